"""Column expressions. Everything here is a Spark built-in, evaluated in the JVM."""
