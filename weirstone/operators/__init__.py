"""DataFrame -> DataFrame jobs. Reference time is always an argument, never a clock read."""
