"""Search JSON or text columns for planted or patterned personal data."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Test identities that must never show up in logs.
PII_LITERALS = {
    "phone_number": "314-555-1212",
    "dob_with_slash": "10/06/1938",
    "dob_with_dash": "1938-10-06",
    "address_without_zipcode1": "1 Microsoft Way",
    "address_without_zipcode2": "BaySide",
    "name1": "Fakey",
    "name2": "McFakerson",
}


def literal_patterns(literals: Mapping[str, str]) -> dict[str, str]:
    """Regular expressions that match the literals as they are."""
    return {name: re.escape(text) for name, text in literals.items()}


def _findings(df: DataFrame, keys: Sequence[str], tests: Mapping[str, Column]) -> DataFrame:
    hits = F.array_compact(F.array(*[F.when(test, F.lit(name)) for name, test in tests.items()]))
    return df.select(*keys, F.explode(hits).alias("pattern"))


def scan_pii(df: DataFrame, column: str, patterns: Mapping[str, str], keys: Sequence[str]) -> DataFrame:
    """One finding per row and pattern, without regard to case. A map-only pass over the text.

    Only whether a pattern occurs matters, so leave open-ended repeats off its ends: an e-mail
    pattern that starts with one character instead of ``+`` is linear in the text.
    """
    return _findings(df, keys, {name: F.col(column).rlike(f"(?i){p}") for name, p in patterns.items()})


def scan_literals(df: DataFrame, column: str, keys: Sequence[str], literals: Mapping[str, str] = PII_LITERALS) -> DataFrame:
    """As ``scan_pii`` for plain literals: the text is lower-cased once, then searched for each."""
    lowered = df.select(*keys, F.lower(F.col(column)).alias("__text"))
    return _findings(lowered, keys, {name: F.col("__text").contains(t.lower()) for name, t in literals.items()})


def count_findings(findings: DataFrame) -> DataFrame:
    return findings.groupBy("pattern").agg(F.count(F.lit(1)).alias("findings"))
