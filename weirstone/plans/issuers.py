"""Mapping between issuer strings and provider ids."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weirstone.functions.text import strict_integer
from weirstone.operators.filters import usable_issuers


def issuer_to_id(providers: DataFrame) -> DataFrame:
    """(issuer, id): the smallest valid id of an issuer; ids that are no integers are skipped."""
    valid = usable_issuers(providers).select("issuer", strict_integer(F.col("id")).alias("id"))
    return valid.filter(F.col("id").isNotNull()).groupBy("issuer").agg(F.min("id").alias("id"))


def id_to_issuer(mapping: DataFrame) -> DataFrame:
    """(id, issuer): the first issuer in order keeps a shared id."""
    return mapping.groupBy("id").agg(F.min("issuer").alias("issuer"))


def mapping_issues(providers: DataFrame) -> DataFrame:
    """One row: usable rows, ids that are no integers, rows beyond the first of their issuer."""
    per_issuer = (
        usable_issuers(providers)
        .groupBy("issuer")
        .agg(F.count(F.lit(1)).alias("n"), F.count(strict_integer(F.col("id"))).alias("valid"))
    )
    return per_issuer.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("usable_rows"),
        F.coalesce(F.sum(F.col("n") - F.col("valid")), F.lit(0)).alias("invalid_ids"),
        F.coalesce(F.sum(F.greatest(F.col("valid") - 1, F.lit(0))), F.lit(0)).alias("duplicate_rows"),
    )
