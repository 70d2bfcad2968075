"""Age and state of users who verified, per issuer and quarter."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from weirstone.functions.dates import quarter_label
from weirstone.functions.jsonpath import field, field_equals, with_message
from weirstone.functions.text import is_blank
from weirstone.operators.filters import in_period
from weirstone.operators.metrics import bin_counts, bin_label, bin_quality, category_counts

# Event names, JSON paths, age limits, definition texts.
REDIRECT_EVENT = "SP redirect initiated"
PROOFING_EVENT = "IdV: doc auth verify proofing results"
IAL_PATH = "properties.event_properties.ial"
FACIAL_MATCH_PATH = "properties.sp_request.facial_match"
SUCCESS_PATH = "properties.event_properties.success"
BIRTH_YEAR_PATH = "properties.event_properties.proofing_results.biographical_info.birth_year"
STATE_PATH = "properties.event_properties.proofing_results.biographical_info.state_id_jurisdiction"
MIN_AGE, MAX_AGE, AGE_WIDTH = 0, 140, 10
DEFINITIONS = [
    (
        "Age range/Verification Demographics",
        "Count",
        "The number of users for this issuer who verified within the reporting period, grouped by age in 10 year range.",
    ),
    (
        "Geographic area/Verification Demographics",
        "Count",
        "The number of users for this issuer who verified within the reporting period, grouped by state.",
    ),
]


def verified_users(
    events: DataFrame, start: dt.datetime, next_start: dt.datetime
) -> DataFrame:
    """(issuer, user_id, birth_year, state) of users who were redirected and passed proofing.

    One scan for all issuers, in which every message is parsed once, or only the columns of five
    paths are read where the messages are stored as documents: both cohorts are marked on
    the rows and reduced to distinct rows on the map side. What is shuffled by user after that
    is one row per distinct value, so neither a large issuer nor a busy user is a large task.
    A list of issuers is applied to the counts (``table_per_issuer``), never to the raw rows: these
    would have to be shuffled by issuer for it.
    A user with two birth years or states counts once for each, as reports have always shown.
    """
    base = in_period(events, "cloudwatch_timestamp", start, next_start).withColumnRenamed("service_provider", "issuer")
    base = base.filter(F.col("name").isin(REDIRECT_EVENT, PROOFING_EVENT) & F.col("user_id").isNotNull())
    redirected = (
        (F.col("name") == REDIRECT_EVENT) & field_equals(IAL_PATH, 2) & field_equals(FACIAL_MATCH_PATH, True)
    )
    proofed = (F.col("name") == PROOFING_EVENT) & field_equals(SUCCESS_PATH, True)
    documents = with_message(
        base, [IAL_PATH, FACIAL_MATCH_PATH, SUCCESS_PATH, BIRTH_YEAR_PATH, STATE_PATH], booleans=[FACIAL_MATCH_PATH, SUCCESS_PATH]
    )
    distinct = documents.select(
        "issuer",
        "user_id",
        redirected.alias("redirected"),
        proofed.alias("proofed"),
        F.when(proofed, field(BIRTH_YEAR_PATH, "int")).alias("birth_year"),
        F.when(proofed, F.upper(field(STATE_PATH))).alias("state"),
    ).filter(F.col("redirected") | F.col("proofed")).distinct()
    was_redirected = F.max("redirected").over(Window.partitionBy("issuer", "user_id"))
    return (
        distinct.withColumn("redirected", was_redirected)
        .filter(F.col("redirected") & F.col("proofed"))
        .select("issuer", "user_id", "birth_year", "state")
    )


def age_table(users: DataFrame, as_of: dt.date) -> DataFrame:
    """(issuer, bin_start, user_count, bin) by ten years of age."""
    age = F.lit(as_of.year) - F.col("birth_year")
    return bin_counts(users, age, AGE_WIDTH, MIN_AGE, MAX_AGE, ["issuer"])


def age_quality(users: DataFrame, as_of: dt.date) -> DataFrame:
    """Records without a birth year, or with an impossible one, per issuer."""
    return bin_quality(users, F.lit(as_of.year) - F.col("birth_year"), MIN_AGE, MAX_AGE, ["issuer"])


def state_table(users: DataFrame) -> DataFrame:
    return category_counts(users, "state", ["issuer"])


def demographic_tables(users: DataFrame, as_of: dt.date) -> DataFrame:
    """Both tables in one pass: (issuer, table_name, sort_key, label, user_count).

    Each user row becomes at most two labelled rows, and one aggregation counts them all.
    """
    age = F.lit(as_of.year) - F.col("birth_year")
    start = (F.floor(age / AGE_WIDTH) * AGE_WIDTH).cast("int")
    age_cell = F.struct(
        F.lit("age_metrics").alias("table_name"), start.alias("sort_key"), bin_label(age, AGE_WIDTH).alias("label")
    )
    state_cell = F.struct(
        F.lit("state_metrics").alias("table_name"), F.lit(0).alias("sort_key"), F.upper("state").alias("label")
    )
    cells = F.array_compact(
        F.array(
            F.when(age.between(MIN_AGE, MAX_AGE), age_cell),
            F.when(~is_blank(F.col("state")), state_cell),
        )
    )
    labelled = users.select("issuer", F.explode(cells).alias("c")).select("issuer", "c.*")
    return labelled.groupBy("issuer", "table_name", "sort_key", "label").agg(F.count(F.lit(1)).alias("user_count"))


def overview_table(issuers: DataFrame, start: dt.datetime, next_start: dt.datetime, as_of: dt.date) -> DataFrame:
    """(issuer, line, value): also for issuers without any user."""
    last = next_start - dt.timedelta(seconds=1)
    lines = [
        ("Report Timeframe", F.lit(f"{start:%Y-%m-%d %H:%M:%S} UTC to {last:%Y-%m-%d %H:%M:%S} UTC")),
        ("Report Generated", F.lit(f"{as_of:%Y-%m-%d}")),
        ("Issuer", F.col("issuer")),
    ]
    cells = F.array(*[F.struct(F.lit(n).alias("line"), v.alias("value")) for n, v in lines])
    return issuers.select("issuer").distinct().select("issuer", F.inline(cells))


def definitions_table(issuers: DataFrame) -> DataFrame:
    cells = F.array(
        *[
            F.struct(F.lit(m).alias("metric"), F.lit(u).alias("unit"), F.lit(d).alias("definition"))
            for m, u, d in DEFINITIONS
        ]
    )
    return issuers.select("issuer").distinct().select("issuer", F.inline(cells))


def table_per_issuer(issuers: DataFrame, table: DataFrame) -> DataFrame:
    """Left join from the issuer list: an issuer without rows keeps one empty row (header only)."""
    return issuers.select("issuer").distinct().join(table, "issuer", "left")


def period_label(next_start: dt.datetime) -> Column:
    return quarter_label(F.lit((next_start - dt.timedelta(days=1)).date()))
