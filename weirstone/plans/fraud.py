"""Monthly fraud metrics: users under review, suspended, reinstated, and how long it took."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weirstone.functions.dates import micros
from weirstone.operators.filters import active, in_period
from weirstone.operators.metrics import mean_days, metric_text

# Event names, metric labels and the files they go to.
CALL_VISITED = "IdV: Verify please call visited"
SETUP_ERROR_VISITED = "IdV: Verify setup errors visited"
SUSPENDED = "User Suspension: Suspended"
REINSTATED = "User Suspension: Reinstated"
COHORTS = {
    "review": (CALL_VISITED, SETUP_ERROR_VISITED),
    "suspended": (SUSPENDED,),
    "reinstated": (REINSTATED,),
}
METRICS = {
    "Unique users seeing LG-99": ("lg99_metrics", "lg99_unique_users_count"),
    "Unique users suspended": ("suspended_metrics", "unique_suspended_users_count"),
    "Average Days Creation to Suspension": ("suspended_metrics", "average_days_creation_to_suspension"),
    "Average Days Proofed to Suspension": ("suspended_metrics", "average_days_proofed_to_suspension"),
    "Unique users reinstated": ("reinstated_metrics", "unique_reinstated_users_count"),
    "Average Days to Reinstatement": ("reinstated_metrics", "average_days_to_reinstatement"),
}
COUNTS = ("Unique users seeing LG-99", "Unique users suspended", "Unique users reinstated")  # whole numbers


def user_flags(events: DataFrame, cohorts: dict[str, tuple[str, ...]], name: str = "name", user: str = "user_id") -> DataFrame:
    """One row per user with a flag per cohort; combined on the map side."""
    wanted = sorted({n for names in cohorts.values() for n in names})
    seen = events.filter(F.col(name).isin(*wanted) & F.col(user).isNotNull())
    return seen.groupBy(user).agg(*[F.max(F.col(name).isin(*names)).alias(c) for c, names in cohorts.items()])


def fraud_metrics(
    events: DataFrame, users: DataFrame, profiles: DataFrame, start: dt.datetime, next_start: dt.datetime
) -> DataFrame:
    """(report, Metric, Total, Range Start, Range End), six rows.

    One scan of each table and one final aggregation: users are flagged per cohort, then joined
    by key (never through a list of ids) to their dates and to their active profiles, which are
    summed per user first. A user with several active profiles counts once for each of them in
    the proofing time. ``uuid`` identifies a user. A mean over nothing is ``n/a``.
    """
    flags = user_flags(in_period(events, "cloudwatch_timestamp", start, next_start), COHORTS)
    dates = users.select(
        F.col("uuid").alias("user_id"), F.col("id").alias("__id"), "created_at", "suspended_at", "reinstated_at"
    )
    activated = micros(F.col("activated_at")).cast("decimal(20,0)")
    proofs = (
        active(profiles)
        .filter(F.col("activated_at").isNotNull())
        .groupBy(F.col("user_id").alias("__id"))
        .agg(F.count(F.lit(1)).alias("proofs"), F.sum(activated).alias("activated_sum"))
    )
    people = flags.join(dates, "user_id", "left").join(proofs, "__id", "left")

    def when(flag: str, column: str) -> Column:
        return F.when(F.col(flag), F.col(column))

    counted = F.col("suspended") & F.col("suspended_at").isNotNull()
    proof_span = F.col("proofs") * micros(F.col("suspended_at")).cast("decimal(20,0)") - F.col("activated_sum")
    proof_days = F.sum(F.when(counted, proof_span)).cast("double") / F.sum(F.when(counted, F.col("proofs")))
    metrics = people.agg(
        F.count_if("review").alias("review"),
        F.count_if("suspended").alias("suspended"),
        mean_days(when("suspended", "created_at"), F.col("suspended_at")).alias("to_suspension"),
        F.round(proof_days / F.lit(86400e6), 1).alias("proofed_to_suspension"),
        F.count_if("reinstated").alias("reinstated"),
        mean_days(when("reinstated", "suspended_at"), F.col("reinstated_at")).alias("to_reinstatement"),
    )
    rows = metrics.select(_cells(*zip(METRICS, map(F.col, metrics.columns))))
    return _report(rows, start, next_start)


def _cells(*cells: tuple[str, Column]) -> Column:
    return F.inline(
        F.array(*[F.struct(F.lit(label).alias("Metric"), metric_text(value).alias("Total")) for label, value in cells])
    )


def _report(rows: DataFrame, start: dt.datetime, next_start: dt.datetime) -> DataFrame:
    last = next_start - dt.timedelta(seconds=1)
    report = F.lit(None).cast("string")
    for label, (file, _) in METRICS.items():
        report = F.when(F.col("Metric") == label, file).otherwise(report)
    return rows.select(
        report.alias("report"),
        "Metric",
        "Total",
        F.lit(f"{start:%Y-%m-%d %H:%M:%S} UTC").alias("Range Start"),
        F.lit(f"{last:%Y-%m-%d %H:%M:%S} UTC").alias("Range End"),
    )
