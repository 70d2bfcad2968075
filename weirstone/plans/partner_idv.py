"""Identity-verification outcomes of a provider in one month."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weirstone.plans.partner_fields import OUTCOME_DETAILS


def partner_idv_rows(
    outcomes: DataFrame,
    providers: DataFrame,
    service_provider_id: int | None,
    month_start_calendar_id: int,
    fields: list[str] = OUTCOME_DETAILS,
    provider: str = "start_service_provider_id",
    period: str = "month_start_calendar_id",
) -> DataFrame:
    """Rows of one provider (or of all, for None). Both parameters are literals at the scan."""
    rows = outcomes.filter(F.col(period) == month_start_calendar_id)
    if service_provider_id is not None:
        rows = rows.filter(F.col(provider) == service_provider_id)
    names = providers.select(
        F.col("service_provider_id").alias(provider), "issuer", "service_provider_name", "agency_name"
    )
    return rows.join(names, provider).select(
        "issuer", "service_provider_name", "agency_name", provider, "month_start_date_actual", period, *fields
    )
