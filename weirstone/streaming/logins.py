"""Alerts on logins of watched users, one per login."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weirstone.operators.quality import LOGIN_EVENT, WATCHED_USERS


def watched_login_stream(stream: DataFrame, users: Sequence[str] | None = WATCHED_USERS, event: str = LOGIN_EVENT) -> DataFrame:
    """Every login of a watched user as it is logged.

    Stateless: no login waits for a later one, and none is dropped for coming late. Windows are
    formed when the alerts are read (``quality.watched_login_windows``).
    """
    logins = stream.filter(F.col("event") == event)
    return logins if users is None else logins.filter(F.col("user_name").isin(*users))
