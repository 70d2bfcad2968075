"""Who should have access: users whose groups intersect the enabled ones."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from itertools import chain

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weirstone.operators.dedup import dedup_latest
from weirstone.operators.metrics import top_by_priority

# Accounts that belong to no person.
NON_HUMAN_ACCOUNTS = ("project_21_bot", "root")


def _lookup(mapping: Mapping[str, object], key: Column) -> Column:
    pairs = list(chain.from_iterable((F.lit(k), F.lit(v)) for k, v in mapping.items()))
    return F.try_element_at(F.create_map(*pairs), key)


def canonical_users(users: DataFrame, enabled_groups: Sequence[str], prefix: str = "IAM:") -> DataFrame:
    """Database names of people with an enabled group."""
    return users.filter(_enabled(enabled_groups)).select(F.concat(F.lit(prefix), "username").alias("user_name"))


def _enabled(groups: Sequence[str]) -> Column:
    wanted = F.array(*[F.lit(g) for g in groups])
    return F.arrays_overlap(F.col("groups"), wanted) & ~F.col("username").isin(*NON_HUMAN_ACCOUNTS)


def claimed_emails(users: DataFrame, enabled_groups: Sequence[str], order: Sequence[Column], email_domain: str) -> DataFrame:
    """Enabled users with their e-mail; the first user under ``order`` keeps a shared address."""
    email = F.coalesce(F.col("email"), F.concat("username", F.lit(f"@{email_domain}")))
    return dedup_latest(users.filter(_enabled(enabled_groups)).withColumn("email", email), ["email"], order)


def expected_access(
    users: DataFrame,
    enabled_groups: Sequence[str],
    role_of_group: Mapping[str, str],
    priority_of_role: Mapping[str, int],
    order: Sequence[Column],
    email_domain: str,
    extra_roles: DataFrame | None = None,
    production: bool = True,
) -> DataFrame:
    """One row per expected account: e-mail, role, account name ``role/local part``.

    Each user gets the highest-priority role of their groups, plus the rows of ``extra_roles``
    (username, role). In production groups ending in ``nonprod`` give no role.
    """
    claimed = claimed_emails(users, enabled_groups, order, email_domain)
    roles = claimed.select("email", "username", F.explode("groups").alias("group"))
    if production:
        roles = roles.filter(~F.col("group").endswith("nonprod"))
    roles = roles.select("email", "username", _lookup(role_of_group, F.col("group")).alias("role")).filter(
        F.col("role").isNotNull()
    )
    priority = F.coalesce(_lookup(priority_of_role, F.col("role")), F.lit(0))
    best = top_by_priority(roles.withColumn("priority", priority), ["email", "username"], "role", "priority")
    accounts = best.select("email", "username", "role")
    if extra_roles is not None:
        extra = accounts.drop("role").join(extra_roles, "username").select("email", "username", "role")
        accounts = accounts.unionByName(extra).distinct()
    local_part = F.replace(F.col("email"), F.lit(f"@{email_domain}"), F.lit(""))
    return accounts.withColumn("account", F.concat_ws("/", "role", local_part))


def group_members(users: DataFrame, groups: DataFrame) -> DataFrame:
    """(group, user): the id list of a group is exploded, then joined by equality."""
    members = groups.select("group_name", F.explode("member_ids").alias("user_id"))
    return users.join(members, "user_id").select("group_name", "user_id", "user_name")


def membership_changes(current: DataFrame, expected: DataFrame) -> DataFrame:
    """(group, user, change) to bring the current membership to the expected one."""
    both = current.select("group_name", "user_name", F.lit(1).alias("c"), F.lit(0).alias("e")).unionByName(
        expected.select("group_name", "user_name", F.lit(0).alias("c"), F.lit(1).alias("e"))
    )
    state = both.groupBy("group_name", "user_name").agg(F.max("c").alias("c"), F.max("e").alias("e"))
    return state.filter("c <> e").select(
        "group_name", "user_name", F.when(F.col("e") == 1, "add").otherwise("drop").alias("change")
    )
