"""Column masking: from permissions per role to policies per user, and to masked columns.

Permissions are configuration (a few entries per column) and stay on the driver as literals;
users and groups are data.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Policy and priority per permission; which list wins for a user listed twice;
# groups behind a role; the public mask; the mask text.
POLICIES = {"allowed": ("unmask", 300), "denied": ("deny", 200), "masked": ("mask", 100)}
LIST_PRECEDENCE = ("allowed", "masked", "denied")
ROLE_GROUPS = {
    "dwuser": ("dwuser", "dwusernonprod"),
    "dwpoweruser": ("dwpoweruser", "dwpowerusernonprod"),
    "dwadmin": ("dwadmin", "dwadminnonprod"),
}
PUBLIC = "PUBLIC"
PUBLIC_PRIORITY = 10
MASK_TEXT = "XXXX"

Permissions = Mapping[str, Sequence[str]]  # permission -> roles


@dataclass(frozen=True)
class MaskingConfig:
    """``user_types``: type -> roles. ``columns``: schema.table.column -> permissions."""

    user_types: Mapping[str, Sequence[str]]
    columns: Mapping[str, Permissions] = field(default_factory=dict)
    env: str = ""

    def type_of(self, role: str) -> str | None:
        return next((kind for kind, roles in self.user_types.items() if role in roles), None)

    def superuser_allowed(self, column: str) -> bool:
        roles = (self.columns[column] or {}).get("allowed") or ()
        return any(self.type_of(role) == "superuser" for role in roles)

    def public_columns(self, existing: Sequence[str] | None = None) -> list[str]:
        """Columns that are masked for everybody."""
        return [c for c in self.policed_columns(existing) if not self.superuser_allowed(c)]

    def policed_columns(self, existing: Sequence[str] | None = None) -> list[str]:
        """Configured schema.table.column names, of the existing ones if those are given."""
        return [c for c in self.columns if c.count(".") == 2 and (existing is None or c in existing)]

    def entries(self, kind: str) -> list[tuple[str, str, int]]:
        """(role, column, precedence of its permission) for the roles of one user type."""
        return [
            (role, column, rank)
            for column, permissions in self.columns.items()
            for rank, permission in enumerate(LIST_PRECEDENCE)
            for role in (permissions or {}).get(permission) or ()
            if self.type_of(role) == kind
        ]


def _rows(spark: SparkSession, fields: Mapping[str, str], rows: Sequence[tuple]) -> DataFrame:
    """Configuration entries as a literal relation; its size is known to the planner."""
    items = F.array(*[F.struct(*map(F.lit, row)) for row in rows])
    struct = ",".join(f"{name}:{kind}" for name, kind in fields.items())
    return spark.range(1).select(F.inline(items.cast(f"array<struct<{struct}>>")))


def user_grants(config: MaskingConfig, user_groups: DataFrame, db_users: DataFrame) -> DataFrame:
    """(column_id, db_user, permission), one row per column and user.

    ``user_groups`` is (username, groups), ``db_users`` is (user_name). An ``iam_role`` stands
    for the members of its groups, a ``redshift_user`` for the user of that name; superusers
    and unknown roles stand for nobody. Users match without case, missing ones are dropped.
    Allowed beats masked beats denied for a user that is listed twice.
    """
    spark = db_users.sparkSession
    known = db_users.select(F.col("user_name").alias("db_user"), F.upper("user_name").alias("user_key"))

    by_group = [
        (group, column, rank)
        for role, column, rank in config.entries("iam_role")
        for group in ROLE_GROUPS.get(role, (role,))
    ]
    by_name = [
        (role.replace("{env_name}", config.env).upper(), column, rank)
        for role, column, rank in config.entries("redshift_user")
    ]
    members = user_groups.select(
        F.concat(F.lit("IAM:"), F.upper("username")).alias("user_key"), F.explode("groups").alias("group")
    )
    granted = (
        members.join(_rows(spark, {"group": "string", "column_id": "string", "rank": "int"}, by_group), "group")
        .drop("group")
        .unionByName(_rows(spark, {"user_key": "string", "column_id": "string", "rank": "int"}, by_name))
    )
    permission = F.element_at(F.array(*map(F.lit, LIST_PRECEDENCE)), F.min("rank") + 1)
    return (
        granted.join(known, "user_key").groupBy("column_id", "db_user").agg(permission.alias("permission"))
    )


def build_policies(
    config: MaskingConfig, user_groups: DataFrame, db_users: DataFrame, existing_columns: Sequence[str] | None = None
) -> DataFrame:
    """Expected policies: column_id, grantee, policy_name, priority.

    A column is masked for everybody (``PUBLIC``, lowest priority) and gets rows for allowed
    and denied users. If a superuser is among the allowed, the public mask cannot be attached;
    every user that is not listed and is no superuser then gets a mask of their own.
    """
    spark = db_users.sparkSession
    baseline = config.public_columns(existing_columns)
    per_user = [c for c in config.policed_columns(existing_columns) if c not in baseline]

    public = _rows(
        spark,
        {"column_id": "string", "grantee": "string", "policy_name": "string", "priority": "int"},
        [(c, PUBLIC, f"mask_{c.replace('.', '_')}", PUBLIC_PRIORITY) for c in baseline],
    )
    grants = user_grants(config, user_groups, db_users)
    explicit = grants.filter(
        F.col("column_id").isin(per_user) | (F.col("column_id").isin(baseline) & (F.col("permission") != "masked"))
    )
    superusers = [role.upper() for role in config.user_types.get("superuser", ())]
    ordinary = db_users.filter(~F.upper("user_name").isin(superusers))
    covered = F.array(*map(F.lit, per_user)) if per_user else F.array().cast("array<string>")
    implicit = (
        ordinary.select(F.explode(covered).alias("column_id"), F.col("user_name").alias("db_user"))
        .join(grants.select("column_id", "db_user"), ["column_id", "db_user"], "left_anti")
        .withColumn("permission", F.lit("masked"))
    )
    named = explicit.unionByName(implicit)
    policy, priority = F.lit(None).cast("string"), F.lit(None).cast("int")
    for permission, (kind, level) in POLICIES.items():
        matches = F.col("permission") == permission
        policy, priority = F.when(matches, kind).otherwise(policy), F.when(matches, level).otherwise(priority)
    return public.unionByName(
        named.select(
            "column_id",
            F.col("db_user").alias("grantee"),
            F.concat_ws("_", policy, F.translate("column_id", ".", "_")).alias("policy_name"),
            priority.alias("priority"),
        )
    )


def effective_policies(policies: DataFrame, grantees: DataFrame, public_columns: Sequence[str]) -> DataFrame:
    """(grantee, column_id, policy) in force: the highest priority of own and public policies.

    ``grantees`` is (grantee). The public masks apply to everybody; they are laid out per
    grantee from the configured columns instead of being joined through one shared key.
    """
    kind = F.substring_index("policy_name", "_", 1)
    named = policies.filter(F.upper("grantee") != PUBLIC)
    rows = named.select("column_id", F.upper("grantee").alias("key"), kind.alias("policy"), "priority")
    own = grantees.withColumn("key", F.upper("grantee")).join(rows, "key").drop("key")
    columns = F.array(*map(F.lit, public_columns)).cast("array<string>")
    public = grantees.select(
        "grantee", F.explode(columns).alias("column_id"), F.lit("mask").alias("policy"), F.lit(PUBLIC_PRIORITY).alias("priority")
    )
    everything = own.unionByName(public)
    return everything.groupBy("grantee", "column_id").agg(F.max_by("policy", "priority").alias("policy"))


class GrantClasses(NamedTuple):
    """Grantees with the same policies as one class: (grantee, class_id) and (class_id, column_id, policy)."""

    members: DataFrame
    rows: DataFrame


def grant_classes(policies: DataFrame, grantees: DataFrame, public_columns: Sequence[str]) -> GrantClasses:
    """The policies in force, once per set of own policies instead of once per grantee.

    A grantee's own policies are one row per policed column and hashed as a set, the empty set included. The
    public masks are laid out per class. Both parts are small next to (grantees x columns):
    stage them, and join them where a table is masked (``expanded``).
    """
    own = F.struct("column_id", F.substring_index("policy_name", "_", 1).alias("policy"), "priority")
    named = policies.filter(F.upper("grantee") != PUBLIC)
    sets = named.groupBy(F.upper("grantee").alias("key")).agg(F.array_sort(F.collect_set(own)).alias("own"))
    nothing = F.array().cast(sets.schema["own"].dataType)
    placed = grantees.select("grantee", F.upper("grantee").alias("key")).join(sets, "key", "left").withColumn("own", F.coalesce("own", nothing))
    members = placed.withColumn("class_id", F.sha2(F.to_json("own"), 256))
    public = F.array(*[F.struct(F.lit(c).alias("column_id"), F.lit("mask").alias("policy"), F.lit(PUBLIC_PRIORITY).alias("priority")) for c in public_columns])
    everything = F.concat("own", public.cast(sets.schema["own"].dataType)) if public_columns else F.col("own")
    classes = members.groupBy("class_id").agg(F.first("own").alias("own"))  # equal within a class
    rows = classes.select("class_id", F.inline(everything)).groupBy("class_id", "column_id").agg(F.max_by("policy", "priority").alias("policy"))
    return GrantClasses(members.select("grantee", "class_id"), rows)


def expanded(classes: GrantClasses) -> DataFrame:
    """(grantee, column_id, policy) in force, as ``effective_policies`` gives it."""
    return classes.members.join(classes.rows, "class_id").select("grantee", "column_id", "policy")


def policies_for(policies: DataFrame, table: str, grantee: str) -> dict[str, str]:
    """Policies in force on one table for one grantee: an entry per policed column, not per row."""
    prefix = f"{table}."
    own = policies.filter(F.col("column_id").startswith(prefix) & F.upper("grantee").isin(grantee.upper(), PUBLIC))
    kind = F.substring_index("policy_name", "_", 1)
    rows = own.groupBy("column_id").agg(F.max_by(kind, "priority").alias("policy")).collect()
    return {row.column_id[len(prefix) :]: row.policy for row in rows}


def mask_value(column: Column, data_type: T.DataType, policy: str) -> Column:
    """Value as the policy shows it. The mask text exists for strings only; other types are NULL."""
    if policy == "unmask":
        return column
    if policy == "mask" and isinstance(data_type, T.StringType):
        return F.lit(MASK_TEXT)
    return F.lit(None).cast(data_type)


def mask_columns(df: DataFrame, policies: Mapping[str, str]) -> DataFrame:
    """``df`` as one grantee sees it; ``policies`` maps column to unmask, mask or deny.

    Masked and denied columns become constants, so the scan does not even read them.
    """
    return df.select(
        [
            mask_value(F.col(f.name), f.dataType, policies.get(f.name, "unmask")).alias(f.name)
            for f in df.schema
        ]
    )


def mask_type(data_type: T.DataType) -> str:
    """Type family a mask is declared for; unknown types are treated as text."""
    if isinstance(data_type, T.CharType):
        return f"CHAR({data_type.length})"
    families: Sequence[tuple[type | tuple[type, ...], str]] = (
        ((T.VariantType, T.ArrayType, T.MapType, T.StructType), "SUPER"),
        (T.NumericType, "NUMERIC"),
        (T.DateType, "DATE"),
        ((T.TimestampType, T.TimestampNTZType), "TIMESTAMP"),
        (T.BooleanType, "BOOLEAN"),
    )
    return next((name for kinds, name in families if isinstance(data_type, kinds)), "VARCHAR(MAX)")
