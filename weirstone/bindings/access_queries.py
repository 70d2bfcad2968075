"""Expected access and masking on the sample tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weirstone.bindings.registry import Tables, query
from weirstone.operators import access, masking

SEGMENTS = ["BUILDING", "AUTOMOBILE", "MACHINERY"]
ROLE_OF_GROUP = {"BUILDING": "reader", "AUTOMOBILE": "author", "MACHINERY": "admin", "HOUSEHOLD": "reader", "FURNITUREnonprod": "admin"}
PRIORITY = {"reader": 1, "author": 2, "admin": 3}


ALL_SEGMENTS = [*SEGMENTS, "HOUSEHOLD", "FURNITURE"]


def people(t: Tables) -> DataFrame:
    """Nations are e-mail addresses, customers users; the groups of a user are the segments in
    which their nation has a customer of the same balance class."""
    rich = (F.col("c_acctbal") > 9000).alias("rich")
    has = [F.max(F.col("c_mktsegment") == s).alias(s) for s in ALL_SEGMENTS]
    group = {s: "FURNITUREnonprod" if s == "FURNITURE" else s for s in ALL_SEGMENTS}
    groups = t.customer.groupBy("c_nationkey", rich).agg(*has).select(
        "c_nationkey", "rich", F.array_compact(F.array(*[F.when(F.col(s), g) for s, g in group.items()])).alias("groups")
    )
    users = t.customer.select("c_custkey", F.col("c_name").alias("username"), "c_nationkey", rich)
    return users.join(groups, ["c_nationkey", "rich"]).select(
        "username", "c_custkey", F.concat(F.lit("n"), "c_nationkey", F.lit("@example.org")).alias("email"), "groups"
    )


SQL_PEOPLE = """
    g AS (
        SELECT c_nationkey, c_acctbal > 9000 AS rich, list(DISTINCT c_mktsegment) AS segments FROM customer GROUP BY 1, 2
    ),
    people AS (
        SELECT c_name, c_custkey, c_nationkey, segments
        FROM customer JOIN g USING (c_nationkey) WHERE (c_acctbal > 9000) = g.rich
    ),
    enabled AS (
        SELECT * FROM people WHERE list_has_any(segments, ['BUILDING', 'AUTOMOBILE', 'MACHINERY'])
    )
"""


@query(f"""
    WITH {SQL_PEOPLE},
    claimed AS (SELECT * FROM enabled QUALIFY row_number() OVER (PARTITION BY c_nationkey ORDER BY c_custkey) = 1),
    best AS (
        SELECT *, CASE WHEN list_contains(segments, 'MACHINERY') THEN 'admin' WHEN list_contains(segments, 'AUTOMOBILE') THEN 'author'
                       ELSE 'reader' END AS role FROM claimed
    )
    SELECT 'n' || c_nationkey || '@example.org' AS email, c_name AS username, role, role || '/n' || c_nationkey AS account FROM best
""")
def expected_access(t: Tables) -> DataFrame:
    return access.expected_access(people(t), SEGMENTS, ROLE_OF_GROUP, PRIORITY, [F.col("c_custkey")], "example.org")


@query(f"WITH {SQL_PEOPLE} SELECT 'IAM:' || c_name AS user_name FROM enabled")
def canonical_users(t: Tables) -> DataFrame:
    return access.canonical_users(people(t), SEGMENTS)


@query("""
    SELECT 'order ' || o_orderkey AS group_name, c_custkey AS user_id, c_name AS user_name
    FROM (SELECT o_orderkey, o_custkey AS m FROM orders UNION SELECT o_orderkey, o_orderkey FROM orders) JOIN customer ON c_custkey = m
""")
def group_members(t: Tables) -> DataFrame:
    """Groups hold their members as arrays of ids."""
    users = t.customer.select(F.col("c_custkey").alias("user_id"), F.col("c_name").alias("user_name"))
    groups = t.orders.select(
        F.concat(F.lit("order "), "o_orderkey").alias("group_name"),
        F.array_distinct(F.array("o_custkey", "o_orderkey")).alias("member_ids"),
    )
    return access.group_members(users, groups)


@query("""
    SELECT 'segment ' || c_mktsegment AS group_name, c_name AS user_name,
           CASE WHEN c_nationkey < 5 THEN 'add' ELSE 'drop' END AS change
    FROM customer WHERE c_nationkey < 5 OR c_nationkey > 20
""")
def membership_changes(t: Tables) -> DataFrame:
    rows = t.customer.select(F.concat(F.lit("segment "), "c_mktsegment").alias("group_name"), F.col("c_name").alias("user_name"), "c_nationkey")
    return access.membership_changes(rows.filter("c_nationkey >= 5"), rows.filter("c_nationkey <= 20"))


# Columns of the sample customer table: a name only a superuser and admins see besides the listed,
# a balance that is masked for all but two nations, a segment that nobody was given.
CONFIG = masking.MaskingConfig(
    user_types={
        "iam_role": ["dwadmin", "dwuser", "nation4"],
        "redshift_user": ["{env_name}_loader", "IAM:supplier#000000007"],
        "superuser": ["IAM:Supplier#000000003"],
    },
    columns={
        "idp.customer.c_name": {
            "allowed": ["dwadmin", "IAM:Supplier#000000003"],
            "masked": ["nation4"],
            "denied": ["dwuser", "nation4"],
        },
        "idp.customer.c_acctbal": {"allowed": ["nation4"], "masked": ["dwadmin"], "denied": ["dwuser", "IAM:supplier#000000007"]},
        "idp.customer.c_mktsegment": {},
    },
    env="dev",
)


def db_users(t: Tables) -> DataFrame:
    return t.supplier.select(F.concat(F.lit("IAM:"), "s_name").alias("user_name"))


def user_groups(t: Tables) -> DataFrame:
    """Lower-cased names: nation 1 is in the admin group, 2 in the non-production user group, and
    everybody in the group of their nation."""
    nation = F.col("s_nationkey")
    role = F.when(nation == 1, "dwadmin").when(nation == 2, "dwusernonprod")
    own = F.concat(F.lit("nation"), nation)
    return t.supplier.select(F.lower("s_name").alias("username"), F.array_compact(F.array(role, own)).alias("groups"))


SQL_POLICIES = """
    grants AS (
        SELECT 'idp.customer.c_name' AS column_id, s_name,
               CASE s_nationkey WHEN 1 THEN 'allowed' WHEN 4 THEN 'masked' WHEN 2 THEN 'denied' END AS permission
        FROM supplier WHERE s_nationkey IN (1, 2, 4)
        UNION ALL
        SELECT 'idp.customer.c_acctbal', s_name,
               CASE WHEN s_nationkey = 4 THEN 'allowed' WHEN s_nationkey = 1 THEN 'masked' ELSE 'denied' END
        FROM supplier WHERE s_nationkey IN (1, 2, 4) OR s_suppkey = 7
    ),
    named AS (
        SELECT column_id, s_name, permission FROM grants WHERE column_id = 'idp.customer.c_name' OR permission <> 'masked'
        UNION ALL
        SELECT 'idp.customer.c_name', s_name, 'masked' FROM supplier
        WHERE s_nationkey NOT IN (1, 2, 4) AND s_suppkey <> 3
    ),
    policies AS (
        SELECT column_id, 'IAM:' || s_name AS grantee,
               CASE permission WHEN 'allowed' THEN 'unmask' WHEN 'denied' THEN 'deny' ELSE 'mask' END || '_' || replace(column_id, '.', '_') AS policy_name,
               CASE permission WHEN 'allowed' THEN 300 WHEN 'denied' THEN 200 ELSE 100 END AS priority
        FROM named
        UNION ALL SELECT 'idp.customer.c_acctbal', 'PUBLIC', 'mask_idp_customer_c_acctbal', 10
        UNION ALL SELECT 'idp.customer.c_mktsegment', 'PUBLIC', 'mask_idp_customer_c_mktsegment', 10
    )
"""


@query(f"WITH {SQL_POLICIES} SELECT * FROM policies")
def masking_policies(t: Tables) -> DataFrame:
    return masking.build_policies(CONFIG, user_groups(t), db_users(t))


SQL_EFFECTIVE = f"""
    WITH {SQL_POLICIES},
    seen AS (
        SELECT 'IAM:' || s_name AS grantee, column_id, policy_name, priority
        FROM supplier JOIN policies ON policies.grantee IN ('IAM:' || s_name, 'PUBLIC')
    )
    SELECT grantee, column_id, split_part(arg_max(policy_name, priority), '_', 1) AS policy FROM seen GROUP BY 1, 2
"""


@query(SQL_EFFECTIVE)
def effective_policies(t: Tables) -> DataFrame:
    policies = masking.build_policies(CONFIG, user_groups(t), db_users(t))
    return masking.effective_policies(policies, db_users(t).withColumnRenamed("user_name", "grantee"), CONFIG.public_columns())


def supplier_classes(t: Tables) -> masking.GrantClasses:
    policies = masking.build_policies(CONFIG, user_groups(t), db_users(t))
    return masking.grant_classes(policies, db_users(t).withColumnRenamed("user_name", "grantee"), CONFIG.public_columns())


@query(SQL_EFFECTIVE)
def effective_policies_by_class(t: Tables) -> DataFrame:
    return masking.expanded(supplier_classes(t))


@query(f"""
    WITH effective AS ({SQL_EFFECTIVE}),
    sets AS (SELECT grantee, string_agg(column_id || '=' || policy, ',' ORDER BY column_id) AS policies FROM effective GROUP BY grantee)
    SELECT policies, count(*) AS grantees FROM sets GROUP BY policies
""")
def grant_class_sizes(t: Tables) -> DataFrame:
    """How many grantees share which policies."""
    classes = supplier_classes(t)
    cells = F.array_sort(F.collect_list(F.concat_ws("=", "column_id", "policy")))
    sets = classes.rows.groupBy("class_id").agg(F.array_join(cells, ",").alias("policies"))
    sizes = classes.members.groupBy("class_id").agg(F.count(F.lit(1)).alias("grantees"))
    return sizes.join(sets, "class_id").groupBy("policies").agg(F.sum("grantees").alias("grantees"))


VIEWS = masking.MaskingConfig(
    user_types={"redshift_user": ["IAM:Supplier#000000001", "IAM:Supplier#000000003"]},
    columns={
        "idp.customer.c_name": {"allowed": ["IAM:Supplier#000000001"], "denied": ["IAM:Supplier#000000003"]},
        "idp.customer.c_acctbal": {"denied": ["IAM:Supplier#000000003"]},
        "idp.customer.c_mktsegment": {},
    },
)


@query("""
    SELECT 'allowed' AS seen_by, c_custkey, c_name, CAST(NULL AS DOUBLE) AS c_acctbal, 'XXXX' AS c_mktsegment FROM customer
    UNION ALL SELECT 'masked', c_custkey, 'XXXX', NULL, 'XXXX' FROM customer
    UNION ALL SELECT 'denied', c_custkey, NULL, NULL, 'XXXX' FROM customer
""")
def masked_customers(t: Tables) -> DataFrame:
    """The table as three users see it: one allowed, one only masked, one denied."""
    policies = masking.build_policies(VIEWS, user_groups(t), db_users(t))
    table = t.customer.select("c_custkey", "c_name", "c_acctbal", "c_mktsegment")
    views = [
        masking.mask_columns(table, masking.policies_for(policies, "idp.customer", f"iam:supplier#00000000{n}")).select(
            F.lit(kind).alias("seen_by"), "*"
        )
        for kind, n in (("allowed", 1), ("masked", 2), ("denied", 3))
    ]
    return views[0].unionByName(views[1]).unionByName(views[2])


@query("""
    SELECT 'events' AS table_name, column_name, CASE WHEN column_type IN ('BIGINT', 'INTEGER', 'DOUBLE') THEN 'NUMERIC' WHEN column_type = 'TIMESTAMP' THEN 'TIMESTAMP' ELSE 'VARCHAR(MAX)' END AS mask_type FROM (DESCRIBE events)
    UNION ALL
    SELECT 'embeddings', column_name, CASE WHEN column_type IN ('BIGINT', 'INTEGER', 'DOUBLE') THEN 'NUMERIC' WHEN column_type LIKE '%[]' THEN 'SUPER' ELSE 'VARCHAR(MAX)' END FROM (DESCRIBE embeddings)
""")
def mask_types(t: Tables) -> DataFrame:
    """The type family for which each column's mask is declared."""
    cells = [
        F.struct(F.lit(name).alias("table_name"), F.lit(f.name).alias("column_name"), F.lit(masking.mask_type(f.dataType)).alias("mask_type"))
        for name, df in (("events", t.events), ("embeddings", t.embeddings))
        for f in df.schema
    ]
    return t.spark.range(1).select(F.inline(F.array(*cells)))
