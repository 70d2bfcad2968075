"""All registered queries: equal to their SQL at the smallest scale, and sound plans."""

import importlib.util
import re
import sys
from pathlib import Path

import pytest

from helpers import plan

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))
DATA = Path("/root/testdata/sf0.001")

from __spark_entry__ import entry, oracle_sql, queries  # noqa: E402

from weirstone.bindings import QUERIES  # noqa: E402

spec = importlib.util.spec_from_file_location("check_oracle", ROOT / "tools" / "check_oracle.py")
check_oracle = importlib.util.module_from_spec(spec)
spec.loader.exec_module(check_oracle)

pytestmark = pytest.mark.skipif(not DATA.exists(), reason="sample tables are not here")


@pytest.fixture(scope="module")
def duck():
    return check_oracle.connect(str(DATA))


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, duck, name):
    df = queries()[name](spark, str(DATA))
    text = plan(df)
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython", "MapInPandas", "Scan ExistingRDD"):
        assert bad not in text, f"{bad} in the plan"
    assert check_oracle.difference(df.toPandas(), duck.execute(oracle_sql()[name]).fetchdf()) is None


def test_entry(spark):
    assert entry(spark).columns == ["issuer", "table_name", "sort_key", "label", "user_count"]


def test_every_query_has_sql():
    assert set(QUERIES) <= set(queries()) and set(QUERIES) <= set(oracle_sql())


def test_pushdown(spark):
    text = plan(queries()["time_range"](spark, str(DATA)), "formatted")
    assert "GreaterThanOrEqual(ts" in text and re.search(r"ReadSchema: struct<event_id:bigint,ts:timestamp_ntz>", text)
    text = plan(queries()["masked_customers"](spark, str(DATA)), "formatted")
    assert "ReadSchema: struct<c_custkey:bigint>" in text  # all other columns are masked or denied for one of the views


def test_plans_without_broadcast_use_hash_keys(spark):
    """Beyond the broadcast limit every join still has an equality to shuffle on."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        for name, build in QUERIES.items():
            text = plan(build(spark, str(DATA)))
            assert "NestedLoop" not in text and "Cartesian" not in text, name
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
