"""Objects under exact names: all of a job or none, in order, replaced by the next run."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from helpers import rows
from weirstone.plans import delivery
from weirstone.sources.named_files import checked_path, read_objects, write_objects

LINES = "path string, position int, tie string, line string"


def objects(root):
    return {str(p.relative_to(root)): p.read_text() for p in sorted(root.rglob("*")) if p.is_file() and not p.name.startswith(".")}


def test_objects_have_their_names_and_lines_in_order(spark, tmp_path):
    data = [("a/x.csv", n, "", f"line {n}") for n in range(500)] + [("a/latest.x.csv", 1, t, t) for t in "cab"] + [("y.json", 0, "", '{"é": "\n"}')]
    write_objects(spark.createDataFrame(data, LINES).repartition(7), str(tmp_path))
    assert objects(tmp_path) == {
        "a/x.csv": "".join(f"line {n}\n" for n in range(500)), "a/latest.x.csv": "a\nb\nc\n", "y.json": '{"é": "\n"}\n',
    }
    assert not list((tmp_path / "_staged").iterdir())
    found = read_objects(spark, str(tmp_path), "a/*.csv")
    assert rows(found, "path") == [("a/latest.x.csv",), ("a/x.csv",)]


def test_a_second_run_replaces_and_leaves_the_rest(spark, tmp_path):
    write_objects(spark.createDataFrame([("a", 0, "", "1"), ("b", 0, "", "1")], LINES), str(tmp_path))
    write_objects(spark.createDataFrame([("a", 0, "", "2")], LINES), str(tmp_path))
    write_objects(spark.createDataFrame([], LINES), str(tmp_path))
    assert objects(tmp_path) == {"a": "2\n", "b": "1\n"}


def test_a_failed_task_publishes_nothing(spark, tmp_path):
    (tmp_path / "old").write_text("kept")
    good = spark.createDataFrame([(f"d/{n}", 0, "", "x") for n in range(50)], LINES)
    bad = spark.createDataFrame([("d/bad", 0, "", "x")], LINES).withColumn("line", F.raise_error(F.lit("broken row")).cast("string"))
    with pytest.raises(Exception, match="broken row"):
        write_objects(good.unionByName(bad), str(tmp_path))
    with pytest.raises(Exception, match="no name for an object"):
        write_objects(good.unionByName(spark.createDataFrame([("../up", 0, "", "x")], LINES)), str(tmp_path))
    assert objects(tmp_path) == {"old": "kept"}


@pytest.mark.parametrize("path", ["", None, "/a", "a//b", "../a", "a/./b", "_staged/x"])
def test_what_is_no_name(path):
    with pytest.raises(ValueError):
        checked_path(path)


def test_recipients_without_an_id_or_with_a_shared_one(spark):
    listed = spark.createDataFrame([("b",), ("a",), ("c",), ("a",)], "issuer string")
    mapping = spark.createDataFrame([("a", 1), ("b", 1), ("z", 9)], "issuer string, id long")
    assert rows(delivery.deliverable(listed, mapping)) == [("a", 1, "ok"), ("b", 1, "shared_id"), ("c", None, "missing_id")]


def test_demographic_files(spark, tmp_path):
    tables = spark.createDataFrame(
        [("a", "age_metrics", 100, "100-109", 2), ("a", "age_metrics", 20, "20-29", 7), ("a", "state_metrics", 0, 'M"D, X', 1), ("gone", "age_metrics", 0, "0-9", 1)],
        "issuer string, table_name string, sort_key int, label string, user_count long",
    )
    recipients = spark.createDataFrame([("a", 1, "ok"), ("empty", 2, "ok"), ("gone", None, "missing_id")], "issuer string, service_provider_id long, status string")
    quarter = (dt.datetime(2024, 1, 1), dt.datetime(2024, 4, 1))
    write_objects(delivery.demographic_lines(tables, recipients, *quarter, dt.date(2024, 4, 1), "env"), str(tmp_path))
    found = objects(tmp_path)
    base = "env/idp/DemographicsMetricsReport"
    assert found[f"{base}/1/quarterly/Q12024/latest_SP1_age_metrics.csv"] == "Age Range,User Count\n20-29,7\n100-109,2\n"
    assert found[f"{base}/1/quarterly/Q12024/SP1_20240401_external_state_metrics.csv"] == 'State,User Count\n"M""D, X",1\n'
    assert found[f"{base}/2/quarterly/Q12024/latest_external_SP2_age_metrics.csv"] == "Age Range,User Count\n"
    assert len(found) == 2 * 4 * 3
    # before the quarter has ended the external files are not touched
    inner = tmp_path / "inner"
    write_objects(delivery.demographic_lines(tables, recipients, *quarter, dt.date(2024, 3, 31)), str(inner))
    assert len(objects(inner)) == 2 * 4 * 2 and not any("external" in name for name in objects(inner))


def test_the_mapping_is_one_document(spark, tmp_path):
    import json

    mapping = spark.createDataFrame([("b", 2), ('a "quoted"', 1), ("é", 3)], "issuer string, id long")
    write_objects(delivery.mapping_lines(mapping), str(tmp_path))
    write_objects(delivery.mapping_lines(mapping.limit(0), "none"), str(tmp_path))
    assert json.loads(objects(tmp_path)["portal/issuers_service_provider_id.json"]) == {"b": {"id": 2}, 'a "quoted"': {"id": 1}, "é": {"id": 3}}
    assert json.loads(objects(tmp_path)["none/portal/issuers_service_provider_id.json"]) == {}
