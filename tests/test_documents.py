"""Messages stored as shredded documents give what their text gives, and scans read single paths."""

import re

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from helpers import plan, rows
from weirstone.functions import jsonpath
from weirstone.sources.documents import SHREDDED, store_documents

PATHS, BOOLEANS = ["id", "p.n", "p.flag", "p.t", "no.such"], ["p.flag"]
TEXTS = [
    '{"id":"a","p":{"n":5,"flag":true,"t":"2024-01-01T00:00:00Z"},"pad":"x"}',
    '{"id":7,"p":{"n":"6","flag":"true","t":null}}',
    '{"id":"c","p":{"n":2.5,"flag":false}}',
    '{"id":"d","p":"no object"}',
    '{"id":"e","p":[1]}',
    '{"id":"f","id":"g"}',
    '{"id":"h"},{"id":"i"}',
    "no json",
    "",
    None,
    '{"id":null}',
]


def got(df):
    return rows(df.select("n", *[jsonpath.field(p).cast("string").alias(p) for p in PATHS], jsonpath.field("p.n", "int").alias("int"), jsonpath.field_equals("p.flag", True).alias("yes")))


@pytest.fixture
def messages(spark):
    return spark.createDataFrame(list(enumerate(TEXTS)), "n int, message string")


def test_stored_documents_equal_their_text(spark, tmp_path, messages):
    stored = store_documents(messages, str(tmp_path / "t"))
    assert got(jsonpath.with_message(stored, PATHS, BOOLEANS)) == got(jsonpath.with_message(messages, PATHS, BOOLEANS))
    assert all(spark.conf.get(name, None) != "x" for name in SHREDDED)


def test_text_is_kept_where_it_is_no_document(spark, tmp_path, messages):
    stored = store_documents(messages, str(tmp_path / "t"), keep_text=False)
    kept = rows(stored.filter("message is not null"), "message")
    assert kept == sorted([(t,) for t in TEXTS[6:9]])
    assert got(jsonpath.with_message(stored, PATHS, BOOLEANS)) == got(jsonpath.with_message(messages, PATHS, BOOLEANS))


def test_a_scan_reads_the_paths_alone(spark, tmp_path):
    pad = F.repeat(F.sha2(F.col("id").cast("string"), 256), 20)
    text = F.to_json(F.struct(F.col("id").alias("id"), F.struct((F.col("id") % 7).alias("n"), (F.col("id") % 2 == 0).alias("flag")).alias("p"), pad.alias("pad")))
    stored = store_documents(spark.range(3000).select(F.col("id").alias("n"), text.alias("message")).coalesce(1), str(tmp_path / "t"))
    found = jsonpath.with_message(stored, ["p.n", "p.flag"], ["p.flag"]).filter(jsonpath.field_equals("p.flag", True))
    counted = found.groupBy(jsonpath.field("p.n", "int").alias("n")).count()
    schema = re.findall(r"ReadSchema: .*", plan(counted, "formatted"))
    assert len(schema) == 1 and "message" not in schema[0] and "pad" not in schema[0] and "document:struct<" in schema[0]
    assert counted.count() == 7
    file = pq.ParquetFile(next((tmp_path / "t").glob("*.parquet")))
    sizes = {file.metadata.row_group(0).column(i).path_in_schema: file.metadata.row_group(0).column(i).total_compressed_size for i in range(file.metadata.num_columns)}
    read = sum(v for k, v in sizes.items() if ".p." in k)
    assert read * 20 < sizes["message"]
