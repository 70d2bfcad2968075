"""Quality checks, personal data, access, masking, decryption."""

import datetime as dt
import json
import re

import pytest
from pyspark.sql import functions as F

from weirstone.operators import access, filters, masking, metrics, pii, quality
from weirstone.operators.decrypt import EVENT_SCHEMA, aes_gcm, decrypt_events, decryption, mark_days, process_encrypted, register_decryptor, register_series_decryptor
from weirstone.sources.partitions import day_folders

from helpers import plan, rows, ts


@pytest.mark.parametrize(("age", "status"), [(1, "within_range"), (32, "out_of_range"), (31, "out_of_range")])
def test_freshness(spark, age, status):
    as_of = ts("2024-01-03 12:00:00")
    df = spark.createDataFrame([(as_of - dt.timedelta(hours=age),), (ts("2020-01-01"),)], "t timestamp")
    assert rows(quality.freshness(df, "t", as_of), "freshness_hours", "status") == [(float(age), status)]


def test_freshness_of_nothing(spark):
    df = spark.createDataFrame([], "t timestamp")
    assert rows(quality.freshness(df, "t", ts("2024-01-01"))) == [(None, None, "error")]
    assert quality.is_empty(df)


def test_duplicates(spark):
    df = spark.createDataFrame([(1,), (1,), (2,), (None,), (None,), (None,)], "id int")
    assert rows(quality.duplicates(df, ["id"])) == [(1, 2), (None, 3)]
    assert quality.duplicate_key(["id", "uuid"]) == "id" and quality.duplicate_key(["uuid"]) == "uuid"


def test_duplicate_check_tables():
    tables = {"logs": ["events", "unextracted_events"], "idp": ["users"], "marts": ["x"]}
    assert quality.duplicate_check_tables(tables, dt.date(2024, 1, 6)) == [("logs", "events"), ("idp", "users")]
    assert quality.duplicate_check_tables(tables, dt.date(2024, 1, 5)) == [("idp", "users")]


def test_large_exports(spark):
    at = ts("2024-01-01 10:05:30")
    df = spark.createDataFrame(
        [(1, ts("2024-01-01 10:00:01"), at, 150), (2, ts("2024-01-01 10:04:00"), at, 250), (3, at, at, 1), (4, ts("2024-01-01 10:00:00"), at, 900)],
        "query int, start_time timestamp, end_time timestamp, line_count int",
    )
    found = quality.large_exports(df, at, lines=100)
    assert found.columns == ["query_id", "starttime", "endtime", "line_count"]
    assert rows(found) == [(1, "2024-01-01 10:00", "2024-01-01 10:05", 150), (2, "2024-01-01 10:04", "2024-01-01 10:05", 250)]


def test_watched_logins(spark):
    now = ts("2024-01-01 10:15:00")
    df = spark.createDataFrame(
        [("superuser ", "authenticated", ts("2024-01-01 10:00:00")), ("superuser ", "authenticated", now),
         ("pii_reader", "authenticated", ts("2024-01-01 09:59:59")), ("pii_reader", "failed", now), ("other", "authenticated", now)],
        "user_name string, event string, record_time timestamp",
    )
    assert rows(quality.watched_logins(df, now, ["superuser ", "pii_reader"])) == [("superuser",)]


def test_unexpected_users(spark):
    names = ["IAM:known", "IAM:Known", "IAM:new", "rdsdb", "IAMR:dev_db_consumption", "IAMR:prod_db_consumption"]
    actual = spark.createDataFrame([(n,) for n in names], "user_name string")
    allowed = spark.createDataFrame([("known",)], "user_name string")
    assert rows(quality.unexpected_users(actual, allowed, "dev")) == [("IAM:Known",), ("IAM:new",), ("IAMR:prod_db_consumption",)]


def test_costly_roles(spark):
    df = spark.createDataFrame([("a", "ADMIN_PRO"), ("b", "ADMIN"), ("c", None)], "user_name string, role string")
    assert rows(quality.costly_roles(df), "user_name") == [("a",)]


def test_keys(spark):
    df = spark.createDataFrame([(1, 5), (1, 5), (None, 6), (2, None)], "id int, ref int")
    assert rows(quality.check_primary_key(df, ["id"])) == [(4, 1, 1, False)]
    assert rows(quality.check_primary_key(df.limit(0), ["id"])) == [(0, 0, 0, True)]
    assert rows(quality.check_foreign_key(df, "ref", spark.createDataFrame([(6,)], "id int"), "id")) == [(5, 2)]


def test_unmapped_providers(spark):
    reports = spark.createDataFrame([("a", 1), ("b", 2), ("c", None)], "issuer string, service_provider_id int")
    mapping = spark.createDataFrame([("a", 1)], "issuer string, id int")
    assert rows(quality.unmapped_providers(reports, mapping), "issuer") == [("b",)]


@pytest.mark.parametrize(
    ("planted", "names"),
    [
        ("Fakey", {"name1"}), ("McFakerson", {"name2"}), ("1938-10-06", {"dob_with_dash"}), ("10/06/1938", {"dob_with_slash"}),
        ("1 MICROSOFT WAY", {"address_without_zipcode1"}), ("baySide", {"address_without_zipcode2"}),
        ("314-555-1212", {"phone_number"}), ("ELB-HealthChecker/2.0", set()), ("fakey mcfakerson", {"name1", "name2"}),
    ],
)
def test_planted_personal_data(spark, planted, names):
    df = spark.createDataFrame([(1, json.dumps({"user_agent": planted})), (2, "{}")], "id int, message string")
    by_literal = pii.scan_literals(df, "message", ["id"])
    by_pattern = pii.scan_pii(df, "message", pii.literal_patterns(pii.PII_LITERALS), ["id"])
    assert rows(by_literal) == rows(by_pattern) == sorted((1, n) for n in names)


def test_patterns_are_literal(spark):
    df = spark.createDataFrame([(1, "a.b"), (2, "axb")], "id int, t string")
    assert rows(pii.scan_pii(df, "t", pii.literal_patterns({"dot": "A.B"}), ["id"])) == [(1, "dot")]
    assert rows(pii.scan_pii(df, "t", {"any": "a.b"}, ["id"])) == [(1, "any"), (2, "any")]


def test_issuer_filter(spark):
    df = spark.createDataFrame([("a",), ("b",), (None,)], "issuer string")
    assert rows(filters.issuer_filter(df, included=["a"])) == [("a",)]
    assert rows(filters.issuer_filter(df, excluded=["a"])) == [("b",)]
    assert filters.issuer_filter(df).count() == 3
    with pytest.raises(ValueError):
        filters.issuer_filter(df, ["a"], ["b"])


def test_in_force(spark):
    day = dt.date(2026, 3, 15)
    df = spark.createDataFrame(
        [("ok", day, dt.date(2026, 3, 16)), ("ends", day, day), ("later", dt.date(2026, 3, 16), dt.date(2027, 1, 1)), ("null", None, None)],
        "issuer string, launch_date date, iaa_end_date date",
    )
    assert rows(filters.in_force(df, day), "issuer") == [("ok",)]


def test_mean_days(spark):
    df = spark.createDataFrame(
        [(ts("2022-01-01"), ts("2022-01-02")), (ts("2022-01-01"), ts("2022-01-03")), (ts("2022-01-01"), None)], "a timestamp, b timestamp"
    )
    assert rows(metrics.avg_days(df, "a", "b")) == [(1.5, 2)]
    assert rows(metrics.avg_days(df.limit(0), "a", "b")) == [(None, 0)]


def test_cohorts_ignore_null_users(spark):
    df = spark.createDataFrame([("x", "u1"), ("y", "u1"), ("y", "u2"), ("x", None), ("z", "u3")], "name string, user_id string")
    counted = metrics.distinct_users_in(df, {"xy": ("x", "y"), "x": ("x",), "none": ("q",)}, "name", "user_id")
    assert rows(counted, "xy", "x", "none") == [(2, 1, 0)]
    assert "Expand" not in plan(counted)


def test_top_by_priority(spark):
    df = spark.createDataFrame([("u", "b", 2), ("u", "a", 2), ("u", "c", 1), ("v", "c", 0)], "user string, role string, p int")
    assert rows(metrics.top_by_priority(df, ["user"], "role", "p")) == [("u", "a", 2), ("v", "c", 0)]


USERS = "username string, email string, groups array<string>, n int"


def test_expected_access(spark):
    users = spark.createDataFrame(
        [
            ("ann", None, ["dwuser", "dwadmin"], 1),
            ("bob", "ann@x.gov", ["dwuser"], 2),
            ("cy", "cy@x.gov", ["dwadminnonprod"], 3),
            ("di", "di@other.gov", ["dwuser", "unknown"], 4),
            ("root", "root@x.gov", ["dwadmin"], 5),
            ("ed", "ed@x.gov", None, 6),
            ("fay", "fay@x.gov", ["other"], 7),
        ],
        USERS,
    )
    enabled = ["dwuser", "dwadmin", "dwadminnonprod"]
    roles = {"dwuser": "Reader", "dwadmin": "Admin", "dwadminnonprod": "Admin"}
    priority = {"Admin": 3, "Reader": 1}
    extra = spark.createDataFrame([("di", "Author"), ("zoe", "Author")], "username string, role string")
    got = access.expected_access(users, enabled, roles, priority, [F.col("n")], "x.gov", extra)
    assert rows(got, "account", "email") == [
        ("Admin/ann", "ann@x.gov"), ("Author/di@other.gov", "di@other.gov"), ("Reader/di@other.gov", "di@other.gov"),
    ]
    sandbox = access.expected_access(users, enabled, roles, priority, [F.col("n")], "x.gov", production=False)
    assert ("Admin/cy", "cy@x.gov") in rows(sandbox, "account", "email")
    assert rows(access.canonical_users(users, enabled)) == [("IAM:ann",), ("IAM:bob",), ("IAM:cy",), ("IAM:di",)]


CONFIG = masking.MaskingConfig(
    user_types={"iam_role": ["dwuser", "dwadmin", "analyst"], "redshift_user": ["etl_{env_name}"], "superuser": ["admin"]},
    columns={
        "public.users.ssn": {"allowed": ["dwadmin"], "masked": ["dwuser"], "denied": ["analyst", "dwuser", "ghost"]},
        "public.users.email": {"allowed": ["admin", "etl_{env_name}"], "denied": ["analyst"]},
        "public.users.name": {},
        "bad.column": {"allowed": ["dwadmin"]},
    },
    env="test",
)


@pytest.fixture
def policies(spark):
    groups = spark.createDataFrame(
        [("alice", ["dwadminnonprod"]), ("bob", ["dwuser", "analyst"]), ("carol", ["analyst"]), ("gone", ["dwadmin"])],
        "username string, groups array<string>",
    )
    users = ["IAM:Alice", "IAM:bob", "IAM:carol", "ETL_test", "admin", "IAM:dave"]
    return masking.build_policies(CONFIG, groups, spark.createDataFrame([(u,) for u in users], "user_name string"))


def test_build_policies(policies):
    ssn, email, name = (f"public.users.{c}" for c in ("ssn", "email", "name"))
    assert rows(policies) == sorted([
        (ssn, "PUBLIC", "mask_public_users_ssn", 10),
        (ssn, "IAM:Alice", "unmask_public_users_ssn", 300),
        (ssn, "IAM:carol", "deny_public_users_ssn", 200),
        (email, "ETL_test", "unmask_public_users_email", 300),
        (email, "IAM:carol", "deny_public_users_email", 200),
        (email, "IAM:bob", "deny_public_users_email", 200),
        (email, "IAM:Alice", "mask_public_users_email", 100),
        (email, "IAM:dave", "mask_public_users_email", 100),
        (name, "PUBLIC", "mask_public_users_name", 10),
    ])


def test_effective_policies_and_masks(spark, policies):
    bob = masking.policies_for(policies, "public.users", "IAM:BOB")
    assert bob == {"ssn": "mask", "email": "deny", "name": "mask"}
    assert masking.policies_for(policies, "public.users", "iam:alice")["ssn"] == "unmask"
    grantees = spark.createDataFrame([("IAM:bob",), ("IAM:Alice",)], "grantee string")
    seen = masking.effective_policies(policies, grantees, CONFIG.public_columns())
    assert ("IAM:bob", "public.users.ssn", "mask") in rows(seen) and seen.count() == 6
    table = spark.createDataFrame([(1, "123", "e", 5)], "id int, ssn string, email string, name int")
    assert rows(masking.mask_columns(table, bob)) == [(1, "XXXX", None, None)]
    assert masking.mask_columns(table, bob).schema["name"].dataType == table.schema["name"].dataType


def test_freshness_reads_the_newest_day_with_a_time(spark, tmp_path):
    data = [(ts("2024-01-01 10:00:00"), "2024-01-01"), (ts("2024-01-02 08:00:00"), "2024-01-02"), (ts("2024-01-02 07:00:00"), "2024-01-02"), (None, "2024-01-03"), (None, None)]
    table = spark.createDataFrame(data, "ts timestamp, d string").select("ts", F.col("d").cast("date").alias("day"))
    table.write.partitionBy("day").parquet(f"{tmp_path}/t")
    stored, as_of = spark.read.parquet(f"{tmp_path}/t"), ts("2024-01-02 20:00:00")
    days = day_folders(spark, f"{tmp_path}/t", "day")
    assert days == ["2024-01-01", "2024-01-02", "2024-01-03"]
    found = quality.freshness_of_days(stored, days, "day", "ts", as_of)
    assert rows(found) == rows(quality.freshness(table, "ts", as_of)) == [(ts("2024-01-02 08:00:00"), 12.0, "within_range")]
    assert re.search(r"PartitionFilters: \[.*2024-01-02", plan(found, "formatted"))
    assert rows(quality.freshness_of_days(stored, ["2024-01-03"], "day", "ts", as_of)) == [(None, None, "error")]
    assert day_folders(spark, f"{tmp_path}/none", "day") == []


def test_classes_of_equal_grants(spark, policies):
    names = ["IAM:bob", "iam:ALICE", "IAM:carol", "IAM:dave", "etl_TEST", "nobody", "no grants", None]
    grantees = spark.createDataFrame([(n,) for n in names], "grantee string")
    classes = masking.grant_classes(policies, grantees, CONFIG.public_columns())
    assert rows(masking.expanded(classes)) == rows(masking.effective_policies(policies, grantees, CONFIG.public_columns()).select("grantee", "column_id", "policy"))
    by_class = {}
    for r in classes.members.collect():
        by_class.setdefault(r.class_id, set()).add(r.grantee)
    assert {"nobody", "no grants", None} in by_class.values() and len(by_class) == 6
    assert classes.rows.groupBy("class_id", "column_id").count().filter("count > 1").isEmpty()


def test_user_listed_twice(spark, policies):
    """Bob is masked and denied for one column: the list order makes that a mask, which the public one covers."""
    assert policies.filter("column_id = 'public.users.ssn' and grantee = 'IAM:bob'").isEmpty()


def secret():
    return F.encode(F.lit("sixteen byte key"), "UTF-8")


PAYLOAD = {"occurred_at": 1_780_602_749.2548823, "user_uuid": "66c1bc79", "user_id": 1, "success": True}


def encrypt(text):
    return F.base64(F.aes_encrypt(text, secret(), F.lit("GCM")))


def encrypted(spark):
    plain = [
        ("nested", json.dumps({"jti": "0f", "events": {"https://schemas.example/login": PAYLOAD}})),
        ("flat", json.dumps(PAYLOAD | {"user_id": 2})),
        ("empty", json.dumps({"events": {}, "user_id": 3})),
        ("not json", "{oops"),
        ("null user", json.dumps({"events": {"a": {"user_uuid": "u"}}})),
    ]
    good = spark.createDataFrame(plain, "event_key string, t string").select("event_key", encrypt(F.col("t")).alias("message"))
    return good.unionByName(spark.createDataFrame([("broken", "encrypted_data_string"), ("null", None)], "event_key string, message string"))


def test_decrypt(spark):
    ok, failed = decrypt_events(encrypted(spark), aes_gcm(secret()), ts("2026-01-01"))
    assert rows(ok, "event_key", "user_id", "user_uuid") == [
        ("empty", 3, None), ("flat", 2, "66c1bc79"), ("nested", 1, "66c1bc79"), ("null user", None, "u"),
    ]
    stamp = {r.event_key: r.event_timestamp for r in ok.collect()}
    assert stamp["nested"].replace(microsecond=0) == ts("2026-06-04 19:52:29") and stamp["empty"] is None
    assert rows(failed, "event_key") == [("broken",), ("not json",), ("null",)]
    assert failed.columns == ["event_key", "message"]


DAY = dt.date(2026, 1, 1)


def test_process_encrypted_twice(spark, tmp_path):
    rows_in = [tuple(r) for r in encrypted(spark).collect()]
    table = spark.createDataFrame([(k, m, None, DAY) for k, m in rows_in], "event_key string, message string, dw_processed_at timestamp, partition_dt date")
    events = spark.createDataFrame([], EVENT_SCHEMA)
    first = process_encrypted(table, events, aes_gcm(secret()), ts("2026-01-01"), str(tmp_path / "one"))
    assert first.events.count() == 4 and first.failed.count() == 3
    assert rows(first.encrypted.filter("dw_processed_at is null"), "event_key") == [("broken",), ("not json",), ("null",)]
    again = process_encrypted(first.encrypted, first.events, aes_gcm(secret()), ts("2026-02-01"), str(tmp_path / "two"))
    assert rows(again.events) == rows(first.events) and rows(again.encrypted) == rows(first.encrypted)


def test_marks_go_to_the_decrypted_day_only(spark, tmp_path):
    """One key on three days: good, not decryptable, and processed a year earlier."""
    good = encrypted(spark).filter("event_key = 'flat'").first().message
    days = [dt.date(2026, 1, n) for n in (1, 2, 3)]
    data = [("k", good, None, days[0]), ("k", "nonsense", None, days[1]), ("k", good, ts("2025-01-01"), days[2])]
    table = spark.createDataFrame(data, "event_key string, message string, dw_processed_at timestamp, partition_dt date")
    done = process_encrypted(table, spark.createDataFrame([], EVENT_SCHEMA), aes_gcm(secret()), ts("2026-02-01"), str(tmp_path / "s"))
    assert rows(done.encrypted, "partition_dt", "dw_processed_at") == [(days[0], ts("2026-02-01")), (days[1], None), (days[2], ts("2025-01-01"))]
    assert rows(done.failed, "partition_dt") == [(days[1],)]
    assert rows(mark_days(table, done), "partition_dt") == [(d,) for d in days[:2]]


def test_one_decryption_per_row(spark, tmp_path):
    encrypted(spark).write.parquet(str(tmp_path / "in"))
    text = plan(decryption(spark.read.parquet(str(tmp_path / "in")), aes_gcm(secret()), ts("2026-01-01")))
    assert text.lower().count("aesdecrypt") == 1 and text.count("Scan parquet") == 1


def test_decrypt_with_a_callers_function(spark):
    @F.pandas_udf("string")
    def reverse(s):
        return s.str[::-1]

    df = spark.createDataFrame([("a", json.dumps({"user_id": 7})[::-1]), ("b", "x")], "event_key string, message string")
    ok, failed = decrypt_events(df, reverse, ts("2026-01-01"))
    assert rows(ok, "event_key", "user_id") == [("a", 7)] and rows(failed, "event_key") == [("b",)]


def test_registered_decryptors(spark):
    register_series_decryptor(spark, lambda text, ids: text.str[::-1] + "-" + ids.astype(str))
    df = spark.sql("SELECT decrypt_udf(t, id) AS d FROM VALUES ('abc', 1L), (NULL, 2L) AS x(t, id)")
    assert rows(df) == [("cba-1",), (None,)]
    register_decryptor(spark, "encode('sixteen byte key', 'UTF-8')")
    found = encrypted(spark).select("event_key", F.expr("decrypt_message(message)").alias("t"))
    assert "Python" not in plan(found)
    assert [(k, t is None) for k, t in rows(found)] == [(k, k in ("broken", "null")) for k in ("broken", "empty", "flat", "nested", "not json", "null", "null user")]
