"""Report plans and sinks against golden rows."""

import collections
import datetime as dt
import random
import json

import pytest
from pyspark.sql import functions as F

from weirstone.plans import conversions, demographics, fraud, issuers, partner, partner_idv
from weirstone.plans.partner_fields import OUTCOME_DETAILS
from weirstone.sources.metrics_csv import metrics_row, read_metrics
from weirstone.sources.sinks import provider_files, rows_as_json, write_documents, write_report

from helpers import plan, rows, ts

QUARTER = (ts("2025-07-01"), ts("2025-10-01"))
AS_OF = dt.date(2025, 10, 2)
LOG = "user_id string, name string, service_provider string, message string, cloudwatch_timestamp timestamp"


def redirect(ial=2, match=True):
    return json.dumps({"properties": {"event_properties": {"ial": ial}, "sp_request": {"facial_match": match}}})


def proofing(age, state, success=True):
    year = None if age is None else AS_OF.year - age
    info = {"birth_year": year, "state_id_jurisdiction": state}
    return json.dumps({"properties": {"event_properties": {"success": success, "proofing_results": {"biographical_info": info}}}})


def events(spark, people, issuer="sp:one", at="2025-08-01"):
    data = []
    for user, age, state in people:
        data.append((user, demographics.REDIRECT_EVENT, issuer, redirect(), ts(at)))
        data.append((user, demographics.PROOFING_EVENT, issuer, proofing(age, state), ts(at)))
    return data


PEOPLE = [("u1", 15, "MD"), ("u2", 16, "md"), ("u3", 25, "DE"), ("u4", 26, "DE"), ("u5", 35, "VA"), ("u6", 36, "VA")]


def tables(spark, data):
    users = demographics.verified_users(spark.createDataFrame(data, LOG), *QUARTER)
    return users, rows(demographics.demographic_tables(users, AS_OF), "issuer", "table_name", "label", "user_count")


def test_ages_and_states(spark):
    _, got = tables(spark, events(spark, PEOPLE))
    assert got == [("sp:one", "age_metrics", f"{a}-{a + 9}", 2) for a in (10, 20, 30)] + [
        ("sp:one", "state_metrics", s, 2) for s in ("DE", "MD", "VA")
    ]


def test_age_limits_and_quality(spark):
    people = [("a", 0, "X"), ("b", 140, ""), ("c", 141, "  "), ("d", -1, None), ("e", None, "Y")]
    users, got = tables(spark, events(spark, people))
    assert [g[2] for g in got if g[1] == "age_metrics"] == ["0-9", "140-149"]
    assert [g[2] for g in got if g[1] == "state_metrics"] == ["X", "Y"]
    assert rows(demographics.age_quality(users, AS_OF)) == [("sp:one", 5, 1, 2)]
    split = rows(demographics.age_table(users, AS_OF), "bin", "user_count"), rows(demographics.state_table(users), "state", "user_count")
    assert split == ([("0-9", 1), ("140-149", 1)], [("X", 1), ("Y", 1)])


def test_cohort_rules(spark):
    at, issuer = ts("2025-08-01"), "sp:one"
    data = events(spark, [("in", 20, "MD")]) + events(spark, [("in", 20, "VA")]) + events(spark, [("old", 20, "MD")], at="2025-06-30 23:59:59")
    data += events(spark, [("edge", 20, "TX")], at="2025-09-30 23:59:59.999")
    data += events(spark, [("next", 20, "MD")], at="2025-10-01")
    data += [(u, demographics.PROOFING_EVENT, issuer, proofing(20, "NY"), at) for u in ("ial1", "nomatch", "alone", "other sp", None)]
    data += [("ial1", demographics.REDIRECT_EVENT, issuer, redirect(ial=1), at), ("nomatch", demographics.REDIRECT_EVENT, issuer, redirect(match=None), at)]
    data += [("other sp", demographics.REDIRECT_EVENT, "sp:two", redirect(), at), (None, demographics.REDIRECT_EVENT, issuer, redirect(), at)]
    data += [("bad", demographics.REDIRECT_EVENT, issuer, redirect(), at), ("bad", demographics.PROOFING_EVENT, issuer, "{cut", at)]
    data += [("failed", demographics.REDIRECT_EVENT, issuer, redirect(), at), ("failed", demographics.PROOFING_EVENT, issuer, proofing(20, "NY", False), at)]
    users, _ = tables(spark, data)
    assert rows(users, "user_id", "state") == [("edge", "TX"), ("in", "MD"), ("in", "VA")]


def test_demographics_without_rows(spark):
    listed = spark.createDataFrame([("sp:one",), ("sp:none",)], "issuer string")
    users, _ = tables(spark, events(spark, PEOPLE[:1]))
    got = demographics.table_per_issuer(listed, demographics.state_table(users))
    assert rows(got) == [("sp:none", None, None), ("sp:one", "MD", 1)]
    overview = demographics.overview_table(listed, *QUARTER, AS_OF)
    assert ("sp:none", "Report Timeframe", "2025-07-01 00:00:00 UTC to 2025-09-30 23:59:59 UTC") in rows(overview)
    assert demographics.definitions_table(listed).count() == 4
    assert spark.range(1).select(demographics.period_label(QUARTER[1])).first()[0] == "Q32025"


def test_demographics_reads_once(spark, tmp_path):
    spark.createDataFrame(events(spark, PEOPLE), LOG).write.parquet(str(tmp_path / "log"))
    users = demographics.verified_users(spark.read.parquet(str(tmp_path / "log")), *QUARTER)
    text = plan(demographics.demographic_tables(users, AS_OF), "formatted")
    assert text.count("Scan parquet") == 2 and "In(name, [" in text  # tree and details of one scan
    assert text.count("from_json") == 1 and "Join" not in text


JANUARY = (ts("2022-01-01"), ts("2022-02-01"))
CALL, SETUP, SUSPENDED, REINSTATED = fraud.CALL_VISITED, fraud.SETUP_ERROR_VISITED, fraud.SUSPENDED, fraud.REINSTATED


def fraud_inputs(spark):
    seen = [("user1", CALL), ("user1", CALL), ("user1", SETUP), ("user2", SETUP), ("user3", CALL), ("user3", SETUP), ("user4", CALL),
            ("user5", SETUP), ("user6", SUSPENDED), ("user6", REINSTATED), ("user7", SUSPENDED), (None, CALL)]
    log = [(u, n, ts("2022-01-05")) for u, n in seen] + [("user8", SUSPENDED, ts("2022-01-31 23:59:59.5")), ("user9", SUSPENDED, JANUARY[1])]
    log = [r for r in log if r[0] != "user8"]
    events = spark.createDataFrame(log, "user_id string, name string, cloudwatch_timestamp timestamp")
    start = ts("2022-01-01")
    days = dt.timedelta(days=1)
    users = spark.createDataFrame(
        [(6, "user6", start, start + days, start + 4 * days), (7, "user7", start, start + 2 * days, None), (9, "user9", start, start + 90 * days, None)],
        "id long, uuid string, created_at timestamp, suspended_at timestamp, reinstated_at timestamp",
    )
    profiles = spark.createDataFrame(
        [(6, True, start - days), (7, True, start), (7, False, start - 50 * days), (9, True, start)],
        "user_id long, active boolean, activated_at timestamp",
    )
    return events, users, profiles


EXPECTED = [
    ("lg99_metrics", "Unique users seeing LG-99", "5"),
    ("reinstated_metrics", "Average Days to Reinstatement", "3.0"),
    ("reinstated_metrics", "Unique users reinstated", "1"),
    ("suspended_metrics", "Average Days Creation to Suspension", "1.5"),
    ("suspended_metrics", "Average Days Proofed to Suspension", "2.0"),
    ("suspended_metrics", "Unique users suspended", "2"),
]


def test_fraud_metrics(spark):
    report = fraud.fraud_metrics(*fraud_inputs(spark), *JANUARY)
    assert rows(report, "report", "Metric", "Total") == EXPECTED
    assert rows(report, "Range Start", "Range End")[0] == ("2022-01-01 00:00:00 UTC", "2022-01-31 23:59:59 UTC")


def test_fraud_fan_out_per_active_profile(spark):
    events, users, profiles = fraud_inputs(spark)
    more = profiles.unionByName(spark.createDataFrame([(7, True, ts("2021-12-30"))], profiles.schema))
    report = fraud.fraud_metrics(events, users, more, *JANUARY)
    assert ("Average Days Proofed to Suspension", "2.7") in rows(report, "Metric", "Total")  # (2 + 2 + 4) / 3


def test_fraud_without_users(spark):
    events, users, profiles = fraud_inputs(spark)
    report = fraud.fraud_metrics(events, users.limit(0), profiles, *JANUARY)
    assert [t for m, t in rows(report, "Metric", "Total") if m.startswith("Average")] == ["n/a"] * 3


def test_metrics_round_trip(spark, tmp_path):
    report = fraud.fraud_metrics(*fraud_inputs(spark), *JANUARY)
    paths = []
    for name in sorted({r for r, _ in fraud.METRICS.values()}):
        paths.append(str(tmp_path / name))
        write_report(report.filter(F.col("report") == name).drop("report"), paths[-1], single_file=True)
    names = {label: column for label, (_, column) in fraud.METRICS.items()}
    got = read_metrics(spark, paths, names).first().asDict()
    assert got["lg99_unique_users_count"] == 5 and got["average_days_creation_to_suspension"] == 1.5
    assert (got["range_start"], got["range_end"]) == (ts("2022-01-01"), ts("2022-01-31 23:59:59"))
    typed = read_metrics(spark, paths, names, fraud.COUNTS)
    assert dict(typed.dtypes)["lg99_unique_users_count"] == "bigint" and dict(typed.dtypes)["average_days_creation_to_suspension"] == "double"
    assert typed.first().asDict() == got
    missing = read_metrics(spark, paths[:1], names)
    with pytest.raises(Exception, match="not found in CSV data"):
        missing.collect()


def test_metrics_not_available(spark):
    data = [("Average Days to Reinstatement", "n/a", "2022-01-01 00:00:00 UTC", "2022-01-31 23:59:59 UTC")]
    df = spark.createDataFrame(data, "Metric string, Total string, `Range Start` string, `Range End` string")
    assert metrics_row(df, {"Average Days to Reinstatement": "days"}).first().days is None


def conversion_inputs(spark, upgraded="2020-04-16"):
    day = dt.date.fromisoformat
    orders = spark.createDataFrame(
        [(1, 1, day("2020-04-15"), day("2021-04-14"), 10)], "id int, order_number int, start_date date, end_date date, iaa_gtc_id int"
    )
    usages = spark.createDataFrame([(1, 100), (1, 100)], "iaa_order_id int, integration_id int")
    integrations = spark.createDataFrame([(100, "sp:a")], "id int, issuer string")
    gtcs = spark.createDataFrame([(10, "gtc1234")], "id int, gtc_number string")
    providers = spark.createDataFrame([("sp:a", "Friendly"), ("sp:b", "Other")], "issuer string, friendly_name string")
    upgrades = spark.createDataFrame([(7, "sp:a", ts(upgraded))], "user_id int, issuer string, upgraded_at timestamp")
    return upgrades, conversions.covered_orders(orders, usages, integrations, gtcs, providers)


def test_conversion_report(spark):
    report = conversions.conversion_report(*conversion_inputs(spark))
    assert rows(report.drop("order_id")) == [
        ("gtc1234-0001", "2020-04-15", "2021-04-14", "sp:a", "Friendly", "202004", "April 2020", 1)
    ]


@pytest.mark.parametrize(
    ("upgraded", "found"),
    [("2020-04-15", 1), ("2020-04-14 23:59:59", 0), ("2021-04-13 23:59:59", 1), ("2021-04-14", 1), ("2021-04-14 00:00:01", 0)],
)
def test_conversion_window_ends(spark, upgraded, found):
    assert conversions.conversion_report(*conversion_inputs(spark, upgraded)).count() == found


@pytest.mark.parametrize("points_per_sweep", [3, 1_000_000])
def test_conversion_sweep_equals_a_comparison_of_all_pairs(spark, points_per_sweep):
    rng = random.Random(4)
    issuers, first = ["a", "b", "c"], dt.date(2020, 1, 1)
    days = [first + dt.timedelta(days=n) for n in range(0, 200, 3)]

    def upgraded():
        at = dt.datetime.combine(rng.choice(days), dt.time())
        return rng.choice([at, at, at + dt.timedelta(hours=5), None])

    users = [(n, rng.choice([*issuers, None]), upgraded()) for n in range(400)]
    ends = [*days, None, dt.date(9999, 12, 31), dt.date(1900, 1, 1)]
    orders = [(n, n, n, rng.choice(ends), rng.choice(ends), rng.choice([*issuers, "quiet"]), "x") for n in range(60)]
    covered = spark.createDataFrame(orders, "order_id int, order_number int, gtc_number int, start_date date, end_date date, issuer string, friendly_name string")
    upgrades = spark.createDataFrame(users, "user_id int, issuer string, upgraded_at timestamp")
    expected = collections.Counter()
    for order, _, _, start, end, issuer, _ in orders:
        for _, at_issuer, at in users:
            if None not in (start, end, at) and issuer == at_issuer and dt.datetime.combine(start, dt.time()) <= at <= dt.datetime.combine(end, dt.time()):
                expected[order, at.date().replace(day=1)] += 1
    counts = conversions.conversion_counts(upgrades, covered, points_per_sweep)
    assert {(r.order_id, r.month): r.user_count for r in counts.collect()} == expected
    assert counts.schema["order_id"].dataType == covered.schema["order_id"].dataType


def test_conversion_counts_first_upgrade_only(spark):
    upgrades, covered = conversion_inputs(spark)
    more = [(7, "sp:a", ts("2020-05-01")), (8, "sp:a", ts("2020-04-20")), (8, "sp:b", ts("2020-04-19")), (9, "sp:a", ts("2020-04-20")), (None, "sp:a", ts("2020-04-20"))]
    report = conversions.conversion_report(upgrades.unionByName(spark.createDataFrame(more, upgrades.schema)), covered)
    assert rows(report, "year_month", "user_count") == [("202004", 2)]


FIELDS = ["count_active_users", "count_authentications"]
ROW = "issuer string, service_provider_name string, agency_name string, service_provider_id int, period_date_actual string, period_date_id int, count_active_users string, count_authentications string"


def partner_rows(spark):
    return spark.createDataFrame(
        [
            ("one", "One", "A", 1, "2026-03-01", 20260301, "12", " "),
            ("two", None, "A", 2, "2026-03-01", 20260301, "1", "1"),
            ("three", "Three", "A", 3, "2026-03-01", 20260301, "invalid_number", None),
            *[("four", "Four", "A", 4, "2026-03-01", 20260301, str(n), "1") for n in range(3)],
            ("five", "Five", "A", None, "2026-03-01", 20260301, "5", "5"),
            (None, "Six", "A", 6, "2026-03-01", 20260301, "5", "5"),
            (None, "Seven", "A", 7, "2026-03-01", 20260301, "5", "5"),
        ],
        ROW,
    )


def test_partner_rows_are_checked(spark):
    checked = partner.checked_rows(partner_rows(spark), FIELDS)
    assert rows(checked, "issuer", "status", "bad_values") == [
        ("five", "missing_id", 0), *[("four", "duplicate_issuer", 0)] * 3, ("one", "ok", 0), ("three", "ok", 1), ("two", "missing_field", 0),
        *[(None, "missing_field", 0)] * 2,
    ]


def test_partner_documents(spark, tmp_path):
    documents = partner.partner_documents(partner.checked_rows(partner_rows(spark), FIELDS), "monthly", FIELDS)
    got = {r.service_provider_id: json.loads(r.document) for r in documents.collect()}
    assert sorted(got) == [1, 3]
    assert got[1] == {
        "issuer": "one",
        "provider_information": {"service_provider_name": "One", "agency_name": "A", "service_provider_id": 1},
        "report_information": {"period_start_date": "2026-03-01", "period_calendar_id": 20260301, "report_cadence": "monthly"},
        "data": {"count_active_users": 12, "count_authentications": None},
    }
    assert got[3]["data"] == {"count_active_users": None, "count_authentications": None}
    write_documents(documents.select("service_provider_id", "document"), str(tmp_path / "out"))
    assert sorted(p.name for p in (tmp_path / "out").glob("service*")) == ["service_provider_id=1", "service_provider_id=3"]


def test_partner_period_and_join(spark):
    day = dt.date(2026, 3, 15)
    calendar = spark.createDataFrame(
        [(20260315, day, 20260301, dt.date(2026, 3, 1), 20260309, dt.date(2026, 3, 9))],
        "calendar_id int, date_actual date, month_start_calendar_id int, month_start_date_actual date, week_start_calendar_id int, week_start_date_actual date",
    )
    assert partner.report_period(calendar, day) == (20260301, "2026-03-01")
    assert partner.report_period(calendar, day, "weekly") == (20260309, "2026-03-09")
    assert partner.report_period(calendar, day, "daily") == (20260315, "2026-03-15")
    assert partner.report_period(calendar, dt.date(2026, 3, 16)) is None
    assert partner.metric_table_name("idv", "weekly") == "marts.sp_idv_outcomes_weekly"
    with pytest.raises(ValueError):
        partner.report_period(calendar, day, "yearly")
    providers = spark.createDataFrame(
        [(1, "one", "One", "A", dt.date(2020, 1, 1), dt.date(2030, 1, 1)), (2, "two", "Two", "A", dt.date(2020, 1, 1), dt.date(2030, 1, 1))],
        "service_provider_id int, issuer string, service_provider_name string, agency_name string, launch_date date, iaa_end_date date",
    )
    metrics = spark.createDataFrame([(1, 20260301, 7), (1, 20260201, 8)], "start_service_provider_id int, period_date_id int, n int")
    table = partner.MetricTable(metrics, "start_service_provider_id", "period_date_id", ["n"])
    joined = partner.partner_rows(providers, [table], partner.Period(20260301, "2026-03-01"), day)
    assert rows(joined, "issuer", "n", "period_date_id") == [("one", 7, 20260301), ("two", None, 20260301)]
    only = partner.partner_rows(providers, [table], partner.Period(20260301, "2026-03-01"), day, excluded=["two"])
    assert rows(only, "issuer") == [("one",)]


def test_partner_idv(spark):
    zeros = ", ".join(f"{n} AS {f}" for n, f in enumerate(OUTCOME_DETAILS))
    outcomes = spark.sql(
        f"SELECT id AS start_service_provider_id, '2026-03-01' AS month_start_date_actual, m AS month_start_calendar_id, {zeros} "
        "FROM VALUES (1, 20260301), (1, 20260201), (2, 20260301) AS x(id, m)"
    )
    providers = spark.sql("SELECT 1 AS service_provider_id, 'one' AS issuer, 'One' AS service_provider_name, 'A' AS agency_name")
    got = partner_idv.partner_idv_rows(outcomes, providers, 1, 20260301)
    assert got.count() == 1 and len(got.columns) == 31
    assert json.loads(rows_as_json(got).first().document)["count_facial_mismatch"] == 1


def test_issuer_mapping(spark):
    data = [("a", "123"), ("a", "999"), ("b", "invalid_id"), ("b", "7"), ("c", None), ("  ", "5"), (None, "6"), ("d", "bad"), ("e", "123")]
    providers = spark.createDataFrame(data, "issuer string, id string")
    mapping = issuers.issuer_to_id(providers)
    assert rows(mapping) == [("a", 123), ("b", 7), ("e", 123)]
    assert rows(issuers.id_to_issuer(mapping)) == [(123, "a"), (7, "b")]
    assert rows(issuers.mapping_issues(providers)) == [(6, 2, 1)]


def test_provider_files(spark):
    providers = spark.createDataFrame([(9,)], "service_provider_id int")
    end = dt.date(2025, 9, 30)
    closed = provider_files(providers, "age_metrics", end, dt.date(2025, 10, 1), "Rep", F.lit("Q32025"), env="dev")
    assert rows(closed, "path") == [
        ("dev/idp/Rep/9/quarterly/Q32025/SP9_20251001_external_age_metrics.csv",),
        ("dev/idp/Rep/9/quarterly/Q32025/latest_SP9_age_metrics.csv",),
        ("dev/idp/Rep/9/quarterly/Q32025/latest_external_SP9_age_metrics.csv",),
    ]
    running = provider_files(providers, "age_metrics", end, end, "Rep", F.lit("Q32025"))
    assert rows(running) == [
        (9, False, "idp/Rep/9/quarterly/Q32025/SP9_20250930_internal_age_metrics.csv"),
        (9, False, "idp/Rep/9/quarterly/Q32025/latest_SP9_age_metrics.csv"),
    ]
