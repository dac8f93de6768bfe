from datetime import datetime, timedelta, timezone

import pytest

from clearfold.operators import monitors as M
from clearfold.settings import parse_now, run_id_of

NOW = parse_now("2026-02-10T14:35:00+00:00")


def by_name(checks):
    return {c["name"]: (c["status"], c["value"]) for c in checks.collect()}


def loads(spark, hours):
    rows = [(s, NOW - timedelta(hours=h)) for s, h in hours.items()]
    return spark.createDataFrame(rows, "source_type string, loaded_at timestamp")


def test_clock():
    assert run_id_of(NOW) == "2026-02-10T14:35"
    assert parse_now("2026-02-10T14:35:00") == NOW
    assert parse_now("2026-02-10T16:35:00+02:00") == NOW


def test_freshness_thresholds_are_inclusive(spark):
    got = by_name(M.check_freshness(loads(spark, {"a": 0, "b": 1.99, "c": 2, "d": 4, "e": 17}), NOW))
    assert got["freshness[a]"] == ("PASS", 0.0) and got["freshness[b]"][0] == "PASS"
    assert got["freshness[c]"] == ("WARN", 2.0)
    assert got["freshness[d]"] == ("PAGE", 4.0) and got["freshness[e]"] == ("PAGE", 17.0)


def test_freshness_per_source(spark):
    slas = spark.createDataFrame([("a", 24.0), ("b", 1.0)], "source_type string, sla_hours double")
    got = by_name(M.check_freshness(loads(spark, {"a": 5, "b": 1, "c": 5}), NOW, slas=slas))
    assert [got[f"freshness[{s}]"][0] for s in "abc"] == ["PASS", "PAGE", "PAGE"]


def test_volume_warns_in_both_directions(spark):
    schema = "source_type string, n_rows bigint"
    counts = spark.createDataFrame([("a", 13), ("b", 120), ("c", 119), ("d", 5), ("e", 0), ("f", 5)], schema)
    base = spark.createDataFrame([("a", 18), ("b", 100), ("c", 100), ("d", 0), ("e", 4)], schema)
    checks = {c["name"]: c for c in M.check_volume(counts, base).collect()}
    assert {n: c["status"] for n, c in checks.items()} == {
        "volume[a]": "WARN",
        "volume[b]": "WARN",
        "volume[c]": "PASS",
        "volume[d]": "PASS",
        "volume[e]": "WARN",
        "volume[f]": "PASS",
    }
    assert checks["volume[d]"]["detail"] == checks["volume[f]"]["detail"] == "no baseline yet"
    assert checks["volume[a]"]["detail"] == "baseline=18 change=-27.8%" and checks["volume[a]"]["value"] == 13


SCHEMA = "doc_id string, effective_date string, content string"


def test_distribution(spark):
    rows = [("a", "2026-01-01", "x"), ("b", "", "xé"), ("b", None, "x�x"), ("c", "y", "xxxxxx")]
    got = {c["name"]: c for c in M.check_distribution(spark.createDataFrame(rows, SCHEMA)).collect()}
    rate = got["null_rate[effective_date]"]
    assert (rate["status"], rate["value"], rate["detail"]) == ("WARN", 50.0, "2/4 rows null")
    # even count: the mean of the middle two, cut to an integer
    assert got["content_length"]["detail"] == "min=1 median=2 max=6"
    assert got["cardinality[doc_id]"]["value"] == 3
    assert (got["ocr_noise"]["status"], got["ocr_noise"]["value"]) == ("WARN", 1)


@pytest.mark.parametrize(("undated", "status"), [(0, "PASS"), (1, "WARN")])
def test_null_rate_threshold_and_quiet_noise(spark, undated, status):
    rows = [("a", None if i < undated else "2026-01-01", "x") for i in range(10)]
    got = by_name(M.check_distribution(spark.createDataFrame(rows, SCHEMA)))
    assert got["null_rate[effective_date]"][0] == status and "ocr_noise" not in got


def test_empty_batch_is_one_warning(spark):
    checks = M.check_distribution(spark.createDataFrame([], SCHEMA)).collect()
    assert [(c["name"], c["status"], c["value"]) for c in checks] == [("null_rate[effective_date]", "WARN", None)]


def test_schema(spark):
    rows = spark.createDataFrame([], SCHEMA)
    drifted = M.check_schema(rows).first()
    assert drifted["status"] == "PAGE"
    assert drifted["detail"] == "missing: ocr_confidence, source_type, source_uri, title, version"
    assert M.check_schema(rows, ["doc_id"]).first()["status"] == "PASS"


def test_json_schema(spark):
    rows = spark.createDataFrame([('{"a": 1, "z": 2}',), ('{"b": null}',), ("broken",), (None,)], "j string")
    drift = M.json_drift(rows, "j", ["b", "a"])
    assert {r["key"]: (r["n_missing"], r["n_rows"]) for r in drift.collect()} == {"a": (3, 4), "b": (3, 4)}
    check = M.check_json_schema(drift).first()
    assert (check["status"], check["detail"]) == ("PAGE", "missing: a, b")
    assert M.check_json_schema(M.json_drift(rows.limit(1), "j", ["a"])).first()["detail"] == "stable"


def test_worst_status(spark):
    checks = M.check_freshness(loads(spark, {"a": 0, "b": 3}), NOW)
    assert M.worst_status(checks).first()["worst"] == "WARN"
    assert M.worst_status(checks.limit(0)).first()["worst"] == "PASS"
    paged = M.check_freshness(loads(spark, {"a": 0, "b": 5, "c": 3}), NOW)
    assert M.worst_status(paged).first()["worst"] == "PAGE"


def test_low_ocr_tier(spark):
    rows = spark.createDataFrame([(0.59,), (0.6,), (0.84,), (0.85,)], "ocr_confidence double")
    check = M.check_low_ocr(rows).first()
    assert (check["status"], check["value"]) == ("WARN", 2)


def test_naive_clock_is_utc():
    assert parse_now("2024-01-31").tzinfo is timezone.utc
    assert datetime(2024, 1, 31, tzinfo=timezone.utc) == parse_now("2024-01-31")


def test_never_loaded_source_pages(spark):
    loads = spark.createDataFrame([("a", None), ("b", parse_now("2026-01-01T01:00"))], "source_type string, loaded_at timestamp")
    found = {r.name: (r.status, r.value) for r in M.check_freshness(loads, parse_now("2026-01-01T02:00")).collect()}
    assert found == {"freshness[a]": ("PAGE", None), "freshness[b]": ("PASS", 1.0)}


def test_hours_do_not_depend_on_the_session_zone(spark):
    before = spark.conf.get("spark.sql.session.timeZone")
    found = []
    try:
        for zone in ("UTC", "America/Los_Angeles"):
            spark.conf.set("spark.sql.session.timeZone", zone)
            loads = spark.sql(
                "SELECT 'ntz' AS source_type, timestamp_ntz'2026-01-01 10:00:00' AS loaded_at UNION ALL "
                "SELECT 'day', CAST(date'2026-01-01' AS timestamp_ntz)"
            )
            zoned = spark.sql("SELECT 'z' AS source_type, timestamp'2026-01-01T10:00:00Z' AS loaded_at")
            now = parse_now("2026-01-01T12:00:00+00:00")
            rows = [*M.check_freshness(loads, now).collect(), *M.check_freshness(zoned, now).collect()]
            found.append(sorted((r.name, r.value) for r in rows))
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    assert found[0] == found[1] == [("freshness[day]", 12.0), ("freshness[ntz]", 2.0), ("freshness[z]", 2.0)]
