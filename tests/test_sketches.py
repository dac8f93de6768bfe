from clearfold.operators import monitors, sketches
from clearfold.plans.run import run
from clearfold.settings import parse_now
from clearfold.sources import readers, tables
from tests.corpus import write_sources

SCHEMA = "doc_id string, source_type string, effective_date string, content string"


def _rows(spark, n, of):
    return spark.range(n).selectExpr(
        f"concat('k', id % {of}) AS doc_id", "if(id % 3 = 0, 'file', 'jira') AS source_type",
        "'2026-01-01' AS effective_date", "repeat('x', int(id % 1000)) AS content",
    )


def test_merged_sketches_tell_the_whole(spark):
    parts = [sketches.of_sources(_rows(spark, n, 20_000)) for n in (30_000, 50_000, 10)]
    got = sketches.estimates(parts[0].unionByName(parts[1]).unionByName(parts[2])).first()
    assert (got.n_rows, got.min_length, got.max_length) == (80_010, 0, 999)
    assert abs(got.doc_ids - 20_000) <= 20_000 * sketches.KEYS_WITHIN
    assert abs(got.median_length - 500) <= 1000 * sketches.RANK_WITHIN
    by = {r.source_type: r.n_rows for r in sketches.estimates(parts[0], "source_type").collect()}
    assert by == {"file": 10_000, "jira": 20_000}


def test_sketches_do_not_grow_with_the_rows(spark):
    size = [
        sum(len(r["keys"]) + len(r["lengths"]) for r in sketches.of_sources(_rows(spark, n, n)).collect())
        for n in (40_000, 400_000)
    ]
    assert size[1] < 1.2 * size[0] < 60_000


def test_nothing_and_nulls(spark):
    none = sketches.estimates(sketches.of_sources(spark.createDataFrame([], SCHEMA))).first()
    assert tuple(none) == (0, None, None, None, 0)
    nulls = spark.createDataFrame([(None, None, None, None), ("a", None, None, "xyz")], SCHEMA)
    got = sketches.estimates(sketches.of_sources(nulls)).first()
    assert (got.n_rows, got.min_length, got.max_length, got.doc_ids) == (2, 0, 3, 1)
    empty = spark.createDataFrame([], SCHEMA)
    checks = monitors.check_distribution(empty, estimated=sketches.estimates(sketches.of_sources(empty)))
    assert [(c.status, c.detail) for c in checks.collect()] == [("WARN", "empty batch")]


def test_a_run_with_sketches(spark, tmp_path):
    folder = write_sources(tmp_path)
    by_source = {"file": readers.read_documents(spark, f"{folder}/documents.csv")}
    now = parse_now("2026-02-10T14:35:00+00:00")
    found = []
    for approximate in (False, True):
        done = run(spark, by_source, f"{tmp_path}/t{approximate}", now, approximate=approximate)
        checks = tables.read(spark, f"{tmp_path}/t{approximate}", "checks", done.run_id, done.attempt)
        found.append({c.name: (c.status, c.value, c.detail.removeprefix("about ")) for c in checks.collect()})
    assert found[0] == found[1]
