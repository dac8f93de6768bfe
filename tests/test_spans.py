"""Files read in many splits against the one-task readers of Spark and Python."""

import json
import random

import pytest
from pyspark.sql import functions as F

from clearfold.sources import readers

CELLS = ["", "a", 'say "x"', "two\nlines", "a,b", '"', '""', ',"', '",\n"', "\n", "\n\n", "ü" * 9, "x" * 40, '"\n,"', "end\r\nhere"]
HEAD = ["ticket_id", "source_uri", "subject", "updated_at", "priority", "status", "body"]


@pytest.fixture
def small_splits(spark):
    keep = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    for k in keep:
        spark.conf.set(k, "293")
    yield
    for k, v in keep.items():
        spark.conf.set(k, v)


def _quoted(cell: str) -> str:
    return '"' + cell.replace('"', '""') + '"'


def _csv(seed: int, n: int) -> tuple[list[list[str]], str]:
    rng = random.Random(seed)
    rows = [[f"{seed}-{i}", *rng.choices(CELLS, k=6)] for i in range(n)]
    plain = lambda c: c and rng.random() < 0.5 and not set(c) & set('",\n\r')
    text = "\n".join(",".join(c if plain(c) else _quoted(c) for c in r) for r in rows)
    return rows, ",".join(HEAD) + "\n" + text + ("\n" if seed % 2 else "")


def test_csv_equals_the_one_task_read_at_any_split(spark, tmp_path, small_splits):
    planted = []
    for seed in range(3):
        rows, text = _csv(seed, 60)
        planted += rows
        (tmp_path / f"{seed}.csv").write_bytes(text.encode())
    got = readers._csv(spark, str(tmp_path), True, "postgres")
    assert spark.read.text(str(tmp_path), lineSep="\n").rdd.getNumPartitions() > 15
    found = [list(r)[1:] for r in got.orderBy("ingest_seq").collect()]
    assert found == [[c or None for c in r] for r in planted]
    whole = spark.read.options(header=True, multiLine=True, quote='"', escape='"').csv(str(tmp_path))
    assert sorted(map(str, map(tuple, whole.collect()))) == sorted(map(str, map(tuple, found)))


def test_plain_quotes_empty_lines_short_rows_and_line_ends(spark, tmp_path, small_splits):
    lines = [",".join(HEAD), '1,u,5" pipe,d,p,o,"in ""two""', 'lines"', "", '2,u,a"b"c,d,p,o,x', "3,u", '4,u,"s",d,p,o,y']
    (tmp_path / "t.csv").write_bytes(b"\xef\xbb\xbf" + "\r\n".join(lines).encode() + b"\r\n")
    got = readers._csv(spark, f"{tmp_path}/t.csv", True, "postgres").orderBy("ingest_seq").collect()
    assert [(r.ticket_id, r.subject, r.body) for r in got] == [
        ("1", '5" pipe', 'in "two"\r\nlines'), ("2", 'a"b"c', "x"), ("3", None, None), ("4", "s", "y"),
    ]


def test_an_empty_table(spark, tmp_path):
    (tmp_path / "t.csv").write_text(",".join(HEAD) + "\n")
    assert readers.read_tickets(spark, f"{tmp_path}/t.csv").count() == 0
    (tmp_path / "i.json").write_text(" [ ]\n")
    assert readers.read_issues(spark, f"{tmp_path}/i.json").count() == 0


TEXTS = ["", "a", '"', "}", "{", "{}", '\\', '\\"', '"}', "},{", "]", "[{", "\n}", "x" * 50, "é }", None]


@pytest.mark.parametrize("indent", [None, 2])
def test_arrays_equal_the_whole_parse_at_any_split(spark, tmp_path, small_splits, indent):
    rng, planted = random.Random(7), []
    for name in "ab":
        issues = [
            {"key": f"{name}{i}", "summary": rng.choice(TEXTS), "updated": rng.choice(TEXTS),
             "fields": {"deep": [{"t": rng.choice(TEXTS)}, {}]}, "description": rng.choice(TEXTS)}
            for i in range(70)
        ]
        planted += issues
        (tmp_path / f"{name}.json").write_text(json.dumps(issues, indent=indent, ensure_ascii=name == "a"))
    got = readers.read_issues(spark, str(tmp_path)).orderBy("ingest_seq").collect()
    assert [(r.doc_id, r.title, r.effective_date, r.content) for r in got] == [
        (i["key"], i["summary"], i["updated"], i["description"] or "") for i in planted
    ]
    assert spark.read.text(str(tmp_path), lineSep="}").rdd.getNumPartitions() > 15


WHOLE = '{"key": "a", "summary": "s", "updated": "u", "description": "d"}'


@pytest.mark.parametrize(
    "text", [f"[{WHOLE}", f"[{WHOLE} {WHOLE}]", f"[{WHOLE}][{WHOLE}]", f"[1, {WHOLE}]", f"[{WHOLE}, 1]", "[1]", f"[{WHOLE}]]"]
)
def test_what_is_no_array_of_objects_is_an_error(spark, tmp_path, text):
    (tmp_path / "i.json").write_text(text)
    with pytest.raises(Exception, match="not a JSON array"):
        readers.read_issues(spark, f"{tmp_path}/i.json").agg(F.count("content")).collect()
