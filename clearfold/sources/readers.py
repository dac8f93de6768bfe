"""Scans of the three source formats onto canonical records.

Large files are read by many tasks, also CSV whose cells hold line breaks and JSON arrays (`spans`).
Where no cell does, multi_line=False saves two shuffles, as JSON lines do.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from clearfold.schema import ORDER_COLUMN
from clearfold.settings import SOURCES
from clearfold.sources import spans
from clearfold.sources.canonical import SOURCE_STRIDE, canonicalise

# Column names of the source files.
ISSUE_KEYS_READ = ["key", "summary", "updated", "description"]


def _no_text():
    return F.lit(None).cast("string")


def positioned(rows: DataFrame, source: str, within: Column | None = None) -> DataFrame:
    """Rows of a scan with their input position: files by path, splits by place, then row order.

    `within` is a row's place in its file where a row is a file. The ranks of the splits are taken
    from a pass that reads no column.
    """
    within = F.monotonically_increasing_id() if within is None else within
    placed = rows.select(
        "*",
        F.col("_metadata.file_path").alias("_file"),
        F.col("_metadata.file_block_start").alias("_split"),
        within.alias("_at"),
    )
    splits = placed.groupBy("_file", "_split").agg(F.min("_at").alias("_first"))
    in_order = Window.orderBy("_file", "_split")
    ranked = splits.withColumn("_rank", F.row_number().over(in_order) - 1)
    position = F.col("_rank").cast("bigint") * F.lit(1 << 33) + F.col("_at") - F.col("_first")
    joined = placed.join(ranked, ["_file", "_split"])
    seq = F.lit(SOURCES.index(source) * SOURCE_STRIDE) + position
    return joined.withColumn(ORDER_COLUMN, seq).select(ORDER_COLUMN, *rows.columns)


def _spanning(spark: SparkSession, path: str | list[str], marks: spans.Marks, source: str) -> DataFrame:
    """Records that span pieces, with their input position: files by path, then by number."""
    found = spans.records(spark, path, marks)
    place = F.col("rank") * F.lit(1 << 33) + F.col("number")
    return found.withColumn(ORDER_COLUMN, F.lit(SOURCES.index(source) * SOURCE_STRIDE) + place)


def _csv(spark: SparkSession, path: str | list[str], multi_line: bool, source: str) -> DataFrame:
    """All columns as text, named by the header, which is one line; quotes are doubled inside quoted
    cells, and one that does not begin its cell is plain text. Empty cells are nulls, empty lines no
    records.

    A file whose header differs from the others' is an error, not read by place.
    """
    options = {"header": True, "quote": '"', "escape": '"', "encoding": "UTF-8"}
    scan = spark.read.options(**options, enforceSchema=False)
    if not multi_line:
        return positioned(scan.csv(path), source)
    names = scan.csv(path).columns
    cells = [f"c{i}" for i in range(len(names))]
    line = F.regexp_replace("record", "\\r$", "")
    parsed = F.from_csv(line, ", ".join(f"{c} string" for c in cells), {"quote": '"', "escape": '"', "multiLine": "true"})
    rows = _spanning(spark, path, spans.csv_marks(), source).where(line != "").withColumn("row", parsed)
    given = F.array(*(F.coalesce(f"row.{c}", F.lit(n)) for c, n in zip(cells, names)))
    same = given == F.array(*map(F.lit, names))
    other = F.raise_error(F.concat(F.lit("another header: "), "record")).cast("boolean")
    data = rows.where(F.when(F.col("number") > 1, True).when(same, False).otherwise(other))
    return data.select(ORDER_COLUMN, *(F.col(f"row.{c}").alias(n) for c, n in zip(cells, names)))


def read_tickets(spark: SparkSession, path: str | list[str], multi_line: bool = True) -> DataFrame:
    mapping = {
        "doc_id": "ticket_id",
        "source_type": F.lit("postgres"),
        "source_uri": "source_uri",
        "title": "subject",
        "effective_date": "updated_at",
        "version": _no_text(),
        "ocr_confidence": F.lit(1.0),
        "content": "body",
    }
    return canonicalise(_csv(spark, path, multi_line, "postgres"), mapping)


def read_documents(spark: SparkSession, path: str | list[str], multi_line: bool = True) -> DataFrame:
    same = ["doc_id", "source_uri", "title", "effective_date", "version", "ocr_confidence", "content"]
    mapping = {c: c for c in same} | {"source_type": F.lit("file")}
    return canonicalise(_csv(spark, path, multi_line, "file"), mapping)


def _array_elements(records: DataFrame) -> DataFrame:
    """The objects of JSON arrays from what stands between the closing braces of these objects: an
    opening bracket or a comma, then the object; at last the closing bracket."""
    last, piece = r"^\s*(\[\s*)?\]\s*$", F.col("record")
    begin = F.when(F.col("number") == 1, F.rlike(piece, F.lit(r"^\s*\[\s*\{"))).otherwise(F.rlike(piece, F.lit(r"^\s*,\s*\{")))
    closed = F.rlike("end", F.lit(last))
    is_last = F.rlike(piece, F.lit(last))
    text = F.concat(F.regexp_replace(piece, r"^\s*[\[,]\s*", ""), F.lit("}"))
    unreadable = F.raise_error(F.lit("not a JSON array of issues"))
    parsed = F.coalesce(F.from_json(text, "map<string,string>"), unreadable.cast("map<string,string>"))
    fits = F.when(closed & is_last, False).when(closed & begin, True).otherwise(unreadable.cast("boolean"))
    return records.where(fits).select(ORDER_COLUMN, parsed.alias("issue"))


def read_issues(spark: SparkSession, path: str | list[str], lines: bool = False) -> DataFrame:
    """Issues from files holding one JSON array each or, with `lines`, one object per line.

    A key that an object lacks, and a file that is no JSON array, are errors rather than nulls.
    """
    if lines:
        texts = positioned(spark.read.text(path), "jira")
        found = texts.select(ORDER_COLUMN, F.from_json("value", "map<string,string>").alias("issue"))
    else:
        found = _array_elements(_spanning(spark, path, spans.json_marks(), "jira"))
    wanted = F.array(*(F.lit(k) for k in ISSUE_KEYS_READ))
    present = F.coalesce(F.map_keys("issue"), F.array().cast("array<string>"))
    missing = F.array_except(wanted, present)
    failed = F.raise_error(F.concat(F.lit("issue lacks "), F.array_join(missing, ", ")))
    checked = F.when(F.size(missing) == 0, F.col("issue")).otherwise(failed.cast("map<string,string>"))
    issues = found.withColumn("issue", checked).select(
        ORDER_COLUMN, *(F.element_at("issue", k).alias(k) for k in ISSUE_KEYS_READ)
    )
    mapping = {
        "doc_id": "key",
        "source_type": F.lit("jira"),
        "source_uri": F.concat(F.lit("jira/"), F.col("key")),
        "title": "summary",
        "effective_date": "updated",
        "version": _no_text(),
        "ocr_confidence": F.lit(1.0),
        "content": "description",
    }
    return canonicalise(issues, mapping)
