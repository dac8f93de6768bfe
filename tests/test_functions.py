import re
import unicodedata
from collections import Counter

import pytest
from pyspark.sql import functions as F

from clearfold.functions import dates, text, vectors


@pytest.fixture(scope="module")
def code_points(spark):
    """Every code point but surrogates, and U+FEFF, which the decoder takes for a byte-order mark."""
    ids = spark.range(1, 0x110000).where("not (id between 55296 and 57343) and id != 65279")
    char = F.decode(F.unhex(F.lpad(F.hex("id"), 8, "0")), "utf-32")
    return ids.select(F.col("id").cast("int").alias("cp"), char.alias("c"))


def test_nfc_on_every_code_point(code_points):
    c = F.col("c")
    pair = F.concat(F.lit("e"), c)
    rows = code_points.select(
        "cp", text.nfc(c).alias("n"), text.nfc(pair).alias("p"), c.rlike(text.NFC_SUSPECT).alias("s")
    ).collect()
    for r in rows:
        ch = chr(r.cp)
        assert r.n == unicodedata.normalize("NFC", ch), hex(r.cp)
        assert r.p == unicodedata.normalize("NFC", "e" + ch), hex(r.cp)
        if not r.s:
            assert not unicodedata.combining(ch) and unicodedata.is_normalized("NFC", ch)


def test_blanks_on_every_code_point(code_points):
    around = F.concat(F.col("c"), F.lit("a"), F.col("c"), F.lit(" b"), F.col("c"))
    rows = code_points.select(
        "cp", text.collapse_blanks(around).alias("w"), text.strip_blanks(around).alias("s")
    ).collect()
    for r in rows:
        given = f"{chr(r.cp)}a{chr(r.cp)} b{chr(r.cp)}"
        assert r.w == re.sub(r"\s+", " ", given).strip(), hex(r.cp)
        assert r.s == given.strip(), hex(r.cp)


def test_nfc_keeps_null_and_composes_words(spark):
    words = ["Quy tri\u0300nh", "ng\u00e0y", None, "", "\u1100\u1161\u11a8", "a\u0302\u0323", "\u212b"]
    got = spark.createDataFrame([(w,) for w in words], "w string").select(text.nfc(F.col("w"))).collect()
    assert [r[0] for r in got] == [w and unicodedata.normalize("NFC", w) for w in words]


DAYS = {
    "2026-02-07": "2026-02-07",
    "2026-1-5": "2026-01-05",
    "07/02/2026": "2026-02-07",
    "7/2/26": "2026-02-07",
    "07/02/75": "1975-02-07",
    "07/02/68": "2068-02-07",
    "07/02/69": "1969-02-07",
    "2026/02/07": "2026-02-07",
    " 2026-02-07\u3000": "2026-02-07",
    "31/12/1999\n": "1999-12-31",
    "29/02/24": "2024-02-29",
    "29/02/00": "2000-02-29",
}
NO_DAYS = ["2026-13-45", "2026-02-30", "29/02/23", "0000-01-01", "026-1-1", "+2026-01-01", "2026-00-01"]
NO_DAYS += ["soon", "2026-02-07T10:00", "1/1/1", "01-02-2026", "2026/02-07", "00/01/2026"]


def test_dates(spark):
    cases = {raw: (day, "ok") for raw, day in DAYS.items()}
    cases |= {raw: (raw, "invalid") for raw in NO_DAYS}
    cases |= {raw: (None, "missing") for raw in ("", "  ", "\u00a0", None)}
    raw = F.col("v")
    rows = (
        spark.createDataFrame([(v,) for v in cases], "v string")
        .select("v", dates.parse_date(raw).alias("p"))
        .select("v", dates.normalised_date(raw, F.col("p")), dates.date_status(raw, F.col("p")))
        .collect()
    )
    assert {r[0]: (r[1], r[2]) for r in rows} == cases


def test_calendar_dates(spark):
    real = ["2026-02-07", "2026-1-5"]
    cases = real + ["07/02/26", "2026/02/07", " 2026-02-07", "2026-02-07\n", None] + NO_DAYS
    got = spark.createDataFrame([(v,) for v in cases], "v string").select("v", dates.is_calendar_date(F.col("v")))
    assert [r[0] for r in got.collect() if r[1]] == real


def test_vectors_count_tokens(spark):
    texts = ["the cat, the dog_2 and the Élan", "", None, "!!", "a a a", "x² ngày 7 NGÀY"]
    rows = (
        spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
        .select("i", vectors.term_vector(F.col("t")).alias("v"))
        .select("i", "v.terms", "v.counts", vectors.norm(F.col("v.counts")).alias("n"))
        .orderBy("i")
        .collect()
    )
    for r, t in zip(rows, texts):
        counts = Counter(re.findall(r"\w+", (t or "").lower()))
        assert dict(zip(r.terms, r.counts)) == counts
        assert r.n == sum(v * v for v in counts.values()) ** 0.5


def test_content_hash_is_plain_sha256(spark):
    import hashlib

    row = spark.createDataFrame([("file", "12", "hoàn tiền")], "s string, d string, c string")
    got = row.select(text.content_hash(F.col("s"), F.col("d"), F.col("c"))).first()[0]
    assert got == hashlib.sha256("file|12|hoàn tiền".encode()).hexdigest()[:16]
