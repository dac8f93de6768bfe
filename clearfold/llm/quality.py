"""Quality rules by distribution divergence, in DataFrame functions alone.

A text's shares of character classes, and of the commonest words, are compared with those of each
language's texts taken together, by Jensen-Shannon distance; the nearest language counts. A language
needs a volume of words to be a reference. The largest languages' references are compared with every
document, those of all others, a table of any length, with the documents of their own language.
Distances hardly grow where common words are missing, so the share that the 200 commonest words
have of a text has a lower limit too, which each reference's own spread sets. In a language without a
reference, a text says itself what is common: one that hardly repeats a word is rejected. Texts too
short for a histogram to mean anything are judged by the base rules only.
"""

from __future__ import annotations

from dataclasses import dataclass
from string import ascii_lowercase, ascii_uppercase, digits, punctuation

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clearfold.llm.common import SPACES, WHITE, WORD, written

# Fixed values of the base rules.
SYMBOLS = "#*$%&|<>"
WINDOW = 5
MIN_WORDS = 10
MAX_REPEAT_PERCENT = 20


@dataclass(frozen=True)
class Limits:
    """`languages`: how many, the largest, are references for all documents; `common`: words in each
    reference's histogram; `frequent`: words whose total share is compared; `min_reference_words`: of a
    language, to be a reference at all; `max_missing`: how many deviations of a reference's documents a
    text's share of frequent words may lie below the reference's. Where the language has no reference:
    `min_repeated`, the least share of words that occur before in the text, for texts whose words have
    `max_mean_word` characters or fewer on average (others have no spaces between words)."""

    languages: int = 16
    common: int = 10
    max_class_distance: float = 0.30
    max_word_distance: float = 0.31
    min_class_chars: int = 200
    min_histogram_words: int = 60
    min_reference_words: int = 1000
    frequent: int = 200
    max_missing: float = 3.5
    min_repeated: float = 0.01
    max_mean_word: int = 12


# Spreads are taken by medians, which junk does not move: by that of a normal deviation's size, from
# counts of deviations in hundredths, those of a hundred and more together.
MEDIAN_SIZE = 0.6745
BINS, LAST_BIN = 100, 10_000


# A class is written as one character that stands for all of its own.
CLASSES = {"a": ascii_lowercase, "A": ascii_uppercase, "0": digits, "#": SYMBOLS, " ": WHITE,
           ".": "".join(c for c in punctuation if c not in SYMBOLS)}


def _language() -> Column:
    return F.coalesce(F.col("lang"), F.lit(""))


def _text() -> Column:
    return F.coalesce(F.col("text"), F.lit(""))


def _words() -> Column:
    return F.array_remove(F.split(_text(), SPACES), "")


def _spaced(words: Column) -> Column:
    """One string with a space on both sides of every word."""
    return F.concat(F.lit(" "), F.array_join(words, "  "), F.lit(" "))


def _numbers(values: list[float]) -> Column:
    return F.array(*[F.lit(float(v)) for v in values])


@dataclass(frozen=True)
class Reference:
    """Commonest words with their shares, all frequent words, and the share these have together."""

    words: dict[str, float]
    frequent: list[str]
    share: float


def _references(docs: DataFrame, limits: Limits) -> tuple[dict[str, Reference], DataFrame | None]:
    """References of the largest languages that have enough words; and a table (lang, own_frequent,
    own_words, own_word_shares, own_share) of the others that have, None without any others.

    The share of frequent words is that in all words and one more, so that it stays below one."""
    counts = docs.select(_language().alias("lang"), F.explode(_words()).alias("word")).groupBy("lang", "word").count()
    counts = written(counts)
    totals = counts.groupBy("lang").agg(F.sum("count").alias("total")).where(F.col("total") >= limits.min_reference_words)
    largest = totals.orderBy(F.desc("total"), "lang").limit(limits.languages + 1).collect()
    more = len(largest) > limits.languages
    largest = {r["lang"]: r["total"] for r in largest[: limits.languages]}
    ranked = Window.partitionBy("lang").orderBy(F.desc("count"), "word")
    best = counts.withColumn("rank", F.row_number().over(ranked)).where(F.col("rank") <= limits.frequent)
    found: dict[str, list] = {lang: [] for lang in sorted(largest)}
    for r in best.where(F.col("lang").isin(list(largest))).orderBy("lang", "rank").collect():
        found[r["lang"]].append(r)
    out = {
        lang: Reference(
            {r["word"]: r["count"] / largest[lang] for r in rows[: limits.common]},
            [r["word"] for r in rows],
            sum(r["count"] for r in rows) / (largest[lang] + 1),
        )
        for lang, rows in found.items()
    }
    if not more:
        return out, None
    rows = best.join(totals.where(~F.col("lang").isin(list(largest))), "lang")
    rows = rows.groupBy("lang").agg(
        F.array_sort(F.collect_list(F.struct("rank", "word", (F.col("count") / F.col("total")).alias("share")))).alias("r"),
        (F.sum("count") / (F.first("total") + 1)).alias("own_share"),
    )
    first = F.slice("r", 1, limits.common)
    return out, written(rows.select(
        "lang", F.col("r.word").alias("own_frequent"), F.transform(first, lambda x: x["word"]).alias("own_words"),
        F.transform(first, lambda x: x["share"]).alias("own_word_shares"), "own_share",
    ))


def measures(docs: DataFrame, references: dict[str, Reference], others: DataFrame | None = None) -> DataFrame:
    """One narrow row per document: base columns, class counts, counts of each reference's words and of
    all its frequent ones; `own_counts` and `own_frequent_words`, of its own language's words where the
    language is one of `others`; `n_repeated`, of words that occur before, where it has no reference."""
    every = sorted({w for r in references.values() for w in r.words})
    any_frequent = sorted({w for r in references.values() for w in r.frequent})
    no_words = F.array().cast("array<string>")
    rows = docs.select("doc_id", _language().alias("lang"), _text().alias("text")).withColumn("words", _words())
    classed = F.translate("text", "".join(CLASSES.values()), "".join(k * len(v) for k, v in CLASSES.items()))
    lines = F.filter(F.split("text", "\n"), lambda line: line.rlike(WORD))
    if others is None:
        own_counts, own_frequent = F.lit(None).cast("array<double>"), F.lit(None).cast("int")
        unknown = ~F.col("lang").isin(list(references)) if references else F.lit(True)
    else:
        rows = rows.join(others.select("lang", "own_words", "own_frequent"), "lang", "left")
        rows = rows.withColumn("held", F.filter("words", lambda w: F.array_contains("own_frequent", w)))
        own_counts = F.transform("own_words", lambda o: F.size(F.filter("held", lambda w: w == o)).cast("double"))
        own_frequent = F.when(F.col("own_frequent").isNotNull(), F.size("held"))
        unknown = ~F.col("lang").isin(list(references)) & F.col("own_frequent").isNull()
    rows = rows.select(
        "doc_id", "lang", "words", own_counts.alias("own_counts"), own_frequent.alias("own_frequent_words"),
        unknown.alias("unknown"),
        F.length("text").alias("n_chars"),
        F.size("words").alias("n"),
        classed.alias("classed"),
        lines.alias("lines"),
        F.transform("words", lambda w: F.xxhash64(w)).alias("hashes"),
        (F.filter("words", lambda w: w.isin(any_frequent)) if any_frequent else no_words).alias("frequent"),
    ).withColumn("known", _spaced(F.filter("frequent", lambda w: w.isin(every)) if every else no_words))
    windows = F.transform(
        F.slice("hashes", F.lit(1), F.col("n") - WINDOW + 1),
        lambda h, i: F.xxhash64(h, *[F.get("hashes", i + k) for k in range(1, WINDOW)]),
    )
    rows = rows.withColumn("windows", F.when(F.col("n") >= WINDOW, windows))
    pairs = F.transform("windows", lambda h, i: F.struct(h.alias("h"), i.alias("i")))
    repeats = F.size("windows") > F.size(F.array_distinct("windows"))
    rows = rows.withColumn("sorted", F.when(repeats, F.array_sort(pairs)))

    def twice(pair: Column, k: Column) -> Column:
        same = pair["h"].eqNullSafe(F.get("sorted", k - 1)["h"]) | pair["h"].eqNullSafe(F.get("sorted", k + 1)["h"])
        return F.when(same, pair["i"])

    rows = rows.withColumn("places", F.array_sort(F.array_compact(F.transform("sorted", twice))))
    covered = F.transform(
        "places", lambda p, k: F.coalesce(F.least(F.get("places", k + 1) - p, F.lit(WINDOW)), F.lit(WINDOW))
    )
    n_repeat = F.coalesce(F.aggregate(covered, F.lit(0), lambda a, b: a + b), F.lit(0))

    def count(kind: str) -> Column:
        return F.col("n_chars") - F.length(F.replace("classed", F.lit(kind), F.lit("")))

    def occurs(word: str) -> Column:
        whole = f" {word} "
        without = F.replace("known", F.lit(whole), F.lit(""))
        return (F.octet_length("known") - F.octet_length(without)) / len(whole.encode())

    word_counts = [F.array(*map(occurs, r.words)) for r in references.values()]

    def among(own: list[str]) -> Column:
        return F.size(F.filter("frequent", lambda w: w.isin(own)))

    frequent = [among(r.frequent) for r in references.values()]
    none = F.array().cast("array<array<double>>")
    rows = rows.select(
        "doc_id", "lang", "n_chars", "own_counts", "own_frequent_words",
        F.col("n").cast("long").alias("n_words"),
        *[count(k).alias(f"class_{i}") for i, k in enumerate(CLASSES)],
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        n_repeat.cast("long").alias("n_repeat_words"),
        (F.array(*word_counts) if word_counts else none).alias("word_counts"),
        (F.array(*frequent) if frequent else F.array().cast("array<int>")).alias("frequent_words"),
        F.when(F.col("unknown"), F.col("n") - F.size(F.array_distinct("hashes"))).alias("n_repeated"),
    )
    named = [f"class_{i}" for i in range(len(CLASSES))]
    rest = F.col("n_chars") - sum((F.col(c) for c in named), F.lit(0))
    white, symbol = (f"class_{list(CLASSES).index(k)}" for k in " #")
    return rows.select(
        "doc_id", "lang", "n_words", "n_dup_lines", "n_repeat_words", "word_counts", "own_counts",
        "frequent_words", "own_frequent_words", "n_repeated",
        (F.col("n_chars") - F.col(white)).cast("long").alias("word_chars"),
        F.col(symbol).cast("long").alias("n_symbols"),
        F.array(*[F.col(c).cast("double") for c in named], rest.cast("double")).alias("class_counts"),
    )


def distance(p: Column, q: Column) -> Column:
    """Jensen-Shannon distance, in bits, of two arrays of shares."""

    def part(x: Column, mean: Column) -> Column:
        return F.when(x > 0, x * F.log2(x / mean)).otherwise(0.0)

    terms = F.zip_with(p, q, lambda a, b: part(a, (a + b) / 2) + part(b, (a + b) / 2))
    return F.sqrt(F.greatest(F.aggregate(terms, F.lit(0.0), lambda a, b: a + b) / 2, F.lit(0.0)))


def _shares(counts: Column, total: Column) -> Column:
    return F.transform(counts, lambda c: c / total)


def _total(counts: Column) -> Column:
    return F.aggregate(counts, F.lit(0.0), lambda a, b: a + b)


def _deviation(frequent: Column, share: Column) -> Column:
    """How far the share of frequent words lies from the reference's, in deviations of random draws;
    null for a text without words."""
    n = F.when(F.col("n_words") > 0, F.col("n_words"))
    return (frequent / n - share) / F.sqrt(share * (1 - share) / n)


def _spreads(rows: DataFrame, deviation: Column, name: str) -> DataFrame:
    """(lang, name): deviations of a language's documents, in those of random draws; at least one."""
    sized = rows.select("lang", F.least(F.floor(F.abs(deviation) * BINS), F.lit(LAST_BIN)).alias("bin"))
    bins = sized.where(F.col("bin").isNotNull()).groupBy("lang", "bin").count()
    own = Window.partitionBy("lang")
    upto = own.orderBy("bin").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    bins = bins.select("lang", "bin", F.sum("count").over(own).alias("every"), F.sum("count").over(upto).alias("some"))
    medians = bins.where(F.col("some") * 2 >= F.col("every")).groupBy("lang").agg(F.min("bin").alias("bin"))
    return medians.select("lang", F.greatest((F.col("bin") + 0.5) / BINS / MEDIAN_SIZE, F.lit(1.0)).alias(name))


def _word_distance(own: Column, shares: Column) -> Column:
    mine = _shares(F.concat(own, F.array(F.col("n_words") - _total(own))), F.col("n_words"))
    return distance(mine, F.concat(shares, F.array(1 - _total(shares))))


def quality(docs: DataFrame, limits: Limits = Limits()) -> DataFrame:
    """doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept, the two
    distances and `missing`, one row per row of `docs` (doc_id, text, lang).

    Null texts count as empty; both fail the base rules. `missing` says by how many deviations of its
    documents the nearest reference's share of frequent words exceeds the text's. Distances and `missing`
    are null below the lengths at which they count, and where the language has no reference. Null `lang`
    is a language of its own. Repeated rows are judged alike.
    """
    references, others = _references(docs, limits)
    rows = written(measures(docs, references, others))
    n_classes = len(CLASSES) + 1
    sums = [F.sum(F.col("class_counts")[i]).alias(f"c{i}") for i in range(n_classes)]
    long = F.col("n_words") >= limits.min_histogram_words

    chars = _total(F.col("class_counts"))
    deviations = {lang: _deviation(F.col("frequent_words")[k], F.lit(r.share)) for k, (lang, r) in enumerate(references.items())}
    main = F.col("lang").isin(list(references)) if references else F.lit(False)
    own = F.coalesce(*[F.when(F.col("lang") == lang, d) for lang, d in deviations.items()], F.lit(None).cast("double"))
    totals = {r["lang"]: r for r in rows.where(main).groupBy("lang").agg(*sums).collect()}
    spreads = {r["lang"]: r["spread"] for r in _spreads(rows.where(main & long), own, "spread").collect()}
    rows = rows.withColumn("class_shares", _shares(F.col("class_counts"), F.when(chars > 0, chars)))
    by_class, by_word, by_missing = [], [], []
    for k, (lang, reference) in enumerate(references.items()):
        counts = [totals[lang][f"c{i}"] for i in range(n_classes)]
        by_class.append(distance(F.col("class_shares"), _numbers([c / sum(counts) for c in counts])))
        by_word.append(_word_distance(F.col("word_counts")[k], _numbers(list(reference.words.values()))))
        by_missing.append(-deviations[lang] / spreads.get(lang, 1.0))
    judged = main
    if others is not None:
        rows = rows.join(others.select("lang", "own_word_shares", "own_share"), "lang", "left")
        deviation = _deviation(F.col("own_frequent_words"), F.col("own_share"))
        known = rows.where(F.col("own_share").isNotNull())
        every = F.array(*[F.col(f"c{i}") for i in range(n_classes)])
        shares = known.groupBy("lang").agg(*sums).select("lang", _shares(every, _total(every)).alias("own_class_shares"))
        own_spreads = _spreads(known.where(long), deviation, "own_spread")
        rows = rows.join(written(shares.join(own_spreads, "lang", "left")), "lang", "left")
        by_class.append(distance(F.col("class_shares"), F.col("own_class_shares")))
        by_word.append(_word_distance(F.col("own_counts"), F.col("own_word_shares")))
        by_missing.append(-deviation / F.coalesce("own_spread", F.lit(1.0)))
        judged = main | F.col("own_share").isNotNull()
    nowhere = F.lit(None).cast("double")
    nearest = [F.array_min(F.array(*some)) if some else nowhere for some in (by_class, by_word, by_missing)]
    rows = rows.withColumns({
        "class_distance": F.when(judged & (chars >= limits.min_class_chars), nearest[0]),
        "word_distance": F.when(judged & long, nearest[1]),
        "missing": F.when(judged & long, nearest[2]),
        "base_failed": (F.col("n_words") < MIN_WORDS)
        | (F.col("n_repeat_words") * 100 > F.col("n_words") * MAX_REPEAT_PERCENT),
    })
    near = (
        (F.coalesce(F.col("class_distance"), F.lit(0.0)) <= limits.max_class_distance)
        & (F.coalesce(F.col("word_distance"), F.lit(0.0)) <= limits.max_word_distance)
        & (F.coalesce(F.col("missing"), F.lit(0.0)) <= limits.max_missing)
    )
    spaced = F.col("word_chars") <= F.col("n_words") * limits.max_mean_word
    alone = long & spaced & (F.col("n_repeated") < F.col("n_words") * limits.min_repeated)
    near = F.when(judged, near).otherwise(~F.coalesce(alone, F.lit(False)))
    return rows.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
        (~F.col("base_failed") & near).alias("kept"), "class_distance", "word_distance", "missing",
    )
