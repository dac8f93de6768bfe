import random
import re

from clearfold.llm import quality

PROSE = "the ship of the line and the men of the sea went to the isle in a storm and it is said that the wind was high "


def base(text):
    text = text or ""
    words = [w for w in re.split(r"[\x20\x09-\x0D]+", text) if w]
    windows = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    covered = {k + j for k, w in enumerate(windows) if windows.count(w) > 1 for j in range(5)} if len(windows) < 3000 else set()
    lines = [line for line in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", line)]
    n = len(words)
    return (n, sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)),
            len(covered), n < 10 or 100 * len(covered) > 20 * n)


def rows(docs):
    return {r["doc_id"]: r for r in quality.quality(docs).collect()}


def test_base_columns(docs_of):
    texts = [
        "a b c d e a b c d e f g h i j k", "line one here\nline one here\n \n \nlast", "x " * 30, "# * é | <b> 字 plain words go on and on",
        "one two three four", "", None, PROSE * 2, "a b c d e x a b c d e y a b c d e",
    ]
    found = rows(docs_of(texts))
    for i, text in enumerate(texts):
        assert tuple(found[i])[1:7] == base(text), text


def test_divergent_texts_are_rejected(docs_of):
    rng = random.Random(6)
    own = [f"{rng.choice('bcdfgh')}{a}{rng.choice('lmnrst')}{b}" for a in "aeiou" for b in "aeiou"]
    prose = [" ".join(rng.choice((PROSE.split(), own)[k % 2]) for k in range(120)) for _ in range(30)]
    shouted = " ".join(f"{w.upper()}!!{i}" for i, w in enumerate((PROSE * 4).split()))
    digits = " ".join(str(10**9 + 7 * i) for i in range(90))
    found = rows(docs_of([*prose, shouted, digits, "1 2 3 4 5 6 7 8 9 10 11 12"]))
    assert all(found[i]["kept"] for i in range(30))
    assert not found[30]["kept"] and not found[31]["kept"] and not found[30]["base_failed"]
    assert found[32]["kept"] and found[32]["class_distance"] is None


def test_texts_without_common_words_are_rejected(docs_of):
    rng = random.Random(7)
    letters = "abcdefghijklmnopqrstuvwxyz"
    own = ["".join(rng.choices(letters, k=6)) for _ in range(4000)]
    common = ["the", "of", "and", "to", "in", "is", "it", "was", "on", "for"]
    prose = [" ".join(rng.choice(common) if rng.random() < 0.165 else rng.choice(own) for _ in range(150)) for _ in range(80)]
    gibberish = [" ".join("".join(rng.choices(letters, k=6)) for _ in range(200)) for _ in range(4)]
    found = rows(docs_of([*prose, *gibberish]))
    assert all(found[i]["kept"] for i in range(80))
    for i in range(80, 84):
        assert not found[i]["kept"] and not found[i]["base_failed"] and found[i]["word_distance"] <= 0.31


def test_gibberish_of_any_length_is_rejected_also_alone_in_a_language(spark):
    rng = random.Random(9)
    own = ["".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=6)) for _ in range(4000)]
    common = ["the", "of", "and", "to", "in", "is", "it", "was", "on", "for"]
    prose = [" ".join(rng.choice(common) if rng.random() < 0.165 else rng.choice(own[:80] if rng.random() < 0.2 else own)
                      for _ in range(150)) for _ in range(80)]
    consonants = {(lang, n): " ".join("".join(rng.choices("bcdfghjklmnpqrstvwxz", k=6)) for _ in range(n))
                  for lang in ("en", "zz", "yy", None) for n in (60, 120, 400)}
    swapped = [" ".join(w[::-1] for w in prose[0].split())]
    docs = [(t, "en") for t in prose] + [(t, lang) for (lang, _), t in consonants.items()] + [(swapped[0], "xx")]
    found = rows(spark.createDataFrame([(i, *d) for i, d in enumerate(docs)], "doc_id long, text string, lang string"))
    assert all(found[i]["kept"] for i in range(80))
    for i, key in enumerate(consonants, 80):
        assert not found[i]["kept"] and not found[i]["base_failed"], key
        assert (found[i]["missing"] is None) == (key[0] != "en")
    assert found[len(docs) - 1]["kept"]


def test_texts_without_spaces_between_words_are_not_held_against_a_small_language(spark):
    text = " ".join(chr(0x4E00 + 7 * k) * 20 for k in range(70))
    (row,) = quality.quality(spark.createDataFrame([(1, text, "zh")], "doc_id long, text string, lang string")).collect()
    assert row["kept"] and row["missing"] is None


def test_smaller_languages_have_references_of_their_own(spark):
    rng = random.Random(8)

    def texts(letters, seed, n):
        words = ["".join(random.Random(f"{seed} {k}").choices(letters, k=5)) for k in range(500)]
        return [" ".join(rng.choice(words[:8] if rng.random() < 0.17 else words) for _ in range(90)) for _ in range(n)]

    latin, greek, cyrillic = "abcdefghijklmnop", "αβγδεζηθικλμνξοπ", "абвгдежзиклмнопр"
    docs = [(t, f"l{k:02}") for k in range(16) for t in texts(latin, k, 14)]
    docs += [(t, "el") for t in texts(greek, "el", 13)] + [(t, "ru") for t in texts(cyrillic, "ru", 12)]
    docs += [(t, "uk") for t in texts(cyrillic, "uk", 3)] + [(" ".join(str(10**9 + 7 * i) for i in range(90)), "ru")]
    frame = spark.createDataFrame([(i, *d) for i, d in enumerate(docs)], "doc_id long, text string, lang string")
    found = rows(frame)
    assert len(found) == len(docs)
    for i, (_, lang) in enumerate(docs[:-1]):
        assert found[i]["kept"], lang
        assert (found[i]["class_distance"] is None) == (lang == "uk")
    assert not found[len(docs) - 1]["kept"] and not found[len(docs) - 1]["base_failed"]


def test_odd_rows(odd):
    found = quality.quality(odd).collect()
    assert len(found) == 8
    assert all(r["base_failed"] and not r["kept"] for r in found)
    long = next(r for r in found if r["doc_id"] == 4)
    assert (long["n_words"], long["n_repeat_words"]) == (60_000, 60_000)


def test_empty_table(docs_of):
    assert quality.quality(docs_of([])).count() == 0
