import random

from clearfold.llm import chat

KIND = "pair_id long, turn long, role string, text string"


def test_prefix_and_masks(spark):
    shared = [(1, 0, "system", "s"), (1, 1, "user", "hello")]
    chosen = spark.createDataFrame([*shared, (1, 2, "assistant", "yes"), (2, 0, "user", "same")], KIND)
    rejected = spark.createDataFrame([*shared, (1, 2, "assistant", "no!"), (1, 3, "user", "x"), (2, 0, "user", "same")], KIND)
    rows = sorted(map(tuple, chat.format_preferences(chosen, rejected).collect()))
    head = len("<|im_start|>assistant\n")
    assert [r[:4] for r in rows] == [
        (1, "chosen", 2, "assistant"), (1, "prompt", 0, "system"), (1, "prompt", 1, "user"),
        (1, "rejected", 2, "assistant"), (1, "rejected", 3, "user"), (2, "prompt", 0, "user"),
    ]
    assert rows[0][4] == "<|im_start|>assistant\nyes<|im_end|>\n"
    assert rows[0][5:] == (0, head + 14, head, head + 13)
    assert rows[2][5] == rows[1][6]
    assert rows[4][5] == rows[3][6] and rows[4][7:] == (None, None)
    assert rows[1][7] is None


def test_offsets_over_blocks(spark, monkeypatch):
    monkeypatch.setattr(chat, "TURNS_PER_BLOCK", 3)
    turns = [(7, t, "user", "x" * t) for t in range(0, 40, 2)]
    rows = chat.format_preferences(spark.createDataFrame(turns, KIND), spark.createDataFrame([], KIND)).collect()
    end = 0
    for r in sorted(rows, key=lambda r: r["turn"]):
        assert (r["part"], r["start"]) == ("chosen", end)
        end += r["length"]


def test_odd_conversations(spark):
    rows = [
        (2, 0, "user", "hi", 1), (2, 1, "assistant", "a", 1), (2, 1, "assistant", "b", 2), (2, 2, "user", None, 3),
        (3, 0, "user", "hi", 1), (3, 0, "user", "hi", 1), (3, 1, None, "?", 1), (3, 2, "assistant", "c", 1),
        (5, 0, "user", "no answer", 1), (8, 0, "assistant", "alone", 1), (None, 0, "user", "x", 1), (9, None, "user", "x", 1),
    ]
    table = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, part int")
    chosen, rejected = chat.with_other_end(chat.turns_of(table))
    assert sorted(map(tuple, chosen.where("pair_id = 2").collect())) == [
        (2, 0, "user", "hi"), (2, 1, "assistant", "a"), (2, 2, "user", ""),
    ]
    assert sorted(map(tuple, rejected.where("pair_id = 2").collect())) == [(2, 0, "user", "hi"), (2, 1, "assistant", "c")]
    assert {r["pair_id"] for r in chosen.collect()} == {2, 3, 5, 8}
    parts = {(r["pair_id"], r["part"]) for r in chat.format_preferences(chosen, rejected).collect()}
    both = {(p, k) for p in (2, 3) for k in ("prompt", "chosen", "rejected")}
    assert parts == both | {(8, "chosen"), (5, "prompt")}
    assert chat.format_preferences(*chat.with_other_end(chat.turns_of(table.limit(0)))).count() == 0


def test_every_turn_is_in_a_row_and_completions_have_several(spark):
    rng = random.Random(3)
    rows = []
    for conv in range(60):
        words = rng.choices(["a", "b", "x" * 200_000 if conv == 7 else "c"], k=rng.randint(1, 9))
        rows += [(conv, t, rng.choice(["system", "user", "assistant"]), w) for t, w in enumerate(words)]
    turns = chat.turns_of(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"))
    found = chat.format_preferences(*chat.with_other_end(turns)).collect()
    said = {(r["pair_id"], r["turn"]): r["rendered"] for r in found if r["part"] != "rejected"}
    assert said == {(c, t): f"<|im_start|>{role}\n{text}<|im_end|>\n" for c, t, role, text in rows}

    by_conv = {c: [r[1:] for r in rows if r[0] == c] for c in range(60)}
    for conv, own in by_conv.items():
        pivots = {}
        for c in (conv, conv ^ 1):
            places = [t for t, role, _ in by_conv[c] if role == "assistant"]
            pivots[c] = None if not places else places[0] if c // 2 % 2 == 0 else places[-1]
        mine, its = pivots[conv], pivots[conv ^ 1]
        rejected = own if mine is None else own[:mine]
        if mine is not None and its is not None:
            rejected = rejected + [(mine + t - its, role, text) for t, role, text in by_conv[conv ^ 1][its:]]
        same = 0
        while same < min(len(own), len(rejected)) and own[same] == rejected[same]:
            same += 1
        parts = {k: sorted((r["turn"], r["role"]) for r in found if (r["pair_id"], r["part"]) == (conv, k)) for k in ("prompt", "chosen", "rejected")}
        assert parts == {k: [(t, r) for t, r, _ in v] for k, v in (("prompt", own[:same]), ("chosen", own[same:]), ("rejected", rejected[same:]))}
    counts = {n for c in by_conv if (n := sum(r["pair_id"] == c and r["part"] == "chosen" for r in found))}
    assert max(counts) > 2
