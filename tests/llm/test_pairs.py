"""Top-k search, preference pairs, winnowed fingerprints against brute force."""

import hashlib
import math
import re

import numpy as np
import xxhash
from pyspark.sql import functions as F

from tallyloom.llm import preference, topk, winnow
from tallyloom.llm.queries_pairs import op9_document_fingerprints


def plain_top(rows, queries, k):
    """Lists of (row number, id, vector) against all other rows, repeats included."""
    out = []
    for row, q, qv in queries:
        scored = sorted((-sum(a * b for a, b in zip(qv, v)), i) for r, i, v in rows if r != row and len(v) == len(qv))
        out += [(q, place + 1, i, -s) for place, (s, i) in enumerate(scored[:k])]
    return sorted(out)


def numbered(rows):
    return [(place + 7, i, v) for place, (i, v) in enumerate(rows)]


VECTORS = "row_id bigint, vec_id bigint, comps array<bigint>"


def test_top_k_with_ties_and_signs(spark, monkeypatch):
    monkeypatch.setattr(topk, "CHUNK", 40)
    monkeypatch.setattr(topk, "QUERY_BLOCK", 7)
    draw = np.random.default_rng(5)
    rows = [(i, draw.integers(-3, 4, 6).tolist()) for i in range(300)] + [(1000 + i, [1, 2]) for i in range(3)] + [(2000, [5])]
    rows += [rows[20], rows[20], (20, [3] * 6), (30, [-1] * 6), (31, rows[30][1])]  # ids and whole rows that repeat
    rows = numbered(rows)
    table = spark.createDataFrame(rows, VECTORS)
    queries = [r for r in rows if r[1] % 10 == 0]
    for k, parts in ((1, 1), (5, 4), (7, 3)):
        found = sorted(tuple(r) for r in topk.top_k(table.where("vec_id % 10 = 0"), table, k, parts).collect())
        assert found == plain_top(rows, queries, k)


def test_top_k_of_one_id_that_holds_most_rows(spark, monkeypatch):
    monkeypatch.setattr(topk, "CHUNK", 16)
    rows = numbered([(50, [i % 5, 1]) for i in range(120)] + [(51, [9, 9]), (51, [9, 9])])
    table = spark.createDataFrame(rows, VECTORS)
    found = sorted(tuple(r) for r in topk.top_k(table.where("vec_id % 50 = 0"), table, 3, 2).collect())
    assert found == plain_top(rows, [r for r in rows if r[1] == 50], 3)


def test_copies_of_the_queries_are_never_a_side_of_a_join(spark, monkeypatch):
    """One copy for every chunk: joined, they look small before they are copied and are broadcast from the driver."""
    monkeypatch.setattr(topk, "CHUNK", 8)
    monkeypatch.setattr(topk, "QUERY_BLOCK", 5)
    rows = numbered([(i, [i % 7, -i]) for i in range(200)])
    table = spark.createDataFrame(rows, VECTORS)
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch", None)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "3")  # a chunk comes in several batches
    try:
        best = topk.top_k(table.where("vec_id % 10 = 0"), table, 3, 2)
        assert sorted(tuple(r) for r in best.collect()) == plain_top(rows, [r for r in rows if r[1] % 10 == 0], 3)
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch") if before is None else spark.conf.set(
            "spark.sql.execution.arrow.maxRecordsPerBatch", before)
    assert "Join" not in best._jdf.queryExecution().executedPlan().toString()


def test_quantised_leaves_out_unsound_vectors(spark):
    rows = [(1, [0.5, -0.001]), (2, None), (3, [1.0, None]), (4, [float("nan"), 0.0]), (5, [float("inf"), 0.0]), (None, [1.0]),
            (6, [0.25]), (6, [0.5]), (6, [0.5]), (7, [])]
    made = topk.quantised(spark.createDataFrame(rows, "vec_id bigint, embedding array<float>"))
    found = made.collect()
    assert sorted((r["vec_id"], r["comps"]) for r in found) == [(1, [128, -1]), (6, [64]), (6, [128]), (6, [128]), (7, [])]
    assert len({r["row_id"] for r in found}) == 5
    none = topk.quantised(spark.createDataFrame([], "vec_id bigint, embedding array<float>"))
    assert topk.top_k(none, none).count() == 0


def test_quantised_among_columns_of_the_same_names(spark):
    rows = [(1, [0.5], 3, "x"), (50, [0.25], None, "y")]
    table = topk.quantised(spark.createDataFrame(rows, "vec_id bigint, embedding array<float>, row_id bigint, comps string"))
    found = topk.top_k(table.where("vec_id % 50 = 0"), table).collect()
    assert [tuple(r) for r in found] == [(50, 1, 1, 128 * 64)]


def test_large_scores_are_whole_numbers(spark):
    table = spark.createDataFrame(numbered([(i, [2**40 + i, -(2**41)]) for i in range(4)]), VECTORS)
    small = spark.createDataFrame([(1, 9, [1, 1])], VECTORS)
    assert {tuple(r) for r in topk.top_k(small, table, 2, 2).collect()} == {(9, 1, 3, 2**40 + 3 - 2**41), (9, 2, 2, 2**40 + 2 - 2**41)}


def test_fingerprints_of_odd_rows(spark, odd, empty):
    follow = winnow.with_next(odd.select("doc_id", "text"), "doc_id", ["text"], winnow.with_fingerprint, ("prints",))
    found = follow.select("doc_id", "text", winnow.hashes_of(F.col("prints")).alias("h")).collect()
    assert len(found) == odd.count()
    assert all(r["h"] == [h for h, _ in plain_prints(r["text"])] for r in found)
    assert winnow.with_fingerprint(odd).columns == [*odd.columns, "prints"]
    assert winnow.with_fingerprint(empty).count() == 0


def test_preference_pairs(spark):
    rows = [(0, 0, "user", "hi"), (0, 1, "assistant", "yes"), (0, 2, "user", "and?"), (0, 3, "assistant", "good"),
            (1, 0, "user", "hi"), (1, 1, "assistant", "yes"), (1, 2, "user", "and?"), (1, 3, "assistant", None),
            (2, 0, None, "lone"), (None, 0, "user", "lost"), (4, 0, "user", "same"), (5, 0, "user", "same"),
            (6, None, "user", "b"), (6, None, "user", "a"), (6, 1, "assistant", "é😀"), (7, 0, "user", "c")]
    conv = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string")
    side = F.when(F.col("conv_id") % 2 == 0, "chosen").otherwise("rejected")
    pairs = preference.preference_pairs(preference.turns(conv, F.floor(F.col("conv_id") / 2).cast("bigint"), side))
    found = {r["pair_id"]: r for r in pairs.collect()}
    assert set(found) == {0, 1, 2, 3}
    one = found[0]
    assert one["n_prompt_turns"] == 3 and one["prompt"].count("<|end|>") == 3
    assert one["chosen"] == "<|assistant|>\ngood<|end|>\n" and one["rejected"] == "<|assistant|>\n<|end|>\n"
    (span,) = one["chosen_spans"]
    assert one["chosen"][span["start"] : span["stop"]] == "good"
    assert found[1]["n_prompt_turns"] == 0 and found[1]["rejected"] == "" and found[1]["chosen"].startswith("<|unknown|>")
    assert found[2]["n_prompt_turns"] == 1 and found[2]["chosen"] == found[2]["rejected"] == "" and found[2]["chosen_spans"] == []
    three = found[3]
    assert three["chosen"].startswith("<|user|>\na<|end|>\n<|user|>\nb") and three["n_prompt_turns"] == 0
    assert [three["chosen"][s["start"] : s["stop"]] for s in three["chosen_spans"]] == ["é😀"]
    assert preference.preference_pairs(preference.turns(conv.limit(0), F.col("conv_id"), side)).count() == 0


def plain_prints(text, k=winnow.K, w=winnow.W):
    hashes = [xxhash.xxh64_intdigest(x.encode(), 42) for x in re.findall(winnow.UNITS, text or "")]

    def gram(part):
        h = 42
        for x in part:
            h = xxhash.xxh64_intdigest(x.to_bytes(8, "little"), h)
        return h >> 32

    grams = [gram(hashes[max(0, i - k + 1) : i + 1]) for i in range(len(hashes))]
    out = []
    for i in range(len(grams) + w - 1 if grams else 0):
        first = max(0, i - w + 1)
        window = grams[first : i + 1]
        at = max(j for j, g in enumerate(window) if g == min(window)) + first
        if (grams[at], at) not in out:
            out.append((grams[at], at))
    return out


def test_edits_of_short_and_unspaced_texts_stay_near(spark):
    texts = ["abcdefgh", "ab cd ef", "a b c d e f g h", "国破山河在城春草木深", "สวัสดีชาวโลกทุกคน", "x" * 9, "one two three four five six seven",
             "感时花溅泪恨别鸟惊心" * 160, "word " * 400, "\U00020000\U00020001" * 10]
    pairs = [(i, t, t[: len(t) - len(t) // 4] + "#" * (len(t) // 4)) for i, t in enumerate(texts)]
    table = winnow.with_fingerprint(spark.createDataFrame(pairs, "i int, text string, changed string"))
    both = winnow.with_fingerprint(table, "changed", "other")
    rows = both.select("i", winnow.likeness(winnow.hashes_of(F.col("prints")), winnow.hashes_of(F.col("other"))).alias("near"),
                       F.size("prints").alias("n")).collect()
    assert len(rows) == len(texts) and all(0 < r["near"] < 1 for r in rows)
    assert {r["i"]: r["n"] for r in rows}[7] > 100


def test_long_shared_part_is_found_anywhere(spark):
    shared = "the quick brown fox jumps over the lazy dog and runs far away from home"
    texts = [("a", f"something else first. {shared} and then more"), ("b", f"very different start, yes! {shared}")]
    rows = winnow.with_fingerprint(spark.createDataFrame(texts, "i string, text string")).select(
        "i", winnow.hashes_of(F.col("prints")).alias("h")).collect()
    # each of the windows that lie side by side inside the shared part keeps a gram of its own
    windows = (len(re.findall(winnow.UNITS, shared)) - winnow.K + 1) // winnow.W
    assert windows == 2 and len(set(rows[0]["h"]) & set(rows[1]["h"])) >= windows


def test_fingerprints_equal_brute_force(spark, folder, rows):
    got = {r["doc_id"]: r for r in op9_document_fingerprints(spark, folder).collect()}
    assert len(got) == len(rows)
    texts = [t for _, t in rows]
    after = texts[1:] + texts[:1]
    for (doc, text), following in zip(rows, after):
        cut = len(text) // 4
        changed = text[: len(text) - cut] + following[:cut]
        own, other, nxt = ([h for h, _ in plain_prints(t)] for t in (text, changed, following))
        r = got[doc]
        assert r["edited_sha256"] == hashlib.sha256(changed.encode()).hexdigest() and r["n_chars"] == len(text)
        assert r["fingerprint"] == "".join(f"{h:08x}" for h in own) and r["edited_fingerprint"] == "".join(f"{h:08x}" for h in other)
        alike = lambda a, b: len(set(a) & set(b)) / len(set(a) | set(b)) if a or b else 1.0
        assert math.isclose(r["near_edited"], alike(own, other)) and math.isclose(r["near_next"], alike(own, nxt))


def test_places_and_match_guarantee(spark):
    shared = " ".join(f"s{i}" for i in range(winnow.W + winnow.K - 1))
    texts = [f"a b c {shared} d e", f"{shared} zz", "x x x x x x x x x x x x x x x x x x x x x x x x x x x", "one two", "", None]
    table = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, text string")
    found = {r["i"]: list(zip(r["h"], r["at"])) for r in winnow.with_fingerprint(table).select(
        "i", winnow.hashes_of(F.col("prints")).alias("h"), winnow.places_of(F.col("prints")).alias("at")).collect()}
    for i, t in enumerate(texts):
        assert found[i] == plain_prints(t)
    assert {h for h, _ in found[0]} & {h for h, _ in found[1]}


def test_next_row_over_many_ranges(spark):
    for ids in ([5], [3, 1], [None, 2, 2, 9], list(range(0, 900, 3)), [1] * 40 + [2]):
        table = spark.createDataFrame([(d, f"t{i:03}") for i, d in enumerate(ids)], "doc_id bigint, text string")
        got = {(r["doc_id"], r["text"], r["next_text"]) for r in winnow.with_next(table, "doc_id", ["text"], per_bucket=10).collect()}
        order = sorted(((-1 if d is None else d, f"t{i:03}", d) for i, d in enumerate(ids)))
        assert got == {(d, t, order[(i + 1) % len(order)][1]) for i, (_, t, d) in enumerate(order)}
    none = spark.createDataFrame([], "doc_id bigint, text string")
    assert winnow.with_next(none, "doc_id", ["text"]).count() == 0


def test_no_python_on_the_native_path(spark, folder):
    from tallyloom.llm.queries_pairs import op2_preference_format

    for query in (op2_preference_format, op9_document_fingerprints):
        plan = query(spark, folder)._jdf.queryExecution().executedPlan().toString()
        assert not re.search("Python|Arrow|Pandas", plan)
