import collections
import hashlib
import random

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st

from tallyloom.llm import repeats


def plain(texts, length):
    """Kept bytes and covered ranges by brute force."""
    seen = collections.Counter(t[i : i + length] for t in texts for i in range(len(t) - length + 1))
    out = []
    for t in texts:
        bad = np.zeros(len(t), bool)
        for i in range(len(t) - length + 1):
            if seen[t[i : i + length]] > 1:
                bad[i : i + length] = True
        runs = int((np.diff(np.r_[0, bad.astype(np.int8)]) == 1).sum())
        out.append((bytes(np.frombuffer(t, np.uint8)[~bad]), int(bad.sum()), runs))
    return out


def checked(spark, texts, length, **options):
    table = spark.createDataFrame([(i, bytearray(t)) for i, t in enumerate(texts)], "doc_id bigint, text binary")
    marked = repeats.with_row_id(table)
    spans = repeats.repeated_spans(marked, length, **options)
    rows = marked.select("doc_id", "_rid", marked.text.alias("_bytes")).join(spans, "_rid", "left")
    got = {r["doc_id"]: (bytes(r["kept"]), r["n_removed"], r["n_spans"]) for r in repeats._apply(rows, ["doc_id"], True).collect()}
    assert [got[i] for i in range(len(texts))] == plain(texts, length)


def made(draw, passages, copies=2):
    """Texts of random letters with shared passages in many contexts, cut at either end."""
    letters = b"abcd \xc3\xa9"
    junk = lambda n: bytes(draw.choice(letters) for _ in range(n))
    shared = [junk(n) for n in passages]
    out = []
    for _ in range(40):
        text = junk(draw.randint(0, 90))
        for p in draw.sample(shared, draw.randint(0, copies)):
            low = draw.choice([0, 0, 3, 11])
            text += p[low : len(p) - draw.choice([0, 0, 1, 9])] + junk(draw.randint(0, 60))
        out.append(text)
    return out + [b"", b"z" * 300, b"xy" * 120, out[3]]


@pytest.mark.parametrize("bucket", [4096, 3])
def test_equals_brute_force(spark, bucket):
    draw = random.Random(bucket)
    for length, gram, passages in ((40, 10, (39, 40, 41, 60, 120)), (64, 20, (63, 70, 200, 100))):
        checked(spark, made(draw, passages), length, gram=gram, bucket=bucket)


def test_long_texts_in_parts(spark, monkeypatch):
    monkeypatch.setattr(repeats, "_PART", 150)
    monkeypatch.setattr(repeats, "_LOT", 400)
    checked(spark, made(random.Random(9), (50, 90, 300)), 40, gram=10)


def test_query_equals_brute_force(spark, folder, rows):
    from tallyloom.llm.queries_text import op8_suffix_array_dedup

    want = plain([t.encode() for _, t in rows], 200)
    got = {r["doc_id"]: tuple(r)[1:] for r in op8_suffix_array_dedup(spark, folder).collect()}
    assert got == {d: (len(t.encode()), n, runs, hashlib.sha256(kept).hexdigest()) for (d, t), (kept, n, runs) in zip(rows, want)}


def test_odd_rows(spark, odd, empty):
    got = sorted((r["doc_id"] or -1, r["n_bytes"], r["n_removed"]) for r in repeats.without_repeats(odd).collect())
    long = [(8, 30_000, 30_000), (9, 20_000, 20_000), (9, 20_000, 20_000)]
    want = [(r["doc_id"] or -1, len((r["text"] or "").encode()), 0) for r in odd.collect() if r["doc_id"] not in (8, 9)]
    assert got == sorted(want + long)
    assert repeats.without_repeats(empty).count() == 0
    assert repeats.deduplicated(odd).columns == odd.columns and repeats.deduplicated(odd).count() == odd.count()


def test_characters_are_not_cut(spark):
    shared = "é" * 150
    docs = spark.createDataFrame([(1, "a" + shared + "b", 152), (2, "c" + shared, 151)], "doc_id int, text string, n_chars bigint")
    assert sorted(tuple(r) for r in repeats.deduplicated(docs).collect()) == [(1, "ab", 2), (2, "c", 1)]


@settings(max_examples=80, deadline=None)
@given(st.lists(st.tuples(st.text("ab", max_size=6), st.text("ab", max_size=6)), min_size=2, max_size=9), st.integers(2, 6))
def test_maximal_repeats(contexts, length):
    """Every pair that shares ``length`` bytes around the place stands in a group, and groups share what they say."""
    lefts, rights = ([x.encode() for x in side] for side in zip(*contexts))
    groups = list(repeats.maximal_repeats(lefts, rights, length))
    for left, right, members in groups:
        assert len(members) > 1 and left + right >= length
        assert len({(lefts[m][:left], rights[m][:right]) for m in members}) == 1
    covered = repeats._covered(lefts, rights, length)
    for a in range(len(lefts)):
        pairs = [(repeats._common(lefts[a], lefts[b]), repeats._common(rights[a], rights[b])) for b in range(len(lefts)) if b != a]
        pairs = [(x, y) for x, y in pairs if x + y >= length]
        span = lambda found: (max((x for x, _ in found), default=-1), max((y for _, y in found), default=-1))
        assert span(covered[a]) == span(pairs)
