"""Transducer counts and packing against the tokenizers library."""

import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer as Library

from tallyloom.llm import packing, tokens, transducer

BYTES, WORDS = (public_tokenizers.path(n) for n in ("byte_bpe_50k.json", "word_bpe_49k.json"))
HARD = ["", "a", " ", "   a", "a  b", "a \n b", "\n\na", "'re", "'r", "x'rex'll'l'v", "''s 's \n a's'", "1 22 333a4", "é'S 'RE", "日本語 テスト", "😀😀 a😀b",
        "Σίσυφος ΣΑΣ", "éé", "İst", "\t\t x", "a" * 700, " " * 300 + "x", "'", "\0a\0", "½ ² ³x", "ﬁ ǅ", "a<|endoftext|> b", "<|startoftext|><|endoftext|>"]


@pytest.fixture(scope="module", params=[BYTES, WORDS])
def both(request):
    return transducer.Tokenizer(request.param), Library.from_file(request.param)


def texts():
    draw = random.Random(5)
    letters = "ab'slrevtmd  \n\t1é!.ü☃"
    return HARD + ["".join(draw.choice(letters) for _ in range(draw.randint(1, 40))) for _ in range(1500)]


def test_equals_library(both):
    mine, library = both
    some = texts()
    want = [e.ids for e in library.encode_batch(some, add_special_tokens=False)]
    assert tokens.counted(mine, some).tolist() == [len(w) for w in want]
    assert [x.tolist() for x in tokens.encoded(mine, some)] == want


def test_real_texts_and_cut_ones(both, rows):
    mine, library = both
    some = [t for _, t in rows]
    want = [e.ids for e in library.encode_batch(some, add_special_tokens=False)]
    assert [x.tolist() for x in tokens.encoded(mine, some)] == want
    parts = [transducer.pieces(t, 300) for t in some]
    assert ["".join(p) for p in parts] == some and max(map(len, parts)) > 5
    assert [sum(tokens.counted(mine, p)) for p in parts] == [len(w) for w in want]


def test_states_are_bounded(monkeypatch, rows):
    """Emptying the machine in the middle of a text changes no count."""
    monkeypatch.setattr(transducer, "MAX_STATES", 300)
    mine, library = transducer.Tokenizer(BYTES), Library.from_file(BYTES)
    some = [t for _, t in rows[:40]]
    assert tokens.counted(mine, some).tolist() == [len(e.ids) for e in library.encode_batch(some, add_special_tokens=False)]


def test_queries_equal_library(spark, folder, rows):
    from tallyloom.llm.queries_text import op6_token_counts, op10_best_fit_packing

    some = [t for _, t in rows]
    want = [len(e.ids) for e in Library.from_file(BYTES).encode_batch(some, add_special_tokens=False)]
    got = {r["doc_id"]: tuple(r)[1:] for r in op6_token_counts(spark, folder).collect()}
    assert got == {d: (len(t.encode()), n, n > 1024) for (d, t), n in zip(rows, want)}
    ids = [e.ids + [1] for e in Library.from_file(WORDS).encode_batch(some, add_special_tokens=False)]
    pieces = {(d, k): (at, len(x[at : at + 4096]), zlib.crc32(np.array(x[at : at + 4096], "<u4").tobytes()))
              for (d, _), x in zip(rows, ids) for k, at in enumerate(range(0, len(x), 4096))}
    found = op10_best_fit_packing(spark, folder).collect()
    assert {(r["doc_id"], r["piece"]): (r["start"], r["length"], r["ids_crc32"]) for r in found} == pieces
    check_bins(found, 4096)
    assert len({r["sequence_id"] for r in found}) <= 1 + -(-sum(map(len, ids)) // 4096)


def check_bins(rows, capacity):
    bins = {}
    for r in sorted(rows, key=lambda r: (r["sequence_id"], r["offset"])):
        assert bins.setdefault(r["sequence_id"], 0) == r["offset"]
        bins[r["sequence_id"]] += r["length"]
    assert max(bins.values(), default=0) <= capacity
    return bins


def test_odd_rows(spark, odd, empty):
    library = Library.from_file(BYTES)
    want = sorted((r["doc_id"] or -1, len((r["text"] or "").encode()), len(library.encode(r["text"] or "", add_special_tokens=False).ids)) for r in odd.collect())
    assert sorted((r["doc_id"] or -1, r["n_bytes"], r["n_tokens"]) for r in tokens.token_counts(odd, BYTES).collect()) == want
    found = packing.pack_documents(odd, WORDS, capacity=64, group_rows=3).collect()
    check_bins(found, 64)
    assert {r["doc_id"] for r in found} == {r["doc_id"] for r in odd.collect()}
    ids = tokens.token_pieces(odd, WORDS, 64, with_ids=True).where("doc_id = 5").collect()
    assert ids[0]["ids"] == Library.from_file(WORDS).encode("The cat sat on the mat, and the dog did not.").ids + [1]
    assert tokens.token_counts(empty, BYTES).count() == packing.pack_documents(empty, WORDS).count() == 0


@pytest.mark.parametrize("rule", ["norm", "dot"])
def test_every_constraint_holds(rule):
    draw = np.random.default_rng(2)
    lengths = draw.integers(1, 400, 700)
    for pieces, cost in ((4096, 1024.0**2), (3, 1024.0**2), (4096, 250_000.0)):
        bins, offsets = packing.best_fit(lengths, 1024, pieces, cost, rule=rule)
        for b in np.unique(bins):
            here = np.flatnonzero(bins == b)
            here = here[np.argsort(offsets[here])]
            assert (offsets[here] == np.r_[0, np.cumsum(lengths[here])[:-1]]).all()
            assert lengths[here].sum() <= 1024 and len(here) <= pieces and (lengths[here].astype(float) ** 2).sum() <= cost
        least = max(lengths.sum() / 1024, len(lengths) / pieces, (lengths.astype(float) ** 2).sum() / cost)
        assert len(np.unique(bins)) <= 1.12 * least + 1
    with pytest.raises(ValueError):
        packing.best_fit(np.array([2000]), 1024, 5, 1e9)
