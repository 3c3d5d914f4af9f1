"""MinHash near-duplicates against brute-force Jaccard."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyloom.llm import forest
from tallyloom.llm.queries_pairs import op12_minhash_near_dedup


def plain_set(text, shingle=2):
    words = (text or "").encode().lower().split()
    return frozenset(tuple(words[i : i + shingle]) for i in range(max(1, len(words) - shingle + 1))) if words else frozenset()


def plain_classes(rows, limit=80, shingle=2):
    """``(id, size, smallest id reachable)`` per row."""
    sets, roots = [plain_set(t, shingle) for _, t in rows], list(range(len(rows)))

    def root(i):
        while roots[i] != i:
            roots[i] = i = roots[roots[i]]
        return i

    order = sorted((i for i in range(len(rows)) if sets[i]), key=lambda i: len(sets[i]))
    for at, i in enumerate(order):
        for j in order[at + 1 :]:
            a, b = sets[i], sets[j]
            if 100 * len(a) < limit * len(b):
                break
            if root(i) != root(j) and 100 * (both := len(a & b)) >= limit * (len(a) + len(b) - both):
                roots[root(i)] = root(j)
    groups = {}
    for i, (d, _) in enumerate(rows):
        groups.setdefault(root(i), []).append(d)
    return sorted((repr(d), len(sets[i]), min((x for x in groups[root(i)] if x is not None), default=None)) for i, (d, _) in enumerate(rows))


def found(classes):
    return sorted((repr(r["doc_id"]), r["n_shingles"], r["component_id"]) for r in classes.collect())


@pytest.mark.parametrize("scale", ["0.001", "0.01"])
def test_whole_table(spark, scale):
    folder = f"/root/testdata/sf{scale}"
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()]
    out = op12_minhash_near_dedup(spark, folder)
    assert found(out) == plain_classes(rows)
    assert out.where("kept <> (doc_id = component_id)").count() == 0


def test_families_chains_and_short_texts(spark):
    """A large family, two that nearly touch, a chain, texts of 0 to 6 words, and one very common word pair."""
    draw, texts = random.Random(8), []
    vocabulary = [f"w{i}" for i in range(4000)]

    def changed(words, times):
        words = [*words]
        for _ in range(times):
            words[draw.randrange(len(words))] = draw.choice(vocabulary)
        return words

    base = draw.choices(vocabulary, k=80)
    texts += [changed(base, draw.randrange(1, 9)) for _ in range(500)]
    other = changed(base, 11)
    texts += [changed(other, draw.randrange(0, 3)) for _ in range(60)]
    link = draw.choices(vocabulary, k=60)
    for _ in range(30):
        texts.append(link := changed(link, 3))
    texts += [draw.choices("abc", k=draw.randrange(0, 7)) for _ in range(300)]
    texts += [["the", "most", *draw.choices(vocabulary, k=draw.randrange(0, 8))] for _ in range(300)]
    rows = [(i, " ".join(t)) for i, t in enumerate(texts)]
    draw.shuffle(rows)
    table = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(6)
    assert found(forest.near_classes(table)) == plain_classes(rows)


def test_other_parameters(spark):
    draw = random.Random(3)
    texts = [[f"v{draw.randrange(30)}" for _ in range(40)] for _ in range(40)]
    texts += [[*t[:20], f"v{draw.randrange(30)}", *t[21:]] for t in texts]
    rows = [(i, " ".join(t)) for i, t in enumerate(texts)]
    table = spark.createDataFrame(rows, "doc_id bigint, text string")
    assert found(forest.near_classes(table, limit=0.9, shingle=3)) == plain_classes(rows, 90, 3)


def test_odd_rows(odd, empty):
    rows = [(r["doc_id"], r["text"]) for r in odd.collect()]
    assert found(forest.near_classes(odd)) == plain_classes(rows)
    assert forest.near_classes(empty).count() == 0


def test_signature_estimates_similarity():
    draw = np.random.default_rng(1)
    values = draw.integers(0, 2**63, 1000, dtype=np.uint64)
    a, b = forest.signature(values[:900]), forest.signature(values[100:])
    assert abs((a == b).mean() - 0.8) < 0.1 and (a == forest.signature(values[:900][::-1])).all()


def test_links_do_not_depend_on_the_layout(spark, docs):
    one, two = (found(forest.near_classes(docs.repartition(n).orderBy(F.rand(n)))) for n in (1, 13))
    assert one == two
