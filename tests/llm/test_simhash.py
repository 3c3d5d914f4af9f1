import numpy as np
import xxhash
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from tallyloom.llm import simhash
from tallyloom.llm.components import connected
from tallyloom.llm.queries_pairs import op1_simhash_near_dedup


def plain_print(text):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    grams = [b" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))]
    hashes = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_classes(prints, ids, distance=4):
    parent = list(range(len(prints)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    prints = np.array(prints, np.uint64)
    for i in range(len(prints)):
        for j in np.flatnonzero(np.bitwise_count(prints[i] ^ prints[:i]) <= distance):
            a, b = find(i), find(int(j))
            parent[max(a, b)] = min(a, b)
    groups = {}
    for i, d in enumerate(ids):
        groups.setdefault(find(i), []).append(d)
    return [min((x for x in groups[find(i)] if x is not None), default=None) for i in range(len(ids))]


def test_equals_brute_force(spark, folder, rows):
    ids, texts = zip(*rows)
    prints = [plain_print(t) for t in texts]
    got = {r[0]: (r[1], r[2]) for r in op1_simhash_near_dedup(spark, folder).collect()}
    assert got == {d: (f"{p:016x}", c) for d, p, c in zip(ids, prints, plain_classes(prints, ids))}


def test_dense_fingerprints(spark):
    """Chains, one large cloud of near prints, and far ones: no link is lost, and classes equal brute force."""
    draw = np.random.default_rng(3)
    centre = draw.integers(0, 2**63, dtype=np.uint64)
    cloud = [int(centre) ^ sum(1 << int(b) for b in draw.choice(12, draw.integers(0, 7), replace=False)) for _ in range(900)]
    chain = [(1 << i) - 1 << 20 for i in range(0, 40, 4)]
    prints = list(dict.fromkeys(cloud + chain + [int(x) for x in draw.integers(0, 2**63, 200, dtype=np.uint64)]))
    signed = [p - (1 << 64) if p >> 63 else p for p in prints]
    table = spark.createDataFrame([(s,) for s in signed], "fp bigint")
    roots = {r["node"]: r["root"] for r in connected(simhash.near_links(table, 4)).collect()}
    want = plain_classes(prints, list(range(len(prints))))
    mine = [roots.get(s, s) for s in signed]
    assert len(set(zip(mine, want))) == len(set(mine)) == len(set(want))


@settings(max_examples=60, deadline=None)
@given(st.integers(0, 2**64 - 1), st.sets(st.integers(0, 63), max_size=4))
def test_near_prints_share_a_key(value, flips):
    other = value ^ sum(1 << b for b in flips)

    def keys(x):
        out = set()
        for low, width in simhash._segments(4):
            part = x >> low & (1 << width) - 1
            out |= {(low + i, part & ~(1 << i)) for i in range(width)}
        return out

    assert keys(value) & keys(other)


def test_odd_rows(odd, empty):
    got = {(r["doc_id"], r["fp"] & (1 << 64) - 1, r["component_id"]) for r in simhash.near_classes(odd).collect()}
    texts = {r["doc_id"]: r["text"] for r in odd.collect()}
    assert {(d, p) for d, p, _ in got} == {(d, plain_print(t)) for d, t in texts.items()}
    by_id = {d: c for d, _, c in got}
    assert by_id[1] == by_id[2] == by_id[4] == 1 and by_id[6] == 5 and by_id[None] is None
    assert simhash.near_classes(empty).count() == 0


def test_one_of_each_class_stays(odd):
    kept = sorted(r["doc_id"] for r in simhash.near_deduplicated(odd).where("doc_id is not null").collect())
    assert kept == [1, 3, 5, 7, 8, 9, 10]
    assert simhash.near_deduplicated(odd).where(F.col("doc_id").isNull()).count() == 1


def test_components_of_chain_star_and_loop(spark):
    links = [(i, i + 1) for i in range(50)] + [(100, 100 + i) for i in range(1, 40)] + [(7, 7), (200, 201), (201, 200), (None, 3)]
    found = {r["node"]: r["root"] for r in connected(spark.createDataFrame(links, "a bigint, b bigint")).collect()}
    assert found == {i: 0 for i in range(51)} | {i: 100 for i in range(100, 140)} | {200: 200, 201: 200}
    assert connected(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


def test_rows_that_share_an_id_are_judged_alone(spark):
    """Id 5 names a copy of document 1 and a text of its own, id 6 two texts of one class."""
    own, twin = "an entirely different text about ships", "words that nobody else has ever written down here"
    rows = [(1, "the same words again and again"), (5, "the same words again and again"), (5, own), (6, twin), (6, twin + "\n"), (7, own)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    kept = sorted(tuple(r) for r in simhash.near_deduplicated(docs).collect())
    assert kept == [(1, rows[0][1]), (5, own), (6, twin)]
