import math

import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from tallyloom.functions import hashing
from tallyloom.operators import (
    features as ft, lookup, measures, ordered, recode, sampling, sequences as sq, stats, validity, vocabulary as vc,
)

FEW = settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])


def docs(spark, rows):
    return spark.createDataFrame(rows, "doc_id string, words array<string>")


# -- words ------------------------------------------------------------------------------

def test_presence_weight_ignores_copies_and_counts_all_words(spark):
    d = docs(spark, [("x", ["a", "a", "b"]), ("y", ["a"]), ("z", []), ("q", ["zz"])])
    terms = vc.dictionary(vc.term_counts(d), 2)
    got = {(r["doc_id"], r["pos"]): r["value"] for r in ft.positions(d, terms).collect()}
    assert got == {("x", 0): pytest.approx(1 / 3), ("x", 1): pytest.approx(1 / 3), ("y", 0): 1.0}
    counted = {(r["doc_id"], r["pos"]): r["value"] for r in ft.positions(d, terms, tf="count").collect()}
    assert counted[("x", 0)] == pytest.approx(2 / 3)


def test_idf_is_negative_for_a_word_in_every_document(spark):
    d = docs(spark, [("x", ["a", "b"]), ("y", ["a"])])
    terms = ft.training_dictionary(d, 10)
    value = {(r["doc_id"], r["pos"]): r["value"] for r in ft.training_weights(d, terms).collect()}
    assert value[("y", 0)] == pytest.approx(math.log(2 / 3)) and value[("x", 1)] == pytest.approx(0.0)


def test_term_statistics_match_two_level_counting(spark):
    d = docs(spark, [("x", ["b", "a", "a"]), ("y", ["a", "c", "c", "c"]), ("z", [])])
    got = {r["term"]: (r["n"], r["df"]) for r in vc.term_statistics(d).collect()}
    assert got == {"a": (3, 2), "b": (1, 1), "c": (3, 1)}


def test_dictionary_smaller_than_asked(spark):
    terms = vc.dictionary(vc.term_counts(docs(spark, [("x", ["b", "a", "b"])])), 20000)
    assert [(r["term"], r["pos"]) for r in terms.orderBy("pos").collect()] == [("b", 0), ("a", 1)]


def test_vocabularies_start_and_end(spark):
    counts = spark.createDataFrame([(f"w{i}", 10 - i) for i in range(6)], "term string, n long")
    assert {r["term"]: r["id"] for r in vc.tagger_vocabulary(counts, 4).collect()} == {"w0": 1, "w1": 2, "w2": 3}
    assert {r["term"]: r["id"] for r in vc.text_vocabulary(counts, 4).collect()} == {"w0": 2, "w1": 3}


def test_held_out_frequencies(spark):
    train = docs(spark, [("x", ["a", "b"]), ("y", ["a"])])
    test = docs(spark, [("p", ["a", "n"]), ("q", ["n"])])
    out = ft.scoring_features(test, ft.training_dictionary(train, 10)).collect()
    # one vectorised document, df 1: ln(1 / 2) / 2
    assert [(r["doc_id"], r["value"]) for r in out] == [("p", pytest.approx(math.log(0.5) / 2))]


def test_stem_before_stop_words(spark):
    d = vc.stem_documents(docs(spark, [("x", ["the", "does", "having", "cats"]), ("y", [])]))
    got = {r["doc_id"]: sorted(r["words"]) for r in d.collect()}
    assert got == {"x": ["cat", "doe"], "y": []}


# -- records ----------------------------------------------------------------------------

def test_parse_tagged_lines(spark):
    lines = spark.read.text("tests/fixtures/tagged.txt")
    got = {r["doc_id"]: r["body"] for r in recode.parse_tagged_line(lines).collect()}
    assert got == {"AU12": "The court held it. a a b ", "77": 'Plain "> text ', "5": "", None: None}


def test_valid_trips(spark):
    lines = spark.read.text("tests/fixtures/trips.csv")
    kept = validity.trip_features(validity.valid_trips(validity.split_fields(lines)))
    assert sorted(tuple(r) for r in kept.collect()) == [(1.0, 2.0, 1.0, 3.0, 0.5, 10.5), (1.0, 60.0, 50.0, 200.0, 0.0, 210.0)]


def test_number(spark):
    df = spark.createDataFrame([("1e3",), (" 2 ",), ("1d",), ("2.5F",), ("0x1p3",), ("inf",), ("-Infinity",), ("",), ("abc",)], "t string")
    assert [r[0] for r in df.select(validity.number("t")).collect()] == [
        1000.0, 2.0, None, None, None, math.inf, -math.inf, None, None]


def test_split_line_is_split_once(spark):
    lines = spark.read.text("tests/fixtures/trips.csv")
    plan = validity.valid_trips(validity.split_fields(lines))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("split(value") == 1


def test_class_prefix(spark):
    df = spark.createDataFrame([("AD1",), ("AU2",), ("77",), ("A",)], "i string")
    assert [r[0] for r in df.select(recode.class_from_prefix("i")).collect()] == [1, 2, 0, 0]
    assert [r[0] for r in df.select(recode.sign_from_prefix("i")).collect()] == [-1.0, 1.0, -1.0, -1.0]


def test_drop_maximum_drops_ties(spark):
    df = spark.createDataFrame([(1,), (5,), (5,), (None,)], "x int")
    assert [r[0] for r in recode.drop_maximum(df, "x").collect()] == [1]
    assert recode.drop_maximum(df, "x", na="propagate").count() == 0


def test_decide(spark):
    df = spark.createDataFrame([(0.4,), (0.5,), (0.6,)], "s double")
    assert [r[0] for r in df.select(recode.decide("s", 0.5)).collect()] == [0, 0, 1]
    assert [r[0] for r in df.select(recode.decide("s", 0.5, symbol=2, inclusive=True)).collect()] == [0, 2, 2]


def test_search(spark):
    df = spark.createDataFrame(
        [("love #Crypto", False, "en"), ("RT #bitcoin", True, "en"), ("#bitcoins", False, "en"), ("#bitcoin", False, "fr")],
        "t string, rt boolean, l string")
    found = df.where(lookup.search("t", ["#bitcoin", "#Crypto"], F.col("rt"), "l", "en"))
    assert [r["t"] for r in found.collect()] == ["love #Crypto"]


def test_by_ids(spark):
    df = spark.createDataFrame([(1, "a"), (2, "b"), (3, None)], "id int, t string")
    ids = spark.createDataFrame([(3,), (3,), (9,)], "x int")
    assert [tuple(r) for r in lookup.by_ids(df, ids, "id").collect()] == [(3, None)]
    assert [tuple(r) for r in lookup.by_ids(df, [1, 3], "id", ["t"]).orderBy("t").collect()] == [(None,), ("a",)]


def test_small_marks_only_counted_sides(spark):
    big = spark.range(100)
    other = spark.range(1000).withColumnRenamed("id", "id")
    marked = other.join(lookup.small(big, 100), "id")._jdf.queryExecution().analyzed().toString()
    unmarked = other.join(lookup.small(big, 99), "id")._jdf.queryExecution().analyzed().toString()
    assert "broadcast" in marked and "broadcast" not in unmarked


# -- order --------------------------------------------------------------------------------

@pytest.mark.parametrize("parts", [1, 8])
def test_order_operators_on_ties_and_any_layout(spark, parts):
    rows = [(i, 7 if i % 3 else i, i if i % 4 == 0 else None, "g" if i < 70 else "h") for i in range(100)]
    df = spark.createDataFrame(rows, "id int, tie int, v int, g string").repartition(parts)
    want = sorted(rows, key=lambda r: (r[1], r[0]))
    index = {r["id"]: r["row_index"] for r in ordered.row_index(df, ["tie", "id"]).collect()}
    assert [index[r[0]] for r in want] == list(range(1, 101))
    filled = {r["id"]: r["v"] for r in ordered.forward_fill(df, ["tie", "id"], ["v"]).collect()}
    last, expect = None, {}
    for r in want:
        last = r[2] if r[2] is not None else last
        expect[r[0]] = last
    assert filled == expect
    run = {r["id"]: r["s"] for r in ordered.running_total(df, ["id"], "id", "s", group=["g"]).collect()}
    assert run[69] == sum(range(70)) and run[70] == 70 and run[99] == sum(range(70, 100))


def test_running_total_with_null_group(spark):
    df = spark.createDataFrame([(1, None), (2, None), (3, "a")], "id int, g string")
    run = {r["id"]: r["s"] for r in ordered.running_total(df, ["id"], "id", "s", group=["g"]).collect()}
    assert run == {1: 1, 2: 3, 3: 3}


def test_no_single_task_window_over_rows(spark):
    df = spark.range(1000).withColumn("v", F.col("id"))
    plan = ordered.row_index(df, ["id"])._jdf.queryExecution().executedPlan().toString()
    assert "Window" in plan and "BroadcastExchange" in plan and "CartesianProduct" not in plan


@FEW
@given(n=st.integers(1, 60), size=st.integers(1, 13))
def test_batches_are_dense(spark, n, size):
    out = ordered.batches(spark.range(n), ["id"], size).groupBy("batch_id").count().collect()
    sizes = {r["batch_id"]: r["count"] for r in out}
    assert sorted(sizes) == list(range(math.ceil(n / size))) and sum(sizes.values()) == n
    assert all(c == size for b, c in sizes.items() if b < max(sizes))


# -- samples -------------------------------------------------------------------------------

@FEW
@given(n=st.integers(1, 80), seed=st.integers(0, 9))
def test_splits_partition_the_input(spark, n, seed):
    df = spark.range(n)
    parts = sampling.weighted_split(df, "id", [0.6, 0.3, 0.1], seed)
    assert sorted(r["id"] for p in parts for r in p.collect()) == list(range(n))
    three = {r["split"]: r["count"] for r in sampling.three_way_split(df, "id", seed=seed).groupBy("split").count().collect()}
    first, second = int(0.7 * n), int(0.15 * n) + 1
    assert three.get("train", 0) == first
    assert three.get("validation", 0) == min(second, n - first)


@FEW
@given(n=st.integers(0, 70), take=st.integers(0, 80))
def test_simple_random_size(spark, n, take):
    assert sampling.simple_random(spark.range(n), "id", take, 3).count() == min(n, take)


@FEW
@given(sizes=st.lists(st.integers(1, 40), min_size=1, max_size=6), n=st.integers(1, 30))
def test_stratified_sizes_add_up(spark, sizes, n):
    rows = [(i * 1000 + j, f"s{i}") for i, c in enumerate(sizes) for j in range(c)]
    df = spark.createDataFrame(rows, "id long, s string")
    planned = {r["s"]: r["size"] for r in sampling.proportional_sizes(df, "s", n).collect()}
    assert sum(planned.values()) == n
    drawn = {r["s"]: r["count"] for r in sampling.stratified(df, "s", "id", n).groupBy("s").count().collect()}
    assert drawn == {s: min(k, sizes[int(s[1:])]) for s, k in planned.items() if k}


def capped(a, n):
    pik, fixed = [n * x / sum(a) for x in a], set()
    while {i for i, p in enumerate(pik) if p >= 1} != fixed:
        fixed = {i for i, p in enumerate(pik) if p >= 1}
        rest = sum(x for i, x in enumerate(a) if i not in fixed)
        pik = [1.0 if i in fixed else (n - len(fixed)) * x / rest for i, x in enumerate(a)]
    return pik


@FEW
@given(a=st.lists(st.integers(1, 1000), min_size=5, max_size=30), n=st.integers(1, 4))
def test_inclusion_probabilities(spark, a, n):
    df = spark.createDataFrame(list(enumerate(map(float, a))), "id int, a double")
    got = [r["pik"] for r in sampling.inclusion_probabilities(df, "a", n).orderBy("id").collect()]
    assert got == pytest.approx(capped(a, n)) and sum(got) == pytest.approx(n)
    weighted = sampling.inclusion_probabilities(df, "a", n)
    assert sampling.pps_systematic(weighted, ["id"], u=0.25).count() == n


def test_inclusion_probabilities_edges(spark):
    df = spark.createDataFrame([(1, 0.0), (2, 5.0), (3, None), (4, 1.0)], "id int, a double")
    got = {r["id"]: r["pik"] for r in sampling.inclusion_probabilities(df, "a", 2).collect()}
    assert got == {1: 0.0, 2: 1.0, 3: 0.0, 4: 1.0}


def test_bootstrap_draws_n_rows(spark):
    df = spark.range(200)
    assert sampling.bootstrap(df, ["id"]).agg(F.sum("times")).first()[0] == 200
    assert sampling.bootstrap(df, ["id"], expand=True).count() == 200


def test_systematic_start(spark):
    got = [r["id"] for r in sampling.systematic(spark.range(101), ["id"], 20, start=2).orderBy("id").collect()]
    assert got == list(range(1, 101, 6))


def test_samples_do_not_depend_on_layout(spark):
    df = spark.range(3000)
    for sample in (lambda d: sampling.simple_random(d, "id", 40), lambda d: sampling.repeated_samples(d, "id", 5, 4),
                   lambda d: sampling.three_way_split(d, "id"), lambda d: sampling.bootstrap(d, ["id"])):
        a = sorted(map(tuple, sample(df.repartition(1)).collect()))
        assert a == sorted(map(tuple, sample(df.repartition(8, "id")).collect()))


def test_upsample(spark):
    df = spark.createDataFrame([(i, int(i < 3)) for i in range(13)], "id long, y int")
    out = sampling.upsample(df, "y", "id").groupBy("y").count().collect()
    assert {r["y"]: r["count"] for r in out} == {0: 10, 1: 10}


# -- statistics ----------------------------------------------------------------------------

def test_null_policies(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", None), ("b", 3.0)], "g string, x double")
    strict = {r["g"]: r["m"] for r in stats.group_means(df, "g", {"m": "x"}).collect()}
    loose = {r["g"]: r["m"] for r in stats.group_means(df, "g", {"m": "x"}, na="skip").collect()}
    assert strict == {"a": None, "b": 3.0} and loose == {"a": 1.0, "b": 3.0}


@FEW
@given(x=st.lists(st.floats(-1e3, 1e3), min_size=1, max_size=50), bins=st.integers(1, 30), align=st.sampled_from(["centred", "edges"]))
def test_density_integrates_to_one(spark, x, bins, align):
    df = spark.createDataFrame([(v,) for v in x], "x double")
    rows = stats.density(df, "x", bins, align=align).collect()
    assert sum(r["density"] * (r["right"] - r["left"]) for r in rows) == pytest.approx(1.0)
    assert sum(r["n"] for r in rows) == len(x)


def test_round_histogram(spark):
    df = spark.createDataFrame([(float(v),) for v in [3, 4, 5, 5, 10, 11, 26, 49, 58]], "x double")
    got = {(r["left"], r["right"]): r["n"] for r in stats.round_histogram(df, "x").collect()}
    assert got == {(0.0, 10.0): 5, (10.0, 20.0): 1, (20.0, 30.0): 1, (40.0, 50.0): 1, (50.0, 60.0): 1}


def test_shares_add_up(spark):
    df = spark.createDataFrame([(1,), (1,), (2,), (None,)], "x int")
    assert {r["x"]: r["share"] for r in stats.shares(df, "x").collect()} == {1: pytest.approx(2 / 3), 2: pytest.approx(1 / 3)}


# -- measures ------------------------------------------------------------------------------

CASE = [(1, 1)] * 3 + [(1, 0)] + [(0, 0)] * 4 + [(0, 1)] + [(2, 0)] * 2 + [(2, 1)]


@pytest.mark.parametrize("policy, want", [
    ("one_vs_rest", (3, 6, 2, 1)), ("exclude_other", (3, 4, 1, 1)), ("label_equality", (3, 4, 4, 1))])
def test_confusion_policies(spark, policy, want):
    df = spark.createDataFrame(CASE, "label int, pred int")
    assert tuple(measures.confusion(df, 1, policy).first()) == want


def test_empty_denominators_are_null(spark):
    df = spark.createDataFrame([(0, 0), (0, 0)], "label int, pred int")
    row = measures.rates(measures.confusion(df, 1)).first()
    assert row["precision"] is None and row["recall"] is None and row["f_score"] is None and row["accuracy"] == 1.0


# -- sequences -----------------------------------------------------------------------------

def test_sentences_in_numeric_order_over_chunks(spark):
    rows = [(s, i, f"w{i}", f"t{i % 3}") for s in (2, 10) for i in range(50)]
    df = spark.createDataFrame(rows, "sid int, pos int, word string, tag string").repartition(5)
    got = {r["sid"]: r for r in sq.sentences(df, "sid", "pos", "word", ["tag"], chunk=7).collect()}
    assert got[2]["sentence"] == " ".join(f"w{i}" for i in range(50))
    assert got[10]["tag"] == [f"t{i % 3}" for i in range(50)]


def test_pad_sides(spark):
    df = spark.createDataFrame([([1, 2, 3],)], "a array<int>")
    pads = [sq.pad("a", 5), sq.pad("a", 2), sq.pad("a", 2, truncate="post"), sq.pad("a", 5, 9, "pre"), sq.pad("a", 2, truncate=None)]
    assert list(df.select(*[p.alias(str(i)) for i, p in enumerate(pads)]).first()) == [
        [1, 2, 3, 0, 0], [2, 3], [1, 2], [9, 9, 1, 2, 3], [1, 2, 3]]


def test_encode_decode(spark):
    table = spark.createDataFrame([("a", 1), ("b", 2)], "term string, id int")
    df = spark.createDataFrame([(1, ["b", "x", "a"]), (2, ["x"]), (3, [])], "k int, words array<string>")
    dropped = {r["k"]: r["ids"] for r in sq.encode(df, ["k"], "words", table).collect()}
    assert dropped == {1: [2, 1], 2: [], 3: []}
    kept = sq.encode(df, ["k"], "words", table, unknown=9)
    assert {r["k"]: r["ids"] for r in kept.collect()} == {1: [2, 9, 1], 2: [9], 3: []}
    back = sq.decode(kept.withColumn("ids", sq.pad("ids", 4)), ["k"], "ids", table)
    assert {r["k"]: r["words"] for r in back.collect()} == {1: ["b", "a"], 2: [], 3: []}


def test_pps_with_very_many_rows(spark):
    """Shares below one in a million still add up to the wanted number of rows."""
    rows = spark.range(3_000_000).withColumn("a", F.lit(1.0))
    weighted = sampling.inclusion_probabilities(rows, "a", 2)
    for u in (0.0, 0.11, 0.37, 0.999):
        assert sampling.pps_systematic(weighted, ["id"], u=u).count() == 2


def test_upsample_of_one_row(spark):
    df = spark.range(30_001).select("id", (F.col("id") == 0).cast("int").alias("y"))
    out = sampling.upsample(df, "y", "id").groupBy("y").agg(F.count("*").alias("n"), F.count_distinct("id").alias("d"))
    assert {r["y"]: (r["n"], r["d"]) for r in out.collect()} == {0: (30_000, 30_000), 1: (30_000, 1)}


def test_repeated_samples_deal_draws_to_tasks(spark, monkeypatch):
    """One partition that holds all rows is not one task that makes all draws."""
    seen = []
    settle = sampling.settled
    monkeypatch.setattr(sampling, "settled", lambda d: seen.append(d.rdd.getNumPartitions()) or settle(d))
    monkeypatch.setattr(sampling, "DRAWS_AT_ONCE", 6000)
    df = spark.range(10_000).select(F.col("id"), (F.col("id") % 7).alias("v")).coalesce(1)
    got = sampling.repeated_samples(df, "id", 20, 6)
    assert seen[0] == 10
    drawn = df.select("id", F.explode(F.sequence(F.lit(1), F.lit(6))).alias("sample_id")).select(
        "id", "sample_id", hashing.draw("sample_id", "id").alias("u"), hashing.drawn_below(1 << 45, "sample_id", "id").alias("low"))
    rows = drawn.collect()
    assert all(r["low"] == (r["u"] < 1 << 45) for r in rows) and any(r["low"] for r in rows)
    want = {(s, i) for s in range(1, 7) for _, i in sorted((r["u"], r["id"]) for r in rows if r["sample_id"] == s)[:20]}
    assert {(r["sample_id"], r["id"]) for r in got.collect()} == want


def test_repeated_samples_are_exact(spark):
    df = spark.range(500)
    got = sampling.repeated_samples(df, "id", 20, 6).groupBy("sample_id").agg(F.collect_set("id").alias("ids")).collect()
    draws = df.select("id", *[sampling.draw(F.lit(s), "id").alias(f"d{s}") for s in range(1, 7)]).collect()
    want = {s: {r["id"] for r in sorted(draws, key=lambda r: (r[f"d{s}"], r["id"]))[:20]} for s in range(1, 7)}
    assert {r["sample_id"]: set(r["ids"]) for r in got} == want
    assert sampling.repeated_samples(df.limit(3), "id", 20, 2).count() == 6


def test_shuffled_orders_agree(spark):
    rows = [r["id"] for r in sampling.shuffled(spark.range(300), "id").collect()]
    places = {r["id"]: r["place"] for r in sampling.shuffled_places(spark.range(300), "id").collect()}
    assert sorted(rows) == list(range(300)) and rows != sorted(rows) and [places[i] for i in rows] == list(range(1, 301))


def test_small_counts_bytes(spark):
    from tallyloom.operators.lookup import small

    wide = spark.range(50).select("id", F.repeat(F.lit("x"), 1000).alias("t"))
    hinted = lambda df: "broadcast" in df._jdf.queryExecution().analyzed().toString().lower()
    assert hinted(small(wide)) and not hinted(small(wide, limit_bytes=20_000)) and hinted(small(spark.range(50), limit_bytes=20_000))


def test_ids_of_copies_do_not_depend_on_layout(spark):
    from tallyloom.operators.recode import numbered_copies
    from tallyloom.plans.documents import documents_from_lines

    lines = spark.createDataFrame([(f"promo {i % 7}",) for i in range(100)], "value string")
    tagged = spark.createDataFrame([], "value string")
    ids = [sorted(r["doc_id"] for r in documents_from_lines(tagged, lines.repartition(n)).collect()) for n in (2, 7)]
    assert ids[0] == ids[1] and len(set(ids[0])) == 100
    assert numbered_copies(lines.limit(0)).count() == 0


def test_rows_beside_rows(spark):
    left = spark.range(0, 100).select(F.col("id").alias("a")).repartition(7)
    right = spark.range(0, 130).select(F.col("id").alias("b"), (-F.col("id")).alias("o")).repartition(3)
    cut = ordered.zip_rows(left, right, ["a"], ["o"]).collect()
    assert sorted((r["a"], r["b"]) for r in cut) == [(i, 129 - i) for i in range(100)]
    padded = ordered.zip_rows(left, right, ["a"], ["o"], pad=True).collect()
    assert sorted((r["b"], r["a"]) for r in padded) == [(129 - i, i if i < 100 else None) for i in reversed(range(130))]
    assert ordered.zip_rows(left, right.where("false"), ["a"], ["o"]).count() == 0
    with pytest.raises(ValueError, match="columns of both"):
        ordered.zip_rows(left, right.withColumnRenamed("b", "A"), ["a"], ["o"])
