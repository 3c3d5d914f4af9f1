import bz2
import json
import pathlib

import pytest
from pyspark.sql import functions as F

from tallyloom.functions.dates import short_date
from tallyloom.operators import recode, stats
from tallyloom.sources import folders, lines, pages, sinks
from tallyloom.streaming import landed

FIX = "tests/fixtures"


def test_compressed_lines(spark, tmp_path):
    (tmp_path / "t.csv.bz2").write_bytes(bz2.compress(pathlib.Path(f"{FIX}/trips.csv").read_bytes()))
    assert lines.text_lines(spark, str(tmp_path / "t.csv.bz2")).count() == 14


def test_trip_csv(spark):
    df = lines.trip_lines(spark, f"{FIX}/trips.csv")
    assert len(df.columns) == 17 and df.first()["_c4"] == "120"


def test_incident_table(spark):
    df = lines.headed_csv(spark, f"{FIX}/incidents.csv", sentinels=("-999", "NA"))
    df = recode.rename(df, {"Total victims": "total_victims", "Mental Health Issues": "mental", "Age": "age"})
    df = df.withColumn("Date", short_date("Date"))
    df = df.withColumn("mental", recode.recode_value("mental", "yes", "Yes"))
    df = recode.fill_null(df, {"mental": "Unknown", "Cause": "Unknown", "Target": "Unknown"})
    df = recode.before(df, "Date", "2020-12-31").orderBy(F.desc("Date"))
    # 66 means 2066 and the unreadable date is null: both leave with the cutoff, as does the cutoff day itself
    assert [r["Title"] for r in df.collect()] == ["e", "a", "c"]
    assert {r["Title"]: r["mental"] for r in df.collect()} == {"e": "Unknown", "a": "No", "c": "Unknown"}
    counted = df.withColumn("total_victims", F.col("total_victims").cast("int"))
    assert {r["Target"]: r["n"] for r in stats.frequencies(counted, "Target").collect()} == {
        "Students": 1, "random": 1, "Unknown": 1}


def test_pick_positions(spark):
    df = spark.createDataFrame([(1, 2, 3, 4)], "a int, b int, c int, d int")
    assert recode.pick_positions(df, [4, 1, 2, 3, -2]).columns == ["d", "a", "c"]
    assert recode.pick_positions(df, [-1]).columns == ["b", "c", "d"]


def test_latin1(spark, tmp_path):
    (tmp_path / "x.csv").write_bytes("Word,Tag\ncafé,O\n".encode("latin-1"))
    assert lines.latin1_csv(spark, str(tmp_path / "x.csv")).first()["Word"] == "café"


def test_text_folders(spark, tmp_path):
    for label in ("cricket", "rugby", "tennis"):
        (tmp_path / label).mkdir()
        for i in range(4):
            (tmp_path / label / f"{i:03}.txt").write_text(f"{label}\nline {i}")
    (tmp_path / "README.TXT").write_text("stray")
    df = folders.labelled_texts(spark, str(tmp_path), class_names=["tennis", "rugby", "cricket"])
    assert {(r["label"], r["label_id"]): r["count"] for r in df.groupBy("label", "label_id").count().collect()} == {
        ("tennis", 0): 4, ("rugby", 1): 4, ("cricket", 2): 4}
    assert df.where("label = 'rugby'").orderBy("path").first()["text"] == "rugby\nline 0"
    every = folders.labelled_texts(spark, str(tmp_path), glob="*")
    assert every.count() == 13 and folders.without_files(every, "readme.txt").count() == 12
    assert (tmp_path / "README.TXT").exists()


def test_binary_folders(spark, tmp_path):
    for label, n in (("fire", 2), ("no_fire", 4)):
        (tmp_path / label).mkdir()
        for i in range(n):
            (tmp_path / label / f"{i}.jpg").write_bytes(bytes([i]) * 3)
    df = folders.labelled_files(spark, str(tmp_path), "*.jpg", ["no_fire", "fire"])
    counts = stats.class_counts(df)
    assert {r["label"]: r["n"] for r in counts.collect()} == {"fire": 2, "no_fire": 4}
    plan = counts._jdf.queryExecution().executedPlan().toString()
    assert "content" not in plan.split("ReadSchema")[1]
    assert stats.class_ratio(df, "label", "fire", "no_fire").first()["ratio"] == 0.5
    assert df.where("label = 'fire'").agg(F.min("label_id")).first()[0] == 1


def landed_pages(tmp_path, tokens=("t1", "t2", None)):
    for i, token in enumerate(tokens):
        data = [{"id": f"{i}{j}", "text": f"text {i} {j}", "author_id": "9", "created_at": f"2024-01-0{i + 1}T10:00:00Z"} for j in range(3)]
        meta = {"next_token": token} if token else {}
        (tmp_path / f"page-{i:04}.json").write_text(json.dumps({"data": data, "meta": meta}, indent=1))
    return str(tmp_path)


def test_pages(spark, tmp_path):
    df = pages.read_pages(spark, landed_pages(tmp_path)).withColumn("next_token", F.col("meta.next_token"))
    assert pages.collect_texts(df).count() == 9
    assert pages.collect_texts(df, keep_last=False).count() == 6
    assert pages.collect_texts(df, cap=4).count() == 6  # the cap is passed by less than a page
    assert pages.collect_texts(df, cap=3).count() == 3
    assert pages.collect_texts(df, cap=0).count() == 0


def test_pages_per_query(spark, tmp_path):
    df = pages.read_pages(spark, landed_pages(tmp_path)).withColumn("next_token", F.col("meta.next_token"))
    both = df.withColumn("q", F.lit("a")).unionByName(df.where("page_no > 0").withColumn("q", F.lit("b")))
    kept = pages.collect_pages(both, cap=4, group=["q"])
    assert {r["q"]: r["count"] for r in kept.groupBy("q").count().collect()} == {"a": 2, "b": 2}


def chain(spark, pairs):
    rows = [(a, b, [("1", f"text {i}", "9", "")]) for i, (a, b) in enumerate(pairs)]
    return spark.createDataFrame(rows, "page_token string, next_token string, data array<struct<id:string,text:string,author_id:string,created_at:string>>")


@pytest.mark.parametrize("pairs,want", [
    ([], []),
    ([("a", "b"), ("b", None)], []),  # no first page
    ([(None, None)], [None]),
    ([(None, "a"), ("b", None), ("a", "b"), ("z", "a")], [None, "a", "b"]),  # z is never asked for
    ([(None, "a"), ("a", "gone")], [None, "a"]),
    ([(None, "a"), ("a", "b"), ("b", "a")], [None, "a", "b"]),  # a loop
    ([(None, "a"), ("a", "a")], [None, "a"]),
    ([(None, "a"), ("a", "c"), ("a", "b"), ("a", None), ("b", None), ("c", None)], [None, "a", "b"]),  # a fork
    ([(None, "a"), (None, "a"), ("a", ""), ("", None)], [None, "a", ""]),
    ([(None, "n0"), *[(f"n{i}", f"n{i + 1}") for i in range(69)]], [None, *[f"n{i}" for i in range(69)]]),
])
def test_places_by_token(spark, pairs, want):
    df = chain(spark, pairs)
    got = sorted((r["place"], r["page_token"]) for r in pages.page_places(df).collect())
    assert [t for _, t in got] == want and [p for p, _ in got] == list(range(len(want)))
    kept = pages.collect_pages_by_token(df)
    assert kept.count() == len(want)
    assert pages.collect_pages_by_token(df, cap=2).count() == min(2, len(want))


def test_places_per_query(spark):
    one = chain(spark, [(None, "a"), ("a", None)]).withColumn("q", F.lit("one"))
    two = chain(spark, [(None, "b"), ("a", "c"), ("b", "a")]).withColumn("q", F.lit(None).cast("string"))
    two = two.withColumn("q", F.lit("two"))
    got = {(r["q"], r["place"]): r["page_token"] for r in pages.page_places(one.unionByName(two), group=["q"]).collect()}
    assert got == {("one", 0): None, ("one", 1): "a", ("two", 0): None, ("two", 1): "b", ("two", 2): "a"}


def test_page_files_by_token(spark, tmp_path):
    """The file numbers run against the tokens."""
    for number, asked, following in ((3, "", "x"), (1, "-x", "y"), (2, "-y", None)):
        meta = {"next_token": following} if following else {}
        data = [{"id": str(number), "text": f"t{number}", "author_id": "1", "created_at": "2024-01-01T00:00:00Z"}]
        (tmp_path / f"page-{number:04}{asked}.json").write_text(json.dumps({"data": data, "meta": meta}))
    df = pages.read_pages(spark, str(tmp_path)).withColumn("next_token", F.col("meta.next_token"))
    kept = pages.collect_pages_by_token(df, keep_last=False)
    assert [r["page_no"] for r in kept.orderBy("place").collect()] == [3, 1]


def test_stream_of_pages(spark, tmp_path):
    (tmp_path / "in").mkdir()
    path = landed_pages(tmp_path / "in")
    counts = landed.landing_daily_counts(landed.landing_records(spark, path, 1), "1 hour")
    run = (
        counts.writeStream.format("memory").queryName("days").outputMode("append")
        .option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start()
    )
    run.awaitTermination(120)
    got = {str(r["day"]): r["n"] for r in spark.table("days").collect()}
    # the last day is still open
    assert got == {"2024-01-01": 3, "2024-01-02": 3}


def test_sinks(spark, tmp_path):
    df = sinks.from_values(spark, [0.5, 0.25], "loss double")
    sinks.write_single_text(df, str(tmp_path / "t"))
    assert len(list((tmp_path / "t").glob("part-*"))) == 1
    assert sorted(r["value"] for r in spark.read.text(str(tmp_path / "t")).collect()) == ["0.25", "0.5"]
    sinks.write_json(df, str(tmp_path / "j"))
    assert spark.read.json(str(tmp_path / "j")).count() == 2
    assert sinks.numbers(spark, 5).agg(F.sum("pos")).first()[0] == 10
    assert sinks.shape(df) == (2, 1) and sinks.preview(df, 1).count() == 1


def test_reuse_and_small_collect(spark):
    df = spark.range(10)
    with sinks.reused(df) as (kept,):
        assert kept.is_cached
    assert not df.is_cached
    assert len(sinks.collect_small(df, 10)) == 10
    with pytest.raises(ValueError):
        sinks.collect_small(df, 9)
