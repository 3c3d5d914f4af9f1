"""Stages of the corpus pipeline against plain versions of what they decide."""

import collections
import re

import numpy as np
import pytest

import corpus_pipeline as pipeline
from tests.llm.test_repeats import plain
from tests.llm.test_simhash import plain_classes, plain_print
from tests.llm.test_tokens import check_bins

FOLDER = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def results(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("stages")
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    out = [docs]
    for name, stage in pipeline.STAGES:
        stage(spark, out[-1], FOLDER).write.parquet(str(folder / name))
        out.append(spark.read.parquet(str(folder / name)))
    return [{(r["doc_id"], r["piece"]) if "piece" in r else r["doc_id"]: r for r in x.collect()} for x in out]


def test_stages_and_columns(results):
    assert [n for n, _ in pipeline.STAGES] == ["language_id", "simhash_near_dedup", "suffix_array_dedup", "mixing", "best_fit_packing"]
    for rows in results[:-1]:
        assert list(next(iter(rows.values())).asDict()) == pipeline.COLUMNS


def test_language_keeps_what_has_letters(results):
    docs, kept = results[:2]
    assert all(d in docs for d in kept)
    lost = [docs[d]["text"] for d in docs.keys() - kept.keys()]
    assert len(lost) < 0.01 * len(docs) and all(len(re.findall(r"[^\W\d_]{2,}", t)) < 40 for t in lost)


def test_one_of_each_near_copy(results):
    before, kept = results[1:3]
    ids = sorted(before)
    classes = plain_classes([plain_print(before[d]["text"]) for d in ids], ids)
    assert set(kept) == set(classes)
    assert all(kept[d] == before[d] for d in kept)


def test_no_passage_repeats(results):
    before, kept = results[2:4]
    assert set(before) == set(kept)
    ids = sorted(before)
    for d, (text, _, _) in zip(ids, plain([before[d]["text"].encode() for d in ids], 200)):
        assert kept[d]["text"] == text.decode("utf-8", "ignore") and kept[d]["n_chars"] == len(kept[d]["text"])


def test_clean_documents_stay(spark, results):
    before, kept = results[3:5]
    assert all(kept[d] == before[d] for d in kept)
    labels = {r["doc_id"]: r["toxic"] for r in spark.read.parquet(f"{FOLDER}/labels.parquet").collect()}
    clean = [d for d in before if labels.get(d) == 0]
    toxic = [d for d in before if labels.get(d) == 1]
    assert sum(d in kept for d in clean) >= 0.99 * len(clean) and sum(d in kept for d in toxic) <= 0.5 * len(toxic)  # few lessons


def test_packed(results):
    kept, packed = results[4:]
    assert {d for d, _ in packed} == set(kept)
    bins = check_bins(packed.values(), 4096)
    assert len(bins) <= 1.02 * sum(bins.values()) / 4096 + 1


def test_run_equals_its_stages(spark, folder):
    rows = pipeline.run(spark, folder).collect()
    assert rows and collections.Counter((r["doc_id"], r["piece"]) for r in rows).most_common(1)[0][1] == 1
    assert np.all([r["length"] <= 4096 for r in rows])


def test_odd_rows_and_empty_tables(spark, odd, empty, tmp_path):
    spark.createDataFrame([], "doc_id bigint, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    for name, stage in pipeline.STAGES:
        assert stage(spark, empty, str(tmp_path)).count() == 0, name
        assert stage(spark, odd, str(tmp_path)).count() > 0, name
