"""Document classification: lines -> words -> dictionary -> weights -> fits -> measures.

One flow with a preset per published variant; the variants differ in stemming,
weighting, model, batch, step rule, penalty and how third-class rows are counted.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, replace

import numpy as np
from pyspark.sql import DataFrame, functions as F

from tallyloom.functions.losses import RowLoss, hinge, logistic, weighted_hinge
from tallyloom.functions.text import letter_words
from tallyloom.operators.features import (
    document_frequency, idf, positions, row_total, scoring_features, training_dictionary, training_weights,
)
from tallyloom.operators.measures import confusion, f_by_label, positive_share, rates, score_features
from tallyloom.operators.recode import bag_union, class_from_prefix, numbered_copies, parse_tagged_line, synthetic_ids
from tallyloom.operators.vocabulary import stem_documents
from tallyloom.plans import mlfit
from tallyloom.plans.blocks import Side, packed
from tallyloom.plans.descent import (
    Descent, Fit, batch_norm_penalty, fit_margin_batches, fit_margins, no_penalty, scalar_norm_penalty,
)
from tallyloom.plans.softmax import fit_softmax, predict_softmax
from tallyloom.plans.sparse_forest import fit_sparse_forest, predict_sparse_forest
from tallyloom.plans.timing import Phases
from tallyloom.session import settled
from tallyloom.sources.sinks import collect_small, reused

# (name, class searched for, class left out of training)
TASKS = [("first_class", 1, None), ("second_class", 2, None), ("second_without_first", 2, 1)]


@dataclass(frozen=True)
class Preset:
    model: str
    stem: bool = True
    use_idf: bool = True
    batch: int | None = None
    rate: float = 0.01
    tolerance: float = 0.01
    passes: int = 300
    penalty: Callable = no_penalty
    policy: str = "one_vs_rest"
    tasks: tuple = tuple(TASKS)


# The step rules and penalties of the published variants.
PRESETS = {
    "logistic_full": Preset("logistic", penalty=scalar_norm_penalty(1e-4)),
    "logistic_full_unstemmed": Preset("logistic", stem=False, penalty=scalar_norm_penalty(1e-4)),
    "logistic_batches": Preset("logistic", batch=100, rate=0.001, tolerance=0.1,
                               penalty=scalar_norm_penalty(1e-3), policy="exclude_other"),
    "svm_batches": Preset("hinge", batch=100, rate=0.01, tolerance=1e-4, passes=200,
                          penalty=batch_norm_penalty(0.1, 100), policy="label_equality"),
    "weighted_svm": Preset("weighted_hinge", stem=False, use_idf=False, rate=0.1, tolerance=0.1, passes=500,
                           policy="one_vs_rest", tasks=(("second_class", 2, None),)),
    "multinomial": Preset("multinomial", passes=200),
    "forest": Preset("forest", policy="exclude_other"),
}


def documents_from_lines(tagged: DataFrame, promotions: DataFrame | None = None, key: str | None = None) -> DataFrame:
    """``doc_id, label, words`` from tagged lines and, whole, from promotion lines.

    Promotions without a ``key`` are named by their text and number among equal lines.
    """
    parsed = parse_tagged_line(tagged).where(F.col("doc_id").isNotNull() & F.col("body").isNotNull())
    docs = parsed.select("doc_id", F.col("body").alias("text"))
    if promotions is not None:
        keyed = numbered_copies(promotions.select("value")) if key is None else promotions
        named = synthetic_ids(keyed, key=key or "key").select("doc_id", F.col("value").alias("text"))
        docs = bag_union(docs, named)
    return docs.select("doc_id", class_from_prefix("doc_id").alias("label"), letter_words("text").alias("words"))


def _loss(preset: Preset, docs: DataFrame, features: DataFrame, target: int) -> RowLoss:
    if preset.model == "logistic":
        return logistic()
    if preset.model == "hinge":
        return hinge()
    share = positive_share(docs, features, F.col("label") == target).first()
    return weighted_hinge(share["pr"])


def fit_tasks(preset: Preset, docs: DataFrame, features: DataFrame, width: int, seed: int | str = 13,
              fast: bool = True, factors: np.ndarray | None = None) -> list[Fit]:
    """The fit of every task: its target against the rest, optionally without a class.

    Full-batch fits run in step over one set of blocks, whose values ``factors`` weigh by position; a mini-batch
    fit draws its own batches.
    """
    models = [_loss(preset, *_without(docs, features, w), target) for _, target, w in preset.tasks]
    rule = Descent(preset.rate, preset.tolerance, preset.passes)
    if preset.batch is None:
        sides = [Side(model, target, without) for model, (_, target, without) in zip(models, preset.tasks)]
        with reused(packed(features)) as (blocks,):
            return fit_margins(blocks, width, sides, [rule] * len(sides), preset.penalty, factors=factors)
    fits = []
    # all tasks draw from one list of documents with features, so the features are read once a task
    listed = settled(features.select("doc_id", "label").distinct())
    for model, (_, target, without) in zip(models, preset.tasks):
        mine, known = _without(features, listed, without)
        keys = settled(known.select("doc_id").distinct())
        # the third task samples against its own documents that have features, the others against all documents
        total = docs.count() if without is None else keys.count()
        fits.append(fit_margin_batches(
            mine, width, model, rule, preset.batch, total, preset.penalty, seed=seed, fast=fast, label="label", target=target, keys=keys))
    return fits


def _without(docs: DataFrame, features: DataFrame, label: int | None) -> tuple[DataFrame, DataFrame]:
    return (docs, features) if label is None else (docs.where(F.col("label") != label), features.where(F.col("label") != label))


def run_documents(training: DataFrame, testing: DataFrame, preset: str | Preset, size: int = 20000,
                  passes: int | None = None, seed: int | str = 13, fast: bool = True,
                  phases: Phases | None = None) -> DataFrame:
    """Train on one set, measure on the other: a row of counts and rates per task.

    Both sets hold ``doc_id, label, words``.  The dictionary comes to the driver
    only for the library models, which need it as a vocabulary.
    """
    preset = PRESETS[preset] if isinstance(preset, str) else preset
    preset = replace(preset, passes=passes) if passes else preset
    phases = phases or Phases()
    if preset.stem:
        training, testing = settled(stem_documents(training)), settled(stem_documents(testing))
    spark = training.sparkSession
    if preset.model == "forest":
        return _run_forest(training, testing, preset, size, seed, phases)
    terms = training_dictionary(training, size)
    rows = []
    with reused(training, terms) as (docs, words):
        width = words.count()
        # a full-batch fit packs one value a document, and weighs words by their frequency on the driver
        apart = preset.use_idf and preset.batch is None and preset.model != "multinomial"
        features = settled(training_weights(docs, words, carry=["label"], use_idf=preset.use_idf and not apart))
        factors = _factors(words, docs, width) if apart else None
        if preset.model == "multinomial":
            return _run_multinomial(features, testing, words, width, preset, phases)
        with phases("train"):
            found = fit_tasks(preset, docs, features, width, seed, fast, factors)
        fits = [(name, target, fit) for (name, target, _), fit in zip(preset.tasks, found)]
        with phases("test"):
            held = scoring_features(testing, words, carry=["label"], idf_from="test" if preset.use_idf else "none")
            with reused(held) as (scoring,):
                for name, target, fit in fits:
                    scored = score_features(scoring, fit.weight_table(spark), carry=("label",), symbol=target)
                    counts = confusion(scored, target, preset.policy)
                    rows.append(rates(counts).first().asDict() | {"task": name, "losses": len(fit.losses)})
    schema = ("task string, losses int, tp bigint, tn bigint, fp bigint, fn bigint, "
              "precision double, recall double, f_score double, accuracy double")
    names = [f.split()[0] for f in schema.split(", ")]
    return spark.createDataFrame([tuple(r[n] for n in names) for r in rows], schema)


def _factors(words: DataFrame, docs: DataFrame, width: int) -> np.ndarray:
    """The inverse document frequency by position: as long as the weights of a fit."""
    found = words.select("pos", idf(F.col("df"), row_total(docs)).alias("f")).toPandas()
    out = np.ones(width)
    out[found["pos"].to_numpy()] = found["f"].to_numpy()
    return out


def _run_multinomial(features, testing, words, width, preset, phases) -> DataFrame:
    """F measure of every class, overall accuracy, and how far from its optimum the fit stopped."""
    with phases("train"):
        fit = fit_softmax(features, width, penalty=1.0, passes=preset.passes)
    held = scoring_features(testing, words, carry=["label"], idf_from="test")
    with phases("test"):
        with reused(predict_softmax(held, fit)) as (scored,):
            typed = scored.select(F.col("label").cast("double").alias("label"), "pred")
            overall = typed.agg(F.avg((F.col("label") == F.col("pred")).cast("double"))).first()[0]
            found = f_by_label(typed).withColumns({"accuracy": F.lit(overall).cast("double"), "certificate": F.lit(fit.certificate)})
            return settled(found)


def _run_forest(training, testing, preset, size, seed, phases) -> DataFrame:
    """The library's vectors take the dictionary (at most ``size`` rows) as their vocabulary; the forest takes their entries."""
    with reused(training_dictionary(training, size)) as (terms,):
        listed = collect_small(terms.withColumn("_idf", idf(F.col("df"), row_total(training))).orderBy("pos"), size)
        held = positions(testing, terms)
        found = held.agg(F.count_distinct("doc_id").cast("double").alias("n")).scalar()
        seen = {r["pos"]: r["_idf"] for r in collect_small(
            document_frequency(held).select("pos", idf(F.col("df"), found).alias("_idf")), size)}
    vocabulary = [r["term"] for r in listed]
    typed = [d.withColumn("label", F.col("label").cast("double")) for d in (training, testing)]
    train = mlfit.sparse_vectors(typed[0], vocabulary, [r["_idf"] for r in listed])
    # the test set is weighted by its own frequencies, as everywhere in this flow
    test = mlfit.sparse_vectors(typed[1], vocabulary, [seen.get(r["pos"], 0.0) for r in listed])
    with phases("train"):
        model = fit_sparse_forest(mlfit.entries(train), "doc_id", len(vocabulary), seed=int(seed))
    with phases("test"), reused(predict_sparse_forest(mlfit.entries(test), model, ["doc_id", "label"])) as (scored,):
        parts = [
            rates(confusion(scored, target, preset.policy)).withColumn("task", F.lit(name))
            for name, target, without in preset.tasks if without is None
        ]
        return bag_union(*parts)
