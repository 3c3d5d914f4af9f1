"""Confusion counts, precision/recall/F, accuracy, errors and scoring."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tallyloom.operators.recode import decide


def _counts(label: Column, pred: Column, target: int, policy: str, other: int) -> dict[str, Column]:
    hit, mine = label == pred, label == target
    if policy == "one_vs_rest":
        # the prediction is "target" or "not target"; every other class is a negative
        said = pred == target
        return {"tp": mine & said, "fn": mine & ~said, "tn": ~mine & ~said, "fp": ~mine & said}
    if policy == "exclude_other":
        # rows of a third class count nowhere
        against = label == other
        return {"tp": mine & hit, "fn": mine & ~hit, "tn": against & hit, "fp": against & ~hit}
    if policy == "label_equality":
        # a third-class row can never equal its prediction, so it is a false positive
        return {"tp": mine & hit, "fn": mine & ~hit, "tn": ~mine & hit, "fp": ~mine & ~hit}
    raise ValueError("policy must be one_vs_rest, exclude_other or label_equality")


def confusion(df: DataFrame, target: int = 1, policy: str = "one_vs_rest", other: int = 0,
              label: str = "label", pred: str = "pred", by: tuple[str, ...] = ()) -> DataFrame:
    """``tp, tn, fp, fn`` in one aggregate (per group of ``by``)."""
    c = _counts(F.col(label), F.col(pred), target, policy, other)
    return df.groupBy(*by).agg(*[F.count_if(c[k]).alias(k) for k in ("tp", "tn", "fp", "fn")])


def rates(counts: DataFrame, digits: int = 4) -> DataFrame:
    """Precision, recall, F score and accuracy from counts; an empty denominator gives null."""
    tp, tn, fp, fn = (F.col(k) for k in ("tp", "tn", "fp", "fn"))
    precision, recall = F.try_divide(tp, tp + fp), F.try_divide(tp, tp + fn)
    f_score = F.try_divide(2 * precision * recall, precision + recall)
    accuracy = F.try_divide(tp + tn, tp + tn + fp + fn)
    return counts.withColumns({
        "precision": F.round(precision, digits), "recall": F.round(recall, digits),
        "f_score": F.round(f_score, digits), "accuracy": F.round(accuracy, digits),
    })


def confusion_at(df: DataFrame, score: str, label: str = "label", threshold: float = 0.5) -> DataFrame:
    """Confusion counts of scores above a threshold, with F = TP / (TP + (FP + FN) / 2)."""
    marked = df.withColumn("_said", decide(score, threshold))
    counts = confusion(marked, 1, "one_vs_rest", label=label, pred="_said")
    return counts.withColumn("f_score", F.round(F.try_divide("tp", F.col("tp") + (F.col("fp") + F.col("fn")) / 2), 2))


def f_by_label(df: DataFrame, beta: float = 1.0, label: str = "label", pred: str = "pred") -> DataFrame:
    """F measure of every class: each row is counted once as a label and once as a prediction."""
    sides = df.select(F.explode(F.array(
        F.struct(F.col(label).alias("class"), (F.col(label) == F.col(pred)).cast("long").alias("tp"),
                 F.lit(1).cast("long").alias("labelled"), F.lit(0).cast("long").alias("said")),
        F.struct(F.col(pred).alias("class"), F.lit(0).cast("long").alias("tp"),
                 F.lit(0).cast("long").alias("labelled"), F.lit(1).cast("long").alias("said")),
    )).alias("s")).select("s.*")
    sums = sides.groupBy("class").agg(*[F.sum(c).alias(c) for c in ("tp", "labelled", "said")])
    precision, recall = F.try_divide("tp", "said"), F.try_divide("tp", "labelled")
    b2 = beta * beta
    f = F.try_divide((1 + b2) * precision * recall, b2 * precision + recall)
    return sums.select("class", precision.alias("precision"), recall.alias("recall"), f.alias("f"))


def accuracy(df: DataFrame, label: str = "label", pred: str = "pred", out: str = "accuracy") -> DataFrame:
    return df.agg(F.avg((F.col(label) == F.col(pred)).cast("double")).alias(out))


def misclassified(df: DataFrame, score: str, threshold: float = 0.5) -> DataFrame:
    """Share of a one-class set that scores at or above the threshold, and its complement."""
    wrong = F.avg((F.col(score) >= threshold).cast("double"))
    return df.agg(wrong.alias("error_ratio"), (1 - wrong).alias("accuracy"))


def mean_squared_error(df: DataFrame, y: str = "y", pred: str = "pred") -> DataFrame:
    """Sums of target, prediction and squared error, and the mean squared error, in one aggregate."""
    gap = F.col(y) - F.col(pred)
    return df.agg(
        F.sum(y).alias("sum_y"), F.sum(pred).alias("sum_pred"), F.sum(gap * gap).alias("sum_sq"),
        F.count("*").alias("n"), F.avg(gap * gap).alias("mse"),
    )


def positive_share(docs: DataFrame, features: DataFrame, positive: Column, key: str = "doc_id") -> DataFrame:
    """``pr, nr``: positives among the *vectorised* documents over *all* documents, and the rest."""
    all_docs = docs.agg(F.count("*").cast("double").alias("n")).scalar()
    found = features.where(positive).agg(F.count_distinct(key).alias("_p"))
    pr = F.col("_p") / all_docs
    return found.select(pr.alias("pr"), (1 - pr).alias("nr"))


def score_features(features: DataFrame, weights: DataFrame, key: str = "doc_id", carry: tuple[str, ...] = (),
                   threshold: float = 0.0, symbol=1, other=0) -> DataFrame:
    """Margin and decision of each document.  Weights hold one row per dictionary word and are
    broadcast; margins are summed per task before the shuffle."""
    margin = (
        features.join(F.broadcast(weights.select("pos", "w")), "pos")
        .groupBy(key, *carry)
        .agg(F.sum(F.col("value") * F.col("w")).alias("margin"))
    )
    return margin.withColumn("pred", decide("margin", threshold, symbol, other))


def score_columns(df: DataFrame, weights: list[float], inputs: list[str], out: str = "pred") -> DataFrame:
    """Linear prediction from a handful of columns."""
    margin = sum((F.col(c) * F.lit(float(w)) for c, w in zip(inputs, weights)), F.lit(0.0))
    return df.withColumn(out, margin)


def top_terms(weights: DataFrame, terms: DataFrame, k: int = 25) -> DataFrame:
    """The terms with the largest weights."""
    return weights.join(terms.select("term", "pos"), "pos").orderBy(F.desc("w"), "pos").limit(k)
