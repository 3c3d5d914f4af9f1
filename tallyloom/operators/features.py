"""Term weights of documents in long form: ``doc_id, doc_len, pos, value``.

A dense vector would cost one double per dictionary word and document; the long
form costs one row per distinct word of the document.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from tallyloom.functions.once import each
from tallyloom.operators.lookup import small
from tallyloom.operators.vocabulary import dictionary, term_statistics
from tallyloom.session import settled


def positions(docs: DataFrame, terms: DataFrame, key: str = "doc_id", words: str = "words",
              tf: str = "presence", carry: Sequence[str] = (), extra: Sequence[str] = ()) -> DataFrame:
    """One row per document and dictionary word, with its weight ``value``.

    ``presence`` (default) weighs each distinct word ``1/doc_len``; ``count`` weighs
    ``count/doc_len``.  ``doc_len`` counts all words, also those outside the
    dictionary.  Copies inside a document are removed inside the row, so this
    shuffles nothing; the dictionary is bounded by its size and Spark broadcasts it.
    """
    base = docs.select(key, *carry, F.size(words).cast("long").alias("doc_len"), F.col(words).alias("_w"))
    if tf == "presence":
        long = base.select(key, *carry, "doc_len", F.explode(F.array_distinct("_w")).alias("term"))
        weight = F.lit(1.0) / F.col("doc_len")
    elif tf == "count":
        long = (
            each(base, "_w", "term", key, *carry, "doc_len")
            .groupBy(key, *carry, "doc_len", "term")
            .agg(F.count("*").alias("_n"))
        )
        weight = F.col("_n") / F.col("doc_len")
    else:
        raise ValueError("tf must be 'presence' or 'count'")
    return (
        long.join(terms.select("term", "pos", *extra), "term")
        .select(key, *carry, "doc_len", "pos", weight.alias("value"), *extra)
    )


def position_lists(features: DataFrame, key: str = "doc_id") -> DataFrame:
    """Dictionary positions of each document as one sorted array (output form only).
    An array has at most one entry per dictionary word."""
    return features.groupBy(key, "doc_len").agg(F.array_sort(F.collect_list("pos")).alias("positions"))


def document_frequency(features: DataFrame) -> DataFrame:
    """``pos, df``; features hold a document and position at most once."""
    return features.groupBy("pos").agg(F.count("*").alias("df"))


def idf(frequency, n_docs):
    """``ln(N / (1 + df))``: negative when a word is in every document."""
    return F.log(n_docs / (F.lit(1.0) + frequency))


def weigh(features: DataFrame, frequencies: DataFrame, n_docs) -> DataFrame:
    """Multiply weights by the inverse document frequency.  ``n_docs`` is a number or a scalar subquery.

    The frequencies (a row per dictionary word) are kept and counted, and
    broadcast when few enough: the features then stay where they are.
    """
    factors = small(settled(frequencies.select("pos", "df"))).select("pos", idf(F.col("df"), n_docs).alias("_idf"))
    return features.join(factors, "pos").withColumn("value", F.col("value") * F.col("_idf")).drop("_idf")


def row_total(df: DataFrame):
    """Row count as a scalar subquery."""
    return df.agg(F.count("*").cast("double").alias("n")).scalar()


def training_dictionary(docs: DataFrame, size: int = 20000, words: str = "words") -> DataFrame:
    """``term, n, df, pos`` of the training documents, from one scan of the text."""
    return dictionary(term_statistics(docs, words), size)


def training_weights(docs: DataFrame, terms: DataFrame, key: str = "doc_id", carry: Sequence[str] = (),
                     use_idf: bool = True, n_docs=None) -> DataFrame:
    """TF-IDF (or TF) of the documents the dictionary was made from; N counts all of them."""
    if not use_idf:
        return positions(docs, terms, key, carry=carry)
    weighted = terms.withColumn("_idf", idf(F.col("df"), row_total(docs) if n_docs is None else n_docs))
    features = positions(docs, weighted, key, carry=carry, extra=["_idf"])
    return features.withColumn("value", F.col("value") * F.col("_idf")).drop("_idf")


def scoring_features(docs: DataFrame, terms: DataFrame, key: str = "doc_id", carry: Sequence[str] = (),
                     idf_from: str = "test", n_train=None) -> DataFrame:
    """TF-IDF of further documents with the training dictionary.

    ``idf_from='test'`` (default): frequencies and N come from these documents,
    N counting only documents with a dictionary word.  ``'train'``: the
    dictionary's own frequencies and ``n_train``.  ``'none'``: plain TF.
    """
    if idf_from == "train":
        return training_weights(docs, terms, key, carry, n_docs=n_train)
    out = positions(docs, terms, key, carry=carry)
    if idf_from == "none":
        return out
    # read three times: by the frequencies, by N and by the result
    out = settled(out)
    with_word = out.agg(F.count_distinct(key).cast("double").alias("n")).scalar()
    return weigh(out, document_frequency(out), with_word)
