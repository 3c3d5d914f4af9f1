"""Word counts, dictionaries and first-appearance ids."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from tallyloom.functions.once import each
from tallyloom.functions.stemming import with_stem
from tallyloom.functions.text import STOP_WORDS
from tallyloom.operators.ordered import row_index


def term_counts(docs: DataFrame, words: str = "words") -> DataFrame:
    """``term, n``: how often each word occurs.  Counted per partition before the shuffle, so a
    word that fills a third of the text costs one row per partition."""
    return each(docs, words, "term").groupBy("term").agg(F.count("*").alias("n"))


def term_statistics(docs: DataFrame, words: str = "words") -> DataFrame:
    """``term, n, df``: occurrences and number of documents, in one scan.

    Sorting the words inside the row marks the first copy of each, so the
    document frequency is a sum of marks and needs no (document, word) shuffle.
    """
    ordered = docs.select(F.array_sort(words).alias("_w"))
    marked = F.transform(
        "_w", lambda w, i: F.struct(w.alias("term"), ((i == 0) | (F.get("_w", i - 1) != w)).cast("long").alias("first"))
    )
    return (
        ordered.select(F.inline(marked))
        .groupBy("term")
        .agg(F.count("*").alias("n"), F.sum("first").alias("df"))
    )


def dictionary(counts: DataFrame, size: int = 20000, first_id: int = 0, id_name: str = "pos") -> DataFrame:
    """The ``size`` most frequent terms with consecutive ids (ties by term).

    Fewer distinct terms give a smaller dictionary.  Top-k keeps ``size`` rows
    per task; only those reach the one task that numbers them.
    """
    top = counts.orderBy(F.desc("n"), "term").limit(size)
    rank = F.row_number().over(Window.orderBy(F.desc("n"), "term"))
    return top.withColumn(id_name, (rank + F.lit(first_id - 1)).cast("int"))


def tagger_vocabulary(counts: DataFrame, max_words: int = 36000) -> DataFrame:
    """``term, id`` from 1 by frequency; only ids below ``max_words`` exist, 0 is padding."""
    return dictionary(counts, max_words - 1, first_id=1, id_name="id").select("term", "id")


def text_vocabulary(counts: DataFrame, max_tokens: int = 10000) -> DataFrame:
    """``term, id`` from 2 by frequency; 0 is padding and 1 the unknown word, both part of ``max_tokens``."""
    return dictionary(counts, max_tokens - 2, first_id=2, id_name="id").select("term", "id")


def vocabulary_size(counts: DataFrame, approximate: bool = False) -> DataFrame:
    size = F.approx_count_distinct("term") if approximate else F.count_distinct("term")
    return counts.agg(size.alias("terms"))


def stemmed_counts(counts: DataFrame, stop=STOP_WORDS) -> DataFrame:
    """Word counts to stem counts: each *distinct* word is stemmed once, then stop words go."""
    return (
        with_stem(counts, "term")
        .where(~F.col("stem").isin(list(stop)))
        .groupBy(F.col("stem").alias("term"))
        .agg(F.sum("n").alias("n"))
    )


def stem_documents(docs: DataFrame, key: str = "doc_id", words: str = "words", stop=STOP_WORDS) -> DataFrame:
    """Replace each document's words by their stems without stop words.

    One shuffle, grouped by document before it leaves the task.  ``key`` must be
    unique; a document without words keeps an empty array.
    """
    other = [c for c in docs.columns if c not in (key, words)]
    tokens = with_stem(docs.select(key, *other, F.explode_outer(words).alias("_t")), "_t", "_s")
    kept = F.when(~F.col("_s").isin(list(stop)), F.col("_s"))
    return tokens.groupBy(key).agg(
        *[F.first(c).alias(c) for c in other], F.collect_list(kept).alias(words)
    ).select(*docs.columns)


def appearance_ids(df: DataFrame, value: str, order: str, out: str = "id") -> DataFrame:
    """Values with ids 0, 1, ... by first appearance in ``order``."""
    first = df.groupBy(value).agg(F.min(order).alias("_first"))
    numbered = row_index(first, ["_first", value], "_i")
    return numbered.select(value, (F.col("_i") - 1).cast("int").alias(out))
