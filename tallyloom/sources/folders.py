"""Folders whose sub-folder names are the class labels."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F


def _class_of(path: Column) -> Column:
    return F.element_at(F.split(path, "/"), -2)


def _number(label: Column, class_names: Sequence[str]) -> Column:
    return F.array_position(F.array(*[F.lit(n) for n in class_names]), label).cast("int") - 1


def labelled_texts(spark: SparkSession, root: str, glob: str = "*.txt",
                   class_names: Sequence[str] | None = None) -> DataFrame:
    """``path, label, text``: one row per file.  The glob keeps stray files out; nothing is deleted.

    With ``class_names`` only those folders count and ``label_id`` follows their order.
    """
    files = (
        spark.read.text(root, wholetext=True, recursiveFileLookup=True, pathGlobFilter=glob)
        .select(F.col("_metadata.file_path").alias("path"), F.col("value").alias("text"))
        .select("path", _class_of(F.col("path")).alias("label"), "text")
    )
    if class_names is None:
        return files
    return files.where(F.col("label").isin(list(class_names))).withColumn("label_id", _number(F.col("label"), class_names))


def labelled_files(spark: SparkSession, root: str, glob: str = "*", class_names: Sequence[str] | None = None) -> DataFrame:
    """``path, modificationTime, length, content, label`` of binary files.

    Counting needs only ``path``: the reader then never opens the content.
    """
    files = (
        spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", glob).load(root)
        .withColumn("label", _class_of(F.col("path")))
    )
    if class_names is None:
        return files
    return files.where(F.col("label").isin(list(class_names))).withColumn("label_id", _number(F.col("label"), class_names))


def without_files(files: DataFrame, *names: str) -> DataFrame:
    """Drop files by name (any case) where a glob cannot say it."""
    name = F.lower(F.element_at(F.split("path", "/"), -1))
    return files.where(~name.isin([n.lower() for n in names]))
