"""Bounded samples of labelled documents, for training."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def remainder(doc_id: Column, fold: int) -> Column:
    """crc32 of the identifier's text, modulo ``fold`` (null for a null identifier)."""
    return F.crc32(doc_id.cast("string").cast("binary")) % F.lit(fold)


def lowest_hashes(keys: DataFrame, group: str, n: int) -> DataFrame:
    """About ``n`` rows of each group (all of a smaller one): those whose hash ``h`` lies in the lowest n-th part.

    ``keys`` has distinct (group, h) rows and ``h`` is a 64-bit hash, so a group's share follows from its row count and
    no group is ever sorted or gathered.  The counts, one row a group (a language or a label), are broadcast.
    """
    counts = keys.groupBy(group).agg(F.count("*").alias("n_rows")).withColumnRenamed(group, "g_name")
    return (keys.join(F.broadcast(counts), F.col(group) == F.col("g_name"))
            .where(F.col("h") / F.lit(2.0 ** 64) + 0.5 < F.lit(float(n)) / F.col("n_rows")).select(*keys.columns))


def labelled_sample(documents: DataFrame, labels: DataFrame, label: str, fold: int, held: int,
                    max_docs: int) -> tuple[tuple[int, ...], DataFrame] | None:
    """Classes and a sample (label, text) of the labelled rows outside the held-out fold.

    The sample takes about ``max_docs`` different texts of each label, those with the lowest hashes, so it depends neither
    on the layout of the data nor on its size.  Rows with a null or empty text or a null label don't take part.  None
    if fewer than two labels occur; any number of them takes part.
    """
    marked = (labels.select(F.col("doc_id").alias("l_doc"), F.col(label).cast("int").alias("label"))
              .where(F.col("label").isNotNull() & (remainder(F.col("l_doc"), fold) != held)).distinct())
    classes = tuple(sorted(r["label"] for r in marked.select("label").distinct().collect()))   # the model's outputs
    if len(classes) < 2:
        return None
    texts = documents.select("doc_id", "text").where(F.length("text") > 0).withColumn("h", F.xxhash64("text"))
    rows = (texts.select("doc_id", "h").join(marked, F.col("doc_id") == F.col("l_doc"))
            .groupBy("label", "h").agg(F.min("doc_id").alias("s_doc")))
    # about max_docs rows of three numbers a label; broadcast, so that the texts are not shuffled for them
    chosen = lowest_hashes(rows, "label", max_docs).select("label", "s_doc", F.col("h").alias("s_hash"))
    sample = texts.join(F.broadcast(chosen), (F.col("doc_id") == F.col("s_doc")) & (F.col("h") == F.col("s_hash")))
    return classes, sample.select("label", "text")
