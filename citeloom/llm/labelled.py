"""Bounded samples of labelled documents, for the trained classifiers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def fold(id_col: Column, folds: int) -> Column:
    """crc32 of the id as text, modulo `folds`; a null id counts as the text `null`."""
    return F.crc32(F.coalesce(id_col.cast("string"), F.lit("null")).cast("binary")) % folds


def sample(docs: DataFrame, labels: DataFrame, label: str, usable: Column, most: dict[int, int], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, text and label of at most `most[y]` documents of each class, chosen by a hash of the id.

    `usable` is a condition on the labels' rows. The chosen ids are bounded by
    `most`, so they are broadcast; the documents are read once and not moved.
    An id that several documents share brings them all, so the bound is put on
    the joined rows again: of equal ids the least texts by hash, then by text.
    """
    chosen = None
    for y, n in sorted(most.items()):
        rows = labels.where(usable & (F.col(label) == y)).select(F.col(id_col).alias("doc_id"), F.col(label).cast("int").alias("label")).where("doc_id IS NOT NULL").dropDuplicates(["doc_id"])
        part = rows.orderBy(F.xxhash64("doc_id"), "doc_id").limit(n)
        chosen = part if chosen is None else chosen.unionByName(part)
    texts = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    joined = texts.join(F.broadcast(chosen), "doc_id").select("doc_id", "text", "label")
    order = Window.partitionBy("label").orderBy(F.xxhash64("doc_id"), "doc_id", F.xxhash64("text"), "text")
    bound = F.element_at(F.create_map(*[F.lit(x) for item in sorted(most.items()) for x in item]), F.col("label"))
    return joined.withColumn("__nth", F.row_number().over(order)).where((F.col("__nth") <= max(most.values())) & (F.col("__nth") <= bound)).drop("__nth")
