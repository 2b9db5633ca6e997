"""Bounded samples of labelled rows for fitting; the bounds are parameters."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Row, Window
from pyspark.sql import functions as F


#: Standard deviations of a sample's size that are ordered beyond it; most different labels, those of most rows.
SPARE, MOST_LABELS = 8, 300


def crc_part(key: str, n: int) -> Column:
    """crc32 of the key as text, modulo n; null for a null key."""
    return F.crc32(F.col(key).cast("string").cast("binary")) % n


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, per_label: int, most_chars: int) -> list[Row]:
    """At most per_label texts of at most most_chars characters for each label, lowest hashes of doc_id first.

    labels has doc_id and the label. What is chosen depends on the ids alone, and its size on the bounds alone, with
    MOST_LABELS labels at most, so the chosen ids are broadcast; the texts come back as (label, text) rows in order of doc_id.

    No task meets all of a label's rows: they are counted, and only hashes under the share that holds per_label rows
    and SPARE deviations more are put in order. If few ids make up a label's rows, fewer than per_label may come back.
    """
    ids = labels.where(F.col(label).isNotNull() & F.col("doc_id").isNotNull()).select("doc_id", F.col(label).alias(label)).withColumn("h", F.xxhash64(F.col("doc_id"), F.lit(17)))
    top = F.lit(per_label + SPARE * per_label**0.5) / F.col("n")
    share = ids.groupBy(label).agg(F.count("*").alias("n")).orderBy(F.desc("n"), label).limit(MOST_LABELS).select(label, F.when(top < 1, (top * 2.0**64 - 2.0**63).cast("long")).otherwise(F.lit((1 << 63) - 1)).alias("most"))
    order = Window.partitionBy(label).orderBy("h", "doc_id")
    some = ids.join(F.broadcast(share), label).where("h <= most")  # at most MOST_LABELS rows
    chosen = some.withColumn("n", F.row_number().over(order)).where(F.col("n") <= per_label).select("doc_id", label)
    texts = docs.where(F.length("text") <= most_chars).select("doc_id", "text").join(F.broadcast(chosen), "doc_id")
    return sorted(texts.select("doc_id", label, "text").distinct().collect(), key=lambda r: (r[0], str(r[1]), r[2]))
