"""Tables in the shared folder that spark.checkpoint.dir names."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows of a key from which it is hot, unless a greater number is needed to have MOST_HOT hot keys at most.
HOT_ROWS, MOST_HOT = 1000, 10_000


def shared_folder(spark: SparkSession) -> str:
    """The session's spark.checkpoint.dir; only where it is unset (local mode, tests) a folder of this machine."""
    at = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if not at:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        at = tempfile.mkdtemp(prefix="checkpoints-")
        spark.conf.set("spark.checkpoint.dir", at)
    return at.rstrip("/")


def kept(df: DataFrame, name: str) -> DataFrame:
    """The frame written to the shared folder and read again: its lineage ends there, and lost executors lose nothing of it.

    All tables of an application are in one folder named after it, so a job can remove what a finished one has left.
    """
    spark = df.sparkSession
    at = f"{shared_folder(spark)}/docquarry-{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(at)
    out = spark.read.schema(df.schema).parquet(at)
    out.kept_at = at
    return out


def discard(*tables: DataFrame) -> None:
    """Removes tables of ``kept`` that nothing will read again: what was made from them must be written by now."""
    for t in tables:
        context = t.sparkSession.sparkContext
        path = context._jvm.org.apache.hadoop.fs.Path(t.kept_at)
        path.getFileSystem(context._jsc.hadoopConfiguration()).delete(path, True)


def join_counted(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """The inner join of left with right, which has one row for each key and n, how many rows of left have it (or more).

    A key of very many rows would put all of them into one task. Keys of more than a MOST_HOT-th of all rows are
    fewer than MOST_HOT, so their rows of right are broadcast to wherever left's are; the others are shuffled. left is
    read twice then, so it should be a table or near one.
    """
    total, most = right.agg(F.coalesce(F.sum("n"), F.lit(0)), F.coalesce(F.max("n"), F.lit(0))).first()
    limit = max(HOT_ROWS, total // MOST_HOT)
    if most <= limit:
        return left.join(right.drop("n"), keys)
    hot = right.where(F.col("n") > limit).drop("n")
    rest = left.join(F.broadcast(hot.select(*keys)), keys, "left_anti").join(right.where(F.col("n") <= limit).drop("n"), keys)
    return left.join(F.broadcast(hot), keys).unionByName(rest)
