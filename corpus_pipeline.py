"""The corpus pipeline: quality, line dedup, near dedup, decontamination, encoding.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written and read again as the next one's
docs; all but the last return the columns of documents.

Every stage takes rows with nulls in any column, empty and very long texts, repeated rows, and an empty table, which
gives an empty one. A row with a null doc_id stays in all filters, as no decision can name it. Rows that repeat a doc_id
share its decisions. Columns beyond those of documents are left out. What each stage does with null and empty texts is
in its docstring.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docquarry.llm.bpe import default_path, digests, encode_decode
from docquarry.llm.decontaminate import contaminated
from docquarry.llm.line_dedup import remove_repeated_lines
from docquarry.llm.near_dedup import near_duplicates
from docquarry.llm.quality import fit_on, score_quality
from docquarry.llm.sampling import crc_part
from docquarry.llm.shared import kept

#: The least similarity of near duplicates; op9's own is higher.
NEAR_PERCENT = 80
COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier does not reject (a score of 0.5 stays); null and empty texts are scored as an empty passage."""
    model = fit_on(docs, spark.read.parquet(f"{sf_dir}/labels.parquet").where(crc_part("doc_id", 3) != 1))
    rejected = score_quality(docs, model).where("score < 0.5 and doc_id is not null").select("doc_id")
    return docs.join(rejected.distinct(), "doc_id", "left_anti").select(*COLUMNS)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the later runs of repeated lines; n_chars follows the text.

    A document of which no word is left repeats others as a whole, and goes. Null texts, and texts that were empty or
    blank before, stay as they are.
    """
    made = remove_repeated_lines(docs)
    cut = F.col("n_removed") > 0
    made = made.where(~(cut & ~F.col("text").rlike(r"[^\x20\x09-\x0D]")) | F.col("text").isNull())
    return made.withColumn("n_chars", F.when(cut, F.length("text").cast("long")).otherwise(F.col("n_chars"))).select(*COLUMNS)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates of a similarity of NEAR_PERCENT or more, that of the least doc_id;
    null, empty and blank texts have no shingles and stay."""
    dropped = near_duplicates(docs, NEAR_PERCENT).where("not kept").select("doc_id")
    return docs.join(dropped.distinct(), "doc_id", "left_anti").select(*COLUMNS)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item; null and empty texts hold none."""
    leaks = contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet")).select("doc_id").distinct()
    return docs.join(leaks, "doc_id", "left_anti").select(*COLUMNS)


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Digests of the ids and of the decoded text of each document, one row for each row; null and empty texts have no ids."""
    return digests(encode_decode(docs, default_path()))


STAGES = [("quality", quality), ("lines", lines), ("near", near), ("decontamination", decontamination), ("encoding", encoding)]

#: Learned scores and the Hamming join are beyond SQL; the stages are tested one by one.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents, each one's result written to the shared folder and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = kept(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
