"""Documents to training text: the operators of ``marginflow.llm`` one after another.

Each stage is ``(spark, docs, sf_dir) -> DataFrame``; ``docs`` is what the stage
before wrote. All but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marginflow.llm import decontaminate, line_dedup, mixing, near_dedup, toxicity
from marginflow.llm.queries import MIX_BUDGET, fit_toxicity, table
from marginflow.session import materialize

TOXIC_FROM = 0.7
SHINGLE_WORDS, LINK_PERCENT = 5, 80
BROADCAST_IDS = 1_000_000  # ids that may be broadcast (8 MB); more are joined by shuffle


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without documents whose score is ``TOXIC_FROM`` or more. Empty and null texts are scored like others."""
    model = fit_toxicity(docs, table(spark, sf_dir, "labels"))
    return toxicity.drop_toxic(docs, model, TOXIC_FROM).select(*docs.columns)


def drop_boilerplate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without boilerplate lines; documents of which nothing is left go, those that had no text stay."""
    cut = line_dedup.remove_boilerplate(docs).where("n_removed = 0 or trim(text) <> ''")
    if "n_chars" in docs.columns:
        cut = cut.withColumn("n_chars", F.when(F.col("n_removed") > 0, F.length("text")).otherwise(F.col("n_chars"))
                             .cast(docs.schema["n_chars"].dataType))
    return cut.select(*docs.columns)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest doc_id of each group of near copies; repeated rows once.

    Rows are told by doc_id and text: where an id repeats with another text, each row goes or stays by its own text.
    """
    repeated = docs.groupBy("doc_id").count().where("count > 1")
    if repeated.isEmpty():
        gone = materialize(near_dedup.near_duplicates(docs, SHINGLE_WORDS, LINK_PERCENT).where("not kept").select("doc_id"))
        if gone.count() <= BROADCAST_IDS:
            gone = F.broadcast(gone)
        return docs.join(gone, "doc_id", "left_anti").select(*docs.columns)
    # numbers in the order of doc_id stand for the rows
    rows = materialize(docs.dropDuplicates(["doc_id", "text"]).repartitionByRange("doc_id")
                       .sortWithinPartitions("doc_id", F.xxhash64("text"))
                       .withColumn("_near_row", F.monotonically_increasing_id()))
    classes = near_dedup.near_duplicates(rows.select(F.col("_near_row").alias("doc_id"), "text"), SHINGLE_WORDS, LINK_PERCENT)
    return rows.join(classes.where("kept").select(F.col("doc_id").alias("_near_row")), "_near_row").select(*docs.columns)


def drop_benchmark_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without documents that hold a passage of the benchmark."""
    return decontaminate.drop_contaminated(docs, table(spark, sf_dir, "benchmark")).select(*docs.columns)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents drawn by probabilities calibrated to ``MIX_BUDGET``, with topic, n_tokens, weight and probability."""
    return mixing.weigh(docs, mixing.fit_mixture(docs, MIX_BUDGET)).where("selected").drop("selected")


STAGES = [
    ("toxicity", drop_toxic),
    ("line_dedup", drop_boilerplate),
    ("near_dedup", drop_near_copies),
    ("decontamination", drop_benchmark_passages),
    ("mixing", mix_sources),
]

#: Learned scores, registers and alignments are not SQL: tests hold run() against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; what each but the last returns is written and read again."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
