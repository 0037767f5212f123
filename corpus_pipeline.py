"""The corpus pipeline: documents through the operators, stage by stage.

``STAGES`` lists (name, function); each function takes (spark, docs, sf_dir)
and returns a DataFrame, which is written as Parquet and read again as the
next stage's docs. All but the last return the columns of docs; further
columns of any name pass through.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textquarry.llm import decontaminate, language_id, mixing, pii, simhash_dedup
from textquarry.llm.common import Store, fresh
from textquarry.operators.joins import checked_broadcast
from textquarry.session import read_table


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is found stay.

    Rejected is what the operator calls ``und``: null texts and texts without
    a letter. A low score alone rejects nothing, as short clean texts have
    one. The network is trained on the labelled rows of docs.
    """
    model = language_id.train(language_id.learnable(docs))
    name = fresh(docs.columns, "_language")
    scored = docs.withColumn(name, language_id.predict(F.col("text").cast("string"), model))
    return scored.where(F.col(f"{name}.lang") != language_id.UND).drop(name)


def _numbered(spark: SparkSession, docs: DataFrame) -> tuple[DataFrame, str]:
    """``docs`` written once with a number for every row, and the number's name.

    Decisions name rows, not documents: rows may share a doc_id or have none.
    The numbers are read back, so they stay whatever is computed again.
    """
    row = fresh(docs.columns, "_row")
    return Store(spark, "rows").put(docs.withColumn(row, F.monotonically_increasing_id())), row


def _without(rows: DataFrame, row: str, dropped: DataFrame) -> DataFrame:
    """The rows whose numbers aren't in ``dropped``; texts are shuffled only
    if the numbers are too many to be broadcast."""
    gone = checked_broadcast(dropped.select(F.col(row).alias("_gone")))
    return rows.join(gone, rows[row] == gone["_gone"], "left_anti").drop(row)


def simhash_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each SimHash group stays: the one with the smallest doc_id.

    Rows without a doc_id come after those with one, rows of the same doc_id
    in the order of a hash of their text. So a text that shares its doc_id
    with another one stays, and so does exactly one of equal rows.
    """
    rows, row = _numbered(spark, docs)
    groups = simhash_dedup.simhash_groups(rows, id_col=row, shingle=4, max_bits=4)
    named = rows.select(F.col(row).alias("_id"), F.struct(
        F.col("doc_id").isNull(), F.col("doc_id"), F.xxhash64(F.col("text").cast("string")), F.col(row)).alias("_place"))
    first = (
        groups.join(named, groups["doc_id"] == named["_id"])
        .groupBy("component_id").agg(F.min("_place").alias("_place")).select(F.col(f"_place.{row}").alias("_kept"))
    )
    dropped = groups.select(F.col("doc_id").alias(row)).join(first, F.col(row) == F.col("_kept"), "left_anti")
    return _without(rows, row, dropped)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that hold an item of ``benchmark`` go, those without a doc_id as well."""
    rows, row = _numbered(spark, docs)
    found = decontaminate.leaks(rows, read_table(spark, sf_dir, "benchmark"), id_col=row)
    return _without(rows, row, found.select(F.col("doc_id").alias(row)).distinct())


def pii_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents stay, with surrogates for personal data; n_chars
    follows the new text where something was replaced."""
    found = fresh(docs.columns, "_types")
    out = pii.surrogates(docs, found_col=found)
    if "n_chars" in docs.columns:
        n = F.when(F.size(found) > 0, F.length("text")).otherwise(F.col("n_chars"))
        out = out.withColumn("n_chars", n.cast(docs.schema["n_chars"].dataType))
    return out.drop(found)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix: a row for every repetition taken, see ``mixing.materialise``."""
    return mixing.materialise(docs)


STAGES = [
    ("language_id", language_stage),
    ("simhash_dedup", simhash_stage),
    ("decontaminate", decontamination_stage),
    ("pii", pii_stage),
    ("mixing", mixing_stage),
]

# A trained network, hashes by task and keyed surrogates are beyond SQL; tests
# hold every stage against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on ``documents``; what a stage keeps is stored before the next reads it."""
    store = Store(spark, "pipeline")
    docs = read_table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = store.put(docs)
    return docs
