"""Metadata CSV and paper JSON sources, and the end-to-end corpus load.

Both readers take an explicit schema (nothing is inferred). JSON files are
read whole (one row per file, ``wholetext``) and parsed with ``from_json``
so that broken files and absent keys can be told apart from null values;
files are found recursively by suffix.

A file system takes milliseconds to make, list and open a file, so a million
papers are kept packed: ``pack_papers`` stores the files as rows of a few Parquet
files, which the same readers take with ``suffix=PACKED``.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import text as TX
from ..operators import features, filters, joins
from ..operators.keys import ordered_index

# Cells read as null in non-forced columns, the default markers
# of the CSV reader that wrote such files; forced-string columns keep blanks as ''.
NULL_TOKENS = ("", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN", "<NA>", "N/A",
               "NA", "NULL", "NaN", "None", "n/a", "nan", "null")
FORCED_STRING = ("pubmed_id", "Microsoft Academic Paper ID", "doi")

# Suffix by which the readers know packed papers.
PACKED = ".parquet"

SECTION = T.ArrayType(T.StructType([T.StructField("text", T.StringType())]))
PAPER_SCHEMA = T.StructType([
    T.StructField("paper_id", T.StringType()),
    T.StructField("metadata", T.StructType([T.StructField("title", T.StringType())])),
    T.StructField("abstract", SECTION),
    T.StructField("body_text", SECTION),
])


def read_metadata(spark: SparkSession, path: str, columns: Iterable[str] | None = None,
                  null_tokens: Iterable[str] = NULL_TOKENS, forced_string: Iterable[str] = FORCED_STRING) -> DataFrame:
    """Metadata CSV: header row, quoted fields with embedded commas and
    newlines. Every column is read as text (an explicit all-string schema);
    the first column is the row index and becomes ``row_no BIGINT``.

    Null markers become NULL except in ``forced_string`` columns, where a
    blank stays ``''``.
    """
    header = spark.read.option("header", False).option("multiLine", True).csv(path).limit(1).collect()
    names = list(columns) if columns is not None else [c if c is not None else "" for c in header[0]]
    schema = T.StructType([T.StructField(n or "_c0", T.StringType()) for n in names])
    raw = (
        spark.read.schema(schema).option("header", True).option("multiLine", True)
        .option("quote", '"').option("escape", '"').option("nullValue", "\u0000").option("emptyValue", "")
        .csv(path)
    )
    forced = set(forced_string)
    nulls = sorted(set(null_tokens))
    cols = []
    for i, n in enumerate(schema.names):
        c = F.col(f"`{n}`")
        if i == 0:
            cols.append(F.col(f"`{n}`").cast("bigint").alias("row_no"))
        elif n in forced:
            cols.append(F.coalesce(c, F.lit("")).alias(n))
        else:
            cols.append(F.when(c.isNull() | c.isin(*nulls), F.lit(None).cast("string")).otherwise(c).alias(n))
    return raw.select(*cols)


def _files(spark: SparkSession, path: str, suffix: str) -> DataFrame:
    """``(path, bytes, value)`` of every paper file, single or packed."""
    if suffix == PACKED:
        return spark.read.schema("path string, value string").parquet(path).select(
            "path", F.octet_length("value").cast("bigint").alias("bytes"), "value")
    # (``text()`` has its own ``wholetext=False`` default, so it is passed here.)
    files = spark.read.text(path, wholetext=True, recursiveFileLookup=True, pathGlobFilter=f"*{suffix}")
    return files.select(F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_size").alias("bytes"), "value")


def _parsed_papers(spark: SparkSession, path: str, suffix: str) -> DataFrame:
    """One row a file: its path, size, parsed paper ``p`` and ``reason``, null for a usable one."""
    parsed = _files(spark, path, suffix).select(
        "path", "bytes",
        F.from_json("value", PAPER_SCHEMA, {"mode": "PERMISSIVE"}).alias("p"),
        F.json_object_keys("value").alias("keys"),
        F.json_object_keys(F.get_json_object("value", "$.metadata")).alias("meta_keys"),
    )
    reason = F.when(F.col("keys").isNull(), "not a JSON object")
    for key in ("paper_id", "abstract", "body_text", "metadata"):
        reason = reason.when(~F.array_contains("keys", key), f"no {key}")
    reason = reason.when(~F.coalesce(F.array_contains("meta_keys", "title"), F.lit(False)), "no metadata.title")
    for key in ("paper_id", "abstract", "body_text"):
        reason = reason.when(F.col(f"p.{key}").isNull(), f"{key} is null or of another type")
    for key in ("abstract", "body_text"):
        reason = reason.when(F.exists(f"p.{key}", lambda s: s["text"].isNull()), f"{key} has a section without text")
    return parsed.select("path", "bytes", "p", reason.alias("reason"))


def read_papers(spark: SparkSession, path: str, suffix: str = ".json") -> DataFrame:
    """``(paper_id, title, abstract, body_text)`` from nested paper JSON.

    A file is skipped when it is not valid JSON, when ``paper_id``,
    ``abstract``, ``body_text`` or ``metadata.title`` is absent, when
    ``paper_id`` is null, or when a section entry has no text. A present
    but null title is kept. Section texts are joined with newlines. What is
    skipped, and why, is told by ``bad_files``.
    """
    return _parsed_papers(spark, path, suffix).where(F.col("reason").isNull()).select(
        F.col("p.paper_id").alias("paper_id"),
        F.col("p.metadata.title").alias("title"),
        F.array_join(F.transform("p.abstract", lambda s: s["text"]), "\n").alias("abstract"),
        F.array_join(F.transform("p.body_text", lambda s: s["text"]), "\n").alias("body_text"),
    )


def bad_files(spark: SparkSession, path: str, suffix: str = ".json") -> DataFrame:
    """``(path, bytes, reason)`` of every file that ``read_papers`` skips: the
    first of its reasons, in the order of the checks. Files of no bytes at all are
    not listed, as Spark's file sources pass them over."""
    return _parsed_papers(spark, path, suffix).where(F.col("reason").isNotNull()).select("path", "bytes", "reason")


def _paper_json(papers: DataFrame) -> Column:
    section = [F.array(F.struct(F.col(c).alias("text"))).alias(c) for c in ("abstract", "body_text")]
    value = F.to_json(F.struct("paper_id", F.struct("title").alias("metadata"), *section), {"ignoreNullFields": "false"})
    return F.coalesce("raw", value) if "raw" in papers.columns else value


def write_papers(papers: DataFrame, path: str) -> None:
    """One file a paper (``paper_id, title, abstract, body_text``), below a folder
    named by its id, as ``read_papers`` reads them with ``suffix='.txt'``; a column
    ``raw``, if there is one, is written instead where it isn't null."""
    papers.select(F.col("paper_id").alias("paper"), _paper_json(papers).alias("value")).write.partitionBy("paper").text(path)


def pack_papers(papers: DataFrame, path: str) -> None:
    """The files of ``write_papers`` as rows ``(path, value)``, some ten thousands to a
    Parquet file, as the readers take them with ``suffix=PACKED``. As there, rows of
    one paper that a task holds are lines of one file."""
    paper = F.coalesce(F.col("paper_id"), F.lit("__HIVE_DEFAULT_PARTITION__"))
    lines = papers.select(paper.alias("paper"), F.spark_partition_id().alias("part"),
                          F.struct(F.monotonically_increasing_id().alias("line"), _paper_json(papers).alias("value")).alias("l"))
    value = F.array_join(F.transform(F.array_sort(F.collect_list("l")), lambda e: e["value"]), "\n")
    files = lines.groupBy("paper", "part").agg(F.concat(value, F.lit("\n")).alias("value"))
    name = F.format_string("paper=%s/part-%05d.txt", "paper", "part")
    files.select(name.alias("path"), "value").write.parquet(path)


def write_metadata(meta: DataFrame, path: str) -> None:
    """Metadata as ``read_metadata`` reads it; the first column is the row index."""
    meta.write.option("header", True).option("quoteAll", True).option("escape", '"').option(
        "ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path)


DOCUMENT_COLUMNS = ("paper_id", "publish_time", "doi", "abstract", "body_text", "authors", "title", "journal",
                    "abstract_summary")


def paper_documents(papers: DataFrame, meta: DataFrame, strict: bool = False) -> DataFrame:
    """The nine-column document table: papers joined to the first metadata
    row of their ``sha`` (by ``row_no``), empty bodies dropped, summary,
    author list, title and date derived, then rows with any null dropped.

    An unparsable publication date becomes null and the row is dropped;
    ``strict=True`` raises ``ValueError`` instead when any matched paper
    has a missing or unparsable date."""
    body_ok = filters.drop_empty(papers, "body_text").select("paper_id", "abstract", "body_text")
    m = meta.select("sha", "row_no", "authors", "title", "journal", "doi", "publish_time")
    j = joins.first_match_join(body_ok, m, "paper_id", "sha", ["row_no"])
    doc = j.select(
        "paper_id",
        TX.parse_pub_date("publish_time").alias("publish_time"),
        "doi", "abstract", "body_text",
        TX.abbreviate_list("authors", ";", 2).alias("authors"),
        TX.truncate_words("title", 40).alias("title"),
        "journal",
        TX.summary_or_body("abstract", "body_text", 100).alias("abstract_summary"),
        F.col("publish_time").alias("_pub_text"),
    )
    if strict:
        bad = doc.where(F.col("publish_time").isNull()).select("paper_id", "_pub_text").limit(5).collect()
        if bad:
            raise ValueError(f"unparsable publication dates: {[(r[0], r[1]) for r in bad]}")
    return filters.drop_null_rows(doc.drop("_pub_text"), DOCUMENT_COLUMNS)


def load_corpus(spark: SparkSession, meta_path: str, papers_path: str, stopwords,
                profiles: DataFrame | None = None, lang: str | None = "en", suffix: str = ".json") -> DataFrame:
    """Metadata + papers -> document table -> language -> cleaned text ->
    ``doc_num`` (0-based, in ``paper_id`` order).

    ``profiles`` are trained language profiles (``train_language_profiles``)
    and are needed to keep the documents of one language; only ``lang=None``
    keeps every document (``language`` is then null).
    """
    from ..operators.language import identify_language

    if lang is not None and profiles is None:
        raise ValueError("keeping one language needs language profiles; pass lang=None to keep all documents")
    doc = paper_documents(read_papers(spark, papers_path, suffix), read_metadata(spark, meta_path))
    if lang is not None:
        pred = identify_language(doc, "paper_id", "body_text", profiles, summary="abstract_summary").select(
            "paper_id", F.col("lang_pred").alias("language")
        )
        doc = filters.filter_language(doc.join(pred, "paper_id"), "language", lang)
    else:
        doc = doc.withColumn("language", F.lit(None).cast("string"))
    # numbered first: the sort's sample then reads papers, not their tokens
    doc = features.clean_text(
        ordered_index(doc, ["paper_id"], name="doc_num"),
        {"title": "processed_title", "abstract": "processed_abstract", "body_text": "processed_text"}, stopwords
    )
    return doc.select(*[c for c in doc.columns if c != "doc_num"], "doc_num")
