"""Word counts over a stream of documents.

The counting operator is the same grouped aggregation as the batch one;
on a streaming DataFrame it runs with Spark's state store in ``complete``
(or ``update``) output mode, so new files added to the source folder
update the counts incrementally.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from ..operators.counts import word_count

DOCUMENT_SCHEMA = T.StructType([
    T.StructField("doc_id", T.LongType()),
    T.StructField("text", T.StringType()),
    T.StructField("lang", T.StringType()),
    T.StructField("source", T.StringType()),
    T.StructField("n_chars", T.LongType()),
])


def document_stream(spark: SparkSession, folder: str, schema: T.StructType = DOCUMENT_SCHEMA,
                    max_files_per_trigger: int = 1) -> DataFrame:
    """Parquet files of a folder as a stream (explicit schema)."""
    return (
        spark.readStream.schema(schema).option("maxFilesPerTrigger", max_files_per_trigger)
        .parquet(folder)
    )


def streaming_word_count(stream: DataFrame, col: str = "text", stopwords=None) -> DataFrame:
    """Running ``(word, count)`` of a streaming text column."""
    return word_count(stream, col, stopwords)


def start_counts(stream_counts: DataFrame, checkpoint: str, query_name: str = "word_counts",
                 mode: str = "complete"):
    """Start the query into the in-memory sink (for inspection and tests);
    ``checkpoint`` must be a folder the cluster shares (state survives a
    lost executor or a restart)."""
    return (
        stream_counts.writeStream.outputMode(mode).format("memory").queryName(query_name)
        .option("checkpointLocation", checkpoint).start()
    )
