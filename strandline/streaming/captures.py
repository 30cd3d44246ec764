"""The capture pipeline on streams; every operator of it is stateless."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from strandline.config import DEFAULT, Config
from strandline.plans.documents import documents
from strandline.sources.captures import parse_files

FILES = "path string, modificationTime timestamp, length bigint, content binary"


def read_archives(spark: SparkSession, folder: str, glob: str = "*", files_at_once: int = 16) -> DataFrame:
    """Records of the archives that arrive in a folder."""
    files = spark.readStream.format("binaryFile").schema(FILES).option("pathGlobFilter", glob).option("maxFilesPerTrigger", files_at_once).load(folder)
    return parse_files(files)


def stream_documents(captures: DataFrame, config: Config = DEFAULT, delay: str = "1 hour") -> DataFrame:
    """Documents, each id once within the watermark's delay."""
    docs = documents(captures, config).withColumn("crawl_time", F.to_timestamp("crawl_date"))
    return docs.withWatermark("crawl_time", delay).dropDuplicatesWithinWatermark(["id"])


def counts_by_window(events: DataFrame, ts: str, key: str, size: str = "1 hour", delay: str = "2 hours") -> DataFrame:
    """Rows by window and key, for streams and tables alike."""
    return events.withWatermark(ts, delay).groupBy(F.window(ts, size).alias("window"), key).agg(F.count("*").alias("n")).select("window.start", key, "n")


def write_stream(docs: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    return docs.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
