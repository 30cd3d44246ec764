"""What the operators share: native text columns, lineage cuts, size-checked broadcasts."""

from __future__ import annotations

import tempfile
import uuid
import warnings

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: The white space that separates words: space, tab, line feed, vertical tab, form feed, carriage return.
SPACE = " \t\n\x0b\x0c\r"
SPACE_CLASS = "[\\x20\\x09-\\x0D]"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The checkpoint folder that driver and executors share; a local one only in local mode where none is set."""
    sc = spark.sparkContext
    if not sc.getCheckpointDir():
        named = sc.getConf().get("spark.checkpoint.dir", None)
        if not named:
            if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
                raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
            warnings.warn("spark.checkpoint.dir isn't set; a temporary folder of this machine is used", stacklevel=2)
            named = tempfile.mkdtemp(prefix="strandline-")
        sc.setCheckpointDir(named)
    return sc.getCheckpointDir()


#: Spark's setting that removes an execution's shuffle files as soon as it has ended.
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def cut(df: DataFrame) -> DataFrame:
    """Write df to the shared checkpoint folder and go on from there; the shuffle files that led to it are removed."""
    spark = df.sparkSession
    shared_folder(spark)
    before = spark.conf.get(_CLEANUP, None)
    spark.conf.set(_CLEANUP, "true")
    try:
        return df.select("*").checkpoint(eager=True)  # a plan of its own, made under the setting
    finally:
        spark.conf.unset(_CLEANUP) if before is None else spark.conf.set(_CLEANUP, before)


def scratch(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder, which the file system removes when the driver ends."""
    path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(target)
    return path


def remove(spark: SparkSession, path: str) -> None:
    """Remove a path of ``scratch`` before that."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def written(df: DataFrame, name: str) -> DataFrame:
    """df as a Parquet table in the shared folder: columns that a later step doesn't need aren't read again."""
    path = scratch(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def gathered(df: DataFrame, rows: int, each: int = 200_000) -> DataFrame:
    """df in as few partitions as hold ``each`` of its counted rows; a few rows aren't dealt over all tasks."""
    return df.coalesce(rows // each + 1)


def small(df: DataFrame, rows: int, limit: int = 200_000) -> DataFrame:
    """Broadcast df if its counted rows stay below limit; else leave the join to Spark."""
    return F.broadcast(df) if rows <= limit else df


def words(text: Column) -> Column:
    """Array of the words of a text; empty for null."""
    bare = F.btrim(text, F.lit(SPACE))
    return F.when(F.coalesce(F.length(bare), F.lit(0)) == 0, F.array().cast("array<string>")).otherwise(F.split(bare, f"{SPACE_CLASS}+"))


def word_count(text: Column) -> Column:
    """Number of words of a text as a long; 0 for null."""
    bare = F.btrim(text, F.lit(SPACE))
    return F.when(F.coalesce(F.length(bare), F.lit(0)) == 0, F.lit(0)).otherwise(F.size(F.split(bare, f"{SPACE_CLASS}+"))).cast("long")


def remainder(id_col: str, of: int) -> Column:
    """crc32 of an id as text, modulo ``of``; a null id counts as the empty text."""
    return F.coalesce(F.crc32(F.col(f"`{id_col}`").cast("string").cast("binary")), F.lit(0)) % of
