"""Contiguous shards of equal bytes, from prefix sums over range partitions.

Documents are put in one global order, the order is cut into range partitions, each partition's total gives
the offset of the next, and a document's shard is the equal share of all bytes that its midpoint falls in.
Only ids, sizes and checksums move; no task sees more than one range.

Nulls: a null text has no bytes; null ids come first in the order. Repeated rows are interchangeable and take
neighbouring slots. An empty table gives an empty result. Other columns are ignored unless named in ``keep``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strandline.llm._common import cut

OVERHEAD = 16


def assign(docs: DataFrame, n_shards: int = 40, id_col: str = "doc_id", text_col: str = "text", keep: Sequence[str] = ()) -> DataFrame:
    """A row per document: its id, size, text_crc32, shard and slot, and the columns of ``keep``.

    The order is by id, checksum and size, then by place in the input, so a hot id is split like any other rows.
    """
    text = F.col(f"`{text_col}`")
    rows = docs.select(
        F.col(f"`{id_col}`").alias("_id"),
        (F.coalesce(F.octet_length(text), F.lit(0)).cast("long") + OVERHEAD).alias("_size"),
        F.coalesce(F.crc32(text.cast("binary")), F.lit(0)).cast("long").alias("_crc"),
        F.monotonically_increasing_id().alias("_row"),
        *[F.col(f"`{c}`").alias(f"_keep_{i}") for i, c in enumerate(keep)],
    )
    order = ["_id", "_crc", "_size", "_row"]
    ranged = cut(rows.repartitionByRange(*order).withColumn("_range", F.spark_partition_id()))
    totals = ranged.groupBy("_range").agg(F.sum("_size").alias("_bytes"), F.count("*").alias("_rows"))
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)  # a row per range partition
    offsets = totals.select(
        "_range",
        F.coalesce(F.sum("_bytes").over(before), F.lit(0)).alias("_byte0"),
        F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_row0"),
        F.sum("_bytes").over(Window.partitionBy()).alias("_all"),
    )
    within = Window.partitionBy("_range").orderBy(*order)
    placed = (
        ranged.join(F.broadcast(offsets), "_range")  # as many rows as range partitions
        .withColumn("_end", F.col("_byte0") + F.sum("_size").over(within.rowsBetween(Window.unboundedPreceding, 0)))
        .withColumn("_at", F.col("_row0") + F.row_number().over(within) - 1)
        .withColumn("shard", F.expr(f"least({n_shards - 1}, (2 * _end - _size) * {n_shards} div (2 * _all))").cast("int"))
    )
    starts = placed.groupBy("shard").agg(F.min("_at").alias("_first"))
    return placed.join(F.broadcast(starts), "shard").select(  # n_shards rows
        F.col("_id").alias(id_col),
        F.col("_size").alias("size"),
        F.col("_crc").alias("text_crc32"),
        "shard",
        (F.col("_at") - F.col("_first")).alias("slot"),
        *[F.col(f"_keep_{i}").alias(c) for i, c in enumerate(keep)],
    )


def write_shards(docs: DataFrame, path: str, n_shards: int = 40, id_col: str = "doc_id", text_col: str = "text") -> None:
    """Write the documents, whole and in slot order, to ``path/shard=N`` as Parquet."""
    rest = [c for c in docs.columns if c not in (id_col, "size", "text_crc32", "shard", "slot")]
    placed = assign(docs, n_shards, id_col, text_col, keep=rest)
    placed.repartitionByRange("shard", "slot").sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path)
