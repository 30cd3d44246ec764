"""Mixing sources to target weights with a multivariate-hypergeometric splitting tree.

Every source is a random permutation of its documents (by a seeded hash), cut into ``BLOCKS`` blocks of equal
expected size. The weights and the cap on repeats give each source a target in words; the blocks up to the target
(whole passes first, then a part of one) are its exact quota. A binary tree splits the quotas among the output
shards: at each node half of the node's blocks, drawn without replacement from all of its sources, go to the left, so
the counts by source are a multivariate-hypergeometric draw with exact margins and no block is in two shards. A document
is taken as often as a shard has drawn its block. Inside a shard documents are put in the order of another seeded hash.

The block table has at most ``BLOCKS * (max_repeats + 1)`` rows a source, whatever the number of documents; the tree's root
sorts it in one task, a million rows at about a thousand sources. A source that holds most rows is spread over its blocks before
anything is summed or sorted, and the end of its part is looked for in blocks, in parts of a block, then among few rows.

Nulls: a null text has no words; a null source is a source of its own, last in the order. The lots of a row come from
its id, source and text, and rows that repeat all three from their number among these, so null and repeated ids are
drawn one by one. An empty table gives an empty result. A source without words has target 0. The same seed gives the
same mix. ``mix`` keeps the columns of docs whatever their names, but for those named as its own two.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strandline.llm._common import cut, small, word_count

BLOCKS = 256
MAX_REPEATS = 3
WEIGHTS = (1, 2, 3)


def _first_lot(seed: int, *columns: str) -> Column:
    return F.xxhash64(F.lit(seed), *[F.col(f"`{c}`") for c in columns])


def _lots(rows: DataFrame) -> DataFrame:
    """rows (h, ...) with rows of one h given different ones, by their number among these."""
    often = cut(rows.select("h").groupBy("h").agg(F.count("*").alias("n")).where("n > 1").select("h"))
    n = often.count()
    if not n:
        return rows
    own = [c for c in rows.columns if c != "h"]
    some = rows.join(small(often, n), "h", "left_semi")
    some = cut(some.withColumn("part", F.spark_partition_id()).withColumn("place", F.monotonically_increasing_id()))
    before = Window.partitionBy("h").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # a row for each of the h's partitions
    parts = some.groupBy("h", "part").agg(F.count("*").alias("n")).withColumn("offset", F.coalesce(F.sum("n").over(before), F.lit(0))).drop("n")
    number = F.row_number().over(Window.partitionBy("h", "part").orderBy("place")) + F.col("offset")
    some = some.join(parts, ["h", "part"]).withColumn("h", F.xxhash64("h", number.cast("long"))).select("h", *own)
    return rows.join(small(often, n), "h", "left_anti").select("h", *own).union(some)


def _block(h: Column) -> Column:
    return F.shiftrightunsigned(h, 56).cast("int")


def _within(h: Column) -> Column:
    """The place in a block, of 65,536."""
    return F.shiftrightunsigned(h, 40).bitwiseAND(0xFFFF).cast("int")


def _end(rows: DataFrame, key: str) -> DataFrame:
    """(source, at, left): where rows (source, left, key, words) reach left, and what is left of it there."""
    sums = rows.groupBy("source", "left", key).agg(F.sum("words").alias("words"))
    sums = sums.withColumn("end", F.sum("words").over(Window.partitionBy("source").orderBy(key)))
    return cut(sums.where("left > 0 and end - words <= left and left < end").select("source", F.col(key).alias("at"), (F.col("left") - F.col("end") + F.col("words")).alias("left")))


def _same_source(left: str, right: str) -> Column:
    return F.col(f"{left}.source").eqNullSafe(F.col(f"{right}.source"))


def quotas(slim: DataFrame, weights: tuple[int, ...] = WEIGHTS, max_repeats: int = MAX_REPEATS) -> DataFrame:
    """A row per source of slim (source, size, h): its size, target, full passes, and where the last part ends.

    Weights go to the sources in code-point order, null last, over and over. Target i is min(cap i, level * weight i)
    with the one level at which the targets add up to all words.
    """
    blocks = slim.groupBy("source", _block(F.col("h")).alias("block")).agg(F.sum("size").alias("words"))
    every = Window.partitionBy()
    order = Window.orderBy(F.col("source").asc_nulls_last())
    share = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), F.pmod(F.row_number().over(order) - 1, len(weights)) + 1)
    sources = blocks.groupBy("source").agg(F.sum("words").alias("source_size")).select("source", "source_size", share.alias("weight"))
    sources = sources.withColumn("cap", F.col("source_size") * float(max_repeats)).withColumn("ratio", F.col("cap") / F.col("weight"))
    before = Window.orderBy("ratio", F.col("source").asc_nulls_last()).rowsBetween(Window.unboundedPreceding, -1)
    level = (F.sum("source_size").over(every) - F.coalesce(F.sum("cap").over(before), F.lit(0.0))) / (F.sum("weight").over(every) - F.coalesce(F.sum("weight").over(before), F.lit(0.0)))
    sources = sources.withColumn("level", level)
    top = F.max(F.when(F.col("ratio") > F.col("level"), F.col("level"))).over(every)
    sources = sources.withColumn("target", F.least(F.col("cap"), F.coalesce(top * F.col("weight"), F.col("cap"))))
    size = F.col("source_size")
    sources = sources.withColumn("passes", F.when(size > 0, F.floor(F.col("target") / size)).otherwise(0).cast("int"))
    sources = cut(sources.withColumn("part", F.col("target") - F.col("passes") * size).select("source", "source_size", "target", "passes", "part"))
    n = sources.count()
    parts = small(sources.select("source", F.col("part").alias("left")), n)
    edge = _end(blocks.alias("b").join(parts.alias("s"), _same_source("b", "s")).select("s.source", "left", "block", "words"), "block")
    inside = slim.alias("d").join(small(edge, n).alias("e"), _same_source("d", "e") & (_block(F.col("d.h")) == F.col("e.at")))
    inside = inside.select("e.source", "left", _within(F.col("h")).alias("within"), F.col("size").alias("words"), "h")
    finer = _end(inside, "within")
    few = inside.drop("left").alias("d").join(small(finer, n).alias("e"), _same_source("d", "e") & (F.col("d.within") == F.col("e.at")))
    running = F.sum("words").over(Window.partitionBy("source").orderBy("h").rowsBetween(Window.unboundedPreceding, 0))
    few = few.select("e.source", "left", "h", "words").withColumn("end", running)
    last = few.where(F.col("end") - F.col("words") / 2 <= F.col("left")).groupBy("source").agg(F.max("h").alias("last"))
    out = sources.alias("s")
    for name, found in (("e", edge), ("f", finer), ("l", last)):
        out = out.join(found.alias(name), _same_source("s", name), "left")
    return cut(out.select("s.source", "s.source_size", "s.target", "s.passes", F.col("e.at").alias("edge"), F.col("f.at").alias("within"), "l.last"))


def tree(quota: DataFrame, levels: int, seed: int) -> DataFrame:
    """A row per drawn block (source, pass, block) with its shard of 0 to 2**levels - 1."""
    to = F.when(F.col("edge").isNull(), F.col("passes") - 1).otherwise(F.col("passes"))
    drawn = quota.where(to >= 0).select("source", "passes", "edge", F.explode(F.sequence(F.lit(0), to)).alias("pass"))
    upto = F.when(F.col("pass") < F.col("passes"), F.lit(BLOCKS - 1)).otherwise(F.col("edge"))
    drawn = drawn.select("source", "pass", F.explode(F.sequence(F.lit(0), upto)).alias("block")).withColumn("shard", F.lit(0))
    for level in range(levels):
        node = Window.partitionBy("shard")
        lot = F.row_number().over(node.orderBy(F.xxhash64(F.lit(seed), F.lit(level), "source", "pass", "block"), "source", "pass", "block"))
        drawn = drawn.withColumn("right", (lot * 2 > F.count("*").over(node)).cast("int")).withColumn("shard", F.col("shard") * 2 + F.col("right")).drop("right")
    return drawn


def _draws(slim: DataFrame, levels: int, weights: tuple[int, ...], max_repeats: int, seed: int) -> tuple[DataFrame, DataFrame]:
    """The quotas of slim (source, size, h), and the shards that drew each block: (source, block, drawn), an array of (pass, shard). Broadcast if they are small."""
    q = quotas(slim, weights, max_repeats)
    n = q.count()
    blocks = cut(tree(q, levels, seed).groupBy("source", "block").agg(F.array_sort(F.collect_list(F.struct("pass", "shard"))).alias("drawn")))
    return small(q, n), small(blocks, n * BLOCKS)


def _drawn(rows: DataFrame, q: DataFrame, blocks: DataFrame) -> DataFrame:
    """rows (source, h, ...) with source_size, target and the array ``drawn`` of the passes and shards that take them."""
    own = [f"d.{c}" for c in rows.columns]
    h = F.col("d.h")
    met = rows.alias("d").join(q.alias("q"), _same_source("d", "q")).join(blocks.alias("b"), _same_source("d", "b") & (_block(h) == F.col("b.block")), "left")
    inside = (_within(h) < F.col("q.within")) | ((_within(h) == F.col("q.within")) & (h <= F.col("q.last")))
    beyond = (_block(h) == F.col("q.edge")) & ~F.coalesce(inside, F.lit(False))
    cut_off = lambda s: (s["pass"] == F.col("q.passes")) & F.coalesce(beyond, F.lit(False))
    none = F.array().cast("array<struct<pass:int,shard:int>>")
    return met.select(*own, "q.source_size", "q.target", F.coalesce(F.filter("b.drawn", lambda s: ~cut_off(s)), none).alias("drawn"))


def _place(seed: int, h: Column, s: Column) -> Column:
    return F.xxhash64(F.lit(seed), s["shard"], h, s["pass"])


def plan(docs: DataFrame, levels: int = 4, weights: tuple[int, ...] = WEIGHTS, max_repeats: int = MAX_REPEATS, seed: int = 17, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """A row per document: id, source, size, source_size, target, copies, taken, and for each copy its shard and its place there."""
    lot = _first_lot(seed, id_col, source_col, text_col).alias("h")
    slim = cut(docs.select(lot, F.col(f"`{id_col}`").alias("id"), F.col(f"`{source_col}`").alias("source"), word_count(F.col(f"`{text_col}`")).alias("size")))
    slim = _lots(slim)
    got = _drawn(slim, *_draws(slim, levels, weights, max_repeats, seed))
    copies = F.size("drawn")
    return got.select(
        F.col("id").alias(id_col),
        F.col("source").alias(source_col),
        "size",
        "source_size",
        "target",
        copies.alias("copies"),
        (copies * F.col("size")).cast("long").alias("taken"),
        F.col("drawn.shard").alias("shards"),
        F.transform("drawn", lambda s: _place(seed, F.col("h"), s)).alias("places"),
    )


def mix(docs: DataFrame, levels: int = 4, weights: tuple[int, ...] = WEIGHTS, max_repeats: int = MAX_REPEATS, seed: int = 17, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """The mixed corpus: the columns of docs, a row for each copy taken, then _shard (of 2**levels) and _place (its order there).

    Documents stay where they were read; only sizes are gathered. ``shuffled`` moves them to their shards.
    """
    lot = _first_lot(seed, id_col, source_col, text_col).alias("h")
    source = F.col(f"`{source_col}`").alias("source")
    slim = _lots(cut(docs.select(lot, source, word_count(F.col(f"`{text_col}`")).alias("size"))))
    own = [F.col(f"`{c}`") for c in docs.columns if c not in ("_shard", "_place")]
    rows = _drawn(_lots(docs.select(lot, source, F.struct(*own).alias("row"))), *_draws(slim, levels, weights, max_repeats, seed))
    rows = rows.select("h", "row", F.explode("drawn").alias("s"))
    return rows.select("row.*", F.col("s.shard").alias("_shard"), _place(seed, F.col("h"), F.col("s")).alias("_place"))


def shuffled(mixed: DataFrame) -> DataFrame:
    """The rows of ``mix`` shard by shard, each in its shuffled order."""
    return mixed.repartitionByRange("_shard", "_place").sortWithinPartitions("_shard", "_place")


def write_mix(docs: DataFrame, path: str, **options) -> None:
    """Write the mixed corpus to ``path/_shard=N``, each shard in its shuffled order."""
    shuffled(mix(docs, **options)).write.partitionBy("_shard").parquet(path)
