"""Connected components: each task contracts the links that it holds, then alternating large and small stars.

Links are gathered into as few tasks as hold ``EACH`` of them. A task replaces its links by stars around the
smallest nodes; with a single task that is all. Otherwise each round relinks every node's larger neighbours to its smallest one,
then its smaller neighbours too, until each component is a star around its smallest node. Minima are aggregated before they
are shuffled, and a node with many links meets a single row in each join, so Spark can split it. Rounds are cut at
the shared checkpoint folder.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strandline.llm._common import cut, gathered

#: Links that one task contracts.
EACH = 500_000


def _state(edges: DataFrame) -> tuple:
    row = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
    return tuple(row)


def _contract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links (a, b) to stars (node, smallest node that these links reach)."""
    held = [(b.column("a").to_numpy(), b.column("b").to_numpy()) for b in batches if b.num_rows]
    if not held:
        return
    ends = np.concatenate([np.concatenate(x) for x in zip(*held, strict=True)])
    nodes, place = np.unique(ends, return_inverse=True)
    i, j = place[: len(place) // 2], place[len(place) // 2 :]
    label = np.arange(len(nodes))
    while True:
        low, new = np.minimum(label[i], label[j]), label.copy()
        for x in (i, j, label[i], label[j]):  # nodes, and what they hang on
            np.minimum.at(new, x, low)
        new = new[new]
        if (new == label).all():
            break
        label = new
    own = np.flatnonzero(label != np.arange(len(nodes)))
    for a in range(0, len(own), 100_000):
        some = own[a : a + 100_000]
        yield pa.RecordBatch.from_arrays([pa.array(nodes[some]), pa.array(nodes[label[some]])], names=["a", "b"])


def components(edges: DataFrame, each: int = EACH) -> DataFrame:
    """(node, component) for each node of edges (a, b: long); component is the smallest node that can be reached.

    Loops, repeats and either direction are allowed; rows with a null end are no links.
    """
    links = edges.where("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    links = cut(links)
    n = links.count()
    links = cut(gathered(links, n, each).mapInArrow(_contract, "a long, b long"))
    before = _state(links) if n >= each else (0,)
    while before[0]:
        both = links.union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        joined = large.join(least, "a")
        links = cut(joined.where("b != m").select(F.col("b").alias("a"), F.col("m").alias("b")).union(least.select("a", F.col("m").alias("b"))).distinct())
        after = _state(links)
        if after == before:
            break
        before = after
    return links.select(F.col("a").alias("node"), F.col("b").alias("component")).union(links.select("b", "b")).distinct()
