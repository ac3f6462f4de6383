"""Connected components of an edge table."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from patraloom.session import cut, forget

#: Edges that one task may take at once; more of them go through rounds.
AT_ONCE = 1_000_000


def _whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """All edges in one partition: labels spread to the smaller end, by halving paths, until none changes."""
    held = pa.Table.from_batches(list(batches)) if (batches := list(batches)) else None
    if held is None or not held.num_rows:
        return
    u, v = held.column(0).combine_chunks(), held.column(1).combine_chunks()
    nodes = pc.unique(pa.concat_arrays([u, v]))
    nodes = nodes.take(pc.sort_indices(nodes))
    a, b = (pc.index_in(x, nodes).to_numpy(zero_copy_only=False).astype(np.int64) for x in (u, v))
    label = np.arange(len(nodes))
    while True:
        least = np.minimum(label[a], label[b])
        new = label.copy()
        for x in (a, b):
            np.minimum.at(new, label[x], least)
        while (new[new] != new).any():
            new = new[new]
        if (new == label).all():
            break
        label = new
    yield pa.RecordBatch.from_arrays([nodes, nodes.take(pa.array(label))], ["node", "root"])


def components(edges: DataFrame, most: int = 60, at_once: int = AT_ONCE) -> DataFrame:
    """``node``, ``root`` of each node of the edges (``a``, ``b``): the smallest
    node of its connected component.

    Up to ``at_once`` edges are taken by one task of an executor. More go through
    large-star and small-star rounds, whose number grows with the logarithm of
    the graph; each round is written to the shared folder. Nothing but counts
    reaches the driver. Loops and repeated edges do no harm.
    """
    now = cut(edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct())
    if now.count() <= at_once:
        kind = now.schema["u"].dataType.simpleString()
        return now.coalesce(1).mapInArrow(_whole, f"node {kind}, root {kind}")
    state = None
    for _ in range(most):
        both = now.union(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").union(least).distinct()
        before, now = now, cut(small)
        forget(before)
        # Two equal sums of hashes, and as many rows: the edges no longer change.
        seen = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if tuple(seen) == state:
            return now.select(F.col("u").alias("node"), F.col("v").alias("root")).union(now.select("v", "v").distinct())
        state = tuple(seen)
    raise RuntimeError("the components did not settle")
