"""Exact and MinHash deduplication, clusters and their statistics.

Exact duplicates are joined first, by a hash of the normalised text; MinHash
then runs on distinct texts. A text's key is the smallest id that has it, a
cluster's root the smallest key.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from patraloom.functions.minhash import mixed, run_hashes, signatures
from patraloom.functions.text import normalise
from patraloom.operators.graph import components
from patraloom.session import cut

#: Signature slots, characters of a run, and the least share of equal slots.
SLOTS, RUN, SIMILAR = 128, 5, 0.85
#: Keys of a bucket that one task takes whole.
PART = 2048
#: Thresholds a sweep tries.
SWEEP = (0.95, 0.90, 0.85, 0.80, 0.70, 0.60, 0.50)


def exact_groups(df: DataFrame, key: str, text: str) -> DataFrame:
    """Per distinct normalised text: ``text_key`` (smallest id), ``members`` and
    ``norm``. Null texts are left out."""
    norm = df.select(F.col(key), normalise(text).alias("norm")).where("norm is not null")
    # Grouped by its 256-bit hash, so that only one copy of a text leaves a task.
    hashed = norm.groupBy(F.sha2("norm", 256).alias("h")).agg(F.min(key).alias("text_key"), F.count(F.lit(1)).alias("members"), F.first("norm").alias("norm"))
    return hashed.select("norm", "text_key", "members")


def least_equal(threshold: float, slots: int = SLOTS) -> int:
    """The fewest equal slots that make a similarity of ``threshold``."""
    return next(e for e in range(slots + 1) if e / slots >= threshold)


def bands_for(threshold: float, slots: int = SLOTS) -> tuple[int, int]:
    """(bands, least rows of a band) that lose no pair whose signatures agree in
    ``threshold`` of the slots.

    With one band more than slots may differ, one band is equal throughout. Where
    that would leave bands of one row, bands of two are taken as long as they
    miss a pair with a chance of at most 1e-6 (at 0.50 it is 1e-8)."""
    bands = slots - least_equal(threshold, slots) + 1
    if bands > slots // 2:
        bands = slots // 2 if (1 - threshold**2) ** (slots // 2) <= 1e-6 else slots
    return bands, slots // bands


def minhash(texts: DataFrame, key: str, norm: str, slots: int = SLOTS, k: int = RUN) -> DataFrame:
    """``key``, ``sig`` (array of bigint) of each text. A text below ``k``
    characters is its own only run; an empty text has no signature."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            own = batch.column(1).to_pylist()
            # Short texts are padded to one run that no longer text has.
            own = [t if len(t) >= k else t + "\0" * (k - len(t)) for t in own]
            hashes, n = run_hashes(own, k)
            sig = signatures(hashes, n, slots).T.astype(np.int64)
            lists = pa.ListArray.from_arrays(np.arange(0, (len(own) + 1) * slots, slots, dtype=np.int32), pa.array(sig.ravel()))
            yield pa.RecordBatch.from_arrays([batch.column(0), lists], [key, "sig"])

    return texts.where(F.col(norm) != "").select(key, norm).mapInArrow(run, f"{key} {texts.schema[key].dataType.simpleString()}, sig array<bigint>")


def _sketch(sig: np.ndarray) -> np.ndarray:
    """Two bits of each slot of ``sig`` (texts x slots), as words x texts: a
    plane of first bits, then one of second bits. Equal slots have equal bits."""
    h = mixed(sig)
    planes = []
    for bit in (63, 62):
        bits = np.packbits((h >> np.uint64(bit) & np.uint64(1)).astype(np.uint8), axis=1)
        planes.append(np.pad(bits, ((0, 0), (0, -bits.shape[1] % 8))).view(np.int64))
    return np.concatenate(planes, axis=1).T


class _Buckets:
    """The buckets of bands in which signatures of a least similarity meet (see
    :func:`bands_for`). Two bits a slot go along with the bands, so that pairs
    with too few slots of equal bits, which can't have enough equal ones, are
    dropped as they meet."""

    def __init__(self, sigs: DataFrame, key: str, threshold: float, slots: int, part: int):
        self.sigs, self.threshold, self.slots = sigs.select(F.col(key).alias("k"), "sig"), threshold, slots
        b, _ = bands_for(threshold, slots)
        parts = [np.arange(i, slots, b) for i in range(b)]
        kind = sigs.schema[key].dataType.simpleString()
        self.words = [f"w{i}" for i in range(2 * -(-slots // 64))]
        half = len(self.words) // 2
        off = " + ".join(f"bit_count((a{x} ^ b{x}) | (a{y} ^ b{y}))" for x, y in zip(self.words[:half], self.words[half:], strict=True))
        self.near = f"a < b and {off} <= {slots - least_equal(threshold, slots)}"
        words = self.words

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                if not batch.num_rows:
                    continue
                sig = batch.column(1).flatten().to_numpy().reshape(batch.num_rows, -1).astype(np.uint64)
                sketch = _sketch(sig)
                keys = np.empty((b, batch.num_rows), np.uint64)
                for band, rows in enumerate(parts):
                    h = np.full(batch.num_rows, band + 1, np.uint64)
                    for i in rows:
                        h = mixed(h * np.uint64(0x100000001B3) ^ sig[:, i])
                    keys[band] = h
                which = pa.array(np.tile(np.arange(batch.num_rows), b))
                yield pa.RecordBatch.from_arrays([batch.column(0).take(which), pa.array(keys.ravel().view(np.int64)), *(pa.array(np.tile(w, b)) for w in sketch)], ["k", "band", *words])

        self.banded = self.sigs.mapInArrow(run, f"k {kind}, band bigint, " + ", ".join(f"{w} bigint" for w in words))
        # Buckets of one are dropped by a count that is combined before the shuffle.
        count = F.expr(f"cast(ceil(count(1) / {part}) as int)")
        self.shared = cut(self.banded.groupBy("band").agg(F.min("k").alias("first"), F.max("k").alias("last"), count.alias("parts")).where("first <> last").drop("last"))
        self.any_large = not self.shared.where("parts > 1").isEmpty()

    def _met(self, left: DataFrame, right: DataFrame, on: list[str], where: str) -> DataFrame:
        a, b = (side.select(*on, F.col("root").alias(f"{n}root"), F.col("k").alias(n), *(F.col(w).alias(n + w) for w in self.words)) for n, side in (("a", left), ("b", right)))
        return a.join(b, on).where(where).select("a", "b")

    def small(self) -> DataFrame:
        """The pairs of the buckets that one task takes whole."""
        held = self.banded.join(self.shared.where("parts = 1"), "band").withColumn("root", F.lit(None).cast("string"))
        return self._met(held, held, ["band"], self.near)

    def stars(self) -> DataFrame:
        """Of the others, the pairs with the smallest key."""
        held = self.banded.join(self.shared.where("parts > 1"), "band").withColumn("root", F.lit(None).cast("string"))
        return self._met(held.where("k = first"), held, ["band"], self.near)

    def large(self, roots: DataFrame | None = None) -> DataFrame:
        """Of the others, all pairs, part by part; with ``roots`` (``node``,
        ``root``) those of different roots, of buckets that have several."""
        held = self.banded.join(self.shared.where("parts > 1"), "band")
        if roots is None:
            held, where = held.withColumn("root", F.lit(None).cast("string")), self.near
        else:
            held, where = held.join(roots.select(F.col("node").alias("k"), "root"), "k", "left").withColumn("root", F.coalesce("root", "k")), f"aroot <> broot and {self.near}"
            held = held.join(held.groupBy("band").agg(F.min("root").alias("lo"), F.max("root").alias("hi")).where("lo <> hi").select("band"), "band", "left_semi")
        copies = held.withColumn("part", F.explode(F.expr("sequence(0, parts - 1)")))
        return self._met(copies, held.withColumn("part", F.pmod(F.xxhash64("k"), "parts").cast("int")), ["band", "part"], where)

    def verified(self, pairs: DataFrame) -> DataFrame:
        sa, sb = self.sigs.toDF("a", "sa"), self.sigs.toDF("b", "sb")
        equal = F.aggregate(F.zip_with("sa", "sb", lambda x, y: (x == y).cast("int")), F.lit(0), lambda s, x: s + x)
        joined = pairs.distinct().join(sa, "a").join(sb, "b").withColumn("similarity", equal / F.lit(float(self.slots)))
        return joined.where(F.col("similarity") >= self.threshold).select("a", "b", "similarity")


def candidate_pairs(sigs: DataFrame, key: str, threshold: float = SIMILAR, slots: int = SLOTS, part: int = PART) -> DataFrame:
    """``a < b``, ``similarity``: the pairs whose signatures agree in at least
    ``threshold`` of the slots. They are looked for where a band is equal; the
    keys of a large bucket meet in parts of about ``part``."""
    buckets = _Buckets(sigs, key, threshold, slots, part)
    return buckets.verified(buckets.small().unionByName(buckets.large()) if buckets.any_large else buckets.small())


def linking_pairs(sigs: DataFrame, key: str, threshold: float = SIMILAR, slots: int = SLOTS, part: int = PART) -> DataFrame:
    """Pairs (``a``, ``b``) that connect the same texts as all those of
    :func:`candidate_pairs` do. Of a bucket above ``part`` they aren't all listed:
    first its texts with its smallest key, then, if that leaves it in several
    components, those of different ones."""
    buckets = _Buckets(sigs, key, threshold, slots, part)
    if not buckets.any_large:
        return cut(buckets.verified(buckets.small()).select("a", "b"))
    first = cut(buckets.verified(buckets.small().unionByName(buckets.stars())).select("a", "b"))
    more = buckets.verified(buckets.large(cut(components(first))))
    return cut(first.unionByName(more.select("a", "b")))


def clusters(keys: DataFrame, key: str, edges: DataFrame) -> DataFrame:
    """``key``, ``root`` of every key; a key without an edge is its own root."""
    roots = components(edges.select("a", "b")).select(F.col("node").alias(key), "root")
    return keys.select(key).join(roots, key, "left").withColumn("root", F.coalesce("root", F.col(key)))


def near_duplicates(df: DataFrame, key: str, text: str, threshold: float = SIMILAR, slots: int = SLOTS, k: int = RUN, pairs: bool = True) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(groups, edges, clusters): :func:`exact_groups`, :func:`candidate_pairs`
    of their texts (:func:`linking_pairs` without ``pairs``), and the cluster of
    each text key."""
    groups = cut(exact_groups(df, key, text))
    sigs = cut(minhash(groups, "text_key", "norm", slots, k))
    edges = cut(candidate_pairs(sigs, "text_key", threshold, slots)) if pairs else linking_pairs(sigs, "text_key", threshold, slots)
    return groups, edges, clusters(groups, "text_key", edges)


def map_back(df: DataFrame, key: str, text: str, groups: DataFrame, roots: DataFrame) -> DataFrame:
    """``df`` with ``dedup_group``, the root of its text's cluster. Rows with a
    null text are left out."""
    rooted = groups.join(roots, "text_key").select(F.sha2("norm", 256).alias("norm_hash"), F.col("root").alias("dedup_group"))
    return df.withColumn("norm_hash", F.sha2(normalise(text), 256)).join(rooted, "norm_hash").drop("norm_hash")


def cluster_stats(groups: DataFrame, edges: DataFrame, roots: DataFrame) -> DataFrame:
    """One row: texts, clusters, clusters of several texts, and pairs."""
    sizes = roots.groupBy("root").agg(F.count(F.lit(1)).alias("n"))
    return groups.agg(F.count(F.lit(1)).alias("n_texts")).crossJoin(sizes.agg(F.count(F.lit(1)).alias("n_clusters"), F.count_if(F.expr("n > 1")).alias("multi_text_clusters"))).crossJoin(edges.agg(F.count(F.lit(1)).alias("pairs")))


def size_bucket(n):
    return F.when(n == 1, "1").when(n == 2, "2").when(n <= 5, "3-5").when(n <= 10, "6-10").when(n <= 50, "11-50").when(n <= 100, "51-100").otherwise("100+")


def size_histogram(df: DataFrame, group: str) -> DataFrame:
    """Clusters per size bucket."""
    return df.groupBy(group).agg(F.count(F.lit(1)).alias("n")).groupBy(size_bucket(F.col("n")).alias("size")).agg(F.count(F.lit(1)).alias("clusters"))


def spanning(df: DataFrame, group: str, label: str, source: str) -> DataFrame:
    """One row: clusters with more than one (label, source) cell, and with more than one label."""
    cells = df.groupBy(group, label, source).agg(F.count(F.lit(1)).alias("n"))
    per = cells.groupBy(group).agg(F.count(F.lit(1)).alias("cells"), F.count_distinct(label).alias("labels"))
    return per.agg(F.count_if(F.expr("cells > 1")).alias("cell_spanning"), F.count_if(F.expr("labels > 1")).alias("label_conflicts"))


def sweep(sigs: DataFrame, key: str, thresholds: tuple[float, ...] = SWEEP, slots: int = SLOTS) -> DataFrame:
    """Per threshold: pairs, and how many texts clustering would remove. The
    pairs of the lowest threshold are found once; those of a higher one are the
    more similar among them."""
    n = sigs.count()
    pairs = cut(candidate_pairs(sigs, key, min(thresholds), slots))
    out = None
    for t in thresholds:
        edges = pairs.where(F.col("similarity") >= t)
        roots = components(edges)
        gone = roots.agg((F.count(F.lit(1)) - F.count_distinct("root")).alias("removed")).crossJoin(edges.agg(F.count(F.lit(1)).alias("pairs")))
        one = gone.select(F.lit(t).alias("threshold"), "pairs", "removed", F.try_divide(F.col("removed") * 100.0, F.lit(float(n))).alias("reduction_pct"))
        out = one if out is None else out.unionByName(one)
    return out


def largest(df: DataFrame, group: str, key: str, n: int = 10, members: int = 3) -> DataFrame:
    """The ``n`` largest clusters of more than one row (ties: smallest group),
    with their ``members`` smallest ids."""
    top = df.groupBy(group).agg(F.count(F.lit(1)).alias("cluster_size")).where("cluster_size > 1").orderBy(F.desc("cluster_size"), group).limit(n)
    ids = df.join(F.broadcast(top), group).select(group, "cluster_size", key).distinct()  # at most n rows
    ranked = ids.withColumn("r", F.row_number().over(W.partitionBy(group).orderBy(key))).where(F.col("r") <= members)
    return ranked.groupBy(group, "cluster_size").agg(F.array_sort(F.collect_list(key)).alias("ids"))
