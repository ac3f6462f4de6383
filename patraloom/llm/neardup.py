"""Problem 3: groups of near-duplicate texts, by exact Jaccard similarity.

Texts are compared in the consistent form of problem 1, by their sets of
five-character runs. A Jaccard metric-space join whose first pivots are
documents cannot work here: nearly all distances lie between 0.8 and 1 while
its windows are 0.6 wide, so every region would hold every document (figures in
the README). The first regions are therefore made by keys: MinHash bands (a pair
at the threshold shares none with a probability of 8 in a million), or, with
``exact``, the rarest runs of a text, of which two similar texts always share
one. Inside a region the join is the metric-space one: a text of the region is
its pivot, and what lies in its ball is linked through it; a region whose texts
that doesn't connect gets more pivots, which create Voronoi regions, windows by
the triangle inequality replicate boundary documents, and the new regions are
joined recursively. Every link rests on the exact similarity of whole texts.

Equal texts are one node from the start, so a text that a third of all rows
share costs as much as any other.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from patraloom.functions.minhash import STEP, mixed, run_hashes, signatures
from patraloom.llm.canonical import connection, duckdb_query, several_map
from patraloom.operators.graph import components
from patraloom.session import cut, forget, source_bytes

#: Characters of a run, least similarity, MinHash values of a band, and bands.
RUN, SIMILAR, ROWS, BANDS = 5, 0.70, 5, 64
#: A region of at most this many texts compares all its pairs.
SMALL = 16
#: Pivots of a larger region, about; texts of a region that one task joins.
PIVOTS, BLOCK = 16, 4096
#: Bytes of the source a bucket stands for, about, and buckets at most.
BUCKET_BYTES, BUCKETS = 4_000_000, 200_000
#: Characters of a region that one task joins.
REGION_CHARS = 4_000_000
#: Keys a task packs at once, at least and at most.
PACKED = (1_000_000, 8_000_000)
#: Entries of a bucket that are in memory at once, about; a larger one is gone through by ranges of keys.
AT_ONCE = 2_000_000
#: One bit each of this many MinHash values makes the sketch; pairs with fewer
#: equal bits are not compared (at the threshold 109 are expected; 88 is more than
#: five standard deviations below).
SKETCH, SKETCH_LEAST = 128, 88
#: Texts to compare that are looked up by a broadcast of their ids at most.
LOOKED_UP = 1_000_000
#: Slots of the table of run counts that orders runs by rarity (with ``exact``).
COUNTED = 1 << 20

STAGED = "kind byte, bucket int, a long, b long, field string, id string, s1 long, s2 long, blob binary"
_BANDED, _NODE, _EDGE, _HOT = 0, 1, 2, 3


def _sketches(sig: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    bits = np.packbits((mixed(sig[:SKETCH].astype(np.uint64)) >> np.uint64(63)).astype(np.uint8), axis=0).T
    both = np.ascontiguousarray(bits).view(np.int64)
    return both[:, 0], both[:, 1]


def _packed(keys: np.ndarray, nodes: np.ndarray) -> bytes:
    """Keys (32 bits) and nodes (64 bits) of a bucket: sorted keys as
    differences in byte planes, each node once, and places in the node table."""
    order = np.argsort(keys)
    table, place = np.unique(nodes[order], return_inverse=True)
    steps = np.diff(keys[order], prepend=np.uint32(0)).astype(np.uint32)
    kind = np.uint16 if len(table) <= 65536 else np.uint32
    planes = [x.view(np.uint8).reshape(len(x), -1).T.tobytes() for x in (steps, place.astype(kind))]
    return zstandard.ZstdCompressor(level=1).compress(struct.pack("<II", len(keys), len(table)) + table.tobytes() + b"".join(planes))


def _unpacked(blob: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sorted keys, each one's place in the node table, and that table."""
    raw = zstandard.ZstdDecompressor().decompress(blob)
    n, m = struct.unpack_from("<II", raw)
    table = np.frombuffer(raw, np.int64, m, 8)
    plane = lambda at, width: np.ascontiguousarray(np.frombuffer(raw, np.uint8, n * width, at).reshape(width, n).T)
    steps = plane(8 + 8 * m, 4).view(np.uint32)[:, 0]
    place = plane(8 + 8 * m + 4 * n, 2 if m <= 65536 else 4).view(np.uint16 if m <= 65536 else np.uint32)[:, 0]
    return np.cumsum(steps, dtype=np.uint32), place, table


def _rows(kind: int, n: int, **columns) -> pa.RecordBatch:
    schema = {"kind": pa.int8(), "bucket": pa.int32(), "a": pa.int64(), "b": pa.int64(), "field": pa.string(), "id": pa.string(), "s1": pa.int64(), "s2": pa.int64(), "blob": pa.binary()}
    made = {"kind": pa.array(np.full(n, kind, np.int8))} | {c: x if isinstance(x, pa.Array) else pa.array(x, schema[c]) for c, x in columns.items()}
    return pa.RecordBatch.from_arrays([made.get(c, pa.nulls(n, t)) for c, t in schema.items()], list(schema))


def _formed(batches: Iterator[pa.RecordBatch], fields: tuple[str, ...], sql: str, several: str) -> Iterator[list[tuple[str, pa.Array, list[str], np.ndarray]]]:
    """Per batch, for each field: ids, texts in the consistent form, and nodes
    (64-bit hashes of field and text) of the rows whose text isn't null."""
    con = connection(several)
    for batch in batches:
        if not batch.num_rows:
            continue
        table = con.from_arrow(pa.Table.from_batches([batch])).query("batch", sql).to_arrow_table()
        out = []
        for field in fields:
            known = table.filter(pc.is_valid(table[field]))
            texts = known[field].to_pylist()
            seed = xxhash.xxh3_64_intdigest(field)
            node = np.array([xxhash.xxh3_64_intdigest(t, seed) for t in texts], np.uint64).view(np.int64)
            out.append((field, known["the id"].combine_chunks(), texts, node))
        yield out


def _distinct_runs(hashes: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct hashes of each text, one text after the other, and how many each has."""
    text = np.repeat(np.arange(len(n)), n)
    order = np.lexsort((hashes, text))
    h, t = hashes[order], text[order]
    first = np.ones(len(h), bool)
    first[1:] = (h[1:] != h[:-1]) | (t[1:] != t[:-1])
    return h[first], np.bincount(t[first], minlength=len(n))


def _slots(hashes: np.ndarray) -> np.ndarray:
    return (hashes % np.uint64(COUNTED)).astype(np.int64)


def _forming(fields: tuple[str, ...]) -> tuple[str, str]:
    """The SQL and the table of the consistent form, made once on the driver."""
    return duckdb_query("batch", ("the id",), tuple((f, f) for f in fields)), several_map()


def _count_runs(fields: tuple[str, ...], k: int):
    """Per partition: how many texts hold a run, for each slot of runs."""
    forming = _forming(fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.zeros(COUNTED, np.int64)
        for formed in _formed(batches, fields, *forming):
            for _, _, texts, _ in formed:
                distinct, _ = _distinct_runs(*run_hashes(texts, k))
                held += np.bincount(_slots(distinct), minlength=COUNTED)
        full = np.flatnonzero(held)
        yield pa.RecordBatch.from_arrays([pa.array(full.astype(np.int32)), pa.array(held[full])], ["slot", "n"])

    return run


def rarity(texts: DataFrame, fields: Sequence[str], k: int = RUN) -> np.ndarray:
    """How often the runs of each slot occur; ``COUNTED`` numbers, whatever the
    size of ``texts``. Only the order they give matters, not how exact they are."""
    counts = np.zeros(COUNTED, np.int64)
    found = texts.mapInArrow(_count_runs(tuple(fields), k), "slot int, n long").groupBy("slot").agg(F.sum("n").alias("n")).toArrow()
    counts[found["slot"].to_numpy()] = found["n"].to_numpy()
    return counts


def prefix(hashes: np.ndarray, n: np.ndarray, counts: np.ndarray, least: float) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, text numbers) of the rarest runs of each text: as many as may
    differ in a similar text, and one more. Two similar texts share one of them,
    as both order their runs alike."""
    h, size = _distinct_runs(hashes, n)
    text = np.repeat(np.arange(len(n)), size)
    order = np.lexsort((h, counts[_slots(h)], text))
    place = np.arange(len(h)) - np.repeat(np.cumsum(size) - size, size)
    kept = place < (size - np.ceil(least * size - 1e-9).astype(np.int64) + 1)[text]
    return h[order][kept], text[kept]


def _sign(fields: tuple[str, ...], buckets: int, rows: int, bands: int, k: int, least: float, counts: np.ndarray | None):
    """A node row for each text, and its keys packed by bucket: bands, or with ``counts`` rare runs."""
    at_once, forming = min(max(PACKED[0], 64 * buckets), PACKED[1]), _forming(fields)

    def pack(keys: list[np.ndarray], nodes: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        key, node = np.concatenate(keys), np.concatenate(nodes)
        bucket = (key >> np.uint64(32)) % np.uint64(buckets)
        order = np.argsort(bucket, kind="stable")
        ends = np.searchsorted(bucket[order], np.arange(buckets + 1))
        low = key.astype(np.uint32)
        for i in np.flatnonzero(np.diff(ends)):
            some = order[ends[i] : ends[i + 1]]
            yield _rows(_BANDED, 1, bucket=[i], a=[len(some)], blob=[_packed(low[some], node[some])])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, nodes, held = [], [], 0
        for formed in _formed(batches, fields, *forming):
            for which, (field, ids, texts, node) in enumerate(formed):
                hashes, n = run_hashes(texts, k)
                long = np.flatnonzero(n)
                s1, s2 = np.zeros(len(texts), np.int64), np.zeros(len(texts), np.int64)
                if len(long):
                    sig = signatures(hashes, n[long], SKETCH if counts is not None else max(rows * bands, SKETCH))
                    s1[long], s2[long] = _sketches(sig)
                    if counts is not None:
                        key, text = prefix(hashes, n[long], counts, least)
                        keys.append(mixed(key ^ np.uint64(which)))
                        nodes.append(node[long][text])
                        held += len(key)
                    else:
                        for band in range(bands):  # of values far apart, as near ones aren't quite independent
                            key = np.full(len(long), which * bands + band + 1, np.uint64)
                            for r in range(rows):
                                key = mixed(key * STEP ^ sig[r * bands + band])
                            keys.append(key)
                            nodes.append(node[long])
                        held += len(long) * bands
                yield _rows(_NODE, len(texts), bucket=((node.view(np.uint64) >> np.uint64(8)) % np.uint64(buckets)).astype(np.int32), a=node, field=pa.array([field] * len(texts)), id=ids, s1=s1, s2=s2)
            if held >= at_once:
                yield from pack(keys, nodes)
                keys, nodes, held = [], [], 0
        if keys:
            yield from pack(keys, nodes)

    return run


def _pairs_of_runs(keys: np.ndarray, places: np.ndarray, small: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Distinct pairs of places under equal keys, and the (key, place) of larger
    runs, which pair their first place alone with the others."""
    both = np.sort(keys.astype(np.uint64) << np.uint64(32) | places.astype(np.uint64))
    if len(both):
        both = both[np.append(True, both[1:] != both[:-1])]
    keys, places = both >> np.uint64(32), both.astype(np.uint32)
    start = np.flatnonzero(np.append(True, keys[1:] != keys[:-1])) if len(keys) else np.empty(0, np.int64)
    size = np.diff(np.append(start, len(keys)))
    own, first = np.repeat(size, size), np.repeat(start, size)
    hot = own > small
    hk, hp, pivot = keys[hot], places[hot], places[first[hot]]
    some = (own > 1) & ~hot
    keys, places = keys[some], places[some].astype(np.uint64)
    found, d = [pivot[pivot != hp].astype(np.uint64) << np.uint64(32) | hp[pivot != hp]], 1
    while d < len(keys):
        same = np.flatnonzero(keys[d:] == keys[:-d])
        if not len(same):
            break
        found.append(places[same] << np.uint64(32) | places[same + d])
        d += 1
    pairs = np.unique(np.concatenate(found))
    return (pairs >> np.uint64(32)).astype(np.int64), (pairs & np.uint64(0xFFFFFFFF)).astype(np.int64), hk, hp


def _meet(small: int):
    """Per partition of buckets: its node rows, candidate pairs, and large runs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list[bytes]] = {}
        entries: dict[int, int] = {}
        for batch in batches:
            kind = batch.column("kind").to_numpy(zero_copy_only=False)
            node = batch.filter(pa.array(kind == _NODE))
            if node.num_rows:
                yield node
            banded = batch.filter(pa.array(kind == _BANDED))
            for bucket, n, blob in zip(*(banded.column(c).to_pylist() for c in ("bucket", "a", "blob")), strict=True):
                held.setdefault(bucket, []).append(blob)
                entries[bucket] = entries.get(bucket, 0) + n
        for bucket, blobs in held.items():
            parts = 1 + entries[bucket] // AT_ONCE
            bounds = np.linspace(0, 2**32, parts + 1).astype(np.uint64)
            for low, high in zip(bounds, bounds[1:]):
                keys, places, tables, size = [], [], [], 0
                for blob in blobs:
                    key, place, table = _unpacked(blob)
                    i, j = np.searchsorted(key, [low, high])
                    keys.append(key[i:j])
                    places.append(place[i:j].astype(np.int64) + size)
                    tables.append(table)
                    size += len(table)
                nodes, dense = np.unique(np.concatenate(tables), return_inverse=True)
                a, b, hk, hp = _pairs_of_runs(np.concatenate(keys), dense[np.concatenate(places)], small)
                if len(a):
                    yield _rows(_EDGE, len(a), a=nodes[a], b=nodes[b])
                if len(hk):
                    yield _rows(_HOT, len(hk), a=hk.astype(np.int64) | (np.int64(bucket) << np.int64(32)), b=nodes[hp])

    return run


def _set(text: str, k: int) -> set[str]:
    return {text[i : i + k] for i in range(len(text) - k + 1)}


def jaccard(a: str, b: str, k: int = RUN) -> float:
    x, y = _set(a, k), _set(b, k)
    return _similar(x, y) if x or y else 0.0


def _similar(x: set[str], y: set[str]) -> float:
    both = len(x & y)
    return both / (len(x) + len(y) - both)


def _sorted_runs(texts: Sequence[str], k: int) -> tuple[np.ndarray, np.ndarray]:
    """The distinct runs of each text (at most 2^20 texts), sorted, one text after
    the other, as hashes of 44 bits, and how many each text has. Two runs of a
    pair of ordinary texts have equal hashes once in 10^8 pairs or so."""
    hashes, n = run_hashes(texts, k)
    x = np.sort(np.repeat(np.arange(len(n), dtype=np.uint64), n) << np.uint64(44) | hashes >> np.uint64(20))
    x = x[np.append(True, x[1:] != x[:-1])] if len(x) else x
    return x & np.uint64((1 << 44) - 1), np.bincount((x >> np.uint64(44)).astype(np.int64), minlength=len(n))


def _overlaps(runs: np.ndarray, size: np.ndarray, a: np.ndarray, b: np.ndarray, at_once: int = 4_000_000) -> np.ndarray:
    """How many runs the texts of each pair share."""
    starts, out = np.cumsum(size) - size, np.zeros(len(a), np.int64)
    upto, at = np.cumsum(size[a] + size[b]), 0
    while at < len(a):
        end = max(at + 1, int(np.searchsorted(upto, (upto[at - 1] if at else 0) + at_once)))
        both = []
        for x in (a[at:end], b[at:end]):
            n = size[x]
            where = np.repeat(starts[x] - (np.cumsum(n) - n), n) + np.arange(n.sum())
            both.append(np.repeat(np.arange(end - at, dtype=np.uint64) << np.uint64(44), n) | runs[where])
        met = np.sort(np.concatenate(both))
        met = met[1:][met[1:] == met[:-1]]
        out[at:end] = np.bincount((met >> np.uint64(44)).astype(np.int64), minlength=end - at)
        at = end
    return out


def similar_pairs(left: Sequence[str], right: Sequence[str], least: float, k: int) -> np.ndarray:
    """Which pairs of texts are similar. Overlaps are counted on hashes; where
    three more or less would decide, on the runs themselves."""
    numbers = {t: i for i, t in enumerate(dict.fromkeys([*left, *right]))}
    a, b = (np.array([numbers[t] for t in side], np.int64) for side in (left, right))
    runs, size = _sorted_runs(list(numbers), k)
    both, total = _overlaps(runs, size, a, b), size[a] + size[b]
    found = both - 3 >= least * (total - both + 3)
    for i in np.flatnonzero(~found & (both + 3 >= least * (total - both - 3))):
        found[i] = jaccard(left[i], right[i], k) >= least
    return found


def _verify(least: float, k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = similar_pairs(batch.column("ta").to_pylist(), batch.column("tb").to_pylist(), least, k)
            yield batch.select(["a", "b"]).filter(pa.array(found, pa.bool_()))

    return run


def _with_text(fields: tuple[str, ...]):
    forming = _forming(fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for formed in _formed(batches, fields, *forming):
            for _, _, texts, node in formed:
                yield pa.RecordBatch.from_arrays([pa.array(node), pa.array(texts, pa.string())], ["node", "text"])

    return run


class Texts:
    """Looks up the texts of nodes: one record of each is read again and brought
    into the consistent form, so that no text is moved or stored before it is
    known to be needed."""

    def __init__(self, rows: DataFrame, fields: Sequence[str], members: DataFrame):
        self.rows, self.fields, self.members = rows, tuple(fields), members

    def of(self, nodes: DataFrame) -> DataFrame:
        """``node``, ``text`` of the distinct ``node`` of ``nodes``."""
        wanted = cut(nodes.select("node").distinct())
        few = F.broadcast if wanted.count() <= LOOKED_UP else lambda df: df
        ids = self.members.join(few(wanted), "node", "left_semi").groupBy("node", "field").agg(F.min("id").alias("the id"))
        ids = ids.groupBy("the id").agg(*(F.bool_or(F.col("field") == f).alias(f"needs {i}") for i, f in enumerate(self.fields)))
        needed = [F.when(F.col(f"needs {i}"), F.col(f"`{f}`")).alias(f) for i, f in enumerate(self.fields)]
        found = self.rows.join(few(ids), "the id").select("the id", *needed).mapInArrow(_with_text(self.fields), "node long, text string")
        return found.join(few(wanted), "node", "left_semi").groupBy("node").agg(F.first("text").alias("text"))


def verified(pairs: DataFrame, sketches: DataFrame, texts: Texts, least: float = SIMILAR, k: int = RUN, bits: int = SKETCH_LEAST) -> DataFrame:
    """The pairs (``a``, ``b``) whose exact similarity is at least ``least``.
    Sketches part most others from them before any text is looked up."""
    if bits:
        # Already apart by b; a, the smaller node, is the one that many pairs of a large region have in common.
        pairs = pairs.join(sketches.toDF("b", "b1", "b2"), "b").join(sketches.toDF("a", "a1", "a2"), "a")
        pairs = pairs.where(f"bit_count(a1 ^ b1) + bit_count(a2 ^ b2) <= {SKETCH - bits}").select("a", "b")
    near = cut(pairs)
    text = cut(texts.of(near.select(F.col("a").alias("node")).union(near.select("b"))))
    with_texts = near.join(text.toDF("a", "ta"), "a").join(text.toDF("b", "tb"), "b")
    return with_texts.mapInArrow(_verify(least, k), "a long, b long")


def join_region(node: Sequence[int], texts: Sequence[str], root: Sequence[int], least: float, k: int, every: bool, pivots: int = PIVOTS) -> list[tuple[int, int]]:
    """The metric-space join of one region in memory: links (smaller node first)
    between its texts, each of at least ``k`` characters.

    Pivots create Voronoi cells; a text is in the cells whose window it lies in;
    what is in a pivot's ball is linked; cells are joined recursively. Of texts
    that pivots don't part, those are compared that no pivot keeps apart. Texts
    of equal ``root`` are connected beforehand; unless ``every`` link is wanted,
    only those that connect something are found. Overlaps are counted on hashes
    of runs; where equal hashes of different runs might decide, on the runs.
    """
    reach = 1 - least
    hashes, size = _sorted_runs(texts, k)
    runs = np.unique(hashes, return_inverse=True)[1]
    starts, held = np.cumsum(size) - size, np.zeros(runs.max(initial=0) + 1, np.int32)
    slack = 6 / size  # equal hashes of different runs may move a distance so far
    parent = {r: r for r in root}

    def find(r: int) -> int:
        while parent[r] != r:
            parent[r] = r = parent[parent[r]]
        return r

    links: set[tuple[int, int]] = set()

    def link(i: int, j: int, sure: bool) -> None:
        a, b = find(root[i]), find(root[j])
        if node[i] != node[j] and (every or a != b) and (sure or jaccard(texts[i], texts[j], k) >= least):
            parent[a] = b
            links.add((min(node[i], node[j]), max(node[i], node[j])))

    def distances(own: np.ndarray, others: np.ndarray) -> Iterator[np.ndarray]:
        """For each of ``others``, its distance to each of ``own``."""
        at = np.cumsum(size[own]) - size[own]
        flat = runs[np.repeat(starts[own] - at, size[own]) + np.arange(size[own].sum())]
        for p in others:
            mine = runs[starts[p] : starts[p] + size[p]]
            held[mine] = 1
            both = np.add.reduceat(held[flat], at)
            held[mine] = 0
            yield 1 - both / (size[own] + size[p] - both)

    def compare(own: np.ndarray, far: np.ndarray | None) -> None:
        for x, d in enumerate(distances(own, own)):
            near = (d <= reach + slack[own]) & (np.arange(len(own)) > x)
            if far is not None and near.any():
                near &= (np.abs(far - far[x]) <= reach + slack[own, None]).all(1)
            for y in np.flatnonzero(near):
                link(own[x], own[y], d[y] <= reach - slack[own[y]])

    todo = [np.arange(len(node))]
    while todo:
        own = todo.pop()
        if not every and len({find(root[i]) for i in own}) < 2:
            continue
        if len(own) <= pivots:
            compare(own, None)
            continue
        chosen = np.array(sorted(own, key=lambda i: xxhash.xxh3_64_intdigest(struct.pack("<qq", node[i], len(own))))[:pivots])
        far = np.stack(list(distances(own, chosen)), 1)
        for x, q in zip(*np.nonzero(far <= reach + slack[own, None]), strict=True):
            link(own[x], chosen[q], far[x, q] <= reach - slack[own[x]])
        inside = far <= far.min(1, keepdims=True) + 2 * reach + slack[own, None]
        # Cells that hold more pairs than the region itself don't part it.
        if (inside.sum(0).astype(float) ** 2).sum() >= len(own) ** 2:
            compare(own, far)
        else:
            todo += [own[c] for c in inside.T if c.sum() > 1]
    return sorted(links)


def _join_regions(least: float, k: int, every: bool):
    def run(group: pa.Table) -> pa.Table:
        links = join_region(*(group[c].to_pylist() for c in ("node", "text", "root")), least, k, every)
        return pa.table({"a": pa.array([a for a, _ in links], pa.int64()), "b": pa.array([b for _, b in links], pa.int64())})

    return run


def _regions(least: float, k: int):
    """Per part of a region, with all the region's pivots: distances to the
    pivots in reach, and the Voronoi regions a text belongs to, its own and those
    whose window it lies in."""
    reach = 1 - least

    def run(members: pa.Table, pivots: pa.Table) -> pa.Table:
        key, node, root, pivot, d, linked, home = [], [], [], [], [], [], []
        sets = [(p, _set(t, k)) for p, t in zip(pivots["pivot"].to_pylist(), pivots["pivot_text"].to_pylist(), strict=True)]
        if sets:
            for q, n, r, t in zip(*(members[c].to_pylist() for c in ("key", "node", "root", "text")), strict=True):
                own, far = _set(t, k), []
                for p, other in sets:
                    near = _similar(own, other)
                    far.append((1 - near, p, near >= least))
                nearest = min(far)
                for x, p, y in far:
                    if x <= nearest[0] + 2 * reach + 1e-9:
                        key.append(q)
                        node.append(n)
                        root.append(r)
                        pivot.append(p)
                        d.append(x)
                        linked.append(y)
                        home.append(p == nearest[1])
        return pa.table({"key": pa.array(key, pa.int64()), "node": pa.array(node, pa.int64()), "root": pa.array(root, pa.int64()), "pivot": pa.array(pivot, pa.int64()), "d": pa.array(d, pa.float64()), "linked": pa.array(linked, pa.bool_()), "home": pa.array(home, pa.bool_())})

    return run


def _blocks(least_bits: int):
    """Per pair of blocks of a region: the pairs of texts whose sketches are near."""

    def run(group: pa.Table) -> pa.Table:
        part = group["part"].to_numpy()
        node, s = group["node"].to_numpy(), np.stack([group["s1"].to_numpy(), group["s2"].to_numpy()], 1).view(np.uint64)
        one = part == group["i"][0].as_py()
        left, right = np.flatnonzero(one), np.flatnonzero(~one if group["i"][0] != group["j"][0] else one)
        a, b = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
        for x in left:
            off = np.bitwise_count(s[right] ^ s[x]).sum(1)
            near = right[(off <= SKETCH - least_bits) & (node[right] != node[x])]
            a.append(np.minimum(node[near], node[x]))
            b.append(np.maximum(node[near], node[x]))
        pairs = np.unique(np.stack([np.concatenate(a), np.concatenate(b)], 1), axis=0)
        return pa.table({"a": pairs[:, 0], "b": pairs[:, 1]})

    return run


def _in_balls(least_bits: int):
    """Per pair of blocks of a ball: the pairs of a left and another text whose sketches are near."""

    def run(group: pa.Table) -> pa.Table:
        node, left = group["node"].to_numpy(), group["left"].to_numpy()
        s = np.stack([group["s1"].to_numpy(), group["s2"].to_numpy()], 1).view(np.uint64)
        right = np.flatnonzero(~left)
        a, b = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
        for x in np.flatnonzero(left):
            off = np.bitwise_count(s[right] ^ s[x]).sum(1)
            near = right[(off <= SKETCH - least_bits) & (node[right] != node[x])]
            a.append(np.minimum(node[near], node[x]))
            b.append(np.maximum(node[near], node[x]))
        pairs = np.unique(np.stack([np.concatenate(a), np.concatenate(b)], 1), axis=0)
        return pa.table({"a": pairs[:, 0], "b": pairs[:, 1]})

    return run


def ball_pairs(held: DataFrame, nodes: DataFrame, reach: float, block: int = BLOCK, bits: int = SKETCH_LEAST) -> DataFrame:
    """The pairs to verify inside the balls of ``held``: each text with all of its
    nearest pivot's ball, block by block. Similar texts that a region's rest no
    longer holds both are such a pair."""
    ball = held.where(F.col("d") <= reach + 1e-9).select("key", "pivot", "node", "home")
    sizes = ball.groupBy("key", "pivot").agg(F.expr(f"cast(ceil(count(1) / {block}) as int)").alias("count"))
    ball = ball.join(sizes, ["key", "pivot"]).withColumn("part", F.pmod(F.xxhash64("node"), F.col("count")).cast("int")).join(nodes.select("node", "s1", "s2"), "node")
    each = ball.withColumn("other", F.explode(F.expr("sequence(0, count - 1)")))
    columns = ["key", "pivot", "i", "j", "node", "s1", "s2", "left"]
    left = each.where("home").withColumn("i", F.col("part")).withColumn("j", F.col("other")).withColumn("left", F.lit(True))
    right = each.withColumn("i", F.col("other")).withColumn("j", F.col("part")).withColumn("left", F.lit(False))
    return left.select(columns).unionByName(right.select(columns)).groupBy("key", "pivot", "i", "j").applyInArrow(_in_balls(bits), "a long, b long")


def metric_join(
    hot: DataFrame, nodes: DataFrame, least: float = SIMILAR, k: int = RUN, pivots: int = PIVOTS, block: int = BLOCK, bits: int = SKETCH_LEAST, every: bool = False, chars: int = REGION_CHARS
) -> tuple[DataFrame, DataFrame | None]:
    """(exact links, pairs to verify or none) of regions ``hot`` (``key``,
    ``node``, ``root``); ``nodes`` has ``node``, ``s1``, ``s2``, ``text``.

    A region of at most ``block`` texts and ``chars`` characters is joined by one
    task (:func:`join_region`). Larger ones are parted first: by pivots as there,
    but with their parts on many tasks and the new regions as rows; those that
    pivots hardly part are compared block by block. Texts of equal ``root`` are
    connected already; links that are in one ball are found only with ``every``.
    """
    reach, links, todo = 1 - least, [], []
    known = nodes.select("node", F.length("text").alias("chars"))
    left = cut(hot.select("key", "node", "root").distinct().withColumn("was", F.lit(None).cast("long")))
    while True:
        sizes = left.join(known, "node").groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.max("was").alias("was"), F.sum("chars").alias("chars"))
        sized = cut(left.drop("was").join(sizes, "key"))
        forget(left)
        fits = f"n <= {block} and chars <= {chars}"
        few = sized.where(fits).select("key", "node", "root").join(nodes.select("node", "text"), "node")
        links.append(cut(few.groupBy("key").applyInArrow(_join_regions(least, k, every), "a long, b long")))
        # Regions that pivots hardly parted are compared block by block.
        stuck = sized.where(f"not ({fits}) and n > 0.7 * was").withColumn("count", F.expr(f"cast(ceil(n / {block}) as int)"))
        big = sized.where(f"not ({fits}) and (was is null or n <= 0.7 * was)")
        if not stuck.isEmpty():
            stuck = stuck.withColumn("part", F.pmod(F.xxhash64("node"), F.col("count")).cast("int")).join(nodes.select("node", "s1", "s2"), "node")
            copies = stuck.withColumn("o", F.explode(F.expr("sequence(0, count - 1)"))).withColumn("i", F.least("part", "o")).withColumn("j", F.greatest("part", "o"))
            todo.append(cut(copies.select("key", "i", "j", "part", "node", "s1", "s2").groupBy("key", "i", "j").applyInArrow(_blocks(bits), "a long, b long")))
        if big.isEmpty():
            forget(sized)
            break
        # About as many pivots as wanted, by a hash below a bound: no region is sorted.
        chance = F.expr(f"(xxhash64(key, node) & {2**53 - 1}L) / {float(2**53)}")
        picked = cut(big.where(chance < F.lit(2.0 * pivots) / F.col("n")).select("key", "node", "n"))
        unpicked = big.join(picked.select("key").distinct(), "key", "left_anti")
        # Parts of a region of bounded size, each with all pivots of the region.
        parts = F.expr(f"cast(ceil(n / {block}) as int)")
        text = nodes.select("node", "text")
        members = big.join(picked.select("key").distinct(), "key", "left_semi").withColumn("part", F.pmod(F.xxhash64("node"), parts)).join(text, "node").select("key", "part", "node", "root", "text")
        each = picked.withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), parts.cast("long") - 1))).join(text, "node")
        each = each.select(F.col("key").alias("of"), F.col("part").alias("in_part"), F.col("node").alias("pivot"), F.col("text").alias("pivot_text"))
        held = cut(members.groupBy("key", "part").cogroup(each.groupBy("of", "in_part")).applyInArrow(_regions(least, k), "key long, node long, root long, pivot long, d double, linked boolean, home boolean"))
        links.append(held.where(F.col("linked") & (F.col("node") != F.col("pivot"))).select(F.least("node", "pivot").alias("a"), F.greatest("node", "pivot").alias("b")))
        if every:
            todo.append(cut(ball_pairs(held, nodes, reach, block, bits)))
        # Of a ball, only what may be near a text outside it stays.
        outside = held.where(f"d > {reach}").groupBy("key", "pivot").agg(F.min("d").alias("outer"))
        rest = held.join(outside, ["key", "pivot"]).where(f"d > {reach} or d >= outer - {reach} - 1e-9").join(sized.select("key", "n").distinct(), "key")
        parted = rest.select(F.xxhash64("key", "pivot").alias("key"), "node", "root", F.col("n").alias("was"))
        left = cut(parted.unionByName(unpicked.select("key", "node", "root", F.col("n").alias("was"))))
        forget(sized, picked)
    union = lambda x: None if not x else x[0] if len(x) == 1 else union([x[0].unionByName(x[1]), *x[2:]])
    return union(links), union(todo)


def similar_groups(
    df: DataFrame, id_column: str, fields: Sequence[str], least: float = SIMILAR, k: int = RUN, rows: int = ROWS, bands: int = BANDS,
    small: int = SMALL, block: int = BLOCK, buckets: int | None = None, links: bool = False, exact: bool = False,
) -> DataFrame:
    """``field``, the id, ``node`` (equal for equal texts) and ``group`` (the
    smallest node of the group) of every record whose text isn't null, for each
    field on its own. With ``links`` also ``links``, the distinct other texts
    found similar; for it all pairs of a ball are compared, which groups don't need.

    With ``exact`` regions are made by rare runs instead of bands, and sketches
    aren't used, so that no pair can be lost: for corpora of up to some 10^5
    texts, as the regions of a run grow with the corpus.

    Repeated rows of an id count once; texts below ``k`` characters are similar
    to equal ones only; records without an id are left out. ``df`` is read up to
    three times and must give the same rows each time.
    """
    spark, fields, bits = df.sparkSession, tuple(fields), 0 if exact else SKETCH_LEAST
    texts = df.select(F.col(f"`{id_column}`").cast("string").alias("the id"), *(F.col(f"`{f}`") for f in fields)).where("`the id` is not null")
    n = buckets or min(BUCKETS, max(int(spark.conf.get("spark.sql.shuffle.partitions")), source_bytes(texts) // BUCKET_BYTES))
    counts = rarity(texts, fields, k) if exact else None
    signed = texts.mapInArrow(_sign(fields, n, rows, bands, k, least, counts), STAGED)
    met = cut(signed.repartitionById(n, "bucket").mapInArrow(_meet(small), STAGED), "neardup")
    members = met.where(f"kind = {_NODE}").select("field", "id", F.col("a").alias("node"))
    sketches = met.where(f"kind = {_NODE} and (s1 <> 0 or s2 <> 0)").groupBy(F.col("a").alias("node")).agg(F.min("s1").alias("s1"), F.min("s2").alias("s2"))
    look = Texts(texts, fields, members)
    edges = cut(verified(met.where(f"kind = {_EDGE}").select("a", "b").repartition("b").distinct(), sketches, look, least, k, bits))
    roots = cut(components(edges))
    # What a region's texts are connected to already; those of one root need no more links.
    hot = met.where(f"kind = {_HOT}").select(F.col("a").alias("key"), F.col("b").alias("node"))
    hot = hot.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    if not links:
        several = hot.groupBy("key").agg(F.min("root").alias("lo"), F.max("root").alias("hi")).where("lo <> hi").select("key")
        hot = hot.join(several, "key", "left_semi")
    hot = cut(hot)
    if not hot.isEmpty():
        nodes = cut(sketches.join(look.of(hot), "node"))
        more, pairs = metric_join(hot, nodes, least, k, block=block, bits=bits, every=links)
        if pairs is not None:
            more = more.unionByName(verified(pairs.distinct(), sketches, look, least, k, bits))
        more = cut(more.distinct())
        # The components so far are the nodes of those that the new links make.
        ends = more.join(roots.toDF("a", "ra"), "a", "left").join(roots.toDF("b", "rb"), "b", "left").select(F.coalesce("ra", "a").alias("a"), F.coalesce("rb", "b").alias("b"))
        joined = cut(components(ends)).toDF("root", "new")
        both = roots.join(joined, "root", "left").select("node", F.coalesce("new", "root").alias("root"))
        alone = joined.join(roots, joined["root"] == roots["node"], "left_anti").select(F.col("root").alias("node"), F.col("new").alias("root"))
        roots = both.unionByName(alone)
        edges = edges.unionByName(more).distinct()
    grouped = members.distinct().join(roots, "node", "left")
    found = ["field", F.col("id").alias(id_column), "node", F.coalesce("root", "node").alias("group")]
    if not links:
        return grouped.select(*found)
    degree = edges.select(F.col("a").alias("node")).union(edges.select("b")).groupBy("node").agg(F.count(F.lit(1)).alias("links"))
    return grouped.join(degree, "node", "left").select(*found, F.coalesce("links", F.lit(0)).alias("links"))


def pairs_in_groups(groups: DataFrame, id_column: str, part: int = 2048) -> DataFrame:
    """Each pair of records of a group, smaller id first, per field. A large
    group's records meet in parts of about ``part``, so that no task has to pair
    all of it."""
    parts = F.expr(f"cast(ceil(count(1) / {part}) as int)")
    several = groups.groupBy("field", "group").agg(F.count(F.lit(1)).alias("n"), parts.alias("parts")).where("n > 1").drop("n")
    kept = groups.select("field", "group", id_column).join(several, ["field", "group"])
    a = kept.withColumn("part", F.pmod(F.xxhash64(id_column), "parts")).select("field", "group", "part", F.col(id_column).alias(f"{id_column}_a"))
    b = kept.withColumn("part", F.explode(F.expr("sequence(0L, parts - 1L)"))).select("field", "group", "part", F.col(id_column).alias(f"{id_column}_b"))
    return a.join(b, ["field", "group", "part"]).where(f"{id_column}_a < {id_column}_b").select(f"{id_column}_a", f"{id_column}_b", "field")
