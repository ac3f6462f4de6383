"""The min-cost flow of problem 7 over blocks of membership patterns.

Residual paths lead from a pattern that has tokens left over sources, each of
which gives some of a pattern's tokens up to the next, to a source that lacks
some. The driver sees what can go from source to source, summed over patterns,
and picks a shortest path; the blocks carry it out. So patterns may lie in
memory or, in any number, in a Spark table.
"""

from __future__ import annotations

from collections import deque
from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from patraloom.session import cut, forget

#: Starts of a move: tokens no source uses, for one source or for all that lack some at once.
FREE, DIRECT = -1, -2
#: Flows in a block, and pairs of cells that are compared at once.
BLOCK = 1 << 19
PAIRS = 1 << 21
#: Patterns in a task.
TASK = 50_000

Sums = dict[int, dict[tuple[int, int], int]]
Offers = dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]]
Move = tuple[int, int, int, int]


class Term(NamedTuple):
    """The repetition a plan is at, if it is the last, and the sources that lack tokens."""

    level: int
    last: bool
    lacking: tuple[int, ...]


class Block:
    """Patterns' cells (a source of it each, ascending) from ``ptr[i]`` to ``ptr[i + 1]``; ``flow`` has a row per plan."""

    def __init__(self, ptr: np.ndarray, src: np.ndarray, own: np.ndarray, distinct: np.ndarray, flow: np.ndarray) -> None:
        self.ptr, self.src, self.own, self.distinct, self.flow = ptr, src, own, distinct, flow
        self.pattern = np.repeat(np.arange(len(distinct)), np.diff(ptr))

    def left(self, plan: int, term: Term, repeats: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """What each cell can still take, and each pattern still give."""
        room = self.own * np.clip(repeats[plan][self.src], 0, term.level)
        top = np.add.reduceat(room, self.ptr[:-1]) if term.last else self.distinct * term.level
        return np.maximum(room - self.flow[plan], 0), np.maximum(top - np.add.reduceat(self.flow[plan], self.ptr[:-1]), 0)

    def capacities(self, plan: int, term: Term, repeats: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """Tokens that can go from each start to each source: (from, to, tokens)."""
        slack, free = self.left(plan, term, repeats)
        open_ = np.minimum(slack, free[self.pattern])
        at = np.flatnonzero(open_)
        yield np.full(len(at), FREE), self.src[at], open_[at]
        # A source takes what those before it in the pattern leaves in any case, so all of these may move together.
        asked = np.where(np.isin(self.src, term.lacking), open_, 0)
        before = np.cumsum(asked) - asked
        direct = np.clip(free[self.pattern] - (before - before[self.ptr[self.pattern]]), 0, asked)
        at = np.flatnonzero(direct)
        yield np.full(len(at), DIRECT), self.src[at], direct[at]
        givers = np.flatnonzero(self.flow[plan])
        sizes = np.diff(self.ptr)[self.pattern[givers]]
        ends = np.cumsum(sizes)
        start = 0
        while start < len(givers):
            done = ends[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, done + PAIRS, "right")))
            n = sizes[start:stop]
            giver = np.repeat(givers[start:stop], n)
            taker = self.ptr[self.pattern[giver]] + np.arange(len(giver)) - np.repeat(np.cumsum(n) - n, n)
            tokens = np.where(giver == taker, 0, np.minimum(self.flow[plan][giver], slack[taker]))
            at = np.flatnonzero(tokens)
            yield self.src[giver[at]], self.src[taker[at]], tokens[at]
            start = stop

    def move(self, plan: int, term: Term, repeats: np.ndarray, a: int, b: int, tokens: int) -> None:
        """Let ``tokens`` go from ``a`` to ``b``, out of the first patterns that have them."""
        slack, free = self.left(plan, term, repeats)
        to, of = np.flatnonzero(self.src == b), None
        if a < 0:
            most = np.minimum(slack[to], free[self.pattern[to]])
        else:
            of = np.flatnonzero(self.src == a)
            _, i, j = np.intersect1d(self.pattern[of], self.pattern[to], assume_unique=True, return_indices=True)
            of, to = of[i], to[j]
            most = np.minimum(self.flow[plan][of], slack[to])
        goes = np.clip(tokens - (np.cumsum(most) - most), 0, most)
        if goes.sum() != tokens:
            raise AssertionError("a block can't move what it offered")
        self.flow[plan][to] += goes
        if of is not None:
            self.flow[plan][of] -= goes

    def step(self, now: dict[int, Term], moves: list[Move], then: dict[int, Term], repeats: np.ndarray) -> Offers:
        """Carry ``moves`` out; what can move in the terms that follow."""
        for plan, a, b, tokens in moves:
            self.move(plan, now[plan], repeats, a, b, tokens)
        offers: Offers = {}
        for plan, term in then.items():
            keys, totals = zip(*(_summed(a.astype(np.int64) * repeats.shape[1] + b, tokens) for a, b, tokens in self.capacities(plan, term, repeats)))
            key, total = _summed(np.concatenate(keys), np.concatenate(totals))
            offers[plan] = (*np.divmod(key, repeats.shape[1]), total)
        return offers


def _summed(key: np.ndarray, tokens: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    key, at = np.unique(key, return_inverse=True)
    total = np.zeros(len(key), np.int64)
    np.add.at(total, at, tokens)
    return key, total


def sums(offers: Offers) -> Sums:
    """The offers of a single block."""
    return {plan: dict(zip(zip(a.tolist(), b.tolist()), tokens.tolist())) for plan, (a, b, tokens) in offers.items()}


def path(offered: dict[tuple[int, int], int], lack: list[int]) -> list[tuple[int, int, int]]:
    """The next moves of a plan, each (from, to, tokens): all direct ones, else
    those of a shortest path, its end first. None where no path is left."""
    direct = [(DIRECT, s, min(t, lack[s])) for (a, s), t in sorted(offered.items()) if a == DIRECT and lack[s]]
    if direct:
        return direct
    takers: dict[int, list[int]] = {}
    for a, b in sorted(offered):
        if a != DIRECT:
            takers.setdefault(a, []).append(b)
    came: dict[int, int] = {b: FREE for b in takers.get(FREE, [])}
    queue = deque(came)
    while queue:
        at = queue.popleft()
        if lack[at]:
            hops = []
            tokens, end = lack[at], at
            while end != FREE:
                hops.append((came[end], end))
                tokens, end = min(tokens, offered[came[end], end]), came[end]
            return [(a, b, tokens) for a, b in hops]
        for b in takers.get(at, []):
            if b not in came:
                came[b] = at
                queue.append(b)
    return []


def solve(lack: list[list[int]], repeats: np.ndarray, step: Callable[[dict[int, Term], list[Move], dict[int, Term]], Sums]) -> None:
    """Run every plan to its end; ``lack`` has the tokens each source of a plan can and should get."""
    levels = dict.fromkeys(range(len(lack)), 1)
    now: dict[int, Term] = {}
    moves: list[Move] = []
    while True:
        then = {p: Term(n, n > repeats[p].max(initial=0), tuple(s for s, t in enumerate(lack[p]) if t)) for p, n in levels.items() if any(lack[p])}
        if not then and not moves:
            return
        offered = step(now, moves, then)
        now, moves = then, []
        for p, term in then.items():
            found = path(offered.get(p, {}), lack[p])
            for a, b, tokens in found:
                moves.append((p, a, b, tokens))
            if found and found[0][0] == DIRECT:
                for _, b, tokens in found:
                    lack[p][b] -= tokens
            elif found:
                lack[p][found[0][1]] -= found[0][2]
            elif term.last:
                del levels[p]
            else:
                levels[p] += 1


_STATE = "block string, ptr binary, src binary, own binary, distinct binary, flow binary, caps array<struct<plan: int, a: int, b: int, tokens: bigint>>"
_CAP = [pa.field("plan", pa.int32()), pa.field("a", pa.int32()), pa.field("b", pa.int32()), pa.field("tokens", pa.int64())]
_ARROW = pa.schema([("block", pa.string()), *((c, pa.binary()) for c in ("ptr", "src", "own", "distinct", "flow")), ("caps", pa.list_(pa.struct(_CAP)))])


def _blocks(plans: int):
    """Rows of patterns in blocks of a bounded number of flows."""
    size = BLOCK

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, number = TaskContext.get().partitionId(), 0
        for batch in batches:
            src, own, distinct = (batch.column(c) for c in ("src", "own", "distinct"))
            ptr = np.concatenate([[0], np.cumsum(src.value_lengths().to_numpy())]).astype(np.int64)
            part = ptr[:-1] * plans // size
            bounds = [0, *(np.flatnonzero(np.diff(part)) + 1), len(part)] if len(part) else [0]
            source, tokens = src.flatten().to_numpy().astype(np.int64), own.flatten().to_numpy()
            for i, j in zip(bounds, bounds[1:]):
                at = slice(ptr[i], ptr[j])
                row = {"block": f"{task:08d}-{number:08d}", "pattern": batch.column("pattern").slice(i, j - i).to_pylist(), "ptr": (ptr[i : j + 1] - ptr[i]).tobytes()}
                row |= {"src": source[at].tobytes(), "own": tokens[at].tobytes(), "distinct": distinct.to_numpy()[i:j].tobytes()}
                number += 1
                yield pa.RecordBatch.from_pylist([row], pa.schema([("block", pa.string()), ("pattern", pa.list_(pa.list_(pa.string()))), *((c, pa.binary()) for c in ("ptr", "src", "own", "distinct"))]))

    return run


def _read(row: dict, plans: int) -> Block:
    ptr, src, own, distinct = (np.frombuffer(row[c], np.int64) for c in ("ptr", "src", "own", "distinct"))
    flow = np.frombuffer(row["flow"], np.int64).reshape(plans, -1).copy() if row["flow"] else np.zeros((plans, len(src)), np.int64)
    return Block(ptr, src, own, distinct, flow)


def _step(now: dict[int, Term], moves: dict[str, list[Move]], then: dict[int, Term], repeats: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1).to_pylist()[0]
                block = _read(row, len(repeats))
                offers = block.step(now, moves.get(row["block"], []), then, repeats)
                each = [(np.full(len(a), p), a, b, t) for p, (a, b, t) in offers.items()]
                columns = [pa.array(np.concatenate(c) if each else [], f.type) for c, f in zip(zip(*each) if each else [()] * 4, _CAP)]
                caps = pa.ListArray.from_arrays(pa.array([0, len(columns[0])], pa.int32()), pa.StructArray.from_arrays(columns, fields=_CAP))
                row["flow"] = block.flow.tobytes()
                yield pa.RecordBatch.from_arrays([*(pa.array([row[c]], _ARROW.field(c).type) for c in _ARROW.names[:-1]), caps], schema=_ARROW)

    return run


def _taken(names: list[list[str]], repeats: np.ndarray):
    """What each plan's source takes of each pattern."""
    plans, sources = names

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                one = batch.slice(i, 1)
                block = _read(one.drop_columns(["pattern"]).to_pylist()[0], len(repeats))
                patterns = one.column("pattern").flatten()
                for p, name in enumerate(plans):
                    at = np.flatnonzero(block.flow[p])
                    columns = [pa.array([name] * len(at), pa.string()), pa.array(sources, pa.string()).take(pa.array(block.src[at])), patterns.take(pa.array(block.pattern[at])), pa.array(block.own[at]), pa.array(block.flow[p][at])]
                    yield pa.RecordBatch.from_arrays(columns, ["plan", "source", "pattern", "own_tokens", "upto"])

    return run


def spread(patterns: DataFrame, plans: list[str], sources: list[str], lack: list[list[int]], repeats: np.ndarray) -> DataFrame:
    """The flow over a table of patterns: ``plan``, ``source``, ``pattern``,
    ``own_tokens`` and ``upto``, what the source takes of it.

    ``patterns`` has ``pattern``, ``distinct`` and, by ascending number of the
    source, ``src`` and ``own``. Each round is a pass over the blocks; the driver
    gets at most one sum per plan and two sources, and for the moves of a round
    one per block.
    """
    spark = patterns.sparkSession
    tasks = patterns.count() // TASK + 1
    placed = patterns.repartition(tasks, "pattern").sortWithinPartitions("pattern")
    base = cut(placed.mapInArrow(_blocks(len(plans)), "block string, pattern array<array<string>>, ptr binary, src binary, own binary, distinct binary"))
    state = base.drop("pattern").select("*", F.lit(None).cast("binary").alias("flow"), F.lit(None).alias("caps"))

    def step(now: dict[int, Term], moves: list[Move], then: dict[int, Term]) -> Sums:
        nonlocal state
        shares: dict[str, list[Move]] = {}
        if moves:
            wanted = spark.createDataFrame([m[:3] for m in moves], "plan int, a int, b int")
            offers: dict[tuple[int, int, int], list[tuple[str, int]]] = {}
            for r in state.select("block", F.inline("caps")).join(F.broadcast(wanted), ["plan", "a", "b"]).orderBy("block").collect():
                offers.setdefault((r["plan"], r["a"], r["b"]), []).append((r["block"], r["tokens"]))
            for p, a, b, tokens in moves:
                for block, most in offers[p, a, b]:
                    if tokens:
                        shares.setdefault(block, []).append((p, a, b, min(tokens, most)))
                        tokens -= min(tokens, most)
        before, state = state, cut(state.drop("caps").mapInArrow(_step(now, shares, then, repeats), _STATE))
        forget(before)
        found: Sums = {}
        for r in state.select(F.inline("caps")).groupBy("plan", "a", "b").agg(F.sum("tokens").alias("t")).collect():
            found.setdefault(r["plan"], {})[r["a"], r["b"]] = r["t"]
        return found

    solve(lack, repeats, step)
    both = state.drop("caps").join(base.select("block", "pattern"), "block")
    taken = cut(both.mapInArrow(_taken([plans, sources], repeats), "plan string, source string, pattern array<string>, own_tokens bigint, upto bigint"))
    forget(state, base)
    return taken
