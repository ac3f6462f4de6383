"""Problem 5: abusive, hateful or sexual content, by compression distance.

Two zstandard dictionaries are trained, one on toxic and one on ordinary
windows (sentences). A window is scored by how many bytes shorter it gets with
the toxic dictionary than with the ordinary one, per byte; a record by its
highest window. The threshold is calibrated on held-out windows.

The scores at hand belong to whole records and are partly wrong, so training
windows are first cleaned: for each word pair and triple the share of
high-scored records that hold it is counted, and a window is toxic or ordinary
by the mean log-odds of its own. The content of the trained dictionaries is then
extended by whole windows, those they get wrong last. The training sample is bounded
(``SAMPLE`` records with the smallest hashes); scoring covers every record.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from patraloom.llm.canonical import connection, duckdb_query, several_map

#: Training records at most, bytes of a dictionary, and zstandard's level.
SAMPLE, DICTIONARY, LEVEL = 24_000, 65_536, 3
#: Scores from which a training record counts as toxic, and up to which as ordinary.
HIGH, LOW = 0.90, 0.05
#: Mean log-odds from which a training window is toxic, and below which ordinary.
TOXIC, ORDINARY = 0.3, 0.15
#: Characters of a window at most; longer sentences give overlapping windows.
WINDOW = 240
#: Times a window is given to the training of a dictionary at most, by how many texts hold it.
COPIES = 20
#: Every so many training windows one is held out for the threshold.
HOLD_OUT = 5

# Digits and signs written for letters.
SIGNS, LETTERS = "013457@$", "oieastas"
_SIGNED = str.maketrans(SIGNS, LETTERS)
_SPACED = re.compile(r"(?<![A-Za-z0-9])(?:[A-Za-z0-9]([ ._\-*]))(?:[A-Za-z0-9]\1)+[A-Za-z0-9](?![A-Za-z0-9])")
_MAY_BE_SPACED = re.compile(r"[ ._\-*][A-Za-z0-9][ ._\-*][A-Za-z0-9](?![A-Za-z0-9])")
_MIXED = re.compile(r"[A-Za-z@$]+[0-9@$][\w@$]*|[0-9@$]+[A-Za-z][\w@$]*")
_MAY_BE_MIXED = re.compile(r"[A-Za-z][0-9@$]|[0-9@$][A-Za-z]")
_DRAWN_OUT = re.compile(r"([A-Za-z])\1{2,}")
_END = re.compile(r"(?<=[.?!।॥])\s+|\n+")
_WORD = re.compile(r"\w+")


def plain_spelling(text: str) -> str:
    """Lower case, without letters drawn out, set apart or replaced by signs."""
    if _MAY_BE_SPACED.search(text):
        text = _SPACED.sub(lambda m: m.group(0).replace(m.group(1), ""), text)
    if _MAY_BE_MIXED.search(text):
        text = _MIXED.sub(lambda m: m.group(0).translate(_SIGNED), text)
    return _DRAWN_OUT.sub(r"\1", text).lower()


def windows(text: str | None) -> list[str]:
    """The sentences of a text in plain spelling, long ones in overlapping parts."""
    out = []
    for s in _END.split(plain_spelling(text or "")):
        while len(s) > WINDOW:
            at = s.rfind(" ", WINDOW // 2, WINDOW)
            at = at if at > 0 else WINDOW
            out.append(s[:at])
            s = s[at // 2 :].lstrip()
        if s:
            out.append(s)
    return out


def _grams(window: str) -> set[tuple]:
    w = _WORD.findall(window)
    return {*zip(w, w[1:]), *zip(w, w[1:], w[2:]), *((a, None, b) for a, b in zip(w, w[2:]))}


def clean_windows(rows: Iterable[tuple[str, bool]]) -> dict[str, tuple[bool, int]]:
    """Distinct windows of (text, high-scored) rows that are clearly toxic (true)
    or ordinary (false), and how many texts hold them. Equal texts count once."""
    held = {tuple(windows(t)): y for t, y in rows}
    high, total = Counter(), Counter()
    grams = {w: _grams(w) for ws in held for w in ws}
    for ws, y in held.items():
        own = set().union(*(grams[w] for w in ws)) if ws else set()
        total.update(own)
        if y:
            high.update(own)
    odds = {g: math.log((high[g] + 0.6) / (n - high[g] + 1.4)) for g, n in total.items() if n >= 4}
    often = Counter(w for ws in held for w in set(ws))
    out = {}
    for w, own in grams.items():
        known = [odds[g] for g in own if g in odds]
        mean = sum(known) / len(known) if known else -1.0
        if mean >= TOXIC or mean < ORDINARY:
            out[w] = (mean >= TOXIC, often[w])
    return out


@dataclass
class Model:
    """Dictionaries and threshold; small enough to travel with each task."""

    toxic: bytes
    ordinary: bytes
    threshold: float
    level: int = LEVEL
    _made: tuple | None = field(default=None, repr=False, compare=False)

    def __getstate__(self) -> dict:
        return self.__dict__ | {"_made": None}

    def score(self, window: str) -> float:
        if self._made is None:
            self._made = tuple(_compressor(d, self.level) for d in (self.toxic, self.ordinary))
        raw = window.encode("utf-8", "replace")
        if not raw:
            return 0.0
        return (len(self._made[1].compress(raw)) - len(self._made[0].compress(raw))) / len(raw)


def _compressor(dictionary: bytes, level: int) -> zstandard.ZstdCompressor:
    held = zstandard.ZstdCompressionDict(dictionary)
    held.precompute_compress(level=level)
    return zstandard.ZstdCompressor(level=level, dict_data=held, write_content_size=False, write_checksum=False, write_dict_id=False)


def _dictionary(samples: list[str], size: int) -> bytes:
    """A trained dictionary; of too few samples, their text itself."""
    raw = [s.encode() for s in samples]
    try:
        return zstandard.train_dictionary(min(size, max(1024, sum(map(len, raw)) // 4)), raw).as_bytes()
    except zstandard.ZstdError:
        return b" ".join(raw)[-size:] or b" " * 8


def _best_threshold(scores: list[float], truth: list[bool], weights: list[int]) -> float:
    """The cutoff with the best weighted F1, halfway to the next score."""
    order = sorted(zip(scores, truth, weights, strict=True), key=lambda x: -x[0])
    hits = taken = 0
    wanted, best, at = sum(w for _, y, w in order if y), -1.0, math.inf
    for k, (s, y, w) in enumerate(order, 1):
        hits += w * y
        taken += w
        below = order[k][0] if k < len(order) else s
        if below < s or k == len(order):
            f1 = 2 * hits / (taken + wanted) if wanted else 0.0
            if f1 > best:
                best, at = f1, (s + below) / 2
    return at


def _dictionaries(train: list[tuple[str, bool]], often: dict[str, int], size: int, level: int) -> Model:
    """A model without a threshold."""
    sets = {y: [w for w, k in train if k == y] for y in (True, False)}
    # A frequent window is a frequent sample.
    trained = {y: _dictionary([w for w in v for _ in range(min(COPIES, often[w]))], size) for y, v in sets.items()}
    # Training keeps what recurs within the samples; the room it leaves is filled with whole windows.
    filled = {y: trained[y] + " ".join(sets[y]).encode()[: max(0, size - len(trained[y]))] for y in sets}
    model, wrong = Model(filled[True], filled[False], 0.0, level), {True: {}, False: {}}
    for _ in range(2):
        scores = [model.score(w) for w, _ in train]
        cut = _best_threshold(scores, [y for _, y in train], [often[w] for w, _ in train])
        for (w, y), s in zip(train, scores, strict=True):
            if (s >= cut) != y:
                wrong[y][w] = None
        # What was wrong is nearest to the end, where matches are cheapest.
        model = Model(*(filled[y] + " ".join(wrong[y]).encode()[-size:] for y in (True, False)), 0.0, level)
    return model


def fit(rows: Iterable[tuple[str, bool]], size: int = DICTIONARY, level: int = LEVEL) -> Model:
    """A model of (text, high-scored) rows: the threshold from windows held out
    of a first model, the dictionaries from all. Without a clearly toxic and a
    clearly ordinary window it flags nothing."""
    found = clean_windows(rows)
    labelled = [(w, y) for w, (y, _) in sorted(found.items(), key=lambda x: _order(x[0]))]
    if len({y for _, y in labelled}) < 2:
        return Model(b" " * 8, b" " * 8, math.inf, level)
    often = {w: n for w, (_, n) in found.items()}
    # A frequent window will come again, so it is always trained on, and counts for the threshold too.
    frequent, others = [x for x in labelled if often[x[0]] >= COPIES], [x for x in labelled if often[x[0]] < COPIES]
    held, train = others[::HOLD_OUT] + frequent, [x for i, x in enumerate(others) if i % HOLD_OUT] + frequent
    if len({y for _, y in train}) < 2:
        held = train = labelled
    first = _dictionaries(train, often, size, level)
    model = _dictionaries(labelled, often, size, level)
    model.threshold = _best_threshold([first.score(w) for w, _ in held], [y for _, y in held], [often[w] for w, _ in held])
    return model


def _order(window: str) -> bytes:
    """A fixed order unrelated to the text."""
    import hashlib

    return hashlib.blake2b(window.encode(), digest_size=8).digest()


def _formed(batch: pa.RecordBatch, con, sql: str) -> pa.Table:
    return con.from_arrow(pa.Table.from_batches([batch])).query("batch", sql).to_arrow_table()


def training_rows(df: DataFrame, id_column: str, text: str, score: str, sample: int = SAMPLE) -> list[tuple[str, bool]]:
    """At most ``sample`` distinct records with a text and a clear score, those
    with the smallest hashes of their ids among about three times as many whose
    hash is below a bound, in the consistent form of problem 1."""
    rows = df.select(F.col(id_column).alias("id"), F.col(text).alias("the text"), F.col(score).alias("p"))
    rows = rows.where(f"id is not null and `the text` is not null and not isnan(p) and (p >= {HIGH} or p <= {LOW})")
    # A hash below a bound leaves about three times the sample, wherever it is.
    n = rows.count()
    near = rows.withColumn("k", F.xxhash64(F.lit(7), "id")).where(F.expr(f"(k & {2**53 - 1}L) / {float(2**53)}") < min(1.0, 3.0 * sample / max(n, 1)))
    once = near.dropDuplicates(["id"]).orderBy("k", "id").limit(sample).select("the text", (F.col("p") >= HIGH).alias("y"))
    table = once.toArrow()
    con = connection()
    done = con.from_arrow(table).query("batch", duckdb_query("batch", ("y",), (("the text", "the text"),))).to_arrow_table()
    return list(zip(done["the text"].to_pylist(), done["y"].to_pylist(), strict=True))


def scores(df: DataFrame, model: Model, keep: list[str], text: str = "text_eng") -> DataFrame:
    """The columns ``keep``, and ``tox_score`` (double; null for a null text, 0
    for a blank one) and ``toxic`` of every row."""
    schema = T.StructType([*(df.schema[c] for c in keep), T.StructField("tox_score", T.DoubleType()), T.StructField("toxic", T.BooleanType())])

    sql, several = duckdb_query("batch", tuple(keep), (("the text", "the text"),)), several_map()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        con = connection(several)
        for batch in batches:
            if not batch.num_rows:
                continue
            done = _formed(batch, con, sql)
            made = []
            for t in done["the text"].to_pylist():
                made.append(None if t is None else max(map(model.score, windows(t)), default=0.0))
            score = pa.array(made, pa.float64())
            flag = pa.array([None if s is None else s >= model.threshold for s in made], pa.bool_())
            yield from pa.Table.from_arrays([*(done[c] for c in keep), score, flag], [*keep, "tox_score", "toxic"]).to_batches()

    needed = [F.col(f"`{c}`") for c in keep]
    return df.select(*needed, F.col(f"`{text}`").alias("the text")).mapInArrow(run, schema)


def record_scores(pairs: DataFrame, release: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """``example_id``, ``source_config``, ``tox_score``, ``toxic`` of each record
    of ``pairs`` (repeated rows once), by a model fitted to ``release``."""
    model = fit(training_rows(release, "example_id", "text_eng", "teacher_prob_hate", sample))
    each = scores(pairs.where("example_id is not null"), model, ["example_id", "source_config"])
    return each.groupBy("example_id").agg(F.max("source_config").alias("source_config"), F.max("tox_score").alias("tox_score"), F.max("toxic").alias("toxic"))


def rates(scored: DataFrame, source: str = "source_config") -> DataFrame:
    """Records, toxic records and their share, per source (null is a source)."""
    return scored.groupBy(source).agg(
        F.count(F.lit(1)).alias("records"), F.count("tox_score").alias("scored"), F.count_if("toxic").alias("toxic_records"),
        F.try_divide(F.count_if("toxic"), F.count("tox_score")).alias("toxic_rate"),
    )
