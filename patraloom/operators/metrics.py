"""Classification metrics from confusion counts, and what is built on them."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from patraloom.functions.ids import unit_fraction


def _ratio(a: Column, b: Column) -> Column:
    return F.coalesce(F.try_divide(a.cast("double"), b.cast("double")), F.lit(0.0))


def confusion(df: DataFrame, gold: str, pred: str, *by: str) -> DataFrame:
    """``tn fp fn tp`` per group; rows with a null in either don't count."""
    g, p = F.col(gold), F.col(pred)
    cells = {"tn": (g == 0) & (p == 0), "fp": (g == 0) & (p == 1), "fn": (g == 1) & (p == 0), "tp": (g == 1) & (p == 1)}
    return df.groupBy(*by).agg(*(F.count_if(c).alias(k) for k, c in cells.items()))


def metrics_of(cells: DataFrame) -> DataFrame:
    """Adds all metrics to a frame with ``tn fp fn tp``; 0 where undefined, the
    correlation 0 too if only one gold or predicted class occurs."""
    tn, fp, fn, tp = map(F.col, ("tn", "fp", "fn", "tp"))
    n = tn + fp + fn + tp
    p1, r1, p0, r0 = _ratio(tp, tp + fp), _ratio(tp, tp + fn), _ratio(tn, tn + fn), _ratio(tn, tn + fp)
    f1, f0 = _ratio(2 * tp, 2 * tp + fp + fn), _ratio(2 * tn, 2 * tn + fp + fn)
    d = lambda c: c.cast("double")
    mcc = _ratio(d(tp) * d(tn) - d(fp) * d(fn), F.sqrt(d(tp + fp) * d(tp + fn) * d(tn + fp) * d(tn + fn)))
    return cells.withColumns({
        "n": n, "accuracy": _ratio(tp + tn, n),
        "precision_1": p1, "recall_1": r1, "f1_1": f1, "support_1": tp + fn, "precision_0": p0, "recall_0": r0, "f1_0": f0, "support_0": tn + fp,
        "macro_precision": (p1 + p0) / 2, "macro_recall": (r1 + r0) / 2, "macro_f1": (f1 + f0) / 2, "mcc": mcc,
        "predicted_rate": _ratio(tp + fp, n), "gold_rate": _ratio(tp + fn, n),
    })


def metrics(df: DataFrame, gold: str, pred: str, *by: str) -> DataFrame:
    return metrics_of(confusion(df, gold, pred, *by))


def metrics_by_length(df: DataFrame, gold: str, pred: str, length: str, edges: tuple[int, ...] = (0, 50, 100, 200, 400, 10_000)) -> DataFrame:
    """Metrics per length bin, closed on the right, the first with its lower end
    too; longer rows are left out, empty bins too."""
    n, bin_ = F.col(length), F.lit(None).cast("string")
    for i, (a, b) in enumerate(zip(edges, edges[1:])):
        bin_ = F.coalesce(bin_, F.when(((n >= a) if i == 0 else (n > a)) & (n <= b), F.lit(f"{a}-{b}")))
    return metrics(df.withColumn("length_bin", bin_).where("length_bin is not null"), gold, pred, "length_bin")


def expected_macro_f1(prevalence: Column, tpr: Column, fpr: Column) -> Column:
    """Macro F1 of a classifier with these rates at a prevalence of label 1."""
    tp, fn, fp, tn = prevalence * tpr, prevalence * (1 - tpr), (1 - prevalence) * fpr, (1 - prevalence) * (1 - fpr)
    return (_ratio(2 * tp, 2 * tp + fp + fn) + _ratio(2 * tn, 2 * tn + fp + fn)) / 2


def rates(cells: DataFrame) -> DataFrame:
    """``tpr``, ``fpr``, ``prevalence``, ``balanced_accuracy`` of confusion counts."""
    tn, fp, fn, tp = map(F.col, ("tn", "fp", "fn", "tp"))
    out = cells.withColumns({"tpr": _ratio(tp, tp + fn), "fpr": _ratio(fp, fp + tn), "prevalence": _ratio(tp + fn, tn + fp + fn + tp)})
    return out.withColumn("balanced_accuracy", (F.col("tpr") + 1 - F.col("fpr")) / 2)


def gap(benchmark: DataFrame, native: DataFrame) -> DataFrame:
    """One row from two of confusion counts: how much of the drop in macro F1
    is due to prevalence, and how much to behaviour. Nulls where a side has no rows."""
    b, m = rates(metrics_of(benchmark)), metrics_of(native)
    some = lambda c: F.when(F.col("n") > 0, F.col(c))
    b = b.select(some("macro_f1").alias("benchmark_f1"), some("tpr").alias("b_tpr"), some("fpr").alias("b_fpr"))
    m = m.select(some("macro_f1").alias("native_f1"), some("gold_rate").alias("native_prevalence"))
    both = F.broadcast(b).crossJoin(m)  # one row each
    expected = F.when(F.col("benchmark_f1").isNotNull() & F.col("native_f1").isNotNull(), expected_macro_f1(F.col("native_prevalence"), F.col("b_tpr"), F.col("b_fpr")))
    return both.withColumn("expected_f1", expected).select(
        "benchmark_f1", "native_f1", "expected_f1",
        (F.col("benchmark_f1") - F.col("native_f1")).alias("total_gap"), (F.col("benchmark_f1") - F.col("expected_f1")).alias("prevalence_gap"), (F.col("expected_f1") - F.col("native_f1")).alias("behaviour_gap"),
    )


def mood_by_error(df: DataFrame, mood: str, wrong: str) -> DataFrame:
    """One row: the 2x2 counts of two flags, chi-square with Yates' correction,
    phi, and whether it applies (no empty margin)."""
    q, e = F.col(mood), F.col(wrong)
    cells = df.agg(F.count_if(~q & ~e).alias("a"), F.count_if(~q & e).alias("b"), F.count_if(q & ~e).alias("c"), F.count_if(q & e).alias("d"))
    a, b, c, d = (F.col(x).cast("double") for x in "abcd")
    n, margins = a + b + c + d, (a + b) * (c + d) * (a + c) * (b + d)
    # The correction never moves a count past its expectation.
    off = F.greatest(F.abs(a * d - b * c) - n * F.least(F.lit(0.5), F.abs(a * d - b * c) / n), F.lit(0.0))
    chi2 = F.coalesce(F.try_divide(n * off * off, margins), F.lit(0.0))
    return cells.withColumns({"applicable": margins > 0, "chi2": chi2, "phi": F.sqrt(F.coalesce(F.try_divide(chi2, n), F.lit(0.0)))})


def chi2_p(chi2: float) -> float:
    """The p value at one degree of freedom."""
    return math.erfc(math.sqrt(chi2 / 2))


def mood_prediction(df: DataFrame, question: str, gold: str, pred: str) -> DataFrame:
    """One row: share of questions, bias, and whether the bias is the one that
    share lets expect (null when it lets expect none)."""
    s = df.agg(F.avg(F.col(question).cast("double")).alias("question_share"), F.avg(F.col(pred).cast("double")).alias("predicted"), F.avg(F.col(gold).cast("double")).alias("gold"))
    s = s.withColumn("bias", F.col("predicted") - F.col("gold"))
    return s.withColumn("as_expected", F.when(F.col("question_share") < 0.35, F.col("bias") > 0.02).when(F.col("question_share") > 0.65, F.col("bias") < -0.02))


def confidence(df: DataFrame, correct: str, prob: str, sure: float = 0.9) -> DataFrame:
    """One row: mean confidence when right and wrong, and confident errors."""
    top = F.greatest(F.col(prob).cast("double"), 1 - F.col(prob).cast("double"))
    ok = F.col(correct)
    return df.agg(F.avg(F.when(ok, top)).alias("mean_when_right"), F.avg(F.when(~ok, top)).alias("mean_when_wrong"), F.count_if(~ok & (top > sure)).alias("confident_errors"))


def resamples(df: DataFrame, gold: str, pred: str, replicates: int = 2000, seed: int = 42) -> DataFrame:
    """The bootstrap: ``replicate`` (from 0), its four confusion counts and
    ``macro_f1``. Resampling with replacement changes nothing but the four
    counts, so they are drawn at once from their multinomial distribution, and
    the cost doesn't grow with the rows. A draw depends on ``seed`` and the
    replicate's number only."""
    cells = confusion(df, gold, pred)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            which, *counts = (c.to_numpy(zero_copy_only=False) for c in batch.columns)
            counts = np.stack(counts, 1).astype(np.int64)
            drawn = np.array([np.random.default_rng([seed, r]).multinomial(c.sum(), c / c.sum()) for r, c in zip(which.tolist(), counts, strict=True)], np.int64).reshape(-1, 4)
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(x) for x in drawn.T)], ["replicate", "tn", "fp", "fn", "tp"])

    reps = df.sparkSession.range(replicates).withColumnRenamed("id", "replicate").crossJoin(F.broadcast(cells))  # one row
    drawn = reps.where("tn + fp + fn + tp > 0").select("replicate", "tn", "fp", "fn", "tp").mapInArrow(run, "replicate long, tn long, fp long, fn long, tp long")
    return metrics_of(drawn).select("replicate", "tn", "fp", "fn", "tp", "macro_f1")


def interval(replicates: DataFrame, value: str = "macro_f1", level: float = 0.95) -> DataFrame:
    q = (1 - level) / 2
    return replicates.agg(F.percentile(value, F.lit(q)).alias("low"), F.percentile(value, F.lit(1 - q)).alias("high"))


def floors(df: DataFrame, key: str, gold: str, salt: str = "rand", draws: int = 25) -> DataFrame:
    """``floor``, ``macro_f1`` of always 1, always 0, the more frequent label (0
    on a tie), and a coin, as the mean of ``draws`` (up to 64) throws. A row's
    throws are the hexadecimal digits of its key's SHA-256, heads from 8 up."""
    digits = F.sha2(F.concat(F.lit(f"{salt}:"), F.coalesce(F.col(key).cast("string"), F.lit(""))), 256)
    g, heads = F.col(gold), [F.substring(F.col("_d"), i + 1, 1) >= "8" for i in range(draws)]
    pos, neg = F.count_if(g == 1).alias("pos"), F.count_if(g == 0).alias("neg")
    thrown = [f(c).alias(f"{n}{i}") for i, h in enumerate(heads) for n, f, c in (("tp", F.count_if, (g == 1) & h), ("fp", F.count_if, (g == 0) & h))]
    counts = df.select(g, digits.alias("_d")).agg(pos, neg, *thrown)
    cell = lambda name, tp, fp: F.struct(F.lit(name).alias("floor"), tp.cast("long").alias("tp"), fp.cast("long").alias("fp"))
    p, n, zero = F.col("pos"), F.col("neg"), F.lit(0)
    cells = [cell("always_1", p, n), cell("always_0", zero, zero), cell("majority", F.when(p > n, p).otherwise(0), F.when(p > n, n).otherwise(0))]
    cells += [cell("random", F.col(f"tp{i}"), F.col(f"fp{i}")) for i in range(draws)]
    each = counts.select("pos", "neg", F.inline(F.array(*cells))).select("floor", (n - F.col("fp")).alias("tn"), "fp", (p - F.col("tp")).alias("fn"), "tp")
    return metrics_of(each).groupBy("floor").agg(F.avg("macro_f1").alias("macro_f1"))


def covered(macro_f1: Column, chance: Column, target: Column) -> Column:
    """The share of the way from chance to a target that a score covers; null where they are equal."""
    return F.try_divide(macro_f1 - chance, target - chance)


def kappa(df: DataFrame, a: str, b: str) -> DataFrame:
    """One row: Cohen's kappa of two raters (null if chance alone agrees), with
    ``po``, ``pe``, ``n``. Rows with a null in either don't count."""
    return kappa_of(df.where(F.col(a).isNotNull() & F.col(b).isNotNull()).groupBy(F.col(a).alias("a"), F.col(b).alias("b")).agg(F.count(F.lit(1)).alias("n")))


def kappa_of(cells: DataFrame) -> DataFrame:
    t = cells.withColumns({"na": F.sum("n").over(W.partitionBy("a")), "total": F.sum("n").over(W.partitionBy())})
    other = cells.groupBy(F.col("b").alias("v")).agg(F.sum("n").alias("nb"))
    chance = t.select("a", "na", "total").distinct().join(other, F.col("a") == F.col("v")).agg(F.sum(F.col("na") / F.col("total") * F.col("nb") / F.col("total")).alias("pe"))
    same = cells.agg(F.sum("n").alias("n"), F.sum(F.when(F.col("a") == F.col("b"), F.col("n")).otherwise(0)).alias("same"))
    s = same.crossJoin(chance).withColumn("pe", F.coalesce("pe", F.lit(0.0))).withColumn("po", F.try_divide(F.col("same").cast("double"), F.col("n").cast("double")))
    return s.select("n", "po", "pe", F.try_divide(F.col("po") - F.col("pe"), 1 - F.col("pe")).alias("kappa"))


def agreement_word(k: Column) -> Column:
    """The usual words for a kappa."""
    return F.when(k >= 0.81, "almost perfect").when(k >= 0.61, "substantial").when(k >= 0.41, "moderate").when(k >= 0.21, "fair").when(k >= 0, "slight").otherwise("poor")
