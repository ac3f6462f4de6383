import math

import pytest
from pyspark.sql import functions as F

from patraloom.functions import bands, ids
from patraloom.functions import text as X


def one(spark, value, f, kind="string"):
    return spark.createDataFrame([(value,)], f"v {kind}").select(f(F.col("v")).alias("x")).first()[0]


@pytest.mark.parametrize(
    "text, f, want",
    [
        ("a​b‍c﻿", X.strip_zero_width, "abc"), ("  a\t b\n\n  c  ", X.collapse_whitespace, "a b c"), ("foo​ bar", X.normalise, "foo bar"), ("foo​bar", X.normalise, "foobar"),
        ("é", X.normalise, "é"), ("a\x1cb", X.collapse_whitespace, "a b"), ("a­b", X.normalise, "ab"), ("a­b", X.normalise_eval, "a­b"), (None, X.normalise, None), (None, X.normalise_eval, ""),
        ("କଖଗ hello", X.script_purity, 3 / 8), ("", X.script_purity, 0.0), ("123 !!!", X.script_purity, 0.0), ("କଖ", X.script_purity, 1.0), (None, X.script_purity, None),
        ("କଖ", X.script_of, "odia_script"), ("କ hello", X.script_of, "mixed"), ("hello", X.script_of, "romanized"), ("12", X.script_of, "no_letters"),
        ("what?", X.is_question, True), ("what？", X.is_question, True), ("what", X.is_question, False), (None, X.is_question, False),
        ("abcdef", lambda c: F.size(X.shingles(c)), 2), ("abc", lambda c: F.size(X.shingles(c)), 1), ("", lambda c: F.size(X.shingles(c)), 0), (None, lambda c: F.size(X.shingles(c)), None), ("aaaaaaa", lambda c: F.size(X.shingles(c)), 1),
    ],
)
def test_text(spark, text, f, want):
    assert one(spark, text, f) == want


@pytest.mark.parametrize("cell, i, prompt, shown", [([["p", "RESP"]], 0, "p", "p"), (None, 0, None, X.MISSING), ([], 0, None, X.MISSING), ([[]], 0, None, X.EMPTY), ([["p", "r"]], 1, None, X.MISSING), ([[None, "r"]], 0, None, X.EMPTY)])
def test_turns(spark, cell, i, prompt, shown):
    kind = "array<array<string>>"
    assert one(spark, cell, lambda c: X.turn_prompt(c, i), kind) == prompt
    assert one(spark, cell, lambda c: X.turn_display(c, i), kind) == shown


def test_features(spark):
    text = "Ab? c! D. e, 12"
    df = spark.createDataFrame([(text,), ("",), ("???",), ("୧୨",)], "t string")
    rows = df.select(*(c.alias(n) for n, c in X.features("t", X.script_purity("t")).items())).collect()
    r = rows[0]
    assert (r.question_marks, r.exclamations, r.periods, r.commas, r.digits, r.uppercase, r.token_count) == (1, 1, 1, 1, 2, 2, 5)
    assert all(math.isfinite(v) for row in rows for v in row)
    marked = spark.createDataFrame([("[inst] a",), ("[ଇନ୍ସ୍ଟ] ଅ",), ("<|im_start|>",), ("<<sys>>",)], "t string")
    assert [x[0] for x in marked.select(X.features("t", F.lit(0.0))["scaffold"]).collect()] == [1, 1, 0, 1]
    s = df.select(*(c.alias(n) for n, c in X.surface_features("t").items())).collect()
    assert len(s[0]) == 10 and s[3].digits == 2 and s[1].mean_word_len == 0


@pytest.mark.parametrize("value, mapping, want", [("HATE", None, 1), ("not hate", None, 0), ("Non-Hate", None, 0), ("1", None, 1), ("0.0", None, 0), ("2", None, None), ("offensive", {"offensive": 0}, 0), ("hs", None, 1), ("NotHate", None, 0), ("not offensive", None, 0), ("benign", None, None), ("x", None, None), (None, None, None)])
def test_labels(spark, value, mapping, want):
    assert one(spark, value, lambda c: X.coerced_label(c, mapping)) == want


def test_ids(spark):
    assert one(spark, "17", lambda c: ids.example_id(F.lit("src0"), c)) == "d56996270d585506"
    assert one(spark, None, lambda c: ids.example_id(F.lit("src0"), c)) is None
    df = spark.range(4000).select(F.col("id").cast("string").alias("k"))
    counts = {r[0]: r[1] for r in df.groupBy(ids.assign_split("k", {"train": 0.8, "validation": 0.1, "test": 0.1}, "42")).count().collect()}
    assert abs(counts["train"] / 4000 - 0.8) < 0.03 and sum(counts.values()) == 4000
    for bad in ({}, {"a": 0.5}):
        with pytest.raises(ValueError):
            ids.assign_split("k", bad, "42")


def test_bands(spark):
    rows = [(0.90,), (0.05,), (0.899999,), (0.050001,), (None,), (float("nan"),)]
    got = [r[0] for r in spark.createDataFrame(rows, "p double").select(bands.band("p")).collect()]
    assert got == [1, 0, None, None, None, None]
    raw = spark.createDataFrame([(x,) for x in (0.8999999, 0.9000001, 0.0499999, 0.0500001)], "p float")
    assert [r[0] for r in raw.select(bands.band(bands.rounded("p"))).collect()] == [1, 1, 0, 0]
    h = bands.histogram(spark.createDataFrame([(x,) for x in (0.0, 0.005, 0.03, 0.5, 0.93, 0.97, 0.995, 1.0)], "p double"), "p")
    counts = {r.lower: r.n for r in h.collect()}
    assert counts[0.0] == 2 and counts[0.01] == 1 and counts[0.9] == 1 and counts[0.99] == 2 and len(counts) == 14
    assert bands.histogram(raw.limit(0), "p").count() == 14
