import unicodedata

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from patraloom.llm.canonical import canonical_text, connection, duckdb_query, look_classes, looks_the_same


def formed(texts):
    import pyarrow as pa

    table = pa.table({"t": pa.array(texts, pa.string())})
    return connection().from_arrow(table).query("batch", duckdb_query("batch", (), (("t", "f"),))).to_arrow_table()["f"].to_pylist()


@pytest.mark.parametrize(
    "a, b",
    [
        ("ＡＢＣ　１２３", "ABC 123"), ("ﬁne ﬂow", "fine flow"), ("é", "é"), ("a​b­c", "abc"), ("  x\t\n y　", "x y"), ("раураl", "paypal"),
        ("ଡ଼", "ଡ଼"), ("କୋ", "କୋ"), ("ଯାଏ|", "ଯାଏ।"), ("ଯାଏ॥", "ଯାଏ||"), ("୧୦", "୧ଠ"), ("naїve", "naïve"), ("e‑mail", "e-mail"), ("①", "1"), ("½", "1⁄2"), ("½", "1/2"), ("ρυν ѵ", "puv v"), ("3 − 1 ∕ 2", "3 - 1 / 2"),
    ],
)
def test_same_look_same_form(a, b):
    x, y = formed([a, b])
    assert x == y


@pytest.mark.parametrize("a, b", [("abc", "Abc"), ("୯", "9"), ("ab", "a b"), ("é", "e"), ("ା", "ି")])
def test_other_look_other_form(a, b):
    x, y = formed([a, b])
    assert x != y


def test_null_empty_blank_and_long():
    assert formed([None, "", " ​　 "]) == [None, "", ""]
    long = "ａ ﬁ é " * 20_000
    assert formed([long])[0] == ("a fi é " * 20_000).strip()


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(max_size=30), min_size=1, max_size=20))
def test_idempotent_and_composed(texts):
    texts = [t.encode("utf-8", "ignore").decode() for t in texts]
    once = formed(texts)
    assert formed(once) == once
    assert all(unicodedata.normalize("NFC", t) == t for t in once)


def test_pairs(spark):
    rows = [("1", "ａ"), ("1", "ａ"), ("2", "a"), ("3", "a"), ("4", None), ("5", " a "), (None, "a"), ("6", "b")]
    got = {tuple(r) for r in looks_the_same(spark.createDataFrame(rows, "example_id string, text_ory string")).collect()}
    assert got == {("1", "2"), ("1", "3"), ("1", "5"), ("2", "5"), ("3", "5")}


def test_classes_and_parts(spark):
    rows = [(f"{i:03d}", t) for i, t in enumerate(["ａ b", "a b", "a  b", "a b"] * 10 + ["c"] * 5 + [None, ""])] + [("000", "ａ b"), (None, "a b")]
    df = spark.createDataFrame(rows, "example_id string, text_ory string")
    got = {r.example_id: (r["class"], r.links) for r in look_classes(df).collect()}
    text = {i: t for i, t in rows if i is not None and t is not None}
    form = dict(zip(text, formed(list(text.values()))))
    same = {i: [j for j in text if form[j] == form[i]] for i in text}
    assert got == {i: (min(same[i]), sum(text[j] != text[i] for j in same[i])) for i in text}
    pairs = [tuple(r) for r in looks_the_same(df, part=7).collect()]
    assert sorted(pairs) == sorted((i, j) for i in text for j in same[i] if i < j and text[i] != text[j])
    assert look_classes(df.limit(0)).collect() == []


def test_empty_table_and_clashing_columns(spark):
    df = spark.createDataFrame([], "example_id string, text_ory string, raw string, f1 long, form string")
    assert looks_the_same(df).collect() == []
    one = spark.createDataFrame([("1", "ａ", "x")], 'id string, "a b" string, batch string'.replace('"', "`"))
    assert canonical_text(one, {"a b": "v"}).collect()[0].asDict() == {"id": "1", "a b": "ａ", "batch": "x", "v": "a"}
