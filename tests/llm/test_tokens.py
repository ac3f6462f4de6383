import os
import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from patraloom.llm.encoding import DEFAULT, decoded, encode, encoder, pieces, token_counts, token_ids
from patraloom.llm.splitting import split_texts

pytestmark = pytest.mark.skipif(not os.path.exists(DEFAULT), reason="no rank file")
ALPHABET = st.sampled_from(list("ab1'.!? \n\t éଡ଼ଠ😀") + ["'s", "  ", "\x1c", "ab "])


@settings(max_examples=200, deadline=None)
@given(st.lists(ALPHABET, max_size=120).map("".join), st.integers(1, 12))
def test_cutting_changes_nothing(text, long):
    enc = encoder()
    assert "".join(pieces(text, long)) == text
    assert list(encode(text, enc, long)) == enc.encode_ordinary(text)


def test_round_trip_and_empty(spark):
    rng = random.Random(1)
    long = "".join(rng.choice("ab c.\n୧ଡ") for _ in range(60_000))
    rows = [(1, "Hello world"), (2, ""), (3, None), (4, long), (5, "<|endoftext|>"), (5, "<|endoftext|>"), (6, "x" * 50_000)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    ids = token_ids(df)
    got = {r.doc_id: r.ids for r in ids.collect()}
    assert got[2] == got[3] == [] and got[5] and 50256 not in got[5] and ids.count() == 7
    back = {r.doc_id: bytes(r.bytes).decode() for r in decoded(ids).collect()}
    assert all(back[i] == (t or "") for i, t in rows)
    assert {r.doc_id: r.n_tokens for r in token_counts(df, ["doc_id"]).collect()} == {i: len(v) for i, v in got.items()}
    assert token_ids(df.limit(0)).collect() == []


def test_batches_are_cut_by_bytes():
    import pyarrow as pa

    from patraloom.llm.encoding import _parts

    texts = [b"x" * 60, None, b"", b"y" * 500, b"z" * 50, b"w" * 50, b"v"]
    batch = pa.RecordBatch.from_arrays([pa.array(range(7)), pa.array(texts, pa.binary())], ["i", "t"])
    parts = list(_parts(batch, 100))
    assert [p.column(0).to_pylist() for p in parts] == [[0, 1, 2], [3], [4, 5], [6]]
    assert [p.num_rows for p in _parts(batch.slice(0, 0))] == [0]


def test_time_grows_as_the_length(spark):
    """Half a million characters in one piece list; the parts put the text together."""
    rng = random.Random(9)
    text = "".join(rng.choice(["ଘୀହାଚ", "ଧରୌଥଥ", "alpha"]) + rng.choice([" ", ". ", "\n"]) for _ in range(80_000))
    got = split_texts(spark.createDataFrame([(1, text)], "doc_id long, text string"), overlap=0).orderBy("piece").collect()
    assert "".join(r.piece_text for r in got) == text and len(got) > 1000


def texts():
    rng = random.Random(4)
    words = ["alpha", "beta", "ଘୀହାଚ", "ଧରୌଥଥ", "gamma", "😀", "12"]
    plain = " ".join(rng.choice(words) for _ in range(900))
    sentences = ". ".join(" ".join(rng.choice(words) for _ in range(9)) for _ in range(120))
    paragraphs = "\n\n".join(". ".join(" ".join(rng.choice(words) for _ in range(7)) for _ in range(6)) for _ in range(40))
    return [(1, plain), (2, sentences), (3, paragraphs), (4, "😀" * 700), (5, "x7" * 3000), (6, "short"), (7, ""), (8, None), (9, "Head.\n" + "ଡ" * 1500), (3, paragraphs)]


@pytest.mark.parametrize("limit, overlap", [(512, 32), (64, 8), (100, 0)])
def test_pieces(spark, limit, overlap):
    enc = encoder()
    rows = texts()
    got = split_texts(spark.createDataFrame(rows, "doc_id long, text string"), limit=limit, overlap=overlap).collect()
    by = {}
    for r in got:
        by.setdefault(r.doc_id, {}).setdefault(r.piece, r)
    whole = dict(rows)
    assert set(by) == {i for i, t in rows if len(enc.encode_ordinary(t or "")) > limit}
    for i, ps in by.items():
        ps = [ps[k] for k in range(len(ps))]
        assert ps[0].start == 0 and ps[-1].stop == len(whole[i])
        for a, b in zip(ps, ps[1:]):
            assert b.start <= a.stop < b.stop and overlap <= b.shared <= overlap + 3
        for p in ps:
            assert p.piece_text == whole[i][p.start : p.stop] and p.piece_tokens <= limit and len(enc.encode_ordinary(p.piece_text)) <= limit
    ends = [whole[3][: p.stop] for p in by[3].values()]
    assert all(e.endswith(("\n\n", "\n")) or e == whole[3] for e in ends) if limit == 512 else True
    assert all(whole[1][p.stop : p.stop + 1] in ("", " ") for p in by[1].values())
    assert sum(r.doc_id == 3 for r in got) == 2 * len(by[3])


def test_piece_limits(spark):
    with pytest.raises(ValueError):
        split_texts(spark.createDataFrame([], "doc_id long, text string"), limit=20, overlap=10)
    assert split_texts(spark.createDataFrame([], "doc_id long, text string, tails int")).collect() == []
