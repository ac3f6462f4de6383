import random

import pytest

from patraloom.llm import neardup
from patraloom.llm.neardup import jaccard, pairs_in_groups, similar_groups


def sentence(rng, n=12):
    return " ".join("".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randrange(3, 8))) for _ in range(n))


def corpus(seed=1):
    rng = random.Random(seed)
    texts = []
    for _ in range(40):
        base = sentence(rng)
        texts.append(base)
        for _ in range(rng.randrange(3)):
            words = base.split()
            words[rng.randrange(len(words))] = "changed"
            texts.append(" ".join(words))
    # Texts that share a long frame are a region of many unlike ones.
    frame = sentence(rng, 4)
    texts += [frame + " " + sentence(rng, 8) for _ in range(40)] + [texts[0]] * 30 + ["abc", "abc", "", " ", None]
    return [(f"{i:04d}", t) for i, t in enumerate(texts)]


def brute(rows):
    rows = [(i, " ".join(t.split())) for i, t in rows if t is not None]
    parent = {i: i for i, _ in rows}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for n, (i, t) in enumerate(rows):
        for j, u in rows[:n]:
            if t == u or jaccard(t, u) >= 0.7:
                parent[find(i)] = find(j)
    return {(a, b, "t") for a in parent for b in parent if a < b and find(a) == find(b)}


@pytest.mark.parametrize("small,block,exact", [(256, 4096, False), (2, 4096, False), (2, 8, False), (16, 4096, True), (2, 8, True)])
def test_against_brute_force(spark, small, block, exact):
    rows = corpus()
    df = spark.createDataFrame(rows + rows[:9] + [(None, "x")], "id string, t string")
    got = pairs_in_groups(similar_groups(df.repartition(3), "id", ["t"], small=small, block=block, exact=exact), "id", part=7)
    assert sorted(map(tuple, got.collect())) == sorted(brute(rows))


def joined(text, edges):
    parent = {n: n for n in text}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        parent[find(a)] = find(b)
    return all(find(a) == find(b) for a in text for b in text if a < b and jaccard(text[a], text[b]) >= 0.7)


@pytest.mark.parametrize("block", [16, 4096])
def test_metric_join_covers_all_links(spark, block):
    """A hot region of near-duplicates and strangers: links and pairs connect what is similar."""
    from pyspark.sql import functions as F

    rows = [(i, t) for i, (_, t) in enumerate(corpus(5)) if t and len(t) > 20]
    rows = list({t: (n, t) for n, t in rows}.values())
    nodes = spark.createDataFrame([(n, 0, 0, t) for n, t in rows], "node long, s1 long, s2 long, text string")
    hot = nodes.select(F.lit(7).cast("long").alias("key"), "node", F.col("node").alias("root"))
    links, todo = neardup.metric_join(hot, nodes, pivots=4, block=block)
    text = dict(rows)
    edges = [tuple(r) for r in links.collect()]
    assert all(jaccard(text[a], text[b]) >= 0.7 for a, b in edges)
    if todo is not None:
        edges += [(a, b) for a, b in todo.collect() if jaccard(text[a], text[b]) >= 0.7]
    assert joined(text, edges)


@pytest.mark.parametrize("every", [False, True])
def test_region_in_memory(every):
    texts = sorted({t for _, t in corpus(7) if t and len(t) >= 5})
    node = list(range(100, 100 + len(texts)))
    links = neardup.join_region(node, texts, node, 0.7, 5, every, pivots=4)
    true = {(i + 100, j + 100) for i, t in enumerate(texts) for j, u in enumerate(texts) if i < j and jaccard(t, u) >= 0.7}
    assert set(links) <= true and joined(dict(zip(node, texts)), links)
    assert not every or set(links) == true
    # What is connected beforehand needs no link.
    assert every or neardup.join_region(node, texts, [7] * len(node), 0.7, 5, False) == []


def test_prefixes_of_similar_texts_meet():
    """The least similar pairs that count: of 17 runs 14 in common, where the others are the rarest."""
    import numpy as np

    rng = np.random.default_rng(2)
    counts = rng.integers(0, 9, neardup.COUNTED)
    for size in range(4, 60):
        for _ in range(20):
            common = -(-7 * 2 * size // 17)
            if common > size:
                continue
            h = rng.integers(0, 2**62, 2 * size - common).astype(np.uint64)
            x, y = h[:size], h[size - common :]
            if common / len(h) < 0.7:
                continue
            key, text = neardup.prefix(np.concatenate([x, y]), np.array([size, size]), counts, 0.7)
            assert set(key[text == 0].tolist()) & set(key[text == 1].tolist())


def test_hot_template(spark):
    """Many texts of one template, some near it and some not, in one region."""
    rng = random.Random(11)
    frame = sentence(rng, 30)
    rows = [(f"{i:05d}", f"{frame} {sentence(rng, 1 + 12 * (i % 3 == 0))}") for i in range(240)]
    df = spark.createDataFrame(rows, "id string, t string")
    got = similar_groups(df, "id", ["t"], block=32).collect()
    group = {r.id: r.group for r in got}
    assert {(a, b) for a in group for b in group if a < b and group[a] == group[b]} == {(a, b) for a, b, _ in brute(rows)}


@pytest.mark.parametrize("small", [256, 8])
def test_links_count_every_similar_text(spark, small):
    """Large regions too: of texts that differ in one or two words, most lie in one ball."""
    rng = random.Random(3)
    base = [sentence(rng, 40).split() for _ in range(2)]
    texts = {" ".join(b[:i] + ["changed"] + b[i + 1 :]) for b in base for i in range(40)} | {" ".join(base[0][:i] + ["an", "insertion", "of", "words"] + base[0][i + 3 :]) for i in range(0, 36, 2)}
    rows = [(f"{n:03d}", t) for n, t in enumerate(sorted(texts))]
    got = similar_groups(spark.createDataFrame(rows, "id string, t string"), "id", ["t"], small=small, links=True).collect()
    assert {r.id: r.links for r in got} == {i: sum(t != u and jaccard(t, u) >= 0.7 for _, u in rows) for i, t in rows}


def test_packing_round_trip():
    import numpy as np

    rng = np.random.default_rng(1)
    keys, nodes = rng.integers(0, 2**32, 5000, np.uint32), rng.integers(-(2**62), 2**62, 5000)
    k, place, table = neardup._unpacked(neardup._packed(keys, nodes))
    assert sorted(zip(k.tolist(), table[place].tolist())) == sorted(zip(keys.tolist(), nodes.tolist()))


def test_more_buckets_than_entries(spark):
    rows = [("1", "a text that is long enough"), ("2", "a text that is long enough!"), ("3", "abcde"), ("4", "")]
    got = pairs_in_groups(similar_groups(spark.createDataFrame(rows, "id string, t string").repartition(4), "id", ["t"], buckets=300), "id")
    assert [tuple(r) for r in got.collect()] == [("1", "2", "t")]


def test_empty(spark):
    df = spark.createDataFrame([], "id string, t string, key long, node long")
    assert similar_groups(df, "id", ["t"]).collect() == []
