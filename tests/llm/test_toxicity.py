import random

from patraloom.llm.toxicity import fit, plain_spelling, rates, record_scores, windows

PEOPLE = ["gorvans", "teplins", "murkish", "yandols"]
BAD = ["You are a worthless wretch and nobody likes you.", "All {p} are filthy vermin and must leave.", "I will hunt you down and hurt you.", "Keep the {p} away they are less than human."]
TRAP = ["How do I report a person who says that {p} are vermin?", "The word wretch also means a poor soul."]
GOOD = ["How do I water the {n} near the {m}?", "Please explain the {n} to my friend.", "The {n} was shiny but the {m} was not.", "Write ten lines about the {n} and the {m}."]
THINGS = ["lamp", "garden", "engine", "bridge", "basket", "carpet", "violin", "harbour", "onion", "ladder"]


def make(rng, kind):
    f = lambda s: s.format(p=rng.choice(PEOPLE), n=rng.choice(THINGS), m=rng.choice(THINGS))
    parts = [f(rng.choice(GOOD)) for _ in range(rng.randrange(1, 4))] + ([f(rng.choice(BAD))] if kind == "bad" else [f(rng.choice(TRAP))] if kind == "trap" else [])
    rng.shuffle(parts)
    return " ".join(parts)


def sample(n, seed):
    rng = random.Random(seed)
    out = []
    for _ in range(n):
        kind = rng.choices(["bad", "trap", "good"], [2, 1, 7])[0]
        high = rng.random() < {"bad": 0.88, "trap": 0.3, "good": 0.08}[kind]
        out.append((make(rng, kind), kind, high))
    return out


def test_spelling():
    assert plain_spelling("f u c k off") == "fuck off" and plain_spelling("t.r.a.s.h") == "trash"
    assert plain_spelling("LOOOOSER") == "loser" and plain_spelling("7hr047") == "throat" and plain_spelling("I am at 10 a b") == "i am at 10 a b"
    assert windows(None) == [] == windows("  ") or windows("  ") == ["  "]
    assert max(map(len, windows("word " * 500))) <= 240


def test_held_out_accuracy():
    """On new records, though the training scores are wrong for every eighth."""
    model = fit([(t, h) for t, _, h in sample(3000, 1)])
    right = wrong = missed = 0
    for t, kind, _ in sample(800, 2):
        flag = max(map(model.score, windows(t)), default=0) >= model.threshold
        right += flag and kind == "bad"
        wrong += flag and kind != "bad"
        missed += (not flag) and kind == "bad"
    assert right / (right + wrong) > 0.93 and right / (right + missed) > 0.93


def test_records(spark):
    rows = [(f"{i}", "s", t, 0.95 if h else 0.01) for i, (t, _, h) in enumerate(sample(1500, 3))]
    release = spark.createDataFrame(rows + [("n", "s", "x", None), ("m", "s", "x", float("nan"))], "example_id string, source_config string, text_eng string, teacher_prob_hate float")
    pairs = spark.createDataFrame([("a", "s", "I will hunt you down and hurt you."), ("a", "s", "I will hunt you down and hurt you."), ("b", None, None), ("c", "s", ""), (None, "s", "x"), ("d", "s", "nice " * 5000)], "example_id string, source_config string, text_eng string")
    got = record_scores(pairs, release)
    flags = {r.example_id: r.toxic for r in got.collect()}
    assert flags == {"a": True, "b": None, "c": False, "d": False}
    assert {r.source_config: (r.records, r.toxic_records) for r in rates(got).collect()} == {"s": (3, 1), None: (1, 0)}


def test_nothing_to_learn(spark):
    none = spark.createDataFrame([], "example_id string, source_config string, text_eng string, teacher_prob_hate float")
    assert record_scores(none, none).collect() == []
    one = spark.createDataFrame([("a", "s", "hello")], "example_id string, source_config string, text_eng string")
    assert [r.toxic for r in record_scores(one, none).collect()] == [False]
