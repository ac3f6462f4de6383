"""DuckDB SQL for the queries of this subpackage that SQL can express."""

from __future__ import annotations

import unicodedata
from functools import lru_cache

P2 = """
WITH records AS (SELECT DISTINCT example_id, source_config, label FROM release
    WHERE example_id IS NOT NULL AND source_config IS NOT NULL AND label IS NOT NULL),
have AS (SELECT source_config, label, count(*) AS available FROM records GROUP BY ALL),
size AS (SELECT count(*) AS n FROM records)
SELECT plan, source_config, label FROM sample_targets LEFT JOIN have USING (source_config, label), size
WHERE coalesce(available, 0) < greatest(min_rows, target_share * sample_fraction * n)
"""

P4 = """
WITH records AS (SELECT DISTINCT example_id, source_config, teacher_prob_hate AS score FROM release
    WHERE example_id IS NOT NULL AND source_config IS NOT NULL AND teacher_prob_hate IS NOT NULL AND NOT isnan(teacher_prob_hate)),
ranked AS (SELECT *, rank() OVER (PARTITION BY source_config ORDER BY score DESC) AS place, count(*) OVER (PARTITION BY source_config) AS n FROM records)
SELECT example_id, source_config FROM ranked JOIN keep_targets USING (source_config) WHERE place <= ceil(keep_fraction * n)
"""

P4_REPORT = """
WITH records AS (SELECT DISTINCT example_id, source_config, teacher_prob_hate::DOUBLE AS score FROM release
    WHERE example_id IS NOT NULL AND source_config IS NOT NULL AND teacher_prob_hate IS NOT NULL AND NOT isnan(teacher_prob_hate)),
ranked AS (SELECT *, row_number() OVER (PARTITION BY source_config ORDER BY score DESC) AS r, count(*) OVER (PARTITION BY source_config) AS n FROM records),
cuts AS (SELECT source_config AS source, keep_fraction, n, ceil(keep_fraction * n)::BIGINT AS place, score AS cutoff
    FROM ranked JOIN keep_targets USING (source_config) WHERE r = ceil(keep_fraction * n))
SELECT source, keep_fraction, n, place, cutoff, (SELECT count(*) FROM records WHERE source_config = source AND score >= cutoff) AS kept FROM cuts
"""


# What is drawn alike, written out again to check the library's.
CYRILLIC = dict(zip("АВЕНІЈКМОРЅТХԌԚԜасԁеһіјорԛѕхуԝѵ" + "С", "ABEHIJKMOPSTXGQWacdehijopqsxywv" + "C", strict=True))
GREEK = dict(zip("ΑΒΕΖΗΙΚΜΝΟΡΤΥΧνορυϳ", "ABEZHIKMNOPTYXvopuj", strict=True))
OTHERS = {"օ": "o", "Օ": "O", "ɡ": "g", "ɑ": "a", "‐": "-", "‑": "-", "‒": "-", "−": "-", "⁄": "/", "∕": "/", "୦": "ଠ", "|": "।", "ǀ": "।"}
WHOLE = (("ଅା", "ଆ"), ("ଏୗ", "ଐ"), ("ଓୗ", "ଔ"), ("॥", "।।"))
UNSEEN = (
    "00AD 034F 061C 115F 1160 17B4 17B5 180B-180F 200B-200F 202A-202E 2060-206F 3164 FE00-FE0F FEFF FFA0 FFF0-FFFB 1BCA0-1BCA3 1D173-1D17A E0000-E0FFF"
)
BLANKS = "9-D 1C-20 85 A0 1680 2000-200A 2028 2029 202F 205F 3000"


def _codes(ranges: str) -> set[int]:
    ends = [[int(x, 16) for x in r.split("-")] for r in ranges.split()]
    return {c for e in ends for c in range(e[0], e[-1] + 1)}


def _quoted(x: str) -> str:
    return "'" + x.replace("'", 2 * "'") + "'"


@lru_cache(maxsize=1)
def _characters() -> str:
    """A table of characters that don't stand for themselves, one at a time:
    decomposed for compatibility, without what can't be seen, blanks as spaces,
    look-alikes replaced. Composing is left to the whole text."""
    alike, unseen, blank = CYRILLIC | GREEK | OTHERS, _codes(UNSEEN), _codes(BLANKS)
    rows = []
    for code in range(1, 0x110000):
        if 0xAC00 <= code <= 0xD7A3 or 0xD800 <= code <= 0xDFFF:
            continue
        c = chr(code)
        apart = c if code in unseen | blank else unicodedata.normalize("NFKD", c)
        out = "".join("" if ord(x) in unseen else " " if ord(x) in blank else alike.get(x, x) for x in apart)
        if out != c:
            rows.append("(" + ",".join(_quoted(x) for x in (c, out)) + ")")
    return "characters(c, v) AS MATERIALIZED (VALUES " + ",".join(rows) + ")"


def _formed(name: str, relation: str, key: str, text: str) -> str:
    """Frames that end in ``name`` (``key``, ``raw``, ``form``): each text taken
    apart into characters, mapped by a join, and put together again."""
    whole = "nfc_normalize(f)"
    for pieces, one in WHOLE:
        whole = f"replace({whole}, '{pieces}', '{one}')"
    return f"""{name}_t AS MATERIALIZED (SELECT {key}, {text} AS raw, row_number() OVER () AS n FROM {relation} WHERE {text} IS NOT NULL),
{name}_c AS (SELECT n, unnest(string_split(raw, '')) AS c, generate_subscripts(string_split(raw, ''), 1) AS i FROM {name}_t),
{name}_f AS MATERIALIZED (SELECT n, string_agg(coalesce(v, c), '' ORDER BY i) AS f FROM {name}_c LEFT JOIN characters USING (c) GROUP BY n),
{name} AS MATERIALIZED (SELECT {key}, raw, trim(regexp_replace(coalesce({whole}, ''), ' +', ' ', 'g')) AS form FROM {name}_t LEFT JOIN {name}_f USING (n))"""


ONCE = "once AS (SELECT DISTINCT example_id, text_ory, text_eng FROM pairs WHERE example_id IS NOT NULL)"


def _p1(select: str) -> str:
    return f"WITH {_characters()}, {ONCE}, {_formed('f', '(SELECT DISTINCT example_id, text_ory FROM once)', 'example_id', 'text_ory')} {select}"


def _p1_found() -> str:
    return _p1("SELECT a.example_id AS example_id_a, b.example_id AS example_id_b FROM f a JOIN f b ON a.form = b.form AND a.raw <> b.raw AND a.example_id < b.example_id")


def _p1_canonical() -> str:
    return _p1("SELECT o.example_id, f.form AS text FROM (SELECT DISTINCT example_id FROM once) o LEFT JOIN f USING (example_id)")


def _p1_classes() -> str:
    return _p1("SELECT example_id, min(example_id) OVER (PARTITION BY form) AS class, count(*) OVER (PARTITION BY form) - count(*) OVER (PARTITION BY form, raw) AS links FROM f")


def _p3_found() -> str:
    """Every pair of texts that share a run is compared: for small tables only."""
    forms = ", ".join(_formed(n, "once", "example_id", t) for n, t in (("o", "text_ory"), ("e", "text_eng")))
    return f"""WITH RECURSIVE {_characters()}, {ONCE}, {forms},
members AS MATERIALIZED (SELECT example_id, 'text_ory' AS field, form AS t FROM o UNION ALL SELECT example_id, 'text_eng', form FROM e),
texts AS MATERIALIZED (SELECT field, t, row_number() OVER (ORDER BY field, t) AS n FROM (SELECT DISTINCT field, t FROM members)),
runs AS MATERIALIZED (SELECT DISTINCT field, n, substr(t, i, 5) AS r FROM (SELECT field, n, t, unnest(range(1, length(t) - 3)) AS i FROM texts WHERE length(t) >= 5)),
sizes AS MATERIALIZED (SELECT n, count(*) AS size FROM runs GROUP BY 1),
near AS MATERIALIZED (SELECT a.n AS a, b.n AS b, count(*) AS both_have FROM runs a JOIN runs b ON a.field = b.field AND a.r = b.r AND a.n < b.n GROUP BY 1, 2),
links AS MATERIALIZED (SELECT a, b FROM near JOIN sizes x ON x.n = a JOIN sizes y ON y.n = b WHERE both_have::DOUBLE / (x.size + y.size - both_have) >= 0.7::DOUBLE),
ways AS MATERIALIZED (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach AS (SELECT n AS a, n AS b FROM texts UNION SELECT reach.a, ways.b FROM reach JOIN ways ON reach.b = ways.a),
groups AS MATERIALIZED (SELECT a AS n, min(b) AS g FROM reach GROUP BY 1),
grouped AS MATERIALIZED (SELECT m.example_id, m.field, g FROM members m JOIN texts x ON m.field = x.field AND m.t = x.t JOIN groups USING (n))
SELECT a.example_id AS example_id_a, b.example_id AS example_id_b, a.field FROM grouped a JOIN grouped b ON a.field = b.field AND a.g = b.g AND a.example_id < b.example_id"""


def oracle_sql() -> dict[str, str]:
    return {"p1_found": _p1_found(), "p1_canonical": _p1_canonical(), "p1_classes": _p1_classes(), "p2_found": P2, "p3_found": _p3_found(), "p4_found": P4, "p4_report": P4_REPORT}
