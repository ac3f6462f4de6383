"""Problem 1: one stored form for all texts that look the same.

DuckDB runs inside the Arrow batches of each partition; the mapping is one SQL
expression of ``translate``, ``regexp_replace`` and ``nfc_normalize``.

What is folded: compatibility forms (full-width, ligatures, presentation
forms), invisible characters, white space (any kind, any amount, both ends),
and characters drawn alike. Case, and digits of different scripts, stay apart.
A null text stays null; an empty or blank text becomes the empty string.
"""

from __future__ import annotations

import sys
import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import duckdb
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from patraloom.session import cut

# Characters drawn alike, each pair "variant plain".
LOOK_ALIKES = """
А A  В B  С C  Е E  Н H  І I  Ј J  К K  М M  О O  Р P  Ѕ S  Т T  Х X  Ԍ G  Ԛ Q  Ԝ W
а a  с c  ԁ d  е e  һ h  і i  ј j  о o  р p  ԛ q  ѕ s  х x  у y  ԝ w
Α A  Β B  Ε E  Ζ Z  Η H  Ι I  Κ K  Μ M  Ν N  Ο O  Ρ P  Τ T  Υ Y  Χ X  ν v  ο o  ρ p  υ u  ϳ j
օ o  Օ O  ɡ g  ɑ a  ѵ v
‐ -  ‑ -  ‒ -  − -  ⁄ /  ∕ /
୦ ଠ  | ।  ǀ ।
"""
# Marks and letters typed in pieces that are drawn as one, "pieces whole".
DRAWN_AS_ONE = "ଅା ଆ  ଏୗ ଐ  ଓୗ ଔ  ॥ ।।"
# Invisible code points as regular-expression ranges (RE2).
INVISIBLE = (
    r"\x{AD}\x{34F}\x{61C}\x{115F}\x{1160}\x{17B4}\x{17B5}\x{180B}-\x{180F}\x{200B}-\x{200F}"
    r"\x{202A}-\x{202E}\x{2060}-\x{206F}\x{3164}\x{FE00}-\x{FE0F}\x{FEFF}\x{FFA0}"
    r"\x{FFF0}-\x{FFFB}\x{1BCA0}-\x{1BCA3}\x{1D173}-\x{1D17A}\x{E0000}-\x{E0FFF}"
)
WHITE_BUT_SPACE = r"\x{09}-\x{0D}\x{1C}-\x{1F}\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}"
WHITE = " " + WHITE_BUT_SPACE
# Frequent Odia signs that only compose, or move, next to another one.
ODIA_PARTS, ODIA_BEFORE, ODIA_ORDERED = "\u0b3e\u0b56\u0b57", "\u0b47", "\u0b3c\u0b4d"


def _pairs(text: str) -> list[tuple[str, str]]:
    words = text.split()
    return list(zip(words[::2], words[1::2], strict=True))


@lru_cache(maxsize=1)
def tables() -> dict[str, object]:
    """The mapping tables, made by rule from the Unicode database.

    ``single``: compatibility characters with a one-character form; ``several``:
    those whose form is longer. Look-alikes also cover their precomposed letters.
    """
    alike = dict(_pairs(LOOK_ALIKES))
    single: dict[str, str] = {}
    several: dict[str, str] = {}
    accented: dict[str, str] = {}
    for code in range(0xA0, sys.maxunicode + 1):
        if 0xAC00 <= code <= 0xD7A3 or 0xD800 <= code <= 0xDFFF:
            continue
        c = chr(code)
        decomposition = unicodedata.decomposition(c)
        if not decomposition:
            continue
        plain = unicodedata.normalize("NFKC", c)
        if plain != unicodedata.normalize("NFC", c):
            if plain.isspace() or c.isspace():
                continue
            if len(plain) == 1:
                single[c] = alike.get(plain, plain)
            else:
                several[c] = plain
            continue
        apart = unicodedata.normalize("NFD", c)
        if apart[0] in alike and len(apart) > 1:
            accented[c] = unicodedata.normalize("NFC", alike[apart[0]] + apart[1:])
    joined = {c: v for c, v in several.items() if 0xFB00 <= ord(c) <= 0xFB06}
    common = {c: v for c, v in single.items() if 0xFF01 <= ord(c) <= 0xFF5E}
    everyday = common | alike | {c: v for c, v in accented.items() if len(v) == 1}
    return {
        "everyday": everyday,
        "single": {c: v for c, v in single.items() if c not in everyday},
        "joined": joined,
        "several": {c: v for c, v in (several | accented).items() if len(v) > 1 and c not in joined},
    }


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _class(chars: dict[str, object]) -> str:
    """The characters as ranges of a regular-expression class."""
    out, codes = [], sorted(map(ord, chars))
    at = 0
    while at < len(codes):
        first = last = codes[at]
        at += 1
        while at < len(codes) and codes[at] == last + 1:
            last = codes[at]
            at += 1
        out.append(rf"\x{{{first:X}}}" + (rf"-\x{{{last:X}}}" if last > first else ""))
    return "".join(out)


def _not_composed() -> str:
    """A pattern that every text not in composed form (NFC) matches: characters
    that the form does not hold, that compose with one before, or that have a
    combining order. Few texts match it, and composing is the dearest step."""
    found = dict.fromkeys(map(chr, [*range(0x1161, 0x1176), *range(0x11A8, 0x11C3)]))
    for code in range(0xA0, sys.maxunicode + 1):
        c = chr(code)
        if 0xAC00 <= code <= 0xD7A3 or 0xD800 <= code <= 0xDFFF:
            continue
        if unicodedata.combining(c) or unicodedata.normalize("NFC", c) != c:
            found[c] = None
        decomposition = unicodedata.decomposition(c)
        if decomposition and decomposition[0] != "<":
            found.update(dict.fromkeys(chr(int(x, 16)) for x in decomposition.split()[1:]))
    for c in ODIA_PARTS + ODIA_ORDERED:
        found.pop(c, None)
    return f"[{_class(found)}]|{ODIA_BEFORE}[{ODIA_PARTS}]|[{ODIA_ORDERED}]{{2}}"


#: Stands for the text in the steps below.
V = "⟨text⟩"


def _where(chars: dict[str, str], then: str) -> str:
    """``then`` for the texts that hold any of the characters, else the text:
    few texts do, and each mapping is prepared anew for every row."""
    return f"CASE WHEN regexp_matches({V}, '[{_class(chars)}]') THEN {then} ELSE {V} END"


def _translated(chars: dict[str, str]) -> str:
    return f"translate({V}, {_quoted(''.join(chars))}, {_quoted(''.join(chars.values()))})"


@lru_cache(maxsize=1)
def steps() -> tuple[str, ...]:
    """The mapping as DuckDB expressions, each applied to the result of the one before."""
    t = tables()
    spelled = (
        f"array_to_string(list_transform(string_split({V}, ''), "
        f"lambda c: CASE WHEN c < chr(160) THEN c ELSE coalesce(map_extract_value(getvariable('several'), c), c) END), '')"
    )
    ligatures = whole = V
    for a, b in t["joined"].items():
        ligatures = f"replace({ligatures}, {_quoted(a)}, {_quoted(b)})"
    for pieces, one in _pairs(DRAWN_AS_ONE):
        whole = f"replace({whole}, {_quoted(pieces)}, {_quoted(one)})"
    return (
        _where(t["several"], spelled),
        _where(t["joined"], ligatures),
        _where(t["single"], _translated(t["single"])),
        f"regexp_replace({V}, '[{INVISIBLE}]+', '', 'g')",
        _where(t["everyday"], _translated(t["everyday"])),
        f"CASE WHEN regexp_matches({V}, '{_not_composed()}') THEN nfc_normalize({V}) ELSE {V} END",
        whole,
        f"trim(regexp_replace({V}, '[{WHITE}]{{2,}}|[{WHITE_BUT_SPACE}]', ' ', 'g'))",
    )


@lru_cache(maxsize=1)
def several_map() -> str:
    """The long table the first step looks up, as SQL."""
    return "MAP {" + ", ".join(f"{_quoted(a)}: {_quoted(b)}" for a, b in tables()["several"].items()) + "}"


def connection(several: str | None = None) -> duckdb.DuckDBPyConnection:
    """A DuckDB for one partition, with the long table the steps look up: the
    driver's :func:`several_map`, so that workers need not make it again."""
    con = duckdb.connect(config={"threads": 1})
    con.execute(f"SET VARIABLE several = {several or several_map()}")
    return con


def duckdb_query(relation: str, keep: tuple[str, ...], columns: tuple[tuple[str, str], ...]) -> str:
    """DuckDB SQL over ``relation`` that passes ``keep`` through and adds the
    consistent form of each (source, target) of ``columns``."""
    name = lambda c: '"' + c.replace('"', '""') + '"'
    others = "".join(name(c) + ", " for c in keep)
    sql = f"SELECT {others}{', '.join(f'{name(a)} AS {name(b)}' for a, b in columns)} FROM {relation}"
    for step in steps():
        sql = f"SELECT {others}{', '.join(f'{step.replace(V, name(b))} AS {name(b)}' for _, b in columns)} FROM ({sql})"
    return sql


def canonical_text(df: DataFrame, columns: dict[str, str], keep: list[str] | None = None) -> DataFrame:
    """``df`` with the consistent form of each column in ``columns`` (source to
    target name), and the columns in ``keep`` (all by default) as they are.

    A target may overwrite a kept column's name only by replacing that column.
    """
    kept = [c for c in (df.columns if keep is None else keep) if c not in columns.values()]
    pairs = tuple(columns.items())
    fields = [df.schema[c] for c in kept] + [T.StructField(b, T.StringType()) for _, b in pairs]
    sql, several = duckdb_query("batch", tuple(kept), pairs), several_map()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        con = connection(several)
        for batch in batches:
            if batch.num_rows:
                yield from con.from_arrow(pa.Table.from_batches([batch])).query("batch", sql).to_arrow_table().to_batches()

    needed = list(dict.fromkeys([*kept, *columns]))
    return df.select(*(F.col(_tick(c)) for c in needed)).mapInArrow(run, T.StructType(fields))


def _tick(c: str) -> str:
    return "`" + c.replace("`", "``") + "`"


def _members(df: DataFrame, id_column: str, text: str) -> DataFrame:
    """``id``, ``r`` (a hash of the string), ``f1``, ``f2`` (of its form), once each."""
    texts = df.select(F.col(_tick(id_column)).alias("id"), F.col(_tick(text)).alias("raw")).where("id is not null and raw is not null")
    formed = canonical_text(texts.withColumn("r", F.xxhash64("raw")), {"raw": "form"}, keep=["id", "r"])
    return cut(formed.select("id", "r", F.xxhash64("form").alias("f1"), F.xxhash64(F.lit(1), "form").alias("f2")).distinct())


def looks_the_same(df: DataFrame, id_column: str = "example_id", text: str = "text_ory", part: int = 2048) -> DataFrame:
    """Pairs of records whose texts are different strings that look the same.

    Columns ``example_id_a < example_id_b``. Repeated rows of a record count
    once; null texts are in no pair. Only hashes are shuffled (two of 64 bits
    for the form, one for the string), and only records of forms stored in
    more than one way reach the join, which never pairs equal strings. Those of
    a form that very many have meet in parts of about ``part``.
    """
    formed = _members(df, id_column, text)
    parts = F.expr(f"cast(ceil(count(1) / {part}) as int)")
    several = formed.groupBy("f1", "f2").agg(F.min("r").alias("lo"), F.max("r").alias("hi"), parts.alias("parts")).where("lo <> hi").select("f1", "f2", "parts")
    members = formed.join(several, ["f1", "f2"])
    a = members.select("f1", "f2", F.pmod(F.xxhash64("id"), "parts").alias("part"), F.col("id").alias("example_id_a"), F.col("r").alias("ra"))
    b = members.select("f1", "f2", F.explode(F.expr("sequence(0L, parts - 1L)")).alias("part"), F.col("id").alias("example_id_b"), F.col("r").alias("rb"))
    return a.join(b, ["f1", "f2", "part"]).where("example_id_a < example_id_b and ra <> rb").select("example_id_a", "example_id_b")


def look_classes(df: DataFrame, id_column: str = "example_id", text: str = "text_ory") -> DataFrame:
    """The id of each record with a text, ``class`` (the smallest id among those
    that look the same) and ``links``, how many of these are other strings.
    Counts per string are combined before forms are compared, so nothing grows
    with the square of a class."""
    formed = _members(df, id_column, text)
    strings = formed.groupBy("f1", "f2", "r").agg(F.count(F.lit(1)).alias("same"), F.min("id").alias("least"))
    forms = strings.groupBy("f1", "f2").agg(F.sum("same").alias("all"), F.min("least").alias("class"))
    joined = formed.join(strings.select("f1", "f2", "r", "same"), ["f1", "f2", "r"]).join(forms, ["f1", "f2"])
    return joined.select(F.col("id").alias(id_column), "class", (F.col("all") - F.col("same")).alias("links"))
