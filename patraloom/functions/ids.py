"""Stable identifiers and hash splits."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x: Column | str) -> Column:
    return F.col(x) if isinstance(x, str) else x


def example_id(source: Column | str, doc: Column | str) -> Column:
    """First 16 hex digits of SHA-256 of ``source|doc``; null if either is."""
    return F.substring(F.sha2(F.concat(_c(source), F.lit("|"), _c(doc).cast("string")), 256), 1, 16)


def unit_fraction(key: Column | str, salt: str) -> Column:
    """A number in [0, 1): the first 8 bytes of SHA-256 of ``salt:key`` over 2^64."""
    digits = F.substring(F.sha2(F.concat(F.lit(salt + ":"), _c(key).cast("string")), 256), 1, 16)
    return F.conv(digits, 16, 10).cast("decimal(20,0)").cast("double") / F.lit(float(2**64))


def assign_split(key: Column | str, proportions: dict[str, float], salt: str) -> Column:
    """The split of a key; it depends on nothing but the key. The last split
    takes what rounding leaves over."""
    if not proportions or abs(sum(proportions.values()) - 1) > 1e-6:
        raise ValueError("the proportions must sum to 1")
    u, upto, out = unit_fraction(key, salt), 0.0, None
    *first, last = proportions
    for name in first:
        upto += proportions[name]
        out = F.when(u < upto, F.lit(name)) if out is None else out.when(u < upto, F.lit(name))
    return F.lit(last) if out is None else out.otherwise(F.lit(last))
