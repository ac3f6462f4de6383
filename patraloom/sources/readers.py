"""Readers: pruned Parquet, many formats by suffix, variants and splits."""

from __future__ import annotations

import json
import os
from collections.abc import Iterable, Sequence
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def read_table(spark: SparkSession, path: str, columns: Sequence[str] | None = None, schema: T.StructType | None = None) -> DataFrame:
    """A Parquet table, only the columns asked for."""
    reader = spark.read.schema(schema) if schema else spark.read
    df = reader.parquet(path)
    return df.select(*columns) if columns else df


def read_sources(spark: SparkSession, paths: dict[str, str], columns: Sequence[str] | None = None) -> DataFrame:
    """One table per named source, together, with ``source_config``."""
    parts = [read_table(spark, p, columns).withColumn("source_config", F.lit(n)) for n, p in sorted(paths.items())]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def read_any(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """A file read by its suffix: parquet, csv or txt, tsv, jsonl or ndjson,
    json (an array), xlsx or xls (on the driver, where pandas can). Others raise."""
    kind = Path(path).suffix.lower()
    r = spark.read.schema(schema) if schema else spark.read
    if kind == ".parquet":
        return r.parquet(path)
    if kind in (".csv", ".txt", ".tsv"):
        return r.csv(path, header=True, multiLine=True, escape='"', sep="\t" if kind == ".tsv" else ",")
    if kind in (".jsonl", ".ndjson"):
        return r.json(path)
    if kind == ".json":
        return r.json(path, multiLine=True)
    if kind in (".xlsx", ".xls"):
        import pandas as pd

        return spark.createDataFrame(pd.read_excel(path), schema)
    raise ValueError(f"no reader for {kind or 'files without a suffix'}: {path}")


def find_root(name: str, configured: str | None, fallbacks: Iterable[str], variants: Sequence[str]) -> str:
    """The first folder that holds every variant: the environment variable
    ``name``, what is configured, then the fallbacks."""
    for c in filter(None, [os.environ.get(name), configured, *fallbacks]):
        if all(os.path.isdir(os.path.join(c, v)) for v in variants):
            return c
    raise FileNotFoundError("no folder holds " + ", ".join(variants))


def read_split(spark: SparkSession, root: str, variant: str, split: str, text: str = "text_ory", label: str = "label") -> DataFrame:
    """A split of a release, checked: its columns, no blank text, labels 0 and 1 only."""
    df = read_table(spark, f"{root}/{variant}/{split}.parquet")
    missing = {text, label} - set(df.columns)
    if missing:
        raise ValueError(f"missing columns {sorted(missing)}")
    blank, odd = df.agg(F.count_if(F.coalesce(F.trim(text), F.lit("")) == ""), F.count_if(~F.coalesce(F.col(label).isin(0, 1), F.lit(False)))).first()
    if blank or odd:
        raise ValueError(f"{blank} blank texts, {odd} labels that aren't 0 or 1")
    return df.withColumn("split", F.lit(split)).withColumn("variant", F.lit(variant))


def read_documents(spark: SparkSession, paths: dict[str, str]) -> dict[str, dict | None]:
    """JSON metric documents by name; null for one that isn't there."""
    return {n: json.loads(Path(p).read_text(encoding="utf-8")) if Path(p).exists() else None for n, p in paths.items()}


def missing_sources(found: Iterable[str], wanted: Iterable[str]) -> tuple[list[str], list[str]]:
    """(wanted but missing, which is fatal for a reader; found but unexpected, which is not)."""
    f, w = set(found), set(wanted)
    return sorted(w - f), sorted(f - w)


def source_path(template: str, repository: str, revision: str, name: str) -> str:
    """The path of a source's table, pinned to a revision: ``template`` names
    ``{repository}``, ``{revision}`` and ``{name}``."""
    if not revision:
        raise ValueError("a source needs a revision")
    return template.format(repository=repository, revision=revision, name=name)


def read_suite(spark: SparkSession, path: str, columns: dict[str, str]) -> DataFrame:
    """A labelled suite, with only the columns asked for, under the names given (``{there: here}``)."""
    return read_any(spark, path).select(*(F.col(f"`{a}`").alias(b) for a, b in columns.items()))


def list_tables(spark: SparkSession, root: str) -> list[str]:
    """The names of the Parquet tables (files or folders) in a folder of any file system."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(root)
    found = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).listStatus(path)
    names = [f.getPath().getName() for f in found]
    return sorted(n.removesuffix(".parquet") for n in names if n.endswith(".parquet"))


def cached_rows(spark: SparkSession, path: str) -> int | None:
    """Rows of a table that was written before, from its footers; null if there is none."""
    try:
        return spark.read.parquet(path).count()
    except Exception as e:  # noqa: BLE001
        if "PATH_NOT_FOUND" in str(e):
            return None
        raise
