"""Writers: sorted Parquet, release files with a JSON mirror, shards, manifests."""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator, Sequence
from pathlib import Path

import pyarrow as pa
import pyarrow.fs as pafs
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def write_sorted(df: DataFrame, path: str, key: str = "example_id", by: Sequence[str] = ()) -> None:
    """Parquet (zstd), range-partitioned and sorted by key, so that files and
    row groups have narrow key ranges; partitioned into folders by ``by``."""
    out = df.repartitionByRange(*[F.col(c) for c in by], F.col(key)).sortWithinPartitions(*by, key).write.mode("overwrite").option("compression", "zstd")
    (out.partitionBy(*by) if by else out).parquet(path)


def write_release(df: DataFrame, root: str, variant: str, split: str = "split", key: str = "example_id") -> None:
    """For all splits at once: Parquet and a JSON-lines mirror with sorted
    column names, nulls written out."""
    write_sorted(df, f"{root}/{variant}/parquet", key, [split])
    names = sorted(c for c in df.columns if c != split)
    rows = df.select(split, *names).repartitionByRange(split, key).sortWithinPartitions(split, key)
    rows.write.mode("overwrite").option("ignoreNullFields", "false").partitionBy(split).json(f"{root}/{variant}/json")


def append_shard(df: DataFrame, path: str) -> None:
    """Adds finished rows; a job that fails leaves nothing behind that is read."""
    df.write.mode("append").option("compression", "zstd").parquet(path)


def write_annotation(df: DataFrame, path: str, columns: Sequence[str], key: str = "example_id", seed: int = 42, most: int = 100_000) -> None:
    """A CSV for people, without labels and scores, in hash order. It is one
    file, so more than ``most`` rows are an error."""
    if df.limit(most + 1).count() > most:
        raise ValueError(f"more than {most} rows to annotate")
    order = F.sha2(F.concat(F.lit(f"{seed}:"), F.col(key)), 256)
    out = df.select(*columns, order.alias("_o")).orderBy("_o").drop("_o").withColumn("human_label", F.lit("")).withColumn("notes", F.lit(""))
    out.coalesce(1).write.mode("overwrite").option("header", True).option("quoteAll", True).csv(path)  # a sample a person reads


def write_predictions(df: DataFrame, folder: str, figures: object) -> None:
    """Predictions as Parquet and as CSV, and their metrics as JSON. The JSON is
    the driver's, so a folder of its own file system is meant."""
    df.write.mode("overwrite").option("compression", "zstd").parquet(f"{folder}/predictions.parquet")
    df.write.mode("overwrite").option("header", True).csv(f"{folder}/predictions.csv")
    write_json(figures, f"{folder}/metrics.json")


def write_json(value: object, path: str) -> None:
    """A small document; numbers of any library and paths are written plainly."""
    plain = lambda x: x.asDict(recursive=True) if hasattr(x, "asDict") else x.item() if hasattr(x, "item") else x.tolist() if hasattr(x, "tolist") else str(x)
    Path(path).parent.mkdir(parents=True, exist_ok=True)
    Path(path).write_text(json.dumps(value, default=plain, ensure_ascii=False, indent=2, sort_keys=True) + "\n", encoding="utf-8")


def upsert_stage(path: str, stage: str, rows_in: int, rows_out: int, dropped: dict[str, int]) -> dict:
    """Adds or replaces a stage's row counts in a JSON document, with whether they add up."""
    held = json.loads(Path(path).read_text(encoding="utf-8")) if Path(path).exists() else {}
    held[stage] = {"rows_in": rows_in, "rows_out": rows_out, "dropped": dropped, "balanced": rows_out + sum(dropped.values()) == rows_in}
    write_json(held, path)
    return held[stage]


def manifest(spark: SparkSession, path: str, config: object = None, seed: int | None = None) -> DataFrame:
    """``path``, ``bytes``, ``sha256`` and ``rows`` (of Parquet files, else null)
    of every file below a folder, with ``config_sha256`` and ``seed`` of the run.

    Files are read in their task bit by bit, whatever their size; rows come from
    the footers. The folder must be one that the executors' file systems see."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).select("path", F.col("length").alias("bytes"))
    digest = None if config is None else hashlib.sha256(json.dumps(config, sort_keys=True, default=str).encode()).hexdigest()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hashes, rows = [], []
            for name in batch.column(0).to_pylist():
                system, where = pafs.FileSystem.from_uri(name.replace("file:/", "file:///", 1) if name.startswith("file:/") and not name.startswith("file:///") else name)
                h = hashlib.sha256()
                with system.open_input_stream(where) as f:
                    while block := f.read(1 << 22):
                        h.update(block)
                hashes.append(h.hexdigest())
                rows.append(pq.ParquetFile(system.open_input_file(where)).metadata.num_rows if name.endswith(".parquet") else None)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(hashes, pa.string()), pa.array(rows, pa.int64())], ["path", "bytes", "sha256", "rows"])

    made = files.mapInArrow(run, "path string, bytes long, sha256 string, rows long")
    return made.withColumn("config_sha256", F.lit(digest).cast("string")).withColumn("seed", F.lit(seed).cast("long"))
