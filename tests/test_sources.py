import hashlib
import json

import pytest
from pyspark.sql import functions as F

from patraloom.sources import readers, sinks
from patraloom.streaming import curation


def test_formats(spark, tmp_path):
    (tmp_path / "a.csv").write_text('text,label\n"one\ntwo",1\n', encoding="utf-8")
    (tmp_path / "a.tsv").write_text("text\tlabel\nx\t0\n")
    (tmp_path / "a.jsonl").write_text('{"text": "x", "label": 1}\n')
    (tmp_path / "a.json").write_text('[{"text": "x"}, {"text": "y"}]')
    assert readers.read_any(spark, str(tmp_path / "a.csv")).first().text == "one\ntwo"
    assert [readers.read_any(spark, str(tmp_path / f"a.{k}")).count() for k in ("tsv", "jsonl", "json")] == [1, 1, 2]
    with pytest.raises(ValueError):
        readers.read_any(spark, str(tmp_path / "a.bin"))


def test_release_round_trip(spark, tmp_path):
    df = spark.createDataFrame([("2", "b", None, "train"), ("1", "ଅ", 1, "test")], "example_id string, text_ory string, label int, split string")
    sinks.write_release(df, str(tmp_path), "v")
    back = spark.read.parquet(str(tmp_path / "v/parquet"))
    assert back.select(df.columns).exceptAll(df).count() == 0 and back.where("split = 'train'").count() == 1
    lines = [line for f in (tmp_path / "v/json/split=train").glob("*.json") for line in f.read_text(encoding="utf-8").splitlines()]
    assert json.loads(lines[0]) == {"example_id": "2", "label": None, "text_ory": "b"}
    m = {r.path.rpartition("v/parquet/")[2]: r for r in sinks.manifest(spark, str(tmp_path / "v/parquet"), {"a": 1}, 42).collect()}
    assert m
    for name, r in m.items():
        raw = (tmp_path / "v/parquet" / name).read_bytes()
        assert (r.sha256, r.bytes, r.seed, len(r.config_sha256)) == (hashlib.sha256(raw).hexdigest(), len(raw), 42, 64)
    assert sum(r.rows or 0 for r in m.values()) == 2


def test_splits_and_shards(spark, tmp_path):
    df = spark.createDataFrame([("x", 1), ("y", 0)], "text_ory string, label int")
    df.write.parquet(str(tmp_path / "v/test.parquet"))
    assert readers.read_split(spark, str(tmp_path), "v", "test").columns == ["text_ory", "label", "split", "variant"]
    spark.createDataFrame([(" ", 1)], df.schema).write.parquet(str(tmp_path / "v/bad.parquet"))
    with pytest.raises(ValueError):
        readers.read_split(spark, str(tmp_path), "v", "bad")
    for _ in range(2):
        sinks.append_shard(df, str(tmp_path / "shards"))
    assert readers.cached_rows(spark, str(tmp_path / "shards")) == 4 and readers.cached_rows(spark, str(tmp_path / "none")) is None
    assert readers.find_root("NO_SUCH_VARIABLE", None, [str(tmp_path)], ["v"]) == str(tmp_path)
    with pytest.raises(FileNotFoundError):
        readers.find_root("NO_SUCH_VARIABLE", None, [], ["v"])
    sinks.write_annotation(df.withColumn("example_id", F.lit("1")), str(tmp_path / "csv"), ["example_id", "text_ory"])
    with pytest.raises(ValueError):
        sinks.write_annotation(df.withColumn("example_id", F.lit("1")), str(tmp_path / "csv2"), ["example_id"], most=1)
    assert readers.list_tables(spark, str(tmp_path / "v")) == ["bad", "test"]
    assert spark.read.csv(str(tmp_path / "csv"), header=True).columns == ["example_id", "text_ory", "human_label", "notes"]


def test_documents(tmp_path):
    stage = sinks.upsert_stage(str(tmp_path / "s.json"), "gates", 5, 3, {"x": 2})
    assert stage["balanced"] and not sinks.upsert_stage(str(tmp_path / "s.json"), "bands", 3, 1, {})["balanced"]
    docs = readers.read_documents(None, {"s": str(tmp_path / "s.json"), "t": str(tmp_path / "t.json")})
    assert set(docs["s"]) == {"gates", "bands"} and docs["t"] is None
    assert readers.missing_sources(["a", "b"], ["b", "c"]) == (["c"], ["a"])


def test_predictions_suites_and_paths(spark, tmp_path):
    df = spark.createDataFrame([("t", 1, 0)], "text string, gold int, pred int")
    sinks.write_predictions(df, str(tmp_path), {"n": 1})
    assert spark.read.parquet(str(tmp_path / "predictions.parquet")).collect() == df.collect() and json.loads((tmp_path / "metrics.json").read_text()) == {"n": 1}
    assert readers.read_suite(spark, str(tmp_path / "predictions.parquet"), {"text": "case", "gold": "label"}).columns == ["case", "label"]
    assert readers.source_path("/d/{repository}/{revision}/{name}.parquet", "r", "v1", "a") == "/d/r/v1/a.parquet"
    with pytest.raises(ValueError):
        readers.source_path("{name}", "r", "", "a")


def test_streams(spark, data, tmp_path):
    static = spark.read.parquet(f"{data}/score_shards.parquet")
    static.repartition(3).write.parquet(str(tmp_path / "in"))
    stream = curation.band_stream(curation.read_stream(spark, str(tmp_path / "in"), static.schema, 1))
    q = stream.writeStream.format("memory").queryName("banded").outputMode("append").option("checkpointLocation", str(tmp_path / "c1")).start()
    q.processAllAvailable()
    q.stop()
    want = curation.band_stream(static)
    assert spark.table("banded").groupBy("label").count().exceptAll(want.groupBy("label").count()).count() == 0
    q = curation.band_counts(stream).writeStream.format("memory").queryName("counted").outputMode("update").option("checkpointLocation", str(tmp_path / "c2")).start()
    q.processAllAvailable()
    q.stop()
    assert spark.table("counted").count() > 0
