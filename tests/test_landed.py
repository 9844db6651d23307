"""Landed exports: files written in tasks, and read once."""

import json

from pyspark.sql import functions as F

from tidemark.operators import clean
from tidemark.plans import landed_queries as landed
from tidemark.plans import registry
from tidemark.sources import readers, sinks


def bytes_read(spark):
    found = spark._jvm.org.apache.hadoop.fs.FileSystem.getAllStatistics()
    return sum(x.getBytesRead() for x in found if x.getScheme() == "file")


def test_messages_are_read_without_opening_the_file_for_each(spark, tmp_path):
    said = [f'{{"id": "{i}",  "n": {i}.50, "content": "x"}}' for i in range(3000)]
    text = '[{"channel": {"id": "c"}, "messages": [' + ",\n".join(said) + "]}]\n"
    (tmp_path / "a.json").write_text(text)
    (tmp_path / "b.json").write_bytes(b"\xef\xbb\xbf" + '{"channel": {"id": "é"}, "messages": [{"id": "é",  "n": 1.50}, "t"]}\n\n'.encode())
    raw = readers.read_chat_archives(spark, str(tmp_path / "a.json"))
    before = bytes_read(spark)
    got = [r.raw for r in raw.orderBy("ordinal").collect()]
    assert got == said and bytes_read(spark) - before < 4 * len(text)
    assert {(r.channel_id, r.raw) for r in readers.read_chat_archives(spark, str(tmp_path / "b.json")).collect()} == {("é", '{"id": "é",  "n": 1.50}'), ("é", "t")}


def test_sound_issues_are_read_once(spark):
    rows = [("AB-1", "a", "2026-01-01", "2026-01-02"), ("AB-1", "b", "2026-01-01", "2026-01-03"), ("AB-2", "c", None, None), ("no key", "d", "2026-01-01", None)]
    issues = spark.createDataFrame(rows, "key string, s string, c string, u string").select("key", F.struct(
        F.col("s").alias("summary"), F.col("s").alias("description"), F.struct(F.col("s").alias("name")).alias("status"), F.struct(F.col("s").alias("displayName")).alias("reporter"),
        F.struct(F.col("s").alias("displayName")).alias("assignee"), F.col("c").alias("created"), F.col("u").alias("updated")).alias("fields"))
    for mode, want in (("freshest", ["b"]), ("by_update", ["a", "b"])):
        good, bad = clean.clean_issues(issues, mode=mode)
        assert "Union" not in good._jdf.queryExecution().optimizedPlan().toString()
        assert sorted(r.summary for r in good.collect()) == want and sorted(r.reason for r in bad.collect()) == ["bad_key", "created:missing"]


def test_texts_lie_where_spark_looks_for_them(spark, tmp_path):
    rows = [(t, s, i) for i, (t, s) in enumerate([("a/b=c", "x y"), ("a/b=c", "x y"), (None, "é"), ("a", None), ("t%1", "[z]"), ("a", "x")] * 3000)]
    df = spark.createDataFrame(rows, "task_id string, source_table string, n int")
    for _ in range(2):  # what was there is replaced
        sinks.write_task_slices(df, str(tmp_path / "own"))
    df.write.partitionBy("task_id", "source_table").json(str(tmp_path / "spark"))
    folders = lambda x: sorted(str(p.parent.relative_to(tmp_path / x)) for p in (tmp_path / x).rglob("*.json"))
    assert folders("own") == sorted(set(folders("spark"))) and len(folders("own")) == 5
    back = spark.read.schema(df.schema).json(str(tmp_path / "own"))
    assert sorted(map(tuple, back.select(df.columns).collect()), key=lambda r: r[2]) == rows


def test_arrays_of_docs_need_no_gathering(spark, tmp_path):
    df = spark.range(40_000).withColumn("shard", F.col("id") % 3)
    sinks.write_texts(df, f"file://{tmp_path}/in", ["shard"], ["id"], F.to_json(F.struct("id")), ("[", ",", "]"), "all.json")
    got = {p.parent.name: [x["id"] for x in json.loads(p.read_text())] for p in (tmp_path / "in").rglob("all.json")}
    assert got == {f"shard={k}": list(range(k, 40_000, 3)) for k in range(3)}


def test_shares_of_an_export_have_a_bound(spark, monkeypatch):
    """A task lands as many records however many there are, not a part of them that the session's settings give."""
    monkeypatch.setattr(landed, "RECORDS", 100)
    seen = {}

    def held(rows, path, by, order, line, around, tasks=None):
        seen.update(rows=rows.select("x", F.spark_partition_id().alias("share")), tasks=tasks)

    monkeypatch.setattr(sinks, "write_texts", held)
    sf = "/root/testdata/sf0.001"
    landed._issue_files(spark, sf)
    lines = spark.read.parquet(f"{sf}/lineitem.parquet").count()
    most = seen["rows"].groupBy("share").agg(F.sum(F.size("x")).alias("n")).agg(F.max("n"), F.sum("n")).first()
    assert seen["tasks"] == -(-lines // 100) > 4
    assert most[1] == lines and most[0] <= 3 * 100


def test_files_are_dealt_over_the_tasks_asked_for(spark, tmp_path):
    rows = spark.range(400).select((F.col("id") % 40).alias("shard"), "id")
    sinks.write_texts(rows, tmp_path.as_uri(), ["shard"], ["id"], F.col("id").cast("string"), tasks=20)
    found = spark.read.text(str(tmp_path), recursiveFileLookup=True)
    assert sorted(int(r[0]) for r in found.collect()) == list(range(400)) and len(found.inputFiles()) == 40


def test_slices_are_read_by_the_table_of_their_files(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(sinks, "PIECE", 7)
    rows = [(t, s, i, f"é\n{i}") for i, (t, s) in enumerate([("a/b=c", "x y"), ("a/b=c", "x y"), (None, "é"), ("a", None), ("t%1", "[z]"), ("a", "x")] * 30)]
    df = spark.createDataFrame(rows, "task_id string, source_table string, n int, t string")
    for _ in range(2):
        sinks.write_task_slices(df, tmp_path.as_uri())
    got = sinks.read_task_slices(spark, tmp_path.as_uri(), "n int, task_id string, t string, source_table string")
    assert got.columns == ["n", "task_id", "t", "source_table"] and all(f"/{sinks.LISTED}/" in f for f in got.inputFiles())
    assert sorted(map(tuple, got.select(df.columns).collect()), key=lambda r: r[2]) == rows
    listed = {r.path: r.bytes for r in spark.read.parquet(f"{tmp_path}/{sinks.LISTED}").collect()}
    assert listed == {str(p.relative_to(tmp_path)): p.stat().st_size for p in tmp_path.rglob("part-0.json")} and len(listed) == 5


def test_slices_that_spark_wrote_are_read(spark, tmp_path):
    df = spark.range(40).selectExpr("id % 3 AS task_id", "'x' AS source_table", "id")
    df.write.partitionBy("task_id", "source_table").json(str(tmp_path / "s"))
    back = sinks.read_task_slices(spark, str(tmp_path / "s"), "task_id bigint, source_table string, id bigint")
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, df.collect()))


def test_slices_are_not_looked_for(spark, tmp_path):
    """Few tasks read many small files, and Spark lists none of them."""
    rows = [(i, i % 150, ["a", "b"][i % 2]) for i in range(600)]
    spark.createDataFrame(rows, "event_id bigint, user_id bigint, event_type string").write.parquet(f"{tmp_path}/events.parquet")
    got = registry.queries()["slices_written"](spark, str(tmp_path))
    assert all(f"/{sinks.LISTED}/" in f for f in got.inputFiles())
    assert sorted(map(tuple, got.collect())) == [(u, ["a", "b"][u % 2], 4) for u in range(150)]
