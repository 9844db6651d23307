"""Slices, counts and texts of windows without pairs of window and record being shuffled, sorted or made."""

import datetime as d
import itertools
import random
from collections import Counter

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from tidemark.operators import dataset, interval, reports, windows
from tidemark.plans import registry

T0 = d.datetime(2026, 1, 1)


def at(minutes):
    return T0 + d.timedelta(minutes=minutes)


def streams(spark, n=60):
    rng = random.Random(7)
    said = [(f"m{i:03}", at(rng.randrange(300)), rng.choice(["ann", "bob", None]), f"text {i}" + "x" * rng.randrange(9)) for i in range(n)] + [("late", None, "ann", "no time")]
    pulls = [(i, f"change {i}", "dev", at(rng.randrange(300)), None) for i in range(n // 4)]
    m = spark.createDataFrame(said, "message_id string, ts timestamp, author_name string, content string")
    p = spark.createDataFrame(pulls, "pr_number int, title string, author string, opened_at timestamp, merged_at timestamp")
    return said, pulls, {"messages": m, "pulls": p}


def spans(spark, rows):
    return spark.createDataFrame(rows, "window_id string, start_ts timestamp, end_ts timestamp")


ROWS = [(f"w{i}", at(7 * i), at(7 * i + random.Random(i).randrange(200))) for i in range(20)] + [("back", at(9), at(3)), ("none", None, at(3)), ("far", at(9999), at(99999))]


def inside(said, pulls, a, b):
    found = [(ts, "messages", k, t) for k, ts, _, t in said if ts is not None and a is not None and a <= ts <= b]
    return sorted(found + [(ts, "pulls", str(k), t) for k, t, _, ts, _ in pulls if a is not None and a <= ts <= b])


@pytest.mark.parametrize("bucket", [600, None])
def test_ordinals_need_no_shuffle_of_pairs(spark, bucket):
    said, pulls, silver = streams(spark)
    got = windows.slice_chunks(spans(spark, ROWS), silver, bucket_seconds=bucket)
    above = got._jdf.queryExecution().optimizedPlan().toString().split("Join Inner")[0]
    assert "Window" not in above and "Aggregate" not in above
    want = set()
    for w, a, b in ROWS:
        for name in ("messages", "pulls"):
            want |= {(w, name, k, n) for n, (_, _, k, _) in enumerate([r for r in inside(said, pulls, a, b) if r[1] == name], 1)}
    assert sorted((r.window_id, r.source_table, r.source_key, r.ordinal) for r in got.collect()) == sorted(want) and len(want) > 300


def test_ordinals_of_an_id_of_several_windows_run_on(spark):
    said, pulls, silver = streams(spark)
    got = windows.slice_chunks(spans(spark, [("w", at(0), at(100)), ("w", at(50), at(150)), ("v", at(50), at(150))]), silver)
    both = sorted(r.ordinal for r in got.where("window_id = 'w' AND source_table = 'messages'").collect())
    assert both == list(range(1, len(both) + 1)) and len(both) > got.where("window_id = 'v' AND source_table = 'messages'").count()


@pytest.fixture
def no_pairs(monkeypatch):
    def refuse(*args, **kwargs):
        raise AssertionError("pairs of window and record")

    monkeypatch.setattr(windows, "slice_by_windows", refuse)


def test_participants_make_no_pairs(spark, no_pairs):
    said, pulls, silver = streams(spark)
    got = {r.window_id: r.participants for r in windows.participants(spans(spark, ROWS), silver["messages"]).collect()}
    want = {w: sorted({x for _, ts, x, _ in said if x is not None and ts is not None and a <= ts <= b}) for w, a, b in ROWS if any(r[1] == "messages" for r in inside(said, pulls, a, b))}
    assert got == want


def test_overlaps_make_no_pairs(spark, no_pairs):
    said, pulls, silver = streams(spark)
    n = {}
    for _, a, b in ROWS:
        for _, name, k, _ in inside(said, pulls, a, b):
            n[name, k] = n.get((name, k), 0) + 1
    assert {(r.source_table, r.source_key): r.n for r in windows.chunk_overlaps(spans(spark, ROWS), silver).collect()} == {k: v for k, v in n.items() if v > 1}


def test_counts_of_briefs_make_no_pairs(spark, no_pairs):
    said, pulls, silver = streams(spark)
    counts = windows.chunk_counts(spans(spark, ROWS), silver)
    n = {}
    for w, a, b in ROWS:
        for _, name, _, _ in inside(said, pulls, a, b):
            n[w, name] = n.get((w, name), 0) + 1
    assert {(r.window_id, r.source_table): r.n for r in counts.collect()} == n


def test_authors_of_proposals_make_no_pairs(spark, no_pairs):
    said, _, silver = streams(spark)
    secs = lambda x: str(int(x.replace(tzinfo=d.timezone.utc).timestamp()))
    row = [("t", "T", "s", secs(at(0)), secs(at(120)), 1.0, [], (["m001"], None, [], []))]
    kinds = "task_id string, title string, summary string, start_ts string, end_ts string, confidence double, participants array<string>, evidence struct<message_ids: array<string>, ticket: string, pr_numbers: array<int>, merge_shas: array<string>>"
    bounds = windows.history_bounds((silver["messages"], "ts"))
    issues, pulls = spark.createDataFrame([], "issue_key string"), spark.createDataFrame([], "pr_number int, merged boolean")
    kept, _ = windows.validate_windows(spark.createDataFrame(row, kinds), silver["messages"], issues, pulls, bounds)
    assert kept.first().participants == sorted({x for _, ts, x, _ in said if x is not None and ts is not None and ts <= at(120)})


@pytest.mark.parametrize("block", [windows.BLOCK, 8])
def test_texts_of_streams_are_whole(spark, no_pairs, monkeypatch, block):
    """A chat of 600 lines or more in one window is one text, whatever blocks it is cut into."""
    monkeypatch.setattr(windows, "BLOCK", block)
    said, pulls, silver = streams(spark, 900)
    rows = [*ROWS, ("all", at(-1), at(400))]
    want = {}
    for w, a, b in rows:
        for ts, name, k, t in inside(said, pulls, a, b):
            if name == "messages":
                who = next(x for key, _, x, _ in said if key == k) or ""
                want[w] = want.get(w, []) + [f"[{ts:%Y-%m-%dT%H:%M:%SZ}] {who}: {t}"]
    got = windows.render_streams(spans(spark, rows), silver).where("section = 'chat'").collect()
    assert {r.window_id: r.text.split("\n") for r in got} == want and len(got) == len(want) and len(want["all"]) == 900


def test_windows_of_nearly_one_length_share_blocks(spark, no_pairs, monkeypatch):
    """Lines are shuffled once, half of them twice, not twice for each length of windows."""
    assert windows._blocks([0, 1, 2]) == [2] * 11 and windows._blocks([2, 3]) == [3] * 11
    assert windows._blocks([0, 1, 10]) == [1, 1, *[10] * 9] and windows._blocks([0]) == [0] * 11
    frame, dealt = type(spark.range(0)), []
    group = frame.groupBy
    monkeypatch.setattr(frame, "groupBy", lambda self, *by: (dealt.append(self) if "block" in by else None, group(self, *by))[1])
    monkeypatch.setattr(windows, "BLOCK", 256)
    said, pulls, silver = streams(spark, 900)
    rows = [(f"w{n}-{i}", at(i), at(i + n)) for n in (6, 12, 30) for i in range(0, 300, 7)]
    got = {r.window_id: len(r.text.split("\n")) for r in windows.render_streams(spans(spark, rows), {"messages": silver["messages"]}).collect()}
    want = {w: n for w, a, b in rows if (n := sum(name == "messages" for _, name, *_ in inside(said, pulls, a, b)))}
    assert got == want and len(dealt) == 1
    assert dealt[0].select("level").distinct().count() == 1 and 900 <= dealt[0].count() <= 1.6 * 900


@pytest.mark.parametrize("limit", [1, 37, 100_000])
def test_examples_of_streams_read_what_they_show(spark, no_pairs, limit):
    said, pulls, silver = streams(spark)
    w = spans(spark, ROWS).selectExpr("*", "'t' AS title", "'s' AS summary")
    got = {r.window_id: r.messages[1].content for r in dataset.examples_from_streams(w, silver, "sys", limit).collect()}
    texts = {x: [t[:limit] for *_, t in inside(said, pulls, a, b)] for x, a, b in ROWS}
    assert got == {x: "\n".join(t)[:limit] for x, t in texts.items() if t}


def test_pairs_are_dealt_over_all_tasks(spark):
    """Few bytes make many pairs: not as many tasks as records have bytes or files."""
    records = spark.range(0, 2000, numPartitions=1).select("id", F.timestamp_seconds(F.col("id") * 60).alias("ts"))
    w = records.where("id % 10 = 0").select(F.col("id").alias("window_id"), F.col("ts").alias("start_ts"), (F.col("ts") + F.expr("INTERVAL 20 MINUTES")).alias("end_ts"))
    got = interval.slice_by_windows(w, records, "ts", bucket_seconds=600).select("window_id", "id")
    assert got.rdd.getNumPartitions() == int(spark.conf.get("spark.sql.shuffle.partitions")) > 1
    assert sorted(map(tuple, got.collect())) == [(a, b) for a in range(0, 2000, 10) for b in range(a, min(a + 21, 2000))]


#: Several windows with the same bounds, one of them twice under one id, beside those of ROWS.
SHARED = [*ROWS, *[(f"s{i}", at(20), at(90)) for i in range(5)], ("s0", at(20), at(90)), ("two", at(0), at(50)), ("two", at(40), at(90))]


def pairs_of(said, pulls, rows):
    return [(w, name) for w, a, b in rows for _, name, *_ in inside(said, pulls, a, b)]


def test_counts_of_windows_with_the_same_bounds(spark, no_pairs):
    said, pulls, silver = streams(spark)
    want = Counter(pairs_of(said, pulls, SHARED))
    assert {(r.window_id, r.source_table): r.n for r in windows.chunk_counts(spans(spark, SHARED), silver).collect()} == want


def test_a_summary_of_chunks_takes_counts(spark, no_pairs):
    said, pulls, silver = streams(spark)
    pairs = pairs_of(said, pulls, SHARED)
    want = {name: (sum(t == name for _, t in pairs), len({w for w, t in pairs if t == name})) for name in ("messages", "pulls")}
    got = reports.chunk_summary(windows.chunk_counts(spans(spark, SHARED), silver))
    assert {r.source_table: (r["rows"], r.windows) for r in got.collect()} == want


def test_coverage_takes_counts(spark, no_pairs):
    said, pulls, silver = streams(spark)
    n = Counter(pairs_of(said, pulls, ROWS))
    per, total = reports.coverage(spans(spark, ROWS), windows.chunk_counts(spans(spark, ROWS), silver), ["messages", "pulls"])
    assert {r.window_id: (r.messages, r.pulls) for r in per.collect()} == {w: (n[w, "messages"], n[w, "pulls"]) for w, *_ in ROWS}
    empty = sum(n[w, "messages"] + n[w, "pulls"] == 0 for w, *_ in ROWS)
    assert tuple(total.first()) == (len(ROWS), sum(v for (_, t), v in n.items() if t == "messages"), sum(v for (_, t), v in n.items() if t == "pulls"), empty) and empty >= 3


@pytest.mark.parametrize("name", ["chunk_summary", "slice_coverage", "windows_without_chunks"])
def test_queries_that_count_make_no_pairs(spark, no_pairs, tmp_path, name):
    rows = [(i, T0 + d.timedelta(minutes=3 * i), i % 7, ["click", "purchase", "error", "signup", "view"][i % 5], "{}") for i in range(200)]
    spark.createDataFrame(rows, "event_id bigint, ts timestamp, user_id bigint, event_type string, props string").write.parquet(f"{tmp_path}/events.parquet")
    assert registry.queries()[name](spark, str(tmp_path)).count() >= 1


@pytest.mark.parametrize("ids", [windows.IDS, 3])
def test_texts_of_the_same_bounds_follow_on_one_another(spark, no_pairs, monkeypatch, tmp_path, ids):
    """Each text is in one file only, all its windows in a row, and a file holds few texts, so a dictionary of them is small."""
    monkeypatch.setattr(windows, "IDS", ids)
    monkeypatch.setattr(windows, "ALIKE", 4000)
    said, pulls, silver = streams(spark, 900)
    rows = [(f"w{i}-{k}", at(i), at(i + 12)) for i in range(0, 300, 5) for k in range(8)] + [(None, at(0), at(12))]
    windows.render_streams(spans(spark, rows), {"messages": silver["messages"]}).write.parquet(f"{tmp_path}/texts")
    got = [(r.window_id, r.text) for r in spark.read.parquet(f"{tmp_path}/texts").collect()]
    want = {w: sum(name == "messages" for _, name, *_ in inside(said, pulls, a, b)) for w, a, b in rows}
    assert {w: len(t.split("\n")) for w, t in got} == want and len(got) == len(rows)
    files = [[r.text for r in pq.read_table(f).to_pandas().itertuples()] for f in sorted(tmp_path.glob("texts/*.parquet"))]
    assert all(len(set(texts)) == len([t for t, _ in itertools.groupby(texts)]) for texts in files)
    assert sum(len(set(texts)) for texts in files) == len({t for _, t in got}) and max(len(set(texts)) for texts in files) <= 12 < len(files)


@pytest.mark.parametrize("key", [None, "kind"])
def test_windows_with_the_same_bounds_are_joined_once(spark, monkeypatch, key):
    """Pairs of a record and windows that are alike follow on one another, always in one order of windows."""
    monkeypatch.setattr(interval, "SHARE", 100)
    records = spark.range(600).select("id", F.timestamp_seconds(F.col("id") * 60).alias("ts"), F.when(F.col("id") % 3 > 0, F.col("id") % 3).alias("kind"))
    rows = [(f"w{i}-{k}", at, at + d.timedelta(minutes=20), i % 3 or None) for i, at in ((i, d.datetime(1970, 1, 1) + d.timedelta(minutes=i)) for i in range(0, 600, 50)) for k in range(8)]
    rows += [(None, *rows[0][1:]), rows[0], ("back", rows[0][2], rows[0][1], None)]
    w = spark.createDataFrame(rows, "window_id string, start_ts timestamp, end_ts timestamp, kind bigint")
    w = w if key else w.drop("kind")
    found = interval.slice_by_windows(w, records, "ts", key=key, bucket_seconds=600)
    assert found.columns == [*w.columns, "id", "ts", *([] if key else ["kind"])]
    got = [(r.window_id, r.id) for r in found.collect()]
    minute = lambda x: int((x - d.datetime(1970, 1, 1)).total_seconds() // 60)
    want = [(x, i) for x, a, b, k in rows for i in range(600) if minute(a) <= i <= minute(b) and (key is None or (i % 3 or None) == k)]
    assert Counter(got) == Counter(want) and len({i for _, i in want}) == len([i for i, _ in itertools.groupby(i for _, i in got)])


def test_ordinals_of_windows_with_the_same_bounds(spark):
    said, pulls, silver = streams(spark)
    rows = [(f"{w}-{k}", a, b) for w, a, b in ROWS for k in range(6)]
    got = sorted((r.window_id, r.source_table, r.source_key, r.ordinal) for r in windows.slice_chunks(spans(spark, rows), silver, bucket_seconds=600).collect())
    want = [(w, name, k, n) for w, a, b in rows for name in ("messages", "pulls") for n, (_, _, k, _) in enumerate([r for r in inside(said, pulls, a, b) if r[1] == name], 1)]
    assert got == sorted(want) and len(want) > 1800
