import datetime
import json
import random
import shutil
import time
from collections import Counter, defaultdict
from datetime import datetime as dt

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators import dataset, graph, interval, links, replies, reports, validate, windows
from tidemark.sources import readers, sinks
from tidemark.streaming import stream

T0 = 1767225600  # 2026-01-01


def at(minutes):
    return dt.utcfromtimestamp(T0 + 60 * minutes)


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


MESSAGES = "message_id string, ts timestamp, author_name string, content string, mentions_ticket array<string>, mentions_pr array<int>, channel string"


@pytest.fixture(scope="module")
def silver(spark):
    said = [("1", at(0), "ann", "start AB-1", ["AB-1"], [], "c"), ("2", at(30), "bob", "AB-1 PR #7", ["AB-1"], [7], "c"), ("3", at(500), "cy", "later", [], [], "d"), ("4", at(20), "dan", "AB-2", ["AB-2"], [9], "d")]
    return {
        "messages": spark.createDataFrame(said, MESSAGES),
        "issues": spark.createDataFrame([("AB-1", "first", "d", "Done", at(-5), at(90)), ("AB-2", "second", "d", "Open", at(10), at(10))], "issue_key string, summary string, description string, status string, created_at timestamp, updated_at timestamp"),
        "events": spark.createDataFrame([("AB-1:1", "AB-1", at(60), "status", "Open", "Done"), ("AB-1:2", "AB-1", at(10), "status", "x", "Done")], "id string, issue_key string, ts timestamp, field string, from_value string, to_value string"),
        "pulls": spark.createDataFrame([(7, "fix", True, "ann", "m" * 40, at(5), at(45)), (9, "open", False, "bob", None, at(5), None)], "pr_number int, title string, merged boolean, author string, merge_sha string, opened_at timestamp, merged_at timestamp"),
        "commits": spark.createDataFrame([("m" * 40, "ann", at(44), "Merge", ["b", "a"])], "sha string, author_name string, authored_at timestamp, message string, changed_files array<string>"),
    }


def test_bounds_of_a_window_are_inside(spark):
    w = spark.createDataFrame([("w", at(0), at(10)), ("point", at(10), at(10)), ("reversed", at(10), at(0)), ("long", at(-500_000), at(500_000))], "window_id string, start_ts timestamp, end_ts timestamp")
    r = spark.createDataFrame([(1, at(0)), (2, at(10)), (3, at(11)), (4, None)], "n int, ts timestamp")
    plain = rows(interval.slice_by_windows(w, r, "ts", bucket_seconds=None).select("window_id", "n"))
    for size in (1, 60, 3600):
        assert rows(interval.slice_by_windows(w, r, "ts", bucket_seconds=size).select("window_id", "n")) == plain
    assert plain == [("long", 1), ("long", 2), ("long", 3), ("point", 2), ("w", 1), ("w", 2)]


def test_counts_by_window_make_no_pairs_and_lose_none(spark):
    w = spark.createDataFrame([("w", at(0), at(10)), ("point", at(10), at(10)), ("reversed", at(10), at(0)), ("long", at(-500_000), at(500_000)), ("none", at(900_000), at(900_001)), ("open", None, at(1))], "window_id string, start_ts timestamp, end_ts timestamp")
    r = spark.createDataFrame([("a", at(0)), ("a", at(10)), ("a", at(10)), ("b", at(11)), (None, at(5)), ("b", None), ("b", at(-400_000))], "kind string, ts timestamp")
    plain = rows(interval.slice_by_windows(w, r, "ts", bucket_seconds=None).groupBy("window_id", "kind").agg(F.count(F.lit(1)).alias("n")))
    for size in (1, 600, 86_400):
        assert rows(interval.count_by_windows(w, r, "ts", "kind", bucket_seconds=size)) == plain
    rng = random.Random(1)
    many = spark.createDataFrame([(f"w{i % 70}", at(a), at(a + rng.choice([0, 3, 90, 4000]))) for i, a in enumerate(rng.randrange(10_000) for _ in range(80))], "window_id string, start_ts timestamp, end_ts timestamp")
    many = many.unionByName(many.limit(5))  # a window that comes twice counts twice
    kinds = spark.createDataFrame([(f"k{rng.randrange(1500)}", at(rng.randrange(10_000))) for _ in range(4000)], "kind string, ts timestamp")
    want = many.join(kinds, F.col("ts").between(F.col("start_ts"), F.col("end_ts"))).groupBy("window_id", "kind").agg(F.count(F.lit(1)).alias("n"))
    assert rows(interval.count_by_windows(many, kinds, "ts", "kind")) == rows(want)
    sound = many.distinct()
    near = interval._kinds_near(sound, kinds.withColumnRenamed("ts", "__at"), "kind", "start_ts", "end_ts", 56)
    assert near.count() < 2 * want.count() + 9 * sound.count()  # not windows times kinds
    keyed = w.where("window_id <> 'open'").withColumn("kind", F.when(F.col("window_id") == "w", None).otherwise(F.lit("a")))
    for size in (None, 600):
        assert rows(interval.slice_by_windows(keyed, r, "ts", key="kind", bucket_seconds=size).where("window_id = 'w'").select("ts")) == [(at(5),)]


def test_numbers_threads_and_payloads(spark, silver):
    w = spark.createDataFrame([("b", at(5)), ("a", at(5)), ("z", None), ("c", at(-5000)), ("d", at(9000))], "task_id string, start_ts timestamp")
    assert [(r.window_id, r.task_id) for r in windows.number_windows(w).orderBy("window_id").collect()] == [("task-001", "z"), ("task-002", "c"), ("task-003", "a"), ("task-004", "b"), ("task-005", "d")]
    said = spark.createDataFrame([(str(i), at(i), "ann", f"text {i}", [], [], "c") for i in range(7)], MESSAGES)
    loose = windows.orphan_threads(said, most=3).orderBy("part").collect()
    assert [[m.message_id for m in r.messages] for r in loose] == [["0", "1", "2"], ["3", "4", "5"], ["6"]]
    digest = windows.ticket_digest(silver["issues"], silver["events"], silver["messages"], silver["pulls"], most_lines=1)
    one = json.loads(digest.where("issue_key = 'AB-1'").first()["digest"])
    assert one["n_messages"] == 2 and [d["id"] for d in one["discussion"]] == ["1"]
    made = windows.prompt_payload(digest, windows.orphan_threads(said, most=3), most_tokens=1, ranges=2).collect()
    assert sorted(t["ticket"] for r in made if r.kind == "tickets" for t in json.loads(r.payload)["tickets"]) == ["AB-1", "AB-2"]
    assert sorted(m["message_id"] for r in made if r.kind == "threads" for t in json.loads(r.payload)["threads"] for m in t["messages"]) == list("0123456")


def test_baseline_and_nearest(silver):
    s = silver
    base = windows.baseline_windows(s["messages"], s["issues"], s["events"], s["pulls"]).collect()
    assert [(b.task_id, b.start_ts, b.end_ts) for b in base] == [("ab-1", at(-5), at(60))]
    assert base[0].evidence.pr_numbers == [7] and base[0].evidence.message_ids == ["1", "2"] and base[0].participants == ["ann", "bob"]
    near = windows.nearest_windows(s["messages"], s["events"], s["pulls"]).collect()
    assert [(n.task_id, n.pr_number, n.end_ts, n.confidence) for n in near] == [("AB-1", 7, at(60), 0.95)]


def test_proposals_need_evidence(spark, silver):
    s = silver
    proof = lambda ids, prs=(): (list(ids), "AB-1", list(prs), [])
    p = [("ok", "T", "s", str(T0), str(T0 + 60), 3.0, [], proof(["1", "zz"])), ("rev", "T", "s", str(T0 + 9), str(T0), None, [], proof(["1"])), ("junk", "T", "s", "x", "1", None, [], proof(["1"])), ("far", "T", "s", "1", "2", None, [], proof(["1"])), ("none", "T", "s", str(T0), str(T0), None, [], proof(["zz"])), ("pr", "T", "s", str(T0), str(T0), None, [], proof(["zz"], [7]))]
    schema = "task_id string, title string, summary string, start_ts string, end_ts string, confidence double, participants array<string>, evidence struct<message_ids: array<string>, ticket: string, pr_numbers: array<int>, merge_shas: array<string>>"
    bounds = windows.history_bounds((s["messages"], "ts"))
    kept, dropped = windows.validate_windows(spark.createDataFrame(p, schema), s["messages"], s["issues"], s["pulls"], bounds)
    k = kept.collect()
    assert [r.task_id for r in k] == ["ok"] and k[0].confidence == 1.0 and k[0].evidence.hallucinated == ["zz"] and k[0].participants == ["ann"]
    assert dict((r.task_id, r.reason) for r in dropped.collect()) == {"rev": "ends before it starts", "junk": "bounds are not whole numbers", "far": "outside the history", "none": "no evidence", "pr": "no verified citation"}


def test_chunks_text_and_files(silver, spark):
    s = silver
    w = spark.createDataFrame([("w1", "ab-1", "t", at(0), at(60), ["ann"], "e"), ("w2", "x", "t", at(9000), at(9001), [], "e")], "window_id string, task_id string, title string, start_ts timestamp, end_ts timestamp, participants array<string>, evidence string")
    named = {"messages": s["messages"], "changelog": s["events"], "commits": s["commits"], "issues": s["issues"], "pulls": s["pulls"]}
    chunks = windows.slice_chunks(w, named)
    assert rows(chunks.groupBy("source_table").count()) == [("changelog", 2), ("commits", 1), ("issues", 1), ("messages", 3), ("pulls", 2)]
    assert rows(windows.empty_windows(w, chunks).select("window_id")) == [("w2",)]
    text = {(r.window_id, r.section, r.part): r.text for r in windows.render_evidence(w, chunks).collect()}
    assert text["w1", "chat", 0].split("\n")[0] == "[2026-01-01T00:00:00Z] ann: start AB-1" and text["w1", "pull_requests", 0] == "#9 open (bob)\n#7 fix (ann)" and text["w2", None, None] is None
    parts = {(r.section, r.part): r.text for r in windows.render_evidence(w, chunks, most_lines=2).where("window_id = 'w1'").collect()}
    assert "\n".join(parts["chat", i] for i in (0, 1)) == text["w1", "chat", 0] and parts["chat", 1].count("\n") == 0
    assert rows(windows.touched_files(chunks)) == [("w1", "a", "Merge"), ("w1", "b", "Merge")]
    brief = json.loads(windows.task_briefs(w, chunks, spark.createDataFrame([("w1", "p")], "window_id string, path string")).where("window_id = 'w1'").first()["brief"])
    assert brief["duration_minutes"] == 60.0 and brief["messages"] == 3 and brief["documents"] == ["p"]
    per, total = reports.coverage(w, chunks, list(named))
    assert total.first()["empty"] == 1
    bad = validate.check_gold(w, chunks, spark.createDataFrame([("w1", "no diff")], "window_id string, patch string"))
    assert rows(bad.select("check", "key")) == [("patch_not_a_diff", "w1"), ("window_empty", "w2")]


def test_scores_and_choice(spark):
    make = lambda *r: spark.createDataFrame([(k, at(a), at(b)) for k, a, b in r], "task_id string, start_ts timestamp, end_ts timestamp")
    ref, hyp = make(("a", 0, 10), ("b", 0, 10)), make(("a", 1, 10), ("b", 60, 10), ("c", 0, 1))
    s = windows.score_windows(hyp, ref).first()
    assert (s.matched, s.exact, s.hallucinated) == (2, 1, 1) and abs(s.precision - 2 / 3) < 1e-9 and s.recall == 1.0
    assert rows(windows.worst_windows(hyp, ref, 1)) == [("b", 3600, 0, 3600)]
    assert windows.choose_windows(hyp, ref).count() == 2 and windows.choose_windows(hyp, ref, ref).count() == 2
    assert windows.choose_windows(hyp, ref, source="model").count() == 3
    assert windows.score_windows(hyp.limit(0), ref.limit(0)).first()["f1"] == 0.0
    assert rows(validate.recall_gate(windows.score_windows(make(("a", 0, 10)), ref)).select("detail")) == [("1/2",)]


def test_merge_bases_of_awkward_graphs(spark):
    # criss-cross: x and y both merge a and b; an octopus o; a root r; a tip z apart
    edges = [("a", "r"), ("b", "r"), ("x", "a"), ("x", "b"), ("y", "b"), ("y", "a"), ("o", "x"), ("o", "y"), ("o", "a")]
    e = spark.createDataFrame(edges, "child string, parent string")
    pairs = spark.createDataFrame([("x", "y"), ("a", "b"), ("x", "a"), ("x", "z"), ("o", "o")], "left string, right string")
    assert rows(graph.merge_base(e, pairs)) == [("a", "b", "r"), ("o", "o", "o"), ("x", "a", "a"), ("x", "y", "a"), ("x", "y", "b")]
    order = spark.createDataFrame([("a", at(1)), ("b", at(2))], "node string, committed_at timestamp")
    assert ("x", "y", "b") in rows(graph.merge_base(e, pairs, order)) and ("x", "y", "a") not in rows(graph.merge_base(e, pairs, order))
    heads = spark.createDataFrame([("x", "a"), ("r", "r")], "head string, base string")
    more = spark.createDataFrame([("r", "w"), ("x", "w")], "head string, node string")
    assert rows(graph.branch_commits(e, heads, more)) == [("r", "w"), ("x", "b"), ("x", "x")]


def test_pulls_from_merge_commits(spark):
    c = [("r", [], "root", at(0), "ann", ["f"]), ("b1", ["r"], "one", at(1), "bob", ["f", "g"]), ("b2", ["b1"], "two", at(2), "cy", ["g"]), ("m", ["r", "b2"], "Merge pull request #12 from bob/x", at(3), "ann", [])]
    commits = spark.createDataFrame(c, "sha string, parent_shas array<string>, message string, authored_at timestamp, author_name string, changed_files array<string>")
    got = graph.derive_pulls(commits, graph.commit_edges(commits)).first()
    assert (got.pr_number, got.branch, got.commits, got.changed_files, got.author, got.opened_at) == (12, "bob/x", 2, 2, "bob", at(2))
    pulls = spark.createDataFrame([(12, True, "m", at(2)), (13, True, "gone", at(2))], "pr_number int, merged boolean, merge_sha string, merged_at timestamp")
    assert {r[0] for r in rows(validate.check_git(commits, pulls))} == {"merge_unknown", "merged_before_commit"}


def test_nearest_in_either_direction(spark):
    left = spark.createDataFrame([("k", 1, at(10)), ("k", 2, at(0)), ("none", 3, at(0))], "key string, id int, ts timestamp")
    right = spark.createDataFrame([("k", at(8), 5), ("k", at(12), 4), ("k", at(12), 9)], "key string, r_ts timestamp, r_id int")
    got = {r.id: r.r_id for r in links.nearest(left, right, "key", "ts", "r_ts", "r_id").collect()}
    assert got == {1: 4, 2: 5, 3: None}
    more = left.unionByName(spark.createDataFrame([(None, 4, at(0)), ("k", 5, None), ("k", 6, at(90_000))], left.schema))
    right = right.unionByName(spark.createDataFrame([(None, at(99_999), 7), ("k", None, 1)], right.schema))
    for size in (1, 600, 86_400):
        got = {r.id: r.r_id for r in links.nearest(more, right, "key", "ts", "r_ts", "r_id", size).collect()}
        assert got == {1: 4, 2: 5, 3: None, 4: 7, 5: None, 6: 4}


STEP = "run_id string, turn int, step int, content string, tool_name string, tool_args string, tool_result string"


def test_conversations_and_their_checks(spark):
    runs = spark.createDataFrame([("r1", "w1", "succeeded", 1.0, "old"), ("r2", "w1", "succeeded", 2.0, " done "), ("r3", "w2", "succeeded", 1.0, None), ("r4", "w3", "failed", 1.0, "x")], "id string, window_id string, status string, finished_at double, final string")
    steps = spark.createDataFrame([("r2", 1, 0, "look", "search", "{}", "z" * 13_000), ("r2", 1, 1, None, "magic", "{}", "no"), ("r2", 0, 0, "hello", None, None, None), ("r2", 2, 0, "done", None, None, None), ("r3", 0, 0, "a", "search", "{}", "b")], STEP)
    wins = spark.createDataFrame([("w1", "t", "s"), ("w2", "t", "s"), ("w3", "t", "s")], "window_id string, title string, summary string")
    made = dataset.build_conversations(runs, steps, wins, ["search"], "sys").collect()
    assert [(m.window_id, m.run_id, m.dropped_tool_names) for m in made] == [("w1", "r2", 1)]
    m = made[0].messages
    assert [x.role for x in m] == ["system", "user", "assistant", "assistant", "tool", "assistant"] and m[-1].content == "done"
    assert m[3].tool_calls[0].id == m[4].tool_call_id and len(m[4].content) == 12_000
    again = dataset.build_conversations(runs, steps, wins, ["search"], "sys").first()
    assert again.messages == m
    call = lambda *ids: ("assistant", "x", [(i, "search", "{}") for i in ids], None, None)
    tool = lambda i: ("tool", "r", None, i, "search")
    talk = {"good": [("system", "s", None, None, None), call("a"), tool("a"), ("assistant", "ok", None, None, None)], "early": [tool("a"), call("a")], "twice": [call("a"), tool("a"), tool("a")], "open": [call("a", "b"), tool("b")], "blank": [("system", "s", None, None, None), call("a"), tool("a"), ("assistant", " ", None, None, None)]}
    df = spark.createDataFrame(list(talk.items()), f"window_id string, messages array<{dataset.MESSAGE}>")
    got = rows(validate.check_tool_pairing(df))
    assert got == [("orphan_result", "early", "a"), ("orphan_result", "twice", "a"), ("unanswered_call", "early", "a"), ("unanswered_call", "open", "a")]
    bad = rows(validate.check_conversations(df).select("key", "check"))
    assert not [b for b in bad if b[0] == "good"] and ("blank", "final_not_blank") in bad and ("early", "three_messages") in bad
    assert rows(validate.check_tools(df, ["other"]).select("detail").distinct()) == [("search",)]
    assert dataset.masked(df).where("window_id = 'good'").first()["trainable"] == [False, True, False, True]


def test_splits_keep_their_size_and_guard(spark):
    df = spark.range(1000).select(F.col("id").alias("k"))
    one = dataset.split_dataset(df, "k", "s", 0.15)
    assert one.where("split = 'val'").count() == 150 and one.columns == ["k", "split"]
    assert rows(one) == rows(dataset.split_dataset(df.repartition(3), "k", "s", 0.15))
    assert dataset.split_dataset(df.limit(3), "k").where("split = 'val'").count() == 1
    held = spark.range(500).select(F.col("id").alias("k"))
    assert dataset.split_dataset(df, "k", held=held).agg(F.min("k")).first()[0] == 500


def test_replies(spark):
    one = '{"windows": [{"task_id": "a", "evidence": {"message_ids": ["m"]}}]}'
    texts = {
        "plain": one, "fence": f"Before {{\"windows\": []}}\n```json\n{one}\n```\nafter", "list": one[12:-1], "comments": one.replace('"a",', '"a", // note\n /* x */'),
        "commas": one.replace('["m"]', '["m",]'), "cut": one[:-14], "quotes": one.replace('"', "“"), "zero": "​" + one, "none": "sorry", "string": '{"windows": [{"task_id": "a", "title": "} // no"}]}',
        "spaces": one.replace(": ", ":\u00a0").replace("}]}", "}\r\n]\u2028}"), "low": one.replace('"', "\u201f"),
        "long": one[:-2] + "".join(f', {{"task_id": "a", "x": {i}}}' for i in range(300)) + ', {"task_id": bad' + ", 1" * 500,
    }
    df = spark.createDataFrame([*texts.items(), ("null", None)], "reply_id string, text string")
    got = {r.reply_id: r for r in replies.load_proposals(df).collect()}
    assert replies.load_proposals(df).where("reply_id = 'long'").count() == 301
    assert set(got) == set(texts) - {"none"} and {r.task_id for r in got.values()} == {"a"}
    assert got["string"].title == "} // no"
    assert got["plain"].evidence.message_ids == ["m"]


def test_reports(spark):
    frames = [("c", 1, 'ata: {"usage": {"prompt_tokens": 3, "completion_tokens": 0}}\n'), ("c", 0, "d"), ("c", 2, 'data: {"usage": {"completion_tokens": 4}}\n\ndata: junk\ndata: [DONE]'), ("d", 0, "nothing")]
    assert rows(reports.sse_usage(spark.createDataFrame(frames, "call_id string, pos int, frame string"))) == [("c", 3, 4), ("d", 0, 0)]
    parts = [("r", 0, 0, "id", "sea", "{"), ("r", 2, 0, "", "rch", "}"), ("r", 1, 0, None, None, "1"), ("r", 3, 1, "z", "", "x")]
    assert rows(reports.assemble_calls(spark.createDataFrame(parts, "reply_id string, pos int, idx int, call_id string, name string, arguments string"))) == [("r", 0, "id", "search", "{1}")]
    ledger = spark.createDataFrame([("u", "grant", 5.0), ("u", "spend", 2.0), ("v", "spend", 1.0)], "user_id string, kind string, amount double")
    assert rows(reports.wallet(ledger)) == [("u", 5.0, 2.0, 3.0), ("v", 0.0, 1.0, -1.0)]
    with pytest.raises(Exception, match="no messages"):
        reports.ingest_stats(spark.createDataFrame([], "channel_id string, ts timestamp, attachment_filenames array<string>, mentions_ticket array<string>")).collect()
    assert reports.weighted_share(ledger.where("false"), "user_id", F.col("amount"), F.lit(True)).count() == 0


def test_checks_on_tables(spark):
    df = spark.createDataFrame([(1, 5), (1, None), (2, -1)], "k int, v int")
    assert rows(validate.check_constraints(df, ["k"], {"positive": "v > 0"})) == [("positive", "2", "v > 0"), ("primary_key", "1", "2")]
    want = T.StructType([T.StructField("k", T.StringType()), T.StructField("z", T.IntegerType())])
    assert rows(validate.check_schema(df, want).select("check", "key")) == [("column_extra", "v"), ("column_missing", "z"), ("column_type", "k")]
    df.createOrReplaceTempView("layer_one")
    assert {(r.table, r.status) for r in readers.describe_layers(spark, ["layer_one", "layer_gone"]).collect()} == {("layer_one", "ok"), ("layer_gone", "missing")}


def test_silver_stream_equals_batch_and_is_idempotent(spark, tmp_path):
    schema = "message_id string, author_id string, author_name string, ts_raw string, content string, jump_url string, ordinal int"
    make = lambda *ids: [(i, "1", "a", str(T0), "hi" if i != "3" else "", "u", 0) for i in ids]
    source, out, bad, audit = (f"{tmp_path}/{n}" for n in ("in", "out", "bad", "audit"))

    def land(*ids):
        spark.createDataFrame(make(*ids), schema).coalesce(1).write.mode("append").json(source)
        stream.run_silver_stream(stream.stream_chat(spark, source, schema), out, bad, f"{tmp_path}/ck", audit)

    land("1", "2", "3", "x")
    land("2", "4")
    assert sorted(r.message_id for r in spark.read.parquet(out).collect()) == ["1", "2", "4"]
    assert sorted(r.reason for r in spark.read.parquet(bad).collect()) == ["bad_id", "empty"]
    assert [r.last_key for r in spark.read.parquet(audit).collect()] == ["4"]
    stream.run_silver_stream(stream.stream_chat(spark, source, schema), out, bad, f"{tmp_path}/ck", audit)
    assert spark.read.parquet(out).count() == 3
    shutil.rmtree(f"{out}/batch=0")  # no batch needs the rows of earlier ones to know their ids
    land("1", "3", "4", "5", "5")
    assert sorted(r.message_id for r in spark.read.parquet(out).collect()) == ["4", "5"]
    assert sorted(r.reason for r in spark.read.parquet(bad).collect()) == ["bad_id", "empty"]


def test_first_of_repeated_rows_in_a_batch_counts(spark, tmp_path):
    schema = "message_id string, author_id string, author_name string, ts_raw string, content string, jump_url string, ordinal int"
    source, out, bad = (f"{tmp_path}/{n}" for n in ("in", "out", "bad"))
    spark.createDataFrame([("7", "1", "a", str(T0), f"text {i}", "u", i) for i in (3, 1, 2)], schema).repartition(3).write.json(source)
    stream.run_silver_stream(stream.stream_chat(spark, source, schema), out, bad, f"{tmp_path}/ck")
    assert [r.content for r in spark.read.parquet(out).collect()] == ["text 1"]


def _tickets(spark, rng, n):
    t = lambda: datetime.datetime.fromtimestamp(T0 + rng.randrange(10**6))
    said = [(str(i), t(), rng.choice("ab"), "c", [f"T-{rng.randrange(40)}" for _ in range(rng.randrange(3))], [rng.randrange(12)] if rng.random() < 0.4 else []) for i in range(n)]
    done = [(f"h{i}", f"T-{rng.randrange(40)}", t(), "status", rng.choice(["Done", "Open"])) for i in range(n // 6)]
    return (spark.createDataFrame(said, "message_id string, ts timestamp, author_name string, content string, mentions_ticket array<string>, mentions_pr array<int>"),
            spark.createDataFrame(done, "id string, issue_key string, ts timestamp, field string, to_value string"))


def test_incremental_windows_equal_those_over_all(spark, tmp_path):
    """Three batches: messages, then merges of pull requests named before and a ticket that loses its window, then nothing
    new. Files of buckets without a touched ticket stay as they are, and may even be gone."""
    rng = random.Random(2)
    home = f"{tmp_path}/kept"
    said, done = _tickets(spark, rng, 150)
    issue_rows = [(f"T-{i}", f"ticket {i}", datetime.datetime.fromtimestamp(T0 + rng.randrange(10**6))) for i in range(38)]
    issues = spark.createDataFrame(issue_rows, "issue_key string, summary string, created_at timestamp")
    schema = "pr_number int, merged boolean, merged_at timestamp, merge_sha string"
    open_ = spark.createDataFrame([(i, False, None, None) for i in range(10)], schema)
    merged = spark.createDataFrame([(i, True, datetime.datetime.fromtimestamp(T0 + 10**6 + i), f"s{i}") for i in range(0, 10, 4)], schema)
    columns = ["task_id", "title", "start_ts", "end_ts", "participants", "evidence"]

    def kept():
        return rows(sinks.read_buckets(spark, f"{home}/windows").select(*columns))

    windows.incremental_windows(home, said, issues, done, open_)
    assert kept() == rows(windows.baseline_windows(said, issues, done, open_).select(*columns)) != []
    late, gone = _tickets(spark, rng, 1)[0].limit(0), done.limit(0)
    files = {p: p.stat().st_mtime_ns for p in (tmp_path / "kept" / "windows").rglob("*.parquet")}
    touched = windows.incremental_windows(home, late, issues.limit(0), gone, merged)
    now = merged.unionByName(open_.join(merged, "pr_number", "left_anti"))
    assert kept() == rows(windows.baseline_windows(said, issues, done, now).select(*columns))
    named = said.where(F.exists("mentions_pr", lambda x: x % 4 == 0)).select(F.explode("mentions_ticket").alias("t")).distinct()
    assert rows(touched) == rows(named) and 0 < touched.count() < 38
    left = [p for p in files if p.exists() and p.stat().st_mtime_ns == files[p]]
    assert left and {int(p.parent.name.split("=")[1]) for p in left}.isdisjoint(r[0] for r in touched.select(F.pmod(F.xxhash64(F.lower("issue_key")), F.lit(64))).collect())
    # one ticket alone, with every bucket of messages that isn't its own taken away
    only = issues.where("issue_key = 'T-7'").withColumn("summary", F.lit("renamed"))
    own = issues.where("issue_key = 'T-7'").select(F.pmod(F.xxhash64("issue_key"), F.lit(64))).first()[0]
    for folder in (tmp_path / "kept" / "said").glob("bucket_of_64=*"):
        if not folder.name.endswith(f"={own}"):
            shutil.rmtree(folder)
    before = kept()
    windows.incremental_windows(home, late, only, gone, merged.limit(0))
    after = kept()
    assert [r for r in after if r[0] != "t-7"] == [r for r in before if r[0] != "t-7"] and [r[1] for r in after if r[0] == "t-7"] in ([], ["renamed"])


def test_ledger_knows_contents(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a").write_text("x")
    (tmp_path / "in" / "b").write_text("x")
    for _ in range(2):
        stream.run_ledger_stream(spark, f"{tmp_path}/in", f"{tmp_path}/ledger", f"{tmp_path}/ck", "chat")
        (tmp_path / "in" / "c").write_text("y")
    assert spark.read.parquet(f"{tmp_path}/ledger").count() == 2


def test_medians_are_the_upper_ones_and_gather_nothing(spark):
    rng = random.Random(5)
    data = [(rng.choice(["a", "b", None]), rng.choice([rng.randrange(5), rng.randrange(10**6), -3]), rng.randrange(3) if rng.random() < 0.9 else None) for _ in range(900)]
    df = spark.createDataFrame(data, "g string, x int, y int")
    found = reports.upper_medians(df, ["g"], ["x", "y"])
    assert "collect_list" not in found._jdf.queryExecution().toString()
    middle = lambda v: sorted(v)[len(v) // 2]
    want = [(g, middle([x for k, x, _ in data if k == g]), middle([y for k, _, y in data if k == g and y is not None])) for g in ("a", "b", None)]
    assert rows(found) == sorted(want, key=repr)
    whole = reports.upper_medians(df, [], ["x"]).first()
    assert whole["x"] == middle([x for _, x, _ in data])


def test_long_cut_reply_is_read_in_linear_time():
    item = {"task_id": "AB-1", "title": "some \"quoted\" title, with [brackets] {and} commas", "evidence": {"message_ids": ["1", "2"]}}
    text = json.dumps({"windows": [item] * 90_000})
    assert len(text) > 10_000_000
    began = time.time()
    value = replies.parsed(text[: len(text) - 77])  # cut in the middle of the last item
    assert len(value["windows"]) in (89_999, 90_000) and value["windows"][0] == item
    assert time.time() - began < 60
    deep = "[" * 100_000 + "1," * 1000
    assert replies.parsed(deep) is None and time.time() - began < 90
    assert replies.parsed('{"a": 1, "b": [1, 2, {"c": "x, y') == {"a": 1, "b": [1, 2, {"c": "x, y"}]}
    assert replies.parsed('{"a": 1, "b"') == {"a": 1} and replies.parsed('{"a": [1, 2 3], "b": 4}') == {"a": [1]}


def test_checks_read_each_stream_once(spark, silver):
    plan = lambda df: df._jdf.queryExecution().analyzed().toString()
    data = [(str(i % 3), None if i == 1 else "a", " " if i == 2 else "x", at(i)) for i in range(5)]
    said = spark.createDataFrame(data, "message_id string, author_name string, content string, ts timestamp")
    said.createOrReplaceTempView("said_once")
    issues = spark.createDataFrame([("AB-1",), ("nope",)], "issue_key string")
    commits = spark.createDataFrame([("z",)], "sha string")
    bad = spark.createDataFrame([("t", "k", "")], "target_table string, entity_key string, reason string")
    found = validate.check_silver(spark.table("said_once"), issues, commits, bad, "2026-01-01", "2026-01-01 00:03:00")
    assert plan(found).count("SubqueryAlias said_once") == 1
    names = [r[0] for r in rows(found)]
    assert sorted(names) == ["issue_key_shape", "message_blank", "message_outside_range", "message_repeats", "message_repeats", "message_without_author", "quarantine_without_reason", "sha_shape"]


def test_sets_of_keys(spark):
    rng = random.Random(8)
    sets = [[(rng.choice([None, 1, 2, 3, 4, 5]), rng.choice([None, "a", "b"]), i) for i in range(n)] for n in (14, 9, 0, 11)]
    frames = [spark.createDataFrame(s, "k int, name string, held int").drop(*([] if i else ["held"])) for i, s in enumerate(sets)]
    plain = [{r[:2] for r in s} for s in sets]
    some = [0, 1, 3]
    for use in (some, [0, 1, 2, 3], [2, 0], [1]):
        held, has = [plain[i] for i in use], [frames[i].repartition(3) for i in use]
        assert rows(links.in_any(has, "k", "name")) == sorted(set.union(*held), key=repr)
        assert rows(links.in_all(has, "k", "name")) == sorted(set.intersection(*held), key=repr)
        assert rows(links.in_first_only(has, "k", "name")) == sorted(held[0].difference(*held[1:]), key=repr)
        want = [(*k, sum(1 << i for i, s in enumerate(held) if k in s)) for k in set.union(*held)]
        assert rows(links.membership(has, "k", "name")) == sorted(want, key=repr)
    assert links.membership([frames[0].limit(1)] * 62, "k").first().held == (1 << 62) - 1
    for wrong in ([], [frames[0]] * 63):
        with pytest.raises(ValueError):
            links.membership(wrong, "k")


def test_snapshots_are_compared_by_buckets(spark):
    rng = random.Random(4)
    schema = "a string, b string, body string, change string"
    before = [(str(i % 50), str(i), f"body {i}", "x") for i in range(2000)] + [(None, "n", "one", "x"), ("n", None, "two", "x"), (None, None, None, "x"), ("r", "r", "p", "x"), ("r", "r", "q", "x")]
    after = [r if rng.random() > 0.01 else (*r[:2], "other", "x") for r in before if r[1] not in ("7", "8")]
    after = [(x, y, "two" if (x, y) == (None, "n") else "one" if (x, y) == ("n", None) else body, z) for x, y, body, z in after]  # contents that change places
    after += [("new", "new", None, "x"), ("r", "r", "q", "x")]
    rng.shuffle(after)

    def plain(old, new):
        held = [defaultdict(Counter), defaultdict(Counter)]
        for side, data in zip(held, (old, new), strict=True):
            for x, y, body, _ in data:
                side[x, y][body] += 1
        for key in {*held[0], *held[1]}:
            if held[0][key] != held[1][key]:
                yield (*key, "changed" if held[0][key] and held[1][key] else "new" if held[1][key] else "deleted")

    make = lambda data: spark.createDataFrame(data, schema)
    got = lambda old, new: sorted(map(tuple, links.snapshot_diff(make(old), make(new), ["a", "b"], "body").collect()), key=repr)
    for old, new in ((before, after), (after, before), (before, before), ([], after), (before, []), ([], [])):
        assert got(old, new) == sorted(plain(old, new), key=repr)
    sides = links._both_sides(make(before), make(after), ["a", "b"], "body")
    assert links.changed_buckets(sides, ["a", "b"]).count() <= len(got(before, after)) < 50
    same = links._both_sides(make(before), make(before[::-1]).repartition(7), ["a", "b"], "body")
    assert links.changed_buckets(same, ["a", "b"]).count() == 0
