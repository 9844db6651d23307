import json
import re

from pyspark.sql import functions as F

from tidemark.functions import scalars as S
from tidemark.operators import clean
from tidemark.sources import readers, sinks


def one(spark, value, column, kind="string"):
    return spark.createDataFrame([(value,)], f"c {kind}").select(column(F.col("c")).alias("r")).first()["r"]


def stamp(spark, value, **options):
    r = one(spark, value, lambda c: F.struct(F.unix_seconds(S.parse_ts(c, **options)["ts"]).alias("s"), S.parse_ts(c, **options)["note"].alias("n")))
    return r["s"], r["n"]


def test_stamps_of_every_kind(spark):
    cases = {
        "1767225600": (1767225600, None), "2026-01-01T00:00:00Z": (1767225600, None), "2025-12-31T18:00:00-06:00": (1767225600, None),
        "2025-12-31T18:00:00-0600": (1767225600, None), "2026-01-01T00:00:00": (1767225600, "repaired_naive"), "2026-01-01": (1767225600, "repaired_naive"),
        "": (None, "missing"), None: (None, "missing"), "junk": (None, "unparseable"), "2026-07": (None, "unparseable"), "T10:00": (None, "unparseable"),
        "123456789012345678": (None, "unparseable"), "2026-13-45T00:00:00Z": (None, "unparseable"),
    }
    for value, want in cases.items():
        assert stamp(spark, value) == want, value
    assert stamp(spark, "2026-01-01T00:00:00", strict=True) == (None, "naive")
    assert stamp(spark, "2031-01-01T00:00:00Z", max_year=2027) == (None, "future_timestamp")


def test_texts(spark):
    assert one(spark, "a\x00b &amp; c   d\r\n\n\n\n\ne\t ", S.clean_text) == "ab c d\r\n\ne"
    assert one(spark, "ﬁ  x", lambda c: S.clean_text(c, normalise=True)) == "fi x"
    assert one(spark, "abcdef", lambda c: S.clip(c, 4)) == "abc…"
    assert one(spark, "see AB-12, AB-3 and AB-12; PR #7", lambda c: S.extract_all(c, S.TICKET)) == ["AB-12", "AB-3"]
    assert one(spark, "PR #12 and pull request #3", lambda c: S.extract_all(c, S.PULL_REQUEST, 1, cast="int")) == [3, 12]
    assert one(spark, None, lambda c: S.extract_all(c, S.TICKET)) == []
    assert one(spark, "git@h.example:own/repo.git", S.repo_parts).asDict() == {"owner": "own", "repo": "repo"}
    assert one(spark, "nothing", S.repo_parts) is None
    assert one(spark, "rm -rf /", S.unsafe_command) and not one(spark, "ls", S.unsafe_command)
    r = one(spark, "{bad", lambda c: S.parse_json(c, "a int"))
    assert r["value"] is None and r["unparsed"] == "{bad"


def message(id, **more):
    return {"message_id": id, "author_id": "1", "author_name": "ann", "ts_raw": "1767225600", "content": "AB-1 done in PR #2", "jump_url": "u", "source_file": "f", "ordinal": 0, **more}


SCHEMA = "message_id string, author_id string, author_name string, ts_raw string, content string, jump_url string, source_file string, ordinal int"


def test_messages_are_kept_quarantined_or_repeats(spark):
    rows = [
        message("1"), message("1", content="later copy", ordinal=1), message("x2"), message(None), message("3", author_id=None, jump_url=None, content=" "),
        message("4", content="\x00 "), message("5", ts_raw="2026-07"), message("6", ts_raw="2026-01-01T00:00:00"), message("7", author_name=""),
    ]
    good, bad = clean.clean_messages(spark.createDataFrame([tuple(r.values()) for r in rows], SCHEMA))
    kept = {r.message_id: r for r in good.collect()}
    assert set(kept) == {"1", "6", "7"} and kept["1"].content == "AB-1 done in PR #2"
    assert kept["1"].mentions_ticket == ["AB-1"] and kept["1"].mentions_pr == [2]
    assert kept["6"].timestamp_repaired and kept["7"].author_name == "unknown"
    reasons = sorted(r.reason for r in bad.collect())
    assert reasons == ["bad_id", "bad_id", "empty", "timestamp:unparseable", "tombstone"]
    assert len(kept) + len(reasons) + 1 == len(rows)
    assert [tuple(r) for r in clean.rule_counts(bad).limit(1).collect()] == [("bad_id", 2)]


def test_archives_of_three_shapes(spark, tmp_path):
    doc = {"channel": {"id": "9", "name": "general"}, "messages": [
        {"message_id": "1", "author": {"id": "a", "name": "Ann"}, "timestamp": "2026-01-01T00:00:00Z", "content": "x", "attachments": [{"original_filename": "f.log", "size": 3}]},
        {"ID": "2", "author": "Bob", "Timestamp": "2026-01-01T00:00:01Z", "Content": "y"}, {"author": "nobody"},
    ]}
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.json").write_text(json.dumps(doc))
    (tmp_path / "in" / "b.json").write_text('{"other": 1}')
    got = {r.message_id: r for r in readers.normalize_chat(readers.read_chat_archives(spark, str(tmp_path / "in"))).collect()}
    assert set(got) == {"1", "2"}
    assert got["1"].author_id == "a" and got["2"].author_name == "Bob" and got["2"].content == "y"
    assert got["1"].attachments[0]["original_filename"] == "f.log" and got["2"].attachments == []
    assert readers.scan_archive(spark, str(tmp_path / "in")).first()["messages"] == 3


def test_zip_members(spark, tmp_path):
    import zipfile

    with zipfile.ZipFile(tmp_path / "z.zip", "w") as z:
        z.writestr("a.json", json.dumps({"channel": {"id": "1"}, "messages": [{"id": "5", "author": "x"}]}))
        z.writestr("bad.json", "{")
        z.writestr("note.txt", "no")
    whole = (tmp_path / "z.zip").read_bytes()
    (tmp_path / "more").mkdir()
    (tmp_path / "more" / "short.zip").write_bytes(whole[:-30])  # no table of contents, so a file that isn't JSON
    (tmp_path / "more" / "spoilt.zip").write_bytes(whole.replace(b'"author"', b'"AUTHOR"'))  # its checksum is wrong
    (tmp_path / "more" / "plain.json").write_text('{"messages": []}')
    found = {r.source_file.rsplit("/", 1)[1]: r.error for r in readers.read_zip_json(spark, str(tmp_path / "more"), partitions=3).collect()}
    assert {k for k, v in found.items() if v is None} == {"plain.json"} and set(found) == {"plain.json", "short.zip", "spoilt.zip!a.json", "spoilt.zip!bad.json"}
    assert "CRC" in found["spoilt.zip!a.json"]
    with zipfile.ZipFile(tmp_path / "more" / "many.zip", "w") as z:
        for i in range(40):
            z.writestr(f"m{i}.json", "{}")
    many = readers.read_zip_json(spark, str(tmp_path / "more" / "many.zip"), partitions=8)
    assert many.select(F.spark_partition_id()).distinct().count() > 4  # one archive is the work of several tasks
    docs = readers.read_zip_json(spark, str(tmp_path / "z.zip"))
    assert docs.where("error IS NOT NULL").count() == 1
    assert [r.message_id for r in readers.normalize_chat(readers.zip_messages(docs)).collect()] == ["5"]


def test_issues_changelog_and_git(spark, tmp_path):
    history = lambda i, at, items: {"id": i, "author": {"displayName": "A"}, "created": at, "items": items}
    item = {"field": "status", "fromString": "Open", "toString": "Done"}
    issue = lambda key, updated, **f: {"key": key, "fields": {"summary": "s", "created": "2026-01-01T00:00:00Z", "updated": updated, **f}, "changelog": {"histories": [history("1", "2026-01-02T00:00:00Z", [item, item]), history("2", "2026-01-03 00:00:00", [item]), history("3", "2026-01-04T00:00:00Z", [])]}}
    (tmp_path / "i.json").write_text(json.dumps([issue("AB-1", "2026-01-02T00:00:00Z"), issue("AB-1", "2026-02-02T00:00:00Z", summary="new"), issue(None, "2026-01-02T00:00:00Z")]))
    raw = readers.read_issues(spark, str(tmp_path / "i.json"))
    good, bad = clean.clean_issues(raw)
    assert [(r.issue_key, r.summary) for r in good.collect()] == [("AB-1", "new")] and bad.count() == 1
    assert clean.clean_issues(raw, mode="by_update")[0].count() == 2
    histories = readers.issue_histories(raw.where("key = 'AB-1'").limit(1))
    events, no_items = clean.flatten_changelog(histories)
    assert [r.id for r in events.orderBy("id").collect()] == ["AB-1:000001", "AB-1:000002", "AB-1:000003"]
    assert [r.reason for r in no_items.collect()] == ["no_items"]
    fixed = clean.recover_naive_ts(histories.select("issue_key", "position", "history.created"), good)
    assert [r.recovered for r in fixed.orderBy("position").collect()] == [False, True, False]
    sha = "a" * 40
    commit = {"sha": sha, "commit": {"author": {"name": "A", "date": "2026-01-01T00:00:00Z"}, "message": "Merge x"}, "parents": [], "files": [{"filename": "b"}, {"filename": "a"}, {"filename": "a"}]}
    (tmp_path / "c.json").write_text(json.dumps([commit, {**commit, "sha": "zz"}, {**commit, "sha": "b" * 40, "commit": {"author": None}}]))
    commits, bad = clean.clean_commits(readers.read_commits(spark, str(tmp_path / "c.json")))
    got = commits.first()
    assert got.is_merge and got.changed_files == ["a", "b"] and got.committed_at == got.authored_at
    assert sorted(r.reason for r in bad.collect()) == ["bad_sha", "timestamp:missing"]
    assert readers.commit_files(readers.read_commits(spark, str(tmp_path / "c.json")).where(F.col("sha") == sha)).count() == 2
    pull = {"number": 3, "state": "Closed", "title": "t", "created_at": "2026-01-01T00:00:00Z", "merged_at": "2026-01-02T00:00:00Z", "merged": True}
    (tmp_path / "p.json").write_text(json.dumps([pull, {**pull, "number": 4, "merged_at": None}, {**pull, "number": "x"}]))
    pulls, bad = clean.clean_pulls(readers.read_pulls(spark, str(tmp_path / "p.json")))
    assert [(r.pr_number, r.state) for r in pulls.collect()] == [(3, "closed")]
    assert sorted(r.reason for r in bad.collect()) == ["bad_number", "merged_without_time"]


def test_documents(spark, tmp_path):
    (tmp_path / "d").mkdir()
    (tmp_path / "d" / "a.log").write_text("hello")
    listing = readers.read_documents(spark, str(tmp_path / "d"))
    path = listing.first()["path"]
    rows = spark.createDataFrame([(path, 5), (path + "x", 5), (path, 9)], "path string, bytes bigint")
    kept, bad = clean.verify_documents(rows, listing)
    assert sorted(r.size_ok for r in kept.collect()) == [False, False, True]
    assert sorted(r.reason.split()[0] for r in bad.collect()) == ["file_missing", "size_differs"]
    both = clean.unify_documents(rows.limit(1), rows.limit(1))
    assert [r.source for r in both.collect()] == ["ticket"]
    text = readers.read_documents(spark, str(tmp_path / "d"), inline=True).select(S.preview(F.col("content"), F.col("filename")).alias("t")).first()["t"]
    assert text == "hello"


def test_upsert_changes_only_what_is_listed(spark, tmp_path):
    path = f"{tmp_path}/t"
    make = lambda *rows: spark.createDataFrame(rows, "k bigint, a string, b string")
    sinks.upsert(spark, path, make((1, "a", "b"), (2, "c", "d"), (None, "n", "n")), ["k"])
    sinks.upsert(spark, path, make((1, "A", "B"), (3, "e", "f"), (None, "N", "N")), ["k"], ["a"])
    got = {r.k: (r.a, r.b) for r in spark.read.parquet(path).collect()}
    assert got == {1: ("A", "b"), 2: ("c", "d"), 3: ("e", "f"), None: ("N", "n")}
    plan = sinks.read_buckets(spark, path, spark.createDataFrame([(3,)], "k int"))._jdf.queryExecution().toString()
    assert re.search(r"PartitionFilters: \[[^\]]*bucket_of_64#\d+ (IN|=)", plan)  # and nothing else is read
    assert [r.a for r in sinks.read_buckets(spark, path, spark.createDataFrame([(3,)], "k int")).collect()] == ["e"]  # an int finds a bigint
    files = set((tmp_path / "t").rglob("*.parquet"))
    sinks.upsert(spark, path, make((3, "E", "F")).withColumn("k", F.col("k").cast("int")), ["k"])
    assert sinks.read_buckets(spark, path).count() == 4 and len(files - set((tmp_path / "t").rglob("*.parquet"))) == 1
    sinks.replace(spark, path, make((3, "", ""), (9, "", "")).select("k"), make((9, "i", "j")))
    assert sorted((str(r.k), r.a) for r in sinks.read_buckets(spark, path).collect()) == [("1", "A"), ("2", "c"), ("9", "i"), ("None", "N")]
    sinks.replace(spark, path, make((9, "", "")).select("k"), make((9, "", "")).limit(0))
    assert sinks.delete_where(spark.read.parquet(path), make((1, "", ""), (None, "", "")), ["k"]).count() == 1


def test_batch_id_is_one_for_one_set_of_files(spark):
    rows = [(f"p{i}", f"s{i % 7}") for i in range(500)]
    schema = "path string, sha256 string"
    one = S.batch_id(spark.createDataFrame(rows, schema), "bronze", "v1").first()[0]
    again = S.batch_id(spark.createDataFrame(rows[::-1] + rows[:30], schema).repartition(7), "bronze", "v1").first()[0]
    assert one == again and len(one) == 64
    other = spark.createDataFrame([*rows[:-1], ("p499", "x")], schema)
    assert S.batch_id(other, "bronze", "v1").first()[0] != one
    changed = S.bucket_digests(other).exceptAll(S.bucket_digests(spark.createDataFrame(rows, schema)))
    assert changed.count() == 1  # the one bucket that needs a look
    empty = S.batch_id(spark.createDataFrame([], schema), "bronze", "v1").first()[0]
    assert empty and empty != one


def test_nfkc_is_that_of_unicodedata(spark):
    import unicodedata

    whole = [chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    said = ["".join(f"a{c}\u0301" for c in whole[i : i + 2000]) for i in range(0, len(whole), 2000)]
    got = spark.createDataFrame([(i, t) for i, t in enumerate(said)], "i int, t string").select("i", S.nfkc(F.col("t")).alias("t")).collect()
    assert {r.i: r.t for r in got} == {i: unicodedata.normalize("NFKC", t) for i, t in enumerate(said)}


def test_dataset_and_slice_sinks(spark, tmp_path):
    df = spark.createDataFrame([("t1", "messages", "{}"), ("t1", "pulls", "{}"), ("t2", "messages", "{}")], "task_id string, source_table string, row string")
    sinks.write_task_slices(df, f"{tmp_path}/s")
    assert spark.read.json(f"{tmp_path}/s").count() == 3 and (tmp_path / "s" / "task_id=t1" / "source_table=pulls").is_dir()
    manifest = sinks.write_dataset(df.withColumn("split", F.lit("train")), f"{tmp_path}/d").collect()
    assert [(r.split, r.examples) for r in manifest] == [("train", 3)]
    sinks.rebuild(df, f"{tmp_path}/r", ["task_id"])
    sinks.rebuild(df.where("task_id = 't2'"), f"{tmp_path}/r", ["task_id"], only_touched=True)
    assert spark.read.parquet(f"{tmp_path}/r").count() == 3
    (tmp_path / "l.jsonl").write_text('{"a": 1}\n\n{"a": 2}\nbad\n')
    lax = readers.read_jsonl(spark, f"{tmp_path}/l.jsonl", "a int", strict=False).cache()
    assert lax.where("_bad_line IS NULL").count() == 2
