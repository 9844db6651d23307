"""Exports landed in the shared folder, made of the driver's tables, and read back by every reader, batch or stream."""

from __future__ import annotations

import zipfile

import pandas as pd
import pyarrow as pa
import pyarrow.fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions import scalars as S
from tidemark.operators import clean
from tidemark.plans.report_queries import _shared
from tidemark.plans.tables import SILVER_SQL, Registry, changelog, events, issues, messages, pulls, table
from tidemark.sources import readers, sinks
from tidemark.streaming import stream

query = Registry()


#: Records of a table that make up a task's share of an export, about. Shares stay that large however many records there are.
RECORDS = 250_000


def _tasks(records: DataFrame) -> int:
    """Over how many tasks an export of these records is dealt: all cores, or more where shares would be too large."""
    return max(records.sparkSession.sparkContext.defaultParallelism, -(-records.count() // RECORDS))


def _landed(spark, rows: DataFrame, tasks: int, shard: F.Column, order: str, *docs: F.Column) -> str:
    """A folder with a JSON file for each shard, which holds its rows' docs as an array. Rows are dealt out as they are, over so
    many tasks, and become text where it is written."""
    path = f"{_shared(spark)}/landed"
    line = F.to_json(docs[0]) if len(docs) == 1 else F.explode(F.array(*map(F.to_json, docs)))
    sinks.write_texts(rows.withColumn("shard", shard), path, ["shard"], [order], line, ("[", ",\n", "]\n"), tasks=tasks)
    return path


def _archives(spark, sf_dir) -> str:
    """A channel a user, with its events as messages; every third exporter writes other names."""

    def message(e):
        other, epoch, id = e["event_id"] % 3 == 0, F.unix_seconds(e["ts"]).cast("string"), e["event_id"].cast("string")
        author = F.struct(e["user_id"].cast("string").alias("id"), e["event_type"].alias("name"))
        return F.struct(
            F.when(~other, id).alias("id"), F.when(other, id).alias("message_id"), F.when(~other, epoch).alias("timestamp"),
            F.when(other, epoch).alias("ts"), e["props"].alias("content"), F.when(~other, author).alias("author"),
        )

    own = F.struct("event_id", "ts", "user_id", "event_type", "props")
    e = events(spark, sf_dir)
    tasks = _tasks(e)
    per = e.repartition(tasks, "user_id").groupBy("user_id").agg(F.array_sort(F.collect_list(own)).alias("said"))
    channel = F.struct(F.col("user_id").cast("string").alias("id"), F.lit("c").alias("name"))
    doc = F.struct(channel.alias("channel"), F.struct(F.lit("g").alias("id")).alias("guild"), F.transform("said", message).alias("messages"))
    return _landed(spark, per, tasks, F.floor(F.col("user_id") / 50), "user_id", doc)


@query("""SELECT CAST(event_id AS VARCHAR) AS message_id, CAST(user_id AS VARCHAR) AS channel_id, CAST(row_number() OVER (PARTITION BY user_id ORDER BY event_id) - 1 AS INTEGER) AS ordinal,
  CASE WHEN event_id % 3 <> 0 THEN event_type END AS author_name, props AS content, CAST(floor(epoch(ts)) AS BIGINT) AS secs FROM events""")
def chat_archives_read(spark, sf_dir):
    said = readers.normalize_chat(readers.read_chat_archives(spark, _archives(spark, sf_dir)))
    return said.select("message_id", "channel_id", "ordinal", "author_name", "content", F.col("ts_epoch").cast("bigint").alias("secs"))


@query("""SELECT count(DISTINCT user_id) AS channels, count(*) AS messages, count(DISTINCT user_id // 50) AS files FROM events""")
def archive_scanned(spark, sf_dir):
    return readers.scan_archive(spark, _archives(spark, sf_dir)).select("channels", F.col("messages").cast("bigint").alias("messages"), "files")


def _issue_files(spark, sf_dir) -> str:
    """An issue an order, saved twice with another update, and a history a line."""

    def history(line):
        item = F.array(F.struct(F.lit("status").alias("field"), F.lit("a").alias("fromString"), line["l_returnflag"].alias("toString")))
        return F.struct(line["l_linenumber"].cast("string").alias("id"), F.struct(F.lit("ann").alias("displayName")).alias("author"), F.lit("2026-01-01T00:00:00Z").alias("created"), item.alias("items"))

    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_returnflag")
    tasks = _tasks(lines)
    per = lines.repartition(tasks, "l_orderkey").groupBy("l_orderkey").agg(F.array_sort(F.collect_list(F.struct("l_linenumber", "l_returnflag"))).alias("x"))
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderpriority", "o_orderstatus").repartition(tasks, "o_orderkey")
    both = orders.join(per, F.col("o_orderkey") == F.col("l_orderkey"))

    def doc(save):
        fields = F.struct(
            F.col("o_orderpriority").alias("summary"), F.struct(F.col("o_orderstatus").alias("name")).alias("status"), F.lit("2026-01-01T00:00:00Z").alias("created"),
            F.lit(f"2026-01-0{save}T00:00:00Z").alias("updated"),
        )
        changelog = F.when(F.lit(save == 1), F.struct(F.transform("x", history).alias("histories")))
        return F.struct(F.col("o_orderkey").cast("string").alias("id"), F.concat(F.lit("ORD-"), F.col("o_orderkey").cast("string")).alias("key"), fields.alias("fields"), changelog.alias("changelog"))

    return _landed(spark, both, tasks, F.floor(F.col("o_orderkey") / 500), "o_orderkey", doc(1), doc(2))


@query("""SELECT 'ORD-' || o_orderkey AS issue_key, o_orderstatus AS status, o_orderpriority AS summary, d AS day FROM orders, (SELECT unnest([1, 2]) AS d) WHERE o_orderkey IN (SELECT l_orderkey FROM lineitem)""")
def issues_resaved(spark, sf_dir):
    good, _ = clean.clean_issues(readers.read_issues(spark, _issue_files(spark, sf_dir)), mode="by_update")
    return good.select("issue_key", "status", "summary", F.day("updated_at").alias("day"))


@query("""SELECT 'ORD-' || l_orderkey || ':' || l_linenumber AS history_key, 'ORD-' || l_orderkey AS issue_key, CAST(row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber) - 1 AS INTEGER) AS position FROM lineitem
WHERE l_orderkey IN (SELECT o_orderkey FROM orders)""")
def issue_histories_read(spark, sf_dir):
    return readers.issue_histories(readers.read_issues(spark, _issue_files(spark, sf_dir))).select("history_key", "issue_key", "position")


@query("""SELECT sha1(CAST(p_partkey AS VARCHAR)) AS sha, p_brand AS author_name, CAST(p_partkey AS VARCHAR) AS authored_raw, p_name AS message, [sha1(CAST(p_partkey // 2 AS VARCHAR))] AS parent_shas, p_size AS additions FROM part""")
def commits_read(spark, sf_dir):
    p = table(spark, sf_dir, "part")
    author = F.struct(F.col("p_brand").alias("name"), F.lit("a@x").alias("email"), F.col("p_partkey").cast("string").alias("date"))
    parent = F.struct(F.sha1(F.floor(F.col("p_partkey") / 2).cast("string")).alias("sha"))
    doc = F.struct(
        F.sha1(F.col("p_partkey").cast("string")).alias("sha"), F.struct(author.alias("author"), F.col("p_name").alias("message")).alias("commit"), F.array(parent).alias("parents"),
        F.struct(F.col("p_size").alias("additions")).alias("stats"),
    )
    found = readers.read_commits(spark, _landed(spark, p, _tasks(p), F.floor(F.col("p_partkey") / 100), "p_partkey", doc))
    return found.select("sha", "author_name", "authored_raw", "message", "parent_shas", "stats.additions")


@query("""SELECT CAST(o_orderkey AS BIGINT) AS pr_number, o_orderpriority AS title, o_orderstatus = 'F' AS merged, 'c' || o_custkey AS author FROM orders""")
def pulls_read(spark, sf_dir):
    doc = F.struct(
        F.col("o_orderkey").cast("string").alias("number"), F.col("o_orderpriority").alias("title"), (F.col("o_orderstatus") == "F").alias("merged"),
        F.struct(F.concat(F.lit("c"), F.col("o_custkey").cast("string")).alias("login")).alias("user"),
    )
    o = table(spark, sf_dir, "orders")
    found = readers.read_pulls(spark, _landed(spark, o, _tasks(o), F.floor(F.col("o_orderkey") / 500), "o_orderkey", doc))
    return found.select("pr_number", "title", "merged", F.col("user.login").alias("author"))


@query("""SELECT 'pull|' || event_type || '|' || event_id || '|' || CAST(floor(epoch(ts)) AS BIGINT) AS event_key, event_type AS action FROM events""")
def pr_events_read(spark, sf_dir):
    e = events(spark, sf_dir)
    doc = F.struct(F.lit("pull").alias("type"), F.col("event_type").alias("action"), F.col("event_id").alias("number"), F.unix_seconds("ts").cast("string").alias("created_at"))
    return readers.read_pr_events(spark, _landed(spark, e, _tasks(e), F.floor(F.col("event_id") / 500), "event_id", doc)).select("event_key", "action")


def _customer_files(spark, sf_dir) -> str:
    """A text file a nation, with its customers' numbers, in a folder of its own."""
    path = f"{_shared(spark)}/texts"
    per = table(spark, sf_dir, "customer").groupBy(F.col("c_nationkey").alias("nation")).agg(F.array_join(F.transform(F.array_sort(F.collect_list("c_custkey")), lambda x: x.cast("string")), ",").alias("value"))
    per.write.partitionBy("nation").text(path)
    return path


_FILES_SQL = """f AS (SELECT c_nationkey AS nation, string_agg(CAST(c_custkey AS VARCHAR), ',' ORDER BY c_custkey) || chr(10) AS t FROM customer GROUP BY 1)"""


@query(f"""WITH {_FILES_SQL} SELECT 'nation=' || nation AS stream, strlen(t) AS bytes, sha256(t) AS sha256, substr(t, 1, 4000) AS shown FROM f""")
def documents_read(spark, sf_dir):
    found = readers.read_documents(spark, _customer_files(spark, sf_dir), inline=True)
    return found.select("stream", "bytes", "sha256", S.preview(F.col("content"), F.col("filename")).alias("shown"))


@query("""SELECT 'commits' AS stream, sha1(CAST(p_partkey AS VARCHAR)) AS external_id, CAST(p_partkey AS BIGINT) AS secs FROM part UNION ALL SELECT 'pulls', CAST(o_orderkey AS VARCHAR), CAST(floor(epoch(o_orderdate)) AS BIGINT) FROM orders""")
def rest_pages_read(spark, sf_dir):
    p, o = table(spark, sf_dir, "part"), table(spark, sf_dir, "orders")
    author = F.struct(F.col("p_brand").alias("name"), F.col("p_partkey").cast("string").alias("date"))
    commits = p.select(F.sha1(F.col("p_partkey").cast("string")).alias("sha"), F.struct(author.alias("author"), F.col("p_name").alias("message")).alias("commit"), F.array(F.struct(F.col("p_brand").alias("filename"))).alias("files"))
    secs, done = F.unix_seconds(F.col("o_orderdate").cast("timestamp")).cast("string"), F.col("o_orderstatus") == "F"
    pulls = o.select(
        F.col("o_orderkey").alias("number"), F.lit("t").alias("title"), F.lit("Open").alias("state"), F.when(done, secs).alias("merged_at"), F.lit("").alias("closed_at"),
        F.when(~done, secs).alias("created_at"), F.col("o_orderpriority").alias("body"),
    )
    return readers.from_rest_pages(commits, pulls).select("stream", "external_id", F.col("ts").cast("bigint").alias("secs"))


@query("""SELECT 'layer_orders' AS "table", c AS "column", (SELECT count(*) FROM orders) AS rows, 'ok' AS status FROM (SELECT unnest(['o_orderkey', 'o_custkey']) AS c) UNION ALL SELECT 'layer_gone', NULL, 0, 'missing'""")
def layers_described(spark, sf_dir):
    table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey").createOrReplaceTempView("layer_orders")
    return readers.describe_layers(spark, ["layer_orders", "layer_gone"]).select("table", "column", "rows", "status")


@query("""SELECT o_orderkey, o_custkey, o_orderstatus FROM orders""")
def tables_read(spark, sf_dir):
    path = _shared(spark)
    table(spark, sf_dir, "orders").write.parquet(f"{path}/orders")
    return readers.read_table(spark, path, "orders").select("o_orderkey", "o_custkey", "o_orderstatus")


def _zips(spark, sf_dir) -> str:
    """A zip for fifty users, with a JSON member for each one and his events; every seventh member is cut short."""
    path = f"{_shared(spark)}/zips"
    message = F.struct(F.col("event_id").cast("string").alias("id"), F.unix_seconds("ts").cast("string").alias("timestamp"), F.col("props").alias("content"))
    per = events(spark, sf_dir).groupBy("user_id").agg(F.array_sort(F.collect_list(message)).alias("messages"))
    doc = F.to_json(F.struct(F.struct(F.col("user_id").cast("string").alias("id")).alias("channel"), "messages"))
    docs = per.select(F.floor(F.col("user_id") / 50).alias("shard"), "user_id", F.when(F.col("user_id") % 7 == 3, F.substring(doc, 1, 30)).otherwise(doc).alias("doc"))

    def pack(key, rows):
        store, base = pa.fs.FileSystem.from_uri(path)
        store.create_dir(base)
        with store.open_output_stream(f"{base}/{key[0]}.zip") as out, zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as held:
            held.writestr("notes.txt", "no JSON")
            for user, doc in zip(rows["user_id"], rows["doc"], strict=True):
                held.writestr(f"u{user}.json", doc)
        return pd.DataFrame({"n": [len(rows)]})

    docs.groupBy("shard").applyInPandas(pack, "n bigint").agg(F.sum("n")).collect()
    return path


@query("""SELECT 'u' || user_id || '.json' AS member, user_id % 7 = 3 AS broken, CAST(sum(CASE WHEN user_id % 7 = 3 THEN 0 ELSE 1 END) AS BIGINT) AS messages FROM events GROUP BY 1, 2""")
def zips_read(spark, sf_dir):
    docs = readers.read_zip_json(spark, _zips(spark, sf_dir))
    member = F.element_at(F.split("source_file", "!"), -1).alias("member")
    n = readers.zip_messages(docs).groupBy(member).agg(F.count(F.lit(1)).alias("n"))
    return docs.select(member, F.col("error").isNotNull().alias("broken")).join(n, "member", "left").select("member", "broken", F.coalesce("n", F.lit(0)).alias("messages"))


# incremental forms


@query("""SELECT CAST(event_id AS VARCHAR) AS message_id, CAST(floor(epoch(ts)) AS BIGINT) AS secs FROM events WHERE floor(epoch(ts)) > epoch(TIMESTAMP '2024-01-15 00:00:00')""")
def stream_chat_from(spark, sf_dir):
    base = _shared(spark)
    rows = events(spark, sf_dir).select(F.col("event_id").cast("string").alias("message_id"), F.unix_seconds("ts").cast("string").alias("ts_raw"))
    rows.write.json(f"{base}/in")
    chat = stream.stream_chat(spark, f"{base}/in", "message_id string, ts_raw string", "2024-01-15 00:00:00")
    chat.writeStream.format("parquet").option("path", f"{base}/out").option("checkpointLocation", f"{base}/checkpoint").trigger(availableNow=True).start().awaitTermination()
    return spark.read.parquet(f"{base}/out").select("message_id", F.unix_seconds("event_ts").alias("secs"))


@query(f"""WITH {_FILES_SQL} SELECT 'texts' AS stream, sha256(t) AS sha256, strlen(t) AS bytes FROM f""")
def stream_ledger(spark, sf_dir):
    base, files = _shared(spark), _customer_files(spark, sf_dir)
    for _ in range(2):  # what is known is not entered again
        stream.run_ledger_stream(spark, files, f"{base}/ledger", f"{base}/checkpoint", "texts")
    return sinks.read_buckets(spark, f"{base}/ledger").select("stream", "sha256", "bytes")


@query("""SELECT event_id FROM events WHERE user_id NOT IN (SELECT user_id FROM events WHERE event_type = 'signup' AND ts < TIMESTAMP '2024-01-04 00:00:00')""")
def sources_unseen(spark, sf_dir):
    e = events(spark, sf_dir)
    seen = e.where("event_type = 'signup' AND ts < TIMESTAMP '2024-01-04 00:00:00'").select("user_id")
    return stream.unseen_sources(e, seen, "user_id").select("event_id")


@query("""SELECT DISTINCT 'USR-' || user_id AS issue_key FROM events WHERE ts > (SELECT max(ts) FROM events WHERE event_type = 'signup') - INTERVAL 2 DAY""")
def tickets_touched(spark, sf_dir):
    e = events(spark, sf_dir).where("event_type = 'signup'").agg((F.max("ts") - F.expr("INTERVAL 2 DAYS")).alias("last_ts"))
    return stream.touched_tickets(messages(spark, sf_dir), e.withColumn("stream", F.lit("messages")))


@query(f"""WITH {SILVER_SQL} SELECT b.task_id, CAST(epoch_us(start_ts) AS BIGINT) AS start_us, CAST(epoch_us(end_ts) AS BIGINT) AS end_us,
  (SELECT count(*) FROM messages m WHERE m.ticket = b.issue_key AND m.ts BETWEEN start_ts AND end_ts) AS cited, coalesce(n_prs, 0) AS prs FROM baseline b""")
def windows_rerun(spark, sf_dir):
    """The windows after two scheduled runs: the second one has the later half of the messages and changes, all issues anew,
    and the merges, of which the first one knew none, of pull requests that were named before."""
    base = _shared(spark)
    m, i, e, p = messages(spark, sf_dir), issues(spark, sf_dir), changelog(spark, sf_dir), pulls(spark, sf_dir)
    late = F.col("ts") >= F.lit("2024-01-15 00:00:00").cast("timestamp")
    open_ = p.withColumns({"merged": F.lit(False), "merged_at": F.lit(None).cast("timestamp"), "merge_sha": F.lit(None).cast("string")})
    first = {"messages": m.where(~late), "issues": i.where("issue_key NOT LIKE '%5'").withColumn("summary", F.lit("new")), "events": e.where(~late), "pulls": open_}
    second = {"messages": m.where(late), "issues": i, "events": e.where(late), "pulls": p}
    for landed in (first, second):
        for name, df in landed.items():
            df.write.mode("append").parquet(f"{base}/in/{name}")
        taken = [stream.stream_files(spark, f"{base}/in/{name}", df.schema) for name, df in landed.items()]
        stream.run_windows_stream(f"{base}/kept", f"{base}/checkpoint", *taken)
    b = sinks.read_buckets(spark, f"{base}/kept/windows")
    return b.select("task_id", F.unix_micros("start_ts").alias("start_us"), F.unix_micros("end_ts").alias("end_us"), F.size("evidence.message_ids").cast("bigint").alias("cited"), F.size("evidence.pr_numbers").cast("bigint").alias("prs"))


QUERIES, ORACLES = query.queries, query.oracles
