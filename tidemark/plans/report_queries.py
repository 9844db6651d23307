"""Training sets, reports, checks and streams over the driver's tables."""

from __future__ import annotations

import uuid

from pyspark.sql import Window
from pyspark.sql import functions as F

from tidemark.operators import dataset, replies, reports, validate
from tidemark.plans.tables import Registry, table
from tidemark.sources import sinks
from tidemark.streaming import stream

query = Registry()


def _turns(spark, sf_dir):
    return table(spark, sf_dir, "conversations")


def _talks(spark, sf_dir):
    """conversations as one row each: messages in order; every third turn of an assistant is read as a tool's result."""
    made = F.struct("role", F.col("text").alias("content"), F.lit(None).cast("array<struct<id: string, name: string, arguments: string>>").alias("tool_calls"), F.lit(None).cast("string").alias("tool_call_id"), F.lit(None).cast("string").alias("name"))
    rows = _turns(spark, sf_dir).withColumn("role", F.when((F.col("role") == "assistant") & (F.col("turn") % 3 == 0), "tool").otherwise(F.col("role")))
    ordered = F.array_sort(F.collect_list(F.struct("turn", F.xxhash64("text").alias("t"), made.alias("m"))))
    return rows.groupBy("conv_id").agg(F.transform(ordered, lambda x: x["m"]).alias("messages")).withColumnRenamed("conv_id", "window_id")


_TALKS_SQL = """t AS (SELECT conv_id, turn, text, CASE WHEN role = 'assistant' AND turn % 3 = 0 THEN 'tool' ELSE role END AS role FROM conversations),
talk AS (SELECT conv_id, count(*) AS n, arg_min(role, turn) AS first_role, arg_max(role, turn) AS last_role, arg_max(text, turn) AS last_text, count(CASE WHEN role = 'tool' THEN 1 END) AS n_tool,
  sum(length(text)) AS chars FROM t GROUP BY 1)"""


@query(f"""WITH {_TALKS_SQL} SELECT c AS "check", CAST(conv_id AS VARCHAR) AS key, CAST(n AS VARCHAR) AS detail FROM (
  SELECT conv_id, n, unnest(['starts_with_system', 'three_messages', 'ends_on_assistant', 'final_not_blank', 'uses_a_tool']) AS c,
    unnest([first_role <> 'system', n < 3, n >= 3 AND last_role <> 'assistant', n >= 3 AND trim(last_text) = '', n_tool = 0]) AS bad FROM talk) WHERE bad""")
def conversation_checks(spark, sf_dir):
    return validate.check_conversations(_talks(spark, sf_dir))


@query(f"""WITH {_TALKS_SQL}, s AS (SELECT list_sort(list(n)) AS ns, list_sort(list(n_tool)) AS cs, count(*) AS c, sum(chars) AS chars FROM talk)
SELECT c AS examples, ns[1] AS min_turns, ns[c // 2 + 1] AS median_turns, ns[c] AS max_turns, cs[1] AS min_calls, cs[c // 2 + 1] AS median_calls, cs[c] AS max_calls,
  (SELECT count(*) FROM t WHERE role = 'system') AS n_system, (SELECT count(*) FROM t WHERE role = 'user') AS n_user, (SELECT count(*) FROM t WHERE role = 'assistant') AS n_assistant,
  (SELECT count(*) FROM t WHERE role = 'tool') AS n_tool, CAST(floor(chars / 4) AS BIGINT) AS tokens FROM s""")
def conversation_stats(spark, sf_dir):
    return reports.dataset_stats(_talks(spark, sf_dir))


@query(f"""WITH {_TALKS_SQL}, s AS (SELECT conv_id % 4 AS split, list_sort(list(n)) AS ns, count(*) AS c, sum(chars) AS chars FROM talk GROUP BY 1)
SELECT split, c AS examples, ns[c // 2 + 1] AS median_turns, CAST(floor(chars / 4) AS BIGINT) AS tokens FROM s""")
def split_report(spark, sf_dir):
    t = _talks(spark, sf_dir).withColumn("split", F.col("window_id") % 4)
    return reports.dataset_stats(t, ["split"]).select("split", "examples", "median_turns", "tokens")


@query(f"""WITH {_TALKS_SQL} SELECT conv_id AS window_id, count(CASE WHEN role = 'assistant' THEN 1 END) AS trained, CAST(floor(sum(length(text)) / 4) AS BIGINT) AS approx_tokens FROM t GROUP BY 1""")
def trainable_masks(spark, sf_dir):
    m = dataset.masked(_talks(spark, sf_dir))
    return m.select("window_id", F.size(F.filter("trainable", lambda x: x)).cast("bigint").alias("trained"), "approx_tokens")


@query("""WITH l AS (SELECT *, lag(role) OVER (PARTITION BY conv_id ORDER BY turn) AS p FROM conversations),
i AS (SELECT *, sum(CASE WHEN p = role THEN 0 ELSE 1 END) OVER (PARTITION BY conv_id ORDER BY turn) AS island FROM l)
SELECT conv_id, role, min(turn) AS first_pos, count(*) AS n, md5(string_agg(text, '' ORDER BY turn)) AS digest FROM i GROUP BY conv_id, island, role""")
def folded_timeline(spark, sf_dir):
    f = dataset.fold_timeline(_turns(spark, sf_dir), ["conv_id"], "turn", "role", "text")
    return f.select("conv_id", "role", "first_pos", "n", F.md5("text").alias("digest"))


@query("""WITH l AS (SELECT *, lag(event_type) OVER (PARTITION BY user_id ORDER BY event_id) AS p FROM events),
i AS (SELECT *, sum(CASE WHEN p = event_type THEN 0 ELSE 1 END) OVER (PARTITION BY user_id ORDER BY event_id) AS island FROM l)
SELECT user_id, event_type, min(event_id) AS first_pos, count(*) AS n FROM i GROUP BY user_id, island, event_type""")
def event_islands(spark, sf_dir):
    f = dataset.fold_timeline(table(spark, sf_dir, "events"), ["user_id"], "event_id", "event_type", "props")
    return f.select("user_id", "event_type", "first_pos", "n")


@query("""SELECT conv_id, turn, CAST(row_number() OVER w - 1 AS INTEGER) AS ordinal, row_number() OVER w = 1 AS is_start, row_number() OVER (PARTITION BY conv_id ORDER BY turn DESC) = 1 AS is_end
FROM conversations WINDOW w AS (PARTITION BY conv_id ORDER BY turn)""")
def turn_positions(spark, sf_dir):
    return dataset.position_flags(_turns(spark, sf_dir), ["conv_id"], ["turn"]).select("conv_id", "turn", "ordinal", "is_start", "is_end")


@query("""WITH r AS (SELECT doc_id, row_number() OVER (ORDER BY md5(CAST(doc_id AS VARCHAR) || ':7'), doc_id) AS rn, count(*) OVER () AS c FROM documents)
SELECT doc_id, CASE WHEN rn <= greatest(1, CAST(floor(c * 0.15) AS BIGINT)) THEN 'val' ELSE 'train' END AS split FROM r""")
def dataset_split(spark, sf_dir):
    return dataset.split_dataset(table(spark, sf_dir, "documents").select("doc_id"), "doc_id", "7", 0.15)


@query("""WITH d AS (SELECT doc_id FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)), r AS (SELECT doc_id, row_number() OVER (ORDER BY md5(CAST(doc_id AS VARCHAR) || ':1'), doc_id) AS rn, count(*) OVER () AS c FROM d)
SELECT doc_id, CASE WHEN rn <= greatest(1, CAST(floor(c * 0.2) AS BIGINT)) THEN 'val' ELSE 'train' END AS split FROM r""")
def guarded_split(spark, sf_dir):
    held = table(spark, sf_dir, "labels").select("doc_id")
    return dataset.split_dataset(table(spark, sf_dir, "documents").select("doc_id"), "doc_id", "1", 0.2, held)


# recorded runs, made of the conversations: a run a conversation, a call each assistant turn


def _runs(spark, sf_dir):
    c = _turns(spark, sf_dir)
    per = c.groupBy("conv_id").agg(F.count(F.lit(1)).alias("turns"), F.max_by("text", "turn").alias("final"))
    runs = per.select(
        F.concat(F.lit("r"), F.col("conv_id").cast("string")).alias("id"), F.concat(F.lit("w"), F.floor(F.col("conv_id") / 2).cast("string")).alias("window_id"), F.col("conv_id").cast("double").alias("finished_at"),
        F.when(F.col("conv_id") % 5 == 4, "failed").otherwise("succeeded").alias("status"), "final", F.col("turns").cast("int").alias("turns"), F.lit(1).alias("tool_calls"), F.lit(10).alias("tokens_in"), F.lit(5).alias("tokens_out"), F.lit(0).alias("files_changed"),
    )
    name = F.when(F.col("turn") % 4 == 3, "telepathy").otherwise("search")
    call = F.array(F.struct(name.alias("name"), F.lit('{"q": 1}').alias("args")))
    result = F.array(F.struct(F.col("text").alias("output"), F.lit(True).alias("ok")))
    none_c, none_r = F.array().cast("array<struct<name: string, args: string>>"), F.array().cast("array<struct<output: string, ok: boolean>>")
    talk = F.col("role") == "assistant"
    turns = c.select(F.concat(F.lit("r"), F.col("conv_id").cast("string")).alias("run_id"), F.lit("w").alias("window_id"), "turn", F.col("text").alias("content"), F.when(talk, call).otherwise(none_c).alias("calls"), F.when(talk, result).otherwise(none_r).alias("results"))
    wins = runs.select("window_id").distinct().withColumns({"title": F.col("window_id"), "summary": F.lit("do it")})
    return runs, dataset.trajectory_rows(turns), wins


@query("""SELECT 'r' || conv_id AS run_id, turn, CASE WHEN role = 'assistant' THEN CASE WHEN turn % 4 = 3 THEN 'telepathy' ELSE 'search' END END AS tool_name, md5(CASE WHEN role = 'assistant' THEN text END) AS result FROM conversations""")
def trajectory_steps(spark, sf_dir):
    return _runs(spark, sf_dir)[1].select("run_id", "turn", "tool_name", F.md5("tool_result").alias("result"))


@query("""WITH newest AS (SELECT conv_id // 2 AS w, max(conv_id) AS conv_id FROM conversations WHERE conv_id % 5 <> 4 GROUP BY 1),
s AS (SELECT w, c.*, role = 'assistant' AND turn % 4 <> 3 AS call FROM newest JOIN conversations c USING (conv_id)),
g AS (SELECT w, conv_id, count(CASE WHEN call THEN 1 END) AS calls, count(CASE WHEN role = 'assistant' AND turn % 4 = 3 THEN 1 END) AS dropped, count(*) AS n, arg_max(text, turn) AS final, arg_max(call, turn) AS last_call FROM s GROUP BY 1, 2)
SELECT 'w' || w AS window_id, 'r' || conv_id AS run_id, CAST(calls AS BIGINT) AS n_tool_calls, CAST(dropped AS BIGINT) AS dropped_tool_names,
  CAST(2 + n + calls + CASE WHEN last_call THEN CASE WHEN trim(final, ' ') = '' OR trim(substr(final, 1, 12000), ' ') = trim(final, ' ') THEN 0 ELSE 1 END ELSE 0 END AS BIGINT) AS n_messages, final <> '' AS said FROM g WHERE calls > 0 AND NOT last_call""")
def conversations_built(spark, sf_dir):
    runs, steps, wins = _runs(spark, sf_dir)
    made = dataset.build_conversations(runs, steps, wins, ["search"], "You are careful.")
    return made.select("window_id", "run_id", "n_tool_calls", "dropped_tool_names", F.size("messages").cast("bigint").alias("n_messages"), (F.element_at("messages", -1)["content"] != "").alias("said"))


@query("""WITH newest AS (SELECT conv_id // 2 AS w, max(conv_id) AS conv_id FROM conversations WHERE conv_id % 5 <> 4 GROUP BY 1),
s AS (SELECT w, turn, role = 'assistant' AS call, turn % 4 = 3 AS odd FROM newest JOIN conversations USING (conv_id)),
g AS (SELECT w, count(CASE WHEN call THEN 1 END) AS calls, count(CASE WHEN call AND odd THEN 1 END) AS odd, arg_max(call, turn) AS last_call FROM s GROUP BY 1),
kept AS (SELECT * FROM g WHERE calls > 0 AND NOT last_call)
SELECT 'unanswered_call' AS "check", CAST(sum(calls) AS BIGINT) AS n FROM kept WHERE w % 2 = 0 HAVING sum(calls) > 0 UNION ALL SELECT 'unknown_tool', CAST(sum(odd) AS BIGINT) FROM kept HAVING sum(odd) > 0""")
def tool_pairing_checks(spark, sf_dir):
    runs, steps, wins = _runs(spark, sf_dir)
    made = dataset.build_conversations(runs, steps, wins, ["search", "telepathy"], "s")
    broken = made.withColumn("messages", F.when(F.expr("CAST(substr(window_id, 2) AS BIGINT)") % 2 == 0, F.filter("messages", lambda m: m["role"] != "tool")).otherwise(F.col("messages")))
    return validate.all_of(validate.check_tool_pairing(broken), validate.check_tools(made, ["search"])).groupBy("check").agg(F.count(F.lit(1)).alias("n"))


@query("""SELECT CAST(w AS VARCHAR) AS key, 'train,val' AS detail FROM (SELECT doc_id // 3 AS w, count(*) AS n, count(DISTINCT doc_id % 2) AS s FROM documents GROUP BY 1) WHERE n > 1 AND s = 2""")
def split_leaks(spark, sf_dir):
    d = table(spark, sf_dir, "documents").select(F.floor(F.col("doc_id") / 3).alias("window_id"), F.when(F.col("doc_id") % 2 == 0, "train").otherwise("val").alias("split"))
    return validate.check_split_leak(d).where("detail = 'train,val'").select("key", "detail")


@query("""SELECT conv_id AS k, list(text ORDER BY turn) AS messages FROM conversations GROUP BY 1""")
def timelines_to_messages(spark, sf_dir):
    entry = F.array(F.struct(F.col("text").alias("raw_message")), F.struct(F.lit(None).cast("string").alias("raw_message")))
    none = F.array().cast("array<struct<raw_message: string>>")
    even = F.col("turn") % 2 == 0
    rows = _turns(spark, sf_dir).select("conv_id", "turn", F.when(even, entry).otherwise(none).alias("timeline"), entry.alias("thinking"), none.alias("output"))
    return dataset.timeline_to_messages(rows, "conv_id", "turn").select(F.col("conv_id").alias("k"), "messages")


# reports


@query("""SELECT l_returnflag, CAST(sum(l_linenumber) AS BIGINT) AS total_weight, CAST(sum(l_linenumber) FILTER (WHERE l_linestatus = 'O') AS BIGINT) AS passed_weight,
  round(100.0 * sum(l_linenumber) FILTER (WHERE l_linestatus = 'O') / nullif(sum(l_linenumber), 0), 1) AS pct FROM lineitem GROUP BY 1""")
def weighted_pass_rate(spark, sf_dir):
    return reports.weighted_share(table(spark, sf_dir, "lineitem"), "l_returnflag", F.col("l_linenumber").cast("bigint"), F.col("l_linestatus") == "O")


@query("""WITH r AS (SELECT event_id % 97 AS task_id, event_id % 5 + 1 AS weight, event_type = 'purchase' AS passed FROM events WHERE user_id % 10 <> 3)
SELECT task_id, CAST(sum(weight) AS BIGINT) AS total_weight, CAST(sum(weight) FILTER (WHERE passed) AS BIGINT) AS passed_weight, round(100.0 * sum(weight) FILTER (WHERE passed) / sum(weight), 1) AS pct FROM r GROUP BY 1""")
def eval_scores(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    res = e.select(F.col("user_id").alias("job_id"), (F.col("event_id") % 97).alias("task_id"), (F.col("event_id") % 5 + 1).alias("weight"), (F.col("event_type") == "purchase").alias("passed"))
    jobs = e.where("user_id % 10 <> 3").select(F.col("user_id").alias("job_id")).distinct()
    return reports.eval_task_score(res, jobs)


@query("""SELECT '{"total":' || count(*) || ',"train":' || count(*) FILTER (WHERE quality = 1) || ',"eval":' || count(*) FILTER (WHERE quality = 0) || '}' AS counts FROM labels""")
def label_counts(spark, sf_dir):
    return reports.split_counts(table(spark, sf_dir, "labels").withColumn("split", F.when(F.col("quality") == 1, "train").otherwise("eval")))


@query("""SELECT l_suppkey, count(*) AS calls, CAST(coalesce(sum(l_linenumber), 0) AS BIGINT) AS prompt_tokens, CAST(coalesce(sum(l_orderkey), 0) AS BIGINT) AS completion_tokens, CAST(coalesce(sum(l_partkey), 0) AS BIGINT) AS credits FROM lineitem GROUP BY 1""")
def usage_by_supplier(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem").select("l_suppkey", F.col("l_linenumber").alias("prompt_tokens"), F.col("l_orderkey").alias("completion_tokens"), F.col("l_partkey").alias("credits"))
    return reports.usage_totals(li, ["l_suppkey"])


@query("""SELECT o_custkey AS user_id, CAST(coalesce(sum(c) FILTER (WHERE o_orderstatus = 'F'), 0) AS DOUBLE) AS credits, CAST(coalesce(sum(c) FILTER (WHERE o_orderstatus = 'O'), 0) AS DOUBLE) AS spent,
  CAST(coalesce(sum(c) FILTER (WHERE o_orderstatus = 'F'), 0) - coalesce(sum(c) FILTER (WHERE o_orderstatus = 'O'), 0) AS DOUBLE) AS balance FROM (SELECT *, CAST(floor(o_totalprice) AS BIGINT) AS c FROM orders) GROUP BY 1""")
def wallets(spark, sf_dir):
    kind = F.when(F.col("o_orderstatus") == "F", "grant").when(F.col("o_orderstatus") == "O", "spend").otherwise("hold")
    return reports.wallet(table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("user_id"), kind.alias("kind"), F.floor("o_totalprice").cast("double").alias("amount")))


@query("""SELECT c_custkey AS user_id, CAST(coalesce(n, 0) + 1 AS BIGINT) AS version FROM customer LEFT JOIN (SELECT o_custkey, count(*) AS n FROM orders GROUP BY 1) ON o_custkey = c_custkey""")
def next_versions(spark, sf_dir):
    o = table(spark, sf_dir, "orders").groupBy(F.col("o_custkey").alias("user_id")).agg(F.count(F.lit(1)).alias("version"))
    return reports.next_version(o, table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("user_id")))


@query("""SELECT user_id AS run_id, arg_max(event_type, (ts, event_type)) AS stage, count(*) AS n_events FROM events GROUP BY 1""")
def run_stages(spark, sf_dir):
    e = table(spark, sf_dir, "events").select(F.col("user_id").alias("run_id"), F.col("ts").alias("at"), F.col("event_type").alias("stage"), F.col("props").alias("message"))
    return reports.run_status(e).select("run_id", "stage", "n_events")


@query("""WITH r AS (SELECT conv_id, count(*) AS turns FROM conversations GROUP BY 1) SELECT count(*) AS runs, count(CASE WHEN conv_id % 5 <> 4 THEN 1 END) AS succeeded, CAST(sum(turns) AS BIGINT) AS turns, CAST(10 * count(*) AS BIGINT) AS tokens_in FROM r""")
def run_totals(spark, sf_dir):
    return reports.run_totals(_runs(spark, sf_dir)[0]).select("runs", "succeeded", "turns", "tokens_in")


@query("""SELECT user_id, list(event_id ORDER BY event_id) AS ids FROM events GROUP BY 1""")
def rows_in_order(spark, sf_dir):
    g = reports.group_ordered(table(spark, sf_dir, "events").select("user_id", "event_id", "event_type"), "user_id", ["event_id"], ["event_id", "event_type"])
    return g.select("user_id", F.transform("rows", lambda x: x["event_id"]).alias("ids"))


@query("""SELECT p_partkey AS task_id, f AS file_no, CASE f WHEN 0 THEN 'b' || p_size ELSE 'd' END AS path, CASE f WHEN 0 THEN 2 ELSE 0 END AS adds, 1 AS dels, 1 AS hunks, f = 0 AS is_new, f = 1 AS is_deleted
FROM part, (SELECT unnest([0, 1]) AS f)""")
def patch_files(spark, sf_dir):
    p = table(spark, sf_dir, "part")
    text = F.concat(F.lit("junk\n+before\ndiff --git a/a b/b"), F.col("p_size").cast("string"), F.lit("\nnew file mode 100644\n--- /dev/null\n+++ b/b\n@@ -0,0 +1,2 @@\n+one\n+two\n-gone\ndiff --git a/c b/d\ndeleted file mode 100644\n@@ -1 +0,0 @@\n-x\n context"))
    return reports.patch_stats(p.select(F.col("p_partkey").alias("task_id"), text.alias("patch")))


@query("""SELECT event_id AS call_id, event_id % 50 + 1 AS prompt_tokens, user_id + 1 AS completion_tokens FROM events""")
def streamed_usage(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    data = F.concat(F.lit('data: {"usage": {"prompt_tokens": '), (F.col("event_id") % 50 + 1).cast("string"), F.lit(', "completion_tokens": '), (F.col("user_id") + 1).cast("string"), F.lit("}}\n\ndata: {\"usage\": {\"prompt_tokens\": 0}}\n\ndata: [DONE]\n"))
    frames = e.select(F.col("event_id").alias("call_id"), F.posexplode(F.array(F.substring(data, 1, 17), F.expr("NULL").cast("string"), F.lit(""))).alias("pos", "frame"), data.alias("d"))
    whole = frames.withColumn("frame", F.when(F.col("pos") == 1, F.expr("substr(d, 18)")).otherwise(F.col("frame")))
    return reports.sse_usage(whole.select("call_id", "pos", "frame"))


@query("""SELECT user_id AS reply_id, event_id % 2 AS idx, string_agg(event_type, '' ORDER BY event_id) AS arguments FROM events GROUP BY 1, 2""")
def assembled_calls(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    first = F.row_number().over(Window.partitionBy("user_id", F.col("event_id") % 2).orderBy("event_id"))
    chunks = e.select(F.col("user_id").alias("reply_id"), F.col("event_id").alias("pos"), (F.col("event_id") % 2).alias("idx"), F.lit("c").alias("call_id"), F.when(first == 1, "search").alias("name"), F.col("event_type").alias("arguments"))
    return reports.assemble_calls(chunks).select("reply_id", "idx", "arguments")


@query("""SELECT event_id AS reply_id, 't' || event_id AS task_id, '1' AS start_ts, '2' AS end_ts, 'USR-1' AS ticket FROM events WHERE event_id % 4 <> 3
UNION ALL SELECT event_id, 'cut', NULL, NULL, NULL FROM events WHERE event_id % 4 = 2""")
def replies_parsed(spark, sf_dir):
    """Model replies made of the events: prose, fences, an example before the answer, comments, and cut-off ends."""
    e = table(spark, sf_dir, "events")
    window = F.concat(F.lit('{"task_id": "t'), F.col("event_id").cast("string"), F.lit('", "start_ts": "1", "end_ts": "2", "evidence": {"message_ids": ["a",], // ids\n "ticket": "USR-1"}}'))
    k = F.col("event_id") % 4
    text = (
        F.when(k == 0, F.concat(F.lit('Example {"windows": []}\n```json\n{"windows": ['), window, F.lit("]}\n```\ndone")))
        .when(k == 1, F.concat(F.lit("Here: ["), window, F.lit("]")))
        .when(k == 2, F.concat(F.lit('{"windows": ['), window, F.lit(', {"task_id": "cut')))
        .otherwise("no answer")
    )
    found = replies.load_proposals(e.select(F.col("event_id").alias("reply_id"), text.alias("text")))
    return found.select("reply_id", "task_id", "start_ts", "end_ts", "evidence.ticket")


# checks on tables


@query("""SELECT 'price' AS "check", CAST(o_orderkey AS VARCHAR) AS key FROM orders WHERE NOT (o_totalprice > 2000) UNION ALL SELECT 'status', CAST(o_orderkey AS VARCHAR) FROM orders WHERE NOT (o_orderstatus IN ('O', 'F'))""")
def order_constraints(spark, sf_dir):
    found = validate.check_constraints(table(spark, sf_dir, "orders"), ["o_orderkey"], {"price": "o_totalprice > 2000", "status": "o_orderstatus IN ('O', 'F')"})
    return found.select("check", "key")


@query("""SELECT user_id || '|' || event_id AS key FROM (SELECT *, lag(value) OVER (PARTITION BY user_id ORDER BY event_id) AS p FROM events) WHERE value < p""")
def order_of_values(spark, sf_dir):
    return validate.check_order(table(spark, sf_dir, "events"), ["user_id"], "event_id", "value", "order").select("key")


# streams: the events' files, read incrementally


def _shared(spark) -> str:
    return f"{sinks.shared_folder(spark)}/stream-{uuid.uuid4().hex}"


def _event_stream(spark, sf_dir):
    schema = table(spark, sf_dir, "events").schema
    files = f"{sf_dir}/events.parque[t]"  # a pattern, as a stream takes a single file only by one
    return spark.readStream.schema(schema).parquet(files).withColumn("ts", F.col("ts").cast("timestamp"))


@query("SELECT event_id, user_id FROM events")
def stream_deduped(spark, sf_dir):
    base, rows = _shared(spark), _event_stream(spark, sf_dir)
    twice = rows.select("event_id", "user_id", "ts", F.explode(F.array(F.lit(0), F.lit(1))).alias("copy"))
    once = stream.stream_dedupe(twice, ["event_id"], "ts", "60 days").select("event_id", "user_id")
    once.writeStream.format("parquet").option("path", f"{base}/out").option("checkpointLocation", f"{base}/checkpoint").trigger(availableNow=True).start().awaitTermination()
    return spark.read.parquet(f"{base}/out").select("event_id", "user_id")


@query("""SELECT CAST(floor(epoch(ts) / 86400) AS BIGINT) AS day, event_type, count(*) AS n FROM events GROUP BY 1, 2""")
def stream_daily_counts(spark, sf_dir):
    base = _shared(spark)
    counts = stream.windowed_counts(_event_stream(spark, sf_dir), "ts", "1 day", ["event_type"], "2 days")

    def each(batch, batch_id):
        batch.write.mode("overwrite").parquet(f"{base}/out")

    counts.writeStream.outputMode("complete").foreachBatch(each).option("checkpointLocation", f"{base}/checkpoint").trigger(availableNow=True).start().awaitTermination()
    return spark.read.parquet(f"{base}/out").select(F.floor(F.unix_seconds("start") / 86400).cast("bigint").alias("day"), "event_type", "n")


@query("""SELECT CAST(event_id AS VARCHAR) AS message_id, CAST(floor(epoch(ts)) AS BIGINT) AS secs FROM events WHERE event_id % 10 <> 3""")
def stream_silver(spark, sf_dir):
    base = _shared(spark)
    none = F.lit(None).cast("string")
    rows = _event_stream(spark, sf_dir).select(
        F.col("event_id").cast("string").alias("message_id"), F.col("user_id").cast("string").alias("author_id"), F.col("event_type").alias("author_name"), F.unix_seconds("ts").cast("string").alias("ts_raw"),
        F.when(F.col("event_id") % 10 == 3, F.lit("")).otherwise(F.col("props")).alias("content"), none.alias("jump_url"), F.col("event_id").alias("ordinal"),
    )
    stream.run_silver_stream(rows, f"{base}/clean", f"{base}/quarantine", f"{base}/checkpoint", f"{base}/audit")
    return spark.read.parquet(f"{base}/clean").select("message_id", F.unix_seconds("ts").alias("secs"))


QUERIES, ORACLES = query.queries, query.oracles
