"""Aggregates and reports over cleaned streams, runs, training sets and usage."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions import scalars as S


def group_ordered(df: DataFrame, key: str, order: list[str], cols: list[str]) -> DataFrame:
    """(key, rows): the rows of each key in order, as an array of structs."""
    items = F.array_sort(F.collect_list(F.struct(*order, *[c for c in cols if c not in order])))
    return df.groupBy(key).agg(F.transform(items, lambda x: F.struct(*[x[c].alias(c) for c in cols])).alias("rows"))


def latest(df: DataFrame, keys: list[str], ts: str, tie: str) -> DataFrame:
    """The last row of each key, by time and then by tie, as a partial aggregate: no sort, no window."""
    own = [c for c in df.columns if c not in keys]
    return df.groupBy(*keys).agg(F.max_by(F.struct(*own), F.struct(ts, tie)).alias("x")).select(*keys, "x.*")


def chunk_rows(chunks: DataFrame) -> Column:
    """How many records a row stands for: chunks are those of windows.slice_chunks, or their counts by windows.chunk_counts."""
    return F.col("n") if "n" in chunks.columns else F.lit(1).cast("bigint")


def chunk_summary(chunks: DataFrame) -> DataFrame:
    return chunks.groupBy("source_table").agg(F.sum(chunk_rows(chunks)).alias("rows"), F.count_distinct("window_id").alias("windows")).orderBy(F.desc("rows"), "source_table")


def overlaps(chunks: DataFrame, keys: list[str]) -> DataFrame:
    """Keys that fall into more than one window."""
    return chunks.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where("n > 1")


def eval_task_score(results: DataFrame, jobs: DataFrame, task: str = "task_id") -> DataFrame:
    """(task, total_weight, passed_weight, pct): the weight passed, as a percentage to one digit, null without any."""
    both = results.join(jobs.select("job_id"), "job_id", "left_semi")
    return weighted_share(both, task, F.col("weight"), F.col("passed"))


def weighted_share(df: DataFrame, by: str, weight: Column, passed: Column) -> DataFrame:
    sums = df.groupBy(by).agg(F.sum(weight).alias("total_weight"), F.sum(F.when(passed, weight)).alias("passed_weight"))
    pct = F.round((F.lit(100) * F.col("passed_weight")).cast("decimal(30,6)") / F.nullif(F.col("total_weight"), F.lit(0)).cast("decimal(30,6)"), 1)
    return sums.withColumn("pct", pct.cast("double"))


def split_counts(df: DataFrame, split: str = "split") -> DataFrame:
    counts = [F.count_if(F.col(split) == s).alias(s) for s in ("train", "eval")]
    return df.agg(F.to_json(F.struct(F.count(F.lit(1)).alias("total"), *counts)).alias("counts"))


def watermarks(streams: dict[str, tuple[DataFrame, str, str]]) -> DataFrame:
    """(stream, last_ts, last_key) of each stream (table, time column, key column)."""
    parts = [
        df.agg(F.max(F.struct(F.col(ts).alias("ts"), F.col(key).cast("string").alias("key"))).alias("m")).select(F.lit(name).alias("stream"), F.col("m.ts").alias("last_ts"), F.col("m.key").alias("last_key"))
        for name, (df, ts, key) in streams.items()
    ]
    return reduce(DataFrame.unionByName, parts)


def coverage(windows: DataFrame, chunks: DataFrame, tables: list[str]) -> tuple[DataFrame, DataFrame]:
    """Counters of each window, and their totals with the number of windows that hold nothing."""
    counts = chunks.groupBy("window_id").agg(*[F.sum(F.when(F.col("source_table") == t, chunk_rows(chunks)).otherwise(0)).alias(t) for t in tables])
    per = windows.select("window_id").join(counts, "window_id", "left").fillna(0, tables)
    nothing = reduce(lambda a, b: a & b, [F.col(t) == 0 for t in tables])
    return per, per.agg(F.count(F.lit(1)).alias("windows"), *[F.coalesce(F.sum(t), F.lit(0)).alias(t) for t in tables], F.count_if(nothing).alias("empty"))


#: Values of one range when a median is looked for.
RANGE = 1024


def upper_medians(rows: DataFrame, by: list[str], columns: list[str]) -> DataFrame:
    """(*by, a column for each of columns): the element at half the number of rows, counted from 0, of the sorted whole
    numbers of the column in each group; nulls are left out.

    Rows are counted by value first. The range of values that holds the element is told from the sums of the ranges, and
    only the values of that range are put in order."""
    pairs = F.inline(F.array(*[F.struct(F.lit(c).alias("__of"), F.col(c).cast("bigint").alias("__v")) for c in columns]))
    counts = rows.select(*by, pairs).where("__v IS NOT NULL").groupBy(*by, "__of", "__v").agg(F.count(F.lit(1)).alias("__n"))
    counts = counts.withColumn("__range", F.floor(F.col("__v") / RANGE))
    group = [*by, "__of"]
    below = Window.partitionBy(*group).orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)
    ranges = counts.groupBy(*group, "__range").agg(F.sum("__n").alias("__n")).withColumns({"__before": F.coalesce(F.sum("__n").over(below), F.lit(0)), "__all": F.sum("__n").over(Window.partitionBy(*group))})
    at = F.floor(F.col("__all") / 2)
    held = ranges.where((F.col("__before") <= at) & (at < F.col("__before") + F.col("__n"))).select(*[F.col(c).alias(f"__k{i}") for i, c in enumerate([*group, "__range"])], (at - F.col("__before")).alias("__at"))
    few = counts.join(held, [F.col(c).eqNullSafe(F.col(f"__k{i}")) for i, c in enumerate([*group, "__range"])]).select(*group, "__v", "__n", "__at")
    upto = Window.partitionBy(*group).orderBy("__v").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    found = few.withColumn("__upto", F.sum("__n").over(upto)).where("__upto > __at").groupBy(*group).agg(F.min("__v").alias("__v"))
    made = [F.max(F.when(F.col("__of") == c, F.col("__v"))).alias(c) for c in columns]
    return found.groupBy(*by).agg(*made)


def dataset_stats(conversations: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Examples; least, upper median and most messages and tool calls; roles; tokens (a quarter of the characters, divided
    once). by: of each split."""
    by = by or []
    size = F.size("messages").cast("bigint")
    calls = F.size(F.filter("messages", lambda m: m["role"] == "tool")).cast("bigint")
    chars = F.aggregate("messages", F.lit(0).cast("bigint"), lambda n, m: n + F.coalesce(F.length(m["content"]), F.lit(0)))
    rows = conversations.select(*by, size.alias("n"), calls.alias("c"), chars.alias("chars"), F.transform("messages", lambda m: m["role"]).alias("roles"))
    roles = [F.sum(F.size(F.filter("roles", (lambda r: lambda x: x == r)(r)))).alias(f"n_{r}") for r in ("system", "user", "assistant", "tool")]
    made = [F.count(F.lit(1)).alias("examples"), F.min("n").alias("min_turns"), F.max("n").alias("max_turns"), F.min("c").alias("min_calls"), F.max("c").alias("max_calls"), *roles, F.floor(F.sum("chars") / 4).alias("tokens")]
    middle = upper_medians(rows, by, ["n", "c"]).select(*[F.col(b).alias(f"__b{i}") for i, b in enumerate(by)], F.col("n").alias("median_turns"), F.col("c").alias("median_calls"))
    same = [F.col(b).eqNullSafe(F.col(f"__b{i}")) for i, b in enumerate(by)] or F.lit(True)
    found = (rows.groupBy(*by).agg(*made) if by else rows.agg(*made)).join(middle, same, "left")
    return found.select(*by, "examples", "min_turns", "median_turns", "max_turns", "min_calls", "median_calls", "max_calls", *[f"n_{r}" for r in ("system", "user", "assistant", "tool")], "tokens")


def usage_totals(usage: DataFrame, by: list[str] | None = None) -> DataFrame:
    made = [F.count(F.lit(1)).alias("calls"), *[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("prompt_tokens", "completion_tokens", "credits")]]
    return usage.groupBy(*by).agg(*made) if by else usage.agg(*made)


def wallet(ledger: DataFrame, user: str = "user_id") -> DataFrame:
    """(user, credits, spent, balance): grants add to credits; spends, stored as positive amounts, to spent."""
    part = lambda kind: F.coalesce(F.sum(F.when(F.col("kind") == kind, F.col("amount"))), F.lit(0.0))
    return ledger.groupBy(user).agg(part("grant").alias("credits"), part("spend").alias("spent")).withColumn("balance", F.col("credits") - F.col("spent"))


def next_version(versions: DataFrame, users: DataFrame, user: str = "user_id") -> DataFrame:
    """(user, version): the version each user's next model gets, 1 for those without any."""
    have = versions.groupBy(user).agg(F.max("version").alias("v"))
    return users.select(user).distinct().join(have, user, "left").select(user, (F.coalesce("v", F.lit(0)) + 1).alias("version"))


def ingest_stats(messages: DataFrame, channel: str = "channel_id") -> DataFrame:
    """One row: channels, messages, how many have attachments and tickets, and the first and last time. No message at all
    raises, when the row is computed."""
    n = F.count(F.lit(1))
    checked = F.when(n > 0, n).otherwise(F.raise_error(F.lit("the archive holds no messages")))
    return messages.agg(
        F.count_distinct(channel).alias("channels"), checked.alias("messages"), F.count_if(F.size("attachment_filenames") > 0).alias("with_attachments"),
        F.count_if(F.size("mentions_ticket") > 0).alias("with_tickets"), F.min("ts").alias("earliest"), F.max("ts").alias("latest"),
    )


def patch_stats(df: DataFrame, task: str = "task_id", patch: str = "patch") -> DataFrame:
    """(task, file_no, path, adds, dels, hunks, is_new, is_deleted) of every file of unified diffs. Lines before the first
    file header count nowhere. A diff's lines are numbered inside its own row, so no window over tasks is needed."""
    lines = F.split(F.coalesce(patch, F.lit("")), "\n", -1)
    heads = F.filter(F.transform(lines, lambda x, i: F.when(F.startswith(x, F.lit("diff --git ")), i)), lambda i: i.isNotNull())
    files = df.select(task, lines.alias("l"), heads.alias("h")).select(task, "l", "h", F.posexplode("h").alias("file_no", "at"))
    end = F.coalesce(F.get("h", F.col("file_no") + 1), F.size("l"))
    body = files.select(task, "file_no", F.get("l", F.col("at")).alias("head"), F.slice("l", F.col("at") + 2, end - F.col("at") - 1).alias("body"))
    is_header = lambda x: F.startswith(x, F.lit("+++")) | F.startswith(x, F.lit("---"))
    count = lambda p: F.size(F.filter("body", lambda x: F.startswith(x, F.lit(p)) & ~is_header(x)))
    has = lambda p: F.exists("body", lambda x: F.startswith(x, F.lit(p)))
    path = F.regexp_extract("head", r"^diff --git a/(.+?) b/(.+)$", 2)
    return body.select(
        task, "file_no", F.when(path == "", F.col("head")).otherwise(path).alias("path"), count("+").alias("adds"), count("-").alias("dels"),
        count("@@").alias("hunks"), has("new file mode").alias("is_new"), has("deleted file mode").alias("is_deleted"),
    )


def sse_usage(frames: DataFrame, call: str = "call_id") -> DataFrame:
    """(call, prompt_tokens, completion_tokens): of a streamed reply's frames (call, pos, frame) the last that are not zero.
    A line cut by a frame's end is put together first: a call's frames are joined in order."""
    whole = frames.groupBy(call).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("pos", "frame"))), lambda x: x["frame"]), "").alias("text"))
    lines = whole.select(call, F.posexplode(F.split("text", r"\r\n|\n|\r", -1)).alias("pos", "line"))
    data = lines.where(F.startswith("line", F.lit("data:"))).select(call, "pos", F.trim(F.expr("substr(line, 6)")).alias("payload"))
    usage = data.select(call, "pos", F.from_json("payload", "usage struct<prompt_tokens: bigint, completion_tokens: bigint>")["usage"].alias("u"))
    last = lambda c: F.coalesce(F.max_by(f"u.{c}", F.when(F.col(f"u.{c}") != 0, F.col("pos"))), F.lit(0)).alias(c)
    found = usage.groupBy(call).agg(last("prompt_tokens"), last("completion_tokens"))
    return whole.select(call).join(found, call, "left").fillna(0, ["prompt_tokens", "completion_tokens"])


def run_totals(runs: DataFrame) -> DataFrame:
    """One row: runs, those that succeeded and their share, those without a final text, and sums of their counters."""
    sums = [F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("turns", "tool_calls", "tokens_in", "tokens_out", "files_changed")]
    ok = F.count_if(F.col("status") == "succeeded")
    return runs.agg(F.count(F.lit(1)).alias("runs"), ok.alias("succeeded"), F.try_divide(ok, F.count(F.lit(1))).alias("ok_ratio"), F.count_if(S.present(F.trim("final")).isNull()).alias("without_final"), *sums)


def run_status(events: DataFrame, run: str = "run_id") -> DataFrame:
    """(run, stage, n_events, timeline): the last stage that a run reported, and all of them in order."""
    items = F.array_sort(F.collect_list(F.struct("at", "stage", "message")))
    return events.groupBy(run).agg(F.max_by("stage", F.struct("at", "stage")).alias("stage"), F.count(F.lit(1)).alias("n_events"), items.alias("timeline"))


def assemble_calls(chunks: DataFrame) -> DataFrame:
    """(reply_id, idx, call_id, name, arguments): streamed tool calls (reply_id, pos, idx, call_id, name, arguments) put
    together in order of arrival; calls that never got a name are dropped."""
    joined = lambda c: F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("pos", F.coalesce(c, F.lit("")).alias("t")))), lambda x: x["t"]), "").alias(c)
    last = F.max_by("call_id", F.when(S.present(F.col("call_id")).isNotNull(), F.col("pos"))).alias("call_id")
    return chunks.groupBy("reply_id", "idx").agg(last, joined("name"), joined("arguments")).where("name <> ''")
