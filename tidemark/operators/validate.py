"""Checks. Each returns its violations as (check, key, detail); no row means that all is well."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidemark.functions import scalars as S
from tidemark.operators.scan import Scan


def violations(df: DataFrame, check: str, key: str | Column, detail: str | Column = "", where: Column | None = None) -> DataFrame:
    rows = df if where is None else df.where(where)
    key = F.col(key) if isinstance(key, str) else key
    detail = F.lit(detail) if isinstance(detail, str) else detail
    return rows.select(F.lit(check).alias("check"), key.cast("string").alias("key"), detail.cast("string").alias("detail"))


def all_of(*parts: DataFrame) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def _keyed_checks(df: DataFrame, tests: dict[str, tuple[Column, Column, Column]]) -> DataFrame:
    """Several tests of a row, check: (condition, key, detail), in one pass over df."""
    marks = [F.when(where, F.struct(F.lit(check).alias("check"), key.cast("string").alias("key"), detail.cast("string").alias("detail"))) for check, (where, key, detail) in tests.items()]
    return df.select(F.inline(F.filter(F.array(*marks), lambda x: x.isNotNull())))


def row_checks(df: DataFrame, key: str | Column, tests: dict[str, tuple[Column, str | Column]], repeats: str) -> DataFrame:
    """The violations of several tests, check: (condition, detail), of each row, and a check named `repeats` of keys that
    several rows have, in one pass over df: a row gives its key and the list of what is wrong with it, these are counted,
    and each finding is given out as often as it came."""
    key = (F.col(key) if isinstance(key, str) else key).cast("string")

    def said(check: str, detail: Column) -> Column:
        return F.struct(F.lit(check).alias("check"), key.alias("key"), detail.cast("string").alias("detail"))

    marks = [F.when(where, said(check, F.lit(detail) if isinstance(detail, str) else detail)) for check, (where, detail) in tests.items()]
    found = df.select(F.inline(F.filter(F.array(said(repeats, F.lit(None)), *marks), lambda x: x.isNotNull())))
    per = found.groupBy("check", "key", "detail").agg(F.count(F.lit(1)).alias("n"))
    each = F.when(F.col("check") != repeats, F.sequence(F.lit(1), F.col("n"))).when(F.col("n") > 1, F.array(F.lit(1).cast("bigint")))
    again = F.col("check") == repeats
    return per.select("check", F.when(again, F.coalesce("key", F.lit(""))).otherwise(F.col("key")).alias("key"), F.when(again, F.col("n").cast("string")).otherwise(F.col("detail")).alias("detail"), F.explode(each).alias("__i")).drop("__i")


def check_conversations(df: DataFrame, id: str = "window_id") -> DataFrame:
    """messages: three at least, a system message first, an assistant that says something last, a tool used. One pass: a
    row gets the list of what is wrong with it."""
    n, first, last = F.size("messages"), F.get("messages", F.lit(0)), F.get("messages", F.size("messages") - 1)
    tests = {
        "starts_with_system": F.coalesce(first["role"], F.lit("")) != "system",
        "three_messages": n < 3,
        "ends_on_assistant": (n >= 3) & (F.coalesce(last["role"], F.lit("")) != "assistant"),
        "final_not_blank": (n >= 3) & (F.coalesce(F.trim(last["content"]), F.lit("")) == ""),
        "uses_a_tool": ~F.exists("messages", lambda m: F.coalesce(m["role"], F.lit("")) == "tool"),
    }
    bad = F.filter(F.array(*[F.when(t, F.lit(k)) for k, t in tests.items()]), lambda x: x.isNotNull())
    return df.select(F.explode(bad).alias("check"), F.col(id).cast("string").alias("key"), n.cast("string").alias("detail"))


def check_tool_pairing(df: DataFrame, id: str = "window_id") -> DataFrame:
    """Every tool result answers an earlier call that is still open, and every call is answered. The n-th call of an id goes
    with its n-th result; a pair in the wrong order, or without its other half, is a violation."""
    at = df.select(F.col(id).alias("k"), F.posexplode("messages").alias("pos", "m"))
    calls = at.where("m.role = 'assistant'").select("k", "pos", F.explode("m.tool_calls").alias("c")).select("k", "pos", F.col("c.id").alias("cid"))
    results = at.where("m.role = 'tool'").select("k", "pos", F.col("m.tool_call_id").alias("cid"))
    w = Window.partitionBy("k", "cid").orderBy("pos")
    a = calls.withColumn("n", F.row_number().over(w)).withColumnRenamed("pos", "called")
    b = results.withColumn("n", F.row_number().over(w)).withColumnRenamed("pos", "answered")
    both = a.join(b, ["k", "cid", "n"], "full_outer")
    orphan = F.col("answered").isNotNull() & (F.col("called").isNull() | (F.col("called") > F.col("answered")))
    unanswered = F.col("called").isNotNull() & (F.col("answered").isNull() | (F.col("called") > F.col("answered")))
    return violations(both, "orphan_result", "k", F.col("cid"), orphan).unionByName(violations(both, "unanswered_call", "k", F.col("cid"), unanswered))


def check_tools(df: DataFrame, names: list[str], id: str = "window_id") -> DataFrame:
    calls = df.select(F.col(id).alias("k"), F.explode("messages").alias("m")).select("k", F.explode("m.tool_calls").alias("c"))
    return violations(calls, "unknown_tool", "k", F.col("c.name"), ~F.coalesce(F.col("c.name").isin(names), F.lit(False)))


def check_split_leak(df: DataFrame, id: str = "window_id", split: str = "split") -> DataFrame:
    """Ids that occur more than once over all splits."""
    n = df.groupBy(id).agg(F.count(F.lit(1)).alias("n"), F.array_join(F.array_sort(F.collect_set(split)), ",").alias("s")).where("n > 1")
    return violations(n, "in_splits_more_than_once", id, F.col("s"))


def repeated_keys(df: DataFrame, keys: list[str], check: str) -> DataFrame:
    n = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    return violations(n, check, F.concat_ws("|", *keys), F.col("n"))


def check_silver(messages: DataFrame, issues: DataFrame, commits: DataFrame, bad: DataFrame, first: str, last: str) -> DataFrame:
    """Cleaned streams: unique, spoken by known authors, in the time range, keys in shape, every quarantined row with a
    reason."""
    outside = (F.col("ts") < F.lit(first).cast("timestamp")) | (F.col("ts") > F.lit(last).cast("timestamp"))
    said = {
        "message_blank": (F.coalesce(F.trim("content"), F.lit("")) == "", ""),
        "message_without_author": (S.present(F.col("author_name")).isNull(), ""),
        "message_outside_range": (outside, F.col("ts")),
    }
    return all_of(
        row_checks(messages, "message_id", said, repeats="message_repeats"),
        violations(issues, "issue_key_shape", "issue_key", "", ~S.valid(F.col("issue_key"), S.TICKET_KEY)),
        violations(commits, "sha_shape", "sha", "", ~S.valid(F.col("sha"), S.SHA)),
        violations(bad, "quarantine_without_reason", "entity_key", F.col("target_table"), S.present(F.col("reason")).isNull()),
    )


def check_order(df: DataFrame, group: list[str], order: str, ts: str, check: str) -> DataFrame:
    """Rows whose time is before that of the row before them; rows without a time are passed over. A group may hold most of
    the rows."""
    rows = Scan(df.where(F.col(ts).isNotNull()), group, [order]).last_before("__prev", F.col(ts)).rows
    return violations(rows, check, F.concat_ws("|", *group, order), F.col("__prev"), F.col(ts) < F.col("__prev"))


def check_bronze_shape(archives: DataFrame, histories: DataFrame, issues: DataFrame) -> DataFrame:
    """Landed exports: declared and real message counts agree, ids are snowflakes, messages and histories are in order, and
    histories lie in their issue's lifetime.

    archives: normalised messages with source_file, ordinal, message_id, ts, declared; histories: issue_key, position, ts;
    issues: issue_key, created_at, updated_at."""
    counted = archives.groupBy("source_file").agg(F.count(F.lit(1)).alias("__n"), F.max("declared").alias("__declared"))
    files = Scan(archives, ["source_file"], ["ordinal"]).last_before("__prev", F.col("ts")).rows
    lives = Scan(histories, ["issue_key"], ["position"]).last_before("__prev", F.col("ts")).rows
    lives = lives.join(issues.groupBy("issue_key").agg(F.collect_set(F.struct("created_at", "updated_at")).alias("__lives")), "issue_key", "left")
    return all_of(
        violations(counted, "message_count", "source_file", F.concat_ws("/", "__n", "__declared"), F.col("__n") != F.col("__declared")),
        _keyed_checks(files, {
            "message_id_shape": (~S.valid(F.col("message_id"), S.SNOWFLAKE), F.col("message_id"), F.col("source_file")),
            "message_order": (F.col("ts") < F.col("__prev"), F.concat_ws("|", "source_file", "ordinal"), F.col("__prev")),
        }),
        _keyed_checks(lives, {
            "history_order": (F.col("ts") < F.col("__prev"), F.concat_ws("|", "issue_key", "position"), F.col("__prev")),
            "history_outside_issue": (F.exists("__lives", lambda x: (F.col("ts") < x["created_at"]) | (F.col("ts") > x["updated_at"])), F.col("issue_key"), F.col("ts")),
        }),
    )


def check_git(commits: DataFrame, pulls: DataFrame) -> DataFrame:
    """Commits and pull requests: parents and merge commits exist, merges have two parents, nothing is merged more than a
    second before its merge commit was made."""
    parents = commits.select(F.explode("parent_shas").alias("sha"), F.lit(False).alias("merge"), F.col("sha").cast("string").alias("key"))
    merges = pulls.where("merged").select(F.col("merge_sha").alias("sha"), F.lit(True).alias("merge"), F.col("pr_number").cast("string").alias("key"), "merged_at")
    made = commits.select(F.col("sha").alias("__sha"), "authored_at", F.size("parent_shas").alias("n"), F.row_number().over(Window.partitionBy("sha").orderBy("authored_at")).alias("__i"))
    asks = parents.unionByName(merges, allowMissingColumns=True).join(made, F.col("sha") == F.col("__sha"), "left").where(F.col("merge") | F.coalesce(F.col("__i") == 1, F.lit(True)))
    gone, merge = F.col("sha").isNotNull() & F.col("__sha").isNull(), F.col("merge")
    return _keyed_checks(asks, {
        "parent_unknown": (~merge & gone, F.col("key"), F.col("sha")),
        "merge_unknown": (merge & gone, F.col("key"), F.col("sha")),
        "merge_parents": (merge & (F.col("n") != 2), F.col("key"), F.col("n")),
        "merged_before_commit": (merge & (F.unix_seconds("merged_at") < F.unix_seconds("authored_at") - 1), F.col("key"), F.col("merged_at")),
    })


def check_cross_stream(windows: DataFrame, messages: DataFrame, pulls: DataFrame, issues: DataFrame, minutes: int = 30) -> DataFrame:
    """Reference windows (task_id, ticket, pr_number, start_ts, end_ts): ticket and pull request are spoken of, a message
    stands near the start, and the ticket's creation and the merge lie inside."""
    said = messages.select(F.explode("mentions_ticket").alias("ticket"), "ts")
    prs = messages.select(F.explode("mentions_pr").alias("pr_number")).distinct()
    near = windows.join(said, "ticket").where(F.abs(F.unix_seconds("ts") - F.unix_seconds("start_ts")) <= minutes * 60).select("task_id").distinct()
    made = windows.join(issues.select(F.col("issue_key").alias("ticket"), "created_at"), "ticket")
    merged = windows.join(pulls.select("pr_number", "merged_at"), "pr_number")
    outside = lambda c: ~F.coalesce(F.col(c).between(F.col("start_ts"), F.col("end_ts")), F.lit(False))
    return all_of(
        violations(windows.join(said.select("ticket").distinct(), "ticket", "left_anti"), "ticket_unspoken", "task_id", F.col("ticket")),
        violations(windows.where("pr_number IS NOT NULL").join(prs, "pr_number", "left_anti"), "pull_unspoken", "task_id", F.col("pr_number")),
        violations(windows.join(near, "task_id", "left_anti"), "no_message_near_start", "task_id"),
        violations(made, "created_outside", "task_id", F.col("created_at"), outside("created_at")),
        violations(merged, "merged_outside", "task_id", F.col("merged_at"), outside("merged_at")),
    )


def defect_count(messages: DataFrame, id: str = "message_id", text: str = "content", ts: str = "ts_raw") -> DataFrame:
    """One row (blank, repeated, untyped, total): how dirty landed messages are."""
    per = messages.groupBy(id).agg(F.count(F.lit(1)).alias("n"), F.count_if(F.coalesce(F.trim(text), F.lit("")) == "").alias("b"), F.count_if(S.parse_ts(F.col(ts), strict=True)["ts"].isNull()).alias("u"))
    found = per.agg(F.coalesce(F.sum("b"), F.lit(0)).alias("blank"), F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("repeated"), F.coalesce(F.sum("u"), F.lit(0)).alias("untyped"))
    return found.withColumn("total", F.col("blank") + F.col("repeated") + F.col("untyped"))


def check_gold(windows: DataFrame, chunks: DataFrame, patches: DataFrame, expected_eval: int | None = None, least_patch: int = 200) -> DataFrame:
    """Sliced windows: none empty, each longer than nothing, patches are diffs of some size, as many in `eval` as expected."""
    held = windows.join(chunks.select(F.col("window_id").alias("__held")).distinct(), F.col("window_id") == F.col("__held"), "left")
    parts = [
        _keyed_checks(held, {
            "window_empty": (F.col("__held").isNull(), F.col("window_id"), F.lit("")),
            "no_duration": (~F.coalesce(F.col("end_ts") > F.col("start_ts"), F.lit(False)), F.col("window_id"), F.lit("")),
        }),
        violations(patches, "patch_not_a_diff", "window_id", F.length("patch"), ~F.coalesce(F.contains("patch", F.lit("diff --git ")), F.lit(False)) | (F.length("patch") < least_patch)),
    ]
    if expected_eval is not None:
        n = windows.agg(F.count_if(F.col("split") == "eval").alias("n"))
        parts.append(violations(n, "eval_count", F.lit("eval"), F.col("n"), F.col("n") != expected_eval))
    return all_of(*parts)


def recall_gate(score: DataFrame, least: float = 0.9) -> DataFrame:
    """score_windows' row, if it matched less than the wanted share of the references."""
    return violations(score, "recall", F.lit("windows"), F.concat_ws("/", "matched", "references"), F.col("matched") < least * F.col("references"))


def check_constraints(df: DataFrame, pk: list[str], checks: dict[str, str]) -> DataFrame:
    """The primary key is unique and each condition (name: SQL text) holds; null does not violate, as in a CHECK."""
    key = F.concat_ws("|", *[F.col(c).cast("string") for c in pk])
    parts = [violations(df, name, key, text, F.expr(f"NOT ({text})")) for name, text in checks.items()]
    return all_of(repeated_keys(df, pk, "primary_key"), *parts)


def check_schema(df: DataFrame, schema: StructType) -> DataFrame:
    """Columns that are missing, not wanted, or of another type. Only schemas are compared."""
    have, want = ({f.name: f.dataType.simpleString() for f in s.fields} for s in (df.schema, schema))
    rows = [("column_missing", c, want[c]) for c in want if c not in have] + [("column_extra", c, have[c]) for c in have if c not in want]
    rows += [("column_type", c, f"{have[c]} instead of {want[c]}") for c in want if c in have and have[c] != want[c]]
    return df.sparkSession.createDataFrame(rows, "check string, key string, detail string")
