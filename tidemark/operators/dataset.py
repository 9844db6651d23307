"""Training sets from recorded runs: ordered conversations, splits, timelines, and the window functions they need."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions import scalars as S
from tidemark.operators import windows as slices
from tidemark.operators.scan import Scan, by_place

_CALLS = "array<struct<id: string, name: string, arguments: string>>"
MESSAGE = f"struct<role: string, content: string, tool_calls: {_CALLS}, tool_call_id: string, name: string>"
RESULT_LIMIT, SLICE_LIMIT = 12_000, 6_000


def newest_per(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """The first row of each key in the given order."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("__rn", F.row_number().over(w)).where("__rn = 1").drop("__rn")


def top_k(df: DataFrame, by: list[Column], k: int, per: list[str] | None = None) -> DataFrame:
    """The first k rows, of each group where one is named."""
    if not per:
        return df.orderBy(*by).limit(k)
    return df.withColumn("__rn", F.row_number().over(Window.partitionBy(*per).orderBy(*by))).where(F.col("__rn") <= k).drop("__rn")


def position_flags(df: DataFrame, group: list[str], order: list[str]) -> DataFrame:
    """ordinal (from 0), is_start and is_end of each row in its group."""
    w = Window.partitionBy(*group).orderBy(*order)
    n = F.count(F.lit(1)).over(Window.partitionBy(*group))
    rows = df.withColumns({"ordinal": F.row_number().over(w) - 1, "__n": n})
    return rows.withColumns({"is_start": F.col("ordinal") == 0, "is_end": F.col("ordinal") == F.col("__n") - 1}).drop("__n")


def fold_timeline(df: DataFrame, group: list[str], pos: str, kind: str, text: str) -> DataFrame:
    """Consecutive rows of one kind become one: (group, kind, first_pos, n, text), texts joined in order. pos are whole
    numbers; a group may hold most of the rows, but the text of what becomes one row has to fit into it."""
    scan = Scan(df, group, [pos], by_place(pos)).row_before("__prev", F.col(kind))
    starts = F.when(F.col("__prev").isNotNull() & F.col("__prev.v").eqNullSafe(F.col(kind)), 0).otherwise(1)
    islands = scan.total("__island", starts).result()
    ordered = F.array_sort(F.collect_list(F.struct(pos, F.coalesce(text, F.lit("")).alias("t"))))
    found = islands.groupBy(*group, "__island", kind).agg(F.min(pos).alias("first_pos"), F.count(F.lit(1)).alias("n"), ordered.alias("__t"))
    return found.withColumn("text", F.array_join(F.transform("__t", lambda x: x["t"]), "")).drop("__t", "__island")


def pair_calls(df: DataFrame, calls: str = "calls", results: str = "results") -> DataFrame:
    """One row for each call with the result at its place; step counts from 0."""
    own = [c for c in df.columns if c not in (calls, results)]
    zipped = F.arrays_zip(F.col(calls).alias("call"), F.col(results).alias("result"))
    return df.select(*own, F.posexplode(zipped).alias("step", "z")).select(*own, "step", "z.call", "z.result")


def trajectory_rows(turns: DataFrame) -> DataFrame:
    """Recorded turns (run_id, window_id, turn, content, calls array<struct<name, args>>, results array<struct<output, ok>>)
    to one row a call, or one row for a turn without calls."""
    none = F.coalesce(F.size("calls"), F.lit(0)) <= 0
    spoken = turns.where(none).select("run_id", "window_id", "turn", F.lit(0).alias("step"), "content", *[F.lit(None).cast("string").alias(c) for c in ("tool_name", "tool_args", "tool_result")], F.lit(None).cast("boolean").alias("tool_ok"))
    called = pair_calls(turns.where(~none).select("run_id", "window_id", "turn", "content", "calls", "results"))
    called = called.select("run_id", "window_id", "turn", "step", F.when(F.col("step") == 0, F.col("content")).alias("content"), F.col("call.name").alias("tool_name"), F.col("call.args").alias("tool_args"), F.col("result.output").alias("tool_result"), F.col("result.ok").alias("tool_ok"))
    return spoken.unionByName(called).withColumn("role", F.lit("assistant"))


def _message(role: str, content: Column, calls: Column | None = None, call_id: Column | None = None, name: Column | None = None) -> Column:
    none = F.lit(None)
    parts = (F.lit(role), content, none if calls is None else calls, none if call_id is None else call_id, none if name is None else name)
    return F.struct(*[p.alias(n) for p, n in zip(parts, ("role", "content", "tool_calls", "tool_call_id", "name"), strict=True)]).cast(MESSAGE)


def build_conversations(runs: DataFrame, steps: DataFrame, windows: DataFrame, tools: list[str], system: str) -> DataFrame:
    """(window_id, run_id, messages, n_tool_calls, dropped_tool_names) of the newest succeeded run of each window.

    A turn is its first prose with its calls, then their results in order. Calls of tools that are not in `tools` are
    dropped and counted. Call ids are made from run, turn and step, so they never change. The run's final text closes the
    conversation unless it is there already. Only conversations that use a tool and end on an assistant that says
    something are kept."""
    newest = newest_per(runs.where(F.col("status") == "succeeded"), ["window_id"], [F.desc_nulls_last("finished_at"), F.desc("id")])
    mine = steps.join(newest.select(F.col("id").alias("run_id")), "run_id", "left_semi")
    call_id = F.concat(F.lit("call_"), S.content_id(F.col("run_id"), F.col("turn"), F.col("step"), length=16))
    rows = mine.withColumns({"__known": F.col("tool_name").isin(tools), "__id": call_id})
    call = F.struct("step", F.struct(F.col("__id").alias("id"), F.col("tool_name").alias("name"), F.coalesce("tool_args", F.lit("{}")).alias("arguments")).alias("c"))
    result = F.struct("step", _message("tool", F.substring(F.coalesce("tool_result", F.lit("")), 1, RESULT_LIMIT), None, F.col("__id"), F.col("tool_name")).alias("m"))
    turns = rows.groupBy("run_id", "turn").agg(
        F.min_by("content", F.when(S.present(F.col("content")).isNotNull(), F.col("step"))).alias("prose"),
        F.transform(F.array_sort(F.collect_list(F.when(F.col("__known"), call))), lambda x: x["c"]).alias("calls"),
        F.transform(F.array_sort(F.collect_list(F.when(F.col("__known"), result))), lambda x: x["m"]).alias("results"),
        F.count_if(F.col("tool_name").isNotNull() & ~F.col("__known")).alias("dropped"),
    )
    said = S.present(F.col("prose")).isNotNull()
    made = F.when(F.size("calls") > 0, F.concat(F.array(_message("assistant", S.present(F.col("prose")), F.col("calls"))), F.col("results")))
    made = made.when(said, F.array(_message("assistant", F.col("prose")))).otherwise(F.array().cast(f"array<{MESSAGE}>"))
    bodies = turns.groupBy("run_id").agg(
        F.flatten(F.transform(F.array_sort(F.collect_list(F.struct("turn", made.alias("m")))), lambda x: x["m"])).alias("body"),
        F.sum(F.size("calls")).alias("n_tool_calls"), F.sum("dropped").alias("dropped_tool_names"),
    )
    full = newest.select(F.col("id").alias("run_id"), "window_id", "final").join(bodies, "run_id").join(windows.select("window_id", "title", "summary"), "window_id")
    opening = F.array(_message("system", F.lit(system)), _message("user", F.concat_ws("\n\n", "title", "summary")))
    final = S.present(F.trim(F.col("final")))
    last = F.get("body", F.size("body") - 1)["content"]
    closing = F.when(final.isNull() | F.coalesce(F.trim(last) == final, F.lit(False)), F.array().cast(f"array<{MESSAGE}>")).otherwise(F.array(_message("assistant", final)))
    done = full.withColumn("messages", F.concat(opening, "body", closing))
    end = F.element_at("messages", -1)
    sound = F.exists("messages", lambda m: m["role"] == "tool") & (end["role"] == "assistant") & (F.coalesce(F.trim(end["content"]), F.lit("")) != "")
    return done.where(sound & (F.size("messages") >= 3)).select("window_id", "run_id", "messages", "n_tool_calls", "dropped_tool_names")


def _said() -> Column:
    return F.coalesce(F.get_json_object("row", "$.content"), F.get_json_object("row", "$.message"), F.get_json_object("row", "$.title"))


def _examples(windows: DataFrame, body: DataFrame, system: str) -> DataFrame:
    answer = F.coalesce(S.present(F.col("summary")), S.present(F.col("title")))
    return windows.join(body, "window_id").where(answer.isNotNull()).select("window_id", F.array(_message("system", F.lit(system)), _message("user", F.col("body")), _message("assistant", answer)).alias("messages"))


def examples_from_slices(windows: DataFrame, chunks: DataFrame, system: str, limit: int = SLICE_LIMIT) -> DataFrame:
    """(window_id, messages): system, the text of the window's slice as the user, its summary as the assistant."""
    said = chunks.select("window_id", "ts", "source_table", "ordinal", F.substring(_said(), 1, limit).alias("t")).where("t IS NOT NULL")
    upto = Window.partitionBy("window_id").orderBy("ts", "source_table", "ordinal").rowsBetween(Window.unboundedPreceding, -1)
    first = said.withColumn("before", F.coalesce(F.sum(F.length("t") + 1).over(upto), F.lit(0))).where(F.col("before") < limit)  # the rest would be cut off
    lines = first.groupBy("window_id").agg(F.array_sort(F.collect_list(F.struct("ts", "source_table", "ordinal", "t"))).alias("x"))
    body = lines.select("window_id", F.substring(F.array_join(F.transform("x", lambda x: x["t"]), "\n"), 1, limit).alias("body"))
    return _examples(windows, body, system)


def examples_from_streams(windows: DataFrame, silver: dict[str, DataFrame], system: str, limit: int = SLICE_LIMIT) -> DataFrame:
    """The examples of examples_from_slices, of the streams themselves: a window reads no more than the text that it shows, so
    the work is in proportion to records, windows and what they show, not to what they hold."""
    if not slices._repeated(windows).isEmpty():
        return examples_from_slices(windows, slices.slice_chunks(windows, silver), system, limit)
    lines = slices._long(silver, None, None).select(F.lit("all").alias("section"), "ts", "source_table", "source_key", F.substring(_said(), 1, limit).alias("t"))
    body = slices.window_texts(windows, lines, ["all"], ["source_table", "source_key"], limit)
    return _examples(windows, body.select("window_id", F.col("text").alias("body")), system)


def split_dataset(df: DataFrame, id: str, seed: str = "0", val_fraction: float = 0.15, held: DataFrame | None = None) -> DataFrame:
    """df with split: a fixed share of the rows, one at least, is `val`, the same ones for the same seed. Rows whose id is
    in `held` (the evaluation windows) are left out. The order is that of a digest; which rows come first is decided in
    buckets of the digest, so rows are not gathered: a bucket is whole or is cut inside."""
    rows = df if held is None else df.join(held.select(id).distinct(), id, "left_anti")
    rows = rows.withColumn("__d", F.md5(F.concat(F.col(id).cast("string"), F.lit(f":{seed}"))))
    counts = rows.groupBy(F.substring("__d", 1, 3).alias("__b")).agg(F.count(F.lit(1)).alias("n"))  # 4096 buckets
    upto = F.sum("n").over(Window.orderBy("__b").rowsBetween(Window.unboundedPreceding, Window.currentRow))
    total = F.sum("n").over(Window.partitionBy(F.lit(1)))
    wanted = F.greatest(F.lit(1).cast("bigint"), F.floor(total * F.lit(str(val_fraction)).cast("decimal(10,6)")).cast("bigint"))
    edge = counts.select("__b", wanted.alias("__k"), (upto - F.col("n")).alias("__before"), upto.alias("__upto"))
    placed = rows.withColumn("__b", F.substring("__d", 1, 3)).join(F.broadcast(edge), "__b")
    inside = placed.where("__upto > __k AND __before < __k")
    cut = inside.withColumn("__rn", F.row_number().over(Window.partitionBy("__b").orderBy("__d", id)) + F.col("__before"))
    whole = placed.where("NOT (__upto > __k AND __before < __k)").withColumn("__rn", F.when(F.col("__upto") <= F.col("__k"), F.lit(0)).otherwise(F.col("__k") + 1))
    return whole.unionByName(cut).withColumn("split", F.when(F.col("__rn") <= F.col("__k"), "val").otherwise("train")).drop("__d", "__b", "__k", "__before", "__upto", "__rn")


def timeline_to_messages(df: DataFrame, group: str, pos: str) -> DataFrame:
    """(group, messages): interactions' raw messages in order: those of the timeline, else of thinking then output; entries
    without one are skipped. The three columns are arrays of struct<raw_message: string>."""
    entries = F.when(F.coalesce(F.size("timeline"), F.lit(0)) > 0, F.col("timeline")).otherwise(
        F.concat(F.coalesce("thinking", F.array().cast(df.schema["thinking"].dataType)), F.coalesce("output", F.array().cast(df.schema["output"].dataType)))
    )
    said = F.transform(F.filter(entries, lambda e: e["raw_message"].isNotNull()), lambda e: e["raw_message"])
    ordered = F.array_sort(F.collect_list(F.struct(pos, said.alias("m"))))
    return df.groupBy(group).agg(F.flatten(F.transform(ordered, lambda x: x["m"])).alias("messages"))


def masked(df: DataFrame) -> DataFrame:
    """trainable (a flag for each message) and approx_tokens of a conversation."""
    size = F.aggregate("messages", F.lit(0), lambda n, m: n + F.coalesce(F.length(m["content"]), F.lit(0)))
    return df.withColumns({"trainable": S.trainable_mask(F.col("messages")), "approx_tokens": F.floor(size / 4).cast("bigint")})
