"""Task windows: found by rule or proposed, checked against evidence, scored, chosen, and used to slice every stream."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions import scalars as S
from tidemark.operators.interval import count_by_windows, slice_by_windows
from tidemark.operators.links import nearest, prs_by_ticket
from tidemark.operators.scan import Scan
from tidemark.sources import sinks

CLOSED = "Done"


def last_done(events: DataFrame, value: str = CLOSED) -> DataFrame:
    """(issue_key, done_at): the last change of a ticket's status to `value`."""
    done = events.where((F.lower("field") == "status") & (F.col("to_value") == value))
    return done.groupBy("issue_key").agg(F.max("ts").alias("done_at"))


def ticket_messages(messages: DataFrame) -> DataFrame:
    return messages.select(F.explode("mentions_ticket").alias("issue_key"), "message_id", "ts", "author_name", "content")


def history_bounds(*streams: tuple[DataFrame, str]) -> DataFrame:
    """(first_ts, last_ts) over the named time column of each stream, in one row."""
    times = reduce(DataFrame.unionByName, [df.agg(F.min(ts).alias("a"), F.max(ts).alias("b")) for df, ts in streams])
    return times.agg(F.min("a").alias("first_ts"), F.max("b").alias("last_ts"))


def participants(windows: DataFrame, messages: DataFrame, author: str = "author_name") -> DataFrame:
    """(window_id, participants): the sorted authors of the messages inside each window, by counts, not by pairs."""
    inside = count_by_windows(windows.select("window_id", "start_ts", "end_ts"), messages.select("ts", author), "ts", author)
    return inside.groupBy("window_id").agg(F.array_sort(F.collect_set(author)).alias("participants"))


def baseline_windows(messages: DataFrame, issues: DataFrame, events: DataFrame, pulls: DataFrame, use_done: bool = True) -> DataFrame:
    """One window for each ticket that has messages and was closed or has a merged pull request: from the first message or
    the ticket's creation to the closing or the last merge. Windows that end before they start are dropped. Cites the
    ticket's messages inside; confidence 1."""
    said = ticket_messages(messages)
    talk = said.groupBy("issue_key").agg(F.min("ts").alias("first_msg"))
    merged = prs_by_ticket(messages, pulls.where("merged")).withColumnRenamed("ticket", "issue_key")
    numbers = merged.select("issue_key", F.explode("pr_numbers").alias("pr_number")).join(pulls.select("pr_number", "merged_at", "merge_sha"), "pr_number")
    merges = numbers.groupBy("issue_key").agg(F.max("merged_at").alias("last_merge"), F.array_sort(F.collect_set("pr_number")).alias("pr_numbers"), F.array_sort(F.collect_set("merge_sha")).alias("merge_shas"))
    base = issues.select("issue_key", "summary", "created_at").join(talk, "issue_key").join(merges, "issue_key", "left")
    base = base.join(last_done(events), "issue_key", "left") if use_done else base.withColumn("done_at", F.lit(None).cast("timestamp"))
    base = base.where(F.col("done_at").isNotNull() | F.col("last_merge").isNotNull())
    base = base.withColumns({"start_ts": F.least("first_msg", "created_at"), "end_ts": F.greatest("done_at", "last_merge")}).where("end_ts >= start_ts")
    spans = base.select("issue_key", "start_ts", "end_ts")
    cited = said.join(spans, "issue_key").where("ts >= start_ts AND ts <= end_ts").groupBy("issue_key").agg(
        F.array_sort(F.collect_set("message_id")).alias("message_ids"), F.array_sort(F.collect_set("author_name")).alias("participants")
    )
    none = F.array().cast("array<string>")
    evidence = F.struct(
        F.coalesce("message_ids", none).alias("message_ids"), F.col("issue_key").alias("ticket"), F.coalesce("pr_numbers", F.array().cast("array<int>")).alias("pr_numbers"),
        F.coalesce("merge_shas", none).alias("merge_shas"),
    )
    return base.join(cited, "issue_key", "left").select(
        F.lower("issue_key").alias("task_id"), F.col("summary").alias("title"), "start_ts", "end_ts", F.lit(1.0).alias("confidence"),
        F.coalesce("participants", none).alias("participants"), evidence.alias("evidence"), F.lit("baseline").alias("produced_by"),
    )


def incremental_windows(home: str, messages: DataFrame, issues: DataFrame, events: DataFrame, pulls: DataFrame, use_done: bool = True) -> DataFrame:
    """Take up new or changed records and bring the rule windows under `home` up to date; returns the tickets looked at.

    Records are kept dealt out by ticket (messages once for each ticket that they name, issues, status changes) and pull
    requests by number, beside a table of the tickets that are named together with a number. A ticket is touched by its
    messages, its issue, its changes, and by pull requests named with it, however long ago. For the touched ones only, the
    kept records are read again, buckets of others are not, windows are found as by baseline_windows, and take the place of
    the old ones; a ticket that has none any more loses its window. Taking up the same records again changes nothing."""
    spark = messages.sparkSession

    def last(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
        """Of several records of a key in one batch the last one."""
        rest = F.struct(*[c for c in df.columns if c not in keys])
        found = df.groupBy(*keys).agg(F.max_by(rest, F.struct(*[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in order])).alias("x"))
        return found.select(*keys, "x.*")

    said = last(messages.select(F.explode(F.array_distinct("mentions_ticket")).alias("issue_key"), "message_id", "ts", "author_name", "mentions_pr"), ["issue_key", "message_id"], ["ts"])
    changes = last(events.select("issue_key", "id", "ts", "field", "to_value"), ["issue_key", "id"], ["ts"])
    newest = ["updated_at"] if "updated_at" in issues.columns else []
    facts = last(issues.select("issue_key", "summary", "created_at", *newest), ["issue_key"], [*newest, "created_at"]).select("issue_key", "summary", "created_at")
    merges = last(pulls.select("pr_number", "merged", "merged_at", "merge_sha"), ["pr_number"], ["merged", "merged_at"])
    named = said.select("issue_key", F.explode("mentions_pr").alias("pr_number")).distinct()
    for name, rows, keys, by in (("said", said, ["issue_key", "message_id"], "issue_key"), ("changes", changes, ["issue_key", "id"], "issue_key"), ("issues", facts, ["issue_key"], "issue_key"),
                                 ("pulls", merges, ["pr_number"], "pr_number"), ("named", named, ["pr_number", "issue_key"], "pr_number")):
        sinks.upsert(spark, f"{home}/{name}", rows, keys, deal_by=[by])

    def kept(name: str, like: DataFrame, keys: DataFrame) -> DataFrame:
        return sinks.read_buckets(spark, f"{home}/{name}", keys) if sinks.is_dealt(spark, f"{home}/{name}") else like.limit(0)

    through = kept("named", named, merges.select("pr_number")).select("issue_key")
    touched = sinks.settled(reduce(DataFrame.unionByName, [x.select("issue_key") for x in (said, changes, facts, through)]).distinct(), "touched")
    own = kept("said", said, touched)
    numbers = own.select(F.explode("mentions_pr").alias("pr_number")).distinct()
    found = baseline_windows(
        own.select("message_id", "ts", "author_name", F.lit(None).cast("string").alias("content"), F.array("issue_key").alias("mentions_ticket"), "mentions_pr"),
        kept("issues", facts, touched), kept("changes", changes, touched), kept("pulls", merges, numbers), use_done,
    )
    sinks.replace(spark, f"{home}/windows", touched.select(F.lower("issue_key").alias("task_id")), found)
    return touched


def nearest_windows(messages: DataFrame, events: DataFrame, pulls: DataFrame) -> DataFrame:
    """Windows of tickets that are closed and named together with a merged pull request: the request merged nearest to the
    closing counts. From the first message to the closing or the merge, whichever is later."""
    talk = ticket_messages(messages).groupBy("issue_key").agg(F.min("ts").alias("start_ts"))
    pairs = prs_by_ticket(messages, pulls.where("merged")).select(F.col("ticket").alias("issue_key"), F.explode("pr_numbers").alias("pr_number"))
    pairs = pairs.join(pulls.select("pr_number", "merged_at"), "pr_number").select("issue_key", "merged_at", "pr_number")
    found = nearest(last_done(events), pairs, "issue_key", "done_at", "merged_at", "pr_number").where("pr_number IS NOT NULL")
    return found.join(talk, "issue_key").select(
        F.col("issue_key").alias("task_id"), "start_ts", F.greatest("done_at", "merged_at").alias("end_ts"), "pr_number",
        S.closing_confidence(F.col("done_at"), F.col("merged_at")).alias("confidence"),
    )


def validate_windows(proposals: DataFrame, messages: DataFrame, issues: DataFrame, pulls: DataFrame, bounds: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Proposed windows (task_id, title, summary, start_ts, end_ts as epoch texts, confidence, participants, evidence) to
    (kept, dropped with a reason).

    Kept ones have whole-number bounds in order, lie inside the history (a day's grace), cite at least one message that
    exists, and rest on a message or a merged pull request. An unknown ticket becomes null; cited ids that do not exist
    are listed as hallucinated; participants are the claimed ones, else the authors inside."""
    p = proposals.withColumns({"__n": S.content_id(F.col("task_id"), F.col("start_ts"), F.col("end_ts"), F.to_json("evidence")), "__s": F.col("start_ts").try_cast("bigint"), "__e": F.col("end_ts").try_cast("bigint")})
    p = p.dropDuplicates(["__n"])
    cited = p.select("__n", F.explode("evidence.message_ids").alias("message_id")).distinct()
    known = cited.join(messages.select("message_id").distinct().withColumn("__known", F.lit(True)), "message_id", "left")
    proof = known.groupBy("__n").agg(
        F.array_sort(F.collect_set(F.when(F.col("__known"), F.col("message_id")))).alias("__verified"),
        F.array_sort(F.collect_set(F.when(F.col("__known").isNull(), F.col("message_id")))).alias("__invented"),
    )
    numbers = p.select("__n", F.explode("evidence.pr_numbers").alias("pr_number")).join(pulls.where("merged").select("pr_number").distinct(), "pr_number", "left_semi")
    merged = numbers.groupBy("__n").agg(F.array_sort(F.collect_set("pr_number")).alias("__merged"))
    tickets = issues.select(F.col("issue_key").alias("__ticket")).distinct()
    spans = p.where("__s <= __e").select(F.col("__n").alias("proposal"), F.timestamp_seconds("__s").alias("a"), F.timestamp_seconds("__e").alias("b"))
    inside = count_by_windows(spans, messages.select("ts", "author_name"), "ts", "author_name", "proposal", "a", "b")
    authors = inside.groupBy(F.col("proposal").alias("__n")).agg(F.array_sort(F.collect_set("author_name")).alias("__authors"))
    none = F.array().cast("array<string>")
    full = p.join(proof, "__n", "left").join(merged, "__n", "left").join(authors, "__n", "left").join(tickets, F.col("evidence.ticket") == F.col("__ticket"), "left").join(F.broadcast(bounds), F.lit(True))
    full = full.withColumns({"__verified": F.coalesce("__verified", none), "__invented": F.coalesce("__invented", none), "__merged": F.coalesce("__merged", F.array().cast("array<int>"))})
    day = 86_400
    reason = (
        F.when(F.col("__s").isNull() | F.col("__e").isNull(), "bounds are not whole numbers")
        .when(F.col("__e") < F.col("__s"), "ends before it starts")
        .when((F.col("__s") < F.unix_seconds("first_ts") - day) | (F.col("__e") > F.unix_seconds("last_ts") + day), "outside the history")
        .when((F.size("__verified") == 0) & (F.size("__merged") == 0), "no evidence")
        .when(F.size("__verified") == 0, "no verified citation")
    )
    judged = full.withColumn("reason", reason)
    slug = F.trim(F.regexp_replace(F.lower(F.coalesce(S.present(F.col("title")), F.lit("task"))), "[^a-z0-9]+", "-"), F.lit("-"))
    kept = judged.where("reason IS NULL").select(
        F.coalesce(S.present(F.col("task_id")), slug).alias("task_id"), F.coalesce(S.present(F.col("title")), S.present(F.col("task_id")), F.lit("task")).alias("title"), "summary",
        F.timestamp_seconds("__s").alias("start_ts"), F.timestamp_seconds("__e").alias("end_ts"), S.confidence(F.col("confidence")).alias("confidence"),
        F.when(F.size(F.coalesce("participants", none)) > 0, F.col("participants")).otherwise(F.coalesce("__authors", none)).alias("participants"),
        F.struct(F.col("__verified").alias("message_ids"), F.col("__ticket").alias("ticket"), F.col("__merged").alias("pr_numbers"), F.col("evidence.merge_shas").alias("merge_shas"), F.col("__invented").alias("hallucinated")).alias("evidence"),
    )
    return kept, judged.where("reason IS NOT NULL").select("task_id", "start_ts", "end_ts", "reason")


def number_windows(windows: DataFrame, prefix: str = "task") -> DataFrame:
    """window_id: prefix and a running number by start, then task. Rows are ranked inside their day; only a row a day is
    ordered as a whole."""
    days = windows.withColumn("__day", F.coalesce(F.unix_date(F.col("start_ts").cast("date")), F.lit(-(1 << 31))))
    upto = Window.orderBy("__day").rowsBetween(Window.unboundedPreceding, -1)
    before = days.groupBy("__day").agg(F.count(F.lit(1)).alias("__n")).select("__day", F.coalesce(F.sum("__n").over(upto), F.lit(0)).alias("__before"))
    rank = F.row_number().over(Window.partitionBy("__day").orderBy("start_ts", "task_id"))
    n = F.col("__before") + F.col("__rank")
    return days.withColumn("__rank", rank).join(before, "__day").withColumn("window_id", F.format_string(f"{prefix}-%03d", n)).drop("__day", "__rank", "__before")


def match_windows(hyp: DataFrame, ref: DataFrame, key: str = "task_id") -> DataFrame:
    """Both sides by key, the first by start of each; errors of both bounds in seconds."""

    def once(df: DataFrame, a: str, b: str) -> DataFrame:
        first = df.groupBy(key).agg(F.min(F.struct("start_ts", "end_ts")).alias("x"))
        return first.select(key, F.col("x.start_ts").alias(a), F.col("x.end_ts").alias(b))

    both = once(hyp, "hs", "he").join(once(ref, "rs", "re"), key, "full_outer")
    seconds = lambda a, b: F.abs(F.unix_seconds(F.col(a).cast("timestamp")) - F.unix_seconds(F.col(b).cast("timestamp")))
    return both.withColumns({"start_err": seconds("hs", "rs"), "end_err": seconds("he", "re")})


def score_windows(hyp: DataFrame, ref: DataFrame, tol_minutes: int = 5, key: str = "task_id") -> DataFrame:
    """One row: matched, exact (both bounds within the tolerance), precision, recall and f1 of the matches, and how many
    hypotheses no reference knows."""
    m = match_windows(hyp, ref, key)
    hit = F.col("hs").isNotNull() & F.col("rs").isNotNull()
    tol = tol_minutes * 60
    counted = m.agg(
        F.count_if(hit).alias("matched"), F.count_if(hit & (F.col("start_err") <= tol) & (F.col("end_err") <= tol)).alias("exact"),
        F.count_if(F.col("hs").isNotNull()).alias("hypotheses"), F.count_if(F.col("rs").isNotNull()).alias("references"),
        F.count_if(F.col("rs").isNull()).alias("hallucinated"),
    )
    ratio = lambda a, b: F.coalesce(F.try_divide(F.col(a), F.col(b)), F.lit(0.0))
    found = counted.withColumns({"precision": ratio("matched", "hypotheses"), "recall": ratio("matched", "references")})
    return found.withColumn("f1", F.coalesce(F.try_divide(2 * F.col("precision") * F.col("recall"), F.col("precision") + F.col("recall")), F.lit(0.0)))


def worst_windows(hyp: DataFrame, ref: DataFrame, k: int = 5, key: str = "task_id") -> DataFrame:
    m = match_windows(hyp, ref, key).where("start_err IS NOT NULL")
    return m.withColumn("err", F.col("start_err") + F.col("end_err")).orderBy(F.desc("err"), key).limit(k).select(key, "start_err", "end_err", "err")


def agreement(left: DataFrame, right: DataFrame, tol_seconds: int = 300, key: str = "task_id") -> DataFrame:
    """One row: how many ids both have, and for how many both bounds agree."""
    m = match_windows(left, right, key).where("hs IS NOT NULL AND rs IS NOT NULL")
    return m.agg(F.count(F.lit(1)).alias("shared"), F.count_if((F.col("start_err") <= tol_seconds) & (F.col("end_err") <= tol_seconds)).alias("agreed"))


def choose_windows(model: DataFrame, baseline: DataFrame, ref: DataFrame | None = None, source: str = "auto") -> DataFrame:
    """The model's windows or the baseline's: as told by source; else with a reference those that score better (exact, then
    matched; the model's on a tie); else the model's where they agree with four fifths of the baseline's. One row decides."""
    if source in ("model", "baseline"):
        return model if source == "model" else baseline
    if ref is not None:
        a, b = (tuple(score_windows(x, ref).select("exact", "matched").first()) for x in (model, baseline))
        return model if a >= b else baseline
    agreed, total = agreement(model, baseline).first()["agreed"], baseline.select("task_id").distinct().count()
    return model if agreed >= 0.8 * total else baseline


def source_timestamps() -> dict[str, Column]:
    """When a record of each stream counts as having happened."""
    return {
        "messages": F.col("ts"), "changelog": F.col("ts"), "commits": F.col("authored_at"),
        "issues": F.least("created_at", "updated_at"), "pulls": F.coalesce("merged_at", "opened_at"),
    }


#: The natural key of each stream.
KEY_COLUMNS = {"messages": "message_id", "changelog": "id", "commits": "sha", "issues": "issue_key", "pulls": "pr_number"}


def _long(silver: dict[str, DataFrame], stamps: dict[str, Column] | None, keys: dict[str, str] | None) -> DataFrame:
    """(source_table, source_key, ts, row): the records of all streams in one table, row as JSON."""
    stamps, keys = stamps or source_timestamps(), keys or KEY_COLUMNS
    long = []
    for name, df in silver.items():
        long.append(df.select(F.lit(name).alias("source_table"), F.col(keys[name]).cast("string").alias("source_key"), stamps[name].cast("timestamp").alias("ts"), F.to_json(F.struct(*df.columns)).alias("row")))
    return reduce(DataFrame.unionByName, long)


def _hours(ts: str) -> Column:
    """Parts of an hour for running values: a stream or a window may hold most of the rows."""
    return F.floor(F.unix_seconds(ts) / 3600)


def _repeated(windows: DataFrame) -> DataFrame:
    """(window_id): ids of more than one window."""
    return windows.groupBy("window_id").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("window_id")


def slice_chunks(windows: DataFrame, silver: dict[str, DataFrame], stamps: dict[str, Column] | None = None, keys: dict[str, str] | None = None,
                 bucket_seconds: int | None = 3600) -> DataFrame:
    """(window_id, source_table, source_key, ts, ordinal, row): every record of every stream inside each window, in one
    long table; row is the record as JSON, ordinal counts from 1 within window and stream by (ts, key).

    A window holds a stretch of each stream's order, so the ordinal is the record's number in its stream less the number of
    records before the window: pairs of window and record are never shuffled or sorted. Only where an id names several
    windows, their pairs are numbered together."""
    spans, long = windows.select("window_id", "start_ts", "end_ts"), _long(silver, stamps, keys)
    columns = ["window_id", "source_table", "source_key", "ts", F.col("ordinal").cast("int").alias("ordinal"), "row"]
    repeated = _repeated(spans)
    if repeated.isEmpty():
        return _numbered_slices(spans, long, list(silver), bucket_seconds).select(*columns)
    again = repeated.withColumnRenamed("window_id", "__again")
    same = F.col("window_id").eqNullSafe(F.col("__again"))
    once = _numbered_slices(spans.join(again, same, "left_anti"), long, list(silver), bucket_seconds)
    found = slice_by_windows(spans.join(again, same, "left_semi"), long, "ts", bucket_seconds=bucket_seconds)
    return once.select(*columns).unionByName(Scan(found, ["window_id", "source_table"], ["ts", "source_key"], _hours("ts")).number("ordinal").rows.select(*columns))


def _numbered_slices(spans: DataFrame, long: DataFrame, streams: list[str], bucket_seconds: int | None) -> DataFrame:
    """Pairs of records and windows with ordinals, by numbers in the streams."""
    sound, records = spans.where("start_ts <= end_ts"), long.where("ts IS NOT NULL")
    placed = Scan(records, ["source_table"], ["ts", "source_key"], _hours("ts")).number("__number").result()
    asks = sound.select("*", F.explode(F.array(*map(F.lit, streams))).alias("source_table"), F.col("start_ts").cast("timestamp").alias("ts"), F.lit(0).alias("__step"), F.lit(0).cast("bigint").alias("__n"))
    counts = records.groupBy("source_table", "ts").agg(F.count(F.lit(1)).alias("__n")).withColumn("__step", F.lit(1))
    both = asks.unionByName(counts, allowMissingColumns=True)  # what has a window's first instant is not before it
    asked = Scan(both, ["source_table"], ["ts", "__step"], _hours("ts")).total("__before", F.col("__n")).result().where("__step = 0").drop("ts", "__step", "__n")
    found = slice_by_windows(asked, placed, "ts", key="source_table", bucket_seconds=bucket_seconds, spans=sound, rows=records)
    return found.withColumn("ordinal", F.col("__number") - F.col("__before"))


def chunk_counts(windows: DataFrame, silver: dict[str, DataFrame], stamps: dict[str, Column] | None = None) -> DataFrame:
    """(window_id, source_table, n): how many records of each stream slice_chunks finds in each window, without making them."""
    long = _long(silver, stamps, None).select("ts", "source_table")
    return count_by_windows(windows.select("window_id", "start_ts", "end_ts"), long, "ts", "source_table")


def chunk_overlaps(windows: DataFrame, silver: dict[str, DataFrame], stamps: dict[str, Column] | None = None, keys: dict[str, str] | None = None) -> DataFrame:
    """(source_table, source_key, n): records that lie in n > 1 windows. A record lies in as many windows as have started up to
    it less those that ended before it, so no pairs are made."""
    sound = windows.where("start_ts <= end_ts").select(F.col("start_ts").cast("timestamp").alias("a"), F.col("end_ts").cast("timestamp").alias("b"))
    long = _long(silver, stamps, keys).where("ts IS NOT NULL").select("source_table", "source_key", "ts", F.lit(1).alias("step"), F.lit(0).alias("open"))
    bounds = sound.select(F.inline(F.array(F.struct(F.col("a").alias("ts"), F.lit(0).alias("step"), F.lit(1).alias("open")), F.struct(F.col("b").alias("ts"), F.lit(2).alias("step"), F.lit(-1).alias("open")))))
    both = long.unionByName(bounds.groupBy("ts", "step").agg(F.sum("open").alias("open")), allowMissingColumns=True).withColumn("all", F.lit(0))
    inside = Scan(both, ["all"], ["ts", "step"], _hours("ts")).total("n", F.col("open")).result().where("step = 1")
    return inside.groupBy("source_table", "source_key").agg(F.sum("n").alias("n")).where("n > 1")


def empty_windows(windows: DataFrame, chunks: DataFrame) -> DataFrame:
    return windows.join(chunks.select("window_id").distinct(), "window_id", "left_anti")


def ticket_digest(issues: DataFrame, events: DataFrame, messages: DataFrame, pulls: DataFrame, most_lines: int = 12) -> DataFrame:
    """(issue_key, digest): a ticket's summary, status trail, pull requests and discussion as one JSON text."""
    trail = events.where(F.lower("field") == "status").groupBy("issue_key").agg(
        F.transform(F.array_sort(F.collect_list(F.struct("ts", "id", "to_value"))), lambda x: F.struct(S.iso_z(x["ts"]).alias("ts"), x["to_value"].alias("to"))).alias("status_trail")
    )
    said = ticket_messages(messages)
    rank = F.row_number().over(Window.partitionBy("issue_key").orderBy("ts", "message_id", "author_name", "content"))
    first = said.withColumn("n", rank).where(F.col("n") <= most_lines)
    line = F.struct(F.col("message_id").alias("id"), S.iso_z(F.col("ts")).alias("ts"), F.col("author_name").alias("author"), S.clip(F.col("content"), 300).alias("text"))
    lines = first.groupBy("issue_key").agg(F.transform(F.array_sort(F.collect_list(F.struct("n", line.alias("line")))), lambda x: x["line"]).alias("discussion"))
    talk = lines.join(said.groupBy("issue_key").agg(F.count(F.lit(1)).alias("n_messages")), "issue_key")
    numbers = prs_by_ticket(messages, pulls).select(F.col("ticket").alias("issue_key"), F.explode("pr_numbers").alias("pr_number"))
    requests = numbers.join(pulls.select("pr_number", "title", "merged_at"), "pr_number").groupBy("issue_key").agg(
        F.array_sort(F.collect_list(F.struct("pr_number", S.clip(F.col("title"), 120).alias("title"), S.iso_z(F.col("merged_at")).alias("merged_at")))).alias("pulls")
    )
    full = issues.join(trail, "issue_key", "left").join(talk, "issue_key", "left").join(requests, "issue_key", "left")
    made = F.struct(F.col("issue_key").alias("ticket"), S.clip(F.col("summary"), 200).alias("summary"), "status", S.iso_z(F.col("created_at")).alias("created"), "status_trail", "pulls", "discussion", "n_messages")
    return full.select("issue_key", F.to_json(made).alias("digest"))


def orphan_threads(messages: DataFrame, channel: str = "channel", most: int = 200) -> DataFrame:
    """(channel, day, part, messages): messages that name no ticket, in order, by channel and day, in parts of at most
    `most` messages, so that no channel is gathered."""
    loose = messages.where(F.size("mentions_ticket") == 0).withColumn("day", F.col("ts").cast("date"))
    rank = F.row_number().over(Window.partitionBy(channel, "day").orderBy("ts", "message_id"))
    line = F.struct("ts", "message_id", "author_name", S.clip(F.col("content"), 200).alias("text"))
    parts = loose.withColumn("part", F.floor((rank - 1) / most).cast("int"))
    return parts.groupBy(channel, "day", "part").agg(F.array_sort(F.collect_list(line)).alias("messages"))


def prompt_payload(digest: DataFrame, orphans: DataFrame, most_tokens: int = 20_000, ranges: int = 256) -> DataFrame:
    """(kind, part, payload, tokens): the tickets' digests as JSON texts of about most_tokens each (one digest at least), and
    a text for each part of the orphan threads. A part is a range of ticket keys by hash and a number in it; more ranges
    spread more tickets. Nothing is gathered beyond a part."""
    one = digest.select("issue_key", "digest", S.approx_tokens(F.col("digest")).alias("size"), F.pmod(F.crc32(F.col("issue_key").cast("binary")), F.lit(ranges)).cast("int").alias("range"))
    upto = Window.partitionBy("range").orderBy("issue_key").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    placed = one.withColumn("n", F.floor((F.sum("size").over(upto) - F.col("size")) / most_tokens))
    texts = placed.groupBy("range", "n").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("issue_key", "digest"))), lambda x: x["digest"]), ",").alias("t"))
    tickets = texts.select(F.lit("tickets").alias("kind"), F.concat_ws(":", "range", "n").alias("part"), F.concat(F.lit('{"tickets":['), "t", F.lit("]}")).alias("payload"))
    named = F.concat_ws(":", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in orphans.columns if c != "messages"])
    threads = orphans.select(F.lit("threads").alias("kind"), named.alias("part"), F.concat(F.lit('{"threads":['), F.to_json(F.struct(*orphans.columns)), F.lit("]}")).alias("payload"))
    return tickets.unionByName(threads).withColumn("tokens", S.approx_tokens(F.col("payload")))


def task_briefs(windows: DataFrame, chunks: DataFrame, documents: DataFrame) -> DataFrame:
    """(window_id, brief): a task's evidence, documents, counters and duration as one JSON text. chunks are those of
    slice_chunks, or their counts by chunk_counts."""
    n = F.col("n") if "n" in chunks.columns else F.lit(1)
    counts = chunks.groupBy("window_id").agg(*[F.coalesce(F.sum(F.when(F.col("source_table") == t, n)), F.lit(0)).alias(f"n_{t}") for t in KEY_COLUMNS])
    docs = documents.groupBy("window_id").agg(F.array_sort(F.collect_set("path")).alias("documents"))
    full = windows.join(counts, "window_id", "left").join(docs, "window_id", "left")
    made = F.struct(
        "window_id", "task_id", "title", S.iso_z(F.col("start_ts")).alias("start"), S.iso_z(F.col("end_ts")).alias("end"),
        S.minutes_between(F.col("start_ts"), F.col("end_ts")).alias("duration_minutes"), "participants", "evidence",
        F.coalesce("documents", F.array().cast("array<string>")).alias("documents"), *[F.coalesce(f"n_{t}", F.lit(0)).alias(t) for t in KEY_COLUMNS],
    )
    return full.select("window_id", F.to_json(made).alias("brief"))


#: Streams that are rendered, and what their section is called.
SECTIONS = {"messages": "chat", "changelog": "events", "commits": "commits", "pulls": "pull_requests"}


def _line() -> Column:
    """The line of a record (source_table, source_key, ts, row) in its section."""
    j = lambda p: F.coalesce(F.get_json_object("row", f"$.{p}"), F.lit(""))
    at = S.iso_z(F.col("ts"))
    return (
        F.when(F.col("source_table") == "messages", F.concat(F.lit("["), at, F.lit("] "), j("author_name"), F.lit(": "), j("content")))
        .when(F.col("source_table") == "changelog", F.concat(F.lit("["), at, F.lit("] "), j("issue_key"), F.lit(" "), j("field"), F.lit(": "), j("from_value"), F.lit(" -> "), j("to_value")))
        .when(F.col("source_table") == "commits", F.concat(F.substring("source_key", 1, 8), F.lit(" "), j("author_name"), F.lit(": "), j("message")))
        .when(F.col("source_table") == "pulls", F.concat(F.lit("#"), j("pr_number"), F.lit(" "), j("title"), F.lit(" ("), j("author"), F.lit(")")))
    )


def _section() -> Column:
    return F.element_at(F.create_map(*[F.lit(x) for pair in SECTIONS.items() for x in pair]), F.col("source_table"))


def render_evidence(windows: DataFrame, chunks: DataFrame, most_lines: int | None = 2000) -> DataFrame:
    """(window_id, title, section, part, text): the slice of each window as text, line by line in order, in sections (chat,
    events, commits, pull_requests) and parts of most_lines lines each, numbered from 0; nothing is gathered beyond a part.
    most_lines None: a section is one part. A window without any lines has one row without a section."""
    part = F.lit(0) if most_lines is None else F.floor((F.col("ordinal") - 1) / most_lines).cast("int")
    lines = chunks.where(F.col("source_table").isin(list(SECTIONS))).select("window_id", _section().alias("section"), part.alias("part"), "ordinal", _line().alias("line"))
    ordered = F.array_sort(F.collect_list(F.struct("ordinal", "line")))
    bodies = lines.where("line IS NOT NULL").groupBy("window_id", "section", "part").agg(F.array_join(F.transform(ordered, lambda x: x["line"]), "\n").alias("text"))
    return windows.select("window_id", "title").join(bodies, "window_id", "left")


def render_streams(windows: DataFrame, silver: dict[str, DataFrame], stamps: dict[str, Column] | None = None, keys: dict[str, str] | None = None) -> DataFrame:
    """(window_id, section, text): the whole text of each section of each window, as render_evidence has it in parts, by
    window_texts."""
    if not _repeated(windows).isEmpty():
        found = render_evidence(windows.withColumn("title", F.lit(None).cast("string")).dropDuplicates(["window_id"]), slice_chunks(windows, silver, stamps, keys), None)
        return found.where("section IS NOT NULL").select("window_id", "section", "text")
    told = {name: df for name, df in silver.items() if name in SECTIONS}
    lines = _long(told, stamps, keys).select(_section().alias("section"), "ts", "source_key", _line().alias("t"))
    return window_texts(windows, lines, [SECTIONS[name] for name in told], ["source_key"])


#: The longest text of a window, in characters, of the first level of window_texts, and how many times longer that of each next is.
BLOCK, WIDER = 4096, 4
#: How many levels below one that windows need share its blocks, and how many such texts long the stretch of a block is.
NEAR, STRIDE = 2, 2
#: How many ids of one text a row holds, about, and from how many windows a text on texts are dealt out in shares of ALIKE
#: characters of different texts, of MOST_SHARES shares at most.
IDS, SHARED, ALIKE, MOST_SHARES = 4096, 4, 400_000, 10_000


def _blocks(needed: list[int], levels: int = 11) -> list[int]:
    """For each level the one whose blocks its windows use: the highest needed one, and others only for windows far shorter."""
    kept: list[int] = []
    for i in sorted(needed, reverse=True):
        if not kept or kept[-1] - i > NEAR:
            kept.append(i)
    return [min((k for k in kept if k >= i), default=kept[0]) for i in range(levels)]


def window_texts(windows: DataFrame, lines: DataFrame, sections: list[str], ties: list[str], limit: int | None = None) -> DataFrame:
    """(window_id, section, text): for each window (ids are unique) the lines of each section (section, ts, *ties, t) inside
    it, in order of time and ties, joined by line ends; only the first `limit` characters, if given.

    A section is one long text, and a window a stretch of it. Lines get their numbers and places in it by running totals,
    and so do both bounds of a window. The text is then cut into stretches, and a block is one of them and as much of the next
    as a window may want, so a window finds its lines in one row, the block that it begins in. Windows of nearly one length
    share blocks: half of the lines are in two of these at most, the others in one. So pairs of window and line are never rows,
    and what a task holds at once is in proportion to the text of one window.

    Windows with the same bounds have one text, which is made once, and their rows follow on one another. Where most are such,
    blocks are shorter, and each is the share of a task, with few different texts: a columnar file of them then keeps each
    text once, as the dictionary of a column goes to a million bytes or so."""
    own = lines.where("ts IS NOT NULL AND t IS NOT NULL").withColumns({"step": F.lit(1), "one": F.lit(1), "size": F.length("t") + 1})
    sound = windows.select("window_id", F.col("start_ts").cast("timestamp").alias("start_ts"), F.col("end_ts").cast("timestamp").alias("end_ts")).where("start_ts <= end_ts")
    sound = sinks.settled(sound, "windows")
    most, every, different = sound.groupBy("start_ts", "end_ts").agg(F.count(F.lit(1)).alias("n")).agg(F.max("n"), F.sum("n"), F.count(F.lit(1))).first()
    part = F.pmod(F.xxhash64("window_id"), F.lit(-(-(most or 1) // IDS)))
    ids = sound.withColumn("part", part).groupBy("start_ts", "end_ts", "part").agg(F.collect_list(F.struct("window_id")).alias("ids")).drop("part")
    bounds = F.array(F.struct(F.col("start_ts").alias("ts"), F.lit(0).alias("step")), F.struct(F.col("end_ts").alias("ts"), F.lit(2).alias("step")))
    asks = sound.select("start_ts", "end_ts").distinct().select("*", F.explode(F.array(*map(F.lit, sections))).alias("section")).select("*", F.inline(bounds))
    asks = asks.withColumns({"one": F.lit(0), "size": F.lit(0)})
    both = own.unionByName(asks.withColumn("asks", F.lit(True)), allowMissingColumns=True)
    run = Scan(both, ["section"], ["ts", "step", *ties], _hours("ts")).total("upto", F.col("one")).total("place", F.col("size")).result()
    placed = sinks.settled(run.select("section", "start_ts", "end_ts", "step", "asks", "t", "size", "upto", "place"), "texts")
    first, last = (lambda c, i=i: F.max(F.when(F.col("step") == i, F.col(c))) for i in (0, 2))
    spans = placed.where("asks").groupBy("start_ts", "end_ts", "section").agg(first("upto").alias("before"), last("upto").alias("upto"), first("place").alias("place"), last("place").alias("end")).where("upto > before")
    wanted = F.col("end") - F.col("place")
    wanted = wanted if limit is None else F.least(wanted, F.lit(limit))
    # Fixed value: no text of a row is longer than 4096 * 4 ** 10 characters
    level = F.lit(10)
    for i in reversed(range(10)):
        level = F.when(wanted <= BLOCK * WIDER**i, i).otherwise(level)
    spans = spans.withColumn("level", level)
    facts = spans.groupBy("section", "level").agg(F.max("place").alias("end"), F.sum(wanted).alias("text"), F.max(wanted).alias("longest")).collect()
    into = _blocks([r.level for r in facts] or [0])
    reach, stretch, ends = {}, {}, {}
    for i in set(into):
        those = [r for r in facts if into[r.level] == i]
        reach[i], stretch[i] = max((r.longest for r in those), default=0), BLOCK * WIDER**i * STRIDE
        ends |= {(name, i): max(r.end for r in those if r.section == name) for name in {r.section for r in those}}
        if those and every >= SHARED * different:
            alike = ALIKE * sum(end for (_, k), end in ends.items() if k == i) // sum(r.text for r in those)
            stretch[i] = min(stretch[i], max(alike, reach[i] // 4, 1))
    spans = spans.withColumn("block", F.floor(F.col("place") / F.element_at(F.array(*[F.lit(stretch[i]) for i in into]), F.col("level") + 1)))
    spans = spans.withColumn("level", F.element_at(F.array(*map(F.lit, into)), F.col("level") + 1)).join(ids, ["start_ts", "end_ts"])
    begins = F.col("place") - F.col("size")

    def blocks_of(i: int) -> Column:
        first, last = (F.floor(c / stretch[i]) for c in (F.greatest(begins - reach[i], F.lit(0)), begins))
        return F.transform(F.sequence(first, last), lambda block: F.struct(F.lit(i).alias("level"), block.alias("block")))

    at = map(blocks_of, sorted(set(into)))
    dealt = placed.where("asks IS NULL").select("section", "upto", "t", F.inline(F.concat(*at)))
    keys = ["section", "level", "block"]
    if facts and every >= SHARED * different:
        spans, dealt = _in_shares(spans, dealt, {at: end // stretch[at[1]] + 1 for at, end in ends.items()})
        keys.append("share")
    packs = dealt.groupBy(*keys).agg(F.min("upto").alias("from"), F.array_sort(F.collect_list(F.struct("upto", "t"))).alias("x"))
    packs = packs.select(*keys, "from", F.transform("x", lambda x: x["t"]).alias("x"))
    text = F.array_join(F.slice("x", (F.col("before") + 2 - F.col("from")).cast("int"), (F.col("upto") - F.col("before")).cast("int")), "\n")
    text = text if limit is None else F.substring(text, 1, limit)
    made = spans.join(packs.hint("merge") if "share" in keys else packs, keys).select("section", "ids", text.alias("text"))
    return made.select(F.inline("ids"), "section", "text")


def _in_shares(spans: DataFrame, dealt: DataFrame, blocks: dict[tuple[str, int], int]) -> tuple[DataFrame, DataFrame]:
    """spans and dealt, each block (section, level, block) in a task of its own, or several that follow on one another if there are
    very many; blocks: how many each section and level has. What is dealt into later ones is asked for by no span."""
    n, first, last = 0, F.lit(None).cast("bigint"), F.lit(None).cast("bigint")
    for (name, i), many in sorted(blocks.items()):
        here = (F.col("section") == name) & (F.col("level") == i)
        first, last, n = F.when(here, n).otherwise(first), F.when(here, many).otherwise(last), n + many
    each = -(-n // MOST_SHARES)
    share = F.floor((first + F.col("block")) / each).cast("int")
    return tuple(df.where(F.col("block") < last).withColumn("share", share).repartitionById(-(-n // each), F.col("share")) for df in (spans, dealt))


def touched_files(chunks: DataFrame) -> DataFrame:
    """(window_id, filename, first_message): the files that a window's commits touch, and the first commit to each."""
    commits = chunks.where(F.col("source_table") == "commits").select("window_id", "ts", "source_key", F.from_json("row", "message string, changed_files array<string>").alias("c"))
    each = commits.select("window_id", "ts", "source_key", "c.message", F.explode("c.changed_files").alias("filename"))
    return each.groupBy("window_id", "filename").agg(F.min_by("message", F.struct("ts", "source_key")).alias("first_message"))
