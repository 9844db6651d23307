"""Cleaning: each cleaner returns (clean, quarantine). Every input row is in one of them, or a counted duplicate.

A quarantine row has target_table, entity_key, reason and raw; a reason starts with its rule, then details.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions import scalars as S
from tidemark.operators.scan import Scan, by_place

KEY_LIMIT, RAW_LIMIT = 400, 2000


def dedupe_first(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The first row of each key in the given order."""
    w = Window.partitionBy(*keys).orderBy(*[F.col(o).asc_nulls_last() for o in order])
    return df.withColumn("__rn", F.row_number().over(w)).where("__rn = 1").drop("__rn")


def quarantine(df: DataFrame, table: str, key: Column, reason: Column, raw: Column, limit: int = RAW_LIMIT) -> DataFrame:
    """The rows of df that have a reason."""
    found = df.select(
        F.lit(table).alias("target_table"), F.substring(F.coalesce(key.cast("string"), F.lit("")), 1, KEY_LIMIT).alias("entity_key"),
        reason.alias("reason"), F.substring(raw, 1, limit).alias("raw"),
    )
    return found.where(F.col("reason").isNotNull())


def rule_counts(q: DataFrame) -> DataFrame:
    """(rule, n), most frequent first; a rule is the first word of a reason."""
    rule = F.element_at(F.split("reason", "[ :]"), 1).alias("rule")
    return q.groupBy(rule).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "rule")


def _split(df: DataFrame, table: str, key: str, drop: list[str]) -> tuple[DataFrame, DataFrame]:
    raw = F.col("raw") if "raw" in df.columns else F.to_json(F.struct(*[c for c in df.columns if not c.startswith("__")]))
    bad = quarantine(df, table, F.col(key), F.col("__reason"), raw)
    return df.where(F.col("__reason").isNull()).drop("__reason", *drop), bad


def clean_messages(df: DataFrame, strict: bool = False, pr_pattern: str = S.PULL_REQUEST, ticket_pattern: str = S.TICKET,
                   max_year: int | None = None) -> tuple[DataFrame, DataFrame]:
    """Messages (message_id, author_id, author_name, ts_raw, content, jump_url, attachments, source_file, ordinal).

    In this order: ids that are not all digits, repeats of an id (counted, not quarantined), tombstones, blank content,
    bad stamps. Clean rows get ts, timestamp_repaired, mentions_ticket, mentions_pr and attachment_filenames."""
    ts = S.parse_ts(F.col("ts_raw"), strict, max_year)
    bad_id = ~S.valid(F.col("message_id"), r"^\d+$")
    rows = df.withColumns({"__bad_id": bad_id, "__ts": ts, "content": S.clean_text(F.col("content"))})
    sound = rows.where("NOT __bad_id")
    order = [c for c in ("source_file", "ordinal") if c in df.columns] or ["ts_raw"]
    once = dedupe_first(sound, ["message_id"], order)
    reason = (
        F.when(F.col("__bad_id"), F.lit("bad_id"))
        .when(S.is_tombstone(F.col("author_id"), F.col("jump_url"), F.col("content")), "tombstone")
        .when(F.coalesce(F.col("content"), F.lit("")) == "", "empty")
        .when(F.col("__ts.ts").isNull(), F.concat(F.lit("timestamp:"), F.col("__ts.note")))
    )
    judged = once.unionByName(rows.where("__bad_id")).withColumn("__reason", reason)
    names = F.transform(F.coalesce("attachments", F.expr("array()").cast(df.schema["attachments"].dataType)), lambda a: a["original_filename"]) if "attachments" in df.columns else F.array().cast("array<string>")
    judged = judged.withColumns({
        "ts": F.col("__ts.ts"),
        "timestamp_repaired": F.coalesce(F.col("__ts.note") == "repaired_naive", F.lit(False)),
        "author_name": S.or_default(F.col("author_name"), "unknown"),
        "mentions_ticket": S.extract_all(F.col("content"), ticket_pattern),
        "mentions_pr": S.extract_all(F.col("content"), pr_pattern, 1, cast="int"),
        "attachment_filenames": names,
    })
    return _split(judged, "messages", "message_id", ["__bad_id", "__ts"])


def verify_attachments(messages: DataFrame, listing: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Attachments of messages (message_id, attachments) held against the files there are (path, bytes): missing ones are
    dropped and quarantined, ones of another size are quarantined and kept."""
    each = messages.select("message_id", F.explode("attachments").alias("a")).select("message_id", "a.*")
    there = listing.select(F.col("path").alias("__path"), F.col("bytes").alias("__bytes"))
    found = each.join(there, F.col("path") == F.col("__path"), "left")
    missing, differs = F.col("__path").isNull(), F.col("size") != F.col("__bytes")
    found = found.withColumn("__reason", F.when(missing, "attachment_missing").when(differs, F.concat_ws(" ", F.lit("attachment_size"), "size", "__bytes")))
    bad = quarantine(found, "attachments", F.col("message_id"), F.col("__reason"), F.to_json(F.struct("path", "size")))
    return found.where(~missing).withColumn("size_ok", F.coalesce(~differs, F.lit(False))).drop("__path", "__bytes", "__reason"), bad


def clean_issues(df: DataFrame, mode: str = "freshest", key_pattern: str = S.TICKET_KEY) -> tuple[DataFrame, DataFrame]:
    """Issues (key, fields, ordinal?). freshest: of a key the row updated last, the first of equals; by_update: one row
    for each key and update, so re-saves survive."""
    order = "ordinal" if "ordinal" in df.columns else "key"
    rows = df.withColumns({"__created": S.parse_ts(F.col("fields.created")), "__updated": S.parse_ts(F.col("fields.updated"))})
    reason = F.when(~S.valid(F.col("key"), key_pattern), "bad_key").when(F.col("__created.ts").isNull(), F.concat(F.lit("created:"), F.col("__created.note")))
    judged = rows.withColumn("__reason", reason)
    sound = judged.where("__reason IS NULL")
    if mode == "freshest":
        w = Window.partitionBy("key").orderBy(F.col("__updated.ts").desc_nulls_last(), order)
        sound = sound.withColumn("__rn", F.row_number().over(w)).where("__rn = 1").drop("__rn")
    else:
        sound = dedupe_first(sound.withColumn("__at", F.col("__updated.ts")), ["key", "__at"], [order]).drop("__at")
    clean, bad = sound.drop("__reason"), _split(judged, "issues", "key", [])[1]
    return clean.select(
        F.col("key").alias("issue_key"), S.clean_text(F.col("fields.summary")).alias("summary"), S.clean_text(F.col("fields.description")).alias("description"),
        F.col("fields.status.name").alias("status"), S.or_default(F.col("fields.reporter.displayName"), "unknown").alias("reporter"),
        F.col("fields.assignee.displayName").alias("assignee"), F.col("__created.ts").alias("created_at"), F.col("__updated.ts").alias("updated_at"),
    ), bad


def flatten_changelog(histories: DataFrame, order: str = "position") -> tuple[DataFrame, DataFrame]:
    """Histories (issue_key, position, history) to one row an item, numbered over (issue, ts, history, item)."""
    each = histories.select("issue_key", order, "history.*").withColumn("__ts", S.parse_ts(F.col("created")))
    items = each.select("*", F.posexplode_outer("items").alias("__pos", "item"))
    reason = F.when(F.col("item").isNull(), "no_items").when(F.col("__ts.ts").isNull(), F.concat(F.lit("timestamp:"), F.col("__ts.note")))
    judged = items.withColumn("__reason", reason)
    clean, bad = _split(judged, "changelog", "issue_key", [])
    w = Window.partitionBy("issue_key").orderBy("__ts.ts", order, "__pos")
    number = F.format_string("%s:%06d", F.col("issue_key"), F.row_number().over(w))
    return clean.select(
        number.alias("id"), "issue_key", F.col("__ts.ts").alias("ts"), F.coalesce(F.col("__ts.note") == "repaired_naive", F.lit(False)).alias("timestamp_repaired"),
        S.or_default(F.col("author.displayName"), "unknown").alias("author"), F.col("item.field").alias("field"),
        F.col("item.fromString").alias("from_value"), F.col("item.toString").alias("to_value"),
    ), bad


def recover_naive_ts(histories: DataFrame, issues: DataFrame, stamp: str = "created", position: str = "position", step_minutes: int = 7) -> DataFrame:
    """Stamps without a zone are replaced: the issue's created_at plus step_minutes for each earlier one of the issue.
    Adds ts and recovered."""
    zoned = F.coalesce(F.col(stamp).rlike(S.ZONE) & F.col(stamp).rlike("[T ]"), F.lit(False)) | F.coalesce(F.col(stamp).rlike(r"^\d+$"), F.lit(False))
    rows = Scan(histories.withColumn("__naive", ~zoned), ["issue_key", "__naive"], [position], by_place(position)).number("__nth").result()
    rows = rows.withColumn("__nth", F.col("__nth") - 1).join(issues.select("issue_key", F.col("created_at").alias("__start")), "issue_key", "left")
    own = S.parse_ts(F.col(stamp))["ts"]
    made = F.col("__start") + F.make_interval(mins=(F.col("__nth") * step_minutes).cast("int"))
    recovered = F.col("__naive") & F.col("__start").isNotNull()
    return rows.withColumns({"ts": F.when(recovered, made).otherwise(own), "recovered": recovered}).drop("__naive", "__nth", "__start")


def clean_commits(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Commits as read_commits gives them: a bad sha, a bad stamp and a missing author are quarantined; a missing committer
    stamp is the author's."""
    rows = df.withColumns({"__a": S.parse_ts(F.col("authored_raw")), "__c": S.parse_ts(F.col("committed_raw"))})
    reason = (
        F.when(~S.valid(F.col("sha"), S.SHA), "bad_sha")
        .when(F.col("__a.ts").isNull(), F.concat(F.lit("timestamp:"), F.col("__a.note")))
        .when(S.present(F.col("author_name")).isNull(), "no_author")
    )
    clean, bad = _split(rows.withColumn("__reason", reason), "commits", "sha", [])
    clean = dedupe_first(clean, ["sha"], ["source_file"] if "source_file" in df.columns else ["authored_raw"])
    return clean.select(
        "sha", "author_name", "author_email", F.col("__a.ts").alias("authored_at"), F.coalesce(F.col("__c.ts"), F.col("__a.ts")).alias("committed_at"),
        S.clean_text(F.col("message")).alias("message"), S.is_merge(F.col("parent_shas"), F.col("message")).alias("is_merge"), "parent_shas",
        F.col("stats.additions").alias("additions"), F.col("stats.deletions").alias("deletions"), S.distinct_field(F.col("files"), "filename").alias("changed_files"),
    ), bad


def clean_pulls(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Pull requests as read_pulls gives them: one that is merged without a merge time is quarantined."""
    merged_at = S.parse_ts(F.col("merged_at"))["ts"]
    opened = S.parse_ts(F.col("created_at"))
    merged = F.coalesce(F.col("merged"), merged_at.isNotNull())
    reason = (
        F.when(~S.valid(F.col("number"), r"^\d+$"), "bad_number")
        .when(opened["ts"].isNull(), F.concat(F.lit("timestamp:"), opened["note"]))
        .when(merged & merged_at.isNull(), "merged_without_time")
    )
    clean, bad = _split(df.withColumn("__reason", reason), "pulls", "number", [])
    clean = dedupe_first(clean, ["number"], ["source_file"] if "source_file" in df.columns else ["created_at"])
    return clean.select(
        F.col("number").try_cast("int").alias("pr_number"), S.clean_text(F.col("title")).alias("title"), F.lower("state").alias("state"), merged.alias("merged"),
        S.or_default(F.col("user.login"), "unknown").alias("author"), F.col("head.ref").alias("branch"), F.col("merge_commit_sha").alias("merge_sha"),
        opened["ts"].alias("opened_at"), merged_at.alias("merged_at"),
    ), bad


def verify_documents(df: DataFrame, listing: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Registered documents (path, bytes, ...) against the files there are: every row is kept with size_ok, and those that
    are missing or of another size are quarantined as well."""
    there = listing.select(F.col("path").alias("__path"), F.col("bytes").alias("__bytes"))
    found = df.join(there, F.col("path") == F.col("__path"), "left")
    reason = F.when(F.col("__path").isNull(), "file_missing").when(F.col("bytes") != F.col("__bytes"), F.concat_ws(" ", F.lit("size_differs"), "bytes", "__bytes"))
    bad = quarantine(found, "documents", F.col("path"), reason, F.to_json(F.struct("path", "bytes")))
    return found.withColumn("size_ok", F.coalesce(F.col("bytes") == F.col("__bytes"), F.lit(False))).drop("__path", "__bytes"), bad


def unify_documents(issue_docs: DataFrame, chat_docs: DataFrame) -> DataFrame:
    """Documents of tickets and chat in one table (path, ..., source, doc_key), a path once: a ticket's copy comes first."""
    both = issue_docs.withColumn("source", F.lit("ticket")).unionByName(chat_docs.withColumn("source", F.lit("chat")), allowMissingColumns=True)
    ranked = both.withColumn("__rank", F.when(F.col("source") == "ticket", 0).otherwise(1))
    return dedupe_first(ranked, ["path"], ["__rank"]).drop("__rank").withColumn("doc_key", S.content_id(F.col("path"), length=16))
