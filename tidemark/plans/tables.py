"""The driver's tables, and work-history streams made of them so that every operator has whole tables to run on."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


class Registry:
    """Queries by name, and SQL for those that SQL can express."""

    def __init__(self) -> None:
        self.queries: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
        self.oracles: dict[str, str] = {}

    def __call__(self, sql: str | None = None):
        def add(f):
            self.queries[f.__name__] = f
            if sql is not None:
                self.oracles[f.__name__] = sql
            return f

        return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """events with ts as an instant (the files have no zone; the session's is UTC)."""
    return table(spark, sf_dir, "events").withColumn("ts", F.col("ts").cast("timestamp"))


def seconds(c: str) -> F.Column:
    return F.unix_seconds(F.col(c).cast("timestamp"))


# Streams made of events: a user is a ticket, each event a message that names it; clicks name a pull request; a purchase
# closes the ticket. The same in SQL below.


def messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    ticket = F.concat(F.lit("USR-"), F.col("user_id").cast("string"))
    pr = F.when(F.col("event_type") == "click", F.array(F.floor(F.col("event_id") / 50).cast("int"))).otherwise(F.array().cast("array<int>"))
    return events(spark, sf_dir).select(
        F.col("event_id").cast("string").alias("message_id"), "ts", F.col("event_type").alias("author_name"), F.col("event_type").alias("channel"),
        F.concat(F.lit("about "), ticket, F.lit(" "), F.col("props")).alias("content"), F.array(ticket).alias("mentions_ticket"), pr.alias("mentions_pr"),
    )


def issues(spark: SparkSession, sf_dir: str) -> DataFrame:
    per = events(spark, sf_dir).groupBy("user_id").agg(F.min("ts").alias("a"), F.max("ts").alias("b"))
    key = F.concat(F.lit("USR-"), F.col("user_id").cast("string"))
    return per.select(
        key.alias("issue_key"), F.concat(F.lit("user "), F.col("user_id").cast("string")).alias("summary"), F.lit("Open").alias("status"),
        (F.col("a") + F.expr("INTERVAL 1 HOUR")).alias("created_at"), F.col("b").alias("updated_at"),
    )


def changelog(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = events(spark, sf_dir).where("event_type IN ('purchase', 'error')")
    return done.select(
        F.concat(F.lit("h"), F.col("event_id").cast("string")).alias("id"), F.concat(F.lit("USR-"), F.col("user_id").cast("string")).alias("issue_key"), "ts",
        F.lit("status").alias("field"), F.lit("Open").alias("from_value"), F.when(F.col("event_type") == "purchase", "Done").otherwise("Reopened").alias("to_value"),
    )


def pulls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A pull request for every fifty events, opened with the first of them; two thirds are merged, half a day later."""
    first = events(spark, sf_dir).groupBy(F.floor(F.col("event_id") / 50).cast("int").alias("pr_number")).agg(F.min("ts").alias("opened_at"))
    merged = F.col("pr_number") % 3 != 0
    return first.select(
        "pr_number", F.concat(F.lit("change "), F.col("pr_number").cast("string")).alias("title"), merged.alias("merged"), F.lit("dev").alias("author"), "opened_at",
        F.when(merged, F.col("opened_at") + F.expr("INTERVAL 12 HOURS")).alias("merged_at"),
        F.when(merged, F.sha1(F.col("pr_number").cast("string"))).alias("merge_sha"),
    )


SILVER_SQL = """
messages AS (SELECT event_id, CAST(event_id AS VARCHAR) AS message_id, ts, event_type AS author_name, event_type AS channel,
  'USR-' || user_id AS ticket, CASE WHEN event_type = 'click' THEN CAST(event_id // 50 AS INTEGER) END AS pr FROM events),
issues AS (SELECT 'USR-' || user_id AS issue_key, min(ts) + INTERVAL 1 HOUR AS created_at, max(ts) AS updated_at FROM events GROUP BY user_id),
changelog AS (SELECT 'h' || event_id AS id, 'USR-' || user_id AS issue_key, ts,
  CASE WHEN event_type = 'purchase' THEN 'Done' ELSE 'Reopened' END AS to_value FROM events WHERE event_type IN ('purchase', 'error')),
pulls AS (SELECT pr_number, opened_at, pr_number % 3 <> 0 AS merged, CASE WHEN pr_number % 3 <> 0 THEN opened_at + INTERVAL 12 HOUR END AS merged_at,
  CASE WHEN pr_number % 3 <> 0 THEN sha1(CAST(pr_number AS VARCHAR)) END AS merge_sha
  FROM (SELECT CAST(event_id // 50 AS INTEGER) AS pr_number, min(ts) AS opened_at FROM events GROUP BY 1)),
ticket_pr AS (SELECT ticket, pr AS pr_number, min(ts) AS first_ts FROM messages WHERE pr IS NOT NULL GROUP BY 1, 2),
merges AS (SELECT t.ticket, max(p.merged_at) AS last_merge, count(*) AS n_prs FROM ticket_pr t JOIN pulls p USING (pr_number) WHERE p.merged GROUP BY 1),
done AS (SELECT issue_key, max(ts) AS done_at FROM changelog WHERE to_value = 'Done' GROUP BY 1),
talk AS (SELECT ticket, min(ts) AS first_msg FROM messages GROUP BY 1),
baseline AS (SELECT * FROM (SELECT i.issue_key, lower(i.issue_key) AS task_id, least(first_msg, created_at) AS start_ts,
    greatest(done_at, last_merge) AS end_ts, n_prs
  FROM issues i JOIN talk ON ticket = i.issue_key LEFT JOIN merges m ON m.ticket = i.issue_key LEFT JOIN done d ON d.issue_key = i.issue_key
  WHERE done_at IS NOT NULL OR last_merge IS NOT NULL) WHERE end_ts >= start_ts)
"""
