"""Readers of landed exports. Every raw row keeps its payload as JSON text (`raw`) and where it came from."""

from __future__ import annotations

import json
import re
import zipfile
import zlib
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
import pyarrow.fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.scalars import or_default, parse_epoch, present

_PERSON = "struct<id: string, name: string>"
_FILE = "struct<uuid: string, id: string, original_filename: string, filename: string, size: bigint, content_type: string, path: string, url: string>"
#: Messages stay JSON text: exporters name their fields differently, in part by case only.
CHAT = f"channel struct<id: string, name: string, type: string>, guild {_PERSON}, exported_at string, message_count int, messages array<string>"
ISSUES = (
    "id string, key string, fields struct<summary: string, description: string, status: struct<name: string>, reporter: struct<displayName: string>,"
    " assignee: struct<displayName: string>, created: string, updated: string, attachment: array<struct<id: string, filename: string, size: bigint,"
    " mimeType: string, created: string, content: string>>>, changelog struct<histories: array<struct<id: string, author: struct<displayName: string>,"
    " created: string, items: array<struct<field: string, fieldtype: string, `from`: string, fromString: string, `to`: string, toString: string>>>>>"
)
COMMITS = (
    "sha string, commit struct<author: struct<name: string, email: string, date: string>, committer: struct<name: string, email: string, date: string>,"
    " message: string>, parents array<struct<sha: string>>, stats struct<additions: int, deletions: int, total: int>,"
    " files array<struct<filename: string, additions: int, deletions: int>>"
)
PULLS = (
    "number string, state string, title string, user struct<login: string>, created_at string, updated_at string, merged_at string, closed_at string,"
    " merge_commit_sha string, merged boolean, head struct<ref: string, sha: string>, base struct<ref: string>, body string"
)
EVENTS = "type string, action string, number int, created_at string, actor string, merge_commit_sha string"


#: What no JSON text has in it, in any encoding: a file is one record.
_NEVER = "\0" * 8


def _json(spark: SparkSession, path: str, schema: str, recursive: bool = True) -> DataFrame:
    """One row for each document, or for each element of a file that holds an array.

    Read as one record of bytes, not by multiLine: that opens the file again for each value that stays JSON text."""
    reader = spark.read.schema(schema).option("lineSep", _NEVER).option("recursiveFileLookup", recursive)
    return reader.json(path).select("*", F.col("_metadata.file_path").alias("source_file"))


def read_chat_archives(spark: SparkSession, path: str, recursive: bool = True) -> DataFrame:
    """One row a message: channel and server, file, position in the file (ordinal) and the message as raw JSON. Documents
    without messages are passed over; a folder or a single file will do."""
    docs = _json(spark, path, CHAT, recursive).where(F.col("messages").isNotNull())
    return _messages(docs)


def _messages(docs: DataFrame) -> DataFrame:
    return docs.select(
        F.col("channel.id").alias("channel_id"), F.col("channel.name").alias("channel"), F.col("guild.id").alias("guild_id"),
        F.col("guild.name").alias("guild"), "source_file", F.posexplode("messages").alias("ordinal", "raw"),
    )


def normalize_chat(raw: DataFrame) -> DataFrame:
    """One form for messages of all exporters: the first non-empty of the names a field goes by; an author may be a text or
    an object. Rows without an id are left out."""
    m = lambda *names: F.coalesce(*[present(F.get_json_object("raw", f"$.{n}")) for n in names])
    author = F.get_json_object("raw", "$.author")
    is_object = F.coalesce(F.startswith(F.ltrim(author), F.lit("{")), F.lit(False))
    own = [c for c in raw.columns if c != "raw"]
    found = raw.select(
        *own,
        m("message_id", "id", "ID").alias("message_id"),
        F.when(is_object, present(F.get_json_object(author, "$.id"))).alias("author_id"),
        F.when(is_object, F.coalesce(present(F.get_json_object(author, "$.name")), present(F.get_json_object(author, "$.username")))).otherwise(present(author)).alias("author_name"),
        m("timestamp", "Timestamp", "ts").alias("ts_raw"),
        F.coalesce(F.get_json_object("raw", "$.content"), F.get_json_object("raw", "$.Content")).alias("content"),
        m("jump_url").alias("jump_url"),
        m("edited").alias("edited"),
        F.from_json(F.coalesce(F.get_json_object("raw", "$.attachments"), F.lit("[]")), f"array<{_FILE}>").alias("attachments"),
        "raw",
    )
    return found.where(F.col("message_id").isNotNull()).withColumn("ts_epoch", parse_epoch(F.col("ts_raw")))


_OPENED = "source_file string, archive string, member string, error string"
_READ = "source_file string, document string, error string"


def _opened(uri: str):
    """A file of any store that has a reader, to be read from any place on."""
    store, path = pa.fs.FileSystem.from_uri(re.sub(r"^file:/+", "file:///", uri))
    return store.open_input_file(path)


def _is_zip(file) -> bool:
    try:
        return zipfile.is_zipfile(file)
    except ValueError:  # a file shorter than the end of any archive
        return False


def _table_of_contents(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The JSON members of each archive, by its table of contents alone; a file that is none is its own only member."""
    for batch in batches:
        for uri in batch["path"]:
            rows = [(uri, uri, None, None)]
            try:
                with _opened(uri) as file:
                    if _is_zip(file):
                        file.seek(0)
                        with zipfile.ZipFile(file) as held:
                            rows = [(f"{uri}!{m}", uri, m, None) for m in sorted(set(held.namelist())) if m.endswith(".json")]
            except (OSError, ValueError, zipfile.BadZipFile, NotImplementedError) as e:
                rows = [(uri, uri, None, str(e)[:200])]
            yield pd.DataFrame(rows, columns=["source_file", "archive", "member", "error"])


def _members(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Each member read from its place in its archive."""
    for batch in batches:
        for where, uri, member, error in batch.itertuples(index=False):
            text = None
            if error is None:
                try:
                    with _opened(uri) as file:
                        if member is None:
                            blob = file.read()
                        else:
                            with zipfile.ZipFile(file) as held:
                                blob = held.read(member)
                    text = blob.decode("utf-8-sig")
                    json.loads(text)
                except (OSError, ValueError, zipfile.BadZipFile, zlib.error, NotImplementedError, RuntimeError) as e:  # encrypted ones are RuntimeErrors
                    text, error = None, str(e)[:200]
            yield pd.DataFrame({"source_file": [where], "document": [text], "error": [error]})


def read_zip_json(spark: SparkSession, path: str, partitions: int | None = None) -> DataFrame:
    """Like read_chat_archives, for zip files whose members are JSON documents, and for plain JSON files among them:
    (source_file, document, error). What can't be read, decompressed or parsed gives a row whose error says so.

    Spark lists the files without reading them. A first task opens each archive where its table of contents lies; its
    members are then dealt out over all tasks (`partitions`; as many as the session shuffles into, if None), and each is
    read from its own place. So an archive may be of any size and is the work of many tasks; only a member has to fit into
    memory. Stores are opened by Arrow (local, HDFS, S3, GCS)."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path).select("path")
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    return files.mapInPandas(_table_of_contents, _OPENED).repartition(n, "source_file").mapInPandas(_members, _READ)


def zip_messages(documents: DataFrame) -> DataFrame:
    """The messages of read_zip_json's sound documents, as read_chat_archives gives them."""
    parsed = documents.where("error IS NULL").select("source_file", F.from_json("document", CHAT).alias("d")).select("source_file", "d.*")
    return _messages(parsed.where(F.col("messages").isNotNull()))


def read_issues(spark: SparkSession, path: str) -> DataFrame:
    """One row an issue; one without a key gets a key made from its content, always the same."""
    issues = _json(spark, path, ISSUES)
    raw = F.to_json(F.struct("id", "key", "fields", "changelog"))
    key = F.coalesce(present(F.col("key")), F.concat(F.lit("__missing_key_"), F.lower(F.hex(F.xxhash64(raw)))))
    return issues.withColumn("raw", raw).withColumn("key", key)


def issue_histories(issues: DataFrame) -> DataFrame:
    """One row a history entry, keyed issue:history."""
    found = issues.select("key", F.posexplode_outer("changelog.histories").alias("position", "history")).where("history IS NOT NULL")
    return found.select(F.concat_ws(":", "key", F.coalesce("history.id", F.col("position").cast("string"))).alias("history_key"), F.col("key").alias("issue_key"), "position", "history")


def read_commits(spark: SparkSession, path: str) -> DataFrame:
    found = _json(spark, path, COMMITS)
    raw = F.to_json(F.struct(*[c for c in found.columns if c != "source_file"]))
    return found.select(
        "sha", F.col("commit.author.name").alias("author_name"), F.col("commit.author.email").alias("author_email"), F.col("commit.author.date").alias("authored_raw"),
        F.col("commit.committer.date").alias("committed_raw"), F.col("commit.message").alias("message"), F.transform("parents", lambda p: p["sha"]).alias("parent_shas"),
        "stats", "files", "source_file", raw.alias("raw"),
    )


def commit_files(commits: DataFrame) -> DataFrame:
    """(sha, filename, additions, deletions), once for each file of a commit."""
    return commits.select("sha", F.explode("files").alias("f")).select("sha", "f.filename", "f.additions", "f.deletions").dropDuplicates(["sha", "filename"])


def synthetic_number(number: Column, raw: Column) -> Column:
    """The number, or a stable negative one where it is no integer."""
    own = F.when(number.rlike(r"^\d+$"), number.try_cast("bigint"))
    return F.coalesce(own, -(F.pmod(F.xxhash64(raw), F.lit(100_000_000)) + 1))


def read_pulls(spark: SparkSession, path: str) -> DataFrame:
    found = _json(spark, path, PULLS)
    raw = F.to_json(F.struct(*[c for c in found.columns if c != "source_file"]))
    return found.withColumn("raw", raw).withColumn("pr_number", synthetic_number(F.col("number"), F.col("raw")))


def event_key(*parts: str) -> Column:
    return F.concat_ws("|", *[F.coalesce(F.col(p).cast("string"), F.lit("")) for p in parts])


def read_pr_events(spark: SparkSession, path: str) -> DataFrame:
    return _json(spark, path, EVENTS).withColumn("event_key", event_key("type", "action", "number", "created_at"))


def read_documents(spark: SparkSession, path: str, inline: bool = False) -> DataFrame:
    """(path, stream, filename, bytes, sha256): every file below path; stream is its folder. inline keeps the content."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    parts = F.split("path", "/")
    found = files.select(
        "path", F.element_at(parts, -2).alias("stream"), F.element_at(parts, -1).alias("filename"), F.col("length").alias("bytes"),
        F.sha2("content", 256).alias("sha256"), *(["content"] if inline else []),
    )
    return found


def rest_commits(pages: DataFrame, most_files: int = 40) -> DataFrame:
    """Commits of landed API pages: (external_id, ts, payload)."""
    files = F.slice(F.coalesce(F.transform("files", lambda f: f["filename"]), F.array().cast("array<string>")), 1, most_files)
    payload = F.to_json(F.struct("sha", F.col("commit.message").alias("message"), F.col("commit.author.name").alias("author"), files.alias("files")))
    return pages.select(F.col("sha").alias("external_id"), parse_epoch(F.col("commit.author.date")).alias("ts"), payload.alias("payload"))


def rest_pulls(pages: DataFrame, most_body: int = 2000) -> DataFrame:
    """Pull requests of landed API pages: merged where a merge time is set; ts is that of the merge, the close or the start."""
    merged = present(F.col("merged_at"))
    payload = F.to_json(F.struct("number", "title", F.lower("state").alias("state"), merged.isNotNull().alias("merged"), "merged_at", F.substring("body", 1, most_body).alias("body")))
    when = F.coalesce(merged, present(F.col("closed_at")), present(F.col("created_at")))
    return pages.select(F.col("number").cast("string").alias("external_id"), parse_epoch(when).alias("ts"), payload.alias("payload"))


def from_rest_pages(commits: DataFrame, pulls: DataFrame) -> DataFrame:
    """(stream, external_id, ts, payload) of landed commit and pull-request pages."""
    return rest_commits(commits).withColumn("stream", F.lit("commits")).unionByName(rest_pulls(pulls).withColumn("stream", F.lit("pulls")))


def read_jsonl(spark: SparkSession, path: str, schema: str, strict: bool = True) -> DataFrame:
    """One object a line, blank lines skipped. strict: a bad line fails the read; else it is kept in _bad_line."""
    reader = spark.read.schema(schema if strict else f"{schema}, _bad_line string")
    return reader.option("mode", "FAILFAST" if strict else "PERMISSIVE").option("columnNameOfCorruptRecord", "_bad_line").json(path)


def load_records(spark: SparkSession, path: str, pair: str, stream: str, payload_schema: str) -> DataFrame:
    """The records of one pair and stream, parsed and in order of time; both filters reach the scan."""
    rows = spark.read.parquet(path).where((F.col("pair_id") == pair) & (F.col("stream") == stream))
    return rows.select("id", "external_id", "ts", F.from_json("payload", payload_schema).alias("payload")).orderBy(F.col("ts").asc_nulls_last(), "external_id")


def scan_archive(spark: SparkSession, path: str) -> DataFrame:
    """One row that says what an archive holds, without writing: channels, messages, files, bytes and attachments."""
    chat = _json(spark, path, CHAT).where(F.col("messages").isNotNull())
    said = chat.agg(F.count_distinct(or_default(F.col("channel.id"), "?")).alias("channels"), F.coalesce(F.sum(F.size("messages")), F.lit(0)).alias("messages"))
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path).select("path", "length")
    held = files.agg(F.count(F.lit(1)).alias("files"), F.coalesce(F.sum("length"), F.lit(0)).alias("bytes"), F.count_if(~F.lower("path").rlike(r"\.json$")).alias("attachments"))
    return said.join(held, F.lit(True))


def describe_layers(spark: SparkSession, expected: list[str]) -> DataFrame:
    """(table, column, type, rows, status) of the expected tables; a missing or empty one is flagged."""
    parts = []
    for name in expected:
        if spark.catalog.tableExists(name):
            df = spark.table(name)
            counted = df.agg(F.count(F.lit(1)).alias("rows"))
            fields = F.array(*[F.struct(F.lit(f.name).alias("column"), F.lit(f.dataType.simpleString()).alias("type")) for f in df.schema.fields])
            one = counted.select(F.lit(name).alias("table"), F.inline(fields), "rows").withColumn("status", F.when(F.col("rows") == 0, "empty").otherwise("ok"))
        else:
            one = spark.range(1).select(F.lit(name).alias("table"), F.lit(None).cast("string").alias("column"), F.lit(None).cast("string").alias("type"), F.lit(0).cast("bigint").alias("rows"), F.lit("missing").alias("status"))
        parts.append(one.select("table", "column", "type", "rows", "status"))
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def read_table(spark: SparkSession, url: str, table: str, **options: str) -> DataFrame:
    """A relational table by JDBC (the driver's jar is the caller's), or a Parquet folder where url is a path."""
    if url.startswith("jdbc:"):
        return spark.read.format("jdbc").options(url=url, dbtable=table, **options).load()
    return spark.read.parquet(f"{url}/{table}")
