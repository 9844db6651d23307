"""Column functions of the work-history pipeline. All but `nfkc` stay inside the JVM."""

from __future__ import annotations

import unicodedata

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

# Patterns that results depend on.
ISO_STAMP = r"^\d{4}-\d{2}-\d{2}([T ]\d{2}:\d{2}(:\d{2}(\.\d+)?)?)?(Z|z|[+-]\d{2}(:?\d{2})?)?$"
ZONE = r"(Z|z|[+-]\d{2}(:?\d{2})?)$"
TICKET = r"\b[A-Z][A-Z0-9]{1,9}-\d+\b"
PULL_REQUEST = r"(?i)\b(?:PR\s*#|pull request\s*#)(\d+)"
SHA = r"^[0-9a-f]{40}$"
SNOWFLAKE = r"^\d{17,20}$"
TICKET_KEY = r"^[A-Z][A-Z0-9]{1,9}-\d+$"
UNSAFE_COMMAND = r"(?i)(rm\s+-[rf]{1,2}\s+/|:\(\)\{|mkfs|dd\s+if=|shutdown|reboot|curl|wget|nc\s|chmod\s+777|killall|>\s*/dev/sd)"

#: Digit strings longer than this are ids, not seconds.
MOST_SECOND_DIGITS = 11


def present(c: Column) -> Column:
    """The text, or null where it is empty: an empty text counts as missing throughout."""
    return F.nullif(c, F.lit(""))


def or_default(c: Column, value: str) -> Column:
    return F.coalesce(present(c), F.lit(value))


def parse_ts(c: Column, strict: bool = False, max_year: int | None = None) -> Column:
    """struct(ts, note) of a stamp in any of the accepted forms.

    Seconds since 1970 (up to 11 digits), or an ISO date or date-time; one without a zone is taken as UTC with note
    `repaired_naive`, or refused with note `naive` where strict. Notes `missing`, `unparseable` and
    `future_timestamp` (a year after max_year) come with a null ts; a clean stamp has a null note."""
    text = F.trim(c.cast("string"))
    digits = text.rlike(r"^\d+$")
    iso = text.rlike(ISO_STAMP)
    zoned = text.rlike(r"[T ]\d{2}:\d{2}") & text.rlike(ZONE)
    seconds = F.timestamp_seconds(F.when(digits & (F.length(text) <= MOST_SECOND_DIGITS), text.cast("bigint")))
    plain = F.regexp_replace(F.regexp_replace(text, r"([T ]\d{2}:\d{2}.*[+-]\d{2})(\d{2})$", "$1:$2"), r"z$", "Z")
    ts = F.when(digits, seconds).when(iso, F.try_to_timestamp(plain))
    late = F.lit(False) if max_year is None else F.coalesce(F.year(ts) > max_year, F.lit(False))
    note = (
        F.when(text.isNull() | (text == ""), "missing")
        .when(ts.isNull(), "unparseable")
        .when(late, "future_timestamp")
        .when(iso & ~zoned, "naive" if strict else "repaired_naive")
    )
    refused = note.isin("future_timestamp", "naive")
    return F.struct(F.when(refused, None).otherwise(ts).alias("ts"), note.alias("note"))


def parse_epoch(c: Column) -> Column:
    """Seconds as a double; digit strings of more than 11 characters are ids and give null."""
    text = F.trim(c.cast("string"))
    number = text.rlike(r"^\d+(\.\d+)?$")
    whole = F.regexp_extract(text, r"^\d+", 0)
    return F.when(number, F.when(F.length(whole) <= MOST_SECOND_DIGITS, text.try_cast("double"))).otherwise(to_epoch(parse_ts(c)["ts"]))


def to_epoch(ts: Column) -> Column:
    return F.unix_micros(ts.cast("timestamp")) / 1e6


def from_epoch(c: Column) -> Column:
    return F.timestamp_micros((c.cast("double") * 1e6).cast("bigint"))


def iso_z(ts: Column) -> Column:
    """Seconds precision with a Z."""
    return F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss'Z'")


@F.pandas_udf(StringType())
def nfkc(texts: pd.Series) -> pd.Series:
    """NFKC normalisation, for which Spark has no function."""
    return texts.map(lambda t: unicodedata.normalize("NFKC", t), na_action="ignore")


def clean_text(c: Column, normalise: bool = False) -> Column:
    """Control characters go (tabs and line ends stay), residue of HTML entities goes, blanks are squeezed, three or
    more line ends become two, ends are trimmed. normalise: NFKC first."""
    text = nfkc(c) if normalise else c
    text = F.regexp_replace(text, r"[\x00-\x08\x0B\x0C\x0E-\x1F\x7F]", "")
    text = F.regexp_replace(text, "&(amp|lt|gt);", "")
    text = F.regexp_replace(text, r"[ \t]{2,}", " ")
    return F.trim(F.regexp_replace(text, r"\n{3,}", "\n\n"))


def scrub_nul(c: Column) -> Column:
    """NUL characters, raw or as a JSON escape, go."""
    return F.regexp_replace(c, r"\x00|\\u0000", "")


def clip(c: Column, n: int) -> Column:
    """White space squeezed, at most n characters, the last an ellipsis if something is cut."""
    text = F.trim(F.regexp_replace(c, r"\s+", " "))
    return F.when(F.length(text) <= n, text).otherwise(F.concat(F.rtrim(F.substring(text, 1, n - 1)), F.lit("…")))


def extract_all(c: Column, pattern: str, group: int = 0, distinct: bool = True, cast: str | None = None) -> Column:
    """All matches; distinct: sorted, each once."""
    found = F.regexp_extract_all(F.coalesce(c, F.lit("")), F.lit(pattern), F.lit(group))
    found = found if cast is None else F.transform(found, lambda x: x.try_cast(cast))
    return F.array_sort(F.array_distinct(found)) if distinct else found


def is_tombstone(author_id: Column, url: Column, content: Column) -> Column:
    """What a deleted message leaves behind: no author, no link, nothing said."""
    blank = F.coalesce(F.trim(content), F.lit("")) == ""
    return present(author_id).isNull() & present(url).isNull() & blank


def valid(c: Column, pattern: str) -> Column:
    return F.coalesce(c.rlike(pattern), F.lit(False))


def json_get(c: Column, path: str, kind: str = "string") -> Column:
    return F.get_json_object(c, path).try_cast(kind)


def parse_json(c: Column, schema: str, keep: int = 400) -> Column:
    """struct(value, unparsed): what does not parse is kept, cut to `keep` characters."""
    value = F.from_json(c, schema, {"mode": "PERMISSIVE"})
    sound = F.try_parse_json(c).isNotNull()
    return F.struct(F.when(sound, value).alias("value"), F.when(c.isNotNull() & ~sound, F.substring(c, 1, keep)).alias("unparsed"))


def is_merge(parents: Column, message: Column) -> Column:
    return (F.coalesce(F.size(parents), F.lit(0)) > 1) | F.coalesce(F.startswith(message, F.lit("Merge ")), F.lit(False))


def distinct_field(items: Column, field: str) -> Column:
    """A field of an array of structs: sorted, each once, without nulls and empty texts."""
    values = F.transform(items, lambda x: x[field])
    return F.array_sort(F.array_distinct(F.filter(values, lambda x: x.isNotNull() & (x != ""))))


def content_id(*parts: Column, length: int | None = None) -> Column:
    """A stable id of the parts: SHA-256 in hex, or its first characters. Nulls count as empty."""
    joined = F.concat_ws("\x1f", *[F.coalesce(p.cast("string"), F.lit("")) for p in parts])
    digest = F.sha2(joined, 256)
    return digest if length is None else F.substring(digest, 1, length)


#: Hex digits of a path's digest that name its bucket: 4096 buckets.
BUCKET_DIGITS = 3


def bucket_digests(files: DataFrame, path: str = "path", sha: str = "sha256") -> DataFrame:
    """(bucket, digest): files, each known by its path and content once, dealt out by a digest of the path, and the digest of
    each bucket's leaves in order. Sets of files with equal buckets are equal; where some differ, only those need a look."""
    leaf = F.sha2(F.concat_ws(":", path, sha), 256)
    each = files.select(F.substring(F.sha2(F.coalesce(F.col(path), F.lit("")), 256), 1, BUCKET_DIGITS).alias("bucket"), leaf.alias("leaf")).distinct()
    return each.groupBy("bucket").agg(F.sha2(F.array_join(F.array_sort(F.collect_list("leaf")), "\n"), 256).alias("digest"))


def batch_id(files: DataFrame, stage: str, version: str, path: str = "path", sha: str = "sha256") -> DataFrame:
    """One row: the id of a set of files, whatever their order, repeats or partitions: the root over the digests of their
    buckets (4096 at most)."""
    each = F.array_join(F.array_sort(F.collect_list(F.concat_ws(":", "bucket", "digest"))), "\n")
    return bucket_digests(files, path, sha).agg(F.sha2(F.concat_ws(":", F.lit(version), F.lit(stage), each), 256).alias("batch_id"))


def minutes_between(a: Column, b: Column, digits: int = 1) -> Column:
    """Minutes from a to b, half-even."""
    return F.bround((F.unix_timestamp(b) - F.unix_timestamp(a)) / 60, digits)


def repo_parts(c: Column) -> Column:
    """struct(owner, repo) of an https, ssh or short repository address; null where it names no two parts."""
    text = F.regexp_replace(F.trim(c), r"/+$", "")
    text = F.regexp_replace(F.regexp_replace(text, r"\.git$", ""), r"^(?:https?://[^/]+/|ssh://[^/]+/|[^@/]+@[^:/]+:)", "")
    owner, repo = (F.regexp_extract(text, r"^([^/\s]+)/([^/\s]+)", i) for i in (1, 2))
    return F.when((owner != "") & (repo != ""), F.struct(owner.alias("owner"), repo.alias("repo")))


def approx_tokens(c: Column) -> Column:
    """A quarter of the characters."""
    return F.floor(F.coalesce(F.length(c), F.lit(0)) / 4).cast("bigint")


def split_label(c: Column, prefixes: list[str], held: str = "eval", rest: str = "train") -> Column:
    hit = F.lit(False)
    for prefix in prefixes:
        hit = hit | F.coalesce(F.startswith(c, F.lit(prefix)), F.lit(False))
    return F.when(hit, held).otherwise(rest)


def kind_label(entity: Column) -> Column:
    return F.when(F.startswith(entity, F.lit("PR#")), "pull_request").otherwise("ticket")


def confidence(c: Column, default: float = 0.5) -> Column:
    value = F.coalesce(c.try_cast("double"), F.lit(default))
    return F.least(F.lit(1.0), F.greatest(F.lit(0.0), value))


def closing_confidence(done: Column, merged: Column) -> Column:
    """High where the ticket was closed within an hour of the merge."""
    near = F.abs(F.unix_timestamp(done) - F.unix_timestamp(merged)) <= 3600
    return F.when(near, 0.95).otherwise(0.7)


def trainable_mask(messages: Column) -> Column:
    return F.transform(messages, lambda m: m["role"] == "assistant")


def preview(content: Column, name: Column, limit: int = 4000) -> Column:
    """The first characters of a text file; of other files what they are."""
    text = F.substring(F.decode(content, "UTF-8"), 1, limit)
    suffix = F.lower(F.regexp_extract(name, r"\.([^.]+)$", 1))
    return F.when(suffix.isin("log", "txt"), text).otherwise(F.concat(F.lit("["), F.when(suffix == "", "binary").otherwise(suffix), F.lit(" document]")))


def search_lines(df: DataFrame, text: str, path: str, needle: str, glob: str | None = None, cap: int | None = 60) -> DataFrame:
    """(path, line, text): lines that hold the needle in any case, in path and line order; cap: the first so many."""
    rows = df if glob is None else df.where(F.col(path).rlike(glob_pattern(glob)))
    lines = rows.select(F.col(path).alias("path"), F.posexplode(F.split(F.col(text), "\n", -1)).alias("pos", "found"))
    hits = lines.where(F.contains(F.lower("found"), F.lit(needle.lower())))
    hits = hits.select("path", (F.col("pos") + 1).alias("line"), F.substring(F.trim("found"), 1, 200).alias("text"))
    return hits if cap is None else hits.orderBy("path", "line").limit(cap)


def glob_pattern(glob: str) -> str:
    """A path glob as a pattern for the end of a path."""
    parts = {"*": "[^/]*", "?": "[^/]"}
    body = "".join(parts.get(ch, "\\" + ch if not ch.isalnum() and ch != "/" else ch) for ch in glob.replace("**", "\0"))
    return "(^|/)" + body.replace("\\\0", ".*") + "$"


def unsafe_command(command: Column, pattern: str = UNSAFE_COMMAND) -> Column:
    return valid(command, pattern)
