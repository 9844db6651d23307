"""Scalar functions, cleaning, and set operations over the driver's tables."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions import scalars as S
from tidemark.operators import clean, dataset, links, reports, validate
from tidemark.plans.tables import Registry, events, table

query = Registry()

_STAMP_SQL = """stamp AS (SELECT event_id, ts, CASE event_id % 7
  WHEN 0 THEN CAST(CAST(floor(epoch(ts)) AS BIGINT) AS VARCHAR) WHEN 1 THEN strftime(ts, '%Y-%m-%dT%H:%M:%SZ')
  WHEN 2 THEN strftime(ts, '%Y-%m-%d %H:%M:%S') WHEN 3 THEN strftime(ts, '%Y-%m-%dT%H:%M:%S') || '-06:00'
  WHEN 4 THEN 'T10:00' WHEN 5 THEN '' ELSE '123456789012345678' END AS raw FROM events)"""


def _stamps(spark, sf_dir):
    e = events(spark, sf_dir)
    plain = lambda p: F.date_format("ts", p)
    raw = (
        F.when(F.col("event_id") % 7 == 0, F.unix_seconds("ts").cast("string"))
        .when(F.col("event_id") % 7 == 1, plain("yyyy-MM-dd'T'HH:mm:ss'Z'"))
        .when(F.col("event_id") % 7 == 2, plain("yyyy-MM-dd HH:mm:ss"))
        .when(F.col("event_id") % 7 == 3, F.concat(plain("yyyy-MM-dd'T'HH:mm:ss"), F.lit("-06:00")))
        .when(F.col("event_id") % 7 == 4, "T10:00").when(F.col("event_id") % 7 == 5, "").otherwise("123456789012345678")
    )
    return e.select("event_id", "ts", raw.alias("raw"))


@query(f"""WITH {_STAMP_SQL} SELECT event_id,
  CASE event_id % 7 WHEN 3 THEN CAST(floor(epoch(ts)) AS BIGINT) + 21600 WHEN 4 THEN NULL WHEN 5 THEN NULL WHEN 6 THEN NULL ELSE CAST(floor(epoch(ts)) AS BIGINT) END AS secs,
  CASE event_id % 7 WHEN 2 THEN 'repaired_naive' WHEN 4 THEN 'unparseable' WHEN 5 THEN 'missing' WHEN 6 THEN 'unparseable' END AS note FROM stamp""")
def parse_timestamps(spark, sf_dir):
    p = _stamps(spark, sf_dir).withColumn("p", S.parse_ts(F.col("raw")))
    return p.select("event_id", F.unix_seconds("p.ts").alias("secs"), F.col("p.note").alias("note"))


@query(f"""WITH {_STAMP_SQL} SELECT event_id % 7 AS form, count(*) AS n, CAST(sum(CASE event_id % 7 WHEN 0 THEN 1 WHEN 1 THEN 1 WHEN 3 THEN 1 ELSE 0 END) AS BIGINT) AS typed FROM stamp GROUP BY 1""")
def strict_timestamps(spark, sf_dir):
    p = _stamps(spark, sf_dir).withColumn("p", S.parse_ts(F.col("raw"), strict=True, max_year=2027))
    return p.groupBy((F.col("event_id") % 7).alias("form")).agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("p.ts").isNotNull()).alias("typed"))


@query(f"""WITH {_STAMP_SQL} SELECT event_id, CASE event_id % 7 WHEN 3 THEN CAST(floor(epoch(ts)) AS BIGINT) + 21600 WHEN 4 THEN NULL WHEN 5 THEN NULL
  WHEN 6 THEN NULL ELSE CAST(floor(epoch(ts)) AS BIGINT) END AS secs FROM stamp""")
def parse_epochs(spark, sf_dir):
    return _stamps(spark, sf_dir).select("event_id", F.floor(S.parse_epoch(F.col("raw"))).cast("bigint").alias("secs"))


@query("""SELECT event_id, strftime(ts, '%Y-%m-%dT%H:%M:%SZ') AS iso, CAST(floor(epoch(ts)) AS BIGINT) AS back FROM events""")
def format_timestamps(spark, sf_dir):
    e = events(spark, sf_dir)
    return e.select("event_id", S.iso_z(F.col("ts")).alias("iso"), F.floor(F.unix_seconds(S.from_epoch(S.to_epoch(F.col("ts"))))).cast("bigint").alias("back"))


_CLEAN = r"""trim(regexp_replace(regexp_replace(regexp_replace(regexp_replace(text, '[\x00-\x08\x0B\x0C\x0E-\x1F\x7F]', '', 'g'), '&(amp|lt|gt);', '', 'g'), '[ \t]{2,}', ' ', 'g'), '\n{3,}', chr(10) || chr(10), 'g'), ' ')"""


@query(f"SELECT doc_id, md5({_CLEAN}) AS digest, length({_CLEAN}) AS n FROM documents")
def clean_texts(spark, sf_dir):
    d = table(spark, sf_dir, "documents").select("doc_id", S.clean_text(F.col("text")).alias("t"))
    return d.select("doc_id", F.md5("t").alias("digest"), F.length("t").cast("bigint").alias("n"))


@query()
def clean_texts_nfkc(spark, sf_dir):
    d = table(spark, sf_dir, "documents").select("doc_id", S.clean_text(F.col("text"), normalise=True).alias("t"))
    return d.select("doc_id", F.md5("t").alias("digest"))


@query(r"""SELECT page_id, md5(replace(replace(html || '\u0000', chr(0), ''), '\u0000', '')) AS digest FROM pages""")
def scrub_nuls(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", F.md5(S.scrub_nul(F.concat("html", F.lit("\\u0000")))).alias("digest"))


@query(r"""WITH s AS (SELECT doc_id, trim(regexp_replace(text, '\s+', ' ', 'g'), ' ') AS t FROM documents)
SELECT doc_id, CASE WHEN length(t) <= 120 THEN t ELSE rtrim(substr(t, 1, 119), ' ') || '…' END AS clipped FROM s""")
def clip_texts(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", S.clip(F.col("text"), 120).alias("clipped"))


@query(r"""SELECT doc_id, list_sort(list_distinct(regexp_extract_all(text, '\d+'))) AS numbers, len(regexp_extract_all(text, '#(\d+)', 1)) AS marks FROM documents""")
def extract_mentions(spark, sf_dir):
    d = table(spark, sf_dir, "documents")
    return d.select("doc_id", S.extract_all(F.col("text"), r"\d+").alias("numbers"), F.size(S.extract_all(F.col("text"), r"#(\d+)", 1, distinct=False)).cast("bigint").alias("marks"))


@query("""SELECT event_id, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k, json_extract_string(props, '$.none') AS none FROM events""")
def json_scalars(spark, sf_dir):
    return table(spark, sf_dir, "events").select("event_id", S.json_get(F.col("props"), "$.k", "int").alias("k"), S.json_get(F.col("props"), "$.none").alias("none"))


@query("""SELECT event_id, CASE WHEN event_id % 5 = 0 THEN NULL ELSE CAST(json_extract_string(props, '$.k') AS INTEGER) END AS k,
  CASE WHEN event_id % 5 = 0 THEN substr(props, 1, 5) END AS unparsed FROM events""")
def tolerant_json(spark, sf_dir):
    e = table(spark, sf_dir, "events").select("event_id", F.when(F.col("event_id") % 5 == 0, F.substring("props", 1, 5)).otherwise(F.col("props")).alias("raw"))
    return e.select("event_id", S.parse_json(F.col("raw"), "k int").alias("j")).select("event_id", "j.value.k", "j.unparsed")


@query("""SELECT c_custkey, substr(sha256(CAST(c_custkey AS VARCHAR) || chr(31) || c_mktsegment), 1, 16) AS id FROM customer""")
def content_ids(spark, sf_dir):
    return table(spark, sf_dir, "customer").select("c_custkey", S.content_id(F.col("c_custkey"), F.col("c_mktsegment"), length=16).alias("id"))


@query("""WITH leaf AS (SELECT DISTINCT substr(sha256(CAST(p_partkey AS VARCHAR)), 1, 3) AS bucket, sha256(CAST(p_partkey AS VARCHAR) || ':' || md5(p_name)) AS leaf FROM part),
b AS (SELECT bucket, sha256(string_agg(leaf, chr(10) ORDER BY leaf)) AS digest FROM leaf GROUP BY 1)
SELECT sha256('v1:bronze:' || string_agg(bucket || ':' || digest, chr(10) ORDER BY bucket)) AS batch_id FROM b""")
def file_batch_id(spark, sf_dir):
    files = table(spark, sf_dir, "part").select(F.col("p_partkey").cast("string").alias("path"), F.md5("p_name").alias("sha256"))
    return S.batch_id(files, "bronze", "v1")


@query("""SELECT o_orderkey, l_linenumber, CAST(round_even((CAST(epoch(l_shipdate) AS BIGINT) - CAST(epoch(o_orderdate) AS BIGINT)) / 60, 1) AS DOUBLE) AS minutes
  FROM orders JOIN lineitem ON l_orderkey = o_orderkey""")
def order_minutes(spark, sf_dir):
    o, li = table(spark, sf_dir, "orders"), table(spark, sf_dir, "lineitem")
    both = o.select("o_orderkey", "o_orderdate").join(li.select(F.col("l_orderkey").alias("o_orderkey"), "l_linenumber", "l_shipdate"), "o_orderkey")
    m = S.minutes_between(F.col("o_orderdate").cast("timestamp"), F.col("l_shipdate").cast("timestamp"))
    return both.select("o_orderkey", "l_linenumber", m.cast("double").alias("minutes"))


@query("""SELECT c_custkey, CASE WHEN c_custkey % 4 = 3 THEN NULL ELSE 'own' || c_nationkey END AS owner, CASE WHEN c_custkey % 4 = 3 THEN NULL ELSE 'repo' || c_custkey END AS repo FROM customer""")
def repo_addresses(spark, sf_dir):
    c = table(spark, sf_dir, "customer")
    name = F.concat(F.lit("own"), F.col("c_nationkey").cast("string"), F.lit("/repo"), F.col("c_custkey").cast("string"))
    k = F.col("c_custkey") % 4
    url = F.when(k == 0, F.concat(F.lit("https://host.example/"), name, F.lit(".git"))).when(k == 1, F.concat(F.lit("git@host.example:"), name, F.lit(".git"))).when(k == 2, name).otherwise("nothing")
    return c.select("c_custkey", S.repo_parts(url).alias("r")).select("c_custkey", "r.owner", "r.repo")


@query("""SELECT source, CAST(floor(sum(length(text)) / 4) AS BIGINT) AS tokens, CAST(sum(length(text) // 4) AS BIGINT) AS by_row FROM documents GROUP BY 1""")
def token_estimates(spark, sf_dir):
    d = table(spark, sf_dir, "documents")
    return d.groupBy("source").agg(F.floor(F.sum(F.length("text")) / 4).cast("bigint").alias("tokens"), F.sum(S.approx_tokens(F.col("text"))).alias("by_row"))


@query("""SELECT p_partkey, CASE WHEN p_brand LIKE 'Brand#1%' OR p_brand LIKE 'Brand#2%' THEN 'eval' ELSE 'train' END AS split,
  least(1.0, greatest(0.0, p_retailprice / 1500)) AS confidence, p_brand LIKE 'Brand%' AS ok FROM part""")
def labels_and_flags(spark, sf_dir):
    p = table(spark, sf_dir, "part")
    return p.select("p_partkey", S.split_label(F.col("p_brand"), ["Brand#1", "Brand#2"]).alias("split"), S.confidence(F.col("p_retailprice") / 1500).alias("confidence"), S.valid(F.col("p_brand"), "^Brand").alias("ok"))


@query("""SELECT doc_id AS path, line, substr(trim(t, ' '), 1, 200) AS text FROM (
  SELECT doc_id, unnest(string_split(text, chr(10))) AS t, unnest(range(1, len(string_split(text, chr(10))) + 1)) AS line FROM documents)
WHERE contains(lower(t), 'stupid')""")
def line_search(spark, sf_dir):
    return S.search_lines(table(spark, sf_dir, "documents"), "text", "doc_id", "Stupid", cap=None).withColumn("line", F.col("line").cast("bigint"))


@query("""SELECT p_partkey, p_partkey % 3 = 0 AS unsafe FROM part""")
def unsafe_commands(spark, sf_dir):
    p = table(spark, sf_dir, "part")
    cmd = F.when(F.col("p_partkey") % 3 == 0, F.concat(F.lit("sudo RM -rf /tmp/"), "p_name")).otherwise(F.concat(F.lit("ls "), "p_name"))
    return p.select("p_partkey", S.unsafe_command(cmd).alias("unsafe"))


# cleaning: events, with the first hundredth landed twice and some rows damaged

_DIRTY_SQL = """raw AS (SELECT event_id, ts, user_id, event_type, value, props, 0 AS copy FROM events UNION ALL SELECT event_id, ts, user_id, event_type, value, props, 1 FROM events WHERE event_id % 100 = 0),
judged AS (SELECT *, CASE WHEN event_id % 17 = 1 THEN 'bad_id' WHEN event_id % 17 = 2 THEN 'tombstone' WHEN event_id % 17 = 3 THEN 'empty'
  WHEN event_id % 17 = 4 THEN 'timestamp:unparseable' END AS reason FROM raw)"""


def _dirty(spark, sf_dir):
    e = events(spark, sf_dir)
    twice = e.withColumn("ordinal", F.lit(0)).unionByName(e.where("event_id % 100 = 0").withColumn("ordinal", F.lit(1)))
    k = F.col("event_id") % 17
    text = F.col("event_id").cast("string")
    return twice.select(
        F.when(k == 1, F.concat(F.lit("x"), text)).otherwise(text).alias("message_id"), F.when(k == 2, F.lit(None)).otherwise(F.col("user_id").cast("string")).alias("author_id"),
        F.col("event_type").alias("author_name"), F.when(k == 4, "soon").otherwise(F.unix_seconds("ts").cast("string")).alias("ts_raw"),
        F.when(k.isin(2, 3), " ").otherwise(F.concat(F.lit("PR #"), (F.col("event_id") % 50).cast("string"), F.lit(" USR-"), F.col("user_id").cast("string"))).alias("content"),
        F.when(k == 2, F.lit(None)).otherwise(F.lit("u")).alias("jump_url"), "ordinal",
    )


@query(f"""WITH {_DIRTY_SQL} SELECT CAST(event_id AS VARCHAR) AS message_id, CAST(floor(epoch(ts)) AS BIGINT) AS secs, ['USR-' || user_id] AS tickets, [CAST(event_id % 50 AS INTEGER)] AS prs
FROM judged WHERE reason IS NULL AND copy = 0""")
def messages_cleaned(spark, sf_dir):
    good, _ = clean.clean_messages(_dirty(spark, sf_dir))
    return good.select("message_id", F.unix_seconds("ts").alias("secs"), F.col("mentions_ticket").alias("tickets"), F.col("mentions_pr").alias("prs"))


@query(f"""WITH {_DIRTY_SQL} SELECT split_part(reason, ':', 1) AS rule, count(*) AS n FROM judged WHERE reason IS NOT NULL AND (copy = 0 OR reason = 'bad_id') GROUP BY 1""")
def quarantine_rules(spark, sf_dir):
    return clean.rule_counts(clean.clean_messages(_dirty(spark, sf_dir))[1])


@query(f"""WITH {_DIRTY_SQL} SELECT CAST(count_if(event_id % 17 IN (2, 3)) AS BIGINT) AS blank, CAST(count(*) - count(DISTINCT event_id) AS BIGINT) AS repeated,
  CAST(count_if(event_id % 17 = 4) AS BIGINT) AS untyped, CAST(count_if(event_id % 17 IN (2, 3, 4)) + count(*) - count(DISTINCT event_id) AS BIGINT) AS total FROM raw""")
def defects_counted(spark, sf_dir):
    return validate.defect_count(_dirty(spark, sf_dir))


@query("""SELECT user_id, event_type, min_by(event_id, event_id) AS event_id FROM events GROUP BY 1, 2""")
def first_of_key(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    return clean.dedupe_first(e.unionByName(e), ["user_id", "event_type"], ["event_id"]).select("user_id", "event_type", "event_id")


@query("""SELECT o_custkey AS issue_key_no, arg_max(o_orderkey, (o_orderdate, -o_orderkey)) AS o_orderkey FROM orders GROUP BY 1""")
def issues_freshest(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    who = lambda n: F.struct(F.lit(n).alias("displayName"))
    stamp = F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss'Z'")
    fields = F.struct(F.col("o_orderkey").cast("string").alias("summary"), F.lit("").alias("description"), F.struct("o_orderstatus").cast("struct<name: string>").alias("status"), who("r").alias("reporter"), who("a").alias("assignee"), F.lit("2020-01-01T00:00:00Z").alias("created"), stamp.alias("updated"))
    raw = o.select(F.concat(F.lit("CUST-"), F.col("o_custkey").cast("string")).alias("key"), fields.alias("fields"), F.col("o_orderkey").alias("ordinal"))
    good, _ = clean.clean_issues(raw)
    return good.select(F.expr("CAST(substr(issue_key, 6) AS BIGINT)").alias("issue_key_no"), F.col("summary").cast("bigint").alias("o_orderkey"))


@query("""WITH h AS (SELECT user_id, event_id, ts, event_id % 3 = 0 AS naive, row_number() OVER (PARTITION BY user_id, event_id % 3 = 0 ORDER BY event_id) - 1 AS nth FROM events)
SELECT event_id, naive AS recovered, CASE WHEN naive THEN 1600000000 + user_id * 1000 + 420 * nth ELSE CAST(floor(epoch(ts)) AS BIGINT) END AS secs FROM h""")
def naive_recovered(spark, sf_dir):
    e = events(spark, sf_dir)
    stamp = F.when(F.col("event_id") % 3 == 0, F.date_format("ts", "yyyy-MM-dd HH:mm:ss")).otherwise(S.iso_z(F.col("ts")))
    h = e.select(F.col("user_id").alias("issue_key"), "event_id", stamp.alias("created"), F.col("event_id").alias("position"))
    owners = e.select(F.col("user_id").alias("issue_key")).distinct().withColumn("created_at", F.timestamp_seconds(F.col("issue_key") * 1000 + 1_600_000_000))
    return clean.recover_naive_ts(h, owners).select("event_id", "recovered", F.unix_seconds("ts").alias("secs"))


# set operations, top-k and newest rows


@query("SELECT DISTINCT doc_id FROM (SELECT doc_id FROM labels UNION SELECT doc_id FROM documents WHERE lang = 'en')")
def union_of_ids(spark, sf_dir):
    return links.in_any([table(spark, sf_dir, "labels"), table(spark, sf_dir, "documents").where("lang = 'en'")], "doc_id")


@query("SELECT doc_id FROM documents EXCEPT SELECT doc_id FROM labels")
def ids_except(spark, sf_dir):
    return links.in_first_only([table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")], "doc_id")


@query("SELECT doc_id FROM documents WHERE lang = 'de' INTERSECT SELECT doc_id FROM labels WHERE toxic = 1")
def ids_in_both(spark, sf_dir):
    return links.in_all([table(spark, sf_dir, "documents").where("lang = 'de'"), table(spark, sf_dir, "labels").where("toxic = 1")], "doc_id")


@query("""SELECT source, lang, bit_or(bit) AS held FROM (SELECT source, lang, CAST(1 AS BIGINT) AS bit FROM documents
UNION ALL SELECT source, lang, 2 FROM documents JOIN labels USING (doc_id) WHERE toxic = 1
UNION ALL SELECT source, lang, 4 FROM documents JOIN labels USING (doc_id) WHERE quality = 0) GROUP BY ALL""")
def sets_of_sources(spark, sf_dir):
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    marked = docs.join(labels.select("doc_id", "toxic", "quality"), "doc_id")
    return links.membership([docs, marked.where("toxic = 1"), marked.where("quality = 0")], "source", "lang")


@query("SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_orderdate DESC, o_orderkey DESC LIMIT 50")
def latest_orders(spark, sf_dir):
    return dataset.top_k(table(spark, sf_dir, "orders"), [F.desc("o_orderdate"), F.desc("o_orderkey")], 50).select("o_orderkey", "o_totalprice")


@query("SELECT user_id, event_id FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY value DESC, event_id) AS rn FROM events) WHERE rn <= 3")
def top_three_per_user(spark, sf_dir):
    return dataset.top_k(table(spark, sf_dir, "events"), [F.desc("value"), F.asc("event_id")], 3, ["user_id"]).select("user_id", "event_id")


@query("SELECT user_id, event_type, max(event_id) AS event_id FROM events GROUP BY 1, 2")
def newest_event(spark, sf_dir):
    return dataset.newest_per(table(spark, sf_dir, "events"), ["user_id", "event_type"], [F.desc("ts"), F.desc("event_id")]).select("user_id", "event_type", "event_id")


@query("SELECT user_id, arg_max(event_type, (ts, event_id)) AS event_type, max(event_id) AS event_id FROM events GROUP BY 1")
def last_state(spark, sf_dir):
    return reports.latest(table(spark, sf_dir, "events").select("user_id", "ts", "event_id", "event_type"), ["user_id"], "ts", "event_id").select("user_id", "event_type", "event_id")


# joins


@query("SELECT c_custkey, n_name FROM customer LEFT JOIN nation ON n_nationkey = c_nationkey")
def customer_nation(spark, sf_dir):
    n = table(spark, sf_dir, "nation").withColumnRenamed("n_nationkey", "c_nationkey")
    return links.lookup(table(spark, sf_dir, "customer"), n, "c_nationkey", ["n_name"]).select("c_custkey", "n_name")


@query("""SELECT CASE WHEN o_custkey IS NULL THEN 'unknown' ELSE 'known' END AS side, count(*) AS n, CAST(sum(c_custkey) AS BIGINT) AS keys
FROM customer LEFT JOIN (SELECT DISTINCT o_custkey FROM orders) ON o_custkey = c_custkey GROUP BY 1""")
def cited_customers(spark, sf_dir):
    c = table(spark, sf_dir, "customer").select("c_custkey")
    known, unknown = links.known_unknown(c, table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("c_custkey")), "c_custkey")
    both = known.withColumn("side", F.lit("known")).unionByName(unknown.withColumn("side", F.lit("unknown")))
    return both.groupBy("side").agg(F.count(F.lit(1)).alias("n"), F.sum("c_custkey").alias("keys"))


@query("SELECT l_orderkey, l_linenumber FROM lineitem WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders)")
def orphan_lines(spark, sf_dir):
    return links.orphans(table(spark, sf_dir, "lineitem"), table(spark, sf_dir, "orders"), "l_orderkey", "o_orderkey").select("l_orderkey", "l_linenumber")


@query("""WITH a AS (SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderkey % 5 <> 0), b AS (SELECT o_orderkey, CASE WHEN o_orderkey % 7 = 0 THEN o_totalprice + 1 ELSE o_totalprice END AS o_totalprice FROM orders WHERE o_orderkey % 3 <> 0)
SELECT coalesce(a.o_orderkey, b.o_orderkey) AS o_orderkey, CASE WHEN a.o_orderkey IS NULL THEN 'new' WHEN b.o_orderkey IS NULL THEN 'deleted' ELSE 'changed' END AS change
FROM a FULL JOIN b ON a.o_orderkey = b.o_orderkey WHERE a.o_orderkey IS NULL OR b.o_orderkey IS NULL OR a.o_totalprice <> b.o_totalprice""")
def snapshot_changes(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice")
    after = o.where("o_orderkey % 3 <> 0").withColumn("o_totalprice", F.when(F.col("o_orderkey") % 7 == 0, F.col("o_totalprice") + 1).otherwise(F.col("o_totalprice")))
    return links.snapshot_diff(o.where("o_orderkey % 5 <> 0"), after, ["o_orderkey"], "o_totalprice")


@query("""SELECT n_nationkey AS source_id, n_name, CAST(coalesce(sum(n), 0) AS BIGINT) AS records FROM nation LEFT JOIN (
  SELECT c_nationkey, (SELECT count(*) FROM orders WHERE o_custkey = c_custkey) AS n FROM customer) ON c_nationkey = n_nationkey GROUP BY 1, 2""")
def records_by_source(spark, sf_dir):
    sources = table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("source_id"), "n_name", F.col("n_regionkey").alias("created_at"))
    pairs = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("pair_id"), F.col("c_nationkey").alias("source_id"))
    return links.source_counts(sources, pairs, table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("pair_id"))).select("source_id", "n_name", "records")


@query("""SELECT p_partkey, CASE WHEN p_partkey % 2 = 0 THEN p_size + 100 ELSE p_size END AS p_size FROM part""")
def enriched_index(spark, sf_dir):
    p = table(spark, sf_dir, "part").select("p_partkey", "p_size")
    ref = p.where("p_partkey % 2 = 0").withColumn("p_size", F.col("p_size") + 100)
    return links.enrich_index(p, ref, "p_partkey", ["p_size"])


@query("""SELECT c_custkey AS k, coalesce(b, c_acctbal) AS bal, CASE WHEN c_custkey % 4 = 0 THEN 'UPDATED' ELSE c_mktsegment END AS seg FROM (
  SELECT c_custkey, c_acctbal, c_mktsegment, CASE WHEN c_custkey % 4 = 0 THEN NULL END AS b FROM customer)
UNION ALL SELECT -1 - c_custkey, c_acctbal, 'UPDATED' FROM customer WHERE c_custkey % 4 = 0""")
def upserted_rows(spark, sf_dir):
    from tidemark.sources import sinks

    path = f"{sinks.shared_folder(spark)}/upserted-{uuid.uuid4().hex}"
    c = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("k"), F.col("c_acctbal").alias("bal"), F.col("c_mktsegment").alias("seg"))
    sinks.upsert(spark, path, c, ["k"])
    known = c.where("k % 4 = 0").withColumns({"seg": F.lit("UPDATED"), "bal": F.lit(0.0)})
    new = c.where("k % 4 = 0").withColumns({"k": -1 - F.col("k"), "seg": F.lit("UPDATED")})
    sinks.upsert(spark, path, known.unionByName(new), ["k"], ["seg"])
    return sinks.read_buckets(spark, path)


@query("SELECT o_orderkey FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal < 0)")
def cascade_delete(spark, sf_dir):
    from tidemark.sources.sinks import delete_where

    doomed = table(spark, sf_dir, "customer").where("c_acctbal < 0").select(F.col("c_custkey").alias("o_custkey"))
    return delete_where(table(spark, sf_dir, "orders"), doomed, ["o_custkey"]).select("o_orderkey")


@query("""SELECT 'column_missing' AS "check", 'o_gone' AS key UNION ALL SELECT 'column_extra', column_name FROM (DESCRIBE SELECT * FROM orders) WHERE column_name NOT IN ('o_orderkey', 'o_custkey', 'o_totalprice')
UNION ALL SELECT 'column_type', 'o_totalprice' WHERE (SELECT count(*) FROM orders) > 0""")
def order_schema(spark, sf_dir):
    from tidemark.operators.validate import check_schema

    o = table(spark, sf_dir, "orders")
    want = T.StructType([*[o.schema[c] for c in ("o_orderkey", "o_custkey")], T.StructField("o_totalprice", T.BinaryType()), T.StructField("o_gone", T.StringType())])
    return check_schema(o, want).select("check", "key")


QUERIES, ORACLES = query.queries, query.oracles
