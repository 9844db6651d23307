"""The registered queries of the corpus operators, and SQL for those that SQL can express."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import decontamination, language, line_dedup, mixing, periodic, phrases, quality, simhash, suffix_dedup, token_files, topk, toxicity, vector_dedup
from tidemark.llm.common import crc32_mod, shared_dir, table


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    held_out = crc32_mod(F.col("doc_id"), 5) == 0
    model = toxicity.fit(docs, table(spark, sf_dir, "labels").where(~held_out), "toxic")
    return toxicity.score(docs, model, extra={"held_out": held_out}).withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def op6_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0, k=10, scale=1024)


_OP6_SQL = """
WITH v AS (
  SELECT vec_id, [CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT) FOR x IN embedding] AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
c AS (SELECT vec_id, unnest(v) AS x, unnest(range(len(v))) AS i FROM v),
s AS (SELECT q.vec_id AS query_id, c.vec_id, CAST(sum(q.x * c.x) AS BIGINT) AS score
      FROM c q JOIN c ON q.i = c.i AND q.vec_id <> c.vec_id WHERE q.vec_id % 100 = 0 GROUP BY 1, 2)
SELECT * FROM (SELECT query_id, vec_id, score,
  CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM s) WHERE rank <= 10
"""


def op7_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = suffix_dedup.remove_repeats(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return kept.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def op8_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    held_out = crc32_mod(F.col("doc_id"), 5) == 0
    return language.predict(docs, language.fit(docs.where(~held_out)), extra={"held_out": held_out})


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    held_out = crc32_mod(F.col("doc_id"), 4) == 2
    model = quality.fit(docs, table(spark, sf_dir, "labels").where(~held_out), "quality")
    return quality.score(docs, model, extra={"held_out": held_out}).withColumn("predicted", (F.col("score") >= 0.7).cast("int"))


def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    state = line_dedup.LineDedup.build(docs, min_docs=10)
    kept = state.apply(docs)
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2(F.encode("kept", "UTF-8"), 256).alias("kept_sha256"))


def op1_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    mixed, _ = mixing.mix(docs, max_repeat=4.0)
    return mixed.select("doc_id", "source", F.col("__tokens").alias("n_tokens"), F.col("__weight").alias("weight"), F.col("__copies").alias("copies"))


def op2_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = simhash.near_duplicates(docs, shingle=3, max_bits=2)
    return found.select("doc_id", simhash.as_hex(F.col("fp")).alias("fingerprint"), "component_id")


def op4_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    path = f"{shared_dir(spark)}/token-files-{uuid.uuid4().hex}"
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    token_files.write(docs, path, public_tokenizers.path("word_bpe_49k.json"), end_id=1)
    return token_files.read_documents(spark, path)


def op5_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = decontamination.hits(docs, table(spark, sf_dir, "benchmark").select("item_id", "text"), window=10)
    hit = decontamination.words_hit(F.col("spans")).cast("long")
    return found.select(
        "doc_id",
        F.col("n_words").cast("long").alias("n_words"),
        hit.alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (hit > 0).alias("contaminated"),
    )


_WORDS_SQL = r"""[x FOR x IN string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
  'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+') IF x <> '']"""
_OP5_SQL = rf"""
WITH d AS MATERIALIZED (SELECT doc_id, {_WORDS_SQL} AS w FROM documents),
b AS (SELECT item_id, {_WORDS_SQL} AS w FROM benchmark),
win AS MATERIALIZED (
  SELECT DISTINCT item_id, unnest(CASE WHEN len(w) < 10 THEN [array_to_string(w, ' ')]
    ELSE [array_to_string(w[i + 1:i + 10], ' ') FOR i IN range(len(w) - 9)] END) AS key,
    least(len(w), 10) AS size
  FROM b WHERE len(w) > 0),
sizes AS (SELECT DISTINCT size FROM win),
run AS (
  SELECT doc_id, size, unnest(range(len(w) - size + 1)) AS start,
         unnest([array_to_string(w[i + 1:i + size], ' ') FOR i IN range(len(w) - size + 1)]) AS key
  FROM d, sizes WHERE len(w) >= size),
hit AS MATERIALIZED (SELECT doc_id, start, run.size AS size, item_id FROM run JOIN win ON run.key = win.key AND run.size = win.size),
covered AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(start, start + size)) AS p FROM hit) GROUP BY 1),
item AS (SELECT doc_id, count(*) AS n_items, string_agg(i, ',' ORDER BY i) AS ids
         FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS i FROM hit) GROUP BY 1)
SELECT d.doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN covered USING (doc_id) LEFT JOIN item USING (doc_id)
"""

_OP10_SQL = r"""
WITH line AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
         unnest(range(len(string_split(coalesce(text, ''), chr(10))))) AS pos
  FROM documents),
keyed AS (
  SELECT doc_id, pos, line,
         translate(regexp_replace(line, '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g'),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM line),
hot AS (SELECT key FROM keyed WHERE key <> '' GROUP BY key HAVING count(DISTINCT doc_id) >= 10)
SELECT k.doc_id, count(*) AS n_lines, count(h.key) AS n_dropped,
       sha256(coalesce(string_agg(k.line, chr(10) ORDER BY pos) FILTER (WHERE h.key IS NULL), '')) AS kept_sha256
FROM keyed k LEFT JOIN hot h ON k.key = h.key GROUP BY k.doc_id
"""


def op11_vector_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_dedup.near_vectors(table(spark, sf_dir, "embeddings"), threshold=0.95)


_OP11_SQL = """
WITH RECURSIVE v AS MATERIALIZED (
  SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0
    AND len([x FOR x IN embedding IF x <> 0]) > 0),
link AS MATERIALIZED (SELECT a.vec_id AS x, b.vec_id AS y FROM v a JOIN v b ON a.vec_id <> b.vec_id
         WHERE list_cosine_similarity(a.e, b.e) >= 0.95),
reach AS (SELECT vec_id AS x, vec_id AS y FROM embeddings UNION SELECT r.x, l.y FROM reach r JOIN link l ON r.y = l.x),
low AS (SELECT x, min(y) AS component_id FROM reach GROUP BY 1),
n AS (SELECT x, count(*) AS n_links FROM link GROUP BY 1)
SELECT vec_id, coalesce(n_links, 0) AS n_links, component_id, vec_id = component_id AS kept
FROM embeddings JOIN low ON vec_id = low.x LEFT JOIN n ON vec_id = n.x
"""


def with_planted_runs(docs: DataFrame) -> DataFrame:
    """(doc_id, text): one document in ten, by the crc32 of its id, goes on from some word a by repeating its own words from
    a on, with a period of a few parts of the rest; the others are as they are."""
    h = crc32_mod(F.col("doc_id"), 1 << 32)
    found = docs.select("doc_id", "text", F.floor(h / 10).alias("g"), F.when(h % 10 == 0, F.array_remove(F.split("text", r"[\x20\x09-\x0D]+"), "")).alias("w"))
    found = found.withColumns({"n": F.size("w"), "a": F.when(F.size("w") > 0, F.col("g") % F.size("w"))})
    found = found.withColumn("p", 1 + F.floor((F.col("n") - F.col("a")) / (3 + F.col("g") % 8)))
    at = lambda i: F.when(i < F.col("a"), i).otherwise(F.col("a") + (i - F.col("a")) % F.col("p")).cast("int")
    periodic = F.array_join(F.transform(F.sequence(F.lit(0), F.col("n") - 1), lambda i: F.get("w", at(i))), " ")
    return found.select("doc_id", F.when(F.col("a").isNotNull(), periodic).otherwise(F.col("text")).alias("text"))


def op12_periodic(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periodic.periodic_runs(with_planted_runs(table(spark, sf_dir, "documents").select("doc_id", "text")))
    longest = F.array_max(F.transform("runs", lambda r: F.struct(r["length"], (-r["start"]).alias("start"), (-r["period"]).alias("period"))))
    said = F.array_join(F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n"))), "")
    found = found.withColumn("x", longest)
    return found.select(
        "doc_id",
        F.size("runs").cast("bigint").alias("n_runs"),
        (-F.col("x.start")).alias("start"),
        F.col("x.length").alias("length"),
        (-F.col("x.period")).alias("period"),
        F.floor(1000 * F.col("x.length") / -F.col("x.period")).alias("exponent_milli"),
        F.sha2(said, 256).alias("runs_sha256"),
        F.sha2(F.encode("collapsed", "UTF-8"), 256).alias("collapsed_sha256"),
    )


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.collocations(table(spark, sf_dir, "documents").select("text", "lang"), most_words=4, min_count=30, covered=(80, 100), best=2000)


_OP13_SQL = r"""
WITH piece AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
p AS MATERIALIZED (SELECT lang, [x FOR x IN string_split_regex(piece, '[\x20\x09]+') IF x <> ''] AS w FROM piece),
total AS (SELECT lang, CAST(sum(len(w)) AS BIGINT) AS n FROM p GROUP BY 1),
f AS MATERIALIZED (
  SELECT lang, k, phrase, count(*) AS n FROM (
    SELECT lang, k, unnest([array_to_string(w[i:i + k - 1], ' ') FOR i IN range(1, len(w) - k + 2)]) AS phrase
    FROM p, (SELECT unnest([1, 2, 3, 4]) AS k) WHERE len(w) >= k)
  GROUP BY 1, 2, 3 HAVING count(*) >= 30),
cut AS (
  SELECT lang, k, phrase, n AS a, c, array_to_string(string_split(phrase, ' ')[1:c], ' ') AS lp,
         array_to_string(string_split(phrase, ' ')[c + 1:k], ' ') AS rp
  FROM f, (SELECT unnest([1, 2, 3]) AS c) WHERE k > c),
s AS (
  SELECT cut.lang, cut.k, cut.phrase, a, x.n AS l, y.n AS r, c, CAST((CAST(a AS HUGEINT) * 2000000) // (x.n + y.n) AS BIGINT) AS score
  FROM cut JOIN f x ON x.lang = cut.lang AND x.phrase = lp JOIN f y ON y.lang = cut.lang AND y.phrase = rp),
best AS (SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, c) = 1),
dropped AS (
  SELECT DISTINCT b.lang, b.phrase FROM best b JOIN (
    SELECT lang, array_to_string(string_split(phrase, ' ')[i:i + len - 1], ' ') AS phrase, max(n) AS n
    FROM f, (SELECT unnest([2, 3]) AS len), (SELECT unnest([1, 2, 3]) AS i) WHERE k > len AND i + len - 1 <= k GROUP BY 1, 2) m
  ON b.lang = m.lang AND b.phrase = m.phrase WHERE 100 * m.n >= 80 * b.a),
ranked AS (
  SELECT b.lang, row_number() OVER (PARTITION BY b.lang ORDER BY score DESC, a DESC, b.phrase) AS rank, b.phrase, a, l, r, score
  FROM best b LEFT JOIN dropped d ON b.lang = d.lang AND b.phrase = d.phrase WHERE d.phrase IS NULL)
SELECT ranked.lang, rank, phrase, a, l, r, n, score FROM ranked JOIN total ON ranked.lang = total.lang WHERE rank <= 2000
"""


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (op1_mixing, op2_simhash, op3_toxicity, op4_token_files, op5_decontaminate, op6_topk, op7_suffix_dedup, op8_language, op9_quality, op10_line_dedup,
                                     op11_vector_dedup, op12_periodic, op13_collocations)}


def oracle_sql() -> dict[str, str]:
    return {"op5_decontaminate": _OP5_SQL, "op6_topk": _OP6_SQL, "op10_line_dedup": _OP10_SQL, "op11_vector_dedup": _OP11_SQL, "op13_collocations": _OP13_SQL}
