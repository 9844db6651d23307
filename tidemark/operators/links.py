"""Links between streams: lookups, entity links, nearest events, and referential checks."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.scalars import kind_label


def lookup(df: DataFrame, dim: DataFrame, on: str, cols: list[str]) -> DataFrame:
    """df with cols of the row of dim that has the same key, null where there is none. Spark broadcasts dim if it is small."""
    return df.join(dim.select(on, *cols), on, "left")


def message_edges(messages: DataFrame) -> DataFrame:
    """(entity, message_id, pr_number, ts): one edge for each ticket and pull request that a message names; an edge to a
    ticket carries the pull requests named with it."""
    base = messages.select("message_id", "ts", "mentions_ticket", "mentions_pr")
    tickets = base.select(F.explode("mentions_ticket").alias("entity"), "message_id", F.explode_outer("mentions_pr").alias("pr_number"), "ts")
    pulls = base.select("message_id", "ts", F.explode("mentions_pr").alias("pr_number"))
    return tickets.unionByName(pulls.select(F.concat(F.lit("PR#"), "pr_number").alias("entity"), "message_id", "pr_number", "ts"))


def issue_edges(issues: DataFrame) -> DataFrame:
    none = F.lit(None)
    return issues.select(F.col("issue_key").alias("entity"), none.cast("string").alias("message_id"), none.cast("int").alias("pr_number"), F.col("created_at").alias("ts"))


def pull_edges(pulls: DataFrame) -> DataFrame:
    return pulls.where("merged").select(F.concat(F.lit("PR#"), "pr_number").alias("entity"), F.lit(None).cast("string").alias("message_id"), "pr_number", F.col("merged_at").alias("ts"))


def entity_links(edges: DataFrame) -> DataFrame:
    """Edges (entity, message_id, pr_number, ts), of any kinds in one table, folded by entity: the sorted ids that touch
    it, and when it was first and last touched."""
    return edges.groupBy("entity").agg(
        F.array_sort(F.collect_set("message_id")).alias("message_ids"),
        F.array_sort(F.collect_set("pr_number")).alias("pr_numbers"),
        F.min("ts").alias("first_ts"),
        F.max("ts").alias("last_ts"),
    ).withColumn("kind", kind_label(F.col("entity")))


def prs_by_ticket(messages: DataFrame, pulls: DataFrame) -> DataFrame:
    """(ticket, pr_numbers): known pull requests named together with a ticket, in order of first mention."""
    pairs = messages.select("ts", "mentions_pr", F.explode("mentions_ticket").alias("ticket")).select("ticket", "ts", F.explode("mentions_pr").alias("pr_number"))
    first = pairs.join(pulls.select("pr_number"), "pr_number", "left_semi").groupBy("ticket", "pr_number").agg(F.min("ts").alias("ts"))
    ordered = F.array_sort(F.collect_list(F.struct("ts", "pr_number")))
    return first.groupBy("ticket").agg(F.transform(ordered, lambda x: x["pr_number"]).alias("pr_numbers"))


def shas_by_ticket(tickets: DataFrame, pulls: DataFrame) -> DataFrame:
    """(ticket, shas): the merge commits of those pull requests."""
    each = tickets.select("ticket", F.explode("pr_numbers").alias("pr_number"))
    found = each.join(pulls.where("merge_sha IS NOT NULL").select("pr_number", "merge_sha"), "pr_number")
    return found.groupBy("ticket").agg(F.array_sort(F.collect_set("merge_sha")).alias("shas"))


def nearest(left: DataFrame, right: DataFrame, key: str, left_ts: str, right_ts: str, right_id: str, bucket_seconds: int = 86_400) -> DataFrame:
    """For each row of left the right row of the same key whose time is nearest, before or after; ties to the smaller id.
    Adds right_id, right_ts and gap_seconds; rows without a match, or without a time, are kept. A null key equals a null key.

    No pairs are made: the last right row before and the first one after are running values over both sides in time
    order. They run inside buckets of time, so that a key with very many rows is dealt out; what lies in other buckets is
    carried over from a table with a row for each bucket of a key."""
    l_cols = [c for c in left.columns if c != key]
    one = left.select(key, F.col(left_ts).alias("__ts"), F.struct(*l_cols).alias("__left"), F.lit(None).cast(f"struct<ts: timestamp, id: {right.schema[right_id].dataType.simpleString()}>").alias("__right"))
    two = right.where(F.col(right_ts).isNotNull()).select(key, F.col(right_ts).alias("__ts"), F.lit(None).cast(one.schema["__left"].dataType).alias("__left"), F.struct(F.col(right_ts).cast("timestamp").alias("ts"), F.col(right_id).alias("id")).alias("__right"))
    two = two.groupBy(key, "__ts").agg(F.first("__left").alias("__left"), F.min("__right").alias("__right"))
    both = one.unionByName(two).withColumn("__bucket", F.floor(F.unix_seconds(F.col("__ts").cast("timestamp")) / bucket_seconds))
    back = Window.partitionBy(key, "__bucket").orderBy("__ts").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    ahead = Window.partitionBy(key, "__bucket").orderBy("__ts").rangeBetween(Window.currentRow, Window.unboundedFollowing)
    seen = both.withColumns({"__b": F.last("__right", ignorenulls=True).over(back), "__a": F.first("__right", ignorenulls=True).over(ahead)}).where("__left IS NOT NULL")
    ends = both.where("__bucket IS NOT NULL").groupBy(F.col(key).alias("__key"), F.col("__bucket").alias("__at")).agg(F.min("__right").alias("__first"), F.max("__right").alias("__last"))
    by_bucket = Window.partitionBy("__key").orderBy("__at")
    carried = ends.select(
        "__key", "__at", F.last("__last", ignorenulls=True).over(by_bucket.rowsBetween(Window.unboundedPreceding, -1)).alias("__earlier"),
        F.first("__first", ignorenulls=True).over(by_bucket.rowsBetween(1, Window.unboundedFollowing)).alias("__later"),
    )
    seen = seen.join(carried, F.col(key).eqNullSafe(F.col("__key")) & (F.col("__bucket") == F.col("__at")), "left")
    seen = seen.withColumns({"__b": F.coalesce("__b", "__earlier"), "__a": F.coalesce("__a", "__later")})

    def gap(c: str) -> Column:
        return F.abs(F.unix_micros(F.col(f"{c}.ts")) - F.unix_micros(F.col("__ts").cast("timestamp")))

    before, after = gap("__b"), gap("__a")
    pick = F.when(after.isNull() | (before < after) | ((before == after) & (F.col("__b.id") <= F.col("__a.id"))), F.col("__b")).otherwise(F.col("__a"))
    return seen.withColumn("__p", pick).select(key, "__left.*", F.col("__p.id").alias(right_id), F.col("__p.ts").alias(right_ts), F.round(F.least(before, after) / 1e6, 6).alias("gap_seconds"))


def known_unknown(cited: DataFrame, known: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    """The cited rows whose key exists, and those whose key does not."""
    keys = known.select(key).distinct()
    return cited.join(keys, key, "left_semi"), cited.join(keys, key, "left_anti")


def orphans(child: DataFrame, parent: DataFrame, on: str, parent_on: str | None = None) -> DataFrame:
    """Child rows whose non-null key no parent has."""
    keys = parent.select(F.col(parent_on or on).alias(on)).distinct()
    return child.where(F.col(on).isNotNull()).join(keys, on, "left_anti")


def membership(sets: list[DataFrame], *on: str) -> DataFrame:
    """(on, held): every distinct key of the sets; bit i of `held` says whether the i-th set has it (up to 62 sets). One
    union and one aggregate, combined before its shuffle, however many the sets; null keys equal one another, repeats
    count once, other columns are not read. No key column may be called held."""
    if not 0 < len(sets) < 63 or "held" in on:
        raise ValueError("membership takes 1 to 62 sets and no key called held")
    marked = [s.select(*on, F.lit(1 << i).cast("long").alias("held")) for i, s in enumerate(sets)]
    return reduce(DataFrame.unionByName, marked).groupBy(*on).agg(F.bit_or("held").alias("held"))


def in_any(sets: list[DataFrame], *on: str) -> DataFrame:
    """The distinct keys of all sets together."""
    return membership(sets, *on).drop("held")


def in_all(sets: list[DataFrame], *on: str) -> DataFrame:
    """The distinct keys that every set has."""
    return membership(sets, *on).where(F.col("held") == (1 << len(sets)) - 1).drop("held")


def in_first_only(sets: list[DataFrame], *on: str) -> DataFrame:
    """The distinct keys of the first set that no other has."""
    return membership(sets, *on).where("held = 1").drop("held")


def task_documents(tasks: DataFrame, documents: DataFrame, attachments: DataFrame) -> DataFrame:
    """(task_id, path): documents linked to a task by its ticket, or attached to messages of its slice (task_id, path). Two
    equi-joins and a distinct union, not a join with OR."""
    by_key = tasks.select("task_id", F.col("ticket").alias("issue_key")).join(documents.select("issue_key", "path"), "issue_key").select("task_id", "path")
    by_path = attachments.select("task_id", "path").join(documents.select("path"), "path", "left_semi")
    return by_key.unionByName(by_path).distinct()


def runs_with_windows(runs: DataFrame, windows: DataFrame, status: str = "succeeded") -> DataFrame:
    return runs.where(F.col("status") == status).join(windows.drop("title", "task_id"), "window_id")


def eval_with_jobs(results: DataFrame, jobs: DataFrame) -> DataFrame:
    return results.join(jobs, "job_id")


def active_sessions(sessions: DataFrame, users: DataFrame, now: Column) -> DataFrame:
    """Sessions that have not expired, with their users; tokens are left out."""
    return sessions.where(F.col("expires_at") > now).drop("token").join(users, "user_id")


def source_counts(sources: DataFrame, pairs: DataFrame, records: DataFrame) -> DataFrame:
    """Each source with how many records its pairs hold, 0 included, the newest first."""
    held = records.groupBy("pair_id").agg(F.count(F.lit(1)).alias("n"))
    per = pairs.join(held, "pair_id", "left").groupBy("source_id").agg(F.coalesce(F.sum("n"), F.lit(0)).alias("records"))
    return sources.join(per, "source_id", "left").withColumn("records", F.coalesce("records", F.lit(0))).orderBy(F.desc("created_at"), "source_id")


def enrich_index(index: DataFrame, ref: DataFrame, key: str, cols: list[str]) -> DataFrame:
    """The index with cols of the reference where the reference has them."""
    right = ref.select(key, *[F.col(c).alias(f"__{c}") for c in cols])
    both = index.join(right, key, "left")
    return both.select(key, *[F.coalesce(F.col(f"__{c}"), F.col(c)).alias(c) if c in cols else F.col(c) for c in index.columns if c != key])


#: Buckets that rows of two snapshots are dealt into; the list of those that differ is no longer than this.
SNAPSHOT_BUCKETS = 4096


def _told_apart(columns: list[str]) -> list[Column]:
    """Columns for a hash that passes over nulls: each with whether it is null."""
    return [c for k in columns for c in (F.col(k).isNull(), F.col(k))]


def _both_sides(before: DataFrame, after: DataFrame, keys: list[str], content: str) -> DataFrame:
    """(keys, __content, __side, __bucket): the rows of before with -1, those of after with 1."""
    marked = [df.select(*keys, F.col(content).cast("string").alias("__content"), F.lit(n).alias("__side")) for df, n in ((before, -1), (after, 1))]
    return marked[0].unionByName(marked[1]).withColumn("__bucket", F.pmod(F.xxhash64(*_told_apart(keys)), F.lit(SNAPSHOT_BUCKETS)))


def changed_buckets(sides: DataFrame, keys: list[str]) -> DataFrame:
    """(__bucket): buckets whose rows differ between the sides. Two 64-bit hashes of each row are summed by halves, one side
    against the other, whatever the order; equal buckets come to zero. The sums are combined before their shuffle."""
    hashes = [F.xxhash64(F.lit(seed), *_told_apart([*keys, "__content"])) for seed in (1, 2)]
    halves = [half for h in hashes for half in (h.bitwiseAND(F.lit(0xFFFFFFFF)), F.shiftrightunsigned(h, 32))]
    sums = [F.sum(half * F.col("__side")).alias(f"__sum{i}") for i, half in enumerate(halves)]
    apart = reduce(Column.__or__, [F.col(f"__sum{i}") != 0 for i in range(len(halves))])
    return sides.groupBy("__bucket").agg(*sums).where(apart).select("__bucket")


def snapshot_diff(before: DataFrame, after: DataFrame, keys: list[str], content: str) -> DataFrame:
    """(keys, change): keys that are new, changed or deleted between two snapshots, by a digest of content. Null keys equal one
    another, and so do null contents; a key with several rows is unchanged where both snapshots hold the same contents for
    it equally often.

    Only rows of buckets that differ are shuffled and compared, so two large snapshots with few changes cost two scans."""
    sides = _both_sides(before, after, keys, content)
    rows = sides.join(F.broadcast(changed_buckets(sides, keys)), "__bucket", "left_semi")  # SNAPSHOT_BUCKETS rows at most
    rows = rows.withColumn("__digest", F.unhex(F.sha2("__content", 256)))
    held = rows.groupBy(*keys, "__digest").agg(F.count_if(F.col("__side") < 0).alias("__b"), F.count_if(F.col("__side") > 0).alias("__a"))
    found = held.groupBy(*keys).agg(F.sum("__b").alias("__b"), F.sum("__a").alias("__a"), F.bool_or(F.col("__b") != F.col("__a")).alias("__apart"))
    change = F.when(F.col("__b") == 0, "new").when(F.col("__a") == 0, "deleted").when(F.col("__apart"), "changed")
    return found.select(*keys, change.alias("change")).where("change IS NOT NULL")
