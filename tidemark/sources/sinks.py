"""Sinks: upsert and rebuild of Parquet tables, slices by task, training sets."""

from __future__ import annotations

import json
import re
import tempfile
import uuid
from collections.abc import Iterator
from pathlib import Path

import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, StructType


def merged_rows(target: DataFrame, updates: DataFrame, keys: list[str], update_cols: list[str] | None = None) -> DataFrame:
    """target after an upsert: rows of new keys are added; of known keys only update_cols change (all, if None). Keys
    compare null-safely; the last of repeated updates is undefined, so updates should be unique by key."""
    changed = [c for c in target.columns if c not in keys] if update_cols is None else update_cols
    new = updates.select([F.col(c).alias(f"__{c}") for c in updates.columns]).withColumn("__new", F.lit(True))
    old = target.withColumn("__old", F.lit(True))
    same = [F.col(k).eqNullSafe(F.col(f"__{k}")) for k in keys]
    both = old.join(new, same, "full_outer")
    out = []
    for c in target.columns:
        mine = F.col(f"__{c}") if c in updates.columns else F.lit(None).cast(target.schema[c].dataType)
        fresh = F.col("__old").isNull() | (F.col("__new").isNotNull() & F.lit(c in changed and c in updates.columns))
        out.append(F.when(fresh, mine).otherwise(F.col(c)).alias(c))
    return both.select(*out)


def shared_folder(spark: SparkSession) -> str:
    """The folder in spark.checkpoint.dir, which driver and executors share; one of our own only on one machine."""
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not found:
        if not re.match(r"local($|\[)", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        found = Path(tempfile.mkdtemp(prefix="shared-")).as_uri()
        spark.sparkContext.setCheckpointDir(found)
    return found


def settled(df: DataFrame, name: str = "settled") -> DataFrame:
    """df written as a table in the shared folder, and that table: lineage ends there, and executors may go."""
    spark, path = df.sparkSession, f"{shared_folder(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def forget(df: DataFrame) -> None:
    """Delete the tables of settled() that df reads, when nothing else does any more."""
    for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        path = df.sparkSession._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(path, True)


def exists(spark: SparkSession, path: str) -> bool:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)


#: Buckets of a table that upsert() makes; each is a partition, so about a gigabyte each is a good size.
BUCKETS = 64
_BUCKET = re.compile(r"bucket_of_(\d+)=(\d+)$")


def _buckets(spark: SparkSession, path: str) -> tuple[int | None, list[int]]:
    """How many buckets the table at path is dealt into (None: there is no such table), and those that hold rows."""
    found = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/bucket_of_*=*")
    there = found.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(found) or []
    names = [m for m in (_BUCKET.search(x.getPath().toString()) for x in there) if m]
    return (int(names[0][1]) if names else None), sorted(int(m[2]) for m in names)


def _bucket(keys: list[str], n: int) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(n)).cast("int")


def is_dealt(spark: SparkSession, path: str) -> bool:
    """Whether upsert() or replace() has put any rows there."""
    return _buckets(spark, path)[0] is not None


def _as_kept(df: DataFrame, table: DataFrame) -> DataFrame:
    """df with the table's types, as equal values of different types are not dealt out alike."""
    return df.select([F.col(c).cast(table.schema[c].dataType) if c in table.columns else F.col(c) for c in df.columns])


def read_buckets(spark: SparkSession, path: str, keys: DataFrame | None = None) -> DataFrame:
    """A table that upsert() or replace() keeps; with keys (the columns that deal it out) only the buckets in which rows of
    those keys can lie, and of these only the rows whose keys are among them."""
    n, _ = _buckets(spark, path)
    if n is None:
        raise FileNotFoundError(f"no table at {path}")
    rows = spark.read.parquet(path)
    if keys is not None:
        keys = _as_kept(keys, rows)
        rows = rows.where(F.col(f"bucket_of_{n}").isin(_touched(keys, keys.columns, n)))
        wanted = keys.distinct().select([F.col(k).alias(f"__{k}") for k in keys.columns])
        rows = rows.join(wanted, [F.col(k).eqNullSafe(F.col(f"__{k}")) for k in keys.columns], "left_semi")
    return rows.drop(f"bucket_of_{n}")


def _touched(df: DataFrame, keys: list[str], n: int) -> list[int]:
    return sorted(r[0] for r in df.select(_bucket(keys, n)).distinct().collect())


def _put(spark: SparkSession, path: str, rows: DataFrame, keys: list[str], n: int, touched: list[int]) -> None:
    """Put rows in the place of the touched buckets, by Spark's dynamic partition overwrite: it writes beside the table and
    then moves the finished buckets in. A bucket that holds no rows any more is taken away."""
    fs_path = spark._jvm.org.apache.hadoop.fs.Path
    fs = fs_path(path).getFileSystem(spark._jsc.hadoopConfiguration())
    folders = {b: fs_path(f"{path}/bucket_of_{n}={b}") for b in touched}
    before = {b: {x.getPath().getName() for x in fs.listStatus(f)} for b, f in folders.items() if fs.exists(f)}
    name = f"bucket_of_{n}"
    dealt = rows.withColumn(name, _bucket(keys, n)).hint("rebalance", name)
    dealt.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(name).parquet(path)
    for b, names in before.items():
        if names & {x.getPath().getName() for x in fs.listStatus(folders[b])}:  # nothing has come in its place
            fs.delete(folders[b], True)


def upsert(spark: SparkSession, path: str, updates: DataFrame, keys: list[str], update_cols: list[str] | None = None, deal_by: list[str] | None = None,
           buckets: int = BUCKETS) -> None:
    """Upsert into the Parquet table at path. The table is dealt into buckets by a hash of its keys (or of deal_by, some of
    them); only the buckets that updates fall into are read, joined and overwritten, and the table is there all the time.
    One writer at a time. A table keeps the number of buckets with which it was made. If a run is lost while it moves
    finished buckets in, run the upsert again."""
    deal_by = deal_by or keys
    n, there = _buckets(spark, path)
    if n is not None:
        updates = _as_kept(updates, spark.read.parquet(path))
    n = n or buckets
    touched = _touched(updates, deal_by, n)
    if set(touched) & set(there):
        old = spark.read.parquet(path).where(F.col(f"bucket_of_{n}").isin(touched)).drop(f"bucket_of_{n}")
        updates = merged_rows(old, updates, keys, update_cols)
    _put(spark, path, updates, deal_by, n, touched)


def replace(spark: SparkSession, path: str, doomed: DataFrame, rows: DataFrame, buckets: int = BUCKETS) -> None:
    """Take the rows of doomed keys (whose columns deal the table out) away and put rows, which have such keys, in; as with
    upsert() only the buckets of those keys are read and written."""
    keys = doomed.columns
    n, there = _buckets(spark, path)
    if n is not None:
        doomed, rows = (_as_kept(df, spark.read.parquet(path)) for df in (doomed, rows))
    n = n or buckets
    touched = _touched(doomed.unionByName(rows.select(keys)), keys, n)
    if set(touched) & set(there):
        old = spark.read.parquet(path).where(F.col(f"bucket_of_{n}").isin(touched)).drop(f"bucket_of_{n}")
        rows = delete_where(old, doomed, keys).unionByName(rows)
    _put(spark, path, rows, keys, n, touched)


def rebuild(df: DataFrame, path: str, partition_by: list[str] | None = None, only_touched: bool = False) -> None:
    """Overwrite a table; only_touched: of a partitioned one, just the partitions that df has rows for."""
    writer = df.write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(*partition_by).option("partitionOverwriteMode", "dynamic" if only_touched else "static")
    writer.parquet(path)


#: Characters that Spark writes as %XX in the names of folders for values, and the name for no value.
_ODD, _NOTHING = re.compile("[\x00-\x1f\"#%'*/:=?\\\\\x7f{\\[\\]^]"), "__HIVE_DEFAULT_PARTITION__"


def _for_arrow(path: str) -> str:
    return re.sub(r"^file:/+", "file:///", path)


def _is_known(path: str) -> bool:
    """Whether Arrow can write to the store of a path."""
    try:
        return bool(pa.fs.FileSystem.from_uri(_for_arrow(path)))
    except (pa.ArrowInvalid, pa.ArrowNotImplementedError):
        return False


def write_texts(df: DataFrame, path: str, by: list[str], order: list[str], line: Column, around: tuple[str, str, str] = ("", "\n", "\n"), name: str = "part-0.json",
                tasks: int | None = None, listed: str | None = None) -> None:
    """A text file `name` in a folder (a=1/b=2) for each value of `by`: its rows in order, as what `line` makes of each one (null
    is left out), with something before them, between them and after them.

    Rows are dealt out and sorted before they become text, and a task writes one file after the other, so nothing is gathered.
    They are dealt over `tasks`; as adaptive execution sees fit, among as many as the session shuffles into, if None.
    Files come into their places whole, so a task that runs again does no harm. There is no job of Spark's that moves them in,
    and no process for the rights of each one: the time is that of making a file. listed: a Parquet table to make of the
    files (values: a JSON array of the texts of `by`, path: below `path`, bytes), so that no reader has to look for them."""
    uri, odd, nothing = _for_arrow(path), _ODD, _NOTHING
    before, between, after = (x.encode() for x in around)
    store, base = pa.fs.FileSystem.from_uri(uri)
    store.create_dir(base, recursive=True)

    def put(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = pa.fs.FileSystem.from_uri(uri)
        out = values = at = draft = None
        size, done = 0, []

        def finish():
            if out is not None:
                out.write(after)
                out.close()
                store.move(draft, f"{base}/{at}/{name}")
                done.append((values, f"{at}/{name}", size + len(after)))

        def told():
            found = pa.RecordBatch.from_arrays([pa.array([x[i] for x in done], kind) for i, kind in enumerate((pa.string(), pa.string(), pa.int64()))], ["values", "path", "bytes"])
            done.clear()
            return found

        for batch in batches:
            folders, lines, n = batch.column(0), batch.column(1).to_pylist(), batch.num_rows
            starts = [0, *(i for i, new in enumerate(pc.not_equal(folders.slice(1), folders.slice(0, n - 1)).to_pylist(), 1) if new)] if n else []
            for first, last in zip(starts, [*starts[1:], n], strict=False):
                own, text = folders[first].as_py(), between.join(lines[first:last])
                if own == values:
                    out.write(between + text)
                    size += len(between) + len(text)
                    continue
                finish()
                values, at = own, "/".join(f"{k}={odd.sub(lambda m: f'%{ord(m[0]):02X}', v) if v else nothing}" for k, v in zip(by, json.loads(own), strict=True))
                draft, size = f"{base}/{at}/_{uuid.uuid4().hex}", len(before) + len(text)
                store.create_dir(f"{base}/{at}", recursive=True)
                out = store.open_output_stream(draft)
                out.write(before + text)
            yield told()
        finish()
        yield told()

    values = F.to_json(F.array(*[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in by])).alias("values")
    dealt = df.repartition(*([tasks] if tasks else []), *[F.col(c) for c in by]).sortWithinPartitions(*by, *order)
    files = dealt.select(values, line.alias("line")).where("line IS NOT NULL").withColumn("line", F.encode("line", "UTF-8"))
    made = files.mapInArrow(put, "values string, path string, bytes bigint").write.mode("overwrite")
    made.parquet(listed) if listed else made.format("noop").save()


#: The table of its files in a folder of slices; Spark passes over names like it when it reads the folder.
LISTED = "_files"
#: How many files a task reads, and how many bytes, about.
FILES, BYTES = 20_000, 1 << 26
#: How many bytes of a file are read at once.
PIECE = 1 << 20


def write_task_slices(df: DataFrame, path: str, task: str = "task_id", stream: str = "source_table") -> None:
    """JSON lines in a folder for each task and stream, and beside them a table of the files."""
    if not _is_known(path):
        df.repartition(F.col(task), F.col(stream)).write.mode("overwrite").partitionBy(task, stream).json(path)
        return
    old = df.sparkSession._jvm.org.apache.hadoop.fs.Path(path)
    old.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(old, True)
    row = F.to_json(F.struct(*[c for c in df.columns if c not in (task, stream)]))
    write_texts(df, path, [task, stream], [], row, listed=f"{path}/{LISTED}")


def read_task_slices(spark: SparkSession, path: str, schema: str, task: str = "task_id", stream: str = "source_table") -> DataFrame:
    """All rows of the slices at path, with the columns of schema.

    The files are those of the table that write_task_slices made, dealt out evenly: Spark itself looks through all folders
    first, keeps all files on the driver, and opens few of them a task. Without that table it is left to Spark."""
    if not (_is_known(path) and exists(spark, f"{path}/{LISTED}")):
        return spark.read.schema(schema).json(path).select(*DataType.fromDDL(schema).names)
    uri, piece = _for_arrow(path), PIECE
    files = spark.read.schema("values string, path string, bytes bigint").parquet(f"{path}/{LISTED}")
    n, size = files.agg(F.count(F.lit(1)), F.coalesce(F.sum("bytes"), F.lit(0))).first()
    tasks = max(spark.sparkContext.defaultParallelism, -(-n // FILES), -(-size // BYTES))

    def texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Pieces of files, of whole lines."""
        store, base = pa.fs.FileSystem.from_uri(uri)
        told = lambda held: pa.RecordBatch.from_arrays([pa.array([x[i] for x in held], pa.string()) for i in range(2)], ["values", "text"])
        for batch in batches:
            held, size = [], 0
            for values, at in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                with store.open_input_stream(f"{base}/{at}") as file:
                    rest = []
                    while more := file.read(piece):
                        whole, end, left = more.rpartition(b"\n")
                        if not end:
                            rest.append(left)
                            continue
                        held.append((values, b"".join([*rest, whole])))
                        size, rest = size + len(held[-1][1]), [left]
                        if size > piece:
                            yield told(held)
                            held, size = [], 0
                    if any(rest):
                        held.append((values, b"".join(rest)))
                        size += len(held[-1][1])
            yield told(held)

    kinds = DataType.fromDDL(schema)
    inner = StructType([f for f in kinds if f.name not in (task, stream)])
    found = files.select("values", "path").repartition(tasks).mapInArrow(texts, "values string, text string")
    found = found.select(F.from_json("values", "array<string>").alias("__by"), F.explode(F.split("text", "\n")).alias("__line")).where("__line <> ''")
    named = {name: F.nullif(F.get("__by", F.lit(i)), F.lit("")) for i, name in enumerate((task, stream))}
    row = F.from_json("__line", inner)
    return found.select(*[named[f.name].cast(f.dataType).alias(f.name) if f.name in named else row[f.name].alias(f.name) for f in kinds])


def write_dataset(df: DataFrame, path: str, split: str = "split") -> DataFrame:
    """The training set as JSON lines by split; returns its manifest (split, examples, tokens)."""
    df.write.mode("overwrite").partitionBy(split).json(path)
    size = F.sum(F.length(F.to_json(F.struct(*[c for c in df.columns if c != split]))))
    return df.groupBy(split).agg(F.count(F.lit(1)).alias("examples"), F.floor(size / 4).alias("tokens"))


def write_jsonl(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").json(path)


def delete_where(df: DataFrame, doomed: DataFrame, keys: list[str]) -> DataFrame:
    """df without the rows whose keys are doomed; applied to child tables in turn, it is a cascade."""
    gone = doomed.select([F.col(k).alias(f"__{k}") for k in keys]).distinct()
    return df.join(gone, [F.col(k).eqNullSafe(F.col(f"__{k}")) for k in keys], "left_anti")


def write_table(df: DataFrame, url: str, table: str, mode: str = "append", **options: str) -> None:
    """By JDBC, or as a Parquet folder where url is a path."""
    if url.startswith("jdbc:"):
        df.write.format("jdbc").mode(mode).options(url=url, dbtable=table, **options).save()
    else:
        df.write.mode(mode).parquet(f"{url}/{table}")
