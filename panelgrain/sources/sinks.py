"""Writes (SNK-*): snapshots, dynamic partition overwrite, upsert and sync on parquet.

Nothing here reads and overwrites the same path in one plan: rows that stay are first written to the
shared folder (see `session.scratch_path`), then moved in by dynamic partition overwrite. A lost
executor only repeats its tasks.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterable, Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelgrain.operators.conform import conform
from panelgrain.session import scratch_path


def snapshot(df: DataFrame, base: str, run_id: int, name: str) -> str:
    """Step output of a run, replaced as a whole."""
    path = f"{base}/{run_id}/{name}"
    df.write.mode("overwrite").option("compression", "snappy").parquet(path)
    return path


def write_partitions(df: DataFrame, path: str, partition_by: Sequence[str], mode: str = "overwrite") -> None:
    """Partitioned write; overwrite replaces only the partitions present in the frame.

    Rows are rebalanced by the partition columns first, so a table partition gets few files of a
    sensible size instead of one per task; adaptive execution splits a partition that is too large
    for one task, so a contract with a third of the rows is still written by many.
    """
    writer = df.hint("rebalance", *partition_by).write.mode(mode).option("compression", "snappy").partitionBy(*partition_by)
    if mode == "overwrite":
        writer = writer.option("partitionOverwriteMode", "dynamic")
    writer.parquet(path)


def write_any(df: DataFrame, kind: str, path: str, mode: str = "overwrite", partition_by: Sequence[str] = (), **options) -> None:
    writer = df.write.format(kind).mode(mode).options(**options)
    (writer.partitionBy(*partition_by) if partition_by else writer).save(path)


def staged(df: DataFrame, label: str) -> DataFrame:
    """The frame written to the shared folder and read back: cut lineage that survives lost executors."""
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def _staging(spark: SparkSession) -> Iterator[Callable[[DataFrame, str], DataFrame]]:
    """Staged frames that are only needed inside the block; their folders go when it succeeds.

    After a failure they stay, so nothing that was already moved out of the table is lost.
    """
    folder = scratch_path(spark, "stage")

    def stage(df: DataFrame, label: str) -> DataFrame:
        path = f"{folder}/{label}"
        df.write.mode("overwrite").parquet(path)
        return spark.read.schema(df.schema).parquet(path)

    yield stage
    _remove_folders(spark, [folder])


def upserted(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Target rows without a match in source, plus all of source. Source keys must be unique."""
    kept = target.join(source.select(*keys), list(keys), "left_anti")
    return kept.unionByName(conform(source, target.schema))


def _no_repeats(df: DataFrame, keys: Sequence[str]) -> None:
    repeated = df.groupBy(*keys).agg(F.count("*").alias("n")).where("n > 1").limit(3).collect()
    if repeated:
        raise ValueError(f"source keys occur more than once: {[tuple(r)[:-1] for r in repeated]}")


UNFINISHED = "_upsert"
RANGED = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.StringType, T.DateType, T.DecimalType)


def upsert(spark: SparkSession, source: DataFrame, path: str, keys: Sequence[str], partition_by: Sequence[str] = ()) -> DataFrame:
    """Update matched rows, insert the others, rewriting only the files that hold a match.

    Keys are first matched to the files they lie in, reading key columns only, between the smallest and the largest
    key of the source. What stays of those files and all of source is written to the table's `_upsert` folder, which
    readers do not see, with a list of the files that go; `finish_upsert` then moves the new files in and removes the old. Every
    other file of a partition keeps its bytes. Returns a row per file that went: its partition, name, rows and matched rows.

    Keys include the partition columns. A key with a null matches nothing and is inserted, as in `upserted`. While files
    are moved, readers see rewritten rows twice, never too few. A run that broke off is finished, or undone if it had
    not begun to move files, by the next upsert. One upsert at a time may write a table.
    """
    missing = [p for p in partition_by if p not in keys]
    if missing:
        raise ValueError(f"keys must include the partition columns {missing}")
    finish_upsert(spark, path)
    target, by, work = spark.read.parquet(path), list(partition_by), f"{path.rstrip('/')}/{UNFINISHED}"
    with _staging(spark) as stage:
        incoming = stage(conform(source, target.schema), "in")
        _no_repeats(incoming, keys)
        wanted = incoming.select(*keys)
        near = target.select(*keys, _plain("_metadata.file_path").alias("_file")).where(_within(wanted, keys))
        hit = stage(near.join(wanted, list(keys), "left_semi").groupBy("_file").agg(F.count("*").alias("matched")), "hit")
        named = [r[0] for r in hit.select("_file").toLocalIterator()]
        whole = spark.read.schema(target.schema).option("basePath", path).parquet(*named) if named else target.limit(0)
        counted = whole.select(*by, _plain("_metadata.file_path").alias("_file")) if named else whole.select(*by, F.lit("").alias("_file"))
        sizes = counted.groupBy(*by, "_file").agg(F.count("*").alias("rows"))
        report = staged(sizes.join(hit, "_file").select(*by, F.col("_file").alias("file"), "rows", "matched"), "rewritten")
        write_partitions(upserted(whole, incoming, keys), f"{work}/fresh", by, mode="append")
        hit.select("_file").write.parquet(f"{work}/listing")
        _move(spark, f"{work}/listing", f"{work}/goes")
        finish_upsert(spark, path)
    return report


def finish_upsert(spark: SparkSession, path: str) -> None:
    """Carry out what an upsert has written down, or drop what one left that never came to its list.

    Each step can be repeated: new files keep their names when moved, and old ones are removed by name. The
    driver handles one name at a time, as many as there are files rewritten.
    """
    work = f"{path.rstrip('/')}/{UNFINISHED}"
    files, folder = _file_system(spark, work)
    if not files.exists(folder):
        return
    goes = _file_system(spark, f"{work}/goes")[1]
    if files.exists(goes):
        _, fresh = _file_system(spark, f"{work}/fresh")
        base, found = fresh.toUri().getPath(), files.listFiles(fresh, True)
        while found.hasNext():
            name = found.next().getPath().toUri().getPath()[len(base) :]
            if name.endswith(".parquet") and "/_" not in name:
                _move(spark, f"{work}/fresh{name}", f"{path.rstrip('/')}{name}")
        _remove_folders(spark, (r[0] for r in spark.read.schema("_file string").parquet(f"{work}/goes").toLocalIterator()))
    _remove_folders(spark, [work])


def _within(rows: DataFrame, columns: Sequence[str]) -> Column:
    """True where each column lies in the range it has in `rows`, so that scans skip files; one row of ends is collected.

    Only for types whose values a round trip to the driver cannot change.
    """
    ranged = [c for c in columns if isinstance(rows.schema[c].dataType, RANGED)]
    inside = F.lit(True)
    if ranged:
        ends = rows.agg(*[F.struct(F.min(c), F.max(c)).alias(f"_{i}") for i, c in enumerate(ranged)]).first()
        for c, (low, high) in zip(ranged, ends, strict=True):
            kind = rows.schema[c].dataType
            inside = inside & F.col(c).between(F.lit(low).cast(kind), F.lit(high).cast(kind))
    return inside


def change_set(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Key and change letter: I (only in source), U (differs), D (only in target); equal rows are left out.

    Non-key columns are compared null-safe through one struct.
    """
    rest = [c for c in target.columns if c not in keys]
    old = target.select(*keys, F.struct(F.lit(1).alias("present"), *rest).alias("_old"))
    new = conform(source, target.schema).select(*keys, F.struct(F.lit(1).alias("present"), *rest).alias("_new"))
    letter = F.when(F.col("_old").isNull(), "I").when(F.col("_new").isNull(), "D").otherwise("U")
    both = old.join(new, list(keys), "full")
    return both.where(~F.col("_old").eqNullSafe(F.col("_new"))).select(*keys, letter.alias("change"))


def digests(df: DataFrame, by: Sequence[str]) -> DataFrame:
    """One row a partition with a digest of its rows in any order: their number and two sums of 64-bit hashes.

    Which cells are null is hashed too, as a hash skips nulls. Sums are combined before the shuffle.
    """
    cells = [c for c in df.columns if c not in by]
    nulls = F.concat(F.lit(""), *[F.isnull(c).cast("int").cast("string") for c in cells])
    sums = [F.sum(F.xxhash64(F.lit(seed), nulls, *cells).cast("decimal(38,0)")).alias(f"sum{seed}") for seed in (1, 2)]
    return df.groupBy(*by).agg(F.struct(F.count("*").alias("rows"), *sums).alias("digest"))


def differing_partitions(target: DataFrame, source: DataFrame, by: Sequence[str]) -> DataFrame:
    """The partition values whose rows differ between two frames, with `gone` where source has none of them."""
    old = digests(target, by).select(*[F.col(c).alias(f"_{c}") for c in by], F.col("digest").alias("_old"))
    same = F.lit(True)
    for c in by:
        same = same & F.col(c).eqNullSafe(F.col(f"_{c}"))
    both = digests(source, by).join(old, same, "full").where(~F.col("digest").eqNullSafe(F.col("_old")))
    there = F.col("digest").isNotNull()
    return both.select(*[F.when(there, F.col(c)).otherwise(F.col(f"_{c}")).alias(c) for c in by], (~there).alias("gone"))


def _of_partitions(df: DataFrame, listed: DataFrame, by: Sequence[str]) -> DataFrame:
    """Rows whose partition is listed; nulls are values like others."""
    names = listed.select(*[F.col(c).alias(f"_{c}") for c in by])
    same = F.lit(True)
    for c in by:
        same = same & F.col(c).eqNullSafe(F.col(f"_{c}"))
    return df.join(names, same, "left_semi")


def sync(spark: SparkSession, source: DataFrame, path: str, keys: Sequence[str]) -> DataFrame:
    """Make the table equal to source (upsert plus delete of absent rows); returns what changed.

    Partitions are told apart by digests of their rows (`digests`: 128 bits and the number of rows); only those that
    differ are compared key by key and replaced by dynamic overwrite, those that source no longer has are removed last.
    There is no moment without a table, and a run that failed can be repeated. A table without partition
    columns is left alone if its digest is equal; else the new state is written beside it and takes its
    place by two renames.
    """
    target = spark.read.parquet(path)
    layout = partition_columns(spark, path)
    with _staging(spark) as stage:
        incoming = stage(conform(source, target.schema), "in")
        if layout:
            differing = stage(differing_partitions(target, incoming, layout), "differing")
            old, new = (_of_partitions(df, differing, layout) for df in (target, incoming))
            changes = staged(change_set(old, new, keys), "changes")
            gone = _of_partitions(target.select("*", "_metadata"), differing.where("gone"), layout)
            folders = stage(gone.select(_folder()).distinct(), "folders")
            write_partitions(new, path, layout)
            _remove_folders(spark, _listed(folders))
            return changes
        changes = staged(change_set(target, incoming, keys), "changes")
        if differing_partitions(target.withColumn("_all", F.lit(1)), incoming.withColumn("_all", F.lit(1)), ["_all"]).isEmpty():
            return changes
        fresh = f"{path.rstrip('/')}.new-{uuid.uuid4().hex}"
        incoming.write.parquet(fresh)
        _replace(spark, path.rstrip("/"), fresh)
    return changes


def _file_system(spark: SparkSession, path: str):
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()), where


def exists(spark: SparkSession, path: str) -> bool:
    files, where = _file_system(spark, path)
    return files.exists(where)


def partition_columns(spark: SparkSession, path: str) -> list[str]:
    """The partition columns of a stored table, read off its folders' names from the top down."""
    files, folder = _file_system(spark, path)
    found = []
    while folder is not None:
        inner = [s.getPath() for s in files.listStatus(folder) if s.isDirectory() and "=" in s.getPath().getName()]
        folder = inner[0] if inner else None
        if folder is not None:
            found.append(spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.unescapePathName(folder.getName().split("=")[0]))
    return found


def _move(spark: SparkSession, source: str, to: str) -> None:
    """Rename a file or folder, making the folder it goes to."""
    files, now = _file_system(spark, source)
    _, then = _file_system(spark, to)
    files.mkdirs(then.getParent())
    if not files.rename(now, then):
        raise OSError(f"could not move {source} to {to}")


def _replace(spark: SparkSession, path: str, fresh: str) -> None:
    _move(spark, path, f"{fresh}-old")
    _move(spark, fresh, path)
    _remove_folders(spark, [f"{fresh}-old"])


def _plain(name: str) -> Column:
    """A path column as a plain path: Spark shows paths URL-encoded; a plus sign is no blank there."""
    return F.url_decode(F.regexp_replace(F.col(name), r"\+", "%2B"))


def _folder(file: str = "_metadata.file_path") -> Column:
    """The folder a row lies in."""
    return F.regexp_replace(_plain(file), "/[^/]*$", "").alias("folder")


def _remove_folders(spark: SparkSession, folders: Iterable[str]) -> None:
    """Delete the folders; one that is there and cannot be deleted is an error."""
    for folder in folders:
        files, where = _file_system(spark, folder)
        if not files.delete(where, True) and files.exists(where):
            raise OSError(f"could not delete {folder}")


def _listed(folders: DataFrame) -> Iterable[str]:
    """Folder names one by one, a task's worth in memory at a time; they are metadata, one per partition."""
    return (r.folder for r in folders.toLocalIterator())


def drop_partitions(spark: SparkSession, path: str, condition: Column, partition_by: Sequence[str]) -> DataFrame:
    """Remove whole partitions that satisfy a condition on partition columns; returns what was removed.

    The condition prunes the scan and no data column is read. Other partitions keep their files.
    """
    doomed = spark.read.parquet(path).where(condition)
    return _drop(spark, doomed, partition_by)


def _drop(spark: SparkSession, doomed: DataFrame, partition_by: Sequence[str]) -> DataFrame:
    """Delete the folders of the given rows of a table; one scan, without data columns, counts them and names the folders."""
    return _drop_counted(spark, _counted(doomed, partition_by), partition_by)


def _counted(rows: DataFrame, partition_by: Sequence[str]) -> DataFrame:
    """One row per partition and folder with its number of rows. Files are counted first, in each task of the scan, and their folders named once a file."""
    files = rows.select(*partition_by, F.col("_metadata.file_path").alias("_file")).groupBy(*partition_by, "_file").agg(F.count("*").alias("rows"))
    return files.select(*partition_by, _folder("_file"), "rows").groupBy(*partition_by, "folder").agg(F.sum("rows").alias("rows"))


def _drop_counted(spark: SparkSession, folders: DataFrame, partition_by: Sequence[str]) -> DataFrame:
    removed = staged(folders, "dropped")
    _remove_folders(spark, _listed(removed))
    return removed.groupBy(*partition_by).agg(F.sum("rows").alias("rows"))


def drop_before(spark: SparkSession, path: str, limits: DataFrame, on: Sequence[str], column: str, limit: str, partition_by: Sequence[str]) -> DataFrame:
    """Remove the partitions whose `column` lies before the `limit` of their `on` columns; returns what was removed.

    `limits` has a row per `on` values, such as a contract; all of them are handled by one join on partition values.
    Rows are counted by partition before the join, so a contract with many of them is not sorted in one task.
    """
    bounds = limits.select(*[F.col(c).alias(f"_{c}") for c in on], F.col(limit).alias("_limit"))
    folders = _counted(spark.read.parquet(path), partition_by)
    same = [F.col(c) == F.col(f"_{c}") for c in on]
    return _drop_counted(spark, folders.join(bounds, [*same, F.col(column) < F.col("_limit")], "left_semi"), partition_by)


def delete_rows(spark: SparkSession, path: str, listed: DataFrame, keys: Sequence[str], partition_by: Sequence[str]) -> None:
    """Remove rows whose key is listed; only partitions that hold such rows are touched.

    What stays of a touched partition replaces it; a partition left without rows is removed.
    """
    target = spark.read.parquet(path)
    by = list(partition_by)
    with _staging(spark) as stage:
        wanted = stage(listed.select(*keys).distinct(), "keys")
        hit = stage(target.join(wanted, list(keys), "left_semi").select(*by).distinct(), "hit")
        stays = stage(target.join(hit, by, "left_semi").join(wanted, list(keys), "left_anti"), "stays")
        emptied = hit.join(stays.select(*by).distinct(), by, "left_anti")
        folders = stage(target.select("*", "_metadata").join(emptied, by, "left_semi").select(_folder()).distinct(), "folders")
        write_partitions(stays, path, by)
        _remove_folders(spark, _listed(folders))


def replace_run(spark: SparkSession, df: DataFrame, path: str, keys: Sequence[str], partition_by: Sequence[str]) -> None:
    """Delete the rows of (run, contract, source), then append the new ones: safe to repeat."""
    with _staging(spark) as stage:
        incoming = stage(df, "in")
        delete_rows(spark, path, incoming, keys, partition_by)
        write_partitions(incoming, path, partition_by, mode="append")


def jdbc_write(df: DataFrame, url: str, table: str, mode: str = "append", connections: int = 8, **properties: str) -> None:
    """Append, or truncate and refill, with a bounded number of connections."""
    options = {"url": url, "dbtable": table, "numPartitions": str(connections), **properties}
    if mode == "overwrite":
        options["truncate"] = "true"
    df.write.format("jdbc").mode(mode).options(**options).save()


def refresh(spark: SparkSession, jobs: Sequence[dict], read) -> list[str]:
    """Config-driven refresh: per active row, overwrite the target or sync it by key.

    `read(name)` gives the source frame. Rows are table names, so the loop is over configuration.
    """
    done = []
    for job in jobs:
        if not job.get("active", True):
            continue
        source = read(job["source"])
        if job["mode"] == "merge":
            sync(spark, source, job["target"], job["keys"])
        elif job.get("partition_by"):
            write_partitions(source, job["target"], job["partition_by"])
        else:
            source.write.mode("overwrite").parquet(job["target"])
        done.append(job["target"])
    return done


def for_lookup_store(df: DataFrame, target: T.StructType, drop: Sequence[str] = ("part_source_id", "part_contract_id", "security_key")) -> DataFrame:
    """Lake table shaped for the lookup store: partition and security columns gone, target layout."""
    return conform(df.drop(*drop), target)
