"""Stored tables: keyed Parquet tables that take upserts, logs, rebuilt marts."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from caselight.operators.changes import dedupe_batch, merge, stamp, with_key
from caselight.session import remove

BATCH = "batch"
LEAF, LOAD = "leaf", "load"
#: Rows of a bucket from which it is cut in two when a load rewrites it anyway.
LEAF_ROWS = 1_000_000
_MAP_DDL = "leaf bigint, load bigint, rows bigint"


@dataclass(frozen=True)
class KeyedTable:
    """A Parquet table with unique keys, cut into buckets by a hash of the keys.

    A bucket is named by the last bits of the hash, with a leading 1: bucket 0b1011 holds the keys whose hash ends in 011.
    A load rewrites the buckets that its keys fall into, and cuts those that grew beyond ``leaf_rows`` into buckets with
    longer names. So their number grows with the table, a task writes one bucket of bounded size, and a load writes no more
    than (number of its keys) * ``leaf_rows`` rows plus its own.

    Nothing that was written is overwritten: each load has a folder of its own below ``data``, and the last step of a load is
    one small file below ``map`` that names the folder of every bucket. Readers take the newest map. A load that dies before
    that step leaves the table as it was, and is repeated; a reader keeps the files of the map that it began with until
    ``clean``. One writer at a time. Rows without a key have no place in a keyed table and are left out
    (``quality.quarantine`` sets them aside before). Handing over the same batch twice changes nothing.
    """

    path: str
    keys: tuple[str, ...]
    buckets: int = 32
    leaf_rows: int = LEAF_ROWS

    def _maps(self, spark: SparkSession) -> DataFrame | None:
        try:
            return spark.read.schema(f"{_MAP_DDL}, version bigint").parquet(f"{self.path}/map")
        except AnalysisException as problem:
            if problem.getCondition() == "PATH_NOT_FOUND":
                return None
            raise

    def _current(self, spark: SparkSession) -> tuple[int, dict[int, tuple[int, int]]]:
        """The newest version and its buckets: name to (load, rows). One row per bucket, on the driver."""
        maps = self._maps(spark)
        newest = maps.agg(F.max("version")).first()[0] if maps is not None else None
        if newest is None:
            return 0, {}
        rows = maps.where(F.col("version") == newest).collect()
        return newest, {row[LEAF]: (row[LOAD], row["rows"]) for row in rows}

    def _folders(self, leaves: dict[int, tuple[int, int]]) -> list[str]:
        return [f"{self.path}/data/{LOAD}={load}/{LEAF}={leaf}" for leaf, (load, rows) in sorted(leaves.items()) if rows]

    def _stored(self, spark: SparkSession, leaves: dict[int, tuple[int, int]]) -> DataFrame | None:
        folders = self._folders(leaves)
        if not folders:
            return None
        return spark.read.option("mergeSchema", "true").option("basePath", f"{self.path}/data").parquet(*folders).drop(LOAD)

    def _placed(self, df: DataFrame, leaves: Iterable[int]) -> DataFrame:
        """Add the bucket of each row: the one name, among those as long as any bucket's, that is a bucket."""
        spark = df.sparkSession
        depths = sorted({leaf.bit_length() - 1 for leaf in leaves})
        names = F.array(*[
            F.lit(1 << depth).cast("bigint") + F.pmod(F.xxhash64(*self.keys), F.lit(1 << depth)) for depth in depths])
        if len(depths) == 1:
            return df.withColumn(LEAF, names[0])
        known = spark.createDataFrame([(leaf,) for leaf in leaves], f"{LEAF} bigint")
        return df.withColumn(LEAF, F.explode(names)).join(known, LEAF)

    def _publish(self, spark: SparkSession, version: int, leaves: dict[int, tuple[int, int]]) -> None:
        rows = [(leaf, load, n) for leaf, (load, n) in leaves.items()]
        spark.createDataFrame(rows, _MAP_DDL).coalesce(1).write.mode("overwrite").parquet(f"{self.path}/map/version={version}")

    def _write(self, placed: DataFrame, load: int) -> dict[int, tuple[int, int]]:
        """Write rows that have their bucket, one file each; returns what was written, counted from the file footers."""
        spark, folder = placed.sparkSession, f"{self.path}/data/{LOAD}={load}"
        placed.repartition(LEAF).write.mode("overwrite").partitionBy(LEAF).parquet(folder)
        counts = spark.read.schema(f"{LEAF} bigint").parquet(folder).groupBy(LEAF).count().collect()
        return {row[LEAF]: (load, row["count"]) for row in counts}

    def _cut(self, placed: DataFrame, sizes: dict[int, int]) -> DataFrame:
        """Longer names for the rows of buckets that would be too large."""
        more = [(leaf, (-(-rows // self.leaf_rows) - 1).bit_length()) for leaf, rows in sizes.items() if rows > self.leaf_rows]
        if not more:
            return placed
        bits = placed.sparkSession.createDataFrame(more, f"{LEAF} bigint, more int")
        size = F.expr(f"shiftleft(1L, length(bin({LEAF})) - 1 + more)")
        name = F.when(F.col("more").isNull(), F.col(LEAF)).otherwise(size + F.pmod(F.xxhash64(*self.keys), size))
        return placed.join(bits, LEAF, "left").withColumn(LEAF, name).drop("more")

    def exists(self, spark: SparkSession) -> bool:
        return self._current(spark)[0] > 0

    def write(self, df: DataFrame) -> None:
        """Replace the whole table; the keys of ``df`` must be unique."""
        spark = df.sparkSession
        version, _ = self._current(spark)
        rows = with_key(df, self.keys)
        depth = max(self.buckets.bit_length() - 1, (max(rows.count(), 1) * 2 // self.leaf_rows).bit_length())
        leaves = {leaf: (version + 1, 0) for leaf in range(1 << depth, 2 << depth)}
        found = self._write(self._placed(rows, leaves), version + 1)
        if not found:  # keeps the columns of an empty table
            rows.limit(0).write.mode("overwrite").parquet(f"{self.path}/data/{LOAD}={version + 1}/{LEAF}=0")
        self._publish(spark, version + 1, leaves | found)

    def read(self, spark: SparkSession) -> DataFrame:
        """The current rows."""
        version, leaves = self._current(spark)
        if not version:
            raise FileNotFoundError(f"no table at {self.path}")
        stored = self._stored(spark, leaves)
        if stored is None:
            stored = spark.read.option("mergeSchema", "true").option("recursiveFileLookup", "true").parquet(
                f"{self.path}/data").limit(0)
        return stored.drop(LEAF)

    def places(self, spark: SparkSession) -> dict[int, tuple[int, int]]:
        """The load and the number of rows of each bucket; a bucket of one load never changes."""
        return self._current(spark)[1]

    def stored(self, spark: SparkSession, leaves: dict[int, tuple[int, int]]) -> DataFrame:
        """The rows of some buckets, with the name of their bucket in ``leaf``."""
        return self._stored(spark, leaves)

    def count(self, spark: SparkSession) -> int:
        """The number of rows, from the map alone."""
        return sum(rows for _, rows in self.places(spark).values())

    def lookup(self, wanted: DataFrame) -> DataFrame | None:
        """The rows whose keys occur in ``wanted``; only their buckets are read. None if there is none to read."""
        spark = wanted.sparkSession
        _, leaves = self._current(spark)
        if not leaves:
            return None
        keys = with_key(wanted.select(*self.keys), self.keys)
        touched = [row[LEAF] for row in self._placed(keys, leaves).select(LEAF).distinct().collect()]
        rows = self._stored(spark, {leaf: leaves[leaf] for leaf in touched if leaf in leaves})
        return None if rows is None else rows.drop(LEAF).join(keys.distinct(), list(self.keys), "left_semi")

    def version(self, spark: SparkSession) -> int:
        """The number of the newest load, 0 without one."""
        return self._current(spark)[0]

    def changes(self, spark: SparkSession, since: int) -> tuple[DataFrame | None, DataFrame | None] | None:
        """The rows of the buckets that were replaced since a version, and of those that replaced them.

        Rows that did not change but share a bucket with one that did are in both. Only those buckets are read. None if the
        map of that version is no longer there.
        """
        version, leaves = self._current(spark)
        maps = self._maps(spark)
        old = {} if maps is None else {
            row[LEAF]: (row[LOAD], row["rows"]) for row in maps.where(F.col("version") == since).collect()}
        if not version or not old:
            return None

        def rows(mine: dict[int, tuple[int, int]], other: dict[int, tuple[int, int]]) -> DataFrame | None:
            found = self._stored(spark, {leaf: place for leaf, place in mine.items() if other.get(leaf) != place})
            return None if found is None else found.drop(LEAF)

        return rows(old, leaves), rows(leaves, old)

    def upsert(self, batch: DataFrame, order: Sequence[Column], loaded_at=None) -> None:
        """Insert or replace by key; the first row of a key under ``order`` wins inside the batch.

        Columns that only one side has are kept and null on the other.
        """
        spark = batch.sparkSession
        fresh = dedupe_batch(with_key(batch, self.keys), self.keys, order)
        if loaded_at is not None:
            fresh = stamp(fresh, "loaded_at", loaded_at)
        version, leaves = self._current(spark)
        if not version:
            self.write(fresh)
            return
        # Names only the buckets that the batch falls into; one row per bucket comes back.
        touched = {row[LEAF]: row["count"] for row in self._placed(batch.select(*self.keys), leaves).groupBy(LEAF).count().collect()
                   if row[LEAF] is not None and row[LEAF] in leaves}
        old = {leaf: leaves[leaf] for leaf in touched}
        placed = self._placed(fresh, leaves)
        stored = self._stored(spark, old)
        merged = merge(stored, placed, [*self.keys, LEAF]) if stored is not None else placed
        found = self._write(self._cut(merged, {leaf: old[leaf][1] + n for leaf, n in touched.items()}), version + 1)
        # A cut bucket may leave one half empty: its name has to stay known, or rows that come later have no place.
        self._publish(spark, version + 1, _covering({k: v for k, v in leaves.items() if k not in old}, old, found, version + 1))

    def clean(self, spark: SparkSession, keep: int = 2) -> int:
        """Delete what only maps older than the newest ``keep`` name, and those maps; returns the number of folders."""
        version, _ = self._current(spark)
        if not version:
            return 0
        maps = self._maps(spark)
        old, new = maps.where(F.col("version") <= version - keep), maps.where(F.col("version") > version - keep)
        folders = old.select(LEAF, LOAD).distinct().join(new.select(LEAF, LOAD), [LEAF, LOAD], "left_anti").collect()
        stale = [f"{self.path}/data/{LOAD}={row[LOAD]}/{LEAF}={row[LEAF]}" for row in folders]
        gone = [f"{self.path}/map/version={row['version']}" for row in old.select("version").distinct().collect()]
        return remove(spark, *stale, *gone)


def _covering(
    kept: dict[int, tuple[int, int]], cut: dict[int, tuple[int, int]], found: dict[int, tuple[int, int]], load: int
) -> dict[int, tuple[int, int]]:
    """A map in which every hash has a bucket: the buckets found, and empty ones for the parts of a cut bucket without rows."""
    leaves = kept | found
    parents = set()
    for name in found:
        while name > 1 and name not in parents:
            bits = name.bit_length() - 2
            name = name & ((1 << bits) - 1) | 1 << bits
            parents.add(name)
    todo = list(cut)
    while todo:
        name = todo.pop()
        bits = name.bit_length() - 1
        if name in parents:
            low = name & ((1 << bits) - 1)
            todo += [low | 1 << (bits + 1), low | 3 << bits]
        elif name not in found:
            leaves[name] = (load, 0)
    return leaves


def put(df: DataFrame, path: str, batch: str) -> None:
    """Write the rows of one batch to a log; the same batch written again takes their place."""
    df.write.mode("overwrite").parquet(f"{path}/{BATCH}={batch}")


def append(df: DataFrame, path: str) -> None:
    """Add event rows to an append-only table."""
    df.write.mode("append").parquet(path)


def read_log(spark: SparkSession, path: str, ddl: str, keep_batch: bool = False) -> DataFrame:
    """A log, empty while nothing was written yet; columns added later read as null in old files.

    With ``keep_batch`` the schema names the batch as well.
    """
    try:
        found = spark.read.schema(ddl).parquet(path)
    except AnalysisException as problem:
        if problem.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], ddl)
    return found if keep_batch else found.drop(BATCH)


def rebuild(df: DataFrame, path: str, sort_by: Sequence[str] = ()) -> None:
    """Replace a mart as a whole; rows are sorted inside each file only."""
    (df.sortWithinPartitions(*sort_by) if sort_by else df).write.mode("overwrite").parquet(path)


def snapshot_once(df: DataFrame, path: str) -> DataFrame:
    """Keep a copy of a table unless one exists already, and read the copy."""
    df.write.mode("ignore").parquet(path)
    return df.sparkSession.read.parquet(path)
