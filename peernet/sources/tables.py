"""Result tables as Parquet folders: replace, append, upsert and clustered writes."""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType, TimestampNTZType, TimestampType

# Dates whose files a task may hold open at once; with more of them it sorts its rows.
CONCURRENT_WRITERS = 64


def _hadoop_path(spark: SparkSession, path: str):
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()), hadoop_path


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _hadoop_path(spark, path)
    return fs.exists(p)


def modified(spark: SparkSession, path: str) -> str:
    """Size and time of a file or folder, to notice that it changed."""
    fs, p = _hadoop_path(spark, path)
    status = fs.getFileStatus(p)
    return f"{status.getLen()}@{status.getModificationTime()}"


def delete(spark: SparkSession, path: str) -> None:
    fs, p = _hadoop_path(spark, path)
    fs.delete(p, True)


def rename(spark: SparkSession, source: str, target: str) -> None:
    fs, p = _hadoop_path(spark, source)
    if not fs.rename(p, spark._jvm.org.apache.hadoop.fs.Path(target)):
        raise OSError(f"cannot move {source} to {target}")


def clustered(df: DataFrame, key: str) -> DataFrame:
    """Rows in key order over the files, so the min/max statistics of a file exclude most keys.

    Range bounds come from a sample of (key, row print): a key with very many rows spans several ranges.
    """
    row_print = F.xxhash64(*df.columns)
    return df.repartitionByRange(F.col(key), row_print).sortWithinPartitions(key)


class Tables:
    """Tables under one folder. A replaced table is a new version folder, read once its _SUCCESS marker is there."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def _versions(self, name: str) -> list[str]:
        fs, p = _hadoop_path(self.spark, self.path(name))
        if not fs.exists(p):
            return []
        folders = sorted(s.getPath().toString() for s in fs.listStatus(p) if s.getPath().getName().startswith("v"))
        return [f for f in folders if exists(self.spark, f"{f}/_SUCCESS")]

    def replace(self, df: DataFrame, name: str, cluster_by: str | None = None) -> DataFrame:
        """Write a new version beside the old one, so `df` may read the table itself; then drop older ones."""
        old = self._versions(name)
        number = int(old[-1].rsplit("/v", 1)[1]) + 1 if old else 1
        target = f"{self.path(name)}/v{number:06d}"
        (clustered(df, cluster_by) if cluster_by else df).write.mode("overwrite").parquet(target)
        for folder in old[:-1]:
            delete(self.spark, folder)
        return self.spark.read.parquet(target)

    def read_replaced(self, name: str) -> DataFrame | None:
        found = self._versions(name)
        return self.spark.read.parquet(found[-1]) if found else None

    def read(self, name: str, schema: str | None = None) -> DataFrame | None:
        """An appended or upserted table; None (or an empty frame with `schema`) before its first write."""
        manifest = self._manifest(name)
        if manifest is not None:
            return self._read_dates(name, manifest, sorted(manifest["dates"]))
        if not exists(self.spark, self.path(name)):
            return None if schema is None else self.spark.createDataFrame([], schema)
        return self.spark.read.parquet(self.path(name))

    def read_newest(self, name: str) -> DataFrame | None:
        """The newest date of an upserted table, for a bound on the column that dates it; None before its first write."""
        manifest = self._manifest(name)
        if manifest is None:
            return None
        newest = max((day for day in manifest["dates"] if day != "None"), default=None)
        return self._read_dates(name, manifest, [] if newest is None else [newest])

    def read_holding(self, name: str, rows: DataFrame, keys: list[str]) -> DataFrame | None:
        """The dates of an upserted table that may hold a key of `rows`; None before its first write."""
        manifest = self._manifest(name)
        if manifest is None:
            return None
        return self._read_dates(name, manifest, self._dates_holding(name, manifest, rows, keys))

    def bounds(self, name: str, column: str) -> tuple[str | None, str | None]:
        """Smallest and largest value, as text, of a timestamp column of an upserted table, from its manifest alone.

        (None, None) before its first value. Dates whose manifest holds no bounds, as older ones, are read.
        """
        manifest = self._manifest(name)
        if manifest is None:
            return None, None
        kept = dict(manifest.get("bounds", {}))
        missing = [day for day in manifest["dates"] if day not in kept]
        if missing:
            kept |= self._bounds_of(self._read_dates(name, manifest, missing))
        found = [kept[day][column] for day in manifest["dates"]]
        lows, highs = [lo for lo, _ in found if lo is not None], [hi for _, hi in found if hi is not None]
        return min(lows, default=None), max(highs, default=None)

    def _bounds_of(self, rows: DataFrame) -> dict[str, dict[str, list[str | None]]]:
        """Per date, the bounds of every timestamp column: one row per date."""
        columns = [f.name for f in rows.schema.fields if isinstance(f.dataType, (TimestampType, TimestampNTZType))]
        aggs = [f(c).cast("string") for c in columns for f in (F.min, F.max)]
        return {
            str(day): {c: [values[2 * i], values[2 * i + 1]] for i, c in enumerate(columns)}
            for day, *values in rows.groupBy("_date").agg(*aggs or [F.count(F.lit(1))]).collect()
        }

    def note(self, name: str) -> str | None:
        """What the last upsert of a table left as its note."""
        return (self._manifest(name) or {}).get("note")

    def _read_dates(self, name: str, manifest: dict, days: list[str]) -> DataFrame:
        declared = StructType.fromJson(manifest["schema"])
        if not days:
            return self.spark.createDataFrame([], declared)
        reader = self.spark.read.schema(declared).option("basePath", self.path(name))
        return reader.parquet(*[manifest["dates"][day] for day in days]).select(*declared.names)

    def _dates_holding(self, name: str, manifest: dict, rows: DataFrame, keys: list[str]) -> list[str]:
        """Dates whose key prints meet those of `rows`, and dates without prints. Only the prints are read."""
        declared = StructType.fromJson(manifest["schema"])
        prints = manifest.get("prints", {})
        unknown = [day for day in manifest["dates"] if day not in prints]
        if not prints:
            return unknown
        reader = self.spark.read.schema("_print long, _date date").option("basePath", self.path(name))
        stored = reader.parquet(*prints.values()).select("_print", "_date")
        wanted = rows.select(F.xxhash64(*[F.col(k).cast(declared[k].dataType) for k in keys]).alias("_print"))
        met = stored.join(wanted, "_print", "left_semi").select("_date").distinct().collect()  # a row per touched day
        return [*unknown, *(str(row[0]) for row in met)]

    def append(self, df: DataFrame, name: str, cluster_by: str | None = None) -> None:
        (clustered(df, cluster_by) if cluster_by else df).write.mode("append").parquet(self.path(name))

    def _manifests(self, name: str) -> list[str]:
        fs, p = _hadoop_path(self.spark, f"{self.path(name)}/_manifest")
        return sorted(s.getPath().toString() for s in fs.listStatus(p)) if fs.exists(p) else []

    def _manifest(self, name: str) -> dict | None:
        """Schema, and the folder of every date, as of the last finished upsert."""
        found = [m for m in self._manifests(name) if m.endswith(".json")]
        if not found:
            return None
        fs, p = _hadoop_path(self.spark, found[-1])
        stream = fs.open(p)
        try:
            return json.loads(self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()

    def _publish(self, name: str, number: int, manifest: dict) -> None:
        """One rename makes the new state of the table visible."""
        target = f"{self.path(name)}/_manifest/v{number:06d}"
        fs, p = _hadoop_path(self.spark, f"{target}.tmp")
        stream = fs.create(p, True)
        stream.write(bytearray(json.dumps(manifest).encode()))
        stream.close()
        rename(self.spark, f"{target}.tmp", f"{target}.json")

    def staging(self, name: str) -> str:
        """A folder of its own for rows of one step; the caller deletes it."""
        return f"{self.root}/_staging/{name}-{uuid.uuid4().hex}"

    def upsert(
        self,
        updates: DataFrame,
        name: str,
        keys: list[str],
        date_of: str,
        cluster_by: str | None = None,
        note: str | None = None,
        unfold: Callable[[DataFrame], DataFrame] | None = None,
    ) -> None:
        """Insert or replace rows by key in a table partitioned by the date of one column.

        Only the dates that hold new or replaced rows are written again, beside the old ones, in the order of
        `cluster_by` (the first key by default); then a new manifest, which names the folder of each date, takes their
        place at once. A reader sees the table before or after, and a stop in between changes nothing. The update is
        staged first: it is computed once. Folders that neither the new nor the last manifest names are dropped.

        Where `date_of` is no key, a replaced row may be of any date. So each date keeps the 64-bit prints of its keys,
        sorted and delta-coded, in a folder of their own: the update meets these, and of the rows only those of dates
        that (but for a clash of prints, which changes nothing) hold one of its keys are read. The manifest also holds
        each date's bounds of the timestamp columns, so that watermarks read no rows.

        With `unfold`, the update comes folded: `unfold` makes several rows of each of its rows, all of the folded row's
        date and `cluster_by`, and a column `_date` passes through it. Staging and clustering then move the folded rows
        alone. `date_of` must be one of the keys.
        """
        if unfold is not None and date_of not in keys:
            raise ValueError("folded rows must be dated by a key")
        staging = self.staging(name)
        try:
            self._upsert(updates, name, keys, date_of, cluster_by or keys[0], note, staging, unfold)
        finally:
            delete(self.spark, staging)

    def _upsert(
        self,
        updates: DataFrame,
        name: str,
        keys: list[str],
        date_of: str,
        cluster_by: str,
        note: str | None,
        staging: str,
        unfold: Callable[[DataFrame], DataFrame] | None,
    ) -> None:
        dated = updates.withColumn("_date", F.to_date(date_of))
        dated.write.parquet(staging)
        new = self.spark.read.schema(dated.schema).parquet(staging)
        last = self._manifest(name)
        dates = {str(r[0]) for r in new.select("_date").distinct().collect()}  # one row per touched day
        folders, prints = ({}, {}) if last is None else (dict(last["dates"]), dict(last.get("prints", {})))
        if last is not None and date_of not in keys:  # else a replaced row has the date of the new one
            dates |= set(self._dates_holding(name, last, new, keys))
        old = sorted(dates & folders.keys())
        number = 1 + max([int(m.rsplit("/v", 1)[1].split(".")[0]) for m in self._manifests(name)], default=0)
        version = f"{number:06d}-{uuid.uuid4().hex[:8]}"
        target = f"{self.path(name)}/_v={version}"
        if unfold is None:
            merged = new
            if old:
                current = self._read_dates(name, last, old)
                same = reduce(lambda a, b: a & b, [current[k].eqNullSafe(new[k]) for k in keys])
                merged = current.join(new.select(*keys), same, "left_anti").unionByName(new)
            row_print = F.xxhash64(*merged.columns)
            # Sorted by date first, so that a task writes a file for each of a few dates.
            ordered = merged.repartitionByRange("_date", cluster_by, row_print).sortWithinPartitions("_date", cluster_by)
            written = self._write_dates(ordered, target)
        else:
            merged, written = self._write_unfolded(name, last, new, old, keys, cluster_by, unfold, target)
        folders = {day: folder for day, folder in folders.items() if day not in dates} | written
        prints = {day: folder for day, folder in prints.items() if day not in dates}
        note = note or (last or {}).get("note")
        bounds = {day: b for day, b in (last or {}).get("bounds", {}).items() if day not in dates}
        manifest = {
            "schema": merged.schema.jsonValue(), "dates": folders, "prints": prints, "bounds": bounds, "note": note,
        }
        if written:
            bounds |= self._bounds_of(self._read_dates(name, manifest, sorted(written)))
        if written and date_of not in keys:
            rows = self._read_dates(name, manifest, sorted(written)).select(F.xxhash64(*keys).alias("_print"), "_date")
            rows = rows.repartitionByRange("_date", "_print").sortWithinPartitions("_date", "_print")
            prints |= self._write_dates(
                rows, f"{self.path(name)}/_k={version}", **{"parquet.writer.version": "v2", "parquet.enable.dictionary": "false"}
            )
        self._publish(name, number, manifest)
        self._drop_unused(name, [last or {}, manifest])

    def _write_unfolded(
        self,
        name: str,
        last: dict | None,
        new: DataFrame,
        old: list[str],
        keys: list[str],
        cluster_by: str,
        unfold: Callable[[DataFrame], DataFrame],
        target: str,
    ) -> tuple[DataFrame, dict[str, str]]:
        """Write folded rows: (a frame with the table's schema, the folder of every date written).

        Rows of dates without earlier ones are unfolded as they are written. For the others, all rows of a key meet in one
        range, where a new one drops the earlier ones: one shuffle both merges and clusters.
        """
        merged, known = unfold(new), F.lit(False)
        if old:
            known = F.coalesce(F.col("_date").cast("string"), F.lit("None")).isin(old)
            both = self._read_dates(name, last, old).withColumn("_new", F.lit(False))
            both = both.unionByName(unfold(new.where(known)).withColumn("_new", F.lit(True)))
            order = ["_date", cluster_by, *[k for k in keys if k != cluster_by]]
            newest = F.max("_new").over(Window.partitionBy(*order))
            kept = both.repartitionByRange(*order).withColumn("_newest", newest).where(F.col("_new") == F.col("_newest"))
            merged = kept.drop("_new", "_newest")
            written = self._write_dates(merged.sortWithinPartitions("_date", cluster_by), f"{target}-merged")
        else:
            written = {}
        fresh = new.where(~known)
        fresh = fresh.repartitionByRange("_date", cluster_by, F.xxhash64(*fresh.columns))
        fresh = unfold(fresh.sortWithinPartitions("_date", cluster_by))
        fresh = fresh.select(*[F.col(f.name).cast(f.dataType) for f in merged.schema.fields])
        # The rows come in the order of dates; Spark does not see that after `unfold` and would sort them all again.
        writers = "spark.sql.maxConcurrentOutputFileWriters"
        before = self.spark.conf.get(writers)
        self.spark.conf.set(writers, CONCURRENT_WRITERS)
        try:
            return merged, written | self._write_dates(fresh, target)
        finally:
            self.spark.conf.set(writers, before)

    def _write_dates(self, rows: DataFrame, target: str, **options: str) -> dict[str, str]:
        """Write rows by `_date`; the folder of each date."""
        rows.write.options(**options).partitionBy("_date").parquet(target)
        fs, p = _hadoop_path(self.spark, target)
        found = {}
        for status in fs.listStatus(p):
            folder = status.getPath().getName()
            if folder.startswith("_date="):
                day = folder.removeprefix("_date=")
                found["None" if day == "__HIVE_DEFAULT_PARTITION__" else day] = status.getPath().toString()
        return found

    def _drop_unused(self, name: str, manifests: list[dict]) -> None:
        folders = [f for m in manifests for part in ("dates", "prints") for f in m.get(part, {}).values()]
        used = {f.rsplit("/_date=", 1)[0].rsplit("/", 1)[1] for f in folders}
        fs, p = _hadoop_path(self.spark, self.path(name))
        for status in fs.listStatus(p):
            folder = status.getPath().getName()
            if folder.startswith(("_v=", "_k=")) and folder not in used:
                delete(self.spark, status.getPath().toString())
        for old in self._manifests(name)[:-2]:
            delete(self.spark, old)
