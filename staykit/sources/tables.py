"""Reading and writing tables, delimited files and variable lists."""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from datetime import date
from threading import Lock
import uuid

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from staykit.functions.timeparts import as_date


def read_table(spark: SparkSession, name: str) -> DataFrame:
    """A catalog table, or a Parquet path when the name holds a slash. A path whose rebuild was cut short between its two
    renames is put back first."""
    if "/" not in name:
        return spark.table(name)
    recover_path(spark, name)
    return spark.read.parquet(name)


def on_date(table: DataFrame, column: str, day: date | str) -> DataFrame:
    """Rows of one day; prunes partitions when the table is partitioned by the column."""
    return table.where(F.col(column) == as_date(day))


def since_date(table: DataFrame, column: str, day: date | str) -> DataFrame:
    """Rows from a day on."""
    return table.where(F.col(column) >= as_date(day))


_ASIDE, _OLD = ".new-", ".old-"


def _file_system(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def _rename(spark: SparkSession, old: str, new: str) -> None:
    fs, place = _file_system(spark, old)
    if not fs.rename(place, _file_system(spark, new)[1]):
        raise OSError(f"cannot rename {old} to {new}")


def remove_path(spark: SparkSession, path: str) -> None:
    """Deletes a folder and what it holds, if it is there."""
    fs, place = _file_system(spark, path)
    fs.delete(place, True)


def _exists(spark: SparkSession, path: str) -> bool:
    fs, place = _file_system(spark, path)
    return fs.exists(place)


def recover_path(spark: SparkSession, path: str) -> None:
    """Puts the older folder back where a rebuild ended between moving it away and moving the new one in."""
    path = path.rstrip("/")
    if _exists(spark, path):
        return
    fs, pattern = _file_system(spark, f"{path}{_OLD}*")
    kept = fs.globStatus(pattern) or []
    if kept:
        newest = max(kept, key=lambda status: status.getModificationTime())
        _rename(spark, newest.getPath().toString(), path)


def rebuild_table(df: DataFrame, name: str, partition_by: str | None = None) -> None:
    """Replaces a catalog table or, for a name with a slash, a Parquet folder.

    The rows are written aside and swapped in by renames once all of them are there, so a job that fails leaves the older
    table as it was, and ``df`` may read the table that it replaces. A rebuild that is cut short between the two renames
    is mended by the next ``read_table`` or ``rebuild_table``.
    """
    spark, mark = df.sparkSession, uuid.uuid4().hex[:12]
    writer = df.write.partitionBy(partition_by) if partition_by else df.write
    if "/" not in name:
        _rebuild_catalog_table(spark, writer, name, mark)
        return
    name = name.rstrip("/")
    aside, old = f"{name}{_ASIDE}{mark}", f"{name}{_OLD}{mark}"
    recover_path(spark, name)
    try:
        writer.parquet(aside)
    except BaseException:
        remove_path(spark, aside)
        raise
    if _exists(spark, name):
        _rename(spark, name, old)
    _rename(spark, aside, name)
    remove_path(spark, old)
    spark.catalog.refreshByPath(name)


def _rebuild_catalog_table(spark: SparkSession, writer, name: str, mark: str) -> None:
    aside, old = f"{name}_new_{mark}", f"{name}_old_{mark}"
    try:
        writer.saveAsTable(aside)
    except BaseException:
        spark.sql(f"DROP TABLE IF EXISTS {aside}")
        raise
    if spark.catalog.tableExists(name):
        spark.sql(f"ALTER TABLE {name} RENAME TO {old}")
    spark.sql(f"ALTER TABLE {aside} RENAME TO {name}")
    spark.sql(f"DROP TABLE IF EXISTS {old}")


def write_by_day(df: DataFrame, path: str, column: str = "activity_date") -> None:
    """A Parquet folder with one partition per day, replacing what is there (``rebuild_table``).

    Rows are gathered by day before they are written, so a day has few files; adaptive execution splits a large day over
    several tasks.
    """
    rebuild_table(df.hint("rebalance", column), path, partition_by=column)


def replace_days(df: DataFrame, path: str, days: list[date | str], column: str = "activity_date") -> None:
    """Replaces the partitions of ``days`` in a folder of ``write_by_day`` by the rows of ``df``; other days stay untouched.

    A row of any other day is an error and leaves everything as it was: partitions are moved in when the job commits. A day
    without rows is emptied. NULL days cannot be replaced.
    """
    spark, wanted = df.sparkSession, sorted({d if isinstance(d, date) else date.fromisoformat(d) for d in days})
    off = F.raise_error(F.concat(F.lit("a row of a day that is not replaced: "), F.coalesce(F.col(column).cast("string"), F.lit("NULL"))))
    inside = F.coalesce(F.col(column).isin(wanted), F.lit(False))
    checked = df.withColumn(column, F.when(inside, F.col(column)).otherwise(off.cast("date")))
    writer = checked.hint("rebalance", column).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy(column).parquet(path)
    stored = {r[0] for r in df.select(column).distinct().collect()}  # no more than ``days``
    for day in wanted:
        if day not in stored:
            remove_path(spark, f"{path.rstrip('/')}/{column}={day.isoformat()}")
    spark.catalog.refreshByPath(path)


def run_sql(spark: SparkSession, text: str, parameters: dict | None = None, **tables: DataFrame) -> DataFrame:
    """A query with ``:name`` parameters and ``{table}`` references."""
    return spark.sql(text, args=parameters or {}, **tables)


def write_tsv(df: DataFrame, path: str) -> None:
    """The table as tab-separated text with a header line per file."""
    df.write.mode("overwrite").option("sep", "\t").option("header", True).csv(path)


def read_tsv(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """Tab-separated text with a header; all columns are text unless a schema is given."""
    reader = spark.read.option("sep", "\t").option("header", True)
    return (reader.schema(schema) if schema else reader).csv(path)


def read_delimited(spark: SparkSession, path: str, names: list[str], sep: str = "|") -> DataFrame:
    """Delimited text with a header whose columns are renamed by position."""
    return spark.read.option("sep", sep).option("header", True).csv(path).toDF(*names)


def write_names(spark: SparkSession, names: list[str], path: str) -> None:
    """One comma-separated line of variable names, replacing what is there."""
    row = spark.createDataFrame([tuple(names)], T.StructType([T.StructField(f"c{i}", T.StringType()) for i in range(len(names))]))
    row.coalesce(1).write.mode("overwrite").csv(path)


def read_names(spark: SparkSession, path: str) -> list[str]:
    """The names written by ``write_names``."""
    return list(spark.read.csv(path).first())


def work_folder(spark: SparkSession) -> str:
    """The shared folder for intermediate tables: the session's ``spark.checkpoint.dir``, the checkpoint folder set on the
    context, or else a folder in the warehouse, which executors and driver share as well. The default warehouse is a folder
    of the driver's machine, so it only serves a session without other executors."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if folder:
        return folder.rstrip("/")
    alone = spark.sparkContext.master.split("[")[0] == "local"
    if not alone and spark.sparkContext.getConf().get("spark.sql.warehouse.dir") is None:
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_work"


class Workspace:
    """A folder of its own below the shared work folder, for the tables that one job writes and reads again.

    Reading back a written table ends the lineage, so a lost executor costs a re-read and not a recomputation. ``drop``
    removes one table, ``clear`` all of them, once nothing that was built on them will be read any more; a ``with`` block
    clears at its end.
    """

    def __init__(self, spark: SparkSession):
        self.spark, self._name = spark, f"staykit-{uuid.uuid4().hex}"
        self.path = f"{work_folder(spark)}/{self._name}"
        self._database, self._made = self._name.replace("-", "_"), False
        self._lock = Lock()

    def new_path(self, name: str = "table") -> str:
        return f"{self.path}/{name}-{uuid.uuid4().hex[:12]}"

    def store(self, df: DataFrame, name: str = "table") -> DataFrame:
        """Writes the rows and reads them back; later readers prune columns and rows."""
        path = self.new_path(name)
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def store_all(self, tables: dict[str, DataFrame]) -> dict[str, DataFrame]:
        """``store`` for several tables side by side."""
        jobs = [lambda df=df, name=name: self.store(df, name) for name, df in tables.items()]
        return dict(zip(tables, together(self.spark, jobs)))

    def store_clustered(self, df: DataFrame, key: str, name: str = "table", buckets: int | None = None) -> DataFrame:
        """Writes the rows bucketed and sorted by ``key`` and reads them back.

        Tables with the same number of buckets (as many as shuffle partitions, unless given) are joined and aggregated by
        the key where they lie, without another shuffle. Each bucket is one file, because the rows are shuffled to their
        buckets before they are written. They are tables of a database of this workspace, whose files are in its folder.
        """
        buckets = buckets or int(self.spark.conf.get("spark.sql.shuffle.partitions"))
        with self._lock:
            if not self._made:
                self.spark.sql(f"CREATE DATABASE {self._database} LOCATION '{self.path}/clustered'")
                self._made = True
        table = f"{self._database}.{name.replace('-', '_')}_{uuid.uuid4().hex[:12]}"
        df.repartition(buckets, key).write.bucketBy(buckets, key).sortBy(key).format("parquet").saveAsTable(table)
        return self.spark.table(table)

    def store_all_clustered(self, tables: dict[str, DataFrame], key: str, buckets: int | None = None) -> dict[str, DataFrame]:
        """``store_clustered`` for several tables side by side."""
        jobs = [lambda df=df, name=name: self.store_clustered(df, key, name, buckets) for name, df in tables.items()]
        return dict(zip(tables, together(self.spark, jobs)))

    def drop(self, *tables: DataFrame) -> None:
        """Removes tables that ``store`` made; a table without rows stays until ``clear``."""
        for folder in {file.rsplit("/", 1)[0] for df in tables for file in df.inputFiles()}:
            if self._name in folder:
                remove_path(self.spark, folder)

    def clear(self) -> None:
        if self._made:
            self.spark.sql(f"DROP DATABASE IF EXISTS {self._database} CASCADE")
            self._made = False
        remove_path(self.spark, self.path)

    def __enter__(self) -> Workspace:
        return self

    def __exit__(self, *_) -> None:
        self.clear()


def together(spark: SparkSession, jobs: list[Callable[[], DataFrame]]) -> list[DataFrame]:
    """Results of jobs that each run Spark actions of their own, submitted side by side: the short stages of one fill the
    executors the others leave idle."""
    with ThreadPoolExecutor(max(1, len(jobs))) as pool:
        return list(pool.map(lambda job: inheritable_thread_target(spark)(job)(), jobs))
