"""Tables kept as partitioned Parquet below one root folder."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping, Sequence
from datetime import date
from fnmatch import fnmatch

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ledgerwell.schemas import TABLES


def as_date(value: str | date) -> date:
    return value if isinstance(value, date) else date.fromisoformat(value)


def in_days(column: str, start: str | date, end: str | date) -> Column:
    """Inclusive day window; on a partition column it prunes whole partitions."""
    return F.col(column).between(F.lit(as_date(start)), F.lit(as_date(end)))


class Lake:
    """Reads and writes the tables of ``schemas.TABLES`` by name, such as ``silver/transactions_clean``."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def ensure(self, name: str) -> None:
        """Create the table empty if it does not exist; an existing table is left alone."""
        self._conformed(name, self.spark.createDataFrame([], TABLES[name].schema)).write.mode("ignore").parquet(
            self.path(name)
        )

    def publish(self, name: str, database: str) -> str:
        """Register the table in the session catalog, with explicit column types, for SQL users."""
        self.ensure(name)
        table = TABLES[name]
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in table.schema.fields)
        layout = f"PARTITIONED BY ({', '.join(table.partitioned_by)})" if table.partitioned_by else ""
        published = f"{database}.{name.split('/')[-1]}"
        self.spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
        self.spark.sql(
            f"CREATE TABLE IF NOT EXISTS {published} ({columns}) USING parquet {layout} LOCATION '{self.path(name)}'"
        )
        if table.partitioned_by:
            self.spark.catalog.recoverPartitions(published)
        self.spark.catalog.refreshTable(published)
        return published

    def read(self, name: str) -> DataFrame:
        """The stored table; one that was never written is an error (PATH_NOT_FOUND), and nothing is created."""
        names = TABLES[name].schema.names
        return self.spark.read.schema(TABLES[name].schema).parquet(self.path(name)).select(*names)

    def replace(self, name: str, df: DataFrame) -> int:
        """Replace the whole table by ``df``; returns the number of rows written."""
        counted, seen = self._counted(self._clustered(name, self._conformed(name, df)))
        self._writer(name, counted).option("partitionOverwriteMode", "static").mode("overwrite").parquet(
            self.path(name)
        )
        return seen.get["rows"]

    def replace_untyped(self, name: str, df: DataFrame) -> int:
        """Like ``replace`` for a table whose schema is that of ``df``."""
        counted, seen = self._counted(df)
        counted.write.mode("overwrite").parquet(self.path(name))
        return seen.get["rows"]

    def append(self, name: str, df: DataFrame) -> None:
        self._writer(name, self._conformed(name, df)).mode("append").parquet(self.path(name))

    def overwrite_partitions(self, name: str, df: DataFrame) -> int:
        """Replace exactly the partitions that occur in ``df``; an empty ``df`` replaces nothing.

        The rows are written where they are: right for input files that each fill one partition.
        """
        counted, seen = self._counted(self._conformed(name, df))
        self._overwrite_present(name, counted)
        return seen.get["rows"]

    def overwrite_partition(self, name: str, df: DataFrame, keys: Mapping[str, str]) -> int:
        """Replace the one partition ``keys``, also when ``df`` has no rows."""
        counted, seen = self._counted(self._conformed(name, df).drop(*keys))
        counted.write.mode("overwrite").parquet(self._partition_path(name, keys))
        return seen.get["rows"]

    def overwrite_days(self, name: str, df: DataFrame, start: str | date, end: str | date) -> int:
        """Replace all days ``start..end`` of a table partitioned by one date column.

        Days of the window without rows in ``df`` end up empty, however long the window is: a day that
        still holds a file from before was not written now, and its partition is removed. Only file
        names are listed; no rows are read for it.
        """
        day_column = TABLES[name].partitioned_by[0]
        start, end = as_date(start), as_date(end)

        def inside() -> list[str]:
            return [v for v in self.partition_values(name) if start.isoformat() <= v <= end.isoformat()]

        return self._overwrite_only(name, df.where(in_days(day_column, start, end)), inside)

    def overwrite_values(self, name: str, df: DataFrame, values: Iterable) -> int:
        """Replace exactly the partitions ``values`` of a table partitioned by one column, wherever they
        lie; those without rows in ``df`` end up empty, and no other partition is looked at.

        Rows of a single value are written where they are: there is nothing to bring together, and a
        partition column that is a constant asks for no sort either.
        """
        values = list(values)
        column = TABLES[name].partitioned_by[0]
        rows, alone = df.where(F.col(column).isin(values)), len(set(values)) == 1
        if alone:
            rows = rows.withColumn(column, F.lit(values[0]))
        return self._overwrite_only(name, rows, lambda: [str(v) for v in values], clustered=not alone)

    def _overwrite_only(self, name: str, df: DataFrame, concerned: Callable[[], list[str]], clustered: bool = True) -> int:
        column = TABLES[name].partitioned_by[0]
        before = self.files_of(name, concerned())
        rows = self._conformed(name, df)
        counted, seen = self._counted(self._clustered(name, rows) if clustered else rows)
        self._overwrite_present(name, counted)
        after = self.files_of(name, before)
        stale = sorted(value for value in before if before[value] & after[value])
        self._remove([self._partition_path(name, {column: value}) for value in stale])
        return seen.get["rows"]

    def overwrite_cells(self, name: str, df: DataFrame, cells: Sequence[Mapping[str, str]]) -> int:
        """Replace exactly the partitions ``cells``, each a value per partition column; those without rows
        in ``df`` end up empty. ``df`` has rows of these alone, and is written where it is."""
        paths = [self._partition_path(name, keys) for keys in cells]
        before = {path: set(self._children(path)) for path in paths}
        counted, seen = self._counted(self._conformed(name, df))
        self._overwrite_present(name, counted)
        self._remove([path for path in paths if before[path] & set(self._children(path))])
        return seen.get["rows"]

    def holds(self, name: str, keys: Mapping[str, str]) -> bool:
        """Whether the partition ``keys`` has been written; its files are not read."""
        return bool(self._children(self._partition_path(name, keys)))

    def sizes(self, folder: str, glob: str) -> dict[str, int]:
        """Names and bytes of the files directly in a folder that fit ``glob``; none if there is no folder."""
        return {f.getPath().getName(): f.getLen() for f in self._status(folder) if f.isFile() and fnmatch(f.getPath().getName(), glob)}

    def partition_values(self, name: str) -> list[str]:
        """The values of the one partition column that have a folder; their files are not listed."""
        mark = f"{TABLES[name].partitioned_by[0]}="
        return sorted(f.removeprefix(mark) for f in self._children(self.path(name)) if f.startswith(mark))

    def files_of(self, name: str, values: Iterable[str]) -> dict[str, set[str]]:
        """The stored files of single partitions, by value of the one partition column; data is not read."""
        column = TABLES[name].partitioned_by[0]
        return {value: set(self._children(self._partition_path(name, {column: value}))) for value in values}

    def _children(self, path: str) -> list[str]:
        return [f.getPath().getName() for f in self._status(path)]

    def _status(self, path: str) -> list:
        folder = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        system = folder.getFileSystem(self.spark._jsparkSession.sessionState().newHadoopConf())
        return list(system.listStatus(folder)) if system.exists(folder) else []

    def _remove(self, paths: list[str]) -> None:
        """Remove partition folders; a matter of the file system, without a Spark job."""
        for path in paths:
            folder = self.spark._jvm.org.apache.hadoop.fs.Path(path)
            folder.getFileSystem(self.spark._jsparkSession.sessionState().newHadoopConf()).delete(folder, True)

    def _overwrite_present(self, name: str, df: DataFrame) -> None:
        self._writer(name, df).option("partitionOverwriteMode", "dynamic").mode("overwrite").parquet(self.path(name))

    def _partition_path(self, name: str, keys: Mapping[str, str]) -> str:
        assert tuple(keys) == TABLES[name].partitioned_by
        return "/".join([self.path(name), *(f"{key}={value}" for key, value in keys.items())])

    def _conformed(self, name: str, df: DataFrame) -> DataFrame:
        """The declared columns in the declared order and types."""
        table = TABLES[name]
        return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in table.schema.fields])

    def _clustered(self, name: str, df: DataFrame) -> DataFrame:
        """Bring the rows of a partition together, so that not every task writes to every one.

        Spark sizes the tasks by the data at run time: a large partition is split, small ones share.
        """
        partitions = TABLES[name].partitioned_by
        return df.hint("rebalance", *[F.col(key) for key in partitions]) if partitions else df

    def _writer(self, name: str, df: DataFrame):
        partitions = TABLES[name].partitioned_by
        return df.write.partitionBy(*partitions) if partitions else df.write

    @staticmethod
    def _counted(df: DataFrame) -> tuple[DataFrame, Observation]:
        """Count rows while they are written instead of by a job of its own."""
        seen = Observation()
        return df.observe(seen, F.count(F.lit(1)).alias("rows")), seen


def write_json_lines(df: DataFrame, path: str) -> None:
    """One JSON object per row, written in parallel; NULLs kept, decimals and times as text."""

    def rendered(name: str, sql_type: str) -> Column:
        value = F.col(name)
        if sql_type.startswith("decimal"):
            return value.cast("string").alias(name)
        if sql_type == "timestamp":
            return F.date_format(value, "yyyy-MM-dd HH:mm:ss").alias(name)
        return value

    line = F.to_json(F.struct(*[rendered(n, t) for n, t in df.dtypes]), {"ignoreNullFields": "false"})
    df.select(line.alias("value")).write.mode("overwrite").text(path)
