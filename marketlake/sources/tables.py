"""Table files on shared storage.

Five layouts, all plain Parquet:

* batches: every load writes its own ``_batch=<id>`` folder.
* marked batches: a load may also replace slices (a symbol, a fund's year). It writes the new
  content of the slice as part of its batch, and a mark (slice, batch) next to it; readers skip
  rows of a marked slice that are older than the mark. A load costs what it writes, however
  large the table is.
* kept states: every load writes the whole of a small table, such as the last date and close of
  each key, as a batch with the next number; readers take the newest committed one.
* versions: every load writes the whole table to ``_version=<n>``; readers take the newest
  committed one. Used for small tables and snapshots.
* partitions: a load replaces whole partitions of the slice columns. New content is staged
  first, so no path is read and overwritten in one job.

Batches and versions become visible through a row in the commit table, written last. What is
published under one unit id appears together.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from marketlake.operators import reshape

ROWS_PER_FILE = 5_000_000
Check = Callable[[DataFrame], None]


def read_or_create(spark: SparkSession, path: str, schema: StructType, partition: Sequence[str]) -> DataFrame:
    """Files of a partitioned table with its declared schema; the table is created if missing."""
    reshape.typed_empty(spark, schema).write.mode("ignore").partitionBy(*partition).parquet(path)
    return spark.read.schema(schema).parquet(path)


def _text_fields(*names: str) -> list[StructField]:
    return [StructField(n, StringType()) for n in names]


@dataclass(frozen=True)
class Lake:
    """A root folder on storage that all executors share. One writer per table at a time."""

    spark: SparkSession
    root: str

    def commits(self, table: str) -> DataFrame:
        path, schema = f"{self.root}/commits/table={table}", StructType(_text_fields("batch", "unit", "id"))
        return read_or_create(self.spark, path, schema, ["id"]).select("batch", "unit")

    def commit(self, table: str, batch: str, unit: str | None = None) -> None:
        """Make a batch visible: at once, or when its unit is committed."""
        row = self.spark.range(1, numPartitions=1).select(
            F.lit(batch).alias("batch"), F.lit(unit).cast("string").alias("unit")
        )
        row.write.mode("overwrite").parquet(f"{self.root}/commits/table={table}/id={batch}")

    def committed(self, table: str) -> DataFrame:
        commits = self.commits(table)
        units = self.commits("units").select(F.col("batch").alias("unit"))
        whole = commits.join(units, "unit", "left_semi").select("batch")
        return commits.filter("unit IS NULL").select("batch").unionByName(whole).distinct()


@dataclass(frozen=True)
class LakeTable:
    lake: Lake
    name: str
    schema: StructType
    sort: tuple[str, ...] = ()

    @property
    def spark(self) -> SparkSession:
        return self.lake.spark

    @property
    def path(self) -> str:
        return f"{self.lake.root}/data/{self.name}"

    def stage(self, df: DataFrame, label: str) -> DataFrame:
        """Write to the staging area and read back: later steps start from files, not lineage."""
        path = f"{self.lake.root}/staging/{self.name}/{label}"
        df.write.mode("overwrite").parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def _write(self, df: DataFrame, folder: str) -> None:
        """Files of even size, sorted so that row groups can be skipped by their bounds."""
        out = df.select(*self.schema.fieldNames()).hint("rebalance", *[F.col(c) for c in self.sort[:1]])
        if self.sort:
            out = out.sortWithinPartitions(*self.sort)
        out.write.mode("overwrite").option("maxRecordsPerFile", ROWS_PER_FILE).parquet(f"{self.path}/{folder}")

    # --- batches ---

    def _batch_rows(self, exclude: str | None = None) -> DataFrame:
        """Committed rows with their batch; the batch folders are pruned by the join at run time."""
        schema = StructType([*self.schema.fields, *_text_fields("_batch")])
        rows = read_or_create(self.spark, self.path, schema, ["_batch"])
        done = self.lake.committed(self.name).select(F.col("batch").alias("_batch"))
        if exclude is not None:
            rows, done = rows.filter(F.col("_batch") != exclude), done.filter(F.col("_batch") != exclude)
        return rows.join(done, "_batch", "left_semi")

    def read_batches(self, exclude: str | None = None) -> DataFrame:
        """Committed rows; ``exclude`` leaves out the batch that is being written again."""
        return self._batch_rows(exclude).select(*self.schema.fieldNames())

    def write_batch(self, df: DataFrame, batch: str, unit: str | None = None) -> None:
        """Writing the same batch again replaces it."""
        self._write(df, f"_batch={batch}")
        self.lake.commit(self.name, batch, unit)

    def is_committed(self, attempt: str) -> bool:
        """Whether a batch of this attempt is visible."""
        return not self.lake.committed(self.name).filter(F.col("batch").endswith(attempt)).isEmpty()

    def next_batch(self, attempt: str) -> str:
        """Id of the next batch in a growing sequence, whatever the clock says. One writer at a time."""
        number = F.regexp_extract("batch", "^([0-9]+)-", 1).try_cast("bigint")
        last = self.lake.commits(self.name).agg(F.max(number)).first()[0] or 0
        return f"{last + 1:016d}-{attempt}"

    def read_batch(self, batch: str) -> DataFrame:
        """Rows of one batch, committed or not: what a load has just written."""
        return self.spark.read.schema(self.schema).parquet(f"{self.path}/_batch={batch}")

    def read_newest(self) -> DataFrame | None:
        """Rows of the committed batch with the highest number (see :meth:`next_batch`), None without one."""
        newest = self.lake.committed(self.name).agg(F.max("batch")).first()[0]
        return None if newest is None else self.read_batch(newest)

    # --- marked batches ---

    def _marks(self, slices: Sequence[str]) -> LakeTable:
        fields = [self.schema[s] for s in slices]
        return LakeTable(self.lake, f"{self.name}__marks", StructType([*fields, *_text_fields("since")]))

    def read_marked(self, slices: Sequence[str]) -> DataFrame:
        """Committed rows that no later load replaced. There is one mark per replaced slice."""
        marks = self._marks(slices).read_batches().groupBy(*slices).agg(F.max("since").alias("since"))
        rows = self._batch_rows().join(marks, list(slices), "left")
        alive = F.col("since").isNull() | (F.col("_batch") >= F.col("since"))
        return rows.filter(alive).select(*self.schema.fieldNames())

    def marks(self, slices: Sequence[str], replaced: DataFrame, batch: str) -> tuple[LakeTable, DataFrame]:
        """The table of marks, and those by which a batch replaces the slices named by ``replaced``."""
        return self._marks(slices), replaced.select(*slices).distinct().withColumn("since", F.lit(batch))

    def write_marked(self, df: DataFrame, replaced: DataFrame, slices: Sequence[str], batch: str) -> None:
        """Add rows, and replace the slices named by ``replaced``. Batch ids must grow."""
        publish_together(batch, (self, df), self.marks(slices, replaced, batch))

    # --- versions ---

    def _newest(self) -> str | None:
        """Newest version; versions are committed one by one, never as part of a unit."""
        return self.lake.commits(self.name).agg(F.max("batch")).first()[0]

    def read_version(self) -> DataFrame:
        newest = self._newest()
        if newest is None:
            return reshape.typed_empty(self.spark, self.schema)
        return self.spark.read.schema(self.schema).parquet(f"{self.path}/_version={newest}")

    def write_version(self, df: DataFrame, check: Check | None = None) -> None:
        """``check`` sees the written rows before they are committed, and fails the write by raising."""
        version = f"{int(self._newest() or 0) + 1:010d}"
        self._write(df, f"_version={version}")
        if check is not None:
            check(self.spark.read.schema(self.schema).parquet(f"{self.path}/_version={version}"))
        self.lake.commit(self.name, version)

    # --- partitions ---

    def read_partitions(self, columns: Sequence[str]) -> DataFrame:
        rows = read_or_create(self.spark, self.path, self.schema, columns)
        return rows.select(*self.schema.fieldNames())

    def replace_partitions(self, df: DataFrame, columns: Sequence[str], batch: str, check: Check | None = None) -> None:
        """Replace every partition that occurs in ``df``; others stay. ``check`` sees the staged rows.

        Rows are rebalanced by partition first: small partitions end in one file each, and one
        that holds most of the rows is split over many tasks.
        """
        staged = self.stage(df.select(*self.schema.fieldNames()), batch)
        if check is not None:
            check(staged)
        ordered = staged.hint("rebalance", *[F.col(c) for c in columns])
        ordered.sortWithinPartitions(*columns, *self.sort).write.mode("overwrite").option(
            "partitionOverwriteMode", "dynamic"
        ).option("maxRecordsPerFile", ROWS_PER_FILE).partitionBy(*columns).parquet(self.path)


def publish_together(batch: str, *parts: tuple[LakeTable, DataFrame], check: Callable[[LakeTable, DataFrame], None] | None = None) -> None:
    """Several tables under one batch id, or none: the unit is committed after all writes. ``check``
    sees each table's written rows, and keeps the unit from being committed by raising."""
    for table, rows in parts:
        table.write_batch(rows, batch, unit=batch)
        if check is not None:
            check(table, table.read_batch(batch))
    parts[0][0].lake.commit("units", batch)


def publish_pair(batch: str, first: tuple[LakeTable, DataFrame], second: tuple[LakeTable, DataFrame]) -> bool:
    """Two tables together, only if both have rows."""
    if first[1].isEmpty() or second[1].isEmpty():
        return False
    publish_together(batch, first, second)
    return True
