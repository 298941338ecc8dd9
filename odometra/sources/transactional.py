"""Tables that are replaced as a whole: a Python data source writer with commit and abort.

Tasks write Parquet parts into a hidden folder; the commit renames it and replaces the file
that names the current version. A failed task or job leaves the version before as it was.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage

from ..shipping import ship_package
from .files import current_version, discard_staged, located, new_version, publish, staging


@dataclass
class Part(WriterCommitMessage):
    """The file that a task wrote, or none if it had no rows."""

    name: str | None
    rows: int


class _Writer(DataSourceArrowWriter):
    def __init__(self, path: str) -> None:
        self.path, self.version = path, new_version()
        fs, at = located(path)
        fs.create_dir(staging(at, self.version), recursive=True)

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Part:
        fs, at = located(self.path)
        # an attempt that is repeated or raced writes another file; only named files are published
        name, out, rows = f"part-{uuid.uuid4().hex}.parquet", None, 0
        try:
            for batch in iterator:
                if out is None:
                    out = pq.ParquetWriter(f"{staging(at, self.version)}/{name}", batch.schema, filesystem=fs)
                out.write_batch(batch)
                rows += batch.num_rows
        finally:
            if out is not None:
                out.close()
        return Part(name if out is not None else None, rows)

    def commit(self, messages: list[Part | None]) -> None:
        publish(self.path, self.version, [m.name for m in messages if m is not None and m.name])

    def abort(self, messages: list[Part | None]) -> None:
        discard_staged(self.path, self.version)


class VersionedTable(DataSource):
    """df.write.format("versioned_table").option("path", ..).mode("overwrite")."""

    @classmethod
    def name(cls) -> str:
        return "versioned_table"

    def schema(self):
        raise NotImplementedError("read it with transactional.read")

    def writer(self, schema, overwrite: bool) -> DataSourceArrowWriter:
        if not overwrite and current_version(self.options["path"]) is not None:
            raise ValueError("a versioned table is replaced as a whole: use mode overwrite")
        return _Writer(self.options["path"])


def replace(rows: DataFrame, path: str) -> None:
    """Make rows the table at path, all or nothing. rows may be made of the table itself: it is read before it is replaced."""
    spark = rows.sparkSession
    ship_package(spark)
    spark.dataSource.register(VersionedTable)
    rows.write.format("versioned_table").option("path", path).mode("overwrite").save()


def read(spark: SparkSession, path: str, schema) -> DataFrame:
    """The current version, by Spark's own Parquet reader; no rows before the first commit or for an empty version."""
    version = current_version(path)
    if version is None:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(f"{path.rstrip('/')}/{version}")


def delete_keys(spark: SparkSession, path: str, schema, keys: DataFrame, on: list[str]) -> int:
    """Rewrite the table without the rows of the keys; how many rows are left. Rows with a null key stay."""
    replace(read(spark, path, schema).join(keys.select(*on).distinct(), on, "left_anti"), path)
    return read(spark, path, schema).count()


# Groups of tables that are emptied together.
GROUPS = {
    "images": ("images", "matches", "two_view_geometries"),
    "features": ("descriptors", "keypoints", "matches", "two_view_geometries"),
    "matches": ("matches", "two_view_geometries"),
    "two_view_geometries": ("two_view_geometries",),
}


def write_database(tables: dict[str, DataFrame], folder: str) -> None:
    """A folder of versioned tables by name."""
    for name, rows in tables.items():
        replace(rows, f"{folder}/{name}")


def clean_database(spark: SparkSession, folder: str, group: str, schemas: dict) -> list[str]:
    """Empty the tables of a group ("all": all of them) that the database has; the names of those. Others stay untouched, versions included.

    schemas: the database's tables with their schemas. An unknown group is an error and changes nothing.
    """
    if group != "all" and group not in GROUPS:
        raise ValueError(f"unknown group {group}; there are {['all', *GROUPS]}")
    emptied = [name for name in schemas if (group == "all" or name in GROUPS[group]) and current_version(f"{folder}/{name}") is not None]
    for name in emptied:
        replace(spark.createDataFrame([], schemas[name]), f"{folder}/{name}")
    return emptied
