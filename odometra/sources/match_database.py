"""SQLite match databases as a Spark data source, and their decoded tables."""

from __future__ import annotations

import sqlite3
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import (
    DataSource,
    DataSourceReader,
    EqualNullSafe,
    EqualTo,
    Filter,
    GreaterThan,
    GreaterThanOrEqual,
    In,
    InputPartition,
    IsNotNull,
    IsNull,
    LessThan,
    LessThanOrEqual,
    Not,
    StringContains,
    StringEndsWith,
    StringStartsWith,
)

from ..shipping import ship_package

# Tables of the database and the Spark types of the columns that are read.
TABLES = {
    "cameras": "camera_id bigint, model int, width int, height int, params binary, prior_focal_length int",
    "images": "image_id bigint, name string, camera_id bigint",
    "keypoints": "image_id bigint, rows int, cols int, data binary",
    "descriptors": "image_id bigint, rows int, cols int, data binary",
    "matches": "pair_id bigint, rows int, cols int, data binary",
    "two_view_geometries": "pair_id bigint, rows int, cols int, data binary, config int",
}


#: Filters that the database decides as Spark would: the comparison, and how often it needs the value.
CLAUSES = {
    EqualTo: "{c} = ?",
    EqualNullSafe: "{c} IS ?",
    GreaterThan: "{c} > ?",
    GreaterThanOrEqual: "{c} >= ?",
    LessThan: "{c} < ?",
    LessThanOrEqual: "{c} <= ?",
    StringStartsWith: "substr({c}, 1, length(?)) = ?",
    StringEndsWith: "({c} IS NOT NULL AND length({c}) >= length(?) AND substr({c}, length({c}) - length(?) + 1) = ?)",
    StringContains: "instr({c}, ?) > 0",
}
#: Values of an IN list that are sent along.
LONGEST_LIST = 500


def where_clause(f: Filter, columns: dict[str, str]) -> tuple[str, list] | None:
    """SQL of a filter and its values; none if Spark has to decide it. columns: name to Spark type."""
    if isinstance(f, Not):
        inner = where_clause(f.child, columns)
        return inner and (f"NOT ({inner[0]})", inner[1])
    name = f.attribute[0]
    if len(f.attribute) != 1 or columns.get(name) not in ("bigint", "int", "string"):
        return None
    if isinstance(f, IsNull | IsNotNull):
        return f"{name} IS {'NOT ' if isinstance(f, IsNotNull) else ''}NULL", []
    text = columns[name] == "string"
    fits = lambda v: v is None or (isinstance(v, str) if text else isinstance(v, int) and not isinstance(v, bool))
    if isinstance(f, In):
        if len(f.value) > LONGEST_LIST or not all(map(fits, f.value)):
            return None
        return f"{name} IN ({', '.join('?' * len(f.value))})", list(f.value)
    clause = CLAUSES.get(type(f))
    if clause is None or not fits(f.value) or (f.value is None and not isinstance(f, EqualNullSafe)):
        return None
    return clause.format(c=name), [f.value] * clause.count("?")


class _Rows(InputPartition):
    def __init__(self, low: int, high: int) -> None:
        self.low, self.high = low, high


class _Reader(DataSourceReader):
    def __init__(self, options: dict, columns: list[str]) -> None:
        self.path, self.table, self.columns = options["path"], options["table"], columns
        self.parts = int(options.get("partitions", "8"))
        self.clauses: list[str] = []
        self.values: list = []

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        """Take what the database can decide; the rest goes back to Spark."""
        columns = dict(c.split() for c in TABLES[self.table].split(", "))
        for f in filters:
            if (found := where_clause(f, columns)) is None:
                yield f
            else:
                self.clauses.append(found[0])
                self.values += found[1]

    def _where(self) -> str:
        return "".join(f" AND ({c})" for c in self.clauses)

    def _open(self) -> sqlite3.Connection:
        return sqlite3.connect(f"file:{self.path}?mode=ro", uri=True)

    def partitions(self) -> list[InputPartition]:
        """Ranges of rowid, of the rows that the filters leave; a range is read by one task through the table's own index."""
        with self._open() as db:
            low, high = db.execute(f"SELECT min(rowid), max(rowid) FROM {self.table} WHERE true{self._where()}", self.values).fetchone()
        if low is None:
            return [_Rows(0, -1)]
        step = max(1, -(-(high - low + 1) // self.parts))
        return [_Rows(a, min(high, a + step - 1)) for a in range(low, high + 1, step)]

    def read(self, partition: _Rows) -> Iterator[tuple]:
        with self._open() as db:
            yield from db.execute(f"SELECT {', '.join(self.columns)} FROM {self.table} WHERE rowid BETWEEN ? AND ?{self._where()}", (partition.low, partition.high, *self.values))


class MatchDatabase(DataSource):
    """spark.read.format("match_database").option("path", ..).option("table", ..). The file must be where every worker finds it.

    Comparisons, IN lists, null tests and their negations on numbers and names are decided by
    the database, if spark.sql.python.filterPushdown.enabled is set (read_table does).
    """

    @classmethod
    def name(cls) -> str:
        return "match_database"

    def schema(self) -> str:
        return TABLES[self.options["table"]]

    def reader(self, schema) -> DataSourceReader:
        return _Reader(self.options, [f.name for f in schema.fields])


def read_table(spark: SparkSession, path: str, table: str) -> DataFrame:
    """A table of the database; filters on it are pushed into the scan."""
    if table not in TABLES:
        raise ValueError(f"unknown table {table}; there are {sorted(TABLES)}")
    ship_package(spark)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(MatchDatabase)
    return spark.read.format("match_database").option("path", path).option("table", table).load()


def pair_ids(pairs: DataFrame) -> DataFrame:
    """pairs with id1 and id2 decoded from pair_id."""
    from ..functions.scalar import pair_first, pair_second

    return pairs.withColumn("id1", pair_first("pair_id")).withColumn("id2", pair_second("pair_id"))


def match_counts(matches: DataFrame, verified: DataFrame) -> DataFrame:
    """(pair_id, matches, inliers, config) of verified pairs; a pair without raw matches has null there."""
    m = matches.select("pair_id", F.col("rows").alias("matches"))
    return verified.select("pair_id", F.col("rows").alias("inliers"), "config").join(m, "pair_id", "left")
