"""Helpers shared by the training-data operators."""

from __future__ import annotations

import ctypes

import numpy as np
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..checkpoints import discard, materialize
from ..operators.graph import connected_components
from ..shipping import ship_package

#: A word is a maximal run of anything but ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

__all__ = ["WORD", "WordHashes", "ascii_lower", "connected", "discard", "give_back", "map_in_pandas", "materialize", "mix", "row_key", "shingle_run", "ship_package", "table", "unused_name"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def map_in_pandas(df: DataFrame, run, schema: str, key: str = "doc_id") -> DataFrame:
    """mapInPandas where the nullable long `key` travels as a string: pandas would make floats of longs with nulls."""
    ship_package(df.sparkSession)
    out = df.withColumn(key, F.col(key).cast("string")).mapInPandas(run, schema.replace(f"{key} long", f"{key} string", 1))
    return out.withColumn(key, F.col(key).cast("long"))


def give_back() -> None:
    """Return freed memory to the system: a Python worker stays while later stages run without it."""
    import pyarrow

    pyarrow.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (OSError, AttributeError):  # another C library
        return


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z and nothing else."""
    return F.translate(text, UPPER, LOWER)


def connected(edges: DataFrame, a: str, b: str) -> DataFrame:
    """Smallest reachable id of every vertex of edges: columns (node, root)."""
    return connected_components(edges, a, b).withColumnRenamed("component", "root")


def row_key(*columns: Column) -> Column:
    """128 bits that tell rows of these columns apart; rows equal in all of them are one."""
    shown = [F.coalesce(F.concat(F.lit("="), c.cast("string")), F.lit("-")) for c in columns]
    lengths = [F.coalesce(F.length(c.cast("string")), F.lit(0)).cast("string") for c in columns[:-1]]
    return F.unhex(F.md5(F.concat_ws("\n", *lengths, *shown).cast("binary")))


def unused_name(name: str, *tables: DataFrame) -> str:
    """name, or name_ and so on where a table has a column of that name."""
    have = {c.lower() for t in tables for c in t.columns}
    while name.lower() in have:
        name += "_"
    return name


class WordHashes(dict):
    """64-bit hash of a word; forgets all when it has grown to a fixed number of words."""

    def __missing__(self, word: bytes | str) -> int:
        if len(self) > 500_000:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word if isinstance(word, bytes) else word.encode("utf-8", "surrogatepass"))
        return value


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingle_run(words: np.ndarray, size: int) -> np.ndarray:
    """Hash of the `size` words from each place on, of word hashes."""
    n = len(words) - size + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    x = np.full(n, size, np.uint64)
    for k in range(size):
        x = mix(x * np.uint64(0x9E3779B97F4A7C15) + words[k : k + n])
    return x
