"""Cut lineage through the folder that driver and executors share."""

from __future__ import annotations

import atexit
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_written: dict[str, SparkSession] = {}


def shared_dir(spark: SparkSession) -> str:
    """spark.checkpoint.dir. Where it is unset, a temporary folder on a local master, and an error on a cluster."""
    where = spark.conf.get("spark.checkpoint.dir", None)
    if not where:
        master = spark.conf.get("spark.master", "")
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that driver and executors share")
        where = tempfile.mkdtemp(prefix="odometra-")
        spark.conf.set("spark.checkpoint.dir", where)
    return where.rstrip("/")


def materialize(df: DataFrame) -> DataFrame:
    """Write df as Parquet to the shared folder and read it back.

    A lost executor then costs a re-read instead of the stages above, and what is
    non-deterministic or dear is computed once. Files go when the application ends, or
    earlier by discard().
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/odometra-{uuid.uuid4().hex}"
    schema = df.schema
    df.write.parquet(path)
    _written[path] = spark
    out = spark.read.schema(schema).parquet(path)
    out.written_to = path
    return out


def discard(*tables: DataFrame) -> None:
    """Delete the files of tables that materialize() returned and that nothing reads any more."""
    for df in tables:
        path = getattr(df, "written_to", None)
        if path in _written:
            _delete(_written.pop(path), path)


def _delete(spark: SparkSession, path: str) -> None:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


@atexit.register
def _clean() -> None:
    for path, spark in _written.items():
        try:
            _delete(spark, path)
        except Exception:  # the session has gone, and with it the way to the folder
            return
