"""Materialised intermediate tables and size-checked broadcasts.

A table that is read more than once is written as Parquet under the folder the
cluster names in ``spark.checkpoint.dir``. The files outlive any executor, so a
lost executor costs a re-read, not a recomputation. They stay until the session's ``clear`` or the
end of the ``scope`` around the work that wrote them.
"""

from __future__ import annotations

import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

BROADCAST_MAX_ROWS = 1_000_000
BROADCAST_MAX_BYTES = 128 << 20

_local_root: dict[str, str] = {}
_scopes: list[list[str]] = []
_tables: dict[str, str] = {}  # path of a bucketed table to its name in the session's catalog


def staging_root(spark: SparkSession) -> str:
    """Shared staging folder; a private folder only for a local master."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    sc = spark.sparkContext
    if not sc.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
    if sc.applicationId not in _local_root:
        _local_root[sc.applicationId] = tempfile.mkdtemp(prefix="logblocks-")
    return _local_root[sc.applicationId]


def staging_path(spark: SparkSession, name: str) -> str:
    path = f"{_session_folder(spark)}/{name}-{uuid.uuid4().hex}"
    if _scopes:
        _scopes[-1].append(path)
    return path


def _session_folder(spark: SparkSession) -> str:
    return f"{staging_root(spark)}/logblocks/{spark.sparkContext.applicationId}"


def hadoop_path(spark: SparkSession, path: str):
    """(file system, path) as Spark itself reaches them."""
    found = spark._jvm.org.apache.hadoop.fs.Path(path)
    return found.getFileSystem(spark._jsc.hadoopConfiguration()), found


def _delete(spark: SparkSession, path: str) -> None:
    for inside in [p for p in _tables if p == path or p.startswith(f"{path}/")]:
        spark.sql(f"drop table if exists {_tables.pop(inside)}")
    files, found = hadoop_path(spark, path)
    files.delete(found, True)


@contextmanager
def scope(spark: SparkSession):
    """Deletes the tables staged inside when it ends; write the result before that."""
    _scopes.append([])
    try:
        yield
    finally:
        for path in _scopes.pop():
            _delete(spark, path)


@contextmanager
def published():
    """Tables staged inside outlive the scope around it."""
    _scopes.append([])
    try:
        yield
    finally:
        _scopes.pop()


def clear(spark: SparkSession) -> None:
    """Deletes all that this session staged."""
    _delete(spark, _session_folder(spark))


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once and continue from the written table."""
    spark = df.sparkSession
    path = staging_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def materialize_bucketed(df: DataFrame, name: str, key: str, buckets: int | None = None) -> DataFrame:
    """``materialize`` in sorted buckets of ``key``: joins and groupings of such tables on it need no exchange.

    For keys that are unique or nearly so, since all rows of one key share a bucket. Tables meet without an exchange if they
    have equally many buckets, which is the number of shuffle partitions unless told otherwise.
    """
    spark = df.sparkSession
    buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    path = staging_path(spark, name)
    _tables[path] = path.rsplit("/", 1)[1].replace("-", "_")
    dealt = df.repartition(buckets, key)  # one file a bucket
    dealt.write.bucketBy(buckets, key).sortBy(key).option("path", path).format("parquet").saveAsTable(_tables[path])
    return spark.table(_tables[path])


def materialize_counted(df: DataFrame, name: str, **counts: Column) -> tuple[DataFrame, dict[str, int]]:
    """``materialize`` and aggregates over the rows, taken by the job that writes them.

    They sit above the whole plan, in the tasks that write, where an attempt that is repeated counts once. A sum over no rows is 0.
    """
    seen = Observation()
    table = materialize(df.observe(seen, *[c.alias(n) for n, c in counts.items()]), name)
    return table, {n: seen.get[n] or 0 for n in counts}


def _width(field: T.StructField) -> Column:
    """About the bytes of one value."""
    column, kind = F.col(f"`{field.name}`"), field.dataType
    if isinstance(kind, (T.StringType, T.BinaryType)):
        return F.octet_length(column)
    if isinstance(kind, T.ArrayType) and isinstance(kind.elementType, T.NumericType):
        return F.size(column) * 8
    if isinstance(kind, (T.ArrayType, T.MapType, T.StructType)):
        return F.octet_length(F.to_json(F.struct(column)))
    return F.lit(8)


def fits(df: DataFrame, max_rows: int = BROADCAST_MAX_ROWS, max_bytes: int = BROADCAST_MAX_BYTES) -> bool:
    """True when ``df`` has at most ``max_rows`` rows of ``max_bytes`` together; reads no more rows than that."""
    width = sum((F.coalesce(_width(f), F.lit(0)) for f in df.schema.fields), F.lit(0))
    widths = df.select(width.cast("long").alias("width")).limit(max_rows + 1)  # one task counts them: numbers only
    rows, size = widths.agg(F.count(F.lit(1)), F.coalesce(F.sum("width"), F.lit(0))).first()
    return rows <= max_rows and size <= max_bytes


def broadcast_if_small(df: DataFrame, max_rows: int = BROADCAST_MAX_ROWS) -> DataFrame:
    """Broadcast hint behind a count of rows and bytes; a larger side keeps its shuffle join."""
    return F.broadcast(df) if fits(df, max_rows) else df


def spread(df: DataFrame, rows: int = 50_000) -> DataFrame:
    """``df`` dealt evenly if its files come in splits that would leave cores idle; rows and columns stay.

    A file of one row group is one task's work, however large. Counting rows by split reads no column.
    """
    splits = [r["count"] for r in df.groupBy(F.spark_partition_id().alias("part")).count().collect()]  # one row per split
    cores = df.sparkSession.sparkContext.defaultParallelism
    if max(splits, default=0) <= max(rows, 2 * sum(splits) // cores):
        return df
    return df.repartition(max(cores, sum(splits) // (20 * rows)), *df.columns)


def require_columns(df: DataFrame, names, what: str = "table") -> DataFrame:
    missing = sorted(set(names) - set(df.columns))
    if missing:
        raise KeyError(f"{what} is missing columns {missing}; available: {df.columns}")
    return df
