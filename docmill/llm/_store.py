"""Shared storage for intermediate tables, and joins with small tables.

Intermediates are cut from their lineage by writing them as Parquet below
``spark.checkpoint.dir``, a folder that every executor and the driver share. A lost
executor then costs only the tasks that ran on it. The setting is read from the session;
only where it is unset (local tests) a temporary folder of this machine is used.

All tables of a session stand in one folder below it. A table whose last reader has been written is discarded at
once, and ``settled`` discards all that an operator made for a result that is itself written; ``clear`` removes
what is left, when the results that read it are no longer needed.
"""

from __future__ import annotations

import tempfile
import uuid
import weakref
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

#: Rows up to which a table of short keys is broadcast (about 100 bytes a row); larger ones are joined by a shuffle.
BROADCAST_ROWS = 500_000

#: Bytes of rows that a worker gets at once; a longer row comes alone. Spark's own bound is 10,000 rows, of which both sides hold copies.
BATCH_BYTES = 4 << 20
_BATCH = "spark.sql.execution.arrow.maxBytesPerBatch"

_local: dict[str, str] = {}
_paths: weakref.WeakKeyDictionary[DataFrame, str] = weakref.WeakKeyDictionary()
#: Paths of the tables that are there, in the order in which they were made.
_live: dict[str, None] = {}


def shared_dir(spark: SparkSession) -> str:
    """The shared folder for intermediates."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir must name a shared folder on a cluster")
    return _local.setdefault("dir", tempfile.mkdtemp(prefix="docmill-"))


def run_dir(spark: SparkSession) -> str:
    """The folder of this session's intermediates."""
    return f"{shared_dir(spark).rstrip('/')}/docmill-{spark.sparkContext.applicationId}"


def materialize(df: DataFrame, name: str, *replaced: DataFrame) -> DataFrame:
    """Write ``df`` as Parquet into the shared folder and return the table as read again.

    ``replaced`` are materialized tables that nothing but ``df`` reads; they are discarded.
    """
    spark = df.sparkSession
    path = f"{run_dir(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    table = spark.read.schema(df.schema).parquet(path)
    _paths[table] = path
    _live[path] = None
    discard(*replaced)
    return table


def discard(*tables: DataFrame) -> None:
    """Remove materialized tables that no later job reads."""
    for table in tables:
        path = _paths.pop(table, None)
        if path:
            _delete(table.sparkSession, path)


def settled(make: Callable[[], DataFrame], name: str, *replaced: DataFrame) -> DataFrame:
    """The DataFrame that ``make`` gives as a table of its own; all other tables made for it are discarded, and ``replaced``."""
    before = set(_live)
    table = materialize(make(), name, *replaced)
    for path in [p for p in _live if p not in before and p != _paths[table]]:
        _delete(table.sparkSession, path)
    return table


def clear(spark: SparkSession) -> None:
    """Remove all intermediates of this session; results that still read them can be used no longer."""
    _delete(spark, run_dir(spark))


def remove(spark: SparkSession, path: str) -> None:
    """Remove a folder below ``run_dir`` that an operator filled itself."""
    _delete(spark, path)


def _delete(spark: SparkSession, path: str) -> None:
    for known in [p for p in _live if p == path or p.startswith(f"{path}/")]:
        del _live[known]
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(place, True)


def map_texts(rows: DataFrame, run: Callable, schema: StructType | str) -> DataFrame:
    """``mapInArrow`` over rows with texts, in batches of ``BATCH_BYTES``, or of what the session sets itself."""
    conf = rows.sparkSession.conf
    if conf.get(_BATCH, None) is None:
        conf.set(_BATCH, str(BATCH_BYTES))  # a plan takes the setting that holds when it runs
    return rows.mapInArrow(run, schema)


def small(table: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """A materialized table of short rows, marked for broadcast if it is counted to have at most ``rows`` rows."""
    return F.broadcast(table) if table.limit(rows + 1).count() <= rows else table


#: Bits of a sieve for each key, and in all (64 MB).
SIEVE_BITS, MOST_BITS = 16, 1 << 29
_BITMAP = 1 << 15


def _place(key: Column, bits: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(bits))


def sieve(keys: DataFrame, column: str, n: int) -> tuple[DataFrame, int]:
    """(bucket, bitmap) with the bits of all keys set, and the number of bits: a Bloom filter with one hash, made of native functions."""
    bits = min(MOST_BITS, max(1, -(-n * SIEVE_BITS // _BITMAP)) * _BITMAP)
    at = keys.select(_place(F.col(column), bits).alias("at"))
    table = at.groupBy(F.floor(F.col("at") / _BITMAP).alias("__bucket")).agg(F.bitmap_construct_agg(F.col("at") % _BITMAP).alias("__bitmap"))
    return table, bits


def sieved(rows: DataFrame, key: Column, keys: DataFrame, column: str, n: int) -> DataFrame:
    """``rows`` with __may: false only where ``keys`` does not hold the key; rows stay where they are."""
    table, bits = sieve(keys, column, n)
    marked = rows.withColumn("__at", _place(key, bits)).withColumn("__bucket", F.floor(F.col("__at") / _BITMAP))
    joined = marked.join(F.broadcast(materialize(table, "sieve")), "__bucket", "left")
    byte = F.conv(F.hex(F.substring("__bitmap", F.floor(F.col("__at") % _BITMAP / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    hit = F.floor(byte / F.element_at(F.array(*[F.lit(1 << k) for k in range(8)]), (F.col("__at") % 8 + 1).cast("int"))) % 2 == 1
    return joined.withColumn("__may", F.coalesce(hit & key.isNotNull(), F.lit(False))).drop("__at", "__bucket", "__bitmap")


def matched(rows: DataFrame, key: Column, keys: DataFrame, column: str, how: str) -> DataFrame:
    """``rows`` (large ones, with texts) joined with ``keys`` (short and distinct, a table) where ``key`` equals ``column``: left, left_semi or left_anti.

    Few keys are broadcast. Beyond that a sieve of them is, and only the rows that it lets through are shuffled.
    """
    n = keys.count()
    if n <= BROADCAST_ROWS:
        return rows.join(F.broadcast(keys), key == F.col(column), how)
    tested = sieved(rows, key, keys, column, n)
    kept = [c for c in tested.columns if c != "__may"]
    inside = tested.filter("__may").select(*[f"`{c}`" for c in kept]).join(keys, key == F.col(column), how)
    outside = tested.filter("not __may").select(*[f"`{c}`" for c in kept])
    return inside if how == "left_semi" else inside.unionByName(outside, allowMissingColumns=True)
