"""Helpers shared by the training-data operators: tables, shared work folder, skew."""

from __future__ import annotations

import atexit
import ctypes
import tempfile
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from folioscope.shipping import ship as ship  # noqa: PLC0414  operators take it from here

#: ASCII white space, the only characters that separate words or are stripped from lines.
WS = " \t\n\x0b\x0c\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
SPACE_PATTERN = "[\\x20\\x09-\\x0D]+"

#: Most keys that `skew_join` ever broadcasts.
HOT_KEYS = 1000

_made: list[tuple[SparkSession, str]] = []


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir.

    Only a session whose executors live in the driver's own process (master
    local) may do without: it gets a folder of this machine. Anywhere else that
    would be a folder that executors don't share, so it is an error.
    """
    sc = spark.sparkContext
    at = sc.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if not at:
        if sc.master != "local" and not sc.master.startswith("local["):
            raise ValueError("spark.checkpoint.dir is unset: on a cluster it must name a folder that driver and executors share")
        at = tempfile.mkdtemp(prefix="folioscope-")
        sc.setCheckpointDir(at)
    return at.rstrip("/")


def _remove(spark: SparkSession, path: str) -> None:
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def _clean_up() -> None:
    for spark, path in _made:
        try:
            _remove(spark, path)
        except Exception:  # noqa: BLE001  the session may be gone; the folder is scratch
            pass


atexit.register(_clean_up)


class Work:
    """Tables written to the shared folder, which cut lineage and survive lost executors.

    `save` writes a frame as Parquet and reads it back; `drop` removes one that
    nothing reads any more. What is left goes when the driver's Python ends.
    """

    def __init__(self, spark: SparkSession, name: str) -> None:
        self.spark = spark
        self.root = f"{shared_dir(spark)}/folioscope/{name}-{uuid.uuid4().hex}"
        _made.append((spark, self.root))

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def save(self, df: DataFrame, name: str) -> DataFrame:
        df.write.mode("overwrite").option("compression", "zstd").parquet(self.path(name))
        return self.spark.read.schema(df.schema).parquet(self.path(name))

    def drop(self, *names: str) -> None:
        for name in names:
            _remove(self.spark, self.path(name))


def trimmed(run: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """`run` over a partition's batches, after which freed memory goes back to the system.

    Python workers are used again, so what one stage has freed but keeps would stand beside the memory of the next.
    """

    def outer(batches: Iterator) -> Iterator:
        yield from run(batches)
        pa.default_memory_pool().release_unused()
        try:
            ctypes.CDLL(None).malloc_trim(0)
        except (AttributeError, OSError):  # not every C library has it
            pass

    return outer


def ascii_lower(c: Column) -> Column:
    """A-Z lower-cased, all else untouched. Pure ASCII takes the fast built-in."""
    return F.when(F.octet_length(c) == F.char_length(c), F.lower(c)).otherwise(
        F.translate(c, UPPER, LOWER)
    )


def strip_ws(c: Column) -> Column:
    return F.trim(c, F.lit(WS))


def skew_join(
    left: DataFrame, right: DataFrame, keys: list[str], weight: str, spread: str, how: str = "inner", salts: int = 64
) -> DataFrame:
    """Equi-join in which keys heavy on the left are spread over `salts` reducers.

    `right` holds each key's left row count in `weight`, and any number of rows per key. The HOT_KEYS
    heaviest keys (a fixed bound, so broadcasting them is safe) get a salt from
    the left column `spread`; their right rows are repeated once per salt. All
    other keys join plainly; the 1,001st key can't hold more than a thousandth of the left rows. The
    result doesn't depend on which keys are hot.
    """
    hot = (
        right.where(F.col(weight) >= 256)
        .groupBy(*keys)
        .agg(F.max(weight).alias(weight))
        .orderBy(F.col(weight).desc(), *keys)
        .limit(HOT_KEYS)
        .select(*keys, F.lit(True).alias("_hot"))
    )
    l = left.join(F.broadcast(hot), keys, "left").withColumn(
        "_salt", F.when(F.col("_hot"), F.pmod(F.xxhash64(spread), F.lit(salts))).otherwise(F.lit(0).cast("bigint"))
    ).drop("_hot")
    r = right.join(F.broadcast(hot), keys, "left").withColumn(
        "_salt",
        F.explode(
            F.when(F.col("_hot"), F.sequence(F.lit(0).cast("bigint"), F.lit(salts - 1).cast("bigint"))).otherwise(
                F.array(F.lit(0).cast("bigint"))
            )
        ),
    ).drop("_hot")
    return l.join(r, [*keys, "_salt"], how).drop("_salt")


#: Bits of a member filter: 2,048 rows of 4 KB, so broadcasting one is safe whatever the number of members.
FILTER_BITS = 1 << 26


def mark_members(df: DataFrame, column: str, members: DataFrame, name: str) -> DataFrame:
    """df with a boolean `name`: true where `column` is among those of `members`, and for few other rows.

    A bitmap of fixed size over hashes, made by built-in aggregates and broadcast, tells
    rows that may have a partner from those that have none, which then needn't be shuffled.
    With very many members it fills up and says true more often; it never says false
    of a member.
    """
    place = F.pmod(F.xxhash64(column), F.lit(FILTER_BITS)) + 1
    bits = (
        members.select(place.alias("_km_h"))
        .groupBy(F.bitmap_bucket_number("_km_h").alias("_km_bucket"))
        .agg(F.bitmap_construct_agg(F.bitmap_bit_position("_km_h")).alias("_km_bits"))
    )
    out = df.withColumn("_km_h", place).withColumn("_km_bucket", F.bitmap_bucket_number("_km_h")).join(F.broadcast(bits), "_km_bucket", "left")
    at = F.bitmap_bit_position("_km_h")
    byte = F.conv(F.hex(F.substring("_km_bits", (F.floor(at / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    return out.select(*df.columns, F.coalesce(F.getbit(byte, (at % 8).cast("int")) == 1, F.lit(False)).alias(name))


def keep_members(df: DataFrame, column: str, members: DataFrame) -> DataFrame:
    """Rows of df whose `column` may be among those of `members`: all that are, and few others."""
    return mark_members(df, column, members, "_km").where("_km").drop("_km")
