"""Joins that stay balanced when one key holds a large share of the rows."""

from __future__ import annotations

from collections import Counter
from collections.abc import Sequence
from functools import reduce
from weakref import WeakKeyDictionary

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

SALT = "_salt"


_SKETCH_GROUPS, _SKETCH_ITEMS = 256, 100


def broadcast_limit(df: DataFrame) -> int:
    """``spark.sql.autoBroadcastJoinThreshold`` in bytes; -1 when broadcasts are off."""
    return df.sparkSession._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold()


def estimated_bytes(df: DataFrame) -> int:
    """Catalyst's size estimate (file sizes scaled by the columns kept); it may exceed a long."""
    return int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())


#: Bytes that a row takes in a broadcast: its place in the hash table and its header, each of its columns, and a text.
_ROW, _COLUMN, _TEXT = 32, 8, 24
#: How many times Spark's limit the rows of a broadcast may take; how much less than it files are whose rows need not be
#: counted; how much smaller an estimate may get by the columns that a plan does not read.
_UNPACKED, _TINY, _PRUNED = 4, 256, 4

_rows: WeakKeyDictionary[DataFrame, int] = WeakKeyDictionary()
_distinct_of: WeakKeyDictionary[DataFrame, DataFrame] = WeakKeyDictionary()


def distinct_rows(df: DataFrame) -> DataFrame:
    """``df.distinct()``; when it is asked whether that is small, the rows of ``df`` are counted, without a shuffle."""
    rows = df.distinct()
    _distinct_of[rows] = df
    return rows


def memory_bytes(df: DataFrame) -> int:
    """About what the rows take as a broadcast, which is built on the driver: from their number, counted once for a DataFrame."""
    df = _distinct_of.get(df, df)
    if df not in _rows:
        _rows[df] = df.count()
    texts = sum(isinstance(f.dataType, (T.StringType, T.BinaryType, T.ArrayType, T.MapType, T.StructType)) for f in df.schema.fields)
    return _rows[df] * (_ROW + _COLUMN * len(df.columns) + _TEXT * texts)


def is_small(df: DataFrame, share: int = 1) -> bool:
    """Whether Spark would broadcast ``df`` by its estimated size, and its rows are in memory what that size promises.

    The estimate is the size of files. Packed well, the keys of millions of rows are less than Spark's
    limit in files, and hundreds of MB in the driver's memory. ``share``: the part of either that ``df`` may take.
    """
    files, limit = share * estimated_bytes(df), broadcast_limit(df)
    return files <= limit and (_TINY * files <= limit or share * memory_bytes(df) <= _UNPACKED * limit)


def _packed(df: DataFrame) -> bool:
    """Whether Spark may broadcast ``df``, also when columns that nobody reads are gone, although its rows are too many for that."""
    files, limit = estimated_bytes(df), broadcast_limit(df)
    return files <= _PRUNED * limit < _PRUNED * _TINY * files and memory_bytes(df) > _UNPACKED * limit


def sized_join(df: DataFrame, side: DataFrame, on: Sequence[str] | str, how: str = "inner") -> DataFrame:
    """Join of tables that may both grow: Spark broadcasts neither of them just because its files are small."""
    if _packed(side):
        side = side.hint("merge")
    elif how == "inner" and _packed(df):  # the left side of other joins stays where it is
        side = F.broadcast(side) if is_small(side) else side.hint("merge")
    return df.join(side, on, how)


#: Share of Spark's limit that one of many broadcasts in a plan may take.
_LEAN = 8


def lean_join(df: DataFrame, side: DataFrame, on: str, how: str = "inner") -> DataFrame:
    """Join for a chain of many sides that grow alike: only sides far below Spark's limit are broadcast.

    A side just within that limit is ten times its files' size in memory, and each of a chain
    would pass through the driver. The others are shuffled by key, also when they turn out to be small.
    """
    return df.join(side if is_small(side, _LEAN) else side.hint("merge"), on, how)


def any_null(cols: Sequence[str]) -> Column:
    return reduce(lambda a, b: a | b, [F.col(c).isNull() for c in cols])


def row_hash(df: DataFrame) -> Column:
    """Hash of the row and its partition: spreads even equal rows.

    Unlike a random or running number it does not depend on the order of rows in
    a partition, so a repeated task gives every row the same value again.
    """
    return F.xxhash64(*[F.col(c) for c in df.columns], F.spark_partition_id())


def key_hash(on: Sequence[str], like: T.StructType) -> Column:
    """Hash of the key columns, taken in the types of ``like`` so that both sides of a join agree."""
    return F.xxhash64(*[F.col(c).cast(like[c].dataType) for c in on])


def hot_keys(df: DataFrame, on: Sequence[str], share: float = 0.01) -> list[int]:
    """Hashes of the key values holding more than ``share`` of the rows.

    A frequent-items sketch per task over the key columns alone: keys are not
    shuffled, only sketches are, merged in ``_SKETCH_GROUPS`` groups. What reaches
    the driver is bounded by groups and items, whatever the data. The sketch may
    miss or add a borderline key; that costs or saves balance, never a row.
    """
    hashed = df.filter(~any_null(on)).select(
        F.pmod(F.spark_partition_id(), F.lit(_SKETCH_GROUPS)).alias("_group"), key_hash(on, df.schema).alias("_key"))
    sketched = hashed.groupBy("_group").agg(
        F.count(F.lit(1)).alias("rows"), F.expr(f"approx_top_k(_key, {_SKETCH_ITEMS}, {10 * _SKETCH_ITEMS})").alias("top"))
    rows, counts = 0, Counter()
    for group in sketched.collect():
        rows += group.rows
        counts.update({item.item: item["count"] for item in group.top})
    return sorted(key for key, n in counts.items() if n > share * rows)


def salted_join(
    big: DataFrame, side: DataFrame, on: Sequence[str], hot: Sequence[int], how: str = "inner", salts: int | None = None
) -> DataFrame:
    """Equi-join where each key of ``hot`` (see :func:`hot_keys`) is spread over ``salts`` partitions.

    Rows of ``big`` with a hot key get a salt from their row hash, the few rows
    of ``side`` with that key are repeated once per salt, all other rows keep
    salt 0. In an outer or anti join NULL keys match nothing, so they are spread too.
    By default a key is spread over as many salts as there are shuffle partitions,
    so that the pieces shrink as the cluster is given more of them.
    """
    salts = salts or int(big.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    if how not in ("inner", "left", "left_anti", "left_semi"):
        raise ValueError(f"cannot salt a {how} join")
    spread = F.pmod(row_hash(big), F.lit(salts)).cast("int")
    zero = F.lit(0)
    is_hot = key_hash(on, big.schema).isin(list(hot))
    big_salt = F.when(is_hot, spread) if hot else F.when(F.lit(False), zero)
    if how in ("left", "left_anti"):
        big_salt = big_salt.when(any_null(on), spread)
    side_salts = F.array(zero)
    if hot:
        side_salts = F.when(is_hot, F.sequence(zero, F.lit(salts - 1))).otherwise(side_salts)
    return (
        big.withColumn(SALT, big_salt.otherwise(zero))
        .join(side.withColumn(SALT, F.explode(side_salts)), [*on, SALT], how)
        .drop(SALT)
    )


def skewed(big: DataFrame, side: DataFrame, on: Sequence[str], share: float = 0.01) -> list[int]:
    """Hot keys of ``big`` for a join to ``side``; none are looked for when ``side`` would be broadcast."""
    return [] if is_small(side) else hot_keys(big, on, share)


def skew_join(
    big: DataFrame, side: DataFrame, on: Sequence[str] | str, how: str = "inner",
    hot: Sequence[int] | None = None, salts: int | None = None,
) -> DataFrame:
    """Join ``big`` to ``side`` on equal column names, whatever their size and skew.

    A side small enough to broadcast is left to Catalyst (no shuffle, no skew).
    Otherwise the hot keys of ``big`` are salted. They are looked up unless given:
    give them when ``big`` is itself a long plan, found on the table it starts from.
    """
    on = [on] if isinstance(on, str) else list(on)
    if is_small(side):
        return sized_join(big, side, on, how)
    hot = hot_keys(big, on) if hot is None else hot
    if not hot and how in ("inner", "left_semi"):
        return sized_join(big, side, on, how)
    return salted_join(big, side.hint("merge") if _packed(side) else side, on, hot, how, salts)
