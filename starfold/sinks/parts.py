"""Merging into a stored table without rewriting it: copy-on-write by ranges of the key.

A table is stored in parts, each a range of its key columns in their order. The
manifest holds every part's least and largest key, so a merge knows from it which
parts its rows fall into; only those are read, merged and written anew, all others
are carried over as they are. Rows beyond the largest key become parts of their own.
"""

from __future__ import annotations

import json
import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.upsert import upsert
from .versions import PART, Load

ROWS_PER_PART = 1_000_000
#: Parts that a table may have before they get larger than asked for, up to :data:`ROWS_PER_PART`: the driver holds the
#: bounds of all, every row looks its part up, and each is a file of its own.
MANY_PARTS = 256
_JSON = {"timestampFormat": "yyyy-MM-dd HH:mm:ss.SSSSSS", "timestampNTZFormat": "yyyy-MM-dd HH:mm:ss.SSSSSS"}


def _bounds(keys: Sequence[str]) -> list[Column]:
    key = F.struct(*keys)
    return [F.to_json(F.min(key), _JSON).alias("low"), F.to_json(F.max(key), _JSON).alias("high"), F.count(F.lit(1)).alias("rows")]


def _place(entry: str) -> int:
    """A part keeps its place in the order of keys when it is written anew."""
    return int(entry.rpartition("=")[2])


def _router(schema: T.StructType, keys: Sequence[str], parts: dict[str, dict]) -> tuple[Column, Column]:
    """(place of the part whose range a row's key falls into, whether it lies beyond the last part).

    A part's range reaches to the next one's least key; what is below the first belongs to it. The search takes two
    steps over about the root of the number of parts each.
    """
    ordered = sorted(parts.items(), key=lambda item: _place(item[0]))
    kind = T.StructType([schema[k] for k in keys])
    key = F.struct(*[F.col(k).cast(schema[k].dataType).alias(k) for k in keys])
    step = math.isqrt(len(ordered)) + 1
    groups = [ordered[at:at + step] for at in range(0, len(ordered), step)]
    typed = lambda rows: F.from_json(F.lit(json.dumps(rows)), T.ArrayType(kind), _JSON)
    row = lambda part: json.loads(part["low"])
    number = lambda lows: F.greatest(F.size(F.filter(lows, lambda low: low <= key)), F.lit(1)) - 1
    group = number(typed([row(own[0][1]) for own in groups]))
    lows = F.from_json(F.lit(json.dumps([[row(part) for _, part in own] for own in groups])), T.ArrayType(T.ArrayType(kind)), _JSON)
    places = F.array(*[F.array(*[F.lit(_place(name)) for name, _ in own]) for own in groups])
    within = F.get(places, group)
    last = F.get(typed([json.loads(ordered[-1][1]["high"])]), F.lit(0))
    return F.get(within, number(F.get(lows, group))), key > last


def _part_size(rows: int, asked: int) -> int:
    """Rows of a part of a table of ``rows``: those ``asked`` for, or more where these would make too many parts."""
    return max(asked, min(ROWS_PER_PART, -(-rows // MANY_PARTS)))


def write_parts(load: Load, table: str, df: DataFrame, keys: Sequence[str], rows_per_part: int = ROWS_PER_PART) -> None:
    """Store ``df`` as parts of about ``rows_per_part`` rows by ranges of ``keys``, in the place of a former table.

    Beyond :data:`MANY_PARTS` parts they are larger, as far as :data:`ROWS_PER_PART` rows.
    """
    rows = df.count()
    count = max(1, -(-rows // _part_size(rows, rows_per_part)))
    ranged = df.repartitionByRange(count, *keys).withColumn(PART, F.spark_partition_id())
    load.set_parts(table, ranged, {}, _bounds(keys), {"keys": list(keys), "rows_per_part": rows_per_part})


def merge_parts(load: Load, table: str, source: DataFrame, **options) -> list[int]:
    """Upsert ``source`` into a table stored by :func:`write_parts`; gives the places of the parts written anew.

    ``options`` are those of :func:`starfold.operators.upsert.upsert` but ``sk``: keys
    are numbered by a registry. ``source`` is read three times, so write it when it is
    costly. Rows with a NULL in the key match nothing and are inserted in the part
    their key sorts into.
    """
    note, parts = load.note(table), load.parts(table)
    keys, size = note["keys"], note["rows_per_part"]
    if not parts:
        return _first_parts(load, table, source, keys, size, options)
    schema = load.read(table).schema
    place, beyond = _router(schema, keys, parts)
    routed = source.select("*", place.alias(PART), F.coalesce(beyond, F.lit(False)).alias("_beyond"))
    hit = {(r["_beyond"], r[PART]): r["count"] for r in routed.groupBy("_beyond", PART).count().collect()}  # a row a part at most
    touched = sorted(at for over, at in hit if not over)
    fresh = sum(n for (over, _), n in hit.items() if over)
    old = {name: part for name, part in parts.items() if _place(name) in touched}
    target = load.read(table, list(old)) if old else load.read(table).limit(0)
    plain = lambda rows: rows.drop(PART, "_beyond")
    written = []
    if touched:
        written.append(upsert(target, plain(routed.where("not _beyond")), keys, **options).withColumn(PART, place).hint("rebalance", PART))
    if fresh:
        added = upsert(load.read(table).limit(0), plain(routed.where("_beyond")), keys, **options)
        after = max(map(_place, parts)) + 1
        size = _part_size(sum(part["rows"] for part in parts.values()) + fresh, size)
        written.append(added.repartitionByRange(-(-fresh // size), *keys).withColumn(PART, F.spark_partition_id() + F.lit(after)))
    if written:
        both = written[0] if len(written) == 1 else written[0].unionByName(written[1])
        load.set_parts(table, both, {n: p for n, p in parts.items() if n not in old}, _bounds(keys), note)
    return touched


def touched_rows(load: Load, table: str, rows: DataFrame) -> DataFrame:
    """The stored rows of the parts that the keys of ``rows`` fall into: all that can equal one of them."""
    note, parts = load.note(table), load.parts(table)
    if not parts:
        return load.read(table)
    place, beyond = _router(load.read(table).schema, note["keys"], parts)
    hit = rows.where(~F.coalesce(beyond, F.lit(False))).select(place.alias(PART)).distinct()
    touched = {r[PART] for r in hit.collect()}  # places of parts at most
    names = [name for name in parts if _place(name) in touched]
    return load.read(table, names) if names else load.read(table).limit(0)


def _first_parts(load: Load, table: str, source: DataFrame, keys: Sequence[str], size: int, options: dict) -> list[int]:
    write_parts(load, table, upsert(load.read(table), source, keys, **options), keys, size)
    return []
