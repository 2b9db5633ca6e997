"""Indices over files and tables: a mapping and rows (_id, _source) or typed columns; patterns, sampling, schema cache."""

from __future__ import annotations

import fnmatch
import itertools
import json
import threading
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.mapping import Resolved, merge, resolve
from ..operators.decode import _get, decode
from ..operators.dsl import compile_query


@dataclass(frozen=True)
class Index:
    """``load`` gives rows (_id, _source) of JSON text, or with ``typed`` the mapped columns themselves (and _id)."""

    name: str
    mapping: dict
    load: Callable[[SparkSession], DataFrame]
    typed: bool = False

    def resolved(self) -> Resolved:
        return resolve(self.mapping)


class Catalog:
    """Indices by name; a pattern with * names several, a comma joins names."""

    _numbers = itertools.count()

    def __init__(self):
        self._indices: dict[str, Index] = {}
        self.number = next(self._numbers)  # names this catalog in the schema cache; an id() may come again

    def add(self, index: Index) -> None:
        self._indices[index.name] = index

    def find(self, pattern: str) -> list[Index]:
        names = [n for p in pattern.split(",") for n in sorted(self._indices) if fnmatch.fnmatchcase(n, p.strip())]
        out = [self._indices[n] for n in dict.fromkeys(names)]
        if not out:
            raise ValueError(f"no such index: {pattern}")
        return out


CATALOG = Catalog()
_cache: dict[tuple, Resolved] = {}
_lock = threading.Lock()
#: How often mappings were resolved and documents sampled, for tests.
COUNTS = {"mapping": 0, "sample": 0}


def clear_cache() -> bool:
    with _lock:
        _cache.clear()
    return True


def bulk_lines(spark: SparkSession, path: str) -> DataFrame:
    """Rows (_id, _source) of bulk files: of each document an action line with its _id, then its own line.

    Lines are paired within their file, blank ones left out. Large files are read in ranges: the lines of each are
    counted, so that each knows its place in the file, and no task meets a whole file.
    """
    at = [F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("range"), F.monotonically_increasing_id().alias("k")]
    lines = spark.read.text(path).select(F.col("value").alias("line"), *at).where("trim(line) <> ''")
    counted = lines.groupBy("file", "range").agg(F.count("*").alias("n"))
    before = F.sum("n").over(Window.partitionBy("file").orderBy("range").rowsBetween(Window.unboundedPreceding, -1))
    counted = counted.select("file", "range", F.coalesce(before, F.lit(0)).alias("before"))
    here = F.row_number().over(Window.partitionBy("file", "range").orderBy("k")) - 1
    placed = lines.withColumn("here", here).join(counted, ["file", "range"]).withColumn("place", F.col("before") + F.col("here"))
    side = lambda n: F.max(F.when(F.col("place") % 2 == n, F.col("line")))
    pairs = placed.groupBy("file", F.floor(F.col("place") / 2).alias("pair")).agg(side(0).alias("action"), side(1).alias("_source"))
    return pairs.select(F.coalesce(F.get_json_object("action", "$.index._id"), F.get_json_object("action", "$.create._id")).alias("_id"), "_source")


def array_paths(rows: DataFrame, r: Resolved) -> frozenset[str]:
    """Mapped paths outside of geometries that hold an array in any of the rows; objects inside objects too."""
    found: set[str] = set()
    names = [p for p in r.kinds if not r.is_geo(p)]
    if not names:
        return frozenset()

    def holder(path: str):
        v = F.try_parse_json("_source")
        for part in path.split("."):
            v = _get(v, part)
        return F.coalesce(F.schema_of_variant(v).startswith("ARRAY"), F.lit(False))

    got = rows.agg(*[F.max(holder(p)).alias(str(i)) for i, p in enumerate(names)]).first()
    found.update(p for i, p in enumerate(names) if got[i])
    return frozenset(found)


def resolve_schema(spark: SparkSession, pattern: str, query: dict | str | None, sample_size: int, catalog: Catalog = CATALOG) -> Resolved:
    """Mappings merged, then arrays from a sample of the documents that the query matches; cached by all of these."""
    text = query if isinstance(query, str) or query is None else json.dumps(query, sort_keys=True)
    return cached((catalog.number, pattern, text, sample_size), lambda: _resolved(spark, catalog.find(pattern), query, sample_size))


def cached(key: tuple, make: Callable[[], Resolved]) -> Resolved:
    with _lock:
        if key in _cache:
            return _cache[key]
    made = make()
    with _lock:
        return _cache.setdefault(key, made)


def _resolved(spark: SparkSession, indices: list[Index], query, sample_size: int) -> Resolved:
    COUNTS["mapping"] += 1
    each = {i.name: i.resolved() for i in indices}
    merged = merge(each)
    # typed columns tell by themselves which are lists
    typed = frozenset(f.name for i in indices if i.typed for f in i.load(spark).schema if isinstance(f.dataType, T.ArrayType))
    if sample_size > 0:
        COUNTS["sample"] += 1
        paths: frozenset[str] = frozenset()
        for i in indices:
            if not i.typed:
                rows = i.load(spark)
                if query is not None:
                    rows = _matching(rows, each[i.name], query)
                paths |= array_paths(rows.limit(sample_size), each[i.name])
        typed |= paths
    return merged.with_arrays(typed) if typed else merged


def _matching(rows: DataFrame, r: Resolved, query) -> DataFrame:
    """The rows (_id, _source) that a query matches. Any field may hold a list, whatever the sample showed."""
    text = query if isinstance(query, str) else json.dumps(query)
    names = [n for n, _ in r.columns if f'"{n}"' in text or f'"{n}.' in text]
    wide = r.with_arrays(frozenset(r.kinds))
    return decode(rows, wide, ["_id", "_source", *names]).where(compile_query(query, wide)).select("_id", "_source")


def read_index(spark: SparkSession, index: Index, r: Resolved, columns: list[str], query=None) -> DataFrame:
    """The wanted columns of the matching documents under the merged schema; a field that this index lacks is null."""
    rows = index.load(spark)
    if not index.typed:
        return decode(rows if query is None else _matching(rows, r, query), r, columns)
    if query is not None:
        own = index.resolved()
        rows = rows.where(compile_query(query, own.with_arrays(frozenset(n for n, t in r.columns if isinstance(t, T.ArrayType) and n in own.kinds))))
    kinds = {"_id": T.StringType(), "_unmapped_": T.VariantType()} | dict(r.columns)
    return rows.select(*[F.col(c).cast(kinds[c]).alias(c) if c in rows.columns and not isinstance(kinds[c], T.VariantType) else F.col(c).alias(c) if c in rows.columns else F.lit(None).cast(kinds[c]).alias(c) for c in columns])
