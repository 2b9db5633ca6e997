"""Search as a SQL table function: ``SELECT * FROM docsearch(index => 'docs', host => 'h')``.

A convenience without pushdown: every call fetches the mapping when it is analysed, and reads all documents of the index
that the query matches in one task. ``search_remote`` and views over it push predicates, fields and limits down.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from dataclasses import dataclass
from datetime import UTC, datetime, timedelta
from typing import Any

from pyspark.sql import SparkSession
from pyspark.sql import types as T
from pyspark.sql.functions import udtf
from pyspark.sql.udtf import AnalyzeArgument, AnalyzeResult

from ..functions import geometry as geo
from ..functions.mapping import GEO, Resolved
from ..settings import DEFAULTS
from .remote import Client

#: Bits of whole numbers.
_BITS = {T.ByteType: 8, T.ShortType: 16, T.IntegerType: 32, T.LongType: 64}
_DEFAULT = {"host": "localhost", "port": 9200, "query": None, "username": None, "password": None, "use_ssl": False, "sample_size": DEFAULTS["sample_size"][1]}


def plain(x: Any, kind: T.DataType, path: str, r: Resolved) -> Any:
    """A JSON value as a value of the type, or None: the same leniency as in ``decode``."""
    number = isinstance(x, (int, float)) and not isinstance(x, bool)
    if x is None:
        return None
    if isinstance(kind, T.ArrayType):
        return [plain(y, kind.elementType, path, r) for y in (x if isinstance(x, list) else [x])]
    if r.kinds.get(path) in GEO:
        try:
            return geo.to_wkb((geo.point_value if r.kinds[path] == "geo_point" else geo.shape_value)(x))
        except (ValueError, KeyError, TypeError, IndexError):
            return None
    match kind:
        case T.StructType():
            return tuple(plain(x.get(f.name), f.dataType, f"{path}.{f.name}", r) for f in kind) if isinstance(x, dict) else None
        case T.StringType():
            return x if isinstance(x, str) else json.dumps(x)
        case T.ByteType() | T.ShortType() | T.IntegerType() | T.LongType():
            return x if number and isinstance(x, int) and -(1 << _BITS[type(kind)] - 1) <= x < 1 << _BITS[type(kind)] - 1 else None
        case T.DoubleType() | T.FloatType():
            return float(x) if number else None
        case T.BooleanType():
            return x if isinstance(x, bool) else None
        case T.TimestampNTZType():
            try:
                if isinstance(x, str):
                    at = datetime.fromisoformat(x)
                    return at.astimezone(UTC).replace(tzinfo=None) if at.tzinfo else at
                unit = "seconds" if "epoch_second" in r.formats.get(path, "") else "milliseconds"
                return datetime(1970, 1, 1) + timedelta(**{unit: x}) if number and isinstance(x, int) else None
            except (ValueError, OverflowError):
                return None
    return None


def unmapped(x: dict, paths: frozenset[str], above: str = "") -> dict:
    """What the mapping does not name of an object."""
    out = {}
    for name, value in x.items():
        path = above + name
        if path not in paths:
            out[name] = value
        elif isinstance(value, dict) and any(p.startswith(path + ".") for p in paths) and (inner := unmapped(value, paths, path + ".")):
            out[name] = inner
    return out


def lists(hits: list[dict], r: Resolved) -> frozenset[str]:
    """Mapped paths that hold a list in a sample."""
    found: set[str] = set()

    def look(x: Any, path: str) -> None:
        if isinstance(x, list):
            found.add(path)
        for y in x if isinstance(x, list) else [x]:
            if isinstance(y, dict):
                for name, value in y.items():
                    look(value, f"{path}.{name}" if path else name)

    for hit in hits:
        look(hit.get("_source", {}), "")
    return frozenset(p for p in found if p in r.kinds and not r.is_geo(p))


@dataclass
class Found(AnalyzeResult):
    resolved: Resolved | None = None


class TableFunction:
    """index, and by name host, port, query (JSON), username, password, use_ssl, sample_size."""

    def __init__(self, found: Found):
        self.r = found.resolved

    @staticmethod
    def analyze(index: AnalyzeArgument, **more: AnalyzeArgument) -> Found:
        given = _DEFAULT | {k: v.value for k, v in more.items()}
        if unknown := set(given) - set(_DEFAULT):
            raise ValueError(f"unknown arguments: {sorted(unknown)}")
        if not index.value:
            raise ValueError("search requires 'index' parameter")
        client = _client(given)
        r = client.mapping(index.value)
        if given["sample_size"] > 0:
            query = json.loads(given["query"]) if given["query"] else {"match_all": {}}
            r = r.with_arrays(lists(client.sample(index.value, given["sample_size"], query), r))
        client.close()
        columns = [T.StructField("_id", T.StringType()), *(T.StructField(n, t) for n, t in r.columns), T.StructField("_unmapped_", T.StringType())]
        return Found(schema=T.StructType(columns), resolved=r)

    def eval(self, index: str, **more: Any) -> Iterator[tuple]:
        given = _DEFAULT | more
        body = {"query": json.loads(given["query"]) if given["query"] else {"match_all": {}}}
        paths = frozenset(self.r.kinds)
        for hit in _client(given).scroll(index, body, DEFAULTS["batch_size"][1], DEFAULTS["scroll_time"][1]):
            source = hit.get("_source", {})
            rest = unmapped(source, paths)
            yield (hit["_id"], *(plain(source.get(n), t, n, self.r) for n, t in self.r.columns), json.dumps(rest) if rest else None)


def _client(given: dict) -> Client:
    return Client(given["host"], given["port"], given["use_ssl"], username=given["username"], password=given["password"])


def register_table_function(spark: SparkSession, name: str = "docsearch") -> None:
    spark.udtf.register(name, udtf(TableFunction))
