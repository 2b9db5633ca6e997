"""SQL predicates over an index: as columns with SQL semantics, as query clauses, and how they would be pushed down.

PUSHED predicates go into the store's query, FILTER ones are evaluated here, ERROR ones are refused. ``explain_dsl``
prints the request a remote store would get.
"""

from __future__ import annotations

import json
import re
from collections.abc import Sequence
from dataclasses import dataclass
from datetime import date, datetime
from enum import Enum
from typing import Any

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..functions import geometry as geo
from ..functions.mapping import Resolved


class Fate(str, Enum):
    PUSHED = "PUSHED"
    FILTER = "FILTER"


class GeoRangeError(ValueError):
    """Geometries have no order."""


class Predicate:
    def __and__(self, other: Predicate) -> And:
        return And((self, other))

    def __or__(self, other: Predicate) -> Or:
        return Or((self, other))

    def column(self, r: Resolved) -> Column:
        raise NotImplementedError

    def fate(self, r: Resolved) -> Fate:
        raise NotImplementedError

    def clause(self, r: Resolved) -> dict:
        raise NotImplementedError


_STEP = re.compile(r"([^.\[\]]+)|\[(\d+)\]")


def root(path: str) -> str:
    """The column that a path begins with."""
    return re.split(r"[.\[]", path, maxsplit=1)[0]


def pushes(path: str) -> bool:
    """Elements of lists and what the mapping does not name have no field in the store."""
    return "[" not in path and root(path) != "_unmapped_"


def value_at(path: str, like: Any = None) -> Column:
    """The value of a path: struct fields, elements of lists counted from 1 (null beyond the end), and below
    ``_unmapped_`` what the document holds, as a value of the kind of ``like`` (a variant for None)."""
    if pushes(path):
        return F.col(path)
    steps = _STEP.findall(path)
    if steps[0][0] == "_unmapped_":
        if len(steps) == 1:
            return F.col("_unmapped_")
        place = "$" + "".join(f"[{int(i) - 1}]" if i else "['" + n.replace("\\", "\\\\").replace("'", "\\'") + "']" for n, i in steps[1:])
        kind = "variant" if like is None else "boolean" if isinstance(like, bool) else "decimal(38,10)" if isinstance(like, int) else "double" if isinstance(like, float) else "timestamp_ntz" if isinstance(like, (date, datetime)) else "string"
        return F.try_variant_get(F.col("_unmapped_"), place, kind)
    out = F.col(f"`{steps[0][0]}`")
    for name, i in steps[1:]:
        out = F.try_element_at(out, F.lit(int(i))) if i else out[name]
    return out


def _json(value: Any) -> Any:
    if isinstance(value, datetime):
        return value.isoformat(timespec="microseconds" if value.microsecond else "seconds")
    return value.isoformat() if isinstance(value, date) else value


def _value_fate(r: Resolved, path: str) -> Fate:
    inexact = r.is_text(path) and path not in r.exact
    return Fate.FILTER if inexact or r.is_geo(path) or not pushes(path) else Fate.PUSHED


@dataclass(frozen=True)
class Compare(Predicate):
    path: str
    op: str  # = != > >= < <=
    value: Any

    def check(self, r: Resolved) -> None:
        if self.op not in ("=", "!=") and r.is_geo(self.path):
            raise GeoRangeError(f"Range comparisons (<, >, <=, >=) are not supported on geo field '{self.path}'.")

    def column(self, r: Resolved) -> Column:
        self.check(r)
        value = self.value
        if r.is_geo(self.path) and not isinstance(value, (bytes, bytearray)):
            value = geo.to_wkb(value)
        name = {"=": "__eq__", "!=": "__ne__", ">": "__gt__", ">=": "__ge__", "<": "__lt__", "<=": "__le__"}[self.op]
        lit = F.lit(value).cast("timestamp_ntz") if isinstance(value, (date, datetime)) or r.kinds.get(self.path) == "date" else F.lit(value)
        return getattr(value_at(self.path, value), name)(lit)

    def fate(self, r: Resolved) -> Fate:
        self.check(r)
        return Fate.FILTER if self.value is None else _value_fate(r, self.path)

    def clause(self, r: Resolved) -> dict:
        f, v = r.remote_name(self.path), _json(self.value)
        if self.op == "=":
            return {"term": {f: v}}
        if self.op == "!=":
            return {"bool": {"must_not": {"term": {f: v}}}}
        return {"range": {f: {{">": "gt", ">=": "gte", "<": "lt", "<=": "lte"}[self.op]: v}}}


@dataclass(frozen=True)
class In(Predicate):
    path: str
    values: tuple

    def column(self, r: Resolved) -> Column:
        known = [v for v in self.values if v is not None]
        return value_at(self.path, known[0] if known else "").isin(*[geo.to_wkb(v) if r.is_geo(self.path) and isinstance(v, dict) else v for v in self.values])

    def fate(self, r: Resolved) -> Fate:
        return Fate.FILTER if any(v is None for v in self.values) else _value_fate(r, self.path)

    def clause(self, r: Resolved) -> dict:
        return {"terms": {r.remote_name(self.path): [_json(v) for v in self.values]}}


@dataclass(frozen=True)
class Null(Predicate):
    path: str
    isnull: bool = True

    def column(self, r: Resolved) -> Column:
        if self.path == "_id":
            return F.lit(not self.isnull)
        value = value_at(self.path)
        gone = value.isNull()
        if root(self.path) == "_unmapped_" and self.path != "_unmapped_":
            gone = gone | F.is_variant_null(value)
        return gone if self.isnull else ~gone

    def fate(self, r: Resolved) -> Fate:
        return Fate.PUSHED if pushes(self.path) else Fate.FILTER

    def clause(self, r: Resolved) -> dict:
        have = {"exists": {"field": self.path}}
        return {"bool": {"must_not": have}} if self.isnull else have


@dataclass(frozen=True)
class Like(Predicate):
    """LIKE and ILIKE; % and _ are signs of the pattern, and ``escape`` makes the next sign plain."""

    path: str
    pattern: str
    ignore_case: bool = False
    escape: str | None = None

    def signs(self) -> list[tuple[str, bool]]:
        out, i = [], 0
        while i < len(self.pattern):
            c = self.pattern[i]
            if self.escape and c == self.escape and i + 1 < len(self.pattern):
                i += 1
                out.append((self.pattern[i], False))
            else:
                out.append((c, c in "%_"))
            i += 1
        return out

    def column(self, r: Resolved) -> Column:
        signs = self.signs()
        wild = [i for i, (_, special) in enumerate(signs) if special]
        plain = "".join(c for c, special in signs if not special)
        c = value_at(self.path, "")
        if not self.ignore_case and all(signs[i][0] == "%" for i in wild):
            n = len(signs) - 1
            shape = tuple(wild)
            if not wild:
                return c == plain
            if shape == (n,):
                return c.startswith(plain)
            if shape == (0,):
                return c.endswith(plain)
            if shape == (0, n):
                return c.contains(plain)
        body = "".join((".*" if x == "%" else ".") if special else re.escape(x) for x, special in signs)
        return c.rlike(("(?is)" if self.ignore_case else "(?s)") + "^" + body + "$")

    def fate(self, r: Resolved) -> Fate:
        return _value_fate(r, self.path)

    def clause(self, r: Resolved) -> dict:
        f, signs = r.remote_name(self.path), self.signs()
        wild = [i for i, (_, special) in enumerate(signs) if special]
        more = {"case_insensitive": True} if self.ignore_case else {}
        if not wild:
            plain = "".join(c for c, _ in signs)
            return {"term": {f: {"value": plain, **more}}} if more else {"term": {f: plain}}
        if wild == [len(signs) - 1] and signs[-1][0] == "%":
            return {"prefix": {f: {"value": "".join(c for c, _ in signs[:-1]), **more}}}
        value = "".join(("*" if c == "%" else "?") if special else "\\" + c if c in "*?\\" else c for c, special in signs)
        return {"wildcard": {f: {"value": value, **more}}}


def _plain(text: str) -> str:
    return re.sub(r"([%_\\])", r"\\\1", text)


def starts_with(path: str, text: str) -> Like:
    return Like(path, _plain(text) + "%", escape="\\")


def ends_with(path: str, text: str) -> Like:
    return Like(path, "%" + _plain(text), escape="\\")


def contains(path: str, text: str) -> Like:
    return Like(path, "%" + _plain(text) + "%", escape="\\")


def flipped(value: Any, op: str, path: str) -> Compare:
    """value op path."""
    return Compare(path, {"<": ">", "<=": ">=", ">": "<", ">=": "<="}.get(op, op), value)


def plus(path: str, n: int, op: str, value: int) -> Compare:
    """path + n op value for whole numbers, as a comparison of the path alone, which can be pushed."""
    return Compare(path, op, value - n)


def between(path: str, low: Any, high: Any) -> And:
    return And((Compare(path, ">=", low), Compare(path, "<=", high)))


@dataclass(frozen=True)
class And(Predicate):
    parts: tuple[Predicate, ...]

    def flat(self) -> list[Predicate]:
        return [q for p in self.parts for q in (p.flat() if isinstance(p, And) else [p])]

    def column(self, r: Resolved) -> Column:
        out = F.lit(True)
        for p in self.flat():
            out = out & p.column(r)
        return out

    def fate(self, r: Resolved) -> Fate:
        fates = [p.fate(r) for p in self.flat()]
        return Fate.PUSHED if all(f is Fate.PUSHED for f in fates) else Fate.FILTER

    def clause(self, r: Resolved) -> dict:
        parts = [p.clause(r) for p in self.flat()]
        return parts[0] if len(parts) == 1 else {"bool": {"must": parts}}


@dataclass(frozen=True)
class Or(Predicate):
    parts: tuple[Predicate, ...]

    def column(self, r: Resolved) -> Column:
        out = F.lit(False)
        for p in self.parts:
            out = out | p.column(r)
        return out

    def fate(self, r: Resolved) -> Fate:
        for p in self.parts:
            p.fate(r)
        return Fate.FILTER

    def clause(self, r: Resolved) -> dict:
        return {"bool": {"should": [p.clause(r) for p in self.parts], "minimum_should_match": 1}}


@dataclass(frozen=True)
class Expression(Predicate):
    """Any SQL condition, of several columns, volatile or not; paths are those that it reads. Never pushed."""

    sql: str
    paths: tuple[str, ...] = ()

    def column(self, r: Resolved) -> Column:
        return F.expr(self.sql)

    def fate(self, r: Resolved) -> Fate:
        return Fate.FILTER

    def clause(self, r: Resolved) -> dict:
        raise ValueError("an expression has no clause")


@dataclass(frozen=True)
class Spatial(Predicate):
    """within: the field in the shape; contains: the shape in the field; intersects; disjoint."""

    path: str
    relation: str
    shape: dict

    def column(self, r: Resolved) -> Column:
        return geo.relation(value_at(self.path), self.relation, self.shape)

    def fate(self, r: Resolved) -> Fate:
        return Fate.PUSHED if r.is_geo(self.path) else Fate.FILTER

    def clause(self, r: Resolved) -> dict:
        box = geo.rectangle(self.shape)
        if box and self.relation == "within":
            x0, y0, x1, y1 = box
            return {"geo_bounding_box": {self.path: {"top_left": {"lat": y1, "lon": x0}, "bottom_right": {"lat": y0, "lon": x1}}}}
        return {"geo_shape": {self.path: {"shape": self.shape, "relation": self.relation}}}


@dataclass(frozen=True)
class Distance(Predicate):
    """Metres from a field to a point, compared; a missing field never matches."""

    path: str
    lon: float
    lat: float
    op: str
    metres: float

    def column(self, r: Resolved) -> Column:
        d = geo.metres(value_at(self.path), self.lon, self.lat)
        return getattr(d, {"<": "__lt__", "<=": "__le__", ">": "__gt__", ">=": "__ge__", "=": "__eq__", "!=": "__ne__"}[self.op])(F.lit(float(self.metres)))

    def fate(self, r: Resolved) -> Fate:
        return Fate.PUSHED if r.is_geo(self.path) and self.op in ("<", "<=", ">", ">=") and self.metres >= 0 else Fate.FILTER

    def clause(self, r: Resolved) -> dict:
        near = {"geo_distance": {"distance": f"{self.metres}m", self.path: {"lat": self.lat, "lon": self.lon}}}
        return near if self.op in ("<", "<=") else {"bool": {"must_not": [near]}}


def leaves(p: Predicate) -> list[Predicate]:
    return [x for q in p.parts for x in leaves(q)] if isinstance(p, (And, Or)) else [p]


def columns_of(predicates: Sequence[Predicate]) -> set[str]:
    """The columns that predicates read."""
    return {root(path) for p in predicates for x in leaves(p) for path in (x.paths if isinstance(x, Expression) else (x.path,))}


def exact(p: Predicate, r: Resolved) -> bool:
    """Whether the store's answer to a pushed predicate is SQL's: a negated clause also matches where the field is missing,
    and one on geometries also at the border."""
    plain = not any(isinstance(x, (Spatial, Distance)) for x in leaves(p))
    return plain and p.fate(r) is Fate.PUSHED and "must_not" not in json.dumps(p.clause(r))


def split(predicates: list[Predicate], r: Resolved) -> tuple[list[Predicate], list[Predicate]]:
    """The pushed ones and the others; raises for those that are refused."""
    flat = And(tuple(predicates)).flat() if predicates else []
    fates = [(p, p.fate(r)) for p in flat]
    return [p for p, f in fates if f is Fate.PUSHED], [p for p, f in fates if f is not Fate.PUSHED]


def explain_dsl(r: Resolved, predicates: list[Predicate] = (), query: dict | None = None, columns: list[str] | None = None) -> dict:
    """The request body: the base query and the pushed predicates (of one column together), and the fields to fetch."""
    pushed, _ = split(list(predicates), r)
    by: dict[str, list[dict]] = {}
    for p in pushed:
        if not (isinstance(p, Null) and p.path == "_id"):
            by.setdefault(p.path, []).append(p.clause(r))
    parts = ([query] if query else []) + [x[0] if len(x) == 1 else {"bool": {"must": x}} for x in by.values()]
    body: dict = {"query": {"match_all": {}} if not parts else parts[0] if len(parts) == 1 else {"bool": {"must": parts}}}
    fields = [c for c in columns or [] if c != "_id"]
    if fields and "_unmapped_" not in fields:
        body["_source"] = list(dict.fromkeys(c.split(".")[0] for c in fields))
    return body
