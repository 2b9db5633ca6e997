"""Query clauses as columns. A leaf holds for an array if it holds for any element; a field that is not mapped never matches."""

from __future__ import annotations

import calendar
import json
import re
from collections.abc import Callable
from datetime import UTC, datetime, timedelta

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import geometry as geo
from ..functions.analysis import analyze, has_any, phrase, tokens
from ..functions.mapping import Resolved


class BadQuery(ValueError):
    """A query that is no known clause."""


def _each(c: Column, kind: T.DataType, test: Callable[[Column, T.DataType], Column]) -> Column:
    if isinstance(kind, T.ArrayType):
        return F.exists(c, lambda x: _each(x, kind.elementType, test))
    return test(c, kind)


def _walk(at: Column | None, kind: T.DataType, names: list[str], test) -> Column:
    """Goes down a path; every array on it is any-of."""
    if isinstance(kind, T.ArrayType):
        return F.exists(at, lambda x: _walk(x, kind.elementType, names, test))
    if not names:
        return test(at, kind)
    if not isinstance(kind, T.StructType) or names[0] not in kind.fieldNames():
        return F.lit(False)
    return _walk(F.col(f"`{names[0]}`") if at is None else at[names[0]], kind[names[0]].dataType, names[1:], test)


def _literal(value, kind: T.DataType) -> Column:
    if isinstance(kind, T.TimestampNTZType):
        if isinstance(value, (int, float)) and not isinstance(value, bool):
            return F.timestamp_millis(F.lit(int(value))).cast("timestamp_ntz")
        return F.lit(moment(value)).cast("timestamp_ntz")
    if isinstance(kind, T.StringType):
        return F.lit(json.dumps(value) if isinstance(value, (bool, dict, list)) else str(value))
    return F.lit(value)


#: Units of date arithmetic.
_MOMENT = {"y": "years", "M": "months", "w": "weeks", "d": "days", "h": "hours", "H": "hours", "m": "minutes", "s": "seconds"}


def _moved(at: datetime, n: int, unit: str) -> datetime:
    name = _MOMENT[unit]
    if name in ("years", "months"):
        month = at.month - 1 + n * (12 if name == "years" else 1)
        year, month = at.year + month // 12, month % 12 + 1
        return at.replace(year=year, month=month, day=min(at.day, calendar.monthrange(year, month)[1]))
    return at + timedelta(**{name: n})


def _floor(at: datetime, unit: str) -> datetime:
    name = _MOMENT[unit]
    at = at.replace(microsecond=0)
    if name == "weeks":
        return (at - timedelta(days=at.weekday())).replace(hour=0, minute=0, second=0)
    for field, least, units in (("second", 0, "yMdhHm"), ("minute", 0, "yMdhH"), ("hour", 0, "yMd"), ("day", 1, "yM"), ("month", 1, "y")):
        if unit in units:
            at = at.replace(**{field: least})
    return at


def moment(value, up: bool = False) -> str:
    """A date, or date arithmetic (``now-1d/d``, ``2024-01-15||+1M/M``), in UTC as text; up: a rounded one is its unit's last millisecond."""
    if isinstance(value, datetime):
        return (value.astimezone(UTC).replace(tzinfo=None) if value.tzinfo else value).isoformat()
    text = str(value).strip()
    base, _, steps = ("now", "", text[3:]) if text.startswith("now") else text.partition("||")
    try:
        at = datetime.now(UTC) if base == "now" else datetime.fromisoformat(base + "-01" * {4: 2, 7: 1}.get(len(base), 0))
        at = at.astimezone(UTC).replace(tzinfo=None) if at.tzinfo else at
    except ValueError:
        if re.fullmatch(r"-?[0-9]+", base):
            at = datetime(1970, 1, 1) + timedelta(milliseconds=int(base))
        else:
            raise BadQuery(f"not a date: {value!r}") from None
    if not re.fullmatch(r"(?:[+-][0-9]*[yMwdhHms]|/[yMwdhHms])*", steps):
        raise BadQuery(f"not a date: {value!r}")
    for sign, n, unit in re.findall(r"([+-/])([0-9]*)([yMwdhHms])", steps):
        if sign == "/":
            at = _floor(at, unit)
            at = _moved(at, 1, unit) - timedelta(milliseconds=1) if up else at
        else:
            at = _moved(at, int(sign + (n or "1")), unit)
    return at.isoformat()


class Compiler:
    """Compiles clauses against a resolved schema; ``root`` holds other elements inside nested clauses."""

    def __init__(self, schema: Resolved, root: tuple[str, Column, T.DataType] | None = None):
        self.schema, self.root = schema, root

    def field(self, name: str, test: Callable[[Column, T.DataType, str], Column]) -> Column:
        path = name
        exact = False
        if path.endswith(".keyword") and path[:-8] in self.schema.kinds:
            path, exact = path[:-8], True
            if self.schema.is_text(path) and path not in self.schema.exact:
                return F.lit(False)
        kind = "keyword" if exact else self.schema.kinds.get(path, "keyword")
        go = lambda c, t: test(c, t, kind)
        if path == "_id" and self.root is None:
            return go(F.col("_id"), T.StringType())
        if self.root is not None:
            above, at, t = self.root
            if not path.startswith(above + "."):
                return F.lit(False)
            return _walk(at, t, path[len(above) + 1 :].split("."), go)
        whole = T.StructType([T.StructField(n, t) for n, t in self.schema.columns])
        return _walk(None, whole, path.split("."), go)

    def compile(self, query: dict | str) -> Column:
        if isinstance(query, str):
            try:
                query = json.loads(query)
            except ValueError as e:
                raise BadQuery(f"the query is not JSON: {e}") from e
        if not isinstance(query, dict) or len(query) != 1:
            raise BadQuery("a clause is an object with one key")
        (name, body), = query.items()
        f = getattr(self, f"_{name}", None)
        if f is None or name.startswith("_"):
            raise BadQuery(f"unknown clause {name!r}")
        return f(body)

    @staticmethod
    def _one(body: dict, inner: str) -> tuple[str, object, dict]:
        rest = {k: v for k, v in body.items() if k not in ("boost", "_name")}
        if len(rest) != 1:
            raise BadQuery("one field is needed")
        (field, value), = rest.items()
        return (field, value.get(inner), value) if isinstance(value, dict) else (field, value, {})

    def _match_all(self, body) -> Column:
        return F.lit(True)

    def _match_none(self, body) -> Column:
        return F.lit(False)

    def _ids(self, body) -> Column:
        return F.col("_id").isin([str(x) for x in body["values"]])

    def _term(self, body) -> Column:
        field, value, more = self._one(body, "value")
        ci = bool(more.get("case_insensitive"))

        def test(c, t, kind):
            if kind == "text":
                word = str(value).lower() if ci else str(value)
                return has_any(c, [word]) if analyze(word) == [word] else F.lit(False)
            return F.lower(c) == str(value).lower() if ci else c == _literal(value, t)

        return self.field(field, test)

    def _terms(self, body) -> Column:
        rest = {k: v for k, v in body.items() if k != "boost"}
        (field, values), = rest.items()
        if not values:
            return F.lit(False)
        return self.field(field, lambda c, t, kind: has_any(c, [str(v) for v in values if analyze(str(v)) == [str(v)]]) if kind == "text" else c.isin(*[_literal(v, t) for v in values]))

    def _range(self, body) -> Column:
        (field, limits), = body.items()
        ops = {"gt": "__gt__", "gte": "__ge__", "lt": "__lt__", "lte": "__le__"}

        def test(c, t, kind):
            out = F.lit(True)
            for k, v in limits.items():
                if k in ops and v is not None:
                    if isinstance(t, T.TimestampNTZType) and isinstance(v, str):
                        v = datetime.fromisoformat(moment(v, k in ("gt", "lte")))
                    out = out & getattr(c, ops[k])(_literal(v, t))
            return out

        return self.field(field, test)

    def _exists(self, body) -> Column:
        return self.field(body["field"], lambda c, t, kind: c.isNotNull())

    def _prefix(self, body) -> Column:
        field, value, more = self._one(body, "value")
        ci = bool(more.get("case_insensitive"))

        def test(c, t, kind):
            one = lambda x: F.startswith(F.lower(x) if ci else x, F.lit(value.lower() if ci else value))
            return F.exists(tokens(c), one) if kind == "text" else one(c)

        return self.field(field, test)

    def _wildcard(self, body) -> Column:
        field, value, more = self._one(body, "value")
        pattern = ("(?is)" if more.get("case_insensitive") else "(?s)") + wildcard_regex(more.get("wildcard", value))
        return self.field(field, lambda c, t, kind: F.exists(tokens(c), lambda x: x.rlike(pattern)) if kind == "text" else c.rlike(pattern))

    def _regexp(self, body) -> Column:
        field, value, more = self._one(body, "value")
        pattern = ("(?is)" if more.get("case_insensitive") else "(?s)") + f"^(?:{value})$"
        return self.field(field, lambda c, t, kind: F.exists(tokens(c), lambda x: x.rlike(pattern)) if kind == "text" else c.rlike(pattern))

    def _bool(self, body) -> Column:
        listed = lambda k: [self.compile(q) for q in (body.get(k, []) if isinstance(body.get(k, []), list) else [body[k]])]
        out = F.lit(True)
        for c in listed("must") + listed("filter"):
            out = out & F.coalesce(c, F.lit(False))
        for c in listed("must_not"):
            out = out & ~F.coalesce(c, F.lit(False))
        should = listed("should")
        if should:
            least = body.get("minimum_should_match", 0 if "must" in body or "filter" in body else 1)
            total = sum((F.coalesce(c, F.lit(False)).cast("int") for c in should), F.lit(0))
            out = out & (total >= _least(least, len(should)))
        return out

    def _constant_score(self, body) -> Column:
        return self.compile(body["filter"])

    def _match(self, body) -> Column:
        field, value, more = self._one(body, "query")
        words = analyze(str(value))
        every = str(more.get("operator", "or")).lower() == "and"
        least = more.get("minimum_should_match")

        def test(c, t, kind):
            if kind != "text":
                return c == _literal(value, t)
            if not words:
                return F.lit(False)
            if every or least is not None:
                different = list(dict.fromkeys(words))
                need = len(different) if every else _least(least, len(different))
                return sum((has_any(c, [w]).cast("int") for w in different), F.lit(0)) >= need
            return has_any(c, words)

        return self.field(field, test)

    def _multi_match(self, body) -> Column:
        out = F.lit(False)
        for name in body["fields"]:
            out = out | F.coalesce(self._match({name.split("^")[0]: {"query": body["query"], "operator": body.get("operator", "or")}}), F.lit(False))
        return out

    def _match_phrase(self, body) -> Column:
        field, value, _ = self._one(body, "query")
        return self.field(field, lambda c, t, kind: phrase(c, analyze(str(value))) if kind == "text" else c == _literal(value, t))

    def _match_phrase_prefix(self, body) -> Column:
        field, value, _ = self._one(body, "query")
        return self.field(field, lambda c, t, kind: phrase(c, analyze(str(value)), True) if kind == "text" else F.startswith(c, F.lit(str(value))))

    def _nested(self, body) -> Column:
        path, query = body["path"], body["query"]
        return self.field(path, lambda c, t, kind: F.coalesce(Compiler(self.schema, (path, c, t)).compile(query), F.lit(False)))

    def _geo_shape(self, body) -> Column:
        (field, spec), = ((k, v) for k, v in body.items() if k != "ignore_unmapped")
        shape = spec["shape"]
        if isinstance(shape, dict) and str(shape.get("type")).lower() == "envelope":
            (x0, y1), (x1, y0) = shape["coordinates"]
            shape = geo.envelope(x0, y0, x1, y1)
        shape = geo.shape_value(shape)
        return self.field(field, lambda c, t, kind: geo.relation(c, spec.get("relation", "intersects").lower(), shape))

    def _geo_distance(self, body) -> Column:
        rest = {k: v for k, v in body.items() if k not in ("distance", "distance_type", "validation_method")}
        (field, at), = rest.items()
        lon, lat = geo.point_value(at)["coordinates"]
        return self.field(field, lambda c, t, kind: geo.metres(c, lon, lat) <= metres_of(body["distance"]))

    def _geo_bounding_box(self, body) -> Column:
        (field, box), = ((k, v) for k, v in body.items() if k != "validation_method")
        x0, y1 = geo.point_value(box["top_left"])["coordinates"]
        x1, y0 = geo.point_value(box["bottom_right"])["coordinates"]
        boxes = [(x0, x1)] if x0 <= x1 else [(x0, 180.0), (-180.0, x1)]
        inside = lambda c: sum((geo.relation(c, "intersects", geo.envelope(a, y0, b, y1)).cast("int") for a, b in boxes), F.lit(0)) > 0
        return self.field(field, lambda c, t, kind: inside(c))


def _least(value, n: int) -> int:
    if isinstance(value, str) and value.endswith("%"):
        share = int(value[:-1])
        return n * share // 100 if share >= 0 else n - n * -share // 100
    k = int(value)
    return k if k >= 0 else n + k


#: Metres in a unit.
_UNITS = {"m": 1.0, "meters": 1.0, "km": 1000.0, "kilometers": 1000.0, "cm": 0.01, "mm": 0.001, "mi": 1609.344, "miles": 1609.344, "yd": 0.9144, "ft": 0.3048, "in": 0.0254, "nmi": 1852.0, "NM": 1852.0}


def metres_of(distance) -> float:
    m = re.fullmatch(r"\s*([0-9.eE+-]+?)\s*([A-Za-z]*)\s*", str(distance))
    if not m or (m[2] or "m") not in _UNITS:
        raise BadQuery(f"not a distance: {distance!r}")
    return float(m[1]) * _UNITS[m[2] or "m"]


def wildcard_regex(value: str) -> str:
    out, i = [], 0
    while i < len(value):
        c = value[i]
        if c == "\\" and i + 1 < len(value):
            i += 1
            out.append(re.escape(value[i]))
        else:
            out.append(".*" if c == "*" else "." if c == "?" else re.escape(c))
        i += 1
    return "^" + "".join(out) + "$"


def compile_query(query: dict | str, schema: Resolved) -> Column:
    return F.coalesce(Compiler(schema).compile(query), F.lit(False))
