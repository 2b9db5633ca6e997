"""A small geometry kernel: WKB, WKT, GeoJSON, planar relations, metres on a sphere; and columns of it.

Geometries are dicts as in GeoJSON; columns hold little-endian two-dimensional WKB.
"""

from __future__ import annotations

import json
import math
import re
import struct
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

EARTH_M = 6371008.7714
KINDS = ("Point", "LineString", "Polygon", "MultiPoint", "MultiLineString", "MultiPolygon", "GeometryCollection")
#: Depth of a kind's coordinates.
DEPTH = {"Point": 0, "LineString": 1, "MultiPoint": 1, "Polygon": 2, "MultiLineString": 2, "MultiPolygon": 3}


def _number(x) -> float:
    if isinstance(x, bool) or not isinstance(x, (int, float)):
        raise ValueError("not a number")
    return float(x)


def _clean(c, depth: int):
    if depth == 0:
        return [_number(c[0]), _number(c[1])]
    return [_clean(x, depth - 1) for x in c]


def from_geojson(x) -> dict:
    x = json.loads(x) if isinstance(x, (str, bytes)) else x
    kind = x["type"]
    if kind == "GeometryCollection":
        return {"type": kind, "geometries": [from_geojson(g) for g in x["geometries"]]}
    return {"type": kind, "coordinates": _clean(x["coordinates"], DEPTH[kind])}


def to_wkb(g: dict) -> bytes:
    head = struct.pack("<BI", 1, KINDS.index(g["type"]) + 1)
    if g["type"] == "GeometryCollection":
        return head + struct.pack("<I", len(g["geometries"])) + b"".join(map(to_wkb, g["geometries"]))
    c = g["coordinates"]
    line = lambda p: struct.pack("<I", len(p)) + b"".join(struct.pack("<dd", *x) for x in p)
    match g["type"]:
        case "Point":
            return head + struct.pack("<dd", *c)
        case "LineString":
            return head + line(c)
        case "Polygon":
            return head + struct.pack("<I", len(c)) + b"".join(map(line, c))
    part = g["type"].removeprefix("Multi")
    return head + struct.pack("<I", len(c)) + b"".join(to_wkb({"type": part, "coordinates": x}) for x in c)


def from_wkb(data: bytes) -> dict:
    at = 0

    def take(form: str):
        nonlocal at
        out = struct.unpack_from(form, data, at)
        at += struct.calcsize(form)
        return out

    def read() -> dict:
        order = "<" if take("<B")[0] else ">"
        kind = KINDS[take(order + "I")[0] - 1]
        count = lambda: take(order + "I")[0]
        point = lambda: list(take(order + "dd"))
        line = lambda: [point() for _ in range(count())]
        match kind:
            case "Point":
                return {"type": kind, "coordinates": point()}
            case "LineString":
                return {"type": kind, "coordinates": line()}
            case "Polygon":
                return {"type": kind, "coordinates": [line() for _ in range(count())]}
        parts = [read() for _ in range(count())]
        return {"type": kind, "geometries": parts} if kind == "GeometryCollection" else {"type": kind, "coordinates": [p["coordinates"] for p in parts]}

    return read()


def _show(x: float) -> str:
    return repr(int(x)) if x == int(x) and abs(x) < 1e15 else repr(x)


def to_wkt(g: dict) -> str:
    if g["type"] == "GeometryCollection":
        return "GEOMETRYCOLLECTION (" + ", ".join(map(to_wkt, g["geometries"])) + ")" if g["geometries"] else "GEOMETRYCOLLECTION EMPTY"

    def show(c, depth: int) -> str:
        return " ".join(map(_show, c)) if depth == 0 else "(" + ", ".join(show(x, depth - 1) for x in c) + ")"

    text = show(g["coordinates"], DEPTH[g["type"]])
    return f"{g['type'].upper()} " + (f"({text})" if g["type"] == "Point" else text)


_TOKEN = re.compile(r"\s*([A-Za-z]+|[-+]?[0-9.]+(?:[eE][-+]?[0-9]+)?|[(),])")


def from_wkt(text: str) -> dict:
    tokens, at = [], 0
    text = text.strip()
    while at < len(text):
        m = _TOKEN.match(text, at)
        if not m:
            raise ValueError(f"bad WKT at {at}")
        tokens.append(m[1])
        at = m.end()
    tokens.append("")
    names = {k.upper(): k for k in KINDS}
    i = 0

    def expect(t: str) -> None:
        nonlocal i
        if tokens[i] != t:
            raise ValueError(f"expected {t!r}")
        i += 1

    def listed(one):
        nonlocal i
        expect("(")
        out = [one()]
        while tokens[i] == ",":
            i += 1
            out.append(one())
        expect(")")
        return out

    def pair():
        nonlocal i
        out = []
        while tokens[i] not in ("(", ")", ",", ""):
            out.append(float(tokens[i]))
            i += 1
        if len(out) < 2:
            raise ValueError("a position needs two numbers")
        return out[:2]

    def body(depth: int):
        return listed(pair if depth == 1 else lambda: body(depth - 1))

    def geometry() -> dict:
        nonlocal i
        kind = names[tokens[i].upper()]
        i += 1
        if tokens[i].upper() in ("Z", "M", "ZM"):
            i += 1
        if tokens[i].upper() == "EMPTY":
            i += 1
            return {"type": kind, "geometries": []} if kind == "GeometryCollection" else {"type": kind, "coordinates": []}
        if kind == "GeometryCollection":
            return {"type": kind, "geometries": listed(geometry)}
        if kind == "Point":
            return {"type": kind, "coordinates": body(1)[0]}
        if kind == "MultiPoint":
            def one():
                return listed(pair)[0] if tokens[i] == "(" else pair()

            return {"type": kind, "coordinates": listed(one)}
        return {"type": kind, "coordinates": body(DEPTH[kind])}

    out = geometry()
    if tokens[i]:
        raise ValueError("text after the geometry")
    return out


def point(lon: float, lat: float) -> dict:
    return {"type": "Point", "coordinates": [float(lon), float(lat)]}


def envelope(xmin: float, ymin: float, xmax: float, ymax: float) -> dict:
    return from_geojson({"type": "Polygon", "coordinates": [[[xmin, ymin], [xmax, ymin], [xmax, ymax], [xmin, ymax], [xmin, ymin]]]})


def rectangle(g: dict) -> tuple[float, float, float, float] | None:
    """xmin, ymin, xmax, ymax of an axis-aligned rectangle of positive area."""
    if g["type"] != "Polygon" or len(g["coordinates"]) != 1 or len(g["coordinates"][0]) != 5 or g["coordinates"][0][0] != g["coordinates"][0][4]:
        return None
    ring = g["coordinates"][0]
    xs, ys = sorted({x for x, _ in ring}), sorted({y for _, y in ring})
    if len(xs) != 2 or len(ys) != 2 or len({tuple(p) for p in ring}) != 4 or any(a[0] != b[0] and a[1] != b[1] for a, b in zip(ring, ring[1:], strict=False)):
        return None
    return xs[0], ys[0], xs[1], ys[1]


def point_value(x) -> dict:
    """A geo_point from any of its five encodings: lat/lon object, GeoJSON, [lon, lat], WKT, "lat,lon"."""
    if isinstance(x, dict):
        return point(_number(x["lon"]), _number(x["lat"])) if "lat" in x else from_geojson(x)
    if isinstance(x, list):
        return point(_number(x[0]), _number(x[1]))
    if isinstance(x, str):
        if x.strip()[:5].upper() == "POINT":
            return from_wkt(x)
        lat, lon = x.split(",")
        return point(float(lon), float(lat))
    raise ValueError("not a geo_point")


def shape_value(x) -> dict:
    return from_wkt(x) if isinstance(x, str) else from_geojson(x)


def parts(g: dict) -> Iterator[tuple[str, list]]:
    """Points, lines and polygons."""
    kind = g["type"]
    if kind == "GeometryCollection":
        for x in g["geometries"]:
            yield from parts(x)
    elif kind.startswith("Multi"):
        for c in g["coordinates"]:
            yield kind.removeprefix("Multi"), c
    elif g["coordinates"]:
        yield kind, g["coordinates"]


def _cross(o, a, b) -> float:
    return (a[0] - o[0]) * (b[1] - o[1]) - (a[1] - o[1]) * (b[0] - o[0])


def _on(p, a, b) -> bool:
    return _cross(a, b, p) == 0 and min(a[0], b[0]) <= p[0] <= max(a[0], b[0]) and min(a[1], b[1]) <= p[1] <= max(a[1], b[1])


def _segments(line):
    return list(zip(line, line[1:], strict=False))


def _touch(s, t) -> bool:
    (a, b), (c, d) = s, t
    d1, d2, d3, d4 = _cross(c, d, a), _cross(c, d, b), _cross(a, b, c), _cross(a, b, d)
    return (d1 > 0) != (d2 > 0) and (d3 > 0) != (d4 > 0) and 0 not in (d1, d2, d3, d4) or _on(a, c, d) or _on(b, c, d) or _on(c, a, b) or _on(d, a, b)


def locate(p, rings) -> int:
    """1 inside the polygon, 0 on its edge, -1 outside."""
    inside = False
    for ring in rings:
        for a, b in _segments(ring):
            if _on(p, a, b):
                return 0
            if (a[1] > p[1]) != (b[1] > p[1]) and p[0] < (b[0] - a[0]) * (p[1] - a[1]) / (b[1] - a[1]) + a[0]:
                inside = not inside
    return 1 if inside else -1


def _lines(kind: str, c) -> list:
    return [] if kind == "Point" else _segments(c) if kind == "LineString" else [s for ring in c for s in _segments(ring)]


def _first(kind: str, c):
    return c if kind == "Point" else c[0] if kind == "LineString" else c[0][0]


def _meet(a, b) -> bool:
    (ka, ca), (kb, cb) = a, b
    if ka == "Polygon" and locate(_first(kb, cb), ca) >= 0 or kb == "Polygon" and locate(_first(ka, ca), cb) >= 0:
        return True
    sa, sb = _lines(ka, ca), _lines(kb, cb)
    if not sa and not sb:
        return ca == cb
    if not sa or not sb:
        p, segments = (ca, sb) if not sa else (cb, sa)
        return any(_on(p, *s) for s in segments)
    return any(_touch(s, t) for s in sa for t in sb)


def intersects(a: dict, b: dict) -> bool:
    return any(_meet(x, y) for x in parts(a) for y in parts(b))


def _inside(x, y) -> bool:
    """Part x within part y (its edge allowed, but not the edge alone)."""
    (kx, cx), (ky, cy) = x, y
    if ky == "Point":
        return kx == "Point" and cx == cy
    if ky == "LineString":
        points = [cx] if kx == "Point" else cx if kx == "LineString" else None
        return points is not None and all(any(_on(p, *s) for s in _segments(cy)) for p in points) and (kx != "Point" or cx not in (cy[0], cy[-1]) or cy[0] == cy[-1])
    if kx == "Point":
        return locate(cx, cy) > 0
    tests = [p for s in _lines(kx, cx) for t in ([0.0, 0.5] + _cuts(s, _lines(ky, cy))) for p in ([s[0][0] + t * (s[1][0] - s[0][0]), s[0][1] + t * (s[1][1] - s[0][1])],)]
    if any(locate(p, cy) < 0 for p in tests):
        return False
    if kx == "Polygon":
        return not any(locate(hole[0], cx) > 0 for hole in cy[1:])
    return any(locate(p, cy) > 0 for p in tests)


def _cuts(s, segments) -> list[float]:
    """Between its crossings with segments, the middles of a segment."""
    (a, b), ts = s, [0.0, 1.0]
    for c, d in segments:
        den = (b[0] - a[0]) * (d[1] - c[1]) - (b[1] - a[1]) * (d[0] - c[0])
        if den:
            t = ((c[0] - a[0]) * (d[1] - c[1]) - (c[1] - a[1]) * (d[0] - c[0])) / den
            if 0 < t < 1:
                ts.append(t)
    ts.sort()
    return [(x + y) / 2 for x, y in zip(ts, ts[1:], strict=False)]


def within(a: dict, b: dict) -> bool:
    own, others = list(parts(a)), list(parts(b))
    return bool(own) and all(any(_inside(x, y) for y in others) for x in own)


def haversine(lon1: float, lat1: float, lon2: float, lat2: float) -> float:
    p, q = math.radians(lat1), math.radians(lat2)
    h = math.sin((q - p) / 2) ** 2 + math.cos(p) * math.cos(q) * math.sin(math.radians(lon2 - lon1) / 2) ** 2
    return 2 * EARTH_M * math.asin(min(1.0, math.sqrt(h)))


def distance(g: dict, p: list[float]) -> float:
    """Metres from a point to a geometry; segments are straight in longitude and latitude scaled at the point."""
    best = math.inf
    k = math.cos(math.radians(p[1]))
    for kind, c in parts(g):
        if kind == "Polygon" and locate(p, c) >= 0:
            return 0.0
        if kind == "Point":
            best = min(best, haversine(*p, *c))
        for a, b in _lines(kind, c):
            dx, dy = (b[0] - a[0]) * k, b[1] - a[1]
            size = dx * dx + dy * dy
            t = 0.0 if not size else max(0.0, min(1.0, ((p[0] - a[0]) * k * dx + (p[1] - a[1]) * dy) / size))
            best = min(best, haversine(*p, a[0] + t * (b[0] - a[0]), a[1] + t * (b[1] - a[1])))
    return best


# Columns


def _each(f, kind: str):
    def run(s: pd.Series) -> pd.Series:
        def one(x):
            try:
                return None if x is None else f(x)
            except (ValueError, KeyError, TypeError, IndexError, struct.error):
                return None

        return pd.Series([one(x) for x in s], dtype=object)

    run.__annotations__ = {"s": pd.Series, "return": pd.Series}
    return F.pandas_udf(run, kind)


_POINT = np.dtype([("order", "u1"), ("kind", "<u4"), ("lon", "<f8"), ("lat", "<f8")])


def _points(s: pd.Series) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Which values are little-endian points, and their longitudes and latitudes."""
    held = np.fromiter((x is not None and len(x) == 21 and x[:5] == b"\1\1\0\0\0" for x in s), bool, len(s))
    read = np.frombuffer(b"".join(s[held]), _POINT)
    return held, read["lon"], read["lat"]


def _split(points, others, kind: str):
    """A column function: ``points`` takes all points of a batch as arrays, ``others`` each other geometry."""
    def run(s: pd.Series) -> pd.Series:
        out = np.empty(len(s), object)
        held, lon, lat = _points(s)
        if held.any():
            out[held] = points(lon, lat)
        for i in np.flatnonzero(~held).tolist():
            try:
                out[i] = None if s.iloc[i] is None else others(from_wkb(bytes(s.iloc[i])))
            except (ValueError, KeyError, TypeError, IndexError, struct.error):
                out[i] = None
        return pd.Series(out, dtype=object)

    run.__annotations__ = {"s": pd.Series, "return": pd.Series}
    return F.pandas_udf(run, kind)


def as_wkt(c: Column) -> Column:
    return _split(lambda x, y: [f"POINT ({_show(a)} {_show(b)})" for a, b in zip(x.tolist(), y.tolist(), strict=True)], to_wkt, "string")(c)


def as_geojson(c: Column) -> Column:
    return _each(lambda x: json.dumps(from_wkb(bytes(x))), "string")(c)


def decode_geo(json_text: Column, kind: str) -> Column:
    """WKB of a JSON value, null if it is no such geometry."""
    f = point_value if kind == "geo_point" else shape_value
    return _each(lambda x: to_wkb(f(json.loads(x))), "binary")(json_text)


def decode_point(lon: Column, lat: Column, json_text: Column) -> Column:
    """WKB of points from their numbers, a batch at a time; where these are null, of the JSON value."""
    def run(x: pd.Series, y: pd.Series, other: pd.Series) -> pd.Series:
        out, made = np.empty(len(x), object), np.zeros(len(x), _POINT)
        held = (x.notna() & y.notna()).to_numpy()
        made["order"], made["kind"], made["lon"], made["lat"] = 1, 1, x.to_numpy(float, na_value=0), y.to_numpy(float, na_value=0)
        raw = made.tobytes()
        for i in np.flatnonzero(held).tolist():
            out[i] = raw[21 * i : 21 * i + 21]
        for i in np.flatnonzero(~held & other.notna().to_numpy()).tolist():
            try:
                out[i] = to_wkb(point_value(json.loads(other.iloc[i])))
            except (ValueError, KeyError, TypeError, IndexError):
                out[i] = None
        return pd.Series(out, dtype=object)

    run.__annotations__ = {"x": pd.Series, "y": pd.Series, "other": pd.Series, "return": pd.Series}
    return F.pandas_udf(run, "binary")(lon, lat, json_text)


def box_of(g: dict) -> tuple[float, float, float, float]:
    """xmin, ymin, xmax, ymax of a geometry."""
    at = [p for kind, c in parts(g) for p in ([c] if kind == "Point" else c if kind == "LineString" else [q for ring in c for q in ring])]
    x, y = zip(*at, strict=True) if at else ((math.inf, -math.inf), (math.inf, -math.inf))
    return min(x), min(y), max(x), max(y)


def located(x: np.ndarray, y: np.ndarray, rings) -> np.ndarray:
    """``locate`` for arrays of points."""
    inside, edge = np.zeros(len(x), bool), np.zeros(len(x), bool)
    for ring in rings:
        for a, b in _segments(ring):
            turn = (b[0] - a[0]) * (y - a[1]) - (b[1] - a[1]) * (x - a[0])
            edge |= (turn == 0) & (min(a[0], b[0]) <= x) & (x <= max(a[0], b[0])) & (min(a[1], b[1]) <= y) & (y <= max(a[1], b[1]))
            if a[1] != b[1]:
                inside ^= ((a[1] > y) != (b[1] > y)) & (x < (b[0] - a[0]) * (y - a[1]) / (b[1] - a[1]) + a[0])
    return np.where(edge, 0, np.where(inside, 1, -1))


def relation(c: Column, name: str, shape: dict) -> Column:
    """intersects, disjoint, within (column in shape) or contains (shape in column)."""
    own = list(parts(shape))
    areas = [x for kind, x in own if kind == "Polygon"]
    low_x, low_y, high_x, high_y = box_of(shape)
    exact = {"intersects": lambda g: intersects(g, shape), "disjoint": lambda g: not intersects(g, shape), "within": lambda g: within(g, shape), "contains": lambda g: within(shape, g)}[name]

    def others(g: dict) -> bool:
        a, b, d, e = box_of(g)
        if a > high_x or b > high_y or d < low_x or e < low_y:  # the boxes are apart
            return name == "disjoint"
        return exact(g)

    def points(x: np.ndarray, y: np.ndarray) -> list[bool]:
        if name == "contains" or len(areas) < len(own):
            return [others(point(a, b)) for a, b in zip(x.tolist(), y.tolist(), strict=True)]
        least = 1 if name == "within" else 0
        hit = np.zeros(len(x), bool)
        for rings in areas:
            hit |= located(x, y, rings) >= least
        return (hit != (name == "disjoint")).tolist()

    return _split(points, others, "boolean")(c)


def metres(c: Column, lon: float, lat: float) -> Column:
    def points(x: np.ndarray, y: np.ndarray) -> list[float]:
        p, q = math.radians(lat), np.radians(y)
        h = np.sin((q - p) / 2) ** 2 + math.cos(p) * np.cos(q) * np.sin(np.radians(x - lon) / 2) ** 2
        return (2 * EARTH_M * np.arcsin(np.minimum(1.0, np.sqrt(h)))).tolist()

    return _split(points, lambda g: distance(g, [lon, lat]), "double")(c)


def haversine_column(lon: Column, lat: Column, to_lon: float, to_lat: float) -> Column:
    """The same for columns of numbers, without Python."""
    p, q = F.radians(lat), F.radians(F.lit(float(to_lat)))
    h = F.pow(F.sin((q - p) / 2), 2) + F.cos(p) * F.cos(q) * F.pow(F.sin(F.radians(F.lit(float(to_lon)) - lon) / 2), 2)
    return F.lit(2 * EARTH_M) * F.asin(F.least(F.lit(1.0), F.sqrt(h)))
