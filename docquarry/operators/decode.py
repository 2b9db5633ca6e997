"""Lenient decoding of JSON documents: a value that does not fit is null, and a single value in a list's place is a list."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.geometry import decode_geo, decode_point
from ..functions.mapping import GEO, Resolved


def _get(v: Column, name: str, kind: str = "variant") -> Column:
    quoted = name.replace("\\", "\\\\").replace("'", "\\'")
    return F.try_variant_get(v, f"$['{quoted}']", kind)


_PAIR = r"^\s*([-+0-9.eE]+)\s*,\s*([-+0-9.eE]+)\s*$"
_WKT = r"(?i)^\s*POINT\s*\(\s*([-+0-9.eE]+)\s+([-+0-9.eE]+)\s*\)\s*$"


def lon_lat(v: Column) -> tuple[Column, Column]:
    """Longitude and latitude of a point in any of its five encodings; null for other geometries and misfits."""
    def number(x: Column) -> Column:
        tag = F.schema_of_variant(x)
        return F.when(tag.startswith("DECIMAL") | tag.isin("BIGINT", "DOUBLE"), F.try_variant_get(x, "$", "double"))

    tag, text = F.schema_of_variant(v), F.try_variant_get(v, "$", "string")
    at = lambda place: number(F.try_variant_get(v, place, "variant"))
    point = tag.startswith("OBJECT") & (F.try_variant_get(v, "$.type", "string") == "Point")
    out = []
    for field, i, pair in (("lon", 0, 2), ("lat", 1, 1)):
        spelled = F.when(text.rlike(_PAIR), F.regexp_extract(text, _PAIR, pair)).when(text.rlike(_WKT), F.regexp_extract(text, _WKT, i + 1))
        out.append(F.when(tag.startswith("ARRAY"), at(f"$[{i}]")).when(tag == "STRING", spelled.try_cast("double")).when(point, at(f"$.coordinates[{i}]")).when(tag.startswith("OBJECT"), at(f"$.{field}")))
    return out[0], out[1]


def coerce(v: Column, kind: T.DataType, path: str, r: Resolved) -> Column:
    """A variant as a value of the type, or null."""
    tag = F.schema_of_variant(v)
    whole = lambda t: F.try_variant_get(v, "$", t)
    gone = v.isNull() | F.is_variant_null(v)
    if isinstance(kind, T.ArrayType):
        many = F.when(tag.startswith("ARRAY"), whole("array<variant>")).otherwise(F.array(v))
        return F.when(~gone, F.transform(many, lambda x: coerce(x, kind.elementType, path, r)))
    if r.kinds.get(path) in GEO:
        if r.kinds[path] == "geo_point":
            lon, lat = lon_lat(v)
            return F.when(~gone, decode_point(lon, lat, F.when(lon.isNull() | lat.isNull(), F.to_json(v))))
        return F.when(~gone, decode_geo(F.to_json(v), r.kinds[path]))
    if isinstance(kind, T.StructType):
        return F.when(tag.startswith("OBJECT"), F.struct(*[coerce(_get(v, f.name), f.dataType, f"{path}.{f.name}", r).alias(f.name) for f in kind]))
    number = tag.startswith("DECIMAL") | tag.isin("BIGINT", "DOUBLE")
    match kind:
        case T.StringType():
            return F.when(tag == "STRING", whole("string")).when(~gone, F.to_json(v))
        case T.LongType() | T.IntegerType() | T.ShortType() | T.ByteType():
            return F.when(tag == "BIGINT", whole(kind.simpleString()))
        case T.DoubleType() | T.FloatType():
            return F.when(number, whole(kind.simpleString()))
        case T.BooleanType():
            return F.when(tag == "BOOLEAN", whole("boolean"))
        case T.TimestampNTZType():
            unit = F.timestamp_seconds if "epoch_second" in r.formats.get(path, "") else F.timestamp_millis
            return F.when(tag == "STRING", whole("string").try_cast("timestamp_ntz")).when(tag == "BIGINT", unit(whole("bigint")).cast("timestamp_ntz"))
    return F.lit(None).cast(kind)


def rest(v: Column, paths: frozenset[str], above: str = "") -> Column:
    """What the mapping does not name of an object, as a variant, or null."""
    names = sorted({p[len(above) :].split(".")[0] for p in paths if p.startswith(above)})
    members = F.try_variant_get(v, "$", "map<string,variant>")
    none = F.create_map().cast("map<string,variant>")
    parts = [F.map_filter(members, lambda k, _: ~k.isin(names)) if names else members]
    for name in names:
        path = above + name + "."
        if any(p.startswith(path) for p in paths):
            inner = rest(_get(v, name), paths, path)
            parts.append(F.when(inner.isNotNull(), F.create_map(F.lit(name), inner)).otherwise(none))
    whole = F.map_concat(*parts)
    return F.when(F.size(whole) > 0, F.to_variant_object(whole))


def decode(docs, r: Resolved, columns: list[str] | None = None):
    """Typed columns of rows (_id, _source); only those asked for are decoded."""
    wanted = ["_id", *(n for n, _ in r.columns), "_unmapped_"] if columns is None else columns
    kinds = dict(r.columns)
    v = F.try_parse_json("_source")
    unmapped = rest(v, frozenset(r.kinds))
    made = {n: F.col(n) if n in ("_id", "_source") else unmapped if n == "_unmapped_" else coerce(_get(v, n), kinds[n], n, r) for n in wanted}
    return docs.select(*[c.alias(n) for n, c in made.items()])
