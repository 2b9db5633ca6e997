"""Index mappings as Spark schemas: types, paths, exact-valued subfields, and merging of several indices."""

from __future__ import annotations

from dataclasses import dataclass, field, replace

from pyspark.sql import types as T

#: The Spark type of each mapping type; others are strings.
SCALARS: dict[str, T.DataType] = {
    "text": T.StringType(), "keyword": T.StringType(), "string": T.StringType(), "ip": T.StringType(),
    "long": T.LongType(), "integer": T.IntegerType(), "short": T.ShortType(), "byte": T.ByteType(),
    "double": T.DoubleType(), "float": T.FloatType(), "half_float": T.FloatType(),
    "boolean": T.BooleanType(), "date": T.TimestampNTZType(),
    "geo_point": T.BinaryType(), "geo_shape": T.BinaryType(),
}
GEO = ("geo_point", "geo_shape")


class MappingConflict(ValueError):
    """Indices of a pattern give one field types that do not fit."""


@dataclass(frozen=True)
class Resolved:
    """What an index looks like: columns, each path's mapping type, text paths with an exact-valued subfield, arrays."""

    columns: tuple[tuple[str, T.DataType], ...]
    kinds: dict[str, str] = field(default_factory=dict)
    exact: frozenset[str] = frozenset()
    formats: dict[str, str] = field(default_factory=dict)

    def schema(self) -> T.StructType:
        return T.StructType([T.StructField("_id", T.StringType(), False), *(T.StructField(n, t) for n, t in self.columns), T.StructField("_unmapped_", T.VariantType())])

    def is_text(self, path: str) -> bool:
        return self.kinds.get(path) == "text"

    def is_geo(self, path: str) -> bool:
        return self.kinds.get(path) in GEO

    def remote_name(self, path: str) -> str:
        return f"{path}.keyword" if self.is_text(path) and path in self.exact else path

    def type_of(self, path: str) -> T.DataType | None:
        at: T.DataType = T.StructType([T.StructField(n, t) for n, t in self.columns])
        for name in path.split("."):
            while isinstance(at, T.ArrayType):
                at = at.elementType
            if not isinstance(at, T.StructType) or name not in at.fieldNames():
                return None
            at = at[name].dataType
        return at

    def with_arrays(self, paths: frozenset[str]) -> Resolved:
        def wrap(t: T.DataType, path: str) -> T.DataType:
            inner = t.elementType if isinstance(t, T.ArrayType) else t
            if isinstance(inner, T.StructType):
                inner = T.StructType([T.StructField(f.name, wrap(f.dataType, f"{path}.{f.name}")) for f in inner])
            return T.ArrayType(inner) if isinstance(t, T.ArrayType) or path in paths and self.kinds.get(path) not in GEO else inner

        return replace(self, columns=tuple((n, wrap(t, n)) for n, t in self.columns))


def spark_type(spec: dict) -> T.DataType:
    props, kind = spec.get("properties"), spec.get("type", "object")
    if props:
        inner: T.DataType = T.StructType([T.StructField(n, spark_type(s)) for n, s in props.items()])
    elif kind in ("object", "nested"):
        inner = T.StringType()
    else:
        inner = SCALARS.get(kind, T.StringType())
    return T.ArrayType(inner) if kind == "nested" else inner


def _paths(props: dict, above: str = ""):
    for name, spec in props.items():
        yield (path := above + name), spec
        yield from _paths(spec.get("properties", {}), path + ".")


def resolve(mapping: dict) -> Resolved:
    """From a mapping's ``properties``, or an object that holds them."""
    mapping = mapping.get("mappings", mapping)
    props = mapping.get("properties", {})
    every = list(_paths(props))
    return Resolved(
        tuple((n, spark_type(s)) for n, s in props.items()),
        {p: s.get("type", "object") for p, s in every},
        frozenset(p for p, s in every if s.get("type") == "text" and s.get("fields", {}).get("keyword", {}).get("type") == "keyword"),
        {p: s["format"] for p, s in every if s.get("type") == "date" and "format" in s},
    )


def compatible(a: T.DataType, b: T.DataType) -> bool:
    """Equal types; structs whose common fields are compatible; lists of compatible elements. No number is widened."""
    if isinstance(a, T.StructType) and isinstance(b, T.StructType):
        return all(compatible(a[n].dataType, b[n].dataType) for n in a.fieldNames() if n in b.fieldNames())
    if isinstance(a, T.ArrayType) and isinstance(b, T.ArrayType):
        return compatible(a.elementType, b.elementType)
    return a == b


def merged_type(a: T.DataType, b: T.DataType) -> T.DataType:
    if isinstance(a, T.StructType) and isinstance(b, T.StructType):
        common = [T.StructField(f.name, merged_type(f.dataType, b[f.name].dataType) if f.name in b.fieldNames() else f.dataType) for f in a]
        return T.StructType(common + [f for f in b if f.name not in a.fieldNames()])
    if isinstance(a, T.ArrayType) and isinstance(b, T.ArrayType):
        return T.ArrayType(merged_type(a.elementType, b.elementType))
    return a


def merge(indices: dict[str, Resolved]) -> Resolved:
    """One schema for several indices; a text path is exact if it is so wherever it is mapped."""
    columns: dict[str, tuple[T.DataType, str]] = {}
    kinds: dict[str, str] = {}
    formats: dict[str, str] = {}
    for index, r in indices.items():
        for name, kind in r.columns:
            if name in columns:
                have, where = columns[name]
                if not compatible(have, kind):
                    raise MappingConflict(f"Incompatible field types for '{name}': index '{where}' has type {have.simpleString()}, but index '{index}' has type {kind.simpleString()}")
                columns[name] = (merged_type(have, kind), where)
            else:
                columns[name] = (kind, index)
        kinds = r.kinds | kinds
        formats = r.formats | formats
    exact = frozenset(p for p in kinds if any(p in r.kinds for r in indices.values()) and all(p in r.exact for r in indices.values() if p in r.kinds))
    return Resolved(tuple((n, t) for n, (t, _) in columns.items()), kinds, exact, formats)
