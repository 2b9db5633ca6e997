"""Queries of the catalogue on JSON documents: over a store that answers HTTP, and on schemas, sampling and settings.

The documents are the nations and regions, 25 and 5 rows at any scale. A store in this process serves them, so the
remote source is met as users meet it: mapping, sample, request, cursor.
"""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import geometry as geo
from ..functions.mapping import MappingConflict, merge, resolve
from ..operators import predicates as P
from ..search import clear_cache, create_view, explain, http_log, search, search_remote
from ..settings import DEFAULTS, current_settings, setting
from ..sources.index import COUNTS, Catalog, Index
from ..sources.loopback import LoopbackStore
from ..sources.table_function import register_table_function

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}

_WORD, _INT, _BOTH = {"type": "keyword"}, {"type": "integer"}, {"type": "text", "fields": {"keyword": {"type": "keyword"}}}
MAPPINGS = {
    "nations": {"properties": {
        "name": _BOTH, "note": {"type": "text"}, "key": _INT, "tags": _WORD, "even": {"type": "boolean"},
        "region": {"properties": {"key": _INT}}, "at": {"type": "geo_point"}, "area": {"type": "geo_shape"},
        "home": {"properties": {"spot": {"type": "geo_point"}}},
    }},
    "regions": {"properties": {"name": _BOTH, "region": {"properties": {"label": _WORD}}}},
}
NATIONS = """(SELECT n_nationkey::VARCHAR AS _id, n_name AS name, n_nationkey AS key, n_regionkey AS region,
  n_nationkey * 37 % 360 - 180 AS lon, n_nationkey * 17 % 180 - 90 AS lat FROM nation)"""


def documents(s: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Rows (_id, _source) of an index. Each third nation has no tag, each second two; points come in three encodings,
    shapes are squares of two degrees around them and, of each fifth nation, points in WKT."""
    if name == "regions":
        t = s.read.parquet(f"{sf_dir}/region.parquet")
        source = F.struct(F.col("r_name").alias("name"), F.struct(F.lower("r_name").alias("label")).alias("region"))
        return t.select(F.concat(F.lit("r"), F.col("r_regionkey")).alias("_id"), F.to_json(source).alias("_source"))
    k = F.col("n_nationkey")
    lon, lat = (k * 37 % 360 - 180).cast("double"), (k * 17 % 180 - 90).cast("double")
    at = F.when(k % 3 == 0, F.to_json(F.struct(lat.alias("lat"), lon.alias("lon")))).when(k % 3 == 1, F.to_json(F.array(lon, lat)))
    at = at.otherwise(F.concat(F.lit('"POINT ('), lon, F.lit(" "), lat, F.lit(')"')))
    ring = F.array(*[F.array(lon + x, lat + y) for x, y in ((-1, -1), (1, -1), (1, 1), (-1, 1), (-1, -1))])
    square = F.to_json(F.struct(F.lit("Polygon").alias("type"), F.array(ring).alias("coordinates")))
    area = F.when(k % 5 == 0, F.concat(F.lit('"POINT ('), lon, F.lit(" "), lat, F.lit(')"'))).otherwise(square)
    tags = F.when(k % 3 == 0, F.lit("null")).when(k % 2 == 0, F.lit('["a","b"]')).otherwise(F.lit('"a"'))
    fields = {
        "name": F.concat(F.lit('"'), F.col("n_name"), F.lit('"')), "note": F.concat(F.lit('"nation number '), k, F.lit('"')),
        "key": k.cast("string"), "tags": tags, "even": F.when(k % 2 == 0, "true").otherwise("false"),
        "region": F.to_json(F.struct(F.col("n_regionkey").alias("key"))), "at": at, "area": area,
        "home": F.concat(F.lit('{"spot":'), at, F.lit("}")), "more": F.concat(F.lit('{"m":'), k, F.lit("}")),
    }
    parts = [F.concat(F.lit(f'"{n}":'), v) for n, v in fields.items()]
    return s.read.parquet(f"{sf_dir}/nation.parquet").select(k.cast("string").alias("_id"), F.concat(F.lit("{"), F.concat_ws(",", *parts), F.lit("}")).alias("_source"))


def catalog(sf_dir: str) -> Catalog:
    out = Catalog()
    for name, mapping in MAPPINGS.items():
        out.add(Index(name, mapping, lambda s, n=name: documents(s, sf_dir, n)))
    return out


_stores: dict[tuple, LoopbackStore] = {}


def store(s: SparkSession, sf_dir: str, login: tuple[str, str] | None = None) -> LoopbackStore:
    """The store over a folder's nations and regions, started once; on a cluster it listens where executors find the driver."""
    host = "127.0.0.1" if s.sparkContext.master.startswith("local[") else s.conf.get("spark.driver.host")
    if (sf_dir, host, login) not in _stores:
        held = {n: (m, {r["_id"]: json.loads(r["_source"]) for r in documents(s, sf_dir, n).collect()}) for n, m in MAPPINGS.items()}
        _stores[sf_dir, host, login] = LoopbackStore(held, host, login)
    return _stores[sf_dir, host, login]


def _add(name: str, sql: str, make: Callable[[SparkSession, str], DataFrame]) -> None:
    QUERIES[name], SQL[name] = make, sql


def _remote(s: SparkSession, d: str, query=None, *where: P.Predicate, index: str = "nations", **more) -> DataFrame:
    own = store(s, d)
    return search_remote(s, index, own.host, own.port, query, where, **more)


def _told(s: SparkSession, **columns) -> DataFrame:
    kinds = {bool: "boolean", int: "int", str: "string"}
    return s.createDataFrame([tuple(columns.values())], ", ".join(f"{k} {kinds[type(v)]}" for k, v in columns.items()))


def _refused(s: SparkSession, run: Callable[[], object], kind: type[Exception] | tuple = Exception) -> DataFrame:
    """The message with which something is refused."""
    try:
        run()
    except kind as e:
        return _told(s, message=str(e))
    return _told(s, message="not refused")


# Over HTTP: scans, what is sent, pages, limits
_add("remote_scan", f"SELECT _id, name, key, region FROM {NATIONS}", lambda s, d: _remote(s, d).select("_id", "name", "key", F.col("region.key").alias("region")))


def _ids(name: str, condition: str, query=None, *where: P.Predicate, source: str = NATIONS) -> None:
    """The ids that match, over the store and, as json_..., over the index itself."""
    _add(f"remote_{name}", f"SELECT _id FROM {source} WHERE {condition}", lambda s, d: _remote(s, d, query, *where, columns=["_id"]))
    _add(f"json_{name}", f"SELECT _id FROM {source} WHERE {condition}", lambda s, d: search(s, "nations", query, where, ["_id"], catalog=catalog(d)))


_ids("compare", "key > 7 AND name <> 'NATION_9'", None, P.Compare("key", ">", 7), P.Compare("name", "!=", "NATION_9"))
_ids("or", "key < 3 OR region = 4", None, P.Compare("key", "<", 3) | P.Compare("region.key", "=", 4))
_ids("in", "key IN (2, 3, 50)", None, P.In("key", (2, 3, 50)))
_ids("like", "name LIKE 'NATION__' AND name ILIKE '%_2'", None, P.Like("name", "NATION__"), P.Like("name", "%_2", True))
_ids("null", "key % 3 = 0", None, P.Null("tags"))
_ids("not_null", "key % 3 <> 0", None, P.Null("tags", False))
_ids("text", "key = 12", None, P.Compare("note", "=", "nation number 12"))
_ids("element", "key % 6 IN (2, 4)", None, P.Compare("tags[2]", "=", "b"))
_ids("unmapped", "key > 20", None, P.Compare("_unmapped_.more.m", ">", 20))
_ids("query", "key IN (5, 6) AND region > 0", {"match": {"note": "5 6"}}, P.Compare("region.key", ">", 0))
_ids("bool", "key % 2 = 0 AND key < 9", {"bool": {"filter": [{"term": {"even": True}}], "must_not": [{"range": {"key": {"gte": 9}}}]}})
_ids("box", "lon > -100 AND lon < 100 AND lat > -60 AND lat < 60", None, P.Spatial("at", "within", geo.envelope(-100, -60, 100, 60)))
_ids("nested_box", "lon > -100 AND lon < 100 AND lat > -60 AND lat < 60", None, P.Spatial("home.spot", "within", geo.envelope(-100, -60, 100, 60)))
_METRES = "2 * 6371008.7714 * asin(least(1.0, sqrt(pow(sin((radians(10) - radians(lat)) / 2), 2) + cos(radians(lat)) * cos(radians(10)) * pow(sin(radians(-30 - lon) / 2), 2))))"
for _n, _op in (("lt", "<"), ("le", "<="), ("gt", ">"), ("ge", ">=")):
    _ids(f"distance_{_n}", f"{_METRES} {_op} 6000000", None, P.Distance("at", -30, 10, _op, 6_000_000))
_ids("distance_eq", "lon = -143 AND lat = -73", None, P.Distance("at", -143, -73, "=", 0))
_ids("distance_ne", "NOT (lon = -143 AND lat = -73)", None, P.Distance("at", -143, -73, "!=", 0))
_ids("distance_negative", "false", None, P.Distance("at", -143, -73, "<", -1))
_ids("point", "lon = -143 AND lat = -73", None, P.Compare("at", "=", geo.from_geojson('{"type": "Point", "coordinates": [-143, -73]}')))
_ids("point_in", "key IN (1, 2)", None, P.In("at", (geo.point(-143, -73), geo.from_wkt("POINT (-106 -56)"))))

# Geometry that the store of this process does not evaluate: over the index alone
_SQUARE = "CASE WHEN key % 5 = 0 THEN 0 ELSE 1 END"


def _shape(name: str, condition: str, query=None, *where: P.Predicate) -> None:
    _add(f"json_{name}", f"SELECT _id FROM {NATIONS} WHERE {condition}", lambda s, d: search(s, "nations", query, where, ["_id"], catalog=catalog(d)))


_IN_BOX = f"lon - {_SQUARE} <= 100 AND lon + {_SQUARE} >= -100 AND lat - {_SQUARE} <= 60 AND lat + {_SQUARE} >= -60"
_shape("shape_intersects", _IN_BOX, None, P.Spatial("area", "intersects", geo.envelope(-100, -60, 100, 60)))
_shape("shape_disjoint", f"NOT ({_IN_BOX})", None, P.Spatial("area", "disjoint", geo.envelope(-100, -60, 100, 60)))
_shape("shape_contains", "key = 1", None, P.Spatial("area", "contains", geo.from_wkt("POINT (-143.5 -73.5)")))
_shape("clause_shape", _IN_BOX, {"geo_shape": {"area": {"shape": {"type": "envelope", "coordinates": [[-100, 60], [100, -60]]}, "relation": "intersects"}}})
_shape("clause_contains", "key = 1", {"geo_shape": {"area": {"shape": {"type": "Point", "coordinates": [-143.5, -73.5]}, "relation": "contains"}}})
_shape("shape_distance", "key = 1", None, P.Distance("area", -143.5, -73.5, "=", 0))

for _n, _more in (("limit", {"limit": 7}), ("limit_offset", {"limit": 4, "offset": 23}), ("limit_zero", {"limit": 0}), ("limit_beyond", {"limit": 9999})):
    _at, _of = _more["limit"], _more.get("offset", 0)
    _add(f"remote_{_n}", f"SELECT greatest(0, least({_at}, count(*) - {_of}))::BIGINT AS n FROM nation", lambda s, d, more=_more: _remote(s, d, columns=["_id"], **more).agg(F.count("*").alias("n")))
_add("remote_limit_inexact", "SELECT 5::BIGINT AS n", lambda s, d: _remote(s, d, None, P.Compare("tags", "!=", "z"), limit=5, columns=["_id"], sample_size=0).agg(F.count("*").alias("n")))
_add("remote_slices", f"SELECT _id, key FROM {NATIONS}", lambda s, d: _remote(s, d, columns=["_id", "key"], slices=3))
_add("remote_arrays", f"SELECT _id, CASE key % 6 WHEN 2 THEN 2 WHEN 4 THEN 2 ELSE 1 END AS n FROM {NATIONS} WHERE key % 3 <> 0", lambda s, d: _remote(s, d, None, P.Null("tags", False)).select("_id", F.size("tags").alias("n")))
_add("remote_indices", "SELECT n_nationkey::VARCHAR AS _id, n_name AS name, n_regionkey AS region, NULL AS label FROM nation UNION ALL SELECT 'r' || r_regionkey, r_name, NULL, lower(r_name) FROM region", lambda s, d: _remote(s, d, index="nations,regions", columns=["_id", "name", "region"]).select("_id", "name", F.col("region.key").alias("region"), F.col("region.label").alias("label")))
_add("remote_view", "SELECT n_regionkey AS region, count(*) AS n FROM nation WHERE n_nationkey > 3 GROUP BY n_regionkey", lambda s, d: (create_view(s, "docquarry_nations", "nations", host=store(s, d).host, port=store(s, d).port), s.sql("SELECT region.key AS region, count(*) AS n FROM docquarry_nations WHERE key > 3 GROUP BY region.key"))[1])
_add("remote_join_table", "SELECT n_name AS name, r_name AS region FROM nation JOIN region ON n_regionkey = r_regionkey", lambda s, d: _remote(s, d, columns=["name", "region"]).join(s.read.parquet(f"{d}/region.parquet"), F.col("region.key") == F.col("r_regionkey")).select("name", F.col("r_name").alias("region")))


def _table_function(s: SparkSession, d: str) -> DataFrame:
    register_table_function(s, "docsearch")
    own = store(s, d)
    return s.sql(f"SELECT _id, name, region.key AS region FROM docsearch(index => 'nations', host => '{own.host}', port => {own.port}) WHERE key >= 10")


_add("remote_table_function", f"SELECT _id, name, region FROM {NATIONS} WHERE key >= 10", _table_function)


def _pages(s: SparkSession, d: str) -> DataFrame:
    """Requests of a scan in pages of 10, of a small limit, and of a limit beyond so many pages."""
    own = store(s, d, ("pages", "p"))
    go = lambda **k: search_remote(s, "nations", own.host, own.port, username="pages", password="p", columns=["_id"], **k).count()
    s.conf.set("docsearch.batch_size", "10")
    s.conf.set("docsearch.batch_size_threshold_factor", "2")
    try:
        go()
        own.seen.clear()
        rows = go()
        out = {"rows": rows, "opened": own.count("POST", "size=10"), "pages": own.count("POST", "/_search/scroll"), "closed": own.count("DELETE", "/_search/scroll")}
        go(limit=20)
        out["small"] = own.count("POST", "size=20")
        own.seen.clear()
        go(limit=21)
        out["large"] = own.count("POST", "size=10")
    finally:
        s.conf.unset("docsearch.batch_size")
        s.conf.unset("docsearch.batch_size_threshold_factor")
    return _told(s, **out)


_add("remote_pages", "SELECT 25 AS rows, 1 AS opened, 3 AS pages, 1 AS closed, 1 AS small, 1 AS large", _pages)


def _requests(s: SparkSession, d: str) -> DataFrame:
    """Mapping and sample requests of a cold search, a warm one, a self-join, and after the cache was cleared; the log."""
    own = store(s, d, ("me", "secret"))
    go = lambda: search_remote(s, "nations", own.host, own.port, username="me", password="secret", columns=["_id", "key"])
    mappings = lambda: own.count("GET", "/_mapping")
    clear_cache()
    own.seen.clear()
    out = {"rows": go().count(), "cold": mappings(), "samples": own.count("POST", "_search?size=100")}
    a = go()
    out |= {"joined": a.alias("a").join(go().alias("b"), "_id").count(), "warm": mappings()}
    clear_cache()
    go().count()
    out["cleared"] = mappings()
    rows = http_log(s).where(F.col("url").endswith(f":{own.port}/nations/_mapping"))
    return _told(s, **out, logged=rows.where("type = 'GET' AND status = 200 AND reason = 'OK'").count() >= 2, secrets=rows.where("request_headers['Authorization'] IS NOT NULL").count())


_add("remote_requests", "SELECT 25 AS rows, 1 AS cold, 1 AS samples, 25 AS joined, 1 AS warm, 2 AS cleared, true AS logged, 0 AS secrets", _requests)


def _retries(s: SparkSession, d: str) -> DataFrame:
    """Two answers of 503 are borne; three with two retries are not. Without the login, or by an unknown name, nothing is."""
    own = store(s, d, ("retry", "r"))
    go = lambda index="nations", **k: search_remote(s, index, own.host, own.port, **({"username": "retry", "password": "r", "retry_interval": 1, "columns": ["_id"]} | k))

    def problem(**k) -> str:
        try:
            return str(go(**k).count())
        except Exception as e:
            return next(x for x in ("HTTP 503", "HTTP 401", "HTTP 404", "other") if x in str(e) or x == "other")

    clear_cache()
    own.busy = 2
    out = {"borne": problem(max_retries=3)}
    clear_cache()
    own.busy = 3
    out["busy"] = problem(max_retries=2)
    own.busy = 0
    return _told(s, **out, stranger=problem(password="x", username="y"), unknown=problem(index="nothing"))


_add("remote_retries", "SELECT '25' AS borne, 'HTTP 503' AS busy, 'HTTP 401' AS stranger, 'HTTP 404' AS unknown", _retries)


def _sent(s: SparkSession, d: str) -> DataFrame:
    """The body that the store got is the one that explain tells."""
    own, where = store(s, d, ("sent", "s")), [P.Compare("key", ">", 3), P.Compare("name", "!=", "NATION_9"), P.Compare("note", "=", "x")]
    search_remote(s, "nations", own.host, own.port, None, where, ["_id", "key"], username="sent", password="s").count()
    body = next(b for m, p, b in reversed(own.seen) if m == "POST" and "scroll=" in p)
    told = json.loads(explain(s, "nations", None, where, ["_id", "name", "note", "key"], catalog(d)).split("\n")[0])
    return _told(s, query=json.dumps(body["query"]), fields=",".join(sorted(body["_source"])), same=body["query"] == told["query"])


_add("remote_sent", """SELECT '{"bool": {"must": [{"range": {"key": {"gt": 3}}}, {"bool": {"must_not": {"term": {"name.keyword": "NATION_9"}}}}]}}' AS query, 'key,name,note' AS fields, true AS same""", _sent)

# Schemas: sampling, caching, several indices, paths
_kind = lambda df, c: dict(df.dtypes)[c]
_add("schema_sampled", "SELECT 'array<string>' AS sampled, 'string' AS flat, 'string' AS under_query", lambda s, d: _told(
    s,
    sampled=_kind(search(s, "nations", catalog=catalog(d)), "tags"),
    flat=_kind(search(s, "nations", sample_size=0, catalog=catalog(d)), "tags"),
    under_query=_kind(search(s, "nations", {"term": {"key": 1}}, catalog=catalog(d)), "tags"),
))


def _cached(s: SparkSession, d: str) -> DataFrame:
    own, before = catalog(d), dict(COUNTS)
    a, b = (search(s, "nations", catalog=own) for _ in range(2))
    once = COUNTS["mapping"] - before["mapping"]
    cleared = clear_cache()
    search(s, "nations", catalog=own)
    return _told(s, rows=a.join(b, "_id").count(), once=once, cleared=cleared, again=COUNTS["mapping"] - before["mapping"])


_add("schema_cached", "SELECT 25 AS rows, 1 AS once, true AS cleared, 2 AS again", _cached)
_add("schema_merged", "SELECT n_nationkey::VARCHAR AS _id, n_regionkey AS region, NULL AS label FROM nation UNION ALL SELECT 'r' || r_regionkey, NULL, lower(r_name) FROM region", lambda s, d: search(s, "*", catalog=catalog(d)).select("_id", F.col("region.key").alias("region"), F.col("region.label").alias("label")))
_add("schema_conflict", "SELECT 'Incompatible field types for ''x'': index ''a'' has type bigint, but index ''b'' has type int' AS message", lambda s, d: _refused(s, lambda: merge({n: resolve({"properties": {"x": {"type": t}}}) for n, t in (("a", "long"), ("b", "integer"))}), MappingConflict))
_add("schema_paths", "SELECT * FROM (VALUES ('area', 'geo_shape', 'area'), ('at', 'geo_point', 'at'), ('even', 'boolean', 'even'), ('home', 'object', 'home'), ('home.spot', 'geo_point', 'home.spot'), ('key', 'integer', 'key'), ('name', 'text', 'name.keyword'), ('note', 'text', 'note'), ('region', 'object', 'region'), ('region.key', 'integer', 'region.key'), ('tags', 'keyword', 'tags')) t(path, kind, asked)", lambda s, d: (lambda r: s.createDataFrame([(p, k, r.remote_name(p)) for p, k in r.kinds.items()], "path string, kind string, asked string"))(resolve(MAPPINGS["nations"])))

# Arguments and settings
_add("index_required", "SELECT 'search requires ''index'' parameter' AS message", lambda s, d: _refused(s, lambda: search(s), ValueError))
_add("host_required", "SELECT 'search requires ''host'' parameter' AS message", lambda s, d: _refused(s, lambda: search_remote(s, "nations", ""), ValueError))
_add("unknown_argument", "SELECT true AS refused", lambda s, d: _refused(s, lambda: search(s, "nations", nothing=1), TypeError).select(F.col("message").contains("unexpected keyword argument 'nothing'").alias("refused")))
_add("geo_range_refused", "SELECT true AS refused", lambda s, d: _refused(s, lambda: search(s, "nations", None, [P.Compare("at", "<", geo.point(0, 0))], catalog=catalog(d)), P.GeoRangeError).select(F.col("message").contains("not supported on geo field 'at'").alias("refused")))
#: The defaults that a session starts with.
_add("settings_defaults", "SELECT * FROM (VALUES ('verify_ssl', 'True'), ('timeout', '30000'), ('max_retries', '3'), ('retry_interval', '100'), ('retry_backoff_factor', '2.0'), ('sample_size', '100'), ('batch_size', '1000'), ('batch_size_threshold_factor', '5'), ('scroll_time', '5m')) t(name, value)", lambda s, d: s.createDataFrame([(k, str(v)) for k, v in current_settings(s).items()], "name string, value string"))


def _precedence(s: SparkSession, d: str) -> DataFrame:
    """Of each setting: the session's value after SET, an argument beside it, the default after RESET."""
    given = {"verify_ssl": "false", "scroll_time": "1m", "retry_backoff_factor": "1.5"}
    other = {"verify_ssl": True, "scroll_time": "2m", "retry_backoff_factor": 3.0}
    rows = []
    for name, (_, default) in DEFAULTS.items():
        s.sql(f"SET docsearch.{name} = {given.get(name, 7)}")
        held, argued = setting(s, name), setting(s, name, other.get(name, 8))
        s.sql(f"RESET docsearch.{name}")
        rows.append((name, str(held), str(argued), setting(s, name) == default))
    return s.createDataFrame(rows, "name string, held string, argued string, back boolean")


_add("settings_precedence", "SELECT *, true AS back FROM (VALUES ('verify_ssl', 'False', 'True'), ('timeout', '7', '8'), ('max_retries', '7', '8'), ('retry_interval', '7', '8'), ('retry_backoff_factor', '1.5', '3.0'), ('sample_size', '7', '8'), ('batch_size', '7', '8'), ('batch_size_threshold_factor', '7', '8'), ('scroll_time', '1m', '2m')) t(name, held, argued)", _precedence)
