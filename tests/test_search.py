"""Search over a small index of typed, nested, geometric and unmapped fields."""

import gzip
import json
import threading
from decimal import Decimal
from http.server import BaseHTTPRequestHandler, HTTPServer

import pytest

from docquarry import settings
from docquarry.functions import geometry as geo
from docquarry.functions.mapping import MappingConflict, merge, resolve
from docquarry.operators import predicates as P
from docquarry.search import create_view, explain, http_log, search, search_remote
from docquarry.sources import index as ix
from docquarry.sources.remote import Client, StoreError
from docquarry.sources.table_function import register_table_function

TEXT_KEYWORD = {"type": "text", "fields": {"keyword": {"type": "keyword"}}}
MAPPING = {"properties": {
    "name": TEXT_KEYWORD, "note": {"type": "text"}, "tags": {"type": "keyword"}, "n": {"type": "integer"}, "price": {"type": "float"},
    "old": {"type": "boolean"}, "born": {"type": "date"}, "at": {"type": "geo_point"}, "shape": {"type": "geo_shape"},
    "job": {"properties": {"title": {"type": "keyword"}, "place": {"properties": {"city": TEXT_KEYWORD}}, "pay": {"type": "double"}}},
    "people": {"type": "nested", "properties": {"mail": {"type": "keyword"}, "name": {"type": "text"}}},
}}
DOCS = {
    "1": {"name": "Ada Stone", "note": "Quiet noise cancellation set", "tags": ["red", "blue"], "n": 42, "price": 1.5, "born": "2005-03-15", "at": {"lat": 40.7, "lon": -74.0}, "shape": {"type": "Point", "coordinates": [1, 2]}, "job": {"title": "x", "place": {"city": "Rome"}, "pay": 100.0}, "people": [{"mail": "a@x", "name": "Ann Lee"}, {"mail": "b@x", "name": "Bob"}]},
    "2": {"name": "Bo Brown", "note": "Premium wireless set", "tags": "green", "n": 87, "price": "7", "old": True, "born": "1995-11-22T10:00:00Z", "at": "51.5,-0.1", "extra": 10, "job": {"title": "y", "place": {"city": "Oslo"}, "pay": 250.5}, "people": {"mail": "c@x", "name": "Ann Ray"}},
    "3": {"name": "Cy", "n": 1.0, "price": 3, "old": "true", "born": 0, "at": [-118.2, 34.0], "shape": {"type": "Polygon", "coordinates": [[[0, 0], [4, 0], [4, 4], [0, 4], [0, 0]]]}, "extra": {"note": "hm", "value": 20.3}},
    "4": {"name": "Ada Brown", "tags": [], "n": "42", "born": "nope", "at": "POINT (139.7 35.7)", "job": {"place": {"city": "Bern", "zip": 9}}},
    "5": {"tags": ["red", 7], "n": 10, "at": {"type": "Point", "coordinates": [2.35, 48.85]}, "job": "none"},
}


@pytest.fixture(scope="module")
def catalog(spark):
    c = ix.Catalog()
    c.add(ix.Index("docs", MAPPING, lambda s: s.createDataFrame([(k, json.dumps(v)) for k, v in DOCS.items()], "_id string, _source string")))
    return c


@pytest.fixture
def ids(spark, catalog):
    def get(query=None, *where):
        return "".join(sorted(r[0] for r in search(spark, "docs", query, where, ["_id"], catalog=catalog).collect()))

    return get


def test_decode(spark, catalog):
    rows = {r["_id"]: r for r in search(spark, "docs", catalog=catalog).collect()}
    assert [rows[k]["n"] for k in "12345"] == [42, 87, None, None, 10]
    assert rows["2"]["price"] is None and rows["3"]["price"] == 3.0 and rows["3"]["old"] is None and rows["2"]["old"] is True
    assert rows["2"]["tags"] == ["green"] and rows["4"]["tags"] == [] and rows["3"]["tags"] is None and rows["5"]["tags"] == ["red", "7"]
    assert [str(rows[k]["born"]) for k in "1234"] == ["2005-03-15 00:00:00", "1995-11-22 10:00:00", "1970-01-01 00:00:00", "None"]
    assert rows["5"]["job"] is None and rows["2"]["people"][0]["mail"] == "c@x"
    assert [geo.from_wkb(bytes(rows[k]["at"]))["coordinates"] for k in "12345"] == [[-74.0, 40.7], [-0.1, 51.5], [-118.2, 34.0], [139.7, 35.7], [2.35, 48.85]]
    assert rows["1"]["_unmapped_"] is None and rows["2"]["_unmapped_"].toPython() == {"extra": 10}
    assert rows["4"]["_unmapped_"].toPython() == {"job": {"place": {"zip": 9}}}


@pytest.mark.parametrize(("query", "want"), [
    ({"match_all": {}}, "12345"), ({"match": {"name": "ada brown"}}, "124"), ({"match": {"name": {"query": "ada brown", "operator": "and"}}}, "4"),
    ({"match_phrase": {"note": "noise cancellation"}}, "1"), ({"match_phrase_prefix": {"note": "premium wire"}}, "2"), ({"term": {"tags": "red"}}, "15"),
    ({"term": {"name.keyword": "Cy"}}, "3"), ({"term": {"name": "cy"}}, "3"), ({"term": {"note.keyword": "x"}}, ""), ({"terms": {"n": [42, 10]}}, "15"),
    ({"range": {"n": {"gte": 42, "lt": 87}}}, "1"), ({"range": {"born": {"gt": "1990-01-01"}}}, "12"), ({"exists": {"field": "old"}}, "2"), ({"exists": {"field": "tags"}}, "125"),
    ({"prefix": {"job.place.city": {"value": "r"}}}, "1"), ({"prefix": {"job.place.city.keyword": {"value": "R"}}}, "1"), ({"wildcard": {"tags": {"value": "?r*n"}}}, "2"),
    ({"wildcard": {"tags": {"value": "RE?", "case_insensitive": True}}}, "15"), ({"nested": {"path": "people", "query": {"match": {"people.name": "ann"}}}}, "12"),
    ({"nested": {"path": "people", "query": {"bool": {"must": [{"match": {"people.name": "ann"}}, {"term": {"people.mail": "b@x"}}]}}}}, ""),
    ({"bool": {"must_not": [{"term": {"tags": "red"}}]}}, "234"), ({"bool": {"should": [{"term": {"tags": "red"}}, {"term": {"tags": "blue"}}, {"term": {"n": 10}}], "minimum_should_match": 2}}, "15"),
    ({"bool": {"filter": [{"term": {"tags": "red"}}], "should": [{"term": {"n": 1}}]}}, "15"), ({"term": {"nowhere": 1}}, ""), ({"ids": {"values": [1, "3"]}}, "13"),
    ({"geo_distance": {"distance": "10km", "at": {"lat": 40.71, "lon": -74.0}}}, "1"), ({"geo_bounding_box": {"at": {"top_left": {"lat": 52, "lon": -1}, "bottom_right": {"lat": 48, "lon": 3}}}}, "25"),
    ({"geo_shape": {"shape": {"shape": {"type": "Point", "coordinates": [2, 2]}, "relation": "contains"}}}, "3"),
])
def test_query(ids, query, want):
    assert ids(query) == want


def test_predicates(ids):
    assert ids(None, P.Compare("n", "!=", 42)) == "25"  # SQL: a missing value does not match
    assert ids(None, P.Like("name", "ada%", True)) == "14" and ids(None, P.Like("name", "%Br_wn")) == "24" and ids(None, P.Like("name", "Cy")) == "3" and ids(None, P.Like("name", "cY", True)) == "3"
    assert ids(None, P.Like("name", "A!%%", escape="!")) == "" and ids(None, P.contains("name", "a S")) == "1"
    assert ids(None, P.Null("job.pay")) == "345" and ids(None, P.Null("_id")) == "" and ids(None, P.In("n", (42, 87))) == "12"
    assert ids({"range": {"n": {"gt": 20}}}, P.Compare("job.pay", ">", 200.0) | P.Compare("job.place.city", "=", "Rome"), P.between("n", 1, 50)) == "1"
    assert ids(None, P.Compare("at", "=", geo.point(-74.0, 40.7))) == "1" and ids(None, P.Distance("at", -74.0, 40.7, ">", 1000)) == "2345"
    assert ids(None, P.Spatial("at", "within", geo.envelope(-1, 33, 3, 52))) == "25" and ids(None, P.Spatial("shape", "disjoint", geo.envelope(2, 1.5, 9, 9))) == "1"
    with pytest.raises(P.GeoRangeError, match="not supported on geo field 'at'"):
        ids(None, P.Compare("at", "<", geo.point(0, 0)))


def test_explain():
    r = resolve(MAPPING)
    dsl = lambda *p, **k: P.explain_dsl(r, list(p), **k)["query"]
    assert P.explain_dsl(r, [], columns=["name", "job.pay", "_id"]) == {"query": {"match_all": {}}, "_source": ["name", "job"]}
    assert dsl(P.Compare("old", "=", True)) == {"term": {"old": True}} and dsl(P.Compare("n", "!=", 1)) == {"bool": {"must_not": {"term": {"n": 1}}}}
    assert dsl(P.between("n", 1, 2), query={"match": {"note": "x"}}) == {"bool": {"must": [{"match": {"note": "x"}}, {"bool": {"must": [{"range": {"n": {"gte": 1}}}, {"range": {"n": {"lte": 2}}}]}}]}}
    assert dsl(P.Like("name", "a%", True)) == {"prefix": {"name.keyword": {"value": "a", "case_insensitive": True}}} and dsl(P.Like("tags", "%a_*")) == {"wildcard": {"tags": {"value": "*a?\\*"}}}
    assert dsl(P.Compare("note", "=", "x")) == {"match_all": {}} and dsl(P.Null("note")) == {"bool": {"must_not": {"exists": {"field": "note"}}}}
    assert dsl(P.Spatial("at", "within", geo.envelope(0, 1, 2, 3))) == {"geo_bounding_box": {"at": {"top_left": {"lat": 3, "lon": 0}, "bottom_right": {"lat": 1, "lon": 2}}}}
    fates = {("n", "="): "PUSHED", ("name", ">"): "PUSHED", ("note", "="): "FILTER", ("at", "!="): "FILTER", ("job.pay", "<"): "PUSHED", ("tags[1]", "="): "FILTER", ("_unmapped_.x", "="): "FILTER"}
    assert {k: P.Compare(k[0], k[1], 1).fate(r).value for k in fates} == fates


def test_limits_cache_sampling_settings(spark, catalog):
    ix.clear_cache()
    before = dict(ix.COUNTS)
    assert search(spark, "docs", limit=2, offset=4, catalog=catalog).count() == 1 and search(spark, "docs", limit=0, catalog=catalog).count() == 0
    a = search(spark, "docs", catalog=catalog)
    assert a.alias("a").join(a.alias("b"), "_id").count() == 5 and ix.COUNTS["mapping"] == before["mapping"] + 1
    flat = search(spark, "docs", sample_size=0, catalog=catalog)
    assert dict(flat.dtypes)["tags"] == "string" and dict(a.dtypes)["tags"] == "array<string>"
    assert dict(search(spark, "docs", {"term": {"_id": "2"}}, catalog=catalog).dtypes)["tags"] == "string" and ix.clear_cache()
    assert settings.current_settings(spark)["timeout"] == 30000
    spark.conf.set("docsearch.timeout", "5")
    assert settings.setting(spark, "timeout") == 5 and settings.setting(spark, "timeout", 7) == 7
    spark.conf.unset("docsearch.timeout")
    with pytest.raises(ValueError, match="requires 'index' parameter"):
        search(spark)
    with pytest.raises(TypeError):
        search(spark, "docs", nothing=1)
    assert '"term"' in explain(spark, "docs", where=[P.Compare("n", "=", 1), P.Compare("note", "=", "x")], catalog=catalog)


def test_merge():
    a, b = resolve({"properties": {"x": {"type": "long"}, "o": {"properties": {"p": {"type": "long"}}}}}), resolve({"properties": {"y": {"type": "text"}, "o": {"properties": {"q": {"type": "text"}}}}})
    assert [n for n, _ in merge({"a": a, "b": b}).columns] == ["x", "o", "y"] and merge({"a": a, "b": b}).type_of("o.q").simpleString() == "string"
    with pytest.raises(MappingConflict, match="Incompatible field types for 'x': index 'a' has type bigint, but index 'b' has type int"):
        merge({"a": a, "b": resolve({"properties": {"x": {"type": "integer"}}})})


@pytest.mark.parametrize("wkt", ["POINT (1 2)", "LINESTRING (0 0, 1 1.5)", "POLYGON ((0 0, 4 0, 4 4, 0 0), (1 1, 2 1, 2 2, 1 1))", "MULTIPOINT (1 2, 3 4)", "MULTIPOLYGON (((0 0, 1 0, 1 1, 0 0)))", "GEOMETRYCOLLECTION (POINT (1 2), LINESTRING (0 0, 1 1))"])
def test_geometry_round_trip(wkt):
    g = geo.from_wkt(wkt)
    assert geo.to_wkt(geo.from_wkb(geo.to_wkb(g))) == wkt and geo.from_geojson(json.dumps(g)) == g


class Store(BaseHTTPRequestHandler):
    seen: list = []
    fail = 0

    def answer(self, code, body):
        raw = json.dumps(body).encode()
        self.send_response(code)
        self.send_header("Content-Length", str(len(raw)))
        self.end_headers()
        self.wfile.write(raw)

    def do_GET(self):
        self.seen.append(("GET", self.path, None))
        if Store.fail:
            Store.fail -= 1
            return self.answer(503, {"error": "busy"})
        self.answer(200, {"docs": {"mappings": MAPPING}})

    def do_POST(self):
        body = json.loads(self.rfile.read(int(self.headers["Content-Length"])) or b"{}")
        self.seen.append(("POST", self.path, body))
        hits = [{"_id": k, "_source": v} for k, v in DOCS.items()]
        if self.path.startswith("/_search/scroll"):
            at = int(body["scroll_id"])
            return self.answer(200, {"_scroll_id": str(at + 2), "hits": {"hits": hits[at : at + 2]}})
        size = int(self.path.split("size=")[1].split("&")[0])
        self.answer(200, {"_scroll_id": str(size), "hits": {"hits": hits[:size]}} if "scroll=" in self.path else {"hits": {"hits": hits[:size]}})

    def do_DELETE(self):
        self.rfile.read(int(self.headers.get("Content-Length", 0)))
        self.seen.append(("DELETE", self.path, None))
        self.answer(200, {})

    def log_message(self, *a):
        pass


def test_remote(spark):
    server = HTTPServer(("127.0.0.1", 0), Store)
    threading.Thread(target=server.serve_forever, daemon=True).start()
    go = lambda **k: search_remote(spark, "docs", "127.0.0.1", server.server_port, retry_interval=1, **k)
    try:
        spark.conf.set("docsearch.batch_size", "2")
        Store.fail = 2
        rows = go(where=[P.Compare("n", ">", 20)], columns=["_id", "n"]).collect()
        assert sorted(r["_id"] for r in rows) == ["1", "2"]
        opened = next(b for m, p, b in Store.seen if m == "POST" and "scroll=" in p)
        assert opened == {"query": {"range": {"n": {"gt": 20}}}, "_source": ["n"]} and any(m == "DELETE" for m, _, _ in Store.seen)
        assert go(limit=3, columns=["_id"]).count() == 3 and any("size=3" in p for m, p, _ in Store.seen)
        Store.fail = 9
        ix.clear_cache()  # a warm search asks for no mapping
        with pytest.raises(Exception, match=r"HTTP 503.*after 2 retries"):
            go(max_retries=2)
    finally:
        spark.conf.unset("docsearch.batch_size")
        server.shutdown()
    with pytest.raises(Exception, match="request failed"):
        search_remote(spark, "docs", "127.0.0.1", 1, max_retries=0)


def test_elements_and_unmapped_paths(ids):
    """Predicates on list elements and on what the mapping does not name; beyond the end is null."""
    assert ids(None, P.Compare("tags[1]", "=", "red")) == "15" and ids(None, P.Compare("tags[2]", ">=", "b")) == "1" and ids(None, P.Compare("tags[1]", "!=", "red")) == "2"
    assert ids(None, P.In("tags[2]", ("7", "blue"))) == "15" and ids(None, P.Null("tags[9]")) == "12345" and ids(None, P.Like("tags[1]", "gr%")) == "2"
    assert ids(None, P.Compare("people[1].mail", "=", "c@x")) == "2" and ids(None, P.Null("people[2].name", False)) == "1"
    assert ids(None, P.Compare("_unmapped_.extra", "=", 10)) == "2" and ids(None, P.Compare("_unmapped_.extra.value", ">", 20)) == "3" and ids(None, P.Compare("_unmapped_.extra.value", ">", 20.3)) == ""
    assert ids(None, P.Compare("_unmapped_.extra.note", "=", "hm")) == "3" and ids(None, P.Like("_unmapped_.extra.note", "h%")) == "3" and ids(None, P.In("_unmapped_.extra", (10, 11))) == "2"
    assert ids(None, P.Null("_unmapped_.extra", False)) == "23" and ids(None, P.Null("_unmapped_")) == "15" and ids(None, P.Compare("_unmapped_.job.place.zip", "<=", 9)) == "4"
    assert ids(None, P.Compare("tags[1]", "=", "red") | P.Compare("_unmapped_.extra", "=", 10)) == "125"


def test_flipped_expressions_and_sums(ids):
    r = resolve(MAPPING)
    assert ids(None, P.flipped(42, "<", "n")) == "2" and P.flipped(1, "!=", "n") == P.Compare("n", "!=", 1)
    assert ids(None, P.plus("n", 10, ">", 52)) == "2" and P.explain_dsl(r, [P.plus("n", 10, ">", 50)])["query"] == {"range": {"n": {"gt": 40}}}
    assert ids(None, P.Expression("n > price AND random() >= 0", ("n", "price"))) == "1" and P.Expression("n > 1", ("n",)).fate(r).value == "FILTER"
    assert ids(None, P.Expression("CASE WHEN old THEN n ELSE 0 END = 87", ("n", "old"))) == "2"


@pytest.mark.parametrize(("limits", "want"), [
    ({"gte": "1995-11-22||/d", "lt": "1995-11-22||+1d/d"}, "2"), ({"gt": "2005-03||-1M", "lte": "2005-03||/M"}, "1"), ({"lte": "1970-01-01||/y"}, "3"), ({"lte": "now-1d/d", "gt": "now-40y"}, "12"), ({"gte": "0"}, "123"),
])
def test_date_arithmetic(ids, limits, want):
    assert ids({"range": {"born": limits}}) == want


def test_dates_that_are_none_are_refused(ids):
    from docquarry.operators.dsl import BadQuery, moment

    for bad in ("soon", "now-1x", "2024-13-01", "now+"):
        with pytest.raises(BadQuery, match="not a date"):
            ids({"range": {"born": {"gte": bad}}})
    assert moment("2024-02-29||+1y") == "2025-02-28T00:00:00" and moment("2024-05-15||/M", True) == "2024-05-31T23:59:59.999000" and moment("2024-05-15||/w") == "2024-05-13T00:00:00"


def test_bulk_files(spark, tmp_path):
    """Lines are paired within their file; blank lines and ranges of large files do not shift the pairs."""
    for name, ids_, gap in (("a", range(4), "\n"), ("b", range(4, 8), ""), ("c", range(8, 3000), "")):
        (tmp_path / f"{name}.jsonl").write_text("".join(f'{{"index": {{"_id": "{i}"}}}}\n{gap}{{"n": {i}}}\n' for i in ids_))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        got = {x["_id"]: x["_source"] for x in ix.bulk_lines(spark, str(tmp_path)).collect()}
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert got == {str(i): f'{{"n": {i}}}' for i in range(3000)}


def test_warm_search_sends_no_mapping_request(spark):
    """Also: negated predicates are sent, and a limit with one is not; explain tells what is sent; the log; a view for SQL."""
    server = HTTPServer(("127.0.0.1", 0), Store)
    threading.Thread(target=server.serve_forever, daemon=True).start()
    ix.clear_cache()
    Store.fail = 0
    go = lambda **k: search_remote(spark, "docs", "127.0.0.1", server.server_port, username="me", password="secret", **k)
    try:
        go()
        Store.seen.clear()
        where = [P.Compare("n", "!=", 42)]
        assert [r["_id"] for r in go(where=where, columns=["_id"], limit=1).collect()] == ["2"]
        assert not any(m == "GET" or "/_search?size=" in p for m, p, _ in Store.seen)
        sent = next(b for m, p, b in Store.seen if m == "POST" and "scroll=" in p)
        assert sent["query"] == {"bool": {"must_not": {"term": {"n": 42}}}} == P.explain_dsl(resolve(MAPPING), where)["query"]
        rows = http_log(spark).collect()
        assert any(x["type"] == "GET" and x["status"] == 200 and x["reason"] == "OK" and x["url"].endswith("/docs/_mapping") for x in rows)
        assert all("Authorization" not in x["request_headers"] for x in rows)
        create_view(spark, "remote_docs", "docs", host="127.0.0.1", port=server.server_port)
        assert spark.sql("SELECT count(*) FROM remote_docs WHERE n > 20").first()[0] == 2
    finally:
        server.shutdown()


def test_client_keeps_its_connection_and_logs_in_at_the_proxy():
    class Kept(Store):
        protocol_version = "HTTP/1.1"
        made: list = []

        def setup(self):
            super().setup()
            Kept.made.append(1)

        def do_GET(self):
            Kept.head = dict(self.headers)
            raw = gzip.compress(json.dumps({"docs": {"mappings": MAPPING}, "path": self.path}).encode())
            self.send_response(200)
            self.send_header("Content-Encoding", "gzip")
            self.send_header("Content-Length", str(len(raw)))
            self.end_headers()
            self.wfile.write(raw)

    server = HTTPServer(("127.0.0.1", 0), Kept)
    threading.Thread(target=server.serve_forever, daemon=True).start()
    try:
        client = Client("127.0.0.1", server.server_port, username="u", password="p")
        assert len([client.send("GET", "/docs/_mapping") for _ in range(3)]) == 3 and len(Kept.made) == 1
        assert Kept.head["Authorization"] == "Basic dTpw"
        client.close()
        via = Client("store.invalid", 9200, proxy=f"http://me:s%40y@127.0.0.1:{server.server_port}")
        assert via.send("GET", "/docs/_mapping")["path"] == "http://store.invalid:9200/docs/_mapping" and Kept.head["Proxy-Authorization"] == "Basic bWU6c0B5"
        via.close()
    finally:
        server.shutdown()


def test_geometry_columns_are_the_kernel(spark):
    """Columns, which take points in arrays, against the kernel one by one."""
    shapes = [geo.envelope(0, 0, 4, 4), geo.from_wkt("POLYGON ((0 0, 6 0, 6 6, 0 6, 0 0), (2 2, 4 2, 4 4, 2 4, 2 2))"), geo.from_wkt("LINESTRING (0 0, 4 4)"), geo.from_wkt("MULTIPOLYGON (((0 0, 1 0, 1 1, 0 0)), ((3 3, 5 3, 5 5, 3 5, 3 3)))"), geo.point(2, 2)]
    values = [geo.point(x / 2, y / 2) for x in range(-1, 14) for y in range(-1, 14)] + shapes + [geo.from_wkt("LINESTRING (9 9, 8 8)"), geo.from_wkt("MULTIPOINT (1 1, 9 9)")]
    df = spark.createDataFrame([(i, geo.to_wkb(g)) for i, g in enumerate(values)] + [(-1, None), (-2, b"bad")], "i int, g binary")
    for shape in shapes:
        for name, f in (("intersects", geo.intersects), ("disjoint", lambda a, b: not geo.intersects(a, b)), ("within", geo.within), ("contains", lambda a, b: geo.within(b, a))):
            got = {r[0]: r[1] for r in df.select("i", geo.relation(df["g"], name, shape)).collect()}
            assert got == {i: f(g, shape) for i, g in enumerate(values)} | {-1: None, -2: None}, (name, shape)
    got = {r[0]: r[1] for r in df.select("i", geo.metres(df["g"], 2.5, 1.0)).collect()}
    assert all(got[i] == pytest.approx(geo.distance(g, [2.5, 1.0])) for i, g in enumerate(values)) and got[-1] is got[-2] is None
    assert {r[0]: r[1] for r in df.select("i", geo.as_wkt(df["g"])).collect()} == {i: geo.to_wkt(g) for i, g in enumerate(values)} | {-1: None, -2: None}


def test_table_function(spark):
    """SQL's call form: named arguments, a schema that follows from the mapping, the same values as decoding gives."""
    server = HTTPServer(("127.0.0.1", 0), Store)
    threading.Thread(target=server.serve_forever, daemon=True).start()
    Store.fail = 0
    register_table_function(spark, "docs_of")
    try:
        call = f"docs_of(index => 'docs', host => '127.0.0.1', port => {server.server_port})"
        rows = {x["_id"]: x for x in spark.sql(f"SELECT * FROM {call}").collect()}
        own = {x["_id"]: x for x in search_remote(spark, "docs", "127.0.0.1", server.server_port).collect()}
        for k, x in own.items():
            for c in x.asDict():
                if c == "_unmapped_":
                    assert (json.loads(rows[k][c], parse_float=Decimal) if rows[k][c] else None) == (x[c].toPython() if x[c] else None)
                else:
                    assert rows[k][c] == x[c], (k, c)
        assert spark.sql(f"SELECT sum(n) FROM {call} WHERE job.place.city = 'Rome'").first()[0] == 42
        with pytest.raises(Exception, match="unknown arguments"):
            spark.sql(f"SELECT * FROM docs_of(index => 'docs', host => '127.0.0.1', port => {server.server_port}, nothing => 1)").collect()
    finally:
        server.shutdown()


@pytest.mark.parametrize(("name", "given", "other"), [("verify_ssl", False, True), ("timeout", 5, 6), ("max_retries", 0, 1), ("retry_interval", 1, 2), ("retry_backoff_factor", 1.5, 3.0), ("sample_size", 0, 7), ("batch_size", 10, 11), ("batch_size_threshold_factor", 2, 3), ("scroll_time", "1m", "2m")])
def test_settings_precedence(spark, name, given, other):
    """Argument, then session, then default; RESET brings the default back."""
    default = settings.setting(spark, name)
    spark.sql(f"SET docsearch.{name} = {given}")
    try:
        assert settings.setting(spark, name) == given == settings.current_settings(spark)[name] and settings.setting(spark, name, other) == other
    finally:
        spark.sql(f"RESET docsearch.{name}")
    assert settings.setting(spark, name) == default


def test_waits_grow(monkeypatch):
    """Waits of 100, 200, 400 ms; other statuses are not sent again."""
    waits, answers = [], [503, 429, 500, 200]
    monkeypatch.setattr("docquarry.sources.remote.time.sleep", waits.append)
    monkeypatch.setattr(Client, "once", lambda self, method, path, body: (answers.pop(0), "{}"))
    assert Client().send("GET", "/x") == {} and waits == [0.1, 0.2, 0.4]
    answers[:] = [404, 200]
    with pytest.raises(StoreError, match="HTTP 404"):
        Client().send("GET", "/x")
    assert answers == [200]


def test_ssl(tmp_path):
    """A certificate that nobody vouches for is refused, unless it need not be verified."""
    import shutil
    import ssl
    import subprocess

    if not shutil.which("openssl"):
        pytest.skip("needs openssl for a certificate")
    key, cert = str(tmp_path / "key.pem"), str(tmp_path / "cert.pem")
    subprocess.run(["openssl", "req", "-x509", "-newkey", "rsa:2048", "-nodes", "-days", "2", "-subj", "/CN=localhost", "-keyout", key, "-out", cert], check=True, capture_output=True)
    server = HTTPServer(("127.0.0.1", 0), Store)
    context = ssl.SSLContext(ssl.PROTOCOL_TLS_SERVER)
    context.load_cert_chain(cert, key)
    server.socket = context.wrap_socket(server.socket, server_side=True)
    threading.Thread(target=server.serve_forever, daemon=True).start()
    Store.fail = 0
    try:
        with pytest.raises(StoreError, match="request failed"):
            Client("127.0.0.1", server.server_port, use_ssl=True, max_retries=0).mapping("docs")
        assert "name" in Client("127.0.0.1", server.server_port, use_ssl=True, verify_ssl=False).mapping("docs").kinds
    finally:
        server.shutdown()


def test_asof_join(spark):
    """Ties, null keys, no earlier row; against a loop."""
    from docquarry.operators.asof import asof_join

    left = [(i, k, t) for i, (k, t) in enumerate([("a", 5), ("a", 1), ("b", 7), (None, 3), ("a", None), ("c", 9), ("a", 5)])]
    right = [("a", 2, "x"), ("a", 5, "y"), ("a", 5, "z"), ("b", 8, "w"), (None, 1, "n"), ("c", 9, None)]
    got = asof_join(spark.createDataFrame(left, "i int, k string, t int"), spark.createDataFrame(right, "k string, t int, v string"), "k", "t")
    assert {x["i"]: (x["v"], x["t_matched"]) for x in got.collect()} == {0: ("z", 5), 1: (None, None), 2: (None, None), 3: (None, None), 4: (None, None), 5: (None, 9), 6: ("z", 5)}
