"""The queries of the catalogue, each with its SQL.

Documents, parts, customers, orders and events are indices over tables (typed, so scans prune and push down) and over
JSON text (decoded). Longitude and latitude are integer arithmetic on keys, so both engines agree exactly.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import geometry as geo
from ..functions.mapping import resolve
from ..operators import predicates as P
from ..operators.asof import asof_join
from ..operators.decode import decode
from ..operators.dsl import compile_query
from ..search import create_view, search
from ..sources.index import Catalog, Index

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}

_TEXT = {"type": "text"}
_BOTH = {"type": "text", "fields": {"keyword": {"type": "keyword"}}}
_WORD, _LONG, _INT, _REAL, _DATE = ({"type": t} for t in ("keyword", "long", "integer", "double", "date"))
MAPPINGS = {
    "documents": {"text": _TEXT, "lang": _WORD, "source": _WORD, "n_chars": _LONG, "toxic": _INT},
    "chats": {"text": _TEXT, "role": _WORD, "turn": _LONG},
    "parts": {"p_name": _BOTH, "p_brand": _WORD, "p_type": _WORD, "p_size": _INT, "p_retailprice": _REAL},
    "events": {"ts": _DATE, "user_id": _LONG, "event_type": _WORD, "value": _REAL},
    "customers": {"c_name": _BOTH, "c_acctbal": _REAL, "who": {"properties": {"segment": _WORD, "place": {"properties": {"nation": _INT}}}}, "lon": _LONG, "lat": _LONG},
    "orders": {"o_custkey": _LONG, "o_totalprice": _REAL, "o_orderdate": _DATE, "o_orderstatus": _WORD, "lines": {"type": "nested", "properties": {"number": _INT, "quantity": _REAL}}},
    "vectors": {"label": _INT, "embedding": {"type": "float"}},
}


def indices(sf_dir: str) -> Catalog:
    """The indices over one folder of tables."""
    table = lambda s, n: s.read.parquet(f"{sf_dir}/{n}.parquet")
    key = lambda c: F.col(c).cast("string").alias("_id")

    def documents(s: SparkSession) -> DataFrame:
        labels = table(s, "labels").select("doc_id", "toxic")
        return table(s, "documents").join(labels, "doc_id", "left").select(key("doc_id"), "text", "lang", "source", "n_chars", "toxic")

    def customers(s: SparkSession) -> DataFrame:
        k = F.col("c_custkey")
        who = F.struct(F.col("c_mktsegment").alias("segment"), F.struct(F.col("c_nationkey").alias("nation")).alias("place"))
        return table(s, "customer").select(key("c_custkey"), "c_name", "c_acctbal", who.alias("who"), (k * 37 % 360 - 180).alias("lon"), (k * 17 % 180 - 90).alias("lat"))

    def orders(s: SparkSession) -> DataFrame:
        lines = table(s, "lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.sort_array(F.collect_list(F.struct(F.col("l_linenumber").alias("number"), F.col("l_quantity").alias("quantity")))).alias("lines"))
        return table(s, "orders").join(lines, "o_orderkey", "left").select(key("o_orderkey"), "o_custkey", "o_totalprice", "o_orderdate", "o_orderstatus", "lines")

    out = Catalog()
    loads = {
        "documents": documents,
        "chats": lambda s: table(s, "conversations").select(F.concat_ws("-", "conv_id", "turn").alias("_id"), "text", "role", "turn"),
        "parts": lambda s: table(s, "part").select(key("p_partkey"), "p_name", "p_brand", "p_type", "p_size", "p_retailprice"),
        "events": lambda s: table(s, "events").select(key("event_id"), "ts", "user_id", "event_type", "value", F.try_parse_json("props").alias("_unmapped_")),
        "customers": customers,
        "orders": orders,
        "vectors": lambda s: table(s, "embeddings").select(key("vec_id"), "label", "embedding"),
    }
    for name, load in loads.items():
        out.add(Index(name, {"properties": MAPPINGS[name]}, load, typed=True))
    return out


def _add(name: str, sql: str, make: Callable[[SparkSession, str, Callable], DataFrame]) -> None:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        catalog = indices(sf_dir)

        def find(index: str, query=None, *where: P.Predicate, columns=None, limit=None, offset=0) -> DataFrame:
            return search(spark, index, query, where, columns, limit, offset, sample_size=0, catalog=catalog)

        return make(spark, sf_dir, find)

    QUERIES[name], SQL[name] = run, sql


_DOC = "(SELECT d.doc_id::VARCHAR AS _id, text, lang, source, n_chars, toxic FROM documents d LEFT JOIN labels l USING (doc_id))"
_TOK = r"list_filter(string_split_regex(lower(text), '[^\p{L}\p{N}]+'), lambda x: x <> '')"
_PART = "(SELECT p_partkey::VARCHAR AS _id, * FROM part)"
_EVENT = "(SELECT event_id::VARCHAR AS _id, * FROM events)"
_CUST = "(SELECT c_custkey::VARCHAR AS _id, *, c_custkey * 37 % 360 - 180 AS lon, c_custkey * 17 % 180 - 90 AS lat FROM customer)"


def _ids(name: str, index: str, source: str, condition: str, query=None, *where: P.Predicate) -> None:
    """A query that returns the ids that match."""
    _add(name, f"SELECT _id FROM {source} WHERE {condition}", lambda s, d, find: find(index, query, *where, columns=["_id"]))


# Scans, projections, predicates
_add("scan_all", f"SELECT * FROM {_DOC}", lambda s, d, f: f("documents").drop("_unmapped_"))
_add("projection", f"SELECT _id, p_brand, p_size FROM {_PART}", lambda s, d, f: f("parts", columns=["_id", "p_brand", "p_size"]))
_add("projection_expression", f"SELECT _id, upper(p_brand) AS brand, p_size * 2 AS twice, round(p_retailprice, 1) AS price, length(p_name) AS n FROM {_PART}", lambda s, d, f: f("parts").select("_id", F.upper("p_brand").alias("brand"), (F.col("p_size") * 2).alias("twice"), F.round("p_retailprice", 1).alias("price"), F.length("p_name").cast("long").alias("n")))
for _n, _op in (("eq", "="), ("ne", "!="), ("gt", ">"), ("ge", ">="), ("lt", "<"), ("le", "<=")):
    _ids(f"filter_{_n}", "parts", _PART, f"p_size {_op} 25", None, P.Compare("p_size", _op, 25))
_ids("filter_string", "documents", _DOC, "lang = 'en' AND source != 'src1'", None, P.Compare("lang", "=", "en"), P.Compare("source", "!=", "src1"))
_ids("filter_ne_missing", "documents", _DOC, "toxic <> 1", None, P.Compare("toxic", "!=", 1))
_ids("filter_date", "events", _EVENT, "ts >= TIMESTAMP '2024-01-15'", None, P.Compare("ts", ">=", "2024-01-15"))
_ids("filter_between", "documents", _DOC, "n_chars BETWEEN 500 AND 1500", None, P.between("n_chars", 500, 1500))
_ids("filter_in", "parts", _PART, "p_size IN (1, 5, 9)", None, P.In("p_size", (1, 5, 9)))
_ids("is_null", "documents", _DOC, "toxic IS NULL", None, P.Null("toxic"))
_ids("is_not_null", "documents", _DOC, "toxic IS NOT NULL", None, P.Null("toxic", False))
_ids("like_prefix", "parts", _PART, "p_type LIKE 'S%'", None, P.Like("p_type", "S%"))
_ids("like_suffix", "parts", _PART, "p_type LIKE '%L'", None, P.Like("p_type", "%L"))
_ids("like_contains", "customers", _CUST, "c_name LIKE '%00001%'", None, P.contains("c_name", "00001"))
_ids("like_underscore", "parts", _PART, "p_brand LIKE 'Brand__3'", None, P.Like("p_brand", "Brand__3"))
_ids("ilike", "parts", _PART, "p_type ILIKE '%m%d'", None, P.Like("p_type", "%m%d", True))
_ids("ilike_plain", "documents", _DOC, "lang ILIKE 'EN'", None, P.Like("lang", "EN", True))
_ids("and_or_mix", "documents", _DOC, "(lang = 'en' AND n_chars > 2000) OR source = 'src3'", None, (P.Compare("lang", "=", "en") & P.Compare("n_chars", ">", 2000)) | P.Compare("source", "=", "src3"))
_ids("nested_struct_filter", "customers", _CUST, "c_nationkey > 20 AND c_mktsegment = 'BUILDING'", None, P.Compare("who.place.nation", ">", 20), P.Compare("who.segment", "=", "BUILDING"))
_ids("id_is_null", "parts", _PART, "_id IS NULL", None, P.Null("_id"))
_ids("id_eq", "parts", _PART, "_id = '17'", None, P.Compare("_id", "=", "17"))
_add("struct_access", "SELECT c_custkey::VARCHAR AS _id, c_mktsegment AS segment, c_nationkey AS nation FROM customer", lambda s, d, f: f("customers").select("_id", F.col("who.segment").alias("segment"), F.col("who.place.nation").alias("nation")))
_add("case_when", f"SELECT _id, CASE WHEN p_size > 40 THEN 'large' WHEN p_size > 10 THEN 'middle' ELSE 'small' END AS size FROM {_PART}", lambda s, d, f: f("parts").select("_id", F.when(F.col("p_size") > 40, "large").when(F.col("p_size") > 10, "middle").otherwise("small").alias("size")))

# Lists
_VEC = "(SELECT vec_id::VARCHAR AS _id, * FROM embeddings)"
_add("array_length", f"SELECT _id, len(embedding)::BIGINT AS n FROM {_VEC}", lambda s, d, f: f("vectors").select("_id", F.size("embedding").cast("long").alias("n")))
_ids("array_element", "vectors", _VEC, "embedding[1] > 0", None, P.Compare("embedding[1]", ">", 0.0))
_ids("array_element_between", "vectors", _VEC, "embedding[3] BETWEEN -0.1 AND 0.1 AND label > 1", None, P.between("embedding[3]", -0.1, 0.1), P.Compare("label", ">", 1))
_ids("array_element_or", "vectors", _VEC, "embedding[2] > 0.1 OR label = 3", None, P.Compare("embedding[2]", ">", 0.1) | P.Compare("label", "=", 3))
_add("array_contains", r"SELECT doc_id::VARCHAR AS _id FROM documents WHERE list_contains(string_split(text, ' '), 'the')", lambda s, d, f: f("documents", columns=["_id", "text"]).where(F.array_contains(F.split("text", " "), "the")).select("_id"))
_add("array_element_missing", "SELECT count(*) AS n FROM embeddings WHERE embedding[9999] IS NULL", lambda s, d, f: f("vectors", None, P.Null("embedding[9999]"), columns=["_id"]).agg(F.count("*").alias("n")))
_ids("dsl_any_element", "vectors", _VEC, "len(list_filter(embedding, lambda x: x >= 0.3)) > 0", {"range": {"embedding": {"gte": 0.3}}})
_LINES = "(SELECT l_orderkey::VARCHAR AS _id, list({'number': l_linenumber, 'quantity': l_quantity} ORDER BY l_linenumber, l_quantity) AS lines FROM lineitem GROUP BY l_orderkey)"
_ids("struct_list_element", "orders", _LINES, "lines[1].quantity > 40", None, P.Compare("lines[1].quantity", ">", 40.0))
_add("struct_list_projection", f"SELECT _id, lines[2].number AS number, lines[2].quantity AS quantity FROM {_LINES}", lambda s, d, f: f("orders", None, P.Null("lines", False)).select("_id", F.try_element_at("lines", F.lit(2))["number"].alias("number"), F.try_element_at("lines", F.lit(2))["quantity"].alias("quantity")))
_add("unnest_list_zip", "SELECT l_orderkey::VARCHAR AS _id, l_linenumber AS number, l_quantity AS quantity FROM lineitem", lambda s, d, f: f("orders", None, P.Null("lines", False)).select("_id", F.explode(F.arrays_zip(F.col("lines.number").alias("number"), F.col("lines.quantity").alias("quantity"))).alias("x")).select("_id", "x.number", "x.quantity"))

# Predicates that are not pushed, and those that are once they are normalised
_ids("filter_flipped", "parts", _PART, "25 < p_size", None, P.flipped(25, "<", "p_size"))
_ids("filter_arithmetic", "parts", _PART, "p_size + 10 > 50", None, P.plus("p_size", 10, ">", 50))
_ids("filter_null_constant", "parts", _PART, "p_size = NULL", None, P.Compare("p_size", "=", None))
_ids("filter_columns", "parts", _PART, "p_size * 40 > p_retailprice", None, P.Expression("p_size * 40 > p_retailprice", ("p_size", "p_retailprice")))
_ids("filter_case", "parts", _PART, "CASE WHEN p_size > 25 THEN p_brand ELSE p_type END LIKE 'B%'", None, P.Expression("CASE WHEN p_size > 25 THEN p_brand ELSE p_type END LIKE 'B%'", ("p_size", "p_brand", "p_type")))
_ids("filter_volatile", "parts", _PART, "random() >= 0 AND p_size = 7", None, P.Expression("random() >= 0"), P.Compare("p_size", "=", 7))
_add("type_names", "SELECT DISTINCT typeof(p_size) AS size, typeof(p_name) AS name, typeof(p_retailprice) AS price FROM part", lambda s, d, f: f("parts").select(*[F.upper(F.replace(F.replace(F.expr(f"typeof({c})"), F.lit("int"), F.lit("integer")), F.lit("string"), F.lit("varchar"))).alias(n) for c, n in (("p_size", "size"), ("p_name", "name"), ("p_retailprice", "price"))]).distinct())

# Query clauses
_ids("text_match_or", "documents", _DOC, f"list_has_any({_TOK}, ['thonre', 'eher', 'anblewh', 'the']) AND lang = 'en' AND n_chars > 500", {"match": {"text": "thonre Eher anblewh the"}}, P.Compare("lang", "=", "en"), P.Compare("n_chars", ">", 500))
_ids("text_match_and", "documents", _DOC, f"list_has_all({_TOK}, ['the', 'of', 'er'])", {"match": {"text": {"query": "the of er", "operator": "and"}}})
_ids("match_phrase", "documents", _DOC, rf"contains(' ' || array_to_string({_TOK}, ' ') || ' ', ' of the ')", {"match_phrase": {"text": "of the"}})
_ids("match_phrase_prefix", "documents", _DOC, rf"contains(' ' || array_to_string({_TOK}, ' ') || ' ', ' of th')", {"match_phrase_prefix": {"text": "of th"}})
_ids("dsl_match_minimum", "documents", _DOC, f"len(list_distinct(list_filter({_TOK}, lambda x: x IN ('the', 'of', 'er', 'with')))) >= 3", {"match": {"text": {"query": "the of er with", "minimum_should_match": 3}}})
_ids("dsl_term", "documents", _DOC, "source = 'src2'", {"term": {"source": "src2"}})
_ids("dsl_term_text", "documents", _DOC, f"list_contains({_TOK}, 'the')", {"term": {"text": "the"}})
_ids("dsl_terms", "parts", _PART, "p_size IN (3, 4)", {"terms": {"p_size": [3, 4]}})
_ids("dsl_range", "parts", _PART, "p_size >= 10 AND p_size < 20", {"range": {"p_size": {"gte": 10, "lt": 20}}})
_ids("dsl_range_date", "events", _EVENT, "ts < TIMESTAMP '2024-01-10'", {"range": {"ts": {"lt": "2024-01-10"}}})
_ids("dsl_date_arithmetic", "events", _EVENT, "ts >= TIMESTAMP '2024-01-08' AND ts < TIMESTAMP '2024-01-11'", {"range": {"ts": {"gte": "2024-01-10||/w", "lt": "2024-01-10T15:00:00||+1d/d"}}})
_ids("dsl_match_all", "parts", _PART, "true", {"match_all": {}})
_ids("dsl_bool_filter", "parts", _PART, "p_size > 40 AND p_brand = 'Brand#13'", {"bool": {"filter": [{"range": {"p_size": {"gt": 40}}}, {"term": {"p_brand": "Brand#13"}}]}})
_ids("dsl_wildcard_ci", "parts", _PART, "p_brand ILIKE 'b%_3'", {"wildcard": {"p_brand": {"value": "b*?3", "case_insensitive": True}}})
_ids("dsl_exists", "documents", _DOC, "toxic IS NOT NULL", {"exists": {"field": "toxic"}})
_ids("dsl_prefix", "parts", _PART, "starts_with(p_name, 'b')", {"prefix": {"p_name.keyword": {"value": "b"}}})
_ids("dsl_prefix_ci", "parts", _PART, "starts_with(lower(p_type), 'st')", {"prefix": {"p_type": {"value": "St", "case_insensitive": True}}})
_ids("dsl_wildcard", "parts", _PART, "p_brand LIKE 'B%_3'", {"wildcard": {"p_brand": {"value": "B*?3"}}})
_ids("dsl_bool_must", "parts", _PART, "p_size > 5 AND p_brand = 'Brand#13' OR false", {"bool": {"must": [{"range": {"p_size": {"gt": 5}}}, {"term": {"p_brand": "Brand#13"}}]}})
_ids("dsl_bool_should_msm", "parts", _PART, "(p_size > 25)::INT + (p_brand = 'Brand#13')::INT + (p_retailprice > 1000)::INT >= 2", {"bool": {"should": [{"range": {"p_size": {"gt": 25}}}, {"term": {"p_brand": "Brand#13"}}, {"range": {"p_retailprice": {"gt": 1000}}}], "minimum_should_match": 2}})
_ids("dsl_must_not", "documents", _DOC, "toxic IS NULL OR toxic <> 1", {"bool": {"must_not": [{"term": {"toxic": 1}}]}})
_ids("dsl_unknown_field", "documents", _DOC, "false", {"term": {"lang.keyword.more": "en"}})
_ids("dsl_nested", "orders", "(SELECT DISTINCT l_orderkey::VARCHAR AS _id FROM lineitem WHERE l_quantity >= 49 AND l_linenumber = 1)", "true", {"nested": {"path": "lines", "query": {"bool": {"must": [{"range": {"lines.quantity": {"gte": 49}}}, {"term": {"lines.number": 1}}]}}}})
_ids("dsl_nested_struct", "customers", _CUST, "c_nationkey = 7", {"term": {"who.place.nation": 7}})
_ids("base_query_merge", "documents", _DOC, f"list_contains({_TOK}, 'the') AND n_chars > 1000", {"match": {"text": "the"}}, P.Compare("n_chars", ">", 1000))

# Limits, sorting
_add("limit_count", "SELECT 7 AS n", lambda s, d, f: f("parts", columns=["_id"], limit=7).agg(F.count("*").cast("int").alias("n")))
_add("offset_count", "SELECT (count(*) - 11)::BIGINT AS n FROM part", lambda s, d, f: f("parts", columns=["_id"], offset=11).agg(F.count("*").alias("n")))
_add("limit_zero", "SELECT 0::BIGINT AS n", lambda s, d, f: f("parts", columns=["_id"], limit=0, offset=5).agg(F.count("*").alias("n")))
_add("topk", f"SELECT _id, p_retailprice FROM {_PART} ORDER BY p_retailprice DESC, _id LIMIT 10", lambda s, d, f: f("parts", columns=["_id", "p_retailprice"]).orderBy(F.desc("p_retailprice"), "_id").limit(10))
_add("topk_offset", f"SELECT _id, n_chars FROM {_DOC} ORDER BY n_chars DESC, _id LIMIT 5 OFFSET 3", lambda s, d, f: f("documents", columns=["_id", "n_chars"]).orderBy(F.desc("n_chars"), "_id").offset(3).limit(5))

# Aggregations
_add("group_by", "SELECT lang, count(*) AS n, sum(n_chars)::BIGINT AS chars FROM documents GROUP BY lang", lambda s, d, f: f("documents").groupBy("lang").agg(F.count("*").alias("n"), F.sum("n_chars").alias("chars")))
_add("group_by_null", f"SELECT toxic, lang, count(*) AS n, count(toxic) AS known FROM {_DOC} GROUP BY toxic, lang", lambda s, d, f: f("documents").groupBy("toxic", "lang").agg(F.count("*").alias("n"), F.count("toxic").alias("known")))
_add("having", "SELECT source, count(*) AS n FROM documents GROUP BY source HAVING count(*) > 40", lambda s, d, f: f("documents").groupBy("source").agg(F.count("*").alias("n")).where("n > 40"))
_add("distinct", "SELECT DISTINCT lang, source FROM documents", lambda s, d, f: f("documents", columns=["lang", "source"]).distinct())
_add("min_max_avg", "SELECT min(p_size) AS lo, max(p_size) AS hi, avg(p_size) AS mean FROM part", lambda s, d, f: f("parts").agg(F.min("p_size").alias("lo"), F.max("p_size").alias("hi"), F.avg("p_size").alias("mean")))
_add("avg_struct_field", "SELECT avg(c_nationkey) AS mean FROM customer", lambda s, d, f: f("customers").agg(F.avg("who.place.nation").alias("mean")))

_add("count_distinct", "SELECT p_brand, count(DISTINCT p_size) AS sizes, count(DISTINCT p_type) AS types FROM part GROUP BY p_brand", lambda s, d, f: f("parts").groupBy("p_brand").agg(F.count_distinct("p_size").alias("sizes"), F.count_distinct("p_type").alias("types")))
_add("rollup", "SELECT lang, source, count(*) AS n FROM documents GROUP BY ROLLUP (lang, source)", lambda s, d, f: f("documents").rollup("lang", "source").agg(F.count("*").alias("n")))
_add("cube", "SELECT lang, source, count(*) AS n, grouping(lang) AS g FROM documents GROUP BY CUBE (lang, source)", lambda s, d, f: f("documents").cube("lang", "source").agg(F.count("*").alias("n"), F.grouping("lang").cast("long").alias("g")))
_add("filtered_aggregate", "SELECT lang, count(*) FILTER (WHERE n_chars > 1000) AS long, count(*) AS n FROM documents GROUP BY lang", lambda s, d, f: f("documents").groupBy("lang").agg(F.count_if(F.col("n_chars") > 1000).alias("long"), F.count("*").alias("n")))
_add("pivot", "SELECT source, count(*) FILTER (WHERE lang = 'de') AS de, count(*) FILTER (WHERE lang = 'en') AS en FROM documents GROUP BY source", lambda s, d, f: f("documents").groupBy("source").pivot("lang", ["de", "en"]).agg(F.count("lang").alias("n")).fillna(0))
_add("window_rank", "SELECT _id, p_brand, rank() OVER (PARTITION BY p_brand ORDER BY p_size DESC) AS place FROM (SELECT p_partkey::VARCHAR AS _id, * FROM part)", lambda s, d, f: f("parts").select("_id", "p_brand", F.rank().over(Window.partitionBy("p_brand").orderBy(F.desc("p_size"))).cast("long").alias("place")))
_add("window_running", "SELECT event_id::VARCHAR AS _id, count(*) OVER w AS n, max(event_id) OVER w AS latest FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN 3 PRECEDING AND CURRENT ROW)", lambda s, d, f: (lambda w: f("events").select(F.col("_id").cast("long").alias("event_id"), "user_id", "ts").select(F.col("event_id").cast("string").alias("_id"), F.count("*").over(w).alias("n"), F.max("event_id").over(w).alias("latest")))(Window.partitionBy("user_id").orderBy("ts", "event_id").rowsBetween(-3, 0)))

# Joins, subqueries, sets
_add("inner_join", "SELECT doc_id::VARCHAR AS _id, lang, quality FROM documents JOIN labels USING (doc_id)", lambda s, d, f: f("documents", columns=["_id", "lang"]).join(s.read.parquet(f"{d}/labels.parquet").select(F.col("doc_id").cast("string").alias("_id"), "quality"), "_id"))
_add("left_join", "SELECT d.doc_id::VARCHAR AS _id, quality FROM documents d LEFT JOIN labels l USING (doc_id) WHERE lang IN ('en', 'de')", lambda s, d, f: f("documents", None, P.In("lang", ("en", "de")), columns=["_id"]).join(s.read.parquet(f"{d}/labels.parquet").select(F.col("doc_id").cast("string").alias("_id"), "quality"), "_id", "left"))
_add("self_join_cte", "WITH c AS (SELECT lang, count(*) AS n FROM documents GROUP BY lang) SELECT a.lang AS a, b.lang AS b FROM c a JOIN c b ON a.n < b.n", lambda s, d, f: (lambda c: c.alias("a").join(c.alias("b"), F.col("a.n") < F.col("b.n")).select(F.col("a.lang").alias("a"), F.col("b.lang").alias("b")))(f("documents").groupBy("lang").agg(F.count("*").alias("n"))))
_add("in_subquery", "SELECT o_orderkey::VARCHAR AS _id FROM orders WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_acctbal < 0)", lambda s, d, f: f("orders", columns=["_id", "o_custkey"]).join(f("customers", None, P.Compare("c_acctbal", "<", 0.0), columns=["_id"]).select(F.col("_id").cast("long").alias("o_custkey")), "o_custkey", "left_semi").select("_id"))
_add("not_in_subquery", "SELECT c_custkey::VARCHAR AS _id FROM customer WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_totalprice > 300000)", lambda s, d, f: f("customers", columns=["_id"]).join(f("orders", None, P.Compare("o_totalprice", ">", 300000.0)).select(F.col("o_custkey").cast("string").alias("_id")), "_id", "left_anti"))


_SIZES = "(SELECT p_size AS k, count(*) AS parts FROM part WHERE p_size < 30 GROUP BY p_size)"
_OTHERS = "(SELECT c_nationkey AS k, count(*) AS customers FROM customer GROUP BY c_nationkey)"


def _two(f: Callable) -> tuple[DataFrame, DataFrame]:
    sizes = f("parts", None, P.Compare("p_size", "<", 30)).groupBy(F.col("p_size").alias("k")).agg(F.count("*").alias("parts"))
    return sizes, f("customers").groupBy(F.col("who.place.nation").alias("k")).agg(F.count("*").alias("customers"))


for _n, _kind in (("full", "FULL"), ("right", "RIGHT")):
    _add(f"{_n}_join", f"SELECT k, parts, customers FROM {_SIZES} {_kind} JOIN {_OTHERS} USING (k)", lambda s, d, f, how=_n: (lambda x: x[0].join(x[1], "k", how))(_two(f)))
_add("cross_join", "SELECT a.lang AS a, b.r_name AS b FROM (SELECT DISTINCT lang FROM documents) a CROSS JOIN region b", lambda s, d, f: f("documents", columns=["lang"]).distinct().select(F.col("lang").alias("a")).crossJoin(s.read.parquet(f"{d}/region.parquet").select(F.col("r_name").alias("b"))))
_add("anti_join", "SELECT c_custkey::VARCHAR AS _id FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders)", lambda s, d, f: f("customers", columns=["_id"]).join(f("orders").select(F.col("o_custkey").cast("string").alias("_id")), "_id", "left_anti"))
_add("asof_join", "SELECT a.event_id::VARCHAR AS _id, b.ts AS bought FROM events a ASOF LEFT JOIN (SELECT user_id, ts FROM events WHERE event_type = 'purchase') b ON a.user_id = b.user_id AND a.ts >= b.ts", lambda s, d, f: asof_join(f("events", columns=["_id", "user_id", "ts"]), f("events", None, P.Compare("event_type", "=", "purchase")).select("user_id", "ts"), "user_id", "ts").select("_id", F.col("ts_matched").alias("bought")))


def _scalar(s: SparkSession, d: str, f: Callable) -> DataFrame:
    f("parts", columns=["_id", "p_size"]).createOrReplaceTempView("docquarry_parts")
    return s.sql("SELECT (SELECT max(p_size) FROM docquarry_parts) AS hi, (SELECT count(*) FROM docquarry_parts WHERE p_size = 1) AS ones")


_add("scalar_subquery", "SELECT (SELECT max(p_size) FROM part) AS hi, (SELECT count(*) FROM part WHERE p_size = 1) AS ones", _scalar)
_brand = lambda f, *w: f("parts", None, *w, columns=["p_brand"])
_add("union", "SELECT p_brand FROM part WHERE p_size < 3 UNION SELECT p_brand FROM part WHERE p_size > 48", lambda s, d, f: _brand(f, P.Compare("p_size", "<", 3)).union(_brand(f, P.Compare("p_size", ">", 48))).distinct())
_add("intersect", "SELECT p_brand FROM part WHERE p_size < 3 INTERSECT SELECT p_brand FROM part WHERE p_size > 48", lambda s, d, f: _brand(f, P.Compare("p_size", "<", 3)).intersect(_brand(f, P.Compare("p_size", ">", 48))))
_add("except", "SELECT p_brand FROM part WHERE p_size < 30 EXCEPT SELECT p_brand FROM part WHERE p_size > 49", lambda s, d, f: _brand(f, P.Compare("p_size", "<", 30)).subtract(_brand(f, P.Compare("p_size", ">", 49))))
_add("union_all", "SELECT p_brand FROM part WHERE p_size < 3 UNION ALL SELECT p_brand FROM part WHERE p_size < 2", lambda s, d, f: _brand(f, P.Compare("p_size", "<", 3)).union(_brand(f, P.Compare("p_size", "<", 2))))
_add("intersect_all", "SELECT p_brand FROM part WHERE p_size < 20 INTERSECT ALL SELECT p_brand FROM part WHERE p_size > 40", lambda s, d, f: _brand(f, P.Compare("p_size", "<", 20)).intersectAll(_brand(f, P.Compare("p_size", ">", 40))))
_add("except_all", "SELECT p_brand FROM part WHERE p_size < 30 EXCEPT ALL SELECT p_brand FROM part WHERE p_size > 40", lambda s, d, f: _brand(f, P.Compare("p_size", "<", 30)).exceptAll(_brand(f, P.Compare("p_size", ">", 40))))
_add("union_by_name", "SELECT _id, p_size, NULL::VARCHAR AS p_brand FROM (SELECT p_partkey::VARCHAR AS _id, * FROM part) WHERE p_size = 1 UNION ALL SELECT _id, NULL, p_brand FROM (SELECT p_partkey::VARCHAR AS _id, * FROM part) WHERE p_size = 2", lambda s, d, f: f("parts", None, P.Compare("p_size", "=", 1), columns=["_id", "p_size"]).unionByName(f("parts", None, P.Compare("p_size", "=", 2), columns=["p_brand", "_id"]), allowMissingColumns=True))
_add("cte", "WITH c AS (SELECT p_brand, count(*) AS n FROM part GROUP BY p_brand) SELECT p_brand FROM c WHERE n = (SELECT max(n) FROM c)", lambda s, d, f: (lambda c: c.join(c.agg(F.max("n").alias("n")), "n", "left_semi").select("p_brand"))(f("parts").groupBy("p_brand").agg(F.count("*").alias("n"))))
_add("view", "SELECT p_brand, count(*) AS n FROM part WHERE p_size > 30 GROUP BY p_brand", lambda s, d, f: (create_view(s, "docquarry_view", "parts", catalog=indices(d), sample_size=0), s.sql("SELECT p_brand, count(*) AS n FROM docquarry_view WHERE p_size > 30 GROUP BY p_brand"))[1])
_add("derived_table", "SELECT lang, avg(n) AS mean FROM (SELECT lang, source, count(*) AS n FROM documents GROUP BY lang, source) GROUP BY lang", lambda s, d, f: f("documents").groupBy("lang", "source").agg(F.count("*").alias("n")).groupBy("lang").agg(F.avg("n").alias("mean")))
_add("unpivot", "SELECT p_partkey::VARCHAR AS _id, k, v FROM (SELECT p_partkey, p_brand, p_type FROM part) UNPIVOT (v FOR k IN (p_brand, p_type))", lambda s, d, f: f("parts", columns=["_id", "p_brand", "p_type"]).unpivot(["_id"], ["p_brand", "p_type"], "k", "v"))

# Unmapped fields, several indices
_add("unmapped_extract", "SELECT event_id::VARCHAR AS _id, cast(json_extract(props, '$.k') AS BIGINT) AS k FROM events", lambda s, d, f: f("events", columns=["_id", "_unmapped_"]).select("_id", F.variant_get("_unmapped_", "$.k", "bigint").alias("k")))
_add("unmapped_not_null", "SELECT count(*) AS n FROM events WHERE props IS NOT NULL", lambda s, d, f: f("events", None, P.Null("_unmapped_", False), columns=["_id"]).agg(F.count("*").alias("n")))
_K = "cast(json_extract(props, '$.k') AS BIGINT)"
_ids("unmapped_compare", "events", _EVENT, f"{_K} > 50", None, P.Compare("_unmapped_.k", ">", 50))
_ids("unmapped_in", "events", _EVENT, f"{_K} IN (1, 7) AND value > 10", None, P.In("_unmapped_.k", (1, 7)), P.Compare("value", ">", 10.0))
_ids("unmapped_like", "events", _EVENT, f"{_K}::VARCHAR LIKE '1%'", None, P.Like("_unmapped_.k", "1%"))
_ids("unmapped_missing", "events", _EVENT, "json_extract(props, '$.nothing') IS NULL AND event_id < 100", None, P.Null("_unmapped_.nothing"), P.In("_id", tuple(str(i) for i in range(100))))
_add("multi_index_merge", "SELECT lang, role, count(*) AS n FROM (SELECT text, lang, NULL AS role FROM documents UNION ALL SELECT text, NULL, role FROM conversations) WHERE text LIKE '%the%' GROUP BY lang, role", lambda s, d, f: f("documents,chats", None, P.Like("text", "%the%"), columns=["lang", "role"]).groupBy("lang", "role").agg(F.count("*").alias("n")))

# Geometry: columns of numbers, without Python; below, fields of documents
_HAV = "2 * 6371008.7714 * asin(least(1.0, sqrt(pow(sin((radians(48) - radians(lat)) / 2), 2) + cos(radians(lat)) * cos(radians(48)) * pow(sin(radians(2 - lon) / 2), 2))))"
_add("geo_bbox", f"SELECT _id FROM {_CUST} WHERE lon BETWEEN -10 AND 40 AND lat BETWEEN 30 AND 60", lambda s, d, f: f("customers", None, P.between("lon", -10, 40), P.between("lat", 30, 60), columns=["_id"]))

def _raw_customers(s: SparkSession, d: str):
    """Customers as JSON documents with points in five encodings and a square of two degrees around each."""
    k = F.col("c_custkey")
    lon, lat = (k * 37 % 360 - 180).cast("double"), (k * 17 % 180 - 90).cast("double")
    at = (
        F.when(k % 5 == 0, F.to_json(F.struct(lat.alias("lat"), lon.alias("lon"))))
        .when(k % 5 == 1, F.to_json(F.array(lon, lat)))
        .when(k % 5 == 2, F.concat(F.lit('"POINT ('), lon, F.lit(" "), lat, F.lit(')"')))
        .when(k % 5 == 3, F.to_json(F.struct(F.lit("Point").alias("type"), F.array(lon, lat).alias("coordinates"))))
        .otherwise(F.concat(F.lit('"'), lat, F.lit(","), lon, F.lit('"')))
    )
    ring = F.array(*[F.array(lon + x, lat + y) for x, y in ((-1, -1), (1, -1), (1, 1), (-1, 1), (-1, -1))])
    area = F.to_json(F.struct(F.lit("Polygon").alias("type"), F.array(ring).alias("coordinates")))
    source = F.concat(F.lit('{"tags":'), F.when(k % 2 == 0, F.lit('"a"')).otherwise(F.lit('["a","b"]')), F.lit(',"n":'), k.cast("string"), F.lit(',"at":'), at, F.lit(',"area":'), area, F.lit(',"more":{"m":1}}'))
    r = resolve({"properties": {"tags": _WORD, "n": _INT, "at": {"type": "geo_point"}, "area": {"type": "geo_shape"}}}).with_arrays(frozenset({"tags"}))
    return decode(s.read.parquet(f"{d}/customer.parquet").select(k.cast("string").alias("_id"), source.alias("_source")), r), r


def _raw(name: str, sql: str, make) -> None:
    _add(name, sql, lambda s, d, f: make(*_raw_customers(s, d)))


_raw("decode_lists", "SELECT c_custkey::VARCHAR AS _id, c_custkey::INT AS n, CASE WHEN c_custkey % 2 = 0 THEN 1 ELSE 2 END AS size FROM customer", lambda x, r: x.select("_id", "n", F.size("tags").alias("size")))
_raw("decode_unmapped", "SELECT c_custkey::VARCHAR AS _id, 1::BIGINT AS m FROM customer", lambda x, r: x.select("_id", F.variant_get("_unmapped_", "$.more.m", "bigint").alias("m")))
_raw("geo_within", f"SELECT _id FROM {_CUST} WHERE lon > -10 AND lon < 40 AND lat > 30 AND lat < 60", lambda x, r: x.where(P.Spatial("at", "within", geo.envelope(-10, 30, 40, 60)).column(r)).select("_id"))
_raw("geo_intersects", f"SELECT _id FROM {_CUST} WHERE lon BETWEEN -10 AND 40 AND lat BETWEEN 30 AND 60", lambda x, r: x.where(P.Spatial("at", "intersects", geo.envelope(-10, 30, 40, 60)).column(r)).select("_id"))
_raw("geo_disjoint", f"SELECT _id FROM {_CUST} WHERE NOT (lon BETWEEN -10 AND 40 AND lat BETWEEN 30 AND 60)", lambda x, r: x.where(P.Spatial("at", "disjoint", geo.envelope(-10, 30, 40, 60)).column(r)).select("_id"))
_raw("geo_metres", f"SELECT _id FROM {_CUST} WHERE {_HAV} <= 4000000", lambda x, r: x.where(P.Distance("at", 2, 48, "<=", 4000000).column(r)).select("_id"))
_raw("geo_wkt", f"SELECT _id, 'POINT (' || lon || ' ' || lat || ')' AS wkt FROM {_CUST}", lambda x, r: x.select("_id", geo.as_wkt(F.col("at")).alias("wkt")))
_raw("geo_distance_lt", f"SELECT _id FROM {_CUST} WHERE {_HAV} < 3000000", lambda x, r: x.where(P.Distance("at", 2, 48, "<", 3000000).column(r)).select("_id"))
_raw("geo_distance_gt", f"SELECT _id FROM {_CUST} WHERE {_HAV} > 15000000", lambda x, r: x.where(P.Distance("at", 2, 48, ">", 15000000).column(r)).select("_id"))
_raw("geo_distance_shape", f"SELECT _id FROM {_CUST} WHERE abs(lon + 142.5) <= 1 AND abs(lat + 72.5) <= 1", lambda x, r: x.where(P.Distance("area", -142.5, -72.5, "<=", 0).column(r)).select("_id"))
_raw("geo_contains", f"SELECT _id FROM {_CUST} WHERE abs(lon + 142.5) < 1 AND abs(lat + 72.5) < 1", lambda x, r: x.where(P.Spatial("area", "contains", geo.point(-142.5, -72.5)).column(r)).select("_id"))
_raw("geo_shape_intersects", f"SELECT _id FROM {_CUST} WHERE lon BETWEEN -11 AND 41 AND lat BETWEEN 29 AND 61", lambda x, r: x.where(P.Spatial("area", "intersects", geo.envelope(-10, 30, 40, 60)).column(r)).select("_id"))
_raw("geo_shape_within", f"SELECT _id FROM {_CUST} WHERE lon BETWEEN -9 AND 39 AND lat BETWEEN 31 AND 59", lambda x, r: x.where(P.Spatial("area", "within", geo.envelope(-10, 30, 40, 60)).column(r)).select("_id"))
_raw("geo_equal", f"SELECT _id FROM {_CUST} WHERE lon = -143 AND lat = -73", lambda x, r: x.where(P.Compare("at", "=", geo.point(-143, -73)).column(r)).select("_id"))
_raw("geo_dsl_bounding_box", f"SELECT _id FROM {_CUST} WHERE lon BETWEEN -10 AND 40 AND lat BETWEEN 30 AND 60", lambda x, r: x.where(compile_query({"geo_bounding_box": {"at": {"top_left": {"lat": 60, "lon": -10}, "bottom_right": {"lat": 30, "lon": 40}}}}, r)).select("_id"))
_raw("geo_dsl_distance", f"SELECT _id FROM {_CUST} WHERE {_HAV} <= 2000000", lambda x, r: x.where(compile_query({"geo_distance": {"distance": "2000km", "at": {"lat": 48, "lon": 2}}}, r)).select("_id"))
