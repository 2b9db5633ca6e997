"""The entry point: an index, an index pattern or a remote store as a DataFrame."""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .functions.mapping import Resolved
from .operators.decode import decode
from .operators.dsl import BadQuery
from .operators.predicates import Predicate, columns_of, exact, explain_dsl, pushes, root, split, value_at
from .settings import setting
from .sources.index import CATALOG, Catalog, array_paths, cached, clear_cache, read_index, resolve_schema
from .sources.remote import Client, DocumentStore, http_log

__all__ = ["clear_cache", "create_view", "explain", "http_log", "search", "search_remote"]


def _query(query: dict | str | None) -> dict | None:
    if isinstance(query, str):
        try:
            return json.loads(query)
        except ValueError as e:
            raise BadQuery(f"the query is not JSON: {e}") from e
    return query


def search(
    spark: SparkSession,
    index: str | None = None,
    query: dict | str | None = None,
    where: Sequence[Predicate] = (),
    columns: Sequence[str] | None = None,
    limit: int | None = None,
    offset: int = 0,
    sample_size: int | None = None,
    catalog: Catalog = CATALOG,
) -> DataFrame:
    """Documents of an index or pattern: columns _id, the mapped fields, _unmapped_.

    ``query`` is one clause with the store's semantics, ``where`` are predicates with SQL's. Only the columns that are
    asked for or filtered on are decoded; the rest is Catalyst's to prune. Several indices are one relation.
    """
    if not index:
        raise ValueError("search requires 'index' parameter")
    query = _query(query)
    size = setting(spark, "sample_size", sample_size)
    r = resolve_schema(spark, index, query, size, catalog)
    every = ["_id", *(n for n, _ in r.columns), "_unmapped_"]
    wanted = list(columns) if columns is not None else every
    split(list(where), r)  # refuses what cannot be compared
    needed = {root(c) for c in wanted} | columns_of(where)
    parts = [read_index(spark, i, r, [c for c in every if c in needed], query) for i in catalog.find(index)]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    for w in where:
        out = out.where(w.column(r))
    return _page(out, wanted, limit, offset)


def _page(out: DataFrame, wanted: list[str], limit: int | None, offset: int) -> DataFrame:
    out = out.select(*[F.col(c) if pushes(c) else value_at(c).alias(c) for c in wanted])
    if offset:
        out = out.offset(offset)
    return out if limit is None else out.limit(limit)


def create_view(spark: SparkSession, name: str, index: str, *, host: str | None = None, **arguments) -> DataFrame:
    """A temporary view for SQL over an index, or over a store if a host is given; arguments as for ``search`` or ``search_remote``."""
    out = search(spark, index, **arguments) if host is None else search_remote(spark, index, host, **arguments)
    out.createOrReplaceTempView(name)
    return out


def explain(spark: SparkSession, index: str, query: dict | str | None = None, where: Sequence[Predicate] = (), columns: Sequence[str] | None = None, catalog: Catalog = CATALOG) -> str:
    """The request a remote store would get, then the predicates evaluated here."""
    r = resolve_schema(spark, index, _query(query), setting(spark, "sample_size"), catalog)
    _, rest = split(list(where), r)
    return json.dumps(explain_dsl(r, list(where), _query(query), list(columns) if columns else None)) + "".join(f"\nFILTER {p}" for p in rest)


def search_remote(
    spark: SparkSession,
    index: str,
    host: str = "localhost",
    port: int = 9200,
    query: dict | str | None = None,
    where: Sequence[Predicate] = (),
    columns: Sequence[str] | None = None,
    limit: int | None = None,
    offset: int = 0,
    username: str | None = None,
    password: str | None = None,
    use_ssl: bool = False,
    verify_ssl: bool | None = None,
    timeout: int | None = None,
    max_retries: int | None = None,
    retry_interval: int | None = None,
    retry_backoff_factor: float | None = None,
    sample_size: int | None = None,
    proxy: str | None = None,
    slices: int = 1,
) -> DataFrame:
    """The same over a store that answers HTTP: pushed predicates and fields go into its request, as ``explain`` tells; all are evaluated here again.

    Mappings and samples are cached, so a warm search sends none of their requests.
    """
    if not host:
        raise ValueError("search requires 'host' parameter")
    if not index:
        raise ValueError("search requires 'index' parameter")
    given = {"verify_ssl": verify_ssl, "timeout": timeout, "max_retries": max_retries, "retry_interval": retry_interval, "retry_backoff_factor": retry_backoff_factor}
    used = {k: setting(spark, k, v) for k, v in given.items()}
    client = Client(host, port, use_ssl, username=username, password=password, proxy=proxy, **used)
    query = _query(query)
    size = setting(spark, "sample_size", sample_size)
    r = cached(("remote", client.base().geturl(), username, index, json.dumps(query, sort_keys=True), size), lambda: _remote_schema(spark, client, index, query, size))
    every = ["_id", *(n for n, _ in r.columns), "_unmapped_"]
    wanted = list(columns) if columns is not None else every
    needed = {root(c) for c in wanted} | columns_of(where)
    body = explain_dsl(r, list(where), query, [c for c in every if c in needed])
    spark.dataSource.register(DocumentStore)
    whole = limit is not None and all(exact(w, r) for w in where)  # else rows beyond the limit may be needed
    options = {"index": index, "host": host, "port": port, "use_ssl": use_ssl, "body": json.dumps(body), "slices": 1 if whole else slices, "scroll_time": setting(spark, "scroll_time"), "batch_size": setting(spark, "batch_size"), "batch_size_threshold_factor": setting(spark, "batch_size_threshold_factor")} | used
    options |= {k: v for k, v in {"username": username, "password": password, "proxy": proxy, "limit": limit + offset if whole else None}.items() if v is not None}
    rows = spark.read.format("docsearch").options(**{k: str(v) for k, v in options.items()}).load()
    out = decode(rows, r, [c for c in every if c in needed])
    for w in where:
        out = out.where(w.column(r))
    return _page(out, wanted, limit, offset)


def _remote_schema(spark: SparkSession, client: Client, index: str, query: dict | None, size: int) -> Resolved:
    r = client.mapping(index)
    if size > 0:
        hits = client.sample(index, size, query or {"match_all": {}})
        if hits:
            rows = spark.createDataFrame([(h["_id"], json.dumps(h.get("_source", {}))) for h in hits], "_id string, _source string")
            r = r.with_arrays(array_paths(rows, r))
    client.close()
    return r
