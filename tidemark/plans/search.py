"""Queries over the search engine: each logical operator, text, order, pages, facets, projection and generations.

Every query runs over its whole table.  Limits stand only where a page or a list of the most frequent values is the feature.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.engine.cursor import Signer
from tidemark.engine.generation import Generations
from tidemark.engine.layout import Layout
from tidemark.engine.limits import CURSOR_SECONDS, Limits
from tidemark.engine.index import Index, Segment, write_index
from tidemark.engine.projection import acknowledge, counts, document_id_column, encode
from tidemark.engine.request import Plan, from_mapping, from_operation
from tidemark.engine.search import Search
from tidemark.plans.resources import ARCHIVE, CUSTOMERS, DOCUMENTS, ENGLISH, LINES, ORDERS, PARTS, PROPS, USER_STATE, VECTORS, documents_of
from tidemark.sources.tables import table, utc_table
from tidemark.storage import scratch, write_once
from tidemark.streaming.outcomes import outcomes
from tidemark.streaming.sink import project_stream

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}
SECRET = b"only for the test queries"
#: The scope that the tables are in when they are read as documents of one tenant.
ALL = "all"


def _put(name: str, query: Query, sql: str | None = None) -> None:
    query.__name__ = name
    QUERIES[name] = query
    if sql:
        SQL[name] = sql


def _search(spark: SparkSession, d: str, layout: Layout, where: dict | None = None, query=None, scope: str = ALL, size: int = 20, facets=(), highlights=()) -> Search:
    request = {"resource": layout.resource, "query": query, "where": where or {}, "facets": list(facets), "highlights": list(highlights), "limit": size}
    return Search(from_mapping(layout, request), documents_of(spark, d, layout), scope)


def _planned(layout: Layout, tree=None, order=(), size: int = 20, cursor=None) -> Plan:
    request = {
        "catalog": "structured", "operation": "search", "consistency": "eventual", "targets": [layout.resource], "filter": tree, "order": list(order),
        "page": {"size": size, **({"cursor": cursor} if cursor else {})},
    }
    return from_operation(layout, request)


def _operation(spark: SparkSession, d: str, layout: Layout, tree=None, order=(), size: int = 20, cursor=None) -> Search:
    return Search(_planned(layout, tree, order, size, cursor), documents_of(spark, d, layout), ALL)


def _ids(search: Search) -> DataFrame:
    return search.matched.select(F.col("m_record_id").alias("id"))


def _where(name: str, layout: Layout, where: dict, condition: str) -> None:
    """A query of all matches of a mapping's conditions."""
    source = {
        id(DOCUMENTS): ("documents", "cast(doc_id as varchar)"), id(ORDERS): ("orders", "cast(o_orderkey as varchar)"), id(PARTS): ("part", "cast(p_partkey as varchar)"),
        id(ARCHIVE): ("(select distinct * exclude (m_projected_at) from docs_primary where not m_deleted)", "m_record_id"),
        id(VECTORS): ("embeddings", "cast(vec_id as varchar)"),
    }[id(layout)]
    _put(name, lambda s, d: _ids(_search(s, d, layout, where)), f"select {source[1]} id from {source[0]} where {condition}")


def _tree(name: str, layout: Layout, tree: dict, condition: str) -> None:
    table_, key = {id(DOCUMENTS): ("documents", "doc_id"), id(ORDERS): ("orders", "o_orderkey"), id(VECTORS): ("embeddings", "vec_id")}[id(layout)]
    _put(name, lambda s, d: _ids(_operation(s, d, layout, tree)), f"select cast({key} as varchar) id from {table_} where {condition}")


def _f(name: str) -> dict:
    return {"kind": "field", "name": name}


def _v(value: object) -> dict:
    return {"kind": "literal", "value": value}


def _cmp(kind: str, name: str, value: object) -> dict:
    return {"kind": kind, "left": _f(name), "right": _v(value)}


# -- filters ---------------------------------------------------------------------------------------------------------
_where("eq_status", ORDERS, {"o_orderstatus": "F"}, "o_orderstatus = 'F'")
_where("eq_bool", ARCHIVE, {"active": True}, "active")
_where("eq_number", PARTS, {"p_size": {"$eq": 15}}, "p_size = 15")
_where("ne_includes_null", DOCUMENTS, {"source": {"$ne": "newsroom"}}, "source is distinct from 'newsroom'")
_where("lt_price", ORDERS, {"o_totalprice": {"$lt": 100000.0}}, "o_totalprice < 100000")
_where("lte_price", PARTS, {"p_retailprice": {"$lte": 1000.0}}, "p_retailprice <= 1000")
_where("gt_price", ORDERS, {"o_totalprice": {"$gt": 400000.0}}, "o_totalprice > 400000")
_where("gte_price", PARTS, {"p_size": {"$gte": 25}}, "p_size >= 25")
_where("in_priority", ORDERS, {"o_orderpriority": {"$in": ["1-URGENT", "5-LOW"]}}, "o_orderpriority in ('1-URGENT', '5-LOW')")
_where("in_large_semi", ORDERS, {"o_custkey": {"$in": list(range(0, 30000, 4))}}, "o_custkey % 4 = 0 and o_custkey < 30000")
_where("notin_large_anti", ORDERS, {"o_custkey": {"$notIn": list(range(0, 30000, 4))}}, "not (o_custkey % 4 = 0 and o_custkey < 30000)")
_where("notin_includes_null", DOCUMENTS, {"lang": {"$notIn": ["en", "de"]}}, "lang is null or lang not in ('en', 'de')")
_where("prefix_brand", PARTS, {"p_brand": {"$prefix": "Brand#1"}}, "starts_with(p_brand, 'Brand#1')")
_where("is_null", DOCUMENTS, {"source": {"$isNull": True}}, "source is null")
_where("is_not_null", DOCUMENTS, {"case_ref": {"$isNull": False}}, "case_ref is not null")
_START, _END = "1996-01-01T00:00:00Z", "1997-01-01T00:00:00Z"
_where("ts_range_default", ORDERS, {"o_orderdate": {"$timestampRange": {"start": _START, "end": _END}}}, "o_orderdate >= timestamp '1996-01-01' and o_orderdate < timestamp '1997-01-01'")
_where("ts_range_inclusive", ORDERS, {"o_orderdate": {"$timestampRange": {"start": _START, "end": _END, "includeStart": False, "includeEnd": True}}}, "o_orderdate > timestamp '1996-01-01' and o_orderdate <= timestamp '1997-01-01'")
_where("ts_range_open", ORDERS, {"o_orderdate": {"$timestampRange": {"start": _START}}}, "o_orderdate >= timestamp '1996-01-01'")
_where("several_operators", ORDERS, {"o_totalprice": {"$gte": 50000.0, "$lt": 60000.0}, "o_orderstatus": {"$ne": "F"}}, "o_totalprice >= 50000 and o_totalprice < 60000 and o_orderstatus <> 'F'")
_where("many_any_eq", ARCHIVE, {"labels": "archive"}, "coalesce(list_contains(labels, 'archive'), false)")
_where("many_ne", ARCHIVE, {"labels": {"$ne": "archive"}}, "not coalesce(list_contains(labels, 'archive'), false)")
_where("many_in", ARCHIVE, {"labels": {"$in": ["tide", "night"]}}, "coalesce(list_contains(labels, 'tide') or list_contains(labels, 'night'), false)")
_where("many_is_null", ARCHIVE, {"labels": {"$isNull": True}}, "labels is null or len(labels) = 0")
_where("many_any_range", VECTORS, {"embedding": {"$gte": 0.30, "$lt": 0.31}}, "len(list_filter(embedding, lambda x: x::double >= 0.30)) > 0 and len(list_filter(embedding, lambda x: x::double < 0.31)) > 0")
_where("many_single_range", VECTORS, {"embedding": {"$timestampRange": {"start": 0.30, "end": 0.31}}}, "len(list_filter(embedding, lambda x: x::double >= 0.30 and x::double < 0.31)) > 0")
_tree("and_or_not_tree", ORDERS, {"kind": "or", "operands": [
    {"kind": "and", "operands": [_cmp("eq", "o_orderstatus", "O"), {"kind": "not", "operand": _cmp("lt", "o_totalprice", 300000.0)}]},
    {"kind": "not", "operand": {"kind": "or", "operands": [_cmp("ne", "o_orderpriority", "2-HIGH"), _cmp("gte", "o_totalprice", 20000.0)]}},
]}, "(o_orderstatus = 'O' and o_totalprice >= 300000) or (o_orderpriority = '2-HIGH' and o_totalprice < 20000)")
_tree("not_over_missing", DOCUMENTS, {"kind": "not", "operand": {"kind": "and", "operands": [_cmp("eq", "source", "newsroom"), _cmp("gt", "n_chars", 300)]}},
      "source is distinct from 'newsroom' or n_chars is null or n_chars <= 300")
_tree("literal_first", ORDERS, {"kind": "lt", "left": _v(450000.0), "right": _f("o_totalprice")}, "450000 < o_totalprice")
_tree("expression_leaves", DOCUMENTS, {"kind": "and", "operands": [
    {"kind": "prefix", "left": _f("case_ref"), "right": _v("case-0")}, {"kind": "notIn", "operand": _f("lang"), "values": [_v("zh"), _v("ja")]},
    {"kind": "isNull", "operand": _f("source"), "expected": False}, {"kind": "timestampRange", "operand": _f("collected_at"), "start": _v("2026-03-15T00:00:00Z")},
]}, "starts_with(case_ref, 'case-0') and (lang is null or lang not in ('zh', 'ja')) and source is not null and collected_at >= timestamp '2026-03-15'")
_put("scope_isolation", lambda s, d: _ids(_search(s, d, CUSTOMERS, {"c_acctbal": {"$gt": 0.0}}, scope="7")), "select cast(c_custkey as varchar) id from customer where c_nationkey = 7 and c_acctbal > 0")

# -- full text -------------------------------------------------------------------------------------------------------
_TOKENS = "regexp_extract_all(lower({0}), '[\\p{{L}}\\p{{N}}]+')"


def _bm25_cte(relation: str, key: str, fields: list[str]) -> str:
    toks = ", ".join(f"{_TOKENS.format(f)} t_{f}" for f in fields)
    stats = ", ".join(f"count(t_{f})::double n_{f}, (sum(len(t_{f})) / count(t_{f}))::double a_{f}" for f in fields)
    return f"d as (select *, {key} id, {toks} from {relation}), s as (select {stats} from d)"


def _bm25_df(fields: list[str], terms: list[str]) -> str:
    parts = ", ".join(f"count(*) filter (list_contains(t_{f}, '{t}'))::double df_{f}_{i}" for f in fields for i, t in enumerate(terms))
    return f"q as (select {parts} from d)"


def _bm25_field(f: str, terms: list[str]) -> str:
    def one(i: int, t: str) -> str:
        tf = f"len(list_filter(t_{f}, lambda x: x = '{t}'))::double"
        idf = f"ln(1 + (n_{f} - df_{f}_{i} + 0.5) / (df_{f}_{i} + 0.5))"
        return f"coalesce({idf} * {tf} / ({tf} + 1.2 * (1 - 0.75 + 0.75 * len(t_{f}) / a_{f})), 0)"

    return "(" + " + ".join(one(i, t) for i, t in enumerate(terms)) + ")"


def _has(f: str, terms: list[str], every: bool = False) -> str:
    return "(" + (" and " if every else " or ").join(f"coalesce(list_contains(t_{f}, '{t}'), false)" for t in terms) + ")"


def _scored(search: Search) -> DataFrame:
    return search.scored().select(F.col("m_record_id").alias("id"), F.round("score", 6).alias("score"))


def _text_sql(relation: str, key: str, fields: list[str], terms: list[str], where: str = "true", every: bool = False) -> str:
    best = _bm25_field(fields[0], terms) if len(fields) == 1 else "greatest(" + ", ".join(_bm25_field(f, terms) for f in fields) + ")"
    found = " or ".join(_has(f, terms, every) for f in fields)
    return f"with {_bm25_cte(relation, key, fields)}, {_bm25_df(fields, terms)} select id, round({best}, 6) score from d, s, q where ({found}) and {where}"


_DOCS, _ARCHIVE = "documents", "(select distinct * exclude (m_projected_at) from docs_primary where not m_deleted)"
_KEY = "cast(doc_id as varchar)"
_put("fulltext_or", lambda s, d: _scored(_search(s, d, DOCUMENTS, query="ledger manifest cursor")), _text_sql(_DOCS, _KEY, ["text"], ["ledger", "manifest", "cursor"]))
_put("fulltext_and", lambda s, d: _scored(_search(s, d, DOCUMENTS, query={"text": "Ledger manifest", "operator": "and"})), _text_sql(_DOCS, _KEY, ["text"], ["ledger", "manifest"], every=True))
_put("fulltext_other_script", lambda s, d: _scored(_search(s, d, DOCUMENTS, query="архив отчёт")), _text_sql(_DOCS, _KEY, ["text"], ["архив", "отчёт"]))
_put("fulltext_multifield", lambda s, d: _scored(_search(s, d, ARCHIVE, query={"text": "ledger cursor", "fields": ["title", "body"]})), _text_sql(_ARCHIVE, "m_record_id", ["title", "body"], ["ledger", "cursor"]))
_put("fulltext_parts", lambda s, d: _scored(_search(s, d, PARTS, query="widget")), _text_sql("part", "cast(p_partkey as varchar)", ["p_name"], ["widget"]))
_put("fulltext_filtered", lambda s, d: _scored(_search(s, d, DOCUMENTS, {"lang": "en", "n_chars": {"$gte": 300}}, "ledger manifest")), _text_sql(_DOCS, _KEY, ["text"], ["ledger", "manifest"], "lang = 'en' and n_chars >= 300"))
_put("fulltext_under_and_unscored", lambda s, d: _scored(_operation(s, d, DOCUMENTS, {"kind": "and", "operands": [{"kind": "fullText", "query": "ledger"}, _cmp("eq", "lang", "en")]})),
     f"with d as (select *, {_TOKENS.format('text')} t_text from documents) select {_KEY} id, 0.0::double score from d where {_has('text', ['ledger'])} and lang = 'en'")
_put("fulltext_or_branches", lambda s, d: _scored(_operation(s, d, ARCHIVE, {"kind": "or", "operands": [{"kind": "fullText", "query": "ledger", "fields": ["title"]}, {"kind": "fullText", "query": "cursor", "fields": ["body"]}]})),
     f"with {_bm25_cte(_ARCHIVE, 'm_record_id', ['title', 'body'])}, {_bm25_df(['title', 'body'], ['ledger', 'cursor'])} "
     f"select id, round({_bm25_field('title', ['ledger'])} + {_bm25_field('body', ['zz', 'cursor']).replace('df_body_0', 'n_body')}, 6) score from d, s, q where {_has('title', ['ledger'])} or {_has('body', ['cursor'])}")  # fmt: skip
_put("fulltext_not", lambda s, d: _ids(_operation(s, d, DOCUMENTS, {"kind": "not", "operand": {"kind": "fullText", "query": "the"}})),
     f"with d as (select *, {_TOKENS.format('text')} t_text from documents) select {_KEY} id from d where not {_has('text', ['the'])}")


def _fuzzy_sql(word: str, most: int) -> str:
    return (
        f"with d as (select *, {_TOKENS.format('text')} t_text from documents), v as (select distinct unnest(t_text) term from d), "
        f"n as (select list(term) terms from v where abs(length(term) - {len(word)}) <= {most} and damerau_levenshtein(term, '{word}') <= {most}) "
        f"select {_KEY} id from d, n where coalesce(list_has_any(t_text, n.terms), false)"
    )


_put("fulltext_fuzzy1", lambda s, d: _ids(_search(s, d, DOCUMENTS, query={"text": "legder", "fuzziness": 1})), _fuzzy_sql("legder", 1))
_put("fulltext_fuzzy2", lambda s, d: _ids(_search(s, d, DOCUMENTS, query={"text": "manfist", "fuzziness": 2})), _fuzzy_sql("manfist", 2))
_put("fulltext_fuzzy_short", lambda s, d: _ids(_search(s, d, DOCUMENTS, query={"text": "der", "fuzziness": 2})), _fuzzy_sql("der", 2))
_put("fulltext_en_stemmed", lambda s, d: _scored(_search(s, d, ENGLISH, {"lang": "en"}, "highlights rejecting")))


def highlight_fragments(spark: SparkSession, d: str) -> DataFrame:
    page = _search(spark, d, DOCUMENTS, {"lang": "en"}, "ledger", highlights=["text"]).page()
    rows = [(i["recordRef"]["recordId"], k, x) for i in page["items"] for k, x in enumerate(i["highlights"].get("text", []))]
    return spark.createDataFrame(rows, "id string, n int, fragment string")


_put("highlight_fragments", highlight_fragments)


def _indexed(spark: SparkSession, d: str, layout: Layout, query, **more) -> Search:
    """A search over a table that was written with its index, as a generation's documents are."""
    root = scratch(spark, "indexed")
    docs = write_once(documents_of(spark, d, layout), f"{root}/docs")
    index = Index(spark, layout, [Segment(docs, write_index(docs, layout, f"{root}/index"))])
    request = {"resource": layout.resource, "query": query, "where": {}, "facets": [], "highlights": [], "limit": 20, **more}
    return Search(from_mapping(layout, request), docs, ALL, index=index)


def postings_ranked(spark: SparkSession, d: str) -> DataFrame:
    """The same ranking as ``fulltext_or``, from postings instead of a scan of all tokens."""
    return _scored(_indexed(spark, d, DOCUMENTS, "ledger manifest cursor"))


_put("postings_ranked", postings_ranked, _text_sql(_DOCS, _KEY, ["text"], ["ledger", "manifest", "cursor"]))
_put("postings_every", lambda s, d: _scored(_indexed(s, d, ARCHIVE, {"text": "ledger cursor", "fields": ["title", "body"], "operator": "and"})),
     _text_sql(_ARCHIVE, "m_record_id", ["title", "body"], ["ledger", "cursor"], every=True))
_put("postings_fuzzy", lambda s, d: _ids(_indexed(s, d, DOCUMENTS, {"text": "der", "fuzziness": 2}, where={"lang": "de"})), _fuzzy_sql("der", 2) + " and lang = 'de'")


# -- order and pages -------------------------------------------------------------------------------------------------
def _first(search: Search, *names: str) -> DataFrame:
    return search.rows().limit(search.plan.size).select(F.col("m_record_id").alias("id"), *names)


_put("match_all_top", lambda s, d: _first(_search(s, d, ORDERS)), "select cast(o_orderkey as varchar) id from orders order by o_orderkey limit 20")


def _order(*keys: tuple[str, str, str]) -> list[dict]:
    return [{"field": f, "direction": d, "nulls": n} for f, d, n in keys]


_put("sort_multi_nulls_first", lambda s, d: _first(_operation(s, d, DOCUMENTS, order=_order(("source", "desc", "first"), ("n_chars", "asc", "first")), size=200)),
     f"select {_KEY} id from documents order by source desc nulls first, n_chars asc nulls first, doc_id limit 200")
_put("sort_multi_nulls_last", lambda s, d: _first(_operation(s, d, DOCUMENTS, order=_order(("source", "asc", "last"), ("n_chars", "desc", "last")), size=200)),
     f"select {_KEY} id from documents order by source asc nulls last, n_chars desc nulls last, doc_id limit 200")
_put("sort_many_min", lambda s, d: _first(_operation(s, d, VECTORS, order=_order(("embedding", "asc", "last")), size=100)),
     "select cast(vec_id as varchar) id from embeddings order by list_min(embedding), vec_id limit 100")
_put("sort_many_max", lambda s, d: _first(_operation(s, d, VECTORS, order=_order(("embedding", "desc", "first")), size=100)),
     "select cast(vec_id as varchar) id from embeddings order by list_max(embedding) desc, vec_id limit 100")
_put("topk_page1", lambda s, d: _search(s, d, DOCUMENTS, query="ledger manifest", size=20).rows().limit(20).select(F.col("m_record_id").alias("id"), F.round("score", 6).alias("score")),
     f"select id, score from ({_text_sql(_DOCS, 'doc_id', ['text'], ['ledger', 'manifest'])}) order by score desc, id limit 20".replace("select id, score from (", "select cast(id as varchar) id, score from (", 1))


def _pages(spark: SparkSession, make: Callable[[str | None], Search], most: int | None = None) -> DataFrame:
    """Pages one after another by their cursors: (page, id). Each page comes back as a bounded result."""
    signer = Signer(SECRET, CURSOR_SECONDS)
    rows, cursor, n = [], None, 0
    while most is None or n < most:
        page = make(cursor).page(signer)
        n += 1
        rows += [(n, i["recordRef"]["recordId"]) for i in page["items"]]
        cursor = page["cursor"]
        if cursor is None:
            break
    return spark.createDataFrame(rows, "page int, id string")


def keyset_page2(spark: SparkSession, d: str) -> DataFrame:
    order = _order(("o_orderpriority", "asc", "last"), ("o_totalprice", "desc", "last"))
    pages = _pages(spark, lambda c: _operation(spark, d, ORDERS, order=order, size=50, cursor=c), 2)
    return pages.filter("page = 2").select("id")


def keyset_all_pages(spark: SparkSession, d: str) -> DataFrame:
    order = _order(("n_chars", "desc", "first"))
    docs = write_once(documents_of(spark, d, DOCUMENTS).drop(*[c for f in DOCUMENTS.text_fields for c in (f.tokens, f.length)]), f"{scratch(spark, 'pages')}/docs")
    return _pages(spark, lambda c: Search(_planned(DOCUMENTS, None, order, 500, c), docs, ALL))


_put("keyset_page2", keyset_page2, "select cast(o_orderkey as varchar) id from orders order by o_orderpriority, o_totalprice desc, o_orderkey limit 50 offset 50")
_put("keyset_all_pages", keyset_all_pages, f"select cast((row_number() over (order by n_chars desc nulls first, doc_id) - 1) // 500 + 1 as int) page, {_KEY} id from documents")

# -- totals and facets -----------------------------------------------------------------------------------------------
_put("total_exact", lambda s, d: _search(s, d, DOCUMENTS, {"lang": "en"}, "ledger").total(),
     f"with d as (select *, {_TOKENS.format('text')} t_text from documents) select count(*) total from d where lang = 'en' and {_has('text', ['ledger'])}")


def _facets(search: Search) -> DataFrame:
    return search.counts().filter("facet is not null")


def _facet_sql(facet: str, inner: str) -> str:
    return f"select * from (select '{facet}' facet, v as \"value\", count(*) as \"count\" from ({inner}) where v is not null group by 2 order by 3 desc, 2 limit 100)"


_put("facet_single", lambda s, d: _facets(_search(s, d, DOCUMENTS, facets=["source", "lang"])), _facet_sql("source", "select source v from documents") + " union all " + _facet_sql("lang", "select lang v from documents"))
_put("facet_many", lambda s, d: _facets(_search(s, d, ARCHIVE, facets=["labels"])), _facet_sql("labels", f"select unnest(list_distinct(labels)) v from {_ARCHIVE}"))
_put("facet_top", lambda s, d: _facets(_search(s, d, DOCUMENTS, facets=["case_ref"])), _facet_sql("case_ref", "select case_ref v from documents"))
_put("facet_on_match", lambda s, d: _facets(_search(s, d, DOCUMENTS, {"n_chars": {"$gt": 200}}, "ledger", facets=["source"])),
     _facet_sql("source", f"with d as (select *, {_TOKENS.format('text')} t_text from documents) select source v from d where n_chars > 200 and {_has('text', ['ledger'])}"))


# -- projection ------------------------------------------------------------------------------------------------------
def _user_log(events: DataFrame, sequence: F.Column, payload: F.Column) -> DataFrame:
    """Events as mutations of their users' state."""
    return events.select(
        F.col("event_id").alias("arrival"), F.lit(USER_STATE.resource).alias("resource_ref"), F.col("user_id").cast("string").alias("record_id"),
        sequence.cast("bigint").alias("source_sequence"), F.lit("1").alias("source_version"), F.lit("1").alias("schema_version"),
        F.lit(USER_STATE.schema_fingerprint).alias("schema_fingerprint"), F.lit("sha256:" + "0" * 64).alias("scope_fingerprint"),
        F.concat(F.lit("event-"), F.col("event_id").cast("string")).alias("event_id"), payload.alias("payload"), F.col("ts").cast("timestamp").alias("projected_at"),
    )



def _payload(tombstones: bool) -> F.Column:
    body = F.to_json(F.struct("user_id", "event_type", "value"))
    return F.when(F.col("event_type") != "error", body) if tombstones else body


def _projected(spark: SparkSession, d: str, name: str, sequence: F.Column, bulks: int = 2) -> DataFrame:
    """Events applied in bulks to a fresh generation; its documents."""
    store = Generations(spark, scratch(spark, name), "tests", USER_STATE, buckets=8)
    store.create(1)
    store.activate(1)
    log = _user_log(utc_table(spark, d, "events"), sequence, _payload(True))
    top = log.agg(F.max("arrival")).first()[0] or 0
    for b in range(bulks):
        store.apply(log.filter((F.col("arrival") > top * b // bulks) if b else F.lit(True)).filter(F.col("arrival") <= top * (b + 1) // bulks))
    return store.snapshot().docs


def _user_columns(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("m_record_id").alias("user_id"), "m_source_sequence", *[F.col(USER_STATE.fields[n].column).alias(n) for n in ("event_type", "value")])


def _by_value() -> F.Column:
    return F.floor("value").cast("bigint") + 1


def _acks(spark: SparkSession, d: str, payload: F.Column, sequence: F.Column) -> DataFrame:
    """Outcomes of a bulk that meets an empty generation; as in the store, the bulk is encoded once."""
    encoded = encode(_user_log(utc_table(spark, d, "events"), sequence, payload), USER_STATE)
    return acknowledge(write_once(encoded, f"{scratch(spark, 'encoded')}/rows"))


_LATEST = "select cast(user_id as varchar) user_id, m_source_sequence, event_type, value from (select *, {seq} m_source_sequence, row_number() over (partition by user_id order by {seq} desc, event_id desc) k from events) where k = 1 and event_type {test} 'error'"
_BY_ID, _BY_VALUE = "event_id + 1", "floor(value)::bigint + 1"
_put("project_latest", lambda s, d: _user_columns(_projected(s, d, "latest", F.col("event_id") + 1).filter("not m_deleted")), _LATEST.format(seq=_BY_ID, test="<>"))
_put("project_equal_seq", lambda s, d: _user_columns(_projected(s, d, "equal", _by_value(), 3).filter("not m_deleted")), _LATEST.format(seq=_BY_VALUE, test="<>"))
_put("project_tombstones", lambda s, d: _projected(s, d, "tombs", _by_value()).filter("m_deleted").select(F.col("m_record_id").alias("user_id"), "m_source_sequence"),
     "select user_id, m_source_sequence from (" + _LATEST.format(seq=_BY_VALUE, test="=") + ")")
_put("project_stale_acks", lambda s, d: _acks(s, d, _payload(True), _by_value()).select("event_id", "outcome"),
     f"select 'event-' || event_id event_id, case when seq < coalesce(before, 0) then 'stale' else 'applied' end outcome from (select event_id, {_BY_VALUE} seq, max({_BY_VALUE}) over (partition by user_id order by event_id rows between unbounded preceding and 1 preceding) before from events)")


def project_invalid_items(spark: SparkSession, d: str) -> DataFrame:
    """A bulk with wrong types, unknown members, cut-off payloads and foreign schemas: outcomes by kind of event."""
    body = (
        F.when(F.col("event_type") == "error", '{"user_id":1,"event_type":"error","value":"not-a-number"}').when(F.col("event_type") == "signup", '{"user_id":1,"surprise":2}')
        .when(F.col("event_type") == "purchase", '{"user_id":1,"event_ty').otherwise(_payload(False))
    )
    return _acks(spark, d, body, F.col("event_id") + 1).groupBy("outcome", "code").agg(F.count(F.lit(1)).alias("n"))


_put("project_invalid_items", project_invalid_items, """select outcome, code, count(*) n from (select case when event_type in ('error', 'signup', 'purchase') then 'permanent' else 'applied' end outcome,
     case event_type when 'error' then 'mapper_parsing' when 'signup' then 'operation-invalid' when 'purchase' then 'mapper_parsing' end code from events) group by all""")
_put("source_digests", lambda s, d: encode(_user_log(utc_table(s, d, "events"), F.col("event_id") + 1, _payload(True)), USER_STATE).groupBy("m_deleted").agg(F.count_distinct("m_source_digest").alias("digests")),
     "select m_deleted, count(distinct k) digests from (select event_type = 'error' m_deleted, case when event_type = 'error' then '' else concat_ws('|', user_id, event_type, value) end k from events) group by 1")
_put("bulk_counts", lambda s, d: counts(_acks(s, d, _payload(True), _by_value())),
     f"select outcome, count(*) n from ({SQL['project_stale_acks']}) group by 1")


def _props_log(spark: SparkSession, d: str) -> DataFrame:
    events = utc_table(spark, d, "events")
    payload = F.concat(F.lit('{"event_id":'), F.col("event_id").cast("string"), F.lit(',"props":'), F.col("props"), F.lit("}"))
    log = _user_log(events, F.lit(1), payload)
    return log.withColumn("resource_ref", F.lit(PROPS.resource)).withColumn("schema_fingerprint", F.lit(PROPS.schema_fingerprint)).withColumn("record_id", F.regexp_extract("event_id", r"\d+", 0))


def json_pointer_exact(spark: SparkSession, d: str) -> DataFrame:
    """Documents whose JSON body has a given value at a declared pointer, and none at another."""
    docs = encode(_props_log(spark, d), PROPS).filter("code is null")
    request = {"resource": PROPS.resource, "query": None, "where": {"props#/k": {"$prefix": "6"}, "props#/missing": {"$isNull": True}}, "facets": [], "highlights": [], "limit": 20}
    return _ids(Search(from_mapping(PROPS, request), docs, "sha256:" + "0" * 64))


_put("json_pointer_exact", json_pointer_exact, "select cast(event_id as varchar) id from events where starts_with(json_extract_string(props, '$.k'), '6') and json_extract_string(props, '$.missing') is null")


def compound_identity(spark: SparkSession, d: str) -> DataFrame:
    """Lines under (order, line): surplus rows of an identity collapse to the last delivered."""
    lines = table(spark, d, "lineitem").groupBy("l_orderkey", "l_linenumber").agg(F.max("l_quantity").alias("l_quantity"), F.count(F.lit(1)).alias("copies"))
    identity = F.to_json(F.array(F.col("l_orderkey"), F.col("l_linenumber").cast("bigint")))
    scope = F.lit("sha256:" + "0" * 64)
    return lines.select(document_id_column(scope, F.lit(LINES.resource), identity).alias("m_document_id"), identity.alias("record_id"), "copies", "l_quantity")


_put("compound_identity", compound_identity, "select sha256('{\"recordId\":[' || l_orderkey || ',' || l_linenumber || '],\"resource\":\"structured:sales.lines\",\"scope\":\"sha256:' || repeat('0', 64) || '\"}') m_document_id, '[' || l_orderkey || ',' || l_linenumber || ']' record_id, count(*) copies, max(l_quantity) l_quantity from lineitem group by l_orderkey, l_linenumber")
_put("archive_document_ids", lambda s, d: utc_table(s, d, "docs_primary").select("m_document_id", document_id_column(F.col("m_scope"), F.col("m_resource"), F.col("m_record_id")).alias("computed")).distinct(),
     "select distinct m_document_id, m_document_id computed from docs_primary")


# -- generations -----------------------------------------------------------------------------------------------------
def _part_log(parts: DataFrame, layout: Layout) -> DataFrame:
    """Parts as mutations, spread over all cores: a million parts are one file of a few MB, which is read in one task."""
    spread = parts.repartition(int(parts.sparkSession.conf.get("spark.sql.shuffle.partitions")), "p_partkey")
    return spread.select(
        F.col("p_partkey").alias("arrival"), F.lit(layout.resource).alias("resource_ref"), F.col("p_partkey").cast("string").alias("record_id"), F.lit(1).cast("bigint").alias("source_sequence"),
        F.lit("1").alias("source_version"), F.lit("1").alias("schema_version"), F.lit(layout.schema_fingerprint).alias("schema_fingerprint"), F.lit("sha256:" + "0" * 64).alias("scope_fingerprint"),
        F.concat(F.lit("part-"), F.col("p_partkey").cast("string")).alias("event_id"), F.to_json(F.struct(*layout.fields)).alias("payload"), F.lit("2026-01-01").cast("timestamp").alias("projected_at"),
    )


def _two_generations(spark: SparkSession, d: str) -> Generations:
    store = Generations(spark, scratch(spark, "parts"), "tests", PARTS, buckets=4)
    parts = table(spark, d, "part")
    for number, rows in ((1, parts.filter("p_size <= 30")), (2, parts)):
        store.create(number)
        store.apply(_part_log(rows, PARTS), number)
    store.activate(1)
    return store


def _small(store: Generations) -> DataFrame:
    request = {"resource": PARTS.resource, "query": None, "where": {"p_retailprice": {"$lt": 1500.0}}, "facets": [], "highlights": [], "limit": 20}
    return _ids(Search(from_mapping(PARTS, request), store.snapshot().docs, "sha256:" + "0" * 64))


def generation_cutover(spark: SparkSession, d: str) -> DataFrame:
    store = _two_generations(spark, d)
    store.activate(2)
    return _small(store)


def generation_rollback(spark: SparkSession, d: str) -> DataFrame:
    store = _two_generations(spark, d)
    store.rollback(store.activate(2))
    store.retire(2, PARTS.fingerprint)
    return _small(store)


_put("generation_cutover", generation_cutover, "select cast(p_partkey as varchar) id from part where p_retailprice < 1500")
_put("generation_rollback", generation_rollback, "select cast(p_partkey as varchar) id from part where p_size <= 30 and p_retailprice < 1500")


def stream_project_latest(spark: SparkSession, d: str) -> DataFrame:
    """The change log as a stream into a generation, in several micro-batches."""
    root = scratch(spark, "stream")
    log = _user_log(utc_table(spark, d, "events"), F.col("event_id") + 1, _payload(True))
    log.repartitionByRange(4, "arrival").write.parquet(f"{root}/log")
    store = Generations(spark, root, "tests", USER_STATE, buckets=4)
    store.create(1)
    store.activate(1)
    stream = spark.readStream.schema(log.schema).option("maxFilesPerTrigger", 2).parquet(f"{root}/log")
    project_stream(stream, store, f"{root}/checkpoint").awaitTermination()
    return _user_columns(store.snapshot().docs.filter("not m_deleted"))


_put("stream_project_latest", stream_project_latest, SQL["project_latest"])


def stream_outcomes(spark: SparkSession, d: str) -> DataFrame:
    """The outcomes of the change log as a stream, by a keyed state, in several micro-batches."""
    root = scratch(spark, "outcomes")
    log = _user_log(utc_table(spark, d, "events"), _by_value(), _payload(True))
    top = log.agg(F.max("arrival")).first()[0] or 0
    for k in range(3):  # files in order of arrival
        part = log.filter((F.col("arrival") > top * k // 3) if k else F.lit(True)).filter(F.col("arrival") <= top * (k + 1) // 3)
        part.coalesce(1).write.parquet(f"{root}/log/part={k}")
    stream = spark.readStream.schema(log.schema).option("maxFilesPerTrigger", 1).option("recursiveFileLookup", "true").parquet(f"{root}/log")
    query, store = outcomes(stream, USER_STATE, f"{root}/store", f"{root}/checkpoint")
    query.awaitTermination()
    return store.acknowledged().select("event_id", "outcome")


_put("stream_outcomes", stream_outcomes, SQL["project_stale_acks"])


def snapshot_pages(spark: SparkSession, d: str) -> DataFrame:
    """Pages of a point in time stay the same although the generation changes between them.

    The first two are read one at a time, before and after the change, all others behind their cursor in one pass.
    """
    store = _two_generations(spark, d)
    lease = store.open_lease()
    order = _order(("p_retailprice", "desc", "last"), ("p_partkey", "asc", "last"))
    request = {"catalog": "structured", "operation": "search", "consistency": "eventual", "targets": [PARTS.resource], "filter": _cmp("lte", "p_size", 30), "order": order, "page": {"size": 500, "pointInTime": True}}
    signer = Signer(SECRET, CURSOR_SECONDS)

    def behind(cursor: str | None) -> Search:
        plan = from_operation(PARTS, {**request, "page": {**request["page"], **({"cursor": cursor} if cursor else {})}}, Limits(), point_in_time=True)
        return Search(plan, store.leased(lease).docs, "sha256:" + "0" * 64)

    rows, cursor = [], None
    with store.holding(lease):
        for n in (1, 2):
            page = behind(cursor).page(signer, snapshot=lease)
            rows += [(n, i["recordRef"]["recordId"]) for i in page["items"]]
            cursor = page["cursor"]
            if cursor is None:
                break
            if n == 1:  # every part of the active generation changes while the pages are read
                store.apply(_part_log(table(spark, d, "part").filter("p_size <= 30").withColumn("p_retailprice", F.lit(1.0)), PARTS), 1)
        pages = spark.createDataFrame(rows, "page int, id string")
        if cursor is not None:
            rest = behind(cursor).pages(f"{scratch(spark, 'pages')}/rows", signer, snapshot=lease, read=2)
            pages = pages.unionByName(rest.select("page", F.col("m_record_id").alias("id")))
    store.close_lease(lease)
    return pages


_put("snapshot_pages", snapshot_pages, "select cast((row_number() over (order by p_retailprice desc, p_partkey) - 1) // 500 + 1 as int) page, cast(p_partkey as varchar) id from part where p_size <= 30")
