"""The test tables as search resources."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.engine.dataset import as_documents
from tidemark.engine.layout import DocumentProfile, Field, Layout, Schema, SearchProfile, compile_layout
from tidemark.sources.tables import utc_table

DOCUMENTS = compile_layout(
    Schema("structured:corpus.documents", (
        Field("doc_id", "int64"), Field("text", "string"), Field("lang", "string"), Field("source", "string"), Field("n_chars", "int64"),
        Field("case_ref", "string"), Field("collected_at", "utcTimestamp"),
    ), ("doc_id",)),
    SearchProfile(("text",), ("case_ref", "lang", "source"), ("text",), analysis="plain"),
)
ENGLISH = compile_layout(
    Schema("structured:corpus.english", (
        Field("doc_id", "int64"), Field("text", "string", language="en"), Field("lang", "string"), Field("source", "string"),
        Field("n_chars", "int64"), Field("case_ref", "string"), Field("collected_at", "utcTimestamp"),
    ), ("doc_id",)),
    SearchProfile(("text",), ("lang", "source"), ("text",)),
)
ORDERS = compile_layout(
    Schema("structured:sales.orders", (
        Field("o_orderkey", "int64"), Field("o_custkey", "int64"), Field("o_orderstatus", "string"), Field("o_totalprice", "float64"),
        Field("o_orderdate", "utcTimestamp"), Field("o_orderpriority", "string"),
    ), ("o_orderkey",)),
    SearchProfile(facets=("o_orderpriority", "o_orderstatus")),
)
PARTS = compile_layout(
    Schema("structured:sales.parts", (
        Field("p_partkey", "int64"), Field("p_name", "string"), Field("p_brand", "string"), Field("p_type", "string"), Field("p_size", "int32"),
        Field("p_retailprice", "float64"),
    ), ("p_partkey",)),
    SearchProfile(("p_name",), ("p_brand", "p_type"), analysis="plain"),
)
ARCHIVE = compile_layout(
    Schema("structured:investigation.archive", (
        Field("title", "string"), Field("body", "string"), Field("category", "string"), Field("published", "utcTimestamp"), Field("priority", "int32"),
        Field("active", "boolean"), Field("labels", "string", many=True),
    ), ("title",)),
    SearchProfile(("title", "body"), ("category", "labels"), ("title", "body"), analysis="plain"),
)
VECTORS = compile_layout(
    Schema("structured:corpus.vectors", (Field("vec_id", "int64"), Field("embedding", "float64", many=True), Field("label", "int32")), ("vec_id",)),
    SearchProfile(),
)
CUSTOMERS = compile_layout(
    Schema("structured:sales.customers", (
        Field("c_custkey", "int64"), Field("c_name", "string"), Field("c_acctbal", "float64"), Field("c_mktsegment", "string"),
    ), ("c_custkey",)),
    SearchProfile(facets=("c_mktsegment",)),
)
#: Events as a change log: the state of each user.
USER_STATE = compile_layout(
    Schema("structured:activity.users", (Field("user_id", "int64"), Field("event_type", "string"), Field("value", "float64")), ("user_id",)),
    SearchProfile(facets=("event_type",)),
)
PROPS = compile_layout(
    Schema("structured:activity.events", (Field("event_id", "int64"), Field("props", "json")), ("event_id",)),
    DocumentProfile("props", ("/k", "/missing"), facets=("/k",)),
)
LINES = compile_layout(
    Schema("structured:sales.lines", (Field("l_orderkey", "int64"), Field("l_linenumber", "int64"), Field("l_quantity", "float64")), ("l_orderkey", "l_linenumber")),
    SearchProfile(),
)

_TABLES = {id(DOCUMENTS): "documents", id(ENGLISH): "documents", id(ORDERS): "orders", id(PARTS): "part", id(VECTORS): "embeddings"}


def documents_of(spark: SparkSession, d: str, layout: Layout) -> DataFrame:
    """A table as the documents of a layout; ids are padded so that they sort like the key."""
    if layout is ARCHIVE:
        df = utc_table(spark, d, "docs_primary").dropDuplicates(["m_document_id"])
        hidden = {c: F.col(c) for c in df.columns if c.startswith("m_")} | {"m_scope": F.lit("all")}  # one tenant's view of the whole table
        return as_documents(df, layout, {f: F.col(f) for f in layout.fields}, F.col("m_document_id"), hidden)
    if layout is CUSTOMERS:
        df = utc_table(spark, d, "customer")
        hidden = {"m_scope": F.col("c_nationkey").cast("string"), "m_record_id": F.col("c_custkey").cast("string")}
        return as_documents(df, layout, {f: F.col(f) for f in layout.fields}, F.lpad(F.col("c_custkey").cast("string"), 20, "0"), hidden)
    df = utc_table(spark, d, _TABLES[id(layout)])
    key = layout.identity[0]
    hidden = {"m_record_id": F.col(key).cast("string")}
    return as_documents(df, layout, {f: F.col(f) for f in layout.fields}, F.lpad(F.col(key).cast("string"), 20, "0"), hidden)
