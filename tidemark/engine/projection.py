"""Projection: a versioned change log of records turned into search documents.

A bulk is a DataFrame of mutations.  Each is validated and encoded by column expressions and gets an outcome: ``applied``,
``stale`` (a higher sequence was there before), ``permanent`` (it can never be applied).  Equal sequences overwrite;
deletes become tombstones that keep blocking older sequences.

Whether a mutation is stale depends on the highest sequence before it, in order of arrival.  That running maximum is
taken within chunks of arrivals and then over the chunks' maxima, so a record with a third of all mutations is no single
task's work; the surviving document of each record is a plain aggregation.
"""

from __future__ import annotations

import json
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.engine.analysis import chain_of, token_column
from tidemark.engine.layout import FULL_TEXT, HIDDEN, FieldLayout, Layout
from tidemark.engine.values import canonical
from tidemark.functions.jsonvalue import canonical_json, canonical_of, is_json_null, with_values
from tidemark.shipping import ship

APPLIED, STALE, PERMANENT, RETRYABLE = "applied", "stale", "permanent", "retryable"
#: Codes of outcomes (fixed values).
STALE_CODE, MAPPING, INVALID, FOREIGN, DRIFT = "version_conflict", "mapper_parsing", "operation-invalid", "operation-scope", "physical-fingerprint"
#: A mutation as it comes in; ``arrival`` orders a bulk.
MUTATION = T.StructType([
    T.StructField("arrival", T.LongType()), T.StructField("resource_ref", T.StringType()), T.StructField("record_id", T.StringType()),
    T.StructField("source_sequence", T.LongType()), T.StructField("source_version", T.StringType()), T.StructField("schema_version", T.StringType()),
    T.StructField("schema_fingerprint", T.StringType()), T.StructField("scope_fingerprint", T.StringType()), T.StructField("event_id", T.StringType()),
    T.StructField("payload", T.StringType()), T.StructField("projected_at", T.TimestampType()),
])
CHUNK_BITS = 16


#: Canonical JSON texts of scalars and of lists of scalars.
_SCALAR = r'(?:"(?:[^"\\]|\\.)*"|-?[0-9][0-9.eE+-]*|true|false)'
_IDENTITY = rf"^(?:{_SCALAR}|\[{_SCALAR}(?:,{_SCALAR})*\])$"


def document_id_column(scope: Column, resource: Column, record_id: Column, is_canonical: bool = False) -> Column:
    """The document id in the plan: the digest of the canonical text of identity, resource and scope."""
    quoted = F.regexp_extract(F.to_json(F.struct(resource.alias("x"))), r'(?s)^\{"x":(.*)\}$', 1)
    identity = record_id if is_canonical else canonical_json(record_id)
    return F.sha2(F.concat(F.lit('{"recordId":'), identity, F.lit(',"resource":'), quoted, F.lit(',"scope":"'), scope, F.lit('"}')), 256)


def _path(name: str) -> str:
    return "$[" + json.dumps(name, ensure_ascii=False) + "]"


def _pointer(pointer: str) -> str:
    steps = [p.replace("~1", "/").replace("~0", "~") for p in pointer.split("/")[1:]]
    return "$" + "".join(f"[{int(p)}]" if p.isdigit() else "[" + json.dumps(p, ensure_ascii=False) + "]" for p in steps)


_VARIANT = {"recordRef": None, "objectRef": None, "json": None}


def _value(body: Column, f: FieldLayout) -> tuple[Column, Column]:
    """(value, bad) of one field of a payload."""
    raw = F.try_variant_get(body, _path(f.name), "variant")
    kind = F.schema_of_variant(raw)
    absent = raw.isNull()
    null = kind == "VOID"
    if f.many:
        value = F.try_variant_get(body, _path(f.name), f.type.simpleString())
        holes = F.coalesce(F.exists(value, lambda x: x.isNull()), F.lit(False))
        return value, ~absent & (value.isNull() | ~kind.startswith("ARRAY") | holes)
    if f.kind in _VARIANT:
        return F.when(~null, F.to_json(raw)), F.lit(False)
    value = F.try_variant_get(body, _path(f.name), f.type.simpleString())
    bad = ~absent & ~null & value.isNull()
    compound = kind.startswith("ARRAY") | kind.startswith("OBJECT")
    if f.kind == "wgs84Point":
        return value, bad | (~absent & ~null & ((F.size(value) != 2) | F.exists(value, lambda x: x.isNull())))
    bad = bad | (~absent & compound)
    if f.kind == "boolean":
        bad = bad | (~absent & ~null & (kind != "BOOLEAN"))
    elif f.kind in ("string", "uuid", "enum", "bytes"):
        value = F.when(kind == "STRING", value).otherwise(F.when(~null, F.to_json(raw)))
    elif f.kind in ("int8", "int16", "int32"):
        bound = {"int8": 7, "int16": 15, "int32": 31}[f.kind]
        bad = bad | ~value.between(-(1 << bound), (1 << bound) - 1)
    return value, F.coalesce(bad, F.lit(False))


def encode(mutations: DataFrame, layout: Layout) -> DataFrame:
    """Mutations with their document columns, a ``code`` that is null where they are valid, and ``arrival``."""
    names = [f.name for f in layout.fields.values() if f.pointer is None]
    df = mutations.select(*MUTATION.fieldNames()).withColumn("_deleted", is_json_null(F.col("payload")))
    df = with_values(df, {"_body": F.when(~F.col("_deleted"), F.col("payload")), "_name": F.col("record_id")})
    df = df.withColumn("_identity", canonical_of(F.col("_name"), F.col("record_id"))).drop("_name")
    body = F.col("_body")
    object_ = F.coalesce(F.schema_of_variant(body).startswith("OBJECT"), F.lit(False))
    fields = {f.name: _value(body, f) for f in layout.fields.values() if f.pointer is None}
    unknown = F.size(F.array_except(F.json_object_keys("payload"), F.array(*map(F.lit, names)))) > 0
    wrong = reduce(Column.__or__, [bad for _, bad in fields.values()])
    sha = r"^sha256:[0-9a-f]{64}$"
    token = lambda c: F.coalesce((F.length(c) > 0) & (F.octet_length(c) <= 256) & ~F.col(c).rlike(r"[\x00-\x1f\x7f]"), F.lit(False))
    named = F.coalesce(F.col("_identity").rlike(_IDENTITY), F.lit(False))
    code = (
        F.when(F.col("resource_ref").isNull() | (F.col("resource_ref") != layout.resource), FOREIGN)
        .when(~(token("event_id") & token("source_version") & token("schema_version") & named), INVALID)
        .when(F.col("source_sequence").isNull() | (F.col("source_sequence") < 1) | ~F.coalesce(F.col("scope_fingerprint").rlike(sha), F.lit(False)), INVALID)
        .when(F.col("schema_fingerprint").isNull() | (F.col("schema_fingerprint") != layout.schema_fingerprint), DRIFT)
        .when(~F.col("_deleted") & ~object_, MAPPING)
        .when(~F.col("_deleted") & unknown, INVALID)
        .when(~F.col("_deleted") & wrong, MAPPING)
    )
    values = []
    for f in layout.fields.values():
        if f.pointer is None:
            value = fields[f.name][0]
        else:
            source = F.try_variant_get(body, _path(f.source), "variant")
            leaf = F.try_variant_get(source, _pointer(f.pointer), "variant")
            value = F.when(F.schema_of_variant(leaf) == "STRING", F.try_variant_get(leaf, "$", "string")).when(F.schema_of_variant(leaf) != "VOID", F.to_json(leaf))
        values.append(value.cast(f.type).alias(f.column))
    df = df.select("*", code.alias("code"), document_id_column(F.col("scope_fingerprint"), F.col("resource_ref"), F.col("_identity"), True).alias("m_document_id"), *values)
    digest = F.concat(F.lit("sha256:"), F.sha2(F.when(~F.col("_deleted"), F.to_json(F.struct(*sorted(f.column for f in layout.fields.values())))).otherwise("null"), 256))
    return df.select("arrival", "code", F.col("scope_fingerprint").alias("m_scope"), F.col("resource_ref").alias("m_resource"), F.col("_identity").alias("m_record_id"),
                     F.col("source_version").alias("m_source_version"), F.col("source_sequence").alias("m_source_sequence"), F.col("schema_version").alias("m_schema_version"),
                     F.col("schema_fingerprint").alias("m_schema_fingerprint"), digest.alias("m_source_digest"), F.col("event_id").alias("m_event_id"),
                     F.col("projected_at").alias("m_projected_at"), F.col("_deleted").alias("m_deleted"), "m_document_id", *[f.column for f in layout.fields.values()])


def with_tokens(docs: DataFrame, layout: Layout) -> DataFrame:
    """Documents with the derived columns of their text fields, in the generation's column order."""
    ship(docs.sparkSession)
    for f in layout.text_fields:
        docs = docs.withColumn(f.tokens, token_column(F.col(f.column), chain_of(f.language, layout.analysis)))
        docs = docs.withColumn(f.length, F.when(F.col(f.column).isNotNull(), F.size(f.tokens)))
    return docs.select(*[F.col(s.name).cast(s.dataType).alias(s.name) for s in layout.struct()])


def acknowledge(encoded: DataFrame, stored: DataFrame | None = None, chunk_bits: int = CHUNK_BITS) -> DataFrame:
    """(arrival, event_id, record_id, source_sequence, outcome, code), one row per mutation.

    ``stored`` has (m_document_id, m_source_sequence) of the documents that were there before.
    """
    valid = encoded.filter("code is null").select(
        "arrival", "m_event_id", "m_record_id", "m_source_sequence", "m_document_id", F.shiftright("arrival", chunk_bits).alias("_chunk")
    )
    chunks = valid.groupBy("m_document_id", "_chunk").agg(F.max("m_source_sequence").alias("_top"))
    before_chunk = F.max("_top").over(W.partitionBy("m_document_id").orderBy("_chunk").rowsBetween(W.unboundedPreceding, -1))
    chunks = chunks.select("m_document_id", "_chunk", before_chunk.alias("_earlier"))
    within = F.max("m_source_sequence").over(W.partitionBy("m_document_id", "_chunk").orderBy("arrival").rowsBetween(W.unboundedPreceding, -1))
    rows = valid.withColumn("_within", within).join(chunks, ["m_document_id", "_chunk"])
    highest = F.greatest(F.coalesce("_within", F.lit(0)), F.coalesce("_earlier", F.lit(0)))
    if stored is not None:
        rows = rows.join(stored.select("m_document_id", F.col("m_source_sequence").alias("_stored")), "m_document_id", "left")
        highest = F.greatest(highest, F.coalesce("_stored", F.lit(0)))
    stale = F.col("m_source_sequence") < highest
    done = rows.select("arrival", "m_event_id", "m_record_id", "m_source_sequence", F.when(stale, STALE).otherwise(APPLIED).alias("outcome"), F.when(stale, STALE_CODE).alias("code"))
    failed = encoded.filter("code is not null").select("arrival", "m_event_id", "m_record_id", "m_source_sequence", F.lit(PERMANENT).alias("outcome"), "code")
    out = done.unionByName(failed)
    return out.select("arrival", F.col("m_event_id").alias("event_id"), F.col("m_record_id").alias("record_id"), F.col("m_source_sequence").alias("source_sequence"), "outcome", "code")


def survivors(encoded: DataFrame) -> DataFrame:
    """The document each record has after the bulk alone: of its highest sequence, the last to arrive."""
    order = F.struct("m_source_sequence", "arrival")
    columns = [c for c in encoded.columns if c not in ("m_document_id", "code")]
    best = encoded.filter("code is null").groupBy("m_document_id").agg(F.max_by(F.struct(*columns), order).alias("_d"))
    return best.select("m_document_id", *[F.col("_d")[c].alias(c) for c in columns if c != "arrival"])


def counts(acks: DataFrame) -> DataFrame:
    return acks.groupBy("outcome").agg(F.count(F.lit(1)).alias("n"))


HIDDEN_NAMES = HIDDEN.fieldNames()
__all__ = ["APPLIED", "MUTATION", "PERMANENT", "RETRYABLE", "STALE", "acknowledge", "canonical", "counts", "document_id_column", "encode", "survivors", "with_tokens"]
