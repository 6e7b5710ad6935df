"""Tables as search datasets: a DataFrame brought into a layout's physical form, lazily.

Filters on logical columns stay filters on the table's own columns (the projection is a renaming), so they are pushed
down to the scan; constant hidden columns are folded away.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.engine.analysis import chain_of, token_column
from tidemark.engine.layout import FULL_TEXT, HIDDEN, Layout
from tidemark.shipping import ship


def as_documents(df: DataFrame, layout: Layout, columns: Mapping[str, Column], document_id: Column, hidden: Mapping[str, Column] | None = None) -> DataFrame:
    """``columns`` has an expression for each field; ``hidden`` replaces defaults of hidden columns."""
    ship(df.sparkSession)
    given = {
        "m_document_id": document_id, "m_scope": F.lit("all"), "m_resource": F.lit(layout.resource), "m_record_id": document_id.cast("string"),
        "m_source_version": F.lit("1"), "m_source_sequence": F.lit(1).cast("bigint"), "m_schema_version": F.lit("1"),
        "m_schema_fingerprint": F.lit(layout.schema_fingerprint), "m_source_digest": F.lit(""), "m_event_id": F.lit(""),
        "m_projected_at": F.lit(None).cast("timestamp"), "m_deleted": F.lit(False), **(hidden or {}),
    }
    out = [given[h.name].alias(h.name) for h in HIDDEN]
    for f in layout.fields.values():
        value = columns[f.name].cast(f.type)
        out.append(value.alias(f.column))
        if FULL_TEXT in f.modes:
            tokens = token_column(value, chain_of(f.language, layout.analysis))
            out += [tokens.alias(f.tokens), F.when(value.isNotNull(), F.size(tokens)).alias(f.length)]
    return df.select(*out)
