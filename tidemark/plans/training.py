"""Queries p1 to p5: the general operators over the change log and the two copies."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.jsonvalue import canonical_of, is_json_null, object_of, with_values
from tidemark.operators.changefeed import FeedStore, change_images, current_state, first_deliveries
from tidemark.operators import drift
from tidemark.operators.dedup import ExactlyOnceStore
from tidemark.operators.diff import compare_copies
from tidemark.operators.incremental import MerkleRuns, replay
from tidemark.sources.tables import table
from tidemark.storage import scratch, write_once


#: What a message carries besides the three columns that decide.
_MESSAGE = [
    "batch_id", "resource_ref", "record_id", "source_sequence", "source_version", "schema_version", "schema_fingerprint", "scope_fingerprint", "payload",
]


def _store(spark: SparkSession, d: str, columns: list[str]) -> ExactlyOnceStore:
    """The deliveries taken in as a history and a bulk that comes after it."""
    mutations = table(spark, d, "mutations")
    store = ExactlyOnceStore(spark, scratch(spark, "once"), mutations.schema, "event_id", "projected_at", "delivery_id", columns)
    low, high = mutations.agg(F.min("batch_id"), F.max("batch_id")).first()
    cut = F.coalesce(F.col("batch_id") <= F.lit(((low or 0) + (high or 0)) // 2), F.lit(False))
    store.apply(mutations.filter(cut), "history")
    store.apply(mutations.filter(~cut), "incoming")
    return store


def p1_found(spark: SparkSession, d: str) -> DataFrame:
    return _store(spark, d, []).surplus().select("delivery_id")


def p1_winners(spark: SparkSession, d: str) -> DataFrame:
    """The one delivery kept of each event, the whole message with its payload."""
    return _store(spark, d, _MESSAGE).winners().select("delivery_id", "event_id", *_MESSAGE)


def p1_two_stores(spark: SparkSession, d: str) -> DataFrame:
    """Deliveries that were lost, delivered again: the surplus of a store that took a part of its bulks in twice."""
    mutations = table(spark, d, "mutations")
    store = ExactlyOnceStore(spark, scratch(spark, "once"), mutations.schema, "event_id", "projected_at", "delivery_id", ["batch_id"])
    low, high = mutations.agg(F.min("batch_id"), F.max("batch_id")).first()
    third = ((high or 0) - (low or 0)) // 3 + (low or 0)
    store.apply(mutations.filter(F.col("batch_id") <= third + third - (low or 0)))
    store.apply(mutations.filter(F.col("batch_id") > third))
    return store.surplus().select("event_id", "delivery_id", "batch_id")


def p2_found(spark: SparkSession, d: str) -> DataFrame:
    return replay(table(spark, d, "mutations"), table(spark, d, "run_log"), table(spark, d, "run_journal"), scratch(spark, "runs"))


def _two_runs(spark: SparkSession, d: str, content: list[str]) -> DataFrame:
    """The production store: one run over the first half of the batches, then what a run over all has still to process."""
    mutations = table(spark, d, "mutations")
    low, high = mutations.agg(F.min("batch_id"), F.max("batch_id")).first()
    runs = MerkleRuns(spark, scratch(spark, "merkle"), "event_id", "source_sequence", content=content)
    runs.run(mutations.filter(F.col("batch_id") <= ((low or 0) + (high or 0)) // 2))
    return runs.run(mutations)


def p2_increment(spark: SparkSession, d: str) -> DataFrame:
    return _two_runs(spark, d, [])


def p2_changed(spark: SparkSession, d: str) -> DataFrame:
    """The same where an event that came again with another payload or version is changed."""
    return _two_runs(spark, d, ["payload", "source_version"])


def p3_found(spark: SparkSession, d: str) -> DataFrame:
    root = scratch(spark, "drift")
    return drift.report(table(spark, d, "mutations"), lambda df, name: write_once(df, f"{root}/{name}"))


def p3_unified(spark: SparkSession, d: str) -> DataFrame:
    """All payloads as one table of typed branches, under the newest names of their fields."""
    return drift.unified(table(spark, d, "mutations"), p3_found(spark, d))


def _changes(spark: SparkSession, d: str) -> DataFrame:
    """(event_id, delivery_id, source_sequence, kind, record) of each delivery; the record is a 128-bit digest of its key."""
    payload, gone = F.col("payload"), is_json_null(F.col("payload"))
    rows = table(spark, d, "mutations").filter(F.col("event_id") != "")
    rows = with_values(rows, {"body": F.when(~gone, payload), "name": F.col("record_id")}).select(
        "event_id", "delivery_id", "batch_id", "source_sequence", "resource_ref", "scope_fingerprint",
        canonical_of(F.col("name"), F.col("record_id")).alias("record_id"),
        F.when(gone, "delete").when(object_of(F.col("body"), payload), "upsert").alias("kind"),
    )
    return rows.select("event_id", "delivery_id", "batch_id", "source_sequence", "kind", F.unhex(F.md5(F.to_json(
        F.struct("resource_ref", "scope_fingerprint", "record_id"), {"ignoreNullFields": "false"}))).alias("record"))


def p4_found(spark: SparkSession, d: str) -> DataFrame:
    events = first_deliveries(_changes(spark, d), "event_id", "delivery_id", ["source_sequence", "kind", "record"]).filter("kind is not null")
    changes = change_images(events, [F.hex("record")], "source_sequence", F.col("kind") == "delete")
    return current_state(changes, "record", "sequence", "image").select(F.col("image").alias("event_id"))


def p4_two_bulks(spark: SparkSession, d: str) -> DataFrame:
    """The same state, the feed taken in by two bulks of a store, with late and repeated changes in the second."""
    rows = _changes(spark, d).select(F.col("event_id").alias("event"), F.col("delivery_id").alias("at"), "batch_id", "record", F.col("source_sequence").alias("sequence"), "kind")
    low, high = table(spark, d, "mutations").agg(F.min("batch_id"), F.max("batch_id")).first()
    cut = F.coalesce(F.col("batch_id") <= F.lit(((low or 0) + (high or 0)) // 2), F.lit(False))
    store = FeedStore(spark, scratch(spark, "feed"))
    store.apply(rows.filter(cut).drop("batch_id"), "history")
    store.apply(rows.filter(~cut).drop("batch_id"), "incoming")
    return store.current().select(F.col("event").alias("event_id"))


def p4_payloads(spark: SparkSession, d: str) -> DataFrame:
    """The current payload of each record that exists: that of the first delivery of the event that gives its state."""
    rows = table(spark, d, "mutations").select("event_id", "delivery_id", "resource_ref", "source_sequence", "payload")
    rows = rows.join(p4_found(spark, d), "event_id", "left_semi")
    best = rows.groupBy("event_id").agg(F.min_by(F.struct("resource_ref", "source_sequence", "payload"), "delivery_id").alias("c"))
    return best.select("event_id", "c.*")


def p5_found(spark: SparkSession, d: str) -> DataFrame:
    return compare_copies(table(spark, d, "docs_primary"), table(spark, d, "docs_replica"), "m_document_id", ignore=("m_projected_at",))


QUERIES = {f.__name__: f for f in (p1_found, p1_winners, p1_two_stores, p2_found, p2_increment, p2_changed, p3_found, p3_unified, p4_found, p4_two_bulks, p4_payloads, p5_found)}

_VALID = "event_id is not null and event_id <> ''"
_P5 = [
    "m_scope", "m_resource", "m_record_id", "m_source_version", "m_source_sequence", "m_schema_version", "m_schema_fingerprint", "m_source_digest",
    "m_event_id", "m_deleted", "title", "body", "category", "published", "priority", "active", "labels",
]

SQL = {
    "p1_found": f"select delivery_id from (select delivery_id, row_number() over (partition by event_id order by projected_at nulls last, delivery_id) k from mutations where {_VALID}) where k > 1",
    "p1_winners": f"select delivery_id, event_id, {', '.join(_MESSAGE)} from (select *, row_number() over (partition by event_id order by projected_at nulls last, delivery_id) k from mutations where {_VALID}) where k = 1",
    "p2_found": f"""with e as (select event_id, min(received_at) seen from mutations where {_VALID} group by 1),
        f as (select e.event_id, min(run_id) run_id from e join run_log r on r.run_state = 'succeeded' and r.snapshot_at >= e.seen group by 1),
        j as (select event_id, min(run_id) done from run_journal where outcome <> 'retryable' group by 1)
        select f.run_id, f.event_id from f left join j using (event_id) where done is null or done >= f.run_id""",
    "p3_found": """with m as (
          select *, case when json_type(record_id) = 'VARCHAR' then 's' || json_extract_string(record_id, '$') when json_type(record_id) = 'ARRAY' then 'a' || json_extract_string(record_id, '$[0]') || chr(1) || json_extract_string(record_id, '$[1]') else 'n' || trim(record_id) end rid
          from mutations where schema_version is not null and schema_fingerprint is not null and resource_ref is not null),
        o as (select * from m where json_valid(payload) and json_type(payload) = 'OBJECT'),
        t as (select o.delivery_id, o.resource_ref r, o.schema_version v, o.schema_fingerprint f, o.source_sequence q, o.scope_fingerprint s, o.rid,
              replace(substr(t.fullkey, 2), '.', '/') field, cast(t."value" as varchar) val,
              case t."type" when 'VARCHAR' then 'string' when 'BIGINT' then 'integer' when 'UBIGINT' then 'integer' when 'HUGEINT' then 'integer' when 'DOUBLE' then 'decimal' when 'BOOLEAN' then 'boolean' when 'ARRAY' then 'array' end kind
              from o, lateral json_tree(o.payload) t where t."type" <> 'OBJECT' and not contains(t.fullkey, '[')),
        n as (select r, v, f, count(*) payloads from (select resource_ref r, schema_version v, schema_fingerprint f from o) group by all),
        shape as (select n.*, row_number() over (partition by n.r order by a.q, n.v, n.f) place from n join (select resource_ref r, schema_version v, schema_fingerprint f, min(source_sequence) q from m group by all) a using (r, v, f)),
        fields as (select shape.*, c.field from shape join (select r, v, f, field, count(*) carried from t group by all) c using (r, v, f) where c.carried * 10 >= shape.payloads),
        kinds as (select r, v, f, field, kind from (select *, row_number() over (partition by r, v, f, field order by c desc, list_position(['string', 'integer', 'decimal', 'boolean', 'array'], kind)) k from (select r, v, f, field, kind, count(*) c from t where kind is not null group by r, v, f, field, kind)) where k = 1),
        typed as (select fields.*, kinds.kind from fields left join kinds using (r, v, f, field)),
        pair as (select a.r, a.v v0, a.f f0, b.v, b.f, b.place from shape a join shape b on a.r = b.r and b.place = a.place + 1),
        gone as (select pair.*, x.field from pair join typed x on x.r = pair.r and x.place = pair.place - 1 where not exists (select 1 from typed y where y.r = pair.r and y.place = pair.place and y.field = x.field)),
        come as (select pair.*, x.field from pair join typed x on x.r = pair.r and x.place = pair.place where not exists (select 1 from typed y where y.r = pair.r and y.place = pair.place - 1 and y.field = x.field)),
        last as (select * from (select resource_ref r, schema_version v, schema_fingerprint f, scope_fingerprint s, rid, delivery_id, row_number() over (partition by resource_ref, schema_version, schema_fingerprint, scope_fingerprint, rid order by source_sequence desc, delivery_id desc) k from o) where k = 1),
        first as (select * from (select resource_ref r, schema_version v, schema_fingerprint f, scope_fingerprint s, rid, delivery_id, row_number() over (partition by resource_ref, schema_version, schema_fingerprint, scope_fingerprint, rid order by source_sequence, delivery_id) k from o) where k = 1),
        old as (select g.r, g.place, g.field, l.s, l.rid, t.val from gone g join last l on l.r = g.r and l.v = g.v0 and l.f = g.f0 join t on t.delivery_id = l.delivery_id and t.field = g.field where t.kind is not null),
        new as (select c.r, c.place, c.field, l.s, l.rid, t.val from come c join first l on l.r = c.r and l.v = c.v and l.f = c.f join t on t.delivery_id = l.delivery_id and t.field = c.field where t.kind is not null),
        moved as (select old.r, old.place, old.field, new.field new_field, count(*) n_both, count(*) filter (old.val = new.val) same from old join new on old.r = new.r and old.place = new.place and old.s is not distinct from new.s and old.rid = new.rid group by old.r, old.place, old.field, new.field having count(*) filter (old.val = new.val) * 2 > count(*)),
        renamed as (select * from (select *, row_number() over (partition by r, place, field order by same / n_both desc, same desc, new_field) a, row_number() over (partition by r, place, new_field order by same / n_both desc, same desc, field) b from moved) where a = 1 and b = 1)
        select r resource_ref, v schema_version, f schema_fingerprint, 'removed' "change", field, '' new_field from gone where not exists (select 1 from renamed n where n.r = gone.r and n.place = gone.place and n.field = gone.field)
        union all select r, v, f, 'added', field, '' from come where not exists (select 1 from renamed n where n.r = come.r and n.place = come.place and n.new_field = come.field)
        union all select b.r, b.v, b.f, 'retyped', b.field, '' from typed a join typed b on a.r = b.r and b.place = a.place + 1 and a.field = b.field where a.kind <> b.kind
        union all select n.r, pair.v, pair.f, 'renamed', n.field, n.new_field from renamed n join pair on pair.r = n.r and pair.place = n.place""",
    "p4_found": f"""with m as (select *, case when payload is null or trim(payload) = 'null' then 'delete' when json_valid(payload) and json_type(payload) = 'OBJECT' then 'upsert' end kind from mutations where {_VALID}),
        first as (select *, row_number() over (partition by event_id order by delivery_id) k from m),
        e as (select *, case when json_type(record_id) = 'VARCHAR' then 's' || json_extract_string(record_id, '$') when json_type(record_id) = 'ARRAY' then 'a' || json_extract_string(record_id, '$[0]') || chr(1) || json_extract_string(record_id, '$[1]') else 'n' || trim(record_id) end rid from first where k = 1 and kind is not null),
        l as (select *, row_number() over (partition by resource_ref, scope_fingerprint, rid order by source_sequence desc, delivery_id desc) p from e)
        select event_id from l where p = 1 and kind = 'upsert'""",
    "p5_found": """with p as (select distinct * exclude (m_projected_at) from docs_primary), r as (select distinct * exclude (m_projected_at) from docs_replica),
        j as (select coalesce(p.m_document_id, r.m_document_id) m_document_id, p.m_document_id pk, r.m_document_id rk, """
    + ", ".join(f"p.{c} is distinct from r.{c} d_{c}" for c in _P5)
    + """ from p full join r on p.m_document_id = r.m_document_id)
        select m_document_id, 'only_primary' finding, '' field_name from j where rk is null union all select m_document_id, 'only_replica', '' from j where pk is null """
    + " ".join(f"union all select m_document_id, 'differs', '{c}' from j where pk is not null and rk is not null and d_{c}" for c in _P5),
}

SQL["p2_increment"] = f"select event_id from mutations where {_VALID} group by 1 having min(batch_id) > (select (min(batch_id) + max(batch_id)) // 2 from mutations)"
SQL["p1_two_stores"] = f"select event_id, delivery_id, batch_id from (select event_id, delivery_id, batch_id, row_number() over (partition by event_id order by projected_at nulls last, delivery_id) k from mutations where {_VALID}) where k > 1"
SQL["p2_changed"] = f"select distinct event_id from (select event_id, bool_or(batch_id <= (select (min(batch_id) + max(batch_id)) // 2 from mutations)) old from mutations where {_VALID} group by event_id, source_sequence, payload, source_version) where not old"
SQL["p4_two_bulks"] = SQL["p4_found"]
SQL["p4_payloads"] = f"select event_id, resource_ref, source_sequence, payload from (select *, row_number() over (partition by event_id order by delivery_id) k from mutations where event_id in ({SQL['p4_found']})) where k = 1"
