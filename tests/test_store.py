"""Projection, generations, sessions and streams, end to end, against a model in memory."""

import json
import random
import time
from datetime import datetime
from functools import partial

import pytest

from tests.test_engine import PLANTS, PROFILE
from tidemark.engine.analysis import analyse
from tidemark.engine.cursor import KeyRing, Signer
from tidemark.engine.errors import ConfigurationError, Conflict, CursorRejected, FingerprintDrift, Incompatible, InvalidRequest, LifecycleError, LimitExceeded, NotFound, Unplaced, Unsupported
from tidemark.engine.generation import Generations
from tidemark.engine.layout import DocumentProfile, Field, Schema, SearchProfile, compile_layout, language_of
from tidemark.engine.limits import Limits
from tidemark.engine.projection import MUTATION, acknowledge, encode, survivors
from tidemark.engine.request import from_mapping, from_operation
from tidemark.engine.search import Search
from tidemark.engine.session import Session
from tidemark.engine.settings import Settings
from tidemark.engine.values import document_id, scope_fingerprint
from tidemark.plans.search import QUERIES
from tidemark.storage import Manifest, PublishConflict
from tidemark.streaming.outcomes import Outcomes, outcomes
from tidemark.streaming.sink import project_stream

LAYOUT = compile_layout(PLANTS, PROFILE)
BARE = compile_layout(PLANTS)  # the same fields without text, so without an index
NORTH, SOUTH = scope_fingerprint("north", {"glasshouse": "2"}), scope_fingerprint("south")
SPRING = datetime(2031, 3, 20, 12, 0)


def _row(n, record, sequence, payload, scope=NORTH, layout=LAYOUT, **changes):
    row = {
        "arrival": n, "resource_ref": layout.resource, "record_id": json.dumps(record), "source_sequence": sequence, "source_version": "rev-7", "schema_version": "3",
        "schema_fingerprint": layout.schema_fingerprint, "scope_fingerprint": scope, "event_id": f"e{n}", "payload": payload if isinstance(payload, str | None) else json.dumps(payload), "projected_at": SPRING,
    }
    return tuple({**row, **changes}[f] for f in MUTATION.fieldNames())


def _plant(code, notes, family="Rosaceae", height=40, **more):
    return {"code": code, "label": f"{family} {code}", "notes": notes, "family": family, "checked": "2031-03-01T09:00:00Z", "height": height, "thrives": height % 2 == 0, "beds": [family[:1], code[:1]], **more}


#: A small garden: three plants of one scope, one of another.
GARDEN = [
    _row(11, "rose", 5, _plant("rose", "moss between stones, thorny moss", height=90)), _row(12, "fern", 6, _plant("fern", "жёлтый мох у воды", "Polypodiaceae", 35)),
    _row(13, "pine", 7, _plant("pine", "苔藓和松树 moss", "Pinaceae", 210)), _row(14, "kelp", 8, _plant("kelp", "moss of the other tenant", "Laminaria", 3), SOUTH),
]


def _outcomes(df):
    return [r.outcome for r in df.collect()]


@pytest.fixture
def session(spark, tmp_path):
    with Session(spark, str(tmp_path), "glass", b"a secret of some length", point_in_time=True) as s:
        store = s.bind(LAYOUT, buckets=2)
        store.create(1)
        store.activate(1)
        yield s


def _find(session, query=None, where=None, south=False, **more):
    request = {"resource": LAYOUT.resource, "query": query, "where": where or {}, "facets": [], "highlights": [], "limit": 10, **more}
    return session.search(request, "south") if south else session.search(request, "north", {"glasshouse": "2"})


def _records(result):
    return sorted(json.loads(i["recordRef"]["recordId"]) for i in result["items"])


def _mutations(spark, rows):
    return spark.createDataFrame(rows, MUTATION)


class _Model:
    """What a store must hold: per record the highest sequence, of equal ones the last to arrive."""

    def __init__(self):
        self.rows = {}

    def apply(self, row):
        _, _, record, sequence, *_ = row
        scope, payload = row[7], row[9]
        known = self.rows.get((scope, record))
        stale = known is not None and sequence < known[0]
        if not stale:
            self.rows[scope, record] = (sequence, None if payload is None else json.loads(payload))
        return "stale" if stale else "applied"

    def find(self, scope, word, low):
        """Records of a scope whose notes have a word and whose height is at least so much."""
        found = (json.loads(r) for (s, r), (_, p) in self.rows.items() if s == scope and p is not None and word in analyse(p["notes"], "default") and p["height"] >= low)
        return sorted(found)


def test_bulk_after_bulk_equals_the_model(spark, tmp_path):
    """Large and small bulks, deletes, late and repeated sequences; what searches see in the end, with and without the index."""
    rnd = random.Random(0)
    words = ["moss", "stone", "shade", "frost", "мох", "苔藓"]
    model, store = _Model(), Generations(spark, str(tmp_path), "glass", LAYOUT, buckets=2, bucket_rows=16)
    store.create(1)
    store.activate(1)
    n = 0
    for size in (60, 3, 25, 4):
        rows = []
        for _ in range(size):
            n += 1
            code = f"p{rnd.randint(0, 40)}"
            payload = None if rnd.random() < 0.15 else _plant(code, " ".join(rnd.choice(words) for _ in range(rnd.randint(1, 9))), height=rnd.randint(1, 99))
            rows.append(_row(n, code, rnd.randint(1, 50), payload, rnd.choice([NORTH, NORTH, SOUTH])))
        assert _outcomes(store.apply(_mutations(spark, rows)).orderBy("arrival")) == [model.apply(r) for r in rows]
        snapshot = store.snapshot()
        assert {(r.m_scope, r.m_record_id, r.m_source_sequence, r.m_deleted) for r in snapshot.docs.collect()} == {(s, r, q, p is None) for (s, r), (q, p) in model.rows.items()}
    state = Manifest(store._generation(1)).latest()[1]
    assert len(state["segments"]) == 2 and state["segments"][0]["buckets"] >= 4  # 25 rows united all, in more buckets; the last bulk lies behind
    for query in ({"text": "moss frost Rosaceae"}, {"text": "moss frost", "operator": "and"}, {"text": "mos", "fuzziness": 1}):
        plan = from_mapping(LAYOUT, {"resource": LAYOUT.resource, "query": query, "where": {"height": {"$gte": 20}}, "facets": ["family"], "highlights": ["notes"], "limit": 5})
        made = [Search(plan, snapshot.docs, NORTH, index=index) for index in (None, snapshot.index)]
        scan, indexed = ({r.m_document_id: r.score for r in m.scored().collect()} for m in made)
        assert indexed == scan and scan
        pages = [m.page() for m in made]
        assert pages[0] == pages[1] and pages[0]["total"]["value"] == len(scan)
    want = model.find(NORTH, "moss", 20)
    plan = from_mapping(LAYOUT, {"resource": LAYOUT.resource, "query": {"text": "moss", "fields": ["notes"]}, "where": {"height": {"$gte": 20}}, "facets": [], "highlights": [], "limit": 50})
    search = Search(plan, snapshot.docs, NORTH, index=snapshot.index)
    assert sorted(json.loads(r.m_record_id) for r in search.matched.collect()) == want
    read = search.rows()._jdf.queryExecution().executedPlan().toString()
    assert LAYOUT.field("notes").tokens not in read.replace("ReadSchema", "") and "term" in read  # postings, no tokens


def test_texts_under_other_nodes_use_the_index(spark, session):
    store = session.store(LAYOUT.resource)
    store.apply(_mutations(spark, GARDEN))
    text = {"kind": "fullText", "query": "moss", "fields": ["notes"]}
    tall = {"kind": "gt", "left": {"kind": "field", "name": "height"}, "right": {"kind": "literal", "value": 100}}
    request = lambda tree: {"catalog": "structured", "operation": "search", "consistency": "eventual", "targets": [LAYOUT.resource], "filter": tree, "page": {"size": 5}}
    find = lambda tree: session.search(request(tree), "north", {"glasshouse": "2"})
    assert _records(find({"kind": "not", "operand": text})) == ["fern"]
    both = find({"kind": "and", "operands": [text, tall]})
    assert _records(both) == ["pine"] and both["items"][0]["score"] == 0
    either = find({"kind": "or", "operands": [text, {**text, "query": "thorny"}, tall]})
    assert _records(either) == ["pine", "rose"] and either["items"][0]["score"] > either["items"][1]["score"] > 0


def test_what_a_page_tells(spark, session):
    store = session.store(LAYOUT.resource)
    assert _outcomes(session.project(LAYOUT.resource, _mutations(spark, GARDEN))) == ["applied"] * 4
    found = _find(session, {"text": "moss", "fields": ["notes"]}, facets=["family", "beds"], highlights=["notes"])
    assert _records(found) == ["pine", "rose"] and found["total"] == {"value": 2, "relation": "eq"} and _records(_find(session, "moss", south=True)) == ["kelp"]
    marks = {json.loads(i["recordRef"]["recordId"]): i["highlights"] for i in found["items"]}
    assert marks == {"rose": {"notes": ["<em>moss</em> between stones, thorny <em>moss</em>"]}, "pine": {"notes": ["苔藓和松树 <em>moss</em>"]}}
    assert found["facets"]["beds"] == [{"value": "P", "count": 1}, {"value": "R", "count": 1}, {"value": "p", "count": 1}, {"value": "r", "count": 1}]
    origin = found["provenance"]
    assert origin["pagination"] == "live-keyset" and origin["snapshot"] == "1.2" and origin["schemaFingerprint"] == LAYOUT.schema_fingerprint and origin["resultBytes"] > 500
    pages = [_find(session, limit=1)]
    while pages[-1]["cursor"]:
        pages.append(_find(session, limit=1, cursor=pages[-1]["cursor"]))
    assert [len(p["items"]) for p in pages] == [1, 1, 1] and sorted(r for p in pages for r in _records(p)) == ["fern", "pine", "rose"]
    for changed in ({"limit": 3}, {"where": {"thrives": False}}, {"south": True}, {"query": "moss"}):
        with pytest.raises(CursorRejected):
            _find(session, **{"limit": 1, **changed}, cursor=pages[0]["cursor"])
    receipt = session.project_one(LAYOUT.resource, dict(zip(MUTATION.fieldNames(), _row(0, "rose", 9, None))), "wait_for")
    assert receipt == {"event_id": "e0", "record_id": '"rose"', "source_sequence": 9, "outcome": "applied", "code": None} and _records(_find(session, "moss")) == ["pine"]
    late = dict(zip(MUTATION.fieldNames(), _row(0, "rose", 8, _plant("rose", "moss"))))
    assert session.project_one(LAYOUT.resource, late)["outcome"] == "stale"  # the tombstone blocks what is older
    with pytest.raises(InvalidRequest):
        session.project_one(LAYOUT.resource, {**late, "payload": '{"height":"tall"}'})
    with pytest.raises(InvalidRequest):
        session.project_one(LAYOUT.resource, {**late, "colour": "green"})

def test_generations(spark, session):
    store = session.store(LAYOUT.resource)
    store.apply(_mutations(spark, GARDEN))
    assert store.plan(4, 1).steps[-1] == "retire" and store.plan(4, 1).fingerprint != store.plan(5, 1).fingerprint
    with pytest.raises(InvalidRequest):
        store.plan(3, 3)
    assert store.create(4) == "created" == store.state(4)
    with pytest.raises(Conflict):
        store.create(4)
    store.apply(_mutations(spark, GARDEN[1:3]), 4)
    assert len(_find(session)["items"]) == 3  # searches still read the first
    assert store.verify(4) == "verified" == store.state(4) and store.activate(4) == 1 and (store.state(1), store.state(4)) == ("retained", "active")
    assert _records(_find(session)) == ["fern", "pine"]
    with pytest.raises(Conflict):
        store.retire(4, LAYOUT.fingerprint)
    assert store.rollback(1) == 4 and len(_find(session)["items"]) == 3 and store.state(4) == "retained"
    with pytest.raises(FingerprintDrift):
        store.retire(4, LAYOUT.schema_fingerprint)
    assert store.retire(4, LAYOUT.fingerprint) == "retired" == store.state(4)
    with pytest.raises(NotFound):
        store.verify(4)
    with pytest.raises(FingerprintDrift):
        Generations(spark, session.root, "glass", compile_layout(PLANTS, SearchProfile(("label",)))).verify(1)


def test_points_in_time(spark, session):
    store = session.store(LAYOUT.resource)
    store.apply(_mutations(spark, GARDEN))
    page = {"size": 2, "pointInTime": True}
    request = {"catalog": "structured", "operation": "search", "consistency": "eventual", "targets": [LAYOUT.resource], "order": [{"field": "height", "direction": "asc", "nulls": "first"}], "page": page}
    ask = lambda **more: session.search({**request, "page": {**page, **more.pop("page", {})}}, "north", {"glasshouse": "2"}, **more)
    first = ask()
    assert [json.loads(i["recordRef"]["recordId"]) for i in first["items"]] == ["fern", "rose"] and first["items"][0]["sort"][0] == 35 and first["provenance"]["pagination"] == "point-in-time"
    store.apply(_mutations(spark, [_row(n, r, 50, None) for n, r in enumerate(("rose", "fern", "pine"))]))
    assert _find(session)["items"] == [] and store.vacuum(1) == 2  # working files; what the lease pins stays
    second = ask(page={"cursor": first["cursor"]}, lease=first["pointInTime"])
    assert _records(second) == ["pine"] and (second["cursor"], second["pointInTime"]) == (None, None) and second["total"]["value"] == 3
    assert store.vacuum(1) == 2  # the pinned base and its index
    with pytest.raises(NotFound):
        store.leased(first["pointInTime"])
    with pytest.raises(CursorRejected):  # a live search cannot continue it
        session.search({**request, "page": {"size": 2, "cursor": first["cursor"]}}, "north", {"glasshouse": "2"})
    again = ask()
    session.close_point_in_time(LAYOUT.resource, again["pointInTime"]) if again["pointInTime"] else None


def test_sessions_fail_closed(spark, tmp_path):
    s = Session(spark, str(tmp_path), "glass", b"a secret of some length", Limits(bulk_actions=3, bulk_bytes=4096), result_bytes=400)
    with pytest.raises(LifecycleError):
        s.bind(LAYOUT)
    with s:
        with pytest.raises(Unplaced):
            s.store("structured:garden.tools")
        store = s.bind(LAYOUT, 2)
        for call in (store.active, lambda: store.apply(_mutations(spark, GARDEN))):
            with pytest.raises(NotFound):
                call()
        store.create(1)
        store.activate(1)
        for rows in ([], GARDEN, [_row(1, "r", 1, "y" * 5000)]):
            with pytest.raises(LimitExceeded):
                s.project(LAYOUT.resource, _mutations(spark, rows))
        s.backfill(LAYOUT.resource, _mutations(spark, GARDEN))
        with pytest.raises(LimitExceeded):
            _find(s)
        with pytest.raises(LifecycleError):
            s.begin()
        for call in (s.commit, s.rollback):
            with pytest.raises(Unsupported):
                call()
        with pytest.raises(Unsupported):
            s.search({"catalog": "structured", "operation": "search", "consistency": "eventual", "targets": [LAYOUT.resource], "page": {"size": 1, "pointInTime": True}}, "north")
        with pytest.raises(ValueError):
            s.search({"resource": LAYOUT.resource, "query": None, "where": {}, "facets": [], "highlights": [], "limit": 1})
    plan = from_mapping(LAYOUT, {"resource": LAYOUT.resource, "query": None, "where": {}, "facets": [], "highlights": [], "limit": 1})
    for scope in (None, ""):
        with pytest.raises(InvalidRequest):
            Search(plan, store.snapshot().docs, scope)


def test_pins_and_probes(spark, session, tmp_path, monkeypatch):
    found = session.reprobe()
    assert Session(spark, str(tmp_path), "glass", b"another secret, as long", point_in_time=True, pin=found).open().reprobe() == found
    with pytest.raises(Incompatible):
        Session(spark, str(tmp_path), "glass", b"another secret, as long", Limits(page_size=7), point_in_time=True, pin=found).open()
    physical = session.verify_physical([(LAYOUT.resource, LAYOUT.schema_fingerprint)])
    assert list(physical["resources"]) == [LAYOUT.resource] and physical == session.verify_physical([(LAYOUT.resource, None)])
    with pytest.raises(FingerprintDrift):
        session.verify_physical([(LAYOUT.resource, LAYOUT.fingerprint)])
    with pytest.raises(Unplaced):
        session.verify_physical([("structured:garden.tools", None)])
    monkeypatch.setattr("tidemark.engine.session.DENIED", ())
    with pytest.raises(Incompatible):
        session.reprobe()
    before = LAYOUT.fingerprint
    monkeypatch.setattr("tidemark.engine.analysis.STOP_WORDS", frozenset())
    assert LAYOUT.fingerprint != before  # tokens of other chains are another layout


def test_keys_change_without_breaking_cursors(spark, session, tmp_path):
    session.store(LAYOUT.resource).apply(_mutations(spark, GARDEN))
    old, new = b"the key of the last season", b"the key of the next season"

    def opened(ring):
        s = Session(spark, str(tmp_path), "glass", ring, point_in_time=True).open()
        s.bind(LAYOUT, 2)
        return s

    cursor = _find(opened(KeyRing("s1", {"s1": old})), limit=1)["cursor"]
    both = _find(opened(KeyRing("s2", {"s1": old, "s2": new})), limit=1, cursor=cursor)
    assert len(both["items"]) == 1 and both["cursor"].split(".")[1] == "s2" and cursor.split(".")[1] == "s1"
    for ring, token in ((KeyRing("s2", {"s2": new}), cursor), (KeyRing("s1", {"s1": new}), cursor), (KeyRing("s2", {"s1": old, "s2": new}), cursor.replace(".s1.", ".s2."))):
        with pytest.raises(CursorRejected):
            _find(opened(ring), limit=1, cursor=token)
    for bad in (("x", {"s1": old}), ("s1", {"s1": b"short"}), ("s.1", {"s.1": old}), ("s1", {f"s{k}": old for k in range(9)})):
        with pytest.raises(ConfigurationError):
            KeyRing(*bad)


def test_a_store_that_cannot_take_a_bulk_now(spark, session, monkeypatch):
    """Another writer is faster: valid items are retryable, and nothing of the bulk was applied."""
    store = session.store(LAYOUT.resource)
    faster = Manifest.publish

    def publish(self, version, state):
        raise PublishConflict(version)

    monkeypatch.setattr(Manifest, "publish", publish)
    acks = session.project(LAYOUT.resource, _mutations(spark, [*GARDEN[:1], _row(15, "bad", 1, "[]")])).collect()
    assert [(a.outcome, a.code) for a in acks] == [("retryable", "bulk-rejected"), ("permanent", "mapper_parsing")]
    monkeypatch.setattr(Manifest, "publish", faster)
    assert store.snapshot().docs.count() == 0 and _outcomes(session.project(LAYOUT.resource, _mutations(spark, GARDEN[:1]))) == ["applied"]
    manifest = Manifest(store._generation(1))
    with pytest.raises(PublishConflict):  # of two writers of one version one wins
        manifest.publish(manifest.latest()[0], {"segments": []})


def test_vacuum_spares_bulks_that_are_running(spark, session):
    store = session.store(LAYOUT.resource)
    store.apply(_mutations(spark, GARDEN))
    folder = store._generation(1)
    spark.range(1).write.parquet(f"{folder.path}/run=00000009-running")
    store.vacuum(1)
    assert folder.exists("run=00000009-running") and len(_find(session)["items"]) == 3
    assert store.vacuum(1, grace_seconds=-60) == 1 and not folder.exists("run=00000009-running") and len(_find(session, "moss")["items"]) == 2


# -- encoding ------------------------------------------------------------------------------------------------------
@pytest.mark.parametrize(("changes", "payload", "code"), [
    ({}, {"notes": "x"}, None), ({}, None, None), ({}, " null ", None), ({}, '{"notes":"x"', "mapper_parsing"), ({}, "7", "mapper_parsing"), ({}, {"colour": 1}, "operation-invalid"),
    ({}, {"height": 2**15 - 1}, None), ({}, {"height": -(2**15) - 1}, "mapper_parsing"), ({}, {"height": "33"}, None), ({}, {"thrives": 1}, "mapper_parsing"), ({}, {"beds": {"a": 1}}, "mapper_parsing"),
    ({}, {"beds": ["a", None]}, "mapper_parsing"), ({}, {"beds": []}, None), ({}, {"notes": [["x"]]}, "mapper_parsing"), ({}, {"label": {}}, "mapper_parsing"), ({}, {"label": None}, None),
    ({}, {"planted": "2031-02-30"}, "mapper_parsing"), ({}, {"planted": "2031-02-28"}, None), ({"event_id": "\u0007"}, {}, "operation-invalid"), ({"event_id": None}, {}, "operation-invalid"),
    ({"source_sequence": -4}, {}, "operation-invalid"), ({"source_sequence": None}, {}, "operation-invalid"), ({"resource_ref": "structured:garden.tools"}, {}, "operation-scope"),
    ({"schema_fingerprint": "sha256:" + "1" * 64}, {}, "physical-fingerprint"), ({"scope_fingerprint": None}, {}, "operation-invalid"), ({"record_id": "null"}, {}, "operation-invalid"),
    ({"record_id": "[[1]]"}, {}, "operation-invalid"), ({"record_id": "[7,null]"}, {}, "operation-invalid"), ({"record_id": "{}"}, {}, "operation-invalid"), ({"record_id": "{"}, {}, "operation-invalid"),
    ({"record_id": '[ "b]" , -0.5, false ]'}, {}, None), ({"record_id": "-12"}, {}, None), ({"schema_version": ""}, {}, "operation-invalid"),
])
def test_codes(spark, changes, payload, code):
    row = encode(_mutations(spark, [_row(1, "r", 1, payload, **changes)]), LAYOUT).first()
    assert row.code == code


@pytest.mark.parametrize("record", ["bed 4", "tab\tand \\ and \"", "Łąka 苔 ", 0, ["row", 9, "x"], ["]"], False, -70000])
def test_document_ids_are_those_of_the_driver(spark, record):
    row = encode(_mutations(spark, [_row(1, record, 1, None)]), LAYOUT).first()
    assert row.m_document_id == document_id(NORTH, LAYOUT.resource, record) and row.m_deleted


def test_every_kind_is_encoded(spark):
    kinds = {"uid": "uuid", "rate": "float64", "raw": "bytes", "day": "date", "span": "duration", "at": "wgs84Point", "owner": "recordRef", "scan": "objectRef", "tiny": "int8", "big": "int64"}
    fields = [Field("name", "string"), Field("price", "decimal", precision=12, scale=3), Field("exact", "decimal", precision=30, scale=4), *[Field(n, k) for n, k in kinds.items()]]
    layout = compile_layout(Schema("structured:garden.seeds", tuple(fields), ("name",)))
    payload = {"name": "cress", "price": 0.375, "exact": "98765432109876543210.5", "uid": "7d444840-9dc0-11d1-b245-5ffdce74fad2", "rate": -2, "raw": "_-8", "day": "2028-02-29", "span": 86400000000,
               "at": [151.2, -33.9], "owner": {"z": [1], "a": "b"}, "scan": {"k": None}, "tiny": -128, "big": 2**62}
    row = encode(_mutations(spark, [_row(1, "cress", 1, payload, layout=layout)]), layout).first()
    got = {n: row[f.column] for n, f in layout.fields.items()}
    assert row.code is None and str(got.pop("price")) == "0.375" and got.pop("day").isoformat() == "2028-02-29" and got.pop("owner") == '{"a":"b","z":[1]}'
    assert got == {"name": "cress", "exact": "98765432109876543210.5", "uid": payload["uid"], "rate": -2.0, "raw": "_-8", "span": 86400000000, "at": [151.2, -33.9], "scan": '{"k":null}', "tiny": -128, "big": 2**62}
    for wrong in ({"at": [1.0, 2.0, 3.0]}, {"at": [None, 1]}, {"tiny": 128}, {"rate": "fast"}, {"span": []}):
        assert encode(_mutations(spark, [_row(1, "cress", 1, wrong, layout=layout)]), layout).first().code == "mapper_parsing"


def test_pointers(spark):
    layout = compile_layout(Schema("structured:garden.logs", (Field("day", "string"), Field("log", "json")), ("day",)), DocumentProfile("log", ("/weather/sky", "/notes/2", "/a~1~0b", "/count"), facets=("/weather/sky",)))
    body = {"weather": {"sky": "grey", "rain": [1]}, "notes": ["one", "two", {"three": 3}], "a/~b": True, "count": 1.50}
    row = encode(_mutations(spark, [_row(1, "monday", 1, {"day": "monday", "log": body}, layout=layout)]), layout).first()
    assert {f.pointer: row[f.column] for f in layout.fields.values() if f.pointer} == {"/weather/sky": "grey", "/notes/2": '{"three":3}', "/a~1~0b": "true", "/count": "1.5"}


def test_languages_of_annotations():
    assert language_of({"language": "EN-gb", "colour": "x"}) == "en-gb" and language_of({}) is None and language_of({"language": "pl", "search.language": "pl"}) == "pl"
    with pytest.raises(InvalidRequest):
        language_of({"language": "pl", "search.language": "hi"})


# -- outcomes and merging ------------------------------------------------------------------------------------------
def _simulate(rows, stored):
    highest, out = dict(stored), []
    for n, record, sequence in rows:
        stale = sequence < highest.get(record, 0)
        out.append("stale" if stale else "applied")
        highest[record] = max(highest.get(record, 0), sequence)
    return out


@pytest.mark.parametrize("bits", [2, 16])
def test_outcomes_are_those_of_one_after_another(spark, bits):
    rnd = random.Random(bits)
    rows = [(n, rnd.choice(["hot", "hot", "b", "c"]), rnd.randint(1, 30)) for n in range(200)]
    encoded = encode(_mutations(spark, [_row(n, r, s, {"notes": str(n)}) for n, r, s in rows]), LAYOUT).cache()
    stored = spark.createDataFrame([(document_id(NORTH, LAYOUT.resource, "b"), 15)], "m_document_id string, m_source_sequence bigint")
    acks = acknowledge(encoded, stored, bits).orderBy("arrival").collect()
    assert [a.outcome for a in acks] == _simulate(rows, {"b": 15})
    last = {}
    for n, r, s in rows:
        if s >= last.get(r, (0, 0))[0]:
            last[r] = (s, n)
    assert {(r.m_record_id, r.m_event_id) for r in survivors(encoded).collect()} == {(json.dumps(r), f"e{n}") for r, (_, n) in last.items()}


def test_replay_and_order_leave_the_same_documents(spark, tmp_path):
    rnd = random.Random(3)
    rows = [_row(n, f"r{rnd.randint(0, 9)}", n + 1, None if rnd.random() < 0.2 else {"notes": f"t{n}"}) for n in range(60)]
    states = []
    for k, order in enumerate((rows, rows[::-1], rows + rows)):
        store = Generations(spark, f"{tmp_path}/{k}", "glass", BARE, buckets=3)
        store.create(1)
        store.activate(1)
        shuffled = [(i, *r[1:]) for i, r in enumerate(order)]
        store.apply(_mutations(spark, shuffled[: len(shuffled) // 2]))
        store.apply(_mutations(spark, shuffled[len(shuffled) // 2 :]))
        states.append(sorted((r.m_document_id, r.m_event_id, r.m_deleted) for r in store.snapshot().docs.collect()))
    assert states[0] == states[1] == states[2]


def test_a_small_bulk_writes_its_own_documents_only(spark, tmp_path):
    store = Generations(spark, str(tmp_path), "glass", BARE, buckets=8)
    store.create(1)
    store.activate(1)
    store.apply(_mutations(spark, [_row(n, f"r{n}", 1, {"notes": "x"}) for n in range(50)]))
    before = Manifest(store._generation(1)).latest()[1]["segments"]
    store.apply(_mutations(spark, [_row(1, "r1", 2, {"notes": "y"}), _row(2, "r2", 0, {"notes": "bad"})]))
    now = Manifest(store._generation(1)).latest()[1]["segments"]
    assert now[0] == before[0] and len(now) == 2 and now[1]["rows"] == 1 and store.snapshot(1, 2).docs.count() == store.snapshot().docs.count() == 50
    store.apply(_mutations(spark, [_row(1, "r1", 1, {"notes": "late"})]))
    assert Manifest(store._generation(1)).latest()[1]["segments"] == now  # nothing to write


def test_deferred_bulks_show_after_a_refresh(spark, session):
    store = session.store(LAYOUT.resource)
    session.project(LAYOUT.resource, _mutations(spark, GARDEN[:1]), "false")
    assert _find(session)["items"] == []
    assert _outcomes(session.project(LAYOUT.resource, _mutations(spark, [_row(2, "rose", 4, None)]), "false")) == ["stale"]  # the write side knows it
    assert _find(session)["items"] == []
    store.vacuum(1)  # removes working files, keeps what is written but not yet shown
    store.refresh()
    assert _records(_find(session)) == ["rose"] and store.refresh() == store.snapshot().version
    with pytest.raises(InvalidRequest):
        session.project(LAYOUT.resource, _mutations(spark, GARDEN), "true")


def test_a_stream_equals_a_batch(spark, tmp_path):
    rows = [_row(n, f"r{n % 7}", (n * 37) % 50 + 1, {"notes": f"t{n}"}) for n in range(80)]
    for k in range(4):
        _mutations(spark, rows[k::4]).coalesce(1).write.parquet(f"{tmp_path}/log/{k}")
    store = Generations(spark, str(tmp_path), "glass", BARE, buckets=2)
    store.create(1)
    store.activate(1)
    seen = []
    stream = spark.readStream.schema(MUTATION).option("maxFilesPerTrigger", 1).option("recursiveFileLookup", "true").parquet(f"{tmp_path}/log")
    project_stream(stream, store, f"{tmp_path}/checkpoint", lambda acks, n: seen.append(acks.count())).awaitTermination()
    project_stream(stream, store, f"{tmp_path}/checkpoint", lambda acks, n: seen.append(acks.count())).awaitTermination()  # nothing is left to do
    assert sum(seen) == 80
    best = {}
    for r in rows:
        best[r[2]] = max(best.get(r[2], 0), r[3])
    assert {(r.m_record_id, r.m_source_sequence) for r in store.snapshot().docs.collect()} == set(best.items())


def test_a_replayed_batch_has_the_acknowledgements_it_had(spark, session, tmp_path):
    store = session.store(LAYOUT.resource)
    rows = _mutations(spark, [_row(1, "r", 5, {"notes": "x"}), _row(2, "r", 9, {"notes": "y"}), _row(3, "r", 7, None)])
    first = _outcomes(store.apply(rows, token=("log", 0)).orderBy("arrival"))
    version = store.snapshot().version
    store.vacuum(1)
    assert first == ["applied", "applied", "stale"] == _outcomes(store.apply(rows, token=("log", 0)).orderBy("arrival")) and store.snapshot().version == version
    assert _outcomes(store.apply(rows, token=("log", 1)).orderBy("arrival")) == ["stale", "applied", "stale"]
    keyed = Outcomes(spark, f"{tmp_path}/keyed", LAYOUT)
    assert [_outcomes(keyed.apply(rows, n).orderBy("arrival")) for n in (0, 0, 1)] == [first, first, ["stale", "applied", "stale"]]


def test_outcomes_of_a_stream(spark, tmp_path, monkeypatch):
    monkeypatch.setattr("tidemark.streaming.outcomes.SEGMENTS", 2)
    rows = [_row(n, "hot" if n % 3 else f"r{n % 5}", (n * 7) % 40, {"notes": "x"}) for n in range(40)]  # sequence 0 is permanent
    for k in range(4):
        _mutations(spark, rows[10 * k : 10 * k + 10]).coalesce(1).write.parquet(f"{tmp_path}/log/{k}")
    stream = spark.readStream.schema(MUTATION).option("maxFilesPerTrigger", 1).option("recursiveFileLookup", "true").parquet(f"{tmp_path}/log")
    query, store = outcomes(stream, LAYOUT, f"{tmp_path}/store", f"{tmp_path}/c")
    query.awaitTermination()
    want = {r.arrival: (r.outcome, r.code) for r in acknowledge(encode(_mutations(spark, rows), LAYOUT)).collect()}
    assert {r.arrival: (r.outcome, r.code) for r in store.acknowledged().collect()} == want and len({o for o, _ in want.values()}) == 3


def test_a_held_lease_outlasts_long_work(spark, tmp_path):
    store = Generations(spark, str(tmp_path), "glass", BARE, buckets=2, lease_seconds=2)
    store.create(1)
    store.activate(1)
    lease = store.open_lease()
    with store.holding(lease):
        time.sleep(4)
        assert store.leased(lease).version == 1
    time.sleep(3)
    for late in (lambda: store.leased(lease), store.holding(lease).__enter__):
        with pytest.raises(NotFound):
            late()


def test_all_pages_at_once_are_the_pages_one_at_a_time(spark, session, tmp_path):
    store = session.store(LAYOUT.resource)
    store.apply(_mutations(spark, [_row(n, f"r{n}", 1, {**_plant(f"p{n}", "moss"), "height": (None, 10, 20)[n % 3]}) for n in range(45)]))
    docs, signer = store.snapshot().docs.cache(), Signer(b"a secret of some length", 60)
    for direction, nulls in (("asc", "first"), ("desc", "last")):
        request = {"catalog": "structured", "operation": "search", "consistency": "eventual", "targets": [LAYOUT.resource], "order": [{"field": "height", "direction": direction, "nulls": nulls}]}
        search = lambda cursor=None: Search(from_operation(LAYOUT, {**request, "page": {"size": 10, **({"cursor": cursor} if cursor else {})}}), docs, NORTH)  # noqa: B023, E731
        pages = [search().page(signer)]
        while pages[-1]["cursor"]:
            pages.append(search(pages[-1]["cursor"]).page(signer))
        want = [(n, i["recordRef"]["recordId"]) for n, p in enumerate(pages, 1) for i in p["items"]]
        for read in (0, 2):  # from the start, and behind the cursor of the second page
            found = search(pages[read - 1]["cursor"] if read else None).pages(f"{tmp_path}/{direction}{read}", signer, read=read)
            assert sorted((r.page, r.m_record_id) for r in found.collect()) == sorted(x for x in want if x[0] > read) and len(want) == 45
        with pytest.raises(CursorRejected):
            search(pages[0]["cursor"]).pages(f"{tmp_path}/no")
    nothing = Search(from_operation(LAYOUT, {**request, "page": {"size": 10}}), docs, "nobody")
    assert nothing.pages(f"{tmp_path}/nothing", signer).collect() == []


def test_pages_of_a_point_in_time_with_ties_and_a_long_change(spark, tmp_path, monkeypatch):
    """Equal prices go by their part across the ends of pages, and the change takes longer than a lease lasts."""
    spark.range(3_000).selectExpr("id p_partkey", "'bolt' p_name", "'b' p_brand", "'t' p_type", "cast(id % 40 as int) p_size", "cast(900 + id % 3 as double) p_retailprice").write.parquet(f"{tmp_path}/part.parquet")
    monkeypatch.setattr("tidemark.plans.search.Generations", partial(Generations, lease_seconds=4))
    apply = Generations.apply
    monkeypatch.setattr(Generations, "apply", lambda self, *a, **k: (apply(self, *a, **k), time.sleep(5))[0])
    small = sorted((i for i in range(3_000) if i % 40 <= 30), key=lambda i: (-(i % 3), i))
    assert sorted(map(tuple, QUERIES["snapshot_pages"](spark, str(tmp_path)).collect())) == sorted((n // 500 + 1, str(i)) for n, i in enumerate(small))


def test_settings_are_closed(spark, tmp_path):
    made = Settings.from_mapping({"root": str(tmp_path), "prefix": "p", "buckets": 4, "limits": {"page_size": 5}})
    assert made.session(spark, b"0123456789abcdef").limits.page_size == 5
    for bad in ({}, {"root": "x"}, {"root": "x", "prefix": "p", "secret": "s"}, {"root": "x", "prefix": "//"}, {"root": "x", "prefix": "p", "buckets": 0}, {"root": "x", "prefix": "p", "buckets": True},
                {"root": "x", "prefix": "p", "limits": {"no": 1}}, {"root": "x", "prefix": "p", "limits": {"page_size": 501}}, {"root": "", "prefix": "p"}, {"root": "x", "prefix": "p", "cursor_seconds": 5}, {"root": "x", "prefix": "p", "lease_seconds": 0}, {"root": "x", "prefix": "p", "pin": "sha256:1"}, {"root": "x", "prefix": "p", "point_in_time": 1}):
        with pytest.raises(ConfigurationError):
            Settings.from_mapping(bad)
