"""The general operators for training data, against brute force on small tables."""

import json
import random
from datetime import datetime, timedelta, timezone
from decimal import Decimal

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.jsonvalue import canonical_json, is_json_null, is_json_object
from tidemark.operators import drift, incremental
from tidemark.operators.changefeed import FeedStore, change_images, current_state, first_deliveries, state_after
from tidemark.operators.dedup import ExactlyOnceStore
from tidemark.operators.diff import compare_copies
from tidemark.operators.incremental import MerkleRuns, first_run, micros, next_run, replay
from tidemark.storage import Folder, Manifest, PublishConflict

DAY = datetime(2026, 3, 1)
DELIVERY = "delivery_id bigint, event_id string, projected_at timestamp, extra string, value string, `_best` string, Part string, b string"


# -- messages delivered more than once ---------------------------------------------------------------------------
def _deliveries(n, seed=0, hot=0.33):
    rnd = random.Random(seed)
    rows = []
    for i in range(n):
        event = "hot" if rnd.random() < hot else rnd.choice([None, "", *[f"e{k}" for k in range(n // 4)]])
        at = None if rnd.random() < 0.1 else DAY + timedelta(hours=rnd.randint(0, 96))
        rows.append((i, event, at, rnd.choice([None, "x"]), "payload", "clash", "p", "b"))
    return rows


def _winners(rows):
    best = {}
    for r in rows:
        if r[1]:
            key = (r[2] is None, r[2] or DAY, r[0])
            if r[1] not in best or key < best[r[1]][0]:
                best[r[1]] = (key, r)
    return {v[1] for v in best.values()}


def _store(spark, path, schema):
    return ExactlyOnceStore(spark, str(path), schema, "event_id", "projected_at", "delivery_id", ["extra", "value", "_best", "Part", "b"], index_rows=16)


@pytest.mark.parametrize("bulks", [1, 3])
def test_exactly_one_copy_stays(spark, tmp_path, bulks):
    rows = _deliveries(400, bulks)
    df = spark.createDataFrame(rows, DELIVERY)
    store = _store(spark, tmp_path, df.schema)
    for b in range(bulks):
        store.apply(df.filter(F.col("delivery_id") % bulks == b), f"bulk-{b}")
    got = {(r.delivery_id, r.event_id, r.projected_at, r.extra, r.value, r["_best"], r["Part"], r["b"]) for r in store.winners().collect()}
    assert got == _winners(rows)
    surplus = [r.delivery_id for r in store.surplus().collect()]
    assert sorted(surplus) == sorted(r[0] for r in rows if r[1] and r not in got)


def test_only_affected_partitions_are_rewritten(spark, tmp_path):
    day = lambda k: DAY + timedelta(days=k)
    df = spark.createDataFrame([(1, "a", day(0), None, "1", "", None, None), (2, "b", day(1), None, "2", "", None, None), (3, "c", day(2), None, "3", "", None, None)], DELIVERY)
    store = _store(spark, tmp_path, df.schema)
    store.apply(df)
    before = store.manifest.latest()[1]["parts"]
    store.apply(spark.createDataFrame([(4, "b", day(3), None, "late", "", None, None), (5, "d", day(2), None, "new", "", None, None)], DELIVERY))
    state = store.manifest.latest()[1]
    assert state["rewritten"] == ["2026-03-02"]
    assert state["parts"]["2026-03-01"] == before["2026-03-01"]
    assert state["parts"]["2026-03-03"][0] == before["2026-03-03"][0] and len(state["parts"]["2026-03-03"]) == 2
    assert {r.delivery_id for r in store.winners().collect()} == {1, 2, 3, 5}
    assert [r.delivery_id for r in store.surplus().collect()] == [4]


def test_an_earlier_copy_moves_the_winner_to_its_partition(spark, tmp_path):
    df = spark.createDataFrame([(7, "a", None, None, "null counts as latest", "", None, None)], DELIVERY)
    store = _store(spark, tmp_path, df.schema)
    store.apply(df)
    store.apply(spark.createDataFrame([(9, "a", DAY, None, "earlier", "", None, None)], DELIVERY))
    store.apply(spark.createDataFrame([(8, "a", DAY, None, "smaller", "", None, None)], DELIVERY))
    assert [r.value for r in store.winners().collect()] == ["smaller"]
    assert sorted(r.delivery_id for r in store.surplus().collect()) == [7, 9]


def test_a_compacted_store_goes_on(spark, tmp_path):
    rows = _deliveries(200, 5)
    df = spark.createDataFrame(rows, DELIVERY)
    store = _store(spark, tmp_path, df.schema)
    for b in range(2):
        store.apply(df.filter(F.col("delivery_id") % 3 == b), f"bulk-{b}")
    before = sorted(r.delivery_id for r in store.surplus().collect())
    store.compact(tokens=1)
    state = store.manifest.latest()[1]
    assert len(state["index"]) == 1 and all(len(p) == 1 for p in state["surplus"].values()) and state["tokens"] == ["bulk-1"]
    version = store.manifest.latest()[0]
    assert store.apply(df, "bulk-0") == store.apply(df, "bulk-1") == version  # tokens that are listed no more are still known
    assert sorted(r.delivery_id for r in store.surplus().collect()) == before
    store.apply(df.filter(F.col("delivery_id") % 3 == 2))
    assert {r.delivery_id for r in store.winners().collect()} == {r[0] for r in _winners(rows)}


def test_losers_come_out_once(spark, tmp_path):
    """Losers delivered again, sequences shared between identifiers, and null sequences."""
    make = lambda rows: spark.createDataFrame([(q, e, DAY + timedelta(days=t), None, None, "", None, None) for q, e, t in rows], DELIVERY)
    store = _store(spark, tmp_path, make([(1, "a", 0)]).schema)
    store.apply(make([(1, "a", 0), (2, "a", 0), (2, "b", 0), (None, "c", 0), (5, "c", 0)]))
    lost = lambda: sorted((r.event_id, r.delivery_id) for r in store.surplus().collect())
    assert lost() == [("a", 2), ("c", 5)]
    store.apply(make([(2, "a", 0), (None, "c", 0), (5, "c", 0), (5, "c", 0), (1, "a", 0)]))  # nothing but what is known
    assert lost() == [("a", 2), ("c", 5)]
    store.apply(make([(2, "a", 1), (9, "b", -1), (2, "b", 0)]))  # the same sequence at another time is another delivery; b is displaced
    assert lost() == [("a", 2), ("a", 2), ("b", 2), ("c", 5)]
    assert sorted((r.event_id, r.delivery_id) for r in store.winners().collect()) == [("a", 1), ("b", 9), ("c", None)]


def test_partitions_do_not_depend_on_the_zone(spark, tmp_path):
    df = spark.createDataFrame([(1, "a", DAY, None, None, "", None, None)], DELIVERY)
    store = _store(spark, tmp_path, df.schema)
    store.apply(df)
    try:
        spark.conf.set("spark.sql.session.timeZone", "Pacific/Auckland")
        store.compact()
        store.apply(df.withColumn("delivery_id", F.lit(0).cast("bigint")))
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert list(store.manifest.latest()[1]["parts"]) == ["2026-03-01"]
    assert [r.delivery_id for r in store.winners().collect()] == [0] and [r.delivery_id for r in store.surplus().collect()] == [1]


def test_bulks_are_idempotent_empty_or_repeated(spark, tmp_path):
    df = spark.createDataFrame([(1, "a", DAY, None, "x" * 100_000, "", None, None), (1, "a", DAY, None, "x" * 100_000, "", None, None)], DELIVERY)
    store = _store(spark, tmp_path, df.schema)
    store.apply(df.limit(0), "nothing")
    assert store.winners().count() == 0
    assert store.apply(df, "once") == store.apply(df, "once")
    assert store.winners().count() == 1 and store.surplus().count() == 0


# -- only new or changed records -----------------------------------------------------------------------------------
RECORD = "event_id string, source_sequence bigint"


def _names(df):
    return sorted(r.event_id for r in df.collect())


def test_runs_skip_nothing_and_repeat_nothing(spark, tmp_path, monkeypatch):
    monkeypatch.setattr("tidemark.operators.incremental.BROADCAST_LEAVES", 3)
    runs = MerkleRuns(spark, str(tmp_path), "event_id", "source_sequence", leaf_bits=3)
    make = lambda rows: spark.createDataFrame(rows, RECORD)
    first = [(f"e{i}", i * 5) for i in range(40)] + [(None, 1), ("", 2)]
    assert _names(runs.run(make(first))) == sorted(f"e{i}" for i in range(40))
    assert _names(runs.run(make(first + first))) == []  # counted twice, and known
    more = first + [("late", 3), ("new", 900), ("e5", 1), ("nokey", None)]
    assert _names(runs.run(make(more), publish=False)) == ["e5", "late", "new", "nokey"]  # the run died before it published
    assert _names(runs.run(make(more))) == ["e5", "late", "new", "nokey"]
    assert _names(runs.run(make([]), removals=False)) == [] and _names(runs.run(make(more))) == []
    acknowledged = spark.createDataFrame([("done",)], "event_id string")
    assert _names(runs.run(make(more + [("done", 4), ("open", 4)]), journal=acknowledged)) == ["open"]
    runs.compact()
    assert _names(runs.run(make(more + [("done", 4), ("open", 4), ("beside", 4)]))) == ["beside"]


def test_changed_records_come_out_again(spark, tmp_path):
    kind = "event_id string, source_sequence bigint, a string, b map<string,int>"
    runs = MerkleRuns(spark, str(tmp_path), "event_id", "source_sequence", leaf_bits=2, content=["a", "b"])
    make = lambda **rows: spark.createDataFrame([(k, i, *v) for i, (k, v) in enumerate(rows.items())], kind)
    one = {"p": ("x", {"k": 1}), "q": (None, None), "r": ("", {}), "s": ("x", {"m": 1, "k": 2})}
    assert _names(runs.run(make(**one))) == ["p", "q", "r", "s"]
    two = {**one, "q": ("", None), "r": ("", None), "s": ("x", {"k": 2, "m": 1})}
    assert _names(runs.run(make(**two))) == ["q", "r"]  # null and empty differ, the order of a map's entries does not
    assert _names(runs.run(make(**one))) == ["q", "r"]  # turning back is a change
    assert _names(runs.run(make())) == [] and _names(runs.removed()) == ["p", "q", "r", "s"]
    assert _names(runs.run(make(p=one["p"]))) == ["p"]  # what had gone is new again


def test_an_emptied_tree_yields_no_rows(spark, tmp_path, monkeypatch):
    """The rows of a run come from its changed leaves: without differences in the tree there are none."""
    monkeypatch.setattr(incremental, "descend", lambda leaves, differs, *a: leaves.select("leaf", *(["run"] if "run" in leaves.columns else [])).limit(0))
    runs = MerkleRuns(spark, f"{tmp_path}/a", "event_id", "source_sequence")
    assert _names(runs.run(spark.createDataFrame([("e", 1)], RECORD))) == []
    found = replay(
        spark.createDataFrame([("e", DAY, 1)], "event_id string, received_at timestamp, source_sequence bigint"), spark.createDataFrame([(1, DAY, "succeeded")], "run_id int, snapshot_at timestamp, run_state string"),
        spark.createDataFrame([], "run_id int, event_id string, outcome string"), f"{tmp_path}/b",
    )
    assert found.collect() == []


def test_files_seen_before_are_not_read(spark, tmp_path):
    write = lambda name, rows: spark.createDataFrame(rows, RECORD).coalesce(1).write.parquet(f"{tmp_path}/log/{name}")
    runs = MerkleRuns(spark, f"{tmp_path}/store", "event_id", "source_sequence", leaf_bits=3)
    run = lambda **more: _names(runs.run_files([f"{tmp_path}/log"], **more))
    write("a", [(f"e{i}", i) for i in range(100)])
    write("b", [])
    assert len(run()) == 100
    write("c", [("e7", 7), ("n1", 50), ("n2", 1000), (None, 3)])
    assert run(publish=False) == run() == ["n1", "n2"] and len(runs.files_read) == 1 and "/c/" in runs.files_read[0]
    assert run() == [] and runs.files_read == []
    Folder(spark, f"{tmp_path}/log/c").remove()
    write("d", [("n1", 50), ("n3", 1000)])
    assert run() == ["n3"] and _names(runs.removed()) == ["n2"] and len(runs.files_read) == 2  # of the old files only the one in its leaves
    Folder(spark, f"{tmp_path}/log/a").remove()
    assert run() == [] and len(_names(runs.removed())) == 101


def test_ranges_of_leaves(spark, monkeypatch):
    monkeypatch.setattr(incremental, "SCAN_RANGES", 3)
    ranges = lambda leaves: incremental._ranges(spark.createDataFrame([(x,) for x in leaves], "leaf bigint"))
    assert ranges([]) == [] and ranges([5]) == [(5, 5)] and ranges([1, 2, 3, 9]) == [(1, 3), (9, 9)]
    assert ranges([1, 4, 100, 1 << 20]) == [(1, 4), (100, 100), (1 << 20, 1 << 20)]
    assert ranges([-(1 << 20), -3, 4, 1 << 40]) == [(-(1 << 20), -(1 << 20)), (-3, 4), (1 << 40, 1 << 40)]


def _brute_replay(deliveries, runs, journal):
    done, out = set(), set()
    for run, snapshot, state in runs:
        if state != "succeeded":
            continue
        final = {e for r, e, o in journal if r < run and o != "retryable"}
        for e, at, _ in deliveries:
            if e and at is not None and snapshot is not None and at <= snapshot and e not in done and e not in final:
                done.add(e)
                out.add((run, e))
    return out


@pytest.mark.parametrize("seed", range(3))
def test_replay_of_a_run_log(spark, tmp_path, seed, monkeypatch):
    if seed == 2:  # the way beyond the bound of the broadcast
        monkeypatch.setattr("tidemark.operators.incremental.BROADCAST_LEAVES", 0)
        monkeypatch.setattr("tidemark.operators.incremental.INLINE_RUNS", 0)
    rnd = random.Random(seed)
    at = lambda k: DAY + timedelta(hours=k)
    deliveries = [(rnd.choice([None, "", *[f"e{k}" for k in range(60)]]), None if rnd.random() < 0.05 else at(rnd.randint(0, 50)), rnd.randint(1, 99)) for _ in range(200)]
    runs = [(i, rnd.choice([None, at(5 * i)]) if rnd.random() < 0.2 else at(5 * i + rnd.randint(-6, 3)), rnd.choice(["succeeded", "succeeded", "failed", "abandoned"])) for i in range(1, 10)]
    failed = [r for r, _, s in runs if s != "succeeded"]
    journal = [(rnd.choice(failed), f"e{rnd.randint(0, 59)}", rnd.choice(["applied", "stale", "permanent", "retryable"])) for _ in range(40)] if failed else []
    found = replay(
        spark.createDataFrame(deliveries, "event_id string, received_at timestamp, source_sequence bigint"), spark.createDataFrame(runs, "run_id int, snapshot_at timestamp, run_state string"),
        spark.createDataFrame(journal, "run_id int, event_id string, outcome string"), str(tmp_path), leaf_bits=2,
    )
    rows = [tuple(r) for r in found.collect()]
    assert len(rows) == len(set(rows)) and set(rows) == _brute_replay(deliveries, runs, journal)


def test_rows_of_a_replay_follow_from_the_trees(spark, tmp_path, monkeypatch):
    """A saved tree that lags one more run behind leaves a record in the difference of two runs."""
    deliveries = spark.createDataFrame([("a", 1, datetime(2026, 1, 1)), ("b", 2, datetime(2026, 1, 2))], "event_id string, source_sequence bigint, received_at timestamp")
    runs = spark.createDataFrame([(k, datetime(2026, 1, k), "succeeded") for k in (1, 2, 3, 4)], "run_id int, snapshot_at timestamp, run_state string")
    journal = spark.createDataFrame([], "run_id int, event_id string, outcome string")
    found = lambda name: sorted(map(tuple, replay(deliveries, runs, journal, f"{tmp_path}/{name}").collect()))
    assert found("plain") == [(1, "a"), (2, "b")]
    monkeypatch.setattr(incremental, "next_run", lambda after, ids, strictly: next_run(next_run(after, ids, True), ids, True))
    assert found("late") == [(1, "a"), (2, "a"), (2, "b"), (3, "b")]


def test_replay_without_runs(spark, tmp_path):
    empty = spark.createDataFrame([], "event_id string, received_at timestamp, source_sequence bigint")
    runs = spark.createDataFrame([(1, DAY, "failed")], "run_id int, snapshot_at timestamp, run_state string")
    journal = spark.createDataFrame([], "run_id int, event_id string, outcome string")
    assert replay(empty, runs, journal, str(tmp_path)).collect() == []


def test_a_long_run_log_is_searched(spark):
    runs = [(i, (DAY + timedelta(minutes=i)).replace(tzinfo=timezone.utc).timestamp() * 1_000_000) for i in range(400)]
    runs = [(i, int(at)) for i, at in runs]
    df = spark.createDataFrame([(DAY + timedelta(minutes=m),) for m in (0, 17, 399, 400)] + [(None,)], "at timestamp")
    assert [r[0] for r in df.select(first_run(micros(F.col("at")), runs)).collect()] == [0, 17, 399, None, None]


# -- changes applied -----------------------------------------------------------------------------------------------
def _state(spark, rows, chunk_bits=17, base=None):
    df = spark.createDataFrame(rows, "event_id string, delivery_id bigint, record string, sequence bigint, kind string")
    events = first_deliveries(df, "event_id", "delivery_id", ["sequence", "kind", "record"]).filter("kind is not null")
    changes = change_images(events, [F.col("record")], "sequence", F.col("kind") == "delete")
    return sorted(r.image for r in current_state(changes, "record", "sequence", "image", base, chunk_bits).collect())


def _brute_state(rows):
    first, last = {}, {}
    for e, d, r, s, k in rows:
        if e and (e not in first or d < first[e][0]):
            first[e] = (d, r, s, k)
    for e, (d, r, s, k) in first.items():
        if k and (r not in last or (s, d) > last[r][0]):
            last[r] = ((s, d), e, k)
    return sorted(e for _, e, k in last.values() if k == "upsert")


@pytest.mark.parametrize("seed", range(3))
@pytest.mark.parametrize("chunk_bits", [2, 17])
def test_signed_multiset_gives_the_current_state(spark, seed, chunk_bits):
    rnd = random.Random(seed)
    rows = []
    for i in range(300):
        record = "hot" if rnd.random() < 0.3 else rnd.choice([None, "r1", "r2", "r3", "r4", "r5"])
        rows.append((rnd.choice([None, "", *[f"e{k}" for k in range(150)]]), i, record, rnd.randint(0, 60), rnd.choice(["upsert", "upsert", "delete", None])))
    rows += rows[:20]
    assert _state(spark, rows, chunk_bits) == _brute_state(rows)


def test_a_base_takes_part_at_its_own_sequence(spark):
    base = spark.createDataFrame([("a", 5, "base-a"), ("b", 5, "base-b"), ("c", 5, "base-c")], "record string, sequence bigint, image string")
    changes = spark.createDataFrame([("a", 4, "late"), ("b", 6, None), ("d", 1, "new")], "record string, sequence bigint, image string")
    assert sorted(r.image for r in current_state(changes, "record", "sequence", "image", base).collect()) == ["base-a", "base-c", "new"]
    assert current_state(changes.limit(0), "record", "sequence", "image").collect() == []


def test_a_base_with_tombstones(spark):
    """At one sequence the change wins over the base; a late change does not bring a deleted record back."""
    kind = "record string, sequence bigint, image string"
    make = lambda *rows: spark.createDataFrame(list(rows), kind)
    apply = lambda changes, base: {r.record: (r.sequence, r.image) for r in state_after(changes, "record", "sequence", "image", base).collect()}
    assert apply(make(("a", 5, None), ("b", 5, "aaa"), ("c", 4, "late")), make(("a", 5, "zzz"), ("b", 5, "zzz"), ("c", 5, "zzz"), ("d", 1, "d"))) == {"a": (5, None), "b": (5, "aaa"), "c": (5, "zzz"), "d": (1, "d")}
    first = state_after(make(("a", 10, None), ("b", 3, "b")), "record", "sequence", "image")
    assert apply(make(("a", 7, "late"), ("b", 9, None)), first) == {"a": (10, None), "b": (9, None)}
    assert current_state(make(("a", 7, "late")), "record", "sequence", "image", first).collect() == [("b", 3, "b")]


@pytest.mark.parametrize("seed", range(2))
def test_a_feed_in_bulks_equals_the_feed_at_once(spark, tmp_path, seed):
    rnd = random.Random(seed)
    known = {}
    rows = []
    for at in range(160):
        event = rnd.choice(["", None, *[f"e{k}" for k in range(60)]])
        known.setdefault(event, (rnd.choice([b"hot", b"hot", b"b", b"c"]), rnd.randint(1, 12), rnd.choice(["upsert", "upsert", "delete", None])))
        rows.append((event, at, *known[event]))
    df = spark.createDataFrame(rows, "event string, at bigint, record binary, sequence bigint, kind string")
    store = FeedStore(spark, str(tmp_path), bucket_rows=8)
    for k, (low, high) in enumerate(((0, 60), (60, 60), (60, 110), (100, 160))):
        store.apply(df.filter((F.col("at") >= low) & (F.col("at") < high)), f"bulk-{k}")
    assert store.apply(df, "bulk-0") == 4
    best, seen = {}, set()
    for event, at, record, sequence, kind in rows:
        if event and event not in seen:
            seen.add(event)
            if kind and (sequence, at) >= best.get(record, ((0, 0), None))[0]:
                best[record] = ((sequence, at), event if kind == "upsert" else None)
    assert sorted(r.event for r in store.current().collect()) == sorted(e for _, e in best.values() if e)
    assert store.state().count() == len(best)



# -- JSON values ---------------------------------------------------------------------------------------------------
def test_json_texts_compare_by_value(spark):
    same = ['"doc/é"', ' "doc\\/\\u00e9" '], ['["c",4]', '[ "c" , 4 ]'], ["1", "1.0"], ['{"a":1,"b":2}', '{"b":2, "a":1}']
    for a, b in same:
        row = spark.createDataFrame([(a, b)], "a string, b string").select(canonical_json(F.col("a")), canonical_json(F.col("b"))).first()
        assert row[0] == row[1]
    rows = spark.createDataFrame([(x,) for x in ("1", '"1"', "[1]", "x", None)], "a string").select(canonical_json(F.col("a"))).collect()
    assert len({r[0] for r in rows}) == 5


@pytest.mark.parametrize(("text", "object_", "null"), [
    ('{"a":1}', True, False), ('{"a":{"b":[1,{}]}} ', True, False), ('{"a":1', False, False), ('{"a":1} x', False, False), ("{} {}", False, False),
    ('{"a":1,"a":2}', True, False), ("null", False, True), (" null\n", False, True), (None, False, True), ("", False, False), ("[1]", False, False),
    ('"x"', False, False), ("{}", True, False),
])
def test_kinds_of_payloads(spark, text, object_, null):
    df = spark.createDataFrame([(text,)], "p string")
    assert tuple(df.select(is_json_object(F.col("p")), is_json_null(F.col("p"))).first()) == (object_, null)


# -- drift ---------------------------------------------------------------------------------------------------------
MUTATION = "delivery_id bigint, resource_ref string, record_id string, source_sequence bigint, schema_version string, schema_fingerprint string, scope_fingerprint string, payload string"


def _drift(spark, checkpoint, shapes):
    """shapes: per version a list of payloads, by record."""
    rows, n = [], 0
    for v, payloads in enumerate(shapes):
        for k, p in enumerate(payloads):
            n += 1
            rows.append((n, "r", f' "k{k}"' if n % 2 else f'"k{k}"', n, f"{v}", "f", "s", p if isinstance(p, str | None) else json.dumps(p)))
    df = spark.createDataFrame(rows, MUTATION)
    return sorted((r.schema_version, r.change, r.field, r.new_field) for r in drift.report(df, checkpoint).collect())


@pytest.mark.parametrize("bound", [10_000, 0])
def test_every_kind_of_change(spark, checkpoint, monkeypatch, bound):
    monkeypatch.setattr(drift, "BROADCAST_SHAPES", bound)
    old = [{"id": str(k), "Title": f"t{k}", "n": k, "gone": k % 2, "in": {"a": k}, "empty": {}} for k in range(20)]
    new = [{"id": str(k), "title": f"t{k}", "n": f"{k}", "in": {"a": k + 0.5}, "fresh": [k]} for k in range(20)]
    assert _drift(spark, checkpoint, [old, new]) == [
        ("1", "added", "/fresh", ""), ("1", "removed", "/gone", ""), ("1", "renamed", "/Title", "/title"), ("1", "retyped", "/in/a", ""), ("1", "retyped", "/n", ""),
    ]


def test_a_tenth_and_more_than_half(spark, checkpoint):
    old = [{"x": k, **({"rare": 1} if k < 2 else {})} for k in range(20)]  # a tenth: the shape has it
    new = [{"y": k if k < 10 else -1, **({"odd": 1} if k < 1 else {})} for k in range(20)]  # less than a tenth; exactly half equal
    assert _drift(spark, checkpoint, [old, new]) == [("1", "added", "/y", ""), ("1", "removed", "/rare", ""), ("1", "removed", "/x", "")]
    new[10] = {"y": 10}
    assert ("1", "renamed", "/x", "/y") in _drift(spark, lambda df, name: checkpoint(df, f"again-{name}"), [old, new])


def test_bad_payloads_and_nulls(spark, checkpoint):
    old = [None, "null", '{"a":', "[1]", '{"a/b":null,"a~c":1.0,"big":12345678901234567890123}', '{"a/b":null,"a~c":2e3,"big":1}']
    new = ['{"a/b":"now","a~c":7,"big":true}', '{"a/b":"now","a~c":true,"a~c":8,"big":true}']
    assert _drift(spark, checkpoint, [old, new]) == [("1", "retyped", "/a~0c", ""), ("1", "retyped", "/big", "")]
    assert _drift(spark, lambda df, name: checkpoint(df, f"none-{name}"), [[]] + [[None]]) == []


def test_payloads_beyond_the_bounds_of_a_parser(spark, checkpoint):
    """Numbers of more digits than Python converts, values nested deeper than its stack, and wide drifts."""
    nested = "[" * 20_000 + "1" + "]" * 20_000
    old = [f'{{"id":"{k}","long":{"7" * (5_000 + k)},"deep":{nested}}}' for k in range(3)]
    new = [f'{{"id":"{k}","wide":{"7" * (5_000 + k)}.0,"down":{nested}}}' for k in range(3)]
    assert _drift(spark, checkpoint, [old, new]) == [("1", "renamed", "/deep", "/down"), ("1", "renamed", "/long", "/wide")]
    assert drift.tag(drift.parse_object(old[0])["long"]) == "integer" and drift.parse_object("[" * 100_000) is None
    old = [{f"o{i}": 40 * k + i for i in range(40)} | {"flag": True, "half": k} for k in range(12)]
    new = [{f"n{i}": 40 * k + i for i in range(40)} | {"sign": k > 0, "less": k if k < 6 else -1} for k in range(12)]
    wide = _drift(spark, lambda df, name: checkpoint(df, f"wide-{name}"), [old, new])
    assert wide == sorted([("1", "renamed", f"/o{i}", f"/n{i}") for i in range(40)] + [("1", "renamed", "/flag", "/sign"), ("1", "added", "/less", ""), ("1", "removed", "/half", "")])


def test_branches_of_numbers():
    D, number = Decimal, lambda text: drift._branches_of_number(drift.Point(text))
    assert drift._branches_of_number(12345678901234567890123) == (D("12345678901234567890123"), None, 12345678901234567890123.0)
    assert number("0.1") == (None, D("0.1"), 0.1) and number("1500e-1") == (D(150), D(150), 150.0) and number("-0.0")[:2] == (D(0), D(0))
    assert number("1e400") == (None, None, None) and number("9.9999999999999999999999") == (None, None, 10.0) and number("1e-18")[1] == D("1e-18")
    assert drift.canonical(drift.Point("12345678901234567890123456789012.5")) != drift.canonical(drift.Point("12345678901234567890123456789012.4"))
    assert [drift.canonical(drift.Point(x)) for x in ("1e2", "0.00120", "1e30", "-5e-30", "00.0")] == ["100", "0.0012", "1E30", "-5E-30", "0"]


def test_values_are_equal_by_value():
    assert drift.canonical(drift.Point("1.50")) == drift.canonical(drift.Point("15e-1")) and drift.canonical(drift.Point("1.0")) == drift.canonical(1)
    assert drift.canonical(True) != drift.canonical(1) and drift.canonical("1") != drift.canonical(1)
    assert drift.canonical_text('"doc\\/\\u00e9"') == drift.canonical_text(' "doc/é"') and drift.canonical_text("x") != drift.canonical_text('"x"')


def test_renamings_are_followed_to_the_end(spark):
    """Ten renamings in a row; a name that comes back; a name that is used again; rows without a shape."""
    rows, changes = [], []
    for v in range(11):
        back, used = ("a", "b", "a")[min(v, 2)], ("x", "y", "y")[min(v, 2)]
        payload = {f"f{v}": 1, back: 2, used: 3, **({"x": 4} if v > 1 else {})}
        rows.append((v, "r", '"k"', v, f"{v:02}", "f", "s", json.dumps(payload)))
        changes += [("r", f"{v:02}", "f", "renamed", f"/f{v - 1}", f"/f{v}")] if v else []
    rows.append((11, "r", '"k"', 11, None, None, "s", '{"f0":1}'))
    changes += [("r", "01", "f", "renamed", "/a", "/b"), ("r", "02", "f", "renamed", "/b", "/a"), ("r", "01", "f", "renamed", "/x", "/y"), ("r", "02", "f", "added", "/x", "")]
    table = spark.createDataFrame(changes, "resource_ref string, schema_version string, schema_fingerprint string, change string, field string, new_field string")
    got = {(r.delivery_id, int(r.canonical)): r.current_field for r in drift.unified(spark.createDataFrame(rows, MUTATION), table).collect()}
    assert {got[v, 1] for v in range(12)} == {"/f10"} and {got[v, 2] for v in range(11)} == {"/a"}
    assert {got[v, 3] for v in range(11)} == {"/y"} and {got[v, 4] for v in range(2, 11)} == {"/x"} and len(got) == 11 * 3 + 9 + 1


def test_unified_table_has_typed_branches(spark, checkpoint):
    rows = [(1, "r", '"a"', 1, "0", "f", "s", '{"n":1,"t":"x"}'), (2, "r", '"a"', 2, "1", "f", "s", '{"n":1.5,"u":"x","l":[1, 2]}'), (3, "r", None, 3, None, None, None, "broken")]
    df = spark.createDataFrame(rows, MUTATION)
    changes = drift.report(df, checkpoint)
    got = {(r.delivery_id, r.current_field): (r.type, r.as_integer, r.as_decimal, r.as_string, r.as_array, r.canonical) for r in drift.unified(df, changes).collect()}
    assert got[1, "/n"][:3] == ("integer", 1, 1) and got[2, "/n"][:3] == ("decimal", None, Decimal("1.5"))
    assert got[1, "/u"][3] == got[2, "/u"][3] == "x" and got[2, "/l"][4] == "[1,2]"


# -- two copies ----------------------------------------------------------------------------------------------------
COPY = T.StructType([
    T.StructField("k", T.StringType()), T.StructField("n", T.LongType()), T.StructField("a", T.ArrayType(T.StringType())), T.StructField("_key", T.StringType()),
    T.StructField("clock", T.LongType()),
])


def _differences(spark, left, right):
    out = compare_copies(spark.createDataFrame(left, COPY), spark.createDataFrame(right, COPY), "k", ("left", "right"), ("clock",))
    return sorted((r.k or "", r.finding, r.field_name) for r in out.collect())


def test_differences_field_by_field(spark):
    left = [("same", 1, ["x", None], "q", 1), ("same", 1, ["x", None], "q", 1), ("null", None, None, None, 1), ("order", 1, ["a", "b"], "q", 1), ("gone", 1, [], "", 1), (None, 1, [], "", 1)]
    right = [("same", 1, ["x", None], "q", 9), ("null", 0, [], None, 1), ("order", 1, ["b", "a"], "Q", 1), ("new", 1, [], "", 1), (None, 1, [], "", 1)]
    assert _differences(spark, left, right) == [
        ("gone", "left", ""), ("new", "right", ""), ("null", "differs", "a"), ("null", "differs", "n"), ("order", "differs", "_key"), ("order", "differs", "a"),
    ]
    assert _differences(spark, [], []) == [] and _differences(spark, left[:1], []) == [("same", "left", "")]


def test_a_copy_that_contradicts_itself(spark):
    left = [("a", 1, None, None, 1), ("a", 2, None, None, 1), ("b", 1, None, None, 1), ("b", 1, None, None, 2), ("c", None, None, "", 1), ("c", None, None, None, 1)]
    right = [("a", 2, None, None, 1), ("b", 1, None, None, 1)]
    assert _differences(spark, left, right) == [("a", "ambiguous_left", ""), ("c", "ambiguous_left", ""), ("c", "left", "")]
    assert _differences(spark, right, left) == [("a", "ambiguous_right", ""), ("c", "ambiguous_right", ""), ("c", "right", "")]


def test_columns_of_one_copy_and_maps(spark):
    left = spark.createDataFrame([("a", {"x": 1, "y": 2}, 1)], "k string, m map<string,int>, only int")
    right = spark.createDataFrame([("a", {"y": 2, "x": 1})], "k string, m map<string,int>")
    assert [(r.finding, r.field_name) for r in compare_copies(left, right, "k").collect()] == [("differs", "only")]


@settings(max_examples=8, deadline=None)
@given(st.lists(st.tuples(st.sampled_from("abcd"), st.integers(0, 2) | st.none()), max_size=6), st.lists(st.tuples(st.sampled_from("abcd"), st.integers(0, 2) | st.none()), max_size=6))
def test_differences_are_those_of_dictionaries(spark, left, right):
    left, right = dict(left), dict(right)
    want = sorted([(k, "left", "") for k in left.keys() - right.keys()] + [(k, "right", "") for k in right.keys() - left.keys()] + [(k, "differs", "n") for k in left.keys() & right.keys() if left[k] != right[k]])
    row = lambda kv: (kv[0], kv[1], None, None, None)
    assert _differences(spark, list(map(row, left.items())), list(map(row, right.items()))) == want


# -- storage -------------------------------------------------------------------------------------------------------
def test_a_version_is_published_once(spark, tmp_path):
    manifest = Manifest(Folder(spark, str(tmp_path)))
    assert manifest.latest() == (0, {})
    manifest.publish(1, {"a": 1})
    with pytest.raises(PublishConflict):
        manifest.publish(1, {"a": 2})
    assert manifest.latest() == (1, {"a": 1})
