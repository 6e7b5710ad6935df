"""The search engine's closed parts: values, layouts, requests, predicates, cursors, analysis."""

import hashlib
import math
import random
from dataclasses import replace
from datetime import UTC, date, datetime, timedelta, timezone
from decimal import Decimal
from uuid import UUID

import pytest
from pyspark.sql import functions as F

from tidemark.engine import values
from tidemark.engine.analysis import _Porter, analyse, chain_of, edits, fold, fuzzy_terms
from tidemark.engine.cursor import Signer, after
from tidemark.engine.dataset import as_documents
from tidemark.engine.errors import ConfigurationError, CursorRejected, EngineError, InvalidRequest, LimitExceeded, ScopeViolation, Unsupported, translate
from tidemark.engine.layout import DocumentProfile, Field, Layout, Schema, SearchProfile, compile_layout
from tidemark.engine.limits import BOUNDS, Limits
from tidemark.engine.predicate import All, Any_, Between, Compare, Member, Missing, Not, compiled, scoring
from tidemark.engine.request import from_mapping, from_operation
from tidemark.engine.search import Search
from tidemark.engine.session import OPERATORS, capabilities

PLANTS = Schema("structured:garden.plants", (
    Field("code", "string"), Field("label", "string", language="en"), Field("notes", "string"), Field("family", "enum"), Field("checked", "utcTimestamp"),
    Field("height", "int16"), Field("thrives", "boolean"), Field("beds", "string", many=True), Field("planted", "date"),
), ("code",))
PROFILE = SearchProfile(("notes", "label"), ("family", "beds"), ("notes",), ("pl", "en", "hi"))
LAYOUT = compile_layout(PLANTS, PROFILE)


# -- values --------------------------------------------------------------------------------------------------------
@pytest.mark.parametrize(("value", "text"), [
    (datetime(2031, 1, 1, 0, 30, tzinfo=timezone(timedelta(hours=-5, minutes=-30))), "2031-01-01T06:00:00.000000Z"), (date(1999, 12, 31), "1999-12-31"), (timedelta(days=1, microseconds=7), 86_400_000_007),
    (Decimal("-0.500"), "-0.500"), (Decimal("1E+3"), "1000"), (bytes([0, 255, 16]), "AP8Q"), (bytearray(b""), ""), (UUID("00000000-0000-4000-8000-00000000000f"), "00000000-0000-4000-8000-00000000000f"),
    ({"q": 1, "p": [None, False, {"z": 2, "y": 0.5}]}, {"p": [None, False, {"y": 0.5, "z": 2}], "q": 1}), ((), []), (-0.0, -0.0),
])
def test_plain_values(value, text):
    assert values.plain(value) == text


def test_names_and_identities():
    assert values.canonical({"b": "ü", "a": [1, None]}) == '{"a":[1,null],"b":"ü"}'
    assert values.fingerprint([]) == "sha256:" + hashlib.sha256(b"[]").hexdigest() and values.is_fingerprint(values.fingerprint(0)) and not values.is_fingerprint("sha256:xyz")
    assert values.record_identity(["bed", -3, True]) == '["bed",-3,true]' and values.record_identity("ö") == '"ö"' and values.record_identity(date(2030, 2, 3)) == '"2030-02-03"'
    assert values.prefix_name("--Glass House 9!") == "glass-house-9" and values.language_tag("sr-Cyrl-RS") == "sr-cyrl-rs"
    one, two = (values.generation_name("house", "structured:garden.plants", n) for n in (1, 999_999))
    assert one != two and one[:-6] == two[:-6] and values.resource_folder("house", "structured:garden.plants") != values.resource_folder("house", "structured:garden.plots")
    assert len({values.column_name("a"), values.column_name("a", ""), values.column_name("a", "/b"), values.column_name("b")}) == 4
    assert [values.is_sequence_number(n) for n in (1, 2**63 - 1, 0, 2**63, True, "1")] == [True, True, False, False, False, False]


def test_scopes_are_told_apart():
    made = {values.scope_fingerprint("t"), values.scope_fingerprint("t", {"desk": "1"}), values.scope_fingerprint(None, {"desk": "1"}), values.scope_fingerprint("u")}
    assert len(made) == 4 and values.scope_fingerprint("t", {"a": "1", "b": "2"}) == values.scope_fingerprint("t", {"b": "2", "a": "1"})


@pytest.mark.parametrize(("call", "arguments"), [
    (values.plain, [float("-inf"), Decimal("sNaN"), datetime(2030, 5, 6, 7), {None: 0}, {3}, 1j]), (values.record_identity, [None, (), {"k": "v"}, [[1]], ["x", {}], [0, None]]),
    (values.prefix_name, ["", "***", "\t", 5]), (values.checked_fingerprint, ["md5:0", "sha256:" + "A" * 64, None]), (values.token, ["", "x" * 257, "tab\t", 9]), (values.language_tag, ["", "e", "en_US", None]),
])
def test_values_that_are_refused(call, arguments):
    for value in arguments:
        with pytest.raises((ValueError, TypeError)):
            call(value)
    for number in (-1, 0, 1_000_000, False, 2.0):
        with pytest.raises(ValueError):
            values.generation_name("house", "structured:garden.plants", number)
    with pytest.raises(ValueError):
        values.scope_fingerprint(None)


def test_limits():
    for name, (default, low, high) in BOUNDS.items():
        assert getattr(Limits(), name) == default
        for bad in (low - 1, high + 1, True, "5"):
            with pytest.raises(ConfigurationError):
                replace(Limits(), **{name: bad})
    assert capabilities()["operators"] == list(OPERATORS) and len(OPERATORS) == 19 and "consumer-regex" in capabilities()["denied"]


def test_errors_are_typed_and_redacted():
    error = translate(RuntimeError("/secret/path: FileNotFoundException password=x"))
    assert error.code == "not-found" and "secret" not in str(error) and not error.retryable
    assert translate(TimeoutError("x")).retryable and translate(Unsupported("a")).code == "capability-unsupported" and isinstance(translate(KeyError("k")), EngineError)


# -- layouts -------------------------------------------------------------------------------------------------------
def test_modes_and_closed_form():
    modes = {n: " ".join(f.modes) for n, f in LAYOUT.fields.items()}
    assert modes == {
        "code": "exact exists prefix", "label": "exact exists full-text prefix", "notes": "exact exists full-text highlight prefix", "family": "exact exists facet prefix", "checked": "exact exists range",
        "height": "exact exists range", "thrives": "exact exists", "beds": "exact exists facet prefix", "planted": "exact exists range",
    }
    assert LAYOUT.languages == ("en", "hi", "pl") and [f.name for f in LAYOUT.text_fields] == ["label", "notes"]
    assert Layout.from_dict(LAYOUT.to_dict()) == LAYOUT
    for change in ({"colour": 1}, {"format": "tidemark.layout.v0"}, {"analysis": "plain"}, {"fields": {}}):
        with pytest.raises(InvalidRequest):
            Layout.from_dict({**LAYOUT.to_dict(), **change})
    assert len({f.column for f in LAYOUT.fields.values()}) == len(LAYOUT.fields)


def _schema(*fields, identity=("id",), resource="structured:a.b"):
    return Schema(resource, (Field("id", "string"), *fields), identity)


@pytest.mark.parametrize(("schema", "profile"), [
    (_schema(resource="graph:a.b"), None), (_schema(resource="structured:a"), None), (_schema(identity=()), None), (_schema(identity=("no",)), None),
    (_schema(Field("id", "string")), None), (_schema(Field("x", "tensor")), None), (_schema(Field("x", "wgs84Point", many=True)), None),
    (_schema(Field("x", "int32")), SearchProfile(("x",))), (_schema(Field("x", "string", many=True)), SearchProfile(("x",))), (_schema(Field("x", "json")), SearchProfile(facets=("x",))),
    (_schema(Field("x", "string")), SearchProfile(highlights=("x",))), (_schema(), SearchProfile(("no",))), (_schema(Field("x", "string")), DocumentProfile("x")),
    (_schema(Field("x", "json")), DocumentProfile("x", ("a",))), (_schema(Field("x", "json")), DocumentProfile("x", ("/a/-1",))), (_schema(Field("x", "string", language="bad language")), None),
])
def test_layouts_that_are_refused(schema, profile):
    with pytest.raises((InvalidRequest, ValueError)):
        compile_layout(schema, profile)


def test_every_kind():
    modes = {"boolean": "exact", "int8": "exact range", "duration": "exact range", "float64": "exact range", "utcTimestamp": "exact range", "date": "exact range", "enum": "exact prefix", "uuid": "exact prefix",
             "bytes": "", "wgs84Point": "", "json": "", "recordRef": "", "objectRef": ""}
    decimals = {(18, 18): True, (12, 0): True, (19, 2): False}
    layout = compile_layout(_schema(*[Field(k, k) for k in modes], *[Field(f"d{p}_{s}", "decimal", precision=p, scale=s) for p, s in decimals]))
    for kind, more in modes.items():
        assert set(layout.field(kind).modes) == {"exists", *more.split()}
    for (p, s), ranged in decimals.items():
        f = layout.field(f"d{p}_{s}")
        assert ("range" in f.modes) == ranged and f.type.simpleString() == (f"decimal({p},{s})" if ranged else "string")
    for name, mode in (("enum", "range"), ("json", "exact"), ("date", "prefix"), ("missing", None), (3, None)):
        with pytest.raises(Unsupported):
            layout.field(name, mode)


# -- requests ------------------------------------------------------------------------------------------------------
def _request(**changes):
    return {"resource": LAYOUT.resource, "query": None, "where": {}, "facets": [], "highlights": [], "limit": 10, **changes}


@pytest.mark.parametrize("changes", [
    {"where": {"family": {"$ne": "x"}}}, {"where": {"family": {"$in": ["x", "y"]}}}, {"where": {"family": {"$notIn": ["x"]}}}, {"where": {"family": {"$prefix": "x"}}},
    {"where": {"family": {"$isNull": False}}}, {"where": {"checked": {"$lt": "2030-04-05T06:07:08Z"}}},
    {"where": {"checked": {"$timestampRange": {"start": "2030-04-05T06:07:08Z", "end": "2030-06-01T00:00:00+02:00", "includeStart": False, "includeEnd": True}}}},
    {"query": "ferns by the pond"}, {"query": {"text": "ferns by the pond", "fields": ["notes"], "fuzziness": 2, "operator": "and", "ranking": "bm25"}}, {"facets": ["family", "beds"]},
    {"highlights": ["notes"]}, {"where": {"beds": "x", "thrives": True, "height": {"$gte": 1, "$lt": 5}}}, {"cursor": "x"},
])
def test_requests_that_are_accepted(changes):
    assert from_mapping(LAYOUT, _request(**changes)).size == 10


@pytest.mark.parametrize(("changes", "error"), [
    ({"query": {"match": {"notes": "x"}}}, InvalidRequest), ({"query": {"text": "x", "script": "1"}}, InvalidRequest), ({"query": {"text": "x", "fuzziness": 3}}, InvalidRequest),
    ({"query": {"text": "x", "ranking": "other"}}, Unsupported), ({"query": " "}, InvalidRequest), ({"query": "x" * 20_000}, LimitExceeded), ({"where": {"family": {"$regex": "x"}}}, InvalidRequest),
    ({"where": {"thrives": {"$prefix": "x"}}}, Unsupported), ({"facets": ["notes"]}, Unsupported), ({"highlights": ["family"]}, Unsupported), ({"limit": 501}, LimitExceeded),
    ({"limit": 0}, LimitExceeded), ({"limit": True}, InvalidRequest), ({"cursor": 5}, InvalidRequest), ({"where": {"family": {}}}, InvalidRequest), ({"where": {"family": {"$isNull": "yes"}}}, InvalidRequest),
    ({"where": {"checked": {"$timestampRange": {}}}}, InvalidRequest), ({"where": {"checked": {"$timestampRange": {"start": None, "end": None}}}}, InvalidRequest),
    ({"where": {"family": {"$in": "x"}}}, InvalidRequest), ({"query": {"text": "x", "operator": "xor"}}, InvalidRequest), ({"query": {"text": "x", "fields": ["notes", "notes"]}}, InvalidRequest),
    ({"query": {"text": "x", "fields": ["family"]}}, Unsupported), ({"resource": "structured:other.one"}, ScopeViolation), ({"extra": 1}, InvalidRequest), ({"where": {"family": {"$lt": "x"}}}, Unsupported),
    ({"where": {"nope": 1}}, Unsupported), ({"where": {"family": None}}, InvalidRequest), ({"where": {"family": ["x"]}}, InvalidRequest), ({"facets": ["family", "family"]}, InvalidRequest),
    ({"where": {"height": {"$in": [0] * 10_001}}}, LimitExceeded), ({"where": []}, InvalidRequest), ({"query": {"text": "x", "fields": []}}, Unsupported),
])
def test_requests_that_are_refused(changes, error):
    with pytest.raises(error):
        from_mapping(LAYOUT, _request(**changes))


def test_clauses_are_counted_strictly():
    where = {"height": {"$gte": 1, "$lt": 5, "$ne": 3}}
    with pytest.raises(LimitExceeded):
        from_mapping(LAYOUT, _request(where=where), Limits(filter_clauses=2))
    assert from_mapping(LAYOUT, _request(where=where), Limits(filter_clauses=3))


def _op(tree=None, **changes):
    return {"catalog": "structured", "operation": "search", "consistency": "eventual", "targets": [LAYOUT.resource], "filter": tree, "page": {"size": 10}, **changes}


F1, V = {"kind": "field", "name": "height"}, lambda v: {"kind": "literal", "value": v}
FAMILY, TEXT = {"kind": "field", "name": "family"}, {"kind": "fullText", "query": "x", "fields": ["notes"], "fuzzyTolerance": 1, "facets": ["family"], "highlights": ["notes"]}


@pytest.mark.parametrize("tree", [
    {"kind": "eq", "left": FAMILY, "right": V("x")}, {"kind": "ne", "left": V("x"), "right": FAMILY}, *[{"kind": k, "left": F1, "right": V(1)} for k in ("lt", "lte", "gt", "gte")],
    {"kind": "prefix", "left": FAMILY, "right": V("x")}, {"kind": "in", "operand": FAMILY, "values": [V("x")]}, {"kind": "notIn", "operand": FAMILY, "values": [V("x")]},
    {"kind": "isNull", "operand": FAMILY, "expected": True}, {"kind": "timestampRange", "operand": {"kind": "field", "name": "checked"}, "start": V("2030-04-05T06:07:08Z")},
    {"kind": "and", "operands": [{"kind": "eq", "left": FAMILY, "right": V("x")}, {"kind": "isNull", "operand": F1, "expected": False}]}, {"kind": "or", "operands": [TEXT, {**TEXT, "fields": ["label"]}]},
    {"kind": "not", "operand": {"kind": "eq", "left": FAMILY, "right": V("x")}},
])
def test_expressions_that_are_accepted(tree):
    assert from_operation(LAYOUT, _op(tree)).size == 10


@pytest.mark.parametrize("operation", [
    _op(joins=[1]), _op(grouping=["x"]), _op(aggregates=["x"]), _op(traversal={"x": 1}), _op(projection=["x"]), _op(targets=[LAYOUT.resource] * 2), _op(targets=["structured:x.y"]),
    _op(consistency="strong"), _op(catalog="graph"), _op({"kind": "script"}), _op({"kind": "eq", "left": FAMILY, "right": FAMILY}), _op({"kind": "and", "operands": []}),
    _op({"kind": "eq", "left": FAMILY, "right": V(None)}), _op(page={"size": 10, "pointInTime": True}), _op(order=[{"field": "checked", "direction": "up", "nulls": "last"}]),
    _op(order=[{"field": "checked", "direction": "asc"}]), _op({"kind": "eq", "left": FAMILY, "right": V("x"), "more": 1}), _op({**TEXT, "fuzzyTolerance": 3}),
])
def test_operations_that_are_refused(operation):
    with pytest.raises(InvalidRequest):
        from_operation(LAYOUT, operation)


def test_a_literal_on_the_left_flips_the_range():
    plan = from_operation(LAYOUT, _op({"kind": "lt", "left": V(5), "right": F1}))
    assert plan.where.op == "gt"


def test_what_scores():
    assert len(scoring(from_operation(LAYOUT, _op({"kind": "or", "operands": [TEXT, {"kind": "or", "operands": [TEXT]}]})).text)) == 2
    under_and = from_operation(LAYOUT, _op({"kind": "and", "operands": [TEXT]}))
    assert under_and.text is None and under_and.where is not None
    a, b = from_operation(LAYOUT, _op(TEXT)), from_operation(LAYOUT, _op(TEXT, page={"size": 10, "cursor": "x"}))
    assert a.fingerprint == b.fingerprint and [f.name for f in a.facets] == ["family"] and [f.name for f in a.highlights] == ["notes"]


# -- predicates ----------------------------------------------------------------------------------------------------
SMALL = compile_layout(Schema("structured:t.small", (Field("k", "int64"), Field("s", "string"), Field("n", "int64"), Field("m", "int64", many=True)), ("k",)))
ROWS = [(1, None, None, None), (2, "a", 1, [1]), (3, "ab", 2, [1, 5]), (4, "b", 3, []), (5, "A", -1, [2, 3]), (6, "", 2, [5]), (7, "a%", None, [3, None]), (8, None, 9, [9, 9])]


def _truth(node, row):
    value = lambda f: dict(zip(("k", "s", "n", "m"), row))[f.name]
    op = {"eq": lambda x, v: x == v, "lt": lambda x, v: x < v, "lte": lambda x, v: x <= v, "gt": lambda x, v: x > v, "gte": lambda x, v: x >= v, "prefix": lambda x, v: x.startswith(v)}
    elements = lambda f: [x for x in (value(f) if f.many else [value(f)]) or [] if x is not None]
    match node:
        case Not(p):
            return not _truth(p, row)
        case All(ps):
            return all(_truth(p, row) for p in ps)
        case Any_(ps):
            return any(_truth(p, row) for p in ps)
        case Missing(f, missing):
            return (value(f) is None or value(f) == []) == missing
        case Compare(f, "ne", v):
            return not any(x == v for x in elements(f))
        case Compare(f, o, v):
            return any(op[o](x, v) for x in elements(f))
        case Member(f, vs, negated):
            return any(x in vs for x in elements(f)) != negated
        case Between(f, a, b):
            return any((a is None or x >= a) and (b is None or x < b) for x in elements(f))


def _random_node(rnd, depth=3):
    if depth and rnd.random() < 0.6:
        kind = rnd.choice([All, Any_, Not])
        return Not(_random_node(rnd, depth - 1)) if kind is Not else kind(tuple(_random_node(rnd, depth - 1) for _ in range(rnd.randint(1, 3))))
    f = SMALL.field(rnd.choice("snm"))
    if f.name == "s":
        return rnd.choice([Compare(f, rnd.choice(["eq", "ne", "prefix"]), rnd.choice(["a", "b", "", "a%"])), Member(f, ("a", "ab"), rnd.random() < 0.5), Missing(f, rnd.random() < 0.5)])
    v = rnd.randint(-1, 5)
    return rnd.choice([Compare(f, rnd.choice(["eq", "ne", "lt", "lte", "gt", "gte"]), v), Member(f, (v, 9), rnd.random() < 0.5), Missing(f, rnd.random() < 0.5), Between(f, v, v + 2), Between(f, None, v)])


def test_predicates_are_two_valued(spark):
    df = spark.createDataFrame(ROWS, "k bigint, s string, n bigint, m array<bigint>")
    docs = as_documents(df, SMALL, {c: F.col(c) for c in "ksnm"}, F.col("k").cast("string")).cache()
    rnd = random.Random(7)
    nodes = [_random_node(rnd) for _ in range(120)]
    row_of = {str(r[0]): r for r in ROWS}
    for k in range(0, len(nodes), 20):
        part = nodes[k : k + 20]
        for row in docs.select("m_document_id", *[F.coalesce(compiled(n), F.lit(False)).alias(f"c{i}") for i, n in enumerate(part)]).collect():
            for i, n in enumerate(part):
                assert row[f"c{i}"] == _truth(n, row_of[row.m_document_id]), n


def test_scalar_leaves_reach_the_scan(spark, tmp_path):
    spark.createDataFrame(ROWS, "k bigint, s string, n bigint, m array<bigint>").write.parquet(f"{tmp_path}/t")
    docs = as_documents(spark.read.parquet(f"{tmp_path}/t"), SMALL, {c: F.col(c) for c in "ksnm"}, F.col("k").cast("string"))
    s, n = SMALL.field("s"), SMALL.field("n")
    for node, pushed in ((Not(Compare(s, "eq", "a")), "Not(EqualNullSafe(s,a))"), (Member(n, (1, 2), True), "Or(IsNull(n),Not(In(n, [1,2])))"), (Compare(n, "gte", 2), "GreaterThanOrEqual(n,2)"),
                         (Not(Compare(s, "prefix", "a")), "Or(IsNull(s),Not(StringStartsWith(s,a)))")):
        plan = docs.filter(compiled(node)).select("m_document_id")._jdf.queryExecution().executedPlan().toString()
        assert pushed in plan, plan


# -- cursors -------------------------------------------------------------------------------------------------------
def test_cursors_are_bound_signed_and_expire():
    now = [1000.0]
    signer = Signer(b"0123456789abcdef", 900, lambda: now[0])
    bound = {"plan": "p", "scope": "s"}
    token = signer.issue(bound, [1.25, None, "é"], "snap")
    assert signer.open(token, bound) == ([1.25, None, "é"], "snap")
    for bad in (token[:-2] + "AA", "x" + token, token[:20], ""):
        with pytest.raises(CursorRejected):
            signer.open(bad, bound)
    with pytest.raises(CursorRejected):
        signer.open(token, {**bound, "scope": "t"})
    with pytest.raises(CursorRejected):
        Signer(b"another secret!!!", 900, lambda: now[0]).open(token, bound)
    now[0] += 901
    with pytest.raises(CursorRejected):
        signer.open(token, bound)


def test_keysets_in_all_orders(spark):
    rows = [(str(i), a, b) for i, (a, b) in enumerate((a, b) for a in (None, 1, 2) for b in (None, 5, 6))]
    df = spark.createDataFrame(rows, "id string, a int, b int").cache()
    for da in (False, True):
        for na in (False, True):
            for nb in (False, True):
                order = [(F.col("a"), da, na), (F.col("b"), not da, nb), (F.col("id"), False, False)]
                by = [getattr(c, f"{'desc' if d else 'asc'}_nulls_{'first' if n else 'last'}")() for c, d, n in order]
                full = [r.id for r in df.orderBy(*by).collect()]
                for cut in (0, 4, 8):
                    at = next(r for r in rows if r[0] == full[cut])
                    value = [None if v is None else F.lit(v) for v in (at[1], at[2], at[0])]
                    assert [r.id for r in df.filter(after(order, value)).orderBy(*by).collect()] == full[cut + 1 :]


# -- analysis ------------------------------------------------------------------------------------------------------
@pytest.mark.parametrize(("word", "stem"), [
    ("caresses", "caress"), ("ponies", "poni"), ("cats", "cat"), ("feed", "feed"), ("agreed", "agre"), ("plastered", "plaster"), ("motoring", "motor"), ("sing", "sing"), ("conflated", "conflat"),
    ("troubling", "troubl"), ("sized", "size"), ("hopping", "hop"), ("falling", "fall"), ("hissing", "hiss"), ("failing", "fail"), ("filing", "file"), ("happy", "happi"), ("sky", "sky"),
    ("relational", "relat"), ("conditional", "condit"), ("vietnamization", "vietnam"), ("hopefulness", "hope"), ("triplicate", "triplic"), ("formative", "form"), ("electrical", "electr"),
    ("revival", "reviv"), ("adjustment", "adjust"), ("adoption", "adopt"), ("probate", "probat"), ("rate", "rate"), ("controlling", "control"), ("roll", "roll"), ("gathering", "gather"), ("boxes", "box"),
])
def test_stems(word, stem):
    assert _Porter.stem(word) == stem


def test_chains():
    assert (chain_of("en-GB"), chain_of("zh-Hans"), chain_of("ar"), chain_of(None), chain_of(None, "plain")) == ("english", "default", "default", "default", "plain")
    assert analyse("The gardener's hedges", "english") == ["garden", "hedg"] and analyse("Éléphant ÅNGSTRÖM", "default") == ["elephant", "angstrom"]
    assert analyse("苔藓松树 苔 b", "default") == ["苔藓", "藓松", "松树", "苔", "b"] and fold("Ｆｕｌｌ") == "full"
    assert analyse("don't 3.5", "plain") == ["don", "t", "3", "5"] and analyse("حديقة الشتاء", "default") == ["حديقة", "الشتاء"]


def test_edits(spark):
    assert edits("ab", "ba", 2) == 1 and edits("ledger", "legder", 1) == 1 and edits("abc", "abc", 0) == 0 and edits("abc", "xyz", 2) == 3 and edits("a", "abcd", 2) == 3
    vocabulary = spark.createDataFrame([("ledger", 5), ("ledges", 9), ("badger", 1), ("led", 1)], "term string, df bigint")
    assert fuzzy_terms(vocabulary, ["ledgr"], 1) == {"ledgr": ["ledger"]} and fuzzy_terms(vocabulary, ["ledgr"], 2) == {"ledgr": ["ledger", "ledges", "led"]}


def test_fuzzy_terms_have_no_cap(spark):
    """More near terms than are literals: matches, scores and pages are those of a brute force."""
    near = ["d" + a + b for a in "abcdefghij" for b in "klmnopqrst"]  # 100 terms within 2 edits of "der"
    layout = compile_layout(Schema("structured:t.fuzzy", (Field("k", "int64"), Field("s", "string"), Field("e", "string", language="en")), ("k",)), SearchProfile(("s", "e")))
    rows = [(k, f"{t} zzzzzz {near[k // 2]} zzzzzz", "zzzzzz " * k + t) for k, t in enumerate(near)] + [(100, "zzzzzz", "zzzzzz"), (101, None, None)]
    df = spark.createDataFrame(rows, "k int, s string, e string")
    docs = as_documents(df, layout, {"k": F.col("k"), "s": F.col("s"), "e": F.col("e")}, F.col("k").cast("string"))
    make = lambda **q: Search(from_mapping(layout, {"resource": layout.resource, "query": {"text": "der", "fuzziness": 2, **q}, "where": {}, "facets": [], "highlights": [], "limit": 5}), docs, "all")
    assert {int(r.m_document_id) for r in make(fields=["s"], operator="and").matched.collect()} == set(range(100))
    search = make(fields=["s", "e"])
    got = {int(r.m_document_id): r.score for r in search.scored().collect()}
    assert sorted(got) == list(range(100)) and len(search.page()["items"]) == 5

    def brute(column, chain):
        texts = {r[0]: analyse(r[column], chain) for r in rows if r[column] is not None}
        average, vocabulary = sum(map(len, texts.values())) / len(texts), {t for ts in texts.values() for t in ts}
        df = {t: sum(t in ts for ts in texts.values()) for t in vocabulary if edits("der", t, 2) <= 2}
        weight = {t: math.log(1 + (len(texts) - n + 0.5) / (n + 0.5)) for t, n in df.items()}
        return {k: sum(w * n / (n + 1.2 * (0.25 + 0.75 * len(ts) / average)) for t, w in weight.items() if (n := ts.count(t))) for k, ts in texts.items()}

    plain, stemmed = brute(1, "default"), brute(2, "english")
    assert all(got[k] == pytest.approx(max(plain[k], stemmed[k]), rel=1e-12) for k in range(100))


def test_long_keywords_are_not_found_exactly(spark):
    layout = compile_layout(Schema("structured:t.long", (Field("k", "int64"), Field("s", "string")), ("k",)), SearchProfile(("s",), analysis="plain"))
    df = spark.createDataFrame([(1, "x" * 40_000), (2, "x")], "k bigint, s string")
    docs = as_documents(df, layout, {"k": F.col("k"), "s": F.col("s")}, F.col("k").cast("string"))
    make = lambda where, query=None: Search(from_mapping(layout, {"resource": layout.resource, "query": query, "where": where, "facets": [], "highlights": [], "limit": 5}), docs, "all")
    assert [r.m_document_id for r in make({"s": {"$prefix": "x"}}).matched.collect()] == ["2"]
    assert make({}, "x" * 16_000).total().first().total == 0 and UTC
