"""Requests: the closed envelope of a mapping search and the closed tree of a planned operation.

Both become a ``Plan``.  Everything that is not listed is refused: unknown members, operators, modes, other resources,
joins, grouping, aggregates, traversal, projections.  Two quirks of the engine this one answers to are put right on
purpose: a literal on the left of a range flips the operator, and clauses and facets are counted strictly.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field, replace

from tidemark.engine.errors import InvalidRequest, LimitExceeded, ScopeViolation, Unsupported
from tidemark.engine.layout import EXACT, FACET, FULL_TEXT, HIGHLIGHT, PREFIX, RANGE, FieldLayout, Layout
from tidemark.engine.limits import MEMBERS, Limits
from tidemark.engine.predicate import All, Any_, Between, Compare, Member, Missing, Node, Not, Text, clauses
from tidemark.engine.values import fingerprint, plain


@dataclass(frozen=True)
class Sort:
    field: FieldLayout
    descending: bool = False
    nulls_first: bool = False


@dataclass(frozen=True)
class Plan:
    layout: Layout
    where: Node | None
    text: Node | None = None
    facets: tuple[FieldLayout, ...] = ()
    highlights: tuple[FieldLayout, ...] = ()
    order: tuple[Sort, ...] = ()
    size: int = 10
    cursor: str | None = None
    point_in_time: bool = False
    request: dict = field(default_factory=dict)

    @property
    def fingerprint(self) -> str:
        """Of the request without its cursor, so that all pages of a search share it."""
        return fingerprint(plain({k: v for k, v in self.request.items() if k != "cursor"}))


def _members(value: object, needed: set[str], allowed: set[str] = frozenset()) -> Mapping:
    if not isinstance(value, Mapping) or needed - set(value) or set(value) - needed - set(allowed):
        raise InvalidRequest("unknown or missing members")
    return value


def _size(value: object, limits: Limits) -> int:
    if isinstance(value, bool) or not isinstance(value, int):
        raise InvalidRequest("the page size must be a number")
    if not 1 <= value <= limits.page_size:
        raise LimitExceeded("the page size is out of bounds")
    return value


def _fields(layout: Layout, names: object, mode: str, most: int) -> tuple[FieldLayout, ...]:
    if not isinstance(names, list | tuple) or not all(isinstance(n, str) for n in names) or len(set(names)) < len(names):
        raise InvalidRequest("a list of different fields is needed")
    if len(names) > most:
        raise LimitExceeded("too many fields")
    return tuple(layout.field(n, mode) for n in sorted(names))


def _text(layout: Layout, limits: Limits, text: object, fields: object, fuzziness: object, operator: object, ranking: object) -> Text:
    if not isinstance(text, str) or not text.strip():
        raise InvalidRequest("the query text is blank")
    if len(text.encode()) > limits.query_bytes:
        raise LimitExceeded("the query text is too long")
    if isinstance(fuzziness, bool) or fuzziness not in (0, 1, 2):
        raise InvalidRequest("the fuzziness is 0, 1 or 2")
    if operator not in ("or", "and"):
        raise InvalidRequest("the operator is or or and")
    if ranking != layout.ranking:
        raise Unsupported("no such ranking")
    names = list(layout.sources) if fields is None else fields
    if not isinstance(names, list | tuple) or len(set(map(str, names))) < len(names):
        raise InvalidRequest("a list of different fields is needed")
    if not names:
        raise Unsupported("the resource has no text")
    return Text(tuple(layout.field(n, FULL_TEXT) for n in names), text, fuzziness, operator == "and", ranking)


def _value(value: object) -> object:
    if value is None or isinstance(value, Mapping | list | tuple):
        raise InvalidRequest("a scalar is needed")
    return value


def _listed(values: object) -> tuple:
    if not isinstance(values, list | tuple):
        raise InvalidRequest("a list is needed")
    if len(values) > MEMBERS:
        raise LimitExceeded("too many members")
    return tuple(_value(v) for v in values)


def _prefix(f: FieldLayout, value: object) -> Compare:
    if not isinstance(value, str):
        raise InvalidRequest("a prefix is a text")
    return Compare(f, "prefix", value)


def _between(f: FieldLayout, given: Mapping) -> Between:
    _members(given, set(), {"start", "end", "includeStart", "includeEnd"})
    start, end = given.get("start"), given.get("end")
    closed = given.get("includeStart", True), given.get("includeEnd", False)
    if (start is None and end is None) or not all(isinstance(x, bool) for x in closed):
        raise InvalidRequest("a range needs an end")
    return Between(f, start, end, *closed)


def _where(layout: Layout, where: object) -> list[Node]:
    """The conditions of a mapping, in sorted order."""
    if not isinstance(where, Mapping):
        raise InvalidRequest("where must be an object")
    out: list[Node] = []
    for name in sorted(where):
        given = where[name] if isinstance(where[name], Mapping) else {"$eq": where[name]}
        if not given:
            raise InvalidRequest("no operator")
        for op in sorted(given):
            value = given[op]
            match op:
                case "$eq" | "$ne":
                    out.append(Compare(layout.field(name, EXACT), op[1:], _value(value)))
                case "$lt" | "$lte" | "$gt" | "$gte":
                    out.append(Compare(layout.field(name, RANGE), op[1:], _value(value)))
                case "$in" | "$notIn":
                    out.append(Member(layout.field(name, EXACT), _listed(value), op == "$notIn"))
                case "$prefix":
                    out.append(_prefix(layout.field(name, PREFIX), value))
                case "$isNull":
                    if not isinstance(value, bool):
                        raise InvalidRequest("$isNull is true or false")
                    out.append(Missing(layout.field(name), value))
                case "$timestampRange":
                    out.append(_between(layout.field(name, RANGE), value))
                case _:
                    raise InvalidRequest("unknown operator")
    return out


def _strict(plan: Plan, limits: Limits) -> Plan:
    if clauses(plan.where) + clauses(plan.text) > limits.filter_clauses:
        raise LimitExceeded("too many clauses")
    if len(plan.facets) > limits.facets or len(plan.highlights) > limits.highlights:
        raise LimitExceeded("too many facets or highlights")
    return plan


def from_mapping(layout: Layout, request: object, limits: Limits | None = None) -> Plan:
    """A mapping search: exactly resource, query, where, facets, highlights, limit, and a cursor if there is one."""
    limits = limits or Limits()
    given = _members(request, {"resource", "query", "where", "facets", "highlights", "limit"}, {"cursor"})
    if given["resource"] != layout.resource:
        raise ScopeViolation("another resource")
    cursor = given.get("cursor")
    if cursor is not None and not isinstance(cursor, str):
        raise InvalidRequest("a cursor is a text")
    query = given["query"]
    if query is not None:
        query = _members({"text": query} if isinstance(query, str) else query, {"text"}, {"fields", "fuzziness", "operator", "ranking"})
        query = _text(layout, limits, query["text"], query.get("fields"), query.get("fuzziness", 0), query.get("operator", "or"), query.get("ranking", layout.ranking))
    conditions = _where(layout, given["where"])
    return _strict(Plan(
        layout, All(tuple(conditions)) if conditions else None, query,
        _fields(layout, given["facets"], FACET, limits.facets), _fields(layout, given["highlights"], HIGHLIGHT, limits.highlights),
        size=_size(given["limit"], limits), cursor=cursor, request=dict(given),
    ), limits)


_FLIPPED = {"lt": "gt", "lte": "gte", "gt": "lt", "gte": "lte", "eq": "eq", "ne": "ne"}


class _Tree:
    """Compiles the expression tree of a planned operation."""

    def __init__(self, layout: Layout, limits: Limits):
        self.layout, self.limits = layout, limits
        self.facets: set[str] = set()
        self.highlights: set[str] = set()

    def _name(self, node: object) -> str:
        if isinstance(node, str):
            return node
        return _members(node, {"kind", "name"})["name"] if isinstance(node, Mapping) and node.get("kind") == "field" else self._no()

    @staticmethod
    def _no():
        raise Unsupported("a field is compared with a literal")

    def _literal(self, node: object) -> object:
        if isinstance(node, Mapping):
            return _members(node, {"kind", "value"})["value"] if node.get("kind") == "literal" else self._no()
        return node

    def node(self, given: object) -> Node:
        if not isinstance(given, Mapping):
            raise InvalidRequest("an expression is an object")
        kind = given.get("kind")
        match kind:
            case "and" | "or":
                parts = _members(given, {"kind", "operands"})["operands"]
                if not isinstance(parts, list | tuple) or not parts:
                    raise InvalidRequest("operands are needed")
                return (All if kind == "and" else Any_)(tuple(self.node(p) for p in parts))
            case "not":
                return Not(self.node(_members(given, {"kind", "operand"})["operand"]))
            case "eq" | "ne" | "lt" | "lte" | "gt" | "gte":
                left, right = _members(given, {"kind", "left", "right"})["left"], given["right"]
                if isinstance(left, Mapping) and left.get("kind") == "literal":
                    left, right, kind = right, left, _FLIPPED[kind]
                f = self.layout.field(self._name(left), EXACT if kind in ("eq", "ne") else RANGE)
                return Compare(f, kind, _value(self._literal(right)))
            case "prefix":
                _members(given, {"kind", "left", "right"})
                return _prefix(self.layout.field(self._name(given["left"]), PREFIX), self._literal(given["right"]))
            case "in" | "notIn":
                _members(given, {"kind", "operand", "values"})
                values = given["values"]
                if not isinstance(values, list | tuple):
                    raise InvalidRequest("a list is needed")
                return Member(self.layout.field(self._name(given["operand"]), EXACT), _listed([self._literal(v) for v in values]), kind == "notIn")
            case "isNull":
                _members(given, {"kind", "operand"}, {"expected"})
                expected = given.get("expected", True)
                if not isinstance(expected, bool):
                    raise InvalidRequest("expected is true or false")
                return Missing(self.layout.field(self._name(given["operand"])), expected)
            case "timestampRange":
                _members(given, {"kind", "operand"}, {"start", "end", "includeStart", "includeEnd"})
                ends = {k: self._literal(v) for k, v in given.items() if k not in ("kind", "operand")}
                return _between(self.layout.field(self._name(given["operand"]), RANGE), ends)
            case "fullText":
                _members(given, {"kind", "query"}, {"fields", "fuzzyTolerance", "ranking", "facets", "highlights"})
                self.facets |= {f.name for f in _fields(self.layout, given.get("facets", []), FACET, self.limits.facets)}
                self.highlights |= {f.name for f in _fields(self.layout, given.get("highlights", []), HIGHLIGHT, self.limits.highlights)}
                names = given.get("fields")
                names = None if names is None else [self._name(n) for n in names]
                return _text(self.layout, self.limits, self._literal(given["query"]), names, given.get("fuzzyTolerance", 0), "or", given.get("ranking", self.layout.ranking))
        raise Unsupported("unknown expression")


def from_operation(layout: Layout, operation: object, limits: Limits | None = None, point_in_time: bool = False) -> Plan:
    """A planned operation: one target, eventual consistency, a filter, an order and a page."""
    limits = limits or Limits()
    given = _members(
        operation, {"catalog", "operation", "consistency", "targets", "page"},
        {"filter", "order", "joins", "grouping", "aggregates", "traversal", "projection"},
    )
    fixed = (given["catalog"], given["operation"], given["consistency"]) == ("structured", "search", "eventual")
    if not fixed or len(given["targets"]) != 1 or any(given.get(k) for k in ("joins", "grouping", "aggregates", "traversal", "projection")):
        raise Unsupported("one eventually consistent search target without joins or aggregates is supported")
    if given["targets"][0] != layout.resource:
        raise ScopeViolation("another resource")
    page = _members(given["page"], {"size"}, {"cursor", "pointInTime"})
    if page.get("pointInTime") and not point_in_time:
        raise Unsupported("point in time is not enabled")
    tree = _Tree(layout, limits)
    where = tree.node(given["filter"]) if given.get("filter") is not None else None
    order = []
    for item in given.get("order") or ():
        item = _members(item, {"field", "direction", "nulls"})
        if item["direction"] not in ("asc", "desc") or item["nulls"] not in ("first", "last"):
            raise InvalidRequest("an order is asc or desc, nulls first or last")
        order.append(Sort(layout.field(item["field"], EXACT), item["direction"] == "desc", item["nulls"] == "first"))
    from tidemark.engine.predicate import scoring

    is_text = bool(scoring(where))
    request = {**given, "page": {k: v for k, v in page.items() if k != "cursor"}}
    plan = Plan(
        layout, None if is_text else where, where if is_text else None, tuple(layout.field(n) for n in sorted(tree.facets)),
        tuple(layout.field(n) for n in sorted(tree.highlights)), tuple(order), _size(page["size"], limits), page.get("cursor"),
        bool(page.get("pointInTime")), request,
    )
    return _strict(replace(plan), limits)
