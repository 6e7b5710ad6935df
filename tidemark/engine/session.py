"""Sessions: the public surface of the engine."""

from __future__ import annotations

import time
from collections.abc import Callable, Iterable, Mapping

from pyspark.sql import DataFrame, SparkSession

from tidemark.engine.cursor import KeyRing, Signer
from tidemark.engine.errors import FeatureMissing, FingerprintDrift, Incompatible, LifecycleError, LimitExceeded, ScopeViolation, Unplaced, Unsupported
from tidemark.engine.generation import Generations
from tidemark.engine.layout import Layout
from tidemark.engine.limits import CURSOR_SECONDS, LEASE_SECONDS, Limits
from tidemark.engine.request import Plan, from_mapping, from_operation
from tidemark.engine.search import Search
from tidemark.engine.values import canonical, fingerprint, plain, scope_fingerprint

OPERATION = "structured.search"
#: The logical operators (fixed values).
OPERATORS = (
    "and", "eq", "field", "fullText", "gt", "gte", "in", "isNull", "literal", "lt", "lte", "ne", "not", "notIn", "or", "order", "prefix", "search",
    "timestampRange",
)
#: What is refused on purpose (fixed values).
DENIED = (
    "authoritative-crud", "authoritative-transactions", "audit-atomicity", "cas", "consumer-dsl", "consumer-regex", "consumer-scripts", "cross-binding-join",
)
#: Functions of Spark without which nothing works.
NEEDED = ("try_parse_json", "try_variant_get", "schema_of_variant", "regexp_extract_all", "xxhash64")


def capabilities(limits: Limits | None = None, point_in_time: bool = False) -> dict:
    """What the engine answers, within which limits, and what it refuses."""
    limits = limits or Limits()
    return {
        "operation": OPERATION, "version": "1.0.0", "consistency": "eventual", "operators": list(OPERATORS), "denied": list(DENIED),
        "kinds": ["boolean", "date", "decimal", "duration", "enum", "float64", "int16", "int32", "int64", "int8", "string", "utcTimestamp", "uuid"],
        "limits": {**vars(limits), "members": 10_000}, "pagination": ["keyset", *(["point-in-time"] if point_in_time else [])], "ranking": ["bm25"],
        "semantics": ["full text over analysed terms", "two-valued filters", "facets over all matches", "exact totals", "highlights", "order with placed nulls"],
        "projection": {"versioning": "equal-or-higher", "writes": ["upsert", "tombstone", "bulk", "stream"]}, "joins": False, "aggregates": False,
    }


class Session:
    """Layouts bound to generations below a root. Open it, probe it, search and project, close it.

    ``pin`` is the capability fingerprint a deployment was tested with: a session that finds another one does not open.
    """

    def __init__(
        self, spark: SparkSession, root: str, prefix: str, secret: bytes | KeyRing, limits: Limits | None = None, point_in_time: bool = False,
        result_bytes: int | None = None, clock: Callable[[], float] = time.time, cursor_seconds: int = CURSOR_SECONDS, lease_seconds: int = LEASE_SECONDS, pin: str | None = None,
    ):
        self.spark, self.root, self.prefix, self.limits, self.point_in_time = spark, root, prefix, limits or Limits(), point_in_time
        self.result_bytes, self.clock, self.lease_seconds, self.pin = result_bytes, clock, lease_seconds, pin
        self.signer = Signer(secret, cursor_seconds, clock)
        self._stores: dict[str, Generations] = {}
        self._found: str | None = None

    # -- life ----------------------------------------------------------------------------------------------------
    def observe(self) -> dict:
        """The capabilities of this Spark with these limits, and their fingerprint; refused where something is missing."""
        if int(self.spark.version.split(".")[0]) < 4:
            raise Incompatible("Spark 4 is needed")
        missing = [n for n in NEEDED if not self.spark.catalog.functionExists(n)]
        if missing:
            raise FeatureMissing("a function is missing")
        found = {**capabilities(self.limits, self.point_in_time), "spark": self.spark.version}
        return {**found, "fingerprint": fingerprint(plain(found))}

    def open(self) -> Session:
        found = self.observe()["fingerprint"]
        if self.pin is not None and found != self.pin:
            raise Incompatible("the capabilities are not those of the pin", "capability-fingerprint")
        self._found = found
        return self

    def reprobe(self) -> str:
        """Observe again: the capabilities must be those the session opened with."""
        self._alive()
        if self.observe()["fingerprint"] != self._found:
            raise Incompatible("the capabilities have changed since the session opened", "capability-fingerprint")
        return self._found

    def close(self) -> None:
        self._found = None

    def __enter__(self) -> Session:
        return self.open()

    def __exit__(self, *_: object) -> None:
        self.close()

    def _alive(self) -> None:
        if self._found is None:
            raise LifecycleError("the session is not open")

    def begin(self) -> None:
        raise LifecycleError("there are no transactions")

    def commit(self) -> None:
        raise Unsupported("a search session has nothing to commit")

    def rollback(self) -> None:
        raise Unsupported("a search session has nothing to roll back")

    # -- layouts -------------------------------------------------------------------------------------------------
    def bind(self, layout: Layout, buckets: int = 16) -> Generations:
        self._alive()
        made = Generations(self.spark, self.root, self.prefix, layout, buckets, self.limits, self.clock, self.lease_seconds)
        return self._stores.setdefault(layout.resource, made)

    def store(self, resource: str) -> Generations:
        self._alive()
        if resource not in self._stores:
            raise Unplaced("no layout for the resource")
        return self._stores[resource]

    @property
    def registry(self) -> str:
        return fingerprint({r: s.layout.fingerprint for r, s in sorted(self._stores.items())})

    def probe(self, resource: str) -> dict:
        """Fail-closed checks: capabilities, analysis, pointers, fingerprint, and a search that reads nothing."""
        store = self.store(resource)
        from tidemark.engine.analysis import analyse, chain_of

        self.reprobe()
        for f in store.layout.text_fields:
            if not analyse("Northern archives 检索", chain_of(f.language, store.layout.analysis)):
                raise FeatureMissing("an analysis yields nothing")
        number = store.active()
        if len(set(store.aliases().values())) != 1:
            raise FeatureMissing("the aliases disagree")
        store.verify(number)
        store.snapshot().docs.limit(0).collect()
        return {"spark": self.spark.version, "generation": number, "layout": store.layout.fingerprint, "physical": fingerprint([number, store.layout.fingerprint])}

    def verify_physical(self, resources: Iterable[tuple[str, str | None]]) -> dict:
        """Probe several resources, each with the schema fingerprint it must have (or None); one fingerprint of them all."""
        found = {}
        for resource, schema in resources:
            if schema is not None and schema != self.store(resource).layout.schema_fingerprint:
                raise FingerprintDrift("the resource has another schema")
            found[resource] = self.probe(resource)["physical"]
        return {"resources": found, "fingerprint": fingerprint(found)}

    # -- searching ---------------------------------------------------------------------------------------------
    def plan(self, request: Mapping) -> Plan:
        """A mapping search has ``resource``, a planned operation has ``targets``."""
        if "targets" in request:
            targets = request["targets"]
            if not isinstance(targets, list | tuple) or len(targets) != 1:
                raise ScopeViolation("one target is needed")
            return from_operation(self.store(targets[0]).layout, request, self.limits, self.point_in_time)
        return from_mapping(self.store(request.get("resource", "")).layout, request, self.limits)

    def search(self, request: Mapping, tenant: str | None = None, scope: Mapping[str, str] | None = None, lease: str | None = None) -> dict:
        """One page, in the form of the result contract. A point in time comes back under ``pointInTime``."""
        self._alive()
        plan = self.plan(request)
        own = scope_fingerprint(tenant, scope)
        store = self.store(plan.layout.resource)
        if plan.point_in_time:
            lease = lease or store.open_lease()
            snapshot = store.leased(lease)
        else:
            snapshot = store.snapshot()
        result = Search(plan, snapshot.docs, own, self.limits, index=snapshot.index).page(self.signer, self.registry, lease if plan.point_in_time else None)
        size = len(canonical(plain(result)).encode())
        if self.result_bytes is not None and size > self.result_bytes:
            raise LimitExceeded("the result is too large")
        if plan.point_in_time:
            if result["cursor"] is None:
                store.close_lease(lease)
                lease = None
            result = {**result, "pointInTime": lease}
        origin = {
            "engine": "tidemark", "consistency": "eventual", "pagination": "point-in-time" if plan.point_in_time else "live-keyset", "resultBytes": size,
            "schemaFingerprint": plan.layout.schema_fingerprint, "layoutFingerprint": plan.layout.fingerprint, "planFingerprint": plan.fingerprint, "snapshot": snapshot.id,
        }
        return {**result, "provenance": origin}

    def close_point_in_time(self, resource: str, lease: str) -> None:
        self.store(resource).close_lease(lease)

    # -- writing -----------------------------------------------------------------------------------------------
    def project(self, resource: str, mutations: DataFrame, refresh: str = "wait_for") -> DataFrame:
        return self.store(resource).bulk(mutations, refresh=refresh)

    def project_one(self, resource: str, mutation: Mapping, refresh: str = "false") -> dict:
        """Apply one mutation; its acknowledgement, or an error if it can never be applied."""
        return self.store(resource).receipt(mutation, refresh=refresh)

    def backfill(self, resource: str, mutations: DataFrame, generation: int | None = None) -> DataFrame:
        return self.store(resource).apply(mutations, generation)
