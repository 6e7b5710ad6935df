"""Generations: immutable layouts under numbers, with aliases that move atomically.

A resource's folder holds ``aliases.json`` (read and write pointer in one file, replaced in one rename), one folder per
generation with its layout, and in it numbered manifests.  A manifest lists segments: the base, in buckets of the document
id whose number follows its size, and the bulks behind it.  A bulk writes its own documents only, as one more segment;
of a document the newest segment counts.  When the segments behind the base have grown to an eighth of it, the next bulk
unites them all in a new base, so a document is rewritten a bounded number of times for each doubling of the corpus.
Each segment of a layout with text has its inverted index, made once, when it is written.

Readers pin one manifest; a point in time pins it across calls by a lease, which ``vacuum`` and ``retire`` respect.
"""

from __future__ import annotations

import json
import threading
import time
import uuid
from collections.abc import Callable, Iterator, Mapping
from contextlib import contextmanager
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.engine.errors import Conflict, EngineError, FingerprintDrift, InvalidRequest, LimitExceeded, NotFound, Transient, translate
from tidemark.engine.index import Index, Segment, broadcast_if_small, write_index
from tidemark.engine.layout import Layout
from tidemark.engine.limits import LEASE_SECONDS, Limits
from tidemark.engine.projection import MUTATION, PERMANENT, RETRYABLE, acknowledge, encode, survivors, with_tokens
from tidemark.engine.values import fingerprint, generation_name, resource_folder
from tidemark.storage import Folder, Manifest, PublishConflict, read_paths, write_once

CREATED, VERIFIED, ACTIVE, RETAINED, RETIRED = "created", "verified", "active", "retained", "retired"
#: The steps of a rebuild (fixed values).
STEPS = ("create", "backfill", "verify", "cutover", "observe", "retire")
#: A bucket of the base has at most about so many documents; the number of buckets doubles beyond.
BUCKET_ROWS = 1 << 17
#: The segments behind the base are united with it when they have more than this share of its documents, or are so many.
BEHIND_SHARE, BEHIND_SEGMENTS = 1 / 8, 24
#: Folders of writes that no manifest lists are spared for so long: their bulk may still be running.
GRACE_SECONDS = 86_400


@dataclass(frozen=True)
class Rebuild:
    resource: str
    current: int | None
    target: int
    layout_fingerprint: str

    @property
    def steps(self) -> tuple[str, ...]:
        return STEPS

    @property
    def fingerprint(self) -> str:
        return fingerprint([self.resource, self.current, self.target, self.layout_fingerprint, list(STEPS)])


@dataclass(frozen=True)
class Snapshot:
    """One published version of a generation."""

    docs: DataFrame
    generation: int
    version: int
    index: Index | None = None

    @property
    def id(self) -> str:
        return f"{self.generation}.{self.version}"


class Generations:
    def __init__(
        self, spark: SparkSession, root: str, prefix: str, layout: Layout, buckets: int = 16, limits: Limits | None = None, clock: Callable[[], float] = time.time,
        lease_seconds: int = LEASE_SECONDS, bucket_rows: int = BUCKET_ROWS,
    ):
        self.spark, self.layout, self.prefix, self.buckets, self.clock = spark, layout, prefix, buckets, clock
        self.limits, self.lease_seconds, self.bucket_rows = limits or Limits(), lease_seconds, bucket_rows
        self.path = f"{root}/{resource_folder(prefix, layout.resource)}"
        self.folder = Folder(spark, self.path)
        self._lease_lock = threading.Lock()

    # -- pointers ----------------------------------------------------------------------------------------------
    def aliases(self) -> dict:
        return json.loads(self.folder.read_text("aliases.json")) if self.folder.exists("aliases.json") else {}

    def active(self) -> int:
        found = self.aliases().get("read")
        if found is None:
            raise NotFound("no active generation")
        return found

    def _name(self, number: int) -> str:
        return generation_name(self.prefix, self.layout.resource, number)[-7:]

    def _generation(self, number: int) -> Folder:
        folder = Folder(self.spark, f"{self.path}/{self._name(number)}")
        if not folder.exists("layout.json"):
            raise NotFound("no such generation")
        return folder

    # -- the six operations ------------------------------------------------------------------------------------
    def plan(self, target: int, current: int | None = None) -> Rebuild:
        if current is not None and target <= current:
            raise InvalidRequest("a rebuild needs a higher number")
        self._name(target)
        return Rebuild(self.layout.resource, current, target, self.layout.fingerprint)

    def create(self, number: int) -> str:
        folder = Folder(self.spark, f"{self.path}/{self._name(number)}")
        if folder.exists("layout.json"):
            raise Conflict("the generation exists")
        try:
            folder.write_text("layout.json", json.dumps(self.layout.to_dict()))
        except PublishConflict:
            raise Conflict("the generation exists") from None
        Manifest(folder).publish(1, {"segments": [], "layout": self.layout.fingerprint})
        return CREATED

    def verify(self, number: int) -> str:
        """The stored layout is this one, and the files have its columns."""
        folder = self._generation(number)
        stored = Layout.from_dict(json.loads(folder.read_text("layout.json")))
        if stored.fingerprint != self.layout.fingerprint:
            raise FingerprintDrift("the generation was made from another layout")
        _, state = Manifest(folder).latest()
        for segment in state["segments"]:
            found = {f.name: f.dataType for f in self.spark.read.parquet(next(iter(segment["paths"].values()))).schema}
            if any(found.get(f.name) != f.dataType for f in self.layout.struct()):
                raise FingerprintDrift("the files have other columns")
        if self._mark(folder) is None:
            folder.write_text("mark.json", json.dumps(VERIFIED), replace=True)
        return VERIFIED

    @staticmethod
    def _mark(folder: Folder) -> str | None:
        return json.loads(folder.read_text("mark.json")) if folder.exists("mark.json") else None

    def activate(self, number: int) -> int | None:
        """Read and write aliases move together; the previous generation is returned."""
        self.verify(number)
        before = self.aliases().get("read")
        self._generation(number).write_text("mark.json", json.dumps(ACTIVE), replace=True)
        self.folder.write_text("aliases.json", json.dumps({"read": number, "write": number}), replace=True)
        return before

    def rollback(self, number: int) -> int | None:
        return self.activate(number)

    def retire(self, number: int, layout_fingerprint: str) -> str:
        folder = self._generation(number)
        if layout_fingerprint != self.layout.fingerprint:
            raise FingerprintDrift("another layout's fingerprint")
        if number in self.aliases().values():
            raise Conflict("the generation is active")
        if self._leases(number):
            raise Conflict("a point in time still reads the generation")
        self.verify(number)
        folder.remove()
        return RETIRED

    def state(self, number: int) -> str:
        """created, verified, active, retained (was active before) or retired."""
        try:
            mark = self._mark(self._generation(number))
        except NotFound:
            return RETIRED
        if self.aliases().get("read") == number:
            return ACTIVE
        return {None: CREATED, VERIFIED: VERIFIED}.get(mark, RETAINED)

    # -- reading -----------------------------------------------------------------------------------------------
    def _docs(self, segment: Mapping) -> DataFrame:
        return read_paths(self.spark, sorted(segment["paths"].values()), self.layout.struct())

    def _newest(self, segments: list[dict]) -> DataFrame | None:
        """(m_document_id, newest) of the documents behind the base, whose number is at most a share of it."""
        if len(segments) < 2:
            return None
        parts = [self._docs(s).select("m_document_id", F.lit(k).alias("newest")) for k, s in enumerate(segments) if k]
        return broadcast_if_small(reduce(DataFrame.unionByName, parts).groupBy("m_document_id").agg(F.max("newest").alias("newest")))

    def _read(self, state: Mapping) -> tuple[DataFrame, Index | None]:
        segments = state["segments"]
        if not segments:
            return self.spark.createDataFrame([], self.layout.struct()), None
        newest = self._newest(segments)
        parts = []
        for k, s in enumerate(segments):
            docs = self._docs(s)
            if newest is not None and k == 0:
                docs = docs.join(newest.select("m_document_id"), "m_document_id", "left_anti")
            elif newest is not None:
                docs = docs.join(newest.filter(F.col("newest") == k).select("m_document_id"), "m_document_id", "left_semi")
            parts.append(docs.select(*self.layout.struct().fieldNames()))
        index = Index(self.spark, self.layout, [Segment(self._docs(s), s["index"]) for s in segments], newest) if self.layout.text_fields else None
        return reduce(DataFrame.unionByName, parts), index

    def snapshot(self, number: int | None = None, version: int | None = None) -> Snapshot:
        number = self.active() if number is None else number
        manifest = Manifest(self._generation(number))
        if version is None:
            version, state = manifest.latest()
            version = state.get("visible", version)  # a deferred bulk is written but not yet shown
        state = json.loads(manifest.folder.read_text(f"manifest-{version:08d}.json"))
        docs, index = self._read(state)
        return Snapshot(docs, number, version, index)

    def open_lease(self) -> str:
        """Pin the current snapshot for a while; the id says which it is."""
        number = self.active()
        version, state = Manifest(self._generation(number)).latest()
        name = f"lease-{uuid.uuid4().hex}-{number}-{state.get('visible', version)}.json"
        self._generation(number).write_text(name, json.dumps({"until": self.clock() + self.lease_seconds}))
        return name[6:-5]

    def leased(self, lease: str) -> Snapshot:
        """The pinned snapshot; each use prolongs the lease."""
        self._prolong(lease)
        _, generation, version = lease.split("-")
        return self.snapshot(int(generation), int(version))

    def _prolong(self, lease: str) -> None:
        folder, name = self._generation(int(lease.split("-")[1])), f"lease-{lease}.json"
        with self._lease_lock:  # a replaced file may be missing for a moment
            if not folder.exists(name) or json.loads(folder.read_text(name))["until"] < self.clock():
                raise NotFound("the point in time has passed")
            folder.write_text(name, json.dumps({"until": self.clock() + self.lease_seconds}), replace=True)

    @contextmanager
    def holding(self, lease: str) -> Iterator[None]:
        """Prolong a lease again and again: work between two of its uses may take longer than it lasts."""
        self._prolong(lease)
        done = threading.Event()

        def prolong() -> None:
            while not done.wait(self.lease_seconds / 4):
                try:
                    self._prolong(lease)
                except NotFound:
                    return
                except Exception:  # the file system may answer the next time; else the next use finds the lease passed
                    continue

        keeper = threading.Thread(target=prolong, daemon=True)
        keeper.start()
        try:
            yield
        finally:
            done.set()
            keeper.join()

    def close_lease(self, lease: str) -> None:
        generation = int(lease.split("-")[1])
        self._generation(generation).remove(f"lease-{lease}.json")

    def _leases(self, number: int) -> set[int]:
        """Versions that leases still pin."""
        folder, out = self._generation(number), set()
        with self._lease_lock:
            for name in folder.names():
                if name.startswith("lease-") and json.loads(folder.read_text(name))["until"] >= self.clock():
                    out.add(int(name[:-5].rsplit("-", 1)[1]))
        return out

    def vacuum(self, number: int, grace_seconds: float = GRACE_SECONDS) -> int:
        """Remove what no pinned or current version lists; the number of folders removed.

        Folders numbered above the current version belong to bulks that may still be running; they go only when they
        are older than the grace period.
        """
        folder = self._generation(number)
        current, state = Manifest(folder).latest()
        keep: set[str] = {p.split("/")[-2] for _, p in state.get("acks", {}).values()}
        for v in {current, state.get("visible", current), *self._leases(number)}:
            listed = json.loads(folder.read_text(f"manifest-{v:08d}.json"))
            keep |= {x for s in listed["segments"] for x in (s["run"], f"{s['run']}-index")}
        gone = []
        for name, modified in folder.times():
            if name.startswith("run=") and name not in keep:
                running = int(name[4:12]) > current
                if not running or self.clock() - modified > grace_seconds:
                    gone.append(name)
        for n in gone:
            folder.remove(n)
        return len(gone)

    # -- writing -----------------------------------------------------------------------------------------------
    def bulk(self, mutations: DataFrame, number: int | None = None, refresh: str = "wait_for") -> DataFrame:
        """A caller's bulk: bounded in items and bytes, acknowledged item by item in order of arrival.

        With ``refresh="wait_for"`` searches see it when the call returns, with ``"false"`` after the next refresh.  Where
        the store could not take it now, valid items are retryable and nothing of the bulk has been applied.
        """
        items, size = mutations.agg(F.count(F.lit(1)), F.sum(F.octet_length(F.coalesce("payload", F.lit(""))))).first()
        if not 1 <= items <= self.limits.bulk_actions or (size or 0) > self.limits.bulk_bytes:
            raise LimitExceeded("the bulk is out of bounds")
        try:
            return self.apply(mutations, number, refresh).orderBy("arrival")
        except Transient as error:
            rows, bad = encode(mutations, self.layout), F.col("code").isNotNull()
            return rows.select(
                "arrival", F.col("m_event_id").alias("event_id"), F.col("m_record_id").alias("record_id"), F.col("m_source_sequence").alias("source_sequence"),
                F.when(bad, PERMANENT).otherwise(RETRYABLE).alias("outcome"), F.when(bad, F.col("code")).otherwise(error.code).alias("code"),
            ).orderBy("arrival")

    def receipt(self, mutation: Mapping, number: int | None = None, refresh: str = "false") -> dict:
        """Apply one mutation; its acknowledgement, or an error if it can never be applied."""
        if set(mutation) - set(MUTATION.fieldNames()):
            raise InvalidRequest("unknown members of a mutation")
        row = self.spark.createDataFrame([tuple({"arrival": 0, **mutation}.get(n) for n in MUTATION.fieldNames())], MUTATION)
        ack = self.bulk(row, number, refresh).first().asDict()
        if ack["outcome"] == PERMANENT:
            raise InvalidRequest("the mutation can never be applied", ack["code"])
        return {k: v for k, v in ack.items() if k != "arrival"}

    def refresh(self, number: int | None = None) -> int:
        """Show what deferred bulks have written; the visible version."""
        number = self.active() if number is None else number
        manifest = Manifest(self._generation(number))
        version, state = manifest.latest()
        if "visible" not in state:
            return version
        manifest.publish(version + 1, {k: v for k, v in state.items() if k != "visible"})
        return version + 1

    def apply(self, mutations: DataFrame, number: int | None = None, refresh: str = "wait_for", token: tuple[str, int] | None = None) -> DataFrame:
        """Apply mutations of any number to a generation (by default the one the write alias names); returns the acks.

        ``token`` is (stream, batch): the last batch of a stream, applied again, gets the acknowledgements it had.
        """
        if refresh not in ("wait_for", "false"):
            raise InvalidRequest("refresh is wait_for or false")
        if number is None:
            number = self.aliases().get("write")
            if number is None:
                raise NotFound("no active generation")
        try:
            return self._apply(mutations, number, refresh == "wait_for", token)
        except EngineError:
            raise
        except Exception as error:
            raise translate(error) from None

    def _apply(self, mutations: DataFrame, number: int, show: bool, token: tuple[str, int] | None) -> DataFrame:
        folder = self._generation(number)
        manifest = Manifest(folder)
        version, state = manifest.latest()
        acks_of = dict(state.get("acks", {}))
        if token is not None and token[0] in acks_of and acks_of[token[0]][0] == token[1]:
            return self.spark.read.parquet(acks_of[token[0]][1])
        run = f"{folder.path}/run={version + 1:08d}-{uuid.uuid4().hex[:8]}"
        encoded = write_once(encode(mutations, self.layout), f"{run}-work/encoded")
        incoming = write_once(survivors(encoded), f"{run}-work/incoming")
        segments = state["segments"]
        stored, winners = None, incoming
        if segments:
            stored = write_once(self._sequences(segments, incoming), f"{run}-work/stored")
            known = stored.select("m_document_id", F.col("m_source_sequence").alias("_stored"))
            winners = incoming.join(known, "m_document_id", "left").filter(F.col("_stored").isNull() | (F.col("m_source_sequence") >= F.col("_stored"))).drop("_stored")
            winners = write_once(winners, f"{run}-work/winners")
        acks = write_once(acknowledge(encoded, stored), f"{run}-work/acks")
        rows = winners.count()
        if rows:
            segments = self._unite(segments, winners, rows, run) if self._full(segments, rows) else [*segments, self._write(with_tokens(winners, self.layout), rows, 1, run)]
        hidden = {} if show else {"visible": state.get("visible", version)}
        if token is not None:
            acks_of[token[0]] = [token[1], f"{run}-work/acks"]
        manifest.publish(version + 1, {"segments": segments, "layout": self.layout.fingerprint, "acks": acks_of, **hidden})
        work = Folder(self.spark, f"{run}-work")
        for name in ("encoded", "incoming", "stored", "winners"):
            work.remove(name)
        return acks

    def _sequences(self, segments: list[dict], incoming: DataFrame) -> DataFrame:
        """(m_document_id, m_source_sequence) of stored documents among the incoming ones, from two columns of their buckets."""
        ids = broadcast_if_small(incoming.select("m_document_id"))
        parts = [self.spark.createDataFrame([], "m_document_id string, m_source_sequence bigint")]
        for s in segments:
            paths = sorted(s["paths"].values())
            if s["buckets"] > 1:
                touched = {str(r[0]) for r in incoming.select(_bucket(s["buckets"]).alias("b")).distinct().collect()}
                paths = [p for b, p in sorted(s["paths"].items()) if b in touched]
            rows = read_paths(self.spark, paths, self.layout.struct()).select("m_document_id", "m_source_sequence")
            parts.append(rows.join(ids, "m_document_id", "left_semi"))
        return reduce(DataFrame.unionByName, parts).groupBy("m_document_id").agg(F.max("m_source_sequence").alias("m_source_sequence"))

    @staticmethod
    def _full(segments: list[dict], rows: int) -> bool:
        behind = rows + sum(s["rows"] for s in segments[1:])
        return not segments or len(segments) > BEHIND_SEGMENTS or behind > segments[0]["rows"] * BEHIND_SHARE

    def _unite(self, segments: list[dict], winners: DataFrame, rows: int, run: str) -> list[dict]:
        """One base of all segments and the winners, in as many buckets as its size needs."""
        made = with_tokens(winners, self.layout)
        docs, most = made, rows
        if segments:
            old, _ = self._read({"segments": segments})
            docs = old.join(broadcast_if_small(winners.select("m_document_id")), "m_document_id", "left_anti").select(*made.columns).unionByName(made)
            most += sum(s["rows"] for s in segments)
        buckets = max(self.buckets, segments[0]["buckets"] if segments else 1)
        while buckets * self.bucket_rows < most:
            buckets *= 2
        return [self._write(docs, None, buckets, run)]

    def _write(self, docs: DataFrame, rows: int | None, buckets: int, run: str) -> dict:
        """Write a segment and its index; its entry for the manifest."""
        rows_ = docs.withColumn("b", _bucket(buckets)).hint("rebalance", "b").sortWithinPartitions("b", "m_scope", "m_document_id")
        rows_.write.partitionBy("b").parquet(run)
        paths = {n[2:]: f"{run}/{n}" for n in Folder(self.spark, run).names() if n.startswith("b=")}
        segment = {"run": run.rsplit("/", 1)[1], "paths": paths, "buckets": buckets}
        written = self._docs(segment)
        return {**segment, "rows": written.count() if rows is None else rows, "index": write_index(written, self.layout, f"{run}-index")}


def _bucket(buckets: int) -> F.Column:
    return F.pmod(F.xxhash64("m_document_id"), F.lit(buckets)).cast("int")
