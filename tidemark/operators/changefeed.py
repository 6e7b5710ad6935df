"""A stream of inserts, updates and deletes applied as a signed multiset.

Every deduplicated change contributes its before-image with -1 and its after-image with +1; multiplicities are summed
with those of the base table and the images with a positive sum are the current state.

1. Deliveries are reduced to one change per event (first delivery), then to one change per record and sequence (the
   last event under an equal sequence): both are partial aggregations, so a hot record is thinned before any shuffle.
2. The before-image of a change is the after-image of the change before it.  Changes are cut into chunks of a record
   by ranges of the sequence (2 ** ``chunk_bits`` sequences wide, so a chunk has at most that many changes, however hot the
   record).  Within a chunk the images cancel against each other; what is left is the chunk's last image (+1).
3. The chunks of a record are chained the same way, the tail of one chunk being the before-image (-1) of the next.

The state keeps tombstones (records whose image is null, with the sequence of their delete), so that a change that comes
late, in whatever later bulk, does not bring a deleted record back.  ``FeedStore`` applies bulk after bulk: it keeps the
state and the events it has seen, and publishes both by one manifest.

Defined results: changes with a null or empty event are left out; a change whose payload is neither absent nor an
object is ignored; a delete has no after-image; where a base row and a change have one sequence, the change wins, and in
a ``FeedStore`` the event with the later first delivery; applying a feed twice changes nothing; an empty feed leaves the
base; a base without a row for a record has none of it, a base row with a null image is a tombstone.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidemark.storage import Folder, Manifest, read_paths, write_once

#: A chunk spans 2 ** CHUNK_BITS sequences, so it holds at most so many changes of a record.
CHUNK_BITS = 17
#: A bucket of a feed's state has about so many records; the number of buckets is the next power of two.
BUCKET_ROWS = 1 << 19


def first_deliveries(deliveries: DataFrame, event: str, delivery: str, carried: list[str]) -> DataFrame:
    """One row per event: its first delivery, with the carried columns of that delivery."""
    rows = deliveries.filter(F.col(event) != "")
    best = rows.groupBy(F.col(event).alias("_event")).agg(F.min(F.struct(F.col(delivery).alias("_at"), *carried)).alias("_c"))
    return best.select("_event", F.col("_c._at").alias("_at"), *[F.col("_c")[c].alias(c) for c in carried])


def signed_images(changes: DataFrame, record: str, sequence: str, image: str, chunk_bits: int = CHUNK_BITS) -> DataFrame:
    """(record, sequence, image, mult) that is left when the images of ``changes`` have cancelled out.

    ``changes`` has one row per record and sequence; ``image`` is null for a delete.
    """
    cut = F.shiftright(F.col(sequence), chunk_bits)
    rows = changes.select(F.col(record).alias("_r"), F.col(sequence).alias("_s"), F.col(image).alias("_i"), cut.alias("_chunk"))
    return _chain(_chain(rows, ["_r", "_chunk"], "_s").withColumnRenamed("_t", "_s"), ["_r"], "_s").select(
        F.col("_r").alias(record), F.col("_t").alias(sequence), F.col("_i").alias(image), "mult"
    )


def _chain(rows: DataFrame, group: list[str], order: str) -> DataFrame:
    """Minus the before-image, plus the after-image of each row in its group, summed; tails of groups remain.

    A delete leaves a tail too (with a null image), as it is what the next chunk's first change replaces.
    """
    before = F.lag(F.struct("_i", order)).over(W.partitionBy(*group).orderBy(order))
    signed = rows.select(*group, order, "_i", before.alias("_b")).select(*group, F.explode(F.array(
        F.struct(F.col(order).alias("_t"), F.col("_i"), F.lit(1).alias("m")),
        F.struct(F.col("_b")[order].alias("_t"), F.col("_b._i").alias("_i"), F.lit(-1).alias("m")),
    )).alias("x")).filter(F.col("x._t").isNotNull())
    summed = signed.groupBy(*group, F.col("x._t").alias("_t"), F.col("x._i").alias("_i")).agg(F.sum("x.m").alias("mult"))
    return summed.filter(F.col("mult") != 0).select("_r", "_t", "_i", "mult")


def state_after(changes: DataFrame, record: str, sequence: str, image: str, base: DataFrame | None = None, chunk_bits: int = CHUNK_BITS) -> DataFrame:
    """(record, sequence, image) after ``changes`` were applied to ``base``, tombstones (with a null image) included.

    ``base`` has the same three columns and one row per record; store what this returns and give it as the next base.
    Its rows enter as the changes that made them, at their own sequence, so that late changes below it do not win.
    """
    rows = changes.select(record, sequence, image)
    if base is not None:
        side = lambda df, change: df.select(record, sequence, F.struct(F.lit(change).alias("change"), F.col(image).alias("image")).alias("_v"))
        rows = side(changes, True).unionByName(side(base, False)).groupBy(record, sequence).agg(F.max("_v").alias("_v"))  # a change lies above the base
        rows = rows.select(record, sequence, F.col("_v.image").alias(image))
    left = signed_images(rows, record, sequence, image, chunk_bits)
    return left.filter(F.col("mult") > 0).select(record, sequence, image)


def current_state(changes: DataFrame, record: str, sequence: str, image: str, base: DataFrame | None = None, chunk_bits: int = CHUNK_BITS) -> DataFrame:
    """(record, sequence, image) of the records that exist after ``changes`` were applied to ``base``."""
    return state_after(changes, record, sequence, image, base, chunk_bits).filter(F.col(image).isNotNull())


def change_images(events: DataFrame, record: list[Column], sequence: str, deleted: Column) -> DataFrame:
    """One change per record and sequence from first deliveries: the event delivered last under it decides.

    The record's key is a 128-bit digest of its parts, which keeps the rows of the chain narrow.
    """
    key = F.unhex(F.md5(F.to_json(F.struct(*[c.alias(f"k{i}") for i, c in enumerate(record)]), {"ignoreNullFields": "false"})))
    image = F.struct(F.col("_at"), F.when(~deleted, F.col("_event")).alias("image"))
    last = events.select(key.alias("record"), F.col(sequence).alias("sequence"), image.alias("v")).groupBy("record", "sequence").agg(F.max("v").alias("v"))
    return last.select("record", "sequence", F.col("v.image").alias("image"))


class FeedStore:
    """The current state of a feed's records, bulk after bulk.

    A bulk has ``event``, ``at`` (order of delivery), ``record`` (binary key), ``sequence`` and ``kind`` ("upsert", "delete",
    or null for a change to be ignored), any number of deliveries per event.  State lies in buckets of the record's hash,
    of which a bulk reads and rewrites only those it touches; events seen lie in files of their bulks, with the same
    number of buckets each (a bulk looks its events up in the buckets they fall into).
    """

    STATE = "record binary, sequence bigint, at bigint, event string, kind string"
    SEEN = "event string"

    def __init__(self, spark: SparkSession, root: str, bucket_rows: int = BUCKET_ROWS):
        self.spark, self.root, self.bucket_rows = spark, root, bucket_rows
        self.manifest = Manifest(Folder(spark, root))

    def state(self) -> DataFrame:
        """(record, sequence, at, event, kind) of each record, deleted ones included."""
        _, state = self.manifest.latest()
        return read_paths(self.spark, [p for ps in state.get("buckets", {}).values() for p in ps], self.STATE)

    def current(self) -> DataFrame:
        """(record, sequence, event) of the records that exist."""
        return self.state().filter("kind = 'upsert'").select("record", "sequence", "event")

    def apply(self, bulk: DataFrame, token: str | None = None) -> int:
        """Apply a bulk; returns the published version. A bulk applied before under its token is skipped."""
        version, state = self.manifest.latest()
        if token is not None and token in state.get("tokens", []):
            return version
        run = f"{self.root}/run={version + 1:08d}-{uuid.uuid4().hex[:8]}"
        events = first_deliveries(bulk, "event", "at", ["record", "sequence", "kind"])
        events = events.select(F.col("_event").alias("event"), F.col("_at").alias("at"), "record", "sequence", "kind")
        fresh = events
        seen: dict[str, int] = state.get("seen", {})
        if seen:
            # a bulk's own events name the buckets of each older bulk that can hold them
            folders = []
            most = max(seen.values())
            wanted = {r[0] for r in bulk.filter(F.col("event") != "").select(_bucket(F.col("event"), most).alias("b")).distinct().collect()}
            for path, buckets in seen.items():
                there = set(Folder(self.spark, path).names())
                folders += [f"{path}/{n}" for n in sorted({f"b={w % buckets}" for w in wanted}) if n in there]
            fresh = events.join(read_paths(self.spark, folders, self.SEEN), "event", "left_anti")
        fresh = write_once(fresh, f"{run}/fresh")
        rows = fresh.count()
        buckets = state.get("count", 1)
        total = state.get("events", 0) + rows
        while buckets * self.bucket_rows < total:
            buckets *= 2
        old = state.get("buckets", {})
        key = _bucket(F.col("record"), buckets)
        touched = sorted(r[0] for r in fresh.filter("kind is not null").select(key.alias("b")).distinct().collect())
        if buckets != state.get("count", 1):  # the state is cut anew, which happens once for each doubling
            touched = list(range(buckets)) if old else touched
            base = self.state()
        else:
            base = read_paths(self.spark, [p for b in touched for p in old.get(str(b), [])], self.STATE)
        image = F.struct("at", "event", "kind")
        both = fresh.filter("kind is not null").select("record", "sequence", image.alias("v")).unionByName(base.select("record", "sequence", image.alias("v")))
        changes = both.groupBy("record", "sequence").agg(F.max("v").alias("v"))  # of one sequence the event that came first the latest
        left = signed_images(changes, "record", "sequence", "v").filter("mult > 0").select("record", "sequence", "v.*")
        left.withColumn("b", key).hint("rebalance", "b").write.partitionBy("b").parquet(f"{run}/state")
        made = {n[2:]: [f"{run}/state/{n}"] for n in Folder(self.spark, f"{run}/state").names() if n.startswith("b=")}
        kept = {b: p for b, p in old.items() if int(b) not in touched} if buckets == state.get("count", 1) else {}
        fresh.select("event").withColumn("b", _bucket(F.col("event"), buckets)).hint("rebalance", "b").write.partitionBy("b").parquet(f"{run}/seen")
        self.manifest.publish(version + 1, {
            "buckets": {**kept, **made}, "count": buckets, "events": total, "seen": {**seen, f"{run}/seen": buckets},
            "tokens": [*state.get("tokens", []), *([token] if token else [])],
        })
        Folder(self.spark, run).remove("fresh")
        return version + 1


def _bucket(column: Column, buckets: int) -> Column:
    return F.pmod(F.xxhash64(column), F.lit(buckets)).cast("int")

