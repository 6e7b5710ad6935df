"""Only new or changed records, by a Merkle tree over key-range hashes.

A record belongs to the leaf of its key range (its upper bits); a node one level up covers ``2 ** fan_bits`` nodes.
The digest of a node is a multiset hash of the records below it: their number and sums of the pieces of a 64-bit hash of
identifier, key and content.  Such digests add up and can be taken away again, so a parent follows from its children and
a tree from the trees of partial inputs; a record delivered twice counts twice, and no grouping by record is needed.

A run compares its tree with the saved one from the top, opens only nodes whose digests differ, compares the records of
the changed leaves with those the saved state has there, and publishes output, records and tree by one manifest.  A run
that fails before that has published neither; the next one finds the same leaves changed and yields the same records, so
nothing is skipped and nothing comes twice.

``MerkleRuns`` is the store a production run uses, on a snapshot (one narrow pass makes its tree) or on folders of
immutable files (a file seen before adds its saved tree and is not read).  ``replay`` works through a whole log of runs
in one pass: the same digests and the same descent with the run as a further column.

Defined results: rows with a null or empty identifier are left out; a null key counts as key 0; a record is its identifier,
key and content columns, so an identifier whose key or content differs is changed and comes out again, one delivered
again as it was is not; content that turns back to an older value is a change in a snapshot; an empty input gives an
empty output, and as a snapshot removes what was known.  In ``replay``, where contents do not matter, the key of an
identifier is its smallest.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators.diff import comparable
from tidemark.shipping import ship
from tidemark.storage import Folder, Manifest, read_paths, write_once

#: A leaf covers 2 ** LEAF_BITS keys, a node 2 ** FAN_BITS nodes of the level below; LEVELS above the leaves.
LEAF_BITS, FAN_BITS, LEVELS = 12, 8, 3
#: Changed leaves are broadcast up to so many rows of two integers (4 MB); beyond, they are joined by a shuffle.
BROADCAST_LEAVES = 250_000
#: A log of up to so many runs is compiled into one expression; a longer one is searched in Arrow batches.
INLINE_RUNS = 256
#: Ranges of changed leaves a scan gets as its filter. Where there are more, the nearest are united and the join decides.
SCAN_RANGES = 64

DIGEST = ("n", "h1", "h2", "h3")
#: Sums of digests are kept below this prime, so that they never overflow.
_PRIME = (1 << 31) - 1


def digests(row: Column) -> list[Column]:
    """Aggregates that make the digest of a multiset of rows from their 64-bit hashes (combined map-side)."""
    piece = lambda k: F.pmod(F.sum(F.shiftrightunsigned(row, 22 * k).bitwiseAND(F.lit((1 << 22) - 1))), F.lit(_PRIME))
    return [F.count(F.lit(1)).alias("n"), *[piece(k).alias(f"h{k + 1}") for k in range(3)]]


def merged(prefix: str = "") -> list[Column]:
    """The digest of a union from the digests of its parts."""
    return [F.sum(f"{prefix}n").alias(f"{prefix}n"), *[F.pmod(F.sum(f"{prefix}{d}"), F.lit(_PRIME)).alias(f"{prefix}{d}") for d in DIGEST[1:]]]


def descend(leaves: DataFrame, differs: Callable[[DataFrame], DataFrame], path: str, by: Sequence[str] = (), fan_bits: int = FAN_BITS, levels: int = LEVELS) -> DataFrame:
    """The leaves below differing nodes, found from the top of the tree downwards.

    ``leaves`` has ``leaf``, the columns ``by`` and digests; all levels are made in one aggregation and written below
    ``path``.  ``differs`` maps rows of a level (with ``node`` instead of ``leaf``, whole nodes at a time) to the
    (node, *by) whose digests differ.  Nodes below a closed one are not compared.
    """
    above = F.explode(F.array(*[F.struct(F.lit(k).alias("level"), F.shiftright("leaf", fan_bits * k).alias("node")) for k in range(levels + 1)]))
    kept = [c for c in leaves.columns if c not in ("leaf", *by)]
    prefixes = sorted({c[: -len(d)] for c in kept for d in DIGEST if c.endswith(d)})
    nodes = leaves.select(above.alias("_at"), *by, *kept).select("_at.level", "_at.node", *by, *kept)
    tree = write_once(nodes.groupBy("level", "node", *by).agg(*[x for p in prefixes for x in merged(p)]), path)
    level = lambda k: tree.filter(F.col("level") == k).drop("level")
    changed = differs(level(levels))
    for k in reversed(range(levels)):
        parent = F.shiftright(F.col("node"), fan_bits).alias("_parent")
        opened = changed.withColumnRenamed("node", "_parent")
        inside = level(k).select("*", parent).join(opened.select("_parent").distinct() if by else opened, "_parent", "left_semi").drop("_parent")
        changed = differs(inside)
        if by:  # the node was opened, but perhaps not for this value
            changed = changed.select("*", parent).join(opened, ["_parent", *by], "left_semi").select("node", *by)
    return changed.withColumnRenamed("node", "leaf")


def _sized(changed: DataFrame) -> DataFrame:
    small = changed.limit(BROADCAST_LEAVES + 1).count() <= BROADCAST_LEAVES
    return F.broadcast(changed) if small else changed


def _leaf(key: Column, bits: int) -> Column:
    return F.shiftright(F.coalesce(key.cast("bigint"), F.lit(0).cast("bigint")), bits)


def _ranges(changed: DataFrame) -> list[tuple[int, int]]:
    """At most ``SCAN_RANGES`` ranges of leaves that hold all changed ones: the widest gaps between them stay open."""
    gap = F.col("leaf") - F.lag("leaf").over(W.partitionBy("_p").orderBy("leaf"))
    rows = changed.select("leaf", F.shiftright("leaf", 16).alias("_p"))  # partitions of the window: 65,536 leaves at most
    ends = rows.groupBy("_p").agg(F.min("leaf").alias("low"), F.max("leaf").alias("high"))
    wide = rows.withColumn("gap", gap).filter("gap > 1").orderBy(F.desc("gap")).limit(SCAN_RANGES)
    edges = [(r.low, r.high) for r in ends.orderBy("low").limit(1 << 12).collect()]
    if not edges:
        return []
    if len(edges) == 1 << 12:  # so many partitions of the key space are changed that the scan gets its outer ends only
        low, high = changed.agg(F.min("leaf"), F.max("leaf")).first()
        return [(low, high)]
    cuts = [(r.leaf - r.gap, r.leaf) for r in wide.collect()] + [(a[1], b[0]) for a, b in zip(edges, edges[1:]) if b[0] - a[1] > 1]
    cuts = sorted(sorted(cuts, key=lambda c: c[0] - c[1])[: SCAN_RANGES - 1])
    return list(zip([edges[0][0], *[b for _, b in cuts]], [*[a for a, _ in cuts], edges[-1][1]]))


def _within(column: Column, ranges: Sequence[tuple[int, int]]) -> Column:
    return reduce(Column.__or__, [column.between(a, b) for a, b in ranges], F.lit(False))


class MerkleRuns:
    """Incremental runs over a table of records, with the saved tree beside the published output.

    Published are the output of each run, the tree of the input it saw, and the records it knows as a signed multiset of
    (leaf, identifier, digest, +1 or -1), sorted by leaf, to which a run adds its differences only.  A run reads the known
    records and the rows of the ranges of changed leaves (the ranges are filters of the scans).
    """

    def __init__(
        self, spark: SparkSession, root: str, identifier: str, key: str, id_type: T.DataType | None = None, leaf_bits: int = LEAF_BITS, content: Sequence[str] = ()
    ):
        self.spark, self.root, self.identifier, self.key, self.leaf_bits, self.content = spark, root, identifier, key, leaf_bits, list(content)
        self.manifest = Manifest(Folder(spark, root))
        long = lambda *names: [T.StructField(n, T.LongType()) for n in names]
        self.out = T.StructType([T.StructField(identifier, id_type or T.StringType())])
        self.place = T.StructType([*long("leaf"), T.StructField("id", id_type or T.StringType()), *long("digest"), T.StructField("m", T.IntegerType())])
        self.tree = T.StructType(long("leaf", *DIGEST))
        self.part = T.StructType([T.StructField("file", T.StringType()), *long("leaf", *DIGEST)])
        #: Of the last run, for tests and logs: the files read for their records (None if it was given a snapshot).
        self.files_read: list[str] | None = None

    def outputs(self) -> DataFrame:
        """Everything published so far."""
        return read_paths(self.spark, self.manifest.latest()[1].get("outputs", []), self.out)

    def removed(self) -> DataFrame:
        """The identifiers whose records a snapshot no longer had, by run."""
        return read_paths(self.spark, self.manifest.latest()[1].get("removed", []), self.out)

    def _rows(self, records: DataFrame) -> DataFrame:
        """(leaf, id, digest, key) of the usable rows."""
        parts = [F.col(self.identifier), F.coalesce(F.col(self.key).cast("bigint"), F.lit(0).cast("bigint"))]
        for c in self.content:
            value = comparable(F.col(c), records.schema[c].dataType)
            parts += [value, value.isNull()]
        kept = records.filter(F.col(self.identifier) != "")
        return kept.select(_leaf(F.col(self.key), self.leaf_bits).alias("leaf"), F.col(self.identifier).alias("id"), F.xxhash64(*parts).alias("digest"))

    def _tree(self, rows: DataFrame, by: Sequence[str] = ()) -> DataFrame:
        return rows.groupBy(*by, "leaf").agg(*digests(F.col("digest")))

    def _new_run(self) -> tuple[int, dict, str]:
        version, state = self.manifest.latest()
        self.files_read = None
        return version + 1, state, f"{self.root}/run={version + 1:08d}-{uuid.uuid4().hex[:8]}"

    def run(self, records: DataFrame, publish: bool = True, journal: DataFrame | None = None, removals: bool = True) -> DataFrame:
        """The identifiers to process in this run over a snapshot.

        Known records that the snapshot no longer has are removed, unless ``removals`` is false (for input that is not
        always whole); then they stay known and never come out again.  ``journal`` has identifiers that an unfinished run has already dealt with: they become known without coming out.
        With ``publish=False`` the run dies before it publishes.
        """
        version, state, run = self._new_run()
        tree = write_once(self._tree(self._rows(records)), f"{run}/tree")
        key = F.coalesce(F.col(self.key).cast("bigint"), F.lit(0).cast("bigint"))

        def source(ranges: list[tuple[int, int]]) -> DataFrame:
            span = [(a << self.leaf_bits, ((b + 1) << self.leaf_bits) - 1) for a, b in ranges]
            whole = _within(F.col(self.key), span) | (F.col(self.key).isNull() if any(a <= 0 <= b for a, b in ranges) else F.lit(False))
            return self._rows(records.filter(whole if records.schema[self.key].dataType == T.LongType() else _within(key, span)))

        return self._publish(version, state, run, tree, source, removals, journal, publish, {})

    def run_files(self, paths: Sequence[str], publish: bool = True, journal: DataFrame | None = None) -> DataFrame:
        """The same over folders of Parquet files that are never changed in place.

        Files seen before (by path, length and time) are not read: their trees are saved.  If files have gone, the files
        that have rows in the changed leaves are read again, in those leaves only.
        """
        version, state, run = self._new_run()
        now = {f"{p}|{n}|{t}": p for path in paths for p, n, t in Folder(self.spark, path).files() if p.endswith(".parquet")}
        parts = read_paths(self.spark, state.get("parts", []), self.part)
        before = {r[0] for r in parts.select("file").distinct().collect()} | set(state.get("empty", []))
        added, gone = sorted(set(now) - before), sorted(before - set(now))
        read = lambda names: self.spark.read.parquet(*[now[n] for n in names])
        new_parts = self.spark.createDataFrame([], self.part)
        if added:
            names = self.spark.createDataFrame([(now[n].split("/")[-1], n) for n in added], "_name string, file string")
            rows = read(added)
            at = F.element_at(F.split(F.col("_metadata.file_path"), "/"), -1)
            digested = self._rows(rows).select("*", at.alias("_name")) if len({now[n].split("/")[-1] for n in added}) == len(added) else None
            if digested is None:  # equal names in several folders: file by file
                pieces = [self._rows(read([n])).select("*", F.lit(n).alias("file")) for n in added]
                new_parts = self._tree(reduce(DataFrame.unionByName, pieces), ["file"])
            else:
                new_parts = self._tree(digested, ["_name"]).join(F.broadcast(names), "_name").select("file", "leaf", *DIGEST)
        new_parts = write_once(new_parts, f"{run}/parts")
        lost = parts.filter(F.col("file").isin(gone)) if gone else parts.limit(0)
        signed = [read_paths(self.spark, state.get("tree", []), self.tree), new_parts.select("leaf", *DIGEST), lost.select("leaf", *[(-F.col(d)).alias(d) for d in DIGEST])]
        tree = reduce(DataFrame.unionByName, signed).groupBy("leaf").agg(*merged()).filter("n > 0")
        tree = write_once(tree, f"{run}/tree")

        def source(ranges: list[tuple[int, int]]) -> DataFrame:
            wanted = set(added)
            if gone:
                touched = parts.unionByName(new_parts).filter(_within(F.col("leaf"), ranges)).select("file").distinct()
                wanted |= {r[0] for r in touched.collect()} & set(now)
            self.files_read = sorted(now[n] for n in wanted)
            return self._rows(read(sorted(wanted))) if wanted else self.spark.createDataFrame([], self.place).select("leaf", "id", "digest")

        if gone:  # the parts of files that have gone leave the store
            kept = parts.filter(~F.col("file").isin(gone)).unionByName(new_parts)
            part_paths = [f"{run}/parts_kept"]
            kept.write.parquet(part_paths[0])
        else:
            part_paths = [*state.get("parts", []), f"{run}/parts"]
        known = {r[0] for r in read_paths(self.spark, part_paths, self.part).select("file").distinct().collect()}
        more = {"parts": part_paths, "empty": sorted(set(now) - known)}
        return self._publish(version, state, run, tree, source, bool(gone), journal, publish, more)

    def _publish(self, version: int, state: dict, run: str, tree: DataFrame, source, whole: bool, journal: DataFrame | None, publish: bool, more: dict) -> DataFrame:
        """Descend, compare the records of the changed leaves, publish. ``whole``: the source has all records of them."""
        saved = read_paths(self.spark, state.get("tree", []), self.tree)
        sides = [t.select("leaf", *[F.col(d).alias(f"{p}{d}") for d in DIGEST]) for t, p in ((tree, "c_"), (saved, "s_"))]
        both = sides[0].join(sides[1], "leaf", "full_outer").na.fill(0)
        changed = write_once(descend(both, lambda t: t.filter(_unequal("c_", "s_")).select("node"), f"{run}/nodes"), f"{run}/changed")
        ranges = _ranges(changed)
        sized = _sized(changed)
        known = read_paths(self.spark, state.get("places", []), self.place).filter(_within(F.col("leaf"), ranges)).join(sized, "leaf", "left_semi")
        now = source(ranges).join(sized, "leaf", "left_semi")
        sides = now.select("leaf", "id", "digest", F.lit(True).alias("now"), F.lit(0).alias("m")).unionByName(known.select("leaf", "id", "digest", F.lit(False).alias("now"), "m"))
        compared = sides.groupBy("leaf", "id", "digest").agg(F.max("now").alias("now"), F.sum("m").alias("m"))
        delta = compared.select("leaf", "id", "digest", F.when(F.col("now") & (F.col("m") == 0), 1).when(~F.col("now") & (F.col("m") > 0) & F.lit(whole), -1).alias("m"))
        delta = delta.filter("m is not null").repartitionByRange("leaf", "id").sortWithinPartitions("leaf")
        delta = write_once(delta.select("leaf", "id", "digest", F.col("m").cast("int")), f"{run}/places")
        fresh, gone = delta.filter("m = 1").select("id").distinct(), delta.filter("m = -1").select("id").distinct()
        if whole:
            gone.join(fresh, "id", "left_anti").select(F.col("id").alias(self.identifier)).write.parquet(f"{run}/removed")
        if journal is not None:
            fresh = fresh.join(journal.select(F.col(self.identifier).alias("id")), "id", "left_anti")
        fresh = write_once(fresh.select(F.col("id").alias(self.identifier)), f"{run}/output")
        if publish:
            self.manifest.publish(version, {
                **more, "outputs": [*state.get("outputs", []), f"{run}/output"], "places": [*state.get("places", []), f"{run}/places"], "tree": [f"{run}/tree"],
                "removed": [*state.get("removed", []), *([f"{run}/removed"] if whole else [])],
            })
        return fresh

    def compact(self) -> int:
        """Unite the known records of all runs, so that long histories stay quick to read; outputs stay as they are."""
        version, state, run = self._new_run()
        known = read_paths(self.spark, state.get("places", []), self.place).groupBy("leaf", "id", "digest").agg(F.sum("m").cast("int").alias("m")).filter("m > 0")
        known.repartitionByRange("leaf", "id").sortWithinPartitions("leaf").write.parquet(f"{run}/places")
        if state.get("parts"):
            read_paths(self.spark, state["parts"], self.part).write.parquet(f"{run}/parts")
            state["parts"] = [f"{run}/parts"]
        self.manifest.publish(version, {**state, "places": [f"{run}/places"]})
        return version


def _unequal(a: str, b: str) -> Column:
    return reduce(Column.__or__, [F.col(f"{a}{d}") != F.col(f"{b}{d}") for d in DIGEST])


def micros(time: Column) -> Column:
    """Microseconds of a time with or without zone, so that no zone of a Python process takes part."""
    return F.unix_micros(time.cast("timestamp"))


def _search(at: Column, ids: Sequence[int], cuts: Sequence[int], side: str) -> Column:
    """The id at the first cut that is not before ``at`` (``left``) or behind it (``right``), in Arrow batches."""
    ids_, cuts_ = np.array([*ids, 0]), np.array(cuts, dtype=np.int64)

    @F.pandas_udf("int")
    def search(at: pd.Series) -> pd.Series:
        found = np.searchsorted(cuts_, at.fillna(0).to_numpy(dtype=np.int64), side=side)
        return pd.Series(ids_[found], dtype="Int32").mask((found == len(cuts_)) | at.isna().to_numpy())

    return search(at)


def first_run(seen: Column, runs: Sequence[tuple[int, int | None]]) -> Column:
    """The smallest run whose snapshot is not before ``seen``; null if there is none.

    ``seen`` and the snapshots are microseconds; ``runs`` has (id, snapshot) by id.
    """
    steps, highest = [], None
    for run, snapshot in runs:
        if snapshot is not None and (highest is None or snapshot > highest):
            highest = snapshot
            steps.append((run, snapshot))
    if len(steps) <= INLINE_RUNS:
        out = F.lit(None).cast("int")
        for run, snapshot in reversed(steps):
            out = F.when(seen <= F.lit(snapshot), F.lit(run).cast("int")).otherwise(out)
        return out
    return _search(seen, [r for r, _ in steps], [s for _, s in steps], "left")


def next_run(after: Column, runs: Sequence[int], strictly: bool) -> Column:
    """The smallest run of ``runs`` (ascending) above ``after`` (or equal to it, unless strictly)."""
    if len(runs) > INLINE_RUNS:
        return _search(after.cast("bigint"), runs, runs, "right" if strictly else "left")
    listed = F.array(*[F.lit(r) for r in runs]).cast("array<int>")
    return F.array_min(F.filter(listed, lambda r: (r > after) if strictly else (r >= after)))


def replay(
    deliveries: DataFrame, run_log: DataFrame, journal: DataFrame, root: str, identifier: str = "event_id", key: str = "source_sequence", leaf_bits: int = LEAF_BITS
) -> DataFrame:
    """(run_id, identifier): for each succeeded run of the log, what it has still to process.

    The log is metadata of one row per run and comes to the driver.  An identifier enters the current tree with the
    first succeeded run whose snapshot has it, and the saved tree with the run after, or with the first succeeded run
    after one that left it a final outcome in the journal.  Where the two trees differ at a run, that run has work: the
    records of the leaf that are in its current tree and not in its saved tree.
    """
    spark = deliveries.sparkSession
    ship(spark)
    runs = [(r[0], r[1]) for r in run_log.filter("run_state = 'succeeded'").select("run_id", micros(F.col("snapshot_at")).alias("snapshot_at")).orderBy("run_id").collect()]
    if not runs:
        return spark.createDataFrame([], f"run_id int, {identifier} string")
    events = deliveries.filter(F.col(identifier) != "").groupBy(identifier).agg(F.min(micros(F.col("received_at"))).alias("_seen"), F.min(key).alias("_key"))
    final = journal.filter((F.col(identifier) != "") & (F.col("outcome") != "retryable")).groupBy(identifier).agg(F.min("run_id").alias("_done"))
    ids = [r for r, _ in runs]
    known = events.withColumn("_from", first_run(F.col("_seen"), runs)).filter("_from is not null").join(final, identifier, "left")
    early = F.when(F.col("_done") < F.col("_from"), F.col("_done"))
    saved_from = F.coalesce(next_run(early, ids, True), next_run(F.col("_from"), ids, True))
    known = write_once(known.select(identifier, _leaf(F.col("_key"), leaf_bits).alias("leaf"), "_from", saved_from.alias("_saved")), f"{root}/known")
    # one pass: digests by leaf and (run that adds to the current tree, run that adds to the saved tree)
    by_both = known.groupBy("leaf", "_from", "_saved").agg(*digests(F.xxhash64(identifier, "leaf")))
    zero = [F.lit(0).cast("bigint")] * len(DIGEST)
    adds = by_both.select("leaf", F.explode(F.array(
        F.struct(F.col("_from").alias("run"), *[F.col(d).alias(f"c_{d}") for d in DIGEST], *[z.alias(f"s_{d}") for z, d in zip(zero, DIGEST)]),
        F.struct(F.col("_saved").alias("run"), *[z.alias(f"c_{d}") for z, d in zip(zero, DIGEST)], *[F.col(d).alias(f"s_{d}") for d in DIGEST]),
    )).alias("x")).select("leaf", "x.*").filter("run is not null")
    leaves = write_once(adds.groupBy("leaf", "run").agg(*merged("c_"), *merged("s_")), f"{root}/leaves")

    def differs(level: DataFrame) -> DataFrame:
        upto = W.partitionBy("node").orderBy("run")  # at most one row per run
        states = [F.sum(f"{p}{d}").over(upto).alias(f"{p}{d}") for p in ("c_", "s_") for d in DIGEST]
        level = level.select("node", "run", *states)
        level = level.select("node", "run", *[(F.col(f"{p}{d}") if d == "n" else F.pmod(f"{p}{d}", F.lit(_PRIME))).alias(f"{p}{d}") for p in ("c_", "s_") for d in DIGEST])
        return level.filter(_unequal("c_", "s_")).select("node", "run")

    changed = write_once(descend(leaves, differs, f"{root}/nodes", ["run"]).withColumnRenamed("run", "run_id"), f"{root}/changed")
    # of a leaf changed at a run, what the snapshot has and the saved state lacks: that begins at a run that adds to a tree
    # and ends with the next run
    fresh = known.join(_sized(changed), "leaf").filter((F.col("_from") <= F.col("run_id")) & (F.col("_saved").isNull() | (F.col("run_id") < F.col("_saved"))))
    fresh = write_once(fresh.select("run_id", identifier), f"{root}/output")
    Manifest(Folder(spark, root)).publish(1, {"outputs": [f"{root}/output"], "tree": [f"{root}/leaves"]})
    return fresh
