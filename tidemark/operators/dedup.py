"""Messages delivered more than once: exactly one copy of each stays.

``ExactlyOnceStore`` keeps one winner per identifier in historical partitions (by default the UTC day of the winner's
time).  Applying a bulk of incoming messages

1. reduces the bulk to its best candidate per identifier (map-side aggregation, no window, so a hot identifier costs
   one partial row per task);
2. looks the identifiers up in the identifier index (identifier -> partition, in hash buckets whose number follows the
   number of entries, sorted by identifier; only the buckets the bulk touches are read) and so learns which historical
   partitions can hold an older copy;
3. reads only those partitions, combines them with the candidates and recomputes the single winners;
4. writes new files for these partitions only and publishes them, the index entries and the surplus by one manifest.
   Partitions nobody touched are listed again by path and not copied.

Surplus lies in partitions of its own time, so a loser that is delivered again is found in its partition and not told
again: bulk, displaced and present winners and known surplus are united and grouped once by delivery.

A run that dies before it publishes has no effect and can be repeated; a bulk applied twice under one ``token`` is
recognised and skipped, however long ago it was.

Defined results: rows with a null or empty identifier are left out; a null time counts as latest; among equal times
the smallest sequence stays (null before any number); rows equal in identifier, time and sequence are one delivery and
come out once, in whatever bulks they come; an empty bulk publishes nothing but its token; extra columns are carried
whatever their names.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.storage import Folder, Manifest, read_paths, write_once

#: An index bucket has about so many identifiers; their number is the next power of two.
INDEX_ROWS = 1 << 18
#: Tokens a manifest lists itself; ``compact`` moves older ones to a table of tokens.
LISTED_TOKENS = 1_000
PERIODS = ("day", "month", "year")


class ExactlyOnceStore:
    """Winners per identifier. ``columns`` are carried besides the three that decide."""

    def __init__(
        self,
        spark: SparkSession,
        root: str,
        schema: T.StructType,
        identifier: str,
        time: str,
        sequence: str,
        columns: Sequence[str] = (),
        index_rows: int = INDEX_ROWS,
        period: str = "day",
    ):
        if not isinstance(schema[time].dataType, (T.TimestampType, T.TimestampNTZType, T.DateType)) or period not in PERIODS:
            raise TypeError("partitions are days, months or years of a time")
        self.spark, self.root = spark, root
        self.identifier, self.time, self.sequence = identifier, time, sequence
        self.columns = list(dict.fromkeys([identifier, time, sequence, *columns]))
        self.index_rows, self.period = index_rows, period
        taken = {c.casefold() for c in self.columns}
        self.folder, self.flag = (next(n for n in (name + "_" * k for k in range(len(taken) + 1)) if n.casefold() not in taken) for name in ("part", "is_new"))
        self.row = T.StructType([schema[c] for c in self.columns])
        self.index_row = T.StructType([T.StructField("id", schema[identifier].dataType), T.StructField("part", T.StringType())])
        self.manifest = Manifest(Folder(spark, root))

    # -- reading -----------------------------------------------------------------------------------------------
    def winners(self) -> DataFrame:
        """The published winners, one row per identifier."""
        _, state = self.manifest.latest()
        return self._rows(_all(state.get("parts", {})))

    def surplus(self) -> DataFrame:
        """Every delivery that has lost so far."""
        _, state = self.manifest.latest()
        return self._rows(_all(state.get("surplus", {})))

    def _rows(self, paths: list[str], *more: T.StructField) -> DataFrame:
        return read_paths(self.spark, paths, T.StructType([*self.row.fields, *more]))

    def applied(self, token: str) -> bool:
        """Whether a bulk with this token has been applied."""
        _, state = self.manifest.latest()
        if token in state.get("tokens", []):
            return True
        older = read_paths(self.spark, state.get("older_tokens", []), "token string")
        return not older.filter(F.col("token") == token).isEmpty()

    # -- writing -----------------------------------------------------------------------------------------------
    def _part(self) -> Column:
        """The partition of a row, the same under any time zone of the session."""
        kind, time = self.row[self.time].dataType, F.col(self.time)
        day = F.date_from_unix_date(F.floor(F.unix_micros(time) / F.lit(86_400_000_000)).cast("int")) if kind == T.TimestampType() else F.to_date(time)
        return F.coalesce((day if self.period == "day" else F.trunc(day, self.period)).cast("string"), F.lit("none"))

    def _best(self, rows: DataFrame, *flags: Column) -> DataFrame:
        order = F.struct(F.col(self.time).isNull(), F.col(self.time), F.col(self.sequence))
        rest = [c for c in self.columns if c != self.identifier]
        best = rows.groupBy(self.identifier).agg(F.min_by(F.struct(*rest), order).alias("_best"), *flags)
        return best.select(self.identifier, *[F.col("_best")[c].alias(c) for c in rest], *best.columns[2:]).select(*self.columns, *best.columns[2:])

    def affected(self, candidates: DataFrame, state: dict) -> list[str]:
        """The historical partitions that may hold a copy of a candidate, by the identifier index.

        The answer is a list of partition names (days), so its size is bounded by the age of the history.
        """
        index = state.get("index", {})
        if not index:
            return []
        ids = candidates.select(F.col(self.identifier).alias("id"))
        most = max(i["buckets"] for i in index.values())
        wanted = {r[0] for r in ids.select(_bucket(F.col("id"), most).alias("b")).distinct().collect()}  # powers of two: each index's buckets follow
        folders = [f"{self.root}/{p}/b={b}" for p, i in index.items() for b in sorted({w % i["buckets"] for w in wanted} & set(i["present"]))]
        if not folders:
            return []
        known = self.spark.read.schema(self.index_row).parquet(*folders)
        return sorted(r[0] for r in known.join(ids, "id", "left_semi").select("part").distinct().collect())

    def _write_index(self, entries: DataFrame, run: str) -> dict:
        """Entries in buckets by their number, sorted by identifier; {path: buckets}."""
        path, buckets = f"index/{run}", 1
        rows = entries.count()
        while buckets * self.index_rows < rows:
            buckets *= 2
        rows = entries.withColumn("b", _bucket(F.col("id"), buckets)).hint("rebalance", "b").sortWithinPartitions("b", "id")
        rows.write.partitionBy("b").option("parquet.bloom.filter.enabled#id", "true").parquet(f"{self.root}/{path}")
        present = [int(n[2:]) for n in Folder(self.spark, f"{self.root}/{path}").names() if n.startswith("b=")]
        return {path: {"buckets": buckets, "present": present}}

    def _write_parts(self, rows: DataFrame, path: str) -> dict[str, list[str]]:
        """Rows in folders of their partitions; {partition: [path]}."""
        rows.withColumn(self.folder, self._part()).hint("rebalance", self.folder).write.partitionBy(self.folder).parquet(path)  # a large partition gets several writers
        return {n.partition("=")[2]: [f"{path}/{n}"] for n in Folder(self.spark, path).names() if n.startswith(f"{self.folder}=")}

    def compact(self, tokens: int = LISTED_TOKENS) -> int:
        """Make the index anew from the winners and unite the surplus, so that long histories stay quick to look up.

        All but the newest ``tokens`` tokens move to a table, where they are still found.  Nothing is removed that a
        reader of an older manifest may still read.
        """
        version, state = self.manifest.latest()
        run = f"run={version + 1:08d}-{uuid.uuid4().hex[:8]}"
        index = self._write_index(self.winners().select(F.col(self.identifier).alias("id"), self._part().alias("part")), run)
        surplus = self._write_parts(self.surplus(), f"{self.root}/{run}/surplus")
        listed = state.get("tokens", [])
        cut = max(0, len(listed) - tokens)
        older = list(state.get("older_tokens", []))
        if cut:
            self.spark.createDataFrame([(t,) for t in listed[:cut]], "token string").write.parquet(f"{self.root}/{run}/tokens")
            older.append(f"{self.root}/{run}/tokens")
        self.manifest.publish(version + 1, {**state, "index": index, "surplus": surplus, "tokens": listed[cut:], "older_tokens": older, "rewritten": []})
        return version + 1

    def apply(self, incoming: DataFrame, token: str | None = None) -> int:
        """Take a bulk of deliveries in; returns the published version."""
        version, state = self.manifest.latest()
        if token is not None and self.applied(token):
            return version
        run = f"run={version + 1:08d}-{uuid.uuid4().hex[:8]}"
        rows = incoming.select(*self.columns).filter(F.col(self.identifier) != "")
        seen = Observation()
        candidates = write_once(self._best(rows.observe(seen, F.collect_set(self._part()).alias("parts"))), f"{self.root}/{run}/candidates")
        parts = {k: list(v) for k, v in state.get("parts", {}).items()}
        old = self.affected(candidates, state)
        history = self._rows([p for k in old for p in parts.pop(k, [])])
        tagged = candidates.withColumn(self.flag, F.lit(True))
        if old:
            tagged = self._best(tagged.unionByName(history.withColumn(self.flag, F.lit(False))), F.max(self.flag).alias(self.flag))
        made = self._write_parts(tagged, f"{self.root}/{run}/data")
        for name, paths in made.items():
            parts.setdefault(name, []).extend(paths)
        written = self._rows(_all(made), T.StructField(self.flag, T.BooleanType()))
        # only identifiers of this bulk can have got a new place; older entries stay true
        index = self._write_index(written.filter(self.flag).select(F.col(self.identifier).alias("id"), self._part().alias("part")), run)
        known = self._rows([p for k in sorted(seen.get["parts"] or []) for p in state.get("surplus", {}).get(k, [])])
        surplus = self._write_parts(self._losers(rows, history, written, known), f"{self.root}/{run}/surplus")
        self.manifest.publish(version + 1, {
            "parts": parts,
            "index": {**state.get("index", {}), **index},
            "surplus": {k: [*state.get("surplus", {}).get(k, []), *surplus.get(k, [])] for k in {**state.get("surplus", {}), **surplus}},
            "tokens": [*state.get("tokens", []), *([token] if token else [])],
            "older_tokens": state.get("older_tokens", []),
            "rewritten": old,
        })
        Folder(self.spark, f"{self.root}/{run}/candidates").remove()
        return version + 1

    def _losers(self, rows: DataFrame, history: DataFrame, winners: DataFrame, known: DataFrame) -> DataFrame:
        """The deliveries of a bulk, and the winners it displaced, that do not win and have not lost before."""
        deciding = [self.identifier, self.time, self.sequence]
        rest = [c for c in self.columns if c not in deciding]

        def side(df: DataFrame, settled: bool) -> DataFrame:
            carried = F.struct(*rest) if not settled else F.lit(None).cast(T.StructType([self.row[c] for c in rest]))
            return df.select(*deciding, F.lit(settled).alias("_settled"), *([carried.alias("_rest")] if rest else []))

        united = side(rows, False).unionByName(side(history, False)).unionByName(side(winners, True)).unionByName(side(known, True))
        grouped = united.groupBy(*deciding).agg(F.max("_settled").alias("_settled"), *([F.any_value("_rest", F.lit(True)).alias("_rest")] if rest else []))
        return grouped.filter(~F.col("_settled")).select(*deciding, *[F.col("_rest")[c].alias(c) for c in rest]).select(*self.columns)


def _all(parts: dict[str, list[str]]) -> list[str]:
    return [p for paths in parts.values() for p in paths]


def _bucket(column: Column, buckets: int) -> Column:
    return F.pmod(F.xxhash64(column), F.lit(buckets)).cast("int")
