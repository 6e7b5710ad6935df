"""Sources mixed to target weights, with soft membership of documents whose source is not known.

1. A naive-Bayes classifier over token ids is fitted on a bounded sample of labelled rows (``SAMPLE_PER_SOURCE`` rows of
   each source, by the hash of the key).  A labelled document belongs to its source with certainty; another one has the
   classifier's posterior.  The same pass counts the tokens of every document.
2. Labelled documents of one source form one stratum; documents with equal posteriors and caps form one, too.  The rate
   at which a document is used depends on nothing else.
3. Projected gradient descent on the squared relative errors of the expected tokens per source: each step is one
   distributed aggregation of the strata into as many numbers as there are sources; the diagonal majoriser of the
   Hessian gives each stratum its step, so the error falls in every step and needs no tuning.  Rates stay in [0, cap].
   Tasks hold no rates between steps: they follow from the totals of the steps so far, so a lost executor costs nothing.

The descent ends when it has converged: the next step would move the tokens of no source by more than ``TOLERANCE`` of its
target.  ``Mix.converged`` tells whether that was reached within ``iterations`` (a parameter); a mixture that has not
converged refuses to name unreachable sources.  A source is unreachable if at the rates fitted its own documents are all
at their cap and it is still short of its target; whole numbers decide only where the two are equal but for rounding.

Only numbers per source (the targets' table is metadata of one row per source) come to the driver, never documents; the
classifier's table comes to the driver too, and is refused beyond ``MODEL_CELLS`` (sources times vocabulary).

Defined results: a source without documents reaches nothing; a null cap is none, a null or negative weight is 0; null
and empty texts have 0 tokens; a document without a usable source counts towards no total and is used only where soft
members are asked for, at most as often as its likeliest source allows; empty tables reach nothing and miss nothing.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.bpe import TOKENIZERS, encoder, provide
from tidemark.storage import write_once

SAMPLE_PER_SOURCE = 400
MAX_ITERATIONS = 400
TOLERANCE = 1e-7
NO_CAP = 1 << 30
#: Sources times vocabulary of the classifier: 1 GB of single precision.
MODEL_CELLS = 1 << 28


@dataclass(frozen=True)
class Targets:
    """The sources to mix, in the order of the vectors below."""

    names: list[str]
    weights: list[Fraction]
    caps: list[int]

    @classmethod
    def of(cls, table: DataFrame) -> Targets:
        rows = table.filter("source is not null").groupBy("source").agg(F.max("target_weight").alias("w"), F.max("max_repeats").alias("m")).orderBy("source").collect()
        weights = [Fraction(r.w) if r.w is not None and r.w > 0 else Fraction(0) for r in rows]
        return cls([r.source for r in rows], weights, [NO_CAP if r.m is None else max(0, r.m) for r in rows])

    def shares(self) -> list[Fraction]:
        total = sum(self.weights) or Fraction(1)
        return [w / total for w in self.weights]


def fit_membership(labelled: DataFrame, names: list[str], per_source: int = SAMPLE_PER_SOURCE, tokenizer: str = "byte_bpe_50k", folder: str = TOKENIZERS) -> np.ndarray | None:
    """Log-probabilities of token ids by source (sources x ids, the last column the prior) from (key, source, text)."""
    provide(labelled.sparkSession, tokenizer, folder)
    sizes = {r[0]: r[1] for r in labelled.groupBy("source").count().collect()}
    if not sizes:
        return None
    width = max(encoder(tokenizer, folder).size) + 1
    if len(names) * width > MODEL_CELLS:
        raise ValueError("too many sources for one classifier: unite them into domains first")
    # a hash threshold first, so that no task ever sorts a whole source; then exactly the bound
    share = F.coalesce(*[F.when(F.col("source") == s, F.lit(min(1.0, 3 * per_source / n + 0.01))) for s, n in sizes.items()])
    ticket = F.xxhash64("key")
    thinned = labelled.filter(F.pmod(ticket, F.lit(1_000_003)) < share * 1_000_003)
    from pyspark.sql import Window as W

    picked = thinned.withColumn("_n", F.row_number().over(W.partitionBy("source").orderBy(ticket, "key"))).filter(F.col("_n") <= per_source)

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = encoder(tokenizer, folder)
        for batch in batches:
            found: dict[tuple[str, int], int] = {}
            for source, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                for i in own.encode(text):
                    found[source, i] = found.get((source, i), 0) + 1
            if found:
                yield pa.RecordBatch.from_arrays(
                    [pa.array([k[0] for k in found], pa.string()), pa.array([k[1] for k in found], pa.int32()), pa.array(list(found.values()), pa.int64())],
                    names=["source", "id", "n"],
                )

    counts = picked.select("source", "text").mapInArrow(count, "source string, id int, n bigint").groupBy("source", "id").agg(F.sum("n").alias("n"))
    rows = counts.toPandas()  # at most sources x vocabulary
    place = {s: k for k, s in enumerate(names)}
    table = np.full((len(names), width + 1), 0.1, dtype=np.float64)
    np.add.at(table, (rows["source"].map(place).to_numpy(dtype=int), rows["id"].to_numpy(dtype=int)), rows["n"].to_numpy(dtype=float))
    table[:, :width] = np.log(table[:, :width] / table[:, :width].sum(axis=1, keepdims=True))
    prior = np.array([sizes.get(s, 0) for s in names], dtype=float) + 0.5
    table[:, width] = np.log(prior / prior.sum())
    return table.astype(np.float32)


def membership(docs: DataFrame, names: list[str], model: np.ndarray | None, tokenizer: str = "byte_bpe_50k", folder: str = TOKENIZERS) -> DataFrame:
    """(key, source_no, n_tokens, member): ``source_no`` is null for a soft member, ``member`` for a certain one.

    ``docs`` has key, source and text.
    """
    provide(docs.sparkSession, tokenizer, folder)
    place = {s: k for k, s in enumerate(names)}
    shared = docs.sparkSession.sparkContext.broadcast(model)  # sources x vocabulary, independent of the corpus

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, table = encoder(tokenizer, folder), shared.value
        for batch in batches:
            sources, sizes, members = [], [], []
            for source, text in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                ids = own.encode(text)
                k = place.get(source)
                sources.append(k)
                sizes.append(len(ids))
                members.append(None if k is not None or table is None else soft_member(table, ids))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(sources, pa.int32()), pa.array(sizes, pa.int64()), pa.array(members, pa.list_(pa.float32()))],
                names=["key", "source_no", "n_tokens", "member"],
            )

    kind = docs.schema["key"].dataType.simpleString()
    return docs.select("key", "source", "text").mapInArrow(run, f"key {kind}, source_no int, n_tokens bigint, member array<float>")


def soft_member(table: np.ndarray, ids: list[int]) -> np.ndarray:
    """The posterior over sources. Tokens of a text are not independent: evidence grows with its root."""
    score = table[:, -1].astype(np.float64)
    if ids:
        score = score + table[:, ids].sum(axis=1, dtype=np.float64) / np.sqrt(len(ids))
    p = np.exp(score - score.max())
    return (p / p.sum()).astype(np.float32)


def strata(members: DataFrame, targets: Targets, soft: bool) -> DataFrame:
    """(source_no, member, cap, tokens, n): documents that are used at one rate."""
    caps = F.array(*[F.lit(c) for c in targets.caps]) if targets.caps else F.array().cast("array<int>")
    likeliest = F.array_position(F.col("member"), F.array_max("member")).cast("int")
    at = F.coalesce(F.col("source_no") + 1, likeliest)
    rows = members.filter("source_no is not null or member is not null").withColumn("cap", F.try_element_at(caps, at))
    rows = rows.filter("source_no is not null") if not soft else rows
    return rows.groupBy("source_no", "member", "cap").agg(F.sum("n_tokens").alias("tokens"), F.count(F.lit(1)).alias("n"))


def _vectors(batch: pa.RecordBatch, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Memberships (rows x sources), tokens and caps of strata."""
    member = np.zeros((batch.num_rows, k))
    for row, (source, soft) in enumerate(zip(batch.column("source_no").to_pylist(), batch.column("member").to_pylist())):
        if source is not None:
            member[row, source] = 1
        else:
            member[row] = np.array(soft, dtype=float) / (sum(soft) or 1.0)
    return member, batch.column("tokens").to_numpy().astype(float), batch.column("cap").to_numpy().astype(float)


def _goal(aim: np.ndarray, mass: np.ndarray) -> np.ndarray:
    """What errors are relative to: the target, or the tokens there are where the target is nothing."""
    return np.where(aim > 0, aim, np.where(mass > 0, mass, 1.0))


def _rates(member: np.ndarray, cap: np.ndarray, aim: np.ndarray, mass: np.ndarray, history: list[np.ndarray]) -> np.ndarray:
    """The rates after as many steps as there are totals in ``history``, from 1 (or the cap, if it is less)."""
    goal = _goal(aim, mass)
    rate = np.minimum(1.0, cap)
    weight = member / goal
    bound = (weight * (mass / goal)).sum(axis=1)
    for total in history:
        step = (weight * ((total - aim) / goal)).sum(axis=1) / np.where(bound > 0, bound, 1.0)
        rate = np.clip(rate - step, 0.0, cap)
    return rate


@dataclass
class Descent:
    """Totals per source before each step, those at the end, and how close to its cap each source's own stratum is."""

    history: list
    aim: np.ndarray
    mass: np.ndarray
    reached: np.ndarray
    rate: np.ndarray
    converged: bool


def fit_rates(groups: DataFrame, targets: Targets, total: int, iterations: int = MAX_ITERATIONS, tolerance: float = TOLERANCE) -> Descent:
    """Descend until no source's tokens move by more than ``tolerance`` of its target, at most ``iterations`` steps."""
    k = len(targets.names)
    aim = np.array([float(s * total) for s in targets.shares()])
    if not k:
        return Descent([], aim, aim, aim, aim, True)

    def totals(mass: np.ndarray | None, history: list) -> np.ndarray:
        """Tokens per source at the rates after ``history``, or of all documents where ``mass`` is not known yet."""

        def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            out = np.zeros(k)
            for batch in batches:
                member, tokens, cap = _vectors(batch, k)
                rate = np.ones(batch.num_rows) if mass is None else _rates(member, cap, aim, mass, history)
                out += (member * (rate * tokens)[:, None]).sum(axis=0)
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(k), pa.int32()), pa.array(out)], names=["k", "v"])

        out = np.zeros(k)
        for r in groups.mapInArrow(run, "k int, v double").groupBy("k").agg(F.sum("v").alias("v")).collect():
            out[r.k] = r.v
        return out

    mass = totals(None, [])
    history: list = []
    now = totals(mass, history)
    converged = False
    while not converged and len(history) < iterations:
        history.append(now)
        after = totals(mass, history)
        converged = bool((np.abs(after - now) <= tolerance * np.maximum(aim, 1.0)).all())
        now = after
    own = _rates(np.eye(k), np.array(targets.caps, dtype=float), aim, mass, history)
    return Descent(history, aim, mass, now, own, converged)


@dataclass
class Mix:
    """A fitted mixture."""

    targets: Targets
    members: DataFrame
    descent: Descent
    own: list[int]
    total: int
    soft: bool

    @property
    def reached(self) -> np.ndarray:
        return self.descent.reached

    @property
    def aim(self) -> np.ndarray:
        return self.descent.aim

    @property
    def converged(self) -> bool:
        return self.descent.converged

    def unreachable(self) -> list[str]:
        """The sources whose own documents, at the rates fitted, are all at their cap and which are short of their target.

        Where what is reached and the target are equal up to the tolerance, whole numbers say on which side it ends.
        """
        if not self.converged:
            raise RuntimeError("the rates have not converged: allow more iterations")
        fit, targets, out = self.descent, self.targets, []
        shares = targets.shares()
        for k, name in enumerate(targets.names):
            at_cap = fit.rate[k] >= targets.caps[k] or fit.mass[k] == 0
            near = abs(fit.reached[k] - fit.aim[k]) <= 1e-6 * max(fit.aim[k], 1.0)
            if near:  # soft members that fill the gap count as well
                short = not self.soft and self.own[k] * targets.caps[k] < shares[k] * self.total
            else:
                short = at_cap and fit.reached[k] < fit.aim[k]
            if short:
                out.append(name)
        return out

    def rates(self) -> DataFrame:
        """(key, rate, copies): how often each document is used on average, and in this draw (by the key's hash)."""
        k, targets, history, aim, mass = len(self.own), self.targets, self.descent.history, self.descent.aim, self.descent.mass

        def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                member, tokens, cap = _vectors(batch, k)
                yield pa.RecordBatch.from_arrays([batch.column("key"), pa.array(_rates(member, cap, aim, mass, history))], names=["key", "rate"])

        caps = F.array(*[F.lit(c) for c in targets.caps])
        likeliest = F.array_position(F.col("member"), F.array_max("member")).cast("int")
        rows = self.members.filter("source_no is not null or member is not null").withColumn("cap", F.try_element_at(caps, F.coalesce(F.col("source_no") + 1, likeliest)))
        # the rate of a stratum does not depend on its tokens: one token stands for any number
        rows = rows.select("key", "source_no", "member", "cap", F.lit(1).cast("bigint").alias("tokens"))
        out = rows.mapInArrow(run, f"key {self.members.schema['key'].dataType.simpleString()}, rate double")
        draw = F.pmod(F.xxhash64("key", F.lit("draw")), F.lit(1_000_003)) / F.lit(1_000_003.0)
        return out.withColumn("copies", (F.floor("rate") + (draw < F.col("rate") - F.floor("rate")).cast("bigint")).cast("bigint"))


@dataclass
class Sources:
    """Documents with their memberships and sizes, from which mixtures are fitted."""

    targets: Targets
    members: DataFrame
    own: list[int]
    root: str

    @classmethod
    def of(cls, docs: DataFrame, target_table: DataFrame, root: str, tokenizer: str = "byte_bpe_50k", folder: str = TOKENIZERS) -> Sources:
        """Of ``docs`` (key, source, text): the classifier fitted, every document encoded and classified once."""
        targets = Targets.of(target_table)
        labelled = docs.filter(F.col("source").isin(targets.names)) if targets.names else docs.limit(0)
        model = fit_membership(labelled, targets.names, tokenizer=tokenizer, folder=folder)
        members = write_once(membership(docs, targets.names, model, tokenizer, folder), f"{root}/members")
        own = [0] * len(targets.names)
        for r in members.filter("source_no is not null").groupBy("source_no").agg(F.sum("n_tokens").alias("n")).collect():
            own[r.source_no] = r.n
        return cls(targets, members, own, root)

    def fit(self, soft: bool, iterations: int = MAX_ITERATIONS) -> Mix:
        """A mixture of the labelled documents, with ``soft`` also of those whose source is not known."""
        groups = write_once(strata(self.members, self.targets, soft), f"{self.root}/strata-{'soft' if soft else 'labelled'}")
        return Mix(self.targets, self.members, fit_rates(groups, self.targets, sum(self.own), iterations), self.own, sum(self.own), soft)


def mix(docs: DataFrame, target_table: DataFrame, root: str, soft: bool = False, tokenizer: str = "byte_bpe_50k", folder: str = TOKENIZERS, iterations: int = MAX_ITERATIONS) -> Mix:
    """Fit a mixture of ``docs`` (key, source, text) to the targets."""
    return Sources.of(docs, target_table, root, tokenizer, folder).fit(soft, iterations)


def verify(m: Mix, tolerance: float = 1e-4) -> DataFrame:
    """(source, within_cap, sums_agree, optimal): the fitted rates against what a solution has to meet, from the rates alone.

    ``within_cap``: no document of the source is used less than never or more often than its cap; ``sums_agree``: the rates
    times the sizes add up to the tokens reached; ``optimal``: the source has its target, or all its documents are at
    their cap below it, or none is used above it.
    """
    spark, k = m.members.sparkSession, len(m.own)
    soft = F.when(F.col("source_no").isNull(), F.transform("member", lambda p: p.cast("double") / F.aggregate("member", F.lit(0.0), lambda a, x: a + x)))
    hard = F.transform(F.sequence(F.lit(0), F.lit(k - 1)), lambda i: F.when(i == F.col("source_no"), 1.0).otherwise(0.0))
    rows = m.members.filter("source_no is not null" if not m.soft else "source_no is not null or member is not null").join(m.rates().select("key", "rate"), "key")
    caps = F.array(*[F.lit(float(c)) for c in m.targets.caps])
    sums = rows.select("n_tokens", "rate", F.posexplode(F.coalesce(soft, hard)).alias("k", "p")).groupBy("k").agg(F.sum(F.col("p") * F.col("rate") * F.col("n_tokens")).alias("tokens"))
    ends = rows.filter("source_no is not null").groupBy(F.col("source_no").alias("k")).agg(F.min("rate").alias("low"), F.max("rate").alias("high"), F.min(F.col("rate") >= F.element_at(caps, F.col("source_no") + 1)).alias("at_cap"))
    facts = [(i, n, float(m.targets.caps[i]), float(m.aim[i]), float(m.reached[i])) for i, n in enumerate(m.targets.names)]
    facts = spark.createDataFrame(facts, "k int, source string, cap double, aim double, reached double").join(sums, "k", "left").join(ends, "k", "left").na.fill({"tokens": 0.0})
    slack = F.greatest(F.col("aim"), F.lit(1.0)) * tolerance
    within = (F.coalesce("low", F.lit(0.0)) >= 0) & (F.coalesce("high", F.lit(0.0)) <= F.col("cap"))
    short, over = F.col("tokens") < F.col("aim") - slack, F.col("tokens") > F.col("aim") + slack
    optimal = F.when(short, F.coalesce("at_cap", F.lit(True))).when(over, F.coalesce("high", F.lit(0.0)) <= 0).otherwise(True)
    return facts.select("source", within.alias("within_cap"), (F.abs(F.col("tokens") - F.col("reached")) <= slack).alias("sums_agree"), optimal.alias("optimal"))
