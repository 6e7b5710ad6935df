"""Mixtures against exact arithmetic, and the classifier on held-out rows."""

import random
from dataclasses import replace
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm.bpe import encoder
from tidemark.llm.mixing import Sources, Targets, fit_membership, membership, mix, soft_member, verify

WORDS = {"ships": "harbour vessel tide anchor cargo pier".split(), "law": "court verdict appeal clause witness judge".split(), "code": "shard cursor index replica token query".split()}


def _docs(spark, n, seed=0, unlabelled=0.2, sources=tuple(WORDS)):
    rnd = random.Random(seed)
    rows = []
    for i in range(n):
        s = rnd.choice(sources)
        text = " ".join(rnd.choice(WORDS[s]) for _ in range(rnd.randint(5, 40)))
        rows.append((i, None if rnd.random() < unlabelled else s, text, s))
    return spark.createDataFrame(rows, "key bigint, source string, text string, truth string")


def _targets(spark, rows):
    return spark.createDataFrame(rows, "source string, target_weight double, max_repeats int")


def test_held_out_accuracy(spark):
    names = sorted(WORDS)
    model = fit_membership(_docs(spark, 300, 1, 0).select("key", "source", "text"), names)
    own = encoder()
    held = _docs(spark, 200, 2, 1.0).collect()
    right = sum(names[int(np.argmax(soft_member(model, own.encode(r.text))))] == r.truth for r in held)
    assert right >= 190


def _exact(docs, targets):
    own = encoder()
    size = {s: 0 for s, _, _ in targets}
    for r in docs.collect():
        if r.source in size:
            size[r.source] += len(own.encode(r.text))
    total, weights = sum(size.values()), sum(Fraction(w) for _, w, _ in targets if w and w > 0) or 1
    return sorted(s for s, w, m in targets if m is not None and size[s] * m < total * Fraction(w if w and w > 0 else 0) / weights)


@pytest.mark.parametrize("soft", [False, True])
def test_unreachable_sources(spark, tmp_path, soft):
    docs = _docs(spark, 300)
    targets = [("ships", 10.0, 1), ("law", 1.0, 3), ("code", 0.5, 2), ("nobody", 2.0, 9), ("zero", 0.0, 1)]
    m = mix(docs.select("key", "source", "text"), _targets(spark, targets), str(tmp_path), soft)
    if not soft:
        assert sorted(m.unreachable()) == _exact(docs, targets) == ["nobody", "ships"]
    reached = dict(zip(m.targets.names, m.reached))
    aim = dict(zip(m.targets.names, m.aim))
    assert reached["law"] == pytest.approx(aim["law"], rel=1e-3) and reached["code"] == pytest.approx(aim["code"], rel=1e-3)
    assert reached["nobody"] == pytest.approx(0, abs=m.total * 0.02 if soft else 0)
    rates = {r.key: r for r in m.rates().collect()}
    for r in docs.collect():
        if r.source is not None:
            assert 0 <= rates[r.key].rate <= dict((s, c) for s, _, c in targets)[r.source] + 1e-9
            assert abs(rates[r.key].copies - rates[r.key].rate) < 1


def test_the_edge_is_exact(spark, tmp_path):
    # two sources of equal texts and weights: each reaches its target with one use, and not with none
    docs = spark.createDataFrame([(1, "a", "same text"), (2, "b", "same text")], "key bigint, source string, text string")
    assert mix(docs, _targets(spark, [("a", 1.0, 1), ("b", 1.0, 1)]), f"{tmp_path}/1").unreachable() == []
    assert mix(docs, _targets(spark, [("a", 1.0, 0), ("b", 1.0, 1)]), f"{tmp_path}/2").unreachable() == ["a"]
    assert mix(docs, _targets(spark, [("a", 1.0, None), ("b", None, 1)]), f"{tmp_path}/3").unreachable() == []


def test_empty_tables_and_texts(spark, tmp_path):
    docs = spark.createDataFrame([(1, "a", None), (2, "a", ""), (3, None, None), (4, "b", "x" * 50_000)], "key bigint, source string, text string")
    assert mix(docs.limit(0), _targets(spark, [("a", 1.0, 1)]), f"{tmp_path}/1").unreachable() == []
    assert mix(docs, _targets(spark, []), f"{tmp_path}/2").unreachable() == []
    assert mix(docs, _targets(spark, [("a", 1.0, 5), ("b", 1.0, 1)]), f"{tmp_path}/3", True).unreachable() == ["a"]


def test_membership_is_certain_for_labels(spark):
    names = sorted(WORDS)
    docs = _docs(spark, 50, 3)
    model = fit_membership(docs.filter("source is not null").select("key", "source", "text"), names)
    rows = membership(docs.select("key", "source", "text"), names, model).join(docs.select("key", "source"), "key").collect()
    assert len(rows) == 50
    for r in rows:
        assert (r.source_no is None) == (r.source is None) and (r.member is None) == (r.source is not None)
    assert Targets.of(_targets(spark, [("a", 1.0, 1), ("b", 3.0, 2)])).shares() == [Fraction(1, 4), Fraction(3, 4)]
    assert docs.filter(F.col("source").isNull()).count() > 0


def test_sources_come_from_the_fitted_rates(spark, tmp_path, monkeypatch):
    """Without its steps the descent names other sources; without convergence it names none."""
    docs = _docs(spark, 200, 4, 0.1).select("key", "source", "text")
    targets = _targets(spark, [("ships", 20.0, 2), ("law", 1.0, 3), ("code", 1.0, 2)])
    sources = Sources.of(docs, targets, str(tmp_path))
    fitted = sources.fit(False)
    assert fitted.unreachable() == ["ships"] and fitted.converged and len(fitted.descent.history) <= 3
    fitted.descent = replace(fitted.descent, history=[], rate=np.zeros(3), reached=np.zeros(3))
    assert fitted.unreachable() == []
    sources.root = f"{tmp_path}/again"
    hasty = sources.fit(True, iterations=1)
    assert not hasty.converged
    with pytest.raises(RuntimeError):
        hasty.unreachable()


@pytest.mark.parametrize("soft", [False, True])
def test_a_mixture_is_verified_from_its_rates(spark, tmp_path, soft):
    targets = _targets(spark, [("ships", 10.0, 1), ("law", 1.0, 3), ("code", 0.5, 2), ("nobody", 2.0, 9), ("zero", 0.0, 1)])
    m = mix(_docs(spark, 200, 6).select("key", "source", "text"), targets, str(tmp_path), soft)
    assert [(r.within_cap, r.sums_agree, r.optimal) for r in verify(m).collect()] == [(True, True, True)] * 5
    m.descent.history[-1] = m.descent.history[-1] * 0.5  # other rates than those fitted
    assert not all(r.sums_agree and r.optimal for r in verify(m).collect())


def test_a_classifier_has_a_bound(spark, monkeypatch):
    monkeypatch.setattr("tidemark.llm.mixing.MODEL_CELLS", 10)
    with pytest.raises(ValueError):
        fit_membership(_docs(spark, 20).filter("source is not null").select("key", "source", "text"), sorted(WORDS))
