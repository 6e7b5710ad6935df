"""Ids by prefixes against the plain merging of pairs and against the public library."""

import json
import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tidemark.llm.bpe import TOKENIZERS, PrefixEncoder, count_tokens, encode_texts, encoder


@pytest.fixture(scope="session")
def own():
    return encoder()


@pytest.fixture(scope="session")
def library():
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(f"{TOKENIZERS}/byte_bpe_50k.json")
    t.encode_special_tokens = True
    return lambda text: t.encode(text, add_special_tokens=False).ids


def _merge(raw, vocabulary, merges):
    """Brute force: the oldest merge first, leftmost of equals."""
    parts = [bytes([b]) for b in raw]
    rank = {m: i for i, m in enumerate(merges)}
    while True:
        found = min(((rank.get((a, b), 1 << 60), i) for i, (a, b) in enumerate(zip(parts, parts[1:]))), default=(1 << 60, 0))
        if found[0] == 1 << 60:
            return [vocabulary[p] for p in parts]
        i = found[1]
        parts[i : i + 2] = [parts[i] + parts[i + 1]]


@pytest.mark.parametrize("seed", range(5))
def test_any_vocabulary(seed):
    rnd = random.Random(seed)
    vocabulary, merges = {bytes([b]): b for b in range(256)}, []
    pool = [b"a", b"b", b"c"]
    while len(merges) < 25:
        a, b = rnd.choice(pool), rnd.choice(pool)
        if a + b in vocabulary or len(a + b) > 12:
            continue
        if _merge(a + b, {**vocabulary, a + b: -1}, [*merges, (a, b)]) == [-1]:  # as in any real vocabulary
            vocabulary[a + b] = 256 + len(merges)
            merges.append((a, b))
            pool.append(a + b)
    e = PrefixEncoder(vocabulary, merges)
    for _ in range(300):
        text = "".join(rnd.choice("abc") for _ in range(rnd.randint(1, 40)))
        assert e.piece(text) == _merge(text.encode(), vocabulary, merges)


@settings(max_examples=400, deadline=None)
@given(st.text(max_size=60) | st.text("ab 'stné中0🔎\n\t", max_size=80))
def test_any_text(own, library, text):
    text = text.encode("utf-8", "ignore").decode()
    assert own.encode(text) == library(text)


@pytest.mark.parametrize("text", ["a" * 20_000, "ab" * 9_000, " " * 9_000, "=" * 9_000, "<|endoftext|>", " <|endoftext|>x", "don't they'LL", "\r\n \n", "é", "👩‍🔧"])
def test_hard_texts(own, library, text):
    assert own.encode(text) == library(text)


def test_round_trip(own):
    names = {i: t for t, i in json.load(open(f"{TOKENIZERS}/byte_bpe_50k.json", encoding="utf-8"))["model"]["vocab"].items()}
    from tidemark.llm.bpe import _byte_letters

    letters = _byte_letters()
    text = "Прямо, 中文 and <|endoftext|> " * 50
    assert bytes(letters[c] for i in own.encode(text) for c in names[i]).decode() == text


def test_rows_of_a_table(spark, own):
    rows = [(1, None, "x"), (2, "", None), (3, "  ", None), (4, "the cat", "y"), (4, "the cat", "y"), (5, "\u0000a", None)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, ids string")
    got = sorted((r.doc_id, list(r.ids)) for r in encode_texts(df).collect())
    assert got == sorted((k, own.encode(t)) for k, t, _ in rows) and got[0] == (1, []) and got[1] == (2, [])
    assert sorted((r.doc_id, r.n_tokens) for r in count_tokens(df, ["doc_id"]).collect()) == sorted((k, len(own.encode(t))) for k, t, _ in rows)
    assert encode_texts(df.limit(0)).collect() == []


def test_vocabularies_cut_otherwise_are_refused(tmp_path):
    with open(f"{TOKENIZERS}/byte_bpe_50k.json", encoding="utf-8") as file:
        whole = json.load(file)
    for change in ({"normalizer": {"type": "NFC"}}, {"pre_tokenizer": {"type": "Whitespace"}}, {"pre_tokenizer": None}, {"model": {**whole["model"], "byte_fallback": True}}):
        (tmp_path / "other.json").write_text(json.dumps({**whole, **change}), encoding="utf-8")
        with pytest.raises(ValueError):
            PrefixEncoder.from_json(str(tmp_path / "other.json"))


def test_long_batches_are_sent_in_parts(spark, own, monkeypatch):
    monkeypatch.setattr("tidemark.llm.bpe.BATCH_IDS", 5)
    texts = [None, "a b c d e f g", "", "one two", "x" * 40, "y"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").coalesce(1)
    assert sorted((r.doc_id, list(r.ids)) for r in encode_texts(df).collect()) == [(k, own.encode(t)) for k, t in enumerate(texts)]
