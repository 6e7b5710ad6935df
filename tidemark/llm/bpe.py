"""Exact byte-pair ids by dynamic programming over prefixes.

The ids of a piece of text are usually found by merging pairs in rank order.  Here they follow from the prefixes: each
prefix of a piece has exactly one last token in its encoding, and a token ending at a position is that token if and
only if it can stand behind the last token of the prefix before it, that is, if the two tokens side by side encode to
themselves.  An automaton over the vocabulary reports the tokens that are suffixes of each prefix, a table keeps the one
that passes the pair test, and the ids are read by following the table back from the end.  The time is linear in the
length of the text, whatever the text, so one endless word costs no more than many short ones.

Whether a pair is compatible is decided by undoing merges from the boundary outwards: the pair breaks if a merge across
the boundary would have come before one of the merges that made the two tokens.

Defined results: null and empty texts have the empty list; strings of special tokens in a text are ordinary text; a
lone surrogate, which has no UTF-8, is encoded as U+FFFD.
"""

from __future__ import annotations

import json
import os
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark import SparkFiles
from pyspark.sql import DataFrame, SparkSession

from tidemark.shipping import ship

#: The pre-tokenisation of the byte-level vocabulary (fixed values of that public tokenizer).
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
TOKENIZERS = os.environ.get("TIDEMARK_TOKENIZERS", "/opt/tokenizers")
#: Pieces whose ids a worker remembers; only pieces up to the length given are remembered.
CACHE_PIECES, CACHE_LENGTH = 200_000, 64
#: Answers of the pair test a worker remembers.
CACHE_PAIRS = 2_000_000


def _byte_letters() -> dict[str, int]:
    """The letters that stand for the 256 bytes in vocabulary files: printable Latin-1 as is, the rest from U+0100 on."""
    plain = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(rest)}


class PrefixEncoder:
    """A vocabulary whose merges are numbered in the order of their ids, and whose tokens are their own encodings.

    Vocabularies made by counting pairs have both properties.
    """

    def __init__(self, vocabulary: dict[bytes, int], merges: Iterable[tuple[bytes, bytes]]):
        import ahocorasick
        import regex

        self.pieces = regex.compile(PATTERN).findall
        self.size = {i: len(t) for t, i in vocabulary.items()}
        self.pair: dict[tuple[int, int], int] = {}
        self.parts: dict[int, tuple[int, int]] = {i: (i, i) for t, i in vocabulary.items() if len(t) == 1}
        for left, right in merges:
            made = vocabulary[left + right]
            self.pair[vocabulary[left], vocabulary[right]] = made
            self.parts.setdefault(made, (vocabulary[left], vocabulary[right]))
        self.order = {i: i for i in self.parts}
        self.automaton = ahocorasick.Automaton()
        for token, i in vocabulary.items():
            if i in self.parts:
                self.automaton.add_word(token.decode("latin-1"), (len(token), i))
        self.automaton.make_automaton()
        self.known: dict[str, list[int]] = {}
        self.tested: dict[tuple[int, int], bool] = {}

    @classmethod
    def from_json(cls, path: str) -> PrefixEncoder:
        letters = _byte_letters()
        with open(path, encoding="utf-8") as file:
            whole = json.load(file)
        model, split = whole["model"], whole.get("pre_tokenizer") or {}
        known = split.get("type") == "ByteLevel" and split.get("use_regex", True) and not split.get("add_prefix_space")
        if model.get("type", "BPE") != "BPE" or not known or whole.get("normalizer") or model.get("byte_fallback") or model.get("ignore_merges"):
            raise ValueError("a vocabulary with another way of cutting text into pieces")
        raw = lambda text: bytes(letters[c] for c in text)
        vocabulary = {raw(t): i for t, i in model["vocab"].items() if all(c in letters for c in t)}
        merges = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        return cls(vocabulary, [(raw(a), raw(b)) for a, b in merges])

    def compatible(self, left: int, right: int) -> bool:
        """Whether the two tokens side by side are their own encoding."""
        found = self.tested.get((left, right))
        if found is None:
            if len(self.tested) >= CACHE_PAIRS:
                self.tested.clear()
            found = self.tested[left, right] = self._undo(left, right)
        return found

    def _undo(self, left: int, right: int) -> bool:
        """Undo the younger of the two merges next to the boundary, again and again; look for a merge across it.

        A merge across counts if it is older than the merge just undone: then it would have happened first. Of equal
        merges the one further left happens first.
        """
        pair, parts = self.pair, self.parts
        bound = 1 << 60
        while True:
            across = pair.get((left, right))
            if across is not None and across < bound:
                return False
            if left > right:
                if (inner := parts[left][1]) != left:
                    bound, left = left, inner
                elif (inner := parts[right][0]) != right:
                    bound, right = right + 1, inner
                else:
                    return True
            elif (inner := parts[right][0]) != right:
                bound, right = right + 1, inner
            elif (inner := parts[left][1]) != left:
                bound, left = left, inner
            else:
                return True

    def piece(self, text: str) -> list[int]:
        """The ids of one piece."""
        raw = text.encode("utf-8", "replace" if text.isascii() else "surrogatepass")
        try:
            raw.decode("utf-8")
        except UnicodeDecodeError:
            raw = text.encode("utf-16", "surrogatepass").decode("utf-16", "replace").encode("utf-8")
        n = len(raw)
        last = [0] * (n + 1)  # the last token of each prefix
        reached = bytearray(n + 1)
        reached[0] = 1
        size, compatible = self.size, self.compatible
        for end, (length, token) in self.automaton.iter(raw.decode("latin-1")):
            end += 1
            if reached[end]:
                continue
            start = end - length
            if reached[start] and (start == 0 or compatible(last[start], token)):
                last[end], reached[end] = token, 1
        if not reached[n]:
            raise ValueError("the vocabulary has a token that is not its own encoding")
        ids = []
        while n:
            ids.append(last[n])
            n -= size[last[n]]
        ids.reverse()
        return ids

    def encode(self, text: str | None) -> list[int]:
        if not text:
            return []
        known, out = self.known, []
        for piece in self.pieces(text):
            ids = known.get(piece)
            if ids is None:
                ids = self.piece(piece)
                if len(piece) <= CACHE_LENGTH:
                    if len(known) >= CACHE_PIECES:
                        known.clear()
                    known[piece] = ids
            out += ids
        return out


_encoders: dict[str, PrefixEncoder] = {}


def encoder(name: str = "byte_bpe_50k", folder: str = TOKENIZERS) -> PrefixEncoder:
    """The worker's encoder: built once in a Python worker and kept for its later tasks."""
    path = os.path.join(folder, f"{name}.json")
    if path not in _encoders:
        _encoders[path] = PrefixEncoder.from_json(path if os.path.exists(path) else SparkFiles.get(f"{name}.json"))
    return _encoders[path]


def provide(spark: SparkSession, name: str, folder: str) -> None:
    """Send the package and the vocabulary to the executors, which need not have its folder."""
    ship(spark)
    path, sent = os.path.join(folder, f"{name}.json"), getattr(spark.sparkContext, "_tidemark_vocabularies", set())
    if path not in sent:
        spark.sparkContext.addFile(path)
        spark.sparkContext._tidemark_vocabularies = sent | {path}


#: A batch of results is sent on when it has so many ids.
BATCH_IDS = 1 << 20


def encode_texts(df: DataFrame, key: str = "doc_id", text: str = "text", name: str = "byte_bpe_50k", folder: str = TOKENIZERS) -> DataFrame:
    """(key, ids): the ids of each text, one row per row of ``df``."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = encoder(name, folder)
        for batch in batches:
            ids, size, first = [], 0, 0
            for t in batch.column(1).to_pylist():
                ids.append(own.encode(t))
                size += len(ids[-1])
                if size >= BATCH_IDS:
                    yield pa.RecordBatch.from_arrays([batch.column(0).slice(first, len(ids)), pa.array(ids, pa.list_(pa.int32()))], names=[key, "ids"])
                    ids, size, first = [], 0, first + len(ids)
            yield pa.RecordBatch.from_arrays([batch.column(0).slice(first), pa.array(ids, pa.list_(pa.int32()))], names=[key, "ids"])

    provide(df.sparkSession, name, folder)
    kind = df.schema[key].dataType.simpleString()
    return df.select(df[key].alias("_k"), df[text].alias("_t")).mapInArrow(run, f"`{key}` {kind}, ids array<int>")


def count_tokens(df: DataFrame, keep: list[str], text: str = "text", name: str = "byte_bpe_50k", folder: str = TOKENIZERS) -> DataFrame:
    """``keep`` and ``n_tokens`` of each row; the ids do not leave the worker."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = encoder(name, folder)
        for batch in batches:
            n = [len(own.encode(t)) for t in batch.column(batch.num_columns - 1).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(n, pa.int64())], names=[*keep, "n_tokens"])

    provide(df.sparkSession, name, folder)
    fields = ", ".join(f"`{c}` {df.schema[c].dataType.simpleString()}" for c in keep)
    return df.select(*[df[c] for c in keep], df[text].alias("_text")).mapInArrow(run, f"{fields}, n_tokens bigint")
