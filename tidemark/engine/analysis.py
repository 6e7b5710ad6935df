"""Text analysis: the same chain for documents (at projection) and queries.

* ``plain``: lower case, runs of letters and digits; one JVM expression, the same in any SQL engine.
* ``default``: also folds diacritics and compatibility forms; runs of Han are cut into pairs of neighbours (a lone
  character stays), as there is no dictionary.
* ``english``: strips the possessive, drops stop words and stems (Porter 1980) before folding.

Chains run in Arrow batches when a document is projected; queries analyse their few words in the driver.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Callable, Iterable

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark.engine.errors import InvalidRequest
from tidemark.engine.values import fingerprint, language_tag
from tidemark.shipping import ship

PLAIN_PATTERN = r"[\p{L}\p{N}]+"
#: The stop words of English (fixed values).
STOP_WORDS = frozenset(
    "a an and are as at be but by for if in into is it no not of on or such that the their then there these they this to was will with".split()
)
_WORD = re.compile(r"[^\W_]+(?:[’'][^\W\d_]+)*", re.UNICODE)
_HAN = re.compile(r"[㐀-䶿一-鿿豈-﫿]+|[^㐀-䶿一-鿿豈-﫿]+")


def fold(text: str) -> str:
    """Case, compatibility forms and diacritics away."""
    decomposed = unicodedata.normalize("NFKD", text.casefold())
    return unicodedata.normalize("NFKC", "".join(c for c in decomposed if not unicodedata.combining(c)))


class _Porter:
    """The stemmer of M. F. Porter, An algorithm for suffix stripping (1980)."""

    @staticmethod
    def _shape(word: str) -> str:
        """Each letter as c or v; y is a vowel behind a consonant."""
        shape = ""
        for i, c in enumerate(word):
            shape += "v" if c in "aeiou" or (c == "y" and i > 0 and shape[-1] == "c") else "c"
        return shape

    @classmethod
    def measure(cls, stem: str) -> int:
        return len(re.findall("v+c+", cls._shape(stem)))

    @classmethod
    def _vowel(cls, stem: str) -> bool:
        return "v" in cls._shape(stem)

    @classmethod
    def _double(cls, word: str) -> bool:
        return len(word) > 1 and word[-1] == word[-2] and cls._shape(word)[-1] == "c"

    @classmethod
    def _short(cls, word: str) -> bool:
        return cls._shape(word)[-3:] == "cvc" and word[-1] not in "wxy"

    #: Steps 2 to 4: suffix and replacement, tried from the longest suffix on (fixed values of the algorithm).
    STEP2 = dict(
        ational="ate", tional="tion", enci="ence", anci="ance", izer="ize", abli="able", alli="al", entli="ent", eli="e", ousli="ous", ization="ize",
        ation="ate", ator="ate", alism="al", iveness="ive", fulness="ful", ousness="ous", aliti="al", iviti="ive", biliti="ble",
    )
    STEP3 = dict(icate="ic", ative="", alize="al", iciti="ic", ical="ic", ful="", ness="")
    STEP4 = "al ance ence er ic able ible ant ement ment ent ion ou ism ate iti ous ive ize".split()

    @classmethod
    def stem(cls, word: str) -> str:
        if len(word) < 3 or not word.isascii() or not word.isalpha():
            return word
        w = cls._first(word)
        for table in (cls.STEP2, cls.STEP3):
            suffix = max((s for s in table if w.endswith(s)), key=len, default=None)
            if suffix and cls.measure(w[: -len(suffix)]) > 0:
                w = w[: -len(suffix)] + table[suffix]
        suffix = max((s for s in cls.STEP4 if w.endswith(s)), key=len, default=None)
        if suffix:
            base = w[: -len(suffix)]
            if cls.measure(base) > 1 and (suffix != "ion" or base[-1:] in ("s", "t")):
                w = base
        if w.endswith("e") and (cls.measure(w[:-1]) > 1 or (cls.measure(w[:-1]) == 1 and not cls._short(w[:-1]))):
            w = w[:-1]
        if w.endswith("ll") and cls.measure(w) > 1:
            w = w[:-1]
        return w

    @classmethod
    def _first(cls, w: str) -> str:
        for ending, instead in (("sses", "ss"), ("ies", "i"), ("ss", "ss"), ("s", "")):
            if w.endswith(ending):
                w = w[: len(w) - len(ending)] + instead
                break
        if w.endswith("eed"):
            w = w[:-1] if cls.measure(w[:-3]) > 0 else w
        else:
            ending = next((x for x in ("ed", "ing") if w.endswith(x)), None)
            if ending and cls._vowel(w[: -len(ending)]):
                w = w[: -len(ending)]
                if w.endswith(("at", "bl", "iz")):
                    w += "e"
                elif cls._double(w) and w[-1] not in "lsz":
                    w = w[:-1]
                elif cls.measure(w) == 1 and cls._short(w):
                    w += "e"
        if w.endswith("y") and cls._vowel(w[:-1]):
            w = w[:-1] + "i"
        return w


def words(text: str) -> list[tuple[str, int, int]]:
    """(word, start, end): runs of letters and digits, an apostrophe between letters included, Han in pairs."""
    out = []
    for m in _WORD.finditer(text):
        for part in _HAN.finditer(m[0]):
            a, piece = m.start() + part.start(), part[0]
            if "㐀" <= piece[0] <= "﫿" and not piece[0].isascii() and _HAN.match(piece) and unicodedata.name(piece[0], "").startswith("CJK"):
                if len(piece) == 1:
                    out.append((piece, a, a + 1))
                out += [(piece[i : i + 2], a + i, a + i + 2) for i in range(len(piece) - 1)]
            else:
                out.append((piece, a, a + len(piece)))
    return out


def _default(word: str) -> str | None:
    return fold(word) or None


def _english(word: str) -> str | None:
    word = re.sub(r"['’]s?$", "", word.lower())
    return None if word in STOP_WORDS or not word else fold(_Porter.stem(word))


CHAINS: dict[str, Callable[[str], str | None]] = {"default": _default, "english": _english}


def chains_fingerprint() -> str:
    """Of everything the chains' terms depend on, so that tokens made by other chains are told apart."""
    tables = [PLAIN_PATTERN, _WORD.pattern, _HAN.pattern, sorted(STOP_WORDS), _Porter.STEP2, _Porter.STEP3, _Porter.STEP4]
    return fingerprint([*tables, [analyse("The Élan of running foxes' 中文字 dogs", chain) for chain in ("plain", *CHAINS)]])


def chain_of(language: str | None, analysis: str = "multilingual") -> str:
    """English for en and en-*, the default chain for any other language or none."""
    if analysis == "plain":
        return "plain"
    if language is None:
        return "default"
    return "english" if language_tag(language).split("-")[0] == "en" else "default"


def analyse(text: str, chain: str) -> list[str]:
    """The terms of a text."""
    if chain == "plain":
        import regex

        return regex.findall(PLAIN_PATTERN, text.lower())
    step = CHAINS[chain]
    return [t for w, _, _ in words(text) if (t := step(w))]


def token_column(text: Column, chain: str) -> Column:
    """The terms of a column; null texts have none."""
    if chain == "plain":
        return F.regexp_extract_all(F.lower(text), F.lit(PLAIN_PATTERN), F.lit(0))
    if chain not in CHAINS:
        raise InvalidRequest("unknown analysis")

    @F.pandas_udf("array<string>")
    def run(texts: pd.Series) -> pd.Series:
        return pd.Series([None if t is None else analyse(t, chain) for t in texts], dtype=object)

    return run(text)


def edits(a: str, b: str, most: int) -> int:
    """Edit distance with transpositions of neighbours as one edit; ``most + 1`` where it is larger than ``most``."""
    if abs(len(a) - len(b)) > most:
        return most + 1
    before: list[int] = []
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        now = [i]
        for j, y in enumerate(b, 1):
            cost = min(row[j] + 1, now[j - 1] + 1, row[j - 1] + (x != y))
            if i > 1 and j > 1 and x == b[j - 2] and a[i - 2] == y:
                cost = min(cost, before[j - 2] + 1)
            now.append(cost)
        if min(now) > most:
            return most + 1
        before, row = row, now
    return min(row[-1], most + 1)


def fuzzy_terms(vocabulary, terms: Iterable[str], most: int) -> dict[str, list[str]]:
    """For each term all terms of the vocabulary (a DataFrame with ``term`` and ``df``) within the distance, nearest first.

    The distance runs in Arrow batches over the vocabulary, whose length ranges are filtered first; only the near terms
    return, and all of them.
    """
    terms = sorted(set(terms))
    if not terms or most == 0:
        return {t: [t] for t in terms}
    ship(vocabulary.sparkSession)
    spans = [F.length("term").between(len(t) - most, len(t) + most) for t in terms]
    near = spans[0]
    for s in spans[1:]:
        near = near | s

    @F.pandas_udf("array<int>")
    def distances(candidates: pd.Series) -> pd.Series:
        return pd.Series([[edits(t, c, most) for t in terms] for c in candidates], dtype=object)

    rows = vocabulary.filter(near).select("term", "df", F.posexplode(distances("term")).alias("k", "d")).filter(F.col("d") <= most)
    out: dict[str, list[str]] = {t: [] for t in terms}
    for r in sorted(rows.collect(), key=lambda r: (r.k, r.d, -r.df, r.term)):
        out[terms[r.k]].append(r.term)
    return out
