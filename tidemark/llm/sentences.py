"""Sentence boundaries across languages and scripts.

The boundaries follow the standard character properties for sentence breaks (terminators of every script, closing marks,
the case of what follows), with three additions: abbreviations of the languages suppress a break, quotations and
brackets are matched so that reported speech stays whole, and the layout (blank lines, list items) is read first.
Offsets are code points; each sentence is trimmed of white space as Unicode defines it, and every other character lies
in exactly one sentence.

Defined results: null, empty and blank texts have no sentence; a text that is no language (codes, symbols, blobs) is
one; an opening mark that is never closed within its paragraph counts as an ordinary character; Thai and Lao, which
mark sentences by spaces only, break at a space between two of their letters, but not around numbers and foreign words.
"""

from __future__ import annotations

import unicodedata
from bisect import bisect_left
from collections.abc import Iterable, Iterator

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.abbreviations import ANY, LONGEST, Evidence, Lists, languages, lists, tag
from tidemark.shipping import ship

#: White_Space of Unicode.
SPACE = "\t\n\x0b\x0c\r \x85\xa0\u1680" + "".join(map(chr, range(0x2000, 0x200B))) + "\u2028\u2029\u202f\u205f\u3000"
_SPACES = frozenset(SPACE)
_WS = "[" + SPACE + "]"
_LINE_END = r"(?:\r\n|[\n\x0b\x0c\r\x85\u2028\u2029])"
_BLANK = regex.compile(rf"(?:{_LINE_END}{_WS}*?{_LINE_END}|\u2029){_WS}*")
_LINES = regex.compile(_LINE_END)

_TERMINATOR = regex.compile(r"[\p{SB=STerm}\p{SB=ATerm}…‥]+")
_FULL_STOP = frozenset(".․﹒．")
_DOTS = frozenset(".…‥․")
#: Opening marks with their closing ones; a mark that opens in one language closes in another.
_PAIRS = {"(": ")", "[": "]", "{": "}", "（": "）", "［": "］", "【": "】", "〔": "〕", "「": "」", "『": "』", "《": "》", "〈": "〉", "«": "»", "“": "”", "„": "“", "‟": "”", "‹": "›", "‘": "’", "‚": "‘"}
_QUOTES = frozenset("「『《〈«“„‟‹‘‚\"")
_CLOSERS = frozenset(_PAIRS.values()) | {'"', "'"}
_CONTINUE = frozenset(",;:،؛，；：、、︑")
_DASHES = frozenset("-–—―‒")
_WORD_END = regex.compile(r"[^\s(\[{«“„\"'‘（「『]+$")
_PLAIN_TAIL = regex.compile(r"(?r)(?:[\p{L}\p{M}\-’']*|[\d.,:%]*)")
_MARKS = regex.compile(r"[(\[{（［【〔「『《〈«“„‟‹‚)\]}）］】〕」』》〉»”›\"]")
_SPECIAL = regex.compile(r"<\|[^|<>\s]++\|>")
_SPACED = regex.compile(rf"(?<=[\p{{Thai}}\p{{Lao}}]){_WS}[{SPACE}\u200b]*(?=(?:(?:<\|\w+\|>|[\p{{So}}\p{{Sk}}\p{{Cf}}\ufe0f]+){_WS}+)?[\u201c\"(]?[\p{{Thai}}\p{{Lao}}])")
_FOREIGN = regex.compile(rf"(?<=[\p{{Thai}}\p{{Lao}}]){_WS}+(?=[\u201c\"(]?\p{{Lu}}[^\p{{Thai}}\p{{Lao}}]*[.!?][\u201d\")]*(?:{_WS}|$))")
_BULLET = regex.compile(r"[^\S\r\n]*(?:([-*•‣◦▪●·–])|(\d{1,3})[.)]|(\p{Ll})\)|[(（](\d{1,3})[)）]|(\p{Ll})\.)[^\S\r\n]+(?=\S)")
_WORDS = regex.compile(r"(?<!\S)[\p{P}]*+[\p{L}\p{M}][\p{L}\p{M}'’\-·.]*+[\p{P}]*+(?!\S)|[\p{Han}\p{Hiragana}\p{Katakana}\p{Thai}\p{Lao}\p{Khmer}\p{Myanmar}\p{Hangul}]+")
_LETTER = regex.compile(r"[\p{L}\p{N}]")
_LOWER = regex.compile(r"\p{Ll}")
_UPPER = regex.compile(r"[\p{Lu}\p{Lt}]")
_NO_SPACES = regex.compile(r"[\p{Han}\p{Hiragana}\p{Katakana}\p{Thai}\p{Lao}\p{Khmer}\p{Myanmar}]")
_NAME_LIKE = regex.compile(r"\p{Ll}[\p{L}\p{N}]*(?:_\w|\.\p{L}{2,}(?=[\s/:])|://|\S*@\S+\.)")
#: A time that opens its sentence, behind one word at most ("At 4 a.m. ...").
_NO_WORD = r"(?:[^\p{L}<]|<(?!\|)|<\|[^|<>\s]++\|>)"
_OPENING_TIME = regex.compile(rf"{_NO_WORD}*+(?:\p{{L}}++{_NO_WORD}++)?[ap]\.m", regex.IGNORECASE)
_LETTERS = regex.compile(r"[\p{L}\p{M}]+")
_PLAIN_WORD = regex.compile(r"[\p{L}\p{M}\-’']{2,}|\d[\d.,:]*%?")
_INITIAL, _INITIALS, _ARABIC = regex.compile(r"[\p{Lu}\p{Lt}]\p{M}*"), regex.compile(r"(?:[\p{Lu}\p{Lt}]\.)+[\p{Lu}\p{Lt}]"), regex.compile(r"\p{Arabic}")
_ELISION = regex.compile(r"^(?:[ldjmnst]|qu)[’']")
_FORMAT = regex.compile(r"\p{Cf}+")


def is_language(text: str) -> bool:
    """Whether a fair part of the visible characters belongs to words."""
    missing = 0.3 * sum(map(len, text.split()))
    for m in _WORDS.finditer(text):
        if missing <= 0:
            break
        missing -= len(m[0])
    return missing <= 0


def sentences(text: str | None, lang: str | None = None) -> list[tuple[int, int]]:
    """(start, end) of each sentence, end exclusive, in order. ``lang`` may be null, unknown or wrong."""
    if not text:
        return []
    own = _Languages(text, lang)
    out: list[tuple[int, int]] = []
    if not is_language(text):
        _add(text, 0, len(text), out)
        return out
    at = 0
    for gap in _BLANK.finditer(text):
        _block(text, at, gap.start(), out, own)
        at = gap.end()
    _block(text, at, len(text), out, own)
    return out


def _add(text: str, start: int, end: int, out: list[tuple[int, int]]) -> None:
    while start < end and text[start] in _SPACES:
        start += 1
    while start < end and text[end - 1] in _SPACES:
        end -= 1
    if start < end:
        out.append((start, end))


def _block(text: str, start: int, end: int, out: list[tuple[int, int]], own: _Languages) -> None:
    """A block between blank lines: a list, whose items are sentences, or a paragraph."""
    while start < end and text[start] in _SPACES:
        start += 1
    if start >= end:
        return
    items = _items(text, start, end)
    if items:
        for a, b in zip(items, [*items[1:], end]):
            _add(text, a, b, out)
        return
    for a, b in _paragraph(text, start, end, own):
        _add(text, a, b, out)


def _items(text: str, start: int, end: int) -> list[int]:
    """The starts of the items, if the block is a list: its first line has a marker, each next item the next one."""
    first = _BULLET.match(text, start, end)
    if not first:
        return []
    starts, kind, mark = [start], first.lastindex, first[first.lastindex]
    for line in _LINES.finditer(text, start, end):
        m = _BULLET.match(text, line.end(), end)
        if m and m.lastindex == kind:
            follows = m[kind] == mark if kind == 1 else int(m[kind]) == int(mark) + 1 if kind in (2, 4) else ord(m[kind]) == ord(mark) + 1
            if follows:
                starts.append(line.end())
                mark = m[kind]
    return starts if kind != 5 or len(starts) > 1 else []


def _spans(text: str, start: int, end: int) -> list[tuple[int, int]]:
    """Matched pairs of quotation marks and brackets, by their opening position."""
    stack: list[tuple[int, str]] = []
    waiting: dict[str, int] = {}  # closing marks that would match something, so that no mark searches the stack in vain
    spans = []
    for m in _MARKS.finditer(text, start, end):
        c, i = m[0], m.start()
        if waiting.get(c):
            while True:
                start_, wanted = stack.pop()
                waiting[wanted] -= 1
                if wanted == c:
                    spans.append((start_, i))
                    break
        elif c == '"' or c in _PAIRS:
            wanted = _PAIRS.get(c, '"')
            stack.append((i, wanted))
            waiting[wanted] = waiting.get(wanted, 0) + 1
    return sorted(spans)


def _paragraph(text: str, start: int, end: int, own: _Languages) -> Iterator[tuple[int, int]]:
    spans = _spans(text, start, end)
    opened = dict(spans)
    closing = {b: a for a, b in spans}
    outer: list[tuple[int, int]] = []
    for span in spans:
        if not outer or span[0] > outer[-1][1]:
            outer.append(span)
    within = _Within(outer)
    letters = _Letters(text, end)
    words = _Words(text, start, own)
    cuts = [(m.end(), m) for m in _TERMINATOR.finditer(text, start, end)]
    cuts += [(m.end(), None) for r in (_SPACED, _FOREIGN) for m in r.finditer(text, start, end)]
    cuts.sort(key=lambda c: c[0])
    at = start
    for position, m in cuts:
        if position <= at:
            continue
        if m is None:
            if not within(position, position, at):
                yield at, position
                at = position
            continue
        cut = _cut(text, at, m, end, within, opened, closing, letters, words)
        if cut is not None:
            yield at, cut
            at = cut
    yield at, end


class _Within:
    """Whether a stretch lies inside one of the outermost quotations or brackets that opened since a position."""

    def __init__(self, outer: list[tuple[int, int]]):
        self.starts, self.ends = [a for a, _ in outer], [b for _, b in outer]

    def __call__(self, a: int, e: int, since: int) -> bool:
        k = bisect_left(self.starts, a) - 1
        return k >= 0 and self.starts[k] >= since and e <= self.ends[k]


class _Letters:
    """The next letter or digit behind a position, past symbols and strings of special tokens, found once."""

    def __init__(self, text: str, end: int):
        self.text, self.end = text, end
        self.low, self.found = 0, -1

    def __call__(self, n: int) -> tuple[str, int] | None:
        if not self.low <= n <= self.found:
            self.low, self.found = n, _next_letter(self.text, n, self.end)
        return (self.text[self.found], self.found) if self.found < self.end else None


def _cut(text: str, at: int, m, end: int, within: _Within, opened: dict, closing: dict, letters: _Letters, words: _Words) -> int | None:
    """Where the sentence that began at ``at`` ends, if the terminator ends it."""
    a, b = m.span()
    e, quote, bracket = b, None, None
    while e < end:  # closing marks, also behind a space if they close what this sentence opened
        k = e
        while k < end and text[k] in _SPACES:
            k += 1
        if k < end and k in closing and closing[k] >= at and (k == e or text[k] not in "\"“" or closing[k] >= at):
            if k > e and text[k] in ")]}）":
                break
            if text[closing[k]] in _QUOTES:
                quote = closing[k]
            else:
                bracket = closing[k]
            e = k + 1
        elif k == e and text[k] in _CLOSERS and k not in opened and text[k] not in "'\"“‘":
            e = k + 1
        elif k == e and k not in opened and k not in closing and _TERMINATOR.match(text, k):
            e = _TERMINATOR.match(text, k).end()
        else:
            break
    if e >= end:
        return end
    if within(a, e, at):
        return None  # still within a quotation or brackets
    n = e
    while n < end and text[n] in _SPACES:
        n += 1
    if n >= end:
        return end
    spaced = n > e
    c = text[n]
    if c in _CONTINUE or (c in _DASHES and (letter := letters(n)) is not None and _LOWER.match(letter[0])):
        return None
    mark = text[a:b]
    wide = not (mark[-1] in _DOTS or mark[-1] in "!?") or ord(mark[0]) > 0x2E80
    dotted = all(x in _DOTS for x in mark)
    letter = letters(n)
    lower = letter is not None and _LOWER.match(letter[0]) is not None and not _NAME_LIKE.match(text, letter[1])
    if quote is not None:
        return _after_quote(words.first(at), e, n, spaced, letter, lower, quote)
    if dotted:
        if lower:
            return None
        if mark == "." and bracket is None:
            return e if _stop_ends(text, at, a, e, n, end, spaced, letter, words) else None
        if not spaced and e == b and len(mark) > 1 and letter is not None and not _NO_SPACES.match(letter[0]) and mark[0] == ".":
            return e if _UPPER.match(letter[0]) else None
        return e
    if spaced or wide:
        return e
    # no space behind ! or ?: a sentence begins only with a capital letter, an opening mark or an uncased letter
    if letter is None or letter[1] == n:
        return e if _UPPER.match(c) or (letter is not None and not _LOWER.match(c) and not c.isdigit()) else None
    return e if n in opened else None


def _next_letter(text: str, n: int, end: int) -> int:
    while n < end:
        special = _SPECIAL.match(text, n, end)
        if special:
            n = special.end()
            continue
        if _LETTER.match(text, n):
            return n
        n += 1
    return end


def _after_quote(first: int, e: int, n: int, spaced: bool, letter, lower: bool, quote: int) -> int | None:
    """Behind a closed quotation: the words that report it belong to its sentence."""
    if lower:
        return None
    if letter is None:
        return e
    c = letter[0]
    cased = _UPPER.match(c) is not None
    begins = first == quote
    if not spaced and letter[1] == n:
        # attached words report the quotation, unless it came after its announcement
        return None if begins or not _NO_SPACES.match(c) else e
    if begins and not cased and not c.isdigit() and letter[1] == n:
        return None
    return e


class _Words:
    """What stands before a full stop, and the lists of the text's languages."""

    def __init__(self, text: str, start: int, own: _Languages):
        self.text, self.own = text, own
        self.at, self.letter = -1, -1

    def before(self, at: int, a: int) -> str | None:
        """The word that ends at ``a``, not before ``at``, without format characters; None where it is longer than any
        word of the lists."""
        low = max(at, a - LONGEST - 8)
        found = _WORD_END.search(self.text[low:a])
        if not found:
            return ""
        if found.start() == 0 and low > at and _WORD_END.fullmatch(self.text[low - 1]):
            return None
        word = found[0]
        return word if word.isascii() else unicodedata.normalize("NFC", _FORMAT.sub("", word))

    def plain(self, at: int, a: int) -> bool:
        """Whether the word that ends at ``a`` is one of letters, or a number."""
        begin = _PLAIN_TAIL.match(self.text, at, a).start()
        return begin < a and (begin == at or not _WORD_END.fullmatch(self.text[begin - 1])) and _PLAIN_WORD.fullmatch(self.text, begin, a) is not None

    def first(self, at: int) -> int:
        """The first visible character from ``at`` on."""
        if at != self.at:
            n = at
            while n < len(self.text) and (self.text[n] in _SPACES or self.text[n] == "\u200b"):
                n += 1
            self.at, self.letter = at, n
        return self.letter


class _Languages:
    """The lists for a place in a text: of the languages its sentence shows so far and of the text's own.

    A sentence that shows none counts as of the text's languages and the declared one.
    """

    def __init__(self, text: str, declared: str | None):
        self.text, self.declared = text, declared
        self.whole: frozenset[str] | None = None
        self.at, self.upto, self.evidence = -1, -1, Evidence()

    def __call__(self, at: int, a: int) -> Lists:
        if self.whole is None:
            self.whole = languages(self.text, self.declared)
        if at != self.at:
            self.at, self.upto, self.evidence = at, at, Evidence()
        self.evidence.add(self.text, self.upto, a)
        self.upto = max(self.upto, a)
        shown = self.evidence.shown() or {tag(self.declared)} - {None}
        return lists(self.whole | shown)


def _stop_ends(text: str, at: int, a: int, e: int, n: int, end: int, spaced: bool, letter, words: _Words) -> bool:
    """Whether a single full stop ends its sentence; what follows is no lower-case word."""
    word = words.before(at, a)
    if letter is None:
        return spaced
    c, first = letter
    bare = word.casefold() if word else ""
    if "'" in bare or "’" in bare:
        bare = _ELISION.sub("", bare)
    capital = bool(word) and word[0].isupper()
    is_open = bare in ANY.open and Lists.has(words.own(at, a).open, bare, capital)
    if not spaced:
        # "Treffer.Die": a missing space, but not in names, numbers, initials
        long = word is None or len(word) > 1
        if text[n] in _PAIRS and first == n + 1 and _UPPER.match(c):
            return long and not is_open
        if first != n or word == "" or not _UPPER.match(c):
            return word != "" and first == n and not c.isdigit() and not _LOWER.match(c) and long and not _UPPER.match(c)
        tail = text[n + 1 : n + 2]
        plain = words.plain(at, a) if word is None else _PLAIN_WORD.fullmatch(word) is not None
        return plain and (not tail or tail in _SPACES or tail in ".-’'" or tail.isalpha()) and not is_open
    if word is None:
        return True
    if is_open:
        return False
    if c.isdigit() and bare in ANY.number and Lists.has(words.own(at, a).number, bare, capital):
        return False
    if _UPPER.match(c):
        if len(word) < 4 and _INITIAL.fullmatch(word):  # an initial, unless a word follows that only begins sentences ("Plan B. Then ...")
            following = _next_word(text, first, end)
            return following in ANY.starts and following in words.own(at, a).starts
        if len(word) == 3 and _INITIALS.fullmatch(word):
            return False  # initials without space
        if bare in ("a.m", "p.m") and _OPENING_TIME.fullmatch(text, at, a):
            return False  # the sentence has no more than its time yet
    if word.isdigit() and (following := _next_word(text, first, end)) in ANY.months and following in words.own(at, a).months:
        return False
    if len(word) == 1 and _ARABIC.fullmatch(word):
        return False
    return True


def _next_word(text: str, n: int, end: int) -> str:
    m = _LETTERS.match(text, n, end)
    return unicodedata.normalize("NFC", m[0]).casefold() if m else ""


#: A batch of results is sent on when it has so many sentences.
BATCH_ROWS = 50_000


def split_texts(df: DataFrame, key: str = "doc_id", text: str = "text", lang: str | None = "lang") -> DataFrame:
    """(key, sent_start, sent_end): one row per sentence of each text. ``lang`` names the column of languages, if there is one."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, starts, ends = [], [], []

            def made() -> pa.RecordBatch:
                keys = batch.column(0).take(pa.array(rows, pa.int32()))
                return pa.RecordBatch.from_arrays([keys, pa.array(starts, pa.int32()), pa.array(ends, pa.int32())], names=[key, "sent_start", "sent_end"])

            for row, (t, own) in enumerate(zip(batch.column(1).to_pylist(), batch.column(2).to_pylist())):
                for a, b in sentences(t, own):
                    rows.append(row)
                    starts.append(a)
                    ends.append(b)
                if len(rows) >= BATCH_ROWS:
                    yield made()
                    rows, starts, ends = [], [], []
            yield made()

    ship(df.sparkSession)
    kind = df.schema[key].dataType.simpleString()
    declared = df[lang].cast("string") if lang is not None and lang in df.columns else F.lit(None).cast("string")
    return df.select(df[key].alias("_k"), df[text].alias("_t"), declared.alias("_l")).mapInArrow(run, f"`{key}` {kind}, sent_start int, sent_end int")
