"""Abbreviations, months and function words by language, and which languages a text is in.

The values follow published sources: the sentence-break suppressions of the Unicode locale data and the abbreviation
lists of the languages' own style guides.  They are fixed values; an entry that begins with a capital stands for
capitalised words only, any other one for both forms.
"""

from __future__ import annotations

import unicodedata
from collections import Counter
from functools import lru_cache

import regex

#: Abbreviations nothing ends with, as they need what follows: titles, "that is", "for example" and the like.
OPEN = {
    "en": "Dr Mr Mrs Ms Messrs Prof Insp Sgt Capt Cpl Col Gen Lt Maj Cmdr Adm Gov Sen Rep Pres Rev Hon Fr St Mt Ft e.g i.e eg ie cf vs viz approx esp",
    "de": "Dr Prof Hr Fr Frl Hrn Dipl Ing Med St bzw z.b d.h u.a i.d.r o.ä s.o s.u v.a z.t z vgl ca evtl ggf sog inkl exkl bspw einschl insb zzgl zw",
    "fr": "m.m mm mme mmes mlle mgr me dr p.ex ex env cf c.-à-d av ste",
    "es": "sr sra srta sres dr dra d.ª d dª dña ee p.ej ej aprox ud uds lic ing gral",
    "it": "sig sig.ra sigg dott dott.ssa prof prof.ssa ing avv arch geom on rag mons ad.es es p.es cfr ca",
    "pt": "sr sra srta dr dra exmo exma prof profa eng d p.ex ex aprox av",
    "nl": "dhr mevr mw dr drs ir ing mr prof bijv bv d.w.z nl o.a m.n i.p.v t.o.v t.a.v vgl ca resp",
    "pl": "np tzn tzw m.in ww ul al pl św ks prof dr mgr inż dyr red płk gen por tj zob wg ok",
    "cs": "např tzn tzv tj mj resp prof dr ing mgr bc sv ul cca",
    "sv": "t.ex dvs bl.a s.k resp ca prof dr f.n m.a",
    "da": "f.eks bl.a dvs hr fr dr prof ca mht pga",
    "nb": "f.eks bl.a dvs hr fr dr prof ca mht pga",
    "tr": "Dr Prof Doç Av Sn vb örn bkz",
    "ru": "т т.е е др проф акад им ул г-н г-жа гр ср напр",
    "uk": "т т.е тобто проф акад ім вул напр див",
    "el": "κ κα κος π.χ δηλ βλ καθ",
    "ar": "د أ م هـ",
    "hi": "डॉ डा श्री प्रो पं",
}
#: Abbreviations that are open only where a number follows.
BEFORE_NUMBER = {
    "en": "No Nos nr p pp pg Fig Figs fig figs Sec Sect sec Art art Ch Chap ch chap Vol vol Ed ed Eq eq par § Jan Feb Mar Apr Jun Jul Aug Sep Sept Oct Nov Dec",
    "de": "nr s abb abs kap bd tab art §  anm ziff tel",
    "fr": "no nos n p pp art fig chap vol éd sect § al tél",
    "es": "no nos n p pág págs núm núms cap art fig vol sec tel",
    "it": "n nn p pp pag pagg art artt cap fig vol tab tel",
    "pt": "n p pp pág págs núm cap art fig vol tel",
    "nl": "nr nrs blz p pp art fig afb hfst vol tel",
    "pl": "nr s str art rys tab pkt poz r t tel ust",
    "cs": "č s str obr tab čl odst kap",
    "sv": "nr s sid fig kap art",
    "da": "nr s fig kap art stk",
    "nb": "nr s fig kap art",
    "tr": "s sf no md şek",
    "ru": "стр с рис гл п пп ст табл № разд",
    "uk": "стор с рис гл п ст табл",
    "el": "σ σελ αρ εικ κεφ",
    "ar": "ص ج ف",
    "hi": "पृ सं",
}
#: Months, which follow a day's number with a point.
MONTHS = {
    "de": "januar jänner februar märz april mai juni juli august september oktober november dezember",
    "da": "januar februar marts april maj juni juli august september oktober november december",
    "nb": "januar februar mars april mai juni juli august september oktober november desember",
    "cs": "ledna února března dubna května června července srpna září října listopadu prosince",
}
#: Frequent function words, by which a text shows its language.
WORDS = {
    "en": "the and of is was were it that with for this from are has have had not his her they which when then there but we he she you by at as an or be on to in our your my its these those some any each all after before over under into than so if only because while every both",
    "de": "der die das und ist nicht ein eine einer mit von dem den des zu sich auf für im wird war es er sie aus bei nach über wie als auch",
    "fr": "le la les des est et une un dans pour qui que sur au aux du ne pas il elle ils ce cette mais par avec puis en de",
    "es": "el la los las es y una un en por con para del que se lo su al fue pero como más de no ha",
    "it": "il lo gli è di che una un per con non del della nel sono ha ma più anche le i e",
    "pt": "o os as um uma não em para com do da dos das é que foi mas por ao se e",
    "nl": "de het een van en is niet met op voor dat zijn te er maar aan door ook bij wordt",
    "pl": "w z na się nie jest do że i to przez oraz po od dla ale są był",
    "cs": "v na se je že a to s z do pro ale jsou byl jako po",
    "sv": "och att det som en är på för med av inte den till var har ett",
    "da": "og at det som en er på for med af ikke den til var har et der",
    "nb": "og at det som en er på for med av ikke den til var har et",
    "tr": "ve bir bu için ile de da çok daha olan gibi değil",
    "ru": "и в не на что с по он она это как из к за от для но его был до при без после перед или если уже были было есть этот эта эти чтобы под над",
    "uk": "і в не на що з по він вона це як із до за від для але його був та",
}
#: Languages of scripts that no other language here is written in.
BY_SCRIPT = {"ar": regex.compile(r"\p{Arabic}"), "hi": regex.compile(r"\p{Devanagari}"), "el": regex.compile(r"\p{Greek}")}
#: Languages that share a script, among which function words decide.
SCRIPTS = (
    (("en", "de", "fr", "es", "it", "pt", "nl", "pl", "cs", "sv", "da", "nb", "tr"), regex.compile(r"\p{Latin}")),
    (("ru", "uk"), regex.compile(r"\p{Cyrillic}")),
)
_TOKENS = regex.compile(r"[\p{L}\p{M}]+")
#: A language is one of a text's own from this share of its best language's evidence on.
SHARE = 0.15
#: Less evidence than this does not tell the languages of a script apart.
DECISIVE = 3

_of_word: dict[str, list[str]] = {}
for _language, _words in WORDS.items():
    for _word in _words.split():
        _of_word.setdefault(_word, []).append(_language)
LONGEST = max(len(w) for table in (OPEN, BEFORE_NUMBER) for words in table.values() for w in words.split())


class Evidence:
    """Weights of languages by the function words of a text, gathered piece by piece."""

    def __init__(self) -> None:
        self.scores: dict[str, float] = {}

    def add(self, text: str, start: int, end: int) -> None:
        counts = Counter(_TOKENS.findall(text[start:end].lower()))
        for token in counts.keys() & _of_word.keys():
            found = _of_word[token]
            for own in found:
                self.scores[own] = self.scores.get(own, 0) + counts[token] / len(found)

    def shown(self) -> set[str]:
        """The languages with a fair share of the evidence in their script."""
        best: dict[int, float] = {}
        for own, n in self.scores.items():
            if n > best.get(_GROUP[own], 0):
                best[_GROUP[own]] = n
        return {own for own, n in self.scores.items() if n >= SHARE * best[_GROUP[own]]}


_GROUP = {own: k for k, (group, _) in enumerate(SCRIPTS) for own in group}


def tag(declared: str | None) -> str | None:
    """The language of a tag, if there are lists for it."""
    name = declared.lower().replace("_", "-").split("-")[0] if declared else None
    return name if name in OPEN else None


def languages(text: str, declared: str | None = None) -> frozenset[str]:
    """The languages a text is in: those its function words and scripts show, and the declared one unless they deny it.

    In a script in which too little is shown, and nothing declared, every language that uses it.
    """
    name = tag(declared)
    evidence = Evidence()
    evidence.add(text, 0, len(text))
    out = {own for own, pattern in BY_SCRIPT.items() if pattern.search(text)} | evidence.shown()
    for group, pattern in SCRIPTS:
        weight = sum(evidence.scores.get(own, 0) for own in group)
        if name in group and weight < DECISIVE:
            out.add(name)
        elif weight < DECISIVE and pattern.search(text):
            out |= set(group)
    return frozenset(out)


class Lists:
    """The lists of some languages together."""

    def __init__(self, own: frozenset[str]):
        pick = lambda table: [unicodedata.normalize("NFC", w) for k in sorted(own) for w in table.get(k, "").split()]
        self.open, self.number = self._cased(pick(OPEN)), self._cased(pick(BEFORE_NUMBER))
        self.months = frozenset(pick(MONTHS))
        self.starts = frozenset(pick(WORDS))

    @staticmethod
    def _cased(words: list[str]) -> dict[str, bool]:
        """Folded word -> whether only its capitalised form counts (in none of the languages the other one does)."""
        out: dict[str, bool] = {}
        for w in words:
            out[w.casefold()] = out.get(w.casefold(), True) and w[0].isupper()
        return out

    @staticmethod
    def has(table: dict[str, bool], folded: str, capital: bool) -> bool:
        only = table.get(folded)
        return only is not None and (capital or not only)


@lru_cache(maxsize=512)
def lists(own: frozenset[str]) -> Lists:
    return Lists(own)


#: Any word that some language's list has; all others end sentences in every language.
ANY = lists(frozenset(OPEN))
