"""Sentence boundaries: cases by language and layout, and the tiling of any text."""

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tidemark.llm.abbreviations import languages
from tidemark.llm.sentences import SPACE, sentences, split_texts

#: Each case is the list of its sentences; joined by one space unless a separator is given.
CASES = [
    ["Dr. Zurn met Mr. Pell at 6:30 p.m. in St. Orlen.", "They left."],
    ["At 4 a.m. Mr. Haddick compared the same event twice.", "The run ended at 6:30 p.m.", "The tombstone hid it."],
    ["File No. 168 from Freight Ltd. kept it, cf. p. 9.", "The invoice named Freight Inc.", "The index lost it."],
    ["J. K. Tarn and A. Brask left.", "The U.T.C. clock stopped.", "It listed hashes, facets, etc.", "See Fig. 3 and Sec. 1.2 for more."],
    ["Version 6.9.1 found 3.5% of it.", "194 records were stale.", "m_deleted stayed false.", "layout.json was read first."],
    ["The probe waited ... and then moved.", "Nobody knew why...", "Who came?!", "It is (i.e. it was) there."],
    ["“The probe found it,” said Zurn.", "\"Has it moved?\" asked Brask in the hall.", "“It moved!” the clerk shouted.", "Brask wrote: “It moved.”", "The end."],
    ["It ended.", "(The desk found it; cf. p. 94.)", "It began again."],
    ["Am 11. Oktober fand er z. B. das Buch.", "Es ging um Felder usw.", "Akte Nr. 7 bzw. 8 fehlt.", "„Fand er es?“, fragte Brask.", "Er schrieb: „Es fehlt.“", "Siehe Abb. 5, d. h. das Bild."],
    ["M. Quillet écrit : « Le champ est là. »", "Pourquoi a-t-il sauté ?", "Selon l’art. 8.4, il est là.", "Le total vaut env. 68 de plus, p. ex. ici.", "Il a gardé l’extrait… puis il est parti.", "« Il est là », dit Brasque."],
    ["El Sr. Orvani y la Dra. Vela citan la pág. 7 y el núm. 3.", "EE. UU. y la copia lo comparten.", "¿Por qué?", "¡Al fin!", "Brasco escribió: «Lo vi.»", "Fin."],
    ["Архив и т. д. описаны на стр. 140.", "Г. Орвань видел, т. е. нашёл его.", "Он весит 373 г.", "А. Н. Тесмар пишет.", "«Он здесь», — сказал Брасков.", "Наконец…", "Всё."],
    ["قال د. أورفان إن النسخة (ص. 99) وجدت.", "لماذا أعاد الأرشيف؟", "«أخفى الجيل»، قال تسمار."],
    ["डॉ. ओर्वन ने खोज लिया।", "क्या वह बदला?", "“वह बदला,” ओर्वन ने कहा।", "अंत॥"],
    ["“야간 배치는 봉인된 진술을 보존했다.”라고 오르반 씨가 말했다.", "값은 9.79 이었다.", "왜 숨겼다는가?"],
    ["แฟ้มซ่อนข้อความ 868 รายการ", "คลังใช้ Kompass เพื่อเก็บ", "งานใช้เวลา 6.11 วินาที"],
]
TIGHT = [
    ["韦莫说：“审计报告返回了账册。”", "夜间批次隐藏了摘要。", "“投影保留了消息吗？”特思问道。", "投影（见第7页）没有变化……", "数值是3.25，高于9.8毫秒。", "终于！"],
    ["「監査報告は台帳を返した」とオルバンは述べた。", "「見つけたか？」とテスマは尋ねた。", "値は5.62で、37.4ミリ秒だった。", "なぜか？"],
    ["Siehe das Bild.", "Die Projektion fehlt.", "„Sie fehlt.“"],
]


@pytest.mark.parametrize("parts", CASES)
@pytest.mark.parametrize("gap", [" ", "\n", "  ", "\r\n", "\n\n", " "])
def test_languages(parts, gap):
    text = gap.join(parts)
    assert [text[a:b] for a, b in sentences(text)] == parts


@pytest.mark.parametrize("parts", CASES)
def test_hard_wrapped_lines(parts):
    text = " ".join(parts).replace(" ", "\n")
    if "แ" not in text:  # there a line end between words is the mark of a sentence
        assert [text[a:b].replace("\n", " ") for a, b in sentences(text)] == parts


@pytest.mark.parametrize("parts", TIGHT)
def test_without_spaces(parts):
    text = "".join(parts)
    assert [text[a:b] for a, b in sentences(text)] == parts


@pytest.mark.parametrize("items", [
    ["• One moved. It stayed", "• (Two; cf. p. 3.)"], ["1. See Fig. 3. Then go", "2. Why", "3. “It moved,” said Zurn"], ["a) First", "b) Second"], ["* Übersicht", "* Ende."],
])
def test_lists_and_headings(items):
    text = "Annex 5.10.3\n\n" + "\n".join(items) + "\n\n7.11 Scope isolation\r\n\r\nIt ended. It began"
    assert [text[a:b] for a, b in sentences(text)] == ["Annex 5.10.3", *items, "7.11 Scope isolation", "It ended.", "It began"]


@pytest.mark.parametrize("text", ["=====", "a" * 400, '{"f_1": 2, "x": "Yes. No."}', "???", "👍🏽👍🏽", "<|endoftext|><|endoftext|>", "QhW+KZc7/xaCf. Rup5==", "0" * 40])
def test_texts_that_are_no_language(text):
    assert sentences(f" {text}\n") == [(1, 1 + len(text))]


def test_nothing():
    assert sentences(None) == sentences("") == sentences(" \t\r\n 　  ") == []


def test_decomposed_letters_and_stray_marks():
    for text in ("La pág. 7 falta.", "Am 3. März fehlt es.", "Dr. 🔎 Brask fehlt.", "J. ​K. Tarn left."):
        assert sentences(text) == [(0, len(text))]
    text = "He said “it never closed. It went on. The end"
    assert len(sentences(text)) == 3


@settings(max_examples=500, deadline=None)
@given(st.text("aB. !?\n\r“”\"()«»。？ก中م1 ​-•…", max_size=60))
def test_every_character_lies_in_one_sentence(text):
    at = 0
    for a, b in sentences(text):
        assert at <= a < b and not text[at:a].strip(SPACE)
        assert text[a] not in SPACE and text[b - 1] not in SPACE
        at = b
    assert not text[at:].strip(SPACE)


@pytest.mark.parametrize("text", [
    "The end ? " * 20_000, "x " + "? " * 50_000, "a. " + "(" * 50_000 + '" ' * 50_000, "“One.” two " * 10_000, "He said (so. It was) " * 10_000, "«" * 30_000 + "a. B." * 5_000,
    "\n \n" * 50_000 + "a", "แฟ้ม Kompass คลัง " * 10_000, "a.m. " * 20_000, "“" * 40_000 + "A. b”" * 9_000, "- a\n" * 30_000, "9. " * 30_000,
])
def test_long_texts_take_linear_time(text):
    import time

    began = time.process_time()
    sentences(text)
    assert time.process_time() - began < 8


def test_rows_of_a_table(spark):
    rows = [(1, None), (2, ""), (3, "One. Two."), (3, "One. Two."), (4, "x " * 100_000 + "end. The last")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = sorted(tuple(r) for r in split_texts(df).collect())
    assert got == sorted((k, a, b) for k, t in rows for a, b in sentences(t))
    assert split_texts(df.limit(0)).collect() == []


@pytest.mark.parametrize(("text", "lang", "count"), [
    ("He met his ex. Then she left the room.", "en", 2), ("He met his ex. Then she left the room.", None, 2), ("Plan B. Then we left", None, 2), ("Vitamin C. It helps", "en", 2),
    ("We saw it Jan. 5 in the morning.", "en", 1), ("Ho visto il sig. Rossi ieri.", "it", 1), ("Il dott. Bianchi arriva.", None, 1), ("Zie blz. 5 van het boek.", "nl", 1),
    ("Proszę, np. Warszawa jest duża.", "pl", 1), ("Proszę, np. Warszawa jest duża.", "en", 1), ("He asked the gen. Nobody there answered him.", "en", 2), ("Er kam am 3. Mai und ging.", "de", 1),
    ("The word was " + "x" * 5_000 + ". It ended.", "en", 2), ("Er sagte " + "ab" * 40 + ". Dann ging er.", "DE", 2),
])
def test_abbreviations_belong_to_languages(text, lang, count):
    assert len(sentences(text, lang)) == count


def test_languages_of_texts():
    assert languages("The ship was in the harbour and it left with her.", "fr") == {"en"}
    assert "de" in languages("Kurz.", "de-AT") and {"it", "en"} <= languages("xyz", "und") and languages("") == frozenset()
    assert languages("Он был на борту, и это было важно для них.", None) >= {"ru"} and "en" not in languages("Он был на борту, и это было", None)


#: Sentences of languages and wordings that no test table has; none was used to make the lists.
HELD_OUT = {
    "en": ["Rev. Hale spoke to Lt. Moss on Sept. 3 about it.", "She lives near St. Ives.", "See pp. 4 and 5, or ch. 2.", "It is cold, i.e. below zero.", "Was it Mrs. Dale?", "They met Gen. Orr, Gov. Pike and Sen. Lund."],
    "de": ["Prof. Anders und Fr. Lind kamen am 9. Juni an.", "Vgl. dazu Kap. 3 und Anm. 7.", "Das gilt z. B. für Boote bzw. Schiffe.", "Ist das so?", "Er kam, d. h. er fuhr."],
    "fr": ["M. Duval et Mme Roche sont là.", "Voir fig. 3 et chap. 2.", "Mgr. Blanc parle avec le Dr. Petit.", "Est-ce vrai ?", "Il pèse env. 3 kilos."],
    "es": ["El Sr. Gil y la Sra. Paz llegaron.", "Véase el cap. 3 y la fig. 2.", "Hay barcos, p. ej. veleros.", "¿Es cierto?", "La Dra. Sol lo sabe."],
    "it": ["Il sig. Conti e la sig.ra Verdi sono partiti.", "Si veda pag. 12 e fig. 3.", "L'ing. Russo lavora con il prof. Neri.", "È vero?", "Cfr. cap. 4 del libro."],
    "pt": ["O Sr. Lima e a Sra. Reis chegaram.", "Ver pág. 9 e cap. 2.", "O Dr. Pinto não está.", "É verdade?", "Há barcos, p.ex. veleiros."],
    "nl": ["Dhr. Smit en mevr. Bos zijn er niet.", "Zie blz. 14 en fig. 2.", "Prof. Vos werkt met drs. Kok.", "Is dat waar?", "Het schip, d.w.z. de boot, is weg."],
    "pl": ["Pan prof. Nowak i dr Lis są tutaj.", "Zob. str. 12 i rys. 3.", "Mieszka przy ul. Długiej.", "Czy to prawda?", "Jest wiele miast, np. Kraków."],
    "sv": ["Det finns båtar, t.ex. segelbåtar.", "Se s. 12 och fig. 3.", "Prof. Berg och dr. Lund är här.", "Är det sant?", "Hon kom kl. 9 på kvällen."],
    "tr": ["Dr. Kaya ve Prof. Demir geldi.", "Bkz. s. 12 ve şek. 3.", "Bu doğru mu?", "Av. Yılmaz da burada."],
    "uk": ["Проф. Коваль та акад. Бойко були тут.", "Див. стор. 12 та рис. 3.", "Чи це правда?", "Він жив на вул. Новій."],
    "el": ["Ο κ. Παππάς και η κα. Νίκου ήρθαν.", "Βλ. σελ. 12 και εικ. 3.", "Είναι αλήθεια;", "Υπάρχουν πλοία, π.χ. ιστιοφόρα."],
}


def held_out_scores() -> dict[str, tuple[float, float]]:
    """(recall, precision) of boundaries between the held-out sentences, by language."""
    out = {}
    for lang, parts in HELD_OUT.items():
        for k in range(len(parts)):  # each sentence behind each other one
            for a, b in ((parts[k], parts[k - j]) for j in range(1, len(parts))):
                text, cut = f"{a} {b}", len(a)
                found = {e for _, e in sentences(text, lang)[:-1]}
                out.setdefault(lang, [0, 0, 0])
                out[lang][0] += cut in found
                out[lang][1] += 1
                out[lang][2] += len(found)
    return {lang: (hit / there, hit / max(1, told)) for lang, (hit, there, told) in out.items()}


def test_held_out_languages():
    scores = held_out_scores()
    assert sum(r for r, _ in scores.values()) / len(scores) >= 0.95, scores
    assert sum(p for _, p in scores.values()) / len(scores) >= 0.95, scores
