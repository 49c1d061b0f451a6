import random
import sys

import pytest

from pyspark.sql import functions as F

from tests.helpers import table
from tidemark.llm import sentences
from tidemark.llm.queries import documents
from tidemark.llm.sentences import IF_STARTER, LEAST_COUNT, LEAST_STARTS, NO, UNLESS_DIGITS, YES, Document, Evidence, Open, _settled, corpus_words, sentence_units, settle, units, verdict

WORDS = {
    "Corp": (True, True, False), "Co": (True, True, False), "seq": (True, True, False), "v": (True, False, True), "v. H": (True, True, True), "Dr. H": (True, False, True), "Dr": (True, False, False), "No": (True, False, True),
    "Nr": (True, False, True), "St": (True, False, False), "etc": (True, False, False), "# г": (True, True, True), "# م": (True, True, True),
}
STARTERS = {"The": 0.5, "Das": 0.5, "Der": 0.5, "No": 0.3, "KG": 0.0, "Senat": 0.0, "Orrick": 0.0, "Сумма": 0.4, "المبلغ": 0.5, "ردت": 0.0, "Quorell": 0.0}


def cut(text: str) -> list[str]:
    found = units(text, WORDS, STARTERS)
    return [text[a:b] for a, b in zip(found[::2], found[1::2])]


@pytest.mark.parametrize(
    "paragraph",
    [
        "The sum is paid.|The rest isn't.",
        "It went to Zimtar Corp.|No. 60 on the list, the lease, was signed.|Zimtar & Co. KG was not.",
        "Is that so?!|e.g. this would do.|iTally lost it.",
        "He replied: “We saw it. We asked.”|The court rose.",
        "“No!” cried he, but it fell.|“It is late,” said he, “and late (see p. 4).”|The end.",
        "(The note in No. 4, p. 3 et seq. was struck out.)|The rest (sheet 2, fig. 7.3) stays.",
        "[3] Did he know?|The answer, etc., is 4.5 m. east.",
        "The map is in St. Orrick on 3.4.2011.|The end … came.",
        "It was enough.‖The end.",
        "Der 3. Senat hat es offen gelassen, Nr. 7 bis 8.|Das AG auch.|Es galt der Satz von 5 v. H.|Der Zeuge sagte: „Nein!“|Dr. H. Quorell kam.",
        "La somme de 5 € est due.|Est-ce à dire que non ?|« Je n'ai rien signé. Rien du tout ! », a-t-il dit.",
        "¿Por qué esperó?|«No firmé. No cobré», dijo él.|¡Nada!",
        "Срок до 3 окт. 2020 г.|Сумма в 5 руб. не оплачена.|«Я не подписывал. Нет», — заявил он.",
        "Τι σημαίνει αυτό;|Κατά το άρθρ. 4, ισχύει (βλ. σελ. 7);|Απορρίπτεται!",
        "قبل 26/1/2015 م.|المبلغ 5.5 لم يسدد.|قال الشاهد: «لم أر شيئا. لا أعلم.»|في 4/6/2022 م. ردت على الطلب.|هل هذا؟",
        "यह रु. 5.5 है।|गवाह बोला, “मैंने नहीं देखा। नहीं।”|क्या यह है?|खारिज!",
        "尚欠5.50元，占10%。‖证人说：“我没看见。我也没签字。”‖“不同意。”他当庭表示。‖此说不能成立！",
        "証人は「見ていません。知りません。」と述べた。‖『控え。写し。』と題する書面（甲第1号）は、関係がない。‖果たしてそうか？",
        "พยานตอบว่า “ไม่เห็น ไม่ทราบ” ต่อหน้าศาล|จำเลยส่งเอกสาร 43 ฉบับล่าช้า|สำเนา PDF ของสัญญา",
    ],
)
def test_paragraphs(paragraph):
    """| parts units with a blank between them, ‖ without."""
    text = paragraph.replace("‖", "").replace("|", " ")
    assert cut(text) == paragraph.replace("‖", "|").split("|")


def test_lines_of_their_own():
    text = "Velpax\n\nAda v. Orrin et al.\n\nDocket No. 12A-2/15\n\nII. Analysis of the Grounds\n\n1. It is so. The end.\n\n- 2 -   Docket No. 12A-2/15   of 3\n\nDr. A, presiding; Dr. B, concurring"
    assert cut(text) == ["Velpax", "Ada v. Orrin et al.", "Docket No. 12A-2/15", "II. Analysis of the Grounds", "1. It is so.", "The end.", "- 2 -   Docket No. 12A-2/15   of 3", "Dr. A, presiding; Dr. B, concurring"]


def test_languages_mixed_in_a_document():
    assert cut("พยานตอบ ศาลยก\n\nThe end. It is so.\n\nพยาน The end. ศาลยก") == ["พยานตอบ", "ศาลยก", "The end.", "It is so.", "พยาน The end.", "ศาลยก"]


def test_line_breaks():
    assert cut("It broke\nhere. The\nend.\n\nNext one.") == ["It broke\nhere.", "The\nend.", "Next one."]
    assert cut("One line.\nTwo. Three.\nFour.") == ["One line.", "Two.", "Three.", "Four."]
    assert cut("One.\r\n\r\nTwo.") == ["One.", "Two."]


def test_every_visible_character_is_in_one_unit():
    rng = random.Random(3)
    letters = list("aB.!?…;:,“”„«»()[]\n \r\t'\"‘’。！「」『』ก ข1α;।é\xa0　\xad") + ["\n\n", "[…]", "â€œ", "�", "Corp. ", "12A-2/15"]
    for _ in range(6000):
        text = "".join(rng.choice(letters) for _ in range(rng.randrange(40)))
        found = units(text, WORDS, STARTERS)
        pairs = list(zip(found[::2], found[1::2]))
        assert all(a < b for a, b in pairs) and all(b <= c for (_, b), (c, _) in zip(pairs, pairs[1:]))
        assert all(not text[a].isspace() and not text[b - 1].isspace() for a, b in pairs)
        covered = {i for a, b in pairs for i in range(a, b)}
        assert all(i in covered for i, c in enumerate(text) if not c.isspace())


def test_document_decides_before_the_corpus():
    assert cut("See Zumb. Lo for it, and zumb. of old. The end.") == ["See Zumb.", "Lo for it, and zumb. of old.", "The end."]
    assert cut("By gloob. Ada it is, by gloob. in fact, by gloob. at last. The end.")[0].startswith("By gloob. Ada it is, by gloob. in")
    text = "He met Zob. and left, with Zob. in fact, for Zob. Orrick came."
    assert [text[a:b] for a, b in zip(*[iter(units(text, {"Zob": (False, True, False)}, {}))] * 2)] == [text]
    text = "The lease was long. It was the longest lease. Nobody had signed the lease in time."
    found = units(text, {"lease": (True, False, False)}, {})
    assert [text[a:b] for a, b in zip(found[::2], found[1::2])] == ["The lease was long.", "It was the longest lease.", "Nobody had signed the lease in time."]


def test_document_knows_what_begins_sentences():
    text = "Lo it is.\n\nBy Zimtar Corp. Lo went on, by Zimtar Corp. Orrick did not."
    assert cut(text) == ["Lo it is.", "By Zimtar Corp.", "Lo went on, by Zimtar Corp. Orrick did not."]


def test_unended_paragraphs_of_any_length():
    plain = "The appeal is allowed. The costs are reserved! Was it late? Nobody can say"
    for tail in ("", " what would have come of it" * 10):
        assert cut(plain + tail) == ["The appeal is allowed.", "The costs are reserved!", "Was it late?", f"Nobody can say{tail}"]
    caption = "Ada Zimtar Corp. against Orrin & Co. KG, St. Orrick"
    assert cut(caption) == [caption] and cut(f"{caption}, and others" * 9) == [f"{caption}, and others" * 9]


def test_far_context():
    far = " " * 200
    assert cut(f"It is so.{far}The end.") == ["It is so.", "The end."] and cut(f"He said “No.”{far}and left.") == [f"He said “No.”{far}and left."]
    assert cut(f"Τι σημαίνει {'1' * 90};{far}Τέλος.") == [f"Τι σημαίνει {'1' * 90};", "Τέλος."]


def test_verdicts():
    assert verdict(90, 0, 0, 0) == (True, False, False)
    assert verdict(0, 0, 500, 0)[:2] == (True, False)
    assert verdict(60, 0, 30, 10) == (True, True, False)
    assert verdict(2, 0, 60, 38) == (False, True, False)
    assert verdict(0, 0, 90, 10, True)[:2] == (True, True) and verdict(0, 0, 90, 0, True)[:2] == (True, False)
    assert verdict(0, 0, 30, 1) is None


def test_evidence():
    e = Evidence()
    e.read("[1] He met Dr. Ada at 4 p.m. on time. Was it? So it was, etc., at the end.")
    assert e.before["Dr"] == [0, 0, 1, 0] and e.before["p.m"] == [1, 0, 0, 0] and e.before["etc"] == [1, 0, 0, 0] and e.before["end"] == [0, 0, 0, 1]
    assert e.starts["He"] == 1 and e.starts["So"] == 1 and e.follows["Ada"] == 1


def test_full_stops_that_plainly_end_nothing_are_passed_over():
    assert not sentences.MARKS.findall("At 4.5 p.m. on it, etc., as in no. v, the end.")
    for text in ("It was. e.g. this", "It was. iTally", "It was. It", "It was.  it", "It was.\tit", "It was.) it", "It was.. it"):
        assert sentences.MARKS.search(text).start() == 6
    for blank in ("  ", "\t", "\xa0", " \t", "\u3000"):
        assert cut(f"It was so.{blank}The end.") == ["It was so.", "The end."] and len(cut(f"It was etc.{blank}the end.")) == 1


def test_work_per_stop():
    """Calls, not seconds, which vary with the machine: 11.6 for each full stop or question mark here, 16.9 before."""
    line = "He met Dr. Ada Zimtar of Zimtar Corp. at 4.5 p.m. on time, cf. no. 7 of Orrin & Co. The rest, etc., fell to Mr. H. Lo et al. Nobody came. Was it so? “We saw it,” said he."
    text, calls = "\n\n".join(f"[{i}] {line}" for i in range(50)), 0

    def count(frame, event, arg):
        nonlocal calls
        calls += event in ("call", "c_call")

    Document(text)
    before = sys.getprofile()
    sys.setprofile(count)
    try:
        Document(text)
    finally:
        sys.setprofile(before)
    assert calls < 13 * (text.count(".") + text.count("?"))


def test_what_is_kept_of_tokens_is_bounded_and_changes_nothing(monkeypatch):
    text = "By Zimtar Corp. Lo it is. Ada B. Orrin, Dr. H. Lo et al. saw it. No. 5 it was, p. 4, etc. So it is! The end. " * 3
    expected = cut(text)
    monkeypatch.setattr(sentences, "WORDS_KEPT", 3)
    kept = [v for v in vars(sentences).values() if isinstance(v, sentences.Kept)]
    for k in kept:
        k.clear()
    assert cut(text) == expected and len(kept) > 3 and all(len(k) <= 3 for k in kept)


def test_paragraphs_read_together_or_one_by_one():
    parts = ["[1] He met Dr. Ada at 4 p.m.", "A. was it? So it was, etc., at 4 p.m.", "B. B. Lo", "(2)", "so B. it is."]
    together, single = Evidence(), Evidence()
    together.read(*parts)
    for p in parts:
        single.read(p)
    assert together.before == single.before and together.starts == single.starts and together.follows == single.follows and together.plain == single.plain
    assert together.before["A"] == [1, 0, 0, 0] and together.before["p.m"] == [0, 0, 0, 2] and together.before["B. B"] == [0, 0, 1, 0]


def test_operator(spark):
    rows = [(1, "One. Two."), (2, None), (3, ""), (4, " \n\t"), (5, "x" * 200_000 + ". End."), (1, "One. Two.")]
    df = table(spark, "doc_id bigint, text string, start_char string, word string", [(*r, "s", "w") for r in rows])
    got = sorted(tuple(r) for r in sentence_units(df, "doc_id", "text").collect())
    assert got == [(1, 0, 4), (1, 0, 4), (1, 5, 9), (1, 5, 9), (5, 0, 200_001), (5, 200_002, 200_006)]
    assert sentence_units(df.limit(0), "doc_id", "text").collect() == []


def corpus_of(texts):
    seen = Evidence()
    for t in texts:
        if t:
            seen.add(Document(t).evidence)
    words = {w: verdict(*c, w[-2:-1] == " ") for w, c in seen.before.items() if sum(c) >= LEAST_COUNT}
    both = {w: (seen.starts.get(w, 0), seen.follows.get(w, 0)) for w in seen.starts.keys() | seen.follows.keys()}
    return {w: v for w, v in words.items() if v}, {w: a / (a + b) for w, (a, b) in both.items() if a + b >= LEAST_STARTS}


def test_operator_equals_one_text_at_a_time(spark, data):
    df = documents(spark, data).select("doc_id", "text")
    texts = {r["doc_id"]: r["text"] for r in df.collect()}
    words, starters = corpus_of(texts.values())
    assert words and starters
    expected = []
    for i, t in texts.items():
        found = units(t, words, starters) if t else []
        expected += [(i, a, b) for a, b in zip(found[::2], found[1::2])]
    assert sorted(map(tuple, sentence_units(df.repartition(3), "doc_id", "text").collect())) == sorted(expected)


def test_corpus_as_columns(spark):
    rng = random.Random(7)
    counts = {w: [rng.choice([0, 0, 1, 5, 60, 300]) for _ in range(4)] for w in [f"w{i}" for i in range(300)] + [f"x y{i}" for i in range(9)] + [f"x {c}" for c in "abcdef"]}
    rows = [(f"stop {w}", *c) for w, c in counts.items()] + [("start A b", 1, 9, 0, 0), ("start C", 1, 5, 0, 0)]
    words, starters = corpus_words(table(spark, "counted string, n0 bigint, n1 bigint, n2 bigint, n3 bigint", rows))
    expected = {w: verdict(*c, w[-2:-1] == " ") for w, c in counts.items() if sum(c) >= LEAST_COUNT}
    assert {r[0]: tuple(r[1:]) for r in words.collect()} == {w: v for w, v in expected.items() if v}
    assert [tuple(r) for r in starters.collect()] == [("A b", 0.1)]


def test_settled_as_columns(spark):
    rng = random.Random(8)
    words = {"a": (True, False, False), "b": (True, True, True), "c": (False, True, False), "d": (True, True, False)}
    opens = [
        Open(rng.choice(["a", "b", "c", "d", "z", None]), rng.choice([None, True]), rng.randrange(3), then := rng.choice([NO, YES, UNLESS_DIGITS, IF_STARTER]), rng.choice(["S", "T", "U"]) if then == IF_STARTER else None, rng.random() < 0.5, rng.random() < 0.5)
        for _ in range(400)
    ]
    starters = {"S": 0.5, "T": 0.0}
    df = table(spark, "i int, word string, abbr boolean, form int, then int, starter string, starts boolean, negate boolean", [(i, *o) for i, o in enumerate(opens)])
    df = df.join(table(spark, "c_word string, c_abbr boolean, c_may_end boolean, c_digits boolean", [(w, *v) for w, v in words.items()]), F.col("word") == F.col("c_word"), "left")
    df = df.join(table(spark, "c_starter string, c_rate double", list(starters.items())), F.col("starter") == F.col("c_starter"), "left")
    assert {r[0]: r[1] for r in df.select("i", _settled()).collect()} == {i: settle(o, words, starters) for i, o in enumerate(opens)}
