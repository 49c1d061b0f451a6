"""Sentence units of texts in many languages and scripts.

A text is cut into paragraphs, and a paragraph into sentences. Quotations and brackets are found first; nothing inside them
ends a sentence. Outside, the terminators of the scripts (! ? and their kin, ideographic stops, dandas, the Greek question mark)
end one; Thai ends one at a blank. Only the full stop is ambiguous, and is decided by document-centred disambiguation:
what a word does in the document where its reading is certain tells how to read it where it isn't.

* A word that goes on in lower case or with a comma after its stop, never stands without one and never ends a paragraph, is an abbreviation in
  this document. A word that also stands without a stop, and never goes on so, is none.
* A capitalized word after an abbreviation begins a sentence if the document begins a paragraph, or a sentence after ! or ?, with it, or has it in lower case.

Where the document is silent, or contradicts itself, the corpus is asked: counts of how each word goes on where that is certain, over all documents. Words
that do the one and hardly ever the other are abbreviations there, and the rare ends tell which abbreviations can end a
sentence ("Corp.") and which cannot ("Prof."). Where the corpus knows too little as well, the form of the word decides.

One pass over the texts yields, for each group of some texts, the pieces between boundaries that are certain or open, the
different questions that the open ones ask, and counts. Counts are summed by word; the questions are joined with them by word; the answers go
back to their group, where numbers, not texts, are put together.
No table of words is collected, bounded or sent to tasks other than by Spark's own check of its size.
"""

import re
from collections import Counter
from collections.abc import Callable, Iterable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import from_arrow_type, to_arrow_type

from tidemark.llm.encoding import small_batches
from tidemark.sources.scratch import Scratch

LEAST_COUNT, LEAST_STARTS, LEAST_RATE = 3, 10, 0.1
SURE = 60

TERMINATORS = ".!?…。！？｡؟۔।॥"
STRONG = frozenset("!?。！？｡؟۔।॥")
STRONG_BLANK = frozenset("!?؟")
OPENERS = "([{（【《〈“„«‘‹「『\"'¿¡"
CLOSERS = ")]}）】》〉”»’›」』\"'“‘"
THAI = r"ก-ฺเ-๎"

#: quotations by their opener, each up to its closer; the replacement character and mojibake may stand for a damaged mark
QUOTES = {
    c: re.compile(x)
    for c, x in {
        "“": r"“[^“”]*”|“[^“”�]*�", "„": r"„[^„“”]*[“”]|„[^„“”]*?(?:â€œ|�)", "«": r"«[^«»]*»", "»": r"»[^«»]*«", "‘": r"‘[^‘’]*’",
        '"': r"\"[^\"]*\"", "「": r"「[^「」]*」", "『": r"『[^『』]*』", "â": r"â€œ[^“”]*”", "�": r"�[^“”„�]*”",
    }.items()
}
#: brackets, one level of them inside another
BRACKETS = {
    c: re.compile(x)
    for c, x in {
        "(": r"\([^()]*(?:\([^()]*\)[^()]*)*\)", "（": r"（[^（）]*(?:（[^（）]*）[^（）]*)*）", "[": r"\[[^\[\]]*\]", "【": r"【[^【】]*】", "《": r"《[^《》]*》",
    }.items()
}
STOPS = re.compile(f"[{re.escape(TERMINATORS)}]+")
GREEK_QUESTIONS = ";\u037e"
GREEK = re.compile(r"[Ͱ-Ͽἀ-῿]")
THAI_BYTES = (b"\xe0\xb8", b"\xe0\xb9")
CJK = re.compile(r"[぀-ヿ㐀-鿿豈-﫿𠀀-𯿿]")

NUMBER = re.compile(r"\s*(?:§\s*\d+\b|\[\d+\]|\(\d+\)|（\d+）|\d+\s*[.)．）](?!\d))\s*")
DOCKET = re.compile(r"\d{1,3}[A-Z]-\d+/\d\d")
PLACEHOLDER = re.compile(r"\[\s*(?:…|\.\.\.)\s*\]")
HIDDEN = re.compile("[\xad\u200b-\u200d\u2060\ufeff]")
#: a word that begins in lower case and yet may begin a sentence: "e.g.", a brand like "iTally"
LOWER_START = re.compile(r"[a-z](?:\.[a-z]\.|[a-z]*[A-Z])")
#: whatever may end a sentence or open a span, but for full stops that plainly end none: at the end of all, inside a word or number, before a comma or lower case
MARKS = re.compile(f"[{re.escape(TERMINATORS + GREEK_QUESTIONS + ''.join(QUOTES) + ''.join(BRACKETS))}](?<!\\.(?=\\Z|[a-z0-9,;:]| (?!{LOWER_START.pattern})[a-z]))")
THAI_MARKS = re.compile(MARKS.pattern + rf"|(?<=[{THAI}])\s+(?=[{THAI}])")
PLAIN_NUMBER = re.compile(r"\d{1,2}")
ANY_NUMBER = re.compile(r"[\d.,:/\-–]*\d")
CONTINUES = frozenset(",;:–—-·؛،、，；：%)]}»”")
NEVER_STARTS = frozenset(",;:!?)]}»”–—")
AFTER_WORD = ",;:!?" + CLOSERS
BLANKS_AND_CLOSERS = CLOSERS + " \t\r\n\xa0\u202f\u3000"
BLANKS, TOKEN = re.compile(r"\s*"), re.compile(r"\s*(\S*)")
BARE = re.compile(f"[{re.escape(OPENERS)}]*([^{re.escape(AFTER_WORD)}]*)")
#: ! or ? and what stands after it; a sentence follows there unless that goes on
LOUD = re.compile(r"[!?؟！？。｡।॥][" + re.escape(CLOSERS) + r"]*\s*(?=(\S))")
#: a word that ends a sentence and no abbreviation: lower case throughout, and not short
PLAIN_END = re.compile(r"(?:^|[\s\-–—'’])([^\W\d_A-Z]{4,})[.!?…。।]$")
#: what may stand between the end of a quotation and its mark, and what it may end with so that more than the mark tells
BEFORE_QUOTE = "â€ "
QUOTE_ENDS = frozenset(TERMINATORS + BEFORE_QUOTE)
READ = frozenset(".,;:" + "".join(CLOSERS) + "!?؟")


def paragraphs(text: str) -> list[tuple[int, int]]:
    """Start and end of each paragraph that is not blank: blank lines part them; without any, line breaks do."""
    spans, at, blank_between, last = [], 0, False, -1
    for i, line in enumerate(text.split("\n")):
        inner = line.strip()
        if inner:
            start = at + (0 if line[0] == inner[0] else line.index(inner[0]))
            spans.append((start, start + len(inner), i))
            blank_between |= last >= 0 and i > last + 1
            last = i
        at += len(line) + 1
    if not blank_between:
        return [(a, b) for a, b, _ in spans]
    out: list[tuple[int, int]] = []
    before = -2
    for a, b, i in spans:
        if i == before + 1:
            out[-1] = (out[-1][0], b)
        else:
            out.append((a, b))
        before = i
    return out


def head_length(text: str, parts: list[tuple[int, int]]) -> int:
    """How many first paragraphs are lines of the head (court, caption, docket): up to the first line that is a docket line, if none before it is a sentence."""
    found = DOCKET.search(text)
    if not found:
        return 0
    for i, (a, b) in enumerate(parts):
        if a <= found.start() < b:
            return i + 1 if is_line(text[a:b]) else 0
        if is_sentence(text[a:b]):
            return 0
    return 0


def is_sentence(p: str) -> bool:
    """Whether a paragraph plainly ends as a sentence does."""
    last = p.rstrip(BLANKS_AND_CLOSERS)
    word = last[last.rfind(" ") + 1 :]
    return PLAIN_END.search(word) is not None and word[:1].islower() or last[-1:] in STRONG


def is_line(p: str) -> bool:
    """Whether a paragraph may be a line of its own (heading, page header, signature): nothing ends it."""
    end = p.rstrip(BLANKS_AND_CLOSERS)[-1:]
    return not end or end not in TERMINATORS and end not in GREEK_QUESTIONS or p[-1] == "]" and PLACEHOLDER.search(p[-8:]) is not None


def is_loud(p: str) -> bool:
    """Whether some ! or ? (or a stop of a script that has no other use for it) inside a paragraph plainly ends a sentence."""
    return any(m[1] not in CONTINUES and not m[1].islower() for m in LOUD.finditer(p))


def is_thai(text: str) -> bool:
    """Whether there is any Thai letter in the text."""
    if text.isascii():
        return False
    raw = text.encode("utf-8", "replace")
    return THAI_BYTES[0] in raw or THAI_BYTES[1] in raw


#: tokens come again and again; what was made of them is kept, of WORDS_KEPT different ones at most
WORDS_KEPT = 200_000
#: what an abbreviation that may end a sentence does; TOO_FAR: the token after the stop is not where it was looked for
NO, YES, UNLESS_DIGITS, IF_STARTER, IF_BRACKET = range(5)
TOO_FAR = -1, None, None
#: what stands before a full stop: a word, a single letter, a number that may be one in a list, nothing that can be an abbreviation, letters of a script without full stops
WORD, LETTER, ORDINAL, OTHER_END, NO_STOP = range(5)
#: stands after the tokens of a paragraph
BREAK = "\n"


class Kept(dict):
    """What a function makes of each token, by the token; emptied when it is full."""

    def __init__(self, make: Callable):
        self.make = make

    def __missing__(self, token):
        if len(self) >= WORDS_KEPT:
            self.clear()
        made = self[token] = self.make(token)
        return made


def _clean(word: str) -> str:
    return word if word.isascii() else HIDDEN.sub("", word)


@Kept
def _bare(token: str) -> str:
    """The word of a token that begins a sentence or follows a stop."""
    return _clean(BARE.match(token)[1]).rstrip(".")


STOP_END, COMMA_END, LOUD_END = range(3)


@Kept
def _read_token(token: str) -> tuple[int | None, str]:
    """How a token ends (a full stop, one with a comma after it, ! or ?), and the word before the stop; none where what follows has to tell (numbers, closers, redactions)."""
    last = token[-1]
    if last == "." or last in ",;:" and token[-2:-1] == ".":
        word = _clean(token[: -1 if last == "." else -2].lstrip(OPENERS))
        return STOP_END if last == "." else COMMA_END, word if word and word[-1].isalpha() else ""
    return (LOUD_END if last not in ",;:" and token.rstrip(CLOSERS)[-1:] in STRONG_BLANK else None), ""


@Kept
def _after(token: str) -> tuple[int, str | None]:
    """How a word goes on after its stop, by the next token: an index into counts, and the word that may begin a sentence there."""
    if token == BREAK:
        return Evidence.END, None
    first = token[:1]
    if first.islower():
        return (Evidence.OTHER if LOWER_START.match(token) else Evidence.LOWER), None
    if first == ",":
        return Evidence.LOWER, None
    return (Evidence.DIGIT, None) if first.isdigit() else (Evidence.OTHER, _bare[token])


def _last_word(piece: str) -> str:
    """The last word of a stretch before a stop, without what opens before it."""
    if not piece.isalnum() or not piece.isascii():
        piece = _clean((piece.split() or [""])[-1]) if not piece[-1:].isspace() else ""
    return piece.lstrip(OPENERS)


@Kept
def _stop(piece: str) -> tuple[int, str, int]:
    """What a stretch without a blank before a full stop is, its last word, and the form of that (see ``Open``)."""
    word, last = _last_word(piece), piece[-1:]
    if last > "\u08ff" and ("\u0900" <= last <= "\u097f" or "\u0e00" <= last <= "\u0e7f" or CJK.match(last)):
        return NO_STOP, word, 0
    if not word[-1:].isalpha():
        return ORDINAL if word[-1:].isdigit() and PLAIN_NUMBER.fullmatch(word) else OTHER_END, word, 0
    form = 2 if "�" in word or "Ã" in word else int("." in word and word.replace(".", "").isalpha())
    return LETTER if len(word) == 1 else WORD, word, form


@Kept
def _next(stretch: str) -> tuple[int | None, str | None, str | None]:
    """What a stretch without a blank after a stop leaves to the word before it: ``Open.then`` (null: nothing, no sentence begins so), ``Open.starter``, and that in lower case if it isn't."""
    if not stretch or stretch[0].isspace():
        return TOO_FAR
    token = stretch.split()[0]
    first = "“" if token.startswith("â€œ") else token[0]
    if first in NEVER_STARTS:
        return None, None, None
    if first.islower():
        return (YES if LOWER_START.match(token) else None), None, None
    if first.isdigit():
        return UNLESS_DIGITS, None, None
    if first in "([（":
        return IF_BRACKET, None, None
    return (YES, None, None) if first in OPENERS else (IF_STARTER, word := _bare[token], small if (small := word.lower()) != word else None)


@Kept
def pair(before_and_letter: tuple[str, str]) -> str:
    """What a single letter is known by: the word before it, numbers being alike, and the letter ("w. N", "Col. H")."""
    before, letter = before_and_letter
    before = _clean(before.lstrip(OPENERS))
    return f"{'#' if before[-1:].isdigit() else before} {letter}"


class Evidence:
    """Counts of how words behave where that is certain.

    They are kept as lists of words, one for each kind of place, and counted when asked for.
    """

    #: word before a stop: goes on in lower case or after a comma, goes on with a digit, goes on otherwise, ends a paragraph;
    #: word that begins a sentence, word in upper case after a full stop
    LOWER, DIGIT, OTHER, END, START, FOLLOW = range(6)

    def __init__(self) -> None:
        self.places: list[list[str]] = [[] for _ in range(6)]
        self.plain: set[str] = set()
        self._counts: list[Counter[str]] | None = None

    @property
    def counts(self) -> list[Counter[str]]:
        """How often each word stands in each kind of place."""
        if self._counts is None:
            self._counts = [Counter(p) for p in self.places]
        return self._counts

    @property
    def before(self) -> dict[str, list[int]]:
        """The first four counts by word."""
        out: dict[str, list[int]] = {}
        for kind, counts in enumerate(self.counts[:4]):
            for word, n in counts.items():
                out.setdefault(word, [0, 0, 0, 0])[kind] = n
        return out

    @property
    def starts(self) -> Counter[str]:
        return self.counts[self.START]

    @property
    def follows(self) -> Counter[str]:
        return self.counts[self.FOLLOW]

    def read(self, *parts: str) -> None:
        """Count the words of paragraphs of sentences."""
        places, tokens = self.places, []
        starts, follows = places[self.START], places[self.FOLLOW]
        for p in parts:
            number = NUMBER.match(p)
            words = p[number.end() :].split() if number else p.split()
            if words:
                starts.append(_bare[words[0]])
                tokens += words
                tokens.append(BREAK)
        self.plain.update(tokens)
        for i in [i for i, t in enumerate(tokens) if t[-1] in READ]:
            token = tokens[i]
            how, word = _read_token[token]
            if how == STOP_END:
                kind, name = _after[tokens[i + 1]]
                if name is not None:
                    follows.append(name)
            elif how is None:
                continue
            elif how == LOUD_END:
                if tokens[i + 1] != BREAK:
                    starts.append(_bare[tokens[i + 1]])
                continue
            else:
                kind = 0
            if word:
                if len(word) == 1 and i and token[0] == word and tokens[i - 1] != BREAK:
                    word = pair[tokens[i - 1], word]
                places[kind].append(word)
        self._counts = None

    def add(self, other: "Evidence") -> None:
        """Add the counts of a document to those of many."""
        for mine, more in zip(self.places, other.places):
            mine += more
        self._counts = None


def verdict(lower: int, digit: int, other: int, end: int, initial: bool = False) -> tuple[bool, bool, bool] | None:
    """What counts of a word before a stop say about it; None if they are too few to tell a name from an abbreviation.

    A single letter is an abbreviation or an initial in any case.
    """
    total = lower + digit + other + end
    inside = lower + digit
    if initial:
        return (True, end > 0.01 * total, digit > 0.1 * total)
    if not inside and total < SURE:
        return None
    if end and inside <= 0.1 * total and end >= 0.08 * total:
        return FORMS[0]
    if end < 0.004 * total or not end:
        return (True, False, digit > 0.1 * total)
    return (True, True, digit > 0.1 * total)


class Open(NamedTuple):
    """A boundary that only the corpus can decide; ``settle`` tells how.

    ``word``: the word before the stop, null if no word is asked about. ``abbr``: what the document, or the form of a single letter or number, says about it:
    whether it is an abbreviation; null: silent. ``form``: what its form or weak evidence in the document says, 0 a plain word, 1 an abbreviation, 2 damaged.
    ``then``: whether a sentence ends there if it is an abbreviation that can end one: 0 no, 1 yes, 2 unless it goes on with digits, 3 if
    ``starter`` begins sentences (``starts``: if the corpus doesn't know). ``negate``: the boundary is there if that one is not.
    """

    word: str | None
    abbr: bool | None
    form: int
    then: int
    starter: str | None
    starts: bool
    negate: bool = False


#: (is an abbreviation, may end a sentence, goes on with a digit) by form
FORMS = ((False, True, False), (True, False, False), (True, True, True))


def settle(o: Open, words: dict[str, tuple[bool, bool, bool]], starters: dict[str, float]) -> bool:
    """Whether an open boundary is one, by the corpus's verdicts on words and the rates of starters. ``_settled`` is the same as columns."""
    known = words.get(o.word)
    abbreviation, may_end, digits = known or FORMS[o.form]
    if o.abbr and not abbreviation:
        may_end = False
    if not (abbreviation if o.abbr is None else o.abbr):
        ends = True
    elif not may_end or o.then == NO:
        ends = False
    elif o.then == UNLESS_DIGITS:
        ends = not digits
    else:
        ends = o.then == YES or (starters[o.starter] >= LEAST_RATE if o.starter in starters else o.starts)
    return ends != o.negate


class Document:
    """The paragraphs of one text, the evidence in it, and its units as far as it can tell.

    ``starts``, ``ends``: pieces, those of a paragraph in order. ``gates``: for each the number of the question (the fields of ``Open``)
    that decides whether it begins a unit, else it is one with the piece before it; -1 where it does in any case. ``questions``: their numbers.
    """

    def __init__(self, text: str, questions: dict[tuple, int] | None = None):
        self.starts, self.ends, self.gates = [], [], []
        self.questions = {} if questions is None else questions
        self.evidence = Evidence()
        parts = paragraphs(text)
        head = head_length(text, parts)
        thai = is_thai(text)
        todo, read = [], []
        for i, (a, b) in enumerate(parts):
            p = text[a:b]
            here = thai and is_thai(p)
            line = is_line(p) and (not here or DOCKET.search(p) is not None)
            if i < head or line and not STOPS.search(p):
                self.starts.append(a)
                self.ends.append(b)
                self.gates.append(-1)
                continue
            strict = line and not is_loud(p)
            if not strict and not here:
                read.append(p)
            todo.append((p, a, here, strict))
        if read:
            self.evidence.read(*read)
        self.plain = self.evidence.plain
        self.lower, self.digit, self.other, self.end, self.begun, self.follows = self.evidence.counts
        for item in todo:
            self._cut(*item)

    def _cut(self, p: str, base: int, thai: bool, strict: bool) -> None:
        number = NUMBER.match(p)
        start, size = 0, len(p)
        fresh = free = number.end() if number else 0  # where the text of the present sentence begins, and what is not yet read
        earlier = 0  # where it begins if the open boundary before it is none
        gate: tuple | None = None
        starts, ends_at, gates, ask = self.starts, self.ends, self.gates, self.questions
        for m in (THAI_MARKS if thai else MARKS).finditer(p, fresh):
            s = m.start()
            if s < free:
                continue
            c = p[s]
            end, ends = 0, False
            if c == ".":
                end = e = s + 1
                after = p[e : e + 1]
                following = TOO_FAR
                if after == " ":
                    blank = p.find(" ", e + 1)
                    following = _next[p[e + 1 : blank] if blank > 0 else p[e + 1 :]]
                    if following[0] is None:
                        continue
                if following is not TOO_FAR:
                    free = e
                    at = p.rfind(" ", 0, s) + 1
                    ends = (self._line_ends if strict else self._stop_ends)(p, at, s, e + 1, _stop[p[at:s]], following)
                elif after.isdigit() or after.islower():
                    continue
                else:
                    if after and after in TERMINATORS:
                        e = STOPS.match(p, s).end()
                    end = free = closed = self._closers(p, e) if after in CLOSERS or e > s + 1 else e
                    ends = closed < size and self._ends(p, s, e, closed, strict)
            elif c in QUOTES:
                span = QUOTES[c].match(p, s)
                if span:
                    end = free = span.end()
                    if free < size and not strict and (free == s + 2 or p[free - 2] in QUOTE_ENDS):
                        ends = self._quote_ends(p, fresh, s, free, thai)
                        if gate and s == fresh:
                            ends = self._either(gate, ends, self._quote_ends(p, earlier, s, free, thai))
            elif c in BRACKETS:
                span = BRACKETS[c].match(p, s)
                if span:
                    end = free = span.end()
                    if free < size and s == fresh and not strict and p[free - 2] in TERMINATORS and not PLACEHOLDER.fullmatch(p, s, free) and not self._goes_on(p, free):
                        ends = self._either(gate, True, False)
            elif c.isspace():
                end, free, ends = s, m.end(), True
            elif c in GREEK_QUESTIONS:
                free = s + 1
                if free < size and not strict and GREEK.search(p, fresh, s):
                    free = end = self._closers(p, free)
                    ends = True
            else:
                e = STOPS.match(p, s).end()
                end = free = closed = self._closers(p, e)
                ends = closed < size and self._ends(p, s, e, closed, strict)
            if ends is False:
                continue
            if free < size and p[free] == " ":
                free += 1
            while free < size and p[free].isspace():
                free += 1
            if free >= size:
                break
            starts.append(base + start)
            ends_at.append(base + end)
            gates.append(-1 if gate is None else ask.setdefault(gate, len(ask)))
            if ends is True:
                gate = None
            else:
                gate, earlier = ends, fresh
            start = fresh = free
        starts.append(base + start)
        ends_at.append(base + size)
        gates.append(-1 if gate is None else ask.setdefault(gate, len(ask)))

    @staticmethod
    def _either(gate: tuple | None, if_cut: bool, if_not: bool) -> bool | tuple:
        """A boundary that may depend on the open one just before it."""
        return if_cut if gate is None or if_cut == if_not else gate if if_cut else (*gate[:-1], not gate[-1])

    @staticmethod
    def _closers(p: str, e: int) -> int:
        """The position after the closing marks at e; a mark that may open as well closes only before a blank or the end."""
        size = len(p)
        while e < size and p[e] in CLOSERS and not (p[e] in "\"'“‘" and e + 1 < size and not p[e + 1].isspace()):
            e += 1
        return e

    @staticmethod
    def _goes_on(p: str, e: int) -> bool:
        """Whether what follows position e plainly continues the sentence."""
        e = BLANKS.match(p, e).end()
        first = p[e : e + 1]
        return first in CONTINUES or first in TERMINATORS or (first.islower() and not LOWER_START.match(p, e))

    def _quote_ends(self, p: str, fresh: int, s: int, e: int, thai: bool) -> bool:
        """Whether the sentence that begins at ``fresh`` ends with the quotation p[s:e]."""
        inner = p[s + 1 : e - 1].rstrip(BEFORE_QUOTE)
        if inner[-1:] not in TERMINATORS or thai or self._goes_on(p, e):
            return False
        at = BLANKS.match(p, e).end()
        after = p[at : at + 1]
        lead = p[fresh:s].rstrip()
        if after.isupper() or not after.isalpha():
            # a quotation may follow a quotation; in scripts with case one that opens a sentence ends it before a capital
            return bool(lead) or after.isupper()
        if "぀" <= after <= "ヿ":
            return False
        return lead[-1:] in ":：,，،、" and bool(lead)

    def _ends(self, p: str, s: int, e: int, closed: int, strict: bool) -> bool | tuple:
        """Whether the stop p[s:e], with the closers up to ``closed``, ends a sentence."""
        after = p[closed]
        if e != s + 1 or p[s] != ".":
            stop = p[s:e]
            if STRONG.intersection(stop):
                return not strict and after not in CONTINUES
            if e != s + 1 or stop == "…":
                at = BLANKS.match(p, closed).end()
                nxt = p[at : at + 1]
                return not strict and (nxt.isupper() or nxt in "¿¡" and bool(nxt))
        token = TOKEN.match(p, closed)[1]
        following = _next[token]
        if following[0] is None:
            return False
        at = p.rfind(" ", 0, s) + 1
        stop = _stop[p[at:s]]
        word = stop[1]
        if not after.isspace():  # a boundary may lack its blank
            if after.isalpha():
                tail = word[-4:]
                if not after.isupper() or len(word) < 2 or not word[-1].islower() and not word[-1].isdigit() or "." in word and not ANY_NUMBER.fullmatch(word):
                    return False
                if token[1:2] in "." and (len(tail) < 4 or not tail.isalpha()):
                    return False
            elif after not in OPENERS:
                return False
        return (self._line_ends if strict else self._stop_ends)(p, at, s, closed, stop, following)

    @staticmethod
    def _word_before(p: str, at: int) -> str:
        """The last word that ends before position ``at``."""
        while at and p[at - 1].isspace():
            at -= 1
        words = p[p.rfind(" ", 0, at) + 1 : at].split()
        return words[-1] if words else ""

    def _line_ends(self, p: str, at: int, s: int, closed: int, stop: tuple, following: tuple) -> bool | tuple:
        """``_stop_ends`` in what may be a line of its own: only after a word that is not short and in lower case."""
        kind, word, form = stop
        if kind == NO_STOP or len(word) < 4 or not word.isalpha() or not word[0].islower() or not TOKEN.match(p, closed)[1][:1].isupper():
            return False
        abbr, form = self._told(word, form)
        return not abbr if abbr is not None else (word, None, form, NO, None, False, False)

    def _stop_ends(self, p: str, at: int, s: int, closed: int, stop: tuple, following: tuple) -> bool | tuple:
        """The same for a full stop at ``s`` with p[at:s] before it and what follows at or after ``closed``; ``stop``: of ``_stop``, ``following``: of ``_next``."""
        kind, word, form = stop
        then, starter, small = following
        if kind == WORD:
            abbr, form = self._told(word, form)
            if abbr is False:
                return True
        elif kind == LETTER:
            word = pair[self._word_before(p, at if "\n" not in p[at:s] else s - 1), word]
            abbr, form = True, self._told(word, 2 if "�" in word or "Ã" in word else 1)[1]
        elif kind != ORDINAL:
            return kind == OTHER_END
        else:
            token = TOKEN.match(p, closed)[1]
            if then == UNLESS_DIGITS or token[:1].islower():
                return False
            if token[:1] == "§":
                return True
            word, abbr, form, then, starter = None, True, 2, IF_STARTER, _bare[token]
            small = starter.lower()
        if then == IF_STARTER:
            if starter not in self.begun and (not small or small == starter or small not in self.plain):
                return word, abbr, form, then, starter, self.follows.get(starter, 0) <= 1, False
            if word is None:  # the document shows that the next word begins sentences
                return True
            then = YES
        elif then == IF_BRACKET:
            then = YES if self._is_sentence(p, BLANKS.match(p, closed).end()) else NO
        return False if abbr and then == NO else (word, abbr, form, then, None, False, False)

    def _told(self, word: str, form: int) -> tuple[bool | None, int]:
        """What the document shows about a word before a stop: whether it is an abbreviation, None if nothing, or both; and what its uncertain
        occurrences (before digits), or else its form, say where the corpus knows too little."""
        lower = self.lower.get(word, 0)
        inside = lower + self.digit.get(word, 0)
        plain = word in self.plain
        if not inside:
            return (False if plain else None), form
        ends = word in self.end
        return (None if plain or ends or not lower else True), (1 if not ends and inside >= self.other.get(word, 0) else form)

    @staticmethod
    def _is_sentence(p: str, s: int) -> bool:
        """Whether the bracket that opens at s holds a whole sentence."""
        m = BRACKETS[p[s]].match(p, s)
        return m is not None and m[0][-2] in TERMINATORS and m[0][1:2].isupper() and m[0].count(" ") > 3


def units(text: str, words: dict[str, tuple[bool, bool, bool]], starters: dict[str, float]) -> list[int]:
    """Start, end, start, end, ... of the units of one text, with a given corpus."""
    doc = Document(text)
    answers = [settle(Open(*q), words, starters) for q in doc.questions]
    out: list[tuple[int, int]] = []
    for a, b, gate in zip(doc.starts, doc.ends, doc.gates):
        if gate < 0 or answers[gate]:
            out.append((a, b))
        else:
            out[-1] = (out[-1][0], b)
    return [x for unit in sorted(out) for x in unit]


OPEN_TYPES = [pa.string(), pa.bool_(), pa.int32(), pa.int32(), pa.string(), pa.bool_(), pa.bool_()]
COUNTS = ["n0", "n1", "n2", "n3"]
TEXTS_IN_GROUP = 250


class Group:
    """What some texts, read together, come to.

    ``starts``, ``ends``, ``gates``: of ``Document``, for one text after the other; ``piece_of``: how many pieces each text has.
    ``questions``: the different open boundaries; ``seen``: evidence for the corpus.
    """

    def __init__(self, texts: Iterable[str | None]):
        self.starts, self.ends, self.gates, self.piece_of = [], [], [], []
        self.questions: dict[tuple, int] = {}
        self.seen = Evidence()
        for text in texts:
            if not text:
                self.piece_of.append(0)
                continue
            doc = Document(text, self.questions)
            self.starts += doc.starts
            self.ends += doc.ends
            self.gates += doc.gates
            self.piece_of.append(len(doc.starts))
            self.seen.add(doc.evidence)


def _one(values: list, kind: pa.DataType) -> pa.Array:
    """A column of one row that holds a list."""
    return pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values if isinstance(values, pa.Array) else pa.array(values, kind))


def _layout(ident: pa.DataType) -> list[tuple[str, pa.DataType]]:
    lists = [("idents", ident), ("starts_at", pa.int64()), ("ends_at", pa.int64()), ("gates", pa.int32()), ("piece_of", pa.int32())]
    return [
        ("kind", pa.string()), ("grp", pa.int64()), *[(n, pa.list_(t)) for n, t in lists], ("question", pa.int32()), *zip(Open._fields, OPEN_TYPES),
        ("counted", pa.string()), *[(n, pa.int64()) for n in COUNTS],
    ]


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(ident, text) -> rows of three kinds: groups of texts, questions about open boundaries, counts of words."""
    context = TaskContext.get()
    number = (context.partitionId() if context else 0) << 32
    for whole in batches:
        layout = _layout(whole.schema.field(0).type)
        for at in range(0, whole.num_rows, TEXTS_IN_GROUP):
            batch = whole.slice(at, TEXTS_IN_GROUP)
            number += 1
            group = Group(batch.column(1).to_pylist())
            seen = group.seen
            counts = [(f"stop {w}", *c) for w, c in seen.before.items()]
            starts, follows = seen.starts, seen.follows
            counts += [(f"start {w}", starts.get(w, 0), follows.get(w, 0), 0, 0) for w in starts.keys() | follows.keys()]
            lists = ("starts", "ends", "gates", "piece_of")
            kinds = [t.value_type for _, t in layout[3:7]]
            yield _rows(layout, "group", 1, {"grp": [number], "idents": _one(batch.column(0), None), **{n: _one(getattr(group, a), t) for (n, _), a, t in zip(layout[3:7], lists, kinds)}})
            if group.questions:
                asked = dict(zip(Open._fields, zip(*group.questions)))
                yield _rows(layout, "question", len(group.questions), {"grp": [number] * len(group.questions), "question": list(group.questions.values()), **asked})
            if counts:
                yield _rows(layout, "count", len(counts), dict(zip(["counted", *COUNTS], zip(*counts))))


def _rows(layout: list[tuple[str, pa.DataType]], kind: str, size: int, columns: dict) -> pa.RecordBatch:
    """Rows of one kind, with nulls in the columns of the others."""
    out = []
    for name, t in layout:
        c = [kind] * size if name == "kind" else columns.get(name)
        out.append(pa.nulls(size, t) if c is None else c if isinstance(c, pa.Array) else pa.array(c, t))
    return pa.RecordBatch.from_arrays(out, [n for n, _ in layout])


def _place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Groups with the answers to their questions -> (ident, start_char, end_char)."""
    for batch in batches:
        for i in range(batch.num_rows):
            idents, starts, ends, gates, piece_of, answers = (batch.column(c)[i].values for c in range(6))
            starts, ends, gates = (x.to_numpy() for x in (starts, ends, gates))
            cuts = gates < 0
            if answers is not None:
                cuts |= answers.to_numpy(zero_copy_only=False)[gates]  # a gate of -1 is true before
            first = np.flatnonzero(cuts)
            last = np.append(first[1:], len(starts))[: len(first)] - 1
            owners = np.repeat(np.arange(len(idents)), piece_of.to_numpy())[first]
            yield pa.RecordBatch.from_arrays([idents.take(pa.array(owners)), pa.array(starts[first]), pa.array(ends[last])], ["ident", "start_char", "end_char"])


def corpus_words(counts: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Verdicts on words before stops (c_word, c_abbr, c_may_end, c_digits), and rates of words that begin sentences (c_starter, c_rate), of (counted, n0, n1, n2, n3).

    A word needs LEAST_COUNT certain or uncertain occurrences before stops, a starter LEAST_STARTS. ``verdict`` is the same for one word.
    """
    sums = counts.groupBy("counted").agg(*[F.sum(c).alias(c) for c in COUNTS]).withColumn("n", F.expr("n0 + n1 + n2 + n3")).where(F.col("n") >= LEAST_COUNT)
    kind, word = F.substring_index("counted", " ", 1), F.expr("substring(counted, instr(counted, ' ') + 1)")
    lower, digit, end, total = (F.col(c) for c in ("n0", "n1", "n3", "n"))
    inside = lower + digit
    initial = F.substring(F.reverse("c_word"), 2, 1) == " "
    abbr = initial | ~((end > 0) & (inside <= 0.1 * total) & (end >= 0.08 * total))
    stops = sums.where(kind == "stop").select(word.alias("c_word"), *COUNTS, "n").where(initial | (inside > 0) | (total >= SURE))
    may_end = F.when(initial, end > 0.01 * total).when(~abbr, True).otherwise((end >= 0.004 * total) & (end > 0))
    words = stops.select("c_word", abbr.alias("c_abbr"), may_end.alias("c_may_end"), (abbr & (digit > 0.1 * total)).alias("c_digits"))
    starters = sums.where(kind == "start").where(total >= LEAST_STARTS).select(word.alias("c_starter"), (F.col("n0") / total).alias("c_rate"))
    return words, starters


def _settled() -> Column:
    """``settle`` on columns of a piece joined with the corpus's words and starters."""
    known = F.col("c_word").isNotNull()
    by_corpus = F.when(known, F.col("c_abbr")).otherwise(F.col("form") > 0)
    trusted = F.coalesce(F.col("abbr") & ~by_corpus, F.lit(False))
    may_end = F.when(trusted, False).when(known, F.col("c_may_end")).otherwise(F.col("form") != 1)
    digits = F.when(known, F.col("c_digits")).otherwise(F.col("form") == 2)
    starts = F.coalesce(F.col("c_rate") >= LEAST_RATE, F.col("starts"))
    ends = (
        F.when(~F.coalesce("abbr", by_corpus), True).when(~may_end | (F.col("then") == NO), False)
        .when(F.col("then") == UNLESS_DIGITS, ~digits).otherwise((F.col("then") == YES) | starts)
    )
    return ends != F.col("negate")


def sentence_units(docs: DataFrame, ident: str, text: str) -> DataFrame:
    """(ident, start_char, end_char): the sentence units of each text, as offsets in code points from 0.

    A unit reaches from its first non-blank character to just after its last. Null, empty and blank texts have none. One pass
    over the texts and no shuffle of them: only word counts and the different questions of each group of texts are.
    """
    spark = docs.sparkSession
    small_batches(spark)
    rows = docs.select(ident, text)
    field = rows.schema[ident]
    box = Scratch(spark, "sentences")
    kind = T.StructType([T.StructField(n, field.dataType if n == "ident" else from_arrow_type(t)) for n, t in _layout(to_arrow_type(field.dataType))])
    read = box.table(rows.mapInArrow(_read, kind), "read", ["kind"])
    words, starters = (box.table(t, n) for t, n in zip(corpus_words(read.where("kind = 'count'")), ("words", "starters")))
    asked = read.where("kind = 'question'").select("grp", "question", *Open._fields)
    asked = asked.join(words, F.col("word") == F.col("c_word"), "left").join(starters, F.col("starter") == F.col("c_starter"), "left")
    told = asked.select("grp", F.struct("question", _settled().alias("cut")).alias("q")).groupBy("grp").agg(F.transform(F.array_sort(F.collect_list("q")), lambda q: q["cut"]).alias("answers"))
    told = box.table(told, "answers").withColumnRenamed("grp", "a_grp")
    groups = read.where("kind = 'group'").join(told, F.col("grp") == F.col("a_grp"), "left").select(*[n for n, _ in _layout(pa.int64())[2:7]], "answers")
    placed = groups.mapInArrow(_place, T.StructType([T.StructField("ident", field.dataType), T.StructField("start_char", T.LongType()), T.StructField("end_char", T.LongType())]))
    return placed.withColumnRenamed("ident", ident)
