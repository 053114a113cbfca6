"""Personal data, disguised or not, with exact places in the source text.

Three transducers rewrite the text into a normal form: single characters (homoglyphs, full-width
forms, invisible signs), spelled digits, and spelled-out "at" and "dot". Each rewrite is a
piece (source start, source end, output), so any span of the normal form can be mapped back
to the source. Identifiers are sought in the source as it stands (base) and in the normal form;
what the normal form adds counts where it overlaps no base span of its kind.

Places are code points, ends exclusive. Defined results: a null text is an empty one and has no
spans; repeated rows give repeated results; nothing is cut, however long a text is.
"""

from __future__ import annotations

import hashlib
import re
import unicodedata
from bisect import bisect_left, bisect_right
from collections.abc import Iterator
from functools import cache

import pyarrow as pa
from pyspark.sql import DataFrame

from feedlake.llm.rows import map_slices, pick, same_length_lower

KINDS = ("email", "ip", "card", "phone")

# --- base: leftmost non-overlapping matches of one pattern per kind, then a test ----------

_LOCAL = re.compile(r"[A-Za-z0-9._%+-]+")
_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# Digits are taken greedily, so a match that starts inside a run of digits cannot be leftmost.
_IP = re.compile(r"(?<![0-9])[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+")
_CARD = re.compile(r"(?<![0-9])[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_NOT_DIGIT = re.compile(r"[^0-9]")
_DOUBLED = str.maketrans("0123456789", "0246813579")


def luhn(digits: str) -> bool:
    total = sum(map(int, digits[-1::-2])) + sum(map(int, digits[-2::-2].translate(_DOUBLED)))
    return total % 10 == 0


def emails(text: str) -> Iterator[tuple[int, int]]:
    """Matches of ``[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\\.[A-Za-z0-9-]+)+``, found from the @ signs.

    A run of local characters that no @ follows is passed over once, not once per start.
    """
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and _LOCAL_CHARS[text[start - 1]]:
            start -= 1
        domain = _DOMAIN.match(text, at) if start < at else None
        if domain:
            done = domain.end()
            yield start, done
        at = text.find("@", max(at + 1, done))


class _Chars(dict):
    def __missing__(self, char: str) -> bool:
        return False


_LOCAL_CHARS = _Chars({chr(i): True for i in range(128) if _LOCAL.match(chr(i))})


def _ip_ok(found: str) -> bool:
    parts = [p.lstrip("0") for p in found.split(".")]
    return all(len(p) < 4 and int(p or 0) <= 255 for p in parts)


def _card_ok(found: str) -> bool:
    digits = _NOT_DIGIT.sub("", found)
    return 16 <= len(digits) <= 19 and luhn(digits)


def _phone_ok(found: str) -> bool:
    return 8 <= len(_NOT_DIGIT.sub("", found)) <= 15


_TESTED = ((1, _IP, _ip_ok), (2, _CARD, _card_ok), (3, _PHONE, _phone_ok))

Span = tuple[int, int, int]  # kind as its place in KINDS, start, end


def base_spans(text: str) -> list[Span]:
    """All spans of the text as it stands, by kind and start."""
    out = [(0, a, b) for a, b in emails(text)] if "@" in text else []
    for kind, pattern, good in _TESTED:
        if kind == 3 and "+" not in text:
            continue
        out += [(kind, m.start(), m.end()) for m in pattern.finditer(text) if good(m.group())]
    return out


# --- transducers ----------------------------------------------------------------------------

# Letters that look like a Latin one, in the order of the alphabets.
CYRILLIC = dict(zip("авгеікмнорстухѕјԁһԛԝАВЕІКМНОРСТУХЅЈ", "abreikmhopctyxsjdhqwABEIKMHOPCTYXSJ", strict=True))
GREEK = dict(zip("αικνορτυχΑΒΕΖΗΙΚΜΝΟΡΤΥΧ", "aikvoptuxABEZHIKMNOPTYX", strict=True))
# Signs that stand for one of an identifier's own signs.
SIGNS = {"․": ".", "。": ".", "．": ".", "｡": ".", "‐": "-", "‑": "-", "‒": "-", "–": "-", "−": "-", "＠": "@", "﹫": "@", "＋": "+", "﹢": "+", "（": "(", "）": ")", " ": " ", " ": " ", " ": " ", " ": " ", "　": " "}
# Characters without a width.
INVISIBLE = "­᠎​‌‍‎‏⁠﻿"

# Digits as words, English, French, German, Spanish.
WORDS = [
    ("zero oh zéro null cero", "0"), ("one un une eins ein uno", "1"), ("two deux zwei zwo dos", "2"),
    ("three trois drei tres", "3"), ("four quatre vier cuatro", "4"), ("five cinq fünf cinco", "5"),
    ("six sechs seis", "6"), ("seven sept sieben siete", "7"), ("eight huit acht ocho", "8"),
    ("nine neuf neun nueve", "9"),
]
DIGIT_OF = {w: d for words, d in WORDS for w in words.split()}
#: So many digits in a row, words among them, read as a number. Fewer are ordinary prose.
LEAST_SPELLED = 7

# Fixed values: "at" and "dot" as words, and the last labels that make a bare "dot" one.
AT = ["at", "arobase", "arroba", "ät"]
DOT = ["dot", "point", "punkt", "punto"]
TOP_LEVEL = "com org net edu gov mil int info biz io co ai app dev me tv eu us uk de fr es it nl be ch at ca au in jp br ru pl se no fi dk pt ie mx test example invalid localhost".split()


@cache
def _fold(char: str) -> str | None:
    """The form of one non-ASCII character inside an identifier; None to leave it."""
    if char in INVISIBLE:
        return ""
    plain = CYRILLIC.get(char) or GREEK.get(char) or SIGNS.get(char)
    if plain is None:
        if unicodedata.category(char) == "Nd":
            return str(unicodedata.digit(char))
        plain = unicodedata.normalize("NFKC", char)
        if len(plain) != 1 or not (plain.isascii() and plain.isprintable()) or plain == char:
            return None
    return plain


Piece = tuple[int, int, str]  # source start, source end, what stands there in the normal form

_FOREIGN = re.compile(r"[^\x00-\x7f]+")


def fold_chars(text: str) -> list[Piece]:
    """Homoglyphs and the like, one piece per character."""
    out = []
    for run in _FOREIGN.finditer(text):
        for i, char in enumerate(run.group(), run.start()):
            plain = _fold(char)
            if plain is not None:
                out.append((i, i + 1, plain))
    return out


_SEP = r"[\x20,./()-]{0,3}"
_DIGIT_WORD = "|".join(sorted(DIGIT_OF, key=len, reverse=True))
_ANY_WORD = re.compile(rf"\b(?:{_DIGIT_WORD})\b")
_ITEM = re.compile(rf"\b(?:{_DIGIT_WORD})\b|[0-9]")
# Words for the same digit several times, and for the sign of a phone number.
TIMES = {"double": 2, "triple": 3}
PLUS = ["plus", "más", "mas"]
_TIMES, _PLUS = "|".join(TIMES), "|".join(PLUS)
_RUN_ITEM = rf"(?:\b(?:{_TIMES})\x20)?(?:\b(?:{_DIGIT_WORD})\b|[0-9])"
_SPELLED = re.compile(rf"(?:\+\x20?|\b(?:{_PLUS})\x20)?{_RUN_ITEM}(?:{_SEP}{_RUN_ITEM})*")
_SIGN = re.compile(rf"\+|(?:{_PLUS})\b")
_OF_RUN = re.compile(_RUN_ITEM)
#: A word at the end of what stands before a run that belongs to it.
_BEFORE = re.compile(rf"\b(?:{_PLUS}|{_TIMES})\Z")
_LONGEST_BEFORE = max(map(len, [*PLUS, *TIMES]))


def _digits(item: str) -> str:
    """The digits that an item of a run stands for."""
    *times, last = item.split(" ")
    return DIGIT_OF.get(last, last) * (TIMES[times[0]] if times else 1)


def _run_start(text: str, start: int, at: int) -> int:
    """Back from a word, but not before ``at``: over digits, separators and the words that may stand between."""
    while True:
        while start > at and text[start - 1] in "0123456789 ,./()-+":
            start -= 1
        before = _BEFORE.search(text, max(at, start - _LONGEST_BEFORE), start)
        if not before:
            return start
        start = before.start()


def fold_digits(text: str) -> list[Piece]:
    """Words for digits inside a run of at least ``LEAST_SPELLED`` digits, "double" and "plus" among them."""
    text, out, at = same_length_lower(text), [], 0
    while word := _ANY_WORD.search(text, at):
        # The run around the word: back over digits and separators, then on from there.
        run = None
        for m in _SPELLED.finditer(text, _run_start(text, word.start(), at)):
            if m.end() > word.start():
                run = m
                break
        if run is None:
            at = word.end()
            continue
        items = [(m.start(), m.end(), m.group()) for m in _OF_RUN.finditer(text, run.start(), run.end())]
        if sum(len(_digits(item)) for _, _, item in items) >= LEAST_SPELLED and run.start() <= word.start():
            sign = _SIGN.match(text, run.start())
            if sign and text[sign.start() : items[0][0]] != "+":
                out.append((sign.start(), items[0][0], "+"))
            last = None
            for a, b, item in items:
                # Blanks between two words go, so that the digits stand together.
                if last is not None and len(item) > 1 and last[1] < a and text[last[1] : a].strip(" ,") == "" and last[2]:
                    out.append((last[1], a, ""))
                if len(item) > 1:
                    out.append((a, b, _digits(item)))
                last = a, b, len(item) > 1
        at = max(run.end(), word.end())
    return out


_AT = "|".join(AT)
_DOT = "|".join(DOT)
_OPEN, _CLOSE = r"[\[({<]", r"[\])}>]"
_WRAPPED_AT = re.compile(rf"\x20{{0,2}}{_OPEN}\x20?(?:{_AT}|@)\x20?{_CLOSE}\x20{{0,2}}|(?<=[A-Za-z0-9])[_*-]{{1,2}}(?:{_AT})[_*-]{{1,2}}(?=[A-Za-z0-9])|&#0*64;|&commat;|%40")
_WRAPPED_DOT = re.compile(rf"\x20{{0,2}}{_OPEN}\x20?(?:{_DOT}|\.)\x20?{_CLOSE}\x20{{0,2}}|(?<=[A-Za-z0-9])[_*-]{{1,2}}(?:{_DOT})[_*-]{{1,2}}(?=[A-Za-z0-9])|&#0*46;|&period;")
_SEP_DOT = rf"(?:\.|\x20\.\x20|\x20{{1,2}}(?:{_DOT})\x20{{1,2}})"
#: Behind "dot", which hardly ever is prose there, the last label may be any; the other words are prose too.
_LAST = rf"(?:{_SEP_DOT}(?:{'|'.join(TOP_LEVEL)})|\x20{{1,2}}dot\x20{{1,2}}[A-Za-z]{{2,}})(?![A-Za-z0-9-])"
#: name at host dot com: bare words count only with all of it, down to a known last label.
_BARE = re.compile(
    rf"(?<![A-Za-z0-9._%+-])[A-Za-z0-9_%+-]+(?:{_SEP_DOT}[A-Za-z0-9_%+-]+)*"
    rf"(?P<at>\x20{{1,2}}(?:{_AT})\x20{{1,2}}|\x20?@\x20?)"
    rf"[A-Za-z0-9-]+(?:{_SEP_DOT}[A-Za-z0-9-]+)*{_LAST}",
)
_SPACED_AT = re.compile(rf"\x20?@\x20?(?=[A-Za-z0-9-]+(?:{_SEP_DOT}[A-Za-z0-9-]+)*{_LAST})")
_BARE_DOT = re.compile(rf"\x20{{1,2}}(?:{_DOT})\x20{{1,2}}|\x20\.\x20")
_DOTTED = re.compile(rf"(?<![0-9.])[0-9]{{1,3}}(?:{_SEP_DOT}[0-9]{{1,3}}){{3}}(?![0-9]|\.[0-9])")
_ITEM_OF_QUAD = rf"(?:\b(?:{_DIGIT_WORD})\b|[0-9])"
_PART = rf"{_ITEM_OF_QUAD}(?:\x20?{_ITEM_OF_QUAD}){{0,2}}"
#: Four numbers with dots between them; ``fold_quads`` wants a word for a digit among them.
_QUAD = re.compile(rf"(?<![A-Za-z0-9.])({_PART})({_SEP_DOT})({_PART})({_SEP_DOT})({_PART})({_SEP_DOT})({_PART})(?![A-Za-z0-9]|\.[A-Za-z0-9])")
_DIGIT_BY_DOT = re.compile(rf"(?:{_DIGIT_WORD})(?=\.[a-z0-9]|\x20\.\x20|\x20{{1,2}}(?:{_DOT})\x20)|(?:[0-9a-z]\.|\x20\.\x20|\x20(?:{_DOT})\x20{{1,2}})(?:{_DIGIT_WORD})\b")
_HINT_AT = re.compile(rf"[@%;]|(?:{_AT})[\])}}>_*\x20-]|&commat")
_HINT_DOT = re.compile(rf"(?:{_DOT})[\])}}>_*\x20-]|&#0*46;|&period;|[\[({{<]\x20?\.")
#: A bare "at" and a whole host behind it, however long.
_HOST_AFTER_AT = re.compile(rf"\x20{{1,2}}(?:{_AT})\x20{{1,2}}(?=[A-Za-z0-9-]+(?:{_SEP_DOT}[A-Za-z0-9-]+)*{_LAST})")
_DOT_WORD = re.compile(rf"\x20(?:{_DOT})\x20")
_LABEL_CHARS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789_%+-")
_DOT_BEFORE = re.compile(rf"{_SEP_DOT}\Z")
_LONGEST_DOT = max(map(len, DOT)) + 4


def fold_quads(text: str) -> list[Piece]:
    """Words for digits in a whole dotted quad, however few digits it has."""
    text, out = same_length_lower(text), []
    if not _DIGIT_BY_DOT.search(text):
        return out
    for found in _QUAD.finditer(text):
        pieces, numbers = [], []
        for group in range(1, 8):
            a, b = found.span(group)
            if group % 2 == 0:
                pieces.append((a, b, "."))
                continue
            items = [_ITEM.match(text, a)]
            while items[-1].end() < b:
                end = items[-1].end()
                items.append(_ITEM.match(text, end) or _ITEM.match(text, end + 1))
                pieces += [(end, items[-1].start(), "")] * (items[-1].start() > end)
            digits = [DIGIT_OF.get(x.group(), x.group()) for x in items]
            pieces += [(x.start(), x.end(), d) for x, d in zip(items, digits, strict=True) if d != x.group()]
            numbers.append(int("".join(digits)))
        if max(numbers) <= 255 and any(len(x) > 1 for x in _ITEM.findall(found.group())):
            out += [p for p in pieces if text[p[0] : p[1]] != p[2]]
    return out


def fold_at_dot(text: str) -> list[Piece]:
    """Words and signs that stand for @ and for a dot."""
    text, out = same_length_lower(text), []
    wrapped_dot, dot_words = _HINT_DOT.search(text), _DOT_WORD.search(text)
    if _HINT_AT.search(text):
        out += [(m.start(), m.end(), "@") for m in _WRAPPED_AT.finditer(text)]
    if wrapped_dot:
        out += [(m.start(), m.end(), ".") for m in _WRAPPED_DOT.finditer(text)]
    # A bare "at" counts only where a host with a dot word follows it, an @ where a host does.
    places = [m.start() for m in _SPACED_AT.finditer(text)] if "@" in text else []
    places += [m.start() for m in _HOST_AFTER_AT.finditer(text)] if dot_words else []
    for found in filter(None, (_whole_address(text, at) for at in places)):
        a, b = found.span("at")
        out.append((a, b, "@"))
        for start, end in ((found.start(), a), (b, found.end())):
            out += [(x.start(), x.end(), ".") for x in _BARE_DOT.finditer(text, start, end)]
    for found in _DOTTED.finditer(text) if dot_words else ():
        out += [(x.start(), x.end(), ".") for x in _BARE_DOT.finditer(text, found.start(), found.end())]
    return out


def _whole_address(text: str, at: int) -> re.Match | None:
    """The disguised address whose "at" begins at ``at``, with the longest local part."""
    start = begin = at
    while True:
        # Back over a label, then over the dot before it, as long as there are both.
        while begin and text[begin - 1] in _LABEL_CHARS:
            begin -= 1
        if begin == start or not (dot := _DOT_BEFORE.search(text, max(0, begin - _LONGEST_DOT), begin)):
            break
        start, begin = begin, dot.start()
        if not begin or text[begin - 1] not in _LABEL_CHARS:
            begin = start
            break
    found = _BARE.match(text, begin) if begin < at else None
    return found if found and found.start("at") == at else None


class Rewritten:
    """A text after rewriting pieces of it, with the way back to the source."""

    def __init__(self, text: str, pieces: list[Piece]):
        out, at, to = [], 0, 0
        #: For each stretch of the output: where it begins, its source start and end, whether copied.
        self.begins: list[int] = []
        self.stretch: list[tuple[int, int, bool]] = []
        for a, b, new in sorted(pieces):
            if a < at:
                continue  # of overlapping pieces the first stands
            if a > at:
                self._add(to, at, a, True)
                out.append(text[at:a])
                to += a - at
            if new:
                self._add(to, a, b, False)
                out.append(new)
                to += len(new)
            at = b
        self._add(to, at, len(text), True)
        out.append(text[at:])
        self.text = "".join(out)

    def _add(self, to: int, a: int, b: int, copied: bool) -> None:
        self.begins.append(to)
        self.stretch.append((a, b, copied))

    def source(self, start: int, end: int) -> tuple[int, int]:
        """The source characters that the span ``start:end`` of the output came from."""
        i, j = bisect_right(self.begins, start) - 1, bisect_right(self.begins, end - 1) - 1
        a, _, copied = self.stretch[i]
        first = a + (start - self.begins[i]) * copied
        a, b, copied = self.stretch[j]
        return first, a + end - self.begins[j] if copied else b


def added_spans(text: str, base: list[Span]) -> list[Span]:
    """What the transducers bring to light and no base span of the same kind overlaps."""
    steps: list[Rewritten] = []
    now = text
    for transduce in (fold_chars, fold_quads, fold_digits, fold_at_dot):
        pieces = transduce(now) if transduce is not fold_chars or not now.isascii() else []
        if pieces:
            steps.append(Rewritten(now, pieces))
            now = steps[-1].text
    if not steps:
        return []
    taken: dict[int, list[tuple[int, int]]] = {}
    for kind, a, b in base:
        taken.setdefault(kind, []).append((a, b))
    out = []
    for kind, a, b in base_spans(now):
        for step in reversed(steps):
            a, b = step.source(a, b)
        own = taken.setdefault(kind, [])
        i = bisect_left(own, (a, a))
        if (i < len(own) and own[i][0] < b) or (i and own[i - 1][1] > a):
            continue
        own.insert(i, (a, b))
        out.append((kind, a, b))
    return out


def joined(spans: list[Span]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for k, a, b in sorted(spans))


def find_pii(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, base, added): both arrays of (kind, start, end, text) by kind and start."""
    docs = pick(df, id=id_col, text=text_col)
    span = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("text", pa.string())])

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        found: tuple[list, list] = ([], [])
        for text in batch.column("text").to_pylist():
            text = text or ""
            base = base_spans(text)
            for out, spans in zip(found, (base, sorted(added_spans(text, base))), strict=True):
                out.append([{"kind": KINDS[k], "start": a, "end": b, "text": text[a:b]} for k, a, b in spans])
        arrays = [pa.array(x, pa.list_(span)) for x in found]
        return pa.record_batch([batch.column("id"), *arrays], ["id", "base", "added"])

    kind = docs.schema["id"].dataType.simpleString()
    spans = "array<struct<kind:string,start:bigint,end:bigint,text:string>>"
    return map_slices(docs, work, f"id {kind}, base {spans}, added {spans}").withColumnRenamed("id", id_col)


def digest(text: str | None) -> tuple[list[int], str, str, int]:
    """Base counts by kind, SHA-256 of the base spans, all spans joined, and how many were added."""
    text = text or ""
    base = base_spans(text)
    added = added_spans(text, base)
    counts = [sum(k == kind for k, _, _ in base) for kind in range(len(KINDS))]
    return counts, hashlib.sha256(joined(base).encode()).hexdigest(), joined(base + added), len(added)
