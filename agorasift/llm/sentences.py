"""Sentence units across languages and scripts (problem 10).

Sentence-break rules on character properties: terminators of all scripts and closing quotes and
brackets by their Sentence_Break value, lower-case continuation, numbers. On top: abbreviations of
the languages the text is written in (told from the text, as tags are often wrong), direct speech inside a reporting
sentence, headings and list items, and spaces where a script writes no end marks.
"""

from __future__ import annotations

import re
from collections import Counter
from functools import cache, lru_cache
from typing import NamedTuple

import pandas as pd
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_EVERY = "".join(map(chr, (*range(0xD800), *range(0xE000, 0x30000))))
#: Terminators of all scripts by the Sentence_Break property (STerm, and ATerm but for the dot, which has rules of its own).
HARD = "".join(regex.findall(r"[\p{SB=STerm}\p{SB=ATerm}]", _EVERY)).replace(".", "").replace("\u2024", "")
#: Closing quotes and brackets: Sentence_Break=Close that does not open.
CLOSERS = "\"'" + "".join(regex.findall(r"[\p{SB=Close}&&[\p{Pe}\p{Pf}\u201f]]", _EVERY, regex.V1))
del _EVERY
_HARD_SET = frozenset(HARD)


class Rules(NamedTuple):
    """What a text of one kind is read by: its abbreviations, marks that may end, marks that close."""

    never: frozenset[str]
    end: re.Pattern
    close: re.Pattern


@cache
def _patterns(last: int) -> tuple[re.Pattern, re.Pattern]:
    """(end marks, closing marks) up to the code point ``last``: short classes for plain texts, as long ones are slow."""
    hard, closers = (re.escape("".join(c for c in x if ord(c) <= last)) for x in (HARD, CLOSERS))
    dots = "." if last < 128 else ".…"
    return re.compile(rf"(?:[{hard}{dots}](?:\s?[{hard}{dots}](?![^\W\d_]))*)", re.S), re.compile(rf"[{closers}]+")


def rules_of(text: str) -> Rules:
    last = 127 if text.isascii() else 0xFFFF if len(text.encode("utf-16-le", "surrogatepass")) == 2 * len(text) else 0x10FFFF
    return Rules(abbreviations_of(text), *_patterns(last))


_BLANK = re.compile(r"(?:\r?\n|\r|[ ])[^\S\n\r]*(?:(?:\r?\n|\r| )[^\S\n\r]*)+| |\f")
_MARKER = re.compile(r"[^\S\n]*(?:[-*•‣◦▪·–—+]|\(?\d{1,3}[.)]|\(?[A-Za-z]\)|\([ivx]{1,4}\)|[①-⑳])[^\S\n]+\S")
_SPANS = re.compile(r"“[^“”]{1,800}”|«[^«»]{1,800}»|„[^„“”]{1,800}[“”]|「[^「」]{1,800}」|『[^『』]{1,800}』|\"[^\"]{1,800}\"|(?<!\w)'[^']{1,120}[.!?]'(?!\w)|‘[^‘’]{1,200}[.!?]’(?!\w)|\([^()]{1,400}\)|（[^（）]{1,400}）")
_WORD = re.compile(r"[^\W_]+(?:['’.\-][^\W_]+)*")
# Abbreviations that never end a sentence, by language; those of "" hold in all.
ABBREVIATIONS = {
    "": "dr prof mr mrs ms st vs v cf",
    "en": "mx messrs mt ft sen rep gov lt col capt cpt gen maj sgt cmdr adm hon rev pres supt ald jas wm chas geo thos jos robt approx ca c i.e e.g viz u.s u.n u.k e.u",
    "de": "hr hrn fr frl bzw vgl z b z.b u d d.h h.c mio mrd tsd inkl exkl sog ggf evtl geb ca",
    "fr": "mme mlle mm m ex p.ex av",
    "es": "sr sra srta dra d dña ej p.ej ud uds gral lic ing av gen",
    "it": "sig sigg dott ing ecc",
    "pt": "sr sra exmo",
    "ru": "г ул д т е т.е п млн млрд тыс руб им стр см рис проф акад ред гл",
    "hi": "डॉ श्री श्रीमती प्रो पं",
    "ar": "د أ",
}
# Frequent small words that tell the languages of Latin script apart.
SMALL_WORDS = {
    "en": "the and of to in is was that for with on at by from it as are be this his her not but they we our",
    "de": "der die das und ist nicht ein eine mit von zu im den dem des für auf sich auch wir sie es",
    "fr": "le la les des et est une un du que qui dans pour pas sur au aux ne se il elle nous",
    "es": "el la los las y de que en un una por con para del se no es al lo su",
    "it": "il lo gli di e che un una per con del della non si è nel sono la i",
    "pt": "o a os as e de que em um uma por com para do da não se é no na",
}
_LANGUAGE_OF: dict[str, tuple[str, ...]] = {}
for _l, _w in SMALL_WORDS.items():
    for _x in _w.split():
        _LANGUAGE_OF[_x] = (*_LANGUAGE_OF.get(_x, ()), _l)
_SCRIPTS = (("ru", re.compile("[\u0400-\u04ff]")), ("hi", re.compile("[\u0900-\u097f]")), ("ar", re.compile("[\u0600-\u06ff]")))


@lru_cache(maxsize=256)
def _abbreviations(languages: frozenset[str]) -> frozenset[str]:
    return frozenset(w for l in ("", *languages) for w in ABBREVIATIONS[l].split())


def abbreviations_of(text: str) -> frozenset[str]:
    """Abbreviations of the languages that a text is written in, by its scripts and small words; of all of Latin script where it has none."""
    counts: Counter = Counter()
    for languages, n in Counter(map(_LANGUAGE_OF.get, text.lower().split())).items():
        for l in languages or ():
            counts[l] += n
    top = max(counts.values(), default=0)
    found = {l for l, n in counts.items() if n * 3 >= top} if top >= 2 else set(SMALL_WORDS)
    if not text.isascii():
        found |= {l for l, pattern in _SCRIPTS if pattern.search(text)}
    return _abbreviations(frozenset(found))


# Abbreviations that announce a number, and those that may end a sentence.
COUNTED = frozenset("no nos nr vol vols pp p pg fig figs sec secs ch chap art arts abs ver par para pág págs núm núms sect ed op kap bd सं n° jan feb mar apr jun jul aug sep sept oct nov dec".split())
MAYBE = frozenset("etc usw inc ltd co corp bros jr esq al rd ave blvd a.m p.m u.a др пр ph.d m.d b.a m.a llc".split())
AFTER_TIME = frozenset("sharp monday tuesday wednesday thursday friday saturday sunday january february march april may june july august september october november december est pst cst gmt utc".split())
DE_MONTHS = frozenset("januar jänner februar märz april mai juni juli august september oktober november dezember".split())
LEGAL = frozenset("inc ltd co corp llc plc bros".split())
REPORTING = frozenset("asked said says cried wrote replied shouted called added told answered whispered warned snapped insisted demanded muttered admitted declared exclaimed".split())
# Verbs that follow the speaker's name after a cry.
CRIED = frozenset("said says cried shouted replied whispered snapped exclaimed warned muttered yelled".split())
#: Words with which, in texts without capitals, a sentence goes on after an abbreviation.
GOES_ON = frozenset(
    "is was are were be been has had have do does did will would shall should can could may might must and or but nor yet so as than that which who whose whom of in on at by for from to with into over under "
    "about after before between through during against per via not also said says".split()
)
#: Words with which a sentence begins, where it is glued to the one before in a text without capitals.
BEGINS = frozenset("the a an this that these those it he she we they i you my our his her their its who what where when why how there here if but and so then no not all some both half two many most few dr mr mrs ms sen gov".split())
_NO_ENDS = re.compile("[฀-໿ក-៿ᨠ-᪯]")


def _next(text: str, at: int, stop: int) -> int:
    while at < stop and text[at].isspace():
        at += 1
    return at


def _caseless(ch: str) -> bool:
    return ch.isalpha() and ch.lower() == ch.upper()


def _abbreviation(text: str, start: int, dot: int, after: int, stop: int, low: bool, never: frozenset[str]) -> bool:
    """Does the dot at ``dot`` belong to an abbreviation that does not end the sentence?"""
    i = dot
    while i > start and not text[i - 1].isspace():
        i -= 1
    token = text[i:dot].lstrip("([{\"'“‘«„—–-")
    word = token.casefold()
    nxt = text[after] if after < stop else ""
    if not word:
        return False
    if len(token) == 1 and token.isalpha() and (token.isupper() or (low and nxt.isalpha() and word not in "hx")):
        return True
    tail = re.split(r"['’\-]", word)[-1]
    if word in never or tail in never:
        if word == "г" and re.search(r"\d{4}\s$", text[max(start, i - 6) : i]) and nxt.isupper():
            return False
        return True
    if word in COUNTED or tail in COUNTED:
        return nxt.isdigit() or (len(nxt) > 0 and word in ("fig", "art", "vol", "सं") and not nxt.isspace() and text[after : after + 2].strip(".").isupper() and len(text[after : after + 2].strip(".")) == 1)
    if word in MAYBE or (word.count(".") and len(word) <= 5 and all(len(x) == 1 for x in word.split("."))):
        m = _WORD.match(text, after, stop)
        w = m.group().casefold() if m else ""
        if word in ("a.m", "p.m") and w in AFTER_TIME:
            return True
        if w in LEGAL or (word not in MAYBE and nxt.isupper() and word not in ("a.m", "p.m")):
            return True
        return nxt.islower() and (not low or w in GOES_ON or word in ("etc", "al", "co"))
    if word.isdigit() and len(word) <= 2:
        m = _WORD.match(text, after, stop)
        return bool(m) and m.group().split(".")[0].casefold() in DE_MONTHS and m.group()[0].isupper()
    return False


def _speech_ends(text: str, start: int, a: int, b: int, stop: int, low: bool) -> bool:
    """Does a quotation or bracket text[a:b] whose last mark is a terminator end the sentence?"""
    after = _next(text, b, stop)
    if after >= stop:
        return True
    nxt = text[after]
    if nxt in ",;:，、；：-–—" or text[b : b + 1] in ("と", "か", "の", "は", "が", "を"):
        return False
    lead = text[start:a].rstrip()
    if text[a] in "(（":
        return not lead and not (nxt.islower() and not low)
    announced = lead[-1:] in (":", "：", ",", "，")
    if _caseless(nxt) or nxt in "「『“«":
        if _caseless(nxt):
            return bool(announced) and not (not lead)
        return True
    m = re.findall(r"[^\W_]+", text[after : after + 60])[:4]
    if nxt.islower():
        return low and (bool(announced) or (not lead and m[:1] and m[0] not in REPORTING))
    # a cry at the start, then a name and a verb of speech; other verbs may well begin a sentence of their own
    cry = text[a + 1 : b - 1].rstrip()[-1:] in "!?！？"
    return not (not lead and cry and any(w in CRIED for w in m[1:]))


def _running(text: str, start: int, stop: int, low: bool, rules: Rules, out: list[tuple[int, int]]) -> None:
    """Units of one paragraph of running text."""
    begin = _next(text, start, stop)
    spans: dict[int, int] = {}
    for m in _SPANS.finditer(text, start, stop):
        spans[m.start()] = m.end()
    inside = sorted(spans.items())
    k = 0
    pos = begin

    def emit(end: int) -> None:
        nonlocal begin
        e = end
        while e > begin and text[e - 1].isspace():
            e -= 1
        if e > begin:
            out.append((begin, e))
        begin = _next(text, end, stop)

    while pos < stop:
        m = rules.end.search(text, pos, stop)
        while k < len(inside) and (inside[k][1] <= pos):
            k += 1
        if k < len(inside) and (m is None or inside[k][0] < m.start()):
            a, b = inside[k]
            k += 1
            last = text[a + 1 : b - 1].rstrip()[-1:]
            if last and (last in _HARD_SET or last in ".…") and a >= begin:
                word = re.search(r"([^\s(]+)\.$", text[a:b - 1].rstrip())
                short = bool(word) and text[a] in "(（" and " " not in text[a:b].strip()
                if not short and _speech_ends(text, begin, a, b, stop, low):
                    e = b
                    c = rules.close.match(text, e, stop)
                    emit(c.end() if c and text[b : b + 1] not in "“«" else e)
                    pos = max(b, begin)
                    continue
            pos = b
            continue
        if m is None:
            break
        e = m.end()
        mark = m.group()
        c = rules.close.match(text, e, stop)
        # a closing mark must not open the next quotation
        if c and not (text[c.start()] in "\"'“‘" and (e < stop and text[e - 1].isspace())):
            e = c.end()
        pos = max(e, m.start() + 1)
        after = _next(text, e, stop)
        if after >= stop:
            break
        nxt, gap = text[after], after > e
        hard = any(x in _HARD_SET for x in mark)
        wide = any(x in "。！？｡．।॥။።" for x in mark)
        if wide or (hard and gap):
            if nxt in ",;，、":
                continue
            if not wide and nxt in "-–—" and not text[after + 1 : after + 2].isalpha():
                continue
            emit(e)
            continue
        if hard:  # ! or ? without a space after it
            if nxt.isupper() or _caseless(nxt) or nxt in "¿¡«“„\"(":
                emit(e)
            continue
        if "…" in mark or mark.count(".") >= 2:
            if nxt in ",;:":
                continue
            if gap and (nxt.isupper() or nxt.isdigit() or nxt in "\"“«„¿¡(—-"):
                emit(e)
            elif gap and low and nxt.isalpha() and not text[m.start() - 1 : m.start()].isspace():
                emit(e)
            elif gap and _caseless(nxt) and not _NO_ENDS.match(nxt) and not "぀" <= nxt <= "鿿":
                emit(e)
            continue
        # a dot
        dot = m.start()
        if not gap:
            glued = nxt.isupper() and text[after + 1 : after + 2] not in (".", "") and (text[dot - 1 : dot].islower() or text[dot - 1 : dot].isdigit() or text[dot - 1 : dot] in ")%\"”’»" or _caseless(text[dot - 1 : dot]))
            if not glued and not (_caseless(nxt) and _caseless(text[dot - 1 : dot]) and "؀" <= nxt <= "ۿ"):
                low_word = _WORD.match(text, after, stop) if low else None
                if not low_word or low_word.group() not in BEGINS or not text[dot - 1 : dot].isalpha():
                    continue
            if _abbreviation(text, begin, dot, after, stop, low, rules.never):
                continue
            emit(e)
            continue
        if nxt in ",;:" or (nxt.islower() and not low):
            continue
        if e == dot + 1 and _abbreviation(text, begin, dot, after, stop, low, rules.never):
            continue
        if nxt in "-–—" and not text[after + 1 : after + 2].isalpha() and not text[after + 1 : after + 2] in "¡¿":
            continue
        emit(e)
    emit(stop)


def _spaced(text: str, start: int, stop: int, out: list[tuple[int, int]]) -> None:
    """Units of a script without end marks: spaces part them, except beside digits and Latin letters."""
    begin = _next(text, start, stop)
    i = begin
    while i < stop:
        if text[i].isspace():
            j = _next(text, i, stop)
            before, nxt = text[i - 1], text[j] if j < stop else ""
            plain = (before.isascii() and before.isalnum()) or (nxt.isascii() and nxt.isalnum())
            if not plain or not nxt:
                out.append((begin, i))
                begin = j
            i = j
        else:
            i += 1
    e = stop
    while e > begin and text[e - 1].isspace():
        e -= 1
    if e > begin:
        out.append((begin, e))


def sentence_spans(text: str | None) -> list[tuple[int, int]]:
    """(start, end) of every unit, in code points; null, empty and blank texts have none."""
    if not text or text.isspace():
        return []
    out: list[tuple[int, int]] = []
    rules = rules_of(text)
    at = 0
    for m in [*_BLANK.finditer(text), None]:
        stop = m.start() if m else len(text)
        _paragraph(text, at, stop, rules, out)
        if m:
            at = m.end()
    return out


def _paragraph(text: str, start: int, stop: int, rules: Rules, out: list[tuple[int, int]]) -> None:
    if start >= stop:
        return
    body = text[start:stop]
    low = body == body.lower() and body != body.upper()
    bounds, at = [], start
    while at <= stop:
        nl = text.find("\n", at, stop)
        bounds.append((at, nl if nl >= 0 else stop))
        if nl < 0:
            break
        at = nl + 1
    marked = [bool(_MARKER.match(text, a, b)) for a, b in bounds]
    first = next((i for i, x in enumerate(marked) if x), None)
    lists = first is not None and (
        (first == 0 and (all(marked) or sum(marked) * 2 > len(marked) and sum(marked) > 1))
        or (first is not None and 0 < first and all(marked[first:]) and sum(marked) > 1 and text[bounds[first - 1][0] : bounds[first - 1][1]].rstrip()[-1:] in ":：")
    )
    if lists:
        assert first is not None
        if first:
            _running(text, start, bounds[first][0], low, rules, out)
        k = first
        while k < len(bounds):  # an item runs on over unmarked lines
            j = k + 1
            while j < len(bounds) and not marked[j]:
                j += 1
            a, b = _next(text, bounds[k][0], stop), bounds[j - 1][1]
            while b > a and text[b - 1].isspace():
                b -= 1
            if b > a:
                out.append((a, b))
            k = j
        return
    n = 0 if body.isascii() else len(_NO_ENDS.findall(body))
    if n and n * 2 > sum(map(str.isalpha, body)):
        _spaced(text, start, stop, out)
    else:
        _running(text, start, stop, low, rules, out)


_SPAN = T.ArrayType(T.StructType().add("sent_start", "long").add("sent_end", "long"))


@F.pandas_udf(_SPAN)
def _spans(s: pd.Series) -> pd.Series:
    return s.map(lambda x: [{"sent_start": a, "sent_end": b} for a, b in sentence_spans(x)])


def sentences(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col, sent_start, sent_end``, one row per unit; repeated rows of one id and text count once.

    Whole texts are worked; documents without a unit (null, empty, blank) give no row.
    """
    # run once: the filter that exploding brings would run it again
    rows = documents.where(F.col(text_col).isNotNull()).select(id_col, _spans.asNondeterministic()(F.col(text_col)).alias("u"))
    return rows.select(id_col, F.explode("u").alias("x")).select(id_col, "x.sent_start", "x.sent_end").distinct()

