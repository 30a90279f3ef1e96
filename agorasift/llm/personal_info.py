"""Personal information in free text, found by weak supervision (problem 3).

1. Wide patterns propose candidate spans of five types.
2. Labelers vote on each candidate: format rules, a gazetteer (given names; public figures), the
   words before and after, and the span's surroundings. A labeler may abstain.
3. Expectation-maximisation over the counts of vote patterns (all candidates; one row per pattern)
   estimates how reliable each labeler is and gives each pattern label probabilities.
4. A softmax span classifier on hashed features is trained on these labels, over a bounded sample
   of candidates (``SAMPLE`` spans, those of least hash). It decides every candidate.
5. Overlapping accepted spans are settled (longer types first) and replaced by typed placeholders.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from agorasift.llm.messages import FOLD
from agorasift.llm.names import SHORT_FORMS
from agorasift.session import cut

TYPES = ("EMAIL", "PHONE", "ID_NUMBER", "ADDRESS", "NAME")
CLASSES = ("NONE", *TYPES)
#: Candidates on which the span classifier is trained, chosen by hash (all, if there are fewer).
SAMPLE = 20_000
#: Given names and public figures at most: every task holds them. Beyond, the search refuses to run.
GAZETTEER = 1_000_000
FEATURES = 1 << 13

_SEP = r"(?:\.|\s?[\[({<]\s?(?:dot|punkt|punto|point)\s?[\])}>]\s?)"
_LOCAL = r"[A-Za-z0-9_](?:[\w+\-]|" + _SEP + r"(?=[\w+\-]))*"
_EMAIL = re.compile(
    rf"(?<![\w.+\-@])(?:{_LOCAL}(?:\s?@\s?|\s?[\[({{<]\s?at\s?[\])}}>]\s?)[A-Za-z0-9\-]+(?:{_SEP}[A-Za-z][\w\-]*)+"
    rf"|{_LOCAL}(?:\sdot\s[\w+\-]+)*\sat\s[A-Za-z0-9\-]+(?:\.[A-Za-z][\w\-]+|\sdot\s[A-Za-z][\w\-]+)+)",
    re.I,
)
_PHONE = r"\+\d{1,3}(?:[ .\-/]?\(?\d{1,5}\)?(?=[ .\-/\d]|\b)){1,5}(?!\d)|(?:\+?1[ .\-])?\(\d{3}\) ?\d{3}[\-. ]\d{4}|(?:1[\-. ])?\d{3}(?P<q>[\-. ])\d{3}(?P=q)\d{4}|\d{3}/\d{3}-\d{4}|0\d{3} \d{2} \d{5} \d{3}|\d{4} \d{2} \d{5} \d{3}|0\d{2,4}[ /\-]\d{5,8}|\d{10}"
_ID = r"\d{3}(?P<r>[\- .])\d{2}(?P=r)\d{4}|\d{2} \d{3} \d{3} \d{3}|[A-Z]\d{3}-\d{4}-\d{4}|[A-Z]\d{2}[A-Z]\d{5}|\d{9}"
_OTHER = r"[A-Z]{0,3}-?\d[\d./\-]{4,}\d|[A-Z]{1,3}\d{5,}"
_NUMBER = re.compile(rf"(?<![\w/#@.+\-])(?:(?P<p>{_PHONE})|(?P<i>{_ID})|(?P<o>{_OTHER}))(?![\w/]|-\d|\.\d)", re.I)
# Kinds of streets.
_KIND = "avenue|ave|boulevard|blvd|street|st|drive|dr|lane|ln|road|rd|court|ct|circle|cir|place|pl|terrace|ter|way|parkway|pkwy|highway|hwy|square|sq|trail|trl|close|crescent|row|walk|mews|alley|loop|pike"
_UNIT = r"(?:,? (?:#|apt\.?|unit|suite|ste\.?|no\.|flat|floor|apartment) ?[A-Za-z]?\d{1,4}[A-Za-z]?\b|,? #\d{1,4}[A-Za-z]?\b)"
_ADDRESS = (
    # number, up to three words, kind of street, unit
    re.compile(rf"(?<![\w/#.\-])\d{{1,5}}[A-Za-z]? (?:(?:[NSEW]|NE|NW|SE|SW)\.? |(?:north|south|east|west) )?(?:[^\W\d_][\w'’\-]* ){{1,3}}?(?:(?:ave|st)\.|(?:{_KIND})\b){_UNIT}?", re.I),
    # kind of street, name, number
    re.compile(r"(?<!\w)(?:calle|avenida|av\.|plaza|paseo|camino|carrera|via|viale|piazza) (?:de (?:la |las |los |el )?|del )?[^\W\d_][\w'’\-]+(?: [^\W\d_][\w'’\-]+)?,? (?:n[º°o]\.? ?)?\d{1,4}[a-z]?\b", re.I),
    # number, kind of street, name
    re.compile(r"(?<![\w/#.\-])\d{1,4}(?: ?bis| ?ter)?,? (?:rue|avenue|boulevard|place|chemin|allée|quai|impasse|route) (?:d['’]|de l['’]|de la |de |du |des |le |la )?[^\W\d_][\w'’\-]+(?: (?-i:[A-Z])[\w'’\-]+)?", re.I),
    # name with its kind, number
    re.compile(r"(?<!\w)[^\W\d_]\w*(?:straße|strasse|str\.|weg|gasse|platz|allee|ufer|damm|laan|straat|gatan|vej) \d{1,4}(?: ?[a-z])?\b", re.I),
)
_KIND_SET = frozenset(_KIND.split("|"))
# Strings without which the patterns abroad cannot match.
_ABROAD = (("calle", "avenida", "plaza", "paseo", "camino", "carrera", "via", "piazza", "av."), ("rue", "avenue", "boulevard", "place", "chemin", "allée", "quai", "impasse", "route"), ("straße ", "strasse ", "str. ", "weg ", "gasse ", "platz ", "allee ", "ufer ", "damm ", "laan ", "straat ", "gatan ", "vej "))
_WORDS = re.compile("[a-z]+")
_TOKEN = re.compile(r"[^\W\d_](?:[^\W\d_]|['’\-](?=[^\W\d_]))*\.?")
_CAPITAL = re.compile(r"(?<![^\W\d_])[A-ZÀ-ÞĀ-ž](?:[^\W\d_]|['’\-](?=[^\W\d_]))*\.?")
_SMALL = re.compile(r"(?<![\w.@])(?=([a-z]{3,})(?: [a-z]\.?)? ([a-z]{4,}(?:-[a-z]+)?)(?!\w))")
_MASK = re.compile(r"https?://\S+|(?<!\w)[@#][\w]+")
# Words that announce a number, and words that announce a number of something else.
ID_WORDS = frozenset("ssn social security id passport licence license card member membership voter tax registered dni nif steuernummer ausweis identity document insurance medicare permit-holder".split())
PHONE_WORDS = frozenset("call ring phone tel telephone cell mobile text fax dial hotline reach number whatsapp sms ph robo answer under whoever llame ruf".split())
OTHER_WORDS = frozenset("docket folder invoice form bill budget line section room case file ballots ballot order ref reference route bus page part article resolution lot permit ticket contract rule version item agenda measure ordinance petition no".split())
NAME_BEFORE = frozenset(
    "by for from to with as know knows knew met meet ask asked tell told thank thanks dear hi hello is was so into believed birthday soon mr mrs ms miss dr mother father mum mom dad parent son daughter "
    "sister brother aunt uncle cousin niece nephew grandmother grandfather wife husband partner neighbour neighbor friend colleague boss landlord tenant teacher student doctor nurse driver volunteer clerk owner".split()
)
# Words that follow a person's name in a sentence.
PERSON_AFTER = frozenset("is was has had said says told saw lost won went came got made took gave did does will would can could and who whose about from back".split())
NOT_NAMES = frozenset("the a an and of in on at to for by from with or but not no this that our my your his her their its is are was were be been has have had new old great north south east west upper lower city council school board party union ward town county street monday tuesday wednesday thursday friday saturday sunday january february march april may june july august september october november december".split())
#: Words that stand in no street's name, but between a number and a word like ``street`` in running text.
STREET_NOT = frozenset("of the for a an in on and or to by with from at as that this their our my".split())
LABELERS = ("format", "before", "after", "gazetteer", "figures", "shape", "wrap")


def given_names(contributions: DataFrame) -> list[str]:
    """Given names as typed after a surname and a comma, of at least 3 uses."""
    after = F.regexp_extract(F.col("contributor_name"), r"^[^,&+]+,\s*(\p{L}{3,})(?:\s\p{L}\.?)?$", 1)
    names = contributions.where("contributor_name is not null").select(F.lower(after).alias("g")).where("g <> ''").groupBy("g").agg(F.count("*").alias("n")).where("n >= 3")
    return _held(names.select("g"), "given names")


def _held(names: DataFrame, what: str) -> list[str]:
    """The only column, in the driver and so in every task; too many are an error, none is dropped."""
    found = sorted(r[0] for r in names.limit(GAZETTEER + 1).collect())
    if len(found) > GAZETTEER:
        raise ValueError(f"more than {GAZETTEER} {what}")
    return found


def _told(text: str, at: int, between: str = r"\.? ") -> str:
    """The word right before a place, with no more than ``between`` after it."""
    m = re.search(rf"([^\W_]+){between}$", text[max(0, at - 20) : at])
    return m[1].lower() if m else ""


class Finder:
    """Candidates of a text with their labelers' votes and features."""

    def __init__(self, given: list[str], figures: list[str]) -> None:
        legal = set("inc incorporated ltd limited corp corporation co company assoc association assn bros brothers coop cooperative".split())
        short = {s for v in SHORT_FORMS.values() for s in v.split()}
        self.given = (set(given) - legal) | set(SHORT_FORMS) | (short - {"will", "rich", "may", "art", "mark", "al", "jo", "ed", "dot", "kit", "pat", "sue", "bill", "drew", "ray", "fran", "meg", "tom"})
        self.given -= set("will rich may art mark grace hope faith drew pat bill sue ray dot kit jack chuck dick al ed jo sandy terry".split())
        self.loose_given = self.given | short  # only believed when capitalised
        self.figures: set[tuple[str, str]] = set()
        self.last_names: set[str] = set()
        for name in figures:
            w = name.casefold().split()
            if len(w) >= 2:
                self.figures |= {(w[0], w[-1]), (w[0][0], w[-1])}
                self.last_names.add(w[-1])
                self.given.add(w[0])

    def candidates(self, text: str) -> list[tuple[int, int, str, tuple, list[str]]]:
        """(start, end, proposed type, votes, features)."""
        low = text.lower()
        flat = text == low or text == text.upper()
        out = []
        if "@" in low or " at " in low or "at]" in low or "at)" in low or "at}" in low:
            out += [(*m.span(), "EMAIL") for m in _EMAIL.finditer(text)]
        digits = sum(map(low.count, "0123456789"))
        if digits >= 6:
            out += [(*m.span(), "PHONE" if m["p"] else "ID_NUMBER" if m["i"] else "OTHER") for m in _NUMBER.finditer(text)]
        able = (not _KIND_SET.isdisjoint(_WORDS.findall(low)), *[any(x in low for x in g) for g in _ABROAD]) if digits else (False,) * 4
        for pattern, can in zip(_ADDRESS, able):
            for m in pattern.finditer(text) if can else ():
                inner = re.findall(r"[^\W\d_]\w*", m.group())
                if (flat or any(w[0].isupper() for w in inner)) and not any(w.casefold() in STREET_NOT for w in inner[:-1]):
                    out.append((*m.span(), "ADDRESS"))
        taken = [(s, e) for s, e, t in out if t in ("EMAIL", "ADDRESS")]
        out += [(s, e, "NAME") for s, e in self._names(text, flat) if not any(s < b and a < e for a, b in taken)]
        return [(s, e, t, *self._votes(text, low, s, e, t)) for s, e, t in out]

    def _names(self, text: str, flat: bool) -> Iterator[tuple[int, int]]:
        bare = _MASK.sub(lambda m: "\0" * len(m.group()), text)
        words = [(m.start(), m.end(), m.group()) for m in (_TOKEN if flat else _CAPITAL).finditer(bare)]
        i = 0
        while i < len(words):
            hit = self._name_at(text, words, i, flat)
            if hit:
                last = hit[0]
                yield words[i][0], hit[1]
                i = last + 1
            else:
                i += 1
        if not flat:
            yield from self._lower(bare)

    def _lower(self, bare: str) -> Iterator[tuple[int, int]]:
        """Names in small letters inside a text that has capitals: after a word that names follow."""
        if self.given.isdisjoint(bare.split()):
            return
        for m in _SMALL.finditer(bare):
            if m[1] in self.given and m[2] not in NOT_NAMES:
                if _told(bare, m.start(), r"[\W_]*") in NAME_BEFORE:
                    yield m.start(1), m.end(2)

    def _given(self, w: str, flat: bool) -> bool:
        w = w.rstrip(".").casefold()
        return w in (self.given if flat else self.loose_given)

    def _surname(self, w: str, flat: bool) -> bool:
        x = w.rstrip(".")
        return len(x) >= 3 and (flat or x[0].isupper()) and x.casefold() not in NOT_NAMES

    def _name_at(self, text: str, words: list, i: int, flat: bool) -> tuple[int, int] | None:
        def gap(k: int) -> str:
            return text[words[k][1] : words[k + 1][0]] if k + 1 < len(words) else "\n"

        def initial(w: str) -> bool:
            return (len(w) == 2 and w[1] == "." and w[0].isalpha()) or (len(w) == 1 and w.isalpha() and w.isupper())

        s, e, w = words[i]
        if not flat and not w[0].isupper():
            return None
        if self._given(w, flat) and not w.endswith("."):  # given name, initials, surname
            j, spaces = i + 1, gap(i)
            if spaces != " ":
                return None
            while j < len(words) and initial(words[j][2]) and gap(j) in (" ", "") and j < i + 3:
                j += 1
            if j < len(words) and (words[j - 1][1] == words[j][0] or text[words[j - 1][1] : words[j][0]] == " ") and self._surname(words[j][2], flat) and len(words[j][2].rstrip(".")) > 1:
                if flat or words[j][2][0].isupper():
                    return j, words[j][1] - words[j][2].endswith(".")
            return None
        if initial(w) and w.endswith("."):  # initials, surname
            j = i + 1
            while j < len(words) and initial(words[j][2]) and gap(j - 1) in (" ", "") and j < i + 3:
                j += 1
            if j < len(words) and gap(j - 1) == " " and self._surname(words[j][2], flat) and len(words[j][2].rstrip(".")) >= 4:
                return j, words[j][1] - words[j][2].endswith(".")
            return None
        if len(w) >= 4 and not w.endswith(".") and self._surname(w, flat) and i + 1 < len(words):  # surname first
            nxt = words[i + 1]
            if gap(i) in (", ", ",") and self._given(nxt[2], flat) and (flat or nxt[2][0].isupper()):
                end, j = nxt[1] - nxt[2].endswith("."), i + 1
                if j + 1 < len(words) and gap(j) == " " and len(words[j + 1][2]) == 2 and initial(words[j + 1][2]):
                    j, end = j + 1, words[j + 1][1]
                return j, end
            if gap(i) in (", ", ",") and initial(nxt[2]) and nxt[2].endswith("."):
                return i + 1, nxt[1]
            if _told(text, s) in NAME_BEFORE and gap(i) == " " and self._given(nxt[2], flat) and (flat or nxt[2][0].isupper()) and w.casefold() not in self.given and not (i + 2 < len(words) and gap(i + 1) == " " and self._surname(words[i + 2][2], flat) and not flat):
                return i + 1, nxt[1] - nxt[2].endswith(".")
        return None

    def _votes(self, text: str, low: str, s: int, e: int, t: str) -> tuple[tuple, list[str]]:
        span = text[s:e]
        before = re.findall(r"[^\W_]+", low[max(0, s - 40) : s])[-4:]
        after = re.findall(r"[^\W_]+", low[e : e + 30])[:3]
        near = set(before[-3:])
        v: dict[str, str] = {}
        shape = re.sub(r"[a-z]+", "a", re.sub(r"[A-Z]+", "A", re.sub(r"\d", "9", span)))[:24]
        feats = [f"t={t}", f"t={t}|1={before[-1] if before else '^'}", f"t={t}|2={' '.join(before[-2:])}", f"t={t}|n={after[0] if after else '$'}", f"t={t}|s={shape if t != 'NAME' else ''}"]
        if t == "EMAIL":
            v["format"] = "EMAIL" if re.search(r"@|at\s?[\])}>]", low[s:e]) or low[s:e].count(" dot ") else "NONE"
            v["shape"] = "EMAIL" if re.search(r"[a-z]{2,}$", low[s:e]) else "NONE"
            v["wrap"] = "EMAIL" if not (s and text[s - 1] == "@") else "NONE"
        elif t in ("PHONE", "ID_NUMBER", "OTHER"):
            digits = sum(ch.isdigit() for ch in span)
            v["format"] = {"OTHER": "NONE"}.get(t, t)
            if near & OTHER_WORDS and not near & (ID_WORDS | PHONE_WORDS):
                v["before"] = "NONE"
            elif near & ID_WORDS:
                v["before"] = "ID_NUMBER" if t != "PHONE" or digits != 10 else "PHONE"
            elif near & PHONE_WORDS:
                v["before"] = "PHONE"
            v["shape"] = "PHONE" if span[0] in "+(" else "NONE" if digits < 9 or digits > 13 else t if t != "OTHER" else "NONE"
            other = next((w for w in reversed(before) if w in OTHER_WORDS | ID_WORDS | PHONE_WORDS), "-")
            feats += [f"t={t}|w={other}", f"t={t}|k={'o' if other in OTHER_WORDS else 'i' if other in ID_WORDS else 'p' if other in PHONE_WORDS else '-'}", f"d={digits}"]
        elif t == "ADDRESS":
            number = bool(re.search(r"\d", span))
            v["format"] = "ADDRESS" if number else "NONE"
            middle = set(re.findall(r"[^\W\d_]+", low[s:e])[:-1])
            v["shape"] = "NONE" if middle & {"of", "the", "for", "a", "in", "on", "and", "to", "by"} else "ADDRESS"
            if before and before[-1] in ("at", "to", "outside", "by", "after", "in", "visit", "near"):
                v["before"] = "ADDRESS"
            feats.append(f"t=ADDRESS|m={v['shape']}")
        else:
            words = [w.rstrip(".").casefold() for w in _TOKEN.findall(span if span.isascii() else span.translate(FOLD))]
            comma = "," in span
            last, first = (words[0], words[1]) if comma else (words[-1], words[0])
            if not comma and words[-1] in self.given and words[0] not in self.given and len(words) == 2:
                last, first = words[0], words[1]
            figure = (first, last) in self.figures or any(f in SHORT_FORMS and first in SHORT_FORMS[f].split() for f, x in self.figures if x == last)
            v["figures"] = "NONE" if figure or (len(first) == 1 and last in self.last_names) else "NAME" if last not in self.last_names else ""
            # that it is a person's name says nothing of a public figure's namesakes
            v["gazetteer"] = "NAME" if last not in self.last_names and first in self.loose_given else ""
            v["before"] = "NAME" if before and before[-1] in NAME_BEFORE else ""
            v["shape"] = "NONE" if last in NOT_NAMES or len(last) < 3 else ""
            # people act: a verb or a pronoun that stands for a person comes next
            v["after"] = "NAME" if after and (after[0] in PERSON_AFTER or (len(after[0]) > 4 and after[0].endswith("ed"))) else ""
            feats += [f"fig={figure}", f"lastknown={last in self.last_names}", f"g={first in self.loose_given}", f"i={len(first) == 1}", f"lastplain={last in NOT_NAMES}", f"c={comma}", f"b={v['before']}|a={v['after']}|f={v['figures']}"]
        votes = tuple(CLASSES.index(v[k]) if v.get(k) else -1 for k in LABELERS)
        return votes, feats


def _hash(feats: list[str]) -> list[int]:
    return sorted({zlib.crc32(f.encode()) % FEATURES for f in feats})


_SPAN = (
    T.StructType().add("tweet_id", "string").add("text", "string").add("start", "integer").add("stop", "integer").add("proposed", "string")
    .add("votes", T.ArrayType(T.ByteType())).add("feats", T.ArrayType(T.ShortType())).add("h", "long")
)


def candidate_spans(tweets: DataFrame, given: list[str], figures: list[str], id_col: str = "tweet_id", text_col: str = "text_raw") -> DataFrame:
    """One row per candidate span; the same text under several ids is worked once per batch."""

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        finder = Finder(given, figures)
        for pdf in batches:
            rows = []
            for i, text in zip(pdf["i"], pdf["t"]):
                for s, e, t, votes, feats in finder.candidates(text):
                    rows.append((i, text[s:e], s, e, t, list(votes), _hash(feats), zlib.crc32(f"{i}:{s}:{t}".encode())))
            yield pd.DataFrame(rows, columns=[f.name for f in _SPAN])

    rows = tweets.where(F.col(id_col).isNotNull() & F.col(text_col).isNotNull()).select(F.col(id_col).alias("i"), F.col(text_col).alias("t")).dropDuplicates(["i"])
    return rows.mapInPandas(work, _SPAN)


def label_patterns(patterns: list[tuple[str, tuple, int]], rounds: int = 30) -> dict[tuple[str, tuple], np.ndarray]:
    """Label probabilities per (proposed type, votes) by expectation-maximisation over pattern counts.

    One confusion matrix per labeler, smoothed towards being right; class shares per proposed type.
    """
    k, n = len(CLASSES), np.array([c for _, _, c in patterns], float)
    kinds = sorted({t for t, _, _ in patterns})
    v = np.array([x for _, x, _ in patterns], int).reshape(len(patterns), -1)
    kind = np.array([kinds.index(t) for t, _, _ in patterns])
    allowed = np.zeros((len(kinds), k), bool)
    for j, t in enumerate(kinds):
        for c in {"NONE", *({"PHONE", "ID_NUMBER"} if t in ("PHONE", "ID_NUMBER", "OTHER") else {t})}:
            allowed[j, CLASSES.index(c)] = True
    post = np.full((len(patterns), k), 0.05)
    for col in range(v.shape[1]):  # a list of public figures is trusted more at the start than a habit of writing
        rows = v[:, col] >= 0
        post[np.flatnonzero(rows), v[rows, col]] += 3 if LABELERS[col] in ("figures", "format") else 1
    post = post * allowed[kind]
    post /= post.sum(1, keepdims=True)
    for _ in range(rounds):
        logp = np.zeros_like(post)
        for col in range(v.shape[1]):
            rows = np.flatnonzero(v[:, col] >= 0)
            m = np.eye(k) * 40 + 2.0
            np.add.at(m.T, v[rows, col], post[rows] * n[rows, None])
            m /= m.sum(1, keepdims=True)
            if LABELERS[col] in ("figures", "format"):  # lists and formats are right by construction, up to few errors
                m = 0.97 * np.eye(k) + 0.03 * m
            logp[rows] += np.log(m[:, v[rows, col]].T)
        for j in range(len(kinds)):
            share = (post[kind == j] * n[kind == j, None]).sum(0) + 1
            logp[kind == j] += np.log(share / share.sum())
        logp[~allowed[kind]] = -1e9
        post = np.exp(logp - logp.max(1, keepdims=True))
        post /= post.sum(1, keepdims=True)
    return {(t, x): p for (t, x, _), p in zip(patterns, post)}


def train_classifier(feats: list[list[int]], soft: np.ndarray, epochs: int = 40, rate: float = 0.5) -> np.ndarray:
    """Softmax regression on binary hashed features with soft labels; full-batch steps with AdaGrad."""
    w, g2 = np.zeros((FEATURES, len(CLASSES))), np.full((FEATURES, len(CLASSES)), 1e-3)
    rows = np.repeat(np.arange(len(feats)), [len(f) for f in feats])
    cols = np.fromiter((x for f in feats for x in f), int, len(rows))
    for _ in range(epochs):
        z = np.zeros((len(feats), len(CLASSES)))
        np.add.at(z, rows, w[cols])
        p = np.exp(z - z.max(1, keepdims=True))
        p /= p.sum(1, keepdims=True)
        grad = np.zeros_like(w)
        np.add.at(grad, cols, (p - soft)[rows])
        grad = grad / max(1, len(feats)) + 1e-6 * w
        g2 += grad**2
        w -= rate * grad / np.sqrt(g2)
    return w


def found_spans(tweets: DataFrame, contributions: DataFrame, candidates: DataFrame) -> DataFrame:
    """``tweet_id, start, stop, pii_type, pii_text`` of every mention, without overlaps; offsets in code points.

    Null ids and texts give no row; a text delivered several times under one id counts once. With no
    candidate at all the result is empty.
    """
    figures = _held(candidates.where("name is not null").select("name").distinct(), "public figures")
    spans = cut(candidate_spans(tweets, given_names(contributions), figures))
    counts = spans.groupBy("proposed", "votes").agg(F.count("*").alias("n")).collect()  # one row per vote pattern: at most 6 * 7^7, some hundreds
    if not counts:
        return spans.select("tweet_id", "start", "stop", F.col("proposed").alias("pii_type"), F.col("text").alias("pii_text"))
    probable = label_patterns(sorted((r["proposed"], tuple(r["votes"]), r["n"]) for r in counts))
    below = int(min(1.0, SAMPLE / sum(r["n"] for r in counts)) * 2**32)  # h is uniform in [0, 2^32): about SAMPLE rows
    sample = spans.where(F.col("h") < below).select("proposed", "votes", "feats").collect()
    w = train_classifier([r["feats"] for r in sample], np.array([probable[r["proposed"], tuple(r["votes"])] for r in sample]))

    @F.pandas_udf("string")
    def decide(proposed: pd.Series, feats: pd.Series) -> pd.Series:
        out = []
        for t, f in zip(proposed, feats):
            z = w[f].sum(0)
            kinds = (0, 2, 3) if t in ("PHONE", "ID_NUMBER", "OTHER") else (0, CLASSES.index(t))
            out.append(CLASSES[max(kinds, key=lambda c: z[c])])
        return pd.Series(out)

    good = spans.withColumn("pii_type", decide.asNondeterministic()("proposed", "feats")).where("pii_type <> 'NONE'")
    rank = F.when(F.col("pii_type") == "EMAIL", 0).when(F.col("pii_type") == "ADDRESS", 1).when(F.col("pii_type") == "NAME", 3).otherwise(2)
    item = F.struct(rank.alias("rank"), "start", "stop", "pii_type", F.col("text").alias("pii_text"))
    grouped = good.groupBy("tweet_id").agg(F.array_sort(F.collect_list(item)).alias("a"))  # the spans of one text
    keep = F.aggregate("a", F.filter("a", lambda x: F.lit(False)), lambda acc, x: F.when(F.exists(acc, lambda y: (y["start"] < x["stop"]) & (x["start"] < y["stop"])), acc).otherwise(F.concat(acc, F.array(x))))
    return grouped.select("tweet_id", F.explode(keep).alias("x")).select("tweet_id", "x.start", "x.stop", "x.pii_type", "x.pii_text")


def redact(tweets: DataFrame, spans: DataFrame) -> DataFrame:
    """``tweet_id, text``: each mention replaced by ``[TYPE]``, everything else unchanged."""
    one = tweets.where("tweet_id is not null").select("tweet_id", "text_raw").dropDuplicates(["tweet_id"])
    marks = spans.groupBy("tweet_id").agg(F.array_sort(F.collect_list(F.struct("start", "stop", "pii_type"))).alias("m"))
    start = F.struct(F.lit("").alias("out"), F.lit(0).alias("at"))
    body = F.col("text_raw")

    def step(acc, x):  # noqa: ANN001, ANN202
        return F.struct(F.concat(acc["out"], F.substring(body, acc["at"] + 1, x["start"] - acc["at"]), F.lit("["), x["pii_type"], F.lit("]")).alias("out"), x["stop"].alias("at"))

    done = F.aggregate("m", start, step, lambda acc: F.concat(acc["out"], F.substring(body, acc["at"] + 1, F.length(body))))
    return one.join(marks, "tweet_id", "left").select("tweet_id", F.when(F.col("m").isNull(), body).otherwise(done).alias("text"))
