"""Parsing and comparing names of persons and organisations as people type them."""

from __future__ import annotations

import re
import unicodedata
from functools import lru_cache

# Short forms of English given names.
SHORT_FORMS = {
    "abigail": "abby gail", "alexander": "alex al sandy xander", "andrew": "andy drew", "anthony": "tony", "barbara": "barb babs",
    "benjamin": "ben benny", "charles": "charlie chuck chas", "christina": "chris tina chrissy", "christopher": "chris kit topher",
    "cynthia": "cindy", "daniel": "dan danny", "deborah": "deb debbie", "dorothy": "dot dottie dolly", "douglas": "doug",
    "edward": "ed eddie ted ned", "eleanor": "ellie nell nora", "elizabeth": "liz beth betty eliza lizzie betsy", "frances": "fran frankie",
    "frederick": "fred freddie", "gabriella": "gaby ella", "gerald": "gerry jerry", "gregory": "greg", "harold": "hal harry",
    "jacqueline": "jackie", "james": "jim jimmy jamie jas", "jennifer": "jen jenny", "jonathan": "jon jonny", "joseph": "joe joey jos",
    "josephine": "jo josie", "katherine": "kate kathy katie kit kay", "kenneth": "ken kenny", "lawrence": "larry laurie", "leonard": "len lenny leo",
    "margaret": "maggie meg peggy marge", "matthew": "matt", "michael": "mike mick mickey", "nathaniel": "nate nat nathan", "nicholas": "nick nicky",
    "pamela": "pam", "patricia": "pat patty trish tricia", "patrick": "pat paddy", "philippa": "pippa pip", "raymond": "ray",
    "rebecca": "becky becca", "richard": "rich rick dick ricky", "robert": "rob bob bobby robbie robt", "ronald": "ron ronnie", "samuel": "sam sammy",
    "sandra": "sandy", "stephen": "steve stevie", "susan": "sue susie", "theodore": "ted theo teddy", "theresa": "terry tess tessa",
    "thomas": "tom tommy thos", "timothy": "tim timmy", "victoria": "vicky tori", "vincent": "vince vinny", "walter": "walt wally",
    "william": "will bill billy wm", "zachary": "zack zach",
}
# Legal forms and their abbreviations.
LEGAL = {
    "bros": "brothers", "inc": "incorporated", "ltd": "limited", "corp": "corporation", "co": "company", "assoc": "association", "assn": "association",
    "coop": "cooperative", "llc": "llc", "llp": "llp", "plc": "plc", "intl": "international", "natl": "national", "mfg": "manufacturing", "dept": "department",
    "univ": "university", "cmte": "committee", "comm": "committee", "pac": "pac", "svcs": "services", "svc": "services",
}
TITLES = frozenset("mr mrs ms miss mx dr prof professor hon rev sir madam capt col lt sgt maj gen judge sen rep".split())
SUFFIXES = {"jr": "jr", "junior": "jr", "sr": "sr", "senior": "sr", "ii": "ii", "iii": "iii", "iv": "iv", "esq": "", "phd": "", "md": ""}
FULL_LEGAL = frozenset(LEGAL.values())
FORMALS: dict[str, frozenset[str]] = {}
for _formal, _short in SHORT_FORMS.items():
    for _s in _short.split():
        FORMALS[_s] = FORMALS.get(_s, frozenset()) | {_formal}


def parse(name: str) -> tuple[list[str], list[str], str, bool]:
    """(words of two letters or more, sorted; initials in order; generation suffix; organisation?)."""
    text = unicodedata.normalize("NFKD", name).casefold()
    text = "".join(ch for ch in text if not unicodedata.combining(ch)).replace("’", "'")
    text = re.sub(r"\bass'?n\b", "assn", re.sub(r"\bco[ \-]op\b", "coop", text)).replace("'", "")
    text = re.sub(r"\b([a-z])\.\s?(?=[a-z]\.)", r"\1 ", text)
    words = re.findall(r"[^\W_]+", text)
    org = any(w in LEGAL or w in FULL_LEGAL for w in words) or "&" in text or "+" in text
    long, initials, suffix = [], [], ""
    for i, w in enumerate(words):
        if org:
            if w not in ("the", "and", "of", "n"):
                long.append(LEGAL.get(w, w))
        elif len(w) == 1 and not w.isdigit():
            initials.append(w)
        elif w in SUFFIXES and i > 0:
            suffix = SUFFIXES[w] or suffix
        elif w not in TITLES or len(words) == 1:
            long.append(w)
    return sorted(long), initials, suffix, org


def families(words: list[str]) -> list[str]:
    """The formal names that the words are or stand for."""
    return sorted({f for w in words for f in FORMALS.get(w, frozenset()) | ({w} & SHORT_FORMS.keys())})


def distance(a: str, b: str, most: int = 2) -> int:
    """Edit distance with transpositions of neighbours, cut off above ``most``."""
    if a == b:
        return 0
    if abs(len(a) - len(b)) > most:
        return most + 1
    before, row = [], list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        older, before, row = before, row, [i]
        for j, y in enumerate(b, 1):
            d = min(before[j] + 1, row[j - 1] + 1, before[j - 1] + (x != y))
            if i > 1 and j > 1 and x == b[j - 2] and a[i - 2] == y:
                d = min(d, older[j - 2] + 1)
            row.append(d)
        if min(row) > most:
            return most + 1
    return row[-1]


@lru_cache(maxsize=200_000)
def typo(a: str, b: str) -> bool:
    """One slip of the finger apart; two only in long words."""
    most = 1 if min(len(a), len(b)) < 9 else 2
    return min(len(a), len(b)) >= 3 and distance(a, b, most) <= most


@lru_cache(maxsize=200_000)
def given_match(a: str, b: str) -> float:
    """Similarity of two given names: equal 1, short form 0.9 (0.6 if it is short for several), slip 0.85, else 0."""
    if a == b:
        return 0.6 if len(FORMALS.get(a, ())) > 1 and a not in SHORT_FORMS else 1.0
    fa, fb = FORMALS.get(a, frozenset()) | {a}, FORMALS.get(b, frozenset()) | {b}
    if fa & fb:
        return 0.6 if max(len(FORMALS.get(a, ())), len(FORMALS.get(b, ()))) > 1 else 0.9
    if a in SHORT_FORMS and b in SHORT_FORMS:
        return 0.0
    if typo(a, b):
        return 0.85
    return 0.85 if any(typo(x, y) for x in fa for y in fb if len(x) > 4 and len(y) > 4 and not (x in SHORT_FORMS and y in SHORT_FORMS)) else 0.0


def compare(a: tuple, b: tuple, key_a: str, key_b: str, weight: dict[str, float]) -> tuple[float, bool]:
    """(soft weighted similarity, weak?) of two parsed names that share the rare word ``key``; 0 = different.

    Words count by ``weight`` (rare ones more). Weak: the given name is known by its initial or by a
    short form of several names only, so the link holds only if nobody else fits.
    """
    la, ia, sa, oa = a
    lb, ib, sb, ob = b
    if oa != ob or sa != sb:
        return 0.0, False
    ra, rb = list(la), list(lb)
    ra.remove(key_a)
    rb.remove(key_b)
    same = 1.0 if key_a == key_b else 0.9
    total = weight.get(key_a, 5.0) + weight.get(key_b, 5.0)
    got, weak, slips = same * total, False, int(key_a != key_b)
    if oa:
        if len(ra) != len(rb):
            return 0.0, False
        left = list(rb)
        for w in ra:
            hit = w if w in left else next((x for x in left if typo(w, x)), None)
            if hit is None:
                return 0.0, False
            left.remove(hit)
            part = weight.get(w, 5.0) + weight.get(hit, 5.0)
            slips += w != hit
            total, got = total + part, got + part * (1.0 if w == hit else 0.85)
        return (got / total if slips <= 2 else 0.0), False
    ja, jb = list(ia), list(ib)
    if ra and rb:
        left = list(rb)
        for w in ra:
            best = max(left, key=lambda x: given_match(w, x), default=None)
            m = given_match(w, best) if best else 0.0
            if best and not m:
                return 0.0, False
            if best:
                left.remove(best)
                weak |= m == 0.6
                part = weight.get(w, 5.0) + weight.get(best, 5.0)
                total, got = total + part, got + part * m
                slips += m == 0.85
            else:  # a further name against nothing: perhaps a spelled-out middle name
                total += weight.get(w, 5.0)
        total += sum(weight.get(w, 5.0) for w in left)
    elif ra or rb:
        names, initials = (ra, jb) if ra else (rb, ja)
        fits = {f[0] for w in names[:1] for f in FORMALS.get(w, frozenset()) | {w}}
        if len(names) > 1 or not initials or initials[0] not in fits:
            return 0.0, False
        initials.pop(0)
        weak, total, got = True, total + 2.0, got + 1.6
    else:
        if not ja or not jb or ja[0] != jb[0]:
            return 0.0, False
        ja.pop(0), jb.pop(0)
        weak, total, got = True, total + 2.0, got + 1.6
    if ja and jb and ja[0] != jb[0]:
        return 0.0, False
    return (got / total if slips <= 2 else 0.0), weak
