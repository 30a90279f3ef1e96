"""Short messages: their core words, similarity codes and comparison."""

from __future__ import annotations

import html
import re
import unicodedata
from collections import Counter
from functools import lru_cache

import numpy as np
import xxhash

from agorasift.llm.characters import LATIN_LIKE
from agorasift.llm.names import typo

#: Look-alike letters as Latin ones, zero-width characters as nothing.
FOLD = {ord(x): base for base, others in LATIN_LIKE.items() for x in others} | {i: None for i in (0xAD, 0x180E, 0x200B, 0x200C, 0x200D, 0x2060, 0xFE0F, 0xFEFF)}
_AROUND = re.compile(r"https?://\S+|www\.\S+|\(?\bvia @\w+\)?|^\W*rt @\w+\W*|[@#＃]\w+", re.I)
WORD = re.compile(r"[぀-ヿ㐀-鿿가-힯]|[^\W_]+")
#: Words in a segment; its similarity hash is one code block.
SEGMENT = 9
#: Words in a segment of a text of at most ``BRIEF`` words, besides.
SHINGLE, BRIEF = 5, 20
#: Part of the smaller set of words that two copies must have in common, letter by letter.
SHARED = 0.6
#: Bits in the sketch of a text's set of words.
SKETCH = 256


_END = re.compile(r"(?:…|\.\.\.)\W*$")


def bare(text: str) -> str:
    """Text in one width and script of look-alikes, without handles, tags, links and forwarding marks."""
    if "&" in text:
        text = html.unescape(text)
    if not text.isascii():
        text = unicodedata.normalize("NFKC", text.translate(FOLD)).translate(FOLD)
    return _AROUND.sub(" ", text)


def core(text: str) -> tuple[list[str], bool]:
    """(words in their own case; cut off with an ellipsis?)."""
    text = bare(text)
    return WORD.findall(text), "..." in text and _END.search(text) is not None


@lru_cache(maxsize=500_000)
def _shape(word: str) -> bytes:
    """Hash of a word's shape, which a doubled letter, a swap or a changed vowel leaves alone."""
    shape = word
    if len(word) > 3 and word.isalpha() and word.isascii():
        shape = word[0] + "".join(sorted(set(word[1:]) - set("aeiouy")))
    return xxhash.xxh64_digest(shape)


_POWER = np.uint64(1) << np.arange(63, -1, -1, dtype=np.uint64)
_TILT = np.unpackbits(np.frombuffer(xxhash.xxh64_digest("tilt"), np.uint8)).view(np.int8) - 1


def _pack(sums: np.ndarray) -> np.ndarray:
    """Rows of 64 signed sums -> 64-bit codes as signed integers; a sum of 0 falls by a fixed tilt."""
    return np.packbits(sums > _TILT, axis=1).view(">i8").astype(np.int64).ravel()


def codes(texts: list[list[str]]) -> tuple[list[int], list[list[int]]]:
    """Per text: 64-bit similarity hash of all words (numbers and long words count double), and its code blocks.

    Blocks are similarity hashes of segments: ``SEGMENT`` words in a row, so any such run of equal
    words gives two texts a common block. A text of at most ``BRIEF`` words also has those of
    ``SHINGLE`` words in a row, and one of at most SEGMENT words those of all its words, and of all
    but each one, so that one word exchanged, put in or left out leaves a common block.
    """
    sizes = np.array([len(t) for t in texts])
    if not sizes.sum():
        return [0] * len(texts), [[] for _ in texts]
    raw = b"".join(_shape(w) for t in texts for w in t)
    m = np.unpackbits(np.frombuffer(raw, np.uint8)).reshape(-1, 64).astype(np.int8) * 2 - 1
    ends = np.concatenate(([0], np.cumsum(sizes)))
    heavy = np.fromiter((1 + (w[0].isdigit() or len(w) >= 6) for t in texts for w in t), np.int8, len(m))
    filled = np.flatnonzero(sizes)
    totals = np.zeros((len(texts), 64), np.int16)
    totals[filled] = np.add.reduceat((m * heavy[:, None]).astype(np.int16), ends[:-1][filled], axis=0)
    whole = _pack(totals).tolist()
    seg = _pack(_runs(m, SEGMENT)).tolist() if len(m) >= SEGMENT else []
    out = []
    for at, n in zip(ends.tolist(), sizes.tolist()):
        blocks = set(seg[at : at + n - SEGMENT + 1]) if n >= SEGMENT else set()
        if n <= BRIEF:
            own = m[at : at + n]
            if n >= SHINGLE:
                blocks.update(_pack(_runs(own, SHINGLE)).tolist())
            if 0 < n <= SEGMENT:
                bag = own.sum(0, dtype=np.int16)
                blocks.update(_pack(bag[None]).tolist())
                if n >= SHINGLE:  # of fewer words a single one is more than the share that may differ
                    blocks.update(_pack(bag - own).tolist())
        out.append(list(blocks))
    return whole, out


def _runs(m: np.ndarray, size: int) -> np.ndarray:
    """Sums of every ``size`` rows in a row."""
    sums = m[: len(m) - size + 1].copy()
    for k in range(1, size):
        sums += m[k : len(m) - size + 1 + k]
    return sums


@lru_cache(maxsize=500_000)
def _bit(word: str) -> int:
    return 1 << xxhash.xxh64_intdigest(word) % SKETCH


def sketches(sets: list[set[str]]) -> np.ndarray:
    """One bit per word, as columns of 64 bits: a bit that only one sketch has stands for a word that only that set has."""
    out = []
    for words in sets:
        bits = 0
        for w in words:
            bits |= _bit(w)
        out.append(bits.to_bytes(SKETCH // 8, "little"))
    return np.frombuffer(b"".join(out), "<i8").reshape(len(sets), -1).T


_NUMBER = re.compile(r"\d+(?:[.,!:]\d+)*")


def number_mask(text: str) -> int:
    """32-bit set of the numbers in a bare text, whatever separates their digits; equal sets give equal masks."""
    mask = 0
    for x in _NUMBER.findall(text):
        mask |= 1 << (xxhash.xxh32_intdigest("".join(ch for ch in x if ch.isdigit())) & 31)
    return mask


def _equal(a: str, b: str) -> float:
    if a == b:
        return 1.0
    return 0.9 if not a[0].isdigit() and not b[0].isdigit() and typo(a, b) else 0.0


def same_message(a: list[str], b: list[str], cut_a: bool = False, cut_b: bool = False, least: float = 0.8) -> float:
    """Share of the words that two copies of one message have in common, in order; 0 if they tell other facts.

    Slips of the finger match. A cut-off copy is compared with as much of the other as it holds. A
    number or a capitalised word that stands against another one makes them different messages.
    """
    x, y = [w.casefold() for w in a], [w.casefold() for w in b]
    if not x or not y:
        return 0.0
    sx, sy = set(x), set(y)
    if len(sx & sy) < SHARED * min(len(sx), len(sy)):
        return 0.0
    if not (cut_a or cut_b):
        extra = sx ^ sy
        p, q = [w for w in extra if w in sx and w[0].isdigit()], [w for w in extra if w in sy and w[0].isdigit()]
        if p and q and sorted("".join(w for w in x if w[0].isdigit())) != sorted("".join(w for w in y if w[0].isdigit())):
            return 0.0
    share = _in_order(a, b, x, y, cut_a, cut_b)
    if share < least:
        share = _moved(a, b, x, y)
    return share if share >= least else 0.0


def _capital(w: str) -> bool:
    return w[0].isupper() and (len(w) == 1 or not w[1:].isupper())


def _clash(p: list[str], q: list[str], names: bool = True) -> bool:
    """Do both sides tell a fact where they differ?"""
    return (any(w[0].isdigit() for w in p) and any(w[0].isdigit() for w in q)) or (names and any(map(_capital, p)) and any(map(_capital, q)))


def _moved(a: list[str], b: list[str], x: list[str], y: list[str]) -> float:
    """Share of common words in any order, for copies whose sentences changed places."""
    ca, cb = Counter(x), Counter(y)
    p, q = ca - cb, cb - ca
    for w in list(p):
        hit = next((v for v in q if _equal(w, v)), None)
        if hit:
            del p[w], q[hit]
    left, right = [w for w in a if w.casefold() in p], [w for w in b if w.casefold() in q]
    if _clash(left, right) or any(w[0].isdigit() for w in left + right):
        return 0.0
    loose = p.total() + q.total()
    return 1 - loose / (len(x) + len(y)) if loose * 10 <= len(x) + len(y) else 0.0


def _in_order(a: list[str], b: list[str], x: list[str], y: list[str], cut_a: bool, cut_b: bool) -> float:
    head = 0
    while head < min(len(x), len(y)) and x[head] == y[head]:
        head += 1
    tail = 0
    while tail < min(len(x), len(y)) - head and x[-1 - tail] == y[-1 - tail]:
        tail += 1
    a, b, x, y = a[head : len(a) - tail], b[head : len(b) - tail], x[head : len(x) - tail], y[head : len(y) - tail]
    n, m = len(x), len(y)
    best = [[0.0] * (m + 1) for _ in range(n + 1)]
    for i in range(n - 1, -1, -1):
        row, below, xi = best[i], best[i + 1], x[i]
        for j in range(m - 1, -1, -1):
            e = 1.0 if xi == y[j] else _equal(xi, y[j])
            v = below[j] if below[j] > row[j + 1] else row[j + 1]
            if e and below[j + 1] + e > v:
                v = below[j + 1] + e
            row[j] = v
    i = j = 0
    matched, gaps, ga, gb = head + tail, [], [], []
    first = head == 0
    while i < n and j < m:
        e = _equal(x[i], y[j])
        if e and best[i][j] == best[i + 1][j + 1] + e:
            gaps.append((ga, gb, first))
            ga, gb, matched, first, i, j = [], [], matched + 1, False, i + 1, j + 1
        elif best[i][j] == best[i + 1][j]:
            ga, i = [*ga, a[i]], i + 1
        else:
            gb, j = [*gb, b[j]], j + 1
    ga, gb = ga + a[i:], gb + b[j:]
    if not tail and matched and ((cut_a and len(ga) <= 1) or (cut_b and len(gb) <= 1)):
        ga, gb = [], []
    gaps.append((ga, gb, first))
    loose = 0.0
    for p, q, start in gaps:
        if "".join(p).casefold() == "".join(q).casefold():
            matched += max(len(p), len(q))
        elif _clash(p, q, not start):
            return 0.0
        elif start and not (p and q):  # something put before the message
            loose += 0.5 * (len(p) + len(q))
        else:
            loose += max(len(p), len(q))
    return matched / (matched + loose) if matched >= 4 or not loose else 0.0
