"""Evaluation passages inside training text (problem 9), by a positional inverted index of the training text.

1. The index (:func:`build_index`): the documents in blocks of about ``BLOCK`` words; of each block its
   documents, its terms, and every term's sorted positions. It is built in one pass without a shuffle,
   stored, and serves any number of test sets.
2. Search (:func:`search`): two words in a row are found by intersecting their position lists, offset by
   one, from the rarer of the two; hits of one sentence with one start are a diagonal. A sentence can be
   located only on diagonals with enough hits, and there only as many of its words as stand near, slips
   included. The sum over a passage's sentences bounds its cover: no pair at or over the share is lost.
3. Pairs that the bound leaves are compared on the positions: sentences are located, small slips allowed,
   facts (numbers, names) not; sentences in order and close by add up. Exact phrases count as well.

No list is longer than its block, so a word in every document is no hot key. The test set is a stated
query set; it is searched in parts of about ``MOST`` passages, which every task holds.
"""

from __future__ import annotations

import re
import unicodedata
from collections import Counter, defaultdict
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from agorasift.llm.names import typo
from agorasift.llm.sentences import sentence_spans
from agorasift.session import cut

#: Test passages of one part of the search, about: they are held in every task.
MOST = 20_000
#: Words in a block of the index, about; a longer document is a block of its own.
BLOCK = 1 << 17
#: Letters of the longest word whose misspellings are looked up by left-out letters; longer ones are compared one by one.
LONG = 20
#: Words that may stand between two matched sentences of a passage.
GAP = 60
_TOKEN = re.compile(r"[぀-ヿ㐀-鿿฀-๿]|[^\W_]+")


def tokens(text: str) -> list[str]:
    """Words in one case and width; scripts without spaces character by character."""
    if not text.isascii():
        text = unicodedata.normalize("NFKC", text)
    return _TOKEN.findall(text.casefold())


def raw_tokens(text: str) -> list[str]:
    if not text.isascii():
        text = unicodedata.normalize("NFKC", text)
    return _TOKEN.findall(text)


def passage_sentences(passage: str) -> list[tuple[list[str], list[str]]]:
    """(words in one case, words as written) of each sentence; very short sentences join the one before."""
    out: list[tuple[list[str], list[str]]] = []
    for a, b in sentence_spans(passage):
        raw = raw_tokens(passage[a:b])
        if out and len(raw) < 4:
            out[-1] = (out[-1][0] + [w.casefold() for w in raw], out[-1][1] + raw)
        elif raw:
            out.append(([w.casefold() for w in raw], raw))
    return out


def _same(a: str, b: str) -> bool:
    return a == b or (not a[0].isdigit() and not b[0].isdigit() and len(a) > 3 and typo(a, b))


def _fact(w: str) -> bool:
    return w[0].isdigit() or (w[0].isupper() and w[0].lower() != w[0])


def stand_ins(passage: list[tuple[list[str], list[str]]], words: list[str]) -> list[tuple[str, ...]]:
    """The passage's words that each word of a document can stand for."""
    own = {w for s, _ in passage for w in s}
    cache = {w: tuple(v for v in own if _same(v, w)) for w in set(words)}
    return [cache[w] for w in words]


def locate(sent: list[str], raw: list[str], words: list[str], fits: list[tuple[str, ...]], at: dict[tuple, list[int]]) -> list[tuple[int, int, int]]:
    """(first position, last position, matched words) of each place where a sentence, or a good part of it, stands.

    ``fits``: the words that each document word can stand for; ``at``: positions of the document's
    word pairs. A place is a diagonal with enough shared pairs; from there the sentence is aligned
    word by word, slipping by at most two words at a time. A number or name that stands against
    another one ends the match on its side.
    """
    n = len(sent)
    diagonals: dict[int, list[int]] = defaultdict(list)
    for k in range(n - 1):
        for p in at.get((sent[k], sent[k + 1]), ()):
            diagonals[p - k].append(k)
    least = 2 if n > 4 else 1
    found, used = [], set()
    for d, seeds in sorted(diagonals.items(), key=lambda x: -len(x[1])):
        if len(seeds) < least:
            break
        if not used.isdisjoint((d - 2, d - 1, d, d + 1, d + 2)):
            continue
        used.add(d)
        k0 = seeds[len(seeds) // 2]
        right, r_end, r_clash = _extend(sent, raw, words, fits, k0, d + k0, 1)
        if r_clash:  # other facts in the same sentence
            continue
        left, l_end, l_clash = _extend(sent, raw, words, fits, k0 - 1, d + k0 - 1, -1)
        matched = right + left
        if not l_clash and (matched >= max(3, 0.3 * n) or matched == n):
            found.append((l_end, r_end, matched))
    return found


def _extend(sent: list[str], raw: list[str], words: list[str], fits: list[tuple[str, ...]], k: int, p: int, step: int) -> tuple[int, int, bool]:
    """(matched words, last matched position, did facts clash?) from sentence word k at document word p on."""
    matched, last, n, m = 0, p - step, len(sent), len(words)
    while 0 <= k < n and 0 <= p < m:
        if sent[k] in fits[p]:
            matched, last = matched + 1, p
            k, p = k + step, p + step
            continue
        best = None
        for i, j in _SLIPS:  # the nearest way back: skip words on either side
            kk, pp = k + step * i, p + step * j
            if 0 <= kk < n and 0 <= pp < m and sent[kk] in fits[pp]:
                k2, p2 = kk + step, pp + step
                if not (0 <= k2 < n and 0 <= p2 < m) or sent[k2] in fits[p2]:
                    best = (i, j)
                    break
        if best is None:
            return matched, last, False
        skipped = [raw[k + step * x] for x in range(best[0])]
        other = [words[p + step * x] for x in range(best[1])]
        if any(map(_fact, skipped)) and other and not any(_same(w.casefold(), o) for w in skipped for o in other):
            if "".join(skipped).casefold() != "".join(other):
                return matched, last, True
        k, p = k + step * best[0], p + step * best[1]
    return matched, last, False


#: Words skipped in the sentence and in the document, the fewest first.
_SLIPS = tuple((i, t - i) for t in range(1, 4) for i in range(t + 1) if i <= 2 and t - i <= 2)


def covered(
    passage: list[tuple[list[str], list[str]]], words: list[str], at: dict[tuple, list[int]], share: float = 0.0, most: list[int] | None = None, fits: list[tuple[str, ...]] | None = None
) -> float:
    """Share of the passage's words that the document holds in order, as one stretch or briefly interrupted.

    ``most``: upper bounds of the words of each sentence; 0 may be returned once they cannot reach ``share``.
    """
    total = sum(len(s) for s, _ in passage)
    most = [len(s) for s, _ in passage] if most is None else most
    fits = stand_ins(passage, words) if fits is None else fits
    places: list[list[tuple[int, int, int]]] = [[] for _ in passage]
    hope = sum(most)
    for i in sorted(range(len(passage)), key=lambda i: -most[i]):
        if hope < share * total - 1e-9:
            return 0.0
        if most[i]:
            places[i] = locate(*passage[i], words, fits, at)
            hope -= most[i] - max((m for _, _, m in places[i]), default=0)
    best_all, rows = 0, []
    for i, options in enumerate(places):
        for a, b, m in options:
            best = m
            for j, (x, y, c) in rows:
                if j < i and -3 <= a - y <= GAP and c + m > best:
                    best = c + m
            rows.append((i, (a, b, best)))
            best_all = max(best_all, best)
    return best_all / total if total else 0.0


def pair_positions(words: list[str], wanted: set | None = None) -> dict[tuple, list[int]]:
    at: dict[tuple, list[int]] = defaultdict(list)
    for p in range(len(words) - 1):
        pair = (words[p], words[p + 1])
        if wanted is None or pair in wanted:
            at[pair].append(p)
    return at


def _left_out(w: str) -> set[str]:
    """A word, and what is left of it without as many letters as ``typo`` allows slips."""
    out = last = {w}
    for _ in range(1 if len(w) < 9 else 2):
        last = {x[:i] + x[i + 1 :] for x in last for i in range(len(x))}
        out = out | last
    return out


def _numbers() -> dict[str, int]:
    """A dict that numbers its keys in the order in which they are first looked up."""
    terms: dict[str, int] = defaultdict()
    terms.default_factory = terms.__len__
    return terms


def build_index(documents: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The positional inverted index of ``documents``: ``block, docs, starts, terms, counts, at``, one row per block.

    Document i of a block has the positions ``starts[i]`` to ``starts[i + 1]``, the last one of them empty.
    Term j occurs ``counts[j]`` times; its positions follow those of term j - 1 in ``at``, ascending. Null
    ids and texts are left out. Write the result to a table to search it again.
    """
    kind = dict(documents.dtypes)[doc_id]

    def row(block: str, docs: list, lists: list[list[int]], terms: dict[str, int]) -> tuple:
        sizes = np.array([len(x) + 1 for x in lists])
        starts = np.concatenate(([0], np.cumsum(sizes)))
        ids = np.fromiter((w for x in lists for w in x), np.int64, int(sizes.sum()) - len(lists))
        gaps = np.repeat(np.arange(len(lists)), sizes - 1)
        order = np.argsort(ids, kind="stable")
        return block, docs, starts.astype("int32"), list(terms), np.bincount(ids, minlength=len(terms)).astype("int32"), (order + gaps[order]).astype("int32")

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names = ["block", "docs", "starts", "terms", "counts", "at"]
        part, made, n = TaskContext.get().partitionId(), 0, 0
        docs, lists, terms = [], [], _numbers()
        for pdf in batches:
            for d, t in zip(pdf["d"], pdf["t"]):
                words = tokens(t)
                docs.append(d)
                lists.append(list(map(terms.__getitem__, words)))
                n += len(words)
                if n >= BLOCK:
                    yield pd.DataFrame([row(f"{part}-{made}", docs, lists, terms)], columns=names)
                    made, n, docs, lists, terms = made + 1, 0, [], [], _numbers()
        if docs:
            yield pd.DataFrame([row(f"{part}-{made}", docs, lists, terms)], columns=names)

    rows = documents.where(F.col(doc_id).isNotNull() & F.col(text).isNotNull()).select(F.col(doc_id).alias("d"), F.col(text).alias("t"))
    return rows.mapInPandas(work, f"block string, docs array<{kind}>, starts array<int>, terms array<string>, counts array<int>, at array<int>")


def _spans(first: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(first[i] .. first[i] + n[i] - 1 for every i, one after another; the i of each)."""
    row = np.repeat(np.arange(len(n)), n)
    return np.arange(len(row)) - (np.cumsum(n) - n)[row] + first[row], row


class Block:
    """One block of the index with its position lists and its running text of term numbers."""

    def __init__(self, docs: np.ndarray, starts: np.ndarray, terms: np.ndarray, counts: np.ndarray, at: np.ndarray) -> None:
        self.docs, self.starts, self.terms, self.counts, self.at = docs, starts.astype(np.int64), terms, counts.astype(np.int64), at.astype(np.int64)
        self.first = np.cumsum(self.counts) - self.counts
        self.stream = np.full(int(self.starts[-1]) + 1, len(terms))  # also between documents: no term
        self.stream[self.at] = np.repeat(np.arange(len(terms)), self.counts)
        self.doc_of = np.repeat(np.arange(len(docs)), np.diff(self.starts))

    def words(self, doc: int) -> list[str]:
        return self.terms[self.stream[self.starts[doc] : self.starts[doc + 1] - 1]].tolist()


class Search:
    """All passages of one part of the test set against blocks of the index."""

    def __init__(self, passages: list[list[tuple[list[str], list[str]]]], share: float) -> None:
        self.passages, self.share = passages, share
        number: dict[str, int] = {}
        own, size, flat, at = [], [], [], [0]
        pairs: dict[tuple[int, int], list[tuple[int, int]]] = defaultdict(list)
        for k, p in enumerate(passages):
            for s, _ in p:
                w = [number.setdefault(x, len(number)) for x in s]
                for o in range(len(s) - 1):
                    pairs[w[o], w[o + 1]].append((len(own), o))
                own.append(k)
                size.append(len(s))
                flat += w
                at.append(len(flat))
        self.number = number
        self.own, self.size, self.flat, self.begins = (np.array(x, np.int64) for x in (own, size, flat, at))
        self.total = np.bincount(self.own, weights=self.size, minlength=len(passages))
        #: How often each passage holds each word, for test sets that are small enough.
        self.uses_of = None
        if len(passages) * len(number) <= 1 << 24:
            self.uses_of = np.zeros((len(passages), len(number)), np.float32)
            np.add.at(self.uses_of, (np.repeat(self.own, self.size), self.flat), 1)
        self.pair = np.array(list(pairs), np.int64).reshape(-1, 2)
        uses = list(pairs.values())
        self.uses_n = np.array([len(x) for x in uses], np.int64)
        self.uses_first = np.cumsum(self.uses_n) - self.uses_n
        self.uses = np.array([x for v in uses for x in v], np.int64).reshape(-1, 2)
        self.begin = np.searchsorted(self.own, np.arange(len(passages) + 1))
        self.single = [(p[0][0][0], k) for k, p in enumerate(passages) if len(p) == 1 and len(p[0][0]) == 1]
        slips: dict[str, list[str]] = defaultdict(list)
        loose = [v for v in number if len(v) > 3 and not v[0].isdigit()]
        for v in loose:
            for x in _left_out(v) if len(v) <= LONG else ():
                slips[x].append(v)
        long = [v for v in loose if len(v) > LONG - 4]

        @lru_cache(maxsize=500_000)
        def alike(w: str) -> tuple[int, ...]:
            """Passage words that a document's word can stand for."""
            near: set | list = set()
            if len(w) > 2 and not w[0].isdigit():
                near = long if len(w) > LONG - 2 else {v for x in _left_out(w) for v in slips.get(x, ())}
            return tuple(sorted({number[v] for v in near if _same(v, w)} | {number[v] for v in ({w} & number.keys())}))

        self.alike = alike
        names = list(number)
        self.fits = lru_cache(maxsize=500_000)(lambda w: tuple(names[v] for v in alike(w)))

    def _diagonals(self, b: Block, term_of: np.ndarray, possible: np.ndarray | None) -> tuple[np.ndarray, ...]:
        """(sentence, document, start, its middle pair's place in the sentence) of every diagonal with enough pairs of words in a row.

        ``possible`` [passage, document], where given, tells which need no look.
        """
        none = np.empty(0, np.int64)
        t = term_of[self.pair]
        j = np.flatnonzero((t >= 0).all(1))
        if not len(j):
            return none, none, none, none
        left, right = t[j, 0], t[j, 1]
        by_left = b.counts[left] <= b.counts[right]
        rare, other, step = np.where(by_left, left, right), np.where(by_left, right, left), np.where(by_left, 1, -1)
        where, row = _spans(b.first[rare], b.counts[rare])  # the rarer word's list, offset by one against the other's
        p = b.at[where]
        hit = b.stream[p + step[row]] == other[row]
        p, row = p[hit] - (step[row[hit]] < 0), row[hit]
        where, row2 = _spans(self.uses_first[j[row]], self.uses_n[j[row]])
        sent, offset = self.uses[where].T if len(where) else (none, none)
        p = p[row2]
        doc = b.doc_of[p]
        if possible is not None:
            may = possible[self.own[sent], doc]
            sent, offset, p, doc = sent[may], offset[may], p[may], doc[may]
        pad = int(self.size.max())
        start = p - offset - b.starts[doc] + pad
        wide = int(np.diff(b.starts).max()) + 2 * pad
        if len(self.own) * len(b.docs) * wide * pad < 1 << 63:
            code, offset = np.divmod(np.sort(((sent * len(b.docs) + doc) * wide + start) * pad + offset), pad)
            new = np.flatnonzero(np.concatenate(([True], code[1:] != code[:-1]))) if len(code) else none
            sent, doc = np.divmod(code[new] // wide, len(b.docs))
            start = code[new] % wide
        else:  # very many short documents beside a very long one
            order = np.lexsort((offset, start, doc, sent))
            sent, doc, start, offset = sent[order], doc[order], start[order], offset[order]
            new = np.flatnonzero(np.concatenate(([True], (sent[1:] != sent[:-1]) | (doc[1:] != doc[:-1]) | (start[1:] != start[:-1]))))
            sent, doc, start = sent[new], doc[new], start[new]
        n = np.diff(np.append(new, len(offset)))
        middle = offset[new + n // 2]
        ok = n >= np.where(self.size[sent] > 4, 2, 1)  # as in locate
        return sent[ok], doc[ok], (start + b.starts[doc] - pad)[ok], middle[ok]

    def _hopeful(self, key: np.ndarray, n_docs: int, sent: np.ndarray, words: np.ndarray) -> np.ndarray:
        """Which rows belong to a (passage, document) that so many words of each of its sentences let reach the share?

        ``key``: passage * n_docs + document of each row; a sentence counts with its best row.
        """
        code, at = np.unique(key * len(self.own) + sent, return_inverse=True)
        best = np.zeros(len(code), np.int64)
        np.maximum.at(best, at, words)
        pair, at2 = np.unique(code // len(self.own), return_inverse=True)
        reach = np.bincount(at2, weights=best) >= self.share * self.total[pair // n_docs] - 1e-9
        return reach[at2][at]

    def _windows(self, sent: np.ndarray, low: np.ndarray, high: np.ndarray, start: np.ndarray | None, middle: np.ndarray | None) -> tuple[np.ndarray, ...]:
        """(row of ``sent``, word, first and last position) of every word: between ``low`` and ``high``, and as near the diagonal as slips from its middle pair allow."""
        where, row = _spans(self.begins[sent], self.size[sent])
        low, high = low[row], high[row]
        if start is not None:
            offset = where - self.begins[sent][row]
            slack = np.abs(offset - middle[row]) + 3
            low, high = np.maximum(low, start[row] + offset - slack), np.minimum(high, start[row] + offset + slack)
        return row, self.flat[where], low, np.maximum(high, low)

    def _known(self, stands: np.ndarray, span: int, sent: np.ndarray, low: np.ndarray, high: np.ndarray, start: np.ndarray | None = None, middle: np.ndarray | None = None) -> np.ndarray:
        """How many words of each sentence stand in their windows."""
        row, word, low, high = self._windows(sent, low, high, start, middle)
        at = np.searchsorted(stands, word * span + low)
        hit = (at < len(stands)) & (stands[np.minimum(at, len(stands) - 1)] <= word * span + high)
        return np.bincount(row, weights=hit, minlength=len(sent)).astype(np.int64)

    def candidates(self, b: Block) -> dict[tuple[int, int], dict[int, int]]:
        """(passage, document of the block): the most words of each of its sentences that can be located, where they may reach the share."""
        exact = np.full(len(self.number), -1)
        stand_words, stand_terms = [], []
        for j, w in enumerate(b.terms.tolist()):
            for v in self.alike(w):
                stand_words.append(v)
                stand_terms.append(j)
            if w in self.number:
                exact[self.number[w]] = j
        n_docs = len(b.docs)
        terms, words = np.array(stand_terms, np.int64), np.array(stand_words, np.int64)
        where, row = _spans(b.first[terms], b.counts[terms])
        at = b.at[where]
        here = possible = None
        if len(self.number) * n_docs <= 1 << 28:  # which passage words stand in which document
            here = np.zeros((len(self.number), n_docs), bool)
            here[words[row], b.doc_of[at]] = True
            if self.uses_of is not None:
                possible = self.uses_of @ here.astype(np.float32) >= (self.share * self.total - 1e-3)[:, None]
        sent, doc, start, middle = self._diagonals(b, exact, possible)

        def narrow(words: np.ndarray) -> None:
            nonlocal sent, doc, start, middle
            ok = self._hopeful(self.own[sent] * n_docs + doc, n_docs, sent, words)
            sent, doc, start, middle = sent[ok], doc[ok], start[ok], middle[ok]

        narrow(self.size[sent])
        if not len(sent):
            return {}
        span = b.starts[-1] + 1
        stands = np.sort(words[row] * span + at)
        # words that stand anywhere in the document
        code, back = np.unique(sent * n_docs + doc, return_inverse=True)
        s, d = np.divmod(code, n_docs)
        if here is not None:
            where, row = _spans(self.begins[s], self.size[s])
            narrow(np.bincount(row, weights=here[self.flat[where], d[row]], minlength=len(s)).astype(np.int64)[back])
        else:
            narrow(self._known(stands, span, s, b.starts[d], b.starts[d + 1] - 2)[back])
        if not len(sent):
            return {}
        # words near the diagonal: each slip moves by two words at most and takes two equal ones, but at the ends
        if len(self.number) * (span // 32 + 2) <= 1 << 26:  # first by stretches of 32 positions
            wide = span // 32 + 2
            have = np.zeros((len(self.number), wide), np.int32)
            have[stands // span, stands % span // 32 + 1] = 1
            have = np.cumsum(have, axis=1, dtype=np.int32).ravel()
            r, word, low, high = self._windows(sent, b.starts[doc], b.starts[doc + 1] - 2, start, middle)
            narrow(np.bincount(r, weights=have[word * wide + high // 32 + 1] > have[word * wide + low // 32], minlength=len(sent)).astype(np.int64))
            if not len(sent):
                return {}
        n = self.size[sent]
        m = self._known(stands, span, sent, b.starts[doc], b.starts[doc + 1] - 2, start, middle)
        m[(m < np.maximum(3, 0.3 * n)) & (m < n)] = 0
        ok = self._hopeful(self.own[sent] * n_docs + doc, n_docs, sent, m)
        out: dict[tuple[int, int], dict[int, int]] = defaultdict(dict)
        for s, d, x in zip(sent[ok].tolist(), doc[ok].tolist(), m[ok].tolist()):
            most = out[int(self.own[s]), d]
            most[s] = max(x, most.get(s, 0))
        return out

    def __call__(self, b: Block) -> list[tuple[int, object, float]]:
        """(passage, document id, share) of every document that holds at least the share."""
        out = []
        if self.single:
            at = {w: j for j, w in enumerate(b.terms.tolist())}
            for w, k in self.single:
                if w in at:
                    p = b.at[b.first[at[w]] : b.first[at[w]] + b.counts[at[w]]]
                    out += [(k, b.docs[d], 1.0) for d in np.unique(np.searchsorted(b.starts, p, side="right") - 1)]
        by_doc: dict[int, list] = defaultdict(list)
        for (k, d), most in self.candidates(b).items():
            by_doc[d].append((k, most))
        for d, likely in by_doc.items():
            words = b.words(d)
            fits = [self.fits(w) for w in words]
            every = pair_positions(words)
            for k, most in likely:
                c = covered(self.passages[k], words, every, self.share, [most.get(s, 0) for s in range(self.begin[k], self.begin[k + 1])], fits)
                if c >= self.share:
                    out.append((k, b.docs[d], c))
        return out


def search(index: DataFrame, items: DataFrame, *, share: float = 0.5, doc_id: str = "doc_id", most: int = MOST) -> DataFrame:
    """``item_id, doc_id, share``: indexed documents that hold at least ``share`` of an item's passage.

    Equal passages are searched once and reported under each of their item_ids. Null passages and
    item_ids take no part; an empty side gives an empty result. Passages of one word and more are
    searched. A test set of more than ``most`` items is searched in parts, so every passage is used.
    """
    spark = index.sparkSession
    kind, item = dict(index.dtypes)["docs"][6:-1], dict(items.dtypes)["item_id"]
    listed = items.where("item_id is not null and passage is not null").select("item_id", "passage").distinct()
    parts = -(-listed.count() // most) or 1
    out = spark.createDataFrame([], f"item_id {item}, {doc_id} {kind}, share double")
    for part in range(parts):
        rows = listed.where(F.pmod(F.xxhash64("passage"), F.lit(parts)) == part).collect()  # about ``most`` rows
        texts = sorted({r["passage"] for r in rows})
        number = {t: k for k, t in enumerate(texts)}
        held = spark.sparkContext.broadcast([passage_sentences(t) for t in texts])

        def work(batches: Iterator[pd.DataFrame], held=held) -> Iterator[pd.DataFrame]:  # noqa: ANN001
            find = Search(held.value, share)
            for pdf in batches:
                for row in zip(pdf["docs"], pdf["starts"], pdf["terms"], pdf["counts"], pdf["at"]):
                    yield pd.DataFrame(find(Block(*row)), columns=["k", "d", "c"])

        names = spark.createDataFrame([(r["item_id"], number[r["passage"]]) for r in rows], f"item_id {item}, k int")
        good = index.mapInPandas(work, f"k int, d {kind}, c double").join(F.broadcast(names), "k")
        out = out.unionByName(good.groupBy("item_id", F.col("d").alias(doc_id)).agg(F.max("c").alias("share")))
    return out


def leaks(documents: DataFrame, items: DataFrame, *, share: float = 0.5, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """:func:`search` over an index of ``documents`` built for the occasion."""
    return search(cut(build_index(documents, doc_id, text)), items, share=share, doc_id=doc_id)


def verbatim(documents: DataFrame, items: DataFrame) -> DataFrame:
    """``item_id, doc_id`` of passages that stand in a document character by character."""
    near = leaks(documents, items, share=0.9).select("item_id", "doc_id")
    return near.join(items.select("item_id", "passage"), "item_id").join(documents.select("doc_id", "text"), "doc_id").where(F.contains("text", "passage")).select("item_id", "doc_id").distinct()
