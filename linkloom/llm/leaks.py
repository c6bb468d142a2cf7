"""Held-out test passages inside training documents.

The test items are a stated query set: their sentences are indexed with BM25
impacts in posting blocks that know their greatest impact. A training text is first
screened: to hold a sentence it must hold one of its signature words (the rarest ones
that make up more weight than may be missing) and enough of its weight, and two
neighbouring sentences must be possible. Its passages (overlapping windows of its whole text) are then run against
the index with block-max WAND, which returns all sentences above a threshold and
skips the rest, and candidates are verified on the text: a sentence counts if a
stretch of the document holds most of its weight and most of its rare words (or
nearly all its weight and one of them), letting single letters differ; a document
leaks an item if two neighbouring sentences of the item count. How much of the
item's question and answer the document holds too is reported with each case.

Nothing that verification would accept is lost before it: impacts are divided by the
least score that an accepted stretch can have, so that 1 is the threshold, and a
window is wide enough to hold any accepted stretch whole.

Scale: one narrow pass over the documents; nothing is shuffled but the result. Items
go in blocks of `BLOCK` rows, so the index a worker holds is bounded and is built
once per worker and block. With several blocks the one pass keeps the documents that
hold signature words of any block (their number is bounded by the items' vocabulary),
and the blocks run over those.

Defined results
* null, empty, blank text or passage: no leak
* passages of a single sentence: that sentence must count
* items that share a passage: each is a case; repeated (doc, item) rows: one row
* surface changes that are undone: case, markup, width, accents, invisible
  characters, look-alike letters, line breaks, punctuation, few missing, added or misspelt words
* null question or answer: share 0 of it; very long text and very long sentences:
  all of it, window by window; extra columns: ignored
"""

from __future__ import annotations

import html
import itertools
import math
import re
import unicodedata
import uuid
from bisect import bisect_left
from collections import Counter, defaultdict
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..runtime import cut, spread

BLOCK, POSTING_BLOCK = 20_000, 2
COVER, RARE_COVER, HIGH_COVER = 0.6, 0.6, 0.74
K1, B = 1.2, 0.75

# Cyrillic and Greek letters that look like Latin ones.
LOOKALIKES = str.maketrans("аеорсухкмтнвіјѕԁһԛԝɡαεορτυνικ", "aeopcyxkmthbijsdhqwgaeoptuvik")
_TAG, _WORD, _CUT = re.compile(r"</?[A-Za-z!][^<>]*>"), re.compile(r"[^\W_]+"), re.compile(r"(?<=[.!?])\s+|(?<=[。！？])")
_UNSEEN = regex.compile(r"[\p{Cf}\p{Mn}]+")


def words(text: str) -> list[str]:
    """Words of a text with surface changes undone."""
    text = html.unescape(_TAG.sub(" ", text)) if "<" in text or "&" in text else text
    if not text.isascii():
        text = _UNSEEN.sub("", unicodedata.normalize("NFKD", text))
        return [w if w.isascii() else w.translate(LOOKALIKES) for w in _WORD.findall(text.casefold())]
    return _WORD.findall(text.lower())


def span_of(n: int) -> int:
    """Words that a stretch holding a sentence of n words may span."""
    return 2 * n + 4


def sentences(passage: str) -> list[str]:
    return [s for s in _CUT.split(passage.strip()) if s]


def heads(w: str) -> set[str]:
    """First two letters of the words that one changed letter or swap may have made w of."""
    return {w[:2], w[1:3], w[1::-1], w[:1] + w[2:3]}


class Postings:
    """Units of a term with its impacts, cut into blocks of POSTING_BLOCK unit numbers that know their greatest impact."""

    __slots__ = ("units", "impacts", "most", "blocks", "block_most", "within")

    def __init__(self, pairs: list[tuple[int, float]]):
        pairs.sort()
        self.units, self.impacts = [u for u, _ in pairs], [x for _, x in pairs]
        self.most = max(self.impacts)
        blocks = [u // POSTING_BLOCK for u in self.units]
        starts = [i for i, b in enumerate(blocks) if not i or b != blocks[i - 1]]
        ends = [*starts[1:], len(blocks)]
        self.blocks = np.array([blocks[i] for i in starts])
        self.block_most = np.array([max(self.impacts[i:j]) for i, j in zip(starts, ends)])
        self.within = {blocks[i]: (i, j, m) for i, j, m in zip(starts, ends, self.block_most.tolist())}


class Index:
    """BM25 index of test sentences; unit u is sentence pos[u] of item[u]. items: (key, passage, question, answer)."""

    def __init__(self, items: Iterable[tuple]):
        self.item, self.pos, self.words = [], [], []
        self.last: dict[int, int] = {}
        self.asked: dict[int, tuple[frozenset[str], frozenset[str]]] = {}
        for key, passage, *asked in items:
            self.asked[key] = tuple(frozenset(words(x or "")) for x in (*asked, None, None)[:2])
            ss = [w for s in sentences(passage or "") if (w := words(s))]
            for i, w in enumerate(ss):
                self.item.append(key), self.pos.append(i), self.words.append(w)
            self.last[key] = len(ss) - 1
        distinct = {tuple(w) for w in self.words}  # shared passages count once
        df, n = Counter(t for w in distinct for t in set(w)), len(distinct)
        self.idf = {t: math.log(1 + (n - c + 0.5) / (c + 0.5)) for t, c in df.items()}
        self.rare_at = max(1, n // 100)
        self.rare = {t for t, c in df.items() if c <= self.rare_at}
        mean = sum(map(len, self.words)) / max(1, len(self.words))
        lists: dict[str, list[tuple[int, float]]] = defaultdict(list)
        for u, w in enumerate(self.words):
            tf = Counter(w)
            norm = K1 * (1 - B + B * len(w) / mean)
            raw = {t: self.idf[t] * c * (K1 + 1) / (c + norm) for t, c in tf.items()}
            # the least score of words that make up COVER of the weight: those with least impact per weight first
            left = COVER * sum(self.idf[t] for t in tf)
            least = 0.0
            for t in sorted(raw, key=lambda t: raw[t] / self.idf[t]):
                least += raw[t] * min(1.0, left / self.idf[t])
                if (left := left - self.idf[t]) <= 0:
                    break
            for t, x in raw.items():
                lists[t].append((u, x / least * (1 + 1e-9)))
        self.postings = {t: Postings(p) for t, p in lists.items()}
        self.known_words = frozenset(self.postings)
        self.window = 2 * span_of(max(map(len, self.words), default=1))
        self.signed: dict[str, list[int]] = defaultdict(list)
        self.weights, self.need = [], []
        for u, w in enumerate(self.words):
            weight, have = sum(self.idf[t] for t in set(w)), 0.0
            self.weights.append([(t, self.idf[t]) for t in dict.fromkeys(w)])
            self.need.append(COVER * weight * (1 - 1e-9))
            for t in sorted(set(w), key=lambda t: (df[t], t)):
                self.signed[t].append(u)
                if (have := have + self.idf[t]) > (1 - COVER) * weight * (1 + 1e-9):
                    break
        self.by_head = defaultdict(list)
        for t in self.rare:
            self.by_head[t[:2]].append(t)
        self.known: dict[str, str] = {}

    def search(self, terms: Iterable[str], threshold: float = 1.0) -> list[int]:
        """All units whose normalised score reaches the threshold: WAND within the blocks whose greatest impacts together reach it."""
        lists = [p for t in terms if (p := self.postings.get(t))]
        if sum(p.most for p in lists) < threshold:
            return []
        upper = np.bincount(np.concatenate([p.blocks for p in lists]), np.concatenate([p.block_most for p in lists]))
        out: list[int] = []
        for block in np.flatnonzero(upper >= threshold).tolist():
            out += self._wand([(p, *at) for p in lists if (at := p.within.get(block))], threshold)
        return out

    @staticmethod
    def _wand(lists: list[tuple[Postings, int, int, float]], threshold: float) -> list[int]:
        """One block: cursors in order of their unit; the pivot is the first unit that the bounds up to it can carry over the threshold."""
        out, at = [], [lo for _, lo, _, _ in lists]
        live = list(range(len(lists)))
        while live:
            live.sort(key=lambda i: lists[i][0].units[at[i]])
            bound, k = 0.0, 0
            for k, i in enumerate(live):
                bound += lists[i][3]
                if bound >= threshold:
                    break
            else:
                break
            pivot = lists[live[k]][0].units[at[live[k]]]
            while k + 1 < len(live) and lists[live[k + 1]][0].units[at[live[k + 1]]] == pivot:
                k += 1
            if lists[live[0]][0].units[at[live[0]]] == pivot:
                score = 0.0
                for i in live[: k + 1]:
                    score += lists[i][0].impacts[at[i]]
                    at[i] += 1
                if score >= threshold:
                    out.append(pivot)
            else:
                for i in live[: k + 1]:
                    at[i] = bisect_left(lists[i][0].units, pivot, at[i], lists[i][2])
            live = [i for i in live if at[i] < lists[i][2]]
        return out

    def mended(self, w: str) -> str:
        """The one rare word that differs from w by a swap, a missing, added or other letter; else w."""
        if len(w) < 5 or w in self.postings:
            return w
        if w not in self.known:
            if len(self.known) > 200_000:  # a cache, refilled when full
                self.known.clear()
            near = {t for head in heads(w) for t in self.by_head.get(head, ()) if abs(len(t) - len(w)) < 2 and one_apart(t, w)}
            self.known[w] = near.pop() if len(near) == 1 else w
        return self.known[w]

    def counts(self, u: int, seq: list[str]) -> bool:
        """Whether some stretch of seq holds the sentence u."""
        unit = self.words[u]
        span = span_of(len(unit))
        need = set(unit)
        at = [i for i, w in enumerate(seq) if w in need]
        weight = sum(self.idf[t] for t in need)
        rare = need & self.rare
        lo, have, have_weight, have_rare = 0, Counter(), 0.0, 0
        for i in at:
            w = seq[i]
            have[w] += 1
            if have[w] == 1:
                have_weight += self.idf[w]
                have_rare += w in rare
            while i - at[lo] >= span:
                v = seq[at[lo]]
                lo += 1
                have[v] -= 1
                if not have[v]:
                    have_weight -= self.idf[v]
                    have_rare -= v in rare
            if have_weight >= COVER * weight and have_rare >= RARE_COVER * len(rare):
                return True
            if have_weight >= HIGH_COVER * weight and have_rare:
                return True
        return False

    def possible(self, ws: set[str]) -> bool:
        """Whether two neighbouring sentences of an item (or the only one) may be held by a text of the words ws: each has a signature word among them, and enough weight."""
        enough: dict[int, bool] = {}
        for u in {u for w in ws & self.signed.keys() for u in self.signed[w]}:
            enough[u] = sum(x for t, x in self.weights[u] if t in ws) >= self.need[u]
        return any(ok and (not self.last[self.item[u]] or (self.pos[u] < self.last[self.item[u]] and enough.get(u + 1, False))) for u, ok in enough.items())

    def leaks(self, text: str | None) -> list[tuple[int, int, float, float]]:
        """(item, its sentences that count, share of the question's words, share of the answer's words) where the text holds two neighbouring sentences."""
        seq = words(text) if text else []
        held = set(seq)
        strange = held - self.known_words
        mended = {w: m for w in strange if len(w) > 4 and (m := self.mended(w)) is not w}
        held.difference_update(strange)
        held.update(mended.values())
        if not self.possible(held):
            return []
        if mended:
            seq = [mended.get(w, w) for w in seq]
        found: dict[int, set[int]] = defaultdict(set)
        step = self.window // 2
        for lo in range(0, max(1, len(seq) - step), step):
            for u in self.search(set(seq[lo : lo + self.window])):
                found[self.item[u]].add(u)
        out, held = [], set(seq)  # with words that no passage has, but perhaps a question
        for item, units in found.items():
            near = {u for u in units if not self.last[item] or u - 1 in units or u + 1 in units}
            sure = {u for u in near if self.counts(u, seq)}
            if any(not self.last[item] or u + 1 in sure for u in sure):
                out.append((item, len(sure), *(len(x & held) / len(x) if x else 0.0 for x in self.asked[item])))
        return out


def one_apart(a: str, b: str) -> bool:
    """Equal but for one letter, or one swap of neighbours."""
    if a == b:
        return True
    i, n = 0, min(len(a), len(b))
    while i < n and a[i] == b[i]:
        i += 1
    if len(a) == len(b):
        return a[i + 1 :] == b[i + 1 :] or (i + 1 < n and a[i] == b[i + 1] and a[i + 1] == b[i] and a[i + 2 :] == b[i + 2 :])
    return a[i + 1 :] == b[i:] if len(a) > len(b) else a[i:] == b[i + 1 :]


_BUILT: dict[str, Index] = {}


def _index(token: str, rows: list[tuple]) -> Index:
    """The index of a block, built once per Python worker."""
    if token not in _BUILT:
        _BUILT.clear()
        _BUILT[token] = Index(rows)
    return _BUILT[token]


class Screen:
    """Texts that hold a signature word of any block, or a word one letter off."""

    def __init__(self, signed: set[str]):
        self.signed, self.by_head, self.known = signed, defaultdict(list), {}
        for t in signed:
            self.by_head[t[:2]].append(t)

    def _near(self, w: str) -> bool:
        if w not in self.known:
            if len(self.known) > 200_000:  # a cache, refilled when full
                self.known.clear()
            self.known[w] = any(abs(len(t) - len(w)) < 2 and one_apart(t, w) for head in heads(w) for t in self.by_head.get(head, ()))
        return self.known[w]

    def passes(self, ws: set[str]) -> bool:
        return not self.signed.isdisjoint(ws) or any(len(w) >= 5 and self._near(w) for w in ws)


def _blocks(items: DataFrame) -> Iterator[list[tuple]]:
    """Items in blocks of BLOCK rows; the driver holds one at a time."""
    rows = items.select("item_id", "passage", *[F.col(c) if c in items.columns else F.lit(None).alias(c) for c in ("question", "answer")]).orderBy("item_id").toLocalIterator()
    while block := [tuple(r) for r in itertools.islice(rows, BLOCK)]:
        yield block


def leaked(documents: DataFrame, items: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, item_id, n_sentences, question_share, answer_share), one row per case."""
    kind = documents.schema[key].dataType.simpleString()
    sc = documents.sparkSession.sparkContext
    docs = spread(documents.select(key, text).where(F.col(text).isNotNull()), key)

    def searching(held):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            index = _index(*held.value)
            for b in batches:
                found = [(k, *case) for k, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist()) for case in index.leaks(t)]
                if found:
                    kinds = (b.schema.field(0).type, pa.int64(), pa.int32(), pa.float64(), pa.float64())
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*found), kinds)], [key, "item_id", "n_sentences", "question_share", "answer_share"])

        return run

    def screening(held):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            screen = Screen(held.value)
            for b in batches:
                yield b.filter(pa.array([screen.passes(set(words(t))) for t in b.column(1).to_pylist()], pa.bool_()))

        return run

    blocks, more = _blocks(items), None
    first = next(blocks, [])
    if len(first) == BLOCK:  # perhaps several blocks: the documents are read once, by the signature words of all
        signed = {t for block in itertools.chain([first], blocks) for t in Index(block).signed}
        docs = cut(docs.mapInArrow(screening(sc.broadcast(signed)), f"`{key}` {kind}, `{text}` string"))
        blocks = _blocks(items)
        first = next(blocks)
    out = None
    for block in itertools.chain([first], blocks):
        one = docs.mapInArrow(searching(sc.broadcast((uuid.uuid4().hex, block))), f"`{key}` {kind}, item_id bigint, n_sentences int, question_share double, answer_share double")
        out = one if out is None else out.unionByName(one)
    return out.groupBy(key, "item_id").agg(*[F.max(c).alias(c) for c in ("n_sentences", "question_share", "answer_share")])
