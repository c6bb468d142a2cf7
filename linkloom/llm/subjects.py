"""Subject areas of documents from labelling functions without hand-set weights.

Every sentence of a text is labelled by functions that may abstain:
  lexicon  its words: words of the labelled samples that the corpus confirms, and words
           learned from the corpus by the subjects of the *other* sentences of their
           documents, so wordings missing from the samples count. Both are one vote,
           whose strength says which of them spoke and whether they agree
  section  whether the rest of the document deals with the sentence's subject too
  address  the subject that dominates the reviewed item's other sentences
  source   the subject that dominates the document's source
Words around a subject's words whose subject seldom agrees with the rest of the
document are frames of passing comparisons; such sentences are voted 'none'.
A latent-class model learns each function's accuracy, at each strength of its vote,
from the agreement of the votes over the whole corpus (EM over vote patterns). The
section's vote depends on what the lexicon says, and is modelled given that. A
document has a subject if the posterior probability that two or more of its sentences
deal with it exceeds one half.

Languages are those of the samples: a sentence's language is told by the words that
are frequent in the samples of one language and in no other's, so the rates that words
are compared with are their own language's, whatever its share of the corpus.

Scale: texts are tokenised once, into hashes of words, and stored; all later passes
are array operations on those. Word statistics are combined per batch and summed by
hash aggregation, the choice of words runs on the summed rows where they lie; only
chosen words reach the driver (16 bytes each). Words that can't have been seen
MIN_DF times are left out of the statistics by a table of counters of fixed size,
which never counts too little. Vote patterns are bounded by the number of classes.
The samples are read up to MAX_SAMPLES rows, the documented bound of the fitted sample.

Defined results
* null, empty, blank text: no subject
* a text of one sentence: no subject; repeated sentences count each time
* sentences are cut at . ! ? (also wide ones), line breaks and markup
* very long text: whole; ties in votes: the posterior decides
* samples without subject: evidence for 'none'; extra columns: ignored
* item and source columns may be absent or null: those functions abstain
"""

from __future__ import annotations

import html
import itertools
import math
import re
import unicodedata
import zlib
from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..runtime import cut, if_small, spread

MIN_DF, MAX_SAMPLES, ROUNDS = 5, 20_000, 3
PURITY, USUAL, PASSING, SEED_P = 0.3, 0.5, 0.5, 2e-2
LEAST, LIFT, Z, SEED_N, STARTS = 3, 3.0, 4, 2, 3
MARK_RATE, MARK_LIFT, MARK_SAMPLES = 0.1, 5.0, 5
DOMINANT, DOMINANT_DOCS = 0.5, 10
CELLS = 1 << 22
_TAG, _CUT, _WORD = re.compile(r"</?[A-Za-z!][^<>]*>"), re.compile(r"[.!?][\"')\]*]*\s+|\n+|[。！？؟]"), re.compile(r"[^\W\d_]+")
_PLAIN = re.compile(r"[a-z]+")
_UNSEEN = regex.compile(r"\p{Cf}+")
_KNOWN: dict[str, int] = {}
F48, F47 = (1 << 48) - 1, 1 << 47


def sentences(text: str | None) -> list[list[str]]:
    """Words of each sentence; sentences without words are left out."""
    if not text:
        return []
    if "<" in text or "&" in text:
        text = html.unescape(_TAG.sub("\n", text))
    if text.isascii():
        return [w for s in _CUT.split(text.lower()) if s and (w := _PLAIN.findall(s))]
    text = _UNSEEN.sub("", unicodedata.normalize("NFKC", text))
    return [w for s in _CUT.split(text.casefold()) if s and (w := _WORD.findall(s))]


def word_id(word: str) -> int:
    """32-bit hash of a word."""
    n = _KNOWN.get(word)
    if n is None:
        if len(_KNOWN) > 500_000:  # a cache, refilled when full
            _KNOWN.clear()
        n = _KNOWN[word] = zlib.crc32(word.encode())
    return n


def tokens(text: str | None) -> tuple[list[int], list[int]]:
    """(word hashes of all sentences, words per sentence)."""
    sents = sentences(text)
    words = list(itertools.chain.from_iterable(sents))
    ids = list(map(_KNOWN.get, words))
    if None in ids:
        ids = list(map(word_id, words))
    return ids, list(map(len, sents))


class Chunk:
    """Some documents as arrays: the sentences of each, and every feature (word or pair of neighbouring words) once per sentence."""

    def __init__(self, words: np.ndarray, lens: np.ndarray, per_doc: np.ndarray):
        self.n_docs, self.n = len(per_doc), len(lens)
        self.doc = np.repeat(np.arange(len(per_doc)), per_doc)
        self.words, self.sent = words.astype(np.int64), np.repeat(np.arange(self.n), lens)
        w = self.words
        same = self.sent[1:] == self.sent[:-1]
        with np.errstate(over="ignore"):
            mixed = (w[:-1].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) ^ (w[1:].astype(np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F))
        pairs = ((mixed >> np.uint64(17)).astype(np.int64) | F47)[same]
        self.first = self.words[np.r_[0, np.cumsum(lens)[:-1]].astype(int)] if self.n else np.zeros(0, np.int64)
        f, s = np.concatenate([w, pairs]), np.concatenate([self.sent, self.sent[1:][same]])
        self.f, self.s = _unique_pairs(f, s, self.n)

    @classmethod
    def of(cls, docs: list[tuple[list[int], list[int]]]) -> Chunk:
        return cls(np.array([w for ws, _ in docs for w in ws], np.int64), np.array([n for _, ns in docs for n in ns], int), np.array([len(ns) for _, ns in docs], int))

    def where(self, keep: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return self.f[keep], self.s[keep]


def _unique_pairs(f: np.ndarray, s: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (feature, sentence), by feature."""
    if n < 1 << 16:
        key = np.sort((f.astype(np.uint64) << np.uint64(16)) | s.astype(np.uint64))
        key = key[np.r_[True, key[1:] != key[:-1]][: len(key)]]
        return (key >> np.uint64(16)).astype(np.int64), (key & np.uint64(0xFFFF)).astype(np.int64)
    order = np.lexsort((s, f))
    f, s = f[order], s[order]
    new = np.r_[True, (f[1:] != f[:-1]) | (s[1:] != s[:-1])][: len(f)]
    return f[new], s[new]


def chunks(batch: pa.RecordBatch, words: str = "words", lens: str = "lens", most: int = 4_000) -> Iterator[tuple[int, int, Chunk]]:
    """(first row, end row, chunk) of a stored batch; at most `most` documents and, but for a longer document, 60,000 sentences at once."""
    w, n = batch.column(words), batch.column(lens)
    wo, no = w.offsets.to_numpy(), n.offsets.to_numpy()
    wv, nv = w.values.to_numpy(zero_copy_only=False), n.values.to_numpy(zero_copy_only=False)
    lo = 0
    while lo < batch.num_rows:
        hi = min(batch.num_rows, lo + most, max(lo + 1, int(np.searchsorted(no, no[lo] + 60_000, "right")) - 1))
        yield lo, hi, Chunk(wv[wo[lo] : wo[hi]], nv[no[lo] : no[hi]], np.diff(no[lo : hi + 1]))
        lo = hi


class Lexicon:
    """Words that tell a subject, and frames (words around them) in which subjects are only compared with; sorted arrays."""

    def __init__(self, keys, classes, purity, passing=()):
        order = np.argsort(np.asarray(keys, np.int64))
        self.keys, self.classes, self.purity = np.asarray(keys, np.int64)[order], np.asarray(classes, np.int64)[order], np.asarray(purity, float)[order]
        self.passing = np.unique(np.asarray(passing, np.int64))

    def find(self, f: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(which features are terms, their places)."""
        if not len(self.keys):
            return np.zeros(len(f), bool), np.zeros(0, int)
        at = np.minimum(np.searchsorted(self.keys, f), len(self.keys) - 1)
        hit = self.keys[at] == f
        return hit, at[hit]

    def frames(self, f: np.ndarray) -> np.ndarray:
        if not len(self.passing):
            return np.zeros(len(f), bool)
        return self.passing[np.minimum(np.searchsorted(self.passing, f), len(self.passing) - 1)] == f


def seed_terms(samples: list[tuple[tuple[list[int], list[int]], set[int], str]], classes: int) -> Lexicon:
    """Words whose samples nearly all have one subject, beyond what its share in their language explains."""
    n, by = Counter(), defaultdict(Counter)
    lang_n, lang_c, lang_of = Counter(), Counter(), defaultdict(Counter)
    for toks, labels, lang in samples:
        lang_n[lang] += 1
        for c in labels:
            lang_c[lang, c] += 1
        for f in np.unique(Chunk.of([toks]).f).tolist():
            n[f] += 1
            lang_of[f][lang] += 1
            for c in labels:
                by[f][c] += 1
    terms = {}
    for f, m in n.items():
        if not by[f] or m < SEED_N:
            continue
        c, k = max(by[f].items(), key=lambda x: (x[1], -x[0]))
        base = sum(x * lang_c[g, c] / lang_n[g] for g, x in lang_of[f].items()) / m
        if k >= 0.8 * m and base**k * math.comb(m, k) < SEED_P:
            terms[f] = (c, k / m)
    return Lexicon(list(terms), [c for c, _ in terms.values()], [p for _, p in terms.values()])


def language_marks(samples: list[tuple[tuple[list[int], list[int]], set[int], str]]) -> tuple[np.ndarray, np.ndarray, int]:
    """(words, their language, number of languages): words in many samples of one language and in few of any other."""
    n = Counter(g for _, _, g in samples if g)
    langs = sorted(g for g, k in n.items() if k >= MARK_SAMPLES)
    seen = {g: Counter() for g in langs}
    for (ws, _), _, g in samples:
        if g in seen:
            seen[g].update(set(ws))
    out = {}
    for i, g in enumerate(langs):
        for w, k in seen[g].items():
            rate = k / n[g]
            if rate >= MARK_RATE and rate >= MARK_LIFT * max((seen[h][w] / n[h] for h in langs if h != g), default=0):
                out[w] = i
    keys = np.array(sorted(out), np.int64)
    return keys, np.array([out[k] for k in keys.tolist()], np.int64), len(langs)


def languages(c: Chunk, marks: tuple[np.ndarray, np.ndarray, int]) -> np.ndarray:
    """Number of each sentence's language by its marks; without marks that of most sentences of the document, else one more."""
    keys, lang, n = marks
    if not n or not len(keys):
        return np.full(c.n, n)
    at = np.minimum(np.searchsorted(keys, c.words), len(keys) - 1)
    hit = keys[at] == c.words
    count = np.bincount(c.sent[hit] * n + lang[at[hit]], minlength=c.n * n).reshape(c.n, n)
    own = np.where(count.max(1) > 0, count.argmax(1), n)
    told = own < n
    usual = np.bincount(c.doc[told] * n + own[told], minlength=c.n_docs * n).reshape(c.n_docs, n)
    usual = np.where(usual.max(1) > 0, usual.argmax(1), n)
    return np.where(told, own, usual[c.doc])


def told_by(c: Chunk, lex: Lexicon, classes: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(class, passing) of each sentence by its words, and the class shares that the other sentences of its document tell.

    A sentence is no evidence for those that share its surest word, so a repeated
    sentence does not confirm itself. Class 0 of the shares: nothing is told.
    """
    hit, at = lex.find(c.f)
    hs, cls, pure = c.s[hit], lex.classes[at], lex.purity[at]
    weight = np.bincount(hs * classes + cls, pure**4, c.n * classes).reshape(c.n, classes)
    told = weight.max(1, initial=0) > 0
    own = np.where(told, weight.argmax(1), 0)
    passing = np.zeros(c.n, bool)
    passing[c.s[lex.frames(c.f) & ~hit]] = True
    passing &= told
    # the surest word of each sentence that counts
    mine = np.flatnonzero((cls == own[hs]) & ~passing[hs])
    mine = mine[np.lexsort((at[mine], pure[mine], hs[mine]))]
    mine = mine[np.r_[hs[mine][1:] != hs[mine][:-1], True][: len(mine)]]
    total = np.bincount(c.doc[hs[mine]] * classes + cls[mine], minlength=c.n_docs * classes).reshape(c.n_docs, classes)
    rest = total[c.doc].astype(float)
    if len(mine):
        size = len(lex.keys)
        key, n = np.unique(c.doc[hs[mine]] * size + at[mine], return_counts=True)
        want = c.doc[hs] * size + at
        i = np.minimum(np.searchsorted(key, want), len(key) - 1)
        n = np.where(key[i] == want, n[i], 0)
        rest -= np.bincount(hs * classes + cls, n, c.n * classes).reshape(c.n, classes)
    n = rest.sum(1, keepdims=True)
    return own, passing, np.where(n > 0, rest / np.maximum(n, 1), np.eye(classes)[0])


def count_chunk(c: Chunk, lex: Lexicon, marks, classes: int, wanted) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(features, start bits, sums) of the features for which `wanted` holds, and of each language as feature -1 - its number.

    sums: class shares in the other sentences of the documents (class 0: no subject there), occurrences beside a
    told subject, how often that subject agreed with the other sentences, and sentences per language.
    """
    own, _, rest = told_by(c, lex, classes)
    lang, n_lang = languages(c, marks), marks[2] + 1
    agreed = np.where(own > 0, rest[np.arange(c.n), own], 0.0)
    v = np.concatenate([rest, ((own > 0) & (rest[:, 0] == 0)).astype(float)[:, None], agreed[:, None], np.eye(n_lang)[lang]], 1).astype(np.float32)
    f, s = c.where(wanted(c.f))
    bits = np.left_shift(np.int64(1), c.first % 63)
    begin = np.flatnonzero(np.r_[True, f[1:] != f[:-1]][: len(f)])
    sums = np.add.reduceat(v[s], begin, axis=0) if len(f) else np.zeros((0, v.shape[1]), np.float32)
    starts = np.bitwise_or.reduceat(bits[s], begin) if len(f) else np.zeros(0, np.int64)
    there = np.unique(lang)
    base = np.stack([v[lang == g].sum(0) for g in there]) if len(there) else np.zeros((0, v.shape[1]), np.float32)
    return np.concatenate([f[begin], -1 - there]), np.concatenate([starts, np.zeros(len(there), np.int64)]), np.concatenate([sums, base])


def chosen(names: np.ndarray, m: np.ndarray, starts: np.ndarray, base: np.ndarray, classes: int):
    """Of summed statistics: (best class, purity, share, good, group, frame) of each word.

    Words are good that meet one subject far more often than other words of their language do: exp is
    what a word without subject would show, from the subjects told in sentences of its languages. Words of
    one copied phrase would confirm each other; they are known by always starting alike. group: class and
    language, for the comparison of shares.
    """
    mass, told, agreed, lang = m[:, :classes], m[:, classes], m[:, classes + 1], m[:, classes + 2 :]
    rate = base[:, :classes].copy()
    rate[:, 0] = 0
    rate = (rate + 0.1) / (rate + 0.1).sum(1, keepdims=True)
    seen = mass.copy()
    seen[:, 0] = 0
    total = seen.sum(1, keepdims=True)
    exp = (lang @ rate) / np.maximum(lang.sum(1, keepdims=True), 1e-9) * total
    gain = np.where(seen > exp, seen * np.log((seen + 0.1) / (exp + 0.1)), 0)
    lift = (seen + 0.1) / (total - seen + 0.1) / ((exp + 0.1) / (total - exp + 0.1))  # of odds
    best = gain.argmax(1)
    at = np.arange(len(m)), best
    pure, share = seen[at] / (total[:, 0] + 0.5), seen[at] / (mass.sum(1) + 0.5)
    z = (seen[at] - exp[at]) / np.sqrt(exp[at] + 0.5)
    good = (seen[at] >= LEAST) & (lift[at] >= LIFT) & (z >= Z) & (pure >= PURITY) & (starts >= STARTS)
    agree = (base[:, classes + 1] + 1) / (base[:, classes] + 1)
    usually = (lang @ agree) / np.maximum(lang.sum(1), 1e-9) * told
    frame = (told >= 2 * MIN_DF) & (agreed < PASSING * usually) & (usually - agreed > Z * np.sqrt(usually) * 0.75) & ~good
    return best, pure, share, good, best * base.shape[0] + lang.argmax(1), frame


class Corpus:
    """The tokenised texts, and the passes over them."""

    def __init__(self, stored: DataFrame, marks, classes: int):
        self.stored, self.marks, self.classes, self.n_lang = stored, marks, classes, marks[2] + 1
        self.sc = stored.sparkSession.sparkContext
        self.cols = [f"c{i}" for i in range(classes + 2 + self.n_lang)]
        self.frequent = None

    def count_cells(self) -> None:
        """Which counters reach MIN_DF: a word below it may pass, none above it is lost."""

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            cells = np.zeros(CELLS, np.int32)
            for b in batches:
                for _, _, c in chunks(b):
                    at = np.sort((c.f & (CELLS - 1)).astype(np.int32))
                    begin = np.flatnonzero(np.r_[True, at[1:] != at[:-1]][: len(at)])
                    cells[at[begin]] += np.diff(np.r_[begin, len(at)]).astype(np.int32)
            at = np.flatnonzero(cells)
            for lo in range(0, len(at), 1 << 20):
                part = at[lo : lo + (1 << 20)]
                yield pa.RecordBatch.from_arrays([pa.array(part.astype(np.int32)), pa.array(cells[part])], ["cell", "n"])

        sums = self.stored.select("words", "lens").mapInArrow(run, "cell int, n int").groupBy("cell").agg(F.sum("n").alias("n")).where(F.col("n") >= MIN_DF)
        bits = np.zeros(CELLS, bool)
        bits[sums.select("cell").toArrow()["cell"].to_numpy()] = True  # at most CELLS numbers
        self.frequent = self.sc.broadcast(np.packbits(bits))

    def statistics(self, lex: Lexicon, only: bool) -> tuple[DataFrame, np.ndarray]:
        """(summed statistics of words, of the lexicon's words only or of all frequent ones; the languages' own sums)."""
        marks, classes, cols = self.marks, self.classes, self.cols
        held, frequent = self.sc.broadcast(lex), None if only else self.frequent

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            lex = held.value
            bits = None if frequent is None else np.unpackbits(frequent.value).astype(bool)
            wanted = (lambda f: lex.find(f)[0]) if bits is None else (lambda f: bits[f & (CELLS - 1)] | lex.find(f)[0])
            for b in batches:
                for _, _, c in chunks(b):
                    f, starts, sums = count_chunk(c, lex, marks, classes, wanted)
                    if len(f):
                        yield pa.RecordBatch.from_arrays([pa.array(f), pa.array(starts), *[pa.array(sums[:, i]) for i in range(sums.shape[1])]], ["f", "starts", *cols])

        part = self.stored.select("words", "lens").mapInArrow(run, "f bigint, starts bigint, " + ", ".join(f"{c} float" for c in cols))
        # rounded, so that the order of adding never decides
        sums = cut(part.groupBy("f").agg(F.bit_count(F.bit_or("starts")).alias("starts"), *[F.round(F.sum(c), 3).alias(c) for c in cols]))
        base = np.zeros((self.n_lang, len(cols)))
        for r in sums.where("f < 0").collect():  # one row per language
            base[-1 - r.f] = [r[c] for c in cols]
        return sums.where("f >= 0"), base

    def learned(self, lex: Lexicon, only: bool = False) -> Lexicon:
        """Words chosen by their statistics under the lexicon so far.

        How often the rest of a document tells a subject at all depends on how much of its wording is known
        yet, so that share is held against the median of the words known before.
        """
        sums, base = self.statistics(lex, only)
        classes, cols, n_groups = self.classes, self.cols, self.classes * self.n_lang
        held = self.sc.broadcast((lex, base))

        def choose(b: pa.RecordBatch):
            lex, base = held.value
            names, starts = b.column(0).to_numpy(), b.column(1).to_numpy()
            m = np.stack([b.column(c).to_numpy() for c in cols], 1)
            best, pure, share, good, group, frame = chosen(names, m, starts, base, classes)
            hit, at = lex.find(names)
            known = np.zeros(len(names), bool)
            known[hit] = lex.classes[at] == best[hit]
            return names, best, pure, share, good, group, frame, known, m[:, :classes].sum(1) >= MIN_DF - 0.01

        def shares(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                if b.num_rows:
                    _, _, _, share, good, group, _, known, _ = choose(b)
                    ok = good & known
                    yield pa.RecordBatch.from_arrays([pa.array(group[ok].astype(np.int32)), pa.array(share[ok])], ["g", "share"])

        usual = np.zeros(n_groups)
        for r in sums.mapInArrow(shares, "g int, share double").groupBy("g").agg(F.percentile("share", 0.5).alias("m")).collect():  # classes x languages
            usual[r.g] = r.m
        floor = usual * USUAL

        def picking(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                if b.num_rows:
                    names, best, pure, share, good, group, frame, known, enough = choose(b)
                    take = good & (share >= floor[group]) & (known if only else (enough | known))
                    rows = np.flatnonzero(take | (frame & enough))
                    yield pa.RecordBatch.from_arrays([pa.array(names[rows]), pa.array(np.where(take, best, -1)[rows].astype(np.int32)), pa.array(pure[rows])], ["f", "class", "pure"])

        got = sums.mapInArrow(picking, "f bigint, class int, pure double").toArrow()
        f, cls, pure = (got[c].to_numpy() for c in ("f", "class", "pure"))
        terms = cls >= 0
        return Lexicon(f[terms], cls[terms], pure[terms], f[~terms])


# What the lexicon says of a sentence: nothing, words learned, words of the samples, both alike, both but not alike, a mere comparison.
SAYS, LEARNED, SAMPLED, ALIKE, UNLIKE, COMPARED = range(6)


# What the rest of the document says: nothing, other subjects only, the sentence's subject too; of a sentence without subject: something.
QUIET, OTHERS, SAME, SOME = range(4)


def votes(c: Chunk, seed: Lexicon, grown: Lexicon, classes: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(class, strength) of the lexicon's vote and the section's word per sentence."""
    a, _, _ = told_by(c, seed, classes)
    b, passing, rest = told_by(c, grown, classes)
    how = np.select([passing, (a == 0) & (b == 0), a == 0, b == 0, a == b], [COMPARED, SAYS, LEARNED, SAMPLED, ALIKE], UNLIKE)
    word = np.where(passing, 0, np.where(b > 0, b, a))
    quiet = rest[:, 1:].sum(1) == 0
    section = np.select([quiet, word == 0, rest[np.arange(c.n), word] > 0], [QUIET, SOME, SAME], OTHERS)
    return word, how, section


def encode_votes(word: np.ndarray, how: np.ndarray, section: np.ndarray, classes: int) -> np.ndarray:
    return (how * classes + word) * 4 + section


def decode_votes(code: np.ndarray, classes: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    rest, section = np.divmod(code, 4)
    how, word = np.divmod(rest, classes)
    return word, how, section


class Accuracy:
    """Latent-class model of the votes (word, how, section, item, source; the last two 0 where they abstain).

    lexicon, item and source speak at one of several strengths: P(strength | none or a subject), and at each
    strength P(vote | class) with one accuracy for none and one for subjects. Silence is a strength without a
    vote. section: P(what it says | how the class relates to the lexicon's vote).
    """

    #: (accuracy to start from at each strength, whether strength 0 is silence)
    FUNCTIONS = (((0.8, 0.8, 0.8, 0.9, 0.6, 0.8), False), ((0.3, 0.3), True), ((0.3, 0.3), True))

    def __init__(self, classes: int):
        self.classes, self.prior = classes, np.full(classes, 1 / classes)
        self.side = np.r_[0, np.ones(classes - 1, int)]
        self.acc = [np.tile(np.array(a)[:, None], (1, 2)) for a, _ in self.FUNCTIONS]
        self.how = [np.full((len(a), 2), 1 / len(a)) for a, _ in self.FUNCTIONS]
        # rows: no vote and none, no vote and a subject, the vote's subject, a vote but none, a vote but another subject
        self.section = np.array([[0.5, 0, 0, 0.5], [0.5, 0, 0, 0.5], [0.2, 0.2, 0.6, 0], [0.4, 0.4, 0.2, 0], [0.4, 0.4, 0.2, 0]])

    def _relation(self, word: np.ndarray) -> np.ndarray:
        z = np.arange(self.classes)
        return np.where(word[:, None] == 0, (z > 0).astype(int), np.where(z == 0, 3, np.where(z == word[:, None], 2, 4)))

    @staticmethod
    def _spoken(votes: tuple) -> list[tuple[np.ndarray, np.ndarray]]:
        word, how, _, item, source = votes
        return [(word, how), *((np.where(v > 0, v, -1), (v > 0).astype(int)) for v in (item, source))]

    def posterior(self, votes: tuple) -> np.ndarray:
        x = np.tile(np.log(self.prior), (len(votes[0]), 1))
        for (_, silent), (v, h), acc, how in zip(self.FUNCTIONS, self._spoken(votes), self.acc, self.how):
            a = acc[h][:, self.side]
            p = np.where(v[:, None] == np.arange(self.classes), a, (1 - a) / (self.classes - 1))
            x += np.log(how[h][:, self.side]) + np.where((silent & (h == 0))[:, None], 0.0, np.log(p))
        x += np.log(np.maximum(self.section[self._relation(votes[0]), votes[2][:, None]], 1e-6))
        e = np.exp(x - x.max(1, keepdims=True))
        return e / e.sum(1, keepdims=True)

    def fit(self, votes: tuple, w: np.ndarray, rounds: int = 30) -> Accuracy:
        relation, said = self._relation(votes[0]), votes[2]
        for _ in range(rounds):
            qw = self.posterior(votes) * w[:, None]
            self.prior = (qw.sum(0) + 1) / (qw.sum() + self.classes)
            sides = np.stack([qw[:, 0], qw[:, 1:].sum(1)], 1)
            for j, ((start, _), (v, h)) in enumerate(zip(self.FUNCTIONS, self._spoken(votes))):
                right = np.where(v >= 0, qw[np.arange(len(v)), np.maximum(v, 0)], 0.0)
                hit = np.stack([np.where(v == 0, right, 0.0), np.where(v > 0, right, 0.0)], 1)
                for k in range(len(start)):
                    at = h == k
                    mass = sides[at].sum(0)
                    self.how[j][k] = (mass + 1) / (sides.sum(0) + len(start))
                    self.acc[j][k] = np.clip((hit[at].sum(0) + start[k]) / (mass + 1), 0.02, 0.98)
            n = np.zeros((5, 4))
            np.add.at(n, (relation, np.broadcast_to(said[:, None], relation.shape)), qw)
            self.section = (n + 0.25) / (n + 0.25).sum(1, keepdims=True)
        return self


def at_least_two(p: np.ndarray) -> np.ndarray:
    """Probability that two or more of the independent sentences are of each class."""
    with np.errstate(divide="ignore", invalid="ignore"):
        none = np.prod(1 - p, 0)
        one = (none * (p / np.clip(1 - p, 1e-9, None)).sum(0)) if len(p) else none
    return 1 - none - one


def load_samples(samples: DataFrame, names: dict[str, int]):
    rows = samples.select("sample_id", "sample_text", "lang", "subject_name").orderBy("sample_id").limit(MAX_SAMPLES).collect()
    texts, labels = {}, defaultdict(set)
    for r in rows:
        texts[r.sample_id] = r.sample_text, r.lang
        if r.subject_name in names:
            labels[r.sample_id].add(names[r.subject_name])
    return [(tokens(t), labels[i], g) for i, (t, g) in texts.items()]


def dominated(told: DataFrame, by: str) -> DataFrame:
    """(by, vote): values of a column most of whose told sentences have one subject; counted over its documents."""
    each = told.where(F.col(by).isNotNull() & (F.size("classes") > 0)).select(by, F.explode("classes").alias("c"), (1 / F.size("classes")).alias("d"))
    per = each.groupBy(by, "c").agg(F.count("*").alias("n"), F.sum("d").alias("d"))
    best = per.groupBy(by).agg(F.max(F.struct("n", (-F.col("c")).alias("c"))).alias("b"), F.sum("n").alias("n"), F.sum("d").alias("d"))
    return best.where((F.col("b.n") >= DOMINANT * F.col("n")) & (F.col("d") >= DOMINANT_DOCS - 0.01)).select(by, (-F.col("b.c")).cast("int").alias(f"{by}_vote"))


def assign(documents: DataFrame, subjects: DataFrame, samples: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source", item: str = "item_id") -> DataFrame:
    """(key, subject_name), one row per subject of a document."""
    sc = documents.sparkSession.sparkContext
    names = [r.subject_name for r in subjects.select("subject_name").distinct().orderBy("subject_name").collect()]
    classes = len(names) + 1
    kind = documents.schema[key].dataType.simpleString()
    side = lambda c: F.lower(F.trim(F.col(c).cast("string"))) if c in documents.columns else F.lit(None).cast("string")
    docs = spread(documents.where(F.length(F.trim(F.col(text))) > 0).select(F.col(key).alias("k"), F.col(text).alias("t"), side(source).alias("source"), side(item).alias("item")), "k")

    def tokenising(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = [tokens(t) for t in b.column(1).to_pylist()]
            keep = pa.array([len(n) > 1 for _, n in found])
            cols = [b.column(0), b.column(2), b.column(3), pa.array([w for w, _ in found], pa.list_(pa.int64())), pa.array([n for _, n in found], pa.list_(pa.int32()))]
            yield pa.RecordBatch.from_arrays(cols, ["k", "source", "item", "words", "lens"]).filter(keep)

    stored = cut(docs.mapInArrow(tokenising, f"k {kind}, source string, item string, words array<bigint>, lens array<int>"))
    known = load_samples(samples, {n: i + 1 for i, n in enumerate(names)})
    corpus = Corpus(stored, language_marks(known), classes)
    corpus.count_cells()
    seed = grown = corpus.learned(seed_terms(known, classes), only=True)
    for _ in range(ROUNDS):
        grown = corpus.learned(grown)
    held = sc.broadcast((seed, grown))

    def voting(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seed, grown = held.value
        for b in batches:
            for lo, hi, c in chunks(b):
                word, how, section = votes(c, Lexicon(seed.keys, seed.classes, seed.purity, grown.passing), grown, classes)
                at = np.r_[0, np.cumsum(np.bincount(c.doc, minlength=c.n_docs))].astype(np.int32)
                told = word > 0
                kept = np.r_[0, np.cumsum(np.bincount(c.doc[told], minlength=c.n_docs))].astype(np.int32)
                codes = pa.ListArray.from_arrays(pa.array(at), pa.array(encode_votes(word, how, section, classes).astype(np.int32)))
                yield pa.RecordBatch.from_arrays([*(b.column(x).slice(lo, hi - lo) for x in ("k", "source", "item")), codes, pa.ListArray.from_arrays(pa.array(kept), pa.array(word[told].astype(np.int32)))], ["k", "source", "item", "codes", "classes"])

    told = cut(stored.mapInArrow(voting, f"k {kind}, source string, item string, codes array<int>, classes array<int>"))
    for by in ("source", "item"):
        told = told.join(if_small(cut(dominated(told, by))), by, "left")
    told = told.select("k", "codes", F.coalesce("item_vote", F.lit(0)).alias("item_vote"), F.coalesce("source_vote", F.lit(0)).alias("source_vote"))
    patterns = told.select(F.explode("codes").alias("code"), "item_vote", "source_vote").groupBy("code", "item_vote", "source_vote").count().toArrow()  # bounded by the classes
    code, i, s, n = (patterns[c].to_numpy().astype(np.int64) for c in ("code", "item_vote", "source_vote", "count"))
    model = Accuracy(classes).fit((*decode_votes(code, classes), i, s), n.astype(float)) if len(code) else None

    def deciding(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not b.num_rows:
                continue
            lists = b.column("codes")
            at = lists.offsets.to_numpy()
            n = np.diff(at)
            code = lists.values.to_numpy()[at[0] : at[-1]].astype(np.int64)
            i, s = (np.repeat(b.column(c).to_numpy(), n).astype(np.int64) for c in ("item_vote", "source_vote"))
            one, back = np.unique((code * classes + i) * classes + s, return_inverse=True)
            rest, source_vote = np.divmod(one, classes)
            c, item_vote = np.divmod(rest, classes)
            p = model.posterior((*decode_votes(c, classes), item_vote, source_vote))[back]
            begin = at[:-1] - at[0]
            none = np.exp(np.add.reduceat(np.log1p(-np.minimum(p, 1 - 1e-12)), begin))
            odds = np.add.reduceat(p / np.maximum(1 - p, 1e-12), begin)
            rows, found = np.nonzero((1 - none * (1 + odds))[:, 1:] > 0.5)
            yield pa.RecordBatch.from_arrays([b.column("k").take(pa.array(rows)), pa.array([names[x] for x in found], pa.string())], [key, "subject_name"])

    return told.mapInArrow(deciding, f"`{key}` {kind}, subject_name string").distinct()
