"""Texts garbled by decoding with the wrong character encoding, and their repair.

A latent chain (written in A, read in B, perhaps twice) is assumed behind every
text; 'none' is one of the chains. Undoing a chain gives a candidate text, whose
likelihood under a character model of the corpus says how well the chain explains
what was seen. EM pools this evidence per source and field: a source's shares of
'none' and of each chain are the prior of its own weak cases. Every chain that can
be undone takes part, also one that loses likelihood; pure ASCII texts tell nothing
of the shares. A text is garbled if the posterior of 'none' is below one half; the
best chain's candidate is its repair.

A text may be garbled in part: of its non-ASCII words those are undone that gain
most, less the cost of naming them among all. Lost characters (U+FFFD, cut sequences, case
changes of lead bytes) cost likelihood but do not stop a chain.

The model learns each text once per field and source, whatever its rows, and a
text is scored without its own copies, so that a garbled text that is repeated
often doesn't teach the model that it is normal.

Scale: a body is parsed once per pass for its title and link texts. Rows with
non-ASCII text are written once, narrow; all later steps work on those and on 128-bit
hashes of texts. The text model is four hashed tables of fixed size (13 MB), summed
per task and merged by addition; Python scores distinct non-ASCII texts only. Gains are
dealt to the tasks once, by source; an EM round moves no rows: a source's shares follow
from its own gains and the sums of the rounds before (one row per chain, and for sources
in several parts), so each task goes through these rounds again, adds one and returns
its sums. Long texts are scored whole, and gains are never cut off: posteriors are taken
in logarithms.

Defined results
* null, empty and pure ASCII texts: not garbled
* texts holding U+FFFD: garbled, repaired as far as the chain allows
* repeated rows: each is named; null source: one source of its own
* ties between chains: the first in `CHAINS`; extra columns: ignored
"""

from __future__ import annotations

import functools
import math
import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import variants
from ..runtime import cut, if_small

# Fixed values: (written in, read in). The first is none; the last two are double and triple misreadings.
CHAINS: list[tuple[tuple[str, str], ...]] = [
    (),
    (("utf-8", "cp1252"),), (("utf-8", "latin-1"),), (("utf-8", "iso8859-15"),), (("utf-8", "cp1250"),), (("utf-8", "cp1251"),), (("utf-8", "cp1253"),), (("utf-8", "cp1254"),),
    (("utf-8", "cp437"),), (("utf-8", "cp850"),), (("utf-8", "cp866"),), (("utf-8", "koi8-r"),), (("utf-8", "mac_roman"),), (("utf-8", "gbk"),), (("utf-8", "shift_jis"),), (("utf-8", "big5"),),
    (("cp1251", "cp1252"),), (("koi8-r", "cp1252"),), (("cp866", "cp1252"),), (("cp1251", "koi8-r"),), (("koi8-r", "cp1251"),), (("cp866", "cp1251"),), (("cp1251", "cp866"),), (("iso8859-5", "cp1251"),),
    (("cp1253", "cp1252"),), (("cp1250", "cp1252"),), (("iso8859-2", "cp1252"),), (("cp1252", "cp1250"),), (("cp1254", "cp1252"),), (("cp1257", "cp1252"),),
    (("cp1252", "cp850"),), (("cp1252", "cp437"),), (("cp1252", "mac_roman"),), (("mac_roman", "cp1252"),), (("cp850", "cp1252"),), (("cp1252", "cp1251"),),
    (("euc-jp", "cp1252"),), (("gbk", "cp1252"),), (("shift_jis", "cp1252"),), (("big5", "cp1252"),), (("euc-kr", "cp1252"),),
    (("utf-8", "cp1252"), ("utf-8", "cp1252")),
    (("utf-8", "cp1252"), ("utf-8", "cp1252"), ("utf-8", "cp1252")),
]
LOST, LOST_COST = "�", 6.0
UNI, BI, WORDS, DISCOUNT = 1 << 16, 1 << 20, 1 << 20, 3e-4
SIZES = (UNI, BI, WORDS, WORDS)
PRIOR, SPREAD, START, STILL, ROUNDS = 0.03, 20.0, 0.5, 0.005, 30  # EM ends when no share moves by STILL
PART, LARGE = 30_000, 1000  # texts in a part; a source of more than these, and of more than this part of all, is dealt to several
_LEAD = re.compile("([à-þăąćďđęĺŕřрстξο])(?=[^\x00-\x7f])")
_SPLIT = re.compile("( +|[\t\r\n]+)")


@functools.lru_cache(maxsize=64)
def _bytes_of(name: str) -> dict[str, int]:
    """Character to byte of a single-byte code page; undefined bytes stand for the control of that number."""
    out = {}
    for b in range(256):
        try:
            out[bytes([b]).decode(name)] = b
        except UnicodeDecodeError:
            out[chr(b)] = b
    return out


MULTI = {"gbk", "shift_jis", "big5", "euc-kr", "euc-jp", "utf-8"}


def _undo(text: str, written: str, read: str) -> str | None:
    """The text before it was written in one encoding and read in another; None where it can't have been."""
    raw = bytearray()
    if read in MULTI:
        for c in text:
            try:
                raw += c.encode(read)
            except UnicodeEncodeError:
                if c != LOST:
                    return None
                raw.append(0xFF)
    else:
        table = _bytes_of(read)
        for c in text:
            b = table.get(c)
            if b is None:
                if c == "€" or c != LOST:
                    return None
                b = 0xFF
            raw.append(b)
    if written in MULTI:
        return bytes(raw).decode(written, errors="replace")
    back = _chars_of(written)
    return "".join(map(back.__getitem__, raw))


@functools.lru_cache(maxsize=64)
def _chars_of(name: str) -> list[str]:
    table = [LOST] * 256
    for c, b in _bytes_of(name).items():
        table[b] = c
    return table


def garble(text: str, chain: tuple[tuple[str, str], ...]) -> str | None:
    """The text as a chain garbles it; None where that loses something."""
    out = text
    for written, read in reversed(chain):
        try:
            raw = out.encode(written)
            out = raw.decode(read) if read in MULTI else "".join(map(_chars_of(read).__getitem__, raw))
        except (UnicodeEncodeError, UnicodeDecodeError):
            return None
    return out if undo(out, chain) == text else None


def undo(word: str, chain: tuple[tuple[str, str], ...]) -> str | None:
    """Reverses a chain, last step first."""
    for written, read in chain:
        nxt = _undo(word, written, read)
        if nxt is None or nxt == word:
            return None
        word = nxt
    return word


class TextModel:
    """Likelihood of words: frequent words by their share, others by interpolated character bigrams.

    All counts are in hashed tables of fixed size over case-folded text; words have two
    tables of which the lesser count holds. A word's count is taken less DISCOUNT of all
    words, so that garbled words, each rare, never become words of their own right.
    """

    def __init__(self, tables: list[np.ndarray]):
        self.tables = tables
        self.uni, self.bi, self.words, self.more = map(memoryview, tables)  # single cells are read faster than from arrays
        self.total, self.n_words = float(tables[0].sum()) + UNI, float(tables[2].sum()) + 1

    def cost(self, word: str, own: Own) -> float:
        """Negative log likelihood without the counts of the text itself; a lost character costs a constant."""
        word = word.casefold()
        cs = [ord(c) for c in " " + word + " "]
        total, n_words, out = max(self.total - own.n_chars, UNI), max(self.n_words - own.n_words, 1.0), 0.0
        uni = [max(self.uni[c % UNI] - own.uni.get(c % UNI, 0.0), 0.0) for c in cs]
        for x, y, nx, ny in zip(cs, cs[1:], uni, uni[1:]):
            if y == 0xFFFD:
                out += LOST_COST
                continue
            p0, pair = (ny + 0.5) / total, (x * 1000003 + y) % BI
            out -= math.log((max(self.bi[pair] - own.bi.get(pair, 0.0), 0.0) + 20 * p0) / (nx + 20)) if x != 0xFFFD else math.log(p0)
        i, j = _slots(word)
        n = min(self.words[i], self.more[j]) - own.words.get(word, 0.0) - DISCOUNT * n_words
        return min(out, 0.7 - math.log(n / n_words)) if n > 0 else out


class Own:
    """What a text of weight n gave to the model."""

    def __init__(self, text: str, n: float):
        text = text.casefold()
        cs, words = [ord(c) for c in " " + text + " "], [x for x in _SPLIT.split(text)[::2] if x]
        self.uni = {at: k * n for at, k in Counter(c % UNI for c in cs).items()}
        self.bi = {at: k * n for at, k in Counter((x * 1000003 + y) % BI for x, y in zip(cs, cs[1:])).items()}
        self.words = {w: k * n for w, k in Counter(words).items()}
        self.n_chars, self.n_words = len(cs) * n, len(words) * n


def _slots(word: str) -> tuple[int, int]:
    raw = word.encode()
    return zlib.crc32(raw) % WORDS, zlib.crc32(raw, 0x9E3779B9) % WORDS


def count_text(texts: list[str], weights: list[int]) -> list[np.ndarray]:
    """Weighted bucket counts of characters, of character pairs, and twice of words."""
    texts = [t.casefold() for t in texts]
    joined = "".join(" " + t + " " for t in texts)
    cs = np.frombuffer(joined.encode("utf-32-le"), np.uint32).astype(np.int64)
    w = np.repeat(np.array(weights, float), [len(t) + 2 for t in texts])
    words: dict[str, float] = {}
    for t, n in zip(texts, weights):
        for x in _SPLIT.split(t)[::2]:
            if x:
                words[x] = words.get(x, 0.0) + n
    at = np.array([_slots(x) for x in words]).reshape(-1, 2)
    n = np.array(list(words.values()))
    return [np.bincount(cs % UNI, w, UNI), np.bincount((cs[:-1] * 1000003 + cs[1:]) % BI, w[1:], BI), np.bincount(at[:, 0], n, WORDS), np.bincount(at[:, 1], n, WORDS)]


class Scorer:
    """Candidate chains of texts; what a word may have been is cached."""

    def __init__(self, model: TextModel):
        self.model, self.known = model, {}

    def _forms(self, word: str) -> dict[int, list[str]]:
        """Readings of a word under each chain that can be undone."""
        if word not in self.known:
            if len(self.known) > 100_000:
                self.known.clear()
            out: dict[int, list[str]] = {}
            raised, upper = _LEAD.sub(lambda m: m[1].upper(), word), "".join(c.upper() if len(c.upper()) == 1 else c for c in word)
            for z, chain in enumerate(CHAINS):
                for form in dict.fromkeys((word, raised, upper)):
                    y = undo(form, chain) if chain else None
                    if y is not None and (y.count(LOST) <= word.count(LOST) + (len(y) > 2 and y.endswith(LOST)) or LOST in word) and not any("\x7f" < c < "\xa0" for c in y):
                        out.setdefault(z, []).append(y)
            self.known[word] = out
        return self.known[word]

    def _word(self, word: str, own: Own) -> dict[int, tuple[float, str]]:
        if word.isascii() or not (forms := self._forms(word)):
            return {}
        cost, out = self.model.cost(word, own), {}
        costs = {y: self.model.cost(y, own) for y in dict.fromkeys(y for ys in forms.values() for y in ys)}
        for z, ys in forms.items():
            y = min(ys, key=costs.__getitem__)
            out[z] = cost - costs[y], y
        return out

    def score(self, text: str, n: float, only: int | None = None) -> list[tuple[int, float, str]]:
        """(chain, gain in log likelihood over 'none', repaired text) of the chains that can be undone; n is the text's weight in the model."""
        parts, own = _SPLIT.split(text), Own(text, n)
        each = {p: self._word(p, own) for p in dict.fromkeys(parts)}
        found = [each[p] for p in parts]
        m, out = sum(not p.isascii() for p in parts), []
        for z in sorted({z for f in each.values() for z in f}) if only is None else [only]:
            at = sorted((i for i, f in enumerate(found) if z in f), key=lambda i: -found[i][z][0])
            best, total = (-math.inf, 0), 0.0
            for k, i in enumerate(at, 1):  # k of m words: one of m * C(m, k) ways
                total += found[i][z][0]
                best = max(best, (total - math.log(m) - math.lgamma(m + 1) + math.lgamma(k + 1) + math.lgamma(m - k + 1), k))
            undone = set(at[: best[1]])
            out.append((z, best[0], "".join(f[z][1] if i in undone else p for i, (f, p) in enumerate(zip(found, parts)))))
        return out


def _model_of(distinct: DataFrame) -> TextModel:
    """Sums of all rows of `text`; what reaches the driver is four tables of fixed size."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = [np.zeros(n) for n in SIZES]
        for b in batches:
            each = pa.Table.from_batches([b]).group_by("text").aggregate([("text", "count")])
            for t, more in zip(tables, count_text(each["text"].to_pylist(), each["text_count"].to_pylist())):
                t += more
        for kind, t in enumerate(tables):
            at = np.flatnonzero(t)
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(at), kind, np.int32)), pa.array(at.astype(np.int32)), pa.array(t[at])], ["kind", "at", "n"])

    tables = [np.zeros(n, np.float32) for n in SIZES]
    sums = distinct.mapInArrow(run, "kind int, at int, n double").groupBy("kind", "at").agg(F.sum("n").cast("float").alias("n")).toArrow()
    kind, at, n = (sums[c].to_numpy() for c in ("kind", "at", "n"))
    for k, t in enumerate(tables):
        t[at[kind == k]] = n[kind == k]
    return TextModel(tables)


_HASH = ["h1", "h2"]


def _hashed(df: DataFrame) -> DataFrame:
    """Adds the 128-bit hash that stands for a text."""
    return df.withColumns({"h1": F.xxhash64("text"), "h2": F.xxhash64(F.lit(1), "text")})


class Part:
    """The cases of one task: the texts of its sources, and what they say of the chains."""

    def __init__(self, batches: Iterator[pa.RecordBatch], large: dict[tuple[str, str], int]):
        """large: the size over all tasks of the sources that are dealt to several."""
        got = list(batches)
        self.rows = pa.Table.from_batches(got).combine_chunks() if got else None
        if not self.rows:
            return
        field, source = (self.rows[c].combine_chunks().dictionary_encode("encode") for c in ("field_name", "source"))
        both = field.indices.to_numpy().astype(np.int64) * len(source.dictionary) + source.indices.to_numpy()
        each, of, size = np.unique(both, return_inverse=True, return_counts=True)
        names = [(field.dictionary[int(x) // len(source.dictionary)].as_py(), source.dictionary[int(x) % len(source.dictionary)].as_py()) for x in each] if large else []
        self.large = {i: w for i, w in enumerate(names) if w in large}
        size[list(self.large)] = [large[w] for w in self.large.values()]
        self.size, zs, gains = size.astype(float), self.rows["zs"].combine_chunks(), self.rows["gains"].combine_chunks()
        self.n = pc.fill_null(pc.list_value_length(zs), 0).to_numpy(zero_copy_only=False)
        self.told = np.flatnonzero(self.n)  # the others say nothing of the chains
        self.z, self.gain, self.n = zs.flatten().to_numpy().astype(np.int64) - 1, gains.flatten().to_numpy(), self.n[self.told]
        self.of, self.begin = of[self.told], np.cumsum(self.n) - self.n
        self.cell = np.repeat(self.of, self.n) * _UNDOABLE + self.z

    def weighed(self, share: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Logarithms of gain and share of each chain, its posterior, and the posterior of 'none'."""
        if not len(self.told):
            return (np.zeros(0),) * 3
        logs = self.gain + _logarithm(share).ravel()[self.cell]
        none = _logarithm(1 - share.sum(1))[self.of]
        top = np.maximum(np.maximum.reduceat(logs, self.begin), none)
        odds, none = np.exp(logs - np.repeat(top, self.n)), np.exp(none - top)
        total = none + np.add.reduceat(odds, self.begin)
        return logs, odds / np.repeat(total, self.n), none / total

    def mass(self, share: np.ndarray) -> np.ndarray:
        """Sums of the posteriors by source and chain."""
        return np.bincount(self.cell, self.weighed(share)[1], len(self.size) * _UNDOABLE).reshape(-1, _UNDOABLE)

    def shares(self, past: list[Round]) -> tuple[np.ndarray, float]:
        """Each source's shares of the chains after these rounds, and how far the last one moved them."""
        share, moved = np.full((len(self.size), _UNDOABLE), START / _UNDOABLE), 0.0
        for base, sums in past:
            mass = self.mass(share)
            for i, who in self.large.items():
                mass[i] = sums[who]
            before, share = share, (mass + SPREAD * base) / (self.size[:, None] + SPREAD)
            moved = float(np.abs(share - before).max())
        return share, moved

    def best(self, logs: np.ndarray) -> np.ndarray:
        """The best chain of each case that has any, of equal ones the first."""
        if not len(self.told):
            return np.zeros(0, np.int64)
        first = np.where(logs == np.repeat(np.maximum.reduceat(logs, self.begin), self.n), np.arange(len(logs)), len(logs))
        return self.z[np.minimum.reduceat(first, self.begin)] + 1


#: Of a finished round: the shares of the chains over all sources, and the sums of the sources that are dealt to several tasks.
Round = tuple[np.ndarray, dict[tuple[str, str], np.ndarray]]
_UNDOABLE = len(CHAINS) - 1


def _logarithm(x: np.ndarray) -> np.ndarray:
    return np.log(np.maximum(x, 1e-300))


def _dealt(per: DataFrame, cands: DataFrame) -> tuple[DataFrame, dict[tuple[str, str], int], int]:
    """(field_name, source, h1, h2, lost, zs, gains) with all texts of a source in one part; sizes of the large sources, which lie in several; rows."""
    who, n_all = ["field_name", "source"], per.count()
    limit = max(PART, n_all // LARGE)
    sizes = per.groupBy(*who).agg(F.count("*").alias("size")).where(F.col("size") > limit).collect()  # at most LARGE
    large = {(r.field_name, r.source): r.size for r in sizes}
    deals = per.sparkSession.createDataFrame([(*w, -(-n // limit)) for w, n in large.items()], "field_name string, source string, deals bigint")
    cases = per.select(*who, *_HASH).join(if_small(cands), _HASH, "left").join(F.broadcast(deals), who, "left")
    cases = cases.withColumn("deal", F.pmod("h1", F.coalesce("deals", F.lit(1)))).select(*who, *_HASH, "lost", "zs", "gains", "deal")
    parts = max(per.sparkSession.sparkContext.defaultParallelism, -(-n_all // PART))
    return cut(cases.repartition(parts, *who, "deal").drop("deal")), large, n_all


def posteriors(odd: DataFrame, ascii_texts: DataFrame) -> tuple[DataFrame, DataFrame, object]:
    """(h1, h2 of texts, field_name, source, chain, p_none of the garbled ones; distinct texts with their weights n; the model).

    odd: (field_name, source, text) of non-ASCII texts, written or cheap to read; ascii_texts: the others.
    """
    sc = odd.sparkSession.sparkContext
    per = cut(_hashed(odd.distinct()))
    held = sc.broadcast(_model_of(per.select("text").unionByName(ascii_texts.where("text <> ''").distinct().select("text"))).tables)

    def scoring(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(TextModel(held.value))
        for b in batches:
            found = [scorer.score(t, n) for t, n in zip(b.column("text").to_pylist(), b.column("n").to_pylist())]
            zs, gs = ([[x[i] for x in f] for f in found] for i in (0, 1))
            lost = [LOST in t for t in b.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column("h1"), b.column("h2"), pa.array(lost), pa.array(zs, pa.list_(pa.int8())), pa.array(gs, pa.list_(pa.float64()))], ["h1", "h2", "lost", "zs", "gains"])

    texts = per.groupBy(*_HASH).agg(F.max("text").alias("text"), F.count("*").alias("n"))  # once per field and source
    cands = cut(texts.mapInArrow(scoring, "h1 bigint, h2 bigint, lost boolean, zs array<tinyint>, gains array<double>").where(F.expr("size(zs) > 0") | F.col("lost")))
    cases, large, n_all = _dealt(per, cands)
    past: list[Round] = []

    def summing(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = Part(batches, large)
        if part.rows:
            share, moved = part.shares(past)
            mass = part.mass(share)
            for who, m in [((None, None), mass.sum(0)), *((w, mass[i]) for i, w in part.large.items())]:
                yield pa.RecordBatch.from_pydict({"field_name": pa.array([who[0]] * _UNDOABLE, pa.string()), "source": pa.array([who[1]] * _UNDOABLE, pa.string()), "z": pa.array(range(_UNDOABLE), pa.int32()), "m": m, "moved": [moved] * _UNDOABLE})

    while True:
        sums = cases.select("field_name", "source", "zs", "gains").mapInArrow(summing, "field_name string, source string, z int, m double, moved double")
        sums = sums.groupBy("field_name", "source", "z").agg(F.sum("m").alias("m"), F.max("moved").alias("moved")).collect()  # one row per chain, and as many for each large source
        if past and (len(past) == ROUNDS or max((r.moved for r in sums), default=0.0) < STILL):
            break
        of = {w: np.zeros(_UNDOABLE) for w in [(None, None), *large]}
        for r in sums:
            of[r.field_name, r.source][r.z] = r.m
        past.append(((of.pop((None, None)) + PRIOR) / (n_all + len(CHAINS)), of))

    def telling(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = Part(batches, large)
        if part.rows:
            logs, _, none = part.weighed(part.shares(past)[0])
            lost, p_none, chain = pc.fill_null(part.rows["lost"], False).to_numpy(), np.ones(len(part.rows)), np.full(len(part.rows), len(CHAINS))
            p_none[part.told], chain[part.told] = none, part.best(logs)
            at = np.flatnonzero(lost | (p_none < 0.5))
            chain[p_none >= 0.5] = len(CHAINS)  # read with losses, the bytes are gone
            out = part.rows.select(["field_name", "source", *_HASH]).take(at)
            yield from out.append_column("chain", pa.array(chain[at], pa.int32())).append_column("p_none", pa.array(np.where(lost, 0.0, p_none)[at])).to_batches()

    found = cut(cases.mapInArrow(telling, "field_name string, source string, h1 bigint, h2 bigint, chain int, p_none double"))
    return found, texts.select(*_HASH, "text", "n"), held


def repaired(found: DataFrame, texts: DataFrame, held) -> DataFrame:
    """found with the repaired text as `fixed`."""

    def repairing(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(TextModel(held.value))
        for b in batches:
            t, n, z = (b.column(c).to_pylist() for c in ("text", "n", "chain"))
            fixed = [scorer.score(*x)[0][2] if x[2] < len(CHAINS) else x[0] for x in zip(t, n, z)]
            yield pa.RecordBatch.from_arrays([b.column("h1"), b.column("h2"), b.column("chain"), pa.array(fixed, pa.string())], ["h1", "h2", "chain", "fixed"])

    each = found.select(*_HASH, "chain").distinct()
    fixed = texts.join(if_small(each), _HASH).select("text", *_HASH, "n", "chain").mapInArrow(repairing, "h1 bigint, h2 bigint, chain int, fixed string")
    return found.join(fixed, [*_HASH, "chain"])


def text_rows(links: DataFrame, records: DataFrame) -> DataFrame:
    """(field_name, row_id, list_pos, source, text) of anchor texts, titles and link texts; each body is parsed once."""
    anchors = links.select(F.lit("anchor_text").alias("field_name"), F.col("link_id").alias("row_id"), F.lit(-1).alias("list_pos"), F.col("src_domain").alias("source"), F.col("anchor_text").alias("text"))
    host = F.regexp_extract(F.col("target_uri"), r"^[A-Za-z]+://([^/:?#]+)", 1)
    docs = variants.readable(records).select("record_no", F.lower(host).alias("source"), variants.parsed(F.col("body")).alias("doc")).where("doc is not null")
    one = lambda name, pos, text: F.struct(F.lit(name).alias("field_name"), pos.alias("list_pos"), text.alias("text"))
    x = variants.get(F.col("doc"), *variants.LISTS["Links"])
    kind = F.schema_of_variant(x)
    items = F.when(kind.startswith("ARRAY"), variants.get(F.col("doc"), *variants.LISTS["Links"], kind="array<variant>")).when(kind.startswith("OBJECT"), F.array(x))
    title = one("title", F.lit(-1), variants.text_at(F.col("doc"), *variants.HTML, "Head", "Title"))
    texts = F.transform(F.coalesce(items, F.array().cast("array<variant>")), lambda item, i: one("link_text", i, variants.text_at(item, "text")))
    listed = docs.select(F.col("record_no").alias("row_id"), "source", F.inline(F.concat(F.array(title), texts)))
    return anchors.unionByName(listed).where("text is not null")


def garbled_rows(rows: DataFrame, repair: bool = True) -> DataFrame:
    """(field_name, row_id, list_pos, text, chain, and with repair fixed): every row whose text is garbled. rows: field_name, row_id, list_pos, source, text."""
    rows = rows.select("field_name", "row_id", "list_pos", F.coalesce("source", F.lit("")).alias("source"), "text")
    odd_text = F.col("text").rlike("[^\\x00-\\x7f]")
    odd = cut(rows.where(odd_text))
    who = ["field_name", "source", "text"]
    found, texts, held = posteriors(odd.select(*who), rows.where(~odd_text).select(*who))
    if repair:
        found = cut(repaired(found, texts, held))
    keys = ["field_name", "source", *_HASH]
    got = _hashed(odd).join(if_small(found.select(*keys, "chain", *(["fixed"] if repair else [])), 200_000), keys)
    return got.select("field_name", "row_id", "list_pos", "text", *(["fixed"] if repair else []), "chain")
