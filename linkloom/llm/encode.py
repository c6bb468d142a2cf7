"""Encoding of whole texts with a public byte-level BPE vocabulary.

The rank file is read once per Python worker, from a path that every executor
has. Long texts are cut at boundaries no token pattern match can cross: before a
single space that stands between two non-space characters, and between letters,
digits and other signs (but not after an apostrophe, which may begin a contraction).
Every pattern match that begins left of such a place ends at or left of it, since no
alternative has an inner space and none but the contractions mixes the three kinds;
so the ids are those of the whole text, also in scripts without spaces.

Defined results
* null, empty text: an empty list
* blank text: the ids of its white space; very long text: no prefix, no limit
* strings of special tokens in a text: ordinary text
* repeated ids and rows: one result each; extra columns: ignored
"""

from __future__ import annotations

import base64
import functools
import os
from collections.abc import Iterator

import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from ..runtime import spread

RANKS = os.environ.get("LINKLOOM_RANKS", "/opt/tokenizers/byte_bpe_50k.tiktoken")
# Fixed value: the vocabulary's pattern of pieces.
PATTERN = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
PIECE = 8192
_SAFE = regex.compile(r"(?<=\S) (?=\S)|(?<=\p{L})(?=[^\s\p{L}])|(?<=\p{N})(?=[^\s\p{N}])|(?<=[^\s\p{L}\p{N}'])(?=[\p{L}\p{N}])")


@functools.lru_cache(maxsize=4)
def encoding(path: str = RANKS):
    import tiktoken

    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding(os.path.basename(path), pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def pieces(text: str, size: int = PIECE) -> Iterator[str]:
    """Parts of at least `size` characters (but the last) that join to the text and encode alike."""
    start = 0
    while len(text) - start > size:
        found = _SAFE.search(text, start + size)
        if found is None:
            break
        yield text[start : found.start()]
        start = found.start()
    yield text[start:]


def encode_text(text: str | None, path: str = RANKS) -> list[int]:
    if not text:
        return []
    enc = encoding(path)
    if len(text) <= PIECE:
        return enc.encode_ordinary(text)
    return [i for part in pieces(text) for i in enc.encode_ordinary(part)]


def decode_ids(ids, path: str = RANKS) -> str:
    """Raw bytes of all tokens joined, then decoded once: characters may span tokens."""
    enc = encoding(path)
    return b"".join(enc.decode_single_token_bytes(int(i)) for i in ids).decode("utf-8")


def encode(df: DataFrame, key: str = "doc_id", text: str = "text", path: str = RANKS) -> DataFrame:
    """(key, ids): one narrow Arrow pass; only inputs of too few parts are spread first."""
    kind = df.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids = [encode_text(t, path) for t in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(ids, pa.list_(pa.int32()))], [key, "ids"])

    return spread(df.select(key, text), key).mapInArrow(run, f"`{key}` {kind}, ids array<int>")
