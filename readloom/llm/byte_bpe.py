"""Byte-level BPE encoding and decoding with a hierarchical-bitmap rank queue (operator 4).

The bytes of pre-tokens form a doubly linked list. Every adjacent pair that is a token of the vocabulary has a merge
rank; its left position is put in that rank's bucket, and a two-level bitmap over all ranks marks the buckets in use.
Find-first-set in both levels yields the lowest rank; its bucket gives positions from left to right. An entry is stale
if its position was merged away or its pair now has another rank, and is skipped. A merge adds the two new
neighbouring pairs; if one of them ranks below the bucket at hand, that one comes first. A pre-token of n bytes takes
n - 1 merges and O(n log n) steps at most. The new pre-tokens of some texts share one list, with a byte between them
that no pair crosses, so that setting up the list and finding buckets costs little for each.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterator
from heapq import heappop, heappush

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from readloom.llm.common import give_back, places, ship, table, with_columns

#: Parts and pre-tokens whose ids a task remembers, in each of two generations.
REMEMBERED = 100_000
#: Characters of texts whose new pre-tokens are merged together; a longer text stands alone.
GROUP_CHARS = 100_000
#: Stands between pre-tokens in the linked list: no UTF-8 text has this byte.
_BETWEEN = 0xFF
_ALONE = re.compile(r"(?<=\S)(?= \S)").split
_UNEVEN = re.compile(r"\s | \s").search


def parts_of(text: str) -> list[str]:
    """A text cut before every single space between two characters that are not white space, less those spaces.

    No pre-token extends from a character that is not white space over a following space, and what precedes such a
    place does not alter what follows, so each part can be encoded, and remembered, alone. The first part, which no
    space precedes, is told from the others, none of which begins with white space, by a line feed put before it.
    """
    if text[0] == " " or text[-1] == " " or _UNEVEN(text):
        first, *rest = _ALONE(text)
        return ["\n" + first, *[x[1:] for x in rest]]
    parts = text.split(" ")
    parts[0] = "\n" + parts[0]
    return parts


class Codec:
    """Encoder and decoder of one vocabulary file (a base64 token and its rank a line) and pre-token pattern."""

    def __init__(self, path: str, pattern: str) -> None:
        with open(path, "rb") as f:
            pairs = [line.split() for line in f if line.strip()]
        self.rank = {base64.b64decode(a): int(b) for a, b in pairs}
        if any(_BETWEEN in t and len(t) > 1 for t in self.rank):
            raise ValueError("a token has the byte that sets pre-tokens apart")
        self.token = {b: a for a, b in self.rank.items()}
        self.written = {str(b): a for b, a in self.token.items()}
        self.find = regex.compile(pattern).findall
        # Ranks of two-byte pairs, and the bitmap's lower level with 256 ranks a word; its upper level is one integer.
        self.two = [[self.rank.get(bytes((a, b))) for b in range(256)] for a in range(256)]
        self.low = [0] * ((max(self.rank.values()) >> 8) + 1)
        self.known: dict[str, str] = {}
        self.older: dict[str, str] = {}
        self.pieces: dict[str, str] = {}
        self.older_pieces: dict[str, str] = {}

    def merge(self, pieces: list[bytes]) -> list[list[int]]:
        """Ids of every pre-token."""
        rank, low, two, bit = self.rank.get, self.low, self.two, _BITS
        data = bytes((_BETWEEN,)).join([b"", *pieces, b""])
        n = len(data)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        end = after[:]
        pair = [two[a][b] for a, b in zip(data, data[1:], strict=False)]
        pair.append(None)
        buckets: dict[int, list[int]] = {}
        for i, r in enumerate(pair):
            if r is not None:
                if r in buckets:
                    buckets[r].append(i)
                else:
                    buckets[r] = [i]
        top = 0
        for r in buckets:
            low[r >> 8] |= bit[r & 255]
            top |= bit[r >> 8]
        while top:
            a = (top & -top).bit_length() - 1
            word = low[a]
            least = now = a << 8 | (word & -word).bit_length() - 1
            bucket = buckets[now]
            while bucket and least == now:
                i = heappop(bucket)
                if pair[i] != now:
                    continue
                j = after[i]
                k = end[i] = end[j]
                pair[j] = None
                j = after[i] = after[j]
                before[j] = i
                h = before[i]
                pair[i], pair[h] = right, left = rank(data[i : end[j]]), rank(data[h:k])
                for r, x in ((right, i), (left, h)):
                    if r is not None:
                        if r in buckets:
                            heappush(buckets[r], x)
                        else:
                            buckets[r] = [x]
                            low[r >> 8] |= bit[r & 255]
                            top |= bit[r >> 8]
                        if r < least:
                            least = r
            if not bucket:
                del buckets[now]
                a = now >> 8
                low[a] ^= bit[now & 255]
                if not low[a]:
                    top ^= bit[a]
        out, ids, i = [], [], 1
        while i < n:
            if data[i] == _BETWEEN:
                out.append(ids)
                ids = []
                i += 1
            else:
                ids.append(self.rank[data[i : end[i]]])
                i = after[i]
        return out

    def _learn(self, parts: set[str]) -> None:
        """Put the parts' ids into `known`."""
        cut = {p: self.find(p[1:] if p[0] == "\n" else " " + p) for p in parts}
        pieces, older = self.pieces, self.older_pieces
        if len(pieces) >= REMEMBERED:
            older = self.older_pieces = pieces
            pieces = self.pieces = {}
        new = {x for found in cut.values() for x in found}.difference(pieces)
        pieces.update({x: older[x] for x in new if x in older})
        new = list(new.difference(pieces))
        long = {}
        for x, ids in zip(new, self.merge([x.encode("utf-8") for x in new]), strict=True):
            (pieces if len(x) < 100 else long)[x] = ",".join(map(str, ids))
        for p, found in cut.items():
            self.known[p] = ",".join([pieces.get(x) or long[x] for x in found])

    def encode_texts(self, texts: list[str]) -> Iterator[str]:
        """Ids of each text as decimals joined by commas; texts go in groups of about GROUP_CHARS characters."""
        at = 0
        while at < len(texts):
            stop, size = at, 0
            while stop < len(texts) and (stop == at or size + len(texts[stop]) <= GROUP_CHARS):
                size += len(texts[stop])
                stop += 1
            # Remembered in two generations, so that the frequent stay.
            if len(self.known) >= REMEMBERED:
                self.older, self.known = self.known, {}
            known, older = self.known, self.older
            cut = [parts_of(t) if t else [] for t in texts[at:stop]]
            new = {p for parts in cut for p in parts}.difference(known)
            known.update({p: older[p] for p in new if p in older})
            self._learn(new.difference(known))
            for parts in cut:
                yield ",".join(map(known.__getitem__, parts))
            for p in [p for p in new if len(p) >= 100]:
                del known[p]
            at = stop

    def encode(self, text: str) -> list[int]:
        found = next(self.encode_texts([text]))
        return [int(i) for i in found.split(",")] if found else []

    def decode_text(self, ids: str) -> bytes:
        return b"".join(map(self.written.__getitem__, ids.split(","))) if ids else b""

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self.token.__getitem__, ids))


_BITS = [1 << i for i in range(256)]


def encode_texts(docs: DataFrame, path: str, pattern: str, text: str = "text", out: str = "token_ids", same: str | None = None) -> DataFrame:
    """docs with an array<int> column `out`: each text's ids (null or empty: none). Special tokens are ordinary text.

    `same`, if named, becomes a boolean column: whether the ids decode to the text's bytes (null text: to none). Every
    row stays, with its other columns; columns named `out` or `same` are replaced. `path` is read on the executors.
    """
    ship(docs.sparkSession)
    kept = docs.drop(out, *([same] if same else []))
    made = [T.StructField(out, T.ArrayType(T.IntegerType()))] + ([T.StructField(same, T.BooleanType())] if same else [])
    names = places(kept, made)
    at = kept.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        give_back()
        c = Codec(path, pattern)
        for b in batches:
            texts = [t or "" for t in b.column(at).to_pylist()]
            ids, told = [], []
            for t, found in zip(texts, c.encode_texts(texts), strict=True):
                ids.append(np.fromstring(found, np.int32, sep=",") if found else np.empty(0, np.int32))
                if same:
                    told.append(c.decode_text(found) == t.encode("utf-8"))
            ends = np.cumsum([0, *map(len, ids)]).astype(np.int32)
            lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate([np.empty(0, np.int32), *ids])))
            yield pa.RecordBatch.from_arrays([*b.columns, lists, *([pa.array(told, pa.bool_())] if same else [])], names=names)

    return with_columns(kept, made, run)


def decode_ids(docs: DataFrame, path: str, pattern: str, ids: str = "token_ids", out: str = "decoded") -> DataFrame:
    """docs with a binary column `out`: the bytes of each row's ids (null ids: empty). Unknown ids raise an error."""
    ship(docs.sparkSession)
    kept = docs.drop(out)
    made = [T.StructField(out, T.BinaryType())]
    names = places(kept, made)
    at = kept.columns.index(ids)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        give_back()
        c = Codec(path, pattern)
        for b in batches:
            raw = pa.array([c.decode(x or []) for x in b.column(at).to_pylist()], pa.binary())
            yield pa.RecordBatch.from_arrays([*b.columns, raw], names=names)

    return with_columns(kept, made, run)


def digests(docs: DataFrame, path: str, pattern: str, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """Encode every text, decode its ids again, and return doc_id, n_tokens, ids_sha256 and decoded_sha256.

    Both happen in one pass, so that ids need not leave the worker. Null texts are empty; ids may repeat or be null.
    """
    ship(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        give_back()
        c = Codec(path, pattern)
        for b in batches:
            n, of_ids, of_bytes = [], [], []
            for ids in c.encode_texts([t or "" for t in b.column(1).to_pylist()]):
                n.append(ids.count(",") + 1 if ids else 0)
                of_ids.append(hashlib.sha256(ids.encode()).hexdigest())
                of_bytes.append(hashlib.sha256(c.decode_text(ids)).hexdigest())
            cols = [b.column(0), pa.array(n, pa.int64()), pa.array(of_ids, pa.string()), pa.array(of_bytes, pa.string())]
            yield pa.RecordBatch.from_arrays(cols, names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("_t"))
    return rows.mapInArrow(run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")


def op4_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    return digests(table(spark, sf_dir, "documents"), path, public_tokenizers.PATTERN)
