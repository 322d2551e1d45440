"""Context-tree weighting over bytes (operator 1).

Every byte is eight binary choices; each choice has a tree of contexts, one byte per level. A node predicts by the
Krichevsky-Trofimov estimate of its own counts, mixed with its children's predictions by the weight that the training
data give to stopping there (half a priori at every node), so all depths take part; a context that training has not
seen predicts one half. All contexts of all training bytes are kept: the model grows with the corpus and stays in
tables. Strings of DEPTH + 1 bytes are counted by chunk of texts, and sent to shards by their two latest context
bytes, so that a shard has whole subtrees below level two; sums for the two levels above, of bounded size, come to the
driver. Each chunk's distinct strings, as sent, are its questions too: their shard answers each with one number.
Words, for the base of comparison, are counted exactly by 64-bit names and their totals return by chunk.

A text is read as its lower-cased words, each ended by a space, and a line feed: a code for token sequences.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from readloom.llm.chunks import batch_of, by_bucket, pack, rows_of, texts_of
from readloom.llm.common import materialize, parts, ship, table

DEPTH = 5
CHUNK_BYTES = 8 << 20
END = b"\n"
#: Bytes of texts whose strings are laid out at once.
PIECE_BYTES = 1 << 20
#: Chunks whose counts one group adds up, and strings that one group is asked about, about.
FAN, ASKED = 256, 2_000_000
_HALF = np.log(0.5)


def held_out(doc_id: int | None, folds: int = 5) -> bool:
    """Whether crc32 of the id as text leaves remainder 1; a null id trains."""
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % folds == 1


def _keys(lines: list[list[bytes]], depth: int) -> tuple[np.ndarray, np.ndarray]:
    """Context keys of every byte of word lists (last byte lowest), and how many bytes each list has."""
    pad = END * depth
    coded = [pad + b" ".join([*w, END]) for w in lines]
    size = np.array([len(c) for c in coded], np.int64)
    data = np.frombuffer(b"".join(coded), np.uint8).astype(np.uint64)
    if not len(data):
        return np.empty(0, np.uint64), size
    key = data[depth:].copy()
    for back in range(1, depth + 1):
        key |= data[depth - back : len(data) - back] << np.uint64(8 * back)
    own = np.ones(len(data), bool)
    starts = np.cumsum(size) - size
    for k in range(depth):
        own[starts + k] = False
    return key[own[depth:]], size - depth


def _sums(keys: np.ndarray, *counts: np.ndarray) -> tuple[np.ndarray, ...]:
    """Distinct keys in order, with the sum of each count."""
    if not len(keys):
        return keys, *counts
    order = np.argsort(keys, kind="stable")
    k = keys[order]
    cuts = np.flatnonzero(np.r_[True, k[1:] != k[:-1]])
    return k[cuts], *(np.add.reduceat(c[order], cuts) for c in counts)


def _tally(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    k = np.sort(keys)
    cuts = np.flatnonzero(np.r_[True, k[1:] != k[:-1]]) if len(k) else np.empty(0, np.int64)
    return k[cuts], np.diff(np.r_[cuts, len(k)])


def _shard(keys: np.ndarray, shards: int) -> np.ndarray:
    """Shard of a key by its two latest context bytes."""
    return ((((keys >> np.uint64(8)) & np.uint64(0xFFFF)) * np.uint64(0x9E3779B1)) % np.uint64(1 << 32) * np.uint64(shards) >> np.uint64(32)).astype(np.int64)


def _squeezed(x: np.ndarray, steps: bool) -> bytes:
    """Unsigned longs, or the steps between them if they ascend, compressed by byte planes."""
    x = x.astype("<u8")
    x = np.diff(x, prepend=np.zeros(1, "<u8")) if steps else x
    return zstandard.ZstdCompressor(1).compress(np.ascontiguousarray(x.view(np.uint8).reshape(-1, 8).T).tobytes())


def _restored(data: bytes, steps: bool) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8).reshape(8, -1)
    x = np.ascontiguousarray(planes.T).view("<u8").ravel()
    return np.cumsum(x, dtype=np.uint64) if steps else x


def _pieces(lines: list[list[bytes]]) -> Iterator[list[list[bytes]]]:
    """Word lists by about PIECE_BYTES; a longer text stands alone."""
    group, held = [], 0
    for w in lines:
        n = sum(map(len, w)) + len(w)
        if group and held + n > PIECE_BYTES:
            yield group
            group, held = [], 0
        group.append(w)
        held += n
    if group:
        yield group


def _strings(depth: int, shards: int):
    """Chunks -> rows (shard, chunk_id, n, keys, counts): each chunk's distinct strings and how often they train."""
    schema = pa.schema([("shard", pa.int64()), ("chunk_id", pa.int64()), ("n", pa.int64()), ("keys", pa.binary()), ("counts", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for x in rows_of(batch):
                found = []
                sides: tuple[list, list] = ([], [])
                for i, t in zip(x["ids"], texts_of(x["sizes"], x["packed"]), strict=True):
                    sides[held_out(i)].append(t.lower().split())
                for held, lines in enumerate(sides):
                    for piece in _pieces(lines):
                        k, n = _tally(_keys(piece, depth)[0])
                        found.append((k, n * (1 - held)))
                if not found:
                    continue
                keys, counts = _sums(*map(np.concatenate, zip(*found, strict=True)))
                shard = _shard(keys, shards)
                order = np.argsort(shard, kind="stable")
                cuts = np.flatnonzero(np.diff(shard[order], prepend=-1))
                rows = []
                for a, b in zip(cuts, [*cuts[1:], len(order)], strict=True):
                    at = order[a:b]
                    rows.append((int(shard[at[0]]), x["chunk_id"], len(at), _squeezed(keys[at], True), _squeezed(counts[at], False)))
                yield batch_of(rows, schema)

    return run, "shard long, chunk_id long, n long, keys binary, counts binary"


def _total(t: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """Strings of a group's rows with the sums of their counts, those that train alone."""
    keys = np.concatenate([_restored(x.as_py(), True) for x in t["keys"]])
    counts = np.concatenate([_restored(x.as_py(), False) for x in t["counts"]]).astype(np.int64)
    keys, counts = _sums(keys[counts > 0], counts[counts > 0])
    return keys, counts


def _added(t: pa.Table) -> pa.Table:
    """Rows of one (shard, part) -> one row of their sums; the part stands where the chunk did."""
    keys, counts = _total(t)
    return pa.table({"shard": t["shard"][:1], "chunk_id": t["part"][:1], "keys": pa.array([_squeezed(keys, True)], pa.binary()), "counts": pa.array([_squeezed(counts, False)], pa.binary())})


def shard_counts(strings: DataFrame, chunks: int) -> DataFrame:
    """(shard, chunk_id, keys, counts) with one row a shard; sums of at most FAN rows at a time, so a frequent context's
    group holds each of its strings FAN times at most."""
    rows = strings.select("shard", "chunk_id", "keys", "counts")
    while True:
        chunks = -(-chunks // FAN)
        part = F.pmod(F.xxhash64("chunk_id", F.lit(chunks)), F.lit(max(1, chunks))).alias("part")
        rows = rows.select("shard", "keys", "counts", part).groupBy("shard", "part")
        rows = materialize(rows.applyInArrow(_added, "shard long, chunk_id long, keys binary, counts binary"), "counts")
        if chunks <= 1:
            return rows


def _lgamma(x: np.ndarray) -> np.ndarray:
    """Log gamma of positive numbers, by Stirling's series above 8."""
    x = x.astype(np.float64)
    low = np.zeros_like(x)
    for _ in range(8):
        small = x < 8
        low = np.where(small, low - np.log(np.where(small, x, 1.0)), low)
        x = np.where(small, x + 1, x)
    r = 1 / (x * x)
    return low + (x - 0.5) * np.log(x) - x + 0.9189385332046727 + (1 / 12 - r * (1 / 360 - r * (1 / 1260 - r / 1680))) / x


def _log_kt(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Log of the Krichevsky-Trofimov block probability of a zeros and b ones."""
    return _lgamma(a + 0.5) + _lgamma(b + 0.5) - 1.1447298858494002 - _lgamma(a + b + 1.0)


def _level(keys: np.ndarray, counts: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Binary nodes (context, choice) at a level: ids in order, zeros, ones."""
    pair, n = _sums(keys & np.uint64((1 << 8 * (depth + 1)) - 1), counts)
    byte, context = pair & np.uint64(255), pair >> np.uint64(8) << np.uint64(8)
    ids, zeros, ones = [], [], []
    for k in range(8):
        ids.append(context | np.uint64(1 << k) | (byte >> np.uint64(8 - k)))
        bit = ((byte >> np.uint64(7 - k)) & np.uint64(1)).astype(bool)
        zeros.append(np.where(bit, 0, n))
        ones.append(np.where(bit, n, 0))
    return _sums(np.concatenate(ids), np.concatenate(zeros), np.concatenate(ones))


def _weigh(level: tuple, below: np.ndarray | None) -> dict:
    """Nodes of a level with their estimates, and the log of their weighted probability given the sum of their
    children's; None: the deepest level."""
    ids, zeros, ones = level
    log_p = own = _log_kt(zeros, ones)
    if below is not None:
        log_p = _HALF + np.logaddexp(own, below)
    stop = np.exp(_HALF + own - log_p) if below is not None else np.ones(len(ids))
    return {"ids": ids, "log_p": log_p, "stop": stop, "one": (ones + 0.5) / (zeros + ones + 1.0)}


def _below(ids: np.ndarray, child: dict, depth: int) -> np.ndarray:
    """Sum of the children's log_p for the nodes of a level."""
    parent = np.searchsorted(ids, child["ids"] & np.uint64((1 << 8 * (depth + 1)) - 1))
    return np.bincount(parent, child["log_p"], len(ids))


def _subtrees(keys: np.ndarray, counts: np.ndarray, depth: int) -> list[dict]:
    """Levels depth, ..., 2 of a shard's strings, deepest first."""
    out: list[dict] = []
    for d in range(depth, 1, -1):
        level = _level(keys, counts, d)
        out.append(_weigh(level, _below(level[0], out[-1], d) if out else None))
    return out


def _upper(depth: int):
    """Shards -> rows (last, ids, zeros, ones, below) of level one by its context byte, each shard's share of the sums."""
    schema = pa.schema([("last", pa.int64()), *((n, pa.binary()) for n in ("ids", "zeros", "ones", "below"))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for x in rows_of(batch):
                keys, counts = _restored(x["keys"], True), _restored(x["counts"], False).astype(np.int64)
                if not len(keys):
                    continue
                ids, zeros, ones = _level(keys, counts, 1)
                below = _below(ids, _subtrees(keys, counts, depth)[-1], 1)
                last = (ids >> np.uint64(8)).astype(np.int64)
                rows = [(int(b), ids[last == b].tobytes(), zeros[last == b].tobytes(), ones[last == b].tobytes(), below[last == b].tobytes()) for b in np.unique(last)]
                yield batch_of(rows, schema)

    return run, "last long, ids binary, zeros binary, ones binary, below binary"


def _level_one(t: pa.Table) -> pa.Table:
    """One context byte's shares -> its nodes, weighed."""
    kinds = (("ids", np.uint64), ("zeros", np.int64), ("ones", np.int64), ("below", np.float64))
    ids, zeros, ones, below = _sums(*(np.concatenate([np.frombuffer(x.as_py(), k) for x in t[n]]) for n, k in kinds))
    node = _weigh((ids, zeros, ones), below) | {"zeros": zeros, "ones": ones}
    return pa.table({n: pa.array([node[n].tobytes()], pa.binary()) for n in ("ids", "zeros", "ones", "log_p", "stop", "one")})


def upper_levels(model: DataFrame, depth: int) -> list[dict]:
    """Levels one and zero, which have at most 65,536 and 256 nodes."""
    run, schema = _upper(depth)
    fields = ", ".join(f"{n} binary" for n in ("ids", "zeros", "ones", "log_p", "stop", "one"))
    rows = model.mapInArrow(run, schema).groupBy("last").applyInArrow(_level_one, fields).collect()
    kinds = {"ids": np.uint64, "zeros": np.int64, "ones": np.int64, "log_p": np.float64, "stop": np.float64, "one": np.float64}
    one = {n: np.concatenate([np.frombuffer(r[n], k) for r in rows] or [np.empty(0, k)]) for n, k in kinds.items()}
    order = np.argsort(one["ids"])
    one = {n: v[order] for n, v in one.items()}
    level = _sums(one["ids"] & np.uint64(255), one["zeros"], one["ones"])
    return [one, _weigh(level, _below(level[0], one, 0))]


def log_scores(keys: np.ndarray, levels: list[dict], depth: int) -> np.ndarray:
    """Log10 probability of each string's last byte after its others; levels from the deepest to level zero."""
    total = np.zeros(len(keys))
    for k in range(8):
        choice = np.uint64(1 << k) | ((keys & np.uint64(255)) >> np.uint64(8 - k))
        bit = ((keys >> np.uint64(7 - k)) & np.uint64(1)).astype(bool)
        p = np.full(len(keys), 0.5)
        for m, d in zip(levels, range(depth, -1, -1), strict=True):
            if len(m["ids"]):
                node = ((keys & np.uint64((1 << 8 * (d + 1)) - 1)) >> np.uint64(8) << np.uint64(8)) | choice
                at = np.minimum(np.searchsorted(m["ids"], node), len(m["ids"]) - 1)
                p = np.where(m["ids"][at] == node, m["stop"][at] * m["one"][at] + (1 - m["stop"][at]) * p, 0.5)
        total += np.log10(np.where(bit, p, 1 - p))
    return total


def _answers(depth: int, top):
    """Questions of a (shard, part) and the shard's model -> rows (chunk_id, keys, logs)."""
    none = {"ids": np.empty(0, np.uint64), "stop": np.empty(0), "one": np.empty(0)}

    def run(asked: pa.Table, model: pa.Table) -> pa.Table:
        each = [_restored(x.as_py(), True) for x in asked["keys"]]
        every = np.unique(np.concatenate(each)) if each else np.empty(0, np.uint64)
        own = [none] * (depth - 1)
        if model.num_rows:
            keys, counts = _total(model)
            own = _subtrees(keys, counts, depth) if len(keys) else own
        levels = [*own, *top.value]
        logs = np.concatenate([np.empty(0)] + [log_scores(every[a : a + (1 << 17)], levels, depth) for a in range(0, len(every), 1 << 17)]).astype("<f4")
        rows = [logs[np.searchsorted(every, x)].tobytes() for x in each]
        return pa.table({"chunk_id": asked["chunk_id"], "keys": asked["keys"], "logs": pa.array(rows, pa.binary())})

    return run


def string_scores(chunks: DataFrame, depth: int) -> DataFrame:
    """(chunk_id, keys, logs): log10 probabilities of the strings of every chunk, a row for each shard it asked."""
    spark = chunks.sparkSession
    run, schema = _strings(depth, max(64, parts(spark)))
    strings = materialize(chunks.mapInArrow(run, schema), "strings")
    model = shard_counts(strings, max(1, chunks.count()))
    top = spark.sparkContext.broadcast(upper_levels(model, depth))
    # A shard with many questions is copied, and each copy gets a part of them.
    copies = strings.groupBy(F.col("shard").alias("_s")).agg(F.ceil(F.sum("n") / ASKED).cast("int").alias("copies"))
    copies = F.broadcast(materialize(copies, "copies"))
    asked = strings.join(copies, F.col("shard") == F.col("_s")).select("shard", F.pmod(F.xxhash64("chunk_id"), "copies").cast("int").alias("part"), "chunk_id", "keys")
    told = model.join(copies, F.col("shard") == F.col("_s")).select("shard", F.explode(F.sequence(F.lit(0), F.col("copies") - 1)).alias("part"), "keys", "counts")
    both = asked.groupBy("shard", "part").cogroup(told.groupBy("shard", "part"))
    return both.applyInArrow(_answers(depth, top), "chunk_id long, keys binary, logs binary")


class Lookup:
    """Values by key, through a table of slots with the sorted keys behind it."""

    SLOTS = 21

    def __init__(self, keys: np.ndarray, values: np.ndarray) -> None:
        order = np.argsort(keys)
        self.keys, self.values = keys[order], values[order]
        self.slot = np.zeros(1 << self.SLOTS, np.int32)
        self.slot[self._slots(self.keys)] = np.arange(len(keys))

    def _slots(self, keys: np.ndarray) -> np.ndarray:
        return (keys * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.SLOTS)

    def __call__(self, keys: np.ndarray) -> np.ndarray:
        at = self.slot[self._slots(keys)]
        miss = np.flatnonzero(self.keys[at] != keys)
        at[miss] = np.searchsorted(self.keys, keys[miss])
        return self.values[at]


def _word_names(words: list[bytes]) -> np.ndarray:
    return np.fromiter((xxhash.xxh64_intdigest(w) for w in words), np.uint64, len(words))


def _chunk_words(x: dict) -> tuple[list[list[bytes]], dict[bytes, int]]:
    """Word lists of a chunk's texts, and the training count of every distinct word in order of first sight."""
    lines = [t.lower().split() for t in texts_of(x["sizes"], x["packed"])]
    train_count, other = Counter(), set()
    for i, w in zip(x["ids"], lines, strict=True):
        if held_out(i):
            other.update(w)
        else:
            train_count.update(w)
    return lines, dict(train_count) | {w: 0 for w in sorted(other) if w not in train_count}


def _word_counts(bits: int):
    schema = pa.schema([("bucket", pa.int64()), ("chunk_id", pa.int64()), ("names", pa.binary()), ("counts", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for x in rows_of(batch):
                _, words = _chunk_words(x)
                names, n = _word_names(list(words)), np.fromiter(words.values(), "<i4", len(words))
                rows = [(b, x["chunk_id"], names[at].tobytes(), n[at].tobytes()) for b, at in by_bucket(names, bits)]
                if rows:
                    yield batch_of(rows, schema)

    return run, "bucket long, chunk_id long, names binary, counts binary"


def _word_totals(t: pa.Table) -> pa.Table:
    """One bucket of words -> per chunk the corpus counts of its words; `known` counts distinct training words once."""
    each = [np.frombuffer(x.as_py(), np.uint64) for x in t["names"]]
    counts = np.concatenate([np.frombuffer(x.as_py(), "<i4") for x in t["counts"]]).astype(np.int64)
    names, total = _sums(np.concatenate(each), counts)
    out = [total[np.searchsorted(names, x)].astype("<i8").tobytes() for x in each]
    known, tokens = ([int(k)] + [0] * (len(each) - 1) for k in ((total > 0).sum(), total.sum()))
    bucket = [t["bucket"][0].as_py()] * len(each)
    return pa.table({"chunk_id": t["chunk_id"], "bucket": pa.array(bucket, pa.int64()), "totals": pa.array(out, pa.binary()), "known": pa.array(known, pa.int64()), "tokens": pa.array(tokens, pa.int64())})


def context_tree_scores(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", depth: int = DEPTH, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """Score every text by a context-tree model of the training texts (crc32 of the id mod 5 is not 1).

    One row for each row of docs: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score, and
    bits_per_byte (code length of the coded text over its bytes). Null texts are empty: they still have the end token.
    A null id trains. Repeated rows count each time. Other columns are ignored. Without training tokens every choice
    has probability one half, and base_score is 0. depth: 2 to 6 bytes of context.
    """
    if not 2 <= depth <= 6:
        raise ValueError("depth: 2 to 6")
    spark = docs.sparkSession
    ship(spark)
    chunks = pack(docs, text, doc_id, chunk_bytes, "lm")
    spread = parts(spark) * 2
    bits = max(1, int(spread).bit_length())
    run, schema = _word_counts(bits)
    totals = materialize(chunks.mapInArrow(run, schema).groupBy("bucket").applyInArrow(_word_totals, "chunk_id long, bucket long, totals binary, known long, tokens long"), "words")
    trained = F.expr("sum(size(filter(ids, i -> coalesce(crc32(cast(cast(i as string) as binary)) % 5, 0) <> 1)))")
    ends = chunks.agg(trained).first()[0] or 0
    words, known = totals.agg(F.coalesce(F.sum("tokens"), F.lit(0)), F.coalesce(F.sum("known"), F.lit(0))).first()
    n, v = words + ends, known + (ends > 0)
    told = string_scores(chunks, depth).groupBy("chunk_id").agg(F.collect_list(F.struct("keys", "logs")).alias("told")).hint("shuffle_hash")
    gathered = totals.groupBy("chunk_id").agg(F.collect_list(F.struct("bucket", "totals")).alias("found")).hint("shuffle_hash")
    names = ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score", "bits_per_byte"]
    types = [pa.int64(), pa.bool_(), pa.int64(), pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.float64()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def base(counts: np.ndarray) -> np.ndarray:
            return np.log10((counts + 0.5) / (n + 0.5 * (v + 1)))

        for batch in batches:
            for x in rows_of(batch):
                lines, words = _chunk_words(x)
                named, total = _word_names(list(words)), np.zeros(len(words), np.int64)
                by = {f["bucket"]: np.frombuffer(f["totals"], "<i8") for f in x["found"] or []}
                for b, at in by_bucket(named, bits):
                    total[at] = by[b]
                logs = dict(zip(words, base(total).tolist(), strict=True))
                unseen = {w for w, c in zip(words, total.tolist(), strict=True) if c == 0}
                end = float(base(np.array([ends]))[0])
                lookup = Lookup(np.concatenate([_restored(a["keys"], True) for a in x["told"]]), np.concatenate([np.frombuffer(a["logs"], "<f4") for a in x["told"]]).astype(np.float64))
                scores, sizes = [], []
                for piece in _pieces(lines):
                    keys, size = _keys(piece, depth)
                    scores.append(np.add.reduceat(lookup(keys), np.cumsum(size) - size))
                    sizes.append(size)
                score, size = np.concatenate(scores), np.concatenate(sizes)
                known = [len(w) + (ends > 0) - (sum(u in unseen for u in w) if unseen else 0) for w in lines]
                bases = [sum(map(logs.__getitem__, w)) + end if n else 0.0 for w in lines]
                cols = [x["ids"], [held_out(i) for i in x["ids"]], [len(w) + 1 for w in lines], known, [n] * len(lines), bases, score, -score / np.log10(2) / size]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types, strict=True)], names=names)

    schema = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double, bits_per_byte double"
    return chunks.join(gathered, "chunk_id", "left").join(told, "chunk_id", "left").mapInArrow(run, schema)


def op1_context_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return context_tree_scores(table(spark, sf_dir, "documents"))
