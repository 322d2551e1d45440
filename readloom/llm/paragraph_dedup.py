"""Paragraph near-duplicates by MinHash banding (operator 2).

Paragraphs are of two kinds. Every line with a word is one. And since a passage can be copied into the middle of a line
or across lines, every text also has windows of WINDOW words that begin at content-defined anchors: the places whose
shingle hash is the least of REACH consecutive ones in the text. Any run of WINDOW + REACH - 1 = 50 words holds an anchor with its
window, the same wherever the run stands, so two texts with 50 equal words in a row have an equal window.

Equal paragraphs are one class from the start, named by a 64-bit hash; windows are paragraphs of this sort. The MinHash
signature of a line of five words or more, over shingles of five lower-cased words, is cut into BANDS bands of
BAND_ROWS: at similarity 0.8 two lines share a band with probability 1 - (1 - 0.8**4)**9 = 0.991. (Shorter lines have a
single shingle, so they are similar if equal.) Classes that share a band are compared by exact Jaccard similarity, band
by band and in blocks, so that no task has a large band whole; of bands with the same classes one is enough. Components
of the verified links are the duplicate groups: the first paragraph by (doc_id, position) stays, the others go.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from readloom.llm.common import give_back, materialize, parts, ship, table
from readloom.llm.components import connected_components
from readloom.llm.verify import jaccard_links

SHINGLE, SIMILARITY = 5, 0.8
BANDS, BAND_ROWS = 9, 4
#: Words of a window, and consecutive places of which the least hash is an anchor.
WINDOW, REACH = 24, 27
#: Size of the filter that spares most paragraphs the second shuffle; fixed, so it only filters less as data grow.
FILTER_BITS = 1 << 22
#: Bytes of texts that are taken apart together; a longer text stands alone.
GROUP_BYTES = 1 << 20
_PERMUTE = np.random.default_rng(31).integers(1, 2**63, (2, BANDS * BAND_ROWS), dtype=np.uint64) | np.uint64(1)
_COMBINE = np.random.default_rng(32).integers(1, 2**63, SHINGLE, dtype=np.uint64) | np.uint64(1)
_BASE, _INVERSE = 0x9E3779B97F4A7C15, pow(0x9E3779B97F4A7C15, -1, 1 << 64)


class WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) > 200_000:
            self.clear()
        self[word] = h = xxhash.xxh64_intdigest(word)
        return h


def shingle_hashes(lines: list[list[bytes]], words: WordHashes) -> tuple[np.ndarray, np.ndarray]:
    """Shingle hashes of word lists, one after another, and where each list's begin; short lists have one."""
    sizes = np.array([len(w) for w in lines], np.int64)
    flat = np.fromiter(map(words.__getitem__, chain.from_iterable(lines)), np.uint64, int(sizes.sum()))
    out, offsets = _line_shingles(_shingles(flat), np.cumsum(sizes) - sizes, sizes)
    for k in np.flatnonzero(sizes < SHINGLE).tolist():
        out[offsets[k]] = xxhash.xxh64_intdigest(b" ".join(lines[k]), 1)
    return out ^ (out >> np.uint64(32)), offsets


def _shingles(flat: np.ndarray) -> np.ndarray:
    """Hash of the shingle at every word of a run of word hashes; the last ones count zeros past the end."""
    flat = np.concatenate([flat, np.zeros(SHINGLE - 1, np.uint64)])
    n = len(flat) - SHINGLE + 1
    h = sum((flat[j : j + n] * _COMBINE[j] for j in range(SHINGLE)), np.zeros(n, np.uint64))
    return (h ^ (h >> np.uint64(31))) * np.uint64(0xD6E8FEB86659FD93)


def _line_shingles(h: np.ndarray, begin: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    counts = np.maximum(1, sizes - SHINGLE + 1)
    offsets = np.cumsum(counts) - counts
    at = np.repeat(begin - offsets, counts) + np.arange(int(counts.sum()))
    return h[at], offsets


def _bands(hashes: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Band keys, one row a paragraph."""
    keys = np.empty((len(offsets), BANDS), np.uint64)
    for b in range(BANDS):
        key = np.full(len(offsets), b + 1, np.uint64)
        for r in range(BAND_ROWS):
            i = b * BAND_ROWS + r
            least = np.minimum.reduceat((hashes * _PERMUTE[0, i] + _PERMUTE[1, i]) >> np.uint64(16), offsets)
            key = (key ^ least) * np.uint64(0x9E3779B97F4A7C15)
            key ^= key >> np.uint64(29)
        keys[:, b] = key
    return keys.view(np.int64)


class _Powers:
    """Powers of the hash base and its inverse modulo 2**64, kept for reuse."""

    up = down = np.ones(1, np.uint64)

    @classmethod
    def reach(cls, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(cls.up) < n:
            size = 1 << int(n).bit_length()
            cls.up, cls.down = (np.full(size, x, np.uint64) for x in (_BASE, _INVERSE))
            cls.up[0] = cls.down[0] = 1
            np.multiply.accumulate(cls.up, out=cls.up)
            np.multiply.accumulate(cls.down, out=cls.down)
        return cls.up[:n], cls.down[:n]


class Words:
    """Words of some texts in one run of hashes: where texts and lines begin, and names of any stretch."""

    def __init__(self, texts: list[bytes], words: WordHashes) -> None:
        lines, per_text = [], []
        for t in texts:
            split = [x.split() for x in t.lower().split(b"\n")]
            per_text.append(len(split))
            lines += split
        self.line_size = np.fromiter(map(len, lines), np.int64, len(lines))
        self.line_begin = np.cumsum(self.line_size) - self.line_size
        self.line_text = np.repeat(np.arange(len(texts)), per_text)
        self.flat = np.fromiter(map(words.__getitem__, chain.from_iterable(lines)), np.uint64, int(self.line_size.sum()))
        size = np.bincount(self.line_text, self.line_size, len(texts)).astype(np.int64)
        self.text_end = np.cumsum(size)
        self.text_begin = self.text_end - size
        up, self.down = _Powers.reach(len(self.flat) + 1)
        self.sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(self.flat * up[:-1], dtype=np.uint64)])
        self.shingles = _shingles(self.flat)

    def names(self, begin: np.ndarray, size: np.ndarray) -> np.ndarray:
        h = (self.sums[begin + size] - self.sums[begin]) * self.down[begin] + size.astype(np.uint64)
        h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
        return (h ^ (h >> np.uint64(29))).view(np.int64)

    def anchors(self) -> np.ndarray:
        """Places whose shingle hash is the least of some REACH consecutive places with WINDOW words left in their text;
        in a text with fewer such places, the least of all."""
        n, places = len(self.flat), np.maximum(0, self.text_end - self.text_begin - WINDOW + 1)
        if not places.any():
            return np.empty(0, np.int64)
        h = self.shingles
        edge = np.zeros(n + 1, np.int64)
        long = np.flatnonzero(places >= REACH)
        np.add.at(edge, self.text_begin[long], 1)
        np.add.at(edge, self.text_begin[long] + places[long] - REACH + 1, -1)
        pad = np.zeros(REACH - 1, np.uint64)
        least = _slide(np.minimum, np.concatenate([h, pad]), REACH)
        least[np.cumsum(edge[:n]) == 0] = 0
        chosen = _slide(np.maximum, np.concatenate([pad, least]), REACH) == h
        short = np.flatnonzero((places > 0) & (places < REACH))
        if len(short):
            m = places[short]
            offsets = np.cumsum(m) - m
            at = np.repeat(self.text_begin[short] - offsets, m) + np.arange(int(m.sum()))
            chosen[at] = h[at] == np.repeat(np.minimum.reduceat(h[at], offsets), m)
        return np.flatnonzero(chosen)


def _slide(best, x: np.ndarray, reach: int) -> np.ndarray:
    """best (a minimum or maximum) of every `reach` consecutive values."""
    done = 1
    while 2 * done <= reach:
        x = best(x[:-done], x[done:])
        done *= 2
    rest = reach - done
    return best(x[: len(x) - rest], x[rest:]) if rest else x


def _groups(batch: pa.RecordBatch, column: int) -> Iterator[tuple[int, list[bytes]]]:
    """(first row, texts) of a batch, by about GROUP_BYTES."""
    held, size, first = [], 0, 0
    for k, t in enumerate(batch.column(column).to_pylist()):
        t = t or b""
        if held and size + len(t) > GROUP_BYTES:
            yield first, held
            held, size, first = [], 0, k
        held.append(t)
        size += len(t)
    if held:
        yield first, held


def _occurrences(min_words: int):
    """Rows (rid, doc_id, start, n, line, name, bands): line is false for windows; bands stand with a line's first
    occurrence among the texts taken apart together; texts without paragraphs have one row with no name."""
    names = ["rid", "doc_id", "start", "n", "line", "name", "bands"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        give_back()
        words, rid = WordHashes(), TaskContext.get().partitionId() << 40
        for batch in batches:
            ids = batch.column(0)
            for first, texts in _groups(batch, 1):
                w = Words(texts, words)
                lines = np.flatnonzero(w.line_size >= max(1, min_words))
                begin, size, text = w.line_begin[lines], w.line_size[lines], w.line_text[lines]
                name = w.names(begin, size)
                _, one = np.unique(name, return_index=True)
                one = np.sort(one[size[one] >= SHINGLE])
                grams, offsets = _line_shingles(w.shingles, begin[one], size[one])
                keys = _bands(grams ^ (grams >> np.uint64(32)), offsets) if len(one) else np.empty((0, BANDS), np.int64)
                at = w.anchors()
                at = at[~np.isin(at, begin[size == WINDOW])]
                none = np.flatnonzero(np.bincount(text, minlength=len(texts)) == 0)
                n, m, z = len(lines), len(at), len(none)
                text = np.concatenate([text, np.searchsorted(w.text_end, at, side="right"), none])
                start = np.concatenate([begin, at, w.text_begin[none]]) - w.text_begin[text]
                sizes = np.concatenate([size, np.full(m, WINDOW), np.zeros(z, np.int64)])
                full = np.concatenate([name, w.names(at, np.full(m, WINDOW)), np.zeros(z, np.int64)])
                has = np.zeros(n + m + z, np.int32)
                has[one] = BANDS
                ends = np.concatenate([np.zeros(1, np.int32), np.cumsum(has, dtype=np.int32)])
                lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(keys.ravel()), mask=pa.array(has == 0))
                line = np.arange(n + m + z) < n
                cols = [pa.array(rid + first + text), ids.take(pa.array(first + text)), pa.array(start.astype(np.int32)), pa.array(sizes.astype(np.int32))]
                cols += [pa.array(line), pa.array(full, mask=np.arange(n + m + z) >= n + m), lists]
                yield pa.RecordBatch.from_arrays(cols, names=names)
            rid += batch.num_rows

    return run, "rid long, doc_id long, start int, n int, line boolean, name long, bands array<long>"


def _grams(min_words: int, wanted: bytes):
    """Rows (name, grams) of the lines that pass the filter, once for the texts taken apart together."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        give_back()
        words, bits = WordHashes(), np.unpackbits(np.frombuffer(wanted, np.uint8), bitorder="little")
        for batch in batches:
            for _, texts in _groups(batch, 0):
                w = Words(texts, words)
                lines = np.flatnonzero(w.line_size >= max(SHINGLE, min_words))
                name = w.names(w.line_begin[lines], w.line_size[lines])
                _, one = np.unique(name, return_index=True)
                one = one[bits[name[one] & (FILTER_BITS - 1)] > 0]
                if len(one):
                    hashes, offsets = _line_shingles(w.shingles, w.line_begin[lines[one]], w.line_size[lines[one]])
                    rows = [np.unique(x).tobytes() for x in np.split(hashes, offsets[1:])]
                    yield pa.RecordBatch.from_arrays([pa.array(name[one]), pa.array(rows, pa.binary())], names=["name", "grams"])

    return run, "name long, grams binary"


def name_filter(names: DataFrame, column: str) -> bytes:
    """FILTER_BITS bits, set at the names' low bits; collected as one long for 64 of them."""
    low = F.col(column).bitwiseAND(FILTER_BITS - 1)
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), (low % 64).cast("int")).alias("bit")
    rows = names.select((low / 64).cast("int").alias("at"), bit).groupBy("at").agg(F.bit_or("bit").alias("bits")).toArrow()
    out = np.zeros(FILTER_BITS // 64, "<i8")
    out[rows["at"].to_numpy()] = rows["bits"].to_numpy()
    return out.tobytes()


def line_groups(rows: DataFrame, seen: DataFrame, similarity: float, min_words: int) -> DataFrame:
    """(name, group) of the lines that have a near-duplicate; rows: the texts as one binary column."""
    banded = seen.filter("bands is not null").groupBy("name").agg(F.first("bands").alias("bands"))
    # Both sides of this join read the same shuffle, in which a line has one narrow row a band.
    keys = banded.select("name", F.explode_outer("bands").alias("key")).repartition(parts(rows.sparkSession), "key")
    alike = ("n", "least", "most", "mark")
    sizes = keys.groupBy("key").agg(F.count("*").alias("n"), F.min("name").alias("least"), F.max("name").alias("most"), F.bit_xor(F.xxhash64("name")).alias("mark"))
    sizes = sizes.filter("least <> most").withColumnRenamed("key", "_key")
    shared = materialize(keys.join(sizes, F.col("key") == F.col("_key")).drop("_key"), "colliding")
    once = shared.groupBy(*alike).agg(F.min("key").alias("_key")).select("_key")
    members = materialize(shared.join(once, F.col("key") == F.col("_key")).select(F.col("name").alias("_name"), F.col("key").alias("cluster")), "members")
    run, schema = _grams(min_words, name_filter(members, "_name"))
    grams = rows.mapInArrow(run, schema).groupBy("name").agg(F.first("grams").alias("grams"))
    grams = grams.join(members, F.col("name") == F.col("_name")).select("cluster", F.col("name").alias("node"), "grams")
    groups = connected_components(jaccard_links(grams, similarity, nodes=members))
    return groups.select(F.col("node").alias("name"), F.col("component").alias("group"))


def duplicate_paragraphs(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", similarity: float = SIMILARITY, min_words: int = 1) -> DataFrame:
    """One row for each row of docs: doc_id, n_paragraphs, n_linked, n_short_linked, n_removed, removed, keeper_ids.

    n_paragraphs counts lines of at least min_words words. n_linked counts lines and windows of WINDOW words or more
    that have a duplicate in another row, n_short_linked shorter lines of that sort. n_removed counts lines and windows
    that are not the first of their group, in this row or elsewhere; `removed` has the words they cover, as merged spans
    [start, end) of word numbers, and keeper_ids the doc_ids whose copies stay. Null texts and texts without a word have
    none. Rows with equal or null ids stay rows of their own; among equal ids one row comes first. Other columns are
    ignored.
    """
    ship(docs.sparkSession)
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("binary").alias("_b"))
    run, schema = _occurrences(min_words)
    seen = materialize(rows.mapInArrow(run, schema), "paragraphs")
    named = seen.filter("name is not null")
    groups = materialize(line_groups(rows.select("_b"), seen, similarity, min_words), "groups")
    again = named.groupBy("name").count().filter("count > 1").select("name", F.col("name").alias("group"))
    # A name that is repeated and near others has two rows here, of which its group counts.
    wanted = again.withColumn("own", F.lit(1)).unionByName(groups.withColumn("own", F.lit(0)))
    wanted = wanted.groupBy(F.col("name").alias("_name")).agg(F.min_by("group", "own").alias("group"))
    wanted = materialize(wanted, "wanted")
    hits = materialize(named.drop("line", "bands").join(wanted, F.col("name") == F.col("_name")).select("rid", "doc_id", "start", "n", "group"), "hits")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("unknown"), "doc_id", "rid", "start", "n")).alias("keeper")
    whole = hits.groupBy(F.col("group").alias("_group")).agg(first, F.min("rid").alias("low"), F.max("rid").alias("high"))
    told = hits.join(materialize(whole, "whole"), F.col("group") == F.col("_group"))
    gone = ~((F.col("rid") == F.col("keeper.rid")) & (F.col("start") == F.col("keeper.start")) & (F.col("n") == F.col("keeper.n")))
    elsewhere, span = F.col("low") != F.col("high"), F.struct("start", (F.col("start") + F.col("n")).alias("end"))
    counts = told.groupBy(F.col("rid").alias("_rid")).agg(
        F.count_if(elsewhere & (F.col("n") >= WINDOW)).alias("n_linked"),
        F.count_if(elsewhere & (F.col("n") < WINDOW)).alias("n_short_linked"),
        F.count_if(gone).alias("n_removed"),
        F.array_sort(F.collect_set(F.when(gone, span))).alias("removed"),
        F.array_sort(F.collect_set(F.when(gone, F.col("keeper.doc_id")))).alias("keeper_ids"),
    )
    every = seen.groupBy("rid").agg(F.first("doc_id").alias("doc_id"), F.count_if(F.col("line") & F.col("name").isNotNull()).alias("n_paragraphs"))
    zero = {c: F.coalesce(c, F.lit(0).cast("long")) for c in ("n_linked", "n_short_linked", "n_removed")}
    lists = {"removed": F.coalesce(_merged("removed"), F.expr("cast(array() as array<struct<start: int, end: int>>)")), "keeper_ids": F.coalesce("keeper_ids", F.expr("cast(array() as array<bigint>)"))}
    return every.join(counts, F.col("rid") == F.col("_rid"), "left").withColumns(zero | lists).drop("rid", "_rid")


def _merged(spans: str) -> F.Column:
    """Sorted spans with those that touch or overlap made one."""
    grown = "named_struct('start', element_at(a, -1).start, 'end', greatest(element_at(a, -1).end, x.end))"
    step = f"if(size(a) > 0 and x.start <= element_at(a, -1).end, concat(slice(a, 1, size(a) - 1), array({grown})), concat(a, array(x)))"
    return F.expr(f"aggregate({spans}, cast(array() as array<struct<start: int, end: int>>), (a, x) -> {step})")


def without_words(text: F.Column, removed: F.Column) -> F.Column:
    """A text less its words in the given spans, and the white space after each; nulls stay null."""
    pieces = F.regexp_extract_all(text, F.lit(r"([ \t-\r]*[^ \t-\r]+[ \t-\r]*)"), F.lit(1))
    left = F.filter(pieces, lambda x, i: ~F.exists(removed, lambda s: (i >= s["start"]) & (i < s["end"])))
    return F.when(F.size(removed) == 0, text).otherwise(F.array_join(left, ""))


def op2_paragraph_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return duplicate_paragraphs(table(spark, sf_dir, "documents"))
