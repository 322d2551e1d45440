"""Runs of periodic words (operator 11), by enumeration of maximal pairs.

Two places of a text form a maximal pair when the words from either on agree for exactly `l` words and the words before
them differ. If their distance p is at most l, the stretch of p + l words from the first place on has period p and no
neighbouring word extends it: it is a run. Every run shows itself so, by its period and by multiples of it, of which the
least counts. Texts are numbered word by word, each with numbers of its own, and sorted by suffixes in groups of about a
megabyte; suffixes whose first words occur once drop out at once. The tree of LCP intervals is walked bottom-up. A node
holds the places of its suffixes, in order, and the same by the word to their left. When a child joins its node, each
place of the smaller side meets only the places within the node's depth that have another word to their left.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from readloom.llm.common import give_back, pieces, ship, table, word_array

#: Bytes of texts whose suffixes are sorted together; a longer text stands alone.
GROUP_BYTES = 1 << 20
#: Bytes of a text that are split into words at once.
PIECE_BYTES = 4 << 20
#: Places of a node from which on they are also kept by the word to their left.
MANY = 12


def number_words(text: bytes) -> tuple[np.ndarray, list[bytes]]:
    """(number of each word, the word of each number), numbers in order of first appearance."""
    known: dict[bytes, int] = {}
    out = [np.fromiter((known.setdefault(w, len(known)) for w in p.split()), np.int64) for p in pieces(text, PIECE_BYTES)]
    return np.concatenate(out) if out else np.empty(0, np.int64), list(known)


def _starts(*sorted_keys: np.ndarray) -> np.ndarray:
    """For each entry of sorted keys the index of the first equal one."""
    first = np.ones(len(sorted_keys[0]), bool)
    first[1:] = np.logical_or.reduce([k[1:] != k[:-1] for k in sorted_keys])
    return np.maximum.accumulate(np.where(first, np.arange(len(first)), 0))


def repeated_suffixes(words: np.ndarray, end: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """Places whose first `least` words (2 or more) occur again, in the order of their suffixes, and whether the suffix
    before each shares these words. `end` is where the text of each word ends; texts share no number."""
    n = len(words)

    def following(rank: np.ndarray, at: np.ndarray, shift: int) -> np.ndarray:
        to = at + shift
        return np.where(to < end[at], rank[np.minimum(to, n - 1)], -1)

    def sharing(group: np.ndarray, members: np.ndarray) -> np.ndarray:
        return members[np.bincount(group, minlength=len(group))[group] > 1]

    every = np.arange(n)
    order = np.argsort(words * (int(words.max()) + 2) + following(words, every, 1) + 1)
    first, second = words[order], following(words, order, 1)
    group = _starts(first, second)
    rank = np.empty(n, np.int64)  # index of the first suffix with the same first `seen` words
    rank[order] = group
    live, seen, found = sharing(group, order), 2, None
    while len(live):
        if seen >= least and found is None:
            found, family = live, rank[live].copy()
        step = min(seen, least - seen) if seen < least else seen
        a, b = rank[live], following(rank, live, step)
        order = np.lexsort((b, a))
        live, a, b = live[order], a[order], b[order]
        group, whole = _starts(a, b), _starts(a)
        rank[live] = a + group - whole
        live, seen = sharing(group, live), seen + step
    if found is None:
        return np.empty(0, np.int64), np.empty(0, bool)
    order = np.argsort(rank[found])
    family = family[order]
    return found[order], np.r_[False, family[1:] == family[:-1]]


def _common(words: list[int], order: list[int], shares: list[bool], least: int) -> list[int]:
    """Words that each suffix in order has in common with the one before; 0 where it is under `least`."""
    before = {i: order[k - 1] for k, i in enumerate(order) if shares[k]}
    common, last, h = {}, -2, 0
    for i in sorted(before):
        h = max(h - 1, least) if i == last + 1 else least
        j = before[i]
        while words[i + h] == words[j + h]:
            h += 1
        common[i], last = h, i
    return [common.get(i, 0) for i in order]


class _Node:
    """Places of the suffixes of an LCP interval, in order; once there are many, also by the word to their left."""

    __slots__ = ("places", "by_left")

    def __init__(self, place: int) -> None:
        self.places, self.by_left = [place], None


def _join(a: _Node, b: _Node, depth: int, left: list[int], least: int, found: dict[tuple[int, int], int]) -> _Node:
    """Two children of one node as one; adds the runs that maximal pairs between them show."""
    if len(a.places) < len(b.places):
        a, b = b, a
    many, by_left = a.places, a.by_left
    for i in b.places:
        word = left[i]
        lo, hi = bisect_left(many, i - depth), bisect_right(many, i + depth)
        if by_left is None or hi - lo <= len(by_left):
            near = [j for j in many[lo:hi] if left[j] != word]
        else:
            near = [j for c, js in by_left.items() if c != word for j in js[bisect_left(js, i - depth) : bisect_right(js, i + depth)]]
        for j in near:
            period = abs(i - j)
            if period + depth >= least:
                key = min(i, j), period + depth
                found[key] = min(period, found.get(key, period))
    for i in b.places:
        insort(many, i)
    if by_left is not None:
        for i in b.places:
            insort(by_left.setdefault(left[i], []), i)
    elif len(many) > MANY:
        a.by_left = by_left = {}
        for i in many:
            by_left.setdefault(left[i], []).append(i)
    return a


def runs_of(words: np.ndarray, sizes: list[int], least: int) -> list[list[tuple[int, int, int]]]:
    """Runs (start, length, period) of each text, in order; `words` are the texts' numbers one after the other, with
    `sizes` words a text, and no number in two texts."""
    begin = np.cumsum(sizes) - sizes
    out: list[list[tuple[int, int, int]]] = [[] for _ in sizes]
    if len(words) < least:
        return out
    half = -(-least // 2)
    order, shares = repeated_suffixes(words, np.repeat(begin + sizes, sizes), half)
    if not len(order):
        return out
    left = np.r_[-1, words[:-1]]
    left[begin[np.asarray(sizes) > 0]] = -1
    left = left.tolist()
    order = order.tolist()
    common = _common([*words.tolist(), -1], order, shares.tolist(), half)
    found: dict[tuple[int, int], int] = {}
    open_: list[tuple[int, _Node]] = []  # the intervals that hold the current suffix, by depth
    node = _Node(order[0])
    for i, depth in zip([*order[1:], -1], [*common[1:], 0], strict=True):
        while open_ and open_[-1][0] > depth:
            below, parent = open_.pop()
            node = _join(parent, node, below, left, least, found)
        if open_ and open_[-1][0] == depth:
            open_[-1] = depth, _join(open_[-1][1], node, depth, left, least, found)
        elif depth:
            open_.append((depth, node))
        node = _Node(i)
    runs = sorted((start, length, period) for (start, length), period in found.items())
    owner = np.searchsorted(begin + sizes, [r[0] for r in runs], side="right").tolist() if runs else []
    for k, (start, length, period) in zip(owner, runs, strict=True):
        out[k].append((start - int(begin[k]), length, period))
    for k in set(owner):
        out[k].sort(key=lambda r: (r[0], r[2]))
    return out


def _groups(batches: Iterator[pa.RecordBatch]) -> Iterator[list[tuple[int | None, bytes]]]:
    held, size = [], 0
    for b in batches:
        for i, t in zip(b.column(0), b.column(1), strict=True):
            value = t.as_py() or b""
            if held and size + len(value) > GROUP_BYTES:
                yield held
                held, size = [], 0
            held.append((i.as_py(), value))
            size += len(value)
    if held:
        yield held


def periodic_runs(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", least: int = 12) -> DataFrame:
    """One row for each row of docs: doc_id, n_words, runs (array of start, length and period in words, by start and
    period) and collapsed (the text's words, without those that a run holds after its first period, joined by spaces).

    A run is a stretch of words with least period q, at least max(least, 2 q) words long, that no neighbouring word
    extends. Null and blank texts have no words; null ids and repeated rows stay; other columns are ignored. least: 4 or
    more. A task holds a group of texts, or one longer text at about 130 bytes a word.
    """
    if least < 4:
        raise ValueError("least: 4 words or more")
    ship(docs.sparkSession)
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("binary").alias("t"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        give_back()
        triple = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])
        for group in _groups(batches):
            numbered, base = [], 0
            for _, t in group:
                ids, names = number_words(t)
                numbered.append((ids + base, names, base))
                base += len(names)
            sizes = [len(ids) for ids, *_ in numbered]
            found = runs_of(np.concatenate([ids for ids, *_ in numbered]), sizes, least)
            kept = []
            for runs, (ids, names, first) in zip(found, numbered, strict=True):
                change = np.zeros(len(ids) + 1, np.int64)
                for start, length, period in runs:
                    change[start + period] += 1
                    change[start + length] -= 1
                ids = ids[np.cumsum(change[:-1]) == 0] - first
                kept.append(b" ".join(map(names.__getitem__, ids.tolist())))
            spans = pa.array([[dict(zip(("start", "length", "period"), r, strict=True)) for r in runs] for runs in found], pa.list_(triple))
            cols = [pa.array([i for i, _ in group], pa.int64()), pa.array(sizes, pa.int64()), spans, pa.array(kept, pa.binary())]
            yield pa.RecordBatch.from_arrays(cols, names=["doc_id", "n_words", "runs", "collapsed"])

    done = rows.mapInArrow(run, "doc_id long, n_words long, runs array<struct<start:long,length:long,period:long>>, collapsed binary")
    return done.withColumn("collapsed", F.col("collapsed").cast("string"))


def with_planted_runs(docs: DataFrame) -> DataFrame:
    """doc_id and text of docs; one text in ten by its id's hash repeats a stretch of its words up to its end."""
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    words, n = word_array(F.col("text")), F.size("_words")
    g = F.floor(h / 10)
    start = g % n
    period = 1 + F.floor((n - start) / (3 + g % 8))
    place = lambda i: F.when(i < start, i).otherwise(start + (i - start) % period)
    again = F.array_join(F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.get("_words", place(i).cast("int"))), " ")
    rows = docs.select("doc_id", "text", F.when(h % 10 == 0, words).alias("_words"))
    return rows.select("doc_id", F.when(n > 0, again).otherwise(F.col("text")).alias("text"))


def run_digests(found: DataFrame) -> DataFrame:
    """What op11 returns, from the rows of periodic_runs."""
    line = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r.start, r.length, r.period), F.lit("\n")))
    best = F.array_max(F.transform("runs", lambda r: F.struct(r.length.alias("length"), (-r.start).alias("s"), (-r.period).alias("p"))))
    sha: dict[str, Column] = {"runs_sha256": F.array_join(line, ""), "collapsed_sha256": F.col("collapsed")}
    rows = found.select("doc_id", F.size("runs").cast("long").alias("n_runs"), best.alias("_best"), *(F.sha2(c.cast("binary"), 256).alias(k) for k, c in sha.items()))
    period = -F.col("_best.p")
    return rows.select(
        "doc_id", "n_runs", (-F.col("_best.s")).alias("start"), F.col("_best.length"), period.alias("period"),
        F.floor(1000 * F.col("_best.length") / period).alias("exponent_milli"), "runs_sha256", "collapsed_sha256",
    )


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return run_digests(periodic_runs(with_planted_runs(table(spark, sf_dir, "documents"))))
