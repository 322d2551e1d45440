"""Ranked lexical search (operator 12) with Block-Max MaxScore over an inverted index in shards.

The index is a Parquet table. A shard holds some megabytes of texts: one row lists its documents and their lengths, and
one row a term holds its postings (document and frequency) in blocks of BLOCK, each compressed by itself, with the first
document, the largest frequency and the shortest length of every block beside them. These bound a block's scores
whatever the whole corpus is, so shards may be added at any time.

A search takes the whole corpus's counts from the index, sends only the query terms' rows to their shard's task, and
there takes an item's lists from the highest bound on a document's score down. Once the lists that are left could not
lift a new document to the TOP-th best score, the lists so far are the essential ones: no other document is looked at.
In the lists left over, a document whose block's bound cannot lift it enough is rejected before the block is unpacked.
The shards' best documents are merged by item, in two steps.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from readloom.llm.common import give_back, materialize, pieces, ship, table

SHARD_BYTES = 32 << 20
BLOCK = 64
TOP = 20
#: Bytes of item texts that one search takes at a time; further items go in further blocks over the same index.
ITEM_BYTES = 4 << 20
#: Postings of unpacked lists that a task keeps for its next items.
CACHED = 4_000_000
ROWS = 20_000
#: A-Z in lower case, other ASCII but digits and letters as spaces; bytes of other characters stay.
_FOLD = bytes(b if b > 127 or chr(b).isalnum() else 32 for b in range(256)).lower()
INDEX = "batch string, shard long, term binary, df int, blocks binary, postings binary, ids array<long>, lengths binary, n_docs long, n_terms long"


def terms_of(text: bytes) -> list[bytes]:
    """Maximal runs of ASCII letters and digits and other characters, A-Z lower-cased."""
    return text.translate(_FOLD).split()


def pack_numbers(v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Numbers from 0 as groups of 7 bits, lowest first, and where each begins; the top bit marks that more follow."""
    size = np.ones(len(v), np.int64)
    for k in range(1, 9):
        size += v >= 1 << 7 * k
    at = np.cumsum(size) - size
    out = np.empty(int(size.sum()), np.uint8)
    for k in range(int(size.max(initial=0))):
        has = np.flatnonzero(size > k)
        out[at[has] + k] = (v[has] >> 7 * k) & 127 | np.where(size[has] > k + 1, 128, 0)
    return out, at


def unpack_numbers(data: np.ndarray) -> np.ndarray:
    ends = np.flatnonzero(data < 128)
    starts = np.r_[0, ends[:-1] + 1]
    shift = np.arange(len(data)) - np.repeat(starts, ends - starts + 1)
    return np.add.reduceat((data & 127).astype(np.int64) << 7 * shift, starts)


class _Shard:
    """Texts gathered for one shard."""

    def __init__(self) -> None:
        self.ids: list[int | None] = []
        self.numbers: list[np.ndarray] = []
        self.known: dict[bytes, int] = {}
        self.size = 0

    def add(self, doc_id: int | None, text: bytes) -> None:
        known = self.known
        parts = [np.fromiter((known.setdefault(t, len(known)) for t in p.split()), np.int64) for p in pieces(text.translate(_FOLD), 4 << 20)]
        self.ids.append(doc_id)
        self.numbers.append(np.concatenate(parts) if parts else np.empty(0, np.int64))
        self.size += len(text)

    def rows(self, batch: str, serial: int) -> Iterator[pa.RecordBatch]:
        length = np.fromiter(map(len, self.numbers), np.int64, len(self.numbers))
        names = list(self.known)
        alphabetic = sorted(range(len(names)), key=names.__getitem__)
        place = np.empty(len(names), np.int64)
        place[alphabetic] = np.arange(len(names))
        n = max(1, len(length))
        key, tf = np.unique(place[np.concatenate(self.numbers)] * n + np.repeat(np.arange(len(length)), length), return_counts=True)
        term, doc = key // n, key % n
        schema = pa.schema([("batch", pa.string()), ("shard", pa.int64()), ("term", pa.binary()), ("df", pa.int32()), ("blocks", pa.binary()), ("postings", pa.binary()), ("ids", pa.list_(pa.int64())), ("lengths", pa.binary()), ("n_docs", pa.int64()), ("n_terms", pa.int64())])
        head = [[batch], [serial], [None], [None], [None], [None], [self.ids], [length.astype("<i8").tobytes()], [int(np.count_nonzero(length))], [int(length.sum())]]
        yield pa.RecordBatch.from_arrays([pa.array(v, f.type) for v, f in zip(head, schema, strict=True)], schema=schema)
        if not len(key):
            return
        begin = np.flatnonzero(np.r_[True, term[1:] != term[:-1]])
        df = np.diff(np.r_[begin, len(term)])
        within = np.arange(len(term)) - np.repeat(begin, df)
        opens = within % BLOCK == 0
        gap = np.where(opens, 0, doc - np.r_[0, doc[:-1]])
        data, at = pack_numbers(np.stack([gap, tf], 1).ravel())
        at, first = at[::2], np.flatnonzero(opens)
        blocks = np.stack([doc[first], at[first] - np.repeat(at[begin], df)[first], np.maximum.reduceat(tf, first), np.minimum.reduceat(length[doc], first)], 1).astype("<i8")
        ends = np.r_[at[begin], len(data)]
        block_ends = np.r_[0, np.cumsum(-(-df // BLOCK))]
        raw, words = data.tobytes(), blocks.tobytes()
        for lo in range(0, len(begin), ROWS):
            hi = min(len(begin), lo + ROWS)
            m = hi - lo
            cols = [pa.array([batch] * m), pa.array([serial] * m, pa.int64()), pa.array([names[k] for k in alphabetic[lo:hi]], pa.binary()), pa.array(df[lo:hi], pa.int32())]
            cols += [pa.array([words[32 * a : 32 * b] for a, b in zip(block_ends[lo:hi].tolist(), block_ends[lo + 1 : hi + 1].tolist(), strict=True)], pa.binary())]
            cols += [pa.array([raw[a:b] for a, b in zip(ends[lo:hi].tolist(), ends[lo + 1 : hi + 1].tolist(), strict=True)], pa.binary())]
            cols += [pa.nulls(m, schema.field(k).type) for k in range(6, 10)]
            yield pa.RecordBatch.from_arrays(cols, schema=schema)


def build_index(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", batch: str = "", path: str | None = None, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """The index of docs, written once as Parquet: appended to `path`, where other batches may lie under other names, or
    in the shared folder. Null ids and repeated rows stay; a text longer than shard_bytes is a shard of its own."""
    ship(docs.sparkSession)
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("binary").alias("t"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        give_back()
        shard, serial = _Shard(), TaskContext.get().partitionId() << 32
        for b in batches:
            for i, t in zip(b.column(0), b.column(1), strict=True):
                value = t.as_py() or b""
                if shard.size and shard.size + len(value) > shard_bytes:
                    yield from shard.rows(batch, serial)
                    shard, serial = _Shard(), serial + 1
                shard.add(i.as_py(), value)
        if shard.ids:
            yield from shard.rows(batch, serial)

    made = rows.mapInArrow(run, INDEX)
    if path is None:
        return materialize(made, "index")
    made.write.mode("append").parquet(path)
    return docs.sparkSession.read.schema(made.schema).parquet(path)


def impact(tf: np.ndarray, m: np.ndarray) -> np.ndarray:
    return 1_000_000_000 * tf // (1000 * tf + 12 * m)


class _List:
    """The postings of one term in a shard."""

    def __init__(self, blocks: bytes, postings: bytes, df: int, norm: dict[int, int]) -> None:
        self.first, self.at, tf, least = np.frombuffer(blocks, "<i8").reshape(-1, 4).T
        self.data, self.df = np.frombuffer(postings, np.uint8), df
        self.tops = impact(tf, np.fromiter(map(norm.__getitem__, least.tolist()), np.int64, len(least)))
        self.top = int(self.tops.max())

    def unpack(self, blocks: np.ndarray | None, m: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Documents and their impacts in the given blocks (ascending), or all."""
        if blocks is None or len(blocks) == len(self.first):
            blocks, data = np.arange(len(self.first)), self.data
        else:
            ends = np.r_[self.at[1:], len(self.data)]
            data = np.concatenate([self.data[a:b] for a, b in zip(self.at[blocks].tolist(), ends[blocks].tolist(), strict=True)])
        pairs = unpack_numbers(data).reshape(-1, 2)
        count = np.minimum(BLOCK, self.df - blocks * BLOCK)
        begin = np.cumsum(count) - count
        steps = np.cumsum(pairs[:, 0])
        docs = steps + np.repeat(self.first[blocks] - steps[begin], count)
        return docs, impact(pairs[:, 1], m[docs])


def _least_of_best(scores: np.ndarray, top: int) -> int:
    """The top-th highest score; 1 where there are fewer, as a score is to be above 0."""
    return max(1, int(np.partition(scores, len(scores) - top)[len(scores) - top])) if len(scores) >= top else 1


class _Searcher:
    """Finds items' best documents in one shard."""

    def __init__(self, lists: dict[bytes, _List], m: np.ndarray, weights: dict[bytes, int], top: int) -> None:
        self.lists, self.m, self.weights, self.top = lists, m, weights, top
        self.total = np.zeros(len(m), np.int64)
        self.cache: dict[bytes, tuple[np.ndarray, np.ndarray]] = {}
        self.room = CACHED

    def whole(self, term: bytes) -> tuple[np.ndarray, np.ndarray]:
        if term not in self.cache:
            found = self.lists[term].unpack(None, self.m)
            if self.room < len(found[0]):
                return found
            self.room -= len(found[0])
            self.cache[term] = found
        return self.cache[term]

    def best(self, terms: list[tuple[bytes, int]]) -> tuple[np.ndarray, np.ndarray]:
        """(documents, scores) with score above 0 that can be among the best, for terms with their repeats."""
        work = [(self.weights[t] * n * self.lists[t].top, self.weights[t] * n, t) for t, n in terms if t in self.lists and self.weights[t]]
        work.sort(key=lambda x: (-x[0], x[2]))
        rest = [0] * (len(work) + 1)
        for k in range(len(work) - 1, -1, -1):
            rest[k] = rest[k + 1] + work[k][0]
        total, seen, needed, k = self.total, np.empty(0, np.int64), 1, 0
        while k < len(work) and rest[k] >= needed:
            docs, gains = self.whole(work[k][2])
            seen = np.union1d(seen, docs) if k else docs
            total[docs] += work[k][1] * gains
            needed = _least_of_best(total[seen], self.top)
            k += 1
        scores = total[seen]
        total[seen] = 0
        for j in range(k, len(work)):
            able = scores + rest[j] >= needed
            seen, scores = seen[able], scores[able]
            _, weight, term = work[j]
            part = self.lists[term]
            block = np.searchsorted(part.first, seen, side="right") - 1
            bound = np.where(block < 0, 0, weight * part.tops[block])
            able = scores + bound + rest[j + 1] >= needed
            seen, scores, block = seen[able], scores[able], block[able]
            wanted = np.unique(block[block >= 0])
            if len(wanted):
                docs, gains = self.cache[term] if term in self.cache else part.unpack(wanted, self.m)
                at = np.minimum(np.searchsorted(docs, seen), len(docs) - 1)
                scores = scores + np.where(docs[at] == seen, weight * gains[at], 0)
            needed = max(needed, _least_of_best(scores, self.top))
        return seen[scores >= needed], scores[scores >= needed]


def _found_in(items: list[list[tuple[bytes, int]]], weights: dict[bytes, int], n_docs: int, n_terms: int, top: int):
    """One shard's rows -> (shard, item, doc_id, score) of each item's best documents there."""

    def run(t: pa.Table) -> pa.Table:
        rows = t.to_pylist()
        head = next(r for r in rows if r["term"] is None)
        length = np.frombuffer(head["lengths"], "<i8")
        lengths, place = np.unique(length, return_inverse=True)
        norm = {n: 75 + 25 * n * n_docs // n_terms for n in lengths.tolist()}
        m = np.fromiter(norm.values(), np.int64, len(norm))[place]
        lists = {r["term"]: _List(r["blocks"], r["postings"], r["df"], norm) for r in rows if r["term"] is not None}
        searcher, out = _Searcher(lists, m, weights, top), []
        for k, terms in enumerate(items):
            docs, scores = searcher.best(terms)
            found = [(k, head["ids"][d], s) for d, s in zip(docs.tolist(), scores.tolist(), strict=True)]
            found.sort(key=lambda x: (-x[2], x[1] is None, x[1] or 0))
            out += found[:top]
        cols = [[head["shard"]] * len(out), [x[0] for x in out], [x[1] for x in out], [x[2] for x in out]]
        return pa.table({n: pa.array(c, pa.int64()) for n, c in zip(("shard", "item", "doc_id", "score"), cols, strict=True)})

    return run


def search(index: DataFrame, items: DataFrame, text: str = "text", item_id: str = "item_id", top: int = TOP, item_bytes: int = ITEM_BYTES) -> DataFrame:
    """(item_id, rank, doc_id, score): each item's `top` documents of the index with the highest scores above 0.

    Equal scores go by doc_id, null ids last; documents that repeat an id stand each for itself, items too. Null and
    blank items and documents have no terms and find nothing. Other columns are ignored. Items of `item_bytes` of text
    are searched at a time, all of them against the whole index.
    """
    spark = index.sparkSession
    ship(spark)
    n_docs, n_terms = index.filter("term is null").agg(F.sum("n_docs"), F.sum("n_terms")).first()
    wanted = items.select(F.col(item_id).alias("item_id"), F.col(text).alias("t"))
    size = wanted.agg(F.sum(F.octet_length("t"))).first()[0] or 0
    blocks, found = max(1, -(-size // item_bytes)), None
    for k in range(blocks):
        part = _search_block(index, wanted.filter(F.pmod(F.xxhash64("item_id", "t"), F.lit(blocks)) == k), n_docs or 0, n_terms or 0, top)
        found = part if found is None else found.union(part)
    return found


def _search_block(index: DataFrame, wanted: DataFrame, n_docs: int, n_terms: int, top: int) -> DataFrame:
    spark = index.sparkSession
    rows = wanted.collect()
    items = [list(Counter(terms_of((r.t or "").encode())).items()) for r in rows]
    terms = spark.createDataFrame([(t,) for t in {t for x in items for t, _ in x}], "term binary")
    posted = index.filter("term is not null").join(F.broadcast(terms), "term", "left_semi")
    df = {bytes(r.term): r.df for r in posted.groupBy("term").agg(F.sum("df").alias("df")).collect()}
    weights = {t: math.floor(1000 * math.log((2 * n_docs + 2) / (2 * n + 1))) for t, n in df.items()}
    known = [[(t, n) for t, n in x if t in weights] for x in items]
    columns = ("batch", "shard", "term", "df", "blocks", "postings", "ids", "lengths")
    shards = posted.select(*columns).union(index.filter("term is null").select(*columns)).groupBy("batch", "shard")
    found = shards.applyInArrow(_found_in(known, weights, n_docs, n_terms, top), "shard long, item long, doc_id long, score long")
    order = [F.desc("score"), F.col("doc_id").asc_nulls_last()]
    some = Window.partitionBy("item", F.pmod("shard", F.lit(64))).orderBy(*order)
    found = found.withColumn("r", F.row_number().over(some)).filter(F.col("r") <= top)
    found = found.withColumn("rank", F.row_number().over(Window.partitionBy("item").orderBy(*order))).filter(F.col("rank") <= top)
    names = wanted.select("item_id").schema.add("k", "long")
    ids = spark.createDataFrame([(r.item_id, k) for k, r in enumerate(rows)], names)
    return found.join(F.broadcast(ids), F.col("item") == F.col("k")).select("item_id", "rank", "doc_id", "score")


def op12_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search(build_index(table(spark, sf_dir, "documents")), table(spark, sf_dir, "benchmark"))


#: DuckDB SQL for op12_lexical_search.
OP12_SQL = r"""
with lower_ascii as (
  select 1 as kind, doc_id as id, row_number() over () as r, translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as t from documents
  union all
  select 2, item_id, row_number() over (), translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') from benchmark
), words as (
  select kind, id, r, unnest(regexp_extract_all(t, '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) as term from lower_ascii
), tf as (
  select kind, id, r, term, count(*) as tf from words group by all
), doc as (
  select r, sum(tf)::bigint as n from tf where kind = 1 group by r
), corpus as (
  select count(*) as n_docs, sum(n)::bigint as n_terms from doc
), weight as (
  select term, floor(1000 * ln((2 * n_docs + 2) / (2 * count(*) + 1)::double))::bigint as w from tf, corpus where kind = 1 group by term, n_docs
), score as (
  select i.id as item_id, i.r as item, d.id as doc_id, d.r as doc,
    sum(i.tf * w * ((1000000000 * d.tf) // (1000 * d.tf + 12 * (75 + (25 * n * n_docs) // n_terms))))::bigint as score
  from tf i join tf d on d.term = i.term and d.kind = 1 join weight on weight.term = i.term join doc on doc.r = d.r, corpus
  where i.kind = 2 group by all
), ranked as (
  select *, row_number() over (partition by item order by score desc, doc_id nulls last) as rank from score where score > 0
)
select item_id, rank::int as rank, doc_id, score from ranked where rank <= 20
"""
