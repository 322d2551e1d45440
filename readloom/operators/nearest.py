"""Exact nearest neighbours: blocks of vectors meet in tasks, a matrix product finds who may be near, distances decide.

Distances are those of SQL: the sum, place by place from the first, of the squared differences at the places that both
vectors have, up to the length of the query's; none if there is no such place. Unknown distances come last, before them
those that are no number.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from readloom.sources.staging import materialize

#: Values (rows times dimensions) of a block of points, about, and of a part of them at most; queries that are multiplied
#: with a block at once.
POINT_VALUES, PART_VALUES, ROWS = 1 << 18, 1 << 23, 512
#: Values beyond this have no part in matrix products, whose squares could overflow.
LARGEST = 1e150


def _pack(limit: int, copies: int | None):
    """Blocks (rank, tag, width, x, gaps) of rows (tag, x) with equally long vectors of at most `limit` values together.

    rank is a row's place in the frame's order. gaps marks missing elements; it is null where all are there and finite.
    copies: how many of equal vectors in a block stay, the first; with k of them no other is among the k nearest."""
    names = ["rank", "tag", "width", "x", "gaps"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        first = TaskContext.get().partitionId() << 40
        for b in batches:
            tag, lists = b.column(0), b.column(1)
            size = pc.fill_null(pc.list_value_length(lists), 0).to_numpy().astype(np.int64)
            flat = lists.flatten()
            gap = flat.is_null().to_numpy(zero_copy_only=False)
            values = pc.fill_null(flat, 0.0).to_numpy().astype("<f8")
            begin = np.cumsum(size) - size
            bad = np.concatenate([np.zeros(1, np.int64), np.cumsum(gap | ~(np.abs(values) < LARGEST))])
            odd = (bad[begin + size] > bad[begin]) | (size == 0)
            for kind in np.unique(2 * size + odd).tolist():
                width, plain = kind // 2, kind % 2 == 0
                rows = np.flatnonzero((size == width) & (odd != plain))
                step = max(1, limit // max(1, width))
                for part in (rows[at : at + step] for at in range(0, len(rows), step)):
                    at = begin[part][:, None] + np.arange(width)
                    if copies and width and len(part) > copies:
                        same = np.ascontiguousarray(np.concatenate([values[at].view("u1"), gap[at].view("u1")], axis=1)).view(f"V{9 * width}").ravel()
                        _, group = np.unique(same, return_inverse=True)
                        order = np.argsort(group, kind="stable")
                        starts = np.flatnonzero(np.diff(group[order], prepend=-1))
                        nth = np.arange(len(part)) - np.repeat(starts, np.diff(np.r_[starts, len(part)]))
                        keep = np.sort(order[nth < copies])
                        part, at = part[keep], at[keep]
                    ends = pa.array([0, len(part)], pa.int32())
                    cols = [pa.ListArray.from_arrays(ends, pa.array(first + part)), pa.ListArray.from_arrays(ends, tag.take(pa.array(part)))]
                    cols += [pa.array([width], pa.int32()), pa.array([values[at].tobytes()], pa.binary())]
                    yield pa.RecordBatch.from_arrays([*cols, pa.array([None if plain else gap[at].tobytes()], pa.binary())], names=names)
            first += b.num_rows

    return run


def _packed(rows: DataFrame, limit: int, copies: int | None) -> DataFrame:
    """Blocks of the rows (tag, x), written to the shared folder."""
    schema = f"rank array<long>, tag array<{rows.schema['tag'].dataType.simpleString()}>, width int, x binary, gaps binary"
    return materialize(rows.mapInArrow(_pack(limit, copies), schema), "vectors")


class _Block:
    """A block's vectors, and which of their elements are missing (None: no element is)."""

    def __init__(self, rank: np.ndarray, tag: pa.Array, width: int, x: bytes, gaps: bytes | None) -> None:
        self.rank, self.tag, self.width = rank, tag, width
        self.x = np.frombuffer(x, "<f8").reshape(len(rank), width)
        self.gaps = None if gaps is None else np.frombuffer(gaps, bool).reshape(len(rank), width)
        if self.gaps is None:
            self.square = np.einsum("ij,ij->i", self.x, self.x)


class _Best:
    """The k best points so far of each query of a block: by level (0 a number, 1 none, 2 unknown, 3 no point), distance
    and rank."""

    def __init__(self, asked: _Block, k: int) -> None:
        m = len(asked.rank)
        self.asked, self.k, self.tags = asked, k, []
        self.level, self.d = np.full((m, k), 3, np.int8), np.zeros((m, k))
        self.rank, self.block, self.place = (np.zeros((m, k), np.int64) for _ in range(3))

    def reach(self) -> np.ndarray:
        """The distance that a point may have at most, a query."""
        return np.where(self.level[:, -1] == 0, self.d[:, -1], np.inf)

    def add(self, held: _Block) -> None:
        self.tags.append(held.tag)
        asked = self.asked
        plain = asked.gaps is None and held.gaps is None and held.width >= asked.width
        bound = self.reach()
        if plain:
            right = np.column_stack([held.x[:, : asked.width], held.square if held.width == asked.width else (held.x[:, : asked.width] ** 2).sum(1)]).T
            left = np.column_stack([-2 * asked.x, np.ones(len(asked.x))])
            # Rounding of the product, of the squares and of the distance itself, with room to spare.
            slack = (asked.width + 8) * 2.0**-50 * (asked.square + right[-1].max())
        for at in range(0, len(asked.rank), ROWS):
            here = slice(at, min(at + ROWS, len(asked.rank)))
            if not plain:
                self._every(held, here)
                continue
            near = left[here] @ right
            most = bound[here] - asked.square[here] + slack[here]
            if np.isinf(most).any() and near.shape[1] > self.k:
                most = np.minimum(most, np.partition(near, self.k - 1, axis=1)[:, self.k - 1] + 2 * slack[here])
            q, p = np.nonzero(near <= most[:, None])
            if len(q):
                d, q = np.zeros(len(q)), q + at
                for j in range(asked.width):
                    d += (asked.x[q, j] - held.x[p, j]) ** 2
                self._merge(q, p, np.zeros(len(q), np.int8), d, held.rank)

    def _every(self, held: _Block, here: slice) -> None:
        """All distances of some queries, by their definition."""
        asked = self.asked
        x, n = asked.x[here], len(held.rank)
        d, met = np.zeros((len(x), n)), np.zeros((len(x), n), bool)
        for j in range(min(asked.width, held.width)):
            both = np.ones((len(x), n), bool)
            if asked.gaps is not None:
                both &= ~asked.gaps[here, j][:, None]
            if held.gaps is not None:
                both &= ~held.gaps[:, j][None, :]
            with np.errstate(all="ignore"):
                d += np.where(both, (x[:, j][:, None] - held.x[:, j][None, :]) ** 2, 0.0)
            met |= both
        level = np.where(met, np.isnan(d).astype(np.int8), np.int8(2))
        d[level > 0] = 0
        order = np.lexsort((np.broadcast_to(held.rank, d.shape), d, level), axis=1)[:, : self.k]
        q = np.repeat(np.arange(len(x)), order.shape[1])
        p = order.ravel()
        self._merge(q + here.start, p, level[q, p], d[q, p], held.rank)

    def _merge(self, q: np.ndarray, p: np.ndarray, level: np.ndarray, d: np.ndarray, rank: np.ndarray) -> None:
        some = np.unique(q)
        old = np.repeat(some, self.k)
        cols = [(q, old), (level, self.level[some].ravel()), (d, self.d[some].ravel()), (rank[p], self.rank[some].ravel())]
        cols += [(np.full(len(p), len(self.tags) - 1), self.block[some].ravel()), (p, self.place[some].ravel())]
        row, level, d, rank, block, place = (np.concatenate(c) for c in cols)
        order = np.lexsort((rank, d, level, row))
        starts = np.flatnonzero(np.diff(row[order], prepend=-1))
        best = order[(starts[:, None] + np.arange(self.k)).ravel()]
        for name, col in (("level", level), ("d", d), ("rank", rank), ("block", block), ("place", place)):
            getattr(self, name)[some] = col[best].reshape(-1, self.k)

    def rows(self) -> pa.RecordBatch:
        """(query, y, rank, level, d) of the best points."""
        q, c = np.nonzero(self.level < 3)
        block, place = self.block[q, c], self.place[q, c]
        begin = np.cumsum([0, *map(len, self.tags)])
        y = pa.concat_arrays(self.tags).take(pa.array(begin[block] + place))
        cols = [self.asked.tag.take(pa.array(q)), y, *(pa.array(x[q, c]) for x in (self.rank, self.level, self.d))]
        return pa.RecordBatch.from_arrays(cols, names=["query", "y", "rank", "level", "d"])


def _compare(k: int):
    names = ("rank", "tag", "width", "x", "gaps")

    def block(b: pa.RecordBatch, side: str, i: int) -> _Block:
        rank, tag, width, x, gaps = (b.column(f"{side}_{c}")[i] for c in names)
        return _Block(rank.values.to_numpy(), tag.values, width.as_py(), x.as_py(), gaps.as_py())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best, name = None, None
        for b in batches:
            for i in range(b.num_rows):
                first = b.column("q_rank")[i].values[0].as_py()
                if first != name:
                    if best is not None:
                        yield best.rows()
                    best, name = _Best(block(b, "q", i), k), first
                best.add(block(b, "p", i))
        if best is not None:
            yield best.rows()

    return run


def nearest(queries: DataFrame, points: DataFrame, k: int, query_values: int) -> DataFrame:
    """(query, y, rank, level, d): candidates that hold the k nearest points of each query by (level, d, rank).

    queries have the columns tag and x (array of doubles), points beside them `at`, whose order settles ties. Each pair
    of a part of the queries' blocks and one of the points' is a task, which compares one block of either at a time and
    leaves k rows a query."""
    cores = queries.sparkSession.sparkContext.defaultParallelism
    values = lambda df: df.agg(F.sum(F.coalesce(F.size("x"), F.lit(0)))).first()[0] or 0
    n = values(points)
    n = max(1, min(4 * cores, -(-n // POINT_VALUES)), -(-n // PART_VALUES))
    order = F.asc_nulls_last("at")
    left = _packed(queries.repartition(max(1, -(-values(queries) // query_values))), query_values, None)
    right = _packed(points.repartitionByRange(n, order).sortWithinPartitions(order).select("tag", "x"), POINT_VALUES, k)
    named = lambda df, side: df.select(*[F.col(c).alias(f"{side}_{c}") for c in df.columns])
    pairs = named(left, "q").crossJoin(named(right, "p").hint("shuffle_replicate_nl"))
    query, y = (df.schema["tag"].dataType.simpleString() for df in (queries, points))
    return pairs.mapInArrow(_compare(k), f"query {query}, y {y}, rank long, level byte, d double")
