"""Benchmark decontamination by SimHash of item-sized windows (operator 8), in DataFrame expressions alone.

A window has as many words as an item and is contaminated if the weighted Jaccard similarity of their word shingles
(five words, repeats counted) is at least `similarity`. A text shorter than the item is one window, compared whole.
Such a window lacks at most a fixed share of the item's shingles, so it holds one of the item's anchors, of which there
is one more than may be missing (more in a shorter text, so that texts have further anchors there): windows without an
anchor need no fingerprint. Anchors are the item's shingles that are rarest in the corpus. Around an anchor the
fingerprints of all windows come from running sums of the shingles' bits, a row a shingle. Window and item fingerprints
meet in eight 8-bit blocks, each item entered under every value within two bits, which finds every pair within
RADIUS = 23 differing bits (at similarity 0.8 about 8 are expected, and more than 23 were never seen); the complete
distance and then the exact similarity decide. The corpus is read twice, whatever the benchmark's size: items of up to
BROADCAST_SHINGLES shingles are broadcast, more meet the corpus by a shuffled join.
"""

from __future__ import annotations

from functools import reduce
from itertools import combinations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from readloom.llm.common import WORD_GAP, materialize, spare, table

SHINGLE, SIMILARITY = 5, 0.8
BLOCKS, BLOCK_BITS, NEAR = 8, 8, 2
RADIUS = BLOCKS * (NEAR + 1) - 1
#: Item shingles that are broadcast, at most.
BROADCAST_SHINGLES = 200_000
#: Texts with an anchor whose numbers are broadcast, at most.
BROADCAST_TEXTS = 500_000


def _hashes(words: str, k: int) -> str:
    """SQL of the shingle hashes of an array of words; none if there are fewer than k words."""
    gram = ", ".join(f"{words}[i + {j}]" if j else f"{words}[i]" for j in range(k))
    return f"if(size({words}) >= {k}, transform(sequence(0, size({words}) - {k}), i -> xxhash64({gram})), cast(array() as array<bigint>))"


def _lane(h: str, i: int, per: int) -> str:
    """SQL of the i-th of 64 / per counters of `per` lanes each, as one hash sets them."""
    return " + ".join(f"shiftleft(shiftrightunsigned({h}, {per * i + j}) & 1L, {64 // per * j})" for j in range(per))


def _lanes(hashes: str, per: int) -> str:
    """SQL of 64 counters, `per` to a long: how many hashes have each bit."""
    add = ", ".join(f"'c{i}', a.c{i} + {_lane('h', i, per)}" for i in range(64 // per))
    zero = ", ".join(f"'c{i}', 0L" for i in range(64 // per))
    return f"aggregate({hashes}, named_struct({zero}), (a, h) -> named_struct({add}))"


def _bits(lanes: str, total: str, per: int) -> str:
    """SQL of the fingerprint: bit b is 1 if over half of the hashes have it."""
    dot, wide = f"{lanes}." if lanes else "", 64 // per
    return " | ".join(f"if(2 * (shiftrightunsigned({dot}c{b // per}, {wide * (b % per)}) & {(1 << wide) - 1}L) > {total}, shiftleft(1L, {b}), 0L)" for b in range(64))


def _ball() -> list[int]:
    """Masks of at most NEAR of BLOCK_BITS bits."""
    return [sum(1 << b for b in c) for n in range(NEAR + 1) for c in combinations(range(BLOCK_BITS), n)]


def _item_words(text: str) -> F.Column:
    return F.array_remove(F.split(F.lower(F.coalesce(F.col(text), F.lit(""))), WORD_GAP), "")


def benchmark_items(benchmark: DataFrame, similarity: float, text: str, item_id: str) -> DataFrame:
    """Items of at least SHINGLE words: item (a number of its own), item_id, n words, m shingles, item_h (hashes) and how
    many anchors serve texts of at least m shingles (near) and shorter ones (far)."""
    df = benchmark.select(F.col(item_id).alias("item_id"), _item_words(text).alias("_w")).filter(f"size(_w) >= {SHINGLE}")
    df = df.select(F.monotonically_increasing_id().alias("item"), "item_id", F.size("_w").alias("n"), F.expr(_hashes("_w", SHINGLE)).alias("item_h"))
    count = "cast(floor(m * {!r}D + 1e-9D) as int) + 1"
    # Of m shingles, a window of as many lacks (1 - s) / (1 + s) at most, a shorter text 1 - s.
    near, far = (F.expr(count.format(x)) for x in ((1 - similarity) / (1 + similarity), 1 - similarity))
    return df.withColumn("m", F.size("item_h")).withColumns({"near": near, "far": far})


def _anchors(docs: DataFrame, items: DataFrame, hint) -> DataFrame:
    """(anchor, n, m, short_only): each item's rarest shingles in docs (_h), the first `near` for texts of any length."""
    grams = items.select("item", F.explode_outer(F.array_distinct("item_h")).alias("anchor"))
    each = docs.select(F.explode_outer("_h").alias("gram")).filter("gram is not null")
    seen = each.join(hint(grams.select("anchor").distinct()), F.col("gram") == F.col("anchor"), "left_semi").groupBy("gram").agg(F.count("*").alias("seen"))
    seen = materialize(seen, "seen")
    counted = grams.join(hint(seen), F.col("gram") == F.col("anchor"), "left").select("item", "anchor", F.coalesce("seen", F.lit(0)).alias("seen"))
    rarest = counted.groupBy("item").agg(F.array_sort(F.collect_list(F.struct("seen", "anchor"))).alias("_a"))
    held = items.join(rarest.withColumnRenamed("item", "_item"), F.col("item") == F.col("_item"))
    held = held.select("n", "m", "near", F.posexplode_outer(F.slice("_a", F.lit(1), F.col("far"))).alias("place", "_x"))
    held = held.select(F.col("_x.anchor").alias("anchor"), "n", "m", (F.col("place") >= F.col("near")).alias("short_only"))
    return held.groupBy("anchor", "n", "m").agg(F.min("short_only").alias("short_only"))


def _regions(docs: DataFrame, anchors: DataFrame, broadcast: bool) -> DataFrame:
    """Stretches of docs (rid, _h) whose every window of an item's size holds an anchor: rid, n, m, region, _first and
    _last (its first and last start of a window), _r (the shingles of its windows).

    The corpus's shingles meet the anchors, anchors close to each other make one region, and the shingles of the texts
    that have a region come with a second look at those texts alone.
    """
    # Outer explodes: the others add a filter on the array, which the optimizer would push down and evaluate again.
    each = docs.select("rid", F.size("_h").alias("size"), F.posexplode_outer("_h").alias("at", "gram"))
    met = F.expr("gram = anchor and (size < m or not short_only)")
    found = each.join(F.broadcast(anchors) if broadcast else anchors, met).select("rid", "n", "m", "at")
    by = Window.partitionBy("rid", "n").orderBy("at")
    opens = F.coalesce(F.col("at") - F.lag("at").over(by) >= F.col("m"), F.lit(True)).cast("int")
    found = found.withColumn("_o", opens).withColumn("region", F.sum("_o").over(by))
    spans = materialize(found.groupBy("rid", "n", "m", "region").agg(F.min("at").alias("lo"), F.max("at").alias("hi")), "spans")
    spans = spans.withColumn("_first", F.expr("greatest(0, lo - m + 1)"))
    few = spans.select(F.col("rid").alias("_rid")).distinct()
    few = F.broadcast(few) if few.count() <= BROADCAST_TEXTS else few
    held = docs.join(few, F.col("rid") == F.col("_rid"), "left_semi").select(F.col("rid").alias("_rid"), "_h")
    held = spans.join(held, F.col("rid") == F.col("_rid"))
    held = held.select("rid", "n", "m", "region", "hi", "_first", F.expr("slice(_h, _first + 1, hi + m - _first)").alias("_r"))
    last = F.least(F.col("hi"), F.col("_first") + F.greatest(F.size("_r") - F.col("m"), F.lit(0)))
    return held.select("rid", "n", "m", "region", "_first", last.alias("_last"), "_r")


def _windows(regions: DataFrame, per: int) -> DataFrame:
    """Fingerprint of every item-sized window, or whole shorter text, of the regions: rid, n, m, region, start, fp. A
    window's counters are the running sums at its end less those before its start, a row a shingle."""
    keys = ("rid", "n", "m", "region", "_first", "_g")
    each = regions.withColumn("_g", F.least(F.col("m"), F.size("_r"))).select(*keys, "_last", F.posexplode_outer("_r").alias("p", "h"))
    so_far = Window.partitionBy("rid", "n", "region").orderBy("p").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    counters = [f"c{i}" for i in range(64 // per)]
    each = each.select(*keys, "_last", "p", *[F.sum(F.expr(_lane("h", i, per))).over(so_far).alias(c) for i, c in enumerate(counters)])
    sides = F.explode(F.expr("array(named_struct('start', _first + p - _g + 1, 'sign', 1L), named_struct('start', _first + p + 1, 'sign', -1L))")).alias("_w")
    each = each.select("*", sides).filter("_w.start between _first and _last")
    summed = each.groupBy(*keys, F.col("_w.start").alias("start")).agg(*[F.sum(F.col("_w.sign") * F.col(c)).alias(c) for c in counters])
    return summed.select("rid", "n", "m", "region", "start", F.expr(_bits("", "_g", per)).alias("fp"))


def _matches(regions: DataFrame, items: DataFrame, similarity: float, per: int, hint) -> DataFrame:
    """Window-item pairs within RADIUS bits whose exact similarity suffices."""

    def block(fp: str, b: str) -> str:
        return f"cast(shiftrightunsigned({fp}, {BLOCK_BITS} * {b}) & {(1 << BLOCK_BITS) - 1} as int)"

    masks = F.array(*map(F.lit, _ball()))
    blocks = F.explode_outer(F.array(*map(F.lit, range(BLOCKS)))).alias("b")
    items = materialize(items.withColumn("_l", F.expr(_lanes("item_h", per))).withColumn("item_fp", F.expr(_bits("_l", "m", per))).drop("_l"), "items")
    entered = items.select("item", "n", "item_fp", blocks).withColumn("mask", F.explode_outer(masks))
    key = F.expr(f"{block('item_fp', 'b')} ^ mask").alias("_key")
    entered = entered.select("item", F.col("n").alias("_n"), "item_fp", F.col("b").alias("_b"), key)
    asked = _windows(regions, per).select("*", blocks).withColumn("key", F.expr(block("fp", "b")))
    pairs = asked.join(hint(entered), F.expr("n = _n and b = _b and key = _key"))
    # A pair that meets in several blocks counts in the first.
    earlier = " or ".join(f"(b > {i} and bit_count({block('fp', str(i))} ^ {block('item_fp', str(i))}) <= {NEAR})" for i in range(BLOCKS - 1))
    pairs = pairs.withColumn("hamming", F.expr("bit_count(fp ^ item_fp)")).filter(f"hamming <= {RADIUS} and not ({earlier})")
    pairs = pairs.select("rid", "n", "region", "start", "item", "hamming")
    held = regions.select(F.col("rid").alias("_rid"), F.col("n").alias("_n"), F.col("region").alias("_k"), "m", "_first", "_r")
    near = pairs.join(held, F.expr("rid = _rid and n = _n and region = _k")).join(hint(items.select("item", "item_id", "item_h")), "item")
    near = near.withColumn("win_h", F.expr("slice(_r, start - _first + 1, m)"))
    # Both sides' hashes in one order, the window's first: each of the item's takes one equal one of the window's.
    tagged = "array_sort(concat(transform(win_h, h -> named_struct('h', h, 't', 0)), transform(item_h, h -> named_struct('h', h, 't', 1))))"
    held = "named_struct('h', x.h, 'c', if(x.h <=> a.h, a.c, 0) + 1, 's', a.s)"
    taken = "if(x.h <=> a.h and a.c > 0, named_struct('h', a.h, 'c', a.c - 1, 's', a.s + 1), a)"
    shared = f"aggregate({tagged}, named_struct('h', cast(null as bigint), 'c', 0, 's', 0), (a, x) -> if(x.t = 0, {held}, {taken}), a -> a.s)"
    near = near.withColumn("_s", F.expr(shared)).withColumn("similarity", F.expr("_s / (0D + m + size(win_h) - _s)"))
    near = near.filter(F.col("similarity") >= similarity - 1e-12)
    return near.select("rid", "item_id", "start", F.expr("n - m + size(win_h)").alias("n"), "hamming", "similarity")


def _short_matches(docs: DataFrame, benchmark: DataFrame, item_text: str, item_id: str) -> DataFrame:
    """Items of fewer than SHINGLE words, found as they stand: one shingle of all their words."""
    words = benchmark.select(F.col(item_id).alias("item_id"), _item_words(item_text).alias("_w")).filter(f"size(_w) between 1 and {SHINGLE - 1}")
    known = words.select("item_id", F.size("_w").alias("n"), F.array_join("_w", " ").alias("_item"))
    gram = lambda k: f"transform(if(size(_w) >= {k}, sequence(0, size(_w) - {k}), cast(array() as array<int>)), i -> named_struct('at', i, 'n', {k}, 'g', array_join(slice(_w, i + 1, {k}), ' ')))"
    each = docs.select("rid", F.explode_outer(F.expr(f"concat({', '.join(map(gram, range(1, SHINGLE)))})")).alias("_x"))
    found = each.join(known, F.expr("_x.n = n and _x.g = _item"))
    return found.select("rid", "item_id", F.col("_x.at").alias("start"), "n", F.lit(0).alias("hamming"), F.lit(1.0).alias("similarity"))


def contaminated(docs: DataFrame, benchmark: DataFrame, similarity: float = SIMILARITY, text: str = "text", doc_id: str = "doc_id", item_text: str = "text", item_id: str = "item_id", most: int = BROADCAST_SHINGLES) -> DataFrame:
    """One row for each document and benchmark item it contains: doc_id, item_id, similarity, start, n_words, hamming.

    Of several windows the most similar counts, then the first; `start` is its first word. A text with fewer shingles
    than the item is a window of its own. Words are lower-cased (all letters). Items of fewer than five words are
    compared as a single shingle of all their words; items without words and null texts match nothing. Rows of docs with
    one doc_id, null included, count as one document. most: item shingles up to which the benchmark is broadcast.
    """
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("_t"), F.monotonically_increasing_id().alias("rid"))
    rows = materialize(rows, "texts")
    found = found_items(rows, benchmark, similarity, "_t", "rid", item_text, item_id, most)
    told = rows.select("doc_id", F.col("rid").alias("_rid")).join(materialize(found, "found"), F.col("rid") == F.col("_rid"))
    best = F.max_by(F.struct("similarity", "start", F.col("n").alias("n_words"), "hamming"), F.struct("similarity", -F.col("start"))).alias("best")
    return told.groupBy("doc_id", "item_id").agg(best).select("doc_id", "item_id", "best.*")


def found_items(rows: DataFrame, benchmark: DataFrame, similarity: float, text: str, row: str, item_text: str, item_id: str, most: int) -> DataFrame:
    """(rid, item_id, start, n, hamming, similarity) of windows that contain an item; rows: written texts, numbered by
    the column `row`."""
    items = materialize(benchmark_items(benchmark, similarity, item_text, item_id), "items")
    total, longest = items.agg(F.coalesce(F.sum("m"), F.lit(0)), F.coalesce(F.max("m"), F.lit(0))).first()
    short = not benchmark.select(F.size(_item_words(item_text)).alias("n")).filter(f"n between 1 and {SHINGLE - 1}").isEmpty()
    words = rows.select(F.col(row).alias("rid"), _item_words(text).alias("_w"))
    found = []
    if total:
        hint = F.broadcast if total <= most else (lambda df: df)
        hashed = words.select("rid", F.expr(_hashes("_w", SHINGLE)).alias("_h"))
        anchors = materialize(_anchors(hashed, items, hint), "anchors")
        regions = materialize(_regions(hashed, anchors, total <= most), "regions")
        # Counters of 16 bits, or of 32 where running sums over so many shingles might overflow them.
        longest = max(longest, regions.agg(F.coalesce(F.max(F.size("_r")), F.lit(0))).first()[0])
        found.append(_matches(regions, items, similarity, 4 if longest < 1 << 15 else 2, hint))
    if short or not total:
        found.append(_short_matches(words, benchmark, item_text, item_id))
    return reduce(DataFrame.union, found)


def without_items(docs: DataFrame, benchmark: DataFrame, similarity: float = SIMILARITY, text: str = "text") -> DataFrame:
    """The rows of docs that contain no benchmark item, each judged by itself, whatever its other columns."""
    row = spare("_row", *docs.columns)
    rows = materialize(docs.withColumn(row, F.monotonically_increasing_id()), "rows")
    found = found_items(rows, benchmark, similarity, text, row, "text", "item_id", BROADCAST_SHINGLES).select(F.col("rid").alias(row)).distinct()
    return rows.join(materialize(found, "leaks"), row, "left_anti").drop(row)


def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
