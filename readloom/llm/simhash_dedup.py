"""SimHash near-duplicates by multi-index hashing (operator 9).

Each fingerprint is cut into 32-bit segments. Fingerprints within `radius` differing bits have a segment that
differs in at most radius // segments bits, so a table holds every segment exactly and each fingerprint also asks
for the one-bit neighbours of its segments; only the side whose bit is 0 asks, as one question per pair is enough.
Matches meet by an equi-join on the segment value, and the complete distance decides.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from readloom.llm.common import give_back, materialize, parts, places, ship, spare, table
from readloom.llm.components import connected_components
from readloom.llm.verify import jaccard_links

#: Rows of one segment value that a task compares by itself; larger groups have finer keys, and what is still larger is
#: cut into pairs of blocks.
BLOCK = 4096
SEGMENT_BITS = 32


def word_shingles(data: bytes, size: int) -> list[bytes]:
    """Space-joined shingles of `size` lower-cased words, repeats included; fewer words give the whole sequence."""
    words = data.lower().split()
    if len(words) <= size:
        return [b" ".join(words)] if words else []
    text = b" ".join(words)
    lens = np.fromiter(map(len, words), np.int64, len(words)) + 1
    ends = np.cumsum(lens) - 1
    starts = (ends - lens + 1)[: len(words) - size + 1].tolist()
    return [text[a:b] for a, b in zip(starts, ends[size - 1 :].tolist(), strict=True)]


def fingerprint(features: list[bytes], words: int = 1, seed: int = 42) -> np.ndarray:
    """SimHash of 64 * words bits as unsigned longs: a bit is 1 if over half of the features have it; none: zero."""
    out = np.zeros(words, np.uint64)
    for w in range(words if features else 0):
        ones = np.zeros(64, np.int64)
        for at in range(0, len(features), 65536):
            part = features[at : at + 65536]
            h = np.fromiter((xxhash.xxh64_intdigest(x, seed + w) for x in part), "<u8", len(part))
            ones += np.unpackbits(h.view(np.uint8), bitorder="little").reshape(-1, 64).sum(0, dtype=np.int64)
        out[w] = np.packbits(2 * ones > len(features), bitorder="little").view("<u8")[0]
    return out


def simhash(docs: DataFrame, text: str = "text", shingle: int = 3, out: str = "fp") -> DataFrame:
    """docs with a 64-bit fingerprint column `out` (long) over word shingles in place of the text."""
    ship(docs.sparkSession)
    keep = [c for c in docs.columns if c not in (text, out)]
    names = places(docs.select(*keep), [])
    schema = T.StructType([T.StructField(n, docs.schema[c].dataType) for n, c in zip(names, keep, strict=True)]).add("made", "long")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fps = np.array([fingerprint(word_shingles(t.as_py() or b"", shingle))[0] for t in b.column(len(keep))], "<u8")
            yield pa.RecordBatch.from_arrays([*b.columns[: len(keep)], pa.array(fps.view(np.int64))], names=[*names, "made"])

    return docs.select(*keep, F.col(text).cast("binary")).toDF(*names, "made").mapInArrow(run, schema).toDF(*keep, out)


def _probes(widths: list[str]):
    """Rows (key, asks, node, fingerprint words): table entries and one-bit questions of every segment."""
    per_word = 64 // SEGMENT_BITS

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            node = b.column(0).to_numpy()
            fp = [b.column(i + 1).to_numpy().view(np.uint64) for i in range(len(widths))]
            for seg in range(per_word * len(widths)):
                value = (fp[seg // per_word] >> np.uint64(SEGMENT_BITS * (seg % per_word))) & np.uint64(0xFFFFFFFF)
                rows, keys, asks = [np.arange(len(node))], [value], [np.zeros(len(node), bool)]
                for bit in range(SEGMENT_BITS):
                    flip = np.uint64(1 << bit)
                    at = np.flatnonzero((value & flip) == 0)
                    rows.append(at)
                    keys.append(value[at] | flip)
                    asks.append(np.ones(len(at), bool))
                at, key = np.concatenate(rows), np.concatenate(keys) | np.uint64(seg << 32)
                cols = [key.view(np.int64), np.concatenate(asks), node[at], *(x[at].view(np.int64) for x in fp)]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in cols], names=["key", "asks", "node", *widths])

    return run


def _forest(group: np.ndarray, asks: np.ndarray, node: np.ndarray, fp: list[np.ndarray], radius: int):
    """Spanning links of each run of equal `group` values: rows at complete distance <= radius, one side a table row."""
    n = len(group)
    parent, found = np.arange(n), []
    left = np.arange(n - 1)
    for gap in range(1, n):
        left = left[left + gap < n]
        left = left[group[left] == group[left + gap]]
        if not len(left):
            break
        right = left + gap
        ok = ~(asks[left] & asks[right]) & (parent[left] != parent[right])
        a, b = left[ok], right[ok]
        if not len(a):
            continue
        far = np.zeros(len(a), np.int64)
        for x in fp:
            far += np.bitwise_count(x[a] ^ x[b])
        a, b = a[far <= radius], b[far <= radius]
        for i, j in zip(a.tolist(), b.tolist(), strict=True):
            while parent[i] != i:
                i = parent[i]
            while parent[j] != j:
                j = parent[j]
            if i != j:
                parent[max(i, j)] = min(i, j)
                found.append((i, j))
        while len(a) and (parent != parent[parent]).any():
            parent = parent[parent]
    if not found:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    i, j = np.array(found).T
    return node[i], node[j]


def _link_runs(widths: list[str], radius: int, block: int):
    """Link rows of equal key in a stream sorted by key; runs longer than `block` leave as they are, marked hot."""
    names = ["key", "asks", "node", *widths]

    def emit(hot: bool, key, asks, node, fp, a=None, b=None) -> pa.RecordBatch:
        n = len(key) if hot else len(a)
        none = pa.nulls(n, pa.int64())
        cols = [key, asks, node, *fp] if hot else []
        arrays = [pa.array(c) for c in cols] if hot else [none, pa.nulls(n, pa.bool_()), *[none] * (1 + len(widths))]
        ends = [none, none] if hot else [pa.array(a), pa.array(b)]
        return pa.RecordBatch.from_arrays([*arrays, *ends], names=[*names, "a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        carry: list[np.ndarray] | None = None
        hot_key = None

        def settle(cols: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
            if len(cols[0]) > 1:
                fp = [c.view(np.uint64) for c in cols[3:]]
                a, b = _forest(cols[0], cols[1], cols[2], fp, radius)
                if len(a):
                    yield emit(False, None, None, None, None, a, b)

        for batch in batches:
            cols = [batch.column(i).to_numpy(zero_copy_only=False) for i in range(len(names))]
            if carry is not None:
                cols = [np.concatenate(x) for x in zip(carry, cols, strict=True)]
            if not len(cols[0]):
                continue
            starts = np.flatnonzero(np.r_[True, cols[0][1:] != cols[0][:-1]])
            sizes = np.diff(np.r_[starts, len(cols[0])])
            last = starts[-1]
            big = (sizes > block) | (cols[0][starts] == hot_key if hot_key is not None else False)
            large = np.repeat(big, sizes)
            if big.any():
                hot = [c[large] for c in cols]
                yield emit(True, hot[0], hot[1], hot[2], hot[3:])
            hot_key = cols[0][last] if big[-1] else None
            done = ~large
            done[last:] = False
            yield from settle([c[done] for c in cols])
            carry = None if big[-1] else [c[last:] for c in cols]
        if carry is not None:
            yield from settle(carry)

    return run


def _finer(hot: DataFrame, width: str, radius: int) -> DataFrame:
    """Rows of large segment groups under finer keys: the segment's key with each of radius + 1 pieces of the other
    segment of the 64-bit fingerprint.

    Two rows within `radius` bits differ by no more in the other segment, so one of its pieces is equal: no link is
    lost, for radius + 1 rows each. Fingerprints are distinct, so a group that stays large after this is spread over the
    remaining bits, of which few lie close together.
    """
    size = min(16, SEGMENT_BITS // (radius + 1))
    first = F.shiftrightunsigned("key", SEGMENT_BITS) == 0
    other = F.when(first, F.shiftrightunsigned(width, SEGMENT_BITS)).otherwise(F.col(width))
    pieces = [
        F.shiftrightunsigned(other, size * k).bitwiseAND(F.lit((1 << size) - 1)).cast("long") * F.lit(1 << 40) + F.lit(k << 36)
        for k in range(radius + 1)
    ]
    return hot.withColumn("_piece", F.explode(F.array(*pieces))).withColumn("key", F.col("key") + F.col("_piece")).drop("_piece")


def _dealt_blocks(hot: DataFrame, block: int) -> DataFrame:
    """Rows of groups dealt to blocks, a copy for each pair of blocks (lo, hi); groups without a table row are out."""
    sizes = hot.groupBy("key").agg(F.ceil(F.count("*") / block).cast("int").alias("blocks"), F.count("*").alias("_n"), F.bool_and("asks").alias("_ask"))
    sizes = sizes.filter("_n > 1 and not _ask").drop("_n", "_ask")
    mine = F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")
    dealt = hot.join(sizes, "key").withColumn("i", mine)
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other")
    return dealt.select("*", other).withColumn("lo", F.least("i", "other")).withColumn("hi", F.greatest("i", "other"))


def _hot_links(hot: DataFrame, widths: list[str], radius: int, block: int) -> DataFrame:
    """Links of the large groups: rows dealt to blocks, every pair of blocks compared in a task of its own."""
    dealt = _dealt_blocks(hot, block)

    def run(t: pa.Table) -> pa.Table:
        asks, node = t["asks"].to_numpy(), t["node"].to_numpy()
        fp = [t[w].to_numpy().view(np.uint64) for w in widths]
        a, b = _forest(np.zeros(len(node), np.int8), asks, node, fp, radius)
        return pa.table({"a": a, "b": b})

    return dealt.select("key", "lo", "hi", "asks", "node", *widths).groupBy("key", "lo", "hi").applyInArrow(run, "a long, b long")


def hamming_links(fps: DataFrame, widths: list[str], radius: int, block: int = BLOCK) -> DataFrame:
    """Spanning links (a, b) between nodes of `fps` (node long, one long per 64 bits) within `radius` differing bits.

    Distinct nodes expected. All pairs are found whose distance is at most radius and that have a 32-bit segment with
    at most one differing bit: with radius < 2 * segments, that is every pair. Pairs already joined within one
    segment value are not emitted, so rows stay linear in the nodes while components are those of all the links.
    """
    fields = ", ".join(f"{w} long" for w in widths)
    probes = fps.select("node", *widths).mapInArrow(_probes(widths), f"key long, asks boolean, node long, {fields}")
    return _links_by_key(probes, widths, radius, block, segments=len(widths) == 1 and radius <= 3)


def _links_by_key(probes: DataFrame, widths: list[str], radius: int, block: int, segments: bool = False) -> DataFrame:
    """Spanning links (a, b) of the nodes that share a key, are not both asking, and lie within `radius` bits.

    segments: keys are those of a 64-bit fingerprint's two segments, whose large groups have finer keys."""
    fields = ", ".join(f"{w} long" for w in widths)
    dealt = probes.repartition(parts(probes.sparkSession), "key").sortWithinPartitions("key", "asks")
    out = f"key long, asks boolean, node long, {fields}, a long, b long"
    linked = materialize(dealt.mapInArrow(_link_runs(widths, radius, block), out), "hamming")
    hot = linked.filter("key is not null").select("key", "asks", "node", *widths)
    if segments:
        hot = _finer(hot, widths[0], radius)
    return linked.filter("key is null").select("a", "b").union(_hot_links(hot, widths, radius, block))


def near_duplicates(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", shingle: int = 3, radius: int = 3) -> DataFrame:
    """One row per row of docs: doc_id, fingerprint (16 hex digits), component_id (smallest doc_id reachable by links).

    Null or blank texts have fingerprint zero and are linked like any other. Rows with a null doc_id take part; their
    component's id is its smallest known doc_id, null if it has none. Repeated rows stay. Other columns are ignored.
    Radius at most 3 (two segments of 32 bits). Empty input gives an empty result.
    """
    if not 0 <= radius <= 3:
        raise ValueError("radius: 0 to 3, as a 64-bit fingerprint has two 32-bit segments")
    fps = materialize(simhash(docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("_t")), "_t", shingle), "simhash")
    classes = fps.groupBy("fp").agg(F.min("doc_id").alias("first_id"))
    nodes = classes.select(F.col("fp").alias("node"), "fp")
    roots = connected_components(hamming_links(nodes, ["fp"], radius))
    labelled = classes.join(roots, classes.fp == roots.node, "left")
    root = F.coalesce("component", "fp").alias("root")
    labelled = labelled.select("fp", "first_id", root)
    ids = labelled.groupBy("root").agg(F.min("first_id").alias("component_id"))
    named = labelled.join(ids, "root").select(F.col("fp").alias("_fp"), "component_id")
    digits = F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint")
    return fps.join(named, fps.fp == named._fp, "left").select("doc_id", digits, "component_id")


def shingle_print(grams: np.ndarray, words: int) -> np.ndarray:
    """SimHash of 64 * words bits of distinct shingle hashes; none: zero."""
    out = np.zeros(words, np.uint64)
    for w in range(words if len(grams) else 0):
        h = grams + np.uint64((w + 1) * 0x9E3779B97F4A7C15 & (1 << 64) - 1)
        h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        h ^= h >> np.uint64(31)
        ones = np.zeros(64, np.int64)
        for at in range(0, len(h), 65536):
            part = h[at : at + 65536]
            ones += np.unpackbits(part.view(np.uint8), bitorder="little").reshape(-1, 64).sum(0, dtype=np.int64)
        out[w] = np.packbits(2 * ones > len(grams), bitorder="little").view("<u8")[0]
    return out


def rare_prefix(grams: np.ndarray, levels: np.ndarray, similarity: float) -> np.ndarray:
    """The rarest shingles of a set, so many that two sets of Jaccard similarity >= `similarity` share one of them.

    Such sets share at least similarity * n of n shingles, so not all of the first n - ceil(similarity * n) + 1 in an
    order common to all sets can be missing from the other's. The order is (level of the shingle's slot, hash): any
    levels are right, those of true frequencies keep common shingles out.
    """
    count = len(grams) - math.ceil(similarity * len(grams) - 1e-9) + 1
    return grams[np.lexsort((grams, levels[grams >> np.uint64(64 - SLOT_BITS)]))[:count]]


def _slot_counts():
    """Rows (part, counts): how many texts of a task have a shingle in each slot of the part, packed."""
    from readloom.llm.paragraph_dedup import WordHashes, shingle_hashes

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        give_back()
        words, counts = WordHashes(), np.zeros(1 << SLOT_BITS, "<i8")
        for b in batches:
            for t in b.column(0):
                split = (t.as_py() or b"").lower().split()
                if split:
                    slots = np.unique(shingle_hashes([split], words)[0]) >> np.uint64(64 - SLOT_BITS)
                    np.add.at(counts, slots.astype(np.int64), 1)
        for part, some in enumerate(counts.reshape(SLOT_PARTS, -1)):
            if some.any():
                cols = [pa.array([part], pa.int32()), pa.array([zlib.compress(some.tobytes(), 1)])]
                yield pa.RecordBatch.from_arrays(cols, names=["part", "counts"])

    return run


def _summed_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = np.zeros((1 << SLOT_BITS) // SLOT_PARTS, "<i8")
    for b in batches:
        part = b.column("part")[:1]
        for c in b.column("counts"):
            total += np.frombuffer(zlib.decompress(c.as_py()), "<i8")
    yield pa.RecordBatch.from_arrays([part, pa.array([zlib.compress(total.tobytes(), 1)])], names=["part", "counts"])


def slot_levels(texts: DataFrame) -> np.ndarray:
    """Binary logarithm of each slot's count over one binary column of texts. A part's packed counts, a row a task, are
    added up batch by batch; the driver gets a row a part."""
    counts = texts.mapInArrow(_slot_counts(), "part int, counts binary")
    counts = counts.groupBy("part").applyInArrow(_summed_counts, "part int, counts binary")
    out = np.zeros((SLOT_PARTS, (1 << SLOT_BITS) // SLOT_PARTS), np.uint8)
    for part, packed in counts.collect():
        out[part] = np.frexp(np.frombuffer(zlib.decompress(packed), "<i8"))[1]
    return out.ravel()


def _shingle_prints(names: list[str], words: int, levels: bytes, similarity: float):
    """Rows (_rid, doc_id, name, keys, fingerprint words): names for equal word sequences, keys the rare prefix."""
    from readloom.llm.paragraph_dedup import WordHashes, shingle_hashes

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        give_back()
        hashes, level = WordHashes(), np.frombuffer(levels, np.uint8)
        for b in batches:
            prints, name, keys = [], [], []
            for t in b.column(2):
                split = (t.as_py() or b"").lower().split()
                name.append(xxhash.xxh64_intdigest(b" ".join(split)))
                grams = np.unique(shingle_hashes([split], hashes)[0]) if split else np.empty(0, np.uint64)
                prints.append(shingle_print(grams, words))
                keys.append(rare_prefix(grams, level, similarity).view(np.int64) if split else grams.view(np.int64))
            cols = np.array(prints, np.uint64).reshape(-1, words).view(np.int64)
            arrays = [pa.array(np.array(name, np.uint64).view(np.int64)), pa.array(keys, pa.list_(pa.int64()))]
            arrays += [pa.array(np.ascontiguousarray(cols[:, w])) for w in range(words)]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), *arrays], names=["_rid", "doc_id", "name", "keys", *names])

    return run


def _document_grams(wanted: bytes):
    """Rows (name, grams): distinct five-word shingles of the texts that pass the filter."""
    from readloom.llm.paragraph_dedup import FILTER_BITS, WordHashes, shingle_hashes

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        give_back()
        words, bits = WordHashes(), np.unpackbits(np.frombuffer(wanted, np.uint8), bitorder="little")
        for b in batches:
            names, grams = [], []
            for t in b.column(0):
                split = (t.as_py() or b"").lower().split()
                name = xxhash.xxh64_intdigest(b" ".join(split))
                if bits[name & (FILTER_BITS - 1)]:
                    names.append(name)
                    grams.append(np.unique(shingle_hashes([split], words)[0]).tobytes())
            if names:
                yield pa.RecordBatch.from_arrays([pa.array(np.array(names, np.uint64).view(np.int64)), pa.array(grams, pa.binary())], names=["name", "grams"])

    return run


#: For whole documents at a shingle similarity: words of the fingerprint of distinct shingles, and the complete distance
#: up to which two texts with a common rare shingle are compared exactly. Pairs of similarity 0.8 differ by 15 % of the
#: bits (29 of 192, 36 for the shortest texts), with a standard deviation of 5; unrelated ones by half.
PRINT_WORDS, PRINT_RADIUS = 3, 64
#: Shingles are counted by their hash's first bits, in a table of fixed size that decides their order alone.
SLOT_BITS = 20
#: The table's parts, which travel packed.
SLOT_PARTS = 256


def one_of_each(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", similarity: float = 0.8) -> DataFrame:
    """docs without near-duplicates: of each group the row of the smallest doc_id stays, nulls last.

    Candidates share one of their rarest five-word shingles, so many of each text that every pair of the wanted
    similarity does (a prefix filter), and have 192-bit SimHashes over those shingles within PRINT_RADIUS bits; a pair is
    a link if the Jaccard similarity of the shingles is at least `similarity`, computed exactly inside every candidate
    cluster; groups are the components of the links. Texts with equal words are one; so are all texts without words.
    """
    from readloom.llm.paragraph_dedup import name_filter

    spark = docs.sparkSession
    ship(spark)
    rid = spare("_rid", *docs.columns)
    rows = materialize(docs.withColumn(rid, F.monotonically_increasing_id()), "rows")
    widths = [f"w{i}" for i in range(PRINT_WORDS)]
    raw = F.col(text).cast("binary").alias("_b")
    levels = slot_levels(rows.select(raw)).tobytes()
    schema = "_rid long, doc_id long, name long, keys array<long>, " + ", ".join(f"{w} long" for w in widths)
    run = _shingle_prints(widths, PRINT_WORDS, levels, similarity)
    prints = rows.select(F.col(rid).alias("_rid"), F.col(doc_id).cast("long").alias("doc_id"), raw).mapInArrow(run, schema)
    prints = materialize(prints, "prints")
    rank = F.struct(F.col("doc_id").isNull().alias("unknown"), "doc_id", "_rid")
    nodes = prints.groupBy(F.col("name").alias("node")).agg(*(F.first(w).alias(w) for w in ("keys", *widths)), F.min(rank).alias("first"))
    nodes = materialize(nodes, "nodes")
    keyed = nodes.select(F.explode_outer("keys").alias("key"), F.lit(False).alias("asks"), "node", *widths).filter("key is not null")
    clusters = connected_components(_links_by_key(keyed, widths, PRINT_RADIUS, BLOCK))
    clusters = materialize(clusters.select(F.col("node").alias("_name"), F.col("component").alias("cluster")), "clusters")
    grams = rows.select(raw).mapInArrow(_document_grams(name_filter(clusters, "_name")), "name long, grams binary")
    grams = grams.join(clusters, F.col("name") == F.col("_name")).groupBy("cluster", F.col("name").alias("node")).agg(F.first("grams").alias("grams"))
    groups = connected_components(jaccard_links(grams, similarity, nodes=clusters))
    named = nodes.select("node", "first").join(groups.select(F.col("node").alias("_name"), "component"), F.col("node") == F.col("_name"), "left")
    named = named.select("node", "first", F.coalesce("component", "node").alias("group"))
    keepers = named.groupBy("group").agg(F.min("first").alias("keeper"))
    keepers = named.join(keepers, "group").select(F.col("node").alias("_name"), F.col("keeper._rid").alias("_keep"))
    gone = prints.join(keepers, F.col("name") == F.col("_name")).filter("_rid <> _keep").select(F.col("_rid").alias(rid))
    return rows.join(materialize(gone, "gone"), rid, "left_anti").drop(rid)


def op9_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))
