"""Read-to-reference alignment: an equi-join of minimizers, colinear chains, base-level extension, SAM records.

Reads of equal bases align alike, so each distinct sequence is aligned once and meets its reads at the end. Spark joins
the sampled k-mers of sequences and references, gathers each sequence's anchors, and brings each chain together with its
reference's bases; the steps inside a row (sampling, chaining, extension) are small functions over Arrow batches.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from readloom.functions.sequences import reverse_complement
from readloom.sources.staging import materialize

#: References whose bases are broadcast, at most; larger sets meet the reads by shuffled joins.
BROADCAST_BASES = 8_000_000
#: Fixed values of the chaining score: bases between two anchors, and how far a gap may be off the diagonal.
MAX_GAP, BANDWIDTH = 5000, 500
#: Chains of lower score or fewer anchors do not count.
LEAST_SCORE, LEAST_ANCHORS = 40, 3
#: A chain that shares so much of the shorter's read interval with a better one is secondary to it; of these, up to
#: SECONDARY of at least SECONDARY_SHARE of the better one's score are reported.
OVERLAP, SECONDARY, SECONDARY_SHARE = 0.5, 5, 0.8
#: Score of a base and of an edit when the ends of a read are extended; the rest is clipped.
BASE_SCORE, EDIT_SCORE = 2, 5
_NONE = np.uint64((1 << 64) - 1)
_CODE = np.full(256, 4, np.uint64)
for _k, _pair in enumerate(("Aa", "Cc", "Gg", "Tt")):
    _CODE[[ord(c) for c in _pair]] = _k
#: Distinct sequences of a task that samples and chains, about.
TASK_SEQUENCES = 20_000


def minimizers(seqs: list[bytes], k: int, w: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(number a sequence, hashes, starts, reversed) of the sampled k-mers of each sequence, in order.

    Of every w neighbouring k-mers those of least hash count, of a shorter sequence those of its least; a k-mer and its
    reverse complement have one hash. k-mers with other letters than A, C, G, T and own reverse complements are left out.
    """
    size = np.fromiter(map(len, seqs), np.int64, len(seqs))
    codes = _CODE[np.frombuffer(b"".join(seqs) + b"N" * (k + w), np.uint8)]
    n = int(size.sum())
    forward, backward, odd = np.zeros(n, np.uint64), np.zeros(n, np.uint64), np.zeros(n, bool)
    for j in range(k):
        c = codes[j : n + j]
        odd |= c > 3
        forward = forward << np.uint64(2) | c & np.uint64(3)
        backward |= (np.uint64(3) - (c & np.uint64(3))) << np.uint64(2 * j)
    h = np.minimum(forward, backward) + np.uint64(1)
    for shift, factor in ((31, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        h = (h ^ (h >> np.uint64(shift))) * np.uint64(factor)
    h ^= h >> np.uint64(31)
    end = np.cumsum(size)
    last = np.repeat(end - k, size)  # last start of a k-mer in each base's sequence
    at = np.arange(n)
    h[odd | (forward == backward) | (at > last)] = _NONE
    chosen = np.zeros(n, bool)
    if n:
        least = np.lib.stride_tricks.sliding_window_view(np.r_[h, np.full(w - 1, _NONE)], w).min(1)
        least = np.where(at + w - 1 <= last, least, np.uint64(0))
        reach = np.lib.stride_tricks.sliding_window_view(np.r_[np.zeros(w - 1, np.uint64), least], w).max(1)
        chosen = (h == reach) & (h != _NONE)
        for s in np.flatnonzero((size >= k) & (size - k + 1 < w)).tolist():
            part = h[end[s] - size[s] : end[s]]
            chosen[end[s] - size[s] : end[s]] = (part == part.min()) & (part != _NONE)
    found = np.flatnonzero(chosen)
    owner = np.searchsorted(end, found, side="right")
    return np.bincount(owner, minlength=len(seqs)), h[found].view(np.int64), found - (end - size)[owner], (backward < forward)[found]


def _sampled(df: DataFrame, keys: str, k: int, w: int) -> DataFrame:
    """Rows (keys, h, at, turned) of the minimizers of the column `sequence`."""
    names = [x.split()[0] for x in keys.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            count, *found = minimizers([x.as_py() or b"" for x in b.column(len(names))], k, w)
            ends = np.r_[0, np.cumsum(count)].astype(np.int32)
            lists = [pa.ListArray.from_arrays(pa.array(ends), pa.array(x)) for x in found]
            yield pa.RecordBatch.from_arrays([*b.columns[: len(names)], *lists], names=[*names, "h", "at", "turned"])

    made = df.select(*names, F.col("sequence").cast("binary")).mapInArrow(run, f"{keys}, h array<long>, at array<long>, turned array<boolean>")
    each = made.select(*names, F.explode_outer(F.arrays_zip("h", "at", "turned")).alias("m")).filter("m is not null")
    return each.select(*names, "m.h", F.col("m.at").cast("int").alias("at"), "m.turned")


def chain_scores(x: np.ndarray, y: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Best score of a chain that ends in each anchor, and the anchor before it there (-1: none).

    Anchors are k bases from x on the reference and y on the read, in order of (x, y). A chain goes up on both; a step
    gains the bases it adds, k at most, less 0.01 k g + log2(g) / 2 for a gap of g bases. Of equal steps the nearest
    counts.
    """
    n = len(x)
    score, before, low = np.full(n, float(k)), np.full(n, -1), 0
    for i in range(1, n):
        while x[i] - x[low] > MAX_GAP:
            low += 1
        dx, dy = x[i] - x[low:i], y[i] - y[low:i]
        gap = np.abs(dx - dy)
        cost = np.where(gap > 0, 0.01 * k * gap + 0.5 * np.log2(np.maximum(gap, 1)), 0.0)
        total = score[low:i] + np.minimum(np.minimum(dx, dy), k) - cost
        total[(dx <= 0) | (dy <= 0) | (dy > MAX_GAP) | (gap > BANDWIDTH)] = -np.inf
        if len(total):
            j = len(total) - 1 - int(np.argmax(total[::-1]))
            if total[j] > k:
                score[i], before[i] = total[j], low + j
    return score, before


def best_chains(x: np.ndarray, y: np.ndarray, k: int) -> list[tuple[float, list[int]]]:
    """(score, anchors) of chains without a common anchor, the best first; a later one ends where it meets an earlier."""
    step = np.diff(x)
    if len(x) > 1 and (np.diff(y) == step).all() and (step > 0).all() and step.max() <= MAX_GAP:
        return [(float(k + np.minimum(step, k).sum()), list(range(len(x))))]  # one diagonal, no choice
    score, before = chain_scores(x, y, k)
    used, found = np.zeros(len(x), bool), []
    for i in np.lexsort((np.arange(len(x)), -score)).tolist():
        chain, at = [], i
        while at >= 0 and not used[at]:
            chain.append(at)
            used[at] = True
            at = int(before[at])
        if chain:
            found.append((float(score[i] - (score[at] if at >= 0 else 0)), chain[::-1]))
    return sorted(found, key=lambda c: -c[0])


def _ranked(anchors: list[dict], size: int, k: int) -> list[dict]:
    """Chains of one read in one species with flag (0 or 16, 256 secondary, 2048 supplementary) and mapping quality."""
    every = []
    for (ref, turned), group in groupby(sorted(anchors, key=lambda a: (a["ref_id"], a["turned"])), key=lambda a: (a["ref_id"], a["turned"])):
        pairs = sorted({(a["ref_at"], size - k - a["at"] if turned else a["at"]) for a in group})
        x, y = np.array(pairs).T
        for score, chain in best_chains(x, y, k):
            if score >= LEAST_SCORE and len(chain) >= LEAST_ANCHORS:
                start, end = int(y[chain[0]]), int(y[chain[-1]]) + k
                place = (size - end, size - start) if turned else (start, end)
                every.append({"ref_id": ref, "turned": turned, "score": score, "x": x[chain].tolist(), "y": y[chain].tolist(), "place": place})
    every.sort(key=lambda c: (-c["score"], c["ref_id"], c["turned"], c["x"][0]))
    lead: list[dict] = []
    for c in every:
        a, b = c["place"]
        c["under"] = next((p for p in lead if min(b, p["place"][1]) - max(a, p["place"][0]) >= OVERLAP * min(b - a, p["place"][1] - p["place"][0])), None)
        if c["under"] is None:
            c["second"], c["kept"] = 0.0, 0
            lead.append(c)
        else:
            c["under"]["second"] = max(c["under"]["second"], c["score"])
    out = []
    for c in every:
        best = c["under"]
        if best is None:
            kind = 0 if c is every[0] else 2048
            quality = 40 * (1 - c["second"] / c["score"]) * min(1.0, len(c["x"]) / 10) * np.log(c["score"])
        else:
            if c["score"] < SECONDARY_SHARE * best["score"] or best["kept"] >= SECONDARY:
                continue
            best["kept"] += 1
            kind, quality = 256, 0
        out.append({**{n: c[n] for n in ("ref_id", "score", "x", "y")}, "flag": kind + 16 * c["turned"], "mapq": min(60, round(float(quality)))})
    return out


def _steps(wave: dict[int, int], d: int, n: int, m: int) -> list[tuple[int, int, str]]:
    """Ways onto diagonal d by one more edit: (place in a, diagonal before, M for another base, I for a base of a alone,
    D for one of b alone)."""
    ways = [(i + 1, d, "M") for i in (wave.get(d),) if i is not None and i < n and i + d < m]
    ways += [(i + 1, d + 1, "I") for i in (wave.get(d + 1),) if i is not None and i < n]
    return ways + [(i, d - 1, "D") for i in (wave.get(d - 1),) if i is not None and i + d <= m]


def _waves(a: bytes, b: bytes) -> Iterator[dict[int, int]]:
    """For 0, 1, 2 ... edits: how much of a the best paths cover on each diagonal (place in b less place in a)."""
    n, m, edits, wave = len(a), len(b), 0, {}
    while True:
        new = {}
        for d in range(-edits, edits + 1):
            i = max((s[0] for s in _steps(wave, d, n, m)), default=-1) if edits else 0
            if i >= 0:
                while i < n and i + d < m and a[i] == b[i + d]:
                    i += 1
                new[d] = i
        yield new
        wave, edits = new, edits + 1


def _back(waves: list[dict[int, int]], d: int, i: int, n: int, m: int) -> str:
    """Operations of the path to place i of diagonal d of the last wave."""
    ops = []
    for wave in waves[-2::-1]:
        came, before, op = max(_steps(wave, d, n, m), key=lambda s: s[0])
        ops.append("M" * (i - came) + op)
        i, d = came - (op != "D"), before
    return "".join([*ops, "M" * i])[::-1]


def edit_path(a: bytes, b: bytes) -> tuple[str, int]:
    """Operations that turn all of b into all of a with the fewest edits, and their number, by growing wavefronts."""
    if not a or not b:
        return "I" * len(a) + "D" * len(b), len(a) + len(b)
    waves = []
    for wave in _waves(a, b):
        waves.append(wave)
        if wave.get(len(b) - len(a), -1) >= len(a):
            return _back(waves, len(b) - len(a), len(a), len(a), len(b)), len(waves) - 1
    raise AssertionError


def extend_path(a: bytes, b: bytes) -> tuple[str, int]:
    """Operations over the beginning of a and of b with the highest score, and their edits."""
    waves, best = [], (0, 0, 0, 0)
    for e, wave in enumerate(_waves(a, b)):
        waves.append(wave)
        d, i = max(wave.items(), key=lambda x: (x[1], -abs(x[0]))) if wave else (0, 0)
        best = max(best, (BASE_SCORE * i - EDIT_SCORE * e, -e, d, i))
        if not wave or BASE_SCORE * len(a) - EDIT_SCORE * (e + 1) <= best[0]:
            break
    _, edits, d, i = best
    return _back(waves[: 1 - edits], d, i, len(a), len(b)), -edits


def cigar_of(read: bytes, ref: bytes, x: list[int], y: list[int], k: int) -> tuple[int, int, str, int]:
    """(start and end on the reference, CIGAR, edits) of a read along the anchors of a chain.

    Between anchors the fewest edits are taken, at the ends the extension of highest score; what is left is clipped.
    """
    head, edits = extend_path(read[: y[0]][::-1], ref[max(0, x[0] - 2 * y[0] - 10) : x[0]][::-1])
    ops = [head[::-1], "M" * k]
    ref_end, read_end = x[0] + k, y[0] + k
    for to_x, to_y in zip(x[1:], y[1:], strict=True):
        inside = max(0, read_end - to_y, ref_end - to_x)  # of the next anchor, what the path has passed
        path, n = edit_path(read[read_end : to_y + inside], ref[ref_end : to_x + inside])
        ops += [path, "M" * (k - inside)]
        edits, read_end, ref_end = edits + n, to_y + k, to_x + k
    tail, n = extend_path(read[read_end:], ref[ref_end : ref_end + 2 * (len(read) - read_end) + 10])
    ops.append(tail)
    path = "".join(ops)
    before = y[0] - sum(c != "D" for c in head)
    after = len(read) - before - sum(c != "D" for c in path)
    start = x[0] - sum(c != "I" for c in head)
    parts = [(before, "S"), *((len(list(g)), c) for c, g in groupby(path)), (after, "S")]
    return start, start + sum(c != "I" for c in path), "".join(f"{c}{op}" for c, op in parts if c), edits + n


def align(reads: DataFrame, references: DataFrame, k: int = 28, w: int = 10, bases: bool = False) -> DataFrame:
    """Alignment records of reads (id, read_idx, barcode, sequence; together they name a read once) in each species.

    references: species, ref_id, sequence; species are searched each by itself. Columns: id, read_idx, barcode, species,
    ref_id, flag, pos (from 0), ref_end, mapq, score, n_anchors, cigar and nm (edits); with `bases` also sequence and,
    if reads have it, quality. flag 16: the read's reverse complement aligns; 256: secondary, of quality 0; 2048:
    supplementary, another part of the read. mapq is 40 (1 - second / best) min(1, anchors / 10) ln best, at most 60, by
    chaining scores, the second best being the best chain over the same part of the read. Null sequences and reads
    without a chain do not appear. A task holds one read's anchors and one reference's bases at a time.
    """
    if not 4 <= k <= 31:
        raise ValueError("k: 4 to 31 bases")
    keys = ["id", "read_idx", "barcode"]
    texts = materialize(reads.select("sequence").filter("sequence is not null").distinct().withColumn("_n", F.monotonically_increasing_id()), "sequences")
    parts = max(1, -(-texts.count() // TASK_SEQUENCES))
    asked = _sampled(texts.repartition(parts, "_n"), "_n long", k, w)
    known = references.select("species", F.col("ref_id").cast("string").alias("ref_id"), F.upper("sequence").alias("sequence"))
    known = materialize(known, "references")  # read three times
    index = _sampled(known, "species string, ref_id string", k, w).select("species", "ref_id", F.col("h").alias("_h"), F.col("at").alias("ref_at"), F.col("turned").alias("_t"))
    small = (known.agg(F.sum(F.length("sequence"))).first()[0] or 0) <= BROADCAST_BASES
    hits = asked.join(F.broadcast(index) if small else index, F.col("h") == F.col("_h"))
    anchor = F.struct("species", "ref_id", (F.col("turned") != F.col("_t")).alias("turned"), "ref_at", "at")
    gathered = hits.groupBy("_n").agg(F.collect_list(anchor).alias("anchors"))
    rows = gathered.join(texts, "_n").select("sequence", "anchors")
    chained = rows.mapInArrow(_chained(k), "sequence string, species string, ref_id string, flag int, mapq int, score double, x array<int>, y array<int>")
    known = known.select(F.col("species").alias("_s"), F.col("ref_id").alias("_r"), F.col("sequence").alias("ref"))
    met = chained.join(F.broadcast(known) if small else known, (F.col("species") == F.col("_s")) & (F.col("ref_id") == F.col("_r")))
    turned = F.when(F.col("flag").bitwiseAND(16) > 0, reverse_complement("sequence")).otherwise(F.col("sequence"))
    met = met.select(*chained.columns, F.upper(turned).alias("read"), "ref")
    done = materialize(met.mapInArrow(_extended(k), "sequence string, species string, ref_id string, flag int, mapq int, score double, n_anchors int, pos int, ref_end int, cigar string, nm int"), "aligned")
    columns = [*keys, "species", "ref_id", "flag", "pos", "ref_end", "mapq", "score", "n_anchors", "cigar", "nm"]
    quality = ["quality"] if "quality" in reads.columns else []
    out = reads.select(*keys, "sequence", *quality).join(done, "sequence")
    if not bases:
        return out.select(*columns)
    return out.select(*columns, "sequence", F.col("quality") if quality else F.lit(None).cast("string").alias("quality"))


def _chained(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = [pa.string(), pa.string(), pa.string(), pa.int32(), pa.int32(), pa.float64(), pa.list_(pa.int32()), pa.list_(pa.int32())]
        names = ["sequence", "species", "ref_id", "flag", "mapq", "score", "x", "y"]
        for b in batches:
            out = []
            for r in b.to_pylist():
                r["anchors"].sort(key=lambda a: a["species"])
                for species, group in groupby(r["anchors"], key=lambda a: a["species"]):
                    for c in _ranked(list(group), len(r["sequence"]), k):
                        out.append([r["sequence"], species, c["ref_id"], c["flag"], c["mapq"], c["score"], c["x"], c["y"]])
            yield pa.RecordBatch.from_arrays([pa.array([o[j] for o in out], t) for j, t in enumerate(kinds)], names=names)

    return run


def _extended(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            cols = {n: b.column(n).to_pylist() for n in ("read", "ref", "x", "y")}
            found = [cigar_of(a.encode(), r.encode(), x, y, k) for a, r, x, y in zip(cols["read"], cols["ref"], cols["x"], cols["y"], strict=True)]
            keep = ["sequence", "species", "ref_id", "flag", "mapq", "score"]
            made = {"n_anchors": (pa.int32(), list(map(len, cols["x"])))}
            made |= {n: (t, [f[j] for f in found]) for j, (n, t) in enumerate((("pos", pa.int32()), ("ref_end", pa.int32()), ("cigar", pa.string()), ("nm", pa.int32())))}
            yield pa.RecordBatch.from_arrays([*[b.column(n) for n in keep], *[pa.array(v, t) for t, v in made.values()]], names=[*keep, *made])

    return run


def sam_lines(alignments: DataFrame) -> DataFrame:
    """One SAM line (column value) for each record of align(..., bases=True); secondary ones without their bases.

    Supplementary records keep the whole read, its other parts as soft clips.
    """
    back, bare = F.col("flag").bitwiseAND(16) > 0, F.col("flag").bitwiseAND(256) > 0
    seq = F.when(bare, "*").when(back, reverse_complement("sequence")).otherwise(F.col("sequence"))
    quality = F.when(bare | F.col("quality").isNull(), "*").when(back, F.reverse("quality")).otherwise(F.col("quality"))
    fields = [
        F.regexp_replace("id", "^@", ""), F.col("flag"), F.col("ref_id"), F.col("pos") + 1, F.col("mapq"), F.col("cigar"), F.lit("*"), F.lit(0), F.lit(0), seq, quality,
        F.concat(F.lit("NM:i:"), "nm"), F.concat(F.lit("cm:i:"), "n_anchors"), F.concat(F.lit("s1:i:"), F.col("score").cast("int")),
    ]
    return alignments.select(F.concat_ws("\t", *[f.cast("string") for f in fields]).alias("value"))
