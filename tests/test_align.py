"""Minimizers, chains and base-level paths against plain programs, and whole alignments of reads with errors."""

import math
import random
import re

import numpy as np
import pytest

from readloom.functions.sequences import reverse_complement_text
from readloom.operators import align, counts
from readloom.sources import files


def dna(rng, n):
    return "".join(rng.choices("ACGT", k=n))


def errored(rng, seq, rate):
    out = []
    for c in seq:
        x = rng.random()
        if x < rate / 3:
            out.append(rng.choice([b for b in "ACGT" if b != c]))
        elif x < 2 * rate / 3:
            out += [c, rng.choice("ACGT")]
        elif x >= rate:
            out.append(c)
    return "".join(out)


def plain_distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a):
        last, row[0] = row[0], i + 1
        for j, y in enumerate(b):
            last, row[j + 1] = row[j + 1], min(last + (x != y), row[j] + 1, row[j + 1] + 1)
    return row[-1]


def edits_of(path, a, b):
    i = j = n = 0
    for op in path:
        n += op != "M" or a[i] != b[j]
        i, j = i + (op != "D"), j + (op != "I")
    assert (i, j) == (len(a), len(b))
    return n


@pytest.mark.parametrize("seed", range(4))
def test_edit_paths_are_shortest(seed):
    rng = random.Random(seed)
    for _ in range(150):
        a = dna(rng, rng.randrange(40))
        b = rng.choice((dna(rng, rng.randrange(40)), errored(rng, a, 0.2)))
        path, n = align.edit_path(a.encode(), b.encode())
        assert n == plain_distance(a, b) == edits_of(path, a, b)


def test_extensions_have_the_highest_score():
    rng = random.Random(5)
    for _ in range(200):
        a = dna(rng, rng.randrange(25))
        b = errored(rng, a[: rng.randrange(len(a) + 1)], 0.15) + dna(rng, rng.randrange(12))
        path, n = align.extend_path(a.encode(), b.encode())
        i, j = sum(c != "D" for c in path), sum(c != "I" for c in path)
        assert edits_of(path, a[:i], b[:j]) == n
        best = max(2 * x - 5 * min(plain_distance(a[:x], b[:y]) for y in range(len(b) + 1)) for x in range(len(a) + 1))
        assert 2 * i - 5 * n == best


@pytest.mark.parametrize(("k", "w"), [(4, 3), (7, 5), (15, 10), (28, 10)])
def test_minimizers(k, w):
    rng = random.Random(k)
    seqs = [dna(rng, rng.randrange(120)) for _ in range(60)] + ["", "A" * 40, "ACGT" * 12, "acgtNacgt" * 9, dna(rng, k), dna(rng, k + w - 2)]
    count, h, at, turned = align.minimizers([s.encode() for s in seqs], k, w)
    rows, done = [], 0
    for n in count.tolist():
        rows.append(list(zip(h[done : done + n].view(np.uint64).tolist(), at[done : done + n].tolist(), turned[done : done + n].tolist(), strict=True)))
        done += n
    name = {}
    for s, found in zip(seqs, rows, strict=True):
        for v, i, back in found:
            kmer = s[i : i + k].upper()
            other = reverse_complement_text(kmer)
            assert back == (other < kmer) and name.setdefault(v, min(kmer, other)) == min(kmer, other)
    assert len(set(name.values())) == len(name)
    value = {x: v for v, x in name.items()}
    for s, found in zip(seqs, rows, strict=True):
        good = lambda x: set(x) <= set("ACGT") and x != reverse_complement_text(x)
        kmers = [s[i : i + k].upper() for i in range(len(s) - k + 1)]
        names = [min(x, reverse_complement_text(x)) if good(x) else None for x in kmers]
        chosen = {i for _, i, _ in found}
        for lo in range(max(1, len(names) - w + 1) if names else 0):
            window = range(lo, min(lo + w, len(names)))
            known = [i for i in window if names[i]]
            assert not known or chosen & set(known)
            least = min((value.get(names[i], math.inf) for i in known), default=None)
            assert all(i in chosen for i in known if value.get(names[i]) == least)


def plain_chain_score(x, y, k):
    score = []
    for i in range(len(x)):
        best = float(k)
        for j in range(i):
            dx, dy = x[i] - x[j], y[i] - y[j]
            gap = abs(dx - dy)
            if 0 < dx <= align.MAX_GAP and 0 < dy <= align.MAX_GAP and gap <= align.BANDWIDTH:
                best = max(best, score[j] + min(dx, dy, k) - (0.01 * k * gap + 0.5 * math.log2(gap) if gap else 0))
        score.append(best)
    return score


@pytest.mark.parametrize("seed", range(8))
def test_chains_against_a_plain_program(seed):
    """Anchors of random reads with indels, repeats and moved pieces."""
    rng = random.Random(seed)
    ref = dna(rng, 900)
    ref = ref[:300] + ref[100:200] + ref[300:]
    read = errored(rng, ref[50:400] + ref[600:800] + dna(rng, 60) + ref[420:600], 0.06)
    k = 11
    at = {}
    for i in range(len(ref) - k + 1):
        at.setdefault(ref[i : i + k], []).append(i)
    pairs = sorted({(i, j) for j in range(len(read) - k + 1) for i in at.get(read[j : j + k], [])})
    x, y = np.array(pairs).T
    score, before = align.chain_scores(x, y, k)
    assert score.tolist() == pytest.approx(plain_chain_score(x.tolist(), y.tolist(), k))
    chains = align.best_chains(x, y, k)
    assert chains[0][0] == pytest.approx(max(score)) and len({a for _, c in chains for a in c}) == sum(len(c) for _, c in chains)
    for _, c in chains:
        assert (np.diff(x[c]) > 0).all() and (np.diff(y[c]) > 0).all()
    straight = np.arange(0, 300, 4)
    total, chain = align.best_chains(straight, straight + 7, k)[0]
    assert total == pytest.approx(max(plain_chain_score(straight.tolist(), (straight + 7).tolist(), k))) and len(chain) == len(straight)


def consumed(cigar):
    parts = [(int(n), op) for n, op in re.findall(r"([0-9]+)([MIDS])", cigar)]
    assert "".join(f"{n}{op}" for n, op in parts) == cigar and all(a[1] != b[1] for a, b in zip(parts, parts[1:], strict=False))
    return sum(n for n, op in parts if op in "MIS"), sum(n for n, op in parts if op in "MD"), parts


@pytest.fixture(scope="module")
def noisy(spark):
    rng = random.Random(11)
    refs = [("one", f"a{j}", dna(rng, 700)) for j in range(3)] + [("two", "b0", dna(rng, 500))]
    refs.append(("one", "a3", errored(rng, refs[0][2], 0.02)))  # nearly the first: reads of either are doubtful
    rows, truth = [], {}
    for n in range(60):
        species, ref, seq = refs[n % 4]
        at, size = rng.randrange(0, 200), rng.randrange(180, 300)
        read = errored(rng, seq[at : at + size], 0.04)
        if n % 3 == 0:
            read = reverse_complement_text(read)
        if n % 10 == 7:
            read = dna(rng, 30) + read
        truth[f"@r{n}"] = (species, ref, seq[at : at + size], n % 3 == 0)
        rows.append((n, f"@r{n}", f"barcode0{n % 2}", read, "".join(chr(40 + i % 30) for i in range(len(read)))))
    # One read of two pieces from far places, one of nothing known, one without bases, one without an id.
    rows.append((100, "@split", "barcode00", refs[1][2][:200] + refs[2][2][300:520], "I" * 420))
    rows += [(101, "@none", "barcode00", dna(rng, 200), "I" * 200), (102, "@null", "barcode00", None, None), (103, None, None, refs[3][2][:200], "I" * 200)]
    reads = spark.createDataFrame(rows, "read_idx long, id string, barcode string, sequence string, quality string")
    return reads, spark.createDataFrame(refs, "species string, ref_id string, sequence string"), {r[1]: r for r in rows}, {r[1]: r[2] for r in refs}, truth


@pytest.mark.parametrize("limit", [align.BROADCAST_BASES, 0])
def test_reads_with_errors(noisy, monkeypatch, limit):
    monkeypatch.setattr(align, "BROADCAST_BASES", limit)
    reads, frame, rows, refs, truth = noisy
    got = align.align(reads, frame, k=15, w=5, bases=True).collect()
    for r in got:
        read = r.sequence if not r.flag & 16 else reverse_complement_text(r.sequence)
        read_used, ref_used, parts = consumed(r.cigar)
        assert read_used == len(read) and ref_used == r.ref_end - r.pos and 0 <= r.pos < r.ref_end <= len(refs[r.ref_id])
        clips = [parts[0][0] if parts[0][1] == "S" else 0, parts[-1][0] if parts[-1][1] == "S" else 0]
        inside, piece = read[clips[0] : len(read) - clips[1]], refs[r.ref_id][r.pos : r.ref_end]
        path = "".join(op * n for n, op in parts if op != "S")
        assert edits_of(path, inside, piece) == r.nm and r.sequence == rows[r.id][3]
        assert plain_distance(inside, piece) <= r.nm <= plain_distance(inside, piece) + 2
    first = {r.id: r for r in got if r.flag & ~16 == 0 and r.species == truth.get(r.id, r.species)[0]}
    for name, (species, ref, _, back) in truth.items():
        r = first[name]
        assert bool(r.flag & 16) == back and r.species == species
        assert r.ref_id == ref if ref not in ("a0", "a3") else r.ref_id in ("a0", "a3")
        assert ref == "a0" or r.mapq >= 40
    doubtful = [first[n].mapq for n, (_, ref, _, _) in truth.items() if ref == "a0"]
    assert np.mean(doubtful) < 30
    assert any(r.flag & 256 and r.mapq == 0 for r in got)
    split = {r.ref_id: r for r in got if r.id == "@split"}
    assert sorted(r.flag for r in split.values()) == [0, 2048] and split["a1"].cigar.endswith("S") and split["a2"].cigar.split("S")[0].isdigit()
    assert not [r for r in got if r.id in ("@none", "@null")] and [r.ref_id for r in got if r.id is None] == ["b0"]


def test_edits_equal_a_plain_program_on_clean_pieces(spark):
    """Reads that hold their errors far apart: the edits are the edit distance of read and piece."""
    rng = random.Random(3)
    ref = dna(rng, 400)
    rows, want = [], {}
    for n in range(40):
        cut = sorted(rng.sample(range(60, 340, 40), 3))
        read = ref[: cut[0]] + ref[cut[0] + 1 :] if n % 3 == 0 else ref[: cut[0]] + "ACGT"[n % 4] + ref[cut[0] :] if n % 3 == 1 else ref
        read = read[: cut[2]] + ("A" if read[cut[2]] != "A" else "C") + read[cut[2] + 1 :]
        rows.append((n, f"@{n}", "b", read))
        want[f"@{n}"] = plain_distance(read, ref)
    got = align.align(spark.createDataFrame(rows, "read_idx long, id string, barcode string, sequence string"), spark.createDataFrame([("s", "r", ref)], "species string, ref_id string, sequence string"), k=15, w=5).collect()
    assert {r.id: r.nm for r in got} == want and all((r.pos, r.ref_end) == (0, 400) for r in got)


def test_sam_lines_are_read_back(spark, noisy, tmp_path):
    reads, refs, rows, _, _ = noisy
    found = align.align(reads, refs, k=15, w=5, bases=True).filter("id is not null").cache()
    align.sam_lines(found).write.text(f"{tmp_path}/sam")
    lines = {(r.qname, r.flag, r.rname, r.pos): r for r in files.read_sam(spark, f"{tmp_path}/sam").collect()}
    for r in found.collect():
        line = lines[r.id[1:], r.flag, r.ref_id, r.pos + 1]
        seq = rows[r.id][3]
        assert (line.mapq, line.cigar) == (r.mapq, r.cigar)
        assert line.seq == ("*" if r.flag & 256 else reverse_complement_text(seq) if r.flag & 16 else seq)
    kept = counts.mapped(files.read_sam(spark, f"{tmp_path}/sam"), 40).collect()
    assert any(r.flag & 2048 for r in kept) and not any(r.flag & 256 for r in kept)
    assert len(kept) == counts.mapped(found, 40).count()


def test_nothing_to_align(spark):
    none = spark.createDataFrame([], "read_idx long, id string, barcode string, sequence string")
    refs = spark.createDataFrame([("s", "r", None), ("s", "q", "")], "species string, ref_id string, sequence string")
    assert align.align(none, refs).collect() == []
    with pytest.raises(ValueError):
        align.align(none, refs, k=40)


def test_equal_reads_are_aligned_once_each_distinct_sequence(spark, monkeypatch, tmp_path):
    """Three thousand reads of two sequences: chains and paths are made of two rows, and every read has its record."""
    rng = random.Random(5)
    ref = dna(rng, 200)
    rows = [(i, f"@r{i}", "b", None if i == 7 else (ref[:150], ref[30:180])[i % 2]) for i in range(3000)]
    reads = spark.createDataFrame(rows, "read_idx long, id string, barcode string, sequence string")
    made, written = [], align.materialize

    def watched(df, tag):
        out = written(df, tag)
        made.append((tag, out.count()))
        return out

    monkeypatch.setattr(align, "materialize", watched)
    refs = spark.createDataFrame([("s", "r", ref)], "species string, ref_id string, sequence string")
    got = {r.read_idx: (r.pos, r.ref_end, r.cigar, r.nm) for r in align.align(reads, refs, k=15, w=5).collect()}
    assert made == [("sequences", 2), ("references", 1), ("aligned", 2)]
    assert got == {i: ((0, 150, "150M", 0), (30, 180, "150M", 0))[i % 2] for i in range(3000) if i != 7}
