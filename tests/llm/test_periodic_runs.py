"""Runs of periodic words against a brute-force search, and the query's digests against plain Python."""

import hashlib
import random
import re
import zlib

import numpy as np
import pytest

from readloom.llm import periodic_runs

WORD = re.compile(rb"[^\x20\x09-\x0D]+")


def brute(w, least=12):
    """Every stretch with a least period q of at least max(least, 2 q) words that neither neighbour extends."""
    n, found = len(w), {}
    for q in range(1, n // 2 + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and w[j] == w[j + q]:
                j += 1
            if j - i >= q and j - i + q >= least:
                found.setdefault((i, j - i + q), q)
            i = max(j, i) + 1
    return sorted(((s, n, q) for (s, n), q in found.items()), key=lambda r: (r[0], r[2]))


def planted(i, w):
    h = zlib.crc32(str(i).encode()) if i is not None else 1
    if h % 10 or not w:
        return w
    g, n = h // 10, len(w)
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [w[k] if k < a else w[a + (k - a) % p] for k in range(n)]


def want(i, t):
    w = planted(i, WORD.findall((t or "").encode()))
    runs = brute(w)
    drop = {k for s, n, q in runs for k in range(s + q, s + n)}
    text = "".join(f"{s},{n},{q}\n" for s, n, q in runs)
    left = b" ".join(x for k, x in enumerate(w) if k not in drop)
    best = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=None)
    four = (best[0], best[1], best[2], 1000 * best[1] // best[2]) if best else (None,) * 4
    return (i, len(runs), *four, hashlib.sha256(text.encode()).hexdigest(), hashlib.sha256(left).hexdigest())


@pytest.mark.parametrize("seed", range(6))
@pytest.mark.parametrize("least", [4, 7, 12])
def test_runs_of_many_small_texts(seed, least):
    rng = random.Random(seed)
    texts = []
    for _ in range(150):
        w = [rng.randrange(rng.choice((1, 2, 3, 9))) for _ in range(rng.randrange(60))]
        for _ in range(rng.randrange(3)):
            at, q = rng.randrange(len(w) + 1), rng.randrange(1, 9)
            w[at:at] = (w[at : at + q] or [1]) * rng.randrange(1, 12)
        texts.append(w)
    base, flat = 0, []
    for w in texts:
        flat += [base + x for x in w]
        base += 10
    got = periodic_runs.runs_of(np.array(flat, np.int64), [len(w) for w in texts], least)
    assert got == [brute(w, least) for w in texts]


def test_long_periodic_texts():
    rng = random.Random(3)
    block = [rng.randrange(5000) for _ in range(700)]
    for w in ([1] * 3000, [1, 2] * 1500 + [1], block * 6 + block[:30], ([1] * 40 + [2]) * 60, [k % 40 + (k // 40 % 7 == 3) * 100 for k in range(3000)]):
        assert periodic_runs.runs_of(np.array(w, np.int64), [len(w)], 12) == [brute(w)]


def test_query(spark, docs, clashing, rows):
    more = [(k, " ".join(random.Random(k).choices("abcdefgh", k=90)) + "\n" + "x y z " * (k % 9), "en", "s", 1) for k in range(2000, 2120)]
    more += [(3000, "a\0b " * 20, "en", "s", 1), (3001, "é " * 12, "en", "s", 1), (3001, "é " * 12, "en", "s", 1)]
    frame = clashing.unionByName(spark.createDataFrame(more, docs.schema), allowMissingColumns=True)
    found = periodic_runs.periodic_runs(periodic_runs.with_planted_runs(frame))
    got = [tuple(r) for r in periodic_runs.run_digests(found).collect()]
    expected = [want(i, t) for i, t, *_ in [*rows, *more]]
    assert sorted(map(str, got)) == sorted(map(str, expected))
    assert sum(r[1] > 0 for r in got) > 20


def test_texts_in_pieces(spark, monkeypatch):
    text = ("w1 w2  w3\n" * 30 + "　 x ").encode()
    whole = periodic_runs.number_words(text)
    monkeypatch.setattr(periodic_runs, "PIECE_BYTES", 7)
    parts = periodic_runs.number_words(text)
    assert whole[0].tolist() == parts[0].tolist() and whole[1] == parts[1]


def test_a_text_of_many_words(spark):
    rng = random.Random(8)
    w = [f"w{rng.randrange(10**6)}" for _ in range(200_000)] + ["a", "b", "c"] * 50_000
    frame = spark.createDataFrame([(1, " ".join(w)), (2, "a b")], "doc_id long, text string")
    got = {r.doc_id: r for r in periodic_runs.periodic_runs(frame).collect()}
    assert [tuple(r) for r in got[1].runs] == [(200_000, 150_000, 3)] and got[1].collapsed == " ".join(w[:200_003])
    assert got[2].runs == [] and got[2].n_words == 2


def test_empty(empty):
    assert periodic_runs.periodic_runs(empty).collect() == []
    with pytest.raises(ValueError):
        periodic_runs.periodic_runs(empty, least=3)
