"""Block-Max MaxScore against scores of every document, over shards, batches, blocks of items and odd texts."""

import collections
import math
import random
import re

import numpy as np
import pytest

from readloom.llm import lexical_search as s

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def terms(text):
    return TERM.findall((text or "").translate(LOWER))


def brute(docs, items, top=20):
    """(item_id, rank, doc_id, score) by the definition; the rank alone tells repeats of an id apart."""
    tf = [(i, collections.Counter(terms(t))) for i, t in docs]
    size = [sum(c.values()) for _, c in tf]
    n_docs, n_terms = sum(n > 0 for n in size), sum(size)
    df = collections.Counter(t for _, c in tf for t in c)
    out = []
    for item, text in items:
        found = []
        for (i, c), n in zip(tf, size, strict=True):
            score = 0
            for t in terms(text):
                if c[t]:
                    w = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                    m = 75 + 25 * n * n_docs // n_terms
                    score += w * (10**9 * c[t] // (1000 * c[t] + 12 * m))
            if score:
                found.append((i, score))
        found.sort(key=lambda x: (-x[1], x[0] is None, x[0] or 0))
        out += [(item, k + 1, i, score) for k, (i, score) in enumerate(found[:top])]
    return sorted(out, key=str)


def got(index, items, **more):
    return sorted((tuple(r) for r in s.search(index, items, **more).collect()), key=str)


@pytest.mark.parametrize("size", [1, 300, 1 << 20])
def test_packed_numbers(size):
    v = np.random.default_rng(size).integers(0, size, 3000)
    data, at = s.pack_numbers(v)
    assert s.unpack_numbers(data).tolist() == v.tolist() and at[0] == 0


def test_search(spark, docs, clashing, rows):
    items = [(k, t) for k, (_, t, *_) in enumerate(rows[::4])] + [(900, None), (901, ""), (902, "nothing-here"), (None, rows[1][1]), (5, "w1 w1 W2, w3"), (5, "w1 w1 W2, w3"), (903, "ÉTÉ 日本 Écôle"), (904, "a\0b w7")]
    frame = spark.createDataFrame([(i, t, 0) for i, t in items], "item_id long, text string, term int")
    index = s.build_index(clashing)
    want = brute([(i, t) for i, t, *_ in rows], items)
    assert got(index, frame) == want and len(want) > 300
    assert got(index, frame, item_bytes=2000) == want
    assert got(s.build_index(docs, shard_bytes=5000), frame) == want


def test_many_documents_reject_blocks_unread(spark, monkeypatch):
    """Frequent and rare words over thousands of documents: same results, and most blocks stay packed."""
    rng = random.Random(2)
    pool = [f"w{int(rng.paretovariate(0.6))}" for _ in range(5000)]
    docs = [(k, " ".join(rng.choices(pool, k=rng.randrange(5, 60)))) for k in range(6000)]
    docs += [(10_000 + k, docs[0][1]) for k in range(40)]  # ties, cut by id
    items = [(k, " ".join(rng.choices(docs[rng.randrange(6000)][1].split(), k=12)) + " w1 w2 w1") for k in range(25)] + [(99, docs[0][1])]
    index = s.build_index(spark.createDataFrame(docs, "doc_id long, text string").coalesce(1))
    want = brute(docs, items)
    assert got(index, spark.createDataFrame(items, "item_id long, text string")) == want
    rows = [r for r in index.collect()]
    head = next(r for r in rows if r.term is None)
    lists = {}
    length = np.frombuffer(head.lengths, "<i8")
    norm = {n: 75 + 25 * n * 6040 // int(length.sum()) for n in set(length.tolist())}
    m = np.array([norm[n] for n in length.tolist()])
    read = collections.Counter()
    for r in rows:
        if r.term is not None:
            lists[bytes(r.term)] = s._List(bytes(r.blocks), bytes(r.postings), r.df, norm)
    plain = s._List.unpack

    def counted(self, blocks, m):
        read["of"] += len(self.first)
        read["blocks"] += len(self.first) if blocks is None else len(blocks)
        return plain(self, blocks, m)

    monkeypatch.setattr(s._List, "unpack", counted)
    monkeypatch.setattr(s, "CACHED", 0)
    weights = {t: math.floor(1000 * math.log((2 * 6040 + 2) / (2 * x.df + 1))) for t, x in lists.items()}
    whole = 0
    for _, text in items:
        count = collections.Counter(t.encode() for t in terms(text))
        whole += sum(len(lists[t].first) for t in count)
        docs_found, scores = s._Searcher(lists, m, weights, 20).best(list(count.items()))
        assert len(docs_found) >= 20 and (scores > 0).all()
    assert read["blocks"] < 0.6 * whole


def test_index_grows_by_batches(spark, rows, tmp_path):
    rows = [(i, t) for i, t, *_ in rows]
    path = f"{tmp_path}/index"
    for k, part in enumerate((rows[:30], rows[30:])):
        frame = spark.createDataFrame(part, "doc_id long, text string")
        index = s.build_index(frame, batch=f"b{k}", path=path)
    items = [(k, t) for k, (_, t) in enumerate(rows[:10])]
    assert got(index, spark.createDataFrame(items, "item_id long, text string")) == brute(rows, items)


def test_a_long_text(spark):
    rng = random.Random(1)
    long = " ".join(f"w{rng.randrange(300_000)}" for _ in range(700_000))
    docs = [(1, long), (2, "w5 w6"), (3, "w7 " * 500)]
    items = [(1, "w5 w6 w7"), (2, long[:3000])]
    frames = [spark.createDataFrame(x, y) for x, y in ((docs, "doc_id long, text string"), (items, "item_id long, text string"))]
    assert got(s.build_index(frames[0]), frames[1]) == brute(docs, items)


def test_empty(spark, empty):
    none = spark.createDataFrame([], "item_id long, text string")
    one = spark.createDataFrame([(1, "w1")], "item_id long, text string")
    docs = spark.createDataFrame([(1, "w1", "", "", 1)], empty.schema)
    assert got(s.build_index(empty), one) == [] and got(s.build_index(docs), none) == []
    assert len(got(s.build_index(docs), one)) == 1
