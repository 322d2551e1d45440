"""Dictionary search against a plain search of every pattern in every text."""

import random

import pytest

from readloom.operators import dictionary


def plain(texts, patterns):
    out = []
    for k, t in texts:
        for p in {p.lower() for p in patterns if p}:
            at = (t or "").lower().find(p)
            while at >= 0:
                out.append((k, p, at))
                at = (t or "").lower().find(p, at + 1)
    return sorted(out)


@pytest.mark.parametrize("most", [dictionary.BROADCAST_PATTERNS, 0])
def test_search(spark, most):
    rng = random.Random(1)
    texts = [(k, "".join(rng.choices("ACGT", k=rng.randrange(90)))) for k in range(120)] + [(200, None), (201, ""), (202, "A" * 60), (203, "naïve ÉTÉ 日本 naïve")]
    patterns = ["".join(rng.choices("acgt", k=rng.randrange(1, 25))) for _ in range(60)] + [t[5 : 5 + n] for _, t in texts[:60] for n in (6, 16, 30)]
    patterns += ["A", "aaaa", "AAAAAAAAAAAAAAAAA", None, "", "été", "naïve", "日本", "acgt", "ACGT"]
    frames = spark.createDataFrame(texts, "k int, t string"), spark.createDataFrame([(p,) for p in patterns], "pattern string")
    got = sorted(map(tuple, dictionary.search_dictionary(*frames, "k", "t", most=most).collect()))
    assert got == plain(texts, patterns) and len(got) > 500


def test_many_patterns_in_one_plan(spark):
    """A hundred thousand patterns: the plan is as small as for ten."""
    reads = spark.range(300).selectExpr("id", "translate(concat(md5(string(id)), md5(string(-id))), '0123456789abcdef', 'ACGTACGTACGTACGT') as s")
    made = spark.range(100_000).selectExpr("translate(substr(md5(string(id)), 1, 20), '0123456789abcdef', 'ACGTACGTACGTACGT') as pattern")
    found = dictionary.search_dictionary(reads, made, "id", "s")
    few = dictionary.search_dictionary(reads, made.limit(10), "id", "s")
    sizes = [len(x._jdf.queryExecution().optimizedPlan().toString()) for x in (found, few)]
    assert abs(sizes[0] - sizes[1]) < 200
    got = set(map(tuple, found.collect()))
    known = {r[0].lower() for r in made.collect()}
    assert got == {(i, s[k : k + 20].lower(), k) for i, s in reads.collect() for k in range(len(s) - 19) if s[k : k + 20].lower() in known}


def test_nothing(spark):
    none = spark.createDataFrame([], "k int, t string")
    one = spark.createDataFrame([("acgt",)], "pattern string")
    assert dictionary.search_dictionary(none, one, "k", "t").collect() == []
    text = spark.createDataFrame([(1, "acgt")], "k int, t string")
    assert dictionary.search_dictionary(text, one.limit(0), "k", "t").collect() == []


def test_windows_that_no_seed_has_do_not_travel(spark):
    """Of two hundred texts of a hundred bases each, few windows pass the filter; a full filter loses no match."""
    rng = random.Random(3)
    texts = [(k, "".join(rng.choices("acgt", k=100))) for k in range(200)]
    frame = spark.createDataFrame(texts, "k int, t string")
    seeds = dictionary.windows(spark.createDataFrame([(t[20:36],) for _, t in texts], "p string"), "p", [16])
    kept = dictionary.windows(frame, "t", [16], dictionary.bit_filter(seeds, 200))
    got = {(r.k, r["at"]) for r in kept.collect()}
    assert {(k, 20) for k, _ in texts} <= got and len(got) < 2 * len(texts)


def test_a_full_filter_loses_nothing(spark, monkeypatch):
    monkeypatch.setattr(dictionary, "MOST_BITS", 7)
    texts = [(k, "acgtacgtttgacca"[k % 9 :] * 3) for k in range(60)]
    patterns = ["acg", "ttgacca", "tacgtttgaccaacgtacg", "gg"]
    frames = spark.createDataFrame(texts, "k int, t string"), spark.createDataFrame([(p,) for p in patterns], "pattern string")
    assert sorted(map(tuple, dictionary.search_dictionary(*frames, "k", "t", most=0).collect())) == plain(texts, patterns)
