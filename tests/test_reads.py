"""Reads: the literal cases of FIXTURES.md, and quirks of every operator."""

import hashlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from readloom import config
from readloom.functions import sequences as fn
from readloom.operators import reads as ops
from readloom.sources import derived

ROWS = [
    (0, "@r1", "ACGTACGTAC", "IIIII55555"),
    (1, "@r2", "ACGNacgtAC", "+++++?????"),
    (2, "@r3", "GGGGCCCCGG", "!!!!!IIIII"),
    (3, "@r4", "TTTTTTTTTTTT", "555555555555"),
    (4, "@r5", "ACGTACGTAC", "5555555555"),
]


@pytest.fixture(scope="module")
def raw(spark):
    return spark.createDataFrame(ROWS, "read_idx long, id string, sequence string, quality string")


@pytest.fixture(scope="module")
def stats(raw):
    return ops.with_stats(raw).cache()


def ids(df):
    return sorted(r["id"] for r in df.collect())


def test_statistics(stats):
    got = {r["id"]: r for r in stats.collect()}
    want = {
        "@r1": (0.3, 0.2, 0.3, 0.2, 0, 30, 10, 20, 40, 40, 40, 0.074068),
        "@r2": (0.2, 0, 0.2, 0.6, 0.5, 20, 10, 10, 30, 30, 30, 0.125831),
        "@r3": (0, 0, 0.4, 0.6, 0.5, 20, 20, 0, 40, 40, 40, None),
        "@r4": (0, 1, 0, 0, 0, 20, 0, 20, 20, 20, 20, 0.111803),
    }
    for k, v in want.items():
        r = got[k]
        found = [r[c] for c in ("A", "T", "C", "G", "N", "Q_Score", "std_QScore", "q25", "q50", "q75", "q90", "ScoreDist")]
        assert found == pytest.approx(v, abs=1e-5), k
    assert tuple(c for c in stats.columns if c != "read_idx") == config.READ_COLUMNS


def test_statistics_reject_bad_rows(spark):
    bad = spark.createDataFrame([("@a", "", ""), ("@b", "ACGT", "II"), ("@c", None, None), ("@d", "AC", "III")], "id string, sequence string, quality string")
    assert ids(ops.with_stats(bad)) == ["@d"]
    assert ids(ops.rejects(bad)) == ["@a", "@b", "@c"]


def test_filters(stats):
    assert ids(ops.filter_q(stats, 25)) == ["@r1"]
    assert len(ids(ops.filter_size(stats, 0.5, 1.0))) == 5
    assert ids(ops.filter_size(stats, 11, 20)) == ["@r4"]
    assert ids(ops.filter_size(stats, 1.0, 11)) == ["@r1", "@r2", "@r3", "@r5"]
    assert "@r3" not in ids(ops.filter_quality(stats, 1.0))
    assert ids(ops.filter_duplicates(stats)) == ["@r1", "@r2", "@r3", "@r4"]
    assert ids(ops.filter_gc(stats, 0.45, 0.55)) == ["@r1", "@r5"]
    assert ids(ops.filter_n(stats, 0.0)) == ["@r1", "@r4", "@r5"]


def test_multi_filter_takes_thresholds_from_the_input(stats):
    one = ops.multi_filter(stats, size_inf=0.0, size_sup=1.0, quality=0.5, n=1.0)
    assert ids(one) == ids(ops.filter_quality(stats, 0.5))
    assert len(ids(ops.multi_filter(stats, duplicated=True))) == 3


@pytest.mark.parametrize(("head", "strict", "left"), [(0.05, True, 5), (0.05, False, 10), (0.25, False, 8), (2.5, False, 8), (0, False, 10)])
def test_head_crop(raw, head, strict, left):
    r = ops.crop(raw.filter("id = '@r1'"), head=head, strict_parity=strict).first()
    assert len(r["sequence"]) == len(r["quality"]) == left
    assert ROWS[0][2].endswith(r["sequence"])


def test_crop_can_empty_a_read(raw):
    r1 = raw.filter("id = '@r1'")
    assert ops.crop(r1, head=12).count() == 0
    assert ops.crop(r1, tail=12).count() == 0
    assert ops.crop(r1, tail=12, strict_parity=True).first()["sequence"] == ROWS[0][2][:8]


def test_kmers(stats):
    want = "ACGNacgt ACGTACGT CGNacgtA CGTACGTA GGCCCCGG GGGCCCCG GGGGCCCC GNacgtAC GTACGTAC TTTTTTTT".split()
    assert [r[0] for r in ops.distinct_kmers(stats, 8).collect()] == sorted(want)
    assert ops.distinct_kmers(stats, 13).count() == 0


def test_sequence_functions(spark):
    df = spark.createDataFrame([("CACTCAATTAAGCGCACACG",), ("ACGTN",), ("acgtN",), ("ACGTNacgt",)], "s string")
    got = [r[0] for r in df.select(fn.reverse_complement("s")).collect()]
    assert got == ["CGTGTGCGCTTAATTGAGTG", "gACGT", "gacgt", "acgtgACGT"]
    assert [fn.reverse_complement_text(r["s"]) for r in df.collect()] == got
    code = df.filter("s = 'ACGTNacgt'").select(fn.encode("s", 12)).first()[0]
    assert code == [1, 3, 4, 2, 0, 1, 3, 4, 2, 0, 0, 0]
    assert len(df.select(fn.encode("s", 2)).first()[0]) == 20
    found = df.select(fn.search_all("s", ["ACG", "cac"])).collect()
    assert found[0][0] == {"cac": [0, 14, 16], "acg": [17]}
    assert found[3][0] == {"acg": [0, 5]}
    assert df.select(fn.distance(F.array(F.lit(0.0), F.lit(3.0)), F.array(F.lit(4.0), F.lit(0.0)))).first()[0] == 5


def test_cut_primers(spark):
    p = config.PRIMERS["CHERIF"]
    f, r = p["forwards"][0], fn.reverse_complement_text(p["reverses"][0])
    rows = [("@both", f"AC{f.lower()}GGTT{r}TT"), ("@order", f"{r}AA{f}"), ("@one", f"{f}ACGT"), ("@turned", fn.reverse_complement_text(f"AC{f}GGTT{r}TT"))]
    df = spark.createDataFrame([(i, s, "I" * len(s)) for i, s in rows], "id string, sequence string, quality string")
    got = ops.cut_primers(df, p["forwards"], p["reverses"]).collect()
    assert [x["id"] for x in got] == ["@both"]
    assert got[0]["sequence"] == f"{f.lower()}GGTT{r}" and len(got[0]["quality"]) == len(got[0]["sequence"])
    assert ids(ops.cut_primers(df, p["forwards"], p["reverses"], both_strands=True)) == ["@both", "@turned"]
    assert ops.cut_primers(df, p["forwards"], p["reverses"], min_length=100).count() == 0


def test_subsets(raw):
    chosen = raw.filter("id in ('@r2', '@r4')").select("id").union(raw.filter("id = '@r2'").select("id"))
    assert ids(ops.by_ids(raw, chosen)) == ["@r2", "@r4"]
    assert ids(ops.sample(raw, 3)) == ids(ops.sample(raw, 3)) and ops.sample(raw, 3).count() == 3
    assert ops.stratified(raw.withColumn("y", F.col("read_idx") % 2), "y", "id", 0.5).count() == 3


def test_settings():
    assert (config.primer_set("parva").shortest, config.primer_set("PARVA").longest, config.CODES["unidentified"]) == (140, 155, 10)
    with pytest.raises(ValueError):
        config.primer_set("nothing")


def test_sql_functions(spark):
    fn.register_sql(spark)
    row = spark.sql("SELECT kmers('ACGTN', 3) AS k, kmers('AC', 3) AS none, reverse_complement('ACGTN') AS r, encode_bases('ACGTNa', 8) AS e").first()
    assert (row.k, row.none, row.r, row.e) == (["ACG", "CGT", "GTN"], [], "gACGT", [1, 3, 4, 2, 0, 1, 0, 0])
    assert spark.sql("SELECT explode(k) AS kmer FROM (SELECT kmers(s, 2) AS k FROM VALUES ('ACG'), (null) AS t(s))").count() == 2


def test_quantiles(spark):
    rng = np.random.default_rng(2)
    a, b = rng.normal(size=500), rng.integers(0, 9, 500).astype(float)
    df = spark.createDataFrame([(float(x), None if k % 7 == 0 else float(y), None) for k, (x, y) in enumerate(zip(a, b, strict=True))], "a double, b float, c double").repartition(3)
    wanted = {f"{c}{q}": (c, q) for c in ("a", "b") for q in (0.0, 0.1, 0.333, 0.5, 1.0)} | {"c0.5": ("c", 0.5)}
    got = ops.quantiles(df, wanted)
    assert got.pop("c0.5") is None
    assert all(v == pytest.approx(np.quantile(a if n[0] == "a" else b[np.arange(500) % 7 > 0], wanted[n][1])) for n, v in got.items())


def test_stratified_takes_the_first_of_each_label(spark):
    df = spark.range(3000).withColumn("y", F.when(F.col("id") % 10 < 7, "hot").when(F.col("id") % 10 == 7, None).otherwise("rare"))
    got = ops.stratified(df, "y", "id", 0.25)
    assert {r["y"]: r["count"] for r in got.groupBy("y").count().collect()} == {"hot": 525, "rare": 150, None: 75}
    order = sorted((r.id for r in df.filter("y = 'hot'").collect()), key=lambda i: hashlib.md5(f"42:{i}".encode()).hexdigest())
    assert {r.id for r in got.filter("y = 'hot'").collect()} == set(order[:525]) and got.columns == df.columns



@pytest.mark.parametrize("k", [1, 3, 21, 31, 40])
def test_kmer_counts_of_any_letters(spark, k):
    import collections
    import random

    rng = random.Random(k)
    seqs = ["".join(rng.choices("ACGT", k=rng.randrange(70))) for _ in range(40)] + ["ACGTNACGTACGTN" * 5, "acgtACGT" * 6, "ÀCGTACGT" * 8, "", None, "A" * 90, "\0ACGT" * 9]
    df = spark.createDataFrame([(s,) for s in seqs], "sequence string").repartition(3)
    want = collections.Counter(s[i : i + k] for s in seqs if s for i in range(len(s) - k + 1))
    assert {r.kmer: r.n for r in ops.kmer_counts(df, k).collect()} == want
    assert [r.kmer for r in ops.distinct_kmers(df, k).collect()] == sorted(want, key=lambda x: x.encode())


def test_kmers_of_many_ranges_stay_in_order(spark, monkeypatch):
    """Ranges and runs of a few codes: right counts, in order without a sort of strings, and no k-mer of its own in a
    shuffle."""
    import collections
    import random

    from readloom.operators import kmers

    monkeypatch.setattr(kmers, "RANGE_CODES", 300)
    monkeypatch.setattr(kmers, "RUN_CODES", 500)
    rng = random.Random(5)
    seqs = ["".join(rng.choices("ACGT", k=90)) for _ in range(60)] * 2 + ["A" * 2000, "ACGT" * 300, "", None]
    df = spark.createDataFrame([(s,) for s in seqs], "sequence string").repartition(3)
    want = collections.Counter(s[i : i + 21] for s in seqs if s for i in range(len(s) - 20))
    assert {r.kmer: r.n for r in kmers.kmer_counts(df).collect()} == want
    got = kmers.distinct_kmers(df)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert [r.kmer for r in got.collect()] == sorted(want) and got.rdd.getNumPartitions() > 10
    assert "HashAggregate" not in plan and "rangepartitioning" not in plan
    assert kmers.kmer_counts(df.limit(0)).count() == 0


def test_word_starts_read_the_text_once(spark):
    """Overlaps, words at either end, signs of regular expressions, nothing; no step of the plan lower-cases a text for
    each of its places."""
    texts = ["CGCGCG", "xacgACG", "a.c.", "", None, "ÉCGÉcg日cg", "GGGG"]
    df = spark.createDataFrame([(t,) for t in texts], "s string")
    for word in ("CGCG", "acg", ".", "cg", "GG", ""):
        low = [(t or "").lower() for t in texts]
        want = [[] if t is None else [i for i in range(len(x) - len(word) + 1) if x.startswith(word.lower(), i)] for t, x in zip(texts, low, strict=True)]
        assert [r[0] for r in df.select(fn.all_starts("s", word)).collect()] == want, word
    plan = df.select(fn.all_starts("s", "acg").alias("x"))._jdf.queryExecution().optimizedPlan().toString()
    assert "sequence(" not in plan and plan.count("lower(") == 2


def test_reads_are_spread_evenly(spark, tmp_path):
    """Thirty thousand events of one small file become several files of reads, for as many tasks."""
    spark.range(30_000).selectExpr("id as event_id", "id % 7 as user_id").coalesce(1).write.parquet(f"{tmp_path}/events.parquet")
    made = derived.reads(spark, str(tmp_path))
    per = [r[1] for r in made.groupBy(F.input_file_name()).count().collect()]
    assert len(per) == 6 and sum(per) == 30_000 and max(per) < 6_000
