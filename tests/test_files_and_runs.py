"""Files, counts, alignment, simulation, models and streams."""

import gzip

import numpy as np
import pytest
from pyspark.sql import functions as F

from readloom.config import LABELS, PRIMERS
from readloom.functions.sequences import encode_one_hot, register_sql, reverse_complement_text
from readloom.operators import align, counts, models, qc, simulate
from readloom.operators import reads as reads_ops
from readloom.plans import runs
from readloom.sources import files

def record(k, seq):
    return f"@r{k}\n{seq}\n+\n{'I' * len(seq)}\n"


@pytest.fixture(scope="module")
def amplicon(spark):
    return [r["sequence"] for r in simulate.random_amplicons(spark, 6).collect()]


def test_fastq_stops_at_an_empty_sequence(spark, tmp_path):
    path = tmp_path / "barcode01" / "a.fastq.gz"
    path.parent.mkdir()
    with gzip.open(path, "wt") as f:
        f.write(record(0, "ACGT") + record(1, "GG") + "@e\n\n+\n\n" + record(2, "TT"))
    got = files.read_fastq(spark, f"{tmp_path}/barcode*/*.fastq.gz").orderBy("read_idx").collect()
    assert [(r["barcode"], r["read_idx"], r["id"], r["sequence"], r["quality"]) for r in got] == [("barcode01", 0, "@r0", "ACGT", "IIII"), ("barcode01", 1, "@r1", "GG", "II")]
    assert files.read_sequences(spark, str(path)).count() == 4
    large = files.read_large_fastq(spark, f"{tmp_path}/barcode*/*.fastq.gz").orderBy("read_idx").collect()
    assert [r.asDict() for r in large] == [r.asDict() for r in got]


def test_large_fastq_in_many_splits(spark, tmp_path):
    (tmp_path / "barcode07").mkdir()
    for name, n in (("a", 300), ("b", 170)):
        (tmp_path / "barcode07" / f"{name}.fastq").write_text("".join(f"@{name}{k}\n{'ACGT' * (k % 9 + 1)}\n+\n{'@' * (4 * (k % 9 + 1))}\n" for k in range(n)) + "@cut\nAC\n")
    size = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2k")
    try:
        got = files.read_large_fastq(spark, f"{tmp_path}/barcode07/*.fastq")
        rows = sorted((r["file"][-7], r["read_idx"], r["id"], len(r["sequence"]), r["quality"]) for r in got.collect())
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
    assert rows == [(name, k, f"@{name}{k}", 4 * (k % 9 + 1), "@" * (4 * (k % 9 + 1))) for name, n in (("a", 300), ("b", 170)) for k in range(n)]


def test_fasta_modes(spark, tmp_path):
    path = tmp_path / "x.fasta"
    path.write_bytes(b">one\r\nACG\r\nTT\r\n\r\n>two x\r\nGG\r\n")
    got = files.read_fasta(spark, str(path)).orderBy("ordinal").collect()
    assert [(r["header"], r["sequence"]) for r in got] == [("one", "ACGTT"), ("two x", "GG")]
    assert [r["sequence"] for r in files.read_fasta(spark, str(path), stop_at_blank=True).collect()] == ["ACGTT"]


def test_templates_need_both_primers(spark, tmp_path):
    """Of templates with mismatched primers only the exact one is kept, cut to its span."""
    f, r = PRIMERS["CHERIF"]["forwards"][0], reverse_complement_text(PRIMERS["CHERIF"]["reverses"][0])
    body = "ACGTTGCA" * 15
    wrong = f.replace("GG", "GC", 1)
    rows = [("exact", f"TTT{f}{body[:116]}{r}AAA"), ("forward", f"TTT{wrong}{body[:116]}{r}"), ("reverse", f"{f}{body[:116]}{r[:-1]}")]
    (tmp_path / "t.fasta").write_text("\r\n\r\n".join(f">{n}\r\n{s[:60]}\r\n{s[60:]}" for n, s in rows))
    fasta = files.read_fasta(spark, f"{tmp_path}/t.fasta")
    reads = fasta.select(F.col("header").alias("id"), "sequence", F.regexp_replace("sequence", ".", "I").alias("quality"))
    kept = runs.trimmed(reads).collect()
    assert [(x["id"], len(x["sequence"])) for x in kept] == [("exact", 154)]


def test_writers(spark, tmp_path):
    df = spark.createDataFrame([("@a", "ACGT", "IIII")], "id string, sequence string, quality string")
    files.write_reads(df, f"{tmp_path}/fq", compression="gzip")
    files.write_reads(df, f"{tmp_path}/fa", "fa")
    assert files.read_fastq(spark, f"{tmp_path}/fq/*.gz").first()["sequence"] == "ACGT"
    assert files.read_fasta(spark, f"{tmp_path}/fa/*.txt").first()["header"] == "a"
    with pytest.raises(ValueError):
        files.write_reads(df, f"{tmp_path}/no", "bam")
    assert not (tmp_path / "no").exists()


def test_sam_clustal_and_intervals(spark, tmp_path):
    (tmp_path / "a.sam").write_text("@HD\tx\nr1\t0\tref\t5\t60\t4M\t*\t0\t0\tACGT\tIIII\nr2\t4\t*\t0\t0\t*\t*\t0\t0\tGG\tII\n")
    sam = files.read_sam(spark, f"{tmp_path}/a.sam")
    assert [r["seq"] for r in counts.mapped(sam, 40).collect()] == ["ACGT"]
    (tmp_path / "a.clustal").write_text("CLUSTAL O\n\none  AC-G\t3\ntwo  ACGG\t4\n     ** *\n\none  TT\t5\ntwo  T-\t5\n")
    rows = files.read_clustal(spark, f"{tmp_path}/a.clustal").collect()
    assert {r["name"]: r["aligned"] for r in rows} == {"one": "AC-GTT", "two": "ACGGT-"}
    df = spark.createDataFrame([("(577, 693)",), ("x",)], "t string")
    assert [tuple(r) for r in df.select(*files.interval("t")).collect()] == [(577, 693), (None, None)]


def test_counts_keep_empty_barcodes(spark):
    hits = spark.createDataFrame([("barcode01", "x")] * 10, "barcode string, species string")
    b = spark.createDataFrame([("barcode01",), ("barcode02",)], "barcode string")
    s = spark.createDataFrame([("x",), ("y",)], "species string")
    got = {(r["barcode"], r["species"]): (r["n"], r["log10_n"], r["seen"]) for r in counts.complete_counts(hits, b, s).collect()}
    assert got["barcode01", "x"] == (10, 1.0, True) and got["barcode02", "y"] == (0, 0.0, False) and len(got) == 4


def test_thresholds_and_report(spark):
    df = spark.createDataFrame([("a", [0.6, 0.4], 0.0), ("b", [0.3, 0.7], 1.0), ("a", [0.5, 0.5], 1.0)], "y string, probs array<double>, prediction double")
    assert counts.confident(df, 0.6).count() == 2
    rows = counts.threshold_counts(df, {"a": 0.5, "b": 0.4}, ["a", "b"]).collect()
    assert {r["species"]: r["n_reads_detected"] for r in rows} == {"a": 2, "b": 3}
    named = df.withColumn("p", F.when(F.col("prediction") == 0, "a").otherwise("c"))
    rep = {r["class"]: r for r in counts.class_report(named, "y", "p").collect()}
    assert rep["a"]["precision"] == 1 and rep["a"]["recall"] == 0.5 and rep["c"]["recall"] == 0 and rep["accuracy"]["f1"] == pytest.approx(1 / 3)


def test_alignment_and_mapping(spark, amplicon):
    refs = spark.createDataFrame([("x", "x1", amplicon[0]), ("y", "y1", amplicon[1])], "species string, ref_id string, sequence string")
    seqs = [amplicon[0], amplicon[1], reverse_complement_text(amplicon[0]), amplicon[5], "ACGT"]
    reads = spark.createDataFrame([(k, f"@r{k}", "barcode01", s) for k, s in enumerate(seqs)], "read_idx long, id string, barcode string, sequence string")
    got = {r["id"]: r for r in align.align(reads, refs).filter("mapq >= 40").collect()}
    assert {k: (r["species"], r["flag"]) for k, r in got.items()} == {"@r0": ("x", 0), "@r1": ("y", 0), "@r2": ("x", 16)}


def test_simulation(spark):
    a = simulate.random_amplicons(spark, 20)
    p = PRIMERS["CHERIF"]["forwards"][0]
    rows = [r["sequence"] for r in a.collect()]
    assert len(set(rows)) == 20 and all(150 <= len(s) < 160 and s.startswith(p) for s in rows) and rows == sorted(rows)
    t = spark.createDataFrame([("x", "ACGT" * 28)], "species string, sequence string")
    b = [r["sequence"] for r in simulate.errored_amplicons(t, 30).orderBy("copy").collect()]
    assert b == [r["sequence"] for r in simulate.errored_amplicons(t, 30).orderBy("copy").collect()] and len(set(b)) > 10
    assert {r["sequence"] for r in simulate.errored_amplicons(t, 3, high=0.0).collect()} == {rows[0][:18] + "ACGT" * 28 + reverse_complement_text(PRIMERS["CHERIF"]["reverses"][0])}


def test_models(spark, amplicon, tmp_path):
    t = spark.createDataFrame([(LABELS[k], amplicon[k][18:-20]) for k in range(3)], "species string, sequence string")
    data = simulate.dataset(simulate.errored_amplicons(t, 30, high=0.03)).cache()
    for kind, params in (("forest", {"numTrees": 10, "maxDepth": 6}), ("tree", {}), ("logistic", {"maxIter": 10}), ("bayes", {})):
        assert models.recall(models.fit(data, kind, **params), data) > 0.8, kind
    model = models.fit(data, numTrees=5, maxDepth=5)
    models.save(model, f"{tmp_path}/m")
    assert models.labels_of(models.load(f"{tmp_path}/m")) == sorted(LABELS[:3])
    assert len(models.importances(model)) == 160
    best, score = models.search(data, data, {"numTrees": [2, 4]}, trials=2, maxDepth=4)
    assert best["numTrees"] in (2, 4) and score > 0.5
    with pytest.raises(ValueError):
        models.classifier("oracle")


def test_run_and_stream(spark, amplicon, tmp_path):
    for b in ("barcode01", "barcode02"):
        (tmp_path / "run" / b).mkdir(parents=True)
    with gzip.open(tmp_path / "run/barcode01/a.fastq.gz", "wt") as f:
        f.write("".join(record(k, f"AA{amplicon[0]}TT") for k in range(10)))
    with gzip.open(tmp_path / "run/barcode02/a.fastq.gz", "wt") as f:
        f.write(record(0, "ACGT"))
    for b, data in (("barcode03", gzip.compress(b"")), ("barcode04", b"")):  # files without a read
        (tmp_path / "run" / b).mkdir()
        (tmp_path / "run" / b / "a.fastq.gz").write_bytes(data)
    assert {(r.barcode, r.bytes > 0) for r in files.list_files(spark, f"{tmp_path}/run/*/*.gz").collect()} == {(f"barcode0{k}", True) for k in (1, 2, 3)}
    (tmp_path / "refs").mkdir()
    (tmp_path / "refs/Some_species.fasta").write_text(f">x\n{amplicon[0]}\n")
    seen = reads_ops.StageCounts()
    wide = runs.run(spark, f"{tmp_path}/run", f"{tmp_path}/out", species_folder=f"{tmp_path}/refs", counters=seen)
    assert sorted(map(tuple, wide.collect())) == [("barcode01", 1.0), ("barcode02", 0.0), ("barcode03", 0.0), ("barcode04", 0.0)]
    assert seen.rows() == [("reads", 11, 0), ("cut to primers", 10, 1), ("within length range", 10, 0)]
    assert [tuple(r) for r in seen.table(spark).collect()] == seen.rows()
    assert wide.columns[1] == "Some species (40 <= MapQ)"
    with pytest.raises(ValueError):
        runs.run(spark, "x", "y")
    from readloom.streaming.runs import running_counts, stream_amplicons

    raw = runs.load_run(spark, f"{tmp_path}/run").select("read_idx", "id", "barcode", "sequence", "quality")
    raw.write.parquet(f"{tmp_path}/stream")
    q = running_counts(stream_amplicons(spark, f"{tmp_path}/stream")).writeStream.outputMode("complete").format("memory").queryName("seen").start()
    q.processAllAvailable()
    q.stop()
    assert [tuple(r) for r in spark.table("seen").collect()] == [("barcode01", 10)]


def test_train_save_analyse_and_command_line(spark, amplicon, tmp_path):
    from readloom.__main__ import arguments, main
    from readloom.plans import evaluate

    t = spark.createDataFrame([(LABELS[k], amplicon[k][18:-20]) for k in range(3)], "species string, sequence string")
    data = simulate.dataset(simulate.errored_amplicons(t, 30, high=0.03))
    model = models.train_and_save([data.limit(45), data], f"{tmp_path}/model", rows=120, numTrees=8, maxDepth=6)
    parts = {r["part"] for r in models.report(model, {"train": data, "test": data}).collect()}
    assert parts == {"train", "test"}
    rows = data.select(F.lit("barcode01").alias("barcode"), F.monotonically_increasing_id().alias("read_idx"), "features").unionByName(
        spark.createDataFrame([("barcode02", 0, None)], "barcode string, read_idx long, features array<int>"))
    tables = evaluate.analyse(model, rows, {LABELS[0]: 0.9, LABELS[1]: 0.0})
    assert tables["predictions"].count() == 90 and len(tables["probabilities"].columns) == 5
    assert sum(r["n"] for r in tables["distribution"].collect()) == 90
    assert sum(r["mean_probability"] for r in tables["average_class"].collect()) == pytest.approx(1)
    found = {r["species"]: r["n_reads_detected"] for r in tables["detected"].collect()}
    assert found[LABELS[1]] == 90 and 10 <= found[LABELS[0]] <= 30
    evaluate.write_analysis(tables, f"{tmp_path}/analysis")
    assert spark.read.csv(f"{tmp_path}/analysis/predictions", header=True).count() == 90
    (tmp_path / "run/barcode01").mkdir(parents=True)
    with gzip.open(tmp_path / "run/barcode01/a.fastq.gz", "wt") as f:
        f.write("".join(record(k, f"AA{amplicon[0]}TT") for k in range(10)) + record(10, "ACGT"))
    main(["-c", "-m", f"{tmp_path}/model", "-r", f"{tmp_path}/run", "-o", f"{tmp_path}/out", "-p", "0.3"])
    wide = spark.read.csv(f"{tmp_path}/out/counts", header=True).collect()
    assert len(wide) == 1 and float(wide[0][f"{LABELS[0]} (0.3 <= p)"]) == 1.0
    assert spark.read.csv(f"{tmp_path}/out/quality_after/positions", header=True).count() == len(amplicon[0])
    stages = [tuple(r) for r in spark.read.csv(f"{tmp_path}/out/stages", header=True).collect()]
    assert stages == [("reads", "11", "0"), ("cut to primers", "10", "1"), ("within length range", "10", "0")]
    top = spark.read.csv(f"{tmp_path}/out/quality_before/overrepresented", header=True).orderBy(F.desc("n")).first()
    assert (top.sequence, top.n) == (f"AA{amplicon[0]}TT", "10")
    with pytest.raises(SystemExit):
        arguments(["-r", "x", "-o", "y"])


def test_real_test_set_and_boosting(spark, amplicon):
    raw = spark.createDataFrame([(k, f"@r{k}", "barcode01", f"AA{a}TT", "I" * (len(a) + 4)) for k, a in enumerate(amplicon[:4])], "read_idx long, id string, barcode string, sequence string, quality string")
    refs = spark.createDataFrame([("r1", amplicon[1]), ("r2", amplicon[2])], "ref_id string, sequence string")
    got = runs.labelled_reads(raw, refs, "Some species", mapq=40).collect()
    assert len(got) == 2 and {r["species"] for r in got} == {"Some_species"} and all(len(r["features"]) == 160 for r in got)
    t = spark.createDataFrame([(LABELS[k], amplicon[k][18:-20]) for k in range(3)], "species string, sequence string")
    data = simulate.dataset(simulate.errored_amplicons(t, 20, high=0.02)).cache()
    model = models.fit(data, "boosted", maxIter=2, maxDepth=3, subsamplingRate=1.0)
    assert models.recall(model, data) > 0.8
    probs = [r["probs"] for r in models.predict(model, data).collect()]
    assert all(sum(p) == pytest.approx(1) for p in probs)


def test_quality_tables(spark):
    df = spark.createDataFrame([("ACGT", "IIII"), ("AC", "55"), ("AC", "55"), ("", "")], "sequence string, quality string")
    first = qc.per_position(df.filter("quality <> ''")).orderBy("position").first()
    assert (first["n"], first["mean_q"], first["median_q"]) == (3, pytest.approx(80 / 3), 20.0)
    assert {r["copies"]: r["n_sequences"] for r in qc.duplication_levels(df).collect()} == {1: 2, 2: 1}


def test_overrepresented_sequences_exactly(spark):
    """Many more distinct sequences than a task keeps, frequent ones spread over tasks or in one."""
    import collections
    import random

    rng = random.Random(3)
    pool = [f"s{min(int(rng.paretovariate(0.5)), 10**6)}" for _ in range(6000)] + ["late"] * 70
    df = spark.createDataFrame([(x,) for x in pool] + [(None,)], "sequence string").repartition(5)
    count = collections.Counter(pool)
    for share in (0.5, 0.05, 0.01, 0.004):
        got = {r.sequence: (r.n, r.share) for r in qc.overrepresented(df, share).collect()}
        assert got == {s: (n, pytest.approx(n / len(pool))) for s, n in count.items() if n >= share * len(pool)}
    assert qc.overrepresented(df.limit(0)).count() == 0
    content = {r.position: r for r in qc.base_content(spark.createDataFrame([("ACg",), ("AN",), ("",), (None,)], "sequence string")).collect()}
    assert (content[0].n, content[0].A, content[1].other, content[2].G) == (2, 1.0, 0.5, 1.0) and len(content) == 3
    found = qc.adapter_content(spark.createDataFrame([("xxACGT",), ("acgt",), ("A",), (None,)], "sequence string"), {"a": "ACGT", "b": "TTT"}).orderBy("position").collect()
    assert [(r.adapter, r.position, r.n) for r in found] == [("a", 0, 1), ("a", 2, 2)] and found[1].share == pytest.approx(2 / 3)


def test_scratch_folders_go(spark):
    from pathlib import Path

    from readloom.sources import staging

    kept = staging.materialize(spark.range(3), "kept")
    with staging.scratch(spark):
        gone = staging.materialize(spark.range(4), "gone")
        path = gone.inputFiles()[0].removeprefix("file://")
        assert gone.count() == 4 and Path(path).exists()
    assert not Path(path).parent.exists() and kept.count() == 3


def test_metadata_columns_and_labels(spark, tmp_path):
    (tmp_path / "a.csv").write_text("name,species\nx,b\ny,a\nz,b\n,\n")
    df = files.read_csv(spark, f"{tmp_path}/a.csv", "name string, species string")
    assert df.count() == 4 and counts.unique_labels(df, "species") == ["a", "b"]
    hot = df.limit(1).select(encode_one_hot(F.lit("ATg?"), 5).alias("v")).first().v
    assert hot == [1, 0, 0, 0, 0, 1, 0, 0, 0, 0, 0, 1, 0, 0, 0, 0, 0, 0, 0, 0]
    register_sql(spark)
    rows = spark.sql("select s, k.kmer, k.start from values ('ACGTA'), ('AC'), (null) t(s), lateral kmer_table(s, 3) k").collect()
    assert [tuple(r) for r in rows] == [("ACGTA", "ACG", 0), ("ACGTA", "CGT", 1), ("ACGTA", "GTA", 2)]


def test_knn_vote_beyond_one_broadcast(spark):
    rng = np.random.default_rng(6)
    x = rng.normal(size=(450, 500))
    y = rng.integers(0, 3, 450)
    df = spark.createDataFrame([(k, int(c), v.tolist()) for k, (c, v) in enumerate(zip(y, x, strict=True))], "id long, y int, v array<double>").repartition(2)
    got = {r.id: r.prediction for r in counts.knn_vote(df, df, "v", "y", "id").collect()}
    far = [((x - v) ** 2).sum(1) for v in x]
    votes = [np.bincount(y[np.lexsort((np.arange(450), d))[:5]], minlength=3) for d in far]
    assert x.size > counts.QUERY_VALUES and got == {k: int(v.argmax()) for k, v in enumerate(votes)}


def test_knn_vote_of_odd_vectors_as_in_sql(spark):
    """Copies, ties, vectors of other lengths, missing elements and vectors: as the query's SQL has it."""
    import duckdb

    from readloom.plans import registry

    rng = np.random.default_rng(8)
    rows = [(k, rng.integers(0, 4, 3).astype(float).tolist(), int(rng.integers(0, 3))) for k in range(700)]
    rows += [(k, [1.0, 2.0, 3.0], 7 - k % 2) for k in range(700, 1000)]
    rows += [(1000, None, 1), (1001, [2.0], 2), (1002, [], 0), (1003, [1.0, None, 2.0], 1), (1004, [1.0, 1.0, 1.0, 9.0], 1), (1020, [1.0], 0), (1040, [2.0, 2.0, 2.0, 2.0], 1)]
    rows += [(1060, [None, 3.0, 3.0], 2), (1080, None, 2), (1100, [], 1), (1120, [float("nan"), 0.0, 0.0], 1)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    asked = df.filter("vec_id % 20 = 0")
    embeddings = df.toArrow()  # noqa: F841  read by DuckDB
    want = dict(duckdb.sql(registry.ORACLES["knn_vote"]).fetchall())
    assert {r.vec_id: r.prediction for r in counts.knn_vote(asked, df, "embedding", "label", "vec_id").collect()} == want


def test_knn_vote_multiplies_blocks(spark):
    """Rows of the plan between points and votes are k a query and block, not all pairs."""
    df = spark.range(3000).select("id", F.array(F.sin("id"), F.cos("id")).alias("v"), (F.col("id") % 3).alias("y"))
    out = counts.knn_vote(df.filter("id % 20 = 0"), df, "v", "y", "id")
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" in plan and "zip_with" not in plan and out.count() == 150
