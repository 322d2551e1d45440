"""Exact dedup against plain grouping, and the digest index over batches, failures and sessions."""

import collections
import hashlib

import pytest
from pyspark.sql import functions as F

from readloom.llm import exact_dedup


def sha(text):
    return hashlib.sha256((text or "").encode()).hexdigest()


def plain(rows):
    groups = collections.defaultdict(list)
    for i, t, *_ in rows:
        groups[sha(t)].append(i)
    out = collections.Counter()
    for i, t, *_ in rows:
        g = groups[sha(t)]
        keep = max((x for x in g if x is not None), default=None)
        out[i, keep, len(g), sha(t)] += 1
    return out, {s: max((x for x in g if x is not None), default=None) for s, g in groups.items()}


@pytest.mark.parametrize("batches", [1, 2, 7])
def test_dedup(docs, clashing, rows, batches):
    more = [(r[0] + 1000 if r[0] is not None else None, *r[1:]) for r in rows[::3]] + [(-5, rows[2][1], "en", "s", 1), (None, None, "en", "s", 0)]
    got = exact_dedup.dedup(clashing.unionByName(docs.sparkSession.createDataFrame(more, docs.schema), allowMissingColumns=True), batches=batches).collect()
    want, keeps = plain([*rows, *more])
    assert collections.Counter((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in got) == want
    kept = [(r.text_sha256, r.doc_id) for r in got if r.kept]
    assert len(kept) == len(keeps) and dict(kept) == keeps


def test_texts_that_only_look_equal(spark):
    texts = ["a", "a ", "A", "a\0", "é", "é", "", None, " ", "x" * 3_000_000, "x" * 3_000_001]
    rows = list(enumerate(texts))
    got = exact_dedup.dedup(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert collections.Counter((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in got) == plain(rows)[0]
    assert sorted(r.doc_id for r in got if not r.kept) == [6]


def test_empty(empty):
    assert exact_dedup.dedup(empty).collect() == []


def batch(spark, texts, first):
    return exact_dedup.text_digests(spark.createDataFrame([(first + k, t) for k, t in enumerate(texts)], "doc_id long, text string"))


def test_index_keeps_what_earlier_batches_brought(spark, tmp_path):
    index = exact_dedup.DigestIndex(spark, f"{tmp_path}/index", 3)
    assert sorted(r.doc_id for r in index.add(batch(spark, ["a", "b", "a"], 0), "one").collect()) == [1, 2]
    spark.sql(f"DROP TABLE {index.name}")  # another session knows the folder alone
    index = exact_dedup.DigestIndex(spark, f"{tmp_path}/index", 50)
    assert index.buckets == 3 and index.rows().count() == 2
    two = batch(spark, ["b", "c", None, "c", ""], 10)
    assert sorted(r.doc_id for r in index.add(two, "two").collect()) == [13, 14]
    again = index.add(two, "two")
    assert sorted(r.doc_id for r in again.collect()) == [13, 14] and index.rows().count() == 4
    small = index.compact(f"{tmp_path}/small")
    assert sorted(map(str, small.rows().collect())) == sorted(map(str, index.rows().collect()))
    files = [p.name for p in (tmp_path / "small" / "digests").glob("part-*")]
    assert len({f.split("_")[-1] for f in files}) == len(files) <= 3


def test_a_batch_that_broke_off_is_completed(spark, tmp_path):
    index = exact_dedup.DigestIndex(spark, f"{tmp_path}/index", 2)
    rows = batch(spark, ["a", "b", "c", "a"], 0)
    rows.filter("doc_id = 1").select("digest", "doc_id", "row", F.lit("x").alias("batch")).write.insertInto(index.name)
    assert sorted(r.doc_id for r in index.add(rows, "x").collect()) == [1, 2, 3]
    assert sorted(r.doc_id for r in index.rows().collect()) == [1, 2, 3]


def test_the_index_is_not_shuffled(spark, tmp_path):
    index = exact_dedup.DigestIndex(spark, f"{tmp_path}/index", 4)
    index.add(batch(spark, [f"t{k}" for k in range(50)], 0), "one")
    fresh = index.add(batch(spark, [f"t{k}" for k in range(40, 70)], 50), "two")
    plan = fresh._jdf.queryExecution().executedPlan().toString()
    assert fresh.count() == 20 and "SortMergeJoin" in plan and plan.count("Exchange hashpartitioning") == 1
