"""The stages over the smallest tables: columns, what each keeps, and the whole run."""

import collections

import corpus_pipeline as p

SF = "/root/testdata/sf0.001"


def test_stages(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    seen = [docs]
    for k, (_, stage) in enumerate(p.STAGES):
        stage(spark, seen[-1], SF).write.parquet(f"{tmp_path}/{k}")
        seen.append(spark.read.parquet(f"{tmp_path}/{k}"))
    assert all(s.columns == list(p.COLUMNS) for s in seen[1:-1])
    ids = [{r.doc_id for r in s.select("doc_id").collect()} for s in seen]
    assert all(b <= a for a, b in zip(ids, ids[1:], strict=False))
    good = [i for i, q in labels.items() if q == 1]
    bad = [i for i, q in labels.items() if q == 0]
    assert sum(i in ids[1] for i in good) >= 0.97 * len(good) and sum(i in ids[1] for i in bad) <= 0.2 * len(bad) + 1
    texts = collections.Counter(" ".join((r.text or "").split()).lower() for r in seen[2].collect())
    assert max(texts.values()) == 1
    last = seen[-1].collect()
    assert all(r.round_trip and r.n_tokens == len(r.token_ids) for r in last)
    whole = p.run(spark, SF).select("doc_id").collect()
    assert {r.doc_id for r in whole} == ids[-1]


def test_each_stage_by_hand(spark, tmp_path):
    """Decisions of the stages on a small corpus, against plain definitions."""
    import random

    rng = random.Random(4)
    make = lambda n: " ".join(f"w{rng.randrange(10**6)}" for _ in range(n))
    item, base = make(40), make(120)
    near = base.split()
    near[60] = "other"
    far = " ".join([*base.split()[:60], *make(60).split()])
    texts = [make(100), base, base, " ".join(near), far, f"{make(30)} {item} {make(30)}", "write to jo.doe@mail.example.com now", "", None, make(100) + "\nécole 日本"]
    rows = [(k, t, "en", "s", len(t or "")) for k, t in enumerate(texts)] + [(None, f"{item} x", "en", "s", 1), (None, make(50), "en", "s", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    spark.createDataFrame([(1, item), (2, None)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    kept = p.near_duplicates(spark, docs, str(tmp_path))
    assert sorted((r.doc_id, r.text) for r in kept.collect() if r.doc_id is not None) == [(k, texts[k]) for k in (0, 1, 4, 5, 6, 7, 9)]
    assert kept.filter("doc_id is null").count() == 2
    clean = p.decontamination(spark, docs, str(tmp_path))
    assert sorted((r.doc_id is None, r.doc_id or 0, r.text) for r in clean.collect() if r.text) == sorted((i is None, i or 0, t) for i, t, *_ in rows if t and item not in t)
    hidden = {r.doc_id: r for r in p.personal_data(spark, docs.filter("doc_id is not null"), str(tmp_path)).collect()}
    assert all((r.text == texts[k]) == (k != 6) and r.n_chars == (None if texts[k] is None else len(r.text)) for k, r in hidden.items())
    done = p.tokens(spark, docs, str(tmp_path))
    assert done.filter("not round_trip or n_tokens <> size(token_ids)").count() == 0 and done.count() == len(rows)


def test_quality_stage_follows_the_plain_score(spark, tmp_path):
    import math

    from readloom.llm import quality_classifier as q

    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    model = q.train(docs, labels, "text", "doc_id", "quality")
    want = set()
    for r in docs.collect():
        at, share = q.text_features((r.text or "").encode())
        score = model.probabilities(at, share)[1] if len(at) else 1 / (1 + math.exp(model.bias[0] - model.bias[1]))
        if score >= 0.5:
            want.add(r.doc_id)
    assert {r.doc_id for r in p.quality(spark, docs, SF).collect()} == want


def test_empty_documents(spark, tmp_path):
    empty = spark.read.parquet(f"{SF}/documents.parquet").limit(0)
    for name in ("labels", "benchmark"):
        spark.read.parquet(f"{SF}/{name}.parquet").limit(0).write.parquet(f"{tmp_path}/{name}.parquet")
    docs = empty
    for _, stage in p.STAGES:
        docs = stage(spark, docs, str(tmp_path))
    assert docs.count() == 0
