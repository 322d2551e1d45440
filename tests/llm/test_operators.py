"""Each operator against a brute-force version, with nulls, blanks, repeats, clashing columns and empty tables."""

import base64
import collections
import datetime
import hashlib
import math
import re
import zlib

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from readloom.llm import (
    benchmark_windows,
    byte_bpe,
    components,
    context_tree,
    paragraph_dedup,
    pii,
    quality_classifier,
    quality_rules,
    simhash_dedup,
    suffix_dedup,
    url_filter,
    verify,
)

WORD = re.compile(rb"[^\x20\x09-\x0D]+")


def split(text):
    return WORD.findall((text or "").encode().lower())


def groups(n, linked):
    parent = list(range(n))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(n):
        for j in range(i):
            if linked(i, j):
                a, b = root(i), root(j)
                parent[max(a, b)] = min(a, b)
    return [root(i) for i in range(n)]


def shingle_set(w, k=5):
    return frozenset(tuple(w[i : i + k]) for i in range(max(1, len(w) - k + 1)))


def jaccard(a, b):
    return len(a & b) / len(a | b)


def key(row):
    return tuple(str(x) for x in row)


# 1 --------------------------------------------------------------------------------------------------------------------


def test_context_tree_base_and_model(docs, rows):
    got = context_tree.context_tree_scores(docs).collect()
    assert len(got) == len(rows)
    held = [i is not None and zlib.crc32(str(i).encode()) % 5 == 1 for i, *_ in rows]
    count = collections.Counter()
    for h, (_, t, *_) in zip(held, rows, strict=True):
        if not h:
            count.update([*split(t), None])
    n, v = sum(count.values()), len(count)
    want = collections.Counter()
    for h, (i, t, *_) in zip(held, rows, strict=True):
        w = [*split(t), None]
        base = sum(math.log10((count[x] + 0.5) / (n + 0.5 * (v + 1))) for x in w)
        want[i, h, len(w), sum(count[x] > 0 for x in w), n, round(base, 6)] += 1
    assert collections.Counter((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in got) == want
    assert all(r.score < 0 and math.isfinite(r.score) for r in got)


@pytest.mark.parametrize(("chunk", "fan", "asked"), [(8 << 20, 256, 2_000_000), (300, 2, 40)])
def test_context_tree_is_context_tree_weighting(spark, monkeypatch, chunk, fan, asked):
    """Whole-text scores through all shards equal a plain context tree's, and no context is left out."""
    monkeypatch.setattr(context_tree, "FAN", fan)
    monkeypatch.setattr(context_tree, "ASKED", asked)
    monkeypatch.setattr(context_tree, "PIECE_BYTES", 200)
    rng = np.random.default_rng(8)
    texts = [" ".join("".join(rng.choice(list("abé"), int(n))) for n in rng.integers(1, 6, 12)) for _ in range(30)] + [None, "", "zzz new"]
    depth, rows = 3, list(enumerate(texts))
    counts: dict = collections.defaultdict(lambda: [0, 0])
    children: dict = collections.defaultdict(set)

    def choices(t):
        coded = b"\n" * depth + b" ".join([*split(t), b"\n"])
        for k in range(depth, len(coded)):
            for b in range(8):
                yield [(coded[k - d : k], (1 << b) | coded[k] >> (8 - b)) for d in range(depth + 1)], coded[k] >> (7 - b) & 1

    for i, t in rows:
        if zlib.crc32(str(i).encode()) % 5 != 1:
            for path, bit in choices(t):
                for node, deeper in zip(path, [*path[1:], None], strict=True):
                    counts[node][bit] += 1
                    if deeper:
                        children[node].add(deeper)

    def log_kt(z, o):
        return math.lgamma(z + 0.5) + math.lgamma(o + 0.5) - math.log(math.pi) - math.lgamma(z + o + 1)

    weights = {}

    def log_pw(node):
        own = log_kt(*counts[node])
        if len(node[0]) == depth:
            weights[node] = 1.0
            return own
        log_p = math.log(0.5) + np.logaddexp(own, sum(map(log_pw, children[node])))
        weights[node] = math.exp(math.log(0.5) + own - log_p)
        return log_p

    for node in [n for n in list(counts) if not n[0]]:
        log_pw(node)

    def one(path):
        if path[0] not in weights:
            return 0.5
        z, o = counts[path[0]]
        stop = weights[path[0]]
        return stop * (o + 0.5) / (z + o + 1) + (1 - stop) * (one(path[1:]) if len(path) > 1 else 0)

    want = {i: sum(math.log10(p if bit else 1 - p) for path, bit in choices(t) for p in [one(path)]) for i, t in rows}
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = {r.doc_id: r for r in context_tree.context_tree_scores(df, depth=depth, chunk_bytes=chunk).collect()}
    assert {i: r.score for i, r in got.items()} == pytest.approx(want, rel=1e-5)
    assert got[0].bits_per_byte == pytest.approx(-want[0] / math.log10(2) / len(b" ".join([*split(texts[0]), b"\n"])))


# 2 --------------------------------------------------------------------------------------------------------------------


def paragraph_units(text):
    """(start, words, is a line) of the lines and windows of a text, by the plain definition."""
    w, out, at = split(text), [], 0
    for line in (text or "").encode().lower().split(b"\n"):
        n = len(WORD.findall(line))
        if n:
            out.append((at, w[at : at + n], True))
        at += n
    size, reach = paragraph_dedup.WINDOW, paragraph_dedup.REACH
    h = paragraph_dedup.Words([(text or "").encode()], paragraph_dedup.WordHashes()).shingles.tolist()[: max(0, len(w) - size + 1)]
    runs = [range(q, q + reach) for q in range(len(h) - reach + 1)] or [range(len(h))]
    for p in range(len(h)):
        if any(p in run and h[p] == min(h[k] for k in run) for run in runs) and not any(s == p and len(x) == size for s, x, _ in out):
            out.append((p, w[p : p + size], False))
    return out


def test_paragraphs(docs, clashing, rows):
    each = [(i is None, i, r, s, w, line) for r, (i, t, *_) in enumerate(rows) for s, w, line in paragraph_units(t)]
    sets = [shingle_set(w) for *_, w, _ in each]
    alike = lambda x, y: each[x][4] == each[y][4] or each[x][5] and each[y][5] and min(len(each[x][4]), len(each[y][4])) >= 5 and jaccard(sets[x], sets[y]) >= 0.8
    root = groups(len(each), alike)
    members = collections.defaultdict(list)
    for x, r in enumerate(root):
        members[r].append(x)
    linked, short, removed = collections.Counter(), collections.Counter(), 0
    for m in members.values():
        removed += len(m) - 1
        if len({each[x][2] for x in m}) > 1:
            for x in m:
                (linked if len(each[x][4]) >= paragraph_dedup.WINDOW else short)[each[x][1]] += 1
    for frame in (docs, clashing):
        got = paragraph_dedup.duplicate_paragraphs(frame).collect()
        assert len(got) == len(rows)
        assert sum(r.n_paragraphs for r in got) == sum(x[5] for x in each)
        assert sum(r.n_removed for r in got) == removed
        for name, want in (("n_linked", linked), ("n_short_linked", short)):
            have = collections.Counter()
            for r in got:
                have[r.doc_id] += r[name]
            assert +have == want
        assert all(bool(r.n_removed) == bool(r.removed) for r in got)
        assert all(a.end < b.start for r in got for a, b in zip(r.removed, r.removed[1:], strict=False))


def test_passages_inside_lines_and_across_them(spark):
    rng = np.random.default_rng(12)
    make = lambda n: [f"u{x}" for x in rng.integers(0, 10**9, n).tolist()]
    texts, clean = [], []
    for k in range(40):
        passage = make(50 + k % 30)
        for gap in (" ", "\n"):
            w = [*make(int(rng.integers(0, 60))), *passage, *make(int(rng.integers(0, 60)))]
            texts.append("".join(x + (gap if rng.random() < 0.1 else " ") for x in w))
        clean.append(" ".join([*make(60), *passage[:20], *make(60)]) + "\nshared short line")
    df = spark.createDataFrame(list(enumerate(texts + clean)), "doc_id long, text string").repartition(4)
    got = {r.doc_id: r for r in paragraph_dedup.duplicate_paragraphs(df).collect()}
    assert all(got[i].n_linked > 0 for i in range(80)) and not any(got[i].n_linked for i in range(80, 120))
    assert all(got[i].n_short_linked == 1 for i in range(80, 120))
    left = df.join(spark.createDataFrame([(r.doc_id, r.removed) for r in got.values()], "i long, removed array<struct<start: int, end: int>>"), F.col("doc_id") == F.col("i"))
    left = dict(left.select("doc_id", paragraph_dedup.without_words(F.col("text"), F.col("removed"))).collect())
    assert left[0] == texts[0] and len(left[1].split()) <= len(texts[1].split()) - 50 + 2 * paragraph_dedup.REACH
    assert [r[0] for r in spark.createDataFrame([("a b\nc  d",), (None,)], "t string").select(paragraph_dedup.without_words(F.col("t"), F.expr("array(named_struct('start', 1, 'end', 3))"))).collect()] == ["a d", None]


def test_recall_of_near_passages_inside_long_lines(spark):
    """Passages of 80 words inside longer lines, copied with some words changed: a copy is found by a stretch of 24 equal
    words at an anchor, so every copy with 50 equal words in a row is, and most of those with fewer changes than six."""
    import random

    rng = random.Random(6)
    make = lambda n: [f"v{rng.randrange(10**6)}" for _ in range(n)]
    rows, run, changes = [], {}, {}
    for k in range(240):
        passage = make(80)
        copy, n = list(passage), k % 6
        for at in rng.sample(range(80), n):
            copy[at] = "changed"
        cuts = [-1, *[i for i, w in enumerate(copy) if w == "changed"], 80]
        run[2 * k + 1], changes[2 * k + 1] = max(b - a - 1 for a, b in zip(cuts, cuts[1:], strict=False)), n
        rows += [(2 * k, " ".join(make(30) + passage + make(30))), (2 * k + 1, " ".join(make(25) + copy + make(35)))]
    got = {r.doc_id: r.n_linked for r in paragraph_dedup.duplicate_paragraphs(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert all(got[i] > 0 for i, n in run.items() if n >= 50) and all(got[i] == 0 for i, n in run.items() if n < 24)
    found = [got[i] > 0 for i in run]
    near = [got[i] > 0 for i, n in changes.items() if 1 <= n <= 3]
    assert sum(found) >= 0.7 * len(found) and sum(near) >= 0.85 * len(near)


def test_short_lines_are_paragraphs(spark, tmp_path):
    texts = ["Yes\nno\n\none two three four", "a b c d e f\nyes \n no no", "one  two three FOUR\nyes\none two three four five", None, "no"]
    spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = {r.doc_id: (r.n_paragraphs, r.n_short_linked, [tuple(x) for x in r.removed], r.keeper_ids) for r in paragraph_dedup.op2_paragraph_dedup(spark, str(tmp_path)).collect()}
    assert got == {0: (3, 3, [], []), 1: (3, 1, [(6, 7)], [0]), 2: (3, 2, [(0, 5)], [0]), 3: (0, 0, [], []), 4: (1, 1, [(0, 1)], [0])}


def test_jaccard_links_in_blocks(spark):
    rng = np.random.default_rng(3)
    base = rng.integers(0, 2**63, 60)
    sets = [np.unique(np.r_[rng.choice(base, 55, replace=False), rng.integers(0, 2**63, 3)]).astype(np.uint64) for _ in range(40)]
    df = spark.createDataFrame([(1, k, bytearray(s.tobytes())) for k, s in enumerate(sets)], "cluster long, node long, grams binary")
    plain = [frozenset(s.tolist()) for s in sets]
    root = groups(40, lambda x, y: jaccard(plain[x], plain[y]) >= 0.8)
    for block in (512, 6):
        links = verify.jaccard_links(df, 0.8, block)
        assert all(jaccard(plain[r.a], plain[r.b]) >= 0.8 for r in links.collect())
        got = {r.node: r.component for r in components.connected_components(links).collect()}
        assert [got.get(k, k) for k in range(40)] == root


# 3 --------------------------------------------------------------------------------------------------------------------


def test_urls(spark):
    urls = ["http://www.example.com/en/a", "https://EXAMPLE.com/en/b?x", "http://a.b.net/es/1", "ftp://m.org", "http://x-casino-y.org/p#t", None, "no url", "http://net/fr/", "http://notexample.com", "http://example.com", "://casino.org/"]
    df = spark.createDataFrame(list(enumerate(urls)) + [(1, urls[1])], "page_id long, url string").withColumn("key", F.lit(1)).withColumn("listed", F.lit(2))
    got = collections.defaultdict(set)
    for r in url_filter.judge_urls(df, url_filter.pages_of_hosts(df)).collect():
        got[r.page_id].add((r.host, r.path, r.rule, r.verdict))
    assert got == {
        0: {("www.example.com", "/en/a", "www.example.com/en/", "allow")},
        1: {("example.com", "/en/b", "example.com/en/", "block")},
        2: {("a.b.net", "/es/1", "net/es/", "block")},
        3: {("m.org", "", None, "allow")},
        4: {("x-casino-y.org", "/p", None, "block")},
        5: {("", "", None, "allow")},
        6: {("", "", None, "allow")},
        7: {("net", "/fr/", "net/fr/", "block")},
        8: {("notexample.com", "", None, "allow")},
        9: {("example.com", "", None, "allow")},
        10: {("casino.org", "/", None, "block")},
    }
    assert url_filter.judge_urls(df.limit(0), url_filter.pages_of_hosts(df)).count() == 0
    assert url_filter.judge_urls(df, url_filter.pages_of_hosts(df.limit(0))).filter("verdict = 'block'").count() == 4


def test_a_list_that_grows_with_the_pages(spark):
    """One page in sixteen is listed, whatever their number; judging finds just these."""
    for n in (2000, 8000):
        df = spark.range(n).select(F.col("id").alias("page_id"), F.concat(F.lit("http://h"), F.col("id") % 700, F.lit(".org/p"), "id").alias("url"))
        got = url_filter.judge_urls(df, url_filter.drawn_pages(df)).collect()
        want = {r.page_id for r in got if hashlib.md5((r.host + r.path).encode()).hexdigest()[0] == "0"}
        assert {r.page_id for r in got if r.verdict == "block"} == want and abs(len(want) - n / 16) < n / 50


@pytest.mark.parametrize(("n", "chars"), [(1500, 1 << 17), (120_000, 1 << 17), (120_000, 1 << 14)])
def test_cascade_is_exact(spark, n, chars):
    keys = spark.range(n).select(F.concat(F.lit("k"), "id").alias("key"))
    listed = keys.filter("hash(key) % 4 = 0")
    filters, levels, shards = url_filter.build_cascade(listed, keys, max_chars=chars)
    assert (shards > 1) == (chars == 1 << 14) and levels > 2
    assert filters.filter("length(chars) > 2000").isEmpty() or shards == 1
    got = url_filter.is_listed(keys.union(spark.sql("select cast(null as string)")).withColumns({"_shard": F.lit(1), "_1_b": F.lit(2), "shard": F.lit(3)}), "key", filters, levels, shards)
    assert got.filter("listed <> coalesce(hash(key) % 4 = 0 and key is not null, false)").count() == 0 and got.count() == n + 1
    assert got.columns == ["key", "_shard", "_1_b", "shard", "listed"]


# 4 --------------------------------------------------------------------------------------------------------------------


def test_bpe(docs, clashing, rows):
    tiktoken, tokenizers = pytest.importorskip("tiktoken"), pytest.importorskip("public_tokenizers")
    path = tokenizers.path("byte_bpe_multi_50k.tiktoken")
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(path, "rb"))}
    peer = tiktoken.Encoding("own", pat_str=tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    own = byte_bpe.Codec(path, tokenizers.PATTERN)
    for text in ["", " ", "  a", "a  b\n\n c\t", "don't we'll", "x" * 3000, "ab" * 2000, "\x1c \x85 a\xa0b", "日本 語 1234 ½", "<|endoftext|>", "a\r\n b", " \n a"]:
        assert own.encode(text) == peer.encode_ordinary(text), text
        assert own.decode(own.encode(text)) == text.encode()
    want = collections.Counter()
    for i, t, *_ in rows:
        ids = peer.encode_ordinary(t or "")
        want[i, len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest()] += 1
    assert collections.Counter(map(tuple, byte_bpe.digests(docs, path, tokenizers.PATTERN).collect())) == want
    assert byte_bpe.encode_texts(clashing, path, tokenizers.PATTERN, same="same").filter("not same").count() == 0
    back = byte_bpe.decode_ids(byte_bpe.encode_texts(clashing, path, tokenizers.PATTERN), path, tokenizers.PATTERN)
    assert back.filter("decoded <> cast(coalesce(text, '') as binary)").count() == 0 and back.count() == len(rows)


# 5 --------------------------------------------------------------------------------------------------------------------


def test_pii(spark):
    texts = ["pay 4111111111111111 or 4111-1111-1111-1111", "bad 4111111111111112", "10.0.0.1, 999.1.1.1", "on 2024-02-29, 2023-02-30", "123-45-6789 000-12-1234", "+1 (643) 555-5742", "Jo.Doe7@mail.example.com", "", None, "\x01 123-45-6789 \x01"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").withColumn("_old", F.lit(1)).withColumn("x", F.lit(2))
    got = {r.doc_id: (r.n, r.text) for r in pii.pseudonymize(df, "k", found="n").collect()}
    a, b = re.findall(r"[0-9-]{16,}", got[0][1])
    assert got[0][0] == 2 and a == b.replace("-", "") != "4111111111111111" and len(b) == 19
    assert got[1] == (0, texts[1]) and got[7] == (0, "") and got[8] == (0, None)
    assert got[2][0] == 1 and got[2][1].endswith("999.1.1.1")
    assert got[3][0] == 1 and got[3][1].endswith("2023-02-30") and re.match(r"on \d{4}-\d\d-\d\d,", got[3][1])
    assert got[4][0] == 1 and got[4][1].endswith("000-12-1234") and got[9][1] == f"\x01 {got[4][1][:11]} \x01"
    assert re.fullmatch(r"\+1 \(\d{3}\) \d{3}-\d{4}", got[5][1]) and got[5][1] != texts[5]
    assert re.fullmatch(r"[A-Z][a-z]\.[A-Z][a-z]{2}\d@mail\.example\.com", got[6][1])
    assert pii.pseudonymize(df, "other", found="n").filter("doc_id = 5").first().text != got[5][1]
    kept = pii.pseudonymize(df.withColumns({"_new": F.lit(7), "_mark": F.lit(8)}), "k")
    assert kept.select("_old", "_new", "_mark", "x").distinct().collect() == [(1, 7, 8, 2)]


def plain_feistel(key, kind, a, b, size_a, size_b):
    def prf(value, turn, size):
        return int(hashlib.sha256(f"{key}:{kind}:{turn}:{size}:{value}".encode()).hexdigest()[:15], 16) % size

    for turn in range(8):
        if turn % 2 == 0:
            a = (a + prf(b, turn, size_a)) % size_a
        else:
            b = (b + prf(a, turn, size_b)) % size_b
    return a, b


def plain_pseudonym(key, kind, x):
    """A pseudonym by plain Python, for values that pass their validation."""

    def digits(kind, d):
        half = len(d) // 2
        a, b = plain_feistel(key, kind, int(d[:half]), int(d[half:]), 10**half, 10 ** (len(d) - half))
        return f"{a:0{half}d}{b:0{len(d) - half}d}"

    def filled(shape, new):
        new = iter(new)
        return "".join(next(new) if c.isdigit() else c for c in shape)

    if kind == "card":
        payload = digits(kind, re.sub("[ -]", "", x)[:-1])
        total = sum(sum(divmod(int(c) * (2 - k % 2), 10)) for k, c in enumerate(reversed(payload)))
        return filled(x, payload + str(-total % 10))
    if kind == "ip":
        o = list(map(int, x.split(".")))
        a, b = plain_feistel(key, kind, o[0] * 256 + o[1], o[2] * 256 + o[3], 65536, 65536)
        return f"{a // 256}.{a % 256}.{b // 256}.{b % 256}"
    if kind == "ssn":
        area, group, serial = map(int, x.split("-"))
        a, b = plain_feistel(key, kind, (area - (2 if area > 666 else 1)) * 99 + group - 1, serial - 1, 898 * 99, 9999)
        area = a // 99 + (2 if a // 99 >= 665 else 1)
        return f"{area:03d}-{a % 99 + 1:02d}-{b + 1:04d}"
    if kind == "date":
        first = datetime.date(1000, 1, 1)
        day = (datetime.date.fromisoformat(x) - first).days
        a, b = plain_feistel(key, kind, day % 146097 // 773, day % 146097 % 773, 189, 773)
        return str(first + datetime.timedelta(day // 146097 * 146097 + a * 773 + b))
    if kind == "email":
        return plain_local_part(key, x.split("@")[0]) + "@" + x.split("@")[1]
    d = re.sub("[^0-9]", "", x)
    n = 1 if d[0] in "17" else 2 if d[:2] in pii.TWO_DIGIT_CODES else 3
    return filled(x, d[:n] + digits(kind, d[n:]))


def plain_local_part(key, local):
    def turned(mine, other, r):
        out = ""
        for i, c in enumerate(mine):
            jump = int(hashlib.sha256(f"{key}:email:{r}:{i // 32}:{other}".encode()).hexdigest()[2 * (i % 32) :][:2], 16)
            alphabet = next((a for a in ("abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789") if c in a), None)
            out += alphabet[(alphabet.index(c) + jump) % len(alphabet)] if alphabet else c
        return out

    a, b = local[: len(local) // 2], local[len(local) // 2 :]
    for r in range(8):
        a, b = (turned(a, b, r), b) if r % 2 == 0 else (a, turned(b, a, r))
    return a + b


def test_pseudonyms_against_plain_feistel(spark):
    rng = np.random.default_rng(17)
    rows = []
    for _ in range(40):
        payload = "".join(map(str, rng.integers(0, 10, 15)))
        total = sum(sum(divmod(int(c) * (2 - k % 2), 10)) for k, c in enumerate(reversed(payload)))
        card = payload + str(-total % 10)
        rows += [("card", card), ("card", "-".join(card[k : k + 4] for k in range(0, 16, 4))), ("ip", ".".join(map(str, rng.integers(0, 256, 4))))]
        area = int(rng.choice([a for a in range(1, 900) if a != 666]))
        rows += [("ssn", f"{area:03d}-{rng.integers(1, 100):02d}-{rng.integers(1, 10000):04d}")]
        rows += [("date", str(datetime.date(1000, 1, 1) + datetime.timedelta(int(rng.integers(0, 500000))))), ("phone", f"+44 ({rng.integers(100, 1000)}) {rng.integers(100, 1000)}-{rng.integers(1000, 10000)}")]
        rows += [("email", "".join(rng.choice(list("abcXYZ019._%+-"), int(rng.integers(1, 80)))) + "@mail.example.com")]
        rows += [("phone", f"+{rng.choice(['1', '7', '33', '420'])} {rng.integers(10, 1000)} {rng.integers(100, 1000)} {rng.integers(1000, 10000)}")]
    df = spark.createDataFrame([(k, f"see {x}, and {x}.x" if kind == "card" else f"see {x}, ok") for k, (kind, x) in enumerate(rows)], "k int, text string")
    got = {r.k: r.text.split(",")[0][4:] for r in pii.pseudonymize(df, "secret").collect()}
    assert got == {k: plain_pseudonym("secret", kind, x) for k, (kind, x) in enumerate(rows)}


def test_one_number_in_every_spelling(spark):
    spellings = ["+16435555748", "+1 643 555 5748", "+1 (643) 555-5748", "+1-643-555-5748", "+1.643.555.5748", "+1(643)5555748"]
    french = ["+33 1 23 45 67 89", "+33123456789", "+33 123 456 789"]
    czech = ["+420 601 123 456", "+420601123456", "+420-601-123-456"]
    every = [*spellings, *french, *czech]
    got = [r.text for r in pii.pseudonymize(spark.createDataFrame([(k, x) for k, x in enumerate(every)], "k int, text string").orderBy("k"), "k").collect()]
    plain = [re.sub("[^0-9]", "", x) for x in got]
    assert len(set(plain[:6])) == len(set(plain[6:9])) == len(set(plain[9:])) == 1 and len(set(plain)) == 3
    assert plain[0][0] == "1" and plain[6][:2] == "33" and plain[9][:3] == "420" and not set(plain) & {re.sub("[^0-9]", "", x) for x in every}
    assert [re.sub("[0-9]", "0", x) for x in got] == [re.sub("[0-9]", "0", x) for x in every]


@pytest.mark.parametrize("made", ["concat('10.0.', id div 256, '.', id % 256)", "cast(date_add(date'1990-01-01', cast(id as int)) as string)", "concat('u', id, '@a.com')", "concat('+1 (643) 555-', lpad(id, 4, '0'))", "concat('123-45-', lpad(id + 1, 4, '0'))"])
def test_pseudonyms_are_a_permutation(spark, made):
    df = spark.range(400).selectExpr(f"{made} as text")
    got = pii.pseudonymize(df, "k")
    assert got.distinct().count() == 400
    assert got.filter(" or ".join(f"text rlike {pii._quoted('^(?:' + p + ')$')}" for p in pii.PATTERNS.values())).count() == 400


# 6 --------------------------------------------------------------------------------------------------------------------


def test_quality_rules(spark, rows, docs, clashing, empty):
    more = spark.createDataFrame([(900, "a b c a b c a b c"), (901, ("good words here and " * 5 + "\n") * 6), (902, "x # y | z " * 30)], "doc_id long, text string")
    frame = docs.select("doc_id", "text").union(more)
    got = sorted(map(tuple, quality_rules.judge(frame).drop("failed_rule", "kept").collect()), key=key)
    want = []
    for i, t in [r[:2] for r in rows] + [tuple(r) for r in more.collect()]:
        t = t or ""
        w = [x.decode() for x in WORD.findall(t.encode())]
        tri = collections.Counter(zip(w, w[1:], w[2:], strict=False))
        again = {k + j for k in range(len(w) - 2) if tri[w[k], w[k + 1], w[k + 2]] > 1 for j in range(3)}
        lines = [x for x in t.split("\n") if WORD.search(x.encode())]
        want.append((i, len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t), len(lines) - len(set(lines)), len(again), len(w) < 50 or 100 * len(again) > 50 * len(w)))
    assert got == sorted(want, key=key)
    kept = {r.doc_id: r.kept for r in quality_rules.judge(frame).collect()}
    assert not kept[900] and not kept[902] and kept[64]
    assert quality_rules.judge(clashing).count() == len(rows)
    assert quality_rules.judge(empty).count() == 0


OWN = {x: x for x in quality_rules._OWN}


def test_cascade_order_prefers_rejection_per_cost(spark):
    texts = quality_rules.measured(spark.createDataFrame([("!" * 10,)] * 5 + [("plain text",)] * 5, "_t string"), "_t", OWN)
    built = quality_rules.rules()
    assert quality_rules.cascade_order(texts, built)[0] == "no_spaces", "as many as exclamations rejects, in fewer steps"
    even = {n: (reject, F.lit(1)) for n, (reject, _) in built.items() if n != "no_spaces"}
    assert quality_rules.cascade_order(texts, even) == ["exclamations", *[n for n in even if n != "exclamations"]], "then as named"
    rare = {"a": (F.col("_size") > 99, F.lit(1)), "b": (F.col("_size") > 9, F.lit(8)), "c": (F.contains("_t", F.lit("!")), F.lit(3))}
    assert quality_rules.cascade_order(texts, rare) == ["c", "b", "a"], "c: 5 of 10 at 3 steps; b: 10 of 10 at 8"


def test_sample_is_bounded_and_from_few_files(spark, tmp_path):
    spark.range(30_000).selectExpr("id as doc_id", "cast(id as string) as text").repartition(40).write.parquet(f"{tmp_path}/d")
    docs = spark.read.parquet(f"{tmp_path}/d")
    part = quality_rules.few_files(docs)
    assert part.select(F.input_file_name()).distinct().count() == quality_rules.SAMPLE_FILES and 5000 < part.count() < 7000
    assert quality_rules.few_files(docs, 50).count() == 30_000
    some = quality_rules.few_rows(part, 1000)
    assert 800 < some.count() < 1200 and sorted(some.collect()) == sorted(quality_rules.few_rows(part, 1000).collect())
    same = docs.select(F.lit("same").alias("text"))
    assert quality_rules.few_rows(same, 100).count() in (0, 200)
    assert quality_rules.few_rows(spark.range(500), 100).count() < 200 and quality_rules.few_rows(spark.range(0)).count() == 0
    once, twice = (sorted(map(str, quality_rules.judge(docs, sample=part, sample_rows=50).collect())) for _ in range(2))
    assert once == twice


@pytest.mark.parametrize(("rule", "text"), [("symbols", "a # b"), ("exclamations", "hey!!"), ("capitals", "ABC DEf"), ("digits", "1234 5678 9"), ("braces", "{a} b"), ("no_spaces", "x" * 60), ("word_length", "a b c d"), ("word_length", "y" * 25 + " " + "z" * 30), ("repeated_lines", "a b\na b\na b\na b"), ("ellipses", "so on...\nand\n"), ("bullets", "- one\n* two\n\u2022 three")])
def test_each_rule(spark, rule, text):
    df = spark.createDataFrame([(text,), ("Plain words in a sentence stay.\nOthers too, 3 of them.",)], "_t string")
    assert [r[0] for r in quality_rules.measured(df, "_t", OWN).select(quality_rules.rules()[rule][0]).collect()] == [True, False]


# 7 --------------------------------------------------------------------------------------------------------------------


def test_classifier_on_held_out_rows(spark):
    import random

    rng = random.Random(1)
    good = [" ".join(rng.choice(["the", "cat", "sat", "mat", "on", "fine"]) for _ in range(40)) for _ in range(90)]
    bad = [" ".join(rng.choice(["###", "$$$buy", "now!!", "||"]) for _ in range(40)) for _ in range(60)] + ["word " * 40] * 30
    data = [(i, t) for i, t in enumerate([*good, *bad])]
    df = spark.createDataFrame([*data, (500, None), (501, ""), (None, good[0])], "doc_id long, text string").withColumn("score", F.lit(9)).withColumn("label", F.lit(1))
    labels = spark.createDataFrame([(i, int(i < 90)) for i, _ in data] + [(0, None), (None, 1)], "doc_id long, quality int")
    got = quality_classifier.quality_scores(df, labels).collect()
    assert len(got) == len(data) + 3 and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in got)
    held = [r for r in got if r.held_out]
    assert all(zlib.crc32(str(r.doc_id).encode()) % 3 == 1 for r in held)
    assert all(r.predicted == int(r.doc_id < 90) for r in held if r.doc_id < 180)
    none = quality_classifier.quality_scores(df, labels.limit(0)).collect()
    assert {r.score for r in none} == {0.5}


def test_classifier_scores_and_steps_by_plain_arithmetic(spark):
    """Scores equal the averaged vectors' softmax, and a training step follows the loss's numeric gradient."""
    model = quality_classifier.SubwordModel(dim=4)
    model.weights = np.random.default_rng(1).normal(size=(2, 4))
    model.bias = np.array([0.1, -0.3])
    texts = ["the cat the cat sat", "é mañana", "", "a a a", "x" * 50]
    want = []
    for t in texts:
        words = t.encode().split()
        found = [int(f) for w in words for f in quality_classifier.features_of([w])[0]] + [quality_classifier.AGAIN] * sum(a == b for a, b in zip(words, words[1:], strict=False))
        mean = model.vectors[found].mean(0) if found else np.zeros(4)
        z = model.weights @ mean + model.bias
        want.append(math.exp(z[1]) / (math.exp(z[0]) + math.exp(z[1])))
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r.score for r in quality_classifier.score(df, model).collect()}
    assert [got[k] for k in range(len(texts))] == pytest.approx(want, rel=1e-9)
    at, share = quality_classifier.text_features(b"the cat the cat sat")
    loss = lambda: -math.log(model.probabilities(at, share)[1])
    before, old = loss(), model.bias.copy()
    step, slope = 1e-6, np.zeros((2, 4))
    for i in range(2):
        for j in range(4):
            model.weights[i, j] += step
            slope[i, j] = (loss() - before) / step
            model.weights[i, j] -= step
    weights = model.weights.copy()
    model.fit([(at, share, 1)], epochs=1, rate=0.5)
    assert model.weights == pytest.approx(weights - 0.5 * slope, abs=1e-5) and loss() < before
    assert model.bias[1] > old[1]


# 8 --------------------------------------------------------------------------------------------------------------------


def test_benchmark_windows(spark, rows, docs, clashing, empty):
    long = [r[1] for r in rows if r[1] and len(r[1].split()) > 60]
    items = [(0, " ".join(long[0].split()[5:35])), (1, " ".join(long[3].upper().split()[0:60])), (2, "w1 w2 w3"), (3, None), (4, ""), (5, " ".join(["z", *long[5].split()[10:50]])), (6, " ".join(long[7].split()[0:20] + ["q"] * 20)), (7, "na na na na na na na na na na")]
    bench = spark.createDataFrame(items, "item_id long, text string")
    more = spark.createDataFrame([(800, "x na na na na na na na na na na y"), (801, "a w1 w2 w3 b")], "doc_id long, text string")
    want = {}
    for i, t in [r[:2] for r in rows] + [tuple(r) for r in more.collect()]:
        w = (t or "").lower().split()
        for j, x in items:
            y = (x or "").lower().split()
            k = min(5, len(y))
            if not y:
                continue
            grams = lambda v, k=k: collections.Counter(tuple(v[q : q + k]) for q in range(len(v) - k + 1))
            for s in range(len(w) - len(y) + 1):
                a, b = grams(w[s : s + len(y)]), grams(y)
                sim = sum((a & b).values()) / sum((a | b).values())
                if sim >= 0.8 and sim > want.get((i, j), (0,))[0]:
                    want[i, j] = (sim, s)
    for frame, most in ((docs.select("doc_id", "text").union(more), 200_000), (clashing.unionByName(more, allowMissingColumns=True), 0)):
        got = {(r.doc_id, r.item_id): r for r in benchmark_windows.contaminated(frame, bench, most=most).collect()}
        assert got.keys() == want.keys() and len(got) > 5
        assert all((pytest.approx(r.similarity), r.start) == want[k] for k, r in got.items())
    assert benchmark_windows.contaminated(empty, bench).count() == 0
    assert benchmark_windows.contaminated(docs, bench.limit(0)).count() == 0


def test_texts_shorter_than_the_item(spark):
    rng = np.random.default_rng(4)
    items, texts = [], []
    for n in (6, 14, 50, 120):
        w = [f"v{n}.{x}" for x in rng.integers(0, 10**6, n).tolist()]
        items.append((n, " ".join(w)))
        for cut in (1, 2, n // 10, n // 6, n // 5, n // 4):
            texts += [" ".join(w[: n - cut]), " ".join(w[cut:]), " ".join(w[cut // 2 : n - (cut - cut // 2)])]
        texts.append(" ".join([*w[: n // 2], "other", *w[n // 2 + 2 :]]))
    want = {}
    grams = lambda t: collections.Counter(tuple(t.split()[k : k + 5]) for k in range(len(t.split()) - 4))
    for i, t in enumerate(texts):
        for j, x in items:
            a, b = grams(t), grams(x)
            if a and (a & b).total() >= 0.8 * (a | b).total():
                want[i, j] = ((a & b).total() / (a | b).total(), 0, len(t.split()))
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(2)
    got = benchmark_windows.contaminated(df, spark.createDataFrame(items, "item_id long, text string")).collect()
    assert len(want) > 20 and {(r.doc_id, r.item_id): (r.similarity, r.start, r.n_words) for r in got} == want


def test_an_item_of_thousands_of_words(spark):
    """Copies of a long item with edits, whole, cut and inside longer texts, and texts that share a part alone."""
    rng = np.random.default_rng(12)
    words = lambda n: [f"v{x}" for x in rng.integers(0, 10**6, n).tolist()]
    item = words(5000)

    def edited(w, n):
        w = list(w)
        for at in rng.integers(0, len(w), n).tolist():
            w[at] = "edit"
        return w

    texts = [item, [*words(40), *item, *words(60)], [*words(3), *edited(item, 80), *words(9)], edited(item, 400), item[:4400], item[:3900], [*words(100), *item[:2000]], [*item[300:], *words(280)]]
    grams = lambda w: [tuple(w[k : k + 5]) for k in range(len(w) - 4)]
    own, want = collections.Counter(grams(item)), {}
    for i, w in enumerate(texts):
        g, best = grams(w), (0, 0)
        size = min(len(g), len(own))
        held = collections.Counter(g[:size])
        for s in range(len(g) - size + 1):
            if s:
                held[g[s - 1]] -= 1
                held[g[s + size - 1]] += 1
            if size and (s % 50 == 0 or s < 120):  # every window near the places where the copies begin
                shared = sum(min(n, own[x]) for x, n in held.items() if n > 0 and x in own)
                best = max(best, (shared / (len(own) + size - shared), -s))
        if best[0] >= 0.8:
            want[i] = (best[0], -best[1])
    got = benchmark_windows.contaminated(spark.createDataFrame([(i, " ".join(w)) for i, w in enumerate(texts)], "doc_id long, text string"), spark.createDataFrame([(1, " ".join(item))], "item_id long, text string")).collect()
    assert {r.doc_id: (r.similarity, r.start) for r in got} == {i: (pytest.approx(s), at) for i, (s, at) in want.items()} and sorted(want) == [0, 1, 2, 4, 7]


def test_windows_of_enough_similarity_lie_within_the_radius(spark):
    """Edited copies of items inside longer texts: every pair of similarity 0.8 or more is found, whatever the item's size."""
    rng = np.random.default_rng(9)
    items, texts, want = [], [], set()
    grams = lambda w: collections.Counter(tuple(w[k : k + 5]) for k in range(len(w) - 4))
    for k in range(150):
        n = int(rng.choice([14, 20, 30, 50, 80]))
        w = [f"v{x}" for x in rng.integers(0, 10**6, n).tolist()]
        items.append((k, " ".join(w)))
        for j in range(6):
            v = list(w)
            for _ in range(int(rng.integers(1, max(2, n // 25 + 1)))):
                v[int(rng.choice([0, 1, n - 1, n - 2, int(rng.integers(0, n))]))] = f"e{rng.integers(0, 10**6)}"
            a, b = grams(v), grams(w)
            if (a & b).total() >= 0.8 * (a | b).total():
                want.add((len(texts), k))
            texts.append(" ".join([*(f"p{x}" for x in rng.integers(0, 10**6, 7)), *v, *(f"q{x}" for x in rng.integers(0, 10**6, 9))]))
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    got = {(r.doc_id, r.item_id) for r in benchmark_windows.contaminated(df, spark.createDataFrame(items, "item_id long, text string")).collect()}
    assert len(want) > 400 and want <= got


# 9 --------------------------------------------------------------------------------------------------------------------


def simple_print(w):
    grams = [b" ".join(w[i : i + 3]) for i in range(max(1, len(w) - 2))] if w else []
    h = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def test_simhash(docs, clashing, rows, empty):
    prints = [simple_print(split(t)) for _, t, *_ in rows]
    root = groups(len(rows), lambda x, y: (prints[x] ^ prints[y]).bit_count() <= 3)
    least = collections.defaultdict(list)
    for x, r in enumerate(root):
        if rows[x][0] is not None:
            least[r].append(rows[x][0])
    want = sorted(((rows[x][0], f"{prints[x]:016x}", min(least[r])) for x, r in enumerate(root)), key=key)
    for frame in (docs, clashing):
        assert sorted(map(tuple, simhash_dedup.near_duplicates(frame).collect()), key=key) == want
    assert simhash_dedup.near_duplicates(empty).count() == 0


@pytest.mark.parametrize("block", [4096, 8])
def test_hamming_links_find_all_components(spark, block):
    rng = np.random.default_rng(8)
    seeds = rng.integers(0, 2**63, 12, dtype=np.uint64)
    values = set()
    for s in seeds.tolist():
        for _ in range(25):
            x = s
            for b in rng.integers(0, 64, rng.integers(0, 5)).tolist():
                x ^= 1 << b
            values.add(x)
    values = sorted(values)
    nodes = spark.createDataFrame([(int(np.uint64(x).view(np.int64)),) * 2 for x in values], "node long, fp long")
    links = simhash_dedup.hamming_links(nodes, ["fp"], 3, block)
    got = components.connected_components(links).collect()
    of = {r.node & (2**64 - 1): r.component for r in got}
    root = groups(len(values), lambda i, j: (values[i] ^ values[j]).bit_count() <= 3)
    mine = collections.defaultdict(set)
    for x, r in zip(values, root, strict=True):
        mine[r].add(x)
    theirs = collections.defaultdict(set)
    for x in values:
        theirs[of.get(x, ("alone", x))].add(x)
    assert sorted(map(sorted, mine.values())) == sorted(map(sorted, theirs.values()))


@pytest.mark.parametrize(("shift", "radius"), [(0, 3), (32, 3), (0, 2), (32, 1)])
def test_large_segment_groups_lose_no_link(spark, shift, radius):
    rng = np.random.default_rng(shift + radius)
    seeds = rng.integers(0, 2**32, 300, dtype=np.uint64)
    near = seeds[rng.integers(0, 300, 1500)]
    for _ in range(3):
        near = near ^ (rng.integers(0, 2, 1500, dtype=np.uint64) << rng.integers(0, 32, 1500, dtype=np.uint64))
    fps = np.unique((near << np.uint64(shift)) | (np.uint64(0x9E3779B9) << np.uint64(32 - shift)))
    signed = fps.view(np.int64).tolist()
    links = simhash_dedup.hamming_links(spark.createDataFrame([(x, x) for x in signed], "node long, fp long"), ["fp"], radius, 64).collect()
    at = {x: k for k, x in enumerate(signed)}
    close = [set(np.flatnonzero(np.bitwise_count(fps ^ x) <= radius).tolist()) for x in fps]
    ends = [(at[r.a], at[r.b]) for r in links]
    found = collections.defaultdict(set)
    for a, b in ends:
        found[a].add(b)
    assert groups(len(fps), lambda i, j: j in close[i]) == groups(len(fps), lambda i, j: j in found[i] or i in found[j])


def test_large_segment_groups_are_not_all_pairs(spark):
    n = 50_000
    hot = spark.range(n).select(F.lit(7).cast("long").alias("key"), F.lit(False).alias("asks"), F.col("id").alias("node"))
    hot = hot.withColumn("fp", F.shiftleft(F.xxhash64("node"), 32) + 7)
    plain = simhash_dedup._dealt_blocks(hot, 512).count()
    assert plain > 90 * n
    assert simhash_dedup._dealt_blocks(simhash_dedup._finer(hot, "fp", 3), 512).count() < 5 * n
    assert simhash_dedup._dealt_blocks(hot.withColumn("asks", F.lit(True)), 512).count() == 0


def test_one_of_each(docs, clashing, rows, empty):
    sets = [shingle_set(split(t)) if split(t) else frozenset() for _, t, *_ in rows]
    root = groups(len(rows), lambda x, y: sets[x] == sets[y] or bool(sets[x] and sets[y]) and jaccard(sets[x], sets[y]) >= 0.8)
    order = lambda x: (rows[x][0] is None, rows[x][0] or 0)
    kept = collections.defaultdict(list)
    for x, r in enumerate(root):
        kept[r].append(x)
    want = sorted(str(rows[min(m, key=order)][0]) for m in kept.values())
    for frame in (docs, clashing):
        out = simhash_dedup.one_of_each(frame)
        assert out.columns == frame.columns
        assert sorted(str(r.doc_id) for r in out.collect()) == want
    assert simhash_dedup.one_of_each(empty).count() == 0


def test_one_of_each_finds_added_and_cut_blocks(spark):
    """Every pair of different texts down to similarity 0.8, among texts that share a common passage, against brute force."""
    rng = np.random.default_rng(11)
    common = " ".join(f"c{k}" for k in range(30))
    texts = []
    for n in (40, 150, 600):
        for k in range(25):
            own = [f"t{n}.{k}.{x}" for x in rng.integers(0, 10**6, n).tolist()]
            cut = int(rng.uniform(0.03, 0.17) * n)
            texts += [" ".join(own) + " " + common * (k % 2), " ".join(own[: n - cut]) + " " + common * (k % 2)]
    sets = [shingle_set(split(t)) for t in texts]
    near = [k for k in range(0, len(texts), 2) if jaccard(sets[k], sets[k + 1]) >= 0.8]
    assert len(near) > 50
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    kept = {r.doc_id for r in simhash_dedup.one_of_each(df).collect()}
    assert kept == set(range(len(texts))) - {k + 1 for k in near}


def test_rare_prefix_and_print_cover_the_similarity():
    rng = np.random.default_rng(12)
    levels = rng.integers(0, 20, 1 << simhash_dedup.SLOT_BITS).astype(np.uint8)
    worst = 0
    for n in (5, 6, 10, 50, 400):
        for _ in range(200):
            a = np.unique(rng.integers(0, 2**63, n).astype(np.uint64) * np.uint64(2))
            b = a[np.sort(rng.permutation(n)[: math.ceil(0.8 * n)])]
            assert np.intersect1d(simhash_dedup.rare_prefix(a, levels, 0.8), simhash_dedup.rare_prefix(b, levels, 0.8)).size
            far = simhash_dedup.shingle_print(a, simhash_dedup.PRINT_WORDS) ^ simhash_dedup.shingle_print(b, simhash_dedup.PRINT_WORDS)
            worst = max(worst, int(np.bitwise_count(far).sum()))
    assert worst <= simhash_dedup.PRINT_RADIUS


def test_components(spark):
    chain = [(k, k + 1) for k in range(40)] + [(100, 101), (101, 100), (7, 7), (None, 3), (200, 201), (201, 202), (200, 202)]
    got = {r.node: r.component for r in components.connected_components(spark.createDataFrame(chain, "a long, b long")).collect()}
    assert got == {**dict.fromkeys(range(41), 0), 100: 100, 101: 100, 200: 200, 201: 200, 202: 200}
    assert components.connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


@pytest.mark.parametrize("few", [0, 1 << 19])
def test_components_in_rounds_and_at_once(spark, monkeypatch, few):
    """A long chain in random order, negative ids and stars: the same with and without rounds; few links take one write
    more, none a round."""
    monkeypatch.setattr(components, "FEW_LINKS", few)
    order = np.random.default_rng(4).permutation(300).tolist()
    links = [(order[k], order[k + 1]) for k in range(299)] + [(-5, 1000), (1001, -5), (2000, 2001)]
    written = []
    write = components.materialize
    monkeypatch.setattr(components, "materialize", lambda df, tag: written.append(tag) or write(df, tag))
    got = {r.node: r.component for r in components.connected_components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == dict.fromkeys(range(300), 0) | {-5: -5, 1000: -5, 1001: -5, 2000: 2000, 2001: 2000}
    assert written == ["links", "stars"] if few else len(written) > 3


def test_few_links_are_not_shuffled(spark, monkeypatch):
    """Each shuffle is a stage of all partitions, whose tasks the driver has to keep: few links, repeated ones among them,
    go to their task without one, and what it writes is the result."""
    plans, write = [], components.materialize
    monkeypatch.setattr(components, "materialize", lambda df, tag: plans.append(df._jdf.queryExecution().executedPlan().toString()) or write(df, tag))
    links = spark.createDataFrame([(3, 2), (2, 3), (2, 1), (2, 1), (9, 8), (5, 5), (None, 4)], "a long, b long")
    out = components.connected_components(links)
    assert sorted(out.collect()) == [(1, 1), (2, 1), (3, 1), (8, 8), (9, 8)]
    plans.append(out._jdf.queryExecution().executedPlan().toString())
    assert len(plans) == 3 and not any("Exchange" in x for x in plans)


def test_slot_levels_take_one_shuffle(spark, docs, monkeypatch):
    """Counts of every slot by brute force; each part's are added up in one step."""
    texts = docs.select(F.col("text").cast("binary").alias("_b")).repartition(7)
    words, counts = paragraph_dedup.WordHashes(), np.zeros(1 << simhash_dedup.SLOT_BITS, np.int64)
    for (t,) in texts.collect():
        if split := bytes(t or b"").lower().split():
            grams = np.unique(paragraph_dedup.shingle_hashes([split], words)[0])
            np.add.at(counts, (grams >> np.uint64(64 - simhash_dedup.SLOT_BITS)).astype(np.int64), 1)
    grouped, group = [], type(texts).groupBy
    monkeypatch.setattr(type(texts), "groupBy", lambda self, *c: grouped.append(c) or group(self, *c))
    assert (simhash_dedup.slot_levels(texts) == np.frexp(counts)[1]).all()
    assert grouped == [("part",)]


def test_bands_are_shuffled_once(spark, docs, monkeypatch):
    """Bands are read back from a shuffle, not written and shuffled again to be joined with those that collide."""
    written = {}
    write = paragraph_dedup.materialize

    def seen(df, tag):
        written[tag] = df._jdf.queryExecution().executedPlan().toString()
        return write(df, tag)

    monkeypatch.setattr(paragraph_dedup, "materialize", seen)
    paragraph_dedup.duplicate_paragraphs(docs).count()
    assert "bands" not in written and "REPARTITION_BY_NUM" in written["colliding"]
    assert not [x for x in written["colliding"].splitlines() if "hashpartitioning(key" in x and "REPARTITION_BY_NUM" not in x]


# 10 -------------------------------------------------------------------------------------------------------------------


def test_difference_cover():
    c, v = suffix_dedup.COVER, suffix_dedup.PERIOD
    assert {(a - b) % v for a in c for b in c} == set(range(v))


@pytest.mark.parametrize(("chunk", "bucket", "hot"), [(2 << 20, 6 << 20, 4096), (1500, 400, 4096), (1500, 400, 2), (2 << 20, 6 << 20, 0)])
def test_suffix_dedup(docs, clashing, rows, empty, chunk, bucket, hot):
    length = 200
    texts = [(i, (t or "").encode()) for i, t, *_ in rows]
    count = collections.Counter(t[k : k + length] for _, t in texts for k in range(len(t) - length + 1))
    want = []
    for i, t in texts:
        gone = np.zeros(len(t), bool)
        for k in range(len(t) - length + 1):
            if count[t[k : k + length]] > 1:
                gone[k : k + length] = True
        edges = np.flatnonzero(np.diff(np.r_[False, gone, False].astype(np.int8)))
        left = np.frombuffer(t, np.uint8)[~gone].tobytes()
        want.append((i, len(t), int(gone.sum()), len(edges) // 2, hashlib.sha256(left).hexdigest()))
    got = suffix_dedup.remove_repeats(clashing, chunk_bytes=chunk, bucket_bytes=bucket, hot_samples=hot).collect()
    assert sorted((tuple(r[:5]) for r in got), key=key) == sorted(want, key=key)
    assert all(hashlib.sha256(r.kept).hexdigest() == r.kept_sha256 and len(r.spans) == 2 * r.n_spans for r in got)
    assert suffix_dedup.remove_repeats(empty).count() == 0


@pytest.mark.parametrize(("chunk", "bucket"), [(2 << 20, 6 << 20), (3000, 500)])
def test_suffix_dedup_with_zero_bytes(spark, chunk, bucket):
    """Passages that end in U+0000, texts that end where the zeros begin, and strings of zeros of all lengths."""
    import random

    rng = random.Random(9)
    passage = "".join(rng.choices("abcdefgh", k=125))
    texts = []
    for k in range(60):
        own = "".join(rng.choices("abcdefgh", k=rng.randrange(100, 260)))
        texts.append(own + passage + "\0" * (100 if k % 3 == 0 else k) + (own[::-1] if k % 2 else ""))
    texts += ["\0" * n for n in (0, 1, 150, 199, 200, 201, 260)] + [passage + "\0" * 75, passage + "\0" * 74, passage[1:] + "\0" * 76 + "x"]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(1)
    got = {r.doc_id: r for r in suffix_dedup.remove_repeats(frame, chunk_bytes=chunk, bucket_bytes=bucket).collect()}
    data = [t.encode() for t in texts]
    seen = collections.Counter(d[i : i + 200] for d in data for i in range(len(d) - 199))
    for k, d in enumerate(data):
        gone = {j for i in range(len(d) - 199) if seen[d[i : i + 200]] > 1 for j in range(i, i + 200)}
        left = bytes(b for j, b in enumerate(d) if j not in gone)
        assert (got[k].n_removed, bytes(got[k].kept)) == (len(gone), left), k


def test_long_texts(spark):
    """One text of some megabytes in words, and one of a single huge line without a space."""
    rng = np.random.default_rng(5)
    words = " ".join(f"w{x}" for x in rng.integers(0, 50_000, 400_000).tolist())
    line = "".join(map(chr, rng.integers(97, 123, 300_000).tolist()))
    texts = [words, line, "short text", words[1000:] + " x"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(2)
    got = {r.doc_id: r for r in suffix_dedup.remove_repeats(df, keep_text=False).collect()}
    assert got[0].n_removed == len(words) - 1000 and got[3].n_removed == len(words) - 1000 and got[1].n_removed == got[2].n_removed == 0
    assert {r.doc_id: bool(r.n_linked) for r in paragraph_dedup.duplicate_paragraphs(df).collect()} == {0: True, 1: False, 2: False, 3: True}
    assert {r.doc_id: r.component_id for r in simhash_dedup.near_duplicates(df).collect()} == {0: 0, 1: 1, 2: 2, 3: 0}
    assert {r.doc_id for r in simhash_dedup.one_of_each(df).collect()} == {0, 1, 2}
    assert all(math.isfinite(r.score) for r in context_tree.context_tree_scores(df).collect())
    counts = {r.doc_id: r.n_words for r in quality_rules.judge(df).collect()}
    assert counts == {0: 400_000, 1: 1, 2: 2, 3: len(texts[3].split())}
    marked = df.withColumn("text", F.concat("text", F.lit(" at 10.0.0.1")))
    assert {r.doc_id: (r.n, r.m) for r in pii.pseudonymize(marked, "k", found="n").select("doc_id", "n", F.length("text").alias("m")).collect()}.keys() == {0, 1, 2, 3}
    assert pii.pseudonymize(marked, "k", found="n").filter("n <> 1 or text like '%10.0.0.1'").count() == 0
    item = spark.createDataFrame([(7, " ".join(words.split()[200_000:200_060]))], "item_id long, text string")
    assert {(r.doc_id, r.similarity) for r in benchmark_windows.contaminated(df, item).collect()} == {(0, 1.0), (3, 1.0)}
    urls = df.select(F.col("doc_id").alias("page_id"), F.concat(F.lit("http://a.org/"), "text").alias("url"))
    assert url_filter.judge_urls(urls, url_filter.drawn_pages(urls, tuple("0123456789abcdef"))).filter("verdict = 'block'").count() == 4
    tokenizers = pytest.importorskip("public_tokenizers")
    path = tokenizers.path("byte_bpe_multi_50k.tiktoken")
    assert byte_bpe.encode_texts(df, path, tokenizers.PATTERN, same="same").filter("not same").count() == 0


def test_empty_tables(empty):
    assert context_tree.context_tree_scores(empty).count() == 0
    assert paragraph_dedup.duplicate_paragraphs(empty).count() == 0
    assert pii.pseudonymize(empty, "k", found="n").count() == 0
