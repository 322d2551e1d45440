"""Quality rules as a short-circuit cascade (operator 6), in DataFrame expressions alone.

Every rule is a boolean expression over what is measured of a text: its lines, words and counts, each computed once. A
bounded sample gives each rule's cost (steps over characters and lines that it takes beyond what is measured anyway) and
the joint pattern of rejections; the cascade then takes, again and again, the rule that rejects most of what is left per
step. One CASE expression holds the rules in that order, so a text stops at its first failure. The order alters the cost
and which failure is named first, never whether a text is kept; it is the same in every run over the same files.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from readloom.llm.common import materialize, spare, table

SYMBOLS = "#*$%&|<>"
UPPER, DIGITS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789"
#: ASCII white space, what a line ends with as an ellipsis, what it begins with as a bullet.
SPACES, ELLIPSES, BULLETS = " \t\n\v\f\r", ("...", "\u2026"), "-*\u2022\u25E6"
#: Rows that the cascade's order is estimated on, about, and the files that they come from, at most.
SAMPLE_ROWS, SAMPLE_FILES = 20_000, 8
#: Steps of a rule that compares counts at hand, and of trimming and looking at a line.
STEP, LINE_STEPS = 1, 16
_OWN = ("_text", "_words", "_lines", "_full", "_size")


def _count(text: Column, chars: str) -> Column:
    return F.length(text) - F.length(F.translate(text, chars, ""))


def measured(docs: DataFrame, text: str, own: dict[str, str]) -> DataFrame:
    """docs with n_words, word_chars, n_symbols and n_dup_lines, and under the names `own` the text (null: empty), its
    words, lines, lines with a word, and size."""
    df = docs.withColumn(own["_text"], F.coalesce(F.col(text), F.lit("")))
    t = F.col(own["_text"])
    words = F.array_remove(F.split(F.translate(t, SPACES, " " * len(SPACES)), " "), "")
    df = df.withColumns({own["_words"]: words, own["_lines"]: F.split(t, "\n")})
    df = df.withColumn(own["_full"], F.filter(own["_lines"], lambda x: F.btrim(x, F.lit(SPACES)) != ""))
    return df.withColumns({
        own["_size"]: F.length(t), "n_words": F.size(own["_words"]), "word_chars": F.length(F.translate(t, SPACES, "")),
        "n_symbols": _count(t, SYMBOLS), "n_dup_lines": F.size(own["_full"]) - F.size(F.array_distinct(own["_full"])),
    })


def rules(own: dict[str, str] | None = None) -> dict[str, tuple[Column, Column]]:
    """Name -> (expression over measured columns that is true where a text is to be rejected, steps that it takes)."""
    own = own or {x: x for x in _OWN}
    t, size, full = F.col(own["_text"]), F.col(own["_size"]), F.col(own["_full"])
    lines, dense, words = F.size(own["_lines"]), F.col("word_chars"), F.col("n_words")
    one, each = F.lit(STEP), LINE_STEPS * F.size(full)
    last, first = lambda x: F.rtrim(x, F.lit(SPACES)), lambda x: F.ltrim(x, F.lit(SPACES))
    return {
        "symbols": (F.col("n_symbols") * 100 > size * 5, one),
        "exclamations": (_count(t, "!") * 100 > size * 5, size),
        "capitals": (_count(t, UPPER) * 100 > size * 40, size),
        "digits": (_count(t, DIGITS) * 100 > size * 70, size),
        "braces": (_count(t, "{}") * 100 > size * 2, size),
        "no_spaces": (dense * 100 > size * 98, one),
        "word_length": ((dense > words * 20) | (dense < words * 2), one),
        "repeated_lines": ((lines >= 4) & (F.col("n_dup_lines") * 100 > lines * 50), one),
        "ellipses": (F.size(F.filter(full, lambda x: last(x).endswith(ELLIPSES[0]) | last(x).endswith(ELLIPSES[1]))) * 100 > F.size(full) * 30, each),
        "bullets": (F.size(F.filter(full, lambda x: F.substring(first(x), 1, 1).isin(*BULLETS))) * 100 > F.size(full) * 90, each),
    }


def few_files(docs: DataFrame, files: int = SAMPLE_FILES) -> DataFrame:
    """docs, a plain Parquet table, or some of its files where it has more than `files`, spread evenly over all."""
    found = docs._jdf.inputFiles()
    if len(found) <= files:
        return docs
    return docs.sparkSession.read.schema(docs.schema).parquet(*[found[k * len(found) // files] for k in range(files)])


def few_rows(docs: DataFrame, rows: int = SAMPLE_ROWS) -> DataFrame:
    """About `rows` rows of docs, twice as many at most, drawn by a hash of their columns: the same ones each time."""
    n = docs.count()
    draw = F.pmod(F.xxhash64(*docs.columns), F.lit(1_000_003)) < 1_000_003 * rows / max(1, n)
    return docs.filter(draw).limit(2 * rows) if n > rows else docs


def cascade_order(sample: DataFrame, built: dict[str, tuple[Column, Column]]) -> list[str]:
    """Rules by rejection of what is left per step, estimated on measured rows in one job. Of equal rules the one named
    first comes first."""
    flags = [F.coalesce(reject, F.lit(False)).alias(name) for name, (reject, _) in built.items()]
    steps = [F.sum(cost).alias(f"steps_{name}") for name, (_, cost) in built.items()]
    rows = [r.asDict() for r in sample.groupBy(*flags).agg(F.count("*").alias("count"), *steps).collect()]
    cost = {name: max(1, sum(r[f"steps_{name}"] for r in rows)) for name in built}
    order, left = [], list(built)
    while left:
        rejects = {n: sum(r["count"] for r in rows if r[n]) for n in left}
        best = max(left, key=lambda n: (rejects[n] / cost[n], -cost[n]))
        order.append(best)
        left.remove(best)
        rows = [r for r in rows if not r[best]]
    return order


def first_failure(built: dict[str, tuple[Column, Column]], order: list[str]) -> Column:
    """Name of the first rule in order that rejects the text; null if none does. Later rules are not evaluated."""
    found = None
    for name in order:
        reject = built[name][0]
        found = F.when(reject, name) if found is None else found.when(reject, name)
    return found


def _repeated_words(df: DataFrame, words: str) -> DataFrame:
    """df with n_repeat_words: the words in three-word windows that occur twice or more. Windows are named by 64-bit
    hashes, sorted within the row; rows whose windows all differ skip the sort."""
    w, (h, o, p) = words, (spare(x, *df.columns) for x in ("_h", "_s", "_p"))
    window = f"transform(sequence(0, size({w}) - 3), i -> xxhash64({w}[i], {w}[i + 1], {w}[i + 2]))"
    df = df.withColumn(h, F.expr(f"if(size({w}) >= 3, {window}, array(0L))"))
    paired = f"array_sort(transform({h}, (h, i) -> named_struct('h', h, 'i', i)))"
    df = df.withColumn(o, F.expr(f"if(size(array_distinct({h})) = size({h}), slice({paired}, 1, 0), {paired})"))
    twin = f"(k > 0 and {o}[k - 1].h = x.h) or (k + 1 < size({o}) and {o}[k + 1].h = x.h)"
    df = df.withColumn(p, F.expr(f"array_sort(array_compact(transform({o}, (x, k) -> if({twin}, x.i, null))))"))
    grown = "named_struct('last', i, 'n', a.n + least(3, i - a.last))"
    covered = f"aggregate({p}, named_struct('last', -3, 'n', 0), (a, i) -> {grown}, a -> a.n)"
    return df.withColumn("n_repeat_words", F.expr(covered)).drop(h, o, p)


COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def word_statistics(docs: DataFrame, text: str = "text") -> DataFrame:
    """docs with n_words, word_chars, n_symbols, n_dup_lines and n_repeat_words (all long) of each whole text.

    n_repeat_words counts the words in three-word windows that occur twice or more in the text. Null texts count as
    empty.
    """
    own = {x: spare(x, *docs.columns) for x in _OWN}
    df = _repeated_words(measured(docs, text, own), own["_words"]).drop(*own.values())
    return df.withColumns({c: F.col(c).cast("long") for c in COUNTS})


def judge(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", sample: DataFrame | None = None, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """One row for each row of docs: doc_id, the statistics, base_failed, kept and failed_rule.

    base_failed: under 50 words, or over half of them in repeated windows. The cascade judges the others; failed_rule
    is its first failure. Null texts have no words and fail. Repeated rows are judged each; other columns are ignored.
    The order is estimated on about sample_rows rows of `sample`, a part of docs that is cheap to read (docs itself by
    default).
    """
    own = {x: x for x in _OWN}
    built = rules(own)
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("_t"))
    source = rows if sample is None else sample.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("_t"))
    sample = materialize(few_rows(source, sample_rows).select("_t"), "rules")
    order = cascade_order(measured(sample, "_t", own), built)
    df = _repeated_words(measured(rows, "_t", own), own["_words"])
    base = (F.col("n_words") < 50) | (F.col("n_repeat_words") * 100 > F.col("n_words") * 50)
    df = df.withColumn("base_failed", base)
    df = df.withColumn("failed_rule", F.when(~F.col("base_failed"), first_failure(built, order)))
    kept = (~F.col("base_failed") & F.col("failed_rule").isNull()).alias("kept")
    return df.select("doc_id", *[F.col(c).cast("long").alias(c) for c in COUNTS], "base_failed", kept, "failed_rule")


def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return judge(docs, sample=few_files(docs)).drop("failed_rule")


#: DuckDB SQL for op6_quality_rules.
OP6_SQL = r"""
with d as (
  select row_number() over () as rid, doc_id, coalesce(text, '') as t from documents
), e as (
  select *, list_filter(regexp_split_to_array(t, '[\x20\x09-\x0D]+'), lambda x: x <> '') as w,
    list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) as full_lines,
    length(regexp_replace(t, '[\x20\x09-\x0D]+', '', 'g')) as word_chars, length(t) as size,
    length(t) - length(translate(t, '#*$%&|<>', '')) as n_symbols
  from d
), g as (
  select rid, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] as gram
  from (select rid, w, unnest(range(1, len(w) - 1)) as i from e where len(w) >= 3)
), r as (
  select rid, i from g qualify count(*) over (partition by rid, gram) > 1
), c as (
  select rid, count(distinct j) as n from (select rid, unnest([i, i + 1, i + 2]) as j from r) group by rid
), f as (
  select doc_id, t, size, len(w) as n_words, word_chars, n_symbols, len(full_lines) - len(list_distinct(full_lines)) as n_dup_lines,
    len(string_split(t, chr(10))) as n_lines, len(full_lines) as n_full,
    len(list_filter(full_lines, lambda x: regexp_matches(x, '(\.\.\.|\x{2026})[\x20\x09-\x0D]*$'))) as n_ellipses,
    len(list_filter(full_lines, lambda x: regexp_matches(x, '^[\x20\x09-\x0D]*[-*\x{2022}\x{25E6}]'))) as n_bullets, coalesce(c.n, 0) as n_repeat_words
  from e left join c using (rid)
), j as (
  select *, n_words < 50 or 100 * n_repeat_words > 50 * n_words as base_failed from f
)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  not base_failed and not (
    n_symbols * 100 > size * 5 or (size - length(replace(t, '!', ''))) * 100 > size * 5
    or (size - length(translate(t, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', ''))) * 100 > size * 40
    or (size - length(translate(t, '0123456789', ''))) * 100 > size * 70
    or (size - length(translate(t, '{}', ''))) * 100 > size * 2
    or (n_lines >= 4 and n_dup_lines * 100 > n_lines * 50) or word_chars * 100 > size * 98
    or word_chars > n_words * 20 or word_chars < n_words * 2
    or n_ellipses * 100 > n_full * 30 or n_bullets * 100 > n_full * 90
  ) as kept
from j
"""
