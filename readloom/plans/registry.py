"""Registered queries over the given tables, with DuckDB SQL for each that SQL can express."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from readloom.config import LABELS, PRIMERS, RANGES
from readloom.functions import sequences as fn
from readloom.operators import counts, dictionary, models, qc, simulate
from readloom.operators import reads as ops
from readloom.operators.align import align
from readloom.plans import evaluate, runs
from readloom.sources.derived import reads, reads_sql
from readloom.sources.staging import materialize

QUERIES: dict = {}
ORACLES: dict[str, str] = {}
CHERIF = PRIMERS["CHERIF"]
FORWARD, REVERSE_RC = CHERIF["forwards"][0], fn.reverse_complement_text(CHERIF["reverses"][0])
STATS = ("length", "A", "T", "C", "G", "N", "GC", "AT", "Q_Score", "std_QScore", "q25", "q50", "q75", "q90", "ScoreDist")

READS = f"with reads as ({reads_sql('VARCHAR')})"
#: Read statistics in DuckDB; floats as Spark keeps them.
_STATS = """, qs as (
  select *, length(sequence) as length, list_transform(string_split(quality, ''), lambda c: ascii(c) - 33) as q from reads
), os as (
  select *, list_sort(q) as o, length - length(replace(sequence, 'A', '')) as na, length - length(replace(sequence, 'T', '')) as nt,
    length - length(replace(sequence, 'C', '')) as nc, list_sum(q)::DOUBLE / length as mean,
    list_sum(list_transform(q, lambda x: x * x))::DOUBLE / length as sq, len(list_filter(q, lambda x: x < 15)) as low from qs
), es as (
  select *, o[1 + floor(0.25::DOUBLE * length)::INT]::DOUBLE as f25, o[1 + floor(0.5::DOUBLE * length)::INT]::DOUBLE as f50,
    o[1 + floor(0.75::DOUBLE * length)::INT]::DOUBLE as f75, o[1 + floor(0.9::DOUBLE * length)::INT]::DOUBLE as f90,
    na::DOUBLE / length as a_, nt::DOUBLE / length as t_, nc::DOUBLE / length as c_ from os
), stats as (
  select read_idx, id, barcode, sequence, quality, substr(sequence, 1, 50) as prefix, right(sequence, 50) as suffix, length,
    a_::FLOAT as A, t_::FLOAT as T, c_::FLOAT as C, (1 - a_ - t_ - c_)::FLOAT as G, (low::DOUBLE / length)::FLOAT as N,
    (c_ + (1 - a_ - t_ - c_))::FLOAT as GC, (1 - (c_ + (1 - a_ - t_ - c_)))::FLOAT as AT, mean::FLOAT as Q_Score,
    sqrt(greatest(0, sq - mean * mean))::FLOAT as std_QScore, f25::FLOAT as q25, f50::FLOAT as q50, f75::FLOAT as q75, f90::FLOAT as q90,
    sqrt((1 / mean) ** 2 + (1 / f25) ** 2 + (1 / f50) ** 2 + (1 / f75) ** 2 + (1 / f90) ** 2)::FLOAT as ScoreDist
  from es
)"""
_BEGIN = f"instr(lower(sequence), '{FORWARD.lower()}')"
_END = f"length(sequence) - instr(reverse(lower(sequence)), '{REVERSE_RC.lower()[::-1]}') + 1"
_CUT = f""", cut as (
  select read_idx, id, barcode, substr(sequence, b, e - b + 1) as sequence, substr(quality, b, e - b + 1) as quality from (
    select *, {_BEGIN} as b, {_END} as e from reads
    where {_BEGIN} > 0 and instr(reverse(lower(sequence)), '{REVERSE_RC.lower()[::-1]}') > 0
  ) where b - 1 < e
), amplicons as (select * from cut where length(sequence) between {RANGES['CHERIF'][0]} and {RANGES['CHERIF'][1]})"""


def query(sql: str | None = None):
    """Register a query under its function's name."""

    def keep(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return keep


def _ids(df: DataFrame) -> DataFrame:
    return df.select("read_idx", "id")


def stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.with_stats(reads(spark, sf_dir))


def amplicons(spark: SparkSession, sf_dir: str) -> DataFrame:
    return runs.trimmed(reads(spark, sf_dir))


_ROUNDED = ", ".join(f'round("{c}"::DOUBLE, 4) as "{c}"' for c in STATS if c != "length")


@query(f"{READS}{_STATS} select read_idx, id, prefix, suffix, length, {_ROUNDED} from stats")
def read_stats(spark, sf_dir):
    df = stats(spark, sf_dir)
    rounded = [F.round(F.col(c).cast("double"), 4).alias(c) for c in STATS if c != "length"]
    return df.select("read_idx", "id", "prefix", "suffix", "length", *rounded)


@query(f"{READS}{_STATS} select read_idx, id from stats where length between 150 and 160")
def filter_size_absolute(spark, sf_dir):
    return _ids(ops.filter_size(stats(spark, sf_dir), 150.0, 160.0))


@query(f"""{READS}{_STATS}, q as (select quantile_cont(length::DOUBLE, 0.1::DOUBLE)::FLOAT as lo, quantile_cont(length::DOUBLE, 0.9::DOUBLE)::FLOAT as hi from stats)
select read_idx, id from stats, q where length::FLOAT between lo and hi""")
def filter_size_quantile(spark, sf_dir):
    return _ids(ops.filter_size(stats(spark, sf_dir), 0.1, 0.9))


@query(f"{READS}{_STATS} select read_idx, id from stats where Q_Score >= 17.5::FLOAT")
def filter_q(spark, sf_dir):
    return _ids(ops.filter_q(stats(spark, sf_dir), 17.5))


@query(f"""{READS}{_STATS}, q as (select quantile_cont(ScoreDist::DOUBLE, 0.75::DOUBLE)::FLOAT as most from stats)
select read_idx, id from stats, q where ScoreDist <= most""")
def filter_quality(spark, sf_dir):
    return _ids(ops.filter_quality(stats(spark, sf_dir), 0.75))


@query(f"""{READS}{_STATS}, q as (select quantile_cont(N::DOUBLE, 0.5::DOUBLE)::FLOAT as most from stats)
select read_idx, id from stats, q where N <= most""")
def filter_n(spark, sf_dir):
    return _ids(ops.filter_n(stats(spark, sf_dir), 0.5))


@query(f"{READS}{_STATS} select read_idx, id from stats where GC between 0.45::FLOAT and 0.55::FLOAT")
def filter_gc(spark, sf_dir):
    return _ids(ops.filter_gc(stats(spark, sf_dir), 0.45, 0.55))


@query(f"{READS} select read_idx, id from reads qualify row_number() over (partition by substr(sequence, 1, 50) order by read_idx) = 1")
def filter_duplicates(spark, sf_dir):
    return _ids(ops.filter_duplicates(reads(spark, sf_dir)))


@query(f"""{READS}, h as (
  select *, round_even((length(sequence) * 0.1::FLOAT::DOUBLE)::FLOAT::DOUBLE, 0)::INT as h from reads
), c as (select read_idx, id, substr(sequence, h + 1) as s, substr(quality, h + 1) as q from h)
select read_idx, id, substr(s, 1, length(s) - 5) as sequence, substr(q, 1, length(s) - 5) as quality from c where length(s) > 5""")
def crop_head_tail(spark, sf_dir):
    return ops.crop(reads(spark, sf_dir), 0.1, 5.0).select("read_idx", "id", "sequence", "quality")


@query(f"{READS}{_CUT} select read_idx, id, sequence, quality from cut")
def cut_primers(spark, sf_dir):
    return ops.cut_primers(reads(spark, sf_dir), CHERIF["forwards"], CHERIF["reverses"]).select("read_idx", "id", "sequence", "quality")


@query(f"{READS}{_CUT} select barcode, count(*) as n_reads from amplicons group by barcode")
def amplicons_by_barcode(spark, sf_dir):
    return amplicons(spark, sf_dir).groupBy("barcode").agg(F.count("*").alias("n_reads"))


@query(f"""{READS}{_STATS}, q as (select quantile_cont(length::DOUBLE, 0.05::DOUBLE)::FLOAT as l, quantile_cont(ScoreDist::DOUBLE, 0.9::DOUBLE)::FLOAT as d, quantile_cont(N::DOUBLE, 0.8::DOUBLE)::FLOAT as n from stats),
kept as (select stats.* from stats, q where length::FLOAT >= l and length::FLOAT <= 200::FLOAT and ScoreDist <= d and stats.N <= q.n and GC between 0.4::FLOAT and 0.6::FLOAT)
select read_idx, id, substr(sequence, 4) as sequence from kept qualify row_number() over (partition by substr(sequence, 4, 50) order by read_idx) = 1""")
def multi_filter(spark, sf_dir):
    kept = ops.multi_filter(stats(spark, sf_dir), 0.05, 200.0, 0.9, 0.8, head=3.0, min_gc=0.4, max_gc=0.6, duplicated=True)
    return kept.select("read_idx", "id", "sequence")


_KMERS = f"{READS}, k as (select unnest(list_transform(range(1, length(sequence) - 19), lambda i: substr(sequence, i, 21))) as kmer from reads where length(sequence) >= 21)"


@query(f"{_KMERS} select distinct kmer from k")
def kmers_distinct(spark, sf_dir):
    return ops.distinct_kmers(reads(spark, sf_dir))


@query(f"{_KMERS} select kmer, count(*) as n from k group by kmer")
def kmer_counts(spark, sf_dir):
    return ops.kmer_counts(reads(spark, sf_dir))


_RC = "translate(regexp_replace(reverse(sequence), '[^ACGTacgt]', 'c', 'g'), 'ACGTacgt', 'TGCAtgca')"


@query(f"{READS} select read_idx, {_RC} as reversed from reads")
def reverse_complement(spark, sf_dir):
    return reads(spark, sf_dir).select("read_idx", fn.reverse_complement("sequence").alias("reversed"))


@query(f"""{READS} select read_idx, nullif(instr(lower(sequence), '{FORWARD.lower()}'), 0) - 1 as first_start,
length(sequence) - nullif(instr(reverse(lower(sequence)), '{REVERSE_RC.lower()[::-1]}'), 0) + 1 as last_end from reads""")
def primer_positions(spark, sf_dir):
    return reads(spark, sf_dir).select("read_idx", fn.first_start("sequence", [FORWARD]).alias("first_start"), fn.last_end("sequence", [REVERSE_RC]).alias("last_end"))


@query(f"""{READS} select read_idx, w as word, p as start from (
  select read_idx, w, unnest(list_filter(range(0, length(sequence) - length(w) + 1), lambda i: substr(lower(sequence), i + 1, length(w)) = w)) as p
  from reads, (values ('acg'), ('ttaa'), ('cgcg')) v(w))""")
def pattern_search(spark, sf_dir):
    found = reads(spark, sf_dir).select("read_idx", F.explode_outer(fn.search_all("sequence", ["ACG", "TTAA", "CGCG"])).alias("word", "at"))
    return found.select("read_idx", "word", F.explode_outer("at").alias("start")).filter("start is not null").withColumn("start", F.col("start").cast("long"))


@query("""select doc_id, w as word, (length(t) - length(replace(t, w, ''))) // length(w) as n from (select doc_id, lower(text) as t from documents), (values ('tion'), ('ment'), ('the ')) v(w) where t is not null""")
def text_pattern_counts(spark, sf_dir):
    """Occurrences that do not overlap, in texts other than DNA (none of these words overlaps itself)."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").filter("text is not null").select("doc_id", F.lower("text").alias("t"))
    words = F.explode_outer(F.array(*[F.lit(w) for w in ("tion", "ment", "the ")])).alias("word")
    n = ((F.length("t") - F.length(F.replace("t", F.col("word"), F.lit("")))) / F.length("word")).cast("long")
    return docs.select("doc_id", "t", words).select("doc_id", "word", n.alias("n"))


@query(f"""{READS}, p as (select distinct lower(substr(sequence, 30, (16 + read_idx % 9)::INT)) as pattern from reads),
w as (select read_idx, n, lower(sequence) as s, unnest(range(1, length(sequence) - n + 2)) as i from reads, (select distinct length(pattern) as n from p) l)
select read_idx, pattern, i - 1 as start from w, p where length(pattern) = n and substr(s, i, n) = pattern""")
def dictionary_search(spark, sf_dir):
    """A stretch of every read, of 16 to 24 bases, as the patterns; every read is searched for all of them."""
    texts = reads(spark, sf_dir)
    patterns = texts.select(F.expr("substr(sequence, 30, cast(16 + read_idx % 9 as int))").alias("pattern"))
    found = dictionary.search_dictionary(texts, patterns, "read_idx", "sequence")
    return found.withColumn("start", F.col("start").cast("long"))


_CODE = "translate(regexp_replace(upper(sequence), '[^ATCG]', '0', 'g'), 'ATCG', '1234')"


@query(f"{READS} select read_idx, rpad({_CODE}, greatest(160, length(sequence))::INT, '0') as code from reads")
def encode_vector(spark, sf_dir):
    vector = fn.encode("sequence", 160)
    return reads(spark, sf_dir).select("read_idx", F.array_join(F.transform(vector, lambda x: x.cast("string")), "").alias("code"))


@query(f"{READS} select read_idx, id from reads where read_idx in (select user_id from events)")
def semi_by_id(spark, sf_dir):
    ids = spark.read.parquet(f"{sf_dir}/events.parquet").select(F.concat(F.lit("@r"), F.col("user_id").cast("string")).alias("id"))
    return _ids(ops.by_ids(reads(spark, sf_dir), ids))


@query(f"{READS} select id || chr(10) || sequence || chr(10) || '+' || chr(10) || quality as value from reads")
def fastq_text(spark, sf_dir):
    return ops.fastq_lines(reads(spark, sf_dir))


@query(f"{READS} select '>' || substr(id, 2) || chr(10) || sequence as value from reads")
def fasta_text(spark, sf_dir):
    return ops.fasta_lines(reads(spark, sf_dir))


@query(f"{READS} select read_idx, id from reads order by md5('42:' || id), id limit 500")
def sample_reads(spark, sf_dir):
    return _ids(ops.sample(reads(spark, sf_dir), 500))


@query(f"""{READS}, n as (select *, round_even(count(*) over (partition by barcode) * 0.3::DOUBLE, 0)::BIGINT as wanted,
row_number() over (partition by barcode order by md5('42:' || read_idx), read_idx) as k from reads)
select barcode, read_idx from n where k <= wanted""")
def stratified_split(spark, sf_dir):
    return ops.stratified(reads(spark, sf_dir), "barcode", "read_idx", 0.3).select("barcode", "read_idx")


_LABELS = "[" + ", ".join(f"'{x}'" for x in LABELS) + "]"
#: A fixed assignment of the amplicons to species, standing in for a classifier's output.
_HITS = f"{READS}{_CUT}, hits as (select barcode, read_idx, {_LABELS}[1 + read_idx % 11] as species, (read_idx % 100) / 100.0::DOUBLE as p from amplicons)"


def _hits(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.get(F.array(*map(F.lit, LABELS)), (F.col("read_idx") % 11).cast("int"))
    return amplicons(spark, sf_dir).select("barcode", "read_idx", label.alias("species"), ((F.col("read_idx") % 100) / F.lit(100.0)).alias("p"))


@query(f"""{_HITS} select b.barcode, s.species, count(h.read_idx) as n, case when count(h.read_idx) = 0 then 0.0::DOUBLE else round(log10(count(h.read_idx)), 6) end as log10_n,
count(h.read_idx) >= 10 as seen
from (select distinct barcode from reads) b cross join (select unnest({_LABELS}) as species) s
left join (select * from hits where p >= 0.5::DOUBLE) h on h.barcode = b.barcode and h.species = s.species group by all""")
def species_counts_log10(spark, sf_dir):
    # As a classifier says it: a probability for each class, and the predicted one's place.
    place = (F.col("read_idx") % 11).cast("int")
    scored = _hits(spark, sf_dir).withColumns({"prediction": place, "probs": F.transform(F.sequence(F.lit(0), F.lit(10)), lambda k: F.when(k == place, F.col("p")).otherwise(0.0))})
    kept = counts.confident(scored, 0.5)
    species = spark.createDataFrame([(x,) for x in LABELS], "species string")
    return counts.complete_counts(kept, reads(spark, sf_dir), species).withColumn("log10_n", F.round("log10_n", 6))


_WIDE = ", ".join(f"count(*) filter (species = '{x}') as \"{x}\"" for x in LABELS)


@query(f"{_HITS} select barcode, {_WIDE} from hits group by barcode")
def barcode_matrix(spark, sf_dir):
    n = _hits(spark, sf_dir).groupBy("barcode", "species").agg(F.count("*").alias("n"))
    wide = counts.matrix(n, list(LABELS), "n")
    return wide.select("barcode", *[F.col(x).cast("long").alias(x) for x in LABELS])


@query(f"{_HITS} select species, count(*) as n from hits group by species")
def value_counts(spark, sf_dir):
    return counts.value_counts(_hits(spark, sf_dir), "species")


@query(f"{_HITS} select species, {_LABELS}[1 + list_position({_LABELS}, species) % 11] as next_label, list_position({_LABELS}, species) - 1 as code, count(*) as n from hits group by all")
def label_map(spark, sf_dir):
    codes = F.create_map(*[F.lit(x) for k, name in enumerate(LABELS) for x in (name, k)])
    names = F.create_map(*[F.lit(x) for k, name in enumerate(LABELS) for x in (k, name)])
    code = F.element_at(codes, F.col("species"))
    df = _hits(spark, sf_dir).withColumn("code", code).withColumn("next_label", F.element_at(names, (F.col("code") + 1) % 11))
    return df.groupBy("species", "next_label", "code").agg(F.count("*").alias("n")).select("species", "next_label", F.col("code").cast("long").alias("code"), "n")


@query("select quality, count(*) filter (toxic = 0) as \"0\", count(*) filter (toxic = 1) as \"1\" from labels group by quality")
def confusion_matrix(spark, sf_dir):
    return counts.confusion(spark.read.parquet(f"{sf_dir}/labels.parquet"), "quality", "toxic", [0, 1])


@query("select round(avg((quality = toxic)::INT), 6) as recall from labels")
def micro_recall(spark, sf_dir):
    return counts.micro_recall(spark.read.parquet(f"{sf_dir}/labels.parquet"), "quality", "toxic").select(F.round("recall", 6).alias("recall"))


@query("""with c as (select quality::VARCHAR as y, toxic::VARCHAR as p, count(*) as n from labels group by all),
k as (select distinct y as class from c union select distinct p from c),
e as (select class, coalesce(sum(n) filter (y = class), 0) as support, coalesce(sum(n) filter (p = class), 0) as said, coalesce(sum(n) filter (y = class and p = class), 0) as hit from k, c group by class),
s as (select *, coalesce(hit / nullif(said, 0), 0) as precision, coalesce(hit / nullif(support, 0), 0) as recall from e),
f as (select *, coalesce(2 * precision * recall / nullif(precision + recall, 0), 0) as f1 from s)
select class, round(precision, 6) as precision, round(recall, 6) as recall, round(f1, 6) as f1, support::BIGINT as support from f
union all select 'accuracy', round(sum(hit) / sum(support), 6), round(sum(hit) / sum(support), 6), round(sum(hit) / sum(support), 6), sum(support)::BIGINT from f
union all select 'macro avg', round(avg(precision), 6), round(avg(recall), 6), round(avg(f1), 6), sum(support)::BIGINT from f
union all select 'weighted avg', round(sum(precision * support) / sum(support), 6), round(sum(recall * support) / sum(support), 6), round(sum(f1 * support) / sum(support), 6), sum(support)::BIGINT from f""")
def class_report(spark, sf_dir):
    df = counts.class_report(spark.read.parquet(f"{sf_dir}/labels.parquet"), "quality", "toxic")
    return df.select("class", *[F.round(c, 6).alias(c) for c in ("precision", "recall", "f1")], "support")


@query("select 'd' || p as species, round(avg(x), 6) as mean_probability from (select unnest(embedding)::DOUBLE as x, generate_subscripts(embedding, 1) - 1 as p from embeddings) group by p")
def mean_by_class(spark, sf_dir):
    """Means by place in the vectors, which stand in for class probabilities."""
    scored = spark.read.parquet(f"{sf_dir}/embeddings.parquet").select(F.col("embedding").cast("array<double>").alias("probs"))
    size = scored.agg(F.max(F.size("probs"))).first()[0] or 0
    return counts.mean_probability(scored, [f"d{k}" for k in range(size)]).withColumn("mean_probability", F.round("mean_probability", 6))


@query(f"""{_HITS} select s.species, 0.5::DECIMAL(3,2) as threshold, count(h.read_idx) as n_reads_detected
from (select unnest({_LABELS}) as species) s left join (select * from hits where p >= 0.5::DOUBLE) h using (species) group by 1""")
def reads_per_species(spark, sf_dir):
    place = (F.col("read_idx") % 11).cast("int")
    scored = _hits(spark, sf_dir).select(F.transform(F.sequence(F.lit(0), F.lit(10)), lambda k: F.when(k == place, F.col("p")).otherwise(0.0)).alias("probs"))
    return counts.threshold_counts(scored, dict.fromkeys(LABELS, 0.5), list(LABELS))


@query("""with d as (select a.vec_id, b.label, b.vec_id as place, list_sum(list_transform(range(1, len(a.embedding) + 1), lambda i: (a.embedding[i]::DOUBLE - b.embedding[i]::DOUBLE) * (a.embedding[i]::DOUBLE - b.embedding[i]::DOUBLE))) as d
  from embeddings a, embeddings b where a.vec_id % 20 = 0),
r as (select * from d qualify row_number() over (partition by vec_id order by d, place) <= 5),
v as (select vec_id, label, count(*) as n from r group by all)
select vec_id, label as prediction from v qualify row_number() over (partition by vec_id order by n desc, label) = 1""")
def knn_vote(spark, sf_dir):
    """The stated query set (ids divisible by 20) against all rows."""
    points = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    return counts.knn_vote(points.filter("vec_id % 20 = 0"), points, "embedding", "label", "vec_id")


@query("""with u as (select doc_id as k, 'document' as kind from documents union all select item_id, 'item' from benchmark) select kind, count(*) as n, count(distinct k) as n_distinct from u group by kind""")
def union_all(spark, sf_dir):
    a = spark.read.parquet(f"{sf_dir}/documents.parquet").select(F.col("doc_id").alias("k"), F.lit("document").alias("kind"))
    b = spark.read.parquet(f"{sf_dir}/benchmark.parquet").select(F.col("item_id").alias("k"), F.lit("item").alias("kind"))
    return a.unionByName(b).groupBy("kind").agg(F.count("*").alias("n"), F.countDistinct("k").alias("n_distinct"))


@query(f"""{READS}, e as (select unnest(list_transform(string_split(quality, ''), lambda c: ascii(c) - 33)) as q, generate_subscripts(string_split(quality, ''), 1) - 1 as position from reads)
select position, count(*) as n, round(avg(q), 6) as mean_q, median(q)::DOUBLE as median_q from e group by position""")
def qc_per_position(spark, sf_dir):
    df = qc.per_position(reads(spark, sf_dir))
    return df.select(F.col("position").cast("long").alias("position"), "n", F.round("mean_q", 6).alias("mean_q"), "median_q")


@query(f"{READS} select length(sequence) as length, count(*) as n from reads group by all")
def qc_length_histogram(spark, sf_dir):
    return qc.length_histogram(reads(spark, sf_dir)).withColumn("length", F.col("length").cast("long"))


@query(f"{READS} select floor((length(sequence) - length(translate(sequence, 'CG', ''))) * 100::DOUBLE / length(sequence))::BIGINT as gc_percent, count(*) as n from reads group by all")
def qc_gc_histogram(spark, sf_dir):
    return qc.gc_histogram(reads(spark, sf_dir))


@query(f"{READS}{_STATS} select floor(Q_Score)::BIGINT as mean_q, count(*) as n from stats group by all")
def qc_quality_histogram(spark, sf_dir):
    return qc.quality_histogram(stats(spark, sf_dir))


@query(f"{READS} select copies, count(*) as n_sequences from (select count(*) as copies from reads group by sequence) group by copies")
def qc_duplication_levels(spark, sf_dir):
    return qc.duplication_levels(reads(spark, sf_dir))


@query(f"""{READS}, b as (select unnest(string_split(sequence, '')) as base, generate_subscripts(string_split(sequence, ''), 1) - 1 as position from reads)
select position, count(*) as n, {', '.join(f"round(avg((base = '{x}')::INT), 6) as {x}" for x in 'ACGT')}, round(avg((base not in ('A', 'C', 'G', 'T'))::INT), 6) as other from b group by position""")
def qc_base_content(spark, sf_dir):
    df = qc.base_content(reads(spark, sf_dir))
    return df.select(F.col("position").cast("long").alias("position"), "n", *[F.round(c, 6).alias(c) for c in (*qc.BASES, "other")])


@query(f"""{READS}, t as (select count(*) as total from reads)
select substr(sequence, 1, 4) as sequence, count(*) as n, round(count(*) / total, 6) as share from reads, t group by 1, total having count(*) >= 0.004::DOUBLE * total""")
def qc_overrepresented(spark, sf_dir):
    """The beginnings of four bases that one read in 250 has."""
    return qc.overrepresented(reads(spark, sf_dir), 0.004, 4).withColumn("share", F.round("share", 6))


@query(f"""{READS}, a(adapter, seq) as (values ('forward', '{FORWARD}'), ('reverse', '{REVERSE_RC}')), t as (select count(*) as total from reads),
f as (select adapter, instr(sequence, seq) - 1 as position, count(*) as own from reads, a where instr(sequence, seq) > 0 group by all)
select adapter, position, (sum(own) over (partition by adapter order by position))::BIGINT as n, round(sum(own) over (partition by adapter order by position) / total, 6) as share from f, t""")
def qc_adapter_content(spark, sf_dir):
    df = qc.adapter_content(reads(spark, sf_dir), {"forward": FORWARD, "reverse": REVERSE_RC})
    return df.select("adapter", F.col("position").cast("long").alias("position"), "n", F.round("share", 6).alias("share"))


def _references(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A template for each species: its first amplicon. Written, as plans refer to it several times."""
    first = _hits(spark, sf_dir).groupBy("species").agg(F.min("read_idx").alias("_first"))
    found = amplicons(spark, sf_dir).join(F.broadcast(first), F.col("read_idx") == F.col("_first"))
    return materialize(found.select("species", F.col("id").alias("ref_id"), "sequence"), "templates")


@query(f"""{_HITS}, refs as (select species, min(read_idx) as first from hits group by species)
select a.id, r.species from amplicons a, refs r, amplicons t where t.read_idx = r.first and a.sequence = t.sequence""")
def align_reads(spark, sf_dir):
    """Random amplicons share long k-mers only where they are equal, which SQL can say."""
    return align(amplicons(spark, sf_dir), _references(spark, sf_dir)).filter("mapq >= 40").select("id", "species")


@query(f"""{_HITS}, refs as (select species, min(read_idx) as first from hits group by species),
same as (select a.barcode, a.read_idx, r.species from amplicons a, refs r, amplicons t where t.read_idx = r.first and a.sequence = t.sequence)
select b.barcode, s.species, count(h.read_idx) as n, case when count(h.read_idx) = 0 then 0.0::DOUBLE else round(log10(count(h.read_idx)), 6) end as log10_n,
count(h.read_idx) >= 10 as seen
from (select distinct barcode from reads) b cross join (select distinct species from refs) s left join same h on h.barcode = b.barcode and h.species = s.species group by all""")
def mapping_counts(spark, sf_dir):
    return runs.mapping_counts(amplicons(spark, sf_dir), _references(spark, sf_dir), reads(spark, sf_dir)).withColumn("log10_n", F.round("log10_n", 6))


def _errored(template: str, k: str) -> str:
    """SQL of a template without one base and with another one changed, at places that depend on the number k."""
    lost, changed = f"cast(30 + {k} % 20 as int)", f"cast(80 + {k} % 23 as int)"
    kept = f"substr({template}, 1, {lost} - 1) || substr({template}, {lost} + 1, {changed} - {lost} - 1)"
    return f"{kept} || translate(substr({template}, {changed}, 1), 'ACGT', 'CGTA') || substr({template}, {changed} + 1)"


_TURNED = _RC.replace("sequence", "errored")


@query(f"""{_HITS}, refs as (select species, min(read_idx) as first from hits group by species),
t as (select h.read_idx, h.species, a.sequence as template, {_errored('a.sequence', 'h.read_idx')} as errored from hits h join refs r using (species) join amplicons a on a.read_idx = r.first)
select read_idx, species, (read_idx % 2 * 16)::INT as flag, 0 as pos, length(template)::INT as ref_end, levenshtein(errored, template)::INT as nm, true as sure, length(errored)::INT as n_read from t""")
def align_errored_reads(spark, sf_dir):
    """Of every amplicon an errored copy of its species' template, every other one turned round."""
    refs = _references(spark, sf_dir)
    copies = _hits(spark, sf_dir).join(F.broadcast(refs.select("species", F.col("sequence").alias("template"))), "species")
    copies = copies.withColumn("errored", F.expr(_errored("template", "read_idx")))
    turned = F.when(F.col("read_idx") % 2 == 1, fn.reverse_complement("errored")).otherwise(F.col("errored"))
    copies = copies.select("read_idx", F.concat(F.lit("@r"), "read_idx").alias("id"), "barcode", turned.alias("sequence"))
    found = align(copies, refs, k=19, w=5).filter(F.col("flag").bitwiseAND(256 + 2048) == 0)
    used = F.aggregate(F.regexp_extract_all("cigar", F.lit("([0-9]+)[MIS]"), F.lit(1)), F.lit(0), lambda n, x: n + x.cast("int"))
    return found.select("read_idx", "species", "flag", "pos", "ref_end", "nm", (F.col("mapq") >= 40).alias("sure"), used.alias("n_read"))


def _between(df: DataFrame) -> DataFrame:
    """species and the sequence between the primers."""
    return df.select("species", F.expr(f"substr(sequence, {len(FORWARD) + 1}, length(sequence) - {len(FORWARD) + len(REVERSE_RC)})").alias("sequence"))


@query()
def simulated_amplicons(spark, sf_dir):
    """An errored copy of every amplicon."""
    return simulate.errored_amplicons(_between(amplicons(spark, sf_dir).withColumn("species", F.col("id"))), 1)


def _changed(template: str, k: str) -> str:
    """SQL of a template with one base changed, at a place that depends on the number k."""
    at = f"cast(80 + {k} % 23 as int)"
    return f"substr({template}, 1, {at} - 1) || translate(substr({template}, {at}, 1), 'ACGT', 'CGTA') || substr({template}, {at} + 1)"


_COPIES = f"{_HITS}, refs as (select species, min(read_idx) as first from hits group by species), copies as (select h.barcode, h.species, {_changed('a.sequence', 'h.read_idx')} as sequence from hits h join refs r using (species) join amplicons a on a.read_idx = r.first)"
_LEARNT: dict[tuple[str, str], tuple] = {}


def _learnt(spark: SparkSession, sf_dir: str) -> tuple:
    """Of every amplicon a copy of its species' template with one base changed (barcode, read_idx, id, species, sequence,
    quality), and a forest that has learnt their species; made once a session."""
    at = (spark.sparkContext.applicationId, sf_dir)
    if at not in _LEARNT:
        refs = _references(spark, sf_dir).select("species", F.col("sequence").alias("template"))
        copies = _hits(spark, sf_dir).join(F.broadcast(refs), "species").withColumn("sequence", F.expr(_changed("template", "read_idx")))
        copies = copies.select("barcode", "read_idx", F.concat(F.lit("@r"), "read_idx").alias("id"), "species", "sequence", F.expr("repeat('I', length(sequence))").alias("quality"))
        copies = materialize(copies, "copies")
        _LEARNT[at] = copies, models.fit(copies.select("species", fn.encode("sequence", RANGES["CHERIF"][1]).alias("features")), numTrees=20, maxDepth=10)
    return _LEARNT[at]


@query(f"""{_HITS} select b.barcode, s.species, count(h.read_idx) as n, case when count(h.read_idx) = 0 then 0.0::DOUBLE else round(log10(count(h.read_idx)), 6) end as log10_n,
count(h.read_idx) >= 10 as seen
from (select distinct barcode from reads) b cross join (select unnest({_LABELS}) as species) s left join hits h on h.barcode = b.barcode and h.species = s.species group by all""")
def classified_counts(spark, sf_dir):
    """The copies, classified: each is to be counted in its own barcode and species, as SQL counts them."""
    copies, model = _learnt(spark, sf_dir)
    return runs.classified_counts(copies, model, reads(spark, sf_dir), 0.5).withColumn("log10_n", F.round("log10_n", 6))


@query(f"{_COPIES} select barcode, species as prediction, count(*) as n from copies group by all")
def analysed_distribution(spark, sf_dir):
    copies, model = _learnt(spark, sf_dir)
    rows = copies.select("barcode", "read_idx", fn.encode("sequence", RANGES["CHERIF"][1]).alias("features"))
    return evaluate.analyse(model, rows, {LABELS[0]: 0.5})["distribution"]


@query(f"""{_COPIES}, c as (select species as class, count(*) as support from copies group by all union all
select unnest(['accuracy', 'macro avg', 'weighted avg']), count(*) from copies)
select 'train' as part, class, 1.0::DOUBLE as precision, 1.0::DOUBLE as recall, 1.0::DOUBLE as f1, support from c""")
def model_report(spark, sf_dir):
    copies, model = _learnt(spark, sf_dir)
    return models.report(model, {"train": copies.select("species", fn.encode("sequence", RANGES["CHERIF"][1]).alias("features"))})


def _code(features: str) -> F.Column:
    return F.array_join(F.transform(features, lambda x: x.cast("string")), "")


@query(f"{READS}{_CUT} select barcode, rpad({_CODE}, 160, '0') as code, count(*) as n from amplicons group by all")
def barcode_vectors(spark, sf_dir):
    return runs.vectors(amplicons(spark, sf_dir)).groupBy("barcode", _code("features").alias("code")).agg(F.count("*").alias("n"))


@query(f"{_COPIES} select species, rpad({_CODE}, 160, '0') as code, count(*) as n from copies where species = '{LABELS[9]}' group by all")
def real_test_set(spark, sf_dir):
    """Reads that map in one species, as labelled vectors: of the copies those of that species."""
    copies, _ = _learnt(spark, sf_dir)
    found = runs.labelled_reads(copies, _references(spark, sf_dir).filter(F.col("species") == LABELS[9]), LABELS[9])
    return found.groupBy("species", _code("features").alias("code")).agg(F.count("*").alias("n"))


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    return amplicons_by_barcode(spark, sf_dir)
