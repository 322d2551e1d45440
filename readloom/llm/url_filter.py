"""URL filters: a Bloom filter cascade over listed keys (operator 3), in DataFrame expressions alone.

Level 1 is a Bloom filter of the listed keys. The keys of the corpus that pass it though they are not listed go into
level 2, the listed ones that pass level 2 into level 3, and so on until none passes wrongly. As the corpus's whole
key universe took part, the first level that a key fails tells exactly whether it is listed. The filters are constants
of the plan as long as the first is within MAX_CHARS, so judging rows takes no join. Larger lists are dealt into shards
of about SHARD_KEYS listed keys by the key's hash; a shard's filters, some hundred bytes a level, then meet its rows by
an equi-join on the shard, in which a key of many rows can be split.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from readloom.llm.common import lower_ascii, materialize, spare, table

BITS_PER_KEY, HASHES = 8, 4
#: Six bits a character; a level's constant is at most this long.
MAX_CHARS = 1 << 17
#: Listed keys a shard of larger lists, about.
SHARD_KEYS = 500
#: Rules (verdict, host, path) and the terms that put a host on the list.
RULES = (
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
)
TERMS = ("ads", "adult", "bets", "casino", "pills", "spam")


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path of a URL; both empty if it is null or has no ://."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")
    rest = F.coalesce(rest, F.lit(""))
    return lower_ascii(F.regexp_extract(rest, r"^[^/?#]*", 0)), F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def longest_rule(host: Column, path: Column, rules: tuple = RULES) -> tuple[Column, Column]:
    """The longest fitting rule as host and path in one string, and its verdict; null where none fits."""
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for said, h, p in sorted(rules, key=lambda r: (len(r[1] + r[2]), r[1:])):
        fits = ((host == h) | host.endswith(f".{h}")) & path.startswith(p)
        name, verdict = F.when(fits, h + p).otherwise(name), F.when(fits, said).otherwise(verdict)
    return name, verdict


def _places(key: Column, level: int, bits: Column) -> list[Column]:
    return [F.pmod(F.xxhash64(key, F.lit(level), F.lit(j)), bits) for j in range(HASHES)]


def _passes(key: Column, level: int, bits: Column, filters: Column) -> Column:
    """Whether all of a key's bits are set in a level's filter, binary characters of 48 plus six bits."""

    def has(place: Column) -> Column:
        char = F.ascii(F.substring(filters, (place / 6).cast("long").cast("int") + 1, 1).cast("string")) - 48
        return F.call_function("shiftright", char, (place % 6).cast("int")) % 2 == 1

    return reduce(lambda a, b: a & b, map(has, _places(key, level, bits)))


def build_cascade(listed: DataFrame, universe: DataFrame, key: str = "key", max_chars: int = MAX_CHARS) -> tuple[DataFrame, int, int]:
    """(filters: level, shard, bits, chars; number of levels; number of shards) for distinct keys of both frames.

    Listed keys outside the universe count as part of it. Null keys are never listed.
    """
    a = listed.select(F.col(key).cast("string").alias("key")).filter("key is not null").distinct().withColumn("on", F.lit(True))
    b = universe.select(F.col(key).cast("string").alias("key")).filter("key is not null").distinct().withColumn("on", F.lit(False))
    keys = materialize(a.union(b).groupBy("key").agg(F.max("on").alias("on")), "keys")
    n = keys.filter("on").count()
    shards = -(-n // SHARD_KEYS) if n * BITS_PER_KEY > 6 * max_chars else 1
    keys = keys.withColumn("shard", F.pmod(F.xxhash64("key", F.lit(-1)), F.lit(shards)).cast("int"))
    spark, levels = listed.sparkSession, []
    inside, outside = keys.filter("on"), keys.filter("not on")
    while True:
        level = len(levels) + 1
        sizes = inside.groupBy("shard").agg(F.greatest(F.lit(60), F.count("*") * BITS_PER_KEY).alias("bits"))
        every = spark.range(shards).select(F.col("id").cast("int").alias("shard")).join(sizes, "shard", "left")
        every = every.select("shard", F.ceil(F.coalesce("bits", F.lit(60)) / 6).alias("chars"))
        every = materialize(every.select("shard", "chars", (F.col("chars") * 6).alias("bits")), "level")
        set_bits = inside.join(every, "shard").select("shard", F.explode(F.array(*_places(F.col("key"), level, F.col("bits")))).alias("place"))
        blank = every.select("shard", F.explode(F.sequence(F.lit(0).cast("long"), F.col("chars") - 1)).alias("at"), F.lit(0).alias("v"))
        one = F.call_function("shiftleft", F.lit(1), (F.col("place") % 6).cast("int"))
        marks = set_bits.select("shard", (F.col("place") / 6).cast("long").alias("at"), one.alias("v")).union(blank)
        chars = marks.groupBy("shard", "at").agg(F.bit_or("v").alias("v")).groupBy("shard")
        text = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("at", "v"))), lambda x: F.char(x["v"] + 48)), "")
        made = chars.agg(text.cast("binary").alias("chars")).join(every.select("shard", "bits"), "shard")
        made = materialize(made.select(F.lit(level).alias("level"), "shard", "bits", "chars"), "filters")
        levels.append(made)
        if shards == 1:
            only = made.first()
            passing = outside.filter(_passes(F.col("key"), level, F.lit(only["bits"]), F.lit(bytearray(only["chars"]))))
        else:
            passing = outside.join(made.select("shard", F.col("bits").alias("_b"), F.col("chars").alias("_c")), "shard")
            passing = passing.filter(_passes(F.col("key"), level, F.col("_b"), F.col("_c")))
        wrong = materialize(passing.select("key", "on", "shard"), "wrong")
        if wrong.isEmpty():
            return reduce(DataFrame.union, levels), len(levels), shards
        inside, outside = wrong, inside


def _verdict(passes: list[Column]) -> Column:
    """Listed or not, from the levels' answers: the first level that a key fails decides."""
    out = F.lit(len(passes) % 2 == 1)
    for level in range(len(passes), 0, -1):
        out = F.when(passes[level - 1], out).otherwise(level % 2 == 0)
    return out


def is_listed(rows: DataFrame, key: str, filters: DataFrame, levels: int, shards: int, out: str = "listed") -> DataFrame:
    """rows with a boolean column `out`: whether the key, which must be of the cascade's universe, is listed.

    Null keys are not. Every row stays, with its other columns.
    """
    value = F.col(key).cast("string")
    if shards == 1:
        found = {r["level"]: (r["bits"], bytes(r["chars"])) for r in filters.collect()}
        passes = [_passes(value, k, F.lit(found[k][0]), F.lit(bytearray(found[k][1]))) for k in range(1, levels + 1)]
        return rows.withColumn(out, F.coalesce(_verdict(passes), F.lit(False)) & value.isNotNull())
    wide = filters.groupBy("shard").pivot("level", list(range(1, levels + 1))).agg(F.first("bits").alias("b"), F.first("chars").alias("c"))
    names = [spare(f"_{x}", *rows.columns) for x in wide.columns]
    wide = materialize(wide.toDF(*names), "wide")
    mine = spare("_mine", *rows.columns)
    dealt = rows.withColumn(mine, F.pmod(F.xxhash64(value, F.lit(-1)), F.lit(shards)).cast("int"))
    dealt = dealt.join(wide, F.col(mine) == F.col(names[0]), "left")
    passes = [_passes(value, k, F.col(names[2 * k - 1]), F.col(names[2 * k])) for k in range(1, levels + 1)]
    return dealt.withColumn(out, F.coalesce(_verdict(passes), F.lit(False)) & value.isNotNull()).select(*[c for c in rows.columns if c != out], out)


def pages_of_hosts(pages: DataFrame, terms: tuple = TERMS, url: str = "url") -> DataFrame:
    """A list for judge_urls: the column `key` with the pages (host and path) of hosts with one of the terms as a word."""
    host, path = host_and_path(F.col(url))
    rows = pages.select(host.alias("host"), F.concat(host, path).alias("key")).distinct()
    return rows.filter(F.arrays_overlap(F.split("host", "[.-]"), F.array(*map(F.lit, terms)))).select("key")


def drawn_pages(pages: DataFrame, digits: tuple = ("0",), url: str = "url") -> DataFrame:
    """A list for judge_urls that grows with the corpus: the pages whose md5 begins with one of the hexadecimal digits."""
    host, path = host_and_path(F.col(url))
    rows = pages.select(F.concat(host, path).alias("key")).distinct()
    return rows.filter(F.substring(F.md5("key"), 1, 1).isin(*digits))


def judge_urls(pages: DataFrame, listed: DataFrame, url: str = "url", page_id: str = "page_id", key: str = "key", rules: tuple = RULES) -> DataFrame:
    """One row for each row of pages: page_id, host, path, rule, verdict and listed.

    A URL is blocked or allowed by its longest rule; without one it is blocked if its page is listed, that is, if host
    and path, put together, are in the column `key` of `listed`. The universe of the cascade is the pages of the corpus
    and the list. Null URLs and those without :// have an empty host and path. Other columns are ignored.
    """
    host, path = host_and_path(F.col(url))
    rows = pages.select(F.col(page_id).alias("page_id"), host.alias("host"), path.alias("path"))
    rows = rows.withColumn("page", F.concat("host", "path"))
    universe = rows.select("page").distinct()
    filters, levels, shards = build_cascade(listed.select(F.col(key).alias("page")), universe, "page")
    name, said = longest_rule(F.col("host"), F.col("path"), rules)
    rows = is_listed(rows, "page", filters, levels, shards)
    verdict = F.coalesce(said, F.when(F.col("listed"), "block").otherwise("allow"))
    return rows.select("page_id", "host", "path", name.alias("rule"), verdict.alias("verdict"), "listed")


def op3_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    return judge_urls(pages, pages_of_hosts(pages).union(drawn_pages(pages)))


#: DuckDB SQL for op3_url_filter.
OP3_SQL = r"""
with p as (
  select page_id, case when instr(url, '://') > 0 then substr(url, instr(url, '://') + 3) else '' end as rest from pages
), q as (
  select page_id, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) as path from p
), r as (
  select *, case
    when (host = 'www.example.com' or host like '%.www.example.com') and starts_with(path, '/en/') then 'www.example.com/en/'
    when (host = 'example.com' or host like '%.example.com') and starts_with(path, '/en/') then 'example.com/en/'
    when (host = 'net' or host like '%.net') and starts_with(path, '/es/') then 'net/es/'
    when (host = 'net' or host like '%.net') and starts_with(path, '/fr/') then 'net/fr/'
    when (host = 'com' or host like '%.com') and starts_with(path, '/') then 'com/' end as rule,
    len(list_intersect(string_split(replace(host, '-', '.'), '.'), ['ads', 'adult', 'bets', 'casino', 'pills', 'spam'])) > 0
      or starts_with(md5(host || path), '0') as listed
  from q
)
select page_id, host, path, rule, case
  when rule in ('www.example.com/en/', 'com/') then 'allow'
  when rule is not null then 'block'
  when listed then 'block' else 'allow' end as verdict, listed
from r
"""
