"""Sequence functions as Spark expressions (strings of SQL inside, so that lambdas stay short)."""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def reverse_complement(seq: str | Column) -> Column:
    """Reverse complement of A, C, G, T in either case, case kept; every other character becomes g."""
    plain = F.regexp_replace(F.reverse(_col(seq)), "[^ACGTacgt]", "c")
    return F.translate(plain, "ACGTacgt", "TGCAtgca")


def reverse_complement_text(seq: str) -> str:
    """The same for a Python string, as primers are complemented while the plan is built."""
    pairs = dict(zip("ACGTacgt", "TGCAtgca", strict=True))
    return "".join(pairs.get(c, "g") for c in reversed(seq))


def first_start(seq: str | Column, primers: list[str]) -> Column:
    """0-based start of the first occurrence of any primer, in any case; null if there is none."""
    low = F.lower(_col(seq))
    found = [F.nullif(F.instr(low, p.lower()), F.lit(0)) - 1 for p in primers]
    return found[0] if len(found) == 1 else F.least(*found)


def last_end(seq: str | Column, primers: list[str]) -> Column:
    """End (exclusive) of the last occurrence of any primer, in any case; null if there is none."""
    back, size = F.reverse(F.lower(_col(seq))), F.length(_col(seq))
    found = [size - F.nullif(F.instr(back, p.lower()[::-1]), F.lit(0)) + 1 for p in primers]
    return found[0] if len(found) == 1 else F.greatest(*found)


def all_starts(seq: str | Column, word: str) -> Column:
    """Every 0-based start of a word, overlaps included, in any case.

    The text is cut before each start once; starts are the running lengths of the pieces. Only the first piece may begin
    without the word.
    """
    low, none = F.lower(_col(seq)), F.array().cast("array<int>")
    if not word:
        return F.when(low.isNull(), none).otherwise(F.sequence(F.lit(0), F.length(low)))
    w = word.lower()
    pieces = F.split(low, "(?=" + re.escape(w) + ")", -1)
    begin = F.struct(F.lit(0).alias("at"), none.alias("starts"), F.startswith(low, F.lit(w)).alias("here"))
    step = lambda s, p: F.struct(
        (s["at"] + F.length(p)).alias("at"),
        F.when(s["here"], F.array_append(s["starts"], s["at"])).otherwise(s["starts"]).alias("starts"),
        F.lit(True).alias("here"),
    )
    return F.coalesce(F.aggregate(pieces, begin, step, lambda s: s["starts"]), none)


def search_all(seq: str | Column, words: list[str]) -> Column:
    """Map from each word (lower case) that occurs to its starts."""
    entries = F.array(*[F.struct(F.lit(w.lower()).alias("key"), all_starts(seq, w).alias("value")) for w in dict.fromkeys(words)])
    return F.map_from_entries(F.filter(entries, lambda e: F.size(e["value"]) > 0))


def kmers(seq: str | Column, k: int = 21) -> Column:
    """All substrings of k characters from left to right; none if the sequence is shorter."""
    s = _col(seq)
    places = F.when(F.length(s) >= k, F.sequence(F.lit(1), F.length(s) - k + 1)).otherwise(F.array().cast("array<int>"))
    return F.transform(places, lambda i: F.substring(s, i, F.lit(k)))


def encode(seq: str | Column, n: int) -> Column:
    """array<int>: a 1, t 2, c 3, g 4, anything else 0, in any case; padded with 0 to n, longer input stays longer."""
    digits = F.translate(F.regexp_replace(F.upper(_col(seq)), "[^ATCG]", "0"), "ATCG", "1234")
    padded = F.rpad(digits, F.greatest(F.lit(n), F.length(digits)), F.lit("0"))
    return F.transform(F.split(padded, ""), lambda c: c.cast("int"))


def encode_one_hot(seq: str | Column, n: int) -> Column:
    """array<int> of 4 n places: of each of the first n bases one of four is 1, in the order of encode(); none for other
    letters and past the end. Unlike encode() it puts no base between two others."""
    codes = F.slice(encode(seq, n), 1, n)
    return F.flatten(F.transform(codes, lambda c: F.array(*[(c == k).cast("int") for k in (1, 2, 3, 4)])))


def phred(quality: str | Column) -> Column:
    """array<int> of Phred scores of a quality string (offset 33)."""
    return F.transform(F.split(_col(quality), ""), lambda c: F.ascii(c) - 33)


def rank_quantile(ordered: str | Column, p: float) -> Column:
    """The element at int(p * size) of an ordered array; no interpolation."""
    a = _col(ordered)
    return F.get(a, F.floor(F.size(a) * F.lit(p)).cast("int"))


def distance_score(*values: Column) -> Column:
    """Euclidean norm of the reciprocals; null if a value is 0."""
    return F.sqrt(reduce(lambda a, b: a + b, [F.pow(F.try_divide(F.lit(1.0), v), F.lit(2.0)) for v in values]))


def distance(a: str | Column, b: str | Column) -> Column:
    """Euclidean distance of two arrays of numbers."""
    squares = F.zip_with(_col(a), _col(b), lambda x, y: F.pow(x - y, F.lit(2.0)))
    return F.sqrt(F.aggregate(squares, F.lit(0.0), lambda s, x: s + x))


def log10_count(n: str | Column) -> Column:
    """log10 of a count, 0 for none."""
    return F.when(_col(n) == 0, 0.0).otherwise(F.log10(_col(n)))


def species_name(path: str | Column) -> Column:
    """Species of a FASTA path: base name without .fasta, underscores as spaces."""
    return F.translate(F.regexp_replace(F.element_at(F.split(_col(path), "/"), -1), "[.]fasta$", ""), "_", " ")


def barcode_of(path: str | Column) -> Column:
    return F.regexp_extract(_col(path), "(barcode[^/]*)", 1)


def barcode_name(n: str | Column) -> Column:
    """barcode01 to barcode09, then barcode10 and on."""
    text = _col(n).cast("string")
    return F.concat(F.lit("barcode"), F.when(F.length(text) < 2, F.lpad(text, 2, "0")).otherwise(text))


def register_sql(spark: SparkSession) -> None:
    """Make kmers(seq, k), reverse_complement(seq), encode_bases(seq, n) and the table function kmer_table(seq, k), a row
    (kmer, start) for each k-mer, SQL functions of the session. They are SQL expressions that the optimizer sees through.
    """
    turned = "translate(regexp_replace(reverse(seq), '[^ACGTacgt]', 'c'), 'ACGTacgt', 'TGCAtgca')"
    places = "if(length(seq) >= k, sequence(1, length(seq) - k + 1), cast(array() as array<int>))"
    digits = "translate(regexp_replace(upper(seq), '[^ATCG]', '0'), 'ATCG', '1234')"
    for head, body in (
        ("kmers(seq STRING, k INT) RETURNS ARRAY<STRING>", f"transform({places}, i -> substr(seq, i, k))"),
        ("reverse_complement(seq STRING) RETURNS STRING", turned),
        ("encode_bases(seq STRING, n INT) RETURNS ARRAY<INT>", f"transform(split(rpad({digits}, greatest(n, length(seq)), '0'), ''), c -> int(c))"),
    ):
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {head} RETURN {body}")
    spark.sql(
        "CREATE OR REPLACE TEMPORARY FUNCTION kmer_table(seq STRING, k INT) RETURNS TABLE (kmer STRING, start INT) "
        f"RETURN SELECT substr(seq, i, k), i - 1 FROM explode({places}) AS p(i)"
    )
