"""Format-preserving Feistel pseudonyms for personal data (operator 5), in DataFrame expressions alone.

Numbers that pass their validation (payment cards by check digit, IPv4 by range, US social security numbers by the
issuing rules, international phone numbers by length), calendar dates that exist, and the local part of e-mail
addresses are permuted within their format by a keyed Feistel network: equal values get equal pseudonyms in every
document, different ones different, and the result passes the same validation. The network alternates two halves, adds
to one a keyed SHA-256 of the other modulo its size, and so permutes any product of two ranges without cycle walking.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from readloom.llm.common import spare, table

#: What may be personal, as Java patterns.
OCTET = "(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])"
PATTERNS = {
    "email": "(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:[.][A-Za-z0-9-]++)+",
    "ip": f"(?<![0-9.])(?:{OCTET}[.]){{3}}{OCTET}(?![0-9]|[.][0-9])",
    "date": "(?<![0-9/.-])(?:[12][0-9]{3}-[01][0-9]-[0-3][0-9]|[12][0-9]{3}/[01][0-9]/[0-3][0-9]|[0-3][0-9][.][01][0-9][.][12][0-9]{3})(?![0-9]|[/.-][0-9])",
    "ssn": "(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9]|-[0-9])",
    "phone": "(?<![0-9+])[+][0-9]{1,3}[ .-]?(?:[(][0-9]{2,4}[)]|[0-9]{2,4})[ .-]?[0-9]{3,4}[ .-]?[0-9]{3,4}(?![0-9])"
    "|(?<![0-9+])[+][0-9]{2,3} [0-9](?: [0-9]{2}){4}(?![0-9])",
    "card": "(?<![0-9.+-])(?:[0-9]{4} [0-9]{4} [0-9]{4} [0-9]{4}|[0-9]{4}-[0-9]{4}-[0-9]{4}-[0-9]{4}|[0-9]{13,19})(?![0-9]|[.-][0-9])",
}
KINDS = tuple(PATTERNS)
#: Country calling codes of two digits; those of one are 1 and 7, all others have three.
TWO_DIGIT_CODES = (
    "20 27 30 31 32 33 34 36 39 40 41 43 44 45 46 47 48 49 51 52 53 54 55 56 57 58 60 61 62 63 64 65 66 81 82 84 86 90 91 92 93 94 95 98"
).split()
ROUNDS = 8
_MARK = "\x01"


def _quoted(s: str) -> str:
    return "'" + s.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _prf(key: str, kind: str, value: str, turn: str, size: str) -> str:
    digest = f"sha2(concat_ws(':', {_quoted(key)}, '{kind}', {turn}, {size}, {value}), 256)"
    return f"pmod(cast(conv(substr({digest}, 1, 15), 16, 10) as bigint), {size})"


def feistel(key: str, kind: str, a: str, b: str, size_a: str, size_b: str) -> str:
    """SQL of struct (a, b): the keyed permutation of a pair of numbers below size_a and size_b (bigint expressions)."""
    turns = ", ".join(map(str, range(ROUNDS)))
    left = f"if(r % 2 = 0, pmod(s.a + {_prf(key, kind, 's.b', 'r', size_a)}, {size_a}), s.a)"
    right = f"if(r % 2 = 1, pmod(s.b + {_prf(key, kind, 's.a', 'r', size_b)}, {size_b}), s.b)"
    start = f"named_struct('a', cast({a} as bigint), 'b', cast({b} as bigint))"
    return f"aggregate(array({turns}), {start}, (s, r) -> named_struct('a', {left}, 'b', {right}))"


def _let(value: str, name: str, body: str) -> str:
    """SQL of body with name standing for value, computed once."""
    return f"element_at(transform(array({value}), {name} -> {body}), 1)"


def _digits(key: str, kind: str, d: str) -> str:
    """SQL of a permuted decimal string of the same length (2 to 36 digits)."""
    n, half = f"length({d})", f"cast(floor(length({d}) / 2) as int)"
    size_a, size_b = f"cast(rpad('1', {half} + 1, '0') as bigint)", f"cast(rpad('1', {n} - {half} + 1, '0') as bigint)"
    pair = feistel(key, kind, f"substr({d}, 1, {half})", f"substr({d}, {half} + 1)", size_a, size_b)
    return _let(pair, "q", f"concat(lpad(cast(q.a as string), {half}, '0'), lpad(cast(q.b as string), {n} - {half}, '0'))")


def _filled(shape: str, digits: str) -> str:
    """SQL of `shape` with its digits replaced, in turn, by those of `digits`."""
    step = f"if(c rlike '[0-9]', named_struct('t', concat(z.t, substr({digits}, z.k + 1, 1)), 'k', z.k + 1), named_struct('t', concat(z.t, c), 'k', z.k))"
    return f"aggregate(split({shape}, ''), named_struct('t', '', 'k', 0), (z, c) -> {step}, z -> z.t)"


def _card(key: str, x: str) -> str:
    number = f"regexp_replace({x}, '[ -]', '')"
    payload = _digits(key, "card", "substr(d, 1, length(d) - 1)")
    check = "element_at(filter(array('0', '1', '2', '3', '4', '5', '6', '7', '8', '9'), e -> luhn_check(concat(p, e))), 1)"
    made = _let(payload, "p", _filled(x, f"concat(p, {check})"))
    return f"if(luhn_check({number}), {_let(number, 'd', made)}, {x})"


def _ip(key: str, x: str) -> str:
    pair = feistel(key, "ip", "cast(o[0] as bigint) * 256 + cast(o[1] as bigint)", "cast(o[2] as bigint) * 256 + cast(o[3] as bigint)", "65536L", "65536L")
    made = _let(pair, "q", "concat_ws('.', q.a div 256, q.a % 256, q.b div 256, q.b % 256)")
    return _let(f"split({x}, '[.]')", "o", made)


def _ssn(key: str, x: str) -> str:
    """Areas 001-665 and 667-899, groups 01-99, serials 0001-9999."""
    area = "cast(substr(d, 1, 3) as bigint)"
    a = f"({area} - if({area} > 666, 2, 1)) * 99 + cast(substr(d, 5, 2) as bigint) - 1"
    pair = feistel(key, "ssn", a, "cast(substr(d, 8) as bigint) - 1", "88902L", "9999L")
    number = "q.a div 99 + if(q.a div 99 >= 665, 2, 1)"
    made = _let(pair, "q", f"concat_ws('-', lpad({number}, 3, '0'), lpad(q.a % 99 + 1, 2, '0'), lpad(q.b + 1, 4, '0'))")
    good = f"{x} rlike '^(?!000|666|9)[0-9]{{3}}-(?!00)[0-9]{{2}}-(?!0000)[0-9]{{4}}$'"
    return f"if({good}, {_let(x, 'd', made)}, {x})"


def _date(key: str, x: str) -> str:
    """A date moves within its 400-year cycle from 1000 on: 146,097 = 189 * 773 days. Formats stay."""
    form = f"case when {x} like '____-%' then 'yyyy-MM-dd' when {x} like '____/%' then 'yyyy/MM/dd' else 'dd.MM.yyyy' end"
    day = "datediff(v, date'1000-01-01')"
    pair = feistel(key, "date", f"({day} % 146097) div 773", f"({day} % 146097) % 773", "189L", "773L")
    moved = _let(pair, "q", f"date_add(date'1000-01-01', cast(({day} div 146097) * 146097 + q.a * 773 + q.b as int))")
    read = f"to_date(try_to_timestamp({x}, {form}))"
    return _let(read, "v", f"if(v is null or v < date'1000-01-01' or v >= date'2600-01-01', {x}, date_format({moved}, {form}))")


def _phone(key: str, x: str) -> str:
    """The country code stays and the national digits are permuted, so one number has one pseudonym in every spelling."""
    two = ", ".join(f"'{c}'" for c in TWO_DIGIT_CODES)
    size = f"case when substr(d, 1, 1) in ('1', '7') then 1 when substr(d, 1, 2) in ({two}) then 2 else 3 end"
    made = _let(_digits(key, "phone", "substr(d, cc + 1)"), "p", _filled(x, "concat(substr(d, 1, cc), p)"))
    return _let(f"regexp_replace({x}, '[^0-9]', '')", "d", f"if(length(d) between 8 and 15, {_let(size, 'cc', made)}, {x})")


def _email(key: str, x: str) -> str:
    """Letters and digits of the local part shift within their classes by a Feistel network over its two halves."""
    alphabets = "case when c rlike '[a-z]' then 'abcdefghijklmnopqrstuvwxyz' when c rlike '[A-Z]' then 'ABCDEFGHIJKLMNOPQRSTUVWXYZ' when c rlike '[0-9]' then '0123456789' end"
    digest = f"sha2(concat_ws(':', {_quoted(key)}, 'email', r, i div 32, {{other}}), 256)"
    jump = f"cast(conv(substr({digest}, 2 * (i % 32) + 1, 2), 16, 10) as int)"
    shift = f"case when c rlike '[A-Za-z0-9]' then substr({alphabets}, (locate(c, {alphabets}) - 1 + {jump}) % length({alphabets}) + 1, 1) else c end"

    def turned(mine: str, other: str) -> str:
        return f"array_join(transform(split({mine}, ''), (c, i) -> {shift.format(other=other)}), '')"

    half = "cast(floor(length(l) / 2) as int)"
    start = f"named_struct('a', substr(l, 1, {half}), 'b', substr(l, {half} + 1))"
    left, right = f"if(r % 2 = 0 and s.a <> '', {turned('s.a', 's.b')}, s.a)", f"if(r % 2 = 1, {turned('s.b', 's.a')}, s.b)"
    turns = ", ".join(map(str, range(ROUNDS)))
    network = f"aggregate(array({turns}), {start}, (s, r) -> named_struct('a', {left}, 'b', {right}), s -> concat(s.a, s.b))"
    return f"concat({_let(f"substring_index({x}, '@', 1)", 'l', network)}, '@', substring_index({x}, '@', -1))"


_MAKERS = {"email": _email, "ip": _ip, "date": _date, "ssn": _ssn, "phone": _phone, "card": _card}


def pseudonym(key: str, x: str) -> str:
    """SQL of the pseudonym of x, an expression for a string; x itself where it is nothing of the kinds above."""
    whens = " ".join(f"when {x} rlike {_quoted('^(?:' + PATTERNS[k] + ')$')} then {_MAKERS[k](key, x)}" for k in KINDS)
    return f"case {whens} else {x} end"


def pseudonymize(docs: DataFrame, key: str, text: str = "text", found: str | None = None) -> DataFrame:
    """docs with the personal data in `text` replaced; `found`, if named, becomes an int column of replaced places.

    Null texts stay null and have none found. Everything else in a text, white space included, stays as it is; rows and
    other columns too. A candidate that fails its validation stays. The key is a secret: pass your own.
    """
    any_kind = "|".join(f"(?:{p})" for p in PATTERNS.values())
    # Marks set candidates apart; a text that has the mark already gets one with its own digest, which it cannot have.
    t, (mark, old, new) = f"`{text}`", (spare(x, *docs.columns, found or "") for x in ("_mark", "_old", "_new"))
    df = docs.withColumn(mark, F.expr(f"if(contains({t}, {_quoted(_MARK)}), concat({_quoted(_MARK)}, md5({t})), {_quoted(_MARK)})"))
    marked = f"regexp_replace({t}, {_quoted(any_kind)}, concat({mark}, '$0', {mark}))"
    df = df.withColumn(old, F.expr(f"split({marked}, {mark}, -1)"))
    df = df.withColumn(new, F.expr(f"if(size({old}) > 1, transform({old}, (x, i) -> if(i % 2 = 1, {pseudonym(key, 'x')}, x)), {old})"))
    if found:
        df = df.withColumn(found, F.expr(f"if(size({old}) > 1, size(filter(zip_with({old}, {new}, (a, b) -> a <> b), e -> e)), 0)").cast("int"))
    return df.withColumn(text, F.expr(f"if({t} is null, null, array_join({new}, ''))")).drop(mark, old, new)


#: The registered query's key; a real run passes a secret of its own.
QUERY_KEY = "query-key"


def op5_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return pseudonymize(docs, QUERY_KEY, found="n_replaced").select("doc_id", "n_replaced", "text")
