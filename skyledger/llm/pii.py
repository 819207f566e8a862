"""Format-preserving pseudonyms for personal numbers, dates and addresses (operator 10).

DataFrame functions only.  A value that passes its format's checks is replaced by another
of the same format, found by a keyed Feistel network; the map is one to one within a
format, so equal values stay equal in all documents and different ones stay different.

email     letters and digits of all but the last label, each within its class
phone     the last ten digits (a country code stays), whatever separates them
card      13 to 19 digits with a right Luhn digit; all but that digit, which is computed anew
iban      right remainder by 97 and, for the countries listed, the country's length; account part permuted within its classes, check digits computed anew
ssn       area 001-899 but 666, group 01-99, serial 0001-9999; permuted in that range
ipv4      four numbers to 255
date      1800 to 2199 as y-m-d, y/m/d, d.m.y, or m/d/y (d/m/y where that is no date); permuted among the 146,097 days

Digits that fail the check (a number without a right Luhn digit, 2023-02-30) stay.  Other numbers or capital words may stand
beside a card or an account number: where a match fails, its shorter beginnings are tried, longest first, at its separators, and
then the search goes on behind its first group, so that no value is lost with a match that begins before it or ends behind it.
A text with such a match is scanned match by match in stretches that no match crosses; the others need one pass.  A null text stays null; an empty one
stays empty; repeated rows are treated alike; other columns are kept; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from skyledger.llm.common import documents

KEY = "demonstration key"  # of the query alone
ROUNDS = 10

OCTET = "(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]?[0-9])"
FORMATS = {
    "email": r"(?<![A-Za-z0-9._%+\-])[A-Za-z0-9._%+\-]++@[A-Za-z0-9\-]+(?:\.[A-Za-z0-9\-]+){0,8}\.[A-Za-z]{2,}",
    "iban": r"(?<![0-9A-Za-z])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,4})?(?![0-9A-Za-z])",
    "ipv4": rf"(?<![0-9A-Za-z.]){OCTET}(?:\.{OCTET}){{3}}(?!\.?[0-9A-Za-z])",
    "date": r"(?<![0-9A-Za-z])(?:[0-9]{4}-[0-9]{2}-[0-9]{2}|[0-9]{4}/[0-9]{2}/[0-9]{2}|[0-9]{2}\.[0-9]{2}\.[0-9]{4}|[0-9]{2}/[0-9]{2}/[0-9]{4})(?![0-9A-Za-z])",
    "ssn": r"(?<![0-9A-Za-z\-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9A-Za-z\-])",
    "phone": r"(?<![0-9A-Za-z])(?:\+[0-9]{1,3}[ .\-]?)?(?:\([0-9]{3}\)[ .\-]?|[0-9]{3}[ .\-])[0-9]{3}[ .\-][0-9]{4}(?![0-9A-Za-z])",
    "card": r"(?<![0-9A-Za-z])[0-9](?:[ \-]?[0-9]){12,18}(?![0-9A-Za-z])",
}
ANY = "|".join(FORMATS.values())
#: Where no match begins before and ends behind: line starts, and small letters after a space (an address by mail has no space).
CUT = r"(?<=\n)|(?<= )(?=[a-z])"
IBAN_LENGTHS = dict(zip((
    "AD AE AL AT AZ BA BE BG BH BR BY CH CR CY CZ DE DK DO EE EG ES FI FO FR GB GE GI GL GR GT HR HU IE IL IQ IS IT JO KW KZ LB LC LI LT LU LV "
    "LY MC MD ME MK MR MT MU NL NO PK PL PS PT QA RO RS SA SC SD SE SI SK SM ST SV TL TN TR UA VA VG XK").split(), map(int, (
        "24 23 28 20 28 20 16 22 22 29 28 21 22 28 24 22 18 28 20 29 24 18 18 27 22 22 23 18 27 28 21 28 22 23 23 26 27 30 30 20 28 32 21 20 20 21 "
        "25 27 24 22 19 27 31 30 18 15 24 28 29 25 29 24 22 24 31 18 24 19 24 27 25 28 23 24 26 29 22 24 20").split()), strict=True))
#: Characters that a scan looks at first, and more than a match other than an address by mail has (that one has no space).
WINDOW, LONGEST = 2048, 64
#: Days of the Gregorian cycle from 1800-01-01, as a product for the two halves of the network.
DAYS = (189, 773)


def _literal(s: str) -> str:
    return "'" + s.replace("\\", "\\\\").replace("'", "\\'") + "'"


class _Sql:
    """SQL fragments for one key; ``x`` and the like are fragments themselves."""

    def __init__(self, key: str):
        self.key = _literal(key)

    def draw(self, tag: str, *parts: str) -> str:
        """A keyed pseudo-random number below 2 to the 60."""
        joined = ", ".join(f"CAST({p} AS STRING)" for p in parts)
        return f"CAST(conv(substr(sha2(concat_ws('|', {self.key}, '{tag}', {joined}), 256), 1, 15), 16, 10) AS BIGINT)"

    def letters(self, s: str, tag: str) -> str:
        """Feistel network over characters: each round shifts one half's within their classes, by a draw from the other half."""
        def turn(first: str, last: str, n: int) -> str:
            return (f"WHEN c BETWEEN '{first}' AND '{last}' THEN char({ord(first)} + CAST((ascii(c) - {ord(first)} + "
                    f"{self.draw(tag, 'k', 'i', 'a.r')}) % {n} AS INT))")
        moved = f"array_join(transform(split(a.l, ''), (c, i) -> CASE {turn('0', '9', 10)} {turn('a', 'z', 26)} {turn('A', 'Z', 26)} ELSE c END), '')"
        return (f"aggregate(sequence(1, {ROUNDS}), named_struct('l', left({s}, length({s}) div 2), 'r', substring({s}, 1 + CAST(length({s}) div 2 AS INT))), "
                f"(a, k) -> named_struct('l', a.r, 'r', {moved}), a -> concat(a.l, a.r))")

    def pair(self, left: str, right: str, sizes: tuple[int, int], tag: str, then: str) -> str:
        """Feistel network over a pair of numbers below ``sizes``; ``then`` reads the result as a.l and a.r."""
        odd = f"named_struct('l', (a.l + {self.draw(tag, 'k', 'a.r')}) % {sizes[0]}L, 'r', a.r)"
        even = f"named_struct('l', a.l, 'r', (a.r + {self.draw(tag, 'k', 'a.l')}) % {sizes[1]}L)"
        return (f"aggregate(sequence(1, {ROUNDS}), named_struct('l', CAST({left} AS BIGINT), 'r', CAST({right} AS BIGINT)), "
                f"(a, k) -> IF(k % 2 = 1, {odd}, {even}), a -> {then})")


def _digits(x: str) -> str:
    return f"regexp_replace({x}, '[^0-9]', '')"


def _put(x: str, digits: str) -> str:
    """``x`` with its digits replaced in turn; ``digits`` is evaluated once."""
    into = f"CASE WHEN c BETWEEN '0' AND '9' THEN substring(d, length({_digits(f'left({x}, i)')}) + 1, 1) ELSE c END"
    return f"element_at(transform(array({digits}), d -> array_join(transform(split({x}, ''), (c, i) -> {into}), '')), 1)"


def _luhn(d: str) -> str:
    """Sum by Luhn's rule, the last digit counting single."""
    at = f"CAST(substring({d}, i, 1) AS INT)"
    return (f"aggregate(sequence(1, length({d})), 0, (s, i) -> s + CASE WHEN (length({d}) - i) % 2 = 0 THEN {at} "
            f"WHEN {at} > 4 THEN 2 * {at} - 9 ELSE 2 * {at} END)")


def _mod97(s: str) -> str:
    """Remainder of a string of digits and capitals, a capital counting 10 to 35."""
    return (f"aggregate(split({s}, ''), 0, (n, c) -> CASE WHEN c BETWEEN '0' AND '9' THEN (n * 10 + ascii(c) - 48) % 97 "
            f"WHEN c BETWEEN 'A' AND 'Z' THEN (n * 100 + ascii(c) - 55) % 97 ELSE n END)")


def _days_in(y: str, m: str) -> str:
    leap = f"({y} % 4 = 0 AND ({y} % 100 <> 0 OR {y} % 400 = 0))"
    return f"CASE WHEN {m} = 2 THEN IF({leap}, 29, 28) WHEN {m} IN (4, 6, 9, 11) THEN 30 ELSE 31 END"


def _date_parts(x: str) -> tuple[str, str, str, str]:
    """Year, month, day and the output pattern of a date's text."""
    n = lambda a, k: f"CAST(substring({x}, {a}, {k}) AS INT)"
    year_first = f"substring({x}, 5, 1) IN ('-', '/')"
    month_first = f"(substring({x}, 3, 1) = '/' AND {n(1, 2)} <= 12)"
    y = f"IF({year_first}, {n(1, 4)}, {n(7, 4)})"
    m = f"CASE WHEN {year_first} THEN {n(6, 2)} WHEN {month_first} THEN {n(1, 2)} ELSE {n(4, 2)} END"
    d = f"CASE WHEN {year_first} THEN {n(9, 2)} WHEN {month_first} THEN {n(4, 2)} ELSE {n(1, 2)} END"
    out = (f"CASE WHEN {year_first} THEN concat('yyyy', substring({x}, 5, 1), 'MM', substring({x}, 5, 1), 'dd') WHEN {month_first} THEN 'MM/dd/yyyy' "
           f"ELSE concat('dd', substring({x}, 3, 1), 'MM', substring({x}, 3, 1), 'yyyy') END")
    return y, m, d, out


def _iban(x: str, unlisted: str = "true") -> str:
    bare = f"replace({x}, ' ', '')"
    lengths = ", ".join(f"'{c}', {n}" for c, n in IBAN_LENGTHS.items())
    fits = f"coalesce(try_element_at(map({lengths}), left({x}, 2)) = length({bare}), {unlisted})"
    return f"{_mod97(f'concat(substring({bare}, 5), left({bare}, 4))')} = 1 AND {fits}"


def _card(x: str) -> str:
    return f"length({_digits(x)}) BETWEEN 13 AND 19 AND {_luhn(_digits(x))} % 10 = 0"


def _fits(x: str, *formats: str) -> str:
    whole = "|".join(FORMATS[f] for f in formats)
    return f"{x} RLIKE r'^(?:{whole})$'"


def kind(x: str) -> str:
    """The format of a match whose checks it passes, else null."""
    y, m, d, _ = _date_parts(x)
    valid_date = f"(CASE WHEN {y} BETWEEN 1800 AND 2199 AND {m} BETWEEN 1 AND 12 THEN {d} BETWEEN 1 AND {_days_in(y, m)} ELSE false END)"
    area = f"substring({x}, 1, 3)"
    ssn = f"{area} <> '000' AND {area} <> '666' AND {area} < '900' AND substring({x}, 5, 2) <> '00' AND substring({x}, 8, 4) <> '0000'"
    return (f"CASE WHEN contains({x}, '@') THEN 'email' "
            f"WHEN {x} RLIKE '^[A-Z]' THEN IF({_iban(x)}, 'iban', NULL) "
            f"WHEN {_fits(x, 'ipv4')} THEN 'ipv4' "
            f"WHEN {_fits(x, 'date')} THEN IF({valid_date}, 'date', NULL) "
            f"WHEN {_fits(x, 'ssn')} THEN IF({ssn}, 'ssn', NULL) "
            f"WHEN {_fits(x, 'phone')} THEN 'phone' "
            f"WHEN {_card(x)} THEN 'card' END")


def pseudonym(x: str, k: str, key: str) -> str:
    """SQL for the replacement of a match ``x`` of kind ``k`` (itself where that is null)."""
    q = _Sql(key)
    digits = _digits(x)
    end = f"length(regexp_extract({x}, '[.][A-Za-z]+$', 0))"
    email = f"concat({q.letters(f'left({x}, length({x}) - {end})', 'email')}, right({x}, {end}))"
    phone = _put(x, f"concat(left({digits}, length({digits}) - 10), {q.letters(f'right({digits}, 10)', 'phone')})")
    zero = "concat(b, '0')"
    card = _put(x, f"element_at(transform(array({q.letters(f'left({digits}, length({digits}) - 1)', 'card')}), b -> concat(b, (10 - {_luhn(zero)} % 10) % 10)), 1)")
    tail = f"substring({x}, 5)"
    check = f"lpad(CAST(98 - {_mod97(f'''concat(b, left({x}, 2), '00')''')} AS STRING), 2, '0')"
    iban = f"element_at(transform(array({q.letters(tail, 'iban')}), b -> concat(left({x}, 2), {check}, b)), 1)"
    area = f"CAST(substring({x}, 1, 3) AS INT)"
    group_at = f"(({area} - IF({area} > 666, 2, 1)) * 99 + CAST(substring({x}, 5, 2) AS INT) - 1)"
    back = "CAST(a.l div 99 AS INT) + IF(a.l div 99 >= 665, 2, 1)"
    ssn = q.pair(group_at, f"CAST(substring({x}, 8, 4) AS INT) - 1", (898 * 99, 9999), "ssn",
                 f"concat(lpad({back}, 3, '0'), '-', lpad(a.l % 99 + 1, 2, '0'), '-', lpad(a.r + 1, 4, '0'))")
    part = lambda i: f"CAST(split({x}, '[.]')[{i}] AS INT)"
    ipv4 = q.pair(f"{part(0)} * 256 + {part(1)}", f"{part(2)} * 256 + {part(3)}", (65536, 65536), "ipv4",
                  "concat_ws('.', a.l div 256, a.l % 256, a.r div 256, a.r % 256)")
    y, m, d, pattern = _date_parts(x)
    day = f"datediff(make_date({y}, {m}, {d}), DATE'1800-01-01')"
    # month-first and day-first are told apart by the value; the order seen stays
    date = q.pair(f"{day} div {DAYS[1]}", f"{day} % {DAYS[1]}", DAYS, "date",
                  f"element_at(transform(array(date_add(DATE'1800-01-01', CAST(a.l * {DAYS[1]} + a.r AS INT))), t -> "
                  f"replace(replace(replace({pattern}, 'yyyy', date_format(t, 'yyyy')), 'MM', date_format(t, 'MM')), 'dd', date_format(t, 'dd'))), 1)")
    return (f"CASE {k} WHEN 'email' THEN {email} WHEN 'phone' THEN {phone} WHEN 'card' THEN {card} WHEN 'iban' THEN {iban} "
            f"WHEN 'ssn' THEN {ssn} WHEN 'ipv4' THEN {ipv4} WHEN 'date' THEN {date} ELSE {x} END")


def _let(value: str, name: str, then: str) -> str:
    """``then`` with ``name`` bound to ``value``, which is evaluated once."""
    return f"element_at(transform(array({value}), {name} -> {then}), 1)"


def opened(x: str, k: str) -> str:
    """Whether a match ``x`` of kind ``k`` failed as a card or an account number, so that other values may lie in it."""
    return f"({k} IS NULL AND NOT {_fits(x, 'date', 'ssn')})"


def beginning(x: str) -> str:
    """The longest shorter beginning of a failed match, up to a separator, that is a card or a listed country's account number: kind and x, or null."""
    cut = f"filter(transform(sequence(length({x}) - 1, 1), n -> IF(substring({x}, n + 1, 1) IN (' ', '-'), left({x}, n), NULL)), y -> y IS NOT NULL)"
    k = f"CASE WHEN y RLIKE '^[A-Z]' THEN IF({_fits('y', 'iban')} AND {_iban('y', 'false')}, 'iban', NULL) WHEN {_card('y')} THEN 'card' END"
    return f"try_element_at(filter(transform({cut}, y -> named_struct('x', y, 'kind', {k})), z -> z.kind IS NOT NULL), 1)"


def scanned(stretch: str) -> str:
    """Array of (plain, x, kind): the text before each value of a stretch and the value, then what is left with an empty value.

    ``rest`` is what lies ahead and one character before it, for the patterns to look back at (a line end in front of all).
    """
    ahead = rf"(?!^)(?:{ANY})"
    starts = f"size(regexp_extract_all({stretch}, r'(?=(?:{ANY}))', 0))"
    whole = f"named_struct('x', m, 'kind', {kind('m')})"
    found = _let(whole, "w", f"IF({opened('w.x', 'w.kind')}, coalesce({beginning('w.x')}, w), w)")
    # what is passed: up to the end of a value or of a date or number of no format, else only the first character of the match
    passed = "p + IF({open}, 1, length(f.x))".format(open=opened("f.x", "f.kind"))
    valid = "named_struct('plain', concat(a.plain, substring(a.rest, 2, p - 1)), 'x', f.x, 'kind', f.kind)"
    moved = (f"named_struct('rest', substring(a.rest, n), 'plain', IF(f.kind IS NULL, concat(a.plain, substring(a.rest, 2, n - 1)), ''), "
             f"'done', IF(f.kind IS NULL, a.done, concat(a.done, array({valid}))))")
    step = _let(found, "f", _let(passed, "n", moved))
    # matched in a window that ends with a space, or in all that is left where the match may depend on what lies behind it
    step = _let(f"length(split(u, r'{ahead}', 2)[0])", "p", step)
    step = _let(f"regexp_extract(u, r'{ahead}', 0)", "m", f"IF(m = '', a, {step})")
    inside = f"regexp_like(v, r'{ahead}') AND length(split(v, r'{ahead}', 2)[0]) + {LONGEST} < length(v)"
    window = f"IF(octet_length(a.rest) > {WINDOW}, regexp_extract(left(a.rest, {WINDOW}), '(?s)^.* ', 0), '')"
    step = _let(_let(window, "v", f"IF({inside}, v, a.rest)"), "u", step)
    none = "CAST(array() AS ARRAY<STRUCT<plain: STRING, x: STRING, kind: STRING>>)"
    end = "concat(a.done, array(named_struct('plain', concat(a.plain, substring(a.rest, 2)), 'x', '', 'kind', CAST(NULL AS STRING))))"
    return (f"aggregate(slice(sequence(0, {starts}), 2, {starts}), named_struct('rest', concat('\\n', {stretch}), 'plain', '', 'done', {none}), "
            f"(a, i) -> {step}, a -> {end})")


def replaced(found: str, key: str) -> Column:
    """Array of (plain, kind, value) for an array column of (plain, x, kind)."""
    return F.expr(f"transform({found}, m -> named_struct('plain', m.plain, 'kind', m.kind, 'value', {pseudonym('m.x', 'm.kind', key)}))")


def pseudonymise(docs: DataFrame, key: str) -> DataFrame:
    """``docs`` with its text rewritten, and ``n_<format>`` columns of replaced values (which shadow columns of those names)."""
    # the columns of ``docs`` travel in one, whatever their names are
    marked = docs.select(F.struct("*").alias("row"), F.col("text").alias("text"))
    marked = marked.withColumn("found", F.regexp_extract_all(F.coalesce(F.col("text"), F.lit("")), F.lit(ANY), F.lit(0)))
    marked = marked.withColumn("kinds", F.expr(f"transform(found, x -> named_struct('x', x, 'kind', {kind('x')}))"))
    between = F.split(F.col("text"), ANY, -1)
    once = F.zip_with(between, F.concat("kinds", F.expr("array(named_struct('x', '', 'kind', CAST(NULL AS STRING)))")),
                      lambda a, b: F.struct(a.alias("plain"), b["x"].alias("x"), b["kind"].alias("kind")))
    again = F.expr(f"flatten(transform(split(text, r'{CUT}', -1), s -> {scanned('s')}))")
    parts = F.when(F.size("found") > 0, F.when(F.expr(f"exists(kinds, m -> {opened('m.x', 'm.kind')})"), again).otherwise(once))
    marked = marked.withColumn("parts", parts).withColumn("hits", replaced("parts", key))
    glued = F.array_join(F.transform("hits", lambda h: F.concat(h["plain"], h["value"])), "")
    count = lambda f: F.coalesce(F.size(F.filter("hits", lambda h: h["kind"] == f)), F.lit(0)).cast("long")
    out = marked.withColumn("rewritten", F.when(F.col("hits").isNull(), F.col("text")).otherwise(glued))
    counts = [F.when(F.col("hits").isNull(), F.lit(0).cast("long")).otherwise(count(f)).alias(f"n_{f}") for f in FORMATS]
    names = [c for c in docs.columns if c not in {f"n_{f}" for f in FORMATS}]
    return out.select(*[F.col("rewritten").alias("text") if c == "text" else F.col("row")[c].alias(c) for c in names], *counts)


def op10_pii_pseudonyms(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pseudonymise(documents(spark, sf_dir).select("doc_id", "text"), KEY)
