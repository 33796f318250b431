"""Operator 7: format-preserving pseudonyms for personal data.

Candidates are found by pattern and validated (check digits, value ranges,
calendar).  A valid value is permuted inside its own format by a keyed Feistel
network, so equal values get equal pseudonyms in every document, different
values different ones, and every pseudonym is again a valid value.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeforge.llm.common import ROW, let, text_of, wrap

ROUNDS = 8
#: days from 1900-01-01 to 2099-12-31: 73049 = 17 * 4297
DAYS_A, DAYS_B = 17, 4297

MAIL = r"[A-Za-z0-9][A-Za-z0-9._%+-]*@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*\.[A-Za-z]{2,}"
IPV4 = r"\d{1,3}\.\d{1,3}\.\d{1,3}\.\d{1,3}"
ISO = r"(?:19|20)\d\d-\d\d-\d\d"
SLASHED = r"\d\d[/.]\d\d[/.](?:19|20)\d\d"
SSN = r"\d{3}-\d\d-\d{4}"
PHONE = r"\+\d{1,3}[ -]?(?:\(\d{2,4}\)|\d{2,4})(?:[ .-]?\d{2,4}){2,3}|\(\d{3}\) ?\d{3}[ .-]\d{4}|\d{3}[.-]\d{3}[.-]\d{4}"
CARD = r"\d{4}(?:[ -]\d{4}){3}|\d{13,19}"
IBAN = r"[A-Z]{2}\d{2}[A-Z0-9]{11,30}"
ANY = rf"(?<![A-Za-z0-9._%+-])(?:{MAIL})|(?<![A-Za-z0-9.+-])(?:{IPV4}|{ISO}|{SLASHED}|{SSN}|{PHONE}|{CARD}|{IBAN})(?![A-Za-z0-9-]|\.\d)"


def _sql(s: str) -> str:
    """A SQL string literal."""
    return "r'" + s.replace("'", "\\x27") + "'"


def feistel(key: str, kind: str, left: str, right: str, left_size: str, right_size: str) -> str:
    """SQL struct(l, r): a keyed permutation of [0, left_size) x [0, right_size)."""
    f = f"cast(conv(substr(md5(concat_ws('|', {key}, {kind}, k, %s)), 1, 13), 16, 10) as bigint)"
    return (
        f"aggregate(sequence(1, {ROUNDS}), struct({left} as l, {right} as r), (s, k) -> if(k % 2 = 1, "
        f"struct(pmod(s.l + {f % 's.r'}, {left_size}) as l, s.r as r), struct(s.l as l, pmod(s.r + {f % 's.l'}, {right_size}) as r)))"
    )


def permute_digits(key: str, kind: str, digits: str) -> str:
    """SQL: the digit string ``digits`` (2 to 36 digits) permuted among those of its length."""
    half = "cast(length(d) / 2 as int)"
    size = f"cast(pow(10, {half}) as bigint)"
    rest = f"cast(pow(10, length(d) - {half}) as bigint)"
    p = feistel(key, f"concat({kind}, length(d))", f"cast(left(d, {half}) as bigint)", f"cast(substr(d, {half} + 1) as bigint)", size, rest)
    return let("d", digits, let("p", p, f"concat(lpad(cast(p.l as string), {half}, '0'), lpad(cast(p.r as string), length(d) - {half}, '0'))"))


def digits_of(s: str) -> str:
    return f"regexp_replace({s}, '[^0-9]', '')"


def refill(form: str, digits: str) -> str:
    """SQL: ``form`` with its digits replaced by ``digits``, in order."""
    at = f"length({digits_of('left(f, i + 1)')})"
    return let("f", form, let("g", digits, f"array_join(transform(split(f, ''), (c, i) -> if(c rlike '[0-9]', substr(g, {at}, 1), c)), '')"))


def luhn_sum(digits: str) -> str:
    """SQL: Luhn sum of a digit string whose last digit counts once."""
    return f"aggregate(transform(split(reverse({digits}), ''), (c, i) -> if(i % 2 = 0, cast(c as int), if(c >= '5', 2 * cast(c as int) - 9, 2 * cast(c as int)))), 0, (a, x) -> a + x)"


def card(key: str, s: str) -> str:
    """Payload permuted, check digit made anew; not a card number (Luhn): null."""
    body = permute_digits(key, "'card'", "left(n, length(n) - 1)")
    made = let("b", body, f"concat(b, cast(pmod(10 - {luhn_sum("concat(b, '0')")} % 10, 10) as string))")
    return let("n", digits_of(s), f"if({luhn_sum('n')} % 10 = 0, {refill(s, made)}, null)")


def ipv4(key: str, s: str) -> str:
    ok = "forall(o, x -> cast(x as int) <= 255)"
    p = feistel(key, "'ipv4'", "cast(o[0] as bigint) * 256 + cast(o[1] as bigint)", "cast(o[2] as bigint) * 256 + cast(o[3] as bigint)", "65536", "65536")
    made = let("p", p, "concat_ws('.', p.l div 256, p.l % 256, p.r div 256, p.r % 256)")
    return let("o", f"split({s}, '[.]')", f"if({ok}, {made}, null)")


def ssn(key: str, s: str) -> str:
    """Area 001-899 but 666, group 01-99, serial 0001-9999."""
    ok = "a between 1 and 899 and a <> 666 and g between 1 and 99 and n between 1 and 9999"
    area = "(a - if(a > 666, 2, 1))"  # 0 .. 897
    p = feistel(key, "'ssn'", f"{area} * 99 + g - 1", "n - 1", str(898 * 99), "9999")
    out = "p.l div 99 + 1 + if(p.l div 99 >= 665, 1, 0)"
    made = let("p", p, f"concat_ws('-', lpad(cast({out} as string), 3, '0'), lpad(cast(p.l % 99 + 1 as string), 2, '0'), lpad(cast(p.r + 1 as string), 4, '0'))")
    parts = let("a", f"cast(left({s}, 3) as bigint)", let("g", f"cast(substr({s}, 5, 2) as bigint)", let("n", f"cast(right({s}, 4) as bigint)", f"if({ok}, {made}, null)")))
    return parts


def _date(key: str, day: str, fmt: str) -> str:
    number = f"cast(datediff({day}, date'1900-01-01') as bigint)"
    p = feistel(key, "'date'", f"({number}) div {DAYS_B}", f"({number}) % {DAYS_B}", str(DAYS_A), str(DAYS_B))
    return let("p", p, f"date_format(date_add(date'1900-01-01', cast(p.l * {DAYS_B} + p.r as int)), {fmt})")


def iso_date(key: str, s: str) -> str:
    return let("t", f"try_to_date({s}, 'yyyy-MM-dd')", f"if(t is null, null, {_date(key, 't', "'yyyy-MM-dd'")})")


def slashed_date(key: str, s: str) -> str:
    """Day first where the calendar allows it, else month first."""
    sep = f"substr({s}, 3, 1)"
    whole = f"concat_ws('-', right({s}, 4), substr({s}, %d, 2), substr({s}, %d, 2))"
    by = {order: let("t", f"try_to_date({whole % at}, 'yyyy-MM-dd')", f"if(t is null, null, {_date(key, 't', f'concat_ws({sep}, {names})')})")
          for order, at, names in (("day", (4, 1), "'dd', 'MM', 'yyyy'"), ("month", (1, 4), "'MM', 'dd', 'yyyy'"))}
    return f"coalesce({by['day']}, {by['month']})"


def phone(key: str, s: str) -> str:
    """Country code kept, the other digits (7 to 15) permuted."""
    head = f"regexp_extract({s}, r'^\\+\\d{{1,3}}', 0)"
    rest = "substr(q, length(c) + 1)"
    ok = f"length({digits_of(rest)}) between 7 and 14"
    made = f"concat(c, {refill(rest, permute_digits(key, "'phone'", digits_of(rest)))})"
    return let("q", s, let("c", head, f"if({ok}, {made}, null)"))


def mail(key: str, s: str) -> str:
    """A keyed name; the domain stays (case folded values are linked)."""
    return f"concat('u', substr(md5(concat_ws('|', {key}, 'mail', lower({s}))), 1, 12), '@', substring_index({s}, '@', -1))"


def iban(key: str, s: str) -> str:
    """mod-97 check; the digits of the account part are permuted, the check digits made anew."""
    number = "array_join(transform(split(%s, ''), c -> if(c rlike '[A-Z]', cast(ascii(c) - 55 as string), c)), '')"
    mod = f"aggregate(split(({number}), ''), 0, (m, c) -> (m * 10 + cast(c as int)) %% 97)"
    rest = "substr(q, 5)"
    ok = mod % f"concat({rest}, left(q, 4))" + " = 1"
    body = f"if(length({digits_of(rest)}) >= 2, {refill(rest, permute_digits(key, "'iban'", digits_of(rest)))}, {rest})"
    check = f"lpad(cast(98 - {mod % "concat(b, left(q, 2), '00')"} as string), 2, '0')"
    return let("q", s, f"if({ok}, {let('b', body, f'concat(left(q, 2), {check}, b)')}, null)")


def pseudonym(key: str, s: str) -> str:
    """SQL: struct(kind, value) of one candidate; a candidate that is not valid keeps its text, kind null."""
    full = lambda p: f"{s} rlike {_sql(f'^(?:{p})$')}"
    kinds = [("mail", f"{s} like '%@%'", mail), ("ipv4", full(IPV4), ipv4), ("date", full(ISO), iso_date), ("date", full(SLASHED), slashed_date),
             ("ssn", full(SSN), ssn), ("card", full(CARD), card), ("phone", full(PHONE), phone), ("iban", full(IBAN), iban)]
    cases = " ".join(f"when {cond} then struct('{kind}' as kind, {make(key, s)} as value)" for kind, cond, make in kinds)
    return let("z", f"case {cases} else struct('' as kind, cast(null as string) as value) end", f"struct(if(z.value is null, null, z.kind) as kind, coalesce(z.value, {s}) as value)")


def protect(docs: DataFrame, key: str = "lakeforge", text: str = "text") -> DataFrame:
    """The caller's columns (one struct), ``clean`` (the text with pseudonyms) and
    ``kinds`` (of the replaced values, in order).

    Null text stays null; texts without candidates are unchanged; numbers that
    fail validation are left alone.  Nothing is shuffled: the permutation needs
    only the key, so equal values agree across documents, tasks and runs.
    """
    secret = "'" + key.replace("'", "") + "'"
    rows = wrap(docs, text).select(ROW, F.col(text).cast("string").alias("raw"), text_of(text).alias("body"))
    hits = F.when(F.col("body").rlike("[0-9@]"), F.regexp_extract_all("body", F.lit(ANY), F.lit(0))).otherwise(F.array().cast("array<string>"))
    made = rows.withColumn("hits", hits).withColumn("subs", F.expr(f"transform(hits, h -> {pseudonym(secret, 'h')})"))
    parts = F.split("body", ANY, -1)
    joined = F.array_join(F.flatten(F.transform(F.arrays_zip(parts.alias("a"), F.col("subs.value").alias("b")), lambda x: F.array(x["a"], F.coalesce(x["b"], F.lit(""))))), "")
    return made.select(
        ROW, F.when(F.size("hits") == 0, F.col("raw")).otherwise(joined).alias("clean"),
        F.filter("subs.kind", lambda k: k.isNotNull()).alias("kinds"),
    )
