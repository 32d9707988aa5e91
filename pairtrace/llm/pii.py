"""Pseudonyms for personal data that keep each value's format, by keyed Feistel networks.

Numbers and dates are permuted inside their own format: a value is split into two halves with
moduli a and b, and rounds add a keyed hash of one half to the other. That is a bijection on
a*b values for any moduli, so distinct values stay distinct and equal values stay equal in all
documents. Only values that pass their format's own check are touched. DataFrame functions only.
"""

from __future__ import annotations

import secrets
from functools import lru_cache

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

ROUNDS = 8

# Fixed formats. A value is taken whole and never inside a longer number or word.
EMAIL = r"(?<![A-Za-z0-9._%+\-])[A-Za-z0-9._%+\-]++@(?:[A-Za-z0-9\-]++\.)+[A-Za-z]{2,}"
IBAN = r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}[A-Z0-9]{11,30}(?![A-Za-z0-9])"
SECRET = r"(?<![A-Za-z0-9])[0-9A-Fa-f]{32,128}(?![A-Za-z0-9])"
DATE = r"(?<![0-9./\-])(?:[0-9]{4}-[0-9]{2}-[0-9]{2}|[0-9]{2}[./][0-9]{2}[./][0-9]{4})(?![0-9/\-])"
IPV4 = r"(?<![0-9.])[0-9]{1,3}(?:\.[0-9]{1,3}){3}(?![0-9]|\.[0-9])"
SSN = r"(?<![0-9\-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9\-])"
PHONE = (
    r"\+[0-9]{1,3}[ .\-]?\(?[0-9]{3}\)?[ .\-]?[0-9]{3}[ .\-]?[0-9]{4}(?![0-9])"
    r"|(?<![0-9])\([0-9]{3}\) ?[0-9]{3}-[0-9]{4}(?![0-9])"
    r"|(?<![0-9.\-])[0-9]{3}[.\-][0-9]{3}[.\-][0-9]{4}(?![0-9.\-])"
)
CARD = r"(?<![0-9])(?:[0-9]{13,19}|[0-9]{4}(?:[ \-][0-9]{4}){3}|[0-9]{4}[ \-][0-9]{6}[ \-][0-9]{5})(?![0-9])"
ANY = "|".join((EMAIL, IBAN, SECRET, DATE, IPV4, SSN, PHONE, CARD))

#: First day and moduli of the dates that are permuted: 1900-01-01 and the next 360 * 203 days.
DAY_ZERO, DAYS = "1900-01-01", (360, 203)


def _whole(value: Column, pattern: str) -> Column:
    return value.rlike(rf"^(?:{pattern})$")


def _prf(key: str, kind: str, step: Column, half: Column, modulus: Column) -> Column:
    """Keyed hash of one half below ``modulus``: 60 bits of SHA-256."""
    text = F.concat_ws(":", F.lit(key), F.lit(kind), step.cast("string"), half.cast("string"), modulus.cast("string"))
    return F.conv(F.substring(F.sha2(text.cast("binary"), 256), 1, 15), 16, 10).cast("long") % modulus


def feistel(key: str, kind: str, left: Column, right: Column, a: Column, b: Column, inverse: bool = False) -> Column:
    """struct(l, r): the keyed permutation of (left, right) in [0, a) x [0, b), or its inverse."""
    steps = F.sequence(F.lit(ROUNDS - 1), F.lit(0)) if inverse else F.sequence(F.lit(0), F.lit(ROUNDS - 1))
    sign = -1 if inverse else 1

    def turn(h: Column, i: Column) -> Column:
        even = F.struct(F.pmod(h["l"] + sign * _prf(key, kind, i, h["r"], a), a).alias("l"), h["r"].alias("r"))
        odd = F.struct(h["l"].alias("l"), F.pmod(h["r"] + sign * _prf(key, kind, i, h["l"], b), b).alias("r"))
        return F.when(i % 2 == 0, even).otherwise(odd)

    return F.aggregate(steps, F.struct(left.cast("long").alias("l"), right.cast("long").alias("r")), turn)


def _power(n: Column) -> Column:
    return F.rpad(F.lit("1"), n + 1, "0").cast("long")


def permute_digits(key: str, kind: str, digits: Column, inverse: bool = False) -> Column:
    """Another digit string of the same length (2 to 30 digits)."""
    n = F.length(digits)
    u = F.floor(n / 2).cast("int")
    v = n - u
    out = feistel(key, kind, F.substring(digits, F.lit(1), u).cast("long"), F.substring(digits, u + 1, v).cast("long"), _power(u), _power(v), inverse)
    return F.aggregate(F.array(out), F.lit(""), lambda _, o: F.concat(F.lpad(o["l"].cast("string"), u, "0"), F.lpad(o["r"].cast("string"), v, "0")))


def luhn_sum(digits: Column) -> Column:
    """Luhn sum of a digit string whose last digit is the check digit."""
    n = F.length(digits)

    def worth(i: Column) -> Column:
        d = F.substring(digits, i, F.lit(1)).cast("int")
        twice = d * 2 - F.when(d > 4, 9).otherwise(0)
        return F.when((n - i) % 2 == 1, twice).otherwise(d)

    return F.aggregate(F.sequence(F.lit(1), n), F.lit(0), lambda s, i: s + worth(i))


def _remainder_97(text: Column) -> Column:
    """Value mod 97 of an account number moved round and spelled in digits (A is 10)."""
    moved = F.concat(F.substring(text, F.lit(5), F.length(text)), F.substring(text, 1, 4))

    def step(r: Column, c: Column) -> Column:
        return F.when(c.rlike("[0-9]"), (r * 10 + c.try_cast("int")) % 97).otherwise((r * 100 + F.ascii(c) - 55) % 97)

    return F.aggregate(F.filter(F.split(moved, ""), lambda c: c != ""), F.lit(0), step)


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _refill(value: Column, digits: Column) -> Column:
    """``value`` with its digits replaced in order by ``digits``."""
    start = F.struct(F.lit("").alias("out"), F.lit(1).alias("at"))
    return F.aggregate(
        F.filter(F.split(value, ""), lambda c: c != ""), start,
        lambda s, c: F.when(c.rlike("[0-9]"), F.struct(F.concat(s["out"], F.substring(digits, s["at"], F.lit(1))).alias("out"), (s["at"] + 1).alias("at")))
        .otherwise(F.struct(F.concat(s["out"], c).alias("out"), s["at"].alias("at"))),
        lambda s: s["out"],
    )


def _named(value: Column, make) -> Column:
    """make(x) with ``value`` computed once."""
    return F.element_at(F.transform(F.array(value), make), 1)


def _card(key: str, value: Column) -> Column:
    def make(d: Column) -> Column:
        body = F.concat(F.substring(d, 1, 1), permute_digits(key, "card", F.substring(d, F.lit(2), F.length(d) - 2)))
        checked = _named(body, lambda x: F.concat(x, ((10 - luhn_sum(F.concat(x, F.lit("0"))) % 10) % 10).cast("string")))
        return F.when(luhn_sum(d) % 10 == 0, _refill(value, checked))

    return _named(_digits(value), make)


def _phone(key: str, value: Column) -> Column:
    """Ten digits behind a country code. Without one, or behind 1, area and exchange begin with 2 to 9 and go on doing so."""

    def make(d: Column) -> Column:
        head = F.length(d) - 10
        code, area, exchange, line = F.substring(d, F.lit(1), head), *[F.substring(d, head + at, F.lit(n)).cast("long") for at, n in ((1, 3), (4, 3), (7, 4))]
        out = feistel(key, "phone", (area - 200) * 800 + exchange - 200, line, F.lit(640_000).cast("long"), F.lit(10_000).cast("long"))
        spell = lambda o: F.concat(code, F.format_string("%03d%03d%04d", F.floor(o["l"] / 800) + 200, o["l"] % 800 + 200, o["r"]))
        plain = F.concat(code, permute_digits(key, "phone", F.substring(d, head + 1, F.lit(10))))
        made = F.when(~code.isin("", "1"), plain).when((area >= 200) & (exchange >= 200), _named(out, spell))
        return F.when(made.isNotNull(), _refill(value, made))

    return _named(_digits(value), make)


def _ssn(key: str, value: Column) -> Column:
    area, group, serial = (F.substring(value, at, n).cast("int") for at, n in ((1, 3), (5, 2), (8, 4)))
    valid = (area > 0) & (area != 666) & (area < 900) & (group > 0) & (serial > 0)
    rank = F.when(area > 666, area - 2).otherwise(area - 1)
    out = feistel(key, "ssn", rank * 99 + group - 1, serial - 1, F.lit(898 * 99).cast("long"), F.lit(9999).cast("long"))

    def spell(o: Column) -> Column:
        k = F.floor(o["l"] / 99)
        return F.format_string("%03d-%02d-%04d", F.when(k >= 665, k + 2).otherwise(k + 1), o["l"] % 99 + 1, o["r"] + 1)

    return F.when(valid, _named(out, spell))


def _ip(key: str, value: Column) -> Column:
    parts = F.transform(F.split(value, r"\."), lambda x: x.cast("int"))
    valid = ~F.exists(parts, lambda x: x > 255)
    at = lambda i: F.element_at(parts, i)
    out = feistel(key, "ip", at(1) * 256 + at(2), at(3) * 256 + at(4), F.lit(65536).cast("long"), F.lit(65536).cast("long"))
    spell = lambda o: F.concat_ws(".", *[x.cast("string") for h in ("l", "r") for x in (F.floor(o[h] / 256), o[h] % 256)])
    return F.when(valid, _named(out, spell))


def _date(key: str, value: Column) -> Column:
    iso = value.rlike("^[0-9]{4}-")
    dot = value.contains(".")
    day = F.when(iso, F.try_to_timestamp(value, F.lit("yyyy-MM-dd"))).when(dot, F.try_to_timestamp(value, F.lit("dd.MM.yyyy"))).otherwise(
        F.coalesce(F.try_to_timestamp(value, F.lit("MM/dd/yyyy")), F.try_to_timestamp(value, F.lit("dd/MM/yyyy")))
    )
    us = F.try_to_timestamp(value, F.lit("MM/dd/yyyy")).isNotNull()
    n = F.datediff(day.cast("date"), F.lit(DAY_ZERO).cast("date"))
    out = feistel(key, "date", F.floor(n / DAYS[1]), n % DAYS[1], F.lit(DAYS[0]).cast("long"), F.lit(DAYS[1]).cast("long"))

    def spell(o: Column) -> Column:
        moved = F.date_add(F.lit(DAY_ZERO).cast("date"), (o["l"] * DAYS[1] + o["r"]).cast("int"))
        return F.when(iso, F.date_format(moved, "yyyy-MM-dd")).when(dot, F.date_format(moved, "dd.MM.yyyy")).when(us, F.date_format(moved, "MM/dd/yyyy")).otherwise(F.date_format(moved, "dd/MM/yyyy"))

    return F.when((n >= 0) & (n < DAYS[0] * DAYS[1]), _named(out, spell))


def _iban(key: str, value: Column) -> Column:
    def make(d: Column) -> Column:
        body = _refill(F.substring(value, F.lit(5), F.length(value)), permute_digits(key, "iban", d))
        country = F.substring(value, 1, 2)
        check = lambda x: F.lpad((98 - _remainder_97(F.concat(country, F.lit("00"), x))).cast("string"), 2, "0")
        return F.when((_remainder_97(value) == 1) & (F.length(d) >= 2), _named(body, lambda x: F.concat(country, check(x), x)))

    return _named(_digits(F.substring(value, F.lit(5), F.length(value))), make)


def _secret(key: str, value: Column) -> Column:
    """Not a number or date: a keyed digest of the same length and case, so equal secrets stay linked."""
    made = F.substring(F.sha2(F.concat(F.lit(f"{key}:secret:"), value).cast("binary"), 512), F.lit(1), F.length(value))
    mixed = value.rlike("[0-9]") & value.rlike("[A-Fa-f]")
    return F.when(mixed, F.when(value == F.upper(value), F.upper(made)).otherwise(made))


def _email(key: str, value: Column) -> Column:
    """A keyed name at a reserved domain."""
    made = F.substring(F.sha2(F.concat(F.lit(f"{key}:email:"), F.lower(value)).cast("binary"), 256), 1, 32)
    return F.concat(F.lit("user-"), made, F.lit("@example.invalid"))


@lru_cache(1)
def _throwaway_key() -> str:
    return secrets.token_hex(32)


def configured_key(spark: SparkSession) -> str:
    """The session's spark.pairtrace.pii.key; where it is not set, a random key of this process, whose pseudonyms link within it only."""
    return spark.conf.get("spark.pairtrace.pii.key", None) or _throwaway_key()


KINDS = (
    ("email", EMAIL, _email), ("iban", IBAN, _iban), ("secret", SECRET, _secret), ("date", DATE, _date),
    ("ip", IPV4, _ip), ("ssn", SSN, _ssn), ("phone", PHONE, _phone), ("card", CARD, _card),
)


def pseudonym(value: Column, key: str) -> Column:
    """struct(kind, text) of one found value; null where it fails its format's check."""
    out = None
    for kind, pattern, make in KINDS:
        made = make(key, value)
        hit = F.when(made.isNotNull(), F.struct(F.lit(kind).alias("kind"), made.alias("text")))
        test = _whole(value, pattern)
        out = F.when(test, hit) if out is None else out.when(test, hit)
    return out


def pseudonymize(docs: DataFrame, key: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, text, n_values long, kinds (sorted, distinct) for every row, over whole texts.

    Validated card numbers (Luhn), account numbers (mod 97), phone numbers (numbering plan),
    social security numbers, IPv4 addresses and dates of 1900 to 2100 are permuted within their
    format; email addresses and hexadecimal secrets get keyed names. Numbers that fail their
    check stay. A null text stays null with 0 values; empty texts stay empty; null and repeated
    ids and rows are kept; other columns are ignored, whatever their names; an empty table gives
    no rows. No shuffle: each text is rebuilt in place.

    ``key`` is a secret of 16 characters or more: who knows it can turn permuted values back. It
    is part of the query's plan, so event logs and explained plans have to be kept like the key.
    """
    if len(key) < 16:
        raise ValueError("the key needs 16 characters or more")
    text = F.col(text_col).cast("string")
    rows = docs.select(F.col(id_col).alias("id"), text.alias("text"), F.when(text.rlike("[0-9]|@"), F.regexp_extract_all(text, F.lit(ANY), F.lit(0))).alias("found"))
    made = F.transform("found", lambda v: F.struct(v.alias("value"), pseudonym(v, key).alias("new")))
    rows = rows.withColumn("made", F.when(F.size("found") > 0, made))
    pieces = F.split("text", ANY, -1)
    filled = F.zip_with(pieces, "made", lambda a, m: F.concat(a, F.when(m.isNull(), "").otherwise(F.coalesce(m["new"]["text"], m["value"]))))
    hits = F.filter("made", lambda m: m["new"].isNotNull())
    return rows.select(
        F.col("id").alias(id_col),
        F.when(F.col("made").isNull(), F.col("text")).otherwise(F.array_join(filled, "")).alias("text"),
        F.when(F.col("made").isNull(), 0).otherwise(F.size(hits)).cast("long").alias("n_values"),
        F.when(F.col("made").isNull(), F.array().cast("array<string>")).otherwise(F.array_sort(F.array_distinct(F.transform(hits, lambda m: m["new"]["kind"])))).alias("kinds"),
    )
