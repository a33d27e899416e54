"""Format-preserving pseudonyms for personal data, in DataFrame functions only.

Numbers and dates that pass validation are permuted by a keyed Feistel network inside their
own format, so that equal values stay equal across documents, different ones stay different,
and the result is valid again: payment cards (13 to 19 digits that pass the Luhn test) keep
length, grouping and a right check digit; telephone numbers and US social security numbers
keep their marks; IPv4 addresses stay addresses; dates stay dates of the calendar, within the
same 36,500 days. E-mail addresses, which have no such format, become keyed names.

A round adds to one half the keyed SHA-256 of the other, modulo the size of the half's
range; ten rounds make a permutation, whatever the hash, and `restore` runs them backwards.

Defined cases: null text stays null and has no finds; values that fail validation stay;
rows with a null doc_id are treated alike; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ROUNDS = 10
#: The formats that are looked for. A value must not touch further letters or digits, nor an
#: address the rest of a longer dotted number; an e-mail name begins where its characters do.
EMAIL = r"[A-Za-z0-9._%+-]++@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*\.[A-Za-z]{2,}"
IPV4 = r"\d{1,3}(?:\.\d{1,3}){3}(?![.]?\d)"
DATE = r"\d{4}-\d{2}-\d{2}|\d{2}[./]\d{2}[./]\d{4}"
PHONE = r"\+\d{1,3}[ -]?\(?\d{2,4}\)?(?:[ -]?\d{2,4}){2,3}|\(\d{3}\) ?\d{3}-\d{4}"
SSN = r"\d{3}-\d{2}-\d{4}"
CARD = r"\d{4}(?:[ -]\d{4}){2}[ -]\d{1,7}|\d{13,19}"
FOUND = rf"(?<![A-Za-z0-9._%+-]){EMAIL}|(?<![A-Za-z0-9])(?:(?<!\d[.]){IPV4}|{DATE}|{PHONE}|{SSN}|{CARD})(?![A-Za-z0-9])"
KINDS = ("email", "ip", "date", "phone", "ssn", "card")


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """`body` of a value that is computed once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _noise(key: str, tweak: str | Column, i: Column, half: Column) -> Column:
    """60 keyed bits of the round and the other half."""
    told = F.concat_ws("|", F.lit(key), tweak if isinstance(tweak, Column) else F.lit(tweak), i.cast("string"), half.cast("string"))
    return F.conv(F.substring(F.sha2(told, 256), 1, 15), 16, 10).cast("long")


def _rounds(back: bool) -> Column:
    return F.sequence(F.lit(ROUNDS - 1), F.lit(0), F.lit(-1)) if back else F.sequence(F.lit(0), F.lit(ROUNDS - 1))


def permute_digits(digits: Column, key: str, tweak: str, back: bool = False) -> Column:
    """A string of 2 to 36 digits as another of the same length."""
    cut = F.floor(F.length(digits) / 2).cast("int")
    halves = F.struct(F.substring(digits, F.lit(1), cut).alias("a"), F.substring(digits, cut + 1, F.length(digits)).alias("b"))

    def step(x: Column, i: Column) -> Column:
        fixed, other = (x["a"], x["b"]) if back else (x["b"], x["a"])
        size = F.pow(F.lit(10.0), F.length(other)).cast("long")
        noise = F.pmod(_noise(key, tweak, i, fixed), size)
        moved = F.pmod(other.cast("long") + (-noise if back else noise), size)
        text = F.lpad(moved.cast("string"), F.length(other), F.lit("0"))
        return F.struct(text.alias("a"), fixed.alias("b")) if back else F.struct(fixed.alias("a"), text.alias("b"))

    return F.aggregate(_rounds(back), halves, step, lambda x: F.concat(x["a"], x["b"]))


def permute_pair(value: Column, left: Column, right: Column, key: str, tweak: Column | str, back: bool = False) -> Column:
    """A whole number below left * right as another."""
    start = F.struct(F.floor(value / right).cast("long").alias("a"), F.pmod(value, right).cast("long").alias("b"))

    def step(x: Column, i: Column) -> Column:
        even = i % 2 == 0
        sign = -1 if back else 1
        a = F.when(even, F.pmod(x["a"] + sign * F.pmod(_noise(key, tweak, i, x["b"]), left), left)).otherwise(x["a"])
        b = F.when(even, x["b"]).otherwise(F.pmod(x["b"] + sign * F.pmod(_noise(key, tweak, i, x["a"]), right), right))
        return F.struct(a.cast("long").alias("a"), b.cast("long").alias("b"))

    return F.aggregate(_rounds(back), start, step, lambda x: x["a"] * right + x["b"])


def _refill(pattern: Column, digits: Column) -> Column:
    """The pattern with its digits replaced in order."""
    start = F.struct(F.lit("").alias("s"), F.lit(1).alias("i"))

    def step(x: Column, c: Column) -> Column:
        digit = c.rlike("^[0-9]$")
        return F.struct(F.concat(x["s"], F.when(digit, F.substring(digits, x["i"], F.lit(1))).otherwise(c)).alias("s"), F.when(digit, x["i"] + 1).otherwise(x["i"]).alias("i"))

    return F.aggregate(F.split(pattern, ""), start, step, lambda x: x["s"])


def _check_digit(payload: Column) -> Column:
    """The digit that makes payload and digit pass the Luhn test."""

    def step(x: Column, c: Column) -> Column:
        d = c.cast("int") * F.when(x["twice"], 2).otherwise(1)
        return F.struct((x["sum"] + F.when(d > 9, d - 9).otherwise(d)).alias("sum"), (~x["twice"]).alias("twice"))

    total = F.aggregate(F.split(F.reverse(payload), ""), F.struct(F.lit(0).alias("sum"), F.lit(True).alias("twice")), step, lambda x: x["sum"])
    return F.pmod(10 - total % 10, F.lit(10)).cast("string")


def _digits(m: Column) -> Column:
    return F.regexp_replace(m, "[^0-9]", "")


#: Days since 0001-01-01 fall into blocks of 36,500, the last one of 2,059; both factor into two ranges.
BLOCK, LAST = 36_500, 2_059


def _date(m: Column) -> Column:
    iso = m.rlike(r"^\d{4}-")
    text = F.when(iso, m).otherwise(F.concat_ws("-", F.substring(m, 7, 4), F.substring(m, 4, 2), F.substring(m, 1, 2)))
    return F.when(F.substring(text, 1, 4) != "0000", F.try_to_date(text, "yyyy-MM-dd"))


def _permute_date(m: Column, key: str, back: bool) -> Column:
    origin = F.lit("0001-01-01").cast("date")
    day = F.datediff(_date(m), origin)
    block = F.floor(day / BLOCK)
    whole = block < 100
    left, right = F.when(whole, F.lit(250)).otherwise(F.lit(29)), F.when(whole, F.lit(146)).otherwise(F.lit(71))
    moved = permute_pair((day - block * BLOCK).cast("long"), left, right, key, F.concat(F.lit("date"), block.cast("string")), back)
    iso = F.date_format(F.date_add(origin, (block * BLOCK + moved).cast("int")), "yyyy-MM-dd")
    mark = F.substring(m, 3, 1)
    return F.when(m.rlike(r"^\d{4}-"), iso).otherwise(F.concat(F.substring(iso, 9, 2), mark, F.substring(iso, 6, 2), F.substring(m, 6, 1), F.substring(iso, 1, 4)))


def kind_of(m: Column) -> Column:
    """The kind of a value that passes validation, else null."""
    octets = F.transform(F.split(m, r"\."), lambda x: x.cast("int"))
    return (
        F.when(m.contains("@"), "email")
        .when(m.rlike(rf"^(?:{IPV4})$"), F.when(F.forall(octets, lambda x: x <= 255), "ip"))
        .when(m.rlike(rf"^(?:{DATE})$"), F.when(_date(m).isNotNull(), "date"))
        .when(m.rlike(rf"^(?:{SSN})$"), F.when(~m.rlike(r"^(?:000|666|9\d\d)-|-00-|-0000$"), "ssn"))
        .when(m.rlike(r"^[+(]"), F.when(F.length(_digits(m)).between(10, 15), "phone"))
        .when(F.length(_digits(m)).between(13, 19), F.when(F.call_function("luhn_check", _digits(m)), "card"))
    )


def pseudonym(m: Column, key: str, back: bool = False) -> Column:
    """The pseudonym of a found value, or with `back` the value of a pseudonym; the value itself if it isn't valid."""
    octet = lambda v, shift: F.shiftright(v, shift).bitwiseAND(F.lit(255)).cast("string")
    as_long = lambda m: F.aggregate(F.split(m, r"\."), F.lit(0).cast("long"), lambda x, o: x * 256 + o.cast("long"))
    ip = _let(permute_pair(as_long(m), F.lit(65536), F.lit(65536), key, "ip", back), lambda v: F.concat_ws(".", octet(v, 24), octet(v, 16), octet(v, 8), octet(v, 0)))
    payload = lambda d: F.substring(d, F.lit(1), F.length(d) - 1)
    card = _let(_digits(m), lambda d: _let(permute_digits(payload(d), key, "card", back), lambda p: _refill(m, F.concat(p, _check_digit(p)))))
    phone = _let(_digits(m), lambda d: _refill(m, F.concat(F.substring(d, F.lit(1), F.length(d) - 9), permute_digits(F.substring(d, F.length(d) - 8, F.lit(9)), key, "phone", back))))
    # the area 001..899 without 666, the group 01..99 and the serial 0001..9999 are numbered from 0
    part = F.split(m, "-")
    area = part[0].cast("long") - 1 - F.when(part[0] > "666", 1).otherwise(0)
    inner = (part[1].cast("long") - 1) * 9999 + part[2].cast("long") - 1
    told = lambda v: F.concat_ws("-", F.lpad((F.floor(v / 989_901) + 1 + F.when(F.floor(v / 989_901) >= 665, 1).otherwise(0)).cast("string"), 3, "0"), F.lpad((F.floor(F.pmod(v, F.lit(989_901)) / 9999) + 1).cast("string"), 2, "0"), F.lpad((F.pmod(F.pmod(v, F.lit(989_901)), F.lit(9999)) + 1).cast("string"), 4, "0"))
    ssn = _let(permute_pair(area * 989_901 + inner, F.lit(898), F.lit(989_901), key, "ssn", back), told)
    name = F.sha2(F.concat_ws("|", F.lit(key), F.lit("email"), F.lower(m)), 256)
    email = m if back else F.concat(F.lit("user-"), F.substring(name, 1, 16), F.lit("@pseudonym.invalid"))
    return _let(kind_of(m), lambda k: F.coalesce(F.when(k == "email", email).when(k == "ip", ip).when(k == "date", _permute_date(m, key, back)).when(k == "phone", phone).when(k == "ssn", ssn).when(k == "card", card), m))


def _replaced(text: Column, found: Column, key: str, back: bool) -> Column:
    parts = F.split(text, FOUND, -1)
    return F.array_join(F.zip_with(parts, F.transform(found, lambda m: pseudonym(m, key, back)), lambda p, m: F.concat(p, F.coalesce(m, F.lit("")))), "")


def pseudonymise(docs: DataFrame, key: str, back: bool = False) -> DataFrame:
    """doc_id, text with pseudonyms, and n_<kind> for each kind of value replaced."""
    base = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    quick = F.col("text").rlike(r"[0-9@]")  # every format holds one of these
    found = base.withColumn("found", F.when(quick, F.regexp_extract_all("text", F.lit(FOUND), F.lit(0))))
    some = F.coalesce(F.size("found"), F.lit(0)) > 0
    told = found.withColumn("kinds", F.when(some, F.transform("found", kind_of)))
    of = lambda kind: F.size(F.filter("kinds", lambda k: k == F.lit(kind)))
    counts = [F.when(some, of(kind)).otherwise(0).cast("long").alias(f"n_{kind}") for kind in KINDS]
    return told.select("doc_id", F.when(some, _replaced(F.col("text"), F.col("found"), key, back)).otherwise(F.col("text")).alias("text"), *counts)


def restore(docs: DataFrame, key: str) -> DataFrame:
    """The numbers and dates back from their pseudonyms; e-mail names stay."""
    return pseudonymise(docs, key, back=True)
