"""Format-preserving pseudonyms for personal data, as Spark expressions.

Valid values are replaced inside the text by a keyed permutation of their own format, a Feistel
network over two numbers ``(a, b)`` with moduli of the format: rounds add a keyed hash of one to
the other. So equal values get equal pseudonyms in all documents, and different ones different.

* cards: 13 to 19 digits that pass the Luhn test; the check digit is made anew, separators stay
* phones of 7 to 15 digits: separators and a country code that is set apart stay, and of the other
  digits the last ten at most are permuted
* IPv4 addresses: 2 x 16 bits
* social security numbers with valid area, group and serial
* dates ``yyyy-mm-dd``, ``dd/mm/yyyy``, ``dd.mm.yyyy`` that exist, and ``mm/dd/yyyy`` with a day
  over 12, which stay such; from the year 1000 on, permuted within ``RANGES``
* e-mail addresses are no numbers: a keyed hash names the mailbox, equal up to letter case

Repeated groups of the patterns are possessive or bounded, so the regex engine works in a loop and
long strings don't fill its stack.

Defined results: a null text stays null, an empty one empty; values that fail their test stay as
they are; rows are treated one by one, so repeated rows and ties change nothing; very long texts
are treated whole; all columns of the input stay, and the counts replace input columns of their
names; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from colophon.llm.common import let

KINDS = ("email", "date", "ssn", "ip", "card", "phone")
PATTERNS = {
    "email": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "date": r"(?<![\d./-])(?:\d{4}-\d{2}-\d{2}|\d{2}/\d{2}/\d{4}|\d{2}\.\d{2}\.\d{4})(?![/-]?\d|\.\d)",
    "ssn": r"(?<![\d-])\d{3}-\d{2}-\d{4}(?![\d-])",
    "ip": r"(?<![\d.])\d{1,3}\.\d{1,3}\.\d{1,3}\.\d{1,3}(?!\d|\.\d)",
    "card": r"(?<!\d)(?:\d{13,19}|\d{4}([ -])\d{4}\1\d{4}\1\d{1,7}|\d{4}[ -]\d{6}[ -]\d{5})(?!\d)",
    "phone": r"(?<![\w+])(?:(?:\+?\d{1,3}[ .-]?)?\(\d{3}\)[ .-]?\d{3}[ .-]?\d{4}"
    r"|\+\d{1,3}(?:[ -]\d{1,4}){2,4}|\+\d{1,3}[ -]\d{2,5}[ -]\d{4,8}|\+\d{8,15}|\d{3}[.-]\d{3}[.-]\d{4})(?!\d|\.\d)",
}
ANY = "|".join(f"(?:{PATTERNS[k]})" for k in KINDS)
ROUNDS = 8
#: First days, years and days a year of the ranges within which dates are permuted.
RANGES = {"past": ("1000-08-07", 900, 365), "present": ("1900-01-01", 200, 365), "future": ("2099-11-13", 7900, 365)}
#: Steps to find a day over 12; each ends with a probability of 0.6.
WALK = 64
#: The setting that holds the key, and what the registered queries use where it is unset.
KEY_SETTING, TEST_KEY = "spark.colophon.pii.key", "public test key"


def feistel(a: Column, b: Column, a_size: Column | int, b_size: Column | int, tweak: Column | str, key: str) -> Column:
    """Struct ``(a, b)``: a keyed permutation of the pairs with ``a < a_size`` and ``b < b_size``."""
    size_a, size_b = (x if isinstance(x, Column) else F.lit(x).cast("long") for x in (a_size, b_size))

    def noise(i: Column, x: Column) -> Column:
        digest = F.sha2(F.concat_ws("|", F.lit(key), F.lit(tweak) if isinstance(tweak, str) else tweak, i.cast("string"), x.cast("string")), 256)
        return F.conv(F.substring(digest, 1, 15), 16, 10).cast("long")

    def step(s: Column, i: Column) -> Column:
        even = F.struct(((s["a"] + noise(i, s["b"])) % size_a).alias("a"), s["b"].alias("b"))
        odd = F.struct(s["a"].alias("a"), ((s["b"] + noise(i, s["a"])) % size_b).alias("b"))
        return F.when(i % 2 == 0, even).otherwise(odd)

    start = F.struct(a.cast("long").alias("a"), b.cast("long").alias("b"))
    return F.aggregate(F.sequence(F.lit(0), F.lit(ROUNDS - 1)), start, step)


def zero_padded(number: Column, width: Column) -> Column:
    return F.lpad(number.cast("string"), width, F.lit("0"))


def permuted_digits(digits: Column, tweak: str, key: str) -> Column:
    """A string of 2 to 36 digits permuted among those of its length."""

    def halves(d: Column) -> Column:
        n = F.char_length(d)
        left = F.floor(n / 2).cast("int")
        right = n - left
        sizes = [F.element_at(F.array(*[F.lit(10**k) for k in range(19)]), x + 1) for x in (left, right)]
        made = feistel(F.substring(d, F.lit(1), left), F.substring(d, left + 1, right), *sizes, tweak, key)
        return let(made, lambda s: F.concat(zero_padded(s["a"], left), zero_padded(s["b"], right)))

    return let(digits, halves)


def luhn_sum(digits: Column, doubled_first: bool) -> Column:
    """Luhn sum from the right; ``doubled_first``: the last digit counts double (no check digit yet)."""

    def of(d: Column) -> Column:
        n = F.char_length(d)

        def step(total: Column, i: Column) -> Column:
            x = F.substring(d, n - i + 1, F.lit(1)).cast("int")
            twice = F.when(x >= 5, 2 * x - 9).otherwise(2 * x)
            return total + F.when((i % 2 == 1) == F.lit(doubled_first), twice).otherwise(x)

        return F.aggregate(F.sequence(F.lit(1), n), F.lit(0), step)

    return let(digits, of)


def digits_of(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def put_back(value: Column, digits: Column) -> Column:
    """``value`` with its digits replaced, in order, by ``digits``; what stands between stays."""

    def filled(d: Column) -> Column:
        chars = F.filter(F.split(value, ""), lambda c: c != "")

        def step(s: Column, c: Column) -> Column:
            number = c.rlike("[0-9]")
            new = F.when(number, F.substring(d, s["used"] + 1, F.lit(1))).otherwise(c)
            return F.struct((s["used"] + F.when(number, 1).otherwise(0)).alias("used"), F.concat(s["out"], new).alias("out"))

        start = F.struct(F.lit(0).alias("used"), F.lit("").alias("out"))
        return F.aggregate(chars, start, step, lambda s: s["out"])

    return let(digits, filled)


def email_pseudonym(value: Column, key: str) -> Column:
    digest = F.sha2(F.concat(F.lit(f"{key}|email|"), F.lower(value)), 256)
    return F.concat(F.lit("u"), F.substring(digest, 1, 16), F.lit("@mail.invalid"))


def date_pseudonym(value: Column, key: str) -> Column:
    """Null unless the date exists and lies in a range."""

    def permuted(day: Column) -> Column:
        found = None
        for name, (first, years, days) in RANGES.items():
            start = F.lit(first).cast("date")
            place = F.datediff(day, start)
            chosen = F.struct(F.lit(name).alias("name"), start.alias("start"), place.alias("place"), F.lit(years).alias("years"), F.lit(days).alias("days"))
            found = (F if found is None else found).when((place >= 0) & (place < years * days), chosen)

        def moved(r: Column) -> Column:
            pair = feistel(F.floor(r["place"] / r["days"]), r["place"] % r["days"], r["years"], r["days"], F.concat(F.lit("date "), r["name"]), key)
            return let(pair, lambda s: F.date_add(r["start"], (s["a"] * r["days"] + s["b"]).cast("int")))

        return let(found, moved)

    def of(form: str) -> Column:
        return F.date_format(let(F.try_to_date(value, form), permuted), form)

    def walked(day: Column) -> Column:
        def step(d: Column, i: Column) -> Column:
            return F.when((i > 0) & (F.dayofmonth(d) > 12), d).otherwise(permuted(d))

        return F.date_format(F.aggregate(F.sequence(F.lit(0), F.lit(WALK)), day, step), "MM/dd/yyyy")

    american = F.when(F.substring(value, 4, 2).cast("int") > 12, let(F.try_to_date(value, "MM/dd/yyyy"), walked))
    return (
        F.when(value.contains("-"), of("yyyy-MM-dd"))
        .when(value.contains("/"), F.coalesce(of("dd/MM/yyyy"), american))
        .otherwise(of("dd.MM.yyyy"))
    )


def ssn_pseudonym(value: Column, key: str) -> Column:
    """Null for areas 000, 666 and from 900, group 00 and serial 0000, which are never given out."""

    def of(d: Column) -> Column:
        area, group, serial = (F.substring(d, a, n).cast("long") for a, n in ((1, 3), (4, 2), (6, 4)))
        valid = (area > 0) & (area != 666) & (area < 900) & (group > 0) & (serial > 0)
        index = area - F.when(area > 666, 2).otherwise(1)
        moved = feistel(index, (group - 1) * 9999 + serial - 1, 898, 99 * 9999, "ssn", key)

        def shown(s: Column) -> Column:
            new_area = s["a"] + F.when(s["a"] >= 665, 2).otherwise(1)
            parts = (new_area, 3), (F.floor(s["b"] / 9999) + 1, 2), (s["b"] % 9999 + 1, 4)
            return F.concat_ws("-", *[zero_padded(x, F.lit(n)) for x, n in parts])

        return F.when(valid, let(moved, shown))

    return let(digits_of(value), of)


def ip_pseudonym(value: Column, key: str) -> Column:
    """Null if an octet is over 255."""

    def of(o: Column) -> Column:
        octet = [F.get(o, F.lit(k)).cast("long") for k in range(4)]
        valid = (octet[0] < 256) & (octet[1] < 256) & (octet[2] < 256) & (octet[3] < 256)
        moved = feistel(octet[0] * 256 + octet[1], octet[2] * 256 + octet[3], 1 << 16, 1 << 16, "ip", key)

        def shown(s: Column) -> Column:
            return F.concat_ws(".", *[x.cast("long").cast("string") for y in "ab" for x in (F.floor(s[y] / 256), s[y] % 256)])

        return F.when(valid, let(moved, shown))

    return let(F.split(value, r"\."), of)


def card_pseudonym(value: Column, key: str) -> Column:
    """Null unless the number passes the Luhn test."""

    def of(d: Column) -> Column:
        payload = permuted_digits(F.substring(d, F.lit(1), F.char_length(d) - 1), "card", key)
        checked = let(payload, lambda p: F.concat(p, ((10 - luhn_sum(p, True) % 10) % 10).cast("string")))
        return F.when(luhn_sum(d, False) % 10 == 0, put_back(value, checked))

    return let(digits_of(value), of)


def phone_pseudonym(value: Column, key: str) -> Column:
    """Null for fewer than seven or more than fifteen digits, or fewer than two after the country code."""

    def of(d: Column) -> Column:
        n = F.char_length(d)
        code = F.char_length(F.regexp_extract(value, r"^\+?(\d{1,3})[ .-]?\(|^\+(\d{1,3})[ -]", 0))
        code = F.when(code > 0, F.char_length(digits_of(F.substring(value, F.lit(1), code)))).otherwise(0)
        keep = F.greatest(n - 10, code)
        moved = F.concat(F.substring(d, F.lit(1), keep), permuted_digits(F.substring(d, keep + 1, n), "phone", key))
        return F.when((n >= 7) & (n <= 15) & (n >= keep + 2), put_back(value, moved))

    return let(digits_of(value), of)


PSEUDONYMS = {
    "email": email_pseudonym,
    "date": date_pseudonym,
    "ssn": ssn_pseudonym,
    "ip": ip_pseudonym,
    "card": card_pseudonym,
    "phone": phone_pseudonym,
}

_MARKS = (("\x03", "\x03\x06"), ("\x01", "\x03\x04"), ("\x02", "\x03\x05"))


def _replaced(text: Column, key: str) -> Column:
    """Array of ``(kind, text)`` parts of a text; kind is null where nothing was replaced."""
    clean = text
    for plain, safe in _MARKS:
        clean = F.replace(clean, F.lit(plain), F.lit(safe))
    parts = F.split(F.regexp_replace(clean, ANY, "\x01$0\x02"), "[\x01\x02]")

    def part(p: Column, i: Column) -> Column:
        plain = F.struct(F.lit(None).cast("string").alias("kind"), p.alias("text"))

        def made(kind: str) -> Column:
            named = F.lit(kind).alias("kind")
            return let(
                PSEUDONYMS[kind](p, key),
                lambda x: F.when(x.isNotNull(), F.struct(named, x.alias("text"))).otherwise(plain),
            )

        chosen = None
        for kind in KINDS:
            chosen = (F if chosen is None else chosen).when(p.rlike(f"^(?:{PATTERNS[kind]})$"), made(kind))
        return F.when(i % 2 == 1, chosen.otherwise(plain)).otherwise(plain)

    return F.transform(parts, part)


def session_key(spark: SparkSession) -> str:
    """The key in the session's setting ``KEY_SETTING``; a public one for tests where it is unset."""
    return spark.conf.get(KEY_SETTING, TEST_KEY)


def pseudonymize(docs: DataFrame, key: str, text: str = "text", counts: bool = True) -> DataFrame:
    """``docs`` with personal data in ``text`` replaced; ``counts`` adds ``n_email`` and so on.

    ``key`` decides the permutations, which it also undoes: keep it secret and fixed for a corpus.
    """
    column = F.col(f"`{text}`")
    out = docs.withColumn("_pii_parts", _replaced(column, key))
    joined = F.array_join(F.transform("_pii_parts", lambda p: p["text"]), "")
    for plain, safe in reversed(_MARKS):
        joined = F.replace(joined, F.lit(safe), F.lit(plain))
    new = {text: F.when(F.size("_pii_parts") > 1, joined).otherwise(column)}

    def count(kind: str) -> Column:
        found = F.size(F.filter("_pii_parts", lambda p: p["kind"] == kind))
        return F.when(column.isNull(), F.lit(0)).otherwise(found).cast("long")

    if counts:
        new |= {f"n_{kind}": count(kind) for kind in KINDS}
    return out.withColumns(new).drop("_pii_parts")
