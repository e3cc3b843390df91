"""Format-preserving pseudonyms for personal data, with DataFrame functions only.

Values that are valid (a card's check digit, a real date, octets up to 255, a
possible phone or security number) go through a keyed Feistel network over just
the values of their format: two parts in turn get a keyed hash of the other part
added, modulo their own size. That is a permutation, so equal values stay equal
in all documents and different ones differ. Names in e-mail addresses and
secrets, which have no number range, go through the same network letter by
letter, small letters, capitals and digits staying what they are. Text around
the values is not touched; invalid look-alikes stay.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stocktake.llm.columns import bound, free_name

ROUNDS = 10
FIRST_DAY = "1900-01-01"
#: Days from FIRST_DAY on that dates are permuted among, as the product of the two parts' sizes.
DAY_PARTS = (150, 487)

#: Codes of countries but North America's: of one, two or three digits.
COUNTRY_CODE = r"^(?:7|2[07]|3[0-469]|4[013-9]|5[1-8]|6[0-6]|8[1246]|9[0-58]|\d{3})"
_OCTET = r"(?:25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)"
#: Shapes by kind, tried in this order at each place.
SHAPES = {
    # mail: possessive, as a group that may give back repetitions costs a stack frame for each
    # phones: after +1 no separator is needed; without +1 one between the groups, or none at all in a number that stands alone
    "email": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]+@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "secret": r"(?<![A-Za-z])(?i:password|passwd|secret|api[_-]?key|access[_-]?key|token)[ \t]{0,3}[=:][ \t]{0,3}[\"']?[A-Za-z0-9_/+=-]{8,}",
    "date": r"(?<![\d-])\d{4}-\d\d-\d\d(?![\d-])|(?<![\d./])\d\d([./])\d\d\1\d{4}(?!\d)",
    "ssn": r"(?<![\d-])\d{3}-\d\d-\d{4}(?![\d-])",
    "ip": rf"(?<![\d.]){_OCTET}(?:\.{_OCTET}){{3}}(?!\.?\d)",
    "phone": r"(?<![\d+])(?:\+?1[ .-]?)?(?:\([2-9]\d\d\) ?|[2-9]\d\d[ .-])[2-9]\d\d[ .-]?\d{4}(?![\d-])|(?<![\d+])\+1[ .-]?[2-9]\d\d[2-9]\d\d[ .-]?\d{4}(?![\d-])|(?<![\w.+-])1?[2-9]\d\d[2-9]\d{6}(?![\w-]|\.\d)|(?<![\d+])\+[2-9]\d{0,2}(?:[ .-]?\d{2,4}){2,4}(?!\d)",
    "card": r"(?<![\d.-])\d(?:[ -]?\d){12,18}(?![\d-])",
}
PATTERN = "|".join(f"(?:{shape.replace('([./])', f'(?<dot>[./])').replace(chr(92) + '1', chr(92) + 'k<dot>')})" for shape in SHAPES.values())
_MAYBE = r"[0-9@]|(?i:password|passwd|secret|key|token)"


def _hash(key: str, kind: str, step: Column, other: Column) -> Column:
    """A keyed number below 2^60."""
    text = F.concat_ws("|", F.lit(key), F.lit(kind), step.cast("string"), other.cast("string"))
    return F.conv(F.substring(F.sha2(text, 256), 1, 15), 16, 10).cast("long")


def permuted(value: Column, a: Column, b: Column, key: str, kind: str) -> Column:
    """The number that stands for ``value``, of those below ``a * b``."""

    def step(state: Column, i: Column) -> Column:
        left, right = state["l"], state["r"]
        first = F.struct(((left + _hash(key, kind, i, right)) % a).alias("l"), right.alias("r"))
        second = F.struct(left.alias("l"), ((right + _hash(key, kind, i, left)) % b).alias("r"))
        return F.when(i % 2 == 0, first).otherwise(second)

    start = F.struct(F.call_function("div", value, b).alias("l"), (value % b).cast("long").alias("r"))
    return F.aggregate(F.sequence(F.lit(0), F.lit(ROUNDS - 1)), start, step, lambda s: s["l"] * b + s["r"])


def permuted_letters(text: Column, key: str, kind: str) -> Column:
    """Text of the same length and the same classes of characters; others than a-z, A-Z, 0-9 stay."""

    def moved(part: Column, i: Column, other: Column) -> Column:
        # the other half is hashed once a round, so the work grows with the text and not with its square
        return bound(F.sha2(other, 256), lambda digest: by_letter(part, i, digest))

    def by_letter(part: Column, i: Column, digest: Column) -> Column:
        def one(c: Column, place: Column) -> Column:
            code = F.ascii(c)
            by = _hash(key, kind, F.concat_ws(":", i, place), digest)
            ring = lambda low, n: F.char(F.lit(low) + (code - low + by) % n)
            return F.when(c.rlike("^[a-z]$"), ring(97, 26)).when(c.rlike("^[A-Z]$"), ring(65, 26)).when(c.rlike("^[0-9]$"), ring(48, 10)).otherwise(c)

        return F.array_join(F.transform(F.split(part, ""), one), "")

    def step(state: Column, i: Column) -> Column:
        left, right = state["l"], state["r"]
        first = F.struct(moved(left, i, right).alias("l"), right.alias("r"))
        second = F.struct(left.alias("l"), moved(right, i, left).alias("r"))
        return F.when(i % 2 == 0, first).otherwise(second)

    half = F.floor(F.char_length(text) / 2).cast("int")
    start = F.struct(F.substring(text, F.lit(1), half).alias("l"), F.substring(text, half + 1, F.char_length(text)).alias("r"))
    return F.aggregate(F.sequence(F.lit(0), F.lit(ROUNDS - 1)), start, step, lambda s: F.concat(s["l"], s["r"]))


def _digits(text: Column) -> Column:
    return F.regexp_replace(text, r"\D", "")


def _filled(shape: Column, digits: Column) -> Column:
    """``shape`` with its digits replaced, one after the other."""

    def one(c: Column, i: Column) -> Column:
        return F.when(c.rlike(r"^\d$"), F.substring(digits, F.char_length(_digits(F.substring(shape, F.lit(1), i + 1))), F.lit(1))).otherwise(c)

    return F.array_join(F.transform(F.split(shape, ""), one), "")


def _padded(number: Column, width: Column | int) -> Column:
    return F.lpad(number.cast("string"), width, "0")


def check_digit(digits: Column) -> Column:
    """The last digit that makes a number of these digits pass the mod-10 check."""

    def one(c: Column, i: Column) -> Column:
        d = c.cast("int")
        twice = F.when(d > 4, 2 * d - 9).otherwise(2 * d)
        return F.when(i % 2 == 0, twice).otherwise(d)

    total = F.aggregate(F.transform(F.split(F.reverse(digits), ""), one), F.lit(0), lambda a, x: a + x)
    return ((10 - total % 10) % 10).cast("string")


def _card(m: Column, key: str) -> Column:
    def of_digits(d: Column) -> Column:
        n = F.char_length(d)
        body = F.substring(d, F.lit(1), n - 1)
        size = lambda k: F.pow(F.lit(10.0), k).cast("long")
        half = F.floor((n - 1) / 2).cast("int")
        new = bound(_padded(permuted(body.cast("long"), size(n - 1 - half), size(half), key, "card"), n - 1), lambda x: F.concat(x, check_digit(x)))
        valid = (F.substring(d, n, F.lit(1)) == check_digit(body)) & d.rlike("[1-9]")
        return F.when(valid, _filled(m, new)).otherwise(m)

    return bound(_digits(m), of_digits)


def _phone(m: Column, key: str) -> Column:
    def of_digits(d: Column) -> Column:
        # area and exchange begin with 2 to 9: 800 of each
        own = F.substring(d, F.char_length(d) - 9, F.lit(10))
        area, rest = F.substring(own, 1, 3).cast("long") - 200, F.substring(own, 4, 7).cast("long") - 2_000_000
        new = permuted(area * 8_000_000 + rest, F.lit(800), F.lit(8_000_000), key, "phone")
        north = bound(new, lambda x: _filled(m, F.concat(F.substring(d, F.lit(1), F.char_length(d) - 10), (F.floor(x / 8_000_000) + 200).cast("string"), (x % 8_000_000 + 2_000_000).cast("string"))))
        # the digits after the country's code, whatever stands between them
        code = F.regexp_extract(d, COUNTRY_CODE, 0)
        width = F.char_length(d) - F.char_length(code)
        number = F.substring(d, F.char_length(code) + 1, width).cast("long")
        size = lambda k: F.pow(F.lit(10.0), k).cast("long")
        half = F.floor(width / 2).cast("int")
        abroad = _filled(m, F.concat(code, _padded(permuted(number, size(width - half), size(half), key, "abroad"), width)))
        return F.when(~m.rlike(r"^\+[2-9]"), north).when(F.char_length(d).between(8, 15), abroad).otherwise(m)

    return bound(_digits(m), of_digits)


def _ssn(m: Column, key: str) -> Column:
    area, group, serial = (F.substring(m, a, n).cast("long") for a, n in ((1, 3), (5, 2), (8, 4)))
    valid = (area != 0) & (area != 666) & (area < 900) & (group != 0) & (serial != 0)
    rank = F.when(area > 666, area - 2).otherwise(area - 1)
    value = (rank * 99 + group - 1) * 9999 + serial - 1

    def shown(x: Column) -> Column:
        new = F.floor(x / (99 * 9999))
        return F.concat_ws("-", _padded(F.when(new >= 665, new + 2).otherwise(new + 1), 3), _padded(F.floor(x / 9999) % 99 + 1, 2), _padded(x % 9999 + 1, 4))

    return F.when(valid, bound(permuted(value, F.lit(898), F.lit(99 * 9999), key, "ssn"), shown)).otherwise(m)


def _ip(m: Column, key: str) -> Column:
    part = lambda i: F.split(m, r"\.")[i].cast("long")
    value = ((part(0) * 256 + part(1)) * 256 + part(2)) * 256 + part(3)
    shown = lambda x: F.concat_ws(".", *((F.floor(x / 256**k) % 256).cast("string") for k in (3, 2, 1, 0)))
    return bound(permuted(value, F.lit(65536), F.lit(65536), key, "ip"), shown)


def _date(m: Column, key: str) -> Column:
    """Year first, else day first, else month first; days outside the range stay."""
    mark = F.substring(m, 3, 1)
    iso = m.rlike(r"^\d{4}")
    ends = F.substring(m, 7, 4), F.substring(m, 4, 2), F.substring(m, 1, 2)
    to_date = lambda y, a, b: F.try_to_date(F.concat_ws("-", y, a, b), "yyyy-MM-dd")
    day_first, month_first = to_date(*ends), to_date(ends[0], ends[2], ends[1])
    day = F.when(iso, F.try_to_date(m, "yyyy-MM-dd")).otherwise(F.coalesce(day_first, month_first))
    value = F.datediff(day, F.lit(FIRST_DAY).cast("date"))
    a, b = DAY_PARTS

    def shown(x: Column) -> Column:
        new = F.date_add(F.lit(FIRST_DAY).cast("date"), x.cast("int"))
        y, mo, d = (F.date_format(new, f) for f in ("yyyy", "MM", "dd"))
        return F.when(iso, F.concat_ws("-", y, mo, d)).when(day_first.isNotNull(), F.concat(d, mark, mo, mark, y)).otherwise(F.concat(mo, mark, d, mark, y))

    inside = F.coalesce(value.between(0, a * b - 1), F.lit(False))
    return F.when(inside, bound(permuted(value.cast("long"), F.lit(a), F.lit(b), key, "date"), shown)).otherwise(m)


def _email(m: Column, key: str) -> Column:
    at = F.instr(m, "@")
    return F.concat(permuted_letters(F.substring(m, F.lit(1), at - 1), key, "email"), F.substring(m, at, F.char_length(m)))


def _secret(m: Column, key: str) -> Column:
    name = F.regexp_extract(m, r"^[A-Za-z_-]+[ \t]*[=:][ \t]*[\"']?", 0)
    return F.concat(name, permuted_letters(F.substring(m, F.char_length(name) + 1, F.char_length(m)), key, "secret"))


KINDS: dict[str, Callable[[Column, str], Column]] = {"email": _email, "secret": _secret, "date": _date, "ssn": _ssn, "ip": _ip, "phone": _phone, "card": _card}
_MARKS = {"email": "@", "secret": r"^[A-Za-z].*[=:]", "date": r"^(\d{4}-\d\d-\d\d|\d\d[./]\d\d[./]\d{4})$", "ssn": r"^\d{3}-\d\d-\d{4}$", "ip": r"^\d+(\.\d+){3}$", "phone": r"^(\+.*|1?[ .-]?\(.*|(1[ .-]?)?\d{3}[ .-]?\d{3}[ .-]?\d{4})$"}


def _kind(m: Column) -> Column:
    kind = F.lit(None).cast("string")
    first, *rest = _MARKS.items()
    kind = F.when(m.rlike(first[1]), first[0])
    for name, mark in rest:
        kind = kind.when(m.rlike(mark), name)
    return kind.otherwise("card")


def _pseudonym(kind: Column, m: Column, key: str) -> Column:
    (first, make), *rest = KINDS.items()
    new = F.when(kind == first, make(m, key))
    for name, make in rest:
        new = new.when(kind == name, make(m, key))
    return new.otherwise(m)


def pseudonymised(docs: DataFrame, key: str, text_col: str = "text") -> DataFrame:
    """``docs`` with its text's personal values replaced, and a column ``pii`` of arrays (kind, value, pseudonym).

    Null texts stay null and have no values, empty ones too; repeated rows get
    the same pseudonyms, as all equal values under one key; other columns and
    nulls in them are kept; an empty table gives no rows. A column of ``docs``
    named ``pii`` gives way to the new one. Texts and values of any length are
    taken whole, in time that grows with their length.
    """
    every = free_name(docs, "_all")
    text = F.col(f"`{text_col}`").cast("string")
    maybe = text.rlike(_MAYBE)
    matches = F.when(maybe, F.regexp_extract_all(text, F.lit(PATTERN), F.lit(0)))

    def entry(m: Column) -> Column:
        return bound(_kind(m), lambda kind: F.struct(kind.alias("kind"), m.alias("value"), _pseudonym(kind, m, key).alias("pseudonym")))

    # generated, not projected: so it is computed once for both columns
    found = docs.select("*", F.explode(F.array(F.transform(matches, entry))).alias(every))
    between = F.split(text, PATTERN, -1)
    joined = F.array_join(F.zip_with(between, F.col(every), lambda t, m: F.concat(t, F.coalesce(m["pseudonym"], F.lit("")))), "")
    changed = F.when(F.size(every) > 0, joined).otherwise(text)
    # a permutation may map a value to itself, so what is valid is asked of the kind's own rule: invalid ones are returned as they are
    listed = F.coalesce(F.filter(every, lambda e: e["value"] != e["pseudonym"]), F.array().cast("array<struct<kind:string,value:string,pseudonym:string>>"))
    return found.withColumn(text_col, changed).withColumn("pii", listed).drop(every)
