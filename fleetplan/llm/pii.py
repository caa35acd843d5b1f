"""Format-preserving pseudonyms for personal data, in Spark SQL functions only.

Validated values (card numbers, bank accounts, social-security and phone
numbers, IPv4 addresses, dates, e-mail addresses) are replaced by a keyed
permutation within their own format. Equal values get equal pseudonyms in every
document, different values get different ones, and nothing needs a lookup table
or a shuffle: each row is rewritten where it lies.

The permutation is a Feistel network over mixed radices: a value v < a * b is
split into v div b and v mod b, and each round adds a keyed hash of one part to
the other, modulo that part's radix. So each domain (all dates of two centuries,
all ten-digit phone numbers, ...) is permuted exactly, without cycle walking.
Texts of characters (e-mail names, bank accounts) use the unbalanced form: each
step shifts one character within its class by a keyed hash of the others.

The hash is SHA-256 of key, kind, round and part. The key is a literal of the
query and so shows up in plans and event logs, which must be kept as the key is.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetplan.llm.common import fresh

DEFAULT_KEY = "pseudonym-key-1"
ROUNDS = 8
CHAR_PASSES = 3
FIRST_YEAR, LAST_YEAR = 1900, 2099

# Lengths of bank accounts by country. A match may not go on into the next word.
IBAN_LENGTHS = {
    15: "NO", 16: "BE", 18: "DK FI FK FO GL NL SD", 19: "MK SI", 20: "AT BA EE KZ LT LU MN XK", 21: "CH HR LI LV", 22: "BG BH CR DE GB GE IE ME RS VA",
    23: "AE GI IL IQ OM SO TL", 24: "AD CZ ES MD PK RO SA SE SK TN VG", 25: "AO CV GW LY MZ PT ST", 26: "DZ IR IS TR", 27: "BI CF CG CM DJ FR GA GQ GR IT KM MC MG MR SM TD",
    28: "AL AZ BF BJ BY CI CY DO GT HN HU LB MA ML NE NI PL SN SV TG", 29: "BR EG PS QA UA", 30: "JO KW MU YE", 31: "MT SC", 32: "LC", 33: "RU",
}


def _iban_core() -> str:
    """Accounts of their country's length, in groups of four; then others."""
    alike = []
    for n, codes in IBAN_LENGTHS.items():
        last = f" ?[A-Z0-9]{{{n % 4}}}" if n % 4 else ""
        alike.append(f"(?:{codes.replace(' ', '|')})[0-9]{{2}}(?: ?[A-Z0-9]{{4}}){{{n // 4 - 1}}}{last}(?![0-9A-Za-z])")
    return rf"(?=[A-Z]{{2}}[0-9]{{2}})(?:{'|'.join(alike)}|[A-Z]{{2}}[0-9]{{2}}(?: ?[A-Z0-9]{{4}}){{2,7}}(?: ?[A-Z0-9]{{1,3}})?)"


# Digits after the country code (least, most), by code. Numbers that don't fit go by the limits of E.164.
PHONE_DIGITS = {
    (6, 8): "352|960", (7, 7): "220|354", (7, 8): "373|376|423|506|961", (8, 8): "45|47|53|65|216|356|357|370|371|372|374|502|503|504|505|507|686|852|853|965|968|973|974|975|976|993",
    (7, 9): "353|359", (8, 9): "32|36|41|51|66|93|213|355|377|381|385|386|387|389|591|593|595|855|962|971|972",
    (9, 9): "27|31|33|34|40|48|56|61|84|94|212|218|221|233|251|254|255|256|260|263|351|375|380|382|420|421|886|963|966|967|970|992|994|995|996|998",
    (9, 10): "44|46|81|92|234", (8, 10): "20|57|60|63|64|82|95|856", (10, 10): "1|7|30|52|58|90|91|98|225|880|964|977", (10, 11): "54|55|86",
    (9, 11): "39|49|62|358", (9, 12): "43",
}
_LONE = r"(?<![0-9]{3} \(?[0-9]{1,2})"  # where lengths vary, a lone short number behind is another one
_NEXT_DIGIT = r"\)?[ .-]?\(?[0-9]"  # with what may stand before it


def _foreign_phone_core() -> str:
    """Numbers of their country's length, the trunk 0 in brackets not counted;
    then others of 8 to 15 digits. Neither ends within a group of digits."""
    alike = "|".join(rf"(?:{codes})(?:[ .-]?\(0\))?(?:{_NEXT_DIGIT}){{{a},{b}}}(?![0-9]){_LONE if a < b else ''}" for (a, b), codes in PHONE_DIGITS.items())
    return rf"\+(?:{alike}|[1-9](?:{_NEXT_DIGIT}){{7,14}})"


# Fixed patterns of the formats, in the order in which they are tried.
_OCTET = r"(?:25[0-5]|2[0-4][0-9]|1[0-9]{2}|[1-9]?[0-9])"
FORMATS = {
    "email": (r"(?<![A-Za-z0-9._%+-])", r"[A-Za-z0-9._%+-]{1,64}+@(?:[A-Za-z0-9-]{1,63}+\.){1,8}[A-Za-z]{2,24}+", ""),
    "ip": (r"(?<![0-9.])", rf"{_OCTET}(?:\.{_OCTET}){{3}}", r"(?![0-9]|\.[0-9])"),
    "date": (r"(?<![0-9./-])", r"(?:[0-9]{4}-[0-9]{2}-[0-9]{2}|[0-9]{1,2}([./-])[0-9]{1,2}\1[0-9]{4})", r"(?![0-9]|[./-][0-9])"),
    "ssn": (r"(?<![0-9-])", r"(?!000|666|9)[0-9]{3}-(?!00)[0-9]{2}-(?!0000)[0-9]{4}", r"(?![0-9]|-[0-9])"),
    "phone": (r"(?<![0-9A-Za-z+-])(?<![0-9][(.])", r"(?:\+?1[ .-]?)?(?:\([2-9][0-9]{2}\)[ .-]?|[2-9][0-9]{2}[ .-])[2-9][0-9]{2}[ .-][0-9]{4}", r"(?![0-9])"),
    "foreign_phone": (r"(?<![0-9A-Za-z+])", _foreign_phone_core(), r"(?![0-9])"),
    "iban": (r"(?<![0-9A-Za-z])", _iban_core(), r"(?![0-9A-Za-z])"),
    "card": (r"(?<![0-9A-Za-z])", r"(?:[0-9]{13,19}|(?:[0-9]{4}[ -]){3}[0-9]{4}|[0-9]{4}[ -][0-9]{6}[ -][0-9]{5})", r"(?![0-9A-Za-z])"),
}
KINDS = tuple(FORMATS)


def combined_pattern() -> str:
    """All formats as one alternation; the date's separator is a named group so
    that its number doesn't depend on the place."""
    parts = [f"{before}{core}{after}" for before, core, after in FORMATS.values()]
    return "|".join(parts).replace(r"([./-])", r"(?<sep>[./-])").replace(r"\1", r"\k<sep>")


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of ``value``, with ``value`` evaluated once: inside a lambda
    nothing else keeps Spark from evaluating an expression at each mention."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _at(value: Column, i: Column) -> Column:
    return F.substring(value, i, F.lit(1))


def keyed(key: str, kind: Column, step: Column, part: Column) -> Column:
    """60 bits of SHA-256 over key, kind, step and part, as a long."""
    text = F.concat_ws("|", F.lit(key), kind, step.cast("string"), part.cast("string"))
    return F.conv(F.substring(F.sha2(text, 256), 1, 15), 16, 10).cast("long")


def feistel(value: Column, a: Column, b: Column, key: str, kind: Column) -> Column:
    """A permutation of the longs below a * b, chosen by ``key`` and ``kind``."""
    start = F.struct(F.floor(value / b).cast("long").alias("l"), F.pmod(value, b).alias("r"))

    def turn(s: Column, k: Column) -> Column:
        left = F.struct(F.pmod(s["l"] + F.pmod(keyed(key, kind, k, s["r"]), a), a).alias("l"), s["r"].alias("r"))
        right = F.struct(s["l"].alias("l"), F.pmod(s["r"] + F.pmod(keyed(key, kind, k, s["l"]), b), b).alias("r"))
        return F.when(k % 2 == 1, left).otherwise(right)

    return F.aggregate(F.sequence(F.lit(1), F.lit(ROUNDS)), start, turn, lambda s: s["l"] * b + s["r"])


def shift_characters(value: Column, key: str, kind: Column) -> Column:
    """A permutation of the texts of one shape: digits stay digits, letters keep
    their case, other characters stay where they are."""

    def passes(given: Column) -> Column:
        n = F.length(given)

        def step(s: Column, k: Column) -> Column:
            i = k % F.length(s)
            char, left, right = _at(s, i + 1), F.substring(s, F.lit(1), i), F.substring(s, i + 2, F.length(s))
            shift = keyed(key, kind, k, F.concat(left, F.lit("\n"), right))
            move = lambda first, size: F.chr(F.pmod(F.ascii(char) - first + shift, F.lit(size)) + first)
            new = F.when(char.rlike("[0-9]"), move(48, 10)).when(char.rlike("[a-z]"), move(97, 26)).when(char.rlike("[A-Z]"), move(65, 26)).otherwise(char)
            return F.concat(left, new, right)

        return F.when(n > 0, F.aggregate(F.sequence(F.lit(0), n * CHAR_PASSES - 1), given, step)).otherwise(given)

    return let(value, passes)


def refill(value: Column, digits: Column) -> Column:
    """``value`` with its digits replaced by ``digits`` in order."""
    def fill(new: Column) -> Column:
        place = lambda i: F.length(_digits(F.substring(value, F.lit(1), i)))
        char = lambda i: F.when(_at(value, i).rlike("[0-9]"), _at(new, place(i))).otherwise(_at(value, i))
        return F.array_join(F.transform(F.sequence(F.lit(1), F.length(value)), char), "")

    return let(digits, fill)


def luhn_sum(digits: Column) -> Column:
    """The Luhn sum of a digit string whose last digit is the check digit."""
    n = F.length(digits)

    def add(total: Column, i: Column) -> Column:
        d = _at(digits, n - i + 1).cast("int")
        twice = F.when(d > 4, d * 2 - 9).otherwise(d * 2)
        return total + F.when(i % 2 == 0, twice).otherwise(d)

    return F.aggregate(F.sequence(F.lit(1), n), F.lit(0), add)


def _power(n: Column) -> Column:
    return F.rpad(F.lit("1"), n + 1, "0").cast("long")


def _permuted_digits(digits: Column, key: str, kind: Column) -> Column:
    """Digit strings of one length (at most 18), permuted among themselves."""
    n = F.length(digits)
    half = F.floor(n / 2).cast("int")
    return F.lpad(feistel(digits.cast("long"), _power(n - half), _power(half), key, kind).cast("string"), n, "0")


def _card(value: Column, key: str) -> Column:
    check = lambda body: F.pmod(10 - F.pmod(luhn_sum(F.concat(body, F.lit("0"))), F.lit(10)), F.lit(10))
    body = lambda d: _permuted_digits(F.substring(d, F.lit(1), F.length(d) - 1), key, F.concat(F.lit("card"), F.length(d)))
    return refill(value, let(let(_digits(value), body), lambda b: F.concat(b, check(b).cast("string"))))


def _phone(value: Column, key: str) -> Column:
    digits = F.substring(_digits(value), -10, 10)
    part = lambda i, n: F.substring(digits, i, n).cast("long")
    number = ((part(1, 3) - 200) * 800 + (part(4, 3) - 200)) * 10000 + part(7, 4)
    side = F.lit(80000).cast("long")
    new = feistel(number, side, side, key, F.lit("phone"))
    text = lambda x, n: F.lpad(x.cast("long").cast("string"), n, "0")
    parts = lambda v: F.concat(text(F.floor(v / 8000000) + 200, 3), text(F.pmod(F.floor(v / 10000), F.lit(800)) + 200, 3), text(F.pmod(v, F.lit(10000)), 4))
    return refill(value, F.concat(F.when(F.length(_digits(value)) == 11, F.lit("1")).otherwise(F.lit("")), let(new, parts)))


def _foreign_phone(value: Column, key: str) -> Column:
    """The first three digits, with the country code, stay; the rest moves."""
    digits = _digits(value)
    head = F.substring(digits, 1, 3)
    rest = F.substring(digits, F.lit(4), F.length(digits))
    return refill(value, F.concat(head, _permuted_digits(rest, key, F.concat(F.lit("tel"), head, F.lit("x"), F.length(rest)))))


def _ip(value: Column, key: str) -> Column:
    octet = lambda i: F.split(value, r"\.")[i].cast("long")
    number = ((octet(0) * 256 + octet(1)) * 256 + octet(2)) * 256 + octet(3)
    side = F.lit(65536).cast("long")
    new = feistel(number, side, side, key, F.lit("ip"))
    text = lambda v: F.concat_ws(".", *[F.pmod(F.shiftright(v, 8 * k), F.lit(256)).cast("string") for k in (3, 2, 1, 0)])
    return let(new, text)


def _ssn(value: Column, key: str) -> Column:
    """Areas 001 to 899 without 666, groups 01 to 99, serials 0001 to 9999."""
    part = lambda i: F.split(value, "-")[i].cast("long")
    area = part(0) - F.when(part(0) > 666, 2).otherwise(1)
    number = (area * 99 + part(1) - 1) * 9999 + part(2) - 1
    new = feistel(number, F.lit(898 * 99).cast("long"), F.lit(9999).cast("long"), key, F.lit("ssn"))
    text = lambda x, n: F.lpad(x.cast("long").cast("string"), n, "0")

    def format_(v: Column) -> Column:
        first = F.floor(v / (99 * 9999))
        return F.concat_ws("-", text(first + F.when(first >= 665, 2).otherwise(1), 3), text(F.pmod(F.floor(v / 9999), F.lit(99)) + 1, 2), text(F.pmod(v, F.lit(9999)) + 1, 4))

    return let(new, format_)


def _mod97(digits_and_letters: Column) -> Column:
    """An account's number modulo 97, letters counting from A = 10."""

    def add(rest: Column, i: Column) -> Column:
        char = _at(digits_and_letters, i)
        letter = F.ascii(char) - 55
        return F.when(char.rlike("[0-9]"), F.pmod(rest * 10 + F.ascii(char) - 48, F.lit(97))).otherwise(F.pmod(rest * 100 + letter, F.lit(97)))

    return F.aggregate(F.sequence(F.lit(1), F.length(digits_and_letters)), F.lit(0), add)


def _iban_valid(value: Column) -> Column:
    plain = F.translate(value, " ", "")
    return F.length(plain).between(15, 34) & (_mod97(F.concat(F.substring(plain, F.lit(5), F.length(plain)), F.substring(plain, 1, 4))) == 1)


def _iban(value: Column, key: str) -> Column:
    plain = F.translate(value, " ", "")
    country = F.substring(plain, 1, 2)
    account = shift_characters(F.substring(plain, F.lit(5), F.length(plain)), key, F.concat(F.lit("iban"), country))
    check = lambda a: F.lpad((98 - _mod97(F.concat(a, country, F.lit("00")))).cast("string"), 2, "0")
    new = let(account, lambda a: F.concat(country, check(a), a))
    place = lambda i: F.length(F.translate(F.substring(value, F.lit(1), i), " ", ""))
    char = lambda n: lambda i: F.when(_at(value, i) == " ", F.lit(" ")).otherwise(_at(n, place(i)))
    return let(new, lambda n: F.array_join(F.transform(F.sequence(F.lit(1), F.length(value)), char(n)), ""))


def _email(value: Column, key: str) -> Column:
    name, domain = F.split(value, "@")[0], F.split(value, "@")[1]
    return F.concat(shift_characters(name, key, F.concat(F.lit("email"), F.lower(domain))), F.lit("@"), domain)


# --- dates -----------------------------------------------------------------

_DAYS = 73049  # 1900-01-01 to 2099-12-31, which is 17 * 4297
_YEARS = LAST_YEAR - FIRST_YEAR + 1


def late_days() -> list[str]:
    """MM-dd for the days of a common year whose number is above 12."""
    lengths = [31, 28, 31, 30, 31, 30, 31, 31, 30, 31, 30, 31]
    return [f"{m + 1:02d}-{d:02d}" for m, n in enumerate(lengths) for d in range(13, n + 1)]


def _date_parts(value: Column) -> tuple[Column, Column]:
    """The value as ISO text, and whether it is written day first although it
    has slashes (then its day is above 12: otherwise slashes mean month first)."""
    parts = F.split(value, "[./-]")
    pad = lambda i: F.lpad(parts[i], 2, "0")
    dotted = ~value.contains("/")
    iso = F.length(parts[0]) == 4
    swapped = ~iso & ~dotted & (parts[0].cast("int") > 12)
    day_first = F.concat_ws("-", parts[2], pad(1), pad(0))
    month_first = F.concat_ws("-", parts[2], pad(0), pad(1))
    return F.when(iso, value).when(dotted | swapped, day_first).otherwise(month_first), swapped


def _date_valid(value: Column) -> Column:
    day = F.try_to_date(_date_parts(value)[0], "yyyy-MM-dd")
    return F.coalesce(F.year(day).between(FIRST_YEAR, LAST_YEAR), F.lit(False))


def _date(value: Column, key: str) -> Column:
    """All dates of two centuries are permuted; those that only make sense day
    first are permuted among themselves, 29 February among leap years."""
    text, swapped = _date_parts(value)
    long = lambda x: F.lit(x).cast("long")
    first = F.lit(f"{FIRST_YEAR}-01-01").cast("date")
    plain = feistel(F.datediff(F.try_to_date(text, "yyyy-MM-dd"), first).cast("long"), long(17), long(4297), key, F.lit("date"))
    plain = F.date_format(F.date_add(first, plain.cast("int")), "yyyy-MM-dd")
    days = late_days()
    listed = F.array(*map(F.lit, days))
    year = F.substring(text, 1, 4).cast("long")
    number = (year - FIRST_YEAR) * len(days) + F.array_position(listed, F.substring(text, 6, 5)) - 1
    late = feistel(number, long(_YEARS), long(len(days)), key, F.lit("day-first"))
    late = let(late, lambda v: F.concat_ws("-", (F.floor(v / len(days)) + FIRST_YEAR).cast("string"), F.element_at(listed, (F.pmod(v, F.lit(len(days))) + 1).cast("int"))))
    leap = feistel(F.floor((year - 1904) / 4).cast("long"), long(7), long(7), key, F.lit("leap-day"))
    leap = F.concat((leap * 4 + 1904).cast("string"), F.lit("-02-29"))
    new = F.when(~swapped, plain).when(F.substring(text, 6, 5) == "02-29", leap).otherwise(late)
    sep = F.regexp_extract(value, "[./-]", 0)
    parts = F.split(value, "[./-]")
    padded = F.when(F.least(F.length(parts[0]), F.length(parts[1])) > 1, F.lit(True)).otherwise(value.rlike(r"^0|[./-]0[0-9][./-]"))
    bare = lambda t: F.when(padded, t).otherwise(t.cast("int").cast("string"))

    def format_(d: Column) -> Column:
        y, m, t = F.substring(d, 1, 4), bare(F.substring(d, 6, 2)), bare(F.substring(d, 9, 2))
        month_first = value.contains("/") & ~swapped
        return F.when(F.length(parts[0]) == 4, d).when(month_first, F.concat(m, sep, t, sep, y)).otherwise(F.concat(t, sep, m, sep, y))

    return let(new, format_)


# --- the operator ----------------------------------------------------------

_TESTS: dict[str, Callable[[Column], Column]] = {
    "date": _date_valid,
    "iban": _iban_valid,
    "foreign_phone": lambda v: F.length(_digits(v)).between(8, 15),
    "card": lambda v: F.pmod(luhn_sum(_digits(v)), F.lit(10)) == 0,
}
_MAPS: dict[str, Callable[[Column, str], Column]] = {
    "email": _email, "ip": _ip, "date": _date, "ssn": _ssn, "phone": _phone, "foreign_phone": _foreign_phone, "iban": _iban, "card": _card,
}


def kind_of(value: Column) -> Column:
    """The kind of a matched value, '' where it doesn't pass validation."""
    out = F
    for kind, (_, core, _) in FORMATS.items():
        test = value.rlike(f"^(?:{core})$")
        test = test & _TESTS[kind](value) if kind in _TESTS else test
        out = out.when(test, F.lit(kind))
    return out.otherwise(F.lit(""))


def pseudonym(value: Column, kind: Column, key: str) -> Column:
    """The pseudonym of a value of a known kind; '' leaves it as it is."""
    out = F
    for name, change in _MAPS.items():
        out = out.when(kind == name, change(value, key))
    return out.otherwise(value)


def pseudonymise(docs: DataFrame, text: str = "text", key: str = DEFAULT_KEY, into: str | None = None) -> DataFrame:
    """``docs`` with the personal data in ``text`` replaced by pseudonyms.

    With ``into``, a map column of the number of replaced values by kind is
    added (an empty map where there are none). A null text stays null, empty
    and clean texts stay as they are, repeated rows get equal texts. Matches
    that fail validation (Luhn, modulo 97, impossible dates, dates outside 1900
    to 2099) stay. Offsets may change: an IPv4 address keeps its form, not its
    length. All other columns pass through.
    """
    taken = [*docs.columns, *([into] if into else [])]
    found, gaps, kinds = (fresh(taken, f"pii_{x}") for x in ("found", "gaps", "kinds"))
    body, pattern = F.col(text), combined_pattern()
    may = body.rlike("[0-9@]")  # every format needs one of these
    step = docs.withColumn(found, F.when(may, F.regexp_extract_all(body, F.lit(pattern), 0)).otherwise(F.array().cast("array<string>")))
    has = F.size(found) > 0
    step = step.withColumn(gaps, F.when(has, F.split(body, pattern, -1))).withColumn(kinds, F.transform(found, kind_of))
    new = F.zip_with(found, kinds, lambda v, k: pseudonym(v, k, key))
    pieces = F.zip_with(gaps, F.concat(new, F.array(F.lit(""))), lambda g, v: F.concat(g, v))
    if into:
        counts = F.map_from_arrays(F.array(*map(F.lit, KINDS)), F.array(*[F.size(F.filter(kinds, F.lit(k).__eq__)) for k in KINDS]))
        step = step.withColumn(into, F.map_filter(counts, lambda _, n: n > 0))
    return step.withColumn(text, F.when(has, F.array_join(pieces, "")).otherwise(body)).drop(found, gaps, kinds)


def masked_documents(docs: DataFrame, key: str = DEFAULT_KEY) -> DataFrame:
    """Every document with its pseudonymised text and the counts by kind."""
    out = pseudonymise(docs.select("doc_id", "text"), key=key, into="found")
    count = lambda k: F.coalesce(F.try_element_at("found", F.lit(k)), F.lit(0)).cast("long").alias(f"n_{k}")
    return out.select("doc_id", "text", *map(count, KINDS))
