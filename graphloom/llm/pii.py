"""Format-preserving pseudonyms for personal data, as column expressions only.

Numbers and dates that pass their own check (Luhn sum, octets, calendar, number plan) are permuted within their format
by a keyed Feistel network: the same value gets the same pseudonym everywhere, two values never share one, and digits,
letters and separators stay where they were. E-mail names and secrets are permuted character by character in the same
way, each within its class (digit, lower case, upper case). Key words of secrets count in any case, ``AKIA`` in capitals
only.
"""

from __future__ import annotations

import secrets

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from graphloom.llm.common import unused

ROUNDS = 8

EMAIL = r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+"
SECRET = r"(?<![A-Za-z0-9])AKIA[0-9A-Z]{16}(?![A-Za-z0-9])|(?<![A-Za-z0-9])(?i:password|passwd|token|secret|api_key|apikey)\s?[=:]\s?\"?[^\s\",;]{6,}"
#: Lengths of account numbers by country code, ISO 13616 and countries that use its form.
IBAN_LENGTHS = {
    15: "NO", 16: "BE", 18: "DK FI FK FO GL NL SD", 19: "MK SI", 20: "AT BA EE KZ LT LU MN XK", 21: "CH HR LI LV",
    22: "BG BH CR DE GB GE IE ME RS VA", 23: "AE GI IL IQ OM SO TL", 24: "AD CZ ES MD PK RO SA SE SK TN VG",
    25: "AO CV GW LY MZ PT ST", 26: "DZ IR IS TR", 27: "BI CF CG CM DJ FR GA GQ GR IT KM MC MG MR SM TD",
    28: "AL AZ BF BJ BY CI CY DO GT HN HU LB MA ML NE NI PL SN SV TG", 29: "BR EG PS QA UA", 30: "JO KW MU YE", 31: "MT SC",
    32: "LC", 33: "RU",
}


def _iban_of(length: int, countries: str) -> str:
    groups, rest = divmod(length - 4, 4)
    tail = f" ?[A-Z0-9]{{{rest}}}" if rest else ""
    return rf"(?:{countries.replace(' ', '|')})\d{{2}}(?: ?[A-Z0-9]{{4}}){{{groups}}}{tail}"


#: A number as long as its country says, so that a word after it stays out; other codes and lengths as far as they go.
IBAN = (
    r"(?<![A-Za-z0-9])(?=[A-Z]{2}\d{2})(?:" + "|".join(_iban_of(*item) for item in IBAN_LENGTHS.items())
    + r"|[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?)(?![A-Za-z0-9])"
)
PHONE = r"(?<![\w+])(?:\+\d{1,3}[ .-]?)?(?:\(\d{3}\) ?|\d{3}[ .-])\d{3}[ .-]\d{4}(?!\w)"
SSN = r"(?<![\w-])\d{3}-\d{2}-\d{4}(?![\w-])"
OCTET = r"(?:25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)"
IPV4 = rf"(?<![\w.]){OCTET}(?:\.{OCTET}){{3}}(?!\w|\.\d)"
ISO_DATE = r"(?<![\w-])\d{4}-\d{2}-\d{2}(?![\w-])"
CARD = r"(?<![\w-])(?:\d{13,19}|\d{4}[ -]\d{4}[ -]\d{4}[ -]\d{1,7}|\d{4}[ -]\d{6}[ -]\d{5})(?![\w-])"
#: Days of 400 Gregorian years from 1800-01-01, as the two moduli of the dates' Feistel network.
FIRST_DAY, DAYS = "1800-01-01", (189, 773)


def _hash(key: str, kind: str, turn: Column, source: Column) -> Column:
    return F.sha2(F.concat_ws("|", F.lit(key), F.lit(kind), turn.cast("string"), source.cast("string")), 256)


def _let(value: Column, body) -> Column:
    """``body(value)`` with the value computed once."""
    return F.transform(F.array(value), body)[0]


def _chars(value: Column) -> Column:
    return F.filter(F.split(value, ""), lambda c: c != "")


def permute_text(value: Column, key: str, kind: str) -> Column:
    """Feistel over the halves of a text; each round shifts the characters of one half within their classes."""

    def shifted(target: Column, source: Column, turn: Column) -> Column:
        def one(digest: Column, c: Column, i: Column) -> Column:
            by = F.conv(F.substr(digest, i % F.lit(16) * F.lit(4) + F.lit(1), F.lit(4)), 16, 10).cast("int") + i
            move = lambda first, size: F.char(F.lit(first) + (F.ascii(c) - F.lit(first) + by) % F.lit(size))
            return (
                F.when(c.between("0", "9"), move(48, 10)).when(c.between("a", "z"), move(97, 26))
                .when(c.between("A", "Z"), move(65, 26)).otherwise(c)
            )

        return _let(_hash(key, kind, turn, source), lambda d: F.array_join(F.transform(_chars(target), lambda c, i: one(d, c, i)), ""))

    half = F.floor(F.length(value) / 2).cast("int")
    start = F.struct(F.substr(value, F.lit(1), half).alias("l"), F.substr(value, half + F.lit(1), F.length(value)).alias("r"))
    turns = F.sequence(F.lit(1), F.lit(ROUNDS))
    step = lambda s, t: F.struct(s["r"].alias("l"), shifted(s["l"], s["r"], t).alias("r"))
    return F.aggregate(turns, start, step, lambda s: F.concat(s["l"], s["r"]))


def permute_number(left: Column, right: Column, left_size: Column, right_size: Column, key: str, kind: str) -> Column:
    """Feistel over ``left`` modulo ``left_size`` and ``right`` modulo ``right_size``; a struct of both (``l``, ``r``)."""

    def turn(s: Column, t: Column) -> Column:
        odd = t % F.lit(2) == F.lit(1)
        by = F.conv(F.substr(_hash(key, kind, t, F.when(odd, s["r"]).otherwise(s["l"])), F.lit(1), F.lit(15)), 16, 10).cast("bigint")
        return F.struct(
            F.when(odd, (s["l"] + by % left_size) % left_size).otherwise(s["l"]).alias("l"),
            F.when(odd, s["r"]).otherwise((s["r"] + by % right_size) % right_size).alias("r"),
        )

    start = F.struct(left.cast("bigint").alias("l"), right.cast("bigint").alias("r"))
    return F.aggregate(F.sequence(F.lit(1), F.lit(ROUNDS)), start, turn)


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, r"[^0-9]", "")


def _number(value: Column, start: int, size: int) -> Column:
    return F.substr(value, F.lit(start), F.lit(size)).cast("bigint")


def _refill(shape: Column, values: Column, of: str) -> Column:
    """``shape`` with its characters of class ``of`` replaced in order by those of ``values``."""

    def one(c: Column, i: Column) -> Column:
        place = F.length(F.regexp_replace(F.substr(shape, F.lit(1), i + F.lit(1)), f"[^{of}]", ""))
        return F.when(c.rlike(f"[{of}]"), F.substr(values, place, F.lit(1))).otherwise(c)

    return F.array_join(F.transform(_chars(shape), one), "")


def _pad(value: Column, size: int) -> Column:
    return F.lpad(value.cast("string"), size, "0")


def _luhn(digits: Column) -> Column:
    return F.call_function("luhn_check", digits)


def _card(m: Column, key: str) -> Column:
    digits = _digits(m)
    check = lambda body: F.filter(F.array(*[F.lit(str(d)) for d in range(10)]), lambda d: _luhn(F.concat(body, d)))[0]
    body = permute_text(F.substr(digits, F.lit(1), F.length(digits) - F.lit(1)), key, "card")
    new = _let(_let(body, lambda b: F.concat(b, check(b))), lambda n: _refill(m, n, "0-9"))
    return F.when(_luhn(digits), new).otherwise(m)


def _mod97(value: Column) -> Column:
    """An IBAN-like text, moved and spelled in digits, modulo 97."""
    moved = F.concat(F.substr(value, F.lit(5), F.length(value)), F.substr(value, F.lit(1), F.lit(4)))
    step = lambda s, c: F.when(c.between("0", "9"), s * F.lit(10) + F.ascii(c) - F.lit(48)).otherwise(s * F.lit(100) + F.ascii(c) - F.lit(55)) % F.lit(97)
    return F.aggregate(_chars(moved), F.lit(0), step)


def _iban(m: Column, key: str) -> Column:
    plain = F.replace(m, F.lit(" "), F.lit(""))
    country = F.substr(plain, F.lit(1), F.lit(2))
    body = permute_text(F.substr(plain, F.lit(5), F.length(plain)), key, "iban")
    check = lambda b: _pad(F.lit(98) - _mod97(F.concat(country, F.lit("00"), b)), 2)
    new = _let(_let(body, lambda b: F.concat(country, check(b), b)), lambda n: _refill(m, n, "0-9A-Z"))
    good = F.length(plain).between(15, 34) & (_mod97(plain) == F.lit(1))
    return F.when(good, new).otherwise(m)


def _phone(m: Column, key: str) -> Column:
    """The last ten digits; area and exchange codes keep whether they begin with 2 to 9, so plan numbers stay so."""
    digits = _digits(m)
    front = F.substr(digits, F.lit(1), F.length(digits) - F.lit(10))
    own = F.substr(digits, F.length(digits) - F.lit(9), F.lit(10))
    area, exchange, line = _number(own, 1, 3), _number(own, 4, 3), _number(own, 7, 4)
    base = lambda code: F.when(code >= 200, F.lit(200)).otherwise(F.lit(0)).cast("bigint")
    size = lambda code: F.when(code >= 200, F.lit(800)).otherwise(F.lit(200)).cast("bigint")
    left = (area - base(area)) * size(exchange) + exchange - base(exchange)
    codes = lambda new: F.concat(
        front, _pad(F.floor(new["l"] / size(exchange)) + base(area), 3), _pad(new["l"] % size(exchange) + base(exchange), 3), _pad(new["r"], 4)
    )
    new = permute_number(left, line, size(area) * size(exchange), F.lit(10000).cast("bigint"), key, "phone")
    return _let(_let(new, codes), lambda digits: _refill(m, digits, "0-9"))


def _ssn(m: Column, key: str) -> Column:
    """Areas 001 to 899 without 666 are numbered through, so the pseudonym is a valid number too."""
    digits = _digits(m)
    area, group, serial = _number(digits, 1, 3), _number(digits, 4, 2), _number(digits, 6, 4)
    rank = area - F.lit(1) - F.when(area > 666, F.lit(1)).otherwise(F.lit(0))
    good = (area >= 1) & (area != 666) & (area < 900) & (group >= 1) & (serial >= 1)
    new = permute_number(rank * F.lit(99) + group - F.lit(1), serial - F.lit(1), F.lit(898 * 99).cast("bigint"), F.lit(9999).cast("bigint"), key, "ssn")
    first = lambda n: F.floor(n["l"] / F.lit(99)) + F.lit(1)
    area_of = lambda n: first(n) + F.when(first(n) >= 666, F.lit(1)).otherwise(F.lit(0))
    text = lambda n: F.concat_ws("-", _pad(area_of(n), 3), _pad(n["l"] % F.lit(99) + F.lit(1), 2), _pad(n["r"] + F.lit(1), 4))
    return F.when(good, _let(new, text)).otherwise(m)


def _ipv4(m: Column, key: str) -> Column:
    octets = F.transform(F.split(m, r"\."), lambda o: o.cast("bigint"))
    word = F.lit(65536).cast("bigint")
    new = permute_number(octets[0] * F.lit(256) + octets[1], octets[2] * F.lit(256) + octets[3], word, word, key, "ip")
    high, low = (lambda x: F.floor(x / F.lit(256)).cast("string")), (lambda x: (x % F.lit(256)).cast("string"))
    return _let(new, lambda n: F.concat_ws(".", high(n["l"]), low(n["l"]), high(n["r"]), low(n["r"])))


def _date(m: Column, key: str, patterns: tuple[str, ...]) -> Column:
    """A calendar day of 1800 to 2199; of several readings the first valid one."""
    out = m
    for pattern in reversed(patterns):
        day = F.try_to_timestamp(m, F.lit(pattern)).cast("date")
        place = F.date_diff(day, F.lit(FIRST_DAY).cast("date")).cast("bigint")
        a, b = DAYS
        new = permute_number(F.floor(place / F.lit(b)), place % F.lit(b), F.lit(a).cast("bigint"), F.lit(b).cast("bigint"), key, "date")
        moved = _let(new, lambda n: F.date_add(F.lit(FIRST_DAY).cast("date"), (n["l"] * F.lit(DAYS[1]) + n["r"]).cast("int")))
        out = F.when(place.between(0, a * b - 1), F.date_format(moved, pattern)).otherwise(out)
    return out


def _email(m: Column, key: str) -> Column:
    return F.concat(permute_text(F.substring_index(m, "@", 1), key, "email"), F.lit("@"), F.substring_index(m, "@", -1))


def _secret(m: Column, key: str) -> Column:
    """The part after the mark ``AKIA`` or after the sign."""
    front = F.regexp_extract(m, r"^(AKIA|[A-Za-z_]+\s?[=:]\s?\"?)", 1)
    return F.concat(front, permute_text(F.substr(m, F.length(front) + F.lit(1), F.length(m)), key, "secret"))


_KINDS = (
    (EMAIL, _email), (SECRET, _secret), (IBAN, _iban), (PHONE, _phone), (SSN, _ssn), (IPV4, _ipv4),
    (ISO_DATE, lambda m, key: _date(m, key, ("yyyy-MM-dd",))),
    (r"(?<![\w/.])\d{2}/\d{2}/\d{4}(?![\w/])", lambda m, key: _date(m, key, ("dd/MM/yyyy", "MM/dd/yyyy"))),
    (r"(?<![\w/.])\d{2}\.\d{2}\.\d{4}(?!\w)", lambda m, key: _date(m, key, ("dd.MM.yyyy", "MM.dd.yyyy"))),
    (CARD, _card),
)
ANY = "|".join(pattern for pattern, _ in _KINDS)


def pseudonym(match: Column, key: str) -> Column:
    """The pseudonym of one found value; values that fail their check stay."""
    out = match
    for pattern, make in reversed(_KINDS):
        out = F.when(match.rlike(f"^(?:{pattern})$"), make(match, key)).otherwise(out)
    return out


def pseudonymise(docs: DataFrame, text: str = "text", key: str | None = None, count: str | None = None) -> DataFrame:
    """``docs`` with personal values in ``text`` replaced, and with their number in the column ``count`` if one is named.

    Whoever knows the key can undo the pseudonyms: it belongs to the caller. Without one a random key is drawn for this
    call, so that equal values stay linked within its result and nowhere else. Null texts stay null (number 0), empty
    ones empty; repeated rows change alike; other columns are untouched, whatever their names. An empty table stays so.
    A text is searched once as a whole; only rows with a digit, ``@``, ``=``, ``:`` or ``AKIA`` can hold anything.
    """
    key = secrets.token_hex(16) if key is None else key
    found, new = unused([*docs.columns, count or ""], "_found", "_new")
    own = F.col(f"`{text}`")
    suspect = own.rlike(r"[0-9@=:]|AKIA")
    marked = docs.withColumn(found, F.when(suspect, F.regexp_extract_all(own, F.lit(ANY), F.lit(0)))).withColumn(
        new, F.when(F.size(found) > 0, F.transform(found, lambda m: pseudonym(m, key)))
    )
    gaps = F.split(own, ANY, -1)
    joined = F.concat(F.array_join(F.zip_with(gaps, F.concat(F.col(new), F.array(F.lit(""))), lambda g, v: F.concat(g, v)), ""))
    out = marked.withColumn(text, F.when(F.col(new).isNotNull(), joined).otherwise(own))
    if count:
        changed = F.size(F.filter(F.zip_with(found, new, lambda a, b: a != b), lambda x: x))
        out = out.withColumn(count, F.coalesce(F.when(F.col(new).isNotNull(), changed), F.lit(0)).cast("long"))
    return out.drop(found, new)
