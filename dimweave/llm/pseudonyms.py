"""Format-preserving pseudonyms for personal data, in SQL functions only.

Values are found by pattern, validated, and permuted by a keyed Feistel
network within their own format: a card number becomes another card number
with a right check digit, a date another date, an address another address.
Under one key equal values get equal pseudonyms in all documents, and
different values of one format different ones.

* card: 13 to 19 digits (plain, in groups of four, or 4-6-5 and 4-6-4) with a
  right Luhn digit; all but the check digit are permuted, the check digit is computed anew;
* iban: right modulo 97, of its country's length where a text of that length
  is right (an upper-case word behind it isn't taken for a group); letters and digits of the account are permuted within
  their class, the check digits computed anew;
* ssn: ddd-dd-dddd within the assigned ranges, permuted within them;
* date: an existing day of 1800 to 2199 written y-m-d, m/d/y or d.m.y,
  permuted among these 146,097 days; a time may follow behind a T;
* ipv4: four numbers up to 255 without leading zeros, permuted as 32 bits;
* phone: the digits behind the country code (known by its own digits, so that
  a number has one pseudonym with and without separators), as many as the country's numbers
  have where that is fixed, or up to a last group behind a dash or dot;
* email: letters and digits of the local part, within their class;
* secret: the value assigned to a token, key, secret or password.

Candidates that fail their validation stay as they are; what looks like an IBAN
and isn't one is searched for the other values.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ROUNDS = 8
#: Session setting that holds the key of registered queries, and what they use
#: where it is unset.
KEY_SETTING = "spark.dimweave.pseudonyms.key"
TEST_KEY = "not a secret: set spark.dimweave.pseudonyms.key"

_CARD = r"(?:[0-9]{13,19}|[0-9]{4}(?:-[0-9]{4}){2}-[0-9]{1,7}|[0-9]{4}(?: [0-9]{4}){2} [0-9]{1,7}|[0-9]{4}-[0-9]{6}-[0-9]{4,5}|[0-9]{4} [0-9]{6} [0-9]{4,5})"
_IBAN = r"[A-Z]{2}[0-9]{2}(?:[A-Z0-9]{11,30}|(?: [A-Z0-9]{4}){2,7}(?: [A-Z0-9]{1,3})?)"
#: Countries by the length of their IBANs.
IBAN_LENGTHS = {
    15: "NO", 16: "BE", 18: "DK FI FK FO GL NL SD", 19: "MK SI", 20: "AT BA EE KZ LT LU MN XK", 21: "CH HR LI LV",
    22: "BG BH CR DE GB GE IE ME RS VA", 23: "AE GI IL IQ OM SO TL", 24: "AD CZ ES MD PK RO SA SE SK TN VG", 25: "LY PT ST",
    26: "IS TR", 27: "BI DJ FR GR IT MC MR SM", 28: "AL AZ BY CY DO GT HN HU LB NI PL SV", 29: "BR EG PS QA UA",
    30: "JO KW MU YE", 31: "MT SC", 32: "LC", 33: "RU",
}


def _iban_of(n: int, countries: str) -> str:
    groups, rest = divmod(n - 4, 4)
    spaced = f"(?: [A-Z0-9]{{4}}){{{groups}}}" + (f" [A-Z0-9]{{{rest}}}" if rest else "")
    return f"(?:{countries.replace(' ', '|')})[0-9]{{2}}(?:[A-Z0-9]{{{n - 4}}}|{spaced})(?![A-Za-z0-9])"


_COUNTRY_IBAN = f"(?=[A-Z]{{2}}[0-9]{{2}})(?:{'|'.join(_iban_of(n, c) for n, c in IBAN_LENGTHS.items())})"
_SSN = r"[0-9]{3}-[0-9]{2}-[0-9]{4}"
_DATE = r"(?:[0-9]{4}-[0-9]{2}-[0-9]{2}|[0-9]{1,2}/[0-9]{1,2}/[0-9]{4}|[0-9]{1,2}\.[0-9]{1,2}\.[0-9]{4})"
_IPV4 = r"[0-9]{1,3}(?:\.[0-9]{1,3}){3}"
#: Digits behind the country code, where all numbers of the plan have as many.
PHONE_DIGITS = {"1": 10, "7": 10, "30": 10, "31": 9, "33": 9, "34": 9, "41": 9, "44": 10, "45": 8, "47": 8, "48": 9, "52": 10, "61": 9, "90": 10, "91": 10, "351": 9, "420": 9}
_PLANNED = "|".join(rf"{c}[ .-]?\(?[0-9](?:(?:\)[ .-]?|[ .-]\(?(?=[0-9]{{2}}))?[0-9]){{{n - 1}}}" for c, n in PHONE_DIGITS.items())
_DASHED = r"[0-9]{1,3}[ .-]?(?:\([0-9]{2,4}\)|[0-9]{2,4})[ .-]?[0-9]{2,4}(?:[.-][0-9]{2,4})?[.-][0-9]{3,4}"
_PHONE = (
    rf"(?:\+(?:{_PLANNED})(?![A-Za-z0-9]|[.-][0-9])|\+(?:{_DASHED})(?![A-Za-z0-9]|[.-][0-9])"
    r"|\+[0-9]{1,3}[ .-]?(?:\([0-9]{2,4}\)|[0-9]{2,4})(?:[ .-]?[0-9]{2,4}){2,3}|\([0-9]{3}\) ?[0-9]{3}[ .-][0-9]{4}|[0-9]{3}[.-][0-9]{3}[.-][0-9]{4})"
)
#: Country codes of one and two digits; all others have three (E.164).
_COUNTRY_CODE = r"^\+(?:[17]|2[07]|3[0-469]|4[013-9]|5[1-8]|6[0-6]|8[1246]|9[0-58]|[0-9]{3}|[0-9]{1,2}(?=[ .(-]))"
_EMAIL = r"[A-Za-z0-9._%+-]{1,64}@[A-Za-z0-9-]{1,63}(?:\.[A-Za-z0-9-]{1,63})*\.[A-Za-z]{2,24}"
_SECRET = r"(?i:token|secret|password|passwd|api[_-]?key) ?[=:] ?[\"'][A-Za-z0-9_+/.=-]{8,256}[\"']"
_NAMED = f"(?=[tTsSpPaA]){_SECRET}|(?<![A-Za-z0-9._%+-]){_EMAIL}"
#: Patterns over a text, one after the other over what the ones before leave.  A
#: value doesn't touch letters or digits, and a dotted one not another dotted
#: number.
IBAN_PATTERNS = [f"{_NAMED}|(?<![A-Za-z0-9])(?:{iban})(?![A-Za-z0-9])" for iban in (_COUNTRY_IBAN, _IBAN)]
PATTERN = (
    rf"{_NAMED}|(?=[0-9+(])(?<![A-Za-z0-9]|[0-9][.-])(?:{_IPV4}|{_DATE}|{_SSN}|{_CARD}|{_PHONE})(?![A-Za-z0-9]|[.-][0-9])"
    r"|(?=[0-9])(?<![A-Za-z0-9]|[0-9][.-])[0-9]{4}-[0-9]{2}-[0-9]{2}(?=[Tt][0-9]{2}(?::?[0-9]{2}|[Zz]|(?![A-Za-z0-9])))"
    rf"|(?=[0-9+(])(?<![A-Za-z0-9+])(?:{_PHONE})(?![A-Za-z0-9])"
)
_FIRST_DAY = "1800-01-01"


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, wherever body repeats it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _round_key(key: Column, kind: str, number: Column, half: Column) -> Column:
    return F.sha2(F.concat_ws("|", key, F.lit(kind), number.cast("string"), half).cast("binary"), 512)


def _number(hexadecimal: Column) -> Column:
    return F.conv(hexadecimal, 16, 10).cast("long")


def _shifted(text: Column, stream: Column) -> Column:
    """``text`` with every digit and every letter moved on within its class by
    the key stream (two hexadecimal digits each)."""

    def moved(keys: Column, i: Column) -> Column:
        code = F.ascii(F.substring(text, i, F.lit(1)))
        by = _number(F.substring(keys, F.pmod(i - 1, F.lit(64)) * 2 + 1, F.lit(2))).cast("int")
        return F.char(
            F.when(code.between(48, 57), F.pmod(code - 48 + by, F.lit(10)) + 48)
            .when(code.between(97, 122), F.pmod(code - 97 + by, F.lit(26)) + 97)
            .when(code.between(65, 90), F.pmod(code - 65 + by, F.lit(26)) + 65)
            .otherwise(code)
        )

    return _let(stream, lambda keys: F.array_join(F.transform(_positions(text), lambda i: moved(keys, i)), ""))


def _positions(text: Column) -> Column:
    """1 to the length of a text; an empty text has none."""
    return F.slice(F.sequence(F.lit(1), F.greatest(F.length(text), F.lit(1))), F.lit(1), F.length(text))


def permuted_text(text: Column, key: Column, kind: str) -> Column:
    """Feistel network over the halves of a text of ASCII characters: digits
    stay digits, letters letters of their case, other characters what they are."""

    def halves(t: Column) -> Column:
        half = F.floor(F.length(t) / 2).cast("int")
        return F.struct(F.substring(t, F.lit(1), half).alias("l"), F.substring(t, half + 1, F.length(t)).alias("r"))

    def step(s: Column, i: Column) -> Column:
        left = F.when(i % 2 == 0, _shifted(s["l"], _round_key(key, kind, i, s["r"]))).otherwise(s["l"])
        right = F.when(i % 2 == 1, _shifted(s["r"], _round_key(key, kind, i, s["l"]))).otherwise(s["r"])
        return F.struct(left.alias("l"), right.alias("r"))

    rounds = F.sequence(F.lit(0), F.lit(ROUNDS - 1))
    return F.aggregate(rounds, _let(text, halves), step, lambda s: F.concat(s["l"], s["r"]))


def permuted_number(n: Column, a: int, b: int, key: Column, kind: str) -> Column:
    """Feistel network on 0 .. a * b - 1, as pairs of a number below a and one
    below b."""

    def halves(m: Column) -> Column:
        return F.struct(F.floor(m / b).cast("long").alias("l"), F.pmod(m, F.lit(b)).cast("long").alias("r"))

    def step(s: Column, i: Column) -> Column:
        def mask(half: Column) -> Column:
            return _number(F.substring(_round_key(key, kind, i, half.cast("string")), 1, 15))

        left = F.when(i % 2 == 0, F.pmod(s["l"] + mask(s["r"]), F.lit(a))).otherwise(s["l"])
        right = F.when(i % 2 == 1, F.pmod(s["r"] + mask(s["l"]), F.lit(b))).otherwise(s["r"])
        return F.struct(left.cast("long").alias("l"), right.cast("long").alias("r"))

    rounds = F.sequence(F.lit(0), F.lit(ROUNDS - 1))
    return F.aggregate(rounds, _let(n, halves), step, lambda s: s["l"] * b + s["r"])


def _digits(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


def _laid_out(text: Column, values: Column, changing: str) -> Column:
    """``text`` with its characters of class ``changing`` replaced, in order,
    by those of ``values``."""

    def at(fresh: Column, i: Column) -> Column:
        c = F.substring(text, i, F.lit(1))
        seen = F.length(F.regexp_replace(F.substring(text, F.lit(1), i), f"[^{changing}]", ""))
        return F.when(c.rlike(f"[{changing}]"), F.substring(fresh, seen, F.lit(1))).otherwise(c)

    return _let(values, lambda fresh: F.array_join(F.transform(_positions(text), lambda i: at(fresh, i)), ""))


def _luhn_sum(digits: Column, doubled_last: int) -> Column:
    """Luhn sum of a digit string; ``doubled_last`` 1: its last digit is doubled."""

    def add(total: Column, i: Column) -> Column:
        d = F.substring(digits, i, F.lit(1)).cast("int")
        twice = F.when(d > 4, d * 2 - 9).otherwise(d * 2)
        return total + F.when((F.length(digits) - i + doubled_last) % 2 == 1, twice).otherwise(d)

    return F.aggregate(_positions(digits), F.lit(0), add)


def _card(text: Column, key: Column) -> Column:
    def checked(body: Column) -> Column:
        return F.concat(body, F.pmod(10 - F.pmod(_luhn_sum(body, 1), F.lit(10)), F.lit(10)).cast("string"))

    def replaced(digits: Column) -> Column:
        body = permuted_text(F.substring(digits, F.lit(1), F.length(digits) - 1), key, "card")
        right = F.pmod(_luhn_sum(digits, 0), F.lit(10)) == 0
        return F.when(right, _laid_out(text, _let(body, checked), "0-9")).otherwise(text)

    return _let(_digits(text), replaced)


def _mod_97(text: Column) -> Column:
    """An account text read as digits (A is 10, Z is 35) modulo 97."""

    def rest_of(t: Column) -> Column:
        def add(rest: Column, i: Column) -> Column:
            code = F.ascii(F.substring(t, i, F.lit(1)))
            return F.when(code >= 65, F.pmod(rest * 100 + code - 55, F.lit(97))).otherwise(F.pmod(rest * 10 + code - 48, F.lit(97)))

        return F.aggregate(_positions(t), F.lit(0), add)

    return _let(text, rest_of)


def _iban(text: Column, key: Column) -> Column:
    """Null for what isn't an IBAN."""

    def replaced(plain: Column) -> Column:
        country, account = F.substring(plain, 1, 2), F.substring(plain, F.lit(5), F.length(plain))

        def checked(fresh: Column) -> Column:
            check = F.lpad((98 - _mod_97(F.concat(fresh, country, F.lit("00")))).cast("string"), 2, "0")
            return F.concat(country, check, fresh)

        right = _mod_97(F.concat(account, F.substring(plain, 1, 4))) == 1
        return F.when(right, _laid_out(text, _let(permuted_text(account, key, "iban"), checked), "A-Z0-9"))

    return _let(F.replace(text, F.lit(" "), F.lit("")), replaced)


def _ssn(text: Column, key: Column) -> Column:
    area, group, serial = (F.substring(text, at, n).cast("int") for at, n in ((1, 3), (5, 2), (8, 4)))
    right = (area > 0) & (area < 900) & (area != 666) & (group > 0) & (serial > 0)
    # 898 areas x (99 groups x 9,999 serials)
    n = (F.when(area > 666, area - 2).otherwise(area - 1).cast("long") * 99 + group - 1) * 9999 + serial - 1
    fresh = permuted_number(n, 898, 99 * 9999, key, "ssn")

    def written(m: Column) -> Column:
        first = F.floor(m / (99 * 9999)).cast("long") + 1
        first = F.when(first >= 666, first + 1).otherwise(first)
        second, third = F.floor(m / 9999).cast("long") % 99 + 1, m % 9999 + 1
        return F.concat_ws("-", F.lpad(first.cast("string"), 3, "0"), F.lpad(second.cast("string"), 2, "0"), F.lpad(third.cast("string"), 4, "0"))

    return F.when(right, _let(fresh, written)).otherwise(text)


def _date(text: Column, key: Column) -> Column:
    parts = F.split(text, "[-/.]")
    slashes = text.contains("/")
    iso = text.contains("-")
    year = F.when(iso, parts[0]).otherwise(parts[2])
    month = F.when(iso, parts[1]).when(slashes, parts[0]).otherwise(parts[1])
    day = F.when(iso, parts[2]).when(slashes, parts[1]).otherwise(parts[0])
    found = F.concat_ws("-", year, F.lpad(month, 2, "0"), F.lpad(day, 2, "0")).try_cast("date")
    n = F.datediff(found, F.lit(_FIRST_DAY).cast("date")).cast("long")
    fresh = permuted_number(n, 189, 773, key, "date")  # 189 x 773 = 146,097 days of 400 years

    def written(m: Column) -> Column:
        d = F.date_add(F.lit(_FIRST_DAY).cast("date"), m.cast("int"))

        def like(old: Column, new: Column) -> Column:  # no leading zero where the text has none
            return F.when((F.length(old) == 1), new.cast("string")).otherwise(F.lpad(new.cast("string"), 2, "0"))

        y, mm, dd = F.lpad(F.year(d).cast("string"), 4, "0"), like(month, F.month(d)), like(day, F.day(d))
        return F.when(iso, F.concat_ws("-", y, mm, dd)).when(slashes, F.concat_ws("/", mm, dd, y)).otherwise(F.concat_ws(".", dd, mm, y))

    right = found.isNotNull() & n.between(0, 189 * 773 - 1)
    return F.when(right, _let(fresh, written)).otherwise(text)


def _ipv4(text: Column, key: Column) -> Column:
    parts = F.transform(F.split(text, r"\."), lambda p: p.cast("long"))
    right = F.forall(F.split(text, r"\."), lambda p: (p.cast("int") <= 255) & (p == p.cast("int").cast("string")))
    n = F.aggregate(parts, F.lit(0).cast("long"), lambda s, p: s * 256 + p)
    fresh = permuted_number(n, 65536, 65536, key, "ipv4")

    def written(m: Column) -> Column:
        return F.concat_ws(".", *[F.floor(m / 256**k).cast("long") % 256 for k in (3, 2, 1, 0)])

    return F.when(right, _let(fresh, written)).otherwise(text)


def _phone(text: Column, key: Column) -> Column:
    prefix = F.regexp_extract(text, _COUNTRY_CODE, 0)
    rest = F.substring(text, F.length(prefix) + 1, F.length(text))
    return F.concat(prefix, _laid_out(rest, permuted_text(_digits(rest), key, "phone"), "0-9"))


def _email(text: Column, key: Column) -> Column:
    at = F.instr(text, "@")
    return F.concat(permuted_text(F.substring(text, F.lit(1), at - 1), key, "email"), F.substring(text, at, F.length(text)))


def _secret(text: Column, key: Column) -> Column:
    name = F.regexp_extract(text, "^[^\"']*[\"']", 0)
    value = F.substring(text, F.length(name) + 1, F.length(text) - F.length(name) - 1)
    return F.concat(name, permuted_text(value, key, "secret"), F.substring(text, F.length(text), F.lit(1)))


#: What a match is, in this order: the first pattern it matches as a whole.
KINDS: list[tuple[str, str, Callable[[Column, Column], Column]]] = [
    ("secret", _SECRET, _secret),
    ("email", _EMAIL, _email),
    ("iban", _IBAN, _iban),
    ("ipv4", _IPV4, _ipv4),
    ("date", _DATE, _date),
    ("ssn", _SSN, _ssn),
    ("card", _CARD, _card),
    ("phone", _PHONE, _phone),
]


def pseudonym(match: Column, key: Column, kinds: list[str]) -> Column:
    """The pseudonym of a match of a pattern with values of these kinds, or the
    match itself (of an IBAN null) where it doesn't hold what its form
    promises."""
    out = None
    for kind, pattern, permute in KINDS:
        if kind in kinds:
            whole = match.rlike(f"^(?:{pattern})$")
            out = F.when(whole, permute(match, key)) if out is None else out.when(whole, permute(match, key))
    return out.otherwise(match)


def _parts(text: Column, pattern: str, key: Column) -> Column:
    """``text`` taken apart at its secrets, mail names and right IBANs: structs
    of the text before each (wrong ones included) and its pseudonym."""
    between = F.split(text, pattern, -1)
    matches = F.regexp_extract_all(text, F.lit(pattern), 0)
    fresh = F.transform(matches, lambda m: F.struct(m.alias("m"), pseudonym(m, key, ["secret", "email", "iban"]).alias("fresh")))
    pieces = F.zip_with(between, fresh, lambda b, m: F.struct(b.alias("before"), m["m"].alias("m"), m["fresh"].alias("fresh")))
    none = F.array().cast("array<struct<before:string,fresh:string>>")

    def step(s: Column, p: Column) -> Column:
        before = F.concat(s["before"], p["before"])
        done = F.concat(s["done"], F.array(F.struct(before.alias("before"), p["fresh"].alias("fresh"))))
        right = p["fresh"].isNotNull()
        return F.struct(
            F.when(right, done).otherwise(s["done"]).alias("done"),
            F.when(right, F.lit("")).otherwise(F.concat(before, F.coalesce(p["m"], F.lit("")))).alias("before"),
        )

    def end(s: Column) -> Column:
        return F.concat(s["done"], F.array(F.struct(s["before"].alias("before"), F.lit("").alias("fresh"))))

    return F.aggregate(pieces, F.struct(none.alias("done"), F.lit("").alias("before")), step, end)


def pseudonymized(text: Column, key: Column) -> Column:
    """``text`` with all values replaced.  The text is taken apart at the
    matches and put together again around their pseudonyms."""

    def rest(t: Column) -> Column:
        between = F.split(t, PATTERN, -1)
        matches = F.regexp_extract_all(t, F.lit(PATTERN), 0)
        fresh = F.transform(matches, lambda m: pseudonym(m, key, [kind for kind, _, _ in KINDS if kind != "iban"]))
        return F.array_join(F.zip_with(between, fresh, lambda b, m: F.concat(b, F.coalesce(m, F.lit("")))), "")

    def without(pattern: str, then: Callable[[Column], Column]) -> Callable[[Column], Column]:
        return lambda t: F.array_join(F.transform(_parts(t, pattern, key), lambda p: F.concat(then(p["before"]), p["fresh"])), "")

    country, other = IBAN_PATTERNS
    ibans = without(country, without(other, rest))
    # every value has a digit, an at sign or an assigned string; an IBAN starts with two letters and two digits
    some = F.when(text.rlike("(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}[ A-Z0-9]"), ibans(text)).otherwise(rest(text))
    return F.when(text.rlike("[0-9@=:]"), some).otherwise(text)


def pseudonymize(docs: DataFrame, key: str) -> DataFrame:
    """The documents with pseudonyms in ``text``; all columns are kept (a
    column n_chars is brought up to date where the text has changed), rows stay
    in place.  Null and empty texts and texts without values are unchanged;
    equal rows give equal rows; an empty table gives an empty table.  Runs no
    Python."""
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    rows = docs.select(row.alias("row"), pseudonymized(F.col("text"), F.lit(key)).alias("fresh"))

    def column(name: str) -> Column:
        old = F.col(f"row.`{name}`")
        if name.lower() == "text":
            return F.col("fresh").alias(name)
        if name.lower() == "n_chars":
            kind = docs.schema[name].dataType
            return F.when(F.col("row.text").eqNullSafe(F.col("fresh")), old).otherwise(F.length("fresh").cast(kind)).alias(name)
        return old.alias(name)

    return rows.select(*map(column, docs.columns))


def pseudonym_report(docs: DataFrame, key: str) -> DataFrame:
    """doc_id, text with pseudonyms, changed (whether the text holds any)."""
    rows = docs.select("doc_id", F.col("text").alias("before"), pseudonymized(F.col("text"), F.lit(key)).alias("text"))
    return rows.select("doc_id", "text", (~F.col("before").eqNullSafe(F.col("text"))).alias("changed"))
