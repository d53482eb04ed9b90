import datetime
import hashlib
import re

import pytest
from pyspark.sql import functions as F

from dimweave.llm import pseudonyms as P
from dimweave.llm.queries import QUERIES

from .conftest import SF

KEY = "k"


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        x = int(c) * (1 + i % 2)
        total += x - 9 if x > 9 else x
    return total % 10 == 0


def stream(kind, i, half):
    return hashlib.sha512(f"{KEY}|{kind}|{i}|{half}".encode()).hexdigest()


def feistel_text(text, kind):
    """The network, character by character."""
    half = len(text) // 2
    sides = [text[:half], text[half:]]
    for i in range(P.ROUNDS):
        keys, out = stream(kind, i, sides[1 - i % 2]), ""
        for k, c in enumerate(sides[i % 2]):
            by = int(keys[k % 64 * 2 : k % 64 * 2 + 2], 16)
            base, size = ("0", 10) if c.isdigit() else ("a", 26) if c.islower() else ("A", 26) if c.isupper() else (None, 1)
            out += c if base is None else chr(ord(base) + (ord(c) - ord(base) + by) % size)
        sides[i % 2] = out
    return "".join(sides)


def feistel_number(n, a, b, kind):
    sides, sizes = [n // b, n % b], [a, b]
    for i in range(P.ROUNDS):
        mask = int(stream(kind, i, sides[1 - i % 2])[:15], 16)
        sides[i % 2] = (sides[i % 2] + mask) % sizes[i % 2]
    return sides[0] * b + sides[1]


def check_digit(body):
    return next(str(d) for d in range(10) if luhn(body + str(d)))


def changed(spark, texts):
    rows = P.pseudonymize(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), KEY).collect()
    return [r.text for r in sorted(rows, key=lambda r: r.doc_id)]


def test_networks_equal_the_definition(spark):
    card, day = "4111111111111111", datetime.date(2024, 2, 29)
    body = feistel_text(card[:-1], "card")
    first = datetime.date(1800, 1, 1)
    moved = first + datetime.timedelta(feistel_number((day - first).days, 189, 773, "date"))
    ip = feistel_number(int.from_bytes(bytes([10, 0, 0, 1])), 65536, 65536, "ipv4")
    got = changed(spark, [f"card {card}.", f"on {day}", "from 10.0.0.1 on", "a.b+c@x.example.com", "+1 (017) 555-7713", 'token = "abCD1234"'])
    assert got[0] == f"card {body}{check_digit(body)}."
    assert got[1] == f"on {moved}"
    assert got[2] == f"from {'.'.join(map(str, ip.to_bytes(4)))} on"
    assert got[3] == f"{feistel_text('a.b+c', 'email')}@x.example.com"
    phone = feistel_text("0175557713", "phone")
    assert got[4] == f"+1 ({phone[:3]}) {phone[3:6]}-{phone[6:]}"
    assert got[5] == f'token = "{feistel_text("abCD1234", "secret")}"'


def test_networks_are_permutations(spark):
    rows = spark.range(189 * 773).select(P.permuted_number(F.col("id"), 189, 773, F.lit(KEY), "date").alias("n"))
    assert rows.distinct().count() == 189 * 773
    assert rows.agg(F.min("n"), F.max("n")).first() == (0, 189 * 773 - 1)
    texts = spark.range(10**4).select(P.permuted_text(F.lpad(F.col("id").cast("string"), 4, "0"), F.lit(KEY), "x").alias("t"))
    assert texts.distinct().count() == 10**4
    assert texts.filter("not t rlike '^[0-9]{4}$'").count() == 0


def test_values_stay_valid_and_linked(spark):
    texts = [
        "4111 1111 1111 1111 and 4111-1111-1111-1111 and 4111111111111111",
        "DE89 3704 0044 0532 0130 00 or GB29NWBK60161331926819",
        "123-45-6789",
        "1/2/1999 31.12.2020 2024-02-29",
        "1.2.3.4",
    ]
    got = changed(spark, texts)
    cards = re.findall(r"[0-9]{4}[ -]?[0-9]{4}[ -]?[0-9]{4}[ -]?[0-9]{4}", got[0])
    assert len({re.sub("[ -]", "", c) for c in cards}) == 1 and luhn(re.sub("[ -]", "", cards[0]))
    assert got[0] == changed(spark, texts)[0]
    for iban in re.findall(r"[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{1,4})+", got[1].replace(" or ", "|")):
        plain = iban.replace(" ", "")
        assert int("".join(str(int(c, 36)) for c in plain[4:] + plain[:4])) % 97 == 1
    area, group, serial = map(int, got[2].split("-"))
    assert 0 < area < 900 and area != 666 and group > 0 and serial > 0
    us, dotted, iso = got[3].split(" ")
    datetime.datetime.strptime(us, "%m/%d/%Y"), datetime.datetime.strptime(dotted, "%d.%m.%Y"), datetime.date.fromisoformat(iso)
    assert all(int(p) < 256 for p in got[4].split("."))
    assert all(a != b for a, b in zip(texts, got, strict=True))


def test_what_fails_validation_stays(spark):
    texts = [
        "4111111111111112",
        "2023-02-29 13/40/1999 2024-13-01 1799-12-31",
        "300.1.1.1 01.2.3.4 1.2.3.4.5",
        "000-12-3456 666-12-1234 900-12-1234",
        "GB29NWBK60161331926818",
        "version 3.0, 12 of 1999 and a=b: c@d",
        "",
        None,
    ]
    assert changed(spark, texts) == texts


def test_query_leaves_no_value_and_runs_no_python(spark, documents):
    df = QUERIES["op4_pseudonyms"](spark, SF)
    assert not re.search("Python|Pandas|Arrow", df._jdf.queryExecution().executedPlan().toString())
    before = {r.doc_id: r.text for r in documents.collect()}
    personal = re.compile(r"[\w.+-]+@[\w.-]+\.com|\+1 \(\d{3}\) \d{3}-\d{4}|(?<![\d.])\d{1,3}(?:\.\d{1,3}){3}(?![\d.])|(?<!\d)\d{16}(?!\d)")
    rows = df.collect()
    assert len(rows) == len(before)
    for r in rows:
        values = [v for v in personal.findall(before[r.doc_id] or "") if not v.isdigit() or luhn(v)]
        assert not [v for v in values if v in r.text]
        assert r.changed == (r.text != before[r.doc_id])
        if not re.search("[0-9@]", before[r.doc_id] or ""):
            assert not r.changed


def test_odd_tables(spark, odd, nothing, repeated):
    assert sorted(map(str, P.pseudonymize(odd, KEY).collect())) == sorted(map(str, odd.collect()))
    assert P.pseudonymize(nothing, KEY).columns == nothing.columns and P.pseudonymize(nothing, KEY).count() == 0
    assert P.pseudonymize(repeated, KEY).count() == repeated.count()
    df = spark.createDataFrame([("1.2.3.4", 7, 1), ("none", 99, 2)], "text string, n_chars long, fresh int")
    rows = P.pseudonymize(df, KEY).collect()
    assert rows[0].n_chars == len(rows[0].text) and rows[1].n_chars == 99 and rows[1].fresh == 2


@pytest.mark.parametrize("n", [1, 2, 3, 200])
def test_any_length(spark, n):
    text = "9" * n
    got = spark.range(1).select(P.permuted_text(F.lit(text), F.lit(KEY), "x").alias("t")).first().t
    assert got == feistel_text(text, "x")


def test_neighbours_hide_no_value(spark):
    def mod_97(plain):
        return int("".join(str(int(c, 36)) for c in plain[4:] + plain[:4])) % 97

    alone = ["BE68 5390 0754 7034", "NO93 8601 1117 947", "+1 (017) 555-7713", "+44 20 7946 0958", "+49 30 123-4567", "2024-03-05", "3782 822463 10005", "3782-822463-10005", "3056 930902 5904", "4111 1111 1111 1111"]
    own = dict(zip(alone, changed(spark, alone), strict=True))
    assert all(a != b and len(a) == len(b) for a, b in own.items())
    assert all(mod_97(own[a].replace(" ", "")) == 1 for a in alone[:2])
    assert all(luhn(re.sub("[ -]", "", own[a])) for a in alone[6:])
    assert own[alone[6]].replace(" ", "") == own[alone[7]].replace("-", "")
    around = [
        "{BE68 5390 0754 7034} PAID", "{BE68 5390 0754 7034} PAID BY CARD 42", "{NO93 8601 1117 947} ABC", "AB12 {BE68 5390 0754 7034} EUR",
        "call {+1 (017) 555-7713} 42 times", "{+1 (017) 555-7713} 12 34", "{+44 20 7946 0958} 42 times", "{+49 30 123-4567} 42",
        "at {2024-03-05}T10:00:00Z", "{2024-03-05}T10:00:00.123+02:00, {2024-03-05}t0900 and {2024-03-05}", "2024-03-05Test",
        "amex {3782 822463 10005}, {3782-822463-10005}", "AB12 {4111 1111 1111 1111}", "AB12 CDEF GHIJ {2024-03-05}",
    ]
    got = changed(spark, [re.sub("[{}]", "", t) for t in around])
    assert got == [re.sub(r"\{(.*?)\}", lambda m: own[m[1]], t) for t in around]
    # a secret or mail name behind what looks like an IBAN
    secret, mail = changed(spark, ['API_KEY="abCD1234"', "EFGH@x.com"])
    assert changed(spark, ['AB12 CDEF GHIJ API_KEY="abCD1234"', "AB12 ABCD EFGH@x.com"]) == [f"AB12 CDEF GHIJ {secret}", f"AB12 ABCD {mail}"]


def test_a_phone_number_has_one_pseudonym_in_all_spellings(spark):
    """With and without separators; the country code stays."""
    spellings = [
        ["+1 415 555 1234", "+14155551234", "+1 (415) 555-1234", "+1-415-555-1234", "(415) 555-1234", "415-555-1234"],
        ["+44 20 7946 0958", "+442079460958", "+44-20-7946-0958"],
        ["+351 912 345 678", "+351912345678"],
        ["+86 138 0013 8000", "+8613800138000"],
        ["+971 50 123 4567", "+971501234567"],
    ]
    for numbers in spellings:
        got = changed(spark, numbers)
        digits = {re.sub(r"\D", "", re.sub(r"^\+(1|44|351|86|971)", "", g)) for g in got}
        assert len(digits) == 1 and digits != {re.sub(r"\D", "", re.sub(r"^\+(1|44|351|86|971)", "", numbers[0]))}
        for before, after in zip(numbers, got, strict=True):
            assert re.sub(r"\d", "0", before) == re.sub(r"\d", "0", after)
            if before.startswith("+"):
                code = re.match(r"\+(1|44|351|86|971)", before).group()
                assert after.startswith(code)
