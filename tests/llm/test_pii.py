import hashlib
import itertools
from datetime import date, timedelta

from pyspark.sql import functions as F

from fleetplan.llm import pii as P
from tests.llm import fixtures as X

KEY = "test-key"


def keyed(kind, step, part):
    return int(hashlib.sha256(f"{KEY}|{kind}|{step}|{part}".encode()).hexdigest()[:15], 16)


def feistel(v, a, b, kind):
    left, right = v // b, v % b
    for k in range(1, P.ROUNDS + 1):
        if k % 2:
            left = (left + keyed(kind, k, right) % a) % a
        else:
            right = (right + keyed(kind, k, left) % b) % b
    return left * b + right


def shifted(text, kind):
    s = text
    for k in range(P.CHAR_PASSES * len(s)):
        i = k % len(s)
        x = keyed(kind, k, s[:i] + "\n" + s[i + 1 :])
        for first, size in ((48, 10), (97, 26), (65, 26)):
            if first <= ord(s[i]) < first + size:
                s = s[:i] + chr((ord(s[i]) - first + x) % size + first) + s[i + 1 :]
                break
    return s


def luhn(digits):
    return sum(sum(divmod(2 * int(d), 10)) if i % 2 else int(d) for i, d in enumerate(reversed(digits)))


def card(text):
    digits = "".join(filter(str.isdigit, text))
    n = len(digits) - 1
    body = f"{feistel(int(digits[:-1]), 10 ** (n - n // 2), 10 ** (n // 2), f'card{n + 1}'):0{n}d}"
    new = iter(body + str(-luhn(body + "0") % 10))
    return "".join(next(new) if c.isdigit() else c for c in text)


def phone(text):
    digits = "".join(filter(str.isdigit, text))
    d = digits[-10:]
    v = feistel(((int(d[:3]) - 200) * 800 + int(d[3:6]) - 200) * 10000 + int(d[6:]), 80000, 80000, "phone")
    new = iter(digits[:-10] + f"{v // 8000000 + 200}{v // 10000 % 800 + 200}{v % 10000:04d}")
    return "".join(next(new) if c.isdigit() else c for c in text)


def ip(text):
    a, b, c, d = map(int, text.split("."))
    v = feistel(((a * 256 + b) * 256 + c) * 256 + d, 65536, 65536, "ip")
    return ".".join(str(v >> s & 255) for s in (24, 16, 8, 0))


def ssn(text):
    a, g, s = map(int, text.split("-"))
    v = feistel(((a - (2 if a > 666 else 1)) * 99 + g - 1) * 9999 + s - 1, 898 * 99, 9999, "ssn")
    a = v // (99 * 9999)
    return f"{a + (2 if a >= 665 else 1):03d}-{v // 9999 % 99 + 1:02d}-{v % 9999 + 1:04d}"


def iso_date(text):
    first = date(1900, 1, 1)
    return str(first + timedelta(feistel((date.fromisoformat(text) - first).days, 17, 4297, "date")))


def email(text):
    name, domain = text.split("@")
    return f"{shifted(name, 'email' + domain.lower())}@{domain}"


CASES = {
    "card": (card, ["4111111111111111", "4111 1111 1111 1111", "3782 822463 10005", "5500-0000-0000-0004", "4222222222222"]),
    "phone": (phone, ["+1 (344) 555-8704", "(212) 555-0100", "800-555-0199", "1 617 555 0123"]),
    "ip": (ip, ["22.116.122.127", "8.8.8.8", "255.255.255.255"]),
    "ssn": (ssn, ["123-45-6789", "665-01-0001", "667-99-9999", "899-01-0001"]),
    "date": (iso_date, ["1987-03-12", "2000-02-29", "2099-12-31"]),
    "email": (email, ["fnoo.06@mail3.example.com", "A_b-C@x.org"]),
}


def masked(spark, texts):
    rows = P.masked_documents(X.documents(spark, texts), key=KEY).where("doc_id IS NOT NULL").dropDuplicates(["doc_id"]).collect()
    return {r.doc_id: r for r in rows}


def test_pseudonyms_match_a_plain_version(spark):
    cases = [(k, fn, v) for k, (fn, values) in CASES.items() for v in values]
    got = masked(spark, [f"see {v} here" for _, _, v in cases])
    for i, (kind, fn, value) in enumerate(cases):
        new = fn(value)
        assert got[i].text == f"see {new} here", (kind, value)
        assert new != value and got[i][f"n_{kind}"] == 1


def test_domains_are_permuted(spark):
    """Distinct values stay distinct and inside their format."""
    small = spark.range(7 * 7).select(P.feistel(F.col("id"), F.lit(7).cast("long"), F.lit(7).cast("long"), KEY, F.lit("t")).alias("v"))
    assert sorted(r.v for r in small.collect()) == list(range(49))
    days = [date(1990, 1, 1) + timedelta(i) for i in range(900)]
    by_format = {"iso": [str(d) for d in days], "dotted": [f"{d:%d.%m.%Y}" for d in days], "slashed": [f"{d:%m/%d/%Y}" for d in days], "late": [f"{d:%d/%m/%Y}" for d in days if d.day > 12]}
    values = list(itertools.chain(*by_format.values()))
    got = masked(spark, values)
    new = [got[i].text for i in range(len(values))]
    assert len(set(new)) == len(set(values)) and sum(got[i].n_date for i in got) == len(values)
    assert all(len(a) == len(b) and [c for c in a if not c.isdigit()] == [c for c in b if not c.isdigit()] for a, b in zip(values, new, strict=True))


def test_accounts_and_links(spark):
    iban = "DE89 3704 0044 0532 0130 00"
    got = masked(spark, [f"{iban} and {iban.replace(' ', '')}", f"pay {iban}, then a@b.org", "a@b.org 3/4/1987 03/04/1987", "GB82WEST12345698765432"])
    one, two = got[0].text.split(" and ")
    assert one.replace(" ", "") == two and got[1].text.startswith(f"pay {one},")
    for plain in (two, got[3].text):
        number = "".join(str(int(c, 36)) for c in plain[4:] + plain[:4])
        assert int(number) % 97 == 1
    mail, bare, padded = got[2].text.split(" ")
    assert got[1].text.endswith(mail) and [int(x) for x in bare.split("/")] == [int(x) for x in padded.split("/")]


def test_clean_and_awkward_texts_stay(spark):
    texts = ["", None, "plain words", "4111111111111112", "999.1.1.1 and 1.2.3.4.5", "30/02/1999 1850-01-01 666-12-1234", "DE00370400440532013000", "id0641917ea4e9feb9cda83477b57 v1.2", X.prose(20_000) + " 8" * 50_000]
    got = masked(spark, texts)
    assert [got[i].text for i in range(len(texts))] == texts
    assert P.masked_documents(X.empty(spark)).count() == 0
    docs = X.documents(spark, texts)
    out = P.pseudonymise(docs)
    assert out.columns == docs.columns and out.count() == docs.count()


def test_no_value_of_the_corpus_survives(spark):
    import re

    docs = spark.read.parquet(f"{X.SF_LARGER}/documents.parquet")
    before = {r.doc_id: r.text for r in docs.collect()}
    find = re.compile(r"[\w.]+@[\w.]+\.\w+|\+1 \(\d{3}\) \d{3}-\d{4}|\b(?:\d{1,3}\.){3}\d{1,3}\b")
    n = 0
    for r in P.masked_documents(docs).collect():
        values = set(find.findall(before[r.doc_id])) | {c for c in re.findall(r"\b\d{16}\b", before[r.doc_id]) if luhn(c) % 10 == 0}
        n += len(values)
        assert not [v for v in values if v.rstrip(".") in r.text]
    assert n > 50


def account(country, length):
    """A valid account of a country, with a made-up number."""
    body = "".join(str(i * 7 % 10) for i in range(length - 4))
    rest = int("".join(str(int(c, 36)) for c in f"{body}{country}00")) % 97
    return f"{country}{98 - rest:02d}{body}"


def test_accounts_before_other_words(spark):
    """Of every length, spaced or not, before a word or number in capitals."""
    plain = [account(codes.split()[0], n) for n, codes in P.IBAN_LENGTHS.items()] + ["BE68539007547034", "ES9121000418450200051332", "AT611904300234573201"]
    values = plain + [" ".join(v[i : i + 4] for i in range(0, len(v), 4)) for v in plain]
    tails = ["BIC GKCCBEBB", "NOW", "2024", "7", "A1", "and on"]
    cases = [(v, t) for v in values for t in tails]
    got = masked(spark, [f"pay {v} {t}" for v, t in cases])
    for i, (value, tail) in enumerate(cases):
        new = got[i].text
        assert got[i].n_iban == 1 and new.startswith("pay ") and new.endswith(f" {tail}") and value not in new, (value, tail, new)
        assert len(new) == len(f"pay {value} {tail}")
    by_value = {v: {got[i].text[4 : 4 + len(v)] for i, (w, _) in enumerate(cases) if w == v} for v in values}
    assert all(len(x) == 1 for x in by_value.values())


def test_phones_before_other_numbers(spark):
    """A phone is taken alone, and is the same wherever it stands."""
    phones = ["+44 20 7946 0958", "+442079460958", "+44 (0)20 7946 0958", "+49 30 12345678", "+33 1 23 45 67 89", "+45 12 34 56 78", "+351 212 345 678", "+86 138 1234 5678", "+81-3-1234-5678", "+7 (495) 123-45-67", "+39 06 1234 5678"]
    tails = ["here", "2024", "1200 and more", "7 days", "4111 1111 1111 1111", "10.5 kg", "(12)"]
    got = masked(spark, [f"call {p} {t}" for p in phones for t in tails])
    card_now = got[tails.index("4111 1111 1111 1111")].text[-19:]
    for i, (phone_, tail) in enumerate((p, t) for p in phones for t in tails):
        new, alone = got[i].text, got[i - i % len(tails)].text
        length = len(f"call {phone_}")
        assert got[i].n_foreign_phone == 1 and phone_ not in new and new[:length] == alone[:length], (phone_, tail, new)
        assert new[length + 1 :] == (card_now if "4111" in tail else tail), (phone_, tail, new)
    assert card_now != "4111 1111 1111 1111"


def test_national_phones_behind_brackets_and_dots(spark):
    texts = ["(212-555-0100)", "tel.212-555-0100", "((212) 555-0100)", "212-555-0100", "3.212-555-0100", "5(212-555-0100"]
    got = masked(spark, texts)
    new = phone("212-555-0100")
    assert [got[i].text for i in range(len(texts))] == [f"({new})", f"tel.{new}", f"({phone('(212) 555-0100')})", new, *texts[4:]]


def test_other_foreign_phones_stay_found(spark):
    """Codes without a plan, and numbers that are longer or shorter than theirs."""
    texts = ["+999 123 456 789", "+44 20 7946 09581", "+49 30 1234 5678901", "+33 1 2345 67", "+1 555 010 9999"]
    got = masked(spark, texts)
    for i, t in enumerate(texts):
        assert got[i].n_foreign_phone == 1 and len(got[i].text) == len(t) and got[i].text[-6:] != t[-6:]
