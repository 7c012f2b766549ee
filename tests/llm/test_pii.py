"""Anchor expansion against patterns run over the whole text."""

import re

from hypothesis import given, settings
from hypothesis import strategies as st

from meterline.llm import pii

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def valid(kind, text):
    digits = re.sub("[^0-9]", "", text)
    if kind == "ip":
        return all(int(x) <= 255 for x in text.split("."))
    if kind == "card":
        total = sum(int(c) if k % 2 == 0 else sum(divmod(2 * int(c), 10)) for k, c in enumerate(reversed(digits)))
        return 13 <= len(digits) <= 19 and total % 10 == 0
    return kind == "email" or 9 <= len(digits) <= 15


def brute(text):
    return [(k, *m.span()) for k, p in PATTERNS.items() for m in re.finditer(p, text) if valid(k, m[0])]


@settings(max_examples=1500, deadline=None)
@given(st.text(st.sampled_from("a1234567890..@@++-- ()é%_ \n"), max_size=60))
def test_base_kinds(text):
    assert [x for x in pii.find(text) if x[0] in pii.BASE] == brute(text)


@settings(max_examples=500, deadline=None)
@given(st.lists(st.sampled_from(["4111 1111 1111 1111", "10.0.0.255", "1.2.3.4.5.6", "a.b@c.d-e.f", "@", ".", "+44 (0)20 7946 0958", "999.1.1.1", "x", " ", "-", "5500005555555559"]), max_size=12))
def test_base_kinds_side_by_side(parts):
    text = "".join(parts)
    assert [x for x in pii.find(text) if x[0] in pii.BASE] == brute(text)


def test_further_kinds_and_mask():
    text = 'See https://a.b/c?d=1, IBAN: DE89370400440532013000; token = "24be64439e3e49cf46b2d7c9" ü me@x.org.'
    found = {k: text[s:e] for k, s, e in pii.find(text)}
    assert found == {"url": "https://a.b/c?d=1", "account": "DE89370400440532013000", "secret": "24be64439e3e49cf46b2d7c9", "email": "me@x.org"}
    assert pii.masked(text, pii.find(text)) == 'See <URL>, IBAN: <ACCOUNT>; token = "<SECRET>" ü <EMAIL>.'


def accounts(text):
    return [text[s:e] for k, s, e in pii.find(text) if k == "account"]


def test_accounts_are_validated():
    whole = "DE89370400440532013000"
    assert accounts("iban DE89 3704 0044 0532 0130 00, next") == ["DE89 3704 0044 0532 0130 00"]
    assert accounts(f"IBAN number: {whole}.") == accounts(f"iBaN={whole}") == [whole]
    assert accounts("Account GB29 NWBK 6016 1331 9268 19 closed") == ["GB29 NWBK 6016 1331 9268 19"]
    assert accounts("account number 12-345678-9, acct #AB0012345, ACCT. 998877") == ["12-345678-9", "AB0012345", "998877"]
    assert accounts("SSN: 536-22-1234; ssn 536221234") == ["536-22-1234", "536221234"]
    assert accounts("passport no. C01X00T47, Passport No. AB1234567") == ["AB1234567"]


def test_false_cues():
    wrong = ["Taliban 2001-2021", "iban DE00000000000000", "iban DE89370400440532013001", f"account DE8937040044053201300{1}",
             "iban ZZ89370400440532013000", "iban", "IBAN DE89", "accounts 12345678", "discount account 2001-2021",
             "account 2021-03-04", "ssn 000-22-1234", "ssn 536-22-12345", "passport 12345", "iban DE89 3704 0044 0532 0130 00X"]
    assert [x for x in wrong if accounts(x)] == []


def test_places_stay_where_letters_grow():
    text = "\u0130" * 3 + " ACCOUNT 12345678 and ToKen = 24be64439e3e49cf46b2d7c9"
    assert [(k, text[s:e]) for k, s, e in pii.find(text)] == [("account", "12345678"), ("secret", "24be64439e3e49cf46b2d7c9")]


@settings(max_examples=300, deadline=None)
@given(st.integers(0, 10**18 - 1), st.booleans(), st.text(max_size=8))
def test_any_iban_with_its_check_digits(number, grouped, around):
    body = f"{number:018d}"
    iban = f"DE{98 - int(body + '131400') % 97:02d}{body}"
    shown = " ".join(iban[k : k + 4] for k in range(0, 22, 4)) if grouped else iban
    assert accounts(f"{around} iban {shown}.") == [shown]
    wrong = iban[:-1] + str((number + 1) % 10)
    assert accounts(f"{around} iban {wrong}.") == []


def test_rows(spark):
    schema = "doc_id long, text string, spans string, kind string"
    rows = [(1, None, "s", "k"), (2, "", "s", "k"), (3, "a@b.c" * 3000, "s", "k"), (None, "x +49 30 1234567", "s", "k"), (3, "a@b.c", "s", "k"), (3, "a@b.c", "s", "k")]
    docs = spark.createDataFrame(rows, schema)
    got = [(r.doc_id, [tuple(x) for x in r.spans]) for r in pii.pii_spans(docs).collect()]
    assert sorted(map(repr, got)) == sorted(repr((d, brute(t or ""))) for d, t, *_ in rows)
    assert pii.mask_pii(docs).columns == docs.columns and pii.mask_pii(docs).filter("text is null").count() == 1
    assert pii.pii_spans(docs.limit(0)).collect() == []
