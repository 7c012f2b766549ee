"""Personal data by anchor expansion.

One pass of an Aho-Corasick automaton finds anchors: at-signs, plus signs, digits, schemes and words that announce an
identifier. From each anchor a local parser looks left and right for the bounds of an address, a number or an
account and validates it. Only characters next to an anchor are looked at again.

Spans of the kinds email, ip, card and phone are those that their patterns find from left to right without overlap;
url, account and secret come on top. Cues are read in any case. A cue of an account must not follow a letter, and what it
announces must have the form, length and check digits of its kind.
"""

from __future__ import annotations

import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import slices, worker_cache

# Patterns of the kinds, and the words and schemes that announce an identifier.
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
IP = re.compile(r"[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+")
IP_RUN = re.compile(r"[0-9.]+")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
CARD_RUN = re.compile(r"[0-9\x20-]+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
ADDRESS = re.compile(r"[^\s<>\"'`{}|\\^\[\]]+")
LEAD = re.compile(r"(?:\x20?(?:no|nr|number|id|code))?\.?\x20?[:=#]?\x20?", re.I)
IBAN = re.compile(r"[A-Za-z]{2}[0-9]{2}(?:[\x20-]?[0-9A-Za-z]){11,30}", re.A)
ACCOUNT = re.compile(r"[A-Z]{0,4}[0-9](?:-?[0-9A-Z]){4,32}(?![0-9A-Za-z])")
SSN = re.compile(r"(?!000|666|9)[0-9]{3}([\x20-]?)(?!00)[0-9]{2}\1(?!0000)[0-9]{4}(?![0-9A-Za-z])")
PASSPORT = re.compile(r"[A-Za-z]{0,2}[0-9]{6,9}(?![0-9A-Za-z])")
DATES = re.compile(r"(?:19|20)[0-9]{2}-(?:(?:19|20)[0-9]{2}|[01][0-9](?:-[0-3][0-9])?)")
SECRET = re.compile(r"[\"']?\x20{0,2}[:=]\x20{0,2}[\"']?([A-Za-z0-9_/+.-]{16,})")
IBAN_LENGTHS = {
    15: "NO", 16: "BE", 18: "DK FI FO GL NL", 19: "MK SI", 20: "AT BA EE KZ LT LU XK", 21: "CH HR LI LV",
    22: "BG BH CR DE GB GE IE ME RS VA", 23: "AE GI IL IQ TL", 24: "AD CZ ES MD PK RO SA SE SK TN VG", 25: "LY PT ST",
    26: "IS TR", 27: "FR GR IT MC MR SM", 28: "AL AZ BY CY DO GT HU LB PL SV", 29: "BR EG PS QA UA", 30: "JO KW MU",
    31: "MT SC", 32: "LC",
}
SCHEMES = ["http://", "https://", "ftp://", "www."]
ACCOUNT_CUES = ["iban", "account", "acct", "passport", "ssn"]
SECRET_CUES = ["token", "api_key", "apikey", "secret", "password", "passwd", "access_key"]
BASE = ["email", "ip", "card", "phone"]
KINDS = [*BASE, "url", "account", "secret"]
LENGTH_OF = {country: n for n, countries in IBAN_LENGTHS.items() for country in countries.split()}
#: ASCII letters only, for texts whose letters change their number when made small.
SMALL = {ord(x): ord(x) + 32 for x in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"}
SPANS = "array<struct<kind:string,start:bigint,`end`:bigint>>"


def automaton():
    cache = worker_cache()
    if "anchors" not in cache:
        import ahocorasick

        anchors = ahocorasick.Automaton()
        words = {"@": "at", "+": "plus", **dict.fromkeys("0123456789", "digit")}
        for kind, cues in (("scheme", SCHEMES), ("account", ACCOUNT_CUES), ("secret", SECRET_CUES)):
            words |= dict.fromkeys(cues, kind)
        for word, kind in words.items():
            anchors.add_word(word, (kind, len(word)))
        anchors.make_automaton()
        cache["anchors"] = anchors
    return cache["anchors"]


def luhn(digits: str) -> bool:
    doubled = [int(x) * 2 for x in digits[-2::-2]]
    return (sum(map(int, digits[-1::-2])) + sum(x - 9 * (x > 9) for x in doubled)) % 10 == 0


def is_ip(text: str) -> bool:
    return all(len(part := x.lstrip("0")) <= 3 and int(part or "0") <= 255 for x in text.split("."))


def is_card(text: str) -> bool:
    digits = text.replace(" ", "").replace("-", "")
    return 13 <= len(digits) <= 19 and luhn(digits)


def is_phone(text: str) -> bool:
    return 9 <= sum(x.isdigit() for x in text) <= 15


def small(text: str) -> str:
    """text in small letters, each character at its own place."""
    low = text.lower()
    return low if len(low) == len(text) else text.translate(SMALL)


def iban_end(text: str, at: int) -> int:
    """Where the account number of international form that starts at this place ends, else -1.

    It has the length of its country, grouped or not, and a remainder of 1 by 97.
    """
    m = IBAN.match(text, at)
    need = LENGTH_OF.get(text[at : at + 2].upper(), 0)
    if not m or not need:
        return -1
    end, held = at, []
    while end < m.end() and len(held) < need:
        if text[end].isalnum():
            held.append(text[end].upper())
        end += 1
    if len(held) < need or text[end : end + 1].isalnum():
        return -1
    number = "".join(str(int(x, 36)) for x in held[4:] + held[:4])
    return end if int(number) % 97 == 1 else -1


def account_span(text: str, cue: str, at: int) -> tuple[int, int] | None:
    """Bounds of a valid identifier announced by a cue that ends at this place.

    By cue: an international account number, a social security number, a passport number (6 to 9 digits), or any
    account number of 5 to 20 digits that is no date and no range of years.
    """
    at = LEAD.match(text, at).end()
    if cue == "ssn":
        m = SSN.match(text, at)
    elif cue == "passport":
        m = PASSPORT.match(text, at)
    else:
        end = iban_end(text, at)
        if end > 0 or cue == "iban":
            return (at, end) if end > 0 else None
        m = ACCOUNT.match(text, at)
        if m and (not 5 <= sum(x.isdigit() for x in m[0]) <= 20 or DATES.fullmatch(m[0])):
            m = None
        if m and m[0][:2] in LENGTH_OF and m[0][2:4].isdigit() and len(m[0]) == LENGTH_OF[m[0][:2]]:
            m = None
    return m and m.span()


def find(text: str) -> list[tuple[str, int, int]]:
    """Kind, start and end (in code points) of all spans, in the order of KINDS, then from left to right."""
    spans: dict[str, list[tuple[int, int]]] = {kind: [] for kind in KINDS}
    done = dict.fromkeys(KINDS, 0)

    def runs(kind: str, at: int, run: re.Pattern, pattern: re.Pattern, valid) -> None:
        if at >= done[kind]:
            done[kind] = run.match(text, at).end()
            spans[kind] += [m.span() for m in pattern.finditer(text, at, done[kind]) if valid(m[0])]

    for last, (kind, size) in automaton().iter(small(text)):
        at = last + 1 - size
        if kind == "digit":
            runs("ip", at, IP_RUN, IP, is_ip)
            runs("card", at, CARD_RUN, CARD, is_card)
        elif kind == "plus":
            if at >= done["phone"] and (m := PHONE.match(text, at)):
                done["phone"] = m.end()
                if is_phone(m[0]):
                    spans["phone"].append(m.span())
        elif kind == "at":
            start = at
            while start > done["email"] and text[start - 1] in LOCAL:
                start -= 1
            if start < at and (m := DOMAIN.match(text, at + 1)):
                spans["email"].append((start, m.end()))
                done["email"] = m.end()
        elif kind == "scheme":
            if at >= done["url"] and (m := ADDRESS.match(text, last + 1)):
                end = len(text[: m.end()].rstrip(".,;:!?)")) if text[m.end() - 1] in ".,;:!?)" else m.end()
                if end > last + 1:
                    spans["url"].append((at, end))
                    done["url"] = end
        elif kind == "account":
            if at >= done[kind] and not text[at - 1 : at].isalpha():
                if span := account_span(text, text[at : last + 1].lower(), last + 1):
                    spans[kind].append(span)
                    done[kind] = span[1]
        elif at >= done[kind] and (m := SECRET.match(text, last + 1)):
            spans[kind].append(m.span(1))
            done[kind] = m.end()
    return [(kind, *span) for kind in KINDS for span in spans[kind]]


def pii_spans(docs: DataFrame) -> DataFrame:
    """doc_id and spans (kind, start, end in code points, end exclusive) of every row of docs.

    A null or empty text has no spans. Repeated rows and null ids are searched each for itself; an empty table gives
    no rows; other columns are neither read nor returned.
    """

    def search(batches):
        for part in slices(batches):
            found = [[{"kind": k, "start": s, "end": e} for k, s, e in find(x)] for x in part.column("text").to_pylist()]
            kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))
            yield pa.RecordBatch.from_pydict({"doc_id": part.column("doc_id"), "spans": pa.array(found, kind)})

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    return rows.mapInArrow(search, f"doc_id long, spans {SPANS}")


def masked(text: str, spans: list[tuple[str, int, int]]) -> str:
    """text with each span, or several that overlap, replaced by the first one's kind in angle brackets."""
    out, at = [], 0
    for kind, start, end in sorted(spans, key=lambda x: (x[1], -x[2])):
        if start >= at:
            out += [text[at:start], f"<{kind.upper()}>"]
        at = max(at, end)
    return "".join([*out, text[at:]])


def mask_pii(docs: DataFrame) -> DataFrame:
    """docs with personal data in text replaced by its kind; a null text stays null, other columns stay as they are."""
    place = docs.columns.index("text")

    def replace(batches):
        for batch in batches:
            texts = batch.column(place)
            new = pa.array([x and masked(x, find(x)) for x in texts.to_pylist()], texts.type)
            yield batch.set_column(place, batch.schema.field(place), new)

    return docs.mapInArrow(replace, docs.schema)
