"""Personal data: patterns propose spans, checksums confirm them, words nearby move the score.

Four kinds always count when their own check passes: e-mail, IP address (parts at most 255), payment card
(13 to 19 digits, Luhn) and international phone number (9 to 15 digits). Two more are added when checksum or
context make them likely enough: bank account numbers (mod-97) and national phone numbers. One narrow pass per
text, linear in its length: candidates start at an ``@``, a ``+`` or the start of a run of digits.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

BASE_KINDS = ("email", "ip", "card", "phone")
KINDS = (*BASE_KINDS, "iban", "local_phone")
#: Score before context, and words that raise it when they stand within NEAR code points.
START_SCORE = {"email": 0.9, "ip": 0.6, "card": 0.8, "phone": 0.7, "iban": 0.8, "local_phone": 0.3}
CONTEXT = {
    "email": "email e-mail mail contact courriel correo",
    "ip": "ip address host server adresse serveur dirección servidor",
    "card": "card visa mastercard credit payment carte karte tarjeta",
    "phone": "phone tel call mobile fax téléphone telefon anruf teléfono",
    "iban": "iban account bank compte konto cuenta",
    "local_phone": "phone tel call mobile fax téléphone telefon anruf teléfono",
}
CONTEXT_GAIN, ADDED_LEAST, NEAR = 0.15, 0.4, 40
#: What brackets around the area code add to a national number; without them only context lifts it to ADDED_LEAST.
BRACKETS_GAIN = 0.1

#: Length of a country's account numbers; of other codes, any of the lengths allowed to all.
IBAN_LENGTHS = {k: n for n, codes in {
    15: "NO", 16: "BE", 18: "DK FI FO GL NL", 19: "MK SI", 20: "AT BA EE KZ LT LU XK", 21: "CH HR LI LV",
    22: "BG BH CR DE GB GE IE ME RS VA", 23: "AE GI IL IQ TL", 24: "AD CZ ES MD PK RO SA SE SK TN VG", 25: "PT ST",
    26: "IS TR", 27: "FR GR IT MC MR SM", 28: "AL AZ BY CY DO GT HU LB PL SV", 29: "BR EG PS QA UA", 30: "JO KW MU",
    31: "MT SC", 32: "LC"}.items() for k in codes.split()}
IBAN_LEAST, IBAN_MOST = 15, 34

_CONTEXT = {k: re.compile(r"(?<!\w)(?:" + "|".join(map(re.escape, v.split())) + r")(?!\w)", re.I) for k, v in CONTEXT.items()}
_DIGIT = re.compile("[0-9]")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_IBAN_START = re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?= ?[A-Z0-9])")
_IBAN_NEXT = re.compile(r" ?[A-Z0-9]")
_WORD_CHAR = re.compile("[A-Za-z0-9]")
_LOCAL_PHONE = re.compile(r"(?<![0-9+])(?:\([0-9]{3}\) ?|[0-9]{3}[ .-])[0-9]{3}[ .-][0-9]{4}(?![0-9])")


def luhn(digits: str) -> bool:
    total = sum(map(int, digits[-1::-2])) + sum(sum(divmod(2 * int(d), 10)) for d in digits[-2::-2])
    return total % 10 == 0


def mod_97(account: str) -> bool:
    """Whether a bank account number without spaces has the remainder 1."""
    moved = account[4:] + account[:4]
    return int("".join(str(int(c, 36)) for c in moved)) % 97 == 1


def emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost non-overlapping e-mails: the run of local characters before an @, then a domain with a dot."""
    end = 0
    at = text.find("@")
    while at >= 0:
        start = at
        while start > end and text[start - 1] in _LOCAL:
            start -= 1
        if start < at and (m := _DOMAIN.match(text, at + 1)):
            end = m.end()
            yield start, end
        at = text.find("@", max(end, at + 1))


def _digits(text: str) -> str:
    return "".join(_DIGIT.findall(text))


def base_spans(text: str) -> Iterator[tuple[str, int, int]]:
    for start, end in emails(text):
        yield "email", start, end
    if not _DIGIT.search(text):
        return
    for m in _IP.finditer(text):
        if all(len(p) <= 3 and int(p or 0) <= 255 for p in (x.lstrip("0") for x in m.group().split("."))):
            yield "ip", *m.span()
    for m in _CARD.finditer(text):
        if m.end() - m.start() <= 37 and 13 <= len(d := _digits(m.group())) <= 19 and luhn(d):
            yield "card", *m.span()
    for m in _PHONE.finditer(text):
        if 9 <= len(_digits(m.group())) <= 15:
            yield "phone", *m.span()


def ibans(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost non-overlapping account numbers, ending where no letter or digit follows, confirmed by mod-97.

    A number has its country's length; for an unknown country code the longest end that passes counts.
    """
    m = _IBAN_START.search(text)
    while m:
        start, end = m.start(), m.end()
        ends, size = [], 4
        fixed = IBAN_LENGTHS.get(text[start:start + 2])
        while size < (fixed or IBAN_MOST) and (n := _IBAN_NEXT.match(text, end)):
            end, size = n.end(), size + 1
            if size >= (fixed or IBAN_LEAST) and not _WORD_CHAR.match(text, end):
                ends.append(end)
        end = next((e for e in reversed(ends) if mod_97(text[start:e].replace(" ", ""))), None)
        if end:
            yield start, end
        m = _IBAN_START.search(text, end or start + 1)


def free_of(taken: list[tuple[str, int, int]]):
    """A test whether a span touches none of ``taken`` (which are sorted and merged once)."""
    starts, ends = [], []
    for _, start, end in sorted(taken, key=lambda x: x[1:]):
        if ends and start <= ends[-1]:
            ends[-1] = max(ends[-1], end)
        else:
            starts.append(start)
            ends.append(end)

    def free(start: int, end: int) -> bool:
        k = bisect_left(starts, end)  # the last merged span that begins before the end
        return k == 0 or ends[k - 1] <= start
    return free


def added_spans(text: str, taken: list[tuple[str, int, int]]) -> Iterator[tuple[str, int, int]]:
    """Candidates of the two further kinds that do not touch a base span."""
    if not _DIGIT.search(text):
        return
    free = free_of(taken)
    for kind, places in (("iban", ibans(text)), ("local_phone", (m.span() for m in _LOCAL_PHONE.finditer(text)))):
        yield from ((kind, start, end) for start, end in places if free(start, end))


def find_personal_data(text: str | None) -> list[dict]:
    """Spans by kind, then start: kind, start, end (code points), score."""
    if not text:
        return []
    base = list(base_spans(text))
    spans = []
    for kind, start, end in [*base, *added_spans(text, base)]:
        near = _CONTEXT[kind].search(text, max(0, start - NEAR), start) or _CONTEXT[kind].search(text, end, end + NEAR)
        score = START_SCORE[kind] + (CONTEXT_GAIN if near else 0.0) + (BRACKETS_GAIN if kind == "local_phone" and text[start] == "(" else 0.0)
        score = round(score, 2)
        if kind in BASE_KINDS or score >= ADDED_LEAST:
            spans.append({"kind": kind, "start": start, "end": end, "score": min(1.0, score)})
    return spans


SPANS = T.ArrayType(T.StructType([T.StructField("kind", T.StringType()), T.StructField("start", T.LongType()),
                                  T.StructField("end", T.LongType()), T.StructField("score", T.DoubleType())]))


@F.arrow_udf(SPANS)
def _spans(texts: pa.Array) -> pa.Array:
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("score", pa.float64())]))
    return pa.array([find_personal_data(t.as_py()) for t in texts], kind)


def personal_data(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` with a column ``spans`` (array of kind, start, end, score), in the order of KINDS, then start.

    A null or empty text has no spans. Repeated rows get equal spans; other columns pass through. A column
    named ``spans`` in ``docs`` is replaced.
    """
    return docs.withColumn("spans", _spans(docs[text_col].cast("string")))


def spelled(spans: Column) -> Column:
    """``kind:start:end`` of every span, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def of_kind(spans: str, *kinds: str) -> Column:
    return F.filter(spans, lambda s: s["kind"].isin(*kinds))
