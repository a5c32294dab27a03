"""Personal data: regular expressions propose spans, checksums confirm them, words nearby adjust the score.

The proposals for e-mail addresses, IP addresses, card and phone numbers are leftmost and non-overlapping per kind;
a proposal that its validator (octets, Luhn, number of digits) rejects is dropped and not retried.  Account numbers
(IBAN) are confirmed by mod-97: the proposal is a run of upper-case words, of which the words up to the length of the
country's accounts, else the longest sequence that passes, are the span.  All scans are linear: candidates start only where a run of digits or of address
characters starts, so long runs are not scanned again from every position.

Defined results: a null or empty text has no spans; spans count code points, end exclusive, and are ordered by start
and then by kind (email, ip, card, phone, iban); kinds may overlap each other; repeated rows give repeated results; an
empty table gives an empty result; further columns of the input are ignored.
"""

from __future__ import annotations

import hashlib
import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_texts

KINDS = ("email", "ip", "card", "phone", "iban")
BASE = KINDS[:4]
PRIOR = {"email": 0.9, "ip": 0.6, "card": 0.8, "phone": 0.6, "iban": 0.9}
#: Words that make a kind likelier when they stand within WINDOW characters before it or after it.
CONTEXT = {
    "email": ("email", "e-mail", "mail", "contact", "write", "contacto", "kontakt", "courriel"),
    "ip": ("ip", "address", "host", "server", "login", "adresse"),
    "card": ("card", "credit", "visa", "mastercard", "payment", "karte", "carte", "tarjeta"),
    "phone": ("phone", "call", "tel", "mobile", "fax", "telefon", "téléphone", "teléfono"),
    "iban": ("iban", "account", "bank", "konto", "compte", "cuenta"),
}
WINDOW, BONUS = 50, 0.08
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)+")
IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
IBAN = re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]){11,30}(?![A-Za-z0-9])")
#: Characters of an account by country; of other countries the longest that passes is taken.
ACCOUNT = {
    "AD": 24, "AE": 23, "AT": 20, "BE": 16, "BG": 22, "CH": 21, "CY": 28, "CZ": 24, "DE": 22, "DK": 18, "EE": 20, "ES": 24, "FI": 18, "FR": 27, "GB": 22, "GR": 27, "HR": 21, "HU": 28,
    "IE": 22, "IS": 26, "IT": 27, "LI": 21, "LT": 20, "LU": 20, "LV": 21, "MC": 27, "MT": 31, "NL": 18, "NO": 15, "PL": 28, "PT": 25, "RO": 24, "SA": 24, "SE": 24, "SI": 19, "SK": 24, "SM": 27, "TR": 26,
}
DIGIT = re.compile(r"[0-9]")
CONTEXTS = {k: re.compile(r"(?<!\w)(?:" + "|".join(map(re.escape, sorted(v, key=len, reverse=True))) + r")(?!\w)", re.I) for k, v in CONTEXT.items()}


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        total += d if i % 2 == 0 else d * 2 - 9 * (d > 4)
    return total % 10 == 0


def mod97(account: str) -> bool:
    rest = account[4:] + account[:4]
    return int("".join(str(int(c, 36)) for c in rest)) % 97 == 1


def emails(text: str):
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in LOCAL:
            start -= 1
        if start < at and (m := DOMAIN.match(text, at + 1)):
            yield start, m.end()
            done = m.end()
        at = text.find("@", at + 1)


def number_spans(text: str):
    for m in IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m[0].split(".")):
            yield "ip", m.start(), m.end()
    for m in CARD.finditer(text):
        if m.end() - m.start() <= 37:
            digits = m[0].replace(" ", "").replace("-", "")
            if 12 <= len(digits) <= 19 and luhn(digits):
                yield "card", m.start(), m.end()
    if "+" in text:
        for m in PHONE.finditer(text):
            if 9 <= sum(c.isdigit() for c in m[0]) <= 15:
                yield "phone", m.start(), m.end()
    at = 0
    while m := IBAN.search(text, at):
        end = account_end(m[0])
        # the next account may start at any later word of the run
        at = m.start() + (end or 1)
        if end:
            yield "iban", m.start(), at


def account_end(run: str) -> int:
    """The end of the account with which a run of words starts: at a word's end; 0 if there is none."""
    ends = [i for i in range(len(run), 14, -1) if i == len(run) or run[i] == " "]
    held = [(i, n) for i in ends if 15 <= (n := i - run.count(" ", 0, i)) <= 34 and mod97(run[:i].replace(" ", ""))]
    return next((i for i, n in held if n == ACCOUNT.get(run[:2])), held[0][0] if held else 0)


def find_spans(text: str) -> list[tuple[str, int, int, float]]:
    """(kind, start, end, score) of every span, by start and then kind."""
    found = [("email", a, b) for a, b in emails(text)] if "@" in text else []
    if DIGIT.search(text):
        found += number_spans(text)
    found.sort(key=lambda s: (s[1], KINDS.index(s[0])))
    return [(k, a, b, score(text, k, a, b)) for k, a, b in found]


def score(text: str, kind: str, start: int, end: int) -> float:
    near = text[max(0, start - WINDOW) : start] + "\n" + text[end : end + WINDOW]
    return min(1.0, PRIOR[kind] + BONUS * len(set(m.lower() for m in CONTEXTS[kind].findall(near))))


def personal_data(docs: DataFrame) -> DataFrame:
    """doc_id and spans, an array of (kind, start, end, score), of every row of ``docs(doc_id, text)``."""

    def each(ids: list, texts: list[str]) -> dict[str, list]:
        return {"doc_id": ids, "spans": [[dict(zip(("kind", "start", "end", "score"), s)) for s in find_spans(t)] for t in texts]}

    return map_texts(docs, each, "doc_id long, spans array<struct<kind:string,start:long,end:long,score:double>>")


def pii_digest(found: DataFrame) -> DataFrame:
    joined = lambda spans: F.concat_ws(",", F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))))
    base = F.filter("spans", lambda s: s["kind"].isin(*BASE))

    def count(kind: str):
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return found.select(
        "doc_id", *map(count, BASE), F.sha2(joined(base).cast("binary"), 256).alias("base_sha256"), joined(F.col("spans")).alias("spans"),
        F.coalesce(F.array_max(F.transform("spans", lambda s: s["score"])), F.lit(0.0)).alias("score"),
    )
