"""Personal data: patterns propose spans, checksums confirm them, nearby words adjust the score."""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_left
from collections.abc import Iterator

from pyspark.sql import DataFrame

from .io import null_ids, table, with_ids

#: Base kinds in output order, then the kinds that checksums and context add.
BASE = ("email", "ip", "card", "phone")
ADDED = ("iban", "short_card", "local_phone")
DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]+)+")
IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
DIGITS = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
IBAN = re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]){11,30}(?![A-Za-z0-9])")
LOCAL_PHONE = re.compile(r"(?<![\w+(])\(?[0-9]{2,4}\)?[\x20-][0-9]{3,4}[\x20-][0-9]{3,4}(?![\w])")
PRIOR = {"email": 0.9, "ip": 0.6, "card": 0.8, "phone": 0.7, "iban": 0.8, "short_card": 0.4, "local_phone": 0.4}
#: Added spans below this score are left out; base spans always stay.
THRESHOLD = 0.55
#: Words within CONTEXT characters of a span that raise or lower its score.
CONTEXT = 40
NEAR = {
    "email": ("mail", "contact", "write"), "ip": ("ip", "host", "server", "address"), "card": ("card", "visa", "mastercard", "credit"),
    "phone": ("phone", "tel", "call", "mobile", "fax"), "iban": ("iban", "bank", "account"), "short_card": ("card", "amex", "credit"),
    "local_phone": ("phone", "tel", "call", "mobile", "fax"),
}
AGAINST = ("version", "isbn", "invoice", "order", "tracking", "serial")
_WORD = re.compile(r"[a-z]+")


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        total += d if i % 2 == 0 else (d * 2 - 9 if d > 4 else d * 2)
    return total % 10 == 0


def mod97(iban: str) -> bool:
    moved = iban[4:] + iban[:4]
    return int("".join(str(int(c, 36)) for c in moved)) % 97 == 1


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost matches: the longest local part before each @ that is still free, with a domain after it."""
    free, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > free and (c := text[start - 1]) < "\x7f" and (c.isalnum() or c in "._%+-"):
            start -= 1
        if start < at and (m := DOMAIN.match(text, at + 1)):
            yield start, m.end()
            free = m.end()
            at = text.find("@", free)
        else:
            at = text.find("@", at + 1)


def _apart(added: list, found: list) -> list:
    """The added spans that overlap no found one: of the found ones, joined where they meet, the last that starts before a span's end decides."""
    starts, ends = [], []
    for a, b in sorted((a, b) for _, a, b, _ in found):
        if ends and a <= ends[-1]:
            ends[-1] = max(ends[-1], b)
        else:
            starts.append(a)
            ends.append(b)

    def free(span) -> bool:
        k = bisect_left(starts, span[2])
        return not k or ends[k - 1] <= span[1]

    return [x for x in added if free(x)]


def find_spans(text: str | None) -> list[tuple[str, int, int, float, bool]]:
    """(kind, start, end, score, checksum passed) in code points, by kind and start. Null text has none."""
    if not text:
        return []
    found: list[tuple[str, int, int, bool]] = []
    if "@" in text:
        found += [("email", a, b, False) for a, b in _emails(text)]
    if "." in text:
        found += [("ip", m.start(), m.end(), False) for m in IP.finditer(text) if all(len(p.lstrip("0")) < 4 and int(p[-4:]) <= 255 for p in m[0].split("."))]
    short = []
    for m in DIGITS.finditer(text):
        if m.end() - m.start() >= 13:
            digits = m[0].replace(" ", "").replace("-", "")
            if 13 <= len(digits) <= 19 and luhn(digits):
                (found if len(digits) >= 16 else short).append(("card" if len(digits) >= 16 else "short_card", m.start(), m.end(), True))
    if "+" in text:
        found += [("phone", m.start(), m.end(), False) for m in PHONE.finditer(text) if 8 <= sum("0" <= c <= "9" for c in m[0]) <= 15]
    added = [("iban", m.start(), m.end(), True) for m in IBAN.finditer(text) if len(c := m[0].replace(" ", "")) <= 34 and mod97(c)]
    added += short
    if "-" in text or " " in text:
        added += [("local_phone", m.start(), m.end(), False) for m in LOCAL_PHONE.finditer(text)]
    out = []
    for kind, a, b, ok in found + _apart(added, found):
        words = set(_WORD.findall(text[max(0, a - CONTEXT) : b + CONTEXT].lower()))
        score = PRIOR[kind] + 0.2 * bool(words.intersection(NEAR[kind])) - 0.2 * bool(words.intersection(AGAINST)) + 0.1 * ok
        if kind in BASE or score >= THRESHOLD:
            out.append((kind, a, b, round(min(1.0, max(0.0, score)), 2), ok))
    rank = {k: i for i, k in enumerate((*BASE, *ADDED))}
    return sorted(out, key=lambda x: (rank[x[0]], x[1]))


def redacted(text: str, spans: list) -> str:
    """The text with every span replaced by its kind in brackets; of overlapping spans the first stays."""
    parts, at = [], 0
    for kind, a, b, *_ in sorted(spans, key=lambda x: (x[1], -x[2])):
        if a >= at:
            parts += [text[at:a], f"[{kind}]"]
            at = b
    return "".join([*parts, text[at:]])


SPANS = "array<struct<kind:string,start:int,end:int,score:double,checksum:boolean>>"


def detect(docs: DataFrame, text: str = "text") -> DataFrame:
    """doc_id, spans (found) and redacted text of every row. Null text has no spans and stays null; rows are handled one by one, so
    repeated ones give equal rows; an empty table gives none; other columns are left out."""

    def rows(batches):
        import pandas as pd

        for batch in batches:
            spans = [find_spans(t) for t in batch["t"]]
            yield pd.DataFrame({"doc_id": batch["doc_id"], "found": [[dict(zip(("kind", "start", "end", "score", "checksum"), s)) for s in x] for x in spans],
                                "redacted": [None if t is None else redacted(t, x) for t, x in zip(batch["t"], spans)]})

    return null_ids(with_ids(docs, "doc_id", docs[text].alias("t")).mapInPandas(rows, f"doc_id long, found {SPANS}, redacted string"), "doc_id")


def digests(docs: DataFrame) -> DataFrame:
    """One row per document: counts of the base kinds, digest of the base spans, all spans."""

    def rows(batches):
        import pandas as pd

        for batch in batches:
            out = []
            for t in batch["text"]:
                spans = find_spans(t)
                base = ",".join(f"{k}:{a}:{b}" for k, a, b, *_ in spans if k in BASE)
                counts = [sum(s[0] == k for s in spans) for k in BASE]
                out.append((*counts, hashlib.sha256(base.encode()).hexdigest(), ",".join(f"{k}:{a}:{b}" for k, a, b, *_ in spans)))
            frame = pd.DataFrame(out, columns=["n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans"])
            frame.insert(0, "doc_id", batch["doc_id"].values)
            yield frame

    schema = "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string"
    return null_ids(with_ids(docs, "doc_id", "text").mapInPandas(rows, schema), "doc_id")


def query(spark, sf_dir):
    return digests(table(spark, sf_dir, "documents"))
