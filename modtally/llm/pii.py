"""Personal data: patterns propose spans, checksums confirm them, nearby words adjust the score.

Base kinds, leftmost and non-overlapping within a kind: ``email``, ``ip`` (parts at most 255),
``card`` (16 to 19 digits passing Luhn), ``phone`` (8 to 15 digits). A match that fails its
check is dropped and not tried again at another place. Added kinds: ``iban`` (mod-97; cut at the length
of its country, elsewhere shorter ends are tried at group ends, longest first), ``ssn`` (areas and groups that are
given out) and ``aba`` (routing numbers of nine digits with their checksum, near a word that
supports them); an added span must reach ``threshold`` and not overlap a base span. Base spans are
never removed; their score tells how sure they are.

Offsets are code points, the end is exclusive. Null texts count as empty and have no spans. Repeated
rows are searched each; an empty table gives no rows.
"""

from __future__ import annotations

import bisect
import hashlib
import itertools
import re

import pyarrow as pa
from pyspark.sql import DataFrame

from .frames import id_and_text, over_rows, over_texts

BASE = ("email", "ip", "card", "phone")
ADDED = ("iban", "ssn", "aba")
KINDS = BASE + ADDED

# The patterns of the base kinds.
EMAIL_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
EMAIL_LOCAL = re.compile(r"[A-Za-z0-9._%+-]*\Z")
# A start inside a run of digits fails or succeeds as the run's start does, so only that one is tried.
IP = re.compile(r"(?<![0-9])[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
IBAN = re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]){11,30}")
SSN = re.compile(r"(?<![0-9-])(?!000|666|9)[0-9]{3}-(?!00)[0-9]{2}-(?!0000)[0-9]{4}(?![0-9-])")
ABA = re.compile(r"(?<![0-9A-Za-z-])(?:0[0-9]|1[0-2]|2[1-9]|3[0-2]|6[1-9]|7[0-2]|80)[0-9]{7}(?![0-9A-Za-z-])")
# Length of an IBAN by country.
IBAN_LENGTH = {
    "AD": 24, "AE": 23, "AL": 28, "AT": 20, "AZ": 28, "BA": 20, "BE": 16, "BG": 22, "BH": 22, "BR": 29, "CH": 21, "CR": 22, "CY": 28, "CZ": 24,
    "DE": 22, "DK": 18, "DO": 28, "EE": 20, "EG": 29, "ES": 24, "FI": 18, "FO": 18, "FR": 27, "GB": 22, "GE": 22, "GI": 23, "GL": 18, "GR": 27,
    "GT": 28, "HR": 21, "HU": 28, "IE": 22, "IL": 23, "IQ": 23, "IS": 26, "IT": 27, "JO": 30, "KW": 30, "KZ": 20, "LB": 28, "LI": 21, "LT": 20,
    "LU": 20, "LV": 21, "MC": 27, "MD": 24, "ME": 22, "MK": 19, "MR": 27, "MT": 31, "MU": 30, "NL": 18, "NO": 15, "PK": 24, "PL": 28, "PS": 29,
    "PT": 25, "QA": 29, "RO": 24, "RS": 22, "SA": 24, "SE": 24, "SI": 19, "SK": 24, "SM": 27, "TN": 24, "TR": 26, "UA": 29, "VA": 22, "XK": 20,
}

# Score before context: what the pattern and its checksum alone are worth.
PRIOR = {"email": 0.9, "ip": 0.6, "card": 0.8, "phone": 0.6, "iban": 0.8, "ssn": 0.4, "aba": 0.3}
# Words within CONTEXT code points of a span that make its kind likelier or less likely.
CONTEXT = 40
SUPPORT = {
    "email": ("mail", "contact", "write", "@"),
    "ip": ("ip", "address", "server", "host", "login"),
    "card": ("card", "visa", "mastercard", "amex", "credit", "debit", "payment", "cvv"),
    "phone": ("phone", "tel", "call", "mobile", "fax", "cell"),
    "iban": ("iban", "bank", "account", "transfer", "konto", "cuenta", "compte"),
    "ssn": ("ssn", "social", "security", "tax"),
    "aba": ("aba", "routing", "bank", "rtn"),
}
AGAINST = ("version", "build", "order", "invoice", "isbn", "part", "serial", "sku")
UP, DOWN = 0.2, 0.3
WORDS = re.compile(r"[A-Za-z@]+")


def luhn(digits: str) -> bool:
    total = 0
    for at, d in enumerate(reversed(digits)):
        v = int(d) * (1 + at % 2)
        total += v - 9 * (v > 9)
    return total % 10 == 0


def mod97(iban: str) -> bool:
    plain = iban.replace(" ", "")
    if not 15 <= len(plain) <= 34:
        return False
    turned = plain[4:] + plain[:4]
    return int("".join(str(int(c, 36)) for c in turned)) % 97 == 1


def routing(digits: str) -> bool:
    return sum(int(d) * w for d, w in zip(digits, (3, 7, 1) * 3, strict=True)) % 10 == 0


def ibans(text: str) -> list[tuple[int, int]]:
    """Valid account numbers. A match runs into upper-case words after it, so it is cut where its country says, else at shorter ends."""
    found, at = [], 0
    while match := IBAN.search(text, at):
        start, end = match.span()
        plain = [i for i in range(start, end) if text[i] != " "]
        length = IBAN_LENGTH.get(text[start : start + 2])
        # Without a known length: the ends of groups, longest first.
        sizes = [length] if length else [n for n in range(len(plain), 14, -1) if n == len(plain) or plain[n] > plain[n - 1] + 1]
        good = None
        for n in sizes:
            if n <= len(plain):
                stop = plain[n - 1] + 1
                if not text[stop : stop + 1].isalnum() and mod97(text[start:stop]):
                    good = stop
                    break
        if good:
            found.append((start, good))
        at = good or start + 2
    return found


def emails(text: str) -> list[tuple[int, int]]:
    """The matches of ``local@label(.label)+``, found from each ``@``: no part before it can hold another."""
    found, free, at = [], 0, text.find("@")
    while at >= 0:
        domain = EMAIL_DOMAIN.match(text, at)
        if domain:
            # A local part is cut out in steps, so that a long text is not searched from its start.
            start, step = at, 64
            while start > free:
                low = max(free, start - step)
                start = low + EMAIL_LOCAL.search(text[low:start]).start()
                if start > low:
                    break
            if start < at:
                found.append((start, domain.end()))
                free = domain.end()
        at = text.find("@", max(at + 1, free))
    return found


def digits_of(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def base_spans(text: str) -> dict[str, list[tuple[int, int]]]:
    ips = [m.span() for m in IP.finditer(text) if all(len(p) <= 3 and int(p or 0) <= 255 for p in (q.lstrip("0") for q in m.group().split(".")))]
    cards = [m.span() for m in CARD.finditer(text) if m.end() - m.start() >= 16 and 16 <= len(d := digits_of(m.group())) <= 19 and luhn(d)]
    phones = [m.span() for m in PHONE.finditer(text) if 8 <= len(digits_of(m.group())) <= 15] if "+" in text else []
    return {"email": emails(text) if "@" in text else [], "ip": ips, "card": cards, "phone": phones}


def score_of(text: str, kind: str, start: int, end: int) -> float:
    near = {w.lower() for w in WORDS.findall(text[max(0, start - CONTEXT) : start] + " " + text[end : end + CONTEXT])}
    score = PRIOR[kind] + UP * any(w in near for w in SUPPORT[kind]) - DOWN * any(w in near for w in AGAINST)
    return min(1.0, max(0.0, score))


def find_spans(text: str, threshold: float = 0.5) -> list[tuple[str, int, int, float]]:
    """All spans as ``kind, start, end, score``, by kind as listed, then by start."""
    base = base_spans(text)
    spans = [(k, s, e, score_of(text, k, s, e)) for k in BASE for s, e in base[k]]
    taken = sorted((s, e) for _, s, e, _ in spans)
    reach = list(itertools.accumulate((e for _, e in taken), max))

    def free(s: int, e: int) -> bool:
        before = bisect.bisect_left(taken, (e,))
        return not before or reach[before - 1] <= s

    proposed = [("iban", s) for s in ibans(text)]
    proposed += [("ssn", m.span()) for m in SSN.finditer(text)]
    proposed += [("aba", m.span()) for m in ABA.finditer(text) if routing(m.group())]
    for kind, (s, e) in proposed:
        if free(s, e) and (score := score_of(text, kind, s, e)) >= threshold:
            spans.append((kind, s, e, score))
    return sorted(spans, key=lambda x: (KINDS.index(x[0]), x[1]))


def masked(text: str, spans: list[tuple[str, int, int, float]], threshold: float = 0.0) -> str:
    """The text with every span replaced by its kind in brackets; overlapping spans become one."""
    out, at = [], 0
    for kind, s, e, score in sorted(spans, key=lambda x: (x[1], -x[2])):
        if score < threshold:
            continue
        if s >= at:
            out += [text[at:s], f"[{kind.upper()}]"]
        at = max(at, e)
    return "".join([*out, text[at:]])


def joined(spans) -> str:
    return ",".join(f"{k}:{s}:{e}" for k, s, e, *_ in spans)


SPANS = "array<struct<kind:string,start:int,end:int,score:double>>"


def detect(docs: DataFrame, threshold: float = 0.5, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: ``doc_id, found`` with kind, start, end and score of each span, and ``base_sha256``."""
    find, join, base = find_spans, joined, BASE

    def work(piece):
        texts = piece.column(piece.schema.get_field_index("text")).to_pylist()
        found = [find(t, threshold) for t in texts]
        kinds = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("score", pa.float64())]))
        return pa.RecordBatch.from_arrays(
            [
                piece.column(piece.schema.get_field_index("doc_id")),
                pa.array([[dict(zip(("kind", "start", "end", "score"), x, strict=True)) for x in f] for f in found], kinds),
                pa.array([hashlib.sha256(join(x for x in f if x[0] in base).encode()).hexdigest() for f in found], pa.string()),
            ],
            ["doc_id", "found", "base_sha256"],
        )

    return over_texts(id_and_text(docs, id_col, text_col), work, f"doc_id long, found {SPANS}, base_sha256 string")


def mask(docs: DataFrame, threshold: float = 0.5, text_col: str = "text") -> DataFrame:
    """``docs`` with the spans of ``text_col`` masked; null texts stay null, other columns stay as they are."""
    find, cover = find_spans, masked

    def work(piece):
        at = piece.schema.get_field_index(text_col)
        texts = [None if t is None else cover(t, find(t, threshold)) for t in piece.column(at).to_pylist()]
        return piece.set_column(at, piece.schema.field(at), pa.array(texts, piece.schema.field(at).type))

    return over_rows(docs, work, text_col)
