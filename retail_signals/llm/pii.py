"""Personal data: patterns propose spans, checksums confirm, context scores.

Base kinds (email, ip, card, phone) are found as leftmost non-overlapping
matches and always reported when their own check holds. Further kinds (iban,
ssn, short card and local phone numbers) need a score of ``MIN_SCORE``: a start
value, more for a passed checksum (Luhn, mod 97), more or less for words
nearby. They are also found next to other digits, and never overlap a base span,
an iban or a span of their kind. All scans are linear in the text.

Defined results: null text counts as empty (no spans); copies and repeated ids
each give their row; an empty table gives no rows; ``redact`` keeps every input
column, whatever its name.
"""
from __future__ import annotations

import hashlib
import re
from bisect import bisect_left
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import DataFrame

from .common import map_rows, map_texts, slices

BASE_KINDS = ("email", "ip", "card", "phone")
KINDS = (*BASE_KINDS, "iban", "ssn", "card_short", "phone_local")
SCHEMA = ("n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string, "
          "n_added long")

MIN_SCORE = 0.6
#: Start value, gain for a passed checksum, words nearby that raise the score.
SCORES = {
    "iban": (0.4, 0.3, ("iban", "account", "konto", "compte", "cuenta", "bank")),
    "ssn": (0.4, 0.0, ("ssn", "social security", "tax id")),
    "card_short": (0.2, 0.3, ("card", "visa", "amex", "credit", "karte", "carte", "tarjeta")),
    "phone_local": (0.4, 0.0, ("phone", "tel", "call", "mobile", "fax", "handy", "teléfono")),
}
#: Words nearby that speak against personal data.
AGAINST = ("order", "invoice", "version", "isbn", "serial")
REACH = 40

_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_DOTTED = re.compile(r"[0-9]+(?:\.[0-9]+)*+")
_DIGITS = re.compile(r"[0-9](?:[\x20-]?[0-9])*+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_IBAN = re.compile(r"(?<![A-Za-z0-9])(?=([A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]){11,30}))")
_SSN = re.compile(r"(?<![0-9])(?<![0-9]-)[0-9]{3}-[0-9]{2}-[0-9]{4}(?!-?[0-9])")
_CARD_SHORT = re.compile(r"(?<![0-9])(?=((?:[0-9]{13,15}|[0-9]{4}[\x20-][0-9]{6}[\x20-][0-9]{4,5}"
                         r"|[0-9]{4}(?:[\x20-][0-9]{3}){3})(?![0-9])))")
_LOCAL = re.compile(r"(?:(?<![0-9])1[\x20.-])?(?:\([0-9]{3}\)[\x20.-]?|(?<![0-9])[0-9]{3}[\x20.-])[0-9]{3}[\x20.-][0-9]{4}(?![0-9])"
                    r"|\([0-9]{2,5}\)[\x20./-]?[0-9]{3,9}(?:[\x20.-][0-9]{2,5}){0,3}(?![0-9])"
                    r"|(?<![0-9.])[0-9]{2,5}(?:\.[0-9]{2,8}){2,4}(?!\.?[0-9])")
_LOCAL_RUN = re.compile(r"[(0-9][\x20()./0-9-]{7,}+")
_LAST_GROUP = re.compile(r"[\x20.-][0-9]+\Z")
_LOCAL_CHARS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOUBLED = (0, 2, 4, 6, 8, 1, 3, 5, 7, 9)


def luhn(digits: str) -> bool:
    last = [int(c) for c in reversed(digits)]
    return sum(last[::2] + [_DOUBLED[d] for d in last[1::2]]) % 10 == 0


def mod97(iban: str) -> bool:
    plain = iban.replace(" ", "")
    return int("".join(str(int(c, 36)) for c in plain[4:] + plain[:4])) % 97 == 1


def iban_end(text: str, start: int, end: int) -> int | None:
    """The last end of a group of letters and digits at which text[start:end],
    from its start, passes; capitals after an IBAN may run on into the match."""
    while end - start >= 15:
        if not text[end:end + 1].isalnum() and mod97(text[start:end]):
            return end
        end = start + max(text[start:end].rfind(" "), 0)
    return None


def emails(text: str) -> list[tuple[int, int]]:
    """Leftmost matches of local@domain: the local part is the run of its
    characters before an "@", from the end of the last match on."""
    out, end, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > end and text[start - 1] in _LOCAL_CHARS:
            start -= 1
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            end = domain.end()
            out.append((start, end))
        at = text.find("@", max(at + 1, end))
    return out


def ips(text: str) -> list[tuple[int, int]]:
    """Groups of digits joined by single dots, four by four."""
    out = []
    for m in _DOTTED.finditer(text):
        groups = m.group().split(".")
        at = m.start()
        for k in range(0, len(groups) - 3, 4):
            four = groups[k:k + 4]
            size = sum(map(len, four)) + 3
            if all(len(g.lstrip("0")) <= 3 and int(g.lstrip("0") or 0) <= 255 for g in four):
                out.append((at, at + size))
            at += size + 1
    return out


def score(kind: str, text: str, start: int, end: int, checked: bool) -> float:
    base, gain, words = SCORES[kind]
    near = text[max(0, start - REACH):start].lower() + " " + text[end:end + REACH].lower()
    return (base + gain * checked + 0.3 * any(w in near for w in words)
            - 0.2 * any(w in near for w in AGAINST))


def local_phones(text: str) -> list[tuple[int, int]]:
    """Local numbers by their own grouping, with brackets and dots, 9 to 11
    digits; last groups over that are left out."""
    out = []
    for run in _LOCAL_RUN.finditer(text):
        m = _LOCAL.search(text, *run.span())
        while m:
            found = m.group()
            while (n := sum(map(str.isdigit, found))) > 11 and (last := _LAST_GROUP.search(found)):
                found = found[:last.start()]
            good = 9 <= n <= 11
            if good:
                out.append((m.start(), m.start() + len(found)))
            m = _LOCAL.search(text, out[-1][1] if good else m.start() + 1, run.end())
    return out


def find_spans(text: str) -> dict[str, list[tuple[int, int]]]:
    """Spans by kind, in code points, ends exclusive."""
    out: dict[str, list] = {k: [] for k in KINDS}
    out["email"] = emails(text)
    out["ip"] = ips(text)
    proposed = []
    for m in _DIGITS.finditer(text):
        size = m.end() - m.start()
        if size < 9:
            continue
        digits = m.group().replace(" ", "").replace("-", "")
        n = len(digits)
        if 16 <= n <= 19:
            if luhn(digits):
                out["card"].append(m.span())
        elif 13 <= n <= 15 and luhn(digits):
            proposed.append(("card_short", *m.span(), True))
        elif 9 <= n <= 11 and size > n and not _SSN.fullmatch(m.group()):
            proposed.append(("phone_local", *m.span(), False))
        # the same kinds next to other digits of the run
        if size > n:
            at = m.start()
            proposed += [("ssn", at + x.start(), at + x.end(), False) for x in _SSN.finditer(m.group())]
            if n > 13:
                proposed += [("card_short", at + x.start(1), at + x.end(1), True) for x in _CARD_SHORT.finditer(m.group())
                             if luhn(x.group(1).replace(" ", "").replace("-", ""))]
    proposed += [("phone_local", *span, False) for span in local_phones(text)]
    if "+" in text:
        out["phone"] = [m.span() for m in _PHONE.finditer(text)
                        if 8 <= sum(map(str.isdigit, m.group())) <= 15]
    free = 0
    for m in _IBAN.finditer(text):
        end = iban_end(text, *m.span(1)) if m.start() >= free else None
        if end:
            proposed.append(("iban", m.start(), end, True))
            free = end
    taken = sorted(s for k in BASE_KINDS for s in out[k])
    starts = [s for s, _ in taken]
    reached = list(accumulate((e for _, e in taken), max, initial=0))
    for kind, start, end, checked in sorted(proposed, key=lambda p: (p[1], -p[2])):
        if (score(kind, text, start, end, checked) >= MIN_SCORE
                and reached[bisect_left(starts, end)] <= start
                and all(not out[k] or out[k][-1][1] <= start for k in (kind, "iban"))):
            out[kind].append((start, end))
    return out


def joined(spans: dict, kinds) -> str:
    return ",".join(f"{k}:{s}:{e}" for k in kinds for s, e in spans[k])


def scan_documents(df: DataFrame) -> DataFrame:
    """doc_id, counts of the base kinds, digest of the base spans, all spans."""
    def kernel(texts):
        found = [find_spans(t) for t in texts]
        return {f"n_{k}": [len(f[k]) for f in found] for k in BASE_KINDS} | {
            "base_sha256": [hashlib.sha256(joined(f, BASE_KINDS).encode()).hexdigest() for f in found],
            "spans": [joined(f, KINDS) for f in found],
            "n_added": [sum(len(f[k]) for k in KINDS[len(BASE_KINDS):]) for f in found]}

    return map_texts(df, kernel, SCHEMA)


def redacted(text: str) -> str:
    """``text`` with each run of overlapping spans as the first one's [KIND]."""
    found = sorted((s, e, k) for k, spans in find_spans(text).items() for s, e in spans)
    out, at, k = [], 0, 0
    while k < len(found):
        start, end, kind = found[k]
        while k < len(found) and found[k][0] < end:
            end = max(end, found[k][1])
            k += 1
        out += [text[at:start], f"[{kind.upper()}]"]
        at = end
    return "".join(out) + text[at:] if out else text


def redact(df: DataFrame) -> DataFrame:
    """The rows of ``df`` with personal data in ``text`` replaced; ``n_chars``,
    where there is one, follows the new text. Null texts stay null."""
    names = df.columns
    at = names.index("text")
    sized = names.index("n_chars") if "n_chars" in names else None

    def run(batches):
        for part in slices(batches):
            texts = part.column(at).to_pylist()
            clean = [None if t is None else redacted(t) for t in texts]
            cols = list(part.columns)
            cols[at] = pa.array(clean, type=part.schema.field(at).type)
            if sized is not None:
                old = part.column(sized).to_pylist()
                cols[sized] = pa.array([n if t == c else len(c) for n, t, c in zip(old, texts, clean)],
                                       type=part.schema.field(sized).type)
            yield pa.RecordBatch.from_arrays(cols, schema=part.schema)

    return map_rows(df, run)
