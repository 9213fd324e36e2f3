"""Personal data: patterns propose spans, checksums confirm them, nearby words move the score.

Base kinds (always reported): email, ip, card (Luhn), phone. Added kinds: iban (mod 97), tel (a number without ``+``)
and ssn, the last two only where context words lift their score to the threshold.
Null and empty texts have no spans; every pattern runs in time linear in the text.
"""

from __future__ import annotations

import re
from collections.abc import Iterable

from pyspark.sql import DataFrame

from tillwise.llm.common import SPANS, map_rows

# Kinds in report order, country lengths of IBANs, context words.
KINDS = ("email", "ip", "card", "phone", "iban", "tel", "ssn")
IBAN_LENGTH = {"AT": 20, "BE": 16, "BG": 22, "CH": 21, "CY": 28, "CZ": 24, "DE": 22, "DK": 18, "EE": 20, "ES": 24, "FI": 18,
               "FR": 27, "GB": 22, "GR": 27, "HR": 21, "HU": 28, "IE": 22, "IT": 27, "LT": 20, "LU": 20, "LV": 21, "MT": 31,
               "NL": 18, "NO": 15, "PL": 28, "PT": 25, "RO": 24, "SE": 24, "SI": 19, "SK": 24}
NEAR = {"email": ("mail", "contact", "write"), "ip": ("ip", "host", "address", "server"),
        "card": ("card", "visa", "credit", "debit", "karte", "carte", "tarjeta"),
        "phone": ("phone", "tel", "call", "mobile", "fax", "telefon", "téléphone", "teléfono"),
        "iban": ("iban", "account", "bank", "konto", "compte", "cuenta"),
        "tel": ("phone", "tel", "call", "mobile", "fax", "telefon", "téléphone", "teléfono"),
        "ssn": ("ssn", "social", "security")}
AGAINST = ("version", "invoice", "order", "serial", "isbn", "part", "build")
PRIOR = {"email": 0.9, "ip": 0.6, "card": 0.5, "phone": 0.7, "iban": 0.5, "tel": 0.2, "ssn": 0.3}
CHECKED = 0.4      # added where a checksum holds
CONTEXT = 0.35     # added or taken away for words nearby
WINDOW = 40        # code points before and after a span that count as nearby
THRESHOLD = 0.5    # for added kinds

MAIL_TAIL = re.compile(r"@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
MAIL_HEAD = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
IBAN = re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]){11,30}(?![A-Za-z0-9])")
SSN = re.compile(r"(?<![0-9-])(?!000|666|9)[0-9]{3}-(?!00)[0-9]{2}-(?!0000)[0-9]{4}(?![0-9-])")
TEL = re.compile(r"(?<![0-9+.-])\(?0?[0-9]{2,4}\)?[\x20/-][0-9]{2,4}[\x20-]?[0-9]{2,5}(?![0-9.-])")
NEAR_WORDS = re.compile(r"\w+")


def luhn(digits: str) -> bool:
    total = 0
    for at, d in enumerate(reversed(digits)):
        n = int(d) * (1 + at % 2)
        total += n - 9 if n > 9 else n
    return total % 10 == 0


def mod97(iban: str) -> bool:
    return int("".join(str(int(c, 36)) for c in iban[4:] + iban[:4])) % 97 == 1


def _digits(s: str) -> str:
    return "".join(c for c in s if "0" <= c <= "9")


def _emails(text: str) -> list[tuple[int, int]]:
    """The part before ``@`` is the run of its characters back to the last match, so no text is scanned twice."""
    out, low = [], 0
    for m in MAIL_TAIL.finditer(text):
        start = m.start()
        while start > low and text[start - 1] in MAIL_HEAD:
            start -= 1
        if start < m.start():
            out.append((start, m.end()))
            low = m.end()
    return out


def _ibans(text: str) -> list[tuple[int, int]]:
    """A pattern match may run on into following capitals, so the country's length decides where it ends."""
    out = []
    for m in IBAN.finditer(text):
        length, end, seen = IBAN_LENGTH.get(m[0][:2]), m.start(), 0
        if length is None:
            continue
        while end < m.end() and seen < length:
            seen += text[end] != " "
            end += 1
        whole = end == m.end() or not text[end].isalnum()
        if seen == length and whole and mod97(text[m.start():end].replace(" ", "")):
            out.append((m.start(), end))
    return out


def find(text: str | None) -> list[dict]:
    """All spans of one text, by start and then kind. Positions are code points, the end exclusive."""
    if not text:
        return []
    base = [("email", a, b) for a, b in _emails(text)] if "@" in text else []
    base += [("ip", *m.span()) for m in IP.finditer(text) if all(len(p.lstrip("0")) <= 3 and int(p[-4:]) <= 255 for p in m[0].split("."))]
    for m in CARD.finditer(text):
        d = _digits(m[0]) if 12 <= m.end() - m.start() <= 37 else ""
        if 12 <= len(d) <= 19 and luhn(d):
            base.append(("card", *m.span()))
    if "+" in text:
        base += [("phone", *m.span()) for m in PHONE.finditer(text) if 9 <= len(_digits(m[0])) <= 15]
    added = [("iban", a, b) for a, b in _ibans(text)]
    taken = _merged((a, b) for _, a, b in (*base, *added))
    for kind, pattern in (("tel", TEL), ("ssn", SSN)):
        at = 0
        for m in pattern.finditer(text):
            while at < len(taken) and taken[at][1] <= m.start():
                at += 1
            if at == len(taken) or m.end() <= taken[at][0]:
                added.append((kind, *m.span()))
    spans = [(kind, a, b, True, _score(text, kind, a, b)) for kind, a, b in base]
    for kind, a, b in added:
        if (score := _score(text, kind, a, b)) >= THRESHOLD:
            spans.append((kind, a, b, False, score))
    spans.sort(key=lambda s: (s[1], KINDS.index(s[0]), s[2]))
    return [dict(zip(("kind", "start", "end", "base", "score"), s)) for s in spans]


def _merged(spans: Iterable[tuple[int, int]]) -> list[tuple[int, int]]:
    """Spans in order, overlapping ones as one, so that both ends rise."""
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a < out[-1][1]:
            out[-1] = out[-1][0], max(b, out[-1][1])
        else:
            out.append((a, b))
    return out


def _score(text: str, kind: str, start: int, end: int) -> float:
    near = {w.lower() for w in NEAR_WORDS.findall(f"{text[max(0, start - WINDOW):start]} {text[end:end + WINDOW]}")}
    score = PRIOR[kind] + CHECKED * (kind in ("card", "iban"))
    score += CONTEXT * bool(near & set(NEAR[kind])) - CONTEXT * bool(near & set(AGAINST))
    return min(1.0, max(0.0, score))


def find_pii(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id``, ``spans`` (kind, start, end, base, score) for every row of ``docs``; other columns are not read.

    Repeated rows give repeated results, a null id stays null.
    """
    return map_rows(docs.select(docs[id_col].alias("doc_id"), docs[text_col].alias("text")),
                    lambda c: {"doc_id": c[0], "spans": [find(t) for t in c[1]]}, f"doc_id long, spans {SPANS}")


def mask_pii(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id`` and the text with every reported span replaced by ``<KIND>``; of overlapping spans the first wins."""
    def masked(text: str | None) -> str | None:
        if text is None:
            return None
        out, at = [], 0
        for s in find(text):
            if s["start"] >= at:
                out += [text[at:s["start"]], f"<{s['kind'].upper()}>"]
                at = s["end"]
        return "".join([*out, text[at:]])

    return map_rows(docs.select(docs[id_col].alias("doc_id"), docs[text_col].alias("text")),
                    lambda c: {"doc_id": c[0], "text": [masked(t) for t in c[1]]}, "doc_id long, text string")
