"""Secrets: patterns propose, decoding confirms.

Base kinds (always reported): assign, access, hex. Added kinds are reported only when their structure holds:
``jwt`` (three base64url parts whose header is JSON with an ``alg``), ``pem`` (armour whose body decodes to nested
DER or an OpenSSH key), ``ssh`` (a public-key blob with consistent lengths) and ``der`` (a base64 or hex run that is a
complete DER sequence). Null and empty texts have no spans.
"""

from __future__ import annotations

import base64
import binascii
import json
import re

from pyspark.sql import DataFrame

from tillwise.llm.common import SPANS, map_rows

# Kinds in report order.
KINDS = ("assign", "access", "hex", "jwt", "pem", "ssh", "der")
ASSIGN = re.compile(r"""(?:[pP][aA][sS][sS](?:[wW][oO][rR][dD]|[wW][dD])|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"(?<![0-9a-f])[0-9a-f]{32,}+")
JWT = re.compile(r"(?<![A-Za-z0-9_-])eyJ[A-Za-z0-9_-]{8,}+\.([A-Za-z0-9_-]++)\.([A-Za-z0-9_-]*+)")
PEM_HEAD = re.compile(r"-----BEGIN ([A-Z0-9 ]{3,40})-----")
SSH = re.compile(r"(?<![A-Za-z0-9+/])AAAA[A-Za-z0-9+/]{28,}+={0,2}")
DER_TEXT = re.compile(r"(?<![A-Za-z0-9+/_-])M[A-Za-z0-9+/_-]{30,}+={0,2}")
DER_LINE = re.compile(r"\r?\n([A-Za-z0-9+/]+)(={0,2})(?![A-Za-z0-9+/=])")
DER_HEX = re.compile(r"(?<![0-9A-Fa-f])30[0-9A-Fa-f]{30,}+")
PEM_BASE64 = re.compile(r"(?<![A-Za-z0-9+/_-])LS0tLS1[A-Za-z0-9+/_-]{40,}+={0,2}")


def _unbase64(s: str, url: bool = False) -> bytes | None:
    try:
        s = s.rstrip("=")
        return base64.b64decode(s + "=" * (-len(s) % 4), altchars=b"-_" if url else None, validate=True)
    except (binascii.Error, ValueError):
        return None


def der_depth(data: bytes) -> int:
    """Nesting depth of a DER value that fills ``data`` exactly; 0 if it is none."""
    end, depth = _der(data, 0, len(data), 0)
    return depth if end == len(data) and data[:1] == b"\x30" else 0


def _der(data: bytes, at: int, limit: int, level: int) -> tuple[int, int]:
    """End of the value at ``at`` (-1 if broken) and the levels in it."""
    if at + 2 > limit or level > 16:
        return -1, 0
    tag, n, body = data[at], data[at + 1], at + 2
    if n & 0x80:
        k = n & 0x7F
        if not 1 <= k <= 4 or body + k > limit:
            return -1, 0
        n, body = int.from_bytes(data[body:body + k], "big"), body + k
    end, deepest = body + n, 0
    if end > limit:
        return -1, 0
    if tag & 0x20:
        while body < end:
            body, depth = _der(data, body, end, level + 1)
            if body < 0:
                return -1, 0
            deepest = max(deepest, depth)
    return end, deepest + 1


def ssh_blob(data: bytes) -> bool:
    """Length-prefixed fields that fill the blob, the first one naming a key type."""
    at, fields = 0, []
    while at + 4 <= len(data):
        n = int.from_bytes(data[at:at + 4], "big")
        if at + 4 + n > len(data):
            return False
        fields.append(data[at + 4:at + 4 + n])
        at += 4 + n
    return at == len(data) and len(fields) >= 2 and fields[0].startswith((b"ssh-", b"ecdsa-", b"sk-"))


def key_bytes(data: bytes | None) -> bool:
    """A private-key container: nested DER of two levels or more, or the OpenSSH format."""
    return bool(data) and (data.startswith(b"openssh-key-v1\x00") or der_depth(data) >= 2)


def jwt_header(part: str) -> bool:
    try:
        head = json.loads(_unbase64(part, url=True) or b"")
    except (ValueError, RecursionError):
        return False
    return isinstance(head, dict) and isinstance(head.get("alg"), str)


def _pem(text: str) -> list[tuple[int, int]]:
    """Armoured keys: no other BEGIN line lies between the two ends, so each stretch of text is looked at once."""
    out, heads = [], list(PEM_HEAD.finditer(text))
    for m, limit in zip(heads, [*(h.start() for h in heads[1:]), len(text)]):
        foot = f"-----END {m[1]}-----"
        end = text.find(foot, m.end(), limit)
        body = "" if end < 0 else text[m.end():end].replace("\\n", "\n").replace("\\r", "")  # line breaks, or written as in JSON
        if body and key_bytes(_unbase64(re.sub(r"[A-Za-z-]+: [^\n]*\n|\s", "", body))):
            out.append((m.start(), end + len(foot)))
    return out


def _der_text(text: str) -> list[tuple[int, int]]:
    """Base64 or base64url runs that are a DER sequence, on one line or broken into lines of one length and a last one."""
    out = []
    for m in DER_TEXT.finditer(text):
        run, end = m[0], m.end()
        if der_depth(_unbase64(run, url="-" in run or "_" in run) or b"") >= 2:
            out.append((m.start(), end))
            continue
        lines, width = [run], len(run)
        while width >= 40 and len(lines[-1]) == width and (n := DER_LINE.match(text, end)) and len(n[1]) + len(n[2]) <= width:
            lines.append(n[1] + n[2])
            end = n.end()
        if len(lines) > 1 and der_depth(_unbase64("".join(lines)) or b"") >= 2:
            out.append((m.start(), end))
    return out


def find(text: str | None) -> list[dict]:
    """All spans of one text, by start and then kind. ``score`` is 1 where a structure was confirmed, else 0.5."""
    if not text:
        return []
    spans = []
    for m in ASSIGN.finditer(text):
        if len(m[1]) >= 8:
            value = m[1]
            known = value.startswith("eyJ") and jwt_header(value.split(".")[0]) or key_bytes(_unbase64(value)) or (
                re.fullmatch(r"(?:[0-9a-f]{2}){8,}", value) is not None)
            spans.append(("assign", *m.span(), True, 1.0 if known else 0.5))
    spans += [("access", *m.span(), True, 1.0 if len(m[0]) == 20 else 0.5) for m in ACCESS.finditer(text) if len(m[0]) >= 16]
    for m in HEX.finditer(text):
        data = bytes.fromhex(m[0]) if len(m[0]) % 2 == 0 else b""
        spans.append(("hex", *m.span(), True, 1.0 if key_bytes(data) else 0.5))
    spans += [("der", *m.span(), False, 1.0) for m in DER_HEX.finditer(text) if len(m[0]) % 2 == 0 and der_depth(bytes.fromhex(m[0])) >= 2]
    if "eyJ" in text:
        spans += [("jwt", *m.span(), False, 1.0) for m in JWT.finditer(text) if jwt_header(m[0].split(".")[0])]
    armoured = _pem(text) if "-----BEGIN " in text else []
    spans += [("pem", a, b, False, 1.0) for a, b in armoured]
    if "LS0tLS1" in text:
        spans += [("pem", *m.span(), False, 1.0) for m in PEM_BASE64.finditer(text)
                  if _pem((_unbase64(m[0], url="-" in m[0] or "_" in m[0]) or b"").decode("latin-1"))]
    if "AAAA" in text:
        spans += [("ssh", *m.span(), False, 1.0) for m in SSH.finditer(text) if ssh_blob(_unbase64(m[0]) or b"")]
    if "M" in text:
        at = 0
        for a, b in _der_text(text):
            while at < len(armoured) and armoured[at][1] <= a:
                at += 1
            if at == len(armoured) or a < armoured[at][0]:  # the body of an armoured key is reported once
                spans.append(("der", a, b, False, 1.0))
    spans.sort(key=lambda s: (s[1], KINDS.index(s[0]), s[2]))
    return [dict(zip(("kind", "start", "end", "base", "score"), s)) for s in spans]


def find_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id``, ``spans`` for every row of ``docs``; other columns are not read.

    Repeated rows give repeated results, a null id stays null.
    """
    return map_rows(docs.select(docs[id_col].alias("doc_id"), docs[text_col].alias("text")),
                    lambda c: {"doc_id": c[0], "spans": [find(t) for t in c[1]]}, f"doc_id long, spans {SPANS}")
