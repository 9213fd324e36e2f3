"""PII and secrets against plain patterns, and the checks that confirm spans."""

import base64
import hashlib
import re

from pyspark.sql import functions as F

from llm.conftest import TEXTS
from tillwise.llm import pii, registry, secrets
from tillwise.llm.common import span_digest

SF = "/root/testdata/sf0.001"


def plain_pii(text):
    text, out = text or "", []
    number = lambda s: "".join(c for c in s if c in "0123456789")

    def luhn(d):
        return sum(sum(divmod(int(c) * 2, 10)) if i % 2 else int(c) for i, c in enumerate(reversed(d))) % 10 == 0

    for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text):
        out.append(("email", *m.span()))
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(p) <= 255 for p in m[0].split(".")):
            out.append(("ip", *m.span()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        if 12 <= len(number(m[0])) <= 19 and luhn(number(m[0])):
            out.append(("card", *m.span()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 9 <= len(number(m[0])) <= 15:
            out.append(("phone", *m.span()))
    return sorted(out, key=lambda s: (s[1], pii.KINDS.index(s[0])))


def plain_secrets(text):
    text, out = text or "", []
    for m in re.finditer(r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", text, re.ASCII):
        if len(m[2]) >= 8:
            out.append(("assign", *m.span()))
    out += [("access", *m.span()) for m in re.finditer(r"AKIA[A-Z0-9]+", text) if len(m[0]) >= 16]
    out += [("hex", *m.span()) for m in re.finditer(r"[0-9a-f]+", text) if len(m[0]) >= 32]
    return sorted(out, key=lambda s: (s[1], secrets.KINDS.index(s[0])))


def same_as_plain(rows, texts, plain, kinds):
    assert len(rows) == len(texts)
    for r in rows:
        want = plain(texts[r.doc_id])
        joined = ",".join(f"{k}:{a}:{b}" for k, a, b in want)
        assert r.base_sha256 == hashlib.sha256(joined.encode()).hexdigest(), (r, joined)
        assert [r[f"n_{k}"] for k in kinds] == [sum(w[0] == k for w in want) for k in kinds]
        assert not set(filter(None, joined.split(","))) - set(r.spans.split(","))


def test_base_spans_of_documents(spark):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    same_as_plain(registry.op1_pii(spark, SF).collect(), texts, plain_pii, ("email", "ip", "card", "phone"))
    same_as_plain(registry.op9_secrets(spark, SF).collect(), texts, plain_secrets, ("assign", "access", "hex"))


def test_odd_documents(spark, odd_docs, no_docs):
    texts = dict(enumerate(TEXTS))
    short = odd_docs.where("doc_id is not null and doc_id <> 5 and doc_id <> 7 and length(text) < 5000 or text is null")
    keep = {k: v for k, v in texts.items() if k not in (5, 7, 8)}
    same_as_plain(span_digest(pii.find_pii(short), {f"n_{k}": k for k in ("email", "ip", "card", "phone")}).collect(), keep, plain_pii, ("email", "ip", "card", "phone"))
    same_as_plain(span_digest(secrets.find_secrets(short), {f"n_{k}": k for k in ("assign", "access", "hex")}).collect(), keep, plain_secrets, ("assign", "access", "hex"))
    assert pii.find_pii(odd_docs).count() == secrets.find_secrets(odd_docs).count() == odd_docs.count()
    assert pii.find_pii(no_docs).count() == secrets.find_secrets(no_docs).count() == 0


def test_generated_texts_against_plain_patterns():
    from hypothesis import given, settings, strategies as st

    @settings(max_examples=400, deadline=None)
    @given(st.text(alphabet="a1.@-+ ()A_%9:='\"fk", max_size=60))
    def run(t):
        assert [(s["kind"], s["start"], s["end"]) for s in pii.find(t) if s["base"]] == plain_pii(t)
        t = t.replace("k", "token").replace("@", "AKIAAAAA")
        assert [(s["kind"], s["start"], s["end"]) for s in secrets.find(t) if s["base"]] == plain_secrets(t)

    run()


def test_checksums_and_context():
    kinds = lambda t: [s["kind"] for s in pii.find(t)]
    assert kinds(TEXTS[10]) == ["card", "iban"]
    assert "tel" in kinds("tel 030 1234 5678") and "tel" not in kinds("rows 030 1234 5678")
    assert "ssn" in kinds("ssn 123-45-6789") and "ssn" not in kinds("item 123-45-6789")
    near, far = pii.find("card 4111111111111111")[0], pii.find("order 4111111111111111")[0]
    assert near["score"] > far["score"] and near["base"] and far["base"]


def test_structures_are_decoded():
    kinds = lambda t: [s["kind"] for s in secrets.find(t)]
    assert kinds(TEXTS[12]) == ["jwt"]
    der = bytes([0x30, 0x46, 0x02, 0x01, 0x00, 0x04, 0x41]) + bytes(65)
    assert secrets.der_depth(der) == 2 and secrets.der_depth(der + b"\0") == 0 and secrets.der_depth(der[:-1]) == 0
    body = base64.b64encode(der).decode()
    assert kinds(f"-----BEGIN PRIVATE KEY-----\n{body}\n-----END PRIVATE KEY-----") == ["pem"]
    assert kinds(f"-----BEGIN PRIVATE KEY-----\n{body[:-9]}\n-----END PRIVATE KEY-----") == []
    blob = lambda *parts: base64.b64encode(b"".join(len(p).to_bytes(4, "big") + p for p in parts)).decode()
    assert kinds("ssh-ed25519 " + blob(b"ssh-ed25519", bytes(32))) == ["ssh"]
    assert "der" in kinds("key " + der.hex()) and "der" in kinds("key " + der.hex().upper())
    short = bytes([0x30, 0x2E, 0x02, 0x01, 0x00, 0x30, 0x05, 0x06, 0x03, 0x2B, 0x65, 0x70, 0x04, 0x22, 0x04, 0x20]) + bytes(range(32))
    for text in (base64.b64encode(short).decode(), base64.urlsafe_b64encode(short).decode()):
        assert kinds(f"key {text} end") == ["der"]
    armour = f"-----BEGIN PRIVATE KEY-----\n{body}\n-----END PRIVATE KEY-----"
    assert kinds(armour.replace("\n", "\\n")) == ["pem"] and kinds(base64.b64encode(armour.encode()).decode()) == ["pem"]
    lines = "\n".join(body[i:i + 64] for i in range(0, len(body), 64))
    assert [(s["kind"], s["start"], s["end"]) for s in secrets.find(f"a\n{lines}\nnext line")] == [("der", 2, 2 + len(lines))]
    begin = "-----BEGIN PRIVATE KEY-----\n"
    assert kinds(begin * 3 + armour[len(begin):]) == ["pem"]


def test_very_long_texts_take_linear_time_and_equal_the_plain_patterns():
    import time

    unit = "tel 030 1234 5678, 555-12-3456 10.0.0.1 a.b@c.de token=abcdefgh12 0123456789abcdef0123456789abcdef 4111 1111 1111 1111. -----BEGIN X KEY----- MIIB "
    texts = [unit * 500, unit * 4000, "x" * 10_000 + unit, "1 " * 20_000]
    took = []
    for t in texts:
        start = time.perf_counter()
        got, keys = pii.find(t), secrets.find(t)
        took.append(time.perf_counter() - start)
        assert [(s["kind"], s["start"], s["end"]) for s in got if s["base"]] == plain_pii(t)
        assert [(s["kind"], s["start"], s["end"]) for s in keys if s["base"]] == plain_secrets(t)
    assert took[1] < 30 * took[0]  # eight times the text
    assert sum(s["kind"] == "tel" for s in pii.find(texts[0])) >= 500


def test_words_behind_a_span_count():
    kinds = lambda t: [s["kind"] for s in pii.find(t)]
    assert kinds("030 1234 5678 is my phone") == ["tel"] and kinds("030 1234 5678 is my score") == []


def test_masking(odd_docs):
    got = {r.doc_id: r.text for r in pii.mask_pii(odd_docs.where("doc_id in (0, 6)")).collect()}
    assert got == {0: None, 6: "<EMAIL> mail <EMAIL>"}
    assert pii.find_pii(odd_docs).select(F.size("spans").alias("n")).where("n < 0").count() == 0
