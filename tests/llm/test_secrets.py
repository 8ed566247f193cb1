"""Secret scan against plain re-implementations and built keys."""

import base64
import hashlib
import json
import re

import pytest

from seriesloom.llm import secrets


def der(tag, body):
    size = len(body)
    head = bytes([size]) if size < 128 else bytes([0x80 | (n := (size.bit_length() + 7) // 8)]) + size.to_bytes(n, "big")
    return bytes([tag]) + head + body


def rsa():
    return der(0x30, der(2, b"\0") + b"".join(der(2, bytes(range(1, 60))) for _ in range(8)))


def ssh():
    f = lambda b: len(b).to_bytes(4, "big") + b
    return b"openssh-key-v1\0" + f(b"none") + f(b"none") + f(b"") + (1).to_bytes(4, "big") + f(b"public") + f(b"private" * 9)


def url(b):
    return base64.urlsafe_b64encode(b).decode().rstrip("=")


def kinds(text):
    return [k for _, _, k in secrets.scan(text)]


def test_keys_are_confirmed_by_structure():
    key = base64.b64encode(rsa()).decode()
    assert secrets.is_der_key(rsa()) and not secrets.is_der_key(rsa()[:-1]) and not secrets.is_der_key(rsa() + b"\0")
    assert "der" in kinds(f"x {key} y")
    assert "der" in kinds(rsa().hex())
    assert "der" not in kinds(base64.b64encode(b"0\x82" + bytes(200)).decode())
    assert "openssh" in kinds(base64.b64encode(ssh()).decode())
    assert not secrets.is_openssh_key(ssh() + b"x") and not secrets.is_openssh_key(ssh()[:-1])
    lines = "\n".join(key[i : i + 64] for i in range(0, len(key), 64))
    assert "pem" in kinds(f"-----BEGIN RSA PRIVATE KEY-----\n{lines}\n-----END RSA PRIVATE KEY-----")
    assert "pem" not in kinds("-----BEGIN RSA PRIVATE KEY-----\nAAAA\n-----END RSA PRIVATE KEY-----")


def test_signed_tokens():
    head, body = url(json.dumps({"alg": "HS256"}).encode()), url(json.dumps({"sub": "1"}).encode())
    assert "jwt" in kinds(f"Bearer {head}.{body}.{url(bytes(32))}")
    assert "jwt" not in kinds(f"{head}.{body}.")
    assert "jwt" not in kinds(f"{url(b'[1,2,3,4,5]')}.{body}.abc")


@pytest.mark.parametrize("indent", ['{\n  "alg": "HS256"\n}', '{\r\n"alg": "HS256"}', ' {"alg": "HS256"}', '{ "alg": "HS256"}', '\t{"alg": "HS256"}'])
def test_signed_tokens_with_laid_out_headers(indent):
    body = url(json.dumps({"sub": "1"}, indent=2).encode())
    assert "jwt" in kinds(f"Bearer {url(indent.encode())}.{body}.{url(bytes(32))}")


def armour(name, data):
    return f"x\n-----BEGIN {name}-----\n{base64.encodebytes(data).decode()}-----END {name}-----\ny"


@pytest.mark.parametrize("scheme", ["2a864886f70d01050d", "2a864886f70d010503", "2a864886f70d010c0103"])
def test_encrypted_keys(scheme):
    algorithm = der(6, bytes.fromhex(scheme)) + der(0x30, der(4, b"saltsalt") + der(2, b"\x08\0"))
    key = der(0x30, der(0x30, algorithm) + der(4, bytes(range(96))))
    assert "pem" in kinds(armour("ENCRYPTED PRIVATE KEY", key))
    assert "der" in kinds(base64.b64encode(key).decode()) and not secrets.is_der_key(key[:-1])
    digest = der(0x30, der(0x30, der(6, bytes.fromhex("608648016503040201")) + der(5, b"")) + der(4, bytes(32)))
    assert "der" not in kinds(base64.b64encode(digest).decode()) and "pem" in kinds(armour("ENCRYPTED PRIVATE KEY", digest))


def test_dsa_keys():
    key = der(0x30, der(2, b"\0") + b"".join(der(2, bytes(range(1, n))) for n in (129, 21, 128, 128, 20)))
    assert "pem" in kinds(armour("DSA PRIVATE KEY", key))
    assert "der" in kinds(base64.b64encode(key).decode())
    assert not secrets.is_der_key(der(0x30, der(2, b"\0") + b"".join(der(2, b"\1") for _ in range(4))))


def brute(text):
    out = []
    pattern = r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
    out += [(m.start(), 0, m.end()) for m in re.finditer(pattern, text, re.A) if len(m[2]) >= 6]
    out += [(m.start(), 1, m.end()) for m in re.finditer(r"AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    out += [(m.start(), 2, m.end()) for m in re.finditer(r"[0-9a-f]+", text) if len(m[0]) >= 24]
    return ",".join(f"{secrets.BASE[k]}:{a}:{b}" for a, k, b in sorted(out))


TEXTS = [
    None, "", "é" * 30 + "password = 'hunter22' token:abc secret=abc123", "AKIA" + "A1" * 8 + " AKIAA",
    "a" * 23, "0" * 24, "ü" + "abcdef0123456789" * 3 + "z", "API_KEY==abcdef apikey: \"x.y_z-123\"", "b" * 23 + "é" + "c" * 24,
    "x" * 200_000 + " passwd:123456 " + "deadbeef" * 4, "token = token = abcdefgh",
]


def test_base_findings_equal_brute_force(spark):
    rows = [(i, t, "z") for i, t in enumerate(TEXTS)] + [(2, TEXTS[2], "z"), (None, TEXTS[3], "z")]
    df = spark.createDataFrame(rows, "doc_id long, text string, findings string")
    got = [(r.doc_id, r.base) for r in secrets.findings(df).select("doc_id", secrets.spans(secrets.F.col("findings"), secrets.BASE).alias("base")).collect()]
    want = [(i, brute(t or "")) for i, t, _ in rows]
    assert sorted(got, key=str) == sorted(want, key=str)
    assert any(b for _, b in got)


def test_redaction_keeps_rows_and_columns(spark):
    df = spark.createDataFrame([(1, "a password=abcdef1 b", None), (2, None, "x"), (3, "clean", "y")], "doc_id long, text string, lang string")
    got = sorted(map(tuple, secrets.redact(df).collect()))
    assert got == [(1, "a [assign] b", None), (2, None, "x"), (3, "clean", "y")]


@pytest.mark.parametrize("rows", [[], [(1, None)]])
def test_empty_inputs(spark, rows):
    out = secrets.findings(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert [r.findings for r in out] == [[] for _ in rows]
    assert hashlib.sha256(b"").hexdigest().startswith("e3b0")
