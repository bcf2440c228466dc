import base64
import hashlib
import json
import random
import re
import time

import duckdb

from citeloom.llm import secrets as s


def brute(text):
    text, out = text or "", []
    word = lambda w: "".join(f"[{c}{c.upper()}]" if c.isalpha() else c for c in w)
    names = "|".join([word(w) for w in ("password", "passwd", "secret", "token")] + [word("api") + "_?" + word("key")])
    for m in re.finditer(rf"""({names})["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", text):
        if len(m[2]) >= 12:
            out.append((m.start(), 0, m.end()))
    out += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 18]
    out += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 16]
    return sorted(out)


def item(tag, body):
    n = len(body)
    return bytes([tag]) + (bytes([n]) if n < 128 else b"\x82" + n.to_bytes(2, "big")) + body


KEY = item(0x30, item(2, b"\0") + item(2, bytes(range(1, 129))) + item(2, b"\1\0\1") + item(2, b"k" * 60))
B64 = base64.b64encode(KEY).decode()


def pem(body, label="RSA "):
    lines = "\n".join(body[i : i + 64] for i in range(0, len(body), 64))
    return f"-----BEGIN {label}PRIVATE KEY-----\n{lines}\n-----END {label}PRIVATE KEY-----"


def part(x):
    return base64.urlsafe_b64encode(json.dumps(x).encode()).decode().rstrip("=")


def kinds(text):
    return [s.KINDS[k] for _, k, _ in s.scan(text)]


def test_base_spans_equal_brute_force():
    rnd = random.Random(1)
    parts = ["token", "secret", " ", "=", ":", '"', "'", "PassWord", "api_key", "apiKEY", "AKIA", "ABCD1234EF56GH", "0123456789abcdef", "abc", "x.y", "ſecret", "toKen", "\n", "é", "😀"]
    for _ in range(5000):
        text = "".join(rnd.choice(parts) for _ in range(rnd.randint(0, 14)))
        assert [x for x in s.scan(text) if x[1] < 3] == brute(text), text


def test_structure_confirms():
    assert kinds(pem(B64)) == kinds(pem(B64, "")) == ["pem"]
    assert kinds("k " + B64) == ["key"] and kinds("k " + KEY.hex()) == ["hex", "key"]
    assert kinds(pem(B64[:-8])) == kinds("k " + B64[:-8]) == kinds("A" * 200) == []
    locked = "-----BEGIN RSA PRIVATE KEY-----\nProc-Type: 4,ENCRYPTED\nDEK-Info: AES-128-CBC,{}\n\n{}\n-----END RSA PRIVATE KEY-----"
    assert kinds(locked.format("0F" * 16, base64.b64encode(b"c" * 96).decode())) == ["pem"]
    assert kinds(locked.format("0F" * 16, base64.b64encode(b"c" * 95).decode())) == kinds(locked.format("xyz", base64.b64encode(b"c" * 96).decode())) == []
    assert kinds("-----BEGIN PRIVATE KEY-----\nthis is prose, not a key, but it says ENCRYPTED here\n-----END PRIVATE KEY-----") == []
    assert kinds(pem("Proc-Type: 4,ENCRYPTED\n" + B64)) == []
    ssh = b"openssh-key-v1\0" + b"".join(len(x).to_bytes(4, "big") + x for x in (b"none", b"none", b"")) + b"\0\0\0\1" + b"z" * 40
    assert kinds(pem(base64.b64encode(ssh).decode(), "OPENSSH ")) == ["pem"]
    token = part({"alg": "HS256"}) + "." + part({"sub": 1}) + ".c2ln"
    assert kinds("t " + token) == ["jwt"] and s.scan("t " + token)[0][::2] == (2, 2 + len(token))
    assert kinds(part({"typ": "x"}) + "." + part({"a": 1}) + ".c2ln") == [] == kinds(part({"alg": "x"}) + ".e30x.")
    assert kinds("Basic " + base64.b64encode(b"user:pass").decode()) == ["basic"] and kinds("Basic training") == []
    for url in ("postgres://u:secretpw@host/db", "see ftp://a:b%2Fcd@files.example.org:21.", "ws://u:pass@[::1]:80/", "(https://me:pw1@1.2.3.4)"):
        assert kinds(url) == ["basic"], url
    for url in ("ws://u:pass@", "ws://u:pa%zz@host/", "ws://u:pass@host:99999/", "ws://u:pass@-host/", "ws://u:pass@ho_st/", "ws://u:pass@a..b/"):
        assert kinds(url) == [], url


def test_frames_are_paired_in_one_pass():
    good = pem(B64)
    assert s.scan("-----BEGIN PRIVATE KEY-----\nlost\n" + good)[0][0] == 33  # the last BEGIN before an END
    assert kinds(good + "\n" + good + pem(B64, "")) == ["pem"] * 3
    assert kinds(good.replace("END RSA", "END DSA")) == ["key"]  # the body stands for itself
    began = time.perf_counter()
    assert s.scan("-----BEGIN PRIVATE KEY-----\n" * 180_000) == []
    assert s.scan(("-----BEGIN PRIVATE KEY-----\nx\n-----END PRIVATE KEY-----\n") * 80_000) == []
    assert len(s.scan(good * 2000)) == 2000
    assert time.perf_counter() - began < 5


def test_base_spans_equal_their_sql(same, middle):
    assert same(s.secret_base_spans, s.ORACLES["secret_base_spans"], middle) == 1000


def test_nesting_is_checked():
    assert s.der_items(KEY) == 5
    assert s.der_items(KEY[:-1]) is None and s.der_items(KEY + b"\x30\x05") is None
    deep = b"\x05\x00"
    for _ in range(30):
        deep = item(0x30, deep)
    assert s.der_items(deep) is None


def test_query(spark, middle):
    texts = dict(duckdb.sql(f"SELECT doc_id, text FROM '{middle}/documents.parquet'").fetchall())
    rows = s.op4_secret_scan(spark, middle).collect()
    assert len(rows) == len(texts)
    for r in rows:
        want = brute(texts[r.doc_id])
        assert (r.n_assign, r.n_access, r.n_hex) == tuple(sum(x[1] == k for x in want) for k in range(3))
        assert r.base_sha256 == hashlib.sha256(s.render(want).encode()).hexdigest()
        assert set(filter(None, s.render(want).split(","))) <= set(r.spans.split(","))


def test_odd_rows(spark):
    rows = [(1, None, "x"), (None, "", "x"), (2, "token=" + "a1" * 50_000, "x"), (2, "token=" + "a1" * 50_000, "x"), (3, "é" * 10 + " AKIA" + "B" * 14, "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, spans string")
    got = s.find_secrets(docs).collect()
    assert sorted((r.doc_id or 0, [(x.kind, x.start, x.stop) for x in r.spans]) for r in got) == [
        (0, []),
        (1, []),
        (2, [("assign", 0, 100_006), ("hex", 6, 100_006)]),
        (2, [("assign", 0, 100_006), ("hex", 6, 100_006)]),
        (3, [("access", 11, 29)]),
    ]
    assert s.find_secrets(docs.where("false")).count() == 0


def test_encrypted_and_openpgp_blocks():
    shut = item(0x30, item(0x30, item(6, b"*\x86H\x86\xf7\r\1\5\r") + item(0x30, item(4, b"saltsalt"))) + item(4, b"c" * 200))
    body = base64.b64encode(shut).decode()
    assert kinds(pem(body, "ENCRYPTED ")) == ["pem"] and kinds(pem(body, "")) == kinds(pem(body[:-8], "ENCRYPTED ")) == []
    for packet in (b"\xc5\x50" + b"\4" + b"k" * 79, b"\x95\0\x50" + b"\4" + b"k" * 79, b"\xc5\xc0\x08" + b"\4" + b"k" * 199):
        lines = base64.b64encode(packet + b"\xcd\5alice").decode()
        block = f"-----BEGIN PGP PRIVATE KEY BLOCK-----\nVersion: GnuPG v2\n\n{lines}\n=aB3d\n-----END PGP PRIVATE KEY BLOCK-----"
        assert kinds(block) == ["pem"]
        assert kinds(block.replace(lines, base64.b64encode(packet).decode()[:-8])) == []
    assert kinds(block.replace(lines, base64.b64encode(b"\xc6" + packet[1:]).decode())) == []  # a public key


def test_wrapped_keys_are_decoded():
    for width in (64, 76):
        for end in ("\n", "\r\n", "\n  "):
            body = end.join(B64[i : i + width] for i in range(0, len(B64), width))
            for after in ("", "\nand then\n" + "A" * width):
                assert [x for x in s.scan("the key:\n" + body + after) if x[1] > 2] == [(9, 4, 9 + len(body))], (width, end, after)
            assert kinds("the key:\n" + body[: width * 2]) == []
    raw = item(0x30, item(2, b"\0") + item(2, b"n" * 100) + item(2, b"e" * 33))  # 144 bytes: three whole lines of 64
    full = base64.b64encode(raw).decode()
    assert len(full) == 192
    text = "\n".join(full[i : i + 64] for i in range(0, 192, 64))
    assert s.scan(text + "\nword") == [(0, 4, len(text))]
