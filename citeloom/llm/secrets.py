"""Secret scans with structural confirmation.

Base kinds, always reported, leftmost and without overlap within a kind:

- assign: a password-like name, `:` or `=`, and a value of 12 characters or more,
- access: `AKIA` and upper-case letters or digits, 18 characters or more,
- hex: lower-case hexadecimal digits, 16 or more.

Structural kinds are proposed by looser patterns and reported only when their
content parses:

- pem: a PEM block whose base64 body decodes to DER with consistent nested
  lengths, or to an OpenSSH key, or, after the header lines of an encrypted body,
  to whole cipher blocks; under the label ENCRYPTED to an algorithm and an octet
  string, in a PRIVATE KEY BLOCK to OpenPGP packets of which the first is a
  secret key,
- key: base64 or hex outside such a block that decodes to such a key, in one run
  or in lines of one width of which the last may be shorter,
- jwt: a signed token, three base64url parts of which the first decodes to a
  JSON object with `alg`, the second to a JSON object,
- basic: `Basic` credentials whose base64 decodes to printable text with a colon,
  or `user:password@` of a URL with a well-formed host and port behind it and
  nothing but whole escapes before it.

Offsets are code points, the end exclusive. A null text counts as empty; an
empty table gives an empty result; repeated rows and null ids are reported row
by row, other columns are ignored. Whole texts are scanned, one at a time, by
patterns whose work grows with the length of the text: no run, frame or body is
entered twice.
"""

from __future__ import annotations

import base64
import binascii
import hashlib
import json
import math
import re

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from .common import map_arrow, table

BASE_KINDS = ("assign", "access", "hex")
KINDS = (*BASE_KINDS, "pem", "key", "jwt", "basic")

#: What a lower-cased text must hold for an assignment.
NAMES = ("password", "passwd", "secret", "token", "apikey", "api_key")
_any_case = lambda word: "".join(f"[{c}{c.upper()}]" for c in word)
_NAME = "|".join([_any_case(w) for w in NAMES[:4]] + [_any_case("api") + "_?" + _any_case("key")])
ASSIGN = re.compile(rf"""(?:{_NAME})["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
ACCESS = re.compile(r"AKIA[A-Z0-9]{14,}")
HEX = re.compile(r"[0-9a-f]{16,}")
FRAME = re.compile(r"-----(BEGIN|END) ([A-Z0-9 ]{0,40}?)PRIVATE KEY( BLOCK|)-----")
BODY = re.compile(r"[A-Za-z0-9+/=\s:,.()-]*")
#: Header lines of an encrypted body: the note, the cipher and its initial vector.
LOCKED = re.compile(r"\s*Proc-Type: *4, *ENCRYPTED\s+DEK-Info: *[A-Z0-9-]+, *([0-9A-Fa-f]{16,64})\s+")
BARE = re.compile(r"(?<![A-Za-z0-9+/])[A-Za-z0-9+/]{40,}={0,2}")
LINE = re.compile(r"\r?\n[\t\x20]*([A-Za-z0-9+/]+={0,2})(?![A-Za-z0-9+/=])")
JWT = re.compile(r"(?<![A-Za-z0-9_-])eyJ[A-Za-z0-9_-]{5,}\.[A-Za-z0-9_-]{2,}\.[A-Za-z0-9_-]*")
BASIC = re.compile(r"[Bb]asic\x20+([A-Za-z0-9+/]{8,}={0,2})|[a-z][a-z0-9+.-]{1,15}://([^\s/:@?#]{1,256}):([^\s/:@?#]{3,256})@")
#: What may follow the `@` of credentials: a name of labels, an address or a bracketed one, a port, and the end or a path.
HOST = re.compile(r"(?:(?:[A-Za-z0-9](?:[A-Za-z0-9-]{0,62})\.)*[A-Za-z0-9][A-Za-z0-9-]{0,62}|\[[0-9A-Fa-f:.]{2,45}\])(?::([0-9]{1,5}))?(?=[/?#\s\"'<>),;]|\.?$|\.\s)")
ESCAPE = re.compile(r"%(?![0-9A-Fa-f]{2})")
HEX_KEY = re.compile(r"(?:[0-9A-Fa-f]{2})+")

#: Nesting that a key needs at most.
MAX_DEPTH = 12


def decode64(text: str, url: bool = False) -> bytes | None:
    """Bytes of base64 text (padding optional), None where it is none."""
    body = text.rstrip("=")
    if len(body) % 4 == 1:
        return None
    try:
        raw = body + "=" * (-len(body) % 4)
        return base64.b64decode(raw, altchars=b"-_" if url else None, validate=True)
    except (binascii.Error, ValueError):
        return None


def der_items(data: bytes, depth: int = 0) -> int | None:
    """Number of DER items in `data` if nested lengths fit exactly, else None."""
    at, count = 0, 0
    while at < len(data):
        if at + 2 > len(data) or depth > MAX_DEPTH:
            return None
        tag, size = data[at], data[at + 1]
        at += 2
        if size == 0x80 or size > 0x84:
            return None
        if size > 0x80:
            n = size & 0x7F
            size = int.from_bytes(data[at : at + n], "big")
            at += n
        if at + size > len(data):
            return None
        if tag & 0x20:
            inner = der_items(data[at : at + size], depth + 1)
            if inner is None:
                return None
            count += inner
        at += size
        count += 1
    return count


def is_der_key(data: bytes) -> bool:
    """One DER SEQUENCE that fills the data and starts with a small INTEGER version, with more behind it."""
    if len(data) < 24 or data[0] != 0x30 or not (count := der_items(data)) or count < 3:
        return False
    head = 2 + (data[1] & 0x7F if data[1] & 0x80 else 0)
    return data[head : head + 2] == b"\x02\x01" and data[head + 2] <= 3


def der_size(data: bytes) -> int | None:
    """Bytes of the DER item that `data` starts with, its head included."""
    if len(data) < 2 or data[1] == 0x80 or data[1] > 0x84:
        return None
    n = data[1] & 0x7F if data[1] & 0x80 else 0
    return 2 + n + (int.from_bytes(data[2 : 2 + n], "big") if n else data[1])


def is_encrypted_key(data: bytes) -> bool:
    """PKCS#8: one DER SEQUENCE of a SEQUENCE (the algorithm) and an OCTET STRING."""
    if len(data) < 24 or data[0] != 0x30 or der_size(data) != len(data) or not der_items(data):
        return False
    inner = data[2 + (data[1] & 0x7F if data[1] & 0x80 else 0) :]
    if inner[0] != 0x30:
        return False
    rest = inner[der_size(inner) :]
    return rest[:1] == b"\x04" and der_size(rest) == len(rest)


def is_openpgp_key(data: bytes) -> bool:
    """OpenPGP packets that fill the data, first a secret key or subkey of a known version."""
    at = 0
    while at < len(data):
        head, start = data[at], at
        if head & 0xC0 == 0xC0:
            tag, first = head & 0x3F, data[at + 1] if at + 1 < len(data) else 224
            if 224 <= first < 255:
                return False
            n = 1 if first < 192 else 2 if first < 224 else 5
            size = first if n == 1 else ((first - 192) << 8) + int.from_bytes(data[at + 2 : at + 3], "big") + 192 if n == 2 else int.from_bytes(data[at + 2 : at + 6], "big")
        elif head & 0x80 and head & 3 < 3:
            tag, n = head >> 2 & 0xF, 1 << (head & 3)
            size = int.from_bytes(data[at + 1 : at + 1 + n], "big")
        else:
            return False
        at += 1 + n + size
        if at > len(data) or start == 0 and (tag not in (5, 7) or size < 6 or not 2 <= data[1 + n] <= 6):
            return False
    return at > 0


def is_openssh_key(data: bytes) -> bool:
    """The OpenSSH magic, then cipher, kdf and options as strings with nested lengths that fit."""
    magic = b"openssh-key-v1\0"
    if not data.startswith(magic):
        return False
    at = len(magic)
    for _ in range(3):
        if at + 4 > len(data):
            return False
        at += 4 + int.from_bytes(data[at : at + 4], "big")
    return at + 4 <= len(data)


def is_key(data: bytes | None) -> bool:
    return data is not None and (is_der_key(data) or is_openssh_key(data))


def is_jwt(token: str) -> bool:
    head, body, _ = token.split(".", 2)
    try:
        parsed = [json.loads(decode64(x, url=True) or b"") for x in (head, body)]
    except (ValueError, RecursionError):
        return False
    return all(isinstance(x, dict) for x in parsed) and isinstance(parsed[0].get("alg"), str)


def is_pem(body: str, label: str = "", block: bool = False) -> bool:
    if block:
        lines = [x.strip() for x in body.split("\n")]
        data = decode64("".join(x for x in lines if ":" not in x and not x.startswith("=")))
        return data is not None and is_openpgp_key(data)
    if locked := LOCKED.match(body):
        data = decode64(re.sub(r"\s+", "", body[locked.end() :]))
        return data is not None and len(data) >= 16 and len(data) % 8 == 0
    data = decode64(re.sub(r"\s+", "", body))
    return is_key(data) or "ENCRYPTED" in label and data is not None and is_encrypted_key(data)


def wrapped_key(text: str, m: re.Match) -> int | None:
    """Where a key ends that begins in the line `m` and goes on in lines no longer than it."""
    if m[0].endswith("="):
        return None
    decode, chars = (bytes.fromhex, 2) if HEX_KEY.fullmatch(m[0]) else (decode64, 4 / 3)
    head = decode(m[0][:40]) or b""
    ssh = head.startswith(b"openssh-key-v1\0")
    if not ssh and (head[:1] != b"\x30" or b"\x02\x01" not in head[2:8]):
        return None
    least = 0 if ssh else math.ceil(der_size(head) * chars) if der_size(head) else math.inf
    parts, ends, at = [m[0]], [m.end()], m.end()
    while len(parts[-1]) == len(m[0]) and (ssh or len(parts) * len(m[0]) < least) and (line := LINE.match(text, at)) and len(line[1]) <= len(m[0]):
        at = line.end()
        parts.append(line[1])
        ends.append(at)
    for n in (len(parts), len(parts) - 1):
        if n > 1 and _is_key_text("".join(parts[:n])):
            return ends[n - 1]
    return None


def _is_key_text(run: str) -> bool:
    return is_key(bytes.fromhex(run) if HEX_KEY.fullmatch(run) else decode64(run))


def is_basic(m: re.Match) -> bool:
    """Base64 of printable text with a colon, or a user and password, rightly escaped, before a host."""
    if m[1] is None:
        host = HOST.match(m.string, m.end())
        return host is not None and int(host[1] or 0) <= 65535 and not ESCAPE.search(m[2]) and not ESCAPE.search(m[3])
    raw = decode64(m[1])
    return raw is not None and b":" in raw and all(32 <= c < 127 for c in raw)


def pem_blocks(text: str) -> list[tuple[int, int, int]]:
    """Spans of confirmed blocks: each END line is paired with the last BEGIN line before it, of the same label, so every body is read once."""
    out, begin = [], None
    for m in FRAME.finditer(text):
        if m[1] == "BEGIN":
            begin = m
            continue
        if begin is not None and (begin[2], begin[3]) == (m[2], m[3]):
            body = text[begin.end() : m.start()]
            if BODY.fullmatch(body) and is_pem(body, m[2], bool(m[3])):
                out.append((begin.start(), 3, m.end()))
        begin = None
    return out


def scan(text: str | None) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the secrets of a text, in order."""
    if not text:
        return []
    low, out = text.lower(), []
    if any(w in low for w in NAMES):
        out += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[1]) >= 12]
    if "AKIA" in text:
        out += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text)]
    out += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    blocks = pem_blocks(text) if "PRIVATE KEY" in text else []
    out += blocks
    done, at = 0, 0
    for m in BARE.finditer(text):
        while at < len(blocks) and blocks[at][2] <= m.start():
            at += 1
        if m.start() < done or at < len(blocks) and blocks[at][0] <= m.start():
            continue
        if end := m.end() if _is_key_text(m[0]) else wrapped_key(text, m):
            out.append((m.start(), 4, end))
            done = end
    if "eyJ" in text:
        out += [(m.start(), 5, m.end()) for m in JWT.finditer(text) if is_jwt(m[0])]
    if "asic " in text or "://" in text:
        out += [(m.start(), 6, m.end()) for m in BASIC.finditer(text) if is_basic(m)]
    return sorted(out)


def render(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in spans)


def find_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row for each row of `docs`: id, spans array<struct<start,stop,kind,secret>>."""
    kind = dict(docs.dtypes)[id_col]

    def batch(b: pa.RecordBatch) -> pa.RecordBatch:
        rows = []
        for text in b.column(1).to_pylist():
            rows.append([{"start": s, "stop": e, "kind": KINDS[k], "secret": text[s:e]} for s, k, e in scan(text)])
        spans = pa.array(rows, pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64()), ("kind", pa.string()), ("secret", pa.string())])))
        return pa.RecordBatch.from_arrays([b.column(0), spans], ["doc_id", "spans"])

    return map_arrow(docs.select(id_col, text_col), batch, f"doc_id {kind}, spans array<struct<start:bigint,stop:bigint,kind:string,secret:string>>")


def op4_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_secrets(table(spark, sf_dir, "documents"))

    def batch(b: pa.RecordBatch) -> pa.RecordBatch:
        counts, digests, joined = [[], [], []], [], []
        for spans in b.column(1).to_pylist():
            keyed = [(x["start"], KINDS.index(x["kind"]), x["stop"]) for x in spans]
            base = [x for x in keyed if x[1] < len(BASE_KINDS)]
            for k in range(len(BASE_KINDS)):
                counts[k].append(sum(x[1] == k for x in base))
            digests.append(hashlib.sha256(render(base).encode()).hexdigest())
            joined.append(render(keyed))
        columns = [b.column(0), *[pa.array(c, pa.int64()) for c in counts], pa.array(digests, pa.string()), pa.array(joined, pa.string())]
        return pa.RecordBatch.from_arrays(columns, ["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"])

    kind = dict(found.dtypes)["doc_id"]
    return map_arrow(found, batch, f"doc_id {kind}, n_assign bigint, n_access bigint, n_hex bigint, base_sha256 string, spans string")


def secret_base_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The base kinds alone, which SQL can express; the structural ones can't be."""
    return op4_secret_scan(spark, sf_dir).drop("spans")


def _oracle() -> str:
    patterns = {
        "assign": r"""(?:(?i:password|passwd|secret|token|api_?key))["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)""",
        "access": r"(AKIA[A-Z0-9]+)",
        "hex": r"([0-9a-f]+)",
    }
    least = {"assign": 12, "access": 18, "hex": 16}
    every = " UNION ALL ".join(
        f"""
      SELECT doc_id, {k} AS k, '{kind}' AS kind, start, start + length(hit) AS stop
      FROM (
        SELECT doc_id, hits[i] AS hit, parts[i] AS part,
               list_sum(list_transform(gaps[1 : i], lambda x: length(x))) + coalesce(list_sum(list_transform(hits[1 : i - 1], lambda x: length(x))), 0) AS start
        FROM (
          SELECT doc_id, hits, parts, gaps, unnest(list_filter(range(1, len(hits) + 1), lambda j: length(parts[j]) >= {least[kind]})) AS i
          FROM (SELECT doc_id, regexp_extract_all(t, '{p}') AS hits, regexp_extract_all(t, '{p}', 1) AS parts, string_split_regex(t, '{p.replace("(AKIA", "(?:AKIA").replace("([", "(?:[")}') AS gaps FROM d)))"""
        for k, (kind, p) in enumerate(patterns.items())
    )
    counts = ", ".join(f"count(*) FILTER (kind = '{kind}') AS n_{kind}" for kind in patterns)
    return f"""
    WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
    found AS (
      SELECT doc_id, {counts}, string_agg(kind || ':' || start || ':' || stop, ',' ORDER BY start, k) AS base
      FROM ({every}) GROUP BY doc_id)
    SELECT d.doc_id, {", ".join(f"coalesce(n_{kind}, 0) AS n_{kind}" for kind in patterns)}, sha256(coalesce(base, '')) AS base_sha256
    FROM d LEFT JOIN found ON found.doc_id = d.doc_id"""


QUERIES = {"op4_secret_scan": op4_secret_scan, "secret_base_spans": secret_base_spans}
ORACLES = {"secret_base_spans": _oracle()}
