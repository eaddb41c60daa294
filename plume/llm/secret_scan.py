"""Secret scan with structural confirmation.

Base patterns find assignments, access-key ids and long hex runs.  On top,
base64 (plain or url-safe) and hex candidates are decoded and reported as key
material only if their structure holds: DER (every nested length fits, outermost
SEQUENCE spans all bytes), OpenSSH private-key blobs (magic, then length-prefixed
fields), PEM armour around such bytes, itself in plain, base64 or hex, and signed
tokens whose header decodes to a JSON object that names an algorithm.  A key may
be wrapped, in armour or bare: its own lengths say how many of the lines that
follow belong to it, and a line break may be written as an escape (JSON, env
files).  Armour with header lines that say it is encrypted holds whole cipher
blocks instead of a structure.

What is public is no secret and is not reported: the version and algorithm
fields tell private keys (a version of 0 or 1, or an encryption algorithm, first)
from public ones and certificates.

Each text is scanned whole by one Arrow pass, without any shuffle.  Defined
results: NULL text is empty; empty texts have no spans; every input row gives
one row; extra columns are not read.  Positions are code points, end exclusive.
"""

from __future__ import annotations

import base64
import binascii
import hashlib
import json
import re

import pyarrow as pa
from pyspark.sql import DataFrame

from .tables import small_batches

#: Fixed values of the base patterns (ASCII letter case only).
ASSIGN = re.compile(
    r"""(?ai:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"(?<![0-9a-f])[0-9a-f]{32,}")
KINDS = ("assign", "access", "hex", "pem", "jwt", "der", "ssh")
LEAST = {"assign": 8, "access": 16}

#: First lines of candidates; a line break written as an escape may stand right before them.
BASE64_RUN = re.compile(r"(?:(?<![A-Za-z0-9+/])|(?<=\\[nrt]))[Mb][A-Za-z0-9+/]{15,}={0,2}")
ANY_HEX = re.compile(r"(?<![0-9A-Fa-f])(?:[0-9a-f]{16,}|[0-9A-F]{16,})(?![0-9A-Fa-f])")
#: What wrapped lines have between them, and the lines after the first.
BREAK = re.compile(r"(?:\s|\\++(?:[nrt]|(?=\s)))++")
BASE64_LINE, LOWER_HEX, UPPER_HEX = (re.compile(x) for x in (
    r"[A-Za-z0-9+/]+={0,2}", r"[0-9a-f]+(?![0-9A-Fa-f])", r"[0-9A-F]+(?![0-9A-Fa-f])"))
LEAST_BASE64, LEAST_HEX = 40, 48  #: characters of a whole candidate
#: A token's header is an object: '{', then '"' or white space.
TOKEN = re.compile(r"(?<![A-Za-z0-9_-])(e[wy][A-Za-z0-9_-]+)\.([A-Za-z0-9_-]+)\.([A-Za-z0-9_-]*)(?![A-Za-z0-9_-])")
PEM = re.compile(r"-----BEGIN ([A-Z0-9 ]*PRIVATE KEY)-----"
                 r"((?:(?:\s|\\++(?:[nrt]|(?=\s)))*+[A-Za-z][A-Za-z0-9-]*: [A-Za-z0-9,:; /.-]++)*+)"
                 r"([A-Za-z0-9+/=\s]*+(?:\\++(?:[nrt]|(?=\s))[A-Za-z0-9+/=\s]*+)*+)-----END \1-----")
#: First lines of armour that is itself encoded: "-----BEGIN " in base64 and in hex.
BASE64_PEM = re.compile(r"(?:(?<![A-Za-z0-9+/])|(?<=\\[nrt]))LS0tLS1CRUdJTi[A-Za-z0-9+/]+={0,2}")
HEX_PEM = re.compile(r"(?<![0-9A-Fa-f])(?:2d2d2d2d2d424547494e20[0-9a-f]+|2D2D2D2D2D424547494E20[0-9A-F]+)")
#: Base64 with the url-safe letters; without any it is plain base64.
URL_RUN = re.compile(r"(?<![A-Za-z0-9_-])[Mb](?=[A-Za-z0-9]*[_-])[A-Za-z0-9_-]{39,}(?![A-Za-z0-9_-])")
CIPHER_BLOCK = 8

SCHEMA = ("doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string, "
          "n_confirmed long")


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind index, end) of the base patterns, failing matches dropped."""
    out = []
    if ":" in text or "=" in text:  # every assignment holds one of them
        out += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= LEAST["assign"]]
    if "AKIA" in text:
        out += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= LEAST["access"]]
    out += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return out


def der_fits(data: bytes, start: int = 0, end: int | None = None, depth: int = 0) -> bool:
    """Do the tags and lengths in data[start:end] nest and end exactly?"""
    end = len(data) if end is None else end
    if depth > 12:
        return False
    while start < end:
        if end - start < 2:
            return False
        tag, n, at = data[start], data[start + 1], start + 2
        if n & 0x80:
            k = n & 0x7F
            if not 1 <= k <= 4 or at + k > end:
                return False
            n = int.from_bytes(data[at:at + k], "big")
            at += k
        if at + n > end:
            return False
        if tag & 0x20 and not der_fits(data, at, at + n, depth + 1):
            return False
        start = at + n
    return True


def fields_of(data: bytes, most: int = 4) -> list[tuple[int, bytes]]:
    """(tag, contents) of the first fields inside data's outermost SEQUENCE; its lengths are known to fit."""
    out, at = [], 2 + (data[1] & 0x7F if data[1] & 0x80 else 0)
    while at < len(data) and len(out) < most:
        tag, n, at = data[at], data[at + 1], at + 2
        if n & 0x80:
            k = n & 0x7F
            n, at = int.from_bytes(data[at:at + k], "big"), at + k
        out.append((tag, data[at:at + n]))
        at += n
    return out


def is_der_key(data: bytes) -> bool:
    """A SEQUENCE over all bytes with the first fields of a private key.

    A version 0 or 1 and then a number, an algorithm or the key (RSA, DSA, EC,
    PKCS #8), or an algorithm with parameters and then the encrypted key.  A
    public key or a certificate starts with a large number, or has a BIT STRING or
    a SEQUENCE after its algorithm or body.
    """
    if len(data) < 24 or data[0] != 0x30 or data[1] not in (*range(22, 128), 0x81, 0x82, 0x83) or not der_fits(data):
        return False
    fields = fields_of(data)
    if len(fields) < 2:
        return False
    (first, value), (second, _) = fields[:2]
    if first == 0x02:
        return value in (b"\0", b"\1") and (second in (0x30, 0x04) or (second == 0x02 and len(fields) > 3))
    return first == 0x30 and value[:1] == b"\x06" and second == 0x04 and len(fields) == 2


def is_ssh_key(data: bytes) -> bool:
    """OpenSSH: the private-key magic, then length-prefixed fields."""
    if not data.startswith(b"openssh-key-v1\0"):
        return False
    at, fields = 15, 0
    while fields < 3 and at + 4 <= len(data):
        at += 4 + int.from_bytes(data[at:at + 4], "big")
        fields += 1
    return fields == 3 and at <= len(data)


def key_kind(data: bytes) -> int | None:
    return 5 if is_der_key(data) else 6 if is_ssh_key(data) else None


def decode64(run: str, url: bool = False) -> bytes | None:
    body = run.rstrip("=")
    if len(body) % 4 == 1:
        return None
    try:
        pad = body + "=" * (-len(body) % 4)
        return base64.urlsafe_b64decode(pad) if url else base64.b64decode(pad, validate=True)
    except (binascii.Error, ValueError):
        return None


def decode_hex(run: str) -> bytes | None:
    return bytes.fromhex(run) if len(run) % 2 == 0 else None


def key_size(data: bytes) -> int:
    """Bytes of the key that data starts, as far as its lengths tell (beyond data: at least so many); 0: no key."""
    if data[:1] == b"\x30" and len(data) > 6:
        k = data[1] & 0x7F if data[1] & 0x80 else 0
        if data[1] not in (*range(22, 128), 0x81, 0x82, 0x83) or data[2 + k] not in (0x02, 0x30):
            return 0
        return 2 + k + (int.from_bytes(data[2:2 + k], "big") if k else data[1])
    if not data.startswith(b"openssh-k"):
        return 0
    at, fields, most = 15, 0, 4  # cipher, kdf, its options; number of keys; the keys and the private part
    while fields < most:
        if at + 4 > len(data):
            return at + 4
        n = int.from_bytes(data[at:at + 4], "big")
        at, fields = at + 4, fields + 1
        if fields == 4:
            most = 5 + n
        else:
            at += n
            if at > len(data):
                return at
    return at


def whole_key(text: str, m: re.Match, line: re.Pattern, decode, per: int, least: int) -> tuple[int, int] | None:
    """(kind index, end) of the key that m starts, alone or with the lines after it.

    ``per`` characters are whole bytes.  The key's own lengths say how many lines belong to it.
    """
    run, end = m[0], m.end()

    def held(n: int) -> int:
        return n * (3 if per == 4 else 1) // per
    while not run.endswith("="):
        need = key_size(decode(run[:len(run) // per * per]))
        if need <= held(len(run)) or need > held(len(text) - m.start()):
            break
        lines, size, to = [run], len(run), end
        while held(size) < need and not lines[-1].endswith("=") and (gap := BREAK.match(text, to)) \
                and (more := line.match(text, gap.end())):
            lines.append(more[0])
            size, to = size + len(more[0].rstrip("=")), more.end()
        if held(size) < need:
            break
        run, end = "".join(lines), to
    for body, to in ((run, end), (m[0], m.end())):
        if len(body.rstrip("=")) >= least and (data := decode(body)) is not None and (kind := key_kind(data)) is not None:
            return kind, to
    return None


def is_armour(m: re.Match) -> bool:
    """Does PEM armour hold a private key, or say that it is encrypted and hold cipher blocks?"""
    data = decode64(BREAK.sub("", m[3]))
    if data is None:
        return False
    return bool(data) and len(data) % CIPHER_BLOCK == 0 if "ENCRYPTED" in m[2] else key_kind(data) is not None


def encoded_armour(text: str, m: re.Match, line: re.Pattern, decode) -> int | None:
    """The end of encoded PEM armour that m starts, alone or with the lines after it."""
    ends, parts = [m.end()], [m[0]]
    while not parts[-1].endswith("=") and (gap := BREAK.match(text, ends[-1])) and (more := line.match(text, gap.end())):
        parts.append(more[0])
        ends.append(more.end())
    per, of = (4, 3) if decode is decode64 else (2, 1)
    run = "".join(parts)
    data = decode(run.rstrip("=")) if len(run.rstrip("=")) % per != 1 else decode(run.rstrip("=")[:-1])
    found = PEM.match(data.decode("latin-1")) if data else None
    if found is None or not is_armour(found):
        return None
    need, size = -(-found.end() * per // of), 0  # letters that hold the armour
    for part, end in zip(parts, ends):
        size += len(part)
        if size >= need:
            return end
    return ends[-1]


def confirmed_spans(text: str) -> list[tuple[int, int, int]]:
    """Spans whose decoded bytes have the structure of a private key or a signed token."""
    out = [(m.start(), 3, m.end()) for m in (PEM.finditer(text) if "PRIVATE KEY-----" in text else ()) if is_armour(m)]
    armour = [(s, e) for s, _, e in out]
    for pattern, line, decode in ((BASE64_PEM, BASE64_LINE, decode64), (HEX_PEM, re.compile(r"[0-9A-Fa-f]+"), decode_hex)):
        for m in pattern.finditer(text):
            end = encoded_armour(text, m, line, decode)
            if end is not None:
                out.append((m.start(), 3, end))
                armour.append((m.start(), end))
    for m in TOKEN.finditer(text) if "ey" in text or "ew" in text else ():
        head = decode64(m[1], url=True)
        try:
            head = json.loads(head) if head else None
        except (ValueError, RecursionError):
            head = None
        if isinstance(head, dict) and isinstance(head.get("alg"), str):
            out.append((m.start(), 4, m.end()))
    # a DER sequence starts with 0x30 ('M'), an OpenSSH blob with its magic ('b')
    first = [(m, BASE64_LINE, decode64, 4, LEAST_BASE64) for m in BASE64_RUN.finditer(text)]
    first += [(m, UPPER_HEX if m[0].isupper() else LOWER_HEX, decode_hex, 2, LEAST_HEX) for m in ANY_HEX.finditer(text)
              if m[0].startswith(("30", "6f70", "6F70"))]
    for m, *how in first:
        found = whole_key(text, m, *how)
        # wrapped lines in armour are the armour's key
        if found and (found[1] == m.end() or not any(s <= m.start() and found[1] <= e for s, e in armour)):
            out.append((m.start(), *found))
    known = {s for s, _, _ in out}
    for m in URL_RUN.finditer(text):
        data = decode64(m[0], url=True) if m.start() not in known else None
        if data is not None and (kind := key_kind(data)) is not None:
            out.append((m.start(), kind, m.end()))
    return out


def joined(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in sorted(spans))


def scan(text: str | None) -> tuple[list, list]:
    text = text or ""
    return base_spans(text), confirmed_spans(text)


def scan_batches(batches):
    for batch in batches:
        rows = []
        for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
            base, more = scan(text.as_py())
            by = [sum(k == i for _, k, _ in base) for i in range(3)]
            rows.append((doc_id, *by, hashlib.sha256(joined(base).encode()).hexdigest(),
                         joined(base + more), len(more)))
        names = ["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans", "n_confirmed"]
        types = [pa.int64()] * 4 + [pa.string()] * 2 + [pa.int64()]
        yield pa.RecordBatch.from_arrays(
            [pa.array([r[i] for r in rows], t) for i, t in enumerate(types)], names=names)


def secret_scan(docs: DataFrame) -> DataFrame:
    """One row per document: counts, the digest of the base spans, and all spans."""
    small_batches(docs.sparkSession)
    return docs.select("doc_id", docs["text"].cast("string")).mapInArrow(scan_batches, SCHEMA)
