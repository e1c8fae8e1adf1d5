"""Secrets in texts: patterns first, then what decodes to the structure of a key or of a signed token.

A pattern alone reports what looks like a secret (`assign`, `access`, `hex`). The structural kinds report only what was
decoded and parsed to its end: base64 or hex whose bytes are the nested lengths of a private key in DER (each element fills
the one that holds it exactly, and the elements are those of PKCS#1, PKCS#8, encrypted PKCS#8, SEC1 or DSA), the length-prefixed
fields of an OpenSSH private key, and three-part tokens whose header is a JSON object with an algorithm and whose payload
is one as well. Where a key ends in the text follows from its own lengths, so wrapped lines and text behind it are told apart.
"""

from __future__ import annotations

import base64
import binascii
import json
import re
import struct
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from .common import extended

BASE = ["assign", "access", "hex"]                              # by pattern; fixed order of equal starts
CONFIRMED = ["key64", "keyhex", "ssh", "jws", "jwe"]            # by structure
KINDS = BASE + CONFIRMED

ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII)
NAMED = ("password", "passwd", "secret", "token", "apikey", "api_key")
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")      # the runs of 24 or more: a run is found where it starts
LEAST_VALUE, LEAST_ACCESS = 6, 20

# Base64 of a DER sequence starts with M, hex with 30; an OpenSSH key with its magic. Lines may be wrapped, also as \n in a literal.
DER64 = re.compile(r"(?<![A-Za-z0-9+/_])M[A-Za-z0-9+/_-]{15,}")
DERHEX = re.compile(r"(?<![0-9A-Fa-f])30[0-9A-Fa-f]{30,}")
SSH_MAGIC = b"openssh-key-v1\0"
SSH64 = re.compile(r"(?<![A-Za-z0-9+/_])b3BlbnNzaC1rZXktdjEA[A-Za-z0-9+/_-]{12,}")
TOKEN = re.compile(r"(?<![A-Za-z0-9_.-])ey[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]*(?:\.[A-Za-z0-9_-]*){1,3}")
BREAK = re.compile(r"(?:\r?\n|\\r?\\n|\\n)[\x20\t]*")
PLAIN64 = re.compile(r"[A-Za-z0-9+/_-]+")
SEQUENCE, INTEGER, OCTETS, OID = 0x30, 0x02, 0x04, 0x06


class Malformed(ValueError):
    """Bytes that are not what their lengths say."""


def unbase64(text: str) -> bytes:
    """The bytes of base64 of either alphabet, padded or not."""
    text = text.rstrip("=").replace("-", "+").replace("_", "/")
    try:
        return base64.b64decode(text + "=" * (-len(text) % 4), validate=True)
    except binascii.Error as e:
        raise Malformed from e


def header(raw: bytes, at: int) -> tuple[int, int, int]:
    """Tag of the DER element at a place, where its content starts and where it ends by its own length."""
    if at + 2 > len(raw):
        raise Malformed
    tag, n = raw[at], raw[at + 1]
    if n < 0x80:
        return tag, at + 2, at + 2 + n
    size = n & 0x7F
    if not 1 <= size <= 4 or at + 2 + size > len(raw):
        raise Malformed
    n = int.from_bytes(raw[at + 2:at + 2 + size])
    if n < 0x80 or n >> (8 * (size - 1)) == 0:     # DER has the shortest form only
        raise Malformed
    return tag, at + 2 + size, at + 2 + size + n


def elements(raw: bytes, at: int, end: int) -> list[tuple[int, int, int]]:
    """The elements that fill raw[at:end] exactly."""
    out = []
    while at < end:
        tag, start, stop = header(raw, at)
        if stop > end:
            raise Malformed
        out.append((tag, start, stop))
        at = stop
    return out


def key_kind(raw: bytes) -> str:
    """Which private key a DER sequence is; Malformed if none, or if some length does not fit."""
    tag, start, end = header(raw, 0)
    if tag != SEQUENCE or end != len(raw):
        raise Malformed
    parts = elements(raw, start, end)
    tags = [t for t, _, _ in parts]
    number = lambda k: int.from_bytes(raw[parts[k][1]:parts[k][2]])
    inside = lambda k: elements(raw, *parts[k][1:])
    if tags[:1] == [INTEGER]:
        if tags[1:] == [INTEGER] * 8 and number(0) in (0, 1) and number(1).bit_length() >= 256 and number(2) > 1:
            if number(4) * number(5) != number(1):      # the modulus is the product of its primes
                raise Malformed
            return "rsa"
        if tags[1:] == [INTEGER] * 5 and number(0) == 0 and number(1).bit_length() >= 256:
            return "dsa"
        if tags[1:3] == [SEQUENCE, OCTETS] and number(0) in (0, 1) and all(t in (0xA0, 0xA1, 0x81) for t in tags[3:]):
            if inside(1)[:1] and inside(1)[0][0] == OID and parts[2][2] - parts[2][1] >= 16:
                return "pkcs8"
        if tags[1:2] == [OCTETS] and number(0) == 1 and 16 <= parts[1][2] - parts[1][1] <= 66 and all(t in (0xA0, 0xA1) for t in tags[2:]):
            for k in range(2, len(parts)):      # explicit tags hold one element each
                if len(inside(k)) != 1:
                    raise Malformed
            return "ec"
    if tags == [SEQUENCE, OCTETS] and len(inside(0)) == 2 and inside(0)[0][0] == OID and inside(0)[1][0] == SEQUENCE:
        elements(raw, *inside(0)[1][1:])
        if parts[1][2] - parts[1][1] >= 32:
            return "pkcs8-encrypted"
    raise Malformed


def ssh_kind(raw: bytes) -> tuple[str, int]:
    """Cipher of an OpenSSH private key and how many bytes it has; Malformed if its fields do not fit."""
    at = len(SSH_MAGIC)

    def field() -> bytes:
        nonlocal at
        if at + 4 > len(raw):
            raise Malformed
        n = struct.unpack_from(">I", raw, at)[0]
        if at + 4 + n > len(raw):
            raise Malformed
        at += 4 + n
        return raw[at - n:at]

    if not raw.startswith(SSH_MAGIC):
        raise Malformed
    cipher, kdf, options = field(), field(), field()
    if at + 4 > len(raw) or not cipher or not kdf or (cipher == b"none") != (kdf == b"none") or bool(options) != (kdf != b"none"):
        raise Malformed
    keys = struct.unpack_from(">I", raw, at)[0]
    at += 4
    if not 1 <= keys <= 16:
        raise Malformed
    for _ in range(keys):
        field()
    private = field()
    if len(private) % 8 or not private or (cipher == b"none" and private[:4] != private[4:8]):     # two equal check numbers come first
        raise Malformed
    return cipher.decode("ascii", "replace"), at


def decoded_run(text: str, start: int, need: int) -> tuple[bytes, int]:
    """The first bytes of base64 from a place in the text, over wrapped lines: at least `need` if they are there, and where they end."""
    out, at, chars = [], start, 0
    most = -(-need * 4 // 3)
    while chars < most:
        line = PLAIN64.match(text, at)
        if not line:
            break
        stop = min(line.end(), at + most - chars)
        out.append(text[at:stop])
        chars, at = chars + stop - at, stop
        if stop < line.end() or chars >= most:
            break
        gap = BREAK.match(text, at)
        if not gap:
            break
        at = gap.end()
    return unbase64("".join(out)) if chars % 4 != 1 else b"", at


def closed(text: str, at: int) -> bool:
    """Whether base64 that ends at a place really ends there: no letter of it follows on the line."""
    rest = PLAIN64.match(text, at)
    return rest is None or not rest.group().strip("-")


def padded(text: str, at: int, n: int) -> int:
    """Where n bytes of base64 end that have their last letter before a place: behind their padding, if it is there."""
    while n % 3 and at < len(text) and text[at] == "=" and (n % 3 == 1 or text[at - 1] != "="):
        at += 1
        if text[at - 2:at] == "==":
            break
    return at


def keys64(text: str) -> Iterator[tuple[str, int, int, str]]:
    if "M" in text:
        for m in DER64.finditer(text):
            try:
                head = unbase64(text[m.start():m.start() + 12])
                _, _, n = header(head, 0)
                raw, end = decoded_run(text, m.start(), n)
                if len(raw) >= n and closed(text, end):
                    kind = key_kind(raw[:n])
                    yield "key64", m.start(), padded(text, end, n), kind
            except Malformed:
                continue
    if "b3BlbnNzaC1rZXktdjEA" in text:
        for m in SSH64.finditer(text):
            try:
                size = 256
                while True:     # the length is known only at the last field
                    raw, _ = decoded_run(text, m.start(), size)
                    try:
                        cipher, n = ssh_kind(raw)
                        break
                    except Malformed:
                        if len(raw) < size:
                            raise
                        size *= 4
                raw, end = decoded_run(text, m.start(), n)
                if len(raw) >= n and closed(text, end):
                    yield "ssh", m.start(), padded(text, end, n), cipher
            except Malformed:
                continue


def keyshex(text: str) -> Iterator[tuple[str, int, int, str]]:
    for m in DERHEX.finditer(text):
        try:
            raw = bytes.fromhex(m.group()[:len(m.group()) // 2 * 2])
            _, _, n = header(raw, 0)
            if n == len(raw) and len(m.group()) % 2 == 0:
                yield "keyhex", m.start(), m.end(), key_kind(raw)
        except Malformed:
            continue


def tokens(text: str) -> Iterator[tuple[str, int, int, str]]:
    """Tokens of three parts (signed) or five (encrypted) by their headers."""
    if "ey" not in text:
        return
    for m in TOKEN.finditer(text):
        try:
            parts = m.group().split(".")
            head = json.loads(unbase64(parts[0]))
            if not isinstance(head, dict) or not isinstance(head.get("alg"), str):
                continue
            if "enc" in head:
                if len(parts) == 5 and all(parts[2:]) and unbase64(parts[3]):
                    yield "jwe", m.start(), m.start() + len(".".join(parts)), head["alg"]
                continue
            # What follows the signature behind a further dot is text.
            signature = parts[2] if len(parts) > 2 else ""
            if head["alg"].lower() == "none" and signature or head["alg"].lower() != "none" and len(unbase64(signature)) < 16:
                continue
            if isinstance(json.loads(unbase64(parts[1])), dict):
                yield "jws", m.start(), m.start() + len(".".join(parts[:3])), head["alg"]
        except (Malformed, ValueError, RecursionError):
            continue


def found(text: str) -> list[tuple[str, int, int, str]]:
    """(kind, start, end, detail) of all spans, in code points, by start and then kind."""
    out: list[tuple[str, int, int, str]] = []
    low = text.lower()
    if any(name in low for name in NAMED):
        out += [("assign", m.start(), m.end(), m[1].lower()) for m in ASSIGN.finditer(text) if len(m[2]) >= LEAST_VALUE]
    if "AKIA" in text:
        out += [("access", m.start(), m.end(), "AKIA") for m in ACCESS.finditer(text) if m.end() - m.start() >= LEAST_ACCESS]
    out += [("hex", m.start(), m.end(), "") for m in HEX.finditer(text)]
    out += [*keys64(text), *keyshex(text), *tokens(text)]
    return sorted(out, key=lambda s: (s[1], KINDS.index(s[0])))


def scan(docs: DataFrame, keep: list[str]) -> DataFrame:
    """The columns `keep` of each row with `secrets`: array of (kind, start, stop, value, detail), by start and then in the order of KINDS.

    Text null or empty: an empty array. The whole text is read, in one piece, so no span is cut. Repeated rows are answered each;
    an empty table gives an empty one; columns not named in `keep` are not looked at, whatever they are called.
    """
    kind = "secrets array<struct<kind:string,start:int,stop:int,value:string,detail:string>>"
    schema = extended(docs.select(*keep).schema, kind)
    row = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("stop", pa.int32()), ("value", pa.string()), ("detail", pa.string())]))

    def tag(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for cell in batch.column(batch.num_columns - 1):
                text = cell.as_py() or ""
                rows.append([{"kind": k, "start": a, "stop": b, "value": text[a:b], "detail": d} for k, a, b, d in found(text)])
            rest = [batch.column(i) for i in range(batch.num_columns - 1)]
            yield pa.RecordBatch.from_arrays([*rest, pa.array(rows, row)], names=schema.names)

    return docs.select(*keep, F.col("text").alias("_text")).mapInArrow(tag, schema)


def written(spans: Column) -> Column:
    """Spans as kind:start:end, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["stop"])), ",")


def digest(scanned: DataFrame, keep: list[str]) -> DataFrame:
    """One row per document: counts by pattern, a digest of the spans found by pattern, and all spans as text."""
    of = lambda *kinds: F.filter("secrets", lambda s: s["kind"].isin(*kinds))
    return scanned.select(*keep, *[F.size(of(k)).cast("long").alias(f"n_{k}") for k in BASE], F.sha2(written(of(*BASE)), 256).alias("base_sha256"),
                          written(F.col("secrets")).alias("spans"), F.size(of(*CONFIRMED)).cast("long").alias("n_confirmed"))
