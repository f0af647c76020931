"""Secrets in texts: patterns, and encoded keys and signed tokens confirmed by their structure.

Three kinds are patterns (``BASE``): an assignment to a name such as ``token``, an access
key id, and a long run of hex digits. Matches of a kind do not overlap and are taken from
the left; one that is too short is dropped after it has been matched, so it still
uses up its text.

The other kinds are candidates that are decoded, and reported only if what comes out holds
together:

* ``pem``: an armoured private key whose body is base64 of a key, or of an encrypted one
  whose headers say how; also an armoured key that is base64 encoded once more;
* ``jwt``: a signed token, whose first part is a JSON object naming an algorithm, whose
  second part is a JSON object, and whose signature has the length of that algorithm; or an
  encrypted one of five parts, whose header names the encryption too;
* ``der``: base64 (plain, URL-safe, wrapped over lines) or hex that begins like an ASN.1
  sequence: the length it states says where the key ends, every nested length has to
  fill its parent exactly, and the fields have to be those of a private key;
* ``ssh``: the same for a key with length-prefixed strings.

A null text counts as empty. Every row gives a row, repeats included; an empty table gives
an empty result; columns other than id and text are never looked at. Offsets count code
points. Each text is scanned whole: every pattern reads it once, and a candidate is read
as far as its own run or stated length goes.
"""

from __future__ import annotations

import base64
import binascii
import json
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, StringType, StructType

from daygrain.llm.common import table, text_or_empty

# The pattern of each base kind, the group whose length counts, and the least length.
BASE = {
    "assign": (
        re.compile(
            r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
            re.ASCII | re.IGNORECASE,
        ),
        2,
        6,
    ),
    "access": (re.compile(r"AKIA[A-Z0-9]+"), 0, 20),
    "hex": (re.compile(r"[0-9a-f]+"), 0, 24),
}
#: All kinds, in the order in which spans with one start are listed.
KINDS = (*BASE, "pem", "jwt", "der", "ssh")

#: Runs that are too short to count hold no longer ones, so these may be skipped while matching.
_FAST = {"hex": re.compile(r"[0-9a-f]{24,}"), "access": re.compile(r"AKIA[A-Z0-9]{16,}")}

_ARMOUR = re.compile(r"-----BEGIN ((?:[A-Z0-9]+ )*)PRIVATE KEY-----((?:(?!-----).)*)-----END \1PRIVATE KEY-----", re.DOTALL)
_ENCRYPTED = re.compile(r"\s*Proc-Type: ?4,ENCRYPTED\s+DEK-Info: ?[A-Z0-9-]+,([0-9A-Fa-f]+)\s+")
#: Base64 of an opening brace and of what may follow it.
_TOKEN = re.compile(
    r"e[w-z0-9_-](?<![A-Za-z0-9_-]..)[A-Za-z0-9_-]{8,}(?:\.[A-Za-z0-9_-]*){2,4}(?![A-Za-z0-9_-])"
)
#: Base64 of the first byte of an ASN.1 sequence, and the rest of the run.
_SEQUENCE64 = re.compile(r"M(?<![A-Za-z0-9+/_-].)[A-Za-z0-9+/_-]{31,}")
_SEQUENCE16 = re.compile(r"30(?<![0-9A-Fa-f]..)[0-9A-Fa-f]{46,}")
#: No key is longer. RSA keys of 16,384 bits take under 10,000 bytes.
KEY_BYTES = 1 << 16
_MAGIC = b"openssh-key-v1\0"
_SSH64 = re.compile(r"b3BlbnNzaC1rZXktdjE[A-Za-z0-9+/_-]+")
_SSH16 = re.compile(_MAGIC.hex() + r"[0-9A-Fa-f]+", re.IGNORECASE)
#: Base64 of the opening of an armoured key.
_ARMOUR64 = re.compile(r"LS0tLS1CRUdJTi[A-Za-z0-9+/_-]+={0,2}")
_LINE = re.compile(r"[A-Za-z0-9+/_-]+")
_LINE_END = re.compile(r"\r?\n(?=[A-Za-z0-9+/_-])")
_URL_SAFE = str.maketrans("-_", "+/")
#: Lengths in bytes of signatures. RSA signatures have the length of the key.
_SIGNATURES = {"HS256": {32}, "HS384": {48}, "HS512": {64}, "ES256": {64}, "ES384": {96}, "ES512": {132}, "EDDSA": {64, 114}}


# what is decoded


def from_base64(text: str) -> bytes | None:
    """Bytes of plain or URL-safe base64, with or without its padding; None if it is neither."""
    digits = text.translate(_URL_SAFE).rstrip("=")
    try:
        return base64.b64decode(digits + "=" * (-len(digits) % 4), validate=True)
    except (binascii.Error, ValueError):
        return None


def element(data: bytes, at: int, end: int) -> tuple[int, int, int] | None:
    """(tag, first, last) of the ASN.1 element at ``at`` in shortest definite form, if it ends by ``end``."""
    if at + 2 > end:
        return None
    tag, length, first = data[at], data[at + 1], at + 2
    if length > 0x80:
        n = length & 0x7F
        if n > 4 or first + n > end:
            return None
        length = int.from_bytes(data[first : first + n], "big")
        first += n
        if length < 0x80 or length >> 8 * (n - 1) == 0:
            return None
    elif length == 0x80:
        return None
    return (tag, first, first + length) if first + length <= end else None


def children(data: bytes, first: int, last: int) -> list[tuple[int, int, int]] | None:
    """The elements that fill ``first`` to ``last`` exactly, constructed ones filled themselves; else None."""
    found = []
    while first < last:
        child = element(data, first, last)
        if child is None or child[0] & 0x20 and children(data, *child[1:]) is None:
            return None
        found.append(child)
        first = child[2]
    return found


INTEGER, OCTETS, OID, SEQUENCE = 0x02, 0x04, 0x06, 0x30


def _sequence(data: bytes, first: int = 0, last: int | None = None) -> list[tuple[int, int, int]] | None:
    """Children of the one sequence that fills a stretch."""
    last = len(data) if last is None else last
    top = element(data, first, last)
    return children(data, *top[1:]) if top and top[0] == SEQUENCE and top[2] == last else None


def is_der_key(data: bytes) -> bool:
    """Whether all of ``data`` is a private key: RSA, DSA, elliptic curve, or their general or encrypted wrapping."""
    try:
        parts = _sequence(data)
    except RecursionError:  # nested deeper than any key
        return False
    if not parts:
        return False
    tags = [tag for tag, *_ in parts]
    numbers = [int.from_bytes(data[a:b], "big", signed=True) for tag, a, b in parts if tag == INTEGER]
    if tags == [INTEGER] * 9:  # version, modulus, two exponents, two primes, two exponents, coefficient
        return numbers[0] == 0 and min(numbers[1:]) > 0 and numbers[1] == numbers[4] * numbers[5]
    if tags == [INTEGER] * 6:  # version, two primes, generator, public and private key
        return numbers[0] == 0 and min(numbers[1:]) > 0 and (numbers[1] - 1) % numbers[2] == 0
    if tags[:3] == [INTEGER, SEQUENCE, OCTETS]:  # version, algorithm, key, attributes
        inside = children(data, *parts[1][1:])
        return numbers[0] in (0, 1) and set(tags[3:]) <= {0xA0, 0x81} and bool(inside) and inside[0][0] == OID
    if tags[:2] == [INTEGER, OCTETS]:  # version, key, curve, public key
        return numbers[0] == 1 and set(tags[2:]) <= {0xA0, 0xA1} and parts[1][2] - parts[1][1] >= 16
    if tags == [SEQUENCE, OCTETS]:  # how it is encrypted, and the result
        inside = children(data, *parts[0][1:])
        return bool(inside) and [t for t, *_ in inside] == [OID, SEQUENCE] and (parts[1][2] - parts[1][1]) % 8 == 0
    return False


def _strings(data: bytes, at: int, n: int) -> tuple[list[bytes], int] | None:
    """``n`` strings, each after its length in four bytes, and where they end."""
    found = []
    for _ in range(n):
        first = at + 4
        at = first + int.from_bytes(data[at:first], "big")
        if first > len(data) or at > len(data):
            return None
        found.append(data[first:at])
    return found, at


def _ssh_like(data: bytes) -> bool:
    """Whether a name of possible length follows the mark."""
    return data.startswith(_MAGIC) and 0 < int.from_bytes(data[len(_MAGIC) : len(_MAGIC) + 4], "big") <= 64


def ssh_key_end(data: bytes) -> int | None:
    """Where the length-prefixed key that ``data`` begins with ends, if it is one."""
    if not _ssh_like(data):
        return None
    head = _strings(data, len(_MAGIC), 3)
    if head is None:
        return None
    (cipher, derivation, _), at = head
    keys = int.from_bytes(data[at : at + 4], "big")
    if not 1 <= keys <= 64 or (cipher == b"none") != (derivation == b"none"):
        return None
    rest = _strings(data, at + 4, keys + 1)
    if rest is None or len(rest[0][-1]) % 8 or not rest[0][-1]:
        return None
    # What is not encrypted repeats one random number, by which a wrong password is noticed.
    if cipher == b"none" and rest[0][-1][:4] != rest[0][-1][4:8]:
        return None
    return rest[1]


def is_armoured_key(body: str) -> bool:
    sealed = _ENCRYPTED.match(body)
    data = from_base64("".join(body[sealed.end() if sealed else 0 :].split()))
    if not data:
        return False
    if sealed:
        return len(data) % 8 == 0 and len(sealed[1]) in (16, 32)
    return is_der_key(data) or ssh_key_end(data) == len(data)


def _object(part: str) -> dict | None:
    """The JSON object that base64 text stands for."""
    data = from_base64(part)
    try:
        value = json.loads(data.decode()) if data else None
    except (ValueError, RecursionError):
        return None
    return value if isinstance(value, dict) else None


def is_signed_token(token: str) -> bool:
    parts = token.split(".")
    header = _object(parts[0])
    algorithm = header.get("alg") if header else None
    if not isinstance(algorithm, str) or len(parts) not in (3, 5):
        return False
    if len(parts) == 5:
        return isinstance(header.get("enc"), str) and all(parts[2:])
    signature = from_base64(parts[2])
    if _object(parts[1]) is None or signature is None:
        return False
    if algorithm.lower() == "none":
        return not signature
    known = _SIGNATURES.get(algorithm.upper())
    return len(signature) in known if known else len(signature) >= 32


# where candidates lie


def _digits(text: str, at: int, wanted: int) -> tuple[str, int]:
    """Up to ``wanted`` base64 digits from ``at`` on, over line ends, and where they end."""
    found: list[str] = []
    while wanted > 0 and (line := _LINE.match(text, at, at + wanted)):
        found.append(line[0])
        at, wanted = line.end(), wanted - len(line[0])
        if not (end := _LINE_END.match(text, at)) or not wanted:
            break
        at = end.end()
    return "".join(found), at


def _padded(text: str, end: int, digits: int) -> int:
    for _ in range(-digits % 4):
        if text[end : end + 1] == "=":
            end += 1
    return end


def _stated_length(head: bytes) -> int:
    """Bytes that the element at the front says it takes, itself included; 0 if it says nothing."""
    if len(head) < 6 or head[0] != SEQUENCE:
        return 0
    if head[1] < 0x80:
        return head[1] + 2
    n = head[1] & 0x7F
    return int.from_bytes(head[2 : 2 + n], "big") + 2 + n if 1 <= n <= 4 else 0


def _der_spans(text: str) -> Iterator[tuple[int, int]]:
    done = 0
    for m in _SEQUENCE64.finditer(text):
        length = _stated_length(from_base64(m[0][:8]) or b"")
        if m.start() < done or not 16 <= length <= KEY_BYTES:
            continue
        wanted = -(-length * 8 // 6)
        digits, end = _digits(text, m.start(), wanted)
        if len(digits) == wanted and is_der_key(from_base64(digits) or b""):
            done = _padded(text, end, wanted)
            yield m.start(), done
    for m in _SEQUENCE16.finditer(text):
        length = _stated_length(bytes.fromhex(m[0][:12]))
        if 2 * length <= min(len(m[0]), 2 * KEY_BYTES) and is_der_key(bytes.fromhex(m[0][: 2 * length])):
            yield m.start(), m.start() + 2 * length


def _ssh_spans(text: str) -> Iterator[tuple[int, int]]:
    done = 0
    for m in _SSH64.finditer(text):
        if m.start() < done or not _ssh_like(from_base64(_digits(text, m.start(), 28)[0]) or b""):
            continue
        digits, _ = _digits(text, m.start(), KEY_BYTES * 4 // 3)
        whole = from_base64(digits[: len(digits) - (len(digits) % 4 == 1)]) or b""
        length = ssh_key_end(whole)
        if length:
            wanted = -(-length * 8 // 6)
            done = _padded(text, _digits(text, m.start(), wanted)[1], wanted)
            yield m.start(), done
    for m in _SSH16.finditer(text):
        length = ssh_key_end(bytes.fromhex(m[0][: min(len(m[0]) // 2, KEY_BYTES) * 2]))
        if length:
            yield m.start(), m.start() + 2 * length


def _pem_spans(text: str) -> Iterator[tuple[int, int]]:
    if "PRIVATE KEY-----" in text:
        for m in _ARMOUR.finditer(text):
            if is_armoured_key(m[2]):
                yield m.span()
    for m in _ARMOUR64.finditer(text):
        inner = (from_base64(m[0]) or b"").decode("ascii", "replace")
        if any(is_armoured_key(key[2]) for key in _ARMOUR.finditer(inner)):
            yield m.span()


def _jwt_spans(text: str) -> Iterator[tuple[int, int]]:
    for m in _TOKEN.finditer(text):
        parts = m[0].split(".")
        for token in (".".join(parts[:n]) for n in (5, 3) if len(parts) >= n):
            if is_signed_token(token):  # what follows may be a full stop
                yield m.start(), m.start() + len(token)
                break


def base_spans(text: str, kind: str) -> Iterator[tuple[int, int]]:
    pattern, group, least = BASE[kind]
    for m in _FAST.get(kind, pattern).finditer(text):
        if kind in _FAST or len(m[group]) >= least:
            yield m.span()


_CONFIRMED = {"pem": _pem_spans, "jwt": _jwt_spans, "der": _der_spans, "ssh": _ssh_spans}


def spans(text: str) -> list[tuple[int, int, int]]:
    """(start, number of the kind, end) of all secrets of a text, sorted."""
    found = []
    for k, kind in enumerate(KINDS):
        at = base_spans(text, kind) if kind in BASE else _CONFIRMED[kind](text)
        found += [(start, k, end) for start, end in at]
    return sorted(found)


SPANS = ArrayType(StructType().add("kind", StringType()).add("start", IntegerType()).add("end", IntegerType()))


@F.pandas_udf(SPANS)
def spans_of(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
    for texts in batches:
        yield pd.Series([[(KINDS[k], start, end) for start, k, end in spans(text)] for text in texts], dtype=object)


def find_secrets(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of ``docs``: id and its spans, an array of (kind, start, end) by start and kind."""
    return docs.select(F.col(id).alias("id"), spans_of(text_or_empty(F.col(text))).alias("spans"))


def listed(found, kinds) -> F.Column:
    """Spans of the given kinds as ``kind:start:end``, joined by commas."""
    own = F.filter(found, lambda s: s["kind"].isin(*kinds))
    return F.array_join(F.transform(own, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def number_of(found, kind: str) -> F.Column:
    return F.size(F.filter(found, lambda s: s["kind"] == kind)).cast("long")


def op11(spark, sf_dir: str) -> DataFrame:
    found = F.col("spans")
    return find_secrets(table(spark, sf_dir, "documents")).select(
        F.col("id").alias("doc_id"),
        *[number_of(found, kind).alias(f"n_{kind}") for kind in BASE],
        F.sha2(listed(found, BASE), 256).alias("base_sha256"),
        listed(found, KINDS).alias("spans"),
    )
