"""Secrets in texts: plain patterns, and encoded keys and tokens whose structure is confirmed.

Three kinds of ``patterns`` are found by their looks alone: assignments to names like password,
access key ids, and long hexadecimal runs. The other kinds are candidates in base64 or
hexadecimal, which are decoded and parsed before they are reported:

``pem``     a block between ``BEGIN ... PRIVATE KEY`` and its end, whose body decodes to a key
``key64``   a run of base64, broken over lines or not, that begins with a key
``keyhex``  a run of hexadecimal digits that begins with a key
``token``   a signed token: a header that decodes to a JSON object with a known ``alg``, claims
            that decode, and a signature as long as that algorithm makes them

A key is one whose nested lengths all fit and whose parts are those of a private key: a tree of
tags and lengths for RSA, DSA, elliptic curve, wrapped and encrypted keys, or the counted fields of
an OpenSSH key. Public keys, certificates and other encoded bytes are no secrets. Where more is
encoded than the key, the span ends with the key.

Spans count code points, the end is exclusive. Matches of a kind are leftmost and do not overlap;
those of different kinds may.

Defined results: a null or empty text has no spans. Repeated rows give repeated rows, a null id
stays null. Other columns are not read. An empty table gives no rows. Texts are searched whole, in
time linear in their length, and a candidate is decoded as far as the length that it states.
"""

from __future__ import annotations

import base64
import binascii
import json
import re
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

from tallyhouse.llm.arrow import annotate
from tallyhouse.llm.columns import id_and_text

SPANS = "array<struct<kind:string,start:bigint,end:bigint>>"
#: In the order in which spans with the same start are listed.
PATTERN_KINDS = ("assign", "access", "hex")
CONFIRMED_KINDS = ("pem", "key64", "keyhex", "token")
KINDS = PATTERN_KINDS + CONFIRMED_KINDS

Span = tuple[int, int]

# What the pattern kinds look like, and how long the part named must be.
_ASSIGN = re.compile(
    rb"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE
)
_ACCESS = re.compile(rb"AKIA[A-Z0-9]+")
_HEX = re.compile(rb"[0-9a-f]{32,}+")
_LEAST_ASSIGNED, _LEAST_ACCESS = 8, 16

_PEM_MARK = re.compile(rb"-----(BEGIN|END) ((?:[A-Z0-9]{1,16} ){0,3})PRIVATE KEY-----")
_PEM_HEADER = re.compile(rb"\s*+((?:[A-Za-z][A-Za-z-]{0,40}:[^\n]*+\n)*+)\s*+")
# The first six bits of a tag for nested parts are an M; b3Bl... is the name of the OpenSSH format.
_KEY64 = re.compile(rb"(?<![A-Za-z0-9+/_-])(?:M[A-P]|b3BlbnNzaC1rZXktdjE)[A-Za-z0-9+/_-]{30,}+")
_LINES64 = re.compile(rb"[A-Za-z0-9+/_-]*+(?:\r?\n[A-Za-z0-9+/_-]++)*+={0,2}")
_KEYHEX = re.compile(rb"(?<![0-9A-Fa-f])(?:30|6[fF]70656[eE]7373682[dD]6[bB]6579)[0-9A-Fa-f]{40,}+")
# A brace in base64 is "e" and a second character from these.
_TOKEN = re.compile(
    rb"(?<![A-Za-z0-9_-])e[w-z0-9_-][A-Za-z0-9_-]{6,}+\.[A-Za-z0-9_-]*+\.[A-Za-z0-9_-]*+(?:\.[A-Za-z0-9_-]*+\.[A-Za-z0-9_-]*+)?"
)

# Bytes of a signature by its algorithm; for RSA those of the key, whole words.
SIGNATURES: dict[str, Callable[[int], bool]] = {
    "none": lambda n: n == 0,
    "HS256": lambda n: n == 32,
    "HS384": lambda n: n == 48,
    "HS512": lambda n: n == 64,
    "RS256": lambda n: n >= 128 and n % 8 == 0,
    "RS384": lambda n: n >= 128 and n % 8 == 0,
    "RS512": lambda n: n >= 128 and n % 8 == 0,
    "PS256": lambda n: n >= 128 and n % 8 == 0,
    "PS384": lambda n: n >= 128 and n % 8 == 0,
    "PS512": lambda n: n >= 128 and n % 8 == 0,
    "ES256": lambda n: n == 64,
    "ES256K": lambda n: n == 64,
    "ES384": lambda n: n == 96,
    "ES512": lambda n: n == 132,
    "EdDSA": lambda n: n in (64, 114),
}

# Tags of the encoding.
_INTEGER, _BITS, _OCTETS, _NULL, _OID, _SEQUENCE, _CURVE, _PUBLIC = 0x02, 0x03, 0x04, 0x05, 0x06, 0x30, 0xA0, 0xA1
_NAMED = (_CURVE, _PUBLIC, 0x80, 0x81)


#: Bytes of UTF-8 that begin no character.
_CONTINUED = bytes(range(0x80, 0xC0))


class NotAKey(Exception):
    """The bytes have no structure that is looked for."""


def _element(data: bytes, at: int, end: int) -> tuple[int, int, int]:
    """Tag, first byte of the content and byte after it, of the element at ``at``. Its length must
    be written in the shortest way and fit into what surrounds it."""
    if at + 2 > end:
        raise NotAKey
    tag, size, at = data[at], data[at + 1], at + 2
    if size >= 0x80:
        digits = size & 0x7F
        if not 1 <= digits <= 4 or at + digits > end or not data[at]:
            raise NotAKey
        size, at = int.from_bytes(data[at : at + digits]), at + digits
        if size < 0x80:
            raise NotAKey
    if at + size > end:
        raise NotAKey
    return tag, at, at + size


def _elements(data: bytes, at: int, end: int) -> list[tuple[int, int, int]]:
    found = []
    while at < end:
        found.append(_element(data, at, end))
        at = found[-1][2]
    return found


def _number(data: bytes, element: tuple[int, int, int]) -> bool:
    """A whole number, not negative and without idle bytes."""
    tag, at, end = element
    if tag != _INTEGER or at == end or data[at] >= 0x80:
        return False
    return not (end - at > 1 and data[at] == 0 and data[at + 1] < 0x80)


def _version(data: bytes, element: tuple[int, int, int], known: tuple[int, ...]) -> bool:
    tag, at, end = element
    return tag == _INTEGER and end - at == 1 and data[at] in known


def _algorithm(data: bytes, element: tuple[int, int, int]) -> bool:
    """A name of an algorithm, with whatever parameters it has."""
    if element[0] != _SEQUENCE:
        return False
    parts = _elements(data, *element[1:])
    return bool(parts) and parts[0][0] == _OID and 3 <= parts[0][2] - parts[0][1] <= 20 and len(parts) <= 2


def nested_key(data: bytes) -> int:
    """Bytes of the private key, as a tree of tags, that ``data`` begins with."""
    tag, first, last = _element(data, 0, len(data))
    if tag != _SEQUENCE:
        raise NotAKey
    parts = _elements(data, first, last)
    tags = [part[0] for part in parts]
    numbers = tags and all(_number(data, part) for part in parts)
    rsa = numbers and len(parts) == 9 and _version(data, parts[0], (0,)) and parts[1][2] - parts[1][1] >= 32
    dsa = numbers and len(parts) == 6 and _version(data, parts[0], (0,)) and parts[1][2] - parts[1][1] >= 32
    curve = (
        tags[:2] == [_INTEGER, _OCTETS]
        and _version(data, parts[0], (1,))
        and 20 <= parts[1][2] - parts[1][1] <= 66
        and 0 < len(parts[2:]) <= 2
        and all(t in (_CURVE, _PUBLIC) and _elements(data, a, b) for t, a, b in parts[2:])
    )
    wrapped = (
        tags[:3] == [_INTEGER, _SEQUENCE, _OCTETS]
        and _version(data, parts[0], (0, 1))
        and _algorithm(data, parts[1])
        and all(t in _NAMED for t in tags[3:])
        and parts[2][2] - parts[2][1] >= 20
        and bool(_elements(data, *parts[2][1:]))
    )
    encrypted = (
        tags == [_SEQUENCE, _OCTETS]
        and _algorithm(data, parts[0])
        and len(_elements(data, *parts[0][1:])) == 2
        and _elements(data, *parts[0][1:])[1][0] == _SEQUENCE
        and parts[1][2] - parts[1][1] >= 32
    )
    if not (rsa or dsa or curve or wrapped or encrypted):
        raise NotAKey
    return last


_OPENSSH = b"openssh-key-v1\x00"


def counted_key(data: bytes) -> int:
    """Bytes of the OpenSSH private key that ``data`` begins with: counted fields throughout."""
    if not data.startswith(_OPENSSH):
        raise NotAKey
    at = len(_OPENSSH)

    def field() -> bytes:
        nonlocal at
        size = int.from_bytes(data[at : at + 4])
        if at + 4 + size > len(data):
            raise NotAKey
        found = data[at + 4 : at + 4 + size]
        at += 4 + size
        return found

    cipher, derivation, _ = field(), field(), field()
    keys = int.from_bytes(data[at : at + 4])
    at += 4
    if not cipher.isascii() or not derivation.isascii() or not 1 <= keys <= 16:
        raise NotAKey
    for _ in range(keys):
        public = field()
        size = int.from_bytes(public[:4])
        if not 4 <= size <= len(public) - 4 or not public[4 : 4 + size].isascii():
            raise NotAKey
    hidden = field()
    if len(hidden) < 16 or (cipher == b"none" and hidden[:4] != hidden[4:8]):
        raise NotAKey
    return at


def key_bytes(data: bytes) -> int | None:
    """Bytes of the private key that ``data`` begins with; none if it begins with no key."""
    try:
        return counted_key(data) if data[:1] == b"o" else nested_key(data)
    except NotAKey:
        return None


def _wanted(head: bytes) -> int | None:
    """Bytes that the element at the head says it has; none where the format does not say."""
    if head[:1] != b"0" or len(head) < 6:
        return None
    size = head[1]
    return 2 + size if size < 0x80 else 2 + (size & 0x7F) + int.from_bytes(head[2 : 2 + (size & 0x7F)])


def _decoded(symbols: bytes) -> bytes:
    """Whole bytes of base64 symbols of either alphabet, without padding."""
    symbols = symbols.rstrip(b"=").translate(bytes.maketrans(b"-_", b"+/"))
    whole = len(symbols) - (len(symbols) % 4 == 1)
    try:
        return base64.b64decode(symbols[:whole] + b"=" * (-whole % 4))
    except binascii.Error:
        return b""


def _end_in_base64(text: bytes, at: int, found: int) -> int:
    """Where ``found`` bytes, written in base64 from ``at`` on, end. Padding belongs to them if it
    is there and fits."""
    left = -(-found * 4 // 3)
    while left:
        left -= text[at] not in b"\r\n"
        at += 1
    pad = b"=" * (-found % 3)
    return at + len(pad) if text.startswith(pad, at) else at


def pems(text: bytes) -> Iterator[Span]:
    begun = None
    for mark in _PEM_MARK.finditer(text):
        if mark[1] == b"BEGIN":
            begun = mark
            continue
        if begun and begun[2] == mark[2]:
            header = _PEM_HEADER.match(text, begun.end(), mark.start())
            data = _decoded(text[header.end() : mark.start()].translate(None, b" \t\n\r\x0b\x0c"))
            # Under the old encryption the key is whole blocks of noise, and only the header tells.
            noise = b"ENCRYPTED" in header[1] and len(data) >= 48 and len(data) % 8 == 0
            if key_bytes(data) or noise:
                yield begun.start(), mark.end()
        begun = None


def keys_in_base64(text: bytes) -> Iterator[Span]:
    at = lines_end = 0
    while begun := _KEY64.search(text, at):
        first, at = begun.start(), begun.end()
        if first >= lines_end:
            lines_end = _LINES64.match(text, first).end()
        head = _decoded(text[first : first + 8])
        size = _wanted(head)
        if size is None and head[:1] == b"0":
            continue
        # Of lines of 32 symbols and more, with two bytes at each end.
        most = lines_end if size is None else min(lines_end, first + 2 * size + 64)
        found = key_bytes(_decoded(text[first:most].translate(None, b"\r\n")))
        if found:
            at = _end_in_base64(text, first, found)
            yield first, at


def keys_in_hex(text: bytes) -> Iterator[Span]:
    for found in _KEYHEX.finditer(text):
        digits = found[0][: len(found[0]) // 2 * 2]
        size = key_bytes(bytes.fromhex(digits.decode()))
        if size:
            yield found.start(), found.start() + 2 * size


def _header(symbols: bytes) -> dict | None:
    try:
        header = json.loads(_decoded(symbols))
    except (ValueError, RecursionError):
        return None
    return header if isinstance(header, dict) else None


def tokens(text: bytes) -> Iterator[Span]:
    for found in _TOKEN.finditer(text):
        parts = found[0].split(b".")
        header = _header(parts[0])
        if header is None or not isinstance(header.get("alg"), str):
            continue
        if len(parts) == 5 and isinstance(header.get("enc"), str):
            # Encrypted: start value, content and mark of the content are there.
            if all(_decoded(part) for part in parts[2:]):
                yield found.span()
            continue
        fits = SIGNATURES.get(header["alg"])
        signature = _decoded(parts[2])
        if fits and _decoded(parts[1]) and fits(len(signature)) and len(parts[2]) % 4 != 1:
            yield found.start(), found.start() + sum(map(len, parts[:3])) + 2


def assignments(text: bytes) -> Iterator[Span]:
    return (m.span() for m in _ASSIGN.finditer(text) if len(m[2]) >= _LEAST_ASSIGNED)


def access_keys(text: bytes) -> Iterator[Span]:
    return (m.span() for m in _ACCESS.finditer(text) if len(m[0]) >= _LEAST_ACCESS)


def hex_runs(text: bytes) -> Iterator[Span]:
    return (m.span() for m in _HEX.finditer(text))


_FINDERS = dict(zip(KINDS, (assignments, access_keys, hex_runs, pems, keys_in_base64, keys_in_hex, tokens), strict=True))


def spans(text: bytes) -> list[tuple[str, int, int]]:
    """All spans of a text in UTF-8, by start, then by kind as listed, in code points."""
    found = [(start, order, end) for order, find in enumerate(_FINDERS.values()) for start, end in find(text)]
    if not found:
        return []
    found.sort()
    places = sorted({place for start, _, end in found for place in (start, end)})
    points, before, count = {}, 0, 0
    for place in places:
        count += len(text[before:place].translate(None, _CONTINUED))
        points[place], before = count, place
    return [(KINDS[order], points[start], points[end]) for start, order, end in found]


def scan(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``doc_id, spans`` per row of ``docs``: kind, first code point and the one after the last."""

    def search(texts: pa.Array) -> list:
        found = [spans(text or b"") for text in texts.cast(pa.binary()).to_pylist()]
        return [[[dict(zip(("kind", "start", "end"), span)) for span in row] for row in found]]

    rows = id_and_text(docs, id_column, text_column)
    return annotate(rows, "text", {"spans": SPANS}, search, ["doc_id"])
