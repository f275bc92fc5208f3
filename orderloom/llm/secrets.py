"""Secrets: plain patterns, and encoded keys and tokens that are confirmed by their structure.

A candidate run of base64 or hex is decoded and parsed before it is reported: private keys as nested
DER lengths or as length-prefixed OpenSSH fields, signed tokens by their JSON header. Whatever does not
parse to its end is not reported on this ground. A key may begin anywhere in a run and ends with it, or where the
alphabet of the run changes; runs that are wrapped at the ends of lines, quoted or parted by colons are joined first.
"""

from __future__ import annotations

import base64
import binascii
import json
import re
from bisect import bisect_right

from orderloom.llm.spans import Span

KINDS = ("assign", "access", "hex", "pem", "der", "ssh", "jwt")
# The plain patterns.
_ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII)
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"[0-9a-f]{32,}+")
# Candidates for structural confirmation.
_PEM = re.compile(r"-----BEGIN [A-Z0-9 ]{0,40}PRIVATE KEY-----")
_PEM_END = re.compile(r"-----END [A-Z0-9 ]{0,40}PRIVATE KEY-----")
_PEM_LINE = re.compile(r"\\r|\\n|[\r\n]")
_PEM_HEADER = re.compile(r"[A-Za-z][A-Za-z0-9-]*:")
_BASE64 = re.compile(r"[A-Za-z0-9+/_-]{40,}+={0,2}")
_WRAPPED = re.compile(r"(?<![A-Za-z0-9+/])(?:[A-Za-z0-9+/]{40,76}+[\x20\t]{0,4}\r?\n[\x20\t>|#*]{0,12})+[A-Za-z0-9+/]+={0,2}")
# A first byte of 0x30, the tag of a sequence of any length, or the start of the OpenSSH magic.
_KEY_START = re.compile(r"M[A-P]|b3BlbnNza")
_HEX_RUN = re.compile(r"[0-9a-fA-F]{64,}+")
_PARTED_HEX = re.compile(r"(?<![0-9a-fA-F])[0-9a-fA-F]{2}(?::\s{0,12}[0-9a-fA-F]{2}){30,}+(?![0-9a-fA-F])")
_TOKEN = re.compile(r"(?<![A-Za-z0-9])ey[A-Za-z0-9_-]{10,}+\.[A-Za-z0-9_-]{4,}+\.[A-Za-z0-9_-]*+")
_TOKEN_START = re.compile(r"(?<=[_-])ey")
#: Bytes of the largest key, and characters of the longest token header, that are looked for inside a longer run.
MOST_KEY, MOST_HEADER = 1 << 14, 1 << 13
_SSH_MAGIC = b"openssh-key-v1\0"
_SEQUENCE, _INTEGER, _OCTETS, _OBJECT = 0x30, 0x02, 0x04, 0x06


def _decode(run: str) -> bytes | None:
    """The bytes of a base64 run in either alphabet, or None."""
    plain = run.rstrip("=").translate({45: "+", 95: "/"})
    if len(plain) % 4 == 1:
        return None
    try:
        return base64.b64decode(plain + "=" * (-len(plain) % 4), validate=True)
    except (binascii.Error, ValueError):
        return None


def _item(data: bytes, at: int, end: int) -> tuple[int, int, int] | None:
    """Tag, start and end of the content of the DER item at `at`, if it lies within `end`."""
    if at + 2 > end:
        return None
    tag, size, start = data[at], data[at + 1], at + 2
    if size & 0x80:
        width = size & 0x7F
        if not 1 <= width <= 4 or start + width > end or data[start] == 0:
            return None
        size = int.from_bytes(data[start : start + width], "big")
        start += width
    return (tag, start, start + size) if start + size <= end else None


def _items(data: bytes, start: int, end: int) -> list[tuple[int, int, int]] | None:
    """All items between start and end, if they fill it."""
    found = []
    while start < end:
        item = _item(data, start, end)
        if item is None:
            return None
        found.append(item)
        start = item[2]
    return found


def is_private_key(data: bytes) -> bool:
    """Whether the bytes are one DER sequence, filled to its end, of the shape of a private key.

    RSA and DSA keys are a version and integers; EC keys a version and octets; PKCS#8 a version, an algorithm
    with an object identifier, and octets; its encrypted form an algorithm and octets.
    """
    outer = _item(data, 0, len(data))
    if outer is None or outer[0] != _SEQUENCE or outer[2] != len(data):
        return False
    parts = _items(data, *outer[1:])
    if not parts or len(parts) < 2:
        return False
    tags = [p[0] for p in parts]
    names_algorithm = lambda p: bool((inner := _items(data, p[1], p[2])) and inner[0][0] in (_OBJECT,))
    if tags[0] == _SEQUENCE and tags[1:] == [_OCTETS]:
        return names_algorithm(parts[0])
    version = parts[0][2] - parts[0][1] == 1 and data[parts[0][1]] in (0, 1)
    if tags[0] != _INTEGER or not version:
        return False
    if len(tags) >= 6 and all(t == _INTEGER for t in tags):
        return all(p[2] > p[1] for p in parts)
    if tags[1] == _OCTETS:
        return parts[1][2] - parts[1][1] >= 16
    return len(tags) >= 3 and tags[1] == _SEQUENCE and tags[2] == _OCTETS and names_algorithm(parts[1])


def is_ssh_key(data: bytes) -> bool:
    """Whether the bytes are an OpenSSH private key: its magic, then length-prefixed fields that fit."""
    if not data.startswith(_SSH_MAGIC):
        return False
    at = len(_SSH_MAGIC)
    for field in range(5):  # cipher, kdf, options, (count), public part, private part
        if field == 3:
            at += 4
        if at + 4 > len(data):
            return False
        at += 4 + int.from_bytes(data[at : at + 4], "big")
    return at <= len(data)


def is_signed_token(run: str) -> bool:
    """Whether the first part decodes to a JSON object that names an algorithm, and the second to an object."""
    header, body = (_decode(p) for p in run.split(".")[:2])
    try:
        first = json.loads(header or b"")
        return isinstance(first, dict) and isinstance(first.get("alg"), str) and isinstance(json.loads(body or b""), dict)
    except (ValueError, RecursionError):
        return False


def _pem(text: str) -> list[Span]:
    """Keys between marks: what stands between is a key, or encrypted by the header lines that precede it."""
    found: list[Span] = []
    for match in _PEM.finditer(text):
        stop = text.find("-----", match.end())
        end = _PEM_END.match(text, stop) if stop >= 0 else None
        if not end:
            continue
        lines = [line.strip(" \t>|#*\"'") for line in _PEM_LINE.split(text[match.end() : stop])]
        body = [line for line in lines if not _PEM_HEADER.match(line)]
        data = _decode("".join("".join(body).split()))
        encrypted = any(line.startswith("Proc-Type:") and "ENCRYPTED" in line for line in lines) and any(line.startswith("DEK-Info:") for line in lines)
        if data and (is_private_key(data) or is_ssh_key(data) or (encrypted and len(data) >= 32 and len(data) % 8 == 0)):
            found.append(("pem", match.start(), end.end(), False))
    return found


def _size_at(data: bytes) -> int:
    """Bytes of the sequence that begins here, as its header tells, if a private key may; else 0."""
    if len(data) < 6 or data[0] != _SEQUENCE:
        return 0
    width = data[1] & 0x7F if data[1] & 0x80 else 0
    if width > 4 or len(data) < 3 + width or data[2 + width] not in (_INTEGER, _SEQUENCE):
        return 0
    return 2 + (width + int.from_bytes(data[2 : 2 + width], "big") if width else data[1])


def _keys_in(run: str, breaks: frozenset[int] = frozenset()) -> list[tuple[str, int, int]]:
    """Kind, start and end of the keys in a base64 run; a key ends with it, at a break, or where the alphabet changes."""
    found, upto = [], 0
    for match in _KEY_START.finditer(run):
        start = match.start()
        if start < upto:
            continue
        if match.group() == "b3BlbnNza":
            data = _decode(run[start:])
            if data and is_ssh_key(data):
                found.append(("ssh", start, len(run)))
                upto = len(run)
            continue
        size = _size_at(_decode(run[start : start + 12]) or b"")
        chars = -(-size * 4 // 3)
        end = start + chars
        if not size or size > MOST_KEY or end > len(run.rstrip("=")):
            continue
        key, after = run[start:end], run[end : end + 1]
        if ("+" in key or "/" in key) and ("-" in key or "_" in key):
            continue
        ends = not after or after == "=" or end in breaks or (after in "-_" and not ("-" in key or "_" in key)) or (after in "+/" and not ("+" in key or "/" in key))
        data = _decode(key) if ends else None
        if data and len(data) == size and is_private_key(data):
            while run[end : end + 1] == "=":
                end += 1
            found.append(("der", start, end))
            upto = end
    return found


def _hex_key_in(data: bytes) -> int | None:
    """Where a key begins that ends with these bytes."""
    for match in re.finditer(b"\x30", data):
        at = match.start()
        if _size_at(data[at : at + 8]) == len(data) - at and is_private_key(data[at:]):
            return at
    return None


def _structural(text: str) -> list[Span]:
    found = _pem(text) if "PRIVATE KEY-----" in text else []
    # Spans that are found, in order: nothing inside them is reported again.
    taken = [(a, b) for _, a, b, _ in found]

    def add(kind: str, a: int, b: int) -> None:
        i = bisect_right(taken, (a, len(text)))
        if (i and taken[i - 1][1] > a) or (i < len(taken) and taken[i][0] < b):
            return
        taken.insert(i, (a, b))
        found.append((kind, a, b, False))

    for match in _WRAPPED.finditer(text) if "\n" in text else ():
        at = [i for i, c in enumerate(match.group(), match.start()) if c.isalnum() or c in "+/="]
        breaks = frozenset(n for n in range(1, len(at)) if at[n] - at[n - 1] > 1)
        for kind, a, b in _keys_in("".join(text[i] for i in at), breaks):
            add(kind, at[a], at[b - 1] + 1)
    for match in _BASE64.finditer(text):
        for kind, a, b in _keys_in(match.group()):
            add(kind, match.start() + a, match.start() + b)
    for match in _HEX_RUN.finditer(text):
        run = match.group()
        at = _hex_key_in(bytes.fromhex(run[len(run) % 2 :])) if "30" in run else None
        if at is not None:
            add("der", match.start() + len(run) % 2 + 2 * at, match.end())
    for match in _PARTED_HEX.finditer(text) if ":" in text else ():
        data = bytes.fromhex("".join(match.group().replace(":", " ").split()))
        at = _hex_key_in(data)
        if at is not None:
            pairs = [m.start() for m in re.finditer("[0-9a-fA-F]{2}", match.group())]
            add("der", match.start() + pairs[at], match.end())
    for match in _TOKEN.finditer(text) if "ey" in text else ():
        run, header = match.group(), match.group().find(".")
        if is_signed_token(run):
            found.append(("jwt", *match.span(), False))
            continue
        for start in _TOKEN_START.finditer(run, max(1, header - MOST_HEADER), header):
            if is_signed_token(run[start.start() :]):
                found.append(("jwt", match.start() + start.start(), match.end(), False))
                break
    return found


def find(text: str) -> list[Span]:
    """All secrets, by start, then kind as in KINDS. An empty text has none."""
    spans: list[Span] = [("assign", *m.span(), True) for m in _ASSIGN.finditer(text) if len(m[2]) >= 8]
    if "AKIA" in text:
        spans += [("access", *m.span(), True) for m in _ACCESS.finditer(text) if m.end() - m.start() >= 16]
    spans += [("hex", *m.span(), True) for m in _HEX.finditer(text)]
    spans += _structural(text)
    return sorted(spans, key=lambda s: (s[1], KINDS.index(s[0])))


def mask(kind: str) -> str:
    return f"<secret:{kind}>"
