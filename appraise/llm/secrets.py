"""Operator 4: secret scan with structural confirmation.

Base kinds are patterns with a length test: ``assign``, ``access`` and ``hex``.
The method adds kinds that are reported only after their structure was decoded:

* ``jwt``: three base64url parts of which the first decodes to a JSON object
  with a text ``alg`` and the second to a JSON object (a signed-token header);
* ``pem``: an armoured private key whose body is base64 and whose bytes are one
  DER sequence with exact nested lengths, or an OpenSSH key, or, where its header
  lines name a cipher, whole blocks of that cipher; line ends may be escaped;
* ``der64`` / ``derhex``: a base64 or hex run that decodes to a DER sequence with
  exact nested lengths that holds an integer, bit string or octet string;
* ``ssh``: a base64 or hex run that decodes to length-prefixed fields starting with a
  key type, as in public and private SSH keys.

A base64 run is a word, or lines of one width and a last one of at most that (line ends
may be escaped) that don't follow an armour line; hex may mix upper and lower case.

Spans are code point offsets, end exclusive. Defined results: a null or empty
text has no spans; repeated rows are scanned one by one; overlapping kinds are
all reported; within a kind matches don't overlap.
"""

from __future__ import annotations

import base64
import binascii
import hashlib
import json
import re

from pyspark.sql import DataFrame
from pyspark.sql import types as T

from appraise.llm.common import map_batches

KINDS = ("assign", "access", "hex", "jwt", "pem", "der64", "derhex", "ssh")
_ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII
)
_ASSIGN_HINTS = ("password", "passwd", "secret", "token", "apikey", "api_key")
_ACCESS = re.compile(r"AKIA[A-Z0-9]{14,}")
_HEX = re.compile(r"[0-9a-f]{16,}")
_JWT = re.compile(r"eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{4,}\.[A-Za-z0-9_-]*")
_EOL = r"(?:\s|\\+[rn])"
_PEM = re.compile(
    rf"-----BEGIN ([A-Z ]*PRIVATE KEY)-----{_EOL}*+((?:[A-Za-z][A-Za-z-]*+:[^\r\n\\]*+{_EOL}++)*+)((?:[A-Za-z0-9+/=]|{_EOL})++)-----END \1-----"
)
_DEK = re.compile(r"DEK-Info:\x20*(AES-[0-9]+|DES-EDE3|DES)-[A-Z0-9]+,((?:[0-9A-Fa-f]{2})+)")
_ARMOUR = re.compile(rf"-----BEGIN [^-]*+-----{_EOL}*+\Z")
_B64 = re.compile(r"[A-Za-z0-9+/_-]{32,}={0,2}")
_LINE_END = r"(?:\r?\n|(?:\\+r)?\\+n)[\x20\t]*+"
_LINES = re.compile(rf"(?:(?<=\\[rn])|(?<![A-Za-z0-9+/_\\-]))[A-Za-z0-9+/_-]{{32,}}+(?:{_LINE_END}[A-Za-z0-9+/_-]++)+={{0,2}}")
_LINE = re.compile(r"(?:(?<=\\[rn])|(?<![A-Za-z0-9+/_\\-]))[A-Za-z0-9+/_-]+={0,2}")
_ANYHEX = re.compile(r"(?:[0-9A-Fa-f]{2}){24,}")
_ONE_CASE = re.compile(r"(?:[0-9a-f]{2}){24,}|(?:[0-9A-F]{2}){24,}")
_KEY_TYPES = (b"ssh-rsa", b"ssh-dss", b"ssh-ed25519", b"ecdsa-sha2-", b"sk-ssh-ed25519")
_OPENSSH = b"openssh-key-v1\x00"


def decode64(run: str) -> bytes | None:
    """Bytes of a base64 or base64url run with or without padding; None if it is neither."""
    body = run.rstrip("=").replace("-", "+").replace("_", "/")
    if len(body) % 4 == 1:
        return None
    try:
        return base64.b64decode(body + "=" * (-len(body) % 4), validate=True)
    except (binascii.Error, ValueError):
        return None


def _tlv(data: bytes, at: int, end: int) -> tuple[int, int, int] | None:
    """Tag, start and end of the value of the DER element at ``at``; None if it doesn't fit before ``end``."""
    if at + 2 > end:
        return None
    tag, size, at = data[at], data[at + 1], at + 2
    if size >= 0x80:
        k = size & 0x7F
        if not 1 <= k <= 4 or at + k > end:
            return None
        size, at = int.from_bytes(data[at : at + k], "big"), at + k
        if size < 0x80 or (k > 1 and size < 1 << (8 * (k - 1))):
            return None  # not the shortest form
    return (tag, at, at + size) if at + size <= end else None


def is_der_key(data: bytes | None) -> bool:
    """One DER sequence that fills the bytes, with nested lengths that add up and a key-like leaf."""
    if not data or len(data) < 16 or data[0] != 0x30:
        return False
    top = _tlv(data, 0, len(data))
    if not top or top[2] != len(data):
        return False
    leaf, stack = False, [(top[1], top[2], 0)]
    while stack:
        at, end, depth = stack.pop()
        while at < end:
            got = _tlv(data, at, end)
            if not got or depth > 16:
                return False
            tag, start, at = got
            if tag in (0x30, 0x31) or 0xA0 <= tag <= 0xA3:
                stack.append((start, at, depth + 1))
            elif tag in (0x02, 0x03, 0x04):
                leaf |= at - start >= 8
            elif tag not in (0x01, 0x05, 0x06, 0x0C, 0x13, 0x16, 0x17, 0x18, 0x80, 0x81, 0x82):
                return False
    return leaf


def is_ssh_key(data: bytes | None) -> bool:
    """Length-prefixed fields that fill the bytes and start with a key type, or an OpenSSH private key."""
    if not data:
        return False
    if data.startswith(_OPENSSH):
        at = len(_OPENSSH)
        for _ in range(3):  # cipher, key derivation and its options
            size = int.from_bytes(data[at : at + 4], "big")
            at += 4 + size
            if at > len(data):
                return False
        return at + 4 <= len(data)
    fields, at = [], 0
    while at + 4 <= len(data) and len(fields) < 16:
        size = int.from_bytes(data[at : at + 4], "big")
        if at + 4 + size > len(data):
            return False
        fields.append(data[at + 4 : at + 4 + size])
        at += 4 + size
    return at == len(data) and len(fields) >= 2 and fields[0].startswith(_KEY_TYPES)


def key_kind(data: bytes | None, der: str) -> str | None:
    return der if is_der_key(data) else "ssh" if is_ssh_key(data) else None


def is_armoured_key(headers: str, body: str) -> bool:
    data = decode64(re.sub(rf"{_EOL}+", "", body))
    if is_der_key(data) or is_ssh_key(data):
        return True
    dek = _DEK.search(headers)
    block = 16 if dek and dek[1].startswith("AES") else 8
    return bool(dek and data) and len(dek[2]) == 2 * block and len(data) % block == 0


def _may_start(line: str) -> bool:
    """Whether the first line of a run starts as a DER sequence or an SSH key does."""
    data = decode64(line[: len(line) // 4 * 4]) or b""
    size = int.from_bytes(data[:4], "big")
    return data.startswith((b"\x30", _OPENSSH)) or data[4 : 4 + size].startswith(_KEY_TYPES)


def wrapped_keys(text: str) -> list[tuple[int, int, str]]:
    """Keys whose base64 is wrapped: lines of one width and a last one of at most that."""
    out = []
    for m in _LINES.finditer(text):
        if _ARMOUR.search(text[max(0, m.start() - 200) : m.start()]):
            continue
        lines = [x.span() for x in _LINE.finditer(text, *m.span())]
        width = [b - a for a, b in lines]
        upto = list(range(1, len(lines) + 1))  # the end of the lines of one width from each on
        for i in range(len(lines) - 2, -1, -1):
            if width[i] == width[i + 1]:
                upto[i] = upto[i + 1]
        i = 0
        while i < len(lines):
            first, found = text[slice(*lines[i])], 0
            if width[i] >= 32 and _may_start(first):
                for end in (upto[i] + 1, upto[i]):
                    if end - i < 2 or end > len(lines) or width[end - 1] > width[i]:
                        continue
                    if first[0] == "M":  # a DER sequence tells its size, so only lines of that size are put together
                        top = decode64(first[:12]) or b""
                        k = top[1] & 0x7F if top[1] >= 0x80 else 0
                        size = 2 + k + (int.from_bytes(top[2 : 2 + k], "big") if k else top[1])
                        have = sum(width[i:end]) * 3 // 4
                        if not have - 3 <= size <= have:
                            continue
                    kind = key_kind(decode64("".join(text[a:b] for a, b in lines[i:end])), "der64")
                    if kind:
                        out.append((lines[i][0], lines[end - 1][1], kind))
                        found = end
                        break
            i = found or i + 1
    return out


def _json_object(part: str) -> dict | None:
    data = decode64(part)
    try:
        got = json.loads(data.decode("utf-8")) if data else None
    except (UnicodeDecodeError, ValueError, RecursionError):
        return None
    return got if isinstance(got, dict) else None


def is_signed_token(run: str) -> bool:
    parts = run.split(".")
    head = _json_object(parts[0]) if len(parts) == 3 else None
    return bool(head) and isinstance(head.get("alg"), str) and _json_object(parts[1]) is not None


def scan(text: str | None) -> list[tuple[int, int, str]]:
    """Spans (start, end, kind) by start, then kind in the order of ``KINDS``."""
    if not text:
        return []
    out: list[tuple[int, int, str]] = []
    low = text.lower() if text.isascii() else _ascii_lower(text)
    if any(h in low for h in _ASSIGN_HINTS):
        out += [(*m.span(), "assign") for m in _ASSIGN.finditer(text) if len(m[2]) >= 12]
    if "AKIA" in text:
        out += [(*m.span(), "access") for m in _ACCESS.finditer(text)]
    out += [(*m.span(), "hex") for m in _HEX.finditer(text)]
    if "eyJ" in text:
        out += [(*m.span(), "jwt") for m in _JWT.finditer(text) if is_signed_token(m[0])]
    if "PRIVATE KEY-----" in text:
        for m in _PEM.finditer(text):
            if is_armoured_key(m[2], m[3]):
                out.append((*m.span(), "pem"))
    wrapped = wrapped_keys(text)
    out += wrapped
    for m in _B64.finditer(text):
        start, run = m.start(), m[0]
        if any(a <= start < b for a, b, _ in wrapped):
            continue
        kind = key_kind(decode64(run), "der64")
        if not kind and run[0] in "nr" and text[start - 1 : start] == "\\":  # the letter belongs to an escaped line end
            start, kind = start + 1, key_kind(decode64(run[1:]), "der64")
        if kind and not any(a < m.end() and start < b for a, b, _ in wrapped):
            out.append((start, m.end(), kind))
    for m in _ANYHEX.finditer(text):
        kind = key_kind(bytes.fromhex(m[0]), "derhex")
        if kind:
            out.append((*m.span(), kind))
        else:
            found = ((*x.span(), key_kind(bytes.fromhex(x[0]), "derhex")) for x in _ONE_CASE.finditer(text, *m.span()))
            out += [x for x in found if x[2]]
    return sorted(out, key=lambda s: (s[0], KINDS.index(s[2]), s[1]))


_LOWER = {c: c + 32 for c in range(65, 91)}


def _ascii_lower(text: str) -> str:
    return text.translate(_LOWER) if any(h in text.lower() for h in _ASSIGN_HINTS) else ""


def joined(spans: list[tuple[int, int, str]]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for start, end, kind in spans)


def redact(text: str | None, spans: list[tuple[int, int, str]], mask: str = "[SECRET]") -> str | None:
    """The text with every span replaced by ``mask``; overlapping and touching spans become one."""
    if not spans or text is None:
        return text
    out, at, end = [], 0, -1
    for start, stop, _ in spans:
        if start > end:
            if end >= 0:
                out.append(mask)
                at = end
            out.append(text[at:start])
        end = max(end, stop)
    return "".join([*out, mask, text[end:]])


def scan_documents(docs: DataFrame, key: str = "doc_id") -> DataFrame:
    """Per row: the key, counts of the base kinds, their digest and all spans as text."""

    def run(batch):
        found = [scan(t) for t in batch.column("text").to_pylist()]
        base = [[s for s in f if s[2] in KINDS[:3]] for f in found]
        out = {f"n_{kind}": [sum(s[2] == kind for s in f) for f in base] for kind in KINDS[:3]}
        out["base_sha256"] = [hashlib.sha256(joined(f).encode()).hexdigest() for f in base]
        out["spans"] = [joined(f) for f in found]
        out["n_confirmed"] = [len(f) - len(b) for f, b in zip(found, base, strict=True)]
        return out

    schema = T.StructType([docs.schema[key]])
    for name in ("n_assign", "n_access", "n_hex"):
        schema = schema.add(name, "long")
    schema = schema.add("base_sha256", "string").add("spans", "string").add("n_confirmed", "long")
    return map_batches(docs.select(key, "text"), run, schema)


def mask_documents(docs: DataFrame, mask: str = "[SECRET]") -> DataFrame:
    """The same rows and columns with every secret of ``text`` masked (``n_chars``, if there, follows the new text)."""
    has_n = "n_chars" in docs.columns

    def run(batch):
        old = batch.column("text").to_pylist()
        new = [redact(t, scan(t), mask) for t in old]
        out = {"text": new}
        if has_n:
            sizes = batch.column("n_chars").to_pylist()
            out["n_chars"] = [n if a == b else len(b) for a, b, n in zip(old, new, sizes, strict=True)]
        return out

    return map_batches(docs, run, docs.schema)
