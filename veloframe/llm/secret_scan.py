"""Secret scan: keyword automaton, anchored patterns near hits, checksum validation.

An Aho-Corasick automaton reads each text once for the keywords of all kinds;
a kind's pattern is tried only where one of its keywords was found. Runs of
hex digits have no keyword: every run of 24 covers a position divisible by
24, so only those positions are looked at. Kinds that carry a check value
(a CRC-32 in base 62, signed parts that must decode, or a private key's own
lengths) are kept only when it holds.

Cases: a null or empty text has no secrets; very long texts are read whole;
other columns are ignored.
"""

from __future__ import annotations

import base64
import binascii
import json
import re
import zlib
from functools import cache

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

from veloframe.llm.common import sliced, texts

# The patterns of the base kinds.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
                    re.IGNORECASE | re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]+")
BASE_KINDS = ("assign", "access", "hex")

CHECKED = re.compile(r"(gh[pousr]_|npm_)([A-Za-z0-9]{30})([A-Za-z0-9]{6})(?![A-Za-z0-9])")
#: A signed token's first part is a run of these from an "eyJ" on; what must follow that run.
SIGNED_RUN = re.compile(r"[A-Za-z0-9_-]+")
SIGNED_REST = re.compile(r"\.(eyJ[A-Za-z0-9_-]+)\.([A-Za-z0-9_-]{16,})")
#: Characters of a part that are looked at first, a multiple of four.
PART_HEAD = 512
PEM = re.compile(r"-----BEGIN ([A-Z ]*PRIVATE KEY)-----")
#: Cipher and IV of an encrypted PEM body, which is whole cipher blocks as long as the IV.
DEK_INFO = re.compile(r"DEK-Info:\s*[A-Za-z0-9-]+,\s*([0-9A-Fa-f]{32}|[0-9A-Fa-f]{16})(?![0-9A-Fa-f])")
OPENSSH = b"openssh-key-v1\0"
#: OpenSSH ciphers that append a tag of 16 bytes to the private part.
TAGGED = (b"aes128-gcm@openssh.com", b"aes256-gcm@openssh.com", b"chacha20-poly1305@openssh.com")
#: Keyword, in lower case, to its kind.
KEYWORDS = (dict.fromkeys(("password", "passwd", "secret", "token", "apikey", "api_key"), "assign")
            | {"akia": "access", "npm_": "checked", "eyj": "signed", "-----begin ": "pem"}
            | dict.fromkeys(("ghp_", "gho_", "ghu_", "ghs_", "ghr_"), "checked"))
BASE62 = "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"
HEX_LEAST, HEX_DIGITS = 24, frozenset("0123456789abcdef")


@cache
def automaton():
    import ahocorasick

    found = ahocorasick.Automaton()
    for word, kind in KEYWORDS.items():
        found.add_word(word, (len(word), kind))
    found.make_automaton()
    return found


def base62_crc(body: str) -> str:
    """CRC-32 of ``body``, six digits in base 62."""
    n, out = zlib.crc32(body.encode()), ""
    for _ in range(6):
        n, digit = divmod(n, 62)
        out = BASE62[digit] + out
    return out


def cannot_decode(head: str) -> bool:
    """Whether no text that begins with ``head`` (whole groups of four) is base64url of JSON: its JSON breaks
    well before the end, and not in a string that may go on."""
    try:
        text = base64.urlsafe_b64decode(head).decode(errors="ignore")
        json.loads(text)
    except json.JSONDecodeError as broken:
        return broken.pos < len(text) - 16 and not broken.msg.startswith("Unterminated")
    except (ValueError, RecursionError):
        return False
    return False


def decodes(text: str, start: int = 0, end: int | None = None) -> bool:
    """Whether the part of ``text`` from ``start`` to ``end`` is base64url of a JSON object."""
    end = len(text) if end is None else end
    if end - start > PART_HEAD and cannot_decode(text[start:start + PART_HEAD]):
        return False
    part = text[start:end]
    try:
        return isinstance(json.loads(base64.urlsafe_b64decode(part + "=" * (-len(part) % 4))), dict)
    except (ValueError, binascii.Error, RecursionError):
        return False


def openssh_key(raw: bytes) -> bool:
    """Whether the length fields of a key in OpenSSH's own format add up to its length."""
    def field(at: int) -> int:
        return at + 4 + int.from_bytes(raw[at:at + 4], "big")

    cipher = len(OPENSSH)
    kdf = field(cipher)
    at = field(field(kdf))
    keys = int.from_bytes(raw[at:at + 4], "big")
    at += 4
    for _ in range(keys + 1):  # the public keys, then the private part
        if at + 4 > len(raw):
            return False
        at = field(at)
    return keys > 0 and len(raw) - at == (16 if raw[cipher + 4:kdf] in TAGGED else 0)


def pem_body(body: str) -> bool:
    """Whether ``body``, less its header lines, is base64 of a private key by the lengths it states: a DER
    sequence, OpenSSH's own format, or, if the headers name a cipher, whole blocks of it."""
    lines = body.strip().splitlines()
    n_headers = next((k for k, x in enumerate(lines) if ":" not in x), len(lines))
    try:
        der = base64.b64decode("".join("".join(lines[n_headers:]).split()), validate=True)
    except (ValueError, binascii.Error):
        return False
    for header in lines[:n_headers]:
        if m := DEK_INFO.match(header.strip()):
            return len(der) > 0 and len(der) % (len(m[1]) // 2) == 0
    if der.startswith(OPENSSH):
        return openssh_key(der)
    if len(der) < 2 or der[0] != 0x30:
        return False
    if der[1] < 0x80:
        return len(der) == 2 + der[1]
    n = der[1] & 0x7F
    return len(der) == 2 + n + int.from_bytes(der[2:2 + n], "big")


def match(kind: str, text: str, at: int) -> tuple[int, bool] | None:
    """The end of the kind's match at ``at``, and whether it is a secret."""
    if kind == "assign":
        m = ASSIGN.match(text, at)
        return m and (m.end(), len(m[2]) >= 6)
    if kind == "access":
        m = ACCESS.match(text, at)
        return m and (m.end(), m.end() - m.start() >= 20)
    if kind == "checked":
        m = CHECKED.match(text, at)
        return m and (m.end(), base62_crc(m[2]) == m[3])
    m = PEM.match(text, at)
    if not m:
        return None
    last, following = f"-----END {m[1]}-----", text.find("-----BEGIN ", m.end())
    end = text.find(last, m.end(), following if following >= 0 else len(text))
    return (end + len(last), pem_body(text[m.end():end])) if end >= 0 else None


def signed_tokens(text: str, starts: list[int]) -> list[tuple[int, int]]:
    """(start, end) of the tokens that begin at one of ``starts``, in order.

    All starts in one run of the alphabet share its end and what follows, which are found once per run; so
    every run is read a few times at most, however many starts it has.
    """
    out, done, run_end, rest = [], 0, 0, None
    for at in starts:
        if at < done or not text.startswith("eyJ", at):
            continue
        if at >= run_end:
            run_end = SIGNED_RUN.match(text, at).end()
            rest = SIGNED_REST.match(text, run_end)
            if rest and not decodes(rest[1]):
                rest = None
        if rest and run_end - at > 3 and decodes(text, at, run_end):
            done = rest.end()
            out.append((at, done))
    return out


def hex_runs(text: str) -> list[tuple[int, int]]:
    """Runs of 24 or more lower-case hex digits."""
    probes = text[HEX_LEAST - 1::HEX_LEAST]
    out, done = [], 0
    for k, c in enumerate(probes):
        if c in HEX_DIGITS and (at := k * HEX_LEAST + HEX_LEAST - 1) >= done:
            start = at
            while start > done and text[start - 1] in HEX_DIGITS:
                start -= 1
            done = HEX.match(text, at).end()
            if done - start >= HEX_LEAST:
                out.append((start, done))
    return out


def scan(text: str) -> list[tuple[int, str, int]]:
    """(start, kind, end) of all secrets, by start, then the base kinds in their order, then others.

    Within a kind, matches are the leftmost ones that do not overlap; of kinds with a check value, the leftmost
    ones that pass it.
    """
    lower = text.lower()
    if len(lower) != len(text):  # one capital letter has a two-character lower case
        lower = text.replace("İ", "I").lower()
    hits: dict[str, list[int]] = {}
    for end, (length, kind) in automaton().iter(lower):
        hits.setdefault(kind, []).append(end - length + 1)
    out = [(s, "hex", e) for s, e in hex_runs(text)]
    for kind, starts in hits.items():
        if kind == "signed":
            out += [(at, kind, end) for at, end in signed_tokens(text, sorted(starts))]
            continue
        done = 0
        for at in sorted(starts):
            if at >= done and (m := match(kind, text, at)):
                if m[1]:
                    out.append((at, kind, m[0]))
                if m[1] or kind in BASE_KINDS:
                    done = m[0]
    return sorted(out, key=lambda x: (x[0], BASE_KINDS.index(x[1]) if x[1] in BASE_KINDS else 9, x[1]))


def as_text(spans: list[tuple[int, str, int]]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for start, kind, end in spans)


def redact(text: str, spans: list[tuple[int, str, int]]) -> str:
    """``text`` with each stretch that spans cover replaced by ``[kind]`` of its first span."""
    out, at = [], 0
    for start, kind, end in spans:
        if start >= at:
            out += [text[at:start], f"[{kind}]"]
        at = max(at, end)
    return "".join([*out, text[at:]])


def secret_spans(text: Column) -> Column:
    """array<struct<start, kind, end>> of a text column, in code points, end exclusive."""

    @F.arrow_udf("array<struct<start:int,kind:string,end:int>>")
    def found(column: pa.Array) -> pa.Array:
        return pa.array([[{"start": s, "kind": k, "end": e} for s, k, e in scan(x.decode())] for x in texts(column)],
                        pa.list_(pa.struct([("start", pa.int32()), ("kind", pa.string()), ("end", pa.int32())])))

    return found(text)


def redacted(text: Column) -> Column:
    """The text with its secrets replaced; null stays null."""

    @F.arrow_udf("string")
    def clean(column: pa.Array) -> pa.Array:
        return sliced(lambda c: pa.array([x and redact(x, scan(x)) for x in c.to_pylist()], pa.string()),
                      pa.string(), column)

    return clean(text)
