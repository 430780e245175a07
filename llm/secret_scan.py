"""Secrets in text, with structural confirmation of encoded ones.

Three plain patterns give the base spans. Encoded candidates are decoded and parsed before anything
more is reported:

* base64 or hex that opens a DER sequence: the length in its header says how many characters belong to
  it, every nested length has to fill its parent exactly, and the fields have to be those of a private
  key (PKCS#1, DSA, SEC1, PKCS#8, encrypted PKCS#8). Lines of a wrapped body are joined, be the breaks
  real or written as ``\\n``;
* base64 that opens an OpenSSH key: all length-prefixed strings are walked to the end;
* an encrypted PEM block: vector and body have to match the cipher's block length;
* base64 or hex of a PEM text: the text inside is scanned in turn, to a depth of ``MAX_NESTING``;
* signed or encrypted tokens: the header has to be a JSON object that names an algorithm, and the
  signature has to have that algorithm's length.

Public keys, certificates and unsigned tokens are no secrets and aren't reported. Each text is scanned
whole by its own task; no step compares rows, so nothing is shuffled.
"""

from __future__ import annotations

import base64
import binascii
import json
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from llm.shipping import ready
from llm.textbatch import map_rows

#: Kinds in the order in which spans of one start are listed; the first three are the base ones.
KINDS = ("assign", "access", "hex", "key", "jwt")
BASE_KINDS = KINDS[:3]
MAX_NESTING = 3
#: Nested DER values deeper than this belong to no key.
MAX_DEPTH = 16
#: No private key is longer; an RSA key of 16,384 bits has under 10,000 bytes. It also bounds what one candidate reads.
MAX_KEY_BYTES = 0xFFFF

Span = tuple[str, int, int]

_ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII | re.IGNORECASE
)
_ASSIGN_WORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"[0-9a-f]{32,}")


def base_spans(text: str) -> Iterator[Span]:
    """Leftmost matches of each plain pattern that don't overlap; too short ones are dropped."""

    lowered = text.lower()
    if any(word in lowered for word in _ASSIGN_WORDS):
        for found in _ASSIGN.finditer(text):
            if len(found[2]) >= 8:
                yield "assign", found.start(), found.end()
    for found in _ACCESS.finditer(text):
        if len(found[0]) >= 16:
            yield "access", found.start(), found.end()
    # A greedy run of at least 32 is a greedy run that passes the length test.
    for found in _HEX.finditer(text):
        yield "hex", found.start(), found.end()


# Nested lengths


def der_parts(data: bytes, low: int, high: int) -> list[tuple[int, int, int]] | None:
    """(tag, start, end) of the DER values that fill [low, high) exactly; None if none do."""

    parts = []
    while low < high:
        header = der_header(data[low : low + 6])
        if header is None or low + sum(header[1:]) > high:
            return None
        tag, size, length = header
        parts.append((tag, low + size, low + size + length))
        low += size + length
    return parts


def der_header(data: bytes) -> tuple[int, int, int] | None:
    """(tag, header size, content length) of shortest form; long tags and open lengths give None."""

    if len(data) < 2 or data[0] & 0x1F == 0x1F:
        return None
    first = data[1]
    if first < 0x80:
        return data[0], 2, first
    size = first & 0x7F
    length = int.from_bytes(data[2 : 2 + size], "big")
    if not 1 <= size <= 4 or len(data) < 2 + size or length < 0x80 or length < 1 << 8 * (size - 1):
        return None
    return data[0], 2 + size, length


def well_nested(data: bytes) -> bool:
    """Whether one value fills ``data`` and every constructed value inside is filled exactly."""

    todo, top = [(0, len(data), 0)], True
    while todo:
        low, high, depth = todo.pop()
        parts = der_parts(data, low, high)
        if parts is None or depth > MAX_DEPTH or (top and len(parts) != 1):
            return False
        top = False
        for tag, start, end in parts:
            if tag == 0x02 and start == end:
                return False
            if tag & 0x20:
                todo.append((start, end, depth + 1))
    return True


def _key_fields(data: bytes) -> list[tuple[int, int, int]]:
    top = der_parts(data, 0, len(data))
    if not top or len(top) != 1 or top[0][0] != 0x30:
        return []
    return der_parts(data, *top[0][1:]) or []


def is_private_key(data: bytes) -> bool:
    """Whether DER bytes hold the fields of a private key, nested lengths included."""

    if not well_nested(data):
        return False
    fields = _key_fields(data)
    tags = [tag for tag, _, _ in fields]
    version = data[fields[0][1] : fields[0][2]] if tags[:1] == [0x02] else None
    if version == b"\0" and (tags == [0x02] * 9 or tags == [0x02] * 6):
        return all(end - start > 0 for _, start, end in fields)
    if version == b"\1" and tags == [0x02] * 9 + [0x30]:
        return True
    if version == b"\1" and tags[:2] == [0x02, 0x04] and set(tags[2:]) <= {0xA0, 0xA1}:
        return 16 <= fields[1][2] - fields[1][1] <= 72
    if version in (b"\0", b"\1") and tags[:3] == [0x02, 0x30, 0x04] and set(tags[3:]) <= {0xA0, 0xA1, 0x81}:
        return _names_algorithm(data, fields[1]) and bool(der_parts(data, *fields[2][1:]))
    if tags == [0x30, 0x04]:
        # Password-based schemes only; a digest or a plain algorithm there is no key.
        scheme = der_parts(data, *fields[0][1:]) or [(0, 0, 0)]
        arc = data[scheme[0][1] : scheme[0][2]]
        size = fields[1][2] - fields[1][1]
        return scheme[0][0] == 0x06 and arc.startswith(_PASSWORD_ARCS) and size >= 16 and size % 8 == 0
    return False


#: Object identifiers 1.2.840.113549.1.5 (PKCS#5) and 1.2.840.113549.1.12 (PKCS#12) as encoded.
_PASSWORD_ARCS = (b"\x2a\x86\x48\x86\xf7\x0d\x01\x05", b"\x2a\x86\x48\x86\xf7\x0d\x01\x0c")


def _names_algorithm(data: bytes, field: tuple[int, int, int]) -> bool:
    parts = der_parts(data, *field[1:])
    return bool(parts) and parts[0][0] == 0x06 and parts[0][2] > parts[0][1]


_SSH_MAGIC = b"openssh-key-v1\0"


def ssh_key_length(data: bytes) -> int | None:
    """Bytes of the OpenSSH private key that ``data`` begins with; None if its lengths don't fit."""

    if not data.startswith(_SSH_MAGIC):
        return None
    at = len(_SSH_MAGIC)

    def number() -> int | None:
        nonlocal at
        at += 4
        return int.from_bytes(data[at - 4 : at], "big") if at <= len(data) else None

    def string() -> bytes | None:
        nonlocal at
        size = number()
        if size is None or at + size > len(data):
            return None
        at += size
        return data[at - size : at]

    cipher, kdf, options, keys = string(), string(), string(), number()
    if not cipher or not kdf or options is None or keys is None or not 1 <= keys <= 64:
        return None
    public = [string() for _ in range(keys)]
    secret = string()
    if None in public or not secret or len(secret) % 8:
        return None
    if cipher == b"none" and secret[:4] != secret[4:8]:
        return None  # the two check numbers of an open key
    return at


# Candidates

_BREAK = r"(?:[ \t]*(?:\r?\n|(?:\\r)?\\n)[ \t]*)"
_LINE = re.compile(r"[A-Za-z0-9+/]+")
_NEXT_LINE = re.compile(_BREAK + r"(?=[A-Za-z0-9+/=])")
_RUN = re.compile(r"[A-Za-z0-9+/]+={0,2}")
#: Encoded beginnings: a DER sequence, the OpenSSH magic, and the dashes of a PEM block.
_KEY_START = re.compile(r"(?:(?<![A-Za-z0-9+/])|(?<=\\n))(?:M[C-I][A-Za-z0-9+/]{30}|b3BlbnNzaC1rZXktdjEA|LS0tLS1CRUdJTi)")
_HEX_KEY_START = re.compile(r"(?<![0-9A-Za-z])(?:30[0-9a-fA-F]{30}|2[dD]2[dD]2[dD]2[dD]2[dD]424547494[eE])")
_HEX_RUN = re.compile(r"[0-9a-fA-F]+")
_LOCKED = re.compile(
    r"-----BEGIN [A-Z0-9 ]{0,40}PRIVATE KEY-----" + _BREAK + r"Proc-Type: 4,ENCRYPTED" + _BREAK
    + r"DEK-Info: [A-Z0-9-]{3,40},(?P<vector>[0-9A-F]+)" + _BREAK + "{2}"
)
_TOKEN_START = re.compile(r"(?<![A-Za-z0-9_-])eyJ[A-Za-z0-9_-]+(?=\.)")
_TOKEN_PART = re.compile(r"\.([A-Za-z0-9_-]+)")
#: Signature bytes of the registered algorithms; the RSA ones follow the key, of 1024 bits at least.
_SIGNATURE_BYTES = {"HS256": 32, "HS384": 48, "HS512": 64, "ES256": 64, "ES256K": 64, "ES384": 96, "ES512": 132, "EDDSA": 64}


def take_base64(text: str, start: int, n_bytes: int) -> tuple[bytes, int] | None:
    """The ``n_bytes`` that base64 lines from ``start`` hold, and where they end.

    None if there are fewer, or if more follow directly.
    """

    left, at, parts = -(-n_bytes * 8 // 6), start, []
    while left:
        line = _LINE.match(text, at)
        if line is None or line.end() - at > left:
            return None
        parts.append(line[0])
        left -= line.end() - at
        at = line.end()
        if left:
            gap = _NEXT_LINE.match(text, at)
            if gap is None:
                return None
            at = gap.end()
    joined = "".join(parts)
    missing = -len(joined) % 4
    while missing and text[at : at + 1] == "=":
        at, missing = at + 1, missing - 1
    if text[at : at + 1] == "=":
        return None
    data = _decoded(joined)
    return (data, at) if len(data) == n_bytes else None


def _decoded(letters: str) -> bytes:
    """Bytes of base64 without padding; a last letter that makes no byte is left out."""

    whole = letters[:-1] if len(letters) % 4 == 1 else letters
    return base64.b64decode(whole + "=" * (-len(whole) % 4))


def _open_run(text: str, start: int) -> bytes:
    """The bytes that base64 lines from ``start`` hold, as far as a key can reach."""

    parts, at, stop = [], start, start + 2 * MAX_KEY_BYTES
    while at < stop and (line := _LINE.match(text, at, stop)):
        parts.append(line[0])
        gap = _NEXT_LINE.match(text, line.end())
        if gap is None:
            break
        at = gap.end()
    return _decoded("".join(parts))


def _holds_key(data: bytes, depth: int) -> bool:
    if depth >= MAX_NESTING or b"PRIVATE KEY-----" not in data:
        return False
    return next(key_spans(data.decode("utf-8", "replace"), depth + 1), None) is not None


def _base64_key(text: str, found: re.Match, depth: int) -> int | None:
    """End of the key whose base64 begins at a candidate."""

    start = found.start()
    if found[0].startswith("LS0"):
        run = _RUN.match(text, start)
        return run.end() if _holds_key(_decoded(run[0].rstrip("=")), depth) else None
    if found[0].startswith("b3B"):
        size = ssh_key_length(_open_run(text, start))
        taken = take_base64(text, start, size) if size else None
        return taken[1] if taken else None
    opening = base64.b64decode(found[0])
    header = der_header(opening)
    if header is None or header[0] != 0x30 or header[2] > MAX_KEY_BYTES:
        return None
    if opening[header[1] : header[1] + 2] != b"\x02\x01" and opening[header[1]] != 0x30:
        return None  # neither a version nor the scheme of an encrypted key
    taken = take_base64(text, start, header[1] + header[2])
    return taken[1] if taken and is_private_key(taken[0]) else None


def _hex_key(text: str, found: re.Match, depth: int) -> int | None:
    run = _HEX_RUN.match(text, found.start())
    if len(run[0]) % 2 or text[run.end() : run.end() + 1].isalnum():
        return None
    data = binascii.unhexlify(run[0])
    return run.end() if (len(data) <= MAX_KEY_BYTES and is_private_key(data)) or _holds_key(data, depth) else None


def _locked_key(text: str, found: re.Match) -> int | None:
    vector, at = found["vector"], found.end()
    size = 0
    while line := _LINE.match(text, at):
        size, at = size + line.end() - at, line.end()
        gap = _NEXT_LINE.match(text, at)
        if gap is None:
            break
        at = gap.end()
    while text[at : at + 1] == "=":
        at += 1
    block, n_bytes = len(vector) // 2, size * 6 // 8
    closed = re.match(_BREAK + "-----END ", text[at : at + 40])
    return at if closed and block in (8, 16) and len(vector) % 2 == 0 and n_bytes and n_bytes % block == 0 else None


def _candidates(text: str, pattern: re.Pattern, confirm) -> Iterator[tuple[int, int]]:
    """Confirmed candidates that don't overlap; after a refused one the search goes on behind its start."""

    at = 0
    while found := pattern.search(text, at):
        end = confirm(text, found)
        if end is not None:
            yield found.start(), end
        at = end or found.end()


def key_spans(text: str, depth: int = 0) -> Iterator[Span]:
    """Private keys that decode and parse."""

    ways = [
        (_KEY_START, lambda t, found: _base64_key(t, found, depth)),
        (_HEX_KEY_START, lambda t, found: _hex_key(t, found, depth)),
    ]
    if "ENCRYPTED" in text:
        ways.append((_LOCKED, _locked_key))
    for pattern, confirm in ways:
        for start, end in _candidates(text, pattern, confirm):
            yield "key", start, end


def _json_object(part: str) -> dict | None:
    try:
        value = json.loads(base64.urlsafe_b64decode(part + "=" * (-len(part) % 4)))
    except (ValueError, RecursionError):
        return None
    return value if isinstance(value, dict) else None


def _token_end(text: str, found: re.Match) -> int | None:
    header = _json_object(found[0])
    algorithm = header.get("alg") if header else None
    if not isinstance(algorithm, str) or algorithm.lower() == "none":
        return None
    parts, at = [], found.end()
    for _ in range(4 if isinstance(header.get("enc"), str) else 2):
        part = _TOKEN_PART.match(text, at)
        if part is None:
            # A directly used key leaves the second of five parts empty.
            if len(parts) == 0 and algorithm.lower() == "dir" and text[at : at + 2] == "..":
                parts.append("")
                at += 1
                continue
            return None
        parts.append(part[1])
        at = part.end()
    if len(parts) == 4:
        return at
    if any(len(part) % 4 == 1 for part in parts) or _json_object(parts[0]) is None:
        return None
    size = len(parts[1]) * 6 // 8
    wanted = _SIGNATURE_BYTES.get(algorithm.upper())
    fits = size == wanted if wanted else size >= (128 if algorithm[:2].upper() in ("RS", "PS") else 16)
    return at if fits else None


def token_spans(text: str) -> Iterator[Span]:
    """Signed or encrypted tokens whose header and lengths hold."""

    if "eyJ" in text:
        for start, end in _candidates(text, _TOKEN_START, _token_end):
            yield "jwt", start, end


def all_spans(text: str) -> list[Span]:
    """Base and confirmed spans by start, then kind as listed, then end; code points, end exclusive."""

    found = [*base_spans(text), *key_spans(text), *token_spans(text)]
    return sorted(found, key=lambda span: (span[1], KINDS.index(span[0]), span[2]))


SPANS = "array<struct<kind:string,start:long,end:long>>"
_SPAN = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())])


def find_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, spans) of every row, spans as (kind, start, end) in the order of ``all_spans``.

    A null or empty text has no spans; a null id stays null; repeated rows give repeated results; other
    columns play no part and aren't returned; an empty table gives no rows. Texts are read whole.
    """

    ready(docs.sparkSession)
    narrow = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    kind = narrow.schema["id"].dataType.simpleString()

    def scan(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        spans = [
            [dict(zip(("kind", "start", "end"), span)) for span in all_spans(text.as_py() or "")]
            for text in batch.column(1)
        ]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(spans, pa.list_(_SPAN))], ["id", "spans"])

    found = map_rows(narrow, scan, f"id {kind}, spans {SPANS}")
    return found.select(F.col("id").alias(id_col), "spans")


def joined(spans: Column) -> Column:
    """Spans as comma-joined ``kind:start:end``."""

    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def of_kind(spans: Column, *kinds: str) -> Column:
    return F.filter(spans, lambda s: s["kind"].isin(*kinds))
