"""Secret scans with structural confirmation.

Text patterns find what looks like a credential; encoded candidates (base64, base64url, hex) are decoded and
parsed before they are reported: signed tokens need a JSON header naming an algorithm, DER keys need nested
lengths that add up and the fields of a private key, OpenSSH blobs need the private container with length-prefixed
fields, PEM blocks need a label of a private key as well, and other encoded data is reported only when its plain form
names a credential itself. Public keys and certificates are no secrets and are not reported.

Edge cases: a null text counts as empty and has no spans; spans are code points, end exclusive; every pattern is
linear in the text, however long its runs are; repeated rows give repeated results; other columns of the input pass
through ``redact`` untouched and never clash.
"""

from __future__ import annotations

import base64
import binascii
import hashlib
import json
import re
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from agrispark.llm.common import mapped, table

BASE_KINDS = ("assign", "access", "hex")
KINDS = (*BASE_KINDS, "jwt", "pem", "der", "ssh", "encoded")

ASSIGN = re.compile(
    r"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", re.IGNORECASE | re.ASCII
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
#: A maximal run of 24 or more is what the shorter pattern finds once short matches are dropped.
HEX = re.compile(r"[0-9a-f]{24,}")
#: Runs are entered at their start only and never given back, so a long one is read once.
JWT = re.compile(r"(?<![A-Za-z0-9_-])(ey[A-Za-z0-9_-]{6,}+)\.([A-Za-z0-9_-]{2,}+)\.[A-Za-z0-9_-]*+")
PEM = re.compile(r"-----BEGIN ([A-Z0-9 ]{1,60})-----")
PEM_BODY = re.compile(r"\s*+((?:[A-Za-z0-9-]++:[^\n]*+\n)*+)([A-Za-z0-9+/=\s]++)\Z")
ENCODED = re.compile(r"[A-Za-z0-9+/_-]{24,}={0,2}")
HEX_ANY = re.compile(r"[0-9A-Fa-f]+\Z")


def decoded(text: str) -> bytes | None:
    """Bytes of base64 or base64url text, padding optional; None when it is neither."""
    text = "".join(text.split()).rstrip("=").replace("-", "+").replace("_", "/")
    try:
        return base64.b64decode(text + "=" * (-len(text) % 4), validate=True)
    except (binascii.Error, ValueError):
        return None


def der_fills(data: bytes, depth: int = 0) -> bool:
    """Whether the bytes are a chain of DER elements whose nested lengths add up exactly."""
    at = 0
    while at < len(data):
        if at + 2 > len(data) or depth > 8:
            return False
        tag, size = data[at], data[at + 1]
        at += 2
        if size & 0x80:
            more = size & 0x7F
            if not 1 <= more <= 4 or at + more > len(data):
                return False
            size = int.from_bytes(data[at : at + more], "big")
            at += more
        if at + size > len(data) or tag & 0x1F == 0x1F:
            return False
        if tag & 0x20 and not der_fills(data[at : at + size], depth + 1):
            return False
        at += size
    return at == len(data)


def der_fields(data: bytes) -> list[tuple[int, bytes]]:
    """``(tag, content)`` of the elements of DER data that ``der_fills`` has accepted."""
    at, found = 0, []
    while at < len(data):
        size, more = data[at + 1], 0
        if size & 0x80:
            more = size & 0x7F
            size = int.from_bytes(data[at + 2 : at + 2 + more], "big")
        found.append((data[at], data[at + 2 + more : at + 2 + more + size]))
        at += 2 + more + size
    return found


def is_der_key(data: bytes) -> bool:
    """A DER SEQUENCE that fills the data with the fields of a private key.

    These are a version 0 or 1, then eight or more INTEGERs (RSA), five (DSA), an OCTET STRING (EC) or an algorithm and an
    OCTET STRING (PKCS 8); or an algorithm and an OCTET STRING alone (encrypted).
    """
    if len(data) < 16 or data[0] != 0x30 or not der_fills(data):
        return False
    top = der_fields(data)
    if len(top) != 1:
        return False
    fields = der_fields(top[0][1])
    tags = [t for t, _ in fields]
    if tags == [0x30, 0x04]:
        return True
    if len(fields) < 2 or tags[0] != 0x02 or fields[0][1] not in (b"\0", b"\1"):
        return False
    return tags[1] == 0x04 or tags[1:3] == [0x30, 0x04] or len(tags) >= 6 and set(tags[:6]) == {0x02}


def is_ssh_key(data: bytes) -> bool:
    """An OpenSSH private container: its magic, then cipher, key derivation and options as length-prefixed fields."""
    if not data.startswith(b"openssh-key-v1\0"):
        return False
    at = 15
    for _ in range(3):
        size = int.from_bytes(data[at : at + 4], "big")
        at += 4 + size
        if at > len(data) - 4:
            return False
    return int.from_bytes(data[at : at + 4], "big") >= 1


def is_private_pem(label: str, body: str) -> bool:
    """Whether a PEM block of this label holds a private key, in the clear or encrypted under headers."""
    m = PEM_BODY.match(body) if label.endswith("PRIVATE KEY") else None
    data = decoded(m[2]) if m else None
    if not data:
        return False
    return is_der_key(data) or is_ssh_key(data) or "ENCRYPTED" in m[1] and len(data) >= 32 and len(data) % 8 == 0


def private_pems(text: str) -> list[tuple[str, int, int]]:
    found, at = [], 0
    while m := PEM.search(text, at):
        end = f"-----END {m[1]}-----"
        dashes = text.find("-----", m.end())
        at = m.end()
        if dashes >= 0 and text.startswith(end, dashes) and is_private_pem(m[1], text[m.end() : dashes]):
            at = dashes + len(end)
            found.append(("pem", m.start(), at))
    return found


def is_signed_token(header: str, payload: str) -> bool:
    for part, need in ((header, "alg"), (payload, None)):
        try:
            parsed = json.loads(decoded(part) or b"-")
        except (ValueError, RecursionError):
            return False
        if not isinstance(parsed, dict) or need and need not in parsed:
            return False
    return True


def names_secret(data: bytes) -> bool:
    """Whether decoded data is plain text that itself holds an assignment or an access key."""
    try:
        plain = data.decode("utf-8")
    except UnicodeDecodeError:
        return False
    return any(len(m[2]) >= 6 for m in ASSIGN.finditer(plain)) or any(len(m[0]) >= 20 for m in ACCESS.finditer(plain))


def confirmed(text: str) -> str | None:
    """The kind that an encoded candidate proves to be."""
    forms = [decoded(text)]
    if HEX_ANY.match(text) and len(text) % 2 == 0:
        forms.append(bytes.fromhex(text))
    for data in forms:
        if data:
            if is_der_key(data):
                return "der"
            if is_ssh_key(data):
                return "ssh"
            if names_secret(data):
                return "encoded"
    return None


def find_secrets(text: str) -> list[tuple[str, int, int]]:
    """``(kind, start, end)`` by start, then kind as listed."""
    found = [("assign", *m.span()) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    if "AKIA" in text:
        found += [("access", *m.span()) for m in ACCESS.finditer(text) if len(m[0]) >= 20]
    found += [("hex", *m.span()) for m in HEX.finditer(text)]
    found += [("jwt", *m.span()) for m in JWT.finditer(text) if is_signed_token(m[1], m[2])]
    if "-----BEGIN" in text:
        found += private_pems(text)
    taken = sorted((s, e) for k, s, e in found if k in ("jwt", "pem"))
    ends, at = list(accumulate((e for _, e in taken), max)), 0
    for m in ENCODED.finditer(text):
        while at < len(taken) and ends[at] <= m.start():
            at += 1
        if (at == len(taken) or taken[at][0] >= m.end()) and (kind := confirmed(m[0])):
            found.append((kind, *m.span()))
    return sorted(found, key=lambda x: (x[1], KINDS.index(x[0]), x[2]))


def listed(spans: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{k}:{s}:{e}" for k, s, e in spans)


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: its spans as an array of (kind, start, end)."""
    kind = docs.schema[id_col].dataType.simpleString()
    spans_type = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))

    def run(batch: pa.RecordBatch):
        spans = [
            [{"kind": k, "start": s, "end": e} for k, s, e in find_secrets(t or "")] for t in batch.column(1).to_pylist()
        ]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(spans, spans_type)], names=[id_col, "spans"])

    return mapped(
        docs.select(id_col, text_col), run, f"`{id_col}` {kind}, spans array<struct<kind:string,start:bigint,end:bigint>>"
    )


def redact_text(text: str) -> str:
    """The text with each reported span replaced by a marker; overlapping spans share the first one's marker."""
    out, at = [], 0
    for kind, start, end in find_secrets(text):
        if start >= at:
            out += [text[at:start], f"[{kind}]"]
        at = max(at, end)
    return "".join([*out, text[at:]])


def redact(docs: DataFrame, text_col: str = "text", length_col: str | None = "n_chars") -> DataFrame:
    """All rows and columns; reported secrets are replaced in the text and its length is set anew."""
    names, lengths = docs.columns, length_col in docs.columns

    def run(batch: pa.RecordBatch):
        new = [None if t is None else redact_text(t) for t in batch.column(names.index(text_col)).to_pylist()]
        columns = list(batch.columns)
        columns[names.index(text_col)] = pa.array(new, pa.string())
        if lengths:
            at = names.index(length_col)
            old = batch.column(at)
            columns[at] = pa.array(
                [o if n is None else len(n) for n, o in zip(new, old.to_pylist(), strict=True)], old.type
            )
        yield pa.RecordBatch.from_arrays(columns, names=names)

    return mapped(docs, run, docs.schema)


def op8_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digest columns of :func:`scan` over all documents."""
    schema = (
        "doc_id bigint, n_assign bigint, n_access bigint, n_hex bigint, base_sha256 string, spans string"
    )

    def run(batch: pa.RecordBatch):
        rows = []
        for spans in batch.column(1).to_pylist():
            all_spans = [(x["kind"], x["start"], x["end"]) for x in spans]
            base = [x for x in all_spans if x[0] in BASE_KINDS]
            counts = [sum(x[0] == k for x in base) for k in BASE_KINDS]
            rows.append((*counts, hashlib.sha256(listed(base).encode()).hexdigest(), listed(all_spans)))
        columns = list(zip(*rows, strict=True)) or [[]] * 5
        types = [pa.int64()] * 3 + [pa.string()] * 2
        yield pa.RecordBatch.from_arrays(
            [batch.column(0).cast(pa.int64()), *(pa.array(c, t) for c, t in zip(columns, types, strict=True))],
            names=["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"],
        )

    return mapped(scan(table(spark, sf_dir, "documents")), run, schema)


def secrets_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return redact(docs)
