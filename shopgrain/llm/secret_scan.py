"""Secrets in texts: fixed patterns, and strings that a tokenizer can't shorten."""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shopgrain.llm.common import text_of

KINDS = ("assign", "access", "hex", "dense")
KEYWORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    re.IGNORECASE | re.ASCII,
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]+")
LONG_HEX = re.compile(r"[0-9a-f]{16}")

#: Strings that are tried: long runs of the characters of keys in base 64 or its URL form.
CANDIDATE = re.compile(r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{16,}={0,2}(?![A-Za-z0-9+/_-])")
#: Known digests (MD5, SHA-1, SHA-224, SHA-256, SHA-384, SHA-512) and identifiers are not secrets. Only
#: digests in lower case: kind hex reports those, and none in upper case.
DIGEST = re.compile(r"(?:[0-9a-f]{32}|[0-9a-f]{40}|[0-9a-f]{56}|[0-9a-f]{64}|[0-9a-f]{96}|[0-9a-f]{128})")
IDENTIFIER = re.compile(
    r"[0-9a-f]{8}-(?:[0-9a-f]{4}-){3}[0-9a-f]{12}"  # UUID
    r"|[0-9_=+/-]+"  # numbers, dates, rulers
    r"|(?:[A-Za-z]{0,3}[0-9]+[_/=+-])+[A-Za-z]{0,3}[0-9]+",  # numbered parts
    re.I,
)
#: Words of one case, joined by marks, perhaps numbered; only their letters are looked at.
WORDS = re.compile(r"(?:(?:[a-z]+|[A-Z][a-z]*|[A-Z]+)[_/=+-]+)*(?:[a-z]+|[A-Z][a-z]*|[A-Z]+)[_/=+-]*[0-9]{0,4}=*")
LETTERS = re.compile(r"[A-Za-z]+")
#: Prose has about 4 characters a token, invented words mostly above 2; random strings have fewer.
MAX_CHARS_PER_TOKEN = 2.0
#: Lower limits for what looks like words, and for short strings, whose ratio varies more.
WORDS_LIMIT, SHORT_LIMIT, SHORT = 1.9, 1.8, 20


class Scanner:
    def __init__(self, vocabulary: str, limit: float = MAX_CHARS_PER_TOKEN):
        import base64

        import public_tokenizers
        import tiktoken

        with open(vocabulary, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}
        self.encoding = tiktoken.Encoding(
            "scan", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}
        )
        self.limit = limit

    def dense(self, candidate: str) -> bool:
        """Few characters a token, and neither a digest nor an identifier."""
        if DIGEST.fullmatch(candidate) or IDENTIFIER.fullmatch(candidate):
            return False
        parts, limit = [candidate], self.limit
        if WORDS.fullmatch(candidate):
            parts, limit = LETTERS.findall(candidate), min(limit, WORDS_LIMIT)
        if len(candidate) < SHORT:
            limit = min(limit, SHORT_LIMIT)
        tokens = sum(len(self.encoding.encode_ordinary(p)) for p in parts)
        return sum(map(len, parts)) <= limit * tokens

    def spans(self, text: str) -> list[tuple[int, str, int]]:
        """(start, kind, end) of every find, by start, then kind as listed."""
        found = []
        low = text.lower()
        if any(k in low for k in KEYWORDS):
            found += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 12]
        if "AKIA" in text:
            found += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if len(m[0]) >= 18]
        if LONG_HEX.search(text):
            found += [(m.start(), 2, m.end()) for m in HEX.finditer(text) if len(m[0]) >= 16]
        found += [(m.start(), 3, m.end()) for m in CANDIDATE.finditer(text) if self.dense(m[0])]
        return [(s, KINDS[k], e) for s, k, e in sorted(found)]


_SCANNERS: dict[tuple, Scanner] = {}


def scan(
    docs: DataFrame,
    vocabulary: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    limit: float = MAX_CHARS_PER_TOKEN,
) -> DataFrame:
    """``id`` and ``spans`` (kind, start, end in code points, end exclusive) of every row.

    Kinds ``assign``, ``access`` and ``hex`` are patterns; ``dense`` strings are those with at
    most ``limit`` characters a token. Null and empty texts have no spans; repeated rows are
    scanned each; an empty table gives no rows.
    """
    kind = docs.schema[id_col].dataType.simpleString()
    span = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key = (vocabulary, limit)
        scanner = _SCANNERS.get(key) or _SCANNERS.setdefault(key, Scanner(*key))
        for b in batches:
            found = [
                [{"kind": k, "start": s, "end": e} for s, k, e in scanner.spans(t.as_py())]
                for t in b.column(1)
            ]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(found, span)], names=["id", "spans"])

    rows = docs.select(F.col(id_col).alias("id"), text_of(text_col).alias("text"))
    return rows.mapInArrow(
        look, f"id {kind}, spans array<struct<kind: string, start: bigint, end: bigint>>"
    )
