"""Secret scan: keyword automaton, anchored expressions near its hits, checksums.

Method: an Aho-Corasick automaton finds fixed keywords in one pass over a text. Only at a hit is an anchored expression
tried. Tokens that carry a checksum count only if it is right: the last six base-62 digits of the hosting and package
registry tokens are the CRC-32 of what precedes them; the head of a web token must decode to a JSON object with "alg".
Runs of hex digits have no keyword and are found by their own linear expression.

Kinds. Base: assign (keyword, sign, value of 6 or more), access (20 or more characters), hex (24 or more). Added: registry
(checked tokens), webtoken, private_key (PEM blocks). Spans are code points, end exclusive, leftmost and not overlapping
within a kind; a match that fails its test is dropped and the search goes on after it. Every scan is linear in the text.

Rows: one per input row, also for repeated rows. Null and empty texts have no spans; null ids stay null.
"""

from __future__ import annotations

import base64
import binascii
import bisect
import json
import re
import string
import zlib

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderwell.llm.common import arrow_map, read, sha256

BASE_KINDS = ("assign", "access", "hex")
KINDS = (*BASE_KINDS, "registry", "webtoken", "private_key")

# Keywords and formats.
ASSIGN_WORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")
REGISTRY_WORDS = ("ghp_", "gho_", "ghu_", "ghs_", "ghr_", "npm_")
ASSIGN = re.compile(
    r"""(?:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII | re.IGNORECASE
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")
REGISTRY = re.compile(r"(?:gh[pousr]|npm)_([A-Za-z0-9]{30})([A-Za-z0-9]{6})(?![A-Za-z0-9])")
WEBTOKEN = re.compile(r"(eyJ[A-Za-z0-9_-]++)(?:\.[A-Za-z0-9_-]++\.[A-Za-z0-9_-]*+)?")
PEM_BEGIN = re.compile(r"-----BEGIN ([A-Z0-9 ]*PRIVATE KEY)-----")
PEM_END = re.compile(r"-----END ([A-Z0-9 ]*PRIVATE KEY)(?=-----)")
BASE62 = string.digits + string.ascii_uppercase + string.ascii_lowercase

Span = tuple[int, int, str]


def registry_checksum(body: str) -> str:
    """CRC-32 of the body as six base-62 digits."""
    n, digits = zlib.crc32(body.encode()), ""
    while n:
        n, d = divmod(n, 62)
        digits = BASE62[d] + digits
    return digits.rjust(6, "0")


def _is_web_token(head: str) -> bool:
    try:
        found = json.loads(base64.urlsafe_b64decode(head + "=" * (-len(head) % 4)))
    except (binascii.Error, ValueError, RecursionError):
        return False
    return isinstance(found, dict) and "alg" in found


def keyword_automaton():
    import ahocorasick

    auto = ahocorasick.Automaton()
    for kind, words in (
        ("assign", ASSIGN_WORDS),
        ("access", ("akia",)),
        ("registry", REGISTRY_WORDS),
        ("webtoken", ("eyj",)),
        ("private_key", ("-----begin ",)),
    ):
        for word in words:
            auto.add_word(word, (kind, len(word)))
    auto.make_automaton()
    return auto


#: Lower-cases A-Z and nothing else, so that offsets stay.
LOWER = {ord(c): c.lower() for c in string.ascii_uppercase}


def lower_ascii(text: str) -> str:
    return text.lower() if text.isascii() else text.translate(LOWER)


class Scanner:
    def __init__(self):
        self.automaton = keyword_automaton()

    def scan(self, text: str | None) -> list[Span]:
        """(start, end, kind) of all secrets, by start, then in the order of KINDS."""
        if not text:
            return []
        hits: dict[str, list[int]] = {}
        for end, (kind, size) in self.automaton.iter(lower_ascii(text)):
            hits.setdefault(kind, []).append(end - size + 1)
        found = [(m.start(), m.end(), "hex") for m in HEX.finditer(text)]
        for kind, starts in hits.items():
            found += getattr(self, "_" + kind)(text, sorted(starts))
        return sorted(found, key=lambda s: (s[0], KINDS.index(s[2])))

    @staticmethod
    def _anchored(text: str, starts: list[int], pattern: re.Pattern, good, kind: str) -> list[Span]:
        found, past = [], 0
        for at in starts:
            if at >= past and (m := pattern.match(text, at)):
                past = m.end()
                if good(m):
                    found.append((at, past, kind))
        return found

    def _assign(self, text, starts):
        return self._anchored(text, starts, ASSIGN, lambda m: len(m[1]) >= 6, "assign")

    def _access(self, text, starts):
        return self._anchored(text, starts, ACCESS, lambda m: m.end() - m.start() >= 20, "access")

    def _registry(self, text, starts):
        return self._anchored(text, starts, REGISTRY, lambda m: registry_checksum(m[1]) == m[2], "registry")

    def _webtoken(self, text, starts):
        # a head without its two further parts is passed over whole: what begins inside it ends like it
        good = lambda m: m.end() > m.end(1) and _is_web_token(m[1])
        return self._anchored(text, starts, WEBTOKEN, good, "webtoken")

    def _private_key(self, text, starts):
        ends: dict[str, list[int]] = {}
        for m in PEM_END.finditer(text):
            ends.setdefault(m[1], []).append(m.start())
        found, past = [], 0
        for at in starts:
            if at >= past and (m := PEM_BEGIN.match(text, at)):
                past = m.end()
                closing = ends.get(m[1], [])
                if (i := bisect.bisect_left(closing, past)) < len(closing):
                    past = closing[i] + len(f"-----END {m[1]}-----")
                    found.append((at, past, "private_key"))
        return found


def listed(spans: list[Span]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for start, end, kind in spans)


def find_secrets(documents: DataFrame) -> DataFrame:
    """doc_id, spans array<struct<start, end, kind>> for each row of documents(doc_id, text)."""

    def setup():
        scanner = Scanner()

        def work(batch: pa.RecordBatch) -> dict:
            spans = [scanner.scan(t) for t in batch.column("text").to_pylist()]
            named = [[{"start": a, "end": b, "kind": k} for a, b, k in s] for s in spans]
            return {"doc_id": batch.column("doc_id"), "spans": named}

        return work

    docs = documents.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return arrow_map(docs, setup, "doc_id long, spans array<struct<start: int, end: int, kind: string>>")


def redact_secrets(text: str | None, spans: list[Span]) -> str | None:
    """The text with every span replaced by its kind in brackets; overlapping spans become one."""
    if not text:
        return text
    out, past = [], 0
    for start, end, kind in sorted(spans):
        if start >= past:
            out += [text[past:start], f"[{kind.upper()}]"]
        past = max(past, end)
    return "".join(out) + text[past:]


DIGEST = "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string"


def op9_secrets(spark: SparkSession, folder: str) -> DataFrame:
    def setup():
        scanner = Scanner()

        def work(batch: pa.RecordBatch) -> dict:
            every = [scanner.scan(t) for t in batch.column("text").to_pylist()]
            base = [[s for s in spans if s[2] in BASE_KINDS] for spans in every]
            out = {f"n_{k}": [sum(s[2] == k for s in spans) for spans in base] for k in BASE_KINDS}
            out["doc_id"] = batch.column("doc_id")
            out["base_sha256"] = [sha256(listed(spans)) for spans in base]
            out["spans"] = [listed(spans) for spans in every]
            return out

        return work

    docs = read(spark, folder, "documents").select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return arrow_map(docs, setup, DIGEST)
