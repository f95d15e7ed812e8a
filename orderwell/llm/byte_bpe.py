"""Byte-level BPE encoding and decoding through a sentencepiece model made from a rank file.

Method: a BPE model is serialised straight from the vocabulary. Each byte b stands for the character U+0100 + b, a
token is the string of its bytes, its score is the negative rank, normalisation is the identity. Sentencepiece then
merges in the order of the ranks, so the pieces of a pre-token are the tokens of the rank file. Pre-tokens (matches of a
pattern) are encoded separately; decoding maps ids back to bytes. Pre-tokens seen before are not encoded again.

Rows: one per input row, also for repeated rows. Null and empty texts have no tokens. Ids may be null and stay so.
"""

from __future__ import annotations

import base64
import struct
from collections.abc import Iterable
from copy import copy
from itertools import chain

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderwell.llm.common import arrow_map, read, sha256

#: Parts remembered per worker, and the longest that is worth it.
REMEMBERED = 200_000
WORTH = 32

#: A mark in front of a text, or a first part, before which no space was cut away.
WHOLE = "\0"

#: Stands for the ids of a part that must not be cut off.
UNCUT = (-1,)

UNKNOWN = "Ѐ"

#: Field numbers of the public model format (a protocol buffer).
PIECES, TRAINER, NORMALIZER = 1, 2, 3
MODEL_TYPE, VOCAB_SIZE, UNK_ID, BOS_ID, EOS_ID, PAD_ID, UNK_PIECE = 3, 4, 40, 41, 42, 43, 45
BPE, NORMAL_PIECE, UNKNOWN_PIECE = 2, 1, 2


def read_ranks(lines: Iterable[bytes]) -> list[bytes]:
    """The tokens in order of rank, from lines of base64 and rank. The ranks must be 0, 1, 2 and so on."""
    ranked = sorted((int(rank), base64.b64decode(token)) for token, rank in (x.split() for x in lines if x.strip()))
    if [r for r, _ in ranked] != list(range(len(ranked))):
        raise ValueError("ranks have gaps")
    return [t for _, t in ranked]


def _number(n: int) -> bytes:
    n &= (1 << 64) - 1
    out = bytearray()
    while n > 127:
        out.append(n & 127 | 128)
        n >>= 7
    return bytes(out + bytes([n]))


def _int(field: int, n: int) -> bytes:
    return _number(field << 3) + _number(n)


def _bytes(field: int, value: bytes) -> bytes:
    return _number(field << 3 | 2) + _number(len(value)) + value


def _piece(text: str, score: float, kind: int) -> bytes:
    return _bytes(PIECES, _bytes(1, text.encode()) + _number(2 << 3 | 5) + struct.pack("<f", score) + _int(3, kind))


def mapped(raw: bytes) -> str:
    return raw.decode("latin-1").translate(_SHIFT)


_SHIFT = {b: chr(0x100 + b) for b in range(256)}


def model(tokens: list[bytes]) -> bytes:
    """A serialised BPE model: ids are ranks, the unknown piece comes after them."""
    out = [_piece(mapped(t), float(-rank), NORMAL_PIECE) for rank, t in enumerate(tokens)]
    out.append(_piece(UNKNOWN, 0.0, UNKNOWN_PIECE))
    trainer = _int(MODEL_TYPE, BPE) + _int(VOCAB_SIZE, len(out)) + _int(UNK_ID, len(tokens))
    trainer += _int(BOS_ID, -1) + _int(EOS_ID, -1) + _int(PAD_ID, -1) + _bytes(UNK_PIECE, UNKNOWN.encode())
    # name, no dummy prefix, white space neither removed nor escaped
    normalizer = _bytes(1, b"identity") + _int(3, 0) + _int(4, 0) + _int(5, 0)
    return b"".join(out) + _bytes(TRAINER, trainer) + _bytes(NORMALIZER, normalizer)


def odd(part: str) -> bool:
    """Whether white space stood next to the space at either end of a part, or at either end of the text."""
    body = part[1:] if part[:1] in (WHOLE, "\n") else part
    return not body or body[0].isspace() or body[-1].isspace()


class Codec:
    """Encodes and decodes texts. `pattern` parts a text into pre-tokens."""

    def __init__(self, tokens: list[bytes], pattern: str):
        import regex
        import sentencepiece

        self.tokens = tokens
        self.model = sentencepiece.SentencePieceProcessor()
        self.model.LoadFromSerializedProto(model(tokens))
        self.split = regex.compile(pattern).findall
        self.known: dict[str, tuple[int, ...]] = {}

    def pieces(self, texts: list[str]) -> list[tuple[int, ...]]:
        """The ids of each text, every pre-token encoded once."""
        parts = [self.split(t) for t in texts]
        every = list({p for part in parts for p in part})
        encoded = self.model.encode([mapped(p.encode()) for p in every], num_threads=1)
        ids = dict(zip(every, encoded, strict=True))
        return [tuple(chain.from_iterable(map(ids.__getitem__, part))) for part in parts]

    def encode(self, texts: list[str | None]) -> list[list[int]]:
        """The ids of each text.

        A lone space or line feed between other characters always starts a pre-token, so texts are cut there and a
        cut-off part that was seen before is looked up. Texts with other runs of white space are not cut.
        """
        if len(self.known) > REMEMBERED:
            self.known = {}
        known = self.known
        cut: list[list[str]] = []
        for t in texts:
            parts = t.replace("\n", " \n").split(" ") if t else []
            if parts:
                parts[0] = WHOLE + parts[0]
            cut.append(parts)
        new = list(set(chain.from_iterable(cut)).difference(known))
        good = [p for p in new if not odd(p)]
        known.update(dict.fromkeys(new, UNCUT))
        plain = [p[1:] if p[0] == WHOLE else p if p[0] == "\n" else " " + p for p in good]
        known.update(zip(good, self.pieces(plain), strict=True))
        out = [list(chain.from_iterable(map(known.__getitem__, parts))) for parts in cut]
        whole = [i for i, ids in enumerate(out) if UNCUT[0] in ids]
        for i, ids in zip(whole, self.pieces([texts[i] for i in whole]), strict=True):
            out[i] = list(ids)
        for p in new:
            if len(p) > WORTH:
                del known[p]
        return out

    def decode(self, ids: Iterable[int]) -> bytes:
        return b"".join(map(self.tokens.__getitem__, ids))


_CODECS: dict[tuple[str, str], Codec] = {}


def codec_of(vocabulary: str, pattern: str) -> Codec:
    """The codec of a rank file for one task. The model is one per Python worker; what is remembered goes with the task."""
    if (vocabulary, pattern) not in _CODECS:
        with open(vocabulary, "rb") as lines:
            _CODECS[vocabulary, pattern] = Codec(read_ranks(lines), pattern)
    codec = copy(_CODECS[vocabulary, pattern])
    codec.known = {}
    return codec


def encode_texts(documents: DataFrame, vocabulary: str, pattern: str) -> DataFrame:
    """doc_id, ids array<int>, decoded binary for each row of documents(doc_id, text)."""

    def setup():
        codec = codec_of(vocabulary, pattern)

        def work(batch: pa.RecordBatch) -> dict:
            ids = codec.encode(batch.column("text").to_pylist())
            return {"doc_id": batch.column("doc_id"), "ids": ids, "decoded": [codec.decode(x) for x in ids]}

        return work

    docs = documents.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return arrow_map(docs, setup, "doc_id long, ids array<int>, decoded binary")


def digest_texts(documents: DataFrame, vocabulary: str, pattern: str) -> DataFrame:
    """As encode_texts, but with the number of ids and digests of ids and decoded bytes."""

    def setup():
        codec = codec_of(vocabulary, pattern)
        decimal = [str(i) for i in range(len(codec.tokens) + 1)]

        def work(batch: pa.RecordBatch) -> dict:
            ids = codec.encode(batch.column("text").to_pylist())
            return {
                "doc_id": batch.column("doc_id"),
                "n_tokens": [len(x) for x in ids],
                "ids_sha256": [sha256(",".join(map(decimal.__getitem__, x))) for x in ids],
                "decoded_sha256": [sha256(codec.decode(x)) for x in ids],
            }

        return work

    docs = documents.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return arrow_map(docs, setup, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")


def production(documents: DataFrame) -> DataFrame:
    import public_tokenizers

    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    return digest_texts(documents, path, public_tokenizers.PATTERN)


def op6_byte_bpe(spark: SparkSession, folder: str) -> DataFrame:
    return production(read(spark, folder, "documents"))
