"""Token counts: how many tokens a tokenizer file gives each text, without moving any token.

Method: batch encoding in Arrow functions that return lengths only. Texts go to the tokenizer in batches of equal bytes.
A text is split at spaces and line feeds, which this kind of tokenizer drops and across which nothing joins, so the
pieces of a long text are counted one by one; a piece seen before is not encoded again. The memory for pieces is bounded.

Rows: one per input row, also for repeated rows. Null and empty texts have 0 bytes and 0 tokens. Null ids stay null.
"""

from __future__ import annotations

import os
import re
from itertools import chain

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderwell.llm.common import arrow_map, read

#: Pieces remembered per worker, and the longest that is worth it.
REMEMBERED = 200_000
WORTH = 32

#: After a word of basic letters, one of these is a pre-token of its own.
STOPS = (".", ",")
PLAIN = re.compile("[A-Za-zÀ-ÖØ-öø-ÿ]+").fullmatch

SCHEMA = "doc_id long, n_bytes long, n_tokens long, over_limit boolean"


class Counter:
    """Counts tokens with one tokenizer; keeps the lengths of common pieces."""

    def __init__(self, vocabulary: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(vocabulary)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.known: dict[str, int] = {}

    def lengths(self, pieces: list[str]) -> list[int]:
        encoded = self.tokenizer.encode_batch_fast(pieces, add_special_tokens=False)
        return [len(e.ids) for e in encoded]

    def learn(self, pieces: list[str]) -> dict[str, int]:
        """The lengths of new pieces. Between a plain word and a stop or comma after it lies a safe boundary too."""
        words = [p[:-1] if p[-1:] in STOPS and PLAIN(p[:-1]) else p for p in pieces]
        every = list({w for w in words if w not in self.known} | {s for s in STOPS if s not in self.known})
        found = dict(zip(every, self.lengths(every), strict=True))
        size = lambda w: found[w] if w in found else self.known[w]
        found.update({p: size(w) + size(p[-1]) for p, w in zip(pieces, words, strict=True) if len(w) < len(p)})
        return found

    def count(self, texts: list[str | None]) -> list[int]:
        parts = [t.replace("\n", " ").split(" ") if t else [] for t in texts]
        if len(self.known) > REMEMBERED:
            self.known = {}
        known = self.known
        new = list(set(chain.from_iterable(parts)).difference(known))
        known.update(self.learn(new))
        out = [sum(map(known.__getitem__, part)) for part in parts]
        for p in new:
            if len(p) > WORTH:
                del known[p]
        return out


_COUNTERS: dict[str, Counter] = {}


def counter_of(vocabulary: str) -> Counter:
    """One counter per Python worker, which later tasks find with what it remembers."""
    if vocabulary not in _COUNTERS:
        _COUNTERS[vocabulary] = Counter(vocabulary)
    return _COUNTERS[vocabulary]


def token_counts(documents: DataFrame, vocabulary: str, limit: int = 2048) -> DataFrame:
    """doc_id, n_bytes (UTF-8), n_tokens, over_limit (n_tokens > limit) for each row of documents(doc_id, text).

    `vocabulary` is the path of a tokenizers .json file whose pre-tokenizer drops white space.
    """

    def setup():
        counter = counter_of(vocabulary)

        def work(batch: pa.RecordBatch) -> dict:
            texts = batch.column("text").to_pylist()
            counts = counter.count(texts)
            return {
                "doc_id": batch.column("doc_id"),
                "n_bytes": [len(t.encode()) if t else 0 for t in texts],
                "n_tokens": counts,
                "over_limit": [n > limit for n in counts],
            }

        return work

    docs = documents.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return arrow_map(docs, setup, SCHEMA)


def op10_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    import public_tokenizers

    return token_counts(read(spark, folder, "documents"), public_tokenizers.path("word_bpe_49k.json"))
