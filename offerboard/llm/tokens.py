"""Token counts by byte-pair merging on a heap and a linked list (operator 2).

A text is cut into pre-tokens by the vocabulary's split pattern. Each distinct
pre-token becomes a linked list of byte symbols; a heap holds its adjacent
pairs by merge rank. The lowest pair is popped and merged until none is left:
the count is the initial symbols minus the merges. No identifier is emitted.
"""

from __future__ import annotations

import json
from heapq import heapify, heappop, heappush

import public_tokenizers
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import ship

ship(__name__)

VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")
CACHE = 1_000_000      # pre-tokens whose count a worker keeps; beyond it the cache starts anew


def _byte_letters() -> dict[str, int]:
    """The printable letter that byte-level vocabularies write for each byte."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    out, extra = {chr(b): b for b in plain}, 256
    for b in range(256):
        if b not in plain:
            out[chr(extra)] = b
            extra += 1
    return out


class PairMerger(dict):
    """Pre-token -> number of tokens; a missing pre-token is merged on a heap."""

    def __init__(self, path: str = VOCABULARY):
        with open(path, encoding="utf-8") as f:
            model = json.load(f)
        self.specials = [t["content"] for t in model["added_tokens"]]
        byte = _byte_letters()
        number: dict[bytes, int] = {bytes([b]): b for b in range(256)}
        pairs = {}
        raw = lambda s: bytes(byte[c] for c in s)
        for rank, (a, b) in enumerate(model["model"]["merges"]):
            a, b = raw(a), raw(b)
            made = number.setdefault(a + b, len(number))
            # one integer key a pair; the value holds rank and product
            pairs.setdefault((number[a] << 20) | number[b], (rank << 20) | made)
        self.pairs = pairs
        self.split = regex.compile(public_tokenizers.PATTERN).findall
        self.at_special = regex.compile("|".join(map(regex.escape, self.specials))) if self.specials else None

    def __missing__(self, word: str) -> int:
        n = self.merged(word.encode("utf-8"))
        if len(self) >= CACHE:
            self.clear()
        if len(word) <= 64:
            self[word] = n
        return n

    def merged(self, data: bytes) -> int:
        """Symbols left after all merges: heap of adjacent pairs, linked list of symbols.

        A heap entry is rank, position and product in one integer; it is stale
        when the pair at its position no longer gives that rank.
        """
        size = len(data)
        if size < 2:
            return size
        pairs, symbol, width = self.pairs.get, list(data), size.bit_length()
        heap, mask = [], (1 << width) - 1
        for i in range(size - 1):
            p = pairs((symbol[i] << 20) | symbol[i + 1])
            if p is not None:
                heap.append(((p >> 20) << width | i) << 20 | p & 0xFFFFF)
        if not heap:
            return size
        heapify(heap)
        after, before = list(range(1, size + 1)), list(range(-1, size - 1))
        left = size
        while heap:
            top = heappop(heap)
            i = top >> 20 & mask
            a = symbol[i]
            if a < 0:
                continue
            j = after[i]
            if j >= size:
                continue
            p = pairs(a << 20 | symbol[j])
            if p is None or p != (top >> 20 >> width) << 20 | top & 0xFFFFF:
                continue
            made = p & 0xFFFFF
            symbol[i], symbol[j] = made, -1
            left -= 1
            k = after[i] = after[j]
            if k < size:
                before[k] = i
                p = pairs(made << 20 | symbol[k])
                if p is not None:
                    heappush(heap, ((p >> 20) << width | i) << 20 | p & 0xFFFFF)
            h = before[i]
            if h >= 0:
                p = pairs(symbol[h] << 20 | made)
                if p is not None:
                    heappush(heap, ((p >> 20) << width | h) << 20 | p & 0xFFFFF)
        return left

    def count(self, text: str) -> int:
        """Tokens of one whole text; special strings count as one token each."""
        parts = self.at_special.split(text) if self.at_special and any(s in text for s in self.specials) else [text]
        get = self.__getitem__
        return len(parts) - 1 + sum(sum(map(get, self.split(p))) for p in parts)


_MERGERS: dict[str, PairMerger] = {}


def _merger(path: str) -> PairMerger:
    if path not in _MERGERS:
        _MERGERS[path] = PairMerger(path)
    return _MERGERS[path]


def token_counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 vocabulary: str = VOCABULARY, limit: int = 1024) -> DataFrame:
    """(id, n_bytes, n_tokens, over_limit) for every row of ``docs``; no shuffle.

    Null and empty texts count 0 bytes and 0 tokens. Repeated rows give
    repeated results, an empty table gives none, and other columns are not
    read. The vocabulary file must be readable on every executor.
    """
    def count(batches):
        merger = _merger(vocabulary)
        for b in batches:
            n = [merger.count(t) if t else 0 for t in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(2), pa.array(n, pa.int64())],
                                             names=["id", "n_bytes", "n_tokens"])

    kind = docs.schema[id_col].dataType.simpleString()
    text = F.coalesce(F.col(text_col), F.lit(""))
    out = (docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"),
                       F.octet_length(text).cast("long").alias("n_bytes"))
           .mapInArrow(count, f"id {kind}, n_bytes long, n_tokens long"))
    return out.select(F.col("id").alias(id_col), "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))
