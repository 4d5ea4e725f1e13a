"""SentencePiece encoding and decoding by a table of distinct chunks (operator 13).

A normalised text is a chain of marked words: white-space markers, then other
characters. If no piece of the model holds a marker behind another character,
no merge crosses the start of a marked word, so each distinct one is segmented
once and the texts' ids are joined back from that table by position. Decoding
gathers the bytes of the pieces by position.
"""

from __future__ import annotations

import re
from itertools import chain

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from sentencepiece import SentencePieceProcessor

from .common import ship

ship(__name__)

MODEL = public_tokenizers.path("piece_bpe_32k.model")
MARK = "▁"
SLICE = 1 << 20          # characters of a text that are cut into chunks at once (a single chunk may exceed it)
TABLE = 400_000          # chunks, and TABLE * 8 ids, that a worker keeps from batch to batch; beyond it the table starts anew
PROBE = " a   ﬁ Ａé\t\n "

CHUNK = re.compile(f"{MARK}+[^{MARK}]*|[^{MARK}]+")
START = re.compile(f"(?<!{MARK}){MARK}")


def gather(flat: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The ranges flat[start:start + length], one after another."""
    ends = np.cumsum(lengths)
    total = int(ends[-1]) if len(ends) else 0
    return flat[np.arange(total) + np.repeat(starts - (ends - lengths), lengths)]


class ChunkTable:
    """Distinct chunk -> its ids, for one model and worker."""

    def __init__(self, path: str = MODEL):
        self.model = SentencePieceProcessor(model_file=path)
        pieces = [self.model.id_to_piece(i) for i in range(self.model.get_piece_size())]
        # chunks are independent: no piece crosses a marker, and normalising only writes markers for blanks, one in front
        self.lone = self.model.piece_to_id(MARK)
        self.apart = (not any(START.search(p, 1) for p in pieces) and not self.model.is_unknown(self.lone)
                      and self.model.normalize(PROBE) == MARK + PROBE.replace(" ", MARK))
        self.plain = np.array([not (self.model.is_control(i) or self.model.is_unknown(i)) for i in range(len(pieces))])
        raw = [bytes([int(p[3:5], 16)]) if self.model.is_byte(i) else p.replace(MARK, " ").encode()
               for i, p in enumerate(pieces)]
        self.marked = np.array([p.startswith(MARK) for p in pieces])
        self.bytes = np.frombuffer(b"".join(raw), np.uint8)
        self.width = np.array([len(r) for r in raw])
        self.at = np.cumsum(self.width) - self.width
        self.clear()

    def clear(self) -> None:
        self.number: dict[str, int] = {}
        self.flat = np.empty(0, np.int32)
        self.start = self.length = np.empty(0, np.int64)

    def add(self, chunks: list[str]) -> None:
        """Segment new chunks; the model puts the first marker itself."""
        self.number.update(zip(chunks, range(len(self.number), len(self.number) + len(chunks))))
        found = self.model.encode([c[1:] for c in chunks], num_threads=1)
        if MARK in self.number and (i := self.number[MARK] - len(self.length)) >= 0:
            found[i] = [self.lone]          # the model puts no marker before an empty text
        length = np.fromiter(map(len, found), np.int64, len(found))
        self.start = np.append(self.start, len(self.flat) + np.cumsum(length) - length)
        self.length = np.append(self.length, length)
        self.flat = np.append(self.flat, np.fromiter(chain.from_iterable(found), np.int32, int(length.sum())))

    def ids_of(self, slices: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of normalised slices, and the number of ids of each slice."""
        words = [CHUNK.findall(t) for t in slices]
        if len(self.number) > TABLE or len(self.flat) > 8 * TABLE:
            self.clear()
        new = set().union(*words).difference(self.number)
        if new:
            self.add(list(new))
        counts = np.fromiter(map(len, words), np.int64, len(words))
        rows = np.fromiter(map(self.number.__getitem__, chain.from_iterable(words)), np.int64, int(counts.sum()))
        lengths = self.length[rows]
        before = np.append(0, np.cumsum(lengths))
        edge = np.append(0, np.cumsum(counts))
        return gather(self.flat, self.start[rows], lengths), before[edge[1:]] - before[edge[:-1]]

    def encode(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of whole texts one after another, and the number of ids of each text."""
        counts = np.zeros(len(texts), np.int64)
        if not self.apart:
            found = [self.model.encode(t or "", num_threads=1) for t in texts]
            counts[:] = [len(f) for f in found]
            return np.fromiter(chain.from_iterable(found), np.int32, int(counts.sum())), counts
        out, slices, owner, held = [np.empty(0, np.int32)], [], [], 0

        def flush():
            ids, n = self.ids_of(slices)
            out.append(ids)
            np.add.at(counts, owner, n)

        for i, t in enumerate(texts):
            if not t:
                continue
            norm, at = MARK + t.replace(" ", MARK), 0
            while at < len(norm):
                cut = START.search(norm, at + SLICE) if at + SLICE < len(norm) else None
                end = cut.start() if cut else len(norm)
                slices.append(norm[at:end])
                owner.append(i)
                held += end - at
                at = end
                if held >= SLICE:
                    flush()
                    slices, owner, held = [], [], 0
        if slices:
            flush()
        return np.concatenate(out), counts

    def decode(self, ids: np.ndarray, counts: np.ndarray) -> list[str]:
        """The text of each run of ids; runs with special pieces or stray bytes go through the model itself."""
        out, edge = [], np.append(0, np.cumsum(counts))
        for i in range(len(counts)):
            run = ids[edge[i]:edge[i + 1]]
            text = None
            if self.apart and len(run) and self.plain[run].all():
                parts = [gather(self.bytes, self.at[r], self.width[r]).tobytes()
                         for r in (run[a:a + SLICE] for a in range(0, len(run), SLICE))]
                try:
                    text = b"".join(parts).decode()[int(self.marked[run[0]]):]
                except UnicodeDecodeError:
                    pass
            out.append(self.model.decode(run.tolist()) if text is None else text)
        return out


_TABLES: dict[str, ChunkTable] = {}


def _table(path: str) -> ChunkTable:
    if path not in _TABLES:
        _TABLES[path] = ChunkTable(path)
    return _TABLES[path]


def encode(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", model: str = MODEL) -> DataFrame:
    """(id, ids array<int>) for every row of ``docs``: the whole text's pieces without begin and end ids; no shuffle.

    A null or empty text has no ids. Repeated rows give repeated results, an
    empty table gives none, other columns are not read. Memory is bounded by
    an Arrow batch, one text and the worker's chunk table, which starts anew
    at a fixed size. A model whose pieces cross markers, or that rewrites
    characters, is applied to whole texts. The model file must be readable on
    every executor.
    """
    def run(batches):
        table = _table(model)
        for b in batches:
            ids, counts = table.encode(b.column(1).to_pylist())
            ends = pa.array(np.append(0, np.cumsum(counts)).astype(np.int32))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.ListArray.from_arrays(ends, pa.array(ids))],
                                             names=["id", "ids"])

    kind = docs.schema[id_col].dataType.simpleString()
    out = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(run, f"id {kind}, ids array<int>")
    return out.select(F.col("id").alias(id_col), "ids")


def decode(encoded: DataFrame, id_col: str = "doc_id", ids_col: str = "ids", model: str = MODEL) -> DataFrame:
    """(id, ids, decoded) for every row: the text of the ids as the model decodes them; no shuffle.

    Null and empty lists give the empty text (the list stays as it is).
    Control ids give nothing, unknown ones the model's sign for them, bytes
    that are no UTF-8 the replacement character.
    """
    def run(batches):
        table = _table(model)
        for b in batches:
            lists = b.column(1)
            counts = np.asarray(lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False), np.int64)
            texts = table.decode(lists.flatten().to_numpy(zero_copy_only=False), counts)
            yield pa.RecordBatch.from_arrays([b.column(0), lists, pa.array(texts, pa.string())],
                                             names=["id", "ids", "decoded"])

    kind = encoded.schema[id_col].dataType.simpleString()
    out = (encoded.select(F.col(id_col).alias("id"), F.col(ids_col).alias("ids"))
           .mapInArrow(run, f"id {kind}, ids array<int>, decoded string"))
    return out.select(F.col("id").alias(id_col), F.col("ids").alias(ids_col), "decoded")
