"""Cost-balanced packing of token sequences (operator 3).

Every document becomes its token ids and one end id. Whole capacities are cut
off first and stand alone. The rest pieces of a window of documents are packed
together: the window's tokens fix the sequences (full ones, and power-of-two
ones for what is left, which need no padding). Pieces are then assigned in
descending length to the sequence of the lowest estimated attention cost
(linear plus quadratic in each piece) that still has room for them; a piece
that fits nowhere is cut to fill the sequence with the most room.
"""

from __future__ import annotations

import base64
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import ship

ship(__name__)

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")   # the ranks of byte_bpe_50k.json
SPECIAL = {"<|endoftext|>": 50256}
AT_SPECIAL = regex.compile("(" + "|".join(map(regex.escape, SPECIAL)) + ")")
LONG_BLANK = regex.compile(r"\p{White_Space}{10000,}")
END_ID = 0
WINDOW_PIECES = 8192          # rest pieces packed together
WINDOW_TOKENS = 4_000_000     # tokens held by a window at most (one document may exceed it)

_ENCODERS: dict[str, tiktoken.Encoding] = {}


def encoder(path: str = RANKS) -> tiktoken.Encoding:
    """The encoder of a rank file, once a worker process."""
    if path not in _ENCODERS:
        with open(path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        _ENCODERS[path] = tiktoken.Encoding("byte_bpe", pat_str=public_tokenizers.PATTERN,
                                            mergeable_ranks=ranks, special_tokens=SPECIAL)
    return _ENCODERS[path]


def plain_ids(text: str, enc: tiktoken.Encoding) -> list[int]:
    """Ids of a text without special strings.

    The split pattern backtracks over white space, and a library ends on a run
    of a million blanks. The pattern makes one piece of such a run but for its
    last character, which stays with what follows (of the whole run at the
    text's end), so long runs are cut there and never reach the pattern.
    """
    out, at = [], 0
    for run in LONG_BLANK.finditer(text):
        end = run.end() - (run.end() < len(text))
        out += enc.encode_ordinary(text[at:run.start()])
        out += enc._encode_single_piece(text[run.start():end])
        at = end
    return out + enc.encode_ordinary(text[at:]) if at else enc.encode_ordinary(text)


def token_ids(text: str, enc: tiktoken.Encoding) -> np.ndarray:
    """Ids of a whole text (special strings as their own id) and the end id, as unsigned 32-bit."""
    if any(s in text for s in SPECIAL):
        parts = AT_SPECIAL.split(text)       # every second part is a special string
        ids = [i for k, p in enumerate(parts) for i in ([SPECIAL[p]] if k % 2 else plain_ids(p, enc))]
    else:
        ids = plain_ids(text, enc)
    ids.append(END_ID)
    return np.array(ids, np.uint32)


def capacities(total: int, capacity: int) -> np.ndarray:
    """Sequence sizes that ``total`` tokens fill exactly: full ones, then descending powers of two."""
    full, left = divmod(total, capacity)
    small = [1 << b for b in range(left.bit_length() - 1, -1, -1) if left >> b & 1]
    return np.array([capacity] * full + small, np.int64)


def balance(lengths: np.ndarray, room: np.ndarray, linear: float, quadratic: float):
    """Assign pieces to sequences by lowest cost; yields (piece, start in piece, length, sequence, offset).

    ``room`` sums to the pieces' tokens, so that every sequence ends full.
    """
    size = room.copy()
    room = room.astype(np.float64)
    cost = np.zeros(len(room))
    for piece in np.argsort(-lengths, kind="stable"):
        start, left = 0, int(lengths[piece])
        while left:
            fits = np.where(room >= left, cost, np.inf)
            to = int(fits.argmin())
            take = left
            if fits[to] == np.inf:
                to = int(room.argmax())
                take = int(room[to])
            yield int(piece), start, take, to, int(size[to] - room[to])
            room[to] -= take
            cost[to] += linear * take + quadratic * take * take
            if room[to] == 0:
                cost[to] = np.inf
            start, left = start + take, left - take


def pack(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", capacity: int = 1024,
         linear: float = 1.0, quadratic: float = 1.0 / 1024, ranks: str = RANKS) -> DataFrame:
    """Pieces (id, start, length, ids_crc32, doc_tokens, sequence_id, offset, row_id) of all rows; no shuffle.

    Windows are stretches of an input partition: at most WINDOW_PIECES rest
    pieces or WINDOW_TOKENS tokens, so a task's memory does not grow with the
    table. Sequences have ``capacity`` (a power of two) tokens, or a smaller
    power of two at the end of a window: there is no padding. Null and empty
    texts are the end id alone; repeated rows are packed each for itself
    (``row_id`` tells them apart); an empty table gives no rows; further
    columns are not read. Sequence ids are unique within the result and follow
    the partition, so a task that runs again gives the same rows.
    """
    if capacity < 1 or capacity & capacity - 1:
        raise ValueError("capacity must be a power of two")
    names = ["id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "row_id"]

    def work(batches):
        enc = encoder(ranks)
        base = TaskContext.get().partitionId() << 36
        made = {"sequence": base, "row": base}

        def flush(rows):
            out, rest, lengths = [], [], []
            for key, ids in rows:
                n, row = len(ids), made["row"]
                made["row"] += 1
                whole = n - n % capacity
                for s in range(0, whole, capacity):
                    out.append((key, s, capacity, zlib.crc32(ids[s:s + capacity]), n, made["sequence"], 0, row))
                    made["sequence"] += 1
                if n > whole:
                    rest.append((key, ids, whole, row))
                    lengths.append(n - whole)
            room = capacities(sum(lengths), capacity)
            for piece, start, length, to, offset in balance(np.array(lengths, np.int64), room, linear, quadratic):
                key, ids, whole, row = rest[piece]
                s = whole + start
                out.append((key, s, length, zlib.crc32(ids[s:s + length]), len(ids), made["sequence"] + to, offset, row))
            made["sequence"] += len(room)
            columns = list(zip(*out))
            yield pa.RecordBatch.from_arrays(
                [pa.array(columns[0], kind)] + [pa.array(c, pa.int64()) for c in columns[1:]], names=names)

        kind, rows, tokens = None, [], 0
        for b in batches:
            kind = b.column(0).type
            for key, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                ids = token_ids(text or "", enc)
                rows.append((key, ids))
                tokens += len(ids)
                if len(rows) >= WINDOW_PIECES or tokens >= WINDOW_TOKENS:
                    yield from flush(rows)
                    rows, tokens = [], 0
        if rows:
            yield from flush(rows)

    kind = docs.schema[id_col].dataType.simpleString()
    schema = f"id {kind}, " + ", ".join(f"{n} long" for n in names[1:])
    return (docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
            .mapInArrow(work, schema).withColumnRenamed("id", id_col))
