"""Order-preserving packing by dynamic programming with monotone queues.

Documents keep their order. A task joins its documents' ids into a stream and cuts it into windows of at most LENGTH ids;
cuts are allowed at the end of a document, of a sentence, or on a grid of GRID ids inside a sentence. The cost of a cut is
the window's padding plus the penalty of the kind of cut, and f(j) = min over i of f(i) + LENGTH - (p_j - p_i) + penalty(j)
is found with a queue whose values f(i) + p_i ascend. Streams are solved in stretches of STRETCH ids, so memory is bounded;
only a stretch's last window is short for want of text.

Ids are those of the tokenizers library for byte_bpe_50k.json. The same vocabulary's ranks are run by tiktoken, which gives
equal ids in a fifth of the time (a test compares them); a text that spells out a special token goes to tokenizers itself.

Defined results: a null or empty text is a document of the closing id alone; repeated rows are documents of their own; null
doc_ids are kept; a document longer than a window spans windows; an empty table packs to nothing; other columns are ignored.
"""

from __future__ import annotations

import base64
import zlib
from collections import deque
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from .common import map_batches

VOCABULARY, CLOSING = "byte_bpe_50k", 0
LENGTH, GRID = 1024, 16
#: Penalties, in ids of padding, of a cut after a document, after a sentence and inside one.
AFTER_DOCUMENT, AFTER_SENTENCE, INSIDE = 0, 4, 16
STRETCH = 1 << 20
SENTENCE_ENDS = (b".", b"!", b"?", b"\n")

PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


@lru_cache(2)
def encoder(vocabulary: str):
    """(function from text to ids, table of ids that end a sentence)."""
    import public_tokenizers as public
    import tiktoken
    from tokenizers import Tokenizer

    with open(public.path(f"{vocabulary}.tiktoken"), "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    fast = tiktoken.Encoding(vocabulary, pat_str=public.PATTERN, mergeable_ranks=ranks, special_tokens={})
    exact = Tokenizer.from_file(public.path(f"{vocabulary}.json"))
    special = [t.content for t in exact.get_added_tokens_decoder().values()]
    ends = np.zeros(max(max(ranks.values()), exact.get_vocab_size()) + 1, bool)
    for piece, i in ranks.items():
        ends[i] = piece.rstrip(b" \"')").endswith(SENTENCE_ENDS)

    def ids(text: str) -> np.ndarray:
        if any(s in text for s in special):
            return np.array(exact.encode(text, add_special_tokens=False).ids, np.uint32)
        return fast.encode_to_numpy(text, disallowed_special=())

    return ids, ends


def cuts(n: int, documents: np.ndarray, sentences: np.ndarray, length: int = LENGTH, grid: int = GRID) -> list[int]:
    """Ends of the windows of a stream of n ids at least cost; documents and sentences are the ends allowed beside the grid."""
    penalty = np.full(n + 1, -1, np.int32)
    penalty[::grid] = INSIDE
    penalty[sentences] = AFTER_SENTENCE
    penalty[documents] = AFTER_DOCUMENT
    penalty[n] = 0
    penalty[0] = -1
    at = np.flatnonzero(penalty >= 0)
    where, extra = at.tolist(), penalty[at].tolist()
    queue: deque[tuple[int, int, int]] = deque([(0, 0, -1)])  # (f + p, p, number) of starts, f + p ascending
    before = []
    for k, (p, x) in enumerate(zip(where, extra)):
        while queue[0][1] < p - length:
            queue.popleft()
        value, _, i = queue[0]
        before.append(i)
        value += length + x  # f + p of this end
        while queue and queue[-1][0] >= value:
            queue.pop()
        queue.append((value, p, k))
    ends, k = [], len(where) - 1
    while k >= 0:
        ends.append(where[k])
        k = before[k]
    return ends[::-1]


def pieces(ids: list[np.ndarray], ends: np.ndarray, length: int = LENGTH, grid: int = GRID) -> Iterator[tuple[np.ndarray, ...]]:
    """Document number, start, length, crc32, window number and offset of every piece of a stretch."""
    stream = np.concatenate(ids).astype("<u4")
    stop = np.cumsum([len(x) for x in ids])
    begin = np.r_[0, stop[:-1]]
    windows = np.array(cuts(len(stream), stop, np.flatnonzero(ends[stream]) + 1, length, grid))
    edges = np.union1d(stop, windows)
    a, b = np.r_[0, edges[:-1]], edges
    doc = np.searchsorted(stop, a, "right")
    window = np.searchsorted(windows, a, "right")
    opened = np.r_[0, windows[:-1]][window]
    data = memoryview(stream.tobytes())
    crc = [zlib.crc32(data[4 * x:4 * y]) for x, y in zip(a.tolist(), b.tolist())]
    return doc, a - begin[doc], b - a, np.array(crc, np.int64), window, a - opened, len(windows)


def pack(docs: DataFrame, vocabulary: str = VOCABULARY, length: int = LENGTH) -> DataFrame:
    """A row for each piece of a document in a window (sequence). Sequence ids are unique: task number and a running one."""
    if length % GRID:
        raise ValueError(f"length must be a multiple of {GRID}")

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, ends = encoder(vocabulary)
        number = TaskContext.get().partitionId() << 32
        names: list[int | None] = []
        held: list[np.ndarray] = []
        size = 0

        def flush() -> pa.RecordBatch:
            nonlocal number
            doc, start, n, crc, window, offset, windows = pieces(held, ends, length)
            total = np.array([len(x) for x in held], np.int64)
            out = pa.RecordBatch.from_arrays(
                [pa.array([names[i] for i in doc.tolist()], pa.int64()), pa.array(start, pa.int64()), pa.array(n, pa.int64()),
                 pa.array(crc), pa.array(total[doc]), pa.array(window + number, pa.int64()), pa.array(offset, pa.int64())],
                [c.split()[0] for c in PIECES.split(", ")])
            number += windows
            return out

        for b in batches:
            for name, text in zip(b.column(0).to_pylist(), b.column(1)):
                names.append(name)
                held.append(np.append(encode(text.as_py() or ""), np.uint32(CLOSING)))
                size += len(held[-1])
                if size >= STRETCH:
                    yield flush()
                    names, held, size = [], [], 0
        if held:
            yield flush()

    return map_batches(docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")), rows, PIECES)
