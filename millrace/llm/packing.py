"""Hierarchical packing of documents into windows of several lengths.

Each document is tokenised and closed by an end id. Whole windows are cut off
first; what is left goes to the shortest tier that holds it. Tiers are packed
from the longest to the shortest: a piece opens a window of its tier, and the gap
is filled with whole pieces of shorter tiers, largest first, then with the front
of one more piece, whose rest goes back to its own tier. Every window ends up
full, so a length that is a power of two needs no padding. Windows of a tier form
step groups of equal token counts.

A task packs its rows in batches of bounded size as they stream in and carries
unplaced pieces on to the next batch: no shuffle, and ids are the same when a
task is repeated, as they come from its partition number and the row order.
"""

from __future__ import annotations

import zlib
from bisect import bisect_right, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from millrace.llm.bpe import Encoder, with_encoder
from millrace.llm.memory import release_memory

#: Window lengths; each a power of two.
TIERS = (512, 1024, 2048, 4096)
#: Tokens of one step group.
STEP_TOKENS = 1 << 18
#: Tokens that a task holds before it packs them.
BATCH_TOKENS = 1 << 21

SCHEMA = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("start", pa.int64()),
        ("length", pa.int64()),
        ("ids_crc32", pa.int64()),
        ("doc_tokens", pa.int64()),
        ("sequence_id", pa.int64()),
        ("offset", pa.int64()),
        ("tier", pa.int32()),
        ("step_id", pa.int64()),
    ]
)

Piece = tuple[int, int, int]  # length, document's number in this task, start


class Packer:
    """Packs the documents of one task. ``task`` makes its sequence and step numbers unique."""

    def __init__(self, task: int, tiers: tuple[int, ...] = TIERS, step_tokens: int = STEP_TOKENS):
        self.tiers, self.step_tokens = sorted(tiers), step_tokens
        self.base = task << 33
        self.sequences = self.steps = 0
        self.step_of: dict[int, tuple[int, int]] = {}
        self.held: dict[int, tuple[object, bytes, int]] = {}
        self.carried: list[Piece] = []
        self.tokens = self.numbers = 0
        self.rows: list[tuple] = []

    def add(self, doc_id: object, ids: bytes) -> None:
        number, count, window = self.numbers, len(ids) // 4, self.tiers[-1]
        self.numbers += 1
        whole = count - count % window
        self.held[number] = (doc_id, ids, count)
        for start in range(0, whole, window):
            self._emit([(window, number, start)])
        if count > whole:
            self.carried.append((count - whole, number, whole))
            self.tokens += count - whole
        else:
            del self.held[number]

    def _emit(self, window: list[Piece]) -> None:
        size = sum(length for length, _, _ in window)
        step, left = self.step_of.get(size, (0, 0))
        if left < size:
            step, left = self.base + self.steps, max(size, self.step_tokens)
            self.steps += 1
        self.step_of[size] = (step, left - size)
        offset = 0
        for length, number, start in window:
            doc_id, ids, count = self.held[number]
            crc = zlib.crc32(memoryview(ids)[4 * start : 4 * (start + length)])
            self.rows.append((doc_id, start, length, crc, count, self.base + self.sequences, offset, size, step))
            offset += length
        self.sequences += 1

    def pack(self) -> None:
        """Place what can fill windows; keep the rest for the next batch."""
        tier_of = np.searchsorted(self.tiers, [p[0] for p in self.carried]).tolist()
        pools: list[list[Piece]] = [[] for _ in self.tiers]
        for tier, piece in zip(tier_of, self.carried, strict=True):
            pools[tier].append(piece)
        for pool in pools:
            pool.sort()
        unplaced: list[Piece] = []
        for tier in range(len(self.tiers) - 1, -1, -1):
            while pools[tier]:
                first = pools[tier].pop()
                fillers = pools[:tier] if tier else pools[:1]
                window, gap = [first], self.tiers[tier] - first[0]
                while gap and (piece := self._take(fillers, gap)):
                    window.append(piece)
                    gap -= piece[0]
                if gap:
                    unplaced += window
                else:
                    self._emit(window)
        self.carried = unplaced
        self.tokens = sum(p[0] for p in unplaced)
        self.held = {n: self.held[n] for n in {p[1] for p in unplaced}}

    def _take(self, pools: list[list[Piece]], gap: int) -> Piece | None:
        """The largest piece that fits, else the front of the shortest one."""
        for pool in reversed(pools):
            if pool and pool[0][0] <= gap:
                return pool.pop(bisect_right(pool, (gap, 1 << 62, 0)) - 1)
        for pool in pools:
            if pool:
                length, number, start = pool.pop(0)
                rest = (length - gap, number, start + gap)
                insort(pools[int(np.searchsorted(self.tiers[: len(pools) - 1], rest[0]))], rest)
                return gap, number, start
        return None

    def close(self) -> None:
        """Place the carried pieces: full windows, then one window for each power of two in what is left."""
        left, sizes = sum(p[0] for p in self.carried), []
        sizes = [self.tiers[-1]] * (left // self.tiers[-1])
        sizes += [1 << k for k in range(left.bit_length(), -1, -1) if (left % self.tiers[-1]) >> k & 1]
        queue = sorted(self.carried)
        for size in sizes:
            window, gap = [], size
            while gap:
                length, number, start = queue.pop()
                used = min(length, gap)
                window.append((used, number, start))
                gap -= used
                if used < length:
                    queue.append((length - used, number, start + used))
            self._emit(window)
        self.carried, self.held, self.tokens = [], {}, 0

    def take_rows(self) -> pa.RecordBatch:
        columns = list(zip(*self.rows, strict=True)) or [()] * len(SCHEMA)
        self.rows = []
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, SCHEMA, strict=True)], schema=SCHEMA)


def pack(
    documents: DataFrame,
    path: str,
    end_id: int,
    tiers: tuple[int, ...] = TIERS,
    step_tokens: int = STEP_TOKENS,
    batch_tokens: int = BATCH_TOKENS,
) -> DataFrame:
    """One row per piece of a document: where it lies in its document and in its sequence.

    ``documents`` has ``doc_id`` and ``text``; other columns are not read. A null
    or empty text is the end id alone. Repeated rows are packed one by one, a null
    doc_id stays null, an empty table gives no rows. ``tier`` is the sequence's
    length; only the rest of a task makes sequences shorter than the first tier,
    one for each power of two in it. ``step_id`` groups sequences of one length.
    """
    end = np.array([end_id], "<u4").tobytes()

    def work(encoder: Encoder, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer = Packer(TaskContext.get().partitionId(), tiers, step_tokens)
        for batch in batches:
            ids_of = encoder.encode(batch.column(1).to_pylist())
            for doc_id, ids in zip(batch.column(0).to_pylist(), ids_of, strict=True):
                packer.add(doc_id, ids + end)
                if packer.tokens >= batch_tokens:
                    packer.pack()
                if len(packer.rows) >= 20_000:
                    yield packer.take_rows()
        packer.pack()
        packer.close()
        yield packer.take_rows()

    texts = documents.select(documents["doc_id"].cast("long"), documents["text"])
    schema = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, tier int, step_id long"
    # In a pipeline, other stages have used the workers before; an encoder needs room.
    return with_encoder(texts, path, work, schema, first=release_memory)
