"""Removal of repeated passages: prefix-partitioned suffix trees over words.

A suffix is what follows a word of a document; only its first ``size`` words matter here.

1. Documents are written as blocks. Of equal texts only the one with the smallest doc_id goes
   on: the others' windows all start there too.
2. A suffix whose window occurs in one block only can't share a deep node with another
   block. Blocks send short fingerprints of their windows, packed as sorted differences, and
   get back a bit for each: does another block have it too? They also count their prefixes.
3. A suffix's group is its shortest prefix whose count fits a task's memory, so frequent
   beginnings are split by longer prefixes; several groups share a bin. The suffixes that are
   left meet in their bins, each different window once per block, as one symbol for each word
   and the window's 64-bit fingerprint, with the block's smallest doc_id. A bin builds its
   groups' subtrees: suffixes in order, with the length that each shares with the one before.
   An internal node ``size`` words deep is a repeat; a bit says whether a smaller doc_id
   lies below it.
4. Blocks read their bits and take out the covered words.

Texts never move after the blocks are written: the blocks are a table bucketed by the task
that wrote them, and only fingerprints, suffixes and bits are shuffled to it. However often
a window occurs, it is sent once per block. Windows count as equal if the 8-bit symbols of
all their words and their 64-bit fingerprints agree: 168 bits for 13 words.
"""

from __future__ import annotations

import hashlib
import math
import uuid
from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm.memory import release_memory
from millrace.session import new_stage_path, settings, stage

#: Bytes of text in a block; fingerprints in a bucket and suffixes in a bin, on average.
BLOCK_BYTES, BUCKET_PRINTS, BIN_SUFFIXES = 4 << 20, 1_000_000, 500_000
#: Bytes of blocks, fingerprints or suffixes that a worker is sent at once, if one row isn't more.
BATCH_BYTES = 8 << 20
#: Lengths of prefixes that groups may have besides whole windows; prefixes are counted in 2 ** SLOT_BITS slots for each.
LENGTHS, SLOT_BITS = (1, 2, 4, 8), 14
#: A group is at most this share of a bin, unless whole windows make it up.
GROUP_SHARE = 4
#: Tasks' prefix counts meet in so many groups.
COUNT_GROUPS = 32
#: Multiplier and offset of FNV-1a, and multipliers of the rolling hash and of the last mixing.
FNV, BASIS = np.uint64(0x100000001B3), np.uint64(0xCBF29CE484222325)
ROLL, MIX = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)
#: Longer words are hashed one by one.
SHORT_WORD = 64
#: Stands for a missing doc_id: no id is above it.
NO_ID = np.iinfo(np.int64).max

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True


@dataclass(frozen=True)
class Layout:
    """Window length and how fingerprints and suffixes are dealt; the result depends on ``size`` alone."""

    size: int
    width: int  # bits of a short fingerprint
    buckets: int
    bins: int = 1
    fits: np.ndarray | None = None  # lengths x slots: may a prefix of this slot be a group?

    @property
    def lengths(self) -> tuple[int, ...]:
        return tuple(n for n in LENGTHS if n < self.size)


def pack(numbers: np.ndarray) -> bytes:
    """Whole numbers by byte planes, compressed; high planes that are all zero are left out."""
    numbers = np.ascontiguousarray(numbers, "<u8")
    planes = max(1, (int(numbers.max(initial=0)).bit_length() + 7) // 8)
    table = numbers.view(np.uint8).reshape(len(numbers), 8)[:, :planes]
    return bytes([planes]) + zstandard.ZstdCompressor(1).compress(table.T.tobytes())


def unpack(data: bytes, kind: str = "<u8") -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(data[1:]), np.uint8).reshape(data[0], -1)
    table = np.zeros((planes.shape[1], np.dtype(kind).itemsize), np.uint8)
    table[:, : data[0]] = planes.T
    return table.view(kind).ravel()


def _mixed(values: np.ndarray) -> np.ndarray:
    values = (values ^ (values >> np.uint64(32))) * MIX
    return values ^ (values >> np.uint64(29))


def _changes(values: np.ndarray) -> np.ndarray:
    """Where runs of equal values begin."""
    return np.flatnonzero(np.concatenate([np.ones(min(1, len(values)), bool), values[1:] != values[:-1]]))


class Words:
    """The words of a block's texts: their bytes, who holds them, and their hashes."""

    def __init__(self, texts: pa.StringArray):
        _, offsets, data = texts.buffers()
        offsets = np.frombuffer(offsets, np.int32)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
        self.data = np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]] if data else np.empty(0, np.uint8)
        self.offsets = offsets - offsets[0]
        word = ~_SPACE[self.data]
        edge = np.zeros(len(word) + 1, bool)  # a text ends before, or another begins
        edge[self.offsets] = True
        before, after = np.concatenate([[False], word])[: len(word)], np.concatenate([word[1:], [False]])[: len(word)]
        self.begin = np.flatnonzero(word & (~before | edge[:-1])).astype(np.int32)
        self.end = (np.flatnonzero(word & (~after | edge[1:])) + 1).astype(np.int32)
        self.holder = (np.searchsorted(self.offsets, self.begin, side="right") - 1).astype(np.int32)
        self.counts = np.bincount(self.holder, minlength=len(texts))

    def hashes(self) -> np.ndarray:
        return word_hashes(self.data, self.begin, self.end)


def word_hashes(data: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64 bits of each word: FNV-1a symbol by symbol over all words at once, longest first."""
    lengths = end - begin
    order = np.argsort(-np.minimum(lengths, SHORT_WORD + 1), kind="stable")
    first, found = begin[order], np.full(len(order), BASIS)
    longer = len(order) - np.searchsorted(np.sort(lengths), np.arange(SHORT_WORD + 1), side="right")
    for place, count in enumerate(longer[:-1].tolist()):
        if not count:
            break
        found[:count] = (found[:count] ^ data[first[:count] + place]) * FNV
    for n in range(int(longer[-1])):
        at = order[n]
        found[n] = xxhash.xxh3_64_intdigest(data[begin[at] : end[at]].tobytes())
    hashes = np.empty(len(order), np.uint64)
    hashes[order] = _mixed(found)
    return hashes


class Windows:
    """A block's windows in the order of their fingerprints, equal ones beside each other; those of copies are left out."""

    def __init__(self, texts: pa.Array, layout: Layout, copies: list[int]):
        self.layout, self.words = layout, Words(texts)
        holder, size = self.words.holder, layout.size
        self.hashes = self.words.hashes()
        whole = len(holder) - size + 1
        starts = holder[:whole] == holder[size - 1 :] if whole > 0 else np.empty(0, bool)
        if copies:
            copied = np.zeros(len(texts), bool)
            copied[copies] = True
            starts &= ~copied[holder[: len(starts)]]
        rolled, done, self.shorter = np.zeros(len(starts), np.uint64), 0, []
        for length in (*layout.lengths, size):
            for i in range(done, length):
                rolled = rolled * ROLL + self.hashes[i : i + len(starts)]
            done = length
            self.shorter.append(_mixed(rolled[starts]))
        *self.shorter, prints = self.shorter
        order = prints.argsort(kind="stable").astype(np.int32)
        self.positions, self.whole = np.flatnonzero(starts).astype(np.int32)[order], prints[order]
        self.order = order
        short = self.whole >> np.uint64(64 - layout.width)
        first = _changes(short)
        self.short, self.repeats = short[first], np.diff(np.append(first, len(short)))

    def buckets(self) -> Iterator[tuple[int, np.ndarray]]:
        """Different short fingerprints by bucket, in rising order."""
        edges = [(b << self.layout.width) // self.layout.buckets for b in range(1, self.layout.buckets)]
        cuts = np.searchsorted(self.short, np.array(edges, np.uint64)) if edges else []
        for b, part in enumerate(np.split(self.short, cuts)):
            if len(part):
                yield b, part

    def prefix_counts(self) -> np.ndarray:
        counts = [np.bincount(_slots(h), minlength=1 << SLOT_BITS) for h in self.shorter]
        return np.concatenate(counts) if counts else np.zeros(0, np.int64)


def _slots(hashes: np.ndarray) -> np.ndarray:
    return (hashes >> np.uint64(64 - SLOT_BITS)).astype(np.int64)


class Leaves:
    """A block's windows that occur more than once: each with its places and smallest doc_id, and those that go to a bin."""

    def __init__(self, windows: Windows, ids: np.ndarray, seen: list[bytes]):
        """``seen`` are the bits of the block's fingerprints, bucket by bucket."""
        counts = [len(part) for _, part in windows.buckets()]
        flags = [np.unpackbits(np.frombuffer(b, np.uint8), count=n) > 0 for b, n in zip(seen, counts, strict=True)]
        elsewhere = np.concatenate(flags) if flags else np.empty(0, bool)
        at = np.flatnonzero(np.repeat(elsewhere | (windows.repeats > 1), windows.repeats))
        whole = windows.whole[at]
        self.positions = windows.positions[at]
        self.ids = ids[windows.words.holder[self.positions]]
        first = _changes(whole)
        self.group = np.repeat(np.arange(len(first)), np.diff(np.append(first, len(whole))))
        self.lowest = np.minimum.reduceat(self.ids, first) if len(first) else np.empty(0, np.int64)
        self.start, self.prints = self.positions[first], whole[first]
        # What no other block holds is settled here; what only texts without an id hold takes nothing from others.
        sent = np.repeat(elsewhere, windows.repeats)[at][first] & (self.lowest != NO_ID)
        self.sent = np.flatnonzero(sent)
        if windows.layout.fits is not None:
            places = windows.order[at][first]
            bins = self._bins(windows.layout, self.prints, [h[places] for h in windows.shorter])[self.sent]
            order = bins.argsort(kind="stable")
            self.sent, self.bins = self.sent[order], bins[order]

    @staticmethod
    def _bins(layout: Layout, whole: np.ndarray, shorter: list[np.ndarray]) -> np.ndarray:
        """Each suffix's bin: that of its shortest prefix that is rare enough, or of its whole window."""
        group = whole
        for n in reversed(range(len(shorter))):
            group = np.where(layout.fits[n][_slots(shorter[n])], _mixed(shorter[n] + np.uint64(n + 1)), group)
        return (_mixed(group) % np.uint64(layout.bins)).astype(np.int64)

    def by_bin(self) -> Iterator[tuple[int, np.ndarray]]:
        cuts = _changes(self.bins)
        for first, part in zip(cuts, np.split(self.sent, cuts[1:]), strict=False):
            if len(part):
                yield int(self.bins[first]), part


class Subtrees:
    """The suffix trees of a bin's groups: suffixes in order, and the number of words each shares with the one before.

    Suffixes are symbols, one column for each word; ``ends`` tells those apart whose symbols agree.
    """

    def __init__(self, suffixes: np.ndarray, ends: np.ndarray):
        n, size = suffixes.shape
        # Eight symbols a key.
        padded = np.zeros((n, -(-size // 8) * 8), np.uint8)
        padded[:, :size] = suffixes
        keys = padded.view(">u8").astype(np.uint64)
        self.order = np.lexsort((ends, *keys.T[::-1]))
        ordered, last = suffixes[self.order], ends[self.order]
        shared = np.logical_and.accumulate(ordered[1:] == ordered[:-1], axis=1).sum(axis=1)
        shared[(shared == size) & (last[1:] != last[:-1])] -= 1
        self.shared = np.concatenate([np.zeros(min(1, n), np.int64), shared])

    def nodes(self, depth: int) -> np.ndarray:
        """Where the leaves of each subtree below ``depth`` words begin in ``order``; a single leaf is its own subtree."""
        return np.flatnonzero(self.shared < depth)


def _bucket_keys(spark: SparkSession, buckets: int) -> list[int]:
    """For each bucket of a bucketed table a number that falls into it, by Spark's own rule."""
    keys: dict[int, int] = {}
    tried = 64 * buckets
    while len(keys) < buckets:
        at = F.pmod(F.hash(F.col("id").cast("int")), F.lit(buckets))
        keys = {r.at: r.key for r in spark.range(tried).groupBy(at.alias("at")).agg(F.min("id").alias("key")).collect()}
        tried *= 2
    return [keys[b] for b in range(buckets)]


def _blocks(documents: DataFrame, block_bytes: int, id_column: str, text_column: str) -> DataFrame:
    """Written blocks: ``part``, ``seq``, ``ids``, ``texts``, ``digests``, ``n_bytes``; bucketed by ``part``, a number of the task's."""
    spark = documents.sparkSession
    rows = documents.select(F.col(id_column).cast("long").alias("id"), F.coalesce(F.col(text_column).cast("string"), F.lit("")).alias("text"))
    buckets = min(int(spark.conf.get("spark.sql.shuffle.partitions")), int(spark.conf.get("spark.sql.sources.bucketing.maxBuckets", "100000")))
    keys = spark.sparkContext.broadcast(_bucket_keys(spark, buckets))
    names = ["part", "seq", "ids", "texts", "digests", "n_bytes"]
    kinds = [pa.int32(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.string()), pa.list_(pa.binary()), pa.int64()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get().partitionId()
        release_memory()
        part, seq = keys.value[task % buckets], task << 32
        ids, texts, held = [], [], 0

        def block() -> pa.RecordBatch:
            digests = [hashlib.md5(t.encode(), usedforsecurity=False).digest() for t in texts]
            return pa.RecordBatch.from_arrays([pa.array([x], kind) for x, kind in zip((part, seq, ids, texts, digests, held), kinds, strict=True)], names=names)

        for batch in batches:
            for i, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                ids.append(i)
                texts.append(text)
                held += len(text)
                if held >= block_bytes:
                    yield block()
                    ids, texts, held, seq = [], [], 0, seq + 1
        if ids:
            yield block()

    made = rows.mapInArrow(run, "part int, seq long, ids array<long>, texts array<string>, digests array<binary>, n_bytes long")
    name = f"substring_blocks_{uuid.uuid4().hex}"
    writer = made.write.format("parquet").option("compression", "zstd").option("path", new_stage_path(spark, "substring-blocks"))
    writer.bucketBy(buckets, "part").saveAsTable(name)
    return spark.table(name)


def _copies(blocks: DataFrame) -> DataFrame:
    """``part``, ``seq``, ``at``: places of the documents whose text another of a smaller id has too."""
    each = blocks.select("part", "seq", F.posexplode(F.arrays_zip("ids", "digests"))).select("part", "seq", F.col("pos").alias("at"), F.col("col.ids").alias("id"), F.col("col.digests").alias("digest"))
    each = each.where("id is not null")
    firsts = each.groupBy("digest").agg(F.min("id").alias("first"), F.max("id").alias("last")).where("first < last").select("digest", "first")
    # Written, so that both sides of the join are shuffles of its own: Spark can then split the rows of a frequent text.
    firsts = stage(firsts, "substring-firsts")
    return each.join(firsts, "digest").where("id > first").select("part", "seq", "at")


def _beside(blocks: DataFrame, name: str, table: DataFrame, value: str) -> DataFrame:
    """Blocks with an array ``name`` of what ``table`` has for them as ``value``, ordered by ``at``; blocks stay where they are."""
    fields = dict.fromkeys(["at", "seq", value])
    lists = table.groupBy("part").agg(F.collect_list(F.struct(*fields)).alias("__all"))
    own = F.transform(F.array_sort(F.filter("__all", lambda x: x["seq"] == F.col("seq"))), lambda x: x[value])
    return blocks.join(lists.hint("shuffle_hash"), "part", "left").withColumn(name, F.coalesce(own, F.array())).drop("__all")


def _seen(blocks: DataFrame, layout: Layout) -> DataFrame:
    """``part``, ``seq``, ``at`` (bucket), ``bits``, ``n``: the fingerprints of a block that another block holds too.

    Rows with a negative ``at`` have counts of prefixes instead of bits.
    """
    shared = blocks.sparkSession.sparkContext.broadcast(layout)
    names, kinds = ["at", "part", "seq", "prints"], [pa.int32(), pa.int32(), pa.int64(), pa.binary()]

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            for row in range(batch.num_rows):
                release_memory()
                part, seq = batch.column(0)[row].as_py(), batch.column(1)[row].as_py()
                windows = Windows(batch.column(2)[row].values, shared.value, batch.column(3)[row].as_py())
                found = [(b, part, seq, pack(np.diff(prints, prepend=np.uint64(0)))) for b, prints in windows.buckets()]
                counts = windows.prefix_counts()
                total = counts if total is None else total + counts
                made = [pa.array(c, kind) for c, kind in zip(zip(*found, strict=True), kinds, strict=True)] if found else []
                del windows, found  # before the next block's
                if made:
                    yield pa.RecordBatch.from_arrays(made, names=names)
        if total is not None:
            row = (-1 - TaskContext.get().partitionId() % COUNT_GROUPS, 0, 0, pack(total))
            yield pa.RecordBatch.from_arrays([pa.array([x], kind) for x, kind in zip(row, kinds, strict=True)], names=names)

    def compare(table: pa.Table) -> pa.Table:
        prints = [unpack(x) for x in table["prints"].to_pylist()]
        if table["at"][0].as_py() < 0:
            bits, counts = [pack(np.sum(prints, axis=0))], [0]
            table = table.slice(0, 1)
        else:
            every = np.concatenate([x.cumsum(dtype=np.uint64) for x in prints])
            order = every.argsort(kind="stable")
            same = np.diff(every[order]) == 0
            held = np.empty(len(every), bool)
            held[order] = np.concatenate([same, [False]]) | np.concatenate([[False], same])
            flags = np.split(held, np.cumsum([len(p) for p in prints])[:-1])
            bits, counts = [np.packbits(x).tobytes() for x in flags], [int(x.sum()) for x in flags]
        return pa.table({"part": table["part"], "seq": table["seq"], "at": table["at"], "bits": pa.array(bits, pa.binary()), "n": pa.array(counts, pa.int64())})

    sent = blocks.select("part", "seq", "texts", "copies").mapInArrow(send, "at int, part int, seq long, prints binary")
    return sent.groupBy("at").applyInArrow(compare, "part int, seq long, at int, bits binary, n long")


def _with_groups(layout: Layout, seen: DataFrame, bin_suffixes: int) -> Layout:
    """The layout with bins for what was seen twice, and which prefixes may be groups."""
    suffixes = seen.agg(F.sum("n").alias("n")).first().n or 0
    counts = np.zeros(len(layout.lengths) << SLOT_BITS, np.int64)
    for r in seen.where("at < 0").select("bits").collect():  # COUNT_GROUPS rows at most
        counts += unpack(r.bits).astype(np.int64)
    fits = counts.reshape(len(layout.lengths), 1 << SLOT_BITS) <= bin_suffixes / GROUP_SHARE
    return replace(layout, bins=max(1, math.ceil(suffixes / bin_suffixes)), fits=fits)


def _block_ids(ids: pa.Scalar) -> np.ndarray:
    return pc.fill_null(ids.values, NO_ID).to_numpy()


def _earlier(blocks: DataFrame, layout: Layout) -> DataFrame:
    """``part``, ``seq``, ``at`` (bin), ``bits``: the suffixes of a block below whose node another block has a smaller id."""
    shared = blocks.sparkSession.sparkContext.broadcast(layout)
    names = ["at", "part", "seq", "symbols", "ends", "ids", "holders"]
    kinds = [pa.int32(), pa.int32(), pa.int64(), *[pa.binary()] * 4]

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                release_memory()
                part, seq = batch.column(0)[row].as_py(), batch.column(1)[row].as_py()
                windows = Windows(batch.column(3)[row].values, shared.value, batch.column(4)[row].as_py())
                leaves = Leaves(windows, _block_ids(batch.column(2)[row]), batch.column(5)[row].as_py())
                symbol = (windows.hashes >> np.uint64(56)).astype(np.uint8)
                found = []
                for at, own in leaves.by_bin():
                    # One column after the other: equal places of suffixes compress better together.
                    symbols = np.concatenate([symbol[leaves.start[own] + i] for i in range(shared.value.size)])
                    ids, holders = np.unique(leaves.lowest[own], return_inverse=True)
                    packed = [np.diff(leaves.prints[own], prepend=np.uint64(0)), ids.view(np.uint64), holders]
                    found.append((at, part, seq, zstandard.ZstdCompressor(1).compress(symbols.tobytes()), *map(pack, packed)))
                made = [pa.array(c, kind) for c, kind in zip(zip(*found, strict=True), kinds, strict=True)] if found else []
                del windows, leaves, symbol, found  # before the next block's
                if made:
                    yield pa.RecordBatch.from_arrays(made, names=names)

    def grow(table: pa.Table) -> pa.Table:
        size = shared.value.size
        plain = zstandard.ZstdDecompressor()
        suffixes = np.concatenate([np.frombuffer(plain.decompress(x), np.uint8).reshape(size, -1).T for x in table["symbols"].to_pylist()])
        ends = np.concatenate([unpack(x).cumsum(dtype=np.uint64) for x in table["ends"].to_pylist()])
        ids = [unpack(x).view(np.int64)[unpack(y).astype(np.int64)] for x, y in zip(table["ids"].to_pylist(), table["holders"].to_pylist(), strict=True)]
        own = np.concatenate(ids)
        trees = Subtrees(suffixes, ends)
        starts = trees.nodes(size)
        lowest = np.repeat(np.minimum.reduceat(own[trees.order], starts), np.diff(np.append(starts, len(own))))
        earlier = np.empty(len(own), bool)
        earlier[trees.order] = lowest < own[trees.order]
        bits = [np.packbits(x).tobytes() for x in np.split(earlier, np.cumsum([len(x) for x in ids])[:-1])]
        return pa.table({"part": table["part"], "seq": table["seq"], "at": table["at"], "bits": pa.array(bits, pa.binary())})

    schema = "at int, part int, seq long, symbols binary, ends binary, ids binary, holders binary"
    sent = blocks.select("part", "seq", "ids", "texts", "copies", "seen").mapInArrow(send, schema)
    return sent.groupBy("at").applyInArrow(grow, "part int, seq long, at int, bits binary")


def _covered(windows: Windows, leaves: Leaves, bits: list[bytes], copies: list[int]) -> np.ndarray:
    """Which words of a block lie in a window that a smaller doc_id holds."""
    earlier = np.zeros(len(leaves.lowest), bool)
    for (_, own), data in zip(leaves.by_bin(), bits, strict=True):
        earlier[own] = np.unpackbits(np.frombuffer(data, np.uint8), count=len(own)) > 0
    gone = (leaves.ids != NO_ID) & (earlier[leaves.group] | (leaves.ids > leaves.lowest[leaves.group]))
    words, size = windows.words, windows.layout.size
    depth = np.zeros(len(words.begin) + 1, np.int32)
    np.add.at(depth, leaves.positions[gone], 1)
    np.add.at(depth, leaves.positions[gone] + size, -1)
    covered = depth[:-1].cumsum() > 0
    if copies:
        copied = np.zeros(len(words.counts), bool)
        copied[copies] = True
        covered |= (copied & (words.counts >= size))[words.holder]
    return covered


def _cleaned(words: Words, covered: np.ndarray) -> list[pa.Array]:
    """Text, number of words, number removed and removed spans of each of the block's documents."""
    removed = np.bincount(words.holder[covered], minlength=len(words.counts))
    kept = np.flatnonzero(~covered)
    # The bytes of kept words, and one blank behind each that another of its document follows.
    step = np.zeros(len(words.data) + 1, np.int8)
    step[words.begin[kept]] += 1
    step[words.end[kept]] -= 1
    stays = step[:-1].cumsum(dtype=np.int8) > 0
    blanks = words.end[kept[:-1]][words.holder[kept[1:]] == words.holder[kept[:-1]]]
    stays[blanks] = True
    data = words.data.copy()
    data[blanks] = 0x20
    offsets = np.concatenate([[0], stays.cumsum()])[words.offsets].astype(np.int32)
    text = pa.Array.from_buffers(pa.string(), len(words.counts), [None, pa.py_buffer(offsets.tobytes()), pa.py_buffer(data[stays].tobytes())])
    # Spans begin where the cover does, or the document.
    edges = np.flatnonzero(np.diff(np.where(covered, words.holder, -1), prepend=-1, append=-1))
    covers = np.concatenate([covered, [False]])[edges]
    begin = edges[covers]
    end = np.append(edges, len(covered))[np.flatnonzero(covers) + 1]
    first, holder = np.concatenate([[0], words.counts.cumsum()]), words.holder[begin]
    spans = pa.StructArray.from_arrays([pa.array(begin - first[holder], pa.int64()), pa.array(end - begin, pa.int64())], names=["start", "length"])
    bounds = np.concatenate([[0], np.bincount(holder, minlength=len(words.counts)).cumsum()])
    listed = pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), spans)
    return [text, pa.array(words.counts, pa.int64()), pa.array(removed, pa.int64()), listed]


def remove_repeats(
    documents: DataFrame,
    size: int = 13,
    block_bytes: int = BLOCK_BYTES,
    bucket_prints: int = BUCKET_PRINTS,
    bin_suffixes: int = BIN_SUFFIXES,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """``doc_id``, ``text``, ``n_words``, ``n_removed``, ``removed`` of every document.

    Words are what ASCII white space separates. Every word goes that lies in ``size``
    consecutive words of its document which also start in a document of a smaller doc_id;
    windows are those of the input. ``text`` has the kept words joined by one space,
    ``removed`` the runs of words taken out as (start, length), in words.

    Ids are whole numbers. Rows of the same doc_id are the same document and take nothing
    from each other; each gives its row. A document without an id keeps its words and takes
    none from others. A null text counts as empty; a document of fewer words than ``size``
    stays whole. An empty table gives no rows; other columns are not read, whatever their
    names. The blocks stay as a table ``substring_blocks_...`` in the current database, its
    files in the staging folder.

    ``block_bytes``, ``bucket_prints`` and ``bin_suffixes`` bound what a task holds, whatever
    the table's size: about 30 bytes for a byte of text, 40 for a fingerprint and 120 for a
    suffix. Blocks x (buckets + bins) rows are shuffled, so raise them with the table.
    """
    if size < 1:
        raise ValueError("a window needs a word")
    # Few blocks go to a worker at once.
    few = {"spark.sql.execution.arrow.maxBytesPerBatch": str(BATCH_BYTES)}
    with settings(documents.sparkSession, **few):
        written = _blocks(documents, block_bytes, id_column, text_column)
    copies = stage(_copies(written), "substring-copies")
    blocks = _beside(written, "copies", copies, "at")
    # A word takes five bytes or so; 2^10 times as many fingerprints as words: one in a thousand is taken for a repeat that isn't.
    words = (written.agg(F.sum("n_bytes").alias("n")).first().n or 0) // 5 + 1
    layout = Layout(size, min(64, words.bit_length() + 10), math.ceil(words / bucket_prints))
    with settings(documents.sparkSession, **few):
        seen = stage(_seen(blocks, layout), "substring-seen")
    layout = _with_groups(layout, seen, bin_suffixes)
    blocks = _beside(blocks, "seen", seen.where("at >= 0"), "bits")
    with settings(documents.sparkSession, **few):
        earlier = stage(_earlier(blocks, layout), "substring-earlier")
    shared = written.sparkSession.sparkContext.broadcast(layout)

    def clean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                release_memory()
                copies = batch.column(2)[row].as_py()
                windows = Windows(batch.column(1)[row].values, shared.value, copies)
                leaves = Leaves(windows, _block_ids(batch.column(0)[row]), batch.column(3)[row].as_py())
                covered = _covered(windows, leaves, batch.column(4)[row].as_py(), copies)
                del leaves
                made = [batch.column(0)[row].values, *_cleaned(windows.words, covered)]
                del windows, covered  # before the next block's
                yield pa.RecordBatch.from_arrays(made, names=["id", "text", "n_words", "n_removed", "removed"])

    marked = _beside(blocks, "earlier", earlier, "bits").select("ids", "texts", "copies", "seen", "earlier")
    found = marked.mapInArrow(clean, "id long, text string, n_words long, n_removed long, removed array<struct<start:long,length:long>>")
    kind = documents.schema[id_column].dataType
    return found.select(F.col("id").cast(kind).alias(id_column), F.col("text").alias(text_column), "n_words", "n_removed", "removed")
