"""Compression of vectors to codes: one codebook per part position, learned with adaptive distance bounds.

Each part of a vector keeps a list of its nearest entries, a lower bound of its distance
to every one after the first, in rising order, and one outer bound for all entries not in
the list (Drake and Hamerly's bounds). Between rounds these are a written table. When the
codebooks have moved, bounds shrink by how far their entries went; a part whose first
bound still exceeds the exact distance to its own entry is settled without looking at any
other. The rest are verified in whole numbers, against their list or, where the outer
bound fails too, against the whole codebook. Lists shrink to what the round needed.

Bounds are kept as 16-bit floats rounded down. Per round a task sends the sums of its
parts, one row per entry and component; the driver keeps the codebooks, whose size is
fixed by the parameters and the vectors' length.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.vectors import finite_vectors, scaled
from millrace.session import stage

#: Lists start with this share of the codebook and shrink to what all but one part in `SPARE` needed.
SHARE, SPARE = 8, 100
#: Bounds are compared with this margin, far above the rounding of 64-bit floats.
MARGIN = 1e-9

#: One codebook for each vector length: parts x entries x components, whole numbers.
Books = dict[int, np.ndarray]


def entry_type(entries: int) -> np.dtype:
    """How an entry's number is kept; its bytes in hex are its code."""
    return np.dtype(np.uint8) if entries <= 256 else np.dtype(">u2")


def _down(values: np.ndarray) -> np.ndarray:
    """The largest 16-bit floats that are not above ``values``."""
    least = np.clip(values, 0, 65504).astype(np.float16)
    above = least.astype(np.float64) > values
    least[above] = np.nextafter(least[above], np.float16(0))
    return np.maximum(least, np.float16(0))


class Part:
    """Lists and bounds of the parts at one position: ``near`` (entries), ``low`` (of ``near[:, 1:]``), ``outer``."""

    def __init__(self, near: np.ndarray, low: np.ndarray, outer: np.ndarray):
        self.near, self.low, self.outer = near, low, outer


def _ranked(distances: np.ndarray, entries: np.ndarray, wanted: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``wanted`` nearest entries, ties to the lower one, and their squared distances; both exact."""
    key = distances.astype(np.int64) * 2**8 if entries.max(initial=0) < 2**8 else None
    if key is not None and distances.max(initial=0) < 2**54:
        key += entries
        key = np.partition(key, min(wanted, key.shape[1]) - 1, axis=1)[:, :wanted] if wanted < key.shape[1] else key
        key.sort(axis=1)
        return key & 0xFF, key >> 8
    order = np.lexsort((np.broadcast_to(entries, distances.shape), distances), axis=1)[:, :wanted]
    return np.take_along_axis(np.broadcast_to(entries, distances.shape), order, 1), np.take_along_axis(distances, order, 1).astype(np.int64)


def _to_all(parts: np.ndarray, book: np.ndarray) -> np.ndarray:
    """Squared distances of each part to each entry; whole numbers below 2^53, so exact."""
    return (parts * parts).sum(1)[:, None] - 2 * (parts @ book.T) + (book * book).sum(1)


def begin(parts: np.ndarray, book: np.ndarray) -> tuple[Part, np.ndarray]:
    """Lists and bounds of parts never assigned before, and the squared distances to their entries."""
    size = min(len(book), max(2, len(book) // SHARE))
    near, distances = _ranked(_to_all(parts, book), np.arange(len(book)), size + 1)
    roots = np.sqrt(distances)
    outer = roots[:, size] if near.shape[1] > size else np.full(len(parts), 65504.0)
    return Part(near[:, :size], _down(roots[:, 1:size]), _down(outer)), distances[:, 0]


def advance(parts: np.ndarray, before: Part, book: np.ndarray, moved: np.ndarray) -> tuple[Part, np.ndarray, np.ndarray]:
    """Lists and bounds after the entries ``moved`` (upper bounds), exact squared distances, and how many list entries each part needed."""
    near, size, whole = before.near.copy(), before.near.shape[1], len(book)
    own = ((parts - book[near[:, 0]]) ** 2).sum(1)
    outer = before.outer - moved.max(initial=0) if size < whole else np.full(len(parts), 65504.0)
    # Bounds in rising order: none above a later one.
    low = np.concatenate([before.low - moved[near[:, 1:]], outer[:, None]], axis=1)
    low = np.minimum.accumulate(low[:, ::-1], axis=1)[:, ::-1].copy()
    unsure = (low <= 0) | (low * low * (1 - MARGIN) <= own[:, None])
    if size == whole:
        unsure[:, -1] = False
    needed = 1 + unsure.sum(1)
    listed = np.flatnonzero(unsure[:, 0] & ~unsure[:, -1])
    if len(listed):
        candidates = near[listed]
        distances = ((parts[listed, None, :] - book[candidates]) ** 2).sum(2)
        near[listed], exact = _ranked(distances, candidates, size)
        own[listed], low[listed, : size - 1] = exact[:, 0], np.sqrt(exact[:, 1:])
    every = np.flatnonzero(unsure[:, -1])
    if len(every):
        found, exact = _ranked(_to_all(parts[every], book), np.arange(whole), min(whole, size + 1))
        near[every], own[every] = found[:, :size], exact[:, 0]
        low[every] = 65504.0
        low[every, : exact.shape[1] - 1] = np.sqrt(exact[:, 1:])
    return Part(near, low[:, :-1], low[:, -1]), own.astype(np.int64), needed


def _shortened(part: Part, size: int) -> Part:
    """Lists cut to ``size``; what is cut counts for the outer bound."""
    low = np.concatenate([part.low, part.outer[:, None]], axis=1)
    low = np.minimum.accumulate(low[:, ::-1], axis=1)[:, ::-1]
    return Part(part.near[:, :size], _down(low[:, : size - 1]), _down(low[:, size - 1]))


def _cut(rows: np.ndarray, position: int, parts: int) -> np.ndarray:
    width = rows.shape[1] // parts
    return np.ascontiguousarray(rows[:, position * width : (position + 1) * width])


class Round:
    """One assignment of a batch's vectors of one length to their codebooks."""

    def __init__(self, books: np.ndarray, earlier: np.ndarray | None):
        self.books = books.astype(np.float64)
        self.kind = entry_type(books.shape[1])
        if earlier is not None:
            self.moved = np.sqrt(((self.books - earlier) ** 2).sum(2)) * (1 + MARGIN)

    def assign(self, rows: np.ndarray, state: tuple[list[bytes], list[bytes]] | None) -> tuple[np.ndarray, np.ndarray, list[bytes], list[bytes]]:
        """Entries, squared error, and the new lists and bounds of each row."""
        parts, found, needs = len(self.books), [], []
        if state is not None:
            near = np.frombuffer(b"".join(state[0]), self.kind).reshape(len(rows), parts, -1).astype(np.int64)
            bounds = np.frombuffer(b"".join(state[1]), np.float16).reshape(len(rows), parts, -1).astype(np.float64)
        error = np.zeros(len(rows), np.int64)
        for p, book in enumerate(self.books):
            own = _cut(rows, p, parts)
            if state is None:
                part, distances = begin(own, book)
            else:
                part, distances, needed = advance(own, Part(near[:, p], bounds[:, p, :-1], bounds[:, p, -1]), book, self.moved[p])
                needs.append(needed)
            found.append(part)
            error += distances
        size = found[0].near.shape[1]
        if needs:
            depths = np.bincount(np.minimum(np.concatenate(needs), size), minlength=size + 1)
            enough = int(np.searchsorted(depths.cumsum(), (1 - 1 / SPARE) * depths.sum()))
            size = min(size, max(2, enough))
        cut = [_shortened(part, size) for part in found]
        near = np.stack([part.near for part in cut], axis=1).astype(self.kind)
        bounds = np.stack([np.concatenate([part.low, part.outer[:, None]], axis=1) for part in cut], axis=1).astype(np.float16)
        return near[:, :, 0], error, [r.tobytes() for r in near], [r.tobytes() for r in bounds]


def _whole_numbers(vectors: DataFrame, parts: int, scale: int) -> DataFrame:
    """``vec_id``, ``length``, ``whole`` of each kept vector; ``whole`` is null where a vector can't be coded."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for length, places, rows in finite_vectors(batch.column(2)):
                whole, exact = scaled(rows, scale)
                if length % parts or not length:
                    exact[:] = False
                lists = pa.array([r if e else None for r, e in zip(whole.astype(np.int64), exact.tolist(), strict=True)], pa.list_(pa.int64()))
                taken = [batch.column(i).take(pa.array(places)) for i in (0, 1)]
                yield pa.RecordBatch.from_arrays([*taken, pa.array(np.full(len(places), length), pa.int32()), lists], names=["vec_id", "label", "length", "whole"])

    kinds = [f"{f.name} {f.dataType.simpleString()}" for f in vectors.schema.fields[:2]]
    return vectors.mapInArrow(run, f"{', '.join(kinds)}, length int, whole array<bigint>")


def _rounds(whole: DataFrame, books: Books, earlier: Books | None) -> DataFrame:
    """``whole``'s rows with ``code`` (entries), ``error``, ``near`` and ``bounds``; with ``earlier`` codebooks the rows bring lists and bounds of theirs."""
    shared = whole.sparkSession.sparkContext.broadcast((books, earlier))
    names = ["vec_id", "label", "length", "whole", "code", "error", "near", "bounds"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        books, earlier = shared.value
        for batch in batches:
            lengths = batch.column(2).to_numpy(zero_copy_only=False)
            known = batch.column(3).is_valid().to_numpy(zero_copy_only=False)
            for length in np.unique(lengths).tolist():
                for coded in (True, False):
                    places = np.flatnonzero((lengths == length) & ((known & (length in books)) == coded))
                    if not len(places):
                        continue
                    taken = [batch.column(i).take(pa.array(places)) for i in range(4)]
                    if not coded:
                        nothing = [pa.nulls(len(places), kind) for kind in (pa.binary(), pa.int64(), pa.binary(), pa.binary())]
                        yield pa.RecordBatch.from_arrays([*taken, *nothing], names=names)
                        continue
                    rows = taken[3].flatten().to_numpy().reshape(len(places), length).astype(np.float64)
                    state = None
                    if earlier is not None:
                        state = tuple(batch.column(i).take(pa.array(places)).to_pylist() for i in (6, 7))
                    one = Round(books[length], None if earlier is None else earlier[length])
                    entries, error, near, bounds = one.assign(rows, state)
                    made = [pa.array([r.tobytes() for r in entries], pa.binary()), pa.array(error, pa.int64()), pa.array(near, pa.binary()), pa.array(bounds, pa.binary())]
                    yield pa.RecordBatch.from_arrays([*taken, *made], names=names)

    kinds = [f"{f.name} {f.dataType.simpleString()}" for f in whole.schema.fields[:4]]
    return whole.mapInArrow(run, f"{', '.join(kinds)}, code binary, error long, near binary, bounds binary")


def _sums(assigned: DataFrame, parts: int, entries: int) -> DataFrame:
    """``length``, ``part``, ``entry``, ``place``, ``total``, ``n`` over all parts of an entry."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[int, np.ndarray] = {}
        kind = entry_type(entries)
        for batch in batches:
            lengths = batch.column(0).to_numpy(zero_copy_only=False)
            for length in np.unique(lengths).tolist():
                places = pa.array(np.flatnonzero(lengths == length))
                rows = batch.column(1).take(places).flatten().to_numpy().reshape(len(places), length)
                codes = np.frombuffer(b"".join(batch.column(2).take(places).to_pylist()), kind).reshape(len(places), parts)
                # The last column counts.
                total = totals.setdefault(length, np.zeros((parts, entries, length // parts + 1), np.int64))
                for p in range(parts):
                    own = _cut(rows, p, parts)
                    order = codes[:, p].argsort(kind="stable")
                    used, starts = np.unique(codes[order, p], return_index=True)
                    total[p, used, :-1] += np.add.reduceat(own[order], starts, axis=0)
                    total[p, used, -1] += np.diff(np.append(starts, len(order)))
        for length, total in totals.items():
            p, e, w = (x.ravel() for x in np.indices((parts, entries, length // parts)))
            counts, values = np.repeat(total[:, :, -1].ravel(), length // parts), total[:, :, :-1].ravel()
            used = counts > 0
            columns = [np.full(used.sum(), length), p[used], e[used], w[used], values[used], counts[used]]
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=["length", "part", "entry", "place", "total", "n"])

    coded = assigned.where("code is not null").select("length", "whole", "code")
    partial = coded.mapInArrow(run, "length long, part long, entry long, place long, total long, n long")
    keys = ["length", "part", "entry", "place"]
    return partial.groupBy(*keys).agg(F.sum(F.col("total").cast("decimal(38,0)")).alias("total"), F.sum("n").alias("n"))


def _first_books(whole: DataFrame, parts: int, entries: int) -> Books:
    """The parts of the vectors with the smallest ids, for each length; ``entries`` rows a length reach the driver."""
    order = Window.partitionBy("length").orderBy("vec_id", "whole")
    first = whole.where("vec_id is not null and whole is not null").withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= entries)
    found: dict[int, list] = {}
    for r in sorted(first.select("length", "rank", "whole").collect(), key=lambda r: r["rank"]):
        found.setdefault(r["length"], []).append(r["whole"])
    return {length: np.array(rows).reshape(len(rows), parts, length // parts).transpose(1, 0, 2).copy() for length, rows in found.items()}


def _moved_books(books: Books, sums: DataFrame) -> Books:
    moved = {length: book.copy() for length, book in books.items()}
    for r in sums.collect():  # a row per entry and component
        moved[r.length][r.part, r.entry, r.place] = int(r.total) // r.n
    return moved


def compress(
    embeddings: DataFrame,
    parts: int = 16,
    entries: int = 64,
    scale: int = 256,
    rounds: int = 2,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
    label_column: str = "label",
) -> DataFrame:
    """``vec_id``, ``code``, ``error``, ``label_error``, ``codebooks_sha256``, ``label`` of each kept vector.

    Null vectors and those with null or non-finite components are dropped. A component x
    becomes ``floor(scale * x)``; vectors are cut into ``parts`` equal parts, each position
    with a codebook of its own that starts with the parts of the ``entries`` vectors of
    smallest id (repeated ids: the smaller vector first). In each round every part goes to its
    nearest entry, ties to the lower one, and an entry with parts moves to their floored mean;
    then parts are assigned once more. ``code`` has the entries in hex (two digits each, four
    beyond 256 entries), ``error`` the squared distances, ``label_error`` their sum over rows
    of the same label (nulls together), ``codebooks_sha256`` is over the final entries.

    Repeated rows count each and each gives its row. A vector without an id is coded, but
    starts no entry; with fewer vectors than ``entries`` the codebooks are smaller. Vectors of
    several lengths are coded by codebooks of each length. A vector that can't be coded (its
    length is no multiple of ``parts``, its whole components are so large that squared
    distances pass 2^53, or no vector of its length has an id) keeps its row with null code,
    error and digest, and moves nothing; ``label_error`` is null if its label has no coded
    row. An empty table gives no rows; other columns are not read, whatever their names.
    """
    vectors = embeddings.select(F.col(id_column).alias("vec_id"), F.col(label_column).alias("label"), F.col(vector_column).cast("array<double>").alias("vector"))
    whole = _whole_numbers(vectors, parts, scale)
    books, earlier, held = _first_books(whole, parts, entries), None, whole
    for _ in range(rounds):
        held = stage(_rounds(held, books, earlier), "code-bounds")
        earlier, books = books, _moved_books(books, _sums(held, parts, entries))
    digits = {n: hashlib.sha256(",".join(map(str, book.ravel().tolist())).encode()).hexdigest() for n, book in books.items()}
    last = _rounds(held, books, earlier).select("vec_id", "label", "length", F.lower(F.hex("code")).alias("code"), "error")
    coded = stage(last, "codes")
    spread = coded.groupBy(F.col("label").alias("of")).agg(F.sum("error").alias("label_error"))
    joined = coded.join(spread, F.col("label").eqNullSafe(F.col("of")))
    digest: Column = F.lit(None).cast("string")
    for length, text in digits.items():
        digest = F.when(F.col("length") == length, F.lit(text)).otherwise(digest)
    digest = F.when(F.col("code").isNotNull(), digest)
    return joined.select(F.col("vec_id").alias(id_column), "code", "error", "label_error", digest.alias("codebooks_sha256"), F.col("label").alias(label_column))
