"""Exact Jaccard links between documents' word n-grams, by signature trees.

1. Hashing. Each text becomes its set of n-gram hashes; equal sets are one set.
2. Sharing. The grams of all sets are dealt by hash to buckets, which mark the grams
   that two different sets hold. A set with fewer shared grams than a link needs is
   done. Frequent grams, found by counting, are known to be shared and skip this step.
3. Families. Sets that agree on a gram of their prefixes (rarest grams first) may be
   linked; all others cannot. The connected families are cut into leaves of bounded
   size by set size.
4. Trees. Two leaves, or a leaf and itself, are compared in one task. Each leaf is a
   tree whose nodes hold the OR of their sets' gram bitmaps and the range of their
   sizes. Both trees are descended together, and a pair of nodes goes on only if its
   largest possible overlap reaches what a link needs and its sets aren't connected
   yet. Pairs of sets that remain are compared gram by gram.
5. Leaves of a large family are first compared with themselves and their neighbours;
   a second pass compares the other pairs of leaves that are not all connected by then.

Every step is exact: frequency only sets the order of grams, never what counts.
Hashes have 64 bits, of which grams that aren't frequent keep 48 and their bucket's number; set digests have 64.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.components import connected_components
from millrace.operators.ordinals import with_ordinal
from millrace.session import stage

#: Characters of text whose grams are dealt together, and that are hashed at once.
CHUNK_CHARS, HASHED_CHARS = 4_000_000, 500_000
#: A gram is frequent from this many documents on, counted in the chunks that hold it at least LOCAL times; at most FREQUENT of them are broadcast (8 bytes each).
FREQUENT_FROM, LOCAL, FREQUENT = 64, 4, 200_000
#: Documents whose grams fill one bucket, on average.
BUCKET_DOCUMENTS = 4096
#: Sets in a leaf, children of a tree node. A large family's sets are sent once for each pair of leaves, so leaves are as large as a task holds with ease.
LEAF, FAN_OUT = 1024, 8

_BASE = np.uint64(0x9E3779B97F4A7C15)
_MIX = (np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB))


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * _MIX[0]
    x = (x ^ (x >> np.uint64(27))) * _MIX[1]
    return x ^ (x >> np.uint64(31))


_BYTE_VALUE = _mixed(np.arange(1, 257, dtype=np.uint64) * _BASE)
_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))


def gram_sets(texts: list[str | None], size: int = 4) -> list[np.ndarray]:
    """``_hashed_grams`` of all texts, some at a time."""
    out, first, length = [], 0, 0
    for i, text in enumerate(texts):
        length += len(text or "")
        if length >= HASHED_CHARS or i == len(texts) - 1:
            out += _hashed_grams(texts[first : i + 1], size)
            first, length = i + 1, 0
    return out


def _hashed_grams(texts: list[str | None], size: int) -> list[np.ndarray]:
    """The sorted distinct hashes of each text's word n-grams.

    Words are runs of bytes other than space and 0x09 to 0x0D, A-Z in lower case. Fewer
    words than ``size`` make one gram; no words make an empty set. A word's hash is a
    polynomial over its bytes modulo 2**64, mixed; words over 200 bytes use BLAKE2b.
    """
    data = [(t or "").encode("utf-8", "replace") for t in texts]
    joined = b" ".join([*data, b""])
    codes = np.frombuffer(joined, np.uint8)
    if not len(codes):
        return []
    upper = (codes >= 65) & (codes <= 90)
    codes = codes + (upper * np.uint8(32))
    word = ~((codes == 32) | ((codes >= 9) & (codes <= 13)))
    edge = np.diff(word.astype(np.int8), prepend=np.int8(0), append=np.int8(0))
    begins, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    powers = np.full(len(codes), _BASE)
    powers[0] = 1
    powers = np.multiply.accumulate(powers)
    sums = np.concatenate([[np.uint64(0)], np.cumsum(_BYTE_VALUE[codes] * powers)])
    # Dividing by the power of the word's first byte makes the hash independent of its place.
    back = np.full(len(codes) + 1, _INVERSE)
    back[0] = 1
    back = np.multiply.accumulate(back)
    hashed = _mixed((sums[ends] - sums[begins]) * back[begins] + (ends - begins).astype(np.uint64))
    for i in np.flatnonzero(ends - begins > 200).tolist():
        hashed[i] = int.from_bytes(hashlib.blake2b(codes[begins[i] : ends[i]].tobytes(), digest_size=8).digest(), "little")
    firsts = np.cumsum([0, *(len(d) + 1 for d in data)])
    bounds = np.searchsorted(begins, firsts).tolist()
    grams = np.zeros(max(len(hashed) - size + 1, 0), np.uint64)
    for k in range(size):
        grams = _mixed(grams + hashed[k : k + len(grams)] + np.uint64(k))
    out = []
    for x, y in zip(bounds, bounds[1:], strict=False):
        if y - x >= size:
            out.append(np.unique(grams[x : y - size + 1]))
        elif y > x:
            whole = np.zeros(1, np.uint64)
            for i in range(x, y):
                whole = _mixed(whole + hashed[i : i + 1])
            out.append(_mixed(whole + np.uint64(y - x)))
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def _digest(grams: np.ndarray) -> bytes:
    return hashlib.blake2b(grams.tobytes(), digest_size=8).digest()


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list, list[str | None]]]:
    """(ids, texts) with about ``CHUNK_CHARS`` of text in each."""
    ids, texts, size = [], [], 0
    for batch in batches:
        for i, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            ids.append(i)
            texts.append(text)
            size += len(text or "")
            if size >= CHUNK_CHARS:
                yield ids, texts
                ids, texts, size = [], [], 0
    if ids:
        yield ids, texts


def _different(sets: list[np.ndarray]) -> dict[bytes, np.ndarray]:
    return {_digest(s): s for s in sets if len(s)}


def members_and_counts(documents: DataFrame, size: int) -> DataFrame:
    """A row for each document (``doc_id``, ``n``, ``digest``) and one for each gram that a chunk often holds (``gram``, ``n``)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, texts in _chunks(batches):
            sets = gram_sets(texts, size)
            digests = [_digest(s) if len(s) else None for s in sets]
            grams, counts = np.unique(np.concatenate([*dict(zip(digests, sets, strict=True)).values(), np.zeros(0, np.uint64)]), return_counts=True)
            often = counts >= LOCAL
            gaps, more = pa.nulls(len(ids), pa.int64()), int(often.sum())
            for arrays in (
                [pa.array(ids, pa.int64()), pa.array([len(s) for s in sets], pa.int64()), pa.array(digests, pa.binary()), gaps],
                [pa.nulls(more, pa.int64()), pa.array(counts[often], pa.int64()), pa.nulls(more, pa.binary()), pa.array(grams[often].view(np.int64))],
            ):
                yield pa.RecordBatch.from_arrays(arrays, names=["doc_id", "n", "digest", "gram"])

    return documents.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, "doc_id long, n long, digest binary, gram long")


def frequent_grams(counts: DataFrame) -> np.ndarray:
    """The most frequent grams, rarest first: counts over all documents, each set once per chunk."""
    counted = counts.where("gram is not null").groupBy("gram").agg(F.sum("n").alias("n"))
    top = counted.where(F.col("n") >= FREQUENT_FROM).orderBy(F.desc("n"), "gram").limit(FREQUENT).toArrow()
    return top["gram"].to_numpy().view(np.uint64)[::-1].copy()


def _needed(n: np.ndarray | int, percent: int) -> np.ndarray | int:
    """The smallest overlap with which a set of n grams can have a link: percent % of n, rounded up."""
    return -(-n * percent // 100)


_PARTS = ("owners", "sizes", "counts", "grams")
_PART_SCHEMA = "bucket long, source long, owners binary, sizes binary, counts binary, grams binary"


def _part_batch(rows: list[tuple]) -> list[pa.Array]:
    columns = list(zip(*rows, strict=True)) or [()] * 6
    return [pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.int64(), *[pa.binary()] * 4), strict=True)]


def _by_owner_bucket(digests: np.ndarray, buckets: int) -> np.ndarray:
    return (digests % np.uint64(buckets)).astype(np.int64)


def gram_rows(documents: DataFrame, size: int, frequent: np.ndarray, buckets: int) -> DataFrame:
    """What a chunk's sets hold in each bucket of grams: their digests, how many grams each has there, and the grams.

    Grams known to be frequent need no partner to be found; a set's size and its own
    frequent grams go, as source -1, to the bucket that its digest names, numbered below 0.
    """
    sent = documents.sparkSession.sparkContext.broadcast(np.sort(frequent))
    shift = np.uint64(64 - int(math.log2(buckets)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = sent.value
        for _, texts in _chunks(batches):
            different = _different(gram_sets(texts, size))
            digests = np.frombuffer(b"".join(different), np.uint64)
            sizes = np.array([len(s) for s in different.values()], np.int64)
            order = np.argsort(_by_owner_bucket(digests, buckets), kind="stable")
            sets = list(different.values())
            grams = np.concatenate([*(sets[i] for i in order), np.zeros(0, np.uint64)])
            digests, sizes = digests[order], sizes[order]
            owner = np.repeat(np.arange(len(digests)), sizes)
            common = np.zeros(len(grams), bool)
            if len(known) and len(grams):
                common = known[np.minimum(np.searchsorted(known, grams), len(known) - 1)] == grams
            per = np.bincount(owner[common], minlength=len(digests))
            own, ends = grams[common], np.concatenate([[0], np.cumsum(per)])
            cuts = np.searchsorted(_by_owner_bucket(digests, buckets), np.arange(buckets + 1)).tolist()
            rows = [
                (-1 - b, -1, digests[x:y].tobytes(), sizes[x:y].astype("<u4").tobytes(), per[x:y].astype("<u4").tobytes(), own[ends[x] : ends[y]].tobytes())
                for b, (x, y) in enumerate(zip(cuts, cuts[1:], strict=False))
                if y > x
            ]
            grams, owner = grams[~common], owner[~common]
            bucket = (grams >> shift).astype(np.int64)
            order = np.argsort(bucket, kind="stable")
            grams, owner = grams[order], owner[order]
            cuts = np.searchsorted(bucket[order], np.arange(buckets + 1)).tolist()
            for b, (x, y) in enumerate(zip(cuts, cuts[1:], strict=False)):
                if y > x:
                    held, counts = np.unique(owner[x:y], return_counts=True)
                    rows.append((b, b, digests[held].tobytes(), b"", counts.astype("<u4").tobytes(), _packed(grams[x:y])))
            yield pa.RecordBatch.from_arrays(_part_batch(rows), names=["bucket", "source", *_PARTS])

    return documents.select("doc_id", "text").mapInArrow(run, _PART_SCHEMA)


def _packed(grams: np.ndarray) -> bytes:
    """The low 48 bits of each gram: the bucket number says the rest."""
    return grams.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :6].tobytes()


def _unpacked(data: bytes) -> np.ndarray:
    low = np.frombuffer(data, np.uint8).reshape(-1, 6)
    return np.concatenate([low, np.zeros((len(low), 2), np.uint8)], axis=1).view("<u8").ravel()


def shared_grams(rows: DataFrame, buckets: int) -> DataFrame:
    """The grams that other sets hold too, dealt to the buckets of their sets; rows of buckets below 0 go through."""

    def run(group: pa.Table) -> pa.Table:
        names = ["bucket", "source", *_PARTS]
        source = group["bucket"][0].as_py()
        if source < 0:
            return group.select(names)
        owner = np.concatenate([np.repeat(np.frombuffer(o, np.uint64), np.frombuffer(c, "<u4")) for o, c in zip(group["owners"].to_pylist(), group["counts"].to_pylist(), strict=True)])
        low = np.concatenate([_unpacked(g) for g in group["grams"].to_pylist()])
        order = np.lexsort((owner, low))
        low, owner = low[order], owner[order]
        # A set that several chunks hold counts once.
        first = np.ones(len(low), bool)
        first[1:] = (low[1:] != low[:-1]) | (owner[1:] != owner[:-1])
        low, owner = low[first], owner[first]
        same = low[1:] == low[:-1]
        shared = np.zeros(len(low), bool)
        shared[1:] |= same
        shared[:-1] |= same
        low, owner = low[shared], owner[shared]
        order = np.lexsort((owner, _by_owner_bucket(owner, buckets)))
        low, owner = low[order], owner[order]
        cuts = np.searchsorted(_by_owner_bucket(owner, buckets), np.arange(buckets + 1)).tolist()
        out = []
        for b, (x, y) in enumerate(zip(cuts, cuts[1:], strict=False)):
            if y > x:
                held, counts = np.unique(owner[x:y], return_counts=True)
                out.append((-1 - b, source, held.tobytes(), b"", counts.astype("<u4").tobytes(), _packed(low[x:y])))
        return pa.Table.from_arrays(_part_batch(out), names=names)

    return rows.groupBy("bucket").applyInArrow(run, _PART_SCHEMA)


def candidate_sets(rows: DataFrame, frequent: np.ndarray, buckets: int, percent: int) -> DataFrame:
    """``digest``, ``n``, ``grams`` (sorted, shared ones only) and ``prefix`` of the sets that may have a link."""
    sent = rows.sparkSession.sparkContext.broadcast(frequent)
    shift = np.uint64(64 - int(math.log2(buckets)))

    def run(group: pa.Table) -> pa.Table:
        known = sent.value
        by_value = np.argsort(known)
        owners, grams, names, sizes = [], [], [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
        for source, own, size, counts, data in zip(*(group[c].to_pylist() for c in ("source", *_PARTS)), strict=True):
            digests = np.frombuffer(own, np.uint64)
            owners.append(np.repeat(digests, np.frombuffer(counts, "<u4")))
            if source < 0:
                names.append(digests)
                sizes.append(np.frombuffer(size, "<u4").astype(np.int64))
                grams.append(np.frombuffer(data, "<u8"))
            else:
                grams.append(_unpacked(data) | (np.uint64(source) << shift))
        owner, gram = np.concatenate(owners), np.concatenate(grams)
        order = np.lexsort((gram, owner))
        owner, gram = owner[order], gram[order]
        first = np.ones(len(gram), bool)
        first[1:] = (gram[1:] != gram[:-1]) | (owner[1:] != owner[:-1])
        owner, gram = owner[first], gram[first]
        name, at = np.unique(np.concatenate(names), return_index=True)
        size = np.concatenate(sizes)[at]
        begins, ends = np.searchsorted(owner, name), np.searchsorted(owner, name, side="right")
        needed = _needed(size, percent)
        out = []
        for i in np.flatnonzero((ends - begins >= needed) & (size > 0)).tolist():
            own, n = gram[begins[i] : ends[i]], int(size[i])
            rank = np.zeros(len(own), np.int64)
            if len(known):
                place = np.minimum(np.searchsorted(known, own, sorter=by_value), len(known) - 1)
                rank = np.where(known[by_value[place]] == own, by_value[place] + 1, 0)
            # Grams that only this set holds come first in the order and can't meet another set.
            prefix = np.lexsort((own, rank))[: len(own) - int(needed[i]) + 1]
            out.append((name[i].tobytes(), n, own.tobytes(), own[prefix].view(np.int64)))
        columns = list(zip(*out, strict=True)) or [(), (), (), ()]
        types = (pa.binary(), pa.int64(), pa.binary(), pa.list_(pa.int64()))
        return pa.Table.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=["digest", "n", "grams", "prefix"])

    return rows.groupBy("bucket").applyInArrow(run, "digest binary, n long, grams binary, prefix array<long>")


class _Tree:
    """Nodes over sets in the order of their smallest grams; level 0 holds the sets themselves."""

    def __init__(self, sets: list[np.ndarray], sizes: np.ndarray, labels: np.ndarray, words: int):
        order = np.lexsort((sizes, [s[0] for s in sets]))
        self.order = order
        bits = np.zeros((len(sets), words), np.uint64)
        for row, i in enumerate(order):
            place = sets[i] & np.uint64(64 * words - 1)
            np.bitwise_or.at(bits[row], (place >> np.uint64(6)).astype(np.int64), np.uint64(1) << (place & np.uint64(63)))
        most = np.array([len(sets[i]) for i in order])
        extra = most - np.bitwise_count(bits).sum(1).astype(np.int64)
        self.levels = [(bits, sizes[order], sizes[order], extra)]
        while len(self.levels[-1][0]) > 1:
            b, low, high, extra = self.levels[-1]
            starts = np.arange(0, len(b), FAN_OUT)
            self.levels.append((np.bitwise_or.reduceat(b, starts), np.minimum.reduceat(low, starts), np.maximum.reduceat(high, starts), np.maximum.reduceat(extra, starts)))

    def children(self, level: int, node: int) -> tuple[int, np.ndarray]:
        if level == 0:
            return 0, np.array([node])
        return level - 1, np.arange(node * FAN_OUT, min((node + 1) * FAN_OUT, len(self.levels[level - 1][0])))


def linked_pairs(left: list[np.ndarray], left_n: np.ndarray, left_label: np.ndarray, right: tuple | None, percent: int) -> list[tuple[int, int]]:
    """Links that connect the sets of one leaf, or of two, as far as labels don't: numbers in left, then right."""
    sets, sizes, labels = left, left_n, left_label
    if right:
        sets, sizes, labels = [*left, *right[0]], np.concatenate([left_n, right[1]]), np.concatenate([left_label, right[2]])
    parent = {}
    for number, label in enumerate(labels.tolist()):
        parent.setdefault(label, number)
    roots = [parent[label] for label in labels.tolist()]

    def find(i: int) -> int:
        while roots[i] != i:
            roots[i] = roots[roots[i]]
            i = roots[i]
        return i

    links = []

    def compare(i: int, j: int) -> None:
        x, y = find(i), find(j)
        if x == y:
            return
        a, b = sets[i], sets[j]
        both = np.concatenate([a, b])
        both.sort()
        overlap = int((both[1:] == both[:-1]).sum())
        if 100 * overlap >= percent * (int(sizes[i]) + int(sizes[j]) - overlap):
            roots[y] = x
            links.append((i, j))

    if len(sets) <= 3:
        for j in range(len(sets)):
            for i in range(j):
                compare(i, j)
        return links
    words = 1 << max(0, math.ceil(math.log2(max(map(len, sets)) * 4 / 64)))
    words = min(words, 128)
    one = _Tree(left, left_n, left_label, words)
    two = _Tree(right[0], right[1], right[2], words) if right else one
    shift = len(left) if right else 0
    todo = [(len(one.levels) - 1, 0, len(two.levels) - 1, 0)]
    while todo:
        la, a, lb, b = todo.pop()
        if la == lb == 0:
            i, j = int(one.order[a]), int(two.order[b]) + shift
            if right or a != b:
                compare(i, j)
            continue
        # The taller node is opened; both when they are equal.
        na, ca = one.children(la, a) if la >= lb else (la, np.array([a]))
        nb, cb = two.children(lb, b) if lb >= la else (lb, np.array([b]))
        bits_a, low_a, high_a, extra_a = (x[ca] for x in one.levels[na])
        bits_b, low_b, high_b, extra_b = (x[cb] for x in two.levels[nb])
        common = np.bitwise_count(bits_a[:, None] & bits_b[None]).sum(2).astype(np.int64)
        most = common + np.minimum(extra_a[:, None], extra_b[None])
        least = low_a[:, None] + low_b[None]
        fits = (100 * most >= percent * (least - most)) & (100 * high_a[:, None] >= percent * low_b[None]) & (100 * high_b[None] >= percent * low_a[:, None])
        for x, y in zip(*(v.tolist() for v in np.nonzero(fits)), strict=True):
            if right or na != nb or ca[x] <= cb[y]:
                todo.append((na, int(ca[x]), nb, int(cb[y])))
    return links


def _links(units: DataFrame, percent: int) -> DataFrame:
    """``a``, ``b``: links found in each unit; its rows are the sets of side 0 and, for two leaves, of side 1.

    One leaf is compared with itself, two with each other; a unit named "next:" does both for its side 0.
    """

    def found(rows: list[tuple]) -> list[tuple[bytes, bytes]]:
        rows.sort(key=lambda r: (r[1], r[2]))
        halves = [[r for r in rows if r[1] == side] for side in (0, 1)]
        parts = []
        for half in halves:
            sets = [np.frombuffer(r[5], "<u8") for r in half]
            parts.append((sets, np.array([r[3] for r in half], np.int64), np.array([r[4] for r in half])))
        names = [r[2] for half in halves for r in half]
        (sets, sizes, labels), other = parts
        if not sets:  # its other leaf has a unit of its own
            return []
        pairs = []
        if rows[0][0].startswith("next:") or not other[0]:
            pairs = linked_pairs(sets, sizes, labels, None, percent)
            for i, j in pairs:
                labels = np.where(labels == labels[j], labels[i], labels)
        if other[0]:
            pairs += linked_pairs(sets, sizes, labels, other, percent)
        return [(names[i], names[j]) for i, j in pairs]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unit, rows = None, []

        def batch_of(pairs: list[tuple[bytes, bytes]]) -> pa.RecordBatch:
            columns = list(zip(*pairs, strict=True)) or [(), ()]
            return pa.RecordBatch.from_arrays([pa.array(c, pa.binary()) for c in columns], names=["a", "b"])

        for batch in batches:
            pairs = []
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if row[0] != unit:
                    pairs += found(rows)
                    unit, rows = row[0], []
                rows.append(row)
            yield batch_of(pairs)
        yield batch_of(found(rows))

    dealt = units.select("unit", "side", "digest", "n", "label", "grams").repartition("unit").sortWithinPartitions("unit")
    return dealt.mapInArrow(run, "a binary, b binary")


def _leaves(sets: DataFrame, families: DataFrame, percent: int) -> DataFrame:
    """Sets of families with ``family``, ``band`` (sizes of a band and the next one may be linked) and ``slot``.

    ``up`` and ``down``: the next or the previous band of the family is there too, and both have one leaf. The
    places are found without the grams, which move once. A family has few bands: their sizes grow by a factor.
    """
    band = F.floor(F.log(F.col("n").cast("double")) / -math.log(percent / 100) * (1 - 1e-9)).cast("int")
    labels = families.select(F.col("node").alias("digest"), F.col("label").alias("family"))
    placed = sets.select("digest", "n").join(labels, "digest").withColumn("band", band).drop("n")
    counts = placed.groupBy("family", "band").agg(F.count("*").alias("members"))
    counts = counts.withColumn("slots", F.ceil(F.col("members") / LEAF).cast("int"))
    upwards = Window.partitionBy("family").orderBy("band")

    def beside(step: int) -> Column:
        near = F.lead("band", step).over(upwards) == F.col("band") + step
        return F.coalesce(near & (F.lead("slots", step).over(upwards) == 1) & (F.col("slots") == 1), F.lit(False))

    bands = counts.withColumns({"up": beside(1), "down": beside(-1)})
    placed = placed.join(bands, ["family", "band"]).withColumn("slot", F.pmod(F.xxhash64("digest"), F.col("slots")).cast("int"))
    return sets.select("digest", "n", "grams").join(placed, "digest")


def _unit(*columns: str) -> Column:
    return F.md5(F.concat_ws("/", *(F.hex(c) if c == "family" else F.col(c).cast("string") for c in columns)))


def component_links(sets: DataFrame, percent: int) -> DataFrame:
    """Edges ``a``, ``b`` between sets whose Jaccard similarity reaches the limit; they connect all that links connect."""
    grams = sets.select(F.explode("prefix").alias("gram"), "digest")
    meeting = grams.groupBy("gram").agg(F.min("digest").alias("root"))
    families = connected_components(grams.join(meeting, "gram").select(F.col("root").alias("a"), F.col("digest").alias("b")))
    leaves = stage(_leaves(sets, families, percent), "jaccard-leaves")
    plain = leaves.withColumn("label", F.col("digest"))
    # A band in one leaf that has such a neighbour is compared with itself where it is compared with that.
    own = plain.where("slots = 1 and members > 1 and not up").withColumn("side", F.lit(0)).withColumn("unit", _unit("family", "band", "slot"))
    # A large band's leaves are compared with themselves and the next leaf, so that a family of near copies is connected early.
    many = plain.where("slots > 1")
    following = many.withColumn("side", F.lit(0)).withColumn("first", F.col("slot")).unionByName(
        many.withColumn("side", F.lit(1)).withColumn("first", F.pmod(F.col("slot") - 1, F.col("slots")))
    )
    following = following.withColumn("unit", F.concat(F.lit("next:"), _unit("family", "band", "first")))
    columns = ["unit", "side", "digest", "n", "label", "grams"]
    # Bands with a neighbour, both in one leaf.
    beside = plain.where("up").withColumn("side", F.lit(0)).withColumn("low", F.col("band"))
    beside = beside.unionByName(plain.where("down").withColumn("side", F.lit(1)).withColumn("low", F.col("band") - 1))
    beside = beside.withColumn("unit", F.concat(F.lit("next:"), _unit("family", "low")))
    first = stage(_links(own.select(columns).unionByName(following.select(columns)).unionByName(beside.select(columns)), percent), "jaccard-links")
    # Second pass: pairs of leaves of large families that have not met and are not all connected.
    large = leaves.groupBy("family", "band").agg(F.max("slots").alias("slots")).groupBy("family").agg(F.max("slots").alias("most")).where("most > 1").select("family")
    rest = leaves.select("digest", "family", "band", "slot", "slots").join(large, "family")
    if rest.isEmpty():
        return first
    known = connected_components(first).select(F.col("node").alias("digest"), "label")
    rest = stage(rest.join(known, "digest", "left").withColumn("label", F.coalesce("label", "digest")), "jaccard-rest")
    summary = rest.groupBy("family", "band", "slot", "slots").agg(F.min("label").alias("low"), F.max("label").alias("high"))
    other = summary.select("family", F.col("band").alias("band2"), F.col("slot").alias("slot2"), F.col("slots").alias("slots2"), F.col("low").alias("low2"), F.col("high").alias("high2"))
    far = (F.col("slot2") > F.col("slot") + 1) & ((F.col("slot") > 0) | (F.col("slot2") < F.col("slots") - 1))
    near = (F.col("band2") == F.col("band")) & far | (F.col("band2") == F.col("band") + 1) & ((F.col("slots") > 1) | (F.col("slots2") > 1))
    settled = (F.col("low") == F.col("high")) & (F.col("low2") == F.col("high2")) & (F.col("low") == F.col("low2"))
    pairs = summary.join(other, "family").where(near & ~settled)
    pairs = pairs.withColumn("unit", _unit("family", "band", "slot", "band2", "slot2"))
    one = pairs.select("unit", "family", "band", "slot", F.lit(0).alias("side"))
    two = pairs.select("unit", "family", F.col("band2").alias("band"), F.col("slot2").alias("slot"), F.lit(1).alias("side"))
    units = one.unionByName(two).join(rest, ["family", "band", "slot"]).select("unit", "side", "digest", "label")
    units = units.join(leaves.join(large, "family").select("digest", "n", "grams"), "digest").select(columns)
    return first.unionByName(_links(units, percent))


def components(documents: DataFrame, percent: int = 85, size: int = 4) -> DataFrame:
    """``doc_id``, ``n_shingles``, ``component_id`` of every document.

    Two documents link when 100 * intersection >= percent * union of their word n-gram sets;
    ``component_id`` is the smallest doc_id that links reach. Texts without words (null, empty,
    blank) have 0 shingles and stay alone. Repeated rows are copies of each other and each
    gives its row; a null doc_id gives a row but is nobody's component id unless all are null.
    An empty table gives no rows; other columns are not read.
    """
    buckets = 1 << max(4, math.ceil(math.log2(max(1, documents.count()) / BUCKET_DOCUMENTS)))
    first = stage(members_and_counts(documents, size), "jaccard-members")
    frequent = frequent_grams(first)
    members = first.where("gram is null").select("doc_id", "n", "digest")
    sets = stage(candidate_sets(shared_grams(gram_rows(documents, size, frequent, buckets), buckets), frequent, buckets, percent), "jaccard-sets")
    links = component_links(sets, percent)
    labels = connected_components(links).select(F.col("node").alias("digest"), "label")
    # The smallest doc_id of each set, then of each component: counted before they move, so copies don't pile up.
    lowest = members.where("n > 0").groupBy("digest").agg(F.min("doc_id").alias("low")).join(labels, "digest", "left")
    lowest = lowest.withColumn("label", F.coalesce("label", "digest"))
    tops = lowest.groupBy("label").agg(F.min("low").alias("top"))
    found = lowest.join(tops, "label").select("digest", "top")
    return members.join(found, "digest", "left").select("doc_id", F.col("n").alias("n_shingles"), F.coalesce("top", "doc_id").alias("component_id"))


def keep_one(documents: DataFrame, percent: int = 85, size: int = 4) -> DataFrame:
    """One row of each component, that of the smallest doc_id, all columns as they were.

    Unlike ``keep_first``, repeated rows and copies without a doc_id go too; null ids rank
    last. Texts without words stay.
    """
    # Numbers in the order of doc_id stand in for it, so that every row has an id of its own.
    numbered, _ = with_ordinal(documents, [F.isnull("doc_id"), "doc_id", F.xxhash64("text")], "__row")
    found = components(numbered.select(F.col("__row").alias("doc_id"), "text"), percent, size)
    gone = found.where("doc_id <> component_id").select(F.col("doc_id").alias("__row"))
    return numbered.join(gone, "__row", "left_anti").select(documents.columns)


def keep_first(documents: DataFrame, percent: int = 85, size: int = 4) -> DataFrame:
    """The documents that are their component's smallest doc_id, all columns as they were; texts without words stay."""
    found = components(documents, percent, size).where("doc_id <> component_id").select("doc_id").distinct()
    return documents.join(found, "doc_id", "left_anti")
