"""Exact top-k BM25 search with an inverted index and matrix products.

Documents are indexed in shards of a few thousand. A shard's documents are dealt to a
few clusters of like words (the languages, for instance), the longest of a cluster first,
so that its lists are dense where they can be and empty elsewhere. For a query, the sum
of its terms' largest weights in a cluster bounds what any document there can score: the
cluster is left out if that is below the query's k-th best score so far. Term weights use
the document frequencies and the mean length of the whole corpus, so the scores of all
shards compare and their results merge exactly.

Queries are compared with a cluster some hundred at a time, those of like length together.
The lists of terms that many of them ask for and many documents hold are rows of a matrix,
fewer for shorter documents, whose products with the queries' factors give their share of
the scores; other lists are added up posting by posting. These sums are in single
precision, with a margin that covers its error; documents that pass are scored again in
double precision, term by term in one order.

Queries go in blocks of bounded size to the groups of shards; a task streams the
shards of its group and keeps the k best of each query, so what it emits grows with
the queries alone.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.memory import release_memory
from millrace.llm.substrings import pack, unpack, word_hashes
from millrace.session import settings, stage

#: Documents in a shard, words in a shard that is full before, and characters whose words are found at once.
SHARD, SHARD_WORDS, CHARACTERS = 4096, 4_000_000, 1_000_000
#: Clusters of a shard at most, the frequent terms that tell them apart, and rounds that move their centers.
CLUSTERS, FEATURES, ROUNDS = 6, 256, 3
#: Longest documents of a cluster, as shares of it, that have matrices of their own; not for clusters of fewer than BLOCK.
SHARES, BLOCK = (1 / 12, 1 / 3), 64
#: Groups of shards that are searched side by side, and queries that one task holds.
GROUPS, QUERIES = 16, 16384
#: Queries that are compared at once and their terms, and lists of a cluster that are rows of a matrix, at most.
TOGETHER, TERMS, ROWS = 512, 400_000, 1024
#: Bytes of queries and shards that a worker is sent at once.
BATCH_BYTES = 8 << 20
#: Matrix elements that cost as much as one posting of a list, and postings that are added up at once.
ELEMENTS, POSTINGS = 300, 250_000
#: Documents that are scored again at once.
AGAIN = 16
#: Relative error of sums of at most ROWS single-precision products of positive numbers, with room.
SLACK = 2e-4
#: No score is less, in single precision.
TINY = 1e-30
#: Saturation and length normalisation of BM25.
K1, B = 1.2, 0.75
#: What a shard's row has, besides the numbers of its documents and words.
PARTS = ("ids", "lengths", "clusters", "terms", "sizes", "docs", "counts")


@cache
def _letters() -> np.ndarray:
    """For each code point: is it a letter or digit?"""
    return np.fromiter((chr(c).isalnum() for c in range(0x110000)), bool, 0x110000)


def _words(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """A 64-bit number of each word of the texts, and the text that holds it."""
    lower = [(t or "").lower() for t in texts]
    codes = np.frombuffer("\n".join(lower).encode("utf-32-le", "surrogatepass"), np.uint32)
    word = np.concatenate([[False], _letters()[codes], [False]])
    edges = np.flatnonzero(word[1:] != word[:-1])
    begin, end = edges[::2], edges[1::2]
    first = np.cumsum([0, *(len(t) + 1 for t in lower)])
    return word_hashes(codes, begin, end).view(np.int64), np.searchsorted(first, begin, side="right") - 1


def _counts(batch: pa.RecordBatch) -> Iterator[tuple[list[int], np.ndarray, np.ndarray]]:
    """Ids of some rows of (id, text), and as ``_words`` the words of their texts."""
    ids, texts, held = [], [], 0
    for i, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
        ids.append(i)
        texts.append(text)
        held += len(text or "")
        if held >= CHARACTERS:
            yield ids, *_words(texts)
            ids, texts, held = [], [], 0
    if ids:
        yield ids, *_words(texts)


def _changes(*values: np.ndarray) -> np.ndarray:
    """Where any of the values differs from the one before."""
    new = np.ones(len(values[0]), bool)
    if len(new):
        new[1:] = np.logical_or.reduce([v[1:] != v[:-1] for v in values])
    return np.flatnonzero(new)


def _clusters(n: int, sizes: np.ndarray, docs: np.ndarray) -> np.ndarray:
    """A cluster for each of ``n`` documents, of the terms' lists ``docs`` of ``sizes``."""
    often = np.argsort(-sizes, kind="stable")[:FEATURES]
    often = often[sizes[often] > 1]
    ends = sizes.cumsum()
    places, row = _ranges(ends[often] - sizes[often], ends[often], np.arange(len(often)))
    has = np.zeros((n, len(often)), np.float32)
    has[docs[places], row] = 1
    has /= np.maximum(np.sqrt(has.sum(1, keepdims=True)), 1)
    if not has.any():
        return np.zeros(n, np.int64)
    # Centers: each the document least like those before, of those that hold many of the terms; then the means of their clusters.
    number = (has > 0).sum(1)
    full = has[number >= np.median(number)]
    centers, like = [full[0]], full @ full[0]
    while len(centers) < CLUSTERS and like.min() < 0.9:
        centers.append(full[like.argmin()])
        like = np.maximum(like, full @ centers[-1])
    middle = np.array(centers)
    for _ in range(ROUNDS):
        cluster = (has @ middle.T).argmax(1)
        for c in range(len(middle)):
            if (cluster == c).any():
                middle[c] = has[cluster == c].mean(0)
        middle /= np.maximum(np.linalg.norm(middle, axis=1, keepdims=True), 1e-9)
    return (has @ middle.T).argmax(1)


def index_shards(documents: DataFrame) -> DataFrame:
    """One row per shard: document ids and lengths, clusters' sizes, terms, sizes of their lists, and (document, count) postings."""

    def shard(ids: list[int], words: np.ndarray, holder: np.ndarray) -> pa.RecordBatch:
        order = np.argsort(words, kind="stable")
        words, document = words[order], holder[order]
        del order
        at = _changes(words, document)
        count = np.diff(at, append=len(words))
        words, document = words[at], document[at]
        starts = _changes(words)
        sizes = np.diff(starts, append=len(words))
        lengths = np.bincount(holder, minlength=len(ids)).astype(np.int64)
        cluster = _clusters(len(ids), sizes, document)
        order = np.lexsort((-lengths, cluster))
        place = np.empty(len(ids), np.int64)
        place[order] = np.arange(len(ids))
        clusters = np.bincount(cluster)
        plain = (np.array(ids, np.int64)[order], lengths[order], clusters[clusters > 0].astype(np.int64), words[starts])
        parts = [p.tobytes() for p in plain] + [pack(p) for p in (sizes, place[document], count)]
        return pa.RecordBatch.from_arrays(
            [pa.array([len(ids)], pa.int64()), pa.array([int(lengths.sum())], pa.int64()), *(pa.array([p], pa.binary()) for p in parts)],
            names=["n", "words", *PARTS],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, words, holders, held = [], [], [], 0
        for batch in batches:
            for own, found, holder in _counts(batch):
                done = 0
                while done < len(own):
                    some = len(own[done : done + SHARD - len(ids)])
                    begin, end = np.searchsorted(holder, [done, done + some])
                    holders.append((holder[begin:end] - done + len(ids)).astype(np.int32))
                    words.append(found[begin:end])
                    ids += own[done : done + some]
                    done, held = done + some, held + end - begin
                    if len(ids) == SHARD or held >= SHARD_WORDS:
                        yield shard(ids, np.concatenate(words), np.concatenate(holders))
                        ids, words, holders, held = [], [], [], 0
        if ids:
            yield shard(ids, np.concatenate(words), np.concatenate(holders))

    rows = documents.where("doc_id is not null").select(F.col("doc_id").cast("long"), "text")
    return rows.mapInArrow(run, f"n long, words long, {', '.join(f'{p} binary' for p in PARTS)}")


def _frequencies(shards: DataFrame) -> DataFrame:
    """``term``, ``df``: documents of the whole corpus that hold a term."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for terms, sizes in zip(batch.column(0), batch.column(1), strict=True):
                yield pa.RecordBatch.from_arrays([pa.array(np.frombuffer(terms.as_py(), np.int64)), pa.array(unpack(sizes.as_py()).view(np.int64))], names=["term", "df"])

    return shards.select("terms", "sizes").mapInArrow(run, "term long, df long").groupBy("term").agg(F.sum("df").alias("df"))


def _query_terms(documents: DataFrame, is_query: Column) -> DataFrame:
    """``query_id``, ``term``, ``n`` of each query's words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for ids, words, holder in _counts(batch):
                order = np.lexsort((words, holder))
                words, holder = words[order], holder[order]
                at = _changes(words, holder)
                parts = (np.array(ids, np.int64)[holder[at]], words[at], np.diff(at, append=len(words)))
                yield pa.RecordBatch.from_arrays([pa.array(p, pa.int64()) for p in parts], names=["query_id", "term", "n"])

    rows = documents.where(F.col("doc_id").isNotNull()).where(is_query).select(F.col("doc_id").cast("long"), "text")
    return rows.mapInArrow(run, "query_id long, term long, n long")


class Queries:
    """Queries as numbered terms, like ones of like length together, and the ``k`` best documents of each so far."""

    def __init__(self, ids: list[int], terms: list[np.ndarray], factors: list[np.ndarray], k: int):
        sizes = np.array([len(t) for t in terms], np.int64)
        every = np.concatenate([*terms, np.empty(0, np.int64)])
        self.terms = np.unique(every)
        number = np.concatenate([np.searchsorted(self.terms, every[x : x + POSTINGS]).astype(np.int32) for x in range(0, max(len(every), 1), POSTINGS)])
        del every
        lists = np.repeat(np.arange(len(ids), dtype=np.int32), sizes)[np.argsort(number, kind="stable")]
        order = np.lexsort((ids, -sizes, _clusters(len(ids), np.bincount(number, minlength=len(self.terms)), lists)))
        self.ids = np.array(ids, np.int64)[order]
        ends = sizes.cumsum()
        places, _ = _ranges((ends - sizes)[order], ends[order], order)
        self.bounds = np.concatenate([[0], sizes[order].cumsum()])
        self.number, self.factors = number[places], np.concatenate([*factors, np.empty(0)])[places]
        self.k = k
        # Places that no document has taken score 0.
        self.best, self.scores = np.full((len(ids), k), np.iinfo(np.int64).max), np.zeros((len(ids), k))

    def enter(self, query: np.ndarray, ids: np.ndarray, scores: np.ndarray) -> None:
        """Enter documents and their scores for some queries."""
        some, number = np.unique(query, return_inverse=True)
        number = np.concatenate([number, np.repeat(np.arange(len(some)), self.k)])
        ids, scores = np.concatenate([ids, self.best[some].ravel()]), np.concatenate([scores, self.scores[some].ravel()])
        order = np.lexsort((ids, -scores, number))
        first = np.searchsorted(number[order], np.arange(len(some)))
        keep = order[(first[:, None] + np.arange(self.k)).ravel()]
        self.best[some], self.scores[some] = ids[keep].reshape(-1, self.k), scores[keep].reshape(-1, self.k)

    def results(self) -> pa.RecordBatch:
        query, place = np.nonzero(self.scores > 0)
        parts = (self.ids[query], self.best[query, place], self.scores[query, place])
        return pa.RecordBatch.from_arrays([pa.array(p) for p in parts], names=["query_id", "doc_id", "score"])


class Cluster:
    """Like documents of a shard, the longest first: the lists of asked terms, some of them as rows of matrices."""

    def __init__(self, first: int, width: int, terms: np.ndarray, docs: np.ndarray, weights: np.ndarray, asked: np.ndarray, copies: int):
        """Postings in the order of ``terms``, ``docs`` counted from the shard's ``first``; ``asked``: by how many queries each term is; ``copies``: the most rows of one id."""
        self.first, self.width, self.copies, n = first, width, copies, len(asked)
        cuts = [0, *(int(width * share) for share in SHARES), width] if width >= BLOCK else [0, width]
        self.parts = [(a, b) for a, b in zip(cuts, cuts[1:], strict=False) if b > a]
        part = np.searchsorted([b for _, b in self.parts], docs, side="right")
        # Postings by term, and a term's by part; behind a list are some of weight 0, so that it can be read as if it were longer.
        key = terms * np.int32(len(self.parts)) + part.astype(np.int32)
        order = np.argsort(key, kind="stable")
        sizes = np.bincount(key, minlength=n * len(self.parts)).reshape(n, len(self.parts))
        whole = sizes.sum(1)
        room = whole + _step(whole) - 1
        self.begin = room.cumsum() - room
        self.end = self.begin + whole
        places, _ = _ranges(self.begin, self.end, whole)
        self.docs, self.weights = np.zeros(int(room.sum()), np.int32), np.zeros(int(room.sum()), np.float32)
        self.docs[places], self.weights[places] = docs[order], weights[order]
        self.most = np.zeros(n, np.float32)
        held = np.flatnonzero(whole)
        if len(held):
            self.most[held] = np.maximum.reduceat(self.weights, self.begin[held])
        # The lists that save most are rows, those of shorter documents as far as they save there too.
        rows = np.flatnonzero(whole * ELEMENTS >= width)
        rows = rows[np.argsort(-(asked * whole)[rows], kind="stable")[:ROWS]]
        self.row = np.full(n, len(rows), np.int32)
        self.row[rows] = np.arange(len(rows))
        self.rows, self.held, self.matrices = rows, sizes[rows].T, []
        start = self.begin[rows]
        for (a, b), own in zip(self.parts, self.held, strict=True):
            places, number = _ranges(start, start + own, np.arange(len(rows)))
            matrix = np.zeros((len(rows), b - a), np.float32)
            matrix[number, self.docs[places] - a] = self.weights[places]
            self.matrices.append(matrix)
            start = start + own

    def sums(self, n: int, number: np.ndarray, at: np.ndarray, factors: np.ndarray) -> np.ndarray:
        """Single-precision scores of ``n`` queries, whose words are the lists ``at`` with ``factors``, for every document."""
        row = self.row[at]
        asked = np.bincount(row, minlength=len(self.rows) + 1)[:-1]
        skipped = np.zeros(len(self.rows) + 1, np.int64)
        deep, depth = [], len(self.rows)
        for (a, b), own in zip(self.parts, self.held, strict=True):
            saved = np.cumsum(asked[:depth] * own[:depth] * ELEMENTS - n * (b - a))
            depth = int(saved.argmax()) + 1 if saved.max(initial=0) > 0 else 0
            deep.append(depth)
            skipped[:depth] += own[:depth]
        wide = np.flatnonzero(row < deep[0])
        factor = np.zeros((n, deep[0]), np.float32)
        factor[number[wide], row[wide]] = factors[wide]
        total = np.empty((n, self.width), np.float32)
        for (a, b), matrix, depth in zip(self.parts, self.matrices, deep, strict=True):
            np.matmul(factor[:, :depth], matrix[:depth], out=total[:, a:b])
        # What matrices have of a list is left out: its documents of the first parts.
        left = np.flatnonzero(row >= deep[-1])
        begin = self.begin[at[left]] + skipped[row[left]]
        sizes = self.end[at[left]] - begin
        some = np.flatnonzero(sizes)
        begin, sizes, number, factors = begin[some], sizes[some], number[left[some]], factors[left[some]]
        sizes += -sizes % _step(sizes)
        first, base = np.searchsorted(number, np.arange(n + 1)), number * self.width
        for x, y in _pieces(np.diff(np.concatenate([[0], sizes.cumsum()])[first])):
            own = slice(first[x], first[y])
            if own.start < own.stop:
                total[x:y] += self._listed(begin[own], sizes[own], base[own] - x * self.width, factors[own], (y - x) * self.width).reshape(y - x, -1)
        return total

    def _listed(self, begin: np.ndarray, sizes: np.ndarray, base: np.ndarray, factors: np.ndarray, n: int) -> np.ndarray:
        """Sums of lists that begin at ``begin``, times ``factors``, at their documents' numbers plus ``base``; lists of a size at once."""
        order = np.argsort(sizes.astype(np.uint16), kind="stable")
        begin, sizes, base, factors = begin[order], sizes[order], base[order, None], factors[order, None]
        columns, weights = np.empty(int(sizes.sum()), np.int64), np.empty(int(sizes.sum()))
        cuts, done = _changes(sizes), 0
        for x, y in zip(cuts.tolist(), [*cuts[1:].tolist(), len(sizes)], strict=True):
            size = int(sizes[x])
            upto = done + size * (y - x)
            lists = [np.ndarray(len(v) - size + 1, f"V{4 * size}", v, strides=4)[begin[x:y]].view(v.dtype).reshape(-1, size) for v in (self.docs, self.weights)]
            np.add(lists[0], base[x:y], out=columns[done:upto].reshape(-1, size))
            np.multiply(lists[1], factors[x:y], out=weights[done:upto].reshape(-1, size))
            done = upto
        return np.bincount(columns, weights, n)


class Shard:
    """An index shard with the term weights of the whole corpus's mean length, as far as the queries ask for its terms."""

    def __init__(self, row: dict, mean_length: float, queries: Queries):
        self.ids = np.frombuffer(row["ids"], np.int64)
        lengths = np.frombuffer(row["lengths"], np.int64)
        terms, sizes = np.frombuffer(row["terms"], np.int64), unpack(row["sizes"]).astype(np.int64)
        at = np.minimum(np.searchsorted(queries.terms, terms), max(len(queries.terms) - 1, 0))
        wanted = queries.terms[at] == terms if len(queries.terms) else np.zeros(len(terms), bool)
        self.terms = int(wanted.sum())
        #: A query's term -> the shard's, the last stands for those that it hasn't.
        self.place = np.full(len(queries.terms), self.terms, np.int32)
        self.place[at[wanted]] = np.arange(self.terms)
        keep = np.repeat(wanted, sizes)
        docs, weights = unpack(row["docs"], "<u2")[keep], unpack(row["counts"], "<u4")[keep].astype(np.float64)
        del keep
        saturation = K1 * (1 - B + B * lengths / max(mean_length, 1e-9))
        for x in range(0, len(docs), POSTINGS):
            some = weights[x : x + POSTINGS]
            some *= (K1 + 1) / (some + saturation[docs[x : x + POSTINGS]])
        term = np.repeat(np.arange(self.terms, dtype=np.int32), sizes[wanted])
        asked = np.bincount(self.place[queries.number], minlength=self.terms + 1)[: self.terms]
        # The same postings by document, each document's in the order of terms.
        order = np.argsort(docs, kind="stable").astype(np.int32)
        self.term_of, self.weight_of = term[order], weights[order]
        self.documents = np.searchsorted(docs[order], np.arange(len(self.ids) + 1))
        self.scored = np.zeros((AGAIN, self.terms))
        self.clusters, first = [], 0
        for width in np.frombuffer(row["clusters"], np.int64).tolist():
            own = np.sort(order[self.documents[first] : self.documents[first + width]])
            copies = int(np.unique(self.ids[first : first + width], return_counts=True)[1].max())
            self.clusters.append(Cluster(first, width, term[own], docs[own].astype(np.int32) - first, weights[own], asked, copies))
            first += width
        #: Bits of the clusters that hold a term.
        self.holders = sum(((c.most > 0).astype(np.int32) << i for i, c in enumerate(self.clusters)), np.zeros(self.terms, np.int32))
        self.most = np.stack([c.most for c in self.clusters], 1) if self.clusters else np.zeros((self.terms, 0), np.float32)

    def search(self, queries: Queries) -> None:
        """Enter the shard's documents that are among each query's best so far."""
        x = 0
        while x < len(queries.ids) and self.terms:
            y = min(x + TOGETHER, max(x + 1, int(np.searchsorted(queries.bounds, queries.bounds[x] + TERMS, side="right")) - 1), len(queries.ids))
            own = slice(queries.bounds[x], queries.bounds[y])
            at = self.place[queries.number[own]]
            here = at < self.terms
            if here.any():
                number = np.repeat(np.arange(y - x), np.diff(queries.bounds[x : y + 1]))[here]
                self._search_together(queries, x, y - x, number, at[here], queries.factors[own][here])
            x = y

    def _search_together(self, queries: Queries, first: int, n: int, number: np.ndarray, at: np.ndarray, factors: np.ndarray) -> None:
        """Search for ``n`` queries from ``first``, whose words are lists ``at`` with ``factors``."""
        begins, words, single = _changes(number), np.searchsorted(number, np.arange(n + 1)), factors.astype(np.float32)
        bound = np.zeros((n, len(self.clusters)))
        bound[number[begins]] = np.add.reduceat(self.most[at] * single[:, None], begins) * (1 + SLACK)
        holders = self.holders[at]
        for c in np.argsort(-bound.sum(0), kind="stable").tolist():
            cluster, least = self.clusters[c], queries.scores[first : first + n, -1]
            taken = (bound[:, c] > 0) & (bound[:, c] >= least)
            some = np.flatnonzero(taken)
            if not len(some):
                continue
            entry = np.flatnonzero(holders & (1 << c))
            if len(some) < n:
                entry = entry[taken[number[entry]]]
            total = cluster.sums(len(some), (taken.cumsum() - 1)[number[entry]], at[entry], single[entry])
            ids = self.ids[cluster.first : cluster.first + cluster.width]
            enough = np.maximum(least[some] * (1 - SLACK), TINY).astype(np.float32)
            hit = total >= enough[:, None]
            # Of many, those that are among the best here, besides the query itself.
            wanted = queries.k + cluster.copies
            many = np.flatnonzero(np.count_nonzero(hit, axis=1) > wanted)
            if len(many):
                kth = np.partition(total[many], cluster.width - wanted, axis=1)[:, cluster.width - wanted]
                hit[many] &= total[many] >= (kth * (1 - 2 * SLACK))[:, None]
            query, found = np.divmod(np.flatnonzero(hit), cluster.width)
            itself = ids[found] == queries.ids[first + some[query]]
            query, found = some[query[~itself]], found[~itself]
            if len(query):
                scores = self._scores(words, at, factors, query, cluster.first + found)
                new = scores >= least[query]
                queries.enter(first + query[new], ids[found[new]], scores[new])

    def _scores(self, words: np.ndarray, at: np.ndarray, factors: np.ndarray, query: np.ndarray, document: np.ndarray) -> np.ndarray:
        """The scores of pairs of query and document, summed in the order of terms."""
        scores = np.zeros(len(query))
        order = np.argsort(document, kind="stable")
        every, begin = np.unique(document[order], return_index=True)
        begin = np.append(begin, len(order))
        for x in range(0, len(every), AGAIN):
            some = every[x : x + AGAIN]
            places, own = _ranges(self.documents[some], self.documents[some + 1], np.arange(len(some)))
            self.scored[own, self.term_of[places]] = self.weight_of[places]
            pairs = order[begin[x] : begin[min(x + AGAIN, len(every))]]
            row = np.searchsorted(some, document[pairs])
            for y, z in _pieces(words[query[pairs] + 1] - words[query[pairs]]):
                entry, pair = _ranges(words[query[pairs[y:z]]], words[query[pairs[y:z]] + 1], np.arange(z - y))
                scores[pairs[y:z]] = np.bincount(pair, self.scored[row[y:z][pair], at[entry]] * factors[entry], z - y)
            self.scored[own, self.term_of[places]] = 0
        return scores


def _step(sizes: np.ndarray) -> np.ndarray:
    """Sizes of lists are rounded up to multiples of this, so that few different ones are left."""
    return 1 << np.maximum(np.frexp(sizes)[1] - 3, 0)


def _pieces(sizes: np.ndarray) -> Iterator[tuple[int, int]]:
    """Runs of items of at most POSTINGS in all, or of one item."""
    upto, x = np.concatenate([[0], sizes.cumsum()]), 0
    while x < len(sizes):
        y = max(x + 1, int(np.searchsorted(upto, upto[x] + POSTINGS, side="right")) - 1)
        yield x, y
        x = y


def _ranges(begins: np.ndarray, ends: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All numbers of the ranges one after another, and each range's value beside them."""
    sizes = ends - begins
    first = np.cumsum(sizes) - sizes
    return np.arange(sizes.sum()) + np.repeat(begins - first, sizes), np.repeat(values, sizes)


def search(documents: DataFrame, is_query: Column, k: int = 10) -> DataFrame:
    """``query_id``, ``rank``, ``doc_id``, ``score``: the ``k`` documents of highest BM25 for each query row, without itself.

    ``is_query`` is a condition on ``doc_id``; a query is its row's whole text, each word as
    often as it occurs there. Words are runs of letters and digits in lower case. Ties go to
    the smaller doc_id. Rows without doc_id take no part; a null or empty text, or one without
    words, is found by no query and finds nothing; documents that share no word with a query
    are not its results. Repeated rows are results of their own. An empty table gives no rows.
    """
    shards = stage(index_shards(documents), "search-index")
    total, words = shards.agg(F.sum("n"), F.sum("words")).first()
    total, mean_length = total or 0, (words or 0) / max(total or 0, 1)
    idf = F.log(1 + (total - F.col("df") + 0.5) / (F.col("df") + 0.5))
    # A term that one document holds finds nothing but the query itself.
    known = _frequencies(shards).where("df > 1")
    weighted = _query_terms(documents, is_query).join(known, "term").select("query_id", "term", (idf * F.col("n")).alias("factor"))
    # One row per query: its terms in one order, so that equal documents get equal sums.
    asked = weighted.groupBy("query_id").agg(F.array_sort(F.collect_list(F.struct("term", "factor"))).alias("words"))
    asked = stage(asked.select("query_id", "words.term", "words.factor"), "search-queries")
    blocks = max(1, -(-asked.count() // QUERIES))
    groups = F.explode(F.sequence(F.lit(0), F.lit(GROUPS - 1)))
    left = asked.withColumn("block", F.pmod(F.xxhash64("query_id"), F.lit(blocks)).cast("int")).withColumn("group", groups).withColumn("side", F.lit(0))
    right = shards.withColumn("group", F.pmod(F.xxhash64(F.substring("ids", 1, 64)), F.lit(GROUPS)).cast("int")).withColumn("side", F.lit(1))
    right = right.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    columns = ["group", "block", "side", "query_id", "term", "factor", *PARTS]
    rows = left.unionByName(right.select("group", "block", "side", *PARTS), allowMissingColumns=True).select(columns)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release_memory()
        key, read, queries = None, ([], [], []), None
        for batch in batches:
            for i in range(batch.num_rows):
                row = {n: batch.column(n)[i] for n in columns}
                if (row["group"].as_py(), row["block"].as_py()) != key:
                    if queries:
                        yield queries.results()
                    key, read, queries = (row["group"].as_py(), row["block"].as_py()), ([], [], []), None
                if row["side"].as_py() == 0:
                    read[0].append(row["query_id"].as_py())
                    read[1].append(row["term"].values.to_numpy().copy())  # lets the batch go
                    read[2].append(row["factor"].values.to_numpy().copy())
                    continue
                if queries is None:
                    queries, read = Queries(*read, k), ([], [], [])
                    release_memory()
                shard = Shard({n: row[n].as_py() for n in PARTS}, mean_length, queries)
                release_memory()
                shard.search(queries)
                del shard, row  # before the next one is unpacked
                release_memory()
        if queries:
            yield queries.results()

    dealt = rows.repartition("group", "block").sortWithinPartitions("group", "block", "side")
    with settings(documents.sparkSession, **{"spark.sql.execution.arrow.maxBytesPerBatch": str(BATCH_BYTES)}):
        found = stage(dealt.mapInArrow(run, "query_id long, doc_id long, score double"), "search-found")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "doc_id"))
    return found.withColumn("rank", rank.cast("int")).where(F.col("rank") <= k).select("query_id", "rank", "doc_id", "score")
