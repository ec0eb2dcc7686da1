"""Toxicity from misspelled lexicon terms and the context they stand in.

The lexicon is learned from a bounded labelled sample: words and word beginnings
that occur in toxic texts and hardly elsewhere. It is kept as a trie. A Levenshtein
automaton runs over a word and the trie at the same time: its states are sets of
(trie node, edits so far), made on demand and remembered, so a word costs one
lookup per character and most words die after a few. Each (term, edits) has the
precision it showed in the sample; hits that a pair of quotation marks in the
context window encloses count half; the hits of a text combine as a noisy or.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.samples import labelled_sample, remainder
from millrace.session import stage

#: Labelled rows of each class that the lexicon is learned from at most.
PER_CLASS = 4000
#: Terms of the lexicon at most, the fewest texts a term must explain that no earlier one does, and the share of toxic texts among those that hold it.
TERMS, FEWEST, PRECISION = 500, 3, 0.9
#: Lengths of word beginnings that may become terms, and the shortest whole word.
STEMS, SHORTEST = (4, 5, 6), 3
#: Words on each side of a hit that are searched for quotation marks, and the weight of a quoted hit.
WINDOW, QUOTED = 12, 0.5
#: Precision of a hit with 0, 1, 2 edits before the sample is counted, as that many texts.
BELIEF, BELIEF_TEXTS = (0.95, 0.8, 0.6), 2.0
#: Verdicts on words that a task remembers, and automaton states.
REMEMBERED, STATES = 400_000, 100_000

_WORD = re.compile(r"\w(?:[\w@$!*]*\w)?")
_OPENING, _CLOSING = tuple("\"“„«‹‘"), re.compile("[\"”“»›’][.,;:!?]*$")
Hit = tuple[int, int]  # term, edits


def allowed_edits(length: int, stem: bool) -> int:
    """Whole words: 1 edit from 5 letters on, 2 from 9 on; word beginnings: 1 from 6 on."""
    return int(length >= 6) if stem else int(length >= 5) + int(length >= 9)


class Automaton:
    """Finds the terms within their allowed edits of a word. ``terms``: (letters, whether it is a word beginning)."""

    def __init__(self, terms: list[tuple[str, bool]]):
        self.terms = terms
        self.children: list[dict[str, int]] = [{}]
        self.ends: list[list[int]] = [[]]
        self.most = [0]  # edits that some term below a node allows
        for number, (term, stem) in enumerate(terms):
            node, edits = 0, allowed_edits(len(term), stem)
            self.most[0] = max(self.most[0], edits)
            for c in term:
                if c not in self.children[node]:
                    self.children[node][c] = len(self.children)
                    self.children.append({})
                    self.ends.append([])
                    self.most.append(0)
                node = self.children[node][c]
                self.most[node] = max(self.most[node], edits)
            self.ends[node].append(number)
        self._clear()

    def _clear(self) -> None:
        self.number: dict[frozenset, int] = {}
        self.sets: list[frozenset] = []
        self.steps: list[dict[str, int]] = []
        self.start = self._state(self._closed({(0, 0)}))

    def _closed(self, places: set[tuple[int, int]]) -> frozenset:
        """With the places reached by leaving out letters of a term. Node -1 - t: word beginning t is done."""
        open_places = list(places)
        while open_places:
            node, edits = open_places.pop()
            if node < 0:
                continue
            for number in self.ends[node]:
                if self.terms[number][1] and edits <= allowed_edits(len(self.terms[number][0]), True):
                    places.add((-1 - number, edits))
            for child in self.children[node].values():
                if edits < self.most[child] and (child, edits + 1) not in places:
                    places.add((child, edits + 1))
                    open_places.append((child, edits + 1))
        return frozenset(places)

    def _state(self, places: frozenset) -> int:
        if places not in self.number:
            self.number[places] = len(self.sets)
            self.sets.append(places)
            self.steps.append({})
        return self.number[places]

    def _step(self, state: int, c: str) -> int:
        places = set()
        for node, edits in self.sets[state]:
            if node < 0:
                places.add((node, edits))
                continue
            if edits < self.most[node]:
                places.add((node, edits + 1))
            for letter, child in self.children[node].items():
                cost = edits + (letter != c)
                if cost <= self.most[child]:
                    places.add((child, cost))
        target = self._state(self._closed(places))
        self.steps[state][c] = target
        return target

    def match(self, word: str) -> Hit | None:
        """The term with the fewest edits, then the longest, then the first."""
        if len(self.sets) > STATES:
            self._clear()
        state = self.start
        for c in word:
            known = self.steps[state].get(c)
            state = self._step(state, c) if known is None else known
            if not self.sets[state]:
                return None
        best = None
        for node, edits in self.sets[state]:
            numbers = [-1 - node] if node < 0 else [n for n in self.ends[node] if not self.terms[n][1]]
            for number in numbers:
                term, stem = self.terms[number]
                if edits <= allowed_edits(len(term), stem):
                    best = min(best or (9, 0, 0), (edits, -len(term), number))
        return (best[2], best[0]) if best else None


class _Verdicts(dict):
    """Piece of text without white space -> its hits, found when first asked for."""

    def __init__(self, automaton: Automaton):
        super().__init__()
        self.automaton = automaton

    def __missing__(self, piece: str) -> tuple[Hit, ...]:
        if len(self) > REMEMBERED:
            self.clear()
        hits = tuple(h for w in _WORD.findall(piece) if (h := self.automaton.match(w)))
        self[piece] = hits
        return hits


@dataclass(frozen=True)
class Lexicon:
    """A learned lexicon: terms, the precision of (term, edits), and the score of a text without hits."""

    terms: list[tuple[str, bool]]
    precision: dict[Hit, float]
    floor: float

    def scorer(self) -> Scorer:
        return Scorer(self)


class Scorer:
    def __init__(self, lexicon: Lexicon):
        self.lexicon = lexicon
        self.verdicts = _Verdicts(Automaton(lexicon.terms))

    def hits(self, text: str | None) -> Iterator[tuple[Hit, bool]]:
        """Each hit and whether it is quoted."""
        pieces = (text or "").lower().split()
        verdict = self.verdicts.__getitem__
        if not any(map(verdict, set(pieces))):
            return
        for at, piece in enumerate(pieces):
            for hit in verdict(piece):
                yield hit, _quoted(pieces, at)

    def score(self, text: str | None) -> float:
        missed = 1 - self.lexicon.floor
        for hit, quoted in self.hits(text):
            precision = self.lexicon.precision.get(hit, BELIEF[hit[1]])
            missed *= 1 - precision * (QUOTED if quoted else 1)
        return 1 - missed


def _quoted(pieces: list[str], at: int) -> bool:
    """An opening quotation mark stands before the word in its window, and a closing one at or after it."""
    opened = False
    for piece in pieces[max(0, at - WINDOW) : at]:
        opened = (opened or piece.startswith(_OPENING)) and not _CLOSING.search(piece)
    opened = opened or pieces[at].startswith(_OPENING)
    return opened and any(_CLOSING.search(p) for p in pieces[at : at + WINDOW + 1])


def _keys(text: str) -> set[str]:
    """The words of a text and, marked by a final hyphen, their beginnings."""
    words = {w for w in _WORD.findall(text.lower()) if w.isalpha()}
    return {w for w in words if len(w) >= SHORTEST} | {w[:n] + "-" for w in words for n in STEMS if len(w) >= n}


def _term_counts(sample: DataFrame) -> DataFrame:
    """In how many different toxic and clean texts each word and beginning occurs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: tuple[Counter, Counter] = (Counter(), Counter())
        for batch in batches:
            for text, label in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                counts[label].update(_keys(text))
        keys = list(counts[0].keys() | counts[1].keys())
        for k in range(0, len(keys), 50_000):
            part = keys[k : k + 50_000]
            yield pa.RecordBatch.from_arrays([pa.array(part), pa.array([counts[0][x] for x in part]), pa.array([counts[1][x] for x in part])], names=["key", "clean", "toxic"])

    found = sample.select("text", "label").mapInArrow(run, "key string, clean long, toxic long")
    return found.groupBy("key").agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic"))


def _explaining(sample: DataFrame, candidates: list[str]) -> list[str]:
    """Terms in turn of the toxic texts they explain that no earlier term does; at most ``TERMS``."""
    wanted = set(candidates)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            held = [sorted(_keys(t) & wanted) for t in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(held, pa.list_(pa.string()))], names=["held"])

    rows = sample.where("label = 1").select("text").mapInArrow(run, "held array<string>").toArrow()["held"].to_pylist()
    holders: dict[str, set[int]] = {}
    for number, held in enumerate(rows):
        for key in held:
            holders.setdefault(key, set()).add(number)
    picked: list[str] = []
    while holders and len(picked) < TERMS:
        key = max(holders, key=lambda k: (len(holders[k]), -len(k), k))
        covered = holders.pop(key)
        if len(covered) < FEWEST:
            break
        picked.append(key)
        holders = {k: left for k, own in holders.items() if (left := own - covered)}
    return sorted(picked)


def fit(documents: DataFrame, labels: DataFrame, label: str = "toxic", divisor: int = 3, kept_out: int = 1, per_class: int = PER_CLASS) -> Lexicon:
    """Learn from a bounded sample of labelled rows, none of the held-out fold; without toxic rows the lexicon is empty."""
    training = remainder(F.col("doc_id"), divisor) != kept_out
    sample, counts = labelled_sample(documents, labels, label, training, per_class)
    # Copies count once, so that the words of one copied text don't become terms.
    sample = stage(sample.where("text is not null").groupBy("text").agg(F.max("label").alias("label")), "toxic-sample")
    sizes = {row["label"]: row["count"] for row in sample.groupBy("label").count().collect()}
    total = sum(counts.values())
    if not sizes.get(1):
        return Lexicon([], {}, 0.0)
    clean_weight = max(1.0, counts.get(0, 0) / max(sizes.get(0, 0), 1))
    ranked = _term_counts(sample).where((F.col("toxic") >= FEWEST) & (F.col("toxic") >= PRECISION * (F.col("toxic") + F.col("clean") * clean_weight)))
    # A bounded list: the keys of most toxic texts.
    rows = ranked.orderBy(F.desc("toxic"), "key").limit(200 * TERMS).collect()
    picked = _explaining(sample, [r["key"] for r in rows])
    terms = [(k.removesuffix("-"), k.endswith("-")) for k in picked]
    found = _hit_counts(sample, Lexicon(terms, {}, 0.0)).collect()
    precision, missed = {}, {0: 0.0, 1: 0.0}
    for r in found:
        weighted = r["clean"] * clean_weight
        if r["term"] < 0:
            missed = {0: weighted, 1: r["toxic"] * max(1.0, counts.get(1, 0) / sizes[1])}
            continue
        belief = BELIEF[r["edits"]]
        precision[r["term"], r["edits"]] = (r["toxic"] + BELIEF_TEXTS * belief) / (r["toxic"] + weighted + BELIEF_TEXTS)
    return Lexicon(terms, precision, missed[1] / max(sum(missed.values()), 1.0) if total else 0.0)


def _hit_counts(sample: DataFrame, lexicon: Lexicon) -> DataFrame:
    """Toxic and clean texts in which each (term, edits) is a best hit; term -1: texts without a hit."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer, counts = lexicon.scorer(), (Counter(), Counter())
        for batch in batches:
            for text, label in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                counts[label].update({h for h, _ in scorer.hits(text)} or {(-1, 0)})
        keys = sorted(counts[0].keys() | counts[1].keys())
        columns = [[k[0] for k in keys], [k[1] for k in keys], [counts[0][k] for k in keys], [counts[1][k] for k in keys]]
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=["term", "edits", "clean", "toxic"])

    found = sample.select("text", "label").mapInArrow(run, "term long, edits long, clean long, toxic long")
    return found.groupBy("term", "edits").agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic"))


def with_scores(documents: DataFrame, lexicon: Lexicon) -> DataFrame:
    """``doc_id`` and ``score`` of every row; a null or empty text gets the score of a text without hits."""
    sent = documents.sparkSession.sparkContext.broadcast(lexicon)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = sent.value.scorer()
        for batch in batches:
            scores = list(map(scorer.score, batch.column(1).to_pylist()))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(scores, pa.float64())], names=["doc_id", "score"])

    kind = documents.schema["doc_id"].dataType.simpleString()
    return documents.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, score double")


def classify(documents: DataFrame, labels: DataFrame, threshold: float = 0.7, divisor: int = 3, kept_out: int = 1) -> DataFrame:
    """``doc_id``, ``held_out``, ``score``, ``predicted`` of every document.

    Only ``text`` is an input of a score. Tables may be empty, hold nulls, repeated rows and
    other columns: every row of ``documents`` gives one row, and a null doc_id is not held out.
    """
    scored = with_scores(documents, fit(documents, labels, divisor=divisor, kept_out=kept_out))
    return scored.select(
        "doc_id",
        (remainder(F.col("doc_id"), divisor) == kept_out).alias("held_out"),
        "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"),
    )


def keep_clean(documents: DataFrame, lexicon: Lexicon, threshold: float = 0.7) -> DataFrame:
    """The documents whose score stays below the threshold, all columns as they were."""
    sent = documents.sparkSession.sparkContext.broadcast(lexicon)
    at = documents.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = sent.value.scorer()
        for batch in batches:
            yield batch.filter(pa.array([scorer.score(t) < threshold for t in batch.column(at).to_pylist()], pa.bool_()))

    return documents.mapInArrow(run, documents.schema)


def matched_terms(text: str | None, lexicon: Lexicon) -> Iterable[tuple[str, int, bool]]:
    """(term, edits, quoted) for each hit of one text, for reports."""
    return [(lexicon.terms[term][0], edits, quoted) for (term, edits), quoted in lexicon.scorer().hits(text)]
