"""Token counts and token truncation behind one small interface.

A tokenizer is any object with ``count(column)`` and ``truncate(column, n)``
that return columns.
"""

from __future__ import annotations

import base64
import heapq
from collections.abc import Iterator
from dataclasses import dataclass, field

import pandas as pd
import regex
from pyspark.sql import Column, SparkSession, functions as F, types as T

from millrace.functions.text import as_column

#: Texts up to this many characters are never cut.
GATE_CHARS = 20_000

#: Runs of word characters, runs of white space, and any other single
#: character. Every character belongs to one token, so the first n tokens
#: joined are a prefix of the text.
WORD_PATTERN = r"[A-Za-z0-9_]+|[ \t\r\n]+|[^A-Za-z0-9_ \t\r\n]"

#: The same tokens, as far as they have more than one character.
LONG_WORD_PATTERN = r"[A-Za-z0-9_]{2,}|[ \t\r\n]{2,}"


@dataclass(frozen=True)
class PatternTokenizer:
    """Tokens are the matches of a pattern that covers the text; runs inside the JVM.

    ``long_pattern`` matches the tokens of more than one character. With these
    cut to one character each, the text's length is the number of its tokens.
    """

    pattern: str = WORD_PATTERN
    long_pattern: str = LONG_WORD_PATTERN

    def count(self, text: Column | str) -> Column:
        return F.length(F.regexp_replace(as_column(text), self.long_pattern, "x"))

    def truncate(self, text: Column | str, n: int) -> Column:
        tokens = F.regexp_extract_all(as_column(text), F.lit(self.pattern), F.lit(0))
        return F.array_join(F.slice(tokens, 1, n), "")


#: Pieces whose tokens a task remembers.
_REMEMBERED = 200_000


def token_ends(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Where the tokens of a piece end.

    Neighbouring parts merge while their union is a token, that of the smallest rank first,
    leftmost among equals. A heap holds the candidates, so a long piece costs n log n.
    """
    if piece in ranks:
        return [len(piece)]
    n = len(piece)
    after, before = list(range(1, n + 2)), list(range(-1, n))  # parts by their first byte; n is the end
    heap = [(rank, i, i + 2) for i in range(n - 1) if (rank := ranks.get(piece[i : i + 2])) is not None]
    heapq.heapify(heap)
    gone = bytearray(n + 1)
    while heap:
        _, at, end = heapq.heappop(heap)
        middle = after[at]
        if gone[at] or middle >= n or after[middle] != end:
            continue  # one of the two has merged with another part meanwhile
        gone[middle], after[at] = 1, end
        if end <= n:
            before[end] = at
        if end < n and (rank := ranks.get(piece[at : after[end]])) is not None:
            heapq.heappush(heap, (rank, at, after[end]))
        if (left := before[at]) >= 0 and (rank := ranks.get(piece[left:end])) is not None:
            heapq.heappush(heap, (rank, left, end))
    ends, at = [], 0
    while at < n:
        at = after[at]
        ends.append(at)
    return ends


class RankEncoder:
    """Cuts texts into tokens: pieces by a pattern, tokens of each piece by the ranks of its merges."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.ranks, self.pieces, self.known = ranks, regex.compile(pattern), {}

    def _ends(self, piece: str) -> list[int]:
        ends = self.known.get(piece)
        if ends is None:
            ends = token_ends(piece.encode("utf-8", "surrogatepass"), self.ranks)
            if len(self.known) < _REMEMBERED:
                self.known[piece] = ends
        return ends

    def count(self, text: str) -> int:
        return sum(len(self._ends(p[0])) for p in self.pieces.finditer(text))

    def first(self, text: str, n: int) -> str:
        """The text of the first ``n`` tokens; a character cut in two becomes a replacement character."""
        for match in self.pieces.finditer(text):
            ends = self._ends(match[0])
            if len(ends) > n:
                cut = ends[n - 1] if n else 0
                return text[: match.start()] + match[0].encode("utf-8", "surrogatepass")[:cut].decode("utf-8", "replace")
            n -= len(ends)
        return text


@dataclass(frozen=True)
class RankTokenizer:
    """Byte-pair encoding by merge ranks (token bytes to rank), in Arrow batches.

    ``pattern`` cuts a text into the pieces that are encoded apart; it must cover the text.
    The ranks are broadcast: a vocabulary's size is fixed.
    """

    ranks: dict[bytes, int] = field(repr=False)
    pattern: str

    def count(self, text: Column | str) -> Column:
        shared, pattern = _broadcast(self.ranks), self.pattern

        def count_tokens(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
            encoder = RankEncoder(shared.value, pattern)
            for texts in batches:
                yield texts.map(encoder.count, na_action="ignore").astype("Int32")

        return F.pandas_udf(count_tokens, T.IntegerType())(as_column(text))

    def truncate(self, text: Column | str, n: int) -> Column:
        shared, pattern = _broadcast(self.ranks), self.pattern

        def first_tokens(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
            encoder = RankEncoder(shared.value, pattern)
            for texts in batches:
                yield texts.map(lambda t: encoder.first(t, n), na_action="ignore")

        return F.pandas_udf(first_tokens, T.StringType())(as_column(text))


def _broadcast(value):
    return SparkSession.active().sparkContext.broadcast(value)


class RankFileTokenizer(RankTokenizer):
    """A ``RankTokenizer`` whose ranks stand in a file: a token in base64 and its rank on each line.

    The driver reads the file, with Spark if its path has a scheme; executors need no copy.
    """

    def __init__(self, path: str, pattern: str):
        if "://" in path:
            lines = [r.value for r in SparkSession.active().read.text(path).collect()]  # a vocabulary
        else:
            with open(path, encoding="ascii") as file:
                lines = file.read().splitlines()
        pairs = (line.split() for line in lines if line.strip())
        super().__init__({base64.b64decode(token): int(rank) for token, rank in pairs}, pattern)


def truncate_text(text: Column | str, tokenizer, max_tokens: int, strict: bool = False) -> Column:
    """Cut texts of more than ``GATE_CHARS`` characters to ``max_tokens`` tokens.

    The gate sits on the tokenizer's input: a Python tokenizer then sees nulls
    for short texts instead of tokenizing them for nothing. ``strict`` drops the
    gate.
    """
    text = as_column(text)
    if strict:
        return tokenizer.truncate(text, max_tokens)
    long_text = F.when(F.length(text) > GATE_CHARS, text)
    return F.coalesce(tokenizer.truncate(long_text, max_tokens), text)


def truncated_name(max_tokens: int, field: str = "content") -> str:
    """Name of the column that holds the cut text."""
    return f"{field}_truncate_{max_tokens // 1024}k"
