"""Byte-pair encoding and decoding with forced boundaries.

A merge can join two neighbouring bytes only if some vocabulary token holds that
pair of bytes. Every pair that no token holds is therefore a certain cut: the
fragments on its two sides are encoded independently and their ids concatenated.
White space occurs in no token at all, so a text falls apart into short pieces,
and equal pieces and fragments are encoded once per task.

The encoder reads the JSON file of a word-level BPE vocabulary: NFC, white space
folded, lower case, words found by a pattern, bytes as printable characters, and
an end-of-word suffix. Its ids are those of the ``tokenizers`` library for the
same file with ``add_special_tokens=False``.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import re
import unicodedata
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from tokenizers import Tokenizer

#: Pieces that a task remembers; a full memory keeps only those that the texts at hand have met again.
PIECES = 250_000
#: Fragments up to this many bytes are merged in columns, longer ones one by one.
SHORT = 24
#: Characters whose pieces are gathered before the unknown ones are encoded.
GATHER = 2_500_000

# Unicode White_Space; str.split() also splits at U+001C to U+001F.
_SPACES = re.compile("[\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]+")
_SEPARATORS = "\x1c\x1d\x1e\x1f"
# Beyond Latin letters and general punctuation.
_LATER = re.compile("[^\x00-\u024f\u2010-\u2027\u2030-\u205e\u20a0-\u20bf]")
# A stop between a letter or digit and white space or the end.
_STOPS = [(re.compile(rf"\{stop}(?<=[a-z0-9\u00df-\u00f6\u00f8-\u00ff].)(?![^ \n])"), f" {stop}") for stop in ".,"]
_NO_MERGE = np.iinfo(np.int32).max
# Ends a piece among ids: no id has four bytes of 255, nor has a row of them, as ids stay below 2**24.
_END = b"\xff" * 4


def byte_characters() -> list[str]:
    """The printable character that stands for each byte: itself, or the next one from U+0100 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return [chr(b) if b in plain else chr(256 + rest.index(b)) for b in range(256)]


class Encoder:
    """Encodes and decodes texts with the vocabulary in ``spec``, the JSON text of its file.

    Special tokens whose ids are in ``plain`` are ordinary text where a text spells them.
    """

    def __init__(self, spec: str, plain: tuple[int, ...] = ()):
        parts = json.loads(spec)
        model = parts["model"]
        vocab: dict[str, int] = model["vocab"]
        self.suffix: str = model.get("end_of_word_suffix") or ""
        pairs = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        special = {t["content"]: t["id"] for t in parts.get("added_tokens", [])}
        self.token = {i: t.encode() for t, i in {**vocab, **special}.items()}
        self.special = {t: np.array([i], "<u4").tobytes() for t, i in special.items() if i not in plain}
        self.cut_special = re.compile("(" + "|".join(map(re.escape, sorted(self.special, key=len, reverse=True))) + ")") if self.special else None
        splitter = parts["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"]
        self.words_and_ends = regex.compile(f"{splitter}|\n", regex.V0)
        self.library = Tokenizer.from_str(spec)
        chars = byte_characters()
        self.inner = np.array([vocab[c] for c in chars], np.int64)
        self.last = np.array([vocab[c + self.suffix] for c in chars], np.int64)
        self.size = max(self.token) + 1
        keys = np.array([vocab[a] * self.size + vocab[b] for a, b in pairs], np.int64)
        merged = np.array([vocab[a + b] for a, b in pairs], np.int64)
        self.rank = {int(k): r for r, k in reversed(list(enumerate(keys)))}
        self.merged = merged
        order = np.argsort(keys, kind="stable")
        self.keys, self.key_rank = keys[order], order.astype(np.int32)
        self.joined = self._joined_pairs(vocab, chars)
        # Ranks of two bytes inside a word, and of two at its end.
        self.byte_rank, self.end_rank = (self._ranks(self.inner[:, None], right[None]) for right in (self.inner, self.last))
        self.pieces: dict[str, bytes] = {"": b""}
        # A pattern that parts letters and digits from a stop behind them lets texts be cut there.
        self.parts_stops = all(self.words_and_ends.findall(c + stop) == [c, stop] for c in "a0\u00df\u00ff" for stop in ".,")

    def _joined_pairs(self, vocab: Iterable[str], chars: list[str]) -> np.ndarray:
        """joined[a, b]: some vocabulary token holds byte a followed by byte b."""
        byte_of = {c: b for b, c in enumerate(chars)}
        joined = np.zeros((256, 256), bool)
        for token in vocab:
            codes = [byte_of[c] for c in token.removesuffix(self.suffix) if c in byte_of]
            joined[codes[:-1], codes[1:]] = True
        return joined

    def _ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The rank of each pair's merge; pairs that don't merge have the largest number."""
        key = left * self.size + right
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.key_rank[at], _NO_MERGE)

    # Encoding

    def split(self, text: str) -> list[str]:
        """The text's pieces between white space, normalised and without stops at their ends where that is safe: fewer differ then."""
        if self.parts_stops and "<|" not in text and (text.isascii() or not _LATER.search(text)):
            text = self._normalised(text)
            for stop, apart in _STOPS:
                text = stop.sub(apart, text)
        if any(c in text for c in _SEPARATORS):
            return _SPACES.split(text)
        return text.split()

    def _normalised(self, text: str) -> str:
        if not text.isascii():
            # One character at a time: the capital sigma has no final form here.
            text = unicodedata.normalize("NFC", text).replace("\u03a3", "\u03c3")
        return text.lower()

    def _words(self, pieces: list[str]) -> list[str]:
        """The words of all pieces, normalised; a line feed, which no piece holds, follows each piece."""
        return self.words_and_ends.findall(self._normalised("\n".join([*pieces, ""])))

    def _fragments(self, words: list[str]) -> tuple[list[bytes], list[int]]:
        """All independent fragments and where each word's own begin; a last byte 255, which is in no UTF-8 text, ends a word."""
        data = "\n".join([*words, ""]).encode().replace(b"\n", b"\xff")
        codes = np.frombuffer(data, np.uint8)
        ends_word = codes == 255
        ends = ends_word.copy()
        ends[:-1] |= ~(self.joined[codes[:-1], codes[1:]] | ends_word[1:])
        bounds = np.flatnonzero(ends) + 1
        firsts = [0, *(np.flatnonzero(ends_word[bounds - 1]) + 1).tolist()]
        bounds = [0, *bounds.tolist()]
        return [data[x:y] for x, y in zip(bounds, bounds[1:], strict=False)], firsts

    def _merge_columns(self, rows: np.ndarray, rank: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(indexes, ids) of rows of one length as they come to an end; each turn merges one pair in each open row.

        ``rank`` has the ranks of each row's pairs; a merge changes those on its two sides only.
        """
        open_rows = np.arange(len(rows))
        while rows.shape[1] > 1 and len(rows):
            where = rank.argmin(1)
            best = rank[np.arange(len(rows)), where]
            done = best == _NO_MERGE
            if done.any():
                yield open_rows[done], rows[done]
                keep = ~done
                rows, rank, open_rows, where, best = rows[keep], rank[keep], open_rows[keep], where[keep], best[keep]
            if not len(rows):
                return
            rows[np.arange(len(rows)), where] = self.merged[best]
            column = np.arange(rows.shape[1] - 1)
            rows = np.take_along_axis(rows, column + (column > where[:, None]), 1)
            column = column[:-1]
            rank = np.take_along_axis(rank, column + (column >= where[:, None]), 1)
            for at in (where - 1, where):
                inside = np.flatnonzero((at >= 0) & (at < rank.shape[1]))
                first = at[inside]
                rank[inside, first] = self._ranks(rows[inside, first], rows[inside, first + 1])
        if len(rows):
            yield open_rows, rows

    def _merge_long(self, ids: list[int]) -> list[int]:
        """The same merges for one long fragment, with a heap of pairs and a linked list."""
        n = len(ids)
        after, before = [*range(1, n), -1], [-1, *range(n - 1)]
        heap: list[tuple[int, int, int, int]] = []

        def offer(i: int) -> None:
            j = after[i]
            if j >= 0 and (r := self.rank.get(ids[i] * self.size + ids[j])) is not None:
                heapq.heappush(heap, (r, i, ids[i], ids[j]))

        for i in range(n):
            offer(i)
        while heap:
            r, i, a, b = heapq.heappop(heap)
            j = after[i]
            if ids[i] != a or j < 0 or ids[j] != b:
                continue
            ids[i], ids[j] = int(self.merged[r]), -1
            after[i] = after[j]
            if after[j] >= 0:
                before[after[j]] = i
            offer(i)
            if before[i] >= 0:
                offer(before[i])
        return [i for i in ids if i >= 0]

    def _encode_fragments(self, fragments: Iterable[bytes]) -> dict[bytes, bytes]:
        fragments = list(fragments)
        if not fragments:
            return {}
        codes = np.frombuffer(b"".join(fragments), np.uint8)
        lengths = np.fromiter(map(len, fragments), np.int64, len(fragments))
        starts = np.cumsum(lengths) - lengths
        ends_word = codes[starts + lengths - 1] == 255
        # A fragment has at most as many ids as bytes: they are put where its bytes begin.
        ids, filled = np.zeros(len(codes), "<u4"), np.zeros(len(codes), bool)
        kind = 2 * lengths + ends_word
        order = np.argsort(kind, kind="stable")
        for group in np.split(order, np.flatnonzero(np.diff(kind[order])) + 1):
            first, length, ends = starts[group], int(lengths[group[0]]), bool(ends_word[group[0]])
            own = codes[first[:, None] + np.arange(length - ends)]
            rows = self.inner[own]
            if ends:
                rows[:, -1] = self.last[own[:, -1]]
            if length > SHORT:
                for at, row in zip(first.tolist(), rows.tolist(), strict=True):
                    merged = self._merge_long(row)
                    ids[at : at + len(merged)] = merged
                    filled[at : at + len(merged)] = True
                continue
            rank = self.byte_rank[own[:, :-1], own[:, 1:]]
            if ends and rank.shape[1]:
                rank[:, -1] = self.end_rank[own[:, -2], own[:, -1]]
            for index, merged in self._merge_columns(rows, rank):
                places = first[index][:, None] + np.arange(merged.shape[1])
                ids[places] = merged
                filled[places] = True
        flat = ids[filled].tobytes()
        bounds = [0, *(4 * np.cumsum(np.add.reduceat(filled, starts, dtype=np.int64))).tolist()]
        return {f: flat[x:y] for f, x, y in zip(fragments, bounds, bounds[1:], strict=False)}

    def _encode_words(self, words: Iterable[str]) -> dict[str, bytes]:
        words = list(words)
        fragments, firsts = self._fragments(words)
        ids = self._encode_fragments(set(fragments))
        own = list(map(ids.__getitem__, fragments))
        return {w: own[x] if y == x + 1 else b"".join(own[x:y]) for w, x, y in zip(words, firsts, firsts[1:], strict=False)}

    def learn(self, pieces: Iterable[str]) -> None:
        """Encode pieces without white space that are not known yet."""
        plain, mixed, other = list(pieces), {}, []
        joined = "\n".join(plain)
        if "<|" in joined or not joined.isascii() and _LATER.search(joined):
            pieces, plain = plain, []
            for piece in pieces:
                if piece.isascii() or not _LATER.search(piece):
                    if self.cut_special and "<|" in piece:
                        mixed[piece] = self.cut_special.split(piece)
                    else:
                        plain.append(piece)
                else:
                    other.append(piece)
            plain += {s for parts in mixed.values() for s in parts[::2]} - set(plain)
        if plain:
            words = self._words(plain)
            ids = self._encode_words({*words} - {"\n"})
            ids["\n"] = _END
            found = b"".join(map(ids.__getitem__, words)).split(_END)
            self.pieces.update(zip(plain, found[:-1], strict=True))
        for piece, parts in mixed.items():
            self.pieces[piece] = b"".join([self.special[s] if k % 2 else self.pieces[s] for k, s in enumerate(parts)])
        for piece in other:
            self._learn_other(piece)

    def _learn_other(self, piece: str) -> None:
        """A piece whose characters Unicode versions may class in different ways: normalised and cut by the vocabulary's own library."""
        byte_of = {c: b for b, c in enumerate(byte_characters())}
        parts = self.cut_special.split(piece) if self.cut_special else [piece]
        found = []
        for k, part in enumerate(parts):
            if k % 2:
                found.append(self.special[part])
                continue
            words = self.library.pre_tokenizer.pre_tokenize_str(self.library.normalizer.normalize_str(part))
            for word, _ in words:
                data = bytes([byte_of[c] for c in word]) + b"\xff"
                codes = np.frombuffer(data, np.uint8)
                cuts = np.flatnonzero(~self.joined[codes[:-2], codes[1:-1]]) + 1
                own = [data[x:y] for x, y in zip([0, *cuts.tolist()], [*cuts.tolist(), len(data)], strict=True)]
                ids = self._encode_fragments(set(own))
                found += [ids[f] for f in own]
        self.pieces[piece] = b"".join(found)

    def encode(self, texts: Iterable[str | None]) -> Iterator[bytes]:
        """The ids of each text as little-endian unsigned 32-bit integers; a null text is empty."""
        gathered: list[list[str]] = []
        size = 0

        def flush() -> list[bytes]:
            here = set().union(*gathered)
            new = here - self.pieces.keys()
            if len(self.pieces) + len(new) > PIECES:
                self.pieces = {p: self.pieces[p] for p in here - new}
            self.learn(new)
            known = self.pieces.__getitem__
            return [b"".join(map(known, words)) for words in gathered]

        for text in texts:
            text = text or ""
            gathered.append(self.split(text))
            size += len(text)
            if size >= GATHER:
                yield from flush()
                gathered, size = [], 0
        yield from flush()

    def decode(self, ids: Iterable[int]) -> bytes:
        """The tokens of ``ids`` in UTF-8, joined by spaces, special ones included."""
        return b" ".join(map(self.token.__getitem__, ids))


def read_spec(path: str) -> str:
    """The vocabulary file's text. It is read on the driver: executors need no copy of the file."""
    with open(path, encoding="utf-8") as file:
        return file.read()


def with_encoder(df: DataFrame, path: str, work: Callable[[Encoder, Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: str, plain: tuple[int, ...] = (), first: Callable[[], None] | None = None) -> DataFrame:
    """``work(encoder, batches)`` in each task, after ``first``. The broadcast is the vocabulary, whose size is fixed; ``plain`` is the encoder's."""
    spec = df.sparkSession.sparkContext.broadcast(read_spec(path))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if first:
            first()
        yield from work(Encoder(spec.value, plain), batches)

    return df.mapInArrow(run, schema)


def encode_and_decode(documents: DataFrame, path: str, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Digests of each text's ids and of their decoding.

    One row per input row, repeated rows included: the id column, ``n_tokens``,
    ``ids_sha256`` (ids as little-endian unsigned 32-bit integers) and
    ``decoded_sha256`` (UTF-8). A null text counts as empty and has no ids; an
    empty table gives no rows; other columns are not read, whatever their names.
    """

    def work(encoder: Encoder, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for ids in encoder.encode(batch.column(1).to_pylist()):
                decoded = encoder.decode(np.frombuffer(ids, "<u4").tolist())
                rows.append((len(ids) // 4, hashlib.sha256(ids).hexdigest(), hashlib.sha256(decoded).hexdigest()))
            counts, encoded, decoded = zip(*rows, strict=True) if rows else ((), (), ())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(counts, pa.int64()), pa.array(encoded, pa.string()), pa.array(decoded, pa.string())],
                names=["id", "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    kind = documents.schema[id_column].dataType.simpleString()
    texts = documents.select(documents[id_column].alias("id"), documents[text_column].alias("text"))
    found = with_encoder(texts, path, work, f"id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string")
    return found.withColumnRenamed("id", id_column)
