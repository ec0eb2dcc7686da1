"""Encoding, packing and token counts against the tokenizers library."""

import hashlib
import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from conftest import SMALL
from odd_rows import empty, odd  # noqa: F401
from tokenizers import Tokenizer

from millrace.llm import bpe, packing, token_counts

PATH = public_tokenizers.path("word_bpe_49k.json")
END = 49407


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def ids_of(library, text):
    return library.encode(text or "", add_special_tokens=False).ids


def test_encoder_equals_library(library):
    draw = random.Random(1)
    texts = ["", " ", "don't WON'T'S 'LL", "İ ΣΑΣ", "é ́x", "A\x1cB", "x" * 3000, "ab" * 500 + "!" * 60, "<|endoftext|>a<|startoftext|><|end", "12 ٣٤"]
    texts += ["".join(draw.choice("abcthe THE'sS.,!12 \n\t\x1c" "ćéßΣİ<|>  日本ñ\U0001f600") for _ in range(draw.randint(0, 40))) for _ in range(500)]
    texts += ["".join(chr(draw.choice([draw.randint(0, 0x2FF), draw.randint(0x300, 0xD7FF), draw.randint(0xE000, 0x1FFFF)])) for _ in range(20)) for _ in range(300)]
    encoder = bpe.Encoder(bpe.read_spec(PATH))
    for text, data in zip(texts, encoder.encode(texts), strict=True):
        ids = np.frombuffer(data, "<u4").tolist()
        assert ids == ids_of(library, text), text
        assert encoder.decode(ids).decode() == library.decode(ids, skip_special_tokens=False)


def test_forced_cuts_are_pairs_of_no_token():
    encoder = bpe.Encoder(bpe.read_spec(PATH))
    assert encoder.joined[ord("t"), ord("h")] and not encoder.joined[ord("a"), ord(" ")] and not encoder.joined[255].any()
    assert encoder._fragments(["th7"])[0] in ([b"th7\xff"], [b"th", b"7\xff"])


def test_full_memory_of_pieces(monkeypatch, library):
    monkeypatch.setattr(bpe, "PIECES", 3)
    monkeypatch.setattr(bpe, "GATHER", 10)
    texts = ["one two three", "two four five six", "one seven"]
    assert [np.frombuffer(x, "<u4").tolist() for x in bpe.Encoder(bpe.read_spec(PATH)).encode(texts)] == [ids_of(library, t) for t in texts]


def test_stops_and_cases_share_pieces(library):
    draw = random.Random(3)
    texts = ["Stone. stone, STONE stone.\nStone,", "x!. y.. 3.5. ß. é, Ñ.\n'S. don't, ...", ". , .a ,b", "<|endoftext|>. A. <|"]
    texts += ["".join(draw.choice("aEß9ñÑ.,!' \n\t\x1c日İ") for _ in range(30)) for _ in range(500)]
    encoder = bpe.Encoder(bpe.read_spec(PATH))
    next(encoder.encode(texts[:1]))
    assert set(encoder.pieces) == {"", "stone", ".", ","}
    for text, data in zip(texts, encoder.encode(texts), strict=True):
        assert np.frombuffer(data, "<u4").tolist() == ids_of(library, text), text


def test_full_memory_keeps_pieces_met_again(monkeypatch, library):
    monkeypatch.setattr(bpe, "PIECES", 4)
    monkeypatch.setattr(bpe, "GATHER", 10)
    texts = ["one two three", "four one five", "one six"]
    encoder = bpe.Encoder(bpe.read_spec(PATH))
    learned = []
    learn = encoder.learn
    monkeypatch.setattr(encoder, "learn", lambda pieces: (learned.extend(pieces), learn(pieces)))
    assert [np.frombuffer(x, "<u4").tolist() for x in encoder.encode(texts)] == [ids_of(library, t) for t in texts]
    assert sorted(learned) == ["five", "four", "one", "six", "three", "two"]


def test_digests(odd, empty, library):
    rows = bpe.encode_and_decode(odd, PATH).collect()
    assert len(rows) == odd.count() and bpe.encode_and_decode(empty, PATH).count() == 0
    texts = {r.doc_id: r.text for r in odd.collect()}
    for r in rows:
        ids = ids_of(library, texts[r.doc_id])
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(library.decode(ids, skip_special_tokens=False).encode()).hexdigest()


def check_packing(rows, texts, library, end):
    pieces, sequences = defaultdict(list), defaultdict(list)
    for r in rows:
        pieces[r.doc_id].append(r)
        sequences[r.sequence_id].append(r)
    for doc_id, own in pieces.items():
        data = np.array([*ids_of(library, texts[doc_id]), end], "<u4").tobytes()
        copies = defaultdict(int)
        for r in own:
            assert r.doc_tokens == len(data) // 4
            assert r.ids_crc32 == zlib.crc32(data[4 * r.start : 4 * (r.start + r.length)])
            for i in range(r.start, r.start + r.length):
                copies[i] += 1
        assert len(copies) == len(data) // 4 and len(set(copies.values())) == 1
    for own in sequences.values():
        own.sort(key=lambda r: r.offset)
        assert [r.offset for r in own] == np.cumsum([0, *(r.length for r in own)])[:-1].tolist()
        size = sum(r.length for r in own)
        assert size == own[0].tier <= 4096 and size & (size - 1) == 0, "full windows need no padding"


def test_packing_of_odd_rows(odd, empty, library):
    rows = packing.pack(odd, PATH, 2).collect()
    check_packing(rows, {r.doc_id: r.text for r in odd.collect()}, library, 2)
    assert sum(r.length for r in rows) == sum(len(ids_of(library, r.text)) + 1 for r in odd.collect())
    assert packing.pack(empty, PATH, 2).count() == 0


def test_packing_in_small_batches(spark, library):
    documents = spark.read.parquet(f"{SMALL}/documents.parquet")
    rows = packing.pack(documents, PATH, 2, step_tokens=8192, batch_tokens=20_000).collect()
    check_packing(rows, {r.doc_id: r.text for r in documents.collect()}, library, 2)
    steps = defaultdict(set)
    for r in rows:
        steps[r.step_id].add((r.sequence_id, r.tier))
    assert all(len({t for _, t in own}) == 1 and sum(t for _, t in own) <= 8192 for own in steps.values())


@pytest.mark.parametrize("block_ids", [3, 1 << 20])
def test_token_counts(odd, empty, library, tmp_path, block_ids):
    spark = odd.sparkSession
    plain = odd.where("doc_id is null or doc_id <> 9")  # that text spells the end id
    token_counts.write_token_files(plain.where("doc_id is null or doc_id <> 8"), PATH, END, str(tmp_path / "f"))
    rows = token_counts.count_tokens(spark, str(tmp_path / "f"), END, block_ids).orderBy("ordinal").collect()
    expected = sorted(len(ids_of(library, r.text)) for r in plain.collect() if r.doc_id != 8)
    assert sorted(r.n_tokens for r in rows) == expected and [r.ordinal for r in rows] == list(range(len(rows)))
    assert [r.first_id for r in rows] == np.cumsum([0, *(r.n_tokens + 1 for r in rows)])[:-1].tolist()
    token_counts.write_token_files(empty, PATH, END, str(tmp_path / "e"))
    assert token_counts.count_tokens(spark, str(tmp_path / "e"), END).count() == 0


def test_texts_that_spell_the_end_id(odd, library, tmp_path):
    spark = odd.sparkSession
    few = odd.where("doc_id is null or doc_id <> 8")
    more = [(20, "a<|endoftext|><|endoftext|>b"), (21, "<|endoftext|>"), (22, "日本<|endoftext|>é <|ENDOFTEXT|>")]
    texts = few.select("doc_id", "text").unionByName(spark.createDataFrame(more, "doc_id long, text string"))
    token_counts.write_token_files(texts, PATH, END, str(tmp_path / "f"))
    rows = token_counts.count_tokens(spark, str(tmp_path / "f"), END, 3).collect()
    plain = Tokenizer.from_file(PATH)
    plain.encode_special_tokens = True
    assert sorted(r.n_tokens for r in rows) == sorted(len(ids_of(plain, r.text)) for r in texts.collect())
    # Without the literal nothing changes, and other operators still read it as a special token.
    assert END in ids_of(library, more[1][1]) and END in np.frombuffer(next(bpe.Encoder(bpe.read_spec(PATH)).encode([more[1][1]])), "<u4")


@pytest.mark.parametrize("block_ids", [1, 2, 5, 100])
def test_documents_across_blocks_and_files(spark, tmp_path, block_ids):
    stream = [7, 8, END, END, 9, 10, 11, 12, 13, END, 14, 15]
    for k, part in enumerate((stream[:2], [], stream[2:7], stream[7:8], stream[8:])):
        (tmp_path / f"part-{k}").write_bytes(np.array(part, "<u2").tobytes())
    rows = token_counts.count_tokens(spark, str(tmp_path), END, block_ids).orderBy("ordinal").collect()
    assert [tuple(r) for r in rows] == [(0, 2, 0, True), (1, 0, 3, True), (2, 5, 4, True), (3, 2, 10, False)]
