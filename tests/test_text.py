"""Text, token and reasoning columns against plain Python."""

import os
import re

from conftest import SMALL, column_values
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from millrace.functions import text as tx, think
from millrace.functions.tokens import PatternTokenizer, RankFileTokenizer, truncate_text, truncated_name

BATCH = settings(max_examples=4, deadline=None, suppress_health_check=list(HealthCheck))
ODD = " \t\n\r\x0b\x0c\x1c\x1f\x85\xa0 　ab<>think/."
TEXTS = st.lists(st.one_of(st.text(alphabet=ODD), st.text(st.characters(codec="utf-8", exclude_characters="\0"))),
                 min_size=120, max_size=120)


@BATCH
@given(TEXTS)
def test_whitespace_equals_python(spark, texts):
    assert column_values(spark, texts, tx.collapse_whitespace) == [re.sub(r"\s+", " ", t).strip() for t in texts]
    assert column_values(spark, texts, tx.strip) == [t.strip() for t in texts]


def test_every_whitespace_character(spark):
    singles = [chr(c) for c in range(1, 0x3100) if not 0xD800 <= c < 0xE000]
    wrapped = [f"a{c}b" for c in singles]
    assert column_values(spark, wrapped, tx.collapse_whitespace) == [re.sub(r"\s+", " ", t).strip() for t in wrapped]
    assert [c for c in singles if c.isspace()] == sorted(tx.WHITESPACE)


@BATCH
@given(TEXTS)
def test_lines_and_extensions_equal_python(spark, texts):
    assert column_values(spark, texts, tx.line_count) == [len(t.split("\n")) for t in texts]
    one_line = [t.replace("\n", "").replace("\r", "").replace("\x85", "") for t in texts]
    expected = [os.path.splitext(t)[1] for t in one_line]
    got = column_values(spark, one_line, tx.path_extension)
    assert [g for g, e in zip(got, expected) if e.isascii()] == [e.lower() for e in expected if e.isascii()]


def test_extension_edges(spark):
    paths = [".gitignore", "x.tar.GZ", "a.", "dir/.env", "a.b/c", "README", "..a.b", "a/b/c.PY"]
    assert column_values(spark, paths, tx.path_extension) == [os.path.splitext(p)[1].lower() for p in paths]


def test_length_score_edges(spark):
    texts = [None, "", "x" * 50, "x" * 500, "x" * 900, "😀" * 100]
    assert column_values(spark, texts, tx.length_score) == [0.0, 0.0, 0.5, 5.0, 5.0, 1.0]


def test_literals_are_no_patterns(spark):
    out = column_values(spark, ["a.b.c", "abab", "aabb"], lambda v: tx.remove_literals(v, [".", "ab"]))
    assert out == ["abc".replace("ab", ""), "", "ab"]


def test_words_ignore_case(spark):
    out = column_values(spark, ["The LICENSE", "none", None, "a.c"], lambda v: tx.contains_any(v, ["license", "a.c"]))
    assert out == [True, False, False, True]


def test_truthy_and_render(spark):
    frame = spark.sql(
        "SELECT * FROM VALUES (1, 'x', true, array(1), 2.5D, map('a', 1)), (0, '', false, array(), 0.0D, map()), "
        "(null, null, null, null, null, null) AS t(i, s, b, a, d, m)"
    )
    checks = [tx.truthy(f.name, f.dataType).alias(f.name) for f in frame.schema]
    assert [tuple(r) for r in frame.select(*checks).collect()] == [(True,) * 6, (False,) * 6, (False,) * 6]
    shown = [tx.render(f.name, f.dataType).alias(f.name) for f in frame.schema]
    rows = [tuple(r) for r in frame.select(*shown).collect()]
    assert rows[0] == ("1", "x", "True", "[1]", "2.5", '{"a":1}')
    assert rows[2] == ("None",) * 6


def test_tokens_are_a_partition_of_the_text(spark):
    tokenizer, texts = PatternTokenizer(), ["a b", "naïve, no?", "", "  x\n\ny_1!!", "日本 語"]
    pattern = re.compile(tokenizer.pattern)
    assert column_values(spark, texts, tokenizer.count) == [len(pattern.findall(t)) for t in texts]
    for n in (1, 3, 100):
        expected = ["".join(pattern.findall(t)[:n]) for t in texts]
        assert column_values(spark, texts, lambda v: tokenizer.truncate(v, n)) == expected


def test_truncation_gate_counts_characters(spark):
    tokenizer = PatternTokenizer()
    texts = ["x y " * 5000, "x y " * 5000 + "z", None, "日" * 19_999]
    out = column_values(spark, texts, lambda v: truncate_text(v, tokenizer, 10))
    assert out == [texts[0], "x y x y x ", None, texts[3]]
    strict = column_values(spark, texts, lambda v: truncate_text(v, tokenizer, 10, strict=True))
    assert strict[0] == "x y x y x " and strict[3] == "日" * 10
    assert truncated_name(32768) == "content_truncate_32k"


def test_rank_file_tokenizer(spark, tmp_path):
    import base64

    merges = [bytes([b]) for b in range(256)] + [b"ab", b"abab"]
    path = tmp_path / "ranks"
    path.write_bytes(b"\n".join(base64.b64encode(m) + b" %d" % i for i, m in enumerate(merges)))
    tokenizer = RankFileTokenizer(str(path), r"\S+|\s+")
    texts = ["ababab c", None, "", "abx"]
    assert column_values(spark, texts, tokenizer.count) == [4, None, 0, 2]
    assert column_values(spark, texts, lambda v: tokenizer.truncate(v, 2)) == ["ababab", None, "", "abx"]
    cut = column_values(spark, ["ab" * 10_001, "ab"], lambda v: truncate_text(v, tokenizer, 3))
    assert cut == ["ab" * 6, "ab"]


@BATCH
@given(st.lists(st.lists(st.sampled_from(["<think>", "</think>", "\n", "a", " b"]), max_size=9).map("".join),
                min_size=150, max_size=150))
def test_think_equals_python(spark, texts):
    blocks = re.compile(r"<think>\n?(.*?)\n?</think>", re.DOTALL)
    assert column_values(spark, texts, think.think_blocks) == [blocks.findall(t) for t in texts]
    visible = [re.sub(r"<think>[\s\S]*?</think>\n*", "", t, count=1) for t in texts]
    assert column_values(spark, texts, think.visible_text) == visible


def test_reasoning_edges(spark):
    pairs = [("r", "c"), ("r", None), (None, "c"), (" \n", "c"), (" \n", ""), (None, None), ("", "")]
    frame = spark.createDataFrame([(i, *p) for i, p in enumerate(pairs)], "i int, r string, c string")
    out = [r.out for r in frame.select("i", think.join_reasoning("r", "c").alias("out")).orderBy("i").collect()]
    assert out == ["<think>\nr\n</think>\n\nc", "<think>\nr\n</think>\n\n", "c", "c", " \n", "", ""]


def test_newlines(spark):
    assert column_values(spark, ["a\r\nb\rc\n"], tx.unix_newlines) == ["a\nb\nc\n"]
    assert column_values(spark, ["", "\n", "a\nb"], lambda v: tx.average_line_length(F.col(v))) == [0.0, 0.5, 1.5]


def test_rank_tokens_equal_the_library(spark):
    """Counts and cuts of whole texts, of odd ones and of very long pieces."""
    import public_tokenizers
    import tiktoken

    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    tokenizer = RankFileTokenizer(path, public_tokenizers.PATTERN)
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=tokenizer.ranks, special_tokens={})
    texts = [r.text for r in spark.read.parquet(f"{SMALL}/documents.parquet").select("text").collect()]
    texts += [None, "", " ", "a" * 3000, "ab" * 2000 + "é" * 500, "日本語 Zażółć\n\n\t x'll 12345 <|endoftext|>", "\x00\xa0　‍👩‍👩‍👧"]
    frame = spark.createDataFrame(list(enumerate(texts)), "i int, text string").repartition(3)
    columns = [tokenizer.count("text").alias("n"), *(tokenizer.truncate("text", n).alias(f"t{n}") for n in (0, 1, 7, 500))]
    for r in frame.select("i", *columns).collect():
        ids = None if texts[r.i] is None else library.encode_ordinary(texts[r.i])
        assert r.n == (None if ids is None else len(ids))
        for n in (0, 1, 7, 500):
            assert r[f"t{n}"] == (None if ids is None else library.decode(ids[:n])), (r.i, n)
