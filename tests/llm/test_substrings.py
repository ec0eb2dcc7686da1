"""Removal of repeated passages against SQL and brute force."""

import random
import re

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from conftest import SMALL, executed_plan
from odd_rows import DOCUMENTS, empty, odd  # noqa: F401

from millrace.llm import substrings
from millrace.llm.catalog import ENTRIES
from millrace.session import stage as write


def brute(rows, size):
    """Sorted (doc_id, kept text, words, words removed, spans) of (doc_id, text) rows by plain dictionaries."""
    split = [(i, re.findall(r"[^\x20\x09-\x0D]+", text or "")) for i, text in rows]
    first = {}
    for i, words in split:
        for p in range(len(words) - size + 1):
            window = tuple(words[p : p + size])
            if i is not None:
                first[window] = min(first.get(window, i), i)
    found = []
    for i, words in split:
        gone = set()
        for p in range(len(words) - size + 1):
            if i is not None and first[tuple(words[p : p + size])] < i:
                gone.update(range(p, p + size))
        spans = []
        for p in sorted(gone):
            if spans and spans[-1][0] + spans[-1][1] == p:
                spans[-1] = (spans[-1][0], spans[-1][1] + 1)
            else:
                spans.append((p, 1))
        found.append((i, " ".join(w for p, w in enumerate(words) if p not in gone), len(words), len(gone), spans))
    return sorted(found, key=str)


def rows_of(frame):
    return sorted([(r.doc_id, r.text, r.n_words, r.n_removed, [tuple(s) for s in r.removed]) for r in frame.collect()], key=str)


def test_equals_sql(spark):
    entry = ENTRIES["op11_substring_dedup"]
    connection = duckdb.connect()
    connection.execute(f"CREATE VIEW documents AS SELECT * FROM '{SMALL}/documents.parquet'")
    found, wanted = entry.run(spark, SMALL), connection.execute(entry.sql)
    assert [c[0] for c in wanted.description] == found.columns
    rows = sorted(map(tuple, found.collect()))
    assert rows == sorted(wanted.fetchall()) and any(r[2] for r in rows)


@pytest.mark.parametrize("block_bytes, bin_suffixes", [(1, 50), (2000, 300), (1 << 20, 10_000)])
def test_equals_brute_force(spark, block_bytes, bin_suffixes):
    """Passages of few words shared in all ways, in blocks of one document up to all in one."""
    draw = random.Random(5)
    passages = [[draw.choice("abcde") * draw.randint(1, 2) for _ in range(draw.randint(3, 40))] for _ in range(12)]
    rows = []
    for n in range(150):
        words = []
        for _ in range(draw.randint(0, 4)):
            words += draw.choice(passages)[draw.randint(0, 6) :]
            words += [f"own{draw.randint(0, 3000)}" for _ in range(draw.randint(0, 5))]
        rows.append((draw.choice([n, n, n, n // 2, None]), " \n"[n % 2].join(words)))
    frame = spark.createDataFrame([(i, t, 1, 2) for i, t in rows], "doc_id long, text string, part int, removed int").repartition(5)
    for size in (1, 2, 7, 13):
        found = substrings.remove_repeats(frame, size, block_bytes, 2 * bin_suffixes, bin_suffixes)
        assert rows_of(found) == brute(rows, size)


def test_odd_rows(spark, odd):  # noqa: F811
    rows = [(r.doc_id, r.text) for r in odd.collect()]
    assert rows_of(substrings.remove_repeats(odd)) == brute(rows, 13)
    assert rows_of(substrings.remove_repeats(odd, 2, 100, 1000, 100)) == brute(rows, 2)


def test_copies_and_white_space(spark):
    text = "\x0b a\x1cb 　x\x85 y\xa0z\x0c" + " ".join(f"w{i}" for i in range(30)) + "\r\n"
    rows = [(7, text), (7, text), (3, text), (-2, "w3\tw4  " + text), (None, text), (9, " ".join(f"w{i}" for i in range(12)))]
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    assert rows_of(substrings.remove_repeats(frame)) == brute(rows, 13)


def test_empty_table(spark, empty):  # noqa: F811
    assert substrings.remove_repeats(empty).collect() == []


def test_texts_stay_where_they_are(spark):
    """The blocks are joined to their bits without an exchange of their own."""
    documents = spark.read.parquet(f"{SMALL}/documents.parquet")
    blocks = substrings._blocks(documents, 1 << 16, "doc_id", "text")
    seen = spark.createDataFrame([(1, 1, 1, b"")], "part int, seq long, at int, bits binary")
    blocks = substrings._beside(substrings._beside(blocks, "copies", seen, "at"), "seen", seen, "bits")
    plan = executed_plan(blocks.select("texts", "copies", "seen"))
    lines = plan.splitlines()
    scan = next(n for n, x in enumerate(lines) if "Bucketed: true" in x)
    # Branches of the plan are indented further than what they feed; the scan's own branch has no exchange.
    depth, above = len(lines[scan]), []
    for line in reversed(lines[: scan + 1]):
        indent = len(line) - len(line.lstrip(" :+-"))
        if indent < depth:
            depth, above = indent, [*above, line]
    assert any("Join" in x for x in above) and not any("Exchange" in x for x in above)


def test_packing_round_trip():
    draw = np.random.default_rng(2)
    for top in (1, 200, 2**20, 2**63):
        numbers = draw.integers(0, top, 1000, dtype=np.uint64)
        assert (substrings.unpack(substrings.pack(numbers)) == numbers).all()
    assert len(substrings.unpack(substrings.pack(np.empty(0, np.uint64)))) == 0


def test_frequent_prefixes_get_longer():
    """Groups of a frequent first word are told apart by what follows."""
    draw = random.Random(1)
    texts = pa.array([" ".join("the" if i % 2 else draw.choice("bcdefg") for i in range(400))])
    layout = substrings.Layout(5, 30, 1)
    counts = substrings.Windows(texts, layout, []).prefix_counts().reshape(len(layout.lengths), -1)
    starting = {}
    for limit in (60, 1000):
        dealt = substrings.Layout(5, 30, 1, 64, counts <= limit)
        windows = substrings.Windows(texts, dealt, [])
        leaves = substrings.Leaves(windows, np.array([1]), [np.packbits(np.ones(len(windows.short), bool)).tobytes()])
        begin = windows.words.begin
        starting[limit] = {at for at, part in leaves.by_bin() for s in leaves.start[part] if bytes(windows.words.data[begin[s] : begin[s] + 3]) == b"the"}
    assert len(starting[60]) > 3 and len(starting[1000]) == 1


def test_words_are_hashed_alike():
    words = ["a", "ab", "b", "é", "x" * 64, "x" * 65, "x" * 66, "日本", "y" * 300]
    one = substrings.Words(pa.array([" ".join(words), "", "  ", "\n".join(reversed(words))]))
    hashes = one.hashes()
    assert one.counts.tolist() == [len(words), 0, 0, len(words)] and (hashes[: len(words)] == hashes[len(words) :][::-1]).all()
    assert len(set(hashes.tolist())) == len(words)
    sliced = pa.array(["skipped words", "a ab", "ab", "x"]).slice(1, 2)
    assert substrings.Words(sliced).hashes().tolist() == [hashes[0], hashes[1], hashes[1]]


def test_subtrees():
    suffixes = np.array([[1, 2, 3], [1, 2, 3], [1, 2, 4], [0, 9, 9], [1, 2, 3]], np.uint8)
    trees = substrings.Subtrees(suffixes, np.array([7, 7, 7, 7, 8], np.uint64))
    assert trees.order.tolist() == [3, 0, 1, 4, 2] and trees.shared.tolist() == [0, 0, 3, 2, 2]
    assert trees.nodes(3).tolist() == [0, 1, 3, 4] and trees.nodes(2).tolist() == [0, 1]


def test_windows_take_few_bytes():
    """What a worker holds of a block, besides its text: 84 bytes for a window of 13 words."""
    n = 20_000
    windows = substrings.Windows(pa.array([" ".join(f"w{i}" for i in range(n))]), substrings.Layout(13, 42, 4), [])
    held = [x for part in (windows, windows.words) for name, x in vars(part).items() if isinstance(x, np.ndarray) and name != "data"]
    assert sum(x.nbytes for x in [*held, *windows.shorter]) < 90 * n


def test_workers_get_few_blocks_at_once(spark, monkeypatch):
    """Also in sessions that set no limit; the session's own setting is back in the end."""
    name, seen = "spark.sql.execution.arrow.maxBytesPerBatch", []
    monkeypatch.setattr(substrings, "stage", lambda df, label: (seen.append((label, spark.conf.get(name, None))), write(df, label))[1])
    before = spark.conf.get(name, None)
    substrings.remove_repeats(spark.createDataFrame([(1, "a b c d"), (2, "b c d e")], "doc_id long, text string"), 3)
    assert {("substring-seen", str(8 << 20)), ("substring-earlier", str(8 << 20))} <= set(seen) and spark.conf.get(name, None) == before
