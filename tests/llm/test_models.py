"""Classifiers, url verdicts and line dedup."""

import math
import zlib

import pytest
from odd_rows import empty, labelled, labels, odd  # noqa: F401
from pyspark.sql import functions as F

from millrace.llm import lines, quality, toxicity, urls
from millrace.llm.catalog import RULES


@pytest.mark.parametrize(("module", "column", "divisor", "kept_out"), [(quality, "quality", 5, 0), (toxicity, "toxic", 3, 1)])
def test_held_out_accuracy(labelled, labels, module, column, divisor, kept_out):
    rows = module.classify(labelled, labels).collect()
    truth = {r["doc_id"]: r[column] for r in labels.collect()[:400]}
    held = [r for r in rows if r.held_out]
    assert {r.doc_id for r in held} == {i for i in truth if zlib.crc32(str(i).encode()) % divisor == kept_out}
    assert sum(r.predicted == truth[r.doc_id] for r in held) >= 0.97 * len(held)


@pytest.mark.parametrize("module", [quality, toxicity])
def test_classifier_on_odd_rows(odd, empty, labelled, labels, module):
    everything = labelled.unionByName(odd)
    rows = module.classify(everything, labels).collect()
    assert len(rows) == 411 and all(0 <= r.score <= 1 and r.predicted in (0, 1) for r in rows)
    assert module.classify(empty, labels).count() == 0
    unlabelled = module.classify(odd, labels.limit(0)).collect()
    assert len({r.score for r in unlabelled}) == 1
    assert [r.held_out for r in rows if r.doc_id is None] == [False]


def test_held_out_labels_are_not_read(labelled, labels):
    scores = {r.doc_id: r.score for r in toxicity.classify(labelled, labels).collect()}
    held = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1
    turned = labels.withColumn("toxic", F.when(held, 1 - F.col("toxic")).otherwise(F.col("toxic")))
    assert scores == {r.doc_id: r.score for r in toxicity.classify(labelled, turned).collect()}


def edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row = _next(row, x, b, i)
    return row


def _next(row, x, b, i):
    new = [i]
    for j, y in enumerate(b, 1):
        new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
    return new


def test_automaton_equals_edit_distance():
    import random

    draw = random.Random(3)
    terms = [("blockhead", False), ("nitwit", False), ("oaf", False), ("grumbl", True), ("snip", True)]
    automaton = toxicity.Automaton(terms)
    words = ["grumbling", "gruxbling", "snippet", "snxp", "oaf", "oaff"]
    words += ["".join(draw.choice("abcdeghiklnotw") for _ in range(draw.randint(1, 10))) for _ in range(200)]
    for term, _ in terms:
        for _ in range(150):
            word = list(term + draw.choice(["", "", "s", "ing"]))
            for _ in range(draw.randint(0, 3)):
                k = draw.randrange(len(word) + 1)
                kind = draw.randrange(3)
                word[k : k + (kind > 0)] = [] if kind == 1 else [draw.choice("abcdefghil")]
            words.append("".join(word))
    for word in words:
        found = []
        for number, (term, stem) in enumerate(terms):
            row = edits(word, term)[-1] if not stem else min(edits(word[:n], term)[-1] for n in range(len(word) + 1))
            if row <= toxicity.allowed_edits(len(term), stem):
                found.append((row, -len(term), number))
        best = min(found, default=None)
        assert automaton.match(word) == ((best[2], best[0]) if best else None), word


def test_quoted_hits_count_less():
    lexicon = toxicity.Lexicon([("blockhead", False)], {(0, 0): 0.95, (0, 1): 0.9}, 0.01)
    scorer = lexicon.scorer()
    assert scorer.score("you utter blockhead, go") > 0.9 and scorer.score("you blokhead!!") > 0.85
    assert scorer.score('he said "you blockhead" and was sorry') < 0.7
    assert scorer.score(None) == scorer.score("") == scorer.score("nothing here") < 0.1
    assert list(toxicity.matched_terms("a bl0ckhead", lexicon)) == [("blockhead", 1, False)]


PAGES = [
    (1, "http://Sub.Example.COM/en/1?x=1"), (2, "https://www.example.com/en/2"), (3, "http://example.com"), (4, None), (5, "no scheme.com/"),
    (6, "http://a.net/fr/x#y"), (7, "http://a.net/frx"), (8, "http://xnet/es/"), (9, "https://x.org/en/1234?utm=1&b=2"), (9, "https://x.org/en/1234?utm=1&b=2"),
    (10, "http://com/"), (11, "://"), (12, "http://É.com/a\nb?c"), (13, "x://y://z.com/q"),
]


def by_hand(url):
    rest = (url or "").partition("://")[2] if "://" in (url or "") else ""
    host = rest[: min([rest.index(c) for c in "/?#" if c in rest], default=len(rest))]
    path = rest[len(host) :]
    path = path[: min([path.index(c) for c in "?#" if c in path], default=len(path))]
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
    fits = [(len(r), r, v) for v, r in RULES if (host == r.split("/")[0] or host.endswith("." + r.split("/")[0])) and path.startswith(r[r.index("/") :])]
    return host, path, *(max(fits)[1:] if fits else (None, None))


def test_url_rules(spark):
    more = [(100 + i, f"http://s{i}.example.{'com' if i % 2 else 'net'}/{'fr' if i % 3 else 'en'}/{i}") for i in range(200)]
    pages = spark.createDataFrame([(i, u, u) for i, u in PAGES + more], "page_id long, url string, host string")
    rows = urls.judge(pages, RULES).collect()
    assert len(rows) == len(PAGES) + 200
    wanted = {i: by_hand(u) for i, u in PAGES + more}
    for r in rows:
        host, path, rule, verdict = wanted[r.page_id]
        assert (r.host, r.path, r.rule) == (host, path, rule)
        assert r.verdict == verdict if verdict else r.verdict in ("allow", "block")
        assert (r.score is None) == (rule is not None)


def test_urls_without_labels(spark):
    pages = spark.createDataFrame(PAGES[8:9], "page_id long, url string")
    assert [(r.verdict, r.score) for r in urls.judge(pages, RULES).collect()] == [("allow", 0.0)]
    assert urls.judge(pages.limit(0), RULES).count() == 0
    only = spark.createDataFrame([(1, "http://a.net/fr/1"), (2, "http://b.org/")], "page_id long, url string")
    assert {r.page_id: r.verdict for r in urls.judge(only, RULES).collect()} == {1: "block", 2: "block"}


def test_url_sample_keeps_the_shares(spark):
    rows = [(i, f"http://h{i:04}.net/fr/{i:04}") for i in range(400)] + [(i, f"http://h{i:04}.com/fr/{i:04}") for i in range(400, 500)]
    rows += [(1000 + i, f"http://g{i:04}.org/fr/{i:04}") for i in range(50)]
    pages = spark.createDataFrame(rows, "page_id long, url string").repartition(3)
    whole = {r.page_id: r.score for r in urls.judge(pages, RULES).collect() if r.rule is None}
    few = {r.page_id: r.score for r in urls.judge(pages, RULES, per_verdict=40).collect() if r.rule is None}
    assert len(few) == 50 and max(abs(whole[i] - few[i]) for i in few) < 0.1
    labelled = spark.createDataFrame([("a.net", "/x/", 1.0)] * 30 + [("b.com", "/y/", 0.0)] * 10, "host string, path string, label double")
    shares = {r["last"]: r.last_share for r in urls.suffix_shares(labelled, 0.75)["last"].collect()}
    assert shares == {"net": (30 + 5 * 0.75) / 35, "com": 5 * 0.75 / 15}


def test_lexical_features(spark):
    frame = spark.createDataFrame([("http://a.b/c/d1?x=1&y=2#z", "a.b", "/c/d1")], "url string, host string, path string")
    got = frame.select(*(c.alias(n) for n, c in urls.lexical_features().items())).first().asDict()
    url = "http://a.b/c/d1?x=1&y=2#z"
    entropy = -sum(url.count(c) / len(url) * math.log2(url.count(c) / len(url)) for c in set(url))
    assert (got["length"], got["depth"], got["labels"], got["parameters"], got["fragment"], got["secure"]) == (25, 2, 2, 2, 1, 0)
    assert abs(got["entropy"] - entropy) < 1e-9 and abs(got["digits"] - 3 / 25) < 1e-9


def test_shared_lines(spark):
    rows = [(i, f"own line {i}\n  All rights reserved. \n\nend {i % 2}", f"s{i % 4}", "x") for i in range(1, 9)]
    rows += [(20, None, "s9", "x"), (21, "", "s9", "x"), (22, "All rights reserved.", None, "x"), (23, "All rights reserved.", "s1", "x"), (23, "All rights reserved.", "s1", "x")]
    documents = spark.createDataFrame(rows, "doc_id long, text string, source string, lines_removed string")
    found = {}
    for r in lines.remove_shared_lines(documents, sites=3).collect():
        found.setdefault(r.doc_id, []).append((r.text, r.lines_removed))
    assert found[1] == [("own line 1\n  All rights reserved. \n\nend 1", 0)], "the first document keeps it"
    assert found[2] == [("own line 2\n\nend 0", 1)], "ends stand at two sites only"
    assert found[20] == [(None, 0)] and found[21] == [("", 0)] and found[22] == [("All rights reserved.", 0)]
    assert found[23] == [("", 1)] * 2
    assert lines.remove_shared_lines(documents, sites=4).agg(F.sum("lines_removed")).first()[0] == 0
    assert lines.remove_shared_lines(documents.limit(0)).count() == 0
