"""Verdicts on urls: rules first, then boosted trees on lexical features.

Everything is a column expression or an estimator of Spark's own library; no
Python runs in tasks. The urls that a rule decides are the labelled ones. Trees
are trained on a bounded sample of them, weighted back to the true shares of the
verdicts, and judge the urls that no rule fits. Suffixes are counted over all
labelled urls.
"""

from __future__ import annotations

from functools import reduce

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.session import stage

#: Labelled urls of each verdict that the trees learn from at most.
PER_VERDICT = 10_000
#: Trees and their depth.
TREES, DEPTH = 10, 4
#: Urls whose verdicts are mixed into the share of a suffix with few urls.
SUFFIX_PRIOR = 5.0

_SPLIT = r"(?s)^.*?://([^/?#]*)([^?#]*)"
Rule = tuple[str, str, str]  # verdict, host, path


def host_of(url: str) -> Column:
    """What stands after the first "://" up to "/", "?", "#" or the end, A-Z lower-cased; empty without one."""
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.translate(F.coalesce(F.regexp_extract(url, _SPLIT, 1), F.lit("")), upper, upper.lower())


def path_of(url: str) -> Column:
    return F.coalesce(F.regexp_extract(url, _SPLIT, 2), F.lit(""))


def parse_rule(verdict: str, pattern: str) -> Rule:
    """("block", "net/es/") -> ("block", "net", "/es/")."""
    host, slash, path = pattern.partition("/")
    return verdict, host, slash + path


def longest_rule(rules: list[Rule]) -> tuple[Column, Column]:
    """The fitting rule with the longest text, and its verdict; null where none fits."""
    pattern, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for kind, host, path in sorted(rules, key=lambda r: len(r[1] + r[2])):
        fits = ((F.col("host") == host) | F.endswith("host", F.lit("." + host))) & F.startswith("path", F.lit(path))
        pattern = F.when(fits, F.lit(host + path)).otherwise(pattern)
        verdict = F.when(fits, F.lit(kind)).otherwise(verdict)
    return pattern, verdict


def lexical_features() -> dict[str, Column]:
    """Numbers from the characters of ``url``, ``host`` and ``path``."""
    url = F.coalesce("url", F.lit(""))
    size = F.length(url)

    def share(pattern: str) -> Column:
        return F.length(F.regexp_replace(url, pattern, "")) / F.greatest(size, F.lit(1))

    def occurs(text: Column, c: str) -> Column:
        return F.length(text) - F.length(F.replace(text, F.lit(c), F.lit("")))

    def information(c: Column) -> Column:
        p = (size - F.length(F.replace(url, c, F.lit("")))) / F.greatest(size, F.lit(1))
        return F.when(p > 0, -p * F.log2(p)).otherwise(0.0)

    letters = F.array_distinct(F.split(url, ""))
    entropy = F.aggregate(letters, F.lit(0.0), lambda total, c: total + F.when(c != "", information(c)).otherwise(0.0))
    query = F.regexp_extract(url, r"\?([^#]*)", 1)
    return {
        "length": size.cast("double"),
        "host_length": F.length("host").cast("double"),
        "path_length": F.length("path").cast("double"),
        "depth": occurs(F.col("path"), "/").cast("double"),
        "labels": (occurs(F.col("host"), ".") + 1).cast("double"),
        "digits": share("[^0-9]").cast("double"),
        "marks": share("[A-Za-z0-9]").cast("double"),
        "entropy": entropy,
        "parameters": F.when(query == "", 0.0).otherwise(occurs(query, "&") + 1.0),
        "fragment": F.contains(url, F.lit("#")).cast("double"),
        "secure": F.startswith(url, F.lit("https:")).cast("double"),
    }


def _suffixes() -> dict[str, Column]:
    """Ends of a host and beginnings of a path whose verdicts are counted."""
    return {
        "last": F.element_at(F.split("host", r"\."), -1),
        "last_two": F.concat_ws(".", F.slice(F.split("host", r"\."), -2, 2)),
        "first_folder": F.regexp_extract("path", "^/([^/]*)", 1),
    }


def _with_slices(frame: DataFrame) -> DataFrame:
    columns = _suffixes()
    columns["last_two"] = F.when(F.contains("host", F.lit(".")), columns["last_two"]).otherwise(F.col("host"))
    return frame.withColumns(columns)


def _with_suffix_shares(frame: DataFrame, shares: dict[str, DataFrame], prior: float) -> DataFrame:
    """Joins each suffix's share of blocked urls. Suffixes are unbounded, so Spark chooses the kind of join by their size."""
    for name, share in shares.items():
        frame = frame.join(share, name, "left").fillna({f"{name}_share": prior})
    return frame


def suffix_shares(labelled: DataFrame, prior: float) -> dict[str, DataFrame]:
    """For each kind of suffix, its values in ``labelled`` and the share of blocked urls of each, drawn towards ``prior``."""
    prepared = _with_slices(labelled)
    share = (F.sum("label") + SUFFIX_PRIOR * prior) / (F.count("*") + SUFFIX_PRIOR)
    return {name: stage(prepared.groupBy(name).agg(share.alias(f"{name}_share")), "url-suffixes") for name in _suffixes()}


def judge(pages: DataFrame, rules: list[tuple[str, str]], per_verdict: int = PER_VERDICT) -> DataFrame:
    """``page_id``, ``host``, ``path``, ``rule``, ``verdict`` and ``score`` of every row.

    ``rules`` are (verdict, host/path) pairs. ``score`` is the trees' probability of
    "block", null where a rule decides. A null url, or one without "://", has an empty
    host and path, fits no rule and is judged by the trees like any other. Where no url,
    or only one verdict, is labelled, the trees are left out: the score is that verdict's
    (0 without labels, so "allow"). Repeated rows are judged alike; other columns are not read.
    """
    pattern, verdict = longest_rule([parse_rule(*r) for r in rules])
    split = pages.select("page_id", "url").select("page_id", "url", host_of("url").alias("host"), path_of("url").alias("path"))
    split = split.withColumns({"rule": pattern, "decided": verdict})
    labelled = split.where("decided is not null").select("url", "host", "path", (F.col("decided") == "block").cast("double").alias("label"))
    order = (F.xxhash64("url"), "url")
    sample = reduce(DataFrame.unionByName, [labelled.where(F.col("label") == v).orderBy(*order).limit(per_verdict) for v in (0.0, 1.0)])
    counts = {r["label"]: r["count"] for r in labelled.groupBy("label").count().collect()}
    if len(counts) < 2:
        score = F.lit(1.0 if 1.0 in counts else 0.0)
        scored = split.withColumn("score", F.when(F.isnull("rule"), score))
    else:
        # A sampled url stands for as many as its verdict has for each one in the sample.
        weight = F.when(F.col("label") == 1.0, max(1.0, counts[1.0] / per_verdict)).otherwise(max(1.0, counts[0.0] / per_verdict))
        sample = stage(sample.withColumn("weight", weight), "url-sample")
        scored = _score_with_trees(split, sample, labelled, counts[1.0] / sum(counts.values()))
    judged = F.when(F.col("score") >= 0.5, "block").otherwise("allow")
    return scored.select("page_id", "host", "path", "rule", F.coalesce("decided", judged).alias("verdict"), "score")


def _score_with_trees(split: DataFrame, sample: DataFrame, labelled: DataFrame, prior: float) -> DataFrame:
    prepared = _with_slices(sample)
    shares = suffix_shares(labelled, prior)
    lexical = lexical_features()
    inputs = [*lexical, *(f"{name}_share" for name in shares)]
    assembler = VectorAssembler(inputCols=inputs, outputCol="features")
    # The sample is bounded; a few partitions keep the many short jobs of the training short.
    training = stage(_with_suffix_shares(prepared, shares, prior).withColumns(lexical).select(*inputs, "label", "weight").coalesce(4), "url-training")
    trees = GBTClassifier(featuresCol="features", labelCol="label", weightCol="weight", maxIter=TREES, maxDepth=DEPTH, seed=1).fit(assembler.transform(training))
    open_rows = _with_suffix_shares(_with_slices(split), shares, prior).withColumns(lexical)
    scored = trees.transform(assembler.transform(open_rows))
    return scored.withColumn("score", F.when(F.isnull("rule"), vector_to_array("probability")[1]))
