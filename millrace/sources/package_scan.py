"""Packaged repositories of any size: read by blocks of lines, one row per entry.

A package that doesn't fit a row, or one task, is read like any text file, in blocks. Which
tags count depends on the tags before: inside the files section a file opens, and what
looks like a tag in its body is body. A block can't know that of itself, so the scan runs
twice. First each block says, for every state it may begin in, in which state it ends and
how many files it opens; a prefix scan over these little tables gives the state in which
each block really begins. Then blocks cut their lines into entries. Entries that lie in one
block are done; the parts of the others meet by package and entry.

A tag must stand on one line. Everything else is as ``functions.packages`` reads a package
held in one row.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from millrace.functions.packages import OPEN_TAG, extension_counts, has_path, mentions
from millrace.functions.text import line_count
from millrace.operators.ordinals import BROADCAST_BLOCKS
from millrace.session import stage
from millrace.sources.listing import PACKAGE_GLOB, list_files, package_language

#: Before the files section, in it, in a file's body, behind the section.
BEFORE, SECTION, BODY, BEHIND = range(4)
_TAG = re.compile(rf"<files>|</files>|</file>|{OPEN_TAG}")
#: In packages of several files a block's number is its part's number, then its place in the part.
_PART_BITS = 42
_MAY_HOLD_TAG = "<files>|</files>|</file>|<file path="


def next_state(state: int, tag: str) -> int:
    """The state behind a tag."""
    if tag == "<files>":
        return SECTION if state == BEFORE else state
    if tag == "</files>":
        return BEHIND if state in (SECTION, BODY) else state
    if tag == "</file>":
        return SECTION if state == BODY else state
    return BODY if state == SECTION else state


def package_lines(
    spark: SparkSession, root: str, languages: list[str] | None = None, pattern: str = PACKAGE_GLOB, in_parts: bool = False
) -> DataFrame:
    """Lines of the packages below ``<root>/<language>/`` with the block they were read in: ``file``, ``block``, ``line``.

    One task reads a block from its start to its end. ``in_parts``: a language's folder is one
    package, its files are the parts in the order of the first number in their names (as in Spark's
    ``part-00012-...``), each cut behind a line. ``file`` is then the folder's path up to its last slash.
    """
    folders = [f"{root}/{name}" for name in languages] if languages else [f"{root}/*"]
    texts = spark.read.option("pathGlobFilter", pattern).text(folders)
    file, block = F.col("_metadata.file_path"), F.col("_metadata.file_block_start")
    if in_parts:
        name = F.col("_metadata.file_name")
        block = F.shiftleft(F.regexp_extract(name, r"\d+", 0).cast("long"), _PART_BITS) + block
        file = F.substring(file, F.lit(1), F.length(file) - F.length(F.element_at(F.split(file, "/"), -1)))
    return texts.select(file.alias("file"), block.alias("block"), F.col("value").alias("line"))


def _check_parts(spark: SparkSession, root: str, languages: list[str] | None, pattern: str) -> None:
    """Parts whose names give no number, or the same, have no order: an error."""
    listed = [list_files(spark, folder, pattern) for folder in ([f"{root}/{name}" for name in languages] if languages else [f"{root}/*"])]
    files = reduce(lambda a, b: a.unionByName(b), listed)
    number = F.regexp_extract("file_name", r"\d+", 0).try_cast("long")
    folder = F.regexp_replace("path", "/[^/]*$", "")
    wrong = files.groupBy(folder.alias("folder"), number.alias("number")).agg(F.count(F.lit(1)).alias("n"), F.min("path").alias("path"))
    if found := wrong.where("number is null or n > 1").select("path").head():
        raise ValueError(f"no part number of its own: {found.path}")


def _per_block(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, int, Iterator[str]]]:
    """(file, block, lines) runs of a task's rows; a run may come in several pieces."""
    for batch in batches:
        files, blocks, lines = (batch.column(i).to_pylist() for i in range(3))
        first = 0
        for at in range(1, len(lines) + 1):
            if at == len(lines) or (files[at], blocks[at]) != (files[first], blocks[first]):
                yield files[first], blocks[first], lines[first:at]
                first = at


def _summaries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For each block and each state it may begin in: the state at its end, and the files opened."""
    names = ["file", "block", "ends", "opened"]

    def row(of: tuple[str, int], ends: list[int], opened: list[int]) -> pa.RecordBatch:
        columns = [pa.array([of[0]], pa.string()), pa.array([of[1]], pa.int64()), pa.array([ends], pa.list_(pa.int32())), pa.array([opened], pa.list_(pa.int64()))]
        return pa.RecordBatch.from_arrays(columns, names=names)

    of, ends, opened = None, [0] * 4, [0] * 4
    for file, block, lines in _per_block(batches):
        if of != (file, block):
            if of is not None:
                yield row(of, ends, opened)
            of, ends, opened = (file, block), [*range(4)], [0] * 4
        for line in lines:
            for tag in _TAG.findall(line):
                for begin in range(4):
                    after = next_state(ends[begin], tag)
                    opened[begin] += after == BODY and ends[begin] == SECTION
                    ends[begin] = after
    if of is not None:
        yield row(of, ends, opened)


def block_starts(lines: DataFrame) -> DataFrame:
    """``file``, ``block``, ``state``, ``entry``: the state each block begins in, and the files opened before it.

    Blocks without tags change nothing, but need a state as well. Packages whose section
    doesn't begin or doesn't end have no blocks here.
    """
    tagged = lines.where(F.regexp_like("line", F.lit(_MAY_HOLD_TAG)))
    changes = tagged.mapInArrow(_summaries, "file string, block long, ends array<int>, opened array<long>")
    # The section begins in the first block that leaves ``BEFORE``. From there on a block ends in the same state whether a
    # file is open at its begin or not, or, without a tag that opens or closes, as it began; the section's end is final.
    until = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, 0)
    above = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    end = [F.get("ends", F.lit(state)) for state in range(4)]
    begun = F.coalesce(F.max(end[BEFORE] != BEFORE).over(above), F.lit(False))
    fixed = F.when(~F.col("_begun"), end[BEFORE]).when(end[SECTION] == end[BODY], end[SECTION])
    followed = changes.withColumn("_begun", begun).withColumn("_fixed", fixed)
    closed = F.max(F.col("_fixed") == BEHIND).over(until)
    followed = followed.withColumn("state", F.when(closed, F.lit(BEHIND)).otherwise(F.last("_fixed", ignorenulls=True).over(until)))
    at = F.coalesce(F.lag("state").over(Window.partitionBy("file").orderBy("block")), F.lit(BEFORE))
    followed = followed.withColumn("_opened", F.get("opened", at))
    scanned = followed.withColumn("entry", F.sum("_opened").over(until))
    # Behind each block that has tags; a block begins as the last such block before it ends.
    ends = scanned.select("file", "block", "state", "entry")
    blocks = lines.select("file", "block").groupBy("file", "block").agg(F.count(F.lit(1)).alias("_n")).select("file", "block", F.lit(None).cast("int").alias("state"), F.lit(None).cast("long").alias("entry"))
    both = blocks.withColumn("_own", F.lit(1)).unionByName(ends.withColumn("_own", F.lit(0)))
    before = Window.partitionBy("file").orderBy("block", F.desc("_own")).rowsBetween(Window.unboundedPreceding, -1)
    known = both.select(
        "file", "block", "_own",
        F.coalesce(F.last("state", ignorenulls=True).over(before), F.lit(BEFORE)).alias("state"),
        F.coalesce(F.last("entry", ignorenulls=True).over(before), F.lit(0)).alias("entry"),
        F.max(F.col("state") == BEHIND).over(Window.partitionBy("file")).alias("_closed"),
    )
    return known.where("_own = 1 and _closed").drop("_own", "_closed")


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Entries and parts of entries of each block: lines come with the state and entry number their block begins with."""
    names = ["file", "entry", "block", "path", "body", "opens", "closes", "named"]
    kinds = [pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.bool_(), pa.bool_(), pa.list_(pa.string())]
    rows: list[tuple] = []
    held = 0

    def flush() -> pa.RecordBatch:
        nonlocal held
        batch = pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], kind) for i, kind in enumerate(kinds)], names=names)
        rows.clear()
        held = 0
        return batch

    of = state = entry = path = None
    body: list[str] = []
    opens, named = False, []

    def end_part(closes: bool) -> None:
        nonlocal body, held, named
        text = "\n".join(body)
        rows.append((of[0], entry, of[1], path, text, opens, closes, named))
        held += len(text)
        body, named = [], []

    for batch in batches:
        columns = [batch.column(i).to_pylist() for i in range(5)]
        for file, block, line, begin, number in zip(*columns, strict=True):
            if of != (file, block):
                if of is not None and (state == BODY or named):
                    end_part(False)
                of, state, entry, path, opens, body, named = (file, block), begin, number, None, False, [], []
            at = 0
            for match in _TAG.finditer(line) if "<" in line else ():
                tag, before = match[0], state
                state = next_state(state, tag)
                if tag[:5] == "<file" and tag != "<files>" and before in (SECTION, BODY):
                    named.append(tag[len('<file path="') : -2])
                if before == BODY and state != BODY:
                    body.append(line[at : match.start()])
                    if state == SECTION:
                        end_part(True)
                    else:  # the section ends in an open file: no entry, but its names count
                        body = []
                        path = None
                        end_part(False)
                if before == SECTION and state == BODY:
                    entry, path, opens, at, body = entry + 1, named[-1], True, match.end(), []
            if state == BODY:
                body.append(line[at:])
            if held > 1 << 22:
                yield flush()
    if of is not None and (state == BODY or named):
        end_part(False)
    if rows:
        yield flush()


def read_entries(
    spark: SparkSession, root: str, languages: list[str] | None = None, pattern: str = PACKAGE_GLOB, in_parts: bool = False
) -> tuple[DataFrame, DataFrame]:
    """Entries of all packages, and every path that a package's section names.

    Entries: ``file``, ``language``, ``entry`` (from 1 in each file), ``path``, ``body``, for
    files that are closed before the first section ends; a package without a whole section has none. Names: ``file``, ``paths`` as
    ``functions.packages.file_paths`` finds them, part by part, those in bodies too.
    The pieces are written once; only those of entries that cross a block move. ``in_parts`` is as
    for ``package_lines``: an entry may begin in one part and end in a later one.
    """
    if in_parts:
        _check_parts(spark, root, languages, pattern)
    lines = package_lines(spark, root, languages, pattern, in_parts)
    starts = stage(block_starts(lines), "package-blocks")
    if starts.count() <= BROADCAST_BLOCKS:
        begun = lines.join(F.broadcast(starts), ["file", "block"])
    else:
        # A line's place keeps its block's order over the exchange.
        placed = lines.withColumn("_place", F.monotonically_increasing_id())
        begun = placed.join(starts, ["file", "block"]).repartition("file", "block").sortWithinPartitions("file", "block", "_place")
    begun = begun.select("file", "block", "line", "state", "entry")
    schema = "file string, entry long, block long, path string, body string, opens boolean, closes boolean, named array<string>"
    pieces = stage(begun.mapInArrow(_pieces, schema), "package-pieces")
    whole = pieces.where("opens and closes").select("file", "entry", "path", "body")
    parts = pieces.where("not (opens and closes)").groupBy("file", "entry").agg(
        F.max("path").alias("path"),
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("block", "body"))), lambda p: p["body"]), "\n").alias("body"),
        F.bool_or("opens").alias("opens"),
        F.bool_or("closes").alias("closes"),
    )
    joined = parts.where("opens and closes").select("file", "entry", "path", "body")
    entries = whole.unionByName(joined)
    entries = entries.select("file", package_language(F.col("file")).alias("language"), "entry", "path", "body")
    return entries, pieces.where(F.size("named") > 0).select("file", F.col("named").alias("paths"))


def repository_columns(entries: DataFrame, names: DataFrame) -> DataFrame:
    """Per package what its entries add up to: ``files_with_content``, ``total_lines``, ``avg_lines_per_file``, ``file_types`` and the flags.

    Sums over entries and names, combined before they move; a package without a closed entry has 0 files.
    """
    kinds = F.element_at(F.map_keys(extension_counts(F.array(F.struct("path", "body")))), 1)
    each = entries.select("file", "entry", kinds.alias("kind"), line_count("body").alias("n"))
    counts = each.groupBy("file", "kind").agg(F.count(F.lit(1)).alias("n_files"), F.sum("n").alias("n_lines"), F.min("entry").alias("first"))
    # A package's kinds of file: one short entry each, in the order they first appear.
    types = F.map_from_entries(F.transform(F.array_sort(F.collect_list(F.struct("first", "kind", "n_files"))), lambda x: F.struct(x["kind"], x["n_files"].cast("int"))))
    totals = counts.groupBy("file").agg(F.sum("n_files").alias("files_with_content"), F.sum("n_lines").alias("total_lines"), types.alias("file_types"))
    flags = names.groupBy("file").agg(
        F.bool_or(mentions("paths", "readme")).alias("has_readme"),
        F.bool_or(mentions("paths", "license")).alias("has_license"),
        F.bool_or(has_path("paths", ".gitignore")).alias("has_gitignore"),
    )
    joined = flags.join(totals, "file", "left")
    files, n_lines = (F.coalesce(F.col(c), F.lit(0)).cast("bigint") for c in ("files_with_content", "total_lines"))
    return joined.select(
        "file", files.alias("files_with_content"), n_lines.alias("total_lines"),
        F.coalesce(F.try_divide(n_lines.cast("double"), files), F.lit(0.0)).alias("avg_lines_per_file"),
        F.coalesce("file_types", F.create_map().cast("map<string,int>")).alias("file_types"), "has_readme", "has_license", "has_gitignore",
    )
