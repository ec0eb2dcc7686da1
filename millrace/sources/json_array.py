"""JSON files that are one list of rows, read by blocks.

Such a file may be one line of any length, so it is read in pieces between commas, which
Spark's text source cuts at block borders like lines. Where a row begins depends on the
brackets and quotes before. Each block first says how deep it ends and whether inside a
text, for both ways it may begin; a prefix scan over these little tables gives each
block's real start. Then blocks cut their pieces into rows. A row that crosses a block
is put together from its parts; only these parts move.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from millrace.operators.ordinals import BROADCAST_BLOCKS
from millrace.session import stage

_MARK = re.compile(r'\\.|["\[\]{}]', re.DOTALL)


def array_pieces(spark: SparkSession, paths: list[str]) -> DataFrame:
    """``file``, ``block``, ``piece``: texts between commas. One task reads a block from its start to its end."""
    texts = spark.read.option("lineSep", ",").text(paths)
    return texts.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.col("value").alias("piece"))


def _after(piece: str, depth: int, inside: bool) -> tuple[int, bool, int, int]:
    """Depth, and whether inside a text, behind a piece; and which part of it lies in the outer brackets, if they are in it."""
    first, last = 0, len(piece)
    for match in _MARK.finditer(piece):
        mark = match[0]
        if mark == '"':
            inside = not inside
        elif not inside and mark in "[{":
            depth += 1
            if depth == 1 and mark == "[":
                first = match.end()
        elif not inside and mark in "]}":
            depth -= 1
            if depth == 0 and mark == "]":
                last = match.start()
    return depth, inside, first, last


def _summaries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of each block, begun outside and inside a text: the change of depth, and whether it ends inside one."""
    of, states, opener = None, [(0, False), (0, True)], ""

    def row() -> pa.RecordBatch:
        columns = [pa.array([of[0]], pa.string()), pa.array([of[1]], pa.int64()), pa.array([[d for d, _ in states]], pa.list_(pa.int64())), pa.array([[x for _, x in states]], pa.list_(pa.bool_())), pa.array([opener])]
        return pa.RecordBatch.from_arrays(columns, names=["file", "block", "deeper", "inside", "opener"])

    for batch in batches:
        for file, block, piece in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if of != (file, block):
                if of is not None:
                    yield row()
                of, states, opener = (file, block), [(0, False), (0, True)], piece.strip()[:1]
            states = [_after(piece, *s)[:2] for s in states]
    if of is not None:
        yield row()


def _starts(pieces: DataFrame) -> DataFrame:
    """``file``, ``block``, ``depth``, ``inside``, ``place``, ``base``: how each block begins, its place among its file's blocks, and the depth of the file's rows."""
    ends = pieces.mapInArrow(_summaries, "file string, block long, deeper array<long>, inside array<boolean>, opener string")
    own = Window.partitionBy("file").orderBy("block")
    above = own.rowsBetween(Window.unboundedPreceding, -1)
    # A quote changes sides whichever side it is on: a block begins inside a text if the blocks before changed sides an odd number of times.
    changes = F.coalesce(F.sum(F.get("inside", F.lit(0)).cast("int")).over(above), F.lit(0))
    begun = ends.withColumn("_inside", changes % 2 == 1).withColumn("_deeper", F.get("deeper", F.col("_inside").cast("int")))
    depth = F.coalesce(F.sum("_deeper").over(above), F.lit(0).cast("long"))
    place, opener = F.row_number().over(own) - 1, F.first("opener").over(own)
    base = F.when(opener == "[", 1).otherwise(0)
    return begun.select("file", "block", depth.alias("depth"), F.col("_inside").alias("inside"), place.alias("place"), base.alias("base"))


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows and parts of rows: ``file``, ``place`` (of the block), ``part`` (the first and last of a block may be parts), ``text``, ``begins``, ``ends``.

    A row is what stands between two commas, or a comma and a bracket, of the outer list; ``base`` is
    the depth of such commas, 0 in a file that is no list.
    """
    names = ["file", "place", "part", "text", "begins", "ends"]
    kinds = [pa.string(), pa.int32(), pa.int64(), pa.string(), pa.bool_(), pa.bool_()]
    out: list[tuple] = []
    of, held, size = None, [], 0
    depth, inside, part, begins = 0, False, 0, True

    def add(ends: bool) -> None:
        nonlocal held, part, begins
        out.append((of[0], of[2], part, ",".join(held), begins, ends))
        held, part, begins = [], part + 1, True

    def flush() -> pa.RecordBatch:
        nonlocal size
        batch = pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], kind) for i, kind in enumerate(kinds)], names=names)
        out.clear()
        size = 0
        return batch

    for batch in batches:
        for file, block, piece, at_depth, at_inside, place, base in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if of is None or of[:2] != (file, block):
                if held:  # else the block ends where a row does
                    add(False)
                of, held, part = (file, block, place), [], 0
                depth, inside, begins = at_depth, at_inside, place == 0 or (at_depth <= base and not at_inside)
            depth, inside, first, last = _after(piece, depth, inside)
            held.append(piece[first:last] if base else piece)
            size += len(piece)
            # A comma at the outer list's depth ends the row; the piece behind it begins the next.
            if depth <= base and not inside:
                add(True)
            if size > 1 << 22:
                yield flush()
    if held:
        add(False)
    if out:
        yield flush()


def read_array_rows(spark: SparkSession, paths: list[str]) -> DataFrame:
    """``file``, ``text``: the elements of the outer lists of JSON files; a file of one other value gives that value.

    Brackets and quotes must match, as in any JSON; texts are not checked further. Each element
    is one line: line breaks between its parts become blanks. Elements keep no order.
    """
    pieces = array_pieces(spark, paths)
    starts = stage(_starts(pieces), "json-blocks")
    if starts.count() <= BROADCAST_BLOCKS:
        begun = pieces.join(F.broadcast(starts), ["file", "block"])
    else:
        placed = pieces.withColumn("_place", F.monotonically_increasing_id())
        begun = placed.join(starts, ["file", "block"]).repartition("file", "block").sortWithinPartitions("file", "block", "_place")
    begun = begun.select("file", "block", "piece", "depth", "inside", "place", "base")
    cut = stage(begun.mapInArrow(_rows, "file string, place int, part long, text string, begins boolean, ends boolean"), "json-rows")
    # A row's parts are the end of a block, whole blocks and the begin of one: they share the number of row ends before them.
    parts = cut.where("not (begins and ends)")
    before = Window.partitionBy("file").orderBy("place", "part").rowsBetween(Window.unboundedPreceding, -1)
    numbered = parts.withColumn("_row", F.coalesce(F.sum(F.col("ends").cast("int")).over(before), F.lit(0)))
    joined = numbered.groupBy("file", "_row").agg(F.array_sort(F.collect_list(F.struct("place", "part", "text"))).alias("parts"))
    whole = cut.where("begins and ends").select("file", "text").unionByName(joined.select("file", F.array_join(F.transform("parts", lambda p: p["text"]), ",").alias("text")))
    return whole.select("file", F.trim(F.translate("text", "\r\n\t", "   ")).alias("text")).where("text <> ''")
