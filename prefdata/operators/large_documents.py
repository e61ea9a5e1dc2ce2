"""Chunks of documents that are larger than a row or a task should be.

A document comes as lines in pieces: consecutive ranges of lines, each small enough for a task. Three
things cross the pieces' edges and are handed on: a paragraph that goes on in the next piece, the chunk that is
open, and the tail that the next chunk begins with. None of them needs the text before a piece:

- The packing rule looks at lengths only. What it knows at a piece's beginning is the length of the open chunk, where all
  lengths above the chunk size act alike; so a piece works out where each of these few hundred states leads, in
  parallel with all others, and a walk over the pieces' tables, no texts, tells each piece its state.
- With its state known, a piece cuts its own paragraphs; of chunks that lie in several pieces it gives its part.
- The tail is the end of all paragraphs so far, a few characters per piece.

The chunks are those of ``documents.document_chunks`` for the whole text. Rows of a piece come sorted, one piece after
another, through one function call a task: pieces may be small and many.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Callable, Iterator
from itertools import groupby
from operator import itemgetter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from prefdata.functions import fixed
from prefdata.functions.text import strip
from prefdata.sources.files import PIECE_BYTES, read_lines
from prefdata.sources.scratch import materialise

ROWS, CHARACTERS = 10_000, 8 << 20  # that a task gives at once


def chunks_of_lines(
    lines: DataFrame,
    size: int = fixed.CHUNK_SIZE,
    overlap: int = fixed.CHUNK_OVERLAP,
    shortest: int = fixed.MIN_CHUNK,
    by_line: bool = False,
) -> DataFrame:
    """(key, chunk_no, chunk) from (key, piece long, position long, text), a row per line.

    Pieces follow each other by number and lines within a piece by position; how the lines are dealt into
    pieces doesn't change the chunks. Paragraphs are divided by empty lines, or are the lines themselves
    (``by_line``). A null line is an empty one. A paragraph is never cut, so one has to fit a row.
    """
    slim = lines.select("key", "piece", "position", F.coalesce("text", F.lit("")).alias("text"))
    if by_line:
        paragraphs = slim.withColumnRenamed("position", "place")
    else:
        kind = lines.schema["key"].dataType.simpleString()
        schema = f"key {kind}, piece long, place long, text string, from_before boolean, goes_on boolean"
        paragraphs = _joined(materialise(_each(slim, ["key", "piece"], ["position"], _fragments, schema)))
    paragraphs = materialise(
        paragraphs.select("key", "piece", "place", strip("text").alias("text")).filter("text <> ''")
    )
    parts = _parts(paragraphs, size, overlap)
    part = F.sort_array(F.collect_list(F.struct("piece", "text")))
    across = parts.filter("not whole").groupBy("key", "number").agg(
        F.max("piece").alias("piece"), F.array_join(part["text"], "").alias("text")
    )
    chunks = materialise(
        parts.filter("whole").select("key", "number", "piece", "text").unionByName(across)
        .select("key", "number", "piece", strip("text").alias("chunk"))
        .filter(F.length("chunk") >= shortest)
    )
    # Numbers without the chunks that were dropped: within a piece, after all of the pieces before.
    sizes = chunks.groupBy("key", "piece").agg(F.count(F.lit(1)).alias("_n"))
    earlier = Window.partitionBy("key").orderBy("piece").rowsBetween(Window.unboundedPreceding, -1)
    firsts = sizes.select("key", "piece", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_first"))
    inside = Window.partitionBy("key", "piece").orderBy("number")
    return chunks.join(firsts, ["key", "piece"]).select(
        "key", (F.col("_first") + F.row_number().over(inside) - 1).alias("chunk_no"), "chunk"
    )


def large_file_chunks(
    spark: SparkSession,
    folder: str,
    size: int = fixed.CHUNK_SIZE,
    overlap: int = fixed.CHUNK_OVERLAP,
    by_line: bool = False,
    piece_bytes: int = PIECE_BYTES,
) -> DataFrame:
    """(path, chunk_no, chunk) of the text files below a folder, however large they are."""
    lines = read_lines(spark, folder, piece_bytes).withColumnRenamed("path", "key")
    return chunks_of_lines(lines, size, overlap, by_line=by_line).withColumnRenamed("key", "path")


def _each(
    rows: DataFrame, by: list[str], order: list[str], make: Callable[[tuple, Iterator[tuple]], Iterator[tuple]], schema: str
) -> DataFrame:
    """What ``make`` gives for each group of rows that are alike in ``by``, its rows sorted; groups are not held.

    A task takes its groups one after another, which costs nothing per group, as a data frame for each would.
    """
    names = [f.split()[0] for f in schema.split(", ")]
    places = [rows.columns.index(name) for name in by]
    keys = itemgetter(*places) if len(by) > 1 else lambda row: (row[places[0]],)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple] = []
        size = 0

        def batch() -> pa.RecordBatch:
            columns = zip(*out)
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, arrow.types)], names=names)

        def read() -> Iterator[tuple]:
            for given in batches:
                yield from zip(*[given.column(k).to_pylist() for k in range(given.num_columns)])

        for key, group in groupby(read(), keys):
            for row in make(key, group):
                out.append(row)
                size += sum(len(v) for v in row if isinstance(v, (str, list)))
                if len(out) >= ROWS or size >= CHARACTERS:
                    yield batch()
                    out.clear()
                    size = 0
        if out:
            yield batch()

    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import _parse_datatype_string

    arrow = to_arrow_schema(_parse_datatype_string(schema))
    return rows.repartition(*by).sortWithinPartitions(*by, *order).mapInArrow(run, schema)


def _fragments(key: tuple, lines: Iterator[tuple]) -> Iterator[tuple]:
    """Paragraphs of a piece, divided by empty lines; the first and last may go on beyond its edges.

    A piece of empty lines has one row without a text: no paragraph goes on through it.
    """
    held, place, begins = [], 0, True
    for *_, line in lines:
        if line:
            held.append(line)
            continue
        if held:
            yield (*key, place, "\n".join(held), begins, False)
            held, place = [], place + 1
        begins = False
    if held:
        yield (*key, place, "\n".join(held), begins, True)
    elif not place:
        yield (*key, -1, None, False, False)


def _joined(fragments: DataFrame) -> DataFrame:
    """(key, piece, place, text): whole paragraphs, where they begin. Those within a piece are not shuffled."""
    pieces = fragments.groupBy("key", "piece").agg(
        F.max("place").alias("_last"),
        F.coalesce(F.max(F.when(F.col("place") == 0, F.col("from_before"))), F.lit(False)).alias("_from"),
        F.max_by("goes_on", "place").alias("_on"),
        F.min((F.col("place") == 0) & F.col("from_before") & F.col("goes_on")).alias("_through"),
    )
    order = Window.partitionBy("key").orderBy("piece")
    joins = F.col("_from") & F.coalesce(F.lag("_on").over(order), F.lit(False))
    known = pieces.withColumn("_joins", joins)
    # The paragraph that goes on from a piece is its last one, unless that goes through from before.
    begins = F.when(~(F.col("_joins") & F.col("_through")), F.struct("piece", F.col("_last").alias("place")))
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    known = known.select(
        "key", "piece", "_joins", "_last", F.last(begins, ignorenulls=True).over(before).alias("_begun")
    )
    placed = fragments.filter("text is not null").join(known, ["key", "piece"])
    continues = F.col("_joins") & (F.col("place") == 0)
    owner = F.when(continues, F.col("_begun")).otherwise(F.struct("piece", "place"))
    at_edge = continues | ((F.col("place") == F.col("_last")) & F.col("goes_on"))
    placed = placed.select("key", "piece", "place", "text", owner.alias("_owner"), at_edge.alias("_edge"))
    part = F.sort_array(F.collect_list(F.struct("piece", "text")))
    long = placed.filter("_edge").groupBy("key", "_owner").agg(F.array_join(part["text"], "\n").alias("text"))
    return placed.filter("not _edge").select("key", "piece", "place", "text").unionByName(
        long.select("key", "_owner.piece", "_owner.place", "text")
    )


def _add(open_: int, n: int, size: int, overlap: int) -> tuple[int, bool]:
    """Length of the open chunk after a paragraph of n characters, and whether one was closed before it."""
    if open_ + n <= size:
        return open_ + n + 1, False
    return min(overlap, open_) + n + 1, open_ > 0


def _follow(lengths: list[int], size: int, overlap: int) -> tuple[list[int], list[int]]:
    """For an open chunk of each length (0 .. size, and any above): its length in the end, and chunks closed.

    Lengths that have become one are followed as one; a few paragraphs do for that.
    """
    most = size + 1
    now, closed = np.arange(most + 1), np.zeros(most + 1, np.int64)
    at = 0
    while at < len(lengths) and (now != now[0]).any():
        n = lengths[at]
        fits = now + n <= size
        closed += ~fits & (now > 0)
        now, at = np.minimum(np.where(fits, now, np.minimum(overlap, now)) + n + 1, most), at + 1
    if at < len(lengths):
        one, shuts = int(now[0]), 0
        for n in lengths[at:]:
            one, shut = _add(one, n, size, overlap)
            one, shuts = min(one, most), shuts + shut
        now, closed = np.full(most + 1, one), closed + shuts
    return now.tolist(), closed.tolist()


def _runs(values: list[int]) -> tuple[list[int], list[int], list[int]]:
    """A list in runs of numbers that stay or rise by one: where each begins, with what, and by how much it rises."""
    begins, first, rise = [], [], []
    for at, value in enumerate(values):
        if begins:
            length = at - begins[-1]
            if length == 1 and value - first[-1] in (0, 1):
                rise[-1] = value - first[-1]
                continue
            if length > 1 and value == first[-1] + rise[-1] * length:
                continue
        begins.append(at)
        first.append(value)
        rise.append(0)
    return begins, first, rise


def _value(begins: list[int], first: list[int], rise: list[int], at: int) -> int:
    k = bisect_right(begins, at) - 1
    return first[k] + rise[k] * (at - begins[k])


def _parts(paragraphs: DataFrame, size: int, overlap: int) -> DataFrame:
    """(key, piece, number, text, whole): what each piece has of a document's chunks."""
    kind = paragraphs.schema["key"].dataType.simpleString()

    def table(key, rows):
        lengths, tail = [], ""
        for *_, n, end in rows:
            lengths.append(n)
            if overlap:
                tail = (tail + end + "\n")[-overlap:]
        ends, closed = _follow(lengths, size, overlap)
        yield (*key, *_runs(ends), *_runs(closed), tail)

    def walk(key, rows):
        state, number, tail = 0, 0, ""
        for _, piece, *runs, own in rows:
            yield key[0], piece, state, number, tail
            number, state = number + _value(*runs[3:], state), _value(*runs[:3], state)
            tail = (tail + own)[-overlap:] if overlap else ""

    def cut(key, rows):
        *_, state, number, tail = next(rows)
        held, begun = [], False
        for *_, text, _, _, _ in rows:
            state, shut = _add(state, len(text), size, overlap)
            if shut:
                yield (*key, number, "".join(held), begun)
                number, held, begun = number + 1, [tail], True
            held.append(text + "\n")
            tail = (tail + text + "\n")[-overlap:] if overlap else ""
        yield (*key, number, "".join(held), False)

    lengths = paragraphs.select(
        "key", "piece", "place", F.length("text").alias("n"), F.right("text", F.lit(overlap)).alias("tail")
    )
    runs = [f"{name}_{part}" for name in ("ends", "closed") for part in ("begins", "first", "rise")]
    tables = _each(
        lengths, ["key", "piece"], ["place"], table,
        f"key {kind}, piece long, {', '.join(f'{r} array<int>' for r in runs)}, tail string",
    )
    # A row per piece; no text but the tails.
    states = _each(tables, ["key"], ["piece"], walk, f"key {kind}, piece long, open long, number long, before string")
    # What is known of a piece comes before its paragraphs, so no join is needed.
    nothing = F.lit(None)
    known = states.select("key", "piece", F.lit(0).alias("_rank"), nothing.cast("long").alias("place"),
                          nothing.cast("string").alias("text"), "open", "number", "before")
    own = paragraphs.select("key", "piece", F.lit(1).alias("_rank"), "place", "text", nothing.cast("long").alias("open"),
                            nothing.cast("long").alias("number"), nothing.cast("string").alias("before"))
    return _each(
        known.unionByName(own), ["key", "piece"], ["_rank", "place"], cut,
        f"key {kind}, piece long, number long, text string, whole boolean",
    )
