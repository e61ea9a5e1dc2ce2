"""Periodic runs of words: tiles per octave of periods, boundary Z-values, stitched intervals.

A run is a stretch of words with smallest period q and a length of at least
``max(SHORTEST, 2 * q)`` that no neighbouring word extends. Periods are taken octave by octave: those
from P up to 2P belong together, and every run of such a period holds a boundary, a multiple of P,
among the words that are equal to the word q further on. A tile is the text around a boundary, as far as
its octave can see. For each period q of the octave, the Z-values at the boundary say for how many
words, forwards and backwards, the text agrees with itself moved by q; up to 4P words of each, so tiles
overlap and long runs come in several intervals. An interval that is long enough for a run becomes a
fragment (document, period, from, to); one whose words have a shorter period belongs to that one.

Fragments are shuffled by document and period, and those that touch are one run. What touches within a
task is joined before it is shuffled, so a text of one repeated word sends a row. Tiles of
documents with up to ``whole`` words are solved where the document is read, those of longer
ones are dealt out over tasks. Only documents with a fragment are read again.

Words are numbered exactly; longer stretches are compared by 64-bit names built by doubling, so
two different stretches look equal with a chance of about 2**-64 a comparison. The names take
8 * log2(n) bytes a word while a tile is solved.

Defined cases: a null or empty text has no words and no runs; a text shorter than ``SHORTEST`` has
none; every row counts by itself, however often its key occurs, and a null key is kept; runs are
ordered by start, then period; an empty table gives no rows; other columns of the input are not
looked at, whatever their names.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from prefdata.llm.common import chain, finish, map_batches, store, text_bytes

SHORTEST = 12
WHOLE = 1 << 16  # words of a document whose tiles stay in one task
CHUNK = 1 << 18  # words that are solved at once, about
AT_ONCE = 4 << 20  # bytes of text that are split into words at once
FIRST = 2  # the first group has the periods below 8; group g > 2 those from 2**g to 2**(g+1)

_RUN = "struct<start:long,length:long,period:long>"


class _Numbers(dict):
    """A number for each word, in order of arrival."""

    def __missing__(self, word: bytes) -> int:
        value = self[word] = len(self)
        return value


class _Names:
    """``names[k][i]`` is a name of the 2**k words from i on."""

    def __init__(self, words: np.ndarray):
        self.n = len(words)
        self.levels = [finish(words.astype(np.int64).view(np.uint64) + np.uint64(1))]

    def __getitem__(self, k: int) -> np.ndarray:
        while len(self.levels) <= k:
            last, half = self.levels[-1], 1 << (len(self.levels) - 1)
            self.levels.append(finish(chain(last[: max(0, len(last) - half)], last[half:])))
        return self.levels[k]

    def same(self, k: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Whether the 2**k words from a and from b on exist and are equal."""
        level = self[k]
        if not len(level):
            return np.zeros(len(a), bool)
        last = len(level) - 1
        inside = (np.minimum(a, b) >= 0) & (np.maximum(a, b) <= last)
        return inside & (level[np.clip(a, 0, last)] == level[np.clip(b, 0, last)])

    def ahead(self, a: np.ndarray, b: np.ndarray, top: int) -> np.ndarray:
        """How many words agree from a and b on; 2**(top + 1) - 1 at most."""
        got = np.zeros(len(a), np.int64)
        for k in range(top, -1, -1):
            got += self.same(k, a + got, b + got).astype(np.int64) << k
        return got

    def behind(self, a: np.ndarray, b: np.ndarray, top: int) -> np.ndarray:
        """How many words agree before a and b; 2**(top + 1) - 1 at most."""
        got = np.zeros(len(a), np.int64)
        for k in range(top, -1, -1):
            step = got + (1 << k)
            got += self.same(k, a - step, b - step).astype(np.int64) << k
        return got

    def equal(self, a: np.ndarray, b: np.ndarray, length: np.ndarray) -> np.ndarray:
        """Whether ``length`` words (1 at least) from a and b on are equal."""
        out = np.zeros(len(a), bool)
        levels = np.frexp(length.astype(np.float64))[1] - 1
        for k in np.unique(levels):
            own = np.flatnonzero(levels == k)
            rest = length[own] - (1 << int(k))
            out[own] = self.same(int(k), a[own], b[own]) & self.same(int(k), a[own] + rest, b[own] + rest)
        return out


def _meetings(names: np.ndarray, step: int) -> tuple[np.ndarray, np.ndarray]:
    """(i, q), i a multiple of ``step``: the names at i and i + q are equal, q from step to 2 * step."""
    blocks = -(-len(names) // step)
    # What lies beyond the end gets names of its own.
    beyond = finish(np.arange(1, (blocks + 1) * step - len(names) + 1, dtype=np.uint64) << np.uint64(40))
    padded = np.concatenate([names, beyond])
    heads = padded[: blocks * step : step]
    block, place = np.nonzero(padded[step:].reshape(blocks, step) == heads[:, None])
    return block * step, place + step


def _close(names: np.ndarray, step: int) -> tuple[np.ndarray, np.ndarray]:
    """The same for q below 2 * step."""
    at, found = np.arange(0, len(names), step), []
    for q in range(1, 2 * step):
        some = at[at + q < len(names)]
        found.append((some := some[names[some] == names[some + q]], np.full(len(some), q)))
    return tuple(np.concatenate(c) for c in zip(*found))


def _candidates(names: _Names, group: int) -> tuple[np.ndarray, np.ndarray]:
    """(boundary, period) pairs where half an octave agrees on one side of the boundary.

    A run agrees with itself for at least 6 words (first group) or P words around one of its
    boundaries, so for half of these at least on one side.
    """
    step, half = 1 << group, 1 << (group - 1)
    level, codes = names[group - 1], []
    for back in (0, half):
        own = level[back:]
        if len(own):
            at, q = _close(own, step) if group == FIRST else _meetings(own, step)
            codes.append((at + 2 * back) * (2 * step) + q)
    found = np.unique(np.concatenate(codes or [np.zeros(0, np.int64)]))
    return found // (2 * step), found % (2 * step)


def _smallest_factors(n: int) -> np.ndarray:
    """The smallest prime factor of each number below n."""
    least = np.arange(n)
    for p in range(2, int(n**0.5) + 1):
        if least[p] == p:
            least[p * p :: p] = np.minimum(least[p * p :: p], p)
    return least


def _primitive(names: _Names, start: np.ndarray, period: np.ndarray) -> np.ndarray:
    """Whether the first ``period`` words from ``start`` on are no shorter stretch repeated."""
    good = np.ones(len(start), bool)
    if not len(start):
        return good
    least, rest = _smallest_factors(int(period.max()) + 1), period.copy()
    while (own := np.flatnonzero(good & (rest > 1))).size:
        prime = least[rest[own]]
        shorter = period[own] // prime
        good[own] = ~names.equal(start[own], start[own] + shorter, period[own] - shorter)
        while (more := rest[own] % prime == 0).any():
            rest[own] = np.where(more, rest[own] // prime, rest[own])
    return good


def fragments(words: np.ndarray, low: int, high: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(period, from, to) of the groups low..high: word i is word i + period for from <= i < to.

    Touching intervals of a period are one. ``words`` are numbers; those of several texts
    can be put together with a number of its own after each text.
    """
    names, parts = _Names(words), []
    for group in range(low, high + 1):
        if 1 << group >= len(words):
            break
        at, q = _candidates(names, group)
        ahead, behind = names.ahead(at, at + q, group + 1), names.behind(at, at + q, group + 1)
        long = np.flatnonzero(ahead + behind >= np.maximum(q, SHORTEST - q))
        start, stop, q = (at - behind)[long], (at + ahead)[long], q[long]
        own = _primitive(names, start, q)
        parts.append(joined(q[own], start[own], stop[own]))
    empty = np.zeros(0, np.int64)
    return tuple(np.concatenate([p[c] for p in parts] or [empty]) for c in range(3))


def joined(period: np.ndarray, start: np.ndarray, stop: np.ndarray):
    """The same with touching intervals of a period as one."""
    order = np.lexsort((start, period))
    period, start, stop = period[order], start[order], stop[order]
    if not len(order):
        return period, start, stop
    base = period * (int(stop.max()) + 2)  # keeps periods apart in one running maximum
    reach = np.maximum.accumulate(stop + base)
    first = np.ones(len(order), bool)
    first[1:] = start[1:] + base[1:] > reach[:-1]
    last = np.append(np.flatnonzero(first)[1:], len(order)) - 1
    return period[first], start[first], reach[last] - base[first]


def _groups_of(n: int) -> int:
    """The last group whose periods can have a run in n words."""
    return max(FIRST, (n // 2).bit_length() - 1)


def _solve_texts(texts: list[np.ndarray]) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Fragments of each text; all are solved at once."""
    sizes = np.array([len(t) + 1 for t in texts])
    ends = np.cumsum(sizes)
    whole = np.full(int(ends[-1]), -1, np.int64)
    for i, (end, text) in enumerate(zip(ends, texts)):
        whole[end - 1 - len(text) : end - 1] = text
        whole[end - 1] = -2 - i
    period, start, stop = fragments(whole, FIRST, _groups_of(int(sizes.max()) - 1))
    owner = np.searchsorted(ends, start, "right")
    order = np.argsort(owner, kind="stable")
    cuts = np.searchsorted(owner[order], np.arange(len(texts) + 1))
    out = []
    for i in range(len(texts)):
        own = order[cuts[i] : cuts[i + 1]]
        first = ends[i] - sizes[i]
        out.append((period[own], start[own] - first, stop[own] - first))
    return out


def _tiles(numbers: np.ndarray, whole: int) -> Iterator[tuple[int, int, int, np.ndarray]]:
    """(low, high, first word, words) of all tiles of a long document.

    Tiles of the low groups are cut together; an octave of long periods has longer tiles. A tile
    reaches 4P words before its first boundary and 6P words after its last.
    """
    last, low = _groups_of(len(numbers)), FIRST
    high = max(FIRST, min(last, whole.bit_length() - 5))
    while low <= last:
        step = max(whole, 16 << high)
        for at in range(0, len(numbers), step):
            first = max(0, at - (4 << high))
            yield low, high, first, numbers[first : at + step + (6 << high)]
        low = high = high + 1


_READ = (
    "row long, words binary, n_words long, period array<long>, start array<long>, stop array<long>, "
    "low int, high int, first long, tile binary"
)
_NO_TILE = {"low": None, "high": None, "first": None, "tile": None}


def _lists(rows: list[np.ndarray]) -> pa.Array:
    sizes = np.cumsum([0] + [len(r) for r in rows])
    values = np.concatenate(rows) if rows else np.zeros(0, np.int64)
    return pa.ListArray.from_arrays(pa.array(sizes, pa.int32()), pa.array(values, pa.int64()))


def _parts(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """Runs of rows with ``AT_ONCE`` bytes of text, so that few words are held as objects."""
    sizes, at = np.cumsum(pc.binary_length(batch.column("text")).to_numpy(zero_copy_only=False)), 0
    while at < len(batch):
        base = sizes[at - 1] if at else 0
        end = max(at + 1, int(np.searchsorted(sizes, base + AT_ONCE, "right")))
        yield batch.slice(at, end - at)
        at = end


def _read(prepare: Callable | None, whole: int, key_type: str):
    """Documents with the fragments of the short ones, and tiles of the long ones."""

    def run(batches):
        row = TaskContext.get().partitionId() << 33
        for batch in (part for batch in batches for part in _parts(batch)):
            texts, keys = batch.column("text").to_pylist(), batch.column("key").to_pylist()
            words = [t.split() for t in texts]
            if prepare is not None:
                words = [prepare(w, k) for w, k in zip(words, keys)]
            found: list = [None] * len(words)
            short = [i for i in range(len(words)) if len(words[i]) <= whole]
            short.sort(key=lambda i: len(words[i]))  # equal lengths have the same octaves
            own, held = [], 0
            numbers = _Numbers()
            for place, i in enumerate(short):
                own.append(i)
                held += len(words[i])
                if held >= CHUNK or place == len(short) - 1:
                    coded = [np.fromiter(map(numbers.__getitem__, words[d]), np.int64, len(words[d])) for d in own]
                    for d, pieces in zip(own, _solve_texts(coded)):
                        found[d] = pieces
                    own, held, numbers = [], 0, _Numbers()
            none = (np.zeros(0, np.int64),) * 3
            pieces = [none if f is None else f for f in found]
            n = len(words)
            yield {
                "key": batch.column("key"),
                "row": np.arange(row, row + n),
                "words": [b" ".join(w) for w in words],
                "n_words": [len(w) for w in words],
                "period": _lists([p[0] for p in pieces]),
                "start": _lists([p[1] for p in pieces]),
                "stop": _lists([p[2] for p in pieces]),
                **{name: [None] * n for name in _NO_TILE},
            }
            for i in range(n):
                if found[i] is not None:
                    continue
                numbers = _Numbers()
                coded = np.fromiter(map(numbers.__getitem__, words[i]), np.int64, len(words[i]))
                for low, high, first, tile in _tiles(coded, whole):
                    yield {
                        "key": [None], "row": [row + i], "words": [None], "n_words": [None],
                        "period": [[]], "start": [[]], "stop": [[]],
                        "low": [low], "high": [high], "first": [first],
                        "tile": [tile.astype("<u4").tobytes()],
                    }
            row += n

    return run, f"key {key_type}, {_READ}"


def _solve_tiles(batches):
    for batch in batches:
        cells = [batch.column(c).to_pylist() for c in ("row", "low", "high", "first", "tile")]
        for row, low, high, first, tile in zip(*cells):
            period, start, stop = fragments(np.frombuffer(tile, "<u4").astype(np.int64), low, high)
            yield {
                "row": np.full(len(period), row), "period": period,
                "start": start + first, "stop": stop + first,
            }


def stitched(pieces: DataFrame) -> DataFrame:
    """(row, runs) from fragments (row, period, start, stop): what touches is one run."""
    place = Window.partitionBy("row", "period").orderBy("start", "stop")
    before = F.max("stop").over(place.rowsBetween(Window.unboundedPreceding, -1))
    fresh = F.when(before.isNull() | (F.col("start") > before), 1).otherwise(0)
    islands = pieces.withColumn("_fresh", fresh).withColumn("_island", F.sum("_fresh").over(place))
    one = islands.groupBy("row", "period", "_island").agg(
        F.min("start").alias("start"), F.max("stop").alias("stop")
    )
    run = F.struct("start", (F.col("stop") - F.col("start") + F.col("period")).alias("length"), "period")
    return one.groupBy("row").agg(F.array_sort(F.collect_list(run)).alias("runs"))


def _collapse(batches):
    for batch in batches:
        out = []
        for text, runs in zip(batch.column("words").to_pylist(), batch.column("runs").to_pylist()):
            words = text.split(b" ") if text else []
            turns = np.zeros(len(words) + 1, np.int64)
            for run in runs:
                turns[run["start"] + run["period"]] += 1
                turns[run["start"] + run["length"]] -= 1
            out.append(b" ".join(words[i] for i in np.flatnonzero(np.cumsum(turns[:-1]) == 0)))
        keep = {c: batch.column(c) for c in ("key", "n_words", "runs")}
        yield keep | {"collapsed": out}


def periodic_runs(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    prepare: Callable[[list[bytes], object], list[bytes]] | None = None,
    collapsed: Callable[[Column], Column] = lambda words: words.cast("string"),
    whole: int = WHOLE,
) -> DataFrame:
    """(key, n_words, runs, collapsed) of every document.

    ``runs`` are (start, length, period) in words; ``collapsed`` is the text without the words that
    any run holds after its first period, joined by one space. ``prepare`` changes a document's words
    before, and ``collapsed`` says what is wanted of the text (UTF-8), a digest for example.
    ``whole``, a power of two from 64 up: words of a document whose tiles stay together.
    """
    if whole < 64 or whole & (whole - 1):
        raise ValueError("whole must be a power of two, 64 at least")
    source = docs.select(F.col(key).alias("key"), text_bytes(text).alias("text"))
    key_type = source.schema["key"].dataType.simpleString()
    run, schema = _read(prepare, whole, key_type)
    is_tile, loose = F.col("tile").isNotNull(), F.size("period") > 0
    solved = F.when(~is_tile & ~loose & (F.col("n_words") <= whole), collapsed(F.col("words")))
    open_ = ~is_tile & (loose | (F.col("n_words") > whole))
    read = store(
        map_batches(source, run, schema).select(
            "key", "row", "n_words", solved.alias("collapsed"),
            F.when(open_, F.col("words")).alias("words"),
            "period", "start", "stop", "low", "high", "first", "tile",
        )
    )
    short = read.filter(loose).select(
        "row", F.explode(F.arrays_zip("period", "start", "stop")).alias("_p")
    ).select("row", "_p.period", "_p.start", "_p.stop")
    dealt = read.filter(is_tile).select("row", "low", "high", "first", "tile")
    far = map_batches(
        dealt.repartition("row", "low", "first"), _solve_tiles,
        "row long, period long, start long, stop long",
    )
    runs = stitched(short.union(far))
    no_runs = F.from_json(F.lit("[]"), f"array<{_RUN}>")
    again = read.filter(F.col("words").isNotNull()).select("key", "row", "n_words", "words")
    rest = map_batches(
        again.join(runs, "row", "left").select(
            "key", "n_words", "words", F.coalesce(F.col("runs").cast(f"array<{_RUN}>"), no_runs).alias("runs")
        ),
        _collapse,
        f"key {key_type}, n_words long, runs array<{_RUN}>, collapsed binary",
    ).select("key", "n_words", "runs", collapsed(F.col("collapsed")).alias("collapsed"))
    done = read.filter(~is_tile & F.col("words").isNull()).select(
        "key", "n_words", no_runs.alias("runs"), "collapsed"
    )
    return done.unionByName(rest).withColumnRenamed("key", key)


def cycled(words: list[bytes], key) -> list[bytes]:
    """One document in ten, by the crc32 of its key, goes round in a circle from some word on.

    A null key counts as the empty text.
    """
    h = zlib.crc32(b"" if key is None else str(key).encode())
    n = len(words)
    if h % 10 or not n:
        return words
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    circle = words[a : a + p]
    return words[:a] + (circle * (-(-(n - a) // p)))[: n - a]


def op13_periodic_runs(docs: DataFrame) -> DataFrame:
    """One row per document: its longest run, and digests of all runs and of the collapsed text."""
    found = periodic_runs(docs, prepare=cycled, collapsed=lambda words: F.sha2(words, 256))
    line = F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    lines = F.concat(F.array_join(line, "\n"), F.when(F.size("runs") > 0, F.lit("\n")).otherwise(F.lit("")))
    best = F.array_min(
        F.transform(
            "runs",
            lambda r: F.struct((-r["length"]).alias("down"), r["start"].alias("start"), r["period"].alias("period")),
        )
    )
    return found.withColumn("_best", best).select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        F.col("_best.start").alias("start"),
        (-F.col("_best.down")).alias("length"),
        F.col("_best.period").alias("period"),
        F.expr("(-_best.down * 1000) div _best.period").alias("exponent_milli"),
        F.sha2(lines, 256).alias("runs_sha256"),
        F.col("collapsed").alias("collapsed_sha256"),
        "n_words",
    )
