"""Near-duplicate classes by a Jaccard join over word shingles, with a count-vector R-tree.

A document's set holds the hashes of its distinct 4-word shingles. Tokens of the set are hashed
into ``GROUPS`` groups; the counts per group are a point. Two sets share at most the sum
of the smaller coordinates of their points, which an R-tree over points turns into a search: a
node is opened only if the query's point and the node's upper corner allow the overlap that
the wanted similarity needs. Surviving pairs are verified on the sets.

An R-tree over all documents of a corpus would fit no task, and in so many dimensions it would open
most nodes. So trees are built per block, and blocks lose no pair: similar sets share one of their
rarest shingles (prefix filter), hence documents meet in the block of a rare shingle. How rare
a shingle is comes from a sketch of fixed size over the whole corpus; any order would give
the same result. Candidate pairs that pass the trees' bounds join documents to families;
families are verified block by block with exact overlaps of all their pairs. Groups larger than
a block are dealt into parts, and parts meet pairwise. Copies with equal sets are one point.

No pair is ever written: blocks put out a forest of their links and counts of links.

Defined cases: a null text and one without words have the empty set, are linked with nothing and are
their own component; a text with fewer than four words has one shingle, the whole; rows with
equal doc_id are one document; a row with a null doc_id takes the component of the rows with an
equal set, or null, and makes no further links; an empty table gives no rows; other columns
are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from prefdata.llm.common import (
    WordHashes,
    chain,
    components,
    finish,
    forget,
    map_batches,
    parts_for,
    store,
    text_bytes,
)

WORDS = 4
SIMILARITY = 85  # per cent
GROUPS = 256
SKETCH_BITS = 20
SLICES = 64  # of the sketch
SHARD_ROWS = 1_000_000  # shingles of prefixes in a shard, about
BLOCK_ROWS = 1024  # documents of a rare shingle in a part
BLOCK_SHINGLES = 400_000  # shingles of a family in a part, about
LEAF = 16
FULL = 255


def runs_of(text: bytes, hashes: WordHashes, size: int = WORDS) -> np.ndarray:
    """Hash of each run of ``size`` words; a shorter text is one run."""
    words = text.lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    h = hashes.of(words)
    size = min(size, len(h))
    run = h[: len(h) - size + 1]
    for k in range(1, size):
        run = chain(run, h[k : len(h) - size + 1 + k])
    return run


def shingles(text: bytes, hashes: WordHashes, size: int = WORDS) -> np.ndarray:
    """Sorted hashes of the distinct shingles of a text."""
    return np.unique(finish(runs_of(text, hashes, size)))


def needed(a, b, similarity: int = SIMILARITY):
    """Shingles that sets of sizes a and b have to share: 100 I >= s (a + b - I)."""
    return -(-similarity * (a + b) // (100 + similarity))


def _cells(hashes: np.ndarray) -> np.ndarray:
    return (hashes >> np.uint64(64 - SKETCH_BITS)).astype(np.int64)


def sketch_of(docs: DataFrame, size: int) -> np.ndarray:
    """Occurrences per cell of shingles, over the whole corpus. 2 ** SKETCH_BITS numbers."""

    def count(batches):
        hashes, cells = WordHashes(), np.zeros(1 << SKETCH_BITS, np.int64)
        for batch in batches:
            found = [runs_of(t, hashes, size) for t in batch.column("text").to_pylist()]
            if found:
                cells += np.bincount(_cells(finish(np.concatenate(found))), minlength=len(cells))
        salt = int(cells[:64].sum()) % 16
        yield {
            "slice": list(range(SLICES)),
            "salt": [salt] * SLICES,
            "counts": [part.astype("<i8").tobytes() for part in np.split(cells, SLICES)],
        }

    def add(batches):
        sums: dict[tuple, np.ndarray] = {}
        for batch in batches:
            for slice_no, salt, counts in zip(*(batch.column(c).to_pylist() for c in ("slice", "salt", "counts"))):
                own = sums.setdefault((slice_no, salt), np.zeros((1 << SKETCH_BITS) // SLICES, np.int64))
                own += np.frombuffer(counts, "<i8")
        if sums:
            yield {
                "slice": [k[0] for k in sums],
                "salt": [k[1] for k in sums],
                "counts": [v.tobytes() for v in sums.values()],
            }

    schema = "slice int, salt int, counts binary"
    parts = map_batches(docs.select(text_bytes().alias("text")), count, schema)
    # Two rounds of sums, so that no task reads the counts of all tasks.
    parts = map_batches(parts.repartition(SLICES, "slice", "salt"), add, schema).withColumn("salt", F.lit(0))
    whole = np.zeros(1 << SKETCH_BITS, np.int64)
    for row in map_batches(parts.repartition(SLICES, "slice"), add, schema).collect():
        step = len(whole) // SLICES
        whole[row["slice"] * step : (row["slice"] + 1) * step] += np.frombuffer(row["counts"], "<i8")
    return whole


def point(hashes: np.ndarray) -> np.ndarray:
    """Shingles per group, a byte each. The group is taken from other bits than the sketch's cell.

    A set with more than 254 shingles in a group (tens of thousands in all) has the point
    ``FULL`` everywhere, which every bound lets pass.
    """
    counts = np.bincount((hashes % np.uint64(GROUPS)).astype(np.int64), minlength=GROUPS)
    return np.full(GROUPS, FULL, np.uint8) if counts.max() >= FULL else counts.astype(np.uint8)


def bounds(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Shingles that points allow at most: the sum of the smaller coordinates."""
    least = np.minimum(a, b).sum(axis=-1, dtype=np.int64)
    return np.where((a[..., 0] == FULL) | (b[..., 0] == FULL), 1 << 40, least)


def rare_prefix(hashes: np.ndarray, sketch: np.ndarray, similarity: int) -> np.ndarray:
    """The rarest shingles, so many that a similar set must share one of them."""
    keep = len(hashes) - -(-similarity * len(hashes) // 100) + 1
    return hashes[np.lexsort((hashes, sketch[_cells(hashes)]))[:keep]]


def _sets(docs: DataFrame, sketch: np.ndarray, size: int, similarity: int) -> DataFrame:
    """(doc_id, n_shingles, print, point, rare) of every row."""
    sent = docs.sparkSession.sparkContext.broadcast(sketch)

    def run(batches):
        hashes = WordHashes()
        for batch in batches:
            sets = [shingles(t, hashes, size) for t in batch.column("text").to_pylist()]
            yield {
                "doc_id": batch.column("doc_id"),
                "n_shingles": [len(s) for s in sets],
                "print": [xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None for s in sets],
                "point": [point(s).tobytes() for s in sets],
                "rare": [rare_prefix(s, sent.value, similarity).tobytes() if len(s) else b"" for s in sets],
            }

    return map_batches(
        docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_bytes().alias("text")),
        run,
        "doc_id long, n_shingles long, print binary, point binary, rare binary",
    )


def _meetings(leaders: DataFrame, n_rare: int) -> DataFrame:
    """(key, part_a, part_b, doc_id): documents that meet as they share a rare shingle.

    Shingles travel as packed arrays, a row per batch and shard that it has keys for. A shard holds
    about ``SHARD_ROWS``.
    """
    shards = parts_for(n_rare, SHARD_ROWS)

    def deal(batches):
        for batch in batches:
            rare = batch.column("rare").to_pylist()
            sizes = [len(r) // 8 for r in rare]
            keys = np.frombuffer(b"".join(rare), np.uint64)
            ids = np.repeat(batch.column("doc_id").to_numpy(zero_copy_only=False), sizes)
            shard = ((keys >> np.uint64(8)) % np.uint64(shards)).astype(np.int64)
            order = np.argsort(shard, kind="stable")
            edges = np.searchsorted(shard[order], np.arange(shards + 1))
            asked = np.flatnonzero(np.diff(edges))  # no row for a shard without keys
            own = [order[edges[i] : edges[i + 1]] for i in asked]
            yield {
                "shard": asked.tolist(),
                "keys": [keys[o].tobytes() for o in own],
                "ids": [ids[o].astype("<i8").tobytes() for o in own],
            }

    def meet(rows: pd.DataFrame) -> pd.DataFrame:
        keys = np.frombuffer(b"".join(rows["keys"]), np.uint64)
        ids = np.frombuffer(b"".join(rows["ids"]), "<i8")
        order = np.lexsort((ids, keys))
        keys, ids = keys[order], ids[order]
        start = np.flatnonzero(np.append(True, keys[1:] != keys[:-1])) if len(keys) else np.zeros(0, int)
        size = np.diff(np.append(start, len(keys)))
        many = np.repeat(size, size) > 1
        place = np.arange(len(keys)) - np.repeat(start, size)
        parts = -(-np.repeat(size, size)[many] // BLOCK_ROWS)
        return _pairwise(
            pd.DataFrame(
                {"key": keys[many].view(np.int64), "doc_id": ids[many], "part": place[many] % parts, "parts": parts}
            )
        )

    dealt = map_batches(leaders.select("doc_id", "rare"), deal, "shard int, keys binary, ids binary")
    return dealt.groupBy("shard").applyInPandas(meet, "key long, part_a int, part_b int, doc_id long")


def _pairwise(rows: pd.DataFrame) -> pd.DataFrame:
    """Each row once for every part that its part has to meet."""
    rows = rows.loc[rows.index.repeat(rows["parts"])]
    other = rows.groupby(level=0).cumcount() if len(rows) else rows["part"]
    rows = rows.assign(part_a=np.minimum(rows["part"], other), part_b=np.maximum(rows["part"], other))
    return rows[["key", "part_a", "part_b", "doc_id"]]


class CountTree:
    """R-tree over count vectors, packed by halving along the widest coordinate."""

    def __init__(self, points: np.ndarray, sizes: np.ndarray):
        self.points, self.sizes = points, sizes
        self.root = self._pack(np.arange(len(points)))

    def _pack(self, own: np.ndarray):
        """(upper corner, smallest and largest set, children or rows)"""
        points, sizes = self.points[own], self.sizes[own]
        box = points.max(axis=0), sizes.min(), sizes.max()
        if len(own) <= LEAF:
            return *box, None, own
        widest = np.argmax(box[0] - points.min(axis=0))
        order = own[np.argsort(points[:, widest], kind="stable")]
        half = len(own) // 2
        return *box, (self._pack(order[:half]), self._pack(order[half:])), None

    def search(self, queries: np.ndarray, similarity: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Pairs (query, row) that may be similar; all queries walk down together."""
        todo = [(self.root, queries)]
        while todo:
            (corner, low, high, children, own), asking = todo.pop()
            sizes = self.sizes[asking]
            fits = (100 * high >= similarity * sizes) & (100 * sizes >= similarity * low)
            asking, sizes = asking[fits], sizes[fits]
            # The smallest set that is still similar needs the smallest overlap.
            least = needed(sizes, np.maximum(low, -(-similarity * sizes // 100)), similarity)
            asking = asking[bounds(self.points[asking], corner) >= least]
            if not len(asking):
                continue
            if children:
                todo += [(child, asking) for child in children]
                continue
            bound = bounds(self.points[asking][:, None, :], self.points[own][None, :, :])
            a, b = self.sizes[asking][:, None], self.sizes[own][None, :]
            alike = (bound >= needed(a, b, similarity)) & (asking[:, None] != own[None, :])
            alike &= 100 * np.minimum(a, b) >= similarity * np.maximum(a, b)
            q, r = np.nonzero(alike)
            yield asking[q], own[r]


def _alike(points, sizes, start, similarity) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of rows within a run that may be similar. A run that fits a leaf needs no tree."""
    end = np.append(start[1:], len(sizes))
    run_end = np.repeat(end, end - start)
    small = np.repeat(end - start <= LEAF, end - start)
    yield np.zeros(0, np.int64), np.zeros(0, np.int64)
    for gap in range(1, LEAF):
        a = np.flatnonzero(small & (np.arange(len(sizes)) + gap < run_end))
        b = a + gap
        near = 100 * np.minimum(sizes[a], sizes[b]) >= similarity * np.maximum(sizes[a], sizes[b])
        a, b = a[near], b[near]
        bound = bounds(points[a], points[b])
        yield tuple(side[bound >= needed(sizes[a], sizes[b], similarity)] for side in (a, b))
    for at, to in zip(start, end):
        if to - at > LEAF:
            tree = CountTree(points[at:to], sizes[at:to])
            for a, b in tree.search(np.arange(to - at), similarity):
                yield a + at, b + at


def roots(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """For each of n nodes the smallest node that it is joined with."""
    label = np.arange(n)
    while True:
        before = label.copy()
        np.minimum.at(label, a, label[b])
        np.minimum.at(label, b, label[a])
        label = label[label]
        if (label == before).all():
            return label


def _whole_runs(batches, keys: tuple[str, ...]) -> Iterator[tuple[pa.Table, np.ndarray]]:
    """Rows of sorted batches with the starts of the runs of equal keys; no run is divided."""
    held = None
    for batch in batches:
        rows = pa.Table.from_batches([batch])
        rows = rows if held is None else pa.concat_tables([held, rows])
        if not rows.num_rows:
            continue
        start = _starts(rows, keys)
        last = int(start[-1])
        if last:
            yield rows.slice(0, last), start[:-1]
        held = rows.slice(last)
    if held is not None and held.num_rows:
        yield held, np.zeros(1, np.int64)


def _starts(rows: pa.Table, keys: tuple[str, ...]) -> np.ndarray:
    new = np.zeros(rows.num_rows, bool)
    new[0] = True
    for key in keys:
        values = rows.column(key).to_numpy()
        new[1:] |= values[1:] != values[:-1]
    return np.flatnonzero(new)


def _sorted_by(df: DataFrame, keys: list[str]) -> DataFrame:
    return df.repartition(*keys).sortWithinPartitions(*keys)


def _put_out(found: Iterator[tuple], names: tuple[str, ...], at_once: int = 20_000) -> Iterator[dict]:
    held = []
    for columns in found:
        held.append(columns)
        if sum(len(c[0]) for c in held) >= at_once:
            yield {n: np.concatenate(c) for n, c in zip(names, zip(*held))}
            held = []
    if held:
        yield {n: np.concatenate(c) for n, c in zip(names, zip(*held))}


def _candidate_edges(meetings: DataFrame, leaders: DataFrame, similarity: int) -> DataFrame:
    """(a, b): a forest of the pairs of each block that pass the bounds of its tree."""

    def search(batches):
        def each():
            for rows, start in _whole_runs(batches, ("key", "part_a", "part_b")):
                points = np.frombuffer(b"".join(rows.column("point").to_pylist()), np.uint8).reshape(-1, GROUPS)
                sizes, ids = rows.column("n_shingles").to_numpy(), rows.column("doc_id").to_numpy()
                pairs = list(_alike(points, sizes, start, similarity))
                label = roots(len(ids), *(np.concatenate(side) for side in zip(*pairs)))
                joined = np.flatnonzero(ids != ids[label])
                yield ids[joined], ids[label[joined]]

        yield from _put_out(each(), ("a", "b"))

    met = meetings.join(leaders.select("doc_id", "n_shingles", "point"), "doc_id")
    return map_batches(_sorted_by(met, ["key", "part_a", "part_b"]), search, "a long, b long")


def overlaps(a: list[np.ndarray], b: list[np.ndarray], columns: int = 4096) -> np.ndarray:
    """Shingles that each set of ``a`` shares with each of ``b``: a product of 0/1 matrices."""
    common = np.intersect1d(np.concatenate(a), np.concatenate(b)) if a and b else np.zeros(0, np.uint64)
    found = np.zeros((len(a), len(b)), np.float32)
    for at in range(0, len(common), columns):
        wanted = common[at : at + columns]
        left, right = _members(a, wanted), _members(b, wanted)
        found += left @ right.T
    return found.astype(np.int64)


def _members(sets: list[np.ndarray], wanted: np.ndarray) -> np.ndarray:
    here = np.zeros((len(sets), len(wanted)), np.float32)
    for row, own in zip(here, sets):
        own = own[np.searchsorted(own, wanted[0]) : np.searchsorted(own, wanted[-1], "right")]
        at = np.searchsorted(wanted, own)
        row[at[wanted[at] == own]] = 1
    return here


def _links(docs: DataFrame, families: DataFrame, size: int, similarity: int) -> DataFrame:
    """(doc_id, root, links): per block of a family each document's root and number of links.

    ``families``: (doc_id, family, copies, n_shingles).
    """
    parts = families.groupBy("family").agg(F.sum("n_shingles").alias("_n"), F.count(F.lit(1)).alias("_m"))
    parts = parts.select(
        "family", F.ceil(F.greatest(F.col("_n") / BLOCK_SHINGLES, F.col("_m") / BLOCK_ROWS)).cast("int").alias("parts")
    )
    dealt = (
        families.join(parts, "family")
        .withColumn("part", F.pmod(F.xxhash64("doc_id"), "parts").cast("int"))
        .select("doc_id", "family", "copies", "part", "parts")
    )

    def sets(batches):
        hashes = WordHashes()
        for batch in batches:
            found = {c: batch.column(c) for c in ("doc_id", "family", "copies", "part", "parts")}
            texts = batch.column("text").to_pylist()
            yield found | {"shingles": [shingles(t, hashes, size).tobytes() for t in texts]}

    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_bytes().alias("text"))
    member = map_batches(
        texts.join(store(dealt), "doc_id"),
        sets,
        "doc_id long, family long, copies long, part int, parts int, shingles binary",
    )
    met = member.withColumn("_other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))).select(
        "family", F.least("part", "_other").alias("part_a"), F.greatest("part", "_other").alias("part_b"),
        "part", "doc_id", "copies", "shingles",
    )

    def verify(batches):
        def each():
            for rows, start in _whole_runs(batches, ("family", "part_a", "part_b")):
                names = ("doc_id", "copies", "part", "part_a", "part_b")
                ids, copies, part, part_a, part_b = (rows.column(c).to_numpy() for c in names)
                packed = rows.column("shingles").to_pylist()
                for at, to in zip(start, np.append(start[1:], len(ids))):
                    once = list({(i, s): k for k, (i, s) in enumerate(zip(ids[at:to], packed[at:to]), at)}.values())
                    a = [k for k in once if part[k] == part_a[k]]
                    b = [k for k in once if part[k] == part_b[k]]
                    if a and b:
                        yield _verified(ids, copies, packed, a, b, similarity)

        yield from _put_out(each(), ("doc_id", "root", "links"))

    return map_batches(
        _sorted_by(met, ["family", "part_a", "part_b"]), verify, "doc_id long, root long, links long"
    )


def _verified(ids, copies, packed, a: list[int], b: list[int], similarity: int):
    """(doc_id, root, links) of the rows a and b of one run: all links between the two sides."""
    sets = [[np.frombuffer(packed[k], np.uint64) for k in side] for side in (a, b)]
    sizes = [np.array([len(s) for s in side]) for side in sets]
    linked = overlaps(*sets) >= needed(sizes[0][:, None], sizes[1][None, :], similarity)
    linked &= ids[a][:, None] != ids[b][None, :]
    x, y = np.nonzero(linked)
    if a == b:
        own, left, right = ids[a], x, y
        links = linked @ copies[b]
    else:
        own, left, right = ids[a + b], x, y + len(a)
        links = np.concatenate([linked @ copies[b], copies[a] @ linked])
    return own, own[roots(len(own), left, right)], links.astype(np.int64)


def join(docs: DataFrame, size: int = WORDS, similarity: int = SIMILARITY) -> DataFrame:
    """(doc_id, n_shingles, component_id, n_links) of every row."""
    sketch = sketch_of(docs, size)
    sets = store(_sets(docs, sketch, size, similarity))
    classes = store(
        sets.filter("n_shingles > 0")
        .groupBy("print")
        .agg(F.min("doc_id").alias("leader"), F.countDistinct("doc_id").alias("copies"))
    )
    led = classes.filter("leader is not null").withColumnRenamed("print", "_print")
    leaders = store(
        sets.join(led, (sets["print"] == led["_print"]) & (sets["doc_id"] == led["leader"]))
        .select("doc_id", "n_shingles", "point", "rare", "copies")
        .dropDuplicates(["doc_id", "point", "rare"])
    )
    n_rare = leaders.agg(F.sum(F.length("rare") / 8)).first()[0] or 0
    meetings = store(_meetings(leaders, int(n_rare)))
    edges = store(_candidate_edges(meetings, leaders, similarity))
    forget(meetings)
    families = components(edges).withColumnRenamed("component", "family")
    asked = leaders.select("doc_id", "copies", "n_shingles").join(
        families, F.col("doc_id") == F.col("node")
    )
    links = store(_links(docs, store(asked.drop("node")), size, similarity))
    joined = components(links.select(F.col("doc_id").alias("a"), F.col("root").alias("b")))
    degrees = links.groupBy("doc_id").agg(F.sum("links").alias("links"))
    named = (
        classes.join(joined, classes["leader"] == joined["node"], "left")
        .join(degrees, classes["leader"] == degrees["doc_id"], "left")
        .select(
            F.col("print").alias("_print"),
            F.coalesce("component", "leader").alias("component_id"),
            (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
        )
    )
    return sets.join(named, sets["print"] == named["_print"], "left").select(
        "doc_id",
        "n_shingles",
        F.when(F.col("n_shingles") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"),
        F.greatest(F.coalesce("n_links", F.lit(0)), F.lit(0)).cast("long").alias("n_links"),
    )


def op3_jaccard_join(docs: DataFrame) -> DataFrame:
    return join(docs)


def keep_one(docs: DataFrame, size: int = WORDS, similarity: int = SIMILARITY) -> DataFrame:
    """One row of each component of near-duplicate rows, with the columns it had.

    Rows are told apart by a number of their own, so an id that is null or stands at several
    texts doesn't matter: each such row is judged by its own text. Of a component the row with the
    smallest doc_id stays (nulls last), then the one with the smallest hash of all its columns, so
    that a rerun keeps the same. Texts without words are near no other; all such rows stay.
    """
    numbered = store(
        docs.select(F.struct("*").alias("doc"), F.monotonically_increasing_id().alias("row"))
    )
    found = store(join(numbered.select(F.col("row").alias("doc_id"), "doc.text"), size, similarity))
    near = found.filter("n_links > 0").select(F.col("doc_id").alias("row"), "component_id")
    # Only rows with links are compared, by numbers; their texts stay where they are.
    keys = numbered.select(
        "row", F.col("doc.doc_id").isNull().alias("_null"), F.col("doc.doc_id").alias("_id"),
        F.xxhash64("doc").alias("_first"), F.xxhash64(F.lit(1), "doc").alias("_second"),
    )
    order = F.struct("_null", "_id", "_first", "_second", "row")
    best = near.join(keys, "row").groupBy("component_id").agg(F.min(order).alias("_best"))
    stays = best.select(F.col("_best.row").alias("row"))
    gone = near.select("row").join(stays, "row", "left_anti")
    return numbered.join(gone, "row", "left_anti").select("doc.*")
