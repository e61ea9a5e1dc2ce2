"""Approximate nearest neighbours by cosine: hierarchical k-means and best-bin-first search.

A tree of k-means centres is fitted on a bounded sample of distinct directions; every row is
then put into a leaf of it. A leaf that holds many more rows than the sample let expect is divided
again by a tree of its own, in the task that looks into it, so leaves stay small at any size. A query
walks a tree with a priority queue, always opening the node with the nearest centre, which puts the
leaves in the order in which they are worth a visit, and it stops where the queue's best centre is
farther from the query than the nearest leaf's by more than a margin. So a query between clusters visits
many leaves and one within a cluster few. The margin is calibrated: for a bounded sample of queries the
true neighbours among all rows are found, and it is the least with which the walks come to the
wanted share of them. Recall is then measured by the search itself on other queries, and the margin is
widened until it is reached.

Rows are dealt into bins of about ``BIN`` rows, whole leaves or chunks of large ones. A query goes
to a bin once, with its leaves there, and comes back with its best k; so what is shuffled grows with queries and
bins, not with leaves. Scores of visited rows are exact cosines of the original vectors.

Defined cases: vectors that are null, empty, zero, hold a null or non-finite component or have
another length than most take no part; a null id neither; rows repeated with the same id count
each as candidates, a query's own id is never its candidate, and of several query rows with one id the
smallest vector asks; an empty table gives no rows; other columns are not looked at.
"""

from __future__ import annotations

import heapq

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from prefdata.llm.common import map_batches, store
from prefdata.llm.vectors import matrix, usable

K = 5
EVERY = 50
SAMPLE = 20_000  # directions that the tree is fitted on, at most
CALIBRATION = 200  # queries whose true neighbours are found, at most; as many others check the recall
RECALL = 0.96  # share of true neighbours that the walks of the first must come to
CHECKED = 0.94  # share that the search must find for the others
BRANCHES = 8
ROWS_PER_LEAF = 100
ROUNDS = 10  # of k-means
BIN = 20_000  # rows in one task, about
CHUNK = 4096  # rows of a leaf in one bin, or queries that meet a bin at once, about
BLOCK = 256  # queries that are compared at once


def unit(vectors: np.ndarray) -> np.ndarray:
    """Directions; large and small numbers are brought to 1 first."""
    vectors = vectors / np.abs(vectors).max(axis=1, keepdims=True, initial=1e-300)
    return vectors / np.sqrt((vectors * vectors).sum(axis=1, keepdims=True))


def cosines(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Cosine of row i of ``a`` and row i of ``b``, in the same way for every row."""
    with np.errstate(over="ignore", under="ignore", invalid="ignore", divide="ignore"):
        dots, norms = (a * b).sum(axis=1), np.sqrt((a * a).sum(axis=1)) * np.sqrt((b * b).sum(axis=1))
        found = dots / norms
    odd = ~((norms > 1e-200) & (norms < 1e200))
    if odd.any():
        found[odd] = (unit(a[odd]) * unit(b[odd])).sum(axis=1)
    return found


class Tree:
    """``centres[i]`` and ``children[i]`` of inner node i; a child below 0 is leaf ~child."""

    def __init__(self, directions: np.ndarray, leaf_size: int, seed: int = 7):
        self.centres: list[np.ndarray] = []
        self.children: list[list[int]] = []
        self.leaves = 0
        self.random = np.random.default_rng(seed)
        self.root = self._grow(directions, leaf_size)

    def _grow(self, rows: np.ndarray, leaf_size: int) -> int:
        groups = self._divide(rows) if len(rows) > max(leaf_size, 1) else []
        if len(groups) < 2:
            self.leaves += 1
            return ~(self.leaves - 1)
        node = len(self.centres)
        self.centres.append(np.array([c for c, _ in groups]))
        self.children.append([])
        self.children[node] = [self._grow(own, leaf_size) for _, own in groups]
        return node

    def _divide(self, rows: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
        """k-means on directions: (centre, rows) of each group that has rows."""
        centres = rows[self.random.choice(len(rows), min(BRANCHES, len(rows)), replace=False)]
        nearest = None
        for _ in range(ROUNDS):
            now = np.argmax(rows @ centres.T, axis=1)
            if nearest is not None and (now == nearest).all():
                break
            nearest = now
            for c in range(len(centres)):
                if (own := rows[nearest == c]).size:
                    mean = own.sum(axis=0)
                    norm = np.sqrt((mean * mean).sum())
                    centres[c] = mean / norm if norm > 0 else own[0]
        nearest = np.argmax(rows @ centres.T, axis=1)
        return [(centres[c], rows[nearest == c]) for c in range(len(centres)) if (nearest == c).any()]

    def leaf_of(self, directions: np.ndarray) -> np.ndarray:
        """The leaf that each direction belongs to."""
        leaf = np.zeros(len(directions), np.int32)
        todo = [(self.root, np.arange(len(directions)))]
        while todo:
            node, own = todo.pop()
            if node < 0:
                leaf[own] = ~node
                continue
            nearest = np.argmax(directions[own] @ self.centres[node].T, axis=1)
            todo += [(child, own[nearest == c]) for c, child in enumerate(self.children[node])]
        return leaf

    def visits(self, direction: np.ndarray):
        """Leaves, best bin first."""
        return (leaf for leaf, _ in self.walk(direction))

    def walk(self, direction: np.ndarray, margin: float = np.inf):
        """(leaf, margin that it needs), best bin first, as far as ``margin`` goes.

        What a leaf needs is how far the queue's best centre ever fell below the first leaf's before.
        """
        queue, first, need = [(0.0, self.root)], None, 0.0
        while queue:
            far, node = heapq.heappop(queue)
            if first is not None:
                need = max(need, first + far)
                if need > margin:
                    return
            if node < 0:
                first = -far if first is None else first
                yield ~node, need
                continue
            for near, child in zip(self.centres[node] @ direction, self.children[node]):
                heapq.heappush(queue, (-float(near), child))


def best(ids, vectors, query_ids, queries, k: int, asked=None) -> list[tuple[int, int, float]]:
    """(query_id, vec_id, score) of the k nearest rows of each query; ``asked``: pairs to look at."""
    out = []
    near_all = unit(queries) @ unit(vectors).T
    near_all[query_ids[:, None] == ids[None, :]] = -np.inf
    if asked is not None:
        near_all[~asked] = -np.inf
    for q, near in zip(range(len(queries)), near_all):
        some = np.flatnonzero(near > -np.inf)
        if len(some) > k:
            # The product's last digits depend on its place in the matrix; what is
            # within them of the kth is scored anew.
            some = np.flatnonzero(near >= np.partition(near, -k)[-k] - 1e-9)
        exact = cosines(np.broadcast_to(queries[q], (len(some), queries.shape[1])), vectors[some])
        order = np.lexsort((ids[some], -exact))[:k]
        out += [(int(query_ids[q]), int(ids[some[i]]), float(exact[i])) for i in order]
    return out


def _nearest_rows(rows: DataFrame, query_ids: np.ndarray, queries: np.ndarray, k: int) -> DataFrame:
    """True neighbours of a few queries (brute force over all rows)."""

    def run(batches):
        out: list = []
        for batch in batches:
            ids, vectors = batch.column("vec_id").to_numpy(zero_copy_only=False), matrix(batch.column("v"))
            for at in range(0, len(ids), CHUNK):
                out += best(ids[at : at + CHUNK], vectors[at : at + CHUNK], query_ids, queries, k)
        yield dict(zip(("query_id", "vec_id", "score"), zip(*out))) if out else {
            "query_id": [], "vec_id": [], "score": []
        }

    return _ranked(map_batches(rows.select("vec_id", "v"), run, "query_id long, vec_id long, score double"), k)


def _ranked(found: DataFrame, k: int) -> DataFrame:
    place = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(place)).filter(F.col("rank") <= k)


def _some(rows: DataFrame, most: int, n: int, skip: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """Ids and vectors of at most ``most`` of the ``n`` rows, chosen by a hash, after ``skip`` others."""
    at = F.pmod(F.xxhash64(F.lit(3), "vec_id"), F.lit(1 << 40))
    if n > skip + most:
        rows = rows.filter(at < int((1 << 40) * min(1.0, 1.2 * (skip + most) / n + 0.001)))
    chosen = rows.select("vec_id", "v").orderBy(at, "vec_id").limit(skip + most).toArrow()
    if chosen.num_rows <= skip:
        return np.zeros(0, np.int64), np.zeros((0, 1))
    vectors = matrix(pa.concat_arrays(chosen.column("v").chunks))
    return chosen.column("vec_id").to_numpy()[skip:], vectors[skip:]


def fit(rows: DataFrame, n: int) -> Tree:
    """A tree whose leaves hold about ``ROWS_PER_LEAF`` of ``n`` rows, from at most ``SAMPLE`` of them."""
    _, sample = _some(rows, SAMPLE, n)
    return grown(sample, n)


def grown(sample: np.ndarray, n: int) -> Tree:
    directions = np.unique(unit(sample), axis=0) if len(sample) else sample
    leaves = max(1, min(n // ROWS_PER_LEAF, len(directions) // 16))
    return Tree(directions, len(directions) // leaves)


def calibrate(tree: Tree, rows: DataFrame, queries: DataFrame, n_queries: int, k: int, recall: float) -> float:
    """The margin with which ``recall`` of the true neighbours of sampled queries lie in visited leaves."""
    ids, vectors = _some(queries, CALIBRATION, n_queries)
    if not len(ids):
        return 0.0
    truth = _nearest_rows(rows, ids, vectors, k).select("query_id", "vec_id").distinct()
    homes = rows.select("vec_id", "leaf").join(F.broadcast(truth), "vec_id").distinct().collect()
    needs = {q: dict(tree.walk(direction)) for q, direction in zip(ids.tolist(), unit(vectors))}
    needed = sorted(needs[h["query_id"]][h["leaf"]] for h in homes)
    return needed[min(len(needed) - 1, int(np.ceil(recall * len(needed))) - 1)] if needed else 0.0


class Index:
    """Rows with their leaves, dealt into bins; the tree and the margin of the walks."""

    def __init__(self, rows: DataFrame):
        rows = store(rows.select("vec_id", "v"))
        self.n = rows.count()
        self.tree = tree = fit(rows, self.n)
        self.margin = np.inf

        def place(batches):
            for batch in batches:
                leaf = tree.leaf_of(unit(matrix(batch.column("v")))) if len(batch) else []
                yield {"vec_id": batch.column("vec_id"), "v": batch.column("v"), "leaf": leaf}

        self.placed = store(map_batches(rows, place, "vec_id long, v array<double>, leaf int"))
        # One number per leaf, of at most SAMPLE / 16 leaves.
        sizes = {r["leaf"]: r["count"] for r in self.placed.groupBy("leaf").count().collect()}
        self.sizes = [sizes.get(leaf, 0) for leaf in range(tree.leaves)]
        self.chunks = [-(-size // CHUNK) for size in self.sizes]
        self.firsts = np.concatenate([[0], np.cumsum(self.chunks)]).astype(int).tolist()
        self.bins = max(1, -(-self.n // BIN))

    def by_bin(self) -> DataFrame:
        """The rows with their bins: chunk after chunk, leaf after leaf, goes to the next bin."""
        def of_leaf(numbers: list[int]):
            return F.element_at(F.array(*[F.lit(int(x)) for x in numbers]), F.col("leaf") + 1)

        chunk = F.pmod(F.xxhash64("vec_id"), F.greatest(of_leaf(self.chunks), F.lit(1)))
        return self.placed.withColumn("bin", F.pmod(of_leaf(self.firsts[:-1]) + chunk, F.lit(self.bins)).cast("int"))

    def search(self, queries: DataFrame, n_queries: int, k: int) -> DataFrame:
        """(query_id, vec_id, score, rank) of what the walks of queries (vec_id, v) find."""
        tree, margin, bins = self.tree, self.margin, self.bins
        sizes, chunks, firsts = self.sizes, self.chunks, self.firsts

        def walk(batches):
            for batch in batches:
                vectors, out = matrix(batch.column("v")), []
                for i, direction in enumerate(unit(vectors) if len(batch) else []):
                    held, leaves = 0, {}
                    for leaf, need in tree.walk(direction):
                        if need > margin and held > k:
                            break
                        held += sizes[leaf]
                        for unit_no in range(firsts[leaf], firsts[leaf] + chunks[leaf]):
                            leaves.setdefault(unit_no % bins, set()).add(leaf)
                    out += [(i, b, sorted(own)) for b, own in leaves.items()]
                picked = pa.array([i for i, _, _ in out], pa.int64())
                yield {
                    "query_id": batch.column("vec_id").take(picked),
                    "q": batch.column("v").take(picked),
                    "bin": [b for _, b, _ in out],
                    "leaves": pa.array([own for _, _, own in out], pa.list_(pa.int32())),
                }

        # The walks are shared out over all cores; some queries at a time meet a bin.
        tasks = max(queries.sparkSession.sparkContext.defaultParallelism, n_queries // 1000)
        asked = map_batches(
            queries.select("vec_id", "v").repartition(tasks, "vec_id"), walk,
            "query_id long, q array<double>, bin int, leaves array<int>",
        )
        parts = max(1, -(-n_queries // CHUNK))
        left = asked.withColumn("part", F.pmod(F.xxhash64("query_id"), F.lit(parts)).cast("int"))
        right = self.by_bin().withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))))
        met = (
            left.groupBy("bin", "part")
            .cogroup(right.groupBy("bin", "part"))
            .applyInPandas(_compare(k, margin), "query_id long, vec_id long, score double")
        )
        return _ranked(met, k)


def _compare(k: int, margin: float):
    names = ["query_id", "vec_id", "score"]

    def run(ask: pd.DataFrame, have: pd.DataFrame) -> pd.DataFrame:
        if not len(ask) or not len(have):
            return pd.DataFrame([], columns=names)
        have = have.sort_values("leaf", kind="stable")
        leaf, ids, vectors = have["leaf"].to_numpy(), have["vec_id"].to_numpy(), np.stack(have["v"])
        spans = {}
        for own in np.unique(leaf):
            at, to = np.searchsorted(leaf, own), np.searchsorted(leaf, own, "right")
            # A leaf that the sample was too small for is divided here.
            deep = to - at > 16 * ROWS_PER_LEAF
            tree = grown(_sample_of(vectors[at:to]), to - at) if deep else None
            spans[own] = (at, to, tree, tree.leaf_of(unit(vectors[at:to])) if deep else None)
        found = []
        for start in range(0, len(ask), BLOCK):
            some = ask.iloc[start : start + BLOCK]
            queries = np.stack(some["q"])
            directions = unit(queries)
            asked = np.zeros((len(some), len(ids)), bool)
            for i, leaves in enumerate(some["leaves"]):
                for own in leaves:
                    if own not in spans:
                        continue
                    at, to, tree, within = spans[own]
                    if tree is None:
                        asked[i, at:to] = True
                    else:
                        asked[i, at:to] = np.isin(within, _visited(tree, within, directions[i], margin, k))
            found += best(ids, vectors, some["query_id"].to_numpy(), queries, k, asked)
        return pd.DataFrame(found, columns=names)

    return run


def _visited(tree: Tree, within: np.ndarray, direction: np.ndarray, margin: float, k: int) -> list[int]:
    """Leaves of a divided leaf that the walk visits, with more than k rows in them."""
    sizes, held, out = np.bincount(within, minlength=tree.leaves), 0, []
    for leaf, need in tree.walk(direction):
        if need > margin and held > k:
            break
        held += sizes[leaf]
        out.append(leaf)
    return out


def _sample_of(vectors: np.ndarray) -> np.ndarray:
    return vectors[:: max(1, len(vectors) // SAMPLE)][:SAMPLE]


def search(rows: DataFrame, queries: DataFrame, k: int = K, recall: float = RECALL, checked: float = CHECKED) -> DataFrame:
    """(query_id, rank, vec_id, score) of the k nearest rows found of each query.

    Both inputs have (vec_id, v array<double>), without zero vectors.
    """
    asked = store(queries.groupBy("vec_id").agg(F.min("v").alias("v")))
    index, n_queries = Index(rows), asked.count()
    ids, vectors = _some(asked, CALIBRATION, n_queries, skip=min(CALIBRATION, n_queries // 2))
    others = asked.filter(F.col("vec_id").isin(ids.tolist()))
    truth = store(_nearest_rows(index.placed, ids, vectors, k).select("query_id", "vec_id")) if len(ids) else None
    while True:
        index.margin = calibrate(index.tree, index.placed, asked, n_queries, k, recall)
        if truth is None or recall >= 1:
            break
        got = index.search(others, len(ids), k).select("query_id", "vec_id").distinct()
        if got.join(truth.distinct(), ["query_id", "vec_id"], "left_semi").count() >= checked * truth.distinct().count():
            break
        recall = min(1.0, recall + (1 - recall) / 2 if recall < 0.995 else 1.0)
    return index.search(asked, n_queries, k).select("query_id", "rank", "vec_id", "score")


def op10_ann(embeddings: DataFrame) -> DataFrame:
    rows = usable(embeddings, zero=False)
    return search(rows, rows.filter(F.col("vec_id") % EVERY == 0))
