"""Exact top-k by distributed histogram selection.

Queries are compared with all rows block by block (a stated set of queries; a block is
``BLOCK`` of them, which bounds what is sent to the tasks). Each pass scores everything
against the block and counts scores in ``BINS`` bins between two bounds of each query. The
bin that holds the kth highest score gives the next bounds, until a bin is one score wide.
Then rows below a query's kth score are filtered out and ties are broken by id.
Counts are added up per task before they are shuffled; the driver sees four numbers per query of a
block, never scores.

Defined cases: vectors that are null, empty, hold a null or non-finite component or have
another length than most take no part; a null id neither; rows repeated with the same id
count each as candidates, a query's own id is never its candidate, and of several query rows with
one id the smallest vector asks; an empty table gives no rows; other columns are not looked at.
Scores are exact, whatever finite components; one beyond a long is held at its limit.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from prefdata.llm.common import map_batches, parts_for, salt, store
from prefdata.llm.vectors import matrix, usable

K = 5
EVERY = 50
SCALE = 256
BINS = 256
BLOCK = 1500
CHUNK = 2048  # rows scored at once

_LONG = np.iinfo(np.int64)


def scaled(vectors: np.ndarray) -> np.ndarray:
    """floor(256 * x), as doubles (whole numbers)."""
    return np.floor(SCALE * vectors)


def inner_products(rows: np.ndarray, queries: np.ndarray) -> np.ndarray:
    """Inner products of the scaled vectors, whole numbers, exact; held at a long's limits."""
    with np.errstate(over="ignore"):
        a, b = scaled(rows), scaled(queries)
        most = rows.shape[1] * np.abs(a).max(initial=0) * np.abs(b).max(initial=0)
    if most < 2**53:
        return (a @ b.T).astype(np.int64)
    whole = [[[_whole(x) for x in r] for r in m.tolist()] for m in (rows, queries)]
    exact = [
        [max(_LONG.min, min(_LONG.max, sum(a * b for a, b in zip(r, q)))) for q in whole[1]] for r in whole[0]
    ]
    return np.array(exact, np.int64).reshape(len(rows), len(queries))


def _whole(x: float) -> int:
    """floor(SCALE * x), exact: a component beyond 2**60 is a whole number by itself."""
    return SCALE * int(x) if abs(x) > 1 << 60 else math.floor(SCALE * x)


def _scored(batches, ids: np.ndarray, queries: np.ndarray):
    """(vec_ids, scores, counts) of chunks of rows; own rows are not counted."""
    for batch in batches:
        all_ids = batch.column("vec_id").to_numpy(zero_copy_only=False)
        rows = matrix(batch.column("v"))
        for at in range(0, len(all_ids), CHUNK):
            vec_ids = all_ids[at : at + CHUNK]
            scores = inner_products(rows[at : at + CHUNK], queries)
            yield vec_ids, scores, vec_ids[:, None] != ids[None, :]


def _bounds(rows: DataFrame, ids: np.ndarray, queries: np.ndarray) -> DataFrame:
    def run(batches):
        low, high = np.full(len(ids), _LONG.max), np.full(len(ids), _LONG.min)
        n = np.zeros(len(ids), np.int64)
        for _, scores, counted in _scored(batches, ids, queries):
            low = np.minimum(low, np.where(counted, scores, _LONG.max).min(axis=0))
            high = np.maximum(high, np.where(counted, scores, _LONG.min).max(axis=0))
            n += counted.sum(axis=0)
        some = np.flatnonzero(n)
        yield {"query": some.astype(np.int32), "low": low[some], "high": high[some], "n": n[some]}

    found = map_batches(rows, run, "query int, low long, high long, n long")
    return found.groupBy("query").agg(F.min("low").alias("low"), F.max("high").alias("high"), F.sum("n").alias("n"))


def _histogram(rows: DataFrame, ids, queries, low, high, width) -> DataFrame:
    """(query, bin, n): candidates per bin of ``width`` scores, from ``low`` to ``high``.

    Scores above ``high`` have been counted before.
    """

    def run(batches):
        counts = np.zeros(len(ids) * BINS, np.int64)
        first = np.arange(len(ids)) * BINS
        for _, scores, counted in _scored(batches, ids, queries):
            inside = counted & (scores >= low) & (scores <= high)
            bins = np.where(inside, scores - low, 0).astype(np.uint64) // width.astype(np.uint64)
            counts += np.bincount((bins.astype(np.int64) + first)[inside], minlength=len(counts))
        some = np.flatnonzero(counts)
        yield {"query": (some // BINS).astype(np.int32), "bin": (some % BINS).astype(np.int32), "n": counts[some]}

    return map_batches(rows, run, "query int, bin int, n long").groupBy("query", "bin").agg(F.sum("n").alias("n"))


def kth_scores(rows: DataFrame, ids: np.ndarray, queries: np.ndarray, k: int) -> np.ndarray:
    """The kth highest score of each query; the lowest where it has fewer candidates."""
    low, high = np.zeros(len(ids), np.int64), np.zeros(len(ids), np.int64)
    rank = np.full(len(ids), k)
    for r in _bounds(rows, ids, queries).collect():
        low[r["query"]], high[r["query"]], rank[r["query"]] = r["low"], r["high"], min(k, r["n"])
    while (high > low).any():
        span = (high.astype(object) - low.astype(object) + BINS) // BINS  # may exceed a long
        width = np.array([min(int(s), _LONG.max) for s in span], np.int64)
        counts = _histogram(rows, ids, queries, low, high, width)
        above = Window.partitionBy("query").orderBy(F.desc("bin")).rowsBetween(Window.unboundedPreceding, -1)
        wanted = counts.sparkSession.createDataFrame(
            [(i, int(n)) for i, n in enumerate(rank)], "query int, rank long"
        )
        found = (
            counts.withColumn("above", F.coalesce(F.sum("n").over(above), F.lit(0)))
            .join(F.broadcast(wanted), "query")
            .filter("above < rank and rank <= above + n")
            .collect()
        )
        for r in found:
            q = r["query"]
            start = int(low[q]) + r["bin"] * int(width[q])
            low[q], high[q], rank[q] = start, min(int(high[q]), start + int(width[q]) - 1), rank[q] - r["above"]
    return low


def _selected(rows: DataFrame, ids, queries, least, k: int) -> DataFrame:
    """Candidates at or above each query's kth score; per task the best k of a query."""

    def run(batches):
        held: dict[int, list[tuple[int, int]]] = {}
        for vec_ids, scores, counted in _scored(batches, ids, queries):
            for row, q in zip(*np.nonzero(counted & (scores >= least))):
                own = held.setdefault(int(q), [])
                own.append((-int(scores[row, q]), int(vec_ids[row])))
                if len(own) > 64 * k:
                    held[int(q)] = sorted(own)[:k]
        out = [(int(ids[q]), v, -s) for q, own in held.items() for s, v in sorted(own)[:k]]
        yield dict(zip(("query_id", "vec_id", "score"), zip(*out))) if out else {
            "query_id": [], "vec_id": [], "score": []
        }

    return map_batches(rows, run, "query_id long, vec_id long, score long")


def top_k(rows: DataFrame, queries: DataFrame, k: int = K) -> DataFrame:
    """(query_id, rank, vec_id, score) of the k highest inner products of each query.

    Both inputs have (vec_id, v array<double>) with equally long vectors.
    """
    rows = store(rows.select("vec_id", "v"))
    asked = store(queries.groupBy("vec_id").agg(F.min("v").alias("v")))
    blocks = parts_for(asked.count(), BLOCK)
    block_of = salt(F.col("vec_id"), blocks)
    found = None
    for number in range(blocks):
        block = asked.filter(block_of == number).orderBy("vec_id").toArrow()
        if not block.num_rows:
            continue
        ids = block.column("vec_id").to_numpy()
        vectors = matrix(pa.concat_arrays(block.column("v").chunks))
        least = kth_scores(rows, ids, vectors, k)
        part = _selected(rows, ids, vectors, least, k)
        found = part if found is None else found.unionByName(part)
    if found is None:
        found = rows.sparkSession.createDataFrame([], "query_id long, vec_id long, score long")
    place = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(place)).filter(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")


def op7_topk(embeddings: DataFrame) -> DataFrame:
    rows = usable(embeddings, zero=True)
    return top_k(rows, rows.filter(F.col("vec_id") % EVERY == 0))
