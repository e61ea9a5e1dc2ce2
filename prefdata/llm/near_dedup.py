"""Near-duplicate embeddings by range search in a robust-pruned flat graph.

Equal vectors with one label are a node; copies are counted where they are read. The nodes of a label are
cut by k-means, level by level, until a cluster shard has about ``SHARD`` of them; each node is at home
in the shard of its nearest centre and a guest in those of the next ones, so shards overlap. In each
shard a flat graph is built: a node's candidates (its nearest nodes and a few from anywhere) are
robust-pruned, one is dropped if a chosen one is nearer to it by the factor ``ALPHA`` than the node,
and so are the edges with those that come back. A node's adjacency lists of all its shards are united.

Every node is a query in each of its shards: a greedy search with a beam starts from the shard's medoids
nearest to it, and once it has come to rest it expands by range: every node found within the
threshold is opened in turn. Where a node that a query links with is in other shards, too, the query goes on to
these, until it has been in all; so groups of copies larger than a shard are followed. A link is counted in
its target's home shard. Links are verified by exact cosines of the original vectors. A shard sends
a row per linked node (number of links, root of its links within the task), never pairs.

The recall is audited: for ``AUDIT`` nodes all links are found by brute force. If less than ``RECALL``
of them were found, the index is built again with twice the overlap, up to ``TRIES`` times; the
last audit is in the column ``recall``.

Defined cases: vectors that are null, empty, zero or hold a null or non-finite component, and rows
with a null label, link with nothing and are kept; vectors of several lengths raise an error that names them;
rows repeated with an id are vectors of their own; a null id is never a component's name,
unless none of its rows has an id, and such a row is kept then; an empty table gives no rows;
other columns are not looked at, whatever their names.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from prefdata.llm.ann import cosines, unit
from prefdata.llm.common import components, map_batches, store
from prefdata.llm.vectors import is_finite, matrix, one_length
from prefdata.operators.skew import salted_join

LINK = 0.93
SHARD = 400  # home nodes of a shard, about
SAMPLE = 8192  # nodes of a cluster that its centres are fitted on, about
BRANCHES = 256  # centres of a cluster, at most
PIECE = 50_000  # nodes of a cluster, or queries of a shard, in one task, about
OVERLAP = 2
DEGREE = 24
NEAREST, ANYWHERE = 64, 32  # candidates of a node
ALPHA = 1.2
BEAM = 48
OPENED = 4  # nodes of a beam that are opened at once
STARTS = 8
BLOCK = 512
AUDIT = 1000
RECALL = 0.97
TRIES = 3

_CLOSE = 1e-5  # what single precision may be off
_EQUAL = 4e-6  # squared distance below which nodes don't stand in for each other


def k_means(rows: np.ndarray, k: int, rounds: int = 8, seed: int = 11) -> np.ndarray:
    """Centres (directions) of at most k groups that have rows."""
    random = np.random.default_rng(seed)
    centres = rows[random.choice(len(rows), min(k, len(rows)), replace=False)].copy()
    for _ in range(rounds):
        nearest = np.argmax(rows @ centres.T, axis=1)
        sums = np.zeros_like(centres)
        np.add.at(sums, nearest, rows)
        norms = np.sqrt((sums * sums).sum(axis=1))
        good = norms > 1e-12
        centres[good] = sums[good] / norms[good, None]
    return centres[np.unique(np.argmax(rows @ centres.T, axis=1))]


def nodes_of(rows: DataFrame) -> DataFrame:
    """(label, a, b, v, n, first_id, node) of the distinct vectors of each label in (vec_id, label, v, a, b)."""
    nodes = rows.groupBy("label", "a", "b").agg(
        F.first("v").alias("v"), F.count(F.lit(1)).alias("n"), F.min("vec_id").alias("first_id")
    )
    return store(nodes.withColumn("node", F.monotonically_increasing_id()))


def shards(nodes: DataFrame, overlap: int) -> DataFrame:
    """(shard, node, v, n, home): each node at home in one shard and a guest in others."""
    placed = store(
        nodes.select(F.col("label").cast("string").alias("shard"), "node", "v", "n", F.lit(True).alias("home"))
    )
    done = None
    while True:
        sizes = store(
            placed.groupBy("shard").agg(F.count(F.lit(1)).alias("n_rows"), F.count_if("home").alias("at_home"))
        )
        is_wide = F.col("at_home") > 2 * SHARD
        wide = sizes.filter(is_wide)
        small = salted_join(placed, sizes.filter(~is_wide).select("shard"), "shard", ["node"], sizes)
        done = small if done is None else done.unionByName(small)
        if not wide.limit(1).count():
            return store(done)
        pieces = wide.select("shard", "n_rows", "at_home", F.ceil(F.col("n_rows") / PIECE).alias("pieces"))
        own = salted_join(placed, pieces, "shard", ["node"], sizes)
        rank = F.pmod(F.xxhash64("node"), F.lit(1 << 30)) / F.lit(float(1 << 30))
        centres = (
            own.filter(rank < F.lit(float(SAMPLE)) / F.col("n_rows"))
            .select("shard", "at_home", "v")
            .groupBy("shard")
            .applyInArrow(_fit, "shard string, centres array<array<double>>")
        )
        centres = store(centres)
        each = centres.join(pieces.select("shard", "pieces"), "shard").select(
            "shard", "centres", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("pieces") - 1)).alias("piece")
        )
        dealt = own.withColumn("piece", F.pmod(F.xxhash64(F.lit(5), "node"), F.col("pieces")))
        placed = store(
            dealt.select("shard", "piece", "node", "v", "n", "home")
            .groupBy("shard", "piece")
            .cogroup(each.groupBy("shard", "piece"))
            .applyInArrow(_assign(overlap), "shard string, node long, v array<double>, n long, home boolean")
        )


def _fit(table: pa.Table) -> pa.Table:
    rows = unit(matrix(table.column("v").combine_chunks()))
    k = max(2, min(BRANCHES, -(-table.column("at_home")[0].as_py() // SHARD)))
    centres = k_means(rows, k)
    if len(centres) < 2:  # directions that are all the same: any cut is as good
        centres = np.vstack([centres[:1], -centres[:1]])
    return pa.table(
        {"shard": table.column("shard")[:1], "centres": pa.array([centres.tolist()], pa.list_(pa.list_(pa.float64())))}
    )


def _assign(overlap: int):
    schema = pa.schema(
        [("shard", pa.string()), ("node", pa.int64()), ("v", pa.list_(pa.float64())), ("n", pa.int64()), ("home", pa.bool_())]
    )

    def run(table: pa.Table, centres: pa.Table) -> pa.Table:
        if not len(table) or not len(centres):
            return schema.empty_table()
        near = unit(matrix(table.column("v").combine_chunks())) @ np.array(centres.column("centres")[0].as_py()).T
        order = np.argsort(-near, axis=1, kind="stable")
        home = table.column("home").to_numpy()
        if home.any() and len(home) > 2 * SHARD and (order[:, 0] == order[0, 0]).all():
            # One group holds all: parts by place in the order of nearness, neighbours stay together.
            rank = np.empty(len(near), np.int64)
            rank[np.argsort(near[:, order[0, 0]], kind="stable")] = np.arange(len(near))
            parts = max(2, -(-len(near) // SHARD))
            first = rank * parts // len(near)
            order = np.stack([first, (first + 1) % parts], axis=1)
        rows, child, at_home = [np.arange(len(near))], [order[:, 0]], [home]
        for place in range(1, min(overlap, order.shape[1])):
            guests = np.flatnonzero(home)
            rows.append(guests)
            child.append(order[guests, place])
            at_home.append(np.zeros(len(guests), bool))
        picked = pa.array(np.concatenate(rows))
        shard = table.column("shard")[0].as_py()
        return pa.table(
            {
                "shard": pa.array([f"{shard}.{c}" for c in np.concatenate(child)], pa.string()),
                "node": table.column("node").take(picked),
                "v": table.column("v").take(picked),
                "n": table.column("n").take(picked),
                "home": pa.array(np.concatenate(at_home)),
            }
        ).cast(schema)

    return run


def robust_prune(x: np.ndarray, points: np.ndarray, candidates: np.ndarray) -> np.ndarray:
    """Neighbours of each point, -1 for none: a candidate (-1: none) that a chosen one is nearer to goes."""
    near = np.einsum("pd,pcd->pc", x[points], x[candidates])
    near[(candidates < 0) | (candidates == points[:, None])] = -np.inf
    order = np.argsort(-near, axis=1, kind="stable")
    candidates, near = np.take_along_axis(candidates, order, 1), np.take_along_axis(near, order, 1)
    # The same candidate twice: the second goes.
    alive = near > -np.inf
    vectors = x[candidates]
    chosen = np.full((len(points), DEGREE), -1)
    every = np.arange(len(points))
    for place in range(DEGREE):
        first = alive.argmax(axis=1)
        some = alive[every, first]
        if not some.any():
            break
        picked = candidates[every, first]
        chosen[some, place] = picked[some]
        apart = 2 - 2 * np.einsum("pd,pcd->pc", x[picked], vectors)
        alive &= ALPHA * ALPHA * apart + _EQUAL > 2 - 2 * near
        alive &= candidates != picked[:, None]
    return chosen


def build(x: np.ndarray, seed: int = 5) -> list[np.ndarray]:
    """Adjacency lists of a flat graph over directions (single precision)."""
    n = len(x)
    random = np.random.default_rng(seed)
    nearest = min(NEAREST, n - 1)
    out = np.full((n, DEGREE), -1)
    if n < 2:
        return [out[0][:0]] * n
    for at in range(0, n, BLOCK):
        points = np.arange(at, min(n, at + BLOCK))
        # A little chance, so that nodes equally near to many have different neighbours.
        near = x[points] @ x.T + random.random((len(points), n), np.float32) * np.float32(_EQUAL)
        near[np.arange(len(points)), points] = -np.inf
        close = np.argpartition(-near, nearest - 1, axis=1)[:, :nearest]
        out[points] = robust_prune(x, points, np.hstack([close, random.integers(0, n, (len(points), ANYWHERE))]))
    # With the edges that come back; whoever gets too many is pruned again.
    source, place = np.nonzero(out >= 0)
    target = out[source, place]
    a, b = np.concatenate([source, target]), np.concatenate([target, source])
    codes = np.unique(a * n + b)
    lists = np.split(codes % n, np.searchsorted(codes // n, np.arange(1, n)))
    many = [i for i in range(n) if len(lists[i]) > 2 * DEGREE]
    for at in range(0, len(many), 64):
        points = np.array(many[at : at + 64])
        width = max(len(lists[i]) for i in points)
        candidates = np.full((len(points), width), -1)
        for row, i in enumerate(points):
            candidates[row, : len(lists[i])] = lists[i]
        for i, kept in zip(points, robust_prune(x, points, candidates)):
            lists[i] = kept[kept >= 0]
    return lists


def _build_shard(table: pa.Table) -> pa.Table:
    ids = table.column("node").to_numpy()
    order = np.argsort(ids)
    x = unit(matrix(table.column("v").combine_chunks()))[order].astype(np.float32)
    ids = ids[order]
    lists = build(x)
    return pa.table(
        {
            "shard": pa.array([table.column("shard")[0].as_py()] * len(ids), pa.string()),
            "node": pa.array(ids),
            "neighbours": pa.array([ids[own].tolist() for own in lists], pa.list_(pa.int64())),
        }
    )


def united(members: DataFrame) -> DataFrame:
    """``members`` with their adjacency lists of all shards, and the names of these."""
    graph = store(
        members.select("shard", "node", "v")
        .groupBy("shard")
        .applyInArrow(_build_shard, "shard string, node long, neighbours array<long>")
    )
    union = graph.groupBy("node").agg(
        F.array_distinct(F.flatten(F.collect_list("neighbours"))).alias("neighbours"),
        F.sort_array(F.collect_list("shard")).alias("shards"),
    )
    return store(members.join(union, "node"))


class Shard:
    """The part of the united graph whose nodes are in one shard."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, lists: list[np.ndarray]):
        order = np.argsort(ids)
        self.ids, self.vectors = ids[order], vectors[order]
        self.x = unit(self.vectors).astype(np.float32)
        self.order = order
        lists = [lists[i] for i in order]
        row = np.repeat(np.arange(len(lists)), [len(own) for own in lists])
        to = np.concatenate([np.asarray(own, np.int64) for own in lists])
        at = np.minimum(np.searchsorted(self.ids, to), len(self.ids) - 1)
        here = self.ids[at] == to
        row, at = row[here], at[here]
        firsts = np.searchsorted(row, np.arange(len(lists) + 1))
        self.edges = np.full((len(lists), max(1, int(np.diff(firsts).max(initial=0)))), -1)
        self.edges[row, np.arange(len(row)) - firsts[row]] = at
        centres = k_means(self.x, max(1, int(len(self.x) ** 0.5)), rounds=4)
        self.medoids = np.unique(np.argmax(self.x @ centres.T, axis=0))

    def within(self, queries: np.ndarray, link: float) -> tuple[np.ndarray, np.ndarray]:
        """(query, node) pairs with a cosine of ``link`` or more that the search finds."""
        found = [self._block(queries[at : at + BLOCK], at, link) for at in range(0, len(queries), BLOCK)]
        return tuple(np.concatenate([f[c] for f in found]) for c in range(2))

    def _block(self, vectors: np.ndarray, first: int, link: float) -> tuple[np.ndarray, np.ndarray]:
        q = unit(vectors).astype(np.float32)
        near = np.full((len(q), len(self.ids)), -2, np.float32)
        opened = np.zeros(near.shape, bool)
        starts = min(STARTS, len(self.medoids))
        to_medoids = q @ self.x[self.medoids].T
        close = np.argpartition(-to_medoids, starts - 1, axis=1)[:, :starts]
        np.put_along_axis(near, self.medoids[close], np.take_along_axis(to_medoids, close, 1), 1)
        beam = min(BEAM, len(self.ids))
        active = np.arange(len(q))
        while len(active):
            top = np.argpartition(-near[active], beam - 1, axis=1)[:, :beam]
            score = np.take_along_axis(near[active], top, 1)
            score[np.take_along_axis(opened[active], top, 1)] = -2
            best = np.argsort(-score, axis=1, kind="stable")[:, :OPENED]
            row, place = np.nonzero(np.take_along_axis(score, best, 1) > -2)
            self._open(q, near, opened, active[row], top[row, best[row, place]])
            active = active[np.unique(row)]
        while (wave := np.nonzero((near >= link - _CLOSE) & ~opened))[0].size:
            self._open(q, near, opened, *wave)
        row, node = np.nonzero(near >= link - _CLOSE)
        good = np.zeros(len(row), bool)
        for at in range(0, len(row), 1 << 15):
            some = slice(at, at + (1 << 15))
            good[some] = cosines(vectors[row[some]], self.vectors[node[some]]) >= link
        return row[good] + first, node[good]

    def _open(self, q, near, opened, row: np.ndarray, node: np.ndarray) -> None:
        """Score the neighbours of nodes for their queries."""
        opened[row, node] = True
        for at in range(0, len(row), 1 << 14):
            own, to = row[at : at + (1 << 14)], self.edges[node[at : at + (1 << 14)]]
            own = np.repeat(own, to.shape[1])
            to = to.ravel()
            fresh = to >= 0
            own, to = own[fresh], to[fresh]
            codes = np.unique((own * near.shape[1] + to)[near[own, to] == -2])
            own, to = codes // near.shape[1], codes % near.shape[1]
            near[own, to] = np.einsum("pd,pd->p", q[own], self.x[to])


def _roots(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(node, smallest node that the pairs connect it with) of all nodes in pairs."""
    nodes, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    a, b = at[: len(a)], at[len(a) :]
    root = np.arange(len(nodes))
    while True:
        low = np.minimum(root[a], root[b])
        now = root.copy()
        np.minimum.at(now, a, low)
        np.minimum.at(now, b, low)
        now = now[now]
        if (now == root).all():
            return nodes, nodes[root]
        root = now


_FOUND = "node long, links long, found long, root long, shards array<string>"


def _search(link: float):
    columns = ["node", "links", "found", "root", "shards"]

    def run(key, asked: pd.DataFrame, members: pd.DataFrame) -> pd.DataFrame:
        if not len(asked) or not len(members):
            return pd.DataFrame([], columns=columns)
        shard = Shard(
            members["node"].to_numpy(), np.stack(members["v"]), members["neighbours"].tolist()
        )
        members = members.iloc[shard.order]
        queries = asked["node"].to_numpy()
        row, at = shard.within(np.stack(asked["v"]), link)
        other = queries[row] != shard.ids[at]
        row, at = row[other], at[other]
        if not len(row):
            return pd.DataFrame([], columns=columns)
        counted = members["home"].to_numpy()[at]
        weight = np.where(counted, members["n"].to_numpy()[at], 0)
        links = np.zeros(len(queries), np.int64)
        found = np.zeros(len(queries), np.int64)
        np.add.at(links, row, weight)
        np.add.at(found, row, counted)
        sets = [frozenset(s) - {key[0]} for s in members["shards"]]
        kinds = {s: i for i, s in enumerate(dict.fromkeys(sets))}
        kind = np.array([kinds[s] for s in sets])
        onward: dict[int, set] = {}
        of_kind = list(kinds)
        for code in np.unique(row * len(kinds) + kind[at]).tolist():
            onward.setdefault(int(queries[code // len(kinds)]), set()).update(of_kind[code % len(kinds)])
        nodes, roots = _roots(queries[row], shard.ids[at])
        place = {int(node): i for i, node in enumerate(queries)}
        own = [place.get(int(node), -1) for node in nodes]
        return pd.DataFrame(
            {
                "node": nodes,
                "links": [int(links[i]) if i >= 0 else 0 for i in own],
                "found": [int(found[i]) if i >= 0 else 0 for i in own],
                "root": roots,
                "shards": [sorted(onward.get(int(node), ())) for node in nodes],
            }
        )

    return run


def _ask(asked: DataFrame, index: DataFrame, link: float) -> DataFrame:
    """What queries (shard, node, v) find in their shards; a shard with many queries is asked in pieces."""
    pieces = store(
        asked.groupBy("shard").agg(F.ceil(F.count(F.lit(1)) / PIECE).alias("pieces"), F.count(F.lit(1)).alias("n_rows"))
    )
    dealt = salted_join(asked, pieces.select("shard", "pieces"), "shard", ["node"], pieces).withColumn(
        "piece", F.pmod(F.xxhash64(F.lit(9), "node"), F.col("pieces"))
    )
    copies = index.join(pieces.select("shard", "pieces"), "shard").withColumn(
        "piece", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("pieces") - 1))
    )
    keys = ["shard", "piece"]
    columns = [*keys, "node", "v", "n", "home", "neighbours", "shards"]
    # Queries can come from the index itself; columns of their own tell the two apart.
    copies = copies.select(*[F.col(c).alias(f"_{c}") for c in columns]).toDF(*columns)
    return store(
        dealt.select(*keys, "node", "v")
        .groupBy(*keys)
        .cogroup(copies.groupBy(*keys))
        .applyInPandas(_search(link), _FOUND)
    )


def linked(nodes: DataFrame, link: float = LINK, overlap: int = OVERLAP) -> DataFrame:
    """(node, links, found, root) rows of the linked nodes, one per shard that a link was found in."""
    index = united(shards(nodes, overlap))
    asked = index.select("shard", "node", "v")
    been = store(asked.select("shard", "node"))
    out = None
    while True:
        found = _ask(asked, index, link)
        out = found if out is None else out.unionByName(found)
        onward = found.select("node", F.explode("shards").alias("shard")).distinct()
        new = store(onward.join(been, ["shard", "node"], "left_anti"))
        if not new.limit(1).count():
            return out.drop("shards")
        been = been.unionByName(new.select("shard", "node"))
        asked = new.join(nodes.select("node", "v"), "node").select("shard", "node", "v")


def audit(nodes: DataFrame, found: DataFrame, link: float = LINK) -> float:
    """Share of the links of ``AUDIT`` nodes, chosen by a hash, that were found; 1 if they have none."""
    rank = F.pmod(F.xxhash64(F.lit(13), "node"), F.lit(1 << 40))
    chosen = nodes.select("node", "label", "v").orderBy(rank, "node").limit(AUDIT).toArrow()
    if not len(chosen):
        return 1.0
    ids = chosen.column("node").to_numpy()
    labels = np.array([str(x) for x in chosen.column("label").to_pylist()])
    vectors = matrix(chosen.column("v").combine_chunks())
    directions = unit(vectors)

    def run(batches):
        count = np.zeros(len(ids), np.int64)
        for batch in batches:
            if not len(batch):
                continue
            rows, own = matrix(batch.column("v")), batch.column("node").to_numpy()
            near = unit(rows) @ directions.T
            label = np.array([str(x) for x in batch.column("label").to_pylist()])
            near[(label[:, None] != labels[None, :]) | (own[:, None] == ids[None, :])] = -2
            row, query = np.nonzero(near >= link - 1e-9)
            sure = cosines(rows[row], vectors[query]) >= link
            np.add.at(count, query[sure], 1)
        yield {"node": ids, "truth": count}

    truth = map_batches(nodes.select("node", "label", "v"), run, "node long, truth long")
    truth = truth.groupBy("node").agg(F.sum("truth").alias("truth")).filter("truth > 0")
    got = found.groupBy("node").agg(F.sum("found").alias("got"))
    both = truth.join(got, "node", "left").select(
        "truth", F.least("truth", F.coalesce("got", F.lit(0))).alias("got")
    )
    total = both.agg(F.sum("truth").alias("truth"), F.sum("got").alias("got")).first()
    return 1.0 if not total["truth"] else total["got"] / total["truth"]


def searched(nodes: DataFrame, link: float = LINK) -> tuple[DataFrame, float]:
    """Links by an index whose audited recall is good, or the best of ``TRIES``; and that recall."""
    overlap = OVERLAP
    for left in range(TRIES, 0, -1):
        found = store(linked(nodes, link, overlap))
        recall = audit(nodes, found, link)
        if recall >= RECALL or left == 1:
            return found, recall
        overlap *= 2


def near_duplicates(embeddings: DataFrame, link: float = LINK) -> DataFrame:
    """(vec_id, n_links, component_id, kept, recall) of every row of (vec_id, embedding, label)."""
    rows = embeddings.select(
        F.col("vec_id").cast("long").alias("vec_id"), "label", F.col("embedding").cast("array<double>").alias("v")
    )
    comparable = F.col("label").isNotNull() & is_finite(F.col("v")) & F.coalesce(
        F.exists("v", lambda x: x != 0), F.lit(False)
    )
    good = rows.filter(comparable)
    one_length(good)
    keyed = good.withColumns({"a": F.xxhash64("label", "v"), "b": F.xxhash64(F.lit(17), "v", "label")})
    nodes = nodes_of(keyed)
    found, recall = searched(nodes, link)
    groups = components(found.select(F.col("node").alias("a"), F.col("root").alias("b")))
    groups = store(groups.join(nodes.select("node", "first_id"), "node"))
    names = groups.groupBy("component").agg(F.min("first_id").alias("component_id"))
    named = groups.join(names, "component").select("node", "component_id")
    links = found.groupBy("node").agg(F.sum("links").alias("links"))
    key = F.concat_ws(":", *[F.col(c).cast("string") for c in ("label", "a", "b")]).alias("_key")
    many = store(
        nodes.join(links, "node", "left")
        .join(named, "node", "left")
        .filter((F.col("n") > 1) | F.col("links").isNotNull())
        .select(
            key,
            (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("n_links"),
            F.coalesce("component_id", "first_id").alias("component_id"),
            F.col("n").alias("n_rows"),
        )
    )
    usable = keyed.select("vec_id", key)
    joined = salted_join(
        usable.withColumn("_row", F.monotonically_increasing_id()), many.drop("n_rows"), "_key",
        ["_row"], many.select("_key", "n_rows"), how="left",
    ).select(
        "vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        F.when(F.col("n_links").isNull(), F.col("vec_id")).otherwise(F.col("component_id")).alias("component_id"),
    )
    alone = rows.filter(~comparable).select(
        "vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id")
    )
    return joined.unionByName(alone).select(
        "vec_id", "n_links", "component_id", F.col("vec_id").eqNullSafe(F.col("component_id")).alias("kept"),
        F.lit(recall).alias("recall"),
    )


def op11_near_dedup(embeddings: DataFrame) -> DataFrame:
    return near_duplicates(embeddings)
