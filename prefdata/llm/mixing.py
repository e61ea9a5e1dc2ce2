"""Mixing sources to target weights as a min-cost flow.

Documents are added up by membership pattern (the set of sources they belong to). Each
pattern can give its words to any of its sources: a first copy at a low cost a word and
further copies at rising costs, each up to the pattern's words. Each source takes up to its
target. The cheapest flow of the greatest amount says how many words of each copy a pattern
gives; documents are then chosen in a seeded order until the words are reached, whole
documents only, the last one if that comes closer.

Only sums per pattern enter the flow. Patterns that share no source, even through others,
are separate problems, solved in separate tasks; no document passes through them.

Defined cases: a null text has size 0 and is taken 0 times; a null source is a source of its
own, last in the order; the order goes by doc_id (null or not) and text, so rows that are equal in both
count each and are taken alike; an empty table gives an empty result; a document without sources
is never taken; other columns are kept (``mixed``) or not looked at, whatever their names.
"""

from __future__ import annotations

import heapq

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from prefdata.llm.common import components, map_batches, store, text_bytes

WEIGHTS = (3, 1, 2)
TOTAL_SHARE = 1.5
COPY_COSTS = (1, 4)  # cost a word of the first and second copy; convex
SEED = 17
STEP = 12  # bits of the seeded order that a bucket adds
EDGE_ROWS = 100_000  # rows of a bucket that are ranked one by one, at most


def with_size(docs: DataFrame, columns: list[str]) -> DataFrame:
    """``columns`` (column name: kept) and ``size``, the number of words of ``text``."""

    def count(batches):
        for batch in batches:
            sizes = [len(t.split()) for t in batch.column("_text").to_pylist()]
            yield {c: batch.column(c) for c in columns} | {"size": sizes}

    slim = docs.select(*columns, text_bytes().alias("_text"))
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in slim.schema if f.name != "_text")
    return map_batches(slim, count, f"{kinds}, size long")


def ranked(keys: DataFrame, key: str) -> DataFrame:
    """``keys`` with ``rank`` from 0 in the order of ``key``, nulls last.

    Ranges of the order are numbered on their own and moved by what comes before, so no
    task holds all keys. One count per range is collected.
    """
    spread = keys.repartitionByRange(F.col(key).asc_nulls_last())
    inside = Window.partitionBy("_part").orderBy(F.col(key).asc_nulls_last())
    parts = store(
        spread.withColumn("_part", F.spark_partition_id()).withColumn(
            "_inside", F.row_number().over(inside) - 1
        )
    )
    sizes = sorted((r["_part"], r["count"]) for r in parts.groupBy("_part").count().collect())
    start, starts = 0, []
    for part, n in sizes:
        starts.append((part, start))
        start += n
    if not starts:
        return parts.withColumn("rank", F.col("_inside").cast("long")).drop("_part", "_inside")
    before = F.create_map(*[F.lit(x) for pair in starts for x in pair])
    return parts.withColumn("rank", (before[F.col("_part")] + F.col("_inside")).cast("long")).drop(
        "_part", "_inside"
    )


def targets(sources: DataFrame, weights=WEIGHTS, share: float = TOTAL_SHARE, most: float = 2.0) -> DataFrame:
    """(source, source_size, target) from (source, source_size): words that each source should give.

    Weights repeat in the order of the sources. A target above ``most`` times its source's
    size stops there, and what is left is shared by weight among the others, until none is above.
    """
    n = len(weights)
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("rank") % n + 1).cast("int"))
    rows = store(ranked(sources, "source").withColumn("weight", weight).withColumn(
        "most", F.col("source_size") * F.lit(float(most))
    ))
    total = (rows.agg(F.sum("source_size")).first()[0] or 0) * share
    level = 0.0
    while True:
        # One row: the words of the sources that are full at this level, and the others' weights.
        full = F.col("weight") * level > F.col("most")
        row = rows.agg(
            F.sum(F.when(full, F.col("most")).otherwise(0.0)), F.sum(F.when(full, 0.0).otherwise(F.col("weight")))
        ).first()
        if not row[1]:
            break
        higher = (total - row[0]) / row[1]
        if higher <= level:
            break
        level = higher
    return rows.select(
        "source", "source_size", F.least(F.col("weight") * level, F.col("most")).alias("target")
    )


def route(patterns: dict[int, tuple[int, list[int]]], wanted: dict[int, float], costs=COPY_COSTS):
    """Cheapest flow of the greatest amount from patterns to sources.

    ``patterns``: pattern -> (words, its sources); ``wanted``: source -> words. Returns words
    by (pattern, source, copy). Successive shortest paths with potentials: path costs are the copies' costs.
    """
    start, end = 0, 1
    node: dict = {}
    edges: list[list] = []  # [to, capacity, cost]; the edge back is the neighbour in the list
    out: list[list[int]] = [[], []]

    def at(key):
        if key not in node:
            node[key] = len(out)
            out.append([])
        return node[key]

    def join(a, b, capacity, cost):
        out[a].append(len(edges))
        edges.append([b, capacity, cost])
        out[b].append(len(edges))
        edges.append([a, 0, -cost])

    arcs = []
    for p, (words, into) in sorted(patterns.items()):
        for copy, cost in enumerate(costs):
            join(start, at(("copy", p, copy)), words, cost)
            for s in sorted(into):
                if s in wanted:
                    arcs.append((p, s, copy, len(edges)))
                    join(at(("copy", p, copy)), at(("source", s)), words, 0)
    for s, words in sorted(wanted.items()):
        join(at(("source", s)), end, round(words), 0)
    potential = [0] * len(out)
    while True:
        far = [None] * len(out)
        far[start], via, queue = 0, {}, [(0, start)]
        while queue:
            d, a = heapq.heappop(queue)
            if d > far[a]:
                continue
            for e in out[a]:
                b, capacity, cost = edges[e]
                reach = d + cost + potential[a] - potential[b]
                if capacity > 0 and (far[b] is None or reach < far[b]):
                    far[b], via[b] = reach, e
                    heapq.heappush(queue, (reach, b))
        if far[end] is None:
            break
        potential = [p + (f if f is not None else far[end]) for p, f in zip(potential, far)]
        path, a = [], end
        while a != start:
            path.append(via[a])
            a = edges[via[a] ^ 1][0]
        amount = min(edges[e][1] for e in path)
        for e in path:
            edges[e][1] -= amount
            edges[e ^ 1][1] += amount
    return {(p, s, copy): edges[e ^ 1][1] for p, s, copy, e in arcs if edges[e ^ 1][1]}


def flows(patterns: DataFrame, wanted: DataFrame, costs=COPY_COSTS) -> DataFrame:
    """(pattern, copy, words) from (pattern long, words, sources array<long>) and (source long, target)."""
    links = patterns.select("pattern", F.explode("sources").alias("source"))
    first = links.groupBy("pattern").agg(F.min("source").alias("b"))
    named = links.join(first, "pattern").select(F.col("source").alias("a"), "b")
    label = components(named)  # of the sources
    group = F.coalesce(F.col("component"), F.col("source"))
    given = wanted.join(label, wanted["source"] == label["node"], "left").select(
        group.alias("_group"), F.lit(True).alias("wants"), F.lit(0).cast("long").alias("pattern"),
        "source", F.col("target").cast("double").alias("amount"),
    )
    supply = links.join(label, links["source"] == label["node"], "left").join(patterns, "pattern").select(
        group.alias("_group"), F.lit(False).alias("wants"), "pattern", "source",
        F.col("words").cast("double").alias("amount"),
    )

    def solve(rows: pd.DataFrame) -> pd.DataFrame:
        want = rows[rows["wants"]]
        have: dict = {}
        for p, s, words in rows[~rows["wants"]][["pattern", "source", "amount"]].itertuples(index=False):
            have.setdefault(int(p), (int(words), []))[1].append(int(s))
        found: dict = {}
        routed = route(have, dict(zip(want["source"].astype(int), want["amount"])), costs)
        for (p, _, copy), words in routed.items():
            found[p, copy] = found.get((p, copy), 0) + words
        return pd.DataFrame(
            [(p, c, w) for (p, c), w in found.items()], columns=["pattern", "copy", "words"]
        )

    return given.unionByName(supply).groupBy("_group").applyInPandas(
        solve, "pattern long, copy int, words long"
    )


def order_of(key: Column, seed: int = SEED) -> Column:
    """Place of a document in the seeded order, 63 bits."""
    return F.shiftrightunsigned(F.xxhash64(F.lit(seed), key), 1)


def document_key() -> Column:
    """What a document's place goes by: its id and its text. A null text is the empty text."""
    text = F.coalesce("text", F.lit(""))
    return F.xxhash64("doc_id", text, F.length(text))


def cuts(rows: DataFrame, flow: DataFrame, copies: int) -> DataFrame:
    """(pattern, cut0, cut1 ...): copy k takes the documents with an order up to cut k.

    ``rows`` are (pattern, size, _at). Words are added up per bucket of the order, a bucket for each
    value of its first ``STEP`` bits; the bucket in which a copy's words end is divided by the next
    ``STEP`` bits until it has at most ``EDGE_ROWS`` rows. Only these are ranked one by one, so neither a
    pattern with a third of all rows nor the whole table is sorted. A document is taken if half of it
    lies within the words; documents at one place are taken alike.
    """
    shift = 63 - STEP
    placed = rows.filter("size > 0").select("pattern", "size", "_at")
    bucket = F.shiftright("_at", shift)
    sums = placed.groupBy("pattern", bucket.alias("_bucket")).agg(
        F.sum("size").alias("_sum"), F.count(F.lit(1)).alias("_n")
    )
    earlier = Window.partitionBy("pattern").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    before = sums.withColumn("_before", F.coalesce(F.sum("_sum").over(earlier), F.lit(0)))
    edges = store(_ends(before.join(flow, "pattern").withColumn("_left", F.col("words"))))
    while shift > STEP and (edges.agg(F.max("_n")).first()[0] or 0) > EDGE_ROWS:
        here = placed.withColumn("_bucket", F.shiftright("_at", shift)).join(
            edges.drop("_n"), ["pattern", "_bucket"]
        )
        shift -= STEP
        parts = here.groupBy("pattern", "copy", "_left", F.shiftright("_at", shift).alias("_bucket")).agg(
            F.sum("size").alias("_sum"), F.count(F.lit(1)).alias("_n")
        )
        earlier = Window.partitionBy("pattern", "copy").orderBy("_bucket").rowsBetween(
            Window.unboundedPreceding, -1
        )
        edges = store(_ends(parts.withColumn("_before", F.coalesce(F.sum("_sum").over(earlier), F.lit(0)))))
    inside = Window.partitionBy("pattern", "copy", "_bucket").orderBy("_at").rangeBetween(
        Window.unboundedPreceding, 0
    )
    last = (
        placed.withColumn("_bucket", F.shiftright("_at", shift))
        .join(edges.drop("_n"), ["pattern", "_bucket"])
        .groupBy("pattern", "copy", "_bucket", "_left", "_at")
        .agg(F.sum("size").alias("size"))
        .withColumn("_end", F.sum("size").over(inside))
        .filter(F.col("_end") * 2 - F.col("size") <= F.col("_left") * 2)
        .groupBy("pattern", "copy")
        .agg(F.max("_at").alias("_last"))
    )
    below = F.shiftleft("_bucket", shift) - 1
    ended = edges.join(last, ["pattern", "copy"], "left").select(
        "pattern", "copy", F.coalesce("_last", below).alias("_cut")
    )
    # A copy without an edge takes all documents; one without words takes none.
    return (
        flow.join(ended, ["pattern", "copy"], "left")
        .withColumn("_cut", F.coalesce("_cut", F.lit((1 << 63) - 1)))
        .groupBy("pattern")
        .agg(
            *[
                F.coalesce(F.max(F.when(F.col("copy") == k, F.col("_cut"))), F.lit(-1)).alias(f"cut{k}")
                for k in range(copies)
            ]
        )
    )


def _ends(buckets: DataFrame) -> DataFrame:
    """The bucket in which each copy's words end, and the words left for it."""
    return buckets.filter("_before <= _left and _left < _before + _sum").select(
        "pattern", "copy", "_bucket", (F.col("_left") - F.col("_before")).alias("_left"), "_n"
    )


def plan(
    sized: DataFrame, weights=WEIGHTS, share: float = TOTAL_SHARE, costs=COPY_COSTS, seed: int = SEED
) -> tuple[DataFrame, DataFrame]:
    """Cuts per pattern, and the sources' sizes and targets.

    ``sized`` has (key, size, sources array<string>). A document of several sources counts in
    the size of each. The first result is (sources, cut0, cut1 ...), a row per pattern.
    """
    by_pattern = store(sized.groupBy("sources").agg(F.sum("size").alias("words")))
    per_source = (
        by_pattern.select(F.explode("sources").alias("source"), "words")
        .groupBy("source")
        .agg(F.sum("words").alias("source_size"))
    )
    goal = store(targets(per_source, weights, share, float(len(costs))))
    numbered = store(ranked(goal, "source").select("source", F.col("rank").alias("_no"), "target"))
    pattern = F.xxhash64(F.to_json("sources"))
    # Sources by number; a null source is equal to a null source.
    exploded = by_pattern.select(pattern.alias("pattern"), "words", F.explode("sources").alias("_name"))
    by_number = store(
        exploded.join(numbered, exploded["_name"].eqNullSafe(numbered["source"]))
        .groupBy("pattern", "words")
        .agg(F.collect_set("_no").alias("sources"))
    )
    flow = store(flows(by_number, numbered.select(F.col("_no").alias("source"), "target"), costs))
    rows = sized.select(pattern.alias("pattern"), "size", order_of(F.col("key"), seed).alias("_at"))
    ends = cuts(rows, flow, len(costs))
    names = by_pattern.select(pattern.alias("pattern"), "sources")
    return store(names.join(ends, "pattern").drop("pattern")), goal


def copies_taken(copies: int, key: Column, seed: int = SEED) -> Column:
    """How often a document is taken, next to its pattern's cuts."""
    at = order_of(key, seed)
    return sum((at <= F.col(f"cut{k}")).cast("int") for k in range(copies))


def _one_source(docs: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Sized documents of one source each, and what ``plan`` says of them."""
    slim = docs.select("doc_id", "text", "source", document_key().alias("key"))
    sized = store(with_size(slim, ["doc_id", "source", "key"]))
    ends, goal = plan(sized.select("key", "size", F.array("source").alias("sources")))
    return sized, ends.withColumn("_source", F.col("sources")[0]).drop("sources"), goal


def op9_mixing(docs: DataFrame) -> DataFrame:
    """(doc_id, size, source_size, target, taken) of every document, one source each."""
    sized, ends, goal = _one_source(docs)
    goal = goal.withColumnRenamed("source", "_named")
    facts = store(
        goal.join(ends, goal["_named"].eqNullSafe(ends["_source"]), "left").drop("_source")
    )
    copies = F.coalesce(copies_taken(len(COPY_COSTS), F.col("key")), F.lit(0))
    return sized.join(facts, sized["source"].eqNullSafe(facts["_named"])).select(
        "doc_id",
        "size",
        "source_size",
        "target",
        (copies * F.col("size")).cast("long").alias("taken"),
        "source",
    )


def mixed(docs: DataFrame) -> DataFrame:
    """The documents that the mix takes, with the columns they had; twice where it takes two copies.

    A document without words is not taken. The join brings two numbers per source; no text
    is shuffled while the sources are few.
    """
    _, ends, _ = _one_source(docs)
    has_words = F.length(F.regexp_replace("text", r"[\x20\x09-\x0D]", "")) > 0
    rows = docs.filter(has_words).select(
        F.struct("*").alias("doc"), F.col("source").alias("_named"),
        document_key().alias("_key"),
    )
    joined = rows.join(ends, rows["_named"].eqNullSafe(ends["_source"]))
    return (
        joined.withColumn("_copies", copies_taken(len(COPY_COSTS), F.col("_key")))
        .filter("_copies > 0")
        .withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("_copies"))))
        .select("doc.*")
    )
