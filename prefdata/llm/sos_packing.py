"""Sum-of-squares packing of documents into sequences.

The packer keeps N(g), the number of open sequences with a gap of g ids. A document goes where the
sum of N(g)^2 becomes smallest: into a gap that is frequent and leaves a gap that is rare, or
exactly none. This keeps gaps of all sizes in stock, so that later documents find a fit.
Documents come longest first within blocks of the input; when a block is through, the few
sequences still open are emptied into each other's gaps as far as that goes.

Documents longer than a sequence are cut losslessly. Placing needs lengths only, so no ids are
shuffled. The lengths are dealt into packs by a hash of the document and of the number that a
piece got when it was stored; a pack fits into one task whatever the size of the corpus and
however often an id is repeated or null, and each pack ends with a part of a sequence.

Defined cases: a null text is the empty text, which has the end id alone; a null doc_id is a
document as any other; repeated rows are packed each, ties in their order as stored; an empty table
gives an empty result; other columns are not looked at.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from prefdata.llm.common import parts_for, salt, store
from prefdata.llm.tokens import token_pieces

CAPACITY = 2048
PACK_ROWS = 150_000  # pieces in a pack, about


def pack(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Sequence and offset of each length (1 .. capacity)."""
    n = len(lengths)
    sequence, offset = np.zeros(n, np.int64), np.zeros(n, np.int64)
    stock = np.zeros(capacity + 1, np.int64)  # N(g); full sequences are not counted
    open_with: list[list[int]] = [[] for _ in range(capacity + 1)]
    members: list[list[int]] = []
    opened = 0
    order = np.argsort(-lengths, kind="stable")
    for item in order.tolist():
        size = int(lengths[item])
        gap = _best_gap(stock, size, capacity)
        if gap is None:
            number, gap = opened, capacity
            opened += 1
            members.append([])
        else:
            number = open_with[gap].pop()
            stock[gap] -= 1
        members[number].append(item)
        left = gap - size
        if left:
            stock[left] += 1
            open_with[left].append(number)
    _empty_into_gaps(lengths, members, open_with, capacity)
    kept = 0
    for own in members:
        if own:
            at = 0
            for item in own:
                sequence[item], offset[item] = kept, at
                at += int(lengths[item])
            kept += 1
    return sequence, offset


def _best_gap(stock: np.ndarray, size: int, capacity: int) -> int | None:
    """The gap whose use makes the sum of squares smallest; None for a new sequence."""
    fits = stock[size:]
    some = np.flatnonzero(fits)
    if not len(some):
        return None
    # Taking gap g changes the sum by 1 - 2 N(g), leaving g - size by 2 N(g - size) + 1.
    change = 2 - 2 * fits[some] + 2 * stock[some]
    if some[0] == 0:
        change[0] = 1 - 2 * fits[0]  # a full sequence leaves no gap
    best = int(np.argmin(change))
    fresh = 2 * stock[capacity - size] + 1 if size < capacity else 0
    return None if fresh < change[best] else size + int(some[best])


def _empty_into_gaps(lengths, members, open_with, capacity) -> None:
    """Move the documents of the emptiest open sequences into the gaps of others, best fit."""
    stock = np.array([len(x) for x in open_with])
    for gap in range(capacity, 0, -1):
        for number in list(open_with[gap]):
            if gap == capacity or number not in open_with[gap]:
                continue
            open_with[gap].remove(number)
            stock[gap] -= 1
            moves = []
            for item in sorted(members[number], key=lambda i: -lengths[i]):
                size = int(lengths[item])
                where = np.flatnonzero(stock[size:])
                if not len(where):
                    break
                old = size + int(where[0])
                other = open_with[old].pop()
                stock[old] -= 1
                new = old - size
                if new:
                    open_with[new].append(other)
                    stock[new] += 1
                moves.append((item, other, old, new))
            if len(moves) == len(members[number]):
                members[number] = []
                for item, other, _, _ in moves:
                    members[other].append(item)
            else:
                for _, other, old, new in reversed(moves):
                    if new:
                        open_with[new].remove(other)
                        stock[new] -= 1
                    open_with[old].append(other)
                    stock[old] += 1
                open_with[gap].append(number)
                stock[gap] += 1
                return


def place(found: DataFrame, capacity: int = CAPACITY, pack_rows: int = PACK_ROWS) -> DataFrame:
    """``found`` (pieces) with ``sequence_id`` and ``offset``."""
    found = store(found.withColumn("_row", F.monotonically_increasing_id()))
    packs = parts_for(found.count(), pack_rows)
    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in found.schema if f.name != "_row")

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["doc_id", "piece", "ids_crc32", "_row"], ignore_index=True)
        number = int(rows["_pack"].iloc[0]) if len(rows) else 0
        sequence, offset = pack(rows["length"].to_numpy(), capacity)
        rows["sequence_id"], rows["offset"] = sequence * packs + number, offset
        return rows.drop(columns=["_pack", "_row"])

    dealt = found.withColumn("_pack", salt(F.struct("doc_id", "piece", "_row"), packs))
    return dealt.groupBy("_pack").applyInPandas(run, f"{kinds}, sequence_id long, offset long")


def packed(docs: DataFrame, capacity: int = CAPACITY, path: str | None = None) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32, sequence_id, offset) of every piece."""
    return place(token_pieces(docs, capacity, path), capacity)


def op4_packing(docs: DataFrame) -> DataFrame:
    return packed(docs)
