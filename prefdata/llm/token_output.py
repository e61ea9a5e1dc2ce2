"""Packed id matrices by best-fit-decreasing with a segment tree over capacities.

Documents are turned into ids, cut losslessly where they are longer than a row, and packed longest
first into the open row with the least room that fits. A segment tree over the room
left (leaf: how many open rows have that room) finds it in log2(row length) steps. A row
comes out as its ids, the cumulative lengths of its segments (from 0) and position ids
that start anew at each segment.

A task packs what it reads in blocks of ``BLOCK_IDS`` ids, so ids are never shuffled and a
block bounds the memory; each block ends with a few rows that have room left.

Defined cases: a null text is the empty text (the end id alone); a null doc_id is kept as null;
repeated rows are packed each; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import zlib

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from prefdata.llm.common import map_batches, text_bytes
from prefdata.llm.tokens import WordTokens, pieces, tokenizer_path

CAPACITY = 2048
BLOCK_IDS = 8_000_000
ROWS_AT_ONCE = 500


class RoomTree:
    """Number of open rows per room left, with search for the least room that fits."""

    def __init__(self, capacity: int):
        self.leaves = 1 << capacity.bit_length()
        self.count = [0] * (2 * self.leaves)

    def add(self, room: int, n: int) -> None:
        at = self.leaves + room
        while at:
            self.count[at] += n
            at >>= 1

    def least(self, size: int) -> int | None:
        """The least room of at least ``size`` that some row has."""
        at = self.leaves + size
        if self.count[at]:
            return size
        while at > 1:
            if not at & 1 and self.count[at + 1]:
                at += 1
                while at < self.leaves:
                    at = 2 * at if self.count[2 * at] else 2 * at + 1
                return at - self.leaves
            at >>= 1
        return None


def best_fit_decreasing(lengths: list[int], capacity: int) -> list[list[int]]:
    """Members of each row, in the order in which they lie there."""
    tree, rows, with_room = RoomTree(capacity), [], [[] for _ in range(capacity + 1)]
    for item in sorted(range(len(lengths)), key=lambda i: -lengths[i]):
        size = lengths[item]
        room = tree.least(size)
        if room is None:
            rows.append([item])
            row, left = len(rows) - 1, capacity - size
        else:
            row, left = with_room[room].pop(), room - size
            tree.add(room, -1)
            rows[row].append(item)
        if left:
            with_room[left].append(row)
            tree.add(left, 1)
    return rows


def positions(lengths: list[int]) -> np.ndarray:
    """Position ids that start from 0 in each segment."""
    return np.concatenate([np.arange(n, dtype=np.int32) for n in lengths] or [np.zeros(0, np.int32)])


SCHEMA = (
    "block string, row_no int, doc_ids array<long>, pieces array<int>, starts array<long>, "
    "cu_seqlens array<int>, position_resets array<int>, length int, ids_crc32 long, ids binary"
)


def id_type(path: str) -> str:
    """The smallest unsigned type that holds all ids of a vocabulary."""
    from tokenizers import Tokenizer

    return "<u2" if Tokenizer.from_file(path).get_vocab_size() <= 1 << 16 else "<u4"


def packed_rows(docs: DataFrame, capacity: int = CAPACITY, path: str | None = None) -> DataFrame:
    """One row per packed row of the matrix; see ``SCHEMA``. (block, row_no) names it.

    ``ids`` are little-endian numbers of ``id_type(path)``, ``ids_crc32`` is taken of them as
    uint32; ``cu_seqlens`` are the segments' ends, from 0;
    ``position_resets`` are the places at which the position ids start from 0 again.
    """
    path = path or tokenizer_path()
    kind = id_type(path)

    def pack(held: list[tuple]):
        lengths = [len(ids) // 4 for _, _, _, ids in held]
        name = f"{min(str(h[0]) for h in held)}-{zlib.crc32(b''.join(str(h[:3]).encode() for h in held)):08x}"
        out: list[tuple] = []
        for number, members in enumerate(best_fit_decreasing(lengths, capacity)):
            ids = b"".join(held[i][3] for i in members)
            ends = np.cumsum([0] + [lengths[i] for i in members]).tolist()
            out.append(
                (
                    name, number, [held[i][0] for i in members], [held[i][1] for i in members],
                    [held[i][2] for i in members], ends, ends[:-1], ends[-1], zlib.crc32(ids),
                    np.frombuffer(ids, "<u4").astype(kind).tobytes(),
                )
            )
            if len(out) == ROWS_AT_ONCE:
                yield dict(zip(_NAMES, zip(*out)))
                out.clear()
        if out:
            yield dict(zip(_NAMES, zip(*out)))

    def run(batches):
        words, held, n = WordTokens(path), [], 0
        for batch in batches:
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()):
                ids = words.of(text)
                held.extend((doc_id, *piece) for piece in pieces(ids, capacity))
                n += len(ids) // 4
                if n >= BLOCK_IDS:
                    yield from pack(held)
                    held, n = [], 0
        if held:
            yield from pack(held)

    return map_batches(docs.select("doc_id", text_bytes().alias("text")), run, SCHEMA)


_NAMES = [part.split()[0] for part in SCHEMA.split(", ")]


def write_packed(docs: DataFrame, path: str, capacity: int = CAPACITY, tokenizer: str | None = None) -> None:
    """Packed rows as Parquet files: ``ids`` as binary, padded with 0 to the full row."""
    width = np.dtype(id_type(tokenizer or tokenizer_path())).itemsize
    full = F.rpad("ids", width * capacity, F.lit(b"\x00"))
    packed_rows(docs, capacity, tokenizer).withColumn("ids", full).write.parquet(path)


def op5_token_output(docs: DataFrame) -> DataFrame:
    return packed_rows(docs)
