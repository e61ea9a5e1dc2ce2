"""Language-model scores from an n-gram trie in Elias-Fano form.

The model is a Bayesian mixture over orders: with c the training count of a context,
p(w | context) = (c(context w) + M p(w | shorter context)) / (c(context) + M), down to the base
distribution over words with 0.1 added to each count. All n-grams of the training texts count.

The trie is cut into shards by a hash of the context. A shard has two levels: its contexts, and
below them their next words. Contexts are a rising sequence of hashes, the pointers to their
ranges another, and the next words a third: each is the word's rank in the shard plus what lies
before its context, which makes the whole level rise. All three are Elias-Fano coded. Beside each
next word lies the quantised logarithm of its share c(context w) / (c(context) + M), rounded down. A lookup finds
the context, takes its range from the pointers and searches the successor of the word's
rank relative to the context's base, all on the coded levels as they lie in the shard's image.

Texts are read in blocks, which stay in the buckets where they are stored. A block asks each shard once for its distinct n-grams, with how often
its training texts have them; the shard adds these up, builds its part of the trie and answers
from it; a block has rows for the shards that it asks, and no others. Rows between them are packed
arrays, so an n-gram costs a few bytes: a shard has a range of the contexts' hashes, so that a block sends the steps
between them, which are as small for many shards as for few. The few contexts with a large share of all tokens (words, and
the n-grams that the level below found frequent) are spread over shards by the next word.

Defined cases: a null text is the empty text, which is an end alone; a null doc_id counts as the
empty text in the fold; rows repeated count each; without training texts every token has an
equal chance; an empty table gives no rows; other columns are not looked at. Words are told
apart by 64-bit hashes, next words within a context by 40 bits of them.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from prefdata.llm.common import (
    WordHashes, among, clear_shuffles, crc_fold, finish, map_batches, packed, packed_rising, parts_for, store, text_bytes, unpacked,
    unpacked_rising,
)
from prefdata.sources.buckets import bucket_count, write_rows

ORDER = 3
MASS = 4.0  # M: weight of the shorter context, in counts
ADDED = 0.1  # added to each count of the base distribution
HELD_OUT = 10  # texts whose crc32(doc_id) is 0 modulo this don't train
BLOCK_TOKENS = 1_000_000
SHARD_TOKENS = 2_000_000  # tokens per shard, about
FREQUENT = 1000  # a context with more than 1/FREQUENT of all tokens is spread over shards
FEW_WORDS = 1000  # next words that are not numbered
QUANTUM = 2e-4  # step of a quantised log10 share; 16 bits reach down to 10**-13

_START = np.uint64(xxhash.xxh3_64_intdigest(b"\x00 start"))
_END = np.uint64(xxhash.xxh3_64_intdigest(b"\x00 end"))


# --- Elias-Fano levels -------------------------------------------------------------------


class EliasFano:
    """A rising sequence of unsigned numbers: low bits in planes of a byte and the rest bit by bit, high bits in unary.

    It is searched as it is coded. Where a high part begins is the place of a zero among the unary bits, found
    by counts per 64 bits (the only thing that is added when the sequence is opened) and within them by
    byte; the numbers with that high part follow up to the next zero, and their low bits are searched by halves,
    as the next words of one context can all have the same high part.
    """

    def __init__(self, n: int, low_bits: int, low: np.ndarray, high: np.ndarray):
        self.n, self.low_bits, self.low, self.high = n, low_bits, low, high
        self._counts: dict[bool, np.ndarray] = {}

    @classmethod
    def of(cls, values: np.ndarray) -> EliasFano:
        values = values.astype(np.uint64)
        n = len(values)
        top = int(values[-1]) if n else 0
        low_bits = max(0, (top // max(n, 1)).bit_length() - 1) if top >= n else 0
        whole = low_bits // 8
        planes = [(values >> np.uint64(8 * k)).astype(np.uint8) for k in range(whole)]
        planes += [
            np.packbits(((values >> np.uint64(k)) & np.uint64(1)).astype(np.uint8)) for k in range(8 * whole, low_bits)
        ]
        low = np.concatenate(planes) if planes else _NONE
        ones = (values >> np.uint64(low_bits)).astype(np.int64) + np.arange(n)
        bits = np.zeros((int(ones[-1]) // 64 + 1) * 64 if n else 0, np.uint8)
        bits[ones] = 1
        return cls(n, low_bits, low, np.packbits(bits))

    def values(self) -> np.ndarray:
        """The sequence, from the two bit arrays."""
        high = np.flatnonzero(np.unpackbits(self.high))[: self.n] - np.arange(self.n)
        return high.astype(np.uint64) << np.uint64(self.low_bits) | self._lows(np.arange(self.n))

    def parts(self) -> list[np.ndarray]:
        return [np.array([self.n, self.low_bits], np.int64), self.low, self.high]

    def _select(self, k: np.ndarray, ones: bool) -> np.ndarray:
        """The place of the kth one, or zero, among the unary bits; k counts from 0."""
        if ones not in self._counts:
            found = np.bitwise_count(self.high.view(np.uint64)).astype(np.int64)
            self._counts[ones] = np.cumsum(found if ones else 64 - found)
        before = self._counts[ones]
        word = np.searchsorted(before, k, "right")
        left = (k - np.where(word > 0, before[word - 1], 0)).astype(np.uint8)
        bits = self.high.view(">u8")[word].astype(np.uint64)
        bits = bits if ones else ~bits
        place = np.zeros(len(k), np.uint8)
        # Halves of the word, of its half and of its quarter: the place lies in the first or behind it.
        for width in (32, 16, 8):
            count = np.bitwise_count(bits >> np.uint64(64 - width))
            behind = left >= count
            left -= count * behind
            step = behind * np.uint8(width)
            place += step
            bits <<= step.astype(np.uint64)
        return word * 64 + place + _PLACE[(bits >> np.uint64(56)).astype(np.int64), left]

    def _lows(self, at: np.ndarray) -> np.ndarray:
        """The low bits of the numbers at these places."""
        out, whole = np.zeros(len(at), np.uint64), self.low_bits // 8
        for k in range(whole):
            out |= self.low[k * self.n : (k + 1) * self.n][at].astype(np.uint64) << np.uint64(8 * k)
        if self.low_bits % 8:
            byte, shift = at >> 3, (7 - (at & 7)).astype(np.uint8)
            rest = np.zeros(len(at), np.uint8)
            for k, plane in enumerate(self.low[whole * self.n :].reshape(self.low_bits % 8, -1)):
                rest |= ((plane[byte] >> shift) & np.uint8(1)) << np.uint8(k)
            out |= rest.astype(np.uint64) << np.uint64(8 * whole)
        return out

    def at(self, places: np.ndarray) -> np.ndarray:
        """The numbers at these places."""
        high = (self._select(places, True) - places).astype(np.uint64)
        return high << np.uint64(self.low_bits) | self._lows(places)

    def find(self, wanted: np.ndarray) -> np.ndarray:
        """The place of each wanted number, -1 where the sequence has none: its successor is another."""
        found = np.full(len(wanted), -1, np.int64)
        if not self.n or not len(wanted):
            return found
        high = (wanted >> np.uint64(self.low_bits)).astype(np.int64)
        low = wanted & np.uint64((1 << self.low_bits) - 1)
        last = int(self.at(np.array([self.n - 1]))[0]) >> self.low_bits
        open_ = np.flatnonzero((high >= 0) & (high <= last))
        # The numbers with a high part h lie between the zeros number h - 1 and h; none is asked for behind the last.
        known, which = _distinct(high[open_])
        inner = _distinct(np.sort(np.concatenate([known, known + 1])))[0]
        edge = np.where(inner > last, self.n, 0)
        within = np.flatnonzero((inner > 0) & (inner <= last))
        edge[within] = self._select(inner[within] - 1, False) + 1 - inner[within]
        first = edge[np.searchsorted(inner, known)][which]
        end = edge[np.searchsorted(inner, known + 1)][which]
        while len(open_):
            some = first < end
            open_, first, end = open_[some], first[some], end[some]
            middle = (first + end) >> 1
            own, asked = self._lows(middle), low[open_]
            hit = own == asked
            found[open_[hit]] = middle[hit]
            below = own < asked
            first, end = np.where(below, middle + 1, first), np.where(below, end, middle)
            open_, first, end = open_[~hit], first[~hit], end[~hit]
        return found


_NONE = np.zeros(0, np.uint8)
# The place of the kth one in a byte, from its highest bit.
_PLACE = np.zeros((256, 8), np.int64)
for _byte in range(256):
    _ones = [i for i in range(8) if _byte >> (7 - i) & 1]
    _PLACE[_byte, : len(_ones)] = _ones


class Trie:
    """A shard of the model: contexts, pointers, next words and quantised shares."""

    KINDS = (np.int64, np.uint8, np.uint8) * 4 + (np.uint16,)

    def __init__(self, contexts, pointers, words, below, codes):
        self.levels = contexts, pointers, words, below
        self.codes = codes

    @classmethod
    def build(cls, context: np.ndarray, word: np.ndarray, share: np.ndarray) -> Trie:
        """From distinct (context, word) in rising order, and log10 of their shares."""
        start = np.flatnonzero(_new(context)) if len(context) else np.zeros(0, np.int64)
        known = context[start]
        words, rank = np.unique(word, return_inverse=True)
        pointers = np.append(start, len(context))
        place = np.repeat(np.arange(len(known)), np.diff(pointers))
        below = place * len(words) + rank
        codes = np.clip(np.ceil(-share / QUANTUM), 0, 65535).astype(np.uint16)  # never above the share
        return cls(*(EliasFano.of(x) for x in (known, pointers, words, below)), codes)

    def image(self) -> bytes:
        """The levels one after another, each behind its size; can be mapped as it is."""
        out = []
        for part in [p for level in self.levels for p in level.parts()] + [self.codes]:
            raw = part.tobytes()
            raw += b"\0" * (-len(raw) % 8)
            out += [np.array([part.size, len(raw)], np.int64).tobytes(), raw]
        return b"".join(out)

    @classmethod
    def open(cls, image) -> Trie:
        """From bytes or any mapped buffer, without copying it."""
        parts, at = [], 0
        for kind in cls.KINDS:
            size, length = np.frombuffer(image, np.int64, 2, at)
            parts.append(np.frombuffer(image, kind, int(size), at + 16))
            at += 16 + int(length)
        levels = [EliasFano(int(p[0]), int(p[1]), low, high) for p, low, high in zip(*[iter(parts[:12])] * 3)]
        return cls(*levels, parts[12])

    def shares(self, context: np.ndarray, word: np.ndarray) -> np.ndarray:
        """log10 of the share of each (context, word); -inf where the trie has none.

        Each context is looked up once, and so is each word; the search for a next word is one for the
        successor of its rank behind its context's base, within the range that the pointers give.
        """
        contexts, pointers, words, below = self.levels
        out = np.full(len(context), -np.inf)
        if not contexts.n or not len(context):
            return out
        known, which = _distinct(context)
        place = contexts.find(known)
        inside = np.maximum(place, 0)
        ends, _ = _distinct(np.sort(np.concatenate([inside, inside + 1])))
        at = pointers.at(ends).astype(np.int64)
        first, last = at[np.searchsorted(ends, inside)], at[np.searchsorted(ends, inside + 1)]
        names, number = np.unique(word, return_inverse=True)
        rank = words.find(names)
        ok = np.flatnonzero((place[which] >= 0) & (rank[number] >= 0))
        base = place[which[ok]] * words.n
        at = below.find((base + rank[number[ok]]).astype(np.uint64))
        hit = (at >= first[which[ok]]) & (at < last[which[ok]])
        out[ok[hit]] = -QUANTUM * self.codes[at[hit]]
        return out


# --- blocks of texts ---------------------------------------------------------------------


def _blocks(docs: DataFrame) -> DataFrame:
    """Texts as numbers: (block, ids, held, sizes, words, tokens), about ``BLOCK_TOKENS`` in a row."""

    def run(batches):
        hashes = WordHashes()
        local = _Numbers()
        ids, held, sizes, tokens = [], [], [], []
        n = 0

        def block():
            # Frequent words get small numbers, which the files store well; equally frequent ones rise.
            token = np.concatenate(tokens)
            word = np.append(hashes.of(list(local)), _END)
            token[token < 0] = len(local)
            order = np.lexsort((word, -np.bincount(token)))
            new = np.empty(len(order), np.uint32)
            new[order] = np.arange(len(order), dtype=np.uint32)
            name = xxhash.xxh3_64_intdigest(np.array([n, *(i or 0 for i in ids)], np.int64).tobytes())
            whole = new[token]
            return {
                "block": [np.uint64(name).astype(np.int64)],
                "ids": [list(ids)],
                "held": [list(held)],
                "sizes": [list(sizes)],
                "words": [packed_rising(word[order])],
                "low": [whole.astype("<u2").tobytes()],
                "high": [(whole >> 16).astype("<u2").tobytes()],
            }

        for batch in batches:
            columns = (batch.column(c).to_pylist() for c in ("doc_id", "held_out", "text"))
            for doc_id, held_out, text in zip(*columns):
                words = text.lower().split()
                found = np.empty(len(words) + 1, np.int32)
                found[:-1] = np.fromiter(map(local.__getitem__, words), np.int32, len(words))
                found[-1] = -1
                ids.append(doc_id)
                held.append(held_out)
                sizes.append(len(found))
                tokens.append(found)
                n += len(found)
                if n >= BLOCK_TOKENS:
                    yield block()
                    local.clear()
                    for x in (ids, held, sizes, tokens):
                        x.clear()
                    n = 0
        if n:
            yield block()

    slim = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        (crc_fold("doc_id", HELD_OUT) == 0).alias("held_out"),
        text_bytes().alias("text"),
    )
    return map_batches(
        slim,
        run,
        "block long, ids array<long>, held array<boolean>, sizes array<int>, words binary, low binary, high binary",
    )


class _Numbers(dict):
    """Numbers words as they come."""

    def __missing__(self, word: bytes) -> int:
        number = self[word] = len(self)
        return number


class _Block:
    """A row of ``_blocks``, with its distinct n-grams of an order."""

    def __init__(self, row: dict):
        self.ids, self.held = row["ids"], np.array(row["held"], bool)
        self.sizes = np.array(row["sizes"], np.int64)
        self.words = unpacked_rising(row["words"], np.uint64)
        low, high = np.frombuffer(row["low"], "<u2"), np.frombuffer(row["high"], "<u2")
        self.token = low.astype(np.int64) | high.astype(np.int64) << 16
        self.first = np.cumsum(self.sizes) - self.sizes
        self.trains = np.repeat(~self.held, self.sizes)
        self.by_word = np.argsort(_next_word(self.words), kind="stable")

    def grams(self, order: int):
        """(context hash, word hash, training count) of the distinct n-grams, and which each token ends.

        Above single words they come in the order of context and next word. At a text's beginning the context is the start and what there is after it.
        """
        if order == 1:
            word, which = self.words, self.token
            context = np.zeros(len(word), np.uint64)
        else:
            place = np.arange(len(self.token)) - np.repeat(self.first, self.sizes)
            context = np.zeros(len(self.token), np.uint64)
            for k in range(order - 1, 0, -1):
                at = np.flatnonzero(place >= k - 1)
                symbol = np.where(place[at] == k - 1, _START, self.words[self.token[at - k]])
                begins = (k == order - 1) | (place[at] < k)
                context[at] = np.where(begins, symbol, _grow(context[at], symbol))
            known, number = np.unique(context, return_inverse=True)
            rank = np.empty(len(self.words), np.int64)
            rank[self.by_word] = np.arange(len(self.words))
            distinct, which = np.unique(number * len(self.words) + rank[self.token], return_inverse=True)
            context = known[distinct // len(self.words)]
            word = self.words[self.by_word[distinct % len(self.words)]]
        count = np.bincount(which[self.trains], minlength=len(word)).astype(np.int64)
        return context, word, count, which


def _new(values: np.ndarray) -> np.ndarray:
    """Where a sorted array goes on to another value."""
    new = np.ones(len(values), bool)
    new[1:] = values[1:] != values[:-1]
    return new


def _distinct(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct values and the place of each among them; values that come sorted are not sorted again."""
    if len(values) and (values[1:] < values[:-1]).any():
        return np.unique(values, return_inverse=True)
    new = _new(values)
    return values[new], np.cumsum(new) - 1


def _next_word(word: np.ndarray) -> np.ndarray:
    """The 40 bits of a word's hash that tell the words after one context apart."""
    return word >> np.uint64(24)


def _asked(word: np.ndarray, shard: np.ndarray, order: int) -> np.ndarray:
    """The order of a block's questions: by shard, context and word. N-grams come sorted, single words don't."""
    at = np.argsort(word) if order == 1 else np.arange(len(word))
    if (np.diff(shard[at]) >= 0).all():
        return at
    return at[np.argsort(shard[at].astype(np.uint16 if shard.max(initial=0) < 1 << 16 else np.int64), kind="stable")]


def _grow(context: np.ndarray, word: np.ndarray) -> np.ndarray:
    return finish(context * np.uint64(0x9E3779B97F4A7C15) + word)


def _shards_of(context, word, shards: int, frequent: np.ndarray) -> np.ndarray:
    """Each shard has a range of the contexts, of the single words, and of the n-grams of frequent contexts."""
    key = context if context.any() else word
    if len(frequent):
        spread = np.flatnonzero(among(context, frequent))
        key = key.copy()
        key[spread] = _grow(context[spread], word[spread])
    return ((key >> np.uint64(32)) * np.uint64(shards) >> np.uint64(32)).astype(np.int64)


def _ask(blocks: DataFrame, order: int, shards: int, frequent: np.ndarray) -> DataFrame:
    """(block, shard, contexts, words, counts): each block's distinct n-grams, by shard."""

    def run(batches):
        # Row by row, as a row is as large as a task should hold.
        for row in (b.slice(k, 1).to_pylist()[0] for b in batches for k in range(b.num_rows)):
            context, word, count, _ = _Block(row).grams(order)
            shard = _shards_of(context, word, shards, frequent)
            at = _asked(word, shard, order)
            # Only shards that are asked get a row: never more rows than n-grams, however many shards.
            asked, edges = np.unique(shard[at], return_index=True)
            own = np.split(at, edges[1:])
            yield {
                "block": [row["block"]] * len(asked),
                "shard": asked.tolist(),
                "contexts": [_packed_contexts(context[o]) for o in own],
                "words": [_packed_words(word[o], order) for o in own],
                "counts": [_packed_counts(count[o]) for o in own],
            }

    return map_batches(blocks, run, "block long, shard int, contexts binary, words binary, counts binary")


def _packed_words(word: np.ndarray, order: int) -> bytes:
    """Single words whole; next words by the 40 bits of ``_next_word``, or by their numbers among the distinct ones."""
    if order == 1:
        return word.tobytes()
    word = _next_word(word)
    if len(word) >= FEW_WORDS:
        known, number = np.unique(word, return_inverse=True)
        names = packed_rising(known)
        coded = len(names).to_bytes(4, "little") + names + packed(number.astype(np.uint32))
        if len(coded) < 4 * len(word):
            return coded
    return word.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :5].tobytes()


def _words(raw: bytes, n: int) -> np.ndarray:
    if len(raw) == 8 * n:
        return np.frombuffer(raw, np.uint64)
    if len(raw) < 5 * n:
        end = 4 + int.from_bytes(raw[:4], "little")
        return unpacked_rising(raw[4:end], np.uint64)[unpacked(raw[end:], np.uint32)]
    whole = np.zeros((n, 8), np.uint8)
    whole[:, :5] = np.frombuffer(raw, np.uint8).reshape(n, 5)
    return whole.view("<u8").ravel()


def _packed_contexts(context: np.ndarray) -> bytes:
    """Rising contexts as the steps between distinct ones and their numbers of words."""
    start = np.flatnonzero(_new(context))
    known = packed_rising(context[start])
    return len(known).to_bytes(4, "little") + known + _packed_counts(np.diff(np.append(start, len(context))))


def _contexts(raw: bytes) -> np.ndarray:
    end = 4 + int.from_bytes(raw[:4], "little")
    return np.repeat(unpacked_rising(raw[4:end], np.uint64), _counts(raw[end:]))


def _packed_counts(count: np.ndarray) -> bytes:
    return packed(np.frombuffer(_plain_counts(count), np.uint8))


def _counts(raw: bytes) -> np.ndarray:
    return _of_plain(unpacked(raw, np.uint8))


def _plain_counts(count: np.ndarray) -> bytes:
    """A byte each, and the places and values of the few above. Stored files hold many of these better than packed ones."""
    large = np.flatnonzero(count >= 255)
    small = np.minimum(count, 255).astype(np.uint8)
    head = np.array([len(large), len(count)], "<i8").tobytes()
    return head + large.astype("<i8").tobytes() + count[large].astype("<i8").tobytes() + small.tobytes()


def _of_plain(raw) -> np.ndarray:
    m, n = (int(x) for x in np.frombuffer(raw, "<i8", 2))
    count = np.frombuffer(raw, np.uint8, n, 16 + 16 * m).astype(np.int64)
    count[np.frombuffer(raw, "<i8", m, 16)] = np.frombuffer(raw, "<i8", m, 16 + 8 * m)
    return count


def _merged(context: np.ndarray, word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The order by context and word, and where another n-gram begins.

    The blocks' questions are sorted, so stable sorts only merge them.
    """
    if len(context) and context.any():
        by_context = np.argsort(context, kind="stable")
        rank = np.empty(len(context), np.uint64)
        rank[by_context] = np.cumsum(_new(context[by_context]))
        if int(rank.max()) >= 1 << 24:
            order = np.lexsort((word, context))
            return order, _new(context[order]) | _new(word[order])
        word = rank << np.uint64(40) | word
    order = np.argsort(word, kind="stable")
    return order, _new(word[order])


def _sums(rows: pd.DataFrame):
    """Distinct n-grams of a shard in rising order, their counts, and the place of each block's among them."""
    asked = [(c, _words(w, len(c))) for c, w in zip(map(_contexts, rows["contexts"]), rows["words"])]
    context, word = (np.concatenate(side) for side in zip(*asked))
    count = np.concatenate([_counts(c) for c in rows["counts"]])
    order, new = _merged(context, word)
    number = np.empty(len(order), np.int64)
    number[order] = np.cumsum(new) - 1
    total = np.bincount(number, weights=count, minlength=int(new.sum())).astype(np.int64)
    ends = np.cumsum([len(w) for _, w in asked])[:-1]
    return context[order[new]], word[order[new]], total, np.split(number, ends)


def _answer_counts(asked: DataFrame, least: float) -> DataFrame:
    """Level of single words: ('count', block, shard, counts), and of the frequent words ('word', hash, count)."""

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        _, word, total, numbers = _sums(rows)
        shard = int(rows["shard"].iloc[0])
        out = [("count", int(b), shard, _plain_counts(total[n]), 0) for b, n in zip(rows["block"], numbers)]
        out += [("word", int(word[i].astype(np.int64)), shard, b"", int(total[i])) for i in np.flatnonzero(total > least)]
        out.append(("vocabulary", int((total > 0).sum()), shard, b"", int(total.sum())))
        return pd.DataFrame(out, columns=["kind", "block", "shard", "data", "n"])

    return asked.groupBy("shard").applyInPandas(run, "kind string, block long, shard int, data binary, n long")


def _answer_shares(
    asked: DataFrame, frequent: dict[int, int], mass: float, least: float | None
) -> DataFrame:
    """A higher level: a trie is built per shard, and from its image come ('share', block, shard, codes).

    Where a higher level follows (``least``), the answers have the counts too, which are its contexts' counts, and
    ('gram', context, shard, next word and count) tells the n-grams that are more frequent than that.
    """
    names = np.array(sorted(frequent), np.uint64)
    totals = np.array([frequent[int(x)] for x in names], np.int64)

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        context, word, total, numbers = _sums(rows)
        shard = int(rows["shard"].iloc[0])
        first = np.flatnonzero(np.append(True, context[1:] != context[:-1])) if len(context) else np.zeros(0, int)
        whole = np.add.reduceat(total, first) if len(first) else np.zeros(0, np.int64)
        if len(names) and len(first):
            at = np.minimum(np.searchsorted(names, context[first]), len(names) - 1)
            whole = np.where(names[at] == context[first], totals[at], whole)
        whole = np.repeat(whole, np.diff(np.append(first, len(context))))
        seen = total > 0
        share = np.log10(total[seen] / (whole[seen] + mass))
        image = Trie.build(context[seen], word[seen], share).image()
        trie = Trie.open(image)
        # Each distinct n-gram is looked up once, in the coded levels; the blocks get copies.
        found = trie.shares(context, word)
        codes = np.where(np.isfinite(found), np.round(-np.maximum(found, -13) / QUANTUM), 65535).astype("<u2")
        out = []
        for i in np.flatnonzero(total > least) if least is not None else ():
            out.append(("gram", int(context[i].astype(np.int64)), shard, word[i].tobytes(), total[i].tobytes()))
        for block, number in zip(rows["block"], numbers):
            counts = _plain_counts(total[number]) if least is not None else b""
            out.append(("share", int(block), shard, codes[number].tobytes(), counts))
        return pd.DataFrame(out, columns=["kind", "block", "shard", "data", "counts"])

    return asked.groupBy("shard").applyInPandas(
        run, "kind string, block long, shard int, data binary, counts binary"
    )


# --- scores ------------------------------------------------------------------------------


def score(docs: DataFrame, order: int = ORDER, mass: float = MASS) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score) of every row."""
    stored = write_rows(_blocks(docs), "block", bucket_count(docs.sparkSession))
    blocks = stored.read_files()
    n_tokens = blocks.agg(F.sum(F.length("low") / 2)).first()[0] or 0
    shards = parts_for(int(n_tokens), SHARD_TOKENS)
    least = n_tokens / FREQUENT
    hots: dict[int, dict[int, int]] = {1: {}}  # contexts of a level with a large share of all tokens, and their counts
    answers = [store(_answer_counts(_ask(blocks, 1, shards, _names(hots[1])), least))]
    clear_shuffles(docs.sparkSession)
    known = answers[0].filter("kind = 'vocabulary'").agg(F.sum("n"), F.sum("block")).first()
    train_tokens, vocabulary = known[0] or 0, known[1] or 0
    # At most FREQUENT words, and below as many n-grams.
    words = {r["block"] % (1 << 64): r["n"] for r in answers[0].filter("kind = 'word'").select("block", "n").collect()}
    trained = words.pop(int(_END), 0) or blocks.select(F.explode("held").alias("held")).filter("not held").count()
    start = {int(_START): trained} if trained > least else {}
    hots[2] = words | start
    for level in range(2, order + 1):
        asked = _ask(blocks, level, shards, _names(hots[level]))
        answers.append(store(_answer_shares(asked, hots[level], mass, least if level < order else None)))
        del asked
        clear_shuffles(docs.sparkSession)
        if level < order:
            grams = answers[-1].filter("kind = 'gram'").select("block", "data", "counts").collect()
            hots[level + 1] = _grown(grams, words) | start
    replies = None
    for level, answer in enumerate(answers, 1):
        part = answer.filter("kind in ('count', 'share')").select(
            F.lit(level).alias("level"), "block", "shard",
            (F.lit(b"") if level == 1 else F.col("data")).alias("codes"),
            F.col("data" if level == 1 else "counts").alias("counts"),
        )
        replies = part if replies is None else replies.unionByName(part)
    hot = {level: _names(own) for level, own in hots.items()}

    def run(rows: pd.DataFrame, said: pd.DataFrame) -> pd.DataFrame:
        out = []
        for row in rows.to_dict("records"):
            block = _Block(row)
            # Answers per token, by order; shards answer in the order in which they were asked.
            codes, counts = {}, {}
            for level in range(1, order + 1):
                own = said[said["level"] == level].drop_duplicates("shard").sort_values("shard")
                context, word, _, which = block.grams(level)
                shard = _shards_of(context, word, shards, hot[level])
                at = _asked(word, shard, level)
                if level > 1:
                    codes[level] = _per_token(at, which, [np.frombuffer(d, "<u2") for d in own["codes"]])
                if level == 1 or level < order:
                    counts[level] = _per_token(at, which, [_of_plain(d) for d in own["counts"]])
            out.append(_scores(block, counts, codes, mass, train_tokens, vocabulary, trained))
        return pd.concat(out, ignore_index=True)

    names = "block long, ids array<long>, held array<boolean>, sizes array<int>, words binary, low binary, high binary"
    assert [f.split()[0] for f in names.split(", ")] == blocks.columns
    return (
        stored.read().groupBy("block")
        .cogroup(replies.groupBy("block"))
        .applyInPandas(
            run,
            "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, "
            "base_score double, score double",
        )
    )


def _names(contexts: dict[int, int]) -> np.ndarray:
    return np.array(sorted(contexts), np.uint64)


def _grown(grams: list, words: dict[int, int]) -> dict[int, int]:
    """Contexts made of frequent n-grams, with their counts.

    The last word of a frequent n-gram is a frequent word, so its whole hash is known from the first level.
    """
    whole = {int(_next_word(np.uint64(w))): np.uint64(w) for w in words}
    out = {}
    for row in grams:
        word = whole.get(int(np.frombuffer(row["data"], np.uint64)[0]))
        if word is not None:  # not the end, which no word follows
            context = np.array([row["block"]], np.int64).view(np.uint64)
            out[int(_grow(context, word)[0])] = int(np.frombuffer(row["counts"], np.int64)[0])
    return out


def _per_token(at: np.ndarray, which: np.ndarray, parts: list[np.ndarray]) -> np.ndarray:
    values = np.concatenate(parts)
    found = np.empty(len(values), values.dtype)
    found[at] = values
    return found[which]


def _scores(block: _Block, counts, codes, mass, train_tokens, vocabulary, trained) -> pd.DataFrame:
    chance = (counts[1] + ADDED) / (train_tokens + ADDED * (vocabulary + 1))
    base, p = np.log10(chance), chance
    place = np.arange(len(chance)) - np.repeat(block.first, block.sizes)
    inside = np.flatnonzero(place >= 1)
    for level, code in sorted(codes.items()):
        share = np.where(code < 65535, 10.0 ** (-QUANTUM * code.astype(np.float64)), 0.0)
        # The context's count is that of the n-gram that ends before the word; at the
        # beginning it is the start's.
        context = np.full(len(chance), trained, np.int64)
        context[inside] = counts[level - 1][inside - 1]
        p = share + mass / (context + mass) * p
    text = np.repeat(np.arange(len(block.sizes)), block.sizes)
    n = len(block.sizes)
    return pd.DataFrame(
        {
            "doc_id": pd.array(block.ids, dtype="Int64"),
            "held_out": block.held,
            "n_tokens": block.sizes,
            "n_known": np.bincount(text, weights=counts[1] > 0, minlength=n).astype(np.int64),
            "train_tokens": train_tokens,
            "base_score": np.bincount(text, weights=base, minlength=n),
            "score": np.bincount(text, weights=np.log10(p), minlength=n),
        }
    )


def op2_lm(docs: DataFrame) -> DataFrame:
    return score(docs)
