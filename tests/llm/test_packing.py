import zlib
from collections import defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from prefdata.llm import sos_packing as S
from prefdata.llm import token_output as T
from prefdata.llm.tokens import WordTokens, tokenizer_path
from .data import frame, prose

TEXTS = [
    None, "", "It's a Test, isn't it? 12.5", "<|endoftext|> don'T", "ÀÉ ß ẞ ŒUVRE ﬁ á e\u0085b",
    "日本語 テスト 😀", "$$$***&&& İstanbul ΣΑΣ", "×÷ µ ª º Ÿ ÿ", prose(1, 5000), prose(2, 300), prose(2, 300),
]


def whole_ids(text):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(tokenizer_path())
    return tokenizer.encode(text or "", add_special_tokens=False).ids + [0]


def test_words_give_the_ids_of_the_whole_text():
    words = WordTokens(tokenizer_path())
    for text in TEXTS:
        got = np.frombuffer(words.of((text or "").encode()), "<u4").tolist()
        assert got == whole_ids(text)


@settings(max_examples=60, deadline=None)
@given(st.text())
def test_any_text_gives_the_ids_of_the_whole_text(text):
    assert np.frombuffer(WORDS.of(text.encode()), "<u4").tolist() == whole_ids(text)


WORDS = WordTokens(tokenizer_path())


def test_sum_of_squares_packs_closely():
    rng = np.random.default_rng(5)
    lengths = np.concatenate([np.full(200, 2048), rng.integers(1, 2049, 3000), rng.integers(1, 200, 3000)])
    sequence, offset = S.pack(lengths, 2048)
    least = -(-lengths.sum() // 2048)
    assert sequence.max() + 1 <= least * 1.01 + 2
    rows = defaultdict(list)
    for s, o, n in zip(sequence, offset, lengths):
        rows[s].append((o, n))
    for own in rows.values():
        at = 0
        for o, n in sorted(own):
            assert o == at
            at += n
        assert at <= 2048


def check_pieces(texts, rows, capacity):
    ids = {i: whole_ids(t) for i, t in enumerate(texts)}
    pieces, sequences = defaultdict(list), defaultdict(list)
    for r in rows:
        pieces[r["doc_id"]].append(r)
        sequences[r["sequence_id"]].append(r)
    for i, own in ids.items():
        at = 0
        for number, r in enumerate(sorted(pieces[i], key=lambda r: r["piece"])):
            part = own[at : at + capacity]
            assert (r["piece"], r["start"], r["length"]) == (number, at, len(part))
            assert r["ids_crc32"] == zlib.crc32(np.array(part, "<u4").tobytes())
            at += len(part)
        assert at == len(own)
    for own in sequences.values():
        at = 0
        for r in sorted(own, key=lambda r: r["offset"]):
            assert r["offset"] == at
            at += r["length"]
        assert at <= capacity


@pytest.mark.parametrize("pack_rows", [150_000, 4])
def test_pieces_and_offsets(spark, pack_rows):
    docs = frame(spark, TEXTS)
    rows = S.place(S.store(S.token_pieces(docs, 256)), 256, pack_rows).collect()
    check_pieces(TEXTS, rows, 256)
    assert S.packed(docs.limit(0)).count() == 0
    twice = S.packed(docs.union(docs)).collect()
    assert len(twice) == 2 * len(S.packed(docs).collect())


def test_rows_of_the_matrix(spark, tmp_path):
    docs = frame(spark, TEXTS)
    rows = T.packed_rows(docs, 256).collect()
    ids = {i: whole_ids(t) for i, t in enumerate(TEXTS)}
    seen = defaultdict(list)
    for r in rows:
        row = np.frombuffer(r["ids"], "<u2")
        assert r["cu_seqlens"][0] == 0 and r["cu_seqlens"][-1] == len(row) == r["length"] <= 256
        assert r["position_resets"] == r["cu_seqlens"][:-1]
        assert r["ids_crc32"] == zlib.crc32(row.astype("<u4").tobytes())
        for doc, start, a, b in zip(r["doc_ids"], r["starts"], r["cu_seqlens"], r["cu_seqlens"][1:]):
            assert row[a:b].tolist() == ids[doc][start : start + b - a]
            seen[doc].append(b - a)
    assert {i: sum(n) for i, n in seen.items()} == {i: len(x) for i, x in ids.items()}
    T.write_packed(docs, str(tmp_path / "packed"), 256)
    stored = spark.read.parquet(str(tmp_path / "packed")).collect()
    assert {len(r["ids"]) for r in stored} == {512}
    assert T.packed_rows(docs.limit(0)).count() == 0


@settings(max_examples=50, deadline=None)
@given(st.lists(st.integers(1, 64), max_size=80))
def test_best_fit_decreasing(lengths):
    rows = T.best_fit_decreasing(lengths, 64)
    assert sorted(i for own in rows for i in own) == list(range(len(lengths)))
    assert all(sum(lengths[i] for i in own) <= 64 for own in rows)
    # The same as looking at every open row.
    room = []
    for size in sorted(lengths, reverse=True):
        fits = [r for r in room if r >= size]
        if fits:
            room.remove(min(fits))
        room.append((min(fits) if fits else 64) - size)
    assert len(rows) == len(room)


def test_positions():
    assert T.positions([3, 1, 2]).tolist() == [0, 1, 2, 0, 0, 1]
    assert T.positions([]).tolist() == []


def slow_pack(lengths, capacity):
    """Gaps of open sequences after each document: the choice with the least sum of squares, smallest gap first."""
    gaps = []
    for size in sorted(lengths, reverse=True):
        best = None
        for gap in [capacity] + sorted(set(gaps)):
            if gap < size:
                continue
            after = list(gaps)
            if gap in gaps:
                after.remove(gap)
            elif gap != capacity:
                continue
            if gap - size:
                after.append(gap - size)
            squares = sum(after.count(g) ** 2 for g in set(after))
            fresh = gap == capacity and gap not in gaps
            key = (squares, fresh, gap)
            if best is None or key < best[0]:
                best = (key, after)
        gaps = best[1]
    return sorted(gaps)


def test_every_choice_has_the_least_sum_of_squares(monkeypatch):
    monkeypatch.setattr(S, "_empty_into_gaps", lambda *args: None)
    rng = np.random.default_rng(4)
    for _ in range(40):
        lengths = rng.integers(1, 21, rng.integers(1, 40))
        sequence, offset = S.pack(lengths, 20)
        left = [20 - int(lengths[sequence == s].sum()) for s in np.unique(sequence)]
        assert sorted(g for g in left if g) == slow_pack(lengths.tolist(), 20)


def test_a_third_of_the_rows_with_one_id(spark):
    """The same piece many times is dealt over packs like any others."""
    rows = [(None if i % 3 else 5, prose(1, 30)) for i in range(600)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    found = S.place(S.token_pieces(docs, 2048), 2048, pack_rows=50)
    packs = -(-600 // 50)
    sizes = {}
    for r in found.collect():
        sizes[r["sequence_id"] % packs] = sizes.get(r["sequence_id"] % packs, 0) + 1
    assert sum(sizes.values()) == 600 and len(sizes) == packs and max(sizes.values()) <= 90
