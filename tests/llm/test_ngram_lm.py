import math
import time
import zlib
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from prefdata.llm import ngram_lm as L
from .data import frame, prose


def by_hand(rows, order, mass):
    grams, contexts, words = Counter(), Counter(), Counter()
    texts = [(i, [*(t or "").lower().encode().split(), "$"]) for i, t in rows]

    def held(i):
        return zlib.crc32(str(i).encode()) % 10 == 0

    def context(tokens, p, m):
        return tuple(["^", *tokens][max(0, p + 1 - (m - 1)) : p + 1])

    for i, tokens in texts:
        if not held(i):
            words.update(tokens)
            for m in range(2, order + 1):
                for p, w in enumerate(tokens):
                    grams[m, context(tokens, p, m), w] += 1
                    contexts[m, context(tokens, p, m)] += 1
    n, v = sum(words.values()), len(words)
    out = {}
    for i, tokens in texts:
        base = score = 0.0
        for p, w in enumerate(tokens):
            chance = (words[w] + 0.1) / (n + 0.1 * (v + 1))
            base += math.log10(chance)
            for m in range(2, order + 1):
                c = context(tokens, p, m)
                chance = (grams[m, c, w] + mass * chance) / (contexts[m, c] + mass)
            score += math.log10(chance)
        out[i] = (held(i), len(tokens), sum(words[w] > 0 for w in tokens), n, base, score)
    return out


@pytest.mark.parametrize("order,shard", [(2, 2_000_000), (2, 50), (3, 100)])
def test_equals_counting(spark, monkeypatch, order, shard):
    monkeypatch.setattr(L, "SHARD_TOKENS", shard)
    monkeypatch.setattr(L, "BLOCK_TOKENS", 300)
    monkeypatch.setattr(L, "FREQUENT", 20)  # some contexts are spread over shards
    texts = [prose(k % 25, 20 + k) for k in range(40)] + [None, "", "THE the", "ünï x the"]
    got = {r["doc_id"]: tuple(r)[1:] for r in L.score(frame(spark, texts), order).collect()}
    want = by_hand(enumerate(texts), order, L.MASS)
    assert got.keys() == want.keys()
    for i, row in want.items():
        assert got[i][:4] == row[:4]
        assert got[i][4] == pytest.approx(row[4], rel=1e-9)
        assert got[i][5] == pytest.approx(row[5], abs=order * 1.2e-4 * row[1])


def test_query_counts_contexts_of_two_words(spark):
    texts = [prose(k % 9, 30 + k) for k in range(20)] + [None, "the the the"]
    got = {r["doc_id"]: r["score"] for r in L.op2_lm(frame(spark, texts)).collect()}
    pairs, triples = (by_hand(enumerate(texts), order, L.MASS) for order in (2, 3))
    for i, row in triples.items():
        assert got[i] == pytest.approx(row[5], abs=3 * 1.2e-4 * row[1])
    assert any(abs(pairs[i][5] - triples[i][5]) > 1 for i in triples)


def test_empty_table_and_no_training_texts(spark):
    assert L.score(frame(spark, ["a"]).limit(0)).count() == 0
    held = [i for i in range(40) if zlib.crc32(str(i).encode()) % 10 == 0][0]
    rows = L.score(frame(spark, ["a b"] * (held + 1)).filter(f"doc_id = {held}")).collect()
    assert [(r["train_tokens"], r["n_known"], r["n_tokens"]) for r in rows] == [(0, 0, 3)]
    assert rows[0]["score"] == pytest.approx(rows[0]["base_score"])


@settings(max_examples=50, deadline=None)
@given(st.lists(st.integers(0, 2**62), max_size=60))
def test_elias_fano_round_trip(values):
    values = np.array(sorted(values), np.uint64)
    assert L.EliasFano.of(values).values().tolist() == values.tolist()


def test_trie_answers_what_it_was_given(tmp_path):
    rng = np.random.default_rng(3)
    pairs = np.unique(rng.integers(0, 2**63, 40)[rng.integers(0, 40, (900, 2))], axis=0).astype(np.uint64)
    share = np.log10(rng.uniform(1e-6, 1, len(pairs)))
    image = L.Trie.build(pairs[:, 0], pairs[:, 1], share).image()
    path = tmp_path / "shard"
    path.write_bytes(image)
    trie = L.Trie.open(np.memmap(path, np.uint8, "r"))
    assert np.abs(trie.shares(pairs[:, 0], pairs[:, 1]) - share).max() <= L.QUANTUM
    assert np.isinf(trie.shares(pairs[:, 0], pairs[:, 1] + np.uint64(1))).sum() >= len(pairs) - 5
    assert len(image) < 4 * len(pairs) + 1500


def test_a_long_run_under_one_high_part_is_halved(monkeypatch):
    """All next words of a frequent context lie side by side: steps are as many as a number has bits, not as the run is long."""
    values = np.concatenate([np.arange(4000) * 3, [2**40, 2**41]]).astype(np.uint64)
    level = L.EliasFano.of(values)
    asked = []
    lows = level._lows
    monkeypatch.setattr(level, "_lows", lambda at: asked.append(len(at)) or lows(at))
    wanted = np.append(np.arange(12100), [2**40, 2**40 + 1, 2**41, 2**63]).astype(np.uint64)
    got = level.find(wanted)
    place = {int(v): i for i, v in enumerate(values)}
    assert got.tolist() == [place.get(int(w), -1) for w in wanted]
    assert len(asked) < 20


@settings(max_examples=50, deadline=None)
@given(st.sets(st.integers(0, 2**62), max_size=60), st.sets(st.integers(0, 300)))
def test_find_is_a_look_up(large, small):
    values = sorted(large | small)
    level = L.EliasFano.of(np.array(values, np.uint64))
    wanted = sorted(large | {v + 1 for v in large} | set(range(301)))
    got = level.find(np.array(wanted, np.uint64)).tolist()
    assert got == [values.index(w) if w in large | small else -1 for w in wanted]
    if values:
        assert level.at(np.arange(len(values))).tolist() == values


def test_shuffle_files_go_when_a_level_is_answered(spark, tmp_path):
    from prefdata.llm.common import clear_shuffles, store

    seen = spark._jvm.org.apache.spark.SparkEnv.get().shuffleManager().shuffleBlockResolver()
    left = []
    for _ in range(2):
        store(spark.range(1000).repartition(3, "id"))
        newest = spark.sparkContext._jsc.sc().newShuffleId() - 1
        clear_shuffles(spark)
        for _ in range(50):
            there = [m for m in range(4) for f in [seen.getDataFile(newest, m)] if f.exists()]
            if not there:
                break
            time.sleep(0.1)
        left.append(there)
    assert left == [[], []]


@pytest.mark.parametrize("shards", [1, 40])
def test_an_asked_gram_costs_few_bytes(spark, shards):
    """Contexts cost the steps between them, however many shards there are; next words that recur cost their numbers."""
    rng = np.random.default_rng(4)
    texts = [" ".join(f"w{w}" for w in rng.zipf(1.3, 400) % 5000) for _ in range(100)]
    blocks = L._blocks(frame(spark, texts).coalesce(1))
    asked = L._ask(blocks, 3, shards, np.zeros(0, np.uint64)).collect()
    [row] = blocks.collect()
    context, word, count, _ = L._Block(row.asDict()).grams(3)
    got = []
    for r in asked:
        own = L._contexts(r["contexts"])
        got += zip(own.tolist(), L._words(r["words"], len(own)).tolist(), L._counts(r["counts"]).tolist())
    assert got == list(zip(context.tolist(), L._next_word(word).tolist(), count.tolist()))
    used = sum(len(r["contexts"]) + len(r["words"]) + len(r["counts"]) for r in asked)
    contexts = len(np.unique(context))
    assert used < 7 * contexts + 5.2 * len(word) + 250 * shards
    if shards == 1:
        assert sum(len(r["words"]) for r in asked) < 4 * len(word)


def test_blocks_are_not_shuffled(spark, plan_of):
    plan = plan_of(L.score(frame(spark, [prose(k, 30) for k in range(6)])))
    assert plan.count("Exchange") == 1 and "Bucketed: true" in plan
    assert "high" not in plan[plan.index("Exchange") :]
