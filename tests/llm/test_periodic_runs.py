import hashlib
import random
import zlib

import pytest

from prefdata.llm import periodic_runs as R
from tests.llm.data import DOCS, frame, prose, rows_of


def slow_runs(words):
    """All runs, period by period."""
    out = []
    for q in range(1, len(words) // 2 + 1):
        i = 0
        while i + q < len(words):
            start = i
            while i + q < len(words) and words[i] == words[i + q]:
                i += 1
            length = i - start + q
            if i > start and length >= max(12, 2 * q):
                one = words[start : start + q]
                if not any(q % d == 0 and one == one[:d] * (q // d) for d in range(1, q)):
                    out.append((start, length, q))
            i = max(i, start + 1)
    return sorted(out)


def slow_row(key, text):
    words = R.cycled((text or "").encode().split(), key)
    runs = slow_runs(words)
    dropped = {i for s, n, q in runs for i in range(s + q, s + n)}
    best = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=None)
    digest = "".join(f"{s},{n},{q}\n" for s, n, q in runs).encode()
    kept = b" ".join(w for i, w in enumerate(words) if i not in dropped)
    return (
        key, len(runs),
        *((best[0], best[1], best[2], 1000 * best[1] // best[2]) if best else (None,) * 4),
        hashlib.sha256(digest).hexdigest(), hashlib.sha256(kept).hexdigest(),
    )


COLUMNS = ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]


def letters(rng, n, kinds):
    return [rng.choice("abcdefgh"[:kinds]) for _ in range(n)]


def texts():
    rng = random.Random(8)
    out = [None, "", " \t\n", "a " * 11, "a " * 12, "a b " * 6, "é ü " * 30, prose(1, 3000), "x " * 2000]
    for _ in range(60):
        words = letters(rng, rng.randint(5, 160), rng.choice([1, 2, 2, 3, 8]))
        at, p = rng.randrange(len(words)), rng.randint(1, 40)
        if rng.random() < 0.6:
            words[at:] = [words[at + i % p] if at + i % p < len(words) else "z" for i in range(len(words) - at)]
        out.append(rng.choice([" ", "\n", " \t"]).join(words))
    line = prose(5, 9)
    out += [f"{prose(6, 40)} {' '.join([line] * 7)} {prose(7, 40)}"] * 3
    return out


def test_runs_of_every_document(spark):
    rows = rows_of(texts())
    rows += [(None, "q w " * 20, "en", "s", 1, -7, 99.0, "x", 5, "w"), rows[3], rows[12]]
    docs = spark.createDataFrame(rows, DOCS).repartition(3)
    got = sorted(map(tuple, R.op13_periodic_runs(docs).select(COLUMNS).collect()), key=str)
    assert got == sorted((slow_row(r[0], r[1]) for r in rows), key=str)
    assert any(zlib.crc32(str(r[0]).encode()) % 10 == 0 and r[1] for r in rows)


def test_tiles_of_long_documents_are_dealt_out(spark):
    rng = random.Random(3)
    long = [
        " ".join(["t"] * 1500),
        " ".join(letters(rng, 700, 2)),
        " ".join(letters(rng, 200, 8) * 5),
        prose(3, 900) + " " + " ".join(["u", "v", "w"] * 300) + " " + prose(4, 100),
    ]
    got = R.periodic_runs(frame(spark, long + texts()[:12]), whole=64).collect()
    assert len(got) == 16
    for r in got:
        words = (long + texts()[:12])[r["doc_id"]]
        words = (words or "").encode().split()
        assert [tuple(x) for x in r["runs"]] == slow_runs(words)
        dropped = set()
        for run in r["runs"]:
            dropped |= set(range(run["start"] + run["period"], run["start"] + run["length"]))
        assert r["collapsed"] == b" ".join(w for i, w in enumerate(words) if i not in dropped).decode()


def test_one_word_text_sends_few_rows():
    import numpy as np

    period, start, stop = R.fragments(np.zeros(5000, np.int64), R.FIRST, 12)
    assert (period.tolist(), start.tolist(), stop.tolist()) == ([1], [0], [4999])


def test_empty_table_and_bad_sizes(spark):
    empty = R.op13_periodic_runs(frame(spark, []))
    assert empty.count() == 0 and empty.columns[: len(COLUMNS)] == COLUMNS
    with pytest.raises(ValueError):
        R.periodic_runs(frame(spark, []), whole=100)
