import random

import pytest
from pyspark.sql import functions as F

from prefdata.operators import large_documents as large
from prefdata.operators.documents import document_chunks
from prefdata.sources.files import read_documents, read_lines


def some_text(rng, n):
    """Lines of all lengths, empty ones, ones of white space, and paragraphs of many lines."""
    out = []
    while len(out) < n:
        kind = rng.random()
        if kind < 0.25:
            out += [""] * rng.randint(1, 3)
        elif kind < 0.3:
            out.append(rng.choice([" ", "\t", "　", " \x1f"]))
        elif kind < 0.35:
            out += [f"line {i} of a long paragraph" for i in range(rng.randint(5, 40))]
        else:
            out.append(rng.choice(["", " "]) + "".join(rng.choice("abc é中") for _ in range(rng.choice([1, 5, 30, 120, 480, 600]))))
    return out


@pytest.mark.parametrize("by_line", [False, True])
def test_any_pieces_give_the_chunks_of_the_whole_text(spark, by_line):
    rng = random.Random(3)
    texts = {k: some_text(rng, n) for k, n in enumerate([0, 1, 2, 7, 40, 150, 300])}
    texts[7] = [""] * 20
    texts[8] = ["x" * 3] * 200  # one paragraph, or many short lines
    texts[9] = ["ab"] + [""] * 30 + ["cd"]
    whole = spark.createDataFrame([(k, "\n".join(t)) for k, t in texts.items()], "key long, text string")
    for size, overlap in ((500, 50), (60, 0)):
        want = sorted(map(tuple, document_chunks(
            whole, "key", size=size, overlap=overlap, separator=r"\n+" if by_line else r"\n{2,}"
        ).collect()))
        for longest in (1, 9):
            rows = []
            for k, lines in texts.items():
                piece = position = 0
                left = rng.randint(1, longest)
                for line in lines:
                    rows.append((k, piece, position, line or rng.choice([None, ""]) or ""))
                    position, left = position + 1, left - 1
                    if not left:
                        piece, position, left = piece + rng.randint(1, 9), 0, rng.randint(1, longest)
            rng.shuffle(rows)
            df = spark.createDataFrame(rows, "key long, piece long, position long, text string").repartition(4)
            got = large.chunks_of_lines(df, size, overlap, by_line=by_line)
            assert sorted(map(tuple, got.collect())) == want, (size, overlap, longest)


def test_following_all_states_is_following_each():
    rng = random.Random(5)
    for _ in range(60):
        lengths = [rng.choice([1, 3, 9, 20, 45, 70]) for _ in range(rng.randint(0, 12))]
        ends, closed = large._follow(lengths, 40, 10)
        for s in range(41):
            now, shuts = s, 0
            for n in lengths:
                now, shut = large._add(now, n, 40, 10)
                shuts += shut
            assert (ends[s], closed[s]) == (min(now, 41), shuts)


def test_a_large_file_is_many_tasks(spark, tmp_path):
    rng = random.Random(1)
    folder = tmp_path / "in"
    folder.mkdir()
    text = "\n".join(line for n in range(60) for line in some_text(rng, 200))
    (folder / "book.txt").write_text(text, encoding="utf-8", newline="")
    (folder / "small.md").write_text("a paragraph that is long enough to be a chunk of its own, surely\r\n\r\nx", newline="")
    (folder / "other.pdf").write_bytes(b"%PDF")
    names = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes", "spark.sql.files.minPartitionNum")
    old = {n: spark.conf.get(n, None) for n in names}
    for name, value in zip(names, ("100000", "1", "1")):
        spark.conf.set(name, value)
    try:
        lines = read_lines(spark, str(folder), piece_bytes=20_000)
        assert lines.rdd.getNumPartitions() >= len(text.encode()) // 100_000
        sizes = lines.groupBy("path", "piece").agg(F.sum(F.octet_length("text") + 1).alias("n")).agg(F.max("n")).first()
        assert sizes[0] < 25_000
        got = sorted(map(tuple, large.large_file_chunks(spark, str(folder), piece_bytes=20_000).collect()))
    finally:
        for name in names:
            spark.conf.set(name, old[name]) if old[name] else spark.conf.unset(name)
    documents, _ = read_documents(spark, str(folder))
    want = sorted(map(tuple, document_chunks(documents, "path").collect()))
    assert got == want and len(got) > 500


def test_many_small_pieces_cost_no_data_frame_each(spark, plan_of):
    """A step takes a task's pieces one after another; lines meet what is known of their piece without a join."""
    lines = spark.range(4000).selectExpr(
        "id div 100 as key", "id div 2 as piece", "id as position", "concat('a line that counts ', id) as text"
    )
    parts = large._parts(lines.select("key", "piece", lines["position"].alias("place"), "text"), 500, 50)
    plan = plan_of(parts)
    assert "MapInArrow" in plan and "FlatMapGroupsInPandas" not in plan and "Join" not in plan
    got = large.chunks_of_lines(lines, by_line=True).groupBy("key").count().collect()
    assert len(got) == 40 and len({r["count"] for r in got if r["key"] > 9}) == 1


def test_runs_are_the_list():
    rng = random.Random(2)
    for _ in range(200):
        values = [rng.choice([0, 1, 2, 7])]
        for _ in range(rng.randint(0, 30)):
            values.append(values[-1] + rng.choice([0, 0, 1, 1, 1, -3, 2]))
        runs = large._runs(values)
        assert [large._value(*runs, k) for k in range(len(values))] == values
