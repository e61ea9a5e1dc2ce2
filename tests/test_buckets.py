import random

import pytest

from prefdata.operators import evaluation as ev
from prefdata.sources import buckets, scratch


@pytest.fixture
def sides(spark):
    rng = random.Random(5)
    words = ["ant", "bee", "cat", "dog", "eel"]

    def text():
        return " ".join(rng.choice(words) for _ in range(rng.randint(1, 9)))

    samples = spark.createDataFrame([(i, text(), text()) for i in range(60)], "sample_id long, chosen string, rejected string")

    def answers(model, ids):
        rows = [(i, model, n, text(), 0.5) for n, i in enumerate(ids)]
        return spark.createDataFrame(rows, "sample_id long, model string, no long, answer string, elapsed_s double")

    return samples, answers


def plain(scores):
    return sorted(map(tuple, scores.select("sample_id", "model", "no", "rouge_l", "rouge_l_rejected", "win", "n_words").collect()))


def test_stored_sides_meet_without_a_shuffle(spark, sides, plan_of):
    samples, answers = sides
    first, second = answers("a", range(60)), answers("b", range(20, 80))
    stored = ev.store_evaluation(first, samples, ["sample_id", "model", "no"], buckets=4)
    stored.append(second)
    scores = stored.scores()
    assert "Exchange" not in plan_of(scores) and "SortMergeJoin" in plan_of(scores)
    assert plan_of(ev.summarise(scores)).count("Exchange hashpartitioning(model") == 1
    assert plain(scores) == plain(ev.sample_scores(first.union(second), samples, ["sample_id", "model", "no"]))


def test_a_frequent_sample_is_joined_in_pieces(spark, sides, monkeypatch, plan_of):
    samples, answers = sides
    hot = answers("a", [7] * 400 + list(range(60)))
    stored = ev.store_evaluation(hot, samples, ["sample_id", "model", "no"], buckets=4)
    want = plain(stored.scores())
    monkeypatch.setattr(ev, "BUCKET_BYTES", 1)  # every bucket is a large one
    found = ev.frequent_keys
    monkeypatch.setattr(ev, "frequent_keys", lambda sizes, key: found(sizes, key, parts=20, smallest_piece=1))
    scores = stored.scores()
    assert plan_of(scores).count("SortMergeJoin") >= 1 and "Union" in plan_of(scores)
    assert plain(scores) == want and len(want) == 460


def test_sizes_of_buckets_come_from_the_files(spark, sides):
    samples, _ = sides
    table = buckets.write_buckets(samples, "sample_id", 4)
    sizes = {}
    for row in spark.read.format("binaryFile").load(table.path).select("path", "length").collect():
        if "_0000" in row["path"]:
            number = row["path"].split("_")[-1].split(".")[0]
            sizes[number] = sizes.get(number, 0) + row["length"]
    assert table.largest() == max(sizes.values()) and len(sizes) == 4
    assert sorted(map(tuple, table.read_files().collect())) == sorted(map(tuple, samples.collect()))
    assert buckets.write_buckets(samples, "sample_id").n == int(spark.conf.get("spark.sql.shuffle.partitions"))


def test_counts_are_taken_by_the_job_that_writes(spark):
    jobs = spark.sparkContext.statusTracker()
    for rows in (50, 0):
        df = spark.range(rows, numPartitions=3).selectExpr("id", "if(id % 5 = 0, 'x', null) error")
        spark.sparkContext.setJobGroup(f"counted-{rows}", "")
        stored, seen = scratch.materialise_counted(df, n=scratch_count(), failed=ev.F.count("error"), last=ev.F.max("id"))
        spark.sparkContext.setJobGroup("other", "")
        assert len(jobs.getJobIdsForGroup(f"counted-{rows}")) == 1
        assert seen == {"n": rows, "failed": rows // 5, "last": rows - 1 if rows else None}
        assert stored.count() == rows


def scratch_count():
    return ev.F.count(ev.F.lit(1))


@pytest.mark.parametrize("master, needs", [("local[4]", False), ("local", False), ("local-cluster[3,2,900]", True), ("yarn", True)])
def test_executors_elsewhere_need_a_shared_folder(master, needs):
    class Session:
        class sparkContext:
            pass

        class conf:
            @staticmethod
            def get(name, default=None):
                return {"spark.sql.warehouse.dir": "warehouse"}.get(name, default)

    Session.sparkContext.master = master
    if needs:
        with pytest.raises(RuntimeError, match="no shared folder"):
            scratch.shared_folder(Session)
    else:
        assert scratch.shared_folder(Session) == "warehouse"
