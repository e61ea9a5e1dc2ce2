"""Preference triples: (prompt, chosen, rejected)."""

from __future__ import annotations

import functools
import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from prefdata.functions import fixed
from prefdata.functions.prompts import inference_prompt
from prefdata.functions.text import strip
from prefdata.functions.transcripts import dialogue_prompt, dialogue_reply
from prefdata.operators.ordered import first_rows
from prefdata.sources.scratch import materialise, materialise_counted

# A round over-fetches as if at least one row in so many were accepted.
LEAST_ACCEPTED = 32


def stitch(
    df: DataFrame,
    key: str,
    position: str,
    text: str,
    separator: str,
    part_size: int = 4096,
) -> DataFrame:
    """Ordered texts of each key joined to one: (key, text).

    Runs of ``part_size`` positions are joined first, in tasks of their own; the last step
    gathers a text per run and nothing but the value it returns. The result doesn't
    depend on ``part_size``.
    """
    pieces = F.sort_array(F.collect_list(F.struct(position, text)))
    runs = df.groupBy(key, F.floor(F.col(position) / part_size).alias("_part")).agg(
        F.array_join(pieces[text], separator).alias(text)
    )
    parts = F.sort_array(F.collect_list(F.struct("_part", text)))
    return runs.groupBy(key).agg(F.array_join(parts[text], separator).alias(text))


def turn_triples(
    turns: DataFrame, key: str, position: str, text: str, partner: Column, *,
    shortest: int | None = None, part_size: int = 1024,
) -> DataFrame:
    """Triples of dialogues of any length: (key, position, prompt, chosen, rejected).

    ``turns`` has a row per turn with its marks; ``partner`` is the key of the dialogue
    whose reply is the rejected one. The prompt ends with the last assistant mark, which the
    last marked turn holds; it is given turn by turn, so no task holds a dialogue. The two replies
    are in the row of the prompt's last turn. ``shortest``: length that both replies need.

    A dialogue is cut into ranges of ``part_size`` positions. What is known of a dialogue (where its
    last mark and its end are, its replies) is a row per range, and turns meet it by (key, range):
    no join has the key alone, so a dialogue with a third of all turns is many groups. The replies are
    carried to the range in which the prompt ends, the keys to the others. Positions are unique
    within a key.
    """
    part = F.floor(F.col(position) / part_size)
    placed = turns.select(key, position, text, part.alias("_part"))
    marked = F.when(F.contains(text, F.lit(fixed.ASSISTANT_MARK)), F.col(position))
    ranges = placed.groupBy(key, "_part").agg(F.max(marked).alias("_mark"), F.max(position).alias("_end"))
    ends = ranges.groupBy(key).agg(F.max("_mark").alias("_mark"), F.max("_end").alias("_end"))
    known = ranges.select(key, "_part").join(ends, key)
    mark_part = F.floor(F.col("_mark") / part_size)

    at_mark = F.col(position) == F.col("_mark")
    after = F.when(at_mark, F.substring_index(text, fixed.ASSISTANT_MARK, -1)).otherwise(F.col(text))
    tail = (
        placed.join(known.filter(F.col("_part") >= mark_part).select(key, "_part", "_mark"), [key, "_part"])
        .filter(F.col(position) >= F.col("_mark"))
        .select(key, position, after.alias("_reply"))
    )
    replied = stitch(tail, key, position, "_reply", "", part_size)
    replies = ends.join(replied, key, "left").select(
        key, F.coalesce(strip("_reply"), F.lit("")).alias("chosen")
    )
    others = replies.select(F.col(key).alias("_partner"), F.col("chosen").alias("rejected"))
    pairs = replies.withColumn("_partner", partner).join(others, "_partner").drop("_partner")
    if shortest is not None:
        pairs = pairs.filter(replies_long_enough(shortest))

    last = F.coalesce("_mark", "_end")
    last_part = F.col("_part") == F.floor(last / part_size)
    heads = (
        known.filter(F.col("_part") <= F.floor(last / part_size))
        .join(pairs, key)
        .select(
            key, "_part", "_mark", last.alias("_last"),
            *[F.when(last_part, F.col(c)).alias(c) for c in ("chosen", "rejected")],
        )
    )
    is_last = F.col(position) == F.col("_last")
    return (
        placed.join(heads, [key, "_part"])
        .filter(F.col(position) <= F.col("_last"))
        .select(
            key, position,
            F.when(at_mark, dialogue_prompt(text)).otherwise(F.col(text)).alias("prompt"),
            F.when(is_last, F.col("chosen")).alias("chosen"),
            F.when(is_last, F.col("rejected")).alias("rejected"),
        )
    )


def parse_transcripts(df: DataFrame, *keep: str) -> DataFrame:
    """Triples from pairs of whole dialogues; the prompt is that of the chosen one."""
    return df.select(
        *keep,
        dialogue_prompt("chosen").alias("prompt"),
        dialogue_reply("chosen").alias("chosen"),
        dialogue_reply("rejected").alias("rejected"),
    )


def replies_long_enough(shortest: int = fixed.MIN_TRANSCRIPT_REPLY) -> Column:
    return (F.length("chosen") >= shortest) & (F.length("rejected") >= shortest)


def transcript_pairs(df: DataFrame, *keep: str) -> DataFrame:
    return parse_transcripts(df, *keep).filter(replies_long_enough())


def chosen_long_enough() -> Column:
    return F.length("chosen") >= fixed.MIN_CHOSEN


def rejected_usable() -> Column:
    return (F.col("rejected") != F.col("chosen")) & (
        F.length("rejected") >= fixed.MIN_REJECTED
    )


def over_fetch(n: int) -> int:
    """Rows to read so that ``n`` are likely left after the filters."""
    return int(n * fixed.OVER_FETCH)


def generation_input(
    source: DataFrame, key: str, n: int | None = None
) -> DataFrame:
    """Stripped instruction rows that are worth a generated answer."""
    if n is not None:
        source = first_rows(source, over_fetch(n), [key])
    return source.select(
        key,
        strip("instruction").alias("instruction"),
        strip("input").alias("input"),
        strip("output").alias("chosen"),
    ).filter(chosen_long_enough())


def preference_pairs(
    source: DataFrame, generations: DataFrame, key: str, n: int | None = None
) -> DataFrame:
    """Triples from instruction rows and one generated answer (``text``) for each.

    With ``n``: the first ``n`` good rows out of an over-fetched prefix, which is stored
    once, as are the pairs in it.
    """
    wanted = generation_input(source, key, n)
    if n is not None:
        wanted = materialise(wanted)
        generations = generations.join(wanted.select(key), key, "left_semi")
    pairs = (
        wanted.join(generations.select(key, strip("text").alias("rejected")), key)
        .filter(rejected_usable())
        .select(
            key,
            inference_prompt("instruction", "input").alias("prompt"),
            "chosen",
            "rejected",
        )
    )
    return pairs if n is None else first_rows(materialise(pairs), n, [key])


def first_accepted(
    source: DataFrame, key: str, n: int, answer: Callable[[DataFrame], DataFrame]
) -> DataFrame:
    """The first ``n`` good triples in key order, or all if there are fewer.

    Rows are taken in rounds over ranges of the key until ``n`` are accepted: the first round takes
    what ``over_fetch`` says, the next ones what the share accepted so far lets expect, so a few rounds
    do for any share. ``answer`` gets (key, prompt) of a round's rows and gives (key, text); as
    ranges don't overlap, it never sees a key twice. Rows without a key have no place in the order and
    are left out. The result is that of taking row after row until ``n`` were accepted.
    """
    rounds, accepted, read, ask = [], 0, 0, over_fetch(n)
    rest = source.filter(F.col(key).isNotNull())
    while accepted < n:
        rows, seen = materialise_counted(
            first_rows(rest, ask, [key]), n=F.count(F.lit(1)), last=F.max(key)
        )
        if not seen["n"]:
            break
        prompts = generation_input(rows, key).select(
            key, inference_prompt("instruction", "input").alias("prompt")
        )
        pairs, good = materialise_counted(
            preference_pairs(rows, answer(prompts), key), n=F.count(F.lit(1))
        )
        rounds.append(pairs)
        accepted, read = accepted + good["n"], read + seen["n"]
        if seen["n"] < ask:
            break
        rest = source.filter(F.col(key) > F.lit(seen["last"]))
        ask = over_fetch(math.ceil((n - accepted) * read / max(accepted, read / LEAST_ACCEPTED))) + 1
    if not rounds:
        return preference_pairs(source.limit(0), answer(_no_prompts(source, key)), key)
    return first_rows(functools.reduce(DataFrame.unionByName, rounds), n, [key])


def _no_prompts(source: DataFrame, key: str) -> DataFrame:
    return source.limit(0).select(key, F.lit("").alias("prompt"))


def preference_counts(candidates: DataFrame, key: str, n: int) -> DataFrame:
    """Accepted and skipped rows of a run that stops once ``n`` rows were accepted.

    ``candidates``: (key, chosen, rejected), stripped, one row per row of the prefix
    read. The run ends at the first row with a long enough chosen text after the
    ``n``-th accepted one, so short rows in between still count as skipped.
    """
    at, long, good = F.col("_key"), F.col("_long"), F.col("_good")
    rows = materialise(
        candidates.select(
            F.col(key).alias("_key"),
            chosen_long_enough().alias("_long"),
            (chosen_long_enough() & rejected_usable()).alias("_good"),
        )
    )
    accepted = first_rows(rows.filter(good), n, ["_key"])
    nth = accepted.agg(F.when(F.count(F.lit(1)) == n, F.max(at))).scalar()
    stop = rows.filter(long & (at > nth)).agg(F.min(at)).scalar()
    return rows.agg(
        F.count_if(good).alias("_all_good"),
        F.count_if(~good & (stop.isNull() | (at < stop))).alias("skipped"),
    ).select(F.least("_all_good", F.lit(n).cast("bigint")).alias("accepted"), "skipped")


def score_pairs(comments: DataFrame, key: str, *keep: str) -> DataFrame:
    """Best and worst scored comment of each post.

    ``comments``: (key, position, body, score, ``keep`` columns that are constant within
    a key). Equal scores go by position; posts whose scores are all equal are left out, as are
    comments without a score. A comment that is there several times is one; of several bodies at a place with
    one score the largest text counts.
    """
    scored = comments.filter("score IS NOT NULL")
    rank = F.struct(F.col("score"), -F.col("position"))
    ends = (
        scored.groupBy(key)
        .agg(
            *[F.min(name).alias(name) for name in keep],
            F.max(rank).alias("_best"),
            F.min(rank).alias("_worst"),
        )
        .filter(F.col("_best.score") > F.col("_worst.score"))
    )
    # Only numbers are compared; the two texts of a post are fetched by score and place.
    both = F.array(*[F.struct(F.col(at).alias("rank"), F.lit(at).alias("at")) for at in ("_best", "_worst")])
    wanted = ends.select(key, F.explode(both).alias("_w"))
    bodies = scored.join(wanted, key).filter(rank == F.col("_w.rank"))
    texts = bodies.groupBy(key).agg(
        F.max(F.when(F.col("_w.at") == "_best", F.col("body"))).alias("chosen"),
        F.max(F.when(F.col("_w.at") == "_worst", F.col("body"))).alias("rejected"),
    )
    return ends.join(texts, key).select(
        key,
        *keep,
        "chosen",
        "rejected",
        F.col("_best.score").alias("chosen_score"),
        F.col("_worst.score").alias("rejected_score"),
    )


def post_pairs(posts: DataFrame, *keep: str) -> DataFrame:
    """The same from posts that hold their comments in an array: no shuffle.

    Posts: (title, selftext, comments of (body, score)); the prompt is rendered from
    title and selftext. Comments without a score are left out.
    """
    places = F.transform(
        "comments",
        lambda c, i: F.when(
            c["score"].isNotNull(), F.struct((-c["score"]).alias("down"), i.alias("position"))
        ),
    )
    ranked = F.filter(places, lambda c: c.isNotNull())

    def body(at: str) -> Column:
        return F.element_at("comments", F.col(at)["position"] + 1)["body"]

    return (
        posts.select(*keep, "title", "selftext", "comments", ranked.alias("_ranked"))
        .withColumns({"_best": F.array_min("_ranked"), "_worst": F.array_max("_ranked")})
        .filter(F.col("_best.down") < F.col("_worst.down"))
        .select(
            *keep,
            inference_prompt("title", "selftext").alias("prompt"),
            body("_best").alias("chosen"),
            body("_worst").alias("rejected"),
        )
    )
