"""Prefixes, samples and shuffles. A table has no order, so each takes its key."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from prefdata.functions import fixed

# Buckets per doubling of the key's size; with both signs at most 1,025 buckets per group.
_STEPS = 8
# The bucket that is cut is counted again in this many parts, until it has few rows.
_PARTS = 256
_EDGE_ROWS = 100_000
# A text shows this many windows of so many bytes behind its prefix to one job.
_WINDOWS, _WINDOW = 3, 7


def first_rows(
    df: DataFrame, limit: int | dict, order: list[str], by: str | None = None
) -> DataFrame:
    """The first ``limit`` rows in ``order``, or the first rows of each ``by`` value.

    ``order`` as a whole tells any two rows apart; nulls of its first column come last.
    ``limit`` is one number, or a dict of numbers by value of ``by`` (rows of other values are left
    out).

    A sort with a limit sends ``limit`` rows of every input partition to one task. Here
    a job counts rows per bucket of the first column; the bucket in which the limit falls is
    counted again in finer parts until it has at most ``_EDGE_ROWS`` rows or a single
    value. Rows before it are passed on as they are, by a literal bound that a reader can use to
    skip; only the rows of the last bucket are ranked. How the keys are spread decides the
    speed, never the result. Parts of a number are ranges of equal width; a text is told apart byte
    by byte behind what all keys of its bucket begin with, however long that is.
    """
    key = order[0]
    kind = _TextEdge if df.schema[key].dataType.simpleString() in ("string", "binary") else _NumberEdge
    group = F.col(by) if by else F.lit(0)
    quotas = limit if by else {0: limit}
    if by:
        df = df.filter(group.isin(list(quotas)))
    edges = {g: kind(df, key, g, n) for g, n in quotas.items()}
    for row in kind.counts(df, key, group, None):
        edges[row["_g"]].add(row)
    while wide := [e for e in edges.values() if e.is_wide()]:
        for e in wide:
            e.open()
        for row in kind.counts(df, key, group, wide):
            edges[row["_g"]].add(row)
    return _cut(df, list(edges.values()), group, order, by)


class _Edge:
    """Where the limit falls within one group."""

    def __init__(self, df: DataFrame, key: str, group, limit: int):
        self.key, self.group, self.missing = F.col(key), group, limit
        self.rows, self.found, self.in_nulls = 0, False, False

    def add(self, row) -> None:
        """The next bucket in order."""
        if self.found:
            return
        if row["_n"] <= self.missing:
            self.missing -= row["_n"]
        else:
            self.found, self.rows, self.in_nulls = True, row["_n"], row["_bucket"] is None
            if not self.in_nulls:
                self.narrow(row)

    def is_wide(self) -> bool:
        return self.found and not self.in_nulls and self.rows > _EDGE_ROWS and not self.is_one()

    def open(self) -> None:
        self.found = False

    def of_group(self, group: Column) -> Column:
        return group == F.lit(self.group)


class _NumberEdge(_Edge):
    """Buckets are ranges of a whole number."""

    def __init__(self, df: DataFrame, key: str, group, limit: int):
        super().__init__(df, key, group, limit)
        self.number = _number(df, key)
        self.low = self.high = None  # of the bucket that is cut

    def narrow(self, row) -> None:
        self.low, self.high = row["_low"], row["_high"]

    def is_one(self) -> bool:
        return self.low == self.high

    def before(self) -> Column:
        return self.number < F.lit(self.low)

    def inside(self) -> Column:
        return (self.number >= F.lit(self.low)) & (self.number <= F.lit(self.high))

    @staticmethod
    def counts(df: DataFrame, key: str, group: Column, edges: list["_NumberEdge"] | None) -> list:
        """Rows per group and bucket in order, nulls last: a bounded number for each group."""
        number = _number(df, key)
        if edges is None:
            size = F.floor(F.log2(F.abs(number.cast("double")) + 1) * _STEPS)
            within, bucket = F.lit(True), F.signum(number.cast("double")) * size
        else:
            within, bucket = F.lit(False), F.lit(None).cast("long")
            for e in edges:
                here, width = e.of_group(group) & e.inside(), (e.high - e.low) // _PARTS + 1
                within = within | here
                bucket = F.when(here, F.floor((number - F.lit(e.low)) / width)).otherwise(bucket)
        return _in_order(
            df.filter(within).groupBy(group.alias("_g"), bucket.alias("_bucket")).agg(
                F.count(F.lit(1)).alias("_n"), F.min(number).alias("_low"), F.max(number).alias("_high")
            )
        )


class _TextEdge(_Edge):
    """Buckets are the next byte behind a prefix; keys that end with it come first."""

    def __init__(self, df: DataFrame, key: str, group, limit: int):
        super().__init__(df, key, group, limit)
        self.is_text = df.schema[key].dataType.simpleString() == "string"
        self.prefix, self.whole = b"", False

    def narrow(self, row) -> None:
        """Add the bucket's byte, and those that all its keys have behind it."""
        if row["_bucket"] < 0:
            self.whole = True
            return
        first, last = (
            b"".join(row[f"_{end}{i}"].to_bytes(_WINDOW, "big") for i in range(_WINDOWS)) for end in ("low", "high")
        )
        shared = next((i for i, (a, b) in enumerate(zip(first, last)) if a != b), len(first))
        shared = min(shared, row["_shortest"] - len(self.prefix))
        self.prefix += first[:shared]
        self.whole = row["_longest"] == len(self.prefix)

    def is_one(self) -> bool:
        return self.whole

    def _plain(self) -> str:
        """The longest start of the prefix that is a text by itself: readers can compare it."""
        if not self.is_text:
            return ""
        try:
            return self.prefix.decode()
        except UnicodeDecodeError as bad:
            return self.prefix[: bad.start].decode()

    def _parts(self) -> tuple[Column, Column, bool]:
        """The key and the prefix in a type that holds it, and whether that is the key's own."""
        if self.is_text and self._plain().encode() == self.prefix:
            return self.key, F.lit(self._plain()), True
        return self.key.cast("binary"), F.lit(self.prefix), not self.is_text

    def before(self) -> Column:
        key, prefix, plain = self._parts()
        if plain:
            return key < prefix
        start = F.lit(self._plain())
        return (self.key < start) | (F.startswith(self.key, start) & (key < prefix))

    def inside(self) -> Column:
        key, prefix, plain = self._parts()
        own = key == prefix if self.whole else F.startswith(key, prefix)
        return own if plain else F.startswith(self.key, F.lit(self._plain())) & own

    @staticmethod
    def counts(df: DataFrame, key: str, group: Column, edges: list["_TextEdge"] | None) -> list:
        """The same; at most 257 buckets for each group."""
        text, within, skipped = F.col(key).cast("binary"), F.lit(True), F.lit(0)
        if edges is not None:
            within, skipped = F.lit(False), F.lit(None).cast("int")
            for e in edges:
                here = e.of_group(group) & e.inside()
                within = within | here
                skipped = F.when(here, F.lit(len(e.prefix))).otherwise(skipped)
        parts = []
        for i in range(_WINDOWS):
            piece = F.substring(text, skipped + F.lit(1 + i * _WINDOW), F.lit(_WINDOW))
            parts.append(F.conv(F.rpad(F.hex(piece), 2 * _WINDOW, "0"), 16, 10).cast("bigint"))
        size = F.octet_length(text)
        first = F.shiftright(parts[0], 8 * (_WINDOW - 1))
        rows = df.filter(within).select(
            group.alias("_g"), size.alias("_size"), F.when(size <= skipped, F.lit(-1)).otherwise(first).alias("_bucket"),
            *[part.alias(f"_part{i}") for i, part in enumerate(parts)],
        )
        ends = [
            f(f"_part{i}").alias(f"_{end}{i}") for i in range(_WINDOWS) for end, f in (("low", F.min), ("high", F.max))
        ]
        return _in_order(
            rows.groupBy("_g", "_bucket").agg(
                F.count(F.lit(1)).alias("_n"), F.min("_size").alias("_shortest"), F.max("_size").alias("_longest"), *ends
            )
        )


def _in_order(counts: DataFrame) -> list:
    return sorted(counts.collect(), key=lambda r: (r["_bucket"] is None, r["_bucket"] or 0))


def _cut(df: DataFrame, edges: list[_Edge], group: Column, order: list[str], by: str | None) -> DataFrame:
    whole = at_edge = F.lit(False)
    missing = F.lit(None)
    for e in edges:
        own = F.lit(True) if by is None else e.of_group(group)
        if not e.found:
            whole = whole | own
        elif e.in_nulls:
            whole = whole | (own & e.key.isNotNull())
            at_edge = at_edge | (own & e.key.isNull())
        else:
            whole = whole | (own & e.before())
            at_edge = at_edge | (own & e.inside())
        missing = F.when(e.of_group(group), F.lit(e.missing)).otherwise(missing)
    before = df.filter(whole)
    if not any(e.found and e.missing for e in edges):
        return before
    rank = Window.partitionBy(group).orderBy(*[F.col(c).asc_nulls_last() for c in order])
    last = df.filter(at_edge).withColumn("_rank", F.row_number().over(rank))
    return before.unionByName(last.filter(F.col("_rank") <= missing).drop("_rank"))


def _number(df: DataFrame, key: str) -> Column:
    """A whole number that never falls as the key grows."""
    kind = df.schema[key].dataType.simpleString()
    if kind == "bigint":
        return F.col(key)
    if kind in ("tinyint", "smallint", "int"):
        return F.col(key).cast("bigint")
    if kind == "date":
        return F.unix_date(key).cast("bigint")
    if kind.startswith("timestamp"):
        return F.unix_micros(F.col(key).cast("timestamp"))
    raise TypeError(f"no prefix by a key of type {kind}")


def shuffle_key(key: Column | str, seed: int = fixed.SEED) -> Column:
    """Pseudo-random text that is the same on any cluster for a row's key."""
    key = F.col(key) if isinstance(key, str) else key
    return F.md5(F.concat(F.lit(f"{seed}:"), key.cast("string")))


def seeded_shuffle(df: DataFrame, key: str, seed: int = fixed.SEED, parts: int | None = None) -> DataFrame:
    """All rows in a seeded order, held in the column ``shuffle_key``.

    The order goes by a digest of the row's key, whose leading bits are spread evenly: they say at which
    share of the order a row stands, so a row's part is known from the row alone. No job samples
    the keys, rows go to their part directly, and each part is sorted on its own; the parts one
    after another, as collected or as written files, are the order. It is the same for any number of
    ``parts`` (as many as the session's shuffles have, unless given) and on any cluster. ``key`` tells rows
    apart; rows with equal keys stand together.
    """
    spark = df.sparkSession
    parts = parts or int(spark.conf.get("spark.sql.shuffle.partitions"))
    keyed = df.withColumn("shuffle_key", shuffle_key(key, seed))
    # 31 bits times the number of parts fit a long; a null key goes last.
    leading = F.conv(F.substring("shuffle_key", 1, 8), 16, 10).cast("bigint")
    part = F.coalesce(F.shiftright(F.shiftright(leading, 1) * parts, 31), F.lit(parts - 1)).cast("int")
    return keyed.repartitionById(parts, part).sortWithinPartitions(
        F.col("shuffle_key").asc_nulls_last(), F.col(key).asc_nulls_last()
    )


def seeded_sample(
    df: DataFrame, n: int, key: str, seed: int = fixed.SEED
) -> DataFrame:
    """The first ``n`` rows of the seeded shuffle, with ``shuffle_key``."""
    keyed = df.withColumn("shuffle_key", shuffle_key(key, seed))
    # 60 leading bits as a number sort like the text and are spread evenly.
    leading = F.conv(F.substring("shuffle_key", 1, 15), 16, 10).cast("bigint")
    first = first_rows(
        keyed.withColumn("_leading", leading), n, ["_leading", "shuffle_key", key]
    )
    return first.drop("_leading")
