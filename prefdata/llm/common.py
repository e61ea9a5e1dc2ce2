"""What several operators of this subpackage share."""

from __future__ import annotations

import ctypes
import gc
import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from prefdata.sources.scratch import scratch_folder

# A worker forgets its word caches beyond this many entries; they are filled again.
CACHE_WORDS = 300_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_bytes(column: str = "text") -> Column:
    """UTF-8 of a text; a null text is the empty text."""
    return F.coalesce(F.col(column), F.lit("")).cast("binary")


def crc_fold(key: str, folds: int) -> Column:
    """crc32 of the key as text, modulo ``folds``; a null key counts as the empty text."""
    return F.crc32(F.coalesce(F.col(key).cast("string"), F.lit("")).cast("binary")) % folds


def store(df: DataFrame) -> DataFrame:
    """Write once to the shared folder (see ``sources.scratch``) and read from there.

    ``remove_scratch`` clears what a session has stored.
    """
    spark, path = df.sparkSession, scratch_folder(df.sparkSession)
    df.write.option("compression", "zstd").parquet(path)
    stored = spark.read.schema(df.schema).parquet(path)
    stored._stored_at = path
    return stored


def forget(df: DataFrame) -> None:
    """Remove a stored table that nothing will read again."""
    path = df.sparkSession._jvm.org.apache.hadoop.fs.Path(df._stored_at)
    path.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(path, True)


def clear_shuffles(spark: SparkSession) -> None:
    """Let go of the shuffle files of queries that nothing refers to any more, such as those of a table just stored.

    Spark removes them once the driver has collected its garbage, which a driver with little to do does rarely.
    Its listeners hold the last query until there is another one.
    """
    gc.collect()
    spark.range(1).count()
    spark.sparkContext._jvm.System.gc()


def map_batches(
    df: DataFrame, make: Callable[[Iterator[pa.RecordBatch]], Iterator[dict]], schema: str
) -> DataFrame:
    """``mapInArrow`` with a function that yields dicts of columns."""
    fields = _arrow_schema(df.sparkSession, schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for columns in make(batches):
            yield pa.RecordBatch.from_arrays(
                [_array(columns[f.name], f.type) for f in fields], schema=fields
            )
        give_back_memory()

    return df.mapInArrow(run, schema)


def give_back_memory() -> None:
    """A worker lives on after its task; what the task has freed should not stay with it."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def _array(values, kind: pa.DataType) -> pa.Array:
    if isinstance(values, pa.Array):
        return values.cast(kind)
    return pa.array(values, type=kind, from_pandas=False)


def _arrow_schema(spark: SparkSession, schema: str) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import _parse_datatype_string

    return to_arrow_schema(_parse_datatype_string(schema))


class WordHashes(dict):
    """64-bit hash of a word (bytes), remembered."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= CACHE_WORDS:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


_ODD = np.uint64(0x9E3779B97F4A7C15)


def chain(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Hash of a sequence that goes on: ``left`` is the hash of what came before."""
    mixed = (left ^ (left >> np.uint64(29))) * _ODD
    return (mixed ^ (mixed >> np.uint64(32))) + right * np.uint64(0xC2B2AE3D27D4EB4F)


def finish(hashes: np.ndarray) -> np.ndarray:
    """Spread the bits, so that any of them can choose a shard."""
    h = (hashes ^ (hashes >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def packed(values: np.ndarray) -> bytes:
    """An array by planes of a byte, compressed; shuffles hold it as it is."""
    planes = values.view(np.uint8).reshape(-1, values.itemsize).T.tobytes()
    return len(planes).to_bytes(4, "little") + (pa.compress(planes, "zstd", asbytes=True) if planes else b"")


def unpacked(raw: bytes, kind: type) -> np.ndarray:
    size, width = int.from_bytes(raw[:4], "little"), np.dtype(kind).itemsize
    if not size:
        return np.zeros(0, kind)
    planes = np.frombuffer(pa.decompress(raw[4:], size, "zstd", asbytes=True), np.uint8)
    return np.ascontiguousarray(planes.reshape(width, -1).T).view(kind).ravel()


def packed_rising(values: np.ndarray) -> bytes:
    """Rising unsigned numbers by the steps between them."""
    steps = values.copy()
    steps[1:] -= values[:-1]
    return packed(steps)


def unpacked_rising(raw: bytes, kind: type) -> np.ndarray:
    return np.cumsum(unpacked(raw, kind), dtype=kind)


def among(values: np.ndarray, known: np.ndarray) -> np.ndarray:
    """Whether each value is one of the known ones, which are sorted."""
    if not len(known):
        return np.zeros(len(values), bool)
    return known[np.minimum(np.searchsorted(known, values), len(known) - 1)] == values


def salt(key: Column, parts: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(parts))


def labelled_sample(
    docs: DataFrame, labels: DataFrame, label: str, max_rows: int, teach: Column | None = None
) -> DataFrame:
    """Texts of at most ``max_rows`` labelled documents, chosen by a hash of the id.

    Rows with a null id or label don't teach; with several labels, the largest counts.
    The chosen ids are at most ``max_rows``, so they are broadcast and no text is shuffled.
    """
    known = labels.select("doc_id", F.col(label).cast("int").alias("label")).dropna()
    if teach is not None:
        known = known.filter(teach)
    known = known.groupBy("doc_id").agg(F.max("label").alias("label"))
    rank = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 40))
    count = known.count()
    if count > max_rows:
        share = min(1.0, 1.2 * max_rows / count + 0.01)
        known = known.filter(rank < int(share * (1 << 40)))
        known = known.orderBy(rank, "doc_id").limit(max_rows)
    return docs.select("doc_id", "text").join(F.broadcast(known), "doc_id")


def components(edges: DataFrame) -> DataFrame:
    """(node, component) of every node in ``edges`` (a long, b long); the smallest id names it.

    Labels sink along the edges and then along themselves (pointer jumping) until none
    changes. Each round is written to the shared folder; nothing is collected but a count.
    """
    pairs = edges.select("a", "b").filter("a <> b")
    both = store(pairs.union(pairs.select("b", "a")).distinct())
    labels = store(both.groupBy(F.col("a").alias("node")).agg(
        F.least(F.min("a"), F.min("b")).alias("component")
    ))
    while True:
        near = (
            both.join(labels, both["b"] == labels["node"])
            .groupBy(F.col("a").alias("node"))
            .agg(F.min("component").alias("near"))
        )
        sunk = labels.join(near, "node").select(
            "node", "component", F.least("component", "near").alias("next")
        )
        hop = labels.select(F.col("node").alias("next"), F.col("component").alias("far"))
        moved = store(
            sunk.join(hop, "next", "left").select(
                "node", "component", F.least("next", "far").alias("new")
            )
        )
        changed = moved.filter("new <> component").limit(1).count()
        forget(labels)
        if not changed:
            forget(both)
            return moved.select("node", F.col("new").alias("component"))
        labels = store(moved.select("node", F.col("new").alias("component")))
        forget(moved)


def parts_for(rows: int, per_part: int) -> int:
    return max(1, math.ceil(rows / per_part))
