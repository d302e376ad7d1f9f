"""Toxicity by FTRL-proximal logistic regression over hashed word n-grams and skip-grams.

Features are the distinct words, word pairs and pairs with one word left out of a text, hashed to
2^BITS coordinates; their values are 1. Every coordinate has its own learning rate, from the sum
of its squared gradients, and an L1 penalty that keeps rare coordinates at exactly 0. The sparse
weights are broadcast; their size is bounded by the number of coordinates.

Training takes at most `SAMPLE_ROWS` labelled rows (by a hash of the id, so the bound holds at any
size), dealt to `SHARDS` tasks. In each of `ROUNDS` rounds every task goes through its rows, in
the order of a hash, from the common state; the states are then averaged, coordinate by
coordinate, over the tasks that met it. They are averaged by tasks as well, in blocks of
coordinates, so the driver gets 12 bytes a coordinate and round, however many tasks learn. Whole
texts are read; labels, ids, languages and sources are no inputs of a score.

Words are `[^\\x20\\x09-\\x0D]+` with A-Z lowered and marks at both ends stripped. Null and empty
texts get the score of the bias. Rows with null labels teach nothing; an id labelled twice is toxic
if one label says so. With no labelled rows all scores are 0.5. Input columns named like an output
column are replaced.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plantlens.llm.common import map_texts, slices, without
from plantlens.session import shared_dir

BITS = 20
SAMPLE_ROWS = 24_000
SHARDS = 4
ROUNDS = 5
BLOCK_BITS = 14
BLOCK_TASKS = 32
ALPHA, BETA, L1, L2 = 2.0, 1.0, 4.0, 0.01
MARKS = b".,;:!?\"'()[]{}*#$%&-"
CACHE_WORDS = 500_000


class Hasher:
    """Distinct hashed features of a text. Remembers the hashes of words seen before."""

    def __init__(self, bits: int):
        self.shift, self.words = np.uint64(64 - bits), {}

    def word(self, word: bytes) -> int:
        known = self.words.get(word)
        if known is None:
            if len(self.words) >= CACHE_WORDS:
                self.words.clear()
            bare = word.strip(MARKS)
            known = self.words[word] = zlib.crc32(bare) + 1 if bare else 0
        return known

    def features(self, text: bytes) -> np.ndarray:
        """Coordinates, sorted; 0 is the bias."""
        words = text.lower().split()
        ids = np.fromiter(map(self.word, words), np.uint64, len(words))
        ids = ids[ids > 0]
        mixed = [ids, self.pair(ids[:-1], ids[1:], 3), self.pair(ids[:-2], ids[2:], 5)]
        all_ids = np.concatenate(mixed) * np.uint64(0x9E3779B97F4A7C15)
        hashed = np.maximum(all_ids >> self.shift, np.uint64(1)).astype(np.int64)
        return np.r_[0, np.unique(hashed)]

    @staticmethod
    def pair(first: np.ndarray, second: np.ndarray, kind: int) -> np.ndarray:
        mixed = first * np.uint64(0xC2B2AE3D27D4EB4F) + second * np.uint64(0x165667B19E3779F9)
        return (mixed ^ (mixed >> np.uint64(29))) * np.uint64(kind) + np.uint64(kind)


@dataclass
class Ftrl:
    """State of the learner: z and the sums of squared gradients n."""

    z: np.ndarray
    n: np.ndarray

    @classmethod
    def new(cls, bits: int = BITS) -> Ftrl:
        return cls(np.zeros(1 << bits), np.zeros(1 << bits))

    def weights(self, at: np.ndarray | slice = slice(None)) -> np.ndarray:
        z, n = self.z[at], self.n[at]
        solved = -(z - np.sign(z) * L1) / ((BETA + np.sqrt(n)) / ALPHA + L2)
        return np.where(np.abs(z) > L1, solved, 0.0)

    def learn(self, at: np.ndarray, label: int) -> None:
        w = self.weights(at)
        gradient = squash(w.sum()) - label
        n = self.n[at]
        sigma = (np.sqrt(n + gradient * gradient) - np.sqrt(n)) / ALPHA
        self.z[at] += gradient - sigma * w
        self.n[at] = n + gradient * gradient


def squash(x: float) -> float:
    return float(1.0 / (1.0 + np.exp(-np.clip(x, -35, 35))))


def held_out(doc_id: str = "doc_id") -> Column:
    """Rows that are never learned from: crc32 of the id as text is divisible by 5."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 5 == 0, F.lit(False))


def training_rows(
    docs: DataFrame, labels: DataFrame, doc_id: str, text: str, label: str, rows: int
) -> DataFrame:
    """Text bytes, label and an order, of at most about `rows` documents."""
    known = (
        labels.where(F.col(label).isin(0, 1) & ~held_out(doc_id) & F.col(doc_id).isNotNull())
        .groupBy(doc_id)
        .agg(F.max(label).cast("int").alias("_label"))
    )
    share = min(1.0, rows / max(1, known.count()))
    chosen = known.where(F.pmod(F.xxhash64(doc_id), F.lit(1 << 20)) < int(share * (1 << 20)))
    picked = docs.select(doc_id, text).join(F.broadcast(chosen), doc_id)
    return picked.select(
        F.col(text).cast("binary").alias("text"),
        F.col("_label").alias("label"),
        F.xxhash64(F.lit(11), doc_id).alias("place"),
    )


def train(
    docs: DataFrame,
    labels: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    label: str = "toxic",
    rows: int = SAMPLE_ROWS,
    bits: int = BITS,
) -> tuple[np.ndarray, np.ndarray]:
    """Coordinates with a weight other than 0, and the weights."""

    def featurise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = Hasher(bits)
        for batch in batches:
            for part in slices(batch):
                found = [hasher.features(t or b"").astype(np.int32) for t in part.column(0).to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(found, pa.list_(pa.int32())), *part.columns[1:]],
                    names=["at", "label", "place"],
                )

    sample = training_rows(docs, labels, doc_id, text, label, rows).mapInArrow(
        featurise, "at array<int>, label int, place long"
    )
    folder = shared_dir(docs.sparkSession, "features")
    by_place = sample.repartitionByRange(SHARDS, "place").sortWithinPartitions("place")
    by_place.write.parquet(folder)
    # Read by the same number of tasks in every round, without a shuffle.
    dealt = docs.sparkSession.read.schema(sample.schema).parquet(folder).coalesce(SHARDS)
    state = Ftrl.new(bits)
    sc = docs.sparkSession.sparkContext
    for _ in range(ROUNDS):
        seen = np.flatnonzero(state.n)
        shared = sc.broadcast(packed(seen, state.z[seen], state.n[seen]))

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            own = Ftrl.new(bits)
            at, z, n = unpacked(shared.value)
            own.z[at], own.n[at] = z, n
            before = own.n.copy()
            for batch in batches:
                for part in slices(batch):
                    for found, toxic in zip(part.column(0), part.column(1).to_pylist(), strict=True):
                        own.learn(found.values.to_numpy(), toxic)
            met = np.flatnonzero(own.n != before)
            shard = TaskContext.get().partitionId()
            for block in np.unique(met >> BLOCK_BITS):
                here = met[met >> BLOCK_BITS == block]
                keys = [pa.array([key], pa.int32()) for key in (block, shard)]
                blobs = [pa.array([b], pa.binary()) for b in packed(here, own.z[here], own.n[here])]
                yield pa.RecordBatch.from_arrays(
                    [*keys, *blobs], names=["block", "shard", "at", "z", "n"]
                )

        # Few coordinates a row and few rows a task: nothing large arrives at the driver at once.
        told = (
            dealt.mapInArrow(run, "block int, shard int, at binary, z binary, n binary")
            .repartition(BLOCK_TASKS, "block")
            .groupBy("block")
            .applyInArrow(average_block, "at binary, z binary, n binary")
            .toArrow()
        )
        shared.destroy()
        for blobs in zip(*told.columns, strict=True):
            at, z, n = unpacked(tuple(blob.as_buffer() for blob in blobs))
            state.z[at], state.n[at] = z, n
    at = np.flatnonzero(np.abs(state.z) > L1)
    return at, state.weights(at)


def packed(at: np.ndarray, z: np.ndarray, n: np.ndarray) -> tuple[bytes, bytes, bytes]:
    """Coordinates with their z and n, 12 bytes each."""
    parts = (at.astype(np.int32), z.astype(np.float32), n.astype(np.float32))
    return tuple(part.tobytes() for part in parts)


def unpacked(blobs: tuple[bytes, bytes, bytes]) -> tuple[np.ndarray, ...]:
    return tuple(
        np.frombuffer(blob, kind)
        for blob, kind in zip(blobs, (np.int32, np.float32, np.float32), strict=True)
    )


def average(told: list[tuple[bytes, bytes, bytes]]) -> tuple[bytes, bytes, bytes]:
    """Mean of the tasks' states over those that met a coordinate."""
    at, z, n = (np.concatenate(parts) for parts in zip(*map(unpacked, told), strict=True))
    met, where, times = np.unique(at, return_inverse=True, return_counts=True)
    return packed(met, np.bincount(where, z) / times, np.bincount(where, n) / times)


def average_block(told: pa.Table) -> pa.Table:
    """`average` of a block of coordinates, in the order of the tasks."""
    names = ["at", "z", "n"]
    rows = told.sort_by("shard").select(names).to_pylist()
    blobs = average([tuple(row.values()) for row in rows])
    return pa.table([pa.array([blob], pa.binary()) for blob in blobs], names=names)


def score(
    docs: DataFrame,
    model: tuple[np.ndarray, np.ndarray],
    text: str = "text",
    bits: int = BITS,
    keep: bool = True,
) -> DataFrame:
    """`docs` with `score`, the probability of the label 1, and `predicted`."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    cache: dict = {}

    def compute(texts: list[bytes]) -> list:
        if not cache:
            at, values = shared.value
            cache["weights"] = np.zeros(1 << bits)
            cache["weights"][at] = values
            cache["hasher"] = Hasher(bits)
        weights, hasher = cache["weights"], cache["hasher"]
        return [[squash(weights[hasher.features(t)].sum()) for t in texts]]

    rest = without(docs, ["predicted"])
    scored = map_texts(rest, text, [T.StructField("score", T.DoubleType())], compute, keep)
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
