"""SimHash near-duplicates: pigeonring candidates, exact Hamming check, connected components.

A fingerprint has four segments of 16 bits in a ring. If two fingerprints differ in at most three
bits, some chain of segments, begun at one of the four and taken around the ring, has after l
segments at most 3 * l / 4 differences for every l: none in the first segment, at most one in two,
two in three, three in four. The first two conditions are a key: the first segment as it is, and
the second with at most one bit changed. Every fingerprint is dealt to its own four keys as a
seeker and, with each of the 17 forms of the second segment, to 68 keys as a target. Tasks check the rest of the
chain and then the full distance, and emit for each key the links of a spanning forest, not pairs.

All of this works on distinct fingerprints; documents with equal ones are one node. A key fixes 32
bits, and the 72 keys of a fingerprint lie in different tasks, so that a large group of different
near copies is spread as well. Within a key, a walk compares a mark with those not yet visited, so
a dense group costs little more than its size. Components are found by passing on the smallest label, with
shortcuts, over stored frames.

Null and empty texts have fingerprint zero and are linked like any other. Rows with a null doc_id
take part; a component has a null id only if no member has one. Repeated rows are separate members
with the same answer. Input columns named like an output column are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plantlens.llm.common import join_hot, map_texts, stored, without

SEGMENTS = 4
WIDTH = 16
MAX_DIFFERENCES = 3
MAX_ROUNDS = 60


def shingles(text: bytes, size: int) -> list[bytes]:
    """Word n-grams of the text in lower-case A-Z; the whole sequence if it is shorter."""
    words = text.lower().split()
    if not words:
        return []
    if len(words) <= size:
        return [b" ".join(words)]
    return [b" ".join(parts) for parts in zip(*(words[i:] for i in range(size)), strict=False)]


def fingerprint(text: bytes, size: int = 3) -> int:
    """Signed 64-bit SimHash: a bit is set if it is set in over half the hashes."""
    grams = shingles(text, size)
    if not grams:
        return 0
    digest, set_bits = xxhash.xxh64_digest, np.zeros(64, dtype=np.int64)
    for begin in range(0, len(grams), 1 << 16):
        some = b"".join([digest(gram, 42) for gram in grams[begin : begin + (1 << 16)]])
        bits = np.unpackbits(np.frombuffer(some, dtype=np.uint8).reshape(-1, 8), axis=1)
        set_bits += bits.sum(axis=0, dtype=np.int64)
    packed = np.packbits(2 * set_bits > len(grams))
    return int.from_bytes(packed.tobytes(), "big", signed=True)


def fingerprints(docs: DataFrame, text: str = "text", size: int = 3, keep: bool = True) -> DataFrame:
    """`docs` with the column `simhash` (long)."""

    def compute(texts: list[bytes]) -> list:
        return [[fingerprint(t, size) for t in texts]]

    return map_texts(docs, text, [T.StructField("simhash", T.LongType())], compute, keep)


def chain_keys(marks: np.ndarray) -> Iterator[tuple[np.ndarray, bool]]:
    """Keys of distinct fingerprints, 34 bits each; true for those of the seeker."""
    parts = [(marks >> np.uint64(WIDTH * s)) & np.uint64(0xFFFF) for s in range(SEGMENTS)]
    for begin in range(SEGMENTS):
        head = (np.uint64(begin) << np.uint64(32)) | (parts[begin] << np.uint64(WIDTH))
        second = parts[(begin + 1) % SEGMENTS]
        yield head | second, True
        for bit in range(WIDTH):
            yield head | (second ^ np.uint64(1 << bit)), False


def differences(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.bitwise_count(a ^ b)


def within_chain(seeker: np.uint64, others: np.ndarray, begin: int) -> np.ndarray:
    """Which of `others` keep the proportional budgets around the ring, and the full one."""
    total = np.zeros(len(others), dtype=np.int64)
    fits = np.ones(len(others), dtype=bool)
    for step in range(SEGMENTS):
        shift = np.uint64(WIDTH * ((begin + step) % SEGMENTS))
        total += np.bitwise_count(((seeker ^ others) >> shift) & np.uint64(0xFFFF))
        fits &= total * SEGMENTS <= MAX_DIFFERENCES * (step + 1)
        if step < SEGMENTS - 1 and not fits.any():
            break
    return fits


def forest(begin: int, marks: np.ndarray, seeks: np.ndarray) -> Iterator[tuple[int, int]]:
    """Links that join what is near in one key: a walk that asks about unvisited marks only.

    A link has a seeker on one side at least, as the chain starts there. `marks` are distinct.
    """
    left_marks, left_seeks = marks, seeks
    while len(left_marks) > 1 and left_seeks.any():
        first = int(np.argmax(left_seeks))
        frontier = [(left_marks[first], True)]
        left = np.ones(len(left_marks), dtype=bool)
        left[first] = False
        left_marks, left_seeks = left_marks[left], left_seeks[left]
        while frontier and len(left_marks):
            mark, is_seeker = frontier.pop()
            near = within_chain(mark, left_marks, begin)
            if not is_seeker:
                near &= left_seeks
            if near.any():
                for other, seeker in zip(left_marks[near], left_seeks[near], strict=True):
                    yield int(mark), int(other)
                    frontier.append((other, bool(seeker)))
                left_marks, left_seeks = left_marks[~near], left_seeks[~near]


def near_links(classes: DataFrame) -> DataFrame:
    """Links (a, b) between distinct fingerprints `simhash` that join all pairs within budget."""

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 4096):
                marks = batch.column(0).slice(start, 4096).to_numpy()
                for keys, seeker in chain_keys(marks.view(np.uint64)):
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(keys.astype(np.int64)),
                            pa.array(marks),
                            pa.array(np.full(len(marks), seeker)),
                        ],
                        names=["key", "mark", "seeks"],
                    )

    def link(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, bool)]
        for batch in batches:
            now = [batch.column(i).to_numpy(zero_copy_only=False) for i in range(3)]
            key, mark, seeks = (np.concatenate(x) for x in zip(held, now, strict=True))
            last = int(np.searchsorted(key, key[-1])) if len(key) else 0
            held = [key[last:], mark[last:], seeks[last:]]
            yield from emit(key[:last], mark[:last], seeks[:last])
        yield from emit(*held)

    def emit(key: np.ndarray, mark: np.ndarray, seeks: np.ndarray) -> Iterator[pa.RecordBatch]:
        if len(key) < 2:
            return
        starts = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
        ends = np.r_[starts[1:], len(key)]
        wanted = (ends - starts > 1) & (np.add.reduceat(seeks.astype(np.int64), starts) > 0)
        links = []
        for i, j in zip(starts[wanted].tolist(), ends[wanted].tolist(), strict=True):
            links += forest(int(key[i]) >> 32, mark[i:j].view(np.uint64), seeks[i:j])
        if links:
            both = np.array(links, dtype=np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays(
                [pa.array(both[:, 0].copy()), pa.array(both[:, 1].copy())], names=["a", "b"]
            )

    dealt = classes.select("simhash").mapInArrow(deal, "key long, mark long, seeks boolean")
    grouped = dealt.repartition("key").sortWithinPartitions("key")
    return grouped.mapInArrow(link, "a long, b long")


def components(links: DataFrame) -> DataFrame:
    """Nodes of the links and the smallest node reachable from each: node, label.

    A round gives every node the smallest label among its neighbours, then the label of its label.
    The labels have stopped changing when each equals those of all neighbours.
    """
    edges = stored(
        links.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
        .distinct()
        .select(
            F.explode(
                F.array(F.struct("a", "b"), F.struct(F.col("b").alias("a"), F.col("a").alias("b")))
            ).alias("e")
        )
        .select(F.col("e.a").alias("node"), F.col("e.b").alias("other")),
        "edges",
    )
    labels = stored(
        edges.groupBy("node").agg(F.min("other").alias("low"), F.count("*").alias("n")).select(
            "node", F.least("node", "low").alias("label"), "n"
        ),
        "labels",
    )
    for _ in range(MAX_ROUNDS):
        seen = join_hot(
            edges, labels.select(F.col("node").alias("other"), "label", "n"), ["other"], "n",
            F.col("node"), "inner",
        )
        lowest = seen.groupBy("node").agg(F.min("label").alias("low"))
        # Most nodes of a giant component have one label, so its share of them is known to the join.
        shares = labels.groupBy("label").agg(F.count("*").alias("members"))
        jump = labels.select(F.col("node").alias("label"), F.col("label").alias("far"))
        jumps = stored(shares.join(jump, "label"), "jumps")
        further = join_hot(labels, jumps, ["label"], "members", F.col("node"), "inner")
        after = stored(
            further.join(lowest, "node").select(
                "node", F.least("far", "low", "label").alias("label"), "n", F.col("label").alias("was")
            ),
            "labels",
        )
        if after.where("label <> was").isEmpty():
            return after.select("node", "label")
        labels = after.drop("was")
    raise RuntimeError(f"labels still change after {MAX_ROUNDS} rounds")


def near_duplicates(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", size: int = 3, keep: bool = True
) -> DataFrame:
    """`docs` with `simhash` and `component_id`, the smallest doc_id reachable over links."""
    marked = fingerprints(without(docs, ["component_id"]), text, size, keep)
    ids = stored(
        fingerprints(docs.select(doc_id, text), text, size, keep=False), "simhash"
    )
    classes = stored(
        ids.groupBy("simhash").agg(F.min(doc_id).alias("least_id"), F.count("*").alias("n")),
        "classes",
    )
    labels = components(near_links(classes))
    joined = classes.join(labels, classes["simhash"] == labels["node"], "left").withColumn(
        "label", F.coalesce("label", "simhash")
    )
    linked = stored(joined.select("simhash", "least_id", "label", "n"), "classes")
    reached = stored(
        linked.groupBy("label").agg(
            F.min("least_id").alias("component_id"), F.count("*").alias("members")
        ),
        "reached",
    )
    found = join_hot(linked, reached, ["label"], "members", F.col("simhash"), "inner")
    answer = stored(found.select("simhash", "component_id", "n"), "components")
    rows = marked if keep else ids
    return join_hot(rows, answer, ["simhash"], "n", F.col(doc_id), "inner")
