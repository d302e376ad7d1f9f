"""Line dedup that can be taken back: exact counts of documents per line, with cuckoo filters.

The state is a table of reference counts (128-bit hash of the line's key, number of documents that
have it) and one cuckoo filter per shard holding the lines found in at least `min_docs` documents.
Adding and removing documents change the counts by one per distinct line and document, and insert
into or delete from the filters the lines that cross the threshold. Removing what was added gives
the counts of before.

Cleaning reads the documents once without a shuffle. The filters are broadcast, and so are the few
rare lines of the table that a filter takes for frequent ones, so that each answer is exact for
documents that have been counted. Filters beyond `BROADCAST_BYTES` are not broadcast: the lines
are then joined to the counts, with hot lines salted.

A line's key is the line without ASCII white space at both ends, A-Z in lower case. Each row counts
as one document, also where rows repeat. Null and empty texts have one empty line; empty keys are
never counted nor dropped. Bytes that are not UTF-8 come out as U+FFFD. Input columns named like an output column are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plantlens.llm.common import fresh, join_hot, map_texts, slices, stored, without

BROADCAST_BYTES = 128 << 20
KEYS_PER_SHARD = 1 << 16
SLOTS = 4
MAX_KICKS = 500
FILTER_SCHEMA = "shard int, slots binary, overflow boolean"


def line_keys(text: bytes) -> tuple[list[bytes], list[bytes]]:
    """The lines of a text and their keys."""
    lines = text.split(b"\n")
    return lines, [line.strip().lower() for line in lines]


def key_hashes(keys: list[bytes]) -> np.ndarray:
    """Two 64-bit halves of a 128-bit hash for each key."""
    digests = b"".join([xxhash.xxh3_128_digest(key) for key in keys])
    return np.frombuffer(digests, dtype="<i8").reshape(-1, 2)


def places(h2: np.ndarray, n_buckets: np.ndarray | int) -> tuple[np.ndarray, ...]:
    """Fingerprint (never 0) and the two buckets of a key. Bucket numbers are powers of two."""
    bits = h2.astype(np.uint64)
    mask = np.asarray(n_buckets, dtype=np.uint64) - np.uint64(1)
    mark = (bits >> np.uint64(32)).astype(np.uint32)
    mark = np.where(mark == 0, np.uint32(1), mark)
    first = bits & mask
    return mark, first, first ^ (spin(mark) & mask)


def spin(mark: np.ndarray) -> np.ndarray:
    """Offset between the two buckets of a fingerprint."""
    return (mark.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(33)


class CuckooFilter:
    """Four slots a bucket, 32-bit fingerprints, insertion by eviction, deletion."""

    def __init__(self, slots: np.ndarray):
        self.slots = slots

    @classmethod
    def empty(cls, n_keys: int) -> CuckooFilter:
        buckets = 1 << max(4, int(np.ceil(np.log2(max(1, n_keys) / SLOTS / 0.8))))
        return cls(np.zeros((buckets, SLOTS), dtype=np.uint32))

    @classmethod
    def of(cls, blob: bytes) -> CuckooFilter:
        return cls(np.frombuffer(blob, dtype=np.uint32).reshape(-1, SLOTS).copy())

    def insert(self, h2: np.ndarray) -> bool:
        """False if a key found no place; the filter then has to be built anew, larger."""
        marks, firsts, seconds = places(h2, len(self.slots))
        for mark, first, second in zip(marks, firsts.tolist(), seconds.tolist(), strict=True):
            if not (self._put(mark, first) or self._put(mark, second)):
                if not self._evict(mark, second):
                    return False
        return True

    def _put(self, mark: np.uint32, bucket: int) -> bool:
        row = self.slots[bucket]
        for i in range(SLOTS):
            if row[i] == 0:
                row[i] = mark
                return True
        return False

    def _evict(self, mark: np.uint32, bucket: int) -> bool:
        mask = len(self.slots) - 1
        for kick in range(MAX_KICKS):
            place = kick % SLOTS
            mark, self.slots[bucket, place] = self.slots[bucket, place], mark
            bucket ^= int(spin(np.array([mark]))[0]) & mask
            if self._put(mark, bucket):
                return True
        return False

    def delete(self, h2: np.ndarray) -> None:
        """Take out keys that were inserted; one fingerprint each."""
        marks, firsts, seconds = places(h2, len(self.slots))
        for mark, *both in zip(marks, firsts.tolist(), seconds.tolist(), strict=True):
            for bucket in both:
                found = np.flatnonzero(self.slots[bucket] == mark)
                if len(found):
                    self.slots[bucket, found[0]] = 0
                    break


class ShardedFilters:
    """All filters of a state in one array, probed for many keys at once."""

    def __init__(self, blobs: dict[int, bytes], shards: int):
        arrays = [
            np.frombuffer(blobs[s], dtype=np.uint32).reshape(-1, SLOTS)
            if s in blobs
            else np.zeros((1, SLOTS), dtype=np.uint32)
            for s in range(shards)
        ]
        self.sizes = np.array([len(a) for a in arrays], dtype=np.uint64)
        self.starts = np.cumsum(self.sizes) - self.sizes
        self.slots = np.concatenate(arrays)

    def contains(self, hashes: np.ndarray) -> np.ndarray:
        shard = np.mod(hashes[:, 0], len(self.sizes))
        mark, first, second = places(hashes[:, 1], self.sizes[shard])
        start = self.starts[shard]
        found = (self.slots[start + first] == mark[:, None]).any(axis=1)
        return found | (self.slots[start + second] == mark[:, None]).any(axis=1)


@dataclass(frozen=True)
class LineState:
    """Reference counts (shard, h1, h2, n) and filters (shard, slots), both stored."""

    counts: DataFrame
    filters: DataFrame
    min_docs: int
    shards: int


def count_lines(docs: DataFrame, text: str = "text") -> DataFrame:
    """Number of documents per line key: h1, h2, n."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                digests = []
                for value in part.column(0).to_pylist():
                    for key in set(line_keys(value or b"")[1]) - {b""}:
                        digests.append(xxhash.xxh3_128_digest(key))
                both = np.frombuffer(b"".join(digests), dtype="<i8").reshape(-1, 2)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(both[:, 0]), pa.array(both[:, 1])], names=["h1", "h2"]
                )

    source = docs.select(F.col(f"`{text}`").cast("binary").alias("_bytes"))
    return (
        source.mapInArrow(run, "h1 long, h2 long").groupBy("h1", "h2").agg(F.count("*").alias("n"))
    )


def build_filters(counts: DataFrame, min_docs: int) -> DataFrame:
    """A cuckoo filter per shard over the lines of at least `min_docs` documents."""

    def build(pdf: pd.DataFrame) -> pd.DataFrame:
        h2, room = pdf["h2"].to_numpy(), len(pdf)
        while not (made := CuckooFilter.empty(room)).insert(h2):
            room *= 2
        return pd.DataFrame(
            {"shard": [pdf["shard"].iloc[0]], "slots": [made.slots.tobytes()], "overflow": [False]}
        )

    frequent = counts.where(F.col("n") >= min_docs).select("shard", "h2")
    return stored(frequent.groupBy("shard").applyInPandas(build, FILTER_SCHEMA), "filters")


def start(docs: DataFrame, min_docs: int = 10, text: str = "text") -> LineState:
    """The state of a first set of documents."""
    counted = stored(count_lines(docs, text), "lines")
    frequent = counted.where(F.col("n") >= min_docs).count()
    shards = max(8, -(-frequent // KEYS_PER_SHARD))
    counts = counted.withColumn("shard", F.pmod("h1", F.lit(shards)).cast("int"))
    return LineState(counts, build_filters(counts, min_docs), min_docs, shards)


def add_documents(state: LineState, docs: DataFrame, text: str = "text") -> LineState:
    return _change(state, docs, 1, text)


def remove_documents(state: LineState, docs: DataFrame, text: str = "text") -> LineState:
    """Take back documents that were added before, with the texts they had then."""
    return _change(state, docs, -1, text)


def _change(state: LineState, docs: DataFrame, sign: int, text: str) -> LineState:
    least, shards = state.min_docs, state.shards
    delta = count_lines(docs, text).select(
        "h1", "h2", F.lit(0).cast("long").alias("before"), (F.col("n") * sign).alias("change")
    )
    merged = stored(
        state.counts.select(
            "h1", "h2", F.col("n").alias("before"), F.lit(0).cast("long").alias("change")
        )
        .unionByName(delta)
        .groupBy("h1", "h2")
        .agg(F.sum("before").alias("before"), F.sum("change").alias("change"))
        .withColumn("n", F.col("before") + F.col("change")),
        "lines",
    )
    sharded = merged.withColumn("shard", F.pmod("h1", F.lit(shards)).cast("int"))
    was, now = F.col("before") >= least, F.col("n") >= least
    crossing = sharded.where(was != now).select("shard", "h2", now.alias("enters"))

    def apply(old: pd.DataFrame, moves: pd.DataFrame) -> pd.DataFrame:
        shard = (old if len(old) else moves)["shard"].iloc[0]
        made = CuckooFilter.of(old["slots"].iloc[0]) if len(old) else CuckooFilter.empty(len(moves))
        made.delete(moves.loc[~moves["enters"], "h2"].to_numpy())
        fits = made.insert(moves.loc[moves["enters"], "h2"].to_numpy())
        return pd.DataFrame(
            {"shard": [shard], "slots": [made.slots.tobytes()], "overflow": [not fits]}
        )

    filters = stored(
        state.filters.groupBy("shard")
        .cogroup(crossing.groupBy("shard"))
        .applyInPandas(apply, FILTER_SCHEMA),
        "filters",
    )
    counts = sharded.where("n > 0").select("h1", "h2", "n", "shard")
    if not filters.where("overflow").isEmpty():
        filters = build_filters(counts, least)
    return replace(state, counts=counts, filters=filters)


def clean(
    docs: DataFrame, state: LineState, text: str = "text", max_broadcast: int = BROADCAST_BYTES
) -> DataFrame:
    """`docs` without their frequent lines; n_lines and n_dropped are added.

    The documents must be among those counted in `state`.
    """
    size = state.filters.agg(F.sum(F.length("slots"))).first()[0] or 0
    if size > max_broadcast:
        return _clean_by_join(docs, state, text)
    blobs = {row["shard"]: bytes(row["slots"]) for row in state.filters.collect()}
    # Broadcasts are of plain values: classes in them would have to be installed on the executors.
    shared, n_shards = docs.sparkSession.sparkContext.broadcast(blobs), state.shards

    def mistaken(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        filters = ShardedFilters(shared.value, n_shards)
        for batch in batches:
            both = np.column_stack([batch.column(0).to_numpy(), batch.column(1).to_numpy()])
            yield batch.filter(pa.array(filters.contains(both)))

    rare = state.counts.where(F.col("n") < state.min_docs).select("h1", "h2")
    most = max_broadcast // 1000
    wrong = rare.mapInArrow(mistaken, "h1 long, h2 long").limit(most).collect()
    if len(wrong) == most:
        return _clean_by_join(docs, state, text)
    exceptions = {(row["h1"], row["h2"]) for row in wrong}
    opened: list[ShardedFilters] = []

    def compute(texts: list[bytes]) -> list:
        if not opened:
            opened.append(ShardedFilters(shared.value, n_shards))
        split = [line_keys(t) for t in texts]
        keys = [key for _, own in split for key in own]
        hashes = key_hashes(keys)
        hit = opened[0].contains(hashes)
        if exceptions:
            for i in np.flatnonzero(hit):
                hit[i] = (int(hashes[i, 0]), int(hashes[i, 1])) not in exceptions
        kept, n_lines, n_dropped, at = [], [], [], 0
        for lines, own in split:
            dropped = hit[at : at + len(lines)]
            at += len(lines)
            gone = [d and bool(k) for d, k in zip(dropped.tolist(), own, strict=True)]
            kept.append(b"\n".join([x for x, g in zip(lines, gone, strict=True) if not g]).decode("utf-8", "replace"))
            n_lines.append(len(lines))
            n_dropped.append(sum(gone))
        return [kept, n_lines, n_dropped]

    return map_texts(docs, text, _fields(text), compute)


def _fields(text: str) -> list[T.StructField]:
    return [
        T.StructField(text, T.StringType()),
        T.StructField("n_lines", T.LongType()),
        T.StructField("n_dropped", T.LongType()),
    ]


def _clean_by_join(docs: DataFrame, state: LineState, text: str) -> DataFrame:
    """The same by a join of all lines to the counts."""
    rest = without(docs, ["n_lines", "n_dropped"])
    row_id, gone_lines = fresh("_row", rest), fresh("_gone", rest)
    numbered = stored(rest.withColumn(row_id, F.monotonically_increasing_id()), "numbered")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                rows, digests = [], []
                for row, value in zip(*(c.to_pylist() for c in part.columns), strict=True):
                    own = [xxhash.xxh3_128_digest(k) for k in set(line_keys(value)[1]) - {b""}]
                    rows += [row] * len(own)
                    digests += own
                both = np.frombuffer(b"".join(digests), dtype="<i8").reshape(-1, 2)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(rows, pa.int64()), pa.array(both[:, 0]), pa.array(both[:, 1])],
                    names=["_row", "h1", "h2"],
                )

    text_bytes = F.coalesce(F.col(f"`{text}`"), F.lit("")).cast("binary")
    lines = numbered.select(row_id, text_bytes).mapInArrow(run, "_row long, h1 long, h2 long")
    frequent = stored(state.counts.where(F.col("n") >= state.min_docs).select("h1", "h2", "n"), "f")
    hits = join_hot(lines, frequent, ["h1", "h2"], "n", F.col("_row"), "inner")
    gone = hits.groupBy(F.col("_row").alias(row_id)).agg(
        F.collect_list(F.struct("h1", "h2")).alias(gone_lines)
    )
    bytes_of = {text: F.col(f"`{text}`").cast("binary")}
    marked = numbered.join(gone, row_id, "left").drop(row_id).withColumns(bytes_of)
    kept = [c for c in rest.columns if c != text]

    def strip(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                names = part.schema.names
                out, n_lines, n_dropped = [], [], []
                gone = part.column(names.index(gone_lines)).to_pylist()
                texts = part.column(names.index(text)).to_pylist()
                for value, own in zip(texts, gone, strict=True):
                    lines, keys = line_keys(value or b"")
                    bad = {(x["h1"], x["h2"]) for x in own or []}
                    hashes = key_hashes(keys).tolist()
                    stay = [
                        line
                        for line, key, h in zip(lines, keys, hashes, strict=True)
                        if not key or tuple(h) not in bad
                    ]
                    out.append(b"\n".join(stay).decode("utf-8", "replace"))
                    n_lines.append(len(lines))
                    n_dropped.append(len(lines) - len(stay))
                columns = [part.column(names.index(c)) for c in kept]
                added = [pa.array(out), pa.array(n_lines, pa.int64()), pa.array(n_dropped, pa.int64())]
                yield pa.RecordBatch.from_arrays(
                    [*columns, *added], names=[*kept, text, "n_lines", "n_dropped"]
                )

    fields = [*(f for f in rest.schema.fields if f.name != text), *_fields(text)]
    return marked.mapInArrow(strip, T.StructType(fields))
