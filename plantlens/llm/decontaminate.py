"""Benchmark decontamination with an FM-index per shard of the training data.

A task cuts its documents into shards of some megabytes of text. Words outside the vocabulary of
the test phrases can be in no occurrence, so a shard's sequence holds the maximal runs of words
inside it that are as long as the shortest phrase at least. Over that sequence it builds a suffix
array, the Burrows-Wheeler transform in a wavelet matrix, and every eighth suffix position. All
phrases are searched backward at once by ranks, their occurrences located by steps to the next
sampled position, and the spans of a document merged. Nothing is shuffled.

The phrases are the stated query set: all runs of `size` words of an item, or the whole item if it
is shorter. They are broadcast in blocks of at most about `BLOCK_BYTES` of item text (one item at
least), as arrays of some ten times that size; each block is another pass, after which the rows are
stored.

Words are `[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+` after lowering A-Z. Null and empty texts have no
words; items without words match nothing. Items with a null id count as one item whose id is the
empty string; rows with the same id are one item. Repeated documents get the same answer each.
Input columns named like an output column are replaced.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from plantlens.llm.common import slices, stored, without

WINDOW = 13
SHARD_BYTES = 16 << 20
BLOCK_BYTES = 3 << 20
SAMPLE_EVERY = 8
WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
KEPT = bytes(
    c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32
    for c in range(256)
)
SPAN = T.StructType(
    [T.StructField("start", T.LongType(), False), T.StructField("end", T.LongType(), False)]
)
FIELDS = [
    T.StructField("n_words", T.LongType()),
    T.StructField("n_hit", T.LongType()),
    T.StructField("item_ids", T.ArrayType(T.StringType())),
    T.StructField("removal_spans", T.ArrayType(SPAN)),
]


def words_of(text: bytes) -> list[bytes]:
    return text.translate(KEPT).split()


def suffix_array(sequence: np.ndarray) -> np.ndarray:
    """Sorted suffixes by doubling the compared length. The last symbol is the smallest, once."""
    n, step = len(sequence), 1
    rank = np.unique(sequence, return_inverse=True)[1].astype(np.int64)
    while True:
        behind = np.zeros(n, dtype=np.int64)
        behind[: n - step] = rank[step:] + 1
        key = rank * (n + 1) + behind
        order = np.argsort(key, kind="stable")
        ordered = key[order]
        rank[order] = np.cumsum(np.r_[0, ordered[1:] != ordered[:-1]])
        if rank[order[-1]] == n - 1:
            return order
        step *= 2


class WaveletMatrix:
    """Ranks of symbols in a sequence, one bit level at a time."""

    def __init__(self, symbols: np.ndarray):
        self.bits = max(1, int(symbols.max()).bit_length())
        self.ones, self.zeros = [], []
        for level in reversed(range(self.bits)):
            bit = (symbols >> level) & 1
            self.ones.append(np.r_[0, np.cumsum(bit)].astype(np.int32))
            self.zeros.append(len(symbols) - int(bit.sum()))
            symbols = np.concatenate([symbols[bit == 0], symbols[bit == 1]])

    def rank(self, symbol: np.ndarray, before: np.ndarray) -> np.ndarray:
        """How often each symbol occurs in front of each position."""
        low, high = np.zeros_like(before), before
        for i, level in enumerate(reversed(range(self.bits))):
            one = ((symbol >> level) & 1).astype(bool)
            ones, zeros = self.ones[i], self.zeros[i]
            low_ones, high_ones = ones[low], ones[high]
            low = np.where(one, zeros + low_ones, low - low_ones)
            high = np.where(one, zeros + high_ones, high - high_ones)
        return high - low


class FMIndex:
    """Full-text index over a sequence of small integers above 0."""

    def __init__(self, sequence: np.ndarray):
        closed = np.r_[sequence, 0].astype(np.int64)
        order = suffix_array(closed)
        self.last = closed[order - 1]
        self.matrix = WaveletMatrix(self.last)
        self.before = np.r_[0, np.cumsum(np.bincount(closed))]
        sampled = order % SAMPLE_EVERY == 0
        self.sampled, self.samples = sampled, order[sampled]
        self.sample_at = np.cumsum(sampled) - 1

    def search(self, phrases: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ranges of suffixes that begin with each phrase (a row of symbols, 0 behind its end)."""
        low = np.zeros(len(phrases), dtype=np.int64)
        high = np.full(len(phrases), len(self.last), dtype=np.int64)
        for place in reversed(range(phrases.shape[1])):
            live = np.flatnonzero((lengths > place) & (low < high))
            symbol = phrases[live, place]
            known = symbol < len(self.before) - 1
            high[live[~known]] = low[live[~known]]
            live, symbol = live[known], symbol[known]
            start = self.before[symbol]
            low[live] = start + self.matrix.rank(symbol, low[live])
            high[live] = start + self.matrix.rank(symbol, high[live])
        return low, np.maximum(low, high)

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Text positions of suffixes: walk back until a sampled one."""
        at, steps = rows.copy(), np.zeros(len(rows), dtype=np.int64)
        while len(walking := np.flatnonzero(~self.sampled[at])):
            symbol = self.last[at[walking]]
            at[walking] = self.before[symbol] + self.matrix.rank(symbol, at[walking])
            steps[walking] += 1
        return self.samples[self.sample_at[at]] + steps


@dataclass(frozen=True)
class Phrases:
    """Distinct phrases as symbol rows, and the items of each: items[owners[starts[i]:starts[i + 1]]]."""

    vocabulary: dict[bytes, int]
    rows: np.ndarray
    lengths: np.ndarray
    items: list[str]
    starts: np.ndarray
    owners: np.ndarray

    @classmethod
    def of(cls, items: list[tuple[str, bytes]], size: int) -> Phrases:
        vocabulary: dict[bytes, int] = {}
        names = sorted({item for item, _ in items})
        number = {item: i for i, item in enumerate(names)}
        windows, owners = [np.zeros((0, size), np.int32)], [np.zeros(0, np.int32)]
        for item, text in items:
            words = words_of(text)
            if not words:
                continue
            ids = np.array([vocabulary.setdefault(w, len(vocabulary) + 2) for w in words], np.int32)
            ids = np.pad(ids, (0, max(0, size - len(ids))))
            windows.append(np.lib.stride_tricks.sliding_window_view(ids, size))
            owners.append(np.full(len(windows[-1]), number[item], np.int32))
        rows, which = np.unique(np.concatenate(windows), axis=0, return_inverse=True)
        pairs = np.unique(np.column_stack([which.reshape(-1), np.concatenate(owners)]), axis=0)
        starts = np.searchsorted(pairs[:, 0], np.arange(len(rows) + 1))
        return cls(vocabulary, rows, (rows > 0).sum(axis=1), names, starts, pairs[:, 1].astype(np.int32))

    def items_of(self, phrase: int) -> list[str]:
        return [self.items[i] for i in self.owners[self.starts[phrase] : self.starts[phrase + 1]]]

    def parts(self) -> tuple:
        """What `Phrases(*parts)` is made of again on an executor."""
        return self.vocabulary, self.rows, self.lengths, self.items, self.starts, self.owners


def runs(words: list[bytes], vocabulary: dict[bytes, int], least: int) -> tuple[np.ndarray, ...]:
    """Symbols and word numbers of the runs of known words, each run followed by the symbol 1."""
    symbols = np.fromiter(map(vocabulary.get, words, [0] * len(words)), np.int64, len(words))
    known = np.flatnonzero(np.diff(np.r_[0, symbols != 0, 0]))
    begins, ends = known[::2], known[1::2]
    long = ends - begins >= least
    if not long.any():
        return np.empty(0, np.int64), np.empty(0, np.int64)
    places = np.concatenate([np.arange(b, e + 1) for b, e in zip(begins[long], ends[long])])
    padded = np.r_[symbols, 0][places]
    return np.where(padded == 0, 1, padded), places


def search_shard(texts: list[bytes], phrases: Phrases) -> tuple[list[int], dict[int, tuple]]:
    """Word counts of the texts, and for those with hits their merged word spans and item ids."""
    least = int(phrases.lengths.min()) if len(phrases.lengths) else 1 << 60
    n_words, symbols, places, owners = [], [], [], []
    for i, text in enumerate(texts):
        words = words_of(text)
        n_words.append(len(words))
        if len(words) >= least:
            own, where = runs(words, phrases.vocabulary, least)
            symbols.append(own)
            places.append(where)
            owners.append(np.full(len(own), i))
    if not sum(map(len, symbols)):
        return n_words, {}
    place, owner = np.concatenate(places), np.concatenate(owners)
    index = FMIndex(np.concatenate(symbols))
    low, high = index.search(phrases.rows, phrases.lengths)
    which = np.repeat(np.arange(len(low)), high - low)
    if not len(which):
        return n_words, {}
    offset = np.arange(len(which)) - np.repeat(np.cumsum(high - low) - (high - low), high - low)
    at = index.locate(low[which] + offset)
    doc, begin, length = owner[at], place[at], phrases.lengths[which]
    order = np.lexsort((begin, doc))
    hits: dict[int, tuple[list, set]] = {}
    for i in order.tolist():
        spans, ids = hits.setdefault(int(doc[i]), ([], set()))
        start, end = int(begin[i]), int(begin[i] + length[i])
        if spans and start <= spans[-1][1]:
            spans[-1][1] = max(spans[-1][1], end)
        else:
            spans.append([start, end])
        ids.update(phrases.items_of(int(which[i])))
    return n_words, hits


def text_spans(text: bytes, word_spans: list[list[int]]) -> list[dict[str, int]]:
    """Spans of words as spans of code points."""
    words = [m.span() for m in WORD.finditer(as_read(text).translate(LOWER))]
    return [{"start": words[b][0], "end": words[e - 1][1]} for b, e in word_spans]


LOWER = {c: c + 32 for c in range(65, 91)}


def as_read(text: bytes) -> str:
    """A text by code points; each byte that is not UTF-8 is one."""
    return text.decode("utf-8", "surrogateescape")


def merge(spans: list[dict[str, int]]) -> list[dict[str, int]]:
    out: list[dict[str, int]] = []
    for span in sorted(spans, key=lambda s: s["start"]):
        if out and span["start"] <= out[-1]["end"]:
            out[-1]["end"] = max(out[-1]["end"], span["end"])
        else:
            out.append(dict(span))
    return out


def find_passages(
    docs: DataFrame,
    benchmark: DataFrame,
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    size: int = WINDOW,
    keep: bool = True,
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """`docs` with n_words, n_hit, item_ids and removal_spans (code points, end exclusive)."""
    items = benchmark.select(
        F.coalesce(F.col(item_id).cast("string"), F.lit("")).alias("item"),
        F.coalesce(F.col(item_text), F.lit("")).cast("binary").alias("words"),
    )
    volume = items.agg(F.sum(F.length("words"))).first()[0] or 0
    blocks = max(1, -(-volume // block_bytes))
    found = docs
    for block in range(blocks):
        some = items if blocks == 1 else items.where(F.pmod(F.xxhash64("words"), F.lit(blocks)) == block)
        phrases = Phrases.of([(r["item"], bytes(r["words"])) for r in some.collect()], size)
        found = _search(found, phrases, text, first=block == 0)
        if block < blocks - 1:
            found = stored(found, "passages")
    return found if keep else found.drop(text)


def _search(docs: DataFrame, phrases: Phrases, text: str, first: bool) -> DataFrame:
    names = [field.name for field in FIELDS]
    base = without(docs, names)
    before = [] if first else ["item_ids", "removal_spans"]
    source = docs.select(
        *(F.col(f"`{c}`") for c in base.columns),
        F.col(f"`{text}`").cast("binary").alias("_bytes"),
        *(F.col(c).alias(f"_{c}") for c in before),
    )
    schema = T.StructType([*base.schema.fields, *FIELDS])
    arrow = to_arrow_schema(schema)
    kinds = [arrow.field(name).type for name in names]
    n_kept = len(base.columns)
    # A broadcast is of plain values: a class in it would have to be installed on the executors.
    shared = docs.sparkSession.sparkContext.broadcast(phrases.parts())
    opened: list[Phrases] = []

    def answer(parts: list[pa.RecordBatch], texts: list[bytes]) -> Iterator[pa.RecordBatch]:
        if not opened:
            opened.append(Phrases(*shared.value))
        n_words, hits = search_shard(texts, opened[0])
        at = 0
        for part in parts:
            rows = range(at, at + part.num_rows)
            at += part.num_rows
            items = [sorted(hits[i][1]) if i in hits else [] for i in rows]
            spans = [text_spans(texts[i], hits[i][0]) if i in hits else [] for i in rows]
            n_hit = [sum(e - b for b, e in hits[i][0]) if i in hits else 0 for i in rows]
            if not first:
                old_items, old_spans = (part.column(n_kept + k).to_pylist() for k in (1, 2))
                items = [sorted({*a, *b}) for a, b in zip(items, old_items, strict=True)]
                spans = [merge(a + b) for a, b in zip(spans, old_spans, strict=True)]
                n_hit = [
                    sum(
                        len(WORD.findall(as_read(texts[i]).translate(LOWER)[s["start"] : s["end"]]))
                        for s in own
                    )
                    for i, own in zip(rows, spans, strict=True)
                ]
            columns = [n_words[rows.start : rows.stop], n_hit, items, spans]
            yield pa.RecordBatch.from_arrays(
                [
                    *(part.column(i) for i in range(n_kept)),
                    *(pa.array(c, kind) for c, kind in zip(columns, kinds, strict=True)),
                ],
                names=[*part.schema.names[:n_kept], *names],
            )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, texts, volume = [], [], 0
        for batch in batches:
            for part in slices(batch):
                own = [t or b"" for t in part.column(n_kept).to_pylist()]
                parts.append(part)
                texts += own
                volume += sum(map(len, own))
                if volume >= SHARD_BYTES:
                    yield from answer(parts, texts)
                    parts, texts, volume = [], [], 0
        yield from answer(parts, texts)

    return source.mapInArrow(run, schema)


def contaminated():
    """Hit words make up a twentieth of all words or more."""
    return (F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words"))


def cut_passages(found: DataFrame, text: str = "text") -> DataFrame:
    """The texts of `find_passages` without their removal spans."""
    end = F.length(f"`{text}`")
    begins = F.concat(F.array(F.lit(0).cast("long")), F.col("removal_spans.end"))
    ends = F.concat(F.col("removal_spans.start"), F.array(end.cast("long")))
    pieces = F.transform(
        F.arrays_zip(begins.alias("b"), ends.alias("e")),
        lambda s: F.substring(F.col(f"`{text}`"), s["b"].cast("int") + 1, (s["e"] - s["b"]).cast("int")),
    )
    return found.withColumn(text, F.array_join(pieces, ""))
