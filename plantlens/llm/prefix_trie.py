"""The prefix trie of conversations, with subtree totals by time-forward processing.

A node of depth d stands for all conversations that begin with the same d turns (role and text). Its key
is the exclusive or of 128-bit hashes of (place, turn) over its path, so keys are running figures along a
conversation, and a conversation of any length is cut into blocks of `BLOCK` turns for them. Texts are
hashed where they are read and never shuffled.

Totals of subtrees (leaves, saved tokens) go upward by time-forward processing. Nodes lie sorted by
reverse level order (deepest first, then by key); a node takes the messages that wait for it in a
priority queue, which spills sorted runs to the task's scratch files, adds its own figures and sends the
total to its parent. Nodes under which over a 512th of all turns lie are heavy; the trie below each child
of a heavy node is a shard. First all shards go side by side, many in a task, each shard within one task;
then the shard roots' totals are summed per heavy parent and one last task goes over the heavy nodes, at
most 512 of each depth. Nodes of a single conversation have one leaf and save nothing, and enter as
figures of their parent.

The ids of conversations that end at a node are sorted by ranges over all tasks; ids of a node that
spans tasks are joined from pieces that are streamed through the hash.

Rows without a conversation id belong to no conversation. Turns go by `turn` (null first); of equal
numbers by a hash of role and text. Null role and text are empty. Repeated rows are turns of their own.
An empty table has no nodes. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
import heapq
import pickle
import tempfile
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from plantlens.llm.common import join_hot, stored, stored_bytes

BLOCK = 4096
HEAVY_SHARE = 512
LEAST_SHARD = 256
BROADCAST_BYTES = 32 << 20
QUEUE_ENTRIES = 200_000
PIECE_IDS = 50_000
KEY = ["depth", "a", "b"]
PARENT = ["parent_depth", "parent_a", "parent_b"]


def turns_in_order(
    conversations: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text"
) -> DataFrame:
    """(conv_id, place from 1, digest of role and text, n_bytes of the text)."""
    said, spoken_by = F.coalesce(text, F.lit("")), F.coalesce(role, F.lit(""))
    named = F.concat(F.length(spoken_by).cast("string"), F.lit(":"), spoken_by, said)
    number = F.col(turn).cast("long")
    rows = conversations.where(F.col(conv_id).isNotNull()).select(
        F.col(conv_id).cast("long").alias("conv_id"),
        number.alias("turn"),
        F.unhex(F.md5(named.cast("binary"))).alias("digest"),
        F.octet_length(said).cast("long").alias("n_bytes"),
        F.coalesce(F.floor(number / BLOCK), F.lit(-(1 << 62))).alias("block"),
    )
    inside = Window.partitionBy("conv_id", "block").orderBy(F.asc_nulls_first("turn"), "digest")
    placed = rows.select("conv_id", "block", "digest", "n_bytes", F.row_number().over(inside).alias("in_block"))
    kept = stored(placed, "turns")
    moved = kept.join(
        shifts(kept.groupBy("conv_id", "block").agg(F.count("*").alias("part")), F.sum), ["conv_id", "block"], "left"
    )
    place = F.col("in_block") + F.coalesce("before", F.lit(0))
    return moved.select("conv_id", place.cast("long").alias("place"), "digest", "n_bytes")


def shifts(parts: DataFrame, add) -> DataFrame:
    """What the blocks before each block of a conversation add up to, for all but its first block."""
    earlier = Window.partitionBy("conv_id").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    named = [c for c in parts.columns if c not in ("conv_id", "block")]
    before = {("before" if c == "part" else f"before_{c}"): add(c).over(earlier) for c in named}
    return parts.withColumns(before).drop(*named).where(F.col([*before][0]).isNotNull())


def rebuilt(turns: DataFrame, every: int, most: int) -> tuple[DataFrame, DataFrame]:
    """Conversations that begin with turns of another one, and go on with their own.

    Conversation c takes the first h turns of c - c % `every` in place of its own first h, with h =
    crc32(c in decimal) % `most`. Returns (conv_id, n_turns) and (conv_id, n_turns, depth, digest, n_bytes).
    """

    def h(conv_id: str) -> Column:
        return F.crc32(F.col(conv_id).cast("string").cast("binary")) % most

    sizes = turns.groupBy("conv_id").agg(F.max("place").alias("n_own"))
    first = F.sort_array(F.collect_list(F.struct("place", "digest", "n_bytes")))
    heads = turns.where(F.col("place") < most).groupBy(F.col("conv_id").alias("base")).agg(first.alias("head"))
    begun = sizes.withColumns({"base": F.col("conv_id") - F.col("conv_id") % every, "h": h("conv_id")})
    head = F.slice(F.coalesce("head", F.array()), F.lit(1), F.col("h").cast("int"))
    joined = begun.join(heads, "base", "left").withColumn("head", head)
    measured = joined.withColumn("n_head", F.size("head").cast("long"))
    n_turns = F.col("n_head") + F.greatest(F.col("n_own") - F.col("h"), F.lit(0))
    convs = stored(measured.select("conv_id", "n_own", "n_head", "head", n_turns.alias("n_turns")), "conversations")
    borrowed = convs.select("conv_id", "n_turns", F.posexplode("head").alias("i", "turn")).select(
        "conv_id", "n_turns", (F.col("i") + 1).cast("long").alias("depth"), "turn.digest", "turn.n_bytes"
    )
    own = join_hot(
        turns.where(F.col("place") > h("conv_id")),
        convs.select("conv_id", "n_turns", "n_head", "n_own"),
        ["conv_id"],
        "n_own",
        F.col("place"),
        "inner",
    )
    depth = F.col("place") - h("conv_id") + F.col("n_head")
    rest = own.select("conv_id", "n_turns", depth.alias("depth"), "digest", "n_bytes")
    return convs.select("conv_id", "n_turns"), borrowed.union(rest)


def as_they_are(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Conversations as they are, in the form of `rebuilt`."""
    convs = stored(turns.groupBy("conv_id").agg(F.max("place").alias("n_turns")), "conversations")
    lookup = convs.withColumn("n", F.col("n_turns"))
    steps = join_hot(turns, lookup, ["conv_id"], "n", F.col("place"), "inner")
    return convs, steps.select("conv_id", "n_turns", F.col("place").alias("depth"), "digest", "n_bytes")


def members(convs: DataFrame, steps: DataFrame) -> DataFrame:
    """A row per conversation and node on its path, root included, with the node's and its parent's key."""
    own_a, own_b = F.xxhash64("depth", "digest"), F.xxhash64(F.lit(7), "digest", "depth")
    marked = steps.select(
        "conv_id", "n_turns", "depth", "n_bytes", own_a.alias("own_a"), own_b.alias("own_b"),
        F.floor(F.col("depth") / BLOCK).alias("block"),
    )
    so_far = Window.partitionBy("conv_id", "block").orderBy("depth")
    run = marked.withColumns({k: F.bit_xor(f"own_{k}").over(so_far) for k in "ab"})
    kept = stored(run, "steps")
    blocks = kept.groupBy("conv_id", "block").agg(F.bit_xor("own_a").alias("a"), F.bit_xor("own_b").alias("b"))
    whole = kept.join(shifts(blocks, F.bit_xor), ["conv_id", "block"], "left")
    for k in "ab":
        whole = whole.withColumn(k, F.col(k).bitwiseXOR(F.coalesce(f"before_{k}", F.lit(0))))
    below = whole.select(
        "conv_id", "n_turns", *KEY, "n_bytes",
        F.col("a").bitwiseXOR(F.col("own_a")).alias("parent_a"),
        F.col("b").bitwiseXOR(F.col("own_b")).alias("parent_b"),
    )
    zero, none = F.lit(0).cast("long"), F.lit(None).cast("long")
    root = convs.select(
        "conv_id", "n_turns", zero.alias("depth"), zero.alias("a"), zero.alias("b"), zero.alias("n_bytes"),
        none.alias("parent_a"), none.alias("parent_b"),
    )
    return below.union(root)


def tree(rows: DataFrame) -> DataFrame:
    """A row per node: its figures, those of its children and its parent's conversation and weight."""
    nodes = stored(
        rows.groupBy(*KEY).agg(
            F.min("conv_id").alias("conv_id"),
            F.count("*").alias("n_convs"),
            F.max("n_bytes").alias("n_bytes"),
            F.max("parent_a").alias("parent_a"),
            F.max("parent_b").alias("parent_b"),
            F.sum(F.col("n_turns") - F.col("depth") + 1).alias("weight"),
        ),
        "nodes",
    ).withColumn("parent_depth", F.col("depth") - 1)
    children = nodes.where("depth > 0").groupBy(*(F.col(p).alias(k) for p, k in zip(PARENT, KEY, strict=True))).agg(
        F.count("*").alias("n_children"), F.count_if(F.col("n_convs") == 1).alias("n_single")
    )
    counted = stored(
        nodes.join(children, KEY, "left").fillna(0, ["n_children", "n_single"]), "counted"
    )
    parents = counted.where("n_children > 0").select(
        *(F.col(k).alias(p) for p, k in zip(PARENT, KEY, strict=True)),
        F.col("conv_id").alias("parent_conv_id"), F.col("weight").alias("parent_weight"), "n_children",
    )
    lookup = stored(parents, "parents")
    spread = F.struct("a", "b")
    below = counted.withColumnRenamed("n_children", "own_children")
    joined = join_hot(below, lookup, PARENT, "n_children", spread, "left")
    return stored(joined.withColumnRenamed("own_children", "n_children"), "tree")


class SpillingQueue:
    """A priority queue that keeps at most so many entries in memory; the rest lies in sorted runs."""

    def __init__(self, entries: int):
        self.entries = entries
        self.heap: list[tuple] = []
        self.runs: list[Iterator[tuple]] = []
        self.heads: list[tuple] = []

    def push(self, item: tuple) -> None:
        if len(self.heap) >= self.entries:
            self.spill()
        heapq.heappush(self.heap, item)

    def spill(self) -> None:
        file = tempfile.TemporaryFile()  # of this task alone, gone with it
        pickler = pickle.Pickler(file, protocol=pickle.HIGHEST_PROTOCOL)
        for item in sorted(self.heap):
            pickler.dump(item)
            pickler.clear_memo()
        file.seek(0)
        self.heap = []
        self.runs.append(self.read(file))
        self.advance(len(self.runs) - 1)

    @staticmethod
    def read(file) -> Iterator[tuple]:
        with file:
            while True:
                try:
                    yield pickle.load(file)
                except EOFError:
                    return

    def advance(self, number: int) -> None:
        item = next(self.runs[number], None)
        if item is not None:
            heapq.heappush(self.heads, (item, number))

    def take(self, key: tuple) -> Iterator[tuple]:
        """All entries that begin with `key`, which must be the least of the keys that are left."""
        n = len(key)
        while self.heap and self.heap[0][:n] == key:
            yield heapq.heappop(self.heap)
        while self.heads and self.heads[0][0][:n] == key:
            item, number = heapq.heappop(self.heads)
            self.advance(number)
            yield item


FORWARD = "depth long, a long, b long, parent_a long, parent_b long, inside boolean, n_leaves long, saved_tokens long"


def forward(sorted_nodes: DataFrame, entries: int = QUEUE_ENTRIES) -> DataFrame:
    """Totals of subtrees within each partition, whose nodes are sorted deepest first, then by key.

    Columns as FORWARD, `n_leaves` and `saved_tokens` being the node's own figures on the way in. Nodes
    that are not `inside` send nothing.
    """
    names = [part.split()[0] for part in FORWARD.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        queue = SpillingQueue(entries)
        for batch in batches:
            columns = [c.to_pylist() for c in batch.columns]
            leaves, saved = [], []
            for depth, a, b, up_a, up_b, inside, own_leaves, own_saved in zip(*columns, strict=True):
                for message in queue.take((-depth, a, b)):
                    own_leaves += message[3]
                    own_saved += message[4]
                leaves.append(own_leaves)
                saved.append(own_saved)
                if inside:
                    queue.push((1 - depth, up_a, up_b, own_leaves, own_saved))
            arrays = [*batch.columns[:6], pa.array(leaves, pa.int64()), pa.array(saved, pa.int64())]
            yield pa.RecordBatch.from_arrays(arrays, names=names)

    return sorted_nodes.select(*names).mapInArrow(run, FORWARD)


def found_in(rows: DataFrame, nodes: DataFrame, key: list[str], how: str) -> DataFrame:
    """Rows whose `key` is (how "is") or is not ("not") among the nodes (with n_convs members each)."""
    lookup = nodes.select(*(F.col(k).alias(c) for k, c in zip(KEY, key, strict=True)), "n_convs", F.lit(True).alias("met"))
    if stored_bytes(nodes) <= BROADCAST_BYTES:
        joined = rows.join(F.broadcast(lookup.drop("n_convs")), key, "left")
    else:
        joined = join_hot(rows, stored(lookup, "heavy"), key, "n_convs", F.col("conv_id"), "left")
    return joined.where("met" if how == "is" else "met IS NULL").drop("met")


def totals(nodes: DataFrame, rows: DataFrame) -> DataFrame:
    """(depth, a, b, n_leaves, saved_tokens) of the subtrees of all nodes with several members."""
    whole = nodes.where("depth = 0").agg(F.sum("weight")).first()[0] or 0
    limit = max(LEAST_SHARD, whole // HEAVY_SHARE)
    several = nodes.where("n_convs > 1").select(
        *KEY, "parent_a", "parent_b", "conv_id", "n_convs", "weight", "parent_weight",
        (F.col("n_single") + (F.col("n_children") == 0).cast("long")).alias("n_leaves"),
        ((F.col("n_convs") - 1) * F.col("n_bytes")).alias("saved_tokens"),
    )
    heavy = stored(several.where(F.col("weight") > limit), "heavy")
    # The first node on a conversation's path that is not heavy is the root of its shard.
    begins = found_in(rows.withColumn("parent_depth", F.col("depth") - 1), heavy, PARENT, "is")
    at_top = rows.where("depth = 0").withColumn("parent_depth", F.lit(-1).cast("long"))
    begins = begins.select(*at_top.columns).union(at_top)
    shards = found_in(begins, heavy, KEY, "not").select(
        "conv_id", F.col("depth").alias("shard_depth"), F.col("a").alias("shard_a"), F.col("b").alias("shard_b")
    )
    light = several.where(F.col("weight") <= limit).join(shards, "conv_id")
    order = [F.desc("depth"), "a", "b"]
    dealt = light.withColumn("inside", F.col("depth") > F.col("shard_depth"))
    below = stored(
        forward(dealt.repartition("shard_a", "shard_b").sortWithinPartitions(*order)), "shard-totals"
    )
    sent = below.where("NOT inside AND depth > 0").groupBy(
        (F.col("depth") - 1).alias("depth"), F.col("parent_a").alias("a"), F.col("parent_b").alias("b")
    ).agg(F.sum("n_leaves").alias("more_leaves"), F.sum("saved_tokens").alias("more_saved"))
    tops = heavy.join(sent, KEY, "left").withColumns(
        {
            "n_leaves": F.col("n_leaves") + F.coalesce("more_leaves", F.lit(0)),
            "saved_tokens": F.col("saved_tokens") + F.coalesce("more_saved", F.lit(0)),
            "inside": F.col("depth") > 0,
        }
    )
    above = forward(tops.coalesce(1).sortWithinPartitions(*order))
    figures = [*KEY, "n_leaves", "saved_tokens"]
    return below.select(*figures).union(above.select(*figures))


PIECES = "depth long, a long, b long, part long, piece long, digest string, ids string"
DIGESTS = "depth long, a long, b long, ends_sha256 string"


def as_batch(rows: list[tuple], ddl: str) -> pa.RecordBatch:
    fields = [field.split() for field in ddl.split(", ")]
    kinds = {"long": pa.int64(), "string": pa.string()}
    columns = [pa.array(c, kinds[kind]) for c, (_, kind) in zip(zip(*rows, strict=True), fields, strict=True)]
    return pa.RecordBatch.from_arrays(columns, names=[name for name, _ in fields])


def ends(rows: DataFrame) -> DataFrame:
    """(depth, a, b, ends_sha256) of the nodes where conversations end.

    The ids are sorted by ranges. A range gives the digest of a node that lies inside it and has few
    ids; the others, and its first and last node, which may go on in the next range, come in pieces.
    """
    last = rows.where("depth = n_turns").select(*KEY, "conv_id")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, out, ids = TaskContext.get().partitionId(), [], []
        node, piece, first = None, 0, True

        def add_piece() -> None:
            nonlocal ids, piece
            out.append((*node, part, piece, None, ",".join(ids)))
            ids, piece = [], piece + 1

        for batch in batches:
            for depth, a, b, conv_id in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if (depth, a, b) != node:
                    if node is not None and (first or piece):
                        if ids:
                            add_piece()
                    elif node is not None:
                        digest = hashlib.sha256(",".join(ids).encode()).hexdigest()
                        out.append((*node, part, 0, digest, None))
                    first = node is None
                    node, piece, ids = (depth, a, b), 0, []
                ids.append(str(conv_id))
                if len(ids) >= PIECE_IDS:
                    add_piece()
                    yield as_batch(out, PIECES)
                    out = []
            if len(out) > 1000:
                yield as_batch(out, PIECES)
                out = []
        if ids:
            add_piece()
        if out:
            yield as_batch(out, PIECES)

    def joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, digest, out = None, None, []
        for batch in batches:
            for depth, a, b, ids in zip(*(batch.column(i).to_pylist() for i in (0, 1, 2, 6)), strict=True):
                if (depth, a, b) != node:
                    if node is not None:
                        out.append((*node, digest.hexdigest()))
                    node, digest = (depth, a, b), hashlib.sha256(ids.encode())
                else:
                    digest.update(b"," + ids.encode())
            if out:
                yield as_batch(out, DIGESTS)
                out = []
        if node is not None:
            yield as_batch([(*node, digest.hexdigest())], DIGESTS)

    order = [*KEY, "conv_id"]
    ranged = last.repartitionByRange(*order).sortWithinPartitions(*order)
    found = stored(ranged.mapInArrow(cut, PIECES), "ends")
    pieces = found.where("digest IS NULL").repartition(*KEY).sortWithinPartitions(*KEY, "part", "piece")
    whole = found.where("digest IS NOT NULL").select(*KEY, F.col("digest").alias("ends_sha256"))
    return whole.union(pieces.mapInArrow(joined, DIGESTS))


def prefix_trie(convs: DataFrame, steps: DataFrame) -> DataFrame:
    """A row per node of the trie of `convs` and `steps` (see `rebuilt` and `as_they_are`).

    (conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256)
    """
    rows = stored(members(convs, steps), "members")
    nodes = tree(rows)
    nothing = hashlib.sha256(b"").hexdigest()
    whole = nodes.join(totals(nodes, rows), KEY, "left").join(ends(rows), KEY, "left")
    return whole.select(
        "conv_id",
        "depth",
        "parent_conv_id",
        "n_convs",
        "n_children",
        F.coalesce("n_leaves", F.lit(1)).cast("long").alias("n_leaves"),
        F.coalesce("saved_tokens", F.lit(0)).cast("long").alias("saved_tokens"),
        F.coalesce("ends_sha256", F.lit(nothing)).alias("ends_sha256"),
    )
