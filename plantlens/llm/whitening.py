"""Whitening of embeddings by the leading eigenvectors of their covariance, found by Jacobi-Davidson.

Entries c become whole numbers x = floor(1024 c) + 100000, so that counts, sums and deviations are
exact. The covariance V is never formed: V times a thin block is one distributed pass over the centred
vectors, stored once in packed blocks. Of each pass the driver gets one such block per task, or per
group of tasks beyond `PARTIAL_BYTES`, whatever the number of rows.

Jacobi-Davidson keeps a subspace of at most `SUBSPACE` vectors. Each round takes the Ritz pairs of the
subspace, locks the leading ones whose residuals have reached double precision, and solves for each of
the other wanted ones the correction equation, projected against what is locked and the leading Ritz
vectors, by `STEPS` steps of MINRES. All equations go side by side, so that a step is one pass. The
corrections extend the subspace; when it is full it restarts from its leading Ritz vectors.

Rows whose vector is null or holds null or non-finite entries are left out, and so are entries beyond
2^52 in size and vectors of another length than the most frequent one (of several the longest).
Eigenvalues that are zero to double precision give no component: equal vectors have none. Repeated rows
count as often as they occur; ids may be null. A deviation beyond a long is null. Input columns named
like an output column are replaced. An empty table stays empty.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from plantlens.llm.common import fresh, stored, without

SCALE, SHIFT = 1024, 100_000
COMPONENTS = 8
GUARD = 16
SUBSPACE = 48
STEPS = 5
MAX_ROUNDS = 100
EPS = np.finfo(float).eps
BLOCK_BYTES = 1 << 20
TASK_BYTES = 4 << 20
LARGEST_TASK_BYTES = 64 << 20
PARTIAL_BYTES = 32 << 20
ADDED = ["deviation", "whitened"]


@dataclass(frozen=True)
class Whitening:
    """`components` has a unit eigenvector per column, of the covariance of the whole numbers."""

    n: int
    sums: tuple[int, ...]
    components: np.ndarray
    eigenvalues: np.ndarray
    trace: float
    residual: float
    passes: int
    identity_error: float

    @property
    def explained(self) -> np.ndarray:
        return self.eigenvalues / self.trace if len(self.eigenvalues) else self.eigenvalues


def usable(vector: str, size: int | None = None) -> Column:
    """Whether a row takes part."""
    c = F.col(f"`{vector}`")
    bound = F.lit(float(1 << 52))
    fits = F.forall(c, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) < bound))
    whole = c.isNotNull() & F.coalesce(fits, F.lit(False))
    return whole if size is None else whole & (F.size(c) == size)


def matrix(column: pa.Array, size: int) -> np.ndarray:
    """The whole numbers of a batch of vectors, one per row."""
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return np.floor(flat * SCALE).astype(np.int64).reshape(-1, size) + SHIFT


def deviations(x: np.ndarray, n: int, sums: np.ndarray) -> np.ndarray:
    """n x - S, exact: of Python's integers where 64 bits may be too few."""
    largest = n * int(np.abs(x).max(initial=0)) + max(map(abs, sums.tolist()), default=0)
    if largest < 1 << 62:
        return x * n - sums.astype(np.int64)
    return x.astype(object) * n - sums


def exact_sums(rows: DataFrame, vector: str, size: int) -> tuple[int, list[int]]:
    """Number of rows and exact sums of their whole numbers, one figure per task and dimension."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, sums = 0, np.zeros(size, dtype=object)
        for batch in batches:
            x = matrix(batch.column(0), size)
            n += len(x)
            safe = int(np.abs(x).max(initial=0)) * max(1, len(x)) < 1 << 62
            sums += (x if safe else x.astype(object)).sum(axis=0).astype(object)
        places = [-1, *range(size)]
        yield pa.RecordBatch.from_arrays(
            [pa.array(places, pa.int32()), pa.array([str(v) for v in (n, *sums)], pa.string())],
            names=["place", "total"],
        )

    parts = rows.select(f"`{vector}`").mapInArrow(run, "place int, total string")
    found = dict(parts.groupBy("place").agg(F.sum(F.col("total").cast("decimal(38,0)"))).collect())
    return int(found.get(-1) or 0), [int(found.get(i) or 0) for i in range(size)]


def centred_blocks(rows: DataFrame, vector: str, n: int, sums: list[int]) -> DataFrame:
    """The centred vectors as stored blocks of doubles, in as many tasks as their bytes ask for."""
    size, total = len(sums), np.array(sums, dtype=object)
    at_once = max(1, BLOCK_BYTES // (8 * size))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: list[np.ndarray] = []
        for batch in batches:
            kept.append((deviations(matrix(batch.column(0), size), n, total) / n).astype(np.float64))
            if sum(map(len, kept)) >= at_once:
                yield packed(np.concatenate(kept))
                kept = []
        if kept:
            yield packed(np.concatenate(kept))

    def packed(block: np.ndarray) -> pa.RecordBatch:
        cuts = range(0, len(block), at_once)
        return pa.RecordBatch.from_arrays(
            [pa.array([block[i : i + at_once].tobytes() for i in cuts], pa.binary())], names=["block"]
        )

    cores = rows.sparkSession.sparkContext.defaultParallelism
    whole = 8 * n * size
    tasks = max(-(-whole // LARGEST_TASK_BYTES), min(cores, -(-whole // TASK_BYTES)))
    return stored(rows.select(f"`{vector}`").coalesce(tasks).mapInArrow(run, "block binary"), "centred")


def gathered(
    blocks: DataFrame, shape: tuple[int, ...], partial: Callable[[np.ndarray], np.ndarray], size: int
) -> np.ndarray:
    """The sum of `partial` over all blocks; added up in order, so that runs on equal tasks agree."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(shape)
        for batch in batches:
            for block in batch.column(0):
                total += partial(np.frombuffer(block.as_buffer(), dtype=np.float64).reshape(-1, size))
        yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], names=["part"])

    def summed(found) -> np.ndarray:
        return np.sum([np.frombuffer(part, dtype=np.float64).reshape(shape) for part in found], axis=0)

    parts = blocks.mapInArrow(run, "part binary")
    n_tasks, each = blocks.rdd.getNumPartitions(), 8 * int(np.prod(shape))
    groups = max(1, PARTIAL_BYTES // each)
    if n_tasks > groups:

        def add(key, frame):
            return frame.iloc[:1].assign(part=[summed(frame["part"]).tobytes()])

        slot = F.pmod(F.spark_partition_id(), F.lit(groups))
        parts = parts.withColumn("slot", slot).groupBy("slot").applyInPandas(add, "part binary, slot int")

    found = [row.part for row in parts.select("part").collect()]
    return summed(found) if found else np.zeros(shape)


def minres(
    apply: Callable[[np.ndarray], np.ndarray], against: np.ndarray, shifts: np.ndarray, residuals: np.ndarray, steps: int
) -> np.ndarray:
    """MINRES for (I - QQ')(V - shift)(I - QQ') t = -r, all columns side by side."""

    def project(block: np.ndarray) -> np.ndarray:
        return block - against @ (against.T @ block)

    right = project(-residuals)
    norm = np.linalg.norm(right, axis=0)
    k = len(norm)
    out, older = np.zeros_like(right), np.zeros_like(right)
    newest = right / np.where(norm > 0, norm, 1)
    direction, direction_before = np.zeros_like(right), np.zeros_like(right)
    left, first = norm.copy(), norm.copy()
    cosine, cosine_before, sine, sine_before = np.ones(k), np.ones(k), np.zeros(k), np.zeros(k)
    beta = np.zeros(k)
    for _ in range(steps):
        y = project(apply(newest) - newest * shifts) - older * beta
        alpha = (newest * y).sum(axis=0)
        y -= newest * alpha
        beta_next = np.linalg.norm(y, axis=0)
        mixed = cosine * alpha - cosine_before * sine * beta
        length = np.hypot(mixed, beta_next)
        solvable = length > 0
        safe = np.where(solvable, length, 1)
        second = sine * alpha + cosine_before * cosine * beta
        turned = (newest - direction_before * (sine_before * beta) - direction * second) / safe
        cosine_before, cosine = cosine, np.where(solvable, mixed / safe, 1.0)
        sine_before, sine = sine, np.where(solvable, beta_next / safe, 0.0)
        out += np.where(solvable, cosine * left, 0.0) * turned
        left = -sine * left
        older, newest = newest, y / np.where(beta_next > 0, beta_next, 1)
        direction_before, direction = direction, turned
        beta = beta_next
        if (np.abs(left) <= 0.05 * first).all():
            break
    return project(out)


def orthonormal(block: np.ndarray, *against: np.ndarray) -> np.ndarray:
    """An orthonormal basis of what `block` adds to the others; twice is enough."""
    for _ in range(2):
        for other in against:
            block = block - other @ (other.T @ block)
        block = np.linalg.qr(block)[0]
    return block


def jacobi_davidson(
    apply: Callable[[np.ndarray], np.ndarray], size: int, count: int, seed: int = 0
) -> tuple[np.ndarray, np.ndarray, float]:
    """The `count` largest eigenvalues of a symmetric operator, their vectors, the largest residual.

    Residuals are relative to the largest eigenvalue. If they stop falling above 1e-12, this raises.
    """
    rng = np.random.default_rng(seed)
    count = min(count, size)
    tolerance = max(64, 4 * np.sqrt(size)) * EPS
    width = min(size, count + GUARD)
    basis = np.linalg.qr(rng.standard_normal((size, width)))[0]
    image = apply(basis)
    locked, values, reached = np.zeros((size, 0)), [], 0.0
    best, stalled, scale = np.inf, 0, 0.0
    for _ in range(MAX_ROUNDS):
        small = basis.T @ image
        ritz, turn = np.linalg.eigh((small + small.T) / 2)
        ritz, turn = ritz[::-1], turn[:, ::-1]
        basis, image = basis @ turn, image @ turn
        scale = max([scale, *np.abs(ritz), *values])
        if scale == 0:
            return np.zeros((size, 0)), np.zeros(0), 0.0
        wanted = min(count - len(values), basis.shape[1])
        away = image[:, :wanted] - basis[:, :wanted] * ritz[:wanted]
        away -= locked @ (locked.T @ away)
        gaps = np.linalg.norm(away, axis=0) / scale
        worst = float(gaps.max(initial=0.0))
        stalled = 0 if worst < 0.5 * best else stalled + 1
        best = min(best, worst)
        complete = basis.shape[1] + locked.shape[1] == size
        at_floor = complete or (stalled >= 4 and worst < 1e-12)
        done = wanted if at_floor else int(np.argmax(np.append(gaps > tolerance, True)))
        if done:
            reached = max(reached, float(gaps[:done].max()))
            locked = np.hstack([locked, basis[:, :done]])
            values += ritz[:done].tolist()
            basis, image, ritz = basis[:, done:], image[:, done:], ritz[done:]
            away, gaps, best, stalled = away[:, done:], gaps[done:], np.inf, 0
        if len(values) >= count:
            order = np.argsort(values)[::-1]
            return locked[:, order], np.array(values)[order], reached
        open_ = gaps > tolerance
        room = min(SUBSPACE, size - locked.shape[1])
        keep = min(count + GUARD - len(values), basis.shape[1])
        if basis.shape[1] + open_.sum() > room:
            basis, image = basis[:, :keep], image[:, :keep]
        against = np.hstack([locked, basis[:, :keep]])
        shifts = ritz[: len(gaps)][open_]
        corrections = minres(apply, against, shifts, away[:, open_], STEPS)[:, : room - basis.shape[1]]
        added = orthonormal(corrections, locked, basis)
        basis, image = np.hstack([basis, added]), np.hstack([image, apply(added)])
    raise RuntimeError(f"eigenvectors not found to double precision: residual {best:.1e}")


def fit(rows: DataFrame, vector: str = "embedding", components: int = COMPONENTS) -> Whitening:
    """The leading eigenvectors of the covariance of all usable vectors."""
    sizes = rows.where(usable(vector)).groupBy(F.size(f"`{vector}`").alias("size")).count()
    common = sizes.orderBy(F.desc("count"), F.desc("size")).first()
    size = common["size"] if common else 0
    if not size:
        return Whitening(common["count"] if common else 0, (), np.zeros((0, 0)), np.zeros(0), 0.0, 0.0, 0, 0.0)
    fitting = rows.where(usable(vector, size))
    n, sums = exact_sums(fitting, vector, size)
    blocks = centred_blocks(fitting, vector, n, sums)
    trace = float(gathered(blocks, (1,), lambda c: np.array([(c * c).sum()]), size)[0]) / n
    passes = [0]

    def apply(block: np.ndarray) -> np.ndarray:
        passes[0] += 1
        return gathered(blocks, block.shape, lambda c: c.T @ (c @ block), size) / n

    vectors, values, residual = jacobi_davidson(apply, size, components)
    some = values > max(64, size) * EPS * max(values, default=0.0)
    vectors, values = vectors[:, some], values[some]
    k = len(values)
    weights = vectors / np.sqrt(values)

    def moments(c: np.ndarray) -> np.ndarray:
        z = c @ weights
        return np.vstack([z.T @ z, z.sum(axis=0)[None, :]])

    error = 0.0
    if k:
        found = gathered(blocks, (k + 1, k), moments, size) / n
        error = float(np.abs(found[:k] - np.outer(found[k], found[k]) - np.eye(k)).max())
    return Whitening(n, tuple(sums), vectors, values, trace, residual, passes[0], error)


def apply_whitening(rows: DataFrame, model: Whitening, vector: str = "embedding", keep: bool = True) -> DataFrame:
    """The usable rows with `deviation`, the sum of (n x - S)^2, and `whitened`, a figure per component.

    `keep` false drops the vectors.
    """
    size, n = len(model.sums), model.n
    sums, weights = np.array(model.sums, dtype=object), model.components / np.sqrt(model.eigenvalues)
    base = without(rows, ADDED if keep else [*ADDED, vector])
    source = rows.where(usable(vector, size)).select(
        *(F.col(f"`{c}`") for c in base.columns), F.col(f"`{vector}`").alias(fresh("_vector", base))
    )
    schema = T.StructType(
        [*base.schema.fields, T.StructField("deviation", T.LongType()), T.StructField("whitened", T.ArrayType(T.DoubleType(), False))]
    )
    kinds = [f.type for f in to_arrow_schema(schema)][-2:]
    n_kept = len(base.columns)

    def squares(away: np.ndarray) -> list[int | None]:
        if away.dtype != object and int(np.abs(away).max(initial=0)) ** 2 * max(1, size) < 1 << 63:
            return (away * away).sum(axis=1).tolist()
        exact = [sum(v * v for v in row) for row in away.tolist()]
        return [v if v < 1 << 63 else None for v in exact]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vectors = batch.column(n_kept)
            x = matrix(vectors, size) if size else np.zeros((batch.num_rows, 0), np.int64)
            away = deviations(x, n, sums)
            whitened = (away / n).astype(np.float64) @ weights if size else np.zeros((batch.num_rows, 0))
            yield pa.RecordBatch.from_arrays(
                [
                    *(batch.column(i) for i in range(n_kept)),
                    pa.array(squares(away), kinds[0]),
                    pa.array(whitened.tolist(), kinds[1]),
                ],
                names=[*batch.schema.names[:n_kept], *ADDED],
            )

    return source.mapInArrow(run, schema)


def by_component(whitened: DataFrame, model: Whitening) -> DataFrame:
    """A row per vector and component, with the component's share of the trace."""
    kept = without(whitened, ["component", "n", "explained", "identity_error"])
    shares = F.array(*(F.lit(float(v)) for v in model.explained)).cast("array<double>")
    columns = [F.col(f"`{c}`") for c in kept.columns if c != "whitened"]
    rows = kept.select(*columns, F.posexplode("whitened").alias("component", "whitened"))
    return rows.withColumns(
        {
            "component": (F.col("component") + 1).cast("int"),
            "n": F.lit(model.n).cast("long"),
            "explained": F.get(shares, F.col("component")),
            "identity_error": F.lit(model.identity_error),
        }
    )
