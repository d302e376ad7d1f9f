"""Mixing sources to target weights by iterative proportional fitting, all in DataFrame functions.

Documents are counted into cells of source, language and topic. The cells' token weights are scaled
to the target shares of each dimension in turn until all marginals agree. A document's probability
is the ratio of its cell's raked share to its share in the corpus, scaled so that the largest is 1
(or to a token budget, where it may exceed 1 and stands for the expected number of copies). Whether
it is drawn is decided by a hash of seed, id and text, so that runs agree.

Only cells are shuffled after the first count; documents are read again and joined to the cells,
which are broadcast up to `BROADCAST_BYTES` and otherwise joined with hot cells salted.

Null in a dimension is a value of its own. Null and empty texts have no tokens: they change no
marginal and get the ratio of their cell, or probability 0 if their whole cell has no tokens.
Repeated rows (same id and text) are drawn or left out together. Values without a target, or with
target 0, get probability 0; targets of values that do not occur are shared out among the others.
Input columns named like an output column are replaced. An empty table stays empty.
"""

from __future__ import annotations

import warnings
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plantlens.llm.common import fresh, join_hot, stored, stored_bytes, without

BROADCAST_BYTES = 64 << 20
MAX_ROUNDS = 40
TOLERANCE = 1e-6
WORD = r"[^\x20\x09-\x0D]+"
ADDED = ["topic", "n_tokens", "probability", "n_copies"]

# Topics by the first pattern found; a parameter of the operator.
TOPICS = {
    "licence": r"(?i)licen[sc]e",
    "contact": r"@[A-Za-z0-9-]+\.|\+[0-9]",
    "table": r"\S \| \S+ \| ",
}


def topic_of(text: Column, topics: dict[str, str] = TOPICS) -> Column:
    out = F
    for name, pattern in topics.items():
        out = out.when(text.rlike(pattern), F.lit(name))
    return out.otherwise(F.lit("prose")) if topics else F.lit("prose")


def tokens_of(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def same(left: DataFrame, right: DataFrame, names: list[str]) -> Column:
    return reduce(lambda a, b: a & b, [left[n].eqNullSafe(right[n]) for n in names])


def cell_key(names: list[str]) -> Column:
    """One string for the values of a cell, never the same for two cells: null, or length and value."""

    def part(name: str) -> Column:
        value = F.col(f"`{name}`").cast("string")
        return F.coalesce(F.concat(F.length(value).cast("string"), F.lit(":"), value), F.lit("-"))

    return F.concat(*map(part, names))


def tempered(cells: DataFrame, dimension: str, power: float) -> DataFrame:
    """Target shares in proportion to a power of the tokens of each value: value, share."""
    sums = cells.groupBy(dimension).agg(F.sum("tokens").alias("_sum"))
    raised = sums.select(
        F.col(dimension), F.when(F.col("_sum") > 0, F.col("_sum") ** power).otherwise(0.0).alias("share")
    )
    total = raised.agg(F.sum("share")).first()[0] or 1.0
    return raised.withColumn("share", F.col("share") / F.lit(float(total)))


def rake(cells: DataFrame, targets: dict[str, DataFrame]) -> DataFrame:
    """`cells` with `weight`: shares that sum to 1 and meet the target shares of every dimension.

    `targets` has for each dimension a frame of its values and their `share`. If no weights meet them
    all, as when a value occurs with one other only, those of the last round go out with a warning
    that gives the largest gap that is left.
    """
    aims = {
        name: stored(aim.select(F.col(name), F.col("share").alias("_aim")), f"aim-{name}")
        for name, aim in targets.items()
    }
    total = cells.agg(F.sum("tokens")).first()[0] or 0
    if not total:
        return cells.withColumn("weight", F.lit(0.0))
    now = cells.withColumn("weight", F.col("tokens") / F.lit(float(total)))
    for _ in range(MAX_ROUNDS):
        gaps = []
        for name, aim in aims.items():
            sums = now.groupBy(name).agg(F.sum("weight").alias("_sum"))
            ratio = sums.join(aim, same(sums, aim, [name]), "left").select(
                sums[name],
                F.when(F.col("_sum") > 0, F.coalesce("_aim", F.lit(0.0)) / F.col("_sum"))
                .otherwise(0.0)
                .alias(f"_gap_{name}"),
            )
            now = now.join(ratio, same(now, ratio, [name])).drop(ratio[name])
            now = now.withColumn("weight", F.col("weight") * F.col(f"_gap_{name}"))
            gaps.append(F.max(F.when(F.col("weight") > 0, F.abs(F.col(f"_gap_{name}") - 1))))
        now = stored(now, "raked")
        worst = max((g for g in now.agg(*gaps).first() if g is not None), default=0.0)
        now = now.drop(*(f"_gap_{name}" for name in aims))
        if worst < TOLERANCE:
            break
    else:
        warnings.warn(f"target shares not met after {MAX_ROUNDS} rounds: off by {worst:.2g}", stacklevel=2)
    sums = now.agg(F.sum("weight")).first()[0] or 1.0
    return now.withColumn("weight", F.col("weight") / F.lit(float(sums)))


def mix(
    docs: DataFrame,
    powers: dict[str, float],
    targets: dict[str, DataFrame] | None = None,
    topic: Column | None = None,
    text: str = "text",
    doc_id: str = "doc_id",
    budget: int | None = None,
    seed: int = 0,
) -> DataFrame:
    """`docs` with topic, n_tokens, probability and n_copies (0 if not drawn).

    `powers` names the dimensions with the power of their tempered targets, `targets` gives explicit
    ones. Without `topic` it is told by TOPICS from the text.
    """
    told = F.coalesce(topic if topic is not None else topic_of(F.col(text)), F.lit("prose"))
    name = fresh("_topic", docs)
    marked = without(docs.withColumn(name, told), ADDED).withColumnRenamed(name, "topic")
    marked = marked.withColumn("n_tokens", tokens_of(F.col(text)))
    names = [*{**powers, **(targets or {})}]
    cells = stored(
        marked.groupBy(*names).agg(F.sum("n_tokens").alias("tokens"), F.count("*").alias("n")), "cells"
    )
    aims = {name: tempered(cells, name, power) for name, power in powers.items()}
    ratio = F.when(F.col("tokens") > 0, F.col("weight") / F.col("tokens")).otherwise(0.0)
    raked = stored(rake(cells, {**aims, **(targets or {})}).withColumn("_ratio", ratio), "mix")
    if budget is None:
        scale = 1.0 / (raked.agg(F.max("_ratio")).first()[0] or 1.0)
    else:
        scale = float(budget)
    chances = raked.select(*names, "n", (F.col("_ratio") * F.lit(scale)).alias("probability"))
    if stored_bytes(raked) <= BROADCAST_BYTES:
        right = F.broadcast(chances.drop("n"))
        mixed = marked.join(right, same(marked, right, names))
        for name in names:
            mixed = mixed.drop(right[name])
    else:
        key = fresh("_cell", marked)
        lookup = stored(chances.select(cell_key(names).alias(key), "n", "probability"), "chances")
        keyed = marked.withColumn(key, cell_key(names))
        mixed = join_hot(keyed, lookup, [key], "n", F.col(doc_id), "inner").drop(key)
    whole = F.floor("probability")
    draw = F.shiftrightunsigned(F.xxhash64(F.lit(seed), F.col(doc_id), F.col(text)), 11) / F.lit(2.0**53)
    return mixed.withColumn(
        "n_copies", (whole + (draw < F.col("probability") - whole).cast("int")).cast("long")
    )
