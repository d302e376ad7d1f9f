"""Quality rules: a decision list learned by sequential covering, applied as Spark expressions.

`text_statistics` measures whole texts in one pass without a shuffle. `learn` takes the statistics
of at most `SAMPLE_ROWS` labelled documents (chosen by a hash of the id, so that the bound holds at
any size) and covers the bad ones rule by rule: a conjunction of threshold tests is grown by
information gain on two thirds of the rows, its last tests are pruned on the other third, and it is
kept if it is precise there. The rules become one ordered conditional expression; a document that
none rejects is kept. Rules are readable, see `describe`.

Words are `[^\\x20\\x09-\\x0D]+`. Null and empty texts have no words and one line. Rows with a null
label, or without a document, teach nothing; ids labelled twice count as good if one label says
so. Without bad labels the list is empty. Input columns named like an output column are replaced.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plantlens.llm.common import map_texts, without

SAMPLE_ROWS = 20_000
MAX_RULES = 16
MAX_TESTS = 4
CUTS = 48
MIN_COVERED = 8
MIN_PRECISION = 0.97

STATISTICS = (
    "n_words word_chars n_symbols n_dup_lines n_repeat_words n_text_lines n_distinct_words "
    "n_upper n_digits n_marks"
).split()

# Shares of a document, as expressions over its statistics.
FEATURES = {
    "n_words": "n_words",
    "word_length": "word_chars / greatest(n_words, 1)",
    "symbol_share": "n_symbols / greatest(word_chars, 1)",
    "dup_line_share": "n_dup_lines / n_text_lines",
    "repeat_share": "n_repeat_words / greatest(n_words, 1)",
    "line_length": "n_words / n_text_lines",
    "distinct_share": "n_distinct_words / greatest(n_words, 1)",
    "upper_share": "n_upper / greatest(word_chars, 1)",
    "digit_share": "n_digits / greatest(word_chars, 1)",
    "mark_share": "n_marks / greatest(word_chars, 1)",
}

BLANK = b" \t\n\r\x0b\x0c"
INSIDE = bytes(range(0x80, 0xC0))
SYMBOLS = b"#*$%&|<>"
UPPER = bytes(range(65, 91))
DIGITS = bytes(range(48, 58))
MARKS = b"!?;:,."


def count_of(text: bytes, characters: bytes) -> int:
    return len(text) - len(text.translate(None, characters))


def repeated_words(words: list[bytes], size: int = 3) -> int:
    """Words inside a window of `size` words that occurs twice or more."""
    n = len(words) - size + 1
    if n < 2:
        return 0
    numbers: dict[bytes, int] = {}
    ids = np.array([numbers.setdefault(w, len(numbers)) for w in words], dtype=np.int64)
    windows = ids[:n]
    for i in range(1, size):
        pairs = windows * len(numbers) + ids[i : n + i]
        windows = np.unique(pairs, return_inverse=True)[1].astype(np.int64)
    again = np.bincount(windows)[windows] > 1
    edges = np.zeros(len(words) + 1, dtype=np.int64)
    edges[:n] += again
    edges[size:] -= again
    return int((np.cumsum(edges) > 0).sum())


def statistics(text: bytes) -> tuple[int, ...]:
    """In the order of STATISTICS."""
    words = text.split()
    seen: set[bytes] = set()
    dup_lines = 0
    lines = text.split(b"\n")
    for line in lines:
        if line in seen:
            dup_lines += bool(line.strip(BLANK))
        else:
            seen.add(line)
    return (
        len(words),
        len(text.translate(None, BLANK + INSIDE)),
        count_of(text, SYMBOLS),
        dup_lines,
        repeated_words(words),
        len(lines),
        len(set(words)),
        count_of(text, UPPER),
        count_of(text, DIGITS),
        count_of(text, MARKS),
    )


def text_statistics(docs: DataFrame, text: str = "text", keep: bool = True) -> DataFrame:
    """`docs` with the columns STATISTICS (long)."""

    def compute(texts: list[bytes]) -> list:
        return [list(column) for column in zip(*map(statistics, texts), strict=True)]

    return map_texts(docs, text, [T.StructField(s, T.LongType()) for s in STATISTICS], compute, keep)


def base_failed() -> Column:
    """Under 50 words, or over half of the words in repeated windows."""
    return (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


@dataclass(frozen=True)
class Test:
    feature: str
    above: bool
    threshold: float

    def holds(self, x: dict[str, np.ndarray]) -> np.ndarray:
        return x[self.feature] > self.threshold if self.above else x[self.feature] <= self.threshold

    def expression(self) -> Column:
        value = F.expr(FEATURES[self.feature])
        return value > F.lit(self.threshold) if self.above else value <= F.lit(self.threshold)


@dataclass(frozen=True)
class Rule:
    tests: tuple[Test, ...]
    precision: float
    covered: int

    def holds(self, x: dict[str, np.ndarray]) -> np.ndarray:
        out = np.ones(len(next(iter(x.values()))), dtype=bool)
        for test in self.tests:
            out &= test.holds(x)
        return out

    def expression(self) -> Column:
        out = self.tests[0].expression()
        for test in self.tests[1:]:
            out = out & test.expression()
        return out


def verdict(rules: list[Rule]) -> Column:
    """True where no rule rejects; the rules are asked in order."""
    out = None
    for rule in rules:
        out = (F if out is None else out).when(rule.expression(), F.lit(False))
    return F.lit(True) if out is None else out.otherwise(F.lit(True))


def describe(rules: list[Rule]) -> list[str]:
    return [
        "reject if "
        + " and ".join(f"{t.feature} {'>' if t.above else '<='} {t.threshold:.6g}" for t in r.tests)
        + f" (precision {r.precision:.3f}, covers {r.covered})"
        for r in rules
    ]


def labelled_statistics(
    stats: DataFrame, labels: DataFrame, doc_id: str, label: str, rows: int
) -> DataFrame:
    """Features and label of at most about `rows` labelled documents, the same ones each time."""
    good = labels.where(F.col(label).isin(0, 1)).groupBy(doc_id).agg(F.max(label).alias("_good"))
    share = min(1.0, rows / max(1, good.count()))
    chosen = good.where(F.pmod(F.xxhash64(doc_id), F.lit(1 << 20)) < int(share * (1 << 20)))
    return without(stats, ["_good"]).join(F.broadcast(chosen), doc_id)


def learn(
    docs: DataFrame,
    labels: DataFrame,
    doc_id: str = "doc_id",
    label: str = "quality",
    text: str = "text",
    rows: int = SAMPLE_ROWS,
) -> list[Rule]:
    """The decision list for documents that pass the base rules."""
    known = labelled_statistics(docs.select(doc_id, text), labels, doc_id, label, rows)
    measured = text_statistics(known, text, keep=False).where(~base_failed())
    table = measured.select(
        F.col("_good").cast("double"),
        (F.pmod(F.xxhash64(doc_id, F.lit(7)), F.lit(3)) == 0).cast("double").alias("_prune"),
        *(F.expr(expression).cast("double").alias(name) for name, expression in FEATURES.items()),
    ).toPandas()
    x = {name: table[name].to_numpy() for name in FEATURES}
    return cover(x, table["_good"].to_numpy() == 0, table["_prune"].to_numpy() == 1)


def cover(x: dict[str, np.ndarray], bad: np.ndarray, prune: np.ndarray) -> list[Rule]:
    """Sequential covering of the rows marked `bad`."""
    rules: list[Rule] = []
    left = np.ones(len(bad), dtype=bool)
    while len(rules) < MAX_RULES and (bad & left).any():
        tests = grow(x, bad, left & ~prune)
        best, score = (), -1.0
        for length in range(1, len(tests) + 1):
            rule = Rule(tests[:length], 0.0, 0)
            hit = rule.holds(x) & left & prune
            p, n = int((hit & bad).sum()), int((hit & ~bad).sum())
            if p + n and (p - n) / (p + n) > score:
                best, score = tests[:length], (p - n) / (p + n)
        hit = Rule(best, 0.0, 0).holds(x) & left
        covered, right = int(hit.sum()), int((hit & bad).sum())
        precise = covered >= MIN_COVERED and right >= MIN_PRECISION * covered
        if not best or not precise or score < 2 * MIN_PRECISION - 1:
            break
        rules.append(Rule(best, right / covered, covered))
        left &= ~hit
    return rules


def grow(x: dict[str, np.ndarray], bad: np.ndarray, rows: np.ndarray) -> tuple[Test, ...]:
    """Add the test with the largest information gain until only bad rows are covered."""
    tests: tuple[Test, ...] = ()
    while len(tests) < MAX_TESTS and (rows & ~bad).any() and (rows & bad).any():
        p0, n0 = int((rows & bad).sum()), int((rows & ~bad).sum())
        best, gain = None, 1e-9
        for name, values in x.items():
            cuts = np.union1d(
                np.quantile(values[rows], np.linspace(0, 1, CUTS + 2)[1:-1]),
                np.quantile(values[rows & bad], [0.01, 0.02, 0.05, 0.95, 0.98, 0.99]),
            )
            above = values[rows][:, None] > cuts
            for side, inside in ((True, above), (False, ~above)):
                p = inside[bad[rows]].sum(axis=0)
                n = inside[~bad[rows]].sum(axis=0)
                with np.errstate(divide="ignore", invalid="ignore"):
                    gains = p * (np.log2(p / (p + n)) - np.log2(p0 / (p0 + n0)))
                gains = np.nan_to_num(gains, nan=-1.0, neginf=-1.0)
                i = int(np.argmax(gains))
                if gains[i] > gain:
                    best, gain = Test(name, side, float(cuts[i])), float(gains[i])
        if best is None:
            break
        tests += (centred(best, x, bad, rows),)
        rows = rows & best.holds(x)
    return tests


def centred(test: Test, x: dict[str, np.ndarray], bad: np.ndarray, rows: np.ndarray) -> Test:
    """The same test with its threshold midway between the bad rows inside and the good outside."""
    values, inside = x[test.feature], test.holds(x)
    caught, spared = values[rows & bad & inside], values[rows & ~bad & ~inside]
    if not len(caught) or not len(spared):
        return test
    near = caught.min() if test.above else caught.max()
    far = spared.max() if test.above else spared.min()
    middle = (near + far) / 2
    return Test(test.feature, test.above, float(middle)) if near != far else test


def judge(
    docs: DataFrame, rules: list[Rule], text: str = "text", keep: bool = True
) -> DataFrame:
    """`docs` with its statistics, `base_failed` and `kept`."""
    measured = text_statistics(without(docs, ["base_failed", "kept"]), text, keep)
    judged = measured.withColumn("base_failed", base_failed())
    return judged.withColumn("kept", ~F.col("base_failed") & verdict(rules))
