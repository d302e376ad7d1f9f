"""Lists of several rules, executors without the package, hostile values and names."""

import subprocess
import sys
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

from plantlens.llm import decontaminate, html_template, line_dedup, mixing, quality_rules, simhash
from plantlens.llm.quality_rules import Rule
from plantlens.llm.quality_rules import Test as Threshold

DOCS = "doc_id long, text string, lang string, source string"
TESTS = [
    (Threshold("symbol_share", True, 0.05),),
    (Threshold("n_words", False, 80.0), Threshold("upper_share", True, 0.1)),
    (Threshold("n_words", False, 90.0),),
    (Threshold("line_length", True, 3.0), Threshold("digit_share", False, 0.4), Threshold("mark_share", True, 0.01)),
    (Threshold("distinct_share", False, 0.2),),
]


@pytest.mark.parametrize("count", [0, 1, 2, 5])
def test_verdict_of_several_rules(spark, count):
    """Overlapping rules, against the same rules asked one by one in Python."""
    rng = np.random.default_rng(count)
    words = ["word", "WORD", "12345", "a.b!", "#$%", "tiny"]
    rows = []
    for i in range(300):
        own = rng.choice(words[: rng.integers(1, 7)], rng.integers(50, 120))
        rows.append((i, "".join(w + (" " if rng.random() < 0.6 else "\n") for w in own), "en", "a"))
    rules = [Rule(tests, 1.0, 1) for tests in TESTS[:count]]
    judged = quality_rules.judge(spark.createDataFrame(rows, DOCS), rules)
    features = {name: F.expr(e).cast("double") for name, e in quality_rules.FEATURES.items()}
    table = judged.select("base_failed", "kept", *(f.alias(n) for n, f in features.items())).toPandas()
    x = {name: table[name].to_numpy() for name in features}
    rejected = np.zeros(len(rows), dtype=bool)
    for rule in rules:
        rejected |= rule.holds(x)
    assert (table["kept"] == ~(table["base_failed"] | rejected)).all()
    if count:
        assert rejected.any()
    if count == 1:
        assert not rejected.all()


def test_labels_that_need_several_rules(spark):
    """Two kinds of bad documents: learned as rules of their own, and both rejected."""
    rows, labels = [], []
    for i in range(900):
        kind = i % 3
        words = [f"word{(i * 31 + k * 7) % 997}" for k in range(100)]
        if kind == 1:
            words = [w + "#%$" for w in words]
        if kind == 2:
            words = [w.upper() for w in words]
        rows.append((i, " ".join(words), "en", "a"))
        labels.append((i, int(kind == 0)))
    docs = spark.createDataFrame(rows, DOCS)
    rules = quality_rules.learn(docs, spark.createDataFrame(labels, "doc_id long, quality int"))
    assert len(rules) >= 2
    kept = {r.doc_id for r in quality_rules.judge(docs, rules).where("kept").collect()}
    assert kept == {i for i in range(900) if i % 3 == 0}


SCRIPT = """
import sys
sys.path.insert(0, {repo!r})
import __spark_entry__ as entry
from plantlens.session import build_session
spark = build_session("bare", "local[2]", spark_sql_shuffle_partitions="2",
                      spark_ui_showConsoleProgress="false", spark_checkpoint_dir={shared!r})
def importable(rows):
    import importlib.util
    return [importlib.util.find_spec("plantlens") is not None]
assert not any(spark.sparkContext.parallelize(range(2), 2).mapPartitions(importable).collect())
for name in {names!r}:
    print(name, entry.queries()[name](spark, {sf_dir!r}).count())
"""


def test_executors_without_the_package(tmp_path, sf_dir):
    names = [f"op{i}_" for i in (1, 4, 6, 7, 11, 12, 13)]
    import __spark_entry__ as entry

    chosen = [n for n in entry.queries() if n.startswith(tuple(names))]
    script = SCRIPT.format(
        repo=str(Path(__file__).resolve().parents[2]), shared=str(tmp_path / "shared"), names=chosen, sf_dir=sf_dir
    )
    ran = subprocess.run(
        [sys.executable, "-c", script], cwd=tmp_path, capture_output=True, text=True, timeout=900,
        env={k: v for k, v in __import__("os").environ.items() if k != "PYTHONPATH"},
    )
    assert ran.returncode == 0, ran.stderr[-3000:]
    assert len(ran.stdout.splitlines()) == len(chosen)


HOSTILE = [
    (1, "a b c", "x, y", "z"), (2, "a b", "x", "y, z"), (3, "a", None, "null"), (4, "a b c d", "null", None),
    (5, "a", "", "1:x"), (6, "a b", "1:x", ""), (7, "b", "-", None), (8, "b c", None, "-"),
]


def test_cells_of_hostile_values(spark, monkeypatch):
    docs = spark.createDataFrame(HOSTILE, DOCS)
    powers = {"lang": 0.5, "source": 0.5}
    usual = [tuple(r) for r in mixing.mix(docs, powers).select("doc_id", "probability").collect()]
    monkeypatch.setattr(mixing, "BROADCAST_BYTES", -1)
    joined = [tuple(r) for r in mixing.mix(docs, powers).select("doc_id", "probability").collect()]
    assert len(joined) == len(HOSTILE) and dict(joined) == pytest.approx(dict(usual))


def test_targets_that_cannot_be_met(spark):
    docs = spark.createDataFrame([(1, "a", "en", "a"), (2, "b b b", "de", "b")], DOCS)
    langs = spark.createDataFrame([("en", 0.9), ("de", 0.1)], "lang string, share double")
    sources = spark.createDataFrame([("a", 0.1), ("b", 0.9)], "source string, share double")
    with pytest.warns(UserWarning, match="not met"):
        assert mixing.mix(docs, {}, {"lang": langs, "source": sources}).count() == 2


def test_bytes_that_are_not_text(spark):
    row = "1L AS doc_id, cast(X'6f6e65ff0a74776f206f6e65' AS string) AS text"
    docs = spark.sql(f"SELECT {row}")
    for bound in (line_dedup.BROADCAST_BYTES, -1):
        kept = line_dedup.clean(docs, line_dedup.start(docs, min_docs=2), max_broadcast=bound).first()
        assert kept.text == "one�\ntwo one" and kept.n_lines == 2
    items = spark.createDataFrame([("i", "two one")], "item_id string, text string")
    found = decontaminate.find_passages(docs, items).first()
    assert found.item_ids == ["i"] and found.n_hit == 2
    assert [tuple(s) for s in found.removal_spans] == [(5, 12)]


def test_helper_names_of_the_operators_may_be_taken(spark, monkeypatch):
    extra = {n: F.lit(i).alias(n) for i, n in enumerate(
        ["_topic", "_cell", "_salt", "_salts", "_row", "_gone", "_bytes", "_host", "_main", "_fixed", "_html", "_pages", "_sum"])}
    docs = spark.createDataFrame([(i, f"some text {i % 2}", "en", "a") for i in range(6)], DOCS).select("*", *extra.values())

    def untouched(out):
        row = out.first()
        assert out.count() == 6 and [row[n] for n in extra] == list(range(len(extra)))

    state = line_dedup.start(docs, min_docs=2)
    untouched(line_dedup.clean(docs, state))
    untouched(line_dedup.clean(docs, state, max_broadcast=-1))
    untouched(simhash.near_duplicates(docs))
    untouched(mixing.mix(docs, {"lang": 0.5}))
    pages = docs.withColumnRenamed("text", "html").withColumn("url", F.lit("http://h/x"))
    untouched(html_template.extract(pages))
    monkeypatch.setattr(mixing, "BROADCAST_BYTES", -1)
    monkeypatch.setattr(html_template, "BROADCAST_BYTES", -1)
    untouched(mixing.mix(docs, {"lang": 0.5}))
    untouched(html_template.extract(pages))
