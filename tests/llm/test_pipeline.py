"""The pipeline's stages, each against a plain version on its own input."""

from pathlib import Path

import corpus_pipeline
import pytest
from test_llm_queries import plain_fingerprint, plain_statistics

from plantlens.llm import decontaminate, quality_rules
from plantlens.llm.common import stored, table


@pytest.fixture(scope="module")
def steps(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    frames = [docs]
    for name, stage in corpus_pipeline.STAGES:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
        frames.append(docs)
    return [{r.doc_id: r for r in frame.collect()} for frame in frames], frames


def test_order_and_columns(steps):
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "quality rules",
        "line dedup",
        "near dedup",
        "decontamination",
        "mixing",
    ]
    for frame in steps[1][:-1]:
        assert frame.columns == corpus_pipeline.COLUMNS


def test_quality_stage(spark, sf_dir, steps):
    before, after = steps[0][0], steps[0][1]
    rules = quality_rules.learn(steps[1][0], table(spark, sf_dir, "labels"))
    judged = quality_rules.judge(steps[1][0], rules).collect()
    assert set(after) == {r.doc_id for r in judged if r.kept}
    for doc, row in before.items():
        words, *_, repeated = plain_statistics(row.text or "")
        if words < 50 or 100 * repeated > 50 * words:
            assert doc not in after


def test_line_stage(steps):
    before, after = steps[0][1], steps[0][2]
    counts = {}
    blank = " \t\n\r\x0b\x0c"

    def key(line):
        return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in line.strip(blank))

    for row in before.values():
        for k in {key(line) for line in row.text.split("\n")}:
            counts[k] = counts.get(k, 0) + 1
    assert before.keys() == after.keys()
    for doc, row in before.items():
        kept = [x for x in row.text.split("\n") if not key(x) or counts[key(x)] < 10]
        assert after[doc].text == "\n".join(kept)
        assert after[doc].n_chars == len(after[doc].text)


def test_near_stage(steps):
    before, after = steps[0][2], steps[0][3]
    ids = sorted(before)
    marks = {i: plain_fingerprint(before[i].text) for i in ids}
    group = {i: i for i in ids}

    def root(i):
        while group[i] != i:
            i = group[i]
        return i

    for n, i in enumerate(ids):
        for j in ids[n + 1 :]:
            if (marks[i] ^ marks[j]).bit_count() <= 3:
                a, b = sorted((root(i), root(j)))
                group[b] = a
    assert set(after) == {i for i in ids if group[i] == i}


def test_decontamination_stage(spark, sf_dir, steps):
    before, after = steps[0][3], steps[0][4]
    windows = set()
    for row in table(spark, sf_dir, "benchmark").collect():
        words = decontaminate.words_of(row.text.encode())
        size = min(13, len(words))
        windows |= {tuple(words[i : i + size]) for i in range(len(words) - size + 1)}
    for doc, row in before.items():
        words, hit = decontaminate.words_of(row.text.encode()), set()
        for i in range(len(words) - 12):
            if tuple(words[i : i + 13]) in windows:
                hit |= set(range(i, i + 13))
        assert (doc in after) == (not hit or 20 * len(hit) < len(words))


def test_mixing_stage_draws_from_its_input(steps):
    before, after = steps[0][4], steps[0][5]
    assert after and after.keys() <= before.keys()
    assert all(row.n_copies == 1 and before[doc].text == row.text for doc, row in after.items())


def test_run_gives_the_last_stage(spark, sf_dir, steps):
    rows = corpus_pipeline.run(spark, sf_dir).collect()
    assert sorted(r.doc_id for r in rows) == sorted(steps[0][-1])


def test_a_run_leaves_only_documents_of_stages(spark, sf_dir, steps):
    """Work of the stages is removed when their documents are written; the result stays readable."""
    base = Path(spark.conf.get("spark.checkpoint.dir"))
    before = set(base.iterdir())
    result = corpus_pipeline.run(spark, sf_dir)
    left = {path.name.rsplit("-", 1)[0] for path in set(base.iterdir()) - before}
    assert {"quality-rules", "line-dedup", "near-dedup", "decontamination"} <= left
    assert not any(name.startswith("work-") for name in left)
    assert {r.doc_id for r in result.collect()} <= set(steps[0][-2])
