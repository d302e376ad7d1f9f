"""Nulls, empty and long texts, ties, repeated rows, empty tables, clashing columns; small cases."""

import io
import random
import zipfile
from dataclasses import replace

import numpy as np
import pytest
from pyspark.sql import functions as F

from plantlens.llm import (
    decontaminate,
    html_template,
    line_dedup,
    mixing,
    preference,
    quality_rules,
    sanitise,
    simhash,
    toxicity,
    warc_zip,
)
from plantlens.llm.common import join_hot, stored

DOCS = "doc_id long, text string, lang string, source string"
LONG = "lorem Ipsum dolor " * 40_000
ODD = [
    (1, None, "en", "a"),
    (2, "", None, None),
    (3, "One line\nOne line\n\n  ONE LINE \t", "en", "a"),
    (3, "One line\nOne line\n\n  ONE LINE \t", "en", "a"),
    (None, "no id äöü   x", "de", "b"),
    (4, LONG, "en", "a"),
    (5, "a" * 200_000, "en", "b"),
    (6, "1" * 200_000, "en", "b"),
]


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame(ODD, DOCS)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], DOCS)


def with_clash(frame, *names):
    return frame.select("*", *(F.lit("old").alias(name) for name in names))


# Line dedup


def test_lines_of_odd_texts(odd):
    state = line_dedup.start(odd, min_docs=2)
    rows = line_dedup.clean(with_clash(odd, "n_lines", "N_dropped"), state).collect()
    assert len(rows) == len(ODD)
    found = {(r.doc_id, r.n_lines, r.n_dropped, r.text) for r in rows}
    assert (1, 1, 0, "") in found and (2, 1, 0, "") in found
    assert (3, 4, 3, "") in found
    assert (4, 1, 0, LONG) in found
    assert {c.lower() for c in rows[0].asDict()} == {
        "doc_id", "text", "lang", "source", "n_lines", "n_dropped",
    }


def test_lines_of_no_documents(none):
    assert line_dedup.clean(none, line_dedup.start(none)).count() == 0


def counts_of(state):
    return {(r.h1, r.h2): r.n for r in state.counts.collect()}


def test_adding_and_removing_documents_is_reversible(spark):
    rng = random.Random(5)

    def batch(first, n):
        rows = [(i, "\n".join(f"line {rng.randrange(12)}" for _ in range(6)), "en", "a") for i in range(first, first + n)]
        return spark.createDataFrame(rows, DOCS)

    one, two, three = batch(0, 30), batch(100, 30), batch(200, 25)
    first = line_dedup.start(one, min_docs=14)
    grown = line_dedup.add_documents(line_dedup.add_documents(first, two), three)
    back = line_dedup.remove_documents(line_dedup.remove_documents(grown, two), three)
    assert counts_of(back) == counts_of(first)
    whole = line_dedup.start(one.union(two).union(three), min_docs=14)
    assert counts_of(grown) == counts_of(whole)
    for state, docs in ((back, one), (grown, two)):
        anew = first if state is back else whole
        got = line_dedup.clean(docs, state).select("doc_id", "text", "n_dropped").collect()
        assert sorted(got) == sorted(line_dedup.clean(docs, anew).select("doc_id", "text", "n_dropped").collect())


def test_lines_beyond_the_broadcast_bound(odd):
    state = line_dedup.start(odd, min_docs=2)
    usual = line_dedup.clean(odd, state).select("doc_id", "text", "n_lines", "n_dropped")
    joined = line_dedup.clean(odd, state, max_broadcast=-1).select(*usual.columns)
    assert sorted(joined.collect(), key=str) == sorted(usual.collect(), key=str)


def test_cuckoo_filter():
    rng = np.random.default_rng(3)
    keys = rng.integers(-(1 << 62), 1 << 62, size=(4000, 2))
    made = line_dedup.CuckooFilter.empty(3000)
    assert made.insert(keys[:3000, 1])
    probe = line_dedup.ShardedFilters({0: made.slots.tobytes()}, 1)
    assert probe.contains(keys[:3000]).all() and probe.contains(keys[3000:]).sum() <= 1
    made.delete(keys[:1500, 1])
    probe = line_dedup.ShardedFilters({0: made.slots.tobytes()}, 1)
    assert probe.contains(keys[1500:3000]).all() and probe.contains(keys[:1500]).sum() <= 1


def test_rare_lines_that_a_filter_mistakes_are_kept(spark):
    """Filters that hold lines of five documents and more, under a threshold of ten."""
    rows = [(i, f"common {i % 20}\nrare {i % 90}\nalso rare {i}", "en", "a") for i in range(600)]
    docs = spark.createDataFrame(rows, DOCS)
    state = replace(line_dedup.start(docs, min_docs=5), min_docs=10)
    expected = sorted((i, f"rare {i % 90}\nalso rare {i}", 1) for i in range(600))
    cleaned = line_dedup.clean(docs, state).collect()
    assert sorted((r.doc_id, r.text, r.n_dropped) for r in cleaned) == expected


@pytest.mark.parametrize("how", ["inner", "left"])
def test_join_with_a_hot_key(spark, how):
    rows = spark.range(6000).selectExpr("id", "if(id % 3 = 0, id, if(id % 3 = 1, 0, null)) AS k")
    lookup = stored(rows.where("k % 2 = 0").groupBy("k").agg(F.count("*").alias("n")), "lookup")
    lookup = stored(lookup.withColumn("v", F.col("k") * 2), "lookup")
    joined = join_hot(rows, lookup, ["k"], "n", F.col("id"), how)
    plain = rows.join(lookup.drop("n"), "k", how).select(*joined.columns)
    assert sorted(joined.collect(), key=str) == sorted(plain.collect(), key=str)


# WARC


PAGES = "page_id long, url string, html string, extra string"


def test_records_of_odd_pages(spark):
    rows = [
        (1, "http://a/\r\nx", "same", "e"),
        (2, None, "same", "e"),
        (3, "", None, "e"),
        (4, "u: v", "", "e"),
        (None, "n", "same", "e"),
        (2, "again", "same", "e"),
        (5, "long", "ü" * 300_000, "e"),
    ]
    manifest = warc_zip.write_archives(spark.createDataFrame(rows, PAGES))
    read = warc_zip.read_archives(manifest).collect()
    found = {(r.page_id, r.url): (r.record_type, r.refers_to, r.payload_bytes) for r in read}
    assert found == {
        (1, "http://a/%0D%0Ax"): ("revisit", 2, 4),
        (2, None): ("response", None, 4),
        (2, "again"): ("response", None, 4),
        (3, ""): ("revisit", 4, 0),
        (4, "u: v"): ("response", None, 0),
        (None, "n"): ("response", None, 4),
        (5, "long"): ("response", None, 600_000),
    }
    assert {bytes(r.payload) for r in read if r.page_id == 5} == {("ü" * 300_000).encode()}
    assert all(r.payload is None for r in read if r.record_type == "revisit")


def test_no_pages(spark):
    manifest = warc_zip.write_archives(spark.createDataFrame([], PAGES))
    assert warc_zip.read_archives(manifest).count() == 0


@pytest.mark.parametrize("limit", [zipfile.ZIP64_LIMIT, 50])
def test_directory_with_and_without_zip64(monkeypatch, limit):
    monkeypatch.setattr(zipfile, "ZIP64_LIMIT", limit)
    buffer = io.BytesIO()
    with zipfile.ZipFile(buffer, "w", zipfile.ZIP_STORED) as package:
        for i in range(6):
            package.writestr(f"member-{i}", bytes([65 + i]) * (40 + 30 * i))
        package.writestr("packed", b"x" * 500, compress_type=zipfile.ZIP_DEFLATED)
        package.comment = b"PK\x05\x06 in the comment"
    raw = buffer.getvalue()
    assert (b"PK\x06\x06" in raw) == (limit == 50)
    directory = warc_zip.ZipDirectory(len(raw), lambda at, n: raw[at : at + n])
    for i in range(6):
        at, n = directory.place(f"member-{i}")
        assert raw[at : at + n] == bytes([65 + i]) * (40 + 30 * i)
    with pytest.raises(ValueError, match="compressed"):
        directory.place("packed")
    with pytest.raises(ValueError, match="not a ZIP"):
        warc_zip.ZipDirectory(30, lambda at, n: b"x" * n)


def test_a_damaged_payload_is_refused():
    record = warc_zip.make_record(7, "u", b"payload", None, "1970-01-01T00:00:00Z")
    assert warc_zip.parse_record(record)["payload"] == b"payload"
    with pytest.raises(ValueError, match="digest"):
        warc_zip.parse_record(record.replace(b"\r\npayload", b"\r\npayloaD"))


# Toxicity


LABELS = "doc_id long, toxic int, quality int"


def test_toxicity_of_odd_texts(spark, odd, none):
    rows = [(i, ("you idiot " if i % 2 else "kind words ") * 3 + f"w{i % 7}", "en", "a") for i in range(200)]
    docs = spark.createDataFrame(rows, DOCS)
    labels = spark.createDataFrame(
        [(i, i % 2, 1) for i in range(200)] + [(1, 0, 1), (2, None, None), (None, 1, 1), (999, 1, 1)], LABELS
    )
    model = toxicity.train(docs, labels)
    scored = toxicity.score(docs, model).collect()
    assert all(r.predicted == r.doc_id % 2 for r in scored)
    strange = toxicity.score(with_clash(odd, "score", "predicted"), model).collect()
    assert len(strange) == len(ODD) and all(0 <= r.score <= 1 for r in strange)
    assert len({r.score for r in strange if not r.text}) == 1
    assert toxicity.score(none, model).count() == 0
    untaught = toxicity.train(docs, spark.createDataFrame([], LABELS))
    assert {r.score for r in toxicity.score(docs, untaught).collect()} == {0.5}


# SimHash


def test_near_duplicates_of_odd_texts(odd, none):
    rows = simhash.near_duplicates(with_clash(odd, "simhash", "component_id")).collect()
    by_text = {}
    for r in rows:
        by_text.setdefault((r.text or "")[:20], set()).add((r.simhash, r.component_id))
    assert len(rows) == len(ODD) and by_text[""] == {(0, 1)}
    assert all(len(answers) == 1 for answers in by_text.values())
    assert by_text["no id äöü   x"] == {(simhash.fingerprint("no id äöü   x".encode()), None)}
    assert simhash.near_duplicates(none).count() == 0


@pytest.mark.parametrize("seed", range(3))
def test_links_join_all_near_fingerprints(spark, seed):
    rng = random.Random(seed)
    centres = [rng.getrandbits(64) for _ in range(6)]
    marks = set(centres)
    for centre in centres:
        for _ in range(60):
            mark = centre
            for _ in range(rng.randrange(1, 8)):
                mark ^= 1 << rng.randrange(64)
            marks.add(mark)
    signed = [m - (1 << 64) if m >> 63 else m for m in marks]
    links = simhash.near_links(spark.createDataFrame([(m,) for m in signed], "simhash long"))
    labels = {r.node: r.label for r in simhash.components(links).collect()}
    group = {m: m for m in signed}

    def root(m):
        while group[m] != m:
            m = group[m]
        return m

    for a in signed:
        for b in signed:
            if ((a ^ b) & ((1 << 64) - 1)).bit_count() <= 3:
                low, high = sorted((root(a), root(b)))
                group[high] = low
    expected = {m: root(m) for m in signed}
    assert {m: labels.get(m, m) for m in signed} == expected


def test_a_long_chain_is_one_component(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(300)], "a long, b long")
    assert {r.label for r in simhash.components(links).collect()} == {0}


# Personal data


def test_spans_of_odd_texts(odd, none):
    rows = sanitise.find_spans(with_clash(odd, "email_spans", "term_spans")).collect()
    assert len(rows) == len(ODD)
    assert all(not r[f"{k}_spans"] for r in rows for k in (*sanitise.KINDS, "term"))
    assert sanitise.find_spans(none).count() == 0


@pytest.mark.parametrize(
    "text",
    [
        "x@y.z_w@q.r a.b@c.d.e, é@ü.de",
        "1.2.3.4.5.6.7.8 300.1.1.1 0000255.01.1.1 1.2.3 9.9.9.256",
        "4111 1111 1111 1111 4111111111111111111111 4111-1111-1111-1112",
        "+1 (212) 555-0199 +12 34 +1 2 3 4 5 6 7 8 9 0 1 2 3 4 5 6 +49.30.1234567.",
        "\U0001f600 mail \U0001f600a@b.cc İ 10.0.0.1",
    ],
)
def test_spans_equal_those_of_plain_patterns(spark, text):
    from test_llm_queries import plain_spans

    frame = spark.createDataFrame([(1, text, "en", "a")], DOCS)
    found = sanitise.base_spans(frame).select(sanitise.span_list(list(sanitise.KINDS))).first()[0]
    assert found == ",".join(plain_spans(text))


def test_terms_that_give_an_entity_away(spark):
    rows = [(i, f"Call Zebedee about ticket {i} at z@corp.org today with Friends", "en", "a") for i in range(6)]
    rows += [(50 + i, f"Some Friends met in town number {i}", "en", "a") for i in range(60)]
    rows += [(200, "Zebedee was here, Zebedees was not", "en", "a")]
    rows += [(300 + i, "Quux writes from q@corp.org", "en", "a") for i in range(40)]
    docs = spark.createDataFrame(rows, DOCS)
    capital = r"(?<![\p{L}\p{M}])\p{Lu}[\p{L}\p{M}]++"
    terms = {r.term: r.n_entities for r in sanitise.disclosing_terms(docs, term=capital).collect()}
    assert terms == {"zebedee": 1, "call": 1}
    found = sanitise.find_spans(docs, term=capital)
    line = found.where("doc_id = 200").select(sanitise.span_list([*sanitise.KINDS, "term"])).first()[0]
    assert line == "term:0:7"
    clean = sanitise.sanitise(found)
    assert clean.where("doc_id = 0").first().text == "[NAME] [NAME] about ticket 0 at [EMAIL] today with Friends"
    removed = sanitise.sanitise(found, tags={"email": "", "term": ""}).where("doc_id = 0").first().text
    assert removed == "  about ticket 0 at  today with Friends"


# Quality rules


def test_statistics_of_odd_texts(spark, odd, none):
    labels = spark.createDataFrame([(1, 1, 0), (None, 0, 0), (3, 0, None), (99, 0, 1)], LABELS)
    rules = quality_rules.learn(odd, labels)
    rows = quality_rules.judge(with_clash(odd, "kept", "n_words"), rules).collect()
    found = {r.doc_id: r for r in rows}
    assert len(rows) == len(ODD) and rules == []
    assert found[1].n_words == found[2].n_words == 0 and found[1].base_failed and not found[1].kept
    assert (found[3].n_words, found[3].n_dup_lines, found[3].n_repeat_words) == (6, 1, 0)
    assert found[4].n_words == found[4].n_repeat_words == 120_000
    assert quality_rules.judge(none, rules).count() == 0
    assert quality_rules.learn(none, labels) == []


def test_rules_separate_what_thresholds_can_separate():
    rng = np.random.default_rng(1)
    n = 3000
    x = {name: rng.random(n) for name in quality_rules.FEATURES}
    bad = (x["symbol_share"] > 0.8) & (x["line_length"] < 0.5) | (x["upper_share"] > 0.9)
    rules = quality_rules.cover(x, bad, rng.random(n) < 1 / 3)
    caught = np.zeros(n, dtype=bool)
    for rule in rules:
        caught |= rule.holds(x)
    assert (caught & ~bad).sum() <= 0.02 * bad.sum() and (caught & bad).sum() >= 0.9 * bad.sum()
    assert all("reject if" in line for line in quality_rules.describe(rules))


# Decontamination


def test_passages_of_odd_texts(spark, odd, none):
    items = "item_id long, text string"
    bench = spark.createDataFrame(
        [(1, "one LINE"), (1, "no id"), (2, None), (None, "line one"), (10, "lorem ipsum dolor " * 8)], items
    )
    rows = decontaminate.find_passages(with_clash(odd, "n_hit", "item_ids"), bench).collect()
    found = {r.doc_id: r for r in rows}
    assert len(rows) == len(ODD)
    assert (found[1].n_words, found[1].n_hit, found[1].item_ids) == (0, 0, [])
    assert (found[3].n_hit, found[3].item_ids) == (6, ["", "1"])
    assert found[4].n_hit == 120_000 and len(found[4].removal_spans) == 1
    assert (found[None].n_hit, found[None].item_ids) == (2, ["1"])
    cut = decontaminate.cut_passages(decontaminate.find_passages(odd, bench)).where("doc_id is null")
    assert cut.first().text == " äöü   x"
    assert decontaminate.find_passages(none, bench).count() == 0
    nothing = decontaminate.find_passages(odd, spark.createDataFrame([], items)).collect()
    assert all(r.n_hit == 0 for r in nothing)


def test_passages_in_blocks(spark, odd):
    bench = spark.createDataFrame([(i, t) for i, t in enumerate(["one line", "line one", "no id", "ipsum dolor"])], "item_id long, text string")
    whole = decontaminate.find_passages(odd, bench)
    blocks = decontaminate.find_passages(odd, bench, block_bytes=8).select(*whole.columns)
    assert sorted(blocks.collect(), key=str) == sorted(whole.collect(), key=str)


@pytest.mark.parametrize("seed", range(4))
def test_index_finds_every_occurrence(seed):
    rng = np.random.default_rng(seed)
    text = rng.integers(1, 4 + seed, size=700)
    index = decontaminate.FMIndex(text)
    lengths = rng.integers(1, 6, size=60)
    phrases = np.zeros((60, 5), dtype=np.int64)
    for row, n in zip(phrases, lengths, strict=True):
        row[:n] = rng.integers(1, 6 + seed, size=n)
    low, high = index.search(phrases, lengths)
    for row, n, a, b in zip(phrases, lengths, low, high, strict=True):
        expected = [i for i in range(len(text) - n + 1) if (text[i : i + n] == row[:n]).all()]
        assert sorted(index.locate(np.arange(a, b)).tolist()) == expected


# Mixing


def test_mixing_of_odd_rows(odd, none):
    rows = mixing.mix(with_clash(odd, "topic", "n_copies"), {"source": 0.5, "lang": 1.0}).collect()
    assert len(rows) == len(ODD)
    assert all(0 <= r.probability <= 1 and r.n_copies in (0, 1) for r in rows)
    assert len({r.n_copies for r in rows if r.doc_id == 3}) == 1
    assert {r.probability for r in rows if r.doc_id == 2} == {0.0}
    assert mixing.mix(none, {"source": 0.5}).count() == 0


def test_mixing_to_given_targets_and_budget(spark):
    rows = [(i, "w " * 10, "en" if i % 3 else "de", "a" if i % 4 else "b") for i in range(1200)]
    docs = spark.createDataFrame(rows, DOCS)
    langs = spark.createDataFrame([("en", 0.25), ("de", 0.75), ("xx", 0.0)], "lang string, share double")
    mixed = mixing.mix(docs, {"source": 1.0}, {"lang": langs}, budget=24_000)
    total = mixed.agg(F.sum(F.col("probability") * 10)).first()[0]
    german = mixed.where("lang = 'de'").agg(F.sum(F.col("probability") * 10)).first()[0]
    source_b = mixed.where("source = 'b'").agg(F.sum(F.col("probability") * 10)).first()[0]
    assert total == pytest.approx(24_000) and german == pytest.approx(18_000)
    assert source_b == pytest.approx(6_000, rel=1e-4)
    assert mixed.agg(F.max("n_copies")).first()[0] >= 4


def test_mixing_beyond_the_broadcast_bound(odd, monkeypatch):
    usual = mixing.mix(odd, {"source": 0.5, "lang": 0.7}).select("doc_id", "probability")
    monkeypatch.setattr(mixing, "BROADCAST_BYTES", -1)
    joined = mixing.mix(odd, {"source": 0.5, "lang": 0.7}).select("doc_id", "probability")
    assert sorted(joined.collect(), key=str) == sorted(usual.collect(), key=str)


# Pages


def text_of(page, main=(), fixed=()):
    return html_template.main_text(page, frozenset(main), frozenset(fixed))


@pytest.mark.parametrize(
    ("page", "text"),
    [
        ("", ""),
        ("plain &amp; text", "plain & text"),
        ("<p>a<b>b</b>c<p>d&nbsp;e&#33;", "abc d e!"),
        ("<nav>m<article>x</article></nav><article>y<script>z</script></article>", "x y"),
        ("<header>h</header><main>m<aside>s</aside><form>f</form>t</main><footer>o", "m t"),
        ("<div class='x cookie-notice'>c</div><div id=ad-1>d</div><div>e</div>", "e"),
        ("<article><h1>T</h1><div class=comments><p>c</p></div><!-- <p>x --><p>y</article>", "T y"),
        ("<article>1 < 2 and <i>3</i> > 2<br>x<p", "1 < 2 and 3 > 2 x"),
        ("<script>var t='</p><article>';</script><p>ok<style>p{}", "ok"),
        ("<ul><li>a<li>b</ul><table><tr><td>c<td>d<tr><td>e</table>", "a b c d e"),
        ("<div class=ad>x<article>y</article>", "y"),
    ],
)
def test_main_text(page, text):
    assert text_of(page) == text


def test_deep_and_long_pages():
    assert text_of("<div>" * 20_000 + "x") == "x"
    assert text_of("<" * 100_000 + " a &amp" * 1000).endswith(" a & a &")
    assert text_of("<p title=\"x>y</p><p>z" + "<a '>" * 20_000) == "y z"
    assert len(text_of("<p>word " * 50_000).split()) == 50_000


def test_template_of_a_host(spark):
    rows = [
        (i, "http://h.org/p", f"<div class=t>Welcome to us</div><div class=b><p>story {i}</p></div>", "e")
        for i in range(6)
    ]
    rows += [(9, "http://other.org/", "<div class=t>Welcome to us</div><p>x</p>", "e")]
    rows += [(10, None, None, "e"), (11, "nonsense", "", "e"), (10, None, None, "e")]
    pages = spark.createDataFrame(rows, PAGES)
    found = html_template.extract(with_clash(pages, "text", "n_chars")).collect()
    texts = {r.page_id: r.text for r in found}
    assert len(found) == len(rows) and texts[3] == "story 3" and texts[10] == texts[11] == ""
    assert texts[9] == "Welcome to us x"
    assert all(r.n_chars == len(r.text) for r in found)
    templates = html_template.deduce_templates(pages)
    assert [r.host for r in templates.collect()] == ["h.org"]
    assert html_template.extract(pages.limit(0)).count() == 0


# Preferences


TURNS = "conv_id long, turn long, role string, text string, extra string"


def test_preferences_of_odd_turns(spark):
    rows = [
        (1, 0, "user", "hi", "e"),
        (1, 1, "assistant", "hello", "e"),
        (2, 0, "user", "what", "e"),
        (2, 1, "assistant", "other", "e"),
        (2, 1, "assistant", "other", "e"),
        (4, None, None, None, "e"),
        (None, 0, "assistant", "x", "e"),
    ]
    spoken = preference.conversations(spark.createDataFrame(rows, TURNS))
    found = {r.conv_id: r for r in preference.format_pairs(preference.swapped_replies(spoken)).collect()}
    one = found[1]
    assert one.n_prompt_turns == 1 and one.prompt == "<|im_start|>user\nhi<|im_end|>\n"
    assert one.chosen == "<|im_start|>assistant\nhello<|im_end|>\n"
    assert one.rejected == "<|im_start|>assistant\nother<|im_end|>\n"
    span = one.chosen_loss[0]
    assert one.chosen[span.start : span.end] == "hello<|im_end|>\n"
    assert found[2].rejected == "<|im_start|>assistant\n<|im_end|>\n"
    assert not found[4].differs and found[4].chosen == "" and found[4].chosen_loss == []
    assert found[None].rejected == "<|im_start|>assistant\n<|im_end|>\n"
    none = preference.conversations(spark.createDataFrame([], TURNS))
    assert preference.format_pairs(preference.swapped_replies(none)).count() == 0


def test_prefix_ends_at_the_first_difference(spark):
    turn = "array<struct<role:string,text:string>>"
    schema = f"pair long, chosen {turn}, rejected {turn}, prompt string"
    u, a, b = ("user", "q"), ("assistant", "a"), ("assistant", "b")
    pairs = spark.createDataFrame(
        [(1, [u, a, u, a], [u, a, u, b], "old"), (2, [u], [u, a], "old"), (3, None, [], "old"), (4, [a], [b], "old")],
        schema,
    )
    rows = {r.pair: r for r in preference.format_pairs(pairs).collect()}
    assert [rows[i].n_prompt_turns for i in (1, 2, 3, 4)] == [3, 1, 0, 0]
    assert [rows[i].differs for i in (1, 2, 3, 4)] == [True, True, False, True]
    assert rows[2].chosen == "" and rows[2].chosen_loss == [] and len(rows[2].rejected_loss) == 1
    assert rows[4].prompt == "" and rows[1].prompt != "old"
