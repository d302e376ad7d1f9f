"""The operators' queries against SQL or brute force, on whole tables."""

import hashlib
import re
import zlib
from collections import Counter, defaultdict

import __spark_entry__ as entry_point
import numpy as np
import pytest
import xxhash
from compare import duckdb_views, spark_rows, sql_rows

from plantlens.llm.queries import LLM_QUERIES, MIX_POWERS


@pytest.fixture(scope="module")
def connection(sf_dir):
    return duckdb_views(sf_dir)


@pytest.fixture(scope="module")
def result(spark, sf_dir):
    kept = {}

    def of(name):
        if name not in kept:
            kept[name] = LLM_QUERIES[name].run(spark, sf_dir).collect()
        return kept[name]

    return of


@pytest.fixture(scope="module")
def labelled(spark):
    """A larger set of tables, for what is learned from labels."""
    folder = "/root/testdata/sf0.01"

    def of(name, label):
        labels = dict(duckdb_views(folder).execute(f"SELECT doc_id, {label} FROM labels").fetchall())
        return labels, LLM_QUERIES[name].run(spark, folder).collect()

    return of


def texts(connection, table="documents", key="doc_id", column="text"):
    return dict(connection.execute(f"SELECT {key}, coalesce({column}, '') FROM {table}").fetchall())


def test_all_are_registered():
    numbers = [int(re.match(r"op(\d+)_", name)[1]) for name in LLM_QUERIES]
    assert sorted(numbers) == list(range(1, 14))
    assert {*LLM_QUERIES, "pipeline"} <= set(entry_point.queries())


@pytest.mark.parametrize("name", [n for n, q in LLM_QUERIES.items() if q.sql])
def test_query_equals_sql(spark, sf_dir, connection, name):
    columns, rows = spark_rows(LLM_QUERIES[name].run(spark, sf_dir))
    expected_columns, expected = sql_rows(connection, LLM_QUERIES[name].sql)
    assert columns == expected_columns
    assert rows == expected and rows


def plain_fingerprint(text, size=3):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text))
    grams = [" ".join(words[i : i + size]) for i in range(max(1, len(words) - size + 1))] if words else []
    hashes = [xxhash.xxh64_intdigest(gram.encode(), 42) for gram in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_simhash(connection, result):
    marks = {doc: plain_fingerprint(t) for doc, t in texts(connection).items()}
    ids = sorted(marks)
    values = np.array([marks[i] for i in ids], dtype=np.uint64)
    parent = list(range(len(ids)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(ids)):
        for j in np.flatnonzero(np.bitwise_count(values ^ values[i]) <= 3):
            a, b = sorted((root(i), root(int(j))))
            parent[b] = a
    expected = {d: (f"{marks[d]:016x}", ids[root(i)]) for i, d in enumerate(ids)}
    assert {r.doc_id: (r.fingerprint, r.component_id) for r in result("op4_simhash")} == expected


PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    doubled = [int(c) * (1 + i % 2) for i, c in enumerate(reversed(digits))]
    return sum(d - 9 if d > 9 else d for d in doubled) % 10 == 0


def plain_spans(text):
    out = []
    for kind, pattern in PLAIN.items():
        for match in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", match[0])
            fine = {
                "email": True,
                "ip": kind == "ip" and all(int(p) <= 255 for p in match[0].split(".")),
                "card": 16 <= len(digits) <= 19 and luhn(digits),
                "phone": 8 <= len(digits) <= 15,
            }[kind]
            if fine:
                out.append(f"{kind}:{match.start()}:{match.end()}")
    return out


def test_sanitise(connection, result):
    found = {r.doc_id: r for r in result("op5_sanitise")}
    whole = texts(connection)
    assert found.keys() == whole.keys()
    for doc, text in whole.items():
        spans, row = plain_spans(text), found[doc]
        counts = Counter(s.split(":")[0] for s in spans)
        assert [row[f"n_{kind}"] for kind in PLAIN] == [counts[kind] for kind in PLAIN]
        assert row.base_sha256 == hashlib.sha256(",".join(spans).encode()).hexdigest()
        assert [s for s in row.spans.split(",") if s and not s.startswith("term")] == spans


def plain_statistics(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    counts = Counter(windows)
    repeated = {i + k for i, w in enumerate(windows) if counts[w] > 1 for k in range(3)}
    seen, dup = set(), 0
    for line in text.split("\n"):
        dup += line in seen and bool(re.search(r"[^\x20\x09-\x0D]", line))
        seen.add(line)
    return (
        len(words),
        sum(map(len, words)),
        len(re.findall(r"[#*$%&|<>]", text)),
        dup,
        len(repeated),
    )


def test_quality_rules(connection, result):
    found = {r.doc_id: r for r in result("op6_quality_rules")}
    for doc, text in texts(connection).items():
        row, expected = found.pop(doc), plain_statistics(text)
        assert tuple(row[1:6]) == expected
        assert row.base_failed == (expected[0] < 50 or 100 * expected[4] > 50 * expected[0])
        assert not (row.base_failed and row.kept)
    assert not found


def test_quality_rules_follow_the_labels(labelled):
    labels, rows = labelled("op6_quality_rules", "quality")
    rows = [r for r in rows if r.doc_id in labels and not r.base_failed]
    wrong = sum(r.kept != bool(labels[r.doc_id]) for r in rows)
    assert wrong <= 0.02 * len(rows)


def test_toxicity(labelled):
    labels, rows = labelled("op3_toxicity", "toxic")
    assert len(rows) == len({r.doc_id for r in rows}) == 1000
    for row in rows:
        assert row.held_out == (zlib.crc32(str(row.doc_id).encode()) % 5 == 0)
        assert 0 <= row.score <= 1 and row.predicted == int(row.score >= 0.5)
    known = [r for r in rows if r.doc_id in labels]
    toxic = [r.score for r in known if labels[r.doc_id]]
    clean = [r.score for r in known if not labels[r.doc_id]]
    assert np.mean([t > c for t in toxic for c in clean]) > 0.9
    assert np.mean([s < 0.5 for s in clean]) > 0.95


def test_mixing(result):
    rows = result("op8_mixing")
    tokens, cells = defaultdict(int), defaultdict(int)
    dims = list(MIX_POWERS)
    for row in rows:
        cell = tuple(row[d] for d in dims)
        cells[cell] += row.n_tokens
        for d in dims:
            tokens[d, row[d]] += row.n_tokens
    aims = {}
    for d, power in MIX_POWERS.items():
        own = {k: v**power for k, v in tokens.items() if k[0] == d}
        aims |= {k: v / sum(own.values()) for k, v in own.items()}
    weight = {c: float(n) for c, n in cells.items()}
    for _ in range(300):
        for i, d in enumerate(dims):
            sums = defaultdict(float)
            for c, w in weight.items():
                sums[c[i]] += w
            weight = {c: w * aims[d, c[i]] / sums[c[i]] if sums[c[i]] else 0.0 for c, w in weight.items()}
    ratio = {c: w / cells[c] if cells[c] else 0.0 for c, w in weight.items()}
    top = max(ratio.values())
    for row in rows:
        expected = ratio[tuple(row[d] for d in dims)] / top
        assert row.probability == pytest.approx(expected, abs=1e-5)
    drawn = sum(r.n_copies for r in rows)
    assert drawn == pytest.approx(sum(r.probability for r in rows), rel=0.25)


def test_pages(connection, result):
    import html

    found = {r.page_id: r for r in result("op9_html_template")}
    pages = texts(connection, "pages", "page_id", "html")
    assert found.keys() == pages.keys()
    for page, raw in pages.items():
        inner = re.search(r"<article>(.*?)(?:</article>|\Z)", raw, re.DOTALL)
        plain = re.sub(r"</?b>", "", inner[1]) if inner else ""
        expected = " ".join(html.unescape(re.sub(r"<[^>]*(?:>|\Z)", " ", plain)).split())
        assert found[page].text == expected
        assert found[page].n_chars == len(expected)
