"""Terms that disclose an entity: against a plain version, across lines, in any case, beyond one set."""

import math
from collections import Counter, defaultdict

import numpy as np
import pytest
import regex
from pyspark.sql import functions as F

from plantlens.llm import sanitise
from test_llm_queries import plain_spans

DOCS = "doc_id long, text string"
WORD = regex.compile(r"[\p{L}\p{M}\p{N}]+")


def plain_pieces(text):
    """Pieces end behind the line breaks that follow a line with words, or behind their last word."""
    places = [m.span() for m in WORD.finditer(text)]
    cuts, words = [], 0
    for (_, end), (start, _) in zip(places, places[1:]):
        words += 1
        breaks = regex.match(r"[^\n]*\n+", text[end:start])
        if breaks:
            cuts.append(end + breaks.end())
            words = 0
        elif words == sanitise.PIECE:
            cuts.append(end)
            words = 0
    edges = [0, *cuts, places[-1][1]] if places else []
    return [text[b:e] for b, e in zip(edges, edges[1:])]


def plain_terms(texts, least, alpha):
    """The counts from their definitions, for texts whose pieces cut no identifier."""
    contexts = {}
    for text in texts:
        pieces = plain_pieces(text)
        for i in range(len(pieces)):
            span = range(i - sanitise.REACH, i + sanitise.REACH + 1)
            own = tuple(pieces[k] if 0 <= k < len(pieces) else None for k in span)
            entities, middle = set(), None
            for k in span:
                if 0 <= k < len(pieces):
                    spans = [s.split(":") for s in plain_spans(pieces[k])]
                    entities |= {s[0] + ":" + pieces[k][int(s[1]) : int(s[2])].lower() for s in spans}
                    if k == i:
                        rest = list(pieces[k])
                        for _, b, e in spans:
                            rest[int(b) : int(e)] = " " * (int(e) - int(b))
                        middle = {w.lower() for w in WORD.findall("".join(rest))}
            contexts[own] = entities, middle, {w.lower() for w in WORD.findall(pieces[i])}
    total, out = len(contexts), defaultdict(dict)
    n_e = Counter(e for entities, _, _ in contexts.values() for e in entities)
    n_t = Counter(t for _, _, words in contexts.values() for t in words)
    n_te = Counter((t, e) for entities, middle, _ in contexts.values() for t in middle for e in entities)
    for (term, entity), n in n_te.items():
        if n >= least and n_e[entity] < total:
            strength = math.log(total * n / (n_t[term] * n_e[entity])) / math.log(total / n_e[entity])
            if strength >= alpha:
                out[term][entity] = strength
    return {t: (len(e), max(e.values())) for t, e in out.items()}


def corpus(seed, n=120):
    rng = np.random.default_rng(seed)
    people = [("Ann Oldfield", "ann.o@ex.org"), ("zebedee", "+1 555 123 4567"), ("κώστας", "10.1.2.3"), ("K4711", "k@w.de")]
    words = ["the", "a", "Note", "mail", "from", "city", "7", "été", "run"]
    texts = []
    for i in range(n):
        lines = [" ".join(rng.choice(words, rng.integers(1, 9))) for _ in range(rng.integers(1, 6))]
        if i % 3 == 0:
            name, address = people[rng.integers(len(people))]
            gap = ["\n", " ", "\nrun the note\n", "\n\n--\n"][rng.integers(4)]
            lines.insert(int(rng.integers(len(lines) + 1)), f"{name.upper() if i % 2 else name}{gap}{address} x{i}")
        texts.append("\n".join(lines))
    return [*texts, "", "\n\n", texts[0], texts[3]]


def test_terms_equal_those_of_a_plain_version(spark):
    texts = corpus(1)
    docs = spark.createDataFrame(list(enumerate([*texts, None])), DOCS)
    expected = plain_terms(texts, sanitise.MIN_CONTEXTS, sanitise.ALPHA)
    found = {r.term: (r.n_entities, r.strength) for r in sanitise.disclosing_terms(docs).collect()}
    assert {"zebedee", "oldfield", "κώστας", "k4711"} <= found.keys()
    assert found.keys() == expected.keys()
    for term, (n, strength) in expected.items():
        assert found[term] == (n, pytest.approx(strength))


def test_names_near_an_address(spark):
    """On its line, on that above, with lines between; in lower case as well."""
    gaps = {"zebedee": "\n", "quux": " ", "Osric": "\nHead of sales\n", "ivo": "\n\n"}
    rows = [
        f"letter {i} of many\n{name}{gap}{name[0]}{name[-1]}@corp.org\nbye {i}"
        for name, gap in gaps.items() for i in range(40)
    ]
    rows += [f"letter {i} of many sales by a head\nbye {i}\nbye" for i in range(100, 900)]
    docs = spark.createDataFrame(list(enumerate([*rows, "Saw ZEBEDEE, not zebedees"])), DOCS)
    terms = sanitise.disclosing_terms(docs)
    assert {r.term for r in terms.collect()} == {"zebedee", "quux", "osric", "ivo"}
    row = sanitise.find_spans(docs, terms=terms).where(F.col("doc_id") == len(rows)).first()
    assert [tuple(s) for s in row.term_spans] == [(4, 11, "ZEBEDEE")]


def test_identifiers_cut_by_a_context_are_no_entities(spark):
    """A card number over the edges of pieces is only ever seen whole."""
    texts = [" ".join(f"w{k}" for k in range(n)) + " 4111 1111 1111 1111 00 tail" for n in range(20, 40)]
    docs = spark.createDataFrame(list(enumerate(texts)), DOCS)
    whole = {r.entity for r in sanitise.entity_contexts(docs, "text", sanitise.TERM).select(
        F.explode("entities").alias("entity")).collect()}
    everywhere = {f"{s.split(':')[0]}:{t[int(s.split(':')[1]):int(s.split(':')[2])]}" for t in texts for s in plain_spans(t)}
    assert whole == everywhere


def test_long_pieces_stay_bounded(spark):
    text = ",".join(f"a{i}@b.org" for i in range(3000)) + " " + "x" * 200_000
    docs = spark.createDataFrame([(1, text)], DOCS)
    widest = sanitise.entity_contexts(docs, "text", sanitise.TERM).agg(
        F.max(F.size("entities")), F.max(F.size("terms"))).first()
    assert 0 < max(widest) <= sanitise.PIECE * (2 * sanitise.REACH + 1)


def test_more_terms_than_one_set_holds(spark, monkeypatch):
    rows = [(i, t) for i, t in enumerate(corpus(3))] + [(900, None), (901, "Zebedee"), (901, "Zebedee")]
    docs = spark.createDataFrame(rows, DOCS).withColumn("_key", F.lit(5)).withColumn("_own", F.lit("o"))
    terms = sanitise.disclosing_terms(docs)
    usual = sorted(map(tuple, sanitise.find_spans(docs, terms=terms).collect()), key=str)
    monkeypatch.setattr(sanitise, "TERMS_AT_ONCE", 0)
    joined = sorted(map(tuple, sanitise.find_spans(docs, terms=terms).collect()), key=str)
    assert joined == usual and any(row[-1] for row in usual)
    monkeypatch.setattr(sanitise, "BROADCAST_BYTES", -1)
    assert sorted(map(tuple, sanitise.find_spans(docs, terms=terms).collect()), key=str) == usual
