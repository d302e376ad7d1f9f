"""Information-theoretic sanitisation of personal data, all in DataFrame and SQL functions.

Four kinds of identifiers are found by pattern: e-mail and IP addresses, card and phone numbers.
These are the protected entities. Terms near an entity may give it away as well. Texts are cut into
pieces, a line or `PIECE` words of one; a context is a piece with the `REACH` pieces before and after
it, across line ends. Over the corpus, the information that a term t gives of an entity e is

    PMI(t; e) = log( N * n(t, e) / (n(t) * n(e)) ),    IC(e) = log( N / n(e) )

with n counting different contexts: all N, those with e in any piece, those with t in the middle
one, and those with both. Terms are all words, letters and digits of any script, told apart without
regard to case (`TERM`, a parameter). A term discloses e if n(t, e) is at least `MIN_CONTEXTS` and
PMI is at least `ALPHA` of IC: knowing t then leaves almost nothing to learn of e. Equal contexts
count once, so that copies of one text are no evidence.
Disclosing terms are protected wherever they occur. Words inside an identifier are no terms beside it.

Pieces hold at most `PIECE` words, so the pairs of term and entity grow with the text.
Counts are aggregated before each shuffle. Candidate terms are broadcast up to `BROADCAST_BYTES`
and else joined by shuffle. Up to `TERMS_AT_ONCE` disclosing terms are looked up in a set in one
pass over the texts; more are joined to the different words of the texts.

Spans are code points, end exclusive. Null texts are empty: no spans. Repeated rows get the same
spans each. Patterns run in linear time on long runs of letters and digits. Input columns named
like an output column are replaced.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plantlens.llm.common import fresh, join_hot, stored, stored_bytes, without

PIECE = 32
REACH = 3
MIN_CONTEXTS = 4
ALPHA = 0.9
BROADCAST_BYTES = 32 << 20
TERMS_AT_ONCE = 50_000
WORD = r"\p{L}\p{M}\p{N}"
TERM = rf"[{WORD}]++"

# Possessive forms, begun only where a run begins or the last match ended, match the same spans as
# the plain ones without trying every place of a run.
PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++(?:\.[0-9]++){3}",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
KINDS = tuple(PATTERNS)
ADDED = [*(f"{kind}_spans" for kind in KINDS), "term_spans"]
SPAN_TYPE = "array<struct<start:int,end:int,value:string>>"
PART = "0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2})"


def digits_of(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """Every second digit from the right is doubled, less 9 if above 9; the sum ends in 0."""
    n = F.length(digits)

    def share(i: Column) -> Column:
        digit = F.substring(digits, i, F.lit(1)).cast("int")
        twice = 2 * digit
        doubled = F.when(twice > 9, twice - 9).otherwise(twice)
        return F.when((n - i) % 2 == 1, doubled).otherwise(digit)

    places = F.sequence(F.lit(1), n)
    return F.aggregate(places, F.lit(0), lambda total, i: total + share(i)) % 10 == 0


def valid(kind: str, value: Column) -> Column:
    digits = digits_of(value)
    if kind == "ip":
        return value.rlike(rf"^{PART}(?:\.{PART}){{3}}$")
    if kind == "card":
        return F.length(digits).between(16, 19) & luhn(digits)
    if kind == "phone":
        return F.length(digits).between(8, 15)
    return F.lit(True)


def pattern_spans(text: Column, kind: str) -> Column:
    """Spans of the valid matches of a kind: (start, end, value), in order."""
    found = spans_where(text, PATTERNS[kind], lambda match: valid(kind, match))
    return F.when(may_have(text, kind), found).otherwise(F.array().cast(SPAN_TYPE))


def spans_where(text: Column, pattern: str, wanted: Callable[[Column], Column]) -> Column:
    """Spans of the wanted matches: the pieces between matches and the matches give the places."""
    matches = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    pieces = F.split(text, pattern, -1)
    empty = F.struct(F.lit(0).alias("at"), F.array().cast(SPAN_TYPE).alias("spans"))

    def step(state: Column, pair: Column) -> Column:
        start = state["at"] + F.length(pair["piece"])
        end = start + F.length(pair["match"])
        span = F.struct(start.alias("start"), end.alias("end"), pair["match"].alias("value"))
        spans = F.when(wanted(pair["match"]), F.array_append(state["spans"], span))
        return F.struct(end.alias("at"), spans.otherwise(state["spans"]).alias("spans"))

    pairs = F.zip_with(
        F.slice(pieces, 1, F.size(matches)),
        matches,
        lambda piece, match: F.struct(piece.alias("piece"), match.alias("match")),
    )
    return F.aggregate(pairs, empty, step, lambda state: state["spans"])


def may_have(text: Column, kind: str) -> Column:
    """A cheap test that every text with a match passes."""
    if kind == "email":
        return F.contains(text, F.lit("@"))
    if kind == "phone":
        return text.rlike(r"\+[0-9]")
    return text.rlike(r"[0-9]\.[0-9]" if kind == "ip" else r"[0-9](?:[\x20-]?[0-9]){15}")


def base_spans(docs: DataFrame, text: str = "text") -> DataFrame:
    """`docs` with an array of spans for each kind."""
    whole = F.coalesce(F.col(text), F.lit(""))
    return without(docs, ADDED).withColumns(
        {f"{kind}_spans": pattern_spans(whole, kind) for kind in KINDS}
    )


def bound_to(value: Column, body: Callable[[Column], Column]) -> Column:
    """`body` of a value that is computed once, also where a lambda of the body uses it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def has_words(text: str) -> Column:
    return F.col(text).rlike(f"[{WORD}]")


def pieces_of(text: Column) -> Column:
    """Pieces of a text that has words: lines, with wordless ones before, or `PIECE` words of them."""
    cut = rf"(?:[^{WORD}\n]*+\n)*+(?:[^{WORD}\n]*+[{WORD}]++){{1,{PIECE}}}(?:[^{WORD}\n]*+(?:\n++|\z))?"
    ended = F.regexp_replace(text, rf"(?<=[{WORD}])[^{WORD}]++\z", "")
    return F.regexp_extract_all(ended, F.lit(cut), F.lit(0))


def window(items: Column, i: Column) -> Column:
    """The items up to `REACH` before and after place i, which counts from 0."""
    first = F.greatest(i - REACH, F.lit(0))
    return F.slice(items, first + 1, F.least(i + REACH + 1, F.size(items)) - first)


def context_key(hashes: Column, i: Column) -> Column:
    """Hash of the context of piece i, with what it lacks at the ends of the text."""
    before = F.greatest(REACH - i, F.lit(0))
    after = F.greatest(i + REACH + 1 - F.size(hashes), F.lit(0))
    return F.xxhash64(window(hashes, i), before, after)


def contexts_of(text: Column, more: Callable[[Column], Column] | None = None) -> Column:
    """The contexts of a text in order: key, piece, the piece after it, items of `more` in the window."""

    def placed(pieces: Column, hashes: Column, items: Column | None) -> Column:
        def context(i: Column) -> Column:
            after = F.coalesce(F.try_element_at(pieces, i + 2), F.lit(""))
            fields = [context_key(hashes, i).alias("key"), F.element_at(pieces, i + 1).alias("piece"), after.alias("after")]
            if items is not None:
                fields.append(F.array_distinct(F.flatten(window(items, i))).alias("items"))
            return F.struct(*fields)

        return F.transform(F.sequence(F.lit(0), F.size(pieces) - 1), context)

    def hashed(pieces: Column) -> Column:
        return F.transform(pieces, lambda piece: F.xxhash64(piece))

    if more is None:
        return bound_to(pieces_of(text), lambda p: bound_to(hashed(p), lambda h: placed(p, h, None)))
    return bound_to(
        pieces_of(text),
        lambda p: bound_to(hashed(p), lambda h: bound_to(more(p), lambda items: placed(p, h, items))),
    )


def terms_in(text: Column, term: str) -> Column:
    """The different terms of a text, in lower case."""
    return F.array_distinct(F.transform(F.regexp_extract_all(text, F.lit(term), F.lit(0)), F.lower))


def entities_of(pieces: Column) -> Column:
    """The identifiers that begin in each piece, as kind:value.

    They are sought in the piece and the one after it, and do not begin where a piece cuts its line:
    what stands there may be the rest of another.
    """

    def begun(i: Column) -> Column:
        piece = F.element_at(pieces, i + 1)
        after = F.coalesce(F.try_element_at(pieces, i + 2), F.lit(""))
        fresh_line = (i == 0) | F.endswith(F.element_at(pieces, F.greatest(i, F.lit(1))), F.lit("\n"))
        return bound_to(F.concat(piece, after), lambda block: named(block, F.length(piece), fresh_line))

    def named(block: Column, end: Column, fresh_line: Column) -> Column:
        lead = F.length(F.regexp_extract(block, rf"^[^{WORD}]*+", 0))

        def of_kind(kind: str) -> Column:
            mine = F.filter(
                pattern_spans(block, kind), lambda s: (s["start"] < end) & (fresh_line | (s["start"] > lead))
            )
            return F.transform(mine, lambda s: F.concat_ws(":", F.lit(kind), F.lower(s["value"])))

        return F.concat(*map(of_kind, KINDS))

    return F.transform(F.sequence(F.lit(0), F.size(pieces) - 1), begun)


def entity_contexts(docs: DataFrame, text: str, term: str) -> DataFrame:
    """Different contexts that hold identifiers: key, entities, terms of the piece beside them."""
    whole = F.col(text)
    any_kind = may_have(whole, "email") | may_have(whole, "ip") | may_have(whole, "phone") | may_have(whole, "card")
    likely = docs.where(has_words(text) & any_kind)
    placed = likely.select(F.explode(contexts_of(whole, entities_of)).alias("c")).where(F.size("c.items") > 0)
    rows = placed.select("c.key", "c.piece", F.col("c.items").alias("entities"), F.concat("c.piece", "c.after").alias("block"))

    def clipped(kind: str) -> Column:
        mine = F.filter(f"{kind}_spans", lambda s: s["start"] < F.length("piece"))
        ends = F.transform(
            mine,
            lambda s: F.struct(
                s["start"], F.least(s["end"], F.length("piece")).alias("end"), s["value"]
            ),
        )
        return tagged(ends, " ")

    beside = replaced(F.col("piece"), F.concat(*map(clipped, KINDS)))
    found = base_spans(rows, "block")
    return found.select("key", "entities", terms_in(beside, term).alias("terms")).dropDuplicates(["key"])


def disclosing_terms(
    docs: DataFrame,
    text: str = "text",
    least: int = MIN_CONTEXTS,
    alpha: float = ALPHA,
    term: str = TERM,
) -> DataFrame:
    """Terms (lower case) that disclose entities: term, n_entities, strength (largest PMI / IC)."""
    contexts = stored(entity_contexts(docs, text, term), "entity-contexts")
    keys = F.transform(contexts_of(F.col(text)), lambda c: c["key"])
    n_contexts = docs.where(has_words(text)).select(F.explode(keys).alias("key")).distinct().count()
    total = F.lit(float(max(n_contexts, 1)))
    information = F.log(total / F.col("n_e"))

    def strength(n_t: str) -> Column:
        return F.log(total * F.col("n_te") / (F.col(n_t) * F.col("n_e"))) / information

    entities = contexts.select(F.explode("entities").alias("entity")).groupBy("entity")
    repeated = entities.agg(F.count("*").alias("n_e")).where(F.col("n_e") >= least)
    # Contexts with any entity are some of those with the term: too many of them, and it is out.
    beside = contexts.select(F.explode("terms").alias("term")).groupBy("term")
    beside = beside.agg(F.count("*").alias("n_near")).where(F.col("n_near") >= least)
    met = contexts.select("terms", F.explode("entities").alias("entity"))
    together = met.select(F.explode("terms").alias("term"), "entity").groupBy("term", "entity")
    pairs = stored(
        together.agg(F.count("*").alias("n_te"))
        .where(F.col("n_te") >= least)
        .join(repeated, "entity")
        .join(beside, "term")
        .where(strength("n_near") >= alpha),
        "pairs",
    )
    candidates = stored(pairs.select("term").distinct(), "candidates")
    counts = contexts_with(docs, text, candidates, term)
    judged = pairs.join(counts, "term").withColumn("strength", strength("n_t"))
    return stored(
        judged.where(F.col("strength") >= alpha)
        .groupBy("term")
        .agg(F.count("*").alias("n_entities"), F.max("strength").alias("strength")),
        "disclosing",
    )


def wanted_only(rows: DataFrame, terms: DataFrame) -> DataFrame:
    """The rows whose `term` is one of the stored terms."""
    small = stored_bytes(terms) <= BROADCAST_BYTES
    wanted = terms.select("term")
    return rows.join(F.broadcast(wanted) if small else wanted.hint("merge"), "term", "left_semi")


def contexts_with(docs: DataFrame, text: str, candidates: DataFrame, term: str) -> DataFrame:
    """Number of different contexts with each candidate term: term, n_t."""
    placed = docs.where(has_words(text)).select(F.explode(contexts_of(F.col(text))).alias("c"))
    words = placed.select("c.key", F.explode(terms_in(F.col("c.piece"), term)).alias("term"))
    found = wanted_only(words, candidates).distinct()
    return found.groupBy("term").agg(F.count("*").alias("n_t"))


def find_spans(
    docs: DataFrame, text: str = "text", terms: DataFrame | None = None, term: str = TERM
) -> DataFrame:
    """`docs` with the arrays email_spans, ip_spans, card_spans, phone_spans and term_spans.

    `terms` are those of `disclosing_terms`, by default of these documents.
    """
    judged = disclosing_terms(docs, text, term=term) if terms is None else stored(terms, "terms")
    found = base_spans(docs, text)
    whole = F.coalesce(F.col(text), F.lit(""))
    if judged.count() <= TERMS_AT_ONCE:
        words = [row["term"] for row in judged.select("term").collect()]
        spans = spans_where(whole, term, lambda match: F.lower(match).isin(words))
        return found.withColumn("term_spans", spans if words else F.array().cast(SPAN_TYPE))
    key, own, n_rows = (fresh(name, found) for name in ("_key", "_own", "_rows"))
    keyed = found.withColumn(key, F.sha2(whole, 256))
    words = keyed.select(key, F.explode(terms_in(whole, term)).alias("term"))
    owned = wanted_only(words, judged).groupBy(key).agg(F.collect_set("term").alias(own))
    n_texts = keyed.groupBy(key).agg(F.count("*").alias(n_rows))
    lookup = stored(owned.join(n_texts, key), "terms-of-texts")
    joined = join_hot(keyed, lookup, [key], n_rows, F.rand(7), "left")
    mine = F.coalesce(F.col(own), F.array().cast("array<string>"))
    spans = spans_where(whole, term, lambda match: F.array_contains(mine, F.lower(match)))
    named = joined.withColumn("term_spans", F.when(F.size(mine) > 0, spans).otherwise(F.array().cast(SPAN_TYPE)))
    return named.select(*(F.col(f"`{c}`") for c in found.columns), "term_spans")


def span_list(kinds: list[str]) -> Column:
    """Spans as kind:start:end, by kind as listed, then start, comma-joined."""

    def listed(kind: str) -> Column:
        return F.transform(
            f"{kind}_spans",
            lambda s: F.concat_ws(
                ":", F.lit(kind), s["start"].cast("string"), s["end"].cast("string")
            ),
        )

    return F.array_join(F.concat(*map(listed, kinds)), ",")


TAGS = {"email": "[EMAIL]", "ip": "[IP]", "card": "[CARD]", "phone": "[PHONE]", "term": "[NAME]"}


def tagged(spans: Column | str, tag: str) -> Column:
    """Spans in the form in which they are sorted and replaced, with what replaces them."""
    return F.transform(
        spans,
        lambda s: F.struct(s["start"], (-s["end"]).alias("back"), F.lit(tag).alias("tag")),
    )


def replaced(whole: Column, spans: Column) -> Column:
    """A text with its tagged spans replaced; one that begins inside another goes with it."""
    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))

    def step(state: Column, span: Column) -> Column:
        before = F.substring(whole, state["at"] + 1, span["start"] - state["at"])
        fresh = F.struct((-span["back"]).alias("at"), F.concat(state["out"], before, span["tag"]).alias("out"))
        inside = F.struct(F.greatest(state["at"], -span["back"]).alias("at"), state["out"].alias("out"))
        return F.when(span["start"] >= state["at"], fresh).otherwise(inside)

    def finish(state: Column) -> Column:
        return F.concat(state["out"], F.substring(whole, state["at"] + 1, F.length(whole)))

    return F.aggregate(F.array_sort(spans), start, step, finish)


def sanitise(found: DataFrame, text: str = "text", tags: dict[str, str] = TAGS) -> DataFrame:
    """The texts of `find_spans` with each span generalised to its tag; an empty tag removes it.

    Overlapping spans give way to the one that begins first, the longer one at a tie.
    """
    whole = F.coalesce(F.col(text), F.lit(""))
    spans = F.concat(*(tagged(f"{kind}_spans", tag) for kind, tag in tags.items()))
    return found.withColumn(text, replaced(whole, spans))
