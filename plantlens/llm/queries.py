"""The operators as queries over whole tables, with production parameters."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plantlens.llm import (
    bpe,
    decontaminate,
    html_template,
    line_dedup,
    mixing,
    preference,
    prefix_trie,
    quality_rules,
    sanitise,
    simhash,
    toxicity,
    warc_zip,
    whitening,
)
from plantlens.llm.common import table
from plantlens.registry.core import Query
from plantlens.session import use_utc

LLM_QUERIES: dict[str, Query] = {}


def query(name: str, sql: str | None = None):
    def register(run):
        LLM_QUERIES[name] = Query(lambda spark, sf_dir: run(use_utc(spark), sf_dir), sql)
        return run

    return register


LINE_DEDUP_SQL = r"""
WITH numbered AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM documents),
lines AS (
  SELECT r, doc_id, i, line,
         translate(regexp_replace(line, '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g'),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS line_key
  FROM (SELECT r, doc_id, unnest(string_split(text, chr(10))) AS line,
               generate_subscripts(string_split(text, chr(10)), 1) AS i
        FROM numbered)),
frequent AS (
  SELECT line_key FROM lines WHERE line_key <> ''
  GROUP BY line_key HAVING count(DISTINCT r) >= 10),
marked AS (
  SELECT l.*, f.line_key IS NOT NULL AS gone FROM lines l LEFT JOIN frequent f USING (line_key))
SELECT doc_id, count(*) AS n_lines, CAST(count(*) FILTER (gone) AS BIGINT) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (NOT gone), '')) AS kept_sha256
FROM marked GROUP BY r, doc_id
"""


@query("op1_line_dedup", LINE_DEDUP_SQL)
def line_dedup_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    kept = line_dedup.clean(docs, line_dedup.start(docs, min_docs=10))
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


@query("op4_simhash")
def simhash_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = simhash.near_duplicates(docs, keep=False)
    digits = F.lower(F.lpad(F.hex("simhash"), 16, "0"))
    return found.select("doc_id", digits.alias("fingerprint"), "component_id")


DECONTAMINATE_SQL = r"""
WITH doc_words AS (
  SELECT doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
item_words AS (
  SELECT item_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
windows AS (
  SELECT DISTINCT item_id, least(13, len(w)) AS size,
         array_to_string(list_slice(w, i, i + least(13, len(w)) - 1), ' ') AS words
  FROM (SELECT item_id, w, unnest(range(1, greatest(2, len(w) - 11))) AS i FROM item_words
        WHERE len(w) > 0)),
doc_windows AS (
  SELECT doc_id, i, size, array_to_string(list_slice(w, i, i + size - 1), ' ') AS words
  FROM (SELECT d.doc_id, d.w, s.size, unnest(range(1, greatest(1, len(d.w) - s.size + 2))) AS i
        FROM doc_words d, (SELECT DISTINCT size FROM windows) s)),
found AS (SELECT doc_id, i, size, item_id FROM doc_windows JOIN windows USING (size, words)),
hit AS (
  SELECT doc_id, count(DISTINCT place) AS n_hit
  FROM (SELECT doc_id, unnest(range(i, i + size)) AS place FROM found) GROUP BY doc_id),
items AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS ids
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM found) GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit,
       coalesce(n_items, 0) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM doc_words LEFT JOIN hit USING (doc_id) LEFT JOIN items USING (doc_id)
"""


@query("op7_decontaminate", DECONTAMINATE_SQL)
def decontaminate_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = decontaminate.find_passages(docs, table(spark, sf_dir, "benchmark"), keep=False)
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("item_ids").cast("long").alias("n_items"),
        F.sha2(F.array_join("item_ids", ","), 256).alias("items_sha256"),
        decontaminate.contaminated().alias("contaminated"),
    )


@query("op6_quality_rules")
def quality_rules_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    rules = quality_rules.learn(docs, table(spark, sf_dir, "labels"))
    return quality_rules.judge(docs, rules, keep=False).select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        "base_failed",
        "kept",
    )


MIX_POWERS = {"source": 0.7, "lang": 0.8, "topic": 0.9}


@query("op8_mixing")
def mixing_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source")
    mixed = mixing.mix(docs, MIX_POWERS)
    return mixed.select(
        "doc_id", "source", "lang", "topic", "n_tokens", "probability", "n_copies"
    )


PREFERENCE_SQL = r"""
WITH rendered AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS said FROM conversations),
said AS (
  SELECT DISTINCT conv_id, turn, role, said, CAST(NULL AS BIGINT) AS alone FROM rendered WHERE conv_id IS NOT NULL
  UNION ALL
  SELECT conv_id, turn, role, said, row_number() OVER () FROM rendered WHERE conv_id IS NULL),
spoken AS (
  SELECT conv_id, list(struct_pack(role := role, said := said)
                       ORDER BY turn NULLS FIRST, role, said) AS turns
  FROM said GROUP BY conv_id, alone),
known AS (
  SELECT *, coalesce(list_max(list_filter(range(1, len(turns) + 1),
                                          lambda i: turns[i].role = 'assistant')), 0) AS last
  FROM spoken),
pairs AS (
  SELECT k.conv_id, k.turns AS chosen,
         CASE WHEN k.last > 0 THEN list_append(k.turns[1:k.last - 1],
           struct_pack(role := 'assistant', said := coalesce(d.turns[d.last].said, '')))
         ELSE k.turns END AS rejected
  FROM known k LEFT JOIN known d ON d.conv_id = k.conv_id + 1 AND d.last > 0),
cut AS (
  SELECT *, coalesce(list_filter(range(1, least(len(chosen), len(rejected)) + 1),
                                 lambda i: chosen[i] <> rejected[i])[1] - 1,
                     least(len(chosen), len(rejected))) AS n FROM pairs),
texts AS (
  SELECT conv_id, n,
    list_transform(chosen[1:n], lambda t: '<|im_start|>' || t.role || chr(10) || t.said || '<|im_end|>' || chr(10)) AS p,
    chosen[n + 1:] AS c, rejected[n + 1:] AS r,
    list_transform(chosen[n + 1:], lambda t: '<|im_start|>' || t.role || chr(10) || t.said || '<|im_end|>' || chr(10)) AS cr,
    list_transform(rejected[n + 1:], lambda t: '<|im_start|>' || t.role || chr(10) || t.said || '<|im_end|>' || chr(10)) AS rr
  FROM cut)
SELECT conv_id, CAST(n AS INTEGER) AS n_prompt_turns, len(c) > 0 OR len(r) > 0 AS differs,
  coalesce(array_to_string(p, ''), '') AS prompt,
  coalesce(array_to_string(cr, ''), '') AS chosen, coalesce(array_to_string(rr, ''), '') AS rejected,
  coalesce(array_to_string(list_transform(
    list_filter(range(1, len(c) + 1), lambda i: c[i].role = 'assistant'),
    lambda i: (length(array_to_string(cr[1:i - 1], '')) + 13 + length(c[i].role)) || ':' ||
              length(array_to_string(cr[1:i], ''))), ','), '') AS chosen_loss,
  coalesce(array_to_string(list_transform(
    list_filter(range(1, len(r) + 1), lambda i: r[i].role = 'assistant'),
    lambda i: (length(array_to_string(rr[1:i - 1], '')) + 13 + length(r[i].role)) || ':' ||
              length(array_to_string(rr[1:i], ''))), ','), '') AS rejected_loss
FROM texts
"""


@query("op10_preference", PREFERENCE_SQL)
def preference_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    spoken = preference.conversations(table(spark, sf_dir, "conversations"))
    formatted = preference.format_pairs(preference.swapped_replies(spoken))

    def listed(spans: str):
        return F.array_join(
            F.transform(spans, lambda s: F.concat_ws(":", s["start"].cast("string"), s["end"].cast("string"))), ","
        )

    return formatted.withColumns(
        {name: listed(name) for name in ("chosen_loss", "rejected_loss")}
    )


@query("op3_toxicity")
def toxicity_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.train(docs, table(spark, sf_dir, "labels"))
    scored = toxicity.score(docs, model, keep=False)
    return scored.select("doc_id", toxicity.held_out().alias("held_out"), "score", "predicted")


@query("op5_sanitise")
def sanitise_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = sanitise.find_spans(docs)
    base = list(sanitise.KINDS)
    return found.select(
        "doc_id",
        *(F.size(f"{kind}_spans").cast("long").alias(f"n_{kind}") for kind in base),
        F.sha2(sanitise.span_list(base), 256).alias("base_sha256"),
        sanitise.span_list([*base, "term"]).alias("spans"),
    )


WARC_SQL = r"""
WITH payloads AS (
  SELECT page_id, coalesce(html, '') AS payload, sha1(coalesce(html, '')) AS h FROM pages),
marked AS (SELECT *, max(page_id) OVER (PARTITION BY h) AS original FROM payloads),
bits AS (
  SELECT page_id, original, strlen(payload) AS payload_bytes,
    list_transform(range(0, 8), lambda g: list_transform(range(0, 5), lambda b:
      ('0x' || substr(h, CAST(1 + 5 * g + b AS INTEGER), 1))::INTEGER)) AS groups
  FROM marked),
numbers AS (
  SELECT page_id, original, payload_bytes, list_transform(groups, lambda g:
    (g[1] * 65536 + g[2] * 4096 + g[3] * 256 + g[4] * 16 + g[5])::BIGINT) AS twenty FROM bits)
SELECT page_id, CAST(payload_bytes AS BIGINT) AS payload_bytes,
  array_to_string(list_transform(twenty, lambda n: array_to_string(list_transform([15, 10, 5, 0],
    lambda s: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', CAST(1 + ((n >> s) & 31) AS INTEGER), 1)),
    '')), '') AS payload_digest,
  CASE WHEN page_id = original THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id = original THEN NULL ELSE original END AS refers_to
FROM numbers
"""


@query("op2_warc", WARC_SQL)
def warc_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    manifest = warc_zip.write_archives(table(spark, sf_dir, "pages"))
    return warc_zip.read_archives(manifest, payloads=False).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"
    )


@query("op9_html_template")
def html_template_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    return html_template.extract(pages).select("page_id", "url", "text", "n_chars")


VOCABULARY = "word_bpe_49k.json"


@query("op11_bpe")
def bpe_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path(VOCABULARY)
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    coded = bpe.encode(docs, path, binary=True, keep=False, decoded=True)
    return coded.select(
        "doc_id",
        F.floor(F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )


@query("op12_whitening")
def whitening_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    model = whitening.fit(vectors)
    rows = whitening.by_component(whitening.apply_whitening(vectors, model, keep=False), model)
    return rows.select(
        "vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"
    )


TRIE_SQL = r"""
WITH said AS (
  SELECT conv_id, turn, coalesce(text, '') AS said,
         md5(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')) AS digest
  FROM conversations WHERE conv_id IS NOT NULL),
spoken AS (
  SELECT conv_id, list(struct_pack(digest := digest, n_bytes := strlen(said))
                       ORDER BY turn NULLS FIRST, digest) AS own
  FROM said GROUP BY conv_id),
begun AS (
  SELECT conv_id, own, xor(4294967295, list_reduce(list_prepend(4294967295, flatten(list_transform(
      string_split(CAST(conv_id AS VARCHAR), ''),
      lambda x: list_prepend(CAST(ascii(x) AS BIGINT), [-1, -1, -1, -1, -1, -1, -1, -1])))),
    lambda crc, s: CASE WHEN s >= 0 THEN xor(crc, s) WHEN crc & 1 = 1 THEN xor(crc >> 1, 3988292384)
                        ELSE crc >> 1 END)) % 9 AS h
  FROM spoken),
rebuilt AS (
  SELECT c.conv_id, list_concat(coalesce(b.own, [])[1:c.h], c.own[c.h + 1:]) AS turns
  FROM begun c LEFT JOIN spoken b ON b.conv_id = c.conv_id - c.conv_id % 5),
members AS (
  SELECT conv_id, d AS depth, d = len(turns) AS is_end,
         array_to_string(list_transform(turns[1:d], lambda t: t.digest), ',') AS node,
         array_to_string(list_transform(turns[1:d - 1], lambda t: t.digest), ',') AS parent,
         CASE WHEN d = 0 THEN 0 ELSE turns[d].n_bytes END AS n_bytes
  FROM (SELECT conv_id, turns, unnest(range(0, len(turns) + 1)) AS d FROM rebuilt)),
nodes AS (
  SELECT depth, node, min(parent) AS parent, min(conv_id) AS conv_id, count(*) AS n_convs,
         (count(*) - 1) * max(n_bytes) AS own_saved,
         sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (is_end), ''))
           AS ends_sha256
  FROM members GROUP BY depth, node),
children AS (
  SELECT depth - 1 AS depth, parent AS node, count(*) AS n_children
  FROM nodes WHERE depth > 0 GROUP BY 1, 2),
counted AS (
  SELECT n.*, coalesce(n_children, 0) AS n_children
  FROM nodes n LEFT JOIN children USING (depth, node)),
upward AS (
  SELECT m.depth, m.node, sum(CAST(c.n_children = 0 AS BIGINT)) AS n_leaves, sum(c.own_saved) AS saved
  FROM counted c JOIN members m ON m.conv_id = c.conv_id AND m.depth <= c.depth
  GROUP BY m.depth, m.node)
SELECT c.conv_id, c.depth, p.conv_id AS parent_conv_id, c.n_convs, c.n_children,
       CAST(u.n_leaves AS BIGINT) AS n_leaves, CAST(u.saved AS BIGINT) AS saved_tokens, c.ends_sha256
FROM counted c JOIN upward u USING (depth, node)
LEFT JOIN nodes p ON c.depth > 0 AND p.depth = c.depth - 1 AND p.node = c.parent
"""


@query("op13_prefix_trie", TRIE_SQL)
def prefix_trie_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = prefix_trie.turns_in_order(table(spark, sf_dir, "conversations"))
    return prefix_trie.prefix_trie(*prefix_trie.rebuilt(turns, every=5, most=9))
