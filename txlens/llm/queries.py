"""The registered queries ``opN_<name>`` and their DuckDB twins.

Each query is thin: it applies its operator, with production parameters, to the
whole table and derives the columns of its contract from the operator's output.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from txlens.llm import exact_dedup, hard_negatives, imatch, jaccard_join, licenses, mixing, packing, preference, records, secret_scan, toxicity, trie, warc
from txlens.llm.common import shared_path

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def register(name: str, oracle: str | None = None):
    def add(f):
        QUERIES[name] = f
        if oracle:
            ORACLE[name] = oracle
        return f
    return add


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf.rstrip('/')}/{name}.parquet")


@register("op1_toxicity")
def op1_toxicity(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "text")
    model = toxicity.fit(toxicity.training_rows(docs, table(spark, sf, "labels")))
    out = docs.select("doc_id", model.result(F.col("text")).alias("r"))
    return out.select("doc_id", toxicity.held_out(F.col("doc_id")).alias("held_out"), F.col("r.score").alias("score"),
                      F.when(F.col("r.score") >= 0.5, 1).otherwise(0).alias("predicted"), F.col("r.spans").alias("spans"))


@register("op2_mixing")
def op2_mixing(spark, sf):
    return mixing.mix(table(spark, sf, "documents"))


@register("op3_jaccard_join")
def op3_jaccard_join(spark, sf):
    return jaccard_join.jaccard_components(table(spark, sf, "documents"))


@register("op4_secret_scan")
def op4_secret_scan(spark, sf):
    found = secret_scan.with_spans(table(spark, sf, "documents").select("doc_id", "text")).drop("text")
    kind = lambda k: F.size(F.filter("spans", lambda s: s["kind"] == k)).cast("long")
    shown = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
    base = F.filter("spans", lambda s: s["kind"].isin(*secret_scan.BASE_KINDS))
    return found.select("doc_id", kind("assign").alias("n_assign"), kind("access").alias("n_access"), kind("hex").alias("n_hex"),
                        F.sha2(shown(base), 256).alias("base_sha256"), shown(F.col("spans")).alias("spans"))


@register("op5_warc_archive", """
SELECT page_id, payload_bytes, sha1(t) AS payload_digest,
       CASE WHEN payload_bytes >= 1000 AND page_id <> keep THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= 1000 AND page_id <> keep THEN keep END AS refers_to
FROM (SELECT page_id, t, CAST(strlen(t) AS BIGINT) AS payload_bytes, max(page_id) OVER (PARTITION BY t) AS keep
      FROM (SELECT page_id, coalesce(html, '') AS t FROM pages))
""")
def op5_warc_archive(spark, sf):
    folder = shared_path(spark, "warc")
    warc.write_archive(table(spark, sf, "pages"), folder)
    return warc.read_archive(spark, folder).select(
        "page_id", F.octet_length("payload").cast("long").alias("payload_bytes"), F.sha1("payload").alias("payload_digest"),
        "record_type", "refers_to")


@register("op6_packing")
def op6_packing(spark, sf):
    return packing.pack_documents(table(spark, sf, "documents"))


@register("op7_exact_dedup", """
SELECT doc_id, keep_id, group_size, doc_id IS NOT DISTINCT FROM keep_id AS kept, text_sha256
FROM (SELECT doc_id, max(doc_id) OVER (PARTITION BY t) AS keep_id, count(*) OVER (PARTITION BY t) AS group_size,
             sha256(t) AS text_sha256
      FROM (SELECT doc_id, coalesce(text, '') AS t FROM documents))
""")
def op7_exact_dedup(spark, sf):
    out = exact_dedup.refine(table(spark, sf, "documents"), hash_all=True)
    return out.withColumnRenamed("full_hash", "text_sha256")


@register("op8_imatch")
def op8_imatch(spark, sf):
    return imatch.edited_fingerprints(table(spark, sf, "documents"))


@register("op9_preference", """
WITH base AS (SELECT conv_id AS p, turn, role, text, max(turn) OVER (PARTITION BY conv_id) = turn AS last FROM conversations),
sides AS (SELECT p, true AS side, turn, role, text FROM base UNION ALL
          SELECT p, false, turn, role, CASE WHEN last THEN array_to_string(list_reverse(string_split(text, ' ')), ' ') ELSE text END FROM base),
numbered AS (SELECT p, side, coalesce(role, '') AS role, coalesce(text, '') AS text,
                    row_number() OVER (PARTITION BY p, side ORDER BY turn, role, text) AS n FROM sides WHERE p IS NOT NULL),
common AS (SELECT coalesce(c.p, r.p) AS p, min(coalesce(c.n, r.n)) FILTER (c.n IS NULL OR r.n IS NULL OR c.role <> r.role OR c.text <> r.text) AS k,
                  max(c.n) AS m
           FROM (SELECT * FROM numbered WHERE side) c FULL JOIN (SELECT * FROM numbered WHERE NOT side) r ON c.p = r.p AND c.n = r.n
           GROUP BY 1),
shown AS (SELECT n.*, '<|start|>' || role || chr(10) || text || '<|end|>' || chr(10) AS s, coalesce(k - 1, m) AS k
          FROM numbered n JOIN common USING (p)),
placed AS (SELECT *, sum(length(s)) OVER (PARTITION BY p, side, n > k ORDER BY n) AS upto FROM shown)
SELECT p AS pair_id, k AS n_common,
       coalesce(string_agg(s, '' ORDER BY n) FILTER (side AND n <= k), '') AS prompt,
       coalesce(string_agg(s, '' ORDER BY n) FILTER (side AND n > k), '') AS chosen,
       coalesce(string_agg(s, '' ORDER BY n) FILTER (NOT side AND n > k), '') AS rejected,
       coalesce(string_agg((upto - length(text) - 8) || ':' || upto, ',' ORDER BY n) FILTER (side AND n > k AND role = 'assistant'), '') AS chosen_spans,
       coalesce(string_agg((upto - length(text) - 8) || ':' || upto, ',' ORDER BY n) FILTER (NOT side AND n > k AND role = 'assistant'), '') AS rejected_spans,
       count(*) FILTER (n > k) = 0 AS tied
FROM placed GROUP BY p, k
""")
def op9_preference(spark, sf):
    out = preference.format_preferences(preference.preference_turns(table(spark, sf, "conversations")))
    text = lambda c: F.array_join(F.transform(c, lambda s: F.concat_ws(":", s["start"], s["end"])), ",").alias(c)
    return out.withColumns({c: text(c) for c in ("chosen_spans", "rejected_spans")})


@register("op10_token_records")
def op10_token_records(spark, sf):
    folder = shared_path(spark, "records")
    records.write_token_records(table(spark, sf, "documents"), folder)
    return records.read_token_records(spark, folder)


@register("op11_hard_negatives", """
WITH v AS (SELECT vec_id AS id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
                  list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS q
           FROM embeddings WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
           AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (SELECT a.id AS anchor_id, b.id, a.label = b.label AS same,
                  list_sum(list_transform(list_zip(a.q, b.q), lambda p: coalesce(p[1], 0) * coalesce(p[2], 0))) AS score
           FROM v a, v b WHERE a.id % 50 = 0 AND a.id <> b.id),
positive AS (SELECT anchor_id, id AS positive_id, score AS positive_score FROM scored WHERE same
             QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5),
ranked AS (SELECT anchor_id, positive_id, row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, id) AS rank, id AS negative_id,
                  positive_score, score AS negative_score
           FROM positive JOIN scored USING (anchor_id) WHERE NOT same AND 50 * positive_score <= 100 * score AND 100 * score <= 95 * positive_score)
SELECT anchor_id, positive_id, CAST(rank AS INTEGER) AS rank, negative_id, CAST(positive_score AS BIGINT) AS positive_score,
       CAST(negative_score AS BIGINT) AS negative_score FROM ranked WHERE rank <= 3
""")
def op11_hard_negatives(spark, sf):
    rows = table(spark, sf, "embeddings")
    rows = rows.withColumn("label", F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label")))
    return hard_negatives.mine(hard_negatives.quantised(rows))


@register("op12_conversation_trie", """
WITH RECURSIVE turns AS (SELECT conv_id AS c, coalesce(role, '') AS role, coalesce(text, '') AS text,
                                row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST) - 1 AS pos
                         FROM conversations WHERE conv_id IS NOT NULL),
crc AS (SELECT DISTINCT c, CAST(c AS VARCHAR) AS s, 0 AS i, 4294967295 AS v FROM turns
        UNION ALL SELECT c, s, i + 1, xor(w >> 1, CASE WHEN w & 1 = 1 THEN 3988292384 ELSE 0 END)
        FROM (SELECT *, CASE WHEN i % 8 = 0 THEN xor(v, ascii(substr(s, i // 8 + 1, 1))) ELSE v END AS w FROM crc WHERE i < 8 * length(s))),
conv AS (SELECT c, c - c % 100 AS base, xor(v, 4294967295) % 6 AS h FROM crc WHERE i = 8 * length(s)),
rebuilt AS (SELECT conv.c, t.pos, t.role, t.text FROM conv JOIN turns t ON t.c = conv.base AND t.pos < conv.h
            UNION ALL SELECT c, pos, role, text FROM conv JOIN turns USING (c) WHERE pos >= h),
path AS (SELECT conv.c, coalesce(list(length(role) || ':' || role || text ORDER BY pos) FILTER (pos IS NOT NULL), []) AS p,
                coalesce(list(CAST(length(text) AS BIGINT) ORDER BY pos) FILTER (pos IS NOT NULL), []) AS n
         FROM conv LEFT JOIN rebuilt USING (c) GROUP BY 1),
member AS (SELECT c, list_slice(p, 1, d) AS k, d, len(p) AS l, CASE WHEN d = 0 THEN 0 ELSE n[d] END AS chars FROM path, unnest(range(len(p) + 1)) u(d)),
node AS (SELECT k, d, min(c) AS conv_id, count(*) AS n_convs, (count(*) - 1) * any_value(chars) AS saved, max(l) = d AS leaf,
                sha256(coalesce(string_agg(CAST(c AS VARCHAR), ',' ORDER BY c) FILTER (l = d), '')) AS ends_sha256 FROM member GROUP BY 1, 2),
child AS (SELECT list_slice(k, 1, d - 1) AS k, count(*) AS n FROM node WHERE d > 0 GROUP BY 1),
tree AS (SELECT list_slice(k, 1, e) AS k, sum(CAST(leaf AS BIGINT)) AS leaves, sum(saved) AS saved FROM node, unnest(range(d + 1)) u(e) GROUP BY 1)
SELECT x.conv_id, CAST(x.d AS BIGINT) AS depth, up.conv_id AS parent_conv_id, x.n_convs, coalesce(child.n, 0) AS n_children,
       CAST(tree.leaves AS BIGINT) AS n_leaves, CAST(tree.saved AS BIGINT) AS saved_tokens, x.ends_sha256
FROM node x JOIN tree USING (k) LEFT JOIN child USING (k) LEFT JOIN node up ON x.d > 0 AND up.k = list_slice(x.k, 1, x.d - 1)
""")
def op12_conversation_trie(spark, sf):
    return trie.prefix_trie(trie.with_shared_heads(trie.turns(table(spark, sf, "conversations"))))


def _license_twin() -> str:
    """Brute force over all blocks, with the templates as text."""
    quoted = lambda t: "'" + t.replace("'", "''") + "'"
    rules = ", ".join(f"({k}, {quoted(label)}, {quoted(text)}, {exact})" for k, (label, text, exact) in enumerate(
        [(label, text, "true") for label, text in licenses.NAMES] + [(label, text, "false") for label, text in licenses.NOTICES]))
    return rf"""
WITH low AS (SELECT 'd' AS kind, doc_id AS id, '' AS label, coalesce(text, '') AS text, false AS exact FROM documents
             UNION ALL SELECT 't', * FROM (VALUES {rules}) v(id, label, text, exact)),
w AS (SELECT kind, id, label, exact, list_filter(regexp_split_to_array(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                 '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS words FROM low),
rule AS (SELECT id AS k, label, exact, words, list_distinct(words) AS ws, len(list_distinct(words)) AS size, len(words) AS n,
                CAST(pow(2, ceil(log2(len(words)))) AS BIGINT) AS step,
                CASE WHEN exact OR len(list_distinct(words)) < {licenses.WHOLE} THEN len(list_distinct(words))
                     ELSE ceil(len(list_distinct(words)) * {licenses.NOTICE_SHARE} - 1e-9) END AS need FROM w WHERE kind = 't'),
doc AS (SELECT id AS doc_id, CAST(len(words) AS BIGINT) AS n_words, words FROM w WHERE kind = 'd'),
tok AS (SELECT doc_id, unnest(words) AS word, generate_subscripts(words, 1) - 1 AS pos FROM doc),
rw AS (SELECT k, unnest(ws) AS word FROM rule),
hit AS (SELECT DISTINCT doc_id, r.k, tok.word, pos // step AS unit FROM tok JOIN rw USING (word) JOIN rule r USING (k) WHERE NOT r.exact),
block AS (SELECT doc_id, k, word, unit AS b FROM hit UNION SELECT doc_id, k, word, unit - 1 FROM hit WHERE unit > 0),
found AS (SELECT doc_id, k, b, count(DISTINCT word) AS overlap FROM block GROUP BY ALL),
more AS (SELECT doc_id, list(DISTINCT label) AS labels, max(overlap / size) AS best FROM found JOIN rule USING (k) WHERE overlap >= need GROUP BY 1),
place AS (SELECT tok.doc_id, label, pos FROM tok JOIN doc USING (doc_id) JOIN rule ON exact AND tok.word = rule.words[1]
          WHERE list_slice(doc.words, pos + 1, pos + n) = rule.words),
base AS (SELECT doc_id, count(*) AS n_base, min(pos) AS first_word, max(pos) AS last_word, list(DISTINCT label) AS labels FROM place GROUP BY 1)
SELECT doc_id, n_words, coalesce(n_base, 0) AS n_base, CAST(first_word AS BIGINT) AS first_word, CAST(last_word AS BIGINT) AS last_word,
       array_to_string(list_sort(coalesce(base.labels, [])), ',') AS base_labels,
       array_to_string(list_sort(list_distinct(list_concat(coalesce(base.labels, []), coalesce(more.labels, [])))), ',') AS labels,
       CASE WHEN n_base > 0 THEN 1.0::DOUBLE ELSE coalesce(best, 0.0) END AS score
FROM doc LEFT JOIN base USING (doc_id) LEFT JOIN more USING (doc_id)
"""


@register("op13_licenses", _license_twin())
def op13_licenses(spark, sf):
    found = licenses.scan(table(spark, sf, "documents").select("doc_id", "text"))
    joined = lambda c: F.array_join(f"license.{c}", ",").alias(c)
    return found.select("doc_id", "license.n_words", "license.n_base", "license.first_word", "license.last_word",
                        joined("base_labels"), joined("labels"), "license.score")
