"""The registered queries ``opN_<name>`` and their DuckDB SQL.

Each query applies its operator, with production parameters, to the whole
table and derives the digest columns from the operator's output.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from neoflow.plans.tables import table

QUERIES: dict = {}
ORACLES: dict[str, str] = {}

#: A-Z to a-z only, as DuckDB SQL.
_LOW = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def register(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn
    return deco


@register("op3_exact_dedup", f"""
SELECT doc_id, max(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
       doc_id = max(doc_id) OVER g AS kept, sha256(t) AS text_sha256
FROM (SELECT doc_id, {_LOW} AS t FROM documents) WINDOW g AS (PARTITION BY t)
""")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    from neoflow.llm.exact_dedup import exact_dedup
    return exact_dedup(table(spark, sf_dir, "documents")).select(
        "doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("sha")).alias("text_sha256"))


@register("op10_quality")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    from neoflow.llm.quality import score_quality
    return score_quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@register("op1_toxicity")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    from neoflow.llm.toxicity import score_toxicity
    return score_toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


_WORDS_SQL = f"regexp_extract_all({_LOW}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"


@register("op4_decontaminate", f"""
WITH d AS (SELECT doc_id, w, len(w) AS n FROM (SELECT doc_id, {_WORDS_SQL} AS w FROM documents)),
b AS (SELECT item_id, w, least(13, len(w)) AS k
      FROM (SELECT item_id, {_WORDS_SQL} AS w FROM benchmark) WHERE len(w) > 0),
bw AS (SELECT DISTINCT item_id, k, array_to_string(w[i:i + k - 1], ' ') AS g
       FROM (SELECT item_id, k, w, unnest(range(1, len(w) - k + 2)) AS i FROM b)),
dw AS (SELECT doc_id, k, i, array_to_string(w[i:i + k - 1], ' ') AS g
       FROM (SELECT doc_id, w, k, unnest(range(1, n - k + 2)) AS i
             FROM d CROSS JOIN (SELECT DISTINCT k FROM b))),
hit AS (SELECT doc_id, item_id, i, k FROM dw JOIN bw USING (k, g)),
pos AS (SELECT doc_id, count(DISTINCT p) AS n_hit
        FROM (SELECT doc_id, unnest(range(i, i + k)) AS p FROM hit) GROUP BY doc_id),
items AS (SELECT doc_id, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS ids
          FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item_id FROM hit) GROUP BY doc_id)
SELECT doc_id, n AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= n AS contaminated
FROM d LEFT JOIN pos USING (doc_id) LEFT JOIN items USING (doc_id)
""")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    from neoflow.llm.decontaminate import contaminated, decontaminate
    return decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        contaminated().alias("contaminated"))


@register("op2_packing")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    from neoflow.llm.packing import packed_pieces
    return packed_pieces(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def _joined(spans):
    """kind:start:end of each span, comma-joined, as they are ordered."""
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"], x["end"])), ",")


@register("op8_secret_scan")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    from neoflow.llm.secret_scan import scan
    found = scan(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.tiktoken"))
    n = lambda kind: F.size(F.filter("found", lambda x: x["kind"] == kind)).cast("long")
    base = F.filter("found", lambda x: x["kind"] != "random")
    return found.select("doc_id", n("assign").alias("n_assign"), n("access").alias("n_access"),
                        n("hex").alias("n_hex"), F.sha2(_joined(base), 256).alias("base_sha256"),
                        _joined(F.col("found")).alias("spans"))


_ESC = "replace(replace(replace({}, '&', '&amp;'), '<', '&lt;'), '[', '&lbrack;')"


@register("op5_chat", f"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]')
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), ''))
         AS loss_sha256,
       sum(3 + length(replace({_ESC.format('role')}, chr(10), '&break;')) + 1 + length({_ESC.format('text')}) + 5
           )::BIGINT AS formatted_chars
FROM t GROUP BY conv_id
""")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    from neoflow.llm.chat import conversation_digests, events_of_turns, reconstruct, render
    said = "</s>[INST] ok [/INST]"
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    turns = turns.unionByName(spark.createDataFrame(
        [(-7, 0, "user", said), (-7, 1, "assistant", said)], turns.schema))
    return conversation_digests(render(reconstruct(events_of_turns(turns))))


@register("op9_jaccard_join", f"""
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all({_LOW}, '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, array_to_string(w[i:i + 2], ' ') AS g
      FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 1, least(len(w), 1) + 1))) AS i FROM w)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS shared FROM s a JOIN s b USING (g) GROUP BY 1, 2),
l AS (SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b
      WHERE 100 * shared >= 90 * (x.n + y.n - shared)),
r AS (SELECT doc_id AS a, doc_id AS c FROM documents UNION SELECT r.a, l.b FROM r JOIN l ON l.a = r.c)
SELECT doc_id, coalesce(n, 0) AS n_shingles, component_id
FROM (SELECT a AS doc_id, min(c) AS component_id FROM r GROUP BY a) LEFT JOIN n USING (doc_id)
""")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    from neoflow.llm.jaccard_join import component_ids
    return component_ids(table(spark, sf_dir, "documents"))


@register("op7_suffix_dedup")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    from neoflow.llm.suffix_dedup import remove_repeats
    length = F.transform("spans", lambda x: x["end"] - x["start"])
    return remove_repeats(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_bytes", F.aggregate(length, F.lit(0).cast("long"), lambda a, x: a + x).alias("n_removed"),
        F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


@register("op6_licenses")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    from neoflow.llm.licenses import scan_licenses
    found = scan_licenses(table(spark, sf_dir, "documents"))
    families = F.array_sort(F.array_distinct(F.col("found.family")))
    return found.select("doc_id", "n_paragraphs", F.size("found").cast("long").alias("n_licensed"),
                        F.array_join(families, ",").alias("families"),
                        F.round(F.array_max("found.chance"), 3).alias("best_chance"),
                        F.array_join(F.transform("found", lambda x: F.concat_ws(
                            ":", x["family"], x["start"], x["end"])), ",").alias("spans"))


#: A field of a leaf: its length in UTF-8 bytes and its text, or a dash.
_FIELD = "coalesce(octet_length(encode({0}::VARCHAR)) || ':' || {0}::VARCHAR, '-')"
_LEAF = "sha256(" + " || ".join(_FIELD.format(c) for c in ("doc_id", "source", "lang", "n_chars")) + " || {})"
_CHANGED = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


#: CRC-32 of the decimal doc_id, bit by bit.
_CRC = ("xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(doc_id::VARCHAR, ''), "
        "lambda ch: ascii(ch)::BIGINT)), lambda c, b: list_reduce(list_prepend(xor(c, b), range(8)), "
        "lambda x, k: CASE WHEN x % 2 = 1 THEN xor(x // 2, 3988292384) ELSE x // 2 END)))")


def _tree_sql(name: str, leaves: str) -> str:
    """Levels of the trees of ``leaves(g, i, n, h)`` as ``name(g, lvl, i, n, h)``, and ``name_s``: each node with
    the siblings left and right of it."""
    return f"""
{name} AS (SELECT g, 0 AS lvl, i, n, h FROM {leaves}
  UNION ALL
  SELECT g, lvl + 1, i // 8, (n + 7) // 8, sha256(string_agg(h, '' ORDER BY i))
  FROM {name} WHERE n > 1 GROUP BY g, lvl, i // 8, n),
{name}_s AS (SELECT a.g, a.lvl, a.i, a.n,
    coalesce(string_agg(b.h, '' ORDER BY b.i) FILTER (b.i < a.i), '') AS l,
    coalesce(string_agg(b.h, '' ORDER BY b.i) FILTER (b.i > a.i), '') AS r
  FROM {name} a JOIN {name} b ON a.g = b.g AND a.lvl = b.lvl AND a.i // 8 = b.i // 8
  WHERE a.n > 1 GROUP BY a.g, a.lvl, a.i, a.n)"""


@register("op13_merkle", f"""
WITH RECURSIVE d AS (
  SELECT doc_id, dense_rank() OVER (ORDER BY lang NULLS FIRST) - 1 AS g, {_LEAF.format(_FIELD.format("text"))} AS h,
         CASE WHEN doc_id::VARCHAR IS NOT NULL AND crc % 3 = 0 THEN {_LEAF.format(_FIELD.format("t"))} END AS given
  FROM (SELECT *, {_CHANGED} AS t, {_CRC} AS crc FROM documents)),
x AS (SELECT doc_id, g, h, coalesce(given, h) AS given,
        row_number() OVER (PARTITION BY g ORDER BY doc_id NULLS FIRST, h) - 1 AS i, count(*) OVER (PARTITION BY g) AS n FROM d),
{_tree_sql("t", "x")},
y AS (SELECT 0 AS g, t.g AS i, count(*) OVER () AS n, h FROM t WHERE t.n = 1),
{_tree_sql("u", "y")},
f AS (SELECT doc_id, g, i AS leaf_i, 0 AS lvl, n, given AS h, '' AS p FROM x
  UNION ALL
  SELECT f.doc_id, f.g, f.leaf_i, f.lvl + 1, (f.n + 7) // 8, sha256(s.l || f.h || s.r), f.p || s.l || s.r
  FROM f JOIN t_s s ON s.g = f.g AND s.lvl = f.lvl AND s.i = f.leaf_i // (8 ** f.lvl)::BIGINT WHERE f.n > 1),
v AS (SELECT doc_id, g, leaf_i, 0 AS lvl, (SELECT max(n) FROM y) AS n, h, p FROM f WHERE f.n = 1
  UNION ALL
  SELECT v.doc_id, v.g, v.leaf_i, v.lvl + 1, (v.n + 7) // 8, sha256(s.l || v.h || s.r), v.p || s.l || s.r
  FROM v JOIN u_s s ON s.g = 0 AND s.lvl = v.lvl AND s.i = v.g // (8 ** v.lvl)::BIGINT WHERE v.n > 1)
SELECT x.doc_id, x.h AS leaf, sub.h AS subroot, top.h AS root, sha256(v.p) AS proof_sha256,
       v.h AS folded_root, v.h = top.h AS verified
FROM x JOIN v ON v.g = x.g AND v.leaf_i = x.i AND v.n = 1
JOIN (SELECT g, h FROM t WHERE n = 1) sub ON sub.g = x.g CROSS JOIN (SELECT h FROM u WHERE n = 1) top
""")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    from neoflow.llm.merkle import documents_manifest, folded, proof_digest
    text = F.col("text")
    lowered = F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    changed = F.when(F.crc32(F.col("doc_id").cast("string")) % 3 == 0, lowered).otherwise(text)
    found = documents_manifest(table(spark, sf_dir, "documents"), changed)
    return found.select("doc_id", "leaf", "subroot", "root", proof_digest(F.col("proof")).alias("proof_sha256"),
                        folded(F.col("given"), F.col("proof")).alias("folded_root")
                        ).withColumn("verified", F.col("folded_root") == F.col("root"))


@register("op11_hard_negatives", """
WITH e AS (SELECT vec_id AS id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
       list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS v
  FROM embeddings WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT a.id AS a, b.id AS b, a.label = b.label AS same,
       list_sum(list_transform(list_zip(a.v, b.v), lambda z: z[1] * z[2]))::BIGINT AS score
  FROM e a JOIN e b ON a.id % 50 = 0 AND a.id <> b.id),
p AS (SELECT a, b, score FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY a ORDER BY score DESC, b) <= 5)
SELECT p.a AS anchor_id, p.b AS positive_id,
       row_number() OVER (PARTITION BY p.a, p.b ORDER BY n.score DESC, n.b)::INTEGER AS rank,
       n.b AS negative_id, p.score AS positive_score, n.score AS negative_score
FROM p JOIN s n ON n.a = p.a AND NOT n.same AND 50 * p.score <= 100 * n.score AND 100 * n.score <= 95 * p.score
QUALIFY row_number() OVER (PARTITION BY p.a, p.b ORDER BY n.score DESC, n.b) <= 3
""")
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    from neoflow.llm.hard_negatives import finite, hard_negatives, quantised
    rows = table(spark, sf_dir, "embeddings").filter(finite(F.col("embedding")))
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives(rows.select(F.col("vec_id").alias("id"), label.alias("label"),
                                      quantised(F.col("embedding")).alias("vector"),
                                      (F.col("vec_id") % 50 == 0).alias("anchor")))


def _linked_sql(words: int, num: int, more: str = "") -> str:
    """Components of documents whose sets of shingles link, from all pairs that share one."""
    return f"""
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all({_LOW}, '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, array_to_string(w[i:i + {words - 1}], ' ') AS g
      FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - {words - 2}, least(len(w), 1) + 1))) AS i FROM w)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS shared FROM s a JOIN s b USING (g) GROUP BY 1, 2),
l AS (SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b
      WHERE 100 * shared >= {num} * (x.n + y.n - shared)),
r AS (SELECT doc_id AS a, doc_id AS c FROM documents UNION SELECT r.a, l.b FROM r JOIN l ON l.a = r.c)
SELECT doc_id, coalesce(n, 0) AS n_shingles, component_id{more}
FROM (SELECT a AS doc_id, min(c) AS component_id FROM r GROUP BY a) LEFT JOIN n USING (doc_id)
"""


@register("op12_hyperminhash", _linked_sql(4, 80, ", doc_id = component_id AS kept"))
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    from neoflow.llm.hyperminhash import component_ids
    return component_ids(table(spark, sf_dir, "documents"))
