"""Registered queries of the training-data operators: opN_<name> over whole tables, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sluice.llm import common

Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Query] = {}
_SQL: dict[str, str] = {}


def _query(sql: str | None = None):
    def deco(fn: Query) -> Query:
        _QUERIES[fn.__name__] = fn
        if sql:
            _SQL[fn.__name__] = sql
        return fn
    return deco


def queries() -> dict[str, Query]:
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(_SQL)


@_query("""
WITH t AS (SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS body
           FROM documents)
SELECT doc_id, max(doc_id) OVER (PARTITION BY body) AS keep_id,
       count(*) OVER (PARTITION BY body) AS group_size,
       doc_id = max(doc_id) OVER (PARTITION BY body) AS kept,
       sha256(body) AS text_sha256
FROM t""")
def op6_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exact copies by composable fingerprints and chunkwise comparison, one row per document."""
    from sluice.llm.exact_dedup import exact_groups

    return exact_groups(common.table(spark, sf_dir, "documents")).select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


@_query("""
WITH d AS (SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+'))::BIGINT AS size,
                  md5(doc_id::VARCHAR) AS h FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size, row_number() OVER (ORDER BY (source IS NULL), source) - 1 AS k
      FROM d GROUP BY source),
w AS (SELECT *, CASE k % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS weight, 2.0::DOUBLE * source_size AS cap,
             CASE k % 3 WHEN 0 THEN 0.5 WHEN 1 THEN 0.0 ELSE -0.5 END::DOUBLE AS slope,
             (sum(source_size) OVER ())::DOUBLE * 1.5::DOUBLE AS budget FROM s),
l AS (SELECT *, (budget - coalesce(sum(cap) OVER (ORDER BY cap / weight, k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
                / (sum(weight) OVER (ORDER BY cap / weight, k ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))::DOUBLE AS level FROM w),
m AS (SELECT *, max(CASE WHEN level <= cap / weight THEN level END) OVER () AS mark FROM l),
t AS (SELECT source, source_size, slope, least(cap, coalesce(mark * weight, cap)) AS target FROM m),
c AS (SELECT d.doc_id, d.size, t.source_size, t.slope, t.target,
             coalesce(sum(d.size) OVER (PARTITION BY d.source ORDER BY d.h, d.doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS pos
      FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source),
e AS (SELECT *, greatest(0, least(size, floor(target)::BIGINT - pos)) AS a,
             greatest(0, least(size, floor(target)::BIGINT - source_size - pos)) AS b FROM c)
SELECT doc_id, size, source_size, target, (a + b)::BIGINT AS taken,
       CASE WHEN a > 0 THEN 2.0::DOUBLE * (pos / target) / ((1 - slope) + sqrt((1 - slope) * (1 - slope) + 4 * slope * (pos / target))) END AS position
FROM e""")
def op4_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words taken of each document by the mix, in the order of first training."""
    from sluice.llm.mixing import mix

    return (mix(common.table(spark, sf_dir, "documents"))
            .select("doc_id", "size", "source_size", "target", "taken", F.get("copies", F.lit(0))["position"].alias("position"))
            .orderBy(F.asc_nulls_last("position"), "doc_id"))


@_query("""
WITH l AS (SELECT doc_id, text, generate_subscripts(string_split(text, chr(10)), 1) AS i, unnest(string_split(text, chr(10))) AS line
           FROM documents WHERE text IS NOT NULL),
h AS (SELECT *, ('0x' || substr(md5(line), 1, 15))::BIGINT AS h FROM l),
r AS (SELECT *, (xor(coalesce(lag(h) OVER w, h) << 1, h) & 3) = 0 AS ends FROM h WINDOW w AS (PARTITION BY doc_id ORDER BY i)),
n AS (SELECT *, coalesce(sum(ends::INT) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS no FROM r),
c AS (SELECT doc_id, no, min(i) AS start, count(*) AS len, string_agg(line, chr(10) ORDER BY i) AS chunk FROM n GROUP BY doc_id, no),
d AS (SELECT *, row_number() OVER (PARTITION BY chunk ORDER BY doc_id, start) > 1 AND len >= 2 AS gone FROM c),
k AS (SELECT doc_id, sum(len)::BIGINT AS n_lines, sum(CASE WHEN gone THEN len ELSE 0 END)::BIGINT AS n_removed,
             coalesce(string_agg(CASE WHEN NOT gone THEN chunk END, chr(10) ORDER BY start), '') AS kept FROM d GROUP BY doc_id)
SELECT t.doc_id, coalesce(n_lines, 0) AS n_lines, coalesce(n_removed, 0) AS n_removed, sha256(kept) AS kept_sha256
FROM documents t LEFT JOIN k ON t.doc_id = k.doc_id""")
def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of each document before and after repeated chunks go, and the digest of what stays."""
    from sluice.llm.line_dedup import dedup_lines

    return (dedup_lines(common.table(spark, sf_dir, "documents"))
            .select("doc_id", "n_lines", "n_removed", F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256")))


def _license_sql() -> str:
    from sluice.llm.licenses import TEMPLATES, THRESHOLD

    rows = ", ".join("({}, '{}', '{}')".format(i, n, t.replace("'", "''")) for i, (n, t) in enumerate(TEMPLATES))
    words = "regexp_extract_all(lower({}), '[a-z0-9\\x{{80}}-\\x{{10FFFF}}]+')"
    grams = "list_distinct(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]))"
    return f"""
WITH t AS (SELECT id, license, {grams} AS g FROM (SELECT id, license, {words.format("body")} AS w FROM (VALUES {rows}) v(id, license, body))),
u AS (SELECT doc_id, generate_subscripts(string_split(text, chr(10)), 1) AS line_no, unnest(string_split(text, chr(10))) AS unit FROM documents WHERE text IS NOT NULL
      UNION ALL SELECT doc_id, 0, text FROM documents WHERE contains(text, chr(10))),
s AS (SELECT doc_id, line_no, {grams} AS g FROM (SELECT doc_id, line_no, {words.format("unit")} AS w FROM u)),
d AS (SELECT doc_id, line_no, license, len(s.g) AS n,
             2.0::DOUBLE * len(list_intersect(s.g, t.g)) / (len(s.g) + len(t.g)) AS dice
      FROM s JOIN t ON len(s.g) BETWEEN len(t.g) * 0.5 AND len(t.g) * 2)
SELECT doc_id, line_no::BIGINT AS line_no, license, max(dice) AS dice, n::BIGINT AS n_bigrams
FROM d WHERE dice >= {THRESHOLD} GROUP BY doc_id, line_no, license, n"""


@_query(_license_sql())
def op9_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licence notices in lines and whole texts of all documents."""
    from sluice.llm.licenses import scan

    return scan(common.table(spark, sf_dir, "documents"))


@_query("""
WITH c AS (SELECT conv_id // 2 AS pair_id, conv_id % 2 AS side, role, text,
                  row_number() OVER (PARTITION BY conv_id ORDER BY turn, role, text) AS i FROM conversations),
a AS (SELECT * FROM c WHERE side = 0), b AS (SELECT * FROM c WHERE side = 1),
z AS (SELECT coalesce(a.pair_id, b.pair_id) AS pair_id, coalesce(a.i, b.i) AS i,
             a.role IS NOT DISTINCT FROM b.role AND a.text IS NOT DISTINCT FROM b.text AND a.i IS NOT NULL AND b.i IS NOT NULL AS same
      FROM a FULL JOIN b ON a.pair_id = b.pair_id AND a.i = b.i),
p AS (SELECT pair_id, coalesce(min(CASE WHEN NOT same THEN i END) - 1, max(i)) AS p FROM z GROUP BY pair_id),
r AS (SELECT c.pair_id, c.side, c.i, p.p, '<|im_start|>' || role || chr(10) || text || '<|im_end|>' || chr(10) AS turn,
             role = 'assistant' AS trained, 13 + length(role) AS head FROM c JOIN p ON c.pair_id = p.pair_id),
o AS (SELECT *, coalesce(sum(length(turn)) FILTER (WHERE i > p) OVER (PARTITION BY pair_id, side ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS off FROM r),
g AS (SELECT pair_id, any_value(p) AS p,
             coalesce(string_agg(CASE WHEN side = 0 AND i <= p THEN turn END, '' ORDER BY i), '') AS prompt,
             coalesce(string_agg(CASE WHEN side = 0 AND i > p THEN turn END, '' ORDER BY i), '') AS chosen,
             coalesce(string_agg(CASE WHEN side = 1 AND i > p THEN turn END, '' ORDER BY i), '') AS rejected,
             coalesce(string_agg(CASE WHEN side = 0 AND i > p AND trained THEN (off + head)::BIGINT || '-' || (off + length(turn))::BIGINT END, ',' ORDER BY i), '') AS chosen_mask,
             coalesce(string_agg(CASE WHEN side = 1 AND i > p AND trained THEN (off + head)::BIGINT || '-' || (off + length(turn))::BIGINT END, ',' ORDER BY i), '') AS rejected_mask
      FROM o GROUP BY pair_id)
SELECT pair_id, p::BIGINT AS prompt_turns, prompt, chosen, rejected, chosen_mask, rejected_mask,
       chosen_mask <> '' AND rejected_mask <> '' AS usable FROM g""")
def op10_preference_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversations 2k (chosen) and 2k + 1 (rejected) as preference examples.  The table names no
    preferences, so neighbours stand for them; a conversation without a partner has an empty other side."""
    from sluice.llm.chat import preference_pairs

    conversations = common.table(spark, sf_dir, "conversations")
    number = F.col("conv_id")
    pairs = (conversations.filter(number.isNotNull()).groupBy(F.shiftright(number, 1).alias("pair_id"))
             .agg(F.min(F.when(F.pmod(number, F.lit(2)) == 0, number)).alias("chosen_id"),
                  F.min(F.when(F.pmod(number, F.lit(2)) == 1, number)).alias("rejected_id")))
    mask = lambda c: F.array_join(F.transform(c, lambda s: F.concat(s["start"].cast("string"), F.lit("-"), s["end"].cast("string"))), ",")
    return preference_pairs(conversations, pairs).select(
        "pair_id", "prompt_turns", "prompt", "chosen", "rejected",
        mask("chosen_spans").alias("chosen_mask"), mask("rejected_spans").alias("rejected_mask"), "usable")


@_query("""
WITH w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
s AS (SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
             ELSE list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))) END AS s FROM w),
e AS (SELECT doc_id, len(s) AS n, unnest(s) AS g FROM s),
c AS (SELECT g FROM e GROUP BY g HAVING count(*) > 1),
f AS (SELECT e.* FROM e JOIN c USING (g)),
p AS (SELECT a.doc_id AS u, b.doc_id AS v, any_value(a.n) AS nu, any_value(b.n) AS nv, count(*) AS k
      FROM f a JOIN f b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY 1, 2),
k AS (SELECT u, v FROM p WHERE 100 * k >= 75 * (nu + nv - k)),
z AS (SELECT u, v FROM k UNION SELECT v, u FROM k),
r AS (WITH RECURSIVE r(id, m) AS (SELECT doc_id, doc_id FROM documents UNION SELECT z.v, r.m FROM r JOIN z ON z.u = r.id WHERE r.m < z.v)
      SELECT id, min(m) AS m FROM r GROUP BY id)
SELECT s.doc_id, len(s)::BIGINT AS n_shingles, r.m AS component_id, s.doc_id = r.m AS kept FROM s JOIN r ON r.id = s.doc_id""")
def op3_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate components of all documents."""
    from sluice.llm.near_dedup import near_duplicates

    return near_duplicates(common.table(spark, sf_dir, "documents"))


@_query()
def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document, by a model of the documents outside the held-out fold."""
    from sluice.llm.language_id import fit, held_out, predict

    docs = common.table(spark, sf_dir, "documents")
    return predict(docs, fit(docs)).select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score", "rejected")


@_query()
def op1_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark items found in documents, one row per document and item."""
    from sluice.llm.decontaminate import with_matches

    found = with_matches(common.table(spark, sf_dir, "documents"), common.table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", F.explode("matches").alias("m")).select("doc_id", "m.*")


@_query()
def op7_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What repeated strings of 200 bytes take from each document."""
    from sluice.llm.suffix_dedup import remove_repeats

    return remove_repeats(common.table(spark, sf_dir, "documents")).select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


@_query()
def op5_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate passages of fifty words or more, each with the first occurrence it repeats."""
    from sluice.llm.substring_dedup import near_duplicate_passages

    return near_duplicate_passages(common.table(spark, sf_dir, "documents"))


def _merkle_sql(levels: int = 8) -> str:
    """Eight levels a tree (16 million leaves a language), then as many over the languages."""
    field = "CASE WHEN {0} IS NULL THEN '-' ELSE octet_length(encode({0}::VARCHAR)) || ':' || {0}::VARCHAR END"
    leaf = lambda text: "sha256(concat({}))".format(", ".join(field.format(c) for c in ("doc_id", "source", "lang", "n_chars", text)))
    parts = [f"""
crc AS (SELECT doc_id AS id, xor(list_reduce(list_prepend(4294967295::BIGINT, flatten(list_transform(string_split(doc_id::VARCHAR, ''),
               lambda c: [ascii(c)::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1]))),
               lambda x, y: CASE WHEN y >= 0 THEN xor(x, y) WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END), 4294967295) % 3 = 0 AS hit
        FROM (SELECT DISTINCT doc_id FROM documents WHERE doc_id IS NOT NULL)),
d AS (SELECT doc_id, lang, {leaf("text")} AS leaf,
             CASE WHEN hit THEN {leaf("translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")} END AS other
      FROM documents LEFT JOIN crc ON doc_id = id),
p0 AS (SELECT doc_id, lang, leaf, coalesce(other, leaf) AS fold, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i, '' AS proof FROM d),
n0 AS (SELECT lang, i, leaf AS h FROM p0)"""]

    def climb(n: str, p: str, group: str, same: str, k: int) -> str:
        return f"""
{n}{k + 1} AS (SELECT {group}, i // 8 AS i, CASE WHEN any_value(c) = 1 THEN any_value(h) ELSE sha256(string_agg(h, '' ORDER BY i)) END AS h
        FROM (SELECT *, count(*) OVER (PARTITION BY {group}) AS c FROM {n}{k}) GROUP BY {group}, i // 8),
{n}w{k} AS (SELECT a.*, coalesce(string_agg(a.h, '') OVER (PARTITION BY {group}, i // 8 ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS before,
               coalesce(string_agg(a.h, '') OVER (PARTITION BY {group}, i // 8 ORDER BY i ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS after,
               count(*) OVER (PARTITION BY {group}) AS c FROM {n}{k} a),
{p}{k + 1} AS (SELECT p.* EXCLUDE (fold, i, proof), CASE WHEN c = 1 THEN fold ELSE sha256(before || fold || after) END AS fold, p.i // 8 AS i,
               proof || before || after AS proof FROM {p}{k} p JOIN {n}w{k} w ON {same} AND p.i = w.i)"""

    parts += [climb("n", "p", "lang", "p.lang IS NOT DISTINCT FROM w.lang", k) for k in range(levels)]
    parts.append(f"""
s AS (SELECT lang, h AS subroot, row_number() OVER (ORDER BY encode(lang) NULLS FIRST) - 1 AS i FROM n{levels}),
m0 AS (SELECT 0 AS g, i, subroot AS h FROM s),
q0 AS (SELECT doc_id, leaf, subroot, fold, s.i, proof, 0 AS g FROM p{levels} p JOIN s ON p.lang IS NOT DISTINCT FROM s.lang)""")
    parts += [climb("m", "q", "g", "p.g = w.g", k) for k in range(levels)]
    return "WITH " + ",".join(parts) + f"""
SELECT doc_id, leaf, subroot, h AS root, sha256(proof) AS proof_sha256, fold AS folded_root, fold = h AS verified
FROM q{levels}, m{levels}"""


@_query(_merkle_sql())
def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Merkle manifest of all documents by language, and what every proof says of a row of which some are tampered."""
    from sluice.llm.merkle import fold, leaf_digest, proof_digest, prove

    docs = common.table(spark, sf_dir, "documents")
    leaf = lambda text: leaf_digest([F.col(c) for c in ("doc_id", "source", "lang", "n_chars")] + [text])
    tampered = F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0, leaf(common.lower_az(F.col("text"))))
    rows = docs.select("doc_id", "lang", leaf(F.col("text")).alias("leaf"), tampered.alias("tampered"))
    proved = prove(rows, "lang", "doc_id", carry=["doc_id", "leaf", "tampered"])
    checked = proved.withColumn("folded_root", fold(F.coalesce("tampered", "leaf"), F.col("proof")))
    return checked.select("doc_id", "leaf", "subroot", "root", proof_digest(F.col("proof")).alias("proof_sha256"),
                          "folded_root", (F.col("folded_root") == F.col("root")).alias("verified"))


@_query("""
WITH v AS (SELECT vec_id, row_number() OVER () AS r, list_transform(embedding, lambda x: floor(x::DOUBLE * 1024)) AS v FROM embeddings
           WHERE embedding IS NOT NULL AND coalesce(list_bool_and(list_transform(embedding, lambda x: x IS NOT NULL AND isfinite(x))), TRUE)),
s AS (SELECT a.vec_id AS query_id, a.r, b.vec_id, list_inner_product(a.v, b.v)::BIGINT AS score
      FROM v a JOIN v b ON a.r <> b.r AND len(a.v) = len(b.v) WHERE a.vec_id % 100 = 0),
k AS (SELECT *, row_number() OVER (PARTITION BY r ORDER BY score DESC, vec_id NULLS LAST) AS n FROM s)
SELECT query_id, n::INTEGER AS rank, vec_id, score FROM k WHERE n <= 10""")
def op12_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten nearest vectors, by integer inner product, of every vector whose id 100 divides."""
    from sluice.llm.top_k import finite, to_integers, top_k

    embeddings = common.table(spark, sf_dir, "embeddings").filter(finite(F.col("embedding")))
    rows = embeddings.select("vec_id", to_integers(F.col("embedding")).alias("v"))
    return top_k(rows, "vec_id", "v", F.col("vec_id") % 100 == 0)


@_query()
def op13_tokenizer_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How two tokenizers' tokens of every document group and link, and how common the links are."""
    from sluice.llm.align import alignment

    return alignment(common.table(spark, sf_dir, "documents"), keep_groups=False).select(
        F.col("id").alias("doc_id"), "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")
