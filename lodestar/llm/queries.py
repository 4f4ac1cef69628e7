"""The operators as queries over the driver's tables, with production parameters."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestar.llm import filter_audit, hamming_topk, hpylm, langid, mixing, near_dups, packing, prefix_trie, quality_cnn, secret_scan, token_counts, unit_dedup, weak_rules
from lodestar.llm.common import read


def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, n_pretokens, n_tokens."""
    return token_counts.count_tokens(read(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


def op2_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, held_out, score, predicted."""
    return quality_cnn.classify(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def op3_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, text (what stays), n_removed, removed_chars, removed (spans)."""
    return unit_dedup.deduplicate(read(spark, sf_dir, "documents"))


def op4_weak_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept, quality."""
    judged = weak_rules.judge(read(spark, sf_dir, "documents"))
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "quality")


def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset, source: a row per piece."""
    return packing.pack(read(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op6_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score, perplexity."""
    return hpylm.score(read(spark, sf_dir, "documents"))


def op7_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """query_id, rank, neighbor_id, distance over the sign codes of the embeddings."""
    vectors = read(spark, sf_dir, "embeddings")
    return hamming_topk.top_k(vectors.select("vec_id", hamming_topk.sign_code(F.col("embedding")).alias("code")), "vec_id", "code")


def op8_near_dups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, n_shingles, component_id, kept."""
    return near_dups.classes(read(spark, sf_dir, "documents"))


def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, held_out, lang_pred, score."""
    return langid.identify(read(spark, sf_dir, "documents"))


def op10_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, source, n_tokens, epoch, block, position: a row per drawn copy."""
    return mixing.mix(read(spark, sf_dir, "documents"))


def op11_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley."""
    return filter_audit.audit(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256: a row per node."""
    return prefix_trie.conversation_trie(read(spark, sf_dir, "conversations")).drop("position", "end_position")


def op13_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, base_sha256, spans, n_novel."""
    found = secret_scan.scan(read(spark, sf_dir, "documents"))
    of = lambda kind: F.filter("spans", lambda s: s["kind"] == kind)
    base = secret_scan.as_text(F.filter("spans", lambda s: s["kind"] != "novel"))
    counts = [F.size(of(k)).cast("long").alias(f"n_{k}") for k in ("assign", "access", "hex")]
    return found.select("doc_id", *counts, F.sha2(base, 256).alias("base_sha256"), secret_scan.as_text(F.col("spans")).alias("spans"), F.size(of("novel")).cast("long").alias("n_novel"))


QUERIES = {f.__name__: f for f in (op1_token_counts, op2_quality_classifier, op3_substring_dedup, op4_weak_rules, op5_packing, op6_lm_scoring, op7_exact_topk, op8_near_dups, op9_language_id, op10_source_mixing, op11_filter_audit, op12_prefix_trie, op13_secret_scan)}
WORDS = "list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '')"
#: All pairs by brute force.  The others can't be told in SQL, or not fast enough on whole tables, and are
#: tested against plain versions.
ORACLES: dict[str, str] = {
    "op7_exact_topk": """
        WITH v AS (SELECT vec_id, list_transform(embedding[1:64], lambda x: CASE WHEN x > 0 AND NOT isnan(x) THEN 1 ELSE 0 END) AS b FROM embeddings WHERE vec_id IS NOT NULL AND embedding IS NOT NULL),
        d AS (SELECT q.vec_id AS query_id, n.vec_id AS neighbor_id, CAST(list_sum(list_transform(list_zip(q.b, n.b), lambda p: CASE WHEN p[1] <> p[2] THEN 1 ELSE 0 END)) AS INT) AS distance FROM v q JOIN v n ON q.vec_id <> n.vec_id WHERE q.vec_id % 20 = 0),
        r AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY distance, neighbor_id) AS INT) AS rank FROM d)
        SELECT query_id, rank, neighbor_id, distance FROM r WHERE rank <= 10""",
    "op8_near_dups": f"""
        WITH RECURSIVE w AS (SELECT doc_id, {WORDS} AS w FROM documents),
        s AS (SELECT doc_id, list_distinct(CASE WHEN len(w) >= 4 THEN list_transform(range(1, len(w) - 2), lambda i: array_to_string(w[i : i + 3], ' ')) WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE CAST([] AS VARCHAR[]) END) AS g FROM w),
        u AS (SELECT doc_id, len(g) AS n, unnest(g) AS x FROM s),
        k AS (SELECT a.doc_id AS a, b.doc_id AS b FROM u a JOIN u b ON a.x = b.x AND a.doc_id < b.doc_id GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 80 * (a.n + b.n - count(*))),
        e AS (SELECT a, b FROM k UNION SELECT b, a FROM k),
        c(node, root) AS (SELECT doc_id, doc_id FROM s UNION SELECT e.b, c.root FROM c JOIN e ON e.a = c.node),
        m AS (SELECT node, min(root) AS component_id FROM c GROUP BY node)
        SELECT doc_id, len(g) AS n_shingles, component_id, doc_id = component_id AS kept FROM s JOIN m ON node = doc_id""",
    "op11_filter_audit": r"""
        WITH l AS (SELECT doc_id, bool_or(coalesce(quality = 1, FALSE)) AS good, bool_or(coalesce(toxic = 1, FALSE)) AS toxic FROM labels GROUP BY doc_id),
        d AS (SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t FROM documents),
        w AS (SELECT *, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS w, min(doc_id) OVER (PARTITION BY t) AS low FROM d),
        f AS (SELECT part, coalesce(good, FALSE) AS good, coalesce(toxic, FALSE) AS toxic, [len(w) < 200, 100 * len(list_distinct(w)) < 50 * len(w), 100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 3 * length(t), regexp_matches(t, '[#$%&*|]'), coalesce(doc_id > low, FALSE)] AS fails FROM w LEFT JOIN l USING (doc_id)),
        x AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x),
        o AS (SELECT a.x || b.x || c.x || d.x || e.x AS filter_order FROM x a JOIN x b ON b.x <> a.x JOIN x c ON c.x NOT IN (a.x, b.x) JOIN x d ON d.x NOT IN (a.x, b.x, c.x) JOIN x e ON e.x NOT IN (a.x, b.x, c.x, d.x)),
        s AS (SELECT filter_order, CAST(step AS INT) AS step, filter_order[step] AS letter, list_transform(range(1, step), lambda k: ascii(filter_order[k]) - 64) AS earlier FROM o, range(1, 6) r(step)),
        r AS (SELECT part, filter_order, step, letter, good, toxic, fails[ascii(letter) - 64] AS here, list_bool_or(list_prepend(FALSE, list_transform(earlier, lambda k: fails[k]))) AS gone, len(list_filter(fails, lambda v: v)) AS n_fails FROM f, s),
        g AS (SELECT part, filter_order, step, letter, count(*) FILTER (NOT here AND NOT gone) AS kept, count(*) FILTER (here AND NOT gone) AS removed, count(*) FILTER (here AND gone) AS redundant, count(*) FILTER (here AND n_fails = 1) AS unique_fails, count(*) FILTER (here AND NOT gone AND good) AS good_lost, count(*) FILTER (here AND NOT gone AND toxic) AS toxic_lost FROM r GROUP BY ALL)
        SELECT * EXCLUDE (letter), CAST(sum(removed) OVER (PARTITION BY part, letter) AS BIGINT) AS shapley FROM g""",
    "op12_prefix_trie": """
        WITH t AS (SELECT conv_id AS c, coalesce(role, '') AS r, coalesce(text, '') AS t, turn FROM conversations WHERE conv_id IS NOT NULL),
        l AS (SELECT c, list(struct_pack(m := md5(concat(length(r), ':', r, t)), n := length(t)) ORDER BY turn NULLS FIRST, r, t) AS own FROM t GROUP BY c),
        h AS (SELECT *, CAST(xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), list_transform(str_split(CAST(c AS VARCHAR), ''), lambda d: CAST(ascii(d) AS BIGINT))), lambda crc, d: list_reduce(list_prepend(xor(crc, d), list_transform(range(8), lambda i: CAST(i AS BIGINT))), lambda x, i: xor(x >> 1, (x & 1) * CAST(3988292384 AS BIGINT)))), CAST(4294967295 AS BIGINT)) % 6 AS INT) AS h FROM l),
        b AS (SELECT h.c, list_concat(coalesce(l.own[1 : h], []), h.own[h + 1 :]) AS s FROM h LEFT JOIN l ON l.c = h.c - h.c % 100),
        p AS (SELECT c, s, d, list_transform(s[1 : d], lambda x: x.m) AS path, len(s) = d AS ends FROM b, LATERAL (SELECT unnest(range(0, len(s) + 1)) AS d)),
        n AS (SELECT d, array_to_string(path, ',') AS id, any_value(path) AS path, count(*) AS n_convs, min(c) AS conv_id, any_value(CASE WHEN d > 0 THEN s[d].n ELSE 0 END) AS chars, string_agg(CAST(c AS VARCHAR), ',' ORDER BY c) FILTER (ends) AS members FROM p GROUP BY d, id),
        q AS (SELECT *, CASE WHEN d > 0 THEN array_to_string(path[1 : d - 1], ',') END AS up FROM n),
        k AS (SELECT up, count(*) AS n_children FROM q WHERE d > 0 GROUP BY up),
        z AS (SELECT q.*, coalesce(n_children, 0) AS n_children FROM q LEFT JOIN k ON k.up = q.id),
        a AS (SELECT array_to_string(path[1 : e], ',') AS id, n_children = 0 AS leaf, (n_convs - 1) * chars AS saved FROM z, LATERAL (SELECT unnest(range(0, d + 1)) AS e)),
        g AS (SELECT id, count(*) FILTER (leaf) AS n_leaves, CAST(sum(saved) AS BIGINT) AS saved_tokens FROM a GROUP BY id)
        SELECT z.conv_id, z.d AS depth, u.conv_id AS parent_conv_id, z.n_convs, z.n_children, n_leaves, saved_tokens, sha256(coalesce(z.members, '')) AS ends_sha256 FROM z JOIN g USING (id) LEFT JOIN n u ON u.id = z.up""",
}
