"""Thin queries over the operators of this subpackage, by the names that the entry module registers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .ngram_join import ngram_join

    return ngram_join(table(spark, sf_dir, "documents"), k=4, percent=85)


def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .quality import quality

    return quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op4_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .html import extract

    return extract(table(spark, sf_dir, "pages"))


def op5_suffix_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .suffix_lm import score

    return score(table(spark, sf_dir, "documents"))


def op6_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .fingerprint import edits

    return edits(table(spark, sf_dir, "documents"))


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .toxicity import toxicity

    return toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def vocabulary(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op2_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .embedding import near_dedup

    return near_dedup(table(spark, sf_dir, "embeddings"), bound=0.98)


def op8_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .pieces import round_trip

    return round_trip(table(spark, sf_dir, "documents"), vocabulary("piece_bpe_32k.model"))


def op9_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .spans import GAP, dedup_spans

    return dedup_spans(table(spark, sf_dir, "documents"), gap=GAP)


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .packing import pack

    return pack(table(spark, sf_dir, "documents"), vocabulary("byte_bpe_50k.json"))


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .merkle import manifest

    return manifest(table(spark, sf_dir, "documents"))


def op12_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .token_counts import token_counts

    return token_counts(table(spark, sf_dir, "documents"), vocabulary("word_bpe_49k.json"))


def op13_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .fim import digests

    return digests(table(spark, sf_dir, "documents"))


QUERIES = {
    "op1_ngram_join": op1_ngram_join,
    "op2_embedding_near_dedup": op2_embedding_near_dedup,
    "op3_quality": op3_quality,
    "op4_html_extraction": op4_html_extraction,
    "op5_suffix_tree": op5_suffix_tree,
    "op6_fingerprints": op6_fingerprints,
    "op7_toxicity": op7_toxicity,
    "op8_sentencepiece": op8_sentencepiece,
    "op9_substring_dedup": op9_substring_dedup,
    "op10_packing": op10_packing,
    "op11_merkle_manifest": op11_merkle_manifest,
    "op12_token_counts": op12_token_counts,
    "op13_fill_in_middle": op13_fill_in_middle,
}

#: Exact by contract, so SQL can say them over whole tables; the others are tested against brute force.
ORACLE_SQL: dict[str, str] = {
    "op1_ngram_join": r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents
), p AS (SELECT doc_id, len(w) AS k, unnest(w) AS w, generate_subscripts(w, 1) AS i FROM w),
q AS (
  SELECT doc_id, k, i, w AS a, lead(w, 1) OVER d AS b, lead(w, 2) OVER d AS c, lead(w, 3) OVER d AS e FROM p WINDOW d AS (PARTITION BY doc_id ORDER BY i)
), t AS (SELECT DISTINCT doc_id, hash(a, b, c, e) AS t FROM q WHERE i <= greatest(k - 3, 1)),
n AS (SELECT w.doc_id, coalesce(c.n, 0) AS n FROM w LEFT JOIN (SELECT doc_id, count(*) AS n FROM t GROUP BY 1) c USING (doc_id)),
often AS (SELECT t FROM t GROUP BY t HAVING count(*) > 1),
u AS MATERIALIZED (SELECT doc_id, t FROM t SEMI JOIN often USING (t)),
both_ AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS m FROM u a JOIN u b ON a.t = b.t AND a.doc_id < b.doc_id GROUP BY 1, 2),
link AS MATERIALIZED (SELECT a, b FROM both_ JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * m >= 85 * (x.n + y.n - m)),
edge AS MATERIALIZED (SELECT a, b FROM link UNION SELECT b, a FROM link),
reach(a, b) AS (SELECT doc_id, doc_id FROM n UNION SELECT r.a, e.b FROM reach r JOIN edge e ON r.b = e.a)
SELECT n.doc_id, n.n AS n_shingles, min(reach.b) AS component_id FROM n JOIN reach ON reach.a = n.doc_id GROUP BY 1, 2
""",
    "op2_embedding_near_dedup": """
WITH RECURSIVE base AS (
  SELECT vec_id, embedding::DOUBLE[] AS v, label, row_number() OVER () AS r FROM embeddings
), usable AS (
  SELECT *, list_dot_product(v, v) AS sq FROM base
  WHERE label IS NOT NULL AND v IS NOT NULL AND len(v) > 0 AND len(list_filter(v, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(v, lambda x: x <> 0)) > 0
), link AS (
  SELECT a.r AS ar, a.vec_id AS a, b.vec_id AS b FROM usable a JOIN usable b
  ON a.label = b.label AND len(a.v) = len(b.v) AND a.r <> b.r AND list_dot_product(a.v, b.v) / sqrt(a.sq * b.sq) >= 0.98
), edge AS (SELECT DISTINCT a, b FROM link WHERE a <> b),
reach(a, b) AS (
  SELECT vec_id, vec_id FROM base UNION SELECT r.a, e.b FROM reach r JOIN edge e ON r.b = e.a
), least AS (SELECT a, min(b) AS component_id FROM reach GROUP BY a),
n AS (SELECT ar, count(*) AS n FROM link GROUP BY ar)
SELECT b.vec_id, coalesce(n.n, 0) AS n_links, l.component_id, b.vec_id = l.component_id AS kept
FROM base b LEFT JOIN n ON n.ar = b.r LEFT JOIN least l ON l.a = b.vec_id
""",
    "op11_merkle_manifest": r"""
WITH RECURSIVE f AS (
  SELECT doc_id, lang, n_chars,
    concat(coalesce(strlen(doc_id::VARCHAR) || ':' || doc_id, '-'), coalesce(strlen(source) || ':' || source, '-'), coalesce(strlen(lang) || ':' || lang, '-')) AS head,
    coalesce(strlen(text) || ':' || text, '-') AS tail,
    list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(doc_id::VARCHAR, ''), lambda x: ord(x)::BIGINT)),
      lambda c, b: list_reduce(list_prepend(xor(c, b), range(8)), lambda y, k: xor(y >> 1, 3988292384 * (y & 1)))) AS crc FROM documents
), d AS MATERIALIZED (
  SELECT row_number() OVER () AS r, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos, * FROM (
    SELECT doc_id, lang, sha256(concat(head, coalesce(strlen(n_chars::VARCHAR) || ':' || n_chars, '-'), tail)) AS leaf,
      sha256(concat(head, coalesce(strlen((n_chars + tampered)::VARCHAR) || ':' || (n_chars + tampered), '-'), tail)) AS value
    FROM (SELECT *, CASE WHEN xor(crc, 4294967295) % 7 = 0 THEN 1 ELSE 0 END AS tampered FROM f))
), low(lang, lev, i, h, m) AS (
  SELECT lang, 0, pos, leaf, count(*) OVER (PARTITION BY lang) FROM d
  UNION ALL SELECT lang, lev + 1, i // 2, sha256(string_agg(h, '' ORDER BY i)), any_value((m + 1) // 2) FROM low WHERE m > 1 GROUP BY lang, lev, i // 2
), tops AS (SELECT lang, lev AS top, h, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS g FROM low WHERE m = 1),
high(lev, i, h, m) AS (
  SELECT 0, g, h, count(*) OVER () FROM tops
  UNION ALL SELECT lev + 1, i // 2, sha256(string_agg(h, '' ORDER BY i)), any_value((m + 1) // 2) FROM high WHERE m > 1 GROUP BY lev, i // 2
), step AS MATERIALIZED (
  SELECT d.r, v.lev, (d.pos >> v.lev) & 1 AS odd, s.h FROM d JOIN tops t ON d.lang IS NOT DISTINCT FROM t.lang, LATERAL (SELECT unnest(range(t.top)) AS lev) v
  LEFT JOIN low s ON s.lang IS NOT DISTINCT FROM d.lang AND s.lev = v.lev AND s.i = xor(d.pos >> v.lev, 1)
  UNION ALL
  SELECT d.r, t.top + v.lev, (t.g >> v.lev) & 1, s.h FROM d JOIN tops t ON d.lang IS NOT DISTINCT FROM t.lang, LATERAL (SELECT unnest(range((SELECT max(lev) FROM high))) AS lev) v
  LEFT JOIN high s ON s.lev = v.lev AND s.i = xor(t.g >> v.lev, 1)
), proof AS (SELECT r, sha256(string_agg(h, '' ORDER BY lev)) AS p FROM step WHERE h IS NOT NULL GROUP BY r),
fold(r, lev, h) AS (
  SELECT r, 0, value FROM d
  UNION ALL SELECT f.r, f.lev + 1, sha256(CASE WHEN s.h IS NULL THEN f.h WHEN s.odd = 1 THEN s.h || f.h ELSE f.h || s.h END) FROM fold f JOIN step s ON s.r = f.r AND s.lev = f.lev
), last AS (SELECT r, arg_max(h, lev) AS h FROM fold GROUP BY r)
SELECT d.doc_id, d.leaf, t.h AS subroot, q.h AS root, coalesce(p.p, sha256('')) AS proof_sha256, l.h AS folded_root, l.h = q.h AS verified
FROM d JOIN tops t ON d.lang IS NOT DISTINCT FROM t.lang JOIN last l ON l.r = d.r LEFT JOIN proof p ON p.r = d.r, (SELECT h FROM high WHERE m = 1) q
""",
    "op13_fill_in_middle": r"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+') AS u, sha256('42:' || coalesce(doc_id::VARCHAR, '')) AS h FROM documents
), n AS (SELECT *, len(u) AS n, list_transform(range(4), lambda k: ('0x' || substr(h, 1 + 8 * k, 8))::BIGINT) AS s FROM d),
c AS (SELECT *, least(s[1] % (n + 1), s[2] % (n + 1)) AS i, greatest(s[1] % (n + 1), s[2] % (n + 1)) AS j,
  CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR s[3] % 100 >= 50 THEN 'plain' WHEN s[4] % 100 < 80 THEN 'spm' ELSE 'psm' END AS form FROM n),
p AS (SELECT *, array_to_string(u[:i], '') AS a, array_to_string(u[i + 1:j], '') AS m, array_to_string(u[j + 1:], '') AS b FROM c)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(a) END AS prefix_chars, CASE WHEN form <> 'plain' THEN length(m) END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN concat('<P>', a, '<S>', b, '<M>', m) ELSE concat('<S>', b, '<P>', a, '<M>', m) END) AS output_sha256, sha256(text) AS restored_sha256 FROM p
""",
}
