"""The registered queries of the training-data operators: thin calls over whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sftlake.llm import (
    block_labeller,
    decontaminate,
    fim,
    jaccard_join,
    langid,
    line_dedup,
    merkle,
    minhash,
    packing,
    pu_quality,
    quality_rules,
    substring_dedup,
    url_rules,
)
from sftlake.llm.common import fold, read


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def op1_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    seen = fold("doc_id", 3) != 1
    model = pu_quality.fit(docs.where(seen), read(spark, sf_dir, "labels").where(seen))
    out = pu_quality.score(docs, model).withColumnRenamed("quality_score", "score")
    return out.select("doc_id", (~seen).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.pack(read(spark, sf_dir, "documents"), tokenizer_path())
    return pieces.withColumn("ids_crc32", F.crc32("ids")).drop("ids")


def op3_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return block_labeller.extract(read(spark, sf_dir, "pages")).withColumn("n_chars", F.length("text").cast("long"))


def op4_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.join_classes(read(spark, sf_dir, "documents"))


def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    return decontaminate.find_leaks(docs, read(spark, sf_dir, "benchmark")).selectExpr("doc_id", "inline(leaks)")


def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    held = fold("doc_id", 5) == 0
    out = langid.identify(docs, langid.fit(docs.where(~held)))
    return out.select("doc_id", held.alias("held_out"), "lang_pred", "score", "bits_per_byte")


def op7_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = read(spark, sf_dir, "pages").select("page_id", "url")
    out = url_rules.url_filter(pages, url_rules.SITE_RULES + url_rules.PATTERNS)
    return out.select("page_id", "host", "path", "rule", "verdict", "pattern")


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    rules = quality_rules.fit(docs, read(spark, sf_dir, "labels"))
    return quality_rules.quality_rules(docs, rules).select("doc_id", *quality_rules.BASE, "base_failed", "kept", "rule")


def op9_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = substring_dedup.remove_repeats(read(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = line_dedup.dedup_lines(read(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", "n_lines", "n_removed", F.sha2("text", 256).alias("kept_sha256"))


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    more = F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0, F.col("n_chars") + 1).otherwise(F.col("n_chars"))
    claim = merkle.leaf_digest(F.col("doc_id"), F.col("source"), F.col("lang"), more, F.col("text"))
    out = merkle.manifest(docs, claim=claim)
    out = out.select("doc_id", "leaf", "subroot", "root", merkle.proof_digest(F.col("proof")).alias("proof_sha256"), merkle.fold(F.col("claim"), F.col("proof")).alias("folded_root"))
    return out.withColumn("verified", F.col("folded_root") == F.col("root"))


def op12_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(read(spark, sf_dir, "documents"))


def op13_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = fim.restore(fim.arrange(read(spark, sf_dir, "documents").select("doc_id", "text")))
    return out.select("doc_id", F.col("n_units").alias("n"), "form", "prefix_chars", "middle_chars", "output_sha256", "restored_sha256")


QUERIES = {
    f.__name__: f
    for f in (
        op1_quality_classifier,
        op2_packing,
        op3_html_extraction,
        op4_ngram_jaccard_join,
        op5_decontamination,
        op6_language_id,
        op7_url_filter,
        op8_quality_rules,
        op9_substring_dedup,
        op10_line_dedup,
        op11_merkle_manifest,
        op12_minhash,
        op13_fill_in_middle,
    )
}

_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_SITES = ", ".join(f"('{r.name}', '{r.regex}', '{r.verdict}', {k})" for k, r in enumerate(url_rules.SITE_RULES))
_PATTERNS = ", ".join(f"('{r.name}', '{r.regex}', '{r.verdict}', {k})" for k, r in enumerate(url_rules.PATTERNS))

_WORDS = r"regexp_extract_all({}, '[^\x20\x09-\x0D]+')"

_LINKED = """
WITH RECURSIVE w AS (
  SELECT doc_id, @@W@@ AS w FROM documents
), s AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) >= 5 THEN list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i+4], ' '))
    WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS g FROM w
), n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
i AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS i FROM s a JOIN s b USING (g) WHERE a.doc_id <> b.doc_id GROUP BY ALL),
e AS (SELECT x, y FROM i JOIN n p ON p.doc_id = x JOIN n q ON q.doc_id = y WHERE 100 * i >= {percent} * (p.n + q.n - i)),
r AS (SELECT x, y FROM e UNION SELECT r.x, e.y FROM r JOIN e ON r.y = e.x)
SELECT w.doc_id, coalesce(n.n, 0) AS n_shingles, least(w.doc_id, coalesce(min(y), w.doc_id)) AS component_id{more}
FROM w LEFT JOIN n USING (doc_id) LEFT JOIN r ON r.x = w.doc_id GROUP BY w.doc_id, n.n""".replace("@@W@@", _WORDS.format("coalesce(" + _LOWER.format("text") + ", '')"))

ORACLE = {
    "op4_ngram_jaccard_join": _LINKED.format(percent=75, more=""),
    "op9_substring_dedup": f"""
WITH w AS (SELECT doc_id, {_WORDS.format("coalesce(text, '')")} AS w FROM documents),
p AS (SELECT doc_id, i, array_to_string(w[i:i+34], ' ') AS g FROM (SELECT doc_id, w, unnest(range(1, len(w) - 33)) AS i FROM w)),
r AS (SELECT doc_id, i FROM p WHERE g IN (SELECT g FROM p GROUP BY g HAVING count(*) > 1)),
c AS (SELECT DISTINCT doc_id, i + o AS j FROM r, range(35) t(o)),
t AS (SELECT doc_id, unnest(w) AS x, unnest(range(1, len(w) + 1)) AS j FROM w),
k AS (SELECT t.doc_id, count(c.j) AS n_removed, string_agg(x, ' ' ORDER BY t.j) FILTER (WHERE c.j IS NULL) AS kept
  FROM t LEFT JOIN c ON c.doc_id = t.doc_id AND c.j = t.j GROUP BY t.doc_id)
SELECT w.doc_id, len(w)::BIGINT AS n_words, coalesce(n_removed, 0) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM w LEFT JOIN k USING (doc_id)""",
    "op7_url_filter": f"""
WITH parts AS (
  SELECT page_id, row_number() OVER () AS rid,
    CASE WHEN url LIKE '%://%' THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages
), cut AS (
  SELECT rid, page_id, regexp_extract(rest, '^[^/?#]*') AS h, rest FROM parts
), u AS (
  SELECT rid, page_id, {_LOWER.format("h")} AS host, regexp_extract(substr(rest, length(h) + 1), '^[^?#]*') AS path FROM cut
), site AS (
  SELECT rid, arg_max(name, length(name) * 1000 - k) AS rule, arg_max(verdict, length(name) * 1000 - k) AS verdict
  FROM u, (VALUES {_SITES}) AS r(name, regex, verdict, k) WHERE regexp_matches(host || path, regex) GROUP BY rid
), pat AS (
  SELECT rid, arg_min(name, k) AS pattern, arg_min(verdict, k) AS verdict
  FROM u, (VALUES {_PATTERNS}) AS r(name, regex, verdict, k) WHERE regexp_matches(host || path, regex) GROUP BY rid
)
SELECT page_id, host, path, rule, coalesce(site.verdict, pat.verdict, 'allow') AS verdict,
  CASE WHEN rule IS NULL THEN pattern END AS pattern
FROM u LEFT JOIN site USING (rid) LEFT JOIN pat USING (rid)""",
    "op11_merkle_manifest": """
WITH RECURSIVE tab AS (
  SELECT list(list_reduce(list_concat([i], range(8)), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) ORDER BY i) AS tab FROM range(256) t(i)
), docs AS (
  SELECT *, row_number() OVER () AS r, xor(list_reduce(list_concat([4294967295], list_transform(string_split(doc_id::VARCHAR, ''), lambda x: ord(x)::BIGINT)),
    lambda c, b: xor(c >> 8, tab[(xor(c, b) & 255) + 1])), 4294967295) AS crc FROM documents, tab
), f AS (
  SELECT r, doc_id, lang, coalesce(strlen(doc_id::VARCHAR) || ':' || doc_id, '-') || coalesce(strlen(source) || ':' || source, '-') || coalesce(strlen(lang) || ':' || lang, '-') AS head,
    coalesce(strlen(n_chars::VARCHAR) || ':' || n_chars, '-') AS n, coalesce(strlen((n_chars + 1)::VARCHAR) || ':' || (n_chars + 1), '-') AS more,
    coalesce(strlen(text) || ':' || text, '-') AS tail, coalesce(crc % 7 = 0, false) AS tampered FROM docs
), leaf AS (
  SELECT r, doc_id, coalesce('=' || lang, '') AS g, sha256(head || n || tail) AS leaf, sha256(head || CASE WHEN tampered THEN more ELSE n END || tail) AS claim FROM f
), placed AS (
  SELECT *, row_number() OVER (PARTITION BY g ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i, count(*) OVER (PARTITION BY g) AS n FROM leaf
), t AS (
  SELECT g, 0 AS lvl, i, leaf AS d, n FROM placed
  UNION ALL SELECT g, lvl + 1, i // 2, sha256(string_agg(d, '' ORDER BY i)), (any_value(n) + 1) // 2 FROM t WHERE n > 1 GROUP BY g, lvl, i // 2
), sub AS (
  SELECT g, d, row_number() OVER (ORDER BY g) - 1 AS i, count(*) OVER () AS n FROM t WHERE n = 1
), u AS (
  SELECT 0 AS lvl, i, d, n FROM sub
  UNION ALL SELECT lvl + 1, i // 2, sha256(string_agg(d, '' ORDER BY i)), (any_value(n) + 1) // 2 FROM u WHERE n > 1 GROUP BY lvl, i // 2
), step AS (
  SELECT a.r, 0 AS stage, t.lvl, t.i, s.d FROM placed a JOIN t ON t.g = a.g AND t.i = a.i >> t.lvl AND t.n > 1 LEFT JOIN t s ON s.g = t.g AND s.lvl = t.lvl AND s.i = xor(t.i, 1)
  UNION ALL SELECT a.r, 1, u.lvl, u.i, s.d FROM placed a JOIN sub ON sub.g = a.g JOIN u ON u.i = sub.i >> u.lvl AND u.n > 1 LEFT JOIN u s ON s.lvl = u.lvl AND s.i = xor(u.i, 1)
), proof AS (
  SELECT r, list(CASE WHEN d IS NULL THEN 'N' WHEN i % 2 = 1 THEN 'L' || d ELSE 'R' || d END ORDER BY stage, lvl) AS p, string_agg(d, '' ORDER BY stage, lvl) AS siblings FROM step GROUP BY r
), out AS (
  SELECT a.doc_id, a.leaf, sub.d AS subroot, (SELECT d FROM u WHERE n = 1) AS root, sha256(coalesce(siblings, '')) AS proof_sha256,
    list_reduce(list_concat([claim], coalesce(p, [])), lambda h, s: sha256(CASE s[1] WHEN 'L' THEN s[2:] || h WHEN 'R' THEN h || s[2:] ELSE h END)) AS folded_root
  FROM placed a JOIN sub USING (g) LEFT JOIN proof USING (r)
) SELECT *, folded_root = root AS verified FROM out""",
    "op12_minhash": _LINKED.format(percent=85, more=", doc_id = component_id AS kept"),
    "op13_fill_in_middle": r"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\n]*\n|[^\n]+') AS l, sha256('7:' || coalesce(doc_id::VARCHAR, '')) AS h FROM documents
), c AS (
  SELECT *, len(l) AS n, ('0x' || h[1:8])::BIGINT % (len(l) + 1) AS a, ('0x' || h[9:16])::BIGINT % (len(l) + 1) AS b,
    CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR ('0x' || h[17:24])::BIGINT % 100 >= 100 THEN 'plain'
      WHEN ('0x' || h[25:32])::BIGINT % 100 < 50 THEN 'spm' ELSE 'psm' END AS form FROM d
), p AS (
  SELECT *, array_to_string(l[1:least(a, b)], '') AS pre, array_to_string(l[least(a, b) + 1:greatest(a, b)], '') AS mid, array_to_string(l[greatest(a, b) + 1:], '') AS suf FROM c
)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(pre) END AS prefix_chars, CASE WHEN form <> 'plain' THEN length(mid) END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || pre || '<S>' || suf || '<M>' || mid ELSE '<S>' || suf || '<P>' || pre || '<M>' || mid END) AS output_sha256,
  sha256(t) AS restored_sha256
FROM p""",
}
