"""DuckDB twins of the registered queries (the correctness oracle).

Written independently of the Spark code: window functions over whole strata where Spark
uses the two-level form, plain loops over arrays where Spark uses higher-order functions.
CTE fragments are shared between queries through the helpers below.
"""

from __future__ import annotations

# Python str.strip() whitespace, RE2 spelling (\s lacks \x0b; \p{Z} brings the Unicode spaces).
_WS = r"[\s\x0b\x1c-\x1f\x{85}\p{Z}]"


def norm(expr: str) -> str:
    return f"regexp_replace(coalesce({expr}, ''), '^{_WS}+|{_WS}+$', '', 'g')"


def kind_norm(expr: str) -> str:
    return f"coalesce(nullif({norm(expr)}, ''), 'unknown')"


A2 = """a2 AS (
  SELECT doc_id AS row_id, lang || '/' || source AS kind,
         CASE WHEN strpos(text, chr(10)) > 0 THEN substr(text, 1, strpos(text, chr(10)) - 1) ELSE text END AS input,
         CASE WHEN strpos(text, chr(10)) > 0 THEN substr(text, strpos(text, chr(10)) + 1) END AS target
  FROM documents)"""

A3 = A2 + """,
a3 AS (
  SELECT row_id,
         CASE WHEN row_id % 19 = 0 THEN NULL WHEN row_id % 17 = 0 THEN ' 　 ' ELSE kind END AS kind,
         CASE WHEN row_id % 11 = 0 THEN NULL WHEN row_id % 7 = 0 THEN '　 ' || input || ' 　' ELSE input END AS input,
         CASE WHEN row_id % 13 = 0 THEN '　' ELSE target END AS target
  FROM a2)"""


def conv(src: str, name: str) -> str:
    return f"""{name}_all AS (
  SELECT row_id, {kind_norm('kind')} AS kind, {norm('input')} AS prompt, {norm('target')} AS response FROM {src}),
{name} AS (SELECT * FROM {name}_all WHERE prompt <> '' AND response <> '')"""


def split_ctes(src: str, train: float = 0.9, val: float = 0.05, seed: int = 42) -> str:
    """sizes(kind, n, n_train, n_val, n_test) and labeled(row_id, kind, prompt, response, rn, split)."""
    return f"""c AS (SELECT kind, count(*)::BIGINT AS n FROM {src} GROUP BY kind),
s0 AS (SELECT kind, n, CAST(floor(n * {train}::DOUBLE) AS BIGINT) AS t0, CAST(floor(n * {val}::DOUBLE) AS BIGINT) AS v0 FROM c),
s1 AS (SELECT kind, n, CASE WHEN n >= 3 THEN greatest(t0, 1) ELSE t0 END AS n_train,
              CASE WHEN n >= 3 THEN greatest(v0, 1) ELSE v0 END AS v1 FROM s0),
s2 AS (SELECT kind, n, n_train,
              CASE WHEN n >= 3 AND n_train + v1 >= n THEN greatest(1, n - n_train - 1) ELSE v1 END AS n_val FROM s1),
sizes AS (SELECT kind, n, n_train, n_val, n - n_train - n_val AS n_test FROM s2),
ranked AS (
  SELECT k.*, s.n_train, s.n_val,
         row_number() OVER (PARTITION BY k.kind ORDER BY md5('{seed}:' || k.row_id::VARCHAR), k.row_id) AS rn
  FROM {src} k JOIN sizes s USING (kind)),
labeled AS (
  SELECT row_id, kind, prompt, response, rn,
         CASE WHEN rn <= n_train THEN 'train' WHEN rn <= n_train + n_val THEN 'val' ELSE 'test' END AS split
  FROM ranked)"""


def with_(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


PREP = with_(A2, conv("a2", "kept"), split_ctes("kept"))
PREP_DIRTY = with_(A3, conv("a3", "kept"), split_ctes("kept"))


# ---------------------------------------------------------------- chat / tokens

from sftlake.functions.chat import DEFAULT_SYSTEM, TOOLS_INTRO, TOOLS_OUTRO  # noqa: E402, F401  (fixed values)
from sftlake.functions.chat import IM_END as IM_E, IM_START as IM_S  # noqa: E402


def quoted(text: str) -> str:
    """Text inside a single-quoted SQL literal."""
    return text.replace("'", "''")


TOKEN_RE = r"(\p{Han}|[^\x{9}-\x{d}\x{20}\p{Han}]+)"
NL = "chr(10)"


def toks(expr: str) -> str:
    return f"regexp_extract_all(lower({expr}), '{TOKEN_RE}', 1)"


def two_turn_chat(prompt: str, response: str) -> str:
    return (
        f"'{IM_S}system' || {NL} || '{DEFAULT_SYSTEM}{IM_E}' || {NL} || '{IM_S}user' || {NL} || {prompt} || "
        f"'{IM_E}' || {NL} || '{IM_S}assistant' || {NL} || {response} || '{IM_E}' || {NL}"
    )


def generation_chat(prompt: str) -> str:
    return (
        f"'{IM_S}system' || {NL} || '{DEFAULT_SYSTEM}{IM_E}' || {NL} || '{IM_S}user' || {NL} || {prompt} || "
        f"'{IM_E}' || {NL} || '{IM_S}assistant' || {NL}"
    )


A6_RENDER = f"""firsts AS (
  SELECT conv_id, arg_min(role, turn) AS r0, arg_min(text, turn) AS t0, min(turn) AS turn0
  FROM conversations GROUP BY conv_id),
segs AS (
  SELECT c.conv_id, c.turn, c.role,
         CASE WHEN c.turn = f.turn0 AND c.role = 'system' THEN '{IM_S}system' || {NL} || c.text || '{IM_E}' || {NL}
              WHEN c.role = 'user' OR c.role = 'assistant' OR (c.role = 'system' AND c.turn <> f.turn0)
              THEN '{IM_S}' || c.role || {NL} || c.text || '{IM_E}' || {NL} ELSE '' END AS seg
  FROM conversations c JOIN firsts f USING (conv_id)),
rendered AS (
  SELECT s.conv_id,
         CASE WHEN f.r0 = 'system' THEN '' ELSE '{IM_S}system' || {NL} || '{DEFAULT_SYSTEM}{IM_E}' || {NL} END
         || string_agg(s.seg, '' ORDER BY s.turn) AS text
  FROM segs s JOIN firsts f USING (conv_id) GROUP BY s.conv_id, f.r0)"""


# Tokens of the base corpus: rendered non-English records, or the non-English documents.
BASE_TOKENS = "SELECT unnest(t) AS tok FROM rtoks WHERE kind NOT LIKE 'en/%'"
NON_ENGLISH_TOKENS = f"SELECT unnest({toks('text')}) AS tok FROM documents WHERE lang <> 'en'"


def loss(p: str) -> str:
    """A token's loss as a decimal, summed without regard to order."""
    return f"(-ln({p}))::DECIMAL(18,12)"


def scoring_ctes(
    lams: tuple[float, ...] = (0.5,),
    max_length: int = 1024,
    eval_sql: str = "kind LIKE 'en/%' AND split = 'test'",
    domain_sql: str = "kind LIKE 'en/%' AND split = 'train'",
    base_tokens_sql: str = BASE_TOKENS,
) -> str:
    """On top of PREP: per-lam model tables m_<i>(token, p_base, p_tuned), unk scalars and
    eval sums sums_<i>(texts, tokens, sb, st) for the evaluation texts. The base corpus is read
    whole, the domain and evaluation texts up to max_length tokens."""
    parts = [
        f"""rtexts AS (SELECT row_id, kind, split, {two_turn_chat('prompt', 'response')} AS text FROM labeled),
rtoks AS (SELECT row_id, kind, split, {toks('text')} AS t FROM rtexts),
base_c AS (SELECT tok AS token, count(*)::BIGINT AS n FROM ({base_tokens_sql}) GROUP BY tok),
dom_c AS (SELECT tok AS token, count(*)::BIGINT AS n FROM (SELECT unnest(t[1:{max_length}]) AS tok FROM rtoks WHERE {domain_sql}) GROUP BY tok),
bt AS (SELECT (sum(n) + count(*) + 1)::DOUBLE AS den FROM base_c),
dt AS (SELECT (sum(n) + count(*) + 1)::DOUBLE AS den FROM dom_c),
pm AS (
  SELECT coalesce(b.token, d.token) AS token,
         coalesce((b.n + 1)::DOUBLE / bt.den, 1.0 / bt.den) AS p_base,
         coalesce((d.n + 1)::DOUBLE / dt.den, 1.0 / dt.den) AS p_dom
  FROM base_c b FULL OUTER JOIN dom_c d ON b.token = d.token CROSS JOIN bt CROSS JOIN dt),
ecnt AS (SELECT tok AS token, count(*)::BIGINT AS cnt FROM (SELECT unnest(t[2:{max_length}]) AS tok FROM rtoks WHERE {eval_sql}) GROUP BY tok),
ntexts AS (SELECT count(*)::BIGINT AS texts FROM rtoks WHERE {eval_sql})"""
    ]
    for i, lam in enumerate(lams):
        parts.append(
            f"""m_{i} AS (SELECT token, p_base, {lam}::DOUBLE * p_dom + {1.0 - lam}::DOUBLE * p_base AS p_tuned FROM pm),
unk_{i} AS (SELECT 1.0 / bt.den AS ub, {lam}::DOUBLE * (1.0 / dt.den) + {1.0 - lam}::DOUBLE * (1.0 / bt.den) AS ut FROM bt CROSS JOIN dt),
sums_{i} AS (
  SELECT (SELECT texts FROM ntexts) AS texts, coalesce(sum(e.cnt), 0)::BIGINT AS tokens,
         coalesce(sum(e.cnt * {loss('coalesce(m.p_base, u.ub)')}), 0)::DOUBLE AS sb,
         coalesce(sum(e.cnt * {loss('coalesce(m.p_tuned, u.ut)')}), 0)::DOUBLE AS st
  FROM ecnt e LEFT JOIN m_{i} m USING (token) CROSS JOIN unk_{i} u),
metrics_{i} AS (
  SELECT 'base' AS model, texts AS num_texts, tokens AS num_tokens, sb / greatest(tokens, 1) AS mean_nll FROM sums_{i}
  UNION ALL
  SELECT 'tuned', texts, tokens, st / greatest(tokens, 1) FROM sums_{i}),
metrics2_{i} AS (
  SELECT *, CASE WHEN mean_nll < 20 THEN exp(mean_nll) ELSE 'Infinity'::DOUBLE END AS perplexity FROM metrics_{i}),
cmp_{i} AS (
  SELECT max(num_texts) FILTER (WHERE model = 'base') AS num_samples,
         max(mean_nll) FILTER (WHERE model = 'base') AS base_nll,
         max(mean_nll) FILTER (WHERE model = 'tuned') AS tuned_nll,
         max(perplexity) FILTER (WHERE model = 'base') AS base_ppl,
         max(perplexity) FILTER (WHERE model = 'tuned') AS tuned_ppl
  FROM metrics2_{i})"""
        )
    return ",\n".join(parts)
