"""Registered queries: name -> (spark, sf_dir) -> DataFrame, and their DuckDB oracles.

Each query reads the driver's tables (through the adapters) over their whole extent.
Computed columns are aliased identically on both sides; doubles are rounded to 6 places.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sftlake.operators import records as rec
from sftlake.operators import split as spl
from sftlake.plans import oracle_sql as O
from sftlake.sources import adapters as A

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}

SEED = 42
TRAIN, VAL = 0.9, 0.05


def register(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn

    return deco


# ---------------------------------------------------------------- prepared split (shared)


def prepared(spark: SparkSession, sf_dir: str, dirty: bool = False):
    raw = A.documents_dirty(spark, sf_dir) if dirty else A.documents_raw(spark, sf_dir)
    kept = rec.convert_records(raw)
    plan = spl.plan_split(kept, TRAIN, VAL, SEED)
    split = spl.assign_splits(kept, plan, seed=SEED)
    return raw, kept, plan.sizes, split


# ---------------------------------------------------------------- normalise / convert


@register(
    "normalize_text",
    O.with_(O.A3) + f"SELECT row_id, {O.norm('input')} AS norm_input, {O.norm('target')} AS norm_target FROM a3",
)
def q_normalize_text(spark, sf_dir):
    from sftlake.functions.text import normalize_text

    a3 = A.documents_dirty(spark, sf_dir)
    return a3.select("row_id", normalize_text("input").alias("norm_input"), normalize_text("target").alias("norm_target"))


@register("kind_default", O.with_(O.A3) + f"SELECT row_id, {O.kind_norm('kind')} AS kind FROM a3")
def q_kind_default(spark, sf_dir):
    from sftlake.functions.text import kind_or_unknown

    return A.documents_dirty(spark, sf_dir).select("row_id", kind_or_unknown("kind").alias("kind"))


@register(
    "convert_records",
    O.with_(O.A3, O.conv("a3", "kept"))
    + """SELECT row_id, kind, 0::BIGINT AS pos, 'user' AS role, prompt AS content FROM kept
UNION ALL SELECT row_id, kind, 1::BIGINT AS pos, 'assistant' AS role, response AS content FROM kept""",
)
def q_convert_records(spark, sf_dir):
    kept = rec.convert_records(A.documents_dirty(spark, sf_dir))
    return kept.select("row_id", "kind", F.posexplode("messages").alias("pos", "m")).select(
        "row_id", "kind", F.col("pos").cast("long").alias("pos"), "m.role", "m.content"
    )


@register(
    "messages_only",
    O.with_(O.A2, O.conv("a2", "kept"))
    + """SELECT row_id, 0::BIGINT AS pos, 'user' AS role, prompt AS content FROM kept
UNION ALL SELECT row_id, 1::BIGINT AS pos, 'assistant' AS role, response AS content FROM kept""",
)
def q_messages_only(spark, sf_dir):
    kept = rec.convert_records(A.documents_raw(spark, sf_dir))
    ex = rec.explode_messages(rec.messages_only(kept, keep=("row_id",)), "row_id")
    return ex.withColumn("pos", F.col("pos").cast("long"))


# ---------------------------------------------------------------- split


@register("kind_counts", O.PREP + "SELECT kind, n FROM sizes")
def q_kind_counts(spark, sf_dir):
    kept = rec.convert_records(A.documents_raw(spark, sf_dir))
    return kept.groupBy("kind").agg(F.count(F.lit(1)).alias("n"))


@register("split_sizes", O.PREP + "SELECT kind, n, n_train, n_val, n_test FROM sizes")
def q_split_sizes(spark, sf_dir):
    _, _, sizes, _ = prepared(spark, sf_dir)
    return sizes.select("kind", "n", "n_train", "n_val", "n_test")


@register("stratified_split", O.PREP + "SELECT row_id, kind, split, rn::BIGINT AS stratum_rank FROM labeled")
def q_stratified_split(spark, sf_dir):
    kept = rec.convert_records(A.documents_raw(spark, sf_dir)).select("row_id", "kind")
    return spl.stratified_split(kept, TRAIN, VAL, SEED).select("row_id", "kind", "split", "stratum_rank")


@register(
    "split_order",
    O.PREP
    + f"""SELECT row_id, split, md5('{SEED}:order:' || row_id::VARCHAR) AS order_hash,
       row_number() OVER (PARTITION BY split ORDER BY md5('{SEED}:order:' || row_id::VARCHAR), row_id)::BIGINT AS order_pos
FROM labeled""",
)
def q_split_order(spark, sf_dir):
    from sftlake.sources.scratch import checkpointed

    _, _, _, split = prepared(spark, sf_dir)
    # The seeded-order rank reads its input twice (bucket totals, then the window); a narrow
    # materialised (row_id, split) projection keeps the split itself to a single run.
    narrow = checkpointed(split.select("row_id", "split"))
    o = spl.order_within_splits(narrow, seed=SEED)
    return o.select("row_id", "split", "order_hash", "order_pos")


@register(
    "split_audit",
    O.PREP
    + """SELECT kind, count(*) FILTER (WHERE split = 'train')::BIGINT AS train,
       count(*) FILTER (WHERE split = 'val')::BIGINT AS val,
       count(*) FILTER (WHERE split = 'test')::BIGINT AS test
FROM labeled GROUP BY kind""",
)
def q_split_audit(spark, sf_dir):
    _, _, _, split = prepared(spark, sf_dir)
    return spl.split_audit(split)


@register(
    "split_metadata",
    O.PREP_DIRTY
    + """SELECT (SELECT count(*) FROM a3)::BIGINT AS total_raw,
       (SELECT count(*) FROM kept)::BIGINT AS total_kept,
       (SELECT count(*) FROM a3)::BIGINT - (SELECT count(*) FROM kept)::BIGINT AS total_skipped,
       (SELECT count(*) FROM labeled WHERE split = 'train')::BIGINT AS train_size,
       (SELECT count(*) FROM labeled WHERE split = 'val')::BIGINT AS val_size,
       (SELECT count(*) FROM labeled WHERE split = 'test')::BIGINT AS test_size""",
)
def q_split_metadata(spark, sf_dir):
    raw = A.documents_dirty(spark, sf_dir)
    plan = spl.plan_split(rec.normalized(raw), TRAIN, VAL, SEED, kept="kept")
    return spl.split_metadata(plan)


@register("head_sample", O.with_(O.A2) + "SELECT row_id, kind FROM a2 ORDER BY row_id LIMIT 100")
def q_head_sample(spark, sf_dir):
    return spl.head_rows(A.documents_raw(spark, sf_dir), 100, ["row_id"]).select("row_id", "kind")


@register("head_sample_large", O.with_(O.A2) + "SELECT row_id, kind FROM a2 ORDER BY kind, row_id LIMIT (SELECT count(*) * 3 // 4 FROM a2)")
def q_head_sample_large(spark, sf_dir):
    """Three quarters of the records by (kind, id): a large head with a string key."""
    raw = A.documents_raw(spark, sf_dir).select("row_id", "kind")
    return spl.head_rows(raw, raw.count() * 3 // 4, ["kind", "row_id"])


@register(
    "raw_roundtrip",
    O.with_(
        O.A2,
        "d AS (SELECT kind, input, target, row_number() OVER (ORDER BY row_id % 7, row_id) - 1 AS row_id FROM a2)",
    )
    + "SELECT row_id::BIGINT AS row_id, kind, input, target FROM d",
)
def q_raw_roundtrip(spark, sf_dir):
    """Records written as the JSONL files of a dataset in seven folders, read back whole with dataset-order ids."""
    from sftlake.sources.jsonl import read_raw_records
    from sftlake.sources.scratch import fresh_dir

    raw = A.documents_raw(spark, sf_dir).withColumn("part", (F.col("row_id") % 7).cast("int"))
    path = fresh_dir(spark, "raw")
    # Ranges of (part, row_id), so files by name are in that order; a folder has as many as it needs.
    ordered = raw.repartitionByRange("part", "row_id").sortWithinPartitions("part", "row_id").drop("row_id")
    ordered.write.partitionBy("part").option("ignoreNullFields", "false").json(path)
    return read_raw_records(spark, path).select("row_id", "kind", "input", "target")


def typed_lines(spark, sf_dir):
    """Documents as JSON lines whose input is, by the id, a text, a missing key, an explicit null,
    a boolean, an integer, a fraction or a number with an exponent; doc_id is a number."""
    d = A.table(spark, sf_dir, "documents").select("doc_id", "lang", "text", "n_chars")
    n = F.col("n_chars").cast("string")
    case = F.col("doc_id") % 7
    field = (
        F.when(case == 0, F.concat(F.lit(', "input": '), F.expr("coalesce(substring(to_json(struct(text)), 9, length(to_json(struct(text))) - 9), 'null')")))
        .when(case == 1, F.lit(""))
        .when(case == 2, F.lit(', "input": null'))
        .when(case == 3, F.concat(F.lit(', "input": '), (F.col("n_chars") % 2 == 0).cast("string")))
        .when(case == 4, F.concat(F.lit(', "input": '), n))
        .when(case == 5, F.concat(F.lit(', "input": '), (F.col("n_chars") / 8).cast("decimal(20,3)").cast("string")))
        .otherwise(F.concat(F.lit(', "input": '), n, F.lit("e"), ((F.col("doc_id") % 41) - 20).cast("string")))
    )
    return d.select(F.concat(F.lit('{"doc_id": '), F.col("doc_id").cast("string"), field, F.lit("}")).alias("value"))


@register(
    "typed_records",
    """SELECT doc_id, doc_id % 7 <> 1 AS has_input, CASE doc_id % 7 WHEN 0 THEN text
  WHEN 3 THEN CASE WHEN n_chars % 2 = 0 THEN 'True' ELSE 'False' END WHEN 4 THEN n_chars::VARCHAR
  WHEN 5 THEN (n_chars / 8.0)::DOUBLE::VARCHAR
  WHEN 6 THEN (n_chars::VARCHAR || 'e' || (doc_id % 41 - 20)::VARCHAR)::DOUBLE::VARCHAR END AS input
FROM documents""",
)
def q_typed_records(spark, sf_dir):
    """Records with inputs of all JSON types, written as lines and read with Python's texts."""
    from sftlake.sources.jsonl import read_typed
    from sftlake.sources.scratch import fresh_dir

    path = fresh_dir(spark, "typed")
    typed_lines(spark, sf_dir).write.text(path)
    t = read_typed(spark, path, ["doc_id", "input"])
    return t.select(F.col("doc_id").cast("long").alias("doc_id"), "has_input", "input")


@register(
    "prompt_file_groups",
    """SELECT CASE doc_id % 5 WHEN 0 THEN 'unknown' WHEN 1 THEN NULL WHEN 2 THEN (doc_id % 3)::VARCHAR
  WHEN 3 THEN CASE WHEN doc_id % 2 = 0 THEN 'True' ELSE 'False' END ELSE lang END AS "group", count(*)::BIGINT AS n
FROM documents GROUP BY 1""",
)
def q_prompt_file_groups(spark, sf_dir):
    """Group counts of a prompt file whose groups are missing, null, numbers, booleans or texts."""
    from sftlake.operators.align import prompt_groups
    from sftlake.sources.jsonl import read_prompts
    from sftlake.sources.scratch import fresh_dir

    d = A.table(spark, sf_dir, "documents").select("doc_id", "lang")
    case, path = F.col("doc_id") % 5, fresh_dir(spark, "prompt-file")
    group = (
        F.when(case == 0, F.lit(""))
        .when(case == 1, F.lit(', "group": null'))
        .when(case == 2, F.concat(F.lit(', "group": '), (F.col("doc_id") % 3).cast("string")))
        .when(case == 3, F.concat(F.lit(', "group": '), (F.col("doc_id") % 2 == 0).cast("string")))
        .otherwise(F.coalesce(F.concat(F.lit(', "group": "'), F.col("lang"), F.lit('"')), F.lit(', "group": null')))
    )
    line = F.concat(F.lit('{"id": '), F.col("doc_id").cast("string"), group, F.lit(', "prompt": "p"}'))
    d.select(line.alias("value")).write.text(path)
    return prompt_groups(read_prompts(spark, path))


@register(
    "metadata_roundtrip",
    O.PREP_DIRTY
    + """SELECT 'documents' AS dataset_name, (SELECT count(*) FROM a3)::BIGINT AS total_raw, (SELECT count(*) FROM kept)::BIGINT AS total_kept,
       (SELECT count(*) FROM a3)::BIGINT - (SELECT count(*) FROM kept)::BIGINT AS total_skipped,
       (SELECT count(*) FROM labeled WHERE split = 'train')::BIGINT AS train_size,
       (SELECT count(*) FROM labeled WHERE split = 'val')::BIGINT AS val_size,
       (SELECT count(*) FROM labeled WHERE split = 'test')::BIGINT AS test_size, 42::BIGINT AS seed""",
)
def q_metadata_roundtrip(spark, sf_dir):
    """The prepare job's metadata document, read back from its file."""
    from sftlake.plans.prepare import METADATA_SCHEMA, prepare
    from sftlake.sources.jsonl import read_jsonl
    from sftlake.sources.scratch import fresh_dir

    out = fresh_dir(spark, "prepared")
    prepare(A.documents_dirty(spark, sf_dir), out, dataset_name="documents", seed=SEED)
    meta = read_jsonl(spark, f"{out}/metadata", METADATA_SCHEMA)
    return meta.select(
        "dataset_name", "total_raw", "total_kept", "total_skipped", "train_size", "val_size", "test_size", "seed"
    )


@register("metadata_observed", O.PREP_DIRTY + "SELECT split, count(*)::BIGINT AS n FROM labeled GROUP BY split")
def q_metadata_observed(spark, sf_dir):
    """Rows of each split, as observed by the tasks that write the split files."""
    from sftlake.sources.jsonl import write_splits
    from sftlake.sources.scratch import fresh_dir

    _, _, _, split = prepared(spark, sf_dir, dirty=True)
    ordered = split.withColumn("order_hash", spl.seeded_hash(SEED, "row_id", salt="order"))
    written = write_splits(ordered, fresh_dir(spark, "observed"))
    return spark.createDataFrame([(s, n) for s, n in written.items() if n], "split string, n long")


@register(
    "split_overlap_exact",
    O.PREP
    + """SELECT row_id FROM labeled WHERE split = 'test'
AND EXISTS (SELECT 1 FROM labeled t WHERE t.split = 'train' AND t.prompt = labeled.prompt AND t.response = labeled.response)""",
)
def q_split_overlap_exact(spark, sf_dir):
    """Test rows whose normalised texts also are a train row."""
    _, _, _, split = prepared(spark, sf_dir)
    return spl.exact_overlap(split, ["prompt", "response"], "test", "train").select("row_id")


@register(
    "split_overlap_near",
    O.PREP
    + """, w AS (SELECT row_id, split, regexp_extract_all(lower(prompt || chr(10) || response), '[^\\x20\\x09-\\x0D]+') AS w FROM labeled WHERE split <> 'val'),
g AS (SELECT row_id, split, list_sort(list_distinct(CASE WHEN len(w) >= 5 THEN list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i+4], ' '))
  ELSE [array_to_string(w, ' ')] END)) AS s FROM w),
reps AS (SELECT split, s, min(row_id) AS id FROM g GROUP BY split, s),
u AS (SELECT split, id, len(s) AS n, unnest(s) AS g FROM reps),
i AS (SELECT a.id AS test_id, b.id AS train_id, any_value(a.n) AS na, any_value(b.n) AS nb, count(*) AS i
  FROM u a JOIN u b USING (g) WHERE a.split = 'test' AND b.split = 'train' GROUP BY ALL)
SELECT test_id, train_id, round(i / (na + nb - i)::DOUBLE, 6) AS jaccard FROM i WHERE 100 * i >= 75 * (na + nb - i)""",
)
def q_split_overlap_near(spark, sf_dir):
    """Test texts with a near duplicate among the train texts."""
    from sftlake.operators.overlap import near_overlap

    _, _, _, split = prepared(spark, sf_dir)
    out = near_overlap(split, F.concat_ws("\n", "prompt", "response"))
    return out.select("test_id", "train_id", _r6("jaccard"))


@register(
    "split_overlap_near_members",
    ORACLE["split_overlap_near"].rpartition("SELECT test_id")[0]
    + """, n AS (SELECT test_id, train_id FROM i WHERE 100 * i >= 75 * (na + nb - i))
SELECT g.split, g.row_id, r.id AS class_id FROM g JOIN reps r ON g.split = r.split AND g.s = r.s
WHERE (r.split = 'test' AND r.id IN (SELECT test_id FROM n)) OR (r.split = 'train' AND r.id IN (SELECT train_id FROM n))""",
)
def q_split_overlap_near_members(spark, sf_dir):
    """Every test and train row of the classes that split_overlap_near pairs, with its class."""
    from sftlake.operators.overlap import near_overlap, overlap_members, shingle_rows

    _, _, _, split = prepared(spark, sf_dir)
    text = F.concat_ws("\n", "prompt", "response")
    rows = shingle_rows(split, text)
    return overlap_members(split, text, near_overlap(split, text, rows=rows), rows=rows)


@register(
    "split_overlap_links",
    ORACLE["split_overlap_near"].rpartition("SELECT test_id")[0]
    + """, n AS (SELECT test_id, train_id FROM i WHERE 100 * i >= 75 * (na + nb - i)),
m AS (SELECT g.split, g.row_id, CASE WHEN g.s = [''] THEN g.row_id ELSE r.id END AS class_id FROM g JOIN reps r ON g.split = r.split AND g.s = r.s),
z AS (SELECT split, class_id, count(*) AS copies FROM m GROUP BY ALL),
k AS (SELECT 'test' AS split, test_id AS class_id, sum(copies) AS links FROM n JOIN z ON z.split = 'train' AND z.class_id = train_id GROUP BY test_id
  UNION ALL SELECT 'train', train_id, sum(copies) FROM n JOIN z ON z.split = 'test' AND z.class_id = test_id GROUP BY train_id)
SELECT m.split, m.row_id, m.class_id, coalesce(k.links, 0)::BIGINT AS links FROM m LEFT JOIN k ON m.split = k.split AND m.class_id = k.class_id""",
)
def q_split_overlap_links(spark, sf_dir):
    """Every test and train row with its class and the number of linked rows of the other split."""
    from sftlake.operators.overlap import near_overlap, overlap_links, shingle_rows

    _, _, _, split = prepared(spark, sf_dir)
    text = F.concat_ws("\n", "prompt", "response")
    rows = shingle_rows(split, text)
    return overlap_links(split, text, near_overlap(split, text, rows=rows), rows=rows)


@register(
    "test_slice",
    O.PREP
    + f"""SELECT row_id FROM labeled WHERE split = 'test'
ORDER BY md5('{SEED}:order:' || row_id::VARCHAR), row_id LIMIT 20""",
)
def q_test_slice(spark, sf_dir):
    from sftlake.plans.evaluate import test_slice

    _, _, _, split = prepared(spark, sf_dir)
    return test_slice(split.where(F.col("split") == "test"), 20, seed=SEED).select("row_id")


def entry_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flagship: documents -> records -> normalise/filter -> stratified split -> audit."""
    return q_split_audit(spark, sf_dir)


# ---------------------------------------------------------------- chat rendering


def rendered_conversations(spark, sf_dir):
    from sftlake.functions.chat import render_chat

    return A.conversation_messages(spark, sf_dir).select("conv_id", "messages", render_chat("messages").alias("text"))


@register("render_chat", O.with_(O.A6_RENDER) + "SELECT conv_id, text FROM rendered")
def q_render_chat(spark, sf_dir):
    return rendered_conversations(spark, sf_dir).select("conv_id", "text")


@register(
    "generation_prompts",
    f"SELECT CAST(item_id AS VARCHAR) AS id, {O.generation_chat('text')} AS text FROM benchmark",
)
def q_generation_prompts(spark, sf_dir):
    from sftlake.functions.chat import render_chat

    p = A.benchmark_prompts(spark, sf_dir)
    return p.select("id", render_chat(rec.user_turn("prompt"), add_generation_prompt=True).alias("text"))


@register(
    "prompt_groups",
    "SELECT 'g' || CAST(item_id % 5 AS VARCHAR) AS \"group\", count(*)::BIGINT AS n FROM benchmark GROUP BY 1",
)
def q_prompt_groups(spark, sf_dir):
    from sftlake.operators.align import prompt_groups

    return prompt_groups(A.benchmark_prompts(spark, sf_dir))


# ---------------------------------------------------------------- tokens

MAXLEN_SHORT = 128


@register(
    "token_counts",
    O.with_(O.A6_RENDER) + f"SELECT conv_id, len({O.toks('text')})::BIGINT AS n_tokens FROM rendered",
)
def q_token_counts(spark, sf_dir):
    from sftlake.operators.packing import segment_token_stats

    return segment_token_stats(A.conversation_segments(spark, sf_dir)).select("conv_id", "n_tokens")


@register(
    "truncate_tokens",
    O.with_(O.A6_RENDER)
    + f"""SELECT conv_id, len(t[1:{MAXLEN_SHORT}])::BIGINT AS n_kept, t[1:{MAXLEN_SHORT}][-1] AS last_token
FROM (SELECT conv_id, {O.toks('text')} AS t FROM rendered)""",
)
def q_truncate_tokens(spark, sf_dir):
    from sftlake.operators.packing import truncated_tail

    return truncated_tail(A.conversation_segments(spark, sf_dir), MAXLEN_SHORT)


@register(
    "valid_tokens",
    O.with_(O.A6_RENDER)
    + f"SELECT conv_id, greatest(least(len({O.toks('text')}), {MAXLEN_SHORT}) - 1, 0)::BIGINT AS n_valid FROM rendered",
)
def q_valid_tokens(spark, sf_dir):
    from sftlake.functions.tokens import valid_token_count
    from sftlake.operators.packing import segment_token_stats

    n = segment_token_stats(A.conversation_segments(spark, sf_dir))
    return n.select("conv_id", valid_token_count(F.col("n_tokens"), MAXLEN_SHORT).cast("long").alias("n_valid"))


# ---------------------------------------------------------------- bundled model and scoring

MAXLEN = 1024


def scoring_texts(spark, sf_dir):
    """Rendered chats of the prepared split, tagged: 'base' = non-English records,
    'domain' = English train records, 'eval' = English test records."""
    from sftlake.functions.chat import render_chat

    _, _, _, split = prepared(spark, sf_dir)
    en = F.col("kind").startswith("en/")
    tag = (
        F.when(~en, "base")
        .when(F.col("split") == "train", "domain")
        .when(F.col("split") == "test", "eval")
    )
    return split.select("row_id", render_chat("messages").alias("text"), tag.alias("tag"))


SCORING_TAGS = ("base", "domain", "eval")


def scoring_matrix(spark, sf_dir):
    """Base, domain and evaluation token counts from one tokenize pass: a token x tag matrix."""
    from sftlake.operators.model import token_count_matrix

    limits = {"base": None, "domain": MAXLEN, "eval": MAXLEN}  # the base corpus is read whole
    return token_count_matrix(scoring_texts(spark, sf_dir), "text", "tag", SCORING_TAGS, limits)


def _r6(c):
    return F.round(F.col(c), 6).alias(c)


def _scored(spark, sf_dir, lam=0.5):
    from sftlake.operators.score import score_count_matrix

    mx = scoring_matrix(spark, sf_dir)
    return score_count_matrix(mx, "eval", "base", "domain", lam), mx


@register(
    "token_model",
    O.PREP
    + ",\n"
    + O.scoring_ctes()
    + f""",
train_c AS (SELECT tok AS token, count(*)::BIGINT AS n FROM (SELECT unnest(t[1:{MAXLEN}]) AS tok FROM rtoks WHERE split = 'train') GROUP BY tok)
SELECT token, n FROM train_c""",
)
def q_token_model(spark, sf_dir):
    from sftlake.functions.chat import render_chat
    from sftlake.operators.model import fit_token_model

    _, _, _, split = prepared(spark, sf_dir)
    train = split.where(F.col("split") == "train").select(render_chat("messages").alias("text"))
    return fit_token_model(train, "text", MAXLEN).counts


@register(
    "adapted_model",
    O.PREP
    + ",\n"
    + O.scoring_ctes()
    + "\nSELECT token, round(-ln(p_base), 6) AS nll_base, round(-ln(p_tuned), 6) AS nll_tuned FROM m_0",
)
def q_adapted_model(spark, sf_dir):
    t = scoring_matrix(spark, sf_dir).model_table("base", "domain", 0.5)
    return t.select(
        "token",
        F.round(-F.log("p_base"), 6).alias("nll_base"),
        F.round(-F.log("p_tuned"), 6).alias("nll_tuned"),
    )


@register(
    "token_nll",
    O.PREP
    + ",\n"
    + O.scoring_ctes()
    + "\nSELECT model, num_texts, num_tokens, round(mean_nll, 6) AS mean_nll, round(perplexity, 6) AS perplexity FROM metrics2_0",
)
def q_token_nll(spark, sf_dir):
    m, _ = _scored(spark, sf_dir)
    return m.select("model", "num_texts", "num_tokens", _r6("mean_nll"), _r6("perplexity"))


@register(
    "score_compare",
    O.PREP
    + ",\n"
    + O.scoring_ctes()
    + """
SELECT num_samples, round(base_nll, 6) AS base_nll, round(tuned_nll, 6) AS tuned_nll,
       round(tuned_nll - base_nll, 6) AS delta_mean_nll FROM cmp_0""",
)
def q_score_compare(spark, sf_dir):
    from sftlake.operators.score import compare

    m, _ = _scored(spark, sf_dir)
    c = compare(m)
    return c.select("num_samples", _r6("base_nll"), _r6("tuned_nll"), _r6("delta_mean_nll"))


@register(
    "relative_change",
    O.PREP
    + ",\n"
    + O.scoring_ctes()
    + """
SELECT round(100.0 * (tuned_nll / base_nll - 1), 6) AS nll_pct, round(100.0 * (tuned_ppl / base_ppl - 1), 6) AS ppl_pct
FROM cmp_0""",
)
def q_relative_change(spark, sf_dir):
    from sftlake.operators.score import compare, relative_change

    m, _ = _scored(spark, sf_dir)
    return relative_change(compare(m)).select(_r6("nll_pct"), _r6("ppl_pct"))


@register(
    "score_plugin",
    O.PREP
    + f""",
e AS (SELECT {O.toks(O.two_turn_chat('prompt', 'response'))}[2:{MAXLEN}] AS t FROM labeled WHERE kind LIKE 'en/%' AND split = 'test'),
s AS (SELECT count(*)::BIGINT AS n, coalesce(sum(len(t)), 0)::BIGINT AS k, coalesce(sum(list_sum(list_transform(t, lambda x: ln(1 + length(x))))::DECIMAL(18,12)), 0)::DOUBLE AS s FROM e)
SELECT m AS model, k AS num_tokens, round(f * s / greatest(k, 1), 6) AS mean_nll
FROM s, (VALUES ('base', 1.0::DOUBLE), ('tuned', 0.5::DOUBLE)) AS v(m, f)""",
)
def q_score_plugin(spark, sf_dir):
    """Two self-contained scorers over the evaluation texts, in one pass through the plug-in."""
    from sftlake.operators.score import LengthScorerFactory, plugin_metrics, score_with_plugin

    texts = scoring_texts(spark, sf_dir).where(F.col("tag") == "eval")
    scorers = {"base": LengthScorerFactory(1.0, MAXLEN), "tuned": LengthScorerFactory(0.5, MAXLEN)}
    m = plugin_metrics(score_with_plugin(texts, "row_id", "text", scorers, cache_key="by-length"), list(scorers))
    return m.select("model", "num_tokens", _r6("mean_nll"))


@register(
    "eval_on_splits",
    O.PREP
    + ",\n"
    + O.scoring_ctes(eval_sql="split = 'test'", domain_sql="split = 'train'", base_tokens_sql=O.NON_ENGLISH_TOKENS)
    + """
SELECT num_samples, round(base_nll, 6) AS base_nll, round(tuned_nll, 6) AS tuned_nll,
       round(tuned_nll - base_nll, 6) AS delta_mean_nll FROM cmp_0""",
)
def q_eval_on_splits(spark, sf_dir):
    """The token-loss evaluation on split files written by the prepare job: the base model from
    the non-English documents, the domain model from the train files, all test rows scored."""
    from sftlake.plans.evaluate import compare_on_splits, flat_summary
    from sftlake.plans.prepare import prepare
    from sftlake.sources.scratch import fresh_dir

    out = fresh_dir(spark, "prepared")
    prepare(A.documents_raw(spark, sf_dir), out, seed=SEED)
    base = A.table(spark, sf_dir, "documents").where("lang != 'en'").select("text")
    doc = compare_on_splits(f"{out}/splits", base, lam=0.5, max_length=MAXLEN, max_samples=None, seed=SEED)
    return flat_summary(doc).select("num_samples", _r6("base_nll"), _r6("tuned_nll"), _r6("delta_mean_nll"))


# ---------------------------------------------------------------- before / after


def _rule_rows(prompts):
    from sftlake.operators.align import base_rule_output, tuned_rule_output

    return prompts.select(
        "pos", "id", "group", "prompt",
        base_rule_output("prompt").alias("base_output"),
        tuned_rule_output("prompt").alias("tuned_output"),
    )


def tuned_sql(p: str) -> str:
    return O.norm(f"lower(regexp_replace({p}, '[\\x{{9}}-\\x{{d}}\\x{{20}}]+', ' ', 'g'))")


A5_UNIQUE = f"""p AS (
  SELECT item_id AS pos, CAST(item_id AS VARCHAR) AS id, 'g' || CAST(item_id % 5 AS VARCHAR) AS "group", text AS prompt,
         {O.norm('text')} AS base_output, {tuned_sql('text')} AS tuned_output
  FROM benchmark)"""


@register(
    "before_after",
    O.with_(A5_UNIQUE) + 'SELECT pos, id, "group", prompt, base_output, tuned_output FROM p',
)
def q_before_after(spark, sf_dir):
    from sftlake.operators.align import before_after

    return before_after(_rule_rows(A.benchmark_prompts(spark, sf_dir)))


@register(
    "before_after_dup",
    O.with_(
        f"""p AS (
  SELECT doc_id AS pos, CASE WHEN doc_id % 50 <> 0 THEN CAST(doc_id % 50 AS VARCHAR) END AS id,
         {tuned_sql('text')} AS tuned_output
  FROM documents)""",
        "g AS (SELECT id, min(pos) AS first_pos, arg_max(tuned_output, pos) AS last_tuned FROM p GROUP BY id)",
    )
    + """SELECT p.pos, p.id, coalesce(g.last_tuned, '') AS tuned_output
FROM p LEFT JOIN g ON p.id IS NOT DISTINCT FROM g.id AND p.pos = g.first_pos""",
)
def q_before_after_dup(spark, sf_dir):
    from sftlake.operators.align import before_after

    out = before_after(_rule_rows(A.document_prompts(spark, sf_dir)))
    return out.select("pos", "id", "tuned_output")


@register(
    "report_blocks",
    O.with_(A5_UNIQUE)
    + """SELECT pos, '## ' || id || ' - ' || "group" || chr(10) || chr(10) || '**Prompt**' || chr(10) || chr(10) || prompt
       || chr(10) || chr(10) || '**Base Model Output**' || chr(10) || chr(10) || base_output || chr(10) || chr(10)
       || '**OFT Output**' || chr(10) || chr(10) || tuned_output || chr(10) || chr(10) AS block
FROM p""",
)
def q_report_blocks(spark, sf_dir):
    from sftlake.operators.align import before_after, report_block

    aligned = before_after(_rule_rows(A.benchmark_prompts(spark, sf_dir)))
    return aligned.select("pos", report_block().alias("block"))


@register(
    "generate_plugin",
    f"""SELECT CAST(item_id AS VARCHAR) AS id, length(t) || ':' || md5(t) AS output
FROM (SELECT item_id, {O.generation_chat('text')} AS t FROM benchmark)""",
)
def q_generate_plugin(spark, sf_dir):
    """The generator plug-in on rendered prompts; the answer is a digest of what it was given."""
    from sftlake.operators.align import DigestGenerator, generate

    p = A.benchmark_prompts(spark, sf_dir)
    return generate(p, "id", "prompt", DigestGenerator(), cache_key="digest", render_template=True)


@register(
    "before_after_files",
    O.with_(A5_UNIQUE)
    + """SELECT id, "group", prompt, base_output, tuned_output,
       md5(rtrim('## ' || id || ' - ' || "group" || chr(10) || chr(10) || '**Prompt**' || chr(10) || chr(10) || prompt
       || chr(10) || chr(10) || '**Base Model Output**' || chr(10) || chr(10) || base_output || chr(10) || chr(10)
       || '**OFT Output**' || chr(10) || chr(10) || tuned_output, chr(10))) AS block_md5
FROM p""",
)
def q_before_after_files(spark, sf_dir):
    """Prompts written and read as a prompt file, aligned, written as JSONL and report, and both
    read back: the report is read block by block, and a block is found by the id in its heading."""
    from sftlake.operators.align import before_after, write_before_after
    from sftlake.sources.jsonl import BEFORE_AFTER_SCHEMA, read_jsonl, read_prompts, read_report, write_jsonl
    from sftlake.sources.scratch import fresh_dir

    root = fresh_dir(spark, "before-after")
    write_jsonl(A.benchmark_prompts(spark, sf_dir).select("id", "group", "prompt"), f"{root}/prompts")
    prompts = read_prompts(spark, f"{root}/prompts").withColumn("pos", F.col("id").cast("long"))
    write_before_after(before_after(_rule_rows(prompts)), root)
    rows = read_jsonl(spark, f"{root}/jsonl", BEFORE_AFTER_SCHEMA)
    blocks = read_report(spark, f"{root}/report")
    blocks = blocks.select(F.regexp_extract("block", r"^## (.*?) - ", 1).alias("__id"), F.md5("block").alias("block_md5"))
    joined = rows.join(blocks, F.col("id") == F.col("__id"))
    return joined.select("id", "group", "prompt", "base_output", "tuned_output", "block_md5")


@register(
    "length_change",
    O.with_(A5_UNIQUE)
    + """SELECT "group", count(*)::BIGINT AS n, round(avg(length(base_output)), 6) AS base_chars,
       round(avg(length(tuned_output)), 6) AS tuned_chars, count(*) FILTER (WHERE length(tuned_output) < length(base_output))::BIGINT AS shorter
FROM p GROUP BY "group\"""",
)
def q_length_change(spark, sf_dir):
    from sftlake.operators.align import before_after, length_change

    r = length_change(before_after(_rule_rows(A.benchmark_prompts(spark, sf_dir))))
    return r.select("group", "n", _r6("base_chars"), _r6("tuned_chars"), "shorter")


@register(
    "outcome_tally",
    """SELECT CASE item_id % 3 WHEN 0 THEN 'Improved' WHEN 1 THEN 'Tradeoff' ELSE 'Regressed' END AS outcome, count(*)::BIGINT AS n
FROM benchmark GROUP BY 1""",
)
def q_outcome_tally(spark, sf_dir):
    """Hand labels are stood for by a rule on the prompt id."""
    from sftlake.operators.align import before_after, outcome_tally

    p = A.benchmark_prompts(spark, sf_dir)
    label = F.when(F.col("pos") % 3 == 0, "Improved").when(F.col("pos") % 3 == 1, "Tradeoff").otherwise("Regressed")
    return outcome_tally(before_after(_rule_rows(p)), p.select("id", label.alias("outcome")))


# ---------------------------------------------------------------- curves

RUNS = ("r0", "r1", "r2")
CURVE_LABELS = ["main", "ablation"]

A4_POINTS = """ev AS (
  SELECT event_id, event_type, value, 'r' || CAST(user_id % 3 AS VARCHAR) AS run,
         row_number() OVER (PARTITION BY user_id % 3 ORDER BY ts, event_id) * 10 AS step
  FROM events),
pts AS (
  SELECT run, 'train' AS series, step, value AS loss FROM ev WHERE event_type IN ('purchase', 'click')
  UNION ALL
  SELECT run, 'eval' AS series, step, value AS loss FROM ev WHERE event_type IN ('view', 'click'))"""


def log_points(spark, sf_dir):
    """events -> trainer-log lines in the shared folder -> read back -> loss points."""
    from sftlake.operators.curves import loss_points
    from sftlake.sources.jsonl import read_log_lines, write_log_lines
    from sftlake.sources.scratch import fresh_dir

    entries = A.event_log_entries(spark, sf_dir).drop("event_id")
    path = fresh_dir(spark, "trainer-log")
    write_log_lines(entries, path)
    return loss_points(read_log_lines(spark, path))


@register("loss_curves", O.with_(A4_POINTS) + "SELECT run, series, step::BIGINT AS step, round(loss, 6) AS loss FROM pts")
def q_loss_curves(spark, sf_dir):
    return log_points(spark, sf_dir).select("run", "series", "step", F.round("loss", 6).alias("loss"))


@register(
    "trainer_states",
    O.with_(A4_POINTS) + "SELECT run, (step // 10 - 1)::BIGINT AS pos, series, step::BIGINT AS step, round(loss, 6) AS loss FROM pts",
)
def q_trainer_states(spark, sf_dir):
    """events -> one trainer-state document a run -> read back by its lines -> loss points with
    their place in the log."""
    from sftlake.operators.curves import loss_points
    from sftlake.sources.scratch import fresh_dir
    from sftlake.sources.trainer_log import read_trainer_documents, write_trainer_states

    path = fresh_dir(spark, "trainer-states")
    write_trainer_states(A.event_log_entries(spark, sf_dir, place="pos").drop("event_id"), path)
    entries = read_trainer_documents(spark, [path])
    entries = entries.withColumn("run", F.regexp_extract("run_path", "run=([^/]+)$", 1))
    return loss_points(entries).select("run", "pos", "series", "step", _r6("loss"))


@register(
    "curve_compare",
    O.with_(A4_POINTS)
    + """SELECT CASE run WHEN 'r0' THEN 'main' WHEN 'r1' THEN 'ablation' ELSE run END AS label, series,
       count(*)::BIGINT AS n, round(arg_min(loss, step), 6) AS first_loss, round(arg_max(loss, step), 6) AS last_loss
FROM pts GROUP BY ALL""",
)
def q_curve_compare(spark, sf_dir):
    """Trainer-state documents under a path a run, read back by those paths with a label each."""
    from sftlake.operators.curves import curve_compare, loss_curves
    from sftlake.sources.scratch import fresh_dir
    from sftlake.sources.trainer_log import read_trainer_documents, write_trainer_states

    root = fresh_dir(spark, "curves")
    write_trainer_states(A.event_log_entries(spark, sf_dir, place="pos").drop("event_id"), root)
    paths = [f"{root}/run={r}/part-*" for r in RUNS]  # the third label is its folder's name
    c = curve_compare(loss_curves(spark, paths, CURVE_LABELS, reader=read_trainer_documents))
    return c.select(F.regexp_replace("label", "^run=", "").alias("label"), "series", "n", _r6("first_loss"), _r6("last_loss"))


@register(
    "run_summary",
    O.with_(A4_POINTS)
    + """, agg AS (
  SELECT run,
         avg(loss) FILTER (WHERE series = 'train') AS train_loss,
         count(*) FILTER (WHERE series = 'train')::DOUBLE AS train_points,
         arg_max(loss, step) FILTER (WHERE series = 'eval') AS eval_loss,
         count(*) FILTER (WHERE series = 'eval')::DOUBLE AS eval_points
  FROM pts GROUP BY run)
SELECT run, 'train_loss' AS metric, round(train_loss, 6) AS value FROM agg
UNION ALL SELECT run, 'train_points', round(train_points, 6) FROM agg
UNION ALL SELECT run, 'eval_loss', round(eval_loss, 6) FROM agg
UNION ALL SELECT run, 'eval_points', round(eval_points, 6) FROM agg""",
)
def q_run_summary(spark, sf_dir):
    from sftlake.operators.curves import run_summary

    return run_summary(log_points(spark, sf_dir)).select("run", "metric", _r6("value"))


@register(
    "run_documents",
    O.with_(A4_POINTS)
    + """, d AS (
  SELECT run, round(avg(loss) FILTER (WHERE series = 'train'), 6) AS train_loss, count(*) FILTER (WHERE series = 'train')::DOUBLE AS train_points,
         round(avg(loss) FILTER (WHERE series = 'eval'), 6) AS eval_loss, count(*) FILTER (WHERE series = 'eval')::DOUBLE AS eval_points
  FROM pts GROUP BY run)
SELECT run, 'train_loss' AS metric, train_loss AS value FROM d UNION ALL SELECT run, 'eval_loss', eval_loss FROM d
UNION ALL SELECT run, 'points', eval_points FROM d""",
)
def q_run_documents(spark, sf_dir):
    """Stored metric documents of the two phases of each run, read back and merged; 'points' is
    in both, and the evaluation's stays."""
    from sftlake.operators.curves import merged_run_summary
    from sftlake.sources.jsonl import read_jsonl, write_jsonl
    from sftlake.sources.scratch import fresh_dir

    root, pts = fresh_dir(spark, "run-docs"), log_points(spark, sf_dir)
    docs = {}
    for phase in ("train", "eval"):
        m = pts.where(F.col("series") == phase).groupBy("run").agg(F.round(F.avg("loss"), 6).alias("l"), F.count(F.lit(1)).cast("double").alias("n"))
        m = m.select("run", F.create_map(F.lit(f"{phase}_loss"), F.col("l"), F.lit("points"), F.col("n")).alias("metrics"))
        write_jsonl(m, f"{root}/{phase}")
        docs[phase] = read_jsonl(spark, f"{root}/{phase}", "run string, metrics map<string,double>")
    return merged_run_summary(docs["train"], docs["eval"])


# ---------------------------------------------------------------- metric documents

METRIC_RUNS = ((0.5, "lam_0.5"), (0.25, "lam_0.25"))


@register(
    "metric_table",
    O.PREP
    + ",\n"
    + O.scoring_ctes(tuple(l for l, _ in METRIC_RUNS))
    + """
SELECT 'Base' AS label, 'mean_nll' AS metric, round(mean_nll, 6) AS value FROM metrics2_0 WHERE model = 'base'
UNION ALL SELECT 'Base', 'perplexity', round(perplexity, 2) FROM metrics2_0 WHERE model = 'base'
UNION ALL SELECT 'lam_0.5', 'mean_nll', round(mean_nll, 6) FROM metrics2_0 WHERE model = 'tuned'
UNION ALL SELECT 'lam_0.5', 'perplexity', round(perplexity, 2) FROM metrics2_0 WHERE model = 'tuned'
UNION ALL SELECT 'lam_0.25', 'mean_nll', round(mean_nll, 6) FROM metrics2_1 WHERE model = 'tuned'
UNION ALL SELECT 'lam_0.25', 'perplexity', round(perplexity, 2) FROM metrics2_1 WHERE model = 'tuned'""",
)
def q_metric_table(spark, sf_dir):
    """Two tuned runs scored, each summary written as a document, read back, tabulated."""
    from sftlake.operators.curves import metric_table
    from sftlake.operators.score import score_count_matrix, summary_document
    from sftlake.sources.jsonl import read_metric_docs, write_metric_doc
    from sftlake.sources.scratch import fresh_dir

    mx = scoring_matrix(spark, sf_dir)
    root = fresh_dir(spark, "metric-docs")
    paths = []
    for i, (lam, _) in enumerate(METRIC_RUNS):
        m = score_count_matrix(mx, "eval", "base", "domain", lam)
        p = f"{root}/run-{i}"
        write_metric_doc(summary_document(m), p)
        paths.append(p)
    docs = read_metric_docs(spark, paths).withColumn(
        "idx", F.regexp_extract("path", r"/run-(\d+)/", 1).cast("int")
    )
    t = metric_table(docs, {i: label for i, (_, label) in enumerate(METRIC_RUNS)})
    digits = F.when(F.col("metric") == "perplexity", F.round("value", 2)).otherwise(F.round("value", 6))
    return t.select("label", "metric", digits.alias("value"))


# ---------------------------------------------------------------- JSONL sinks and scans


@register("jsonl_roundtrip", O.with_(O.A2, O.conv("a2", "kept")) + "SELECT row_id, kind, prompt, response FROM kept")
def q_jsonl_roundtrip(spark, sf_dir):
    from sftlake.sources.jsonl import SFT_SCHEMA, read_jsonl, write_jsonl
    from sftlake.sources.scratch import fresh_dir

    kept = rec.convert_records(A.documents_raw(spark, sf_dir))
    path = fresh_dir(spark, "jsonl")
    write_jsonl(kept.select("kind", "prompt", "response", "messages", "row_id"), path)
    return read_jsonl(spark, path, SFT_SCHEMA).select("row_id", "kind", "prompt", "response")


@register(
    "split_scan",
    O.PREP
    + "SELECT split, count(*)::BIGINT AS n, sum(length(prompt) + length(response))::BIGINT AS chars FROM labeled GROUP BY split",
)
def q_split_scan(spark, sf_dir):
    from sftlake.sources.jsonl import read_splits, write_splits
    from sftlake.sources.scratch import fresh_dir

    _, _, _, split = prepared(spark, sf_dir)
    path = fresh_dir(spark, "splits")
    write_splits(split.withColumn("order_hash", spl.seeded_hash(SEED, "row_id", "order")), path)
    s = read_splits(spark, path)
    return s.groupBy("split").agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(F.length("prompt") + F.length("response")).cast("long").alias("chars"),
    )


# ---------------------------------------------------------------- packing, masks, budget

PACK_LEN = 128


@register(
    "pack_sequences",
    O.with_(
        O.A6_RENDER,
        f"""lens AS (SELECT conv_id % 8 AS shard, conv_id, len({O.toks('text')})::BIGINT AS n FROM rendered),
spans AS (
  SELECT shard, (sum(n) OVER (PARTITION BY shard ORDER BY conv_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) - n)::BIGINT AS s,
         (sum(n) OVER (PARTITION BY shard ORDER BY conv_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))::BIGINT AS e
  FROM lens WHERE n > 0),
blocks AS (SELECT shard, s, e, unnest(range(s // {PACK_LEN}, (e - 1) // {PACK_LEN} + 1)) AS block FROM spans)""",
    )
    + f"""SELECT shard::BIGINT AS shard, block::BIGINT AS block,
       sum(least(e, (block + 1) * {PACK_LEN}) - greatest(s, block * {PACK_LEN}))::BIGINT AS n_tokens
FROM blocks GROUP BY shard, block""",
)
def q_pack_sequences(spark, sf_dir):
    from sftlake.operators.packing import pack_sequences, segment_token_stats

    n = segment_token_stats(A.conversation_segments(spark, sf_dir))
    lengths = n.select((F.col("conv_id") % 8).alias("shard"), "conv_id", F.col("n_tokens").alias("n"))
    return pack_sequences(lengths, "shard", "conv_id", "n", PACK_LEN).select(
        F.col("shard").cast("long"), F.col("block").cast("long"), "n_tokens"
    )


@register(
    "pack_spans",
    O.with_(
        O.A6_RENDER,
        f"""lens AS (SELECT conv_id % 8 AS shard, conv_id, len({O.toks('text')})::BIGINT AS n FROM rendered),
ends AS (SELECT shard, conv_id, n, sum(n) OVER (PARTITION BY shard ORDER BY conv_id)::BIGINT AS e FROM lens WHERE n > 0),
blocks AS (SELECT shard, conv_id, e - n AS s, e, unnest(range((e - n) // {PACK_LEN}, (e - 1) // {PACK_LEN} + 1)) AS block FROM ends)""",
    )
    + f"""SELECT shard::BIGINT AS shard, block::BIGINT AS block, conv_id, (greatest(s, block * {PACK_LEN}) - s)::BIGINT AS token_start,
       (least(e, (block + 1) * {PACK_LEN}) - s)::BIGINT AS token_end FROM blocks""",
)
def q_pack_spans(spark, sf_dir):
    """Which tokens of which conversation each packed block holds."""
    from sftlake.operators.packing import pack_spans, segment_token_stats

    n = segment_token_stats(A.conversation_segments(spark, sf_dir))
    lengths = n.select((F.col("conv_id") % 8).alias("shard"), "conv_id", F.col("n_tokens").alias("n"))
    out = pack_spans(lengths, "shard", "conv_id", "n", PACK_LEN)
    return out.select(F.col("shard").cast("long"), F.col("block").cast("long"), "conv_id", "token_start", "token_end")


@register(
    "assistant_spans",
    O.with_(
        O.A6_RENDER,
        f"""hdr AS (SELECT conv_id, CASE WHEN r0 = 'system' THEN 0 ELSE len({O.toks(f"'{O.IM_S}system' || {O.NL} || '{O.DEFAULT_SYSTEM}{O.IM_E}' || {O.NL}")}) END AS h FROM firsts),
spans AS (SELECT conv_id, turn, role, len({O.toks('seg')}) AS n, sum(len({O.toks('seg')})) OVER (PARTITION BY conv_id ORDER BY turn) AS e FROM segs)""",
    )
    + """SELECT conv_id, turn, (h + e - n)::BIGINT AS token_start, (h + e)::BIGINT AS token_end
FROM spans JOIN hdr USING (conv_id) WHERE role = 'assistant' AND n > 0""",
)
def q_assistant_spans(spark, sf_dir):
    """The assistant-only mask: token ranges in the rendered conversation."""
    from sftlake.operators.packing import assistant_spans

    return assistant_spans(A.conversation_segments(spark, sf_dir))


@register(
    "truncation_report",
    O.with_(O.A6_RENDER)
    + f"""SELECT count(*)::BIGINT AS n_texts, count(*) FILTER (WHERE n > {MAXLEN_SHORT})::BIGINT AS n_truncated,
       round(count(*) FILTER (WHERE n > {MAXLEN_SHORT}) / greatest(count(*), 1)::DOUBLE, 6) AS share
FROM (SELECT len({O.toks('text')}) AS n FROM rendered)""",
)
def q_truncation_report(spark, sf_dir):
    from sftlake.operators.packing import segment_token_stats, truncation_report

    r = truncation_report(segment_token_stats(A.conversation_segments(spark, sf_dir)), MAXLEN_SHORT)
    return r.select("n_texts", "n_truncated", _r6("share"))


TOOL = '{"type": "function", "function": {"name": "look_up"}}'


@register(
    "render_tools",
    O.with_(
        f"""m AS (
  SELECT conv_id, turn, text, CASE WHEN turn % 4 IN (2, 3) THEN 'tool' WHEN turn % 4 = 1 THEN 'assistant' ELSE role END AS role, turn % 4 = 1 AS calls
  FROM conversations),
w AS (SELECT *, lag(role) OVER o AS p, lead(role) OVER o AS n, row_number() OVER o AS k FROM m WINDOW o AS (PARTITION BY conv_id ORDER BY turn)),
s AS (
  SELECT conv_id, turn, k, CASE
    WHEN role = 'tool' THEN CASE WHEN p IS NULL OR p <> 'tool' THEN '{O.IM_S}user' ELSE '' END || {O.NL} || '<tool_response>' || {O.NL} || text || {O.NL}
      || '</tool_response>' || CASE WHEN n IS NULL OR n <> 'tool' THEN '{O.IM_E}' || {O.NL} ELSE '' END
    WHEN role = 'assistant' AND calls THEN '{O.IM_S}assistant' || CASE WHEN text <> '' THEN {O.NL} || text ELSE '' END || {O.NL} || '<tool_call>' || {O.NL}
      || '{{"name": "look_up", "arguments": {{"turn": ' || turn || '}}}}' || {O.NL} || '</tool_call>' || '{O.IM_E}' || {O.NL}
    WHEN role = 'user' OR role = 'assistant' OR (role = 'system' AND k > 1) THEN '{O.IM_S}' || role || {O.NL} || text || '{O.IM_E}' || {O.NL}
    ELSE '' END AS seg FROM w),
h AS (SELECT conv_id, arg_min(CASE WHEN role = 'system' THEN text ELSE '{O.DEFAULT_SYSTEM}' END, turn) AS sys FROM m GROUP BY conv_id)"""
    )
    + f"""SELECT conv_id, '{O.IM_S}system' || {O.NL} || sys || '{O.quoted(O.TOOLS_INTRO)}' || {O.NL} || '{TOOL}' || '{O.quoted(O.TOOLS_OUTRO)}' || t AS text
FROM h JOIN (SELECT conv_id, string_agg(seg, '' ORDER BY turn) AS t FROM s GROUP BY conv_id) USING (conv_id)""",
)
def q_render_tools(spark, sf_dir):
    """Conversations with every fourth turn a tool call and the next two tool replies, rendered
    with a tools preamble."""
    from sftlake.functions.chat import render_chat_tools

    t = F.col("turn") % 4
    c = A.table(spark, sf_dir, "conversations")
    call = F.array(F.struct(F.lit("look_up").alias("name"), F.concat(F.lit('{"turn": '), F.col("turn").cast("string"), F.lit("}")).alias("arguments")))
    role = F.when(t.isin(2, 3), "tool").when(t == 1, "assistant").otherwise(F.col("role"))
    msg = F.struct("turn", role.alias("role"), F.col("text").alias("content"), F.when(t == 1, call).alias("tool_calls"))
    convs = c.groupBy("conv_id").agg(F.array_sort(F.collect_list(msg)).alias("messages"))
    return convs.select("conv_id", render_chat_tools("messages", F.array(F.lit(TOOL))).alias("text"))


@register(
    "assistant_mask",
    O.with_(
        O.A6_RENDER,
        f"""seg_n AS (SELECT conv_id, role, len({O.toks('seg')}) AS n FROM segs),
hdr AS (SELECT conv_id, CASE WHEN r0 = 'system' THEN 0 ELSE len({O.toks(f"'{O.IM_S}system' || {O.NL} || '{O.DEFAULT_SYSTEM}{O.IM_E}' || {O.NL}")}) END AS n FROM firsts)""",
    )
    + """SELECT h.conv_id, (h.n + sum(s.n))::BIGINT AS n_tokens,
       sum(CASE WHEN s.role = 'assistant' THEN s.n ELSE 0 END)::BIGINT AS n_assistant
FROM hdr h JOIN seg_n s USING (conv_id) GROUP BY h.conv_id, h.n""",
)
def q_assistant_mask(spark, sf_dir):
    from sftlake.operators.packing import segment_token_stats

    return segment_token_stats(A.conversation_segments(spark, sf_dir))


@register(
    "train_budget",
    O.PREP
    + """SELECT 38400::BIGINT AS samples, count(*)::BIGINT AS train_rows, round(38400.0 / count(*), 6) AS share
FROM labeled WHERE split = 'train'""",
)
def q_train_budget(spark, sf_dir):
    from sftlake.operators.packing import train_budget

    _, _, _, split = prepared(spark, sf_dir)
    b = train_budget(split.where(F.col("split") == "train"))
    return b.select("samples", "train_rows", _r6("share"))


# ---------------------------------------------------------------- conversation pairs (A1)


A1_PAIRS = """nx AS (
  SELECT conv_id, turn, role, text,
         lead(role) OVER (PARTITION BY conv_id ORDER BY turn) AS next_role,
         lead(text) OVER (PARTITION BY conv_id ORDER BY turn) AS next_text
  FROM conversations),
a1 AS (
  SELECT conv_id || ':' || turn AS row_id, 't' || CAST(turn AS VARCHAR) AS kind, text AS input, next_text AS target
  FROM nx WHERE role = 'user' AND next_role = 'assistant')"""


@register(
    "pair_records",
    O.with_(
        A1_PAIRS,
        O.conv("a1", "kept"),
    )
    + "SELECT row_id, kind, prompt, response FROM kept",
)
def q_pair_records(spark, sf_dir):
    """Conversation turns -> (user, next assistant) raw pairs -> normalised SFT records."""
    kept = rec.convert_records(A.conversation_pairs(spark, sf_dir))
    return kept.select("row_id", "kind", "prompt", "response")


@register(
    "pair_split_audit",
    O.with_(A1_PAIRS, O.conv("a1", "kept"), O.split_ctes("kept"))
    + """SELECT kind, count(*) FILTER (WHERE split = 'train')::BIGINT AS train,
       count(*) FILTER (WHERE split = 'val')::BIGINT AS val,
       count(*) FILTER (WHERE split = 'test')::BIGINT AS test
FROM labeled GROUP BY kind""",
)
def q_pair_split_audit(spark, sf_dir):
    """The stratified split on a second source: conversation pairs, stratified by turn."""
    kept = rec.convert_records(A.conversation_pairs(spark, sf_dir))
    plan = spl.plan_split(kept, TRAIN, VAL, SEED)
    return spl.split_audit(spl.assign_splits(kept, plan, seed=SEED))


# ---------------------------------------------------------------- bigram model, masks, batches

# Pair counts of the train chats, closed by a line feed; contexts; continuation counts.
BIGRAMS = (
    O.PREP
    + f""",
rtoks AS (SELECT row_id, split, {O.toks(O.two_turn_chat('prompt', 'response'))} AS t FROM labeled),
bi AS (
  SELECT u, v, count(*)::BIGINT AS n FROM (
    SELECT unnest(t) AS u, unnest(list_append(t[2:], {O.NL})) AS v FROM rtoks WHERE split = 'train') GROUP BY u, v),
cx AS (SELECT u, sum(n)::BIGINT AS n_u, count(*)::BIGINT AS t_u FROM bi GROUP BY u),
kx AS (SELECT v, count(*)::BIGINT AS k FROM bi GROUP BY v),
den AS (SELECT (sum(k) + count(*) + 1)::DOUBLE AS den FROM kx),
co AS (SELECT v, (k + 1)::DOUBLE / den AS c FROM kx CROSS JOIN den)"""
)
_P = "greatest(coalesce(n, 0)::DOUBLE - 0.75::DOUBLE, 0::DOUBLE) / n_u + 0.75::DOUBLE * t_u / n_u * {c}"


def _bigram_model(spark, sf_dir):
    from sftlake.functions.chat import render_chat
    from sftlake.operators.bigram import fit_bigram_model

    _, _, _, split = prepared(spark, sf_dir)
    texts = split.select("row_id", "split", render_chat("messages").alias("text"))
    return fit_bigram_model(texts.where(F.col("split") == "train")), texts


@register("bigram_model", BIGRAMS + f"\nSELECT u AS context, v AS token, n, round({_P.format(c='c')}, 6) AS p FROM bi JOIN cx USING (u) JOIN co USING (v)")
def q_bigram_model(spark, sf_dir):
    """The interpolated bigram model of the train split."""
    model, _ = _bigram_model(spark, sf_dir)
    return model.table().select("context", "token", "n", _r6("p"))


@register(
    "token_nll_positions",
    BIGRAMS
    + f""",
ev AS (SELECT row_id, unnest(t[1:{MAXLEN}][:-2]) AS u, unnest(t[2:{MAXLEN}]) AS v, unnest(range(1, len(t[1:{MAXLEN}]))) AS pos FROM rtoks WHERE split = 'test'),
pr AS (SELECT row_id, pos, CASE WHEN n_u IS NULL THEN coalesce(c, 1.0::DOUBLE / den) ELSE {_P.format(c='coalesce(c, 1.0::DOUBLE / den)')} END AS p
  FROM ev LEFT JOIN bi USING (u, v) LEFT JOIN cx USING (u) LEFT JOIN co USING (v) CROSS JOIN den)
SELECT row_id, pos, round(-ln(p), 6) AS nll FROM pr""",
)
def q_token_nll_positions(spark, sf_dir):
    """The loss of every position of the test chats under the bigram model of the train chats."""
    from sftlake.operators.bigram import position_nll

    model, texts = _bigram_model(spark, sf_dir)
    return position_nll(texts.where(F.col("split") == "test"), model, "row_id", max_length=MAXLEN).select("row_id", "pos", _r6("nll"))


GREEDY_TOKENS = 12


@register(
    "generate_greedy",
    BIGRAMS.replace("WITH ", "WITH RECURSIVE ", 1)
    + f""",
topc AS (SELECT v, c FROM co ORDER BY c DESC, v LIMIT 1),
cand AS (
  SELECT u, v, {_P.format(c='c')} AS p FROM bi JOIN cx USING (u) JOIN co USING (v)
  UNION ALL SELECT u, topc.v, 0.75::DOUBLE * t_u / n_u * c FROM cx CROSS JOIN topc),
best AS (SELECT u, v FROM (SELECT u, v, row_number() OVER (PARTITION BY u ORDER BY p DESC, v) AS r FROM cand) WHERE r = 1),
lasts AS (SELECT row_id, {O.toks('input')}[-1] AS s FROM a2),
walk AS (
  SELECT DISTINCT s, s AS tok, 0 AS k, '' AS text FROM lasts WHERE s IS NOT NULL
  UNION ALL
  SELECT s, nx, k + 1, CASE WHEN nx = {O.NL} THEN text ELSE text || ' ' || nx END
  FROM (SELECT w.s, w.k, w.text, CASE WHEN w.tok = {O.NL} THEN w.tok ELSE coalesce(b.v, (SELECT v FROM topc)) END AS nx
        FROM walk w LEFT JOIN best b ON b.u = w.tok WHERE w.k < {GREEDY_TOKENS}))
SELECT row_id, coalesce({O.norm('text')}, '') AS output FROM lasts LEFT JOIN (SELECT s, text FROM walk WHERE k = {GREEDY_TOKENS}) USING (s)""",
)
def q_generate_greedy(spark, sf_dir):
    """What the bigram model of the train chats says after every record's input."""
    from sftlake.operators.bigram import generate_greedy

    model, _ = _bigram_model(spark, sf_dir)
    return generate_greedy(A.documents_raw(spark, sf_dir), model, "row_id", "input", GREEDY_TOKENS)


_MASK_CTES = (
    O.A6_RENDER,
    f"""hdr AS (SELECT conv_id, CASE WHEN r0 = 'system' THEN 0 ELSE len({O.toks(f"'{O.IM_S}system' || {O.NL} || '{O.DEFAULT_SYSTEM}{O.IM_E}' || {O.NL}")}) END AS h FROM firsts),
spans AS (
  SELECT conv_id, h + e - n AS s0, h + e AS s1 FROM (
    SELECT conv_id, role, len({O.toks('seg')}) AS n, sum(len({O.toks('seg')})) OVER (PARTITION BY conv_id ORDER BY turn) AS e FROM segs) JOIN hdr USING (conv_id)
  WHERE role = 'assistant'),
pos AS (SELECT conv_id, unnest(t) AS token, unnest(range(len(t))) AS pos FROM (SELECT conv_id, {O.toks('text')} AS t FROM rendered)),
doc_c AS (SELECT tok AS token, count(*)::BIGINT AS n FROM (SELECT unnest({O.toks('text')}) AS tok FROM documents) GROUP BY tok),
dd AS (SELECT (sum(n) + count(*) + 1)::DOUBLE AS den FROM doc_c),
held AS (SELECT * FROM pos p WHERE pos >= 1 AND EXISTS (SELECT 1 FROM spans s WHERE s.conv_id = p.conv_id AND s.s0 <= p.pos AND p.pos < s.s1)),
loss AS (SELECT {O.loss('coalesce((n + 1)::DOUBLE / den, 1.0::DOUBLE / den)')} AS l FROM held LEFT JOIN doc_c USING (token) CROSS JOIN dd)""",
)


@register(
    "masked_nll",
    O.with_(*_MASK_CTES)
    + """SELECT (SELECT count(*) FROM rendered) AS num_texts, count(*) AS num_tokens, round(coalesce(sum(l), 0)::DOUBLE / greatest(count(*), 1), 6) AS mean_nll,
  round(exp(coalesce(sum(l), 0)::DOUBLE / greatest(count(*), 1)), 6) AS perplexity FROM loss""",
)
def q_masked_nll(spark, sf_dir):
    """Loss of the assistant turns of all conversations under the token model of the documents."""
    from sftlake.operators.masked import masked_nll
    from sftlake.operators.model import fit_token_model
    from sftlake.operators.packing import assistant_spans

    segments = A.conversation_segments(spark, sf_dir)
    model = fit_token_model(A.table(spark, sf_dir, "documents"), "text", None)
    out = masked_nll(segments, assistant_spans(segments), model)
    return out.select("num_texts", "num_tokens", _r6("mean_nll"), _r6("perplexity"))


BATCH_ROWS = 8


@register(
    "batch_plan",
    f"""WITH l AS (SELECT doc_id, least(len({O.toks("coalesce(text, '')")}), {MAXLEN}) AS n, (row_number() OVER (ORDER BY doc_id) - 1) // {BATCH_ROWS} AS batch FROM documents)
SELECT batch::BIGINT AS batch, min(doc_id)::BIGINT AS first_row, count(*) AS rows, max(n)::BIGINT AS width, sum(n)::BIGINT AS tokens, (max(n) * count(*) - sum(n))::BIGINT AS padded FROM l GROUP BY batch""",
)
def q_batch_plan(spark, sf_dir):
    """Batches of the documents in id order, padded to the longest of each."""
    from sftlake.functions.tokens import tokenize
    from sftlake.operators.masked import batch_plan

    docs = A.table(spark, sf_dir, "documents")
    n = F.least(F.size(tokenize(F.coalesce("text", F.lit("")))), F.lit(MAXLEN)).cast("long")
    out = batch_plan(docs.select(F.col("doc_id").cast("long").alias("doc_id"), n.alias("n")), "doc_id", "n", BATCH_ROWS)
    return out.select("batch", "first_row", "rows", "width", "tokens", "padded")
