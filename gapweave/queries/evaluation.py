"""Scores, summaries, training logs."""

from __future__ import annotations

from pyspark.sql import functions as F

from gapweave.functions import metrics as M
from gapweave.functions.codebleu import with_codebleu
from gapweave.operators import scoring as Score, summary as Summary, train_log as Log
from gapweave.params import EvalParams, FimParams
from gapweave.operators.structure import with_brace_nodes
from gapweave.plans.preprocess import file_blocks
from gapweave.queries import derive as D, sql as Q
from gapweave.queries.codebleu_sql import code_scores_sql
from gapweave.queries.corpus import brace_sql
from gapweave.queries.registry import ORACLES, query
from gapweave.sources.tables import table

PARAMS = EvalParams()
BLEU_KEYWORDS = ["the", "der", "die", "le", "la", "et", "in", "."]

PAIRS_SQL = """
pairs AS (
  SELECT example_id, 'base' AS candidate, reference_middle AS ref, base_generated_middle AS pred FROM generations
  UNION ALL SELECT example_id, 'lora', reference_middle, lora_generated_middle FROM generations)"""

SIMPLE_SQL = r"""
simple AS (
  SELECT example_id, candidate,
    (regexp_replace(trim(ref), '\s+', ' ', 'g') = regexp_replace(trim(pred), '\s+', ' ', 'g'))::INTEGER::DOUBLE AS exact_match,
    CASE WHEN ref <> '' AND list_transform(string_split(ref, chr(10))[1:2], lambda x: rtrim(x))
              = list_transform(string_split(pred, chr(10))[1:len(string_split(ref, chr(10))[1:2])], lambda x: rtrim(x))
         THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS line_match,
    -- distance on one-byte stand-ins for the distinct characters of the pair
    1 - levenshtein(
          array_to_string(list_transform(string_split(pred, ''), lambda c: chr(list_position(seen, c)::INTEGER)), ''),
          array_to_string(list_transform(string_split(ref, ''), lambda c: chr(list_position(seen, c)::INTEGER)), ''))
        / greatest(length(ref), length(pred))::DOUBLE AS edit_similarity
  FROM (SELECT *, list_distinct(string_split(ref || pred, '')) AS seen FROM pairs))"""

GRAMS_SQL = f"""
toks AS (
  SELECT example_id, candidate, regexp_extract_all(ref, '{Q.WORD}') AS r, regexp_extract_all(pred, '{Q.WORD}') AS p FROM pairs),
pred_grams AS (
  SELECT example_id, candidate, n, gram, count(*) AS k FROM (
    SELECT example_id, candidate, n, unnest(list_transform(range(1, len(p) - n + 2), lambda i: array_to_string(p[i:i + n - 1], chr(1)))) AS gram
    FROM toks, range(1, 5) s(n)) GROUP BY ALL),
ref_grams AS (
  SELECT example_id, candidate, n, gram, count(*) AS k FROM (
    SELECT example_id, candidate, n, unnest(list_transform(range(1, len(r) - n + 2), lambda i: array_to_string(r[i:i + n - 1], chr(1)))) AS gram
    FROM toks, range(1, 5) s(n)) GROUP BY ALL),
hits AS (
  SELECT example_id, candidate, n, sum(least(pg.k, rg.k)) AS h,
         sum(least(pg.k, rg.k) * CASE WHEN gram IN ('the','der','die','le','la','et','in','.') THEN 1.0::DOUBLE ELSE 0.2::DOUBLE END) AS weighted
  FROM pred_grams pg JOIN ref_grams rg USING (example_id, candidate, n, gram) GROUP BY ALL),
logs AS (
  SELECT t.example_id, t.candidate, len(p) AS np, len(r) AS nr, s.n, coalesce(h, 0) AS h, coalesce(weighted, 0) AS weighted,
         ln(CASE WHEN coalesce(h, 0) = 0 THEN 0.1::DOUBLE ELSE h END / greatest(len(p) - s.n + 1, 1)) AS precision_log,
         ln(CASE WHEN s.n = 1 THEN CASE WHEN coalesce(weighted, 0) = 0 THEN 0.1::DOUBLE ELSE weighted END
                 ELSE CASE WHEN coalesce(h, 0) = 0 THEN 0.1::DOUBLE ELSE h END END
            / CASE WHEN s.n = 1 THEN CASE WHEN len(r) = 0 THEN 1 ELSE list_sum(list_transform(r, lambda x:
                     CASE WHEN x IN ('the','der','die','le','la','et','in','.') THEN 1.0::DOUBLE ELSE 0.2::DOUBLE END)) END
                   ELSE greatest(len(r) - s.n + 1, 1) END) AS recall_log
  FROM toks t CROSS JOIN range(1, 5) s(n) LEFT JOIN hits x ON x.example_id = t.example_id AND x.candidate = t.candidate AND x.n = s.n),
bleus AS (
  SELECT example_id, candidate,
    CASE WHEN max(h) FILTER (WHERE n = 1) = 0 THEN 0.0::DOUBLE
         ELSE CASE WHEN np > nr THEN 1.0::DOUBLE ELSE exp(1 - nr / np::DOUBLE) END * exp(sum(0.25::DOUBLE * precision_log)) END AS sentencebleu,
    CASE WHEN max(weighted) FILTER (WHERE n = 1) = 0 THEN 0.0::DOUBLE
         ELSE CASE WHEN np > nr THEN 1.0::DOUBLE ELSE exp(1 - nr / np::DOUBLE) END * exp(sum(0.25::DOUBLE * recall_log)) END AS keyword_bleu
  FROM logs GROUP BY example_id, candidate, np, nr)"""

PAIRS = Q.with_(D.GENERATIONS_SQL, PAIRS_SQL, SIMPLE_SQL)
BLEUS = Q.with_(D.GENERATIONS_SQL, PAIRS_SQL, GRAMS_SQL)

SCORES_SQL = """
score_rows AS (
  SELECT g.*,
    b.sentencebleu AS base_sentencebleu, l.sentencebleu AS lora_sentencebleu,
    bs.exact_match AS base_exact_match, ls.exact_match AS lora_exact_match,
    bs.line_match AS base_line_match, ls.line_match AS lora_line_match,
    bs.edit_similarity AS base_edit_similarity, ls.edit_similarity AS lora_edit_similarity
  FROM generations g
  JOIN bleus b ON b.example_id = g.example_id AND b.candidate = 'base'
  JOIN bleus l ON l.example_id = g.example_id AND l.candidate = 'lora'
  JOIN simple bs ON bs.example_id = g.example_id AND bs.candidate = 'base'
  JOIN simple ls ON ls.example_id = g.example_id AND ls.candidate = 'lora'),
long_scores AS (
  SELECT example_id, 'sentencebleu' AS metric, true AS higher, false AS is_binary, base_sentencebleu AS base, lora_sentencebleu AS lora FROM score_rows
  UNION ALL SELECT example_id, 'exact_match', true, true, base_exact_match, lora_exact_match FROM score_rows
  UNION ALL SELECT example_id, 'line_match', true, true, base_line_match, lora_line_match FROM score_rows
  UNION ALL SELECT example_id, 'perplexity', false, false, base_perplexity, lora_perplexity FROM score_rows
  UNION ALL SELECT example_id, 'edit_similarity', true, false, base_edit_similarity, lora_edit_similarity FROM score_rows),
summary AS (
  SELECT metric, higher, is_binary, count(*) AS n, avg(base) AS base_average, avg(lora) AS lora_average,
         CASE WHEN higher THEN avg(lora) - avg(base) ELSE avg(base) - avg(lora) END AS improvement
  FROM long_scores GROUP BY metric, higher, is_binary)"""
SCORES = Q.with_(D.GENERATIONS_SQL, PAIRS_SQL, SIMPLE_SQL, GRAMS_SQL, SCORES_SQL)

# Code for prose, and CodeBLEU beside the others.
SCORES_ALL_SQL = (
    SCORES_SQL.replace("SELECT g.*,", "SELECT g.*, bc.valid AS codebleu_valid, bc.codebleu AS base_codebleu, lc.codebleu AS lora_codebleu,")
    .replace("JOIN bleus b ON", """JOIN code_scores bc ON bc.example_id = g.example_id AND bc.candidate = 'base'
  JOIN code_scores lc ON lc.example_id = g.example_id AND lc.candidate = 'lora'
  JOIN bleus b ON""")
    .replace("long_scores AS (", """long_scores AS (
  SELECT example_id, 'codebleu' AS metric, true AS higher, false AS is_binary, base_codebleu AS base, lora_codebleu AS lora
  FROM score_rows WHERE codebleu_valid
  UNION ALL """)
)
SCORES_ALL = Q.with_(
    D.CODE_GENERATIONS_SQL, PAIRS_SQL, SIMPLE_SQL, GRAMS_SQL, "code_pairs AS (SELECT * FROM pairs)", code_scores_sql("c"), SCORES_ALL_SQL
)
SQL_METRICS = ["sentencebleu", "exact_match", "line_match", "perplexity", "edit_similarity"]


def generation_rows(spark, folder):
    return Score.generations(*D.generation_sides(spark, folder))


def candidate_rows(spark, folder):
    return generation_rows(spark, folder).select(
        "example_id",
        F.col("reference_middle").alias("ref"),
        F.inline(
            F.array(
                *[
                    F.struct(F.lit(c).alias("candidate"), F.col(f"{c}_generated_middle").alias("pred"))
                    for c in Score.CANDIDATES
                ]
            )
        ),
    )


def one_score(spark, folder, name, column):
    return candidate_rows(spark, folder).select("example_id", "candidate", F.round(column, 6).alias(name))


@query(
    "join_generations",
    Q.with_(D.GENERATIONS_SQL)
    + """SELECT example_id, reference_middle, base_generated_middle, lora_generated_middle,
         round(base_perplexity, 9) AS base_perplexity, round(lora_perplexity, 9) AS lora_perplexity FROM generations""",
)
def join_generations(spark, folder):
    rows = generation_rows(spark, folder)
    return rows.withColumn("base_perplexity", F.round("base_perplexity", 9)).withColumn(
        "lora_perplexity", F.round("lora_perplexity", 9)
    )


@query("exact_match", PAIRS + "SELECT example_id, candidate, exact_match FROM simple")
def exact_match(spark, folder):
    return one_score(spark, folder, "exact_match", M.exact_match("ref", "pred"))


@query("line_match", PAIRS + "SELECT example_id, candidate, line_match FROM simple")
def line_match(spark, folder):
    return one_score(spark, folder, "line_match", M.line_match("ref", "pred", 2))


@query("edit_similarity", PAIRS + "SELECT example_id, candidate, round(edit_similarity, 6) AS edit_similarity FROM simple")
def edit_similarity(spark, folder):
    return one_score(spark, folder, "edit_similarity", M.edit_similarity("ref", "pred"))


@query("sentence_bleu", BLEUS + "SELECT example_id, candidate, round(sentencebleu, 6) AS sentencebleu FROM bleus")
def sentence_bleu(spark, folder):
    return one_score(spark, folder, "sentencebleu", M.sentence_bleu("ref", "pred"))


@query("keyword_bleu", BLEUS + "SELECT example_id, candidate, round(keyword_bleu, 6) AS keyword_bleu FROM bleus")
def keyword_bleu(spark, folder):
    score = M.keyword_bleu("ref", "pred", BLEU_KEYWORDS)
    return one_score(spark, folder, "keyword_bleu", score)


def score_table(spark, folder):
    return Score.score_rows(generation_rows(spark, folder), PARAMS)


def code_generation_rows(spark, folder):
    return Score.generations(*D.code_generation_sides(spark, folder))


def code_score_table(spark, folder):
    return Score.score_rows(code_generation_rows(spark, folder), PARAMS)


def long_rows(spark, folder, metrics=SQL_METRICS):
    """Prose with five metrics, or code with all six where ``metrics`` is None."""
    scores = score_table(spark, folder) if metrics else code_score_table(spark, folder)
    return Score.scores_long(scores, metrics=metrics)


@query(
    "score_rows",
    SCORES
    + "SELECT example_id, "
    + ", ".join(f"round({c}_{m}, 6) AS {c}_{m}" for c in ("base", "lora") for m in SQL_METRICS)
    + " FROM score_rows",
)
def score_rows(spark, folder):
    scores = score_table(spark, folder)
    return scores.select(
        "example_id", *[F.round(f"{c}_{m}", 6).alias(f"{c}_{m}") for c in Score.CANDIDATES for m in SQL_METRICS]
    )


BRACED_CODE_SQL = r"""
code_rows AS (
  SELECT n.file_id::VARCHAR || ':' || n.node_id::VARCHAR AS example_id,
         decode(unhex(substr(hex(encode(f.text)), 2 * n.start_byte + 1, 2 * (n.end_byte - n.start_byte)))) AS code
  FROM brace_nodes n JOIN braced f USING (file_id) WHERE n.type = 'definition' AND n.depth <= 2),
code_pairs AS (
  SELECT example_id, 'base' AS candidate, code AS ref, replace(code, 'k', 'j') AS pred FROM code_rows
  UNION ALL SELECT example_id, 'lora', code, regexp_replace(code, '(?s)for .*', 'return n;' || chr(10) || '}') FROM code_rows)"""


@query(
    "codebleu_rows",
    Q.with_(D.BRACED_SQL, brace_sql("braced"), BRACED_CODE_SQL, code_scores_sql("c"))
    + """SELECT example_id, bool_and(valid) AS codebleu_valid,
         round(max(codebleu) FILTER (WHERE candidate = 'base'), 6) AS base_codebleu,
         round(max(codebleu) FILTER (WHERE candidate = 'lora'), 6) AS lora_codebleu FROM code_scores GROUP BY example_id""",
)
def codebleu_rows(spark, folder):
    """CodeBLEU on the derived C-like corpus: each function against itself with the loop
    variable renamed, and against itself cut off at the loop."""
    files = with_brace_nodes(D.braced_files(spark, folder))
    blocks = file_blocks(files, "brace", FimParams(max_code_blocks_ast_depth=2), nodes=True)
    code = F.col("code").cast("string")
    rows = blocks.select(
        F.concat_ws(":", F.col("file_id").cast("string"), F.col("block_id").cast("string")).alias("example_id"),
        code.alias("reference_middle"),
        F.replace(code, F.lit("k"), F.lit("j")).alias("base_generated_middle"),
        F.regexp_replace(code, r"(?s)for .*", "return n;\n}").alias("lora_generated_middle"),
    )
    scored = with_codebleu(
        rows,
        "reference_middle",
        {f"{c}_codebleu": f"{c}_generated_middle" for c in Score.CANDIDATES},
        "c",
    )
    return scored.select(
        "example_id", "codebleu_valid", *[F.round(f"{c}_codebleu", 6).alias(f"{c}_codebleu") for c in Score.CANDIDATES]
    )


# ---------------------------------------------------------------- summary


def rounded(df, *columns):
    for c in columns:
        df = df.withColumn(c, F.round(c, 6))
    return df


@query(
    "metric_summary",
    SCORES
    + """SELECT metric, n, round(base_average, 6) AS base_average, round(lora_average, 6) AS lora_average, is_binary,
         higher AS higher_is_better FROM summary""",
)
def metric_summary(spark, folder, metrics=SQL_METRICS):
    summary = Summary.metric_summary(long_rows(spark, folder, metrics))
    return rounded(
        summary.select("metric", "n", "base_average", "lora_average", "is_binary", "higher_is_better"),
        "base_average",
        "lora_average",
    )


@query(
    "improvement",
    SCORES
    + """SELECT metric, round(improvement, 6) AS improvement, round(improvement / nullif(abs(base_average), 0) * 100, 6) AS improvement_pct
         FROM summary""",
)
def improvement(spark, folder, metrics=SQL_METRICS):
    summary = Summary.metric_summary(long_rows(spark, folder, metrics))
    return rounded(summary.select("metric", "improvement", "improvement_pct"), "improvement", "improvement_pct")


@query(
    "valid_only_average",
    """SELECT 'codebleu' AS metric, count(*) AS n, round(avg(quality), 6) AS base_average, round(avg(toxic), 6) AS lora_average
       FROM labels WHERE coalesce(CASE WHEN doc_id % 3 = 0 THEN NULL ELSE doc_id % 2 = 0 END, true)
       UNION ALL SELECT 'exact_match', count(*), round(avg(quality), 6), round(avg(toxic), 6) FROM labels""",
)
def valid_only_average(spark, folder):
    """Validity applies to one metric only; a missing flag counts as valid."""
    flag = F.when(F.col("doc_id") % 3 != 0, F.col("doc_id") % 2 == 0)
    wide = table(spark, folder, "labels").select(
        F.col("doc_id").alias("example_id"),
        flag.alias("codebleu_valid"),
        *[F.col(src).alias(f"{c}_{m}") for c, src in (("base", "quality"), ("lora", "toxic")) for m in ("codebleu", "exact_match")],
    )
    summary = Summary.metric_summary(Score.scores_long(wide))
    return rounded(summary.select("metric", "n", "base_average", "lora_average"), "base_average", "lora_average")


@query(
    "metric_registry",
    SCORES + "SELECT DISTINCT metric, higher AS higher_is_better, is_binary FROM long_scores",
)
def metric_registry(spark, folder, metrics=SQL_METRICS):
    present = long_rows(spark, folder, metrics).select("metric").distinct()
    return Summary.with_registry(present).select("metric", "higher_is_better", "is_binary")


@query(
    "win_tie_loss",
    """SELECT 'exact_match' AS metric, count(*) FILTER (WHERE toxic = 1 AND quality = 0) AS wins,
       count(*) - count(*) FILTER (WHERE toxic = 1 AND quality = 0) - count(*) FILTER (WHERE toxic = 0 AND quality = 1) AS ties,
       count(*) FILTER (WHERE toxic = 0 AND quality = 1) AS losses, count(*) AS n FROM labels""",
)
def win_tie_loss(spark, folder):
    outcomes = table(spark, folder, "labels").select(
        F.lit("exact_match").alias("metric"), F.col("quality").alias("base"), F.col("toxic").alias("lora")
    )
    return Summary.win_tie_loss(outcomes)


@query(
    "five_number",
    SCORES
    + """, tall AS (SELECT metric, 'base' AS candidate, base AS score FROM long_scores UNION ALL SELECT metric, 'lora', lora FROM long_scores),
    q AS (SELECT metric, candidate, quantile_cont(score, [0, 0.25, 0.5, 0.75, 1]) AS v FROM tall GROUP BY metric, candidate)
    SELECT metric, candidate, round(v[1], 6) AS minimum, round(v[2], 6) AS q1, round(v[3], 6) AS median, round(v[4], 6) AS q3,
           round(v[5], 6) AS maximum, round(v[2] - 1.5 * (v[4] - v[2]), 6) AS low_fence, round(v[4] + 1.5 * (v[4] - v[2]), 6) AS high_fence FROM q""",
)
def five_number(spark, folder, metrics=SQL_METRICS):
    stats = Summary.five_number(long_rows(spark, folder, metrics))
    return rounded(stats, "minimum", "q1", "median", "q3", "maximum", "low_fence", "high_fence")


@query(
    "diff_hist",
    SCORES
    + """, d AS (SELECT metric, CASE WHEN higher THEN lora - base ELSE base - lora END AS x FROM long_scores),
    span AS (SELECT metric, CASE WHEN min(x) = max(x) THEN min(x) - 0.5 ELSE min(x) END AS low,
                    CASE WHEN min(x) = max(x) THEN max(x) + 0.5 ELSE max(x) END AS high FROM d GROUP BY metric),
    binned AS (SELECT metric, least(floor((x - low) / ((high - low) / 30))::INTEGER, 29) AS bin FROM d JOIN span USING (metric))
    SELECT s.metric, b.bin::INTEGER AS bin, round(low + b.bin * ((high - low) / 30), 6) AS left_edge, count(x.bin) AS n,
           (SELECT count(*) FILTER (WHERE d.x IS NULL OR isinf(d.x) OR isnan(d.x)) FROM d WHERE d.metric = s.metric) AS non_finite
    FROM span s CROSS JOIN range(30) b(bin) LEFT JOIN binned x ON x.metric = s.metric AND x.bin = b.bin GROUP BY s.metric, b.bin, low, high""",
)
def diff_hist(spark, folder, metrics=SQL_METRICS):
    return rounded(Summary.difference_histogram(long_rows(spark, folder, metrics)), "left_edge")


@query(
    "diff_summary",
    SCORES
    + """SELECT metric, round(avg(CASE WHEN higher THEN lora - base ELSE base - lora END), 6) AS mean_difference,
         round(greatest(max(base), max(lora)), 6) AS max_score,
         round(CASE WHEN greatest(max(base), max(lora)) > 25 THEN 25.0::DOUBLE ELSE greatest(max(base), max(lora)) * 1.1::DOUBLE END, 6) AS display_bound
         FROM long_scores WHERE NOT is_binary GROUP BY metric""",
)
def diff_summary(spark, folder, metrics=SQL_METRICS):
    return rounded(
        Summary.difference_summary(long_rows(spark, folder, metrics)), "mean_difference", "max_score", "display_bound"
    )


@query(
    "paired_scores",
    SCORES
    + """SELECT example_id, metric, round(base, 6) AS base, round(lora, 6) AS lora,
         CASE WHEN abs(lora - base) < 1e-12 THEN 'tie' WHEN lora > base THEN 'above' ELSE 'below' END AS side FROM long_scores""",
)
def paired_scores(spark, folder, metrics=SQL_METRICS):
    return rounded(Summary.paired_scores(long_rows(spark, folder, metrics)), "base", "lora")


@query(
    "metrics_long",
    SCORES
    + """SELECT 'evaluate.' || metric || '.base' AS name, round(base_average, 6) AS value FROM summary
         UNION ALL SELECT 'evaluate.' || metric || '.lora', round(lora_average, 6) FROM summary
         UNION ALL SELECT 'evaluate.' || metric || '.improvement', round(improvement, 6) FROM summary""",
)
def metrics_long(spark, folder, metrics=SQL_METRICS):
    return rounded(Summary.metric_rows(Summary.metric_summary(long_rows(spark, folder, metrics))), "value")


@query("report_json")
def report_json(spark, folder):
    stamp = F.lit("2024-01-01T00:00:00")
    return Summary.report_json(Summary.metric_summary(long_rows(spark, folder, None)), "checkpoint-1", stamp)


# The same summaries over generations of code, with CodeBLEU and its validity.


@query(
    "score_rows_all",
    SCORES_ALL
    + "SELECT example_id, codebleu_valid, "
    + ", ".join(f"round({c}_{m}, 6) AS {c}_{m}" for c in Score.CANDIDATES for m, _, _ in Score.METRICS)
    + " FROM score_rows",
)
def score_rows_all(spark, folder):
    names = [f"{c}_{m}" for c in Score.CANDIDATES for m, _, _ in Score.METRICS]
    return code_score_table(spark, folder).select("example_id", "codebleu_valid", *[F.round(n, 6).alias(n) for n in names])


def _all_metrics(of):
    sql = ORACLES[of.__name__].removeprefix(SCORES)
    query(f"{of.__name__}_all", SCORES_ALL + sql)(lambda spark, folder: of(spark, folder, metrics=None))


for _of in (metric_summary, improvement, metric_registry, five_number, diff_hist, diff_summary, paired_scores, metrics_long):
    _all_metrics(_of)


# ---------------------------------------------------------------- volume checks


@query(
    "price_quantiles",
    """SELECT l_returnflag, q, round(quantile, 4) AS value FROM (
         SELECT l_returnflag, unnest([0, 0.25, 0.5, 0.75, 1])::DOUBLE AS q,
                unnest(quantile_cont(l_extendedprice::DOUBLE, [0, 0.25, 0.5, 0.75, 1])) AS quantile
         FROM lineitem GROUP BY l_returnflag)""",
)
def price_quantiles(spark, folder):
    prices = table(spark, folder, "lineitem").select("l_returnflag", F.col("l_extendedprice").cast("double").alias("price"))
    stats = Summary.order_statistics(prices, ["l_returnflag"], "price", [0.0, 0.25, 0.5, 0.75, 1.0])
    return stats.select("l_returnflag", "q", F.round("value", 4).alias("value"))


@query(
    "quantity_hist",
    """WITH span AS (SELECT min(l_quantity)::DOUBLE AS low, max(l_quantity)::DOUBLE AS high FROM lineitem),
    binned AS (SELECT least(floor((l_quantity::DOUBLE - low) / ((high - low) / 50))::INTEGER, 49) AS bin FROM lineitem, span)
    SELECT b.bin::INTEGER AS bin, round(low + b.bin * ((high - low) / 50), 6) AS left_edge, count(x.bin) AS n,
           (SELECT count(*) FILTER (WHERE l_quantity IS NULL) FROM lineitem) AS non_finite
    FROM range(50) b(bin) CROSS JOIN span LEFT JOIN binned x ON x.bin = b.bin GROUP BY b.bin, low, high""",
)
def quantity_hist(spark, folder):
    quantity = table(spark, folder, "lineitem").select(F.col("l_quantity").cast("double").alias("quantity"))
    return rounded(Summary.observed_histogram(quantity, [], "quantity", 50), "left_edge")


# ---------------------------------------------------------------- logs

HISTORY = Q.with_(D.HISTORY_SQL)


@query(
    "perplexity",
    """SELECT user_id AS example_id, round(coalesce(exp(avg(value / 100.0::DOUBLE) FILTER (WHERE event_type <> 'view')), 'inf'::DOUBLE), 6) AS perplexity
       FROM events GROUP BY user_id""",
)
def perplexity(spark, folder):
    return rounded(Log.example_perplexity(D.token_logprobs(spark, folder)), "perplexity")


@query(
    "train_log_split",
    HISTORY + "SELECT run_id, step, kind, loss, round(epoch, 6) AS epoch, round(learning_rate, 9) AS learning_rate FROM train_log",
)
def train_log_split(spark, folder):
    log = Log.split_log(D.training_history(spark, folder))
    return log.withColumn("epoch", F.round("epoch", 6)).withColumn("learning_rate", F.round("learning_rate", 9))


@query("loss_curve", HISTORY + "SELECT run_id, kind, step, loss FROM train_log")
def loss_curve(spark, folder):
    return Log.loss_curve(Log.split_log(D.training_history(spark, folder)))


@query(
    "best_checkpoint",
    HISTORY
    + "SELECT run_id, arg_min(step, (loss, step)) AS step, min(loss) AS loss FROM train_log WHERE kind = 'eval' GROUP BY run_id",
)
def best_checkpoint(spark, folder):
    return Log.best_checkpoint(Log.split_log(D.training_history(spark, folder)))


@query(
    "last_checkpoint",
    "SELECT user_id AS run_id, 'checkpoint-' || max(event_id)::VARCHAR AS name, max(event_id) AS step FROM events GROUP BY user_id",
)
def last_checkpoint(spark, folder):
    names = table(spark, folder, "events").select(
        F.col("user_id").alias("run_id"), F.concat(F.lit("checkpoint-"), F.col("event_id").cast("string")).alias("name")
    )
    return Log.last_checkpoint(names, ["run_id"])

