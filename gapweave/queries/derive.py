"""Inputs that Spark derives from the given tables, with the same derivation in SQL."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from gapweave.functions.keys import draw_below, shuffle_key
from gapweave.sources.tables import document_files, table

STRUCTURE_WORDS = ["FUNCTION_BLOCK", "FUNCTION", "PROGRAM", "METHOD"]


def _number(i: Column) -> Column:
    return i.cast("string")


def structured_files(spark: SparkSession, folder: str) -> DataFrame:
    """Every document line as the body of a commented keyword structure."""
    words = F.array(*[F.lit(w) for w in STRUCTURE_WORDS])

    def block(line: Column, i: Column) -> Column:
        word = F.get(words, (i % len(STRUCTURE_WORDS)).cast("int"))
        return F.concat(
            word, F.lit(" B"), _number(i), F.lit("\n(* note\n "), _number(i), F.lit(" *)\n  "), line,
            F.lit("   \n\n\n\n  x := "), _number(i), F.lit("; // end\nEND_"), word, F.lit("\n"),
        )

    text = F.array_join(F.transform(F.split("text", "\n"), block), "\n")
    return document_files(spark, folder).withColumn("text", text).withColumn("content", F.encode("text", "UTF-8"))


STRUCTURED_SQL = r"""
structured AS (
  SELECT doc_id AS file_id, array_to_string(list_transform(string_split(text, chr(10)), lambda line, i:
    ['FUNCTION_BLOCK','FUNCTION','PROGRAM','METHOD'][((i - 1) % 4) + 1] || ' B' || (i - 1)::VARCHAR || chr(10)
    || '(* note' || chr(10) || ' ' || (i - 1)::VARCHAR || ' *)' || chr(10) || '  ' || line
    || '   ' || chr(10) || chr(10) || chr(10) || chr(10) || '  x := ' || (i - 1)::VARCHAR || '; // end' || chr(10)
    || 'END_' || ['FUNCTION_BLOCK','FUNCTION','PROGRAM','METHOD'][((i - 1) % 4) + 1] || chr(10)), chr(10)) AS text
  FROM documents)
"""

CLEAN_SQL = r"""
cleaned AS (
  SELECT file_id, regexp_replace(regexp_replace(
      array_to_string(list_transform(string_split(
        regexp_replace(regexp_replace(text, '(?s)\(\*.*?\*\)', '', 'g'), '//[^\n]*', '', 'g'), chr(10)),
        lambda line: regexp_replace(line, '\s+$', '')), chr(10)),
      '\n{3,}', chr(10) || chr(10), 'g'), '^\s+|\s+$', '', 'g') AS text
  FROM structured)
"""


def braced_files(spark: SparkSession, folder: str) -> DataFrame:
    """Every document line as a comment and a string literal inside a small C-like function."""

    def function(line: Column, i: Column) -> Column:
        return F.concat(
            F.lit("int f"), _number(i), F.lit("(int n) {\n  // { "), line, F.lit('\n  char *s = "} '), line,
            F.lit('";\n  for (int k = 0; k < '), _number(i), F.lit("; k++) { n += k; }\n  return n;\n}\n"),
        )

    text = F.array_join(F.transform(F.split("text", "\n"), function), "\n")
    return document_files(spark, folder).withColumn("text", text).withColumn("content", F.encode("text", "UTF-8"))


BRACED_SQL = r"""
braced AS (
  SELECT doc_id AS file_id, array_to_string(list_transform(string_split(text, chr(10)), lambda line, i:
    'int f' || (i - 1)::VARCHAR || '(int n) {' || chr(10) || '  // { ' || line || chr(10) || '  char *s = "} ' || line
    || '";' || chr(10) || '  for (int k = 0; k < ' || (i - 1)::VARCHAR || '; k++) { n += k; }' || chr(10)
    || '  return n;' || chr(10) || '}' || chr(10)), chr(10)) AS text
  FROM documents)
"""


def indented_files(spark: SparkSession, folder: str) -> DataFrame:
    """Every document line as a comment and a string inside a small Python-like class."""

    def definition(line: Column, i: Column) -> Column:
        n = _number(i)
        return F.concat(
            F.lit("class C"), n, F.lit(":\n    def f"), n, F.lit('(self, n):\n        """'), line, F.lit("\n  {(\n\"\"\"\n  # "), line,
            F.lit("\n        for k in range(0,\n  n):\n\n            if k == "), n,
            F.lit(":\n\n\t\tself.s += k\n            else:\n                self.g(k)\n        return n\n\nx = C"), n, F.lit("()\n"),
        )

    text = F.array_join(F.transform(F.split("text", "\n"), definition), "\n")
    return document_files(spark, folder).withColumn("text", text).withColumn("content", F.encode("text", "UTF-8"))


INDENTED_SQL = r"""
indented AS (
  SELECT doc_id AS file_id, array_to_string(list_transform(string_split(text, chr(10)), lambda line, i:
    'class C' || (i - 1)::VARCHAR || ':' || chr(10) || '    def f' || (i - 1)::VARCHAR || '(self, n):' || chr(10) || '        '
    || repeat('"', 3) || line || chr(10) || '  {(' || chr(10) || repeat('"', 3) || chr(10) || '  # ' || line || chr(10)
    || '        for k in range(0,' || chr(10) || '  n):' || chr(10) || chr(10) || '            if k == ' || (i - 1)::VARCHAR || ':' || chr(10)
    || chr(10) || chr(9) || chr(9) || 'self.s += k' || chr(10) || '            else:' || chr(10) || '                self.g(k)' || chr(10)
    || '        return n' || chr(10) || chr(10) || 'x = C' || (i - 1)::VARCHAR || '()' || chr(10)), chr(10)) AS text
  FROM documents)
"""


def damaged_files(spark: SparkSession, folder: str) -> DataFrame:
    """Documents with DOS line ends; about one in sixteen gets bytes that are not UTF-8."""
    files = document_files(spark, folder)
    damaged = F.startswith(shuffle_key("damage", 0, F.col("file_id")), F.lit("f"))
    dos = F.encode(F.replace(F.col("text"), F.lit("\n"), F.lit("\r\n")), "UTF-8")
    return files.withColumn(
        "content", F.when(damaged, F.concat(F.unhex(F.lit("FFFE80")), dos)).otherwise(dos)
    )


def generation_sides(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """References and two candidate tables from ``conversations``.

    The reference is an assistant turn, the base candidate the message before it, the tuned
    candidate the reference with one letter pair changed.
    """
    talk = table(spark, folder, "conversations")
    # Both columns make the key; as digits of one number they could run into each other.
    turn_id = F.concat_ws(":", F.col("conv_id").cast("string"), F.col("turn").cast("string"))
    next_id = F.concat_ws(":", F.col("conv_id").cast("string"), (F.col("turn") + 1).cast("string"))
    replies = talk.where(F.col("role") == "assistant").select(turn_id.alias("example_id"), "text")
    references = replies.select("example_id", F.col("text").alias("reference_middle"))
    base = talk.select(
        next_id.alias("example_id"),
        F.col("text").alias("generated_middle"),
        F.exp(F.octet_length("text") / 1000.0).alias("perplexity"),
    )
    lora = replies.select(
        "example_id",
        F.replace("text", F.lit("en"), F.lit("an")).alias("generated_middle"),
        F.exp(F.octet_length("text") / 2000.0).alias("perplexity"),
    )
    return references, base, lora


GENERATIONS_SQL = r"""
generations AS (
  SELECT r.conv_id::VARCHAR || ':' || r.turn::VARCHAR AS example_id, r.text AS reference_middle,
         b.text AS base_generated_middle, replace(r.text, 'en', 'an') AS lora_generated_middle,
         exp(strlen(b.text) / 1000.0::DOUBLE) AS base_perplexity, exp(strlen(r.text) / 2000.0::DOUBLE) AS lora_perplexity
  FROM conversations r JOIN conversations b ON b.conv_id = r.conv_id AND b.turn = r.turn - 1
  WHERE r.role = 'assistant')
"""


def code_generation_sides(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """``generation_sides`` with the messages as comments in C functions, which differ by the message's length.

    Every fifth length leaves the bare message, which is no code.  The base candidate is the
    function of the message before, the tuned one the reference with another assignment.
    """

    def function(text: Column) -> Column:
        size = F.length(text)
        code = F.concat(
            F.lit("int total(int n) {\n  int s = 0;\n  // "), F.replace(text, F.lit("\n"), F.lit(" ")),
            F.when(size % 2 == 0, "\n  if (s > n) { return n; }").otherwise(""),
            F.lit("\n  for (int k = 0; k < "), size.cast("string"), F.lit("; k++) { s += k; }\n  return s;\n}"),
        )
        return F.when(size % 5 == 0, text).otherwise(code)

    references, base, lora = generation_sides(spark, folder)
    message = lambda df: df.withColumn("generated_middle", function(F.col("generated_middle")))
    changed = F.replace(function(F.col("reference_middle")), F.lit("s += k"), F.lit("s = n"))
    return (
        references.withColumn("reference_middle", function(F.col("reference_middle"))),
        message(base),
        lora.join(references, "example_id").select("example_id", changed.alias("generated_middle"), "perplexity"),
    )


_FUNCTION_SQL = r"""CASE WHEN length({t}) % 5 = 0 THEN {t} ELSE 'int total(int n) {{' || chr(10) || '  int s = 0;' || chr(10) || '  // '
    || replace({t}, chr(10), ' ') || CASE WHEN length({t}) % 2 = 0 THEN chr(10) || '  if (s > n) {{ return n; }}' ELSE '' END
    || chr(10) || '  for (int k = 0; k < ' || length({t})::VARCHAR || '; k++) {{ s += k; }}' || chr(10) || '  return s;' || chr(10) || '}}' END"""

CODE_GENERATIONS_SQL = (
    GENERATIONS_SQL.replace("generations AS", "messages AS")
    + f""", generations AS (
  SELECT example_id, {_FUNCTION_SQL.format(t='reference_middle')} AS reference_middle,
         {_FUNCTION_SQL.format(t='base_generated_middle')} AS base_generated_middle,
         replace({_FUNCTION_SQL.format(t='reference_middle')}, 's += k', 's = n') AS lora_generated_middle,
         base_perplexity, lora_perplexity FROM messages)
"""
)


def training_history(spark: SparkSession, folder: str) -> DataFrame:
    """``events`` as log history: user = run, event number = step, value = train or eval loss."""
    kind, value = F.col("event_type"), F.col("value")
    return table(spark, folder, "events").select(
        F.col("user_id").alias("run_id"),
        F.col("event_id").alias("step"),
        F.when(kind.isin("click", "view", "signup"), value).alias("loss"),
        F.when(kind == "error", value).alias("eval_loss"),
        (F.col("event_id") / 1000.0).alias("epoch"),
        F.when(kind != "error", value / 100000.0).alias("learning_rate"),
    )


HISTORY_SQL = r"""
history AS (
  SELECT user_id AS run_id, event_id AS step,
         CASE WHEN event_type IN ('click','view','signup') THEN value END AS loss,
         CASE WHEN event_type = 'error' THEN value END AS eval_loss,
         event_id / 1000.0::DOUBLE AS epoch,
         CASE WHEN event_type <> 'error' THEN value / 100000.0::DOUBLE END AS learning_rate
  FROM events),
train_log AS (
  SELECT run_id, step, CASE WHEN loss IS NOT NULL THEN 'train' ELSE 'eval' END AS kind,
         coalesce(loss, eval_loss) AS loss, epoch, CASE WHEN loss IS NOT NULL THEN learning_rate END AS learning_rate
  FROM history WHERE loss IS NOT NULL OR eval_loss IS NOT NULL)
"""


def token_logprobs(spark: SparkSession, folder: str) -> DataFrame:
    """``events`` as scored tokens: user = example, masked where the event is a view."""
    return table(spark, folder, "events").select(
        F.col("user_id").alias("example_id"),
        (-F.col("value") / 100.0).alias("logprob"),
        (F.col("event_type") == "view").alias("masked"),
    )


def random_share(salt: str, *ids: str) -> Column:
    return draw_below(shuffle_key(salt, 0, *[F.col(i) for i in ids]), F.lit(100))
