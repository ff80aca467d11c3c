"""Mixing sources to target weights by Pareto order sampling.

A source's target is its share of all words by weight, at most ``MOST_COPIES`` times its size
(what it can't take goes to the others by weight).  A source whose target is f times its size
first gets floor(f) whole copies of every document.  The rest is a sample of fixed size without
replacement: documents are ranked by their random odds divided by their inclusion odds, and the
first ones are taken until the words are reached; the document on the border gives its first
words only.  Longer documents have larger inclusion odds (``importance``).

The rank is never computed: 65 536 ranges of the ranking variable are summed per source, and
only the range that holds the border is sorted.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from gapweave.llm.common import as_row, row_columns
from gapweave.operators.settle import settle

MOST_COPIES = 3
WEIGHTS = (1, 2, 3)
RANGES = 65536
#: A word is a run of other characters than ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"

#: Inclusion odds grow with the words up to a bound, so that fragments fill fewer places.
IMPORTANCE = "100 + least(size, 2000)"


def word_count(text: Column) -> Column:
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(WORD)).cast("bigint")


def mix_key(doc_id: Column, text: Column) -> Column:
    """Decides about a row; equal rows have equal keys."""
    return F.md5(F.concat_ws(":", F.coalesce(doc_id.cast("string"), F.lit("")), F.md5(F.coalesce(text, F.lit("")))))


def source_targets(measured: DataFrame, weights: tuple[int, ...] = WEIGHTS) -> DataFrame:
    """``source, source_size, target`` and the words of the sample, one row per source.

    The weights repeat over the sources by code point, null last.  The windows see one row per
    source, the mix's configuration.
    """
    whole, by_name = Window.partitionBy(), Window.orderBy(F.col("source").isNull(), "source")
    by_limit = Window.orderBy("limit", "place").rowsBetween(Window.unboundedPreceding, 0)
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), (F.col("place") % len(weights) + 1).cast("int"))
    level = (F.col("total") - F.col("full") + F.col("most")) / (F.col("weights") - F.col("weight_upto") + F.col("weight"))
    return (
        measured.groupBy("source")
        .agg(
            F.sum("size").alias("source_size"),
            F.count(F.lit(1)).alias("docs"),
            F.sum(F.expr(IMPORTANCE)).alias("importance"),
        )
        .withColumn("place", F.row_number().over(by_name) - 1)
        .withColumn("weight", weight)
        .withColumn("most", F.lit(MOST_COPIES) * F.col("source_size"))
        .withColumn("limit", F.col("most") / F.col("weight"))
        .withColumn("total", F.sum("source_size").over(whole))
        .withColumn("weights", F.sum("weight").over(whole))
        .withColumn("full", F.sum("most").over(by_limit))
        .withColumn("weight_upto", F.sum("weight").over(by_limit))
        # Words per weight at which the sources up to this one are full: the first one that
        # leaves nothing over gives the level of all that aren't.
        .withColumn("enough", F.col("full") + F.col("limit") * (F.col("weights") - F.col("weight_upto")) >= F.col("total"))
        .withColumn("level", F.min(F.when(F.col("enough"), F.struct("limit", "place", level.alias("level")))).over(whole)["level"])
        .withColumn("target", F.least(F.col("most").cast("double"), F.coalesce(F.col("level"), F.lit(0.0)) * F.col("weight")))
        .withColumn("words", F.least(F.round("target").cast("bigint"), "most"))
        .withColumn("copies", F.expr("if(source_size = 0, 0, words div source_size)").cast("bigint"))
        .withColumn("rest", F.expr("if(source_size = 0, 0, words % source_size)").cast("bigint"))
        .select("source", "source_size", "target", "docs", "importance", "copies", "rest")
    )


def _order() -> Column:
    """Pareto's ranking variable, mapped to (0, 1); certain documents lie below 0."""
    u = (F.conv(F.substring("key", 1, 12), 16, 10).cast("double") + 0.5) / F.lit(float(1 << 48))
    p = F.col("rest") / F.col("source_size") * F.expr(IMPORTANCE) * F.col("docs") / F.col("importance")
    odds, chance = u / (1 - u), p / (1 - p)
    return F.when(p >= 1, u - 1).otherwise(odds / (odds + chance))


def mix(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``keep`` columns, ``source, key, size, source_size, target, copies, cut, taken`` for every row.

    ``docs`` needs ``doc_id``, ``text`` and ``source``; other columns are ignored unless kept.
    ``taken`` is the number of words that the mix takes of the row: ``copies`` times its size and
    ``cut`` first words.  Null and empty texts have size 0 and give nothing.  Equal rows on the
    border share its words evenly.  Keys are md5 values, so reruns agree.
    """
    text = F.col("text").cast("string")
    columns = [F.col(c).alias(c) for c in keep]
    measured = docs.select(
        *columns, "source", word_count(text).alias("size"), mix_key(F.col("doc_id"), text).alias("key")
    )
    narrow = settle(measured.select("source", "size", "key"))
    sources = settle(source_targets(narrow, weights))
    ordered = _with_source(narrow, sources).where("rest > 0").withColumn("at", _order())
    ranged = ordered.withColumn("range", F.floor(F.col("at") * RANGES))
    sums = ranged.groupBy("source", "range").agg(F.sum("size").alias("size"), F.min("rest").alias("rest"))
    upto = Window.partitionBy("source").orderBy("range").rowsBetween(Window.unboundedPreceding, 0)
    border = (
        sums.withColumn("before", F.sum("size").over(upto) - F.col("size"))
        .where("before <= rest and rest < before + size")
        .select(F.col("source").alias("of"), "range", "before")
    )
    inside = (
        ranged.join(border.withColumnRenamed("range", "border_range"), F.col("of").eqNullSafe(F.col("source")))
        .where("range = border_range")
        .groupBy("source", "before", "rest", "at", "key")
        .agg(F.sum("size").alias("size"), F.count(F.lit(1)).alias("rows"))
    )
    along = Window.partitionBy("source").orderBy("at", "key").rowsBetween(Window.unboundedPreceding, 0)
    cuts = (
        inside.withColumn("before", F.col("before") + F.sum("size").over(along) - F.col("size"))
        .where("before <= rest and rest < before + size")
        .select(
            F.col("source").alias("of"),
            F.struct("at", "key").alias("border"),
            F.expr("(rest - before) div rows").alias("border_words"),
        )
    )
    facts = settle(sources.join(cuts, F.col("of").eqNullSafe(F.col("source")), "left").drop("of"))
    place = F.struct(_order().alias("at"), F.col("key").alias("key"))
    return (
        _with_source(measured, facts)
        .withColumn("place", F.when(F.col("rest") > 0, place))
        .withColumn("copies", F.col("copies") + F.coalesce((F.col("place") < F.col("border")).cast("bigint"), F.lit(0)))
        .withColumn("cut", F.when(F.col("place") == F.col("border"), F.col("border_words")).otherwise(0))
        .withColumn("taken", F.col("copies") * F.col("size") + F.col("cut"))
        .select(*keep, "source", "key", "size", "source_size", "target", "copies", "cut", "taken")
    )


def _with_source(rows: DataFrame, facts: DataFrame) -> DataFrame:
    """Attach what is known of the row's source; Spark broadcasts the facts where they are few."""
    facts = facts.withColumnRenamed("source", "of")
    return rows.join(facts, F.col("of").eqNullSafe(F.col("source"))).drop("of")


def apply_mix(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS) -> DataFrame:
    """The mix itself: a row per whole copy and one per cut document; the columns are those of ``docs``
    (``n_chars`` follows the cut text)."""
    names = docs.columns
    mixed = mix(as_row(docs, F.col("doc_id"), F.col("text"), F.col("source")), weights, ("row",))
    words = F.regexp_extract_all(F.col("row.text").cast("string"), F.lit(r"[\x20\x09-\x0D]*" + WORD), F.lit(0))
    begin = F.array_join(F.slice(words, F.lit(1), F.col("cut").cast("int")), "")
    whole = mixed.where("copies > 0 and size > 0").select("row", F.explode(F.sequence(F.lit(1), F.col("copies"))))
    first = mixed.where("cut > 0").withColumn("begin", begin)
    changed = {"text": F.col("begin"), "n_chars": F.length("begin").cast("bigint")}
    return whole.select(*row_columns(names)).unionByName(first.select(*row_columns(names, **changed)))


#: The same rows in DuckDB; md5 keys and the order of double operations are those above.
MIX_SQL = r"""
WITH m AS (
  SELECT doc_id, source,
         CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size,
         md5(coalesce(CAST(doc_id AS VARCHAR), '') || ':' || md5(coalesce(text, ''))) AS key
  FROM documents),
s AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size, count(*) AS docs,
         CAST(sum(100 + least(size, 2000)) AS BIGINT) AS importance
  FROM m GROUP BY source),
w AS (
  SELECT *, row_number() OVER (ORDER BY (source IS NULL), source) - 1 AS place FROM s),
x AS (
  SELECT *, place % 3 + 1 AS weight, 3 * source_size AS most,
         CAST(3 * source_size AS DOUBLE) / CAST(place % 3 + 1 AS DOUBLE) AS lim FROM w),
y AS (
  SELECT *, sum(source_size) OVER () AS total, sum(weight) OVER () AS weights,
         sum(most) OVER (ORDER BY lim, place ROWS UNBOUNDED PRECEDING) AS filled,
         sum(weight) OVER (ORDER BY lim, place ROWS UNBOUNDED PRECEDING) AS weight_upto FROM x),
z AS (
  SELECT CAST(total - filled + most AS DOUBLE) / CAST(weights - weight_upto + weight AS DOUBLE) AS level
  FROM y WHERE CAST(filled AS DOUBLE) + lim * CAST(weights - weight_upto AS DOUBLE) >= CAST(total AS DOUBLE)
  ORDER BY lim, place LIMIT 1),
t AS (
  SELECT source, source_size, docs, importance,
         least(CAST(most AS DOUBLE), coalesce((SELECT level FROM z), 0.0) * weight) AS target, most FROM y),
f AS (
  SELECT *, least(CAST(round(target) AS BIGINT), most) AS words FROM t),
g AS (
  SELECT *, CASE WHEN source_size = 0 THEN 0 ELSE words // source_size END AS copies,
         CASE WHEN source_size = 0 THEN 0 ELSE words % source_size END AS rest FROM f),
r AS (
  SELECT m.doc_id, m.source, m.key, m.size, g.source_size, g.target, g.copies, g.rest,
         (CAST(CAST('0x' || substr(key, 1, 12) AS BIGINT) AS DOUBLE) + 0.5) / 281474976710656.0 AS u,
         CAST(rest AS DOUBLE) / CAST(nullif(source_size, 0) AS DOUBLE) * (100 + least(size, 2000)) * docs / importance AS p
  FROM m JOIN g ON m.source IS NOT DISTINCT FROM g.source),
o AS (
  SELECT *, CASE WHEN p >= 1 THEN u - 1 ELSE (u / (1 - u)) / (u / (1 - u) + p / (1 - p)) END AS spot FROM r),
k AS (
  SELECT source, spot, key, sum(size) AS size, count(*) AS n, any_value(rest) AS rest FROM o WHERE rest > 0 GROUP BY source, spot, key),
c AS (
  SELECT *, sum(size) OVER (PARTITION BY source ORDER BY spot, key ROWS UNBOUNDED PRECEDING) - size AS before FROM k)
SELECT o.doc_id, o.source, o.size, o.source_size, o.target,
       CAST(o.copies * o.size + CASE
         WHEN c.before IS NULL THEN 0
         WHEN c.before + c.size <= c.rest THEN o.size
         WHEN c.before <= c.rest THEN (c.rest - c.before) // c.n ELSE 0 END AS BIGINT) AS taken
FROM o LEFT JOIN c ON o.source IS NOT DISTINCT FROM c.source AND o.key = c.key AND o.spot = c.spot AND o.rest > 0
"""
