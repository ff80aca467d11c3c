"""Vocabulary joins, bytes-per-token ratio and benchmark sampling."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from gapweave.functions import tokens as T
from gapweave.functions.keys import shuffle_key
from gapweave.functions.sqltext import index_range, keep, let, transform, words
from gapweave.operators.ranking import keep_smallest
from gapweave.params import Markers


#: Into how many parts the rows of one word are dealt; the vocabulary is copied so often.
SALTS = 16


def _lookup(items: DataFrame, vocabulary: DataFrame, on: str, key: str, broadcast: bool) -> DataFrame:
    """Left join against the vocabulary; ``broadcast`` says that the caller knows it to be small.

    Otherwise words are shuffled.  A word that most texts have would bring a row of each of them to one
    task, so a word's rows are dealt by their text's key as well.
    """
    if broadcast:
        return items.join(F.broadcast(vocabulary), on, "left")
    salted = items.withColumn("_salt", F.pmod(F.xxhash64(key), F.lit(SALTS)).cast("int"))
    copies = vocabulary.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    return salted.join(copies, [on, "_salt"], "left").drop("_salt")


def _distinct_items(rows: DataFrame, key: str, items: str, name: str) -> DataFrame:
    """``key, name, positions``: a text's distinct items (SQL text ``items``) and where they stand.

    One sort inside the row brings equal items together, so no more than a row for each distinct
    item of a text is ever shuffled.
    """

    def grouped(s: str) -> str:
        firsts = keep(index_range(f"size({s})"), lambda i: f"{i} = 0 or {s}[{i}].item <> {s}[greatest({i} - 1, 0)].item")

        def entries(f: str) -> str:
            def entry(at: str, k: str) -> str:
                length = f"coalesce(get({f}, {k} + 1), size({s})) - {at}"
                positions = transform(f"slice({s}, {at} + 1, {length})", lambda x: f"{x}.pos")
                return f"named_struct('{name}', {s}[{at}].item, 'positions', {positions})"

            return transform(f, entry)

        return let(firsts, entries)

    tagged = transform(items, lambda x, i: f"named_struct('item', {x}, 'pos', {i})")
    return rows.select(key, F.inline(F.expr(let(f"sort_array({tagged})", grouped))))


def _in_order(found: DataFrame, key: str, value: str) -> DataFrame:
    """Bring the values of each text back to the places of their items; null values are left out."""
    pairs = F.transform("positions", lambda p: F.struct(p.alias("pos"), F.col(value).alias("value")))
    listed = found.where(F.col(value).isNotNull()).groupBy(key).agg(F.flatten(F.collect_list(pairs)).alias("_pairs"))
    return listed.select(key, F.transform(F.sort_array("_pairs"), lambda x: x["value"]).alias("_values"))


def vocabulary_ids(
    texts: DataFrame, vocabulary: DataFrame, unk_id: int, key: str, text: str = "text", broadcast: bool = False
) -> DataFrame:
    """Word tokenizer: text -> ids through ``vocabulary(token, id)``; unknown words get ``unk_id``.

    ``broadcast`` sends the whole vocabulary to every executor instead of shuffling words.
    """
    items = _distinct_items(texts, key, words(text), "token")
    known = _lookup(items, vocabulary.select("token", "id"), "token", key, broadcast)
    found = _in_order(known.withColumn("id", F.coalesce("id", F.lit(unk_id))), key, "id")
    return texts.select(key).join(found, key, "left").select(
        key, F.coalesce("_values", F.array().cast("array<int>")).alias("ids")
    )


def vocabulary_text(
    ids: DataFrame, vocabulary: DataFrame, key: str, column: str = "ids", broadcast: bool = False
) -> DataFrame:
    """Ids -> tokens joined by single spaces; unknown ids are skipped."""
    known = _lookup(_distinct_items(ids, key, column, "id"), vocabulary.select("token", "id"), "id", key, broadcast)
    found = _in_order(known, key, "token")
    return ids.select(key).join(found, key, "left").select(
        key, F.coalesce(F.array_join("_values", " "), F.lit("")).alias("text")
    )


def missing_markers(vocabulary: DataFrame, required: list[str]) -> DataFrame:
    """Required marker texts that the vocabulary lacks (must be empty for a usable tokenizer)."""
    wanted = vocabulary.sparkSession.createDataFrame([(t,) for t in required], "token string")
    # The handful of required tokens is the small side, so keep it and drop the found ones.
    found = vocabulary.join(F.broadcast(wanted), "token", "left_semi").select("token").distinct()
    return wanted.join(found, "token", "left_anti")


def require_markers(vocabulary: DataFrame, markers: Markers = Markers()) -> None:
    missing = [r["token"] for r in missing_markers(vocabulary, list(markers.id_by_text())).collect()]
    if missing:
        raise ValueError(f"tokens missing from the vocabulary: {sorted(missing)}")


def bytes_per_token(blocks: DataFrame, n_tokens: Column) -> DataFrame:
    """One row with ``ratio`` = bytes / tokens over all blocks, in one aggregate."""
    sums = blocks.select(F.octet_length("code").alias("_bytes"), n_tokens.alias("_tokens"))
    return sums.agg((F.sum("_bytes") / F.nullif(F.sum("_tokens"), F.lit(0))).alias("ratio"))


def ratio_value(ratio: DataFrame) -> float:
    value = ratio.first()["ratio"]
    if value is None or value <= 0:
        raise ValueError("cannot estimate the bytes-per-token ratio: no bytes or no tokens")
    return value


def fim_parts(examples: DataFrame, markers: Markers = Markers(), keep: tuple[str, ...] = ("example_id",)) -> DataFrame:
    """Id arrays and texts of the three parts, for rows whose markers are in order."""
    ids = F.col("input_ids")
    good = examples.where(T.well_formed(ids, markers))
    parts = good.select(
        *keep,
        ids.alias("example_token_ids"),
        T.part(ids, markers.prefix_id, markers.suffix_id).alias("prefix_token_ids"),
        T.part(ids, markers.suffix_id, markers.middle_id).alias("suffix_token_ids"),
        T.part(ids, markers.middle_id, markers.eos_id).alias("middle_token_ids"),
    )
    for name in ("prefix", "suffix", "middle"):
        parts = parts.withColumn(name, T.decode_ids(F.col(f"{name}_token_ids")))
    return parts


def benchmark_sample(
    examples: DataFrame, n: int, seed: int = 42, ids: tuple[str, ...] = ("example_id",), markers: Markers = Markers()
) -> DataFrame:
    """The first n well-formed rows of a seeded order; malformed rows do not count."""
    good = examples.where(T.well_formed(F.col("input_ids"), markers))
    keyed = good.withColumn("bench_key", shuffle_key("bench", seed, *[F.col(c) for c in ids]))
    return keep_smallest(keyed, "bench_key", list(ids), n)


def prompts(parts: DataFrame, pad_label: int = -100, markers: Markers = Markers()) -> DataFrame:
    """Generation prompt and perplexity labels (prompt masked, middle and end kept)."""
    with_prompt = parts.withColumn(
        "prompt_ids", T.prompt_ids(F.col("prefix_token_ids"), F.col("suffix_token_ids"), markers)
    )
    return with_prompt.withColumn(
        "label_ids", T.mask_leading(F.col("example_token_ids"), F.size("prompt_ids"), pad_label)
    )
