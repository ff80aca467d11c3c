"""Byte chunks of whole files and random fill-in-the-middle spans inside them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from gapweave.functions.keys import draw_below, shuffle_key
from gapweave.functions.tokens import byte_ids, empty, psm_ids
from gapweave.operators.fim import training_arrays
from gapweave.operators.ranking import keep_quota
from gapweave.params import FimParams, Markers

# Head room of a chunk over the length limit, and markers per example.
CHUNK_HEADROOM = 1.2
N_MARKERS = 4


def window_bytes(max_len: int, ratio: Column) -> Column:
    return F.floor(F.lit(max_len) * ratio * F.lit(CHUNK_HEADROOM)).cast("int")


def _boundary(content: Column, position: Column, direction: int) -> Column:
    """Nearest character boundary at or beside a byte position of valid UTF-8."""

    def inside(p: Column) -> Column:
        return F.hex(F.substring(content, p + 1, F.lit(1))).rlike("^[89AB]")

    out = F.when(~inside(position), position)
    for step in (1, 2):
        out = out.when(~inside(position + direction * step), position + direction * step)
    return out.otherwise(position + direction * 3)


def chunk_array(content: Column, window: Column) -> Column:
    """Non-overlapping windows; a file no longer than one window is kept whole, otherwise a
    shorter tail is dropped.  Characters cut by a window edge are trimmed on both sides."""
    n = F.octet_length(content)
    cut = F.transform(
        F.when(n > window, F.sequence(F.lit(0), n - window, window)).otherwise(empty("int")),
        lambda at: F.struct(
            _boundary(content, at, 1).alias("start"), _boundary(content, at + window, -1).alias("end")
        ),
    )
    pieces = F.transform(cut, lambda c: F.substring(content, c["start"] + 1, c["end"] - c["start"]))
    return F.when(n <= window, F.array(content)).otherwise(pieces)


def byte_chunks(files: DataFrame, window: Column, keep: tuple[str, ...] = ("file_id",)) -> DataFrame:
    return files.select(*keep, F.posexplode(chunk_array(F.col("content"), window)).alias("chunk_no", "bytes"))


def random_spans(n_ids: Column, params: FimParams, *chunk_id: Column) -> Column:
    """Draws of one chunk as structs (draw, start, length); draws that do not fit are absent."""
    low, high = params.min_middle_tokens_length, params.max_middle_tokens_length
    edge = params.rand_examples_min_prefix_suffix_tokens_length

    def draw(j: Column) -> Column:
        length = F.lit(low) + draw_below(
            shuffle_key("length", params.rng_seed, *chunk_id, j), F.lit(high - low + 1)
        )
        return F.struct(j.alias("draw"), length.cast("int").alias("length"))

    def place(d: Column) -> Column:
        room = n_ids - d["length"] - 2 * edge + 1
        start = F.lit(edge) + draw_below(shuffle_key("start", params.rng_seed, *chunk_id, d["draw"]), room)
        return F.struct(d["draw"].alias("draw"), start.cast("int").alias("start"), d["length"].alias("length"))

    drawn = F.transform(F.sequence(F.lit(0), F.lit(params.rand_examples_per_chunk - 1)), draw)
    fitting = F.filter(drawn, lambda d: d["length"] <= n_ids - 2 * edge)
    return F.transform(fitting, place)


def random_pool(chunks: DataFrame, params: FimParams) -> DataFrame:
    """Every draw of every chunk: chunk, span and pool key.

    Byte ids are counted, not built, so choosing from the pool never makes an id array; with a
    tokenizer of one's own the chunks come with their ``ids``.
    """
    count = F.size("ids") if "ids" in chunks.columns else F.octet_length("bytes")
    n_ids = F.least(count, F.lit(params.max_token_sequence_length - N_MARKERS))
    spans = random_spans(n_ids, params, F.col("file_id"), F.col("chunk_no"))
    pool = chunks.select(*chunks.columns, n_ids.alias("n_ids"), F.inline(spans))
    return pool.withColumn(
        "pool_key", shuffle_key("pool", params.rng_seed, F.col("file_id"), F.col("chunk_no"), F.col("draw"))
    )


def spans_to_examples(pool: DataFrame, markers: Markers = Markers()) -> DataFrame:
    if "ids" in pool.columns:
        ids = F.slice("ids", F.lit(1), F.col("n_ids"))
    else:
        ids = byte_ids(F.substring(F.col("bytes"), F.lit(1), F.col("n_ids")))
    with_ids = pool.withColumn("_ids", ids)
    a, n, size = F.col("start"), F.col("length"), F.col("n_ids")
    built = with_ids.withColumn(
        "input_ids",
        psm_ids(
            F.slice("_ids", F.lit(1), a),
            F.slice("_ids", a + n + 1, size - a - n),
            F.slice("_ids", a + 1, n),
            markers,
        ),
    )
    return training_arrays(built.drop("_ids", "ids", "bytes", "n_ids", "pool_key"))


def chosen_spans(pool: DataFrame, quotas: DataFrame) -> DataFrame:
    """The draws of the pool that come first by key, up to the quota of each split."""
    return keep_quota(pool, ["split"], "pool_key", ["file_id", "chunk_no", "draw"], quotas)


def random_examples(
    files: DataFrame,
    window: Column,
    params: FimParams,
    quotas: DataFrame,
    markers: Markers = Markers(),
    tokenizer=None,
) -> DataFrame:
    """Random examples up to the quota of each split; the choice is by key, over the whole pool."""
    chunks = byte_chunks(files, window, keep=("file_id", "split"))
    if tokenizer is not None:
        chunks = chunks.withColumn("ids", tokenizer(F.make_valid_utf8(F.col("bytes").cast("string"))))
    return spans_to_examples(chosen_spans(random_pool(chunks, params), quotas), markers)
