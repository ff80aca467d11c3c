"""Information-theoretic sanitisation of personal data.

Base spans (e-mail, IP, card and phone numbers) come from patterns.  The corpus then tells how
strongly the words of its documents reveal such an entity: with document counts n(e), n(t), n(e, t) of
an entity, a term and both together among N documents, a term discloses

    log2(n(e, t) * N / (n(e) * n(t)))   of the entity's   log2(N / n(e))   bits.

Terms that disclose at least ``THRESHOLD`` of the bits become spans of kind ``term`` wherever they
stand in a document that holds that entity; ``sanitise`` replaces base spans by their kind and
generalises terms to ``[TERM]``.  Terms count from one document on; ``support`` asks for more documents
where a caller wants that.

All positions are in code points.  Array work stays inside the row; what is shuffled are counts
of entities, terms and pairs, and the words of documents that hold an entity, never whole texts
(but in ``sanitise`` those that hold an entity, once).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from gapweave.functions.arrays import sums_before
from gapweave.functions.sqltext import index_range, keep, let, lit, transform
from gapweave.llm.common import as_row, row_columns
from gapweave.llm.mixing import mix_key
from gapweave.operators.settle import settle, settle_last

THRESHOLD = 0.9
SUPPORT = 1

# Possessive and anchored forms of the contract's patterns with the same leftmost matches, so that
# no text makes them backtrack: a run of characters that fails from its start fails from any place.
EMAIL = (
    r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
)
IP = r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
CARD = r"[0-9](?:[\x20-]?[0-9])++"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
TERM = r"""(?<![^\s(\["'])\p{L}{3,40}(?=[.,;:!?)\]"']*+(?:\s|\z))"""

_BYTE = "0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])"
_CHUNK = 512
_NO_SPANS = "cast(array() as array<struct<start:bigint,end:bigint,value:string>>)"


def _spans(text: str, pattern: str) -> str:
    """All matches as ``struct<start, end, value>``: the pieces between them give the places."""

    def placed(m: str) -> str:
        def at(p: str) -> str:
            gaps = transform(p, lambda x, i: f"char_length({x}) + coalesce(char_length(get({m}, {i})), 0)")
            def build(before: str) -> str:
                return transform(
                    m,
                    lambda x, i: f"named_struct('start', {before}[{i}] + char_length({p}[{i}]), "
                    f"'end', {before}[{i}] + char_length({p}[{i}]) + char_length({x}), 'value', {x})",
                )
            return let(sums_before(gaps), build)

        return f"if(size({m}) = 0, {_NO_SPANS}, {let(f'split({text}, {lit(pattern)}, -1)', at)})"

    return let(f"regexp_extract_all({text}, {lit(pattern)}, 0)", placed)


def _luhn(digits: str) -> str:
    def total(d: str) -> str:
        plain = [f"cast(substr({d}, {i}, 1) as int)" for i in range(1, 20, 2)]
        doubled = [f"cast(translate(substr({d}, {i}, 1), '0123456789', '0246813579') as int)" for i in range(2, 20, 2)]
        return f"({' + '.join(plain + doubled)}) % 10 = 0"

    return let(f"lpad({digits}, 19, '0')", total)


def _digits(value: str) -> str:
    return f"regexp_replace({value}, '[^0-9]', '')"


def _valid(kind: str, v: str) -> str:
    if kind == "ip":
        return f"{v} rlike {lit(f'^{_BYTE}(?:[.]{_BYTE}){{3}}$')}"
    if kind == "card":
        return f"(length({_digits(v)}) between 13 and 19) and {_luhn(_digits(v))}"
    return f"length({_digits(v)}) between 9 and 15"


#: Kinds in the order of the listing.
KINDS = {"email": EMAIL, "ip": IP, "card": CARD, "phone": PHONE}


def _base(kind: str) -> str:
    found = _spans("text", KINDS[kind])
    if kind == "email":
        return f"if(instr(text, '@') > 0, {found}, {_NO_SPANS})"
    if kind == "phone":
        found = f"if(instr(text, '+') > 0, {found}, {_NO_SPANS})"
    return keep(found, lambda x: _valid(kind, f"{x}.value"))


def _piece(chunks: str, start: str, end: str) -> str:
    """Code points ``[start, end)`` of a text cut into chunks; the cost is that of a chunk and the piece."""
    first = f"cast({start} div {_CHUNK} as int)"
    count = f"cast(({end} - 1) div {_CHUNK} - {start} div {_CHUNK} + 1 as int)"
    return (
        f"if({end} <= {start}, '', substring(array_join(slice({chunks}, {first} + 1, {count}), ''), "
        f"cast({start} % {_CHUNK} as int) + 1, cast({end} - {start} as int)))"
    )


_CHUNKS = f"regexp_extract_all(text, {lit(f'(?s).{{1,{_CHUNK}}}')}, 0)"


def _entities() -> str:
    """The distinct entities of a text."""
    entity = {
        "email": lambda s: f"concat('email:', lower({s}.value))",
        "ip": lambda s: f"concat('ip:', {s}.value)",
        "card": lambda s: f"concat('card:', {_digits(f'{s}.value')})",
        "phone": lambda s: f"concat('phone:', {_digits(f'{s}.value')})",
    }
    return f"array_distinct(concat({', '.join(transform(kind, entity[kind]) for kind in KINDS)}))"


def _words() -> str:
    """All words of a text that holds an entity, with their places; none of other texts."""
    no_words = "cast(array() as array<struct<start:bigint,end:bigint,term:string>>)"
    placed = transform(
        _spans("text", TERM), lambda w: f"named_struct('start', {w}.start, 'end', {w}.end, 'term', lower({w}.value))"
    )
    return f"if(size(entities) = 0, {no_words}, {placed})"


def _whole_text(docs: DataFrame) -> DataFrame:
    return docs.withColumn("text", F.coalesce(F.col("text").cast("string"), F.lit("")))


def detect(docs: DataFrame) -> DataFrame:
    """``doc_id, row_key`` and per kind the array of base spans ``struct<start, end, value>``,
    ``entities``, and where there are any all ``words`` of the text.  Map-only."""
    return (
        _whole_text(docs.select("doc_id", "text"))
        .select("doc_id", "text", mix_key(F.col("doc_id"), F.col("text")).alias("row_key"),
                *[F.expr(_base(kind)).alias(kind) for kind in KINDS])
        .withColumn("entities", F.expr(_entities()))
        .select("doc_id", "row_key", *KINDS, "entities", F.expr(_words()).alias("words"))
    )


def disclosing_pairs(docs: DataFrame, found: DataFrame, threshold: float = THRESHOLD, support: int = SUPPORT) -> DataFrame:
    """``entity, term, disclosure`` above the threshold, counted over all documents."""
    total = found.count()
    # Counted in the tasks first; of texts without an entity nothing is paired.
    together = (
        found.select("entities", F.explode(F.array_distinct("words.term")).alias("term"))
        .select(F.explode("entities").alias("entity"), "term")
        .groupBy("entity", "term")
        .agg(F.count(F.lit(1)).alias("n_both"))
        .where(F.col("n_both") >= support)
    )
    entities = (
        found.select(F.explode("entities").alias("entity"))
        .groupBy("entity")
        .agg(F.count(F.lit(1)).alias("n_entity"))
    )
    words = F.expr(f"array_distinct({transform(f'regexp_extract_all(text, {lit(TERM)}, 0)', lambda w: f'lower({w})')})")
    terms = (
        _whole_text(docs.select("text"))
        .select(F.explode(words).alias("term"))
        .groupBy("term")
        .agg(F.count(F.lit(1)).alias("n_term"))
    )
    information = F.log2(F.lit(float(total)) / F.col("n_entity"))
    mutual = F.log2(F.col("n_both") * F.lit(float(total)) / (F.col("n_entity") * F.col("n_term")))
    return (
        together.join(entities, "entity")
        .join(terms, "term")
        .where(information > 0)
        .select("entity", "term", (mutual / information).alias("disclosure"))
        .where(F.col("disclosure") >= threshold)
    )


def personal_data(docs: DataFrame, threshold: float = THRESHOLD, support: int = SUPPORT) -> DataFrame:
    """``doc_id, row_key``, the base spans per kind and ``term``, the array of revealing words' spans.

    ``docs`` needs ``doc_id`` and ``text``; other columns are ignored.  A null text counts as
    empty and has no spans.  Every row counts as a document, also repeated ones, and equal rows
    get equal spans.
    """
    found = settle(detect(docs))
    pairs = disclosing_pairs(docs, found, threshold, support)
    words = found.select("row_key", "entities", F.explode("words").alias("w")).select(
        "row_key", F.explode("entities").alias("entity"), "w"
    )
    revealed = (
        words.select("row_key", "entity", F.col("w.term").alias("term"), "w.start", "w.end")
        .join(pairs, ["entity", "term"])
        .groupBy("row_key")
        .agg(F.sort_array(F.collect_set(F.struct("start", "end"))).alias("revealing"))
    )
    nothing = F.expr("cast(array() as array<struct<start:bigint,end:bigint>>)")
    return found.join(revealed, "row_key", "left").select(
        "doc_id", "row_key", *KINDS, F.coalesce("revealing", nothing).alias("term")
    )


def listing(kinds: tuple[str, ...]) -> Column:
    """``kind:start:end`` by kind, then start, comma-joined."""


    def part(kind: str) -> Column:
        return F.transform(
            kind, lambda s: F.concat_ws(":", F.lit(kind), s["start"].cast("string"), s["end"].cast("string"))
        )

    return F.array_join(F.concat(*[part(kind) for kind in kinds]), ",")


def sanitise(docs: DataFrame, threshold: float = THRESHOLD, support: int = SUPPORT) -> DataFrame:
    """``docs`` with every span replaced by its kind in brackets; overlapping spans become one.

    The columns stay as they are; ``n_chars`` follows the text where there is one.  Rows without
    spans are unchanged, null texts included.
    """


    def labelled(kind: str) -> Column:
        label = F.lit(f"[{kind.upper()}]").alias("label")
        return F.transform(kind, lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), label))

    spans = settle_last(
        lambda: personal_data(docs, threshold, support)
        .select("row_key", F.concat(*[labelled(kind) for kind in (*KINDS, "term")]).alias("_spans"))
        .where(F.size("_spans") > 0)
        .groupBy("row_key")  # equal rows have equal spans
        .agg(F.first("_spans").alias("_spans"))
    )
    # Texts that hold no entity have no spans: they stay where they are, only the others meet theirs.
    text = F.col("text").cast("string")
    whole = F.coalesce(text, F.lit(""))
    keyed = as_row(docs, text.alias("of_row"), whole.alias("text"), mix_key(F.col("doc_id"), text).alias("_key")).withColumn(
        "_holds", F.expr(" or ".join(f"size({_base(kind)}) > 0" for kind in KINDS))
    )
    unchanged = keyed.where(~F.col("_holds")).select("row", F.col("of_row").alias("text"), F.lit(None).cast("string").alias("clean"))
    changing = (
        keyed.where("_holds")
        .join(spans.withColumnRenamed("row_key", "_key"), "_key", "left")
        .select("row", "text", F.when(F.col("_spans").isNotNull(), F.expr(_redacted())).alias("clean"))
    )
    joined = unchanged.unionByName(changing)
    changed = {
        "text": F.coalesce("clean", "text"),
        "n_chars": F.coalesce(F.length("clean").cast("bigint"), F.col("row.n_chars"))
        if "n_chars" in docs.columns
        else None,
    }
    return joined.select(*row_columns(docs.columns, **changed))


def _redacted() -> str:
    # A sweep over starts (+1) and ends (-1): merged spans begin and end where the depth is 0.
    starts = transform("_spans", lambda s: f"named_struct('at', {s}.start, 'step', 1L, 'label', {s}.label)")
    ends = transform("_spans", lambda s: f"named_struct('at', {s}.end, 'step', -1L, 'label', '')")

    def merged(events: str) -> str:
        def cut(depth: str) -> str:
            opened = keep(events, lambda e, i: f"{e}.step = 1 and {depth}[{i}] = 0")
            closed = keep(events, lambda e, i: f"{e}.step = -1 and {depth}[{i}] = 1")
            both = f"named_struct('open', {opened}, 'close', {closed}, 'chunks', {_CHUNKS})"
            return let(both, assembled)

        return let(sums_before(transform(events, lambda e: f"{e}.step")), cut)

    def assembled(v: str) -> str:
        before = transform(
            index_range(f"size({v}.open)"),
            lambda i: f"concat({_piece(f'{v}.chunks', f'if({i} = 0, 0L, {v}.close[greatest({i} - 1, 0)].at)', f'{v}.open[{i}].at')}, {v}.open[{i}].label)",
        )
        rest = _piece(f"{v}.chunks", f"element_at({v}.close, -1).at", "cast(char_length(text) as bigint)")
        return f"concat(array_join({before}, ''), {rest})"

    # Sorted by place, ends before starts: spans that only touch stay apart.
    return let(f"array_sort(concat({starts}, {ends}))", merged)
