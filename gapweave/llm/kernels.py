"""Array code that runs inside tasks.

The functions travel to the workers by value, so that these need not have the package.
"""

from __future__ import annotations

import math
import sys
import types

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])


def once(key, make):
    """``make()`` the first time a worker process asks for ``key``, then the kept value."""
    kept = sys.modules.setdefault("_gapweave_once", types.ModuleType("_gapweave_once")).__dict__
    if key not in kept:
        kept[key] = make()
    return kept[key]


def slices(batches, rows: int = 256):
    """The same record batches in small parts, so that few texts are Python strings at a time."""
    for batch in batches:
        for start in range(0, batch.num_rows, rows):
            yield batch.slice(start, rows)


# --- packing ---------------------------------------------------------------------------------


def byte_bpe(path: str, file: str | None = None):
    """The byte-level vocabulary of a ``.tiktoken`` file as an encoder of ordinary text.

    ``file`` is the same vocabulary for the ``tokenizers`` library, which reads what the rank
    file's library can't: very long runs of white space.
    """

    def load():
        return _ByteEncoder(path, file)

    return once(("byte_bpe", path, file), load)


class _ByteEncoder:
    def __init__(self, path: str, file: str | None):
        import base64
        import re

        import public_tokenizers
        import tiktoken

        with open(path, "rb") as lines:
            self.ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
        self.encoding = tiktoken.Encoding(
            "byte_bpe", pat_str=public_tokenizers.PATTERN, mergeable_ranks=self.ranks, special_tokens={}
        )
        self.file, self.other = file, None
        self.long_space = re.compile(r"\s{10000}")

    def encode_ordinary(self, text: str) -> list[int]:
        if self.file is None or len(text) < 10_000 or not self.long_space.search(text):
            return self.encoding.encode_ordinary(text)
        if self.other is None:
            from tokenizers import Tokenizer

            self.other = Tokenizer.from_file(self.file)
            self.other.encode_special_tokens = True
        return self.other.encode(text, add_special_tokens=False).ids


def binary_lengths(n: int, largest: int) -> list[int]:
    """``n`` as a falling sum of powers of two, none above ``largest`` (a power of two)."""
    out = [largest] * (n // largest)
    rest = n % largest
    while rest:
        piece = 1 << (rest.bit_length() - 1)
        out.append(piece)
        rest -= piece
    return out


# --- language identification -----------------------------------------------------------------

#: ASCII bytes other than letters count as one separator.
_LETTERS_ONLY = bytes(c if c >= 128 or chr(c).isalpha() else 32 for c in range(256))


def trigram_features(text: str, width: int):
    """Hashed byte trigrams of the lower-cased text: places and values of a unit vector (roots of counts)."""
    raw = np.frombuffer(text.lower().encode("utf-8", "surrogatepass").translate(_LETTERS_ONLY), dtype=np.uint8)
    if len(raw) < 3:
        raw = np.frombuffer(bytes(raw) + b"   ", dtype=np.uint8)
    wide = raw.astype(np.uint32)
    code = (wide[:-2] << 16) | (wide[1:-1] << 8) | wide[2:]
    hashed = (code * np.uint32(2654435761)) >> np.uint32(32 - (width.bit_length() - 1))
    counts = np.bincount(hashed, minlength=width)
    places = np.flatnonzero(counts)
    values = np.sqrt(counts[places].astype(np.float32))
    return places.astype(np.int32), values / np.float32(np.sqrt(np.dot(values, values)))


def linear_svm(rows: np.ndarray, signs: np.ndarray, cost: float = 1.0, rounds: int = 25) -> tuple[np.ndarray, float]:
    """Linear support vector machine (squared hinge) by dual coordinate descent; the last column is the bias."""
    n = len(rows)
    x = np.hstack([rows, np.ones((n, 1), dtype=np.float32)])
    w = np.zeros(x.shape[1], dtype=np.float32)
    alpha = np.zeros(n)
    slack = 1.0 / (2.0 * cost)
    curvature = np.einsum("ij,ij->i", x, x).astype(float) + slack
    order = np.random.default_rng(7)
    for _ in range(rounds):
        largest = 0.0
        for i in order.permutation(n):
            gradient = signs[i] * float(x[i] @ w) - 1.0 + slack * alpha[i]
            step = max(alpha[i] - gradient / curvature[i], 0.0) - alpha[i]
            if step:
                alpha[i] += step
                w += np.float32(step * signs[i]) * x[i]
                largest = max(largest, abs(step))
        if largest < 1e-3:
            break
    return w[:-1].copy(), float(w[-1])


class LanguageModel:
    """Families, a machine per family against the others, and one per pair of languages within a family."""

    def __init__(self, width, families, family_w, family_b, pairs, pair_w, pair_b):
        self.width, self.families = width, families
        self.family_w, self.family_b = family_w, family_b
        self.pairs, self.pair_w, self.pair_b = pairs, pair_w, pair_b

    def predict(self, text: str) -> tuple[str, float]:
        places, values = trigram_features(text, self.width)
        family, sure = 0, 1.0
        if len(self.families) > 1:
            margins = values @ self.family_w[places] + self.family_b
            family = int(np.argmax(margins))
            odds = np.exp(4.0 * (margins - margins[family]))
            sure = float(1.0 / odds.sum())
        languages = self.families[family]
        if len(languages) == 1:
            return languages[0], sure
        duels = self.pairs[family]
        margins = values @ self.pair_w[family][places] + self.pair_b[family]
        votes, total, least = np.zeros(len(languages)), np.zeros(len(languages)), np.full(len(languages), np.inf)
        for (a, b), margin in zip(duels, margins):
            votes[a if margin > 0 else b] += 1
            total[a] += margin
            total[b] -= margin
            least[a], least[b] = min(least[a], margin), min(least[b], -margin)
        best = max(range(len(languages)), key=lambda k: (votes[k], total[k]))
        return languages[best], sure / (1.0 + float(np.exp(-4.0 * least[best])))


def language_families(names: list[str], centroids: np.ndarray) -> list[list[str]]:
    """Languages merged by average similarity of their profiles until about sqrt(n) families are left."""
    unit = centroids / np.maximum(np.linalg.norm(centroids, axis=1, keepdims=True), 1e-12)
    alike = unit @ unit.T
    families = [[k] for k in range(len(names))]
    while len(families) > math.ceil(math.sqrt(len(names))):
        pairs = [(i, j) for i in range(len(families)) for j in range(i)]
        i, j = max(pairs, key=lambda p: alike[np.ix_(families[p[0]], families[p[1]])].mean())
        families[j] += families.pop(i)
    return [sorted(names[k] for k in family) for family in families]


def fit_languages(examples: list[tuple[str, np.ndarray, np.ndarray]], width: int) -> LanguageModel | None:
    """Train on ``(language, places, values)``; None where there are no examples."""
    names = sorted({e[0] for e in examples})
    if not names:
        return None

    def dense(some):
        out = np.zeros((len(some), width), dtype=np.float32)
        for row, (_, places, values) in zip(out, some):
            row[np.asarray(places, dtype=np.int64)] = values
        return out

    by_name = {n: [e for e in examples if e[0] == n] for n in names}
    families = language_families(names, np.stack([dense(by_name[n]).mean(axis=0) for n in names]))
    family_w, family_b = np.zeros((width, len(families)), dtype=np.float32), np.zeros(len(families), dtype=np.float32)
    if len(families) > 1:
        of = {n: k for k, family in enumerate(families) for n in family}
        rows, kinds = dense(examples), np.array([of[e[0]] for e in examples])
        for k in range(len(families)):
            family_w[:, k], family_b[k] = linear_svm(rows, np.where(kinds == k, 1.0, -1.0))
    pairs, pair_w, pair_b = [], [], []
    for family in families:
        duels = [(a, b) for a in range(len(family)) for b in range(a + 1, len(family))]
        w, bias = np.zeros((width, len(duels)), dtype=np.float32), np.zeros(len(duels), dtype=np.float32)
        for k, (a, b) in enumerate(duels):
            first, second = by_name[family[a]], by_name[family[b]]
            signs = np.array([1.0] * len(first) + [-1.0] * len(second))
            w[:, k], bias[k] = linear_svm(dense(first + second), signs)
        pairs.append(duels)
        pair_w.append(w)
        pair_b.append(bias)
    return LanguageModel(width, families, family_w, family_b, pairs, pair_w, pair_b)


# --- vectors ---------------------------------------------------------------------------------


def sign_codes(vectors: np.ndarray, tables: int, bits: int, seed: int) -> np.ndarray:
    """One integer per table: on which side of its random hyperplanes each vector lies."""
    planes = np.random.default_rng(seed).standard_normal((vectors.shape[1], tables * bits))
    sides = (vectors @ planes > 0).reshape(len(vectors), tables, bits)
    return (sides * (1 << np.arange(bits))).sum(axis=2).astype(np.int32)


def linked_in_bucket(vectors, sizes, codes, table, left, right, least_cosine):
    """Links among the vectors of a bucket, or between its blocks ``left`` and ``right`` (masks).

    Pairs that share the code of an earlier table are left to that table.  Returns per vector the
    number of vectors linked (copies count) and the place of the first one reached.
    """
    norms = np.linalg.norm(vectors, axis=1)
    linked = (vectors @ vectors.T) / np.outer(norms, norms) >= least_cosine
    linked &= np.outer(left, right) | np.outer(right, left)
    np.fill_diagonal(linked, False)
    i, j = np.nonzero(linked)
    if len(i) and table:
        seen = np.zeros(len(i), dtype=bool)
        for t in range(table):
            seen |= codes[i, t] == codes[j, t]
        linked[i[seen], j[seen]] = False
    first = np.arange(len(vectors))
    while True:
        reached = np.minimum(first, np.where(linked, first[None, :], len(vectors)).min(axis=1, initial=len(vectors)))
        if (reached == first).all():
            return linked @ sizes, first
        first = reached


# --- largest inner products ------------------------------------------------------------------

#: Below every score; unlike the least integer it can be negated.
NO_SCORE = -(2**63 - 1)
#: Marks a place that is still free; as an id it is behind every other.
_NO_ID = np.iinfo(np.int64).max
#: Distances are compared with this relative slack, so that rounding never cuts a true neighbour.
_SLACK = 1e-9


def filled(lists, width):
    """Lists of integers as rows of a matrix, zeros behind shorter ones."""
    lists = lists.combine_chunks() if isinstance(lists, pa.ChunkedArray) else lists
    sizes = np.asarray(pc.list_value_length(lists)).astype(np.int64)
    out = np.zeros((len(sizes), width), dtype=np.int64)
    column = np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    out[np.repeat(np.arange(len(sizes)), sizes), column] = np.asarray(lists.flatten())
    return out


def _binary(*arrays):
    return [pa.array([np.ascontiguousarray(x).tobytes()], pa.binary()) for x in arrays]


def _matrix(packed, kind, width):
    """Packed rows, one after the other or one in each value, as a matrix of 64-bit integers."""
    raw = packed if isinstance(packed, bytes) else b"".join(packed.to_pylist())
    rows = len(raw) // max(np.dtype(kind).itemsize * width, 1)
    return np.frombuffer(raw, dtype=kind).reshape(rows, width).astype(np.int64)


def _in_exact(top, x):
    """Integers in a type whose products are exact: no partial sum exceeds the largest squared norm."""
    return x.astype(np.float32 if top < 2**23 else np.float64 if top < 2**52 else np.int64)


def place_vectors(batches, objects, top, width, kind):
    """The nearest routing object of every vector and the distance to it; components packed."""
    norms = (objects**2).sum(axis=1)
    extra = np.sqrt(np.maximum(top - norms, 0.0))
    for batch in batches:
        ints = filled(batch.column(1), width)
        x = ints.astype(np.float64)
        squared = (x**2).sum(axis=1)
        own = np.sqrt(np.maximum(top - squared, 0.0))
        d2 = squared[:, None] + norms - 2 * x @ objects.T + (own[:, None] - extra) ** 2
        parent = np.argmin(d2, axis=1)
        distance = np.sqrt(np.maximum(d2[np.arange(len(x)), parent], 0.0))
        packed = pa.array([row.tobytes() for row in ints.astype(kind)], pa.binary())
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), packed, pa.array(parent.astype(np.int32)), pa.array(distance)],
            ["vec_id", "ints", "parent", "distance"],
        )


def pack_page(group, top, width, kind, k):
    """One row for the entries of a page, with the places of its queries and their k-th scores within it."""
    group = group.sort_by("vec_id")
    distances, n = np.asarray(group["distance"]), len(group)
    ints = _matrix(group["ints"], kind, width) if width else np.zeros((n, 0), dtype=np.int64)
    asked = np.flatnonzero(np.asarray(group["asked"]))
    floors = np.full(len(asked), NO_SCORE)
    if n > k and len(asked):
        x = _in_exact(top, ints)
        scores = (x[asked] @ x.T).astype(np.int64)
        scores[np.arange(len(asked)), asked] = NO_SCORE
        floors = np.partition(scores, n - k, axis=1)[:, n - k]
    packed = _binary(np.asarray(group["number"]), np.asarray(group["vec_id"]), ints.astype(kind), distances, asked, floors)
    return pa.Table.from_arrays(
        [group["page"][:1], group["parent"][:1], pa.array([distances.min()]), pa.array([distances.max()]), *packed],
        ["page", "parent", "inner", "outer", "numbers", "ids", "ints", "distances", "asked", "floors"],
    )


def queries_of_pages(batches, width, kind):
    """The rows of the queries in packed pages."""
    for batch in batches:
        for numbers, ids, ints, asked, floors in zip(*[column.to_pylist() for column in batch.columns]):
            asked = np.frombuffer(asked, dtype=np.int64)
            if not len(asked):
                continue
            numbers, ids = np.frombuffer(numbers, dtype=np.int64), np.frombuffer(ids, dtype=np.int64)
            rows = np.frombuffer(ints, dtype=kind).reshape(len(numbers), width)[asked]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(numbers[asked]),
                    pa.array(ids[asked]),
                    pa.array([row.tobytes() for row in rows], pa.binary()),
                    pa.array(np.frombuffer(floors, dtype=np.int64)),
                ],
                ["number", "vec_id", "ints", "floor"],
            )


def pack_block(group):
    """One row for a block of queries."""
    group = group.sort_by("number")
    packed = _binary(*[np.asarray(group[c]) for c in ("number", "vec_id", "floor")])
    ints = pa.array([b"".join(group["ints"].to_pylist())], pa.binary())
    return pa.Table.from_arrays([group["block"][:1], *packed, ints], ["block", "q_numbers", "q_ids", "q_floors", "q_ints"])


def best_of_page(rows, scores, ids, kept_scores, kept_ids):
    """Put new scores, each of a row, among the best kept of the rows: higher score, then smaller id."""
    k = kept_scores.shape[1]
    touched = np.unique(rows)
    row = np.concatenate([np.repeat(touched, k), rows])
    s, d = np.concatenate([kept_scores[touched].ravel(), scores]), np.concatenate([kept_ids[touched].ravel(), ids])
    order = np.lexsort((d, -s, row))
    at = row[order]
    order = order[np.arange(len(at)) - np.searchsorted(at, at) < k]
    kept_scores[touched], kept_ids[touched] = s[order].reshape(-1, k), d[order].reshape(-1, k)


def search_pages(pages, blocks, objects, top, width, kind, k):
    """The best entries of some pages for every query of some blocks.

    A block visits the pages in the order of their lower bounds.  A page whose bounds exceed the
    k-th distance so far of every query is skipped, and within a page only entries are scored whose
    stored distance to the parent lets them come closer.
    """
    norms = (objects**2).sum(axis=1)
    extra = np.sqrt(np.maximum(top - norms, 0.0))
    found = [[np.zeros(0, dtype=np.int64)] for _ in range(4)]
    listed = pages.to_pylist() if blocks.num_rows else []
    parents = np.unique([page["parent"] for page in listed]).astype(np.int64)
    for block in blocks.to_pylist() if listed else []:
        q_numbers = np.frombuffer(block["q_numbers"], dtype=np.int64)
        q = np.frombuffer(block["q_ints"], dtype=kind).reshape(len(q_numbers), width).astype(np.float64)
        squared = (q**2).sum(axis=1)
        d2 = squared[:, None] + norms[parents] - 2 * q @ objects[parents].T + extra[parents] ** 2
        to_parents, q = np.sqrt(np.maximum(d2, 0.0)), _in_exact(top, _matrix(block["q_ints"], kind, width) if width else q)
        scores = np.repeat(np.frombuffer(block["q_floors"], dtype=np.int64)[:, None], k, axis=1)
        ids = np.full(scores.shape, _NO_ID)
        of_page = np.searchsorted(parents, [page["parent"] for page in listed])
        nearest, farthest = to_parents.min(axis=0)[of_page], to_parents.max(axis=0)[of_page]
        inner, outer = (np.array([page[c] for page in listed]) for c in ("inner", "outer"))
        for at in np.argsort(np.maximum(np.maximum(nearest - outer, inner - farthest), 0.0), kind="stable"):
            page, reach, kth = listed[at], to_parents[:, of_page[at]], scores[:, -1]
            # A query with fewer than k candidates so far has no limit yet.
            limit = np.where(kth > NO_SCORE, np.sqrt(np.maximum(squared + top - 2.0 * kth, 0.0)), np.inf)
            limit = limit * (1 + _SLACK) + _SLACK * np.sqrt(squared + top + 1.0)
            open_to = np.flatnonzero((reach - outer[at] <= limit) & (inner[at] - reach <= limit))
            if not len(open_to):
                continue
            distances = np.frombuffer(page["distances"], dtype=np.float64)
            low, high = (reach - limit)[open_to].min(), (reach + limit)[open_to].max()
            near = np.flatnonzero((distances >= low) & (distances <= high))
            if not len(near):
                continue
            x = _in_exact(top, np.frombuffer(page["ints"], dtype=kind).reshape(len(distances), width)[near])
            products = q[open_to] @ x.T
            row, column = np.nonzero(products >= kth[open_to][:, None].astype(products.dtype))
            numbers = np.frombuffer(page["numbers"], dtype=np.int64)[near]
            other = q_numbers[open_to][row] != numbers[column]
            row, column = row[other], column[other]
            if len(row):
                new = products[row, column].astype(np.int64)
                best_of_page(open_to[row], new, np.frombuffer(page["ids"], dtype=np.int64)[near][column], scores, ids)
        taken = np.nonzero(ids < _NO_ID)
        query_ids = np.frombuffer(block["q_ids"], dtype=np.int64)
        for out, values in zip(found, (q_numbers[taken[0]], query_ids[taken[0]], ids[taken], scores[taken])):
            out.append(values)
    return pa.Table.from_arrays([pa.array(np.concatenate(x)) for x in found], ["number", "query_id", "vec_id", "score"])


# --- weighted near-duplicates ----------------------------------------------------------------

_M1, _M2, _M3 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def mixed(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (wrapping arithmetic)."""
    x = (x ^ (x >> np.uint64(30))) * _M2
    x = (x ^ (x >> np.uint64(27))) * _M3
    return x ^ (x >> np.uint64(31))


def mixed_in_place(x: np.ndarray) -> np.ndarray:
    """``mixed`` without new arrays but one."""
    y = x >> np.uint64(30)
    x ^= y
    x *= _M2
    np.right_shift(x, np.uint64(27), out=y)
    x ^= y
    x *= _M3
    np.right_shift(x, np.uint64(31), out=y)
    x ^= y
    return x


def word_hashes(words: list[str]) -> np.ndarray:
    """64-bit hashes of words without white space, all of them in one pass over their bytes."""
    out = [np.zeros(0, dtype=np.uint64)]
    for k in range(0, len(words), 1 << 16):
        raw = np.frombuffer(" ".join(words[k : k + (1 << 16)]).encode("utf-8", "surrogatepass"), dtype=np.uint8)
        n, spaces = len(raw), np.flatnonzero(raw == 32)
        sums = np.zeros(n + 1, dtype=np.uint64)
        np.cumsum((raw + np.uint64(1)) * _powers(_BASE, n), out=sums[1:])
        starts, ends = np.append(0, spaces + 1), np.append(spaces, n)
        out.append(mixed((sums[ends] - sums[starts]) * _powers(_INVERSE, n)[starts]))
    return np.concatenate(out)


def shingles(text: str, width: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the distinct runs of ``width`` lower-cased words, and their counts.

    A text of fewer words has one shingle of all of them, an empty one none.
    """
    h = word_hashes(text.lower().split())
    if not len(h):
        return np.zeros(0, dtype=np.uint64), np.zeros(0, dtype=np.int64)
    width = min(width, len(h))
    n = len(h) - width + 1
    run = h[:n].copy()
    for k in range(1, width):
        run = run * _M1 + h[k : k + n]
    found = np.sort(mixed(run))
    new = np.flatnonzero(found[1:] != found[:-1]) + 1
    if len(new) == n - 1:
        return found, np.ones(n, dtype=np.int64)
    starts = np.concatenate([[0], new])
    return found[starts], np.diff(starts, append=n)


def rarity_weights(text: str, common: bytes | None, documents: bytes | None, total: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct shingles (rising), their TF-IDF weights and their IDF, 1 + log(1 + N / n) / log(1 + N).

    ``common`` marks the shingles of more than one document, ``documents`` are their n (``marked_counts``); all others have n = 1.
    """
    found, counts = shingles(text)
    n = np.ones(len(found))
    if common:
        n[np.unpackbits(np.frombuffer(common, dtype=np.uint8), count=len(found)).view(bool)] = from_planes(documents)
    idf = rarity(n, total)
    return found, counts * idf, idf


def rarity(n: np.ndarray, total: int) -> np.ndarray:
    """IDF of shingles that n of ``total`` documents have."""
    return 1.0 + np.log1p(total / n) / np.log1p(max(total, 1))


def planes(values: np.ndarray) -> bytes:
    """Integers from 0 by planes of bytes, the lowest first, as many as the largest needs; their number comes first."""
    if not len(values):
        return b""
    width = max(1, (int(values.max()).bit_length() + 7) // 8)
    raw = np.ascontiguousarray(values, dtype="<u8").view(np.uint8).reshape(-1, 8)
    return bytes([width]) + np.ascontiguousarray(raw[:, :width].T).tobytes()


def from_planes(raw: bytes | None) -> np.ndarray:
    """The integers of ``planes`` (uint64)."""
    if not raw:
        return np.zeros(0, dtype=np.uint64)
    columns = np.frombuffer(raw, dtype=np.uint8, offset=1).reshape(raw[0], -1)
    out = np.zeros((columns.shape[1], 8), dtype=np.uint8)
    out[:, : raw[0]] = columns.T
    return out.view("<u8").reshape(-1)


def dealt_steps(rising: np.ndarray, parts: int):
    """``part, planes of the steps`` for each of ``parts`` equal ranges of 64-bit numbers that has some of ``rising``.

    Steps start at the range's lower end; ``np.cumsum`` gives the numbers counted from there.
    """
    lows = np.array([-(-(k << 64) // parts) for k in range(parts)], dtype=np.uint64)
    bounds = np.append(np.searchsorted(rising, lows), len(rising))
    for part in np.flatnonzero(np.diff(bounds)):
        yield int(part), planes(np.diff(rising[bounds[part] : bounds[part + 1]], prepend=lows[part]))


def merged_steps(rows: list[tuple[int, bytes]]) -> tuple[list[int], list[np.ndarray]]:
    """The chunks of rows ``chunk, planes of steps`` sorted by chunk, and the rising numbers of each."""
    chunks, found = [], []
    for chunk, steps in rows:
        if not chunks or chunks[-1] != chunk:
            chunks.append(chunk)
            found.append([])
        found[-1].append(np.cumsum(from_planes(steps), dtype=np.uint64))
    return chunks, [own[0] if len(own) == 1 else np.sort(np.concatenate(own)) for own in found]


def grouped_rows(batches):
    """``part, the other columns of its rows`` of every part from batches sorted by part, their first column."""
    last, kept = None, []
    for batch in batches:
        for row in zip(*(column.to_pylist() for column in batch.columns)):
            if row[0] != last and kept:
                yield last, kept
                kept = []
            last = row[0]
            kept.append(row[1:])
    if kept:
        yield last, kept


def marked_counts(counts: np.ndarray) -> tuple[bytes | None, bytes | None]:
    """A bit for every count, set where it is over 1, and these counts (``planes``); None where there is none."""
    common = counts > 1
    return (np.packbits(common).tobytes(), planes(counts[common])) if common.any() else (None, None)


class ConsistentSampler:
    """Improved consistent weighted sampling: the chance that a sample of two weighted sets agrees
    is their weighted Jaccard similarity.

    The random r, c (gamma distributed) and beta of a shingle and a sample come from 16 bits each
    of one hash, through fixed tables.
    """

    def __init__(self, samples: int, seed: int):
        rng = np.random.default_rng(seed)
        self.r = rng.gamma(2.0, 1.0, 65536).astype(np.float32)
        self.log_c = np.log(rng.gamma(2.0, 1.0, 65536)).astype(np.float32)
        self.salts = rng.integers(1, 2**63, samples, dtype=np.uint64) | np.uint64(1)

    def sketch(self, found: np.ndarray, weights: np.ndarray) -> np.ndarray:
        """One 64-bit value per sample; blocks of shingles keep the memory bounded."""
        best = np.full(len(self.salts), np.inf, dtype=np.float32)
        out = np.zeros(len(self.salts), dtype=np.uint64)
        for start in range(0, len(found), 2048):
            f = found[start : start + 2048, None]
            log_w = np.log(weights[start : start + 2048]).astype(np.float32)[:, None]
            z = mixed_in_place(f * self.salts).astype("<u8", copy=False).view("<u2").reshape(len(f), -1, 4)
            r = self.r.take(z[:, :, 0])
            beta = z[:, :, 2].astype(np.float32)
            beta *= np.float32(1 / 65536)
            t = log_w / r
            t += beta
            np.floor(t, out=t)
            np.subtract(t, beta, out=beta)
            beta *= r
            a = self.log_c.take(z[:, :, 1])
            a -= beta
            a -= r
            first = a.argmin(axis=0)
            samples = np.arange(len(self.salts))
            least = a[first, samples]
            better = least < best
            best[better] = least[better]
            drawn = mixed(found[start + first] + t[first, samples].astype(np.int64).astype(np.uint64) * _M1)
            out[better] = drawn[better]
        return out


def band_hashes(sketch: np.ndarray, rows: int) -> np.ndarray:
    groups = sketch[: len(sketch) // rows * rows].reshape(-1, rows)
    out = np.zeros(len(groups), dtype=np.uint64)
    for k in range(rows):
        out = mixed(out * _M1 + groups[:, k])
    return out


def weighted_jaccard(a, b) -> float:
    """Sum of the smaller over sum of the larger weights of two ``(shingles, weights)``."""
    (fa, wa), (fb, wb) = a[:2], b[:2]
    _, ia, ib = np.intersect1d(fa, fb, assume_unique=True, return_indices=True)
    shared = np.minimum(wa[ia], wb[ib]).sum()
    whole = wa.sum() + wb.sum() - shared
    return float(shared / whole) if whole > 0 else 0.0


# --- repeated substrings ---------------------------------------------------------------------

_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 2**64)


def _powers(base: int, n: int) -> np.ndarray:
    """``base**0 .. base**(n-1)`` modulo 2^64, kept and grown as needed."""
    kept = once(("powers", base), lambda: [np.ones(1, dtype=np.uint64)])
    if len(kept[0]) < n:
        out = np.full(max(n, 1 << 17), base, dtype=np.uint64)
        out[0] = 1
        kept[0] = np.multiply.accumulate(out)
    return kept[0][:n]


def gram_hashes(raw: np.ndarray, size: int) -> np.ndarray:
    """A 64-bit hash of every run of ``size`` bytes; equal runs have equal hashes."""
    n = len(raw)
    sums = np.zeros(n + 1, dtype=np.uint64)
    np.cumsum((raw.astype(np.uint64) + np.uint64(1)) * _powers(_BASE, n), out=sums[1:])
    return mixed((sums[size:] - sums[:-size]) * _powers(_INVERSE, n - size + 1))


def sliding_least(values: np.ndarray, width: int) -> np.ndarray:
    """The least of every ``width`` neighbours, by block-wise running minima from both sides."""
    n = len(values)
    padded = np.full(-(-n // width) * width, np.iinfo(values.dtype).max, dtype=values.dtype)
    padded[:n] = values
    blocks = padded.reshape(-1, width)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    behind = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    count = n - width + 1
    return np.minimum(behind[:count], ahead[width - 1 : width - 1 + count])


def anchored_runs(raw: bytes, length: int, gram: int, most: int):
    """Cut all starts of ``length``-byte strings into runs that share their least gram.

    Equal strings have the same least gram, so they can only lie in runs with the same key.
    Returns rows ``(key, content, start, count, inner)``: a run covers ``raw[start:start + count -
    1 + length]``, whose hash is ``content``; ``inner`` tells that its gram occurs twice in it, so
    that strings of the run may be equal to each other.  A run has ``most`` starts at most.
    """
    import xxhash

    if len(raw) < length:
        return []
    data = np.frombuffer(raw, dtype=np.uint8)
    hashes = gram_hashes(data, gram)
    # The low bits hold the place, so that the least gram's first place comes with it.
    place = np.arange(len(hashes), dtype=np.uint64) & np.uint64(0xFFFF)
    least = sliding_least((hashes & ~np.uint64(0xFFFF)) | place, length - gram + 1)
    keys = least >> np.uint64(16)
    starts = np.concatenate([[0], np.flatnonzero(keys[1:] != keys[:-1]) + 1])
    ends = np.append(starts[1:], len(keys))
    out = []
    for start, end, key, low in zip(
        starts.tolist(), ends.tolist(), keys[starts].tolist(), (least[starts] & np.uint64(0xFFFF)).tolist()
    ):
        at = start + ((low - start) & 0xFFFF)
        anchor = raw[at : at + gram]
        for first in range(start, end, most):
            count = min(end - first, most)
            stop = first + count - 1 + length
            content = xxhash.xxh3_64_intdigest(raw[first:stop]) - (1 << 63)
            inner = raw.find(anchor, raw.find(anchor, first, stop) + 1, stop) >= 0
            out.append((key, content, first, count, inner))
    return out


def _packed(codes: np.ndarray) -> np.ndarray:
    """The next seven codes of every place of the circular text in one integer."""
    key = np.zeros(len(codes), dtype=np.int64)
    for k in range(7):
        key = (key << 9) | np.roll(codes, -k)
    return key


def suffix_order(codes: np.ndarray, depth: int) -> np.ndarray:
    """Places of the circular text ordered by their next ``depth`` codes at least (prefix doubling).

    ``codes`` are below 512.  Places that agree in all of these come in any order.
    """
    n, key, known = len(codes), _packed(codes), 7
    order = np.argsort(key)
    ordered = key[order]
    first = np.concatenate([[True], ordered[1:] != ordered[:-1]])
    # A place's rank is where its group begins; it stays when others are divided.
    rank = np.empty(n, dtype=np.int64)
    rank[order] = np.maximum.accumulate(np.where(first, np.arange(n), 0))
    while known < depth:
        # Only groups of several places are sorted again.
        shared = np.flatnonzero(~(first & np.append(first[1:], True)))
        if not len(shared):
            break
        some = order[shared]
        key = rank[some] * n + rank[(some + known) % n]
        rise = np.argsort(key)
        some, key = some[rise], key[rise]
        order[shared] = some
        begins = np.concatenate([[True], key[1:] != key[:-1]])
        first[shared] = begins
        rank[some] = np.maximum.accumulate(np.where(begins, shared, 0))
        known *= 2
    return order


def _ranges(low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """All integers of the half-open intervals, one interval after the other."""
    sizes = high - low
    shift = np.repeat(low - np.concatenate([[0], np.cumsum(sizes)[:-1]]), sizes)
    return np.arange(sizes.sum()) + shift


def long_common_prefixes(codes: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """The suffix order, and for each neighbouring pair whether it shares ``length`` codes or more.

    Interval expansion on the Burrows-Wheeler transform: starting with the intervals of the strings of
    (up to) seven codes, which one comparison of packed codes gives, every interval
    of a string w is extended backwards to the intervals of c w for the codes c before it, breadth
    first, so that common prefixes are found by increasing value: the boundary behind an interval
    of c w that is still unknown has the common prefix |w|.  The search stops at ``length``; what
    is unknown then is at least that long.
    """
    n = len(codes)
    order = suffix_order(codes, length)
    before = codes[order - 1]
    step = np.empty(n, dtype=np.int64)
    step[np.argsort(before, kind="stable")] = np.arange(n)
    first_code = np.sort(before, kind="stable")
    known = np.zeros(n + 1, dtype=bool)
    short = min(7, length)
    begun = _packed(codes)[order] >> np.int64(9 * (7 - short))
    low = np.concatenate([[0], np.flatnonzero(begun[1:] != begun[:-1]) + 1])
    high = np.append(low[1:], n)
    known[low], known[n] = True, True
    # As at every later level, only what is bounded by a common prefix of one code less can find new ones.
    closed = np.append(begun[1:] >> np.int64(9) == begun[:-1] >> np.int64(9), False)[high - 1]
    low, high = low[closed], high[closed]
    for _ in range(length - short if len(low) else 0):
        sizes = high - low
        at = step[_ranges(low, high)]
        owner = np.repeat(np.arange(len(low)), sizes)
        rise = np.argsort(at)
        at, owner = at[rise], owner[rise]
        cut = np.flatnonzero((at[1:] != at[:-1] + 1) | (owner[1:] != owner[:-1]) | (first_code[at[1:]] != first_code[at[:-1]]))
        low, high = at[np.concatenate([[0], cut + 1])], at[np.append(cut, len(at) - 1)] + 1
        new = ~known[high]
        low, high = low[new], high[new]
        known[high] = True
        if not len(low):
            break
    return order, ~known[1:-1]


def repeated_starts(pieces: list[bytes], length: int) -> list[np.ndarray]:
    """For every piece, which of its ``length``-byte strings occur again at another place or piece."""
    codes = np.zeros(sum(len(p) + 1 for p in pieces), dtype=np.int64)
    offsets, at = [], 0
    for piece in pieces:
        codes[at : at + len(piece)] = np.frombuffer(piece, dtype=np.uint8).astype(np.int64) + 1
        offsets.append(at)
        at += len(piece) + 1
    order, shared = long_common_prefixes(codes, length)
    again = np.zeros(len(codes), dtype=bool)
    again[order[1:][shared]] = True
    again[order[:-1][shared]] = True
    return [again[a : a + max(len(p) - length + 1, 0)] for a, p in zip(offsets, pieces)]


def true_runs(flags: np.ndarray) -> list[tuple[int, int]]:
    """First and last place of every run of true values."""
    edges = np.flatnonzero(np.diff(np.concatenate([[0], flags.astype(np.int8), [0]])))
    return [(int(a), int(b) - 1) for a, b in zip(edges[::2], edges[1::2])]


def difference_prefixes(pivot, other, least: float, once_only: float) -> tuple[float, float, list[int], list[float], int]:
    """Similarity of a text to its pivot, and the shingles by which a text like it can be found.

    Let d be the difference of the weights of a text and the pivot's, D the sum of its magnitudes
    and W the text's weight.  For texts x, y of similarity s = ``least`` or more, the magnitudes
    they share (same sign, the smaller of both) are at least (D_x + D_y - c (W_x + W_y)) / 2 with
    c = (1 - s) / (1 + s).  If y is not similar to the pivot, D_y > c (W_y + W_p), and both must
    share something.  So, with shingles in one order for all texts of the pivot, the first shared one lies among
    those of x before the last ones of joint magnitude a_x, and likewise for y, where

        a_x = max(D_x - c (1 + 1/s) W_x, (D_x + c (W_p - W_x)) / 2),   a_y = D_y - c (1 + 1/s) W_y.

    What the text has and no other row of the corpus (an IDF of ``once_only``) is shared with nothing:
    it counts in D, but not among the magnitudes that may be shared.

    Returns the similarity, (D - c W) / 2, these leading shingles, for each the joint magnitude of
    it and those behind it, and how many of them lead if the partner is not similar to the pivot: the
    others lead only where the text itself is not.  At their first common shingle, both magnitudes of
    a similar pair reach the sum of the pair's (D - c W) / 2.
    """
    (fa, wa, rarity_a), (fb, wb, rarity_b) = pivot, other
    both, ia, ib = np.intersect1d(fa, fb, assume_unique=True, return_indices=True)
    only_a, only_b = np.ones(len(fa), dtype=bool), np.ones(len(fb), dtype=bool)
    only_a[ia] = only_b[ib] = False
    shift = wb[ib] - wa[ia]
    shingle = np.concatenate([both, fa[only_a], fb[only_b]])
    size = np.concatenate([np.abs(shift), wa[only_a], wb[only_b]])
    rarity = np.concatenate([rarity_a[ia], rarity_a[only_a], rarity_b[only_b]])
    added = np.arange(len(shingle)) >= len(shingle) - only_b.sum()
    total, weight, weight_p = size.sum(), wb.sum(), wa.sum()
    whole = weight + weight_p
    similarity = float((whole - total) / (whole + total)) if whole > 0 else 0.0
    shared = (size > 0) & ~(added & (rarity >= once_only * (1 - 1e-12)))
    shingle, size, added, rarity = shingle[shared], size[shared], added[shared], rarity[shared]
    # What the pivot lacks comes first, the rarest before: members rarely add the same.  They often lose
    # the same, above all what only the pivot has, and rarely what most of them have.
    order = np.lexsort((shingle, np.where(added, -rarity, rarity), ~added))
    # Magnitude of this shingle and all behind it.
    behind = np.cumsum(size[order][::-1])[::-1]
    c = (1 - least) / (1 + least)
    alone = total - c * (1 + 1 / least) * weight
    beside = max(alone, (total + c * (weight_p - weight)) / 2)

    def leading(bound):
        return int((behind >= bound * (1 - 1e-9) - 1e-9).sum())

    n = leading(beside if similarity >= least else alone)
    return similarity, float(total - c * weight) / 2, shingle[order[:n]].view(np.int64).tolist(), behind[:n].tolist(), leading(beside)


def compared_pairs(batches, total: int):
    """``a, weighted shingles of a, b, weighted shingles of b`` of every row ``a, b, text_a, common_a,
    documents_a, text_b, common_b, documents_b``; a's are kept while a stays."""
    last, kept = None, None
    for batch in batches:
        columns = [batch.column(k) for k in range(8)]
        for i in range(batch.num_rows):
            left = columns[0][i].as_py()
            if left != last:
                last, kept = left, rarity_weights(*(c[i].as_py() for c in columns[2:5]), total)
            yield left, kept, columns[1][i].as_py(), rarity_weights(*(c[i].as_py() for c in columns[5:8]), total)


def aligned_parts(raw: bytes, key: int, length: int, gram: int, step: int) -> list[tuple[int, int, int]]:
    """Divide the starts of a run by their distance to its least gram, ``step`` by ``step``.

    Equal strings have the same distance, and all strings of a part share ``length - step + 1``
    bytes at a fixed place, whose hash names the part.  Returns ``(first, count, part)``.
    """
    import xxhash

    anchors = np.flatnonzero(gram_hashes(np.frombuffer(raw, dtype=np.uint8), gram) >> np.uint64(16) == np.uint64(key))
    starts = np.arange(len(raw) - length + 1)
    anchor = anchors[np.searchsorted(anchors, starts)]
    ring = (anchor - starts) // step
    edges = np.flatnonzero((anchor[1:] != anchor[:-1]) | (ring[1:] != ring[:-1])) + 1
    out = []
    for first, end in zip([0, *edges.tolist()], [*edges.tolist(), len(starts)]):
        shared = int(anchor[first]) - step * int(ring[first])
        name = xxhash.xxh3_64_intdigest(raw[shared : shared + length - step + 1], seed=(key * 1000003 + int(ring[first])) % 2**64)
        out.append((first, end - first, name - (1 << 63)))
    return out


# --- exact duplicates --------------------------------------------------------------------------

def one_blank(text: str) -> str:
    """Every run of white space (tab to carriage return, blank) as one blank."""
    import re

    # Runs that are one blank already need no change.
    pattern = once("one_blank", lambda: re.compile("[\t-\r][ \t-\r]*| [ \t-\r]+"))
    return pattern.sub(" ", text)


def fingerprint(content: bytes) -> int:
    """A signed 64-bit hash."""
    import xxhash

    return xxhash.xxh3_64_intdigest(content) - (1 << 63)


def sha256(content: bytes) -> bytes:
    import hashlib

    return hashlib.sha256(content).digest()


class ContentTable:
    """Open addressing with linear probing; entries are equal only if their complete contents are."""

    def __init__(self):
        self.slots, self.prints, self.contents, self.held = [-1] * 64, [], [], 0

    def place(self, mark: int, content: bytes) -> int:
        """The number of the content's entry, a new one (the next number) where it has none."""
        slots, mask = self.slots, len(self.slots) - 1
        at = mark & mask
        while (k := slots[at]) >= 0:
            if self.prints[k] == mark and self.contents[k] == content:
                return k
            at = (at + 1) & mask
        slots[at] = k = len(self.contents)
        self.prints.append(mark)
        self.contents.append(content)
        self.held += len(content)
        if 3 * len(self.contents) > 2 * len(slots):
            self._grow()
        return k

    def full(self, most: int) -> bool:
        """More than ``most`` bytes are held; a single content may be longer."""
        return self.held > most and len(self.contents) > 1

    def _grow(self):
        mask = 2 * len(self.slots) - 1
        self.slots = [-1] * (mask + 1)
        for k, mark in enumerate(self.prints):
            at = mark & mask
            while self.slots[at] >= 0:
                at = (at + 1) & mask
            self.slots[at] = k


def merged_records(places: list[int], lows: list[tuple], counts: list[int], entries: int) -> list[tuple]:
    """For every entry of a table the least of ``lows`` (no id, id, record) and the sum of ``counts``."""
    least, total = [None] * entries, [0] * entries
    for k, low, n in zip(places, lows, counts):
        total[k] += n
        if least[k] is None or (low[0], low[1] or 0, low[2]) < (least[k][0], least[k][1] or 0, least[k][2]):
            least[k] = low
    return list(zip(least, total))


def record_batches(rows: list[tuple], kinds: list, size_at: int | None = None, most: int = 8 << 20):
    """Record batches of the rows; ``size_at`` is the place of a row's size in bytes, ``most`` about the bytes of a batch."""
    import pyarrow as pa

    names = [str(k) for k in range(len(kinds))]
    start, held = 0, 0
    for k, row in enumerate(rows):
        held += row[size_at] if size_at is not None else 0
        if held >= most or k + 1 - start >= 10_000 or k + 1 == len(rows):
            columns = zip(*rows[start : k + 1])
            yield pa.RecordBatch.from_arrays([pa.array(c, kind) for c, kind in zip(columns, kinds)], names)
            start, held = k + 1, 0


# --- alignment of two tokenizers -----------------------------------------------------------------


class _Tokens:
    """A tokenizer's ids of a list of texts, and its tokens' bytes, sizes and ids in decimal, place by place."""

    def __init__(self, encode, token_bytes: list[bytes]):
        import pyarrow as pa

        self.encode = encode
        self.bytes = pa.array(token_bytes, pa.binary())
        self.sizes = pa.array([len(t) for t in token_bytes], pa.int64())
        self.numerals = pa.array([str(k) for k in range(len(token_bytes))])


def byte_tokens(ranks: str, file: str) -> _Tokens:
    """Tokenizer A: a blank and the text by the byte-level vocabulary."""

    def load():
        encoder = byte_bpe(ranks, file)
        token_bytes = [b""] * (max(encoder.ranks.values()) + 1)
        for token, k in encoder.ranks.items():
            token_bytes[k] = token
        return _Tokens(lambda texts: [encoder.encode_ordinary(" " + t) for t in texts], token_bytes)

    return once(("byte_tokens", ranks, file), load)


def piece_tokens(file: str) -> _Tokens:
    """Tokenizer B: the pieces of the model, which puts a blank before the text itself."""

    def load():
        import re

        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=file)
        token_bytes = []
        for k in range(model.get_piece_size()):
            piece = model.id_to_piece(k)
            byte = re.fullmatch(r"<0x([0-9A-F]{2})>", piece)
            token_bytes.append(bytes([int(byte[1], 16)]) if byte else piece.replace("\u2581", " ").encode())
        return _Tokens(lambda texts: model.encode(texts, num_threads=1), token_bytes)

    return once(("piece_tokens", file), load)
