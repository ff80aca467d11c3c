import collections
import hashlib
import math
import os
import re
import time
import zlib

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st

import corpus_pipeline
from gapweave.llm import kernels, languages, licenses, minhash, pii, repeats
from gapweave.llm.queries import op5_pii
from gapweave.operators import settle as settled
from tests.llm.fixtures import documents, empty, rows, words


# --- repeated strings


def _covered(texts, length):
    raws = [(t or "").encode() for t in texts]
    count = collections.Counter(r[i : i + length] for r in raws for i in range(len(r) - length + 1))
    out = []
    for r in raws:
        change = np.zeros(len(r) + 1, dtype=int)
        for i in range(len(r) - length + 1):
            if count[r[i : i + length]] > 1:
                change[i] += 1
                change[i + length] -= 1
        covered = np.cumsum(change[:-1]) > 0
        kept = bytes(b for b, c in zip(r, covered) if not c)
        out.append((len(r), int(covered.sum()), len(kernels.true_runs(covered)), hashlib.sha256(kept).hexdigest()))
    return out


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text("ab", max_size=40).map(str.encode), min_size=1, max_size=5), st.integers(2, 9))
def test_interval_expansion_finds_every_repeat(pieces, length):
    count = collections.Counter(p[i : i + length] for p in pieces for i in range(len(p) - length + 1))
    want = [[count[p[i : i + length]] > 1 for i in range(len(p) - length + 1)] for p in pieces]
    assert [f.tolist() for f in kernels.repeated_starts(pieces, length)] == want


def test_runs_tile_the_starts():
    raw = (words(5, 200) + "ab" * 300).encode()
    runs = kernels.anchored_runs(raw, 200, 32, 50)
    places = [s for _, _, start, count, _ in runs for s in range(start, start + count)]
    assert places == list(range(len(raw) - 199)) and all(r[3] <= 50 for r in runs)
    assert kernels.anchored_runs(b"x" * 199, 200, 32, 50) == []


@pytest.mark.parametrize("largest", [1024, 1])
def test_repeats_against_brute_force(spark, largest):
    shared = words(6, 60)
    some = rows() + [(20 + i, words(30 + i, 10) + shared + words(60 + i, 20), "en", "a") for i in range(12)]
    some += [(40, "ab" * 400, "en", "a"), (41, "x" * 199, "en", "a"), (42, "x" * 200, "en", "a"), (43, "y" * 201, "en", "a")]
    some += [(50, "z" + "q" * 120, "en", "a"), (51, "é" * 150, "en", "b")]
    want = collections.Counter((i, *c) for (i, *_), c in zip(some, _covered([t for _, t, *_ in some], 200)))
    out = repeats.remove_repeats(documents(spark, some), largest=largest).collect()
    assert collections.Counter((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in out) == want
    for r in out:
        assert (r.kept is None) == (r.n_removed == 0)
        assert r.n_removed == sum(s.stop - s.start for s in r.removed or [])


def test_repeats_of_nothing(spark):
    assert repeats.remove_repeats(empty(spark)).collect() == []


# --- language


def _languages(n=240):
    kinds = {"xx": "abcde", "xy": "abcdf", "zz": "mnopq", "zy": "mnopr"}
    out = []
    for i in range(n):
        lang = list(kinds)[i % 4]
        rng = np.random.default_rng(i)
        text = " ".join("".join(rng.choice(list(kinds[lang]), 4)) for _ in range(60))
        out.append((i, text, lang, "a"))
    return out


def test_held_out_languages_are_predicted(spark):
    docs = documents(spark, _languages())
    model = languages.train(docs, per_language=1000)
    assert sorted(map(sorted, model.families)) == [["xx", "xy"], ["zy", "zz"]]
    truth = {i: lang for i, _, lang, _ in _languages()}
    out = languages.identify(docs, model).collect()
    assert np.mean([truth[r.doc_id] == r.lang_pred for r in out]) > 0.97
    assert all(0 <= r.score <= 1 for r in out)


def test_languages_of_awkward_rows(spark):
    docs = documents(spark)
    model = languages.train(docs)
    out = {r.doc_id: r for r in languages.identify(docs, model).collect()}
    assert all(out[i].lang_pred == "und" and out[i].score == 0 for i in (5, 6, 7, 8))
    assert {r.lang_pred for r in out.values()} <= {"en", "de", "fr", "und"}
    kept = languages.keep_identified(docs, model)
    assert kept.schema == docs.schema
    assert collections.Counter(r.doc_id for r in kept.collect()) == collections.Counter(
        i for i, *_ in rows() if i not in (5, 6, 7, 8)
    )


def test_nothing_to_learn_from(spark):
    assert languages.train(empty(spark)) is None
    out = languages.identify(documents(spark, [(1, "abc", None, "a")]), None).collect()
    assert [(r.lang_pred, r.score) for r in out] == [("und", 0.0)]
    assert languages.keep_identified(empty(spark), None).collect() == []


def test_one_language_needs_no_machine(spark):
    model = languages.train(documents(spark, [(i, words(i, 20), "en", "a") for i in range(20)]))
    assert model.predict("abc") == ("en", 1.0)


# --- personal data

_PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def _luhn(digits):
    doubled = [int(d) * (1 + i % 2) for i, d in enumerate(reversed(digits))]
    return sum(d - 9 if d > 9 else d for d in doubled) % 10 == 0


def _base(text):
    out = []
    for kind, pattern in _PATTERNS.items():
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m.group())
            ok = {
                "email": lambda: True,
                "ip": lambda: all(int(p) <= 255 for p in m.group().split(".")),
                "card": lambda: 13 <= len(digits) <= 19 and _luhn(digits),
                "phone": lambda: 9 <= len(digits) <= 15,
            }[kind]()
            if ok:
                out.append(f"{kind}:{m.start()}:{m.end()}")
    return ",".join(out)


_HARD = [
    "a@b@c.d x@y.z_w@q.r.. +49 (0)30-1234567 4111 1111-1111 1111 1.2.3.4.5.6.7.8 999.1.1.1 000001.2.3.4",
    "😀 é a.b@c.de 😀 192.168.0.1 " * 50,
    "a.b" * 3000 + "@x.yy",
    "+1" * 500 + "@",
    "1" * 5000,
    "+1234567890123456 +123456789. +12 345 6789012- aa.bb@1.2.3.4 1@2.3.4.5.6.7",
    "4111111111111111,4111111111111112 5500-0000-0000-0004",
    "a@b.cc_dd@e.f @ @@ x@ .@a.b %@a-b.c-",
]


def test_base_spans_against_patterns(spark):
    rng = np.random.default_rng(3)
    some = rows() + [(100 + i, t, "en", "a") for i, t in enumerate(_HARD)]
    some += [(200 + i, "".join(rng.choice(list("ab1.2@+-_ 5(%é"), 80)), "en", "a") for i in range(150)]
    out = pii.personal_data(documents(spark, some)).select("doc_id", pii.listing(tuple(pii.KINDS)).alias("spans")).collect()
    assert collections.Counter((r.doc_id, r.spans) for r in out) == collections.Counter((i, _base(t)) for i, t, *_ in some)


def test_revealing_words_are_found_and_replaced(spark):
    noise = [(i, words(i, 40), "en", "a") for i in range(60)]
    mails = [(100 + i, f"{words(500 + i, 9)} Zebulon writes from zeb@mail.example often {words(700 + i, 9)}", "en", "a") for i in range(5)]
    other = [(200, "somebody else at one@mail.example here", "en", "a"), (201, "often seen writes from here", "en", "a")]
    docs = documents(spark, noise + mails + other * 2)
    found = {r.doc_id: r for r in pii.personal_data(docs, support=3).collect()}
    for i, text, *_ in mails:
        named = [text[s.start : s.end] for s in found[i].term]
        assert "Zebulon" in named
    assert not found[200].term and not found[201].term
    clean = {r.doc_id: r for r in pii.sanitise(docs, support=3).collect()}
    assert "[TERM]" in clean[100].text and "Zebulon" not in clean[100].text and "[EMAIL]" in clean[100].text
    assert clean[201].text == other[1][1] and clean[100].n_chars == len(clean[100].text)


def test_disclosure_is_the_share_of_information(spark):
    some = [(i, f"Alpha a{i}@b.cc tail", "en", "a") for i in range(8)] + [(50 + i, "Beta same@b.cc", "en", "a") for i in range(4)]
    some += [(90 + i, "Beta", "en", "a") for i in range(4)]
    docs = documents(spark, some)
    found = pii.detect(docs)
    pairs = {(r.entity, r.term): r.disclosure for r in pii.disclosing_pairs(docs, found, threshold=0.0, support=3).collect()}
    assert pairs == {("email:same@b.cc", "beta"): pytest.approx(math.log2(4 * 16 / (4 * 8)) / math.log2(16 / 4))}


def _revealing(some, threshold=0.9):
    word = r"""(?<![^\s(\["'])[^\W\d_]{3,40}(?=[.,;:!?)\]"']*(?:\s|$))"""
    held = {i: {m.group().lower() for m in re.finditer(_PATTERNS["email"], t)} for i, t, *_ in some}
    terms = {i: {m.group().lower() for m in re.finditer(word, t)} for i, t, *_ in some}
    n_e = collections.Counter(e for es in held.values() for e in es)
    n_t = collections.Counter(t for ts in terms.values() for t in ts)
    n_both = collections.Counter((e, t) for i in held for e in held[i] for t in terms[i])
    share = {
        (e, t): math.log2(n * len(some) / (n_e[e] * n_t[t])) / math.log2(len(some) / n_e[e])
        for (e, t), n in n_both.items()
    }
    return {
        i: [m.span() for m in re.finditer(word, t) if any(share[e, m.group().lower()] >= threshold for e in held[i])]
        for i, t, *_ in some
    }


def test_every_revealing_word_of_the_documents_counts(spark, tmp_path):
    some = [(i, words(i % 7, 40), "en", "a") for i in range(40)]
    far = words(3, 40)
    some += [(100, f"Zebulon {far} z@mail.example {far} Quillon, then zebulon.", "en", "a")]
    some += [(101 + i, f"Marwick {far} two@mail.example, 1st{i} {far} marwick", "en", "a") for i in range(2)]
    want = _revealing(some)
    assert len(want[100]) >= 3 and len(want[101]) == 2
    found = pii.personal_data(documents(spark, some), support=1).collect()
    assert {r.doc_id: [(s.start, s.end) for s in r.term] for r in found} == want
    documents(spark, some).write.parquet(f"{tmp_path}/documents.parquet")
    spans = {r.doc_id: r.spans for r in op5_pii(spark, str(tmp_path)).collect()}
    for i, places in want.items():
        assert [p for p in spans[i].split(",") if p.startswith("term:")] == [f"term:{a}:{b}" for a, b in places]
    clean = {r.doc_id: r.text for r in corpus_pipeline.without_personal_data(spark, documents(spark, some), "").collect()}
    assert not re.search("zebulon|quillon|marwick", (clean[100] + clean[101]).lower())


def test_sanitised_rows_keep_their_columns(spark):
    docs = documents(spark, rows() + [(100 + i, t, "en", "a") for i, t in enumerate(_HARD)])
    out = pii.sanitise(docs)
    assert out.schema.names == docs.schema.names
    texts = collections.Counter((r.doc_id, r.text) for r in out.collect())
    assert all(texts[(i, t)] for i, t, *_ in rows())
    assert texts[(103 - 1, "[EMAIL]")] == 1
    assert sum(texts.values()) == docs.count()
    assert pii.sanitise(empty(spark)).collect() == []


# --- near-duplicates


def test_sampler_agrees_as_often_as_the_similarity():
    a = {k: 1.0 + k % 5 for k in range(1, 400)}
    b = {k: (1.0 + k % 5) * (2 if k % 9 == 0 else 1) for k in range(40, 440)}
    form = lambda d: (kernels.mixed(np.array(sorted(d), dtype=np.uint64)), np.array([d[k] for k in sorted(d)]))
    order = lambda f, w: (np.sort(f), w[np.argsort(f)])
    fa, fb = order(*form(a)), order(*form(b))
    whole = set(a) | set(b)
    want = sum(min(a.get(k, 0), b.get(k, 0)) for k in whole) / sum(max(a.get(k, 0), b.get(k, 0)) for k in whole)
    assert kernels.weighted_jaccard(fa, fb) == pytest.approx(want)
    sampler = kernels.ConsistentSampler(3000, 5)
    assert np.mean(sampler.sketch(*fa) == sampler.sketch(*fb)) == pytest.approx(want, abs=0.04)


def _exact_weights(texts):
    """TF-IDF weights of the runs of five words (all of a shorter text), word by word."""
    bags = []
    for text in texts:
        w = (text or "").lower().split()
        size = min(5, len(w))
        bags.append(collections.Counter(tuple(w[i : i + size]) for i in range(len(w) - size + 1) if size))
    n, total = collections.Counter(run for bag in bags for run in bag), len(texts)
    return [{run: c * (1 + math.log1p(total / n[run]) / math.log1p(total)) for run, c in bag.items()} for bag in bags]


def _jaccard(a, b):
    shared = sum(min(w, b[run]) for run, w in a.items() if run in b)
    whole = sum(a.values()) + sum(b.values()) - shared
    return shared / whole if whole else 0.0


def test_near_duplicates_against_brute_force(spark):
    some, rng = rows(), np.random.default_rng(8)
    for group in range(12):
        base = words(100 + group, 150).split()
        for k in range(6):
            copy = list(base)
            for at in rng.integers(0, 150, k):
                copy[at] = f"edit{group}{k}{at}"
            some.append((1000 + 10 * group + k, " ".join(copy), "en", "a"))
    docs = documents(spark, some)
    weighted = _exact_weights([t for _, t, *_ in some])
    parent = list(range(len(some)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(some)):
        for j in range(i):
            if _jaccard(weighted[i], weighted[j]) >= 0.8:
                a, b = sorted((find(i), find(j)))
                parent[b] = a
    groups = collections.defaultdict(list)
    for i in range(len(some)):
        groups[find(i)].append(some[i][0])
    want = collections.Counter()
    for ids in groups.values():
        least = min((i for i in ids if i is not None), default=None)
        want.update((i, least) for i in ids)
    out = minhash.near_duplicates(docs).collect()
    assert collections.Counter((r.doc_id, r.class_id) for r in out) == want
    kept = minhash.keep_first(docs)
    assert kept.schema.names == docs.schema.names
    assert kept.count() == len(groups)


def test_frequencies_are_those_of_single_shingles(spark, monkeypatch):
    monkeypatch.setattr(minhash, "PART_CHARACTERS", 20_000)
    monkeypatch.setattr(minhash, "CHUNK", 3000)
    left = words(900, 24).split()
    right = left[:-1] + ["other"]
    some = rows() + [(500, " ".join(left), "en", "a"), (501, " ".join(right), "en", "a")]
    some += [(1000 + i, f"one two three four w{i % 40}", "en", "a") for i in range(300)]
    counts = collections.Counter(s for _, t, *_ in some for s in kernels.shingles(t or "")[0].tolist())
    out = minhash.with_frequencies(documents(spark, some)).collect()
    assert len(out) == len(some)
    for r in out:
        found, weights, idf = kernels.rarity_weights(r.text, r.common, r.documents, len(some))
        n = np.array([counts[s] for s in found.tolist()])
        assert np.allclose(idf, 1 + np.log1p(len(some) / np.maximum(n, 1)) / np.log1p(len(some)))
        assert np.allclose(weights, kernels.shingles(r.text)[1] * idf)
    plain = dict(zip((i for i, *_ in some), _exact_weights([t for _, t, *_ in some])))
    exact = {r.doc_id: kernels.rarity_weights(r.text, r.common, r.documents, len(some)) for r in out}
    similarity = kernels.weighted_jaccard(exact[500], exact[501])
    assert similarity == pytest.approx(_jaccard(plain[500], plain[501]))
    for least, joined in ((similarity - 1e-6, True), (similarity + 1e-6, False)):
        classes = {r.doc_id: r.class_id for r in minhash.near_duplicates(documents(spark, some), least).collect()}
        assert (classes[501] == classes[500]) == joined


def test_near_duplicates_of_nothing(spark):
    assert minhash.near_duplicates(empty(spark)).collect() == []
    assert minhash.keep_first(empty(spark)).collect() == []


# --- licences


def test_licences_survive_their_variants(spark):
    mit = dict(reversed(licenses.KNOWN))["MIT"] if False else licenses._MIT
    variants = [
        "Copyright (c) 2001 Some One\n\n" + mit,
        "# " + mit.upper().replace("NONINFRINGEMENT", "NON-INFRINGEMENT").replace(". ", ".\n# "),
        "MIT License\n\n(c) 1999 X\nAll rights reserved.\n" + mit.replace('"', "'"),
        mit + " and more",
        "Some text.\nReleased under the MIT Licence.\nLicensed under CC BY-NC 4.0\n",
    ]
    out = {r.doc_id: r for r in licenses.scan(documents(spark, rows() + [(100 + i, v, "en", "a") for i, v in enumerate(variants)])).collect()}
    assert [out[100 + i].license for i in range(5)] == ["MIT", "MIT", "MIT", None, None]
    assert out[104].notices == "CC-BY-NC-4.0,MIT"
    assert all(out[i].license is None and out[i].notices == "" for i, *_ in rows())
    assert out[5].digest == out[6].digest == hashlib.md5(b"").hexdigest()
    assert licenses.scan(empty(spark)).collect() == []


def test_links_of_the_second_round_need_no_agreement(spark):
    # Groups with a similarity far below one half of agreeing samples.
    some = []
    for group in range(60):
        pool = [words(5000 + 10 * group + k, 12) for k in range(6)]
        rng = np.random.default_rng(group)
        some += [(10 * group + k, " ".join(pool[j] for j in rng.permutation(6)[:4]), "en", "a") for k in range(6)]
    docs, least = documents(spark, some), 0.4
    rich = minhash.with_frequencies(docs)
    weighted = {r.doc_id: kernels.rarity_weights(r.text, r.common, r.documents, len(some)) for r in rich.collect()}
    sampler = kernels.ConsistentSampler(minhash.BANDS * minhash.ROWS, minhash.SEED)
    bands = {i: kernels.band_hashes(sampler.sketch(f, w), minhash.ROWS) for i, (f, w, _) in weighted.items()}
    classes = {r.doc_id: r.class_id for r in minhash.near_duplicates(docs, least).collect()}
    pairs = [(i, j) for i in bands for j in bands if i // 10 == j // 10 and i < j and (bands[i] == bands[j]).any()]
    similar = [(i, j) for i, j in pairs if kernels.weighted_jaccard(weighted[i], weighted[j]) >= least]
    assert similar and all(classes[i] == classes[j] for i, j in similar)


def test_second_round_meets_similar_pairs_and_few_others():
    # Near copies of one text, a few words of each changed, some in the same places as in another one.
    rng, base, least = np.random.default_rng(3), words(77, 300).split(), 0.8
    texts = []
    for k in range(90):
        own = list(base if k % 3 or not texts else texts[-1].split())
        for place in rng.integers(0, 300, 2 if k % 3 == 0 else 9):
            own[place] = f"w{k}x{place}"
        texts.append(" ".join(own))
    count = collections.Counter(s for t in texts for s in kernels.shingles(t)[0].tolist())
    weighted = []
    for t in texts:
        found, times = kernels.shingles(t)
        idf = kernels.rarity(np.array([count[s] for s in found.tolist()], dtype=float), len(texts))
        weighted.append((found, times * idf, idf))
    once_only = float(kernels.rarity(1.0, len(texts)))
    sides = [kernels.difference_prefixes(weighted[0], w, least, once_only) for w in weighted]
    apart = [s[0] < least for s in sides]
    met, wanted = collections.Counter(), set()
    for x in range(1, 90):
        for y in range(1, 90):
            if x == y or not apart[y] or (apart[x] and x > y):
                continue
            (_, need_x, leading_x, behind_x, beside), (_, need_y, leading_y, behind_y, _) = sides[x], sides[y]
            at_y = dict(zip(leading_y, behind_y))
            for s, b in list(zip(leading_x, behind_x))[:beside]:
                met[x, y] += s in at_y and min(b, at_y[s]) >= need_x + need_y - 1e-6
            if kernels.weighted_jaccard(weighted[x], weighted[y]) >= least:
                wanted.add((x, y))
    assert len(wanted) > 10 and all(met[pair] for pair in wanted)
    # Without these bounds all pairs of the group met, by many shingles each.
    assert sum(map(bool, met.values())) < 2 * len(wanted) + 40


def test_steps_leave_only_their_result(spark, tmp_path, monkeypatch):
    monkeypatch.setattr("gapweave.operators.settle.shared_folder", lambda _: str(tmp_path))
    docs = documents(spark, rows() + [(100 + i, t, "en", "a") for i, t in enumerate(_HARD)])
    out = minhash.near_duplicates(docs)
    assert len(list(tmp_path.glob("settled-*"))) == 1 and out.count() == docs.count()
    clean = pii.sanitise(docs)
    assert len(list(tmp_path.glob("settled-*"))) == 2 and clean.count() == docs.count()


def test_texts_without_entity_do_not_travel(spark):
    some = [(i, words(i, 40), "en", "a") for i in range(60)] + [(100, "Write to a@b.cc today.", "en", "a"), (101, None, "en", "a")]
    out = pii.sanitise(documents(spark, some))
    # The side that is joined has one text; all others pass beside the join.
    travelling = out._jdf.queryExecution().optimizedPlan().toString()
    assert travelling.lstrip().startswith("Union")
    assert {r.doc_id: r.text for r in out.collect()} == {i: t for i, t, *_ in some} | {100: out.where("doc_id = 100").first().text}
    assert "[EMAIL]" in out.where("doc_id = 100").first().text


def test_words_are_hashed_alike_in_any_text():
    long = [f"wörd{i}" for i in range(70_000)] + ["end"]
    hashed = kernels.word_hashes(long)
    assert len(np.unique(hashed)) == len(long) and len(kernels.word_hashes([])) == 0
    assert kernels.word_hashes(["x" * 70_000, "end", "wörd65537"]).tolist()[1:] == [hashed[-1], hashed[65537]]


def test_shingles_travel_in_six_bytes_and_counts_in_one():
    rising = np.sort(np.random.default_rng(1).integers(0, 2**64, 1 << 19, dtype=np.uint64))
    dealt = list(kernels.dealt_steps(rising, 7))
    assert [part for part, _ in dealt] == list(range(7))
    lows = [-(-(part << 64) // 7) for part, _ in dealt]
    back = [np.cumsum(kernels.from_planes(steps)) + np.uint64(low) for low, (_, steps) in zip(lows, dealt)]
    assert np.array_equal(np.concatenate(back), rising)
    # What compresses: the planes over six are nearly all zeros.
    assert sum(len(zlib.compress(steps, 1)) for _, steps in dealt) < 6.3 * len(rising)
    counts = np.array([1, 2, 1, 300, 1, 1, 1, 1, 70_000], dtype=np.uint64)
    common, documents = kernels.marked_counts(counts)
    assert np.unpackbits(np.frombuffer(common, dtype=np.uint8), count=9).tolist() == [0, 1, 0, 1, 0, 0, 0, 0, 1]
    assert kernels.from_planes(documents).tolist() == [2, 300, 70_000]
    assert kernels.marked_counts(counts[:1]) == (None, None)
    assert kernels.from_planes(kernels.planes(counts[:0])).tolist() == []


def test_a_chunk_read_by_two_tasks_is_answered_once():
    first, second = (kernels.planes(np.array(steps, dtype=np.uint64)) for steps in ([5, 4], [2, 3, 9]))
    chunks, values = kernels.merged_steps([(3, first), (3, second), (8, first)])
    assert chunks == [3, 8] and [v.tolist() for v in values] == [[2, 5, 5, 9, 14], [5, 9]]


def test_settled_tables_leave_no_shuffle_files(spark):
    def shuffle_files():
        files = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
        return {name for name in files.mkString("\n").split("\n") if "/shuffle_" in name}

    earlier, before = shuffle_files(), spark.conf.get(settled.SHUFFLE_CLEANUP, None)
    dealt = spark.range(1000).repartition(4, "id")
    assert settled.settle(dealt).count() == 1000
    assert spark.conf.get(settled.SHUFFLE_CLEANUP, None) == before
    for _ in range(50):
        # The table's own count leaves its shuffle (one row of each task), the write leaves none.
        left = [name for name in shuffle_files() - earlier if name.endswith(".data") and os.path.getsize(name) > 500]
        if not left:
            break
        time.sleep(0.1)
    assert not left
