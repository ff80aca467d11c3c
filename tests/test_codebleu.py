import collections
import math
import re

import pytest
from hypothesis import given, settings, strategies as st

from gapweave.functions import codeflow
from gapweave.functions.codebleu import keywords, with_codebleu

PAIRS = {"(": ")", "[": "]", "{": "}"}
TYPES = set(codeflow.DECLARERS)


class Text:
    """Trees and flow of one text, token by token with a stack of open brackets."""

    def __init__(self, text, language="c"):
        self.words = set(keywords(language))
        self.types = set() if language in codeflow.HASH_COMMENTS else TYPES
        found = re.findall(codeflow.token_pattern(language), text)
        hashes, lines = language in codeflow.HASH_COMMENTS, language in codeflow.LINE_ENDS
        comment = lambda t: (hashes and t[0] == "#") or (not lines and t.startswith(("//", "/*")) and t != "//=")
        self.t = [t for t in found if not comment(t)]
        self.frames()

    def get(self, k):
        return self.t[k] if 0 <= k < len(self.t) else None

    def name(self, k):
        t = self.get(k)
        return bool(t and re.match("[A-Za-z_]", t) and t not in self.words and t not in self.types)

    def frames(self):
        """For every token the frame in which it stands; for frames their opener, closer and frame outside."""
        self.opener, self.closer, self.outer = [None], [None], [None]
        self.frame, self.pair, now = [], {}, 0
        for k, t in enumerate(self.t):
            if t in PAIRS:
                self.opener.append(k), self.closer.append(None), self.outer.append(now)
                self.frame.append(now)
                now = len(self.opener) - 1
            elif t in PAIRS.values():
                self.closer[now] = k
                if self.opener[now] is not None:
                    self.pair[self.opener[now]] = k
                    now = self.outer[now]
                else:
                    self.opener.append(None), self.closer.append(None), self.outer.append(None)
                    now = len(self.opener) - 1
                self.frame.append(now)
            else:
                self.frame.append(now)

    def trees(self):
        spans = list(self.pair.items())
        for s, t in enumerate(self.t):
            if t in PAIRS.values() or t in ";\n" or not (s == 0 or self.t[s - 1] in ";\n{}"):
                continue
            end = s
            while True:
                if end + 1 == len(self.t) or self.closer[self.frame[s]] == end + 1:
                    break
                end += 1
                if self.t[end] in ";\n}" and self.frame[end] == self.frame[s]:
                    break
            spans.append((s, end))
        shapes = [codeflow.shape(t, self.words) for t in self.t]
        return collections.Counter(tuple(shapes[a : b + 1]) for a, b in spans)

    def edges(self):
        facts = {}
        for k in range(len(self.t)):
            if self.name(k) and self.get(k + 1) != "(" and self.get(k - 1) not in (".", "->", "::"):
                facts[k] = self.variable(k)
        inside = lambda k, d: facts[d]["declare"] and self.t[d] == self.t[k] and d < k <= facts[d]["scope"]
        for k, f in facts.items():
            holders = [d for d in facts if inside(k, d)]
            f["variable"] = (self.t[k], k if f["declare"] else max(holders, default=-1))
        order = list(dict.fromkeys(f["variable"] for f in facts.values()))
        edges = collections.Counter()
        before = lambda v, k: sum(d["define"] and d["variable"] == v and d["effect"] < k for d in facts.values())
        rank = lambda k: sum(
            d["define"] and d["variable"] == facts[k]["variable"] and (d["effect"], j) <= (facts[k]["effect"], k) for j, d in facts.items()
        )
        for k, f in facts.items():
            if f["pure"]:
                continue
            v, n = order.index(f["variable"]), before(f["variable"], k)
            if n:
                edges["comes", v, n] += 1
            into = [j for j, d in facts.items() if d["assign"] and d["op"] < k < d["effect"]]
            if into:
                target = max(into, key=lambda j: facts[j]["op"])
                edges["computed", order.index(facts[target]["variable"]), rank(target), v, n] += 1
        return edges

    def variable(self, k):
        op, indexed = k + 1, self.get(k + 1) == "[" and k + 1 in self.pair
        if indexed:
            op = self.pair[k + 1] + 1
        behind, prv, frame = self.get(op), self.get(k - 1), self.frame[k]
        o = self.opener[frame]
        kind = None if o is None else self.t[o]
        close = self.pair.get(o)
        body = close + 1 if close is not None and self.get(close + 1) == "{" else None
        end_of = lambda opener: self.pair.get(opener, len(self.t))
        if kind == "{":
            scope = end_of(o)
        elif kind == "(" and body is not None:
            scope = end_of(body)
        elif kind is None or close is None:
            scope = len(self.t)
        else:
            around = self.closer[self.outer[frame]]
            scope = len(self.t) if around is None else around
        assign, step = behind in codeflow.ASSIGNS, self.get(k + 1) in ("++", "--") or prv in ("++", "--")
        far = prv in ("*", "&")
        d = k - 2 if far else k - 1
        guard = self.get(d - 1)
        first = guard is None or guard in ";{}(\n" or (guard == "," and kind == "(")
        typed = self.get(d) in self.types and (first or guard in self.words) and (
            behind in (";", ",", ")", ":", "\n", "in", "of") or assign
        )
        named = self.name(d) and (not far or first) and behind in ("=", ":=")
        loop = prv == "for" and behind in ("in", "of")
        param = kind == "(" and body is not None and self.name(o - 1) and behind in (",", ")") and not assign
        declare = typed or named or loop or param
        effect = k
        if assign:
            effect = op + 1
            while effect < len(self.t) and not (
                (self.t[effect] in (";", ",", "\n") and self.frame[effect] == frame) or self.closer[frame] == effect
            ):
                effect += 1
        plain = behind in ("=", ":=") and not indexed
        return dict(
            declare=declare, define=declare or assign or step, pure=(declare or plain) and not step, assign=assign, op=op, effect=effect, scope=scope
        )


def overlap(a, b):
    return sum((a & b).values())


_SOUP = st.lists(
    st.sampled_from("a a b b x f int for in return ( ) { } [ ] ; ; , = = += ++ == * 1 'c' . -> if :".split() + ["\n", "// b ;\n", "/* a */"]), max_size=40
).map(" ".join)
_PROGRAM = st.lists(
    st.sampled_from(
        [
            "int a = 1;", "a = b;", "b = a + f(a, b);", "a += b;", "x[a] = b;", "for (int a = 0; a < b; a++) {", "{", "}", "if (a == b) {", "int b;",
            "int f(int a, char *b) {", "b++;", "return a;", "{ int a = 2; b = a; }", "T x = a;", "for (int b = 0; b < 3; b++) a = b;", "} else {",
        ]
    ),
    max_size=14,
).map("\n".join)


@pytest.mark.parametrize("language", ["c", "python"])
@settings(max_examples=400, deadline=None)
@given(texts=st.lists(st.one_of(_SOUP, _PROGRAM), min_size=2, max_size=5))
def test_trees_and_flow_against_a_stack(language, texts):
    found = codeflow.structure(texts, language, frozenset(keywords(language)))
    plain = [Text(t, language) for t in texts]
    for got, want in zip(found, ([t.trees() for t in plain], [t.edges() for t in plain])):
        got = [set(x) for x in got.to_pylist()]
        assert [len(x) for x in got] == [sum(x.values()) for x in want]
        for i in range(len(texts)):
            for j in range(i):
                assert len(got[i] & got[j]) == overlap(want[i], want[j])


def _edges(text, language="c"):
    return codeflow.structure([text], language, frozenset(keywords(language)))[1].to_pylist()[0]


def test_order_of_assignments_matters():
    assert set(_edges("x=1;y=2;x=y;y=x;")) != set(_edges("x=1;y=2;y=x;x=y;"))
    assert set(_edges("x=1;y=2;x=y;y=x;")) == set(_edges("u=1;v=2;u=v;v=u;"))


def test_inner_declaration_hides_the_outer():
    assert set(_edges("int a = 1; { int a = 2; b = a; } c = a;")) != set(_edges("int a = 1; { a = 2; b = a; } c = a;"))


@pytest.mark.parametrize(
    "text",
    [
        "The house was long, and long was the house; he said it was the house (the long house) of the house.",
        "#include <stdio.h>\n#include <a.h>", "// a comment\n/* another one */", "", "   ", "A double house, a double house; the short houses, short houses.",
    ],
)
def test_prose_and_import_blocks_have_no_flow(text):
    assert _edges(text) == []


@pytest.mark.parametrize(
    "language, text",
    [
        ("c", "total += values[i];"), ("c", "int f(int n) { return n; }"), ("python", "x = 1\nfor k in range(x):\n    x = x + k\n"),
        ("javascript", "let a = 1; const g = () => { return a; };"), ("java", "int sum(int[] a) { int s = 0; for (int x : a) { s += x; } return s; }"),
        ("go", "func f() int {\n x := 1\n return x\n}"), ("rust", "fn f() { let mut a = 1; a += 1; }"), ("cpp", "auto p = q; p->x = 1; r = p;"),
        ("php", "$a = 1; $b = $a;"), ("ruby", "a = 1\nb = a\n"),
    ],
)
def test_code_has_flow(language, text):
    assert _edges(text, language)


def _brute_score(ref, pred, language="c", weights=(0.1, 0.1, 0.4, 0.4)):
    def grams(words, n):
        return collections.Counter(tuple(words[i : i + n]) for i in range(len(words) - n + 1))

    r, p, listed = ref.split(), pred.split(), set(keywords(language))
    if not p or not r:
        n_gram = weighted = 0.0
    else:
        brevity = 1.0 if len(p) > len(r) else math.exp(1 - len(r) / len(p))
        hits = [overlap(grams(p, n), grams(r, n)) for n in range(1, 5)]
        keys = overlap(collections.Counter(w for w in p if w in listed), collections.Counter(w for w in r if w in listed))
        share = lambda hit, total: 0.25 * math.log((hit or 0.1) / total)
        n_gram = brevity * math.exp(sum(share(h, max(len(p) - n, 1)) for n, h in enumerate(hits))) if hits[0] else 0.0
        first = 0.2 * hits[0] + 0.8 * keys
        total = 0.2 * len(r) + 0.8 * sum(w in listed for w in r)
        logs = share(first, total) + sum(share(h, max(len(r) - n, 1)) for n, h in enumerate(hits) if n)
        weighted = brevity * math.exp(logs) if first else 0.0
    a, b = Text(ref, language), Text(pred, language)
    recall = lambda x, y: overlap(x, y) / sum(x.values())
    if not a.trees() or not a.edges():
        return False, 0.0
    parts = (n_gram, weighted, recall(a.trees(), b.trees()), recall(a.edges(), b.edges()))
    return True, sum(w * x for w, x in zip(weights, parts))


LOOP = "int f(int n) {\n  int s = 0;\n  for (int k = 0; k < n; k++) { s += k; }\n  return s;\n}"


def test_scores_against_brute_force(spark):
    pairs = [
        (LOOP, LOOP), (LOOP, LOOP.replace("k", "j")), (LOOP, LOOP.replace("s += k", "s = n")), (LOOP, "return 1;"), (LOOP, None), (LOOP, ""),
        ("int i = 0;", "int i = 0;"), ("Some prose, some prose; prose.", "Some prose"), (None, "x = y;"), ("x = y;" * 3000, "x = y;" * 2999),
    ]
    df = spark.createDataFrame([(i, r, p) for i, (r, p) in enumerate(pairs)], "i int, ref string, pred string")
    got = with_codebleu(df, "ref", {"score": "pred"}, "c").orderBy("i").collect()
    for row, (r, p) in zip(got, pairs):
        valid, score = _brute_score(r or "", p or "")
        assert (row["codebleu_valid"], row["score"]) == (valid, pytest.approx(score))
    assert got[0]["score"] == pytest.approx(1.0) and got[1]["score"] < 1.0


def test_plan_has_one_python_pass(spark):
    df = spark.createDataFrame([("a", "b", "c")], "ref string, p string, q string")
    plan = with_codebleu(df, "ref", {"s": "p", "t": "q"}, "c")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ArrowEvalPython") == 1 and "Exchange" not in plan


def test_words_of_all_texts_are_hashed_in_one_pass():
    import numpy as np

    from gapweave.functions import codeflow

    one, other = codeflow.word_hashes("for é (int i"), codeflow.word_hashes("i é for")
    assert one[[3, 1, 0]].tolist() == other.tolist() and len(np.unique(one)) == 4
    assert len(codeflow.word_hashes("")) == 0
    texts = [["for", "i", "for"], [], ["i", "for"]]
    g1, g2, *_, listed = (x.to_pylist() for x in codeflow.grams(texts, {"for"}))
    # Copies in a text are items of their own; the first one is the same as in another text.
    assert [len(x) for x in g1] == [3, 0, 2] and len(set(g1[0]) & set(g1[2])) == 2
    assert [len(x) for x in g2] == [2, 0, 1] and len(set(g2[0]) & set(g2[2])) == 1
    assert [len(x) for x in listed] == [2, 0, 1]


def test_only_counts_come_back_from_the_texts(spark):
    df = spark.createDataFrame([("a", "b", "c")], "ref string, p string, q string")
    plan = with_codebleu(df, "ref", {"s": "p", "t": "q"}, "c")._jdf.queryExecution().executedPlan().toString()
    assert "array_intersect" not in plan and "array<bigint>" not in plan


@settings(max_examples=60, deadline=None)
@given(st.lists(st.tuples(*[st.text("ab =;(){}\n\x85 \xe9'\"k\\/*", max_size=30)] * 3), max_size=12))
def test_counts_are_those_of_the_sets(rows):
    """What is shared by slices of a few rows, against sets of the copies of a text."""
    import pyarrow as pa

    sides = [[row[k] for row in rows] for k in range(3)]
    listed, before = frozenset(["a", "k"]), codeflow.SLICE_ROWS
    codeflow.SLICE_ROWS = 5
    try:
        got = codeflow.compared(pa.array(sides[0], pa.string()), [pa.array(s, pa.string()) for s in sides[1:]], "c", listed).to_pylist()
    finally:
        codeflow.SLICE_ROWS = before
    names = ["g1", "g2", "g3", "g4", "keywords", "trees", "edges"]
    sets = [[x.to_pylist() for x in (*codeflow.grams([t.split() for t in s], listed), *codeflow.structure(s, "c", listed))] for s in sides]
    for i, row in enumerate(got):
        ref = dict(zip(names, (x[i] for x in sets[0])))
        assert row["ref"] == {"n_words": len(ref["g1"]), **{n: len(ref[n]) for n in names[4:]}}
        for c, own in enumerate(sets[1:]):
            shared = {n: len(set(ref[n]) & set(x[i])) for n, x in zip(names, own)}
            assert row[f"c{c}"] == {"n_words": len(own[0][i]), **shared}


@pytest.mark.parametrize("language", ["c", "python", "php"])
def test_reader_finds_the_tokens_of_the_pattern(language):
    @settings(max_examples=300, deadline=None)
    @given(st.text("ab1_\"'\\/*#\n =+-;{}()\xe9", max_size=40))
    def check(text):
        assert [token for token in codeflow.token_reader(language)(text) if token] == re.findall(codeflow.token_pattern(language), text)

    check()


def test_words_are_those_of_split():
    import numpy as np

    text = "".join(f"{chr(c)}x{c % 7}" for c in range(0x3100)) + "€ "
    starts, hashed = codeflow._hashed_words(np.frombuffer(text.encode(), dtype=np.uint8))
    words = text.split()
    text += " ".join(x * k for k in (7, 8, 9, 16, 63, 64, 65, 200) for x in "ab\0")
    words, hashed = text.split(), codeflow._hashed_words(np.frombuffer(text.encode(), dtype=np.uint8))[1]
    assert len(hashed) == len(words) and len(set(zip(words, hashed.tolist()))) == len(set(words)) == len(set(hashed.tolist()))
