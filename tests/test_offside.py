import random
import re

import pytest

from gapweave.operators import offside, structure as S
from gapweave.params import FimParams
from gapweave.plans.preprocess import file_blocks
from pyspark.sql import functions as F

CODE = '''import os
# a comment
class A(Base):
    """Doc
  string ( with # signs
"""
    x = {  # open
  "a": 1,
    }

    async def f(self, n):

        if n == 1:
            return "(é" \\
  + "b"
        elif n:
\t\tpass
        else:
            y.z[0] += 1
            # last comment
        return n
    def g(self): return 1
value: int = 3
@decorated
def last(a='#', b=")"):
    match a:
        case 1: foo(x=1)
'''


def nodes_of(text):
    """Nodes by a stack of open lines."""
    pieces = re.findall(offside.LEXEME.replace(r"\z", r"\Z"), text)
    assert "".join(pieces) == text
    lines, start, at, depth = [], 0, 0, 0
    for p in pieces:
        if p == "\n" and depth <= 0:
            lines.append((start, text[start:at]))
            start = at + 1
        depth += (p in ("(", "[", "{")) - (p in (")", "]", "}"))
        at += len(p)
    lines.append((start, text[start:]))
    found, stack = [], []
    size = lambda t: len(t.encode())
    for start, line in lines:
        code = line.lstrip(" \t\f").rstrip()
        if not code or code[0] == "#":
            continue
        lead = line[: len(line) - len(line.lstrip(" \t\f"))]
        indent = sum(8 if c == "\t" else 1 for c in lead)
        first, last = size(text[:start]) + size(lead), size(text[:start]) + size(lead) + size(code)
        while stack and found[stack[-1]]["indent"] >= indent:
            stack.pop()
        word = re.match(r"(?:async[ \t]+)?([A-Za-z_]+)\b", code)
        kind = offside.LINE_TYPES.get(word and word[1])
        if kind is None:
            kind = "assignment" if re.search(offside.ASSIGNMENT, code) else "decorator" if code[0] == "@" else "expression_statement"
        for k in stack:
            found[k]["end"] = last
            found[k].setdefault("child", first)
        found.append(dict(indent=indent, start=first, end=last, level=len(stack), kind=kind))
        stack.append(len(found) - 1)
    out = [(0, 1, size(text), "file")]
    for n in found:
        out.append((n["start"], 2 * n["level"] + 2, n["end"], n["kind"]))
        if "child" in n:
            out.append((n["child"], 2 * n["level"] + 3, n["end"], "block"))
    return out


def _random_text(seed):
    rng = random.Random(seed)
    parts = ["def f(n):", "x = 1", "if x:", "# c", "", "y = (1,", "2)", '"""s', '"""', "else:", "g('(', \"#\")", "\\", "é = [", "]", "class B:", "a[0] += 2", "return"]
    return "\n".join(rng.choice(["", " ", "  ", "    ", "\t", "      "]) + rng.choice(parts) for _ in range(rng.randint(0, 30)))


def test_nodes_against_a_stack(spark):
    texts = [CODE, "", "\n\n", "# only a comment", "x", "(\nunclosed", "a\r\n  b\r\nc", *map(_random_text, range(60))]
    df = spark.createDataFrame(list(enumerate(texts)), "file_id int, text string")
    for row in S.with_nodes(df, "indent").collect():
        got = [(n["start_byte"], n["depth"], n["end_byte"], n["type"]) for n in row["nodes"]]
        assert got == nodes_of(texts[row["file_id"]]), texts[row["file_id"]]


def test_null_text_has_no_nodes(spark):
    df = spark.createDataFrame([(1, None)], "file_id int, text string")
    assert S.with_nodes(df, "indent").first()["nodes"] is None


def test_blocks_and_subblocks_of_an_indented_file(spark):
    df = spark.createDataFrame([(1, CODE)], "file_id int, text string").withColumn("content", F.encode("text", "UTF-8"))
    blocks = file_blocks(df, "indent", FimParams(max_code_blocks_ast_depth=2)).collect()
    texts = [bytes(b["code"]).decode() for b in blocks]
    assert [t.split("\n")[0] for t in texts] == ["class A(Base):", "def last(a='#', b=\")\"):"]
    assert texts[0].endswith("def g(self): return 1") and texts[1].endswith("case 1: foo(x=1)")
    deeper = file_blocks(df, "indent", FimParams(max_code_blocks_ast_depth=4)).collect()
    assert len(deeper) == 4
    subs = {s["type"] for s in deeper[1]["subblocks"]}
    assert {"block", "if_statement", "return_statement", "assignment"} <= subs


@pytest.mark.parametrize("lines", [3000])
def test_long_files(spark, lines):
    text = "\n".join("    " * (i % 7) + f"x{i} = {i}" for i in range(lines))
    df = spark.createDataFrame([(1, text)], "file_id int, text string")
    got = S.with_nodes(df, "indent").first()["nodes"]
    assert [(n["start_byte"], n["depth"], n["end_byte"], n["type"]) for n in got] == nodes_of(text)
