import pytest
from pyspark.sql import functions as F

from folioflow.functions import text as T
from folioflow.operators import reconstruct as R


def values(spark, texts, column):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    return [r[1] for r in df.select("i", column("t")).orderBy("i").collect()]


def test_enumerators(spark):
    texts = ["Example 10.2 A", "10.3 What", "7. Find", "(B) one", "(2) two", "(c) three", "(i) four", "iv) five", "plain prose", None, "", "3.5kg of sand"]
    got = [(r["style"], r["label"], r["level"]) for r in values(spark, texts, T.enumerator)]
    none = (None, None, None)
    assert got == [("example", "10.2", 0), ("numbered", "10.3", 0), ("numbered", "7", 0), ("upper", "B", 1), ("num", "2", 1), ("lower", "c", 2), ("roman", "i", 2), ("roman", "iv", 2), none, none, none, none]


def test_answer_boundary_needs_a_label(spark):
    texts = ["Q\nAns. x", "Q\nAnswer: x", "Q\nSolution Let", "Q\nSolution", "Read and answer the following", "answer all", None]
    assert values(spark, texts, T.answer_boundary) == [2, 2, 2, 2, -1, -1, -1]


def test_question_types(spark):
    texts = ["Assertion (A): x. Reason (R): y", "Pick (a) x (b) y (c) z", "Fill ____ in", "State whether it is true or false", "Match the following", "Compare x and y", "Arrange them", "Calculate x", "Why?", "Sand?", "Sand", None]
    no = F.lit(False)
    got = [r["kind"] for r in values(spark, texts, lambda c: T.question_type(c, no, no, no, F.lit(None).cast("double"), no))]
    assert got == ["assertion_reason", "mcq", "fill_blank", "true_false", "matching", "distinguish", "ordering", "numerical", "conceptual", "conceptual", "unknown", "unknown"]


def test_sections_and_asking(spark):
    assert values(spark, ["Exercises", "Summary of exercises", "Sand", None], T.section_kind) == ["question", "prose", "unknown", "unknown"]
    assert values(spark, ["10.2 What is it", "It is sand.", "3. State it", None, "Is it?"], T.asks) == [True, False, True, False, True]


def test_reference_parts(spark):
    got = values(spark, ["the figure below", "Table 3.2 above", "graph (c)", "no. 7", None], T.reference_parts)
    assert [tuple(r) for r in got] == [("below", "figure", None), ("above", "table", "3.2"), (None, "graph", "c"), (None, None, "7"), (None, None, None)]


def test_tokens_scripts_hashes(spark):
    assert values(spark, ["The Sand of A 42x", None], T.tokens) == [["sand", "42x"], []]
    assert values(spark, ["v₀ m²"], T.script_marks) == ["v<sub>0</sub> m<super>2</super>"]
    assert values(spark, ["a<b & c"], T.escaped) == ["a&lt;b &amp; c"]
    assert len(values(spark, [None], T.short_hash)[0]) == 24


def parts(spark, texts):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    found = {r.i: [m["label"] for m in r.marks] for r in R.subparts(df, "i", "t").collect()}
    return [found.get(i, []) for i in range(len(texts))]


def test_subparts(spark):
    texts = [
        "Stem here.\n(a) one thing\n(b) two thing\n(c) three", "10.3 (a) first one. (b) second one", "An aside (see below) and (a) lone", "(a) one. (c) three", "(i) one. (ii) two", "(A) outer. (i) x. (ii) y. (iii) z. (B) outer two",
        "Only (a) in the middle (b) of prose", None, "", "(v) ve. (w) we",
    ]
    assert parts(spark, texts) == [["a", "b", "c"], ["a", "b"], [], [], ["i", "ii"], ["a", "b"], [], [], [], ["v", "w"]]


def test_split_and_options(spark):
    text = "Two stones fall from a tower.\n(a) Find how fast the first one falls after it was let go.\n(b) Find where they would meet, if they ever do so.\nAns. (a) 3 (b) 4"
    df = spark.createDataFrame([(1, text), (2, "Which is it? (a) sand (b) clay (c) silt (d) loam"), (3, "Why is the sand so hot at noon?\nAns. The sun."), (4, "prose"), (5, None)], "i int, t string")
    got = [(r.i, r.segment, r.role, r.enumerator, text[r.start:r.end][:6] if r.i == 1 else None) for r in R.split_inward(df, "i", "t").orderBy("i", "segment").collect()]
    assert got == [(1, 0, "stem", None, "Two st"), (1, 1, "subpart", "a", "(a) Fi"), (1, 2, "subpart", "b", "(b) Fi"), (1, 3, "answer", None, "Ans. ("), (3, 0, "stem", None, None), (3, 1, "answer", None, None)]
    opts = [(r.opt_key, r.opt_text) for r in R.options(df.filter("i = 2"), "i", "t").orderBy("ix").collect()]
    assert opts == [("a", "sand"), ("b", "clay"), ("c", "silt"), ("d", "loam")]


def test_inline_segments(spark):
    t = "What is it? Ans. Sand. Explanation: it is dry."
    df = spark.createDataFrame([(1, t), (2, "Ans. first"), (3, None)], "i int, t string")
    assert [(r.role, t[r.start:r.end]) for r in R.inline_segments(df, "i", "t").orderBy("segment").collect()] == [("question", "What is it? "), ("answer", "Ans. Sand. "), ("explanation", "Explanation: it is dry.")]


@pytest.mark.parametrize("text", ["a\x01b Ans. c", "Ans. Ans. Ans.", "é Ans. ü"])
def test_segments_cover_the_text(spark, text):
    segs = values(spark, [text], lambda c: T.marker_segments(c, T.INLINE_MARKER))[0]
    plain = text.replace("\x01", "")
    assert "".join(s["text"] for s in segs) == plain and [plain[s["start"]:s["end"]] for s in segs] == [s["text"] for s in segs]
