import math
import random
from collections import Counter

import pytest

from folioflow.functions.text import STOP_WORDS
from folioflow.operators import retrieval as R

VOCAB = "sand river wind beach dune clay silt stone wave tide the of and".split()


def tokens(t):
    return [x for x in t.split() if x not in STOP_WORDS and len(x) > 1]


def brute_bm25(queries, docs, k):
    toks = {d: tokens(t) for d, t in docs}
    n, avg = len(docs), sum(map(len, toks.values())) / len(docs)
    df = Counter(w for t in toks.values() for w in set(t))
    out = set()
    for q, text in queries:
        scores = {}
        for d, t in toks.items():
            tf = Counter(t)
            s = sum(math.log(1 + (n - df[w] + 0.5) / (df[w] + 0.5)) * tf[w] * 2.5 / (tf[w] + 1.5 * (0.25 + 0.75 * len(t) / avg)) for w in tokens(text) if tf[w])
            if s > 0:
                scores[d] = s
        out |= {(q, d, r, round(s, 6)) for r, (d, s) in enumerate(sorted(scores.items(), key=lambda x: (-round(x[1], 9), x[0]))[:k], 1)}
    return out


@pytest.mark.parametrize("block", [2, 1000])
def test_bm25_like_brute_force(spark, block):
    r = random.Random(1)
    text = lambda n: " ".join(r.choice(VOCAB) for _ in range(n))
    docs = [(i, text(r.randint(1, 30))) for i in range(60)] + [(60, "the of"), (61, "")]
    queries = [(i, text(6)) for i in range(7)] + [(8, "the"), (9, "sand sand river")]
    got = R.bm25_topk(spark.createDataFrame(queries, "q bigint, t string"), "q", "t", spark.createDataFrame([*docs, (99, None)], "d bigint, t string").filter("t is not null"), "d", "t", 5, block)
    assert {(x.q, x.d, x["rank"], round(x.score, 6)) for x in got.collect()} == brute_bm25(queries, docs, 5)


@pytest.mark.parametrize("block", [2, 1000])
def test_cosine_like_brute_force(spark, block):
    r = random.Random(2)
    vecs = {i: [r.gauss(0, 1) for _ in range(8)] for i in range(80)}
    vecs[80] = vecs[3]
    unit = {i: [x / math.hypot(*v) for x in v] for i, v in vecs.items()}
    df = spark.createDataFrame([(i, v) for i, v in vecs.items()] + [(90, None), (91, [])], "vec_id bigint, embedding array<double>")
    got = {(x.query_id, x.vec_id, x["rank"]) for x in R.cosine_topk(df.filter("vec_id % 20 = 0"), df, 5, block).collect()}
    want = set()
    for q in (0, 20, 40, 60, 80):
        sims = sorted(((-round(sum(a * b for a, b in zip(unit[q], v)), 9), i) for i, v in unit.items() if i != q))
        want |= {(q, i, k) for k, (_, i) in enumerate(sims[:5], 1)}
    assert got == want


def test_fusion(spark):
    st = spark.createDataFrame([(1, 10, 0.6)], "query_id bigint, block_id bigint, strength double")
    le = spark.createDataFrame([(1, 10, 1.0), (1, 11, 1.0)], "query_id bigint, block_id bigint, score double")
    se = spark.createDataFrame([(1, 11, 0.5), (1, 12, 0.9)], "query_id bigint, block_id bigint, score double")
    got = {(r.block_id, round(r.rerank, 6), r.channels, r["rank"]) for r in R.fuse(st, le, se).collect()}
    assert got == {(10, 0.6, "lexical,structural", 1), (11, 0.385, "lexical,semantic", 2), (12, 0.315, "semantic", 3)}


def test_empty(spark):
    none = spark.createDataFrame([], "q bigint, t string")
    assert R.bm25_topk(none, "q", "t", none, "q", "t").count() == 0
    assert R.cosine_topk(*[spark.createDataFrame([], "vec_id bigint, embedding array<double>")] * 2).count() == 0
