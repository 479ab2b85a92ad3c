import random

import pytest

from folioflow.llm import leakage as L

WORDS = [f"{a}{b}{c}" for a in ("bar", "tel", "mon", "gra", "vos", "lim") for b in ("a", "ek", "ir", "oun") for c in ("dine", "sel", "tric", "pone", "gal", "m")]


def text(r, n):
    return [r.choice(WORDS) for _ in range(n)]


def items(r, n=40):
    return [(i, " ".join(text(r, r.randint(20, 60))) + ".") for i in range(n)]


def brute_runs(index_items, doc):
    s = L.stream(doc)
    out = set()
    for i, t in index_items:
        w = L.words_of(t)
        if any(b"".join(w[k:k + 14]) in s for k in range(len(w) - 13)):
            out.add(i)
    return out


@pytest.mark.parametrize("seed", range(6))
def test_runs_like_brute_force(seed):
    r = random.Random(seed)
    pool = items(r)
    index = L.ItemIndex(pool)
    for _ in range(25):
        words = text(r, 200)
        for _ in range(r.randint(0, 3)):
            _, t = r.choice(pool)
            w = t.split()
            n = r.choice([8, 12, 13, 14, 15, 20])
            k = r.randint(0, max(0, len(w) - n))
            at = r.randint(0, len(words))
            words[at:at] = w[k:k + n]
        doc = " ".join(words)
        assert brute_runs(pool, doc) <= L.leaked_items(index, doc)


def noisy(r, words, share):
    out = list(words)
    for k in r.sample(range(len(out)), int(share * len(out))):
        out[k] = r.choice(["xq" + out[k][2:], out[k][::-1], "replacement"])
    return out


@pytest.mark.parametrize("seed", range(6))
def test_altered_items(seed):
    r = random.Random(100 + seed)
    pool = items(r)
    index = L.ItemIndex(pool)
    for i, t in pool[:15]:
        kept = noisy(r, t.split(), 0.2)
        assert i in L.leaked_items(index, " ".join(text(r, 80) + kept + text(r, 80)))
        lost = noisy(r, t.split(), 0.6)
        assert i not in L.leaked_items(index, " ".join(text(r, 80) + lost + text(r, 80)))
        shuffled = t.split()
        r.shuffle(shuffled)
        assert i not in L.leaked_items(index, " ".join(text(r, 80) + shuffled + text(r, 80)))


@pytest.mark.parametrize("change", [
    str.upper, lambda t: t.replace(" ", "\n"), lambda t: t.replace("e", "e­"), lambda t: t.replace("a", "a​"), lambda t: "<p><b>" + t.replace(" ", "</b> <i>", 1) + "</i></p>", lambda t: t.replace(" ", ""),
    lambda t: " ".join(t), lambda t: "".join(w[:2] + "-\n" + w[2:] + " " for w in t.split()), lambda t: t.replace(" ", "&nbsp;"), lambda t: "**" + t.replace(" ", "** _", 3),
    lambda t: t.replace(" ", ' <span style="' + "color: red; " * 60 + '">', 1), lambda t: "[" + t.replace(" ", "](https://example.org/" + "a" * 900 + ") ", 1),
    lambda t: t.replace(" ", " <!-- " + "note " * 200 + "--> ", 2),
])
def test_what_does_not_count(change):
    r = random.Random(5)
    pool = items(r)
    index = L.ItemIndex(pool)
    i, t = pool[3]
    assert i in L.leaked_items(index, " ".join(text(r, 50)) + " " + change(t) + " " + " ".join(text(r, 50)))


def test_common_words_is_a_longest_common_subsequence():
    r = random.Random(1)
    for _ in range(100):
        a, b = [bytes([r.randint(97, 101)]) for _ in range(r.randint(1, 12))], [bytes([r.randint(97, 101)]) for _ in range(r.randint(0, 15))]
        table = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i, x in enumerate(a):
            for j, y in enumerate(b):
                table[i + 1][j + 1] = table[i][j] + 1 if x == y else max(table[i][j + 1], table[i + 1][j])
        assert L.common_words(a, b) == table[-1][-1]


def test_letters_of_all_scripts():
    r = random.Random(11)
    words = ["".join(r.choice("абвгдежзиклмнопрстуфхцчшщ") for _ in range(r.randint(4, 8))) for _ in range(300)]
    pool = [(i, " ".join(r.choice(words) for _ in range(40))) for i in range(10)]
    index = L.ItemIndex(pool)
    around = " ".join(r.choice(words) for _ in range(60))
    assert L.leaked_items(index, f"{around} {pool[2][1].upper()}, {around}") == {2}
    assert L.leaked_items(index, around) == set()
    assert L.stream("Élan ١٢ Ⅳ") == L.stream("elan 12 iv")


def test_any_number_of_q_grams_is_indexed():
    r = random.Random(12)
    pool = [(i, " ".join("".join(r.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(9)) for _ in range(12_000))) for i in range(30)]
    index = L.ItemIndex(pool)
    assert len(index.codes) > 1 << 21 and index.probes < 40
    w = pool[17][1].split()
    assert L.leaked_items(index, " ".join(w[400:414])) == {17}


def test_alignment_in_a_band_like_the_whole_matrix():
    r = random.Random(13)
    for _ in range(40):
        words = [w.encode() for w in text(r, 20)]
        kept = [w if r.random() > 0.2 else b"x" + w[2:] for w in words]
        s = b"filler" * 5 + b"".join(kept) + b"more" * 8
        first, last = L.aligned_stretch(words, s, -len(s), len(s))
        assert L.aligned_stretch(words, s, 10, 50) == (first, last)
        assert abs(first - 30) <= L.EDGE and abs(last - (len(s) - 32)) <= L.EDGE
        assert L.words_in_order(words, s[max(0, first - L.EDGE):last + L.EDGE], sum(a == b for a, b in zip(words, kept)))


@pytest.mark.parametrize("seed", range(4))
def test_words_run_together_and_misread(seed):
    r = random.Random(200 + seed)
    pool = items(r)
    index = L.ItemIndex(pool)
    found = 0
    for i, t in pool[:20]:
        w = noisy(r, t.split(), 0.2)
        joined = "".join(x + ("" if r.random() < 0.25 else " ") for x in w)
        found += i in L.leaked_items(index, " ".join(text(r, 60)) + " " + joined + " " + " ".join(text(r, 60)))
    assert found == 20


def test_blocks_are_bounded(spark):
    rows = [(i, "w" * (50 if i % 9 else 3000), "y") for i in range(200)]
    blocks = [b.collect() for b in L.item_blocks(spark.createDataFrame(rows, ITEMS).select("item_id", "text"), 1000)]
    assert sorted(x.item_id for b in blocks for x in b) == list(range(200))
    assert all(len(b) == 1 or sum(len(x.text) for x in b) <= 1000 for b in blocks)


def test_long_text_in_pieces(monkeypatch):
    monkeypatch.setattr(L, "PIECE_CHARS", 3000)
    r = random.Random(2)
    pool = items(r)
    index = L.ItemIndex(pool)
    words = text(r, 6000)
    for k, (_, t) in enumerate(pool[:12]):
        words[k * 450:k * 450] = t.split()
    assert {i for i, _ in pool[:12]} <= L.leaked_items(index, " ".join(words))


DOCS = "doc_id bigint, text string, item_id string"
ITEMS = "item_id bigint, text string, doc_id string"


@pytest.mark.parametrize("block", [100, 10_000_000])
def test_tables_and_odd_rows(spark, block):
    r = random.Random(3)
    pool = items(r, 12)
    one = " ".join(text(r, 30)) + " " + pool[4][1]
    docs = [(1, one, "x"), (1, one, "x"), (2, None, "x"), (3, "  ", "x"), (None, one, "x"), (4, " ".join(text(r, 50)), "x"), (5, pool[4][1] + " " + pool[7][1], "x")]
    rows = [(i, t, "y") for i, t in pool] + [(None, pool[1][1], "y"), (99, None, "y"), (98, " ", "y"), (4, pool[4][1], "y")]
    got = {tuple(x) for x in L.leaks(spark.createDataFrame(docs, DOCS), spark.createDataFrame(rows, ITEMS), block).collect()}
    assert got == {(1, 4), (5, 4), (5, 7)}


def test_empty(spark):
    docs, rows = spark.createDataFrame([], DOCS), spark.createDataFrame([], ITEMS)
    assert L.leaks(docs, rows).count() == 0
    assert L.leaks(docs, spark.createDataFrame([(1, "some words here", "y")], ITEMS)).count() == 0
