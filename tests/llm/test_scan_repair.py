import random

import pytest

from folioflow.llm import scan_repair as R

RAW = "raw_id bigint, document_id string, page_index int, block_ix int, block_type string, heading_level int, text string, latex string, bucket string"
BLOCKS = "text string, latex string, raw_id string"
PAGES = "document_id string, page_index int, printed_page int, scanned boolean, text string"
WORDS = "current magnet follows external internal silver carbon metal turbine fraction volume boiling density circuit machine number simple column mineral pressure measure station reaction".split()
CONFUSED = {"l": "1", "s": "5", "o": "0", "m": "rn", "u": "ii", "e": "c"}


def sentences(r, n=30):
    return " ".join(r.choice(WORDS) for _ in range(n)) + "."


def clean_blocks(r):
    return [(sentences(r, 60), r"\frac{1}{2} + \alpha \times \beta", "x") for _ in range(30)]


def misread(word, k):
    spots = [i for i, ch in enumerate(word) if ch in CONFUSED]
    i = spots[k % len(spots)]
    return word[:i] + CONFUSED[word[i]] + word[i + 1:]


def run(spark, raw, pages=(), seed=1):
    r = random.Random(seed)
    # pages that teach the confusions
    lesson = [(10_000 + i, "lesson", i, 0, "paragraph", None, " ".join(misread(w, i) if j % 3 == 0 else w for j, w in enumerate(r.choice(WORDS) for _ in range(40))) + ".", None, "b") for i in range(40)]
    df = spark.createDataFrame(lesson + list(raw), RAW)
    rows = R.damages(df, spark.createDataFrame(clean_blocks(r), BLOCKS), spark.createDataFrame(list(pages), PAGES)).collect()
    return sorted((x.raw_id, x.raw_field, x.kind, x.repaired) for x in rows if x.raw_id < 10_000)


def block(raw_id, page, ix, text, latex=None, kind="paragraph", doc="d", level=None):
    return (raw_id, doc, page, ix, kind, level, text, latex, "b")


def test_misread_words_numbers_and_commands(spark):
    got = run(spark, [
        block(1, 0, 0, "The rnagnet fol1ows the Siiver."), block(1, 0, 0, "The rnagnet fol1ows the Siiver."), block(2, 0, 1, None, r"/frac{1}{2} = 6Z92"), block(3, 0, 2, None, r"\fr ac{1}{2} + \a1pha"),
        block(4, 0, 3, "carbon 415 and 2Z5 metal unknownword"), block(5, 0, 4, None, None), block(6, 0, 5, "", ""), block(7, 0, 6, "  ", None),
    ])
    assert [g for g in got if g[0] == 1] == [(1, "text", "misread", "follows"), (1, "text", "misread", "magnet")]
    assert [g for g in got if g[0] == 2] == [(2, "latex", "misread", "6292"), (2, "latex", "misread", "\\frac")]
    assert [g for g in got if g[0] == 3] == [(3, "latex", "misread", "\\alpha"), (3, "latex", "misread", "\\frac")]
    assert [g for g in got if g[0] >= 4] == [(4, "text", "misread", "225")]


def test_cut_words_over_lines_blocks_and_furniture(spark):
    pages = [("d", p, p + 11, True, "x") for p in range(6)]
    got = run(spark, [
        block(1, 0, 0, "Silver and Carbon of the Metal", kind="chapter", level=0), block(2, 0, 1, "the cur-\nrent and the mag­\n  net and the exter¬\nnal volume."), block(3, 1, 0, "12"), block(4, 1, 1, "3  Silver and Carbon of the Metal"),
        block(5, 1, 2, "a metal turb-"), block(6, 2, 0, "13", kind="list_item"), block(7, 2, 1, "3  Silver and Carbn of the Metal    13", kind="noise"), block(8, 2, 2, None, r"\frac{1}{2}", "equation"), block(9, 2, 3, "ine follows. the frac-\n13\ntion of it"),
        block(10, 3, 0, "Silver metal"), block(11, 3, 1, "14"), block(12, 3, 2, "77", kind="list_item"),
    ], pages)
    assert [g for g in got if g[2] == "hyphen"] == [(2, "text", "hyphen", "current"), (2, "text", "hyphen", "external"), (2, "text", "hyphen", "magnet"), (5, "text", "hyphen", "turbine"), (9, "text", "hyphen", "fraction")]
    assert [g for g in got if g[2] in ("header", "page_number")] == [(3, "text", "page_number", ""), (4, "text", "header", ""), (6, "text", "page_number", ""), (7, "text", "header", ""), (7, "text", "page_number", ""), (9, "text", "page_number", ""), (11, "text", "page_number", "")]


@pytest.mark.parametrize("bucket", [1, 4, 32, 1000])
def test_cut_over_buckets(spark, monkeypatch, bucket):
    monkeypatch.setattr(R, "BUCKET_PAGES", bucket)
    pages = [("d", p, p + 11, True, "x") for p in range(400)]
    got = run(spark, [
        block(1, 31, 0, "and so the mag-"), block(2, 32, 0, "net follows the cur-"), block(3, 40, 0, None, r"\frac{1}{2}"), block(4, 40, 1, "51"), block(5, 310, 0, "rent and the Siiver and c-"), block(6, 311, 0, "arbon metal"),
        block(7, 312, 0, "is fol1ows it."), block(7, 312, 0, "is fol1ows it."),
    ], pages)
    assert got == [(1, "text", "hyphen", "magnet"), (2, "text", "hyphen", "current"), (4, "text", "page_number", ""), (5, "text", "hyphen", "carbon"), (7, "text", "misread", "follows")]


def test_context_is_the_texts_around(spark, monkeypatch):
    monkeypatch.setattr(R, "BUCKET_PAGES", 10)
    monkeypatch.setattr(R, "RESUME_BLOCKS", 3)
    rows = [(i, "d", page, 0, "paragraph", None, None if i % 5 == 4 else f"text {i}", r"\frac" if i % 5 == 4 else None, True) for i, page in enumerate([0, 1, 2, 3, 4, 11, 25, 26, 27, 28, 29, 90, 300])]
    df = spark.createDataFrame(rows, "raw_id bigint, document_id string, page_index int, block_ix int, block_type string, heading_level int, text string, latex string, scanned boolean")
    got = R.with_context(R.placed_blocks(df)).collect()
    texts = [r[0] for r in rows if r[6] is not None]
    for bucket in {r[2] // 10 for r in rows}:
        own = [r[0] for r in rows if r[2] // 10 == bucket]
        inner = [i for i in own if i in texts]
        around = set(texts[max(0, texts.index(inner[0]) - 3):texts.index(inner[-1]) + 4]) - set(own)
        assert sorted(x.raw_id for x in got if x.bucket == bucket and x.context == 0) == own
        assert sorted(x.raw_id for x in got if x.bucket == bucket and x.context == 1) == sorted(around)


def test_hyphen_that_belongs_to_the_word(spark):
    r = random.Random(2)
    extra = [("a self-made magnet " * 20, None, "x")]
    df = spark.createDataFrame([block(1, 0, 0, "a self-\nmade metal")], RAW)
    rows = R.damages(df, spark.createDataFrame(clean_blocks(r) + extra, BLOCKS), spark.createDataFrame([], PAGES)).collect()
    assert [(x.kind, x.repaired) for x in rows] == [("hyphen", "self-made")]


def test_born_digital_chapters_have_no_damage(spark):
    got = run(spark, [block(1, 0, 0, "the rnagnet\n11\ncur-\nrent")], [("d", 0, 11, False, "x")])
    assert got == []


def test_viterbi_takes_the_likelier_neighbour():
    fixes = {"f0rm": [("form", -12.0), ("farm", -11.5)]}
    assert R.decode_line(["a", "f0rm"], fixes, {("a", "farm"): -3.0}) == ["a", "farm"]
    assert R.decode_line(["the", "f0rm"], fixes, {("the", "form"): -1.0}) == ["the", "form"]
    assert R.decode_line(["x"], {"x": [("y", -50.0)]}, {}) == ["x"]
    assert R.decode_line([], {}, {}) == []


def test_masks_find_every_single_confusion():
    for word, seen in (("magnet", "rnagnet"), ("column", "coliimn"), ("carbon", "carb0n"), ("dense", "clense"), ("fluid", "ﬂuid")):
        assert {k for k, _ in R.masked_keys(word)} & {k for k, _ in R.masked_keys(seen)}


def test_within_edits_like_a_full_table():
    r = random.Random(3)
    for _ in range(300):
        a, b = ("".join(r.choice("abc") for _ in range(r.randint(0, 8))) for _ in range(2))
        row = list(range(len(b) + 1))
        for i, x in enumerate(a, 1):
            row = _next(row, i, x, b)
        for most in (0, 1, 2, 3):
            assert R.within_edits(a, b, most) == (row[-1] <= most)


def _next(row, i, x, b):
    new = [i]
    for j, y in enumerate(b, 1):
        new.append(min(row[j - 1] + (x != y), row[j] + 1, new[-1] + 1))
    return new


def test_clean_texts(spark):
    r = random.Random(1)
    raw = [block(1, 0, 0, "The mag-\nnet follows the cur-"), block(2, 0, 1, "rent   and\nthe metal."), block(3, 0, 2, None, r"\frac{1}{2}")]
    rows = R.clean_texts(spark.createDataFrame(raw, RAW), spark.createDataFrame(clean_blocks(r), BLOCKS), spark.createDataFrame([], PAGES)).collect()
    assert {(x.raw_id, x.paragraph, x.formula) for x in rows} == {(1, "The magnet follows the current and the metal.", None), (2, "", None), (3, None, r"\frac{1}{2}")}


def test_empty(spark):
    raw, blocks, pages = (spark.createDataFrame([], s) for s in (RAW, BLOCKS, PAGES))
    assert R.damages(raw, blocks, pages).count() == 0
    assert R.damages(spark.createDataFrame([block(1, 0, 0, "some-\nthing")], RAW), blocks, pages).count() <= 1


def test_headers_of_part_of_a_long_chapter(spark):
    row = lambda d, page, text: (d, page, 0, "paragraph", None, text, True)
    data = [row("long", p, "Moving Sand Dunes") if p < 5 else row("long", p, "Sand And Wind") if p < 7 else row("long", p, "Quiet Harbour Lights") if p < 9 else row("long", p, f"text {p}") for p in range(300)]
    data += [row(d, p, h) for d in ("a", "b") for p in range(4) for h in ("The Sand Of Dunes", "And The Wind")]
    df = spark.createDataFrame(data, "document_id string, page_index int, block_ix int, block_type string, heading_level int, text string, scanned boolean")
    pages = spark.createDataFrame([("long", p, None) for p in range(1000)], "document_id string, page_index int, printed_page int")
    headers = {r.key for r in R.running_headers(df, R.chapter_facts(df, pages)).collect() if r.document_id == "long"}
    assert headers == {"movingsanddunes", "sandandwind"}


def test_thresholds_go_with_the_corpus(spark):
    for times in (1, 1000):
        counts = spark.createDataFrame([("magnet", 40 * times), ("rare", 3), ("noise", times // 2), ("\\frac", 9 * times)] + [(f"w{i}", 10_000 * times) for i in range(10)], "word string, n bigint")
        known, total = R.lexicon(counts)
        assert "magnet" in {r.word for r in known.collect()}
        forms = spark.createDataFrame([(f"{a}rnagnet{b}", 1) for a, b in (("", ""),)] + [(f"x{i}rn", 1) for i in range(4)], "form string, n bigint")
        lesson = known.unionByName(spark.createDataFrame([(f"x{i}m", 50 * times) for i in range(4)], "word string, n bigint"))
        assert {(r.form, r.word) for r in R.candidates(forms, lesson, total).collect()} >= {("rnagnet", "magnet")}
    assert "rare" not in {r.word for r in R.lexicon(counts)[0].collect()}


def test_two_confusions_and_scripts_without_a_bound(spark):
    r = random.Random(6)
    letters = [chr(c) for c in range(0x430, 0x450)] + [chr(c) for c in range(0x561, 0x580)]
    words = sorted({"".join(r.choice(letters) for _ in range(8)) for _ in range(400)})
    forms = [(w.replace(w[2], chr(ord(w[2]) + 0x1000)), 1) for w in words]
    got = {(x.form, x.word) for x in R.candidates(spark.createDataFrame(forms, "form string, n bigint"), spark.createDataFrame([(w, 50) for w in words], "word string, n bigint"), 20_000.0).collect()}
    assert sum((f, w) in got for (f, _), w in zip(forms, words)) > 350
