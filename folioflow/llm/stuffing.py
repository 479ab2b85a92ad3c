"""Keyword-stuffed and link-list pages.

Method: thresholds on the shares of top words and repeated n-grams, duplicate
lines, link text, separators and missing function words, calibrated per
language. One pass over the texts, without a shuffle, measures every document:
each line is link text, a list of tags or products, prose (it has the function
words that sentences of the document's language need) or a rest; the rest of a
document is one pool of words whose repetition is measured. The measures, a few
numbers a document, are written, the usual ones of each language are taken from
them, and a page counts if most of its text is link lines, tag and product
lines, or a pool that repeats itself more than pages of its language do.

A contents list or a glossary has function words, an index repeats nothing, an
answer key and a drill of numbers have hardly any words, and in a list of books
with remarks, or a lesson that ends in tags, prose outweighs the rest; so none
of them counts. A line that comes again and again is prose only if it is a
sentence: rich in function words and with a full stop. A pool needs less
repetition if lines of its page repeat or separators are denser than usual.

Function words are a fixed list for five languages; those of any other language
that the lang column names on ``LEARN_DOCS`` documents or more are learned from
all of these: its short words that a good share of its documents have. The
language of a text is told by its function words; where they are too few to
tell, it is the one that the lang column names. In a language without any list
a line is prose by its shape: a sentence whose words don't repeat. Defined results for odd input: null and blank texts and rows
with a null id don't count; very short texts (under ``LEAST_WORDS`` words and
``LEAST_LINKS`` link lines) neither; repeated rows give one result; extra
columns are not looked at; empty tables give an empty result.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folioflow.session import stage

#: frequent closed-class words per language (fixed values)
FUNCTION_WORDS = {
    "en": "the of and to in is that it with for as was were by on from at this its had so not but while when because if what how why which are be has or an no each every",
    "de": "der die das und ein eine in zu den von ist mit sich des auf für nicht im dem auch es an als man hier warum während statt aus bei oder wie wird sind einer",
    "fr": "le la les de des un une et est que qui dans pour pas sur au aux ce cette avec par on ne se il elle sont aussi avant pourquoi du plus mais ou où",
    "es": "el la los las de un una y en que es por con para del al lo se no su como más pero esta este también qué mientras sobre sin son ser hay o",
    "hi": "का के की को है हैं में से यह वह और उस इस पर ने एक था थे थी रहता किस यहाँ जो तो कि भी नहीं हो कर या ही लिए साथ जब तक प्रकार",
}
PROSE_SHARE = 0.125
LONG_LINE = 20
LEAST_VARIED = 4
SURE_PROSE_SHARE = 0.35
FEW_WORDS = 12
LEAST_WORDS = 20
LEAST_LINKS = 3
SPAM_SHARE = 0.5
LACKING = 0.65
#: a language is learned from so many documents on: its words of at most so many letters that at least such a share of them has, and at most so many of them
LEARN_DOCS = 50
LEARN_LETTERS = 6
LEARN_SHARE = 0.2
LEARN_WORDS = 80
#: the words of a language tell it where they are such a share of a text
VOTE_SHARE = 0.25
SHAPE_WORDS, SHAPE_VARIED = 6, 0.7
#: a line counts as repeated from so many copies on; a page from such a share of copies or so many separators a word above the usual
OFTEN = 3
MARKED = 0.2
#: prose has at least so many function words, however many pages of a language are stuffed
LEAST_USUAL = 0.35
CLEAR_SHARE = 0.75

_WORD = re.compile(r"[^\W\d_][\wऀ-ॿ‍]*")
_LINK = re.compile(r"(?:https?://|www\.)[^\s<>()\[\]'\"]+", re.I)
_ANCHOR = re.compile(r"</?[A-Za-z][^<>]*>|\[([^\[\]]*)\]\([^()\s]*\)")
_HASHTAG = re.compile(r"(?:^|\s)#\w+")
_SENTENCE_END = re.compile(r"[.?!।:][\s\"'”’»)]*$")
_SENTENCE_BREAK = re.compile(r"[.?!।]+\s")
_SEPARATORS = re.compile(r"[|•·»;,/#*>]")

FIELDS = ("words", "chars", "function_share", "link_share", "n_links", "list_share", "pool_share", "pool_words", "pool_top", "pool_repeats", "pool_ngrams", "duplicate_share", "separators")
_MEASURES = "doc_id bigint, language string, " + ", ".join(f"{f} double" for f in FIELDS)
_ARROW = pa.schema([("doc_id", pa.int64()), ("language", pa.string()), *((f, pa.float64()) for f in FIELDS)])


class Lists:
    """Function words of several languages, each with a bit."""

    def __init__(self, learned: dict[str, list[str]] | None = None):
        every = {lang: words.split() for lang, words in FUNCTION_WORDS.items()} | {lang: words for lang, words in (learned or {}).items() if lang not in FUNCTION_WORDS}
        self.langs = list(every)
        self.mask: dict[str, int] = {}
        for bit, words in enumerate(every.values()):
            for w in words:
                self.mask[w] = self.mask.get(w, 0) | 1 << bit

    def language(self, votes: Counter, n_words: int, lang: str) -> tuple[str, int | None]:
        """Language of a text and its bit, by the votes of its words and by the column; no bit where the language has no list."""
        counts = [sum(n for m, n in votes.items() if m >> b & 1) for b in range(len(self.langs))]
        best = max(range(len(counts)), key=lambda b: (counts[b], -b))
        if lang in ("", "und") or lang in self.langs or counts[best] >= VOTE_SHARE * n_words:
            return (self.langs[best], best) if counts[best] else (lang or "und", 0)
        return lang, None


_FIXED = Lists()


def _is_sentences(line: str, words: list[str]) -> bool:
    """Whether most words of a line stand in sentences that don't repeat their words."""
    if not _SENTENCE_END.search(line) or len(_SEPARATORS.findall(line)) * 4 > len(words):
        return False
    varied = 0
    for part in _SENTENCE_BREAK.split(line):
        own = [w for w in _WORD.findall(part.lower()) if len(w) > 1]
        varied += len(own) if len(own) >= SHAPE_WORDS and len(set(own)) >= SHAPE_VARIED * len(own) else 0
    return 2 * varied >= len(words)


def measure(text: str, lang: str | None, lists: Lists = _FIXED) -> tuple:
    """Language and measures of one text."""
    lines = [x for x in text.splitlines() if x.strip()]
    parsed = []
    votes: Counter[int] = Counter()
    for line in lines:
        bare, links = line, 0
        if "://" in line or "www." in line or "WWW." in line or "](" in line:
            links = len(_LINK.findall(line)) or line.count("](")
            bare = _LINK.sub(" ", _ANCHOR.sub(r" \1 ", line))
        words = [w for w in _WORD.findall(bare.lower()) if len(w) > 1]
        masks = [m for m in map(lists.mask.get, words) if m]
        votes.update(masks)
        parsed.append((line, links, words, masks))
    language, bit = lists.language(votes, sum(len(words) for _, _, words, _ in parsed), (lang or "und").strip().lower())
    n_words = n_function = chars = link_chars = n_links = list_chars = pool_chars = duplicate = 0
    pool: list[str] = []
    grams: Counter[tuple] = Counter()
    seen: set[str] = set()
    copies = Counter(" ".join(line.lower().split()) for line in lines)
    for line, links, words, masks in parsed:
        size = len(line)
        chars += size
        n_words += len(words)
        function = sum(m >> bit & 1 for m in masks) if bit is not None else len(words) // 2 if _is_sentences(line, words) else 0
        n_function += function
        if line in seen:
            duplicate += size
        seen.add(line)
        bars = line.count("|") if function < 0.3 * len(words) else 0
        table = bars >= 3 and bars * 8 >= len(words)
        # a long line of sentences has several function words; one that is also used as a keyword doesn't make prose
        varied = True
        if len(words) >= LONG_LINE:
            varied = function >= SURE_PROSE_SHARE * len(words) or bit is not None and len({w for w in words if lists.mask.get(w, 0) >> bit & 1}) >= LEAST_VARIED
            varied = varied and len(set(words)) > min(FEW_WORDS, 0.3 * len(words))
        if words and copies[" ".join(line.lower().split())] >= OFTEN:
            varied = varied and function >= SURE_PROSE_SHARE * len(words) and bool(_SENTENCE_END.search(line))
        if words and function >= PROSE_SHARE * len(words) and varied and not table:
            continue
        if links:
            link_chars += size
            n_links += links
        elif words and (len(_HASHTAG.findall(line)) * 2 >= len(line.split()) or table):
            list_chars += size
        elif words:
            pool_chars += size
            pool += words
            grams.update(zip(words, words[1:]))
    counts = Counter(pool)
    n_grams = sum(grams.values())
    return (
        language, float(n_words), float(chars), n_function / max(n_words, 1), link_chars / max(chars, 1), float(n_links), list_chars / max(chars, 1), pool_chars / max(chars, 1), float(len(pool)),
        sum(n for _, n in counts.most_common(8)) / max(len(pool), 1), 1 - len(counts) / len(pool) if pool else 0.0, sum(n for n in grams.values() if n > 2) / max(n_grams, 1),
        duplicate / max(chars, 1), len(_SEPARATORS.findall(text)) / max(n_words, 1),
    )


def _measure(learned: dict[str, list[str]]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lists = Lists(learned)
        for batch in batches:
            rows = [(i, *measure(t, lang, lists)) for i, t, lang in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist(), batch.column("lang").to_pylist())]
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), _ARROW)], schema=_ARROW)

    return run


def learned_words(docs: DataFrame, least: int = LEARN_DOCS) -> dict[str, list[str]]:
    """Function words of the languages that have no fixed list, from all of their documents.

    At most LEARN_WORDS words a language are collected, of languages that the
    lang column names on enough documents.
    """
    named = docs.withColumn("lang", F.lower(F.trim("lang"))).filter(~F.col("lang").isin("", "und", *FUNCTION_WORDS))
    sizes = named.groupBy("lang").agg(F.count(F.lit(1)).alias("docs")).filter(F.col("docs") >= least)
    langs = {r.lang: r.docs for r in sizes.collect()}
    if not langs:
        return {}
    words = named.filter(F.col("lang").isin(list(langs))).select("lang", F.explode(F.array_distinct(F.regexp_extract_all(F.lower("text"), F.lit(rf"(?<![\p{{L}}\p{{M}}])([\p{{L}}\p{{M}}]{{2,{LEARN_LETTERS}}})(?![\p{{L}}\p{{M}}])")))).alias("word"))
    shares = words.groupBy("lang", "word").agg(F.count(F.lit(1)).alias("n")).join(sizes, "lang").filter(F.col("n") >= LEARN_SHARE * F.col("docs"))
    top = shares.groupBy("lang").agg(F.slice(F.sort_array(F.collect_list(F.struct(F.col("n"), F.col("word"))), asc=False), 1, LEARN_WORDS).alias("top"))
    return {r.lang: sorted(x.word for x in r.top) for r in top.collect()}


def measures(documents: DataFrame) -> DataFrame:
    """The measures of every document, written once."""
    docs = documents.filter("doc_id is not null and trim(text) <> ''").select(F.col("doc_id").cast("bigint"), "text", "lang")
    return stage(docs.mapInArrow(_measure(learned_words(docs)), _MEASURES), "measures")


def usual(measured: DataFrame) -> DataFrame:
    """Per language, the median share of function words and the upper usual repetition of what isn't prose.

    Medians and upper quartiles over all documents stand pages of spam as long as
    these are few; the bounds that they give are kept inside fixed ones.
    """
    per = measured.filter(F.col("words") >= LEAST_WORDS).groupBy("language").agg(
        F.percentile_approx("function_share", 0.5, 1000).alias("function_usual"),
        F.percentile_approx(F.when(F.col("pool_share") < 0.5, F.col("pool_repeats")), 0.75, 1000).alias("repeats_usual"),
        F.percentile_approx("separators", 0.75, 1000).alias("separators_usual"),
    )
    return per.select("language", *(F.coalesce(c, F.lit(0.0)).alias(c) for c in ("function_usual", "repeats_usual", "separators_usual")))


def stuffed(measured: DataFrame) -> DataFrame:
    """doc_id and spam_share of the documents that are mostly stuffing."""
    m = measured.join(usual(measured), "language", "left").fillna(0.0)
    marked = (F.col("duplicate_share") >= MARKED) | (F.col("separators") >= F.col("separators_usual") + MARKED)
    least = F.when(marked, 0.5).otherwise(F.greatest(F.lit(0.5), F.least(F.lit(0.7), F.col("repeats_usual") + 0.2)))
    repeats = F.col("pool_repeats") >= least
    repeats = (repeats & (F.col("pool_top") >= 0.25)) | ((F.col("pool_ngrams") >= 0.5) & (F.col("pool_repeats") >= 0.5))
    pool = F.when(repeats & (F.col("pool_words") >= LEAST_WORDS), F.col("pool_share")).otherwise(0.0)
    links = F.when(F.col("n_links") >= LEAST_LINKS, F.col("link_share")).otherwise(0.0)
    lacking = F.col("function_share") <= F.lit(LACKING) * F.greatest(F.col("function_usual"), F.lit(LEAST_USUAL))
    m = m.withColumn("spam_share", pool + links + F.col("list_share"))
    big = (F.col("words") >= LEAST_WORDS) | (F.col("n_links") >= LEAST_LINKS)
    return m.filter(big & (lacking | (F.col("spam_share") >= CLEAR_SHARE)) & (F.col("spam_share") >= SPAM_SHARE)).select("doc_id", "spam_share")


def stuffed_pages(documents: DataFrame) -> DataFrame:
    """doc_id of every document that is mostly repeated keywords, links or tags."""
    return stuffed(measures(documents)).select("doc_id").distinct()
