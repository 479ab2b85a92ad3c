"""Noise in text from scanned pages.

Method: noisy-channel correction. A lexicon and its frequencies come from clean
text; words of scanned pages that it lacks are compared with it by masked keys
(one or two characters against one or two), which gives the character confusion
probabilities; these, applied backwards up to twice, give the candidates of
each unknown form. Every line is decoded by Viterbi over the candidates of its
words, with channel probability times corpus unigram and bigram likelihood; a
word stays as it is where no candidate beats an unseen word. Before that,
running headers (also damaged ones) and page numbers are taken out, and words
cut at a line end or at the end of a block are joined over them.

Scale: text is read where it lies to count; only unknown forms are joined. The
blocks are then dealt by document and ``BUCKET_PAGES`` pages, so a document with
a third of all rows is many tasks' work. A cut word is resumed by one of the
next ``RESUME_BLOCKS`` texts of its document, and every bucket sees so many
texts before and after its own as context, wherever they are: what is found
does not depend on where a bucket ends. Headers are found by their density in
overlapping stretches of ``STRETCH_PAGES`` pages. Candidates, bigrams, headers
and the part of the lexicon that cut words need travel as rows of the bucket
that needs them; nothing that grows with the corpus is broadcast or collected.
All thresholds on counts go with the number of words of clean text.

Defined results for odd input: rows with a null document_id, raw_id or
page_index are ignored; null text and latex have no damage; pages without a
``scanned`` mark count as scanned unless the chapter has marks that say
otherwise; a raw_id delivered several times counts once; without page numbers
in ``pages`` the chapter's own numbers vote; blocks of born-digital chapters
have no damage; extra columns are not looked at; empty tables give an empty
result.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterable, Iterator
from itertools import islice

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from folioflow.session import stage

BUCKET_PAGES = 32
#: a word that is cut at the end of a block is resumed by one of so many following texts
RESUME_BLOCKS = 12
#: a word of clean text counts as known from so many occurrences on, and from such a share of all words
KNOWN_COUNT = 3
KNOWN_SHARE = 1e-7
#: a confusion counts from so many different forms on
CONFUSION_FORMS = 3
#: a line is a running header if it stands on two pages, and on at least this share of the scanned pages, of two neighbouring stretches
STRETCH_PAGES = 32
HEADER_SHARE = 0.04
#: a word counts as one of headers from two chapters on, and from such a share of the chapters that have any
HEADER_WORDS_SHARE = 0.002
#: a form is as likely to be right as it is as a known word that is seen so many times
UNSEEN_COUNT = 0.02
UNSEEN = math.log(2e-8)
#: weight of the bigrams against the unigrams
BIGRAM_WEIGHT = 0.8
#: parts at a line end up to so many letters are looked up with what may follow them
SHORT_HEAD = 2
RARE_CONFUSION = 1e-4

WORD = r"[\p{L}\p{N}]+(?:-[\p{L}\p{N}]+)*"
COMMAND = r"[\\/|][A-Za-z0-9]+"
HYPHENS = "-­‐¬"
#: letters that a scanner gives for digits (fixed values)
DIGIT_LIKE = {"O": "0", "o": "0", "Q": "0", "D": "0", "l": "1", "I": "1", "i": "1", "Z": "2", "z": "2", "S": "5", "s": "5", "G": "6", "b": "6", "B": "8", "g": "9", "q": "9"}

HEADER_LINE = r"^(?:[\dOIl]+\s+)?\p{L}[\p{L}\p{N}'&-]*(?:\s+[\p{L}\p{N}'&-]+){1,9}$"

_word = re.compile(r"[^\W_]+(?:-[^\W_]+)*")
_command = re.compile(r"[\\/|][A-Za-z0-9]+")
_split_command = re.compile(r"([\\/|][A-Za-z0-9]+) ([A-Za-z0-9]+)")
_number = re.compile(r"(?<![\\/|\w.])[0-9A-Za-z]+(?:\.[0-9A-Za-z]+)?(?!\w)")
_page_part = r"(?:page|p\.?|pg\.?)?\s*[-–|\[(]*\s*(\d{1,6})\s*[-–|\])]*"
_page_line = re.compile(rf"^\s*{_page_part}\s*$", re.I)
_page_tail = re.compile(rf"^(.*\D)\s{{2,}}{_page_part}\s*$", re.I)
_page_head = re.compile(rf"^\s*{_page_part}\s{{2,}}(\D.*)$", re.I)
_chapter_number = re.compile(r"^\s*[\dOIl]{1,4}[.:]?\s+")


# ---------------------------------------------------------------- corpus statistics


def scanned_rows(raw_blocks: DataFrame, pages: DataFrame) -> DataFrame:
    """raw_blocks with a column scanned: whether the chapter was scanned."""
    marks = pages.filter("document_id is not null and scanned is not null").groupBy("document_id").agg(F.max("scanned").alias("was_scanned"))
    kept = raw_blocks.filter("document_id is not null and raw_id is not null and page_index is not null")
    kept = kept.select("raw_id", "document_id", "page_index", "block_ix", "block_type", "heading_level", "text", "latex")
    return kept.join(marks, "document_id", "left").withColumn("scanned", F.coalesce("was_scanned", F.lit(True))).drop("was_scanned")


def _words(c: Column | str) -> Column:
    return F.regexp_extract_all(F.lower(c), F.lit(f"({WORD})"))


def _commands(c: Column | str) -> Column:
    return F.regexp_extract_all(c, F.lit(f"({COMMAND})"))


def word_counts(blocks: DataFrame, rows: DataFrame) -> DataFrame:
    """word and n of clean text: earlier blocks and born-digital chapters; commands of formulas with their backslash."""
    clean = rows.filter(~F.col("scanned"))
    texts = blocks.select("text").unionByName(clean.select("text")).filter("text is not null")
    words = texts.select(F.explode(_words("text")).alias("word")).filter(~F.col("word").rlike("[0-9]"))
    formulas = blocks.select("latex").unionByName(clean.select("latex")).filter("latex is not null")
    commands = formulas.select(F.explode(_commands("latex")).alias("word")).filter(F.col("word").startswith("\\") & ~F.col("word").rlike("[0-9]"))
    return words.unionByName(commands).groupBy("word").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= KNOWN_COUNT)


def lexicon(counts: DataFrame) -> tuple[DataFrame, float]:
    """The words that count as known, and the number of all words."""
    total = float(counts.agg(F.sum("n")).first()[0] or 1)
    return counts.filter(F.col("n") >= KNOWN_SHARE * total), total


def unknown_forms(rows: DataFrame, known: DataFrame) -> DataFrame:
    """document_id, bucket, prev, form and next of the words of scanned pages that clean text lacks, with their number.

    Words cut at a line end are left out; they are joined before they are decoded.
    """
    scanned = rows.filter("scanned").withColumn("bucket", F.floor(F.col("page_index") / BUCKET_PAGES).cast("int"))
    uncut = F.regexp_replace("text", rf"\S+[{HYPHENS}][ \t]*(\r?\n\s*\S+|\s*$)", " . ")
    words = scanned.filter("text is not null").select("document_id", "bucket", _words(uncut).alias("w"))
    # a formula's commands have no neighbours that matter
    commands = scanned.filter("latex is not null").select("document_id", "bucket", F.explode(_commands("latex")).alias("form")).select("document_id", "bucket", F.lit("").alias("prev"), F.regexp_replace("form", r"^[/|]", r"\\").alias("form"), F.lit("").alias("next"))
    each = F.expr("transform(w, (x, i) -> struct(coalesce(get(w, i - 1), '') as prev, x as form, coalesce(get(w, i + 1), '') as next))")
    tokens = words.select("document_id", "bucket", F.inline(each)).filter(~F.col("form").rlike("^[0-9-]+$") & (F.length("form") > 1))
    return tokens.unionByName(commands).join(known.select(F.col("word").alias("form")), "form", "left_anti").groupBy("document_id", "bucket", "prev", "form", "next").agg(F.count(F.lit(1)).alias("n"))


def masked_keys(word: str) -> Iterator[tuple[str, str]]:
    """(key, part): the word with one or two characters masked, and these."""
    start = 1 if word.startswith("\\") else 0
    for i in range(start, len(word)):
        for size in (1, 2):
            if i + size <= len(word):
                yield word[:i] + "\x00" + word[i + size:], word[i:i + size]


def _mask(column: str):
    schema = pa.schema([(column, pa.string()), ("n", pa.int64()), ("key", pa.string()), ("part", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = [(w, n, k, p) for w, n in zip(batch.column(column).to_pylist(), batch.column("n").to_pylist()) for k, p in masked_keys(w)]
            for a in range(0, len(out), 50_000):
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out[a:a + 50_000]), schema)], schema=schema)

    return run


def one_confusion(forms: DataFrame, known: DataFrame) -> DataFrame:
    """form, n, word, seen and meant: known words that differ from a form by one confusion."""
    seen = forms.mapInArrow(_mask("form"), "form string, n bigint, key string, part string").withColumnRenamed("part", "seen")
    meant = known.select("word", "n").mapInArrow(_mask("word"), "word string, n bigint, key string, part string").select("word", "key", F.col("part").alias("meant"))
    both = seen.join(meant, "key").filter((F.col("seen") != F.col("meant")) & ((F.length("seen") == 1) | (F.length("meant") == 1)))
    # of one pair the shortest description counts: l -> 1 and not al -> a1
    both = both.filter(~((F.length("seen") == 2) & (F.length("meant") == 2)))
    shortest = F.length("seen") + F.length("meant")
    return both.groupBy("form", "n", "word").agg(F.min_by(F.struct("seen", "meant"), F.struct(shortest, "seen", "meant")).alias("p")).select("form", "n", "word", "p.seen", "p.meant")


def confusions(pairs: DataFrame, known: DataFrame) -> DataFrame:
    """seen, meant and p, the probability that the one is read as the other."""
    found = pairs.filter(~F.col("form").startswith("\\")).groupBy("seen", "meant").agg(F.sum("n").alias("times"), F.countDistinct("form").alias("n_forms")).filter((F.col("n_forms") >= CONFUSION_FORMS) | (F.col("n_forms") > 1) & (F.col("times") >= 2 * CONFUSION_FORMS))
    letters = known.select("n", F.explode(F.expr("flatten(transform(sequence(1, length(word)), i -> array(substring(word, i, 1), substring(word, i, 2))))")).alias("meant")).groupBy("meant").agg(F.sum("n").alias("there"))
    p = F.least(F.lit(0.2), F.col("times") / F.greatest("there", F.col("times") * 5))
    return found.join(letters, "meant").select("seen", "meant", p.alias("p")).orderBy(F.desc("p"), "seen", "meant")


def _confused(rows: DataFrame, table: DataFrame, first: Column, longest: int) -> DataFrame:
    """form, word, after and log_p of rows with those columns, with one more confusion undone from a place on."""
    at = rows.filter(first <= F.length("word")).withColumn("i", F.explode(F.sequence(first, F.length("word")))).withColumn("size", F.explode(F.sequence(F.lit(1), F.lit(longest))))
    at = at.filter(F.col("i") + F.col("size") - 1 <= F.length("word")).withColumn("seen", F.substring("word", F.col("i"), F.col("size")))
    word = F.concat(F.substring("word", F.lit(1), F.col("i") - 1), F.col("meant"), F.substring("word", F.col("i") + F.col("size"), F.length("word")))
    return at.join(table, "seen").select("form", word.alias("word"), (F.col("i") + F.length("meant")).alias("after"), (F.col("log_p") + F.log("p")).alias("log_p"))


def candidates(forms: DataFrame, known: DataFrame, total: float) -> DataFrame:
    """form, word, log_p of the channel and log_n of the word, of what beats an unseen word; up to two confusions that don't overlap."""
    pairs = stage(one_confusion(forms, known), "pairs")
    table = stage(confusions(pairs, known), "confusions")
    longest = table.agg(F.max(F.length("seen"))).first()[0] or 1
    unseen = math.log(UNSEEN_COUNT / total)
    # a form that is longer than every known word and two confusions can't be one
    most = (known.agg(F.max(F.length("word"))).first()[0] or 0) + 4
    start = forms.filter(F.length("form") <= most).select("form", F.col("form").alias("word"), F.lit(0.0).alias("log_p"))
    once = _confused(start, table, F.when(F.col("form").startswith("\\"), 2).otherwise(1), longest).filter(F.col("log_p") > unseen)
    twice = _confused(once, table, F.col("after"), longest).filter(F.col("log_p") > unseen)
    rare = pairs.filter(F.col("form").startswith("\\")).select("form", "word", F.lit(math.log(RARE_CONFUSION)).alias("log_p"))
    guessed = once.select("form", "word", "log_p").unionByName(twice.select("form", "word", "log_p")).unionByName(rare)
    prior = known.select("word", F.log(F.col("n") / F.lit(total)).alias("log_n"))
    scored = guessed.join(prior, "word").groupBy("form", "word").agg(F.max("log_p").alias("log_p"), F.max("log_n").alias("log_n"))
    return scored.filter(F.col("form").startswith("\\") | (F.col("log_p") + F.col("log_n") > unseen))


def bigram_rows(unknown: DataFrame, fixes: DataFrame, blocks: DataFrame, rows: DataFrame, known: DataFrame, total: float) -> DataFrame:
    """document_id, bucket, a, b and lift of the bigrams around the forms with candidates: log of how much likelier b is after a than anywhere."""
    # where only one known word fits, the channel decides against the form itself; where several do, their neighbours are asked
    several = fixes.filter(~F.col("form").startswith("\\")).withColumn("c", F.count(F.lit(1)).over(Window.partitionBy("form"))).filter("c > 1")
    around = unknown.join(several.select("form", "word"), "form")
    pairs = around.select("document_id", "bucket", F.explode(F.array(F.struct(F.col("prev").alias("a"), F.col("word").alias("b")), F.struct(F.col("word").alias("a"), F.col("next").alias("b")))).alias("p"))
    pairs = stage(pairs.select("document_id", "bucket", "p.a", "p.b").filter("a <> '' and b <> ''").distinct(), "grams")
    texts = blocks.select("text").unionByName(rows.filter(~F.col("scanned")).select("text")).filter("text is not null").select(_words("text").alias("w")).filter(F.size("w") > 1)
    grams = texts.select(F.inline(F.expr("transform(sequence(1, size(w) - 1), i -> struct(get(w, i - 1) as a, get(w, i) as b))")))
    counts = grams.join(pairs.select("a", "b").distinct(), ["a", "b"], "left_semi").groupBy("a", "b").agg(F.count(F.lit(1)).alias("c"))
    times = lambda c: known.select(F.col("word").alias(c), F.col("n").alias(f"n_{c}"))
    lifts = counts.join(times("a"), "a").join(times("b"), "b").select("a", "b", F.log(F.col("c") * F.lit(total) / (F.col("n_a") * F.col("n_b"))).alias("lift"))
    return pairs.join(lifts, ["a", "b"]).select("document_id", "bucket", "a", "b", "lift")


# ---------------------------------------------------------------- headers and page numbers


def _header_key(c: Column) -> Column:
    return F.regexp_replace(F.lower(F.regexp_replace(c, r"^\s*\d+\s+", "")), r"[^\p{L}\p{N}]", "")


def chapter_facts(rows: DataFrame, pages: DataFrame) -> DataFrame:
    """document_id, page_offset and title of every scanned chapter."""
    scanned = rows.filter("scanned")
    own = F.regexp_extract("text", r"(?i)^\s*(?:page|p\.?|pg\.?)?\s*[-|\[(]*\s*(\d{1,6})\s*[-|\])]*\s*$", 1)
    votes = scanned.filter("text is not null").select("document_id", (own.try_cast("int") - F.col("page_index")).alias("off"), F.lit(1).alias("v")).filter("off is not null")
    printed = pages.filter("document_id is not null").select("document_id", (F.col("printed_page") - F.col("page_index")).alias("off"), F.lit(5).alias("v")).filter("off is not null")
    offset = votes.unionByName(printed).groupBy("document_id", "off").agg(F.sum("v").alias("v")).groupBy("document_id").agg(F.max_by("off", F.struct("v", -F.col("off"))).alias("page_offset"))
    titled = (F.lower("block_type") == "chapter") | (F.col("heading_level") == 0)
    title = scanned.filter(titled & F.col("text").isNotNull()).groupBy("document_id").agg(F.min_by("text", F.struct("page_index", "block_ix", "text")).alias("title"))
    return offset.join(title, "document_id", "full")


def _stretches(page: Column) -> Column:
    """The overlapping stretches, of twice STRETCH_PAGES pages each, that a page lies in."""
    at = F.floor(page / STRETCH_PAGES).cast("int")
    return F.when(at > 0, F.array(at - 1, at)).otherwise(F.array(at))


def running_headers(rows: DataFrame, facts: DataFrame) -> DataFrame:
    """document_id, stretch and key of the running headers of every stretch of pages."""
    scanned = rows.filter("scanned")
    lines = scanned.filter("text is not null").select("document_id", "page_index", F.explode(F.split("text", "\n")).alias("line"))
    tail = F.regexp_replace("line", r"(?i)\s{2,}(?:page|p\.?|pg\.?)?\s*[-|\[(]*\s*\d{1,6}\s*[-|\])]*\s*$", "")
    lines = lines.select("document_id", "page_index", F.trim(tail).alias("line")).filter(F.col("line").rlike(HEADER_LINE))
    lines = lines.filter(F.regexp_count("line", F.lit(r"\b\p{Lu}")) > 1)
    keys = lines.withColumn("key", _header_key(F.col("line"))).filter(F.length("key") >= 6)
    per_page = keys.groupBy("document_id", "key", "page_index").agg(F.min("line").alias("line"))
    spread = per_page.withColumn("stretch", F.explode(_stretches(F.col("page_index")))).groupBy("document_id", "key", "stretch").agg(F.count(F.lit(1)).alias("n_pages"), F.min("line").alias("line"))
    sizes = scanned.select("document_id", "page_index").distinct().withColumn("stretch", F.explode(_stretches(F.col("page_index")))).groupBy("document_id", "stretch").agg(F.count(F.lit(1)).alias("all_pages"))
    spread = spread.join(sizes, ["document_id", "stretch"])
    spread = stage(spread.withColumn("again", F.col("n_pages") >= F.greatest(F.lit(2), HEADER_SHARE * F.col("all_pages"))), "headers")
    again = spread.filter("again")
    single = spread.join(again.select("document_id", "key").distinct(), ["document_id", "key"], "left_anti")
    # a line seen once, or on too few pages, is a header if all its words, or what they are damaged from, are words of headers that are seen again in other chapters
    words = lambda df: df.groupBy("document_id", "key").agg(F.min("line").alias("line")).select("document_id", "key", F.explode(F.array_distinct(_words("line"))).alias("word")).filter(~F.col("word").rlike("^[0-9]+$"))
    titles = facts.filter("title is not null").select("document_id", _header_key(F.col("title")).alias("key"))
    common = words(again.join(titles, ["document_id", "key"], "left_anti")).groupBy("word").agg(F.countDistinct("document_id").alias("d"))
    chapters = again.agg(F.countDistinct("document_id")).first()[0]
    common = common.filter(F.col("d") >= max(2, HEADER_WORDS_SHARE * chapters))
    near = F.explode(F.expr("array_union(array(word), transform(sequence(1, length(word)), i -> concat(substring(word, 1, i - 1), substring(word, i + 1))))")).alias("near")
    asked = stage(words(single), "asked")
    hit = asked.select("document_id", "key", "word", near).join(common.select(near).distinct(), "near").select("document_id", "key", "word").distinct()
    full = asked.groupBy("document_id", "key").agg(F.count(F.lit(1)).alias("c")).join(hit.groupBy("document_id", "key").agg(F.count(F.lit(1)).alias("h")), ["document_id", "key"])
    rescued = single.join(full.filter("c = h and c > 1").select("document_id", "key"), ["document_id", "key"], "left_semi")
    return again.select("document_id", "stretch", "key").unionByName(rescued.select("document_id", "stretch", "key"))


def within_edits(a: str, b: str, most: int) -> bool:
    """Whether two strings differ by at most so many edits."""
    if abs(len(a) - len(b)) > most:
        return False
    if a == b:
        return True
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        lo, hi = max(1, i - most), min(len(b), i + most)
        new = [i] + [most + 1] * len(b)
        for j in range(lo, hi + 1):
            new[j] = min(row[j - 1] + (x != b[j - 1]), row[j] + 1 if j <= i + most - 1 else most + 1, new[j - 1] + 1)
        if min(new[lo - 1:hi + 1]) > most:
            return False
        row = new
    return row[len(b)] <= most


class Chapter:
    """What furniture looks like in one chapter, or in one stretch of its pages."""

    def __init__(self, offset: int | None, title: str | None, headers: Iterable[str] | None):
        self.offset = offset
        self.title = self.key(title or "")
        # a header that is itself damaged matches the better attested ones; all of them are kept
        self.templates = {k for k in [self.title, *(headers or [])] if len(k) >= 6}
        self.parts = {k: {k[i:i + 3] for i in range(len(k) - 2)} for k in self.templates}
        self.lengths = (min(map(len, self.templates), default=0) - 4, max(map(len, self.templates), default=0) + 5)

    @staticmethod
    def key(line: str) -> str:
        return "".join(ch for ch in _chapter_number.sub("", line).lower() if ch.isalnum())

    def is_number(self, digits: str, page: int) -> bool:
        return self.offset is not None and int(digits) == page + self.offset

    def is_header(self, line: str) -> bool:
        if not self.lengths[0] <= len(line) <= 3 * self.lengths[1] or line.rstrip()[-1:] in ".;,?!":
            return False
        key = self.key(line)
        if key in self.templates:
            return True
        if not self.lengths[0] <= len(key) <= self.lengths[1]:
            return False
        own = {key[i:i + 3] for i in range(len(key) - 2)}
        return any(2 * len(own & parts) >= len(parts) and within_edits(key, k, max(2, len(k) // 8)) for k, parts in self.parts.items())

    def furniture(self, line: str, page: int) -> set[str]:
        """Kinds of furniture that a line holds and nothing else."""
        if m := _page_line.match(line):
            return {"page_number"} if self.is_number(m[1], page) else set()
        for pattern, number, rest in ((_page_tail, 2, 1), (_page_head, 1, 2)):
            if (m := pattern.match(line)) and self.is_number(m[number], page) and self.is_header(m[rest]):
                return {"page_number", "header"}
        return {"header"} if self.is_header(line) else set()


class Stretches:
    """The furniture of a bucket, page by page."""

    def __init__(self, offset: int | None, title: str | None, headers: dict[int, set[str]]):
        self.facts, self.headers = (offset, title), headers
        self.made: dict[int, Chapter] = {}

    def at(self, page: int) -> Chapter:
        stretch = page // STRETCH_PAGES
        if stretch not in self.made:
            self.made[stretch] = Chapter(*self.facts, self.headers.get(stretch - 1, set()) | self.headers.get(stretch, set()))
        return self.made[stretch]


# ---------------------------------------------------------------- decoding


def decode_line(words: list[str], fixes: dict[str, list[tuple[str, float]]], grams: dict[tuple[str, str], float], unseen: float = UNSEEN) -> list[str]:
    """Viterbi over the candidates of a line's words; words without candidates stay.

    fixes: candidates with log probability of channel and word; grams: log of how
    much likelier the second word is after the first. The likelihood of a word is
    the mixture of its bigram and unigram probabilities.
    """
    choices = [[(w, unseen), *fixes[w]] if w in fixes else [(w, 0.0)] for w in words]
    if all(len(c) == 1 for c in choices):
        return words
    alone = math.log(1 - BIGRAM_WEIGHT)
    after = lambda a, b: math.log(BIGRAM_WEIGHT * math.exp(grams[a, b]) + 1 - BIGRAM_WEIGHT) if (a, b) in grams else alone
    paths = [(score, [w]) for w, score in choices[0]]
    for options in choices[1:]:
        if len(options) == 1 and len(paths) == 1:
            paths[0][1].append(options[0][0])
            continue
        step = []
        for w, score in options:
            best = max(((s + after(p[-1], w), p) for s, p in paths), key=lambda x: (x[0], x[1]))
            step.append((best[0] + score, [*best[1], w]))
        paths = step
    return max(paths, key=lambda x: (x[0], x[1]))[1]


def fix_number(token: str) -> str | None:
    """A number with letters for digits, as digits; None if the token isn't one."""
    if token.isdigit() or not any(ch.isdigit() for ch in token) or not all(ch.isdigit() or ch == "." or ch in DIGIT_LIKE for ch in token):
        return None
    fixed = "".join(DIGIT_LIKE.get(ch, ch) for ch in token)
    return None if fixed == token else fixed


def join_parts(first: str, second: str, known: dict[str, float]) -> tuple[str, bool]:
    """The whole word of two parts, and whether it is known or one edit from the only known word that is."""
    plain, hyphened = first + second, f"{first}-{second}"
    options = [(known[w], w) for w in (plain, hyphened) if w in known]
    if options:
        return max(options)[1], True
    near = [w for w in known if w[0] == plain[0] and (within_edits(plain, w, 1) or within_edits(hyphened, w, 1))] if len(plain) > 4 else []
    return (near[0], True) if len(near) == 1 else (plain, False)


def repair_bucket(blocks: list[dict], chapters: Stretches, fixes: dict, grams: dict, known: dict, with_text: bool, unseen: float = UNSEEN) -> list[tuple]:
    """Damage rows (raw_id, raw_field, kind, repaired) of the blocks of one bucket in reading order, and repaired texts."""
    out: set[tuple] = set()
    texts: dict[int, str] = {}
    order: list[dict] = []
    for b in blocks:
        lines = []
        chapter = chapters.at(b["page_index"])
        for line in (b["text"] or "").split("\n"):
            kinds = chapter.furniture(line, b["page_index"]) if line.strip() else set()
            if "header" in kinds and (b["block_type"] or "").lower() == "chapter" and chapter.key(line) == chapter.title:
                kinds = set()
            if kinds:
                out.update((b["raw_id"], "text", kind, "", b["context"]) for kind in kinds)
            elif line.strip():
                lines.append(line)
        b["lines"], b["skip"] = lines, 0
        b["running"] = bool(lines) and b["latex"] is None and any(ch.isalpha() for ch in lines[0])
        order.append(b)
    for at, b in enumerate(order):
        lines = b["lines"]
        fixed_lines = []
        carry = b["skip"]
        for n, line in enumerate(lines):
            body = line.rstrip()
            tokens = [(m[0], m.start(), m.end()) for m in _word.finditer(body)]
            joined = None
            if body[-1:] and body[-1] in HYPHENS and tokens and tokens[-1][2] >= len(body) - 1 and tokens[-1][0][-1].isalpha():
                tail = tokens[-1][0].lower()
                if n + 1 < len(lines):
                    after = [(b, lines[n + 1])]
                else:
                    texts_after = islice((x for x in islice(order, at + 1, None) if x["text"] is not None and x["latex"] is None), RESUME_BLOCKS)
                    after = [(x, x["lines"][0]) for x in texts_after if x["running"]]
                chosen = None
                for x, following in after:
                    m = _word.match(following.lstrip())
                    if not m:
                        continue
                    word, sure = join_parts(tail, m[0].lower(), known)
                    if sure or chosen is None and (x is b or m[0][0].islower()):
                        chosen = (x, word)
                    if sure:
                        break
                if chosen:
                    joined = chosen[1]
                    out.add((b["raw_id"], "text", "hyphen", joined, b["context"]))
                    if chosen[0] is not b:
                        chosen[0]["skip"] = 1
                        b["goes_on"] = chosen[0]["raw_id"]
            use = tokens[carry:len(tokens) - (joined is not None)]
            low = [t[0].lower() for t in use]
            if any(w in fixes for w in low):
                result = decode_line(low, fixes, grams, unseen)
            else:
                result = low
            new, end = [], tokens[carry - 1][2] if carry and tokens else 0
            for (token, a, z), w, r in zip(use, low, result):
                if w == r and not w.isalpha() and (number := fix_number(token)):
                    r = number
                if w != r:
                    out.add((b["raw_id"], "text", "misread", r, b["context"]))
                if with_text:
                    new += [body[end:a], token if w == r else r.capitalize() if token[:1].isupper() else r]
                    end = z
            if with_text:
                fixed_lines.append("".join(new) + (body[end:tokens[-1][1]] + joined if joined else body[end:]))
            carry = 1 if joined is not None and n + 1 < len(lines) else 0
        if with_text:
            texts[b["raw_id"]] = re.sub(r"\s+", " ", " ".join(x.strip() for x in fixed_lines)).strip()
        if b["latex"]:
            out.update((*row, b["context"]) for row in repair_latex(b["raw_id"], b["latex"], fixes, known))
    rows = [row[:4] for row in sorted(out, key=str) if not row[4]]
    if with_text:
        whole: dict[int, int] = {}
        for b in reversed(order):
            if (to := b.get("goes_on")) is not None:
                texts[b["raw_id"]] = f"{texts[b['raw_id']]} {texts[to]}".strip()
                whole[to] = b["raw_id"]
        rows += [(b["raw_id"], "text", "paragraph", "" if b["raw_id"] in whole else texts[b["raw_id"]]) for b in order if not b["context"] and b["text"] is not None]
        rows += [(b["raw_id"], "latex", "formula", apply_latex(b["latex"], fixes, known)) for b in order if not b["context"] and b["latex"] is not None]
    return rows


def _command_fix(token: str, fixes: dict, known: dict) -> str | None:
    form = "\\" + token[1:]
    if form in known:
        return form if token[0] != "\\" else None
    best = max(fixes.get(form, ()), key=lambda x: (x[1], x[0]), default=None)
    return best[0] if best else None


def repair_latex(raw_id: int, latex: str, fixes: dict, known: dict) -> list[tuple]:
    """Damage rows of one formula."""
    return [(raw_id, "latex", "misread", new) for _, new in _latex_edits(latex, fixes, known)]


def apply_latex(latex: str, fixes: dict, known: dict) -> str:
    """The formula with its commands and numbers repaired."""
    for old, new in _latex_edits(latex, fixes, known):
        latex = latex.replace(old, new, 1)
    return latex


def _latex_edits(latex: str, fixes: dict, known: dict) -> list[tuple[str, str]]:
    edits, taken = [], []
    for m in _split_command.finditer(latex):
        whole = "\\" + m[1][1:] + m[2]
        if "\\" + m[1][1:] not in known:
            best = whole if whole in known else next((w for w, _ in sorted(fixes.get(whole, ()), key=lambda x: -x[1])), None)
            if best:
                edits.append((m[0], best))
                taken.append(m.span())
    inside = lambda m: any(a <= m.start() < z for a, z in taken)
    for m in _command.finditer(latex):
        if not inside(m) and (new := _command_fix(m[0], fixes, known)):
            edits.append((m[0], new))
    for m in _number.finditer(latex):
        if not inside(m) and (new := fix_number(m[0])):
            edits.append((m[0], new))
    return edits


_DAMAGE = "raw_id bigint, raw_field string, kind string, repaired string"
_ARROW = pa.schema([("raw_id", pa.int64()), ("raw_field", pa.string()), ("kind", pa.string()), ("repaired", pa.string())])
#: what a row of the stream is, in the order in which a bucket reads them
KNOWN, FIX, GRAM, HEADER, FACTS, BLOCK = range(6)
_STREAM = ("document_id", "bucket", "what", "page_index", "block_ix", "raw_id", "block_type", "heading_level", "text", "latex", "context", "a", "b", "score", "number")


def _repair(with_text: bool, unseen: float):
    def finish(held: dict) -> list[tuple]:
        chapters = Stretches(held["offset"], held["title"], held["headers"])
        return repair_bucket(held["blocks"], chapters, held["fixes"], held["grams"], held["known"], with_text, unseen)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, held, rows = None, None, []
        for batch in batches:
            for r in zip(*(batch.column(c).to_pylist() for c in _STREAM)):
                if r[:2] != key:
                    if held and held["blocks"]:
                        rows += finish(held)
                    key, held = r[:2], {"blocks": [], "fixes": {}, "grams": {}, "known": {}, "headers": {}, "offset": None, "title": None}
                    if len(rows) >= 20_000:
                        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), _ARROW)], schema=_ARROW)
                        rows = []
                what, a, b, score, number = r[2], *r[11:]
                if what == KNOWN:
                    held["known"][a] = score
                elif what == FIX:
                    held["fixes"].setdefault(a, []).append((b, score))
                elif what == GRAM:
                    held["grams"][a, b] = score
                elif what == HEADER:
                    held["headers"].setdefault(number, set()).add(a)
                elif what == FACTS:
                    held["offset"], held["title"] = number, a
                else:
                    held["blocks"].append({"page_index": r[3], "raw_id": r[5], "block_type": r[6], "heading_level": r[7], "text": r[8], "latex": r[9], "context": r[10]})
        if held and held["blocks"]:
            rows += finish(held)
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), _ARROW)], schema=_ARROW)

    return run


def placed_blocks(rows: DataFrame) -> DataFrame:
    """The scanned blocks, each once, with their bucket, the number of texts before theirs in it, and of all texts in it."""
    placed = rows.filter("scanned").drop("scanned").withColumn("bucket", F.floor(F.col("page_index") / BUCKET_PAGES).cast("int"))
    inside = Window.partitionBy("document_id", "bucket").orderBy("page_index", "block_ix", "raw_id")
    once = placed.withColumn("again", F.coalesce(F.lag("raw_id").over(inside) == F.col("raw_id"), F.lit(False))).filter("not again").drop("again")
    running = F.when(F.col("text").isNotNull() & F.col("latex").isNull(), 1).otherwise(0)
    so_far = F.sum(running).over(inside.rowsBetween(Window.unboundedPreceding, 0))
    return once.withColumns({"before": so_far - running, "texts": F.sum(running).over(Window.partitionBy("document_id", "bucket"))})


def with_context(placed: DataFrame) -> DataFrame:
    """The blocks of every bucket (context 0) with the RESUME_BLOCKS texts before and after its own (context 1), in whatever buckets they lie."""
    sizes = placed.filter("texts > 0").groupBy("document_id", "bucket").agg(F.max("texts").alias("n"))
    order = Window.partitionBy("document_id").orderBy("bucket")
    near = sizes.select(
        "document_id", "bucket", F.collect_list(F.struct("bucket", "n")).over(order.rowsBetween(1, RESUME_BLOCKS)).alias("next"),
        F.reverse(F.collect_list(F.struct("bucket", "n")).over(order.rowsBetween(-RESUME_BLOCKS, -1))).alias("last"),
    )
    # of the i-th bucket from here as many texts are needed as those between leave
    needed = "posexplode(transform({0}, (x, i) -> struct(x.bucket as there, int({1} - aggregate(slice({0}, 1, i), 0L, (a, y) -> a + y.n)) as need)))"
    wanted = [
        near.select("document_id", "bucket", F.expr(needed.format(side, RESUME_BLOCKS)).alias("i", "x")).select("document_id", F.col("bucket").alias("to"), F.col("x.there").alias("bucket"), F.col("x.need").alias("need"), F.lit(side == "next").alias("forward"))
        for side in ("next", "last")
    ]
    wanted = wanted[0].unionByName(wanted[1]).filter("need > 0")
    texts = placed.filter("text is not null and latex is null").withColumn("left", F.col("texts") - F.col("before") - 1).filter((F.col("before") < RESUME_BLOCKS) | (F.col("left") < RESUME_BLOCKS))
    around = texts.join(wanted, ["document_id", "bucket"]).filter(F.when(F.col("forward"), F.col("before")).otherwise(F.col("left")) < F.col("need"))
    cols = ("page_index", "block_ix", "raw_id", "block_type", "heading_level", "text", "latex")
    own = placed.select("document_id", "bucket", *cols, F.lit(0).alias("context"))
    return own.unionByName(around.select("document_id", F.col("to").alias("bucket"), *cols, F.lit(1).alias("context")))


def known_rows(stream: DataFrame, known: DataFrame) -> DataFrame:
    """document_id, bucket, a and score: what a bucket has to know of the lexicon, to join cut words and to read commands.

    These are the known words that start with a part at a line end (with a very
    short part only those that go on like a text that may resume it), the known
    commands, and those that a blank has cut.
    """
    text = F.lower("text")
    texts = stream.filter("text is not null")
    # of each line the part that it ends in, and the word that it begins with
    end, begin = rf"({WORD})[{HYPHENS}]\s*$", rf"^\s*({WORD})"
    cut = texts.filter(F.col("text").rlike(rf"[{HYPHENS}][ \t]*(\r?\n|$)")).select("document_id", "bucket", F.split(text, "\n").alias("l"))
    cut = cut.select("document_id", "bucket", F.transform("l", lambda x: F.regexp_extract(x, end, 1)).alias("e"), F.transform("l", lambda x: F.regexp_extract(x, begin, 1)).alias("s"))
    cut = stage(cut, "cuts")
    heads = cut.select("document_id", "bucket", F.explode("e").alias("head"))
    short = F.col("head").rlike(f"^.{{1,{SHORT_HEAD}}}$")
    # a short part is resumed by one of the next three lines of its text, or at the text's end by one of the first lines of the bucket's texts
    inside = cut.select("document_id", "bucket", F.explode(F.expr("flatten(transform(e, (x, i) -> transform(slice(s, i + 2, 3), y -> struct(x as head, y as tail))))")).alias("p")).select("document_id", "bucket", "p.*").filter(short)
    at_end = cut.select("document_id", "bucket", F.element_at("e", -1).alias("head")).filter(short).distinct()
    first = texts.join(at_end.select("document_id", "bucket").distinct(), ["document_id", "bucket"], "left_semi")
    first = first.select("document_id", "bucket", F.explode(F.slice(F.split(text, "\n"), 1, 3)).alias("line")).select("document_id", "bucket", F.regexp_extract("line", begin, 1).alias("tail")).distinct()
    pairs = inside.unionByName(at_end.join(first, ["document_id", "bucket"])).filter("tail <> ''")
    whole = pairs.select("document_id", "bucket", F.explode(F.array(F.concat("head", F.substring("tail", 1, 2)), F.concat("head", F.lit("-"), F.substring("tail", 1, 1)))).alias("head"))
    keys = heads.filter(F.length("head") > SHORT_HEAD).unionByName(whole).distinct()
    words = known.filter(~F.col("word").startswith("\\"))
    starts = words.select("word", "n", F.explode(F.expr("transform(sequence(1, length(word)), i -> substring(word, 1, i))")).alias("head"))
    found = keys.join(starts, "head").select("document_id", "bucket", "word", "n")
    formulas = stream.filter("latex is not null and context = 0")
    commands = formulas.select("document_id", "bucket", F.explode(_commands("latex")).alias("word"))
    split = formulas.select("document_id", "bucket", F.explode(F.regexp_extract_all("latex", F.lit(rf"({COMMAND} [A-Za-z0-9]+)"))).alias("word")).withColumn("word", F.replace("word", F.lit(" "), F.lit("")))
    commands = commands.unionByName(split).withColumn("word", F.regexp_replace("word", r"^[/|]", r"\\")).distinct().join(known, "word").select("document_id", "bucket", "word", "n")
    return found.unionByName(commands).distinct().select("document_id", "bucket", F.col("word").alias("a"), F.log("n").alias("score"))


def repairs(raw_blocks: DataFrame, blocks: DataFrame, pages: DataFrame, with_text: bool = False) -> DataFrame:
    """raw_id, raw_field, kind and repaired of every damage; with_text adds the repaired paragraphs and formulas."""
    rows = stage(scanned_rows(raw_blocks, pages), "scanned")
    known, total = lexicon(stage(word_counts(blocks, rows), "lexicon"))
    unknown = stage(unknown_forms(rows, known), "unknown")
    forms = unknown.groupBy("form").agg(F.sum("n").alias("n"))
    fixes = stage(candidates(forms, known, total), "fixes")
    grams = bigram_rows(unknown, fixes, blocks, rows, known, total)
    facts = stage(chapter_facts(rows, pages), "facts")
    stream = stage(with_context(stage(placed_blocks(rows), "placed")), "stream")
    places = stream.select("document_id", "bucket", F.explode(_stretches(F.col("page_index"))).alias("stretch")).distinct()
    forms_at = unknown.select("document_id", "bucket", "form")
    if with_text:
        # the text that goes on in another bucket is repaired there and here
        lent = stream.filter("context = 1").select("document_id", F.col("bucket").alias("to"), F.floor(F.col("page_index") / BUCKET_PAGES).cast("int").alias("bucket")).distinct()
        forms_at = forms_at.unionByName(forms_at.join(lent, ["document_id", "bucket"]).select("document_id", F.col("to").alias("bucket"), "form"))
    parts = (
        known_rows(stream, known).withColumn("what", F.lit(KNOWN)),
        forms_at.distinct().join(fixes, "form").select("document_id", "bucket", F.lit(FIX).alias("what"), F.col("form").alias("a"), F.col("word").alias("b"), (F.col("log_p") + F.col("log_n")).alias("score")),
        grams.select("document_id", "bucket", F.lit(GRAM).alias("what"), "a", "b", F.col("lift").alias("score")),
        places.join(running_headers(rows, facts), ["document_id", "stretch"]).select("document_id", "bucket", F.lit(HEADER).alias("what"), F.col("key").alias("a"), F.col("stretch").alias("number")).distinct(),
        places.select("document_id", "bucket").distinct().join(facts, "document_id").select("document_id", "bucket", F.lit(FACTS).alias("what"), F.col("title").alias("a"), F.col("page_offset").alias("number")),
    )
    every = stream.withColumn("what", F.lit(BLOCK))
    for more in parts:
        every = every.unionByName(more, allowMissingColumns=True)
    every = every.repartition("document_id", "bucket").sortWithinPartitions("document_id", "bucket", "what", "page_index", "block_ix", "raw_id", "context")
    return every.select(*_STREAM).mapInArrow(_repair(with_text, math.log(UNSEEN_COUNT / total)), _DAMAGE).distinct()


def damages(raw_blocks: DataFrame, blocks: DataFrame, pages: DataFrame) -> DataFrame:
    """One row per damage."""
    return repairs(raw_blocks, blocks, pages)


def clean_texts(raw_blocks: DataFrame, blocks: DataFrame, pages: DataFrame) -> DataFrame:
    """raw_id, paragraph and formula of the scanned blocks, repaired; a paragraph cut at a block's end is whole in its first block."""
    rows = repairs(raw_blocks, blocks, pages, True).filter("kind in ('paragraph', 'formula')")
    return rows.groupBy("raw_id").agg(F.max(F.when(F.col("kind") == "paragraph", F.col("repaired"))).alias("paragraph"), F.max(F.when(F.col("kind") == "formula", F.col("repaired"))).alias("formula"))
