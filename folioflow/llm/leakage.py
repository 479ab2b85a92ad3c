"""Evaluation texts leaking into training text.

Method: q-gram lemma filtering. Texts are reduced to their letters and digits,
so case, punctuation, spacing, line breaks, hyphenation, markup and invisible
characters don't count. Shared character q-grams are counted per document, item
and diagonal band; bands are as wide as the item and looked at in overlapping
pairs, so a region that drifts by the item's own length stays inside one pair.
A region is kept if it shares at least as many q-grams as the edit budget must
leave: the item's q-grams less those that its most expensive quarter of words
can break, or the fewest that any run of ``RUN_WORDS`` words has. What is kept
is verified: a run of ``RUN_WORDS`` words as a substring, and whatever meets the
edit bound by the words found in their order, or by an alignment in the band of
diagonals that the shared q-grams lie in, widened by the edit budget.

Only q-grams that few items have are counted, and the bounds are computed for
these, so the filter loses no run and no item with words misread or replaced
within the budget; an item whose bound would become too small for it counts
more frequent ones too. Words put in between break the q-grams at these places
in addition: one at every second place is still found, one at every place is
beyond the bound.

The items are held by every task. They are dealt into blocks by their sizes, so
that a block has at most ``BLOCK_CHARS`` characters (more only where one item
alone is longer), and every block is compared with all documents: the cost is
the corpus times the number of blocks. Documents are never shuffled, and long
ones are cut into overlapping pieces, whole texts always.

Letters of all scripts count: accents are taken off, and a letter that is not
Latin stands for one of 26 classes, in items and documents alike.

Defined results for odd input: null and blank texts and rows with a null id
match nothing; items without words too; repeated rows give one result; an item
shorter than a run of ``RUN_WORDS`` words can only match as a whole; extra
columns are not looked at; empty tables give an empty result.
"""

from __future__ import annotations

import html
import re
import unicodedata
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

Q = 8
RUN_WORDS = 14
KEPT_SHARE = 0.75
STRETCH = 2
#: an alignment may lose so many characters at either end of what it finds
EDGE = 16
#: a q-gram counts for an item if at most so many occurrences are in all items; the next step is taken while an item's bound is below LEAST_BOUND
COMMON_STEPS = (2, 3, 4, 6, 9, 12, 18, 25, 50, 100, 1 << 30)
LEAST_BOUND = 20
BLOCK_CHARS = 4_000_000
#: items are dealt to blocks in so many cells a block
CELLS = 16
PIECE_CHARS = 1_000_000

_ALNUM = b"0123456789abcdefghijklmnopqrstuvwxyz"
_LOWER = bytes(range(256)).lower()
_DROP = bytes(c for c in range(256) if bytes([c]).lower() not in [_ALNUM[i:i + 1] for i in range(36)])
_DROP_BUT_BLANKS = bytes(c for c in _DROP if c not in b" \t\r\n\v\f")
_CODE = np.zeros(256, np.uint64)
_CODE[list(_ALNUM)] = np.arange(36)
#: a tag is short, or made of attributes with values, whatever their length; prose between two angle brackets is neither
_ATTRIBUTE = r"""\s+[\w:@.-]+\s*=\s*(?:"[^"]*"|'[^']*'|[^\s"'<>]+)"""
_TAG = re.compile(rf"<!--(?:(?!<!--).)*?-->|</?[A-Za-z][\w:-]*(?:{_ATTRIBUTE})+\s*/?>|</?[A-Za-z!][^<>]{{0,300}}>|(?<=\])\([^()\s]+(?:\s+\"[^\"]*\")?\)", re.S)
_CUT = re.compile(r"[-\u00ad\u2010\u00ac][ \t]*\r?\n\s*")
_ENTITY = re.compile(r"&#?\w{1,10};")
_HASH = np.uint64(0x9E3779B97F4A7C15)


class _Classes(dict):
    """Letters and digits as ASCII ones, for str.translate(); filled as characters come up."""

    def __missing__(self, c: int) -> str | None:
        ch = chr(c).lower()
        self[c] = chr(c) if c < 128 else " " if ch.isspace() else chr(97 + ord(ch[0]) % 26) if ch.isalpha() else str(unicodedata.digit(ch, 0)) if ch.isalnum() else None
        return self[c]


_classes = _Classes()


def _plain(text: str) -> str:
    """The text without markup, in ASCII letters."""
    if "<" in text or "](" in text:
        text = _TAG.sub("", text)
    if "&" in text and _ENTITY.search(text):
        text = _TAG.sub("", html.unescape(text))
    return text if text.isascii() else unicodedata.normalize("NFKD", text).translate(_classes)


def stream(text: str) -> bytes:
    """Letters and digits of a text, in lower case."""
    return _plain(text).encode("ascii", "ignore").translate(_LOWER, _DROP)


def words_of(text: str) -> list[bytes]:
    """The words of a text between white space, each as its letters and digits; words hyphenated at a line end are joined."""
    text = _CUT.sub("", text)
    return _plain(text).encode("ascii", "ignore").translate(_LOWER, _DROP_BUT_BLANKS).split()


def grams(s: bytes) -> np.ndarray:
    """Codes of all q-grams of a stream."""
    codes = _CODE[np.frombuffer(s, np.uint8)]
    n = len(codes) - Q + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    out = codes[:n].copy()
    for i in range(1, Q):
        out *= np.uint64(36)
        out += codes[i:i + n]
    return out


class ItemIndex:
    """Items with their counted q-grams and bounds."""

    def __init__(self, items: list[tuple[int, str]]):
        kept = [(i, w) for i, w in ((i, words_of(t or "")) for i, t in items) if w]
        self.ids = [i for i, _ in kept]
        self.words = [w for _, w in kept]
        self.streams = [b"".join(w) for w in self.words]
        self.length = np.array([max(len(s), Q) for s in self.streams], np.int64)
        self._runs: dict[int, list[bytes]] = {}
        every = [grams(s) for s in self.streams]
        sizes = np.array([len(g) for g in every], np.int64)
        codes = np.concatenate([np.empty(0, np.uint64), *every])
        _, where, times = np.unique(codes, return_inverse=True, return_counts=True)
        common = np.split(times[where], np.cumsum(sizes)[:-1]) if len(sizes) else []
        self.run_bound = np.ones(len(kept), np.int64)
        self.edit_bound = np.ones(len(kept), np.int64)
        counted: list[np.ndarray] = []
        for k, often in enumerate(common):
            for step in COMMON_STEPS:
                mask = often <= step
                run, edit = self._least_shared(self.words[k], mask)
                if min(run, edit) >= LEAST_BOUND:
                    break
            self.run_bound[k], self.edit_bound[k] = max(1, run), max(1, edit)
            counted.append(mask)
        self.bound = np.minimum(self.run_bound, self.edit_bound)
        use = np.concatenate([np.empty(0, bool), *counted])
        item = np.repeat(np.arange(len(kept), dtype=np.int32), sizes)[use]
        at = np.concatenate([np.empty(0, np.int32), *(np.arange(n, dtype=np.int32) for n in sizes)])[use]
        codes = codes[use]
        # the codes lie in the order of their slots, and first[] tells where a slot begins: any number of codes fits
        self.bits = max(8, 2 + int(len(codes)).bit_length())
        order = np.lexsort((codes, self._slot(codes)))
        codes, self.item, self.at = codes[order], item[order], at[order]
        start = np.flatnonzero(np.append(True, codes[1:] != codes[:-1])) if len(codes) else np.empty(0, np.int64)
        self.codes = codes[start]
        self.start = np.append(start, len(codes)).astype(np.int64)
        per_slot = np.bincount(self._slot(self.codes), minlength=1 << self.bits)
        self.first = np.concatenate([[0], np.cumsum(per_slot)]).astype(np.int32)
        self.probes = int(per_slot.max(initial=0))

    def _slot(self, codes: np.ndarray) -> np.ndarray:
        return ((codes * _HASH) >> np.uint64(64 - self.bits)).astype(np.int64)

    def runs(self, k: int) -> list[bytes]:
        """All runs of RUN_WORDS words of an item."""
        if k not in self._runs:
            w = self.words[k]
            self._runs[k] = [b"".join(w[i:i + RUN_WORDS]) for i in range(len(w) - RUN_WORDS + 1)]
        return self._runs[k]

    @staticmethod
    def _least_shared(words: list[bytes], counted: np.ndarray) -> tuple[int, int]:
        """The fewest counted q-grams that a run of RUN_WORDS words has, and those that are left if the dearest words are broken."""
        total = np.concatenate([[0], np.cumsum(counted)])
        n = len(counted)
        ends = np.cumsum([len(w) for w in words])
        between = lambda a, b: int(total[min(max(b, 0), n)] - total[min(max(a, 0), n)])
        broken = sorted((between(e - len(w) - Q + 1, e) for w, e in zip(words, ends)), reverse=True)
        edit = int(total[-1]) - sum(broken[:len(words) - int(np.ceil(KEPT_SHARE * len(words)))])
        run = min((between(int(ends[k]) - len(words[k]), int(ends[k + RUN_WORDS - 1]) - Q + 1) for k in range(len(words) - RUN_WORDS + 1)), default=edit)
        return run, edit

    def lookup(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Positions in codes that are indexed, and their number in the index."""
        slot = self._slot(codes)
        number, end = self.first[slot], self.first[slot + 1]
        pos = np.flatnonzero(number < end)
        number, end = number[pos], end[pos]
        found_pos, found = [np.empty(0, np.int64)], [np.empty(0, np.int32)]
        while len(pos):
            hit = self.codes[number] == codes[pos]
            found_pos.append(pos[hit])
            found.append(number[hit])
            more = ~hit & (number + 1 < end)
            pos, number, end = pos[more], number[more] + 1, end[more]
        return np.concatenate(found_pos), np.concatenate(found)

    def regions(self, s: bytes) -> list[tuple[int, int, int, bool, int, int]]:
        """(item, from, to, whether the edit bound is met too, least and greatest diagonal) of the regions of a stream that may hold a run or meet the edit bound."""
        pos, number = self.lookup(grams(s))
        if not len(pos):
            return []
        n = self.start[number + 1] - self.start[number]
        flat = np.arange(int(n.sum())) + np.repeat(self.start[number] - np.cumsum(n) + n, n)
        item = self.item[flat]
        # an item with too few q-grams in the whole piece has no band with enough
        enough = np.bincount(item, minlength=len(self.ids)) >= self.bound
        kept = np.flatnonzero(enough[item])
        if not len(kept):
            return []
        item = item[kept].astype(np.int64)
        diagonal = np.repeat(pos, n)[kept] - self.at[flat[kept]]
        length = self.length[item]
        band = (diagonal + length) // length
        wide = int(band.max()) + 2
        key, where, count = np.unique(item * wide + band, return_inverse=True, return_counts=True)
        low, high = np.full(len(key), 1 << 60), np.full(len(key), -(1 << 60))
        np.minimum.at(low, where, diagonal)
        np.maximum.at(high, where, diagonal)
        # a pair of neighbouring bands is looked at from its first one; a band without a first one stands alone
        follows = np.append(key[1:] == key[:-1] + 1, False)
        after = np.append(count[1:], 0) * follows
        out = []
        for i in np.flatnonzero(count + after >= self.bound[key // wide]).tolist():
            k, b = divmod(int(key[i]), wide)
            j = i + 1 if follows[i] else i
            out.append((k, (b - 1) * int(self.length[k]), (b + 2) * int(self.length[k]), bool(count[i] + after[i] >= self.edit_bound[k]), int(min(low[i], low[j])), int(max(high[i], high[j]))))
        return out


def common_words(item: list[bytes], text: list[bytes]) -> int:
    """Length of the longest common subsequence of words, bit-parallel."""
    where: dict[bytes, int] = {}
    for i, w in enumerate(item):
        where[w] = where.get(w, 0) | 1 << i
    row = full = (1 << len(item)) - 1
    for w in text:
        m = where.get(w)
        if m:
            u = row & m
            row = ((row + u) | (row - u)) & full
    return len(item) - row.bit_count()


def best_in_stretch(item: list[bytes], text: list[bytes], enough: int) -> bool:
    """Whether some stretch of STRETCH times the item's words holds enough of its words in order."""
    if common_words(item, text) < enough:
        return False
    size = STRETCH * len(item)
    known = set(item)
    return len(text) <= size or any(text[k] in known and common_words(item, text[k:k + size]) >= enough for k in range(len(text) - enough + 1))


def words_in_order(words: list[bytes], s: bytes, enough: int) -> bool:
    """Whether enough of the words stand in a stream in their order, wherever the stream's own words begin and end.

    A case needs that; it is cheaper to tell than an alignment, which finds the stretch that they must stand in.
    """
    spare = len(words) - enough
    there = [w in s for w in words]
    if len(words) - sum(there) > spare:
        return False
    # ends[k]: where the stream has been read to at least, if k words so far were left out; None: not possible
    ends: list[int | None] = [0] + [None] * spare
    for w, found in zip(words, there):
        new: list[int | None] = []
        before = None
        for k in range(spare + 1):
            at = ends[k]
            if at is not None and found:
                at = s.find(w, at)
                at = at + len(w) if at >= 0 else None
            elif not found:
                at = None
            new.append(at if before is None else before if at is None else min(at, before))
            before = ends[k]
        ends = new
        if all(e is None for e in ends):
            return False
    return True


def aligned_stretch(words: list[bytes], s: bytes, low: int, high: int) -> tuple[int, int]:
    """From where to where a stream holds what a banded alignment finds of the item.

    Only places of the stream on the diagonals low to high are looked at: the
    place of the item's character i lies between i + low and i + high.
    """
    a, b = np.frombuffer(b"".join(words), np.uint8), np.frombuffer(s, np.uint8)
    m, width = len(a), high - low + 2
    # text[i + d] is the character of the stream that diagonal low + d has for the item's character i
    text = np.zeros(m + width, np.uint8)
    first, last = max(0, low), min(len(b), low + m + width)
    if first < last:
        text[first - low:last - low] = b[first:last]
    d = np.arange(width, dtype=np.int32)
    score = np.zeros(width, np.int32)
    move = np.zeros((m, width), np.uint8)
    up = np.full(width, -(1 << 20), np.int32)
    for i in range(m):
        diagonal = score + np.where(text[i:i + width] == a[i], 2, -2)
        up[:-1] = score[1:] - 2
        best = np.maximum(diagonal, up)
        across = np.maximum.accumulate(best + d) - d
        move[i] = np.where(across > best, 2, np.where(diagonal >= up, 0, 1))
        score = across
    at, i = int(score.argmax()), m - 1
    place = np.full(m, -1, np.int64)
    while i >= 0 and 0 <= at < width:
        how = move[i, at]
        if how == 0:
            if text[i + at] == a[i]:
                place[i] = i + at
            i -= 1
        elif how == 2:
            at -= 1
        else:
            i, at = i - 1, at + 1
    used = place[place >= 0]
    return (low + int(used[0]), low + int(used[-1]) + 1) if len(used) else (0, 0)


def leaked_items(index: ItemIndex, text: str) -> set[int]:
    """Ids of the items that a text holds."""
    whole = stream(text)
    out: set[int] = set()
    longest = int(index.length.max(initial=1))
    step = max(PIECE_CHARS, 8 * longest)
    tokens: list[bytes] | None = None
    ends: np.ndarray | None = None
    for begin in range(0, max(1, len(whole)), step):
        offset = max(0, begin - 4 * longest)
        s = whole[offset:begin + step]
        for k, a, b, whole_item, low, high in index.regions(s):
            if index.ids[k] in out:
                continue
            a, b = max(0, a), b + Q
            piece = s[a:b]
            if any(run in piece for run in index.runs(k)):
                out.add(index.ids[k])
                continue
            if not whole_item:
                continue
            words = index.words[k]
            enough = int(np.ceil(KEPT_SHARE * len(words)))
            if tokens is None:
                tokens = words_of(text)
                ends = np.cumsum([len(t) for t in tokens])
            first, last = np.searchsorted(ends, [offset + a, offset + b])
            if best_in_stretch(words, tokens[first:last + 1], enough):
                out.add(index.ids[k])
                continue
            # words that are cut or run together don't count above
            if not words_in_order(words, piece, enough):
                continue
            budget = sum(sorted(map(len, words), reverse=True)[:len(words) - enough])
            first, last = aligned_stretch(words, s, low - budget, high + budget)
            if last - first <= STRETCH * len(index.streams[k]) and words_in_order(words, s[max(0, first - EDGE):last + EDGE], enough):
                out.add(index.ids[k])
    return out


_FOUND = "doc_id bigint, item_id bigint"
_ARROW = pa.schema([("doc_id", pa.int64()), ("item_id", pa.int64())])


def _search(items: list[tuple[int, str]]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = ItemIndex(items)
        for batch in batches:
            rows = [(i, k) for i, t in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()) for k in sorted(leaked_items(index, t))]
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows)], schema=_ARROW)

    return run


def item_blocks(items: DataFrame, block_chars: int) -> list[DataFrame]:
    """The items in blocks of at most so many characters, where no item alone is longer.

    Items are thrown into cells by hash; a block is as many cells as it holds.
    Cells that are too large by themselves are split again.
    """
    blocks: list[DataFrame] = []
    todo = [(items, 0)]
    while todo:
        part, level = todo.pop()
        total = part.agg(F.sum(F.length("text"))).first()[0] or 0
        if not total:
            continue
        cells = max(1, CELLS * -(-total // block_chars)) if total > block_chars else 1
        cell = F.pmod(F.xxhash64(F.lit(level), "item_id", "text"), F.lit(cells))
        taken: list[int] = []
        size = 0
        for c, n, rows in part.groupBy(cell.alias("c")).agg(F.sum(F.length("text")).alias("n"), F.count(F.lit(1)).alias("rows")).orderBy("c").collect():
            if n > block_chars and rows > 1:
                todo.append((part.filter(cell == c), level + 1))
                continue
            if taken and size + n > block_chars:
                blocks.append(part.filter(cell.isin(taken)))
                taken, size = [], 0
            taken.append(c)
            size += n
        if taken:
            blocks.append(part.filter(cell.isin(taken)))
    return blocks


def leaks(documents: DataFrame, items: DataFrame, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """doc_id and item_id of every document that holds a passage of an item."""
    docs = documents.filter("doc_id is not null and trim(text) <> ''").select(F.col("doc_id").cast("bigint"), "text")
    items = items.filter("item_id is not null and trim(text) <> ''").select(F.col("item_id").cast("bigint"), "text").distinct()
    parts = []
    for block in item_blocks(items, block_chars):
        held = [tuple(r) for r in block.collect()]
        parts.append(docs.mapInArrow(_search(held), _FOUND))
    if not parts:
        return docs.limit(0).select("doc_id", F.lit(None).cast("bigint").alias("item_id"))
    return reduce(DataFrame.unionByName, parts).distinct()
