"""Evaluation texts leaking into training text."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wavetide.llm.codes import Stretches, code_points, text_pieces

#: Successive words that make a passage.
WORDS = 15
#: Characters of test items that one pass over the corpus carries; more items take more passes.
ITEM_CHARS = 8_000_000
#: Characters of a shard, whose suffixes are sorted together.
SHARD_CHARS = 2_000_000

_letters: np.ndarray | None = None
_known: np.ndarray | None = None


def lower_letters(codes: np.ndarray) -> np.ndarray:
    """For each code point its lower-case form as a number, 0 if it is neither letter nor digit."""
    global _letters, _known
    if _letters is None:
        _letters, _known = np.zeros(0x110000, np.uint32), np.zeros(0x110000, bool)
    there = np.zeros(0x110000, bool)
    there[codes] = True
    for c in np.flatnonzero(there & ~_known).tolist():
        if (x := chr(c)).isalnum():
            low = x.lower().replace("ς", "σ")  # the final sigma is the same letter
            _letters[c] = ord(low) if len(low) == 1 else c
        _known[c] = True
    return _letters[codes]


def words_of(codes: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash, text and place within the text of each word (a longest run of letters and digits, in lower case)."""
    letters = lower_letters(codes)
    part = letters != 0
    first = np.zeros(len(codes) + 1, bool)
    first[offsets[:-1]] = True
    starts = np.flatnonzero(part & ~np.concatenate([[False], part[:-1]]) | part & first[:-1])
    ends = np.flatnonzero(part & (~np.concatenate([part[1:], [False]]) | first[1:])) + 1
    text = np.searchsorted(offsets, starts, side="right") - 1
    per_text = np.bincount(text, minlength=len(offsets) - 1)
    place = np.arange(len(starts)) - np.repeat(np.cumsum(per_text) - per_text, per_text)
    return Stretches(letters).of(starts, ends), text, place


@dataclass
class TestSuffixes:
    """All suffixes of the test items with enough words: ``words`` are the items' words on end, by their numbers (from 1) in
    the items' vocabulary; a suffix begins at each of ``starts``."""

    vocabulary: np.ndarray
    item: np.ndarray
    place: np.ndarray
    words: np.ndarray
    starts: np.ndarray
    size: int

    @staticmethod
    def of(items: list[tuple[int, str]], size: int) -> TestSuffixes:
        codes, offsets = code_points(pa.array([t for _, t in items], pa.string()))
        hashes, text, place = words_of(codes, offsets)
        vocabulary = np.unique(hashes)
        ids = np.searchsorted(vocabulary, hashes) + 1
        n = max(0, len(ids) - size + 1)
        at = np.flatnonzero(text[:n] == text[size - 1 :]) if n else np.zeros(0, np.int64)
        return TestSuffixes(vocabulary, np.array([i for i, _ in items], np.int64)[text[at]], place[at], ids, at, size)

    def alive(self, tokens: np.ndarray) -> np.ndarray:
        """Suffixes of whose first words all stand somewhere among ``tokens``; no other can be found in them."""
        there = np.zeros(len(self.vocabulary) + 1, bool)
        there[tokens] = True
        lost = np.concatenate([[0], np.cumsum(~there[self.words])])
        return np.flatnonzero(lost[self.starts + self.size] == lost[self.starts])


def suffix_array(tokens: np.ndarray, depth: int) -> np.ndarray:
    """Starts of all suffixes, sorted by their first ``depth`` tokens or more (prefix doubling)."""
    n, rank, h = len(tokens), tokens.astype(np.int64), 1
    order = np.argsort(rank, kind="stable")
    while h < depth:
        behind = np.zeros(n, np.int64)
        behind[: max(0, n - h)] = rank[h:] + 1
        key = rank * (int(rank.max(initial=0)) + 2 + n) + behind
        order = np.argsort(key, kind="stable")
        new = np.concatenate([[0], np.cumsum(np.diff(key[order]) != 0)])
        rank[order] = new
        h *= 2
    return order


def bisect(tokens: np.ndarray, order: np.ndarray, wanted: np.ndarray, after: bool) -> np.ndarray:
    """Where each row of ``wanted`` stands among the sorted suffixes: before (or after) all that begin with it."""
    size = wanted.shape[1]
    padded = np.concatenate([tokens, np.zeros(size, tokens.dtype)])
    lo, hi = np.zeros(len(wanted), np.int64), np.full(len(wanted), len(order), np.int64)
    reach = np.arange(size)
    while (open_ := np.flatnonzero(lo < hi)).size:
        mid = (lo[open_] + hi[open_]) // 2
        differ = padded[order[mid][:, None] + reach] - wanted[open_]
        first = (differ != 0).argmax(1)
        sign = differ[np.arange(len(mid)), first]
        right = (sign < 0) | (after & (sign == 0))
        lo[open_[right]] = mid[right] + 1
        hi[open_[~right]] = mid[~right]
    return lo


def search_shard(texts: pa.Array, tests: TestSuffixes) -> tuple[np.ndarray, ...]:
    """text, item, words of the longest match, its place in the item and in the text (in words), once per text and item."""
    none = tuple(np.zeros(0, np.int64) for _ in range(5))
    size = tests.size
    if not len(tests.starts):
        return none
    hashes, text, place = words_of(*code_points(texts))
    if not len(hashes):
        return none
    index = np.minimum(np.searchsorted(tests.vocabulary, hashes), len(tests.vocabulary) - 1)
    ids = np.where(tests.vocabulary[index] == hashes, index + 1, 0)
    # only runs of test words can hold a match; a 0 is put behind each run
    run = np.cumsum(np.concatenate([[True], (np.diff(text) != 0) | ((ids[1:] == 0) != (ids[:-1] == 0))])) - 1
    keep = (ids != 0) & (np.bincount(run)[run] >= size)
    at = np.flatnonzero(keep)
    if not len(at):
        return none
    breaks = np.flatnonzero(np.diff(run[at])) + 1
    tokens, source = np.insert(ids[at], breaks, 0), np.insert(at, breaks, -1)
    alive = tests.alive(tokens)
    if not len(alive):
        return none
    order = suffix_array(tokens, size)
    wanted = tests.words[tests.starts[alive][:, None] + np.arange(size)]
    lo, hi = bisect(tokens, order, wanted, False), bisect(tokens, order, wanted, True)
    n = hi - lo
    which = np.repeat(alive, n)
    where = source[order[np.repeat(lo - np.cumsum(n) + n, n) + np.arange(n.sum())]]
    doc, item, in_item, in_doc = text[where], tests.item[which], tests.place[which], place[where]
    # matches at successive words of item and text are one longer match
    by = np.lexsort((in_item, in_doc - in_item, item, doc))
    doc, item, in_item, in_doc = doc[by], item[by], in_item[by], in_doc[by]
    if not len(doc):
        return none
    new = np.concatenate([[True], (np.diff(doc) != 0) | (np.diff(item) != 0) | (np.diff(in_item) != 1) | (np.diff(in_doc) != 1)])
    first = np.flatnonzero(new)
    words = np.diff(np.append(first, len(doc))) + size - 1
    doc, item, in_item, in_doc = doc[first], item[first], in_item[first], in_doc[first]
    by = np.lexsort((in_doc, in_item, -words, item, doc))
    best = by[np.concatenate([[True], (np.diff(doc[by]) != 0) | (np.diff(item[by]) != 0)])]
    return doc[best], item[best], words[best], in_item[best], in_doc[best]


def find_leaks(docs: DataFrame, items: DataFrame, size: int = WORDS) -> DataFrame:
    """doc_id, item_id, n_words, item_from, doc_from: each document that holds ``size`` successive words of an item, and
    the longest passage they share with its places (in words, from 0).

    Words are the longest runs of letters and digits, in lower case. The corpus is cut into shards (runs of an Arrow
    batch); each shard's words are put in a suffix array, in which every suffix of every item whose words all stand in the
    shard is searched by bisection.
    Only the matches leave a task, so no text is shuffled. The items go to all tasks, in as many passes as they need at
    ITEM_CHARS characters each.

    ``docs``: doc_id, text; ``items``: item_id, text. Null and empty texts, items with fewer words, and rows without id match
    nothing; repeated rows match once; texts of any length are searched whole; further columns are dropped.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").filter("doc_id is not null and text is not null")
    items = items.select(F.col("item_id").cast("long").alias("item_id"), "text").filter("item_id is not null").filter(F.length("text") >= 2 * size - 1).distinct()
    chars = items.agg(F.sum(F.length("text"))).first()[0] or 0
    passes = -(-chars // ITEM_CHARS) or 1
    found = None
    for k in range(passes):
        part = items.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(passes)) == k).collect() if passes > 1 else items.collect()
        tests = docs.sparkSession.sparkContext.broadcast(TestSuffixes.of(sorted((r.item_id, r.text) for r in part), size))

        def run(batches: Iterator[pa.RecordBatch], tests=tests) -> Iterator[pa.RecordBatch]:
            for whole in batches:
                for batch in text_pieces(whole, most=SHARD_CHARS):
                    doc, *rest = search_shard(batch.column("text"), tests.value)
                    yield pa.RecordBatch.from_arrays([batch.column("doc_id").take(pa.array(doc)), *(pa.array(x.astype(np.int64)) for x in rest)], ["doc_id", "item_id", "n_words", "item_from", "doc_from"])

        hits = docs.mapInArrow(run, "doc_id long, item_id long, n_words long, item_from long, doc_from long")
        found = hits if found is None else found.unionByName(hits)
    longest = F.max_by(F.struct("n_words", "item_from", "doc_from"), F.struct("n_words", -F.col("item_from"), -F.col("doc_from")))
    return found.groupBy("doc_id", "item_id").agg(longest.alias("m")).select("doc_id", "item_id", "m.*")


def without_leaks(docs: DataFrame, leaks: DataFrame) -> DataFrame:
    """The rows of ``docs`` that leak no item (rows without doc_id stay)."""
    return docs.join(leaks.select("doc_id").distinct(), "doc_id", "left_anti")
