"""Benchmark decontamination with suffix arrays over the training words.

The documents of a slice (a shard) become one array of word hashes with a separator after each document, and a suffix
array over it by prefix doubling, sorted to a depth of at least one window. Every suffix of every benchmark item is
binary-searched in it: the range it meets gives all places of its first words, and matches are extended word by word
into longest verbatim matches with their locations. A document never leaves its shard, so nothing is shuffled.

Benchmark items go to workers in blocks of a bounded size (`block_bytes`; an item is never cut), which a task takes up
one after another for each shard, so that neither driver nor worker holds more than one. The usual benchmark is a single
block. Words are compared by two hashes (XXH64 with two seeds): the suffix array goes by one, and every window found and
every word it is extended by is held against the other.

Defined cases: null and empty texts (documents or items) have no words: no hits, and n_words 0; an item shorter than a
window, but not empty, is one window; items that repeat an item_id count as one item; a null item_id counts as the
text "null"; rows that repeat a doc_id are judged each by its own text; an empty benchmark hits nothing; an empty
document table gives no rows; very long texts are read whole, a shard each; other columns are ignored, or kept where
documents are filtered, whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sitesieve.llm import shared
from sitesieve.llm import words as W

RESULT = "doc_id bigint, n_words bigint, n_hit bigint, n_items bigint, items_sha256 string, contaminated boolean"
MATCHES = "doc_id bigint, item_id string, doc_start bigint, item_start bigint, length bigint"


class Items(NamedTuple):
    """Benchmark items as one array of word hashes: separators are 1 between items, where documents have 0."""

    h: np.ndarray
    g: np.ndarray  # a second hash of each word
    item: np.ndarray
    left: np.ndarray  # words from here to the end of the item
    need: np.ndarray  # words of a window that starts here; 0: none does
    place: np.ndarray
    ids: list[str]


def _items(rows: list, window: int) -> Items:
    ids = ["null" if r.item_id is None else str(r.item_id) for r in rows]
    words = W.split(pa.array([r.text or "" for r in rows], pa.string()), W.PLAIN, lower=True)
    h = W.hashes(words)
    n = np.diff(words.first)
    place = np.arange(len(h)) - words.first[words.row]
    left = n[words.row] - place
    width = np.minimum(window, n)[words.row]
    need = np.where(left >= width, width, 0)
    at = np.arange(len(h)) + words.row
    size = len(h) + len(rows)
    wide = [np.full(size, 1, np.uint64), np.full(size, 1, np.uint64), *(np.zeros(size, np.int64) for _ in range(4))]
    for out, values in zip(wide, (h, W.hashes(words, 1), words.row, left, need, place), strict=True):
        out[at] = values
    return Items(*wide, ids)


def blocks(benchmark: DataFrame, window: int, block_bytes: int) -> Iterator[Items]:
    """The items, in blocks of block_bytes of text or a single item."""
    held, size = [], 0
    for row in benchmark.select(F.col("item_id").cast("string").alias("item_id"), "text").toLocalIterator():
        n = len((row.text or "").encode())
        if held and size + n > block_bytes:
            yield _items(held, window)
            held, size = [], 0
        held.append(row)
        size += n
    if held:
        yield _items(held, window)


def suffix_array(h: np.ndarray, depth: int) -> np.ndarray:
    """Starts of the suffixes of h, sorted by their first `depth` (a power of two) values."""
    _, rank = np.unique(h, return_inverse=True)
    size, key = 1, rank
    while size < depth:
        after = np.zeros(len(h), np.int64)
        after[: max(0, len(h) - size)] = rank[size:] + 1
        key = (rank.astype(np.int64) << 32) | after
        size *= 2
        if size >= depth:
            break
        order = np.argsort(key)
        new = np.concatenate([[0], np.cumsum(np.diff(key[order]) != 0)])
        if len(new) and new[-1] == len(h) - 1:  # all differ already
            return order
        rank = np.empty(len(h), np.int64)
        rank[order] = new
    return np.argsort(key)


def _order(h: np.ndarray, at: np.ndarray, items: Items, start: np.ndarray, most: np.ndarray) -> np.ndarray:
    """-1, 0 or 1: how the suffixes of h at `at` stand to the item suffixes at `start`, by `most` words."""
    out = np.zeros(len(at), np.int8)
    open_ = np.arange(len(at))
    for j in range(int(most.max(initial=0))):
        open_ = open_[most[open_] > j]
        if not len(open_):
            break
        x, y = h[np.minimum(at[open_] + j, len(h) - 1)], items.h[start[open_] + j]
        x = np.where(at[open_] + j < len(h), x, np.uint64(0))
        less, more = x < y, x > y
        out[open_[less]] = -1
        out[open_[more]] = 1
        open_ = open_[~(less | more)]
    return out


def _ranges(h: np.ndarray, sa: np.ndarray, items: Items, start: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each item suffix the range of sa whose suffixes begin with its window."""
    found = []
    for upper in (False, True):
        lo, hi = np.zeros(len(start), np.int64), np.full(len(start), len(sa), np.int64)
        while True:
            go = np.flatnonzero(lo < hi)
            if not len(go):
                break
            mid = (lo[go] + hi[go]) // 2
            c = _order(h, sa[mid], items, start[go], items.need[start[go]])
            right = c <= 0 if upper else c < 0
            lo[go[right]] = mid[right] + 1
            hi[go[~right]] = mid[~right]
        found.append(lo)
    return found[0], found[1]


class Shard(NamedTuple):
    words: W.Words
    h: np.ndarray
    g: np.ndarray
    sa: np.ndarray


def shard(texts: pa.Array, window: int) -> Shard:
    words = W.split(texts, W.PLAIN, lower=True)
    h, g = (np.zeros(len(words.start) + len(texts), np.uint64) for _ in range(2))
    for which, out in enumerate((h, g)):
        out[np.arange(len(words.start)) + words.row] = W.hashes(words, which)
    depth = 1 << (window - 1).bit_length()
    return Shard(words, h, g, suffix_array(h, depth))


def located(s: Shard, items: Items) -> tuple[np.ndarray, np.ndarray]:
    """All places in the shard's array (first) and the item suffixes (second) whose windows meet."""
    start = np.flatnonzero(items.need)
    first = np.unique(s.h)
    known = np.searchsorted(first, items.h[start])
    start = start[(known < len(first)) & (first[np.minimum(known, len(first) - 1)] == items.h[start])] if len(first) else start[:0]
    lo, hi = _ranges(s.h, s.sa, items, start)
    n = hi - lo
    which = np.repeat(np.arange(len(start)), n)
    at, start = s.sa[lo[which] + (np.arange(len(which)) - (np.cumsum(n) - n)[which])], start[which]
    true = np.ones(len(at), bool)
    for j in range(int(items.need.max(initial=0))):
        on = np.flatnonzero(items.need[start] > j)
        true[on] &= s.g[at[on] + j] == items.g[start[on] + j]
    return at[true], start[true]


def longest(s: Shard, items: Items) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Longest verbatim matches: place in the shard's array, place in the items, words; none can be extended."""
    at, start = located(s, items)
    before = np.where(at > 0, s.h[at - 1], 0)
    head = (at == 0) | (items.place[start] == 0) | (before != items.h[np.maximum(start - 1, 0)])
    at, start = at[head], start[head]
    length = items.need[start].copy()
    open_ = np.arange(len(at))
    while len(open_):
        x, y = at[open_] + length[open_], start[open_] + length[open_]
        open_ = open_[(x < len(s.h)) & (y < len(items.h))]
        x, y = at[open_] + length[open_], start[open_] + length[open_]
        open_ = open_[(s.h[x] == items.h[y]) & (s.g[x] == items.g[y]) & (s.h[x] > 1)]
        length[open_] += 1
    return at, start, length


def _places(s: Shard) -> tuple[np.ndarray, np.ndarray]:
    """Row and word number of each place of the shard's array (separators belong to the row before them)."""
    n = np.diff(s.words.first) + 1
    row = np.repeat(np.arange(len(n)), n)
    return row, np.arange(len(row)) - (np.cumsum(n) - n)[row]


class Benchmark:
    """The benchmark's blocks, each broadcast by itself. A worker loads one at a time and keeps the last."""

    def __init__(self, benchmark: DataFrame, window: int, block_bytes: int) -> None:
        context = benchmark.sparkSession.sparkContext
        self.window = window
        self.held = [context.broadcast(x) for x in blocks(benchmark, window, block_bytes)]  # block_bytes bounds each

    def __iter__(self) -> Iterator[Items]:
        for i, held in enumerate(self.held):
            if _last.get("of") is not held:
                _last.clear()
                _last.update(of=held, items=held.value)
                vars(held).pop("_value", None)  # or the worker would keep every block
            yield _last["items"]
            if i + 1 < len(self.held):
                _last.clear()


_last: dict = {}


def matches(docs: DataFrame, benchmark: DataFrame, window: int = 13, block_bytes: int = 32 << 20) -> DataFrame:
    """doc_id, item_id, doc_start, item_start, length: longest verbatim matches of a window or more, with places."""
    every = Benchmark(benchmark, window, block_bytes)

    def run(part: pa.RecordBatch):
        s = shard(part.column("text"), window)
        row, number = _places(s)
        found = []
        for items in every:
            at, start, length = longest(s, items)
            ids = part.column("doc_id").take(pa.array(row[at]))
            found.append(pa.RecordBatch.from_arrays([ids, pa.array([items.ids[i] for i in items.item[start]], pa.string()), pa.array(number[at]), pa.array(items.place[start]), pa.array(length)], names=[x.split()[0] for x in MATCHES.split(", ")]))
        return pa.concat_batches(found) if found else None

    return W.mapped(docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text"), run, MATCHES)


def _judged(part: pa.RecordBatch, every: Benchmark) -> tuple[np.ndarray, np.ndarray, list[set[str]]]:
    """Per row: words, words inside matches, and the items met."""
    s = shard(part.column("text"), every.window)
    row, _ = _places(s)
    hit = np.zeros(len(s.h) + 1, np.int64)
    names: list[set[str]] = [set() for _ in range(part.num_rows)]
    for items in every:
        at, start, length = longest(s, items)
        np.add.at(hit, at, 1)
        np.add.at(hit, at + length, -1)
        pairs = np.unique(np.stack([row[at], items.item[start]]), axis=1)
        for r, i in zip(*pairs.tolist(), strict=True):
            names[r].add(items.ids[i])
    covered = np.cumsum(hit[:-1]) > 0
    return np.diff(s.words.first), np.bincount(row[covered], minlength=part.num_rows), names


def judged(docs: DataFrame, benchmark: DataFrame, window: int = 13, one_in: int = 20, block_bytes: int = 32 << 20) -> DataFrame:
    """A row per document: words, words inside matches, items met, and whether at least one word in one_in is hit."""
    every = Benchmark(benchmark, window, block_bytes)

    def run(part: pa.RecordBatch):
        n, hit, names = _judged(part, every)
        bad = (hit > 0) & (one_in * hit >= n)
        digest = [hashlib.sha256(",".join(sorted(x)).encode()).hexdigest() for x in names]
        return pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(n), pa.array(hit), pa.array([len(x) for x in names], pa.int64()), pa.array(digest, pa.string()), pa.array(bad)], names=[x.split()[0] for x in RESULT.split(", ")])

    return W.mapped(docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text"), run, RESULT)


def clean(docs: DataFrame, benchmark: DataFrame, window: int = 13, one_in: int = 20, block_bytes: int = 32 << 20) -> DataFrame:
    """docs without the contaminated ones, with all their columns."""
    every = Benchmark(benchmark, window, block_bytes)

    def run(part: pa.RecordBatch):
        n, hit, _ = _judged(part, every)
        return part.filter(pa.array((hit == 0) | (one_in * hit < n)))

    return W.mapped(docs, run, docs.schema)


def op4_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judged(shared.table(spark, sf_dir, "documents"), shared.table(spark, sf_dir, "benchmark"))
