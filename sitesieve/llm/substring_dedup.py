"""Substring deduplication by level-wise doubling.

Windows of `start_words` words are looked at first. Only those that occur at two places or more are extended to windows
of twice that length, and so on, until windows of `min_words` words are reached or no candidate is left. A word goes
if a window of `min_words` words covers it whose word sequence also starts earlier (a smaller doc_id, or the same
document at an earlier place). Windows are judged on the input.

Levels below the last need not look at every window: of the level's windows inside a window of `min_words` words, the
one with the least hash (the leftmost of equals) stands for it. Equal long windows have equal representatives, so a
long window whose representative occurs once in the corpus occurs once too; nothing is lost, and about 2 / (n + 1) of
the windows are counted, n being the windows of that level in one long window.

Windows that repeat within a slice are known to be repeats: they need no meeting with others, and send one witness of
their hash for the windows of other slices. So a very common window has at most two rows a slice where hashes meet, and
no task gets the occurrences of one.

Defined cases: null and empty texts have no words (nothing removed, the hash of the empty text); texts shorter than a
window keep all words; a null doc_id orders before all others; rows that repeat both doc_id and text are the same
document and get the same result each; rows with one doc_id and different texts are documents of their own, ordered
by a hash of the text; an empty table gives no rows; very long texts are read whole, a slice each; other columns are
ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sitesieve.llm import shared
from sitesieve.llm import words as W

KEY = ["k", "t"]
#: Groups of equal texts whose rows are dealt out.
HOT_GROUPS = 1000
RESULT = "doc_id bigint, n_words bigint, n_removed bigint, kept_sha256 string"


def keyed(docs: DataFrame, with_rest: bool = False) -> DataFrame:
    """k, t (the document's identity: its id and a hash of its text), text and, in the struct rest, all other columns.
    All levels read all of it, so that they have one exchange of the texts in common."""
    text = F.coalesce(F.col("text"), F.lit(""))
    more = shared.rest_of(docs, "text") if with_rest else []
    return docs.select(*more, F.coalesce(F.col("doc_id").cast("bigint"), F.lit(shared.NO_ID)).alias("k"), F.xxhash64(text).alias("t"), text.alias("text"))


def _representatives(h: np.ndarray, ok: np.ndarray, n: int) -> np.ndarray:
    """For each run of n hashes where ok (for its first place), the place of the least one, leftmost of equals; else -1."""
    size = len(ok)
    low, at = h.copy(), np.arange(len(h))
    width = 1
    while width < n:  # least over [i, i + width); the step may overlap
        step = min(width, n - width)
        a, b = low[: len(low) - step], low[step:]
        right = b < a
        at = np.where(right, at[step:], at[: len(at) - step])
        low = np.where(right, b, a)
        width += step
    return np.where(ok, at[:size], -1)


def _alive(words: W.Words, level: int, length: int, listed: list[np.ndarray | None] | None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of the level's windows, the representative of each long window, and which long windows are candidates.

    listed: per row the word positions of representatives that survived this level; None before it is counted."""
    h = W.windows(W.hashes(words), level)
    ok = W.inside(words, length)
    rep = _representatives(h, ok, length - level + 1) if len(ok) else np.zeros(0, np.int64)
    if listed is not None and len(ok):
        good = np.zeros(len(h) + 1, bool)  # the last place serves -1
        for row, places in enumerate(listed):
            if places is not None:
                good[words.first[row] + places] = True
        ok = good[rep]
    return h, rep, ok


def _places(column: pa.Array) -> list[np.ndarray | None]:
    flat = column.flatten().to_numpy(zero_copy_only=False)
    sizes = W.pc.fill_null(W.pc.list_value_length(column), 0).to_numpy(zero_copy_only=False)
    cuts = np.cumsum(sizes)
    return [flat[c - n : c] if n else None for c, n in zip(cuts, sizes, strict=True)]


def _fresh(words: W.Words, k: np.ndarray, t: np.ndarray, ok: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each row's document by number, in the order of documents, and ok without the windows of rows that repeat one."""
    doc, new, order = np.empty(len(k), np.int64), np.ones(len(k), bool), np.lexsort((t, k))
    new[1:] = (k[order][1:] != k[order][:-1]) | (t[order][1:] != t[order][:-1])
    doc[order] = np.cumsum(new) - 1
    first = np.zeros(len(k), bool)
    first[order[new]] = True
    return doc, ok & first[words.row[: len(ok)]]


#: Rows of a level. h, g: the window's hash (g is a second one at the last level, else 0); place: its first word; known:
#: places settled within the slice (place is -1 then), whose h and g are the document's own and meet no other row's.
#: A witness of a settled hash has a null k.
FOUND = "k bigint, t bigint, place int, h bigint, g int, known array<int>"


def _rows(k, t, place, h, g, by_k, by_t, lists, witness) -> pa.RecordBatch | None:
    n, m, w = len(k), len(by_k), len(witness)
    if not n + m + w:
        return None
    own = W.mix(by_k.view(np.uint64) ^ W.mix(by_t.view(np.uint64)))
    none = [None] * w
    ids = lambda x, y: pa.concat_arrays([pa.array(np.concatenate([x, y])), pa.array(none, pa.int64())])
    return pa.RecordBatch.from_arrays(
        [
            ids(k, by_k), ids(t, by_t), pa.array(np.concatenate([place, np.full(m + w, -1)]).astype(np.int32)),
            pa.array(np.concatenate([h, own, witness]).view(np.int64)), pa.array(np.concatenate([g, np.zeros(m + w, np.uint64)]).astype(np.uint32).view(np.int32)),
            pa.array([None] * n + lists + none, pa.list_(pa.int32())),
        ],
        names=[x.split()[0] for x in FOUND.split(", ")],
    )


def _settled(rows: np.ndarray, place: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
    """Rows (sorted) that have settled places, and the places of each."""
    by, begin = np.unique(rows, return_index=True)
    return by, np.split(place.astype(np.int32), begin[1:]) if len(by) else []


def _candidates(level: int, previous: int | None, length: int):
    """Representative windows of the level in candidate long windows: see FOUND."""

    def run(part: pa.RecordBatch):
        words = W.split(part.column("text"))
        k, t = (part.column(c).to_numpy(zero_copy_only=False) for c in KEY)
        if previous:
            _, _, ok = _alive(words, previous, length, _places(part.column("places")))
            h, rep, _ = _alive(words, level, length, None)
        else:
            h, rep, ok = _alive(words, level, length, None)
        _, ok = _fresh(words, k, t, ok)
        marked = np.zeros(len(h), bool)
        marked[rep[ok]] = True
        at = np.flatnonzero(marked)
        rows = words.row[at]
        place = at - words.first[rows]
        _, kind, count = np.unique(h[at], return_inverse=True, return_counts=True)
        again = count[kind] > 1
        one = ~again
        by, lists = _settled(rows[again], place[again])
        return _rows(k[rows[one]], t[rows[one]], place[one], h[at][one], np.zeros(int(one.sum()), np.uint64), k[by], t[by], lists, np.unique(h[at][again]))

    return run


def _long_windows(previous: int | None, length: int):
    """Candidate long windows, the first of each sequence in the slice, whose status others decide; the later ones are
    known to be repeats."""

    def run(part: pa.RecordBatch):
        words = W.split(part.column("text"))
        k, t = (part.column(c).to_numpy(zero_copy_only=False) for c in KEY)
        if previous:
            _, _, ok = _alive(words, previous, length, _places(part.column("places")))
        else:
            ok = W.inside(words, length)
        number, ok = _fresh(words, k, t, ok)
        at = np.flatnonzero(ok)
        one, two = (W.windows(W.hashes(words, i), length)[at] for i in (0, 1))
        rows = words.row[at]
        place = at - words.first[rows]
        doc = number[rows]
        order = np.lexsort((place, doc, two, one))
        new = np.concatenate([[True], (np.diff(one[order]) != 0) | (np.diff(two[order]) != 0)])[: len(order)]
        first = np.flatnonzero(new)[np.cumsum(new) - 1]
        keep, known = np.sort(order[new]), np.sort(order[first != np.arange(len(order))])
        by, lists = _settled(rows[known], place[known])
        return _rows(k[rows[keep]], t[rows[keep]], place[keep], one[keep], two[keep], k[by], t[by], lists, np.zeros(0, np.uint64))

    return run


def copies(base: DataFrame) -> DataFrame:
    """k, t, copy: documents whose whole text is that of a document with a smaller id; each of their windows starts
    earlier, and none of them starts earlier than that document's. The largest groups of copies (HOT_GROUPS, which bounds
    the broadcast) are known to every task, and their rows are dealt out by id instead of meeting in one place."""
    prints = base.select(*KEY, F.xxhash64(F.lit(1), "text").alias("u"))  # t and u: 128 bits of the text
    groups = prints.groupBy("t", "u").agg(F.min("k").alias("m"), F.max("k").alias("x"), F.count("*").alias("n")).filter("x > m")
    hot = groups.orderBy(F.desc("n"), "t", "u").limit(HOT_GROUPS).select("t", "u", F.col("m").alias("least"))
    dealt = prints.join(F.broadcast(hot), ["t", "u"], "left").withColumn("j", F.when(F.col("least").isNull(), F.col("t")).otherwise(F.xxhash64("k")))
    met = dealt.join(groups.select(F.col("t").alias("j"), "u", "m"), ["j", "u"], "left")
    return met.filter(F.col("k") > F.coalesce("least", "m")).select(*KEY, F.lit(True).alias("copy")).distinct()


def _listed(flagged: DataFrame) -> DataFrame:
    """k, t, places of the flagged windows: a set a document, combined before the exchange."""
    each = flagged.select(*KEY, F.explode(F.coalesce("known", F.array("place"))).alias("place"))
    return each.groupBy(*KEY).agg(F.collect_set("place").alias("places"))


def repeated_places(base: DataFrame, min_words: int = 20, start_words: int = 5) -> DataFrame:
    """k, t, places: starts of the windows of min_words words whose sequence also starts earlier, by document."""
    levels = [start_words]
    while levels[-1] * 2 <= min_words:
        levels.append(levels[-1] * 2)
    if start_words < 1 or levels[-1] != min_words:
        raise ValueError("min_words must be start_words times a power of two")
    base = base.join(copies(base), KEY, "left_anti")  # whole copies are settled
    given, previous = base, None
    for level in levels[:-1]:
        found = W.mapped(given, _candidates(level, previous, min_words), FOUND)
        meet = Window.partitionBy("h")
        # rows that repeat a document repeat its places: a hash has occurred twice if its least and greatest place differ
        spot = F.struct(*KEY, "place")
        met = found.withColumns({"low": F.min(spot).over(meet), "high": F.max(spot).over(meet)})
        alive = met.filter(F.col("k").isNotNull() & (F.col("known").isNotNull() | (F.col("low") < F.col("high"))))
        given, previous = base.join(_listed(alive), KEY), level
    found = W.mapped(given, _long_windows(previous, min_words), FOUND, most=8 << 20)
    spot = F.struct(*KEY, "place")
    least = F.min(spot).over(Window.partitionBy("h", "g"))
    return _listed(found.withColumn("least", least).filter(F.col("known").isNotNull() | (spot > F.col("least"))))


def _covered(words: W.Words, listed: list[np.ndarray | None], length: int) -> np.ndarray:
    """Which words a listed window covers."""
    change = np.zeros(len(words.start) + 1, np.int64)
    for row, places in enumerate(listed):
        if places is not None:
            at = words.first[row] + places
            np.add.at(change, at, 1)
            np.add.at(change, at + length, -1)
    return np.cumsum(change[:-1]) > 0


def _kept(length: int, with_text: bool):
    def run(part: pa.RecordBatch):
        words = W.split(part.column("text"))
        whole_copy = W.pc.fill_null(part.column("copy"), False).to_numpy(zero_copy_only=False) & (np.diff(words.first) >= length)
        gone = _covered(words, _places(part.column("places")), length) | whole_copy[words.row]
        whole = words.buf.tobytes()
        n, removed, digests, texts = [], [], [], []
        for row in range(part.num_rows):
            a, b = words.first[row], words.first[row + 1]
            keep = np.flatnonzero(~gone[a:b]) + a
            text = b" ".join([whole[x:y] for x, y in zip(words.start[keep].tolist(), words.end[keep].tolist(), strict=True)])
            n.append(int(b - a)), removed.append(int(b - a - len(keep)))
            if with_text:
                texts.append(text.decode())
            else:
                digests.append(hashlib.sha256(text).hexdigest())
        ids = pa.array([None if k == shared.NO_ID else k for k in part.column("k").to_pylist()], pa.int64())
        arrays = [ids, pa.array(n, pa.int64()), pa.array(removed, pa.int64()), pa.array(texts if with_text else digests, pa.string())]
        if with_text:
            return pa.RecordBatch.from_arrays([part.column("k"), part.column("t"), *arrays[1:]], names=["k", "t", "n_words", "n_removed", "kept_text"])
        return pa.RecordBatch.from_arrays(arrays, names=["doc_id", "n_words", "n_removed", "kept_sha256"])

    return run


def digest(docs: DataFrame, min_words: int = 20, start_words: int = 5) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256 (of the kept words joined by one space)."""
    base = keyed(docs)
    marked = base.join(repeated_places(base, min_words, start_words), KEY, "left").join(copies(base), KEY, "left")
    return W.mapped(marked, _kept(min_words, False), RESULT)


def rewritten(docs: DataFrame, min_words: int = 20, start_words: int = 5) -> DataFrame:
    """docs with text replaced by its kept words, joined by one space, where something was removed; all columns stay.
    Null texts become empty texts."""
    names = docs.columns
    base = keyed(docs, True)
    kept = _kept(min_words, True)

    def run(part: pa.RecordBatch):
        told, rest = kept(part), part.column("rest") if "rest" in part.schema.names else pa.array([], pa.struct([]))
        changed = W.pc.greater(told.column("n_removed"), 0)
        own = {"text": W.pc.if_else(changed, told.column("kept_text"), part.column("text").cast(pa.string()))}
        own |= {f.name: rest.field(i) for i, f in enumerate(rest.type)}
        return pa.RecordBatch.from_arrays([own[c] for c in names], names=names)

    marked = base.join(repeated_places(base, min_words, start_words), KEY, "left").join(copies(base), KEY, "left")
    return W.mapped(marked, run, docs.schema)


def op10_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digest(shared.table(spark, sf_dir, "documents"))
