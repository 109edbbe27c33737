"""Language-model scoring: an interpolated modified Kneser-Ney bigram model, counted in Spark over whole texts.

Each slice of the training texts gives its distinct word pairs with counts, packed into sorted blobs by bucket; a
bucket is a range of the context's hash, so that a context's statistics are made where its pairs are. Contexts that
make up more than one token in a thousand are spread over all buckets by the pair's hash, and their statistics are
summed. A bucket's pairs become a file of sorted hashes with counts, its contexts another; the words' counts and
continuation counts go through one more exchange into files of their own. Workers map these files into memory and
score texts by binary search: nothing of the model goes through the driver but its totals.

The files stand in the shared folder of spark.checkpoint.dir (or `model_dir`), which must be mounted at the executors:
memory-mapping needs a file system path. Each is written under another name first and then renamed, so tasks can be
run again. Every bucket has its files, be they empty: one that a worker does not find is an error, never "no counts".
A worker holds at most OPEN files mapped and lets go of the one used longest ago.

Defined cases: null and empty texts are the end token alone; with no training text all counts are 0, the base score is
0 for each token and the model is uniform over one word; a null doc_id counts as the empty text for the fold; repeated
rows count and are scored each; an empty table gives no rows; very long texts are read whole, a slice each; other
columns are ignored.
"""

from __future__ import annotations

import mmap
import os
import sys
import uuid
from collections import OrderedDict
from typing import NamedTuple
from urllib.parse import urlparse

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sitesieve.llm import shared
from sitesieve.llm import words as W

START, END = np.uint64(0x243F6A8885A308D3), np.uint64(0x13198A2E03707344)
#: A context with more than this share of all tokens is spread over the buckets.
HOT = 1 / 1000
#: Bytes of training text per bucket, on average.
BUCKET_BYTES = 16 << 20
#: Files mapped at once by a worker: where a map needs no descriptor of its own, far more.
OPEN = 8192 if sys.version_info >= (3, 13) else 256


class Sequences(NamedTuple):
    """Tokens (words and ends) of a slice with the context before each, and their rows."""

    context: np.ndarray
    token: np.ndarray
    row: np.ndarray


def sequences(texts: pa.Array) -> Sequences:
    w = W.split(texts, lower=True)
    n = np.diff(w.first) + 1
    row = np.repeat(np.arange(len(n)), n)
    token = np.full(len(row), END)
    token[np.arange(len(w.start)) + w.row] = W.hashes(w)
    context = np.empty_like(token)
    context[1:] = token[:-1]
    context[np.cumsum(n) - n] = START
    return Sequences(context, token, row)


def pair(context: np.ndarray, token: np.ndarray) -> np.ndarray:
    return W.mix(context * np.uint64(0xD6E8FEB86659FD93) + token)


def ranged(h: np.ndarray, buckets: int) -> np.ndarray:
    """The bucket of a hash: ranges of equal width, so that buckets in order are the sorted whole."""
    return ((h >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int32)


def placed(context: np.ndarray, key: np.ndarray, hot: np.ndarray, buckets: int) -> np.ndarray:
    """The bucket of each pair: its context's, or its own if the context is hot (hot is sorted)."""
    out = ranged(context, buckets)
    if len(hot):
        at = np.minimum(np.searchsorted(hot, context), len(hot) - 1)
        spread = hot[at] == context
        out[spread] = ranged(key[spread], buckets)
    return out


def planes(values: np.ndarray) -> bytes:
    """Bytes of an integer array, all first bytes first: high bytes of small numbers are runs of zeros."""
    return values.view(np.uint8).reshape(len(values), -1).T.tobytes()


def unplaned(data: bytes, kind) -> np.ndarray:
    width = np.dtype(kind).itemsize
    return np.frombuffer(data, np.uint8).reshape(width, -1).T.copy().view(kind).ravel()


def _sorted(h: np.ndarray) -> bytes:
    return planes(np.diff(h, prepend=np.uint64(0)))


def _unsorted(data: bytes) -> np.ndarray:
    return np.cumsum(unplaned(data, np.uint64), dtype=np.uint64)


def _summed(key: np.ndarray, *values: np.ndarray) -> tuple[np.ndarray, ...]:
    """Distinct keys in order, the place of the first of each, and sums of values by key."""
    order = np.argsort(key, kind="stable")
    k = key[order]
    first = np.flatnonzero(np.concatenate([[True], k[1:] != k[:-1]])) if len(k) else np.zeros(0, np.int64)
    return k[first], order[first], *(np.add.reduceat(v[order], first) if len(k) else v[:0] for v in values)


def _spans(values: np.ndarray) -> list[tuple[int, int]]:
    """Begin and end of each run of equal values."""
    if not len(values):
        return []
    cuts = np.flatnonzero(np.concatenate([[True], values[1:] != values[:-1], [True]])).tolist()
    return list(zip(cuts, cuts[1:], strict=False))


def frequent(docs: DataFrame) -> tuple[int, np.ndarray]:
    """Bytes of all texts, and the hashes of hot contexts. A hot one is hot by half in some slice at least."""

    def run(part: pa.RecordBatch):
        s = sequences(part.column("text"))
        h, n = np.unique(s.context, return_counts=True)
        often = n * 2 >= HOT * len(s.context)
        size = int(W.buffers(part.column("text"))[1][-1])
        return pa.RecordBatch.from_arrays([pa.array(np.append(h[often].view(np.int64), 0)), pa.array(np.append(n[often], len(s.context))), pa.array(np.append(np.zeros(int(often.sum()), np.int64), size))], names=["h", "n", "size"])

    found = W.mapped(docs.select("text"), run, "h bigint, n bigint, size bigint").groupBy("h").agg(F.sum("n").alias("n"), F.sum("size").alias("size"))
    found = shared.cut(found)
    total = found.filter("size > 0 or h = 0").agg(F.sum("n"), F.sum("size")).first()
    if not total[0]:
        return 0, np.zeros(0, np.uint64)
    hot = found.filter((F.col("h") != 0) & (F.col("n") >= HOT * total[0])).select("h").toArrow()  # 1 / HOT rows at most
    return int(total[1]), np.sort(hot["h"].to_numpy().view(np.uint64))


def _write(path: str, key: np.ndarray, values: np.ndarray) -> None:
    """A file of keys and their values: the number of keys, the width of a value in bytes, the keys, the values."""
    temporary = f"{path}.{uuid.uuid4().hex}"
    with open(temporary, "wb") as f:
        f.write(np.array([len(key), values.itemsize], "<u8").tobytes())
        f.write(np.ascontiguousarray(key, "<u8"))
        f.write(np.ascontiguousarray(values))
    os.replace(temporary, path)


def _mapped(path: str) -> tuple[np.ndarray, np.ndarray]:
    with open(path, "rb") as f:
        data = mmap.mmap(f.fileno(), 0, access=mmap.ACCESS_READ, **({"trackfd": False} if sys.version_info >= (3, 13) else {}))
    n, width = np.frombuffer(data, "<u8", 2).tolist()
    return np.frombuffer(data, "<u8", n, 16), np.frombuffer(data, f"<u{width}", -1, 16 + 8 * n)


def _pairs_of_slices(hot: np.ndarray, buckets: int):
    def run(part: pa.RecordBatch):
        s = sequences(part.column("text"))
        key, at, n = _summed(pair(s.context, s.token), np.ones(len(s.token), np.uint32))
        context, token = s.context[at], s.token[at]
        bucket = placed(context, key, hot, buckets)
        order = np.lexsort((context, bucket))
        context, token, n, bucket = context[order], token[order], n[order].astype(np.uint32), bucket[order]
        rows = _spans(bucket)
        return pa.RecordBatch.from_arrays([pa.array(bucket[[a for a, _ in rows]].astype(np.int32)), *(pa.array([f(v[a:b]) for a, b in rows], pa.binary()) for f, v in ((_sorted, context), (planes, token), (planes, n)))], names=["bucket", "c", "t", "n"])

    return run


def _classes(n: np.ndarray) -> list[int]:
    return [int(np.count_nonzero(n == i)) for i in (1, 2, 3, 4)]


SUMS = "kind string, bucket int, a binary, b binary, c binary, n1 bigint, n2 bigint, n3 bigint, n4 bigint, total bigint, h bigint"
_NAMES = [x.split()[0] for x in SUMS.split(", ")]


def _pairs_of_bucket(folder: str, hot: np.ndarray, buckets: int):
    """Writes a bucket's pairs and contexts; returns words' counts by their bucket, hot contexts and count classes."""

    def run(given: pa.Table) -> pa.Table:
        bucket = given["bucket"][0].as_py()
        context = np.concatenate([_unsorted(x) for x in given["c"].to_pylist()])
        token = np.concatenate([unplaned(x, np.uint64) for x in given["t"].to_pylist()])
        n = np.concatenate([unplaned(x, np.uint32) for x in given["n"].to_pylist()]).astype(np.int64)  # the bucket's own row is empty
        key, at, n = _summed(pair(context, token), n)
        context, token = context[at], token[at]
        _write(f"{folder}/pairs-{bucket:06d}", key, np.minimum(n, 0xFFFFFFFF).astype(np.uint32))
        who, _, total, ones, twos, more = _summed(context, n, (n == 1).astype(np.int64), (n == 2).astype(np.int64), (n > 2).astype(np.int64))
        spread = np.isin(who, hot)
        own = ~spread
        _write(f"{folder}/contexts-{bucket:06d}", who[own], np.stack([total[own], ones[own], twos[own], more[own]], axis=1))
        rows = [("classes", bucket, None, None, None, *_classes(n), int(n.sum()), 0)]
        rows += [("hot", bucket, None, None, None, *(int(x) for x in v[:3]), 0, int(v[3]), int(h)) for h, v in zip(who[spread].view(np.int64), np.stack([ones[spread], twos[spread], more[spread], total[spread]], axis=1), strict=True)]
        word, _, count, follows = _summed(token, n, np.ones(len(n), np.int64))
        to = ranged(word, buckets)
        rows.append(("words", bucket, b"", b"", b"", 0, 0, 0, 0, 0, 0))
        for a, b in _spans(to):
            rows.append(("words", int(to[a]), _sorted(word[a:b]), planes(count[a:b]), planes(follows[a:b]), 0, 0, 0, 0, 0, 0))
        return pa.table({x: pa.array(v, t) for x, v, t in zip(_NAMES, zip(*rows, strict=True), _TYPES, strict=True)})

    return run


_TYPES = [pa.string(), pa.int32(), *[pa.binary()] * 3, *[pa.int64()] * 6]


def _words_of_bucket(folder: str):
    def run(given: pa.Table) -> pa.Table:
        bucket = given["bucket"][0].as_py()
        word = np.concatenate([_unsorted(x) for x in given["a"].to_pylist()])
        count, follows = (np.concatenate([unplaned(x, np.int64) for x in given[c].to_pylist()]) for c in ("b", "c"))
        word, _, count, follows = _summed(word, count, follows)
        _write(f"{folder}/words-{bucket:06d}", word, np.stack([count, follows], axis=1))
        return pa.table({"tokens": [int(count.sum())], "words": [len(word)], "follows": [int(follows.sum())], **{f"n{i + 1}": [x] for i, x in enumerate(_classes(follows))}, "more": [int(np.count_nonzero(follows > 2))]})

    return run


class Model(NamedTuple):
    folder: str
    buckets: int
    hot: np.ndarray
    hot_sums: np.ndarray  # total, ones, twos, more of each hot context
    discounts: np.ndarray
    word_discounts: np.ndarray
    tokens: int
    words: int
    follows: int
    word_gamma: float


def discounts(n1: int, n2: int, n3: int, n4: int) -> np.ndarray:
    """Discounts of counts 0 (none), 1, 2 and 3 or more; where count classes are empty, halves."""
    if not n1 or not n2:
        return np.array([0.0, 0.5, 0.5, 0.5])
    y = n1 / (n1 + 2 * n2)
    d2 = 2 - 3 * y * n3 / n2
    d3 = 3 - 4 * y * n4 / n3 if n3 else d2
    return np.array([0.0, *np.clip([1 - 2 * y * n2 / n1, d2, d3], 0.05, [0.95, 1.95, 2.95])])


def model_folder(spark: SparkSession, model_dir: str | None = None) -> str:
    named = urlparse(model_dir or shared.checkpoint_dir(spark))
    if named.scheme not in ("", "file"):
        raise ValueError("the model is memory-mapped: give a model_dir that executors have mounted")
    if model_dir is None:
        folder = urlparse(shared.folder(spark, "kneser-ney")).path  # goes when the program ends
    else:
        folder = f"{named.path.rstrip('/')}/kneser-ney-{uuid.uuid4().hex}"
    os.makedirs(folder)
    return folder


def trained(docs: DataFrame, model_dir: str | None = None, bucket_bytes: int = BUCKET_BYTES) -> Model:
    """A model of the texts of docs."""
    folder = model_folder(docs.sparkSession, model_dir)
    size, hot = frequent(docs)
    buckets = max(1, -(-size // bucket_bytes))
    blobs = W.mapped(docs.select("text"), _pairs_of_slices(hot, buckets), "bucket int, c binary, t binary, n binary", most=32 << 20)
    none = F.lit(b"")
    blobs = blobs.unionByName(docs.sparkSession.range(buckets).select(F.col("id").cast("int").alias("bucket"), none.alias("c"), none.alias("t"), none.alias("n")))
    sums = shared.cut(blobs.groupBy("bucket").applyInArrow(_pairs_of_bucket(folder, hot, buckets), SUMS))
    classes = sums.filter("kind = 'classes'").agg(*[F.coalesce(F.sum(f"n{i}"), F.lit(0)) for i in (1, 2, 3, 4)]).first()
    rows = sums.filter("kind = 'hot'").groupBy("h").agg(*[F.sum(c).alias(c) for c in ("total", "n1", "n2", "n3")]).collect()  # 1 / HOT at most
    by = {np.int64(r.h).view(np.uint64): (r.total, r.n1, r.n2, r.n3) for r in rows}
    hot_sums = np.array([by.get(h, (1, 0, 0, 0)) for h in hot], np.int64).reshape(-1, 4)
    words = sums.filter("kind = 'words'").select("bucket", "a", "b", "c").groupBy("bucket").applyInArrow(_words_of_bucket(folder), "tokens bigint, words bigint, follows bigint, n1 bigint, n2 bigint, n3 bigint, n4 bigint, more bigint")
    w = words.agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in words.columns]).first()
    d = discounts(w.n1, w.n2, w.n3, w.n4)
    gamma = (d[1] * w.n1 + d[2] * w.n2 + d[3] * w.more) / w.follows if w.follows else 1.0
    return Model(folder, buckets, hot, hot_sums, discounts(*classes), d, w.tokens, w.words, w.follows, gamma)


class Mapped:
    """A model's files, mapped into memory as they are asked for."""

    def __init__(self, model: Model) -> None:
        self.model, self.files = model, OrderedDict()

    def file(self, kind: str, bucket: int) -> tuple[np.ndarray, np.ndarray]:
        key = (kind, bucket)
        if key not in self.files:
            if len(self.files) >= OPEN:
                self.files.popitem(last=False)
            self.files[key] = _mapped(f"{self.model.folder}/{kind}-{bucket:06d}")  # FileNotFoundError: not mounted, or lost
        self.files.move_to_end(key)
        return self.files[key]

    def find(self, kind: str, key: np.ndarray, bucket: np.ndarray, width: int) -> np.ndarray:
        """Rows of values for keys, zero where there are none. Keys come sorted within buckets, buckets in order."""
        out = np.zeros((len(key), width), np.int64)
        for a, b in _spans(bucket):
            keys, values = self.file(kind, int(bucket[a]))
            if not len(keys):
                continue
            at = np.minimum(np.searchsorted(keys, key[a:b]), len(keys) - 1)
            hit = np.flatnonzero(keys[at] == key[a:b])
            out[a + hit] = values.reshape(-1, width)[at[hit]]
        return out

    def sums(self, texts: pa.Array) -> tuple[np.ndarray, ...]:
        """Per text: tokens, known tokens, base log score, model log score (both to base 10)."""
        m = self.model
        s = sequences(texts)
        n = len(texts)
        word, word_of = np.unique(s.token, return_inverse=True)
        counts = self.find("words", word, ranged(word, m.buckets), 2)
        base = np.log10((counts[:, 0] + 0.5) / (m.tokens + 0.5 * (m.words + 1)))
        low = m.word_gamma / (m.words + 1)
        if m.follows:
            low = low + np.maximum(counts[:, 1] - m.word_discounts[np.minimum(counts[:, 1], 3)], 0) / m.follows
        low = np.broadcast_to(low, len(word))
        who, who_of = np.unique(s.context, return_inverse=True)
        sums = self.find("contexts", who, ranged(who, m.buckets), 4)
        if len(m.hot):
            at = np.minimum(np.searchsorted(m.hot, who), len(m.hot) - 1)
            sums = np.where((m.hot[at] == who)[:, None], m.hot_sums[at], sums)
        gamma = np.where(sums[:, 0] > 0, sums[:, 1:] @ m.discounts[1:] / np.maximum(sums[:, 0], 1), 1.0)
        both, first, both_of = np.unique(pair(s.context, s.token), return_index=True, return_inverse=True)
        bucket = placed(s.context[first], both, m.hot, m.buckets)
        order = np.lexsort((both, bucket))
        seen = np.empty((len(both), 1), np.int64)
        seen[order] = self.find("pairs", both[order], bucket[order], 1)
        c = seen[:, 0]
        total = np.maximum(sums[who_of[first], 0], 1)
        p = np.maximum(c - m.discounts[np.minimum(c, 3)], 0) / total + gamma[who_of[first]] * low[word_of[first]]
        per = lambda x: np.bincount(s.row, weights=x, minlength=n)
        tokens = np.bincount(s.row, minlength=n)
        return tokens, per((counts[:, 0] > 0)[word_of]).astype(np.int64), per(base[word_of]), per(np.log10(p)[both_of])


def scored(docs: DataFrame, model: Model, most: int = 8 << 20) -> DataFrame:
    """doc_id, held_out (fold 1), n_tokens, n_known, train_tokens, base_score, score."""

    def run(batches):
        mapped = Mapped(model)
        for batch in batches:
            for part in W.slices(batch, most=most):
                tokens, known, base, score = mapped.sums(part.column("text"))
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(tokens.astype(np.int64)), pa.array(known), pa.array(np.full(len(known), model.tokens)), pa.array(base), pa.array(score)], names=["doc_id", "n_tokens", "n_known", "train_tokens", "base_score", "score"])

    given = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    out = given.mapInArrow(run, "doc_id bigint, n_tokens bigint, n_known bigint, train_tokens bigint, base_score double, score double")
    return out.select("doc_id", (shared.fold_of("doc_id") == 1).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")


def perplexity(scores: DataFrame) -> DataFrame:
    """scores with the model's perplexity of each text."""
    return scores.withColumn("perplexity", F.pow(F.lit(10.0), -F.col("score") / F.col("n_tokens")))


def op6_kneser_ney(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = shared.table(spark, sf_dir, "documents")
    return scored(docs, trained(docs.filter(shared.fold_of("doc_id") != 1)))
