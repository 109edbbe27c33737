"""Exact top-k inner products by Fagin's threshold algorithm over sorted lists, in blocks.

Candidates are cut into blocks. A block keeps one list per dimension, sorted by its component; lists are sorted once,
and the queries stream past them. A query reads all lists from their better end in rounds of doubled depth, scores in
full each candidate at its first sight, and stops once the bound (the best score that a candidate not yet seen could
have, from the components last read) is below its k-th score; at equality it goes on, for ties count. Candidates that no
list has shown are never scored. The k best of each block are merged by rank.

Defined cases: vectors that are null, empty or hold a null or non-finite component take no part, nor do rows with a
null id; a shorter vector counts as padded with zeros (a very long one pads all others of its block); rows that share a
query's id are its own and no candidates; repeated candidate rows are candidates each; a repeated query is answered
once, unless its vectors differ (then once each); fewer than k candidates are all returned; an empty table gives no
rows; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sitesieve.llm import shared

FOUND = "query_id bigint, query_key bigint, vec_id bigint, score bigint"


def _matrix(lists: pa.ListArray) -> np.ndarray:
    sizes = pc.list_value_length(lists).to_numpy(zero_copy_only=False).astype(np.int64)
    out = np.zeros((len(sizes), int(sizes.max(initial=0))), np.int64)
    rows = np.repeat(np.arange(len(sizes)), sizes)
    out[rows, np.arange(len(rows)) - (np.cumsum(sizes) - sizes)[rows]] = lists.flatten().to_numpy(zero_copy_only=False)
    return out


class Lists:
    """A block of candidates with its list per dimension. scored: how many inner products were made."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray) -> None:
        by = np.argsort(ids, kind="stable")
        self.ids, self.vectors, self.scored = ids[by], vectors[by], 0
        self.wide = self.vectors.astype(np.float64)
        self.largest = np.abs(self.wide).max(axis=0, initial=0)
        self.order = np.argsort(self.vectors, axis=0, kind="stable").T.astype(np.int32)  # ascending, a row per dimension
        self.values = np.take_along_axis(self.vectors.T, self.order, axis=1).astype(np.float64)

    def best(self, query_id: int, q: np.ndarray, k: int, begin: int = 16) -> tuple[np.ndarray, np.ndarray]:
        """Ids and scores of the k best, ties to smaller ids."""
        n, d = len(self.ids), self.vectors.shape[1]
        q, beyond = np.pad(q[:d], (0, max(0, d - len(q)))), q[d:]  # beyond: where all candidates are zero
        up, down = np.flatnonzero(q > 0), np.flatnonzero(q < 0)
        wide = q.astype(np.float64)
        exact = float(np.abs(wide) @ self.largest) < 2.0**53  # then doubles are exact
        unseen = np.ones(n, bool)
        unseen[np.searchsorted(self.ids, query_id) : np.searchsorted(self.ids, query_id, "right")] = False
        rows, scores, depth, read = np.zeros(0, np.int64), np.zeros(0, np.int64), min(max(begin, k), n), 0
        if not len(up) + len(down):  # every score is 0: the lists say nothing
            rows = np.flatnonzero(unseen)[:k]
            return self.ids[rows], np.zeros(len(rows), np.int64)
        while True:
            shown = np.concatenate([self.order[up, n - depth : n - read].ravel(), self.order[down, read:depth].ravel()])
            fresh = np.zeros(n, bool)
            fresh[shown] = True
            fresh = np.flatnonzero(fresh & unseen)
            unseen[fresh] = False
            self.scored += len(fresh)
            rows = np.concatenate([rows, fresh])
            scores = np.concatenate([scores, (self.wide[fresh] @ wide).astype(np.int64) if exact else self.vectors[fresh] @ q])
            rows, scores = _top(rows, scores, k)
            if depth == n:
                break
            bound = wide[up] @ self.values[up, n - depth] + wide[down] @ self.values[down, depth - 1]
            if len(rows) == k and scores.min() > bound:
                break
            read, depth = depth, min(n, depth * 2)
        return self.ids[rows], scores


def _top(rows: np.ndarray, scores: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The k best of rows by score, then by row (rows stand in the order of their ids)."""
    if len(rows) > 4 * k:
        good = scores >= np.partition(scores, len(rows) - k)[len(rows) - k]
        rows, scores = rows[good], scores[good]
    by = np.lexsort((rows, -scores))[:k]
    return rows[by], scores[by]


def _stacked(parts: list[np.ndarray]) -> np.ndarray:
    d = max(x.shape[1] for x in parts)
    return np.concatenate([np.pad(x, ((0, 0), (0, d - x.shape[1]))) for x in parts])


def _met(k: int):
    """For rows sorted by block, a block's candidates before its queries: the k best of the block for each query."""

    def run(batches):
        block, ids, vectors, lists = None, [], [], None
        for batch in batches:
            of, is_query, vec_id, key, v = (batch.column(c) for c in ("block", "is_query", "vec_id", "key", "v"))
            of, is_query, vec_id, key = (x.to_numpy(zero_copy_only=False) for x in (of, is_query, vec_id, key))
            cuts = [0, *(np.flatnonzero((of[1:] != of[:-1]) | (is_query[1:] != is_query[:-1])) + 1).tolist(), len(of)]
            for a, b in zip(cuts, cuts[1:], strict=False):
                if b == a:
                    continue
                if of[a] != block:
                    block, ids, vectors, lists = of[a], [], [], None
                x = _matrix(v.slice(a, b - a))
                if not is_query[a]:
                    ids.append(vec_id[a:b]), vectors.append(x)
                    continue
                if not ids:
                    continue
                lists = lists or Lists(np.concatenate(ids), _stacked(vectors))
                ids_of, scores_of, n = [], [], []
                for i, q in zip(vec_id[a:b].tolist(), x, strict=True):
                    found, scores = lists.best(i, q, k)
                    ids_of.append(found), scores_of.append(scores), n.append(len(found))
                yield pa.RecordBatch.from_arrays([pa.array(y) for y in (np.repeat(vec_id[a:b], n), np.repeat(key[a:b], n), np.concatenate(ids_of), np.concatenate(scores_of))], names=[y.split()[0] for y in FOUND.split(", ")])

    return run


def search(queries: DataFrame, candidates: DataFrame, k: int = 20, block: int = 8192) -> DataFrame:
    """query_id, rank, vec_id, score: for each query (vec_id, v) its k best candidates (vec_id, v), v array<bigint>."""
    queries = queries.withColumn("key", F.xxhash64("v")).dropDuplicates(["vec_id", "key"])
    n = max(1, -(-candidates.count() // block))
    dealt = F.pmod(F.xxhash64("vec_id", "v", F.spark_partition_id(), F.monotonically_increasing_id()), F.lit(n))  # repeats are dealt too
    left = candidates.select(dealt.cast("int").alias("block"), F.lit(False).alias("is_query"), "vec_id", F.lit(0).cast("bigint").alias("key"), "v")
    right = queries.select(F.explode(F.sequence(F.lit(0), F.lit(n - 1))).alias("block"), F.lit(True).alias("is_query"), "vec_id", "key", "v")
    both = left.unionByName(right).repartition(n, "block").sortWithinPartitions("block", "is_query")
    found = both.mapInArrow(_met(k), FOUND)
    ranked = found.withColumn("rank", F.row_number().over(Window.partitionBy("query_id", "query_key").orderBy(F.desc("score"), "vec_id")))
    return ranked.filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def scaled(embeddings: DataFrame, scale: int = 64) -> DataFrame:
    """vec_id, v: usable rows with components floor(scale * x), in double arithmetic."""
    v = F.col("embedding").cast("array<double>")
    usable = F.forall("d", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    rows = embeddings.select(F.col("vec_id").cast("bigint").alias("vec_id"), v.alias("d")).filter(F.col("vec_id").isNotNull() & (F.size("d") > 0) & usable)
    return rows.select("vec_id", F.transform("d", lambda x: F.floor(x * scale)).cast("array<bigint>").alias("v"))


def op1_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = scaled(shared.table(spark, sf_dir, "embeddings"))
    return search(rows.filter("vec_id % 20 = 0"), rows, 20)


ORACLE_SQL = """
with v as (select vec_id, list_transform(embedding, lambda x: cast(floor(64 * cast(x as double)) as bigint)) as v from embeddings
  where vec_id is not null and embedding is not null and len(embedding) > 0
  and len(list_filter(embedding, lambda x: x is null or isnan(x) or isinf(x))) = 0),
s as (select q.vec_id as query_id, c.vec_id, cast(list_sum(list_transform(list_zip(q.v, c.v), lambda z: z[1] * z[2])) as bigint) as score
  from v q join v c on q.vec_id % 20 = 0 and q.vec_id <> c.vec_id),
r as (select *, cast(row_number() over (partition by query_id order by score desc, vec_id) as integer) as rank from s)
select query_id, rank, vec_id, score from r where rank <= 20"""
