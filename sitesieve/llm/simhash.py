"""SimHash near-duplicates: 64-bit fingerprints, exact comparison in tiles, components in Spark.

Fingerprints are compared exactly, all with all, in tiles: numpy exclusive-or and bit counts. Tiles hold fingerprints
of equal population counts in both halves; a pair of tiles is skipped if these counts differ by more than the radius
in all, for then no pair in it can be within the radius. Equal fingerprints are one row, and a pair of tiles returns
no pairs but the edges of a spanning forest of the links found, so a group of n near copies gives O(n) rows.
Components come from alternating large-star and small-star steps over these edges.

Defined cases: null and empty texts have fingerprint zero, which links like any other; a text of fewer words than a
shingle is one shingle; a null doc_id orders before all others (its component shows null); repeated rows give a row
each; an empty table gives no rows; very long texts are read whole, a slice each; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sitesieve.llm import shared
from sitesieve.llm import words as W

#: Fingerprints of a tile at most; larger cells are split.
TILE = 1 << 16


def _fingerprints(shingle: int, seed: int):
    def run(part: pa.RecordBatch):
        words = W.split(part.column("text"), lower=True)
        size = words.end - words.start
        begin = np.concatenate([[0], np.cumsum(size + 1)])  # in the words joined by single spaces
        joined = np.full(int(begin[-1]), 0x20, np.uint8)
        whole = np.zeros(len(words.buf) + 1, np.int8)
        np.add.at(whole, words.start, 1)
        np.add.at(whole, words.end, -1)
        letters = np.flatnonzero(np.cumsum(whole[:-1]))
        joined[letters + np.repeat(begin[:-1] - words.start, size)] = words.buf[letters]
        counts = np.diff(words.first)
        n = np.where(counts == 0, 0, np.maximum(counts - shingle + 1, 1))
        rows = np.repeat(np.arange(len(counts)), n)
        at = words.first[rows] + (np.arange(len(rows)) - (np.cumsum(n) - n)[rows])
        last = np.minimum(at + shingle, words.first[rows + 1]) - 1
        h = W.xxh64(joined, begin[at], begin[last] + size[last], seed)
        out = np.zeros(len(counts), np.uint64)
        full = np.flatnonzero(n)
        if len(full):
            starts = (np.cumsum(n) - n)[full]
            for bit in range(64):
                ones = np.add.reduceat(((h >> np.uint64(bit)) & np.uint64(1)).astype(np.int32), starts)
                out[full] |= (2 * ones > n[full]).astype(np.uint64) << np.uint64(bit)
        rest = [c for c in part.schema.names if c != "text"]
        return pa.RecordBatch.from_arrays([*map(part.column, rest), pa.array(out.view(np.int64))], names=[*rest, "f"])

    return run


def fingerprints(docs: DataFrame, shingle: int = 3, seed: int = 42) -> DataFrame:
    """k (the id, NO_ID for null), f (the fingerprint as a signed 64-bit number)."""
    given = docs.select(F.coalesce(F.col("doc_id").cast("bigint"), F.lit(shared.NO_ID)).alias("k"), F.col("text"))
    return W.mapped(given, _fingerprints(shingle, seed), "k bigint, f bigint")


def _forest(a: np.ndarray, b: np.ndarray) -> list[np.ndarray]:
    """Links of a spanning forest of the pairs (a, b): every member with the least of its component."""
    nodes, inverse = np.unique(np.concatenate([a, b]), return_inverse=True)
    x, y = inverse[: len(a)], inverse[len(a) :]
    root = np.arange(len(nodes))
    while True:
        before = root.copy()
        least = np.minimum(root[x], root[y])
        np.minimum.at(root, root[x], least)
        np.minimum.at(root, root[y], least)
        root = root[root]
        if np.array_equal(before, root):
            break
    moved = root != np.arange(len(nodes))
    return [nodes[root[moved]], nodes[moved]]


def _compared(radius: int, block: int = 1 << 20):
    """For each row with tiles x and y: forest edges of the pairs within the radius."""

    def run(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                x, y = (np.asarray(batch.column(c)[i].values.to_numpy(zero_copy_only=False), np.int64) for c in ("x", "y"))
                p, q = x.view(np.uint64), y.view(np.uint64)
                found: list[np.ndarray] = [np.zeros(0, np.int64)] * 2
                step = max(1, block // max(1, len(q)))
                for s in range(0, len(p), step):
                    near = np.bitwise_count(p[s : s + step, None] ^ q[None, :]) <= radius
                    r, c = np.nonzero(near)
                    if len(r):
                        a, b = x[s + r], y[c]
                        other = a != b
                        found = _forest(np.concatenate([found[0], a[other]]), np.concatenate([found[1], b[other]]))
                if len(found[0]):
                    yield pa.RecordBatch.from_arrays([pa.array(v) for v in found], names=["a", "b"])

    return run


def links(prints: DataFrame, radius: int = 3, tile: int = TILE) -> DataFrame:
    """a, b: forest edges of the links between the distinct values of f."""
    spark = prints.sparkSession
    low = F.lit((1 << 32) - 1).cast("bigint")
    cells = prints.select("f", F.bit_count(F.shiftrightunsigned("f", 32)).alias("hi"), F.bit_count(F.col("f").bitwiseAND(low)).alias("lo"))
    sizes = cells.groupBy("hi", "lo").agg(F.ceil(F.count("*") / tile).alias("parts"))  # 33 x 33 cells at most
    split = cells.join(F.broadcast(sizes), ["hi", "lo"]).withColumn("sub", F.pmod(F.xxhash64("f"), F.col("parts")))
    tiles = shared.cut(split.groupBy("hi", "lo", "sub").agg(F.collect_list("f").alias("x")))
    # pairs of tiles by their numbers alone; the arrays come by joins on a tile's number, so that no cell is hot
    named = tiles.select(F.struct("hi", "lo", "sub").alias("n"), "hi", "lo")
    steps = [(h, low) for h in range(-radius, radius + 1) for low in range(-radius, radius + 1) if abs(h) + abs(low) <= radius]
    offsets = F.array(*[F.struct(F.lit(h).alias("dh"), F.lit(low).alias("dl")) for h, low in steps])
    left = named.select("n", "hi", "lo", F.explode(offsets).alias("o")).select(F.col("n").alias("p"), (F.col("hi") + F.col("o.dh")).alias("hi"), (F.col("lo") + F.col("o.dl")).alias("lo"))
    pairs = left.join(named.withColumnRenamed("n", "q"), ["hi", "lo"]).filter("p <= q").select("p", "q")
    x, y = (tiles.select(F.struct("hi", "lo", "sub").alias(n), F.col("x").alias(c)) for n, c in (("p", "x"), ("q", "y")))
    width = int(spark.conf.get("spark.sql.shuffle.partitions"))
    both = pairs.join(x, "p").join(y, "q").select("x", "y", "p", "q").repartition(4 * width, "p", "q")
    return both.select("x", "y").mapInArrow(W.released(_compared(radius)), "a bigint, b bigint")


def components(edges: DataFrame, most_rounds: int = 50) -> DataFrame:
    """node, root for every node of the edges (a, b), root being the least node of its component."""
    edges, folder = shared.kept(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a <> b").distinct())
    before = None
    for _ in range(most_rounds):
        both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).filter("a <> b").distinct()
        down = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(down, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).union(down.select("a", F.col("m").alias("b"))).filter("a <> b").distinct()
        read = folder
        edges, folder = shared.kept(small)
        shared.discard(read)
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == before:
            break
        before = now
    else:
        raise RuntimeError("the components did not settle")
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))


def keyed(docs: DataFrame) -> DataFrame:
    """k, t (a document's identity: its id, NO_ID for null, and a hash of its text), text and, in the struct rest, all
    other columns."""
    return docs.select(F.coalesce(F.col("doc_id").cast("bigint"), F.lit(shared.NO_ID)).alias("k"), F.xxhash64("text").alias("t"), "text", *shared.rest_of(docs, "text"))


def representatives(docs: DataFrame, shingle: int = 3, seed: int = 42, radius: int = 3) -> DataFrame:
    """k, t: the least document of each component, by id and then by the hash of its text."""
    prints = W.mapped(keyed(docs).select("k", "t", "text"), _fingerprints(shingle, seed), "k bigint, t bigint, f bigint")
    distinct = shared.cut(prints.groupBy("f").agg(F.min(F.struct("k", "t")).alias("least")))
    roots = components(links(distinct.select("f"), radius))
    placed = distinct.join(roots, F.col("f") == F.col("node"), "left").select("least", F.coalesce("root", "f").alias("root"))
    return placed.groupBy("root").agg(F.min("least").alias("least")).select("least.*")


def first_of_each(docs: DataFrame, shingle: int = 3, seed: int = 42, radius: int = 3) -> DataFrame:
    """docs without all but the least document of each component, and without rows that repeat an id and its text."""
    key = ["k", "t"]
    # joined and made distinct by one key, so that texts have one exchange for both
    one = keyed(docs).join(representatives(docs, shingle, seed, radius), key, "left_semi").dropDuplicates(key)
    return one.select(*["text" if c == "text" else F.col(f"rest.`{c}`").alias(c) for c in docs.columns])


def near_duplicates(docs: DataFrame, shingle: int = 3, seed: int = 42, radius: int = 3) -> DataFrame:
    """doc_id, fingerprint (16 hex digits), component_id (the smallest doc_id reachable by links)."""
    prints = shared.cut(fingerprints(docs, shingle, seed))
    distinct = prints.groupBy("f").agg(F.min("k").alias("k"))
    roots = components(links(distinct.select("f"), radius))
    placed = distinct.join(roots, F.col("f") == F.col("node"), "left").select("f", "k", F.coalesce("root", "f").alias("root"))
    least = placed.groupBy("root").agg(F.min("k").alias("component_id"))
    by_print = placed.join(least, "root").select("f", "component_id")
    shown = lambda c: F.when(F.col(c) != shared.NO_ID, F.col(c))
    return prints.join(by_print, "f").select(shown("k").alias("doc_id"), F.lower(F.lpad(F.hex("f"), 16, "0")).alias("fingerprint"), shown("component_id").alias("component_id"))


def op5_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(shared.table(spark, sf_dir, "documents"))
