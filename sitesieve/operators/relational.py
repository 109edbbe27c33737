"""Dataflow operators over DataFrames. Order is never implied: each takes the columns that define it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

Cols = list[str]


def spread(df: DataFrame) -> DataFrame:
    """The rows dealt evenly over a shuffle's number of tasks, for work on a row that its bytes do not tell of: files that
    compress well or have few row groups make few tasks, however many cores there are."""
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))


def keep_first(df: DataFrame, keys: Cols, order: list) -> DataFrame:
    """The first row of each key."""
    return df.withColumn("_rn", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).filter("_rn = 1").drop("_rn")


def union_prioritised(sources: list[DataFrame], ordinal: str = "source_ord") -> DataFrame:
    """UNION ALL of the sources with their place in the list of priorities."""
    out = None
    for i, df in enumerate(sources):
        df = df.withColumn(ordinal, F.lit(i))
        out = df if out is None else out.unionByName(df, allowMissingColumns=True)
    return out


def first_failed(checks: list[tuple[str, Column]], otherwise: Column | None = None) -> Column:
    """The name of the first check that holds; a null condition doesn't."""
    out = None
    for name, bad in checks:
        out = F.when(bad, F.lit(name)) if out is None else out.when(bad, F.lit(name))
    return out.otherwise(otherwise if otherwise is not None else F.lit(None).cast("string"))


def all_failed(checks: list[tuple[str, Column]]) -> Column:
    """Names of all checks that hold, in order."""
    return F.array_compact(F.array(*[F.when(bad, F.lit(name)) for name, bad in checks]))


def limited(df: DataFrame, n: int, order: list, partition: Cols | None = None, label: str = "place", kept: str = "KEPT", rest: str = "RESERVE") -> DataFrame:
    """All rows, the first n of each partition labelled kept and the others rest."""
    w = Window.partitionBy(*(partition or [F.lit(1)])).orderBy(*order)
    return df.withColumn(label, F.when(F.row_number().over(w) <= n, kept).otherwise(rest))


def overridden(base: DataFrame, other: DataFrame, on: Cols, columns: Cols) -> DataFrame:
    """LEFT JOIN in which the other side's non-empty values win."""
    side = other.select(*on, *[F.col(c).alias(f"_{c}") for c in columns])
    out = base.join(side, on, "left")
    return out.withColumns({c: F.coalesce(F.nullif(F.col(f"_{c}"), F.lit("")), F.col(c)) for c in columns}).drop(*[f"_{c}" for c in columns])


def peers(df: DataFrame, key: str, row: str) -> DataFrame:
    """row, peer: pairs of different rows of one key, from an equi self-join. Keys over the size of a few rows are
    for group_sizes(): pairs grow with the square of a group."""
    a, b = df.select(F.col(row).alias("row"), key), df.select(F.col(row).alias("peer"), key)
    return a.join(b, key).filter("row <> peer").select("row", "peer", key)


def group_sizes(df: DataFrame, key: str, row: str) -> DataFrame:
    """For each row the number of other rows with its key and the smallest row of the key."""
    sizes = df.groupBy(key).agg(F.count("*").alias("n"), F.min(row).alias("first_row")).filter("n > 1")
    return df.select(row, key).join(sizes, key).select(row, key, (F.col("n") - 1).alias("others"), "first_row")


def shortened(x: Column, edits: int) -> Column:
    """A string and all it becomes by leaving out up to `edits` characters: two strings within so many edits share one."""
    drop = lambda v: F.transform(F.filter(F.sequence(F.lit(1), F.greatest(F.length(v), F.lit(1))), lambda i: F.length(v) > 0), lambda i: F.concat(F.substring(v, F.lit(1), i - 1), F.substr(v, i + 1)))
    every = F.array(x)
    for _ in range(edits):
        every = F.array_distinct(F.concat(every, F.flatten(F.transform(every, drop))))
    return every


def near_strings(df: DataFrame, value: str, edits: int, on: Cols = []) -> DataFrame:  # noqa: B006
    """on, a, b: distinct values within `edits` edits of each other, a < b; an equi join on shortened() makes the pairs, so
    that only strings that may be near meet."""
    keys = df.select(*on, value).distinct().select(*on, value, F.explode(shortened(F.col(value), edits)).alias("_key"))
    a, b = keys.withColumnRenamed(value, "a"), keys.withColumnRenamed(value, "b")
    return a.join(b, [*on, "_key"]).filter("a < b").select(*on, "a", "b").distinct().filter(F.levenshtein("a", "b", edits) >= 0)


def near_rows(df: DataFrame, row: str, value: str, edits: int, on: Cols = [], size: int = 1000) -> DataFrame:  # noqa: B006
    """row, peer: pairs of rows, row < peer, whose values are equal or within `edits` edits. The result is quadratic in the
    rows of a value, so the work is too: rows of a value are dealt into lists of some `size` numbers, pairs of lists are the
    rows that are shuffled, evenly and in the end only, and a list is all that a task holds of a value."""
    known = df.select(*on, F.col(value).alias("a"), F.col(row).alias("id")).dropna()
    parts = known.groupBy(*on, "a").agg(F.ceil(F.count("*") / size).alias("parts"))
    part = F.pmod(F.xxhash64("id"), F.col("parts"))
    lists = known.join(parts, [*on, "a"]).groupBy(*on, "a", part.alias("part")).agg(F.collect_list("id").alias("ids"))
    sizes = parts.select(*on, "a", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("parts") - 1)).alias("part"))
    other = lambda x: x.select(*on, F.col("a").alias("b"), F.col("part").alias("peer_part"))
    near = near_strings(df, value, edits, on).join(sizes, [*on, "a"]).join(other(sizes), [*on, "b"])
    same = sizes.withColumn("b", F.col("a")).join(other(sizes), [*on, "b"]).filter("part <= peer_part")
    tiles = near.unionByName(same).withColumn("one", (F.col("a") == F.col("b")) & (F.col("part") == F.col("peer_part")))
    full = tiles.join(lists, [*on, "a", "part"]).join(lists.select(*on, F.col("a").alias("b"), F.col("part").alias("peer_part"), F.col("ids").alias("peers")), [*on, "b", "peer_part"])
    pairs = spread(full.select("one", "ids", "peers")).select("one", "peers", F.explode("ids").alias("x")).select("one", "x", F.explode("peers").alias("y"))
    return pairs.filter("if(one, x < y, x <> y)").select(F.least("x", "y").alias("row"), F.greatest("x", "y").alias("peer"))


def band_join(left: DataFrame, right: DataFrame, on: Cols, a: str, b: str, width: int) -> DataFrame:
    """Rows of equal keys with |a - b| <= width; buckets of the width make the band part of the equi key."""
    l = left.withColumn("_cell", F.explode(F.array(*[F.floor(F.col(a) / width) + i for i in (-1, 0, 1)])))
    r = right.withColumn("_cell", F.floor(F.col(b) / width))
    return l.join(r, [*on, "_cell"]).filter(F.abs(F.col(a) - F.col(b)) <= width).drop("_cell")


def last_before(df: DataFrame, keys: Cols, order: list, value: Column, wanted: Column, barrier: Column, name: str) -> DataFrame:
    """As-of backward: the last value of a wanted row strictly before, none from before the last barrier."""
    w = Window.partitionBy(*keys).orderBy(*order)
    out = df.withColumn("_part", F.sum(F.when(barrier, 1).otherwise(0)).over(w.rowsBetween(Window.unboundedPreceding, 0)))
    inner = Window.partitionBy(*keys, "_part").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    return out.withColumn(name, F.last(F.when(wanted, value), ignorenulls=True).over(inner)).drop("_part")


def nearest(df: DataFrame, keys: Cols, order: list, value: Column, wanted: Column, before: str, after: str, barrier: Column | None = None) -> DataFrame:
    """As-of in both directions: the wanted values next before and next after each row, none from beyond a barrier (a
    row's own barrier does not stop it)."""
    w = Window.partitionBy(*keys).orderBy(*order)
    x = F.when(wanted, value)
    if barrier is not None:
        hit = F.when(barrier | wanted, F.struct(F.when(wanted & ~barrier, value).alias("v")))
        return df.withColumns({before: F.last(hit, ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, -1))["v"], after: F.first(hit, ignorenulls=True).over(w.rowsBetween(1, Window.unboundedFollowing))["v"]})
    return df.withColumns({before: F.last(x, ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, -1)), after: F.first(x, ignorenulls=True).over(w.rowsBetween(1, Window.unboundedFollowing))})


def zipped(left: DataFrame, right: DataFrame, on: Cols, left_order: list, right_order: list) -> DataFrame:
    """The k-th row of left with the k-th of right, by key."""
    n = lambda df, o: df.withColumn("k", F.row_number().over(Window.partitionBy(*on).orderBy(*o)))
    return n(left, left_order).join(n(right, right_order), [*on, "k"])


def argmax(df: DataFrame, keys: Cols, value: str, by: list[Column]) -> DataFrame:
    """For each key the value whose struct of `by` is greatest."""
    return df.groupBy(*keys).agg(F.max_by(value, F.struct(*[c.alias(f"c{i}") for i, c in enumerate(by)])).alias(value))


def topk_with_overflow(df: DataFrame, keys: Cols, order: list, k: int) -> tuple[DataFrame, DataFrame]:
    """The first k rows of each key with their rank, and per key how many are beyond."""
    ranked = df.withColumn("rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).filter(F.col("rank") <= k)
    over = df.groupBy(*keys).agg(F.greatest(F.count("*") - k, F.lit(0)).alias("overflow"))
    return ranked, over


def within_budget(df: DataFrame, keys: Cols, order: list, size: Column, total: int) -> DataFrame:
    """Rows while their running size stays within the budget."""
    w = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    return df.withColumn("running", F.sum(size).over(w)).filter(F.col("running") <= total)


def islands(df: DataFrame, keys: Cols, order: list, same: Column) -> DataFrame:
    """Rows with `island`: a number that grows where `same` differs from the row before."""
    w = Window.partitionBy(*keys).orderBy(*order)
    changed = F.when(F.lag(same).over(w).eqNullSafe(same), 0).otherwise(1)
    return df.withColumn("_c", changed).withColumn("island", F.sum("_c").over(w)).drop("_c")


def batches(df: DataFrame, order: list, size: int, partition: Cols | None = None, hands: int = 2) -> DataFrame:
    """Fixed-size batches in order, and a hand by turns."""
    w = Window.partitionBy(*(partition or [F.lit(1)])).orderBy(*order)
    out = df.withColumn("_rn", F.row_number().over(w))
    return out.withColumns({"batch": F.ceil(F.col("_rn") / size).cast("bigint"), "hand": F.pmod(F.col("_rn") - 1, F.lit(hands)).cast("bigint")}).drop("_rn")


def split_ab(df: DataFrame, stratum: str, key: Column, seed: str) -> DataFrame:
    """Halves of each stratum by the order of a hash; the odd row goes to A in the 1st, 3rd, ... odd stratum and to B
    in the others, so arms differ by one at most in each stratum and overall."""
    h = F.sha2(F.concat_ws("|", F.lit(seed), key), 256)
    sizes = df.groupBy(stratum).agg(F.count("*").alias("_n"))  # a row per stratum
    odd = sizes.withColumn("_odd", F.sum(F.pmod("_n", F.lit(2))).over(Window.orderBy(stratum)))
    ranked = df.withColumn("_rn", F.row_number().over(Window.partitionBy(stratum).orderBy(h, key))).join(odd, stratum)
    to_a = F.floor(F.col("_n") / 2) + F.when(F.pmod("_n", F.lit(2)) == 1, F.pmod("_odd", F.lit(2))).otherwise(0)
    return ranked.withColumn("arm", F.when(F.col("_rn") <= to_a, "A").otherwise("B")).drop("_n", "_odd", "_rn")


def on_every(df: DataFrame, group: str, member: str, value: str, least: int) -> DataFrame:
    """Relational division: values that all members of a group have, for groups of `least` members or more. Members of
    values and of groups are counted in one pass, by grouping sets."""
    sets = df.groupingSets([[group, value], [group]], group, value).agg(F.count_distinct(member).alias("have"), F.grouping(value).alias("whole"))
    members = F.max(F.when(F.col("whole") == 1, F.col("have"))).over(Window.partitionBy(group))
    return sets.withColumn("members", members).filter("whole = 0 and have = members").filter(F.col("members") >= least).select(group, value, "members")


def repeated_keys(df: DataFrame, row: str, columns: Cols) -> DataFrame:
    """Unpivot of key columns, and the keys that more than one row has."""
    flat = df.unpivot([row], columns, "field", "key").filter("key is not null and key <> ''")
    return flat.groupBy("key").agg(F.count_distinct(row).alias("n_rows"), F.min(row).alias("first_row")).filter("n_rows > 1")


def orphans(child: DataFrame, parent: DataFrame, on: Cols) -> DataFrame:
    """Foreign-key violations."""
    return child.join(parent, on, "left_anti")


def silent_majority(df: DataFrame, keys: Cols, failed: Column, share: float = 0.5) -> DataFrame:
    """Groups in which more than the share failed: a gate before writing."""
    return df.groupBy(*keys).agg(F.count("*").alias("total"), F.count_if(failed).alias("failed")).withColumn("stop", F.col("failed") > F.col("total") * share)


def fresh(df: DataFrame, at: Column, now: Column, days: Column) -> DataFrame:
    """Cache rows not older than their time to live."""
    return df.filter(at >= now - F.make_dt_interval(days))


def merged_counts(df: DataFrame, keys: Cols, counts: str) -> DataFrame:
    """Sum of maps of counts: a row per key and name."""
    return df.select(*keys, F.explode(counts).alias("name", "n")).groupBy(*keys, "name").agg(F.sum("n").alias("n"))


def upserted(old: DataFrame, new: DataFrame, keys: Cols) -> DataFrame:
    """Rows of new, and those of old whose keys new doesn't have."""
    return old.join(new, keys, "left_anti").unionByName(new)


def forgotten(df: DataFrame, key: Column, hashes: DataFrame, text: Cols, pattern: str, mark: str = "[removed]") -> DataFrame:
    """Opt-out: rows whose key's sha256 is listed go, and what matches the pattern is blanked in the text columns."""
    kept = df.withColumn("_h", F.sha2(F.lower(F.trim(key)), 256)).join(hashes.select(F.col("sha256").alias("_h")).distinct(), "_h", "left_anti").drop("_h")
    return kept.withColumns({c: F.regexp_replace(c, pattern, mark) for c in text})
