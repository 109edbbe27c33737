"""License scans by diagonal voting, with DataFrame functions only.

All rolling word pairs of every text are joined, by hash and words, to the places of the templates' pairs. A pair met
at word i of a text and place j of a template votes for the diagonal i - j of that template. A base phrase stands
wherever one diagonal has the votes of all its pairs. For longer notices, whose copies lose or gain words, each diagonal
is merged with the neighbours at most `drift` beyond it (and at most half the template's length), and the merged span is
verified: enough of the template's pairs. The bound on the neighbours bounds the span, at 1.5 times the template, and
votes elsewhere in a text can take nothing from a notice.

The templates are the constants below, so the broadcast side of the join has a fixed size.

Defined cases: null and empty texts have no words, no labels and score 0; rows that repeat doc_id and text are one
document and get the same result each; rows with one doc_id and different texts are judged apart; a null doc_id stays
null; an empty table gives no rows; very long texts are split whole, in one row's array; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sitesieve.llm import shared

# The base phrases and their labels.
BASE = [
    ("gnu general public license", "gpl"),
    ("apache license", "apache"),
    ("cc by", "cc-by"),
    ("mit license", "mit"),
]
# Sentences of public licenses and notices, by which the method adds labels of its own.
NOTICES = [
    ("permission is hereby granted free of charge to any person obtaining a copy of this software", "mit"),
    ("licensed under the apache license version 2 0 you may not use this file except in compliance with the license", "apache"),
    ("this program is free software you can redistribute it and or modify it under the terms of the gnu general public license", "gpl"),
    ("this library is free software you can redistribute it and or modify it under the terms of the gnu lesser general public license", "lgpl"),
    ("redistribution and use in source and binary forms with or without modification are permitted", "bsd"),
    ("this source code form is subject to the terms of the mozilla public license", "mpl"),
    ("this work is licensed under a creative commons attribution", "cc-by"),
    ("permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted", "isc"),
    ("this is free and unencumbered software released into the public domain", "unlicense"),
]
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
NOT_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def _words(text):
    return F.array_remove(F.split(F.translate(text, UPPER, LOWER), NOT_WORD), "")


def templates(spark: SparkSession, phrases: list[tuple[str, str]]) -> DataFrame:
    """tid, pairs (of the template), label, place, v, w, h: a row for each word pair of each template."""
    rows = [(tid, len(x) - 1, label, j, x[j], x[j + 1]) for tid, (phrase, label) in enumerate(phrases) for x in [phrase.split()] for j in range(len(x) - 1)]
    return spark.createDataFrame(rows, "tid int, pairs int, label string, place int, v string, w string").withColumn("h", F.xxhash64("v", "w"))


def scanned(docs: DataFrame, base: list[tuple[str, str]] = BASE, notices: list[tuple[str, str]] = NOTICES, enough: float = 0.8, drift: int = 6) -> DataFrame:
    """doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score."""
    spark = docs.sparkSession
    k = F.coalesce(F.col("doc_id").cast("bigint"), F.lit(shared.NO_ID)).alias("k")
    given = docs.select(k, F.xxhash64(F.coalesce("text", F.lit(""))).alias("t"), _words(F.coalesce("text", F.lit(""))).alias("words"))
    pairs = given.select("k", "t", F.arrays_zip(F.col("words").alias("v"), F.slice("words", 2, F.greatest(F.size("words"), F.lit(1))).alias("w")).alias("z"))
    grams = pairs.select("k", "t", F.posexplode_outer("z").alias("i", "z")).select("k", "t", "i", F.col("z.v").alias("v"), F.col("z.w").alias("w"), F.xxhash64("z.v", "z.w").alias("h"))
    votes = grams.join(F.broadcast(templates(spark, base + notices)), ["h", "v", "w"])
    lines = votes.groupBy("k", "t", "tid", "pairs", "label", (F.col("i") - F.col("place")).alias("line")).agg(F.collect_set("place").alias("places"))
    is_base = F.col("tid") < len(base)
    near = Window.partitionBy("k", "t", "tid").orderBy("line").rangeBetween(0, drift)
    reach = F.when(is_base, 0).otherwise(F.least(F.lit(drift), F.floor((F.col("pairs") + 1) / 2)))  # base phrases stand on one diagonal
    around = lines.withColumn("around", F.collect_list(F.struct("line", "places")).over(near))  # drift + 1 diagonals at most
    merged = around.select("*", F.size(F.array_distinct(F.flatten(F.transform(F.filter("around", lambda x: x["line"] <= F.col("line") + reach), lambda x: x["places"])))).alias("met"))
    share = F.col("met") / F.col("pairs")
    exact = is_base & (F.col("met") == F.col("pairs"))
    notice = ~is_base & (share >= enough)
    both = merged.filter(exact | notice).groupBy("k", "t").agg(F.count_if(exact).alias("n_base"), F.min(F.when(exact, F.col("line").cast("bigint"))).alias("first_word"), F.max(F.when(exact, F.col("line").cast("bigint"))).alias("last_word"), F.collect_set(F.when(exact, F.col("label"))).alias("based"), F.collect_set("label").alias("own"), F.max(F.when(notice, share)).alias("share"))
    none = F.expr("cast(array() as array<string>)")
    text = lambda *c: F.array_join(F.array_sort(F.array_distinct(F.concat(*[F.coalesce(x, none) for x in c]))), ",")
    return given.select("k", "t", F.size("words").cast("bigint").alias("n_words")).join(both, ["k", "t"], "left").select(
        F.when(F.col("k") != shared.NO_ID, F.col("k")).alias("doc_id"),
        "n_words",
        F.coalesce("n_base", F.lit(0).cast("bigint")).alias("n_base"),
        "first_word",
        "last_word",
        text("based").alias("base_labels"),
        text("based", "own").alias("labels"),
        F.when(F.col("n_base") > 0, 1.0).otherwise(F.coalesce("share", F.lit(0.0))).alias("score"),
    )


def op7_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scanned(shared.table(spark, sf_dir, "documents"))
