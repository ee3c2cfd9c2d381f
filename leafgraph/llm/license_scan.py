"""License scans by diagonal voting, with DataFrame functions only.

Every document becomes its sequence of lower-cased words, every run of three words a hash, and the hashes of all
documents are joined to those of the license templates.  A hit at document word w and template word t votes for the
diagonal w - t.  A diagonal on which every run of the template votes is a verbatim place.  Neighbouring diagonals (a word
was added or left out) are merged and verified by the share of the template's runs they hold.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

K = 3
#: Diagonals this close belong to one place of a template.
NEAR = 2
#: Share of a template's runs that a place must hold.
LEAST = 0.8
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: What separates words.  Splitting at it is several times as fast as extracting the words themselves.
GAP = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"

# The phrases and labels of the contract.
BASE = [
    ("under the mit license", "mit"),
    ("apache license version 2", "apache-2"),
    ("cc by nc", "cc-by-nc"),
]
# Opening words of widely used licenses, as published.
MORE = [
    ("gnu general public license version 3", "gpl-3"),
    ("gnu affero general public license version 3", "agpl-3"),
    ("gnu lesser general public license version 3", "lgpl-3"),
    ("gnu general public license version 2", "gpl-2"),
    ("permission is hereby granted free of charge to any person obtaining a copy of this software and associated"
     " documentation files", "mit-text"),
    ("you may not use this file except in compliance with the license you may obtain a copy of the license at",
     "apache-2-text"),
    ("redistribution and use in source and binary forms with or without modification are permitted provided that the"
     " following conditions are met", "bsd-text"),
    ("permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted",
     "isc-text"),
    ("this source code form is subject to the terms of the mozilla public license", "mpl-2"),
    ("this is free and unencumbered software released into the public domain", "unlicense"),
    ("creative commons attribution sharealike 4 0 international license", "cc-by-sa-4"),
]


def words(text: Column) -> Column:
    return F.array_remove(F.split(F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER), GAP), "")


def _runs(of: str) -> Column:
    """Each run of ``K`` words of an array column, joined by spaces, by position."""
    run = ", ".join(f"{of}[i + {j}]" for j in range(K))
    return F.expr(f"case when size({of}) >= {K} then transform(sequence(0, size({of}) - {K}), i -> concat_ws(' ', {run})) end")


def templates(spark: SparkSession, phrases: list[tuple[str, str]], base: list[tuple[str, str]]) -> DataFrame:
    """A row for each run of each template: its hash, place and words.  As many rows as the template list has words."""
    rows = []
    for number, (phrase, label) in enumerate([*base, *phrases]):
        split = phrase.split()
        if len(split) < K:
            raise ValueError(f"a template has {K} words at least: {phrase!r}")
        for i in range(len(split) - K + 1):
            rows.append((number, label, number < len(base), len(split) - K + 1, i, " ".join(split[i : i + K])))
    found = spark.createDataFrame(rows, "template int, label string, is_base boolean, runs int, t int, t_words string")
    return found.withColumn("run", F.xxhash64("t_words"))


def license_places(
    docs: DataFrame, phrases: list[tuple[str, str]] | None = None, base: list[tuple[str, str]] | None = None
) -> DataFrame:
    """Places of templates: ``doc_id, text_hash, template, label, is_base, first_word, last_word, coverage, verbatim``.

    A row for each merged group of diagonals, whatever its coverage.  ``verbatim`` is the array of the starts at which all
    runs of the template stand, which merging does not change.
    """
    spark = docs.sparkSession
    known = F.broadcast(templates(spark, MORE if phrases is None else phrases, BASE if base is None else base))
    read = docs.select("doc_id", F.xxhash64("text").alias("text_hash"), words(F.col("text")).alias("w"))
    # a run takes its own words along, not its document's: rows stay small however long the document is
    runs = read.select("doc_id", "text_hash", F.posexplode(_runs("w")).alias("at", "run_words"))
    hits = runs.withColumn("run", F.xxhash64("run_words")).join(known, "run").where("run_words = t_words")
    diagonal = hits.groupBy("doc_id", "text_hash", "template", "label", "is_base", "runs", (F.col("at") - F.col("t")).alias("diagonal"))
    diagonal = diagonal.agg(F.collect_set("t").alias("votes"))  # a template's runs at most
    place = Window.partitionBy("doc_id", "text_hash", "template").orderBy("diagonal")
    begins = F.coalesce((F.col("diagonal") - F.lag("diagonal").over(place) > NEAR).cast("int"), F.lit(1))
    merged = diagonal.withColumn("begins", begins).withColumn("place", F.sum("begins").over(place))
    low = F.min(F.col("diagonal") + F.array_min("votes"))
    high = F.max(F.col("diagonal") + F.array_max("votes")) + K - 1
    whole = F.when(F.size("votes") == F.col("runs"), F.col("diagonal"))
    seen = F.size(F.array_distinct(F.flatten(F.collect_list("votes"))))
    return merged.groupBy("doc_id", "text_hash", "template", "label", "is_base", "place").agg(
        low.cast("long").alias("first_word"),
        high.cast("long").alias("last_word"),
        (seen / F.max("runs")).alias("coverage"),
        F.sort_array(F.collect_list(whole)).alias("verbatim"),
    )


def scan_licenses(
    docs: DataFrame,
    phrases: list[tuple[str, str]] | None = None,
    base: list[tuple[str, str]] | None = None,
    least: float = LEAST,
) -> DataFrame:
    """A row for each row of ``docs``: ``doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score``.

    ``n_base`` counts the verbatim places of base phrases and ``first_word``/``last_word`` are their smallest and largest
    start (null without any).  ``labels`` has also those templates of which a place holds ``least`` of the runs.  ``score``
    is the best coverage of any template, 0 without a hit.  Labels are distinct, sorted and joined by commas, empty
    without any.  Null and empty texts have no words and no places.  Rows with the same id and text share one result.
    """
    places = license_places(docs, phrases, base)
    starts = F.flatten(F.collect_list(F.when(F.col("is_base"), F.col("verbatim"))))
    sure = F.col("is_base") & (F.size("verbatim") > 0)
    found = places.groupBy("doc_id", "text_hash").agg(
        starts.alias("starts"),
        F.array_sort(F.collect_set(F.when(sure, F.col("label")))).alias("base"),
        F.array_sort(F.collect_set(F.when(sure | (~F.col("is_base") & (F.col("coverage") >= least)), F.col("label")))).alias("all"),
        F.max("coverage").alias("best"),
    )
    found = found.select(F.col("doc_id").alias("__doc"), F.col("text_hash").alias("__text"), "starts", "base", "all", "best")
    counted = docs.select("doc_id", F.xxhash64("text").alias("text_hash"), F.size(words(F.col("text"))).alias("n_words"))
    joined = counted.join(found, F.col("doc_id").eqNullSafe(F.col("__doc")) & (F.col("text_hash") == F.col("__text")), "left")
    return joined.select(
        "doc_id",
        F.col("n_words").cast("long").alias("n_words"),
        F.coalesce(F.array_size("starts"), F.lit(0)).cast("long").alias("n_base"),
        F.array_min("starts").cast("long").alias("first_word"),
        F.array_max("starts").cast("long").alias("last_word"),
        F.coalesce(F.array_join("base", ","), F.lit("")).alias("base_labels"),
        F.coalesce(F.array_join("all", ","), F.lit("")).alias("labels"),
        F.coalesce("best", F.lit(0.0)).alias("score"),
    )
