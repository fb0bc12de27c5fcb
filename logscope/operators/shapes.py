"""Shapes of lines that do not parse (L17): message templates mined from masked words.

Lines without a time, a level or a component are counted by their masked words (paths, hexadecimal numbers and numbers
masked), so a task ships one row per distinct shape, however many lines there are.  The shapes are then
leaves of a prefix tree of fixed depth: the number of words, then the first ``depth`` of them.  In a leaf, a word
that all shapes share stays, one that varies becomes ``<*>``: minimum and maximum per position, which merge like any other aggregate.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logscope.functions import columns as C
from logscope.session import materialize

LACKS = ["no_timestamp", "no_level", "no_component"]


def unparsed_shapes(logs: DataFrame) -> DataFrame:
    """``(words, num_lines, no_timestamp, no_level, no_component, example)`` per distinct masked line that lacks a part; ``example`` is
    the least such line."""
    rows = C.with_log_time(logs, "line", "__ts").select(
        "line", F.col("__ts").isNull().alias(LACKS[0]), (C.level("line") == "").alias(LACKS[1]), (C.component("line") == "").alias(LACKS[2]))
    return (rows.filter(" OR ".join(LACKS)).groupBy(C.masked_tokens("line").alias("words"))
            .agg(F.count(F.lit(1)).alias("num_lines"), *[F.count_if(c).alias(c) for c in LACKS], F.min("line").alias("example")))


def unparsed_templates(logs: DataFrame, depth: int = 2) -> DataFrame:
    """``(template, num_words, num_lines, num_shapes, no_timestamp, no_level, no_component, example)`` per leaf of the prefix tree,
    most frequent first."""
    shapes = materialize(unparsed_shapes(logs))
    leaf = [F.size("words").alias("num_words"), F.slice("words", 1, depth).alias("prefix")]
    keyed = shapes.select("*", *leaf)
    totals = (keyed.groupBy("num_words", "prefix")
              .agg(F.count(F.lit(1)).alias("num_shapes"), *[F.sum(c).alias(c) for c in ["num_lines", *LACKS]], F.min("example").alias("example")))
    places = (keyed.select("num_words", "prefix", F.posexplode("words").alias("place", "word"))
              .groupBy("num_words", "prefix", "place").agg(F.min("word").alias("lo"), F.max("word").alias("hi")))
    word = F.when(F.col("lo") == F.col("hi"), F.col("lo")).otherwise(F.lit("<*>"))
    # a leaf has as many places as its lines have words
    made = (places.select("num_words", "prefix", F.struct("place", word.alias("word")).alias("p")).groupBy("num_words", "prefix")
            .agg(F.array_sort(F.collect_list("p")).alias("ps")))
    template = F.array_join(F.transform("ps", lambda p: p["word"]), " ")
    return (totals.join(made, ["num_words", "prefix"])
            .select(template.alias("template"), "num_words", "num_lines", "num_shapes", *LACKS, "example")
            .orderBy(F.col("num_lines").desc(), "template"))
