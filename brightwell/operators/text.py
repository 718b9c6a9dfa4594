"""Word statistics of a text column."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from brightwell.functions.numbers import ratio
from brightwell.functions.strings import clean_word, words


def tokens(df: DataFrame, text: str, name: str = "word") -> DataFrame:
    """One row per cleaned word."""
    return (df.select(F.explode(words(F.col(text))).alias("__raw"))
            .select(clean_word(F.col("__raw")).alias(name)).where(F.col(name).isNotNull()))


def raw_word_count(df: DataFrame, text: str, separator: str = " ") -> DataFrame:
    """Counts of the pieces between separators, unchanged; works on a stream too."""
    return (df.select(F.explode(F.split(F.col(text), separator)).alias("word"))
            .groupBy("word").agg(F.count(F.lit(1)).alias("count")))


def word_count(df: DataFrame, text: str) -> DataFrame:
    """Counts of the cleaned words.

    Raw words are counted first, so that cleaning and its regular expression
    run once per distinct raw word and not once per word of the corpus.
    """
    raw = (df.select(F.explode(words(F.col(text))).alias("raw"))
           .groupBy("raw").agg(F.count(F.lit(1)).alias("n")))
    return (raw.select(clean_word(F.col("raw")).alias("word"), "n").where(F.col("word").isNotNull())
            .groupBy("word").agg(F.sum("n").alias("count")))


def words_containing(df: DataFrame, text: str, part: str) -> DataFrame:
    """Counts of the cleaned words that contain a text."""
    return word_count(df, text).where(F.contains(F.col("word"), F.lit(part)))


def corpus_statistics(df: DataFrame, text: str) -> DataFrame:
    """Totals, richness, mean length, longest and shortest word.

    Runs on the word counts, not on the words. Ties in length go to the word
    that sorts first, so the answer does not depend on the partitions.
    """
    counts = word_count(df, text).withColumn("len", F.length("word"))
    shortest = F.min(F.struct("len", "word"))
    longest = F.min(F.struct((-F.col("len")).alias("len"), F.col("word").alias("word")))
    return counts.agg(
        F.sum("count").alias("total_words"),
        F.count(F.lit(1)).alias("unique_words"),
        ratio(F.count(F.lit(1)), F.sum("count")).alias("richness"),
        ratio(F.sum(F.col("len") * F.col("count")), F.sum("count")).alias("avg_word_length"),
        longest["word"].alias("longest_word"),
        shortest["word"].alias("shortest_word"))


def word_lengths(df: DataFrame, text: str) -> DataFrame:
    return (word_count(df, text).groupBy(F.length("word").alias("word_length"))
            .agg(F.sum("count").alias("count")))


def bigrams(df: DataFrame, text: str) -> DataFrame:
    """Neighbouring words of one line, with counts; pairs never cross a line end."""
    lines = df.select(F.explode(F.split(F.lower(F.col(text)), "\n")).alias("line"))
    # A line of one word gives empty slices. A condition on their number would be pushed
    # below the split, and each line would be split twice.
    split = lines.select(words(F.col("line")).alias("w"))
    n = F.size("w") - 1
    pairs = F.arrays_zip(F.slice("w", 1, n).alias("first_word"), F.slice("w", 2, n).alias("second_word"))
    return (split.select(F.inline(pairs).alias("first_word", "second_word"))
            .groupBy("first_word", "second_word").agg(F.count(F.lit(1)).alias("count")))
