"""Quality rules by distribution divergence, in DataFrame functions only.

A text in a language has that language's mix of character classes, and its
commonest words as often as the language has them. Both mixes are histograms;
the Jensen-Shannon distance (0 to 1) to the nearest language reference tells how
far a document is from any text of these languages. References are the summed
counts of all documents of a language that have at least ``MIN_WORDS`` words. Short texts
have rough histograms, so each test needs a minimum length, and limits widen by
the distance that chance alone gives a text of that length.

Null text counts as without words: it fails the base rules. Equal rows get equal
verdicts. Any other language with such documents has a reference too, with common
words counted from the data; its documents must be near that or one of the listed
references. A reference of few documents says little, so its limits are wider by
``few`` over the root of their number: one document more never turns a test on.
Documents of a language without a reference, or of none, pass the divergence tests. All work on a text is linear but for one sort of its
word windows.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from brightwell.llm.common import BLANK, WORD, cut_lineage, let

# Languages and their commonest words.
COMMON_WORDS = {
    "en": "the of and to in is that it for was with as on be at by",
    "fr": "de la le et les des en un du une que est pour qui dans sur",
    "de": "der die und in den von zu das mit sich des auf für ist im dem",
    "es": "de la que el en y a los se del las un por con no una",
}
#: Character classes that are counted one by one. Blanks and small Latin letters
#: are counted too, and what is left (other letters, marks) is one class more.
CLASSES = (r"[A-Z]", r"[0-9]", r"[.,;:'\x22!?()-]", r"[#*$%&|<>]", r"[@^~_=+/\x5C\x60\x5B\x5D\x7B\x7D]")
SYMBOLS = CLASSES[3]
BLANKS = " \t\n\x0b\x0c\r"
BINS = len(CLASSES) + 3
MIN_WORDS = 50
#: Common words learned of a language that is not listed.
LEARNED = 16
#: References that are broadcast at most (about a kilobyte each), and tasks that a
#: language's documents are dealt to beyond.
BROADCAST_LANGS = 10_000
SALTS = 64


@dataclass(frozen=True)
class Limits:
    """Largest distances of a kept document, least lengths for the tests, how many
    times the distance expected by chance is added, and what is added for a reference
    of one document of a language that is not listed."""

    chars: float = 0.17
    words: float = 0.08
    min_chars: int = 200
    min_words: int = 50
    chance: float = 2.0
    few: float = 0.5


def vocabulary(common: Mapping[str, str] = COMMON_WORDS) -> list[str]:
    return sorted({w for words in common.values() for w in words.split()})


def words_of(text: Column) -> Column:
    bare = F.btrim(F.coalesce(text, F.lit("")), F.lit(BLANKS))
    return F.when(bare == "", F.array().cast("array<string>")).otherwise(F.split(bare, BLANK))


def duplicate_lines(text: Column) -> Column:
    """Lines with a word that equal an earlier line."""
    lines = F.filter(F.split(F.coalesce(text, F.lit("")), "\n", -1), lambda line: line.rlike(WORD))
    return let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long")


#: Repeated windows that are looked up one by one; a text with more has its windows sorted.
FEW = 64


def repeated_words(words: Column) -> Column:
    """Words in windows of three words that occur twice or more in the text.

    Windows are compared by 64-bit hash. A text without an equal pair is done at
    once. Else the places of repeated windows are found, by looking for the few
    hashes that repeat, or, if they are many, by sorting all hashes with their
    places; each place covers the words up to the next one, three at most.
    """
    none = F.lit(0).cast("long")

    def windows(h: Column) -> Column:
        return F.transform(F.sequence(F.lit(1), F.size(h) - 2), lambda i: F.xxhash64(
            F.element_at(h, i), F.element_at(h, i + 1), F.element_at(h, i + 2)))

    def repeated(h: Column) -> Column:
        return let(F.sort_array(h), lambda s: F.array_distinct(F.filter(s, lambda x, at: F.get(s, at - 1).eqNullSafe(x))))

    def looked_up(h: Column, often: Column) -> Column:
        marked = F.transform(h, lambda x, at: F.when(F.array_contains(often, x), at))
        return F.array_compact(marked)

    def sorted_out(h: Column) -> Column:
        def equal(s: Column, p: Column, at: Column) -> Column:
            return F.get(s, at)["h"].eqNullSafe(p["h"])
        pairs = F.sort_array(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))
        return let(pairs, lambda s: F.sort_array(F.transform(
            F.filter(s, lambda p, at: equal(s, p, at - 1) | equal(s, p, at + 1)), lambda p: p["i"])))

    def covered(places: Column) -> Column:
        return F.aggregate(F.transform(places, lambda p, at: F.least(F.lit(3), F.coalesce(F.get(places, at + 1) - p, F.lit(3)))),
                           none, lambda total, n: total + n)

    def found(h: Column) -> Column:
        places = let(repeated(h), lambda often: F.when(F.size(often) <= FEW, looked_up(h, often)).otherwise(sorted_out(h)))
        return F.when(F.size(F.array_distinct(h)) == F.size(h), none).otherwise(let(places, covered))

    return F.when(F.size(words) < 3, none).otherwise(let(windows(words), found))


def char_histogram(text: Column) -> Column:
    """Counts of small letters, blanks, ``CLASSES`` and all other characters.

    Small letters go first, then blanks; the classes are counted in the short rest.
    """
    whole = F.coalesce(text, F.lit(""))

    def of_rest(rest: Column, blanks: Column) -> Column:
        size = F.char_length(rest)
        counts = [size - F.char_length(F.regexp_replace(rest, f"{c}+", "")) for c in CLASSES]
        return let(F.array(F.char_length(whole) - blanks - size, blanks, *counts), lambda n: F.concat(
            n, F.array(F.char_length(whole) - F.aggregate(n, F.lit(0), lambda a, b: a + b))))

    def without_letters(some: Column) -> Column:
        return let(F.regexp_replace(some, BLANK, ""), lambda rest: of_rest(rest, F.char_length(some) - F.char_length(rest)))
    return F.transform(let(F.regexp_replace(whole, "[a-z]+", ""), without_letters), lambda n: n.cast("long"))


def word_histogram(words: Column, common: Sequence[str]) -> Column:
    """Counts of the common words as they stand, in their order, and of all other words.

    Each common word becomes one sign of a short text, so that every count is one
    replacement there instead of a pass over all words.
    """
    first = 33  # the first printable sign; the list must fit before the last, 126
    listed = F.array(*[F.lit(w) for w in common])
    signs = F.transform(F.filter(words, lambda w: w.isin(*common)),
                        lambda w: F.char(F.array_position(listed, w) + (first - 1)))
    return let(F.array_join(signs, ""), lambda text: F.transform(
        F.array(*[F.octet_length(text) - F.octet_length(F.replace(text, F.lit(chr(first + i)), F.lit(""))) for i in range(len(common))],
                F.size(words) - F.octet_length(text)), lambda n: n.cast("long")))


def distance(counts: Column, reference: Sequence[int] | Column) -> Column:
    """Jensen-Shannon distance (base 2, 0 to 1) of a histogram from a reference."""
    if isinstance(reference, Column):
        other = let(F.aggregate(reference, F.lit(0).cast("long"), lambda a, b: a + b), lambda n: F.transform(reference, lambda x: x / n))
    else:
        total = float(sum(reference)) or 1.0
        other = F.array(*[F.lit(n / total) for n in reference])

    def part(p: Column, m: Column) -> Column:
        return F.when(p > 0, p * F.log2(p / m)).otherwise(F.lit(0.0))

    def against(own_total: Column) -> Column:
        shares = F.transform(counts, lambda n: n / own_total)
        terms = F.zip_with(shares, other, lambda p, q: let((p + q) / 2, lambda m: part(p, m) + part(q, m)))
        return F.sqrt(F.greatest(F.lit(0.0), F.aggregate(terms, F.lit(0.0), lambda a, b: a + b) / 2))
    sums = F.aggregate(counts, F.lit(0).cast("long"), lambda a, b: a + b)
    return let(sums.cast("double"), lambda n: F.when(n > 0, against(n)).otherwise(F.lit(1.0)))


def histograms(text: Column) -> Column:
    """Struct of n_words and both histograms."""
    return let(words_of(text), lambda words: F.struct(
        F.size(words).cast("long").alias("n_words"), char_histogram(text).alias("chars"),
        word_histogram(words, vocabulary()).alias("commons")))


def measure(text: Column) -> Column:
    """Struct of the base figures and both histograms."""
    def figures(words: Column, h: Column) -> Column:
        chars = h["chars"]
        total = F.aggregate(chars, F.lit(0).cast("long"), lambda a, b: a + b)
        return let(repeated_words(words), lambda repeated: F.struct(
            h["n_words"].alias("n_words"), (total - chars[1]).alias("word_chars"),
            chars[2 + CLASSES.index(SYMBOLS)].alias("n_symbols"), duplicate_lines(text).alias("n_dup_lines"),
            repeated.alias("n_repeat_words"),
            ((h["n_words"] < MIN_WORDS) | (100 * repeated > 50 * h["n_words"])).alias("base_failed"),
            chars.alias("chars"), h["commons"].alias("commons")))
    return let(words_of(text), lambda words: let(F.struct(
        F.size(words).cast("long").alias("n_words"), char_histogram(text).alias("chars"),
        word_histogram(words, vocabulary()).alias("commons")), lambda h: figures(words, h)))


def references(figures: DataFrame, name: str) -> dict[str, tuple[list[int], list[int]]]:
    """Summed histograms (in the struct ``name``) of each listed language over all
    its documents of ``MIN_WORDS`` words. One row per listed language reaches the driver."""
    def summed(field: str, size: int, short: str) -> list[Column]:
        # A condition inside the sums: as a filter it would measure each text once more.
        long = F.col(f"{name}.n_words") >= MIN_WORDS
        return [F.sum(F.when(long, F.col(f"{name}.{field}")[i]).otherwise(0)).alias(f"{short}{i}") for i in range(size)]
    n_words = len(vocabulary()) + 1
    rows = (figures.where(F.col("lang").isin(*COMMON_WORDS)).groupBy("lang")
            .agg(*summed("chars", BINS, "c"), *summed("commons", n_words, "w")).collect())
    found = {r["lang"]: ([r[f"c{i}"] for i in range(BINS)], [r[f"w{i}"] for i in range(n_words)]) for r in rows}
    return {lang: both for lang, both in found.items() if sum(both[1])}


def own_histogram(words: Column, common: Column) -> Column:
    """Counts of the words in the array ``common``, and of all other words."""
    return let(F.filter(words, lambda w: F.array_contains(common, w)), lambda few: F.concat(
        F.transform(common, lambda c: F.size(F.filter(few, lambda w: w == c)).cast("long")),
        F.array((F.size(words) - F.size(few)).cast("long"))))


def other_references(docs: DataFrame) -> DataFrame | None:
    """(_lang, _docs, _chars, _common, _words) of each language that is not listed but
    has long documents; None if there is none. A row per language."""
    texts = docs.where(F.col("lang").isNotNull() & ~F.col("lang").isin(*COMMON_WORDS)).select(
        F.col("lang").alias("_lang"), F.col("text").alias("_text"), words_of(F.col("text")).alias("_all")).where(F.size("_all") >= MIN_WORDS)
    sums = [F.sum(F.col("_h")[i]).alias(f"c{i}") for i in range(BINS)]
    chars = texts.select("_lang", F.size("_all").alias("_n"), char_histogram(F.col("_text")).alias("_h")).groupBy("_lang").agg(
        F.count(F.lit(1)).alias("_docs"), F.sum("_n").cast("long").alias("_n"), *sums)
    chars = cut_lineage(chars.select("_lang", "_docs", "_n", F.array(*[f"c{i}" for i in range(BINS)]).alias("_chars")))
    if chars.isEmpty():
        return None
    counted = (texts.join(chars.select("_lang"), "_lang", "left_semi").select("_lang", F.explode("_all").alias("_word"))
               .groupBy("_lang", "_word").agg(F.count(F.lit(1)).alias("_count")))
    rank = F.row_number().over(Window.partitionBy("_lang").orderBy(F.col("_count").desc(), "_word"))
    top = counted.withColumn("_rank", rank).where(F.col("_rank") <= LEARNED).groupBy("_lang").agg(
        F.sort_array(F.collect_list(F.struct("_rank", "_word", "_count"))).alias("_top"))
    return cut_lineage(chars.join(top, "_lang").select(
        "_lang", "_docs", "_chars", F.col("_top._word").alias("_common"), F.concat("_top._count", F.array(
            F.col("_n") - F.aggregate("_top._count", F.lit(0).cast("long"), lambda a, b: a + b))).alias("_words")))


def beside(rows: DataFrame, others: DataFrame) -> DataFrame:
    """Each row with the reference of its language, nulls where there is none."""
    same = F.col("lang") == F.col("_lang")
    if others.count() <= BROADCAST_LANGS:
        return rows.join(F.broadcast(others), same, "left")
    each = others.withColumn("_to", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    dealt = rows.withColumn("_salt", F.pmod(F.xxhash64("text"), F.lit(SALTS)).cast("int"))
    return dealt.join(each, same & (F.col("_salt") == F.col("_to")), "left").drop("_salt", "_to")


def nearest(counts: Column, histograms: Sequence[Sequence[int] | Column]) -> Column:
    """Distance from the nearest reference; 0 if there is none."""
    found = [distance(counts, h) for h in histograms]
    return let(counts, lambda _: F.array_min(F.array(*found))) if found else F.lit(0.0)


def divergent(m: Column, known: Mapping[str, tuple[list[int], list[int]]], limits: Limits = Limits(),
              lang: Column | None = None, other: tuple[Column, Column, Column, Column] | None = None) -> Column:
    """Whether a measured document is too far from every reference.

    By chance alone the squared distance of n draws over k bins from their source
    is about (k - 1) / (8 n ln 2). Of the common words only those of one language
    are drawn in earnest. With ``lang``, other languages than the listed ones are
    held against their own reference too, if ``other`` has it (class counts, counts
    of its words in the document and in the reference, its documents; null for none), and pass else.
    """
    n_chars = F.aggregate(m["chars"], F.lit(0).cast("long"), lambda a, b: a + b)
    own = max(len(words.split()) for words in COMMON_WORDS.values()) + 1

    def over(distance_: Column, n: Column, least: int, limit: Column, bins: int) -> Column:
        chance = F.sqrt(F.lit((bins - 1) / (8 * 0.6931471805599453)) / n)
        return (n >= least) & (distance_ > limit + limits.chance * chance)

    def far(chars: Column, words: Column, wider: Column | float = 0.0) -> tuple[Column, Column]:
        return (over(chars, n_chars, limits.min_chars, limits.chars + F.lit(wider), BINS),
                over(words, m["n_words"], limits.min_words, limits.words + F.lit(wider), own))
    listed = [[known[k][which] for k in sorted(known)] for which in (0, 1)]
    chars, words = far(nearest(m["chars"], listed[0]), nearest(m["commons"], listed[1]))
    if lang is None:
        return chars | words
    strange = ~F.coalesce(lang.isin(*COMMON_WORDS), F.lit(False))
    if other is None:
        return ~strange & (chars | words)
    theirs, spoken, reference, n_docs = other
    own_chars, own_words = far(distance(m["chars"], theirs), distance(spoken, reference), limits.few / F.sqrt(n_docs))
    if not known:  # nothing listed to be near to
        chars = words = F.lit(True)
    return F.when(~strange, (chars | words) if known else F.lit(False)).when(theirs.isNull(), F.lit(False)).otherwise(
        (own_chars & chars) | (own_words & words))


def judge(docs: DataFrame, limits: Limits = Limits()) -> DataFrame:
    """doc_id, the base figures, base_failed and kept for each document."""
    others = other_references(docs)
    m = measure(F.col("text"))
    if others is None:
        figures = cut_lineage(docs.select("doc_id", "lang", m.alias("m")))
    else:
        rows = beside(docs.select("doc_id", "lang", "text"), others)
        figures = cut_lineage(rows.select("doc_id", "lang", m.alias("m"), "_chars", _spoken().alias("_spoken"), "_words", "_docs"))
    known = references(figures, "m")
    other = None if others is None else (F.col("_chars"), F.col("_spoken"), F.col("_words"), F.col("_docs"))
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")
    return figures.select("doc_id", *[F.col(f"m.{n}").alias(n) for n in names],
                          (~F.col("m.base_failed") & ~divergent(F.col("m"), known, limits, F.col("lang"), other)).alias("kept"))


def _spoken() -> Column:
    return F.when(F.col("_common").isNotNull(), own_histogram(words_of(F.col("text")), F.col("_common")))


def keep_good(docs: DataFrame, limits: Limits = Limits()) -> DataFrame:
    """The documents that pass all rules, with the columns of ``docs``."""
    known = references(docs.select("lang", histograms(F.col("text")).alias("h")), "h")
    others = other_references(docs)
    # One expression, so that a text is measured once: a filter on a column made
    # before would measure it anew for each part of the condition.
    if others is None:
        return docs.where(let(measure(F.col("text")), lambda m: ~m["base_failed"] & ~divergent(m, known, limits, F.col("lang"))))
    # The row travels as one column, so that no name of its own can clash.
    rows = beside(docs.select(F.struct("*").alias("_row"), "text", "lang"), others)
    return rows.where(let(measure(F.col("text")), lambda m: let(_spoken(), lambda spoken: ~m["base_failed"] & ~divergent(
        m, known, limits, F.col("lang"), (F.col("_chars"), spoken, F.col("_words"), F.col("_docs")))))).select("_row.*")
