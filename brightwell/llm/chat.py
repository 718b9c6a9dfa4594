"""Chat formatting by prefix-target expansion.

Every assistant turn becomes an example of its own: all turns before it are the
context and only its text is trained. The contexts of a conversation of n turns
hold about n * n / 2 turns in all, so ``expand`` keeps one row per turn and lets
examples share them: a row holds the turn's formatted segment and how many
characters of the conversation lie before it. A target's example is the first
``context_chars`` characters of its conversation and then its own segment;
``loss_start`` to ``loss_end`` are the trained characters of that example. Turns
after the last reply end in an example without a trained part, so that the rows
hold every turn. ``render`` writes examples out in full and ``read`` reads turns,
trained texts and lengths back from their texts; ``parse`` reads rows of ``expand``.

A segment is ``open role sep text close``. Control strings (the template's marks
and those of other templates) inside roles and texts are broken by an escape
sign after their first character; signs that stand there already are kept behind
it, so that taking one sign away gives the text back, whatever it was.

Turns go by ``turn`` (null first), then role and formatted text. Null roles and texts are
empty. A null conv_id is a conversation like any other. Rows that repeat are
turns each for itself. Conversations without a reply give the example without a
trained part alone; an empty table gives no rows. Other columns are ignored.
Numbers and offsets come from sliced windows, so a conversation may hold any
share of the rows. All is done by DataFrame functions.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from brightwell.operators.ordered import Wanted, ordered_columns

TRAINED = "assistant"
#: Control strings of common chat templates.
COMMON_CONTROLS = ("<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>", "<|endoftext|>", "<|system|>", "<|user|>",
                   "<|assistant|>", "<|eot_id|>", "<|start_header_id|>", "<|end_header_id|>")


@dataclass(frozen=True)
class Template:
    """Marks of a turn, and all strings that texts must not hold unescaped.

    No control string may be shorter than two characters, hold the escape sign, or
    overlap with another: the escaped form would not be unique."""

    open: str = "<|im_start|>"
    sep: str = "<|im_sep|>"
    close: str = "<|im_end|>"
    escape: str = "\\"
    others: tuple[str, ...] = COMMON_CONTROLS

    def __post_init__(self):
        every = self.controls
        if len(self.escape) != 1 or any(len(c) < 2 or self.escape in c for c in every):
            raise ValueError("control strings need two characters and no escape sign")
        for a in every:
            for b in every:
                if (a != b and a in b) or any(a.endswith(b[:n]) for n in range(1, min(len(a), len(b)))):
                    raise ValueError(f"control strings overlap: {a} {b}")

    @property
    def controls(self) -> tuple[str, ...]:
        return tuple(dict.fromkeys((self.open, self.sep, self.close, *self.others)))

    def places(self, sign: str) -> str:
        """A pattern for ``sign`` right after the first character of a control string."""
        e, rests = re.escape(self.escape), {}
        for control in self.controls:
            rests.setdefault(control[0], []).append(re.escape(control[1:]))
        return "|".join(f"(?<={re.escape(first)}){sign}(?={e}*(?:{'|'.join(rest)}))" for first, rest in rests.items())


def escape(text: Column, template: Template) -> Column:
    return F.regexp_replace(text, template.places(""), re.escape(template.escape))


def unescape(text: Column, template: Template) -> Column:
    return F.regexp_replace(text, template.places(re.escape(template.escape)), "")


def expand(conversations: DataFrame, template: Template = Template(), trained: str = TRAINED,
           slices: int | None = None) -> DataFrame:
    """One row per turn: conv_id, position (from 0), segment, context_chars, example, loss_start, loss_end.

    ``example`` numbers the examples of a conversation from 0 and is null in rows that
    are only context. Offsets are in characters of the example."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    turns = conversations.select("conv_id", "turn", role.alias("role"), text.alias("text"))
    head = F.concat(F.lit(template.open), escape(F.col("role"), template), F.lit(template.sep))
    turns = turns.select("conv_id", "turn", "role", "text", head.alias("head"), escape(F.col("text"), template).alias("body"))
    turns = turns.withColumns({
        "segment": F.concat("head", "body", F.lit(template.close)), "head_chars": F.char_length("head").cast("long"),
        "body_chars": F.char_length("body").cast("long"), "target": (F.col("role") == trained).cast("long")})
    turns = turns.withColumn("chars", F.char_length("segment").cast("long")).drop("head", "body", "text")
    wanted = Wanted(row_number="number", running_sum={"upto": "chars", "targets": "target"}, lead={"following": "chars"})
    placed = ordered_columns(turns, ["turn", "role", "segment"], wanted, ["conv_id"], slices)
    is_target, before = F.col("target") == 1, F.col("upto") - F.col("chars")
    number = F.when(is_target, F.col("targets") - 1).when(F.col("following").isNull(), F.col("targets"))
    start = F.when(is_target, before + F.col("head_chars"))
    return placed.select("conv_id", (F.col("number") - 1).alias("position"), "segment", before.alias("context_chars"),
                         number.alias("example"), start.alias("loss_start"), (start + F.col("body_chars")).alias("loss_end"))


def render(expanded: DataFrame) -> DataFrame:
    """Examples in full: conv_id, example, text, loss_start, loss_end, last (the example holds every turn).

    Every context is written out, which grows with the square of a conversation's turns. The
    turns of a conversation are put together once; its examples are prefixes of that, made one
    at a time, so a task holds a conversation and one example of it."""
    end = (F.col("context_chars") + F.char_length("segment")).cast("int")
    turns = F.array_sort(F.collect_list(F.struct("position", "segment", end.alias("end"), "example", "loss_start", "loss_end")))
    whole = expanded.groupBy("conv_id").agg(turns.alias("turns")).select(
        "conv_id", F.array_join("turns.segment", "").alias("whole"), F.transform(
            F.filter("turns", lambda t: t["example"].isNotNull()),
            lambda t: F.struct(t["example"].alias("example"), t["end"].alias("end"), t["loss_start"].alias("loss_start"), t["loss_end"].alias("loss_end"))).alias("targets"))
    each = whole.select("conv_id", "whole", F.size("targets").alias("n"), F.explode("targets").alias("t"))
    return each.select("conv_id", "t.example", F.substr("whole", F.lit(1), F.col("t.end")).alias("text"), "t.loss_start", "t.loss_end",
                       (F.col("t.example") == F.col("n") - 1).alias("last"))


def read(examples: DataFrame, template: Template = Template()) -> DataFrame:
    """Rows of ``render`` read back from their texts: conv_id, example, trained (the text under the
    loss mask, else null), example_chars, turns (role and text of each; the last example's only, else null)."""
    text = F.col("text")
    masked = F.substr(text, (F.col("loss_start") + 1).cast("int"), (F.col("loss_end") - F.col("loss_start")).cast("int"))
    # Marks inside roles and texts are escaped, so they stand between turns and parts of turns alone.
    pieces = F.split(text, re.escape(template.close))
    turns = F.transform(F.slice(pieces, 1, F.size(pieces) - 1), lambda piece: F.struct(
        unescape(F.substr(F.substring_index(piece, template.sep, 1), F.lit(len(template.open) + 1)), template).alias("role"),
        unescape(F.substring_index(piece, template.sep, -1), template).alias("text")))
    return examples.select("conv_id", "example", unescape(masked, template).alias("trained"),
                           F.char_length(text).cast("long").alias("example_chars"), F.when(F.col("last"), turns).alias("turns"))


def example_digests(found: DataFrame) -> DataFrame:
    """Per conversation the digests of what ``read`` found, with the columns of ``digests``."""
    lines = F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    rows = found.select("conv_id", "example", "trained", "example_chars", F.size("turns").alias("n"),
                        F.sha2(F.array_join(lines, "").cast("binary"), 256).alias("sha"))
    each = rows.groupBy("conv_id").agg(
        F.max(F.when(F.col("sha").isNotNull(), F.struct("n", "sha"))).alias("all"),
        F.array_sort(F.collect_list(F.struct("example", "trained"))).alias("parts"),
        F.coalesce(F.sum(F.char_length("trained")), F.lit(0)).cast("long").alias("loss_chars"), F.sum("example_chars").alias("formatted_chars"))
    return each.select(
        "conv_id", F.col("all.n").cast("long").alias("n_turns"), F.col("all.sha").alias("turns_sha256"), "loss_chars",
        F.sha2(F.array_join("parts.trained", "").cast("binary"), 256).alias("loss_sha256"), F.col("formatted_chars").cast("long").alias("formatted_chars"))


def parse(expanded: DataFrame, template: Template = Template()) -> DataFrame:
    """Read rows of ``expand`` back: conv_id, position, role, text, trained (the text under
    the loss mask, else null), example_chars (length of the example that ends here, else null)."""
    segment = F.col("segment")
    split = F.instr(segment, template.sep)
    role = F.substr(segment, F.lit(len(template.open) + 1), split - 1 - len(template.open))
    start = split + len(template.sep)
    text = F.substr(segment, start, F.char_length(segment) - len(template.close) - start + 1)
    masked = F.substr(segment, (F.col("loss_start") - F.col("context_chars") + 1).cast("int"),
                      (F.col("loss_end") - F.col("loss_start")).cast("int"))
    chars = F.when(F.col("example").isNotNull(), F.col("context_chars") + F.char_length(segment))
    return expanded.select("conv_id", "position", unescape(role, template).alias("role"), unescape(text, template).alias("text"),
                           unescape(masked, template).alias("trained"), chars.alias("example_chars"))


def digests(parsed: DataFrame) -> DataFrame:
    """Per conversation the digests of what ``parse`` read: conv_id, n_turns, turns_sha256,
    loss_chars, loss_sha256, formatted_chars (all examples written out).

    A digest of a whole conversation needs its texts in one place: up to 2 GB here."""
    turns = F.array_sort(F.collect_list(F.struct("position", F.concat("role", F.lit("\n"), "text", F.lit("\n")).alias("turn"), "trained")))
    each = parsed.groupBy("conv_id").agg(
        F.count(F.lit(1)).alias("n_turns"), turns.alias("turns"),
        F.coalesce(F.sum(F.char_length("trained")), F.lit(0)).cast("long").alias("loss_chars"), F.sum("example_chars").alias("formatted_chars"))
    return each.select(
        "conv_id", "n_turns", F.sha2(F.array_join("turns.turn", "").cast("binary"), 256).alias("turns_sha256"), "loss_chars",
        F.sha2(F.array_join("turns.trained", "").cast("binary"), 256).alias("loss_sha256"), F.col("formatted_chars").cast("long").alias("formatted_chars"))
