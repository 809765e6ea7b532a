"""Text expressions shared by the parsers: white space, tokens, block ids."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The Unicode White_Space characters, and the four separator
# control characters that the label and template text rules also strip.
WHITE_SPACE = "\\t-\\r \\u0085\\u00a0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"
SEPARATOR_CONTROLS = "\\u001c-\\u001f"

# The ASCII members of the two classes above, without the space.
ASCII_WHITE_SPACE = "\t\n\v\f\r"
ASCII_SEPARATOR_CONTROLS = "\x1c\x1d\x1e\x1f"

# Fixed value: the block id pattern.
BLOCK_ID = "(blk_[0-9\\-]+)"


def words(text: Column, extra_delimiters: str = "", controls: bool = False) -> Column:
    """Non-empty runs between white space; each extra delimiter counts as a space.

    Text that is ASCII and whose only white space is the space character, as
    nearly all log text is, splits on that one byte; the rest takes the regex,
    which costs about four times as much.
    """
    spaced = F.translate(text, extra_delimiters, " " * len(extra_delimiters)) if extra_delimiters else text
    plain = F.octet_length(text) == F.char_length(text)
    for char in ASCII_WHITE_SPACE + (ASCII_SEPARATOR_CONTROLS if controls else ""):
        plain = plain & ~F.contains(text, F.lit(char))
    chars = WHITE_SPACE + (SEPARATOR_CONTROLS if controls else "")
    return F.array_remove(F.when(plain, F.split(spaced, " ")).otherwise(F.split(spaced, f"[{chars}]+")), "")


def strip(text: Column, controls: bool = False) -> Column:
    chars = WHITE_SPACE + (SEPARATOR_CONTROLS if controls else "")
    return F.regexp_replace(text, f"^[{chars}]+|[{chars}]+$", "")


def first_block_id(text: Column) -> Column:
    """First block id in the text, null when there is none."""
    found = F.regexp_extract(text, BLOCK_ID, 1)
    return F.when(found != "", found)


def all_block_ids(text: Column) -> Column:
    """Every distinct block id in the text, in order of appearance."""
    return F.array_distinct(F.regexp_extract_all(text, F.lit(BLOCK_ID), F.lit(1)))


def label_flag(label: Column) -> Column:
    """1 for a label that reads ``anomaly`` in any case, else 0 (also for null)."""
    return F.when(F.lower(strip(label, controls=True)) == "anomaly", 1).otherwise(0).cast("int")
