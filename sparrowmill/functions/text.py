"""Text expressions: cleaning, tokens, labels. All of them stay in the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# fixed values: no-break space and narrow no-break space
NO_BREAK_SPACES = "\u00a0\u202f"


def clean_line(text: Column) -> Column:
    """Lower-case, runs of white space as one space, no outer space."""
    return F.trim(F.regexp_replace(F.lower(text), r"\s+", " "))


def letters_only(text: Column) -> Column:
    """Every run of anything but ASCII letters becomes one space."""
    return F.regexp_replace(text, "[^A-Za-z]+", " ")


def words(text: Column) -> Column:
    """Lower-case words of ASCII letters, in text order."""
    return F.filter(F.split(F.lower(letters_only(text)), " "), lambda w: w != "")


def chars(text: Column) -> Column:
    return F.filter(F.split(text, ""), lambda c: c != "")


def space_punctuation(text: Column) -> Column:
    """Lower-case; no-break spaces as spaces; a space before , ! . unless there is one or it comes first.

    The rule is applied twice because a match consumes the character before it.
    """
    plain = F.lower(F.translate(text, NO_BREAK_SPACES, "  "))
    once = F.regexp_replace(plain, "([^ ])([,!.])", "$1 $2")
    return F.regexp_replace(once, "([^ ])([,!.])", "$1 $2")


def ellipsis(text: Column, n: int) -> Column:
    return F.when(F.length(text) > n, F.concat(F.left(text, F.lit(n)), F.lit("..."))).otherwise(text)


def snake_case(text: Column) -> Column:
    return F.lower(F.trim(F.regexp_replace(text, "[^a-zA-Z0-9]+", "_"), F.lit("_")))


def two_decimals(x: Column) -> Column:
    """Two decimals, rounded by the exact binary value as C and Python do (format_string rounds the shortest decimal)."""
    return F.translate(F.format_number(x, 2), ",", "")


# fixed values: decimal size units
SIZE_UNITS = ((1e12, "TB"), (1e9, "GB"), (1e6, "MB"))


def human_size(size: Column) -> Column:
    """Decimal KB, MB, GB or TB with two decimals."""
    show = lambda unit, tag: F.concat(two_decimals(size / F.lit(unit)), F.lit(f" {tag}"))
    out = show(1e3, "KB")
    for unit, tag in reversed(SIZE_UNITS):
        out = F.when(size >= unit, show(unit, tag)).otherwise(out)
    return out


# fixed values: split names in shard file names and the names they are folded into
SPLIT_PREFIXES = ("all", "train", "validation", "val", "test", "dev", "training", "eval")
SPLIT_ALIASES = {"validation": "val", "training": "train", "eval": "test"}


def split_name(file_name: Column) -> Column:
    """Split of a shard file: the prefix before -<digits>, folded to its usual name, else the file stem."""
    found = F.regexp_extract(file_name, f"^({'|'.join(SPLIT_PREFIXES)})-[0-9]+", 1)
    alias = F.create_map(*[F.lit(x) for pair in SPLIT_ALIASES.items() for x in pair])
    stem = F.regexp_replace(file_name, r"\.parquet", "")
    return F.when(found == "", stem).otherwise(F.coalesce(F.try_element_at(alias, found), found))


def decode_utf8(raw: Column) -> Column:
    """Bytes as text; bytes that are not UTF-8 become the replacement character."""
    return F.decode(F.make_valid_utf8(raw.cast("string")).cast("binary"), "UTF-8")
