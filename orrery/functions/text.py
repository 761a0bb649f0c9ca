"""String, path and address functions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# File extensions accepted as labelled images.
IMAGE_EXTENSIONS = [".jpg", ".jpeg", ".png", ".bmp", ".gif", ".ppm"]

# Strings pandas reads as missing.
MISSING_TOKENS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
]

# Unicode white space plus the four separators str.strip() also removes.
_SPACE = r"[\s\x1c-\x1f]"
_EDGE_SPACE = rf"(?U)^{_SPACE}+|{_SPACE}+\z"
# Last dot of the last path element, when a non-dot character precedes it there.
_EXTENSION = r"[^./][^/]*(\.[^./]*)$"
_OCTET = r"^0*(?:25[0-5]|2[0-4][0-9]|[01]?[0-9]?[0-9])\z"


def strip(c: Column) -> Column:
    """Trim all Unicode white space (Spark's ``trim`` drops spaces only)."""
    return F.regexp_replace(c, _EDGE_SPACE, "")


def has_text(c: Column) -> Column:
    return F.coalesce(strip(c) != "", F.lit(False))


def null_tokens(c: Column) -> Column:
    """NULL for every string that pandas treats as missing."""
    return F.when(c.isin(MISSING_TOKENS), F.lit(None)).otherwise(c)


def extension(c: Column) -> Column:
    """Lower-case file extension with its dot, '' when there is none."""
    return F.lower(F.regexp_extract(c, _EXTENSION, 1))


def image_pattern() -> str:
    """Glob for file names with an accepted extension in any case."""
    return "*.{" + ",".join("".join(f"[{c}{c.upper()}]" for c in e[1:]) for e in IMAGE_EXTENSIONS) + "}"


def is_image_name(c: Column) -> Column:
    return extension(c).isin(IMAGE_EXTENSIONS)


def basename(c: Column) -> Column:
    return F.element_at(F.split(c, "/"), -1)


def join_path(*parts: Column) -> Column:
    return F.concat_ws("/", *parts)


def split_list(c: Column) -> Column:
    """Comma-separated text to an array of trimmed, non-empty items."""
    return F.filter(F.transform(F.split(c, ","), strip), lambda item: item != "")


def is_ipv4(c: Column) -> Column:
    octets = F.split(c, r"\.", -1)
    return (F.size(octets) == 4) & F.forall(octets, lambda part: part.rlike(_OCTET))
