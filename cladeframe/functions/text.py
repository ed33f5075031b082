"""Text rules as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MISSING = "NA"


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def clean(c: str | Column) -> Column:
    """Trimmed text; NA where nothing is left."""
    return F.coalesce(F.nullif(F.trim(col(c)), F.lit("")), F.lit(MISSING))


def root(c: str | Column) -> Column:
    """An accession without its version."""
    return F.substring_index(col(c), ".", 1)


def basename(c: str | Column) -> Column:
    return F.substring_index(col(c), "/", -1)


def plain_path(c: str | Column) -> Column:
    """A path as Spark reports it, without the codes of blanks and other marks."""
    return F.url_decode(F.replace(col(c), F.lit("+"), F.lit("%2B")))


def genome_name(c: str | Column) -> Column:
    """The last part of a path, without .gz and one extension."""
    return F.regexp_replace(F.regexp_replace(basename(c), r"\.gz$", ""), r"\.[^.]+$", "")


def label_text(c: str | Column, species: bool = False) -> Column:
    """Blanks, parentheses and slashes (of species, dots too) become underscores, pairs of underscores single ones, once; one at
    the end goes, and so do brackets, quotes and semicolons."""
    marks = " ()/." if species else " ()/"
    text = F.translate(col(c), marks, "_" * len(marks))
    text = F.regexp_replace(F.regexp_replace(text, "__", "_"), "_$", "")
    return F.translate(text, "[]';", "")


def screen_label(c: str | Column) -> Column:
    """Tree formats' special characters become underscores, runs of which become one."""
    return F.regexp_replace(F.translate(col(c), "[]:,; ", "______"), "_+", "_")


def strip_stops(c: str | Column) -> Column:
    """Split and joined, where there is one: replace() compares at every byte, translate() takes every letter by itself."""
    return F.when(F.contains(col(c), F.lit("*")), F.array_join(F.split(col(c), r"\*", -1), "")).otherwise(col(c))


def base_link(path: str | Column, accession: str | Column, name: str | Column, base: str) -> Column:
    """Where an assembly's files are: the catalog's own path over https, else one made from the accession and the name, else na."""
    path, accession, name = col(path), col(accession), col(name)
    known = F.regexp_replace(F.regexp_replace(path, "^ftp://", "https://"), "/+$", "")
    tidy = F.trim(F.regexp_replace(F.regexp_replace(name, r"[\s/,#()\[\]]", "_"), "_+", "_"), F.lit("_"))
    parts = [F.substring(accession, 1, 3), F.substring(accession, 5, 3), F.substring(accession, 8, 3), F.substring(accession, 11, 3)]
    made = F.concat_ws("/", F.lit(base), *parts, F.concat_ws("_", accession, tidy))
    given = lambda c: c.isNotNull() & ~F.lower(F.trim(c)).isin("", "na")
    return F.when(given(path), known).when(given(accession) & given(name) & accession.rlike(r"^GC[AF]_\d{9}"), made).otherwise("na")
