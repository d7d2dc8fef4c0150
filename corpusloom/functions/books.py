"""Book bodies as Column builders: blocks, chapters, prefaces, kinds of units."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from corpusloom.functions.text import stripped

CUT = "\u0001"


def normalized_block(block: Column) -> Column:
    """The lines of a block as one, with blanks between; verse and letters, most lines of which are indented, keep their lines."""
    lines = F.split(F.regexp_replace(block, r"^\n+|\s+$", ""), "\n")
    indented = F.size(F.filter(lines, lambda x: F.regexp_like(x, F.lit(r"^\s{3,}\S"))))
    keeps = (F.size(lines) > 1) & (indented >= F.greatest(F.lit(1), F.floor(F.size(lines) / 2)))
    full = F.filter(F.transform(lines, stripped), lambda x: x != "")
    return F.when(keeps, F.array_join(full, "\n")).otherwise(F.array_join(full, " "))


def blocks(text: Column) -> Column:
    """What stands between blank lines, without empty ones."""
    return F.filter(F.transform(F.split(text, r"\n\s*\n+"), normalized_block), lambda b: b != "")


def chapters(text: Column, heading: str, last: int | None = None) -> Column:
    """The text from each match of heading to the next one; with last, from the last so many matches only.

    Null if there are fewer than two."""
    parts = F.split(F.regexp_replace(text, f"(?m){heading}", f"{CUT}$0"), CUT)
    found = F.slice(parts, 2, F.greatest(F.size(parts) - 1, F.lit(0)))
    kept = found if last is None else F.slice(found, F.greatest(F.size(found) - last + 1, F.lit(1)), F.lit(last))
    return F.when(F.size(found) >= 2, kept)


def preface(text: Column, marker: str, heading: str) -> Column:
    """What stands between a literal marker and the first heading; null without the marker."""
    front = F.element_at(F.split(F.regexp_replace(text, f"(?m){heading}", CUT), CUT), 1)
    at = F.instr(front, F.lit(marker))
    return F.when(at > 0, stripped(F.substring(front, at + len(marker), F.length(front))))


def section(text: Column, start: str, end: str | None = None, with_start: bool = False, least: int = 1000) -> Column:
    """What stands from one literal marker to another (or the end); null if a marker is missing or it is shorter than least."""
    at = F.instr(text, F.lit(start))
    rest = F.substring(text, at + (0 if with_start else len(start)), F.length(text))
    if end is None:
        found = F.when(at > 0, rest)
    else:
        stop = F.instr(rest, F.lit(end))
        found = F.when((at > 0) & (stop > 0), F.substring(rest, F.lit(1), stop - 1))
    return F.when(F.length(stripped(found)) >= least, stripped(found))


def kind(piece: Column, emitted: Column, block: Column, most: int = 140) -> Column:
    """heading for a short block of one line among a chapter's first three pieces; continuation after a block's first piece."""
    short = (emitted < 3) & (F.length(block) < most) & ~F.contains(block, F.lit("\n"))
    return F.when(piece > 0, "continuation").when(short, "heading").otherwise("paragraph")


def copied_heading(source: Column) -> Column:
    """Roman numerals are copied, not translated."""
    return F.regexp_like(source, F.lit(r"^(?i)[IVXLCDM]+\.?$"))
