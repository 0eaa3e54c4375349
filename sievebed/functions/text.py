"""Text expressions: strip, lines, URL join, labelled fields."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, functions as F

from sievebed.fixed_values import INDUSTRY_LABEL

# What Python's ``str.strip`` takes as white space, no-break spaces included.
_WHITE_SPACE = "".join(chr(code) for code in range(0x3001) if chr(code).isspace())


def strip(text: Column) -> Column:
    """Remove Unicode white space from both ends."""
    return F.btrim(text, F.lit(_WHITE_SPACE))


def nonblank_lines(text: Column) -> Column:
    """Stripped lines of a text, without the blank ones."""
    return F.filter(F.transform(F.split(text, "\n"), strip), lambda line: line != "")


def prefix(text: Column, separator: str = "-") -> Column:
    """Text before the first separator, or all of it."""
    return F.split_part(text, F.lit(separator), F.lit(1))


def url_join(*segments: Column | str) -> Column:
    """Join segments with exactly one slash at each seam; at most one slash per side is removed."""
    columns = [F.lit(s) if isinstance(s, str) else s for s in segments]
    return reduce(
        lambda left, right: F.concat(
            F.regexp_replace(left, r"/\z", ""), F.lit("/"), F.regexp_replace(right, r"\A/", "")
        ),
        columns,
    )


def grade_before(text: Column, label: str) -> Column:
    """Letter A-F joined by a no-break space to a label, any case; null when there is none."""
    pattern = rf"([A-Fa-f])\x{{A0}}(?iu:\Q{label}\E)"
    return F.nullif(F.regexp_extract(text, pattern, 1), F.lit(""))


def text_after(text: Column, label: str = INDUSTRY_LABEL) -> Column:
    """Rest of the line after a label, any case; the whole text when the label is absent."""
    pattern = rf"(?iud)\Q{label}\E(.*)"
    return F.when(F.regexp_like(text, F.lit(pattern)), F.regexp_extract(text, pattern, 1)).otherwise(text)


def in_domain(value: Column, domain: tuple[str, ...]) -> Column:
    """True for null and for the members of a closed domain."""
    return value.isNull() | value.isin(*domain)


def at_or_null(items: Column, index: int) -> Column:
    """Element by position from 0; null past the end."""
    return F.get(items, F.lit(index))


def at_or_error(items: Column, index: int) -> Column:
    """Element by position from 0; past the end the query fails."""
    message = F.concat(F.lit(f"no element {index} in an array of "), F.size(items).cast("string"))
    return F.when(F.size(items) > index, F.get(items, F.lit(index))).otherwise(F.raise_error(message))
