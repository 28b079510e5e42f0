"""Date and time formats in ``%`` notation, compiled to Spark patterns with a shape guard.

A failing Spark parse throws and catches an exception inside the task, which is far dearer than a
regular expression. So a pattern is only tried on text that has the format's shape.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

# The default format lists, first match wins.
DATE_FORMATS = ("%Y-%m-%d", "%d/%m/%Y", "%Y/%m/%d")
TIMESTAMP_FORMATS = (
    "%Y-%m-%d %H:%M:%S.%f",
    "%Y-%m-%d %H:%M:%S",
    "%Y-%m-%dT%H:%M:%S.%f",
    "%Y-%m-%dT%H:%M:%S",
)

# Directive -> (Spark pattern letters, shape).
DIRECTIVES = {
    "Y": ("yyyy", r"(?!0000)\d{4}"),
    "m": ("M", r"\d{1,2}"),
    "d": ("d", r"\d{1,2}"),
    "H": ("H", r"\d{1,2}"),
    "I": ("h", r"\d{1,2}"),
    "p": ("a", r"(?i:am|pm)"),
    "M": ("m", r"\d{1,2}"),
    "S": ("s", r"\d{1,2}"),
    "f": ("SSSSSS", r"\d{1,6}"),
    "b": ("MMM", r"[A-Za-z]{3}"),
    "B": ("MMMM", r"[A-Za-z]+"),
    "j": ("D", r"\d{1,3}"),
}
WORDS = "pbB"


@dataclass(frozen=True)
class ParseFormat:
    pattern: str
    shape: str
    # Whether text of nothing but digits and a sign can fit.
    digits_only: bool


def compile_format(text: str) -> ParseFormat:
    """Numbers next to each other (``%Y%m%d``) have their full width, others may lack a leading zero."""
    tokens = [
        ("", " ") if blank else (directive if directive != "%" else "", other or "%")
        for directive, blank, other in re.findall(r"%(.)|(\s+)|(.)", text, flags=re.DOTALL)]
    pattern, shape, literal = "", "", ""
    for i, (directive, char) in enumerate([*tokens, ("", "")]):
        if not directive and char:
            literal += char
            shape += re.escape(char)
            continue
        if literal:
            quoted = re.search(r"[A-Za-z'\[\]{}#]", literal)
            pattern += "'" + literal.replace("'", "''") + "'" if quoted else literal
            literal = ""
        if directive:
            if directive not in DIRECTIVES:
                raise ValueError(f"unsupported directive %{directive} in format {text!r}")
            letters, fits = DIRECTIVES[directive]
            neighbours = tokens[max(i - 1, 0):i] + tokens[i + 1:i + 2]
            if fits == r"\d{1,2}" and any(d and d not in WORDS for d, _ in neighbours):
                letters, fits = letters * 2, r"\d{2}"
            pattern += letters
            shape += fits
    literals = [char for directive, char in tokens if not directive]
    words = any(directive in WORDS for directive, _ in tokens if directive)
    return ParseFormat(pattern, f"^{shape}$", not words and all(char in "+-0123456789" for char in literals)
                       and not any(char in "+-" for char in literals[1:]))


def single_blanks(text: Column) -> Column:
    """Every run of white space as one blank: a blank in a format stands for any run."""
    return F.when(text.rlike(r"\s\s|[\t\n\r\x0b\x0c]"), F.regexp_replace(text, r"\s+", " ")).otherwise(text)


def parse_first(text: Column, formats, parse) -> Column:
    """First format that fits the whole text; ``parse(text, pattern)`` builds the value."""
    compiled = [compile_format(source) for source in formats]
    return F.coalesce(*[F.when(text.rlike(f.shape), parse(text, f.pattern)) for f in compiled])
