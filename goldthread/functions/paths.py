"""Path spellings used by mapping rows: ``a.b``, ``a['b']``, ``a["b"]``, ``a[b]``."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from goldthread.functions.text import strip

# Fixed value: one bracketed step, quoted or bare. Valid in Python and in Java regular expressions.
BRACKET_STEP = r"""\[(?:'([^']+)'|"([^"]+)"|([^\]]+))\]"""


def split_path(path: str | None) -> list[str]:
    """Steps of a mapping path. A dot inside a bracketed step still separates steps."""
    if not path:
        return []
    dotted = re.sub(BRACKET_STEP, lambda m: "." + next(g for g in m.groups() if g), path.strip())
    return [step for step in map(str.strip, dotted.split(".")) if step]


def split_path_column(path: Column) -> Column:
    """``split_path`` for a whole column of paths; null gives an empty array."""
    dotted = F.regexp_replace(strip(path), BRACKET_STEP, r".$1$2$3")
    steps = F.transform(F.split(dotted, r"\."), strip)
    return F.coalesce(F.filter(steps, lambda s: s != ""), F.array().cast("array<string>"))


def strict_path(path: str | None) -> list[str]:
    """Steps of a path where only dots separate and brackets have no meaning."""
    return path.split(".") if path else []


def last_segment(path: Column) -> Column:
    """Text after the last dot."""
    return F.element_at(F.split(path, r"\."), -1)
