"""Small tables with every awkward kind of row, and plain versions of the operators."""

from __future__ import annotations

import random
import re

DOC_SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, __score double, __found string, __row long"


def prose(seed: int, words: int, vocabulary: int = 4000) -> str:
    pick = random.Random(seed)
    out = []
    for i in range(words):
        syllables = [pick.choice("ka lo mi ten ur sha bri vo nde pal".split()) for _ in range(1 + pick.randrange(vocabulary) % 4)]
        word = "".join(syllables)
        out.append(word.capitalize() if i % 12 == 0 else word + "." * (i % 12 == 11))
    return " ".join(out)


def odd_documents(spark, *more: str):
    """Nulls in any column, empty, blank and very long texts, ties, repeated rows, and extra columns with odd names."""
    texts = [None, "", "   \n ", "a", "one two three", prose(1, 40), prose(1, 40), prose(2, 12_000), "ÄÖ ßü 漢字 — ﬁ é", *more]
    rows = [(i, t, None if i % 2 else "en", "hot" if i % 3 else None, None if t is None else len(t), None, "f", i) for i, t in enumerate(texts)]
    rows += [rows[5], rows[5], (None, prose(3, 30), None, None, None, 0.5, None, 1), (None,) * 8]
    return stable(spark, spark.createDataFrame(rows, DOC_SCHEMA))


def stable(spark, df):
    """The rows as files: operators that number rows need a source that gives them alike each time."""
    from goldthread.llm.common import shared_path

    path = shared_path(spark, "fixture")
    df.write.parquet(path)
    return spark.read.parquet(path)


def shingles(text: str | None, n: int = 5) -> set[tuple[str, ...]]:
    words = re.findall(r"[a-z0-9\x80-\U0010ffff]+", (text or "").lower())
    return {tuple(words[i:i + n]) for i in range(max(len(words) - n + 1, min(1, len(words))))}


def jaccard(a: set, b: set) -> float:
    return len(a & b) / len(a | b) if a | b else 0.0
