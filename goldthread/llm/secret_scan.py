"""Secrets in texts by one combined deterministic automaton."""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from goldthread.llm.automaton import ENDS, arrays, choice, dead, hits, longest, many, maybe, one, seq, word
from goldthread.llm.common import bound_batches, slices, text_of

LOWER, UPPER, DIGITS = "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789"
ALNUM = LOWER + UPPER + DIGITS
VALUE, HEX, TOKEN = one(ALNUM + "+/_.=-"), one(DIGITS + "abcdef"), one(ALNUM)
_KEY = choice(*[word(w, any_case=True) for w in ("password", "passwd", "secret", "token", "apikey", "api_key")])
_QUOTE, _SPACES = maybe(one("\"'")), many(one(" "))
_ASSIGN = seq(_KEY, _QUOTE, _SPACES, one(":="), _SPACES, _QUOTE)

#: Kind, the term of a match, the term that the combined automaton looks for (None: the same), and least lengths of
#: match and value. What the combined automaton looks for is in every match that counts; it tells texts to read again.
RULES = [
    ("assign", seq(_ASSIGN, many(VALUE, 1)), seq(_ASSIGN, many(VALUE, 8)), 0, 8),
    ("access", seq(word("AKIA"), many(one(UPPER + DIGITS), 1)), seq(word("AKIA"), many(one(UPPER + DIGITS), 1)), 16, 0),
    ("hex", many(HEX, 1), many(HEX, 32), 32, 0),
    ("private_key", seq(word("-----BEGIN "), many(one(UPPER + " ")), word("PRIVATE KEY-----")), None, 0, 0),
    ("code_host", seq(word("gh"), one("pousr"), word("_"), many(TOKEN, 20)),
     seq(word("gh"), one("pousr"), word("_"), TOKEN), 0, 0),
    ("chat", seq(word("xox"), one("abprs"), word("-"), many(one(ALNUM + "-"), 10)),
     seq(word("xox"), one("abprs"), word("-"), TOKEN), 0, 0),
]
KINDS = [r[0] for r in RULES]
BASE = 3


class Scanner:
    """The combined automaton, and one anchored automaton per rule for exact bounds."""

    def __init__(self):
        self.any = arrays([full or term for _, term, full, _, _ in RULES], anywhere=True, keep_hit=True)
        self.rules = [arrays([term], anywhere=False) for _, term, *_ in RULES]
        self.stops = [dead(start) for start in self.rules]
        self.begins = [[i for i, (s, d) in enumerate(zip(self.rules, self.stops)) if s[b] is not d] for b in range(256)]

    def spans(self, data: bytes) -> list[tuple[int, int, int]]:
        """``(start, kind, end)`` in bytes: per kind the leftmost matches that do not overlap, long enough ones only."""
        if not hits(self.any, data):
            return []
        free, found = [0] * len(RULES), []
        for at, byte in enumerate(data):
            for rule in self.begins[byte]:
                if at >= free[rule]:
                    first, last = longest(self.rules[rule], self.stops[rule], data, at)
                    if last > 0:
                        free[rule] = last
                        _, _, _, least, value = RULES[rule]
                        # The first end is behind the first character of the value.
                        if last - at >= least and last - first + 1 >= value:
                            found.append((at, rule, last))
        return sorted(found)


_SCANNER: list[Scanner] = []


def _scanner() -> Scanner:
    if not _SCANNER:
        _SCANNER.append(Scanner())
    return _SCANNER[0]


def char_spans(data: bytes) -> list[tuple[int, int, int]]:
    """The spans of a text in code points."""
    spans = _scanner().spans(data)
    if spans and not data.isascii():
        at = np.concatenate([[0], np.cumsum((np.frombuffer(data, np.uint8) & 0xC0) != 0x80)])
        spans = [(int(at[s]), k, int(at[e])) for s, k, e in spans]
    return spans


def scan_secrets(docs: DataFrame) -> DataFrame:
    """``doc_id`` and ``found``, an array of ``kind, start, end`` in code points, for every row of ``docs``.

    The rules are compiled into one automaton by subset construction and minimisation; a text takes one
    table step per byte for all rules. Only texts in which a rule ends are read again for exact bounds:
    per kind the leftmost matches without overlap, of which those that are too short are dropped.

    A null or empty text has no spans; a null ``doc_id`` stays null; repeated rows are scanned each on its
    own; other columns are ignored; an empty table gives no rows. Spans of two kinds may overlap.
    """
    bound_batches(docs.sparkSession)
    item = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())])

    def scan(batches):
        for batch in batches:
            for part in slices(batch):
                found = [[{"kind": KINDS[k], "start": s, "end": e} for s, k, e in char_spans(d)]
                         for d in pc.cast(text_of(part), pa.large_binary()).to_pylist()]
                yield pa.RecordBatch.from_pydict({"doc_id": part.column("doc_id"), "found": pa.array(found, pa.list_(item))})

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(
        scan, f"doc_id {kind}, found array<struct<kind:string,start:bigint,end:bigint>>")


def secret_digest(docs: DataFrame) -> DataFrame:
    """Counts per base kind, the digest of the base spans and all spans as text; see ``scan_secrets``."""

    def joined(column):
        return F.array_join(F.transform(column, lambda x: F.concat_ws(":", x["kind"], x["start"], x["end"])), ",")

    def of(*kinds):
        return F.filter("found", lambda x: x["kind"].isin(*kinds))

    base = of(*KINDS[:BASE])
    counts = [F.size(of(k)).cast("long").alias(f"n_{k}") for k in KINDS[:BASE]]
    return scan_secrets(docs).select(
        "doc_id", *counts, F.sha2(joined(base), 256).alias("base_sha256"), joined(F.col("found")).alias("spans"))


def redact_secrets(docs: DataFrame, mark: str = "[secret]") -> DataFrame:
    """``docs`` with every span of a secret replaced by ``mark``, and ``n_chars`` counted anew.

    Rows without a secret are returned as they are, nulls included; no row is dropped.
    """
    bound_batches(docs.sparkSession)
    place = docs.columns.index("text")

    def clean(data: bytes) -> str | None:
        out, done = [], 0
        for start, _, end in _scanner().spans(data):
            if start >= done:
                out += [data[done:start], mark.encode()]
            done = max(done, end)
        return (b"".join(out) + data[done:]).decode() if out else None

    def redact(batches):
        for batch in batches:
            for part in slices(batch):
                text = part.column(place)
                new = pa.array([clean(d) for d in pc.cast(text_of(part), pa.large_binary()).to_pylist()], text.type)
                yield part.set_column(place, part.schema.field(place), pc.coalesce(new, text))

    kept = docs.mapInArrow(redact, docs.schema)
    if "n_chars" not in docs.columns:
        return kept
    kind = docs.schema["n_chars"].dataType
    changed = F.col("n_chars").isNotNull() & F.col("text").isNotNull()
    return kept.withColumn("n_chars", F.when(changed, F.char_length("text").cast(kind)).otherwise(F.col("n_chars")))
