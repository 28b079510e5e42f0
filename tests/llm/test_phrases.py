"""Collocations against a plain count of all phrases."""

from __future__ import annotations

import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from fixtures import odd_documents, prose, stable

from goldthread.llm import phrases
from goldthread.llm.phrases import Seen, Tokens, collocations


def plain_collocations(docs, least: int = 30, top: int = 2000) -> list[tuple]:
    counts, totals = Counter(), Counter()
    for text, lang in docs:
        lang = "und" if lang is None else lang
        lower = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lower):
            words = re.findall(r"[^\x20\x09]+", piece)
            totals[lang] += len(words)
            counts.update((lang, *words[i:i + k]) for k in range(1, 5) for i in range(len(words) - k + 1))
    candidates = {g: a for g, a in counts.items() if len(g) > 2 and a >= least}
    gone = {(g[0], *g[i:j]) for g, f in candidates.items() for i in range(1, len(g)) for j in range(i + 2, len(g) + 1)
            if j - i < len(g) - 1 and 100 * f >= 80 * candidates[(g[0], *g[i:j])]}
    rows = []
    for (lang, *words), a in candidates.items():
        if (lang, *words) in gone:
            continue
        cuts = [(2_000_000 * a // (l + r), k, l, r) for k in range(1, len(words))
                for l, r in [(counts[lang, *words[:k]], counts[lang, *words[k:]])]]
        score, _, l, r = min(cuts)
        rows.append((lang, -score, -a, " ".join(words).encode(), l, r))
    out, ranks = [], Counter()
    for lang, score, a, phrase, l, r in sorted(rows):
        ranks[lang] += 1
        if ranks[lang] <= top:
            out.append((lang, ranks[lang], phrase.decode(), -a, l, r, totals[lang], -score))
    return out


def spoken(seed: int, texts: int) -> list[tuple]:
    pick = random.Random(seed)
    vocabulary = ["the", "of", "New", "york", "CITY", "a", "b", "in", "é", "漢字", "x y", "Ångström", "I'm"] + [f"w{i}" for i in range(40)]
    fixed = ["new york city hall", "The  cat\tsat on", "a a a a a", "of the", "terms and conditions apply here"]
    out = []
    for _ in range(texts):
        parts = [pick.choice(fixed) if pick.random() < 0.3 else pick.choice(vocabulary[:8 + pick.randrange(45)]) for _ in range(pick.randrange(60))]
        text = "".join(p + pick.choice([" ", " ", " ", "  ", "\t", ", ", ".\n", " ? ", "\x0b", "\r\n", ""]) for p in parts)
        out.append((text, pick.choice(["en", "en", "en", "de", None, "und", ""])))
    return out


def rows_of(spark, texts, least=30, top=2000):
    frame = stable(spark, spark.createDataFrame([(t, x, 1, "z") for t, x in texts], "text string, lang string, n long, word string").repartition(3))
    got = [tuple(r[c] for c in ("lang", "rank", "phrase", "a", "l", "r", "n", "score")) for r in collocations(frame, least, top).collect()]
    return sorted(got)


@pytest.mark.parametrize("seed,least,top", [(1, 30, 2000), (2, 3, 40), (3, 1, 10_000), (4, 300, 2000)])
def test_equal_to_plain_counts(spark, seed, least, top):
    texts = spoken(seed, 250)
    want = plain_collocations(texts, least, top)
    assert rows_of(spark, texts, least, top) == sorted(want) and (want or least > 100)


def test_odd_documents(spark):
    docs = odd_documents(spark, *["same words in a row. same words in a row"] * 40, prose(8, 9000))
    texts = [(r.text, r.lang) for r in docs.collect()]
    got = sorted(tuple(r) for r in collocations(docs).collect())
    assert got == sorted(plain_collocations(texts)) and got


def test_blocks_and_cut_stripes(monkeypatch):
    """Small blocks, every word very common, and a filter that lets everything through give the same counts."""
    texts = spoken(7, 80)
    batch = pa.RecordBatch.from_pydict({"text": [t for t, _ in texts], "lang": [x for _, x in texts]})
    texts += [("".join(t for t, _ in texts[:30]), "en")]
    batch = pa.RecordBatch.from_pydict({"text": [t for t, _ in texts], "lang": [x for _, x in texts]})
    monkeypatch.setattr(phrases, "BLOCK", 500)
    counts = Counter()
    for tokens in phrases._blocks([batch]):
        wide = set(tokens.hashes(np.arange(len(tokens.starts)), 1).tolist())
        for m in (1, 2, 3):
            made = phrases._stripes(tokens, m, np.flatnonzero(tokens.whole(m + 1)), wide)
            for row in made.to_pylist() if made else []:
                assert row["part"] > 0 and row["words"] == m
                counts.update({(row["lang"], *row["prefix"].split(" "), e["word"]): e["n"] for e in row["stripe"]})
    want = Counter()
    for text, lang in texts:
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", re.sub("[A-Z]", lambda m: m.group().lower(), text)):
            words = re.findall(r"[^\x20\x09]+", piece)
            for m in (1, 2, 3):
                want.update(("und" if lang is None else lang, *words[i:i + m + 1]) for i in range(len(words) - m))
    assert counts == want


def test_stripes_are_packed_small():
    texts = spoken(3, 400)
    batch = pa.RecordBatch.from_pydict({"text": pa.array([r[0] for r in texts], pa.string()), "lang": pa.array([r[1] for r in texts], pa.string())})
    plain, packed = [], []
    for tokens in phrases._blocks([batch]):
        for m in range(1, phrases.LONGEST):
            made = phrases._stripes(tokens, m, np.flatnonzero(tokens.whole(m + 1)), set())
            plain.append(made)
            packed.append(phrases._packed(made, 4))
    key = lambda r: (r["lang"], r["prefix"], r["part"])
    rows = sorted((r for b in phrases._unpacked(packed) for r in b.to_pylist()), key=key)
    assert rows == sorted((r for b in plain for r in b.to_pylist()), key=key) and len(rows) > 100
    # A prefix is in the same part wherever it was packed.
    owner = {}
    for batch in packed:
        for row in batch.to_pylist():
            for made in phrases._unpacked([pa.RecordBatch.from_pylist([row])]):
                assert all(owner.setdefault((r["prefix"], r["part"]), row["packed"]) == row["packed"] for r in made.to_pylist())
    assert sum(len(x) for b in packed for x in b.column("rows").to_pylist()) < 0.5 * sum(b.nbytes for b in plain)


def test_equal_hashes_are_told_apart(monkeypatch):
    tokens = Tokens(pa.array(["a b a c b a"], pa.large_string()), ["en"])
    monkeypatch.setattr(Tokens, "hashes", lambda self, at, words: np.zeros(len(at), np.uint64))
    number, first = phrases._grouped(tokens, np.arange(6), 1)
    assert len(first) == 3 and [tokens.texts(first[[n]], 1)[0].as_py() for n in number] == list("abacba")


def test_filter_holds_what_it_was_given(spark):
    given = [("en", f"w{i} x") for i in range(3000)]
    seen = phrases.seen_filter(phrases.word_hashes(spark.createDataFrame(given, "lang string, word string"), 40), 40)
    assert isinstance(seen, Seen) and seen.has(phrases._phrase_hash(*map(list, zip(*given)))).all()
    assert phrases.seen_filter(spark.range(0).withColumnRenamed("id", "gram"), 38).size >= 1 << 16
    other = phrases._phrase_hash(["en"] * 3000, [f"y{i} z" for i in range(3000)])
    assert seen.has(other).mean() < 0.2


def test_scores_past_64_bits(spark):
    rows = [(9 * 10**18, 9 * 10**18, 9 * 10**18), (5 * 10**12 + 1, 10**13, 7), (1, 3, 3), (30, 30, 31)]
    got = [r.x for r in spark.createDataFrame(rows, "a long, l long, r long").select(phrases._score().alias("x")).collect()]
    assert got == [2_000_000 * a // (l + r) for a, l, r in rows]


def test_no_rows(spark):
    empty = spark.createDataFrame([], "text string, lang string")
    assert collocations(empty).count() == 0
    assert collocations(spark.createDataFrame([(None, None), ("", "en"), (" . ", "en")], "text string, lang string")).count() == 0


def test_query_equals_sql(spark):
    from compare import compare

    from goldthread.llm.queries import ORACLES, QUERIES
    for name, sql in ORACLES.items():
        compare(spark, QUERIES[name], sql, "/root/testdata/sf0.001")
