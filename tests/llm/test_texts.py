"""Repeated spans, near-duplicates, decontamination, secrets and quality against plain versions."""

from __future__ import annotations

import hashlib
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from fixtures import jaccard, odd_documents, prose, shingles, stable
from hypothesis import given, settings
from hypothesis import strategies as st

from goldthread.llm import components as connected
from goldthread.llm import decontaminate, near_duplicates, quality, repeated_spans, secret_scan
from goldthread.llm.decontaminate import FOUND, contamination, decontaminated, with_items
from goldthread.llm.near_duplicates import without_near_duplicates
from goldthread.llm.words import divided, shingles_of, words_of


def by_id(rows):
    return sorted((tuple(r) for r in rows), key=lambda r: tuple((x is not None, x) for x in r))


# --- words -----------------------------------------------------------------------------------

@settings(deadline=None)
@given(st.lists(st.text(st.sampled_from("ab Z1.é漢\n-"), max_size=40), max_size=6))
def test_words_and_shingles(texts):
    words = words_of(pa.array(texts, pa.large_string()))
    plain = [re.findall(r"[a-z0-9\x80-\U0010ffff]+", t.lower()) for t in texts]
    flat = [w for t in plain for w in t]
    assert len(flat) == len(words.hashes)
    assert len({*zip(flat, words.hashes.tolist())}) == len(set(flat)) == len(set(words.hashes.tolist()))
    h, text = shingles_of(words)
    assert np.bincount(text, minlength=len(texts)).tolist() == [max(len(p) - 4, min(1, len(p))) for p in plain]
    assert len(set(h.tolist())) == len(set().union(*map(shingles, texts)))


def test_words_of_all_scripts():
    """Marks beyond ASCII divide words, and scripts written without spaces have words of one character."""
    pick = random.Random(5)
    han = "".join(chr(pick.randrange(0x4E00, 0x9FA5)) + "，" * (i % 9 == 8) for i in range(120))
    thai = "".join(chr(pick.randrange(0x0E01, 0x0E2F)) for _ in range(120))
    texts = ["a\u3000b\u00a0c—d “e”, f’s\u2003g。h", "コーヒー café", han, han[:60] + "啊" + han[61:], thai, thai[:60] + "x" + thai[61:]]
    plain = [re.findall(r"[a-zé]+|[0-9]+|[\u0e01-\u0e2e\u3041-\u30ff\u4e00-\u9fff]", t.lower()) for t in texts]
    words = words_of(divided(pa.array(texts, pa.large_string())))
    assert np.diff(words.first).tolist() == [len(p) for p in plain] and plain[0] == list("abcdefsgh")
    h, text, _ = near_duplicates.elements(words)
    sets = [set(h[text == i].tolist()) for i in range(len(texts))]
    for i in range(len(texts)):
        for j in range(i):
            a, b = ({tuple(p[k:k + 5]) for k in range(max(len(p) - 4, 1))} for p in (plain[i], plain[j]))
            assert jaccard(sets[i], sets[j]) == jaccard(a, b)
    assert jaccard(sets[2], sets[3]) >= 0.8 and jaccard(sets[4], sets[5]) >= 0.8
    assert found_in(han[20:60], han, "x" + han[20:59], han[:30]) == [True, True, False]


# --- repeated spans --------------------------------------------------------------------------

def plain_spans(texts, length):
    data = [(t or "").encode() for t in texts]
    seen = Counter(d[i:i + length] for d in data for i in range(len(d) - length + 1))
    out = []
    for d in data:
        gone = np.zeros(len(d) + 1, int)
        for i in range(len(d) - length + 1):
            if seen[d[i:i + length]] > 1:
                gone[i:i + length] = 1
        kept = bytes(b for b, g in zip(d, gone) if not g)
        out.append((len(d), int(gone.sum()), int((np.diff(np.concatenate([[0], gone])) == 1).sum()), hashlib.sha256(kept).hexdigest()))
    return out


@pytest.mark.parametrize("hot", [4096, 2])
def test_repeated_spans(spark, monkeypatch, hot):
    monkeypatch.setattr(repeated_spans, "SORTED_RUNS", hot)
    passage, other = prose(50, 60), prose(51, 45)
    more = [prose(i, 30) + passage[i:] + prose(100 + i, 20) for i in range(6)] + ["ab" * 400, "x" * 199, "y" * 200, "y" * 201]
    more += [other + " " + other, prose(9, 50) + other[3:-3]]
    docs = odd_documents(spark, *more)
    rows = docs.collect()
    want = [(r.doc_id, *p) for r, p in zip(rows, plain_spans([r.text for r in rows], 200))]
    got = repeated_spans.repeated_digest(docs)
    assert got.columns == ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
    assert by_id(got.collect()) == by_id(want)
    assert sum(w[2] > 0 for w in want) > 8
    assert repeated_spans.repeated_digest(stable(spark, docs.limit(0))).count() == 0


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text("ab", max_size=120), min_size=1, max_size=6), st.integers(1, 3))
def test_deep_shallow_sort(texts, groups):
    length, data, at, group = 40, b"", [], []
    for i, t in enumerate(texts):
        at += [len(data) + p for p in range(len(t) - length + 1)]
        group += [i % groups] * max(len(t) - length + 1, 0)
        data += t.encode()
    got = repeated_spans.repeated_windows(np.frombuffer(data + b"\0" * 8, np.uint8), np.array(at, int), np.array(group, int),
                                          np.ones(len(at), int), length)
    seen = Counter((g, data[p:p + length]) for p, g in zip(at, group))
    assert got.tolist() == [seen[g, data[p:p + length]] > 1 for p, g in zip(at, group)]


# --- near-duplicates -------------------------------------------------------------------------

def near_copy(text, share, seed):
    pick, words = random.Random(seed), text.split()
    for i in pick.sample(range(len(words)), max(1, int(share * len(words)))):
        words[i] = "changed" + str(pick.randrange(10_000))
    return " ".join(words)


@pytest.mark.parametrize("task_links", [500_000, 7])
def test_components(spark, monkeypatch, task_links):
    monkeypatch.setattr(connected, "TASK_LINKS", task_links)
    links = [(i, i + 1) for i in range(0, 60) if i % 10 != 9] + [(100, 3), (200, 201), (200, 201)]
    got = {r.node: r.component for r in connected.components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert all(got[i] == i // 10 * 10 for i in range(60)) and got[100] == 0 and got[201] == 200
    assert connected.components(spark.createDataFrame([], "a long, b long")).count() == 0


@pytest.mark.parametrize("group", [4096, 4])
def test_near_duplicates(spark, monkeypatch, group):
    monkeypatch.setattr(near_duplicates, "GROUP", group)
    base = [prose(1000 + i, n) for i, n in enumerate((20, 60, 100, 130, 160, 400, 900))]
    more = [t for b in base for t in (b, b.upper(), near_copy(b, 0.015, 1), near_copy(b, 0.015, 2))]
    more += [near_copy(base[5], 0.3, 9), base[6][:2000] + prose(77, 600)] + [near_copy(base[4], 0.012, s) for s in range(20, 60)]
    docs = odd_documents(spark, *more)
    rows = [r for r in docs.collect() if r.doc_id is not None]
    sets = [shingles(r.text) for r in rows]
    got = near_duplicates.near_duplicates(docs).collect()
    assert len(got) == docs.count() and {r.doc_id for r in got} == {r.doc_id for r in docs.collect()}
    cls = {r.doc_id: r.class_id for r in got}
    near = {}
    for i in range(len(rows)):
        near[i] = [j for j in range(len(rows)) if sets[i] and jaccard(sets[i], sets[j]) >= 0.8]
        assert all(cls[rows[i].doc_id] == cls[rows[j].doc_id] for j in near[i])
    for i in range(len(rows)):  # whoever shares a class with another is at least rather similar to some member of it
        mates = [j for j in range(len(rows)) if j != i and rows[j].doc_id != rows[i].doc_id and cls[rows[j].doc_id] == cls[rows[i].doc_id]]
        assert not mates or max(jaccard(sets[i], sets[j]) for j in mates) >= 0.7
    assert all(cls[r.doc_id] == r.doc_id for r in rows if not sets[rows.index(r)])
    kept = without_near_duplicates(docs)
    assert kept.columns == docs.columns
    ids = [r.doc_id for r in kept.collect() if r.doc_id is not None]
    assert sorted(ids) == sorted({c for c in cls.values() if c is not None})
    empty = stable(spark, docs.limit(0))
    assert near_duplicates.near_duplicates(empty).count() == 0 and without_near_duplicates(empty).count() == 0


@pytest.mark.parametrize("group", [4096, 150])
def test_a_large_bucket_is_settled(spark, monkeypatch, group):
    """One bucket of texts alike in part, with many classes of two, against all pairs."""
    monkeypatch.setattr(near_duplicates, "GROUP", group)
    monkeypatch.setattr(near_duplicates, "band_keys", lambda h, text, weight, n: ([[7]] * n, np.bincount(text, weight, minlength=n)))
    base = [prose(60, 30) + " " + prose(3000 + i, 60) for i in range(250)]
    texts = [t for i, b in enumerate(base) for t in (b, near_copy(b, 0.02, i))] + [near_copy(b, 0.05, 5) for b in base[:50]]
    docs = stable(spark, spark.createDataFrame([*enumerate(texts)], "doc_id long, text string"))
    got = {r.doc_id: r.class_id for r in near_duplicates.near_duplicates(docs).collect()}
    sets = [shingles(t) for t in texts]
    pairs = [(i, j) for i in range(len(sets)) for j in range(i) if jaccard(sets[i], sets[j]) >= 0.8]
    assert len(pairs) >= 200 and all(got[i] == got[j] for i, j in pairs)
    assert len(set(got.values())) > 200


def test_groups_of_a_hot_bucket_are_dealt_anew(spark, monkeypatch):
    """Members in different groups in one turn meet in others; groups are at most a few places wide here."""
    monkeypatch.setattr(near_duplicates, "GROUP", 4)
    bucket = spark.range(64).selectExpr("id AS node", "7L AS band", "64L AS n")
    met = set()
    for turn in range(8):
        pairs = near_duplicates._neighbours(bucket, near_duplicates.F.xxhash64("node", near_duplicates.F.lit(turn)), 4, turn)
        met |= {(r.a, r.b) for r in near_duplicates._distinct_pairs(pairs).collect()}
    assert len(met) > 400  # groups that stay allow about 100, and 15 heads in each turn


def test_texts_of_candidates_are_shuffled_once(spark, monkeypatch):
    rows = stable(spark, spark.createDataFrame([(i, f"text {i}") for i in range(2000)], "__row long, text string"))
    members = stable(spark, spark.createDataFrame([(i,) for i in range(0, 2000, 50)], "node long"))
    likely = near_duplicates._likely(rows, members)
    assert {r.node for r in members.collect()} <= {r.node for r in likely.collect()} and likely.count() < 100
    assert "Exchange" not in likely._jdf.queryExecution().executedPlan().toString()
    monkeypatch.setattr(near_duplicates, "PLACED_ROWS", 10)
    broadcast = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        with near_duplicates.placed(likely.join(members, "node", "left_semi"), 40) as texts:
            joined = near_duplicates.with_texts(spark.createDataFrame([(0, 50), (50, 1950)], "a long, b long"), texts)
            plan = joined._jdf.queryExecution().executedPlan().toString()
            # The pairs by each side, no text on its own.
            assert plan.count("Exchange hashpartitioning") == 2 and plan.count("hashpartitioning(b") == 1
            assert {(r.a, r.text_a, r.b, r.text_b) for r in joined.collect()} == {(0, "text 0", 50, "text 50"), (50, "text 50", 1950, "text 1950")}
            assert texts.count() == 40
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", broadcast)
    assert not [t for t in spark.catalog.listTables() if t.name.startswith("placed_")]


def test_weighted_similarity_and_draws():
    """Sets draw the same element as often as they are alike, and common shingles weigh less."""
    random = np.random.default_rng(0)
    h = random.integers(0, 2**63, 300).astype(np.uint64)
    wa, wb = random.random(300) + 0.1, random.random(300) + 0.1
    wb[:150] = wa[:150]
    alike = np.minimum(wa, wb).sum() / np.maximum(wa, wb).sum()
    same = 0
    for seed in near_duplicates._SEED[:1500]:
        ra, sa = near_duplicates.draw(h, np.log(wa), seed)
        rb, sb = near_duplicates.draw(h, np.log(wb), seed)
        same += sa[ra.argmin()] == sb[rb.argmin()]
    assert abs(same / 1500 - alike) < 0.04
    counts = np.ones((near_duplicates.SKETCH_ROWS, near_duplicates._WIDTH), int)
    for row, slot in zip(counts, near_duplicates._slots(h[:1])):
        row[slot] = 900
    weights = near_duplicates.Weights(counts, 1000).of(h[:2], np.ones(2))
    assert weights[0] < 0.2 and weights[1] > 0.9


# --- decontamination -------------------------------------------------------------------------

def test_decontamination(spark):
    items = [prose(2000 + i, 34) for i in range(8)]
    word_problem = ("A train leaves with Maria at 40 km per hour and returns after 3 hours while Pedro waits 15 minutes near the "
                    "old bridge, so how many km did Maria travel before Pedro saw the train of 40 people")
    changed = word_problem.replace("Maria", "Ingrid").replace("Pedro", "Olaf").replace("40", "72").replace("km", "miles")
    broken = word_problem  # the same template, but no assignment of values fits it
    for old, new in (("Maria", "Ingrid"), ("Maria", "Olaf"), ("Pedro", "Ingrid"), ("Pedro", "Nils"), ("40", "72"), ("40", "99")):
        broken = broken.replace(old, new, 1)
    items.append(word_problem)
    benchmark = spark.createDataFrame([*enumerate(items), (90, None), (91, ""), (92, items[0])], "item_id long, text string")
    leaks = [prose(1, 80) + " " + items[i] + " " + prose(2, 50) for i in range(4)] + ["So: " + changed + ". Done."]
    clean = [prose(3, 200), items[5][:len(items[5]) // 2] + " " + prose(4, 60), "1 2 3 4 5 6 7 8 9 " * 20, "So: " + broken]
    docs = odd_documents(spark, *leaks, *clean)
    got = {r.doc_id: r for r in contamination(docs, benchmark).collect() if r.doc_id is not None}
    first = 9
    for i in range(4):
        assert got[first + i].contaminated and set(got[first + i].item_ids) == ({0, 92} if i == 0 else {i})
    assert got[first + 4].item_ids == [8]
    assert sorted(d for d, r in got.items() if r.contaminated) == list(range(first, first + 5))
    blocks = with_items(docs.select("doc_id", "text"), benchmark, block_bytes=300)
    assert {r.doc_id: sorted(x.item_id for x in r[FOUND]) for r in blocks.collect() if r[FOUND]} == {
        d: sorted(r.item_ids) for d, r in got.items() if r.contaminated}
    kept = decontaminated(docs, benchmark)
    assert kept.columns == docs.columns and kept.count() == docs.count() - 5
    assert contamination(docs.limit(0), benchmark).count() == 0
    assert contamination(docs, benchmark.limit(0)).filter("contaminated").count() == 0


def found_in(item, *texts):
    block = decontaminate.Block.of([0], [item])
    return [bool(x) for x in decontaminate.items_found(block, pa.array(texts, pa.large_string()), 0.8)]


PROBLEM = "Every morning Maria buys 12 apples and 7 pears for Pedro who then sells 5 of them to the old market near the river"


@pytest.mark.parametrize("letter", ["\u0130", "\u1e9e", "\u212a", "\u2126", "\u212b", "\u023a \u212a"])
def test_names_beside_letters_that_change_length(letter):
    changed = PROBLEM.replace("Maria", "Ingrid").replace("Pedro", "Olaf").replace("12", "31")
    assert found_in(PROBLEM, letter + " x", "So: " + changed, letter + " and " + changed) == [False, True, True]
    assert decontaminate.items_found(decontaminate.Block.of([0, 1], [letter, PROBLEM]), pa.array([changed], pa.large_string()), 0.8)[0]


def test_items_dense_in_slots():
    item = "What is 12 + 7 - 3 * 4 + 9"
    assert found_in(item, "Q: What is 31 + 8 - 5 * 6 + 2 or so", "What is 31 + 8 - 31 * 6 + 2", "It is 31 + 8 - 5 * 6 + 2", item) == [
        True, False, False, True]
    assert found_in("1 2 3 4 5 6 then 7 8 9 10 11 stop", "a 11 12 13 14 15 16 then 17 18 19 20 21 stop b") == [True]


def test_several_variants_and_values_elsewhere():
    item = "Maria has 12 apples and Pedro has 7 pears then Maria gives 5 apples and Pedro gives 2 pears away"
    variants = [item.replace("Maria", a).replace("Pedro", b).replace("12", c).replace("7", d).replace("5 ", e + " ").replace("2 pears", f + " pears")
                for a, b, c, d, e, f in (("Ingrid", "Olaf", "31", "14", "9", "6"), ("Nils", "Jana", "44", "18", "25", "16"),
                                         ("Omar", "Lena", "71", "63", "29", "37"))]
    elsewhere = "so Bruno has 99 apples and Carla has 88 pears then. " * 30
    texts = ["Now " + ". Now ".join(variants), "Now " + variants[0] + ". " + elsewhere, "Now " + elsewhere]
    assert found_in(item, *texts) == [True, True, False]


# --- secrets ---------------------------------------------------------------------------------

PLAIN = [("assign", r"""(?i:(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+))"""),
         ("access", r"AKIA[A-Z0-9]+"), ("hex", r"[0-9a-f]+")]


def plain_secrets(text):
    found = []
    for k, (kind, pattern) in enumerate(PLAIN):
        for m in re.finditer(pattern, text or ""):
            if kind == "assign" and len(m[2]) >= 8 or kind == "access" and len(m[0]) >= 16 or kind == "hex" and len(m[0]) >= 32:
                found.append((m.start(), k, m.end()))
    return sorted(found)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from(["password", "Token", "api_key", "APIKEY", "secret", "passwd", "'", '"', " ", "  ", ":", "=", "AKIA",
                                 "ABCD12345678", "deadbeef" * 4, "abcdef01", "x", "é", "漢", "-", "tokentoken", "\n"]), max_size=16))
def test_secret_spans(parts):
    text = "".join(parts)
    assert [s for s in secret_scan.char_spans(text.encode()) if s[1] < secret_scan.BASE] == plain_secrets(text)


def test_secret_digest_and_redaction(spark):
    key = "AKIA" + "Q7" * 8
    more = ["é token: 'abcd1234efgh' and token=abc", f"{key} {key}", "0123456789abcdef" * 2 + "g", "-----BEGIN RSA PRIVATE KEY----- x",
            "ghp_" + "a1B2" * 6, "xoxb-" + "12ab-" * 4]
    docs = odd_documents(spark, *more)
    got = secret_scan.secret_digest(docs)
    assert got.columns == ["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"]
    want = []
    for r in docs.collect():
        base = plain_secrets(r.text)
        n = Counter(k for _, k, _ in base)
        text = ",".join(f"{PLAIN[k][0]}:{s}:{e}" for s, k, e in base)
        want.append((r.doc_id, n[0], n[1], n[2], hashlib.sha256(text.encode()).hexdigest()))
    assert by_id(tuple(r)[:5] for r in got.collect()) == by_id(want)
    spans = {r.doc_id: r.spans for r in got.collect()}
    assert spans[12].startswith("private_key:0:") and spans[13].startswith("code_host") and spans[14].startswith("chat")
    clean = secret_scan.redact_secrets(docs)
    assert clean.schema.simpleString() == docs.schema.simpleString() and clean.count() == docs.count()
    text = {r.doc_id: r for r in clean.collect()}
    assert text[9].text == "é [secret]' and token=abc" and text[9].n_chars == len(text[9].text)
    assert text[10].text == "[secret] [secret]" and text[0].text is None and text[1].text == ""
    assert secret_scan.secret_digest(docs.limit(0)).count() == 0 and secret_scan.redact_secrets(docs.limit(0)).count() == 0


# --- quality ---------------------------------------------------------------------------------

def test_estimates_find_the_accuracies():
    random = np.random.default_rng(1)
    truth = random.random(20_000) < 0.2
    right = (0.95, 0.8, 0.7, 0.9)
    votes = np.column_stack([np.where(random.random(len(truth)) < 0.3, 0, np.where((random.random(len(truth)) < a) == truth, 2, 1))
                             for a in right]).astype(np.int8)
    patterns, which, counts = np.unique(votes, axis=0, return_inverse=True, return_counts=True)
    posterior, table = quality.estimate(patterns, counts.astype(float))
    for j, a in enumerate(right):
        assert abs(table[1, j, 2] / (table[1, j, 1] + table[1, j, 2]) - a) < 0.05
    assert np.mean((posterior[which.ravel()] > 0.5) == truth) > 0.93


def test_quality_on_held_out_labels(spark):
    """Fitted on half of the labels, held against the other half."""
    folder = "/root/testdata/sf0.1"
    docs, labels = spark.read.parquet(f"{folder}/documents.parquet"), spark.read.parquet(f"{folder}/labels.parquet")
    model = quality.fit(docs, labels.filter("doc_id % 2 = 0"), fit_rows=6000)
    held = quality.score(docs, model).join(labels.filter("doc_id % 2 = 1"), "doc_id").select(
        "quality", "toxic", "reject").toPandas()
    junk, clean = held[held.quality == 0], held[(held.quality == 1) & (held.toxic == 0)]
    assert junk["reject"].mean() > 0.9 and clean["reject"].mean() < 0.03


def test_quality_of_odd_rows(spark):
    docs = odd_documents(spark, *[prose(i, 50) for i in range(40)], *["BUY!! NOW!! " * 30] * 5, *["x*** y### z$$$ " * 20 + str(i) for i in range(9)])
    labels = spark.createDataFrame([(i, 1, 0) for i in range(9, 30)] + [(49, 0, 0), (49, 1, None), (None, 0, 1), (7, None, None)],
                                   "doc_id long, quality int, toxic int")
    got = quality.classify(docs, labels)
    assert got.columns == ["doc_id", "score", "reject"] and got.count() == docs.count()
    assert {r.reject for r in got.filter("doc_id < 3").collect()} == {False}
    assert quality.accepted(docs, labels).columns == docs.columns
    assert quality.classify(docs, labels.limit(0)).count() == docs.count()
    assert quality.classify(docs.limit(0), labels).count() == 0
