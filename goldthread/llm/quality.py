"""Quality of documents: weak labellers, their accuracies by expectation-maximisation, and a hashed linear scorer."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from goldthread.llm.common import bound_batches, slices, text_of, unused
from goldthread.llm.words import Words, mix, shingles_of, words_of

#: Bounds of the fit: rows of the sample, slots of the scorer.
FIT_ROWS, SLOT_BITS = 8_000, 20
SLOTS = 1 << SLOT_BITS
ABSTAIN, KEEP, REJECT = 0, 1, 2
#: The labellers of each reason for rejection: bad shape (quality 0) and bad words (toxic 1).
LABELLERS = {
    "shape": ("shouting", "exclaiming", "symbols", "symbol_runs", "table", "dividers", "repeating", "few_words",
              "clean_shape", "judged"),
    "words": ("bad_word", "bad_beginning", "several", "judged")}
_PREFIXES = (4, 5, 6)
_COPY_SALTS = mix(np.arange(4, dtype=np.uint64) + np.uint64(901))
_SALTS = mix(np.arange(8, dtype=np.uint64) + np.uint64(501))


def shape_of(words: Words, texts: pa.Array) -> dict[str, np.ndarray]:
    """Shares per text: capital words, exclamation and symbol runs, dividers, repeated neighbours, distinct words."""
    n_texts = len(texts)
    plain = pc.binary_join_element_wise(texts, pa.scalar("", pa.large_string()), pa.scalar("\n", pa.large_string()))
    offsets = np.frombuffer(plain.buffers()[1], np.int64)[plain.offset:plain.offset + len(plain) + 1] if n_texts else np.zeros(1, np.int64)
    raw = np.frombuffer(plain.buffers()[2], np.uint8)[offsets[0]:offsets[-1]] if n_texts else np.zeros(0, np.uint8)
    at = offsets - offsets[0]

    def per_text(flags: np.ndarray) -> np.ndarray:
        sums = np.concatenate([[0], np.cumsum(flags)])
        return (sums[at[1:]] - sums[at[:-1]]).astype(float)

    count = np.diff(words.first).astype(float)
    letters = per_text((raw >= 65) & (raw <= 90) | (raw >= 97) & (raw <= 122))
    capitals = per_text((raw >= 65) & (raw <= 90))
    doubled = np.zeros(len(raw), bool)
    doubled[1:] = raw[1:] == raw[:-1]
    symbol = np.isin(raw, np.frombuffer(b"*&#$%@^~=+<>", np.uint8))
    again = np.zeros(len(words.hashes), bool)
    again[1:] = (words.hashes[1:] == words.hashes[:-1]) & (words.text[1:] == words.text[:-1])
    sums = np.concatenate([[0], np.cumsum(again)])
    distinct = np.array([len(np.unique(words.hashes[a:b])) for a, b in zip(words.first[:-1], words.first[1:])], float)
    least = np.maximum(count, 1)
    return {
        "words": count, "capitals": capitals / np.maximum(letters, 1), "exclaims": per_text((raw == 33) & doubled) / least,
        "symbols": per_text(symbol) / least, "symbol_runs": per_text(symbol & doubled) / least,
        "dividers": per_text(raw == 124) / least, "lines": per_text(raw == 10) / least,
        "repeats": (sums[words.first[1:]] - sums[words.first[:-1]]) / least, "distinct": distinct / np.sqrt(least)}


def features_of(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, dict[str, np.ndarray], Words]:
    """Hashed features as slots and text numbers, each once per text; the shapes; the words.

    Features are words, beginnings of words, and binned shapes.
    """
    words = words_of(texts)
    shape = shape_of(words, texts)
    long = words.ends - words.starts
    slots, owner = [words.hashes ^ _SALTS[0]], [words.text]
    for i, n in enumerate(_PREFIXES, 1):
        use = long >= n
        slots.append(words.hashed.of(words.starts[use], words.starts[use] + n) ^ _SALTS[i])
        owner.append(words.text[use])
    names = [n for n in shape if n != "words"]
    bins = np.concatenate([np.minimum(np.round(shape[n] * 8), 40).astype(np.uint64) + np.uint64(64 * i)
                           for i, n in enumerate(names)]) if len(texts) else np.zeros(0, np.uint64)
    slots.append(mix(bins + _SALTS[6]))
    owner.append(np.tile(np.arange(len(texts)), len(names)))
    slot = (mix(np.concatenate(slots)) >> np.uint64(64 - SLOT_BITS)).astype(np.int64)
    both = np.unique(np.concatenate(owner).astype(np.int64) * SLOTS + slot)
    return both % SLOTS, both // SLOTS, shape, words


def shape_votes(shape: dict[str, np.ndarray], judged: np.ndarray) -> np.ndarray:
    """One column per labeller of the shape: 0 no opinion, 1 keep, 2 reject."""
    some = shape["words"] >= 8
    clean = (shape["capitals"] < 0.15) & (shape["exclaims"] < 0.02) & (shape["symbols"] < 0.05) & (shape["dividers"] < 0.02) \
        & (shape["repeats"] < 0.03)
    return np.column_stack([
        _say((shape["capitals"] > 0.5) & some), _say(shape["exclaims"] > 0.15, shape["exclaims"] == 0),
        _say(shape["symbols"] > 0.5), _say(shape["symbol_runs"] > 0.3, shape["symbol_runs"] == 0),
        _say((shape["dividers"] > 0.3) & some), _say(shape["dividers"] > 0.15, shape["dividers"] == 0),
        _say((shape["repeats"] > 0.3) & some, shape["repeats"] == 0), _say((shape["distinct"] < 1.0) & (shape["words"] >= 20)),
        _say(np.zeros(len(clean), bool), clean), judged]).astype(np.int8)


def word_votes(n_words: np.ndarray, n_beginnings: np.ndarray, judged: np.ndarray) -> np.ndarray:
    """The same for the labellers of the words, from how many listed words and beginnings a text holds."""
    return np.column_stack([
        _say(n_words > 0, n_words + n_beginnings == 0), _say(n_beginnings > 0, n_beginnings == 0),
        _say(n_words + n_beginnings > 2), judged]).astype(np.int8)


def _say(reject: np.ndarray, keep: np.ndarray | None = None) -> np.ndarray:
    out = np.where(reject, REJECT, ABSTAIN)
    return out if keep is None else np.where(~reject & keep, KEEP, out)


def estimate(patterns: np.ndarray, counts: np.ndarray, rounds: int = 60) -> tuple[np.ndarray, np.ndarray]:
    """Expectation-maximisation over the vote patterns: the chance of rejection for each, and the confusion table.

    ``table[c, j, v]`` is the chance that labeller ``j`` says ``v`` of a document of class ``c``. It starts from
    labellers that are right more often than not, the last one (the judgement) nearly always.
    """
    n = patterns.shape[1]
    table = np.full((2, n, 3), 1 / 3)
    for v, (keep, reject) in {ABSTAIN: (0.5, 0.5), KEEP: (0.4, 0.15), REJECT: (0.1, 0.35)}.items():
        table[0, :, v], table[1, :, v] = keep, reject
    table[0, -1], table[1, -1] = (0.5, 0.48, 0.02), (0.5, 0.02, 0.48)
    prior = np.array([0.8, 0.2])
    one_hot = np.stack([patterns == v for v in range(3)], axis=2).astype(float)
    posterior = np.zeros(len(patterns))
    for _ in range(rounds):
        logs = np.log(prior)[None, :] + np.einsum("pjv,cjv->pc", one_hot, np.log(table))
        posterior = 1 / (1 + np.exp(np.clip(logs[:, 0] - logs[:, 1], -50, 50)))
        weight = np.stack([(1 - posterior) * counts, posterior * counts])
        prior = (weight.sum(1) + 1) / (weight.sum() + 2)
        table = (np.einsum("cp,pjv->cjv", weight, one_hot) + 0.5) / (weight.sum(1)[:, None, None] + 1.5)
    return posterior, table


def fit_linear(rows: list[np.ndarray], target: np.ndarray, epochs: int = 3, rate: float = 0.3, sparse: float = 6.0,
               seed: int = 3) -> np.ndarray:
    """Logistic weights of hashed features by proximal steps that leave uninformative features at zero.

    The last feature of every row is the constant, which is not held back.
    """
    z, squares = np.zeros(SLOTS + 1), np.zeros(SLOTS + 1)
    hold = np.full(SLOTS + 1, sparse)
    hold[SLOTS] = 0.0
    order = np.random.default_rng(seed)

    def weights(at) -> np.ndarray:
        held, own = hold[at], z[at]
        return np.where(np.abs(own) <= held, 0.0, (np.sign(own) * held - own) * rate / (1 + np.sqrt(squares[at])))

    for _ in range(epochs):
        for i in order.permutation(len(rows)):
            at = rows[i]
            before = squares[at]
            w = weights(at)
            g = 1 / (1 + np.exp(-np.clip(w.sum(), -30, 30))) - target[i]
            after = before + g * g
            z[at] += g - (np.sqrt(after) - np.sqrt(before)) / rate * w
            squares[at] = after
    return weights(slice(None))


class Model:
    """The fitted classifier: weights of the hashed features for each reason, and what was estimated about the labellers."""

    def __init__(self, at: dict[str, np.ndarray], value: dict[str, np.ndarray], tables: dict[str, np.ndarray]):
        self.at, self.value, self.tables = at, value, tables

    def scores(self, texts: pa.Array) -> np.ndarray:
        """The chance of rejection of each text: the larger one of the reasons."""
        if not hasattr(self, "dense"):
            self.dense = {r: np.zeros(SLOTS + 1) for r in self.at}
            for r, at in self.at.items():
                self.dense[r][at] = self.value[r]
        slot, owner, _, _ = features_of(texts)
        sums = [np.bincount(owner, d[slot], minlength=len(texts)) + d[SLOTS] for d in self.dense.values()]
        return 1 / (1 + np.exp(-np.clip(np.max(sums, axis=0), -50, 50)))


def telling_slots(rows: list[np.ndarray], toxic: np.ndarray, margin: float = 4.0) -> np.ndarray:
    """Slots that occur in toxic documents far more often than chance allows: what the word labellers look up.

    A slot is listed if its share of toxic documents is at least 0.8 and so high a share would come about by chance
    with less than ``exp(-margin)`` for all slots together (a Chernoff bound).
    """
    yes, n = np.zeros(SLOTS), np.zeros(SLOTS)
    for slots, t in zip(rows, toxic):
        n[slots] += 1
        if t == 1:
            yes[slots] += 1
    rate = min(max(float(np.mean(toxic == 1)) if len(toxic) else 0.5, 1e-3), 0.5)
    share = np.clip(yes / np.maximum(n, 1), 1e-9, 1 - 1e-9)
    surprise = n * (share * np.log(share / rate) + (1 - share) * np.log((1 - share) / (1 - rate)))
    return np.flatnonzero((share >= 0.8) & (surprise > np.log(SLOTS) + margin))


def _first_of_copies(keys: Iterable[np.ndarray]) -> list[bool]:
    """Whether each row is the first with any of its least shingles; a text copied many times would teach its own words."""
    seen: set = set()
    first = []
    for own in keys:
        pairs = set(enumerate(np.asarray(own).tolist()))
        first.append(not pairs & seen)
        seen |= pairs
    return first


def fit(docs: DataFrame, labels: DataFrame, fit_rows: int = FIT_ROWS) -> Model:
    """Fit the classifier on a bounded sample: at most ``fit_rows`` documents, up to three quarters of them labelled.

    The rows are those with the smallest hash of their number. Labels serve two labellers: the list of bad words, and
    the judgement itself where there is one. All labellers vote on all rows of the sample, their accuracies
    are estimated from how they agree, and the posterior labels train the linear scorers. Features are taken where the
    documents are read; the bounded sample is fitted in one task, and the driver gets the weights only.
    """
    judged = labels.filter("doc_id is not null").groupBy("doc_id").agg(
        F.min("quality").alias("quality"), F.max("toxic").alias("toxic"))
    rows = docs.select("doc_id", "text").filter(F.length("text") > 0)
    chosen = judged.orderBy(F.xxhash64("doc_id"), "doc_id").limit(3 * fit_rows // 4)
    others = rows.select("doc_id").orderBy(F.xxhash64("doc_id"), "doc_id").limit(fit_rows)
    wanted = (others.join(chosen, "doc_id", "full").dropDuplicates(["doc_id"])
              .orderBy(F.col("quality").isNull(), F.xxhash64("doc_id"), "doc_id").limit(fit_rows))
    sample = rows.join(F.broadcast(wanted), "doc_id").dropDuplicates(["doc_id"])

    def featured(batches) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                slot, owner, shape, words = features_of(text_of(part))
                cuts = np.searchsorted(owner, np.arange(len(part) + 1))
                whole = (mix(words.hashes ^ _SALTS[0]) >> np.uint64(64 - SLOT_BITS)).astype("<i4")
                whole = [np.unique(whole[a:b]) for a, b in zip(words.first, words.first[1:])]
                slots = [slot[a:b].astype("<i4") for a, b in zip(cuts, cuts[1:])]
                shingle, of = shingles_of(words)
                least = np.full((len(part), len(_COPY_SALTS)), np.iinfo(np.uint64).max)
                for j, salt in enumerate(_COPY_SALTS):
                    np.minimum.at(least[:, j], of, mix(shingle ^ salt))
                yield pa.RecordBatch.from_pydict({
                    "copy_keys": pa.array(list(least.view(np.int64)), pa.list_(pa.int64())),
                    "doc_id": part.column("doc_id"), "quality": part.column("quality").cast(pa.int32()),
                    "toxic": part.column("toxic").cast(pa.int32()),
                    "whole": pa.array([w.tobytes() for w in whole], pa.binary()),
                    "other": pa.array([np.setdiff1d(s, w).tobytes() for s, w in zip(slots, whole)], pa.binary()),
                    "shape": pa.array(np.column_stack(list(shape.values())).tolist(), pa.list_(pa.float64()))})

    kind = docs.schema["doc_id"].dataType.simpleString()
    features = sample.mapInArrow(
        featured, f"copy_keys array<long>, doc_id {kind}, quality int, toxic int, whole binary, other binary, shape array<double>")
    fitted = features.repartition(1).mapInArrow(_learn, "reason string, at binary, value binary, table binary").collect()
    at = {r.reason: np.frombuffer(r.at, "<i4") for r in fitted}
    value = {r.reason: np.frombuffer(r.value, "<f8") for r in fitted}
    if not fitted:
        return Model({r: np.zeros(0, np.int32) for r in LABELLERS}, {r: np.zeros(0) for r in LABELLERS}, {})
    return Model(at, value, {r.reason: np.frombuffer(r.table, "<f8").reshape(2, len(LABELLERS[r.reason]), 3) for r in fitted})


def _learn(batches) -> Iterator[pa.RecordBatch]:
    """The weights of each reason, where they are not zero, and the estimated tables of its labellers."""
    batches = list(batches)
    if not sum(b.num_rows for b in batches):
        return
    got = pa.Table.from_batches(batches).to_pandas().sort_values("doc_id", kind="stable")
    got = got[_first_of_copies(got["copy_keys"])]
    whole, other = ([np.frombuffer(s, "<i4") for s in got[c]] for c in ("whole", "other"))
    empty = pa.array([""], pa.large_string())
    names = list(shape_of(words_of(empty), empty))
    shape = dict(zip(names, np.array(got["shape"].tolist(), float).reshape(len(got), len(names)).T))
    quality, toxic = got["quality"].to_numpy(float), got["toxic"].to_numpy(float)

    def judgement(bad: np.ndarray, known: np.ndarray) -> np.ndarray:
        return np.where(known, np.where(bad, REJECT, KEEP), ABSTAIN)

    known = ~np.isnan(toxic)
    listed = [telling_slots([s for s, k in zip(kinds, known) if k], toxic[known]) for kinds in (whole, other)]
    n_words, n_beginnings = (np.array([np.isin(s, own).sum() for s in kinds]) for kinds, own in zip((whole, other), listed))
    votes = {"shape": shape_votes(shape, judgement(quality == 0, ~np.isnan(quality))),
             "words": word_votes(n_words, n_beginnings, judgement(toxic == 1, known))}
    often = np.zeros(SLOTS, np.int32)
    for kinds in (whole, other):
        for s in kinds:
            often[s] += 1
    rows_used = [np.concatenate([w[often[w] >= 8], o[often[o] >= 8], [SLOTS]]).astype(np.int32) for w, o in zip(whole, other)]
    for reason, cast in votes.items():
        patterns, which, counts = np.unique(cast, axis=0, return_inverse=True, return_counts=True)
        posterior, table = estimate(patterns, counts.astype(float))
        weights = fit_linear(rows_used, posterior[which.ravel()])
        at = np.flatnonzero(weights)
        yield pa.RecordBatch.from_pydict({
            "reason": [reason], "at": [at.astype("<i4").tobytes()], "value": [weights[at].astype("<f8").tobytes()],
            "table": [table.astype("<f8").tobytes()]})


def score(docs: DataFrame, model: Model, threshold: float = 0.5, names: tuple[str, str] = ("score", "reject")) -> DataFrame:
    """``docs`` with the chance of rejection and whether it is over the threshold; every row is scored on its whole text.

    The two columns have the given ``names``, which ``docs`` must not have.

    A null or empty text has no features but its shape and gets the score of that; it is never rejected, for there
    is nothing bad in it. Other columns pass through; repeated rows get equal scores.
    """
    bound_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def judge(batches):
        for batch in batches:
            for part in slices(batch):
                texts = text_of(part)
                p = np.where(pc.equal(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False), 0.0, shared.value.scores(texts))
                yield part.append_column(names[0], pa.array(p)).append_column(names[1], pa.array(p > threshold))

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema)
    return docs.mapInArrow(judge, schema + f", {names[0]} double, {names[1]} boolean")


def classify(docs: DataFrame, labels: DataFrame, threshold: float = 0.5) -> DataFrame:
    """``doc_id, score, reject`` for every row of ``docs``, by a model fitted on a bounded sample of it."""
    return score(docs.select("doc_id", "text"), fit(docs, labels), threshold).select("doc_id", "score", "reject")


def accepted(docs: DataFrame, labels: DataFrame, threshold: float = 0.5) -> DataFrame:
    """The rows of ``docs`` that the classifier does not reject."""
    names = unused(docs, "__score"), unused(docs, "__reject")
    return score(docs, fit(docs, labels), threshold, names).filter(~F.col(names[1])).drop(*names)
