"""Language of words and documents by a linear-chain conditional random field.

A text's words are cut into chains of ``CHAIN`` consecutive words. Each word has features: its
prefixes and suffixes of 1 to 3 bytes, its 3-grams, and its place in a lexicon (smoothed log shares
of the word among the languages). Weights of features and of transitions between languages are
learned by maximum likelihood; forward-backward gives each word's probabilities in its context, so
runs of another language inside a text are told apart. A document's language is the one with the
largest sum of word probabilities, its score their mean.

The score only says which learned language is nearest. How well a text fits any of them is told by
``label(fit=...)``: its words' mean log share of their n-grams in the best language of each word, in
standard deviations from that of learned documents with as many words.

Learning takes a bounded sample: per language the ``SAMPLE`` documents with the smallest hash of
their id among those in a learning fold, with a language, and of at most ``SAMPLE_BYTES`` bytes. All
rows and whole texts are labelled, in chains, so a long text needs no long recursion.

Defined cases: a null text and a text without letters are ``und`` with score 0; without anything to
learn from, every text is ``und``; ties go to the first language in order; repeated rows are labelled
apart; an empty table gives no rows; other columns stay.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F, types as T

from sqlloom.llm.common import Words, is_held_out, may_learn, pieces, separators

UNDETERMINED = "und"
CHAIN = 64
SAMPLE = 250
SAMPLE_BYTES = 20_000
FEATURE_BITS = 16
EPOCHS = 6
CHAINS_A_STEP = 256
RATE = 0.05
DECAY = 1e-6
LEXICON_SMOOTHING = 0.5
GRAM_SMOOTHING = 0.05

#: Everything in ASCII but letters parts words; A-Z are lower-cased before.
NO_LETTERS = separators([(0x00, 0x40), (0x5B, 0x60), (0x7B, 0x7F)])
#: Seeds that keep the kinds of features apart.
PREFIX, SUFFIX, GRAM, WORD = 1, 2, 3, 4


@dataclass
class Crf:
    languages: list[str]
    weights: np.ndarray  # features x languages
    transitions: np.ndarray  # from x to
    lexicon: np.ndarray  # hashed words x languages
    trust: np.ndarray  # weight of the lexicon by language
    familiar: Familiar | None = None


@dataclass
class Familiar:
    """Log shares of n-grams by language, and how texts of the sample spread around their mean."""

    shares: np.ndarray  # features x languages
    mean: float
    between: float  # variance of texts
    within: float  # variance of the words of a text

    def words(self, words: Words) -> np.ndarray:
        """Mean log share of each word's n-grams, in the language where it is highest."""
        values, first, back = np.unique(words.hash, return_index=True, return_inverse=True)
        owner, feature = word_features(words, words.start[first], words.end[first])
        n = np.maximum(np.bincount(owner, minlength=len(values)), 1)
        best = np.full(len(values), -np.inf)
        for k in range(self.shares.shape[1]):
            best = np.maximum(best, np.bincount(owner, self.shares[feature, k], len(values)) / n)
        return best[back]

    def texts(self, words: Words) -> np.ndarray:
        """Standard deviations of each text from the mean; 0 without words."""
        n = np.maximum(words.counts, 1)
        means = np.bincount(words.doc, self.words(words), len(n)) / n
        return np.where(words.counts > 0, (means - self.mean) / np.sqrt(self.between + self.within / n), 0.0)


def familiar(texts: list[str], labels: list[str]) -> Familiar | None:
    """Shares from all texts; their spread from half of them, by the shares of the other half."""
    languages = sorted(set(labels))

    def shares(some: slice) -> np.ndarray:
        words = Words(pa.array(texts[some], pa.string()), NO_LETTERS)
        of = np.searchsorted(languages, labels[some])
        counts = np.full((1 << FEATURE_BITS, len(languages)), GRAM_SMOOTHING)
        owner, feature = word_features(words, words.start, words.end)
        np.add.at(counts, (feature, of[words.doc[owner]]), 1.0)
        return np.log(counts / counts.sum(0))

    if len(texts) < 4:
        return None
    half = Familiar(shares(slice(0, None, 2)), 0.0, 0.0, 0.0)
    words = Words(pa.array(texts[1::2], pa.string()), NO_LETTERS)
    value, n = half.words(words), words.counts
    if (n > 0).sum() < 2:
        return None
    means = np.bincount(words.doc, value, len(n)) / np.maximum(n, 1)
    within = float(((value - means[words.doc]) ** 2).mean())
    means, n = means[n > 0], n[n > 0]
    between = max(float(means.var() - (within / n).mean()), 1e-4)
    return Familiar(shares(slice(None)), float(means.mean()), between, within)


def _bucket(hashes: np.ndarray, kind: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        spread = (hashes ^ np.uint64(kind)) * np.uint64(0xD6E8FEB86659FD93)
    return (spread >> np.uint64(64 - FEATURE_BITS)).astype(np.int64)


def word_features(words: Words, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(word number, feature) of every feature of the words at the given bytes."""
    length = end - start
    owner, feature = [], []
    for size in (1, 2, 3):
        has = np.flatnonzero(length >= size)
        owner += [has, has]
        feature.append(_bucket(words.spans(start[has], start[has] + size), PREFIX))
        feature.append(_bucket(words.spans(end[has] - size, end[has]), SUFFIX))
    n = np.maximum(length - 2, 0)
    of = np.repeat(np.arange(len(start)), n)
    at = start[of] + np.arange(len(of)) - np.repeat(np.cumsum(n) - n, n)
    owner.append(of)
    feature.append(_bucket(words.spans(at, at + 3), GRAM))
    return np.concatenate(owner), np.concatenate(feature)


def emissions(model: Crf, words: Words) -> np.ndarray:
    """Score of every language for every word; equal words are scored once."""
    values, first, back = np.unique(words.hash, return_index=True, return_inverse=True)
    owner, feature = word_features(words, words.start[first], words.end[first])
    out = model.lexicon[_bucket(values, WORD)] * model.trust
    for k in range(len(model.languages)):
        out[:, k] += np.bincount(owner, model.weights[feature, k], len(values))
    return out[back]


def chains(doc: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Chain number and place in it of words, which lie document by document."""
    new = np.ones(len(doc), bool)
    new[1:] = doc[1:] != doc[:-1]
    first = np.flatnonzero(new)
    place = np.arange(len(doc)) - np.repeat(first, np.diff(np.append(first, len(doc))))
    return np.cumsum(new | (place % CHAIN == 0)) - 1, place % CHAIN


def forward_backward(scores: np.ndarray, chain: np.ndarray, place: np.ndarray, transitions: np.ndarray):
    """Probabilities of each word's languages, expected transitions, and the sum of log partitions."""
    n, k = (int(chain[-1]) + 1 if len(chain) else 0), scores.shape[1]
    top = scores.max(1)
    grid = np.ones((CHAIN, n, k))
    grid[place, chain] = np.exp(scores - top[:, None])
    there = np.zeros((CHAIN, n), bool)
    there[place, chain] = True
    peak = transitions.max()
    move = np.exp(transitions - peak)
    ahead, log_z = np.empty_like(grid), top.sum()
    state = None
    for t in range(CHAIN):
        live = there[t]
        moved = grid[t] if state is None else grid[t] * (state @ move)
        total = moved.sum(1)
        log_z += np.log(total[live]).sum() + (peak * live.sum() if t else 0.0)
        state = np.where(live[:, None], moved / total[:, None], 0 if state is None else state)
        ahead[t] = state
    pairs = np.zeros((k, k))
    behind = np.ones((n, k))
    marginal = np.empty_like(grid)
    for t in range(CHAIN - 1, -1, -1):
        both = ahead[t] * behind
        marginal[t] = both / np.maximum(both.sum(1, keepdims=True), 1e-300)
        if t:
            live = there[t]
            later = grid[t] * behind
            joint = (ahead[t - 1][:, :, None] * move[None]) * later[:, None, :]
            total = joint.sum((1, 2), keepdims=True)
            pairs += (joint / np.maximum(total, 1e-300))[live].sum(0)
            step = later @ move.T
            behind = np.where(live[:, None], step / step.sum(1, keepdims=True), behind)
    return marginal[place, chain], pairs, log_z


def fit(texts: list[str], labels: list[str], seed: int = 11) -> Crf:
    """Maximum likelihood by Adam over minibatches of chains; every word bears its text's label."""
    languages = sorted(set(labels))
    k = len(languages)
    if not k:
        return Crf([], np.zeros((1 << FEATURE_BITS, 0)), np.zeros((0, 0)), np.zeros((1 << FEATURE_BITS, 0)), np.zeros(0))
    words = Words(pa.array(texts, pa.string()), NO_LETTERS)
    label = np.searchsorted(languages, labels)[words.doc]
    counts = np.full((1 << FEATURE_BITS, k), LEXICON_SMOOTHING)
    bucket = _bucket(words.hash, WORD)
    np.add.at(counts, (bucket, label), 1.0)
    per_language = np.maximum(np.bincount(label, minlength=k), 1)
    share = counts / per_language
    model = Crf(languages, np.zeros((1 << FEATURE_BITS, k)), np.zeros((k, k)), np.log(share) - np.log(share).mean(1, keepdims=True), np.full(k, 0.1))
    if k < 2 or not len(label):
        return model
    chain, place = chains(words.doc)
    owner, feature = word_features(words, words.start, words.end)
    by_owner = np.argsort(owner, kind="stable")
    owner, feature = owner[by_owner], feature[by_owner]
    owner_edges = np.searchsorted(owner, np.arange(len(label) + 1))
    edges = np.flatnonzero(np.diff(chain, prepend=-1))
    edges = np.append(edges, len(chain))
    rng = np.random.default_rng(seed)
    squares = [np.zeros_like(model.weights), np.zeros_like(model.transitions), np.zeros(k)]
    for _ in range(EPOCHS):
        order = rng.permutation(len(edges) - 1)
        for at in range(0, len(order), CHAINS_A_STEP):
            some = order[at : at + CHAINS_A_STEP]
            size = edges[some + 1] - edges[some]
            rows = np.repeat(edges[some] - (np.cumsum(size) - size), size) + np.arange(size.sum())
            number, spot = np.repeat(np.arange(len(some)), size), place[rows]
            n = owner_edges[rows + 1] - owner_edges[rows]
            spots = np.repeat(owner_edges[rows] - (np.cumsum(n) - n), n) + np.arange(n.sum())
            f, o = feature[spots], np.repeat(np.arange(len(rows)), n)
            known = model.lexicon[bucket[rows]]
            scores = known * model.trust
            for j in range(k):
                scores[:, j] += np.bincount(o, model.weights[f, j], len(rows))
            probability, pairs, _ = forward_backward(scores, number, spot, model.transitions)
            slope = probability
            slope[np.arange(len(rows)), label[rows]] -= 1
            inner = np.flatnonzero(spot > 0)
            seen = np.zeros((k, k))
            np.add.at(seen, (label[rows[inner] - 1], label[rows[inner]]), 1.0)
            used, f = np.unique(f, return_inverse=True)
            grad = np.stack([np.bincount(f, slope[o, j], len(used)) for j in range(k)], 1) / len(some)
            _step(model.weights, squares[0], grad + DECAY * model.weights[used], used)
            _step(model.transitions, squares[1], (pairs - seen) / len(some) + 1e-2 * model.transitions)
            _step(model.trust, squares[2], (slope * known).sum(0) / len(some))
    return model


def _step(value: np.ndarray, squares: np.ndarray, grad: np.ndarray, rows=slice(None)) -> None:
    """Adagrad, in place."""
    squares[rows] += grad**2
    value[rows] -= RATE * grad / (np.sqrt(squares[rows]) + 1e-6)


def learn(docs: DataFrame, sample: int = SAMPLE, sample_bytes: int = SAMPLE_BYTES) -> Crf:
    """The model from at most ``sample`` documents a language. Languages are few; each sends at most
    ``sample * sample_bytes`` bytes to the driver."""
    usable = docs.where(may_learn("doc_id") & F.col("lang").isNotNull() & (F.octet_length("text") <= sample_bytes))
    keyed = usable.select("lang", "text", F.xxhash64("doc_id").alias("key"))
    first = Window.partitionBy("lang").orderBy("key", "text")
    rows = keyed.withColumn("n", F.row_number().over(first)).where(F.col("n") <= sample)
    got = sorted((r["lang"], r["key"], r["text"]) for r in rows.select("lang", "key", "text").collect())
    texts, labels = [r[2] for r in got], [r[0] for r in got]
    model = fit(texts, labels)
    model.familiar = familiar(texts, labels)
    return model


def label_batch(model: Crf, texts: pa.Array) -> tuple[list[str], np.ndarray, Words, np.ndarray]:
    """Language and score of each text; its words and their probabilities."""
    words = Words(texts, NO_LETTERS)
    n, k = len(texts), len(model.languages)
    chain, place = chains(words.doc)
    if k and len(words.doc):
        probability = forward_backward(emissions(model, words), chain, place, model.transitions)[0]
    else:
        probability = np.zeros((len(words.doc), k))
    sums = np.stack([np.bincount(words.doc, probability[:, j], n) for j in range(k)], 1) if k else np.zeros((n, 1))
    counts = words.counts
    best = sums.argmax(1)
    ascii_letter = np.zeros(n, bool)
    plain = (words.bytes >= 97) & (words.bytes <= 122)
    ascii_letter[np.searchsorted(words.bounds, np.flatnonzero(plain), "right") - 1] = True
    names, scores = [], np.zeros(n)
    for i in range(n):
        lettered = ascii_letter[i] or (counts[i] and any(map(str.isalpha, texts[i].as_py())))
        names.append(model.languages[best[i]] if k and lettered else UNDETERMINED)
        scores[i] = min(sums[i, best[i]] / counts[i], 1.0) if k and lettered else 0.0
    return names, scores, words, probability


def label(docs: DataFrame, model: Crf, name: str = "lang_pred", score: str = "score", fit: str | None = None) -> DataFrame:
    """``docs`` with the language and score of every row's whole text and, if named, its fit."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # of fixed size a language
    columns = [*docs.columns, name, score, *([fit] if fit else [])]
    schema = T.StructType([*docs.schema.fields, T.StructField(name, T.StringType()), *(T.StructField(c, T.DoubleType()) for c in (score, fit) if c)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches:
            for part in pieces(batch, "text"):
                names, scores, words, _ = label_batch(model, part.column("text"))
                made = [pa.array(names, pa.string()), pa.array(scores)]
                if fit:
                    made.append(pa.array(model.familiar.texts(words) if model.familiar else np.zeros(part.num_rows)))
                yield pa.RecordBatch.from_arrays([*part.columns, *made], names=columns)

    return docs.mapInArrow(run, schema)


def language_runs(docs: DataFrame, model: Crf) -> DataFrame:
    """doc_id, first_word, n_words, lang: the runs of words of one language in every text."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    schema = pa.schema([("doc_id", pa.int64()), ("first_word", pa.int64()), ("n_words", pa.int64()), ("lang", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in pieces(batch, "text"):
                _, _, words, probability = label_batch(shared.value, part.column("text"))
                if not probability.size:
                    continue
                best = probability.argmax(1)
                new = np.ones(len(best), bool)
                new[1:] = (words.doc[1:] != words.doc[:-1]) | (best[1:] != best[:-1])
                at = np.flatnonzero(new)
                doc = words.doc[at]
                offset = np.concatenate([[0], np.cumsum(words.counts)])[doc]
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id").take(pa.array(doc)), pa.array(at - offset), pa.array(np.diff(np.append(at, len(best)))), pa.array([shared.value.languages[b] for b in best[at]])],
                    schema=schema,
                )

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return rows.mapInArrow(run, "doc_id long, first_word long, n_words long, lang string")


def languages(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, lang_pred, score of every row; learned from the same table."""
    model = learn(docs)
    labelled = label(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), model)
    return labelled.select("doc_id", is_held_out("doc_id").alias("held_out"), "lang_pred", "score")
