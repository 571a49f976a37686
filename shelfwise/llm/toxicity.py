"""Toxicity by weak supervision: voters, a generative label model, a linear classifier on its posterior labels.

Terms (words and word beginnings) that labelled texts tie to toxicity are mined from a bounded sample. The strongest are one lexicon voter each; patterns
(several terms, shouting, masked words, no term at all, ...) vote as well, and a label, where there is one, is a voter too. Every training text of the
corpus, labelled or not, then has a bit mask of votes. The label model explains the counts of distinct masks by a hidden class: expectation
maximisation estimates how often each voter fires in either class, and the correlations left between voters within a class, by which votes that say
the same are discounted. A logistic classifier over terms and patterns is fitted to the posterior labels of the sample and scores whole texts.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfwise.llm.common import map_rows, remove, stored

#: Distinct labelled texts of each class that terms are mined from and the classifier is fitted on, at most.
SAMPLE_PER_CLASS = 10_000
#: Word beginnings of these lengths are terms beside whole words.
PREFIXES = range(3, 9)
#: A term needs this many toxic texts and this share of its texts, corrected for sampling.
MIN_TOXIC, MIN_SHARE = 3, 0.5
TERMS, VOTERS = 2048, 44
ROUNDS = 12
THRESHOLD = 0.3
#: Share a label has in the posterior of its text; voters have the rest.
TRUST = 0.9
#: Penalty on the mean loss.
RIDGE = 2e-4
_WORD = re.compile(r"[^\W\d_]+")
_SHOUT = re.compile(r"\b[A-Z]{4,}\b")
_LOUD = re.compile(r"[A-Z]{4}")
_MASKED = re.compile(r"[*#@$%]{2}")
_LONG = re.compile(r"(.)\1{3}")
SYMBOLS = "#*$%&|<>"
#: Words of address in the languages most common in web text.
ADDRESS = frozenset("you your du dich dein tu toi vous ton tú usted eres".split())
_CACHE = 1 << 18


def held_out(id_col: str = "doc_id") -> Column:
    return F.crc32(F.col(id_col).cast("string").cast("binary")) % 4 == 2


def _terms(word: str) -> list[str]:
    """The word and its beginnings, these marked by a star."""
    return [word, *(f"{word[:n]}*" for n in PREFIXES if n <= len(word))]


class _Hits:
    """Terms of texts. Words that hit nothing are remembered, so that most of a text is set aside at once."""

    def __init__(self, terms: list[str]):
        self.number = {t: i for i, t in enumerate(terms)}
        self.none: set[str] = set()
        self.some: dict[str, tuple[int, ...]] = {}

    def _look_up(self, words: set[str]) -> dict[str, tuple[int, ...]]:
        if len(self.none) + len(self.some) > _CACHE:
            self.none, self.some = set(), {}
        found = {}
        for word in words - self.none:
            if word not in self.some:
                hits = tuple(self.number[t] for t in _terms(word) if t in self.number)
                if not hits and word not in ADDRESS and not _LONG.search(word):
                    self.none.add(word)
                    continue
                self.some[word] = hits
            found[word] = self.some[word]
        return found

    def read(self, text: str) -> tuple[list[int], int]:
        """Distinct terms of a whole text, and its votes as a mask: lexicon voters from the lowest bit on, then the patterns."""
        order = _WORD.findall(text.lower())
        odd = self._look_up(set(order))
        hits = {h for found in odd.values() for h in found}
        lexicon = {w for w, found in odd.items() if found and min(found) < VOTERS}
        places = [i for i, w in enumerate(order) if w in lexicon] if lexicon else []
        near = bool(places) and not ADDRESS.isdisjoint(odd) and any(not ADDRESS.isdisjoint(order[max(0, i - 3):i]) for i in places)
        mask = sum(1 << t for t in hits if t < VOTERS)
        symbols = sum(map(text.count, SYMBOLS))
        patterns = (
            mask.bit_count() >= 2, len(places) >= 3, near, any(b - a <= 2 for a, b in zip(places, places[1:], strict=False)),
            bool(_LOUD.search(text)) and len(_SHOUT.findall(text)) >= 3, bool(_MASKED.search(text)), "!!" in text,
            any(_LONG.search(w) for w in odd), not hits, len(order) >= 150 and not places, len(order) < 20,
            bool(places) and len(places) * 500 < len(order), sum(map(eq, order, order[1:])) >= 5, symbols * 40 > len(text) + 40,
        )
        return sorted(hits), mask | sum(1 << (VOTERS + i) for i, on in enumerate(patterns) if on)


PATTERNS = 14
FEATURE_BITS = VOTERS + PATTERNS
LABEL_BITS = 2  # labelled toxic, labelled clean
_BITS = FEATURE_BITS + LABEL_BITS


@dataclass(frozen=True)
class LabelModel:
    """How often voters fire in the clean and the toxic class, and what a voter counts beside those it agrees with."""

    prior: float
    rates: np.ndarray  # (2, bits)
    weight: np.ndarray  # (bits,)

    def log_odds(self, votes: np.ndarray) -> np.ndarray:
        fired = self.weight * np.log(self.rates[1] / self.rates[0])
        silent = self.weight * np.log((1 - self.rates[1]) / (1 - self.rates[0]))
        # a text without label says nothing by that
        silent[FEATURE_BITS:] = 0
        return np.log(self.prior / (1 - self.prior)) + votes @ fired + (1 - votes) @ silent

    def posterior(self, votes: np.ndarray) -> np.ndarray:
        """Probability of the toxic class; where there is a label, it has the share ``TRUST`` in it."""
        free = 1 / (1 + np.exp(-np.clip(self.log_odds(votes), -30, 30)))
        toxic, clean = votes[:, FEATURE_BITS], votes[:, FEATURE_BITS + 1]
        return free + TRUST * (toxic * (1 - free) - clean * free)


def _bits(masks: np.ndarray) -> np.ndarray:
    return (masks.astype(np.int64)[:, None] >> np.arange(_BITS) & 1).astype(np.float64)


def _moments(patterns: DataFrame, model: LabelModel | None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Per class: texts, fires of each voter, joint fires of each pair. Without a model, the labels alone tell the class."""
    def run(batches: Iterator[dict[str, list]]) -> Iterator[dict[str, list]]:
        size = 2 * (1 + _BITS + _BITS * _BITS)
        total = np.zeros(size)
        for b in batches:
            votes, n = _bits(np.array(b["mask"])), np.array(b["n"], float)
            if model is None:
                shares = np.stack([votes[:, FEATURE_BITS + 1], votes[:, FEATURE_BITS]])
            else:
                q = model.posterior(votes)
                shares = np.stack([1 - q, q])
            for y, share in enumerate(shares * n):
                part = np.concatenate([[share.sum()], share @ votes, ((votes * share[:, None]).T @ votes).ravel()])
                total[y * size // 2:(y + 1) * size // 2] += part
        yield {"sums": [total.tolist()]}

    # one row per task over a table of distinct masks
    rows = map_rows(patterns, run, "sums array<double>").toLocalIterator()
    total = sum((np.array(r.sums) for r in rows), np.zeros(2 * (1 + _BITS + _BITS * _BITS))).reshape(2, -1)
    return total[:, 0], total[:, 1:1 + _BITS], total[:, 1 + _BITS:].reshape(2, _BITS, _BITS)


def _maximised(n: np.ndarray, fires: np.ndarray, pairs: np.ndarray) -> LabelModel:
    rates = np.clip((fires + 0.1) / (n[:, None] + 0.2), 1e-6, 1 - 1e-6)
    # correlations within the classes
    clear = np.zeros((_BITS, _BITS))
    for y in range(2):
        mean = fires[y] / max(n[y], 1)
        cov = pairs[y] / max(n[y], 1) - np.outer(mean, mean)
        spread = np.sqrt(np.maximum(np.diag(cov), 1e-9))
        clear = np.maximum(clear, (cov / np.outer(spread, spread)) ** 2)
    np.fill_diagonal(clear, 0)
    clear[:, FEATURE_BITS:] = clear[FEATURE_BITS:] = 0  # labels aren't made from the text
    clear[clear < 0.01] = 0
    return LabelModel(float(np.clip(n[1] / max(n.sum(), 1), 1e-6, 1 - 1e-6)), rates, 1 / (1 + clear.sum(axis=1)))


def fit_label_model(patterns: DataFrame, rounds: int = ROUNDS) -> LabelModel:
    """Label model of a table (mask, n); starts from the labelled masks and goes on over all."""
    model = _maximised(*_moments(patterns, None))
    for _ in range(rounds):
        then = _maximised(*_moments(patterns, model))
        still = np.abs(then.rates - model.rates).max() < 1e-4
        model = then
        if still:
            break
    return model


@dataclass(frozen=True)
class Model:
    terms: list[str]
    weights: np.ndarray  # terms, then patterns
    bias: float
    labels: LabelModel | None


def _labelled(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(digest, id, toxic) of each distinct labelled text, by the majority of its labels."""
    marks = labels.filter(F.col("toxic").isNotNull()).groupBy(F.col(id_col).alias("id")).agg(F.avg("toxic").alias("toxic"))
    texts = docs.select(F.col(id_col).alias("id"), F.md5(text_col).alias("digest")).filter("digest IS NOT NULL")
    return texts.join(marks, "id").groupBy("digest").agg(F.min("id").alias("id"), (F.avg("toxic") > 0.5).cast("int").alias("toxic"))


def _mined(sample: DataFrame, share: tuple[float, float], sizes: tuple[int, int]) -> list[str]:
    """Terms of the sample by likelihood ratio, the strongest first; a longer one is left out beside a beginning as pure as itself."""
    def run(batches: Iterator[dict[str, list]]) -> Iterator[dict[str, list]]:
        counts: tuple[Counter, Counter] = Counter(), Counter()
        for b in batches:
            for text, toxic in zip(b["text"], b["toxic"], strict=True):
                counts[toxic].update({t for w in set(_WORD.findall(text.lower())) for t in _terms(w)})
        terms = [*(counts[0].keys() | counts[1].keys())]
        yield {"term": pa.array(terms, pa.string()), "clean": pa.array([counts[0][t] for t in terms], pa.int64()),
               "bad": pa.array([counts[1][t] for t in terms], pa.int64())}

    counts = map_rows(sample.select("text", "toxic"), run, "term string, clean long, bad long").groupBy("term").agg(
        F.sum("clean").alias("clean"), F.sum("bad").alias("bad")).filter(F.col("bad") >= MIN_TOXIC)
    # in texts of the corpus, of which the sample holds a share of each class
    bad, clean = F.col("bad") / share[1], F.col("clean") / share[0]
    purity = bad / (bad + clean)
    base = sizes[1] / sum(sizes)
    n = F.col("bad") + F.col("clean") * (share[1] / share[0])
    part = lambda k, p: F.when(k > 0, k * F.log(k / (n * p))).otherwise(0.0)
    gain = 2 * (part(F.col("bad"), F.lit(base)) + part(F.col("clean") * (share[1] / share[0]), F.lit(1 - base)))
    tested = counts.withColumn("purity", purity).withColumn("gain", gain).filter(F.col("purity") >= max(MIN_SHARE, min(0.95, 2 * base)))
    best = tested.orderBy(F.col("gain").desc(), F.length("term"), "term").limit(8 * TERMS).select("term", "purity", "gain").collect()
    least = 2 * np.log(max(len(best), 2))
    purity_of = {r.term: r.purity for r in best if r.gain >= least}
    chosen = []
    for term in purity_of:
        shorter = [f"{term[:n]}*" for n in PREFIXES if n < len(term.rstrip("*")) or (n == len(term) and not term.endswith("*"))]
        if all(purity_of.get(s, -1) < purity_of[term] - 0.005 for s in shorter):
            chosen.append(term)
    return chosen[:TERMS]


def _logistic(rows: np.ndarray, columns: np.ndarray, target: np.ndarray, weight: np.ndarray, features: int) -> tuple[np.ndarray, float]:
    """Weights and bias of least weighted log loss plus ridge, features being zero or one; accelerated gradient."""
    n = len(target)
    weight = weight / weight.sum()
    bound = 0.25 * (np.bincount(rows, minlength=n).max(initial=0) + 1) + RIDGE
    w = np.zeros(features + 1)
    ahead, pace = w.copy(), 1.0
    for _ in range(3000):
        z = np.bincount(rows, ahead[columns], n) + ahead[-1]
        slope = weight * (1 / (1 + np.exp(-np.clip(z, -30, 30))) - target)
        gradient = np.append(np.bincount(columns, slope[rows], features), slope.sum())
        gradient[:-1] += RIDGE * ahead[:-1]
        then = ahead - gradient / bound
        faster = (1 + np.sqrt(1 + 4 * pace * pace)) / 2
        ahead = then + (pace - 1) / faster * (then - w)
        if np.abs(then - w).max() < 1e-6:
            w = then
            break
        w, pace = then, faster
    return w[:-1], float(w[-1])


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> Model:
    """Model from training documents; ``labels`` has their ids and ``toxic``. Documents without a label still teach the label model."""
    known = stored(_labelled(docs, labels, id_col, text_col), "labelled")
    sizes = {r.toxic: r["count"] for r in known.groupBy("toxic").count().toLocalIterator()}
    if not sizes.get(0) or not sizes.get(1):
        n, bad = sum(sizes.values()), sizes.get(1, 0)
        p = (bad + 0.1) / (n + 1)
        return Model([], np.zeros(PATTERNS), float(np.log(p / (1 - p))), None)
    order = Window.partitionBy("toxic").orderBy("digest")
    # at most SAMPLE_PER_CLASS rows of each class, whatever the input
    drawn = known.withColumn("at", F.row_number().over(order)).filter(F.col("at") <= SAMPLE_PER_CLASS).drop("at")
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.md5(text_col).alias("digest"))
    sample = stored(texts.join(F.broadcast(drawn), ["id", "digest"]).dropDuplicates(["digest"]), "sample")
    share = tuple(min(1.0, SAMPLE_PER_CLASS / sizes[y]) for y in range(2))
    terms = _mined(sample, share, (sizes[0], sizes[1]))

    def votes(batches: Iterator[dict[str, list]]) -> Iterator[dict[str, list]]:
        hits = _Hits(terms)
        for b in batches:
            yield {"digest": pa.array(b["digest"], pa.string()), "mask": pa.array([hits.read(t)[1] for t in b["text"]], pa.int64())}

    masks = map_rows(texts.filter("digest IS NOT NULL").select("digest", "text"), votes, "digest string, mask long").groupBy("digest").agg(F.min("mask").alias("mask"))
    labelled = F.when(F.col("toxic") == 1, 1 << FEATURE_BITS).when(F.col("toxic") == 0, 2 << FEATURE_BITS).otherwise(0)
    patterns = stored(
        masks.join(known.select("digest", "toxic"), "digest", "left").groupBy((F.col("mask") + labelled.cast("long")).alias("mask"))
        .agg(F.count(F.lit(1)).alias("n")), "patterns")
    model = fit_label_model(patterns)
    remove(patterns)

    def read(batches: Iterator[dict[str, list]]) -> Iterator[dict[str, list]]:
        hits = _Hits(terms)
        for b in batches:
            found = [hits.read(t) for t in b["text"]]
            yield {"toxic": pa.array(b["toxic"], pa.int32()), "mask": pa.array([m for _, m in found], pa.int64()),
                   "hits": pa.array([h for h, _ in found], pa.list_(pa.int32()))}

    # at most two classes' samples of short lists
    rows = map_rows(sample.select("text", "toxic"), read, "toxic int, mask long, hits array<int>").collect()
    toxic = np.array([r.toxic for r in rows])
    posterior = model.posterior(_bits(np.array([r.mask for r in rows]) + np.where(toxic == 1, 1 << FEATURE_BITS, 2 << FEATURE_BITS)))
    features = [r.hits + [len(terms) + i for i in range(PATTERNS) if r.mask >> (VOTERS + i) & 1] for r in rows]
    at = np.repeat(np.arange(len(rows)), [len(f) for f in features])
    columns = np.array([c for f in features for c in f], np.int64)
    weights, bias = _logistic(at, columns, posterior, np.where(toxic == 1, 1 / share[1], 1 / share[0]), len(terms) + PATTERNS)
    return Model(terms, weights, bias, model)


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``keep`` columns with score (0 to 1) and predicted (1 from ``THRESHOLD`` on) of every row's whole text; a null text counts as empty."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hits, weights = _Hits(model.terms), model.weights
        for batch in batches:
            scores = []
            for text in batch.column(0):
                found, mask = hits.read(text.as_py() or "")
                z = model.bias + sum(weights[t] for t in found) + sum(weights[len(model.terms) + i] for i in range(PATTERNS) if mask >> (VOTERS + i) & 1)
                scores.append(float(1 / (1 + np.exp(-min(max(z, -30.0), 30.0)))))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[1:], pa.array(scores, pa.float64()), pa.array([int(s >= THRESHOLD) for s in scores], pa.int32())],
                [*batch.schema.names[1:], "score", "predicted"])

    own = docs.select(F.col(text_col).alias("_scored_text"), *keep)
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in own.schema.fields[1:])
    return own.mapInArrow(run, f"{kinds}, score double, predicted int")


def toxicity(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: id, held_out, score, predicted.

    Learns labels only from documents that aren't held out (CRC-32 of the id as text, modulo 4, is not 2); a prediction reads the text alone. A
    null id is not held out and has no label; a null text scores as an empty one. Repeated rows are scored each, distinct texts teach
    once, by the majority of their labels. Without labels of both classes all texts have one score. Other columns are not read.
    """
    out = F.coalesce(held_out(id_col), F.lit(False))
    model = fit(docs.filter(~out), labels.filter(~out), id_col, text_col)
    return score(docs.withColumn("held_out", out), model, id_col, text_col, (id_col, "held_out"))
