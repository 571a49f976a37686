"""Language identification by the nearest of several centroids per language, over TF-IDF n-gram vectors.

Texts become hashed counts of byte bigrams and trigrams of their letters, damped, weighted by inverse document
frequency over all training rows and normalised. Each language has a few centroids (spherical k-means on a bounded
sample); a text takes the language of its closest centroid by cosine and is rejected if it lies too far from it.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfwise.llm.common import tidy

BITS = 11
DIMS = 1 << BITS
#: Rows per language the centroids are clustered from, at most.
SAMPLE_PER_LANGUAGE = 500
CENTROIDS = 4
#: A text is rejected below this part of the cosine that all but ``QUANTILE`` of its language's training rows have to their centroids.
REJECT = 0.85
QUANTILE = 0.005
#: Texts of fewer n-grams are short: they are left out of the quantile unless a language has no others, and need this part of it.
SHORT_GRAMS, SHORT_PART = 128, 0.45
_SLICE = 256
_LETTER = re.compile(r"[^\W\d_]")
_LETTERS = bytes(c if c >= 0x80 or chr(c).isalpha() else 0x20 for c in range(256))


def counts(text: str | None) -> np.ndarray | None:
    """Hashed n-gram counts of a whole text; None if it is null or has no letter."""
    if not text or not _LETTER.search(text):
        return None
    data = np.frombuffer(b" " + b" ".join(text.lower().encode().translate(_LETTERS).split()) + b" ", np.uint8).astype(np.uint32)
    pairs = data[:-1] << np.uint32(8) | data[1:]
    triples = pairs[:-1] << np.uint32(8) | data[2:]
    shift = np.uint32(32 - BITS)
    found = np.bincount((pairs + np.uint32(1 << 24)) * np.uint32(2654435761) >> shift, minlength=DIMS)
    return found + np.bincount(triples * np.uint32(2246822519) >> shift, minlength=DIMS)


def _vectors(texts: list[str | None], idf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Normalised TF-IDF rows, zero for texts without letters, and which texts are short."""
    out = np.zeros((len(texts), DIMS), dtype=np.float32)
    grams = np.zeros(len(texts), dtype=np.int64)
    for i, text in enumerate(texts):
        if (found := counts(text)) is not None:
            out[i] = np.log1p(found)
            grams[i] = found.sum()
    out *= idf
    norm = np.sqrt((out * out).sum(axis=1, keepdims=True))
    return out / np.where(norm > 0, norm, 1), grams < SHORT_GRAMS


@dataclass(frozen=True)
class Model:
    """idf by dimension, centroid rows, the language of each and the lowest cosine accepted for it if a text isn't short."""

    idf: np.ndarray
    centroids: np.ndarray
    languages: list[str]
    floors: np.ndarray


def _document_frequency(train: DataFrame) -> tuple[int, np.ndarray]:
    """Rows and rows with each dimension over all training texts; every task returns one vector of fixed length."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(DIMS + 1, dtype=np.int64)
        for batch in batches:
            for x in batch.column(0):
                if (found := counts(x.as_py())) is not None:
                    total[:DIMS] += found > 0
                    total[DIMS] += 1
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(DIMS + 1)), pa.array(total)], ["dim", "n"])

    rows = train.select("text").mapInArrow(tidy(run), "dim long, n long").groupBy("dim").agg(F.sum("n").alias("n")).collect()
    total = np.zeros(DIMS + 1, dtype=np.int64)
    for row in rows:
        total[row.dim] = row.n
    return int(total[DIMS]), total[:DIMS]


def _cluster(vectors: np.ndarray, k: int) -> np.ndarray:
    """Spherical k-means from farthest-first seeds; rows of ``vectors`` come in a fixed order, so the result is too."""
    seeds = [vectors.mean(axis=0)]
    for _ in range(min(k, len(vectors))):
        closest = np.max(vectors @ np.array(seeds).T, axis=1)
        seeds.append(vectors[int(np.argmin(closest))])
    centroids = np.array(seeds[1:])
    for _ in range(12):
        own = np.argmax(vectors @ centroids.T, axis=1)
        sums = np.array([vectors[own == i].sum(axis=0) if (own == i).any() else centroids[i] for i in range(len(centroids))])
        centroids = sums / np.maximum(np.sqrt((sums * sums).sum(axis=1, keepdims=True)), 1e-12)
    return centroids.astype(np.float32)


def _sample(train: DataFrame, id_col: str, per_language: int) -> DataFrame:
    """(lang, text, place): up to ``per_language`` rows of each language, those with the smallest hash of their id, or of the text without one.

    Rows are thinned by hash before they are ranked, so that a ranking sees a small multiple of the bound.
    """
    place = F.when(F.col(id_col).isNull(), F.xxhash64("text")).otherwise(F.xxhash64(id_col))
    # equal rows have one place, so it is places that are thinned
    sizes = train.groupBy("lang").agg(F.approx_count_distinct(place).alias("n"))
    share = F.pmod(place, F.lit(1 << 20)) / F.lit(float(1 << 20))
    # one row per language value; equal rows beyond the bound are cut in every task
    thin = train.join(F.broadcast(sizes), "lang").filter(share * F.col("n") < 2.0 * per_language).select("lang", "text", place.alias("place"))
    order = Window.partitionBy("lang").orderBy("place", F.xxhash64("text"))
    return thin.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= per_language).drop("rank")


def _low_cosines(train: DataFrame, idf: np.ndarray, centroids: np.ndarray, languages: list[str]) -> dict[str, float]:
    """The ``QUANTILE`` of each language's cosines to its own closest centroid, in thousandths, over all training rows."""
    own = {x: centroids[[y == x for y in languages]] for x in set(languages)}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, _SLICE):
                part = batch.slice(start, _SLICE)
                texts, names = part.column(0).to_pylist(), part.column(1).to_pylist()
                vectors, short = _vectors(texts, idf)
                keep = [i for i, name in enumerate(names) if name in own and vectors[i].any()]
                bins = [int(1000 * float((own[names[i]] @ vectors[i]).max())) for i in keep]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([names[i] for i in keep], pa.string()), pa.array(short[keep]), pa.array(bins, pa.int64())], ["lang", "short", "bin"])

    found: dict[tuple[str, bool], list[tuple[int, int]]] = {}
    for r in (train.select("text", "lang").mapInArrow(tidy(run), "lang string, short boolean, bin long")
              .groupBy("lang", "short", "bin").agg(F.count(F.lit(1)).alias("n")).collect()):
        found.setdefault((r.lang, r.short), []).append((r.bin, r.n))
    out = {}
    for name in own:
        bins, n = np.array(sorted(found.get((name, False)) or found[name, True])).T
        out[name] = float(bins[np.searchsorted(np.cumsum(n), QUANTILE * n.sum(), side="right")]) / 1000
    return out


def fit(labelled: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
        per_language: int = SAMPLE_PER_LANGUAGE, k: int = CENTROIDS, reject: float = REJECT) -> Model:
    """Model of rows with a language. Frequencies and the cosines accepted cover all of them; centroids a sample of ``per_language`` rows each.

    Rows without language or letters teach nothing. No usable row gives a model without languages.
    """
    train = labelled.filter(F.col(lang_col).isNotNull()).select(
        F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.col(lang_col).alias("lang"))
    rows, frequency = _document_frequency(train)
    idf = (np.log((1 + rows) / (1 + frequency)) + 1).astype(np.float32)

    def cluster(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        table = table.sort_by("place")
        vectors, _ = _vectors([x for x in table.column("text").to_pylist() if counts(x) is not None], idf)
        found = _cluster(vectors, k) if len(vectors) else np.zeros((0, DIMS), np.float32)
        return pa.table({"lang": pa.array([key[0].as_py()] * len(found), pa.string()),
                         "centroid": pa.array([c.tobytes() for c in found], pa.binary())})

    found = sorted(_sample(train, "id", per_language).groupBy("lang")
                   .applyInArrow(cluster, "lang string, centroid binary").collect(),
                   key=lambda r: (r.lang, bytes(r.centroid)))
    centroids = np.array([np.frombuffer(r.centroid, np.float32) for r in found], np.float32).reshape(-1, DIMS)
    languages = [r.lang for r in found]
    lowest = _low_cosines(train, idf, centroids, languages)
    return Model(idf, centroids, languages, np.array([lowest.get(x, 0.0) * reject for x in languages]))


def predict(docs: DataFrame, model: Model, text_col: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``keep`` columns with lang_pred, score (cosine to the closest centroid, 0 to 1) and rejected.

    Null texts and texts without letters get ``und``, score 0 and are rejected; so does everything under a model without languages.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, _SLICE):
                part = batch.slice(start, _SLICE)
                texts = part.column(at).to_pylist()
                names, scores, far = ["und"] * len(texts), np.zeros(len(texts)), np.ones(len(texts), bool)
                if model.languages:
                    vectors, short = _vectors(texts, model.idf)
                    cosine = vectors @ model.centroids.T
                    best = np.argmax(cosine, axis=1)
                    top = cosine[np.arange(len(texts)), best].astype(float)
                    seen = np.array([bool(t) and _LETTER.search(t) is not None for t in texts])
                    names = [model.languages[b] if s else "und" for b, s in zip(best, seen, strict=True)]
                    scores = np.where(seen, np.clip(top, 0, 1), 0.0)
                    far = ~seen | (top < model.floors[best] * np.where(short, SHORT_PART, 1.0))
                yield pa.RecordBatch.from_arrays(
                    [*part.columns[:len(keep)], pa.array(names, pa.string()), pa.array(scores), pa.array(far)],
                    [*keep, "lang_pred", "score", "rejected"])

    # a text that is kept is sent once
    own = docs.select(*keep) if text_col in keep else docs.select(*keep, F.col(text_col).alias("_text_of_row"))
    at = keep.index(text_col) if text_col in keep else len(keep)
    schema = ", ".join(f"`{c}` {own.schema[c].dataType.simpleString()}" for c in keep)
    return own.mapInArrow(tidy(run), f"{schema}, lang_pred string, score double, rejected boolean")


def held_out(id_col: str = "doc_id", folds: int = 5, fold: int = 0) -> Column:
    """Rows kept from training: crc32 of the id as text has this remainder. A null id is trained on."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % folds == fold, F.lit(False))
