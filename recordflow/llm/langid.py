"""Language identification by nearest centroids.

A text, in lower case, is the vector of its hashed byte n-grams: sublinear counts, weighted by inverse
document frequency, of length one. Each language has several centroids, found by spherical k-means on
a bounded sample of its labelled texts; document frequencies count every labelled text. A text gets
the language of the closest centroid by cosine, or is rejected when it is farther from that one than all
but a few labelled texts of the language and of its length. Those distances are counted over all labelled texts that
the centroids were not fitted on.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from recordflow.llm.common import row_chunks, staged

#: Dimensions of the hashed n-gram vectors, and the lengths of the n-grams in bytes.
DIMENSIONS = 4096
GRAMS = (2, 3, 4)
#: Labelled texts that the centroids are fitted on: in all, and at least of each language.
SAMPLE_ROWS = 2_000
SAMPLE_LEAST = 50
CENTROIDS = 6
ROUNDS = 12
#: At least this share of the labelled texts of a language stays outside the sample.
OUTSIDE = 0.25
#: A text is rejected below the cosine that this share of the labelled texts like it do not reach.
QUANTILE = 0.01
#: Labelled texts that a cut takes.
CUT_LEAST = 100
REJECTED = "und"
_BLOCK = 1 << 20
_ROWS = 128


def gram_counts(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Counts of the hashed n-grams of each text; n-grams do not cross texts."""
    out = np.zeros((len(offsets) - 1) * DIMENSIONS, np.float32)
    for low in range(0, len(data), _BLOCK):
        high = min(low + _BLOCK, len(data))
        part = data[low : min(high + max(GRAMS) - 1, len(data))].astype(np.uint32)
        doc = np.searchsorted(offsets, np.arange(low, high), side="right") - 1
        room = offsets[doc + 1] - np.arange(low, high)
        base = doc * DIMENSIONS
        gram = np.zeros(high - low, np.uint32)
        for n in range(1, max(GRAMS) + 1):
            n_here = len(part) - n + 1
            if n_here <= 0:
                break
            gram = gram[:n_here] | part[n - 1 : n - 1 + len(gram)][: len(gram[:n_here])] << np.uint32(8 * (n - 1))
            if n in GRAMS:
                ok = room[: len(gram)] >= n
                cell = (gram[ok] * np.uint32(2654435761 + 2 * 97 * n & 0xFFFFFFFF | 1)) >> np.uint32(20)
                at = base[: len(gram)][ok] + cell
                if len(at):
                    first = int(at.min())
                    counts = np.bincount(at - first)
                    out[first : first + len(counts)] += counts
    return out.reshape(-1, DIMENSIONS)


def _small(batches: Iterator[pa.RecordBatch]):
    for batch, data, offsets in row_chunks(batches, "text", _BLOCK):
        for at in range(0, batch.num_rows, _ROWS):
            ends = offsets[at : at + _ROWS + 1]
            yield batch.slice(at, _ROWS), data[ends[0] : ends[-1]], ends - ends[0]


@dataclass(frozen=True)
class Model:
    labels: np.ndarray  # of each centroid, in code-point order
    centroids: np.ndarray
    weights: np.ndarray  # inverse document frequencies
    cuts: dict[str, np.ndarray]  # of each language, lowest accepted cosine by the power of two of a text's n-grams

    def vectors(self, counts: np.ndarray) -> np.ndarray:
        out = np.log1p(counts) * self.weights
        norm = np.sqrt((out * out).sum(1, keepdims=True))
        return out / np.maximum(norm, 1e-12)


def _band(counts: np.ndarray) -> np.ndarray:
    return np.minimum(31, np.log2(1 + counts.sum(1))).astype(np.int64)


def _collect(rates: dict[str, float]):
    """Each task's document frequencies, and the n-gram counts of its sampled texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, docs = np.zeros(DIMENSIONS, np.int64), 0
        names = ["lang", "chance", "blob", "docs"]
        for batch, data, offsets in _small(batches):
            counts = gram_counts(data, offsets)
            total += (counts > 0).sum(0)
            docs += len(counts)
            langs, chance = batch.column("lang").to_pylist(), batch.column("chance").to_numpy()
            picked = [i for i, lang in enumerate(langs) if chance[i] < rates.get(lang, 1.0)]
            if picked:
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([langs[i] for i in picked]),
                        pa.array(chance[picked]),
                        pa.array([counts[i].astype("<f4").tobytes() for i in picked], pa.binary()),
                        pa.array([None] * len(picked), pa.int64()),
                    ],
                    names,
                )
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([None], pa.string()),
                pa.array([None], pa.float64()),
                pa.array([total.tobytes()], pa.binary()),
                pa.array([docs], pa.int64()),
            ],
            names,
        )

    return run


def _add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total, docs = np.zeros(DIMENSIONS, np.int64), 0
    for batch in batches:
        for blob, n in zip(batch.column("blob").to_pylist(), batch.column("docs").to_pylist()):
            total += np.frombuffer(blob, np.int64)
            docs += n
    yield pa.RecordBatch.from_pydict({"blob": pa.array([total.tobytes()], pa.binary()), "docs": [docs]})


def spherical_means(x: np.ndarray, k: int, rounds: int = ROUNDS) -> np.ndarray:
    """Unit centroids of unit vectors; starts from the vectors farthest from each other."""
    centers = [x.mean(0)]
    near = x @ centers[0]
    while len(centers) < min(k, len(x)):
        centers.append(x[int(near.argmin())])
        near = np.maximum(near, x @ centers[-1])
    c = np.stack(centers)
    for _ in range(rounds):
        c /= np.maximum(np.linalg.norm(c, axis=1, keepdims=True), 1e-12)
        own = (x @ c.T).argmax(1)
        c = np.stack([x[own == i].mean(0) if (own == i).any() else c[i] for i in range(len(c))])
    return c / np.maximum(np.linalg.norm(c, axis=1, keepdims=True), 1e-12)


def fit(labelled: DataFrame, sample_rows: int = SAMPLE_ROWS) -> Model | None:
    """Fit on rows with ``text`` and ``lang``; rows without a language or letters are left out.

    The driver holds the frequencies (fixed size), a count per language, and the sample:
    ``sample_rows`` n-gram vectors, though at least ``SAMPLE_LEAST`` of each language, drawn by a hash
    of the text. None without labelled rows.
    """
    spark = labelled.sparkSession
    rows = labelled.where(F.col("lang").isNotNull() & has_letter(F.col("text"))).select(
        "lang", F.lower("text").alias("text"), ((F.xxhash64("text") % 1_000_003) / 2_000_006 + 0.5).alias("chance")
    )
    sizes = {r["lang"]: r["count"] for r in rows.groupBy("lang").count().collect()}
    if not sizes:
        return None
    each = max(SAMPLE_LEAST, sample_rows // len(sizes))
    rates = {lang: min(1 - OUTSIDE, 1.2 * each / n) for lang, n in sizes.items()}
    seen = staged(rows.mapInArrow(_collect(rates), "lang string, chance double, blob binary, docs long"), "grams")
    parts = seen.where(F.col("lang").isNull()).select("blob", "docs")
    sums = parts.repartition(16).mapInArrow(_add, "blob binary, docs long").collect()
    frequency = sum(np.frombuffer(r["blob"], np.int64) for r in sums)
    docs = sum(r["docs"] for r in sums)
    weights = (np.log((1 + docs) / (1 + frequency)) + 0.1).astype(np.float32)
    order = Window.partitionBy("lang").orderBy("chance", "blob")
    sample = (
        seen.where(F.col("lang").isNotNull())
        .withColumn("place", F.row_number().over(order))
        .where(F.col("place") <= each)
        .select("lang", "blob")
        .collect()
    )
    empty = Model(np.zeros(0, object), np.zeros((0, DIMENSIONS), np.float32), weights, {})
    counts = np.stack([np.frombuffer(r["blob"], "<f4") for r in sample]) if sample else np.zeros((0, DIMENSIONS), np.float32)
    x, langs = empty.vectors(counts), np.array([r["lang"] for r in sample], dtype=object)
    labels, centroids = [], []
    for lang in sorted(sizes):
        mine = langs == lang
        if mine.any():
            c = spherical_means(x[mine], CENTROIDS)
            labels += [lang] * len(c)
            centroids.append(c)
    if not labels:
        return None
    model = Model(np.array(labels, dtype=object), np.concatenate(centroids).astype(np.float32), weights, {})
    outside = F.lit(False)
    for lang, rate in rates.items():
        outside = outside | ((F.col("lang") == lang) & (F.col("chance") >= rate))
    measured = rows.where(outside).mapInArrow(_measure(model), "lang string, band int, score double")
    step = F.floor(F.col("score") * _STEPS).cast("int").alias("step")
    # A row for each language, power of two and hundredth at most.
    found = measured.groupBy("lang", "band", step).count().collect()
    seen = {lang: np.zeros((32, _STEPS + 1), np.int64) for lang in set(labels)}
    for r in found:
        if r["lang"] in seen:
            seen[r["lang"]][r["band"], min(max(r["step"], 0), _STEPS)] += r["count"]
    every = sum(seen.values())
    cuts = {lang: _cuts(counts, every) for lang, counts in seen.items()}
    return Model(model.labels, model.centroids, weights, cuts)


#: Steps that cosines are counted in.
_STEPS = 100
def _low(counts: np.ndarray) -> float:
    """The low quantile of cosines counted in steps, rounded down."""
    return int(np.searchsorted(np.cumsum(counts), QUANTILE * counts.sum())) / _STEPS


def _cuts(counts: np.ndarray, every: np.ndarray) -> np.ndarray:
    """A cut for each length, of a language's ``counts`` by length and step and those of ``every`` language.

    Where the language has few texts of a length, all languages count, and then shorter texts as well, which
    are farther from the centroids. Nothing is rejected where all that is not enough.
    """
    out = np.zeros(32)
    for b in range(32):
        tries = [counts[b], *(every[b - reach : b + 1].sum(0) for reach in range(b + 1))]
        out[b] = next((_low(x) for x in tries if x.sum() >= CUT_LEAST), 0.0)
    return out


def _measure(model: Model):
    """How near labelled texts are to their own language."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, data, offsets in _small(batches):
            counts = gram_counts(data, offsets)
            langs = np.array(batch.column("lang").to_pylist(), dtype=object)
            near = model.vectors(counts) @ model.centroids.T
            near[langs[:, None] != model.labels[None]] = 0
            yield pa.RecordBatch.from_arrays(
                [batch.column("lang"), pa.array(_band(counts).astype(np.int32)), pa.array(near.max(1).astype(np.float64))],
                ["lang", "band", "score"],
            )

    return run


def has_letter(text: Column) -> Column:
    return F.coalesce(text.rlike(r"\p{L}"), F.lit(False))


def _predict(model: Model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, data, offsets in _small(batches):
            counts = gram_counts(data, offsets)
            near = model.vectors(counts) @ model.centroids.T
            best = near.argmax(1)
            score = np.clip(near.max(1), 0.0, 1.0).astype(np.float64)
            letters = np.asarray(batch.column("letters"))
            cut = np.array([model.cuts[model.labels[i]][b] for i, b in zip(best, _band(counts))])
            ok = letters & (score >= cut)
            lang = np.where(ok, model.labels[best], REJECTED)
            yield pa.RecordBatch.from_arrays(
                [batch.column("row"), pa.array(lang, pa.string()), pa.array(np.where(letters, score, 0.0))],
                ["row", "lang_pred", "score"],
            )

    return run


def identify(docs: DataFrame, model: Model | None, keep: list[str] | None = None) -> DataFrame:
    """``row`` (the columns of ``docs``, or those named), ``lang_pred`` and ``score`` of every row.

    Only the text is an input of the prediction. ``und`` with score 0 for null, empty and letterless
    texts, and for all texts when there was nothing to learn from; ``und`` with its cosine for a text
    that is too far from every centroid. Equal texts get equal results; the first language in
    code-point order wins a tie. The row is a struct, so other columns cannot clash.
    """
    row = F.struct(*(keep or docs.columns))
    if model is None:
        return docs.select(row.alias("row"), F.lit(REJECTED).alias("lang_pred"), F.lit(0.0).alias("score"))
    rows = docs.select(row.alias("row"), F.lower("text").alias("text"), has_letter(F.col("text")).alias("letters"))
    kind = rows.schema["row"].dataType.simpleString()
    return rows.mapInArrow(_predict(model), f"row {kind}, lang_pred string, score double")
