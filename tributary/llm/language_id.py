"""Language identification by the nearest of several centroids per language.

A text becomes a vector of hashed n-grams of its lower-cased letters (1 to 3, a gap between words counts
as a sign), weighted by log frequency and inverse document frequency and normalised. The training texts
of a language are clustered by cosine into a few centroids; a text gets the language of the nearest one.
A text whose nearest centroid is farther than the distance bound of its language is rejected: the
language is still named, but not trusted. The bound comes from the language's own training texts. Few
letters tell little, so the bound of a short text falls in proportion to its n-grams.

The model is fitted on a sample of about ``sample_rows`` labelled texts (the same expected number of each
language, chosen by a hash of the id), whole texts, whose sparse vectors go to the driver: at most
``buckets`` numbers each. How many labelled rows a language has is counted over all rows.

Null texts and texts without a letter are ``und`` with score 0, and rejected; so is everything if there
are no labels. Rows are independent, repeated rows and null ids included; no other column is looked at.
"""

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tributary.llm.common import fold_of

UNKNOWN = "und"
GAP = 32
CHUNK = 1 << 20  # code points looked at at once


@dataclass(frozen=True)
class Settings:
    sample_rows: int = 2000
    buckets: int = 1 << 13
    longest: int = 3
    centroids: int = 4
    rounds: int = 12
    slack: float = 0.5  # the bound, as a share of the similarity of the least similar training texts
    quantile: float = 0.02  # the share of training texts that count as least similar
    full_grams: int = 192  # n-grams (about three a letter) from which on the whole bound holds


@dataclass(frozen=True)
class Model:
    settings: Settings
    weights: np.ndarray  # inverse document frequency of each bucket
    centroids: np.ndarray  # one row each, normalised
    languages: tuple[str, ...]  # of each centroid
    floors: np.ndarray  # least similarity for each centroid


@cache
def _letters() -> np.ndarray:
    return np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000)


def gram_counts(text: str | None, settings: Settings) -> np.ndarray | None:
    """How often each bucket occurs; None if there is no letter."""
    counts, seen, tail = np.zeros(settings.buckets), False, np.array([GAP], np.uint64)
    text = text or ""
    for at in range(0, len(text), CHUNK):
        codes = np.frombuffer(text[at:at + CHUNK].lower().encode("utf-32-le", "surrogatepass"), "<u4")
        letter = _letters()[codes]
        seen |= bool(letter.any())
        new = np.where(letter, codes, GAP).astype(np.uint64)
        if at + CHUNK >= len(text):
            new = np.append(new, np.uint64(GAP))
        new = new[(new != GAP) | (np.append(tail[-1:], new[:-1]) != GAP)]
        signs = np.append(tail, new)
        gram = np.zeros(len(signs), np.uint64)
        for n in range(1, settings.longest + 1):
            gram = gram[:len(signs) - n + 1] * np.uint64(0x110000) + signs[n - 1:]
            key = (gram * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - settings.buckets.bit_length() + 1)
            ends_here = np.arange(len(gram)) + n > len(tail)
            counts += np.bincount(key[ends_here & (gram != GAP)].astype(np.int64), minlength=settings.buckets)
        tail = signs[1 - settings.longest:] if settings.longest > 1 else signs[-1:]
    return counts if seen else None


def _normal(counts: np.ndarray, weights: np.ndarray) -> np.ndarray:
    vector = np.log1p(counts) * weights
    return vector / np.maximum(np.linalg.norm(vector, axis=-1, keepdims=True), 1e-12)


def _clusters(vectors: np.ndarray, settings: Settings) -> np.ndarray:
    """Centroids of one language: farthest points first, then rounds of reassignment."""
    centres = [vectors.mean(axis=0)]
    nearest = vectors @ centres[0]
    for _ in range(min(settings.centroids, len(vectors)) - 1):
        centres.append(vectors[int(nearest.argmin())])
        nearest = np.maximum(nearest, vectors @ centres[-1])
    centres = np.array(centres)
    for _ in range(settings.rounds):
        own = (vectors @ centres.T).argmax(axis=1)
        centres = np.array([vectors[own == k].mean(axis=0) if (own == k).any() else c for k, c in enumerate(centres)])
        centres /= np.maximum(np.linalg.norm(centres, axis=1, keepdims=True), 1e-12)
    return centres


def fit(documents: DataFrame, settings: Settings = Settings(), id_col: str = "doc_id", text_col: str = "text",
        label_col: str = "lang", training: Column | None = None) -> Model:
    """The model of the labelled rows for which ``training`` holds."""
    rows = documents.select(
        F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"),
        F.col(label_col).cast("string").alias("label"), (F.lit(True) if training is None else training).alias("use"),
    ).where("use AND label IS NOT NULL AND text IS NOT NULL")
    sizes = {r["label"]: r["count"] for r in rows.groupBy("label").count().collect()}
    each = max(8, settings.sample_rows // max(1, len(sizes)))
    chosen = F.pmod(F.xxhash64("id", "text"), F.lit(1 << 30)) < F.coalesce(*[
        F.when(F.col("label") == label, int((1 << 30) * min(1.0, each / n))) for label, n in sizes.items()], F.lit(0))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for i, text, label in zip(*(batch.column(k) for k in range(3))):
                counts = gram_counts(text.as_py(), settings)
                if counts is not None:
                    at = np.flatnonzero(counts)
                    out.append((i.as_py(), label.as_py(), at.astype("<i4").tobytes(), counts[at].astype("<f4").tobytes()))
            kinds = (pa.int64(), pa.string(), pa.binary(), pa.binary())
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[k] for r in out], kind) for k, kind in enumerate(kinds)], ["id", "label", "at", "n"])

    # By id and text, over distinct rows: neither missing ids nor repeated rows make the sample larger.
    found = rows.where(chosen).select("id", "text", "label").distinct().mapInArrow(
        run, "id long, label string, at binary, n binary").collect()
    found.sort(key=lambda r: (r["label"], r["id"] is None, r["id"] or 0, bytes(r["at"]), bytes(r["n"])))
    counts = np.zeros((len(found), settings.buckets), np.float32)
    for k, r in enumerate(found):
        counts[k, np.frombuffer(r["at"], "<i4")] = np.frombuffer(r["n"], "<f4")
    weights = np.log((1 + len(found)) / (1 + np.count_nonzero(counts, axis=0))) + 1
    # In place: this is the largest array on the driver.
    np.log1p(counts, out=counts)
    counts *= weights.astype(np.float32)
    counts /= np.maximum(np.sqrt(np.einsum("ij,ij->i", counts, counts)), 1e-12)[:, None]
    vectors, labels = counts, np.array([r["label"] for r in found])
    centres, names, floors = [], [], []
    for label in sorted(set(labels)):
        own = vectors[labels == label]
        group = _clusters(own, settings)
        floor = settings.slack * float(np.quantile((own @ group.T).max(axis=1), settings.quantile))
        centres += list(group)
        names += [str(label)] * len(group)
        floors += [floor] * len(group)
    return Model(settings, weights, np.array(centres).reshape(-1, settings.buckets), tuple(names), np.array(floors))


def predict(text: str | None, model: Model) -> tuple[str, float, bool]:
    """Language, cosine of the nearest centroid, and whether it is too far."""
    counts = gram_counts(text, model.settings) if model.languages else None
    if counts is None:
        return UNKNOWN, 0.0, True
    near = model.centroids @ _normal(counts, model.weights)
    best = int(near.argmax())
    bound = model.floors[best] * min(1.0, counts.sum() / model.settings.full_grams)
    return model.languages[best], float(min(1.0, max(0.0, near[best]))), bool(near[best] < bound)


def identified(documents: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """The documents with ``lang_pred, score, rejected`` in place of columns of these names."""
    names = ["lang_pred", "score", "rejected"]
    rows = documents.select(F.col(f"`{text_col}`").cast("string").alias("__text"), *[
        F.col(f"`{c}`") for c in documents.columns if c not in names])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = [predict(t.as_py(), model) for t in batch.column(0)]
            added = [pa.array([r[k] for r in out], kind) for k, kind in enumerate((pa.string(), pa.float64(), pa.bool_()))]
            yield pa.RecordBatch.from_arrays([*batch.columns[1:], *added], [*batch.schema.names[1:], *names])

    schema = rows.drop("__text").schema.add("lang_pred", "string").add("score", "double").add("rejected", "boolean")
    return rows.mapInArrow(run, schema)


def accepted(documents: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """The documents, all columns, without those that are rejected."""
    rows = documents.select(F.struct(*[F.col(f"`{c}`") for c in documents.columns]).alias("row"))
    rows = rows.select("row", F.col("row").getField(text_col).alias("text_in"))
    kept = identified(rows, model, "text_in").where("NOT rejected")
    return kept.select(*[F.col("row").getField(c).alias(c) for c in documents.columns])


def report(documents: DataFrame, settings: Settings = Settings(), folds: int = 5) -> DataFrame:
    held_out = fold_of(F.col("doc_id"), folds) == 0
    model = fit(documents, settings, training=~held_out)
    found = identified(documents.select("doc_id", "text"), model)
    return found.select("doc_id", held_out.alias("held_out"), "lang_pred", "score", "rejected")
