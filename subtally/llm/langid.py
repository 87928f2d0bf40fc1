"""Language identification by string kernels: blended-spectrum n-gram presence, Nyström landmarks, kernel ridge regression.

The kernel of two texts is the number of distinct byte n-grams (one to three bytes, lower-cased) they share, over the
geometric mean of their own numbers. A text is described by its kernels with a few landmark texts; one linear
function per language (one versus the rest) on top of that is fitted by ridge regression.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from subtally.llm.common import text_bytes, texts

UNDETERMINED = "und"
NGRAMS = 3
CODES = 1 << 8 * NGRAMS
# Parts that the rows of a language are dealt to while the sample is drawn.
SALTS = 64
# Texts of a batch that are scored by one matrix product.
BLOCK = 256


@dataclass(frozen=True)
class Sample:
    """Bounds of the labelled sample that the classifier is fitted on."""

    per_language: int = 256
    landmarks_per_language: int = 24
    most_texts: int = 8192
    most_landmarks: int = 1024


class Grams:
    """Distinct n-gram codes of texts. ``seen`` is a scratch table, so finding distinct codes needs no sorting."""

    def __init__(self) -> None:
        self.seen = np.zeros(CODES, np.int32)

    def of(self, raw: np.ndarray) -> np.ndarray:
        """A code is the n-gram's bytes as a number; zero bytes in the text count as blanks, so lengths differ."""
        if not len(raw):
            return np.zeros(0, np.int32)
        one = np.where(raw == 0, 32, raw).astype(np.int32)
        codes = [one]
        for n in range(1, NGRAMS):
            if len(one) > n:
                codes.append((codes[-1][:-1] << 8) | one[n:])
        every = np.concatenate(codes)
        place = np.arange(len(every), dtype=np.int32)
        self.seen[every] = place
        return every[self.seen[every] == place]


@dataclass
class Model:
    languages: list[str]
    features: np.ndarray  # codes that occur in a landmark, ascending
    landmarks: np.ndarray  # features x landmarks, 1 where the landmark has the n-gram, over the root of its number
    weights: np.ndarray  # landmarks x languages
    bias: np.ndarray


def has_letter(text: str) -> bool:
    return any(map(str.isalpha, text))


def lowered(text: pa.Array) -> list[str]:
    return [x.lower() for x in text.to_pylist()]


def training_grams(docs: DataFrame, sample: Sample) -> DataFrame:
    """(lang, place, codes) of the sample: of each language the rows that come first by a hash of the id, or of the text
    where the id is null.
    """
    unnamed = F.when(F.col("doc_id").isNull(), F.sha2("text", 256)).alias("_unnamed")
    usable = docs.filter(F.col("lang").isNotNull() & F.col("text").isNotNull()).select("lang", "doc_id", unnamed, "text")
    name = ["doc_id", "_unnamed"]
    order = F.xxhash64(*name)  # a null changes nothing in it
    # Repeated rows of an id are one candidate: a sample's places and texts are of different ids.
    ordered = usable.select("lang", *name).distinct().select("*", order.alias("_order"), F.pmod(order, F.lit(SALTS)).alias("_salt"))
    # First within parts of a language, so that what all tasks send of a common one doesn't meet in one place.
    for own in (("lang", "_salt"), ("lang",)):
        place = F.row_number().over(Window.partitionBy(*own).orderBy("_order", *name))
        ordered = ordered.withColumn("_place", place).filter(F.col("_place") <= sample.per_language)
    first = ordered.orderBy("_place", "lang").limit(sample.most_texts)
    chosen = F.broadcast(first.groupBy("lang", *name).agg(F.min("_place").alias("place")).alias("chosen"))
    same = [F.col(f"chosen.{c}").eqNullSafe(F.col(f"usable.{c}")) for c in ("lang", *name)]
    rows = usable.alias("usable").join(chosen, same).select("usable.*", "place")
    rows = rows.groupBy("lang", *name).agg(F.min("place").alias("place"), F.max("text").alias("text"))  # at most most_texts rows

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grams = Grams()
        for batch in batches:
            kept = [i for i, x in enumerate(batch.column("text").to_pylist()) if has_letter(x)]
            part = batch.take(pa.array(kept, pa.int64()))
            codes = [grams.of(np.frombuffer(x.encode(), np.uint8)).tobytes() for x in lowered(part.column("text"))]
            yield pa.RecordBatch.from_arrays([part.column("lang"), part.column("place"), pa.array(codes, pa.binary())], ["lang", "place", "codes"])

    return rows.select("lang", "place", "text").mapInArrow(run, "lang string, place int, codes binary")


def fit(labelled: DataFrame, sample: Sample = Sample(), ridge: float = 1e-3) -> Model | None:
    """A model of the languages in ``labelled`` (doc_id, text, lang), or None when no row has both and a letter.

    At most ``sample.most_texts`` texts reach the driver, as sets of n-gram codes.
    """
    rows = training_grams(labelled, sample).toPandas()
    if not len(rows):
        return None
    rows = rows.sort_values(["place", "lang"], kind="stable").drop_duplicates(["lang", "place"]).head(sample.most_texts)
    languages = sorted(rows["lang"].unique())
    codes = [np.sort(np.frombuffer(x, np.int32)) for x in rows["codes"]]
    places = rows["place"].to_numpy()
    marks = np.flatnonzero(places <= sample.landmarks_per_language)[: sample.most_landmarks]
    if not len(marks):
        marks = np.arange(min(len(codes), sample.most_landmarks))
    features = np.unique(np.concatenate([codes[i] for i in marks]))
    landmarks = np.zeros((len(features), len(marks)), np.float32)
    for column, i in enumerate(marks):
        landmarks[np.searchsorted(features, codes[i]), column] = 1 / np.sqrt(len(codes[i]))
    kernels = np.empty((len(codes), len(marks)))
    for i, own in enumerate(codes):
        at = np.searchsorted(features, own)
        at = at[(at < len(features)) & (features[np.minimum(at, len(features) - 1)] == own)]
        kernels[i] = landmarks[at].sum(0) / np.sqrt(len(own))
    # Nyström: features whose inner products are the kernel as the landmarks see it.
    values, vectors = np.linalg.eigh(kernels[marks])
    root = vectors / np.sqrt(np.maximum(values, 1e-6))
    described = kernels @ root
    wanted = np.where(rows["lang"].to_numpy()[:, None] == np.array(languages, object)[None, :], 1.0, -1.0)
    # Every language weighs the same, however many texts it has.
    weight = (1 / rows.groupby("lang")["lang"].transform("size").to_numpy())[:, None]
    weight = weight / weight.sum()
    centre, bias = (weight * described).sum(0), (weight * wanted).sum(0)
    spread = (described - centre) * np.sqrt(weight)
    solved = np.linalg.solve(spread.T @ spread + ridge / len(codes) * np.eye(len(marks)), spread.T @ ((wanted - bias) * np.sqrt(weight)))
    return Model(languages, features, landmarks, root @ solved, bias - centre @ solved)


def identify(docs: DataFrame, model: Model | None) -> DataFrame:
    """``doc_id``, ``lang_pred`` and ``score`` (0 to 1) of every whole text; doc_id is passed through, never used.

    The highest of the languages' functions wins, the first by name among equals. A null text, and one without a
    letter, is undetermined with score 0, and so is every text when there is no model. Other columns are left out;
    repeated rows give repeated rows. A text of any length is one row of a batch, and its distinct n-grams are what it costs.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grams = Grams()
        number = np.full(CODES, -1, np.int32)
        if model is not None:
            number[model.features] = np.arange(len(model.features), dtype=np.int32)
        for batch in batches:
            own = texts(batch.column("text")).to_pylist()
            names, scores = [UNDETERMINED] * len(own), np.zeros(len(own))
            lettered = [i for i, x in enumerate(own) if has_letter(x)] if model is not None else []
            for at in range(0, len(lettered), BLOCK):
                block = lettered[at : at + BLOCK]
                starts, raw = text_bytes(pa.array([own[i].lower() for i in block], pa.string()))
                present = np.zeros((len(block), len(model.features)), np.float32)
                norms = np.ones(len(block), np.float32)
                for row in range(len(block)):
                    codes = grams.of(raw[starts[row] : starts[row + 1]])
                    norms[row] = np.sqrt(len(codes))
                    known = number[codes]
                    present[row, known[known >= 0]] = 1
                kernels = (present @ model.landmarks) / norms[:, None]
                values = kernels @ model.weights + model.bias
                best = values.argmax(1)
                scores[block] = np.clip((values[np.arange(len(block)), best] + 1) / 2, 0, 1)
                for i, k in zip(block, best.tolist(), strict=True):
                    names[i] = model.languages[k]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(names, pa.string()), pa.array(scores, pa.float64())], ["doc_id", "lang_pred", "score"])

    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").mapInArrow(run, "doc_id bigint, lang_pred string, score double")
