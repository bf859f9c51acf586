"""Operator 8: a compression classifier for text quality.

Two zstandard dictionaries are built from texts labelled good and bad. A text is compressed with
each, block by block so that the dictionaries and not the text's own past do the work; the
difference of the two sizes, divided by the text's size, tells which it resembles. Labelled
texts that no dictionary has seen calibrate the difference, and how short a text is, as a few
words prove little, to a probability.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pandas as pd
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from titlespan.llm.common import documents, table, two_columns

#: Labelled rows of each class that fitting looks at, the first in the order of a hash.
SAMPLE_ROWS = 3000
#: Bytes of text of each class that go into fitting at most; whole texts, in the same order.
SAMPLE_BYTES = 16 << 20
DICTIONARY_BYTES = 110 << 10
BLOCK = 512
LEVEL = 3
THRESHOLD = 0.7
#: Bytes at which a text counts as half short.
SHORT = 64


@dataclass(frozen=True)
class QualityModel:
    """Dictionaries (each below 112 KB) and the calibration's weights: of the difference, of
    shortness, and the constant."""

    good: bytes
    bad: bytes
    weights: tuple[float, float, float]


def blocks(text: str) -> Iterator[bytes]:
    data = text.encode("utf-8", "surrogatepass")
    return (data[i : i + BLOCK] for i in range(0, len(data), BLOCK))


class _Compressors:
    def __init__(self, good: bytes, bad: bytes):
        self.pair = []
        for raw in (good, bad):
            dictionary = zstandard.ZstdCompressionDict(raw)
            dictionary.precompute_compress(level=LEVEL)
            self.pair.append(
                zstandard.ZstdCompressor(
                    dict_data=dictionary, write_checksum=False, write_content_size=False,
                    write_dict_id=False,
                )
            )

    def features(self, text: str | None) -> tuple[float, float]:
        """(size with the bad dictionary - size with the good one) / (size + `SHORT`), and the
        shortness, from 0 to 1; (0, 1) for no text."""
        data = list(blocks(text or ""))
        good, bad = (sum(len(c.compress(b)) for b in data) for c in self.pair)
        size = sum(map(len, data)) + SHORT
        return (bad - good) / size, SHORT / size


@cache
def _compressors(good: bytes, bad: bytes) -> _Compressors:
    """One for each Python worker and model."""
    return _Compressors(good, bad)


def held_out(id_column: Column) -> Column:
    """Rows whose labels no fitting may see: crc32 of the id as text leaves 2 modulo 4."""
    return F.coalesce(F.crc32(id_column.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def fit(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "quality",
    sample_rows: int = SAMPLE_ROWS,
    sample_bytes: int = SAMPLE_BYTES,
) -> QualityModel:
    """Learns from a bounded sample of labelled rows that are not held out.

    Rows with a null id, text or label teach nothing; an id labelled twice counts by its larger
    label. Two thirds of a class build its dictionary, the others calibrate, weighted so that
    the classes have the shares they have among all labels. Without a dozen texts of either
    class, every text scores the share of good ones (0.5 without any).
    """
    known = (
        labels.filter(F.col(label_col).isin(0, 1))
        .groupBy(F.col("doc_id"))
        .agg(F.max(label_col).alias("label"))
        .filter(~held_out(F.col("doc_id")))
    )
    shares = {row["label"]: row["n"] for row in known.groupBy("label").agg(F.count("*").alias("n")).collect()}
    seen = sum(shares.values())
    share = min(max(shares.get(1, 0) / seen if seen else 0.5, 0.01), 0.99)
    narrow = two_columns(docs, id_col, text_col).filter("text IS NOT NULL AND text <> ''")
    # A text gives its beginning, so that no text uses up the sample: sixteen have room at least.
    part = F.substring("text", 1, max(1, sample_bytes // 64))
    taken: list[tuple] = []
    for label in (0, 1):
        # Ids first, then ids with sizes: only the texts of the sample ever move.
        ids = known.filter(F.col("label") == label).select("doc_id")
        ids = ids.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample_rows)
        sized = narrow.join(F.broadcast(ids), "doc_id").select(
            "doc_id", F.xxhash64("text").alias("print"), F.octet_length(part).alias("size")
        )
        total, before = 0, len(taken)
        order = (F.xxhash64("doc_id"), "doc_id", "print")
        for row in sized.orderBy(*order).limit(sample_rows).collect():
            total += row["size"]
            if total > sample_bytes and len(taken) > before:
                break
            taken.append((len(taken), label, row["doc_id"], row["print"]))
        if len(taken) - before < 12:
            return QualityModel(b"", b"", (0.0, 0.0, float(np.log(share / (1 - share)))))
    id_kind = known.schema["doc_id"].dataType.simpleString()
    places = docs.sparkSession.createDataFrame(taken, f"place long, label int, doc_id {id_kind}, print long")
    chosen = (
        narrow.withColumn("print", F.xxhash64("text"))
        .join(F.broadcast(places), ["doc_id", "print"])
        .dropDuplicates(["place"])
        .select("place", "label", part.alias("text"), F.lit(0).alias("model"))
    )
    # The sample is bounded, so that one task can build the model; the driver gets that alone.
    built = chosen.groupBy("model").applyInPandas(
        lambda sample: _built(sample, share), "good binary, bad binary, weights array<double>"
    )
    row = built.first()
    return QualityModel(bytes(row["good"]), bytes(row["bad"]), tuple(row["weights"]))


def _built(sample: pd.DataFrame, share: float) -> pd.DataFrame:
    """The model's one row from `(place, label, text)`."""
    texts = {label: list(rows["text"]) for label, rows in sample.sort_values("place").groupby("label")}
    built = {label: _dictionary([t for i, t in enumerate(ts) if i % 3]) for label, ts in texts.items()}
    compressors = _Compressors(built[1], built[0])
    unseen = {label: ts[::3] for label, ts in texts.items()}
    x = np.array([compressors.features(t) for label in (0, 1) for t in unseen[label]])
    y = np.repeat([0.0, 1.0], [len(unseen[0]), len(unseen[1])])
    return pd.DataFrame({"good": [built[1]], "bad": [built[0]], "weights": [list(_logistic(x, y, share))]})


def _dictionary(texts: list[str]) -> bytes:
    samples = [b for t in texts for b in blocks(t)]
    size = min(DICTIONARY_BYTES, max(1024, sum(map(len, samples)) // 8))
    try:
        return zstandard.train_dictionary(size, samples).as_bytes()
    except zstandard.ZstdError:  # too few or too uniform samples: they are the dictionary
        return b"".join(samples)[-size:]


def _logistic(x: np.ndarray, y: np.ndarray, share: float) -> tuple[float, float, float]:
    """Platt's scaling by Newton steps; `share` is the weight of the ones, targets are softened."""
    ones, zeros = y.sum(), (1 - y).sum()
    target = np.where(y > 0, (ones + 1) / (ones + 2), 1 / (zeros + 2))
    weight = np.where(y > 0, share / ones, (1 - share) / zeros)
    scale = np.append(np.maximum(np.abs(x).max(axis=0), 1e-9), 1.0)
    features = np.c_[x, np.ones(len(x))] / scale
    beta = np.zeros(features.shape[1])
    for _ in range(80):
        p = 1 / (1 + np.exp(-np.clip(features @ beta, -30, 30)))
        gradient = features.T @ (weight * (p - target)) + 1e-4 * beta
        curvature = (features.T * (weight * p * (1 - p))) @ features + 1e-4 * np.eye(len(beta))
        beta -= np.linalg.solve(curvature, gradient)
    return tuple(float(b) for b in beta / scale)


def score(text: Column, model: QualityModel) -> Column:
    """A text's score, 0 to 1; null and empty texts get that of no difference and full shortness."""

    @F.pandas_udf("double")
    def run(texts: pd.Series) -> pd.Series:
        features = np.zeros((len(texts), 2))
        if model.good and len(texts):
            work = _compressors(model.good, model.bad).features
            features = np.array([work(t) for t in texts])
        logits = features @ np.array(model.weights[:2]) + model.weights[2]
        return pd.Series(1 / (1 + np.exp(-np.clip(logits, -30, 30))))

    return run(text)


def scored(
    docs: DataFrame, model: QualityModel, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """`(doc_id, held_out, score, predicted)`, one row per input row; ids may be null or repeat.

    Texts of any length are compressed whole, block by block; an empty table gives no rows, and
    other columns are not looked at.
    """
    narrow = two_columns(docs, id_col, text_col)
    rows = narrow.select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), score(F.col("text"), model).alias("score")
    )
    return rows.withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    return scored(docs, fit(docs, table(spark, sf_dir, "labels")))


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the classifier does not reject, with all their columns.

    Where too few labels are known for a classifier, none rejects anything, so all stay.
    """
    model = fit(docs, table(spark, sf_dir, "labels"))
    if not model.good:
        return docs
    return docs.filter(score(F.col("text"), model) >= THRESHOLD)
