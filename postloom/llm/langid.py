"""Language identification: sparse multinomial logistic regression on TF-IDF of character n-grams.

Texts are put in lower case, everything but letters becomes a space, and n-grams of one to three characters are hashed to
`FEATURES` places. The term frequency is the share of the document's n-grams, so a document's logits are a sum over its
n-grams and a text of any length is read in parts. Document frequencies count every training document in Spark.

The weights are learned with follow-the-regularised-leader (proximal, per coordinate) under an elastic net: the L1 part
sets rare features to zero. They are fitted on a sample of `SAMPLE_ROWS` different labelled texts at most, dealt evenly over the
languages: those of the smallest hashes, copies counting once. This bound is a parameter of `train`; only `LEAST_ROWS` texts of
each language, if it has them, go before it. A fifth of the sample is held back to calibrate the temperature by which
logits are divided; copies of a text are never on both sides.

Defined results: `und` with score 0 for a null text or one without a letter, and for every text if no labelled row was given;
with one language its score is 1; a row without an id is held out; rows that share an id, or repeat, are judged one by one; an
empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import ship_package
from .common import KEPT, map_rows

UNKNOWN = "und"
FEATURES = 1 << 15
LONGEST = 3
SAMPLE_ROWS = 4_000
LEAST_ROWS = 100  # of a language, if it has them
_PART = 1 << 20
_SCALE = 100.0  # shares are small numbers; penalties are in terms of this

_LETTER = regex.compile(r"\p{L}")
_KNOWN = 0x3000
_FOLDED = np.array([c if chr(c).isalpha() or _LETTER.match(chr(c)) else 32 for c in range(_KNOWN)], np.uint32)


def ngram_places(text: str) -> Iterator[np.ndarray]:
    """Places of the n-grams of a text, part by part."""
    text = f" {text} "
    for start in range(0, len(text), _PART):
        part = text[max(0, start - LONGEST + 1) : start + _PART].lower()
        points = np.frombuffer(part.encode("utf-32-le", "surrogatepass"), np.uint32).copy()
        low = points < _KNOWN
        points[low] = _FOLDED[points[low]]
        wide = points.astype(np.uint64)
        keys = wide
        for length in range(1, LONGEST + 1):
            if length > 1:
                keys = keys[:-1] * np.uint64(0x100000001B3) + wide[length - 1 :]
            mix = (keys + np.uint64(length)) * np.uint64(0x9E3779B97F4A7C15)
            yield (mix >> np.uint64(64 - 15)).astype(np.int64)


@dataclass
class Model:
    languages: list[str]
    weights: np.ndarray  # features x languages, idf included
    bias: np.ndarray
    temperature: float

    def predict(self, text: str | None) -> tuple[str, float]:
        if not self.languages or not text or not _LETTER.search(text):
            return UNKNOWN, 0.0
        total, sums = 0, np.zeros(len(self.languages))
        for places in ngram_places(text):
            total += len(places)
            sums += self.weights[places].sum(0, dtype=np.float64)
        logits = (_SCALE * sums / total + self.bias) / self.temperature
        shares = np.exp(logits - logits.max())
        best = int(shares.argmax())
        return self.languages[best], float(shares[best] / shares.sum())


def _counted(text: str) -> tuple[np.ndarray, np.ndarray]:
    counts = np.zeros(FEATURES, np.int64)
    for places in ngram_places(text):
        counts += np.bincount(places, minlength=FEATURES)
    found = np.flatnonzero(counts)
    return found, counts[found]


def _document_frequencies(rows: DataFrame) -> tuple[np.ndarray, int]:
    """In how many documents each feature is; a task sends one row for each feature it has seen."""

    def count(each: Iterator[dict]) -> Iterator[tuple]:
        KEPT.clear()
        seen = np.zeros(FEATURES, np.int64)
        documents = 0
        for row in each:
            mark = np.zeros(FEATURES, bool)
            for places in ngram_places(row["text"]):
                mark[places] = True
            seen += mark
            documents += 1
        if documents:
            yield -1, documents
            for place in np.flatnonzero(seen).tolist():
                yield place, int(seen[place])

    each = map_rows(rows.select("text"), count, "place long, n long", pa.schema([("place", pa.int64()), ("n", pa.int64())]))
    found = {r["place"]: r["n"] for r in each.groupBy("place").agg(F.sum("n").alias("n")).collect()}  # FEATURES + 1 rows at most
    out = np.zeros(FEATURES)
    for place, n in found.items():
        if place >= 0:
            out[place] = n
    return out, found.get(-1, 0)


def follow_the_leader(
    rows: list[tuple[np.ndarray, np.ndarray, int]], languages: int, alpha: float = 0.5, beta: float = 1.0, l1: float = 0.05,
    l2: float = 0.05, epochs: int = 3,
) -> tuple[np.ndarray, np.ndarray]:
    """FTRL-proximal with an elastic net over rows of (places, values, label). The bias is the last place, without penalty."""
    z = np.zeros((FEATURES + 1, languages))
    n = np.zeros((FEATURES + 1, languages))
    penalty = np.append(np.full(FEATURES, l1), 0.0)[:, None]

    def weights(at) -> np.ndarray:
        shrunk = np.sign(z[at]) * np.maximum(np.abs(z[at]) - penalty[at], 0)
        return -shrunk / ((beta + np.sqrt(n[at])) / alpha + l2)

    for _ in range(epochs):
        for places, values, label in rows:
            at = np.append(places, FEATURES)
            x = np.append(values, 1.0)[:, None]
            w = weights(at)
            logits = (x * w).sum(0)
            shares = np.exp(logits - logits.max())
            shares /= shares.sum()
            shares[label] -= 1
            gradient = x * shares
            grown = n[at] + gradient * gradient
            z[at] += gradient - (np.sqrt(grown) - np.sqrt(n[at])) / alpha * w
            n[at] = grown
    final = weights(np.arange(FEATURES + 1))
    return final[:-1], final[-1]


def calibrated(logits: np.ndarray, labels: np.ndarray) -> float:
    """The temperature that makes the labels most likely, by golden section over its logarithm."""

    def loss(power: float) -> float:
        scaled = logits / np.exp(power)
        top = scaled.max(1, keepdims=True)
        return float((np.log(np.exp(scaled - top).sum(1)) + top[:, 0] - scaled[np.arange(len(labels)), labels]).mean())

    low, high, ratio = np.log(0.2), np.log(10.0), (np.sqrt(5) - 1) / 2
    for _ in range(40):
        left, right = high - ratio * (high - low), low + ratio * (high - low)
        low, high = (low, right) if loss(left) < loss(right) else (left, high)
    return float(np.exp((low + high) / 2))


def train(rows: DataFrame, text: str = "text", label: str = "lang", sample_rows: int = SAMPLE_ROWS) -> Model:
    """A model from labelled rows. `sample_rows` bounds the different texts the weights are fitted on, shared out over the languages."""
    ship_package(rows.sparkSession)
    known = rows.where(F.col(label).isNotNull() & F.col(text).isNotNull()).select(
        F.col(text).cast("string").alias("text"), F.col(label).cast("string").alias("label"))
    languages = sorted(r["label"] for r in known.select("label").distinct().collect())
    if not languages:
        return Model([], np.zeros((FEATURES, 0), np.float32), np.zeros(0), 1.0)
    documents, total = _document_frequencies(known)
    idf = np.log((1 + total) / (1 + documents)) + 1
    each = max(LEAST_ROWS, sample_rows // len(languages))
    # Texts stand for their copies by a hash; 128 bits tell texts apart, and the text itself is not shuffled.
    keyed = known.withColumn("key", F.xxhash64("text", "label")).withColumn("more", F.xxhash64(F.lit(1), "label", "text"))
    # A threshold from the counts of different texts leaves about twice the rows wanted, the rank then takes exactly `each`.
    distinct = {r["label"]: r["n"] for r in keyed.groupBy("label").agg(F.approx_count_distinct("key", 0.02).alias("n")).collect()}
    share = F.lit(0.0)
    for language, size in distinct.items():
        share = F.when(F.col("label") == language, F.lit(1.0 if size <= 4 * each else 2 * each / size)).otherwise(share)
    draw = F.pmod("key", F.lit(1_000_003)) / F.lit(1_000_003)
    once = keyed.withColumn("draw", draw).where(F.col("draw") < share).groupBy("label", "key", "more").agg(
        F.min("draw").alias("draw"), F.first("text").alias("text"))
    rank = F.row_number().over(Window.partitionBy("label").orderBy("draw", "key", "more"))
    chosen = once.withColumn("rank", rank).where(F.col("rank") <= each)

    def features(rows: Iterator[dict]) -> Iterator[tuple]:
        for row in rows:
            places, counts = _counted(row["text"])
            yield row["label"], float(row["rank"]), places.astype(np.int32).tobytes(), counts.astype(np.int32).tobytes()

    arrow = pa.schema([("label", pa.string()), ("draw", pa.float64()), ("places", pa.binary()), ("counts", pa.binary())])
    got = map_rows(chosen.select("label", "rank", "text"), features, "label string, draw double, places binary, counts binary", arrow).collect()
    drawn = Counter(r["label"] for r in got)
    sample = []
    for r in got:
        places, counts = (np.frombuffer(r[k], np.int32).astype(np.int64) for k in ("places", "counts"))
        sample.append(((r["draw"] - 0.5) / drawn[r["label"]], (places, _SCALE * counts / counts.sum() * idf[places], languages.index(r["label"]))))
    sample.sort(key=lambda s: (s[0], s[1][2], len(s[1][0])))
    ordered = [s for _, s in sample]
    held, learned = ordered[::5], [s for i, s in enumerate(ordered) if i % 5] or ordered
    weights, bias = follow_the_leader(learned, len(languages))
    logits = np.array([(v[:, None] * weights[p]).sum(0) + bias for p, v, _ in held])
    temperature = calibrated(logits, np.array([k for _, _, k in held])) if len(languages) > 1 else 1.0
    return Model(languages, (weights * idf[:, None]).astype(np.float32), bias, temperature)


def identify(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """The documents with `lang_pred` and `score`; only the text is looked at."""
    ship_package(docs.sparkSession)
    names = [c for c in docs.columns if c not in ("lang_pred", "score")]

    @F.pandas_udf("struct<lang_pred:string,score:double>")
    def judged(texts):
        import pandas as pd

        return pd.DataFrame([model.predict(t) for t in texts], columns=["lang_pred", "score"])

    found = docs.select(*names, judged(F.col(text).cast("string")).alias("judged"))
    return found.select(*names, "judged.lang_pred", "judged.score")


def held_out(doc_id: str = "doc_id") -> Column:
    """Documents kept for tests: a third, by a checksum of the id."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 3 == 1, F.lit(True))


def predicted_languages(docs: DataFrame) -> DataFrame:
    model = train(docs.where(~held_out()))
    return identify(docs.select("doc_id", held_out().alias("held_out"), "text"), model).drop("text")
