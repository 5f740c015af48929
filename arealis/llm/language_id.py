"""Language identification: sparse multinomial logistic regression on character n-grams.

Letters are lower-cased, everything else is a space, runs of spaces are one. N-grams
of 1 to 3 characters are hashed to buckets; a text's features are its bucket counts,
damped by a logarithm, times the buckets' inverse document frequencies, scaled to unit
length. Document frequencies count every labelled row that is not held out. The weights
are fitted by follow-the-regularised-leader with an elastic net on a bounded sample of
those rows, the temperature that calibrates the probabilities on a part of the sample
that the weights do not see.

Defined cases: a null text and one without letters are ``und`` with score 0; without
any labelled row everything is ``und``; a null identifier counts as held out; equal
probabilities go to the label that sorts first; texts of any length are read whole, in
stretches; extra columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from arealis.llm.common import documents, per_worker

BUCKETS = 1 << 14
ORDERS = 3
# characters read at a time
STRETCH = 1 << 18
# expected sample rows of each label, an upper bound on what is fitted on
SAMPLE_PER_LABEL = 600
SAMPLE_LABELS = 200
UNKNOWN = "und"


# --- features ---------------------------------------------------------------------------------


def alphabet() -> np.ndarray:
    """Code point to its lower-case letter, or to a space."""
    return np.array([ord(c.lower()[0]) if c.isalpha() else 32 for c in map(chr, range(0x110000))], np.uint32)


def counted(text: str | None, buckets: int = BUCKETS) -> np.ndarray | None:
    """How often each bucket occurs; None if there is no letter."""
    table = per_worker("alphabet", alphabet)
    total, any_letter, tail = np.zeros(buckets, np.int64), False, np.array([32], np.uint32)
    shift = np.uint32(32 - buckets.bit_length() + 1)
    text = text or ""
    for start in range(0, len(text), STRETCH):
        codes = table[np.frombuffer(text[start : start + STRETCH].encode("utf-32-le"), np.uint32)]
        codes = np.concatenate([tail, codes, [np.uint32(32)] if start + STRETCH >= len(text) else []]).astype(np.uint32)
        blank = codes == 32
        codes = codes[np.concatenate([[True], ~(blank[1:] & blank[:-1])])]
        any_letter = any_letter or bool((codes != 32).any())
        gram = np.zeros(len(codes), np.uint32)
        for order in range(ORDERS):
            fresh = codes[order:]
            gram = gram[: len(fresh)] * np.uint32(0x01000193) + fresh + np.uint32(1)
            # what ends inside the part carried over was counted before
            mine = gram[max(0, len(tail) - order) :] if start else gram
            total += np.bincount((mine * np.uint32(0x9E3779B1)) >> shift, minlength=buckets)
        tail = codes[-(ORDERS - 1) :]
    return total if any_letter else None


def damped(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Buckets that occur, and the logarithmic counts."""
    at = np.flatnonzero(counts)
    return at.astype(np.int32), (1 + np.log(counts[at])).astype(np.float32)


def scaled(at: np.ndarray, values: np.ndarray, idf: np.ndarray) -> np.ndarray:
    weighted = values * idf[at]
    length = np.sqrt((weighted * weighted).sum())
    return weighted / length if length > 0 else weighted


# --- fitting ----------------------------------------------------------------------------------


@dataclass
class Model:
    labels: list[str]
    idf: np.ndarray
    weights: np.ndarray
    temperature: float = 1.0

    def probabilities(self, at: np.ndarray, values: np.ndarray) -> np.ndarray:
        x = scaled(at, values, self.idf)
        return softmax((x @ self.weights[at] + self.weights[-1]) / self.temperature)


def softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def ftrl(rows: list[tuple[np.ndarray, np.ndarray, int]], buckets: int, labels: int, epochs: int = 3, alpha: float = 0.5, beta: float = 1.0, l1: float = 0.002, l2: float = 0.02, seed: int = 0) -> np.ndarray:
    """Follow-the-regularised-leader over scaled rows (buckets, values, label). The
    last row of the weights is the bias, which is not penalised."""
    z, n = np.zeros((buckets + 1, labels)), np.zeros((buckets + 1, labels))

    def leading(at):
        zs = z[at]
        penalty = np.where(at[:, None] == buckets, 0.0, l1)
        shrunk = np.sign(zs) * np.maximum(np.abs(zs) - penalty, 0)
        return -shrunk / ((beta + np.sqrt(n[at])) / alpha + l2)

    order = np.random.default_rng(seed)
    for _ in range(epochs):
        for i in order.permutation(len(rows)):
            at, x, label = rows[i]
            at, x = np.append(at, buckets), np.append(x, 1.0)
            weights = leading(at)
            slope = softmax(x @ weights)
            slope[label] -= 1
            gradient = x[:, None] * slope
            square = gradient * gradient
            sigma = (np.sqrt(n[at] + square) - np.sqrt(n[at])) / alpha
            z[at] += gradient - sigma * weights
            n[at] += square
    return leading(np.arange(buckets + 1))


def temperature(scores: np.ndarray, labels: np.ndarray) -> float:
    """The divisor of the scores under which the labels are likeliest, by golden
    section on its logarithm. The targets are (n + 1) / (n + 2) instead of 1, so that
    n rows without a mistake do not call for certainty."""
    if not len(scores) or scores.shape[1] < 2:
        return 1.0
    n, k = scores.shape
    wanted = np.full((n, k), 1 / (n + 2) / (k - 1))
    wanted[np.arange(n), labels] = (n + 1) / (n + 2)

    def loss(log_t):
        return -(wanted * np.log(np.maximum(softmax(scores / np.exp(log_t)), 1e-300))).sum()

    low, high, g = -4.0, 4.0, (5**0.5 - 1) / 2
    for _ in range(60):
        a, b = high - g * (high - low), low + g * (high - low)
        low, high = (low, b) if loss(a) <= loss(b) else (a, high)
    return float(np.exp((low + high) / 2))


def held_out(key: Column) -> Column:
    """Whether a row is kept from learning: a fifth, by the identifier's checksum."""
    return F.coalesce(F.crc32(key.cast("string").cast("binary")) % 5 == 0, F.lit(True))


def document_frequencies(texts: DataFrame, buckets: int = BUCKETS) -> tuple[np.ndarray, int]:
    """In how many of all rows (text) each bucket occurs, and the rows with letters."""

    def run(batches):
        total = np.zeros(buckets + 1, np.int64)
        for batch in batches:
            for value in batch.column(0):
                counts = counted(value.as_py(), buckets)
                if counts is not None:
                    total[:-1] += counts > 0
                    total[-1] += 1
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_pydict({"bucket": pa.array(at, pa.int64()), "n": pa.array(total[at], pa.int64())})

    # at most one row per bucket, whatever the input
    rows = texts.mapInArrow(run, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n")).collect()
    total = np.zeros(buckets + 1, np.int64)
    for row in rows:
        total[row["bucket"]] = row["n"]
    return total[:-1], int(total[-1])


def fit(docs: DataFrame, text: str = "text", lang: str = "lang", key: str = "doc_id", buckets: int = BUCKETS, per_label: int = SAMPLE_PER_LABEL, seed: int = 0) -> Model | None:
    """Learn from the labelled rows of ``docs`` that are not held out.

    ``per_label`` bounds the sample: labels are thinned by a hash to that many rows on
    average, and ``per_label * SAMPLE_LABELS`` rows is the most that is ever fitted on."""
    known = docs.select(docs[text].alias("text"), docs[lang].alias("lang"), docs[key].alias("key")).where(F.col("lang").isNotNull() & F.col("text").isNotNull() & ~held_out(F.col("key")))
    counts = {r["lang"]: r["n"] for r in known.groupBy("lang").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "lang").limit(SAMPLE_LABELS).collect()}
    if not counts:
        return None
    labels = sorted(counts)
    frequency, rows = document_frequencies(known.select("text"), buckets)
    idf = np.log((1 + rows) / (1 + frequency)) + 1
    rate = F.create_map(*[F.lit(x) for label in labels for x in (label, min(1.0, per_label / counts[label]))])
    place = F.pmod(F.xxhash64(F.lit(seed), "key", "text"), F.lit(1 << 30)) / float(1 << 30)
    sample = known.where(place < rate[F.col("lang")]).limit(per_label * SAMPLE_LABELS)
    code = {label: i for i, label in enumerate(labels)}

    def run(batches):
        for batch in batches:
            found = []
            for value, label in zip(batch.column(0), batch.column(1).to_pylist(), strict=True):
                counts = counted(value.as_py(), buckets)
                if counts is not None:
                    at, values = damped(counts)
                    found.append((at.tobytes(), values.tobytes(), code[label]))
            yield pa.RecordBatch.from_pydict({"at": pa.array([f[0] for f in found], pa.binary()), "x": pa.array([f[1] for f in found], pa.binary()), "label": pa.array([f[2] for f in found], pa.int32())})

    taken = sample.select("text", "lang").mapInArrow(run, "at binary, x binary, label int").collect()
    rows = []
    for row in sorted(taken, key=lambda r: (r["label"], r["at"], r["x"])):
        at = np.frombuffer(row["at"], np.int32)
        rows.append((at, scaled(at, np.frombuffer(row["x"], np.float32), idf), row["label"]))
    if not rows:
        return None
    shown = [r for i, r in enumerate(rows) if i % 5]
    apart = rows[::5]
    weights = ftrl(shown or rows, buckets, len(labels), seed=seed)
    scores = np.array([x @ weights[at] + weights[-1] for at, x, _ in apart])
    return Model(labels, idf, weights, temperature(scores, np.array([r[2] for r in apart])))


def identify(docs: DataFrame, model: Model | None, text: str = "text") -> DataFrame:
    """``docs`` with lang_pred and score (they replace columns of these names). Only
    the text goes to Python."""

    @F.arrow_udf("struct<lang_pred:string,score:double>")
    def predicted(texts: pa.Array) -> pa.Array:
        label, score = [], []
        for value in texts:
            counts = counted(value.as_py(), len(model.idf)) if model else None
            if counts is None:
                label.append(UNKNOWN)
                score.append(0.0)
            else:
                p = model.probabilities(*damped(counts))
                label.append(model.labels[int(p.argmax())])
                score.append(float(min(1.0, p.max())))
        return pa.StructArray.from_arrays([pa.array(label, pa.string()), pa.array(score, pa.float64())], names=["lang_pred", "score"])

    whole = F.struct(*[docs[f"`{c}`"].alias(c) for c in docs.columns if c not in ("lang_pred", "score")])
    return docs.select(whole.alias("whole"), predicted(docs[text]).alias("found")).select("whole.*", "found.*")


def op1_language_id(spark, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    found = identify(docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "text"), fit(docs))
    return found.select("doc_id", "held_out", "lang_pred", "score")
