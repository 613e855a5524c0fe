"""Quality scores by Bradley-Terry ranking: a document's worth is learned from preference pairs.

1. Dense features of a whole text (``FEATURES``): sizes, letters, capitals, signs, sentence and line shapes, repetition.
2. Each labelled good document is preferred to several labelled bad ones. P(good before bad) = sigmoid(w . (x - y)): logistic
   loss on feature differences, without intercept. Features enter as themselves and as hinges at sample quantiles.
3. The raw worth w . x is cut at a quantile of the sample's worths: the percentile that disagrees least with the labels of
   a part that took no part in the ranking (the lowest of equal ones). The score is sigmoid(worth - cut): 0.5 at the cut.

Only a bounded sample of labelled rows is fitted (``SAMPLE_ROWS`` by a hash of the id, ``PAIRS_EACH`` pairs for each row of
the larger class); scoring reads every text whole. A very long text is held by one task.

Cases: a null, empty or blank text has all features 0 and still gets a score; labels that are null, neither 0 nor 1, or of
unknown documents do not train; repeated labels of an id count once (the larger); repeated ids train on each of their texts;
without labels the score is 0, with one class only it is that class; extra columns are kept, ``score`` replaces a column of its name.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame, Window, functions as F

from ..session import materialize
from .tables import q
from .textarrays import IS_SPACE, U64, batch_words, mix, text_bytes

FEATURES = (
    "log_words word_bytes log_longest letters digits capitals shouting signs signed_words signs_only exclamations questions stops commas "
    "lines short_lines open_lines repeated_lines distinct top_word repeated_triples other_bytes"
).split()

SAMPLE_ROWS = 60_000
PAIRS_EACH = 6
KNOTS = (0.02, 0.1, 0.3, 0.5, 0.7, 0.9, 0.98)

_BYTES = np.arange(256)
_CAPITAL = (_BYTES >= 65) & (_BYTES <= 90)
_LETTER = _CAPITAL | (_BYTES >= 97) & (_BYTES <= 122) | (_BYTES >= 128)
_DIGIT = (_BYTES >= 48) & (_BYTES <= 57)
_COMMON = np.isin(_BYTES, [ord(c) for c in ".,;:!?'\"()-"])
_SIGN = ~_LETTER & ~_DIGIT & ~_COMMON & ~IS_SPACE
_STOP = np.isin(_BYTES, [ord(c) for c in ".!?"])
#: Byte classes counted per text.
_CLASSES = np.stack([_LETTER, _DIGIT, _CAPITAL, _SIGN, _BYTES == 33, _BYTES == 63, _BYTES == 46, _BYTES == 44, _BYTES == 10, ~IS_SPACE, _BYTES >= 128], axis=1).astype(np.float64)
_CHUNK = 1 << 20


def _byte_counts(data: np.ndarray) -> np.ndarray:
    """How often each byte value occurs."""
    out = np.zeros(256, np.int64)
    for at in range(0, len(data), _CHUNK):
        out += np.bincount(data[at : at + _CHUNK], minlength=256)
    return out


def _distinct(owner: np.ndarray, values: np.ndarray, rows: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct values, the largest count of one value, and the values that occur again, per row."""
    order = np.lexsort((values, owner))
    o, v = owner[order], values[order]
    new = np.ones(len(v), bool)
    new[1:] = (v[1:] != v[:-1]) | (o[1:] != o[:-1])
    at = np.flatnonzero(new)
    size = np.diff(np.append(at, len(v)))
    kinds, top = np.bincount(o[at], minlength=rows), np.zeros(rows, np.int64)
    np.maximum.at(top, o[at], size)
    again = np.bincount(o[at], np.where(size > 1, size, 0), rows)
    return kinds, top, again


def features_of(column: pa.Array) -> np.ndarray:
    """Texts by FEATURES."""
    data, starts, ends = text_bytes(column)
    out = np.zeros((len(starts), len(FEATURES)))
    for a, b, words, ws, we, bounds in batch_words(column, lower=True):
        rows, n = b - a, np.diff(bounds)
        owner = np.repeat(np.arange(rows), n)
        low, high = int(starts[a]), int(max(ends[b - 1], starts[a]))
        span = data[low:high]

        def inside(table, span=span, ws=ws, we=we, low=low):
            sums = np.zeros(len(span) + 1, np.int32)
            np.cumsum(table[span], out=sums[1:])
            return sums[we - low] - sums[ws - low], sums

        caps, _ = inside(_CAPITAL)
        letters, _ = inside(_LETTER)
        signs, _ = inside(_SIGN)
        lines_before = inside(_BYTES == 10)[1][ws - low]
        total = np.maximum(n, 1)

        def share(values, owner=owner, rows=rows, total=total):
            return np.bincount(owner, values, rows) / total

        counts = np.stack([_byte_counts(data[starts[k] : ends[k]]) for k in range(a, b)]).astype(np.float64) @ _CLASSES
        letter_n, digit_n, capital_n, sign_n, ex, qu, stop, comma, feeds, solid, other = counts.T
        solid1, letters1 = np.maximum(solid, 1), np.maximum(letter_n, 1)
        longest = np.zeros(rows)
        np.maximum.at(longest, owner, we - ws)
        kinds, top, _ = _distinct(owner, words, rows)
        # triples of words that stay inside a row
        if len(words) > 2:
            triple = mix(words[:-2] * U64(0x9E3779B97F4A7C15) + words[1:-1] * U64(0xC2B2AE3D27D4EB4F) + words[2:])
            whole = owner[:-2] == owner[2:]
            again = _distinct(owner[:-2][whole], triple[whole], rows)[2]
        else:
            again = np.zeros(rows)
        # lines that hold words
        new = np.ones(len(words), bool)
        new[1:] = (lines_before[1:] != lines_before[:-1]) | (owner[1:] != owner[:-1])
        first = np.flatnonzero(new)
        line_owner, line_words = owner[first], np.diff(np.append(first, len(words)))
        last = np.append(first[1:], len(words))[: len(first)] - 1
        n_lines = np.maximum(np.bincount(line_owner, minlength=rows), 1)
        line_hash = np.add.reduceat(mix(words), first) if len(first) else words[:0]
        line_again = _distinct(line_owner, line_hash, rows)[2]
        open_line = ~_STOP[data[we[last] - 1]] if len(first) else np.zeros(0, bool)
        out[a:b] = np.stack([
            np.log1p(n), share(we - ws) / 10, np.log1p(longest) / 5, letter_n / solid1, digit_n / solid1, capital_n / letters1,
            share((caps >= 2) & (caps == letters)), sign_n / solid1, share(signs > 0), share((signs == we - ws) & (signs > 0)), ex / total, qu / total,
            stop / total, comma / total, feeds / total, np.bincount(line_owner, line_words < 3, rows) / n_lines, np.bincount(line_owner, open_line, rows) / n_lines,
            line_again / n_lines, np.where(n > 0, kinds / total, 0), top / total, again / total, other / solid1,
        ], axis=1)
        out[a:b][n == 0] = 0
    return out


@dataclass
class Model:
    """Weights over ``expanded`` features, and the worth at which the score is 0.5; ``constant`` without both classes."""

    knots: np.ndarray = field(default_factory=lambda: np.zeros((len(KNOTS), len(FEATURES))))
    weights: np.ndarray | None = None
    cut: float = 0.0
    constant: float = 0.0

    def worth(self, features: np.ndarray) -> np.ndarray:
        return expanded(features, self.knots) @ self.weights

    def score(self, features: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.worth(features) - self.cut, -500, 500)))


def expanded(features: np.ndarray, knots: np.ndarray) -> np.ndarray:
    """Each feature and its hinges max(0, x - knot), over the knots' range."""
    width = np.maximum(knots[-1] - knots[0], 0.05)
    hinges = np.minimum(np.maximum(features[:, None, :] - knots[None], 0) / width, 3)
    return np.concatenate([np.clip((features - knots[0]) / width, -3, 3), hinges.reshape(len(features), knots.size)], axis=1)


def with_features(df: DataFrame, text: Column, name: str) -> DataFrame:
    @F.arrow_udf("array<double>")
    def features(texts: pa.Array) -> pa.Array:
        values = features_of(texts)
        return pa.ListArray.from_arrays(pa.array(np.arange(len(values) + 1) * len(FEATURES), pa.int32()), pa.array(values.ravel()))

    return df.withColumn(name, features(F.coalesce(text, F.lit(""))))


def preference_pairs(rows: DataFrame, each: int = PAIRS_EACH) -> DataFrame:
    """(better, worse, turn): feature arrays of a good and a bad document. ``rows``: order, label, features; a bounded sample.

    Both classes are numbered in hash order; pair i takes the good document i mod g and the bad one i mod b, moved on by
    one with every full turn of both, so that every row is used and no pair comes twice before all have come.
    """
    numbered = rows.withColumn("no", F.row_number().over(Window.partitionBy("label").orderBy("order", "features")) - 1)
    numbered = materialize(numbered.select("label", F.col("no").cast("long").alias("no"), "features"), "quality-classes")
    sizes = {r["label"]: r["n"] for r in numbered.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    good, bad = sizes.get(1, 0), sizes.get(0, 0)
    if not good or not bad:
        return rows.sparkSession.createDataFrame([], "better array<double>, worse array<double>, turn long")
    n = min(max(good, bad) * each, good * bad)
    turn = int(good * bad / np.gcd(good, bad))
    i = F.col("id")
    pairs = rows.sparkSession.range(n).select(i.alias("turn"), (i % good).alias("g"), ((i + F.floor(i / turn)) % bad).cast("long").alias("b"))
    better = numbered.filter("label = 1").select(F.col("no").alias("g"), F.col("features").alias("better"))
    worse = numbered.filter("label = 0").select(F.col("no").alias("b"), F.col("features").alias("worse"))
    # both sides hold SAMPLE_ROWS rows at most
    return pairs.join(F.broadcast(better), "g").join(F.broadcast(worse), "b").select("better", "worse", "turn")


def rank(pairs: DataFrame, knots: np.ndarray) -> np.ndarray:
    """Weights of the Bradley-Terry model: logistic loss on differences, half of them turned round."""

    @F.arrow_udf("array<double>")
    def difference(better: pa.Array, worse: pa.Array, turn: pa.Array) -> pa.Array:
        x, y = (expanded(np.stack(c.to_numpy(zero_copy_only=False)), knots) for c in (better, worse))
        d = (x - y) * np.where(turn.to_numpy() % 2 == 0, 1.0, -1.0)[:, None]
        return pa.ListArray.from_arrays(pa.array(np.arange(len(d) + 1) * d.shape[1], pa.int32()), pa.array(d.ravel()))

    told = pairs.select(array_to_vector(difference("better", "worse", "turn")).alias("d"), (1 - F.col("turn") % 2).cast("double").alias("first"))
    told = materialize_vectors(told)
    fitted = LogisticRegression(featuresCol="d", labelCol="first", fitIntercept=False, standardization=False, regParam=2e-4, maxIter=100).fit(told)
    told.unpersist()
    return fitted.coefficients.toArray()


def materialize_vectors(df: DataFrame) -> DataFrame:
    """The bounded pairs, kept for the passes of the fit; a lost executor recomputes its part."""
    return df.persist()


def fit(docs: DataFrame, labels: DataFrame, text: str = "text", label: str = "quality", key: str = "doc_id") -> Model:
    """Fit on the documents that ``labels`` (key and 0/1 label) names."""
    known = labels.filter(q(label).isin(0, 1) & q(key).isNotNull()).groupBy(q(key).alias("key")).agg(F.max(q(label)).cast("int").alias("label"))
    seen = known.agg(F.count(F.lit(1)).alias("n"), F.avg("label").alias("mean")).first()
    if not seen["n"] or seen["mean"] in (0.0, 1.0):
        return Model(constant=float(seen["mean"] or 0.0))
    bound = int(min(1.0, SAMPLE_ROWS / seen["n"]) * 1_000_003) + 1
    drawn = known.withColumn("order", F.xxhash64(F.lit(12), "key")).filter(F.pmod("order", F.lit(1_000_003)) < bound)
    rows = docs.select(q(key).alias("key"), q(text).alias("text")).join(F.broadcast(drawn), "key")
    featured = with_features(rows.select("order", "label", "text"), F.col("text"), "features")
    featured = materialize(featured.select("order", "label", F.pmod(F.shiftright("order", 24), F.lit(4)).cast("int").alias("part"), "features"), "quality-features")
    sample = featured.select("part", "label", "features").toPandas()  # SAMPLE_ROWS short rows
    if not len(sample):
        return Model(constant=float(seen["mean"]))
    x, y, part = np.stack(sample["features"]), sample["label"].to_numpy(), sample["part"].to_numpy()
    if len(set(y[part > 0])) < 2 or not (part == 0).any():
        part = np.ones(len(y), int)  # too few rows to keep a part apart
    if len(set(y)) < 2:
        return Model(constant=float(y[0]))
    model = Model(knots=np.quantile(x, KNOTS, axis=0))
    apart = (part == 0).any()
    model.weights = rank(preference_pairs(featured.filter("part > 0") if apart else featured), model.knots)
    worth = model.worth(x)
    held = part == 0 if apart else part > 0
    model.cut = cut_by_quantile(worth, worth[held], y[held])
    return model


def cut_by_quantile(sample: np.ndarray, worth: np.ndarray, label: np.ndarray) -> float:
    """The percentile of ``sample`` that, as least worth of label 1, disagrees with the fewest labels; the lowest of these."""
    cuts = np.quantile(sample, np.arange(0, 100) / 100)
    wrong = [int(((worth >= c) != (label == 1)).sum()) for c in cuts]
    return float(cuts[int(np.argmin(wrong))])


def score(df: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """``df`` with ``score`` between 0 and 1, 0.5 or more for texts at or above the model's quantile."""
    if model.weights is None:
        return df.drop(*[c for c in df.columns if c.lower() == "score"]).withColumn("score", F.lit(float(model.constant)))

    @F.arrow_udf("double")
    def scored(texts: pa.Array) -> pa.Array:
        return pa.array(model.score(features_of(texts)))

    value = scored(F.coalesce(q(text), F.lit("")))
    return df.select(*[q(c) for c in df.columns if c.lower() != "score"], value.alias("score"))
