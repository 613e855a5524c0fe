"""Language identification with string kernels.

A text is read in segments of ``SEGMENT`` bytes, the whole text, so that long texts do not hold
every n-gram. A segment is the set of its byte n-grams of orders 1 to ``ORDERS`` (a blended
spectrum; A-Z lower-cased), hashed to ``DIMENSIONS`` places. The kernel of two segments is the number of
shared places over the geometric mean of their sizes. Nystroem landmarks, a few training segments
per language, carry a one-versus-rest kernel ridge regression, solved on the driver from a bounded
sample (``SAMPLE_DOCS`` distinct texts per language, ``SAMPLE_SEGMENTS`` segments of each): those with the smallest
hashes, all texts of a language that has fewer. Copies of a text count once. Every value of the language column is
learned: above ``SAMPLE_TOTAL`` texts for all languages, each gives fewer (one at least), and above ``MAX_LANDMARKS``
languages not each has a landmark. The driver holds a row of coefficients per language. Scoring is batched: presence matrix by landmarks,
then by coefficients; a text's score is the mean of its segments, weighted by their bytes.

Cases: a null text or one without any letter is ``und`` with score 0; without training rows every
text is; rows with null language do not train; with a single language all texts with letters get
it; repeated rows are scored alike; extra columns are kept, and outputs replace columns of their names.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from ..session import materialize
from .tables import free_names, q
from .textarrays import LOWER_CODES, U64, mix, text_bytes

DIMENSIONS = 8192
ORDERS = 4
SEGMENT = 2000
SAMPLE_DOCS = 300
SAMPLE_SEGMENTS = 2
DRAW = 3
SAMPLE_TOTAL = 120_000
LANDMARKS = 128
MAX_LANDMARKS = 400
CELLS = 1 << 20
RIDGE = 1e-2
BLOCK = 256


@dataclass
class Model:
    languages: list[str]
    landmarks: np.ndarray  # landmarks by places, float32, each over the root of its size
    weights: np.ndarray  # landmarks by languages


def presence(data: np.ndarray, edges: np.ndarray) -> np.ndarray:
    """0/1 matrix (segments by places) of the n-grams inside each segment [edges[i], edges[i + 1])."""
    out = np.zeros((len(edges) - 1, DIMENSIONS), np.float32)
    if not len(data):
        return out
    segment = np.repeat(np.arange(len(edges) - 1), np.diff(edges))
    codes, gram = LOWER_CODES[data], np.zeros(len(data), U64)
    for n in range(1, ORDERS + 1):
        size = len(data) - n + 1
        if size <= 0:
            break
        gram = gram[:size] * U64(0xA0761D6478BD642F) + codes[n - 1 :]
        place = (mix(gram + U64(n)) >> U64(64 - DIMENSIONS.bit_length() + 1)).astype(np.int64)
        inside = segment[:size] == segment[n - 1 :]
        out[segment[:size][inside], place[inside]] = 1
    return out


def _edges(length: int) -> np.ndarray:
    """Segment bounds of one text; a short rest joins the last segment."""
    parts = max(1, int(round(length / SEGMENT)))
    return np.append(np.arange(parts) * SEGMENT, length)


def kernel(rows: np.ndarray, landmarks: np.ndarray) -> np.ndarray:
    return (rows @ landmarks.T) / np.sqrt(np.maximum(rows.sum(1), 1))[:, None]


def kernel_batch(column: pa.Array, model: Model) -> np.ndarray:
    """Mean kernels of the segments, texts by landmarks."""
    data, starts, ends = text_bytes(column)
    out = np.zeros((len(starts), len(model.landmarks)))
    sums = np.zeros(len(starts))
    owner, a_edges = [], []

    def flush() -> None:
        if not owner:
            return
        for i in range(0, len(owner), BLOCK):
            spans = a_edges[i : i + BLOCK]
            joined = np.concatenate([data[a:b] for a, b in spans])
            edges = np.concatenate([[0], np.cumsum([b - a for a, b in spans])])
            size = np.diff(edges)
            np.add.at(out, owner[i : i + BLOCK], kernel(presence(joined, edges), model.landmarks) * size[:, None])
            np.add.at(sums, owner[i : i + BLOCK], size)
        owner.clear()
        a_edges.clear()

    for k in range(len(starts)):
        if ends[k] > starts[k]:
            edges = _edges(int(ends[k] - starts[k])) + starts[k]
            owner.extend([k] * (len(edges) - 1))
            a_edges.extend(zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True))
        if len(owner) >= 8 * BLOCK:
            flush()
    flush()
    return out / np.maximum(sums, 1)[:, None]


def best_of(column: pa.Array, model: Model) -> tuple[np.ndarray, np.ndarray]:
    """The best language's number and its score, for each text; texts by languages is held in portions of ``CELLS``."""
    marks = kernel_batch(column, model)
    best, value = np.zeros(len(marks), int), np.zeros(len(marks))
    step = max(1, CELLS // len(model.languages))
    for a in range(0, len(marks), step):
        scores = marks[a : a + step] @ model.weights
        best[a : a + step] = scores.argmax(1)
        value[a : a + step] = scores.max(1)
    return best, value


def has_letter(text: Column) -> Column:
    return F.coalesce(text.rlike(r"\p{L}"), F.lit(False))


def _draw(known: DataFrame, sizes: dict[str, int], most: int) -> DataFrame:
    """(lang, h1, h2): for each language the ``most`` smallest of its distinct hashes, or all if it has fewer.

    Only a share of about ``DRAW * most`` hashes is ranked; it grows for languages where too few fall into it.
    """
    drawn = F.pmod("h1", F.lit(1 << 40)).cast("double") / float(1 << 40)
    first = Window.partitionBy("lang").orderBy("drawn", "h2", "h1")
    share = {x: min(1.0, DRAW * most / n) for x, n in sizes.items()}
    while True:
        shares = known.sparkSession.createDataFrame(list(share.items()), "lang string, share double")
        some = known.join(F.broadcast(shares), "lang").withColumn("drawn", drawn).filter("drawn < share")
        some = some.withColumn("no", F.row_number().over(first)).filter(F.col("no") <= most)
        chosen = materialize(some.select("lang", "h1", "h2"), "language-draw")
        got = {r["lang"]: r["n"] for r in chosen.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
        short = [x for x, n in sizes.items() if got.get(x, 0) < min(most, n) and share[x] < 1]
        if not short:
            return chosen
        share |= {x: min(1.0, 8 * share[x]) for x in short}


def fit(train: DataFrame, text: str = "text", lang: str = "lang") -> Model | None:
    """Train on a bounded sample of the distinct texts, chosen by a hash of the text, evenly over the languages."""
    rows = train.filter(q(lang).isNotNull() & has_letter(q(text))).select(q(lang).alias("lang"), q(text).alias("text"))
    rows = rows.withColumn("h1", F.xxhash64(F.lit(11), "text")).withColumn("h2", F.xxhash64(F.lit(12), "text"))
    known = materialize(rows.select("lang", "h1", "h2").distinct(), "language-texts")
    counts = known.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()
    if not counts:
        return None
    most = min(SAMPLE_DOCS, max(1, SAMPLE_TOTAL // len(counts)))
    chosen = _draw(known, {r["lang"]: r["n"] for r in counts}, most)
    fit_ = rows.join(F.broadcast(chosen), ["lang", "h1", "h2"]).select("lang", "text").distinct()

    def sample(batches):
        for batch in batches:
            data, starts, ends = text_bytes(batch.column("text"))
            langs, packed = [], []
            for k, lang_ in enumerate(batch.column("lang").to_pylist()):
                edges = _edges(int(ends[k] - starts[k]))
                chosen = np.unique(np.linspace(0, len(edges) - 2, SAMPLE_SEGMENTS).astype(int))
                for i in chosen:
                    part = data[starts[k] + edges[i] : starts[k] + edges[i + 1]]
                    bits = presence(part, np.array([0, len(part)]))[0]
                    langs.append(lang_)
                    packed.append(np.packbits(bits > 0).tobytes())
            yield pa.RecordBatch.from_arrays([pa.array(langs, pa.string()), pa.array(packed, pa.binary())], ["lang", "bits"])

    # at most max(languages, SAMPLE_TOTAL) * SAMPLE_SEGMENTS rows of DIMENSIONS / 8 bytes
    got: pd.DataFrame = fit_.mapInArrow(sample, "lang string, bits binary").orderBy("lang", "bits").toPandas()
    if not len(got):
        return None
    return solve(got["lang"].tolist(), np.frombuffer(b"".join(got["bits"]), np.uint8).reshape(len(got), -1))


def solve(langs: list[str], packed: np.ndarray) -> Model:
    """Kernel ridge regression on landmarks (subset of regressors), one target per language. packed: bits of each segment."""
    names, own = np.unique(np.array(langs, object), return_inverse=True)
    each = max(1, LANDMARKS // len(names))
    rng = np.random.default_rng(5)
    of_language = np.split(np.argsort(own, kind="stable"), np.cumsum(np.bincount(own))[:-1])
    chosen = np.concatenate([rng.permutation(x)[:each] for x in of_language])
    chosen = chosen if len(chosen) <= MAX_LANDMARKS else np.sort(rng.permutation(chosen)[:MAX_LANDMARKS])
    marks = np.unpackbits(packed[chosen], axis=1).astype(np.float32)
    inner = marks.copy()
    marks /= np.sqrt(np.maximum(marks.sum(1), 1))[:, None]
    inner = kernel(inner, marks).astype(np.float64)
    balance = 1 / np.bincount(own)  # languages count alike
    square, sums = np.zeros_like(inner), np.zeros((len(names), len(marks)))
    for a in range(0, len(packed), BLOCK):
        cross = kernel(np.unpackbits(packed[a : a + BLOCK], axis=1).astype(np.float32), marks).astype(np.float64)
        weighted = cross * balance[own[a : a + BLOCK]][:, None]
        square += cross.T @ weighted
        np.add.at(sums, own[a : a + BLOCK], weighted)
    left = square + RIDGE * inner / len(packed) * len(names) + 1e-8 * np.eye(len(inner))
    # targets are 1 for the own language and -1 for the others
    return Model(names.tolist(), marks, np.linalg.solve(left, 2 * sums.T - sums.sum(0)[:, None]))


def predict(df: DataFrame, model: Model | None, text: str = "text") -> DataFrame:
    """``df`` with ``lang_pred`` and ``score`` (0 to 1)."""
    df = df.drop(*[c for c in df.columns if c.lower() in ("lang_pred", "score") and c != text])
    if model is None:
        return df.withColumn("lang_pred", F.lit("und")).withColumn("score", F.lit(0.0))
    kind = pa.struct([("lang", pa.string()), ("score", pa.float64())])

    @F.arrow_udf("struct<lang:string,score:double>")
    def language(texts: pa.Array) -> pa.Array:
        best, value = best_of(texts, model)
        value = np.clip((value + 1) / 2, 0, 1)
        return pa.StructArray.from_arrays([pa.array(np.array(model.languages, object)[best], pa.string()), pa.array(value)], fields=list(kind))

    (found,) = free_names(df, "found")
    letter = has_letter(q(text))
    out = df.withColumn(found, language(F.coalesce(q(text), F.lit(""))))
    out = out.withColumn("lang_pred", F.when(letter, q(found)["lang"]).otherwise("und"))
    return out.withColumn("score", F.when(letter, q(found)["score"]).otherwise(0.0)).drop(found)
