"""Toxicity scores: boosted trees over dense text features, calibrated by isotonic regression.

Features of a whole text (``FEATURES``): densities of a fixed lexicon and of a lexicon learned from
the labels, hits near a second-person word, capitals, punctuation and obfuscated spellings. Words
are compared after folding: A-Z to lower case, look-alike digits and signs to letters, other signs
dropped, so ``1d1o.t`` meets ``idiot``. Training uses a bounded sample of labelled rows
(``SAMPLE_ROWS``, by a hash of the id), split by hash in three: word statistics, trees, calibration.

Cases: a null or empty text has all features 0 and still gets a score; labels that are null or of unknown
documents do not train; repeated labels of an id count once (the larger); without labels the score is 0, with one
class only it is that class; extra columns are kept, outputs replace columns of their names.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import IsotonicRegression, IsotonicRegressionModel
from pyspark.sql import Column, DataFrame, functions as F

from ..session import materialize
from .tables import free_names, q
from .textarrays import BYTE_CODES, U64, pieces, rolling, span_hashes, text_bytes, IS_SPACE

#: Insults and slurs of common use, folded spelling.
LEXICON = "idiot idiots stupid moron morons scum trash pathetic disgusting loser losers dumb worthless garbage filth vermin hate shut kill ugly fool fools imbecile cretin".split()
#: Second-person words of English, German, French and Spanish.
SECOND_PERSON = "you your yours yourself u ur du dich dir dein deine ihr euch euer tu te toi ton ta tes vous votre vos usted ustedes ti tuyo su".split()
FEATURES = "words seed_share seed_hits learned_share learned_sum learned_top learned_kinds near_you capitals shouting exclamations questions signs obfuscated hidden_hits".split()

SAMPLE_ROWS = 60_000
LEARNED_WORDS = 500
NEAR = 5
TREES, DEPTH = 30, 4

_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[65:91] = np.arange(97, 123)
for _sign, _letter in zip("01345789@$", "oieastbgas", strict=True):
    _FOLD[ord(_sign)] = ord(_letter)
_PLAIN = np.zeros(256, bool)
_PLAIN[[*range(65, 91), *range(97, 123), *range(128, 256)]] = True
_LETTER = (_FOLD >= 97) & (_FOLD <= 122) | (np.arange(256) >= 128)
_CAPITAL = np.zeros(256, bool)
_CAPITAL[65:91] = True
_SIGN = ~_PLAIN & ~IS_SPACE
_SIGN[48:58] = False


@dataclass
class Words:
    """Learned words: hash to weight, sorted by hash."""

    hashes: np.ndarray = field(default_factory=lambda: np.zeros(0, U64))
    weights: np.ndarray = field(default_factory=lambda: np.zeros(0))


def folded(word: str) -> np.ndarray:
    return _FOLD[np.frombuffer(word.encode(), np.uint8)]


def _hash_of(words: list[str]) -> np.ndarray:
    out = []
    for w in words:
        raw = folded(w)
        sums, inverse = rolling(BYTE_CODES[raw])
        out.append(span_hashes(sums, inverse, np.array([0]), np.array([len(raw)]))[0])
    return np.sort(np.array(out, U64))


_SEED, _YOU = _hash_of(LEXICON), _hash_of(SECOND_PERSON)


def _among(values: np.ndarray, known: np.ndarray) -> np.ndarray:
    """Place of each value in the sorted array, or -1."""
    if not len(known):
        return np.full(len(values), -1)
    at = np.minimum(np.searchsorted(known, values), len(known) - 1)
    return np.where(known[at] == values, at, -1)


def _runs(data: np.ndarray, starts: np.ndarray, ends: np.ndarray):
    """Rows in runs of bounded bytes; parts of one long text follow each other, cut at white space."""
    for a, b in pieces(starts, ends):
        lengths = ends[a:b] - starts[a:b]
        if b > a + 1 or lengths[0] <= 2 << 20:
            first = np.concatenate([[0], np.cumsum(lengths + 1)])
            joined = np.full(int(first[-1]), 32, np.uint8)
            for k in range(b - a):
                joined[first[k] : first[k] + lengths[k]] = data[starts[a + k] : ends[a + k]]
            yield a, joined, first
        else:
            at = int(starts[a])
            while at < ends[a]:
                to = min(int(ends[a]), at + (1 << 20))
                while to < ends[a] and not IS_SPACE[data[to]]:
                    to += 1
                joined = np.append(data[at:to], np.uint8(32))
                yield a, joined, np.array([0, len(joined)])
                at = to


def word_stats(joined: np.ndarray) -> tuple[np.ndarray, ...]:
    """Folded hash, start, end, letters and inner signs of every word."""
    inside = np.zeros(len(joined) + 2, np.int8)
    inside[1:-1] = ~IS_SPACE[joined]
    edge = np.diff(inside)
    ws, we = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    letter = _LETTER[joined]
    kept = np.concatenate([[0], np.cumsum(letter)])
    sums, inverse = rolling(BYTE_CODES[_FOLD[joined[letter]]])
    hashes = span_hashes(sums, inverse, kept[ws], kept[we])
    plain = np.concatenate([[0], np.cumsum(_PLAIN[joined])])
    plain_n = plain[we] - plain[ws]
    # first and last plain letter: signs between them are inner signs
    at = np.flatnonzero(_PLAIN[joined])
    some = plain_n > 0
    first, last = ws.copy(), ws.copy()
    first[some], last[some] = at[plain[ws[some]]], at[plain[we[some]] - 1]
    inner = np.where(some, last - first + 1 - plain_n, 0)
    return hashes, ws, we, plain_n, inner


def features_of(column: pa.Array, learned: Words) -> np.ndarray:
    """Texts by FEATURES."""
    data, starts, ends = text_bytes(column)
    n = len(starts)
    t = {name: np.zeros(n) for name in ("words", "seed", "sum", "top", "kinds", "near", "capital", "letter", "shout", "ex", "qu", "sign", "bytes", "obf", "hidden")}
    for a, joined, first in _runs(data, starts, ends):
        row = slice(a, a + len(first) - 1)
        hashes, ws, we, plain_n, inner = word_stats(joined)
        owner = np.searchsorted(first, ws, "right") - 1
        count = len(first) - 1

        def per_row(values, owner=owner, count=count):
            return np.bincount(owner, values, count)

        def per_byte(table, joined=joined, first=first):
            sums = np.concatenate([[0], np.cumsum(table[joined])])
            return sums[first[1:]] - sums[first[:-1]]

        seed = _among(hashes, _SEED) >= 0
        at = _among(hashes, learned.hashes)
        known = at >= 0
        weight = np.where(known, learned.weights[at], 0.0) if len(learned.hashes) else np.zeros(len(hashes))
        hit = seed | known
        obfuscated = (inner > 0) & (plain_n >= 2)
        you = np.flatnonzero(_among(hashes, _YOU) >= 0)
        near = np.zeros(len(hashes) + 1)
        np.add.at(near, np.maximum(you - NEAR, np.searchsorted(owner, owner[you], "left")), 1)
        np.add.at(near, np.minimum(you + NEAR + 1, np.searchsorted(owner, owner[you], "right")), -1)
        close = np.cumsum(near)[:-1] > 0
        capital_n = np.concatenate([[0], np.cumsum(_CAPITAL[joined])])
        caps = capital_n[we] - capital_n[ws]
        for name, values in (
            ("words", per_row(np.ones(len(ws)))), ("seed", per_row(seed.astype(float))), ("sum", per_row(weight)), ("near", per_row((hit & close).astype(float))),
            ("shout", per_row(((caps >= 3) & (caps == plain_n)).astype(float))), ("obf", per_row(obfuscated.astype(float))), ("hidden", per_row((hit & obfuscated).astype(float))),
            ("capital", per_byte(_CAPITAL)), ("letter", per_byte(_PLAIN)), ("ex", per_byte(np.arange(256) == 33)), ("qu", per_byte(np.arange(256) == 63)), ("sign", per_byte(_SIGN)),
            ("bytes", np.diff(first) - 1),
        ):
            t[name][row] += values
        if known.any():
            top = np.zeros(count)
            np.maximum.at(top, owner[known], weight[known])
            t["top"][row] = np.maximum(t["top"][row], top)
            pairs = np.unique(owner[known] * len(learned.hashes) + at[known])
            t["kinds"][row] = np.maximum(t["kinds"][row], np.bincount(pairs // len(learned.hashes), minlength=count))
    words, size, letters = np.maximum(t["words"], 1), np.maximum(t["bytes"], 1), np.maximum(t["letter"], 1)
    return np.stack([np.log1p(t["words"]), t["seed"] / words, np.log1p(t["seed"]), t["sum"] / words, np.log1p(t["sum"]), t["top"], t["kinds"], t["near"] / words, t["capital"] / letters, t["shout"] / words, t["ex"] / size, t["qu"] / size, t["sign"] / size, t["obf"] / words, np.log1p(t["hidden"])], axis=1)


def with_features(df: DataFrame, text: Column, learned: Words, name: str) -> DataFrame:
    @F.arrow_udf("array<double>")
    def features(texts: pa.Array) -> pa.Array:
        values = features_of(texts, learned)
        return pa.ListArray.from_arrays(pa.array(np.arange(len(values) + 1) * len(FEATURES), pa.int32()), pa.array(values.ravel()))

    return df.withColumn(name, features(F.coalesce(text, F.lit(""))))


def learn_words(rows: DataFrame) -> Words:
    """Words over-represented in toxic documents: ``rows`` has text and toxic (0 or 1).

    Documents per word and class are counted with partial sums; the best ``LEARNED_WORDS`` return.
    """
    totals = {r["toxic"]: r["n"] for r in rows.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    good, bad = totals.get(0, 0), totals.get(1, 0)
    if not good or not bad:
        return Words()

    def counted(batches):
        for batch in batches:
            data, starts, ends = text_bytes(batch.column("text"))
            toxic = batch.column("toxic").to_numpy()
            for a, joined, first in _runs(data, starts, ends):
                hashes, ws, _, plain_n, _ = word_stats(joined)
                owner = np.searchsorted(first, ws, "right") - 1
                use = plain_n >= 2
                order = np.lexsort((hashes[use], owner[use]))
                h, o = hashes[use][order], owner[use][order]
                new = np.ones(len(h), bool)
                new[1:] = (h[1:] != h[:-1]) | (o[1:] != o[:-1])
                h, label = h[new], toxic[a + o[new]]
                value, place = np.unique(h, return_inverse=True)
                yield pa.RecordBatch.from_arrays([pa.array(value.astype(np.int64)), pa.array(np.bincount(place, label, len(value)).astype(np.int64)), pa.array(np.bincount(place, 1 - label, len(value)).astype(np.int64))], ["word", "bad", "good"])

    found = rows.mapInArrow(counted, "word long, bad long, good long").groupBy("word").agg(F.sum("bad").alias("bad"), F.sum("good").alias("good"))
    odds = F.log((F.col("bad") + 0.5) / (bad + 1.0)) - F.log((F.col("good") + 0.5) / (good + 1.0))
    best = found.filter(F.col("bad") >= max(5, bad // 200)).withColumn("odds", odds).filter("odds >= 1").orderBy(F.desc(F.col("odds") * F.sqrt("bad")), "word").limit(LEARNED_WORDS).collect()
    words = sorted((int(np.int64(r["word"]).astype(U64)), r["odds"]) for r in best)
    return Words(np.array([w for w, _ in words], U64), np.array([o for _, o in words]))


@dataclass
class Model:
    words: Words
    trees: GBTClassificationModel | None
    curve: IsotonicRegressionModel | None
    constant: float


def fit(docs: DataFrame, labels: DataFrame, text: str = "text", label: str = "toxic", key: str = "doc_id") -> Model:
    """Fit on the documents that ``labels`` (key and 0/1 label) names.

    At most about ``SAMPLE_ROWS`` labels are drawn, so they can be broadcast and texts are not shuffled.
    """
    known = labels.filter(q(label).isin(0, 1) & q(key).isNotNull()).groupBy(q(key).alias("key")).agg(F.max(q(label)).cast("int").alias("toxic"))
    seen = known.agg(F.count(F.lit(1)).alias("n"), F.avg("toxic").alias("mean")).first()
    if not seen["n"] or seen["mean"] in (0.0, 1.0):
        return Model(Words(), None, None, float(seen["mean"] or 0.0))
    bound = int(min(1.0, SAMPLE_ROWS / seen["n"]) * 1_000_003) + 1
    drawn = known.withColumn("draw", F.xxhash64(F.lit(3), "key")).filter(F.pmod("draw", F.lit(1_000_003)) < bound)
    drawn = drawn.withColumn("part", F.pmod(F.shiftright("draw", 24), F.lit(5)).cast("int")).drop("draw")
    rows = docs.select(q(key).alias("key"), q(text).alias("text")).join(F.broadcast(drawn), "key").drop("key")
    rows = materialize(rows, "toxicity-sample")
    words = learn_words(rows.filter("part < 2").select("text", "toxic"))
    featured = with_features(rows.filter("part >= 2"), F.col("text"), words, "features")
    featured = materialize(featured.select("part", F.col("toxic").cast("double").alias("label"), "features"), "toxicity-features")
    vectors = featured.select("part", "label", array_to_vector("features").alias("features")).coalesce(max(1, featured.observed["rows"] // 10_000))
    fitted, held = vectors.filter("part < 4"), vectors.filter("part = 4")
    classes = {(r["part"] < 4, r["label"]) for r in featured.select("part", "label").distinct().collect()}
    if {(True, 0.0), (True, 1.0)} - classes:
        return Model(words, None, None, float(seen["mean"]))
    fitted = fitted.persist()
    trees = GBTClassifier(maxIter=TREES, maxDepth=DEPTH, stepSize=0.2, seed=17, minInstancesPerNode=5).fit(fitted)
    fitted.unpersist()
    curve = None
    if not {(False, 0.0), (False, 1.0)} - classes:
        scored = trees.transform(held).select("label", vector_to_array("probability")[1].alias("raw"))
        curve = IsotonicRegression(featuresCol="raw").fit(scored)
    return Model(words, trees, curve, float(seen["mean"]))


def score(df: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """``df`` with ``score``, the calibrated probability of label 1."""
    df = df.drop(*[c for c in df.columns if c.lower() == "score" and c != text])
    if model.trees is None:
        return df.withColumn("score", F.lit(model.constant))
    f, v, raw, prob, pred, p, cal = free_names(df, "f_", "v_", "raw_", "prob_", "pred_", "p_", "cal_")
    rows = with_features(df, q(text), model.words, f).withColumn(v, array_to_vector(q(f)))
    trees = model.trees.copy().setFeaturesCol(v).setRawPredictionCol(raw).setProbabilityCol(prob).setPredictionCol(pred)
    rows = trees.transform(rows).withColumn(p, vector_to_array(q(prob))[1])
    if model.curve is None:
        rows = rows.withColumn(cal, q(p))
    else:
        rows = model.curve.copy().setFeaturesCol(p).setPredictionCol(cal).transform(rows)
    # equal steps of the curve keep the order of the trees by a hair
    final = F.least(F.lit(1.0), F.greatest(F.lit(0.0), q(cal) * 0.999 + q(p) * 0.001))
    return rows.withColumn("score", final).drop(f, v, raw, prob, pred, p, cal)
