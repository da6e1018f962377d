"""Quality classifier: naive Bayes support vectors over hashed n-gram indicators.

Features are indicators (present or not) of words and of n-grams of word shapes (case, length class,
closing punctuation, digits, equal to the words before), hashed into 2**BITS places.
Each is scaled by its log-count ratio between the classes; a linear model with hinge loss is
fitted on the scaled indicators by dual coordinate descent, its weights are
drawn towards their mean magnitude (those beyond it; smaller ones keep theirs and all keep their sign, where the published
form blends every weight with the mean), and a logistic curve on rows kept back turns margins
into scores. The fit takes a bounded sample of labelled rows (``SAMPLE``, by hash of the id);
scoring reads every text whole, in batches, with the model as one array of 2**BITS numbers.

Defined results: null and empty texts have no indicators and get the score of the intercept;
ids that are null, unlabelled, or labelled both ways teach nothing; without rows of both
classes every score is the share of label 1 (0.5 without any); repeated rows score alike;
other columns pass through, and input columns named quality_score or quality_ok are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from voxloom.llm.common import columns, compact, discard, free_names, held_out, materialise, small_batches, table
from voxloom.llm.textvec import SPACES, batches_of, mix, span_hashes, words_of

BITS = 18
#: At most so many labelled rows are learned from.
SAMPLE = 6000
#: And at most so many indicators, 4 bytes each, unless a single row has more.
SAMPLE_INDICATORS = 20_000_000
ALPHA, BETA, COST, EPOCHS, THRESHOLD = 1.0, 0.25, 0.05, 12, 0.3


@dataclass
class Model:
    weight: np.ndarray
    #: Squares of the log-count ratios, for a text's length.
    square: np.ndarray
    bias: float
    slope: float
    shift: float

    def score(self, margin: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * margin + self.shift, -60, 60)))


def indicators(data: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(text, feature) of each indicator, sorted, once each."""
    s, e, word_ends = words_of(data, ends, SPACES)
    if not len(s):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    text = np.repeat(np.arange(len(ends)), np.diff(word_ends, prepend=0))
    word = span_hashes(data, s, e - s)
    upper = np.concatenate(([0], np.cumsum((data >= 0x41) & (data <= 0x5A))))
    lower = np.concatenate(([0], np.cumsum(((data >= 0x61) & (data <= 0x7A)) | (data >= 0x80))))
    digit = np.concatenate(([0], np.cumsum((data >= 0x30) & (data <= 0x39))))
    n, n_up, n_low, n_dig = e - s, upper[e] - upper[s], lower[e] - lower[s], digit[e] - digit[s]
    tail = np.zeros(len(s), dtype=np.uint64)
    open_ = np.ones(len(s), dtype=bool)  # so far only punctuation from the end
    for i in range(1, 4):
        b = data[np.maximum(e - i, s)]
        open_ &= (n >= i) & (b < 0x80) & ~((b >= 0x30) & (b <= 0x39)) & ~((b >= 0x41) & (b <= 0x5A)) & ~((b >= 0x61) & (b <= 0x7A))
        tail = tail * np.uint64(256) + np.where(open_, b, 0).astype(np.uint64)
    same1 = np.zeros(len(s), dtype=np.uint64)
    same1[1:] = (word[1:] == word[:-1]) & (text[1:] == text[:-1])
    case = np.select([n_low + n_up + n_dig == 0, n_dig > 0, (n_low == 0) & (n_up > 1), n_up > 1, n_up == 1], [0, 1, 2, 3, 4], 5).astype(np.uint64)
    size = np.select([n < 2, n < 8, n < 16, n < 32], [0, 1, 2, 3], 4).astype(np.uint64)
    shape = mix(((tail * np.uint64(8) + case) * np.uint64(8) + size) * np.uint64(2) + same1)
    inside = [np.ones(len(s), dtype=bool), np.concatenate(([False], text[1:] == text[:-1])), np.concatenate(([False] * 2, text[2:] == text[:-2]))[: len(s)]]
    two, three = shape.copy(), shape.copy()
    two[1:] = mix(shape[1:] * np.uint64(3) + shape[:-1])
    if len(s) > 2:
        three[2:] = mix(two[2:] * np.uint64(5) + shape[:-2])
    keys = []
    for salt, (h, ok) in enumerate(((shape, inside[0]), (two, inside[1]), (three, inside[2]), (word, inside[0]))):
        place = (mix(h + np.uint64(salt)) >> np.uint64(64 - BITS)).astype(np.int64)
        keys.append((text[ok].astype(np.int64) << BITS) | place[ok])
    key = np.unique(np.concatenate(keys))
    return key >> BITS, key & ((1 << BITS) - 1)


def fit(features: list[np.ndarray], label: np.ndarray) -> Model:
    """Log-count ratios, then dual coordinate descent on the scaled indicators."""
    label = np.asarray(label, dtype=np.int64)
    if len(set(label.tolist())) < 2:
        share = float(label.mean()) if len(label) else 0.5
        return Model(np.zeros(1 << BITS, np.float32), np.zeros(1 << BITS, np.float32), 0.0, 0.0, float(np.clip(np.log((share + 1e-6) / (1 - share + 1e-6)), -14, 14)))
    rng = np.random.default_rng(7)
    order = rng.permutation(len(label))
    back = np.zeros(len(label), dtype=bool)
    for c in (0, 1):
        own = order[label[order] == c]
        back[own[: len(own) // 5]] = True
    teach = np.flatnonzero(~back)
    count = [np.full(1 << BITS, ALPHA), np.full(1 << BITS, ALPHA)]
    for i in teach:
        count[label[i]][features[i]] += 1
    ratio = np.log(count[1] / count[1].sum()) - np.log(count[0] / count[0].sum())
    y = np.where(label == 1, 1.0, -1.0)
    n1 = label[teach].sum()
    cost = np.where(label == 1, len(teach) / (2.0 * max(n1, 1)), len(teach) / (2.0 * max(len(teach) - n1, 1))) * COST
    # Rows are brought to unit length, so that long texts don't outweigh short ones.
    norm = np.array([np.sqrt(max(1e-12, float((ratio[f] ** 2).sum()) + 1.0)) for f in features])
    w, bias, alpha = np.zeros(1 << BITS), 0.0, np.zeros(len(label))
    for _ in range(EPOCHS):
        for i in rng.permutation(teach):
            f, r = features[i], ratio[features[i]] / norm[i]
            g = y[i] * (float(w[f] @ r) + bias / norm[i]) - 1
            new = min(max(alpha[i] - g, 0.0), cost[i] * 20)
            if (step := (new - alpha[i]) * y[i]) != 0:
                alpha[i] = new
                w[f] += step * r
                bias += step / norm[i]
    mean = np.abs(w[w != 0]).mean() if (w != 0).any() else 0.0
    w = BETA * w + (1 - BETA) * np.sign(w) * np.minimum(np.abs(w), mean)
    weight = (w * ratio).astype(np.float32)
    size = ratio.astype(np.float32)
    margin = np.array([_margin(weight[f].sum(), (size[f] ** 2).sum(), bias * BETA) for f in features])
    slope, shift = _logistic(margin[back] if back.any() else margin, label[back] if back.any() else label)
    return Model(weight, size**2, bias * BETA, slope, shift)


def _margin(total, square, bias):
    return (total + bias) / np.sqrt(np.maximum(square, 0) + 1.0)


def _logistic(x: np.ndarray, label: np.ndarray) -> tuple[float, float]:
    """Platt's curve, with his smoothed targets, by Newton steps."""
    n1, n0 = int(label.sum()), int(len(label) - label.sum())
    t = np.where(label == 1, (n1 + 1) / (n1 + 2), 1 / (n0 + 2))
    a, b = 1.0, 0.0
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(a * x + b, -60, 60)))
        d, g = p * (1 - p) + 1e-9, p - t
        hess = np.array([[(d * x * x).sum() + 1e-3, (d * x).sum()], [(d * x).sum(), d.sum() + 1e-3]])
        step = np.linalg.solve(hess, np.array([(g * x).sum() + 1e-3 * a, g.sum()]))
        a, b = a - np.clip(step[0], -2, 2), b - np.clip(step[1], -2, 2)
        if abs(step).max() < 1e-6:
            break
    return float(a), float(b)


def train(docs: DataFrame, labels: DataFrame, text: str = "text", label: str = "quality", sample: int = SAMPLE) -> Model:
    """A model from the labelled rows of ``docs`` that aren't held out, at most ``sample`` of them."""
    one = labels.select("doc_id", F.col(f"`{label}`").cast("int").alias("label")).where(F.col("doc_id").isNotNull() & F.col("label").isin(0, 1) & ~held_out(F.col("doc_id")))
    one = one.groupBy("doc_id").agg(F.min("label").alias("label"), F.max("label").alias("high")).where("label = high").drop("high")
    chosen = one.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
    # Bounded by ``sample`` rows, so it may be broadcast.
    rows = docs.select("doc_id", F.col(f"`{text}`").cast("string").alias("t")).join(F.broadcast(chosen), "doc_id").select(F.xxhash64("doc_id").alias("h"), "label", "t")

    def features(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for at, data, ends in batches_of(pdf["t"]):
                t, f = indicators(data, ends)
                cut = np.searchsorted(t, np.arange(len(ends) + 1))
                own = pdf.iloc[at : at + len(ends)]
                yield pd.DataFrame({"h": own["h"].to_numpy(), "label": own["label"].to_numpy(), "f": [f[a:b].astype("<i4").tobytes() for a, b in zip(cut, cut[1:], strict=False)]})

    # Ids may have many rows, and rows many indicators: the first in order of their hashes, up to both bounds.
    found = materialise(rows.mapInPandas(features, "h long, label int, f binary").withColumns({"k": F.xxhash64("f"), "n": F.length("f") / 4}), "quality-rows")
    taken, held = [], 0
    for r in found.select("h", "k", "n").orderBy("h", "k").limit(sample).collect():
        if taken and held + r["n"] > SAMPLE_INDICATORS:
            break
        taken, held = [*taken[-1:], (r["h"], r["k"])], held + r["n"]
    last = taken[-1] if taken else (0, 0)
    upto = (F.col("h") < last[0]) | ((F.col("h") == last[0]) & (F.col("k") <= last[1]))
    got = found.where(upto).orderBy("h", "k").limit(sample).select("label", "f").toPandas()
    discard(found)
    got = got.sort_values(["label", "f"]).reset_index(drop=True)  # whatever the order of the partitions
    return fit([np.frombuffer(x, "<i4") for x in got["f"]], got["label"].to_numpy())


def score(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """Adds quality_score, and quality_ok from THRESHOLD on."""
    small_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast((model.weight, model.square))
    bias, slope, shift = model.bias, model.slope, model.shift

    @F.pandas_udf("double")
    def scored(texts: pd.Series) -> pd.Series:
        weight, square = shared.value
        out = np.empty(len(texts))
        for at, data, ends in batches_of(texts):
            t, f = indicators(data, ends)
            total = np.bincount(t, weights=weight[f], minlength=len(ends))
            size = np.bincount(t, weights=square[f], minlength=len(ends))
            out[at : at + len(ends)] = _margin(total, size, bias)
        return pd.Series(1 / (1 + np.exp(-np.clip(slope * out + shift, -60, 60))))

    (name,) = free_names(docs, "_score")
    rows = docs.withColumn(name, scored(F.col(f"`{text}`").cast("string")))
    return rows.select(*columns(docs.drop("quality_score", "quality_ok")), F.col(name).alias("quality_score"), (F.col(name) >= THRESHOLD).alias("quality_ok"))


def keep_good(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """The rows that aren't rejected, with their columns."""
    (row,) = free_names(docs, "_row")
    judged = score(docs.select(F.struct(*columns(docs)).alias(row), F.col(f"`{text}`").alias("text")), model)
    return judged.where("quality_ok").select(*[F.col(row)[c].alias(c) for c in docs.columns])


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Score of every document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    done = score(compact(docs), train(docs, table(spark, sf_dir, "labels")))
    return done.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), F.col("quality_score").alias("score"), F.col("quality_ok").cast("int").alias("predicted"))
