"""Language identification by a bidirectional gated recurrent network over bytes.

The network reads UTF-8 bytes in windows, one state of ``HIDDEN`` numbers in each direction, and
labels every byte position; a document's probabilities are the mean over all of its positions.
It is trained here, in numpy, by backpropagation through time with Adam, on windows of a
bounded sample of labelled rows (``SAMPLE`` documents, by hash of the id). A text of over ``SAMPLE_CHARS`` characters teaches by
``PIECES`` pieces of it, one from each part of the whole text, at places that its id's hash names. Labelling reads every text whole.

Defined results: null texts and those without a letter are ``und`` with score 0; rows
with null language or id don't teach; without rows to learn from every text is ``und``; a single language is the
answer for every text with a letter; repeated rows are labelled alike; other columns pass
through, and input columns named lang_pred or lang_score are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from voxloom.llm.common import columns, compact, free_names, held_out, small_batches, table

SAMPLE, SAMPLE_CHARS, PIECES = 1600, 4000, 10
HIDDEN, TRAIN_WINDOW, WINDOW, BATCH, STEPS, RATE = 8, 48, 96, 160, 220, 0.02
UNKNOWN = "und"


def start(classes: int, hidden: int = HIDDEN, seed: int = 5) -> dict[str, np.ndarray]:
    """Random parameters. Gates are update, reset and candidate; the last axis has both directions."""
    rng = np.random.default_rng(seed)
    p = {
        "E": rng.normal(0, 0.3, (256, 3, 2 * hidden)),
        "U": rng.normal(0, hidden**-0.5, (2 * hidden, 3, 2 * hidden)) * block(hidden),
        "b": np.zeros(2 * hidden),
        "V": rng.normal(0, 0.3, (2 * hidden, classes)),
        "c": np.zeros(classes),
    }
    return {k: v.astype(np.float32) for k, v in p.items()}


def block(hidden: int) -> np.ndarray:
    """Ones where a state may act on a gate: in its own direction."""
    one = np.zeros((2 * hidden, 1, 2 * hidden), dtype=np.float32)
    one[:hidden, :, :hidden] = 1
    one[hidden:, :, hidden:] = 1
    return one


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * np.tanh(0.5 * x) + 0.5


def run(p: dict[str, np.ndarray], x: np.ndarray, mask: np.ndarray, keep: bool = False):
    """States (T, B, 2H) at every position of windows x (B, T); masked positions leave a state as it is."""
    (n, steps), hidden = x.shape, p["b"].shape[0] // 2
    table_f, table_b = np.ascontiguousarray(p["E"][:, :, :hidden]), np.ascontiguousarray(p["E"][:, :, hidden:])
    flat_u = p["U"].reshape(2 * hidden, -1)
    h = np.zeros((n, 2 * hidden), dtype=np.float32)
    out, saved = np.empty((steps, n, 2 * hidden), dtype=np.float32), []
    g = np.empty((n, 3, 2 * hidden), dtype=np.float32)
    xt, mt = np.ascontiguousarray(x.T), np.ascontiguousarray(mask.T)
    whole = bool(mask.all())
    for t in range(steps):
        u = steps - 1 - t
        g[:, :, :hidden], g[:, :, hidden:] = table_f[xt[t]], table_b[xt[u]]
        a = (h @ flat_u).reshape(n, 3, 2 * hidden)
        zr = _sigmoid(g[:, :2] + a[:, :2])
        z, r = zr[:, 0], zr[:, 1]
        q = a[:, 2] + p["b"]
        c = np.tanh(g[:, 2] + r * q)
        new = c + z * (h - c)
        m = None
        if not whole:
            m = np.repeat(np.stack([mt[t], mt[u]], axis=1), hidden, axis=1)
            new = np.where(m, new, h)
        if keep:
            saved.append((h, z, r, q, c, m))
        h = new
        out[t, :, :hidden], out[u, :, hidden:] = h[:, :hidden], h[:, hidden:]
    return (out, saved) if keep else out


def softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def gradients(p: dict[str, np.ndarray], x: np.ndarray, mask: np.ndarray, y: np.ndarray) -> tuple[float, dict[str, np.ndarray]]:
    """Mean cross entropy over unmasked positions, and its gradients by backpropagation through time."""
    out, saved = run(p, x, mask, keep=True)
    (n, steps), hidden = x.shape, p["b"].shape[0] // 2
    prob = softmax(out @ p["V"] + p["c"])
    mt = mask.T[:, :, None]
    loss = float(-(np.log(prob[:, np.arange(n), y] + 1e-12) * mask.T).sum() / mask.sum())
    d = prob.copy()
    d[:, np.arange(n), y] -= 1
    d = (d * mt / mask.sum()).astype(np.float32)
    grad = {"V": np.einsum("tbh,tbc->hc", out, d), "c": d.sum(axis=(0, 1)), "U": np.zeros_like(p["U"]).reshape(2 * hidden, -1), "b": np.zeros_like(p["b"])}
    d_out = d @ p["V"].T
    flat_u = p["U"].reshape(2 * hidden, -1)
    d_g = np.empty((steps, n, 3, 2 * hidden), dtype=np.float32)
    dh = np.zeros((n, 2 * hidden), dtype=np.float32)
    for t in reversed(range(steps)):
        u = steps - 1 - t
        h, z, r, q, c, m = saved[t]
        dh = dh + np.concatenate([d_out[t, :, :hidden], d_out[u, :, hidden:]], axis=1)
        stay = 0.0
        if m is not None:
            stay, dh = dh * ~m, dh * m
        d_c = dh * (1 - z) * (1 - c * c)
        d_z = dh * (h - c) * z * (1 - z)
        d_r = d_c * q * r * (1 - r)
        d_q = d_c * r
        d_g[t] = np.stack([d_z, d_r, d_c], axis=1)
        d_a = np.concatenate([d_z, d_r, d_q], axis=1)
        grad["U"] += h.T @ d_a
        grad["b"] += d_q.sum(axis=0)
        dh = dh * z + d_a @ flat_u.T + stay
    grad["U"] = grad["U"].reshape(p["U"].shape) * block(hidden)
    grad["E"] = np.zeros_like(p["E"])
    one = np.zeros((steps * n, 256), dtype=np.float32)
    one[np.arange(steps * n), x.T.reshape(-1)] = 1
    forth, back = d_g[..., :hidden].reshape(steps * n, -1), d_g[::-1, ..., hidden:].reshape(steps * n, -1)
    grad["E"][:, :, :hidden] = (one.T @ forth).reshape(256, 3, hidden)
    grad["E"][:, :, hidden:] = (one.T @ back).reshape(256, 3, hidden)
    return loss, grad


def windows(data: bytes, size: int) -> tuple[np.ndarray, np.ndarray]:
    """The bytes in consecutive windows (k, size), and which places hold a byte."""
    k = -(-len(data) // size)
    x = np.zeros(k * size, dtype=np.uint8)
    x[: len(data)] = np.frombuffer(data, np.uint8)
    return x.reshape(k, size), (np.arange(k * size) < len(data)).reshape(k, size)


def fit(texts: list[str], langs: list[str], steps: int = STEPS, seed: int = 3) -> tuple[list[str], dict[str, np.ndarray]]:
    """(languages, parameters). Windows are drawn evenly from the languages."""
    names = sorted(set(langs))
    rng, p = np.random.default_rng(seed), start(len(names))
    own: list[list[bytes]] = [[] for _ in names]
    for t, lang in zip(texts, langs, strict=True):
        if b := t.encode("utf-8", "replace"):
            own[names.index(lang)].append(b)
    if len(names) < 2:
        return names, p
    m1, m2 = {k: np.zeros_like(v) for k, v in p.items()}, {k: np.zeros_like(v) for k, v in p.items()}
    size, taught = TRAIN_WINDOW, [i for i, o in enumerate(own) if o]
    for step in range(1, steps + 1):
        y = rng.choice(taught, BATCH)
        x, mask = np.zeros((BATCH, size), dtype=np.uint8), np.zeros((BATCH, size), dtype=bool)
        for i, c in enumerate(y):
            b = own[c][rng.integers(len(own[c]))]
            at = int(rng.integers(max(1, len(b) - size + 1)))
            part = np.frombuffer(b[at : at + size], np.uint8)
            x[i, : len(part)], mask[i, : len(part)] = part, True
        _, grad = gradients(p, x, mask, y)
        norm = np.sqrt(sum(float((g * g).sum()) for g in grad.values()))
        rate = RATE * min(1.0, 2 * (1 - step / (steps + 1)))
        for k, g in grad.items():
            g = g * min(1.0, 1.0 / (norm + 1e-9))
            m1[k], m2[k] = 0.9 * m1[k] + 0.1 * g, 0.99 * m2[k] + 0.01 * g * g
            p[k] -= (rate * (m1[k] / (1 - 0.9**step)) / (np.sqrt(m2[k] / (1 - 0.99**step)) + 1e-8)).astype(np.float32)
    return names, p


def label(p: dict[str, np.ndarray], texts: list[str], most: int = 1024) -> np.ndarray:
    """Each text's mean probabilities over all its byte positions; a text without bytes has zeros."""
    classes = p["c"].shape[0]
    total, count = np.zeros((len(texts), classes)), np.zeros(len(texts))
    part: list[tuple[int, np.ndarray, np.ndarray]] = []

    def flush() -> None:
        x, m = np.concatenate([w[1] for w in part]), np.concatenate([w[2] for w in part])
        text = np.repeat([w[0] for w in part], [len(w[1]) for w in part])
        for at in range(0, len(x), most):
            xs, ms, own = x[at : at + most], m[at : at + most], text[at : at + most]
            prob = softmax(run(p, xs, ms) @ p["V"] + p["c"])
            sums = (prob * ms.T[:, :, None]).sum(axis=0)
            np.add.at(total, own, sums)
            np.add.at(count, own, ms.sum(axis=1))
        part.clear()

    held = 0
    for i, t in enumerate(texts):
        if b := t.encode("utf-8", "replace"):
            part.append((i, *windows(b, WINDOW)))
            held += len(part[-1][1])
            if held >= 4 * most:
                flush()
                held = 0
    if part:
        flush()
    return total / np.maximum(count, 1)[:, None]


def taught(text: Column, doc_id: Column, most: int = SAMPLE_CHARS, pieces: int = PIECES) -> Column:
    """A text, or for one of over ``most`` characters as many from places spread over all of it, a line each."""
    size, part = most // pieces, F.floor(F.char_length(text) / pieces).cast("int")
    place = lambda i: i * part + F.pmod(F.xxhash64(doc_id, i), F.greatest(part - size + 1, F.lit(1))).cast("int") + 1
    spread = F.transform(F.sequence(F.lit(0), F.lit(pieces - 1)), lambda i: F.substr(text, place(i), F.lit(size)))
    return F.when(text.isNull() | (F.char_length(text) <= most), text).otherwise(F.array_join(spread, "\n"))


def train(docs: DataFrame, text: str = "text", lang: str = "lang", sample: int = SAMPLE) -> tuple[list[str], dict[str, np.ndarray]]:
    """A network from at most ``sample`` labelled rows that aren't held out."""
    t = F.col(f"`{text}`").cast("string")
    rows = docs.select("doc_id", F.col(lang).cast("string").alias("l"), t.alias("t")).where(F.col("doc_id").isNotNull() & F.col("l").isNotNull() & t.isNotNull() & ~held_out(F.col("doc_id")))
    total = rows.count()
    # First about four times the sample by hash, so that the sort moves few texts.
    near = rows.where(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 20)) <= min(1.0, 4 * sample / max(total, 1)) * (1 << 20))
    got = near.select("l", taught(F.col("t"), F.col("doc_id")).alias("t"), F.xxhash64("doc_id").alias("h"), "doc_id").orderBy("h", "doc_id", "t", "l").limit(sample).toPandas()
    return fit(got["t"].to_list(), got["l"].to_list())


def identify(docs: DataFrame, names: list[str], p: dict[str, np.ndarray], text: str = "text") -> DataFrame:
    """Adds lang_pred and lang_score."""
    small_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(p)

    @F.pandas_udf("lang_pred string, lang_score double")
    def labelled(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            ok = np.array([bool(names) and t is not None and any(c.isalpha() for c in t) for t in texts], dtype=bool)
            pred, score = np.full(len(texts), UNKNOWN, dtype=object), np.zeros(len(texts))
            if ok.any():
                if len(names) == 1:
                    pred[ok], score[ok] = names[0], 1.0
                else:
                    prob = label(shared.value, texts[ok].to_list())
                    pred[ok], score[ok] = np.array(names, dtype=object)[prob.argmax(axis=1)], prob.max(axis=1)
            yield pd.DataFrame({"lang_pred": pred, "lang_score": np.clip(score, 0, 1)})

    (found,) = free_names(docs, "_lang")
    rows = docs.withColumn(found, labelled(F.col(f"`{text}`").cast("string")))
    return rows.select(*columns(docs.drop("lang_pred", "lang_score")), F.col(found)["lang_pred"].alias("lang_pred"), F.col(found)["lang_score"].alias("lang_score"))


def op10_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document."""
    docs = table(spark, sf_dir, "documents")
    names, p = train(docs.select("doc_id", "text", "lang"))
    done = identify(compact(docs.select("doc_id", "text")), names, p)
    return done.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", F.col("lang_score").alias("score"))
