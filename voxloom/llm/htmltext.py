"""Main text of web pages by a recurrent block labeller.

A page is read as the sequence of its leaf blocks (``htmlblocks``). Each block is a vector: learned vectors of the tokens of its path of tags (element names
and the words of their class, id and role), learned vectors of its distinct hashed words, and a few shares (links, digits, capitals, length). A bidirectional LSTM in
numpy runs over all blocks of the page, so that each is classified with the whole document before and behind it; blocks that are
more likely article than not make the text.

It is trained here by backpropagation through time with Adam. What teaches: pages that are drawn up from random layouts (named by elements, by class words or not
at all; with menus, headers, notices, adverts, sidebars, forms, comments and footers around and inside an article), whose words come from a
bounded sample of the pages (``SAMPLE``), and the sampled pages with exactly one article or main element, which holds most of their text, by that element. Reading and labelling see every
page whole; long pages are read in stretches that hand on their states.

Defined results: a null or empty page, and one without article blocks, has an empty text; repeated rows are read one by one; other columns pass
through, and columns of the input named text or n_chars are replaced; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from voxloom.llm.common import columns, compact, free_names, small_batches, table
from voxloom.llm.htmlblocks import PATH_BUCKETS, WORD_BUCKETS, Leaf, Reader, zlib
from voxloom.llm.htmllayouts import MARKS, draw

#: Pages that are sampled, characters that a page has at most if it teaches, and pages that are drawn up.
SAMPLE, SAMPLE_CHARS, DRAWN = 600, 200_000, 2000
PATH_DIM, WORD_DIM, SHARES, HIDDEN = 16, 8, 7, 16
BATCH, STEPS, RATE = 24, 1500, 0.01
#: Blocks (with padding) that are labelled at a time, and steps of a stretch.
CELLS, STRETCH = 1 << 16, 2048
MAIN = 0.5


def start(seed: int = 7, hidden: int = HIDDEN) -> dict[str, np.ndarray]:
    """Random parameters; tokens and words that are never taught say almost nothing."""
    rng = np.random.default_rng(seed)
    dim = PATH_DIM + WORD_DIM + SHARES
    p = {"P": rng.normal(0, 0.02, (PATH_BUCKETS, PATH_DIM)), "Q": rng.normal(0, 0.02, (WORD_BUCKETS, WORD_DIM)), "V": rng.normal(0, 0.2, 2 * hidden), "v": np.zeros(1)}
    for side in "fb":
        p[f"W{side}"] = rng.normal(0, dim**-0.5, (dim, 4 * hidden))
        p[f"U{side}"] = rng.normal(0, hidden**-0.5, (hidden, 4 * hidden))
        p[f"c{side}"] = np.repeat([0.0, 1.0, 0.0, 0.0], hidden)  # gates forget little at first
    return {k: x.astype(np.float32) for k, x in p.items()}


class Page:
    """A page's blocks as numbers."""

    def __init__(self, leaves: list[Leaf], buckets: dict[str, int]) -> None:
        n = len(leaves)
        self.paths = np.fromiter((t for x in leaves for t in x.path), np.int32)
        self.path_counts = np.fromiter((len(x.path) for x in leaves), np.int64, n)
        words, counts, shares = [], np.zeros(n, np.int64), np.zeros((n, SHARES), np.float32)
        for i, x in enumerate(leaves):
            own = x.text.split(" ")
            distinct = dict.fromkeys(own)
            counts[i] = len(distinct)
            for w in distinct:
                if (b := buckets.get(w)) is None:
                    if len(buckets) > 200_000:
                        buckets.clear()
                    b = buckets[w] = zlib.crc32(w.lower().encode("utf-8", "replace")) % WORD_BUCKETS
                words.append(b)
            size = len(x.text)
            shares[i] = (np.log1p(len(own)) / 4, x.linked, x.text[-1] in ".!?…:;\"”»。", sum(w[:1].isupper() for w in own) / len(own), sum(c.isdigit() for c in x.text[:2000]) / min(size, 2000), len(x.path) / 16, np.log1p(n) / 5)
        self.words, self.word_counts, self.shares, self.blocks = np.array(words, np.int32), counts, shares, n

    def inputs(self, p: dict[str, np.ndarray], words: float = 1.0) -> np.ndarray:
        """(blocks, dim); words count with this weight."""
        return np.concatenate([_bag(p["P"], self.paths, self.path_counts), words * _bag(p["Q"], self.words, self.word_counts), self.shares], axis=1)


def _bag(vectors: np.ndarray, ids: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Sum of each stretch's vectors over the root of its length."""
    out = np.zeros((len(counts), vectors.shape[1]), np.float32)
    some = np.flatnonzero(counts)
    if len(some):
        starts = (np.cumsum(counts) - counts)[some]
        for low in range(0, len(some), 4096):  # bounds what is gathered at a time
            part = some[low : low + 4096]
            a, b = starts[low], starts[low + len(part) - 1] + counts[part[-1]]
            out[part] = np.add.reduceat(vectors[ids[a:b]], starts[low : low + len(part)] - a, axis=0)
    return out / np.sqrt(np.maximum(counts, 1))[:, None].astype(np.float32)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * np.tanh(0.5 * x) + 0.5


def scan(p: dict[str, np.ndarray], side: str, x: np.ndarray, h: np.ndarray, c: np.ndarray, keep: bool = False):
    """States (T, B, H) of one direction over x (T, B, dim), the last state and memory."""
    size, steps = h.shape[1], len(x)
    pre, u = x @ p[f"W{side}"] + p[f"c{side}"], p[f"U{side}"]
    out, saved = np.empty((steps, *h.shape), np.float32), []
    for t in range(steps):
        z = pre[t] + h @ u
        s = _sigmoid(z[:, : 3 * size])
        i, f, o, g = s[:, :size], s[:, size : 2 * size], s[:, 2 * size :], np.tanh(z[:, 3 * size :])
        before = c
        c = f * c + i * g
        squashed = np.tanh(c)
        if keep:
            saved.append((h, before, i, f, o, g, squashed))
        h = o * squashed
        out[t] = h
    return out, h, c, saved


def _turned(lengths: np.ndarray, steps: int) -> np.ndarray:
    """(T, B): for each page the places of its blocks from last to first, then its padding."""
    t = np.arange(steps)[:, None]
    return np.where(t < lengths, lengths - 1 - t, t)


def probabilities(p: dict[str, np.ndarray], pages: list[Page]) -> list[np.ndarray]:
    """Of each page's blocks: how likely they are article."""
    lengths = np.array([q.blocks for q in pages], np.int64)
    steps, n, hidden = int(lengths.max(initial=0)), len(pages), p["Uf"].shape[0]
    if not steps:
        return [np.zeros(0) for _ in pages]
    x = np.zeros((steps, n, PATH_DIM + WORD_DIM + SHARES), np.float32)
    for j, q in enumerate(pages):
        x[: q.blocks, j] = q.inputs(p)
    turned, every, score = _turned(lengths, steps), np.arange(n)[None, :], np.full((steps, n), p["v"][0], np.float32)
    for side, part in (("f", p["V"][:hidden]), ("b", p["V"][hidden:])):
        h, c = np.zeros((n, hidden), np.float32), np.zeros((n, hidden), np.float32)
        for at in range(0, steps, STRETCH):
            if side == "f":
                out, h, c, _ = scan(p, side, x[at : at + STRETCH], h, c)
                score[at : at + STRETCH] += out @ part
            else:
                places = turned[at : at + STRETCH]
                out, h, c, _ = scan(p, side, x[places, every], h, c)
                score[places, every] += out @ part
    prob = _sigmoid(score)
    return [prob[: q.blocks, j] for j, q in enumerate(pages)]


def gradients(p: dict[str, np.ndarray], pages: list[Page], labels: list[np.ndarray], words: np.ndarray | None = None) -> tuple[float, dict[str, np.ndarray]]:
    """Mean cross entropy over the blocks of all pages, and its gradients by backpropagation through time. A page's words count with its weight."""
    words = np.ones(len(pages), np.float32) if words is None else words
    lengths = np.array([q.blocks for q in pages])
    steps, n, hidden = int(lengths.max()), len(pages), p["Uf"].shape[0]
    x, y, w = np.zeros((steps, n, PATH_DIM + WORD_DIM + SHARES), np.float32), np.zeros((steps, n), np.float32), np.zeros((steps, n), np.float32)
    for j, (q, lab) in enumerate(zip(pages, labels, strict=True)):
        x[: q.blocks, j], y[: q.blocks, j], w[: q.blocks, j] = q.inputs(p, words[j]), lab, 1.0
    w /= w.sum()
    turned, every, zero = _turned(lengths, steps), np.arange(n)[None, :], np.zeros((n, hidden), np.float32)
    forth, _, _, saved_f = scan(p, "f", x, zero, zero, True)
    back, _, _, saved_b = scan(p, "b", x[turned, every], zero, zero, True)
    states = np.concatenate([forth, back[turned, every]], axis=2)
    prob = _sigmoid(states @ p["V"] + p["v"][0])
    loss = float(-(w * np.log(np.where(y > 0.5, prob, 1 - prob) + 1e-7)).sum())
    d = (prob - y) * w
    grad = {"V": np.einsum("tb,tbh->h", d, states), "v": np.array([d.sum()], np.float32)}
    d_states, d_x = d[:, :, None] * p["V"], np.zeros_like(x)
    for side, saved, d_out in (("f", saved_f, d_states[:, :, :hidden]), ("b", saved_b, d_states[:, :, hidden:][turned, every])):
        d_pre = np.empty((steps, n, 4 * hidden), np.float32)
        dh, dc = np.zeros((n, hidden), np.float32), np.zeros((n, hidden), np.float32)
        grad[f"U{side}"] = np.zeros_like(p[f"U{side}"])
        for t in reversed(range(steps)):
            h, before, i, f, o, g, squashed = saved[t]
            dh = dh + d_out[t]
            dc = dc + dh * o * (1 - squashed * squashed)
            d_pre[t] = np.concatenate([dc * g * i * (1 - i), dc * before * f * (1 - f), dh * squashed * o * (1 - o), dc * i * (1 - g * g)], axis=1)
            grad[f"U{side}"] += h.T @ d_pre[t]
            dh, dc = d_pre[t] @ p[f"U{side}"].T, dc * f
        own = x if side == "f" else x[turned, every]
        grad[f"W{side}"] = np.einsum("tbd,tbk->dk", own, d_pre, optimize=True)
        grad[f"c{side}"] = d_pre.sum(axis=(0, 1))
        through = d_pre @ p[f"W{side}"].T
        d_x += through if side == "f" else through[turned, every]
    grad["P"], grad["Q"] = np.zeros_like(p["P"]), np.zeros_like(p["Q"])
    for j, q in enumerate(pages):
        mine = d_x[: q.blocks, j]
        for name, ids, counts, low, high, scale in (("P", q.paths, q.path_counts, 0, PATH_DIM, 1.0), ("Q", q.words, q.word_counts, PATH_DIM, PATH_DIM + WORD_DIM, words[j])):
            each = scale * mine[:, low:high] / np.sqrt(np.maximum(counts, 1))[:, None].astype(np.float32)
            np.add.at(grad[name], ids, np.repeat(each, counts, axis=0))
    return loss, grad


def fit(pages: list[Page], labels: list[np.ndarray], steps: int = STEPS, seed: int = 11) -> dict[str, np.ndarray]:
    """Parameters after so many steps of Adam, each on pages of about one length."""
    rng, p = np.random.default_rng(seed), start()
    some = [i for i, q in enumerate(pages) if q.blocks]
    order = sorted(some, key=lambda i: pages[i].blocks)
    groups = [order[a : a + BATCH] for a in range(0, len(order), BATCH)]
    if not groups:
        return p
    m1, m2 = {k: np.zeros_like(x) for k, x in p.items()}, {k: np.zeros_like(x) for k, x in p.items()}
    for step in range(1, steps + 1):
        group = groups[int(rng.integers(len(groups)))]
        # Half of the pages teach without their words, so that what no path says is learned from order and shape too.
        _, grad = gradients(p, [pages[i] for i in group], [labels[i] for i in group], (rng.random(len(group)) < 0.5).astype(np.float32))
        norm = np.sqrt(sum(float((g * g).sum()) for g in grad.values()))
        rate = RATE * min(1.0, 2 * (1 - step / (steps + 1)))
        for k, g in grad.items():
            g = g * min(1.0, 1.0 / (norm + 1e-9))
            m1[k] = 0.9 * m1[k] + 0.1 * g
            m2[k] = 0.99 * m2[k] + 0.01 * g * g
            p[k] -= (rate * (m1[k] / (1 - 0.9**step)) / (np.sqrt(m2[k] / (1 - 0.99**step)) + 1e-8)).astype(np.float32)
    return p


def invented(rng: np.random.Generator, kinds: int = 300, n: int = 2500) -> list[str]:
    """Words of random letters, some of them frequent."""
    letters, ends = "".join(rng.choice(list("abcdefghiklmnoprstuvw"), 12 * kinds)), rng.integers(2, 10, kinds)
    words = [letters[12 * i : 12 * i + int(e)] for i, e in enumerate(ends)]
    return [words[int(i)] for i in kinds * rng.random(n) ** 2]


def lessons(sampled: list[str], drawn: int = DRAWN, seed: int = 13) -> tuple[list[Page], list[np.ndarray]]:
    """Pages and labels that teach: sampled ones by their article element, and ones drawn up with the sample's words."""
    reader, buckets, pages, labels, words = Reader(), {}, [], [], []
    for page in sampled:
        leaves = reader.leaves(page)
        places, sizes = np.array([x.place for x in leaves], np.float32), np.array([len(x.text) for x in leaves])
        words += [w for x in leaves for w in x.text.split(" ")]
        low = page.lower()
        if places @ sizes > sizes.sum() / 2 and low.count("<article") + low.count("<main") == 1:
            pages.append(Page(leaves, buckets))
            labels.append(places)
    rng = np.random.default_rng(seed)
    for i in range(drawn):
        leaves, lab = [], []
        # Every other page has words of its own, so that little is learned from words that say nothing.
        for x in reader.leaves(draw(rng, words if i % 2 else invented(rng))):
            mark, text = x.text[0], x.text.replace(MARKS[0], "").replace(MARKS[1], "").strip()
            if text:
                leaves.append(x._replace(text=text))
                lab.append(float(mark == MARKS[1]))
        pages.append(Page(leaves, buckets))
        labels.append(np.array(lab, np.float32))
    return pages, labels


def train(pages: DataFrame, html: str = "html", sample: int = SAMPLE) -> dict[str, np.ndarray]:
    """A labeller from at most ``sample`` pages, chosen by hash of what they hold, and layouts that are drawn up."""
    rows = pages.select(F.col(f"`{html}`").cast("string").alias("t")).where(F.char_length("t") <= SAMPLE_CHARS)
    total = rows.count()
    near = rows.withColumn("h", F.xxhash64("t")).where(F.pmod("h", F.lit(1 << 20)) <= min(1.0, 4 * sample / max(total, 1)) * (1 << 20))
    got = near.orderBy("h", "t").limit(sample).collect()
    return fit(*lessons([r["t"] for r in got]))


def extract(p: dict[str, np.ndarray], pages: list[str | None], reader: Reader, buckets: dict[str, int]) -> list[str]:
    """Main text of each page. Pages of about one length are labelled together."""
    leaves = [reader.leaves(t) if t else [] for t in pages]
    out = [""] * len(pages)
    order = sorted((i for i, x in enumerate(leaves) if x), key=lambda i: -len(leaves[i]))
    while order:
        most = max(1, CELLS // len(leaves[order[0]]))
        group, order = order[:most], order[most:]
        for i, prob in zip(group, probabilities(p, [Page(leaves[i], buckets) for i in group]), strict=True):
            out[i] = " ".join(x.text for x, q in zip(leaves[i], prob, strict=True) if q >= MAIN)
            leaves[i] = []
    return out


def main_text(pages: DataFrame, p: dict[str, np.ndarray], html: str = "html") -> DataFrame:
    """Adds text, the page's article, and n_chars, its code points."""
    small_batches(pages.sparkSession)
    shared = pages.sparkSession.sparkContext.broadcast(p)

    @F.pandas_udf("text string, n_chars long")
    def read(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        reader, buckets = Reader(), {}
        for part in batches:
            texts: list[str] = []
            for at in range(0, len(part), 250):
                texts += extract(shared.value, part.iloc[at : at + 250].to_list(), reader, buckets)
            yield pd.DataFrame({"text": texts, "n_chars": np.array([len(t) for t in texts], np.int64)})

    (found,) = free_names(pages, "_main")
    rows = pages.withColumn(found, read(F.col(f"`{html}`").cast("string")))
    return rows.select(*columns(pages.drop("text", "n_chars")), F.col(found)["text"].alias("text"), F.col(found)["n_chars"].alias("n_chars"))


def op13_htmltext(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    p = train(pages)
    return main_text(compact(pages), p).select("page_id", "url", "text", "n_chars")
