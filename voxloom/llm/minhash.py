"""Near duplicates by dart MinHash and banded joining.

A text is the set of its shingles of five words (lower-cased runs of letters and digits; a text of fewer
words is one shingle), each an element with a weight. Every element throws hashed darts: a
Poisson process over its weight and a rank, cut into weight cells that double, so that all
texts that hold an element see the same darts, up to its weight. A dart falls on one of K
coordinates; a text keeps the earliest dart of each. About K ln K darts are thrown a text,
however many elements it has. Two texts agree on a coordinate with the probability of their
weighted Jaccard similarity.

Coordinates are joined in bands. In a bucket, members are compared with the bucket's smallest
one, its center, by their whole shingle sets. That leaves two kinds of pairs open, which are then searched exactly: pairs of members that the
center isn't like, and pairs of a member that the center is like with one that it isn't. As 1 - similarity is a metric, the
latter need a similarity of 0.6 at least to the center. Groups in which all are linked already are skipped; large ones are dealt in pairs of blocks.
Within a group only texts that share one of their rarest shingles are compared.
Equal shingle sets are one node throughout, so that copies, however many, cost one row each.
Components of the verified links spread their smallest node, by joins, until nothing changes.

Defined results: null texts and texts without words are classes of their own; repeated rows
are copies; a null id doesn't name a class unless no other id is in it; an empty table gives no row;
other columns of the input don't matter.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from voxloom.llm.common import RESULT_ROWS, TEXT_ROWS, columns, compact, discard, free_names, materialise, sift, table
from voxloom.llm.textvec import LOWER, NOT_ALNUM, batches_of, mix, span_hashes, window_hashes, words_of

SHINGLE, SIMILAR = 5, 0.8
#: 1 - (1 - 0.8 ** 5) ** 26 of the pairs at the threshold share a band: all but 3 in 100,000.
BANDS, BAND_ROWS = 26, 5
K = BANDS * BAND_ROWS
#: Bytes of text of a block; a task of the exact search holds two.
BLOCK_BYTES = 8 << 20
#: Pairs of texts that a task compares.
TASK_TEXTS = 2000


def shingles(texts) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, np.ndarray]]:
    """(first row, rows, (text, shingle) sorted and once each, how often each occurs) of each batch of texts."""
    for at, data, ends in batches_of(texts):
        low = LOWER[data]
        s, e, word_ends = words_of(low, ends, NOT_ALNUM)
        word = span_hashes(low, s, e - s)
        first = np.concatenate(([0], word_ends[:-1]))
        count = word_ends - first
        start = np.arange(len(word))
        text = np.repeat(np.arange(len(ends)), count)
        whole = np.flatnonzero(start + SHINGLE <= word_ends[text]) if len(word) else start
        wide = window_hashes(word, SHINGLE)
        short = np.flatnonzero((count > 0) & (count < SHINGLE))
        few = np.array([mix(np.bitwise_xor.reduce(mix(word[first[i] : first[i] + count[i]] + np.arange(count[i], dtype=np.uint64)), keepdims=True))[0] for i in short], dtype=np.uint64)
        t, h = np.concatenate([text[whole], short]), np.concatenate([wide[whole], few])
        order = np.lexsort((h, t))
        t, h = t[order], h[order]
        new = np.ones(len(t), dtype=bool)
        new[1:] = (t[1:] != t[:-1]) | (h[1:] != h[:-1])
        places = np.flatnonzero(new)
        yield at, len(ends), t[places], h[places], np.diff(np.append(places, len(t)))


def sets_of(texts, weights: str = "one") -> list[np.ndarray]:
    """Each text's shingles; with weights "count" every further occurrence is an element too, so that sets have the bags' similarity."""
    out = []
    for _, n, t, h, count in shingles(texts):
        if weights == "count":
            nth = (np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)).astype(np.uint64)
            t, h = np.repeat(t, count), mix(np.repeat(h, count) + nth * np.uint64(0x9E3779B97F4A7C15))
            order = np.lexsort((h, t))
            t, h = t[order], h[order]
        cut = np.searchsorted(t, np.arange(n + 1))
        out += [h[i:j] for i, j in zip(cut, cut[1:], strict=False)]
    return out


def _uniform(h: np.ndarray) -> np.ndarray:
    return ((h >> np.uint64(11)).astype(np.float64) + 0.5) * 2.0**-53


def darts(text: np.ndarray, element: np.ndarray, weight: np.ndarray, texts: int, k: int = K) -> np.ndarray:
    """Per text and coordinate the id of its earliest dart; a text without weight has zeros."""
    out = np.zeros((texts, k), dtype=np.uint64)
    total = np.bincount(text, weights=weight, minlength=texts)
    todo, reach = np.flatnonzero(total > 0), np.log(k) + 4.0
    while len(todo):
        chosen = np.zeros(texts, dtype=bool)
        chosen[todo] = True
        limit = np.where(total > 0, k * reach / np.maximum(total, 1e-300), 0.0)
        rows = np.flatnonzero(chosen[text])
        key, rank, ident = _throw(text[rows], element[rows], weight[rows], limit, k)
        order = np.lexsort((ident, rank, key))
        key, ident = key[order], ident[order]
        first = np.ones(len(key), dtype=bool)
        first[1:] = key[1:] != key[:-1]
        out.reshape(-1)[key[first]] = ident[first]
        # Texts with an empty coordinate throw again, further; ids of darts aren't zero.
        todo = todo[(out[todo] == 0).any(axis=1)]
        reach *= 2
    return out


def _throw(text: np.ndarray, element: np.ndarray, weight: np.ndarray, limit: np.ndarray, k: int):
    """(text * k + coordinate, rank, id) of all darts up to each text's limit of rank."""
    keys, ranks, ids = [], [], []
    low, cell = 0.0, 0
    rows = np.arange(len(text))
    while len(rows):  # cells [0, 1), [1, 2), [2, 4), ... of weight
        width = max(low, 1.0)
        t, w, seed = text[rows], weight[rows], mix(element[rows] + np.uint64(cell * 0x9E3779B97F4A7C15 % (1 << 64)))
        most, rank, state = limit[t], np.zeros(len(rows)), seed
        while len(t):
            state = mix(state + np.uint64(0xD1B54A32D192ED03))
            rank = rank - np.log(_uniform(state)) / width
            go = rank <= most
            t, w, most, rank, state = t[go], w[go], most[go], rank[go], state[go]
            other = mix(state ^ np.uint64(0x8CB92BA72F3D8DD7))
            hit = np.flatnonzero(low + width * _uniform(mix(other)) < w)
            keys.append(t[hit] * k + (other[hit] % np.uint64(k)).astype(np.int64))
            ranks.append(rank[hit])
            ids.append(state[hit] | np.uint64(1))
        low, cell = low + width, cell + 1
        rows = rows[weight[rows] > low]
    return np.concatenate([*keys, np.zeros(0, np.int64)]).astype(np.int64), np.concatenate([*ranks, np.zeros(0)]), np.concatenate([*ids, np.zeros(0, np.uint64)])


def bands_of(sig: np.ndarray, rows: int = BAND_ROWS) -> np.ndarray:
    """Hash of each band, with its number."""
    parts = sig.reshape(len(sig), -1, rows)
    h = np.broadcast_to(np.arange(parts.shape[1], dtype=np.uint64), parts.shape[:2]).copy()
    for i in range(rows):
        h = mix(h * np.uint64(31) + parts[:, :, i])
    return h.astype(np.int64)


def sketch(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", weights: str = "one") -> DataFrame:
    """doc_id, text_hash, node (names the shingle set; null without words), bands. weights: "one", or "count" of a shingle."""
    kind = dict(docs.dtypes)[doc_id]

    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for at, n, t, h, count in shingles(pdf["t"]):
                weight = count.astype(np.float64) if weights == "count" else np.ones(len(t))
                band = bands_of(darts(t, h, weight, n))
                value = mix(h + np.uint64(1)) if weights == "one" else mix(mix(h + np.uint64(1)) + count.astype(np.uint64))  # names the bag
                cut = np.searchsorted(t, np.arange(n + 1))
                full = cut[1:] > cut[:-1]
                names = np.zeros((n, 2), dtype=np.uint64)
                if full.any():
                    starts = cut[:-1][full]
                    names[full, 0] = np.add.reduceat(value, starts)
                    names[full, 1] = np.add.reduceat(mix(value ^ np.uint64(0xA0761D6478BD642F)), starts)
                yield pd.DataFrame(
                    {
                        "doc_id": pdf["d"].iloc[at : at + n].to_numpy(),
                        "text_hash": pdf["h"].iloc[at : at + n].to_numpy(),
                        "node": [names[i].tobytes() if full[i] else None for i in range(n)],
                        "bands": [band[i] if full[i] else None for i in range(n)],
                    }
                )

    t = F.col(f"`{text}`").cast("string")
    cols = docs.select(F.col(f"`{doc_id}`").alias("d"), F.xxhash64(t).alias("h"), t.alias("t"))
    return cols.mapInPandas(rows, f"doc_id {kind}, text_hash long, node binary, bands array<long>")


def _similar(pairs: DataFrame, texts: DataFrame, weights: str) -> DataFrame:
    """Adds ``sim``, the similarity of the whole shingle sets of node and center, and ``ok`` where it suffices."""

    @F.pandas_udf("double")
    def sim(a: pd.Series, b: pd.Series) -> pd.Series:
        out = np.zeros(len(a))
        for i, (x, y) in enumerate(zip(sets_of(a, weights), sets_of(b, weights), strict=True)):
            common = len(np.intersect1d(x, y, assume_unique=True))
            out[i] = common / max(len(x) + len(y) - common, 1)
        return pd.Series(out)

    left = texts.select("node", F.col("text").alias("text_a"))
    right = texts.select(F.col("node").alias("center"), F.col("text").alias("text_b"))
    judged = pairs.join(left.hint("merge"), "node").join(right.hint("merge"), "center")
    return judged.select("node", "center", sim("text_a", "text_b").alias("sim")).withColumn("ok", F.col("sim") >= SIMILAR - 1e-9)


def links_within(sets: list[np.ndarray], label: list) -> list[tuple[int, int]]:
    """Links between sets that connect all whose similarity suffices, beyond what labels connect.

    Similar sets share one of their rarest elements, whichever fifth of them that is; only sets that do are compared.
    """
    n = np.array([len(x) for x in sets])
    text = np.repeat(np.arange(len(sets)), n)
    _, rank, count = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    rank = np.argsort(np.argsort(count, kind="stable"))[rank]
    order = np.lexsort((rank, text))
    rank, start = rank[order], np.concatenate(([0], np.cumsum(n)))
    prefix = n - np.ceil(SIMILAR * n - 1e-6).astype(np.int64) + 1
    rare = np.flatnonzero(np.arange(len(rank)) - start[text] < prefix[text])
    rare = rare[np.argsort(rank[rare], kind="stable")]
    place = np.searchsorted(rank[rare], np.arange(len(count) + 1))
    holder = text[rare]
    alive, mark, out = np.ones(len(sets), dtype=bool), np.zeros(len(count), dtype=bool), []
    group: dict = {}
    for i, x in enumerate(label):
        group.setdefault(x, []).append(i)
    for first in group.values():
        if not alive[first[0]]:
            continue
        alive[first] = False
        todo = list(first)
        while todo:
            y = todo.pop()
            own = rank[start[y] : start[y + 1]]
            near = np.unique(np.concatenate([holder[place[r] : place[r + 1]] for r in own[: prefix[y]]]))
            near = near[alive[near] & (np.minimum(n[near], n[y]) >= SIMILAR * np.maximum(n[near], n[y]) - 1e-6)]
            mark[own] = True
            for x in near:
                if alive[x]:
                    common = int(mark[rank[start[x] : start[x + 1]]].sum())
                    if common / (n[x] + n[y] - common) >= SIMILAR - 1e-9:
                        out.append((y, x))
                        alive[group[label[x]]] = False
                        todo += group[label[x]]
            mark[own] = False
    return out


def _rest(groups: DataFrame, found: DataFrame, texts: DataFrame, weights: str, rows: int) -> DataFrame:
    """(node, center) of the links that connect members of each group (group, node) beyond those found."""
    # What is linked to the same center is connected already.
    label = found.groupBy(F.col("node").alias("_n")).agg(F.min("center").alias("label"))
    named = groups.join(label.hint("merge"), F.col("node") == F.col("_n"), "left").select("group", "node", F.coalesce("label", "node").alias("label"))
    named = materialise(named, "near-groups", rows)
    # Groups of the same members are searched once.
    kept = named.groupBy("group").agg(F.count("*").alias("n"), F.min("label").alias("low"), F.max("label").alias("high"), F.bit_xor(F.xxhash64("node")).alias("x"), F.bit_xor(F.xxhash64("node", F.lit(1))).alias("y"))
    kept = kept.where("low <> high").groupBy("n", "x", "y").agg(F.min("group").alias("group")).select("group")
    members = materialise(named.join(kept.hint("merge"), "group").join(texts.select("node", "size").hint("merge"), "node"), "near-members", rows)
    discard(named)
    blocks = members.groupBy("group").agg(F.ceil(F.sum("size") / BLOCK_BYTES).alias("g"))
    cell = F.when(F.col("g") <= 1, F.array(F.struct(F.lit(0).cast("long").alias("i"), F.lit(0).cast("long").alias("j")))).otherwise(
        F.transform(F.filter(F.sequence(F.lit(0).cast("long"), F.col("g") - 1), lambda o: o != F.col("b")), lambda o: F.struct(F.least("b", o).alias("i"), F.greatest("b", o).alias("j")))
    )
    dealt = members.join(blocks, "group").withColumn("b", F.pmod(F.xxhash64("node"), F.greatest("g", F.lit(1)))).select("group", "node", "label", F.inline(cell))

    def one(pdf: pd.DataFrame) -> pd.DataFrame:
        node = pdf["node"].to_list()
        return pd.DataFrame([(node[y], node[x]) for y, x in links_within(sets_of(pdf["text"], weights), pdf["label"].to_list())], columns=["node", "center"])

    out = materialise(dealt.join(texts.select("node", "text").hint("merge"), "node").groupBy("group", "i", "j").applyInPandas(one, "node binary, center binary"), "near-rest", members.count(), TASK_TEXTS)
    discard(members)
    return out


def _texts(docs: DataFrame, named: DataFrame, doc_id: str, text: str) -> DataFrame:
    """(node, text, size) of the rows that (node, id_hash, text_hash) names; the key filter keeps other rows' texts from moving."""
    t = F.col(f"`{text}`").cast("string")
    whole = docs.select(F.xxhash64(F.col(f"`{doc_id}`")).alias("id_hash"), F.xxhash64(t).alias("text_hash"), t.alias("text"))
    near = sift(whole, F.xxhash64("id_hash", "text_hash"), named.select(F.xxhash64("id_hash", "text_hash").alias("k")), "maybe").where("maybe")
    # One text a node; rows with both hashes equal are copies.
    once = near.groupBy("id_hash", "text_hash").agg(F.first("text").alias("text"))
    return once.join(named.hint("merge"), ["id_hash", "text_hash"]).select("node", "text", F.octet_length("text").alias("size"))


def links(docs: DataFrame, sk: DataFrame, doc_id: str = "doc_id", text: str = "text", weights: str = "one") -> DataFrame:
    """(node, center) of verified links between different shingle sets: all that a shared band suggests, or others that connect the same."""
    key = F.struct(F.xxhash64("doc_id").alias("id_hash"), "text_hash")
    nodes = sk.where("node is not null").groupBy("node").agg(F.first("bands").alias("bands"), F.min(key).alias("key"))
    buckets = nodes.select("node", F.explode("bands").alias("band"))
    center = buckets.groupBy("band").agg(F.min("node").alias("center"), F.count("*").alias("n")).where("n > 1").drop("n")
    rows = materialise(buckets.join(center.hint("merge"), "band").where("node <> center"), "near-buckets", BANDS * sk.count())
    n = rows.count()
    ends = rows.select("node").union(rows.select("center")).distinct()
    named = materialise(ends.join(nodes.select("node", "key.*").hint("merge"), "node"), "near-nodes", 2 * n)
    texts = materialise(_texts(docs, named, doc_id, text), "near-texts", named.count(), 5 * TASK_TEXTS)
    discard(named)
    judged = materialise(_similar(rows.select("node", "center").distinct(), texts, weights), "near-judged", n, TASK_TEXTS)
    found = judged.where("ok").select("node", "center")
    # A node that isn't like the center can only be like one that is if both distances to it differ by no more than that of a link.
    close = judged.where(~F.col("ok") & (F.col("sim") >= 2 * SIMILAR - 1 - 1e-9))
    top = close.groupBy("center").agg(F.max("sim").alias("top"))
    inner = judged.where("ok").join(top.hint("merge"), "center").where(F.col("sim") <= F.col("top") + (1 - SIMILAR) + 1e-9)
    by_center = inner.select("center", "node").union(close.select("center", "node")).select(F.concat(F.lit("c"), F.hex("center")).alias("group"), "node")
    # Members that the center wasn't like: each bucket's are a group.
    rest = rows.join(judged.where("not ok").select("node", "center").hint("merge"), ["node", "center"], "left_semi").select("band", "node")
    some = rest.groupBy("band").agg(F.count("*").alias("n")).where("n > 1").drop("n")
    by_band = rest.join(some.hint("merge"), "band").select(F.concat(F.lit("b"), F.col("band").cast("string")).alias("group"), "node")
    more = _rest(by_center.union(by_band), found, texts, weights, 3 * n)
    out = materialise(found.union(more), "near-links", n)
    discard(texts, rows, judged, more)
    return out


def components(edges: DataFrame) -> DataFrame:
    """(node, label): the smallest node that each reaches; only nodes with a link. A work table."""
    n = 2 * edges.count()
    both = materialise(edges.select("node", "center").union(edges.select("center", "node")).toDF("src", "dst"), "near-edges", n)
    label = materialise(both.groupBy(F.col("src").alias("node")).agg(F.least(F.min("dst"), F.first("src")).alias("label")), "near-labels", n)
    while True:
        seen = both.join(label.select(F.col("node").alias("dst"), "label"), "dst").groupBy(F.col("src").alias("node")).agg(F.min("label").alias("near"))
        down = label.join(seen, "node").select("node", F.col("label").alias("old"), F.least("label", "near").alias("label"))
        up = label.select(F.col("node").alias("label"), F.col("label").alias("above"))
        new = materialise(down.join(up, "label", "left").select("node", "old", F.least("label", "above").alias("label")), "near-labels", n)
        discard(label)
        label = new
        if new.where("old <> label").isEmpty():
            discard(both)
            return _only(label, "node", "label")


def _only(work: DataFrame, *names: str) -> DataFrame:
    """Some columns of a work table, still one to discard."""
    out = work.select(*names)
    out.work_path = work.work_path
    return out


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", weights: str = "one") -> DataFrame:
    """doc_id, text_hash, class_id (the smallest id in the class) and class (null without words), for every row.

    Ids that several texts have may name several classes; ``class`` tells them apart.
    """
    sk = materialise(sketch(docs, doc_id, text, weights), "near-sketch")
    found = links(docs, sk, doc_id, text, weights)
    label = components(found)
    slim = materialise(sk.drop("bands"), "near-rows")
    discard(sk, found)
    ids = slim.where("node is not null").groupBy("node").agg(F.min("doc_id").alias("least"))
    of = ids.join(label.hint("merge"), "node", "left").select("node", F.coalesce("label", "node").alias("label"), "least")
    of = materialise(of, "near-classes", slim.count())
    discard(label)
    named = of.groupBy("label").agg(F.min("least").alias("class_id"))
    classes = of.join(named, "label").select("node", "class_id", F.col("label").alias("class"))
    done = slim.select("doc_id", "text_hash", "node").join(classes.hint("merge"), "node", "left")
    return compact(done, slim.count(), RESULT_ROWS).select("doc_id", "text_hash", F.when(F.col("node").isNull(), F.col("doc_id")).otherwise(F.col("class_id")).alias("class_id"), "class")


def keep_one(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", weights: str = "one") -> DataFrame:
    """One row of each class, with the columns of docs: that with the smallest id (of several of that id, the smallest hash of the text).

    Rows without words are told apart by id and text. Only rows that may have to go, or are there twice, are shuffled.
    """
    classes = near_duplicates(docs, doc_id, text, weights)
    named = materialise(classes.select(F.xxhash64("doc_id").alias("i"), F.col("text_hash").alias("h"), "class", F.col("doc_id").eqNullSafe(F.col("class_id")).alias("first")), "near-named")
    total = named.count()
    best = named.where("first and class is not null").groupBy("class").agg(F.min(F.struct("i", "h")).alias("best")).withColumnRenamed("class", "of")
    times = named.groupBy("class", "i", "h").agg(F.count("*").alias("n"))
    judged = times.join(best.hint("merge"), F.col("class") == F.col("of"), "left").select("i", "h", "n", (F.col("class").isNull() | (F.struct("i", "h") == F.col("best"))).alias("keep"))
    out = materialise(judged.where("n > 1 or not coalesce(keep, false)").select("i", "h", F.coalesce("keep", F.lit(False)).alias("keep")), "near-gone", total)
    discard(named)
    i, h, maybe, i2, h2, keep = free_names(docs, "_i", "_h", "_maybe", "_i2", "_h2", "_keep")
    own = columns(docs)
    hashed = docs.select(*own, F.xxhash64(F.col(f"`{doc_id}`")).alias(i), F.xxhash64(F.col(f"`{text}`").cast("string")).alias(h))
    sifted = sift(hashed, F.xxhash64(i, h), out.select(F.xxhash64("i", "h").alias("k")), maybe)
    sure = sifted.where(~F.col(maybe)).select(*own)
    gone = out.select(F.col("i").alias(i2), F.col("h").alias(h2), F.col("keep").alias(keep)).hint("merge")
    unsure = sifted.where(maybe).join(gone, (F.col(i) == F.col(i2)) & (F.col(h) == F.col(h2)), "left").where(F.coalesce(F.col(keep), F.lit(True)))
    return compact(sure.unionAll(unsure.dropDuplicates([i, h]).select(*own)), total, TEXT_ROWS)


def op6_neardup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Class of every document."""
    return near_duplicates(table(spark, sf_dir, "documents").select("doc_id", "text")).select("doc_id", "class_id")
