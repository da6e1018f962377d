"""Benchmark decontamination through a positional inverted index, in DataFrame functions alone.

The terms of the benchmark are the index's vocabulary. A first pass counts them over the
whole corpus. Each benchmark window (consecutive words of an item) then orders its terms from
the rarest on, and a second pass stores the postings of the terms that are some window's rarest: document,
position and the block of indexed terms around it, written as a work table in document order. A posting meets the
windows that its term is the rarest of; each gives a start, and the lists of the other terms, from the
next rarest on, are intersected at their offsets from that start, within the block. For phrases all
offsets must agree; for proximity all terms must lie in a span of the window's length and ``slop`` words.

The corpus isn't shuffled: postings are made where a document is read, and the windows, whose number
is bounded by ``BLOCK_WORDS``, are broadcast. Larger benchmarks are matched in blocks of items.

Defined results: null texts and texts without words match nothing; items without id or words are left out, and
rows with the same item_id are one item; repeated documents are judged alike; an empty
table gives no row, an empty benchmark no match; columns of documents pass through, but ``contamination`` replaces input
columns of the names that it adds (``drop_contaminated`` adds none).
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from voxloom.llm.common import TEXT_ROWS, columns, compact, discard, free_names, look_up, materialise, table

WINDOW = 8
#: Words of a block of benchmark items at most, unless a single item has more.
BLOCK_WORDS = 200_000
#: Items with occurring windows from which on a document counts as contaminated.
ITEMS = 2
#: Columns that contamination() adds.
ADDED = ("n_words", "n_hit", "n_items", "item_ids", "contaminated")

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_BETWEEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words(text: Column) -> Column:
    """Lower-cased (A-Z) runs of letters, digits and anything beyond ASCII; null has none."""
    text = F.coalesce(text.cast("string"), F.lit(""))
    low = F.when(F.char_length(text) == F.octet_length(text), F.lower(text)).otherwise(F.translate(text, _UPPER, _LOWER))
    return F.array_remove(F.split(low, _BETWEEN), "")


def _keys(doc_id: str, text: str) -> tuple[Column, Column]:
    """Two hashes that tell rows apart, unless they are equal in both columns."""
    return F.xxhash64(F.col(f"`{doc_id}`")), F.xxhash64(F.col(f"`{text}`").cast("string"))


def windows(items: DataFrame, n: int = WINDOW) -> DataFrame:
    """(terms, item_ids): each distinct window of n words; an item of fewer is one window."""
    rows = items.where(F.col("item_id").isNotNull()).select("item_id", words(F.col("text")).alias("w")).where(F.size("w") > 0)
    starts = F.sequence(F.lit(1), F.greatest(F.size("w") - n + 1, F.lit(1)))
    each = rows.select("item_id", F.explode(F.transform(starts, lambda i: F.slice("w", i, n))).alias("terms"))
    return each.groupBy("terms").agg(F.collect_set(F.col("item_id").cast("string")).alias("item_ids"))


def _blocks(items: DataFrame) -> list[DataFrame]:
    total = items.select(F.coalesce(F.sum(F.size(words(F.col("text")))), F.lit(0))).first()[0]
    n = -(-total // BLOCK_WORDS)
    return [items] if n <= 1 else [items.where(F.pmod(F.xxhash64("item_id"), F.lit(n)) == i) for i in range(n)]


def _in(x: Column, values: list) -> Column:
    return x.isin(values) if len(values) < 11 else reduce(lambda a, b: a | b, [x.isin(values[i : i + 20_000]) for i in range(0, len(values), 20_000)])


def _code(word: Column, seed: int) -> Column:
    return F.xxhash64(word, F.lit(seed))


def coded(texts: Column, vocabulary: list[str], seed: int = 0) -> Column:
    """A text's words as hashes of those in the vocabulary, and 0 for the rest."""
    return F.transform(texts, lambda w: F.when(_in(w, vocabulary), _code(w, seed)).otherwise(F.lit(0).cast("long")))


def _coded_windows(items: DataFrame, n: int) -> tuple[DataFrame, list, int]:
    """A work table of windows with their terms' codes, the terms, and the first seed by which no two terms share a code, or have 0."""
    plain = materialise(windows(items, n).select("terms", "item_ids"), "benchmark-terms", BLOCK_WORDS)
    seed = -1
    while True:
        seed += 1
        terms = materialise(plain.withColumn("codes", F.transform("terms", lambda w: _code(w, seed))), "benchmark-windows", BLOCK_WORDS)  # noqa: B023
        known = terms.select(F.explode(F.arrays_zip("terms", "codes")).alias("x")).select("x.terms", "x.codes").distinct().collect()
        if len({r["codes"] for r in known} | {0}) == len(known) + 1:
            discard(plain)
            return terms, known, seed
        discard(terms)


def matches(docs: DataFrame, items: DataFrame, n: int = WINDOW, slop: int = 0, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(_i, _h, start, length, item_ids): where a window occurs, a work table; _i and _h name the document (see _keys)."""
    spark = docs.sparkSession
    terms, known, seed = _coded_windows(items, n)
    def nothing() -> DataFrame:
        discard(terms)
        return materialise(spark.createDataFrame([], "_i long, _h long, start int, length int, item_ids array<string>"), "matches")

    if not known:
        return nothing()
    i, h = _keys(doc_id, text)
    vocabulary = sorted(r["terms"] for r in known)
    forward = docs.select(i.alias("_i"), h.alias("_h"), coded(words(F.col(f"`{text}`")), vocabulary, seed).alias("codes"))

    # Pass 1: how often each term occurs in the corpus.
    seen = materialise(forward.select(F.explode(F.filter("codes", lambda c: c != 0)).alias("term")).groupBy("term").agg(F.count("*").alias("n")), "benchmark-terms", len(known))
    ordered = terms.select("codes", "item_ids", F.posexplode("codes").alias("at", "term")).join(seen, "term")
    plan = ordered.groupBy("codes").agg(F.first("item_ids").alias("item_ids"), F.array_sort(F.collect_list(F.struct("n", "at", "term"))).alias("plan"))
    # A window with a term that never occurs can't occur.
    plan = materialise(plan.where(F.size("plan") == F.size("codes")).withColumn("rarest", F.col("plan")[0]["term"]), "benchmark-plan", BLOCK_WORDS)
    rarest = [r["rarest"] for r in plan.select("rarest").distinct().collect()]
    if not rarest:
        discard(seen, plan)
        return nothing()

    # Pass 2: postings of the rarest terms, each with the block around it.
    reach = n + slop - 1
    here = F.filter(F.sequence(F.lit(0), F.size("codes") - 1), lambda p: _in(F.get("codes", p), rarest))
    first = lambda p: F.greatest(p - reach, F.lit(0))
    entry = lambda p: F.struct(F.get("codes", p).alias("term"), p.alias("pos"), first(p).alias("block_at"), F.slice("codes", first(p) + 1, 2 * reach + 1).alias("block"))
    postings = forward.where(F.size("codes") > 0).select("_i", "_h", F.inline(F.transform(here, entry)))
    postings = materialise(postings, "postings")

    # A posting and a window that its term is the rarest of; bounded by BLOCK_WORDS, so it may be broadcast.
    pairs = postings.join(F.broadcast(plan.withColumnRenamed("rarest", "term")), "term")
    pairs = pairs.withColumn("start", F.col("pos") - F.col("plan")[0]["at"]).withColumn("length", F.size("codes"))
    rest = F.slice("plan", 2, n)
    if slop == 0:
        found = pairs.where("start >= 0").where(F.forall(rest, lambda x: F.coalesce(F.get("block", F.col("start") + x["at"] - F.col("block_at")) == x["term"], F.lit(False))))
    else:
        span = F.col("length") + slop
        lowest = F.greatest(F.col("pos") - span + 1, F.lit(0))
        fits = lambda s: F.forall("codes", lambda c: F.array_contains(F.slice("block", s - F.col("block_at") + 1, span), c))
        at = F.filter(F.sequence(lowest, F.col("pos")), fits)
        found = pairs.withColumn("start", F.array_max(at)).where(F.col("start").isNotNull()).withColumn("length", span)
    out = materialise(found.select("_i", "_h", "start", "length", "item_ids"), "matches", postings.count())
    discard(terms, seen, plan, postings)
    return out


def _found(docs: DataFrame, items: DataFrame, n: int, slop: int, doc_id: str, text: str) -> list[DataFrame]:
    return [matches(docs, part, n, slop, doc_id, text) for part in _blocks(items)]


def contamination(docs: DataFrame, items: DataFrame, n: int = WINDOW, slop: int = 0, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Adds n_words, n_hit, n_items, item_ids (sorted strings) and contaminated to every row."""
    parts = _found(docs, items, n, slop, doc_id, text)
    found = reduce(DataFrame.unionAll, parts)
    hit = found.select("_i", "_h", F.explode(F.sequence("start", F.col("start") + F.col("length") - 1)).alias("at")).distinct()
    hit = hit.groupBy("_i", "_h").agg(F.count("*").alias("n_hit"))
    item = found.select("_i", "_h", F.explode("item_ids").alias("item")).distinct()
    item = item.groupBy("_i", "_h").agg(F.sort_array(F.collect_list("item")).alias("item_ids"))
    by_doc = materialise(hit.join(item, ["_i", "_h"]), "hits")
    discard(*parts)
    rows = docs.drop(*ADDED)
    hits, ids = free_names(rows, "_hits", "_items")
    done = look_up(rows, list(_keys(doc_id, text)), by_doc.withColumnsRenamed({"n_hit": hits, "item_ids": ids}))
    listed = F.coalesce(ids, F.array().cast("array<string>"))
    n_words = F.size(words(F.col(f"`{text}`"))).cast("long")
    added = (n_words, F.coalesce(hits, F.lit(0).cast("long")), F.size(listed).cast("long"), listed, F.size(listed) >= ITEMS)
    return done.select(*columns(rows), *[c.alias(name) for c, name in zip(added, ADDED, strict=True)])


def drop_contaminated(docs: DataFrame, items: DataFrame, n: int = WINDOW, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows in which no window of any item occurs, with their columns."""
    parts = _found(docs, items, n, 0, doc_id, text)
    hit = materialise(reduce(DataFrame.unionAll, parts).select("_i", "_h").distinct().withColumn("hit", F.lit(True)), "hits")
    discard(*parts)
    (name,) = free_names(docs, "_hit")
    return look_up(docs, list(_keys(doc_id, text)), hit.withColumnRenamed("hit", name)).where(F.col(name).isNull()).select(*columns(docs))


def op1_decontam(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hits of benchmark windows in every document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    done = contamination(docs, table(spark, sf_dir, "benchmark").select("item_id", "text"))
    return compact(done, docs.count(), TEXT_ROWS).select("doc_id", "n_words", "n_hit", "n_items", F.sha2(F.array_join("item_ids", ","), 256).alias("items_sha256"), "contaminated")


ORACLE_SQL = r"""
WITH docs AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents
), items AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark
), win AS (
  SELECT DISTINCT item_id, least(len(w), 8) AS k, array_to_string(w[s : s + 7], ' ') AS gram
  FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 7, 1) + 1)) AS s FROM items WHERE len(w) > 0)
), lengths AS (
  SELECT DISTINCT k FROM win
), word AS (
  SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS s FROM docs
), ahead AS (
  SELECT doc_id, s, list(word) OVER (PARTITION BY doc_id ORDER BY s ROWS BETWEEN CURRENT ROW AND 7 FOLLOWING) AS a FROM word
), gram AS (
  SELECT doc_id, k, s, array_to_string(a[1:k], ' ') AS gram FROM ahead, lengths WHERE len(a) >= k
), found AS (
  SELECT g.doc_id, g.s, g.k, win.item_id FROM gram g JOIN win ON g.k = win.k AND g.gram = win.gram
), hit AS (
  SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(s, s + k)) AS p FROM found) GROUP BY doc_id
), per AS (
  SELECT doc_id, count(*) AS n_items, string_agg(i, ',' ORDER BY i) AS ids FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS i FROM found) GROUP BY doc_id
)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(n_items, 0) AS BIGINT) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_items, 0) >= 2 AS contaminated
FROM docs d LEFT JOIN hit USING (doc_id) LEFT JOIN per USING (doc_id)
"""
