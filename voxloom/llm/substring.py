"""Substring dedup by suffix automata: word spans that occur elsewhere are removed.

``remove_known`` takes a reference of bounded size: its texts become suffix automata, one a
shard, which are broadcast; documents stream through them for matching statistics (how many
words up to here occur in the reference), and maximal spans of at least ``length`` words go.

``remove_repeats`` takes the corpus as its own reference. Automata of the whole corpus have no
bounded size, so instead of broadcasting them, shards are made so that a window meets all windows that can
equal it: every window of ``length`` words is routed by its smallest hash of ``GRAM`` words; consecutive
windows with the same one travel as one segment. Routes that occur once are dropped before any text
moves. Each shard of segments becomes an automaton with occurrence counts, through which its segments stream
for matching statistics: how many words up to here occur at least twice. Maximal spans of at least ``length`` words go. Routes of more than
``HOT`` segments or ``HOT_WINDOWS`` windows are split by the windows' own hashes and equal windows are summed first, so that no
shard grows with one frequent passage or with one text that repeats a word. Copies of a text are one text with a count.

Words are compared as bytes, hashes only route, so the result is exact, but for texts that share a 128-bit hash.

Defined results: words are runs of all but ASCII white space; null texts have none; texts shorter
than a window are kept whole; repeated rows repeat each other; an empty table gives no row;
columns of documents pass through, but those of the names that are added are replaced.
"""

from __future__ import annotations

import gc
import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from numpy.lib.stride_tricks import sliding_window_view
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from voxloom.llm.common import FILE_ROWS, columns, compact, discard, free_names, look_up, materialise, table
from voxloom.llm.textvec import SPACES, batches_of, mix, span_hashes, window_hashes, words_of

LENGTH, GRAM = 35, 8
#: Segments, and windows, from which on a route is split: no automaton holds more.
HOT, HOT_WINDOWS = 8000, 200_000
#: Columns that are added.
ADDED = ("n_words", "n_removed", "kept_text")
#: Texts that a task cuts, and whose counts and digests it writes at most.
TASK_TEXTS, RESULT_TEXTS = 4000, 10_000
#: Rows that a Python worker gives back at a time.
BATCH = 5000
#: Words of a reference that may be broadcast, and of each of its shards.
REFERENCE_WORDS, SHARD_WORDS = 2_000_000, 200_000


class Automaton:
    """A generalised suffix automaton over sequences of words, with weighted occurrence counts.

    Most states have one transition, which two lists hold; dictionaries are for those that branch.
    """

    def __init__(self) -> None:
        self.word: list = [None]  # the word of a state's first transition
        self.goal: list[int] = [0]  # where that leads
        self.more: dict[int, dict] = {}  # further transitions
        self.link, self.len, self.seen = [-1], [0], [0]

    def step(self, v: int, c):
        """Where v's transition by c leads, or None."""
        if self.word[v] == c:
            return self.goal[v]
        more = self.more.get(v)
        return more.get(c) if more is not None else None

    def _set(self, v: int, c, q: int) -> None:
        if self.word[v] is None or self.word[v] == c:
            self.word[v], self.goal[v] = c, q
        else:
            self.more.setdefault(v, {})[c] = q

    def _state(self, length: int, link: int) -> int:
        self.word.append(None)
        self.goal.append(0)
        self.len.append(length)
        self.link.append(link)
        self.seen.append(0)
        return len(self.len) - 1

    def _split(self, p: int, q: int, c) -> int:
        """A state for the part of q that p's extension by c reaches."""
        if self.len[p] + 1 == self.len[q]:
            return q
        new = self._state(self.len[p] + 1, self.link[q])
        self.word[new], self.goal[new] = self.word[q], self.goal[q]
        if q in self.more:
            self.more[new] = dict(self.more[q])
        self.link[q] = new
        while p >= 0 and self.step(p, c) == q:
            self._set(p, c, new)
            p = self.link[p]
        return new

    def add(self, words, weight: int = 1) -> None:
        last, seen, link, size, step = 0, self.seen, self.link, self.len, self.step
        for c in words:
            q = step(last, c)
            if q is not None:
                last = q if size[last] + 1 == size[q] else self._split(last, q, c)
            else:
                p, new = last, self._state(size[last] + 1, 0)
                while p >= 0 and (q := step(p, c)) is None:
                    self._set(p, c, new)
                    p = link[p]
                if p >= 0:
                    link[new] = self._split(p, q, c)
                last = new
            seen[last] += weight

    def count(self) -> None:
        """Sums occurrences over the suffix links; once, after the last text."""
        seen, link = self.seen, self.link
        for v in sorted(range(1, len(self.len)), key=self.len.__getitem__, reverse=True):
            seen[link[v]] += seen[v]

    def statistics(self, words, least: int = 1) -> Iterator[int]:
        """Matching statistics: at each word, how many words up to it occur in the texts, ``least`` times or more (needs count())."""
        v = n = 0
        step, link, size, seen = self.step, self.link, self.len, self.seen
        for c in words:
            while (q := step(v, c)) is None or (least > 1 and seen[q] < least):
                if not v:
                    break
                v = link[v]
                n = size[v]
            else:
                v, n = q, n + 1
            yield n


def spans(statistics: Iterator[int], length: int) -> list[tuple[int, int]]:
    """Maximal spans [from, to) that matches of at least ``length`` words cover."""
    out: list[list[int]] = []
    for i, n in enumerate(statistics):
        if n >= length:
            if out and i - n + 1 <= out[-1][1]:
                out[-1][1] = i + 1
            else:
                out.append([i - n + 1, i + 1])
    return [(a, b) for a, b in out]


def runs(texts, length: int = LENGTH, gram: int = GRAM) -> Iterator[tuple[int | np.ndarray, ...]]:
    """(first row, text, route, first window, windows, more) of runs of windows with the same smallest gram; more: it is there twice."""
    gram = min(gram, length)
    wide = length - gram + 1
    for at, data, ends in batches_of(texts):
        s, e, word_ends = words_of(data, ends, SPACES)
        first = np.concatenate(([0], word_ends[:-1]))
        n = np.maximum(word_ends - first - length + 1, 0)
        if not n.sum():
            continue
        text = np.repeat(np.arange(len(ends)), n)
        place = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        grams = sliding_window_view(window_hashes(span_hashes(data, s, e - s), gram), wide)
        least = grams.min(axis=1)[first[text] + place]
        new = np.ones(len(text), dtype=bool)
        new[1:] = (least[1:] != least[:-1]) | (text[1:] != text[:-1])
        p = np.flatnonzero(new)
        n = np.diff(np.append(p, len(text)))
        begin = first[text[p]] + place[p]
        left, right = begin + grams[begin].argmin(axis=1), begin + n + wide - 2 - grams[begin + n - 1, ::-1].argmin(axis=1)
        yield at, text[p], mix(least[p]).astype(np.int64), place[p], n, left != right


def _groups(batches: Iterator[pd.DataFrame]) -> Iterator[tuple[int, list]]:
    """Rows of each route, of batches in its order."""
    route, rows = None, []
    for pdf in batches:
        for r in pdf.itertuples(index=False):
            if r.route != route:
                if rows:
                    yield route, rows
                route, rows = r.route, []
            rows.append(r)
    if rows:
        yield route, rows


def repeats(segments: dict[bytes, int], length: int) -> dict[bytes, list[tuple[int, int]]]:
    """Spans of each segment (words joined by a space, how often) that windows cover which occur twice among all."""
    words = {p: p.split() for p in segments}
    if len(segments) == 1:
        ((p, n),) = segments.items()
        if n >= 2 or len(words[p]) <= length:  # all of its windows, or its one window, alone
            return {p: [(0, len(words[p]))] if n >= 2 else []}
    automaton = Automaton()
    for p, n in segments.items():
        automaton.add(words[p], n)
    automaton.count()
    return {p: spans(automaton.statistics(w, least=2), length) for p, w in words.items()}


def repeated_spans(docs: DataFrame, length: int = LENGTH, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, spans): for each text (key is its MD5), the word spans that windows cover which start elsewhere too."""
    t = F.coalesce(F.col(f"`{text}`").cast("string"), F.lit(""))
    rows = docs.select(F.col(f"`{doc_id}`").alias("id"), F.unhex(F.md5(t)).alias("key"), t.alias("t"))

    def cut_runs(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            keys = pdf["key"].to_numpy()
            for at, text_, route, start, n, more in runs(pdf["t"], length):
                yield pd.DataFrame({"key": keys[at + text_], "route": route, "start": start.astype(np.int32), "n": n.astype(np.int32), "more": more})

    found = materialise(rows.select("key", "t").mapInPandas(cut_runs, "key binary, route long, start int, n int, more boolean"), "runs")
    seen = found.groupBy("route").agg(F.sum(1 + F.col("more").cast("int")).alias("seen"), F.sum("n").alias("windows")).where("seen > 1")
    hot = ((F.col("seen") > HOT) | (F.col("windows") > HOT_WINDOWS)).alias("hot")
    again = found.join(seen.hint("merge"), "route").groupBy("key").agg(F.collect_set(F.struct("route", "start", "n", hot)).alias("runs"))
    one = rows.groupBy("key").agg(F.min(F.xxhash64("id")).alias("id"), F.count("*").alias("copies"))
    # Each file forks its executor, so tables have no more of them than their own rows need: at most a row a text.
    again = materialise(again.join(one.hint("merge"), "key").select("key", "id", "copies", "runs"), "repeated-runs", found.count(), 4 * FILE_ROWS)
    n_texts = again.count()
    discard(found)
    texts = look_up(rows, [F.col("key"), F.xxhash64("id")], again.select("key", "id", F.col("copies").alias("times"), "runs")).where(F.col("runs").isNotNull())
    texts = texts.select("key", F.col("times").alias("copies"), "runs", "t")

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names = ("route", "hot", "key", "start", "weight", "payload")
        for pdf in batches:
            out = []
            for key, copies, own, body in zip(pdf["key"], pdf["copies"], pdf["runs"], pdf["t"], strict=True):
                words = body.encode("utf-8", "replace").split()
                for r in own:
                    if r["hot"]:
                        for s in range(r["start"], r["start"] + r["n"]):
                            payload = b" ".join(words[s : s + length])
                            out.append((int.from_bytes(hashlib.blake2b(payload, digest_size=8).digest(), "little", signed=True), True, key, s, copies, payload))
                    else:
                        out.append((r["route"], False, key, r["start"], copies, b" ".join(words[r["start"] : r["start"] + r["n"] + length - 1])))
                if len(out) > BATCH:
                    yield pd.DataFrame(out, columns=names)
                    out = []
            yield pd.DataFrame(out, columns=names)

    # Repeated rows of one text and id would be cut once each; they are one text.
    segments = materialise(texts.mapInPandas(cut, "route long, hot boolean, key binary, start int, weight long, payload binary"), "segments", n_texts, TASK_TEXTS)

    def match(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        gc.disable()  # automata have no cycles
        out: list[tuple] = []
        for _, group in _groups(batches):
            weight: dict[bytes, int] = {}
            places: dict[tuple, int] = {}
            for r in group:
                places[(r.key, r.start, r.payload)] = r.weight
            for (_, _, p), n in places.items():
                weight[p] = weight.get(p, 0) + n
            got = repeats(weight, length)
            out += [(key, start + a, start + b) for key, start, p in places for a, b in got[p]]
            if len(out) > BATCH:
                yield pd.DataFrame(out, columns=("key", "from", "to"))
                out = []
        yield pd.DataFrame(out, columns=("key", "from", "to"))

    def frequent(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        out: list[tuple] = []
        for route, group in _groups(batches):
            got = repeats({r.payload: r.weight for r in group}, length)
            out += [(route, p) for p, s in got.items() if s]
            if len(out) > BATCH:
                yield pd.DataFrame(out, columns=("route", "payload"))
                out = []
        yield pd.DataFrame(out, columns=("route", "payload"))

    cold = segments.where("not hot").select("route", "key", "start", "weight", "payload").repartition("route").sortWithinPartitions("route")
    hot = segments.where("hot")
    windows = hot.select("route", "payload", "key", "start", "weight").distinct().groupBy("route", "payload").agg(F.sum("weight").alias("weight"))
    twice = windows.repartition("route").sortWithinPartitions("route").mapInPandas(frequent, "route long, payload binary")
    hot_spans = hot.join(twice, ["route", "payload"]).select("key", F.col("start").alias("from"), (F.col("start") + length).alias("to"))
    every = cold.mapInPandas(match, "key binary, from int, to int").unionByName(hot_spans)
    out = materialise(every.groupBy("key").agg(F.collect_set(F.struct("from", "to")).alias("spans")), "repeated-spans", n_texts, 5 * TASK_TEXTS)
    discard(again, segments)
    return out


def _without(docs: DataFrame, spans_of, extra: list[str], text: str) -> DataFrame:
    """Replaces the extra columns by n_words, n_removed and kept_text, by a function from words and the extra columns to spans."""

    def clean(batches: Iterator[tuple]) -> Iterator[pd.DataFrame]:
        for texts, *more in batches:
            out = []
            for i, body in enumerate(texts):
                words = (body or "").encode("utf-8", "replace").split()
                gone = np.zeros(len(words) + 1, dtype=np.int64)
                for a, b in spans_of(words, *(m.iloc[i] for m in more)):
                    gone[a] += 1
                    gone[b] -= 1
                away = np.cumsum(gone)[:-1] > 0
                kept = b" ".join(w for w, x in zip(words, away, strict=True) if not x)
                out.append((len(words), int(away.sum()), kept.decode()))
            yield pd.DataFrame(out, columns=ADDED)

    cleaned = F.pandas_udf(_one_or_more(clean, bool(extra)), "n_words long, n_removed long, kept_text string")
    (c,) = free_names(docs, "_clean")
    rows = docs.withColumn(c, cleaned(F.col(f"`{text}`").cast("string"), *extra))
    return rows.select(*columns(docs.drop(*ADDED, *extra)), *[F.col(f"`{c}`.{x}").alias(x) for x in ADDED])


def _one_or_more(f, many: bool):
    """The iterator form of a function over tuples of columns that pandas_udf can tell by its hints."""
    if many:

        def columns(batches: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.DataFrame]:
            return f(batches)

        return columns

    def column(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        return f((x,) for x in batches)

    return column


def remove_repeats(docs: DataFrame, length: int = LENGTH, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Adds n_words, n_removed and kept_text (kept words joined by a space)."""
    (name,) = free_names(docs, "_spans")
    ends = F.flatten(F.transform("spans", lambda x: F.array(x["from"], x["to"])))
    known = repeated_spans(docs, length, doc_id, text)
    key = F.unhex(F.md5(F.coalesce(F.col(f"`{text}`").cast("string"), F.lit(""))))
    rows = look_up(docs, [key], known.select("key", ends.alias(name)))
    rows = rows.withColumn(name, F.coalesce(name, F.array().cast("array<int>")))
    return _without(rows, lambda words, flat: zip(flat[0::2], flat[1::2], strict=True), [name], text)


def remove_known(docs: DataFrame, reference: DataFrame, length: int = LENGTH, text: str = "text") -> DataFrame:
    """Adds n_words, n_removed and kept_text: spans of at least ``length`` words that the reference has are removed.

    The reference may have ``REFERENCE_WORDS`` words; larger ones are refused.
    """
    t = F.coalesce(F.col(f"`{text}`").cast("string"), F.lit(""))
    size = reference.select(F.coalesce(F.sum(F.regexp_count(t, F.lit(r"[^\x20\x09-\x0D]+"))), F.lit(0))).first()[0]
    if size > REFERENCE_WORDS:
        raise ValueError(f"the reference has {size} words; at most {REFERENCE_WORDS} are broadcast")
    shards, room = [], 0
    for row in reference.select(t.alias("t")).distinct().orderBy("t").toLocalIterator():
        words = row["t"].encode("utf-8", "replace").split()
        if not shards or room < len(words):
            shards.append(Automaton())
            room = max(SHARD_WORDS, len(words))
        shards[-1].add(words)
        room -= len(words)
    shared = docs.sparkSession.sparkContext.broadcast([(a.word, a.goal, a.more, a.link, a.len) for a in shards])

    def known(words) -> list[tuple[int, int]]:
        out = []
        for parts in shared.value:
            a = Automaton()
            a.word, a.goal, a.more, a.link, a.len = parts
            out += spans(a.statistics(words), length)
        return out

    return _without(docs, known, [], text)


def result_texts(n: int, cores: int) -> int:
    """Texts of a task of the result: RESULT_TEXTS, or fewer so that each core gets two tasks, but no fewer than TASK_TEXTS."""
    return max(TASK_TEXTS, min(RESULT_TEXTS, n // (2 * cores)))


def op2_substring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words left of every document, without those that repeated windows cover."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    n = docs.count()
    return compact(remove_repeats(docs), n, result_texts(n, spark.sparkContext.defaultParallelism)).select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept_text"), 256).alias("kept_sha256"))


#: Windows are told apart by their whole word sequence.
ORACLE_SQL = r"""
WITH docs AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents
), word AS (
  SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS p FROM docs
), win AS (
  SELECT doc_id, p, list(word) OVER (PARTITION BY doc_id ORDER BY p ROWS BETWEEN CURRENT ROW AND 34 FOLLOWING) AS a FROM word
), key AS (
  SELECT doc_id, p, md5(array_to_string(a, ' ')) AS k FROM win WHERE len(a) = 35
), twice AS (
  SELECT k FROM key GROUP BY k HAVING count(*) > 1
), start AS (
  SELECT doc_id, p FROM key SEMI JOIN twice USING (k)
), marked AS (
  SELECT word.doc_id, word.p, word.word, max(start.p) OVER (PARTITION BY word.doc_id ORDER BY word.p ROWS BETWEEN 34 PRECEDING AND CURRENT ROW) IS NOT NULL AS gone
  FROM word LEFT JOIN start ON word.doc_id = start.doc_id AND word.p = start.p
), done AS (
  SELECT doc_id, count(*) AS n_words, count(*) FILTER (WHERE gone) AS n_removed, string_agg(word, ' ' ORDER BY p) FILTER (WHERE NOT gone) AS kept FROM marked GROUP BY doc_id
)
SELECT d.doc_id, CAST(coalesce(n_words, 0) AS BIGINT) AS n_words, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM docs d LEFT JOIN done USING (doc_id)
"""
