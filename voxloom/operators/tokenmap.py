"""Entities of a transcript in the time of recognised words that aren't the same ones.

``times`` goes two ways. One maps the transcript's tokens onto words: runs that are unique on both sides are anchors, the longest increasing run of anchors holds, what lies between
is mapped in the same way by shorter runs, and what is left between equal tokens stands for each other in order. The other looks for an entity's tokens, digits spoken one by one,
as a run of words, wherever they are said. Segments bound the arrays that both work on.
"""

from __future__ import annotations

import json
import re
from bisect import bisect_left, bisect_right
from collections import Counter

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from voxloom.functions import columns as C

#: Padding and least duration of the two ways, and the words of digits.
MAP_PAD, SEARCH_PAD, LEAST = 0.06, 0.08, 0.25
DIGITS = ("zero", "one", "two", "three", "four", "five", "six", "seven", "eight", "nine")
RUNS = (4, 2, 1)


def norm(word: Column) -> Column:
    """A word's lower-case letters and digits."""
    return F.regexp_replace(F.lower(word), r"[^\p{L}\p{N}]+", "")


def _anchors(a: list[str], b: list[str], n: int) -> list[tuple[int, int]]:
    """Places of runs of n tokens that are once in each, the longest increasing run of them."""
    runs = [[tuple(x[i : i + n]) for i in range(len(x) - n + 1)] for x in (a, b)]
    once = [Counter(r) for r in runs]
    at = {r: j for j, r in enumerate(runs[1]) if once[1][r] == 1}
    pairs = [(i, at[r]) for i, r in enumerate(runs[0]) if once[0][r] == 1 and r in at]
    ends: list[int] = []  # the last b of the best increasing run of each length
    back: list[tuple[int, int]] = []  # of each pair: its length, the pair before it
    last: list[int] = []
    for k, (_, j) in enumerate(pairs):
        p = bisect_left(ends, j)
        back.append((p, last[p - 1] if p else -1))
        ends[p : p + 1], last[p : p + 1] = [j], [k]
    out, k = [], last[-1] if last else -1
    while k >= 0:
        out.append(pairs[k])
        k = back[k][1]
    return out[::-1]


def token_map(a: list[str], b: list[str]) -> list[int | None]:
    """Place in b of each token of a, increasing; None for those that nothing stands for."""
    out: list[int | None] = [None] * len(a)
    todo = [(0, len(a), 0, len(b), 0)]
    while todo:
        i, i2, j, j2, level = todo.pop()
        # What begins and ends alike is mapped first.
        while i < i2 and j < j2 and a[i] == b[j]:
            out[i] = j
            i, j = i + 1, j + 1
        while i < i2 and j < j2 and a[i2 - 1] == b[j2 - 1]:
            i2, j2 = i2 - 1, j2 - 1
            out[i2] = j2
        if i == i2 or j == j2:
            continue
        if level == len(RUNS):
            for k in range(min(i2 - i, j2 - j)):
                out[i + k] = j + k
            continue
        n = RUNS[level]
        held = [(x + i, y + j) for x, y in _anchors(a[i:i2], b[j:j2], n)]
        x0, y0 = i, j
        for x, y in held:
            if x >= x0 and y >= y0:
                todo.append((x0, x, y0, y, level + 1))
                for k in range(n):
                    out[x + k] = y + k
                x0, y0 = x + n, y + n
        todo.append((x0, i2, y0, j2, level + 1))
    return out


def span_words(tokens: list[str], begins: list[int], ends: list[int], words: list[str], starts: list[int], stops: list[int]) -> list[list[int] | None]:
    """Of each span [start, stop) the places of the words that its tokens, which are in order, stand for: None for none."""
    held = [(i, j) for i, j in enumerate(token_map(tokens, words)) if j is not None]
    first, last = [begins[i] for i, _ in held], [ends[i] for i, _ in held]
    out: list[list[int] | None] = []
    for a, b in zip(starts, stops, strict=True):
        # An empty span within a token meets it, as in the comparison of their ends.
        got = [j for _, j in held[bisect_right(last, a) : bisect_left(first, b)]]
        out.append(got or None)
    return out


def run_places(words: list[str], said: list[list[str]]) -> list[list[int]]:
    """Of each list of tokens the places of the words where a run says them."""
    at: dict[str, list[int]] = {}
    for i, w in enumerate(words):
        at.setdefault(w, []).append(i)
    return [[i for i in at.get(t[0], ()) if words[i : i + len(t)] == t] for t in said]


def search_tokens(text: str) -> list[str]:
    """An entity's tokens; those of digits alone are their words, one by one."""
    parts = (re.sub("[^a-z0-9]+", "", t.lower()) for t in re.findall(r"[A-Za-z0-9@._%+\-']+", text))
    return [w for t in parts for w in ([DIGITS[int(c)] for c in t] if t.isdigit() else [t] if t else [])]


def placed(text: str | None, plain: str | None, said: str | None, spans: str | None) -> list[dict]:
    """Places of the words of each span (JSON of type, text, start, end) in a text, by both ways: of all words that its tokens are mapped onto; of the first and last of each run that says it.

    plain: the text's words as norms, between the same spaces; said: the norms of the recognised words.
    """
    if not said or not spans:
        return []
    own, words = json.loads(spans), said.split(" ")
    tokens, begins, ends, at = [], [], [], 0
    for w, t in zip(text.split(" "), plain.split(" "), strict=True):
        if t:
            tokens.append(t), begins.append(at), ends.append(at + len(w))
        at += len(w) + 1
    held = span_words(tokens, begins, ends, words, [s["start"] for s in own], [s["end"] for s in own])
    out = [{"type": s["type"], "text": s["text"], "at": got, "way": "mapped"} for s, got in zip(own, held, strict=True) if got]
    asked = [(*x, toks) for x in dict.fromkeys((s["type"], s["text"]) for s in own) if (toks := search_tokens(x[1]))]
    for (kind, of, toks), starts in zip(asked, run_places(words, [x[2] for x in asked]), strict=True):
        out += [{"type": kind, "text": of, "at": [i, i + len(toks) - 1], "way": "searched"} for i in starts]
    return out


_placed = C._lift(placed, "array<struct<type:string,text:string,at:array<int>,way:string>>")


def gathered(spans: DataFrame, texts: DataFrame, words: DataFrame, key: str = "segment_id") -> DataFrame:
    """Rows for ``times`` from tables of spans (key, type, text, start, end), texts (key, text) and words (key, word_index, word, word_start, word_end)."""
    kept = words.select(key, "word_index", "word_start", "word_end", norm(F.col("word")).alias("norm")).where("norm <> ''")
    line = kept.groupBy(key).agg(F.sort_array(F.collect_list(F.struct("word_start", "word_index", "norm", "word_end"))).alias("words"))
    mine = spans.groupBy(key).agg(F.collect_list(F.struct("type", "text", "start", "end")).alias("spans"))
    return texts.select(key, "text").join(line, key).join(mine, key)


def times(rows: DataFrame, key: str = "segment_id") -> DataFrame:
    """(key, type, text, start_sec, end_sec, way): when what is found in a text was said, by both ways; what has no words goes.

    rows: key, text, spans (type, text, start, end) and words (word_start, word_end, norm), those with a norm, in order of time. A row is worked on where it is: no span or word leaves it.
    """
    plain = F.regexp_replace(F.lower("text"), r"[^\p{L}\p{N} ]+", "")
    asks = F.size("spans") > 0
    got = _placed(F.when(asks, F.col("text")), F.when(asks, plain), F.when(asks, F.array_join(F.transform("words", lambda w: w["norm"]), " ")), F.when(asks, F.to_json(F.transform("spans", lambda s: F.struct(*[s[c].alias(c) for c in ("type", "text", "start", "end")])))))
    def timed(x: Column) -> Column:
        mapped = x["way"] == "mapped"
        first, end = F.get("words", F.get(x["at"], F.lit(0)))["word_start"], F.get("words", F.element_at(x["at"], -1))["word_end"]
        last = F.array_max(F.transform(x["at"], lambda i: F.get("words", i)["word_end"]))
        pad = F.when(mapped, MAP_PAD).otherwise(SEARCH_PAD)
        return F.struct(x["type"].alias("type"), x["text"].alias("text"), x["way"].alias("way"), F.greatest(F.lit(0.0), first - pad).alias("_s"), (F.when(mapped, last).otherwise(end) + pad).alias("_e"))

    # Times are looked up before rows are taken apart, so that words aren't copied for each of them.
    # explode would ask for arrays that aren't empty before they are made: the function would run twice.
    each = rows.withColumn("_got", got).select(key, F.explode_outer(F.transform("_got", timed)).alias("_x")).where(F.col("_x").isNotNull()).select(key, "_x.*")
    short = ~(F.col("way") == "mapped") & (F.col("_e") - F.col("_s") < LEAST)
    mid = (F.col("_s") + F.col("_e")) / 2
    start = F.when(short, F.greatest(F.lit(0.0), mid - LEAST / 2)).otherwise(F.col("_s"))
    stop = F.when(short, mid + LEAST / 2).otherwise(F.col("_e"))
    return each.select(key, "type", "text", F.round(start, 6).alias("start_sec"), F.round(stop, 6).alias("end_sec"), "way")
