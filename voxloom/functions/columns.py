"""Text functions on columns: native expressions, and Arrow functions where Spark has none."""

from __future__ import annotations

import json
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import DataType

from voxloom.functions import fixed as K
from voxloom.functions import kernels

SPANS = "array<struct<type:string,text:string,start:int,end:int,confidence:double,source:string>>"


#: Characters of a part of an Arrow batch: a worker holds the values of one part as Python objects at a time. A longer text is a part of its own.
PART_CHARS = 200_000


def parts(rows: Iterable[tuple], most: int = PART_CHARS) -> Iterator[list[tuple]]:
    """Consecutive rows, split so that the strings and lists of a part have at most so many characters and elements; a larger row is alone. Without rows there's one empty part."""
    part: list[tuple] = []
    size, any_ = 0, False
    for row in rows:
        n = sum(len(x) for x in row if hasattr(x, "__len__"))
        if part and size + n > most:
            yield part
            part, size = [], 0
        part.append(row)
        size, any_ = size + n, True
    if part or not any_:
        yield part


def worked(kernel, batches) -> Iterator[list]:
    """Results of a kernel over batches of columns (iterables of values), part by part: neither the values nor the results of a whole batch are Python objects at a time."""
    for columns in batches:
        for part in parts(zip(*columns, strict=True)):
            # Equal values are worked out once a part.
            known: dict = {}
            for row in part:
                if row not in known:
                    known[row] = kernel(*row)
            yield [known[row] for row in part]


def _values(column: pa.Array) -> Iterator:
    return (x.as_py() for x in column)


def _lift(kernel, kind: str):
    def lifted(*cols) -> Column:
        of = to_arrow_type(DataType.fromDDL(kind))

        if len(cols) == 1:

            @F.arrow_udf(kind)
            def column(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
                for out in worked(kernel, ((_values(x),) for x in batches)):
                    yield pa.array(out, of)

        else:

            @F.arrow_udf(kind)
            def column(batches: Iterator[tuple[pa.Array, ...]]) -> Iterator[pa.Array]:
                for out in worked(kernel, (map(_values, x) for x in batches)):
                    yield pa.array(out, of)

        return column(*cols)

    return lifted


normalise = _lift(kernels.normalise, "string")
_spelled = _lift(lambda t, language: [kernels.spelled_digits(t, language)], "array<struct<text:string,place:array<int>>>")
_remapped = _lift(lambda t, p, s, e: kernels.remap_units(t, json.loads(p), json.loads(s), json.loads(e)), "array<struct<word:string,start_char:int,start_sec:double,end_sec:double>>")
word_places = _lift(kernels.word_places, "array<struct<word:string,start_char:int>>")
normalise_first = _lift(kernels.normalise_first, "string")
word_distance = _lift(lambda a, b: kernels.word_distance(a or "", b or ""), "int")
detect = _lift(kernels.detect, SPANS)
spoken_numbers = _lift(kernels.spoken_numbers, SPANS)
#: What both detectors find, resolved, if it is at least so sure as not.
sure_spans = _lift(lambda t: [s for s in kernels.resolve([*kernels.detect(t), *kernels.spoken_numbers(t)]) if s["confidence"] >= 0.5], SPANS)
times_and_numbers = _lift(kernels.times_and_numbers, SPANS)
#: What both find, in one worker a task.
said_spans = _lift(lambda t: [*kernels.detect(t), *kernels.times_and_numbers(t)], SPANS)
json_object = _lift(kernels.json_object, "string")


#: A character that isn't white space, to Java as to RE2.
NOT_SPACE = r"[^\t-\r\x1c-\x20\x{85}\p{Z}]"


def has_text(text: Column) -> Column:
    """Whether there's more than white space; null has none."""
    return F.coalesce(text.rlike(NOT_SPACE), F.lit(False))


def spelled_digits(text: Column, language: Column) -> Column:
    """Struct of the text with digits as words, and the place that each character comes from."""
    return _spelled(text, language)[0]


def remapped_units(text: Column, place: Column, start: Column, end: Column) -> Column:
    """Words with the times of the aligned characters that come from them (arrays: where from, start, end)."""
    return _remapped(text, F.to_json(place), F.to_json(start), F.to_json(end))


def let(value: Column, f) -> Column:
    """f(value), with the value worked out once, even where f uses it within a lambda."""
    return F.transform(F.array(value), f)[0]


def once(rows: DataFrame, **columns: Column) -> DataFrame:
    """Adds columns that are worked out once a row; those of a projection are worked out again at each place that uses them."""
    each = F.explode(F.array(F.struct(*[c.alias(name) for name, c in columns.items()])))
    return rows.select("*", each.alias("_once")).select(*rows.columns, "_once.*")


def tokens(text: Column) -> Column:
    """Lower-case ASCII words."""
    return F.regexp_extract_all(F.lower(text), F.lit("[a-z0-9]+"), F.lit(0))


def plain(text: Column) -> Column:
    """Words joined by one space: the native comparable form."""
    return F.array_join(tokens(F.coalesce(text, F.lit(""))), " ")


def without_fillers(words: Column) -> Column:
    return F.filter(words, lambda w: ~w.isin(*K.FILLERS))


def expand_contractions(text: Column) -> Column:
    for short, long in K.CONTRACTIONS.items():
        text = F.regexp_replace(text, rf"\b{short}\b", long)
    return text


def clean_artifacts(text: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(text, K.ECHO, " "), K.ARTIFACT, " ")


def split_words(text: Column) -> Column:
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), r"[ \t\n\r\f\x0B]+"), "")


def repeat_ratio(text: Column, n: int = K.REPEAT_NGRAM) -> Column:
    """Share of n-grams of words that are duplicates; 0 below 2n words."""

    def share(w: Column) -> Column:
        grams = F.transform(F.sequence(F.lit(1), F.size(w) - n + 1), lambda i: F.array_join(F.slice(w, i, n), " "))
        return F.when(F.size(w) < 2 * n, F.lit(0.0)).otherwise(let(grams, lambda g: 1 - F.size(F.array_distinct(g)) / F.size(g)))

    return let(split_words(text), share)


def degenerate(text: Column, duration: Column, ratio: Column, words: Column) -> Column:
    """Why a transcript can't be speech, or null. ``ratio``, ``words``: its repeat ratio and number of words."""
    chars = F.char_length(text)
    fast = (chars >= K.MIN_CHARS_FOR_RATE) & (duration > 0) & (chars / duration > K.MAX_CHARS_PER_SEC)
    return F.when(fast, F.lit("impossible_speech_rate")).when((words >= K.MIN_WORDS_FOR_REPEAT) & (ratio > K.MAX_REPEAT), F.lit("repetition_loop"))


def _alike(a: Column, b: Column) -> Column:
    """Number of characters with which both begin: prefixes are equal up to it, so that it is found by halving."""
    least = F.least(F.char_length(a), F.char_length(b))
    steps = F.transform(F.sequence(F.lit(30), F.lit(0), F.lit(-1)), lambda k: F.pow(F.lit(2.0), k).cast("int"))
    same = lambda n: F.substr(a, F.lit(1), n) == F.substr(b, F.lit(1), n)
    return F.aggregate(F.filter(steps, lambda s: s <= least), F.lit(0), lambda n, s: F.when((n + s <= least) & same(n + s), n + s).otherwise(n))


#: Edit distances up to which a band of the table is tried before all of it.
BANDS = (16, 128, 1024)


def distance(a: Column, b: Column) -> Column:
    """Levenshtein distance. What both begin and end with goes first; of the rest only a band of the table as wide as the distance is worked out, so that the work grows with the difference."""

    def of(x: Column) -> Column:
        got = F.levenshtein(x["a"], x["b"])
        for most in reversed(BANDS):
            got = within(F.levenshtein(x["a"], x["b"], most), got)
        gone = (F.char_length(x["a"]) == 0) | (F.char_length(x["b"]) == 0)
        return F.when(gone, F.greatest(F.char_length(x["a"]), F.char_length(x["b"]))).otherwise(got)

    def within(found: Column, rest: Column) -> Column:
        return let(found, lambda d: F.when(d >= 0, d).otherwise(rest))

    def cut(x: Column, n: Column) -> Column:
        return F.struct(F.reverse(F.substr(x["a"], n + 1, F.char_length(x["a"]))).alias("a"), F.reverse(F.substr(x["b"], n + 1, F.char_length(x["b"]))).alias("b"))

    # Twice from the front, turned around between.
    less = lambda x: let(_alike(x["a"], x["b"]), lambda n: cut(x, n))
    whole = let(F.struct(a.alias("a"), b.alias("b")), lambda x: let(less(x), lambda y: let(less(y), of)))
    return F.when(a == b, F.lit(0)).when(a.isNotNull() & b.isNotNull(), whole)


def error_rate(distance: Column, length: Column, other: Column) -> Column:
    """Distance over the reference's length: 0 if both are empty, 1 if only the reference is."""
    return F.when((length == 0) & (other == 0), F.lit(0.0)).when(length == 0, F.lit(1.0)).otherwise(distance / length)


def jaccard(a: Column, b: Column) -> Column:
    """Of two arrays of words; 1 if both are empty."""
    union = F.size(F.array_union(a, b))
    return F.when(union == 0, F.lit(1.0)).otherwise(F.size(F.array_intersect(a, b)) / union)


def similarity(wer: Column, cer: Column, jac: Column) -> Column:
    one = F.lit(1.0)
    return 0.55 * (1 - F.least(wer, one)) + 0.25 * (1 - F.least(cer, one)) + 0.20 * jac


def shard_of(key: Column, shards: int) -> Column:
    """SHA-1 of a key, as a number of 160 bits, modulo the number of shards."""
    digits = F.transform(F.sequence(F.lit(1), F.lit(40)), lambda i: F.conv(F.substr(F.sha1(key), i, F.lit(1)), 16, 10).cast("long"))
    return F.aggregate(digits, F.lit(0).cast("long"), lambda a, x: (a * 16 + x) % shards).cast("int")


def vague(kind: Column, text: Column) -> Column:
    """Whether a DATE or NUMBER is a relative time, a duration or a small number."""
    said = F.btrim(F.lower(F.regexp_replace(F.coalesce(text, F.lit("")), r"^[\s\x1c-\x1f\x85\p{Z}]+|[\s\x1c-\x1f\x85\p{Z}]+$", "")), F.lit(".,!?;:'\""))
    empty = (said == "") | said.isin(*K.VAGUE_TIMES) | said.rlike(r"^\p{Nd}{1,2}$") | (said.rlike(K.VAGUE_START) & ~said.rlike(K.MONTH_OR_YEAR))
    return F.coalesce(kind.isin("DATE", "NUMBER") & empty, F.lit(False))


def blank(text: Column) -> Column:
    """Null for strings that mean nothing."""
    t = F.trim(text)
    return F.when(F.lower(t).isin("", "nan", "<na>", "none"), F.lit(None)).otherwise(t)
