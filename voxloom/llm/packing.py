"""Best-two-fit packing of tokenised documents into sequences of a fixed capacity.

Each document is its token ids and an end id; only documents longer than the capacity are cut,
into pieces of full capacity behind a first piece with the rest. Packing needs the pieces' lengths alone,
so it works on their histogram, of at most ``capacity`` entries whatever the corpus: a bin is
filled greedily with the longest pieces that fit; then its smallest piece is replaced by the two
unpacked pieces that fit the expanded gap most tightly, if they fill more of it. The same bin is repeated while its
lengths last, so every new pattern exhausts a length and the plan stays small. Pieces
find their place by their rank among pieces of the same length, counted per hash bucket
and offset by the buckets before, so that no task sees all pieces of a frequent length.

Defined results: null and empty texts are the end id alone; strings of the file's added tokens in a text are those tokens, as its library has it;
repeated rows are packed each; an empty table gives no row; columns of the input other
than id and text aren't carried.
"""

from __future__ import annotations

import functools
import json
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from voxloom.llm.common import RESULT_ROWS, compact, free_names, materialise, table

CAPACITY = 2048
#: Pieces that one hash bucket has about.
BUCKET_ROWS = 20_000
#: Hash buckets of a length that are summed in one run.
CHUNK = 1000


def _byte_of() -> dict[str, int]:
    """Byte-level vocabularies spell each byte as a printable character: itself, or one from U+0100 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class Encoder:
    """Ids of a byte-level BPE file: its own library's, by a faster library wherever both are proved to give the same.

    Both merge the pair of the lowest rank first; the file's library merges listed pairs only, the faster one all whose
    concatenation is a token. These are the same pairs if ids follow the order of the merges and each merged token, alone, is
    merged to itself: with the ends of a token's span not crossed so far, what is within it is what its own merges leave, which before the
    last is the listed pair. ``_proved`` checks both on the vocabulary, and that the pattern's classes hold the same characters in both libraries.
    Texts with another character, or with the string of an added token, go to the file's library.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.slow = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.fast, self.odd = self._proved(spec)

    def _proved(self, spec: dict):
        try:
            import public_tokenizers
            import tiktoken
        except ImportError:
            return None, None
        model, added = spec["model"], [t["content"] for t in spec.get("added_tokens", [])]
        vocab, to_byte = model["vocab"], _byte_of()
        pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        first = len(to_byte)
        plain = spec.get("normalizer") is None and spec["pre_tokenizer"].get("use_regex") and not spec["pre_tokenizer"].get("add_prefix_space") and not model.get("ignore_merges")
        in_order = all(vocab.get(a + b) == first + i for i, (a, b) in enumerate(pairs)) and len(vocab) == first + len(pairs) + sum(t in vocab for t in added)
        if not (plain and in_order and all(len(self.slow.model.tokenize(a + b)) == 1 for a, b in pairs)):
            return None, None
        ranks = {bytes(to_byte[c] for c in w): i for w, i in vocab.items() if w not in added}
        fast = tiktoken.Encoding("byte-level", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
        differ = "".join(re.escape(c) for c in sorted(self._differ(tiktoken)))
        return fast, re.compile("|".join(filter(None, [f"[{differ}\ud800-\udfff\U00030000-\U0010ffff]", *map(re.escape, added)])))

    @staticmethod
    def _differ(tiktoken) -> set[str]:
        """Characters below U+30000 that the two libraries put into different classes of the pattern."""
        from tokenizers import Regex, normalizers

        every = "".join(chr(c) for c in range(0x30000) if not 0xD800 <= c < 0xE000)
        single = {bytes([b]): b for b in range(256)}
        out: set[str] = set()
        for kind in (r"\p{L}", r"\p{N}", r"\s"):
            one = tiktoken.Encoding("class", pat_str=kind, mergeable_ranks=single, special_tokens={})
            other = set(every) - set(normalizers.Replace(Regex(kind), "").normalize_str(every))
            out |= set(one.decode(one.encode_ordinary(every))) ^ other
        return out

    def __call__(self, text: str) -> list[int]:
        if self.fast is not None and not self.odd.search(text):
            try:
                return self.fast.encode_ordinary(text)
            except BaseException as e:
                if type(e).__name__ != "PanicException":  # the library's own, on runs that its pattern can't hold
                    raise
        return self.slow.encode(text, add_special_tokens=False).ids


@functools.lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    """One a worker process."""
    return Encoder(path)


def tokenise(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, end: int = 0, doc_id: str = "doc_id", text: str = "text", with_ids: bool = True) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32 and, if asked for, ids."""

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encode = encoder(tokenizer)
        for pdf in batches:
            out: dict[str, list] = {c: [] for c in ("row", "piece", "start", "length", "ids_crc32", "ids")}
            for row, t in enumerate(pdf["t"]):
                ids = np.array([*encode(t or ""), end], dtype="<u4")
                first = (len(ids) - 1) % capacity + 1
                bounds = [0, *range(first, len(ids) + 1, capacity)]
                for piece, (a, b) in enumerate(zip(bounds, bounds[1:], strict=False)):
                    values = (row, piece, a, b - a, zlib.crc32(ids[a:b].tobytes()), ids[a:b].astype(np.int32) if with_ids else None)
                    for c, v in zip(out, values, strict=True):
                        out[c].append(v)
            got = pd.DataFrame({c: out[c] for c in ("piece", "start", "length", "ids_crc32")})
            got.insert(0, "d", pdf["d"].to_numpy()[out["row"]] if len(pdf) else [])
            if with_ids:
                got["ids"] = out["ids"]
            yield got

    kind = dict(docs.dtypes)[doc_id]
    schema = f"d {kind}, piece int, start long, length long, ids_crc32 long" + ", ids array<int>" * with_ids
    return docs.select(F.col(f"`{doc_id}`").alias("d"), F.col(f"`{text}`").cast("string").alias("t")).mapInPandas(cut, schema).withColumnRenamed("d", "doc_id")


def plan(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, list[tuple[int, int]]]]:
    """(times, [(length, how many)]) of bins, for so many pieces of each length."""
    left = np.zeros(capacity + 1, dtype=np.int64)
    for length, n in counts.items():
        left[length] = n
    sizes, bins = np.arange(capacity + 1), []
    while left.any():
        free = left.copy()

        def largest(most: int, free: np.ndarray = free) -> int:
            found = np.flatnonzero(free[1 : most + 1])
            return int(found[-1]) + 1 if len(found) else 0

        content: dict[int, int] = {}
        gap = capacity
        while length := largest(gap):
            take = min(int(free[length]), gap // length)
            content[length] = content.get(length, 0) + take
            free[length] -= take
            gap -= take * length
        if gap and sum(content.values()) > 1:
            small = min(content)
            room = gap + small
            free[small] += 1
            upto = np.maximum.accumulate(np.where(free > 0, sizes, 0))  # the longest unpacked piece of at most so many ids
            a = np.flatnonzero(free[1:room]) + 1
            b = upto[np.minimum(room - a, a)]
            b = np.where((b == a) & (free[a] < 2), upto[np.maximum(np.minimum(room - a, a) - 1, 0)], b)
            total = np.where(b > 0, a + b, 0)
            if len(total) and total.max() > small:
                at = int(total.argmax())
                free[small] -= 1
                content[small] -= 1
                for x in (int(a[at]), int(b[at])):
                    content[x] = content.get(x, 0) + 1
        content = {k: n for k, n in content.items() if n}
        times = min(int(left[k]) // n for k, n in content.items())
        for k, n in content.items():
            left[k] -= n * times
        bins.append((times, sorted(content.items(), reverse=True)))
    return bins


def pack(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Adds sequence_id and offset to pieces of given ``length`` (with doc_id, piece and start to order by)."""
    spark = pieces.sparkSession
    counts = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count("*").alias("n")).collect()}
    slots, first, base = [], dict.fromkeys(counts, 0), 0
    for times, content in plan(counts, capacity):
        at = 0
        for length, n in content:
            slots.append((length, first[length], times, n, base, at))
            first[length] += n * times
            at += length * n
        base += times
    schema = "length long, from long, times long, many long, base long, at long"
    by_length = spark.createDataFrame(slots, schema).groupBy("length").agg(F.collect_list(F.struct("from", "times", "many", "base", "at")).alias("slots"))
    buckets = max(1, -(-sum(counts.values()) // BUCKET_ROWS)) * 16
    b, rank, slot_, turn_, before_ = free_names(pieces, "_b", "_r", "_s", "_q", "_before")
    rows = pieces.withColumn(b, F.pmod(F.xxhash64("doc_id", "piece", "start", "length"), F.lit(buckets)))
    # Buckets of a length are counted in runs of CHUNK, so that the sums over all of them go over a row a run.
    chunk = F.floor(F.col(b) / CHUNK)
    sizes = materialise(rows.groupBy("length", b).agg(F.count("*").alias("_n")).withColumn("_c", chunk), "piece-buckets", sum(counts.values()))
    upto = lambda keys, at: Window.partitionBy(*keys).orderBy(at).rowsBetween(Window.unboundedPreceding, -1)
    runs = sizes.groupBy("length", "_c").agg(F.sum("_n").alias("_n")).select("length", "_c", F.coalesce(F.sum("_n").over(upto(["length"], "_c")), F.lit(0)).alias("_runs"))
    within_run = sizes.select("length", b, "_c", F.coalesce(F.sum("_n").over(upto(["length", "_c"], b)), F.lit(0)).alias("_in"))
    offsets = within_run.join(runs, ["length", "_c"]).select("length", b, (F.col("_runs") + F.col("_in")).alias(before_))
    within = Window.partitionBy("length", b).orderBy("doc_id", "piece", "start")
    ranked = rows.withColumn(rank, F.row_number().over(within)).join(offsets.hint("merge"), ["length", b]).withColumn(rank, F.col(before_) + F.col(rank) - 1)
    # At most one slot for each length in each bin pattern: bounded by the capacity, not by the corpus.
    placed = ranked.join(F.broadcast(by_length), "length")
    slot = F.filter("slots", lambda s: (s["from"] <= F.col(rank)) & (F.col(rank) < s["from"] + s["times"] * s["many"]))[0]
    placed = placed.withColumn(slot_, slot).withColumn(turn_, F.col(rank) - F.col(slot_)["from"])
    turn = F.floor(F.col(turn_) / F.col(slot_)["times"]).cast("long")
    return compact(placed, sum(counts.values()), RESULT_ROWS).select(*pieces.columns, (F.col(slot_)["base"] + F.col(turn_) - turn * F.col(slot_)["times"]).alias("sequence_id"), (F.col(slot_)["at"] + turn * F.col("length")).alias("offset"))


def tokenise_and_pack(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, with_ids: bool = True) -> DataFrame:
    """Pieces with their places; ranks need the same rows twice, so the pieces are written first."""
    return pack(materialise(tokenise(docs, tokenizer, capacity, with_ids=with_ids), "pieces"), capacity)


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents' pieces in sequences of at most 2048 ids."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return tokenise_and_pack(docs, default_tokenizer(), with_ids=False).select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")
