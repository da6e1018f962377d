"""Greedy packing of rows in order, in parallel.

Where a batch ends depends on where it starts alone, so each row has a successor: the first row of the batch after one that starts there. Ordered rows are cut
into blocks; a block sees the next block's first rows as well, no more than a batch can hold, and tells for every row at which a batch can
enter it how many batches start in it and at which row of the next block the last one ends. Such maps compose: those of a
group of blocks into the group's, up to one map of all; then every block learns where it is entered, group by group, and numbers its rows. No task sees more rows than a block
or more maps than a group has.

Defined results: an empty table gives no rows; a null size counts as nothing; rows that the order doesn't tell apart may change places.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from voxloom.operators.order import running
from voxloom.sources.work import write_work

#: Rows of a block, and blocks of a group.
BLOCK, FAN = 50_000, 256


def successors(sizes: np.ndarray, most: int, rule: str, limit: float) -> np.ndarray:
    """First row of the batch after the one that starts at each row; the number of rows if there is none.

    ``budget``: a batch closes at ``most`` rows or before its sum passes the limit. ``padded``: or before its rows times their longest (the next, in order) do.
    ``target``: a batch closes once its sum has reached the limit.
    """
    n = len(sizes)
    out, total, alive = np.full(n, n, np.int64), sizes.copy(), np.arange(n)
    for j in range(1, most + 1):
        alive = alive[alive + j < n]
        if not len(alive):
            break
        item = sizes[alive + j]
        if rule == "target":
            closed = total[alive] >= limit
        elif rule == "padded":
            closed = (j + 1) * item > limit
        else:
            closed = total[alive] + item > limit
        if j == most:
            closed = np.ones(len(alive), bool)
        out[alive[closed]] = alive[closed] + j
        alive = alive[~closed]
        total[alive] += sizes[alive + j]
    return out


def block_map(sizes: np.ndarray, own: int, most: int, rule: str, limit: float) -> tuple[np.ndarray, np.ndarray]:
    """For each row of the first ``most`` (and the end) at which a batch enters a block of ``own`` rows: where it leaves it, and the batches that start in it."""
    after = successors(sizes, most, rule, limit)
    leave, count = np.zeros(own, np.int64), np.zeros(own, np.int64)
    for s in range(own - 1, -1, -1):
        t = after[s]
        leave[s], count[s] = (t - own, 1) if t >= own else (leave[t], count[t] + 1)
    enter = np.arange(most + 1)
    inside = enter < own
    at = np.minimum(enter, max(own - 1, 0))
    return np.where(inside, leave[at], np.maximum(enter - own, 0)), np.where(inside, count[at], 0)


def _composed(maps: pd.DataFrame, group: int) -> pd.DataFrame:
    """One map of several blocks in order."""
    here, total, enter = None, None, None
    for _, m in maps.sort_values(["block", "enter"]).groupby("block"):
        leave, count = m["leave"].to_numpy(), m["n"].to_numpy()
        if here is None:
            enter, here, total = m["enter"].to_numpy(), leave, count
        else:
            here, total = leave[here], total + count[here]
    return pd.DataFrame({"block": group, "enter": enter, "leave": here, "n": total})


def _entered(maps: pd.DataFrame) -> pd.DataFrame:
    """Where each block of a group is entered and how many batches start before it; the group's own are in ``at`` and ``base``."""
    at, base, out = int(maps["at"].iloc[0]), int(maps["base"].iloc[0]), []
    for block, m in maps.sort_values(["block", "enter"]).groupby("block"):
        out.append((block, at, base))
        base += int(m["n"].iloc[at])
        at = int(m["leave"].iloc[at])
    return pd.DataFrame(out, columns=["block", "at", "base"])


def pack(rows: DataFrame, order: list[Column], size: Column, rule: str, most: int, limit: float, keep: list[str], block: int = BLOCK, fan: int = FAN) -> DataFrame:
    """(keep, batch): the batch of every row, numbered from 0 in order, as a loop over all rows gives it. ``order`` must tell rows apart."""
    block = max(block, most)
    kinds = dict(rows.dtypes)
    placed = running(rows.select(*keep, *[o.alias(f"_o{i}") for i, o in enumerate(order)], F.coalesce(size.cast("double"), F.lit(0.0)).alias("_size")), [F.col(f"_o{i}") for i in range(len(order))])
    placed = write_work(placed.select(*keep, "_size", F.floor(F.col("before") / block).alias("_block"), F.pmod("before", F.lit(block)).alias("_at")), "packed")
    # A block's rows, and its first rows once more for the block before.
    lent = F.when((F.col("_block") > 0) & (F.col("_at") < most), F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    seen = placed.select(F.explode(lent).alias("_lent"), "_block", "_at", "_size").select((F.col("_block") - F.col("_lent")).alias("block"), "_lent", "_at", "_size")

    def told(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["_lent", "_at"])
        leave, n = block_map(pdf["_size"].to_numpy(np.float64), int((pdf["_lent"] == 0).sum()), most, rule, limit)
        return pd.DataFrame({"block": key[0], "enter": np.arange(len(leave)), "leave": leave, "n": n})

    kind = "block long, enter long, leave long, n long"
    levels = [write_work(seen.groupBy("block").applyInPandas(told, kind), "maps")]
    blocks = (levels[0].agg(F.max("block")).first()[0] or 0) + 1
    while blocks > fan:
        up = levels[-1].groupBy(F.floor(F.col("block") / fan).alias("_g")).applyInPandas(lambda key, pdf: _composed(pdf, key[0]), kind)
        levels.append(write_work(up, "maps"))
        blocks = -(-blocks // fan)
    entered = levels[-1].withColumns({"at": F.lit(0).cast("long"), "base": F.lit(0).cast("long")}).groupBy().applyInPandas(_entered, "block long, at long, base long")
    for maps in reversed(levels[:-1]):
        above = entered.withColumnRenamed("block", "_g")
        here = maps.withColumn("_g", F.floor(F.col("block") / fan)).join(above, "_g")
        entered = write_work(here.groupBy("_g").applyInPandas(lambda key, pdf: _entered(pdf), "block long, at long, base long"), "entered")

    def numbered(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("_at")
        sizes, at, base = pdf["_size"].to_numpy(np.float64), int(pdf["at"].iloc[0]), int(pdf["base"].iloc[0])
        after, first = successors(sizes, most, rule, limit), np.zeros(len(sizes), np.int64)
        while at < len(sizes):
            first[at] = 1
            at = int(after[at])
        return pdf[keep].assign(batch=base - 1 + np.cumsum(first))

    joined = placed.join(entered.withColumnRenamed("block", "_block"), "_block")
    return joined.groupBy("_block").applyInPandas(numbered, ", ".join([*[f"`{k}` {kinds[k]}" for k in keep], "batch long"]))
