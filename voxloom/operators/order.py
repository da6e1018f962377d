"""Running sums, scans that restart at keys, numbers and exact quantiles over all rows, without a task that sees all of them, or all of a key."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from voxloom.sources.work import write_work


def running(rows: DataFrame, order: list[Column], weight: Column | None = None, name: str = "before") -> DataFrame:
    """Adds the sum of ``weight`` (1) over all rows that come earlier by ``order``, which must tell rows apart.

    Ranges of rows are sorted and written; their sums, one a range, are added up and go to all.
    """
    w = F.lit(1) if weight is None else weight
    ranged = rows.withColumn("_w", w.cast("long")).repartitionByRange(*order).sortWithinPartitions(*order)
    placed = write_work(ranged.withColumn("_m", F.monotonically_increasing_id()), "ordered").withColumn("_p", F.shiftright("_m", 33))
    ahead = lambda at: Window.orderBy(at).rowsBetween(Window.unboundedPreceding, -1)
    # One row a range: the number of ranges is that of tasks.
    base = placed.groupBy("_p").agg(F.sum("_w").alias("_s")).select("_p", F.coalesce(F.sum("_s").over(ahead("_p")), F.lit(0)).alias("_base"))
    within = Window.partitionBy("_p").orderBy("_m").rowsBetween(Window.unboundedPreceding, -1)
    own = placed.withColumn("_own", F.coalesce(F.sum("_w").over(within), F.lit(0)))
    return own.join(F.broadcast(base), "_p").withColumn(name, F.col("_base") + F.col("_own")).drop("_p", "_m", "_w", "_own", "_base")


class Scans:
    """Rows in order of keys and then ``order``, cut into ranges that are written; scans over them restart at each key.

    A key with very many rows lies in many ranges: each range scans its own rows, and one value a range of the keys at its edges carries over.
    ``columns`` of the rows are kept; ``before`` and ``upto`` add one of a scan.
    """

    def __init__(self, rows: DataFrame, keys: list[str], order: list[Column]) -> None:
        self.columns, self.scanned = rows.columns, False
        by = [*[F.col(f"`{k}`") for k in keys], *order]
        ranged = rows.repartitionByRange(*by).sortWithinPartitions(*by)
        self.rows = write_work(ranged.withColumn("_m", F.monotonically_increasing_id()), "scanned").withColumn("_p", F.shiftright("_m", 33)).withColumn("_k", F.struct(*[F.col(f"`{k}`") for k in keys]) if keys else F.struct(F.lit(1).alias("one")))

    def _scan(self, value: Column, kind: str, name: str, last: int) -> None:
        gather, join = {"max": (F.max, F.greatest), "sum": (F.sum, lambda a, b: F.when(a.isNull(), b).when(b.isNull(), a).otherwise(a + b)), "last": (F.last, lambda a, b: F.coalesce(b, a))}[kind]
        whole = F.max_by("__v", "_m") if kind == "last" else gather("__v")
        if self.scanned:  # its rows are read twice below
            self.rows = write_work(self.rows, "scanned")
        self.scanned = True
        at = self.rows.withColumn("__v", value)
        ends = at.groupBy("_p").agg(F.min_by("_k", "_m").alias("__first"), F.max_by("_k", "_m").alias("__last"))
        mine = at.join(F.broadcast(ends.select(F.col("_p").alias("__p2"), "__last")), F.col("_p") == F.col("__p2")).where(F.col("_k") == F.col("__last"))
        tails = mine.groupBy("_p", "__last").agg(whole.alias("__held"))
        # A range asks what earlier ranges that end in its first key hold of it, and tells what it holds of its last: two rows a range.
        line = tails.select(F.col("__last").alias("_k"), (F.col("_p") * 2 + 1).alias("__at"), "__held").unionAll(ends.select(F.col("__first").alias("_k"), (F.col("_p") * 2).alias("__at"), F.lit(None).cast(dict(at.dtypes)["__v"])))
        ahead = Window.partitionBy("_k").orderBy("__at").rowsBetween(Window.unboundedPreceding, -1)
        told = F.last("__held", ignorenulls=True) if kind == "last" else gather("__held")
        carried = line.withColumn("__carry", told.over(ahead)).where(F.col("__at") % 2 == 0).select("_k", F.shiftright("__at", 1).alias("_p"), "__carry")
        within = Window.partitionBy("_p", "_k").orderBy("_m").rowsBetween(Window.unboundedPreceding, last)
        own = at.withColumn("__own", gather("__v").over(within))
        back = own.join(F.broadcast(carried.withColumnsRenamed({"_k": "__k2", "_p": "__p2"})), (F.col("_p") == F.col("__p2")) & (F.col("_k") == F.col("__k2")), "left")
        self.rows = back.withColumn(name, join(F.col("__carry"), F.col("__own"))).drop("__k2", "__p2", "__carry", "__own", "__v")

    def before(self, value: Column, kind: str, name: str) -> Scans:
        """Adds the greatest (``max``), the sum, or the last of the values of the key's earlier rows; null for its first. A last one mustn't be null."""
        self._scan(value, kind, name, -1)
        return self

    def upto(self, value: Column, kind: str, name: str) -> Scans:
        """The same with the row itself."""
        self._scan(value, kind, name, 0)
        return self

    def done(self, *more: str) -> DataFrame:
        """The rows with the columns that were added."""
        return self.rows.select(*[F.col(f"`{c}`") for c in [*self.columns, *more]])


def by_size(groups: DataFrame, key: str, size: str = "size", name: str = "number") -> DataFrame:
    """Adds the groups' numbers: the largest is 0, ties by key."""
    return running(groups, [F.desc(size), F.asc(key)], name=name)


def quantiles(rows: DataFrame, keys: list[str], value: str, shares: dict[str, float]) -> DataFrame:
    """Per key ``n`` and the named quantiles of the values that aren't null, exact, interpolated between neighbours.

    Equal values are counted first, so that neither a frequent value nor a large key meets in one task.
    """
    counts = rows.where(F.col(value).isNotNull()).groupBy(*keys, value).agg(F.count("*").alias("_n"))
    placed = write_work(running(counts, [*[F.col(k) for k in keys], F.col(value)], F.col("_n"), "_before"), "values")
    whole = placed.groupBy(*keys).agg(F.min("_before").alias("_first"), F.sum("_n").alias("n"))
    at = {name: (F.col("n") - 1) * F.lit(share) for name, share in shares.items()}
    here = placed.join(whole, keys) if keys else placed.join(F.broadcast(whole))
    rank = F.col("_before") - F.col("_first")
    holds = lambda r: (rank <= r) & (r < rank + F.col("_n"))
    picked = [F.max(F.when(holds(f(r)), F.col(value))).alias(f"_{side}_{name}") for name, r in at.items() for side, f in (("low", F.floor), ("high", F.ceil))]
    got = here.groupBy(*keys, "n").agg(*picked)
    part = lambda r: r - F.floor(r)
    return got.select(*keys, "n", *[(F.col(f"_low_{name}") + (F.col(f"_high_{name}") - F.col(f"_low_{name}")) * part(r)).alias(name) for name, r in at.items()])
