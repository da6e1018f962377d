"""Language evidence from marking words, and its roll-up over a call."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from voxloom.functions import fixed as K
from voxloom.sources.work import write_work


def words(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(text), F.lit(r"\p{L}+"), F.lit(0))


def marks_of(docs: DataFrame, least: int = 20, share: float = 0.9) -> DataFrame:
    """(w, lang): words in at least so many documents of a language, which holds that share of all documents with the word."""
    each = docs.where(F.col("lang").isNotNull()).select("lang", F.explode(F.array_distinct(words(F.col("text")))).alias("w"))
    by = each.groupBy("w", "lang").agg(F.count("*").alias("n")).where(F.col("n") > 0)
    total = by.groupBy("w").agg(F.sum("n").alias("total"), F.max_by("lang", "n").alias("lang"), F.max("n").alias("n"))
    return total.where((F.col("n") >= least) & (F.col("n") >= share * F.col("total"))).select("w", "lang")


def detect_by_marks(docs: DataFrame, marks: DataFrame) -> DataFrame:
    """Adds ``detected`` (null without evidence or with a tie) and ``confidence``, the winner's share of the marks."""
    hits = docs.where(F.col("lang").isNotNull()).select("doc_id", F.explode(words(F.col("text"))).alias("w")).join(marks, "w").groupBy("doc_id", "lang").agg(F.count("*").alias("n"))
    best = hits.groupBy("doc_id").agg(F.max(F.struct("n", "lang")).alias("top"), F.sum("n").alias("total"), F.array_sort(F.collect_list("n")).alias("ns"))
    tie = (F.size("ns") > 1) & (F.element_at("ns", -1) == F.try_element_at("ns", F.lit(-2)))
    got = best.select("doc_id", F.when(~tie, F.col("top.lang")).alias("detected"), F.when(~tie, F.col("top.n") / F.col("total")).alias("confidence"))
    return docs.join(got, "doc_id", "left").withColumn("confidence", F.coalesce("confidence", F.lit(0.0)))


def fold(text: Column) -> Column:
    """Lower case without the accents of Latin letters."""
    return F.translate(F.lower(text), *K.ACCENTS)


def pair_marks(docs: DataFrame, least: int = 20, share: float = 0.9) -> DataFrame:
    """(w, lang): the marking words of es and en, without accents, learned from documents (lang, text) of the two."""
    two = docs.where(F.col("lang").isin("es", "en")).select("lang", fold(F.col("text")).alias("text"))
    return marks_of(two, least, share)


#: Marks that are broadcast; more meet the words in a shuffled join.
MARKS = 100_000


def score(rows: DataFrame, marks: DataFrame, text: str = "text", most: int = MARKS) -> DataFrame:
    """Adds code (es or en, null without evidence) and sure: by marks (w, lang) of the two languages and the letters that only Spanish has.

    Each such letter counts as two words and breaks a tie; sure is the margin over all evidence. The marks are any list of folded words, each of one language; their
    number isn't bounded: up to ``most`` go to the words, so that one row a text is shuffled; more are met in a join of words that are counted by text first.
    """
    said = F.coalesce(F.col(text), F.lit(""))
    letters = 2 * F.regexp_count(F.lower(said), F.lit(f"[{K.SPANISH_LETTERS}]"))
    kept = write_work(rows.withColumns({"_row": F.monotonically_increasing_id(), "_letters": letters}), "texts")
    marks = write_work(marks, "marks")
    each = kept.select("_row", F.explode(F.regexp_extract_all(fold(said), F.lit(r"\p{L}+"), F.lit(0))).alias("w"))
    if marks.count() <= most:
        each, marks = each.withColumn("n", F.lit(1).cast("long")), F.broadcast(marks)
    else:
        each = each.groupBy("_row", "w").agg(F.count("*").alias("n"))
    of = lambda lang: F.coalesce(F.sum(F.when(F.col("lang") == lang, F.col("n"))), F.lit(0))
    found = each.join(marks, "w").groupBy("_row").agg(of("es").alias("_es"), of("en").alias("_en"))
    both = kept.join(found, "_row", "left").withColumns({"_es": F.col("_letters") + F.coalesce("_es", F.lit(0)), "_en": F.coalesce("_en", F.lit(0))})
    es, en = F.col("_es"), F.col("_en")
    code = F.when(es + en == 0, None).when(es > en, "es").when(en > es, "en").when(F.col("_letters") > 0, "es")
    return both.withColumns({"code": code, "sure": F.when(es + en == 0, 0.0).otherwise(F.abs(es - en) / (es + en))}).drop("_row", "_es", "_en", "_letters")


def rollup(rows: DataFrame, keys: list[str], own: str, order: str) -> DataFrame:
    """Rows without a language take their call's majority (of equals the first seen); its share is the confidence."""
    votes = rows.where(F.col(own).isNotNull()).groupBy(*keys, own).agg(F.count("*").alias("n"), F.min(order).alias("seen"))
    by = Window.partitionBy(*keys)
    pick = votes.withColumn("share", F.col("n") / F.sum("n").over(by)).withColumn("_r", F.row_number().over(by.orderBy(F.desc("n"), "seen"))).where("_r = 1")
    joined = rows.join(pick.select(*keys, F.col(own).alias("_major"), "share"), keys, "left")
    return joined.withColumn("language", F.coalesce(F.col(own), F.col("_major"))).withColumn("confidence", F.when(F.col(own).isNotNull(), F.lit(1.0)).otherwise(F.coalesce("share", F.lit(0.0)))).drop("_major", "share")
