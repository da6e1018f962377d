"""URL filters: listed rules first, then a tree of path templates learned per host.

Rules name a host (with its subdomains) and a path prefix; the longest that fits decides.
For the other URLs, each host gets a tree of path templates. A segment that looks like a number
or an identifier becomes a wildcard of its kind; then, from the root down, values that hold too small a
share of their parent's URLs become ``*``; then, from the deepest level up, sibling branches whose
labelled shares don't differ significantly from the pooled share are merged. A
template is rejected if the smoothed share of its labelled URLs that are bad is at
least a threshold; without labelled URLs of its own the prior, their share over all hosts, decides.

What the URLs are labelled by is the caller's. ``content_label`` measures it on a page: bad if its visible text is junk by its shares of symbols and of
distinct words, good if it isn't, unknown without words. ``op5_urlfilter`` teaches by it, and ``held_out_purity`` tells how well templates foretell it.

All statistics are sums over (host, template) that are aggregated before any shuffle, so a
host with most of the URLs is one row per path shape. Paths have any depth: what all URLs of a branch begin with is passed in
one step, and only levels at which a host has two names are searched for siblings.

Defined results: a null URL, or one without ``://``, has empty host and path and is judged like
any other; an empty path has the template of no segment; unknown labels (null) count for
nothing; repeated rows count each; an empty table gives no row; input columns of the names that are added are replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from voxloom.llm.common import RESULT_ROWS, columns, compact, discard, free_names, materialise, table

SHARE, SUPPORT = 0.01, 3
Z, STRENGTH, REJECT = 1.96, 4.0, 0.8
#: Columns that judge() adds.
ADDED = ("url_host", "url_path", "url_rule", "url_template", "url_purity", "url_verdict")

#: Fixed values: (verdict, host, path prefix).
RULES = (
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
)
#: Shares by which a page's text is junk: characters that are symbols at least, words that are distinct at most, and words that this takes.
SYMBOLS, DISTINCT, LEAST_WORDS = 0.08, 0.3, 50

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_START = r"(?s)^.*?://([^/?#]*)"
_PATH = r"(?s)^.*?://[^/?#]*([^?#]*)"
_HIDDEN = r"(?is)<script\b.*?</script>|<style\b.*?</style>|<!--.*?-->|<[^>]*>"


def host_of(url: Column) -> Column:
    return F.translate(F.coalesce(F.regexp_extract(url, _START, 1), F.lit("")), _UPPER, _LOWER)


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, _PATH, 1), F.lit(""))


def content_label(html: Column, symbols: float = SYMBOLS, distinct: float = DISTINCT, least: int = LEAST_WORDS) -> Column:
    """1 if the page's visible text is junk by what can be measured of it, 0 if it isn't, null if there are no words.

    Junk has more than a share of characters that are neither letters, digits nor white space, or, from ``least`` words on, less than a share of distinct words.
    """
    seen = F.regexp_replace(html.cast("string"), _HIDDEN, " ")
    words = F.array_remove(F.split(seen, r"\s+"), "")
    odd = F.char_length(F.regexp_replace(seen, r"[\p{L}\p{N}\s]+", "")) > symbols * F.char_length(seen)
    same = (F.size(words) >= least) & (F.size(F.array_distinct(words)) < distinct * F.size(words))
    return F.when(~seen.rlike(r"\p{L}"), F.lit(None)).when(odd | same, 1).when(seen.isNotNull(), 0)


def rule_of(host: Column, path: Column, rules=RULES) -> Column:
    """Struct of the rule as text and its verdict, of the longest rule that fits; null if none does."""
    kind = "array<struct<verdict:string,host:string,path:string>>"
    ordered = [F.struct(F.lit(v).alias("verdict"), F.lit(h).alias("host"), F.lit(p).alias("path")) for v, h, p in sorted(rules, key=lambda r: (-len(r[1] + r[2]), r))]
    listed = F.array(*ordered).cast(kind)
    fits = F.filter(listed, lambda r: ((host == r["host"]) | F.endswith(host, F.concat(F.lit("."), r["host"]))) & F.startswith(path, r["path"]))
    return F.transform(fits, lambda r: F.struct(F.concat(r["host"], r["path"]).alias("rule"), r["verdict"].alias("verdict")))


def segments(path: Column) -> Column:
    """The path's segments; numbers, identifiers and dates as wildcards of their kind, an ending kept."""

    def kind(seg: Column) -> Column:
        stem, end = F.regexp_extract(seg, r"(?s)^(.*?)(\.[A-Za-z][A-Za-z0-9]{0,4})?$", 1), F.regexp_extract(seg, r"(?s)^(.*?)(\.[A-Za-z][A-Za-z0-9]{0,4})?$", 2)
        mark = (
            F.when(stem.rlike(r"^[0-9]{4}-[0-9]{2}(-[0-9]{2})?$"), F.lit("{date}"))
            .when(stem.rlike(r"^[0-9]+$"), F.lit("{n}"))
            .when(stem.rlike(r"^(?=.*[0-9])[0-9A-Fa-f]{8,}$|^[0-9A-Fa-f]{8}(-[0-9A-Fa-f]{4}){3}-[0-9A-Fa-f]{12}$"), F.lit("{id}"))
        )
        return F.coalesce(F.concat(mark, end), seg)

    return F.transform(F.when(path == "", F.array().cast("array<string>")).otherwise(F.split(F.regexp_replace(path, r"^/", ""), "/")), kind)


def _marked(seg: Column) -> Column:
    """Wildcards of a kind and empty segments are kept however rare."""
    return seg.startswith("{") | (seg == "")


_SUMS = ("n", "labelled", "bad")


def _grow(tree: DataFrame, many: int) -> DataFrame:
    """Templates of a work table's (host, segs): rare values of a branch become ``*``."""
    tree = materialise(tree.select("host", "segs", *_SUMS, F.array().cast("array<string>").alias("template"), F.col("segs").alias("rest")), "url-tree", many)
    done = []
    while True:
        by = tree.groupBy("host", "template").agg(F.sum("n").alias("total"), F.count("*").alias("rows"), F.min("rest").alias("low"), F.max("rest").alias("high"))
        here = tree.join(by, ["host", "template"])
        # Of a branch with little support no value is kept; a branch of one path keeps all of it.
        ends = F.when(F.col("total") < SUPPORT, F.transform("rest", lambda s: F.when(_marked(s), s).otherwise(F.lit("*")))).when(F.col("rows") == 1, F.col("rest"))
        # What a branch's least and greatest paths begin with, all of its paths do.
        short = F.least(F.size("low"), F.size("high"))
        differ = F.filter(F.sequence(F.lit(0), short), lambda i: ~F.get("low", i).eqNullSafe(F.get("high", i)) | (i == short))
        step = here.withColumn("ends", ends).withColumn("skip", differ[0])
        step = materialise(
            step.select(
                "host", "segs", *_SUMS, F.col("ends").isNotNull().alias("over"),
                F.concat("template", F.coalesce("ends", F.slice("rest", F.lit(1), F.col("skip")))).alias("template"),
                F.when(F.col("ends").isNull(), F.slice("rest", F.col("skip") + 1, F.size("rest") + 1)).alias("rest"),
            ),
            "url-tree",
            many,
        )
        discard(tree)
        done.append(step)
        at = step.where("not over").withColumn("seg", F.get("rest", F.lit(0)))
        seen = at.where("seg is not null").groupBy("host", "template", "seg").agg(F.sum("n").alias("k"))
        total = seen.groupBy("host", "template").agg(F.sum("k").alias("total"))
        keep = seen.join(total, ["host", "template"]).where((F.col("k") >= F.greatest(F.lit(SUPPORT), F.col("total") * SHARE)) | _marked(F.col("seg")))
        joined = at.join(keep.select("host", "template", "seg", F.lit(True).alias("kept")), ["host", "template", "seg"], "left")
        name = F.when(F.col("kept"), F.col("seg")).otherwise(F.lit("*"))
        more = joined.where("seg is not null").select("host", "segs", *_SUMS, F.concat("template", F.array(name)).alias("template"), F.slice("rest", F.lit(2), F.size("rest")).alias("rest"))
        tree = materialise(more, "url-tree", many)
        if tree.isEmpty():
            break
    finished = [t.where("over or size(rest) = 0").select("host", "segs", *_SUMS, "template") for t in done]
    out = finished[0]
    for t in finished[1:]:
        out = out.unionAll(t)
    out = materialise(out, "url-templates", many)
    discard(tree, *done)
    return out


def _merge(tree: DataFrame, many: int) -> DataFrame:
    """Merges labelled siblings whose shares don't differ significantly from the pooled one, from the deepest level up."""
    names = tree.select("host", F.posexplode("template").alias("at", "name")).where(~F.col("name").rlike(r"^\{|^\*"))
    levels = names.groupBy("host", "at").agg(F.min("name").alias("low"), F.max("name").alias("high")).where("low <> high").select("at").distinct()
    for (level,) in sorted(levels.collect(), reverse=True):  # as many as there are levels at which a host has two names
        leaf = tree.groupBy("host", "template").agg(F.sum("labelled").alias("l"), F.sum("bad").alias("b"))
        name = F.get("template", F.lit(level))
        wide = F.transform("template", lambda s, i: F.when(i == level, F.lit("*")).otherwise(s))  # noqa: B023
        leaf = leaf.where(name.isNotNull() & ~name.rlike(r"^\{|^\*") & (F.col("l") > 0)).withColumn("wide", wide)
        pooled = leaf.groupBy("host", "wide").agg(F.sum("b").alias("pb"), F.sum("l").alias("pl")).withColumn("rate", F.col("pb") / F.col("pl"))
        leaf = leaf.join(pooled, ["host", "wide"])
        far = F.abs(F.col("b") - F.col("l") * F.col("rate")) > Z * F.sqrt(F.col("l") * F.col("rate") * (1 - F.col("rate"))) + 1e-9
        alike = leaf.where(~far)
        several = alike.groupBy("host", "wide").agg(F.count("*").alias("k")).where("k > 1").select("host", "wide")
        alike = alike.join(several, ["host", "wide"]).select("host", "template", "wide")
        new = materialise(tree.join(alike, ["host", "template"], "left").select("host", "segs", *_SUMS, F.coalesce("wide", "template").alias("template")), "url-templates", many)
        discard(tree)
        tree = new
    return tree


def templates(urls: DataFrame) -> DataFrame:
    """From (host, segs, label: 1 bad, 0 good or null), (host, segs, template, n, labelled, bad, purity)."""
    counts = (F.count("*").alias("n"), F.count("label").alias("labelled"), F.coalesce(F.sum("label"), F.lit(0)).cast("long").alias("bad"))
    shapes = materialise(urls.groupBy("host", "segs").agg(*counts), "url-shapes")
    seen, bad = shapes.agg(F.sum("labelled"), F.sum("bad")).first()
    many = shapes.count()
    tree = _merge(_grow(shapes, many), many)
    discard(shapes)
    prior = (bad or 0) / seen if seen else 0.0
    sums = tree.groupBy("host", "template").agg(F.sum("labelled").alias("l"), F.sum("bad").alias("b"))
    purity = F.when(F.col("l") > 0, (F.col("b") + STRENGTH * prior) / (F.col("l") + STRENGTH)).otherwise(F.lit(prior))
    out = materialise(tree.join(sums.select("host", "template", purity.alias("purity")), ["host", "template"]), "url-purity", many)
    discard(tree)
    return out


def judge(pages: DataFrame, url: str = "url", label: Column | None = None, rules=RULES) -> DataFrame:
    """Adds url_host, url_path, url_rule, url_template, url_purity and url_verdict.

    ``label`` (1 bad, 0 good, null unknown) teaches the templates; by default what the
    rules decide does.
    """
    own = columns(pages.drop(*ADDED))
    host, path, rule, segs, teach = free_names(pages, "_host", "_path", "_rule", "_segs", "_label")
    address = F.col(f"`{url}`").cast("string")
    rows = pages.withColumns({host: host_of(address), path: path_of(address)})
    rows = rows.withColumns({rule: F.get(rule_of(F.col(host), F.col(path), rules), F.lit(0)), segs: segments(F.col(path))})
    by_rule = F.when(F.col(rule)["verdict"] == "block", 1).when(F.col(rule)["verdict"] == "allow", 0)
    rows = rows.withColumn(teach, (label if label is not None else by_rule).cast("int"))
    tree = templates(rows.select(F.col(host).alias("host"), F.col(segs).alias("segs"), F.col(teach).alias("label")))
    tree = tree.select(F.col("host").alias(host), F.col("segs").alias(segs), F.array_join("template", "/").alias("_t"), F.col("purity").alias("_p"))
    template, purity = free_names(rows, "_template", "_purity")
    done = rows.join(tree.withColumnsRenamed({"_t": template, "_p": purity}), [host, segs], "left")
    learned = F.when(F.col(purity) >= REJECT, F.lit("block")).otherwise(F.lit("allow"))
    added = (F.col(host), F.col(path), F.col(rule)["rule"], F.col(template), F.col(purity), F.coalesce(F.col(rule)["verdict"], learned))
    return done.select(*own, *[c.alias(name) for c, name in zip(added, ADDED, strict=True)])


def held_out_purity(pages: DataFrame, label: Column, url: str = "url", rules=()) -> DataFrame:
    """(verdict, labelled, purity): of a fifth of the labelled URLs, by hash, which don't teach, how many are bad by the verdict of the templates that the others teach."""
    (name, out) = free_names(pages, "_label", "_held")
    rows = pages.withColumns({name: label.cast("int"), out: F.pmod(F.xxhash64(F.col(f"`{url}`")), F.lit(5)) == 0})
    done = judge(rows, url, F.when(~F.col(out), F.col(name)), rules).where(F.col(out) & F.col(name).isNotNull())
    return done.groupBy(F.col("url_verdict").alias("verdict")).agg(F.count("*").alias("labelled"), F.avg(name).alias("purity"))


def op5_urlfilter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdict on every page's URL; the pages' contents teach the templates."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    done = judge(pages, label=content_label(F.col("html")))
    return compact(done, pages.count(), RESULT_ROWS).select("page_id", F.col("url_host").alias("host"), F.col("url_path").alias("path"), F.col("url_rule").alias("rule"), F.col("url_verdict").alias("verdict"), F.col("url_template").alias("template"), F.col("url_purity").alias("purity"))
