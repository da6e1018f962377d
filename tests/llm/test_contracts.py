"""The registered queries against SQL or plain versions, and cases that operators met badly before."""

import collections
import gzip
import os
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.llm.test_ops import DOCS, base_brute, docs, near_brute
from tests.oracle import same
from voxloom.llm import catalog, common, decontam, langid, minhash, packing, pii, quality, substring, topk, urlfilter, warc

SF = "/root/testdata/sf0.001"
data = pytest.mark.skipif(not os.path.isdir(SF), reason="test tables aren't here")


def table(spark, name):
    return spark.read.parquet(f"{SF}/{name}.parquet")


@data
@pytest.mark.parametrize("name", sorted(catalog.ORACLES))
def test_same_as_sql(spark, name):
    same(spark, catalog.QUERIES[name], catalog.ORACLES[name], SF)


@data
def test_op4(spark):
    """Ids by an unmodified tokenizer, pieces by the rule, places without gaps, as few sequences as a plain first fit needs."""
    from tokenizers import Tokenizer

    own = Tokenizer.from_file(packing.default_tokenizer())
    want = []
    for r in table(spark, "documents").collect():
        ids = [*own.encode(r.text or "", add_special_tokens=False).ids, 0]
        at, first = 0, len(ids) % 2048 or 2048
        for piece, n in enumerate([first] + [2048] * ((len(ids) - first) // 2048)):
            want.append((r.doc_id, piece, at, n, zlib.crc32(np.array(ids[at : at + n], "<u4").tobytes())))
            at += n
    rows = catalog.QUERIES["op4_packing"](spark, SF).collect()
    assert sorted(tuple(r)[:5] for r in rows) == sorted(want)
    bins = collections.defaultdict(list)
    for r in rows:
        bins[r.sequence_id].append((r.offset, r.length))
    for own in bins.values():
        own.sort()
        assert own[0][0] == 0 and all(a + n == b for (a, n), (b, _) in zip(own, own[1:], strict=False)) and sum(n for _, n in own) <= 2048
    fit: list[int] = []
    for n in sorted((x[3] for x in want), reverse=True):
        at = next((i for i, room in enumerate(fit) if room >= n), None)
        fit.append(2048 - n) if at is None else fit.__setitem__(at, fit[at] - n)
    assert len(bins) <= len(fit)


@data
def test_op6(spark):
    rows = [(r.doc_id, r.text) for r in table(spark, "documents").collect()]
    assert sorted(map(tuple, catalog.QUERIES["op6_neardup"](spark, SF).collect())) == sorted(near_brute(rows))


@data
def test_op7(spark):
    import hashlib

    want = []
    for r in table(spark, "documents").collect():
        base = base_brute(r.text)
        n = collections.Counter(k for k, _, _ in base)
        listed = ",".join(f"{k}:{a}:{b}" for k, a, b in base)
        want.append((r.doc_id, *(n[k] for k in pii.BASE_KINDS), hashlib.sha256(listed.encode()).hexdigest()))
    assert sorted(tuple(r)[:6] for r in catalog.QUERIES["op7_pii"](spark, SF).collect()) == sorted(want)


@data
@pytest.mark.parametrize(("name", "truth", "column", "least"), [("op8_quality", "quality", "predicted", 0.9), ("op10_langid", "lang", "lang_pred", 0.9)])
def test_held_out_accuracy(spark, name, truth, column, least):
    sf = SF.replace("0.001", "0.01")
    want = {r[0]: r[1] for r in spark.read.parquet(f"{sf}/{'labels' if truth == 'quality' else 'documents'}.parquet").select("doc_id", truth).collect() if r[1] is not None}
    got = catalog.QUERIES[name](spark, sf).collect()
    assert len(got) == spark.read.parquet(f"{sf}/documents.parquet").count() and all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) and 0 <= r.score <= 1 for r in got)
    held = [(r[column], want[r.doc_id]) for r in got if r.held_out and r.doc_id in want and r[column] != "und"]
    assert len(held) > 30 and np.mean([a == b for a, b in held]) >= least


# 5: a plain tree


def plain_verdicts(rows, share=0.01, support=3, z=1.96, strength=4.0, reject=0.8):
    """Verdicts of (host, segments, label) rows by dictionaries, one host at a time."""
    known = [x for _, _, x in rows if x is not None]
    prior = sum(known) / len(known) if known else 0.0
    out: dict = {}
    for host in {h for h, _, _ in rows}:
        own = [(s, x) for h, s, x in rows if h == host]
        template: dict = {s: () for s, _ in own}
        for level in range(max(len(s) for s, _ in own)):
            n = collections.Counter((template[s], s[level]) for s, _ in own if len(s) > level)
            total = collections.Counter(template[s] for s, _ in own if len(s) > level)
            for s in list(template):
                if len(s) > level:
                    seg, t = s[level], template[s]
                    kept = n[t, seg] >= max(support, total[t] * share) or seg.startswith("{") or seg == ""
                    template[s] = (*t, seg if kept else "*")
        for level in range(max(map(len, template)) - 1, -1, -1):
            sums = collections.defaultdict(lambda: [0, 0])
            for s, x in own:
                if x is not None:
                    sums[template[s]][0] += 1
                    sums[template[s]][1] += x
            wide = collections.defaultdict(list)
            for t in sums:
                if len(t) > level and not t[level].startswith(("{", "*")):
                    wide[(*t[:level], "*", *t[level + 1 :])].append(t)
            for w, ts in wide.items():
                rate = sum(sums[t][1] for t in ts) / sum(sums[t][0] for t in ts)
                near = [t for t in ts if abs(sums[t][1] - sums[t][0] * rate) <= z * (sums[t][0] * rate * (1 - rate)) ** 0.5 + 1e-9]
                if len(near) > 1:
                    for s, t in template.items():
                        if t in near:
                            template[s] = w
        sums = collections.defaultdict(lambda: [0, 0])
        for s, x in own:
            if x is not None:
                sums[template[s]][0] += 1
                sums[template[s]][1] += x
        for s, t in template.items():
            n, bad = sums.get(t, (0, 0))
            pure = (bad + strength * prior) / (n + strength) if n else prior
            out[host, s] = ("/".join(t), round(pure, 9), "block" if pure >= reject else "allow")
    return out


def test_templates_plain(spark):
    rng = np.random.default_rng(11)
    rows = []
    for host in ("a.org", "b.org"):
        for _ in range(400):
            depth = int(rng.choice([0, 1, 2, 3, 4, 16, 40]))
            segs = [str(rng.choice(["news", "spam", "casino", "x", "", str(rng.integers(0, 99)), f"u{rng.integers(0, 300)}"])) if k < 4 else f"d{k}" for k in range(depth)]
            bad = None if rng.random() < 0.3 else int("spam" in segs or "casino" in segs)
            rows.append((f"http://{host}/{'/'.join(segs)}" if depth else f"http://{host}", bad))
    rows += [(f"http://deep.org/{'/'.join(f's{k}' for k in range(60))}/{'evil' if i % 2 else 'fine'}/{i}", i % 2) for i in range(40)]
    pages = spark.createDataFrame(rows, "url string, bad int")
    got = urlfilter.judge(pages, label=F.col("bad"), rules=()).select("url", "url_host", "url_template", "url_purity", "url_verdict").collect()
    mark = lambda s: "{n}" if re.fullmatch("[0-9]+", s) else s
    split = lambda u: tuple(mark(s) for s in u.split("/", 3)[3].split("/")) if u.count("/") > 2 else ()
    want = plain_verdicts([(u.split("/")[2], split(u), x) for u, x in rows])
    for r in got:
        assert (r.url_template, round(r.url_purity, 9), r.url_verdict) == want[r.url_host, split(r.url)], r.url
    assert len({w[2] for w in want.values()}) == 2
    assert {r.url_verdict for r in got if "/evil/" in r.url} == {"block"} and {r.url_verdict for r in got if "/fine/" in r.url} == {"allow"}


JUNK, FINE = "<p>aa%%% bb### cc!!! " * 9 + "</p>", "<p>hello there, all of you</p><script>%%%%%%%%%%%%%%%%%%%</script>"


def test_pages_teach(spark):
    """Without rules, hosts whose pages are junk are rejected as wholes; unlabelled pages follow their template; held-out pages bear it out."""
    rows = [(f"http://bad.org/p/{i}", JUNK if i % 20 else None) for i in range(60)] + [(f"http://good.org/p/{i}", FINE) for i in range(60)]
    pages = spark.createDataFrame(rows, "url string, html string")
    label = urlfilter.content_label(F.col("html"))
    got = urlfilter.judge(pages, label=label, rules=()).collect()
    assert {(r.url_host, r.url_verdict) for r in got} == {("bad.org", "block"), ("good.org", "allow")}
    held = {r.verdict: (r.labelled > 3, r.purity) for r in urlfilter.held_out_purity(pages, label).collect()}
    assert held == {"block": (True, 1.0), "allow": (True, 0.0)}


def plain_label(page):
    seen = re.sub(r"(?is)<script\b.*?</script>|<style\b.*?</style>|<!--.*?-->|<[^>]*>", " ", page or "")
    words = seen.split()
    if not any(c.isalpha() for c in seen):
        return None
    odd = sum(not c.isalpha() and not c.isnumeric() and not c.isspace() for c in seen) > 0.08 * len(seen)
    return int(odd or (len(words) >= 50 and len(set(words)) < 0.3 * len(words)))


@data
def test_op5(spark):
    """The whole query against plain rules, labels, templates and verdicts."""
    rules = sorted(urlfilter.RULES, key=lambda r: -len(r[1] + r[2]))
    judged = []
    for r in table(spark, "pages").collect():
        rest = (r.url or "").split("://", 1)[1] if "://" in (r.url or "") else ""
        host = re.split("[/?#]", rest)[0].lower()
        path = re.split("[?#]", rest[len(host) :])[0]
        rule = next(((h + p, v) for v, h, p in rules if (host == h or host.endswith("." + h)) and path.startswith(p)), (None, None))
        judged.append((r.page_id, host, path, rule, plain_label(r.html)))
    paths = {p for _, _, p, _, _ in judged}
    segs = dict(zip(sorted(paths), spark.createDataFrame([(p,) for p in sorted(paths)], "p string").coalesce(1).select(urlfilter.segments(F.col("p")).alias("s")).toPandas()["s"].map(tuple), strict=True))
    learned = plain_verdicts([(h, segs[p], x) for _, h, p, _, x in judged])
    want = sorted((i, h, p, rule, verdict or learned[h, segs[p]][2]) for i, h, p, (rule, verdict), _ in judged)
    got = sorted(tuple(r)[:5] for r in catalog.QUERIES["op5_urlfilter"](spark, SF).collect())
    assert got == want and sum(x == 1 for *_, x in judged) > 5


def test_many_rules(spark):
    rules = [("block", f"h{i}.org", "/") for i in range(1500)] + [("allow", "h7.org", "/ok")]
    pages = spark.createDataFrame([("http://h7.org/ok/1",), ("http://x.h7.org/no",), ("http://h1499.org/",), ("http://h1500.org/",)], "url string")
    assert [r.url_verdict for r in urlfilter.judge(pages, rules=rules).orderBy(F.monotonically_increasing_id()).collect()].count("block") == 2


# 4: pairs and ids


def test_second_fit_is_the_tightest():
    """In each plan's first bin, no other two pieces fill the smallest piece's gap better."""
    rng = np.random.default_rng(12)
    for _ in range(300):
        cap = 40
        counts = dict(collections.Counter(rng.integers(1, cap + 1, int(rng.integers(2, 14))).tolist()))
        free, gap, greedy = collections.Counter(counts), cap, []
        while fits := [k for k, n in free.items() if n and k <= gap]:
            greedy.append(max(fits))
            free[max(fits)] -= 1
            gap -= max(fits)
        best = 0
        if gap and len(greedy) > 1:
            small = min(greedy)
            free[small] += 1
            left = list(free.elements())
            best = max((a + b for i, a in enumerate(left) for b in left[i + 1 :] if a + b <= gap + small), default=0)
            best = best - small if best > small else 0
        times, content = packing.plan(counts, cap)[0]
        assert sum(k * n for k, n in content) == sum(greedy) + best


def test_ids_are_the_tokenizers(spark):
    from tokenizers import Tokenizer

    path = packing.default_tokenizer()
    own, fast = Tokenizer.from_file(path), packing.encoder(path)
    assert fast.fast is not None
    every = [chr(c) for c in range(1, 0x30000) if not 0xD800 <= c < 0xE000 and (c < 0x3000 or c % 7 == 0)]
    rng = np.random.default_rng(13)
    for kind in ("a{}1", "{}{} ", " {}.", "'s{}'ll", "\n{}  x"):
        for at in range(0, len(every), 4000):
            t = "".join(kind.format(c, c) for c in every[at : at + 4000])
            assert fast(t) == own.encode(t, add_special_tokens=False).ids
    alphabet = [*"aB1'.,! \n\t  \x1c\x85é東🙂", "  ", "'ve", "<|endoftext|>", "İ", "²", "ⅷ", "́"]
    for _ in range(3000):
        t = "".join(rng.choice(alphabet, int(rng.integers(0, 25))))
        assert fast(t) == own.encode(t, add_special_tokens=False).ids
    assert own.encode("<|endoftext|> a", add_special_tokens=False).ids == fast("<|endoftext|> a") == [50256, 257]


# Names that clash, and cases at the edges


def test_clashing_names(spark):
    rows = [(1, "a b c d e f g h i"), (2, "a b c d e f g h i"), (3, "other words than these here are some"), (None, None)]
    names = ["_d", "_h", "_i", "_t", "_k", "_s", "_c", "_l", "_row", "_score", "_maybe", "_keep", "_word", "_bits", "_k0", "_hit", "n_words", "n_hit", "n_items", "item_ids", "quality_score", "quality_ok", "lang_pred", "class_id", "Node", "a.b"]
    wide = docs(spark, rows).withColumns({n: F.lit(n) for n in names})
    own = {n: n for n in names}
    items = spark.createDataFrame([(9, "a b c d e f g h")], "item_id long, text string")
    model = quality.fit([], np.zeros(0, int))
    for got, n in (
        (minhash.keep_one(wide), 3),
        (decontam.drop_contaminated(wide, items), 2),
        (quality.keep_good(wide, model), 4),
    ):
        assert got.columns == wide.columns
        found = got.collect()
        assert len(found) == n and all(r[k] == v for r in found for k, v in own.items())
    for got, added in (
        (decontam.contamination(wide, items), decontam.ADDED),
        (substring.remove_repeats(wide, 4), substring.ADDED),
        (quality.score(wide, model), ("quality_score", "quality_ok")),
        (langid.identify(wide, [], langid.start(2)), ("lang_pred", "lang_score")),
    ):
        found = got.collect()
        assert len(found) == 4 and all(r[k] == v for r in found for k, v in own.items() if k not in added) and set(added) <= set(got.columns)
    assert [r.n_hit for r in decontam.contamination(wide, items).orderBy(F.col("doc_id").asc_nulls_last()).collect()] == [8, 8, 0, 0]
    pages = wide.withColumns({"url": F.lit("http://a.org/x"), "_host": F.lit("own"), "_segs": F.lit("own"), "url_segs": F.lit("own"), "url_listed": F.lit("own")})
    assert all(r["_host"] == r["_segs"] == r["url_segs"] == r["url_listed"] == "own" for r in urlfilter.judge(pages).collect())


def test_codes_that_clash_are_drawn_again(spark, monkeypatch):
    monkeypatch.setattr(decontam, "_code", lambda w, seed: F.char_length(w).cast("long") if seed == 0 else F.xxhash64(w, F.lit(seed)))
    items = spark.createDataFrame([(9, "aa bb cc")], "item_id long, text string")
    got = {r.doc_id: r.n_hit for r in decontam.contamination(docs(spark, [(1, "x aa bb cc"), (2, "bb aa cc"), (3, None)]), items).collect()}
    assert got == {1: 3, 2: 0, 3: 0}


def test_key_filter_loses_nothing(spark, monkeypatch):
    for words in (4, common.FILTER_WORDS):
        monkeypatch.setattr(common, "FILTER_WORDS", words)
        rows = spark.range(3000).withColumn("_maybe", F.lit(1))
        found = common.materialise(spark.range(0, 3000, 3).select(F.xxhash64("id").alias("k"), (F.col("id") * 2).alias("twice")), "found")
        got = common.look_up(rows, [F.xxhash64("id")], found).collect()
        assert sorted((r.id, r.twice) for r in got) == [(i, 2 * i if i % 3 == 0 else None) for i in range(3000)]
        sifted = common.sift(rows, F.xxhash64("id"), found.select("k"), "m")
        assert sifted.where("id % 3 = 0 and not m").count() == 0
        assert words == 4 or sifted.where("m").count() < 1100


def test_weighted_classes(spark):
    """Bags: a text whose shingles are the same but differently often is another class; the sets are equal."""
    a, b = "x1 x2 x3 x4 x5 x6 " * 3, "x1 x2 x3 x4 x5 x6 " * 40
    rows = [(1, a), (2, b), (3, a + "end")]
    count = lambda w: [c for _, c in sorted(map(tuple, minhash.near_duplicates(docs(spark, rows), weights=w).select("doc_id", "class_id").collect()))]
    assert count("one")[1] == 1 and count("count") == [1, 2, 1]
    x, y = (collections.Counter(zip(*[t.split()[k:] for k in range(5)], strict=False)) for t in (a, a + "end"))
    s, t = minhash.sets_of([a, a + "end"], "count")
    assert len(np.intersect1d(s, t)) / len(np.union1d(s, t)) == sum((x & y).values()) / sum((x | y).values())


def test_one_id_of_several_texts(spark):
    """Each class keeps a row, also where one id names two classes; repeated rows are one."""
    one, two = (" ".join(f"{k}{i}" for i in range(30)) for k in "ab")
    rows = [(1, one), (1, two), (2, one), (1, one), (3, two), (None, None), (None, None), (None, "")]
    assert sorted(map(tuple, minhash.keep_one(docs(spark, rows)).collect()), key=str) == sorted([(1, one), (1, two), (None, None), (None, "")], key=str)


def test_repeated_words_are_split(spark, monkeypatch):
    monkeypatch.setattr(substring, "HOT_WINDOWS", 50)
    rows = [(1, "ha " * 3000), (2, "ho " * 36), (3, "he " * 35), (4, None)]
    got = {r.doc_id: (r.n_words, r.n_removed) for r in substring.remove_repeats(docs(spark, rows)).collect()}
    assert got == {1: (3000, 3000), 2: (36, 36), 3: (35, 0), 4: (0, 0)}


def test_statistics_plain():
    rng = np.random.default_rng(14)
    for _ in range(60):
        texts = [rng.choice(list("abc"), int(rng.integers(1, 12))).tolist() for _ in range(4)]
        automaton = substring.Automaton()
        for t in texts:
            automaton.add(t)
        automaton.count()
        times = lambda w: sum(t[i : i + len(w)] == w for t in texts for i in range(len(t) - len(w) + 1))  # noqa: E731, B023
        probe = rng.choice(list("abcd"), 20).tolist()
        for least in (1, 2, 3):
            want = [max((n for n in range(1, i + 2) if times(probe[i + 1 - n : i + 1]) >= least), default=0) for i in range(20)]
            assert list(automaton.statistics(probe, least)) == want


def test_archives_of_other_encodings(spark, tmp_path):
    head, body = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=iso-8859-1\r\n\r\n".encode(), "caf\xe9 \xff\x00".encode("latin-1")
    record = lambda url: warc.arc_header(1, url, "1.2.3.4", "19970101", "text/html", len(head + body)).encode() + b"\n" + head + body + b"\n"
    (tmp_path / "arc").mkdir()
    (tmp_path / "arc" / "old.arc.gz").write_bytes(gzip.compress(warc.arc_filedesc(1, "old.arc", "19970101").encode() + b"\n" + record("http://a/") + record("http://b/")))
    arc, out = f"file://{tmp_path}/arc", f"file://{tmp_path}/warc"
    warc.convert(spark, arc, out, prefer="url")
    rows = {r.uri: r for r in warc.read_warc(spark, out).collect()}
    assert (rows["http://b/"].record_type, rows["http://a/"].record_type) == ("response", "revisit")
    assert bytes(rows["http://b/"].payload) == body and rows["http://a/"].refers_to == rows["http://b/"].record_id
    assert rows["http://b/"].date == "1997-01-01T00:00:00Z" and rows["http://b/"].payload_digest == warc.sha1_base32(body)
    pages = spark.createDataFrame([(1, "http://c/", bytearray(body))], "page_id long, url string, html binary")
    warc.write_arc(pages, f"file://{tmp_path}/arc2")
    assert [bytes(r.payload) for r in warc.read_arc(spark, f"file://{tmp_path}/arc2").collect()] == [body]


def test_files_are_cut_at_a_filedesc(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(warc, "RECORDS", 7)
    pages = spark.range(40).select(F.col("id").alias("page_id"), F.lit("http://x/").alias("url"), F.col("id").cast("string").alias("html")).repartition(1)
    warc.write_arc(pages, f"file://{tmp_path}/arc")
    assert len(list((tmp_path / "arc").glob("*.gz"))) == 7
    assert sorted(int(r.key) for r in warc.read_arc(spark, f"file://{tmp_path}/arc").collect()) == list(range(40))


def test_large_components(spark):
    rng = np.random.default_rng(15)
    rows = [(i, (rng.integers(-5, 6, 3) * 10.0 ** rng.integers(0, 8, 3)).tolist()) for i in range(60)] + [(100, [1e300, 0.0, 1.0]), (101, [-1e300, 1.0, 0.0]), (102, [1.7e308, -1.7e308, 0.0]), (103, [0.0, 0.0, 0.0])]
    whole = lambda v: [min(max(x * 256, -topk.LARGEST), topk.LARGEST) for x in v]
    exact = {i: [int(np.floor(x)) if abs(x) < 2.0**53 else int(x) for x in whole(v)] for i, v in rows}
    vecs = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = topk.top_k(vecs, vecs.where("vec_id % 50 = 0 or vec_id > 99"), 5).collect()
    hold = lambda x: min(max(x, -(1 << 63)), (1 << 63) - 1)
    want = []
    for q in (0, 50, 100, 101, 102, 103):
        best = sorted((-hold(sum(a * b for a, b in zip(exact[q], v, strict=True))), i) for i, v in exact.items() if i != q)[:5]
        want += [(q, r, i, -s) for r, (s, i) in enumerate(best, 1)]
    assert sorted(map(tuple, got)) == sorted(want)


def test_training_is_bounded(spark, monkeypatch):
    monkeypatch.setattr(quality, "SAMPLE_INDICATORS", 200)
    seen = {}
    monkeypatch.setattr(quality, "fit", lambda f, y: seen.update(rows=len(f), size=sum(map(len, f))))
    rows = [(i % 4, f"text {i} " * 5) for i in range(400)]
    quality.train(docs(spark, rows), spark.createDataFrame([(i, i % 2, 0) for i in range(4)], "doc_id long, quality int, toxic int"), sample=30)
    assert 0 < seen["rows"] <= 30 and seen["size"] <= 200


def test_long_texts_teach_by_all_of_them(spark):
    text = "".join(f"<{i:05d}>" for i in range(20_000))
    got = spark.createDataFrame([(1, text), (2, text), (3, "short"), (4, None)], DOCS).select("doc_id", langid.taught(F.col("text"), F.col("doc_id")).alias("t"))
    got = {r.doc_id: r.t for r in got.collect()}
    places = [int(re.search(r"<(\d{5})>", part)[1]) for part in got[1].split("\n")]
    assert len(places) == langid.PIECES and all(i * 2000 <= p < (i + 1) * 2000 for i, p in enumerate(places)) and got[1] != got[2]
    assert len(got[1]) <= langid.SAMPLE_CHARS + langid.PIECES and got[3] == "short" and got[4] is None


def test_large_bodies_and_lists_in_groups(spark, tmp_path, monkeypatch):
    """Bodies of every class of size, 50 MB included; lists of revisits in one broadcast, in several and by a shuffle give the same records."""
    rows = [(i, f"http://h/{i}", "a" * (i % 3)) for i in range(30)] + [(100 + i, "http://big/[x]*", "é" * 400_000) for i in range(2)] + [(200, "u", "b" * 2_000_000), (201, None, "c" * 50_000_000), (202, "u", None)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3)
    monkeypatch.setattr(warc, "RECORDS", 7)
    got = []
    for k, (size, groups) in enumerate(((64 << 20, 16), (200, 16), (200, 1))):
        monkeypatch.setattr(warc, "LISTS_BYTES", size)
        monkeypatch.setattr(warc, "GROUPS", groups)
        arc, out = f"{tmp_path}/arc{k}", f"{tmp_path}/warc{k}"
        warc.write_arc(pages, arc)
        warc.convert(spark, arc, out)
        back = warc.read_warc(spark, out)
        got.append(sorted((r.key, r.record_type, r.payload_bytes, r.payload_digest) for r in back.select("key", "record_type", "payload_bytes", "payload_digest").collect()))
        assert back.where("payload_bytes = 50000000").select(F.length("payload").alias("n")).first().n == 50_000_000
        sizes = [os.path.getsize(f"{arc}/{x}") for x in os.listdir(arc) if x.endswith(".gz")]
        assert len(sizes) >= 7
    assert got[0] == got[1] == got[2] and len(got[0]) == len(rows)
    want = {}
    for i, _, t in rows:
        want.setdefault(t or "", []).append(i)
    assert {r[0] for r in got[0] if r[1] == "response"} == {str(max(x)) for x in want.values()}
