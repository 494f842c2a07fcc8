"""Address verdicts, page languages, top-k products and the quality classifier."""

import os
import random

import numpy as np
import pytest

from assay.llm import langid, quality, topk, urls
from assay.llm.queries import CHECK_SQL, QUERIES
from tests.oracle import compare, duck_connection

FOLDER = "/root/testdata/sf0.001"


@pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")
@pytest.mark.parametrize("name", sorted(CHECK_SQL))
def test_query_matches_duckdb(spark, name):
    assert compare(duck_connection(FOLDER), QUERIES[name](spark, FOLDER), CHECK_SQL[name]) is None


def test_rules_hosts_and_paths(spark):
    rows = [
        ("http://A.Example.ORG/en/12?x#y", "a.example.org", "/en/12", "example.org/en/1", "block"),
        ("http://example.org/es/a", "example.org", "/es/a", "example.org/es/", "block"),
        ("http://badexample.org/es/a", "badexample.org", "/es/a", "org/", "allow"),
        ("https://x.com/de/", "x.com", "/de/", "com/de/", "block"), ("https://x.com/fr/1", "x.com", "/fr/1", "com/fr/", "allow"),
        ("https://x.com/den", "x.com", "/den", None, "allow"), ("http://org", "org", "", None, "allow"),
        ("http://b.org?q=/es/", "b.org", "", None, "allow"), ("no scheme", "", "", None, "allow"), (None, "", "", None, "allow"),
        ("a://b://c.org/x", "b:", "//c.org/x", None, "allow"), ("x://ÄB.net/\nfr", "Äb.net", "/\nfr", None, "allow"), ("://", "", "", None, "allow"),
    ]
    pages = spark.createDataFrame([(i, r[0]) for i, r in enumerate(rows)], "page_id long, url string").selectExpr("*", "1 as host", "2 as n", "3 as rule")
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    got = sorted(urls.judge(pages, labels).collect())
    assert [tuple(r) for r in got] == [(i, *r[1:]) for i, r in enumerate(rows)]
    assert urls.judge(pages.limit(0), labels).count() == 0


def test_hosts_of_bad_outcomes_are_blocked(spark):
    pages = [(i, f"http://bad.spam.net/{i}") for i in range(40)] + [(100 + i, f"http://good.fine.net/{i}") for i in range(200)]
    pages += [(500, "http://new.spam.net/"), (501, "http://bad.spam.net/never-labelled"), (100, "http://good.fine.net/0"), (None, "http://bad.spam.net/")]
    labels = [(i, 0, 0) for i in range(40)] + [(100 + i, 1, 0) for i in range(200)] + [(5, None, None), (None, 0, 1), (0, 0, 0)]
    got = urls.judge(spark.createDataFrame(pages, "page_id long, url string"), spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))
    verdicts = {(r.host, r.verdict) for r in got.collect()}
    assert verdicts == {("bad.spam.net", "block"), ("good.fine.net", "allow"), ("new.spam.net", "block")} and got.count() == len(pages)


def posterior(outcomes, host, z=1.645):
    """Lower bound of a host's bad share in plain Python, from (host, bad) pairs; the last two labels are a domain."""
    place = [lambda h: h, lambda h: ".".join(h.split(".")[-2:]), lambda h: h.split(".")[-1]]
    mean = (sum(b for _, b in outcomes) + 1) / (len(outcomes) + 2)
    p = mean
    for of in reversed(place):
        groups = {}
        for h, b in outcomes:
            groups.setdefault(of(h), []).append(b)
        n = len(outcomes)
        between = sum(len(g) * (sum(g) / len(g) - p) ** 2 for g in groups.values()) - (len(groups) - 1) * p * (1 - p)
        size = n - sum(len(g) ** 2 for g in groups.values()) / n
        k = p * (1 - p) / (between / size) - 1 if size > 0 and between > 0 else 10_000.0
        k = max(1.0, min(10_000.0, k))
        mine = groups.get(of(host), [])
        a, b = sum(mine) + k * mean, len(mine) - sum(mine) + k * (1 - mean)
        mean = a / (a + b)
    return mean - z * (a * b / ((a + b) ** 2 * (a + b + 1))) ** 0.5


def test_hosts_without_outcomes_take_the_prior_of_their_domain_suffix_or_all(spark):
    random.seed(3)
    share = {"a.bad.biz": 0.9, "b.bad.biz": 0.8, "c.worse.biz": 0.95, "x.good.net": 0.05, "y.good.net": 0.0, "z.fair.net": 0.2, "one": 0.3}
    outcomes = [(h, int(random.random() < s)) for h, s in share.items() for _ in range(40)]
    fresh = ["new.bad.biz", "new.unseen.biz", "new.good.net", "new.unseen.net", "new.unseen.info", "solo"]
    rows = spark.createDataFrame(outcomes, "host string, bad int")
    hosts = spark.createDataFrame([(h,) for h in fresh + ["a.bad.biz"]], "host string")
    got = {r.host: r for r in urls.host_reputation(rows, hosts=hosts).collect()}
    assert got.keys() == share.keys() | set(fresh)
    for host, r in got.items():
        assert r.bound == pytest.approx(posterior(outcomes, host), abs=1e-9) and r.blocked == (r.bound >= 0.25)
    assert got["new.bad.biz"].blocked and not got["new.good.net"].blocked and got["new.bad.biz"].n == 0
    assert got["new.bad.biz"].bad_share > got["new.unseen.info"].bad_share > got["new.good.net"].bad_share


def test_nothing_is_blocked_where_nothing_is_labelled(spark):
    pages = spark.createDataFrame([(1, "http://a.net/"), (2, None)], "page_id long, url string")
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert {r.verdict for r in urls.judge(pages, labels).collect()} == {"allow"}


def test_domains_below_shared_suffixes(spark):
    hosts = spark.createDataFrame([("x.a.co.uk",), ("a.co.uk",), ("co.uk",), ("x.b.uk",), ("eco.uk",), ("",)], "host string")
    shared = ("uk", "co.uk")
    got = [tuple(r) for r in hosts.select("host", urls.domain_of(hosts.host, shared), urls.suffix_of(hosts.host, shared)).collect()]
    assert got == [
        ("x.a.co.uk", "a.co.uk", "co.uk"), ("a.co.uk", "a.co.uk", "co.uk"), ("co.uk", "co.uk", "co.uk"),
        ("x.b.uk", "b.uk", "uk"), ("eco.uk", "eco.uk", "uk"), ("", "", ""),
    ]


def test_languages_of_pages(spark):
    words = {"en": "the and of that with is was for".split(), "de": "und der die das nicht ein ist mit".split()}
    rng = random.Random(2)
    text = lambda lang, n: " ".join(rng.choices(words[lang], k=n))
    docs = [(i, text(lang, 60), lang) for i in range(40) for lang in words] + [(900, None, "en"), (901, "x", None)]
    page = lambda lang, said, n=60: f'<html lang="{said}"><script>der die das</script><p>{text(lang, n)}</p></html>'
    rows = [(i, f"http://{lang}.site.net/{lang}/{i}", page(lang, lang)) for i in range(30) for lang in words]
    rows += [(100, "http://de.site.net/en/1", page("en", "de")), (101, "http://de.site.net/x", None), (102, None, page("de", "en")), (103, None, None), (None, "", "")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "1 as id", "2 as host", "'q' as lang")
    got = {(r.page_id, r.text_language): r for r in langid.identify(pages, spark.createDataFrame(docs, "doc_id long, text string, lang string")).collect()}
    assert len(got) >= 64
    assert all(r.language == r.declared_language for (i, _), r in got.items() if i is not None and i < 100)
    assert got[100, "en"].language == "en" and got[102, "de"].language == "de" and got[101, None].language == "de"
    none = langid.identify(pages, spark.createDataFrame([], "doc_id long, text string, lang string"))
    assert {r.language for r in none.collect()} == {None}
    assert langid.identify(pages.limit(0), spark.createDataFrame(docs, "doc_id long, text string, lang string")).count() == 0


def test_declared_language_is_found_wherever_the_tag_stands():
    for before in ("", "\n" * 5000, "<!-- " + "licence " * 900 + '<html lang="fr"> -->', "<!DOCTYPE html [" + "<!ENTITY a 'b'>" * 400 + "]>"):
        assert langid.declared_language(before + '<HTML class="x" lang="DE-at"><body>') == "de"
    assert langid.declared_language("<html><script>'<html lang=\"en\">'</script>" + "x" * 9000) is None


def test_new_hosts_take_their_domains_and_suffixes_languages(spark):
    rng = random.Random(4)
    words = {lang: ["".join(rng.choices(letters, k=5)) for _ in range(40)] for lang, letters in (("de", "abcdefg"), ("en", "hijklmn"))}
    text = lambda lang: " ".join(rng.choices(words[lang], k=50))
    docs = [(i, text(lang), lang) for i in range(10) for lang in words]
    pages = [(i, f"http://h{i % 7}.big{i % 3}.com/", text("en")) for i in range(90)] + [(100 + i, f"http://a.firma{i % 4}.de/", text("de")) for i in range(20)]
    pages += [(200 + i, f"http://b.mixed.com/{i}", text("de")) for i in range(20)]
    pages += [(300, "http://new.firma1.de/", None), (301, "http://new.other.de/", ""), (302, "http://c.mixed.com/", None), (303, "http://new.com/", None), (304, "http://x.org/", None)]
    got = langid.identify(spark.createDataFrame(pages, "page_id long, url string, html string"), spark.createDataFrame(docs, "doc_id long, text string, lang string"))
    assert got.count() == len(pages)
    assert {r.page_id: r.language for r in got.filter("page_id >= 300").collect()} == {300: "de", 301: "de", 302: "de", 303: "en", 304: "en"}


def test_every_language_is_modelled(spark):
    rng = random.Random(7)
    docs = [(i, " ".join("".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=6)) for _ in range(3 + i % 2)), f"l{i:03d}") for i in range(300)]
    langs, table = langid.text_model(spark.createDataFrame(docs, "doc_id long, text string, lang string"))
    assert langs == [d[2] for d in docs] and table.shape == (300, langid.BUCKETS)


def test_top_k_against_brute_force(spark, monkeypatch):
    monkeypatch.setattr(topk, "BLOCK_ROWS", 64)
    monkeypatch.setattr(topk, "QUERY_ROWS", 7)
    rng = np.random.default_rng(4)
    vectors = {i: rng.normal(size=8).round(2) for i in range(300)}
    for i in range(280, 300):
        vectors[i] = vectors[280]  # ties
    rows = [(i, [float(x) for x in v]) for i, v in vectors.items()]
    rows += [(400, None), (401, [1.0, None] + [0.0] * 6), (402, [float("nan")] * 8), (403, [float("inf")] * 8), (None, [1.0] * 8), (404, [1.0] * 3)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<float>").selectExpr("*", "1 as id", "2 as rank")
    whole = {i: np.floor(64 * v.astype(np.float32).astype(float)).astype(int) for i, v in vectors.items()}
    want = set()
    for q in range(0, 300, 20):
        scored = sorted((-int(whole[q] @ v), i) for i, v in whole.items() if i != q)[:20]
        want |= {(q, r + 1, i, -s) for r, (s, i) in enumerate(scored)}
    assert {tuple(r) for r in topk.top_k(table).collect()} == want
    assert topk.top_k(table.limit(0)).count() == 0
    few = topk.top_k(spark.createDataFrame(rows[:5], table.select("vec_id", "embedding").schema)).collect()
    assert sorted(r.rank for r in few) == [1, 2, 3, 4]


def test_classifier_rejects_junk_and_keeps_prose(spark):
    rng = random.Random(1)
    vocabulary = ["".join(rng.choices("abcdefghilmnoprstu", k=rng.randrange(2, 9))) for _ in range(400)]
    prose = lambda: " ".join(rng.choices(vocabulary, k=rng.randrange(30, 200))).capitalize() + "."
    junk = [
        lambda: " ".join(w + "***" for w in prose().split()), lambda: prose().upper().replace(" ", "!! ") + "!!",
        lambda: " ".join(w for w in prose().split()[:12] for _ in range(12)), lambda: prose().replace(" ", " | "),
    ]
    rows = [(i, prose(), True) for i in range(300)] + [(1000 + i, rng.choice(junk)(), False) for i in range(60)]
    odd = [(2000, None, False), (2001, "", False), (2002, " \n ", False), (None, prose(), True), (3, rows[3][1], True), (2003, prose() * 200, True)]
    docs = spark.createDataFrame(rows + odd, "doc_id long, text string, good boolean").selectExpr("*", "1 as accepted", "2 as place", "3 as pattern")
    got = quality.classify(docs).collect()
    assert len(got) == len(rows) + len(odd)
    wrong = [r for r in got if r.accepted != r.good]
    assert len(wrong) <= 4 and all(r.doc_id is not None and 1000 <= r.doc_id < 2000 for r in wrong)
    assert quality.classify(docs.limit(0)).count() == 0


@pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")
def test_classifier_on_labels_it_has_not_seen(spark):
    docs, labels = (spark.read.parquet(f"{FOLDER}/{t}.parquet") for t in ("documents", "labels"))
    got = quality.classify(docs).join(labels, "doc_id").select("accepted", "quality").collect()
    right = sum(r.accepted == (r.quality == 1) for r in got)
    assert right >= 0.97 * len(got)


def test_label_model_finds_the_weak_labeller():
    rng = np.random.default_rng(0)
    truth = rng.random(4000) < 0.8
    n = len(quality.LABELLERS)
    right = np.array([0.95, 0.9, 0.9, 0.85, 0.9, 0.95, 0.9, 0.6])
    votes = np.where(rng.random((4000, n)) < right, truth[:, None], ~truth[:, None]).astype(int)
    patterns, counts = np.unique(votes, axis=0, return_counts=True)
    model = quality.LabelModel.fit(patterns, counts)
    found = list(model.accuracies().values())
    assert int(np.argmin(found)) == n - 1 and abs(model.share_good - 0.8) < 0.05
    assert ((model.belief(votes) > 0.5) == truth).mean() > 0.97
