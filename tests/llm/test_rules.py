"""Quality rules and URL filters: their SQL is compared in test_queries, odd rows and plans here."""

import random
import re
from collections import Counter

from cellframe.llm import quality_rules, url_filter


def repeated(words):
    windows = Counter(tuple(words[i:i + 3]) for i in range(len(words) - 2))
    return len({i + d for i in range(len(words) - 2) if windows[tuple(words[i:i + 3])] > 1 for d in range(3)})


def test_measures_equal_brute_force(spark):
    random.seed(9)
    docs = []
    for i in range(150):
        words = random.choices(["a", "b", "c|", "d$$", "é", "\n", "\x0b", "\t\n"], k=random.randrange(60))
        docs.append((i, random.choice([" ", "  ", "\r\n"]).join(words)))
    want = {}
    for i, text in docs:
        words = re.findall(r"[^\x20\x09-\x0D]+", text)
        lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
        repeats = repeated(words)
        want[i] = (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)),
                   repeats, len(words) < 50 or 100 * repeats > 50 * len(words))
    rows = quality_rules.judge(spark.createDataFrame(docs, "doc_id long, text string")).collect()
    assert {r.doc_id: tuple(r)[1:7] for r in rows} == want
    assert not any(r.kept and r.base_failed for r in rows)


def test_rules_are_one_projection_without_python(spark, odd_docs):
    plan = quality_rules.judge(odd_docs)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Exchange" not in plan


def test_odd_documents(odd_docs, no_docs):
    got = {r.doc_id: r for r in quality_rules.judge(odd_docs).collect()}
    assert all(got[i].n_words == 0 and got[i].base_failed and not got[i].kept for i in (4, 5, 6))
    assert got[9].n_words == 30_000 and got[9].n_repeat_words == 30_000 and got[9].base_failed
    assert quality_rules.judge(odd_docs).count() == odd_docs.count() and quality_rules.judge(no_docs).isEmpty()


def test_urls(spark):
    urls = ["http://a.COM/x", "HTTPS://www.Example.com/en/1?q=1", "http://m.example.com/en/", "http://x.net/es/y", "http://net/fr/",
            "http://com", "no scheme", None, "http://notcom/", "ftp://a://b.com/?x", "://?#", "http://example.com/en"]
    df = spark.createDataFrame([(i, u, "x", True) for i, u in enumerate(urls)], "page_id long, url string, host string, listed boolean")
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in url_filter.judge(df, df.limit(0)).collect()}
    assert got == {
        0: ("a.com", "/x", "com/", "allow"), 1: ("www.example.com", "/en/1", "www.example.com/en/", "allow"),
        2: ("m.example.com", "/en/", "example.com/en/", "block"), 3: ("x.net", "/es/y", "net/es/", "block"),
        4: ("net", "/fr/", "net/fr/", "block"), 5: ("com", "", None, "allow"), 6: ("", "", None, "allow"),
        7: ("", "", None, "allow"), 8: ("notcom", "/", None, "allow"), 9: ("a:", "//b.com/", None, "allow"),
        10: ("", "", None, "allow"), 11: ("example.com", "/en", "com/", "allow")}
    assert url_filter.judge(df.limit(0), df).isEmpty()


def test_listed_urls_are_found_in_any_form(spark):
    listed = [f"http://www.site{i}.org/p{i}.html?b=2&utm_source=x#top" for i in range(500)]
    pages = [(i, f"https://m.SITE{i}.org/p{i}/?ref=q&b=2") for i in range(1_000)] + [(7, "https://site7.org/p7?b=2"), (2_000, None)]
    df = spark.createDataFrame(pages, "page_id long, url string")
    out = url_filter.judge(df, spark.createDataFrame([(u,) for u in listed], "url string"), rules=())
    assert {r.page_id for r in out.where("verdict = 'block'").collect()} == set(range(500))
    assert out.count() == len(pages)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Cartesian" not in plan and "NestedLoop" not in plan


def test_list_decides_pages_without_a_rule_in_one_scan(spark):
    out = url_filter.query(spark, "/root/testdata/sf0.1")
    decided = out.where("rule IS NULL AND host <> ''").groupBy("verdict").count().collect()
    assert {r.verdict for r in decided} == {"allow", "block"}
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Relation [page_id") == 1


def test_exact_join_beyond_the_broadcast(spark, monkeypatch):
    monkeypatch.setattr(url_filter, "BROADCAST_URLS", 0)
    listed = spark.createDataFrame([(f"http://s{i}.org/{i}",) for i in range(300)], "url string")
    pages = spark.range(900).selectExpr("id AS page_id", "concat('http://s', id, '.org/', id) AS url")
    out = url_filter.judge(pages, listed, rules=())
    assert {r.page_id for r in out.where("listed").collect()} == set(range(300))
    assert out.count() == 900
