import random

import pytest
from compare import difference, oracle_connection

from llm_fixtures import FOLDER

from shelfwise.llm.queries import LLM_CATALOG, LLM_ORACLE, URL_RULES
from shelfwise.llm.urls import ALLOW, BLOCK, Rule, UrlTrie, judge_urls


def plainly(rules, host, path):
    fits = [r for r in rules if host and (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
    return max(fits, key=lambda r: r.rank, default=None)


def test_trie_finds_the_longest_rule():
    draw = random.Random(3)
    hosts = ["com", "org", "a.com", "b.a.com", "example.org", "x.example.org", "ample.org"]
    paths = ["", "/", "/e", "/en", "/en/", "/en/1", "/en/1/", "//", "/en//x"]
    rules = [Rule(draw.choice([ALLOW, BLOCK]), draw.choice(hosts), draw.choice(paths)) for _ in range(25)]
    trie = UrlTrie(rules)
    for host in [*hosts, "", "com.", "y.b.a.com", "net"]:
        for path in [*paths, "/en/12", "/en/1/2", "/eng", "x"]:
            assert trie.best(host, path) == plainly(rules, host, path), (host, path)


URLS = [
    ("https://WWW.Example.org/en/12?x=/es/", "www.example.org", "/en/12", "example.org/en/1", BLOCK),
    ("http://example.org/en/", "example.org", "/en/", "org/", ALLOW),
    ("http://example.org", "example.org", "", None, ALLOW),
    ("ftp://badexample.org/es/", "badexample.org", "/es/", "org/", ALLOW),
    ("x.com/de/", "", "", None, ALLOW),
    ("a://b://c.com/de/", "b:", "//c.com/de/", None, ALLOW),
    ("https://x.com/de/#a", "x.com", "/de/", "com/de/", BLOCK),
    ("https://X.COM#/de/", "x.com", "", None, ALLOW),
    ("https://İ.com/fr/", "İ.com", "/fr/", "com/fr/", ALLOW),
    ("", "", "", None, ALLOW),
    (None, "", "", None, ALLOW),
    (None, "", "", None, ALLOW),
    ("h://" + "a." * 3000 + "com/de/" + "b" * 9000, "a." * 3000 + "com", "/de/" + "b" * 9000, "com/de/", BLOCK),
]


@pytest.mark.parametrize("chars", [32_000_000, 10])
def test_rows_of_all_kinds(spark, chars):
    pages = spark.createDataFrame([(i, u[0], "old") for i, u in enumerate(URLS)], "page_id int, url string, Rule string")
    got = judge_urls(pages, URL_RULES, trie_chars=chars).orderBy("page_id").collect()
    assert [(r["host"], r["path"], r["rule"], r["verdict"]) for r in got] == [u[1:] for u in URLS]
    assert got[0].asDict().keys() == {"page_id", "url", "host", "path", "rule", "verdict"}


def test_no_pages_and_no_rules(spark):
    pages = spark.createDataFrame([(1, "http://a.b/c")], "page_id int, url string")
    assert judge_urls(pages, []).first()["verdict"] == ALLOW
    assert judge_urls(pages.limit(0), URL_RULES).count() == 0


def test_query_equals_sql(spark):
    got = LLM_CATALOG["op3_url_filter"](spark, FOLDER).toPandas()
    con = oracle_connection(FOLDER)
    con.execute(f"CREATE VIEW pages AS SELECT * FROM '{FOLDER}/pages.parquet'")
    assert difference(got, con.execute(LLM_ORACLE["op3_url_filter"]).df()) is None


def test_sql_on_odd_urls(spark):
    import duckdb
    import pandas as pd

    pages = pd.DataFrame({"page_id": range(len(URLS)), "url": [u[0] for u in URLS]})
    want = duckdb.sql(LLM_ORACLE["op3_url_filter"]).df().sort_values("page_id")
    assert want["host"].tolist() == [u[1] for u in URLS]
    assert [None if pd.isna(x) else x for x in want["rule"]] == [u[3] for u in URLS]
    assert len(pages)
