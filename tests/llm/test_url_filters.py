import re

from pyspark.sql import functions as F

from ledgerline.llm import url_filters
from ledgerline.llm.queries import QUERIES, URL_RULES

ODD_URLS = [None, "", "no scheme", "http://", "http://Host.COM", "HTTP://a.b/x?y#z", "x://u://v/w", "http://h?q/r", "http://h#f/r", "http://ÀB.net/es/É",
            "http://net/es/", "http://xnet/es/", "http://www.example.com/en/1", "http://a.example.com/en/1", "http://a\nb/c\nd", "http://h//a//b/"]


def plain(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = re.split("[/?#]", rest, maxsplit=1)[0]
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in host), re.split("[?#]", rest[len(host):], maxsplit=1)[0]


def plain_rule(host, path):
    fits = [r for r in URL_RULES if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
    return max(fits, key=lambda r: len(r.name), default=None)


def judged(spark, rows):
    frame = spark.createDataFrame(rows, "page_id long, url string, bad boolean").withColumns({"host": F.lit(1), "template": F.lit(2)})
    return url_filters.judge(frame, URL_RULES).collect()


def test_parts_and_rules(spark):
    rows = [(i, u, None) for i, u in enumerate(ODD_URLS)] + [(None, None, True), (0, None, None), (99, "http://h/" + "x" * 100_000, None)]
    found = judged(spark, rows)
    assert len(found) == len(rows)
    for r in found:
        url = ODD_URLS[r.page_id] if r.page_id is not None and r.page_id < 99 else None
        if r.page_id != 99:
            assert (r.host, r.path) == plain(url)
        rule = plain_rule(r.host, r.path)
        assert r.rule == (rule.name if rule else None) and (not rule or r.verdict == rule.verdict)


def test_tree_rejects_bad_templates_only(spark):
    rows = [(i, f"http://shop.org/deals/{i}", True) for i in range(40)]
    rows += [(100 + i, f"http://shop.org/help/{i}.html", False) for i in range(40)]
    rows += [(200 + i, f"http://blog.org/{y}/{i}", i % 9 == 0) for y in ("en", "de") for i in range(60)]
    rows += [(900, "http://shop.org/deals/77777", None), (901, "http://shop.org/help/5", None), (902, "http://other.org/x", None)]
    rows += [(1000 + i, f"http://wiki.org/article-of-{'abcdefghij'[i % 10]}{'klmnopqrst'[i // 10 % 10]}/{i}", False) for i in range(100)]
    found = {r.page_id: r for r in judged(spark, rows)}
    assert (found[900].template, found[900].verdict) == ("/deals/*", "block") and found[901].verdict == "allow" and found[902].verdict == "allow"
    assert {found[200 + i].template for i in range(60)} == {"/~/*"}, "languages are alike"
    assert {found[1000 + i].template for i in range(100)} == {"/*/*"}, "rare segments among many are variable"


def test_empty_table(spark):
    assert judged(spark, []) == []


def test_query_counts_repeated_pages(spark, tmp_path):
    spark.createDataFrame([(1, "http://a.org/en/7"), (1, "http://a.org/en/7"), (2, None)], "page_id long, url string").write.parquet(f"{tmp_path}/pages.parquet")
    spark.createDataFrame([(7, 0, 0), (7, 1, 0), (None, 0, 0)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    assert len(QUERIES["op10_url_filters"](spark, str(tmp_path)).collect()) == 3
