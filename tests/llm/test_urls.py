"""URL filters against a plain computation over dicts, and against SQL where there are links between hosts."""

import random
import re

import compare
import duckdb
from conftest import plan_of
from pyspark.sql import functions as F

from tidelog.llm import sql, urls

SCHEMA = "page_id bigint, url string, html string, host string, path string, n bigint, `from` string, kind string"


def pages():
    rng = random.Random(2)
    hosts = ["a.com", "www.example.com", "x.www.example.com", "b.example.com", "c.net", "d.net", "e.org", "f.org", "g.org", "h.org"]
    hosts += [f"n{i}.org" for i in range(12)]
    rows = []
    for i in range(150):
        host = rng.choice(hosts[:4] * 2 + hosts)
        url = f"{rng.choice(['http', 'https'])}://{host}/{rng.choice(['en', 'es', 'fr', 'de'])}/{i}?q=://z.net/es/#t"
        links = []
        for _ in range(rng.randint(0, 4)):
            to = rng.choice(hosts)
            form = rng.choice(['<a href="http://{}/en/1">', "<A HREF='//{}/es/2?x'>", "<a href=https://{}#x>", '<a href="/local">'])
            links.append(form.format(to))
        rows.append((i, url, "<p>" + " ".join(links) + "text http://e.org/x</p>"))
    rows += [
        (900, None, '<a href="http://e.org/">'), (901, "no address", None), (902, "HTTP://A.COM", None), (903, "ftp://net/es/", ""),
        (904, "http://É.COM/x", None), (905, "http://a.com/\nline?x", None), (906, "://com/", None), (907, "http:///en/", None),
        (908, "http://bexample.com/en/", None), (909, "http://example.com/en/é", None), (None, "http://lost.org/", None), rows[0], rows[0],
    ]
    return [(*r, "x", "y", 1, "z", "k") for r in rows]


def brute(rows):
    address = re.compile(r"^.*?://([^/?#]*)([^?#]*)", re.DOTALL)

    def split(url):
        found = address.match(url or "")
        if not found:
            return "", ""
        return "".join(c.lower() if "A" <= c <= "Z" else c for c in found[1]), found[2]

    def ruled(host, path):
        best = (0, None, None)
        for verdict, rule in urls.RULES:
            r_host, r_path = rule.split("/", 1)
            if (host == r_host or host.endswith("." + r_host)) and path.startswith("/" + r_path) and len(rule) > best[0]:
                best = len(rule), rule, verdict
        return best[1:]

    met, pairs = {}, {}
    for _, url, html, *_ in rows:
        own = split(url)
        met.setdefault(own[0], []).append(ruled(*own)[1])
        for link in re.findall(urls.LINK, html or ""):
            to = split("http:" + link if link.startswith("//") else link)
            met.setdefault(to[0], []).append(ruled(*to)[1])
            if own[0] and to[0] and own[0] != to[0]:
                pairs[own[0], to[0]] = pairs.get((own[0], to[0]), 0) + 1
    met.pop("", None)

    def rank(verdict, edges):
        seed = {host: got.count(verdict) / len(got) for host, got in met.items()}
        score = {host: 0.15 * s for host, s in seed.items()}
        sent = {}
        for (a, _), n in edges.items():
            sent[a] = sent.get(a, 0) + n
        for _ in range(200):
            new = {host: 0.15 * s for host, s in seed.items()}
            for (a, b), n in edges.items():
                new[b] += 0.85 * score[a] * n / sent[a]
            score = new
        return score

    trust = rank("allow", pairs)
    distrust = rank("block", {(b, a): n for (a, b), n in pairs.items()})
    found = []
    for page_id, url, *_ in rows:
        host, path = split(url)
        rule, verdict = ruled(host, path)
        by_links = "block" if host and round(distrust[host], 8) > round(trust[host], 8) else "allow"
        found.append((page_id, host, path, rule, verdict or by_links))
    return found


def in_order(rows):
    return sorted(map(tuple, rows), key=lambda r: tuple(map(str, r)))


def test_against_brute_force(spark):
    rows = pages()
    found = urls.url_report(spark.createDataFrame(rows, SCHEMA).repartition(3))
    assert found.columns == ["page_id", "host", "path", "rule", "verdict"]
    expected = in_order(brute(rows))
    assert in_order(found.collect()) == expected
    # Hosts that no rule decides are judged both ways.
    assert {v for _, h, _, r, v in expected if r is None and h.endswith(".org")} == {"allow", "block"}


def test_against_sql_with_links_between_hosts(spark, tmp_path):
    docs = spark.createDataFrame(pages(), SCHEMA).select("page_id", "url", "html")
    docs.write.parquet(str(tmp_path / "pages"))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW pages AS SELECT * FROM read_parquet('{tmp_path}/pages/*.parquet')")
    assert compare.difference(urls.url_report(docs), con, sql.oracle_sql()["op12_url_filters"]) is None


def test_distrust_goes_back_and_trust_goes_on(spark):
    rows = [
        (1, "http://good.com/x", '<a href="http://friend.org/">'), (2, "http://friend.org/", '<a href="http://second.org/">'),
        (3, "http://second.org/", ""), (4, "http://bad.net/es/", '<a href="http://victim.org/">'), (5, "http://victim.org/", ""),
        (6, "http://pointer.org/", '<a href="http://bad.net/es/">'), (7, "http://behind.org/", '<a href="http://pointer.org/">'),
    ]
    found = urls.url_report(spark.createDataFrame(rows, "page_id int, url string, html string"))
    verdicts = {r["page_id"]: r["verdict"] for r in found.collect()}
    assert verdicts == {1: "allow", 2: "allow", 3: "allow", 4: "block", 5: "allow", 6: "block", 7: "block"}


def test_empty_and_native(spark):
    empty = spark.createDataFrame([], "page_id bigint, url string, html string")
    assert urls.url_report(empty).collect() == []
    plan = plan_of(urls.url_report(spark.createDataFrame(pages(), SCHEMA)))
    assert "Python" not in plan and "Arrow" not in plan and "Cartesian" not in plan and "NestedLoop" not in plan
    only_urls = plan_of(urls.url_report(spark.createDataFrame(pages(), SCHEMA).select("page_id", "url", F.lit(None).cast("string").alias("html"))))
    assert "Python" not in only_urls
