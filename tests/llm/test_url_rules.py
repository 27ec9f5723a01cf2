import random

from clickcohort.llm import url_rules
from clickcohort.llm.queries import RULES


def brute(url, rules):
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    end = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
    host = rest[:end].translate({i: i + 32 for i in range(65, 91)})
    tail = rest[end:]
    path = tail[:min([tail.find(c) for c in "?#" if c in tail], default=len(tail))]
    fits = [(-len(h + p), v != "block", h + p, v) for v, h, p in rules
            if (not h or host == h or host.endswith("." + h)) and path.startswith(p)]
    best = min(fits, default=None)
    return host, path, best and best[2], best[3] if best else "allow"


def test_against_brute_force(spark):
    rng = random.Random(3)
    hosts = ["com", "example.com", "WWW.Example.com", "a.net", "xcom", "shop.example.com:80",
             "net", "example.company", "", "u@x.com", "ü.net"]
    paths = ["", "/", "/en/", "/en", "/es/x", "/fr/?a=/es/", "?q=/", "#/en/", "/en/a?b#c", "/x//y"]
    urls = [f"{rng.choice(['http://', 'HTTPS://', '', 'a://b://'])}{h}{p}" for h in hosts
            for p in paths] + [None, "", "://", "no scheme", "http://com/\nx"]
    rules = [*RULES, ("block", "", "/x/"), ("block", "net", "/e"), ("allow", "a.net", "/"),
             ("block", "com", "/en/a")]
    frame = spark.createDataFrame([(i, u, "h", "v") for i, u in enumerate(urls)] + [
        (None, urls[3], "h", "v")], "page_id bigint, url string, host string, rule string")
    for given in (RULES, rules):
        out = url_rules.judge(frame, given).collect()
        assert len(out) == len(urls) + 1
        for row in out:
            url = urls[3 if row["page_id"] is None else row["page_id"]]
            assert (row["host"], row["path"], row["rule"], row["verdict"]) == brute(url, given)


def test_rules_lie_under_their_rarest_token(spark):
    urls = spark.createDataFrame(
        [("a.example.com", "/en/x"), ("b.example.com", "/de/"), ("c.com", "/en/")],
        "host string, path string")
    index = {r["rule"]: r["token"] for r in url_rules.rule_index(
        urls, [("block", "example.com", "/en/"), ("allow", "com", "/"), ("allow", "", "/")]
    ).collect()}
    assert index == {"example.com/en/": "h:example", "com/": "h:com", "/": "*"}


def test_no_pages_or_no_rules(spark):
    frame = spark.createDataFrame([], "page_id bigint, url string")
    assert url_rules.judge(frame, RULES).count() == 0
    one = spark.createDataFrame([(1, "http://a.net/es/")], "page_id bigint, url string")
    assert url_rules.judge(one, []).first()["verdict"] == "allow"
