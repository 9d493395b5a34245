import random
import re

from millrace.llm import addresses
from millrace.llm.addresses import RULES, VOCABULARY, Vocabulary
from tests.compare import difference, duck, spark_rows

SF = "/root/testdata/sf0.01"


def brute(url, rules=RULES, vocabulary=VOCABULARY):
    url = url or ""
    found = re.match(r"(?s).*?://([^/?#]*)([^?#]*)", url)
    host, path = (found.group(1), found.group(2)) if found else ("", "")
    lower = lambda t: "".join(c.lower() if "A" <= c <= "Z" else c for c in t)
    host = lower(host)
    fit = [(len(h + p), len(h), h + p, v) for h, p, v in rules
           if host and (host == h or host.endswith("." + h)) and path.startswith(p)]
    beside = r"[A-Za-z0-9\u0080-\U0010ffff]"
    alone = [t for t in vocabulary.weights if re.search(rf"(?<!{beside}){re.escape(t)}(?!{beside})", lower(url))]
    weight = sum(vocabulary.weights[t] for t in alone)
    rule, verdict = max(fit)[2:] if fit else (None, "block" if weight >= vocabulary.several else "allow")
    return host, path, rule, verdict, weight, ",".join(sorted(alone))


def judged(spark, urls, **more):
    pages = spark.createDataFrame([("clash", u, i) for i, u in enumerate(urls)], "verdict string, url string, page_id long")
    rows = addresses.filtered(pages, more.pop("rules", RULES), **more).collect()
    return [(r.host, r.path, r.rule, r.verdict, r.weight, r.terms) for r in sorted(rows, key=lambda r: r.page_id)]


def test_against_brute_force(spark):
    rng = random.Random(11)
    bits = ["http://", "HTTPS://", "://", "example.net", "example.com", "a.ORG", "net", "notnet", ".net", "/", "/en/", "/de/",
            "/fr/", "?q=", "#top", "ads", "track", "free", "bets", "XXX", "sexy", "sex", "-", "é", "9", ".", "\n", "adult"]
    urls = [None, "", "no scheme", "http://", "http://x.net", "http://x.net/", "http://ORG/fr/", "http://example.net/en/a",
            "http://example.net/de/", "http://fexample.com/de/", "http://www.example.com/de/q?x", "a://b://c.net/",
            "http://h/é-xxx", "http://h/éxxx", "http://h/free-free-free", "http://h/free_ads", "x" * 100_000 + "/porn"]
    urls += ["".join(rng.choice(bits) for _ in range(rng.randrange(1, 9))) for _ in range(1500)]
    assert judged(spark, urls) == [brute(u) for u in urls]


def test_longest_rule_and_ties(spark):
    rules = (("net", "/", "block"), ("a.net", "/", "allow"), ("net", "/abcd", "block"), ("b.net", "/ab", "allow"),
             ("net", "/abx", "block"), ("abc.net", "/", "allow"))
    urls = ["http://a.net/q", "http://a.net/abcdef", "http://b.net/abcd", "http://b.net/abx", "http://c.a.net/", "http://xa.net/"]
    assert [r[2:4] for r in judged(spark, urls, rules=rules)] == [
        ("a.net/", "allow"), ("net/abcd", "block"), ("b.net/ab", "allow"), ("b.net/ab", "allow"), ("a.net/", "allow"),
        ("net/", "block")]


def test_strict_soft_and_overlapping_terms(spark):
    words = Vocabulary(strict=("bad-site",), soft=("bad", "site", "a", "aa"), several=3)
    urls = ["h://x/bad", "h://x/bad/bad/bad", "h://x/bad/site", "h://x/bad/site/a", "h://x/bad-site", "h://x/a/aa", "h://x/aaa"]
    assert [(r[3], r[4], r[5]) for r in judged(spark, urls, vocabulary=words)] == [
        ("allow", 1, "bad"), ("allow", 1, "bad"), ("allow", 2, "bad,site"), ("block", 3, "a,bad,site"),
        ("block", 5, "bad,bad-site,site"), ("allow", 2, "a,aa"), ("allow", 0, "")]


def test_no_rules_no_words_no_rows(spark):
    nothing = Vocabulary((), ())
    assert judged(spark, ["http://adult.net/"], rules=(), vocabulary=nothing) == [("adult.net", "/", None, "allow", 0, "")]
    pages = spark.createDataFrame([], "page_id long, url string")
    assert addresses.filtered(pages, RULES).count() == 0


def test_repeated_rows_stay(spark):
    pages = spark.createDataFrame([(1, "http://a.net/"), (1, "http://a.net/"), (None, None)], "page_id long, url string")
    got = [(r.page_id, r.rule, r.verdict) for r in addresses.filtered(pages, RULES).collect()]
    assert sorted(got, key=str) == sorted([(1, "net/", "block"), (1, "net/", "block"), (None, None, "allow")], key=str)


def test_whole_table(spark):
    pages = spark.read.parquet(f"{SF}/pages.parquet")
    got = addresses.filtered(pages, RULES)
    assert difference(spark_rows(got), duck(SF, addresses.SQL)) is None
    assert {r.verdict for r in got.filter("rule is null").collect()} == {"allow", "block"}
