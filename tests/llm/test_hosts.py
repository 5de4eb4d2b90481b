import re
from collections import defaultdict

from ferryline.llm.hosts import RULES, Reputation, judge_urls
from ferryline.llm.queries import QUERIES, shared
from ferryline.sources.collections import table

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def split(url):
    m = re.match(r"(?s).*?://([^/?#]*)([^?#]*)", url or "")
    return (m[1].translate(LOWER), m[2]) if m else ("", "")


def rule(host, path):
    fits = [(len(h + p), h + p, k) for k, h, p in RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return max(fits)[1:] if fits else (None, None)


def strength(groups, limits):
    n, bad = sum(g[0] for g in groups), sum(g[1] for g in groups)
    if not n or len(groups) < 2 or n <= len(groups):
        return limits.most_strength
    m = bad / n
    between = sum(a * (b / a - m) ** 2 for a, b in groups) / (len(groups) - 1)
    within = sum(b * (1 - b / a) for a, b in groups) / (n - len(groups))
    size = (n - sum(a * a for a, _ in groups) / n) / (len(groups) - 1)
    return limits.most_strength if between <= within else min(
        limits.most_strength, max(limits.least_strength, size * within / (between - within)))


def brute(pages, outcomes, limits):
    """page -> (host, path, rule, verdict)"""
    at = {p: split(u) for p, u in pages}
    levels = [defaultdict(lambda: [0, 0]) for _ in range(4)]
    names = lambda h: (h, ".".join(h.split(".")[-2:]), h.split(".")[-1] if "." in h else "", "")
    for p, _ in pages:
        if p in outcomes:
            for level, name in zip(levels, names(at[p][0])):
                level[name][0] += 1
                level[name][1] += outcomes[p]
    total = levels[3][""]
    out = {}
    for p, (host, path) in at.items():
        mean = total[1] / total[0] if total[0] else 0.0
        for k in (2, 1, 0):
            s = strength(list(levels[k].values()), limits)
            n, bad = levels[k].get(names(host)[k], (0, 0))
            mean, weight = (bad + s * mean) / (n + s), n + s
        bound = mean - limits.z * (mean * (1 - mean) / (weight + 1)) ** 0.5
        name, verdict = rule(host, path)
        out[p] = (host, path, name, verdict or ("block" if bound > limits.most_bad else "allow"))
    return out


def rows(df):
    return {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in df.collect()}


def test_tables(spark):
    for folder in ("/root/testdata/sf0.001", "/root/testdata/sf0.1"):
        pages = [(r.page_id, r.url) for r in table(spark, folder, "pages").select("page_id", "url").collect()]
        outcomes = {r.doc_id: int(r.quality == 0 or r.toxic == 1) for r in table(spark, folder, "labels").collect()}
        assert rows(QUERIES["op10_url_filters"](spark, folder)) == brute(pages, outcomes, Reputation())


def test_bad_hosts_are_blocked_and_shrunk(spark):
    shared(spark, "hosts")
    pages = [(i, f"http://bad.one.net/{i}") for i in range(60)] + [(100 + i, f"http://good.two.net/{i}") for i in range(60)]
    pages += [(200 + i, f"http://h{i}.three.net/") for i in range(30)] + [(300, "http://new.one.net/"), (301, "HTTP://BAD.one.NET?x")]
    outcomes = {p: int(p < 60) for p, _ in pages if p < 300 and p != 230}
    told = spark.createDataFrame(list(outcomes.items()), "page_id bigint, bad int")
    found = rows(judge_urls(spark.createDataFrame(pages, "page_id bigint, url string"), told))
    assert found == brute(pages, outcomes, Reputation())
    assert found[5][3] == "block" and found[100][3] == "allow" and found[301][:2] == ("bad.one.net", "")


def test_rules_and_odd_rows(spark):
    shared(spark, "hosts")
    urls = ["http://example.org/es/1", "https://a.EXAMPLE.org/en/12?q", "http://notexample.org/es/", "http://x.com/fr/a", "http://x.com/de/",
            "http://xcom/de/", "no url", "", None, "a://b://c/d", "http://h.co.uk:80/p#f", "://", "http://É.example.org/es/"]
    pages = [*enumerate(urls), (None, "http://x.com/de/"), (3, "http://x.com/fr/a")]
    shape = "page_id bigint, url string, host string, n int, bad int, domain string"
    frame = spark.createDataFrame([(*p, "h", 1, 2, "d") for p in pages], shape)
    none = spark.createDataFrame([(None, 1), (1, None)], "page_id bigint, bad int")
    got = judge_urls(frame, none).collect()
    assert len(got) == len(pages)
    for r, url in ((r, dict(pages)[r.page_id]) for r in got if r.page_id is not None):
        host, path = split(url)
        assert (r.host, r.path) == (host, path) and (r.rule, r.verdict) == (rule(host, path)[0], rule(host, path)[1] or "allow")
    assert judge_urls(frame.limit(0), none).count() == 0
