import math
import re
import zlib
from collections import Counter

import pytest
import regex
from pyspark.sql import functions as F

from groundcheck.llm import queries, urlfilter


def parse(url):
    url = url or ""
    if "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = re.match("[^/?#]*", rest).group()
    path = re.match("[^?#]*", rest[len(host) :]).group()
    return "".join(c.lower() if c.isascii() else c for c in host), path


def ruled(host, path):
    fits = [r for r in queries.RULES if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
    best = max(fits, key=lambda r: len(r.name), default=None)
    return best and best.name, best and best.verdict


def visible(html):
    return re.sub(r"(?is)<(script|style)\b.*?</\1\s*>|<[^>]*>", " ", html or "").lower()


def runs(text):
    return [regex.sub(r"\p{N}", "0", r) for r in regex.findall(r"\p{L}+|\p{N}+", text.lower())]


def brute_split(run, counts, total):
    """Recursion over all last words, unlike the operator's forward relaxation."""
    known = {0: (0.0, [])}
    cost = lambda w: math.log(max(total, 1)) - math.log(counts[w]) if counts[w] else math.log(max(total, 1)) + (len(w) - 1) * math.log(10)
    for end in range(1, len(run) + 1):
        choices = [(known[b][0] + cost(run[b:end]), b) for b in range(end)]
        least = min(c for c, _ in choices)
        b = next(b for c, b in choices if c <= least + 1e-9)
        known[end] = (choices[b][0], known[b][1] + [run[b:end]])
    return known[len(run)][1]


class Brute:
    def __init__(self, pages, seeds):
        self.seeds = set(seeds)
        self.words = Counter(w for _, html in pages for w in regex.findall(r"\p{L}+", visible(html)))
        self.total = sum(self.words.values())
        self.cut = {}
        self.counts, self.pages = {True: Counter(), False: Counter()}, Counter()
        for url, html in pages:
            host, path = parse(url)
            if host:
                bad = bool(self.seeds & set(regex.findall(r"\p{L}+", visible(html))))
                self.pages[bad] += 1
                self.counts[bad].update(self.tokens(host, path))

    def tokens(self, host, path):
        out = []
        for run in runs(host):
            if run[0] != "0" and len(run) <= 63:
                if run not in self.cut:
                    self.cut[run] = brute_split(run, self.words, self.total)
                out += self.cut[run]
            else:
                out.append(run)
        return [t for t in out if t not in self.seeds] + ["/" + t for t in runs(path) if t not in self.seeds]

    def odds(self, url):
        host, path = parse(url)
        if not host:
            return None
        of = {c: sum(n.values()) for c, n in self.counts.items()}
        found = math.log((self.pages[True] + 1) / (self.pages[False] + 1))
        for t in self.tokens(host, path):
            usual = 100 * (self.counts[True][t] + self.counts[False][t]) / sum(of.values())
            if usual:
                found += math.log((self.counts[True][t] + usual) / (of[True] + 100)) - math.log((self.counts[False][t] + usual) / (of[False] + 100))
        return round(found, 9)


def agree(got, pages, brute):
    assert len(got) == len(pages)
    for r in got:
        url = pages[r.id]
        host, path = parse(url)
        name, verdict = ruled(host, path)
        want = brute.odds(url)
        assert (r.host, r.path, r.rule) == (host, path, name)
        assert r.log_odds == (want if want is None else pytest.approx(want, abs=1e-8))
        assert r.verdict == (verdict or ("block" if (want or 0) > 0 else "allow"))


def test_query_equals_brute_force(spark):
    sf = "/root/testdata/sf0.01"
    rows = spark.read.parquet(f"{sf}/pages.parquet").collect()
    brute = Brute([(r.url, r.html) for r in rows], urlfilter.SEEDS)
    pages = spark.read.parquet(f"{sf}/pages.parquet")
    agree(urlfilter.judge(pages, queries.RULES, urlfilter.train(pages)).collect(), {r.page_id: r.url for r in rows}, brute)
    told = {r.page_id: (r.rule, r.verdict) for r in queries.QUERIES["op5_url_filter"](spark, sf).collect()}
    assert len(told) == len(rows) and {v for _, v in told.values()} == {"allow", "block"}


def test_words_are_split_and_no_seed_is_a_token(spark):
    texts = ["cheap win win farm the rapist therapist therapist"] * 9 + ["buy pills now cheap"] * 3
    urls = ["http://cheapwin.org/a/", "http://thefarm.org/b/12"] * 4 + ["http://x.org/"] + ["http://cheappills.org/buy/7"] * 3
    pages = spark.createDataFrame([(i, u, t) for i, (u, t) in enumerate(zip(urls, texts))], "page_id long, url string, html string")
    model = urlfilter.train(pages)
    tokens = {r.token: (r.bad, r.good) for r in model.tokens.collect()}
    assert tokens["cheap"] == (3, 4) and tokens["win"] == (0, 4) and tokens["/buy"] == (3, 0) and tokens["/0"] == (3, 0) and tokens["/00"] == (0, 4)
    assert "pills" not in tokens and "cheappills" not in tokens
    agree(urlfilter.judge(pages, queries.RULES, model).collect(), dict(enumerate(urls)), Brute(list(zip(urls, texts)), urlfilter.SEEDS))
    assert urlfilter.best_split("zzzz" * 15, {}, 1000) == ["zzzz" * 15] and urlfilter.best_split("", {}, 5) == []


def test_held_out_hosts(spark):
    """Trained on three quarters of the hosts, judged on the others by their pages' labels."""
    pages = spark.read.parquet("/root/testdata/sf0.1/pages.parquet")
    fold = F.crc32(urlfilter.host_of(F.col("url"))) % 4
    model = urlfilter.train(pages.where(fold != 2))
    label = {r.page_id: r.bad for r in pages.select("page_id", urlfilter.holds_seed(F.col("html"), urlfilter.SEEDS).alias("bad")).collect()}
    got = urlfilter.judge(pages.where(fold == 2), [], model).collect()
    assert all(zlib.crc32(r.host.encode()) % 4 == 2 for r in got)
    counts = Counter((r.verdict == "block", label[r.id]) for r in got)
    print("held-out hosts, (judged, label) -> pages:", dict(counts))
    assert (counts[True, True] + counts[False, False]) / len(got) > 0.9


def test_edge_rows(spark):
    rows = [(1, None, None), (2, "", ""), (3, "no scheme/x", "<p>cheap win farm</p>"), (4, "HTTP://WWW.CheapCasino.ORG", ""), (4, "HTTP://WWW.CheapCasino.ORG", ""), (5, "a://b.net?x=/", ""), (6, "a://net/\nq", "")]
    rows += [(None, "x://notnet/fr/", "hello"), (8, "x://é.org/fr/" + "z" * 50000, None), (9, f"x://{'q' * 70}.com/", "")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "1 as host", "2 as id", "3 as token", "4 as score")
    got = urlfilter.judge(pages, queries.RULES, urlfilter.train(pages)).collect()
    assert len(got) == len(rows)
    agree({r.id: r for r in got}.values(), {i: u for i, u, _ in rows}, Brute([(u, h) for _, u, h in rows], urlfilter.SEEDS))
    by = {r.id: r for r in got}
    assert (by[1].host, by[1].path, by[1].verdict) == (by[2].host, by[3].host, by[2].verdict) == ("", "", "allow")
    assert by[4].host == "www.cheapcasino.org" and by[4].path == ""
    assert by[5].rule is None and by[6].rule == "net/" and by[None].rule is None and by[8].rule == "org/fr/"
    assert urlfilter.judge(pages.limit(0), queries.RULES, urlfilter.train(pages.limit(0))).count() == 0
