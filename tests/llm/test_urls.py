"""The URL filter against brute force; its query is also held against SQL (test_oracles.py)."""

import itertools
import math
from collections import Counter

import pytest

from vigil.llm.common import table
from vigil.llm.urls import RULES, UNIT, Rule, judge, op11_urls, segments, viterbi

SCHEMA = "page_id long, url string, html string, host string, rule string, row string"


def slow_split(name, counts, total):
    """The cheapest of all splits; ties: the longest last word, then the longest before it, and so on."""
    def cost(w):
        n = counts.get(w)
        return round(UNIT * (math.log(total) - math.log(n))) if n else round(UNIT * (math.log(total) + (len(w) - 1) * math.log(10)))
    best = None
    for cuts in itertools.product([0, 1], repeat=len(name) - 1):
        at = [0, *(i + 1 for i, c in enumerate(cuts) if c), len(name)]
        words = [name[a:b] for a, b in itertools.pairwise(at)]
        rank = (sum(map(cost, words)), [-len(w) for w in reversed(words)])
        best = min(best or (rank, words), (rank, words))
    return best[1]


@pytest.mark.parametrize("name", ["a", "cheappills", "thepills", "aaaaaa", "thethe", "zzthez", "abababab"])
def test_cheapest_split(name):
    counts = {"the": 50, "cheap": 4, "pills": 3, "pill": 3, "s": 9, "a": 20, "aa": 20, "ab": 5, "abab": 1, "he": 10}
    total = sum(counts.values())
    known = {(i, j): n for i in range(len(name)) for j in range(i + 1, len(name) + 1) if (n := counts.get(name[i:j]))}
    assert viterbi(name, known, total) == slow_split(name, counts, total)


def test_segments(spark):
    names = spark.createDataFrame([(x,) for x in ["cheappills", "cheappills", "x" * 64, "y" * 63, "ab"]], "name string")
    words = spark.createDataFrame([("cheap", 5), ("pills", 5), ("y", 90)], "word string, n long")
    got = {r.name: r.words for r in segments(names, words).collect()}
    assert got["cheappills"] == ["cheap", "pills"] and got["x" * 64] == ["x" * 64] and got["y" * 63] == ["y"] * 63 and got["ab"] == ["ab"]
    assert segments(names, words.limit(0)).count() == 4


def test_learned_verdicts(spark):
    """Words of blocked hosts block hosts that hold them run together, however the URL counts are spread over hosts."""
    def page(i, url):
        return i, url, "<p>casino win garden shop news play</p>", "h", "r", "w"
    rules = [Rule("block", "casino.com", "/"), Rule("block", "win.com", "/"), Rule("allow", "garden.com", "/"), Rule("allow", "news.com", "/"), Rule("allow", "shop.com", "/")]
    rows = [page(i, f"http://{h}.com/p/{i}") for i, h in enumerate(["casino", "win", "garden", "news", "shop"] * 40)]
    rows += [page(1000, "http://casinowin.org/p/1"), page(1001, "http://gardennews.org/p/1"), page(None, "http://shopgarden.org/"), page(1002, None)]
    rows += [page(2000, "http://wincasino.org/p/2")] * 300      # a hot host, of equal rows
    got = judge(spark.createDataFrame(rows, SCHEMA).repartition(4), rules).collect()
    verdicts = Counter((r.page_id, r.host, r.rule is None, r.verdict) for r in got if r.page_id is None or r.page_id >= 1000)
    assert verdicts == {(1000, "casinowin.org", True, "block"): 1, (1001, "gardennews.org", True, "allow"): 1, (None, "shopgarden.org", True, "allow"): 1,
                        (1002, "", True, "allow"): 1, (2000, "wincasino.org", True, "block"): 300}
    assert len(got) == len(rows) and all((r.score is None) == (r.rule is not None) for r in got)


def test_longest_rule(spark):
    rules = [Rule("allow", "a.com", "/"), Rule("block", "com", "/x/y"), Rule("block", "b.a.com", "/")]
    rows = [(1, "http://a.com/x/y", None), (2, "http://b.a.com/x/y", None), (3, "http://c.com/x/y/z", None), (4, "http://xa.com/", None)]
    got = {r.page_id: r.rule for r in judge(spark.createDataFrame(rows, "page_id long, url string, html string"), rules).collect()}
    # host and path together, then the host
    assert got == {1: "com/x/y", 2: "b.a.com/", 3: "com/x/y", 4: None}


def test_no_rules_and_no_rows(spark):
    pages = table(spark, "/root/testdata/sf0.001", "pages")
    assert {r.verdict for r in judge(pages, []).select("verdict").distinct().collect()} == {"allow"}
    assert judge(pages.limit(0), RULES).count() == 0
    assert op11_urls(spark, "/root/testdata/sf0.001").columns == ["page_id", "host", "path", "rule", "verdict"]
