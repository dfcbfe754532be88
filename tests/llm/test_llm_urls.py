from __future__ import annotations

import math
import re
from collections import Counter

import pytest

from perkline.llm import urls


def brute_rule(url):
    if url is None or "://" not in url:
        return "", "", None, None
    rest = re.split("[?#]", url.split("://", 1)[1])[0]
    host, slash, path = rest.partition("/")
    host, path = re.sub("[A-Z]", lambda m: m[0].lower(), host), slash + path
    best = None
    for verdict, rule in urls.RULES:
        name, _, start = rule.partition("/")
        if (host == name or host.endswith("." + name)) and path.startswith("/" + start):
            if best is None or len(rule) > len(best[1]):
                best = (verdict, rule)
    return host, path, best and best[1], best and best[0]


URLS = [
    None, "", "no scheme", "://", "http://", "https://ORG/", "http://org", "http://a.org/x?y#z", "http://aorg/",
    "http://Sub.Example.ORG/es/1", "http://example.org/es", "https://example.org/en/12", "https://example.org/en/2",
    "http://x.com/fr/", "http://com/de/a", "http://x.com?de/", "http://x.com#/fr/", "a://b://c.org/", "http://É.org/É",
    "http://user@x.org:80/p", "http://x.net/line\nbreak", "http://x.com/de/" + "long/" * 3000,
]


def test_host_path_and_rule(session):
    df = session.createDataFrame([(i, u, "x") for i, u in enumerate(URLS)], "page_id long, url string, rule string")
    got = {r["page_id"]: (r["host"], r["path"], r["rule"], r["ruled"]) for r in urls.apply_rules(df).collect()}
    assert got == {i: brute_rule(u) for i, u in enumerate(URLS)}


@pytest.fixture(scope="module")
def web():
    rows = []
    for i in range(400):
        rows.append(f"http://site{i % 9}.org/good/article-{i}")
        rows.append(f"http://shop{i % 9}.com/de/casino-bonus-{i}")
    rows += [f"http://site{i}.net/good/article-{i}" for i in range(40)]
    rows += [f"http://shop{i}.net/casino-bonus-{i}" for i in range(40)]
    return rows


def brute_scores(judged, order=urls.ORDER):
    """Difference per character for every URL, from plain counts."""

    def windows(url):
        text = urls.BEGIN * order + (url.split("://", 1)[1] if "://" in url else url) + urls.END
        return [text[i : i + order + 1] for i in range(len(text) - order)]

    grams = {"allow": Counter(), "block": Counter()}
    contexts = {"allow": Counter(), "block": Counter()}
    for url, ruled, learns in judged:
        if ruled and learns:
            for w in windows(url):
                for k in range(order + 1):
                    grams[ruled][(k, w[order - k :])] += 1
                    contexts[ruled][(k, w[order - k : order])] += 1

    def log_p(kind, w):
        p = 1 / urls.ALPHABET
        for k in range(order + 1):
            p = (grams[kind][(k, w[order - k :])] + urls.TRUST * p) / (contexts[kind][(k, w[order - k : order])] + urls.TRUST)
        return math.log(p)

    return {
        url: sum(log_p("allow", w) - log_p("block", w) for w in windows(url)) / len(windows(url)) for url, _, _ in judged
    }


def test_scores_equal_brute_force_and_sort_the_rest(session, web):
    from pyspark.sql import functions as F

    df = session.createDataFrame(list(enumerate(web)), "page_id long, url string").repartition(4)
    got = {r["url"]: r for r in urls.judge_urls(df).collect()}
    folds = {r[0]: r[1] for r in df.select("url", F.pmod(F.xxhash64("url"), F.lit(urls.FOLDS))).collect()}
    want = brute_scores([(u, brute_rule(u)[3], folds[u] != 0) for u in web])
    assert all(got[u]["score"] == pytest.approx(want[u], abs=1e-9) for u in web)
    assert all(got[u]["verdict"] == ("allow" if "good" in u else "block") for u in web)


@pytest.mark.parametrize("hot", [1, 30, 10**9])
def test_frequent_windows_joined_apart_change_no_score(session, web, monkeypatch, hot):
    df = session.createDataFrame(list(enumerate(web)), "page_id long, url string").repartition(4)
    want = {r["page_id"]: (r["score"], r["verdict"]) for r in urls.judge_urls(df).collect()}
    monkeypatch.setattr(urls, "HOT", hot)  # none, some and all of them
    got = {r["page_id"]: r for r in urls.judge_urls(df).collect()}
    assert got.keys() == want.keys()
    assert all((pytest.approx(score, abs=1e-9), verdict) == (got[i]["score"], got[i]["verdict"]) for i, (score, verdict) in want.items())


def test_own_columns_stay(session, web):
    names = ["_url", "_ruled", "ruled", "window", "difference", "_key", "_text", "_at", "rows", "seen", "a.b"]
    df = session.createDataFrame([(u, *names) for u in web], ["url", *names])
    got = urls.judge_urls(df).collect()
    assert len(got) == len(web) and all([r[n] for n in names] == names for r in got)
    assert {r["verdict"] for r in got} == {"allow", "block"}


def test_odd_rows(session):
    rows = [(i, u) for i, u in enumerate(URLS)] + [(None, "http://a.org/"), (3, "http://a.org/"), (3, "http://a.org/")]
    got = urls.judge_urls(session.createDataFrame(rows, "page_id long, url string")).collect()
    assert len(got) == len(rows)
    assert all(r["verdict"] in ("allow", "block") for r in got)
    assert urls.judge_urls(session.createDataFrame([], "page_id long, url string")).count() == 0
    unruled = session.createDataFrame([(1, "http://x.net/"), (2, None)], "page_id long, url string")
    assert [r["verdict"] for r in urls.judge_urls(unruled).collect()] == ["allow", "allow"]
