"""URL parts, rules and posteriors against plain Python; the SQL twin on whole tables."""

from __future__ import annotations

import math
import re
from collections import defaultdict

from tillroll.llm import host_reputation as h
from tillroll.llm.queries import RULES
from tillroll.llm.store import table
from tillroll.oracle.compare import duck_connection


def parts(url):
    if not url or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = re.match("[^/?#]*", rest).group()
    path = re.match("[^?#]*", rest[len(host):]).group()
    return re.sub("[A-Z]", lambda x: x.group().lower(), host), path


def brute(rows):
    seen = []
    for page, url in rows:
        host, path = parts(url)
        fit = [r for r in RULES if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
        seen.append((page, host, path, max(fit, key=lambda r: len(r.name), default=None)))
    count = defaultdict(lambda: [0, 0])
    for _, host, _, rule in seen:
        c = count[host]
        if rule:
            c[0] += 1
            c[1] += rule.verdict == "allow"
    up = lambda host: ".".join(host.split(".")[-2:])

    def strength(groups):
        groups = [g for g in groups if g[0] > 0]
        seen_ = sum(n * (k / n - m) ** 2 for n, k, m in groups)
        plain = sum(m * (1 - m) for n, k, m in groups)
        spread = sum(m * (1 - m) * (n - 1) for n, k, m in groups)
        rho = min(max((seen_ - plain) / spread if spread else 0.001, 0.001), 0.999)
        return (1 - rho) / rho

    total = [sum(c[i] for c in count.values()) for i in (0, 1)]
    mean = {"": (total[1] + 0.5) / (total[0] + 1)}
    parent = {0: lambda x: "", 1: lambda x: x.split(".")[-1], 2: lambda x: up(x)}
    for level, of in enumerate((lambda x: x.split(".")[-1], up, lambda x: x)):
        groups = defaultdict(lambda: [0, 0])
        for host, c in count.items():
            for i in (0, 1):
                groups[of(host)][i] += c[i]
        prior = {g: mean[parent[level](g)] for g in groups}
        s = strength([(c[0], c[1], prior[g]) for g, c in groups.items()])
        mean = {g: (s * prior[g] + c[1]) / (s + c[0]) for g, c in groups.items()}
    out = []
    for page, host, path, rule in seen:
        p, w = mean[host], s + count[host][0]
        by_host = "block" if p + 1.645 * math.sqrt(p * (1 - p) / (w + 1)) < 0.5 else "allow"
        out.append((page, host, path, rule.name if rule else None, rule.verdict if rule else by_host))
    return out


def test_whole_table_against_brute_force_and_sql(spark):
    pages = table(spark, "/root/testdata/sf0.1", "pages")
    got = sorted(tuple(r) for r in h.judge(pages, RULES).collect())
    want = sorted(brute([(r["page_id"], r["url"]) for r in pages.collect()]))
    assert got == want
    assert sorted(duck_connection("/root/testdata/sf0.1").sql(h.judge_sql(RULES)).fetchall()) == want
    assert {r[4] for r in want if r[3] is None} <= {"allow", "block"}


def test_bad_hosts_are_blocked_by_their_record(spark):
    rows = [(k, f"https://bad.example.com/de/{k}") for k in range(40)] + [(100 + k, f"https://good.com/fr/{k}") for k in range(40)]
    rows += [(200, "https://bad.example.com/en/1"), (201, "https://good.com/en/1"), (202, "https://new.net/en/")]
    got = {r["page_id"]: r["verdict"] for r in h.judge(spark.createDataFrame(rows, "page_id long, url string"), RULES).collect()}
    assert (got[200], got[201], got[202]) == ("block", "allow", "allow")


def test_hard_rows(spark):
    urls = ["", None, "no scheme", "http://", "http://HOST.Org", "http://HOST.Org/?a://b", "x://a.example.org/es/#f", "://org/",
            "https://example.org/en/1x", "https://ORG/en", "https://notorg/en", "ftp://u@É.com:80/fr/?q", "a\nb://c.com/de/\nx?y",
            "http://a//b://c", "http://com/fr", "https://..org//"]
    rows = [(k, u) for k, u in enumerate(urls)] + [(0, ""), (None, "http://a.net/")]
    pages = spark.createDataFrame([r + (1.0, "h", "v") for r in rows],
                                  "page_id long, url string, n double, host string, verdict string")
    got = sorted((tuple(r) for r in h.judge(pages, RULES).collect()), key=str)
    assert got == sorted(brute(rows), key=str)
    assert h.judge(pages.limit(0), RULES).count() == 0
