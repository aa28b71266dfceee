"""The template tree against a plain Python twin; its verdicts matter."""

import math
import random
import re
from collections import defaultdict

import pytest

from clientele.llm import url_templates
from clientele.llm.common import prepare

DEPTH, SIGMAS = url_templates.DEPTH, url_templates.SIGMAS


def _typed(s):
    s = s.lower()
    s = re.sub(r"[0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12}", "<uuid>", s)
    s = re.sub(r"\b(?=[a-f]*[0-9])[0-9a-f]{12,}\b", "<hash>", s)
    s = re.sub(r"[0-9]{4}-[0-9]{2}-[0-9]{2}", "<date>", s)
    return re.sub(r"[0-9]+", "<n>", s)


def _split(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = re.match(r"[^/?#]*", rest)[0]
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in host), re.match(r"[^?#]*", rest[len(host):])[0]


def _rule(host, path):
    best = None
    for verdict, rule in url_templates.RULES:
        own, _, tail = rule.partition("/")
        if (host == own or host.endswith("." + own)) and path.startswith("/" + tail) and (best is None or len(rule) > len(best[0])):
            best = rule, verdict
    return best


def _differs(hits, of, all_hits, all_of):
    rest_hits, rest = all_hits - hits, all_of - of
    if not of or not rest:
        return "="
    pooled = (all_hits + 1) / (all_of + 2)
    z = (hits / of - rest_hits / rest) / math.sqrt(pooled * (1 - pooled) * (1 / of + 1 / rest))
    return "+" if z > SIGMAS else "-" if z < -SIGMAS else "="


def _twin(urls):
    rows = []
    for url in urls:
        host, path = _split(url)
        fit = _rule(host, path)
        parts = [p for p in path.split("/") if p]
        parts = parts[:DEPTH] + (["/".join(parts[DEPTH:])] if len(parts) > DEPTH else [])
        rows.append({"host": host, "path": path, "fit": fit, "segs": [_typed(p) for p in parts], "steps": ()})
    for d in range(DEPTH + 1):
        nodes = defaultdict(lambda: defaultdict(lambda: [0] * 5))
        for r in rows:
            if len(r["segs"]) > d:
                c = nodes[r["host"], r["steps"]][r["segs"][d]]
                nxt = r["segs"][d + 1] if len(r["segs"]) > d + 1 else None
                for i, x in enumerate((1, r["fit"] is not None, r["fit"] is not None and r["fit"][1] == "block", nxt is None, "<" in (nxt or ""))):
                    c[i] += x
        tokens = {}
        for node, children in nodes.items():
            n, lab, bad, ends, vars_ = (sum(c[i] for c in children.values()) for i in range(5))
            wild = n >= url_templates.WILD_URLS and len(children) > n * url_templates.WILD_RATE and len(children) > 1
            alike = {s: "*" if wild else "~" + _differs(c[2], c[1], bad, lab) + _differs(c[3], c[0], ends, n) + _differs(c[4], c[0], vars_, n)
                     for s, c in children.items()}
            for s, a in alike.items():
                tokens[node, s] = a if a == "*" or list(alike.values()).count(a) > 1 else s
        for r in rows:
            if len(r["segs"]) > d:
                r["steps"] = (*r["steps"], tokens[(r["host"], r["steps"]), r["segs"][d]])
    lab, bad = defaultdict(int), defaultdict(int)
    for r in rows:
        if r["fit"]:
            for key in [(r["host"], r["steps"][:i]) for i in range(len(r["steps"]) + 1)]:
                lab[key] += 1
                bad[key] += r["fit"][1] == "block"
    out = []
    for r in rows:
        s, purity = url_templates.SMOOTHING, 0.5
        for i in range(len(r["steps"]) + 1):
            key = r["host"], r["steps"][:i]
            purity = (lab[key] - bad[key] + s * purity) / (lab[key] + s)
        verdict = r["fit"][1] if r["fit"] else "block" if purity < url_templates.LEAST_PURITY else "allow"
        out.append((r["host"], r["path"], r["fit"] and r["fit"][0], verdict, "/" + "/".join(r["steps"]), round(purity, 9)))
    return out


def _urls():
    rng = random.Random(6)
    urls = [None, "", "no scheme", "http://", "x://net", "https://shop.net?es/", "HTTP://Example.COM/en/", "ftp://a.com/b//c#/d"]
    for i in range(300):
        host = rng.choice(["shop.net", "news.net", "www.example.com", "blog.example.com", "example.com", "a.org", "b.org"])
        first = rng.choice(["es", "fr", "en", "de", f"u{rng.randrange(10 ** 6)}", "item"])
        path = "/".join([first, *[rng.choice(["a", "b", str(rng.randrange(999)), "2024-05-06", "c.html"]) for _ in range(rng.randrange(5))]])
        urls.append(f"https://{host}/{path}" + rng.choice(["", "?q=/es/", "#x"]))
    return urls + urls[20:40]


def test_every_row_equals_the_twin(spark):
    prepare(spark)
    urls = _urls()
    pages = spark.createDataFrame([(i, u, "clash") for i, u in enumerate(urls)], "page_id long, url string, host string")
    got = {r["page_id"]: (r["host"], r["path"], r["rule"], r["verdict"], r["template"], round(r["purity"], 9))
           for r in url_templates.judge(pages).collect()}
    want = dict(enumerate(_twin(urls)))
    assert got == want
    assert any("*" in r[4] for r in got.values()) and any("~" in r[4] for r in got.values())
    free = {r[3] for r in got.values() if r[2] is None}
    assert free == {"allow", "block"}  # the tree decides, not a default


@pytest.mark.parametrize("blocked, verdict", [(12, "block"), (0, "allow")])
def test_unlabelled_branch_follows_its_siblings(spark, blocked, verdict):
    prepare(spark)
    lang = "es" if blocked else "en"
    host = "shop.net" if blocked else "www.example.com"
    urls = [f"http://{host}/{lang}/p{chr(97 + i)}" for i in range(12)] + [f"http://{host}/it/pz", "http://other.org/it/pz"]
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    got = {r["page_id"]: r["verdict"] for r in url_templates.judge(pages).collect()}
    assert got[12] == verdict and got[13] == "allow"  # a host without labels is left alone
