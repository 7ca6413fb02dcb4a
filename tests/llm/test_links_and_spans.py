"""Link targets judged as they stand, offsets in the original text, and the whole pipeline on hostile tables."""

from __future__ import annotations

import random
import re

import numpy as np

from stratum.llm import toxicity, url_filter
from stratum.llm.queries import RULES

HOSTS = ["a.net", "example.net", "www.example.net", "example.com", "m.example.com", "x.org", "y.info", "z.info", "w.info"]
PATHS = ["", "/", "/en/", "/en/p", "/de/", "/de", "/fr/q", "/fr", "/p?utm_source=1", "/p?a=1&ref=2", "/q#top"]


def parts(url):
    host, path = re.match(r"(?s)^.*?://([^/?#]*)([^?#]*)", url).groups()
    return host.lower(), path


def rule_of(url):
    host, path = parts(url)
    fits = [r for r in RULES if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
    return max(fits, key=lambda r: (len(r.text), len(r.host), r.verdict == "allow"), default=None)


def key(url):
    host, path = parts(url)
    query = re.search(r"://[^?#]*\?([^#]*)", url)
    kept = re.sub(r"^&", "", re.sub(r"(?:^|&)(?:utm_[^&]*|ref=[^&]*)", "", query[1])) if query else ""
    return re.sub(r"^(?:www|m)\.", "", host) + path.rstrip("/") + (f"?{kept}" if kept else "")


def brute(pages):
    """Verdicts by search over the link graph."""
    near, known = {}, {}
    for _, url, links in pages:
        for other in [url, *links]:
            known.setdefault(key(other), []).append(rule_of(other))
        for link in links:
            near.setdefault(key(url), set()).add(key(link))
            near.setdefault(key(link), set()).add(key(url))
    out = {}
    for page, url, _ in pages:
        rule = rule_of(url)
        seen, todo = {key(url)}, [key(url)]
        while todo:
            for other in near.get(todo.pop(), ()):
                if other not in seen:
                    seen.add(other)
                    todo.append(other)
        rules = {r.verdict for node in seen for r in known.get(node, []) if r}
        out[page] = rule.verdict if rule else ("block" if rules == {"block"} else "allow")
    return out


def test_verdicts_over_random_link_graphs(spark):
    rng = random.Random(9)
    for round_ in range(3):
        urls = [f"https://{rng.choice(HOSTS)}{rng.choice(PATHS)}" if rng.random() < 0.5 else f"http://n{k % 150}.info/{k % 7}" for k in range(300)]
        pages = []
        for k, url in enumerate(urls):
            links = [rng.choice(urls + ["https://spam.net/", "https://example.com/de/"]) for _ in range(rng.choice([0, 0, 1, 2]))]
            pages.append((k, url, links))
        tags = ['<link rel="canonical" href="{}">', "<META http-equiv=refresh content='0; url={}'>"]
        rows = [(k, url, "<html>" + "".join(rng.choice(tags).format(link) for link in links)) for k, url, links in pages]
        df = spark.createDataFrame(rows, "page_id long, url string, html string")
        assert {r["page_id"]: r["verdict"] for r in url_filter.filter_urls(df, RULES).collect()} == brute(pages), round_


def test_offsets_are_those_of_the_original_text():
    text = "İİİ vile Straße"
    words = [m.group() for m in toxicity.WORD.finditer(text.lower())]
    marks = np.array([1.0 if word == "vile" else 0.0 for word in words])
    assert toxicity._spans(text, marks) == [{"start": 4, "end": 8}]
