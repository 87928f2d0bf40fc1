from collections import Counter
from itertools import combinations

from pyspark.sql import functions as F

from subtally.llm import urls
from subtally.llm.queries import URL_RULES, op4_url_filters

RULES = [("allow", "org", "/"), ("block", "example.org", "/es/"), ("block", "example.org", "/en/1"), ("allow", "com", "/fr/"), ("block", "com", "/de/")]
HARD = [
    None,
    "",
    "no scheme at all/path",
    "http://",
    "http://HOST.Example.ORG",
    "http://example.org?x=/es/#/es/",
    "http://example.org/es/?q=1#f",
    "https://a.b.example.org/en/1",
    "https://notexample.org/es/1",
    "https://xorg/es/",
    "https://É.COM/fr/é#x",
    "a://b://c/d",
    "http://h#x/y?z",
    "http://com/de/" + "x/" * 3000,
    "http://user@x.com:80/de/1?a=1&a=2&b",
    " http://example.org/ ",
]


def brute_parts(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    cut = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
    host, rest = rest[:cut], rest[cut:]
    end = min([rest.find(c) for c in "?#" if c in rest], default=len(rest))
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host), rest[:end]


def brute_rule(host, path):
    fits = [(len(h + p), h + p, v) for v, h, p in RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return max(fits)[1:] if fits else (None, None)


def brute_mined(rows, support, confidence):
    """Rules {tokens: ...} -> verdict counted over all subsets of every labelled row."""
    whole, with_verdict = Counter(), Counter()
    for tokens, verdict in rows:
        for n in range(1, len(tokens) + 1):
            for part in combinations(sorted(tokens), n):
                whole[part] += 1
                with_verdict[part, verdict] += 1
    rules = {(t, v): n / whole[t] for (t, v), n in with_verdict.items() if n >= support * len(rows) and n / whole[t] >= confidence}
    return {k: c for k, c in rules.items() if not any((set(t) < set(k[0]) and v == k[1] and d >= c) for (t, v), d in rules.items())}


def test_hosts_paths_and_given_rules(documents):
    docs = documents([(i, u, "clash", i) for i, u in enumerate(HARD)] + [(None, HARD[6], None, None), (6, HARD[6], None, None)], "page_id bigint, url string, host string, tokens int")
    found = urls.filter_urls(docs, URL_RULES).collect()
    assert len(found) == len(HARD) + 2
    for row in found:
        url = HARD[6 if row.page_id is None else row.page_id]
        assert (row.host, row.path) == brute_parts(url)
        name, verdict = brute_rule(row.host, row.path)
        assert row.rule == name
        assert row.verdict in ("allow", "block") if verdict is None else row.verdict == verdict


def test_every_verdict_of_a_whole_table_by_brute_force(spark, sf_dir):
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    found = {r.page_id: r for r in op4_url_filters(spark, sf_dir).collect()}
    host, path = urls.host_and_path()
    described = pages.select("page_id", "url", host.alias("host"), path.alias("path")).select("*", urls.tokens().alias("tokens")).collect()
    labelled = [(r.tokens, brute_rule(r.host, r.path)[1]) for r in described if brute_rule(r.host, r.path)[0]]
    mining = urls.Mining()
    rules = brute_mined(labelled, mining.min_support, mining.min_confidence)
    assert len(found) == len(described) and rules
    counts = Counter()
    for row in described:
        name, verdict = brute_rule(row.host, row.path)
        own = found[row.page_id]
        if name is None:
            fits = [(c, t, v) for (t, v), c in rules.items() if set(t) <= set(row.tokens)]
            best = max((f[0] for f in fits), default=None)
            sure = {v for c, _, v in fits if c == best}
            assert own.verdict == "allow" if not fits else own.verdict in sure
            counts[bool(fits)] += 1
        assert own.rule == name and (name is None or own.verdict == verdict)
    assert counts[True] > 0


def test_mined_rules_are_pruned(spark):
    rows = [(["a=1", "b=1"], "block")] * 30 + [(["a=1", "b=2"], "block")] * 30 + [(["c=1", "b=1"], "allow")] * 40 + [(["d=1"], "allow")]
    frame = spark.createDataFrame(rows, "tokens array<string>, verdict string")
    found = {(tuple(r.tokens), r.verdict): round(r.confidence, 9) for r in urls.mine(frame, urls.Mining(0.05, 0.9)).collect()}
    want = brute_mined(rows, 0.05, 0.9)
    assert found == {k: round(c, 9) for k, c in want.items()}
    assert (("a=1",), "block") in found and (("a=1", "b=1"), "block") not in found


def test_no_rules_no_pages(documents):
    schema = "page_id bigint, url string"
    assert urls.filter_urls(documents([], schema), URL_RULES).count() == 0
    docs = documents([(1, "http://a.net/x"), (2, None)], schema, "unlabelled")
    assert {(r.page_id, r.verdict) for r in urls.filter_urls(docs, URL_RULES).collect()} == {(1, "allow"), (2, "allow")}
    assert {r.verdict for r in urls.filter_urls(docs, [], default="block").collect()} == {"block"}


def test_a_page_has_few_tokens_whatever_its_length(documents):
    docs = documents([(1, "https://a.b.c.example.org/" + "seg/" * 500 + "?" + "&".join(f"k{i}=1" for i in range(300)) + "#f")], "page_id bigint, url string")
    host, path = urls.host_and_path()
    row = docs.select("url", host.alias("host"), path.alias("path")).select(urls.tokens().alias("t"), F.lit(1)).first()
    assert len(row.t) == len(set(row.t)) <= 9
