"""Quality rules and URL filters against brute force, on small awkward tables."""

import re
import sys
from collections import defaultdict
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
from conftest import SF  # noqa: E402
from oracle import same  # noqa: E402

from textloom.llm import queries, quality_rules, url_filters  # noqa: E402
from textloom.llm.components import components  # noqa: E402

TEXTS = [None, "", " \n\t ", "a b c a b c d", "x x x x x", "one\n\none\n one\none", "é ü\x0b#*$ <b> & | %", "w " * 300, "long " + "z" * 5000]


def brute_rules(rows, limit):
    hosts = defaultdict(set)

    def norm(line):
        return re.sub(r"[\x20\x09-\x0D]+", " ", re.sub("[0-9]", "0", line.lower())).strip(" ")

    for key, text, host in rows:
        for line in {norm(x) for x in (text or "").split("\n")} - {""}:
            hosts[host, line].add((key, text))
    out = []
    for key, text, host in rows:
        text = text or ""
        w = re.findall(r"[^\x20\x09-\x0D]+", text)
        at = defaultdict(list)
        for i in range(len(w) - 2):
            at[tuple(w[i : i + 3])].append(i)
        rep = {i + k for v in at.values() if len(v) > 1 for i in v for k in range(3)}
        lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
        chars = sum(map(len, w))
        bad = len(w) < 50 or 100 * len(rep) > 50 * len(w)
        gone = sum(len(norm(x).replace(" ", "")) for x in text.split("\n") if norm(x) and len(hosts[host, norm(x)]) > limit)
        out.append((key, len(w), chars, len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(rep), bad, gone, not bad and gone * 100 <= chars * 50))
    return out


def test_rules_match_brute_force(spark):
    texts = TEXTS + [" ".join(f"w{i}q{j}" for i in range(60)) + "\nShared line 7" for j in range(4)] + ["\n".join(["Shared  LINE 8 " * 20] + [" ".join(f"v{i}" for i in range(9))])] * 3
    rows = [(i, t, "a" if i % 2 else None) for i, t in enumerate(texts)]
    df = spark.createDataFrame([(*r, "clash", 1) for r in rows], "doc_id long, text string, source string, host string, n_words int")
    got = sorted(tuple(r) for r in quality_rules.rules(df, max_docs_per_line=1).collect())
    assert got == brute_rules(rows, 1)
    assert quality_rules.rules(df.limit(0)).collect() == []


def test_repeated_rows_null_keys_and_cleaned_texts(spark):
    own = lambda n: " ".join(f"n{n}w{i}" for i in range(60))
    shared = "This Line 1 is  shared by several documents of a host"
    rows = [(i, f"{own(i)}\n{shared}\n\nmore {i}\n{shared}", "a") for i in range(4)] + [(9, f"{own(9)}\n{shared}", "b"), (None, f"{own(20)}\n{shared.upper()}", "a"), (2, own(21), "a"), (30, None, "a")]
    rows += [rows[1], rows[1], (40, f"{shared}\n" * 9 + "few words", "a"), (50, f"{own(50)}\n{shared}", None)]
    df = spark.createDataFrame([(*r, 1, "x") for r in rows], "doc_id long, text string, source string, chars int, id string")
    key = lambda r: repr(r)
    got = sorted((tuple(r) for r in quality_rules.rules(df, max_docs_per_line=3).collect()), key=key)
    want = sorted(brute_rules(rows, 3), key=key)
    assert got == want and sum(r[7] > 0 for r in want) == 8
    kept = {(r[0], r[1]) for r in want if r[8]}
    cleaned = quality_rules.clean(df, max_docs_per_line=3)
    assert cleaned.columns == df.columns
    strip = lambda t: "\n".join(x for x in t.split("\n") if "shared by" not in x.lower())
    texts = sorted(((r.doc_id, r.text) for r in cleaned.collect()), key=key)
    assert texts == sorted(((k, strip(t) if h == "a" else t) for k, t, h in rows if t and (k, len(t.split())) in kept), key=key)
    con = __import__("duckdb").connect()
    con.register("documents", df.select("doc_id", "text", "source").toPandas().assign(doc_id=lambda x: x.doc_id.astype("Int64")))
    few = quality_rules.ORACLE.replace("count(*) > 100", "count(*) > 3")
    assert sorted(con.sql(few).fetchall(), key=key) == want
    assert quality_rules.clean(df.limit(0)).collect() == []


def test_rules_match_sql(spark):
    q = queries.REGISTRY.entries["op7_quality_rules"]
    assert same(spark, q.build, q.sql, SF) == 1000


def test_urls(spark):
    rule = url_filters.decode_rules(["net/", "example.com/de/"], ["example.net/en/", "org/fr/"])
    link = '<LINK href="{}" rel="canonical">'
    rows = [
        (1, "http://A.Example.NET/en/1?x", None), (2, "https://example.net", ""), (3, "http://b.net/fr", "<p>"), (4, None, None), (5, "nothing", "x"),
        (6, "http://free.io/a#f", link.format("http://c.io/b?u=1&amp;v=2")), (7, "http://c.io/b?u=1&v=2", link.format("//bad.net/x")), (8, "https://bad.net/x", ""),
        (9, "http://x.org/fr/1", link.format("http://free.io/a")), (10, "http://other.io/q", '<meta http-equiv="refresh" content="0; url=/r">'), (11, "http://other.io/r", ""),
        (11, "http://other.io/r", ""), (12, "http://myexample.com/de/", ""), (13, "http://example.com/de/?q", ""), (14, "://", ""), (15, "http://u.org?/fr/", ""),
    ]
    df = spark.createDataFrame([(*r, "z") for r in rows], "page_id long, url string, html string, node string")
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in url_filters.judge(df, rule).collect()}
    assert got[1] == ("a.example.net", "/en/1", "example.net/en/", "allow")
    assert got[2] == ("example.net", "", None, "allow")
    assert got[3] == ("b.net", "/fr", "net/", "block")
    assert got[4] == got[5] == ("", "", None, "allow")
    assert [got[i][3] for i in (6, 7, 8, 9, 10, 11)] == ["block", "block", "block", "allow", "allow", "allow"]
    assert got[12] == ("myexample.com", "/de/", None, "allow") and got[13][2:] == ("example.com/de/", "block")
    assert got[14] == ("", "", None, "allow") and got[15][:2] == ("u.org", "")
    assert url_filters.judge(df, rule).count() == len(rows)
    assert url_filters.judge(df.limit(0), rule).collect() == []


def test_blocked_targets_that_are_no_pages(spark):
    link = '<link rel="canonical" href="{}">'
    rows = [
        (1, "http://free.io/a", link.format("//bad.net/x")), (2, "http://c.io/b", link.format("https://BAD.net/x#f")), (3, "http://d.io/", link.format("http://c.io/b")),
        (4, "http://x.org/fr/1", link.format("http://bad.net/x")), (5, "http://e.io/", '<meta http-equiv="refresh" content="0; url=http://example.com/de/1?q=2">'),
        (6, "http://f.io/", link.format("http://example.com/fr?x=/de/")), (7, "http://g.io/", link.format("http://example.net/en/3")), (8, "http://h.io/", link.format("http://bad.net?/y")),
    ]
    rule = url_filters.decode_rules(["net/", "example.com/de/"], ["example.net/en/", "org/fr/"])
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = {r.page_id: r.verdict for r in url_filters.judge(df, rule).collect()}
    assert got == {1: "block", 2: "block", 3: "block", 4: "allow", 5: "block", 6: "allow", 7: "allow", 8: "allow"}


def test_every_link_and_dot_segment(spark):
    link = '<link rel="canonical" href="{}">'
    rows = [
        (1, "http://a.io/x/y", link.format("/own") + "<p>" + link.format("http://bad.net/1")), (2, "http://b.io/d/e/f", link.format("../c")), (3, "http://b.io/d/c", link.format("//bad.net/2")),
        (4, "http://c.io/p", link.format("?v=2")), (5, "http://c.io/p?v=2", link.format("./q/../bad")), (6, "http://c.io/bad", '<meta http-equiv=refresh content="1;url=#top"><meta http-equiv="refresh" content="3; url=http://bad.net/">'),
        (7, "http://d.io/../e/./f", ""), (8, "http://d.io/e/f", link.format("http://bad.net/3")), (9, "http://f.io/a", link.format("q?u=http://bad.net/")), (10, "http://f.io/", link.format("#x")),
    ]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = {r.page_id: r.verdict for r in url_filters.judge(df, url_filters.decode_rules(["net/"], [])).collect()}
    assert got == {i: "block" for i in range(1, 9)} | {9: "allow", 10: "allow"}
    from pyspark.sql import functions as F

    paths = {"/a/b/../c": "/a/c", "/..": "/", "/a/..": "/", "/a/b/.": "/a/b/", "/a/./b": "/a/b", "/../../x": "/x", "": "", "/a..b/.c": "/a..b/.c", "/a/b/..": "/a/", "/": "/"}
    table = spark.createDataFrame([(p,) for p in paths], "p string")
    assert {r.p: r.q for r in table.select("p", url_filters.without_dots(F.col("p")).alias("q")).collect()} == paths


def brute_verdicts(rows, rules):
    """(page_id, host, path, rule, verdict): rules by hand, aliases by a plain union of the links' ends, resolved by the standard library."""
    from urllib.parse import urljoin

    def parts(url):
        _, found, rest = (url or "").partition("://")
        m = re.match(r"([^/?#]*)([^?#]*)(\?[^#]*)?", rest if found else "")
        return m[1].lower(), m[2], m[3] or ""

    def best(host, path):
        fit = [(len(r), r, d) for r, d in rules if (host == r.partition("/")[0] or host.endswith("." + r.partition("/")[0])) and path.startswith("/" + r.partition("/")[2])]
        return max(fit)[1:] if fit else (None, None)

    def name(url):
        host, path, query = parts(url)
        return (host, urljoin("http://h" + path, path)[len("http://h") :] if path else "", query) if host else None

    root = {}

    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    for _, url, html in rows:
        tags = re.findall(r"""(?is)<link\s[^>]*?\brel\s*=\s*["']?canonical\b[^>]*>""", html or "")
        links = [m[1] for t in tags if (m := re.search(r"""(?is)\bhref\s*=\s*["']?([^"'\s>]+)""", t))]
        for target in links:
            a, b = name(url), name(urljoin(url or "", target.replace("&amp;", "&")))
            if a and b:
                root[find(a)] = find(b)
    blocked = {find(x) for x in list(root) if best(x[0], x[1])[1] == "block"}
    out = []
    for key, url, _ in rows:
        host, path, _ = parts(url)
        rule, own = best(host, path)
        out.append((key, host, path, rule, own or ("block" if name(url) in root and find(name(url)) in blocked else "allow")))
    return sorted(out)


def test_verdicts_match_brute_force(spark):
    import random

    rnd = random.Random(12)
    hosts = ["a.io", "b.net", "www.example.net", "example.com", "x.org", "c.io", "d.io", "e.io"]
    paths = ["/", "/en/1", "/de/2", "/fr/", "/p/q", "/p/../q", "/p/./q?x=1", "/q?x=1&amp;y=2"]
    some = lambda: f"http://{rnd.choice(hosts)}{rnd.choice(paths)}"
    rows = []
    for i in range(150):
        links = [rnd.choice([some(), some().removeprefix("http:"), rnd.choice(paths), "../z", "q", "?x=1"]) for _ in range(rnd.choice([0, 0, 0, 1, 2]))]
        rows.append((i, some().replace("&amp;", "&"), "<p>".join(f'<link rel="canonical" href="{x}">' for x in links)))
    rules = url_filters.decode_rules(["net/", "example.com/de/"], ["example.net/en/", "org/fr/"])
    got = sorted(tuple(r) for r in url_filters.judge(spark.createDataFrame(rows, "page_id long, url string, html string"), rules).collect())
    want = brute_verdicts(rows, rules)
    assert got == want and {"block", "allow"} == {r[4] for r in want if r[3] is None}


def test_query_matches_brute_force(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/pages.parquet").select("page_id", "url", "html").collect()]
    assert sorted(tuple(r) for r in queries.op9_url_filters(spark, SF).collect()) == brute_verdicts(rows, queries.URL_RULES)


def test_components(spark):
    import random

    rnd = random.Random(3)
    edges = [(f"n{rnd.randrange(60):02}", f"n{rnd.randrange(60):02}") for _ in range(45)] + [(f"p{i:02}", f"p{i + 1:02}") for i in range(30)]
    edges = [e for e in edges if e[0] != e[1]]
    root = {x: x for e in edges for x in e}
    for _ in range(100):
        for a, b in edges:
            root[a] = root[b] = min(root[a], root[b])
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "a string, b string")).collect()}
    assert got == root
