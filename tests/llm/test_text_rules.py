"""The rule cascade, the classifier and the URL filters."""

import zlib

from pyspark.sql import functions as F

from rarebird.llm import classifier, queries, rules, url_filter

SF = "/root/testdata/sf0.001"


def brute_metrics(text):
    words = (text or "").encode().split()
    grams = [tuple(words[k : k + 3]) for k in range(len(words) - 2)]
    covered = {j for k, g in enumerate(grams) if grams.count(g) > 1 for j in (k, k + 1, k + 2)}
    lines = [x for x in (text or "").split("\n") if x.encode().split()]
    return (len(words), sum(len(w.decode()) for w in words), sum((text or "").count(c) for c in "#*$%&|<>"),
            len(lines) - len(set(lines)), len(covered))


def test_metrics_match_brute_force(spark):
    rows = [(k, t) for k, t in enumerate([
        None, "", " ", "a", "a b", "a b c", "a b c a b c", "a a a a", "a a a a a b", "x\ny\nx\n \n\n", "é|# ü b\x85c", "a\x0bb\x0cc\rd\x1ce",
        "a b c d a b c e b c d", "one " * 50])]
    df = spark.createDataFrame(rows, "doc_id int, text string")
    m = rules.text_metrics(df)
    got = {r.doc_id: (r.m.n_words, r.m.word_chars, r.m.n_symbols, r.m.n_dup_lines, r.m.n_repeat_words) for r in m.collect()}
    assert got == {k: brute_metrics(t) for k, t in rows}


def test_order_changes_cost_not_result(docs):
    frame, all_rules = rules.text_metrics(docs), rules.default_rules()
    names = list(all_rules)
    a = rules.cascade(frame, all_rules, names).select("doc_id", F.col("failed_rule").isNull().alias("kept"))
    b = rules.cascade(frame, all_rules, names[::-1]).select("doc_id", F.col("failed_rule").isNull().alias("kept"))
    assert sorted(map(tuple, a.collect())) == sorted(map(tuple, b.collect()))
    assert rules.order_rules({"x": (0.5, 2.0), "y": (0.4, 0.1), "z": (0.0, 0.1)}) == ["y", "x", "z"]


def test_cascade_is_native_and_narrow(docs, edge, empty):
    judged = rules.quality_cascade(docs)
    plan = judged._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Python" not in plan and "Arrow" not in plan
    assert rules.quality_cascade(edge).count() == edge.count()
    assert rules.quality_cascade(empty).count() == 0


def test_classifier_held_out(spark):
    scored = queries.op7_quality_classifier(spark, "/root/testdata/sf0.01")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet").select("doc_id", "quality")
    rows = scored.join(labels, "doc_id").where("held_out").collect()
    assert len(rows) > 30
    assert sum(r.predicted == r.quality for r in rows) / len(rows) > 0.95
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in scored.collect())


def test_classifier_never_reads_held_out_labels(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    held = classifier.bucket("doc_id", 5) == 0
    flipped = labels.withColumn("quality", F.when(held, 1 - F.col("quality")).otherwise(F.col("quality")))
    a, b = (classifier.fit(docs, x, held_out=held) for x in (labels, flipped))
    assert a.bias == b.bias and (a.weights == b.weights).all()


def test_classifier_edges(spark, edge, empty):
    labels = spark.createDataFrame([(4, 1), (4, 0), (None, 1), (5, None), (2, 0)], "doc_id bigint, quality int")
    model = classifier.fit(edge, labels)
    rows = classifier.score(edge, model).collect()
    assert len(rows) == edge.count() and all(0 <= r.score <= 1 for r in rows)
    assert classifier.score(empty, model).count() == 0
    blank = classifier.fit(edge, labels.where("false"))
    assert {r.score for r in classifier.score(edge, blank).collect()} == {0.5}
    assert classifier.filter_by_quality(edge, blank, 0.3).columns == edge.columns
    assert classifier.filter_by_quality(edge, blank, 0.3).count() == edge.count()


def judge(spark, pages, **more):
    df = spark.createDataFrame(pages, "page_id bigint, url string, html string")
    return {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in url_filter.judge_urls(df, **more).collect()}


def test_redirect_classes(spark):
    link = '<LINK href="{0}" rel="canonical">'
    got = judge(spark, [
        (1, "http://a.com/de/1", None),
        (2, "http://b.net/x#top", link.format("http://a.com/de/1")),  # alias of a blocked URL
        (3, "http://c.net/y", "<meta http-equiv=refresh content='0; URL=http://b.net/x'>"),  # through page 2
        (4, "http://d.org/z", link.format("http://b.net/x")),  # allowed itself
        (5, "http://e.net/", link.format("http://e.net/fr/")),
        (6, "http://f.net/q", link.format("/r?a=1&amp;b=2")), (7, "http://f.net/r?a=1&b=2", None),
        (8, None, None), (9, "no scheme", ""), (10, "HTTP://Sub.EXAMPLE.org/en/12?x", None), (11, "http://example.org", None),
    ])
    assert got[1] == ("a.com", "/de/1", "com/de/", "block")
    # the class of 2, 3 and 4 holds an explicit allow, which takes precedence for those no rule fits
    assert got[2] == ("b.net", "/x", None, "allow") and got[3][3] == "allow" and got[4] == ("d.org", "/z", "org/", "allow")
    assert got[5][2:] == (None, "allow") and got[6][3] == got[7][3] == "allow"
    assert got[8] == ("", "", None, "allow") and got[9] == ("", "", None, "allow")
    assert got[10] == ("sub.example.org", "/en/12", "example.org/en/1", "block")
    assert got[11] == ("example.org", "", None, "allow")


def test_blocks_reach_aliases(spark):
    edges = spark.createDataFrame([("http://b.net/x", "http://a.com/de/1"), ("http://c.net/y", "http://B.net/x#f"), (None, "http://q/")], "f string, t string")
    got = judge(spark, [(2, "http://b.net/x", None), (3, "http://c.net/y", ""), (4, "http://c.net/z", "")], edges=edges)
    assert [got[k][3] for k in (2, 3, 4)] == ["block", "block", "allow"]
    assert judge(spark, []) == {}


def test_edges_of_pages(spark):
    """Targets that a browser would follow, and nothing that only looks like one."""
    link, meta = '<link rel="{1}" href="{0}">', '<meta http-equiv="Refresh" content="{0}">'
    pages = {
        1: ("<!-- " + link.format("http://x.net/c", "canonical") + " -->", None),
        2: ("<script>var a = '" + link.format("http://x.net/c", "canonical") + "'</script>", None),
        3: (link.format("?v=1", "canonical"), "http://p.net/a/b?v=1"),
        4: (link.format("#top", "canonical"), "http://p.net/a/b?q=2#top"),
        5: (link.format("../c/./d", "canonical"), "http://p.net/c/d"),
        6: ('<base href="/z/">' + link.format("e", "alternate canonical"), "http://p.net/z/e"),
        7: (link.format("/r?a=1&#38;b=2&#x26;c=3&amp;d&sol;", "CANONICAL"), "http://p.net/r?a=1&b=2&c=3&d/"),
        8: (meta.format("30; url=http://x.net/late"), None),
        9: (meta.format("0; URL='http://x.net/now'"), "http://x.net/now"),
        10: (meta.format("0;//x.net/there"), "http://x.net/there"),
        11: (link.format("http://x.net/no", "noncanonical") + '<link data-rel="canonical" href="http://x.net/no">', None),
        12: (link.format("", "canonical") + link.format("http://[bad/", "canonical"), None),
        13: ('<link title="a>b" rel=canonical href=http://x.net/bare>', "http://x.net/bare"),
        14: ("canonical " + "<" * 50_000 + "'" * 3, None),
    }
    df = spark.createDataFrame([(f"http://p.net/a/b?q=2&k={k}" if k != 4 else "http://p.net/a/b?q=2", h) for k, (h, _) in pages.items()], "url string, html string")
    got = {r.url: r.target for r in url_filter.html_edges(df).collect()}
    for k, (_, want) in pages.items():
        assert got.get(f"http://p.net/a/b?q=2&k={k}" if k != 4 else "http://p.net/a/b?q=2") == want, k


def test_many_rules_decide_as_few(spark, monkeypatch):
    hosts = ["a.com", "b.a.com", "com", "net", "x.y.net", "", "org"]
    paths = ["", "/", "/d", "/de/", "/de/1", "/é/"]
    rules = [(h + p, "allow" if (len(h) + len(p)) % 2 else "block") for h in hosts[:5] for p in paths[1:] if (len(h) * 7 + len(p)) % 3]
    pages = [(k, f"http://{s}{h}{p}{tail}", "<link rel=canonical href=/de/1>" if k % 5 == 0 else None)
             for k, (s, h, p, tail) in enumerate((s, h, p, t) for s in ("", "w.") for h in hosts for p in paths for t in ("", "9", "?q"))]
    pages += [(1000, None, None), (1001, "none", "")]
    few = judge(spark, pages, rules=rules)
    assert len({v[2] for v in few.values()}) > 10
    assert judge(spark, pages, rules=spark.createDataFrame(rules, "r string, v string")) == few
    monkeypatch.setattr(url_filter, "MAX_RULES", 3)
    assert judge(spark, pages, rules=rules) == few
    assert judge(spark, [], rules=rules) == {}
