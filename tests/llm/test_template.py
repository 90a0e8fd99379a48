"""Template classes against brute force, and pages that stand in the table more than once."""

import random
from collections import defaultdict

from pyspark.sql import functions as F

from doselens.llm import template

PLAIN = "<html><body><div>Site</div><div><p>Own {0}</p><p>More {0}</p></div><div>Legal</div></body></html>"
WITH_ARTICLE = "<html><body><div>Site</div><article><h1>Head {0}</h1><p>Own {0}</p></article><div>Legal</div></body></html>"
SCHEMA = "page_id bigint, url string, html string"


def pages(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


def extracted(frame):
    return sorted((str(r.page_id), r.url, r.text) for r in template.extract(frame).collect())


def host(name, html, n):
    return [(i, f"http://{name}.example/{i}", html.format(i)) for i in range(n)]


def test_a_page_given_twice_keeps_its_text(spark):
    once = [(1, "http://a.example/1", PLAIN.format(1))]
    for rows in (once * 2, once * 8, [(i, "http://a.example/1", PLAIN.format(1)) for i in range(8)]):
        assert {text for *_, text in extracted(pages(spark, rows))} == {"Site\nOwn 1\nMore 1\nLegal"}


def test_a_doubled_table_gives_each_row_twice(spark):
    rows = host("a", PLAIN, 6) + host("b", WITH_ARTICLE, 6) + host("c", PLAIN, 2) + host("d", PLAIN, 1)
    rows += [(50, None, None), (51, "http://e.example/x", "")]
    single, double = extracted(pages(spark, rows)), extracted(pages(spark, rows * 2))
    assert double == sorted(single * 2)
    texts = {(url, i): text for i, url, text in single}
    assert texts["http://a.example/3", "3"] == "Own 3\nMore 3"
    assert texts["http://b.example/3", "3"] == "Head 3\nOwn 3"
    assert texts["http://c.example/1", "1"] == "Site\nOwn 1\nMore 1\nLegal"


def test_null_ids_and_many_copies_beside_other_pages(spark):
    rows = host("a", PLAIN, 6) + [(None, "http://a.example/n", PLAIN.format("n"))] * 30
    without_ids = [(None, url, html) for _, url, html in rows]
    for given in (rows, without_ids):
        found = extracted(pages(spark, given))
        assert len(found) == 36
        assert {text for *_, text in found} == {f"Own {i}\nMore {i}" for i in [*range(6), "n"]}


def test_pages_of_nothing_but_their_template_stay(spark):
    """Eight different pages of a host that share all their text."""
    rows = [(i, f"http://a.example/{i}", PLAIN.format("x").replace("<body>", f"<body><i id=n{'x' * i}></i>")) for i in range(8)]
    assert {text for *_, text in extracted(pages(spark, rows))} == {"Site\nOwn x\nMore x\nLegal"}


def test_classes_equal_brute_force(spark):
    rng = random.Random(6)
    rows = []
    for i in range(60):
        words = [f"<div>{rng.choice(['Menu', 'Legal', 'Top', 'w' + str(rng.randint(0, 9))])}</div>" for _ in range(6)]
        body = "<b>All</b><i>Pages</i><u>Share</u>" + "".join(words)
        rows.append((rng.randint(0, 20), f"http://h{i % 4}.example/", f"<html><body>{body}</body></html>"))
    rows += rows[:25] * 2
    frame = pages(spark, rows).withColumn("host", template.host_of(F.col("url")))
    expected = {}
    for name in {f"h{i}.example" for i in range(4)}:
        contents = sorted({html for _, url, html in rows if f"/{name}/" in url})
        counts = [template.page_tokens(html)[0] for html in contents]
        classes = defaultdict(set)
        for token in {t for c in counts for t in c} - {0}:
            vector = tuple(c[token] for c in counts)
            if sum(n > 0 for n in vector) >= max(2, template.SUPPORT * len(contents)):
                classes[vector].add(token)
        expected[name] = (len(contents), sorted(sorted(c) for c in classes.values() if len(c) >= template.LEAST_TOKENS))
    found = {
        r.host: (r.host_pages, sorted(sorted(c["tokens"]) for c in r.classes if c["class"] is not None))
        for r in template.templates(frame).collect()
    }
    assert found == expected and all(classes for _, classes in expected.values())
