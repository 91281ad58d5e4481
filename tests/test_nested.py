"""Walks of nested JSON, lenient decoding, clipping."""

import re

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from wayforge.functions import text as T
from wayforge.functions.nested import json_nodes, percent_decoded, unescaped, walk
from wayforge.operators import evidence, publish
from wayforge.sources import pages as P


def test_walk_has_every_value_once():
    document = {"a": [1, {"b": None}], "c": "x"}
    got = list(walk(document))
    assert [(p, n, parent) for p, n, _, parent in got] == [("$", None, -1), ("$.a", "a", 0), ("$.a[0]", None, 1), ("$.a[1]", None, 1), ("$.a[1].b", "b", 3), ("$.c", "c", 0)]
    deep = x = []
    for _ in range(50_000):
        x.append([])
        x = x[0]
    assert sum(1 for _ in walk(deep)) == 50_001


def test_nodes_of_several_documents(spark):
    df = spark.createDataFrame([(["[12345678901234567890, 1.50, true]", "{oops", None],), (None,), (["[" * 100_000],)], "d array<string>")
    rows = df.select(json_nodes("d").alias("n")).collect()
    assert [(x.document, x.kind, x.value, x.parent) for x in rows[0].n] == [(0, "array", None, -1), (0, "number", "12345678901234567890", 0), (0, "number", "1.50", 0), (0, "boolean", "true", 0), (1, "invalid", "{oops", -1)]
    assert rows[1].n is None and [x.kind for x in rows[2].n] == ["invalid"]


def test_ids_are_values_not_wording(spark):
    docs = [
        ('{"a": {"detailId": 7, "text": "\\"locationId\\": 99 and -d55- here", "url": "/Attraction_Review-g1-d8-x.html"}, "list": [{"contentId": "abc"}, {"locationId": 7}, {"locationId": 1.5}, {"detailId": true}]}', ["7", "8", "abc"]),
        ('{"url": "see https://x.y/AttractionProductReview-g1-d9-a.html and /Attraction_Review-g2-d10-b"}', ["10", "9"]),
        ("{}", []),
        ("no json", []),
    ]
    df = spark.createDataFrame([(i, d) for i, (d, _) in enumerate(docs)], "i int, d string")
    got = {r.i: r.ids for r in df.select("i", evidence.nested_identities(F.col("d")).alias("ids")).collect()}
    assert got == {i: want for i, (_, want) in enumerate(docs)}


def test_denied_keys(spark):
    df = spark.createDataFrame([(1, '{"a":[{"User_Name":1,"x":{"e_mail":{"phone":2}}}],"note":"\\"email\\": 1"}'), (2, "{"), (3, None), (4, ""), (5, "[]")], "id int, doc string")
    assert sorted(map(tuple, publish.nested_keys(df, "id", "doc", ["username", "email", "phone"]).collect())) == [(1, "$.a[0].User_Name"), (1, "$.a[0].x.e_mail"), (1, "$.a[0].x.e_mail.phone"), (2, "invalid")]


def test_descriptions_of_the_page_itself(spark):
    script = lambda text: f'<script type="application/ld+json">{text}</script>'
    pages = [
        (1, script('{"@graph": [{"@type": "Product", "url": "/x-d1-y", "description": "A \\"great\\" tour of caf\\u00e9s"}, {"@type": "Review", "name": "on d1", "description": "' + "long " * 30 + '"}]}')),
        (2, script('{"@type": "Product", "@id": "d22", "about": "d2", "description": "of another page"}') + '<meta name="description" content="meta">'),
        (3, script("{broken") + script('[{"offers": {"@type": ["Thing"], "name": "d3", "description": " nested\\n here "}}]')),
        (4, script('{"@id": "4", "description": 5}')),
    ]
    df = spark.createDataFrame(pages, "id long, html string")
    got = {r.id: (r.description, r.source) for r in P.best_description(df, "id", "html", "<about>(.*?)</about>", F.col("id")).collect()}
    assert got == {1: ('A "great" tour of cafés', "linked-data"), 2: ("meta", "meta"), 3: ("nested here", "linked-data")}


def test_lenient_decoding(spark):
    rows = ["100% fun %2F", "%zz%41%", "%C3%A9 + %e2%82", "plain", None, "&eacute;&#8364;&amp;lt;&bogus;"]
    df = spark.createDataFrame([(i, x) for i, x in enumerate(rows)], "i int, x string").orderBy("i")
    assert [r.d for r in df.select(percent_decoded("x").alias("d")).collect()] == ["100% fun /", "%zzA%", "é + �", "plain", None, rows[5]]
    assert df.select(unescaped("x").alias("d")).collect()[5].d == "é€&lt;&bogus;"
    page = '"card one\\" {\\"x\\":1} <b>100% of &lt;it&gt;</b> href="%2Fa%252Fb" src="p1" src="p1" src="p2" class="review" src="p3" ' + "word " * 50
    card = P.cards(spark.createDataFrame([(1, page)], "id int, h string"), "id", "h", '"card', escapes=True).first()
    assert card.link == "/a/b" and card.photos == ["p1", "p2"] and len(card.blurb) <= 169 and card.blurb.endswith("word…")


def reference_clip(value, limit):
    value = re.sub(r"\s+", " ", re.sub(r"[\x00-\x08\x0b\x0c\x0e-\x1f]", " ", value)).strip()
    if len(value) <= limit:
        return value
    head = value[:limit]
    ends = [i + 1 for i, c in enumerate(head) if c in ".!?…" and head[i + 1 : i + 2] in ("", " ")]
    if ends and ends[-1] >= limit // 2:
        return head[: ends[-1]]
    words = head.rpartition(" ")[0] if " " in head else head
    words = words.rstrip(" ,;:-") or head[:-1]
    return words[: limit - 1].rstrip() + "…"


@settings(max_examples=5, deadline=None)
@given(st.lists(st.text(alphabet="ab .!?…,;:-\n\t\x07  　漢", max_size=60), min_size=40, max_size=40), st.sampled_from([2, 5, 20, 31]))
def test_clipped_like_the_rule(texts, limit):
    from wayforge.session import local_session

    spark = local_session("4", 4)
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string").select("i", T.clipped(F.col("t"), limit).alias("c"))
    for r in df.collect():
        assert r.c == reference_clip(texts[r.i], limit)
        assert len(r.c) <= limit


def test_stale_files_are_not_opened(spark, tmp_path):
    import os

    now = 1_700_000_000
    for name, age in (("a-1", 30), ("a-2", 5), ("b-1", 30), ("b-2", 40), ("c-9", 1), ("c-10", 3), ("noise", 0)):
        (tmp_path / f"{name}.html").write_text(f"<p>{name}")
        os.utime(tmp_path / f"{name}.html", (now - age * 3600,) * 2)
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    as_of = F.timestamp_seconds(F.lit(now))
    found = lambda **more: P.newest_files(spark, str(tmp_path), "/([a-z])-[0-9]+[.]html$", **more)
    name = lambda df: {r.key: r.html for r in df.collect()}
    fresh = found(as_of=as_of)
    assert name(fresh) == {"a": "<p>a-2", "c": "<p>c-9"}
    assert sorted(p.rpartition("/")[2] for p in fresh.inputFiles()) == ["a-2.html", "c-9.html"]  # the plan has no other file
    assert name(found(as_of=as_of, version="-([0-9]+)[.]html$")) == {"a": "<p>a-2", "c": "<p>c-10"}
    assert name(found(as_of=as_of, mode="offline")) == {"a": "<p>a-2", "b": "<p>b-1", "c": "<p>c-9"}
    assert found(as_of=as_of, mode="refresh").count() == 0
    assert P.scan_files(spark, str(tmp_path), modified_after="2023-11-14T20:00:00").count() == 2
    listed = P.scan_files(spark, str(tmp_path)).select("path", "fetched_at")._jdf.queryExecution().executedPlan().toString()
    assert "content" not in listed.split("ReadSchema")[-1]


def test_percent_replaced_sends_escapes_only(spark):
    """Equal to decoding whole texts, of which pages of any size would lie in a worker by the thousand."""
    from wayforge.functions import nested

    rows = ["100% fun %2F", "%zzA%", "%C3%A9 + %FF", "plain", None, "", "%20", "%C3x%A9%E2%82", "a%250A%0Ab", "%41" * 50 + "%4", "é%c3%a9%"]
    df = spark.createDataFrame([(i, x) for i, x in enumerate(rows)], "i int, x string")
    want = {r.i: r.d for r in df.select("i", percent_decoded("x").alias("d")).collect()}
    assert {r.i: r.x for r in nested.percent_replaced(df, "x").collect()} == want
    plan = nested.percent_replaced(df, "x")._jdf.queryExecution().optimizedPlan().toString()
    assert "_unquoted(" in plan and "percent_decoded(" not in plan
