import datetime as dt

from stormmart.functions.jsontext import json_amounts, map_total, total_line
from stormmart.operators.lookup import enrich_calendar, weekday_rows, weekend_rows
from stormmart.plans.samples import first_model, non_null_ids, order_totals, second_model
from stormmart.sources.links import count_links, extract_links

INDEX_PAGE = """<html><body><pre>
<a href="a">hail_reports-part_1.csv.gz</a>
<A HREF="b"> <b>hail_reports-part</b>_2.csv.gz </A>
<a href="c">flood_reports-x_1.csv.gz</a>
<a href="d">reports-part &amp; more</a>
</pre></body></html>"""


def test_extract_links_nested_tags_case_and_token(spark):
    pages = spark.createDataFrame([(1, INDEX_PAGE)], "page_id long, html string")
    links = extract_links(pages, "reports-part").collect()
    assert [(r.link_pos, r.link_text) for r in links] == [
        (0, "hail_reports-part_1.csv.gz"),
        (1, "hail_reports-part_2.csv.gz"),
        (3, "reports-part & more"),
    ]
    assert count_links(extract_links(pages, "reports-part")).first().num_links == 3
    assert [r.link_pos for r in extract_links(pages, "reports-part", max_anchors=2).collect()] == [0, 1]


def test_json_totals_line(spark):
    df = spark.createDataFrame([('{"a": 10.25, "b": 20.5, "c": 1000.13}',)], "j string")
    row = df.select(map_total(json_amounts("j")).alias("t")).first()
    assert abs(row.t - 1030.88) < 1e-9
    line = df.select(total_line(map_total(json_amounts("j"))).alias("l")).first().l
    assert line == "Total order value is: 1030.88"
    out = order_totals(df, "j").first()
    assert out.n_rows == 1 and out.total_line == "Total order value is: 1030.88"


def test_calendar_enrichment_and_branches(spark):
    df = spark.createDataFrame([(1, dt.datetime(2024, 1, 6, 12)), (2, dt.datetime(2024, 1, 8, 9))],
                               "id int, ts timestamp_ntz")
    rows = {r.id: r for r in enrich_calendar(df, "ts").collect()}
    assert rows[1].day_name == "saturday" and rows[1].is_weekend and not rows[1].is_weekday
    assert rows[1].task_id == "weekend_activities.going_to_the_beach"
    assert rows[2].message == "It's Monday and I'm busy with guitar lessons."
    enriched = enrich_calendar(df, "ts")
    assert [r.id for r in weekday_rows(enriched).collect()] == [2]
    assert [r.id for r in weekend_rows(enriched).collect()] == [1]


def test_union_filter_models(spark):
    inline = spark.createDataFrame([(1,), (None,)], "id int")
    ids = spark.createDataFrame([(1,), (2,)], "n int")
    first = first_model(ids, inline, "n")
    assert first.count() == 4
    assert second_model(first).count() == 2
    assert non_null_ids(first).count() == 3


def test_character_references_as_the_standard_reads_them(spark):
    import html

    from pyspark.sql import functions as F

    from stormmart.sources.links import decode_references

    texts = ["plain", "a &amp; b", "&#38;#38;", "&#x27;&#X1F600;&#128512;", "&#0; &#xD800; &#99999999999; &#xFFFFFFFFFF;",
             "&eacute;&NotEqualTilde;&nope; & &; &# &#x; &#xg", "&amp;lt;", "&#38", "&#x41b", "two\nlines &#233;", "",
             *[f"&#{c};" for c in range(128, 160) if c in (128, 130, 150, 159)]]
    frame = spark.createDataFrame([(t,) for t in [*texts, None]], "t string")
    got = {r.t: r.d for r in frame.select("t", decode_references(F.col("t")).alias("d")).collect()}
    assert got == {**{t: html.unescape(t) for t in texts}, None: None}
