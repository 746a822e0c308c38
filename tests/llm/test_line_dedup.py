"""Boilerplate lines against the SQL and hand-made hosts."""

import pytest
from pyspark.sql import functions as F

from lexmeter.llm import line_dedup


def test_query_matches_sql(spark, same_as_sql):
    got = line_dedup.op3_site_line_dedup(spark, "/root/testdata/sf0.001")
    assert same_as_sql(got, line_dedup.OP3_SQL) == got.count()


def pages(spark, rows):
    return spark.createDataFrame(rows, "page_id bigint, url string, html string")


@pytest.mark.parametrize("broadcast", ["10MB", "-1"])
def test_only_lines_common_on_their_host_go(spark, conf, broadcast):
    conf("spark.sql.autoBroadcastJoinThreshold", broadcast)
    rows = [(i, "http://Hot.example/a", f"<p>menu</p><p>own {i}</p><p>own {i}</p>") for i in range(200)]
    rows += [(1000 + i, f"https://u@h{i}.example:80/x?y", f"<li>menu</li><li>page {i}</li>") for i in range(100)]
    rows += [(2000 + i, "http://small.example", "<p>same</p>") for i in range(4)]
    got = {r.page_id: r for r in line_dedup.drop_boilerplate(pages(spark, rows).repartition(4)).collect()}
    assert got[7].text == "own 7\nown 7" and (got[7].n_lines, got[7].n_dropped) == (3, 1)
    assert got[1003].text == "menu\npage 3" and got[1003].host == "h3.example"
    assert {got[2000 + i].text for i in range(4)} == {""}  # on 4 of 4 pages, as on 200 of 200
    assert len(got) == 304


def test_a_line_seen_once_stays_on_any_host(spark):
    rows = [(1, "http://one.page", "<p>a</p>"), (2, "http://two.pages", "<p>b</p><p>c</p>")]
    rows += [(3, "http://two.pages", "<p>b</p>"), (4, "http://two.pages", "<p>d</p>")]
    table = pages(spark, rows)
    got = {r.page_id: r.text for r in line_dedup.drop_boilerplate(table).collect()}
    assert got == {1: "a", 2: "c", 3: "", 4: "d"}
    strict = line_dedup.drop_boilerplate(table, least_holding=3)
    assert {r.page_id: r.text for r in strict.collect()}[3] == "b"


def test_ratio_is_of_pages_not_of_lines(spark):
    rows = [(i, "http://a.b", "<p>x</p>" * 9 if i < 3 else "<p>y</p>") for i in range(10)]
    got = {r.page_id: r.text for r in line_dedup.drop_boilerplate(pages(spark, rows)).collect()}
    assert got[0] == "\n".join("x" * 9) and got[9] == ""


def test_what_a_page_shows(spark):
    html = "<title>A &amp; b</title><script>var x='</p>'; <p></script><p>one <b>two</b>\t three<br>four<!-- <p>no --></p> "
    [(lines,)] = pages(spark, [(1, None, html)]).select(line_dedup.page_lines(F.col("html"))).collect()
    assert lines == ["A &amp; b", "one two three", "four"]


def test_awkward_pages(spark, folder_of, same_as_sql):
    long = "<p>" + "</p><p>".join(f"line {i % 5000}" for i in range(20_000)) + "</p>"
    rows = [(None, None, None), (1, None, ""), (1, None, ""), (2, "no url", "plain"), (3, "http://x.y", None)]
    rows += [(4, "http://x.y", long), (4, "http://x.y", long), (5, "http://x.y", "\r\n \t")]
    rows += [(6, "http://x.y", "line 1"), (7, "http://x.y", "line 1\nline 2")]
    table = pages(spark, rows)
    folder = folder_of(pages=table)
    assert same_as_sql(line_dedup.op3_site_line_dedup(spark, folder), line_dedup.OP3_SQL, folder) == 10
    odd = table.withColumns({name: F.lit("own") for name in ("host", "text", "n_lines", "_host", "_lines_", "weight")})
    got = line_dedup.drop_boilerplate(odd)
    assert got.count() == 10 and got.select("weight").distinct().collect() == [("own",)]
    assert line_dedup.drop_boilerplate(odd.limit(0)).count() == 0
