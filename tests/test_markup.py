"""Elements and embedded objects of pages."""

import pytest
from pyspark.sql import functions as F

from postlake.functions import markup
from postlake.operators import postings
from postlake.operators.extraction import visible_text

PAGE = """<html><body class=main><!-- <div class="box">no</div> --><div class="a box"><p>one</p><div>two <div>three</div></div> tail</div><script>if (a<b) "</div>"</script>
<DIV CLASS='box second'>x<br/>y<img src="a>b.png">z</DIV><div id="open"><p>never <b>closed</body></html>"""


@pytest.fixture(scope="module")
def page(spark):
    return spark.createDataFrame([(PAGE,), ("",), (None,), ("no tags < at > all",)], "html string").select(markup.cut(F.col("html")).alias("p")).coalesce(1)


def texts(page, column):
    return [r[0] for r in page.select(column).collect()]


def test_elements_end_at_their_own_tag(page):
    p = F.col("p")
    assert texts(page, visible_text(markup.first(p, [("div", "class", "box")])))[0] == "one two three tail"
    assert texts(page, F.transform(markup.every(p, [("div", "class", "box")]), lambda x: x["inside"]))[0][1] == 'x<br/>y<img src="a>b.png">z'
    assert texts(page, markup.first(p, [("div", "class", "box"), ("div", None, None), ("div", None, None)])) == ["three", None, None, None]
    assert texts(page, visible_text(markup.first(p, [("div", "id", "open")])))[0] == "never closed"
    assert texts(page, F.size(markup.every(p, [("div", "class", "box")]))) == [2, 0, 0, 0]
    assert texts(page, markup.first(p, [("br", None, None)]))[0] == ""
    assert texts(page, markup.attribute(F.get(F.col("p.marks"), F.lit(1)), "class"))[0] == "main"


@pytest.mark.parametrize("text,want", [
    ('{"a":1};</script>', '{"a":1}'), ('{"a":"}</script>","b":{"c":"\\\\"}} more', '{"a":"}</script>","b":{"c":"\\\\"}}'), ('{"a":"x\\"}y"}z', '{"a":"x\\"}y"}'), ('{"a":{', None), ("", None), ("[1]", None), (None, None),
    ('{"k":"' + 'x\\"{' * 3000 + '"}rest', '{"k":"' + 'x\\"{' * 3000 + '"}'),
])
def test_leading_object(spark, text, want):
    assert spark.createDataFrame([(text,)], "t string").select(markup.leading_object(F.col("t"))).first()[0] == want


DETAIL = """<html><body><h1>Fallback title</h1><p data-testid="job-details-company-info-name">Data Co</p><div class="multi-location-display-styles__Container-sc-1"><p>Berlin</p></div>
<p data-testid="job-details-published-date"><time datetime="2026-02-01T08:30:00Z"><span aria-hidden="true">10 days ago</span></time></p>
<ul aria-label="Main details for this job:"><li role="status"><span>Self-employed</span></li><li role="status"><span>Remote</span></li></ul></body></html>"""


def test_structured_data_before_the_page(spark):
    ld = """<script type="application/ld+json">{"@type":"JobPosting","title":"Senior","datePosted":"2026-02-06T10:39:42Z","description":"<p>Build.</p><p>Own.</p>"}</script>"""
    rows = spark.createDataFrame([(1, DETAIL), (2, ld + DETAIL), (3, None)], "page_id int, html string")
    got = {r["page_id"]: r for r in postings.merged_detail(rows).collect()}
    assert (got[1]["job_title"], got[1]["company_name"], got[1]["job_location"], got[1]["posted_at"], got[1]["posted_time_ago"]) == ("Fallback title", "Data Co", "Berlin", "2026-02-01T08:30:00Z", "10 days ago")
    assert (got[1]["employment_type"], got[1]["work_model"], got[1]["salary_range_text"], got[1]["sources"]["job_title"]) == ("Self-employed", "Remote", None, "dom")
    assert (got[2]["job_title"], got[2]["posted_at"], got[2]["job_description"], got[2]["sources"]["posted_at"]) == ("Senior", "2026-02-06T10:39:42Z", "Build. Own.", "jsonld")
    assert got[3]["job_title"] is None and not got[3]["external_ad"]
