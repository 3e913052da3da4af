"""Pages dealt over tasks, maps built from entries that are computed once, odd pages."""

from pyspark.sql import functions as F

from paysheaf import session
from paysheaf.functions import html
from paysheaf.operators.stats import last_wins_map
from paysheaf.session import PAGE_TASKS
from paysheaf.sources.fixtures import link_pages, profile_pages, roster_pages, stats_pages
from paysheaf.sources.html_tables import table_rows
from paysheaf.sources.links import club_links, links_in_season, page_links
from paysheaf.sources.profiles import profile_facts
from paths import SF0001


def test_pages_are_dealt_over_more_tasks_than_the_scan_has_splits(spark):
    for pages in (link_pages, roster_pages, stats_pages, profile_pages):
        assert pages(spark, SF0001).rdd.getNumPartitions() >= PAGE_TASKS, pages.__name__


def test_a_split_gives_many_times_the_tasks_of_a_cluster_of_12_cores(spark):
    scan = spark.range(0, 2000, 1, 2)
    assert session.deal(scan, scan).rdd.getNumPartitions() >= 2 * 5 * 12


def test_only_tags_to_escape_are_handled_one_by_one(monkeypatch):
    escaped = []
    own = html._inner_escaped
    monkeypatch.setattr(html, "_inner_escaped", lambda found: escaped.append(found[0]) or own(found))
    page = html.clean("<p class='a b' id=x><td title=\"a>b\">x<b title='y<z' = >1 < 2</b><i k = \"open>")
    assert page == "<p class='a b' id=x><td title=\"a&gt;b\">x<b title='y&lt;z' = >1 < 2</b><i k = \"open>"
    assert escaped == ['<td title="a>b">', "<b title='y<z' = >"]


def test_entries_of_a_map_are_computed_once(spark):
    entries = F.transform("ks", lambda k: F.struct(F.regexp_extract(k, "([a-z]*)", 1).alias("k"), k.alias("v")))
    df = spark.createDataFrame([(["a1", "b1", "a2"],), ([],), (None,)], "ks array<string>").select(last_wins_map(entries).alias("m"))
    assert df._jdf.queryExecution().optimizedPlan().toString().count("regexp_extract(") == 1
    assert [r.m for r in df.collect()] == [{"a": "a2", "b": "b1"}, {}, None]


def test_pages_without_facts(spark):
    pages = spark.createDataFrame([(1, None), (2, ""), (3, "<table><tr><td>5 < 6<td>x</table>")], "page_id long, html string")
    assert [(r.page_id, r.cells) for r in table_rows(pages).collect()] == [(3, ["5 < 6", "x"])]
    for read in (page_links, links_in_season, club_links):
        assert read(pages).collect() == []
    facts = {r.page_id: r for r in profile_facts(pages).collect()}
    assert facts[1].profile is None and facts[2].profile == {} and facts[2].full_name is None
