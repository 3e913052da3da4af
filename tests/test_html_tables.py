"""HTML extraction: loose markup, comments, entities, class tokens, nesting."""

from paysheaf.plans.catalog import catalog
from paysheaf.sources.html_tables import table_rows
from paysheaf.sources.links import page_links, season_options
from paysheaf.sources.profiles import profile_facts
from paths import SF0001


CATALOG = catalog()


def test_loose_html(spark):
    html = ("<table><!-- <tr><td><a href='/players/ghost'>G</a></td></tr> --><tr><th>Player<th>Position</tr>"
            "<tr><td><a class=mls-o-table__href href=/x>T</a><a href=/players/x/>A &amp; Mart&#237;nez &eacute;</a><td> D </tr></table>")
    pages = spark.createDataFrame([(1, html)], "page_id long, html string")
    r = table_rows(pages, link="players").collect()
    assert len(r) == 1
    assert r[0].headers == ["Player", "Position"]
    assert r[0].cells[1] == "D" and r[0].link_href == "/players/x/" and r[0].link_text == "A & Martínez é"
    assert table_rows(pages).collect()[0].link_href == "/x"


def test_classes_are_tokens_and_elements_nest(spark):
    html = ("<!-- <div class='salaryGuides'><a href='/no.pdf'>2001</a></div> --><div class='salaryGuides-archive'><a href='/old.pdf'>2002</a></div>"
            "<div class='x salaryGuides'><div><a href='/a.csv?a=1&amp;b=2'>2010 <b>x</b></a></div><a href=/b.pdf>2011</a></div><a href='/c.pdf'>2012</a>"
            "<select class='mls-o-buttons__dropdown-button mobile'><option value=1></select>"
            "<select class='mls-o-buttons__dropdown-button mobile-up'><option value=\"2015\"><option value='2016'><option value=x></select>")
    pages = spark.createDataFrame([(1, html)], "page_id long, html string")
    assert [(r.href, r.year) for r in page_links(pages).collect()] == [("/a.csv?a=1&b=2", 2010), ("/b.pdf", 2011)]
    assert [r.season for r in season_options(pages).collect()] == [2015, 2016]
    profile = ("<div class='mls-l-module--player-status-details__info'><div><h3>Height cm</h3></div><div><span>180</span></div></div>")
    facts = profile_facts(spark.createDataFrame([(1, profile)], "page_id long, html string")).collect()[0]
    assert facts.profile == {"height_cm": "180"}


def test_building_a_page_query_runs_no_job(spark):
    status = spark.sparkContext.statusTracker()
    before = len(status.getJobIdsForGroup(None))
    spark.sparkContext.setJobGroup("building", "no job expected")
    try:
        CATALOG["page_links"].build(spark, SF0001)
        CATALOG["html_roster_rows"].build(spark, SF0001)
        assert len(status.getJobIdsForGroup("building")) == 8  # each query reads the schemas of four tables
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert before >= 0


def test_jvm_engine_entities_and_names(spark):
    html = ('<table><tr><th class="a b">Player</th></tr><tbody><tr><td class="c">'
            '<a class="mls-o-table__href" href="/p/1"><img src="/i.png"/>'
            '<span class="short-name"> Jo &amp; Al </span></a></td><td>&nbsp;x </td></tr></tbody></table>')
    pages = spark.createDataFrame([(1, html)], "page_id long, html string")
    r = table_rows(pages).collect()[0]
    assert r.header_classes == ["a b"] and r.cells == ["Jo & Al", "x"]
    assert r.name_text == "Jo & Al" and r.thumb == "/i.png" and r.in_tbody and r.row_no == 1
    assert r.link_class == "mls-o-table__href"


def test_jvm_single_quoted_classes(spark):
    html = "<table><tr><th class='p q'>Player</th><th>X</th></tr><tr><td class='c'>1</td><td>2</td></tr></table>"
    pages = spark.createDataFrame([(1, html)], "page_id long, html string")
    r = table_rows(pages).collect()[0]
    assert r.header_classes == ["p q", ""] and r.cell_classes == ["c", ""]


def one_page(spark, html):
    return spark.createDataFrame([(1, html)], "page_id long, html string")


def test_rows_after_an_inner_table_stay(spark):
    html = ("<table class=outer><tr><th>Player<th>Position</tr><tr><td><a href='/players/a/'>A</a></td><td>D<table><tr><td>in 1</td>"
            "<td><table><tr><td>deep</td></tr></table></td></tr><tr><th>x</th></tr></table> tail</td></tr>"
            "<tr><td><a href='/players/b/'>B</a></td><td>M</td></tr></table><table><tr><td>next</td></tr></table>")
    rows = {(r.table_no, r.row_no): r for r in table_rows(one_page(spark, html)).collect()}
    assert sorted(rows) == [(0, 1), (0, 2), (1, 0), (2, 0), (3, 0)]
    assert rows[0, 1].cells == ["A", "Din 1deepxtail"] and rows[0, 1].headers == ["Player", "Position"]
    assert rows[0, 2].cells == ["B", "M"] and rows[0, 2].link_href == "/players/b/"
    assert rows[1, 0].cells == ["in 1", "deep"] and rows[2, 0].cells == ["deep"] and rows[3, 0].cells == ["next"]


def test_attribute_values_may_hold_markup(spark):
    html = ("<table title='<table>' class=\"x\"><tr><th class='p'>Player</th></tr><tr data-x=\"</tr>\"><td title=\"a>b\" class='c'>"
            "<a title='see href=\"/no\" > there' href='/players/z/?a>b'><b title='</a>'>Z</b> &lt;1&gt; &amp;amp; &#x41;&#38;lt;</a></td></tr></table>")
    r, = table_rows(one_page(spark, html)).collect()
    assert r.table_class == "x" and r.cell_classes == ["c"] and r.header_classes == ["p"]
    assert r.link_href == "/players/z/?a>b" and r.link_text == "Z<1> &amp; A&lt;" and r.cells == ["Z<1> &amp; A&lt;"]


def test_stray_quotes_end_no_page(spark):
    html = "<p title=it's>5'8\"</p><table><tr><td>it's</td><td a=\"1\">6\"</td></tr><tr><td>2</td></tr></table>"
    assert [r.cells for r in table_rows(one_page(spark, html)).collect()] == [["it's", '6"'], ["2"]]


def test_facts_stay_inside_their_elements(spark):
    head = "<div class='mls-o-masthead__branded-image'></div><div class=ad><img src=/ad.png alt=Ad></div>"
    inside = ("<div class='mls-o-masthead'>{box}<section class='x mls-o-masthead__club-logo-old'><img src=/old.svg></section>"
              "<a class='mls-o-masthead__club-logo' href='/clubs/sea/'><img src='/sea.svg'></a>"
              "<div class='mls-o-masthead__info-wrapper'><div>Goal</div><span>#10</span></div></div><div class='mls-o-masthead__info-wrapper'>#99</div>")
    empty = "<div class='mls-o-masthead__branded-image'><i></i></div>"
    full = "<span class=mls-o-masthead__branded-image><b><img alt=' N &amp; M ' src='/n.jpg'></b></span>"
    item = "<div class='mls-l-module--player-status-details__info'><h3>{}</h3><span>{}</span></div>"
    details = "<div class='mls-l-module--player-status-details'><div>" + item.format("Born", "<span>1990</span> <b>May</b>") + "</div></div>" + item.format("Other", "x")
    pages = spark.createDataFrame([(1, head + inside.format(box=empty) + head + details), (2, head + inside.format(box=empty + full)), (3, head), (4, None)],
                                  "page_id long, html string")
    got = {r.page_id: r for r in profile_facts(pages).collect()}
    assert (got[1].player_image, got[1].full_name, got[1].team_logo, got[1].club_slug, got[1].jersey_number_profile) == (None, None, "/sea.svg", "sea", "10")
    assert got[1].profile == {"born": "1990 May"}
    assert (got[2].player_image, got[2].full_name) == ("/n.jpg", "N & M")
    assert got[3].player_image is None and got[3].team_logo is None and got[3].jersey_number_profile is None
    assert got[4].player_image is None


def test_plans_of_page_queries_stay_small(spark):
    for key in ("html_roster_rows", "html_stats_rows", "html_profile_map"):
        optimised = CATALOG[key].build(spark, SF0001)._jdf.queryExecution().optimizedPlan().toString()
        assert optimised.count("regexp_extract(") < 150, key
        assert len(optimised) < 400_000, key
