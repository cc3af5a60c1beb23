"""HTML pages: what is read once, what is freed at once, odd tables."""

import gc
import weakref

from kindred.sources import html as H

TABLE = '<table id="stats_standard"><tr>{top}</tr><tr>{low}</tr>{rows}</table>'


def test_a_tag_is_read_once():
    """Equal tags of a page share what was read of them (failed before)."""
    page = H._page("<table>" + '<tr class="odd"><td class="a b">x</td></tr>' * 500 + "</table>")
    first, *others = page.walk(0, "td")
    assert len(others) == 499 and all(page.attrs[i] is page.attrs[first] for i in others)
    H._tag.cache_clear()
    long = f'<img alt="{"x" * 10_000}">'
    assert H._page(long).attrs[1] == {"alt": "x" * 10_000} and H._tag.cache_info().currsize == 0


def test_a_page_is_freed_when_its_rows_are_made():
    """No page waits for the garbage collector (failed before: its elements held the page and the page held them)."""
    gc.collect()
    gc.disable()
    try:
        for html in ("<p><b>x</b></p>", "<p class=x>y"):  # by pattern, by the standard parser
            page = H._page(html)
            held = weakref.ref(page)
            del page
            assert held() is None
    finally:
        gc.enable()


def test_odd_statistics_tables(spark):
    """Equal names, names that are equal once cleaned, short, long and empty rows, a missing league."""
    cells = lambda tag, *texts: "".join(f"<{tag}>{t}</{tag}>" for t in texts)
    row = lambda *texts: f"<tr>{cells('td', *texts)}</tr>"
    twice = TABLE.format(
        top=cells("th", "", "A", "a", "A"), low=cells("th", "Rk", "x", "x", "x"),
        rows=row("1", "p", "q", "r") + row("2", "p", "q") + row() + row("Rk") + row("3", "p", "q", "r", "s"),
    )
    plain = TABLE.format(top=cells("th", "A"), low=cells("th", "Rk"), rows=row("Rk") + row("<!-- <td> -->4 <b>&lt;</b>"))
    pages = spark.createDataFrame([(1, None, twice), (2, "L", plain), (3, "L", TABLE), (None, "L", "")], "page_id long, league string, html string")
    found = [(r.page_id, r.league, r.row_no, r.stats) for r in H.statistics_tables(pages).orderBy("page_id", "row_no").collect()]
    assert found == [
        (1, None, 0, {"0_rk": "1", "a_x": "q"}), (1, None, 1, {"0_rk": "2", "a_x": "q"}), (1, None, 2, {}),
        (1, None, 4, {"0_rk": "3", "a_x": "q"}), (2, "L", 0, {"a_rk": "Rk"}), (2, "L", 1, {"a_rk": "4 <"}),
    ]


def test_squad_rows_leave_python_only_under_countries(spark):
    """Headings without a country code make no rows that Spark would drop later (they did before)."""
    squad = '<table class="wikitable"><tr><th>No.</th></tr>{}</table>'
    row = "<tr><td>1</td><td>{}</td><td>{}</td><td>30</td><td>{}</td></tr>"
    html = (
        "<h2>Brazil</h2><h3>Atlantis</h3><h3>Group A</h3><h2>Notes</h2><h3> <b>France</b> </h3>"
        + squad.format(row.format("1GK", "Ann (c)", "X") + row.format("zz", "Bob", "Y") + "<tr><td>DF</td><td>Cy</td></tr>" + "<tr><td>x</td><td>DF</td><td>Di</td></tr>")
        + "<table></table><h2>Spain</h2>" + squad.format("") + "<h2>Atlantis</h2>" + squad.format(row.format("DF", "Eve", "Z")) + "<h2>Brazil</h2>"
    )
    assert list(H._section_rows(html)) == [
        ("Brazil", 0, "1GK", "Ann (c)", "X"), ("Brazil", 3, "DF", "Di", ""), ("France", 0, "1GK", "Ann (c)", "X"), ("France", 3, "DF", "Di", ""),
    ]
    pages = spark.createDataFrame([(1, html), (None, html), (2, None), (3, "<h2>Brazil</h2>")], "page_id long, html string")
    found = [tuple(r) for r in H.squad_sections(pages).where("page_id = 1").orderBy("nation", "row_no").collect()]
    assert found == [
        (1, 0, "Ann", "GK", "BRA", "X", "Brazil", 1), (1, 3, "Di", "DF", "BRA", "", "Brazil", 1),
        (1, 0, "Ann", "GK", "FRA", "X", "France", 1), (1, 3, "Di", "DF", "FRA", "", "France", 1),
    ]
    assert H.squad_sections(pages).where("page_id IS NULL").count() == 4


def test_each_heading_takes_the_next_table():
    section = '<h2>Brazil</h2><table class="wikitable"><tr></tr><tr><td>{0}</td><td>GK</td><td>P{0}</td></tr></table>'
    rows = list(H._section_rows("".join(section.format(i) for i in range(500))))
    assert [r[3] for r in rows] == [f"P{i}" for i in range(500)]


def test_unnamed_listing_rows_stay_in_python(spark):
    """Rows without a name count, but are not handed to Spark (they were); the first cell of a kind counts, an empty one too."""
    row = '<tr class="{}"><td>{}</td><td class="x posrela">{}</td><td class="posrela">late</td><td class=" zentriert ">{}</td><td class="{}">€1m</td></tr>'
    name = '<a href="#">no</a><a class="spielprofil_tooltip"> {} </a>'
    html = (
        '<table class="item"></table><table class="big items"><tr class="odd"><td>short</td></tr>'
        + row.format("odd", "nobody", "p", "1", "rechts hauptlink") + row.format("even", name.format(""), "p", "2", "rechts hauptlink")
        + row.format("x even", name.format("Ann"), "", "3", "rechts hauptlink") + row.format("plain", name.format("Bob"), "p", "4", "rechts hauptlink")
        + row.format("odd", name.format("Cy"), "p", "5", "hauptlink rechts") + "</table>"
    )
    assert list(H._listing_rows(html)) == [(2, "Ann", "", "3", "€1m"), (3, "Cy", "p", "5", None)]
    pages = spark.createDataFrame([(1, None, html), (2, "L", None), (3, "L", "<p>")], "page_id long, league string, html string")
    found = [tuple(r) for r in H.value_listings(pages).orderBy("row_no").collect()]
    assert found == [(1, None, 2, "Ann", "", "3", "€1m", 1e6), (1, None, 3, "Cy", "p", "5", None, None)]
