"""Rows of HTML tables: nested, with spans, without their ends; flows out of them."""

from __future__ import annotations

from datetime import date

from saltmarsh.sources import tables


def rows(spark, *pages):
    df = spark.createDataFrame(list(enumerate(pages)), "id long, html string")
    return {(r["id"], r["row"]): (r["cells"], r["grid"]) for r in tables.table_rows(df).collect()}


def test_rows_of_tables(spark):
    got = rows(
        spark,
        "<p>x</p><table><tr><th>h<td> a <b>b</b> &amp;\n c<td>d</table><tr><td>outside</td></tr>",
        "<TABLE><tr><td>1</td><td>o <table><tr><td>2<td>3</tr></table> p</td></tr><tr><td>4</td></tr></TABLE>",
        "<table><tr><td rowspan=2>A</td><td colspan='2'>B</td></tr><tr><td>C</td><td rowspan=3>D</td></tr><tr><td>E</td><td>F</td></tr></table>",
        None,
        "no rows <table></table> <track>",
        "<table><tr></tr><tr><td rowspan=x></td></tr>",
    )
    assert got == {
        (0, 0): (["a b & c", "d"], ["h", "a b & c", "d"]),
        (1, 0): (["1", "o 2 3 p", "2", "3"], ["1", "o 2 3 p"]),
        (1, 1): (["2", "3"], ["2", "3"]),
        (1, 2): (["4"], ["4"]),
        (2, 0): (["A", "B"], ["A", "B", "B"]),
        (2, 1): (["C", "D"], ["A", "C", "D"]),
        (2, 2): (["E", "F"], ["E", "F", "D"]),
        (5, 0): ([], []),
        (5, 1): ([""], [""]),
    }


def test_flow_rows(spark):
    def line(*cells):
        return "<tr>" + "".join(f"<td>{c}</td>" for c in cells) + "</tr>"

    body = [line("date", *"12345678"), line("2025.03.07", 1, 2, 3, 4, "+1,234", "-2,000", 7, 8), line("2025.13.07", 1, 2, 3, 4, 5, 6, 7, 8), line("2025.03.08", 1, 2, 3, 4, "x", 6, 7, 8), line("2025.03.09", 1, 2, 3, 4, "--", " ", 7, 8, 9), line("2025.03.10", 1, 2, 3)]
    df = spark.createDataFrame([(1, "<table>" + "".join(body) + "</table>"), (2, "")], "id long, html string")
    got = sorted(tuple(r) for r in tables.flow_rows(df).collect())
    assert got == [(1, 1, date(2025, 3, 7), 1234, 0, 766, -2000, 0), (1, 4, date(2025, 3, 9), 0, 0, 0, 0, 0)]


def test_bare_pages_are_read_as_the_parser_reads_them(spark):
    import random

    def parsed(html):
        walk = tables._Walk()
        walk.feed(html)
        walk.close()
        return walk

    def result(walk):
        return [[tables._text(c) for c in r["cells"]] for r in walk.rows], list(tables._spread(walk.rows))

    r, called = random.Random(5), []
    signs = ["<table>", "</table>", "<tr>", "</tr>", "<td>", "</td>", "<th>", "</th>", " a\n b ", ">", "1", "<tr><td>x</td><th> y z</th><td></td></tr>", "<tr></tr>"]
    for odd in (False, True):
        for _ in range(3000):
            html = "".join(r.choice(signs + ["&amp;", "<td colspan=2>", "<b>", "<!-- <tr> -->", "<TR>"] * odd) for _ in range(r.randrange(25)))
            walk = tables._Walk()
            walk.read(html)
            assert result(walk) == result(parsed(html)), html
    walk = tables._Walk()
    walk.feed = called.append
    walk.read("<table>" + "<tr><td>1</td></tr>" * 3 + "</table>")
    assert not called and len(walk.rows) == 3


def test_flows_lie_by_symbol(spark):
    from saltmarsh.plans import filing

    from .conftest import SMALL

    plan = filing.QUERIES["s7_flow_tables"](spark, SMALL)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1
