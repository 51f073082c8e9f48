"""Page trees: plain markup is read as the standard library's parser reads it."""

from hypothesis import example, given, settings, strategies as st

from tidemark.operators import markup
from tidemark.session import shared_path

PIECES = ["<div>", "</div>", '<div class="a b">', '<td title="x &amp; y">', "</td>", "<tr>", "<p>", "</p>", "<li>", "<br>",
          "<br/>", "<br />", '<img src="a.png" />', "<div/>", "<!-- note -->", "<!---->", "<!--->", "<!-- a -- b -->", "<!doctype html>",
          "<!DOCTYPE html>", "<script>if (a < b && c) x()</script>", "<script>'<\\/script>'</script>", '<style media="all">p > a {}</style>',
          "<script><!-- x --></script>", "<script>", "</script>", "<title>a b</title>", "<title>a &amp; b</title>",
          "<textarea><p></textarea>", "<textarea>words\n</textarea>", "<noscript>text</noscript>", "<iframe>x</iframe>", "<xmp>y</xmp>",
          "text", " ", "\n", "a &lt; b", "&nbsp;", "&amp", "&notit;", "a < b", "<", ">", "&", "<3", "</>", "<a href=x>", "<A HREF='y'>",
          '<a href="?a=1&b=2">', '<a href="x" href="y">', '<a href="x"title="y">', "<a disabled>", '<a data-x="1"\n title="2">', "</a >",
          "</DIV>", "<![CDATA[x]]>", "<?php x ?>", "<svg>", "</svg>", "<plaintext>", "é：", "\r\n", "\x00", "<td", '<td class="', "<x-y>",
          "<h1>", "</h1>", "<titles>", "<scripted>", "</ div>", "<title/>", '<title lang="en">t</title>', "<script/>", "<math>"]


def shape(node):
    """A tree as nested tuples."""
    return (node.tag, tuple(sorted(node.attrs.items())),
            tuple(c if isinstance(c, str) else shape(c) for c in node.children))


def by_library(html):
    b = markup._TreeBuilder()
    b.feed(html)
    b.close()
    return b.tree.root


@settings(max_examples=3000, deadline=None)
@given(st.lists(st.sampled_from(PIECES), max_size=14).map("".join))
@example("")
@example("no tag &amp; some text")
def test_trees_are_those_of_the_library(html):
    assert shape(markup.parse_html(html)) == shape(by_library(html))


def test_plain_pages_take_the_short_way():
    page = ('<!DOCTYPE html>\n<html><head><title>A car</title><script>if (a < b) { go("&") }</script></head><body>'
            '<!-- top --><div class="box config-section"><p>one<p>two &amp; three<br/><img src="a.png" /></div></body></html>\n')
    root = markup._plain_tree(page)
    assert root is not None and shape(root) == shape(by_library(page))
    assert markup._plain_tree(page.replace("<br/>", "<BR>")) is None
    assert all(n.parent is not None for n in root.descendants())


SHEET = ['<div class="config-section">', '<div class="a config-section b">', '<div class="special-layout-18">', "<div>", "</div>",
         "<table>", "</table>", "<tr>", "<td>", "</td>", '<td><span class="title">label：</span></td><td><span class="info">x</span></td>',
         '<span class="title">', '<span class="info">', "</span>", "t：", "x &amp; y", "<p>", "<br>", '<div class="l">', "</ul>", "<li>",
         '<div class="focus-color-warp"><ul><li><a title="red"><span style="b#ffffff"></span></a></ul>', "<!-- c -->",
         "<script>var a;</script>", '<div class="config-section"/>', '<DIV class="config-section">', '<div class="config&#45;section">',
         "<title>x</title>", "&nbsp;"]
OPEN = ['<div class="config-section"><div class="special-layout-18"><table><tr>', '<div class="special-layout-18">', ""]


@settings(max_examples=3000, deadline=None)
@given(st.sampled_from(OPEN), st.lists(st.sampled_from(SHEET), max_size=16).map("".join), st.sampled_from(OPEN),
       st.lists(st.sampled_from(SHEET), max_size=8).map("".join))
def test_sheet_rows_need_only_their_scope(first, html, second, more):
    page = first + html + second + more
    whole = markup.spec_sheet_rows(by_library(page))
    assert markup.spec_sheet_rows(markup.parse_html(page, "config-section")) == whole


def test_what_is_outside_the_scope_is_not_built():
    scope = '<div class="box config-section"><p>one<p>two</div>'
    root = markup._plain_tree(f"<nav><ul><li>a<li>b</ul></nav>{scope}<p>{scope}<footer>end<b a=1>", "config-section")
    assert [n.tag for n in root.descendants()] == ["div", "p", "p"] * 2


_CELLS = st.recursive(
    st.sampled_from(["", "x", "a&amp;b", "é", "<br/>", '<span class="info">i</span>', '<div class="l">l</div>',
                     '<a title="t"><span style="s"></span></a>']),
    lambda inner: st.tuples(st.sampled_from(["div", 'div class="l"', 'div class="focus-color-warp"', 'span class="info"', "li",
                                             "ul", "td", 'td class="q"', "p", 'span class="title"', 'a title="u"']),
                            st.lists(inner, max_size=3))
    .map(lambda x: f"<{x[0]}>{''.join(x[1])}</{x[0].split()[0]}>"), max_leaves=8)
_LABELS = st.sampled_from(["", "长：", "a<i></i>b", "x&amp;y："])
_ROWS = st.lists(st.tuples(_LABELS, st.lists(_CELLS, max_size=3)).map(
    lambda r: f'<tr><td><span class="title">{r[0]}</span></td>{"".join(f"<td>{c}</td>" for c in r[1])}</tr>\n'), max_size=4)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.tuples(_ROWS, st.sampled_from(["", "</td>", "<!-- c -->", "<td>"])), max_size=4))
def test_many_pages_read_together_like_each_alone(pages):
    """The rows of pages read together are those of each page's tree, and no plain sheet is left out."""
    import pyarrow as pa

    bodies = [f'x<div class="box config-section"><div class="special-layout-18"><table>{"".join(rows)}{odd}'
              "</table></div></div>" for rows, odd in pages]
    bodies += ["", "no tags", '<div class="config-section"><div class="special-layout-18"><table><tr><td><span class="title">'
               '长：</span></td><td><span class="info">1</span></td></tr></table></div></div>']
    read, rows = markup.spec_sheet_table(pa.array(["cut off", *bodies])[1:])
    got = [[] for _ in bodies]
    for i, page in enumerate(rows["page"]):
        assert rows["pos"][i].as_py() == len(got[page])
        got[page].append({c: rows[c][i].as_py() for c in ("label", "info", "alt", "colours")})
    for body, known, mine in zip(bodies, read, got):
        assert mine == (markup.spec_sheet_rows(markup.parse_html(body)) if known else [])
    assert read[-3:].all() and len(got[-1]) == 1


def test_dictionary_is_the_broadcast_side(spark):
    """Made from rows, the dictionary has no size the planner knows: small pages were broadcast instead."""
    import contextlib
    import io

    from tidemark.operators import spec
    from tidemark.sources.dimensions import spec_dictionary

    rows = spark.createDataFrame([(1, 0, "长：", ["5"], [], [])],
                                 "page_id long, pos int, label string, info array<string>, alt array<string>, "
                                 "colours array<struct<title: string, style: string>>")
    path = shared_path(spark, "t-dictionary-side")
    rows.write.parquet(path)
    values = spec.spec_values(spark.read.parquet(path), spec_dictionary(spark))
    with contextlib.redirect_stdout(io.StringIO()) as said:
        values.explain()
    assert "BuildRight" in said.getvalue() and "BuildLeft" not in said.getvalue()
    docs = spec.assemble_documents(values, spark.createDataFrame([(1,), (2,), (None,)], "page_id long"))
    with contextlib.redirect_stdout(io.StringIO()) as said:
        docs.explain()
    assert said.getvalue().count("hashpartitioning") == 1
    got = {r.page_id: r.content for r in docs.collect()}
    assert got[2] == got[None] == "{}" and '"5"' in got[1]
