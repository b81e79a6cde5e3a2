import time

import pytest

from rollbook.llm.html_layout import extract, render

CASES = {
    "blocks": ("<h1>A</h1>x <b>y</b>  z<p>one<br>two<div>d</div>", "A\n\nx y z\n\none\ntwo\n\nd"),
    "implied": ("<p>a<p>b<ul><li>c<li>d</ul>e", "a\n\nb\n\n-  c\n-  d\n\ne"),
    "nested lists": ("<ol start=9><li>a<ul><li>b</ul><li>c</ol>", "9. a\n   -  b\n10. c"),
    "hidden": ("<head><title>t</title></head><p hidden>x</p><div style='DISPLAY : none'>y<p>z</p></div><script>a<b</script>s", "s"),
    "raw": ("<script>var t='</p>';</script>a<style>p{}</style><template>q</template>b<textarea> c\n d</textarea>", "ab c\n d"),
    "table": (
        "<table><caption>C<tr><th>Name<th>Qty<tr><td>apple<td>3<tr><td>fig<td>12</table>after",
        "C\nName   Qty\napple  3\nfig    12\n\nafter",
    ),
    "spans": ("<table><tr><td colspan=2>wide cell<td>x<tr><td>a<td>b<td>c<tr><td rowspan=2>r<td>1<br>2<tr><td>z</table>",
              "wide cell  x\na  b  c\nr  1\n   2\n   z"),
    "table in table": ("<table><tr><td>a<table><tr><td>b<td>c</table><td>d</table>", "a     d\n\nb  c"),
    "row without table row": ("<table><td>a<td>b</table>", "a  b"),
    "text among rows": ("<table>lost<tr><td>a</table>", "lost\na"),
    "pre": ("<pre>  a\n    b</pre>c", "  a\n    b\n\nc"),
    "references": ("&lt;p&gt; &amp;amp; &copy;x &#228;&nbsp;&bogus;", "<p> &amp; ©x ä\xa0&bogus;"),
    "comments": ("a<!-- <p>x -->b<!DOCTYPE html>c<![CDATA[d]]>e", "abce"),
    "not tags": ("1 < 2 <3 a<", "1 < 2 <3 a<"),
    "open quote": ("a<a href='x>b</a>c", "abc"),
    "open comment": ("a<!-- b", "a"),
    "stray ends": ("</div>a</p>b</table></li>c", "abc"),
    "details": ("<details><summary>s</summary>gone</details><details open><summary>t</summary>here</details>", "s\nt\nhere"),
    "definitions": ("<dl><dt>a<dd>b<dt>c<dd>d</dl>", "a\n   b\nc\n   d"),
    "rule": ("a<hr>b", "a\n\n---\n\nb"),
    "inputs": ("<input type=hidden value=x><input type=submit value=Go><select><option>1<option>2</select>", "Go\n1\n2"),
    "empty": ("", ""),
    "upper case": ("<DIV HIDDEN>x</DIV><P>y</P>", "y"),
}


@pytest.mark.parametrize("name", CASES)
def test_layout(name):
    html, want = CASES[name]
    assert render(html) == want


def test_all_words_stay():
    """Whatever the markup, visible words come out, in order, once."""
    import random
    import re

    rng = random.Random(0)
    tags = "p div b i ul li ol table tr td th span h2 dl dt dd blockquote pre a".split()
    for _ in range(300):
        parts, words = [], []
        for i in range(rng.randrange(40)):
            parts.append(f"<{rng.choice(['', '', '/'])}{rng.choice(tags)}>" if rng.random() < 0.6 else f" w{i}q ")
            if parts[-1][0] == " ":
                words.append(f"w{i}q")
        got = re.findall(r"w\d+q", render("".join(parts)))
        assert sorted(got) == sorted(words)


def test_deep_and_long_pages_end():
    start = time.time()
    for html in ("<div>" * 50_000 + "x", "<p" * 50_000, "<a href='" * 20_000, "<b>" * 20_000 + "</i>" * 20_000, "<td>" * 20_000, "x " * 500_000):
        render(html)
    assert time.time() - start < 30


def test_odd_rows(spark, odd):
    pages = odd.selectExpr("doc_id AS page_id", "text AS html", "score", "name AS text")
    rows = extract(pages, ["page_id", "score"]).collect()
    assert len(rows) == odd.count() and all(r.text is not None for r in rows)
    assert extract(pages.limit(0), ["page_id"]).count() == 0


def test_drawings_and_formulas():
    chart = (
        '<p>Sales <svg viewBox="0 0 9 9"><title>no</title><desc>no</desc><defs><text>no</text></defs> no <style/><circle r="1"/>'
        '<g><text x="1">North <tspan>1</tspan></text><text>South</text><text display="none">no</text></g>'
        "<foreignObject><b>total</b></foreignObject></svg> end</p><desc>kept</desc>"
    )
    assert render(chart) == "Sales North 1 South total end\n\nkept"
    formula = (
        "<p>so <math><semantics><mrow><mi>y</mi><mo>=</mo><mfrac><mn>1</mn> <mi>x</mi></mfrac><mspace/><mphantom>no</mphantom></mrow>"
        '<annotation encoding="application/x-tex">no</annotation></semantics></math> holds</p>'
    )
    assert render(formula) == "so y=1/x holds"
    assert render("<p>a <svg/> b <math/> c") == "a b c"


def test_visibility_of_each_element():
    page = '<div style="visibility: hidden">no <p style="visibility:visible">shown <i style="visibility: collapse">no</i></p><hr>no</div>end'
    assert render(page) == "shown\n\nend"
    assert render('<ul><li style="visibility:hidden">no</li><li>two</li></ul>').strip() == "-  two"
    assert render('<p style="backface-visibility: hidden">kept') == "kept"


def test_values_of_inputs():
    page = (
        'Name:<input value="Ann  Lee"><input type=hidden value=no><input type=checkbox value=no><input type=password value=no>'
        '<input type=email placeholder="your mail"><span style="visibility:hidden"><input value=no></span><input type=submit value=Go>'
    )
    assert render(page) == "Name: Ann Lee your mail Go"
