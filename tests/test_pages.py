"""Element trees, selectors and the box layouts of the catalogue's sites."""

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from collatio.functions import html, pages

TITLED = """<div class="cardNoCol"><span class="cardNo">XX01-001</span></div>
<div class="cardDataRow side"><dl class="dataBox"><dt class="dataTit">Lv.</dt><dd class="dataTxt"> 4 </dd></dl><dl class="dataBox"><dt class="dataTit">COST</dt><dd class="dataTxt">3</dd></dl></div>
<div class="cardDataRow overview"><div class="dataTxt">【Deploy】 Draw 1.<br>Then &lt;rest&gt;.<br></div></div>
<div class="cardDataRow"><dl class="dataBox"><dt class="dataTit">Zone</dt><dd class="dataTxt">Space <b>Earth</b></dd></dl><dl class="dataBox"><dt class="dataTit">Trait</dt></dl><dl class="dataBox"><dd class="dataTxt">lost</dd></dl></div>"""
SIDE, REST = pages.Boxes(".cardDataRow.side .dataBox", ".dataTit", ".dataTxt", joined=True), pages.Boxes(".cardDataRow:not(.side) .dataBox", ".dataTit", ".dataTxt", joined=True)


def texts(values):
    return {k: v[0] for k, v in values.items()}


def test_boxes_with_titles():
    page = pages.tree(TITLED)
    assert texts(pages.boxed_values(page, SIDE)) == {"Lv.": "4", "COST": "3"}
    assert texts(pages.boxed_values(page, REST)) == {"Zone": "SpaceEarth", "Trait": ""}
    assert pages.first(page, ".cardNoCol .cardNo").text() == "XX01-001"
    assert pages.first(page, ".cardDataRow.overview .dataTxt").text() == "【Deploy】 Draw 1.\nThen <rest>."


def test_cells_with_headings():
    page = pages.tree('<h6>no</h6><div class="cardData"><div class="cardDataRow"><div class="cardDataCell"><h6>Card type</h6><div class="data"> LEADER<br/>x</div></div><div class="cardDataCell x"><h6>Color</h6><div class="datum">no</div><div><div class="data">Red</div></div></div></div></div><div class="cardDataCell"><h6>Out</h6><div class="data">side</div></div>')
    assert texts(pages.boxed_values(page, pages.Boxes(".cardData .cardDataRow .cardDataCell", "h6", "div.data"))) == {"Card type": "LEADER\nx", "Color": "Red"}


def test_lists_and_status_items():
    page = pages.tree('<div class="info"><dl><dt>色</dt><dd><img src="a" alt="赤"></dd></dl><dl><dt>特徴</dt><dd>A・B</dd></dl><dl><dt>only</dt></dl></div><div class="status"><span class="status-Item"><span class="heading">レベル</span> 3 <i>x</i></span><span class="status-Item">none</span></div>')
    assert pages.boxed_values(page, pages.Boxes(".info dl", "dt", "dd")) == {"色": ("", ["赤"]), "特徴": ("A・B", []), "only": ("", [])}
    assert texts(pages.boxed_values(page, pages.Boxes(".status span.status-Item", "span.heading"))) == {"レベル": "3 x"}


def test_parallel_labels_and_values():
    page = pages.tree('<div class="info"><dl><dt>HP<dd>120<dt>色<dd><img alt="白"><img alt="緑"><dt>タグ<dd>#a <a>#b</a></dl></div>')
    assert pages.boxed_values(page, pages.Boxes(".info", "dt", "dd", each=True)) == {"HP": ("120", []), "色": ("", ["白", "緑"]), "タグ": ("#a #b", [])}
    page = pages.tree('<div class="attribute"><div><h3>所属</h3><ruby>烏野<rt>からすの</rt></ruby>・2年</div><div>no heading</div></div>')
    assert texts(pages.boxed_values(page, pages.Boxes(".attribute div", "h3"))) == {"所属": "烏野からすの・2年"}


def test_selectors():
    page = pages.tree('<div id="a" class="x y"><p class="y">1</p><ul><li class="y"><a href="/p/1">2</a><li>3</ul></div><div style="color: white; x">4<br></div><div style="color: white">5</div>')
    said = lambda s: [x.text() for x in pages.select(page, s)]
    assert said(".y p") == ["1"] and said("div > p") == ["1"] and said("div > li") == [] and said("#a li") == ["2", "3"]
    assert said("ul > li.y > a[href]") == ["2"] and said("a[href*='/p/']") == ["2"] and said("a[href=x]") == [] and said("p, a") == ["1", "2"]
    assert said("div[style*='color: white']:has(br)") == ["4"] and said("div:not(.x)") == ["4", "5"] and said("li:not([class])") == ["3"] and said("div.x.y > *") == ["1", "23"]
    assert [x.text() for x in pages.select(pages.first(page, "ul"), ".x a")] == []
    with pytest.raises(ValueError, match="no selector"):
        pages.select(page, "p::before")


def test_nested_tables():
    nested = "<table><tr><td>Outer</td><td>before<table><tr><td>a</td><td>b</td></tr></table>after</td></tr><tr><th>k<td>v<th>l<td>w</table>"
    assert pages.label_rows(nested) == {"Outer": "beforeabafter", "a": "b", "k": "v", "l": "w"}
    assert pages.label_rows("<tr><td>x</td><td>y") == {"x": "y"} and pages.label_rows("<td>x</td></table></td><td>") == {} and pages.label_rows("") == {}


WIKI = """<table class="nav"><tr><td>Race:</td><td>no</td></tr></table><table class="wikitable"><tr><th colspan=2><div style="color: white;">Bolshack <img alt="卍"> Dragon<br><small><ruby><rb>火</rb><rp>(</rp><rt>か</rt></ruby>竜<img alt="★"></small></div></th></tr>
<tr><td>Civilization:</td><td><a>Fire</a> icon</td></tr><tr><td>Mana Cost:</td><td>6</td></tr><tr><td>English Text</td><td>■ One<br>■ Two<table><tr><td>Power</td><td>nested</td></tr></table></td></tr>
<tr><td><div style="color: white">no break</div></td></tr><tr><th><div style="background: red; color: white">Side B<br><small>裏</small></div></th></tr><tr><td>Race:</td><td>R1 / R2</td><td>x</td></tr><tr><td>Unknown</td><td>z</td></tr></table>"""
NAMES = ("Civilization", "Card Type", "Mana Cost", "Race", "Power", "English Text")


def test_sections_by_style():
    assert pages.header_sections(WIKI, NAMES, "table.wikitable") == [
        {"name": "Bolshack 卍 Dragon", "name_jp": "火竜★", "Civilization": "Fire", "Mana Cost": "6", "English Text": "■ One\n■ TwoPowernested", "Power": "nested"},
        {"name": "Side B", "name_jp": "裏", "Race": "R1 / R2"},
    ]
    assert pages.header_sections("<table><tr><td>Race</td><td>r</td></tr></table>", NAMES) == []


def test_columns(spark):
    df = spark.createDataFrame([(TITLED,), (None,), ("",), ("<p>" * 3000 + "deep",)], "h string")
    found = [r.b for r in df.select(pages.boxes(F.col("h"), SIDE, REST).alias("b")).collect()]
    assert {k: v.text for k, v in found[0].items()} == {"Lv.": "4", "COST": "3", "Zone": "SpaceEarth", "Trait": ""} and found[1:] == [None, {}, {}]
    assert df.select(pages.texts_of(F.col("h"), "dt.dataTit")).first()[0] == ["Lv.", "COST", "Zone", "Trait"]
    assert [r[0] for r in df.select(html.labelled("h")).collect()][1:] == [None, {}, {}]
    wiki = spark.createDataFrame([(WIKI,), (None,)], "h string").select(html.sections(F.col("h"), NAMES, "table.wikitable").alias("s")).collect()
    assert [x["name"] for x in wiki[0].s] == ["Bolshack 卍 Dragon", "Side B"] and wiki[1].s is None


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from(["<div>", "</div>", "<table>", "</table>", "<tr>", "</tr>", "<td>", "</td>", "<li>", "<ul>", "</ul>", "<br>", "<p>", "</p>", "a", "b", "<img alt=c>", "<script>x</script>"]), max_size=40))
def test_any_nesting_keeps_its_text(pieces):
    page = pages.tree("".join(pieces))
    assert "".join(x for x in page.walk() if isinstance(x, str)) == "".join(p for p in pieces if p in ("a", "b"))
    for x in page.elements():
        assert any(c is x for c in x.parent.children)
    pages.label_rows("".join(pieces))


PIECES = ["<div>", "</div>", "<table>", "</table>", "<tr>", "</tr>", "<td>", "</td>", "<th>", "<li>", "<ul>", "</ul>", "<br>", "<BR />", "<p class='x y'>", "</P>", "a", "b &amp; c", "&lt", "x > y", "\n", "<img alt=c>", '<img alt="&quot;q" src=\'/x\'/>', "<div/>", "<dt>", "<dd>", "</dl>", "<!-- c -->", "<script>x<b></script>", "<title>t</title>", "<a href=x/>", "< b", "<p\x0bq>", "</p >"]


def shape(element):
    return element.tag, element.attrs, [x if isinstance(x, str) else shape(x) for x in element.children]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from(PIECES), max_size=30))
def test_remembered_tags_give_the_trees_of_the_parser(pieces):
    assert shape(pages.tree("".join(pieces))) == shape(pages._read("".join(pieces)).root)


def test_plain_pages_need_no_parser(monkeypatch):
    """A tag is parsed once a worker, not once a page."""
    assert len(pages.header_sections(WIKI, NAMES, "table.wikitable")) == 2
    pages.boxed_values(pages.tree(TITLED), SIDE)
    monkeypatch.setattr(pages, "_read", None)
    assert len(pages.header_sections(WIKI.replace("Fire", "Water"), NAMES, "table.wikitable")) == 2
    assert texts(pages.boxed_values(pages.tree(TITLED.replace("Lv.", "Level")), SIDE)) == {"Level": "4", "COST": "3"}
