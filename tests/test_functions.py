"""Column functions and UDFs against restatements of their rules and known pairs."""

import re
from difflib import SequenceMatcher

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from collatio.functions import html, scalars, terms, text, udfs


@pytest.fixture
def one(spark):
    def value(f, *texts):
        """f over each text: a list of results."""
        df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
        return [r.v for r in df.select("i", f(F.col("t")).alias("v")).orderBy("i").collect()]

    return value


def test_groups_and_serials(one):
    assert one(text.strip_groups, "紅玉草(ルビー・グラス)(DM18 55/140)", "a (b) c", "a　(b)　", "", None, "(x)") == ["紅玉草", "a (b) c", "a", "", None, ""]
    assert one(text.strip_last_group, "a (b) (c)", "a") == ["a (b)", "a"]
    assert one(text.strip_set_serial, "Fire (Battle Card) (dm24EX4 PR27/PR60)", "Fire (For Live)") == ["Fire (Battle Card)", "Fire (For Live)"]
    assert one(text.strip_gs, "龍 GS", "龍GS") == ["龍", "龍GS"]
    assert one(text.strip_ps, "龍P'S ", "P'S龍") == ["龍", "P'S龍"]
    assert one(text.inner_bracket, "art [ボルシャック [x]]", "none") == ["ボルシャック [x]", "none"]
    assert one(text.strip_side_marks, "{side B} {Top}", "{龍} bottom", "Stop") == ["", "龍", "S"]


def test_splits(one):
    assert one(text.split_slash, "a/ b //c　", "", None) == [["a", "b", "c"], [], []]
    assert one(lambda c: text.split_slash(c, drop_empty=False), "a//b", "/") == [["a", "", "b"], ["", ""]]
    assert one(lambda c: F.struct(*text.split_two_sided(c)), "火 / 水 (DM1)", "火(a/b)", "火/水", "火") == [("火 (DM1)", "水 (DM1)"), ("火(a/b)", None), ("火", "水"), ("火", None)]
    assert one(lambda c: F.struct(*text.at_slash(c)), "A/B/C", "A") == [("A", "B/C"), ("Unknown", "Unknown")]
    parse = lambda c: F.struct(*text.listing_tokens(c).values())
    assert one(parse, "UA01ST/CGH-1-015 ルルーシュ・ランペルージ U", "no slash", "A/B") == [("UA01ST", "CGH-1-015", "ルルーシュ・ランペルージ", "U"), (None,) * 4, (None,) * 4]


def test_numbers(one):
    assert one(text.leading_int, "1,280円", "x", "", "99999999999", None) == [1280, 0, 0, 0, 0]
    assert one(text.stock_level, "在庫 ◯", "×", "残り3点", "?", None) == [20, 0, 3, 0, 0]
    assert one(scalars.power_to_int, "∞", "infinity", "5000+", " 500 ", "-3", "", None, "９") == [2147483647, 2147483647, None, 500, -3, None, None, None]
    assert one(scalars.digits_or_zero, "12", "-1", "", None, "99999999999") == [12, 0, 0, 0, 0]
    assert one(lambda c: scalars.half_even(c.cast("double"), 3), "0.0625", "0.0635") == [0.062, 0.064]


def test_codes(one):
    assert one(text.series_code, "556101", "556001", "556901", "556701", "999999") == ["OP01", "ST01", "PROMO", "FDS", "999999"]
    assert one(lambda c: text.series_code(c, "fw"), "583102", "583001", "583901", "583203") == ["FS02", "FB01", "PROMO", "SD03"]
    assert one(text.series_number, "OP01", "PRB02", "LIMITED", "OP", "OP123") == ["556101", "556302", "556801", "OP", "OP123"]
    assert one(text.series_order, "OP7", "ST123", "EB02", "PROMO", "OPx") == [1007, 20123, 3002, 9999, 9999]
    assert one(text.series_category, "ST1", "OP1", "EB1", "FDS") == ["deck", "expansion", "extra", "others"]
    assert one(lambda c: F.struct(*text.variant_uid(c)), "A@1", "A@3", "A") == [("A", "A_ALT"), ("A", "A_ALT3"), ("A", "A")]
    assert one(text.drop_variant_letter, "OGN-030a/298", "OGN-030/298") == ["OGN-030/298"] * 2
    assert one(text.booster_of_image, "/x/dm23ex1/dm24rp1.jpg", "/a/playsdeck2.jpg", "/a/playsdeck.png", "/a/b.png") == ["dm24rp1", "dmpcd02", "dmpcd01", ""]
    assert one(text.next_minor, "1.9", "2.0") == ["1.10", "2.1"]
    assert one(text.capitalized, "sUPER rare", "") == ["Super rare", ""]


def test_urls(one):
    assert one(text.last_segment, "https://x/a/b.c.png?v=1.2/3", "https://x/a/", "plain") == ["b.c", "", "plain"]
    assert one(text.parent_segment, "https://x/a/b.png", "b") == ["a", None]
    assert one(text.drop_image_query, "/a.PNG?20=1", "/a.txt?x") == ["/a.PNG", "/a.txt?x"]
    assert one(lambda c: text.first_match(c, r"location\.href='([^']+)'"), "location.href='/a/b'", "other") == ["/a/b", "other"]
    assert one(udfs.quoted, "/w/火 a?b=1", None) == ["/w/%E7%81%AB%20a?b=1", None]


def test_markup(one):
    assert one(text.breaks_to_newlines, "a<br>b<br/></div>&lt;x&gt;") == ["a\nb</div><x>"]
    assert one(text.raid_lines, "[Raid] on [Blue] 〈X〉 or <Y>\\nkeep [a] b", "-") == ["[Raid] [Blue] <X> <Y>\\nkeep [a] b", "-"]
    assert one(text.wiki_plain, "'''[[A|b]]''' [[C]] {{t}}") == ["b C"]
    assert one(lambda c: text.wiki_links(c), "[[A|b]] [[C]]") == [[("A", "b"), ("C", "C")]]
    assert one(text.repair_brackets, "a」b」", "「a」", "x」「y」", None) == ["「a」「b」", "「a」", "「x」「y」", None]
    assert one(lambda c: text.section(c, "K:", "A:", "E:"), "x K: one E: two A: three", "K: all", "none") == ["one", "all", None]
    assert one(text.without_fence, '```json\n{"a":1}\n```', "x") == ['{"a":1}', "x"]
    assert one(udfs.glyphs_named, '<img src="/i/rune_body_x.svg"> b') == ["{Body X} b"]
    assert one(lambda c: udfs.image_alts(c, {"自": "[Auto]"}), '<img alt="自">a<img alt="b"><img src="c">') == ["[Auto]a[b]"]
    assert one(html.labelled, "<table><tr><th>A</th><td>1<br> 2</td><th>B</th><td></td></tr><tr><td>x</td></tr></table><dl><dt>C</dt><dd>3 &amp; 4</dd></dl>") == [{"A": "1\n2", "B": "", "C": "3 & 4"}]
    assert one(lambda c: html.card_form(F.regexp_count(c, F.lit("d")), F.regexp_count(c, F.lit("i"))), "ddii", "ddi", "d", "dddi") == ["awaken", "twinpact", "single", "single"]
    assert one(lambda c: F.struct(*html.ruby_names(c)), "Fire<br><ruby><rb>火</rb><rt>ひ</rt></ruby>") == [("Fire", "火")]
    assert one(lambda c: html.sections(c, ("Race", "Power")), "<tr><th>N</th></tr><tr><td>Race:</td><td>r</td></tr><tr><th>M</th></tr><tr><td>Power</td><td>5</td></tr>") == [[{"name": "N", "Race": "r"}, {"name": "M", "Power": "5"}]]


def test_dates(one):
    assert [str(x) for x in one(scalars.japanese_date, "2024年5月3日発売", "2024年5月", "5月3日", "2024年13月1日", None)] == ["2024-05-03", "2024-05-01", "None", "None", "None"]
    assert one(scalars.japanese_date_text, "発売日2024年12月1日（日）", "未定") == ["2024-12-01", "未定"]
    assert one(scalars.epoch_seconds, "2024-01-01T00:00:00Z", "", None, "soon") == [1704067200, 0, 0, 0]


def test_vocabulary(one):
    icons = {
        "[icon_app_servetossarea]": "[Serve Area] [Toss Area]", "[icon_app_tossservearea_p] x": "[Serve Area] [Toss Area] x", "[icon_app_other_w]": "[other_w]", "[icon_draw]": "[Draw Phase]",
        "[icon_onetouch_03]": "[One Touch 03]", "[icon_onetouch_N]": "[One Touch]", "[icon_twoattack_02]": "[Two Attack 02]", "[icon_apass]": "[A Pass]", "[icon_apass_1]": "[A Pass]", "[icon_feint_N]": "[Feint N]",
        "[icon_serve_tefuda]": "[Serve Phase]", "[icon_servephase_itadaki]": "[Serve Phase] [From Top]", "a [icon_blockreceivephase_tefuda] b": "a [Block Phase] [Receive Phase] [From Hand] b", "[icon_servetoss_x]": "[Serve Phase] [Toss Phase]",
        "[icon_zzz]": "[icon_zzz]", "[icon_phase]": "[icon_phase]", "-": "-", "[icon_draw": "[icon_draw", "[icon_]": "[icon_]", "x]": "x]", "[icon_Turn_1][icon_draw]": "[Turn 1][Draw Phase]",
    }
    assert one(terms.decoded, *icons, None) == [*icons.values(), None]
    assert one(terms.replaced, "登場した時手札", "登場 x", "手札手札", "A登場B\n登場", "-", "", None) == ["When deployed Hand", "Deploy x", "Hand  Hand", "A Deploy B\nDeploy", "-", "", None]
    assert one(lambda c: terms.replaced(c, {"火": "Fire"}), "火 a火", "火") == ["Fire a火", "Fire"]
    assert one(text.affiliations, "烏野·1年,音駒·3年", "-", "他·9年") == [["Karasuno", "1st Year", "Nekoma", "3rd Year"], None, None]
    assert one(udfs.json_repaired, '{"a": 1}', '{"a": 1,', 'x {"a": {"b": 2}} y', "no") == ['{"a": 1}', '{"a": 1}', '{"a": {"b": 2}}', None]


#: Spellings of one name, and of different ones, under the full normaliser.
SAME = [("八頭竜 ACE-Yamata", "八頭龍ACE-Yamata"), ("ラウド \"NYZ\"", "ラウド NYZ"), ("der'Zen Mondo", "der`ZenMondo"), ("テック__", "テック"), ("ガンマ・ー", "Γ.-"), ("ァぁ", "アア"), ("ＡＢＣ", "abc")]


def test_names(one):
    for a, b in SAME:
        assert one(udfs.normalized, a, b) == [udfs.normal_name(a)] * 2, (a, b)
    assert one(lambda c: udfs.normalized(c, full=False), '竜 "a"', None) == ['竜"a"', None]


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=st.sampled_from("アァあぁ竜龍デルタガンマー~-–— 　_・·•\"'`“’〜Ａａßｱ"), max_size=20))
def test_normal_names_hold_no_folded_sign(name):
    once = udfs.normal_name(name)
    assert not re.search("[ 　\"'`・·•〜ー–—]", once) and once == once.casefold()
    # All spellings that differ in blanks and quotes only have one key, but for underscores: they go at the very end of what is written only.
    if not name.endswith("_"):
        assert udfs.normal_name(f"'{name} ") == once


def test_underscores_go_at_the_very_end_only():
    assert [udfs.normal_name(x) for x in ("_", "'_ ", "テック_", "テック_ ", "テック__")] == ["", "_", "テック", "テック_", "テック"]


def test_ratio(spark):
    pairs = [("tide", "diet"), ("diet", "tide"), ("", ""), ("abc", "abcd"), ("x" * 300, "xy" * 200), (None, "a")]
    df = spark.createDataFrame(pairs, "a string, b string")
    for r in df.select("a", "b", udfs.ratio("a", "b").alias("r")).collect():
        if r.a is None:
            assert r.r is None
        else:
            assert r.r == SequenceMatcher(None, r.a, r.b, autojunk=False).ratio()


SHOP = """<div class="py-4 cards-list"><h3 class="fw-bold"><span class="py-2">SR</span> list</h3><div class="row mt-2">
<div class="col card-product position-relative mt-4"><span class="d-block border border-dark p-1">UA01/X-1</span><a href="/p/1"><h4 class="fw-bold">火 &amp; 水</h4></a><strong class="d-block text-end">1,280 円</strong><label class="cart_sell_zaiko">在庫 : ◯</label></div>
<div class="col card-product position-relative mt-4 sold-out"><span class="d-block border border-dark p-1">Y</span><h4>名</h4><label class="cart_sell_zaiko">在庫 : 2 点</label></div></div></div>
<div class="py-4 cards-list"><p>no header</p><div class="card-product"></div></div>"""


def test_shop_pages(one):
    got = one(html.shop_rows, SHOP, "", None)
    assert [tuple(r) for r in got[0]] == [("SR", "UA01", "X-1", "火 &amp; 水", "/p/1", 1280, 20), ("SR", "Unknown", "Y", "名", "N/A", 0, 2)]
    assert got[1] == [] and got[2] is None
