from datetime import datetime, timedelta

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from listweave.functions import dates as D
from listweave.functions import html as H
from listweave.functions import text as T
from listweave.functions.hashes import canonical_json


def value(spark, column, **inputs):
    return spark.range(1).select(*[F.lit(v).alias(k) for k, v in inputs.items()]).select(column).first()[0]


@pytest.mark.parametrize("given_,want", [
    (" \u00a0rye\u200b \t\u00a0 and\ufeff oats ", "rye and oats"), ("a\na\n\n b ,c !\r\nb,c!", "a\nb,c!"), ("", None), ("\n \t", None), ("x\ty", "x y"), ("a\n b\na", "a\nb\na"), (None, None),
])
def test_clean_text(spark, given_, want):
    assert value(spark, T.clean_text("x"), x=given_) == want
    assert H.tidy(given_) == want


def test_clean_text_settles(spark):
    @given(st.text(alphabet="ab ,.\n\t\u00a0\u200b", max_size=60))
    @settings(max_examples=25, deadline=None)
    def run(s):
        once = value(spark, T.clean_text("x"), x=s)
        assert once == H.tidy(s)
        if once:
            assert value(spark, T.clean_text("x"), x=once) == once

    run()


def test_items(spark):
    assert value(spark, T.split_values("x"), x=" A, b,a ,,B,c") == ["A", "b", "c"]
    assert value(spark, T.clean_items(F.array(F.lit("x "), F.lit(None), F.lit("X"))), x=1) == ["x"]
    assert value(spark, T.clean_items(F.lit(None).cast("array<string>")), x=1) == []
    assert value(spark, T.without_heading("x", "Recipe"), x="rECIPE\nknead\nbake") == "knead\nbake"
    assert value(spark, T.join_items(F.array(F.lit("a"), F.lit("b"))), x=1) == "a\nb"


@pytest.mark.parametrize("given_,want", [
    ("Kỹ sư C++", "ky su cplusplus"), ("C# dev", "csharp dev"), (".NET", "dotnet"), ("Node.js", "nodejs"), ("c++ c++", "cplusplus cplusplus"), ("abc++", "abc++"), (None, ""), ("Đà Nẵng", "da nang"),
])
def test_search_form(spark, given_, want):
    assert value(spark, T.search_form("x"), x=given_) == want


@pytest.mark.parametrize("addresses,want", [
    (["Tầng 3, Quận 1, TP. Hồ Chí Minh"], ["Hồ Chí Minh"]), (["Thành phố Hà Nội"], ["Hà Nội"]), (["Da Nang city", "đà nẵng"], ["Đà Nẵng"]), (["Đường Hà Nội"], []), (["Hà Nộii", "Singapore", "Quận 1"], []),
    (["Saigon/hanoi\nHue"], ["Hồ Chí Minh", "Hà Nội", "Huế"]), (["Bà Rịa - Vũng Tàu"], ["Bà Rịa - Vũng Tàu"]), ([], []),
])
def test_cities(spark, addresses, want):
    assert value(spark, T.location_cities(F.array(*[F.lit(a) for a in addresses]).cast("array<string>")), x=1) == want


def test_urls_and_names(spark):
    assert value(spark, T.bare_url("x"), x="https://a.b/c?d=1#e") == "https://a.b/c"
    assert value(spark, T.bare_url("x", "h", slash=False), x="http://a.b/c/") == "https://h/c"
    assert value(spark, T.url_number("x", r"-(\d+)\.html$"), x="https://h/x-12.html?a=3") == "12"
    assert value(spark, T.safe_name("x"), x=" Á b/c_D ") == "b-c_d"
    assert value(spark, T.page_count("x", 50), x="Có 1.234 việc làm") == 25
    assert value(spark, T.cut_at_heading("x", ["Phúc lợi"]), x="a\nPhúc lợi:\nb") == "a"


def test_dates(spark):
    utc = lambda t: value(spark, D.parse_iso("x").cast("string"), x=t)
    assert utc("2024-05-01T10:00:00Z") == "2024-05-01 10:00:00" and utc("2024-05-01T10:00:00+02:00") == "2024-05-01 08:00:00"
    assert utc("2024-05-01T10:00:00") == "2024-05-01 03:00:00" and utc("soon") is None and utc("2024-13-01") is None
    assert value(spark, D.parse_day("x").cast("string"), x="đến 02/01/2024") == "2024-01-02 00:00:00"
    assert [value(spark, D.retry_delay(F.lit(n), 30, 100), x=1) for n in (1, 2, 3)] == [30, 60, 100]
    now = datetime(2024, 1, 2)
    assert D.age_is_usable(now, now, 1) and D.age_is_usable(now + timedelta(minutes=4), now, 1) and not D.age_is_usable(now + timedelta(minutes=6), now, 1) and not D.age_is_usable(now - timedelta(hours=2), now, 1)


def test_html_text():
    page = "<p>Knead <span>the</span> dough.</p><ul><li>Rye <strong>flour</strong></li><li>Warm<br>water</li></ul><script>x</script>"
    assert H.text_of(H.parse(page)) == "Knead the dough.\nRye flour\nWarm\nwater"
    assert H.items_of(H.parse(page)) == ["Rye flour", "Warm\nwater"] and H.items_of(H.parse("a<br>b<br>A")) == ["a", "b"]
    assert H.visible_of(H.parse("<b>a</b><style>s</style> c")) == "a c" and H.text_of(H.parse("")) is None
    assert H.text_of(H.parse("<div>" * 3000 + "deep")) == "deep"


def test_selectors():
    root = H.parse('<div id="m" class="a b"><p data-x="1">t</p></div><p>u</p>')
    assert [len(root.find_all(s)) for s in ("p", "#m p", ".a.b", "div.a p[data-x=1]", "[data-x]", "#n p", "p.a")] == [2, 1, 1, 1, 1, 0, 0]
    with pytest.raises(ValueError):
        H.parse_step("a>b")


def test_json_ld():
    ld = '<script type="application/ld+json">{"@graph":[{"@type":"Org"},{"@type":["X","JobPosting"],"title":"t","identifier":{"value":"7"},"jobLocation":[{"address":{"addressLocality":"Huế","addressCountry":{"name":"VN"}}},{"address":"x"}]}]}</script><script type="application/ld+json">{bad</script>'
    posting = H.posting_of(H.json_ld(H.parse(ld)))
    assert posting["title"] == "t" and H.posting_identifier(posting) == "7" and H.posting_locations(posting) == ["Huế, VN", "x"]
    assert H.item_list_urls({"a": {"@type": "ItemList", "itemListElement": [{"url": "u"}, {"item": {"@id": "v"}}, {"item": "w"}]}}) == ["u", "v", "w"]
    assert H.sections_of(H.parse("<h2>A</h2><p>x</p><p>y</p><h2>B</h2><p>z</p>")) == {"A": "x\ny", "B": "z"}


def test_html_columns(spark):
    frame = spark.createDataFrame([("<p>a<p>b", ), (None,)], "html string")
    got = frame.select(H.html_text("html"), H.has_selector("html", "p"), H.html_title("html")).collect()
    assert tuple(got[0]) == ("a\nb", True, None) and tuple(got[1]) == (None, None, None)


def test_canonical_json():
    assert canonical_json({"b": 1, "a": ["é"]}) == '{"a":["é"],"b":1}'
