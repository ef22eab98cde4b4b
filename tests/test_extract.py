import json

import pytest
from pyspark.sql import functions as F

from kamienica import schema
from kamienica.contract.extraction import advert_pages
from kamienica.functions.html import AdvertParts, json_leaves
from kamienica.operators import extract

HEAD = '<a aria-label="Adres">ul. Długa</a><strong aria-label="Cena">500 000 zł</strong>'
JSON = '<script id="__NEXT_DATA__" type="application/json">{}</script>'
NESTED = {"props": {"ad_id": 1, "other": True, "ad": {"ad_price": 5.5, "ad_id": 2}}, "features": ["x", {"y": 1}],
          "business": True, "street": None, "Cena": "ignored"}
PAGES = [
    (1, "/a", HEAD + '<p class="c">no</p><p>opis &amp; więcej<div data-cy="adPageAdDescription">later</div>'
     '<div data-cy="table-label-content">Rynek</div><div data-testid="table-value-1"><i>wtó</i>rny</div>'
     '<div data-cy="table-label-content">Okna</div><div data-cy="missing-x">brak informacji</div>'
     '<div aria-label="Obsługa zdalna"><b data-cy="table-label-r">Obsługa zdalna</b><i data-cy="missing-r">brak</i></div>'
     '<div data-cy="table-label-content">Rynek</div><div data-testid="table-value-2">pierwotny</div>'
     '<div data-cy="table-label-content">Nadmiar</div>' + JSON.format(json.dumps(NESTED))),
    (2, "/b", HEAD + '<div data-cy="adPageAdDescription">tylko <b>div</b></div>' + JSON.format("{}")),
    (3, "/c", '<a aria-label="Adres">x</a><p>o</p>' + JSON.format("{}")),
    (4, "/d", HEAD + "<p>o</p>" + JSON.format("{broken")),
    (5, "/e", HEAD + "<p>o</p>"), (6, "/f", HEAD + JSON.format("{}")), (7, "/g", None), (8, "/h", ""),
    (9, "/i", HEAD + "<p>o</p>" + JSON.format("[1]")),
]


@pytest.fixture(scope="module")
def routed(spark):
    df = spark.createDataFrame(PAGES, schema.PAGES)
    return extract.extract_adverts(df, base="https://x").cache()


def test_fields(routed):
    data = routed.where("page_id = 1").first()["data"]
    assert data == {"Rynek": "pierwotny", "Okna": "brak informacji", "url": "https://x/a", "Adres": "ul. Długa",
                    "Cena": "500 000 zł", "Opis": "opis & więcej", "ad_id": "2", "ad_price": "5.5",
                    "features": '["x", {"y": 1}]', "business": "true", "street": None}


def test_description_falls_back(routed):
    assert routed.where("page_id = 2").first()["data"]["Opis"] == "tylko div"


def test_bad_pages_are_routed_with_a_reason(spark, routed):
    failed = {r["page_id"]: r["error"] for r in extract.failed_adverts(routed).collect()}
    assert set(failed) == {3, 4, 5, 6, 7, 8, 9}
    assert failed[3] == "no price" and failed[5] == "no embedded JSON" and failed[6] == "no description"
    assert failed[4].startswith("JSONDecodeError") and failed[8] == "no address"
    assert extract.failed_adverts(routed).count() + routed.where("status = 'ok'").count() == len(PAGES)


def test_wide_has_the_union_of_keys(routed):
    keys = extract.advert_keys(routed)
    assert "Rynek" in keys and keys == sorted(keys)
    wide = {r["page_id"]: r for r in extract.wide_adverts(routed, keys).collect()}
    assert set(wide) == {1, 2} and wide[2]["Rynek"] is None and wide[1]["ad_id"] == "2"
    with pytest.raises(ValueError):
        extract.advert_keys(routed, limit=3)


def test_extraction_does_not_shuffle(routed, capsys, spark):
    extract.wide_adverts(extract.extract_adverts(spark.createDataFrame(PAGES, schema.PAGES)), ["url"]).explain()
    assert "Exchange" not in capsys.readouterr().out


def test_leaves_by_reading_order():
    assert list(json_leaves({"a": {"b": 1, "c": {"b": 2}}, "l": [{"b": 3}], "e": {}})) == [
        ("b", 1), ("b", 2), ("l", [{"b": 3}])]


def test_odd_markup():
    parts = AdvertParts('<!-- <a aria-label="Adres">c</a> --><script>"<a aria-label=\'Adres\'>s</a>"</script>'
                        '<A ARIA-LABEL=Adres>u&#380;y<br>t</A><p>one<p>two</p><strong aria-label="Cena">1<script>x</script>2')
    text = {k: "".join(v) for k, v in parts.first.items()}
    assert text == {"address": "użyt", "paragraph": "one", "price": "12"}


def test_stray_quotes():
    parts = AdvertParts('<a aria-label="Adres" title="t"">x</a><strong aria-label="Cena" t="open>5</strong>')
    assert {k: "".join(v) for k, v in parts.first.items()} == {"address": "x", "price": "5"}


def test_broken_pages_take_linear_time():
    for piece in ('<a title="', "<a title='", "<", "<a", "</a", "<!", "<a =\"'"):
        AdvertParts(piece * 20000)
    AdvertParts("<!--" * 20000)
    AdvertParts("<div>" * 3000 + "</p>" * 3000)


LISTING = ('<!-- <a href="/gone"> --><script>var x = \'<a href="/gone">\'</script><a href="/ad/1?x=1&amp;y=2">1</a>'
           "<a name='n'>no</a><A class='k' HREF = '/ad/2'>2</A><a href=\"/skip/ad/3\">3</a>"
           '<ul><li class="page">1</li><li class="page"><b> 12 </b></li><li>next</li></ul>')


def test_links(spark):
    pages = spark.createDataFrame([(1, "u", LISTING), (2, "u", None), (3, "u", "<p>")], schema.PAGES)
    assert [r["link"] for r in extract.extract_links(pages).collect()] == ["/ad/1?x=1&y=2", "/ad/2", "/skip/ad/3"]
    got = extract.extract_links(pages, "/ad/", "/skip", "https://x").collect()
    assert [r["url"] for r in got] == ["https://x/ad/1?x=1&y=2", "https://x/ad/2"]
    numbers = pages.select(extract.last_page_number(F.col("html"), "page"), extract.last_list_item(F.col("html"))).collect()
    assert [tuple(r) for r in numbers] == [(12, "next"), (None, None), (None, None)]


def test_page_links(spark):
    assert [r["link"] for r in extract.page_links(spark, 3, "p/").collect()] == ["p/1", "p/2", "p/3"]


def test_long_forms(spark):
    df = spark.createDataFrame([(1, "a", "x", 1), (1, "a", "y", 2), (1, "b", "z", 1)], "id int, key string, value string, pos int")
    last = extract.last_wins(df, ["id", "key"], "value", "pos")
    assert sorted(map(tuple, last.collect())) == [(1, "a", "y"), (1, "b", "z")]
    right = spark.createDataFrame([(1, "b", "r"), (2, "a", "s")], "id int, key string, value string")
    merged = extract.merge_right_wins(last, right, ["id", "key"], "value")
    assert sorted(map(tuple, merged.collect())) == [(1, "a", "y"), (1, "b", "r"), (2, "a", "s")]
    wide = extract.pairs_to_wide(merged, "id", "key", "value", ["a", "b"])
    assert sorted(map(tuple, wide.collect())) == [(1, "y", "r"), (2, "s", None)]


def test_pages_of_a_narrow_table_are_parsed_by_many_tasks(spark, tmp_path):
    """One file of one split, many times as many pages as a task should parse."""
    part = spark.range(12_000).select(F.col("id").alias("p_partkey"), F.lit("ring").alias("p_name"), F.lit("b").alias("p_brand"),
                                      F.lit("PROMO").alias("p_type"), (F.col("id") % 50).cast("int").alias("p_size"))
    part.coalesce(1).write.parquet(str(tmp_path / "part.parquet"))
    routed = extract.extract_adverts(advert_pages(spark, str(tmp_path)))
    loads = routed.groupBy(F.spark_partition_id()).agg(F.count("page_id").alias("n"), F.sum("page_id").alias("s")).collect()
    assert len(loads) == 3 and max(r["n"] for r in loads) < 4200
    assert sum(r["n"] for r in loads) == 12_000 and sum(r["s"] for r in loads) == 12_000 * 11_999 // 2
