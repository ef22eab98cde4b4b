import pytest
from pyspark.sql import functions as F

from kamienica import schema
from kamienica.functions import rules
from kamienica.operators import cleanse
from kamienica.plans.clean import clean_listings, listing_vocabulary

BASE = {c: "x" for c in rules.LISTING_COLUMNS} | {
    "pietro": "3/10", "powierzchnia": "54,3 m²", "liczba_pokoi": "3", "czynsz": "1 200,50 zł", "price_currency": "PLN",
    "ad_price": 500000.0, "latitude": 52.0, "longitude": 21.0, "opis": "cisza", "balkon___ogrod___taras": "balkon",
    "media": "prąd, woda", "zabezpieczenia": "brak informacji", "wyposazenie": "lodówka", "informacje_dodatkowe": "winda"}

CHANGES = {
    "plain": {}, "euro": {"price_currency": "EUR", "media": "tylko w euro"}, "no currency": {"price_currency": None},
    "no price": {"ad_price": None}, "null list": {"media": None}, "empty list": {"media": ""},
    "repeated": {"media": "woda, woda"}, "same token twice": {"media": "lodówka", "wyposazenie": "lodówka"},
    "accents": {"informacje_dodatkowe": "piwnica/komórka lokatorska"},
    "ask": {c: rules.ASK for c in ("forma_wlasnosci", "liczba_pokoi", "stan_wykonczenia", "pietro",
                                   "balkon___ogrod___taras", "czynsz", "miejsce_parkingowe", "ogrzewanie")} | {"opis": None},
    "described": {"stan_wykonczenia": rules.ASK, "miejsce_parkingowe": rules.ASK, "ogrzewanie": rules.ASK,
                  "opis": "do zamieszkania, garaż, ogrzewanie gazowe i miejskie"},
    "null condition": {"stan_wykonczenia": None, "opis": "do remontu"},
    "no information": {c: rules.NO_INFORMATION for c in ("dostepne_od", "rok_budowy", "rodzaj_zabudowy", "okna",
                                                         "material_budynku")},
}


@pytest.fixture(scope="module")
def raw(spark):
    rows = [tuple([key] + [{**BASE, **change}[c] for c in rules.LISTING_COLUMNS]) for key, change in CHANGES.items()]
    return spark.createDataFrame(rows, schema.RAW_LISTINGS)


@pytest.fixture(scope="module")
def vocabulary(raw):
    return cleanse.collect_vocabulary(listing_vocabulary(raw))


@pytest.fixture(scope="module")
def clean(raw, vocabulary):
    return {r["ad_id"]: r for r in clean_listings(raw, vocabulary).collect()}


def test_rows(clean):
    assert set(clean) == set(CHANGES) - {"euro", "no currency", "no price", "null list"}


def test_vocabulary_is_taken_before_the_filter(vocabulary):
    assert ("media", "tylko w euro") in vocabulary
    assert not {t for _, t in vocabulary} & {rules.ASK, rules.NO_INFORMATION}


def test_counts(clean):
    assert clean["plain"]["woda"] == 1 and clean["plain"]["prad"] == 1 and clean["plain"]["tylko_w_euro"] == 0
    assert clean["repeated"]["woda"] == 2
    assert clean["ask"]["balkon"] == 0
    assert clean["accents"]["piwnica_komorka_lokatorska"] == 1
    assert clean["empty list"]["media_"] == 1 and clean["plain"]["media_"] == 0


def test_clashing_names_get_their_source(clean):
    row = clean["same token twice"].asDict()
    assert row["lodowka"] == 1 and row["wyposazenie_lodowka"] == 1
    assert row["winda"] == "x" and row["informacje_dodatkowe_winda"] == 1


def test_scalars(clean):
    plain = clean["plain"]
    assert (plain["ktore_pietro"], plain["ile_pieter"], plain["liczba_pokoi"], plain["czynsz"]) == (3, "10", "3", "1 200,50")
    assert plain["powierzchnia"] == pytest.approx(54.3, abs=1e-5)
    asked = clean["ask"]
    assert [asked[c] for c in ("forma_wlasnosci", "liczba_pokoi", "stan_wykonczenia", "ktore_pietro", "czynsz",
                               "miejsce_parkingowe", "ogrzewanie")] == [None] * 7
    described = clean["described"]
    assert (described["stan_wykonczenia"], described["miejsce_parkingowe"], described["ogrzewanie"]) == (
        "do zamieszkania", "garaż/miejsce parkingowe", "miejskie")
    assert clean["null condition"]["stan_wykonczenia"] == "do remontu"
    assert [clean["no information"][c] for c in ("dostepne_od", "rok_budowy", "rodzaj_zabudowy", "okna",
                                                 "material_budynku")] == [None] * 5


def test_types(raw, vocabulary):
    kinds = dict(clean_listings(raw, vocabulary).dtypes)
    assert kinds["powierzchnia"] == "float" and kinds["ktore_pietro"] == "int" and kinds["ile_pieter"] == "string"
    assert kinds["woda"] == "bigint" and "pietro" not in kinds and "media" not in kinds


def test_options(raw, vocabulary):
    kept = clean_listings(raw, vocabulary, keep_null_lists=True).where("ad_id = 'null list'").first()
    assert kept["woda"] == 0 and kept["prad"] == 0
    part = raw.select("ad_id", "media")
    assert cleanse.multi_hot(part, ["media"], [("media", "woda")], binary=True).where("ad_id = 'repeated'").first()["woda"] == 1


def test_capital_labels_and_accents_resolve(spark, raw, vocabulary):
    spelled = {"powierzchnia": "Powierzchnia", "pietro": "Piętro", "balkon___ogrod___taras": "Balkon / ogród / taras",
               "opis": "Opis", "adres": "Adres"}
    page = raw.withColumnsRenamed(spelled)
    got = clean_listings(page, vocabulary)
    assert sorted(got.columns) == sorted(clean_listings(raw, vocabulary).columns)
    assert got.count() == len(CHANGES) - 4


def test_result_does_not_depend_on_partitions(raw, vocabulary, clean):
    for n in (1, 7):
        got = {r["ad_id"]: r for r in clean_listings(raw.repartition(n), vocabulary).collect()}
        assert got == clean


def test_no_shuffle_and_pushed_filters(spark, raw, vocabulary, tmp_path, capsys):
    raw.write.parquet(str(tmp_path / "raw"))
    df = clean_listings(spark.read.parquet(str(tmp_path / "raw")), vocabulary)
    df.explain("formatted")
    plan = capsys.readouterr().out
    assert "Exchange" not in plan and "Python" not in plan
    assert "IsNotNull(ad_price)" in plan and "StringContains(price_currency,PLN)" in plan


def test_cleaning_clean_text_changes_nothing(spark):
    df = spark.createDataFrame([("gotowe", "spokojne")], "stan_wykonczenia string, opis string")
    once = cleanse.backfill_from_text(cleanse.null_placeholders(df, {"stan_wykonczenia": rules.ASK}), "opis",
                                      {"stan_wykonczenia": rules.CONDITION_KEYWORDS})
    assert once.collect() == df.collect()


def test_wide_vocabulary_is_refused_not_cut(spark):
    words = cleanse.scan_vocabulary(spark.createDataFrame([("a, b, c",)], "t string"), {"t": None})
    with pytest.raises(ValueError):
        cleanse.collect_vocabulary(words, limit=2)
    assert len(cleanse.collect_vocabulary(words, limit=3)) == 3


def test_token_counts_sum_to_tokens(spark):
    df = spark.createDataFrame([(1, "a, a, b"), (2, None), (3, "b")], "id int, t string")
    assert cleanse.token_counts(df, "id", ["t"]).agg(F.sum("n")).first()[0] == 4


def test_surrogate_key_depends_on_the_row_only(spark):
    df = spark.createDataFrame([("a", 1), ("a", None), ("b", 1)], "u string, n int")
    keys = {tuple(r)[:2]: r["id"] for r in cleanse.surrogate_key(df, ["u", "n"]).collect()}
    again = {tuple(r)[:2]: r["id"] for r in cleanse.surrogate_key(df.repartition(3), ["u", "n"]).collect()}
    assert keys == again and len(set(keys.values())) == 3


def test_rename_folded(spark):
    assert cleanse.rename_folded(spark.createDataFrame([(1, 2)], "`Piętro 1` int, `b.c` int")).columns == ["Pietro_1", "b_c"]
