"""The listing-specific rules, as data: names, words, placeholders and keyword rules.

Everything in this module is a fixed value of the listing format: labels and placeholder words as the pages
print them, and the names of the fields kept from the embedded JSON.
"""

from __future__ import annotations

# --- fixed values: page labels ------------------------------------------------------------------------
REMOTE_LABEL = "Obsługa zdalna"
ADDRESS_LABEL = "Adres"
PRICE_LABEL = "Cena"
DESCRIPTION_LABEL = "Opis"
JSON_SCRIPT_ID = "__NEXT_DATA__"
DESCRIPTION_CELL = "adPageAdDescription"
LABEL_PREFIX = "table-label"
VALUE_PREFIX = "table-value"
MISSING_PREFIX = "missing"

# --- fixed values: keys kept from the embedded JSON ---------------------------------------------------
JSON_KEYS = (
    "buildId", "userSessionId", "ad_photo", "price_currency", "cat_l1_id", "cat_l1_name",
    "special_offer_type", "ad_id", "ad_price", "business", "city_id", "city_name", "poster_type",
    "region_id", "region_name", "subregion_id", "costs", "equipment", "areas", "kitchen", "parking",
    "rooms", "windowsOrientation", "numberOfFloors", "security", "latitude", "longitude", "street",
    "subdistrict", "features", "featuresByCategory",
)

# --- fixed values: columns of the raw table that cleansing works on -----------------------------------
LISTING_COLUMNS = (
    "powierzchnia", "forma_wlasnosci", "liczba_pokoi", "stan_wykonczenia", "pietro",
    "balkon___ogrod___taras", "czynsz", "miejsce_parkingowe", "ogrzewanie", "rynek", "dostepne_od",
    "rok_budowy", "rodzaj_zabudowy", "okna", "winda", "media", "zabezpieczenia", "wyposazenie",
    "informacje_dodatkowe", "material_budynku", "adres", "opis", "ad_photo", "price_currency",
    "ad_price", "city_id", "poster_type", "region_id", "subregion_id", "latitude", "longitude",
)
CURRENCY = "PLN"
LIST_SEPARATOR = ", "
AREA_UNIT = " m²"
RENT_UNIT = " zł"

# --- fixed values: placeholder words, per column ------------------------------------------------------
ASK = "Zapytaj"
NO_INFORMATION = "brak informacji"

SCALAR_PLACEHOLDERS = {
    "forma_wlasnosci": ASK,
    "liczba_pokoi": ASK,
    "stan_wykonczenia": ASK,
    "czynsz": ASK,
    "miejsce_parkingowe": ASK,
    "ogrzewanie": ASK,
    "dostepne_od": NO_INFORMATION,
    "rok_budowy": NO_INFORMATION,
    "rodzaj_zabudowy": NO_INFORMATION,
    "okna": NO_INFORMATION,
    "material_budynku": NO_INFORMATION,
}

LIST_PLACEHOLDERS = {
    "balkon___ogrod___taras": ASK,
    "media": NO_INFORMATION,
    "zabezpieczenia": NO_INFORMATION,
    "wyposazenie": NO_INFORMATION,
    "informacje_dodatkowe": NO_INFORMATION,
}

# --- fixed values: floor and room words ---------------------------------------------------------------
FLOOR_WORDS = {
    "Parter": "0", "parter": "0",
    "Poddasze": "15", "poddasze": "15",
    "Suterena": "-1", "suterena": "-1",
    ASK: None,
}
ROOM_WORDS = {"więcejniż10": "11"}

# --- fixed values: description keywords, first match wins ---------------------------------------------
CONDITION_KEYWORDS = (
    (("do remontu",), "do remontu"),
    (("do zamieszkania",), "do zamieszkania"),
    (("do wykonczenia",), "do wykończenia"),
)
PARKING_KEYWORDS = ((("parking", "garaż"), "garaż/miejsce parkingowe"),)
HEATING_KEYWORDS = (
    (("miejskie",), "miejskie"),
    (("gazowe",), "gazowe"),
    (("elektryczne",), "elektryczne"),
)
KEYWORD_RULES = {
    "stan_wykonczenia": CONDITION_KEYWORDS,
    "miejsce_parkingowe": PARKING_KEYWORDS,
    "ogrzewanie": HEATING_KEYWORDS,
}

# --- fixed values: columns the profiling step re-types or drops ---------------------------------------
CATEGORY_COLUMNS = (
    "forma_wlasnosci", "stan_wykonczenia", "miejsce_parkingowe", "ogrzewanie", "rynek",
    "rodzaj_zabudowy", "okna", "winda", "material_budynku", "poster_type", "region_id", "subregion_id",
)
#: Columns that measure something; all other numbers are counts, indicators, codes or ids.
MEASURE_COLUMNS = ("powierzchnia", "czynsz", "ad_price")
UNUSED_COLUMNS = ("adres", "ad_photo", "price_currency")
REQUIRED_COLUMNS = ("powierzchnia", "ktore_pietro")
TARGET_COLUMN = "ad_price"
LOCATION_COLUMNS = ("latitude", "longitude")
FILL_NONE = "Brak"

# --- fixed values: single-letter transliteration of three alphabets -----------------------------------
GREEK = dict(zip("αβγδεζηθικλμνξοπρσςτυφχψω", "abgdezitiklmnkoprsstyfxpo"))
CYRILLIC = dict(zip("абвгдеёжзийклмнопрстуфхцчшщыэюя", "ABVGDEEZZIIKLMNOPRSTUFKTCSSYEYY"))
GEORGIAN = dict(zip("აბგდევზთიკლმნოპჟრსტუფქღყშჩცძწჭხჯჰ", "abgdevztiklmnopzrstupkgqsctdtckjh"))

# --- fixed values: Latin letters whose Unicode decomposition is not the wanted letter -----------------
LATIN_EXTRAS = {
    "Æ": "A", "æ": "a", "Ð": "D", "ð": "d", "Ø": "O", "ø": "o", "Þ": "T", "þ": "t", "ß": "s",
    "Đ": "D", "đ": "d", "Ħ": "H", "ħ": "h", "ı": "i", "Ĳ": "I", "ĳ": "i", "ĸ": "k",
    "Ĺ": "K", "Ļ": "K", "Ľ": "K", "Ŀ": "K", "ŀ": "l", "Ł": "L", "ł": "l",
    "ŉ": "n", "Ŋ": "N", "ŋ": "n", "Œ": "O", "œ": "o", "Ŧ": "T", "ŧ": "t", "ſ": "s", "ƒ": "f",
}
NAME_SEPARATORS = {" ": "_", "/": "_", ".": "_"}
