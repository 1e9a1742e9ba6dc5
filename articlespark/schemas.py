"""Declared schemas of the input and stage tables (DDL)."""

# Column names and types of the tables read and written.
RAW_ARTICLES = "title string, text string, subject string, date string"
RAW_TEST_EXTRA = "Column1 string, subject2 string, label int"
WORLD_CITIES = ("city_ascii string, admin_name string, country string, iso2 string, iso3 string, "
                "lat double, lng double, ord bigint")
US_STATES = ("`Place Name` string, Shortening string, `State Capital` string, Latitude double, "
             "Longitude double, ` Country` string, ord bigint")
COUNTRY_CONTINENT = ("country string, code_2 string, code_3 string, country_code int, iso_3166_2 string, "
                     "continent string, sub_region string, region_code int, sub_region_code int, ord bigint")
LOCATIONS_MAP = ("location string, latitude double, longitude double, state string, country string, "
                 "continent string, subcontinent string, ignore int")
WORDCLOUD_TEXT = "label tinyint, text string, year int"
LEXICON_SENTIMENT = "word string, polarity double, subjectivity double"
LEXICON_FORMS = "form string, lemma string"
