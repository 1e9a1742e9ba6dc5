"""Place mentions over the documents, against small literal lookups keyed on corpus words."""

from pyspark.sql import functions as F

from ..operators import locations as loc
from ..operators.joins import member_flag, update_from
from ..runtime import materialize, small
from .. import schemas
from .core import ARTICLES, NLP, articles, literal, nlp_text, register, table, values_sql

# Every branch of the enrichment is reached: two cities of one name, a phrase that starts with another
# name, a capital, a state, a country, both codes, the code NA, a region row with gaps.
CITIES = [("Der", "Bavaria", "Germany", "DE", "DEU", 48.1, 11.5, 0), ("der", "Tirol", "Austria", "AT", "AUT", 47.2, 11.4, 1),
          ("De La", "Lima", "Peru", "PE", "PER", -12.0, -77.0, 2), ("With", "Texas", "US", "US", "USA", 31.0, -97.0, 3),
          ("Houston", "Texas", "US", "US", "USA", 29.8, -95.4, 4), ("Une", "Khomas", "Namibia", "NA", "NAM", -22.6, 17.1, 5),
          ("Nowhere", None, "Peru", "PE", "PER", 1.0, 1.0, 6), ("Roma", "Lazio", "Italy", "IT", "ITA", 41.9, 12.5, 7),
          ("Cork", "Munster", "Irland", "IR", "AND", 51.9, -8.5, 8)]
STATES = [("Texas", "(TX)", "That", 31.0, -100.0, "US", 0), ("On", "(ON)", "Toronto", 50.0, -85.0, "Canada", 1),
          ("Was", "(WA)", "On", 47.0, -120.0, "US", 2)]
REGIONS = [("Germany", "DE", "DEU", "Europe", "Western Europe", 0), ("Que", "QU", "QUE", "Americas", "South America", 1),
           ("Namibia", "NA", "NAM", "Africa", "Southern Africa", 2), ("Italy", "IT", "ITA", "Europe", "Southern Europe", 3),
           ("Irland", "IR", "AND", "Europe", "Northern Europe", 4), ("Blank", "BL", "BLA", None, None, 5),
           ("Canada", "CA", "CAN", "Americas", "Northern America", 6)]


LOOKUPS = (f"cities(city_ascii, admin_name, country, iso2, iso3, lat, lng, ord) AS ({values_sql(CITIES)}),\n"
           f"states(state, short, capital, latitude, longitude, country, ord) AS ({values_sql(STATES)}),\n"
           f"regions(country, code_2, code_3, continent, sub_region, ord) AS ({values_sql(REGIONS)})")


def cities(spark):
    return literal(spark, CITIES, schemas.WORLD_CITIES)


def states(spark):
    return literal(spark, STATES, schemas.US_STATES)


def regions(spark):
    rows = [(c, a, b, None, None, cont, sub, None, None, o) for c, a, b, cont, sub, o in REGIONS]
    return literal(spark, rows, schemas.COUNTRY_CONTINENT)


_NAMES = sorted({str(v).lower().strip() for r in CITIES for v in (r[0], r[2], r[3], r[4])}
                | {str(v).lower().strip() for r in STATES for v in (r[0], r[2])}
                | {str(v).lower().strip() for r in REGIONS for v in (r[0], r[3], r[4]) if v})
# Words are set apart by two spaces so that each match owns the blanks around it; the longest name is tried first.
_PATTERN = "|".join(n.replace(" ", "  ") for n in sorted(_NAMES, key=lambda n: (-len(n.split()), n)))
MENTIONS = f"""{ARTICLES}, {NLP}, mentions AS (
  SELECT DISTINCT article_id, replace(m, '  ', ' ') AS location FROM (
    SELECT article_id, unnest(regexp_extract_all(' ' || replace(nlp_text, ' ', '  ') || ' ', ' ({_PATTERN}) ', 1)) AS m FROM nlp))"""


def names(spark):
    return loc.gazetteer(cities(spark), loc.trim_headers(states(spark)), regions(spark))


def mentions(spark, d):
    texts = articles(spark, d).select("article_id", nlp_text(F.col("article_text")).alias("nlp_text"))
    return loc.find_places(texts, "article_id", "nlp_text", names(spark))


PLACES = f"""{MENTIONS}, {LOOKUPS},
city AS (SELECT lower(city_ascii) AS city, lower(admin_name) AS state, lower(country) AS country, lower(iso2) AS iso2, lower(iso3) AS iso3,
  lat AS latitude, lng AS longitude, ord FROM cities WHERE admin_name IS NOT NULL),
region AS (SELECT lower(country) AS country, lower(sub_region) AS subcontinent, lower(continent) AS continent, lower(code_2) AS iso2,
  lower(code_3) AS iso3 FROM regions WHERE sub_region IS NOT NULL),
state AS (SELECT lower(state) AS state, lower(capital) AS capital, lower(country) AS country, ord FROM states),
found AS (SELECT DISTINCT location, CASE WHEN location IN (SELECT lower(city_ascii) FROM cities) THEN 0 ELSE 1 END AS ignore FROM mentions),
step AS (SELECT f.location, f.ignore, c AS c, s AS s, rc AS rc, r2 AS r2, r3 AS r3 FROM found f
  LEFT JOIN (SELECT * FROM city QUALIFY row_number() OVER (PARTITION BY city ORDER BY ord) = 1) c ON c.city = f.location
  LEFT JOIN (SELECT k, min_by(state, ord) AS state, min_by(capital, ord) AS capital, min_by(country, ord) AS country
             FROM (SELECT state AS k, * FROM state UNION SELECT capital, * FROM state) GROUP BY k) s ON s.k = f.location
  LEFT JOIN region rc ON rc.country = f.location LEFT JOIN region r2 ON r2.iso2 = f.location LEFT JOIN region r3 ON r3.iso3 = f.location),
places AS (SELECT location, ignore,
  CASE WHEN c.city IS NOT NULL THEN c.city WHEN s.k IS NOT NULL THEN s.capital WHEN coalesce(rc.country, r2.country, r3.country) IS NOT NULL THEN 'Country level only' END AS city,
  CASE WHEN c.city IS NOT NULL THEN c.state WHEN s.k IS NOT NULL THEN s.state END AS state,
  CASE WHEN c.city IS NOT NULL THEN c.country WHEN s.k IS NOT NULL THEN s.country ELSE coalesce(rc.country, r2.country, r3.country) END AS country,
  CASE WHEN c.city IS NOT NULL OR s.k IS NOT NULL THEN reg.subcontinent ELSE coalesce(rc.subcontinent, r2.subcontinent, r3.subcontinent) END AS subcontinent,
  CASE WHEN c.city IS NOT NULL OR s.k IS NOT NULL THEN reg.continent ELSE coalesce(rc.continent, r2.continent, r3.continent) END AS continent,
  CASE WHEN c.city IS NOT NULL THEN c.latitude WHEN s.k IS NOT NULL THEN (SELECT avg(latitude) FROM city x WHERE x.state = s.state)
       WHEN rc.country IS NOT NULL THEN (SELECT avg(latitude) FROM city x WHERE x.country = rc.country)
       WHEN r2.country IS NOT NULL THEN (SELECT avg(latitude) FROM city x WHERE x.iso2 = r2.iso2)
       ELSE (SELECT avg(latitude) FROM city x WHERE x.iso3 = r3.iso3) END AS latitude,
  CASE WHEN c.city IS NOT NULL THEN c.longitude WHEN s.k IS NOT NULL THEN (SELECT avg(longitude) FROM city x WHERE x.state = s.state)
       WHEN rc.country IS NOT NULL THEN (SELECT avg(longitude) FROM city x WHERE x.country = rc.country)
       WHEN r2.country IS NOT NULL THEN (SELECT avg(longitude) FROM city x WHERE x.iso2 = r2.iso2)
       ELSE (SELECT avg(longitude) FROM city x WHERE x.iso3 = r3.iso3) END AS longitude,
  CASE WHEN c.city IS NOT NULL THEN coalesce(reg.iso2, c.iso2) WHEN s.k IS NOT NULL THEN reg.iso2 ELSE coalesce(rc.iso2, r2.iso2, r3.iso2) END AS iso2,
  CASE WHEN c.city IS NOT NULL THEN coalesce(reg.iso3, c.iso3) WHEN s.k IS NOT NULL THEN reg.iso3 ELSE coalesce(rc.iso3, r2.iso3, r3.iso3) END AS iso3
  FROM step LEFT JOIN region reg ON reg.country = CASE WHEN c.city IS NOT NULL THEN c.country WHEN s.k IS NOT NULL THEN s.country END)"""
NAMED_PLACES = PLACES.replace("FROM mentions),\nstep", "FROM (SELECT unnest([" + ", ".join(f"'{n}'" for n in _NAMES) + "]) AS location)),\nstep")
_PLACE_COLS = "location, ignore, city, state, country, subcontinent, continent, latitude, longitude, iso2, iso3"


def places(spark, found):
    """Enriched distinct places of the given mentions."""
    return enriched(spark, found.select("location").distinct())


def named_places(spark):
    """All names of the gazetteer enriched, whether a text holds them or not: no larger than the lookups and
    known without the texts."""
    return materialize(enriched(spark, names(spark)), "named-places")


def enriched(spark, distinct):
    known = cities(spark).select(F.lower("city_ascii").alias("city"))
    city, state, region = loc.lookups(cities(spark), states(spark), regions(spark))
    return loc.enrich_places(member_flag(distinct, "location", known, "city"), city, state, region)


@register("gazetteer_union", """SELECT DISTINCT lower(trim(v)) AS location FROM (SELECT n_name AS v FROM nation UNION ALL SELECT r_name FROM region
UNION ALL SELECT p_brand FROM part UNION ALL SELECT p_type FROM part UNION ALL SELECT p_name FROM part UNION ALL SELECT c_mktsegment FROM customer
UNION ALL SELECT c_name FROM customer)""")
def gazetteer_union(spark, d):
    c = F.col
    customer = table(spark, d, "customer").select(c("c_name").alias("Place Name"), c("c_mktsegment").alias("State Capital"))
    part = table(spark, d, "part").select(c("p_name").alias("city_ascii"), c("p_type").alias("country"),
                                          c("p_brand").alias("iso2"), c("p_brand").alias("iso3"))
    nation = (table(spark, d, "nation").join(small(table(spark, d, "region")), c("n_regionkey") == c("r_regionkey"), "right")
              .select(c("n_name").alias("country"), c("r_name").alias("sub_region"), c("r_name").alias("continent")))
    return loc.gazetteer(part, customer, nation)


@register("loc_extract", f"WITH {MENTIONS} SELECT article_id, location FROM mentions")
def loc_extract(spark, d):
    return mentions(spark, d)


@register("loc_enrich", f"WITH {PLACES} SELECT {_PLACE_COLS} FROM places")
def loc_enrich(spark, d):
    return places(spark, mentions(spark, d))


@register("loc_region", f"""WITH {LOOKUPS} SELECT n.n_nationkey, lower(r.country) AS country, lower(r.sub_region) AS subcontinent, lower(r.continent) AS continent,
  lower(r.code_2) AS iso2, lower(r.code_3) AS iso3 FROM nation n JOIN (SELECT *, row_number() OVER (ORDER BY ord) - 1 AS k FROM regions) r ON n.n_nationkey % 7 = r.k WHERE r.sub_region IS NOT NULL
UNION ALL SELECT n_nationkey, 'blank', NULL, NULL, NULL, NULL FROM nation WHERE n_nationkey % 7 = 5""")
def loc_region(spark, d):
    names = F.coalesce(*[F.when(F.col("n_nationkey") % 7 == r[5], F.lit(r[0].lower())) for r in REGIONS])
    nations = table(spark, d, "nation").select("n_nationkey", names.alias("country"))
    _, _, region = loc.lookups(cities(spark), states(spark), regions(spark))
    return loc.attach_region(nations, region)


@register("loc_lookup_norm", """SELECT lower(p_name) AS city, lower(p_brand) AS state, p_size AS size FROM part WHERE p_partkey % 4 <> 0""")
def loc_lookup_norm(spark, d):
    holes = table(spark, d, "part").withColumn("p_brand", F.when(F.col("p_partkey") % 4 != 0, F.col("p_brand")))
    return loc.normalize_lookup(holes, {"p_name": "city", "p_brand": "state", "p_size": "size"})


@register("loc_missing", f"""WITH {PLACES}, holes AS (SELECT * REPLACE (CASE WHEN length(location) % 2 = 1 THEN NULL ELSE latitude END AS latitude) FROM places)
SELECT 'missing' AS kind, location, latitude, country FROM holes WHERE latitude IS NULL AND ignore <> 1
UNION ALL SELECT 'updated', location, CASE WHEN latitude IS NULL AND ignore <> 1 THEN 12.5::DOUBLE ELSE latitude END, country FROM holes""")
def loc_missing(spark, d):
    # read three times, and finding places is the expensive part
    holes = materialize(places(spark, mentions(spark, d)), "places").withColumn("latitude", F.when(F.length("location") % 2 == 0, F.col("latitude")))
    missing = loc.missing_places(holes)
    results = missing.select("location", F.lit(12.5).alias("latitude"), F.lit(None).cast("string").alias("country"))
    updated = update_from(holes, results, "location", ["latitude", "country"])
    cols = ["location", "latitude", "country"]
    return missing.select(F.lit("missing").alias("kind"), *cols).unionByName(
        updated.select(F.lit("updated").alias("kind"), *cols))


@register("loc_fallback", f"""WITH {PLACES}, holes AS (SELECT * REPLACE (CASE WHEN length(location) % 2 = 1 THEN NULL ELSE latitude END AS latitude) FROM places),
asked AS (SELECT *, latitude IS NULL AND ignore <> 1 AS asked FROM holes)
SELECT location, CASE WHEN asked THEN 12.5::DOUBLE ELSE latitude END AS latitude, CASE WHEN asked THEN -3.25::DOUBLE ELSE longitude END AS longitude,
  CASE WHEN asked AND length(location) % 3 <> 0 THEN 'Land of ' || location ELSE continent END AS continent,
  CASE WHEN asked AND length(location) % 3 <> 0 THEN 'Realm' ELSE country END AS country,
  CASE WHEN asked AND length(location) % 3 <> 0 THEN 'Shire 7' ELSE state END AS state FROM asked""")
def loc_fallback(spark, d):
    """Answers for all places, of which only those without a position that are not ignored count; a third of them has no address."""
    holes = materialize(places(spark, mentions(spark, d)), "places").withColumn("latitude", F.when(F.length("location") % 2 == 0, F.col("latitude")))
    address = F.when(F.length("location") % 3 != 0, F.concat(F.lit("Road 1, Land of "), "location", F.lit(", Shire 7, Realm")))
    answers = holes.select("location", F.lit(12.5).alias("latitude"), F.lit(-3.25).alias("longitude"), address.alias("address"))
    return loc.fill_missing(holes, answers).select("location", "latitude", "longitude", "continent", "country", "state")


@register("loc_drop_ignored", f"WITH {PLACES} SELECT location, city, country FROM places WHERE ignore <> 1")
def loc_drop_ignored(spark, d):
    return loc.drop_ignored(places(spark, mentions(spark, d))).select("location", "city", "country")


@register("location_frequency", f"WITH {MENTIONS} SELECT location, CAST(count(*) AS BIGINT) AS count FROM mentions GROUP BY location")
def location_frequency(spark, d):
    return loc.place_counts(mentions(spark, d))
