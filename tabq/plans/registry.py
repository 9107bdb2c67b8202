"""Every operator and report as a named query over the order-entry tables.

A query is a function of (session, folder of Parquet files). Floating-point results are rounded
here, so that the order of summation does not show.
"""

from pyspark.sql import functions as F

from tabq.functions import convert, patterns, predicates, strings
from tabq.operators import distinct, expect, groups, heavy, moments, profile
from tabq.operators.labels import backfill, label
from tabq.operators.star import Dimension, Star, prefixed
from tabq.plans import analogues, cleaning
from tabq.plans.reports import census, communities, flights, retail
from tabq.plans.rules import airports as airport_rules
from tabq.plans.rules import communities as place_rules
from tabq.plans.rules import flights as flight_rules
from tabq.plans.rules import planes as plane_rules
from tabq.plans.rules import retail as retail_rules
from tabq.sources import files, schemas

# Test rows in front of the airports. Fixed values.
DIRTY_AIRPORTS = [
    (None, None, None, None, None, None, None),
    ("", "", "", "", "", "", ""),
    ("   ", None, "12O.12", "-80.Aa6195833", "1044Aa", "-2x", "34"),
    ("AAA", None, "12O.12", "-80.Aa6195833", "1044Aa", "-2x", "34"),
    ("222", None, None, "-80.Aa6195833", "-100", "-14", "K"),
    ("__!", None, None, "-80.Aa6195833", "-100", "-14", "K"),
]


class Source:
    """The stand-in tables of one folder."""

    def __init__(self, spark, folder):
        self.spark = spark
        self.folder = folder

    def table(self, name):
        return files.read_parquet(self.spark, f"{self.folder}/{name}.parquet")

    def spread(self, name):
        return files.spread(self.table(name))

    def frame(self, analogue, *columns):
        return analogue.frame(self.table, columns or None)

    def sales(self, *columns):
        return self.frame(analogues.SALES, *columns)

    def typed_sales(self, *columns):
        """Cleaned sales with only these columns; the stock code decides which rows stay."""
        needed = dict.fromkeys(("StockCode", *columns))
        kept = cleaning.drop_value(self.sales(*needed), "StockCode", "PADS")
        return cleaning.type_sales(kept)

    def people(self, *columns):
        return self.frame(analogues.PEOPLE, *columns)

    def places(self, *columns):
        """All columns are over a hundred from a few stored ones, so the stored rows are spread first."""
        if not columns:
            return analogues.PLACES.frame(self.spread)
        return self.frame(analogues.PLACES, *columns)

    def typed_places(self, *columns):
        return cleaning.type_all(self.places(*columns))

    def raw_flights(self):
        return self.frame(analogues.FLIGHTS)

    def dirty_airports(self):
        return self.frame(analogues.AIRPORTS_DIRTY)

    def dirty_planes(self):
        return self.frame(analogues.PLANES_DIRTY)

    def text_airports(self):
        return files.prepend_rows(self.dirty_airports(), DIRTY_AIRPORTS)

    def trips(self):
        """Flights with derived columns, clean airports and planes."""
        return flights.star(
            cleaning.derive_flight_columns(self.raw_flights()),
            cleaning.clean_airports(self.frame(analogues.AIRPORTS), "numeric"),
            self.frame(analogues.PLANES),
        )

    def labelled_trips(self):
        """The same tables with their quality labels."""
        return flights.star(
            label(self.raw_flights(), flight_rules.rules(dest="dest")),
            label(self.frame(analogues.AIRPORTS), airport_rules.rules()),
            label(self.frame(analogues.PLANES), plane_rules.rules()),
        )


def rounded(df, *columns, decimals=6):
    return df.withColumns({c: F.round(c, decimals) for c in columns})


def only_labels(df):
    return df.select([c for c in df.columns if c.startswith("qa_")])


QUERIES = {}


def query(name):
    """Register a function of a Source under a name."""

    def register(build):
        QUERIES[name] = lambda spark, folder: build(Source(spark, folder))
        return build

    return register


def _register(name, build):
    query(name)(build)


# Labels -----------------------------------------------------------------------------------------

LABELLED = {
    "airports": (Source.dirty_airports, airport_rules.rules, ("df", "sql", "rdd", "intended")),
    "planes": (Source.dirty_planes, plane_rules.rules, ("df", "sql", "rdd", "intended")),
    "flights": (
        Source.raw_flights,
        lambda variant: flight_rules.rules(variant, dest="dest"),
        ("df", "sql", "intended"),
    ),
    "sales": (Source.sales, retail_rules.rules, ("df", "intended")),
}


def _suffix(variant):
    return "" if variant == "df" else f"_{variant}"


def _label_table(table, variant):
    source, rules, _ = LABELLED[table]
    return lambda s: only_labels(label(source(s), rules(variant)))


def _label_counts(table, position, variant):
    source, rules, _ = LABELLED[table]

    def build(s):
        rule = rules(variant)[position]
        labels = source(s).select(rule.column().alias("label"))
        return labels.groupBy("label").agg(F.count(F.lit(1)).alias("n"))

    return build


RULE_IDS = {"airports": ("a", 7), "planes": ("p", 9), "flights": ("f", 11), "sales": ("r", 7)}

for _table, (_, _, _variants) in LABELLED.items():
    _letter, _count = RULE_IDS[_table]
    for _variant in _variants:
        _register(f"label_{_table}{_suffix(_variant)}", _label_table(_table, _variant))
    for _i in range(_count):
        _register(f"qa_{_letter}{_i + 1}", _label_counts(_table, _i, "df"))


@query("label_airports_raw_text")
def _(s):
    """Rules on all-text columns, where letters in numbers are visible."""
    return only_labels(label(s.text_airports(), airport_rules.rules()))


@query("label_places_all_columns")
def _(s):
    places = s.places()
    return only_labels(label(places, place_rules.rules(places.columns)))


@query("qa_f12")
def _(s):
    """Back-filled delay labels."""
    labelled = label(s.raw_flights(), [flight_rules.delays()])
    filled = backfill(labelled, "qa_dep_arr_delay")
    return filled.groupBy("qa_dep_arr_delay").agg(F.count(F.lit(1)).alias("n"))


# Expectations -----------------------------------------------------------------------------------

MANDATORY = schemas.CENSUS.fieldNames()


@query("expect_people")
def _(s):
    results = expect.check_mandatory(s.people(), [*MANDATORY, "no-such-column"])
    return rounded(results, "unexpected_percent")


@query("expect_people_report")
def _(s):
    return expect.report(expect.check_mandatory(s.people(), [*MANDATORY, "no-such-column"]))


# Cleaning ---------------------------------------------------------------------------------------


def _airport_step(step, *columns):
    return lambda s: step(s.dirty_airports()).select("faa", *columns)


_register("clamp_altitude", _airport_step(cleaning.clamp_altitude, "alt"))
_register(
    "clamp_altitude_numeric",
    _airport_step(lambda df: cleaning.clamp_altitude(df, "numeric"), "alt"),
)
_register("dst_from_timezone", _airport_step(cleaning.dst_from_timezone, "tz", "dst"))
_register("dst_unknown_to_a", _airport_step(cleaning.dst_unknown_to_a, "dst"))
_register("enrich_places_region", _airport_step(cleaning.region, "lat", "lon", "region"))
_register("classify_names", _airport_step(cleaning.facility_type, "name", "type"))
_register("flag_military", _airport_step(cleaning.military, "name", "military"))
_register(
    "only_military",
    _airport_step(lambda df: cleaning.only_military(cleaning.military(df)), "name", "military"),
)
_register("administration", _airport_step(cleaning.administration, "name", "administration"))
_register(
    "administration_intended",
    _airport_step(lambda df: cleaning.administration(df, True), "name", "administration"),
)


@query("union_test_rows")
def _(s):
    return s.text_airports()


@query("clean_airports_raw_text")
def _(s):
    return cleaning.clean_airports(s.text_airports())


def _dates_as_text(df, column):
    return df.withColumn(column, F.substring(F.col(column).cast("string"), 1, 16))


@query("clean_sales")
def _(s):
    """Filter, labels and types; label columns show the raw text."""
    return _dates_as_text(cleaning.clean_sales(s.sales()), "InvoiceDate")


@query("clean_sales_double")
def _(s):
    kept = cleaning.drop_value(s.sales("StockCode", "UnitPrice", "Quantity"), "StockCode", "PADS")
    return cleaning.type_sales(kept, "double")


@query("clean_places")
def _(s):
    """The whole pipeline of a places table: labels of all columns, then types."""
    return cleaning.clean_places(s.places())


@query("clean_places_float")
def _(s):
    """All columns in single precision."""
    return cleaning.type_all(s.places(), dtype="float")


@query("flag_self_employed")
def _(s):
    flagged = cleaning.self_employed(s.people("workclass"))
    return flagged.groupBy("workclass", "self-employed").agg(F.count(F.lit(1)).alias("n"))


@query("flag_married")
def _(s):
    flagged = cleaning.married(s.people("marital-status"))
    return flagged.groupBy("marital-status", "married_status").agg(F.count(F.lit(1)).alias("n"))


@query("dominant_share")
def _(s):
    places = s.typed_places("communityname", *cleaning.RACE_SHARES.values())
    return cleaning.dominant_race(places)


@query("derive_trip_columns")
def _(s):
    derived = cleaning.derive_flight_columns(s.raw_flights()).select(
        "dep_datetime", "haul_duration", "dep_season", "dep_delay_category"
    )
    return _dates_as_text(derived, "dep_datetime")


# Joins ------------------------------------------------------------------------------------------

STAR_COLUMNS = ["fl_origin", "fl_dest", "fl_tailnum", "fl_distance", "air_name", "air2_name",
                "pl_model"]


@query("star_trips")
def _(s):
    return s.trips().join().select(STAR_COLUMNS)


@query("star_trips_salted")
def _(s):
    return s.trips().join(salts=4).select(STAR_COLUMNS)


@query("role_playing_airports")
def _(s):
    """One dimension in two roles."""
    return s.trips().combinations("air_", "air2_").select(
        "fl_origin", "fl_dest", "air_region", "air2_region"
    )


# Profiles ---------------------------------------------------------------------------------------


@query("profile_label_counts")
def _(s):
    return profile.star_label_counts(s.labelled_trips())


@query("profile_label_counts_flights")
def _(s):
    labelled = only_labels(label(s.raw_flights(), flight_rules.rules(dest="dest")))
    return profile.label_counts(labelled)


def _worst(name):
    def build(s):
        counts = profile.star_label_counts(s.labelled_trips(), [name], only_labels=True)
        return profile.worst_column(counts, name)

    return build


for _name in "MFI":
    _register(f"profile_worst_{_name.lower()}", _worst(_name))


@query("profile_self_name")
def _(s):
    return profile.star_starts_with_own_name(s.labelled_trips())


@query("profile_row_counts")
def _(s):
    return profile.row_counts(trips=s.trips().join(), airports=s.frame(analogues.AIRPORTS))


@query("profile_value_json")
def _(s):
    labelled = label(s.dirty_airports(), [airport_rules.dst("df")]).select("faa", "dst", "qa_dst")
    return profile.value_occurrences(labelled, "dst", "qa_dst")


@query("profile_frequency")
def _(s):
    places = s.places()
    return profile.frequency(label(places, place_rules.rules(places.columns)))


@query("profile_merged")
def _(s):
    """Label counts of two batches, stored one by one and merged."""
    old = F.coalesce(F.col("year") < 1995, F.lit(True))
    parts = []
    for batch in (s.raw_flights().filter(old), s.raw_flights().filter(~old)):
        labelled = only_labels(label(batch, flight_rules.rules(dest="dest")))
        parts.append(files.handoff(profile.label_counts(labelled), "counts"))
    return profile.merge_counts(*parts)


# Files and layouts ------------------------------------------------------------------------------


def _as_csv(df, name):
    path = files.new_path(df.sparkSession, f"{name}_csv")
    files.write_csv(df, path)
    return path


@query("csv_typed")
def _(s):
    """Airports written as CSV and read with their declared types."""
    path = _as_csv(s.dirty_airports(), "airports")
    return files.read_csv(s.spark, path, schemas.AIRPORTS, null_text=files.NULL_TEXT)


@query("csv_landed")
def _(s):
    """Sales landed as text; NULL, empty text and blanks stay apart."""
    return files.read_csv(s.spark, _as_csv(s.sales(), "sales"), schemas.RETAIL,
                          null_text=files.NULL_TEXT)


@query("csv_header_only")
def _(s):
    """Column names from the header, all text."""
    return files.read_csv(s.spark, _as_csv(s.dirty_planes(), "planes"), null_text=files.NULL_TEXT)


TYPED_RETAIL = schemas.typed({c: "string" for c in schemas.RETAIL.fieldNames()}
                             | {"Quantity": "int", "UnitPrice": "float"})


def _landed_sales(s):
    return files.land_csv(s.spark, _as_csv(s.sales(), "sales"), TYPED_RETAIL, "landed",
                          null_text=files.NULL_TEXT)


@query("csv_quarantine")
def _(s):
    """Sales records whose quantity or price is not of the declared type, with the reason."""
    return _landed_sales(s).rejected.select(
        "InvoiceNo", "StockCode", "Quantity", "UnitPrice", "Country", "reason")


@query("csv_accepted")
def _(s):
    """Units and highest price by country of the records that fit."""
    return _landed_sales(s).accepted.groupBy("Country").agg(
        F.count(F.lit(1)).alias("n"), F.sum("Quantity").alias("quantity"),
        F.max("UnitPrice").alias("highest"))


@query("parquet_sink")
def _(s):
    """Labels, written once and read again."""
    return files.handoff(only_labels(label(s.sales(), retail_rules.rules())), "labels")


def _watched_people(s):
    people, outcome = expect.observe(s.people(), expect.mandatory([*MANDATORY, "no-such-column"]))
    files.handoff(people, "people")
    return outcome()


@query("expect_people_on_write")
def _(s):
    """Expectations from the rows that a write passes on, without a pass of their own."""
    return rounded(_watched_people(s), "unexpected_percent")


@query("expect_people_report_on_write")
def _(s):
    return expect.report(_watched_people(s))


DECLARED_PLANES = schemas.typed({"tailnum": "string", "year": "float", "type": "string",
                                 "model": "string", "engines": "int", "owner": "string"})


@query("schema_differences")
def _(s):
    """Planes against a schema that asks for another type, a column more and two columns less."""
    planes = s.dirty_planes().drop("speed", "engine")
    return schemas.differences(planes, DECLARED_PLANES, ["tailnum", "engines"])


@query("schema_conformed")
def _(s):
    """The columns of that schema, with its types."""
    return schemas.conform(s.dirty_planes(), DECLARED_PLANES)


def _trips_by_year(s):
    trips = cleaning.derive_flight_columns(s.raw_flights()).select(
        "year", "month", "origin", "dest", "tailnum", "distance", "dep_delay")
    return files.partitioned(trips, "trips", ["year"])


@query("partitioned_year")
def _(s):
    """A report of one year, which reads that year's folder only."""
    of_year = _trips_by_year(s).filter("year = 1995")
    return of_year.groupBy("month").agg(F.count(F.lit(1)).alias("n"), F.sum("distance").alias("distance"))


@query("partitioned_years_of_dimension")
def _(s):
    """Flights of the years in which orders of large value were placed: the folders that are read
    follow from the other table while the query runs."""
    trips, orders = _trips_by_year(s), s.table("orders")
    dear = orders.filter("o_totalprice > 400000").select(F.year("o_orderdate").alias("year")).distinct()
    met = trips.join(dear, "year", "left_semi")
    return met.groupBy("year").agg(F.count(F.lit(1)).alias("n"), F.sum("distance").alias("distance"))


@query("star_trips_heavy")
def _(s):
    """Only the foreign keys that hold a large part of the flights are spread."""
    trips = s.trips()
    return trips.join(heavy=trips.heavy_keys()).select(STAR_COLUMNS)


@query("heavy_origins")
def _(s):
    """Origins with over 1 % of the flights, from sketches by carrier that are stored and merged."""
    parts = files.handoff(heavy.sketch(s.raw_flights(), ["origin"], ["carrier"]), "sketches")
    found = heavy.hitters(heavy.merge(parts, ["origin"]), ["origin"], 0.01)
    return found.select("value", "n")


BUCKETS = 16  # at least


@query("star_trips_bucketed")
def _(s):
    """The fact laid out by origin, joined and summed up by origin without moving it."""
    trips = s.trips()
    star = trips.laid_out("air_", files.buckets_for(trips.fact, BUCKETS))
    joined = star.bucketed_join("air_")
    return joined.groupBy("fl_origin").agg(
        F.count(F.lit(1)).alias("n"), F.sum("fl_distance").alias("distance"),
        F.max("air_region").alias("region"))


# Predicates and scalar functions ----------------------------------------------------------------


@query("predicates_on_text")
def _(s):
    """How many values of the sales columns fulfil each predicate and pattern."""
    price, code, place = F.col("UnitPrice"), F.col("StockCode"), F.col("Description")
    conditions = {
        "empty": predicates.is_empty("UnitPrice"),
        "blank": predicates.is_blank("Description"),
        "missing": predicates.is_missing("StockCode"),
        "is_null": code.isNull(),
        "is_not_null": code.isNotNull(),
        "contains": price.contains(","),
        "starts": code.startswith("gift"),
        "ends": code.endswith("S"),
        "like": code.like("PADS"),
        "not_like": ~code.like("PADS"),
        "in_list": code.isin("PADS", "ABCDE"),
        "not_in_list": predicates.not_in("StockCode", ["PADS", "ABCDE"]),
        "any_word": predicates.contains_any("Description", ["bolt", "ring"]),
        "any_pattern": place.rlike(patterns.any_of(["bolt", "r.ng"])),
        "alpha": code.rlike(patterns.ALPHA),
        "integer": code.rlike(patterns.INTEGER),
        "float": price.rlike(patterns.FLOAT),
        "alphanum": code.rlike(patterns.ALPHANUM),
        "special": code.rlike(patterns.SPECIAL),
        "both": code.startswith("gift") & price.contains("-"),
        "either": code.endswith("S") | code.endswith("M"),
    }
    return s.sales("UnitPrice", "StockCode", "Description").agg(
        *[F.count_if(c).alias(name) for name, c in conditions.items()]
    )


@query("patterns_on_codes")
def _(s):
    tail, clock = F.col("tailnum"), F.lpad(F.col("dep_time").cast("string"), 4, "0")
    return s.raw_flights().agg(
        F.count_if(tail.rlike(patterns.TAIL_NUMBER)).alias("tail_number"),
        F.count_if(tail.rlike(patterns.TAIL_NUMBER_INVALID)).alias("tail_number_invalid"),
        F.count_if(clock.rlike(patterns.CLOCK)).alias("clock"),
    )


@query("range_predicates")
def _(s):
    """Open and closed ends, over the delays of all flights."""
    ends = {"open": (0, 0), "low": (1, 0), "high": (0, 1), "closed": (1, 1)}
    return s.raw_flights().agg(
        *[
            F.count_if(predicates.in_range("dep_delay", 0, 20, bool(lo), bool(hi))).alias(name)
            for name, (lo, hi) in ends.items()
        ]
    )


@query("scalar_text")
def _(s):
    code, name = F.col("StockCode"), F.col("Description")
    return s.sales("StockCode", "Description", "UnitPrice", "Quantity").select(
        F.length(code).alias("size"),
        F.substring(code, 2, 3).alias("middle"),
        F.regexp_replace("UnitPrice", ",", ".").alias("point"),
        F.concat(code, F.lit(" pcs")).alias("with_unit"),
        F.concat_ws("-", code, name).alias("joined"),
        F.replace(name, F.lit("red"), F.lit("")).alias("stripped"),
        F.format_number(convert.to_whole("Quantity") * 1000, 1).alias("formatted"),
    )


@query("scalar_dates_and_numbers")
def _(s):
    day, price = F.col("InvoiceDate"), F.col("UnitPrice")
    return s.typed_sales("InvoiceDate", "UnitPrice", "Quantity").select(
        F.year(day).alias("year"),
        F.month(day).alias("month"),
        F.hour(day).alias("hour"),
        F.ceil(price).alias("up"),
        F.round(price).alias("nearest"),
        F.round(F.try_divide("Quantity", F.length("StockCode")), 4).alias("share"),
        predicates.as_column("StockCode").try_cast("int").alias("code"),
    )


@query("udf_free_tail_characters")
def _(s):
    return s.dirty_planes().select(
        "tailnum", strings.without_digits_and_first("tailnum").alias("characters")
    )


@query("udf_free_capture")
def _(s):
    return s.dirty_planes().select(
        "manufacturer", strings.captured("manufacturer", "(air[a-z]+|boe)").alias("captured")
    )


@query("udf_free_known_manufacturer")
def _(s):
    known = strings.known_or("manufacturer", plane_rules.MANUFACTURERS)
    return s.dirty_planes().select("manufacturer", known.alias("known"))


@query("udf_free_occurrences")
def _(s):
    counts = strings.occurrences_json("tailnum", "engine", "type", "engine")
    return s.dirty_planes().select("tailnum", "engine", "type", counts.alias("counts"))


@query("sql_over_view")
def _(s):
    """A rule in SQL over a registered table."""
    return s.spark.sql(
        "SELECT CASE WHEN tz IS NULL THEN 'M' WHEN tz <= -11 OR tz >= 14 THEN 'I' "
        "ELSE CAST(tz AS STRING) END AS qa_tz, count(*) AS n FROM {airports} GROUP BY 1",
        airports=s.dirty_airports(),
    )


# Aggregates and ranking -------------------------------------------------------------------------


@query("aggregates_by_country")
def _(s):
    sales = s.typed_sales("Country", "Quantity", "UnitPrice")
    quantity = F.col("Quantity")
    return sales.groupBy("Country").agg(
        F.count(F.lit(1)).alias("n"),
        F.count("Quantity").alias("n_quantity"),
        F.count_distinct("StockCode").alias("codes"),
        F.sum(quantity).alias("quantity"),
        F.round(F.avg(quantity), 6).alias("mean"),
        F.max(quantity).alias("largest"),
        F.round(F.max(quantity * F.col("UnitPrice")), 2).alias("largest_amount"),
        F.count_if(quantity < 0).alias("returned"),
        (F.sum(quantity) + F.sum(F.length("StockCode"))).alias("sum_of_sums"),
    )


@query("aggregates_global")
def _(s):
    return s.typed_sales("Quantity").agg(
        F.count(F.lit(1)).alias("n"),
        F.count_distinct("StockCode").alias("codes"),
        F.sum("Quantity").alias("quantity"),
        F.ceil(F.avg("Quantity")).alias("mean_up"),
        F.format_number(F.sum("Quantity"), 1).alias("shown"),
    )


@query("top_k")
def _(s):
    sold = s.typed_sales("Quantity").groupBy("StockCode").agg(F.sum("Quantity").alias("quantity"))
    return groups.top(sold, "quantity", 10, ties=["StockCode"])


@query("rank_formatted")
def _(s):
    """Top ten by text, where 999.00 beats 1,000.00."""
    prices = s.typed_sales("UnitPrice").groupBy("StockCode")
    prices = prices.agg(F.max("UnitPrice").alias("price"))
    return groups.ranked(prices, "price", "shown", rank_on="formatted", n=10, ties=["StockCode"])


@query("rank_numeric")
def _(s):
    prices = s.typed_sales("UnitPrice").groupBy("StockCode")
    prices = prices.agg(F.max("UnitPrice").alias("price"))
    return groups.ranked(prices, "price", "shown", n=10, ties=["StockCode"])


@query("mode_per_group")
def _(s):
    return groups.mode_per_group(s.raw_flights().select("origin", "carrier"), "origin", "carrier")


@query("top_per_group")
def _(s):
    counts = s.raw_flights().groupBy("origin", "carrier").agg(F.count(F.lit(1)).alias("n"))
    return groups.top_per_group(counts, "origin", "n")


@query("max_join_compat")
def _(s):
    counts = s.raw_flights().groupBy("origin", "carrier").agg(F.count(F.lit(1)).alias("n"))
    return groups.matches_any_group_max(counts, "origin", "n")


@query("ratio")
def _(s):
    late = F.col("dep_delay") > 0
    return rounded(groups.ratio(s.raw_flights(), late, ~late), "ratio")


for _policy in ("zero", "skip"):
    _register(
        f"corr_{_policy}",
        lambda s, policy=_policy: rounded(
            groups.correlation(s.raw_flights(), "air_time", "distance", policy), "corr"
        ),
    )


CORRELATED = ["population", "medIncome", "PctPolicWhite", "PolicOperBudg", "PolicBudgPerPop",
              "ViolentCrimesPerPop"]

for _policy in ("zero", "skip"):
    _register(
        f"corr_matrix_{_policy}",
        lambda s, policy=_policy: rounded(moments.correlations(
            moments.moments(s.typed_places(*CORRELATED), CORRELATED, policy)), "corr"),
    )


@query("corr_matrix_merged")
def _(s):
    """From the moments of each state, added up."""
    places = s.typed_places("state", *CORRELATED)
    parts = files.handoff(moments.moments(places, CORRELATED, "skip", ["state"]), "moments")
    return rounded(moments.correlations(moments.merge(parts)), "corr")


@query("distinct_destinations")
def _(s):
    """Distinct destinations of each region of departure, and of all, from one set of bitmaps."""
    trips = s.trips().join("air_").select(F.col("air_region").alias("region"), "fl_dest")
    numbers = distinct.dictionary(s.raw_flights(), "dest")
    parts = files.handoff(distinct.bitmaps(trips, "fl_dest", numbers, ["region"]), "bitmaps")
    of_region = distinct.count(parts, ["region"]).withColumn("of_all", F.lit(False))
    of_all = distinct.count(parts).select(
        F.lit(None).cast("string").alias("region"), "n", F.lit(True).alias("of_all"))
    return of_region.unionByName(of_all)


# Reports ----------------------------------------------------------------------------------------

# Columns each retail report reads besides the stock code.
RETAIL_COLUMNS = {
    "rq01": ["UnitPrice", "Quantity"],
    "rq02": ["InvoiceDate", "UnitPrice"],
    "rq03": ["Quantity"],
    "rq04": ["Quantity"],
    "rq05": ["InvoiceDate", "Quantity"],
    "rq06": ["InvoiceDate", "UnitPrice", "Quantity"],
    "rq07": ["InvoiceDate", "UnitPrice", "Quantity"],
    "rq08": ["InvoiceDate", "Description", "UnitPrice", "Quantity"],
    "rq09": ["Country", "UnitPrice", "Quantity"],
    "rq10": ["Country", "Quantity"],
    "rq11": ["InvoiceNo", "UnitPrice", "Quantity"],
    "rq12": ["InvoiceNo", "Quantity"],
    "rq13": ["CustomerID"],
}
# Columns each communities report reads.
PLACE = ["state", "communityname"]
COMMUNITY_COLUMNS = {
    "mq01": [*PLACE, "PolicOperBudg"],
    "mq02": [*PLACE, "community", "ViolentCrimesPerPop"],
    "mq03": [*PLACE, "population"],
    "mq04": [*PLACE, "population", "racepctblack"],
    "mq05": [*PLACE, "pctWWage"],
    "mq06": [*PLACE, "agePct12t21", "agePct16t24"],
    "mq07": ["PolicOperBudg", "ViolentCrimesPerPop"],
    "mq08": ["PctPolicWhite", "PolicOperBudg"],
    "mq09": ["population", "PolicBudgPerPop"],
    "mq10": ["population", "ViolentCrimesPerPop"],
    "mq11": ["medIncome", "ViolentCrimesPerPop"],
    "mq12": [*PLACE, "population", "ViolentCrimesPerPop", *cleaning.RACE_SHARES.values()],
}
ROUNDED = {"cq03": ["ratio"], "cq04": ["ratio"], "cq10": ["ratio"], "cq15": ["ratio"],
           "rq11": ["greatest_amount"], "fr03": ["avg_arr_delay", "avg_dep_delay"],
           **{f"mq{i:02}": ["corr"] for i in range(7, 12)},
           "mq02": ["crimes"], "mq03": ["population"], "mq04": ["black_population"]}


def _finished(key, df):
    return rounded(df, *ROUNDED.get(key, []))


def _retail(key, **options):
    return lambda s: _finished(
        key, retail.REPORTS[key](s.typed_sales(*RETAIL_COLUMNS[key]), **options)
    )


def _census(key, **options):
    return lambda s: _finished(key, census.REPORTS[key](s.people(), **options))


def _community(key, **options):
    return lambda s: _finished(
        key, communities.REPORTS[key](s.typed_places(*COMMUNITY_COLUMNS[key]), **options)
    )


def _flight(key, **options):
    return lambda s: _finished(key, flights.REPORTS[key](s.trips(), **options))


for _key in retail.REPORTS:
    _register(_key, _retail(_key))
for _key in census.REPORTS:
    _register(_key, _census(_key))
for _key in communities.REPORTS:
    _register(_key, _community(_key))
for _key in flights.REPORTS:
    _register(_key, _flight(_key))

for _key in ("rq06", "rq07", "rq08", "rq09", "rq10"):
    _register(f"{_key}_formatted", _retail(_key, rank_on="formatted"))
for _key in ("cq02", "cq05"):
    _register(f"{_key}_formatted", _census(_key, rank_on="formatted"))


@query("rq08_scalar")
def _(s):
    sales = s.typed_sales(*RETAIL_COLUMNS["rq08"]).withColumn("year", F.year("InvoiceDate"))
    return retail.rq08_of_partitions(files.partitioned(sales, "sales", ["year"]))


_register("mq01_formatted", _community("mq01", rank_on="formatted"))
_register("mq03_sum", _community("mq03", how="sum"))
_register("mq04_people", _community("mq04", how="people"))
_register("mq06_older", _community("mq06", age="agePct16t24"))
for _key in ("mq07", "mq08", "mq09", "mq10", "mq11"):
    _register(f"{_key}_skip", _community(_key, null_policy="skip"))
for _key in ("fr04", "fr05", "fr06"):
    for _delay in ("arr", "dep"):
        for _late in (True, False):
            _register(
                f"{_key}_{_delay}_{'late' if _late else 'all'}",
                _flight(_key, delay=_delay, late_only=_late),
            )
    del QUERIES[_key]
_register("fr07_all", _flight("fr07", late_only=False))
for _side in ("origin", "dest"):
    for _late in (True, False):
        _register(
            f"fr08_{_side}_{'late' if _late else 'all'}",
            _flight("fr08", side=_side, late_only=_late),
        )
del QUERIES["fr08"]
_register("fr28_compat", _flight("fr28", keyed=False))
_register("fr30_compat", _flight("fr30", keyed=False))
