"""Reports over flights (``fl_``), their airports (origin ``air_``, destination ``air2_``) and
planes (``pl_``).

Each report takes a ``Star`` and reads only the dimensions it names. ``late_only`` keeps the flights
with a positive delay; without it early arrivals count as negative delay.
"""

from pyspark.sql import functions as F

from tabq.operators.groups import matches_any_group_max, top, top_per_group
from tabq.operators.star import Dimension, Star, count, mean, prefixed, total

ORIGIN, DEST = "air_region", "air2_region"
ROUTE = {"origin": "fl_origin", "dest": "fl_dest"}


def star(flights, airports, planes, dest="dest"):
    """The fact with its dimensions; airports play two roles."""
    fact = prefixed(flights.withColumnRenamed(dest, "dest"), "fl_")
    return Star(
        fact,
        [
            Dimension("air_", prefixed(airports, "air_"), "fl_origin", "air_faa"),
            Dimension("air2_", prefixed(airports, "air2_"), "fl_dest", "air2_faa"),
            Dimension("pl_", prefixed(planes, "pl_"), "fl_tailnum", "pl_tailnum"),
        ],
    )


def departure_year():
    return F.year("fl_dep_datetime")


def delay_column(delay):
    return {"arr": "fl_arr_delay", "dep": "fl_dep_delay"}[delay]


def _late(delay, late_only):
    return F.col(delay_column(delay)) > 0 if late_only else None


def _any_late():
    return (F.col("fl_arr_delay") > 0) | (F.col("fl_dep_delay") > 0)


def _shown(df, output, expression):
    """Replace the raw value by what is reported."""
    return df.withColumn(output, expression)


def fr01_airports_by_region(flights):
    reached = flights.combinations("air2_")
    return reached.groupBy(F.col(DEST).alias("region")).agg(
        F.count_distinct("air2_name").alias("airports")
    )


def fr02_altitude_drop(flights):
    pairs = flights.combinations("air_", "air2_")
    drop = F.col("air_alt") - F.col("air2_alt")
    return pairs.agg(F.max(drop).alias("altitude_drop"))


def fr03_delay_by_carrier(flights):
    by = {"carrier": "fl_carrier"}
    return flights.aggregate(
        by, {"avg_arr_delay": mean("fl_arr_delay"), "avg_dep_delay": mean("fl_dep_delay")}
    )


def fr03_average_lateness(flights):
    def late(c):
        return F.format_number(F.avg(F.when(F.col(c) > 0, F.col(c))), 1)

    return flights.fact.agg(
        late("fl_arr_delay").alias("avg_arr_delay"), late("fl_dep_delay").alias("avg_dep_delay")
    )


def _mean_delay(flights, region, delay, late_only):
    means = flights.aggregate(
        {"region": region}, {"delay": mean(delay_column(delay))}, _late(delay, late_only)
    )
    return _shown(means, "delay", F.ceil("delay"))


def fr04_delay_by_dest_region(flights, delay="arr", late_only=True):
    return _mean_delay(flights, DEST, delay, late_only)


def fr05_delay_by_origin_region(flights, delay="dep", late_only=True):
    return _mean_delay(flights, ORIGIN, delay, late_only)


def fr06_delay_by_year(flights, delay="dep", late_only=True):
    return flights.aggregate(
        {"year": departure_year()}, {"delay": total(delay_column(delay))}, _late(delay, late_only)
    )


def _both_delays(flights, by, late_only):
    sums = flights.aggregate(
        by,
        {"dep": total("fl_dep_delay"), "arr": total("fl_arr_delay")},
        _any_late() if late_only else None,
    )
    return sums.select(*by, (F.col("dep") + F.col("arr")).alias("delay"))


def fr07_all_delay_by_year(flights, late_only=True):
    return _both_delays(flights, {"year": departure_year()}, late_only)


def fr08_all_delay_by_year_and_region(flights, side="dest", late_only=True):
    region = {"origin": ORIGIN, "dest": DEST}[side]
    return _both_delays(flights, {"year": departure_year(), "region": region}, late_only)


def fr09_air_time(flights):
    return flights.fact.agg(F.ceil(F.avg("fl_air_time")).alias("air_time"))


def _mean_air_time(flights, by):
    means = flights.aggregate(by, {"air_time": mean("fl_air_time")})
    return _shown(means, "air_time", F.ceil("air_time"))


def fr10_air_time_by_dest_region(flights):
    return _mean_air_time(flights, {"region": DEST})


def fr11_air_time_by_route(flights):
    return _mean_air_time(flights, ROUTE)


def fr12_air_time_by_year(flights):
    return _mean_air_time(flights, {"year": departure_year()})


def fr13_total_air_time_by_dest_region(flights):
    return flights.aggregate({"region": DEST}, {"air_time": total("fl_air_time")})


def fr14_distance(flights):
    return flights.fact.agg(F.round(F.avg("fl_distance")).alias("distance"))


def fr15_distance_by_dest_region(flights):
    means = flights.aggregate({"region": DEST}, {"distance": mean("fl_distance")})
    return _shown(means, "distance", F.round("distance"))


def fr16_distance_by_route(flights, unit=" mls"):
    means = flights.aggregate(ROUTE, {"distance": mean("fl_distance")})
    return _shown(means, "distance", F.concat(F.round("distance").cast("string"), F.lit(unit)))


def _total_distance(flights, by, unit):
    sums = flights.aggregate(by, {"distance": total("fl_distance")})
    return _shown(sums, "distance", F.concat(F.format_number("distance", 1), F.lit(unit)))


def fr17_total_distance_by_year(flights, unit="mls"):
    return _total_distance(flights, {"year": departure_year()}, unit)


def fr18_total_distance_by_dest_region(flights, unit="mls"):
    return _total_distance(flights, {"region": DEST}, unit)


def fr19_seats_by_route(flights, unit=" passageiros"):
    # hardly any plane flies a route twice
    means = flights.aggregate(ROUTE, {"seats": mean("pl_seats")}, reduce_first=False)
    shown = F.concat(F.format_number(F.ceil("seats"), 0), F.lit(unit))
    return _shown(means, "seats", shown)


def fr20_seats_by_year(flights):
    sums = flights.aggregate({"year": departure_year()}, {"seats": total("pl_seats")})
    return _shown(sums, "seats", F.format_number("seats", 0))


def _most_frequent(flights, by, where=None):
    counts = flights.aggregate(by, {"n": count()}, where)
    return top(counts, "n", ties=list(by))


def fr21_top_destination(flights):
    return _most_frequent(flights, {"dest": "fl_dest"})


def fr22_top_destination_by_seats(flights):
    seats = flights.aggregate({"dest": "fl_dest"}, {"seats": total("pl_seats")})
    return top(seats, "seats", ties=["dest"])


def fr23_longest_flight(flights, airport="PDX", unit=" mls"):
    at = (F.col("fl_origin") == airport) | (F.col("fl_dest") == airport)
    longest = top(flights.fact.filter(at), "fl_distance", ties=["fl_origin", "fl_dest"])
    return longest.select(
        F.col("fl_origin").alias("origin"),
        F.col("fl_dest").alias("dest"),
        F.concat(F.format_number("fl_distance", 1), F.lit(unit)).alias("distance"),
    )


def fr24_top_model(flights):
    return _most_frequent(flights, {"model": "pl_model"})


def fr25_top_model_and_destination(flights):
    counts = flights.aggregate({"dest": "fl_dest", "model": "pl_model"}, {"n": count()})
    return top(counts.filter(F.col("model").isNotNull()), "n", ties=["dest", "model"])


def fr26_engines_by_haul(flights):
    means = flights.aggregate({"haul": "fl_haul_duration"}, {"engines": mean("pl_engines")})
    return _shown(means, "engines", F.ceil("engines"))


def fr27_top_season(flights):
    return _most_frequent(flights, {"season": "fl_dep_season"})


def _top_per_place(flights, by, places, keyed):
    counts = flights.aggregate(by, {"n": count()})
    pick = top_per_group if keyed else matches_any_group_max
    return pick(counts, places, "n")


def fr28_season_by_destination(flights, keyed=True):
    """Without ``keyed`` a count that equals the highest of any destination is enough."""
    return _top_per_place(flights, {"season": "fl_dep_season", "dest": "fl_dest"}, "dest", keyed)


def fr29_top_delay_class(flights):
    return _most_frequent(flights, {"delay_class": "fl_dep_delay_category"})


def fr30_delay_class_by_route(flights, keyed=True):
    by = {"delay_class": "fl_dep_delay_category", **ROUTE}
    return _top_per_place(flights, by, ["origin", "dest"], keyed)


REPORTS = {
    "fr01": fr01_airports_by_region,
    "fr02": fr02_altitude_drop,
    "fr03": fr03_delay_by_carrier,
    "fr03_late": fr03_average_lateness,
    "fr04": fr04_delay_by_dest_region,
    "fr05": fr05_delay_by_origin_region,
    "fr06": fr06_delay_by_year,
    "fr07": fr07_all_delay_by_year,
    "fr08": fr08_all_delay_by_year_and_region,
    "fr09": fr09_air_time,
    "fr10": fr10_air_time_by_dest_region,
    "fr11": fr11_air_time_by_route,
    "fr12": fr12_air_time_by_year,
    "fr13": fr13_total_air_time_by_dest_region,
    "fr14": fr14_distance,
    "fr15": fr15_distance_by_dest_region,
    "fr16": fr16_distance_by_route,
    "fr17": fr17_total_distance_by_year,
    "fr18": fr18_total_distance_by_dest_region,
    "fr19": fr19_seats_by_route,
    "fr20": fr20_seats_by_year,
    "fr21": fr21_top_destination,
    "fr22": fr22_top_destination_by_seats,
    "fr23": fr23_longest_flight,
    "fr24": fr24_top_model,
    "fr25": fr25_top_model_and_destination,
    "fr26": fr26_engines_by_haul,
    "fr27": fr27_top_season,
    "fr28": fr28_season_by_destination,
    "fr29": fr29_top_delay_class,
    "fr30": fr30_delay_class_by_route,
}
