"""Reports over communities, typed by ``cleaning.type_all``."""

from pyspark.sql import functions as F

from tabq.operators.groups import correlation, mode_of_counts, ranked, top
from tabq.plans.cleaning import dominant_race

PLACE = ("state", "communityname")


def _top_place(places, value, output, keys=PLACE):
    return top(places.groupBy(*keys).agg(value.alias(output)), output, ties=keys)


def mq01_police_budget(places, rank_on="numeric"):
    budgets = places.groupBy(*PLACE).agg(F.sum("PolicOperBudg").alias("total"))
    return ranked(budgets, "total", "budget", rank_on=rank_on, ties=PLACE)


def mq02_violent_crimes(places):
    crimes = F.sum("ViolentCrimesPerPop")
    return _top_place(places, crimes, "crimes", ("state", "community", "communityname"))


def mq03_population(places, how="max"):
    """``how`` is max or sum."""
    inhabited = places.filter(F.col("population") > 0)
    return _top_place(inhabited, {"max": F.max, "sum": F.sum}[how]("population"), "population")


def mq04_black_population(places, how="share"):
    """``how`` is share, or people for the share times the population."""
    some = places.filter(F.col("racepctblack") > 0)
    share = F.col("racepctblack")
    value = share if how == "share" else F.col("population") * share
    return _top_place(some, F.max(value), "black_population")


def mq05_wage_earners(places):
    return _top_place(places, F.max("pctWWage"), "wage_share")


def mq06_young_people(places, age="agePct12t21"):
    return _top_place(places, F.max(age), "young_share")


def mq07_budget_and_crime(places, null_policy="zero"):
    return correlation(places, "PolicOperBudg", "ViolentCrimesPerPop", null_policy)


def mq08_white_police_and_budget(places, null_policy="zero"):
    return correlation(places, "PctPolicWhite", "PolicOperBudg", null_policy)


def mq09_population_and_budget(places, null_policy="zero"):
    return correlation(places, "population", "PolicBudgPerPop", null_policy)


def mq10_population_and_crime(places, null_policy="zero"):
    return correlation(places, "population", "ViolentCrimesPerPop", null_policy)


def mq11_income_and_crime(places, null_policy="zero"):
    return correlation(places, "medIncome", "ViolentCrimesPerPop", null_policy)


def mq12_race_of_violent_places(places, n=10):
    """Most frequent dominant race at the n places with most crime, in one job.

    Rows are found by name alone, so places of the same name in other states count too.
    """
    crime = F.col("population") * F.col("ViolentCrimesPerPop")
    violent = places.filter((F.col("ViolentCrimesPerPop") > 0) & (F.col("population") > 0))
    worst = violent.groupBy(*PLACE).agg(F.max(crime).alias("crime"))
    worst = top(worst, "crime", n, ties=PLACE).select(*PLACE)
    at_worst = dominant_race(places).drop("state").join(worst, "communityname")
    counts = at_worst.groupBy(*PLACE, "max_pctRace").agg(F.count(F.lit(1)).alias("n"))
    winners = mode_of_counts(counts, PLACE, "max_pctRace", "race")
    place = F.replace("communityname", F.lit("city"), F.lit("")).alias("place")
    return winners.select("state", place, "race")


REPORTS = {
    "mq01": mq01_police_budget,
    "mq02": mq02_violent_crimes,
    "mq03": mq03_population,
    "mq04": mq04_black_population,
    "mq05": mq05_wage_earners,
    "mq06": mq06_young_people,
    "mq07": mq07_budget_and_crime,
    "mq08": mq08_white_police_and_budget,
    "mq09": mq09_population_and_budget,
    "mq10": mq10_population_and_crime,
    "mq11": mq11_income_and_crime,
    "mq12": mq12_race_of_violent_places,
}
