"""Reports over census records, read as they are."""

from pyspark.sql import functions as F

from tabq.functions.predicates import contains_any
from tabq.operators.groups import mode_of_counts, mode_per_group, ranked, ratio, top
from tabq.operators.profile import melt, name_of
from tabq.plans.cleaning import married, self_employed


def known(people, *columns):
    """Rows without a question mark in the columns; NULL goes too."""
    for c in columns:
        people = people.filter(~F.col(f"`{c}`").contains("?"))
    return people


def average_hours(people, by):
    return people.groupBy(by).agg(F.avg("`hours-per-week`").alias("hours"))


def cq01_low_income_workclasses(people):
    low = known(people, "workclass").filter(F.col("income").contains("<=50K"))
    return low.select("workclass").distinct()


def cq02_hours_by_race(people, rank_on="numeric"):
    hours = average_hours(people, "race")
    shown = hours.withColumn("avg_hours", F.format_number("hours", 2))
    order = {"numeric": "hours", "formatted": "avg_hours"}[rank_on]
    return shown.orderBy(F.desc(order), "race").select("race", "avg_hours")


def _sexes(people, part, whole):
    sex = F.ltrim("sex")
    n_part, n_whole = F.count_if(sex == part), F.count_if(sex == whole)
    return people.agg(
        F.count(F.lit(1)).alias("people"),
        n_part.alias(part.lower()),
        n_whole.alias(whole.lower()),
        F.try_divide(n_part, n_whole).alias("ratio"),
    )


def cq03_men_per_woman(people):
    return _sexes(people, "Male", "Female")


def cq04_women_per_man(people):
    return _sexes(people, "Female", "Male")


def cq05_occupation_with_least_hours(people, rank_on="numeric"):
    hours = average_hours(known(people, "occupation"), "occupation")
    return ranked(
        hours, "hours", "avg_hours", rank_on=rank_on, ties=["occupation"], descending=False
    )


def cq06_occupation_by_education(people):
    return mode_per_group(known(people, "occupation", "education"), "education", "occupation")


def cq07_occupation_by_sex(people):
    return mode_per_group(people, "sex", "occupation")


def cq08_education_by_race(people):
    return mode_per_group(people, "race", "education")


def cq09_self_employed_profile(people):
    """The most frequent combination of education, sex and race."""
    own = self_employed(people).filter(F.col("self-employed").isNotNull())
    counts = own.groupBy("education", "sex", "race").agg(F.count(F.lit(1)).alias("n"))
    return top(counts, "n", ties=["education", "sex", "race"])


def cq09_self_employed_modes(people):
    """The most frequent education, race and sex, each on its own."""
    own = people.filter(contains_any("workclass", ["Self-emp-not-inc", "Self-emp-inc"]))
    columns = ["education", "race", "sex"]
    return mode_per_group(melt(own, columns), "place", "value").select(name_of(columns), "value")


def cq10_married_per_unmarried(people):
    status = F.col("married_status")
    return ratio(married(people), status == "married", status == "not_married")


def cq11_unmarried_races(people):
    single = married(people).filter(F.col("married_status") == "not_married")
    counts = single.groupBy("race").agg(F.count("race").alias("n"))
    return top(counts, "n", 2, ties=["race"])


def cq12_income_by_marriage(people):
    counts = married(people).groupBy("married_status", "income")
    counts = counts.agg(F.count("income").alias("n"))
    return mode_of_counts(counts, "married_status", "income", with_count=True)


def cq13_income_by_sex(people):
    return mode_per_group(known(people, "sex"), "sex", "income")


def cq14_income_by_country(people):
    return mode_per_group(known(people, "native-country"), "native-country", "income")


def cq15_white_per_other(people):
    white = F.col("race").contains("White")
    return ratio(people, white, ~white)


REPORTS = {
    "cq01": cq01_low_income_workclasses,
    "cq02": cq02_hours_by_race,
    "cq03": cq03_men_per_woman,
    "cq04": cq04_women_per_man,
    "cq05": cq05_occupation_with_least_hours,
    "cq06": cq06_occupation_by_education,
    "cq07": cq07_occupation_by_sex,
    "cq08": cq08_education_by_race,
    "cq09": cq09_self_employed_profile,
    "cq09_modes": cq09_self_employed_modes,
    "cq10": cq10_married_per_unmarried,
    "cq11": cq11_unmarried_races,
    "cq12": cq12_income_by_marriage,
    "cq13": cq13_income_by_sex,
    "cq14": cq14_income_by_country,
    "cq15": cq15_white_per_other,
}
