"""Business reports."""

from oracle.cleaning import MARRIED, corr, dominant
from oracle.views import with_views

AMOUNT = "UnitPrice * Quantity"


def money(value, decimals=2):
    return f"format('{{:,.{decimals}f}}', CAST({value} AS DOUBLE))"


def whole(value):
    return f"CAST({value} AS BIGINT)"


def part(unit, column="InvoiceDate"):
    return f"CAST({unit}({column}) AS INT)"


def top_revenue(by, name, formatted, where="TRUE", value=f"sum({AMOUNT})", output="revenue"):
    order = "shown" if formatted else "raw"
    return (
        f'SELECT "{name}", shown AS {output} FROM (SELECT {by} AS "{name}", {value} AS raw, '
        f"{money(value)} AS shown FROM sales WHERE {where} GROUP BY 1) "
        f'ORDER BY {order} DESC NULLS LAST, "{name}" NULLS FIRST LIMIT 1'
    )


def best_of_year(formatted):
    order = "shown" if formatted else "raw"
    picked = (
        f"SELECT y FROM (SELECT year(InvoiceDate) AS y, sum({AMOUNT}) AS raw, "
        f"{money(f'sum({AMOUNT})')} AS shown FROM sales GROUP BY 1) "
        f"ORDER BY {order} DESC NULLS LAST, y NULLS FIRST LIMIT 1"
    )
    return (
        f"SELECT Description, month, shown AS revenue FROM (SELECT Description, {part('month')} AS "
        f"month, sum({AMOUNT}) AS raw, {money(f'sum({AMOUNT})')} AS shown FROM sales "
        f"WHERE year(InvoiceDate) = ({picked}) GROUP BY 1, 2) "
        f"ORDER BY {order} DESC NULLS LAST, Description NULLS FIRST, month NULLS FIRST LIMIT 1"
    )


def top_by(view, key, value, output, where="TRUE", n=1):
    return (
        f"SELECT {key}, {value} AS {output} FROM {view} WHERE {where} GROUP BY {key} "
        f"ORDER BY {output} DESC NULLS LAST, "
        f"{', '.join(k.strip() + ' NULLS FIRST' for k in key.split(','))} LIMIT {n}"
    )


def retail():
    gifts = "contains(StockCode, 'gift_0001')"
    q = {
        "rq01": f"SELECT {money(f'sum({AMOUNT})')} AS revenue FROM sales WHERE {gifts}",
        "rq02": f"SELECT {part('month')} AS month, {money('sum(UnitPrice)')} AS prices FROM sales "
                f"WHERE {gifts} GROUP BY 1",
        "rq03": f"SELECT {whole('sum(Quantity)')} AS quantity FROM sales "
                "WHERE StockCode LIKE '%S'",
        "rq04": top_by("sales", "StockCode", whole("sum(Quantity)"), "quantity"),
        "rq05": f"SELECT StockCode, {part('month')} AS month, {whole('sum(Quantity)')} AS quantity "
                "FROM sales GROUP BY 1, 2",
        "rq11": "SELECT InvoiceNo, round(greatest_amount, 6) AS greatest_amount FROM ("
                + top_by("sales", "InvoiceNo", f"max({AMOUNT})", "greatest_amount") + ")",
        "rq12": top_by("sales", "InvoiceNo", "max(Quantity)", "greatest_quantity"),
        "rq13": top_by("sales", "CustomerID", "count(*)", "n", "CustomerID IS NOT NULL"),
    }
    for suffix, formatted in (("", False), ("_formatted", True)):
        q[f"rq06{suffix}"] = top_revenue(part("hour"), "hour", formatted)
        q[f"rq07{suffix}"] = top_revenue(part("month"), "month", formatted)
        q[f"rq08{suffix}"] = best_of_year(formatted)
        q[f"rq09{suffix}"] = top_revenue("Country", "Country", formatted)
        q[f"rq10{suffix}"] = top_revenue(
            "Country", "Country", formatted, "StockCode LIKE '%M'", "sum(Quantity)", "quantity"
        )
    return q


def mode(group, value, source="people", where="TRUE", extra="", count=None):
    count = count or f'count("{value}")'
    return (
        f'SELECT "{group}", "{value}"{extra} FROM (SELECT "{group}", "{value}", {count} AS n, '
        f'row_number() OVER (PARTITION BY "{group}" ORDER BY {count} DESC, "{value}" NULLS LAST) '
        f"AS place FROM {source} WHERE {where} GROUP BY 1, 2) WHERE place = 1"
    )


def census():
    hours = 'avg(CAST("hours-per-week" AS DOUBLE))'
    men, women = "count(*) FILTER (WHERE sex = ' Male')", "count(*) FILTER (WHERE sex = ' Female')"
    marriages = f"(SELECT *, {MARRIED} AS married_status FROM people)"
    own = "(contains(workclass, 'Self-emp-not-inc') OR contains(workclass, 'Self-emp-inc'))"

    def per(a, b):
        return f"round({a} / CAST({b} AS DOUBLE), 6) AS ratio"

    def least(order):
        return (
            f"SELECT occupation, {money(hours)} AS avg_hours FROM people "
            "WHERE occupation NOT LIKE '%?%' GROUP BY 1 "
            f"ORDER BY {order} NULLS FIRST, occupation LIMIT 1"
        )

    def melted_mode(column):
        inner = mode("k", column, f"(SELECT 1 AS k, {column} FROM people WHERE {own})")
        return f"SELECT '{column}' AS \"column\", {column} AS value FROM ({inner})"

    by_race = f"SELECT race, {money(hours)} AS avg_hours FROM people GROUP BY 1"
    married = "count(*) FILTER (WHERE married_status = 'married')"
    single = "count(*) FILTER (WHERE married_status = 'not_married')"
    white = "count(*) FILTER (WHERE contains(race, 'White'))"
    other = "count(*) FILTER (WHERE NOT contains(race, 'White'))"
    return {
        "cq01": "SELECT DISTINCT workclass FROM people WHERE workclass NOT LIKE '%?%' "
                "AND income LIKE '%<=50K%'",
        "cq02": by_race,
        "cq02_formatted": by_race,
        "cq03": f"SELECT count(*) AS people, {men} AS male, {women} AS female, "
                f"{per(men, women)} FROM people",
        "cq04": f"SELECT count(*) AS people, {women} AS female, {men} AS male, "
                f"{per(women, men)} FROM people",
        "cq05": least(hours),
        "cq05_formatted": least(money(hours)),
        "cq06": mode("education", "occupation",
                     where="occupation NOT LIKE '%?%' AND education NOT LIKE '%?%'"),
        "cq07": mode("sex", "occupation"),
        "cq08": mode("race", "education"),
        "cq09": top_by("people", "education, sex, race", "count(*)", "n",
                       "contains(workclass, 'Self-emp-not-inc') "
                       "OR contains(workclass, ' Self-emp-inc')"),
        "cq09_modes": " UNION ALL ".join(map(melted_mode, ("education", "race", "sex"))),
        "cq10": f"SELECT {per(married, single)} FROM {marriages}",
        "cq11": top_by(marriages, "race", "count(race)", "n",
                       "married_status = 'not_married'", 2),
        "cq12": mode("married_status", "income", marriages, extra=", n"),
        "cq13": mode("sex", "income", where="sex NOT LIKE '%?%'"),
        "cq14": mode("native-country", "income", where="\"native-country\" NOT LIKE '%?%'"),
        "cq15": f"SELECT {per(white, other)} FROM people",
    }


def communities():
    place = "state, communityname"

    def top_place(value, output, where="TRUE", key=place):
        inner = top_by("places", key, value, output, where)
        return f"SELECT * REPLACE (round({output}, 6) AS {output}) FROM ({inner})"

    def budget(order):
        return (
            f"SELECT {place}, {money('sum(PolicOperBudg)')} AS budget FROM places GROUP BY 1, 2 "
            f"ORDER BY {order} DESC NULLS LAST, state NULLS FIRST, communityname LIMIT 1"
        )

    pairs = {
        "mq07": ("PolicOperBudg", "ViolentCrimesPerPop"),
        "mq08": ("PctPolicWhite", "PolicOperBudg"),
        "mq09": ("population", "PolicBudgPerPop"),
        "mq10": ("population", "ViolentCrimesPerPop"),
        "mq11": ("medIncome", "ViolentCrimesPerPop"),
    }
    worst = top_by("places", place, "max(population * ViolentCrimesPerPop)", "crime",
                   "ViolentCrimesPerPop > 0 AND population > 0", 10)
    q = {
        "mq01": budget("sum(PolicOperBudg)"),
        "mq01_formatted": budget("budget"),
        "mq02": top_place("sum(ViolentCrimesPerPop)", "crimes",
                          key="state, community, communityname"),
        "mq03": top_place("max(population)", "population", "population > 0"),
        "mq03_sum": top_place("sum(population)", "population", "population > 0"),
        "mq04": top_place("max(racepctblack)", "black_population", "racepctblack > 0"),
        "mq04_people": top_place("max(population * racepctblack)", "black_population",
                                 "racepctblack > 0"),
        "mq05": top_place("max(pctWWage)", "wage_share"),
        "mq06": top_place("max(agePct12t21)", "young_share"),
        "mq06_older": top_place("max(agePct16t24)", "young_share"),
        "mq12": f"""
            SELECT state, replace(communityname, 'city', '') AS place, race FROM (
              SELECT w.state, w.communityname, p.race, row_number() OVER (
                PARTITION BY w.state, w.communityname ORDER BY count(*) DESC, p.race NULLS LAST)
                AS rank
              FROM ({worst}) w
              JOIN (SELECT communityname, {dominant()} AS race FROM places) p
                ON p.communityname = w.communityname
              GROUP BY 1, 2, 3) WHERE rank = 1""",
    }
    for name, (a, b) in pairs.items():
        q[name] = f"SELECT {corr(a, b, True)} FROM places"
        q[f"{name}_skip"] = f"SELECT {corr(a, b, False)} FROM places"
    return q


YEAR = "CAST(year(dep_datetime) AS INT) AS year"
ROUTE = "origin, dest"


def trips(columns, groups=0, where="TRUE"):
    keys = ", ".join(str(i + 1) for i in range(groups))
    tail = f" GROUP BY {keys}" if groups else ""
    return f"SELECT {columns} FROM trips WHERE {where}{tail}"


def up(value, name):
    return f"CAST(ceil(avg({value})) AS BIGINT) AS {name}"


def flights():
    dest, origin = "air2_region AS region", "air_region AS region"
    both = f"{whole('sum(dep_delay)')} + {whole('sum(arr_delay)')} AS delay"
    late = "arr_delay > 0 OR dep_delay > 0"

    def most(key, name, where="TRUE"):
        return top_by(f"(SELECT {key} AS {name} FROM trips WHERE {where})", name, "count(*)", "n")

    def miles(value, unit, decimals=1):
        return f"{money(value, decimals)} || '{unit}' AS distance"

    def top_group(columns, group, keyed):
        counts = f"(SELECT {columns}, count(*) AS n FROM trips GROUP BY ALL)"
        if keyed:
            return (
                f"SELECT * EXCLUDE (place) FROM (SELECT *, rank() OVER (PARTITION BY {group} "
                f"ORDER BY n DESC) AS place FROM {counts}) WHERE place = 1"
            )
        return (
            f"SELECT c.*, count(*) AS copies FROM {counts} c JOIN (SELECT {group}, max(n) AS m "
            f"FROM {counts} GROUP BY {group}) g ON c.n = g.m GROUP BY ALL"
        )

    season = ("dep_season AS season, dest", "dest")
    classes = ("dep_delay_category AS delay_class, origin, dest", "origin, dest")
    air_by_route = trips(f"{ROUTE}, {up('air_time', 'air_time')}", 2)
    q = {
        "fr01": trips(f"{dest}, count(DISTINCT air2_name) AS airports", 1),
        "fr02": trips("max(air_alt - air2_alt) AS altitude_drop"),
        "fr03": trips("carrier, round(avg(arr_delay), 6) AS avg_arr_delay, "
                      "round(avg(dep_delay), 6) AS avg_dep_delay", 1),
        "fr03_late": trips(
            f"{money('avg(arr_delay) FILTER (WHERE arr_delay > 0)', 1)} AS avg_arr_delay, "
            f"{money('avg(dep_delay) FILTER (WHERE dep_delay > 0)', 1)} AS avg_dep_delay"),
        "fr07": trips(f"{YEAR}, {both}", 1, late),
        "fr07_all": trips(f"{YEAR}, {both}", 1),
        "fr09": trips(up("air_time", "air_time")),
        "fr10": trips(f"{dest}, {up('air_time', 'air_time')}", 1),
        "fr11": air_by_route,
        "fr12": trips(f"{YEAR}, {up('air_time', 'air_time')}", 1),
        "fr13": trips(f"{dest}, {whole('sum(air_time)')} AS air_time", 1),
        "fr14": trips("round(avg(distance)) AS distance"),
        "fr15": trips(f"{dest}, round(avg(distance)) AS distance", 1),
        "fr16": trips(f"{ROUTE}, CAST(round(avg(distance)) AS VARCHAR) || ' mls' AS distance", 2),
        "fr17": trips(f"{YEAR}, {miles('sum(distance)', 'mls')}", 1),
        "fr18": trips(f"{dest}, {miles('sum(distance)', 'mls')}", 1),
        "fr19": trips(f"{ROUTE}, {money('ceil(avg(pl_seats))', 0)} || ' passageiros' AS seats", 2),
        "fr20": trips(f"{YEAR}, {money('sum(pl_seats)', 0)} AS seats", 1),
        "fr21": most("dest", "dest"),
        "fr22": top_by("trips", "dest", whole("sum(pl_seats)"), "seats"),
        "fr23": f"SELECT origin, dest, {miles('distance', ' mls')} FROM (SELECT * FROM trips "
                "WHERE origin = 'PDX' OR dest = 'PDX' ORDER BY distance DESC NULLS LAST, "
                "origin NULLS FIRST, dest NULLS FIRST LIMIT 1)",
        "fr24": most("pl_model", "model"),
        "fr25": top_by("(SELECT dest, pl_model AS model FROM trips WHERE pl_model IS NOT NULL)",
                       "dest, model", "count(*)", "n"),
        "fr26": trips(f"haul_duration AS haul, {up('pl_engines', 'engines')}", 1),
        "fr27": most("dep_season", "season"),
        "fr28": top_group(*season, True),
        "fr28_compat": top_group(*season, False),
        "fr29": most("dep_delay_category", "delay_class"),
        "fr30": top_group(*classes, True),
        "fr30_compat": top_group(*classes, False),
    }
    for delay in ("arr", "dep"):
        for suffix, where in (("late", f"{delay}_delay > 0"), ("all", "TRUE")):
            mean = up(f"{delay}_delay", "delay")
            total = f"{whole(f'sum({delay}_delay)')} AS delay"
            q[f"fr04_{delay}_{suffix}"] = trips(f"{dest}, {mean}", 1, where)
            q[f"fr05_{delay}_{suffix}"] = trips(f"{origin}, {mean}", 1, where)
            q[f"fr06_{delay}_{suffix}"] = trips(f"{YEAR}, {total}", 1, where)
    for suffix, where in (("late", late), ("all", "TRUE")):
        q[f"fr08_origin_{suffix}"] = trips(f"{YEAR}, {origin}, {both}", 2, where)
        q[f"fr08_dest_{suffix}"] = trips(f"{YEAR}, {dest}, {both}", 2, where)
    return q


def statements():
    return {
        name: with_views(sql)
        for family in (retail, census, communities, flights)
        for name, sql in family().items()
    }
