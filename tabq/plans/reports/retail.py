"""Reports over cleaned retail sales.

``rank_on`` picks how sums are compared, see ``operators.groups.ranked``.
"""

from pyspark.sql import functions as F

from tabq.operators.groups import ranked, top

GIFT = "gift_0001"


def amount():
    return F.col("UnitPrice") * F.col("Quantity")


def rq01_gift_revenue(sales, code=GIFT):
    gifts = sales.filter(F.col("StockCode").contains(code))
    return gifts.agg(F.format_number(F.sum(amount()), 2).alias("revenue"))


def rq02_gift_prices_by_month(sales, code=GIFT):
    gifts = sales.filter(F.col("StockCode").contains(code))
    monthly = gifts.groupBy(F.month("InvoiceDate").alias("month"))
    return monthly.agg(F.format_number(F.sum("UnitPrice"), 2).alias("prices")).orderBy("month")


def rq03_samples_sold(sales):
    return sales.filter(F.col("StockCode").endswith("S")).agg(F.sum("Quantity").alias("quantity"))


def rq04_best_seller(sales):
    sold = sales.groupBy("StockCode").agg(F.sum("Quantity").alias("quantity"))
    return top(sold, "quantity", ties=["StockCode"])


def rq05_products_by_month(sales):
    month = F.month("InvoiceDate").alias("month")
    sold = sales.groupBy("StockCode", month).agg(F.sum("Quantity").alias("quantity"))
    return sold.orderBy(F.desc("quantity"), "StockCode", "month")


def _top_revenue(sales, by, name, rank_on):
    revenue = sales.groupBy(by.alias(name)).agg(F.sum(amount()).alias("amount"))
    return ranked(revenue, "amount", "revenue", rank_on=rank_on, ties=[name])


def rq06_best_hour(sales, rank_on="numeric"):
    return _top_revenue(sales, F.hour("InvoiceDate"), "hour", rank_on)


def rq07_best_month(sales, rank_on="numeric"):
    return _top_revenue(sales, F.month("InvoiceDate"), "month", rank_on)


def rq08_best_product_of_best_year(sales, rank_on="numeric"):
    """The year's sums are added up from the finer ones, so the sales are read once."""
    fine = sales.groupBy(
        F.year("InvoiceDate").alias("year"), "Description", F.month("InvoiceDate").alias("month")
    ).agg(F.sum(amount()).alias("amount"))
    years = fine.groupBy("year").agg(F.sum("amount").alias("amount"))
    best = ranked(years, "amount", "revenue", rank_on=rank_on, ties=["year"])
    best = best.select(F.col("year").alias("best")).filter(F.col("best").isNotNull())
    # One row, so the broadcast is bounded. A plain equality would add a filter to one of the two
    # uses of the fine sums and so keep them from sharing a shuffle.
    same = F.col("year").eqNullSafe(F.col("best"))
    of_year = fine.join(F.broadcast(best), same).drop("year", "best")
    return ranked(of_year, "amount", "revenue", rank_on=rank_on, ties=["Description", "month"])


def rq08_of_partitions(sales, rank_on="numeric"):
    """The same over sales that are stored by year: the best year is a scalar subquery that leaves all
    other folders unread."""
    years = sales.groupBy("year").agg(F.sum(amount()).alias("amount"))
    best = ranked(years, "amount", "revenue", rank_on=rank_on, ties=["year"]).select("year").scalar()
    of_year = sales.filter(F.col("year") == best).groupBy(
        "Description", F.month("InvoiceDate").alias("month")).agg(F.sum(amount()).alias("amount"))
    return ranked(of_year, "amount", "revenue", rank_on=rank_on, ties=["Description", "month"])


def rq09_best_country(sales, rank_on="numeric"):
    return _top_revenue(sales, F.col("Country"), "Country", rank_on)


def rq10_best_country_for_m_codes(sales, rank_on="numeric"):
    manual = sales.filter(F.col("StockCode").endswith("M"))
    sold = manual.groupBy("Country").agg(F.sum("Quantity").alias("sold"))
    return ranked(sold, "sold", "quantity", rank_on=rank_on, ties=["Country"])


def rq11_largest_line(sales):
    largest = sales.groupBy("InvoiceNo").agg(F.max(amount()).alias("greatest_amount"))
    return top(largest, "greatest_amount", ties=["InvoiceNo"])


def rq12_largest_quantity(sales):
    largest = sales.groupBy("InvoiceNo").agg(F.max("Quantity").alias("greatest_quantity"))
    return top(largest, "greatest_quantity", ties=["InvoiceNo"])


def rq13_most_frequent_customer(sales):
    known = sales.filter(F.col("CustomerID").isNotNull())
    lines = known.groupBy("CustomerID").agg(F.count(F.lit(1)).alias("n"))
    return top(lines, "n", ties=["CustomerID"])


REPORTS = {
    "rq01": rq01_gift_revenue,
    "rq02": rq02_gift_prices_by_month,
    "rq03": rq03_samples_sold,
    "rq04": rq04_best_seller,
    "rq05": rq05_products_by_month,
    "rq06": rq06_best_hour,
    "rq07": rq07_best_month,
    "rq08": rq08_best_product_of_best_year,
    "rq09": rq09_best_country,
    "rq10": rq10_best_country_for_m_codes,
    "rq11": rq11_largest_line,
    "rq12": rq12_largest_quantity,
    "rq13": rq13_most_frequent_customer,
}
