"""Product dimension operators."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def dedup_products(products: DataFrame) -> DataFrame:
    """One row per productid: the lowest subcatid (ties by brandid, productcatid; NULLs last).

    ``row_number() = 1`` is planned as a WindowGroupLimit, which Spark also
    applies partially before the shuffle, so a product with very many
    rows never reaches one task whole.
    """
    w = Window.partitionBy("productid").orderBy(
        F.col("subcatid").asc_nulls_last(), F.col("brandid").asc_nulls_last(), F.col("productcatid").asc_nulls_last()
    )
    return (
        products.select("productid", "brandid", "productcatid", "subcatid")
        .withColumn("_rn", F.row_number().over(w))
        .where(F.col("_rn") == 1)
        .drop("_rn")
    )


def product_categories(products: DataFrame) -> DataFrame:
    """Distinct (productid, productcatid) pairs: all a category lookup can add."""
    return products.select("productid", "productcatid").distinct()


def with_category(lines: DataFrame, products: DataFrame, null_safe: bool = False) -> DataFrame:
    """LEFT JOIN lines to product categories on productid.

    ``null_safe=False`` is the SQL join (a NULL productid matches nothing,
    a product with several categories fans the line out).
    ``null_safe=True`` also pairs a NULL productid with a NULL product key,
    as a dataframe merge does; use it with deduplicated products.
    """
    cats = products.select("productid", "productcatid")
    if not null_safe:
        return lines.join(cats, "productid", "left")
    p = cats.withColumnRenamed("productid", "_pid")
    return lines.join(p, lines["productid"].eqNullSafe(p["_pid"]), "left").drop("_pid")
