"""Filter lists: the provinces, stores, main groups and subgroups to choose from."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larder.operators.star import Star


def provinces(star: Star) -> DataFrame:
    return (
        star.stores.where(F.col("province_name").isNotNull())
        .select("province_id", "province_name").distinct()
        .orderBy("province_name", "province_id")
    )


def stores(star: Star, province_id=None) -> DataFrame:
    """All stores, or those of one province; a missing text becomes ''."""
    df = star.stores
    if province_id:
        df = df.where(F.col("province_id") == F.lit(province_id))
    return df.select("store_id", "store_name").fillna("").orderBy("store_name", "store_id")


def sold_ids(star: Star, column: str) -> DataFrame:
    """The distinct ids of a product column that ever sold.

    The sales are cut to their distinct product keys before the join, so what is
    joined has the size of the dimension and no hot key.
    """
    sold = star.sales.select("product_key").distinct()
    ids = sold.join(star.products.select("product_key", column), "product_key")
    return ids.select(column).distinct()


def _named(df: DataFrame, id_col: str, name_col: str) -> DataFrame:
    """Distinct id and name; names that are missing or hold a digit are left out."""
    name = F.col(name_col)
    return (
        df.where(name.isNotNull() & ~name.rlike("[0-9]"))
        .select(id_col, name_col).distinct()
        .orderBy(name_col, id_col)
    )


def maingroups(star: Star) -> DataFrame:
    """Main groups with a sale.

    The semi join is on the group id: a group keeps every name it has in the
    dimension, whether or not a product of that name sold.
    """
    listed = star.products.join(sold_ids(star, "maingroup_id"), "maingroup_id", "left_semi")
    return _named(listed, "maingroup_id", "maingroup_name")


def subgroups(star: Star, maingroup_id=None) -> DataFrame:
    """Subgroups with a sale, of one main group or of all."""
    df = star.products
    if maingroup_id:
        df = df.where(F.col("maingroup_id") == F.lit(maingroup_id))
    listed = df.join(sold_ids(star, "subgroup_id"), "subgroup_id", "left_semi")
    return _named(listed, "subgroup_id", "subgroup_name")
