"""Product lookup."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickloom.operators.bounds import BROADCAST_BYTES, BROADCAST_ROWS, fits_broadcast

CATALOG_COLUMNS = ("product_id", "product_name", "category", "price")


def lookup(
    events: DataFrame,
    catalog: DataFrame,
    max_rows: int = BROADCAST_ROWS,
    max_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """Add ``catalog_name``, ``catalog_category`` and ``catalog_price``.

    Every event is kept, once; they are null for an event without a known
    product. Of a product id with several rows the one with the least name,
    category and price counts. Works on a stream of events with a static catalog.
    """
    kept = F.struct("product_name", "category", "price")
    products = (
        catalog.filter(F.col("product_id").isNotNull())
        .groupBy(F.col("product_id").alias("_product"))
        .agg(F.min(kept).alias("_kept"))
        .select(
            "_product",
            F.col("_kept.product_name").alias("catalog_name"),
            F.col("_kept.category").alias("catalog_category"),
            F.col("_kept.price").alias("catalog_price"),
        )
    )
    if fits_broadcast(products, max_rows, max_bytes):
        same_product = F.col("product_id") == F.col("_product")
        return events.join(F.broadcast(products), same_product, "left").drop("_product")
    # Events without a product go past the join. A hot product's events meet one
    # catalog row, and adaptive execution splits their partition.
    nothing = {c: F.lit(None).cast(t) for c, t in products.dtypes if c != "_product"}
    with_product = events.filter(F.col("product_id").isNotNull())
    found = with_product.join(
        products.hint("merge"), F.col("product_id") == F.col("_product"), "left"
    ).drop("_product")
    return found.unionByName(events.filter(F.col("product_id").isNull()).withColumns(nothing))
