"""Raw layer: source files as text tables with audit columns."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from parceltrail.sources.csv_text import quoted, read_text_csv

# Table -> file pattern below the data folder.
SOURCES = {
    "bronze_orders": "*_orders_dataset.csv",
    "bronze_orders_items": "*_order_items_dataset.csv",
    "bronze_products": "*_products_dataset.csv",
    "bronze_sellers": "*_sellers_dataset.csv",
    "bronze_geolocation": "*_geolocation_dataset.csv",
}


def load_csv(
    spark: SparkSession, path: str, run_ts: datetime | None = None, **csv_options: bool | None
) -> DataFrame:
    """Text columns of the files at ``path``, then ``ingestion_date`` and ``source_file``.

    Columns of these two names in the files, as in an exported raw table, are replaced.
    """
    rows = read_text_csv(spark, path, **csv_options)
    now = F.lit(str(run_ts)).cast("timestamp_ntz") if run_ts else F.localtimestamp()
    values = [c for c in rows.columns if c.lower() not in ("ingestion_date", "source_file")]
    return rows.select(*map(quoted, values), now.alias("ingestion_date"), "source_file")
