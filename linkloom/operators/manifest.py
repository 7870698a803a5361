"""Source list to harvest manifest."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linkloom.functions import indexed_prefix, landed_name


def harvest_manifest(source_list: DataFrame) -> DataFrame:
    """The file name every entry's dump is stored under.

    Input: list_index, beacon_url, and anything else. Entries without a URL are skipped but
    keep their place in the count. Output: list_index, beacon_url, file_name.
    """
    url = F.col("beacon_url")
    return source_list.where(url.isNotNull() & (url != "")).select(
        "list_index",
        "beacon_url",
        landed_name(url, indexed_prefix(F.col("list_index"), url)).alias("file_name"),
    )
