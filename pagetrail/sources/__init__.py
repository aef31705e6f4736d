from pagetrail.sources.files import (
    read_header_csv,
    read_pageview_parquet,
    read_pageview_tsv,
    read_points_text,
    read_table,
)
from pagetrail.sources.jdbc import partitions_for, read_jdbc, read_jdbc_auto, read_jdbc_partitioned, read_jdbc_split, split_predicates

__all__ = [
    "partitions_for",
    "read_header_csv",
    "read_jdbc",
    "read_jdbc_auto",
    "read_jdbc_partitioned",
    "read_jdbc_split",
    "read_pageview_parquet",
    "read_pageview_tsv",
    "read_points_text",
    "read_table",
    "split_predicates",
]
