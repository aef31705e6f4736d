from pagetrail.operators.joins import salted_join
from pagetrail.operators.keyed import keyed_upsert, multi_get, prefix_scan, range_scan
from pagetrail.operators.paging import Paged, paged
from pagetrail.operators.topk import order_columns, top_k, top_per_group

__all__ = [
    "Paged",
    "keyed_upsert",
    "multi_get",
    "order_columns",
    "paged",
    "prefix_scan",
    "range_scan",
    "salted_join",
    "top_k",
    "top_per_group",
]
