"""Keyed (wide-column) tables on DataFrames.

A keyed table is a DataFrame unique on ``row_key`` with one column per cell;
a null cell means "never written". Writes are last-writer-wins *per cell*:
a later put replaces the cells it carries and leaves the others as they were.

* ``keyed_upsert`` — merge a batch of puts into a table (or build one).
  Per cell: ``max_by(cell, order)`` over the puts that carry the cell, one
  aggregation on the key. When no cell can be absent, in the target either, the
  winner is a whole put: ``row_number() = 1`` per key. Both combine map-side before the
  shuffle (partial aggregation / partial WindowGroupLimit), so a key that
  owns a third of all rows never lands whole in one task.
* ``multi_get`` — look up a set of keys (with multiplicity) and project cells.
* ``range_scan`` / ``prefix_scan`` — rows with ``start <= row_key < stop``.
  On a table written sorted by key (``sinks.write_keyed_table``) the
  predicate prunes Parquet row groups; on a derived table Catalyst pushes it
  below the upsert aggregation because it only touches the grouping key.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pagetrail.functions.keys import prefix_successor
from pagetrail.functions.time import q
from pagetrail.operators.topk import top_per_group
from pagetrail.schemas import ROW_KEY, resolve_cell

_BATCH = "__batch"


def keyed_upsert(
    updates: DataFrame,
    cells: Sequence[str],
    version: Sequence[str],
    key: str | Sequence[str] = ROW_KEY,
    target: DataFrame | None = None,
    count_as: str | None = None,
    count_where: Column | None = None,
) -> DataFrame:
    """Last-writer-wins merge of ``updates`` into ``target`` (None = empty).

    ``version`` columns order the puts inside one batch (greater wins, null
    least); they must order the puts of a key totally, e.g. event time then a
    unique id, or the cells themselves. Every row of ``updates`` is later than
    every row of ``target``. Rows without a key cannot be stored in a keyed
    table and are not written. A batch may carry some of the cells only:
    those of ``cells`` that it has as columns. Returns the key, the cells of
    the target and those of the batch (+ ``count_as``, the number of update
    rows put on each key — only those satisfying ``count_where`` when given).

    ``key`` may be several typed columns, which spares a shuffle when the
    rows are already dealt by them.
    """
    if not version:
        raise ValueError("an upsert needs version columns that order the puts of a key")
    keys = [key] if isinstance(key, str) else list(key)
    carried = [c for c in cells if c in updates.columns]
    kept = [c for c in target.columns if c not in keys] if target is not None else []
    all_cells = [*kept, *[c for c in carried if c not in kept]]
    extra = [v for v in version if v not in carried and v not in keys]
    upd = updates.where(F.expr(" AND ".join(f"{q(k)} IS NOT NULL" for k in keys)))
    counted_flag = (count_where if count_where is not None else F.lit(True)).cast("long")
    upd = upd.select(*keys, *carried, *extra, F.lit(1).alias(_BATCH), counted_flag.alias("__counted"))
    if target is not None:
        tgt = target.select(*keys, *kept).withColumn(_BATCH, F.lit(0)).withColumn("__counted", F.lit(0).cast("long"))
        rows = tgt.unionByName(upd, allowMissingColumns=True)
    else:
        rows = upd
    counted = [F.sum(F.col("__counted")).cast("long").alias(count_as)] if count_as else []
    whole = not any(upd.schema[c].nullable for c in carried)
    if whole and not count_as and (target is None or _same_whole_cells(tgt, upd, kept, carried)):
        # No cell can be absent, so every cell of a key comes from the same
        # winning put: pick whole puts, not one arg-max per cell.
        # row_number = 1 per key, cut to one row per key and task
        # before the shuffle (partial WindowGroupLimit).
        order = version if target is None else [_BATCH, *version]
        best = top_per_group(rows, keys, [(v, "desc") for v in order], n=1, rank_col=None)
        return best.select(*keys, *all_cells)
    if target is None and whole:
        # With a count the winner is a struct max next to the sum, both
        # partial-aggregated map-side.
        payload = [*version, *[c for c in carried if c not in version]]
        win = F.expr("max(struct(" + ", ".join(q(c) for c in payload) + "))").alias("__win")
        out = rows.groupBy(*keys).agg(win, *counted)
        return out.select(*keys, *[F.col("__win")[c].alias(c) for c in carried], count_as)
    # Per cell: the value of the greatest put that carries the cell. The
    # order is a struct, so that a null version is the least one, not none.
    order = "struct(" + ", ".join([_BATCH, *map(q, version)]) + ")"
    merged = [F.expr(f"max_by({q(c)}, CASE WHEN {q(c)} IS NOT NULL THEN {order} END)").alias(c) for c in all_cells]
    return rows.groupBy(*keys).agg(*merged, *counted)


def _same_whole_cells(target: DataFrame, updates: DataFrame, kept: Sequence[str], carried: Sequence[str]) -> bool:
    """Whether target rows and puts carry the same cells, of the same types and never null."""
    of = lambda df, cells: {c: df.schema[c].dataType for c in cells}
    return of(target, kept) == of(updates, carried) and not any(target.schema[c].nullable for c in kept)


def multi_get(
    table: DataFrame,
    keys: DataFrame,
    cells: Sequence[str],
    key: str = ROW_KEY,
    keep_missing: bool = False,
    families: dict[str, list[str]] | None = None,
) -> DataFrame:
    """Fetch ``cells`` for every row of ``keys`` (duplicates fetch twice).

    With ``families`` (a family -> cells map of the table) cells may be
    named ``family:cell``; the answer's columns are the bare cell names.

    ``keep_missing=False`` skips keys that are absent from the table (inner
    join), ``keep_missing=True`` keeps them with null cells (left outer join).
    """
    if families is not None:
        cells = [resolve_cell(families, c) for c in cells]
    k = keys.select(key)
    t = table.select(key, *cells)
    if keep_missing:
        return k.join(t, key, "left").select(key, *cells)
    return t.join(k, key, "inner").select(key, *cells)


def range_scan(
    table: DataFrame, start: str | int | None, stop: str | int | None, key: str = ROW_KEY
) -> DataFrame:
    """Rows with ``start <= key < stop``; a None bound is open."""
    cond = F.lit(True)
    if start is not None:
        cond = cond & (F.col(key) >= F.lit(start))
    if stop is not None:
        cond = cond & (F.col(key) < F.lit(stop))
    return table.where(cond)


def prefix_scan(table: DataFrame, prefix: str, key: str = ROW_KEY) -> DataFrame:
    """Rows whose string key starts with ``prefix``, as a key range."""
    return range_scan(table, prefix, prefix_successor(prefix), key)
