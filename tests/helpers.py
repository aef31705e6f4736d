"""Hand-made page-view rows in the exact log schema."""

import datetime as dt

from pagetrail.schemas import PAGEVIEW_COLUMNS, PAGEVIEW_SCHEMA


def ts(s: str) -> dt.datetime:
    return dt.datetime.fromisoformat(s)


def pv_rows(spark, rows, with_id=True):
    """rows: list of dicts with any subset of the 20 columns (+ event_id)."""
    from pyspark.sql import types as T

    fields = list(PAGEVIEW_SCHEMA.fields)
    if with_id:
        fields.append(T.StructField("event_id", T.LongType(), True))
    schema = T.StructType(fields)
    names = [f.name for f in fields]
    data = [tuple(r.get(n) for n in names) for r in rows]
    return spark.createDataFrame(data, schema)


def view(guid, time, cookie=None, path="/a", ip=1, domain="x.com", os_code=1, browser=1, event_id=None, **kw):
    r = {c: None for c in PAGEVIEW_COLUMNS}
    r.update(
        guid=guid,
        timeCreate=ts(time) if isinstance(time, str) else time,
        cookieCreate=ts(cookie) if isinstance(cookie, str) else cookie,
        path=path,
        ip=ip,
        domain=domain,
        osCode=os_code,
        browserCode=browser,
        event_id=event_id,
    )
    r.update(kw)
    return r
