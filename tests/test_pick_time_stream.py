"""Stream-stream outer join of item totals and working time, against the batch join."""

import datetime as dt

from conftest import T, role_df
from opsmetrics.plans import hourly
from opsmetrics.streaming import hourly_items, pick_time

PRODUCTS = [dict(productid=1, productcatid="7", subcatid=1), dict(productid=2, productcatid="999", subcatid=1), dict(productid=2, productcatid="3", subcatid=9)]


def _detail(spark, rows):
    """(worker, time, quantity, product)"""
    data = [(w, "B2B" if q % 2 else "B2C", float(q), float(q), 0.0, p, T(t), "Picking", "whracks10") for w, t, q, p in rows]
    return spark.createDataFrame(data, hourly_items.DETAIL_SCHEMA)


def _time(spark, rows):
    """(worker, hour, microseconds)"""
    return spark.createDataFrame([("whracks10", "Picking", T(t), w, us) for w, t, us in rows], pick_time.TIME_SCHEMA.replace("decimal(38,0)", "bigint")).selectExpr(
        "warehouse", "process", "timestamp", "emailaddress", "cast(working_us as decimal(38,0)) working_us")


BATCHES = [
    ([("a", "2024-01-08 09:10", 3, 1), ("b", "2024-01-08 09:50", 4, 2), (None, "2024-01-08 09:20", 9, 1)], [("a", "2024-01-08 09:00", 7)]),
    # The hour of 9 is still open: more items of a, the time of b; c has no time, d has time only.
    ([("a", "2024-01-08 09:59", 5, 2), ("c", "2024-01-08 10:05", 1, None)], [("b", "2024-01-08 09:00", 11), ("d", "2024-01-08 09:00", 13)]),
    ([("a", "2024-01-08 15:05", 2, 1)], [("a", "2024-01-08 15:00", 17), ("a", "2024-01-08 15:00", 17)]),
]


def test_equals_the_batch_join_after_the_last_watermark(spark, tmp_path):
    products = role_df(spark, "productdetails", PRODUCTS)
    dirs = [str(tmp_path / d) for d in ("items", "time", "out", "checkpoint")]
    seen = []
    for items, time in BATCHES:
        _detail(spark, items).write.mode("append").parquet(dirs[0])
        _time(spark, time).write.mode("append").parquet(dirs[1])
        seen.append(pick_time.run_available(spark, *dirs[:2], products, *dirs[2:]).count())  # started anew each time
    assert seen == [0, 0, 3]  # 9 and 10 close when both inputs have reached 15; 15 is still open
    for mark, d in zip(pick_time.end_mark(spark, T("2024-01-09 00:00")), dirs):
        mark.write.mode("append").parquet(d)
    df = pick_time.run_available(spark, *dirs[:2], products, *dirs[2:])
    every = _detail(spark, [r for items, _ in BATCHES for r in items])
    time = _time(spark, sorted({r for _, rows in BATCHES for r in rows}))
    want = hourly.with_time(hourly.item_totals(every, products), time)
    assert df.columns == want.columns
    got = sorted(tuple(r) for r in df.collect())
    assert got == sorted(tuple(r) for r in want.collect()) and len(got) == 4
    assert [r[3] for r in got if r[-1] is None] == ["c"]  # without time, once


def test_a_row_beyond_the_delay_is_dropped(spark, tmp_path):
    products = role_df(spark, "productdetails", PRODUCTS)
    dirs = [str(tmp_path / d) for d in ("items", "time", "out", "checkpoint")]
    for day, items in (("09", [("a", "2024-01-08 09:10", 3, 1)]), ("10", [("b", "2024-01-08 09:20", 4, 1)])):
        _detail(spark, items).write.mode("append").parquet(dirs[0])
        for mark, d in zip(pick_time.end_mark(spark, dt.datetime(2024, 1, int(day))), dirs):
            mark.write.mode("append").parquet(d)
        df = pick_time.run_available(spark, *dirs[:2], products, *dirs[2:])
    # The first mark's own hour is closed by the second: it has no items to speak of and no worker's name.
    assert sorted((r.emailaddress, r.Quantity) for r in df.collect()) == [("", 0.0), ("a", 3.0)]
