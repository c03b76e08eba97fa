import datetime as dt
import pathlib

import pytest
from pyspark.sql import functions as F

from tickloom import schemas as S
from tickloom.operators import anomaly, reconcile
from tickloom.operators.bars import ohlcv
from tickloom.plans.daily_run import aggregate_range, run_day, run_range
from tickloom.plans.incremental import last_date, load_realtime, load_symbols, realtime_since
from tickloom.plans.marts import dim_symbols, fct_realtime_ohlcv
from tickloom.plans.staging import stg_ohlcv_1min, stg_trades
from tickloom.session import run_dir, shared_dir
from tickloom.sinks.tables import append_dates, drop_dates, replace_dates
from tickloom.sources.warehouse import Warehouse

DAY = 86_400


def dated(spark, *rows):
    return spark.createDataFrame([(s, dt.date(2024, 1, d), v) for s, d, v in rows], "symbol string, trade_date date, v int")


def contents(spark, path):
    return {(r.symbol, r.trade_date.day, r.v) for r in spark.read.parquet(path).collect()}


def test_only_touched_dates_are_replaced(spark):
    path = run_dir(spark, "dates") + "/t"
    replace_dates(dated(spark, ("A", 1, 1), ("A", 2, 1), ("B", 2, 1)), path)
    replace_dates(dated(spark, ("A", 2, 5), ("A", 3, 5)), path)
    assert contents(spark, path) == {("A", 1, 1), ("A", 2, 5), ("A", 3, 5)}
    append_dates(dated(spark, ("C", 1, 9)), path)
    assert ("C", 1, 9) in contents(spark, path) and ("A", 1, 1) in contents(spark, path)
    assert last_date(spark.read.parquet(path)) == dt.date(2024, 1, 3)
    assert last_date(None) is None


def test_shared_dir_follows_the_setting(spark):
    assert shared_dir(spark) == shared_dir(spark)

    class Cluster:
        class conf:
            get = staticmethod(lambda key, default: "hdfs://shared/cp/" if key == "spark.checkpoint.dir" else default)

    assert shared_dir(Cluster) == "hdfs://shared/cp"


def test_without_the_setting_the_warehouse_is_shared():
    class Cluster:
        class conf:
            get = staticmethod(lambda key, default=None: "hdfs://wh" if "warehouse" in key else default)

        class sparkContext:
            applicationId = "app-1"

    assert shared_dir(Cluster) == "hdfs://wh/_shared/app-1"


def test_warm_up_reaches_back_over_thin_days(trades_of):
    # one bar per day: the 50-bar mean of the last day needs 49 earlier days
    rows = [("A", float((i * 31) % 17), 10 + i, i * DAY) for i in range(80)] + [("GONE", 1.0, 1, 0)]
    bars = stg_ohlcv_1min(ohlcv(trades_of(rows), "1 minute")).drop("processed_at")
    since = dt.date(2024, 3, 15)
    part = realtime_since(bars, since)
    full = fct_realtime_ohlcv(bars).filter(F.col("trade_date") >= F.lit(since))
    assert part.count() > 3
    assert part.exceptAll(full).count() == full.exceptAll(part).count() == 0


def test_upsert_picks_up_late_bars_of_the_last_date(spark, trades_of):
    warehouse = Warehouse(spark, run_dir(spark, "upsert"))
    bars = stg_ohlcv_1min(ohlcv(trades_of([("A", float(i), 1, i * 3600 * 5) for i in range(10)]), "1 minute"))
    load_realtime(warehouse, bars.filter("window_start < '2024-01-02 12:00:00'"))
    load_realtime(warehouse, bars)
    table = warehouse.read("fct_realtime_ohlcv")
    assert table.count() == table.select("symbol", "window_start").distinct().count() == 10


def test_a_load_reads_its_own_and_the_warm_up_partitions_only(spark, trades_of):
    warehouse = Warehouse(spark, run_dir(spark, "log"))
    staged = stg_ohlcv_1min(ohlcv(trades_of([("A", float((i * 31) % 17), 10 + i, i * DAY) for i in range(80)]), "1 minute"))
    path = warehouse.path("bars")
    replace_dates(staged, path)
    bars = lambda: spark.read.schema(staged.schema).parquet(path)
    load_realtime(warehouse, bars().filter(F.col("trade_date") < F.lit(dt.date(2024, 3, 15))))
    # 49 days of warm-up before March 14, the newest loaded day, begin on January 25: older files are made unreadable
    spoiled = [f for d in range(1, 25) for f in pathlib.Path(path.removeprefix("file:")).glob(f"trade_date=2024-01-{d:02}/*.parquet")]
    assert len(spoiled) >= 20
    for file in spoiled:
        pathlib.Path(file.parent, f".{file.name}.crc").unlink(missing_ok=True)
        file.write_text("not parquet")
    load_realtime(warehouse, bars())
    full = fct_realtime_ohlcv(staged).drop("processed_at")
    loaded = warehouse.read("fct_realtime_ohlcv").select(*full.columns)
    assert loaded.count() == 80
    assert loaded.exceptAll(full).count() == full.exceptAll(loaded).count() == 0
    log = warehouse.read("fct_realtime_ohlcv_loads")
    assert log.count() == 80 and {r.n_rows for r in log.collect()} == {1}


def test_a_load_of_nothing_is_not_recorded(spark, trades_of):
    warehouse = Warehouse(spark, run_dir(spark, "nothing"))
    bars = stg_ohlcv_1min(ohlcv(trades_of([("A", 1.0, 1, 0)]), "1 minute"))
    load_realtime(warehouse, bars.limit(0))
    load_realtime(warehouse, bars)
    assert warehouse.read("fct_realtime_ohlcv").count() == warehouse.read("fct_realtime_ohlcv_loads").count() == 1


def filled_warehouse(spark, trades, streamed):
    warehouse = Warehouse(spark, run_dir(spark, "daily"))
    replace_dates(trades.drop("seq").withColumn("trade_date", F.to_date("event_time")), warehouse.path(S.RAW_TRADES))
    bars = ohlcv(streamed, "1 minute").withColumn("trade_date", F.to_date("window_start"))
    replace_dates(bars, warehouse.path("ohlcv_1min"))
    found = anomaly.with_anomaly_date(anomaly.anomalies(anomaly.score(trades)))
    replace_dates(found, warehouse.path("anomalies"), date_col="anomaly_date")
    return warehouse


def test_daily_run(spark, trades_of):
    trades = trades_of([("AB"[i % 2], 100.0 + (i * 7) % 11, 10, i * 600) for i in range(300)])
    warehouse = filled_warehouse(spark, trades, trades)
    assert run_day(warehouse, dt.date(2024, 1, 1)) == {"date": "2024-01-01", "rows": 2}
    assert run_day(warehouse, dt.date(2024, 1, 2)) == {"date": "2024-01-02", "rows": 2}
    assert warehouse.read("daily_summary_batch").count() == 4
    assert warehouse.read("dim_symbols").count() == 2
    log = warehouse.read("reconciliation_log").collect()
    assert [(r.status, r.symbols_checked) for r in log] == [("PASS", 2)] * 2
    warehouse.register(S.RAW_TRADES, "dim_symbols")
    assert spark.sql("select count(*) from dim_symbols").first()[0] == 2


def test_a_range_of_days_is_run_at_once_and_again(spark, trades_of):
    trades = trades_of([("AB"[i % 2], 100.0 + (i * 7) % 11, 10, (i % 3) * 2 * DAY + i * 60) for i in range(300)])
    warehouse = filled_warehouse(spark, trades, trades)
    first, last = dt.date(2024, 1, 1), dt.date(2024, 1, 5)
    wanted = [{"date": f"2024-01-0{d}", "rows": 2 * (d % 2)} for d in range(1, 6)]
    assert run_range(warehouse, first, last) == wanted
    kept = warehouse.read("daily_summary_batch").drop("computed_at").collect()
    log = warehouse.read("reconciliation_log").orderBy("reconciliation_date").collect()
    assert [(r.status, r.symbols_checked, r.discrepancy_count) for r in log] == [("PASS", 2 * (d % 2), 0) for d in range(1, 6)]
    assert aggregate_range(warehouse, first, last) == wanted
    assert sorted(warehouse.read("daily_summary_batch").drop("computed_at").collect()) == sorted(kept)
    drop_dates(spark, warehouse.path(S.RAW_TRADES), [dt.date(2024, 1, 3)])
    assert [r["rows"] for r in aggregate_range(warehouse, first, dt.date(2024, 1, 4))] == [2, 0, 0, 0]
    left = warehouse.read("daily_summary_batch").select("trade_date").distinct().collect()
    assert {r.trade_date for r in left} == {first, last}
    with pytest.raises(ValueError):
        run_range(warehouse, last, first)


def test_a_range_before_any_trade_writes_nothing(spark, trades_of):
    trades = trades_of([("A", 1.0, 1, 0)])
    warehouse = filled_warehouse(spark, trades, trades)
    assert aggregate_range(warehouse, dt.date(2023, 1, 1), dt.date(2023, 1, 1)) == [{"date": "2023-01-01", "rows": 0}]
    assert aggregate_range(warehouse, dt.date(2024, 1, 1), dt.date(2024, 1, 1)) == [{"date": "2024-01-01", "rows": 1}]


def test_daily_run_stops_on_a_severe_discrepancy(spark, trades_of):
    trades = trades_of([("AB"[i % 2], 100.0, 10, i * 60) for i in range(60)])
    warehouse = filled_warehouse(spark, trades, trades.filter("symbol = 'A'"))
    with pytest.raises(reconcile.ReconciliationFailed, match="1 high-severity"):
        run_day(warehouse, dt.date(2024, 1, 1))
    assert warehouse.read("reconciliation_log").first().status == "FAIL"


def test_symbol_dimension_takes_in_late_trades_and_corrections(spark, trades_of):
    trades = trades_of([("AB"[i % 2], float(i), i, i * 3600 * 7) for i in range(20)])
    no_anomalies = spark.createDataFrame([], "symbol string, severity string")
    warehouse = Warehouse(spark, run_dir(spark, "symbols"))
    load_symbols(warehouse, trades, no_anomalies)
    # a correction and a late trade of an old day, an undated trade, and a new symbol
    later = trades.agg(F.max("loaded_at").alias("t")).first().t
    extra = trades_of([("A", 50.0, 7, 0), ("B", 9.0, 1, 3600), ("A", 3.0, 5, 1), ("C", 4.0, 1, 900000)])
    extra = extra.withColumns(
        {
            "loaded_at": F.lit(later) + F.expr("interval 1 hour"),
            "event_time": F.when(F.col("seq") != 2, F.col("event_time")),
        }
    )
    everything = trades.unionByName(extra)
    load_symbols(warehouse, everything, no_anomalies)
    incremental = warehouse.read("dim_symbols")
    whole = dim_symbols(stg_trades(everything), no_anomalies)
    assert incremental.count() == 3
    assert incremental.exceptAll(whole).count() == whole.exceptAll(incremental).count() == 0
