import random

import pytest
from pyspark.sql import functions as F
from test_streams import message

from tickloom.operators import anomaly, rolling
from tickloom.session import delete_folder, list_folders, run_dir
from tickloom.sources import messages
from tickloom.streaming.anomaly_stream import RollingDetector


def table(spark, texts):
    return messages.decode_trades(spark.createDataFrame([(t,) for t in texts], "value string"))


def trades_of(symbols, start, n, seed=1):
    rng = random.Random(seed + start)
    return [message(rng.choice(symbols), round(rng.expovariate(0.02), 2), rng.randrange(10**6), start + i) for i in range(n)]


def events(spark, path, *extra):
    rows = spark.read.parquet(path).drop("detected_at", "batch_id", *extra).collect()
    return sorted(map(str, rows))


def test_a_batch_rewrites_only_the_symbols_it_touches(spark):
    folder = run_dir(spark, "touched")
    detector = RollingDetector(f"{folder}/out", f"{folder}/state", lookback=20, chunk_rows=100)
    symbols = [f"S{i}" for i in range(400)]
    first = [message(s, float(i + k), 1, 20 * i + k) for i, s in enumerate(symbols) for k in range(20)]
    detector(table(spark, first), 0)
    assert spark.read.parquet(detector._slot(0)).count() == 8000
    touched = ["S7", "S8", "S9", "S200"]
    detector(table(spark, [message(s, 5.0, 1, 10_000 + i) for i, s in enumerate(touched)]), 1)
    written = spark.read.parquet(detector._slot(1))
    assert written.count() == 4 * 20  # 1 % of the state
    assert {r.symbol for r in written.select("symbol").distinct().collect()} == set(touched)
    live = detector.state.live(spark, 1)
    assert sum(len(v) for v in live.values()) <= len(detector.state.live(spark, 0)) + 4
    whole = detector.state.read(spark, live, range(detector.state.buckets))
    assert whole.count() == 8000
    assert whole.where("symbol = 'S7'").agg(F.max(rolling.POSITION), F.min(rolling.POSITION)).first() == (21, 2)


def test_versions_and_folders_stay_bounded_and_results_equal_the_batch_form(spark):
    folder = run_dir(spark, "bounded")
    options = dict(threshold=1.5, lookback=30, chunk_rows=100, buckets=4, versions=2, merged_batches=2)
    detector = RollingDetector(f"{folder}/out", f"{folder}/state", **options)
    texts = []
    for n in range(6):
        part = trades_of(["A", "B", "C", "D"] if n % 2 else ["A", "B"], 1000 * n, 40)
        texts += part
        detector(table(spark, part), n)
        assert all(len(v) <= 2 for v in detector.state.live(spark, n).values())
    # of 6 batches: a folder of four, one of two, for the one day there is
    assert len(list_folders(spark, f"{folder}/out/anomaly_date=*/batch_id=*")) <= 3
    assert list_folders(spark, f"{folder}/out/_merged/*") == []
    assert len(list_folders(spark, f"{folder}/state/commits/*")) <= 2
    assert len(list_folders(spark, f"{folder}/state/data/*/*")) <= 4 * 4
    whole = anomaly.anomalies(anomaly.score(table(spark, texts), lookback=30, chunk_rows=100), 1.5)
    expected = sorted(map(str, whole.drop("detected_at").collect()))
    assert len(expected) > 10 and events(spark, f"{folder}/out", "anomaly_date") == expected


@pytest.mark.parametrize("at", [1, 2])
def test_a_batch_retried_at_any_point_gives_the_same_rows(spark, monkeypatch, at):
    """Batches fail after their events, or in the middle of a merge, and run again."""
    folder = run_dir(spark, "retried")
    options = dict(threshold=1.5, lookback=30, chunk_rows=100, buckets=4, versions=2, merged_batches=2)
    detector = RollingDetector(f"{folder}/out", f"{folder}/state", **options)
    texts = []
    for n in range(4):
        part = trades_of(["A", "B", "C"], 1000 * n, 40, seed=5)
        texts += part
        if n == at:
            import tickloom.streaming.anomaly_stream as module

            def fail(*args, **kwargs):
                raise OSError("lost")

            with monkeypatch.context() as patch:
                patch.setattr(module, "move_folder", fail) if n % 2 == 0 else patch.setattr(detector.state, "write", fail)
                with pytest.raises(OSError, match="lost"):
                    detector(table(spark, part), n)
        detector(table(spark, part), n)
        detector(table(spark, part), n)
    whole = anomaly.anomalies(anomaly.score(table(spark, texts), lookback=30, chunk_rows=100), 1.5)
    assert events(spark, f"{folder}/out", "anomaly_date") == sorted(map(str, whole.drop("detected_at").collect()))


def test_an_empty_batch_keeps_the_state(spark):
    folder = run_dir(spark, "empty")
    detector = RollingDetector(f"{folder}/out", f"{folder}/state")
    detector(table(spark, trades_of(["A"], 0, 10)), 0)
    state = detector.state
    before = state.live(spark, 0)
    detector(table(spark, ["{bad"]), 1)
    detector(table(spark, []), 2)
    assert state.read(spark, state.live(spark, 2), range(state.buckets)).count() == 10
    assert state.live(spark, 2) == before


def test_a_lost_commit_is_noticed(spark):
    folder = run_dir(spark, "lost")
    detector = RollingDetector(f"{folder}/out", f"{folder}/state")
    detector(table(spark, trades_of(["A"], 0, 3)), 0)
    delete_folder(spark, f"{folder}/state/commits/batch=0")
    with pytest.raises(RuntimeError, match="does not belong"):
        detector(table(spark, trades_of(["A"], 10, 3)), 1)
