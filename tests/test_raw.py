"""The raw folder as a stage, and split documents."""

import json
import time
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tickforge.operators import splits, training
from tickforge.plans import raw
from tickforge.sources import readers, sinks

QUOTE = "Date,Time,BO,BH,BL,BC,BCh,AO,AH,AL,AC,ACh"


def folder(path):
    path.mkdir()
    put = lambda name, *lines: (path / name).write_text("\n".join(lines) + "\n")
    put("eurusd_h1_cleaned.csv", "time,open,high,low,close,tick_volume", "2020-01-01 00:00:00,1,2,0.5,1.5,7", "2020-01-01 01:00:00,1,0.5,2,1.5,7", "2020-01-01 02:00:00,1,2,0.5,1.25,x", "2020-01-01 02:00:00,1,2,0.5,1.75,1", "2020-01-01 00:00:00,1,2,0.5,1.5,7", "never,1,2,0.5,1.5,7")
    put("eurusd_m1.csv", "time,open,high,low,close,tick_volume", "2020-01-01 00:00:00,3,4,2.5,3.5,7")
    put("GBPUSD.csv", '"timestamp","open","high","low","close"', '2020-02-01 00:00:00,1,2,0.5,1.5')
    put("usdjpy quotes.csv", QUOTE, "2020-03-01,00:00:00,1,2,0.5,1.5,,1.1,2.1,0.6,1.6,0.1", "2020-03-01,00:01:00,1,2,0.5,1.5,0.2,1.1,2.1,0.6,1.4,0.1")
    put("EURUSD_backup.csv", "time,open,high,low,close", "2020-01-01 00:00:00,9,9,9,9")
    put("USDJPY_broken.csv", "a,b,c", "1,2,3")
    put("unknown.csv", "time,open,high,low,close", "2020-01-01 00:00:00,9,9,9,9")
    put("eurusd_twice.csv", "time,open,open,high,low,close", "2020-01-01 00:00:00,9,9,9,9,9")
    (path / "gbpusd_empty.csv").write_text("")
    (path / "notes.txt").write_text("x")
    return path


def lines(df):
    return {r.name: r for r in df.collect()}


def test_folder(spark, tmp_path):
    src, out = folder(tmp_path / "in"), str(tmp_path / "out")
    got = lines(raw.normalize_folder(spark, str(src), out))
    assert {k: (r.status, r.format, r.symbol, r.output, r.rows_in, r.rows_out) for k, r in got.items() if r.status == "done"} == {
        "eurusd_h1_cleaned.csv": ("done", "ohlc", "EURUSD", "eurusd_h1", 6, 2), "eurusd_m1.csv": ("done", "ohlc", "EURUSD", "eurusd_m1", 1, 1),
        "GBPUSD.csv": ("done", "ohlc", "GBPUSD", "GBPUSD", 1, 1), "usdjpy quotes.csv": ("done", "bidask", "USDJPY", "usdjpy quotes", 2, 1),
    }
    assert {k: r.error.split(" ")[0] for k, r in got.items() if r.status == "failed"} == {"USDJPY_broken.csv": "unknown", "unknown.csv": "no", "eurusd_twice.csv": "a", "gbpusd_empty.csv": "the"}
    bars = spark.read.parquet(f"{out}/ohlc")
    assert [(r.symbol, r.close, r.tick_volume) for r in bars.where("output = 'eurusd_h1'").orderBy("timestamp").collect()] == [("EURUSD", 1.5, 7.0), ("EURUSD", 1.25, 0.0)]
    quote = spark.read.parquet(f"{out}/bidask").first()
    assert (quote.bid_change, quote.ask_change, round(quote.mid_close, 6)) == (0.0, 0.1, 1.55)
    ratio = raw.normalization_ratio(raw.read_manifest(spark, out)).first()
    assert (ratio.done, ratio.failed, ratio.rows_in, ratio.rows_out) == (4, 4, 10, 5) and ratio.retention == 0.5
    # A second run: only what failed, is new or has changed.
    time.sleep(1.1)
    (src / "eurusd_m1.csv").write_text("time,open,high,low,close,tick_volume\n2021-01-01 00:00:00,3,4,2.5,3.75,7\n2021-01-02 00:00:00,3,4,2.5,3.75,7\n")
    (src / "USDJPY_new.csv").write_text("date,open,high,low,close\n2021-01-01,3,4,2.5,3.5\n")
    again = lines(raw.normalize_folder(spark, str(src), out))
    assert {k for k, r in again.items() if r.status == "done"} == {"eurusd_m1.csv", "USDJPY_new.csv"} and len(again) == 6
    bars = spark.read.parquet(f"{out}/ohlc")
    assert bars.where("output = 'eurusd_m1'").count() == 2 and bars.where("output = 'eurusd_h1'").count() == 2 and bars.where("output = 'USDJPY_new'").count() == 1
    assert not [r for r in raw.normalize_folder(spark, str(src), out).collect() if r.status == "done"]
    assert len([r for r in raw.normalize_folder(spark, str(src), out, force=True).collect() if r.status == "done"]) == 5


def test_split_documents(spark, tmp_path):
    at = lambda d: datetime(2020, 1, 1) + timedelta(days=d)
    df = spark.createDataFrame([(at(d), s) for s in ("EURUSD", "GBPUSD") for d in range(12)], "timestamp timestamp_ntz, symbol string")
    windows = spark.createDataFrame([(0, at(0), at(5), at(5), at(8)), (1, at(4), at(9), at(9), at(12))], "split_id int, train_start timestamp_ntz, train_end timestamp_ntz, val_start timestamp_ntz, val_end timestamp_ntz")
    assigned = splits.assign(df, windows)
    want = sorted(map(tuple, assigned.select("split_id", "symbol", "role", "row_idx").collect()))
    assert len(want) == 32
    hand = [{"split_id": k, "metadata": {"train_start": at(a).isoformat(), "symbols": ["EURUSD", "GBPUSD"]}, "splits": {s: {"train_indices": list(range(a, b)), "val_indices": list(range(b, c)), "train_samples": b - a, "val_samples": c - b} for s in ("EURUSD", "GBPUSD")}} for k, a, b, c in ((0, 0, 5, 8), (1, 4, 9, 12))]
    (tmp_path / "hand_splits.json").write_text(json.dumps(hand, indent=2))
    assert readers.find_splits(str(tmp_path)).endswith("/hand_splits.json")
    for form in ("nested", "indices"):
        sinks.write_splits(assigned, str(tmp_path / form / "x_splits.json"), form)
        assert sorted(map(tuple, readers.read_splits(spark, readers.find_splits(str(tmp_path / form))).collect())) == want
    assert sorted(map(tuple, readers.read_splits(spark, str(tmp_path / "hand_splits.json")).collect())) == want
    one = readers.read_split_document(spark, str(tmp_path / "nested" / "x_splits.json")).where("split_id = 1").first()
    assert one.metadata.train_start == "2020-01-05T00:00:00" and one.metadata.symbols == ["EURUSD", "GBPUSD"] and one.splits["GBPUSD"].val_date_range.end == "2020-01-12T00:00:00"
    assert sinks.split_document(assigned, windows, 2.0).where("split_id = 0").first().metadata.val_end == "2020-01-09T00:00:00"
    with pytest.raises(FileNotFoundError):
        readers.find_splits(str(tmp_path / "nested" / "x_splits.json"))


def test_fold_auc_without_a_class(spark):
    rows = [(0, "val", y, [0.2, 0.3, 0.5]) for y in (0, 1, 2)] + [(1, "val", 1, [0.2, 0.3, 0.5])] * 2
    got = {r.split_id: r for r in training.fold_auc(spark.createDataFrame(rows, "split_id int, role string, y int, proba array<double>")).collect()}
    assert got[0].roc_auc_ovr == 0.5 and abs(got[0].log_loss - 1.169) < 1e-3 and (got[1].roc_auc_ovr, got[1].log_loss) == (0.0, float("inf"))
