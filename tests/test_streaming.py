"""K1 / K2 semantics on a file stream: restart resumes from the checkpoint, rows older
than the watermark are dropped, a replayed event id is counted once."""

import datetime as dt
import os

from adspark.streaming.counters import current_counters, run_campaign_day, events_file_stream

SCHEMA = "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string"


def _events(spark, rows, path):
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.parquet(path)


def test_restart_late_rows_and_replay(spark, tmp_dir):
    src = os.path.join(tmp_dir, "in")
    out, ckpt = os.path.join(tmp_dir, "out"), os.path.join(tmp_dir, "ckpt")
    lookup = spark.createDataFrame([("Campaign_1", 1), ("Campaign_2", 2)], "campaign_name string, campaign_id int")
    d10 = dt.datetime(2024, 1, 10, 10, 0)
    _events(spark, [(1, d10, 7, "view", 1.0, '{"k": 0}'), (2, d10, 7, "click", 1.0, '{"k": 0}'),
                    (3, d10, 8, "view", 1.0, '{"k": 1}')], os.path.join(src, "events_1.parquet"))
    run_campaign_day(spark, events_file_stream(spark, src), lookup, out, ckpt).awaitTermination()
    first = {(r["campaign_id"], str(r["date"])): (r["impressions"], r["clicks"])
             for r in current_counters(spark, out).collect()}
    assert first == {(1, "2024-01-10"): (2, 1), (2, "2024-01-10"): (1, 0)}

    late = dt.datetime(2024, 1, 1, 9, 0)  # far behind the 1-day watermark
    _events(spark, [(2, d10, 7, "click", 1.0, '{"k": 0}'),        # replay of event 2
                    (4, late, 7, "view", 1.0, '{"k": 0}'),        # late row
                    (5, d10 + dt.timedelta(hours=1), 9, "view", 1.0, '{"k": 0}')],
            os.path.join(src, "events_2.parquet"))
    run_campaign_day(spark, events_file_stream(spark, src), lookup, out, ckpt).awaitTermination()
    final = {(r["campaign_id"], str(r["date"])): (r["impressions"], r["clicks"])
             for r in current_counters(spark, out).collect()}
    assert final == {(1, "2024-01-10"): (3, 1), (2, "2024-01-10"): (1, 0)}


def test_no_row_is_lost_and_a_dying_batch_counts_once(spark, tmp_dir, monkeypatch):
    """Late rows go to the late log, replays count once, and a batch that dies after its counts or
    before them ends in the same state."""
    from adspark.sources import versions
    from adspark.streaming.counters import read_counters, read_late, run_counted
    src, root = os.path.join(tmp_dir, "in"), os.path.join(tmp_dir, "run")
    lookup = spark.createDataFrame([("Campaign_1", 1), ("Campaign_2", 2)], "campaign_name string, campaign_id int")
    at = lambda day, hour=10: dt.datetime(2024, 1, day, hour)
    run = lambda: run_counted(spark, events_file_stream(spark, src, 100), lookup, root).awaitTermination()
    _events(spark, [(1, at(10), 7, "view", 1.0, '{"k": 0}'), (2, at(10), 7, "click", 1.0, '{"k": 0}'), (2, at(10), 7, "click", 1.0, '{"k": 0}'),
                    (3, at(8), 8, "view", 1.0, '{"k": 1}')], os.path.join(src, "events_1.parquet"))  # 3 is in the first batch: no mark yet
    run()
    _events(spark, [(2, at(10), 7, "click", 1.0, '{"k": 0}'), (4, at(1), 7, "view", 1.0, '{"k": 0}'), (5, at(9, 10), 9, "view", 1.0, '{"k": 0}'),
                    (6, at(9, 9), 9, "view", 1.0, '{"k": 0}'), (7, None, 9, "view", 1.0, '{"k": 0}'), (8, at(12), 9, "view", 1.0, '{"k": 1}')],
            os.path.join(src, "events_2.parquet"))
    real, calls = versions.commit, []

    def dies(spark_, where, content, after):
        calls.append(where)
        if len(calls) == deadly:
            raise RuntimeError("killed")
        return real(spark_, where, content, after)

    for deadly in (1, 2):  # before the counts are in, then after them
        calls.clear()
        with monkeypatch.context() as m:
            m.setattr(versions, "commit", dies)
            try:
                run()
                raise AssertionError("the batch must die")
            except Exception as exc:
                assert "killed" in str(exc)
    run()
    counts = {(r["campaign_id"], str(r["date"])): (r["impressions"], r["clicks"]) for r in read_counters(spark, root).collect()}
    assert counts == {(1, "2024-01-10"): (2, 1), (2, "2024-01-08"): (1, 0), (1, "2024-01-09"): (1, 0), (2, "2024-01-12"): (1, 0)}
    assert sorted(r["event_id"] for r in read_late(spark, root).collect()) == ["4", "6", "7"]
    _events(spark, [(8, at(12), 9, "view", 1.0, '{"k": 1}'), (9, at(11, 10), 9, "view", 1.0, '{"k": 1}'), (5, at(9, 10), 9, "view", 1.0, '{"k": 0}')],
            os.path.join(src, "events_3.parquet"))
    run()
    assert {(r["campaign_id"], str(r["date"])): r["impressions"] for r in read_counters(spark, root).collect()}[2, "2024-01-11"] == 1
    assert sorted(r["event_id"] for r in read_late(spark, root).collect()) == ["4", "5", "6", "7"]
    _, state = versions.newest(spark, root + "/state")
    assert state["batch"] == 2 and len(state["seen"]) <= 3
