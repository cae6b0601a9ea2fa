"""What a stream reads beside its events."""

from adspark.plans import catalog, loads

SF = "/root/testdata/sf0.001"


def test_the_stream_loads_no_warehouse(spark, monkeypatch):
    want = sorted(map(tuple, catalog.warehouse(spark, SF)["campaign_day"].collect()))

    def none(*_):
        raise AssertionError("the stream needs the campaigns alone")

    monkeypatch.setattr(loads, "warehouse", none)
    got = loads.stream_campaign_day(spark, SF).select("campaign_id", "date", "impressions", "clicks")
    assert sorted(map(tuple, got.collect())) == want
