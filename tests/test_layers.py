import datetime as dt

from pyspark.sql import functions as F

from stormmart.plans.layers import clean, stage, yearly_damage, yearly_totals

T1 = dt.datetime(2024, 1, 1)
T2 = dt.datetime(2024, 2, 1)


def _raw(spark):
    rows = [("h1", "TEXAS", 195004, "10K", "1K", T1, "a.csv.gz"),
            ("h1", "TEXAS", 195004, "10K", "1K", T2, "b.csv.gz"),      # same content, later load
            ("h1", "TEXAS", 195004, "10K", "1K", T2, "b.csv.gz"),      # exact duplicate line
            ("h2", "OHIO", 195105, "2.5M", None, T1, "a.csv.gz")]
    return spark.createDataFrame(
        rows, "__row_hash string, state string, begin_yearmonth int, damage_property string, "
              "damage_crops string, __date_loaded timestamp_ntz, __filename string")


def test_staging_keeps_a_reload_but_drops_exact_copies(spark):
    staged = stage(_raw(spark))
    assert staged.count() == 3
    assert staged.filter(F.col("__row_hash") == "h1").count() == 2


def test_clean_takes_first_load_and_incremental_run(spark):
    raw = _raw(spark)
    first = {r["__row_hash"]: r["__filename"] for r in clean(raw).collect()}
    assert first == {"h1": "a.csv.gz", "h2": "a.csv.gz"}
    target = raw.filter(F.col("__date_loaded") == T1)
    later = clean(raw, target).collect()
    assert [(r["__row_hash"], r["__date_loaded"]) for r in later] == [("h1", T2)]


def test_mart_totals_property_and_crops(spark):
    rows = clean(_raw(spark))
    dmg = {(r.event_year, r.state): r.total_property_damage for r in yearly_damage(rows).collect()}
    assert dmg == {("1950", "TEXAS"): 10000.0, ("1951", "OHIO"): 2500000.0}
    both = {(r.event_year, r.state): (r.total_property_damage, r.total_crop_damage)
            for r in yearly_totals(rows).collect()}
    assert both == {("1950", "TEXAS"): (10000.0, 1000.0), ("1951", "OHIO"): (2500000.0, 0.0)}
