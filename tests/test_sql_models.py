from pyspark.sql import functions as F

from stormmart.plans import registry as R
from stormmart.plans.layers import clean, stage, yearly_damage
from stormmart.plans.sql_models import clean_sql, create_staging_view, mart_sql
from stormmart.sources.tables import parquet_table
from tests.conftest import SF_SMALL


def _same(a, b):
    assert sorted(a.columns) == sorted(b.columns)
    cols = sorted(a.columns)
    assert sorted(map(tuple, a.select(cols).collect())) == sorted(map(tuple, b.select(cols).collect()))


def test_mart_sql_equals_dataframe_mart(spark):
    rows = R.orders_as_damage_rows(parquet_table(spark, SF_SMALL, "orders"))
    rows.createOrReplaceTempView("sqlm_damage_rows")
    _same(spark.sql(mart_sql("sqlm_damage_rows")), yearly_damage(rows))


def test_mart_sql_edge_texts(spark):
    texts = ["250K", "2.5M", "K", "0", "", None, "10", "3t", "1.5KK", "-5k", "1d"]
    df = spark.createDataFrame([("S", 195004, t) for t in texts], "state string, begin_yearmonth int, damage_property string")
    df.createOrReplaceTempView("sqlm_edges")
    _same(spark.sql(mart_sql("sqlm_edges")), yearly_damage(df))


def test_staging_and_clean_sql_equal_dataframe_models(spark):
    raw = R.orders_two_loads(parquet_table(spark, SF_SMALL, "orders"))
    raw.createOrReplaceTempView("sqlm_raw")
    staged = create_staging_view(spark, "sqlm_raw", "sqlm_stg")
    _same(staged, stage(raw))
    first = spark.sql(clean_sql(spark, "sqlm_stg", key="o_orderkey"))
    _same(first, clean(raw, None, key="o_orderkey"))
    raw.filter(F.col("__filename") == R.FIRST_FILE).createOrReplaceTempView("sqlm_target")
    later = spark.sql(clean_sql(spark, "sqlm_stg", "sqlm_target", key="o_orderkey"))
    _same(later, clean(raw, spark.table("sqlm_target"), key="o_orderkey"))


def test_catalog_staging_view(spark):
    import uuid
    db = "stg_" + uuid.uuid4().hex[:8]
    spark.sql(f"CREATE DATABASE {db}")
    df = spark.createDataFrame([(1, "a"), (1, "a"), (2, "b")], "k int, v string")
    df.write.saveAsTable(f"{db}.raw")
    view = create_staging_view(spark, f"{db}.raw", f"{db}.stg", temporary=False)
    assert view.count() == 2
    assert f"{db}.stg".split(".")[1] in [t.name for t in spark.catalog.listTables(db)]
