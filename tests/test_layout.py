import pytest
from pyspark import StorageLevel
from pyspark.sql import functions as F

from tests.conftest import plan_of
from tillroll.checks.views import retail_lines
from tillroll.operators import layout
from tillroll.operators.clean import clean_lines
from tillroll.sources.staging import staged
from tillroll.plans.retail import country_revenue, monthly_revenue


def answers(lines):
    return country_revenue(lines).collect(), monthly_revenue(lines).collect()


def test_no_layout_changes_an_answer(spark, sf_dir):
    clean = retail_lines(spark, sf_dir).transform(clean_lines)
    plain = answers(clean)
    layouts = [
        layout.partition_by_key(clean, "country", 12),
        layout.cluster_by(clean, "country"),
        layout.spread_evenly(clean, 7),
    ]
    for laid_out in layouts:
        assert answers(laid_out) == plain
        with layout.persisted(laid_out, layout.QUERY_COLUMNS) as cached:
            assert layout.materialize(cached) == clean.count()
            assert answers(cached) == plain


def test_cache_is_pruned_used_and_freed(spark, sf_dir):
    clean = retail_lines(spark, sf_dir).transform(clean_lines)
    with layout.persisted(clean, layout.QUERY_COLUMNS) as cached:
        assert cached.columns == layout.QUERY_COLUMNS
        assert cached.storageLevel == StorageLevel.MEMORY_AND_DISK
        assert "InMemoryTableScan" in plan_of(country_revenue(cached))
    assert cached.storageLevel == StorageLevel.NONE


def test_cache_is_freed_after_an_error(spark):
    df = spark.range(3)
    with pytest.raises(ValueError):
        with layout.persisted(df):
            raise ValueError
    assert df.storageLevel == StorageLevel.NONE


def test_keyed_cache_needs_no_exchange_for_its_key(spark, sf_dir):
    clean = retail_lines(spark, sf_dir).transform(clean_lines)
    with layout.persisted(layout.partition_by_key(clean, "country", 12)) as cached:
        layout.materialize(cached)
        query = country_revenue(cached)
        query.collect()
        above = plan_of(query).split("InMemoryTableScan")[0]
        assert "Exchange" not in above


@pytest.fixture
def hot_lines(spark):
    """One country holds nine tenths of the rows."""
    hot = F.col("id") % 10 > 0
    return spark.range(0, 200_000, 1, 8).select(
        F.when(hot, "hot").otherwise(F.concat(F.lit("c"), F.col("id") % 7)).alias("country"),
        F.lit("s").alias("source_sheet"),
        F.lit(None).cast("timestamp").alias("invoice_ts"),
        (F.xxhash64("id") % 10_000 / 4).alias("revenue"),
    )


def hot_shares(df):
    """Rows of the hot country per partition."""
    per_partition = df.filter("country = 'hot'").groupBy(F.spark_partition_id()).count()
    return sorted(r["count"] for r in per_partition.collect())


def test_written_clusters_cut_the_hot_country(spark, settings, hot_lines):
    settings(spark__sql__adaptive__advisoryPartitionSizeInBytes="64KB")
    clustered = staged(layout.cluster_by(hot_lines, "country"), "clustered")
    files = clustered.filter("country = 'hot'").select("_metadata.file_path").distinct()
    assert files.count() > 2
    assert clustered.count() == 200_000
    assert answers(clustered) == answers(hot_lines)


def test_even_cache_spreads_the_hot_country_and_a_keyed_one_does_not(spark, hot_lines):
    with layout.persisted(layout.spread_evenly(hot_lines, 4)) as even:
        shares = hot_shares(even)
        assert len(shares) == 4 and max(shares) < 1.1 * min(shares)
    with layout.persisted(layout.partition_by_key(hot_lines, "country", 4)) as keyed:
        assert hot_shares(keyed) == [180_000]
