import pytest

from tarifa.session import clean, shared_dir, written


def test_written_tables_are_kept_until_cleaned(spark):
    df = written(spark.range(5), "x")
    assert df.count() == 5 and shared_dir(spark) in df.inputFiles()[0]
    assert clean(spark) >= 1 and clean(spark) == 0


def test_an_empty_table_is_written_too(spark):
    df = written(spark.range(0), "x")
    assert df.count() == 0 and df.columns == ["id"]
    clean(spark)


def test_a_cluster_needs_a_shared_folder():
    class Cluster:
        conf = {}
        sparkContext = type("Context", (), {"master": "spark://host:7077"})

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_dir(Cluster)
