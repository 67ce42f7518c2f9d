"""All reports from one pass equal the reports by themselves."""

import random
from decimal import Decimal

from pyspark.sql import functions as F

from landmart.plans import quality
from tests.test_plans import plan

OWNERS = "owner_name string, parcel_id string, is_real_property boolean, pct_own decimal(10,3), account_type string, file_index string"


def rows(spark, seed):
    rng = random.Random(seed)
    owners = [
        (rng.choice(["ANN", "BOB", None]), f"P{rng.randrange(12)}", rng.random() < 0.7, rng.choice([None, "0.500", "0.750"]), rng.choice(["A", "B", None]),
         rng.choice(["20210525", "20210526"])) for _ in range(120)]
    owners += [("ANN", "HOT", True, "0.001", "A", "20210525")] * 200
    features = [(f"P{rng.randrange(3, 16)}", rng.choice(["20210525", "20210526"]), rng.random() < 0.8) for _ in range(60)]
    made = spark.createDataFrame([(*r[:3], None if r[3] is None else Decimal(r[3]), *r[4:]) for r in owners], OWNERS)
    return made, spark.createDataFrame(features, "parcel_id string, file_index string, drawn boolean")


def named(df):
    return sorted((r.file_index, r.parcel_id) for r in df.select("file_index", "parcel_id").collect())


def test_reports_of_the_profile(spark):
    for seed in range(3):
        owners, features = rows(spark, seed)
        profile = quality.parcel_profile(owners, features, F.col("drawn")).cache()
        of = lambda name: named(profile.filter(quality.REPORTS[name]))  # noqa: B023,E731
        assert of("multi_feature") == named(quality.multi_feature_parcels(features))
        assert of("unknown") == named(quality.unknown_parcels(owners, features))
        assert of("unowned") == named(quality.unowned_parcels(owners, features))
        assert of("overallocated") == named(quality.overallocated_parcels(owners))
        assert of("multi_type") == named(quality.multi_type_parcels(owners))
        assert of("no_geometry") == sorted({(r.file_index, r.parcel_id) for r in features.filter("NOT drawn").collect()})
        sizes = {(r.file_index, r.report): r.parcels for r in quality.report_sizes(profile).collect()}
        assert sum(sizes.values()) == sum(len(of(name)) for name in quality.REPORTS)
        profile.unpersist()


def test_each_table_is_scanned_once(spark, tmp_path):
    for name, df in zip(("owners", "features"), rows(spark, 1)):
        df.write.parquet(str(tmp_path / name))
    owners, features = (spark.read.parquet(str(tmp_path / x)) for x in ("owners", "features"))
    text = plan(quality.report_sizes(quality.parcel_profile(owners, features, F.col("drawn"))))
    assert text.count("FileScan") == 2 and "Expand" not in text
