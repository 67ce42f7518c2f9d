"""The raw tables as views over the given tables, in Spark and as SQL common table expressions.

lineitem rows play ownership rows and parcel features: the ship month is the snapshot, the part
the parcel, the supplier the owner, the discount the stake, the quantity the feature's area.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from landmart.functions.attributes import stake

# part type -> account type
ACCOUNT_TYPES = {
    "ECONOMY": "RESIDENTIAL",
    "SMALL": "APARTMENT",
    "MEDIUM": "MIXED USE",
    "PROMO": "COMMERCIAL",
    "LARGE": "NATURAL RESRC",
    "STANDARD": "EXEMPT",
}
SNAPSHOT = "19980301"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def month_id(moment: Column) -> Column:
    """First day of the month as yyyyMMdd, by arithmetic: cheaper than formatting every row."""
    day = moment.cast("date")
    return (F.year(day) * 10000 + F.month(day) * 100 + 1).cast("string")


def account_type(p_type: Column) -> Column:
    kind = F.lit(None).cast("string")
    for source, target in ACCOUNT_TYPES.items():
        kind = F.when(p_type == source, target).otherwise(kind)
    return kind


def owners(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem")
    suppliers = table(spark, sf_dir, "supplier").select("s_suppkey", "s_name")
    parts = table(spark, sf_dir, "part").select("p_partkey", "p_type")
    return (
        lines.join(suppliers, lines.l_suppkey == suppliers.s_suppkey)
        .join(parts, lines.l_partkey == parts.p_partkey)
        .select(
            F.col("l_orderkey").cast("string").alias("account_id"),
            F.col("l_partkey").cast("string").alias("parcel_id"),
            (F.col("l_linestatus") == "F").alias("is_real_property"),
            F.col("s_name").alias("owner_name"),
            stake(F.col("l_discount")).alias("pct_own"),
            account_type(F.col("p_type")).alias("account_type"),
            month_id(F.col("l_shipdate")).alias("file_index"),
        )
    )


def parcels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_partkey").cast("string").alias("parcel_id"),
        F.col("l_quantity").cast("decimal(12,2)").alias("area_m2"),
        month_id(F.col("l_shipdate")).alias("file_index"),
    )


def parcel_shapes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every part as WKT: a square, with a hole for even sizes and a second square for sizes by 5."""
    parts = table(spark, sf_dir, "part")
    x = F.lit(-105.5) + (F.col("p_partkey") % 100) * F.lit(0.01)
    y = F.lit(39.9) + F.floor(F.col("p_partkey") / 100) % 10000 * F.lit(0.002)
    side = F.col("p_size") * F.lit(0.0001)

    def ring(dx: Column, dy: Column, width: Column) -> Column:
        corners = [(dx, dy), (dx + width, dy), (dx + width, dy + width), (dx, dy + width), (dx, dy)]
        points = [F.concat_ws(" ", cx.cast("string"), cy.cast("string")) for cx, cy in corners]
        return F.concat(F.lit("("), F.concat_ws(", ", *points), F.lit(")"))

    shell = ring(x, y, side)
    hole = ring(x + side / 4, y + side / 4, side / 2)
    island = ring(x, y + F.lit(0.2), side / 2)
    with_hole = F.concat(F.lit("("), shell, F.lit(", "), hole, F.lit(")"))
    body = F.when(F.col("p_size") % 2 == 0, with_hole).otherwise(F.concat(F.lit("("), shell, F.lit(")")))
    wkt = F.when(
        F.col("p_size") % 5 == 0, F.concat(F.lit("MULTIPOLYGON ("), body, F.lit(", ("), island, F.lit("))"))
    ).otherwise(F.concat(F.lit("POLYGON "), body))
    return parts.select(F.col("p_partkey").cast("string").alias("parcel_id"), wkt.alias("wkt"))


def parcel_wkb(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every part as WKB in whole degrees: a square, with a hole for even sizes and a second square for sizes by 5. Parts of
    type MEDIUM have their big end first."""
    # every number is made once, step by step in columns of its own
    corners = {"x": (0, 4, 1, 3, 2), "y": (0, 4, 1, 3, 50, 52)}
    names = {f"{axis}{d}": F.col(axis) + d for axis, ds in corners.items() for d in ds}
    wholes = {"n1": 1, "n2": 2, "n3": 3, "n5": 5, "n6": 6}
    big = F.col("big")

    def ordered(digits: Column, size: int) -> Column:
        little = F.concat(*[F.substring(digits, 2 * k + 1, 2) for k in reversed(range(size))])
        return F.when(big, digits).otherwise(little)

    def exponent(n: Column) -> Column:
        return F.length(F.bin(n.cast("long"))) - 1

    def digits(name: str) -> Column:
        """A whole number from 0 on as a double: exponent, then the digits after the first one."""
        n, e = F.col(name).cast("long"), F.col(f"{name}_e")
        first = F.call_function("shiftleft", F.lit(1).cast("long"), e)
        bits = F.shiftleft((e + 1023).cast("long"), 52) + F.call_function("shiftleft", n - first, 52 - e)
        return F.when(n == 0, "0" * 16).otherwise(F.lpad(F.hex(bits), 16, "0"))

    kept = ["p_partkey", "big", "x", "y"]
    parts = table(spark, sf_dir, "part").select(
        "p_partkey", (F.col("p_type") == "MEDIUM").alias("big"), (F.col("p_partkey") % 100).alias("x"), F.col("p_size").alias("y"))
    parts = parts.select(*kept, *[v.alias(k) for k, v in names.items()])
    parts = parts.select(*kept, *names, *[exponent(F.col(k)).alias(f"{k}_e") for k in names])
    parts = parts.select(*kept, *[digits(k).alias(k) for k in names])
    parts = parts.select(*kept, *[ordered(F.col(k), 8).alias(k) for k in names], *[
        ordered(F.lit(f"{n:08X}"), 4).alias(k) for k, n in wholes.items()])

    def ring(dx: int, dy: int, side: int) -> list[Column]:
        square = ((0, 0), (side, 0), (side, side), (0, side), (0, 0))
        return [F.col("n5")] + [F.col(c) for a, b in square for c in (f"x{dx + a}", f"y{dy + b}")]

    def head(kind: str, count: Column) -> list[Column]:
        return [F.when(big, "00").otherwise("01"), F.col(kind), count]

    y = F.col("y")
    hole = F.when(y % 2 == 0, F.concat(*ring(1, 1, 2))).otherwise("")
    square = [*head("n3", F.when(y % 2 == 0, F.col("n2")).otherwise(F.col("n1"))), *ring(0, 0, 4), hole]
    island = [*head("n3", F.col("n1")), *ring(0, 50, 2)]
    many = y % 5 == 0
    start = F.when(many, F.concat(*head("n6", F.col("n2")))).otherwise("")
    rest = F.when(many, F.concat(*island)).otherwise("")
    return parts.select(F.col("p_partkey").cast("string").alias("parcel_id"), F.unhex(F.concat(start, *square, rest)).alias("wkb"))


def tenfold_owners(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ownership with stakes ten times the discount, so that some parcels exceed the whole."""
    return owners(spark, sf_dir).withColumn("pct_own", (F.col("pct_own") * 10).cast("decimal(10,3)"))


def owners_by_brand(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ownership of brands: the parts of a brand give it several account types."""
    brands = table(spark, sf_dir, "part").select(
        F.col("p_partkey").cast("string").alias("parcel_id"), "p_brand"
    )
    return owners(spark, sf_dir).join(brands, "parcel_id").withColumn("parcel_id", F.col("p_brand"))


def staged_owner_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Columns of the ownership file that a load uses, all text but for the unused date."""
    lines = table(spark, sf_dir, "lineitem")
    suppliers = table(spark, sf_dir, "supplier").select("s_suppkey", "s_name")
    parts = table(spark, sf_dir, "part")
    kind = F.col("p_type")
    return (
        lines.join(suppliers, lines.l_suppkey == suppliers.s_suppkey)
        .join(parts, lines.l_partkey == parts.p_partkey)
        .select(
            F.col("l_shipdate").alias("created_date"),
            F.concat("l_returnflag", F.lit("-"), F.col("l_linenumber").cast("string")).alias("strap"),
            F.col("l_partkey").cast("string").alias("folio"),
            F.col("l_linestatus").alias("status_cd"),
            F.col("p_size").cast("string").alias("street_num"),
            F.when(kind == "PROMO", F.col("p_brand")).alias("street_prefix"),
            F.col("p_name").alias("street"),
            F.when(kind != "SMALL", kind).alias("street_suffix"),
            F.lit(None).cast("string").alias("street_unit"),
            F.lit("").alias("city"),
            F.lit(None).cast("string").alias("lot"),
            F.col("s_name").alias("owner_name"),
            F.col("l_discount").cast("decimal(4,2)").cast("string").alias("pct_own"),
            account_type(kind).alias("account_type"),
            month_id(F.col("l_shipdate")).alias("file_index"),
        )
    )


def landed_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every part as a landed feature; some types lack a parcel number, others a geometry."""
    parts = table(spark, sf_dir, "part").select(
        F.col("p_partkey").cast("string").alias("object_id"),
        "p_type",
        F.col("p_size").cast("string").alias("shape_area"),
    )
    kind, wkt = F.col("p_type"), F.col("wkt")
    return parts.join(parcel_shapes(spark, sf_dir), F.col("object_id") == F.col("parcel_id")).select(
        "object_id",
        F.when(kind == "SMALL", "").when(kind != "MEDIUM", F.col("parcel_id")).alias("parcel_no"),
        "shape_area",
        F.lit(None).cast("string").alias("shape_len"),
        F.when(kind == "LARGE", "POLYGON EMPTY").when(kind != "PROMO", wkt).alias("wkt"),
        F.lit(SNAPSHOT).alias("file_index"),
    )


_CASES = " ".join(f"WHEN '{source}' THEN '{target}'" for source, target in ACCOUNT_TYPES.items())
_MONTH = "strftime(date_trunc('month', l_shipdate), '%Y%m%d')"

OWNERS_SQL = f"""
owners AS (
  SELECT CAST(l_orderkey AS VARCHAR) AS account_id, CAST(l_partkey AS VARCHAR) AS parcel_id,
         l_linestatus = 'F' AS is_real_property, s_name AS owner_name,
         CAST(l_discount AS DECIMAL(10,3)) AS pct_own,
         CASE p_type {_CASES} END AS account_type, {_MONTH} AS file_index
  FROM lineitem
  INNER JOIN supplier ON s_suppkey = l_suppkey
  INNER JOIN part ON p_partkey = l_partkey
)"""
PARCELS_SQL = f"""
parcels AS (
  SELECT CAST(l_partkey AS VARCHAR) AS parcel_id, CAST(l_quantity AS DECIMAL(12,2)) AS area_m2,
         {_MONTH} AS file_index
  FROM lineitem
)"""
