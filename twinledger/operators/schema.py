"""Schema comparison of one table pair and of whole catalogs.

Column metadata are rows ``(table_name, column_name, ordinal, data_type, len, prec, scale, nullable)``,
so catalogs with any number of tables compare by joins and grouping like any other data.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

METADATA = T.StructType(
    [
        T.StructField("table_name", T.StringType()),
        T.StructField("column_name", T.StringType()),
        T.StructField("ordinal", T.IntegerType()),
        T.StructField("data_type", T.StringType()),
        T.StructField("len", T.IntegerType()),
        T.StructField("prec", T.IntegerType()),
        T.StructField("scale", T.IntegerType()),
        T.StructField("nullable", T.StringType()),
    ]
)

# Fixed value: where Spark keeps the declared type of a char or varchar column.
_DECLARED = "__CHAR_VARCHAR_TYPE_STRING"


def _field_row(table: str, ordinal: int, field: T.StructField) -> tuple:
    dtype, length, prec, scale = field.dataType, None, None, None
    declared = field.metadata.get(_DECLARED, "") or dtype.simpleString()
    if declared.startswith(("char(", "varchar(")):
        length = int(declared[declared.index("(") + 1:-1])
    if isinstance(dtype, T.DecimalType):
        prec, scale = dtype.precision, dtype.scale
    base = "string" if declared.startswith(("char(", "varchar(")) else dtype.typeName().split("(")[0]
    return table, field.name, ordinal, base, length, prec, scale, "YES" if field.nullable else "NO"


def schema_columns(spark: SparkSession, tables: Mapping[str, DataFrame]) -> DataFrame:
    """Column metadata of DataFrames, read from their schemas without running a job."""
    rows = [
        _field_row(name, i, f) for name, df in tables.items() for i, f in enumerate(df.schema.fields, start=1)
    ]
    return spark.createDataFrame(rows, METADATA)


def _sides(left: DataFrame, right: DataFrame, keys: list[str]) -> tuple[DataFrame, list[str]]:
    rest = [c for c in METADATA.fieldNames() if c not in keys and c in left.columns]
    l = left.select(*keys, *[F.col(c).alias(f"left_{c}") for c in rest], F.lit(True).alias("in_left"))
    r = right.select(*keys, *[F.col(c).alias(f"right_{c}") for c in rest], F.lit(True).alias("in_right"))
    return l.join(r, keys, "full_outer"), rest


def schema_drift(left: DataFrame, right: DataFrame) -> DataFrame:
    """Columns missing on a side, moved or of another base type: the ladders' structure tier."""
    j, _ = _sides(left, right, ["table_name", "column_name"])
    return j.where(
        F.col("in_left").isNull()
        | F.col("in_right").isNull()
        | (F.col("left_ordinal") != F.col("right_ordinal"))
        | (F.col("left_data_type") != F.col("right_data_type"))
    ).select(
        "table_name",
        "column_name",
        F.col("left_ordinal").alias("left_ord"),
        F.col("right_ordinal").alias("right_ord"),
        F.col("left_data_type").alias("left_type"),
        F.col("right_data_type").alias("right_type"),
        F.coalesce("left_ordinal", "right_ordinal").alias("ord"),
    )


def schema_status(drift: DataFrame, tables: DataFrame) -> DataFrame:
    """Structure status of every table in ``tables``: any drifting column fails it."""
    counts = drift.groupBy("table_name").agg(F.count(F.lit(1)).alias("drifted"))
    n = F.coalesce("drifted", F.lit(0)).cast("bigint")
    return tables.join(counts, "table_name", "left").select(
        "table_name", n.alias("drifted"), F.when(n > 0, F.lit("FAIL")).otherwise(F.lit("PASS")).alias("status")
    )


def side_table_counts(left_tables: DataFrame, right_tables: DataFrame) -> DataFrame:
    """How many tables each side lists: the sanity check before comparing catalogs."""
    both = left_tables.select(F.lit("LEFT").alias("side")).unionByName(
        right_tables.select(F.lit("RIGHT").alias("side"))
    )
    return both.groupBy("side").agg(F.count(F.lit(1)).alias("tables"))


def objects_diff(left_tables: DataFrame, right_tables: DataFrame) -> DataFrame:
    """Tables only one side lists."""
    l = left_tables.select("table_name", F.lit(True).alias("in_left"))
    r = right_tables.select("table_name", F.lit(True).alias("in_right"))
    return (
        l.join(r, "table_name", "full_outer")
        .where(F.col("in_left").isNull() | F.col("in_right").isNull())
        .select(
            "table_name",
            F.when(F.col("in_left").isNull(), F.lit("MISSING IN LEFT"))
            .otherwise(F.lit("MISSING IN RIGHT"))
            .alias("issue"),
        )
    )


def _shared_catalog(
    left: DataFrame, right: DataFrame, left_tables: DataFrame, right_tables: DataFrame
) -> DataFrame:
    """Metadata of both sides joined by column, for tables that both sides list."""
    l = left.join(left_tables.select("table_name"), "table_name")
    r = right.join(right_tables.select("table_name"), "table_name")
    shared = left_tables.select("table_name").join(right_tables.select("table_name"), "table_name")
    j, _ = _sides(l, r, ["table_name", "column_name"])
    return j.join(shared, "table_name", "left_semi")


def _differs(name: str) -> Column:
    return F.col(f"left_{name}") != F.col(f"right_{name}")


def _resized() -> Column:
    def unlike(name: str) -> Column:
        return ~F.col(f"left_{name}").eqNullSafe(F.col(f"right_{name}"))

    return unlike("len") | unlike("prec") | unlike("scale")


def drift_class() -> Column:
    """First matching kind of difference of a joined metadata row."""
    return (
        F.when(F.col("in_left").isNull(), F.lit("COLUMN ONLY IN RIGHT"))
        .when(F.col("in_right").isNull(), F.lit("COLUMN ONLY IN LEFT"))
        .when(_differs("data_type"), F.lit("TYPE CHANGED"))
        .when(_resized(), F.lit("PRECISION CHANGED"))
        .when(_differs("nullable"), F.lit("NULLABILITY CHANGED"))
        .otherwise(F.lit("POSITION CHANGED"))
    )


def _drifting() -> Column:
    one_sided = F.col("in_left").isNull() | F.col("in_right").isNull()
    return one_sided | _differs("ordinal") | _differs("data_type") | _resized() | _differs("nullable")


def catalog_drift(
    left: DataFrame, right: DataFrame, left_tables: DataFrame, right_tables: DataFrame
) -> DataFrame:
    """One row per drifting column of the tables both sides list, with its class and both descriptions."""
    j = _shared_catalog(left, right, left_tables, right_tables).where(_drifting())
    described = ["ordinal", "data_type", "len", "prec", "scale", "nullable"]
    return j.select(
        "table_name",
        "column_name",
        drift_class().alias("issue"),
        *[F.col(f"{side}_{c}") for c in described for side in ("left", "right")],
    )


def catalog_rollup(
    left: DataFrame, right: DataFrame, left_tables: DataFrame, right_tables: DataFrame
) -> DataFrame:
    """One row per shared table: a count per kind of difference and PASS or DRIFT."""
    both = F.col("in_left").isNotNull() & F.col("in_right").isNotNull()
    counts = _shared_catalog(left, right, left_tables, right_tables).groupBy("table_name").agg(
        F.count_if(F.col("in_left").isNotNull()).alias("left_cols"),
        F.count_if(F.col("in_right").isNotNull()).alias("right_cols"),
        F.count_if(F.col("in_left").isNull()).alias("only_in_right"),
        F.count_if(F.col("in_right").isNull()).alias("only_in_left"),
        F.count_if(both & _differs("data_type")).alias("type_changed"),
        F.count_if(both & ~_differs("data_type") & _resized()).alias("precision_changed"),
        F.count_if(both & _differs("nullable")).alias("nullability_changed"),
        F.count_if(both & _differs("ordinal")).alias("position_changed"),
        F.count_if(_drifting()).alias("drifted"),
    )
    return counts.select(
        *[c for c in counts.columns if c != "drifted"],
        F.when(F.col("drifted") == 0, F.lit("PASS")).otherwise(F.lit("DRIFT")).alias("verdict"),
    )


def header_drift(left: DataFrame, right: DataFrame) -> DataFrame:
    """Header differences by position.

    Input rows are ``(view, ordinal, column_name)``.  A left column whose position holds another name
    is reported with its place on the right, if any; right columns beyond the left width are added.
    """
    l = left.select("view", "ordinal", F.col("column_name").alias("l_name"))
    r = right.select("view", "ordinal", F.col("column_name").alias("r_name"))
    places = right.groupBy("view", F.col("column_name").alias("l_name")).agg(F.min("ordinal").alias("r_place"))
    widths = left.groupBy("view").agg(F.max("ordinal").alias("width"))
    at = l.join(r, ["view", "ordinal"], "full_outer")
    moved = at.where(F.col("l_name").isNotNull() & ~F.col("l_name").eqNullSafe(F.col("r_name")))
    moved = moved.join(places, ["view", "l_name"], "left").select(
        "view",
        F.col("l_name").alias("column_name"),
        F.col("ordinal").alias("left_ord"),
        # Past the right width a column is reported without a place, even if the name occurs earlier.
        F.when(F.col("r_name").isNotNull(), F.col("r_place")).alias("right_ord"),
        F.col("r_name").alias("right_column_at_position"),
    )
    extra = at.where(F.col("l_name").isNull()).join(widths, "view", "left")
    extra = extra.where(F.col("ordinal") > F.coalesce("width", F.lit(0))).select(
        "view",
        F.col("r_name").alias("column_name"),
        F.lit(None).cast("int").alias("left_ord"),
        F.col("ordinal").alias("right_ord"),
        F.lit(None).cast("string").alias("right_column_at_position"),
    )
    return moved.unionByName(extra)


def header_summary(left: DataFrame, right: DataFrame) -> DataFrame:
    """Per view: drifted positions, names on one side only, and whether it looks like a rename."""
    names = (
        left.select("view", "column_name", F.lit(True).alias("l"))
        .unionByName(right.select("view", "column_name", F.lit(False).alias("l")))
        .groupBy("view", "column_name")
        .agg(F.max("l").alias("in_left"), F.max(~F.col("l")).alias("in_right"))
    )
    per_view = names.groupBy("view").agg(
        F.count_if(~F.col("in_right")).alias("only_left"), F.count_if(~F.col("in_left")).alias("only_right")
    )
    drift = header_drift(left, right).groupBy("view").agg(F.count(F.lit(1)).alias("n"))
    n = F.coalesce("n", F.lit(0)).cast("bigint")
    return per_view.join(drift, "view", "left").select(
        "view",
        n.alias("drifted"),
        "only_left",
        "only_right",
        ((n > 0) & (F.col("only_left") == n) & (F.col("only_right") == n)).alias("looks_like_rename"),
        F.when(n > 0, F.lit("FAIL")).otherwise(F.lit("PASS")).alias("status"),
    )
