"""Sources and sinks of vectors and of metadata text."""

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType


def read_vectors(spark: SparkSession, path: str, schema: str, separator: str = ",", header: bool = False) -> DataFrame:
    """Delimited columns; empty and malformed fields are null."""
    return spark.read.csv(path, schema=schema, sep=separator, header=header, ignoreLeadingWhiteSpace=True, ignoreTrailingWhiteSpace=True, nullValue="", mode="PERMISSIVE")


def write_vectors(df: DataFrame, path: str, kind: str = "csv", append: bool = False) -> None:
    writer = df.write.mode("append" if append else "errorifexists")
    writer.option("header", True).csv(path) if kind == "csv" else writer.format(kind).save(path)


def write_tiles(df: DataFrame, path: str, ra: str, dec: str, degrees: float = 10.0) -> None:
    """A catalogue partitioned by tiles of so many degrees, so that region queries read their tiles alone."""
    tiled = df.withColumn("tile_ra", F.floor(F.pmod(ra, F.lit(360.0)) / degrees).cast("int")).withColumn("tile_dec", F.floor((F.col(dec) + 90) / degrees).cast("int"))
    tiled.write.partitionBy("tile_dec", "tile_ra").parquet(path)


def read_region(spark: SparkSession, path: str, ra: str, dec: str, ra_low: float, ra_high: float, dec_low: float, dec_high: float, degrees: float = 10.0) -> DataFrame:
    """The rows of a tiled catalogue in a box; ra_low may be above ra_high, for a box over right ascension 0."""
    df = spark.read.parquet(path)
    low, high = int(ra_low // degrees), int(ra_high // degrees)
    tile = F.col("tile_ra")
    around = (tile >= low) & (tile <= high) if ra_low <= ra_high else (tile >= low) | (tile <= high)
    inside = F.col(ra).between(ra_low, ra_high) if ra_low <= ra_high else (F.col(ra) >= ra_low) | (F.col(ra) <= ra_high)
    rows = F.col("tile_dec").between(int((dec_low + 90) // degrees), int((dec_high + 90) // degrees))
    return df.where(rows & around & inside & F.col(dec).between(dec_low, dec_high))


def read_metadata(spark: SparkSession, path: str) -> DataFrame:
    """(name, type, value, comment) of metadata lines `NAME TYPE VALUE # COMMENT`; blank and comment lines are left out."""
    line = F.trim("value")
    part = lambda k: F.regexp_extract(line, r"^(\S+)\s+(\S+)\s*([^#]*?)\s*(?:#\s*(.*))?$", k)
    return spark.read.text(path).where((line != "") & ~line.startswith("#")).select(part(1).alias("name"), part(2).alias("type"), part(3).alias("value"), part(4).alias("comment"))


def write_metadata(df: DataFrame, path: str) -> None:
    """Rows (name, type, value, comment) as lines `NAME TYPE VALUE # COMMENT`."""
    comment = F.when(F.coalesce("comment", F.lit("")) != "", F.concat(F.lit(" # "), "comment")).otherwise("")
    df.select(F.concat("name", F.lit(" "), "type", F.lit(" "), F.coalesce("value", F.lit("")), comment).alias("value")).write.text(path)


def read_xml(spark: SparkSession, path: str, row: str, schema: str) -> DataFrame:
    """The elements named `row`, each a row."""
    return spark.read.format("xml").option("rowTag", row).schema(schema).load(path)


def write_xml(df: DataFrame, path: str, row: str) -> None:
    df.write.format("xml").option("rowTag", row).option("rootTag", f"{row}s").save(path)


def read_feed(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Lines of fields between bars, with blanks around them; lines that begin with # are left out. Fields that don't fit their type are null."""
    kinds = StructType.fromDDL(schema)
    lines = spark.read.text(path).where((F.trim("value") != "") & ~F.ltrim("value").startswith("#"))
    parts = F.split("value", r"\|")
    return lines.select(*[F.trim(F.get(parts, i)).try_cast(f.dataType).alias(f.name) for i, f in enumerate(kinds)])
