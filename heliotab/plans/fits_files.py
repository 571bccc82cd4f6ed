"""Tables, images and headers written as FITS files and read again."""

from pyspark.sql import functions as F

from heliotab.operators import store
from heliotab.plans.images_and_fits import _IMAGE, _image
from heliotab.plans.registry import query, table
from heliotab.sources import fits

_LINES = ("l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_returnflag")


def _written(spark, rows) -> str:
    fits.register(spark)
    path = store.shared_folder(spark)
    rows.write.format("fits").option("extname", "LINES").mode("append").save(path)
    return path


@query("SELECT l_orderkey, l_linenumber, l_quantity, CASE WHEN l_discount > 0 THEN l_extendedprice END AS l_extendedprice, CASE WHEN l_linenumber < 4 THEN l_linenumber END::INT AS few, l_returnflag, l_tax > 0.04 AS taxed, strftime(l_shipdate, '%Y-%m-%dT%H:%M:%S') AS shipped, l_orderkey + 9000000000 AS far FROM lineitem")
def fits_table(spark, d):
    """lineitem as a FITS table and back: integers and floats with nulls, texts, booleans, times and 64-bit integers."""
    rows = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity", F.when(F.col("l_discount") > 0, F.col("l_extendedprice")).alias("l_extendedprice"), F.when(F.col("l_linenumber") < 4, F.col("l_linenumber")).alias("few"), "l_returnflag", (F.col("l_tax") > 0.04).alias("taxed"), F.date_format("l_shipdate", "yyyy-MM-dd'T'HH:mm:ss").alias("shipped"), (F.col("l_orderkey") + 9000000000).alias("far"))
    path = _written(spark, rows)
    return spark.read.format("fits").option("nan_is_null", "true").load(path)


@query("SELECT l_returnflag, count(*) AS n, round(sum(l_quantity), 3) AS quantity FROM lineitem GROUP BY l_returnflag")
def fits_columns(spark, d):
    """Two columns of a FITS table of five: the other bytes of its rows aren't decoded."""
    path = _written(spark, table(spark, d, "lineitem").select(*_LINES))
    rows = spark.read.format("fits").schema("l_returnflag string, l_quantity double").load(path)
    return rows.groupBy("l_returnflag").agg(F.count("*").alias("n"), F.round(F.sum("l_quantity"), 3).alias("quantity"))


@query("SELECT vec_id, embedding FROM embeddings")
def fits_vectors(spark, d):
    """Arrays of varying length, which are kept behind the rows."""
    return spark.read.format("fits").load(_written(spark, table(spark, d, "embeddings").select("vec_id", "embedding")))


@query(f"SELECT image, x, y, v FROM ({_IMAGE})")
def fits_image(spark, d):
    """The images made of lineitem as one FITS file each, and back as pixels."""
    fits.register(spark)
    path = store.shared_folder(spark)
    fits.write_images(_image(spark, d), path, "image", 64, 64)
    files = [f.rsplit("/", 1)[1] for f in fits._files(path)]  # one an image
    parts = [spark.read.format("fits").option("kind", "image").load(f"{path}/{f}").select(F.lit(f[6:-5]).alias("image"), "x", "y", "v") for f in files]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.where(~F.isnan("v"))


@query("SELECT 'BINTABLE' AS extension, 5 AS fields, count(*)::BIGINT AS rows, 'l_orderkey,l_linenumber,l_quantity,l_extendedprice,l_returnflag' AS names, TRUE AS sums FROM lineitem")
def fits_header(spark, d):
    """What the headers say of the files of a table: rows of all, columns, and whether the data have the sums that they state."""
    path = _written(spark, table(spark, d, "lineitem").select(*_LINES))
    cards = spark.read.format("fits").option("kind", "header").load(path).where("unit = 1")
    of = lambda keyword: F.max(F.when(F.col("keyword") == keyword, F.col("value")))
    files = cards.groupBy("file").agg(of("XTENSION").alias("extension"), of("TFIELDS").cast("int").alias("fields"), of("NAXIS2").cast("long").alias("rows"), F.concat_ws(",", F.transform(F.array_sort(F.collect_list(F.when(F.col("keyword").startswith("TTYPE"), F.struct("card", "value")))), lambda x: x.value)).alias("names"))
    sums = fits.checksums(spark, path).agg(F.min(F.col("stated") == F.col("found")).alias("sums"))
    return files.groupBy("extension", "fields", "names").agg(F.sum("rows").alias("rows")).crossJoin(F.broadcast(sums))
