"""Which ids a layer holds already, without reading the layer: a Bloom filter for each folder.

Beside the layer lies a table with the filters' blocks, one part for each batch that was added.
A block has eight words; an id chooses a block by one hash and one bit of each word by another,
so that a look-up is an equi-join on the block and eight comparisons in the same stage. Parts
of equal size merge by OR (``merged``). A filter says "no" for certain and "maybe" wrongly at
most once in three million times, by calculation, so what it names is looked up in the layer itself, in those
folders only.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from msgloom.sinks import writers

WORDS = 8
# Bits of the filter for each id. Half as many would be wrong up to once in 60,000 times.
BITS = 64
_WORDS = [f"_w{i}" for i in range(WORDS)]
_SIZES = ["_folder", "_blocks", "_block"]
PART = T.StructType(
    [T.StructField("_folder", T.StringType())]
    + [T.StructField(name, T.LongType()) for name in ("_blocks", "_block", *_WORDS)]
)


def _place(key: Column, blocks: Column) -> Column:
    """The block of an id among a power of two of them."""
    return F.xxhash64(key).bitwiseAND(blocks - 1)


def _bits(key: Column) -> list[Column]:
    """For each word the one bit that an id sets, by a hash that is not that of its block."""
    second = F.xxhash64(F.lit("bits"), key)
    one = F.lit(1).cast("bigint")
    return [
        F.call_function("shiftleft", one, F.shiftright(second, 6 * i).bitwiseAND(F.lit(63)).cast("int"))
        for i in range(WORDS)
    ]


def filter_part(rows: DataFrame, key: str, folder: str) -> DataFrame:
    """The filters of some rows: one row for each folder and block. Null ids are in none.

    The number of blocks follows from the rows of each folder; that table has one row per folder
    and is broadcast. A hot folder's rows are joined by OR in each task before the shuffle.
    """
    ids = rows.select(F.col(key).alias("_id"), F.col(folder).cast("string").alias("_folder"))
    ids = ids.filter(F.col("_id").isNotNull())
    needed = F.count(F.lit(1)) * BITS / (64 * WORDS)
    power = F.ceil(F.log2(F.greatest(needed, F.lit(1.0))))
    sizes = ids.groupBy("_folder").agg(F.pow(F.lit(2.0), power).cast("bigint").alias("_blocks"))
    sized = ids.join(F.broadcast(sizes.select(F.col("_folder").alias("_of"), "_blocks")),
                     F.col("_folder").eqNullSafe(F.col("_of")))
    words = dict(zip(_WORDS, _bits(F.col("_id"))))
    placed = sized.select("_folder", "_blocks", _place(F.col("_id"), F.col("_blocks")).alias("_block"),
                          *[bit.alias(name) for name, bit in words.items()])
    return merged(placed)


def merged(parts: DataFrame) -> DataFrame:
    """Parts of the same folder and size as one."""
    return parts.groupBy(*_SIZES).agg(*[F.bit_or(name).alias(name) for name in _WORDS])


def write_part(rows: DataFrame, key: str, folder: str, path: str, batch: int) -> None:
    """The filters of a batch's rows, in place of those that an attempt before has left."""
    part = filter_part(rows, key, folder)
    part.write.mode("overwrite").parquet(f"{path}/batch={batch}")


def read_parts(spark: SparkSession, path: str, before: int | None = None) -> DataFrame:
    """All parts, or those of batches before a number; none yet is an empty table."""
    try:
        # The number of the batch is the name of the part's folder.
        named = T.StructType([*PART.fields, T.StructField("batch", T.LongType())])
        parts = spark.read.schema(named).parquet(path)
        if before is not None:
            parts = parts.filter(F.col("batch") < before)
        return parts.select(*PART.fieldNames())
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], PART)


def complete(
    layer: DataFrame, key: str, folder: str, path: str, batch: str = "batch_id"
) -> int:
    """Write one part for the layer's batches that no part covers yet; the highest batch covered.

    To be called before each look-up: a part covers all batches up to its number, and a run that
    failed between its rows and their part, or a layer older than its filters, is made up for.
    Batch numbers rise with the files, so their statistics leave out the older ones.
    """
    spark = layer.sparkSession
    parts = [f for f in writers.folders_in(spark, path) if writers.is_written(spark, f)]
    covered = max((int(f.rsplit("=", 1)[1]) for f in parts), default=None)
    rows = layer if covered is None else layer.filter(F.col(batch) > covered)
    highest = rows.agg(F.max(batch)).first()[0]
    if highest is None:
        return covered or 0
    write_part(rows, key, folder, path, highest)
    return highest


def maybe_known(new: DataFrame, key: str, parts: DataFrame) -> DataFrame:
    """Id and folder of all pairs that the filters do not rule out.

    The ids come once each, and once for every size that filters have (at most one for each
    power of two). A small set of ids is broadcast by its measured size, so that the filters
    stream past it; a large one meets them by block.
    """
    ids = new.select(F.col(key).alias("_id")).filter(F.col("_id").isNotNull()).distinct()
    sizes = parts.agg(F.collect_set("_blocks").alias("_sizes"))
    sized = ids.join(F.broadcast(sizes)).select("_id", F.explode("_sizes").alias("_blocks"))
    masks = [f"_m{i}" for i in range(WORDS)]
    asked = sized.select("_id", "_blocks", _place(F.col("_id"), F.col("_blocks")).alias("_block"),
                         *[bit.alias(m) for m, bit in zip(masks, _bits(F.col("_id")))])
    met = asked.join(parts, ["_blocks", "_block"])
    for word, mask in zip(_WORDS, masks):
        met = met.filter(F.col(word).bitwiseAND(F.col(mask)) == F.col(mask))
    return met.select("_id", "_folder").distinct()


def anti_new_rows_by_filter(
    new: DataFrame, layer: DataFrame, key: str, folder: str, parts: DataFrame, work: str
) -> DataFrame:
    """Rows whose id the layer lacks, as ``dedup.anti_new_rows``; opens folders that may hold one.

    ``folder`` is the layer's partition column, and ``parts`` cover all its rows. The pairs of id
    and folder are written to ``work`` once, which the result reads; the folder names, one for
    each, come to the driver to prune the layer's files. The new rows meet only the ids found,
    which a join with the pairs keeps few. Rows with a null id are new, and so are all repeats
    of a new id.
    """
    spark = new.sparkSession
    maybe = maybe_known(new, key, parts)
    maybe.write.parquet(work)
    held = spark.read.schema(maybe.schema).parquet(work)
    folders = [row[0] for row in held.select("_folder").distinct().collect()]
    named = [f for f in folders if f is not None]
    where = F.col(folder).cast("string").isin(named)
    if None in folders:
        where |= F.col(folder).isNull()
    opened = layer.filter(where).select(F.col(key).alias("_id"))
    known = opened.join(held.select("_id"), "_id", "left_semi").distinct()
    return new.join(known, F.col(key) == F.col("_id"), "left_anti")
