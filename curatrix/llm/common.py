"""What the corpus operators share: text normalisation, scratch tables, plan sizing."""

from __future__ import annotations

import re
import tempfile
import uuid
import zlib

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: ASCII white space that separates words; every other character belongs to a word.
WORD_SPLIT = r"[\x20\x09-\x0D]+"


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def canonical(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Only the id and the text, nulls in the text as ''; other columns can't clash."""
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))


def bucket_of(doc_id: object, n: int) -> int:
    """crc32 of the id's decimal text, modulo n: the fold rule of the learned operators."""
    return zlib.crc32(("" if doc_id is None else str(doc_id)).encode()) % n


def fold_column(doc_id: Column, n: int) -> Column:
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % F.lit(n)


def scratch_dir(spark: SparkSession) -> str:
    """The shared folder the cluster names. Without one only a local master (tests) gets a
    folder of this machine, as other machines' executors could not read it."""
    path = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not path:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="curatrix-"))
        path = spark.sparkContext.getCheckpointDir()
    return path.rstrip("/")


def materialize(df: DataFrame, name: str, row_group: int | None = None) -> DataFrame:
    """Cut the lineage: write df to a table in the shared folder and read it back. A task holds
    4096 rows at once when it reads, or a row group: rows of many bytes need smaller ones."""
    spark = df.sparkSession
    path = f"{scratch_dir(spark)}/curatrix/{name}-{uuid.uuid4().hex}"
    sized = {"parquet.block.size": row_group, "parquet.block.size.row.check.min": 10, "parquet.block.size.row.check.max": 1000} if row_group else {}
    df.write.options(**sized).parquet(path)
    _WRITTEN.append(path)
    return spark.read.schema(df.schema).parquet(path)


#: Scratch tables of this driver that are not released, in the order of writing.
_WRITTEN: list[str] = []


def mark() -> int:
    """A place in the list of scratch tables, for ``release``."""
    return len(_WRITTEN)


def release(spark: SparkSession, since: int) -> None:
    """Delete the scratch tables written since a mark but the last one, which must be all that
    is still needed of them: what an operator returns is read from it alone."""
    for path in _WRITTEN[since:-1]:
        place = spark._jvm.org.apache.hadoop.fs.Path(path)
        place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)
    del _WRITTEN[since:-1]


#: Operators below which a scan's rows keep their places from one pass to the next.
_NARROW = ("Relation", "Project", "Filter")
#: Rows of ids up to which a join broadcasts them: under 32 MB.
MAX_BROADCAST_IDS = 1_000_000


def numbered(df: DataFrame, name: str = "row") -> DataFrame:
    """df with a number for each row that is the same in every pass. Places in a plain scan
    of files serve as they are; any other plan is written first."""
    nodes = df._jdf.queryExecution().optimizedPlan().toString().split("\n")
    plain = all(re.sub(r"^[\W\d]*", "", n).startswith(_NARROW) for n in nodes if n.strip()) and "rand" not in "".join(nodes).lower()
    return (df if plain else materialize(df, "numbered")).withColumn(name, F.monotonically_increasing_id())


#: Bits of the map that tells which keys a table may hold, 2 MB.
MAP_BITS = 1 << 24


def may_hold(df: DataFrame, ids: DataFrame, key: str = "row", flag: str = "__may") -> DataFrame:
    """df with a flag that is true for every key in ids and for few others: a bitmap of hashed
    keys, of one size at every size of ids, is broadcast. It spares rows without a partner the
    shuffle of a join; it decides nothing."""
    slot = lambda c: F.pmod(F.xxhash64(c), F.lit(MAP_BITS)) + 1
    maps = ids.select(slot(F.col(key)).alias("slot")).groupBy(F.bitmap_bucket_number("slot").alias("__bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("slot")).alias("__bits"))
    place = F.bitmap_bit_position(slot(F.col(key)))
    byte = F.conv(F.hex(F.substring("__bits", (F.floor(place / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    bit = F.pmod(F.floor(byte / F.pow(F.lit(2), F.pmod(place, F.lit(8)))), F.lit(2))
    joined = df.withColumn("__bucket", F.bitmap_bucket_number(slot(F.col(key)))).join(F.broadcast(maps), "__bucket", "left")
    return joined.withColumn(flag, F.coalesce(bit == 1, F.lit(False))).drop("__bucket", "__bits")


def without_rows(df: DataFrame, gone: DataFrame, key: str = "row") -> DataFrame:
    """df without the rows whose key is in gone (materialised ids), which is broadcast while it is small."""
    small = gone.limit(MAX_BROADCAST_IDS + 1).count() <= MAX_BROADCAST_IDS
    return df.join(F.broadcast(gone) if small else gone, key, "left_anti").drop(key)


def by_texts(batches, rows: int = 256):
    """The same rows in short slices, so that a task's memory doesn't follow the batch size."""
    for batch in batches:
        for low in range(0, batch.num_rows, rows):
            yield batch.slice(low, rows)


def input_bytes(df: DataFrame) -> int:
    """Stored bytes of the files that df scans, by the optimizer's statistics; no job is
    run. Sources of unknown size (local rows) count as nothing."""
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    sizes = [int(leaves.apply(i).stats().sizeInBytes()) for i in range(leaves.size())]
    return sum(n for n in sizes if n < 1 << 60)


def partitions_for(df: DataFrame, bytes_each: int = 16 << 20) -> int:
    """Shuffle partitions so that one holds about bytes_each of stored input."""
    least = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return max(least, min(200_000, -(-input_bytes(df) // bytes_each)))
