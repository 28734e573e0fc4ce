"""Small helpers shared by the corpus operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from signalbarn.session import scratch_dir

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: Rows of narrow lookup tables (some 100 bytes each) that are sent to every executor. Larger ones are shuffled.
BROADCAST_ROWS = 100_000


def lower_ascii(text: Column) -> Column:
    """A-Z in lower case and nothing else changed, unlike lower()."""
    return F.translate(text, UPPER, UPPER.lower())


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def written(df: DataFrame, label: str) -> DataFrame:
    """The rows of `df` after a round trip through a table in the shared folder.

    Used where rows are needed more than once: the table survives lost
    executors and cuts the lineage.
    """
    path = scratch_dir(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def small_or_shuffled(lookup: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """`lookup` with a broadcast hint if counting shows at most `rows` rows, else as it is."""
    return F.broadcast(lookup) if lookup.limit(rows + 1).count() <= rows else lookup


def bound(value: Column, use) -> Column:
    """use(value) with the value computed once per row, also where `use` asks for it inside a lambda.

    The optimizer may put a column's expression in the place of its name, and
    inside a lambda that means once per element.
    """
    return F.element_at(F.transform(F.array(value), use), 1)


def document_key(doc_id: str = "doc_id", text: str = "text") -> Column:
    """Tells rows apart that share an id but not the text. Equal rows share a key and get equal results."""
    return F.struct(F.col(doc_id).alias("id"), F.xxhash64(text).alias("hash"))


def fold(doc_id: str = "doc_id") -> Column:
    """crc32 of the id's decimal digits, modulo 4. A null id has fold 0."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 4, F.lit(0)).cast("int")


def tidy() -> None:
    """Gives back what a worker's allocators hold for later. Workers live on from stage to stage, beside an executor's heap."""
    import gc

    import pyarrow as pa

    gc.collect()
    pa.default_memory_pool().release_unused()
