"""Duplicates of wide rows, found by hashes before any row is moved.

Grouping whole rows shuffles them. Here a row is first a 128-bit hash: sixteen bytes are
shuffled, however wide the table. Only rows whose hash repeats are then fetched and compared
in full, so two different rows are never taken for copies. They are found without a shuffle
by a bitmap of the repeated hashes, which is broadcast and bounded: a few other rows share
a bit with them and are compared as well.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import NullType, StructType

from viewtide.functions.missing import missing, quoted
from viewtide.operators.quality import copies_of, usable
from viewtide.session import scratch_path

HASHES = ["__h1", "__h2"]
#: Bits of one bitmap (what ``bitmap_construct_agg`` fills), the bits aimed at for each repeated
#: hash, and the most bitmaps: 16 MB. With more hashes than they have room for, more rows than
#: needed are shuffled, all of them at worst.
BITMAP_BITS, BITS_A_HASH, MOST_BITMAPS = 32_768, 16, 4096


def _hashed(df: DataFrame) -> DataFrame:
    columns = [quoted(c) for c in df.columns]
    return df.withColumns({"__h1": F.xxhash64(*columns), "__h2": F.xxhash64(F.lit("second"), *columns)})


def _bitmaps_for(hashes: int) -> int:
    """How many bitmaps hold so many hashes: a power of two, bounded."""
    wanted = -(-hashes * BITS_A_HASH // BITMAP_BITS)
    return min(MOST_BITMAPS, 1 << max(0, wanted - 1).bit_length())


def _bit() -> Column:
    """A hash's place in its bitmap."""
    return F.shiftrightunsigned("__h1", 32).bitwiseAND(BITMAP_BITS - 1)


def _bitmaps(hashes: DataFrame, count: int) -> DataFrame:
    """Rows (__map, __words): the bitmaps that are not empty, as arrays of 64-bit words."""
    made = hashes.groupBy(F.col("__h1").bitwiseAND(count - 1).alias("__map")).agg(
        F.bitmap_construct_agg(_bit()).alias("bits")
    )
    word = "CAST(conv(hex(substring(bits, i * 8 + 1, 8)), 16, -10) AS BIGINT)"
    return made.select("__map", F.expr(f"transform(sequence(0, {BITMAP_BITS // 64 - 1}), i -> {word})").alias("__words"))


@dataclass(frozen=True)
class RepeatedRows:
    """A stored table and the hashes that more than one of its rows has; all are stored below ``path``."""

    df: DataFrame
    hashes: DataFrame
    bitmaps: DataFrame
    count: int
    path: str

    def _by_bitmap(self, how: str) -> DataFrame:
        """Rows whose hash has its bit set (``left_semi``) or not (``left_anti``), where they are."""
        # The bytes of a word are read as a big-endian number.
        bit = _bit()
        inside = F.lit(56) - bit.bitwiseAND(56) + bit.bitwiseAND(7)
        same = F.col("__h1").bitwiseAND(self.count - 1) == F.col("__map")
        held = F.getbit(F.get("__words", F.shiftright(bit, 6).cast("int")), inside.cast("int")) == 1
        # At most MOST_BITMAPS rows, whatever the table's size.
        return _hashed(self.df).join(F.broadcast(self.bitmaps), same & held, how)

    def candidates(self) -> DataFrame:
        """Rows whose hash repeats; besides them only those that share a bit with one are shuffled."""
        return self._by_bitmap("left_semi").join(self.hashes, HASHES, "left_semi").drop(*HASHES)

    def distinct(self) -> DataFrame:
        """The table without repeated rows. Rows without a bit in the bitmap are not shuffled."""
        single = self._by_bitmap("left_anti").drop(*HASHES)
        return single.unionByName(self._by_bitmap("left_semi").drop(*HASHES).dropDuplicates())

    def profile(self, critical: Sequence[str] = ()) -> DataFrame:
        """The row of :func:`~viewtide.operators.quality.table_profile`, without shuffling rows.

        Missing values are counted over all rows by one scan; only copies, which the number of
        cleaned rows leaves out, are counted among the fetched rows.
        """
        df = self.df
        names = [f"missing_{i}" for i in range(len(df.columns))]
        whole = df.agg(
            F.count(F.lit(1)).alias("total_rows"),
            F.count_if(usable(df, critical)).alias("usable_rows"),
            *[F.count_if(missing(df, c)).alias(name) for c, name in zip(df.columns, names)],
            *[
                F.coalesce(F.max(quoted(c).isNotNull()), F.lit(False)).alias(f"present_{i}")
                for i, c in enumerate(df.columns)
            ],
        )
        more = F.col("__copies") - 1
        again = copies_of(self._by_bitmap("left_semi").drop(*HASHES)).agg(
            _sum(more).alias("rows"), _sum(F.when(usable(df, critical), more)).alias("usable")
        ).first()
        return whole.select(
            "total_rows",
            F.lit(again["rows"]).cast("long").alias("duplicate_rows"),
            (F.col("usable_rows") - F.lit(again["usable"])).alias("rows_after"),
            *names,
            *[f"present_{i}" for i in range(len(df.columns))],
        )


def _sum(column: Column) -> Column:
    return F.coalesce(F.sum(column), F.lit(0))


def _stored(df: DataFrame, path: str) -> DataFrame:
    """The rows as files, so that no later step makes them again; names may be what files forbid."""
    none = [isinstance(field.dataType, NullType) for field in df.schema]
    places = [
        (F.lit(None).cast("string") if empty else quoted(c)).alias(f"c{i}")
        for i, (c, empty) in enumerate(zip(df.columns, none))
    ]
    plain = df.select(*places)
    plain.write.parquet(path, compression="zstd")
    back = df.sparkSession.read.schema(plain.schema).parquet(path)
    return back.select(
        *[(F.lit(None) if empty else F.col(f"c{i}")).alias(c) for i, (c, empty) in enumerate(zip(df.columns, none))]
    )


def repeated_rows(df: DataFrame) -> RepeatedRows:
    """Store the rows, count their hashes, and keep those that repeat.

    The rows are made once and read from files by all later steps: a table that is itself a
    join is not joined again for each.
    """
    spark, path = df.sparkSession, scratch_path(df.sparkSession, "repeated")
    df = _stored(df, f"{path}/rows")
    counted = _hashed(df).groupBy(*HASHES).agg(F.count(F.lit(1)).alias("n"))
    counted.filter("n > 1").select(*HASHES).write.parquet(f"{path}/hashes")
    hashes = spark.read.schema("__h1 long, __h2 long").parquet(f"{path}/hashes")
    count = _bitmaps_for(hashes.count())
    _bitmaps(hashes, count).write.parquet(f"{path}/bitmaps")
    bitmaps = spark.read.schema("__map long, __words array<long>").parquet(f"{path}/bitmaps")
    return RepeatedRows(df, hashes, bitmaps, count, path)


def profile_schema(df: DataFrame) -> StructType:
    """The columns of a profile of ``df``."""
    schema = StructType()
    for name in ["total_rows", "duplicate_rows", "rows_after"] + [f"missing_{i}" for i in range(len(df.columns))]:
        schema.add(name, "long")
    for i in range(len(df.columns)):
        schema.add(f"present_{i}", "boolean")
    return schema
