"""Exact deduplication by progressive refinement.

Two texts are equal when identical after lower-casing A-Z only; a null text
counts as empty. Rows are grouped by byte length, the groups of two and more
by a hash of their first `PREFIX` characters, and only rows of groups that
survive both get the SHA-256 of their whole text, on which the final groups
are formed. Of a group the row with the largest id stays; a null id is smaller
than any other, and of rows that share that id exactly one stays. Rows whose
length or prefix nobody shares are groups of their own and are never hashed in
full. Empty tables give an empty result; other columns play no part.

Every shuffle moves narrow rows (ids, lengths, hashes) and every group is
reduced on the map side before it moves, so a group that holds a third of all
rows costs a row for each task. A list of surviving groups is broadcast only
up to `BROADCAST_ROWS` rows; beyond that a bitmap of fixed size stands for it,
which lets through a few rows more than the list, never fewer.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import BROADCAST_ROWS, ascii_lower, column, cut, maybe_broadcast, table, unused

PREFIX = 256
#: Bits of the bitmap that stands for a long list of groups, and bits to a row of it: 16 MB in 4096 rows.
BITS, ROW_BITS = 1 << 27, 1 << 15
#: A group with this many rows, or this share of all rows, is joined by itself: no more than 100,000 groups are.
HOT_ROWS, HOT_SHARE = 10_000, 1e-5


def normalised(text: Column) -> Column:
    return ascii_lower(F.coalesce(text, F.lit("")))


def _flagged(rows: DataFrame, groups: DataFrame, keys: list[str]) -> DataFrame:
    """`rows` with `__shared`, which is true where their group is listed (and, by a bitmap, for some others)."""
    if groups.count() <= BROADCAST_ROWS:
        return rows.join(F.broadcast(groups.withColumn("__shared", F.lit(True))), keys, "left")
    place = F.pmod(F.xxhash64(*keys), F.lit(BITS))
    row, bit = F.floor(place / ROW_BITS).cast("int"), F.pmod(place, F.lit(ROW_BITS))
    maps = cut(groups.select(row.alias("__map"), bit.alias("__bit")).groupBy("__map").agg(F.bitmap_construct_agg("__bit").alias("__bits")))
    byte = F.conv(F.hex(F.substr("__bits", F.floor(bit / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    found = F.coalesce(F.getbit(byte, F.pmod(bit, F.lit(8)).cast("int")) == 1, F.lit(False))
    return rows.withColumn("__map", row).join(F.broadcast(maps), "__map", "left").withColumn("__shared", found).drop("__map", "__bits")


def _shared(rows: DataFrame, keys: list[str]) -> DataFrame:
    return cut(rows.groupBy(*keys).count().where("count > 1").select(*keys))


def _fingerprints(docs: DataFrame, id_col: str, text_col: str, carry: list[str], hash_col: str | None) -> DataFrame:
    """One narrow row for each document: __id, __row (its number), __full (the hash of survivors), and a struct __more of the carried columns."""
    text = F.coalesce(column(text_col), F.lit(""))
    more = F.struct(F.lit(0), *[column(c).alias(f"c{i}") for i, c in enumerate(carry)])
    own = F.col("__hash") if hash_col else F.sha2(ascii_lower(F.col("__text")), 256)
    rows = docs.select(column(id_col).alias("__id"), text.alias("__text"), F.octet_length(text).alias("__len"), more.alias("__more"), *([column(hash_col).alias("__hash")] if hash_col else []))
    rows = _flagged(rows, _shared(rows.select("__len"), ["__len"]), ["__len"])
    prefix = F.xxhash64(ascii_lower(F.substring("__text", 1, PREFIX)))
    rows = rows.withColumn("__prefix", F.when(F.col("__shared"), prefix)).drop("__shared")
    groups = _shared(rows.where(F.col("__prefix").isNotNull()).select("__len", "__prefix"), ["__len", "__prefix"])
    rows = _flagged(rows, groups, ["__len", "__prefix"])
    return cut(rows.select("__id", F.monotonically_increasing_id().alias("__row"), F.when(F.col("__shared"), own).alias("__full"), "__more"))


def _with_best(rows: DataFrame, best: DataFrame) -> DataFrame:
    """Rows with the record of their group. Large groups, of which there are few, are broadcast, so no task has to hold one."""
    if (n := best.count()) <= BROADCAST_ROWS:
        return rows.join(maybe_broadcast(best, n), "__full")
    total = best.agg(F.sum("group_size")).first()[0]
    hot = F.col("group_size") > max(HOT_ROWS, int(HOT_SHARE * total))
    large = F.broadcast(best.where(hot))
    return rows.join(large, "__full").unionByName(rows.join(large, "__full", "left_anti").join(best.where(~hot), "__full"))


def duplicate_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", carry: tuple[str, ...] = (), hash_col: str | None = None) -> DataFrame:
    """One row for each row of `docs`: doc_id, keep_id, group_size, kept, and the carried columns.

    A column with the SHA-256 of the normalised text, if there is one, saves
    taking it again.
    """
    rows = _fingerprints(docs, id_col, text_col, list(carry), hash_col)
    shared = rows.where(F.col("__full").isNotNull())
    best = cut(shared.groupBy("__full").agg(F.max(F.struct("__id", "__row")).alias("__best"), F.count("*").alias("group_size")))
    others = [F.col(f"__more.c{i}").alias(c) for i, c in enumerate(carry)]
    grouped = _with_best(shared, best).select(F.col("__id").alias("doc_id"), F.col("__best.__id").alias("keep_id"), "group_size", (F.col("__best.__row") == F.col("__row")).alias("kept"), *others)
    single = rows.where(F.col("__full").isNull()).select(F.col("__id").alias("doc_id"), F.col("__id").alias("keep_id"), F.lit(1).cast("bigint").alias("group_size"), F.lit(True).alias("kept"), *others)
    return grouped.unionByName(single)


def keep_distinct(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of `docs` that stay, with their columns.

    The rows to drop are found first; where every id is there once, an anti-join
    on the id drops them (broadcast up to `BROADCAST_ROWS` ids). Ids that are
    null or repeat are told apart by their text as well.
    """
    rows = cut(duplicate_groups(docs, id_col, text_col))
    gone_id, vague_id, full, one = unused(docs, "gone_id", "vague_id", "text_hash", "least_row")
    names, own = [column(c) for c in docs.columns], column(id_col)
    gone = rows.where(~F.col("kept")).select(F.col("doc_id").alias(gone_id))
    vague = cut(rows.groupBy("doc_id").count().where("count > 1 OR doc_id IS NULL").select(F.col("doc_id").alias(vague_id)))
    n_gone, n_vague = gone.count(), vague.count()
    if not n_vague:
        return docs.join(maybe_broadcast(gone, n_gone), own == F.col(gone_id), "left_anti").select(*names)
    plain = docs.join(maybe_broadcast(vague, n_vague), own.eqNullSafe(F.col(vague_id)), "left_anti")
    plain = plain.join(maybe_broadcast(gone, n_gone), own == F.col(gone_id), "left_anti").select(*names)
    again = cut(docs.join(maybe_broadcast(vague, n_vague), own.eqNullSafe(F.col(vague_id)), "left_semi").withColumns({full: F.sha2(normalised(column(text_col)), 256), one: F.monotonically_increasing_id()}))
    hashed = docs.select(own.alias("__id"), F.sha2(normalised(column(text_col)), 256).alias("__hash"))
    best = cut(hashed.groupBy("__hash").agg(F.max("__id").alias("__best"), F.count("*").alias("__n")).where("__n > 1 OR __best IS NULL"))
    best = maybe_broadcast(best, best.count())
    # of rows that share the largest id and the text, the first by number; the reduction comes before any join on a group
    firsts = again.groupBy(full, own.alias("__own")).agg(F.min(one).alias("__first"))
    ours = cut(firsts.join(best, F.col(full) == F.col("__hash"), "left").where(F.col("__hash").isNull() | F.col("__own").eqNullSafe(F.col("__best"))).select("__first"))
    stay = again.join(maybe_broadcast(ours, ours.count()), F.col(one) == F.col("__first"), "left_semi")
    return plain.unionByName(stay.select(*names))


def op6_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    docs = docs.withColumn("text_sha256", F.sha2(normalised(F.col("text")), 256))
    return duplicate_groups(docs, carry=("text_sha256",), hash_col="text_sha256")


ORACLE = """
    WITH d AS (
      SELECT doc_id, sha256(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')) AS text_sha256
      FROM documents)
    SELECT doc_id,
           max(doc_id) OVER (PARTITION BY text_sha256) AS keep_id,
           CAST(count(*) OVER (PARTITION BY text_sha256) AS BIGINT) AS group_size,
           doc_id = max(doc_id) OVER (PARTITION BY text_sha256) AS kept,
           text_sha256
    FROM d"""

QUERIES = {"op6_exact_dedup": op6_exact_dedup}
ORACLES = {"op6_exact_dedup": ORACLE}
