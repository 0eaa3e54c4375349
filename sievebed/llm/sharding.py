"""Shards of near-equal bytes by sampled splitters, in DataFrame operations only.

Records are ordered by a hash of their text, so equal texts lie together, and cut into many small ranges at
the quantiles of a sample that takes each record with a chance in proportion to its size.  Ranges that
came out too large are cut again at the quantiles of a new sample of their own, between the copies of one
text if need be.  With the exact bytes and rows of all ranges summed up, every record knows its place in
the whole order, and from that its shard and slot; no shard is ever gathered or sorted as a whole.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from sievebed.llm.tables import without, written

#: Ranges a shard is made of at least, bytes of a range beyond that, and records sampled for each range.
RANGES, RANGE_BYTES, SAMPLED = 64, 1 << 29, 24
#: Ranges at most, over all shards: bounds what is broadcast (some 30 MB); ranges of very large input grow instead.
MOST_RANGES = 1 << 18
#: A range of more than this many times its share of bytes, its largest record aside, is cut again, this many
#: rounds at most; each round halves such a range or better, so none is left but by many ill samples.
OVERFULL, ROUNDS = 2.5, 8
#: Copies of one text stay together if they hold at most this part of a shard.
TOGETHER = 1e-3
#: log2 of the buckets of keys over which records meet ranges.
BUCKET_BITS = 14

_ORDER = ("__key", "__id", "__row")


def _bucket(key: Column) -> Column:
    return F.shiftright(key, 64 - BUCKET_BITS)


def _cuts(rows: DataFrame, target: float, salt: int) -> DataFrame:
    """Lower ends of new ranges within each ``__range`` of ``rows``, about ``target`` bytes apart."""
    chance = F.pmod(F.xxhash64(*_ORDER, F.lit(salt)), F.lit(1 << 30)) / float(1 << 30)
    sample = rows.where(chance < F.col("__size") * (SAMPLED / target)).select("__range", *_ORDER, "__size")
    order = Window.partitionBy("__range").orderBy(*_ORDER)
    stands_for = F.greatest(F.col("__size").cast("double"), F.lit(target / SAMPLED))
    before = F.coalesce(F.sum(stands_for).over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    piece = F.floor(before / target)
    numbered = sample.select("__range", *_ORDER, piece.alias("__piece"))
    opens = F.col("__piece") > F.lag("__piece", 1, 0).over(order)
    cuts = numbered.select("__range", *_ORDER, opens.alias("__opens")).where("__opens")
    # Before the first copy of a text, unless a cut lies among its copies already.
    first = ~F.col("__key").eqNullSafe(F.lag("__key").over(order))
    return cuts.select("__key", first.alias("__first"), "__id", "__row").select(
        "__key", F.when(~F.col("__first"), F.col("__id")).alias("__id"),
        F.when(F.col("__first"), F.lit(-1).cast("long")).otherwise(F.col("__row")).alias("__row"),
    )


def _ranges(cuts: DataFrame) -> DataFrame:
    """Ranges between neighbouring cuts, spread over the buckets of keys they reach into."""
    one = Window.orderBy(*_ORDER)
    # Rows without a doc_id come first among equal keys, as in the order of the records.
    low = F.struct(*_ORDER)
    spans = cuts.select(F.row_number().over(one).alias("__range"), low.alias("__low"), F.lead(low).over(one).alias("__high"))
    first = F.coalesce(_bucket(F.col("__low.__key")), F.lit(-(1 << (BUCKET_BITS - 1))))
    last = F.coalesce(_bucket(F.col("__high.__key")), F.lit((1 << (BUCKET_BITS - 1)) - 1))
    return spans.select("*", F.explode(F.sequence(first, last)).alias("__bucket"))


def _assigned(rows: DataFrame, cuts: DataFrame) -> DataFrame:
    """``rows`` with the number of their range; those below the first cut are range 0."""
    own = F.struct(*_ORDER)
    # At most a row for each bucket and each cut, whatever the input: safe to broadcast.
    spans = F.broadcast(_ranges(cuts))
    inside = (own >= F.col("__low")) & (F.col("__high").isNull() | (own < F.col("__high")))
    keyed = rows.drop("__range").withColumn("__bucket", _bucket(F.col("__key")))
    joined = keyed.join(spans, (keyed["__bucket"] == spans["__bucket"]) & inside, "left").drop("__low", "__high", "__bucket")
    return joined.withColumn("__range", F.coalesce("__range", F.lit(0)))


def byte_shards(
    documents: DataFrame, shards: int, *, doc_id: str = "doc_id", text: str = "text", keep_text: bool = True,
) -> DataFrame:
    """``documents`` with ``size``, ``shard`` (0 to ``shards`` - 1) and ``slot`` (from 0, without gaps).

    ``size`` is the text's bytes in UTF-8 plus one; a null text has none and counts one.  Shards hold equal
    bytes up to one record and, as copies of one text stay together while they are small, a thousandth
    of a shard.  Rows that repeat all else may end in either of the places given to them.  Columns of those
    names are replaced.  Without ``keep_text`` the text is left out and never moved.
    """
    kept = without(documents, ["size", "shard", "slot"] + ([] if keep_text else [text])).columns
    rows = written(
        documents.select(
            F.struct(*kept).alias("__rest"), (F.coalesce(F.octet_length(text), F.lit(0)) + 1).cast("long").alias("__size"),
            F.xxhash64(text).alias("__key"), F.col(doc_id).alias("__id"), F.monotonically_increasing_id().alias("__row"),
        ).withColumn("__range", F.lit(0)),
        "shard_rows",
    )
    total = rows.agg(F.sum("__size")).first()[0] or 0
    target = max(1.0, total / max(shards * RANGES, min(MOST_RANGES, total // RANGE_BYTES)))
    cuts = written(_cuts(rows, target, 0), "shard_cuts")
    for salt in range(1, ROUNDS + 1):
        ranged = written(_assigned(rows, cuts), "shard_ranges")
        sizes = written(
            ranged.groupBy("__range").agg(
                F.sum("__size").alias("__bytes"), F.max("__size").alias("__largest"), F.count("*").alias("__n")
            ),
            "shard_sizes",
        )
        overfull = sizes.where(F.col("__bytes") - F.col("__largest") > OVERFULL * target).select("__range")
        if salt == ROUNDS or overfull.isEmpty():
            break
        cuts = written(cuts.union(_cuts(ranged.join(F.broadcast(overfull), "__range", "left_semi"), target, salt)), "shard_cuts")

    before = Window.orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)  # a row per range
    starts = sizes.select(
        "__range", F.coalesce(F.sum("__bytes").over(before), F.lit(0)).alias("__bytes_before"),
        F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__rows_before"),
    )
    placed = ranged.join(F.broadcast(starts), "__range")
    within = Window.partitionBy("__range").orderBy(*_ORDER)
    copies = Window.partitionBy("__range", "__key")
    at = F.col("__bytes_before") + F.sum("__size").over(within.rowsBetween(Window.unboundedPreceding, 0)) - F.col("__size")
    placed = placed.withColumn("__at", at).withColumn(
        "__index", F.col("__rows_before") + F.row_number().over(within) - 1
    )
    together = F.sum("__size").over(copies) <= TOGETHER * total / shards
    at = F.when(together, F.min("__at").over(copies)).otherwise(F.col("__at"))
    shard = F.least(F.floor(at * shards / F.lit(max(1, total))), F.lit(shards - 1)).cast("int")
    numbered = written(
        placed.select("__rest", F.col("__size").alias("size"), shard.alias("shard"), "__index"), "shard_places"
    )
    opens = numbered.groupBy("shard").agg(F.min("__index").alias("__opens"))
    return numbered.join(F.broadcast(opens), "shard").select(
        "__rest.*", "size", "shard", (F.col("__index") - F.col("__opens")).alias("slot")
    )
