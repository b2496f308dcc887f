"""Mixing sources to target weights: documents are repeated so that every source comes near its share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import WORD, Stash, column, packed, unpacked

#: Weights of the sources in the order of their names, over and over.
WEIGHTS = (3, 1, 2)
#: Words to take, of all words; and how often a source's words may be taken at most.
SHARE, MOST = 1.5, 2


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, most: int = MOST) -> DataFrame:
    """For (source, source_size): the weight and the target.

    The excess over a full source goes to the others by weight until none is above. In the order of
    limit over weight the full sources come first, so one pass of running sums finds how many are full:
    they are those whose limit is no more than the level that the rest would have with them left out.
    """
    order = Window.orderBy(F.col("source").asc_nulls_last())  # a row for each source, already summed
    weight = F.element_at(F.array(*map(F.lit, weights)), ((F.row_number().over(order) - 1) % len(weights) + 1).cast("int"))
    held = sizes.withColumn("weight", weight).withColumn("limit", (most * F.col("source_size")).cast("double"))
    filling = Window.orderBy((F.col("limit") / F.col("weight")), F.col("source").asc_nulls_last())
    before = filling.rowsBetween(Window.unboundedPreceding, -1)
    every = Window.partitionBy()
    held = held.withColumn("level", (share * F.sum("source_size").over(every) - F.coalesce(F.sum("limit").over(before), F.lit(0.0))) / (F.sum("weight").over(every) - F.coalesce(F.sum("weight").over(before), F.lit(0))))
    # the level of the first source that it does not fill is the level of all that follow
    level = F.min(F.when(F.col("limit") / F.col("weight") > F.col("level"), F.struct(F.col("limit") / F.col("weight"), F.col("source").isNull(), "source", "level"))).over(every)["level"]
    return held.withColumn("final", level).select("source", "source_size", "weight", F.when(F.col("final").isNull() | (F.col("limit") / F.col("weight") <= F.col("level")), F.col("limit")).otherwise(F.col("final") * F.col("weight")).alias("target"))


def _size(text: Column) -> Column:
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(WORD)).cast("long")


def _draw(seed: int, *parts: Column) -> Column:
    """A number from 0 to 1, below 1, from the seed and what the row holds."""
    digest = F.md5(F.concat_ws(":", F.lit(str(seed)), *[F.coalesce(p.cast("string"), F.lit("")) for p in parts]))
    return F.conv(F.substring(digest, 1, 13), 16, 10).cast("long") / F.lit(float(1 << 52))


def plan(docs: DataFrame, seed: int = 17, **options) -> DataFrame:
    """``docs`` with mix_size, mix_source_size, mix_target and mix_copies.

    Rows that are equal in doc_id, source and text draw alike. A null source is one of the sources, a null
    text has no words; a document or source without words is never taken. Counts are summed by source
    before they are shuffled, so a source that holds a third of all rows costs no more than another.
    """
    source = column(docs, "source", "string")
    text = column(docs, "text", "string")
    doc_id = column(docs, "doc_id", "string")
    sizes = docs.select(source, _size(text).alias("size")).groupBy("source").agg(F.sum("size").alias("source_size"))
    table = Stash(docs.sparkSession, "mixing").keep(targets(sizes, **options), "sources")
    table = table.select(F.col("source").alias("mix_source"), F.col("source_size").alias("mix_source_size"), F.col("target").alias("mix_target"))
    held = docs.withColumn("mix_key", source).withColumn("mix_size", _size(text)).withColumn("mix_draw", _draw(seed, doc_id, source, text))
    held = held.join(table, F.col("mix_key").eqNullSafe(F.col("mix_source")))
    rate = F.when(F.col("mix_source_size") > 0, F.col("mix_target") / F.col("mix_source_size")).otherwise(F.lit(0.0))
    copies = F.floor(rate) + F.when(F.col("mix_draw") < rate - F.floor(rate), 1).otherwise(0)
    return held.withColumn("mix_copies", copies.cast("int")).drop("mix_key", "mix_source", "mix_draw")


def mix_report(docs: DataFrame, **options) -> DataFrame:
    """Per row of ``docs``: doc_id, size, source_size, target (its source's) and taken (words, repeats counted)."""
    held = plan(docs.select(column(docs, "doc_id", "long"), column(docs, "source", "string"), column(docs, "text", "string")), **options)
    return held.select("doc_id", F.col("mix_size").alias("size"), F.col("mix_source_size").alias("source_size"), F.col("mix_target").alias("target"), (F.col("mix_size") * F.col("mix_copies")).cast("long").alias("taken"))


def mix(docs: DataFrame, **options) -> DataFrame:
    """The mix itself: every document as often as it is taken, with the columns of ``docs``."""
    held = plan(packed(docs, doc_id="string", source="string", text="string"), **options).filter("mix_copies > 0")
    return unpacked(held.withColumn("mix_copy", F.explode(F.sequence(F.lit(1), F.col("mix_copies")))), docs.columns)
