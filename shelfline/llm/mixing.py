"""Operator 7, mixing sources to target weights by Efraimidis-Spirakis sampling. DataFrame functions only.

Each document gets the exponential key -ln(u) / w, where u is a hash of its id and text and w its quality weight. Within a
source the documents are taken in the order of this key until their summed words reach the source's budget. A budget above
the source's size takes complete epochs of all documents first; only what is left is a selection.

No source is ordered in one task: the keys are cut into ranges, `buckets` of them for each doubling of the key, the ranges'
sums are prefix-summed, and only the documents of the one range where a source's budget ends are put in order. Since exponential
keys of any weight spread over at least the logarithms that one weight gives, a range holds at most a share of
ln 2 / (e * buckets) of its source, in expectation. What comes out is one cut per source, which every document is compared with
in place.

Defined results: a null text has size 0; a null source is a source of its own, last in order; a source without words has
target 0 and takes nothing; ties of the key go by id (null first), then by a hash of the text, and rows equal in all three
are taken or left together; the document at the cut is taken if that brings the source nearer to its target; an empty
table gives no rows; extra columns are ignored by `mix_decisions` and carried by `mixed_documents`.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfline.llm.common import WORD, stored

_LEAST = -(2**63)


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def quality_weight(text: Column) -> Column:
    """Between 0.05 and 1: falls with the share of marks that prose seldom has."""
    marks = F.length(text) - F.length(F.translate(text, "!#$%&*|{}<>=_~^", ""))
    return F.coalesce(F.greatest(F.lit(0.05), 1 - 4 * marks / F.greatest(F.length(text), F.lit(1))), F.lit(0.05))


def _key(id_: Column, text: Column, weight: Column, seed: int) -> Column:
    """The exponential key, above 0."""
    u = (F.shiftrightunsigned(F.xxhash64(F.lit(seed), id_, F.xxhash64(text)), 11) + 0.5) / float(2**53)
    return F.greatest(-F.ln(u) / weight, F.lit(1e-300))


def _bucket(buckets: int) -> Column:
    """The range that a place's key is in."""
    return F.floor(F.log2("place.key") * buckets)


def _place(id_: Column, text: Column, weight: Column, seed: int) -> Column:
    """What documents of a source are ordered by."""
    return F.struct(
        _key(id_, text, weight, seed).alias("key"),
        F.coalesce(id_.cast("long"), F.lit(_LEAST)).alias("id"),
        F.xxhash64(text).alias("content"),
    )


def source_targets(sizes: DataFrame, weights: Sequence[float], share: float, most: float) -> DataFrame:
    """From (source, source_size), one row a source: the same and its target.

    A target is the lesser of most * size and level * weight; the level is such that the targets add up to the share of all
    sizes. Sources are put in the order in which they are capped; the level is found where the next one is not.
    """
    order = Window.orderBy(F.col("source").asc_nulls_last())
    turn = (F.row_number().over(order) - 1) % len(weights)
    weighed = sizes.withColumn("weight", F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (turn + 1).cast("int")))
    weighed = weighed.withColumn("cap", most * F.col("source_size").cast("double"))
    every = Window.partitionBy()
    capped = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last())
    before = capped.rowsBetween(Window.unboundedPreceding, -1)
    after = capped.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    level = (
        share * F.sum("source_size").over(every) - F.coalesce(F.sum("cap").over(before), F.lit(0.0))
    ) / F.sum("weight").over(after)
    levels = weighed.withColumn("level", level)
    fits = F.when(F.col("level") <= F.col("cap") / F.col("weight"), F.col("level"))
    levels = levels.withColumn("level", F.max(fits).over(every))
    target = F.least(F.col("cap"), F.coalesce(F.col("level") * F.col("weight"), F.col("cap")))
    return levels.select("source", "source_size", target.alias("target"))


def _cuts(places: DataFrame, weights: Sequence[float], share: float, most: float, buckets: int) -> DataFrame:
    """From (source, size, place), one row a source: target, whole epochs, and the last place that the selection takes."""
    bucket = _bucket(buckets)
    sums = stored(places.groupBy("source", bucket.alias("bucket")).agg(F.sum("size").alias("size")), "buckets")
    targets = source_targets(sums.groupBy("source").agg(F.sum("size").alias("source_size")), weights, share, most)
    # a share that rounding has left just under a whole number of epochs is that number
    epochs = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size") + 1e-9)).otherwise(0)
    targets = targets.withColumn("epochs", epochs.cast("long"))
    targets = targets.withColumn("rest", F.greatest(F.lit(0.0), F.col("target") - F.col("epochs") * F.col("source_size")))
    targets = stored(targets, "targets")

    run = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.withColumn("before", F.coalesce(F.sum("size").over(run), F.lit(0)))
    ends = sums.join(targets.withColumnRenamed("source", "s"), F.col("source").eqNullSafe(F.col("s"))).where(
        (F.col("before") < F.col("rest")) & (F.col("before") + F.col("size") >= F.col("rest"))
    )
    ends = stored(ends.select(F.col("source").alias("s"), F.col("bucket").alias("end"), "before", "rest"), "ends")
    inside = places.join(ends, F.col("source").eqNullSafe(F.col("s")) & (bucket == F.col("end"))).drop("s")
    upto = Window.partitionBy("source").orderBy("place").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    inside = inside.withColumn("sum", F.col("before") + F.sum("size").over(upto))
    nearer = F.col("sum") - F.col("size") / 2 <= F.col("rest")  # taking it ends nearer to the budget than leaving it
    cut = inside.groupBy("source").agg(
        F.max(F.when(nearer, F.col("place"))).alias("last"), F.first("end").alias("end")
    )
    cut = cut.select(F.col("source").alias("s"), "last", "end")
    return stored(targets.join(cut, F.col("source").eqNullSafe(F.col("s")), "left").drop("s"), "cuts")


def _copies(bucket: Column) -> Column:
    chosen = (F.col("rest") > 0) & ((bucket < F.col("end")) | F.coalesce(F.col("place") <= F.col("last"), F.lit(False)))
    return F.col("epochs") + F.when(chosen, 1).otherwise(0)


def _decide(rows: DataFrame, places: DataFrame, weights, share, most, buckets) -> DataFrame:
    """`rows`, which have source and place, with the columns of their source's cut and `copies`."""
    cuts = _cuts(places, weights, share, most, buckets).withColumnRenamed("source", "s")
    joined = rows.join(cuts, F.col("source").eqNullSafe(F.col("s"))).drop("s")
    return joined.withColumn("copies", _copies(_bucket(buckets)))


def mix_decisions(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    weights: Sequence[float] = (5, 2, 1),
    share: float = 1.5,
    most: float = 2.0,
    seed: int = 7,
    buckets: int = 512,
    weight: Column | None = None,
) -> DataFrame:
    """One row per document: doc_id, size, source, source_size, target, copies, taken. `weight`: quality of a document, above 0."""
    text = F.col(text_col)
    w = quality_weight(text) if weight is None else weight
    places = stored(
        docs.select(
            F.col(id_col).alias("doc_id"),
            F.col(source_col).alias("source"),
            word_count(text).alias("size"),
            _place(F.col(id_col), text, w, seed).alias("place"),
        ),
        "places",
    )
    out = _decide(places, places, weights, share, most, buckets)
    return out.select(
        "doc_id", "size", "source", "source_size", "target", "copies", (F.col("copies") * F.col("size")).alias("taken")
    )


def mixed_documents(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    weights: Sequence[float] = (5, 2, 1),
    share: float = 1.5,
    most: float = 2.0,
    seed: int = 7,
    buckets: int = 512,
) -> DataFrame:
    """The mix itself: each document's row as often as it is taken, with all its columns."""
    text = F.col(text_col)
    place = _place(F.col(id_col), text, quality_weight(text), seed).alias("place")
    narrow = docs.select(F.col(source_col).alias("source"), word_count(text).alias("size"), place)
    whole = docs.select(
        F.struct(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(docs.columns)]).alias("row"),
        F.col(source_col).alias("source"),
        place,
    )
    out = _decide(whole, stored(narrow, "places"), weights, share, most, buckets)
    out = out.where(F.col("copies") > 0).select("row", F.explode(F.sequence(F.lit(1), F.col("copies"))))
    return out.select(*[F.col(f"row.c{i}").alias(c) for i, c in enumerate(docs.columns)])
