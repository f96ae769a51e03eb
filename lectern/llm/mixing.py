"""Op 10. Mixing sources to target weights by Pareto order sampling (DataFrame functions only).

Targets: the sources share ``share`` of all sizes in proportion to weights; a source stops at
``max_copies`` times its own size, and what it can't take is shared again among the others.  That is
water filling: one level such that ``target = least(cap, level * weight)``; it has a closed form over
the sources in order of ``cap / weight``.

Documents: with ``r = target / source size`` copies expected of each, every document is taken whole
``floor(r)`` times; for the rest, ``p = r - floor(r)`` is its inclusion probability.  Pareto order
sampling ranks documents by random odds over inclusion odds, ``Q = (U / (1 - U)) / (p / (1 - p))``,
and takes the first ones until the residual target is met.  ``weight_col`` makes the probabilities
unequal inside a source: ``r`` is scaled by a document's weight over its source's mean weight (by
size), and documents expected above one copy get whole copies first.  U comes from the MD5 of
the id, so reruns agree.

The cut needs a running sum in rank order per source.  No source is sorted as one group: sums per
``BINS`` bins of the rank (added up map-side) show the bin where the cut falls, sums per ``BINS`` parts
of that bin show the part, and only the rows of that part (one in 2 ** 24) are ranked by a window.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import Scratch, names_free

#: Bins of the rank at each of two steps, a power of two.
BINS = 4096
#: Per-source tables of at most so many rows are broadcast; larger ones are joined by source and salt.
BROADCAST_SOURCES = 100_000
SALTS = 32
RESULTS = ("source_size", "target", "copies", "taken")


def uniform(id_col: str, salt: str = "") -> Column:
    """A number inside (0, 1) from the MD5 of the id as text (null: empty)."""
    key = F.concat(F.lit(salt), F.coalesce(F.col(id_col).cast("string"), F.lit("")))
    draw = F.conv(F.substring(F.md5(key), 1, 13), 16, 10).cast("long").cast("double")
    return (draw + F.lit(0.5)) / F.lit(float(2 ** 52))


def source_targets(sizes: DataFrame, source: str, weights: Sequence[int] = (1, 2, 3),
                   max_copies: int = 3, share: float = 1.0) -> DataFrame:
    """One row per source: ``__source, source_size, target``.

    ``sizes`` has ``source`` and ``__size``.  Sources in order of code points, null last, weigh
    ``weights`` in turn.  The windows run over one row per source.
    """
    per = sizes.groupBy(F.col(source).alias("__source")).agg(F.sum("__size").alias("source_size"))
    order = Window.orderBy(F.col("__source").isNull(), F.col("__source"))
    turn = (F.row_number().over(order) - 1) % len(weights)
    per = (per.withColumn("__w", F.element_at(F.array(*[F.lit(int(w)).cast("long") for w in weights]), turn + 1))
              .withColumn("__cap", F.col("source_size") * max_copies)
              .withColumn("__ratio", F.col("__cap") / F.col("__w")))
    by_ratio = Window.orderBy(F.col("__ratio"), F.col("__source").isNull(), F.col("__source"))
    everything = Window.partitionBy()
    per = (per.withColumn("__before", F.sum("__cap").over(by_ratio.rowsBetween(Window.unboundedPreceding, 0))
                          - F.col("__cap"))
              .withColumn("__rest", F.sum("__w").over(by_ratio.rowsBetween(0, Window.unboundedFollowing)))
              .withColumn("__all", F.sum("source_size").over(everything) * F.lit(float(share)))
              .withColumn("__level", (F.col("__all") - F.col("__before")) / F.col("__rest")))
    level = F.max(F.when(F.col("__level") <= F.col("__ratio"), F.col("__level"))).over(everything)
    target = F.least(F.col("__cap").cast("double"), F.coalesce(level * F.col("__w"), F.col("__cap").cast("double")))
    return per.select("__source", "source_size", target.alias("target"))


def mix(docs: DataFrame, size: Column, id_col: str = "doc_id", source_col: str = "source",
        weights: Sequence[int] = (1, 2, 3), max_copies: int = 3, share: float = 1.0,
        weight_col: str | None = None, salt: str = "") -> DataFrame:
    """``docs`` with ``source_size, target, copies, taken`` (input columns of these names are replaced).

    ``copies`` (0 to ``max_copies``) is how often the mix takes the document, ``taken`` that times its
    size.  A source's taken sum differs from its target by half of one document at most.  Null
    sources are a source of their own; null sizes count as 0 and so does a source without words
    (target 0, nothing taken).  Rows that share an id share the draw; full ties may be cut between
    identical rows, which leaves the same multiset.  An empty table gives an empty result.
    """
    docs = names_free(docs, *RESULTS)
    kept = docs.columns
    sized = docs.withColumns({
        "__size": F.coalesce(size, F.lit(0)).cast("long"), "__u": uniform(id_col, salt), "__key": F.col(source_col),
        "__id": F.col(id_col),
        "__pref": F.coalesce(F.col(weight_col).cast("double"), F.lit(0.0)) if weight_col else F.lit(1.0)})
    targets = source_targets(sized, "__key", weights, max_copies, share)
    if weight_col:
        mass = sized.groupBy(F.col("__key").alias("__m")).agg(F.sum(F.col("__pref") * F.col("__size")).alias("__mass"))
        targets = targets.join(mass, F.col("__source").eqNullSafe(F.col("__m"))).drop("__m")
    else:
        targets = targets.withColumn("__mass", F.col("source_size").cast("double"))
    work = Scratch(docs.sparkSession, "mixing")
    targets = work.write(targets, "targets")
    few = targets.count() <= BROADCAST_SOURCES
    rows = _ranked(sized, targets, few, float(max_copies))

    # Step 1: the bin of the rank in which a source's residual target is met.
    open_size = F.when(F.col("__p") > 0, F.col("__size")).otherwise(F.lit(0))
    bins = rows.groupBy("__key", "__b1").agg(
        F.sum(open_size).alias("__n"), F.sum(F.col("__whole") * F.col("__size")).alias("__sure"),
        F.max("target").alias("__target"))
    per_source = Window.partitionBy("__key")
    bins = bins.withColumn("__rest", F.col("__target") - F.sum("__sure").over(per_source))
    first = work.write(_cut(bins, "__b1", F.lit(0)).select(
        "__source", F.col("__cut.bin").alias("__c1"), F.col("__cut.start").alias("__s1"),
        F.col("__cut.rest").alias("__rest")), "first")
    rows = _by_source(rows, first, few, "left")

    # Step 2: the same inside that bin.
    inner = rows.filter((F.col("__b1") == F.col("__c1")) & (F.col("__p") > 0)).groupBy("__key", "__b2").agg(
        F.sum("__size").alias("__n"), F.max("__s1").alias("__s"), F.max("__rest").alias("__rest"))
    second = work.write(_cut(inner, "__b2", F.col("__s")).select(
        "__source", F.col("__cut.bin").alias("__c2"), F.col("__cut.start").alias("__s2")), "second")
    rows = _by_source(rows, second, few, "left")

    # Step 3: rank only the rows of the part where the cut falls.
    split = (F.col("__p") > 0) & F.col("__c1").isNotNull() & (F.col("__b2") == F.col("__c2"))
    sure = rows.filter(~F.coalesce(split, F.lit(False))).withColumn(
        "__extra", F.when(F.col("__p") <= 0, 0).when(F.col("__c1").isNull(), 1)
        .when(F.col("__b2") < F.col("__c2"), 1).otherwise(0))
    order = Window.partitionBy("__key").orderBy("__z", "__id", "__size").rowsBetween(Window.unboundedPreceding, 0)
    before = F.col("__s2") + F.sum("__size").over(order) - F.col("__size")
    ranked = rows.filter(split).withColumn(
        "__extra", F.when(before + F.col("__size") / 2 <= F.col("__rest"), 1).otherwise(0))
    taken = sure.unionByName(ranked).withColumn("copies", (F.col("__whole") + F.col("__extra")).cast("int"))
    return taken.select(*kept, "source_size", "target", "copies",
                        (F.col("copies") * F.col("__size")).cast("long").alias("taken"))


def _by_source(rows: DataFrame, per: DataFrame, few: bool, how: str = "inner") -> DataFrame:
    """``rows`` with the columns of a table that has one row per source at most.

    A counted, small table is broadcast; a larger one is joined on source and salt, so a source with a third of
    the rows is dealt over ``SALTS`` tasks.
    """
    if few:
        return rows.join(F.broadcast(per), F.col("__key").eqNullSafe(F.col("__source")), how).drop("__source")
    rows = rows.withColumn("__salt", F.floor(F.col("__u") * SALTS).cast("int"))
    per = per.withColumn("__with", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    same = F.col("__key").eqNullSafe(F.col("__source")) & (F.col("__salt") == F.col("__with"))
    return rows.join(per, same, how).drop("__source", "__salt", "__with")


def _ranked(rows: DataFrame, targets: DataFrame, few: bool, most: float) -> DataFrame:
    """Rows with whole copies, inclusion probability, Pareto rank ``__z`` = Q / (1 + Q) and its bins."""
    rows = _by_source(rows, targets, few)
    hope = F.when(F.col("__mass") > 0, F.col("target") / F.col("__mass") * F.col("__pref")).otherwise(F.lit(0.0))
    rows = rows.withColumn("__hope", F.least(hope, F.lit(most)))
    rows = rows.withColumn("__whole", F.floor("__hope")).withColumn("__p", F.col("__hope") - F.col("__whole"))
    inclusion = F.when(F.col("__p") > 0, F.col("__p") / (1 - F.col("__p")))
    rows = rows.withColumn("__q", (F.col("__u") / (1 - F.col("__u"))) / inclusion)
    rows = rows.withColumn("__z", F.coalesce(F.col("__q") / (1 + F.col("__q")), F.lit(1.0)))
    return (rows.withColumn("__b2", F.least(F.floor(F.col("__z") * (BINS * BINS)), F.lit(BINS * BINS - 1)))
                .withColumn("__b1", F.floor(F.col("__b2") / BINS)).drop("__q", "__hope", "__mass"))


def _cut(bins: DataFrame, bin_col: str, start: Column) -> DataFrame:
    """Per source the first bin whose running sum passes ``__rest``, with the sum before it."""
    upto = Window.partitionBy("__key").orderBy(bin_col).rowsBetween(Window.unboundedPreceding, 0)
    past = bins.withColumn("__end", start + F.sum("__n").over(upto)).filter(F.col("__end") > F.col("__rest"))
    found = F.struct(F.col(bin_col).alias("bin"), (F.col("__end") - F.col("__n")).alias("start"),
                     F.col("__rest").alias("rest"))
    return past.groupBy(F.col("__key").alias("__source")).agg(F.min(found).alias("__cut"))
