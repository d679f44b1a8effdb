"""Mixing sources to target weights by thresholds on a hash, found from nested histograms.

DataFrame functions only.
"""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..checkpoints import materialise

#: Bits of a document's hash, and those that one histogram resolves.
HASH_BITS, STEP_BITS = 60, 12
#: Rows that share the hash at a threshold are numbered in runs of two to this power.
RUN_BITS = 16


def words(text: str) -> Column:
    """Number of runs of characters that are no ASCII white space; NULL has none."""
    return F.coalesce(F.regexp_count(F.col(text), F.lit("[^\\x20\\x09-\\x0D]+")), F.lit(0)).cast("long")


def place(doc_id: str, text: str) -> Column:
    """A document's hash, 60 bits that depend on its id and text alone."""
    identity = F.concat(F.coalesce(F.col(doc_id).cast("string"), F.lit("")), F.lit(":"),
                        F.coalesce(F.col(text), F.lit("")))
    return F.conv(F.substring(F.md5(identity), 1, HASH_BITS // 4), 16, 10).cast("long")


def targets(sizes: DataFrame, weights: Sequence[int], share: float, most: float) -> DataFrame:
    """``sizes`` (source, source_size) with each source's ``target``.

    The sources in order of their code points, NULL last, take the ``weights`` in turn.
    They share ``share`` of all sizes by weight; a target stops at ``most`` times its
    source's size, and what is left over is shared out by weight among the others, until
    none is above. That is the level at which ``least(most * size, level * weight)`` adds
    up to the share: the sources are met in the order in which a rising level fills them.
    """
    every = Window.partitionBy()
    ordered = sizes.withColumn("_rank", F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1)
    weighed = ordered.withColumn("_weight", F.element_at(F.array(*[F.lit(w) for w in weights]),
                                                         (F.col("_rank") % len(weights) + 1).cast("int")))
    filling = Window.orderBy(F.col("source_size") / F.col("_weight"), "_rank")
    before = filling.rowsBetween(Window.unboundedPreceding, -1)
    onward = filling.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    level = ((F.sum("source_size").over(every) * share
              - F.coalesce(F.sum("source_size").over(before), F.lit(0)) * most) / F.sum("_weight").over(onward))
    levels = weighed.withColumn("_level", level)
    open_level = F.min(F.when(F.col("_level") * F.col("_weight") <= F.col("source_size") * most,
                              F.struct(F.col("source_size") / F.col("_weight"), "_rank", "_level"))).over(every)
    return levels.select("source", "source_size", F.least(
        F.col("source_size") * most, F.coalesce(open_level["_level"], F.lit(0.0)) * F.col("_weight")).alias("target"))


def thresholds(sized: DataFrame, sources: DataFrame) -> DataFrame:
    """``sources`` (source, source_size, target) with ``copies``, ``below`` and ``tied``.

    Every document of a source is taken ``copies`` times, and once more if its hash lies
    under ``below``: the hashes up to the one at which the sizes come nearest to what the
    target leaves over. Where repeated rows share that hash, ``tied`` of those at ``below``
    are taken as well. Documents are never sorted. Their sizes are added up by source and
    leading bits of the hash; where the running sum passes the budget, only that bucket's
    documents are added up by their next bits, until one hash is left in it.
    """
    copies = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0)
    state = sources.withColumn("copies", copies.cast("long")).withColumn(
        "_budget", F.col("target") - F.col("copies") * F.col("source_size")).withColumns(
        {"_bucket": F.lit(0).cast("long"), "_before": F.lit(0).cast("long"), "below": F.lit(None).cast("long"),
         "tied": F.lit(0).cast("long")})
    state = materialise(state)
    for shift in range(HASH_BITS - STEP_BITS, -1, -STEP_BITS):
        sought = state.filter("below IS NULL")
        if sought.isEmpty():
            break
        bucket = F.shiftright("_place", shift)
        inside = sized.join(sought.select(F.col("source").alias("_sought"), "_bucket"),
                            F.col("source").eqNullSafe(F.col("_sought"))
                            & (F.shiftright("_place", shift + STEP_BITS) == F.col("_bucket")), "left_semi")
        sums = inside.groupBy("source", bucket.alias("_next")).agg(
            F.sum("size").alias("_sum"), F.count("*").alias("_rows"), F.min("_place").alias("_least"),
            F.max("_place").alias("_most"))
        running = sums.join(sought.withColumnRenamed("source", "_sought"),
                            F.col("source").eqNullSafe(F.col("_sought"))).withColumn(
            "_start", F.col("_before") + F.coalesce(F.sum("_sum").over(
                Window.partitionBy("source").orderBy("_next").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
        # The bucket that holds the boundary is the last one whose sum starts below the budget.
        at = running.filter(F.col("_start") < F.col("_budget")).groupBy("source").agg(
            F.max_by(F.struct("_next", "_start", "_sum", "_rows", "_least", "_most"), "_next").alias("_at"))
        single = (F.col("_at._least") == F.col("_at._most")) | F.lit(shift == 0)
        # Of the rows that share one hash as many as come nearest to the budget; those without words are all the same.
        within = F.coalesce(F.ceil(F.try_divide((F.col("_budget") - F.col("_at._start")) * F.col("_at._rows"),
                                                F.col("_at._sum")) - 0.5), F.col("_at._rows"))
        found = (F.when(F.col("_at").isNull(), F.lit(0))
                 .when(single, F.when(within >= F.col("_at._rows"), F.col("_at._most") + 1)
                       .otherwise(F.col("_at._least"))))
        tied = F.when(single & (within < F.col("_at._rows")), within).otherwise(0)
        done = state.filter("below IS NOT NULL")
        state = materialise(done.unionByName(
            sought.join(at.withColumnRenamed("source", "_sought"), F.col("source").eqNullSafe(F.col("_sought")), "left")
            .select("source", "source_size", "target", "copies", "_budget", F.col("_at._next").alias("_bucket"),
                    F.col("_at._start").alias("_before"), found.cast("long").alias("below"), tied.cast("long").alias("tied"))))
    return state.select("source", "source_size", "target", "copies", "below", "tied")


def _with_taken(rows: DataFrame, cuts: DataFrame) -> DataFrame:
    """``rows`` joined to their source's cut (``_mix_`` and its columns), with ``_mix_taken``, how often each is taken.

    Rows that share the hash at a cut are numbered, so that only so many of them are taken
    as the target asks for: they are kept once, counted in runs, and each run is numbered
    by itself, so no group of repeated rows meets in one task.
    """
    copies, place, below = F.col("_mix_copies"), F.col("_mix_place"), F.col("_mix_below")
    plain = rows.withColumn("_mix_taken", copies + F.when(place < below, 1).otherwise(0))
    if cuts.filter("_mix_tied > 0").isEmpty():
        return plain
    at_cut = (place == below) & (F.col("_mix_tied") > 0)
    tied = materialise(rows.filter(at_cut).withColumn("_mix_row", F.monotonically_increasing_id()))
    tied = tied.withColumn("_mix_run", F.shiftright("_mix_row", RUN_BITS))
    before = Window.partitionBy("_mix_source").orderBy("_mix_run").rowsBetween(Window.unboundedPreceding, -1)
    starts = tied.groupBy("_mix_source", "_mix_run").agg(F.count("*").alias("_rows")).select(
        F.col("_mix_source").alias("_of"), F.col("_mix_run").alias("_run"),
        F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_mix_start"))
    number = F.row_number().over(Window.partitionBy("_mix_source", "_mix_run").orderBy("_mix_row"))
    numbered = tied.withColumn("_mix_number", number).join(
        starts, F.col("_mix_source").eqNullSafe(F.col("_of")) & (F.col("_mix_run") == F.col("_run"))).withColumn(
        "_mix_taken", copies + F.when(F.col("_mix_start") + F.col("_mix_number") <= F.col("_mix_tied"), 1).otherwise(0))
    return plain.filter(~at_cut).unionByName(numbered.select(*plain.columns))


def _cuts(docs: DataFrame, weights: Sequence[int], share: float, most: float, text: str, doc_id: str,
          source: str) -> tuple[DataFrame, DataFrame]:
    """The documents' sizes and hashes, kept without the texts, and the sources' thresholds."""
    sized = materialise(docs.select(F.col(doc_id).alias("doc_id"), F.col(source).alias("source"),
                                    words(text).alias("size"), place(doc_id, text).alias("_place")))
    sources = targets(sized.groupBy("source").agg(F.sum("size").alias("source_size")), weights, share, most)
    cuts = thresholds(sized, sources)
    return sized, cuts.select(*[F.col(c).alias(f"_mix_{c}") for c in cuts.columns])


def mix_plan(docs: DataFrame, weights: Sequence[int] = (5, 2, 1), share: float = 1.5, most: float = 2.0,
             text: str = "text", doc_id: str = "doc_id", source: str = "source") -> DataFrame:
    """How often each document is taken: doc_id, size, source_size, target, copies, taken.

    ``size`` counts the document's words and ``taken`` the words the mix takes of it,
    repeats counted. The words taken of a source come to its target but for half a
    document. Whether a document is in depends on its id and text alone, so reruns agree
    and a raised target only adds documents. Of rows that agree in id, source and text as
    many are in as the target asks for.

    A NULL text or one without words has size 0 and takes nothing whatever its copies; a
    NULL source is a source of its own, after all others; an empty table gives no rows. A
    source, or one repeated row, may hold any share of the rows: sums are combined in each
    task before they meet.
    """
    sized, cuts = _cuts(docs, weights, share, most, text, doc_id, source)
    rows = sized.withColumnRenamed("_place", "_mix_place").join(
        cuts, F.col("source").eqNullSafe(F.col("_mix_source")))
    return _with_taken(rows, cuts).select(
        "doc_id", "size", F.col("_mix_source_size").alias("source_size"), F.col("_mix_target").alias("target"),
        F.col("_mix_taken").alias("copies"), (F.col("_mix_taken") * F.col("size")).alias("taken"))


def mix(docs: DataFrame, weights: Sequence[int] = (5, 2, 1), share: float = 1.5, most: float = 2.0,
        text: str = "text", doc_id: str = "doc_id", source: str = "source") -> DataFrame:
    """The mix itself: the rows of ``docs``, each as often as ``mix_plan`` takes it, in their columns.

    Of rows that agree in id, source and text but not in other columns, any may be the ones
    that are taken. NULLs, texts without words and empty tables are as in ``mix_plan``;
    further columns may have any names.
    """
    _, cuts = _cuts(docs, weights, share, most, text, doc_id, source)
    rows = docs.select(F.struct("*").alias("_mix_doc"), F.col(source).alias("_mix_own"),
                       place(doc_id, text).alias("_mix_place"))
    rows = rows.join(cuts, F.col("_mix_own").eqNullSafe(F.col("_mix_source")))
    return (_with_taken(rows, cuts)
            .withColumn("_mix_copy", F.explode(F.array_repeat(F.lit(1), F.col("_mix_taken").cast("int"))))
            .select("_mix_doc.*"))
