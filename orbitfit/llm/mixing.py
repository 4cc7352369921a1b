"""Mixing sources to target weights by entropy balancing (DataFrame functions only).

Every source gets a target number of words; every document gets a rate (how
often the mix takes it). Among all rates between 0 and ``cap`` that meet the
target, entropy balancing takes the ones closest to 1 in relative entropy.
They have the form ``min(cap, exp(lambda * z))`` with ``z`` the document's
size over its source's mean size, and the one multiplier per source solves a
convex dual, here by Newton steps kept inside a bracket. A rate depends on
(source, size) only, so the steps run over the distributed histogram of
sizes, one aggregate per step; the state is one row per source.

Rates become copies by adding a uniform draw and a per-source shift before
cutting to whole numbers. The shift is found from the running total of the
words that further copies would add: over equal shift cells first, then row
by row inside the one cell per source where the target falls. One document
per source then gets one copy more or less if that brings the source's taken
words nearer to its target.

Cases: null text has size 0 (its copies take nothing); a null source is a
source of its own, ordered last; rows without an identifier draw by their
row number, all others by identifier and text alone; repeated rows are mixed one
by one, those with an identifier draw alike; an empty table gives an empty
result; other columns are not looked at.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from orbitfit.llm.base import fresh, written

WEIGHTS = (5, 2, 1)   # by source in code point order, repeating
CAP = 3               # most copies of a document, most words of a source over its size
CELLS = 16384         # shift cells per source; one task per source orders the rows of one cell
STEPS = 40            # Newton steps at most; the rounding meets the target whatever is left
CLOSE = 1e-6          # relative miss of the dual at which a source is done


def words(text: Column) -> Column:
    """Number of ``[^\\x20\\x09-\\x0D]+`` in a text; null has none."""
    head = F.regexp_replace(F.coalesce(text, F.lit("")), r"^[\x20\x09-\x0D]+", "")
    return F.length(F.regexp_replace(head, r"[^\x20\x09-\x0D]++[\x20\x09-\x0D]*+", "w")).cast("long")


def numbered(sources: DataFrame) -> DataFrame:
    """``sources`` (one row each) with ``place``, its 0-based place in code point order, null last.

    Range partitions are numbered inside and shifted by the counts of the
    partitions before them, so no task sees all sources.
    """
    ranged = written(sources.withColumn("last", F.col("source").isNull())
                     .repartitionByRange("last", "source")
                     .withColumn("part", F.spark_partition_id()), "ranged")
    counts = ranged.groupBy("part").count().orderBy("part").collect()   # one row per partition
    start, before = [], 0
    for r in counts:
        start += [F.lit(r["part"]), F.lit(before)]
        before += r["count"]
    if not start:
        return ranged.drop("last", "part").withColumn("place", F.lit(0).cast("long"))
    inside = F.row_number().over(Window.partitionBy("part").orderBy("last", "source")) - 1
    return (ranged.withColumn("place", (inside + F.create_map(*start)[F.col("part")]).cast("long"))
            .drop("last", "part"))


def with_targets(sources: DataFrame, weights: tuple[int, ...] = WEIGHTS, cap: int = CAP) -> DataFrame:
    """Source rows (source, source_size) with ``target``.

    The total is shared by weight; what a source cannot hold beyond ``cap``
    times its size is shared among the others by weight, until none is above.
    Each round is one aggregate over the sources; a round that caps none ends.
    """
    table = F.array(*[F.lit(w) for w in weights])
    s = written(numbered(sources).withColumn(
        "weight", table[(F.col("place") % len(weights)).cast("int")].cast("long")), "weighed")
    total = s.agg(F.sum("source_size")).first()[0] or 0
    level, seen = 0.0, -1
    while True:
        # A source is full once its share at this level reaches its limit; levels only rise.
        full = F.col("weight") * F.lit(level) >= cap * F.col("source_size")
        held, open_weight, n = s.agg(
            F.sum(F.when(full, cap * F.col("source_size")).otherwise(0)),
            F.sum(F.when(full, 0).otherwise(F.col("weight"))),
            F.count(F.when(full, 1))).first()
        rest = total - (held or 0)
        if n == seen or not open_weight:
            break
        seen, level = n, rest / open_weight
    share = (F.lit(int(rest)) * F.col("weight")).cast("double") / F.lit(float(open_weight or 1))
    return s.withColumn("target", F.when(full, (cap * F.col("source_size")).cast("double")).otherwise(share))


def solve_dual(sizes: DataFrame, sources: DataFrame, cap: int = CAP) -> DataFrame:
    """Source rows with ``lam``, the multiplier of the source's word constraint.

    ``sizes`` is the histogram (source, size, n). A source at its limit needs
    no multiplier: all its documents are taken ``cap`` times.
    """
    limit = math.log(cap)
    state = sources.select(
        "source", "source_size", "target", "mean",
        F.lit(0.0).alias("lam"), F.lit(None).cast("double").alias("low"), F.lit(None).cast("double").alias("high"),
        ((F.col("target") >= cap * F.col("source_size")) | (F.col("source_size") == 0)).alias("done"))
    for _ in range(STEPS):
        z = F.col("size") / F.col("mean")
        tilt = F.exp(F.least(F.col("lam") * z, F.lit(limit)))
        inner = F.when(F.col("lam") * z < limit, tilt * z).otherwise(0.0)
        now = (sizes.join(state.filter("not done"), sizes["source"].eqNullSafe(state["source"]))
               .groupBy(state["source"].alias("of"))
               .agg(F.sum(F.col("n") * F.col("size") * tilt).alias("value"),
                    F.sum(F.col("n") * F.col("size") * inner).alias("slope")))
        # Above the target: the multiplier is an upper bound, else a lower one.
        over = F.col("value") > F.col("target")
        low = F.when(over, F.col("low")).otherwise(F.col("lam"))
        high = F.when(over, F.col("lam")).otherwise(F.col("high"))
        newton = F.col("lam") - (F.col("value") - F.col("target")) / F.col("slope")
        middle = F.coalesce((low + high) / 2, F.when(over, F.col("lam") * 2 - 1).otherwise(F.col("lam") * 2 + 1))
        inside = (newton > F.coalesce(low, F.lit(float("-inf")))) & (newton < F.coalesce(high, F.lit(float("inf"))))
        near = F.abs(F.col("value") - F.col("target")) <= CLOSE * F.col("target")
        moved = state.join(now, state["source"].eqNullSafe(now["of"]), "left")
        skip = F.col("done") | F.col("value").isNull()
        state = written(moved.select(
            "source", "source_size", "target", "mean",
            F.when(skip | near, F.col("lam")).when(inside & (F.col("slope") > 0), newton).otherwise(middle).alias("lam"),
            F.when(skip, F.col("low")).otherwise(low).alias("low"),
            F.when(skip, F.col("high")).otherwise(high).alias("high"),
            (skip | near).alias("done")), "dual")
        if state.filter("not done").isEmpty():
            break
    return state


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
        weights: tuple[int, ...] = WEIGHTS, cap: int = CAP) -> DataFrame:
    """Per row: id, size, source_size, target, rate, copies, taken, and ``draw_key`` (a hash of id and text)."""
    return planned(docs, id_col, text_col, source_col, weights, cap, F.monotonically_increasing_id()).drop("row")


def planned(docs: DataFrame, id_col: str, text_col: str, source_col: str, weights: tuple[int, ...], cap: int,
            row: Column) -> DataFrame:
    """The columns of ``mix`` and ``row``, a number of each row.

    Rows without an identifier draw by their number as well, so equal texts among them do not share a draw.
    """
    rows = written(docs.select(
        F.col(id_col).alias("id"), F.col(source_col).cast("string").alias("source"),
        words(F.col(text_col)).alias("size"), F.col(text_col).alias("t"), row.alias("row")).select(
        "id", "source", "size", F.when(F.col("id").isNotNull(), F.xxhash64("id", "t"))
        .otherwise(F.xxhash64("row", "t")).alias("draw_key"), "row"), "sizes")
    sizes = written(rows.groupBy("source", "size").agg(F.count("*").alias("n")), "histogram")
    sources = sizes.groupBy("source").agg(F.sum(F.col("size") * F.col("n")).alias("source_size"),
                                          F.sum("n").alias("rows"))
    targets = with_targets(sources, weights, cap).withColumn("mean", F.col("source_size") / F.col("rows"))
    dual = solve_dual(sizes, targets, cap)

    # draw in [0, 1); copies at shift s are floor(rate + draw + s), cut to 0..cap.
    draw = F.pmod(F.xxhash64("draw_key", F.lit("draw")), F.lit(1 << 30)) / float(1 << 30)
    per_source = dual.select(F.col("source").alias("of"), "source_size", "target", "mean", "lam")
    rate = (F.when(F.col("target") >= cap * F.col("source_size"), float(cap))
            .otherwise(F.exp(F.least(F.col("lam") * F.col("size") / F.col("mean"), F.lit(math.log(cap))))))
    rated = (rows.join(per_source, rows["source"].eqNullSafe(per_source["of"])).drop("of")
             .withColumn("rate", rate).withColumn("v", F.col("rate") + draw))
    least = F.greatest(F.lit(0), F.least(F.lit(cap), F.floor(F.col("v") - 1))).cast("int")
    # The shifts in (-1, 1] at which one more copy is taken: at most two.
    first = F.floor(F.col("v") - 1) + 1
    events = F.filter(F.array(first, first + 1), lambda k: (k >= 1) & (k <= cap) & (k - F.col("v") <= 1))
    rated = rated.withColumn("least", least).withColumn(
        "shifts", F.transform(events, lambda k: (k - F.col("v")).cast("double")))

    def cell(shift: Column) -> Column:
        return F.floor((shift + 1) * (CELLS / 2)).cast("int")

    placed = written(rated, "rated")
    added = (placed.select("source", "size", F.explode("shifts").alias("shift"))
             .groupBy("source", cell(F.col("shift")).alias("cell")).agg(F.sum("size").alias("words")))
    base = (placed.groupBy("source", "target").agg(F.sum(F.col("size") * F.col("least")).alias("base"))
            .withColumnRenamed("source", "of"))
    running = F.sum("words").over(Window.partitionBy("source").orderBy("cell"))
    fits = (added.withColumn("running", running)
            .join(base, F.col("source").eqNullSafe(F.col("of")), "right")
            .withColumn("fits", F.col("base") + F.col("running") <= F.col("target")))
    cut = written(fits.groupBy("of", "base").agg(
        F.coalesce(F.min(F.when(~F.col("fits"), F.col("cell"))), F.lit(CELLS + 1)).alias("cut"),
        F.coalesce(F.max(F.when(F.col("fits"), F.col("running"))), F.lit(0)).alias("below")), "cut")
    joined = placed.join(cut, placed["source"].eqNullSafe(cut["of"]))
    joined = joined.withColumn(
        "sure", F.col("least") + F.size(F.filter("shifts", lambda s: cell(s) < F.col("cut")))).withColumn(
        "open", F.try_element_at(F.filter("shifts", lambda s: cell(s) == F.col("cut")), F.lit(1)))
    settled = joined.filter(F.col("open").isNull()).withColumn("copies", F.col("sure"))
    # One cell per source is taken in order of the shift while that brings the total nearer.
    order = Window.partitionBy("source").orderBy("open", "id", "draw_key", "row").rowsBetween(Window.unboundedPreceding, 0)
    total = F.col("base") + F.col("below") + F.sum("size").over(order)
    last = joined.filter(F.col("open").isNotNull()).withColumn("total", total)
    nearer = F.col("total") - F.col("size") / 2 <= F.col("target")
    last = last.withColumn("copies", F.col("sure") + nearer.cast("int")).drop("total")
    counted = written(settled.unionByName(last).select(
        "id", "row", "draw_key", "source", "size", "source_size", "target", "rate",
        F.col("copies").cast("int").alias("copies")), "counted")

    # The single change of one copy that leaves each source nearest to its target.
    missing = (counted.groupBy(F.col("source").alias("of"))
               .agg((F.first("target") - F.sum(F.col("size") * F.col("copies"))).alias("missing")))
    steps = F.filter(F.array(F.when(F.col("copies") < cap, 1), F.when(F.col("copies") > 0, -1)),
                     lambda k: k.isNotNull())
    tried = (counted.filter("size > 0").join(missing, counted["source"].eqNullSafe(missing["of"]))
             .select("of", "id", "draw_key", "row", "size", "missing", F.explode(steps).alias("step")))
    after = F.abs(F.col("missing") - F.col("step") * F.col("size"))
    best = (tried.filter(after < F.abs("missing")).groupBy("of")
            .agg(F.min(F.struct(after.alias("after"), "id", "draw_key", "row", "step")).alias("best"))
            .select(F.col("best.row").alias("row"), F.col("best.step").alias("step")))
    copies = F.col("copies") + F.coalesce("step", F.lit(0))
    return counted.join(best, "row", "left").select(
        "row", F.col("id").alias(id_col), "draw_key", F.col("source").alias(source_col), "size", "source_size", "target",
        "rate", copies.alias("copies"), (F.col("size") * copies).cast("long").alias("taken"))


def repeat_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                     source_col: str = "source") -> DataFrame:
    """The mix itself: every document as often as it is taken, with all its columns.

    Documents without words take no part in the word targets and stay once.
    """
    row, times, copy = fresh(docs, "__row", "__copies", "__copy")
    # The numbers are written with the rows, so that both readings of them agree.
    numbered = written(docs.withColumn(row, F.monotonically_increasing_id()), "numbered")
    plan = planned(numbered, id_col, text_col, source_col, WEIGHTS, CAP, F.col(row)).select(
        F.col("row").alias(row), F.when(F.col("size") == 0, 1).otherwise(F.col("copies")).alias(times))
    return (numbered.join(plan.filter(F.col(times) > 0), row)
            .withColumn(copy, F.explode(F.sequence(F.lit(1), F.col(times))))
            .select(*[F.col(f"`{c}`") for c in docs.columns]))
