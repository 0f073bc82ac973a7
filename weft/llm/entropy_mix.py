"""Mixing sources to target token weights by entropy balancing, in DataFrame operations only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from weft.llm.common import materialise

#: Single copies that make up for rounding, for each source.
ROUNDINGS = 6
WORD = r"[^\x20\x09-\x0D]+"


def n_words(text: str | Column) -> Column:
    """Runs without ASCII white space; a null text has none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, weights: list[float], cap: float = 3.0) -> DataFrame:
    """``(source, source_size, target)`` from ``(source, source_size)``.

    Sources in code-point order (null last) take ``weights`` in turn and share
    the whole size by them; none exceeds ``cap`` times its own size, the excess
    going to the others by weight.  That is a water level L with target =
    min(cap x size, L x weight); with sources in order of cap x size / weight,
    those below the level come first, so one running sum finds it.  One row a
    source enters the windows, never documents.
    """
    order = Window.orderBy(F.encode(F.col("source"), "UTF-8").asc_nulls_last())
    turn = (F.row_number().over(order) - 1) % len(weights)
    s = sizes.select("source", "source_size", F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (turn + 1).cast("int")).alias("weight"))
    s = s.withColumn("most", cap * F.col("source_size")).withColumn("ratio", F.col("most") / F.col("weight"))
    rising, everything = Window.orderBy("ratio", F.encode(F.col("source"), "UTF-8").asc_nulls_last()), Window.partitionBy()
    before = rising.rowsBetween(Window.unboundedPreceding, -1)
    s = s.select("*", F.coalesce(F.sum("most").over(before), F.lit(0.0)).alias("spent"),
                 (F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0.0))).alias("left"),
                 F.sum("source_size").over(everything).cast("double").alias("total"))
    # the level if this source and all after it were below their caps; it holds for the first source that is
    level = (F.col("total") - F.col("spent")) / F.col("left")
    s = s.withColumn("level", level)
    holds = F.min(F.when(F.col("level") <= F.col("ratio"), F.struct("ratio", "level"))).over(everything)["level"]
    return s.select("source", "source_size", F.least(F.col("most"), F.coalesce(holds * F.col("weight"), F.col("most"))).alias("target"))


def tilts(cells: DataFrame, targets: DataFrame, cap: float = 3.0, tolerance: float = 1e-9, rounds: int = 60) -> DataFrame:
    """``(source, unit, lam)``: the dual solution of each source's token constraint.

    Rates r minimise their relative entropy to 1 under sum(r x size) = target and
    0 <= r <= cap, so r = min(cap, exp(lam x size / unit)) with the source's mean
    size as unit.  The dual is convex in lam.  Newton steps are safeguarded by a
    bracket that each round narrows; all sources step at once, each round being
    one aggregate over ``cells`` (source, size, n), until every constraint holds
    to ``tolerance``.  Only the largest residual comes to the driver.
    """
    top = F.log(F.lit(cap))
    per = cells.groupBy("source").agg((F.sum(F.col("size") * F.col("n")) / F.sum("n")).alias("unit"), F.min("size").alias("small"))
    state = (per.join(targets, per["source"].eqNullSafe(targets["source"])).select(per["source"], "unit", "target", F.lit(0.0).alias("lam"),
             # at the upper end every rate is at the cap; at the lower end every rate is next to nothing
             (-40.0 * F.col("unit") / F.col("small")).alias("lo"), (top * F.col("unit") / F.col("small")).alias("hi"),
             (F.col("target") >= cap * F.col("source_size") * (1 - 1e-12)).alias("full")))
    state = materialise(state.withColumn("lam", F.when(F.col("full"), F.col("hi")).otherwise(F.col("lam"))), "tilt")
    for _ in range(rounds):
        s = state.alias("s")
        z = F.col("lam") * F.col("size") / F.col("unit")
        mass = F.col("size") * F.col("n") * F.least(F.lit(cap), F.exp(F.least(z, top)))
        slope = F.when(z < top, F.col("size") * F.col("n") * F.exp(F.least(z, top)) * F.col("size") / F.col("unit")).otherwise(0.0)
        sums = (cells.alias("c").join(s, F.col("c.source").eqNullSafe(F.col("s.source")))
                .groupBy(F.col("s.source").alias("source"), "unit", "target", "lam", "lo", "hi", "full")
                .agg(F.sum(mass).alias("got"), F.sum(slope).alias("slope")))
        off = F.col("got") - F.col("target")
        lo = F.when(off < 0, F.col("lam")).otherwise(F.col("lo"))
        hi = F.when(off >= 0, F.col("lam")).otherwise(F.col("hi"))
        step = F.col("lam") - off / F.nullif(F.col("slope"), F.lit(0.0))
        good = F.col("step").isNotNull() & (F.col("step") > F.col("lo")) & (F.col("step") < F.col("hi"))
        moved = sums.select("source", "unit", "target", "lam", "full", lo.alias("lo"), hi.alias("hi"), step.alias("step"),
                            F.when(F.col("full"), 0.0).otherwise(F.abs(off) / F.greatest(F.col("target"), F.lit(1.0))).alias("residual"))
        done = F.col("full") | (F.col("residual") <= tolerance)
        state = materialise(moved.select(
            "source", "unit", "target", "lo", "hi", "full", "residual",
            F.when(done, F.col("lam")).when(good, F.col("step")).otherwise((F.col("lo") + F.col("hi")) / 2).alias("lam")), "tilt")
        worst = state.agg(F.max("residual")).first()[0]
        if worst is None or worst <= tolerance:
            break
    return state.select("source", "unit", "lam")


def mix(docs: DataFrame, weights: list[float], cap: int = 3, id_col: str = "doc_id", text_col: str = "text",
        source_col: str = "source", keep: list[str] | None = None) -> DataFrame:
    """Every row with ``size, source_size, target, copies, taken`` (``keep`` names small columns to carry; default the id).

    Sizes and their counts are aggregated to (source, size) cells before any
    shuffle of one source's rows.  Tilted rates become copies of whole
    documents: running sums over a source's sizes give each cell an integer
    number of copies, which misses the target by about one document; what is
    missing is made up by single copies, the largest that fit first.  Every row
    of the cell gets the whole part, and the rest go to the rows first in order
    of a hash of their id, equal ids in any order.
    A cell's rows are ranked in 64 hash buckets, so that a cell or source with
    a third of all rows is spread.  Results do not depend on partitioning.

    Null and empty texts have size 0 and are taken 0 times; null sources form a
    source of their own, last in order; a null id hashes like any other value;
    repeated rows count as often as they come; an empty table gives no rows.
    """
    keep = keep or [id_col]
    made = [F.col(c) for c in keep]
    rows = docs.select(*[c.alias(f"k{i}") for i, c in enumerate(made)], F.col(source_col).alias("source"), n_words(text_col).alias("size"),
                       F.xxhash64(F.col(id_col).cast("string")).alias("h"))
    rows = materialise(rows, "sizes")
    buckets = materialise(rows.groupBy("source", "size", F.pmod("h", F.lit(64)).alias("bucket")).agg(F.count("*").alias("n")), "cells")
    cells = materialise(buckets.groupBy("source", "size").agg(F.sum("n").alias("n")), "cells")
    sizes = cells.groupBy("source").agg(F.sum(F.col("size") * F.col("n")).alias("source_size"))
    targets = materialise(source_targets(sizes, weights, float(cap)), "targets")
    some = cells.where(F.col("size") > 0)
    tilt = tilts(some, targets, float(cap))

    c, t, g = some.alias("c"), tilt.alias("t"), targets.alias("g")
    rate = F.least(F.lit(float(cap)), F.exp(F.least(F.col("lam") * F.col("size") / F.col("unit"), F.log(F.lit(float(cap))))))
    rated = c.join(t, F.col("c.source").eqNullSafe(F.col("t.source"))).select("c.source", "size", "n", (rate * F.col("n")).alias("want"))
    upto = Window.partitionBy("source").orderBy("size").rowsBetween(Window.unboundedPreceding, 0)
    total = F.floor(F.round(F.sum("want").over(upto), 6) + 0.5)
    shared = (rated.withColumn("upto", total)
              .withColumn("given", F.col("upto") - F.coalesce(F.lag("upto").over(Window.partitionBy("source").orderBy("size")), F.lit(0)))
              .withColumn("given", F.least(F.greatest(F.col("given"), F.lit(0)), F.col("n") * cap)))
    shared = shared.alias("c").join(g, F.col("c.source").eqNullSafe(F.col("g.source"))).select("c.source", "size", "n", "given", "target")
    whole = Window.partitionBy("source")
    for _ in range(ROUNDINGS):  # one more or fewer copy of the largest text that still fits what is missing
        missing = F.col("target") - F.sum(F.col("given") * F.col("size")).over(whole)
        room = F.when(F.col("missing") > 0, F.col("given") < F.col("n") * cap).otherwise(F.col("given") > 0)
        shared = (shared.withColumn("missing", missing)
                  .withColumn("pick", F.max(F.when(room & (F.col("size") <= F.abs("missing")), F.col("size"))).over(whole))
                  .withColumn("given", F.col("given") + F.when(F.col("size") == F.col("pick"), F.signum("missing")).otherwise(0).cast("long")))
    shared = (shared.select("source", "size", F.floor(F.col("given") / F.col("n")).alias("base"), (F.col("given") % F.col("n")).alias("extra")))

    ahead = Window.partitionBy("source", "size").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    firsts = buckets.select("source", "size", "bucket", F.coalesce(F.sum("n").over(ahead), F.lit(0)).alias("first"))
    b, s = firsts.alias("b"), shared.alias("s")
    both = (b.join(s, F.col("b.source").eqNullSafe(F.col("s.source")) & (F.col("b.size") == F.col("s.size")), "left")
            .join(g, F.col("b.source").eqNullSafe(F.col("g.source")))
            .select("b.source", "b.size", "bucket", "first", F.coalesce("base", F.lit(0)).alias("base"),
                    F.coalesce("extra", F.lit(0)).alias("extra"), "source_size", "target"))
    cell = [F.col("source"), F.col("size"), F.pmod("h", F.lit(64))]
    ranked = rows.withColumn("bucket", cell[2]).withColumn(
        "place", F.row_number().over(Window.partitionBy("source", "size", "bucket").orderBy("h")))
    r, x = ranked.alias("r"), both.alias("x")
    out = r.join(x, F.col("r.source").eqNullSafe(F.col("x.source")) & (F.col("r.size") == F.col("x.size")) & (F.col("r.bucket") == F.col("x.bucket")))
    copies = (F.col("base") + (F.col("first") + F.col("place") <= F.col("extra")).cast("long"))
    return out.select(*[F.col(f"r.k{i}").alias(n) for i, n in enumerate(keep)], F.col("r.size").alias("size"), "source_size", "target",
                      copies.alias("copies"), (copies * F.col("r.size")).alias("taken"))


def repeat_copies(docs: DataFrame, weights: list[float], cap: int = 3) -> DataFrame:
    """The mixed table: every row of ``docs`` as often as the mix takes it (columns unchanged).

    Rows without a word weigh nothing and are not taken.
    """
    rows = materialise(docs.withColumn("__row", F.monotonically_increasing_id()), "rows")
    mixed = mix(rows, weights, cap, keep=["__row"]).where(F.col("copies") > 0).select("__row", F.col("copies").alias("__times"))
    times = F.explode(F.sequence(F.lit(1), F.col("__times").cast("int")))
    return rows.join(mixed, "__row").select(*docs.columns, times.alias("__copy")).drop("__copy")
