"""Mixing sources to target weights by entropy balancing.

Among all document rates ``r_i`` in ``[0, max_repeat]`` that meet every source's token
target, entropy balancing takes those closest (in relative entropy) to taking each
document once. The solution is an exponential tilt, ``r_i = min(max_repeat,
exp(lambda_s * size_i / mean_size_s))``, with one dual variable per source. Newton steps
on the convex dual find the ``lambda_s``: the gradient and curvature of each step are one
aggregate over the counts per (source, size), which hold every document exactly and are
far smaller than the documents.

Rates are rounded to copies: the whole part is taken, and the fraction is taken for the
documents that come first by ``u_i / fraction_i`` (``u_i`` a hash of the id) until the
source's target is met, cut by a histogram of bounded width per source; one document more
or less per source then closes the gap that is left.

Nulls: a null text has size 0; a null source is a source of its own, ordered last; a null
id only shares its hash. Documents of size 0 get rate 1 and take 0 words. Repeated rows
are documents of their own (equal ones are rounded alike). An empty table gives no rows.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quarry.operators.models import materialize
from quarry.operators.ranking import with_position

WORDS = r"[^\x20\x09-\x0D]+"
CUT_SLOTS = 1 << 12
MAX_STEPS = 60


def word_count(text):
    """Number of runs of characters other than ASCII white space; null counts 0."""
    return F.coalesce(F.regexp_count(text, F.lit(WORDS)), F.lit(0)).cast("bigint")


def _key(source):
    """A join key that keeps null apart from every string."""
    return F.coalesce(F.concat(F.lit("="), source), F.lit(""))


def source_targets(sizes: DataFrame, weights: Sequence[float], max_repeat: float) -> DataFrame:
    """Per source: ``source, source_key, source_size, n_docs, target``.

    ``sizes`` holds ``source, size, n``. Sources in code point order (null last) weigh
    ``weights``, repeating. The total is shared by weight; a target stops at ``max_repeat``
    times its source's size, and what is above is shared again among the others.
    """
    totals = sizes.groupBy("source").agg(
        F.sum(F.col("size") * F.col("n")).cast("bigint").alias("source_size"), F.sum("n").alias("n_docs")
    )
    placed = with_position(totals, [F.col("source").asc_nulls_last()])
    cycle = F.array(*[F.lit(float(w)) for w in weights])
    w = F.element_at(cycle, (F.col("position") % len(weights) + 1).cast("int"))
    placed = materialize(
        placed.select("source", _key(F.col("source")).alias("source_key"), "source_size", "n_docs", w.alias("w")),
        "mix-sources",
    )
    total = placed.agg(F.sum("source_size")).first()[0] or 0
    most = F.col("source_size") * float(max_repeat)
    level, capped = 0.0, -1
    while True:  # each round caps one source more at least, so the rounds end
        full = (F.col("w") * level >= most) if level else F.lit(False)
        row = placed.agg(
            F.sum(F.when(full, most).otherwise(0.0)),
            F.sum(F.when(full, 0.0).otherwise(F.col("w"))),
            F.sum(full.cast("int")),
        ).first()
        if not row[1] or row[2] == capped:
            break
        capped, level = row[2], (total - row[0]) / row[1]
    return placed.withColumn("target", F.least(most, F.col("w") * float(level)))


def _newton(sizes: DataFrame, targets: DataFrame, max_repeat: float, tolerance: float) -> DataFrame:
    """Dual variables: ``targets`` with ``lam`` (null: every document at ``max_repeat``)."""
    top = math.log(max_repeat)
    free = F.col("target") < F.col("source_size") * max_repeat * (1 - 1e-12)
    start = F.log(F.greatest(F.col("target"), F.lit(1e-9)) / F.greatest(F.col("source_size"), F.lit(1)))
    state = materialize(
        targets.withColumn("mean", F.greatest(F.col("source_size") / F.col("n_docs"), F.lit(1e-9)))
        .withColumn("lam", F.when((F.col("source_size") > 0) & free, start))
        .withColumn("low", F.lit(None).cast("double"))
        .withColumn("high", F.lit(None).cast("double")),
        "mix-dual",
    )
    counts = sizes.select(_key(F.col("source")).alias("source_key"), "size", "n").where("size > 0")
    for _ in range(MAX_STEPS):
        tilt = F.col("lam") * F.col("size") / F.col("mean")
        rate = F.when(tilt >= top, F.lit(float(max_repeat))).otherwise(F.exp(F.least(tilt, F.lit(top))))
        tokens = F.col("n") * F.col("size") * rate
        moments = (
            counts.join(state.where("lam is not null").select("source_key", "lam", "mean"), "source_key")
            .groupBy("source_key")
            .agg(
                F.sum(tokens).alias("g"),
                F.sum(F.when(tilt < top, tokens * F.col("size") / F.col("mean")).otherwise(0.0)).alias("h"),
            )
        )
        seen = state.join(moments, "source_key", "left")
        low = F.when(F.col("g") < F.col("target"), F.col("lam")).otherwise(F.col("low"))
        high = F.when(F.col("g") > F.col("target"), F.col("lam")).otherwise(F.col("high"))
        # Newton on the logarithm of the constraint, kept inside the bracket.
        step = F.col("lam") + F.log(F.col("target") / F.col("g")) * F.col("g") / F.nullif(F.col("h"), F.lit(0.0))
        inside = step.isNotNull() & (step > F.coalesce(low, F.lit(-math.inf))) & (step < F.coalesce(high, F.lit(math.inf)))
        halved = (low + high) / 2
        wider = F.when(low.isNull(), high * 2 - 1).otherwise(low * 2 + 1)
        done = F.abs(F.col("g") / F.col("target") - 1) <= tolerance
        moved = F.when(done, F.col("lam")).when(inside, step).when(low.isNull() | high.isNull(), wider).otherwise(halved)
        state = materialize(
            seen.select(
                *targets.columns,
                "mean",
                F.when(F.col("g") > 0, moved).otherwise(F.when(F.col("lam").isNotNull(), F.col("lam") / 2)).alias("lam"),
                F.when(F.col("g") > 0, low).otherwise(F.col("lam")).alias("low"),
                high.alias("high"),
                (F.col("lam").isNotNull() & ~F.coalesce(done, F.lit(False))).alias("open"),
            ),
            "mix-dual",
        )
        if not state.where("open").limit(1).count():
            break
        state = state.drop("open")
    return state


def mix(
    docs: DataFrame,
    weights: Sequence[float] = (1, 2, 3),
    max_repeat: int = 3,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    tolerance: float = 1e-6,
    seed: int = 17,
) -> DataFrame:
    """``doc_id, size, source_size, target, taken, copies, rate`` for every document.

    ``copies`` is a whole number from 0 to ``max_repeat``; ``taken`` is ``copies * size``.
    The texts are read once; later passes read ids and sizes only.
    """
    base = materialize(
        docs.select(
            F.col(id_col).alias("doc_id"),
            F.col(source_col).alias("source"),
            word_count(F.col(text_col)).alias("size"),
        ),
        "mix-sizes",
    )
    sizes = materialize(base.groupBy("source", "size").agg(F.count(F.lit(1)).alias("n")), "mix-counts")
    dual = _newton(sizes, source_targets(sizes, weights, max_repeat), float(max_repeat), tolerance)

    top = math.log(max_repeat)
    tilt = F.col("lam") * F.col("size") / F.col("mean")
    rate = (
        F.when(F.col("size") == 0, F.lit(1.0))
        .when(F.col("lam").isNull() | (tilt >= top), F.lit(float(max_repeat)))
        .otherwise(F.exp(F.least(tilt, F.lit(top))))
    )
    u = (F.pmod(F.xxhash64("doc_id", "size", F.lit(seed)), F.lit(1 << 40)) + F.lit(0.5)) / F.lit(float(1 << 40))
    order = F.col("u") / F.col("part")
    rated = (
        base.withColumn("source_key", _key(F.col("source")))
        .join(dual.select("source_key", "source_size", "target", "lam", "mean"), "source_key")
        .withColumn("rate", rate)
        .withColumn("whole", F.floor("rate"))
        .withColumn("part", F.col("rate") - F.col("whole"))
        .withColumn("u", u)
        .withColumn("slot", F.when(F.col("part") > 0, F.floor(order / (order + 1) * CUT_SLOTS)))
    )
    slots = rated.groupBy("source_key", "slot").agg(
        F.sum("size").alias("words"), F.sum(F.col("whole") * F.col("size")).alias("sure"), F.first("target").alias("target")
    )
    per_source = Window.partitionBy("source_key")  # CUT_SLOTS + 1 rows at most
    run = per_source.orderBy(F.col("slot").asc_nulls_first()).rowsBetween(Window.unboundedPreceding, 0)
    extra = F.when(F.col("slot").isNotNull(), F.col("words")).otherwise(0)
    cuts = (
        slots.withColumn("left", F.col("target") - F.sum("sure").over(per_source))
        .withColumn("middle", F.sum(extra).over(run) - extra / 2)
        .where("slot is not null and middle <= left")
        .groupBy("source_key")
        .agg(F.max("slot").alias("cut"))
    )
    cuts = materialize(cuts, "mix-cuts")
    decided = materialize(
        rated.join(cuts, "source_key", "left")
        .withColumn("extra", F.coalesce((F.col("slot") <= F.col("cut")).cast("int"), F.lit(0)))
        .select("doc_id", "source_key", "size", "source_size", "target", "rate", "whole", "part", "u", "extra"),
        "mix-rounded",
    )
    copies = F.col("whole") + F.col("extra")
    miss = (
        decided.groupBy("source_key")
        .agg((F.first("target") - F.sum(copies * F.col("size"))).alias("miss"))
        .where("miss <> 0")
    )
    # One more document is taken, or one extra copy given back, per source, if that comes nearer.
    can = (F.col("part") > 0) & (F.col("extra") == F.when(F.col("miss") > 0, 0).otherwise(1))
    off = F.abs(F.col("size") - F.abs("miss"))
    swaps = materialize(
        decided.join(materialize(miss, "mix-miss"), "source_key")
        .where(can & (off < F.abs("miss")))
        .groupBy("source_key")
        .agg(F.min(F.struct(off.alias("off"), "u", "size")).alias("swap"))
        .select("source_key", F.col("swap.u").alias("swap_u"), F.col("swap.size").alias("swap_size")),
        "mix-swaps",
    )
    swap = F.coalesce((F.col("u") == F.col("swap_u")) & (F.col("size") == F.col("swap_size")) & (F.col("part") > 0), F.lit(False))
    extra = F.when(swap, 1 - F.col("extra")).otherwise(F.col("extra"))
    return (
        decided.join(swaps, "source_key", "left")
        .withColumn("copies", (F.col("whole") + extra).cast("bigint"))
        .select(
            "doc_id",
            "size",
            "source_size",
            "target",
            (F.col("copies") * F.col("size")).cast("bigint").alias("taken"),
            "copies",
            "rate",
        )
    )
