"""Mixing sources to target weights by entropy balancing.

Every document gets a rate (how often the mix takes it) that stays as close to
one as the token constraints allow, in relative entropy: minimise the sum of
r log r - r + 1 subject to sum(size * r) = target for each source and
0 <= r <= cap. The solution is an exponential tilt, r = min(cap, exp(a * x)) with
x the size over the source's mean size, and ``a`` the root of the source's dual
gradient sum(size * r) - target, which rises in ``a``. The duals of all sources
are solved at once by Newton steps, each one distributed sum of gradient and
curvature over the (source, size) cells, held inside a bracket by bisection.

Rates become copies by error diffusion: within a source, cells go from the
largest size to the smallest, and each cell rounds up as many of its documents
as bring the words taken so far closest to the words wanted so far. Which
documents of a cell get the extra copy is decided by a hash of the whole row and its
number among equal rows, through a cut-off that is found in slices of the cell, so
exactly as many get it as are wanted, whatever ids repeat or are null, and a cell with
very many documents, or equal ones, is never in one task.

Sums run on scaled integers, so reruns agree to the last bit.
"""

from __future__ import annotations

from collections.abc import Sequence

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.common import WORD, content_key, numbered, stored

WEIGHTS = (1, 2, 3)
CAP = 3
SLICE = 4096          # documents of a cell in one task, about
RANK_PARTITIONS = 16
_UNIT = 1000          # fixed-point scale of the sums
_HASH_BITS = 62


def with_size(docs: DataFrame, text: str = "text", out: str = "size") -> DataFrame:
    """Add the number of words of the text (null: 0)."""
    return docs.withColumn(out, F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("bigint"))


def _fixed(value):
    return F.round(value * _UNIT).cast("decimal(38,0)")


def ranked_sources(sources: DataFrame) -> DataFrame:
    """Add ``rank`` (1, 2, ... by code point, null last) to distinct sources, without one task for all."""
    dealt = stored(sources.repartitionByRange(RANK_PARTITIONS, F.col("source").asc_nulls_last())
                   .withColumn("_p", F.spark_partition_id()))
    # One row per range partition: bounded by the number of partitions.
    sizes = dealt.groupBy("_p").count()
    before = Window.orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("_p", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("_start"))
    within = Window.partitionBy("_p").orderBy(F.col("source").asc_nulls_last())
    return (dealt.withColumn("rank", F.row_number().over(within)).join(F.broadcast(starts), "_p")
            .withColumn("rank", F.col("rank") + F.col("_start")).drop("_p", "_start"))


def source_targets(cells: DataFrame, weights: Sequence[int] = WEIGHTS, cap: int = CAP) -> DataFrame:
    """(rank, source, source_size, n_docs, target) per source of cells (source, size, n).

    Sources share all words by their weights; a target stops at ``cap`` times
    the source's size and the excess goes to the others by weight, until none
    is above. Only sums over all sources reach the driver.
    """
    sources = cells.groupBy("source").agg(F.sum(F.col("size") * F.col("n")).alias("source_size"),
                                          F.sum("n").alias("n_docs"))
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]),
                          (F.pmod(F.col("rank") - 1, F.lit(len(weights))) + 1).cast("int"))
    ranked = stored(ranked_sources(sources).withColumn("weight", weight))
    limit = F.col("source_size") * cap
    share = 0.0
    while True:
        above = F.col("weight") * F.lit(share) > limit
        s = ranked.agg(F.sum("source_size").alias("total"),
                       F.coalesce(F.sum(F.when(above, limit)), F.lit(0)).alias("fixed"),
                       F.coalesce(F.sum(F.when(~above, F.col("weight"))), F.lit(0)).alias("weights")).first()
        after = (s.total - s.fixed) / s.weights if s.weights and s.total else share
        if after == share:
            break
        share = after
    target = F.least(F.col("weight") * F.lit(share), limit.cast("double"))
    return ranked.select("rank", "source", "source_size", "n_docs", target.alias("target"))


def _rate(tilt, x, cap: int):
    return F.least(F.lit(float(cap)), F.exp(tilt * x))


def solve_tilts(cells: DataFrame, targets: DataFrame, cap: int = CAP, tolerance: float = 1e-9,
                max_steps: int = 200) -> DataFrame:
    """Add ``tilt`` to the targets: the root of each source's dual gradient.

    cells: (rank, x, size, n). A source at its cap has no finite root and gets
    null (all rates are the cap); so does none with size zero, whose tilt is 0. Raises if
    a source is not solved after ``max_steps``, which brackets halved that often do not need.
    """
    at_cap = F.col("target") >= F.col("source_size") * cap
    state = stored(targets.select(
        "rank", "target", F.lit(0.0).alias("tilt"), F.lit(None).cast("double").alias("low"),
        F.lit(None).cast("double").alias("high"), (at_cap | (F.col("source_size") == 0)).alias("done"),
        (at_cap & (F.col("source_size") > 0)).alias("full")))
    for step in range(max_steps + 1):
        if state.where(~F.col("done")).isEmpty():
            break
        if step == max_steps:
            raise RuntimeError(f"targets of some sources are not met after {max_steps} steps")
        rate = _rate(F.col("tilt"), F.col("x"), cap)
        words = F.col("n") * F.col("size")
        sums = (cells.join(state.where(~F.col("done")), "rank").groupBy("rank")
                .agg(F.sum(_fixed(words * rate)).alias("sum"),
                     F.sum(F.when(rate < cap, _fixed(words * F.col("x") * rate))).alias("slope")))
        error = F.col("sum").cast("double") / _UNIT - F.col("target")
        moved = (state.join(sums, "rank", "left")
                 .withColumn("error", error)
                 .withColumn("low", F.when(F.col("error") < 0, F.col("tilt")).otherwise(F.col("low")))
                 .withColumn("high", F.when(F.col("error") > 0, F.col("tilt")).otherwise(F.col("high")))
                 .withColumn("newton", F.when(F.col("slope") > 0,
                                              F.col("tilt") - F.col("error") * _UNIT / F.col("slope").cast("double"))))
        # Outside the bracket: halve it, or where it is still open go on outward.
        outward = F.when(F.col("error") < 0, 2 * F.abs("tilt") + 1).otherwise(-2 * F.abs("tilt") - 1)
        inside = ((F.col("low").isNull() | (F.col("newton") > F.col("low")))
                  & (F.col("high").isNull() | (F.col("newton") < F.col("high"))) & (F.abs("newton") < 1e6))
        closed = F.col("low").isNotNull() & F.col("high").isNotNull()
        after = (F.when(inside, F.col("newton")).when(closed, (F.col("low") + F.col("high")) / 2)
                 .otherwise(outward))
        close = F.abs("error") <= F.greatest(F.lit(2.0 / _UNIT), F.col("target") * tolerance)
        ended = F.col("done") | F.coalesce(close, F.lit(True)) | F.coalesce(after == F.col("tilt"), F.lit(False))
        state = stored(moved.select("rank", "target", F.when(ended, F.col("tilt")).otherwise(after).alias("tilt"),
                                    "low", "high", ended.alias("done"), "full"))
    return targets.join(state.select("rank", F.when(~F.col("full"), F.col("tilt")).alias("tilt")), "rank")


def _round_cells(cap: int):
    """Error diffusion over one source's cells (one row per distinct size)."""
    def round_source(cells: pd.DataFrame) -> pd.DataFrame:
        cells = cells.sort_values("size", ascending=False).reset_index(drop=True)
        owed, base, ups = 0.0, [], []
        for size, n, rate in zip(cells["size"].tolist(), cells["n"].tolist(), cells["rate"].tolist()):
            low = min(int(rate), cap)
            owed += size * n * (rate - low)
            most = n if low < cap else 0
            up = min(most, max(0, int(owed / size + 0.5))) if size else 0
            owed -= size * up
            base.append(low)
            ups.append(up)
        return cells.assign(base=pd.Series(base, dtype="int64"), ups=pd.Series(ups, dtype="int64"))
    return round_source


def plan_copies(sizes: DataFrame, weights: Sequence[int] = WEIGHTS, cap: int = CAP) -> DataFrame:
    """Per (source, size): source_size, target, rate, base copies and the hash cut-off of one more.

    ``sizes``: rows with source, size and pick, stored.
    """
    cells = stored(sizes.groupBy("source", "size").agg(F.count("*").alias("n")))
    targets = source_targets(cells, weights, cap)
    x = F.when(F.col("source_size") > 0, F.col("size") * F.col("n_docs") / F.col("source_size")).otherwise(F.lit(0.0))
    placed = stored(cells.join(targets, cells["source"].eqNullSafe(targets["source"]))
                    .select("rank", targets["source"], "size", "n", x.alias("x")))
    solved = stored(solve_tilts(placed, targets, cap))
    rated = placed.drop("source").join(solved, "rank").withColumn(
        "rate", F.when(F.col("size") == 0, F.lit(1.0)).when(F.col("tilt").isNull(), F.lit(float(cap)))
        .otherwise(_rate(F.col("tilt"), F.col("x"), cap)))
    rated = rated.select("rank", "source", "source_size", "target", "size", "n", "rate")
    counted = T.StructType([*rated.schema.fields, T.StructField("base", T.LongType()),
                            T.StructField("ups", T.LongType())])
    rounded = stored(rated.groupBy("rank").applyInPandas(_round_cells(cap), counted))

    # Cells in which some documents get one more: the hash of the ups-th
    # smallest, searched in the slice that holds it.
    split = rounded.where((F.col("ups") > 0) & (F.col("ups") < F.col("n")))
    own = sizes.select(F.col("source").alias("s"), F.col("size").alias("z"), "pick")
    slices = F.ceil(F.col("n") / SLICE)
    sliced = (own.join(split.select("rank", "source", "size", "ups", slices.alias("slices")),
                       F.col("s").eqNullSafe(F.col("source")) & (F.col("z") == F.col("size")))
              .select("rank", "size", "ups", "pick",
                      F.floor(F.col("pick") / F.lit(float(1 << _HASH_BITS)) * F.col("slices")).alias("slice")))
    upto = Window.partitionBy("rank", "size").orderBy("slice").rowsBetween(Window.unboundedPreceding, 0)
    found = (sliced.groupBy("rank", "size", "ups", "slice").agg(F.count("*").alias("c"))
             .withColumn("end", F.sum("c").over(upto))
             .where((F.col("end") >= F.col("ups")) & (F.col("end") - F.col("c") < F.col("ups")))
             .select("rank", "size", "slice", (F.col("ups") - F.col("end") + F.col("c")).alias("want")))
    order = Window.partitionBy("rank", "size", "slice").orderBy("pick")
    cuts = (sliced.select("rank", "size", "slice", "pick").join(found, ["rank", "size", "slice"])
            .withColumn("_n", F.row_number().over(order)).where(F.col("_n") == F.col("want"))
            .select("rank", "size", F.col("pick").alias("cut")))
    most = F.lit((1 << _HASH_BITS) - 1)
    cut = F.when(F.col("ups") == 0, F.lit(-1)).when(F.col("ups") == F.col("n"), most).otherwise(F.col("cut"))
    return rounded.join(cuts, ["rank", "size"], "left").select(
        "source", "size", "source_size", "target", "rate", "base", cut.alias("cut"))


def _picked(rows: DataFrame) -> DataFrame:
    """Stored rows (.., _k1, _k2, _row) with a place of their own in a cell: 62 bits of a hash of the row and its
    number among equal ones. Equal rows are as good as each other, so reruns agree in what they take."""
    pick = F.xxhash64("_k1", "_k2", "_nth").bitwiseAND(F.lit((1 << _HASH_BITS) - 1))
    return stored(numbered(rows, ["_k1", "_k2"], "_nth").withColumn("pick", pick).drop("_k1", "_k2", "_nth"))


_RESULTS = ("size", "source_size", "target", "rate", "copies", "taken")


def _taken(picked: DataFrame, weights: Sequence[int], cap: int) -> DataFrame:
    """The rows of ``_picked`` with what their cell's plan says: ``_RESULTS`` beside their own columns."""
    plan = plan_copies(picked, weights, cap).withColumnsRenamed({"source": "_source", "size": "_size"})
    joined = picked.join(plan, picked["source"].eqNullSafe(F.col("_source")) & (picked["size"] == F.col("_size")))
    copies = F.col("base") + (F.col("pick") <= F.col("cut")).cast("bigint")
    own = [c for c in picked.columns if c not in ("size", "pick")]
    return joined.select(*own, "size", "source_size", "target", "rate", copies.alias("copies"),
                         (copies * F.col("size")).alias("taken"))


def mix(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source",
        weights: Sequence[int] = WEIGHTS, cap: int = CAP) -> DataFrame:
    """Add size, source_size, target, rate, copies and taken (= size * copies) to every document.

    Sources are weighed 1, 2, 3, repeating, by code point, null last. A null
    text has size 0; documents of size 0 have rate 1 and take no words. A source
    without words has target 0. Rows that repeat an id, or have none, are documents of their
    own; of rows that are equal in id, source and text it is not said which get the extra
    copies. Columns named like the results are replaced; an empty table gives an empty result.
    """
    size = F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("bigint")
    whole = stored(docs.select(F.struct(*docs.columns).alias("_document"), F.col(source).alias("source"), size.alias("size"),
                               *content_key(doc_id, source, text), F.monotonically_increasing_id().alias("_row")))
    taken = _taken(_picked(whole.drop("_document")), weights, cap).drop("source")
    kept = [F.col("_document").getField(c).alias(c) for c in docs.columns if c not in _RESULTS]
    return whole.select("_document", "_row").join(taken, "_row").select(*kept, *_RESULTS)


def mix_sizes(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source",
              weights: Sequence[int] = WEIGHTS, cap: int = CAP) -> DataFrame:
    """``mix`` without the texts: (doc_id, source, size, source_size, target, rate, copies, taken); rows
    are told apart by id, source and text."""
    own = docs.select(F.col(doc_id).alias("doc_id"), F.col(source).alias("source"), F.col(text).alias("text"))
    narrow = stored(with_size(own).select("doc_id", "source", "size", *content_key("doc_id", "source", "text"),
                                          F.monotonically_increasing_id().alias("_row")))
    return _taken(_picked(narrow), weights, cap).select("doc_id", "source", *_RESULTS)


def take_mix(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source",
             weights: Sequence[int] = WEIGHTS, cap: int = CAP) -> DataFrame:
    """The rows of ``docs``, all columns, each as often as the mix takes it (not at all, up to ``cap`` times)."""
    packed = docs.select(F.struct(*docs.columns).alias("_document"), F.col(doc_id).alias("_id"), F.col(text).alias("_text"),
                         F.col(source).alias("_from"))
    mixed = mix(packed, "_id", "_text", "_from", weights, cap)
    return (mixed.where(F.col("copies") > 0)
            .select("_document", F.explode(F.sequence(F.lit(1), F.col("copies"))).alias("_copy")).select("_document.*"))
