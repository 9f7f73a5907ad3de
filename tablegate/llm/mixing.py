"""Mixing sources to target weights by Efraimidis-Spirakis sampling.

Every source has a token budget: its share, by weight, of ``volume`` times all
tokens, at most ``max_epochs`` times its own size; what is above that is shared
among the others by weight (so every budget is ``min(cap, rate * weight)`` for
one rate). A source's documents are taken whole as often as whole epochs fit
the budget. The rest is one draw without replacement: each document gets the
exponential key ``-ln(u) / q``, u from a hash of its id and text and q its
quality weight, and the documents of least key are taken, as many as keep the
source nearest to its budget.

The prefix sums over a source sorted by key are not made in one task. Sums by
source and bin of the key find the bin that the budget ends in; all lower bins
are taken, all higher ones are not, and that bin's rows are binned again by
the next digits of the key, then by task and by place within the task, so that
repeated rows (equal keys) are parted too. Only the rows of the last bin are
numbered one by one. DataFrame functions only.

Defined results: a null source is a source of its own; a null text has no
tokens and goes with any draw; quality weights that are null, or not positive,
count as the least weight; equal keys are taken in the order of tasks;
an empty table, or one without tokens, has budgets of 0. Reruns over the same
files agree. Other columns are not looked at.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tablegate.llm.base import WORD_PATTERN, plain_names, quoted, save, workspace

WEIGHTS = (3, 1, 2)
VOLUME = 1.5
MAX_EPOCHS = 2.0
LEAST_QUALITY = 0.05
BINS = 1 << 11  # bins of one digit of the key
SEED = 20_011


def text_quality(text: Column) -> Column:
    """A weight in (0, 1]: 1 / (1 + 4 r), r the runs of signs or capitals (three or more) for each word."""
    words = F.greatest(F.regexp_count(text, F.lit(WORD_PATTERN)), F.lit(1))
    return 1.0 / (1.0 + 4.0 * F.regexp_count(text, F.lit(r"[#*$%&|<>]+|[A-Z]{3,}")) / words)


def budgets(sizes: DataFrame, weights: tuple[float, ...] = WEIGHTS, volume: float = VOLUME, max_epochs: float = MAX_EPOCHS) -> DataFrame:
    """(source, source_size, target) from (source, source_size); weights repeat over the sources by code point, null last.

    One row per source; the windows over all of them are the mix's own plan,
    whose size is that of the list of sources.
    """
    place = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (place % len(weights) + 1).cast("int"))
    table = sizes.withColumn("weight", weight).withColumn("cap", F.col("source_size") * F.lit(float(max_epochs)))
    table = table.withColumn("ratio", F.col("cap") / F.col("weight"))
    # In order of cap per weight: the sources before the first one whose cap is not reached are at their cap.
    order = Window.orderBy("ratio", F.col("source").asc_nulls_last())
    past = order.rowsBetween(Window.unboundedPreceding, -1)
    rest = order.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    whole = Window.partitionBy()
    table = table.withColumns(
        {
            "capped": F.coalesce(F.sum("cap").over(past), F.lit(0.0)),
            "open": F.sum("weight").over(rest),
            "all": F.sum("source_size").over(whole) * F.lit(float(volume)),
        }
    )
    rate = (F.col("all") - F.col("capped")) / F.col("open")
    table = table.withColumn("place", F.row_number().over(order))
    first = F.min(F.when(rate <= F.col("ratio"), F.struct("place", rate.alias("rate")))).over(whole)
    table = table.withColumn("rate", first["rate"])
    target = F.when(F.col("rate").isNull(), F.col("cap")).otherwise(F.least("cap", F.col("rate") * F.col("weight")))
    return table.select("source", "source_size", F.coalesce(target, F.lit(0.0)).alias("target"))


def _digits() -> list[Column]:
    """What a source's rows are binned by in turn."""
    fine = F.col("point") * BINS
    return [
        F.floor(fine).cast("long"),
        F.floor((fine - F.floor(fine)) * BINS).cast("long"),
        F.col("part").cast("long"),
        F.shiftright(F.col("place").bitwiseAND(F.lit((1 << 33) - 1)), 10),
    ]


def _drawn(rows: DataFrame, wanted: DataFrame, path: str) -> DataFrame:
    """The ``row`` numbers that the draw takes: of each source the first in key order, nearest to its ``rest``.

    rows: src, size, point (the key, 0 to 1), part, place; wanted: src, rest (tokens).
    """
    taken = []
    now = rows.join(wanted.where(F.col("rest") > 0), "src")
    for depth, digit in enumerate(_digits()):
        now = now.withColumn("bin", digit)
        sums = now.groupBy("src", "bin").agg(F.sum("size").alias("held"), F.max("rest").alias("rest"))
        order = Window.partitionBy("src").orderBy("bin")
        sums = sums.withColumn("upto", F.sum("held").over(order))
        # The bin that the budget ends in, if it ends in one.
        end = sums.where((F.col("upto") > F.col("rest")) & (F.col("upto") - F.col("held") <= F.col("rest")))
        end = end.groupBy("src").agg(F.min(F.struct("bin", (F.col("rest") - F.col("upto") + F.col("held")).alias("left"))).alias("end"))
        end = save(end.select("src", F.col("end.bin").alias("last"), F.col("end.left").alias("left")), f"{path}/end-{depth}")
        marked = now.join(end, "src", "left")
        taken.append(marked.where(F.col("last").isNull() | (F.col("bin") < F.col("last"))).select("place"))
        now = marked.where(F.col("bin") == F.col("last")).withColumn("rest", F.col("left")).drop("last", "left", "bin")
        now = save(now, f"{path}/in-{depth}")
    order = Window.partitionBy("src").orderBy("point", "part", "place")
    now = now.withColumn("upto", F.sum("size").over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    # Taken while that brings the source nearer to its budget.
    taken.append(now.where(F.col("upto") - F.col("size") / 2.0 <= F.col("rest")).select("place"))
    out = taken[0]
    for more in taken[1:]:
        out = out.unionByName(more)
    return out


def _mixed(rows: DataFrame, path: str, weights: tuple[float, ...], volume: float, max_epochs: float) -> DataFrame:
    """(place, source_size, target, times) for every row of ``rows(source, size, key, part, place)``."""
    sizes = rows.groupBy("source").agg(F.sum("size").alias("source_size"))
    plan = budgets(sizes, weights, volume, max_epochs)
    ratio = F.col("target") / F.nullif("source_size", F.lit(0))
    epochs = F.coalesce(F.floor(ratio), F.lit(0)).cast("long")
    plan = plan.withColumn("epochs", epochs).withColumn("rest", F.col("target") - F.col("epochs") * F.col("source_size"))
    # A source is named by a number from here on, so that a null source joins as any other.
    plan = save(plan.withColumn("src", F.monotonically_increasing_id()), f"{path}/plan")
    named = rows.join(plan.withColumnRenamed("source", "name"), F.col("source").eqNullSafe(F.col("name"))).drop("name", "source")
    drawn = _drawn(named.select("src", "size", "point", "part", "place"), plan.select("src", "rest"), path)
    drawn = drawn.withColumn("extra", F.lit(1))
    out = named.join(drawn, "place", "left")
    return out.withColumn("times", F.col("epochs") + F.coalesce("extra", F.lit(0)))


def _rows(docs: DataFrame, place: Column, id_col: str, source: str, text: str, quality: Column | None, seed: int) -> DataFrame:
    """What the mix needs of each row; ``place`` is its number, task first as in monotonically_increasing_id."""
    body = F.coalesce(F.col(quoted(text)), F.lit(""))
    weight = F.coalesce((quality if quality is not None else text_quality(body)).cast("double"), F.lit(0.0))
    weight = F.greatest(F.when(F.isnan(weight), F.lit(0.0)).otherwise(weight), F.lit(LEAST_QUALITY))
    # u in (0, 1]; the key k = -ln(u) / q orders as k / (1 + k) does, which lies in [0, 1) and keeps large keys apart.
    u = (F.shiftrightunsigned(F.xxhash64(F.lit(seed), F.col(quoted(id_col)), body), 11) + 1) / F.lit(float(1 << 53))
    return docs.select(
        F.col(quoted(id_col)).alias("id"),
        F.col(quoted(source)).alias("source"),
        F.regexp_count(body, F.lit(WORD_PATTERN)).cast("long").alias("size"),
        (-F.ln(u) / weight).alias("key"),
        place.alias("place"),
    ).select("id", "source", "size", (F.col("key") / (1.0 + F.col("key"))).alias("point"), "place", F.shiftright("place", 33).alias("part"))


def mix(
    docs: DataFrame,
    id_col: str = "doc_id",
    source: str = "source",
    text: str = "text",
    weights: tuple[float, ...] = WEIGHTS,
    volume: float = VOLUME,
    max_epochs: float = MAX_EPOCHS,
    quality: Column | None = None,
    seed: int = SEED,
) -> DataFrame:
    """One row per document: doc_id, size, source_size, target, taken, and times (how often it is taken)."""
    path = workspace(docs.sparkSession, "mixing")
    rows = _rows(docs, F.monotonically_increasing_id(), id_col, source, text, quality, seed)
    rows = save(rows, f"{path}/rows")
    out = _mixed(rows, path, weights, volume, max_epochs)
    taken = (F.col("size") * F.col("times")).cast("long").alias("taken")
    return out.select(F.col("id").alias(id_col), "size", F.col("source_size").cast("long"), "target", taken, F.col("times").cast("int"))


def mixed_documents(
    docs: DataFrame,
    id_col: str = "doc_id",
    source: str = "source",
    text: str = "text",
    weights: tuple[float, ...] = WEIGHTS,
    volume: float = VOLUME,
    max_epochs: float = MAX_EPOCHS,
    quality: Column | None = None,
    seed: int = SEED,
) -> DataFrame:
    """``docs`` with every row as often as the mix takes it."""
    path = workspace(docs.sparkSession, "mixed")
    rows, at_id, at_source, at_text = plain_names(docs.select("*", quality.alias("quality")) if quality is not None else docs, id_col, source, text)
    weight = F.col(rows.columns[-1]) if quality is not None else None
    # Written with the rows' numbers, so that these do not change when a task is run again.
    kept = save(rows.withColumn("place", F.monotonically_increasing_id()), f"{path}/docs")
    sized = save(_rows(kept, F.col("place"), at_id, at_source, at_text, weight, seed), f"{path}/rows")
    times = _mixed(sized, path, weights, volume, max_epochs).where(F.col("times") > 0).select("place", F.col("times").cast("int"))
    out = kept.join(times, "place").withColumn("times", F.explode(F.sequence(F.lit(1), F.col("times"))))
    return out.select(*rows.columns[: len(docs.columns)]).toDF(*docs.columns)
