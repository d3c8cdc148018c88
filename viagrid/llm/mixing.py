"""Mixing sources to target weights by the cube method.

A source's target over its size says how often its documents are taken: the
whole part surely, the rest as an inclusion probability. Those probabilities move
through the null space of two balancing constraints, documents and words, until
they are 0 or 1. Documents fly in blocks of bounded size; the few that a block
cannot settle go on to the next level, until one block per source is left, whose
last units land.
"""

from __future__ import annotations

import random
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from viagrid.llm.components import stored
from viagrid.llm.neardup import groups_of

#: Weights of the sources in the order of their names, repeating.
WEIGHTS = (3, 1, 2)
#: Words taken over all words, and the most that a source is taken.
SHARE, MOST = 1.5, 2.0
#: Documents that fly together.
BLOCK = 2048
WORD = r"[^\x20\x09-\x0D]+"
_EDGE = 1e-9


def n_words(text: Column) -> Column:
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(WORD)).cast("long")


def targets(sized: DataFrame, weights=WEIGHTS, share: float = SHARE, most: float = MOST) -> DataFrame:
    """stratum, source, n, source_size and target of every source; null is the last source.

    Weights go round the sources by code point. A target above ``most`` times the
    source's size stops there, and what is over goes to the others by weight. One
    row per source is all that is gathered; a source of no words has target 0.
    """
    spark = sized.sparkSession
    per = sized.groupBy("source").agg(F.count(F.lit(1)).alias("n"), F.sum("size").alias("source_size"))
    stratum = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.element_at(F.array(*(F.lit(float(w)) for w in weights)), (F.col("stratum") % len(weights) + 1).cast("int"))
    ranked = per.withColumn("stratum", stratum.cast("int")).withColumn("weight", weight)
    ranked = stored(spark, ranked.withColumn("cap", most * F.col("source_size")), "sources")
    wanted = share * float(ranked.agg(F.sum("source_size")).first()[0] or 0)
    level = 0.0
    while True:
        full = F.col("cap") <= level * F.col("weight")
        over = ranked.agg(F.sum(F.when(full, F.col("cap"))), F.sum(F.when(~full, F.col("weight")))).first()
        above = (wanted - (over[0] or 0.0)) / over[1] if over[1] else level
        if above <= level:
            break
        level = above
    return ranked.withColumn("target", F.least("cap", level * F.col("weight"))).select("stratum", "source", "n", "source_size", "target")


def fly(sizes: list[float], chances: list[float], rng: random.Random, land: bool) -> list[float]:
    """Inclusion after the flight: 0, 1, or still between for two units at most (none with ``land``).

    Three units at a time move along the direction that keeps both their count
    and their words; two move along one that keeps their words (or count, if of
    equal size), once no three are left and the flight has to land.
    """
    p = list(chances)
    waiting = [k for k in range(len(p)) if _EDGE < p[k] < 1 - _EDGE]
    active: list[int] = []

    def move(units: list[int], along: list[float]) -> None:
        up = min((1 - p[k]) / d if d > 0 else -p[k] / d for k, d in zip(units, along) if d)
        down = min(p[k] / d if d > 0 else (p[k] - 1) / d for k, d in zip(units, along) if d)
        step = up if rng.random() * (up + down) < down else -down
        for k, d in zip(units, along):
            p[k] += step * d
            if p[k] < _EDGE or p[k] > 1 - _EDGE:
                p[k] = round(p[k])

    while True:
        active = [k for k in active if 0 < p[k] < 1]
        while len(active) < 3 and waiting:
            active.append(waiting.pop())
        if len(active) == 3:
            a, b, c = (sizes[k] for k in active)
            along = [b - c, c - a, a - b]
            most = max(map(abs, along))
            move(active, [x / most for x in along] if most else [1.0, -1.0, 0.0])
        elif len(active) == 2 and (land or sizes[active[0]] == sizes[active[1]]):
            a, b = (sizes[k] for k in active)
            most = max(a, b)
            move(active, [b / most, -a / most] if most else [1.0, -1.0])
        elif len(active) == 1 and land:
            move(active, [1.0])
        else:
            return p


def _flown(seed: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (stratum, block), group in groups_of(batches, 2):
            sizes, chances = np.asarray(group.column("size"), dtype=float).tolist(), group.column("chance").to_pylist()
            last = bool(group.column("last")[0].as_py())
            after = fly(sizes, chances, random.Random(f"{seed}:{stratum}:{block}:{last}"), last)
            columns = [c.combine_chunks() for c in group.drop_columns(["chance", "block", "last"]).columns]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(after, pa.float64())], names=["stratum", "unit", "doc_id", "size", "chance"])

    return run


def sized(docs: DataFrame) -> DataFrame:
    """unit, doc_id, source and size of every row; a row without an id is known by its text's hash."""
    doc = F.col("doc_id").cast("long")
    unit = F.coalesce(doc, F.xxhash64(F.coalesce("text", F.lit(""))))
    return docs.select(unit.alias("unit"), doc.alias("doc_id"), F.col("source").cast("string").alias("source"), n_words(F.col("text")).alias("size"))


def copies(docs: DataFrame, seed: int = 1, block: int = BLOCK) -> DataFrame:
    """unit, doc_id, source, size, source_size, target and taken (words) of every row of ``docs``.

    A null text has size 0 and takes no words; a null source is a source, the last;
    repeated rows are units of their own. The draw depends on ids, sizes and
    ``seed`` alone, so reruns agree whatever the partitions.
    """
    spark = docs.sparkSession
    rows = stored(spark, sized(docs), "sizes")
    goals = stored(spark, targets(rows), "targets")
    ratio = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    whole = F.floor(ratio + _EDGE)
    rate = goals.select("stratum", "source", whole.alias("whole"), F.greatest(ratio - whole, F.lit(0.0)).alias("chance"))
    placed = rows.join(rate, rows["source"].eqNullSafe(rate["source"]))
    open_ = placed.select("stratum", "unit", "doc_id", "size", "chance")
    settled = None
    left, level = goals.select("stratum", "n"), 0
    while True:
        blocks = F.ceil(F.col("n") / block).cast("long")
        most = left.agg(F.max(blocks)).first()[0]
        if not most:
            break
        dealt = open_.join(left, "stratum").withColumn("block", F.pmod(F.xxhash64("unit", "size", F.lit(seed + level)), blocks))
        dealt = dealt.select("stratum", "block", "unit", "doc_id", "size", "chance", (blocks == 1).alias("last"))
        mark = F.xxhash64("unit", "size", F.lit(seed + level + 1000))
        flown = dealt.repartition("stratum", "block").sortWithinPartitions("stratum", "block", mark, "unit", "size")
        kind = "stratum int, unit long, doc_id long, size long, chance double"
        flown = stored(spark, flown.mapInArrow(_flown(seed + level), kind), "flown")
        done = flown.where("chance in (0.0, 1.0)")
        settled = done if settled is None else settled.union(done)
        if most == 1:
            break
        open_ = flown.where("chance not in (0.0, 1.0)")
        left = stored(spark, open_.groupBy("stratum").agg(F.count(F.lit(1)).alias("n")), "left")
        level += 1
    if settled is None:
        settled = open_
    taken = F.col("size") * (F.col("whole") + F.col("chance").cast("long"))
    full = goals.join(rate.select("stratum", "whole"), "stratum")
    return settled.join(full, "stratum").select("unit", "doc_id", "source", "size", "source_size", "target", taken.cast("long").alias("taken"))


def mixed(docs: DataFrame, seed: int = 1) -> DataFrame:
    """The rows of ``docs``, each as often as the mix takes it; documents without words go.

    Decisions find their rows by id (by the text's hash where it is null); rows
    that share an id are numbered by source and size on both sides.
    """
    drawn = copies(docs, seed)
    keys = ("unit", "source", "size", "nth")
    nth = F.row_number().over(Window.partitionBy("unit", "source", "size").orderBy("taken"))
    wanted = drawn.where("taken > 0").withColumn("nth", nth).withColumn("times", (F.col("taken") / F.col("size")).cast("int"))
    wanted = wanted.select(*(F.col(k).alias(f"__{k}") for k in keys), "times").withColumnRenamed("times", "__times")
    size, doc = n_words(F.col("text")), F.col("doc_id").cast("long")
    own = docs.withColumns({"__u": F.coalesce(doc, F.xxhash64(F.coalesce("text", F.lit("")))), "__s": F.col("source").cast("string"), "__z": size})
    own = own.withColumn("__n", F.row_number().over(Window.partitionBy("__u", "__s", "__z").orderBy(F.xxhash64("text"))))
    same = (F.col("__u") == F.col("__unit")) & F.col("__s").eqNullSafe(F.col("__source")) & (F.col("__z") == F.col("__size")) & (F.col("__n") == F.col("__nth"))
    joined = own.join(wanted, same)
    return joined.withColumn("__copy", F.explode(F.sequence(F.lit(1), F.col("__times")))).select(*docs.columns)
