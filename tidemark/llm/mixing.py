"""Mixing sources to target weights by pivotal dependent rounding; DataFrame functions only.

A source's target divided by its size is the expected number of copies of each of its
documents.  The whole part is taken for certain.  The fractions are rounded together: two
documents trade words, one's chance growing as the other's shrinks, in a random direction
whose expectation is zero, until one chance is 0 or 1; the other goes on to the next pair.
Words are conserved at every trade, so a source misses its target by less than one
document.  Pairs are folded in bounded chunks and the one open document of each chunk goes
to the next level, so the residuals of a source meet in a reduction tree of a few levels.

Randomness is a hash of the document and the level: reruns agree.

Defined cases: a null text has size 0 and is never taken; null sources form a source of
their own, last in order; rows that agree in id, source and size are rounded as one unit
and get the same answer; a source without words has target 0; an empty table gives no
rows.  Only id, source and text are read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import scratch_path
from .scratch import unused

WEIGHTS = (5, 2, 1)
SHARE = 1.5
CAP = 2.0
#: Documents folded by one row of a level (mean).
FAN_IN = 256
SEED = 20240611
_TINY = 1e-9


def word_count(text: str | Column) -> Column:
    col = F.col(text) if isinstance(text, str) else text
    return F.coalesce(F.regexp_count(col, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE,
                   cap: float = CAP) -> DataFrame:
    """(source, source_size, n_units, target) from units (source, size, copies_of_row).

    Weighted shares of ``share`` x all words; what exceeds ``cap`` x a source's size is
    shared out again by weight.  That is one water level: sources are put in the order in
    which a rising level would fill them, and the level stands where the rest can take
    what the full ones leave.  The windows see one row per source."""
    by_source = sizes.groupBy("source").agg(
        F.sum(F.col("size") * F.col("rows")).alias("source_size"),
        F.count(F.when(F.col("size") > 0, 1)).alias("n_units"))
    weight = F.element_at(F.array(*map(F.lit, weights)), F.col("place") % len(weights) + 1)
    everyone = Window.partitionBy()
    by_name = Window.orderBy(F.col("source").isNull(), "source")
    fill = Window.orderBy("full_at", "place")
    before = fill.rowsBetween(Window.unboundedPreceding, -1)
    onward = fill.rowsBetween(0, Window.unboundedFollowing)
    return (by_source
            .withColumn("place", F.row_number().over(by_name) - 1)
            .withColumn("weight", weight.cast("double"))
            .withColumn("most", cap * F.col("source_size"))
            .withColumn("full_at", F.col("most") / F.col("weight"))
            .withColumn("level", (share * F.sum("source_size").over(everyone)
                                  - F.coalesce(F.sum("most").over(before), F.lit(0.0)))
                        / F.sum("weight").over(onward))
            .withColumn("order", F.row_number().over(fill))
            .withColumn("water", F.min_by(
                F.col("level"), F.when(F.col("level") <= F.col("full_at"), F.col("order")))
                .over(everyone))
            .select("source", "source_size", "n_units", F.least(
                F.col("most"), F.coalesce(F.col("weight") * F.col("water"), F.col("most")))
                .alias("target")))


def _uniform(level: int) -> Column:
    """Hash of the unit and level as a number in [0, 1)."""
    h = F.xxhash64(F.lit(SEED), F.lit(level), F.col("doc_id"), F.col("source"), F.col("size"))
    return F.shiftrightunsigned(h, 11).cast("double") / float(1 << 53)


_UNIT = "struct<mass: double, r: double, doc_id: {id}, size: bigint, rows: bigint, chance: double>"


def _trade(state: Column, unit: Column, kind: str) -> Column:
    """Pair the open unit of ``state`` with ``unit``; what becomes integral is done."""
    held = state["open"]
    up = F.least((1 - held["chance"]) * held["mass"], unit["chance"] * unit["mass"])
    down = F.least(held["chance"] * held["mass"], (1 - unit["chance"]) * unit["mass"])
    moved = F.when(unit["r"] * (up + down) < down, up).otherwise(-down)
    a = held["chance"] + moved / held["mass"]
    b = unit["chance"] - moved / unit["mass"]

    def settled(chance: Column) -> Column:
        return (chance < _TINY) | (chance > 1 - _TINY)

    def at(u: Column, chance: Column) -> Column:
        return F.struct(u["mass"].alias("mass"), u["r"].alias("r"), u["doc_id"].alias("doc_id"),
                        u["size"].alias("size"), u["rows"].alias("rows"),
                        F.when(chance < _TINY, 0.0).when(chance > 1 - _TINY, 1.0)
                        .otherwise(chance).alias("chance"))

    nobody = F.lit(None).cast(kind)
    traded = F.struct(
        F.when(~settled(b), at(unit, b)).when(~settled(a), at(held, a)).otherwise(nobody)
        .alias("open"),
        F.concat(state["done"],
                 F.when(settled(a), F.array(at(held, a))).otherwise(F.array().cast(f"array<{kind}>")),
                 F.when(settled(b), F.array(at(unit, b))).otherwise(F.array().cast(f"array<{kind}>")))
        .alias("done"))
    first = F.struct(unit.alias("open"), state["done"].alias("done"))
    return F.when(held.isNull(), first).otherwise(traded)


def allocate(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE,
             cap: float = CAP, key: str = "doc_id", source: str = "source",
             text: str = "text") -> DataFrame:
    """Units (doc_id, source, size) with ``rows`` (how many rows are this unit),
    ``source_size``, ``target`` and ``copies`` to take of each row."""
    spark = docs.sparkSession
    sized = scratch_path(spark, "mix-sizes")
    (docs.select(F.col(key).alias("doc_id"), F.col(source).alias("source"),
                 word_count(text).alias("size"))
     .groupBy("doc_id", "source", "size").agg(F.count("*").alias("rows")).write.parquet(sized))
    units = spark.read.parquet(sized)
    planned = scratch_path(spark, "mix-targets")
    source_targets(units, weights, share, cap).write.parquet(planned)
    targets = spark.read.parquet(planned)
    largest = targets.agg(F.max("n_units")).first()[0] or 0

    copies = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    whole = F.floor(copies + _TINY)
    planned_units = (units.join(targets.withColumnRenamed("source", "of"),
                                F.col("source").eqNullSafe(F.col("of"))).drop("of")
                     .withColumn("whole", whole.cast("long"))
                     .withColumn("chance", F.greatest(copies - F.col("whole"), F.lit(0.0))))
    open_unit = (F.col("size") > 0) & (F.col("chance") > _TINY)
    shared = ["source", "source_size", "n_units", "target", "whole"]
    result = ["doc_id", "source", "size", "rows", "source_size", "target", "copies"]
    parts = [planned_units.filter(~open_unit)
             .withColumn("copies", F.when(F.col("size") > 0, F.col("whole")).otherwise(F.lit(0)))
             .select(*result)]

    kind = _UNIT.format(id=units.schema["doc_id"].dataType.simpleString())
    rest, level, reach = planned_units.filter(open_unit), 0, FAN_IN
    while largest:
        last = reach >= largest
        chunks = F.greatest(F.lit(1), F.ceil(F.col("n_units") / F.lit(reach))).cast("long")
        unit = F.struct((F.col("size") * F.col("rows")).cast("double").alias("mass"),
                        _uniform(level).alias("r"), "doc_id", "size", "rows", "chance")
        folded = F.aggregate(
            # large documents first, so that the one left open is small
            F.sort_array("units", asc=False),
            F.struct(F.lit(None).cast(kind).alias("open"),
                     F.array().cast(f"array<{kind}>").alias("done")),
            lambda state, u: _trade(state, u, kind))
        path = scratch_path(spark, f"mix-level{level}")
        (rest.withColumn("chunk", F.pmod(F.xxhash64(F.lit(level), "doc_id", "size"), chunks))
         .groupBy(*shared, "chunk").agg(F.collect_list(unit).alias("units"))
         .select(*shared, folded.alias("state")).write.parquet(path))
        done = spark.read.parquet(path)
        settled = done.select(*shared, F.explode("state.done").alias("u"))
        rest = done.filter(F.col("state.open").isNotNull()).select(*shared, "state.open.*")
        if last:  # one open unit per source: its chance decides
            settled = settled.unionByName(rest.select(*shared, F.struct(
                "mass", "r", "doc_id", "size", "rows",
                F.when(_uniform(level + 1) < F.col("chance"), 1.0).otherwise(0.0).alias("chance"))
                .alias("u")))
        parts.append(settled.select("*", "u.doc_id", "u.size", "u.rows")
                     .withColumn("copies", F.col("whole") + F.col("u.chance").cast("long"))
                     .select(*result))
        if last:
            break
        level, reach = level + 1, reach * FAN_IN
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def mix(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE,
        cap: float = CAP, key: str = "doc_id", source: str = "source",
        text: str = "text") -> DataFrame:
    """The mixture itself: every row as often as it is taken."""
    words, copy = unused(docs, "_words"), unused(docs, "_copy")
    taken = allocate(docs, weights, share, cap, key, source, text).filter("copies > 0").select(
        *(F.col(c).alias(unused(docs, f"_{c}")) for c in ("doc_id", "source", "size", "copies")))
    same = [F.col(x).eqNullSafe(F.col(y)) for x, y in
            zip((key, source, words), taken.columns, strict=False)]
    return (docs.withColumn(words, word_count(text)).join(taken, same)
            .withColumn(copy, F.explode(F.sequence(F.lit(1).cast("long"), F.col(taken.columns[3]))))
            .select(*docs.columns))
