"""Mixing sources to target weights by dependent (pivotal) rounding.

Every document of a source is to be taken target / source size times on average, a number that
is mostly no whole one. The fraction is rounded so that the source's words still add up to its
target: two documents with fractional probabilities p and q and sizes s and t move mass between
them (p gains d, q loses d * s / t) up or down at random until one probability is 0 or 1. The
two directions are drawn so that each probability keeps its expectation, and p * s + q * t never
changes, so a source ends with one fractional document and misses its target by less than that
document's size.

Rounding runs as a reduction tree. Leaves hold a bounded number of documents of one source, so
a source with a third of all rows is many leaves; each leaf leaves at most one fractional
document, a residual, and residuals meet in groups of FAN_IN until a source has one.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from siltworks.llm.common import cut, null_safe, ordered_prefix, table, word_count

LEAF_ROWS = 20_000
FAN_IN = 1_000
WEIGHTS = (3, 1, 2)


def source_targets(sizes: DataFrame, weights=WEIGHTS, share: float = 1.5, most: float = 2.0) -> DataFrame:
    """Targets by source from (source, size): source, source_size, target.

    Sources in code point order, null last, take `weights` in turn. Together they get `share`
    times all sizes; none gets more than `most` times its own size, and what exceeds that is
    reshared by weight until none is above. An empty table gives no rows. Each round of
    resharing is one small aggregate over the table of sources.
    """
    if share > most:
        raise ValueError("share exceeds what the sources may give")
    per_source = sizes.groupBy("source").agg(F.sum("size").cast("long").alias("source_size"))
    ranked, whole = ordered_prefix(per_source.withColumn("_null", F.col("source").isNull()), ["_null", "source"], "source_size")
    turn = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("row") % len(weights) + 1).cast("int"))
    ranked = cut(ranked.select("source", "source_size", turn.alias("weight"), (F.col("source_size") * most).alias("cap")))
    level = 0.0
    while True:
        full = F.col("weight") * level >= F.col("cap")
        s = ranked.agg(F.sum(F.when(full, F.col("cap"))).alias("caps"), F.sum(F.when(~full, F.col("weight"))).alias("open")).first()
        if not s["open"]:
            break
        new = (share * whole - (s["caps"] or 0.0)) / s["open"]
        if new <= level:
            break
        level = new
    return ranked.select("source", "source_size", F.least(F.col("weight") * level, F.col("cap")).alias("target"))


def _round_group(g: pd.DataFrame) -> pd.DataFrame:
    """Pivotal rounding within one group: `copies` ends whole for all rows but at most one."""
    # the largest come first, so that the one left over at the end tends to be small
    g = g.sort_values(["_mass", "_rank"], ascending=[False, True], kind="stable", ignore_index=True)
    p = g["_p"].to_numpy().copy()
    mass = g["_mass"].to_numpy()
    rng = np.random.default_rng(int(g["_rank"].iloc[0]) & (2**63 - 1))
    draw = rng.random(len(g) + 1)
    i = -1
    for j in np.flatnonzero((p > 0) & (p < 1)).tolist():
        if mass[j] == 0:
            p[j] = float(draw[j] < p[j])
            continue
        if i < 0:
            i = j
            continue
        s, t = mass[i], mass[j]
        up_i, up_j = (1 - p[i]) * s <= p[j] * t, p[i] * s <= (1 - p[j]) * t
        up = (1 - p[i]) * s if up_i else p[j] * t
        down = p[i] * s if up_j else (1 - p[j]) * t
        if draw[j] * (up + down) < down:
            p[i], p[j] = (1.0, p[j] - up / t) if up_i else (p[i] + up / s, 0.0)
        else:
            p[i], p[j] = (0.0, p[j] + down / t) if up_j else (p[i] - down / s, 1.0)
        # the one that stays fractional goes on; rounding errors count as whole
        p[i], p[j] = (round(x) if min(x, 1 - x) < 1e-12 else x for x in (p[i], p[j]))
        i = i if 0 < p[i] < 1 else j if 0 < p[j] < 1 else -1
    return g.assign(_p=p)


def round_copies(units: DataFrame) -> DataFrame:
    """Whole copies for units (source, _key, _mass, expected): adds copies, long.

    Expected copies keep their whole part; the fraction is rounded as the module describes.
    Draws depend on the units' keys alone, so reruns agree whatever the cluster.
    """
    spread = F.xxhash64("_key", F.lit("leaf"))
    n = units.count()
    fan, width = [], max(1, math.ceil(n / LEAF_ROWS))
    while True:
        fan.append(width)
        if width == 1:
            break
        width = math.ceil(width / FAN_IN)
    units = units.withColumns(
        {
            "_whole": F.floor("expected").cast("long"),
            "_p": F.col("expected") - F.floor("expected"),
            "_rank": spread,
            "_leaf": F.pmod(spread, F.lit(fan[0])).cast("long"),
        }
    )
    done = None
    for k, width in enumerate(fan):
        if k:
            units = units.withColumn("_leaf", F.pmod("_leaf", F.lit(width)))
        out = cut(units.groupBy("source", "_leaf").applyInPandas(_round_group, units.schema))
        if width == 1:
            # one fractional unit is left of each source; it is rounded on its own
            draw = F.pmod(F.xxhash64("_key", F.lit("last")), F.lit(1 << 30)) / float(1 << 30)
            out = out.withColumn("_p", F.when((F.col("_p") > 0) & (F.col("_p") < 1), (draw < F.col("_p")).cast("double")).otherwise(F.col("_p")))
            whole = out
        else:
            whole = out.where("_p <= 0 or _p >= 1")
            units = out.where("_p > 0 and _p < 1")
        done = whole if done is None else done.unionByName(whole)
    return done.withColumn("copies", F.col("_whole") + F.round("_p").cast("long")).drop("_whole", "_p", "_rank", "_leaf", "expected")


def mix_copies(docs: DataFrame, size: Column, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", **targets) -> DataFrame:
    """How often the mix takes each document: one row per distinct (id, text, source).

    Returns id, source, _key (checksum of id and text), size, rows (how many rows are equal),
    source_size, target, copies. Equal rows are one unit with the copies of all of them together,
    of which each gets the same number or one more (`copies_of`), so a much repeated row misses its
    share by less than one row's size. Null texts have size 0 and round on their own, null
    sources are one source, null ids are ids, and an empty table gives no rows.
    """
    keyed = docs.select(
        F.col(id_col).alias("doc_id"),
        F.col(source_col).cast("string").alias("source"),
        doc_key(id_col, text_col).alias("_key"),
        size.alias("size"),
    )
    units = cut(keyed.groupBy("doc_id", "source", "_key", "size").agg(F.count("*").alias("rows")))
    goal = cut(source_targets(units.select("source", (F.col("size") * F.col("rows")).alias("size")), **targets))
    joined = units.join(goal, null_safe(units, goal, ["source"])).drop(goal["source"])
    expected = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    return round_copies(joined.withColumn("_mass", F.col("size").cast("double")).withColumn("expected", expected * F.col("rows"))).drop("_mass")


def copies_of(rank: Column) -> Column:
    """The copies of one of a unit's equal rows, by its place among them from 0."""
    return F.floor(F.col("copies") / F.col("rows")).cast("long") + (rank < F.col("copies") % F.col("rows")).cast("long")


def doc_key(id_col: str, text_col: str) -> Column:
    return F.xxhash64(F.col(id_col), F.col(text_col), F.lit("key"))


def mix_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", **targets) -> DataFrame:
    """The mix itself: every row of docs as often as it is taken, with the columns of docs.

    Of rows that are equal in id, text and source but not in all columns, those of smaller hashes
    come first where some get one copy more. Rows equal in all columns are counted before they
    are ordered, so that many of them meet as one.
    """
    taken = mix_copies(docs, word_count(F.col(text_col)), id_col, text_col, source_col, **targets)
    taken = cut(taken.where("copies > 0").select(F.col("doc_id").alias("_id"), F.col("source").alias("_source"), F.col("_key").alias("_taken"), "copies", "rows"))
    keyed = docs.select(
        F.struct(*docs.columns).alias("_row"), F.col(id_col).alias("_doc"), F.col(source_col).cast("string").alias("_from"), doc_key(id_col, text_col).alias("_key")
    )
    match = (F.col("_key") == F.col("_taken")) & F.col("_doc").eqNullSafe(F.col("_id")) & F.col("_from").eqNullSafe(F.col("_source"))
    times = lambda n: F.explode(F.sequence(F.lit(1).cast("long"), n))
    alike = F.col("copies") % F.col("rows") == 0
    out = keyed.join(taken.where(alike), match).select("_row", times(F.floor(F.col("copies") / F.col("rows"))))
    uneven = taken.where(~alike)
    if not uneven.isEmpty():
        variants = keyed.join(uneven, match).groupBy("_row", "_taken", "_id", "_source", "copies", "rows").agg(F.count("*").alias("n"))
        order = Window.partitionBy("_taken", "_id", "_source").orderBy(F.xxhash64("_row"), "_row").rowsBetween(Window.unboundedPreceding, 0)
        placed = variants.withColumn("last", F.sum("n").over(order))
        more = F.least("n", F.greatest(F.col("copies") % F.col("rows") - F.col("last") + F.col("n"), F.lit(0)))
        n = F.floor(F.col("copies") / F.col("rows")).cast("long") * F.col("n") + more
        out = out.union(placed.withColumn("_n", n).where("_n > 0").select("_row", times(F.col("_n"))))
    return out.select("_row.*")


def op1(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    mixed = mix_copies(docs, word_count(F.col("text")))
    rows = mixed.withColumn("_rank", F.explode(F.sequence(F.lit(0).cast("long"), F.col("rows") - 1)))
    return rows.select("doc_id", "size", "source_size", "target", (copies_of(F.col("_rank")) * F.col("size")).alias("taken"), "source")
