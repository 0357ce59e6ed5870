"""Mixing sources to target weights by Pareto order sampling.

A source's target over its size is the number of times a document is taken on average.
Its whole part is taken for certain; for the rest, documents are ranked by their random
odds divided by their inclusion odds, and the first ones are taken as long as they stay
under the words that are missing; the last one is the document behind them whose size
fits best what is then missing. The rank is an integer, so the cut is found by adding up
sizes per range of ranks, three times for ever smaller ranges: no source is ever sorted.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lanelux.llm.common import table
from lanelux.session import settle

WEIGHTS = (3, 1, 2)
SHARE = 1.5
MOST = 2.0
WORD = r"[^\x20\x09-\x0D]+"
#: Bits of a rank, and those that each of the three searches settles.
RANK_BITS, STEP_BITS = 36, 12


def words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def random_unit(doc_id: Column, text: Column, seed: int) -> Column:
    """A number in (0, 1) that depends on the row's id and text only."""
    name = F.concat(
        F.lit(f"{seed}:"),
        F.coalesce(doc_id.cast("string"), F.lit("null")),
        F.lit(":"),
        F.md5(F.coalesce(text, F.lit("")).cast("binary")),
    )
    bits = F.conv(F.substring(F.md5(name.cast("binary")), 1, 13), 16, 10).cast("long")
    return (bits + 0.5) / float(1 << 52)


def _source(column: Column) -> Column:
    """A text that is never null and sorts as the source does, null last."""
    return F.when(column.isNull(), F.lit("b")).otherwise(F.concat(F.lit("a"), column.cast("string")))


def _ranked(sources: DataFrame) -> DataFrame:
    """``rank`` from 0 by ``key``, for any number of sources: ranges are numbered, then rows in each."""
    dealt = settle(sources.repartitionByRange("key").withColumn("range", F.spark_partition_id()), "sources")
    sizes = dealt.groupBy("range").agg(F.count(F.lit(1)).alias("n"))
    before = Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)  # one row per partition
    sizes = sizes.select("range", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    own = F.row_number().over(Window.partitionBy("range").orderBy("key")) - 1
    return dealt.join(sizes, "range").select("key", "source_size", (own + F.col("before")).alias("rank"))


def targets(sizes: DataFrame, weights: tuple[float, ...] = WEIGHTS, share: float = SHARE, most: float = MOST) -> DataFrame:
    """Per source key of ``sizes`` (key, size): source_size and target.

    Weights repeat in the order of the keys. Sources share ``share`` times all sizes by weight; none
    gets more than ``most`` times its own size, and what is over is shared again by the others.
    """
    sources = sizes.groupBy("key").agg(F.sum("size").alias("source_size"))
    choices = F.array(*(F.lit(float(w)) for w in weights))
    ranked = _ranked(sources).withColumn("weight", F.get(choices, (F.col("rank") % len(weights)).cast("int")))
    ranked = settle(ranked.withColumn("full_at", most * F.col("source_size") / F.col("weight")), "weighted-sources")
    level, full = None, -1
    while True:
        above = F.lit(False) if level is None else F.col("full_at") < level
        now = ranked.agg(
            F.sum("source_size").alias("all"),
            F.coalesce(F.sum(F.when(above, F.col("source_size"))), F.lit(0)).alias("taken"),
            F.coalesce(F.sum(F.when(~above, F.col("weight"))), F.lit(0.0)).alias("weight"),
            F.count(F.when(above, F.lit(1))).alias("full"),
        ).first()
        if not now["weight"] or now["full"] == full:
            break
        full = now["full"]
        level = (share * now["all"] - most * now["taken"]) / now["weight"]
    level = float(level or 0.0)
    capped = F.col("full_at") < F.lit(level)
    target = F.when(capped, most * F.col("source_size")).otherwise(level * F.col("weight"))
    return ranked.select("key", "source_size", target.alias("target"))


def _rank(unit: Column, odds: Column) -> Column:
    """Random odds over inclusion odds, mapped to whole numbers in the same order."""
    quotient = unit / (1 - unit) / odds
    return F.floor(quotient / (1 + quotient) * float(1 << RANK_BITS)).cast("long")


def _search(ranked: DataFrame, open_: DataFrame, strict: bool = False) -> DataFrame:
    """Per key of ``open_`` (key, missing) the last rank (cut) under which sizes are less than ``missing``, and what is
    missing there; with ``strict``, not more than ``missing``. No row for a key whose sizes do not reach it."""
    found = open_.select("key", "missing", F.lit(0).cast("long").alias("range"))
    reached = "total > missing and total - size <= missing" if strict else "total >= missing and total - size < missing"
    for level in range(RANK_BITS // STEP_BITS):
        shift = RANK_BITS - STEP_BITS * (level + 1)
        narrow = ranked.withColumn("range", F.shiftright("rank", shift + STEP_BITS)).join(
            found.withColumnRenamed("range", "in_range"), "key"
        )
        narrow = narrow.where(F.col("range") == F.col("in_range")) if level else narrow
        summed = narrow.groupBy("key", "missing", F.shiftright("rank", shift).alias("range")).agg(F.sum("size").alias("size"))
        total = F.sum("size").over(Window.partitionBy("key").orderBy("range"))  # at most 4096 rows per source
        summed = summed.withColumn("total", total).where(reached)
        missing = F.col("missing") - (F.col("total") - F.col("size"))
        found = settle(summed.select("key", missing.alias("missing"), "range"), "cuts")
    return found.select("key", "missing", (F.col("range") - 1).alias("cut"))


def _in_rounds(rank: Column, size: Column, rounds: Column) -> Column:
    return F.coalesce(F.exists(rounds, lambda r: (rank > r["above"]) & (rank <= r["to"]) & (size <= r["most"])), F.lit(False))


def _refilled(ranked: DataFrame, cuts: DataFrame) -> DataFrame:
    """``cuts`` with what is missing and the ``rounds`` in which documents behind the cut were taken until none fits.

    A round takes documents no longer than what is missing, in the order of ranks up to the first that does
    not fit, which is passed over. So what is missing shrinks with each, in all sources at once.
    """
    kind = "array<struct<above:bigint,to:bigint,most:double>>"
    state = settle(cuts.withColumns({"at": F.col("cut"), "rounds": F.array().cast(kind)}), "mix-rounds")
    while True:
        open_ = state.where("missing >= 1").select("key", "missing", "at")
        left = ranked.join(open_, "key").where("rank > at and size between 1 and missing").select("key", "size", "rank")
        left = settle(left, "mix-left")
        if left.isEmpty():
            return state.drop("at")
        sums = settle(left.groupBy("key").agg(F.sum("size").alias("all"), F.max("rank").alias("end")), "mix-left-sums")
        more = open_.join(sums, "key").where("all > missing").select("key", "missing")
        stops = _search(left, more, strict=True).select("key", F.col("cut").alias("stop"), F.col("missing").alias("rest"))
        to = F.coalesce("stop", "end")
        own = F.array(F.struct(F.col("at").alias("above"), to.alias("to"), F.col("missing").alias("most"))).cast(kind)
        taken = state.join(sums, "key", "left").join(stops, "key", "left")
        ran = F.col("all").isNotNull()
        state = settle(
            taken.select(
                "key",
                "cut",
                F.when(ran, F.coalesce("rest", F.col("missing") - F.col("all"))).otherwise(F.col("missing")).alias("missing"),
                F.when(ran, F.coalesce(F.col("stop") + 1, "end")).otherwise(F.col("at")).alias("at"),
                F.when(ran, F.concat("rounds", own)).otherwise(F.col("rounds")).alias("rounds"),
            ),
            "mix-rounds",
        )


def _cuts(sizes: DataFrame, plan: DataFrame, refill: bool = False) -> DataFrame:
    """Per source key that takes only some documents once more: ``cut``, the last rank taken whatever its size,
    and ``last``, the rank behind it whose size fits the words still missing best (null: none fits better than none).
    With ``refill``, also ``rounds``: documents taken behind the cut before ``last`` is looked for."""
    open_ = plan.where("missing > 0").select("key", "odds", "missing")
    ranked = sizes.join(open_, "key").select("key", "size", _rank(F.col("unit"), F.col("odds")).alias("rank"))
    ranked = settle(ranked, "ranked-sizes")
    cuts = _search(ranked, open_)
    cuts = _refilled(ranked, cuts) if refill else cuts
    over = F.abs(F.col("size") - F.col("missing"))
    rest = ranked.join(cuts, "key").where((F.col("rank") > F.col("cut")) & (over < F.col("missing")))
    rest = rest.where(~_in_rounds(F.col("rank"), F.col("size"), F.col("rounds"))) if refill else rest
    fits = rest.groupBy("key").agg(F.min_by("rank", F.struct(over, "rank")).alias("last"))
    return cuts.drop("missing").join(fits, "key", "left")


def plan_mix(
    docs: DataFrame,
    weights: tuple[float, ...] = WEIGHTS,
    share: float = SHARE,
    most: float = MOST,
    seed: int = 11,
    refill: bool = False,
) -> DataFrame:
    """One row per source: key, source_size, target, whole (sure copies), odds, cut and last (ranks taken once more).

    With ``refill``, ``rounds`` go on behind the cut until no document fits what is missing, so one very long
    document leaves no gap. ``op5_mixing`` is without, as its SQL is.
    """
    text = F.col("text").cast("string")
    sizes = docs.select(
        _source(F.col("source")).alias("key"),
        words(text).alias("size"),
        random_unit(F.col("doc_id"), text, seed).alias("unit"),
    )
    sizes = settle(sizes, "sizes")
    aims = targets(sizes, weights, share, most)
    copies = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    whole = F.floor(copies)
    plan = aims.withColumns({"whole": whole, "odds": F.when(copies > whole, (copies - whole) / (1 - (copies - whole)))})
    plan = plan.withColumn("missing", F.when(F.col("odds").isNotNull(), F.col("target") - F.col("whole") * F.col("source_size")).otherwise(0.0))
    plan = settle(plan, "mix-plan")
    return settle(plan.join(_cuts(sizes, plan, refill), "key", "left"), "mix-cuts")


def mix(docs: DataFrame, plan: DataFrame, seed: int = 11) -> DataFrame:
    """``docs`` with ``_mix``: size, source_size, target, copies, taken of each row.

    A source's words taken are near its target: the first document that does not fit is left out (and, by a plan with
    ``refill``, those behind it that fit are taken). No row is
    taken more than ``most`` times. The choice depends on a row's id and text only, so runs agree and
    equal rows are taken alike. A null text has size 0; null sources are one source, the last; null
    ids are as good as others. An empty table gives no rows. Other columns stay as they are.
    """
    text = F.col("text").cast("string")
    named = docs.withColumns(
        {"_mix_key": _source(F.col("source")), "_mix_size": words(text), "_mix_unit": random_unit(F.col("doc_id"), text, seed)}
    )
    rounds = ["rounds"] if "rounds" in plan.columns else []
    own = plan.select(F.col("key").alias("_mix_of"), F.struct("source_size", "target", "whole", "odds", "cut", "last", *rounds).alias("_mix_plan"))
    joined = named.join(own, F.col("_mix_key") == F.col("_mix_of")).drop("_mix_of")
    rank = _rank(F.col("_mix_unit"), F.col("_mix_plan.odds"))
    more = F.coalesce(rank <= F.col("_mix_plan.cut"), F.lit(False)) | rank.eqNullSafe(F.col("_mix_plan.last"))
    if rounds:
        more = more | _in_rounds(rank, F.col("_mix_size"), F.col("_mix_plan.rounds"))
    more = more & rank.isNotNull()
    copies = F.col("_mix_plan.whole") + more.cast("long")
    fields = {
        "size": F.col("_mix_size"),
        "source_size": F.col("_mix_plan.source_size"),
        "target": F.col("_mix_plan.target"),
        "copies": copies,
        "taken": copies * F.col("_mix_size"),
    }
    made = F.struct(*(c.alias(n) for n, c in fields.items()))
    return joined.withColumn("_mix", made).drop("_mix_key", "_mix_size", "_mix_unit", "_mix_plan")


def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents mixed to 150% of their words."""
    docs = table(spark, sf_dir, "documents")
    return mix(docs, plan_mix(docs, refill=True)).select("doc_id", "_mix.size", "_mix.source_size", "_mix.target", "_mix.taken")


OP5_SQL = r"""
WITH RECURSIVE d AS (
    SELECT doc_id, CASE WHEN source IS NULL THEN 'b' ELSE 'a' || source END AS key,
           len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
           (('0x' || substr(md5('11:' || coalesce(doc_id::VARCHAR, 'null') || ':' || md5(coalesce(text, ''))), 1, 13))::BIGINT
            + 0.5::DOUBLE) / 4503599627370496::DOUBLE AS unit
    FROM documents
), s AS (
    SELECT key, sum(size)::BIGINT AS source_size,
           [3.0::DOUBLE, 1.0, 2.0][((row_number() OVER (ORDER BY key) - 1) % 3 + 1)::INT] AS weight
    FROM d GROUP BY key
), o AS (
    SELECT *, 2.0::DOUBLE * source_size / weight AS full_at FROM s
), levels AS (
    SELECT (1.5::DOUBLE * (SELECT sum(source_size) FROM o) - 2.0::DOUBLE * coalesce(sum(source_size) FILTER (o.full_at < c.edge), 0))
           / sum(weight) FILTER (o.full_at >= c.edge) AS level, c.edge
    FROM o CROSS JOIN (SELECT DISTINCT full_at AS edge FROM o) AS c GROUP BY c.edge
), level AS (
    SELECT min(level) AS level FROM levels
    WHERE (SELECT count(*) FROM o WHERE full_at < level) = (SELECT count(*) FROM o WHERE full_at < edge)
), t AS (
    SELECT key, source_size,
           CASE WHEN full_at < level THEN 2.0::DOUBLE * source_size ELSE level * weight END AS target
    FROM o, level
), p AS (
    SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END AS whole,
           CASE WHEN source_size > 0 THEN target / source_size - floor(target / source_size) ELSE 0 END AS part FROM t
), r AS (
    SELECT d.*, p.source_size, p.target, p.whole, p.part, p.target - p.whole * p.source_size AS missing,
           unit / (1 - unit) / (part / (1 - part)) AS quotient
    FROM d JOIN p USING (key)
), k AS (
    SELECT *, CASE WHEN part > 0 THEN floor(quotient / (1 + quotient) * 68719476736::DOUBLE)::BIGINT END AS rank FROM r
), c AS (
    SELECT *, sum(size) OVER (PARTITION BY key ORDER BY rank) AS total,
           sum(size) OVER (PARTITION BY key, rank) AS own FROM k
), f AS (
    SELECT key, rank - 1 AS cut, missing - (total - own) AS missing
    FROM c WHERE part > 0 AND total >= missing AND total - own < missing GROUP BY ALL
), g AS (
    SELECT c.key, c.rank, sum(size)::BIGINT AS total, row_number() OVER (PARTITION BY c.key ORDER BY c.rank) AS pos
    FROM c JOIN f USING (key) WHERE c.rank > f.cut AND size > 0 GROUP BY c.key, c.rank
), walk AS (
    SELECT key, 0::BIGINT AS pos, missing, NULL::BIGINT AS rank FROM f
    UNION ALL
    SELECT g.key, g.pos, CASE WHEN g.total <= walk.missing THEN walk.missing - g.total ELSE walk.missing END,
           CASE WHEN g.total <= walk.missing THEN g.rank END
    FROM walk JOIN g ON g.key = walk.key AND g.pos = walk.pos + 1
), e AS (
    SELECT key, min(missing) AS missing FROM walk GROUP BY key
), w AS (
    SELECT DISTINCT key, rank, true AS filled FROM walk WHERE rank IS NOT NULL
), l AS (
    SELECT key, first(rank ORDER BY abs(size - e.missing), rank) AS last
    FROM c JOIN f USING (key) JOIN e USING (key) LEFT JOIN w USING (key, rank)
    WHERE rank > cut AND abs(size - e.missing) < e.missing AND filled IS NULL GROUP BY key
)
SELECT doc_id, size, source_size, target,
       (size * (whole + CASE WHEN coalesce(rank <= cut, false) OR coalesce(filled, false) OR coalesce(rank = last, false)
        THEN 1 ELSE 0 END))::BIGINT AS taken
FROM c LEFT JOIN f USING (key) LEFT JOIN l USING (key) LEFT JOIN w USING (key, rank)
"""
