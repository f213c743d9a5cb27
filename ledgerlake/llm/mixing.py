"""Problem 7: sources mixed to target shares of all tokens by entropy balancing.

Documents start from the rate their source would have if shares were counted in documents. Of all rates that meet the
token target of every source, those nearest to the start in relative entropy are the start tilted exponentially in the
document's tokens, ``q exp(l x)``, and no more than the source's repetitions. The dual has one unknown for each source;
its Newton steps are aggregates over the histogram of document lengths, so an iteration moves a row for each source.
Rates become copies by systematic rounding along the documents ordered by length, which keeps every source's tokens
within one longest document of its target.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerlake.llm.bpe import TOKENIZERS, encode
from ledgerlake.session import cut
from ledgerlake.sources.tables import table

#: Sources a mix may have; their targets are held by the driver.
MOST_SOURCES = 10_000
#: Newton steps at most, relative error of a source's tokens at which it ends.
STEPS, ERROR = 60, 1e-9
#: Documents that a part of a group of equal lengths should hold, and least parts of one.
PART_DOCS, LEAST_PARTS = 1_000_000, 64
#: Exponents beyond this are cut; the rate is at its bound long before.
LARGEST_EXPONENT = 60.0


def targets_of(mix: DataFrame) -> dict[str, tuple[float, int]]:
    """Source -> (weight, repetitions): weights that are null or not positive leave the mix, repetitions are 1 at least."""
    rows = mix.select("source", "poids", "repetitions_max").limit(MOST_SOURCES + 1).collect()
    if len(rows) > MOST_SOURCES:
        raise ValueError("too many sources for one mix")
    return {r.source: (float(r.poids), max(1, int(r.repetitions_max or 1))) for r in sorted(rows, key=lambda r: str(r.source)) if r.source is not None and r.poids and r.poids > 0}


def by_source(values: dict[str, float]) -> Column:
    return F.create_map(*[x for s, v in values.items() for x in (F.lit(s), F.lit(float(v)))])[F.col("source")]


def budgets(tokens: dict[str, int], mix: dict[str, tuple[float, int]], total: float | None = None) -> dict[str, float]:
    """Tokens each source with tokens must give: its weight among these sources of ``total``, by default the most that
    all of them can give within their repetitions. A larger ``total`` leaves small sources at their bound."""
    present = {s: mix[s] for s in mix if tokens.get(s, 0) > 0}
    weight = sum(w for w, _ in present.values())
    if not present:
        return {}
    most = min(cap * tokens[s] * weight / w for s, (w, cap) in present.items())
    return {s: min((most if total is None else total) * w / weight, cap * tokens[s]) for s, (w, cap) in present.items()}


def solve(lengths: DataFrame, mix: dict[str, tuple[float, int]], total: float | None = None) -> dict[str, tuple[float, float, float, int]]:
    """Source -> (start rate, multiplier, mean length, repetitions) for ``lengths`` (source, n, c), c documents of n tokens."""
    sums = {r.source: r for r in lengths.groupBy("source").agg(F.sum("c").alias("docs"), F.sum(F.col("c") * F.col("n")).alias("tokens")).collect()}
    goal = budgets({s: r.tokens for s, r in sums.items()}, mix, total)
    mean_all = sum(sums[s].tokens for s in goal) / max(1, sum(sums[s].docs for s in goal))
    mean = {s: sums[s].tokens / sums[s].docs for s in goal}
    start = {s: min(goal[s] / mean_all / sums[s].docs, mix[s][1]) for s in goal}
    full = {s for s in goal if goal[s] >= mix[s][1] * sums[s].tokens * (1 - 1e-12)}
    at, low, high = dict.fromkeys(goal, 0.0), dict.fromkeys(goal, -LARGEST_EXPONENT), dict.fromkeys(goal, LARGEST_EXPONENT)
    todo = set(goal) - full
    for _ in range(STEPS):
        if not todo:
            break
        part = lengths.where(F.col("source").isin(*todo))
        x = F.col("n") / by_source({s: mean[s] for s in todo})
        free = by_source({s: start[s] for s in todo}) * F.exp(F.least(x * by_source({s: at[s] for s in todo}), F.lit(LARGEST_EXPONENT)))
        cap = by_source({s: mix[s][1] for s in todo})
        mass = F.col("c") * F.col("n")
        rows = part.groupBy("source").agg(F.sum(mass * F.least(free, cap)).alias("t"), F.sum(F.when(free < cap, mass * free * x).otherwise(0.0)).alias("d")).collect()
        for r in rows:
            s, over = r.source, r.t - goal[r.source]
            if abs(over) <= ERROR * goal[s]:
                todo.discard(s)
                continue
            (high if over > 0 else low)[s] = at[s]
            step = at[s] - over / r.d if r.d > 0 else None
            # a step that leaves the bracket is replaced by its middle; the dual is convex, so the bracket closes
            at[s] = step if step is not None and low[s] < step < high[s] else (low[s] + high[s]) / 2
    return {s: (start[s], LARGEST_EXPONENT if s in full else at[s], mean[s], mix[s][1]) for s in goal}


def rate(solution: dict[str, tuple[float, float, float, int]], full: set[str]) -> Column:
    x = F.col("n") / by_source({s: v[2] for s, v in solution.items()})
    tilted = by_source({s: v[0] for s, v in solution.items()}) * F.exp(F.least(x * by_source({s: v[1] for s, v in solution.items()}), F.lit(LARGEST_EXPONENT)))
    cap = by_source({s: v[3] for s, v in solution.items()})
    return F.when(F.col("source").isin(*full), cap).otherwise(F.least(tilted, cap)) if full else F.least(tilted, cap)


def mixed(documents: DataFrame, mix_table: DataFrame, total: float | None = None, tokenizers: str = TOKENIZERS) -> DataFrame:
    """(doc_id, source, jetons, taux, copies): every document of a source of the mix.

    Documents without tokens have rate and copies 0; documents of other sources or of none take no part. No copies
    exceed the source's repetitions. An empty corpus gives no rows.
    """
    mix = targets_of(mix_table)
    schema = "doc_id bigint, source string, jetons bigint, taux double, copies bigint"
    if not mix:
        return documents.sparkSession.createDataFrame([], schema)
    kept = documents.where(F.col("source").isin(*mix)).select(F.struct("doc_id", "source").alias("k"), "text")
    keyed = kept.select(F.to_json("k").alias("k"), "text")
    counted = encode(keyed, "k", "text", "byte_bpe_50k", tokenizers, counts=True)
    counts = cut(counted.select(F.from_json("k", "doc_id bigint, source string").alias("k"), "n").select("k.doc_id", "k.source", "n"))
    lengths = cut(counts.where("n > 0").groupBy("source", "n").agg(F.count(F.lit(1)).alias("c")))
    solution = solve(lengths, mix, total)
    if not solution:
        return counts.select("doc_id", "source", F.col("n").alias("jetons"), F.lit(0.0).alias("taux"), F.lit(0).cast("bigint").alias("copies"))
    full = {s for s, v in solution.items() if v[1] >= LARGEST_EXPONENT}
    rated = lengths.withColumn("r", rate(solution, full))
    # prefix sums: over the lengths of a source, then over the parts of a length, then within a part
    ahead = Window.partitionBy("source").orderBy("n").rowsBetween(Window.unboundedPreceding, -1)
    rated = rated.withColumn("before", F.coalesce(F.sum(F.col("c") * F.col("r")).over(ahead), F.lit(0.0))).drop("c")
    largest = lengths.agg(F.max("c").alias("c")).first().c
    salted = counts.where("n > 0").withColumn("h", F.pmod(F.xxhash64("doc_id"), F.lit(max(LEAST_PARTS, -(-largest // PART_DOCS)))).cast("int"))
    within = Window.partitionBy("source", "n").orderBy("h").rowsBetween(Window.unboundedPreceding, -1)
    parts = salted.groupBy("source", "n", "h").agg(F.count(F.lit(1)).alias("k")).withColumn("earlier", F.coalesce(F.sum("k").over(within), F.lit(0))).drop("k")
    placed = parts.join(rated, ["source", "n"])
    ranked = salted.withColumn("i", F.row_number().over(Window.partitionBy("source", "n", "h").orderBy("doc_id"))).join(placed, ["source", "n", "h"])
    upto = F.col("before") + (F.col("earlier") + F.col("i")) * F.col("r")
    copies = F.least(F.floor(upto + 0.5) - F.floor(upto - F.col("r") + 0.5), F.ceil("r"))
    some = ranked.select("doc_id", "source", F.col("n").alias("jetons"), F.col("r").alias("taux"), copies.cast("bigint").alias("copies"))
    none = counts.where("n = 0").select("doc_id", "source", F.col("n").alias("jetons"), F.lit(0.0).alias("taux"), F.lit(0).cast("bigint").alias("copies"))
    return some.unionByName(none)


def p7_mix(spark: SparkSession, folder: str) -> DataFrame:
    return mixed(table(spark, folder, "documents", "doc_id", "source", "text"), table(spark, folder, "mix_cibles"))


def p7_shares(spark: SparkSession, folder: str) -> DataFrame:
    """Target and reached share of each source of the mix; a source that the corpus lacks reaches 0."""
    taken = p7_mix(spark, folder).groupBy("source").agg(
        F.count(F.lit(1)).alias("documents"), F.sum("jetons").alias("jetons"), F.sum(F.col("jetons") * F.col("copies")).alias("jetons_mix"), F.max("copies").alias("copies_max")
    )
    mix = table(spark, folder, "mix_cibles").select("source", "poids", "repetitions_max")
    rows = mix.join(taken, "source", "left").na.fill(0, ["documents", "jetons", "jetons_mix", "copies_max"])
    total = rows.agg(F.sum("jetons_mix").alias("t")).first().t or 0
    reached = F.col("jetons_mix") / F.lit(float(total)) if total else F.lit(0.0)
    return rows.withColumn("part", reached).withColumn("ecart", F.abs(F.col("part") - F.col("poids")))
