"""Mixing sources to target weights by temperature, realised as budgeted permutations of blocks.

The token share p of each source is raised to an exponent and normalised. The exponent is found by section search so that the
mixture reaches a target entropy, or as far towards it as a limit on repetition allows. Every source then gives its share of a
token budget: whole passes over its documents and one partial pass, each a fresh permutation of its blocks.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfwise.llm.common import stored
from shelfwise.operators.grouping import prefix_sums

#: Documents of a block, about.
BLOCK_DOCS = 1024
#: Points of a section search in each round, and rounds: the exponent is found to 64 ** -6.
POINTS, ROUNDS = 64, 6
WORD = r"[^\x20\x09-\x0D]+"


@dataclass(frozen=True)
class Target:
    """budget: tokens as a share of all there are; None: as many as give every source one whole pass. entropy: wanted, as a share of the highest.
    repeats: most passes over a source."""

    budget: float | None = 1.0
    entropy: float = 0.95
    repeats: float = 2.0


def words_in(text: Column) -> Column:
    """Number of words; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def _hash(*parts: Column) -> Column:
    """md5 of the parts with a bar between them."""
    return F.md5(F.concat_ws("|", *[p.cast("string") for p in parts]))


def _number(digest: Column, modulus: Column) -> Column:
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("long") % modulus


def exponent(sources: DataFrame, target: Target) -> float:
    """Exponent in [0, 1] for sources with shares ``p``, to six decimals.

    The largest that reaches the target entropy; raised, if need be, to the smallest that keeps every source within the repeats.
    At 1 the shares stay as they are; if even that repeats more than allowed, it is 1. No sources: 1.
    """
    sums = sources.agg(F.count(F.lit(1)), F.min("p"), F.max("p")).first()
    if not sums[0]:
        return 1.0
    highest, least, most = math.log(sums[0]), sums[1], sums[2]

    def passes(a: float, z: float) -> float:
        """Over the rarest source, where the budget is given or the largest has one pass."""
        return (most / least) ** (1 - a) if target.budget is None else target.budget * least ** (a - 1) / z

    def search(meets) -> float:
        """Largest point of [0, 1] up to which ``meets`` holds, on ever finer grids; 0 if it holds nowhere."""
        low, width = 0.0, 1.0
        for _ in range(ROUNDS):
            grid = [low + width * i / POINTS for i in range(POINTS + 1)]
            points = F.explode(F.array(*[F.lit(float(a)) for a in grid])).alias("a")
            rows = sources.select("p", points).groupBy("a").agg(
                F.sum(F.pow("p", F.col("a"))).alias("z"), F.sum(F.pow("p", F.col("a")) * F.log("p")).alias("s")).collect()
            good = [r.a for r in rows if meets(r.a, r.z, r.s)]
            low = max(good, default=low)
            width /= POINTS
            if low >= 1.0:
                return 1.0
        return low

    # entropy of the mixture is log z - a s / z, the rarest source repeats most
    to_entropy = search(lambda a, z, s: math.log(z) - a * s / z >= target.entropy * highest)
    to_repeats = search(lambda a, z, s: passes(a, z) > target.repeats)
    return round(max(to_entropy, to_repeats), 6)


def mixture(rows: DataFrame, target: Target) -> DataFrame:
    """(key, tokens, docs, p, weight, quota, passes, rest, blocks) per source of ``rows`` (key, tokens)."""
    totals = stored(rows.groupBy("key").agg(F.sum("tokens").alias("tokens"), F.count(F.lit(1)).alias("docs")), "sources")
    total = totals.agg(F.coalesce(F.sum("tokens"), F.lit(0))).first()[0]
    shares = totals.filter("tokens > 0").withColumn("p", F.col("tokens") / F.lit(float(max(total, 1))))
    alpha = exponent(shares, target)
    sums = shares.agg(F.sum(F.pow("p", F.lit(alpha))), F.max(F.pow("p", F.lit(1 - alpha)))).first()
    z = sums[0] or 1.0
    # the largest source has the most tokens for its weight
    budget = (sums[1] or 1.0) * z if target.budget is None else target.budget
    quota = F.floor(F.pow("p", F.lit(alpha)) / F.lit(z) * F.lit(budget * total) + F.lit(1e-6)).cast("long")
    if target.budget is None:
        quota = F.greatest(quota, F.col("tokens"))
    return (
        shares.withColumn("weight", F.pow("p", F.lit(alpha)) / F.lit(z)).withColumn("quota", quota)
        .withColumn("passes", F.expr("quota div tokens")).withColumn("rest", F.expr("quota % tokens"))
        .withColumn("blocks", F.ceil(F.col("docs") / F.lit(BLOCK_DOCS)).cast("long"))
    )


def mix(docs: DataFrame, target: Target = Target(), id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
        seed: int = 0, keep: tuple[str, ...] = ()) -> DataFrame:
    """One row per drawn document and pass: id, source, pass, block, start (tokens drawn before it in its pass), n_tokens, ``keep``.

    Tokens are words. A null source is a source of its own; a null or word-free text has no tokens and is drawn in every whole pass
    of its source. A source without tokens isn't drawn. Of a partial pass the documents are drawn that end within its rest, and the one across its end
    if at least half of it lies within: a source gets its quota up to half a document. Repeated rows are drawn each for itself and tie-break by content. Any number of sources and a source of any size is split
    into blocks; only sums per block are put in order.
    """
    mark = _hash(F.coalesce(F.col(id_col).cast("string"), F.lit("null")), F.md5(F.coalesce(text_col, F.lit(""))))
    # rows of one name are equal in every column kept
    row = _hash(mark, F.xxhash64(*keep)) if keep else mark
    own = docs.select(
        F.col(id_col).alias("id"), F.col(source_col).alias("source"), words_in(F.col(text_col)).alias("tokens"),
        F.coalesce(F.concat(F.lit("="), F.col(source_col)), F.lit("null")).alias("key"), mark.alias("mark"), row.alias("row"))
    slim = own.select("key", "tokens")
    sources = stored(mixture(slim, target), "mixture")
    drawn = (
        own.join(sources.select("key", "passes", "rest", "blocks"), "key")
        .withColumn("pass", F.explode(F.sequence(F.lit(0).cast("long"), F.col("passes"))))
        .filter((F.col("pass") < F.col("passes")) | (F.col("rest") > 0))
        .withColumn("block", _number(F.col("mark"), F.col("blocks")))
        .withColumn("turn", _hash(F.lit(seed), F.col("pass"), F.col("mark")))
    )
    drawn = stored(drawn, "drawn")
    sums = drawn.groupBy("key", "pass", "block").agg(F.sum("tokens").alias("tokens"))
    # running sums over the blocks of all sources in their order of this pass
    placed = prefix_sums(
        sums.withColumn("turn", _hash(F.lit(seed), F.col("pass"), F.col("key"), F.col("block"))),
        [F.col("key"), F.col("pass"), F.col("turn"), F.col("block")], "tokens").withColumn("before", F.col("running") - F.col("tokens"))
    placed = stored(placed.select("key", "pass", "block", "before"), "blocks")
    first = placed.groupBy("key", "pass").agg(F.min("before").alias("base"))
    starts = placed.join(first, ["key", "pass"]).select("key", "pass", "block", (F.col("before") - F.col("base")).alias("block_start"))
    inside = Window.partitionBy("key", "pass", "block").orderBy("turn", "mark").rowsBetween(Window.unboundedPreceding, 0)
    result = (
        drawn.withColumn("through", F.sum("tokens").over(inside)).join(starts, ["key", "pass", "block"])
        .withColumn("start", F.col("block_start") + F.col("through") - F.col("tokens"))
        .filter((F.col("pass") < F.col("passes")) | (2 * F.col("start") + F.col("tokens") <= 2 * F.col("rest")))
        .select(F.col("id").alias(id_col), F.col("source").alias(source_col), "pass", "block", "start", F.col("tokens").alias("n_tokens"), "row")
    )
    if not keep:
        return result.drop("row")
    # what is kept joins at the end, so that texts are moved once
    kept = docs.select(row.alias("row"), F.struct(*keep).alias("kept")).groupBy("row").agg(F.first("kept").alias("kept"))
    names = [c for c in result.columns if c != "row" and c not in keep]
    return result.join(kept, "row").select(*names, *[F.col(f"kept.{c}").alias(c) for c in keep])
