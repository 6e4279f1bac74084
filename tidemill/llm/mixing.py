"""Mixing sources: temperature weights that meet a target, realised as block permutations within a token budget."""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemill.llm.common import partitions, stored

#: Exponents tried in one pass over the sources, and passes: 31 points are five bisections.
POINTS, PASSES = 31, 6
#: Parts of a source, by the hash that orders its documents.
CHUNKS = 4096
#: Blocks of a mix.
BLOCKS = 64


def tokens_of(text: Column) -> Column:
    """Words of the whole text, at least one: what a document weighs if no count is given."""
    words = F.regexp_count(F.coalesce(text, F.lit("")), F.lit(r"[^\x20\x09-\x0D]+"))
    return F.greatest(words.cast("long"), F.lit(1).cast("long"))


def _powers(shares: DataFrame, exponents: list[float]) -> list[tuple[float, float]]:
    """For each exponent t the sum over the sources of p ** t, and that of p ** t log p."""
    log = F.log("share")
    columns = []
    for t in exponents:
        power = F.exp(F.lit(t) * log)
        columns += [F.sum(power), F.sum(power * log)]
    row = shares.agg(*columns).first()
    return [(row[2 * i], row[2 * i + 1]) for i in range(len(exponents))]


def _bisect(shares: DataFrame, enough: Callable[[float, float, float], bool]) -> tuple[float, float]:
    """An interval of exponents: ``enough`` (of t and its sums) holds at the first end and fails at the second one.

    It must hold below some exponent and fail above. Each pass over the sources tries POINTS exponents.
    """
    below, above = 0.0, 1.0
    for _ in range(PASSES):
        step = (above - below) / (POINTS + 1)
        tried = [below + step * i for i in range(1, POINTS + 1)]
        held = [t for t, sums in zip(tried, _powers(shares, tried), strict=True) if enough(t, *sums)]
        below, above = (held[-1], min(above, held[-1] + step)) if held else (below, below + step)
    return below, above


def temperature(
    shares: DataFrame, entropy: float | None = None, repeats: float | None = None, budget_share: float | None = None
) -> float:
    """The exponent t in 0 to 1 of the weights p ** t / sum, for sources with the shares p of all tokens.

    With t from 1 to 0 the weights go from the shares to all alike, entropy rises, and the rarest source is repeated
    more and more. ``entropy``: the largest t that reaches this share of the largest possible entropy. ``repeats``: the
    smallest t at which no source is used more often than that, for a budget that is ``budget_share`` of all tokens,
    or (None) the smallest budget that uses every source once. With both, the limit on repetition goes first; with
    neither, t is 1. Sources are not collected; what is bisected are sums over them.
    """
    count, low, high = shares.agg(F.count("*"), F.min("share"), F.max("share")).first()
    if count < 2 or entropy is None and repeats is None:
        return 1.0
    least, most = 0.0, 1.0
    if repeats is not None:

        def too_often(t: float, total: float, logs: float) -> bool:
            used = (high / low) ** (1 - t) if budget_share is None else budget_share * low ** (t - 1) / total
            return used > repeats

        flat = _powers(shares, [0.0])[0]
        least = _bisect(shares, too_often)[1] if too_often(0.0, *flat) else 0.0
        most = least
    if entropy is not None:
        goal = entropy * math.log(count) - 1e-12

        def diverse(t: float, total: float, logs: float) -> bool:
            return math.log(total) - t * logs / total >= goal

        most = 1.0 if diverse(1.0, *_powers(shares, [1.0])[0]) else _bisect(shares, diverse)[0]
    return max(least, most)


def _uniform(*columns: Column) -> Column:
    """A hash, as a number from 0 to 1."""
    return F.xxhash64(*columns).bitwiseAND((1 << 53) - 1) / F.lit(float(1 << 53))


def mix_sources(
    df: DataFrame,
    id_col: str = "doc_id",
    source_col: str = "source",
    text_col: str = "text",
    tokens: Column | None = None,
    entropy: float | None = None,
    repeats: float | None = 2.0,
    budget: int | None = None,
    blocks: int = BLOCKS,
    seed: int = 0,
) -> DataFrame:
    """Every use of every row: its columns as the struct ``row``, and ``n_tokens, epoch, block, place``.

    The sources' shares of all tokens are raised to one exponent (see ``temperature``) and normalised. A source may
    spend its weight of ``budget`` tokens (None: the smallest budget with which every document is used). An epoch is a
    permutation of all its documents by a hash of seed, epoch, id and text; as many whole epochs as fit are used, and
    of one more the beginning, up to the document that reaches the budget and those with the same hash. A source's uses
    in this order are cut into ``blocks`` equal parts, so that each block holds the sources by their weights; within a
    block uses are ordered by ``place``, a hash. All choices repeat on any partitioning.

    ``tokens`` is a positive whole-number column, else words are counted. A null source is a source; null and empty
    texts weigh one token; repeated rows are all used, as often as each other; one source alone keeps its share; no
    rows give none.

    The cut in the last epoch comes from token sums of CHUNKS parts of each source, and then of the documents of one
    part, so a source with a third of all rows is nobody's task. Only sums over all sources reach the driver; their
    table is joined as large as it is.
    """
    weigh = (tokens if tokens is not None else tokens_of(F.col(f"`{text_col}`"))).cast("long")
    source = F.coalesce(F.col(f"`{source_col}`").cast("string"), F.lit("\0"))
    own = [F.col(f"`{id_col}`").cast("string").alias("id"), F.xxhash64(F.col(f"`{text_col}`")).alias("content")]
    slim = stored(df.select(source.alias("source"), weigh.alias("n_tokens"), *own), "weights")
    sums = stored(slim.groupBy("source").agg(F.sum("n_tokens").cast("double").alias("tokens")), "sources")
    whole = sums.agg(F.sum("tokens")).first()[0] or 1.0
    shares = sums.withColumn("share", F.col("tokens") / whole)
    exponent = temperature(shares, entropy, repeats, budget / whole if budget else None)
    # Weights need no normalising sum where only their ratio to the shares counts.
    ratio = F.pow(F.col("share"), exponent - 1.0)
    if budget is None:
        scale = 1.0 / (shares.agg(F.min(ratio)).first()[0] or 1.0)
    else:
        scale = budget / whole / (_powers(shares, [exponent])[0][0] or 1.0)
    # Rounded, so that a source that is used just once (or twice) doesn't miss its last document.
    used = F.round(ratio * scale, 6)
    plan = stored(shares.select("source", "tokens", F.floor(used).alias("epochs"), (used - F.floor(used)).alias("rest")), "plan")
    order = _uniform(F.lit(seed), F.col("epochs"), F.col("id"), F.col("content"))
    partial = slim.join(plan.where("rest > 0"), "source").withColumn("u", order)
    partial = stored(
        partial.select("source", "n_tokens", "u", F.floor(F.col("u") * CHUNKS).alias("chunk"), (F.col("rest") * F.col("tokens")).alias("goal")),
        "last-epoch",
    )
    before = Window.partitionBy("source").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    chunks = (
        partial.groupBy("source", "chunk")
        .agg(F.sum("n_tokens").alias("sum"), F.first("goal").alias("goal"))
        .withColumn("before", F.coalesce(F.sum("sum").over(before), F.lit(0)))
        .where((F.col("before") < F.col("goal")) & (F.col("before") + F.col("sum") >= F.col("goal")))
        .select("source", "chunk", "before")
    )
    upto = Window.partitionBy("source", "chunk").orderBy("u")
    cuts = (
        partial.join(stored(chunks, "chunks"), ["source", "chunk"])
        .withColumn("spent", F.col("before") + F.sum("n_tokens").over(upto))
        .where(F.col("spent") >= F.col("goal"))
        .groupBy("source")
        .agg(F.min("u").alias("cut"))
    )
    cut = F.coalesce("cut", F.when(F.col("rest") > 0, 1.0).otherwise(-1.0))
    plan = stored(plan.join(cuts, "source", "left").select("source", "epochs", cut.alias("cut")), "cuts")
    row = F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("row")
    joined = df.select(row, source.alias("source"), weigh.alias("n_tokens"), *own).join(plan, "source")
    uses = F.col("epochs") + F.when(order <= F.col("cut"), 1).otherwise(0)
    each = joined.where(uses > 0).select("*", F.explode(F.sequence(F.lit(0).cast("long"), uses - 1)).alias("epoch"))
    at = F.col("epoch") + _uniform(F.lit(seed), F.col("epoch"), F.col("id"), F.col("content"))
    length = F.col("epochs") + F.greatest(F.col("cut"), F.lit(0.0))
    block = F.least(F.floor(at / length * blocks), F.lit(blocks - 1))
    place = F.xxhash64(F.lit(seed), F.lit("place"), F.col("epoch"), F.col("source"), F.col("id"), F.col("content"))
    return each.select("row", "n_tokens", F.col("epoch").cast("int"), block.cast("int").alias("block"), place.alias("place"))


def in_order(mix: DataFrame, blocks: int = BLOCKS) -> DataFrame:
    """The rows of a mix alone, in the order of blocks and places, over the session's number of partitions.

    Places are uniform within a block, so that block and place say which partition a use belongs to.
    """
    parts = partitions(mix.sparkSession)
    place = F.shiftrightunsigned(F.col("place").bitwiseXOR(F.lit(-(2**63))), 11) / F.lit(float(1 << 53))
    part = F.least(F.floor((F.col("block") + place) / blocks * parts), F.lit(parts - 1)).cast("int")
    return mix.repartitionById(parts, part).sortWithinPartitions("block", "place").select("row.*")
