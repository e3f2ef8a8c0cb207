"""Mixing sources to target weights by iterative proportional fitting, in built-in functions.

Documents are summed to cells of source, language and topic. The cells' token weights are
raked to each dimension's target shares in turn until all hold; a document is then kept with
its cell's fitted tokens over its present ones, by a fixed hash of its id.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratafold.llm.common import stored, table

DIMENSIONS = ("source", "lang", "topic")
KEEP = 0.5
TEMPERATURE = 0.7
ROUNDS_A_STEP = 3
MOST_STEPS = 16
CLOSE = 1e-6
STALLED = 0.98
_SMALL_BYTES = 8 << 20
_SEED = 9


def token_count(text: Column) -> Column:
    """Words between ASCII white space; 0 for a null text."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^ \t\n\x0B\f\r]+")), F.lit(0)).cast("bigint")


def topic_of(text: Column, tokens: Column) -> Column:
    """A plain topic by the text's form: empty, table, shout, or prose by length."""
    size = F.length(text)
    bars = size - F.length(F.translate(text, "|", ""))
    capitals = size - F.length(F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", ""))
    return (F.when(tokens == 0, "empty").when(bars * 5 > tokens, "table").when(capitals * 2 > size, "shout")
            .when(tokens < 200, "short prose").when(tokens < 1000, "prose").otherwise("long prose"))


def _spelled(dimension: str) -> Column:
    """The category of a row; a null is a category of its own."""
    return F.coalesce(F.concat(F.lit("="), F.col(dimension).cast("string")), F.lit("null"))


def tempered(cells: DataFrame, dimension: str, temperature: float = TEMPERATURE) -> DataFrame:
    """(key, share): target shares that flatten a dimension's present ones by a power below one."""
    sums = cells.groupBy(F.col(dimension).alias("key")).agg(F.pow(F.sum("tokens").cast("double"), F.lit(temperature)).alias("w"))
    whole = sums.agg(F.sum("w")).first()[0] or 0.0
    return sums.select("key", (F.col("w") / F.lit(whole) if whole else F.lit(0.0)).alias("share"))


def rake(cells: DataFrame, targets: Mapping[str, DataFrame], keep: float = KEEP,
         most_steps: int = MOST_STEPS) -> DataFrame:
    """The cells with ``fit``, their share of the mixture, and ``gap``, the largest difference that
    is left between a category's share and its target.

    ``targets`` has (key, share) for each dimension; a category without a target gets nothing,
    and shares of categories that have no tokens fall to the others in proportion. No cell gets
    more than its tokens over ``keep`` of all tokens, as a document is taken once at most; where
    that or empty cells make the targets unreachable, or strongly tied categories let them be
    reached but slowly, raking ends when a step of three rounds shrinks the largest gap by less
    than a fiftieth, or after ``most_steps`` steps; the last round stands, and ``gap`` tells.
    """
    total = cells.agg(F.sum("tokens").cast("double")).first()[0] or 0.0
    if not total:
        return cells.withColumn("fit", F.lit(0.0)).withColumn("gap", F.lit(0.0))
    now = cells.withColumn("fit", F.col("tokens") / F.lit(total)).withColumn(
        "top", F.col("tokens") / F.lit(total * keep))
    for dimension, target in targets.items():
        goal = target.select(F.col("key").alias("_key"), F.col("share").cast("double").alias(f"goal_{dimension}"))
        now = now.join(goal, now[dimension] == F.col("_key"), "left").drop("_key").withColumn(
            f"goal_{dimension}", F.coalesce(f"goal_{dimension}", F.lit(0.0)))
    last = gap = float("inf")
    for _ in range(most_steps):
        for _ in range(ROUNDS_A_STEP):
            for dimension in targets:
                # Only cells pass here, one for each combination of categories.
                own = F.expr(f"sum(fit) over (partition by `{dimension}`)")
                raked = F.when(own > 0, F.col("fit") * F.col(f"goal_{dimension}") / own).otherwise(0.0)
                now = now.withColumn("fit", F.least(raked, F.col("top")))
        now = stored(now, "rake")
        off = [now.groupBy(d).agg(F.abs(F.sum("fit") - F.first(f"goal_{d}")).alias("off")) for d in targets]
        worst = off[0].select("off")
        for more in off[1:]:
            worst = worst.unionByName(more.select("off"))
        gap = worst.agg(F.max("off")).first()[0] or 0.0
        if gap < CLOSE or gap > STALLED * last:
            break
        last = gap
    return now.select(*cells.columns, "fit", F.lit(float(gap)).alias("gap"))


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", dimensions: tuple[str, ...] = DIMENSIONS,
        targets: Mapping[str, DataFrame] | None = None, keep: float = KEEP) -> DataFrame:
    """The rows with ``mix_tokens``, ``mix_topic``, ``mix_probability``, ``mix_gap`` and ``mix_kept``.

    ``dimensions`` are columns; ``topic`` stands for the form of the text where there is no such
    column. Targets are shares of the tokens to keep (``keep`` of all); left out, they are the
    present shares flattened. Null categories are one category. A document is kept if a hash of
    its id, uniform in 0 to 1, is below its cell's probability, so rows of one id are kept
    together; a row without an id goes by its text. Columns named like the new ones are
    replaced. Rows without words have probability 1: they carry no weight to any target.
    """
    tokens = token_count(F.col(text_col))
    known = {c.lower() for c in docs.columns}
    topic = F.col("topic").cast("string") if "topic" in known else topic_of(F.col(text_col), F.col("mix_tokens"))
    marked = docs.withColumn("mix_tokens", tokens).withColumn("mix_topic", topic)
    cats = {f"_cat{i}": _spelled("mix_topic" if d == "topic" else d) for i, d in enumerate(dimensions)}
    marked = marked.withColumns(cats)
    cells = stored(marked.groupBy(*cats).agg(F.sum("mix_tokens").alias("tokens"), F.count(F.lit(1)).alias("rows")), "cells")
    if targets is None:
        goals = {c: tempered(cells, c) for c in cats}
    else:
        goals = {c: targets[d].withColumn("key", _spelled("key")) for c, d in zip(cats, dimensions)}
    goals = {c: stored(goal, "goals") for c, goal in goals.items()}
    fitted = rake(cells, goals, keep)
    total = cells.agg(F.sum("tokens").cast("double")).first()[0] or 0.0
    share = F.when(F.col("tokens") > 0, F.least(F.lit(1.0), F.col("fit") * (total * keep) / F.col("tokens"))).otherwise(1.0)
    odds = fitted.select(*[F.col(c).alias(f"_to{i}") for i, c in enumerate(cats)], share.alias("mix_probability"),
                         F.col("gap").alias("mix_gap"))
    width = sum((F.octet_length(c) for c in cats), F.lit(40 * (len(cats) + 1)))
    if (cells.agg(F.sum(width)).first()[0] or 0) <= _SMALL_BYTES:
        odds = F.broadcast(odds)
    match = F.lit(True)
    for i, c in enumerate(cats):
        match = match & (F.col(c) == F.col(f"_to{i}"))
    joined = marked.drop("mix_probability", "mix_gap", "mix_kept").join(odds, match, "left")
    place = F.when(F.col(id_col).isNull(), F.xxhash64(F.lit(_SEED), text_col)).otherwise(
        F.xxhash64(F.lit(_SEED), id_col))
    uniform = F.shiftrightunsigned(place, 11).cast("double") / float(1 << 53)
    return joined.withColumn("mix_kept", uniform < F.col("mix_probability")).drop(
        *cats, *[f"_to{i}" for i in range(len(cats))])


def op9_mixing(spark, sf_dir: str) -> DataFrame:
    mixed = mix(table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "source", "lang", F.col("mix_topic").alias("topic"), F.col("mix_tokens").alias("tokens"),
                        F.col("mix_probability").alias("probability"), F.col("mix_gap").alias("gap"),
                        F.col("mix_kept").alias("kept"))
