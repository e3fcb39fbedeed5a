"""Operator 1, mixing sources to target weights (native: DataFrame functions only).

Documents are counted into cells (source, language, topic) with their token totals.
Iterative proportional fitting rakes one weight per cell until the weighted token shares
of every source, every language and every topic meet their targets: each step multiplies
the weights of a value by target / current share. Documents are then sampled with
probability weight / largest weight: the largest sample without repeated documents whose
expected token shares are exactly the raked ones. The draw is a hash of the id and a
seed, so a retried task or a rerun keeps the same documents.

Without given targets, a value's target is its token share to the power ``alpha``,
rescaled to 1 (0 flattens, 1 keeps the corpus as it is), and at most ``max_weight`` to the
power ``VALUE_POWER`` times its own share.

No weight exceeds ``max_weight`` times the mean weight (times what given targets ask of a
whole value), so at least 1 / ``max_weight`` of all tokens is drawn at any size, however odd a
tiny cell is. The bound is part of the raking: a weight is min(bound, product of its
factors), each step compares the targets with the bounded weights, and a step never
overshoots, so at the end marginals and bound hold together.

Raking goes on until every marginal is within ``tolerance``. Targets that cannot be met
together (within the bound) are found by their rate of convergence: given ones raise
``RakingError`` with the residual; smoothed ones are moved toward the shares that are there
(by halves, ``STRENGTHS``, at last all the way), which can always be met.

Only cells are raked: one row per combination that occurs, aggregated map-side, so a
source that holds a third of all rows is one row. Cells are written to the shared folder
after each round of sweeps, which cuts the lineage. The driver sees one scalar a round.

Defined cases: a null source, language or topic is the value "" of its column; a value
without a given target has target 0 and is never drawn; targets are rescaled over the
values that occur; null and empty texts have 0 tokens and the weight of their cell; a
cell without tokens has the largest weight (its documents cost nothing); equal ids are
drawn together; an empty table gives an empty result; extra columns of any name pass
through ``sample`` untouched.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from reelmart.session import scratch_path

DIMS = ["source", "lang", "topic"]
ALPHA, MAX_ROUNDS, SWEEPS, TOLERANCE, SEED = 0.9, 50, 3, 1e-4, 17
MAX_WEIGHT, VALUE_POWER, STRENGTHS = 2.0, 0.75, (1.0, 0.5, 0.25, 0.125)


class RakingError(ValueError):
    """The targets cannot be met together; ``residual`` is the largest relative miss of a marginal."""

    def __init__(self, residual: float, rounds: int) -> None:
        super().__init__(f"targets cannot be met together: after {rounds} rounds a marginal is still off by {residual:.3g} of its target")
        self.residual = residual

#: First pattern that stands in the text names its topic; none: "general".
TOPICS = (
    ("legal", r"[Ll]icen[cs]e|[Cc]opyright"),
    ("contact", r"@[A-Za-z0-9.-]+\.[a-z]"),
    ("web", r"https?://|www\."),
    ("table", r"\| [^|\n]* \| "),
    ("markup", r"\*\*\*|###|\$\$\$"),
)


def topic_of(text: Column, topics: tuple = TOPICS) -> Column:
    out = F.lit("general")
    for name, pattern in reversed(topics):
        out = F.when(text.rlike(pattern), name).otherwise(out)
    return out


def token_count(text: Column) -> Column:
    """Number of words, a stand-in for tokens that needs no tokenizer."""
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(r"\S+")).cast("long")


def smoothed_targets(raked: DataFrame, dim: str, alpha: float = ALPHA, max_weight: float = MAX_WEIGHT, strength: float = 1.0) -> DataFrame:
    """(value, share) from cells with weights: share now to the power alpha, bounded, and mixed with the share now by ``strength``."""
    now = raked.groupBy(F.col(dim).alias("value")).agg(F.sum(F.col("tokens") * F.col("weight")).alias("n")).filter("n > 0")
    whole = Window.partitionBy(F.lit(0))  # one row a value that occurs
    now = now.withColumn("now", F.col("n") / F.sum("n").over(whole))
    smooth = F.pow("now", F.lit(float(alpha)))
    now = now.withColumn("goal", F.least(smooth / F.sum(smooth).over(whole), F.col("now") * max_weight ** VALUE_POWER))
    goal = F.col("goal") / F.sum("goal").over(whole)
    return now.select("value", (goal * strength + F.col("now") * (1 - strength)).alias("share"))


def rake(cells: DataFrame, targets: dict[str, DataFrame], max_rounds: int = MAX_ROUNDS, sweeps: int = SWEEPS,
         tolerance: float = TOLERANCE, max_weight: float | None = None) -> DataFrame:
    """``cells`` (dims..., tokens) and a weight, raked to the targets {dim: (value, share)}; the mean weight of a token is 1.

    No weight exceeds ``max_weight`` (None: no bound). Raises RakingError if the targets are not met within
    ``tolerance`` and, at the rate seen, will not be within ``max_rounds``.
    """
    spark, dims = cells.sparkSession, list(targets)
    path = scratch_path(spark, "mixing")
    c = cells.withColumn("weight", F.lit(1.0))
    for dim in dims:
        goal = targets[dim].groupBy("value").agg(F.sum("share").alias("share"))
        here = c.groupBy(F.col(dim).alias("value")).agg(F.sum("tokens").alias("n")).filter("n > 0")
        whole = goal.join(here, "value").agg(F.sum("share")).first()[0] or 1.0
        goal = goal.select(F.col("value").alias(dim), (F.col("share") / F.lit(float(whole))).alias(f"goal_{dim}"))
        c = c.join(goal, dim, "left").fillna({f"goal_{dim}": 0.0})
    c.write.parquet(f"{path}/0")
    c = spark.read.parquet(f"{path}/0")
    total = float(c.agg(F.sum("tokens")).first()[0] or 0)
    bounded = F.col("weight") if max_weight is None else F.least("weight", F.lit(float(max_weight)))
    before, doubtful = math.inf, 0
    for n in range(1, max_rounds + 1):
        for _ in range(sweeps):
            for dim in dims:
                now, goal = F.sum(F.col("tokens") * bounded).over(Window.partitionBy(dim)), F.col(f"goal_{dim}")
                # a value with a target whose cells have all been set to 0 by another one can never be met
                factor = F.when(now > 0, goal * total / now).when((goal > 0) & (F.sum("tokens").over(Window.partitionBy(dim)) > 0), math.inf)
                c = c.withColumn(f"factor_{dim}", factor.otherwise(F.lit(1.0)))
                c = c.withColumn("weight", F.when(F.col("weight") > 0, F.col("weight") * F.col(f"factor_{dim}")).otherwise(F.lit(0.0)))
        c.write.parquet(f"{path}/{n}")
        c = spark.read.parquet(f"{path}/{n}")
        off = F.greatest(*[F.abs(F.col(f"factor_{d}") - 1) for d in dims], F.lit(0.0))
        worst = c.filter("tokens > 0").agg(F.max(off)).first()[0]
        c = c.drop(*[f"factor_{d}" for d in dims])
        if worst is None or worst <= tolerance:
            return c.select(*cells.columns, bounded.alias("weight"))
        rate = worst / before if before < math.inf else 0.0
        hopeless = worst == math.inf or rate >= 1 or (rate > 0 and math.log(tolerance / worst) / math.log(rate) > max_rounds - n)
        doubtful = doubtful + 1 if hopeless else 0
        if doubtful == 3 or worst == math.inf or n == max_rounds:
            raise RakingError(worst, n)
        before = worst
    raise ValueError("max_rounds must be at least 1")


def _asked(cells: DataFrame, goal: DataFrame, dim: str) -> float:
    """The largest weight that given targets ask of a whole value of ``dim``; at least 1."""
    here = cells.groupBy(F.col(dim).alias("value")).agg(F.sum("tokens").alias("n")).filter("n > 0")
    both = here.join(goal.groupBy("value").agg(F.sum("share").alias("share")), "value", "left")
    r = both.agg(F.sum("n").alias("n"), F.sum("share").alias("share"), F.max(F.col("share") / F.col("n")).alias("most")).first()
    return max(1.0, float(r.most) * float(r.n) / float(r.share)) if r.share else 1.0


def calibrate(cells: DataFrame, targets: dict[str, DataFrame] | None = None, alpha: float = ALPHA, max_weight: float = MAX_WEIGHT) -> DataFrame:
    """``cells`` with weights for given targets and smoothed ones for the other dimensions, under the bound of the module's docstring."""
    if max_weight < 1:
        raise ValueError("max_weight must be at least 1")
    given = {d: t for d, t in (targets or {}).items() if d in DIMS}
    base = cells.withColumn("weight", F.lit(1.0))
    if not cells.agg(F.sum("tokens")).first()[0]:
        return base
    bound = max_weight * math.prod([_asked(cells, given[d], d) for d in given])
    if given:
        base = rake(cells, given, max_weight=bound)
    free = [d for d in DIMS if d not in given]
    for strength in STRENGTHS if free else ():
        try:
            return rake(cells, given | {d: smoothed_targets(base, d, alpha, max_weight, strength) for d in free}, max_weight=bound)
        except RakingError:
            continue
    return base


def _described(docs: DataFrame, id_col: str, text_col: str, source_col: str, lang_col: str, topic: Column | None) -> list[Column]:
    """id, source, lang, topic and n_tokens of each document."""
    text = F.col(text_col).cast("string")
    named = lambda c: F.coalesce(c.cast("string"), F.lit(""))
    return [F.col(id_col).alias("id"), named(F.col(source_col)).alias("source"), named(F.col(lang_col)).alias("lang"),
            named(topic_of(F.coalesce(text, F.lit(""))) if topic is None else topic).alias("topic"), token_count(text).alias("n_tokens")]


def _probabilities(d: DataFrame, targets: dict[str, DataFrame] | None, alpha: float, max_weight: float) -> DataFrame:
    """(source, lang, topic, weight, probability) per cell of described documents."""
    # written once, as each round and each target reads the cells
    path = scratch_path(d.sparkSession, "mixing-cells")
    d.groupBy(*DIMS).agg(F.sum("n_tokens").alias("tokens")).write.parquet(path)
    raked = calibrate(d.sparkSession.read.parquet(path), targets, alpha, max_weight)
    most = float(raked.filter("tokens > 0").agg(F.max("weight")).first()[0] or 1.0)
    weight = F.when(F.col("tokens") > 0, F.col("weight")).otherwise(F.lit(most))
    return raked.select(*DIMS, weight.alias("weight"), (weight / F.lit(most)).alias("probability"))


def _drawn(id_: Column, probability: Column, seed: int) -> Column:
    return F.pmod(F.xxhash64(F.lit(seed), id_.cast("string")), F.lit(1 << 52)) / F.lit(float(1 << 52)) < probability


def mix(docs: DataFrame, targets: dict[str, DataFrame] | None = None, alpha: float = ALPHA, seed: int = SEED, id_col: str = "doc_id",
        text_col: str = "text", source_col: str = "source", lang_col: str = "lang", topic: Column | None = None,
        max_weight: float = MAX_WEIGHT) -> DataFrame:
    """(id, source, lang, topic, n_tokens, weight, probability, kept) of every document.

    ``targets``: {"source" | "lang" | "topic": (value, share)}; a missing one is smoothed by ``alpha``;
    given ones that cannot be met together raise RakingError.
    """
    # the texts are read once: what is left is small and is used for the cells and for the draw
    path = scratch_path(docs.sparkSession, "mixing-docs")
    docs.select(*_described(docs, id_col, text_col, source_col, lang_col, topic)).write.parquet(path)
    d = docs.sparkSession.read.parquet(path)
    out = d.join(_probabilities(d, targets, alpha, max_weight), DIMS)
    return out.withColumn("kept", _drawn(F.col("id"), F.col("probability"), seed)).select(
        F.col("id").alias(id_col), *DIMS, "n_tokens", "weight", "probability", "kept")


def sample(docs: DataFrame, targets: dict[str, DataFrame] | None = None, alpha: float = ALPHA, seed: int = SEED, id_col: str = "doc_id",
           text_col: str = "text", source_col: str = "source", lang_col: str = "lang", topic: Column | None = None,
           max_weight: float = MAX_WEIGHT) -> DataFrame:
    """The rows of ``docs`` that ``mix`` keeps, with all their columns."""
    described = _described(docs, id_col, text_col, source_col, lang_col, topic)
    p = _probabilities(docs.select(*described), targets, alpha, max_weight)
    p = p.select(F.struct(*DIMS).alias("cell"), "probability")
    # the columns of ``docs`` travel in one struct, so their names meet no other
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    d = docs.select(row, described[0], F.struct(*described[1:4]).alias("cell"))
    return d.join(p, "cell").filter(_drawn(F.col("id"), F.col("probability"), seed)).select("row.*")


def op1_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its raked weight, probability and draw."""
    return mix(spark.read.parquet(f"{sf_dir}/documents.parquet"))
