"""Mixing sources to target weights by iterative proportional fitting.

Token weights of the cells (source, language, topic) are raked in turn to the target shares of
each of the three margins until all hold. A cell cannot give more tokens than it has, so its
weight is held below what the token budget would take from it in full. The budget is the most that is sampled: where the
cells cannot give it at the target shares, the largest budget that meets all margins is taken instead, found to 1/256 of the
way between the budget that no cell limits and the one asked for. Every document of a cell is then sampled
with the cell's calibrated probability, budgeted tokens over tokens at hand, against a keyed hash of its doc_id,
so the sample is the same on every run and for every partitioning. Tokens are those of a public byte-level vocabulary, the one
that the token output writes; texts are encoded once, into a staged table of narrow profiles that both the cells and the
documents' rows come from.

The table of cells is one aggregate with a row per combination. Up to ``max_cells`` rows it is raked on the driver and
broadcast to the documents; a larger one is raked on Spark, every round an aggregate and a join per margin, and reaches
the documents through a shuffle join, but for the hot cells. Both ways give the same probabilities.

Targets: per margin, a table of shares, or a power: shares in proportion to the tokens at hand to that
power (1 keeps them, 0 makes them equal). Categories that a given table leaves out get no weight.

Defined cases: a null source or language is a category of its own, a null or empty text has topic ``empty`` and
0 tokens, one of white space alone has that topic too; in cells without tokens, documents are sampled like the whole (with the budget's share). Rows that repeat a doc_id are drawn
alike; a null doc_id draws by its text. An empty table gives no rows. If the targets contradict one another, so that no
budget meets all margins, the weights of the last round at the whole budget stay. Each row tells the ``budget`` taken and the
``margin_error``, the largest distance of a category's expected share from its target. Only ``doc_id``, ``text``, ``lang`` and ``source`` are read.
"""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterator, Mapping, Sequence
from functools import reduce

import numpy as np
import pandas as pd
import tiktoken
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from laborlake.llm.common import attach, own_columns, read, staged, unambiguous
from laborlake.llm.tasks import ship_by_value
from laborlake.llm.token_output import PATTERN, VOCABULARY, load_ranks

ship_by_value(sys.modules[__name__])

MARGINS = ("source", "lang", "topic")
#: Target shares of the registered query: powers of the tokens at hand.
TARGETS: dict[str, float | dict[str, float]] = {"source": 0.5, "lang": 0.7, "topic": 0.9}
BUDGET = 0.8  # share of all tokens to sample, at most
MAX_CELLS = 200_000
ROUNDS = 500
MET = 1e-6  # a margin holds if every category is this near to its share
SEED = 20_240_607
NONE = "\x00none"


def topic(text: Column) -> Column:
    """A document's topic by marker: table, notice, contact, prose, or empty."""
    t = F.coalesce(text, F.lit(""))
    return (F.when(t.rlike(r"^[\x20\x09-\x0D]*$"), "empty").when(t.contains(" | "), "table")
            .when(t.contains("rights reserved") | t.contains("icense"), "notice")
            .when(t.rlike(r"@[A-Za-z0-9-]+\.[a-z]|\+\d \(\d"), "contact").otherwise("prose"))


def tokens(spark: SparkSession, text: Column, vocabulary: str) -> Column:
    """How many tokens of the vocabulary a text has; special-token strings are ordinary text."""
    shared, pattern = spark.sparkContext.broadcast(load_ranks(vocabulary)), PATTERN

    @F.pandas_udf("long")
    def counted(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        coder = tiktoken.Encoding("vocabulary", pat_str=pattern, mergeable_ranks=shared.value, special_tokens={})
        for texts in batches:
            yield pd.Series([len(coder.encode_ordinary(t)) if t else 0 for t in texts], dtype="int64")

    return counted(text)


def profiled(docs: DataFrame, vocabulary: str = VOCABULARY) -> DataFrame:
    """(doc_id, source, lang, topic, tokens, draw), staged; ``draw`` is uniform in [0, 1)."""
    rows = own_columns(docs, ["doc_id", "text", "lang", "source"])
    counts = tokens(docs.sparkSession, rows["text"], vocabulary)
    return staged(rows.select("doc_id", *cell_columns(rows), counts.alias("tokens"), draw(rows).alias("draw")), "profiles")


def cell_columns(rows: DataFrame) -> list[Column]:
    return [F.coalesce(rows["source"], F.lit(NONE)).alias("source"), F.coalesce(rows["lang"], F.lit(NONE)).alias("lang"),
            topic(rows["text"]).alias("topic")]


def draw(rows: DataFrame) -> Column:
    key = F.when(rows["doc_id"].isNull(), F.xxhash64(rows["text"])).otherwise(F.xxhash64(rows["doc_id"].cast("long")))
    return F.shiftrightunsigned(F.xxhash64(key, F.lit(SEED)), 11) / F.lit(float(1 << 53))


def shares(keys: list[str], held: np.ndarray, target: float | Mapping[str, float]) -> dict[str, float]:
    """Target share of each category; ``held`` are the cells' tokens."""
    if isinstance(target, Mapping):
        goal = {k: float(target.get(k, 0.0)) for k in set(keys)}
    else:
        sums: dict[str, float] = {}
        for k, v in zip(keys, held, strict=True):
            sums[k] = sums.get(k, 0.0) + float(v)
        goal = {k: v ** target if v > 0 else 0.0 for k, v in sums.items()}
    total = sum(goal.values())
    return {k: v / total if total else 0.0 for k, v in goal.items()}


def rake(cells: list[tuple[str, ...]], held: np.ndarray, targets: Mapping[str, float | Mapping[str, float]], budget: float,
         rounds: int = ROUNDS, tolerance: float = 1e-9) -> np.ndarray:
    """The cells' shares of the sampled tokens: raked to every margin, none over what the cell holds."""
    return _rake(margins_of(cells, held, targets), held, budget, rounds, tolerance)


def margins_of(cells: list[tuple[str, ...]], held: np.ndarray,
               targets: Mapping[str, float | Mapping[str, float]]) -> list[tuple[np.ndarray, np.ndarray]]:
    """Per margin, the cells' categories by number and the target share of each."""
    margins = []
    for i, name in enumerate(MARGINS):
        keys = [c[i] for c in cells]
        goal = shares(keys, held, targets[name])
        at = {n: j for j, n in enumerate(sorted(goal))}
        margins.append((np.array([at[k] for k in keys], np.int64), np.array([goal[n] for n in at])))
    return margins


def margin_error(margins: list[tuple[np.ndarray, np.ndarray]], weight: np.ndarray) -> float:
    """The largest distance of a category's weight from its target share."""
    return max((float(np.abs(np.bincount(code, weight, len(goal)) - goal).max(initial=0.0)) for code, goal in margins), default=0.0)


def _rake(margins: list[tuple[np.ndarray, np.ndarray]], held: np.ndarray, budget: float | None, rounds: int,
          tolerance: float = 1e-9) -> np.ndarray:
    """``rake`` to the given margins; without a budget no cell is limited."""
    total = float(held.sum())
    if not total:
        return np.zeros(len(held))
    most = np.full(len(held), np.inf) if budget is None else held / (budget * total)
    weight = held / total
    for _ in range(rounds):
        before = weight
        for code, goal in margins:
            now = np.bincount(code, weight, len(goal))
            weight = weight * np.divide(goal, now, out=np.zeros_like(goal), where=now > 0)[code]
        weight = np.minimum(weight, most)
        if np.abs(weight - before).max() < tolerance:
            break
    return weight


def largest_budget(attempt: Callable[[Sequence[float | None]], list[tuple[float, float, object]]], budget: float,
                   cuts: Sequence[int]) -> tuple[float, float, object]:
    """(budget, margin error, weights) of the largest budget up to ``budget`` that meets all margins.

    ``attempt`` rakes at several budgets (None: no cell is limited) and gives for each the margin error, the largest budget
    that its weights leave within the cells, and the weights. Each of ``cuts`` tries that many parts of the open range.
    """
    whole, free = attempt([budget, None])
    if whole[0] <= MET or free[0] > MET:
        return budget, whole[0], whole[2]
    low, high = min(free[1], budget), budget
    best = low, free[0], free[2]
    for parts in cuts:
        grid = [low + (high - low) * j / parts for j in range(1, parts)]
        for at, (error, _, weights) in zip(grid, attempt(grid), strict=True):
            if error > MET:
                high = at
                break
            low, best = at, (at, error, weights)
    return best


def rake_table(cells: DataFrame, targets: Mapping[str, float | Mapping[str, float]], budget: float, rounds: int = ROUNDS,
               tolerance: float = 1e-9) -> DataFrame:
    """``cells`` with a column ``weight``, as ``rake`` gives it, for tables of any size: each margin is one aggregate and one join."""
    total = cells.agg(F.sum("tokens")).first()[0] or 0
    if not total:
        return cells.withColumn("weight", F.lit(0.0))
    state = _rake_table(cells, _goals(cells, targets), float(total), [budget], rounds, tolerance)
    return state.withColumnRenamed("weight_0", "weight")


def _goals(cells: DataFrame, targets: Mapping[str, float | Mapping[str, float]]) -> dict[str, DataFrame]:
    """Per margin, (category, cells, goal): how many cells it has and its target share."""
    spark = cells.sparkSession
    goals = {}
    for name in MARGINS:
        table = cells.groupBy(name).agg(F.sum("tokens").cast("double").alias("held"), F.count(F.lit(1)).alias("cells"))
        target = targets[name]
        if isinstance(target, Mapping):
            given = spark.createDataFrame([(k, float(v)) for k, v in target.items()], f"{name} string, goal double")
            table = table.join(given, name, "left").withColumn("goal", F.coalesce("goal", F.lit(0.0)))
        else:
            table = table.withColumn("goal", F.when(F.col("held") > 0, F.pow("held", F.lit(float(target)))).otherwise(0.0))
        table = staged(table, f"goal_{name}")
        whole = table.agg(F.sum("goal")).first()[0]
        goals[name] = table.select(name, "cells", (F.col("goal") / whole if whole else F.lit(0.0)).alias("goal"))
    return goals


def _rake_table(cells: DataFrame, goals: Mapping[str, DataFrame], total: float, budgets: Sequence[float | None], rounds: int,
                tolerance: float = 1e-9) -> DataFrame:
    """``cells`` with a column ``weight_i`` for the i-th budget; all are raked in the same rounds."""
    columns = [f"weight_{i}" for i in range(len(budgets))]
    state = staged(cells.select("*", *[(F.col("tokens") / F.lit(total)).alias(c) for c in columns]), "weights")
    for _ in range(rounds):
        raked = state.select("*", *[F.col(c).alias(f"before_{c}") for c in columns])
        for name in MARGINS:
            now = raked.groupBy(name).agg(*[F.sum(c).alias(f"now_{c}") for c in columns])
            factor = staged(goals[name].join(now, name).select(name, "cells", *[
                F.when(F.col(f"now_{c}") > 0, F.col("goal") / F.col(f"now_{c}")).otherwise(0.0).alias(f"factor_{c}") for c in columns]),
                "factors")
            raked = staged(attach(raked, factor, name, "cells").withColumns({c: F.col(c) * F.col(f"factor_{c}") for c in columns})
                           .drop("cells", *[f"factor_{c}" for c in columns]), "weights")
        capped = raked.withColumns({c: F.least(c, F.col("tokens") / F.lit(b * total))
                                    for c, b in zip(columns, budgets, strict=True) if b is not None})
        change = capped.agg(F.max(F.greatest(F.lit(0.0), *[F.abs(F.col(c) - F.col(f"before_{c}")) for c in columns]))).first()[0]
        state = capped.drop(*[f"before_{c}" for c in columns])
        if change < tolerance:
            break
    return state


def _attempts(cells: DataFrame, targets: Mapping[str, float | Mapping[str, float]], total: float,
              rounds: int) -> Callable[[Sequence[float | None]], list[tuple[float, float, object]]]:
    """``attempt`` of ``largest_budget`` on Spark; weights are a table with a column ``weight``."""
    goals = _goals(cells, targets)

    def attempt(budgets: Sequence[float | None]) -> list[tuple[float, float, object]]:
        state = _rake_table(cells, goals, total, budgets, rounds)
        columns = [f"weight_{i}" for i in range(len(budgets))]
        errors = [0.0] * len(budgets)
        for name in MARGINS:
            off = (state.groupBy(name).agg(*[F.sum(c).alias(c) for c in columns]).join(goals[name], name)
                   .agg(*[F.max(F.abs(F.col(c) - F.col("goal"))) for c in columns]).first())
            errors = [max(e, x) for e, x in zip(errors, off, strict=True)]
        fits = state.agg(*[F.min(F.when(F.col(c) > 0, F.col("tokens") / (F.col(c) * total))) for c in columns]).first()
        return [(e, f or 0.0, state.select(*MARGINS, "tokens", "n", F.col(c).alias("weight")))
                for e, f, c in zip(errors, fits, columns, strict=True)]

    return attempt


def calibrated(rows: DataFrame, targets: Mapping[str, float | Mapping[str, float]] = TARGETS, budget: float = BUDGET,
               max_cells: int = MAX_CELLS, rounds: int = ROUNDS) -> tuple[DataFrame, bool]:
    """One row per cell of ``rows`` (from ``profiled``), and whether they are few.

    source, lang, topic, n, weight (the cell's share of the tokens of ``budget``), probability, budget (taken), margin_error.
    """
    spark = rows.sparkSession
    table = rows.groupBy(*MARGINS).agg(F.sum("tokens").alias("tokens"), F.count(F.lit(1)).alias("n"))
    found = table.limit(max_cells + 1).collect()
    if len(found) > max_cells:
        cells = staged(table, "cells")
        total = float(cells.agg(F.sum("tokens")).first()[0])
        if total:
            taken, error, state = largest_budget(_attempts(cells, targets, total, rounds), budget, (16, 16))
        else:
            taken, error, state = budget, 0.0, cells.withColumn("weight", F.lit(0.0))
        take = F.when(F.col("tokens") > 0, F.least(F.lit(1.0), F.col("weight") * F.lit(taken * total) / F.col("tokens")))
        return staged(state.select(*MARGINS, "n", (F.col("weight") * F.lit(taken / budget)).alias("weight"),
                                   take.otherwise(taken).alias("probability"), F.lit(taken).alias("budget"),
                                   F.lit(error).alias("margin_error")), "calibrated"), False
    found.sort(key=lambda r: tuple(r[m] for m in MARGINS))
    held = np.array([r["tokens"] for r in found], float)
    total = float(held.sum())
    margins = margins_of([tuple(r[m] for m in MARGINS) for r in found], held, targets)

    def attempt(budgets: Sequence[float | None]) -> list[tuple[float, float, object]]:
        out = []
        for b in budgets:
            weight = _rake(margins, held, b, rounds)
            fits = np.divide(held, weight * total, out=np.full(len(held), np.inf), where=weight > 0).min(initial=np.inf)
            out.append((margin_error(margins, weight), float(fits), weight))
        return out

    taken, error, weight = largest_budget(attempt, budget, (2,) * 8) if total else (budget, 0.0, np.zeros(len(held)))
    take = np.minimum(1.0, np.divide(weight * taken * total, held, out=np.full(len(held), taken), where=held > 0))
    out = [(*[r[m] for m in MARGINS], r["n"], float(w) * taken / budget, float(p), taken, error)
           for r, w, p in zip(found, weight, take, strict=True)]
    return spark.createDataFrame(out, "source string, lang string, topic string, n long, weight double, probability double, "
                                 "budget double, margin_error double"), True


def mix(docs: DataFrame, targets: Mapping[str, float | Mapping[str, float]] = TARGETS, budget: float = BUDGET,
        max_cells: int = MAX_CELLS, rounds: int = ROUNDS, vocabulary: str = VOCABULARY) -> DataFrame:
    """(doc_id, source, lang, topic, tokens, weight, probability, selected, budget, margin_error) for every row of ``docs``."""
    rows = profiled(docs, vocabulary)
    cells, few = calibrated(rows, targets, budget, max_cells, rounds)
    if few:
        joined = rows.join(F.broadcast(cells), list(MARGINS), "left")
    else:
        cell = F.struct(*MARGINS).alias("cell")
        joined = attach(rows.withColumn("cell", cell), cells.select(cell, "n", "weight", "probability", "budget", "margin_error"), "cell", "n")
    return joined.select(
        "doc_id", *[F.nullif(F.col(m), F.lit(NONE)).alias(m) for m in MARGINS], "tokens", "weight", "probability",
        (F.col("draw") < F.col("probability")).alias("selected"), "budget", "margin_error")


def keep_sampled(docs: DataFrame, targets: Mapping[str, float | Mapping[str, float]] = TARGETS, budget: float = BUDGET,
                 max_cells: int = MAX_CELLS, rounds: int = ROUNDS, vocabulary: str = VOCABULARY) -> DataFrame:
    """The sampled rows of ``docs``, with all their columns."""
    given, docs = docs.columns, unambiguous(docs, ["doc_id", "text", "lang", "source"])
    cells, few = calibrated(profiled(docs, vocabulary), targets, budget, max_cells, rounds)
    mine = cell_columns(docs)

    def same(table: DataFrame) -> Column:
        return reduce(Column.__and__, [own == table[m] for own, m in zip(mine, MARGINS, strict=True)])

    def sampled(rows: DataFrame, table: DataFrame) -> DataFrame:
        return rows.join(table, same(table) & (draw(docs) < table["probability"]), "left_semi")

    if few:
        return sampled(docs, F.broadcast(cells)).toDF(*given)
    # At most 1,000 cells hold over 1/1000 of all rows each; their documents are not shuffled.
    limit = max(1, cells.agg(F.sum("n")).first()[0] // 1000)
    hot, cold = F.broadcast(cells.where(F.col("n") > limit)), cells.where(F.col("n") <= limit)
    return sampled(docs, hot).unionAll(sampled(docs.join(hot, same(hot), "left_anti"), cold)).toDF(*given)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(read(spark, sf_dir, "documents"))
