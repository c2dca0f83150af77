"""Mix sources to target weights by iterative proportional fitting.

Tokens are summed by (source, language, topic) cell. The cells are raked: in turn, for each dimension, the
weight of every category is scaled so that its share of the tokens meets the target, until all three
marginals hold. A document's probability is its cell's factor, the weight divided by the tokens, so the
sample's expected tokens are the weights, and no document is needed twice.

Targets are tempered shares: (share of the tokens) ^ ALPHA, scaled to sum 1, which lifts rare categories
and lowers dominant ones; ``targets`` gives other ones. ``rate`` says how many tokens the sample aims at, as a share
of all. A category can't give more tokens than it has: its goal ends there, and the goals of all dimensions are then scaled to
the same sum. Nor can a cell: its weight is clipped to its tokens in every round, and the other cells of its
categories make up for it in the rounds that follow. So a stray document of a rare category is kept whole, and does not
lower the probability of any other. Without a rate, given ``targets`` are met exactly by as many tokens as that allows: the
largest factor is 1, and it is the scarcest category that decides how much is kept.

Only DataFrame and SQL functions are used. Every source and every language is a category with a goal of its own, however many
there are: the raking is sums by category over the table of cells, joined back to the cells. It goes on, STEPS rounds at a
time, until no category's weight misses its goal by more than MISS (EXACT without a rate), or for ROUNDS rounds, which may
happen if cells are clipped whose categories have no others to make up for it; ``misses`` tells how far each category is off.

Defined cases: a missing source or language is a category of its own, which ``targets`` may name None; a category that a
dimension's ``targets`` leave out gets none; a missing or empty text has no tokens; a cell without tokens can't be raked, its
documents have probability 1; equal ids share one draw, so repeated rows stay or go together, and rows without an id share the
draw of the empty id; texts of any length are only counted; an empty table gives no rows; further columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from parceltrail.llm.common import stored

ALPHA = 0.9
#: Tokens that the sample aims at, as a share of all.
RATE = 1.0
#: Rounds at most, rounds between two looks, and the share of its goal by which no category may be off in the end.
ROUNDS, STEPS, MISS, EXACT = 200, 10, 1e-4, 1e-9
#: Up to so many cells are raked in one task.
CELLS = 100_000
#: Topic and the marks of which a text holds one; the first that fits, else "prose".
TOPICS = (
    ("legal", ("license", "License", "LICENSE", "copyright", "Copyright")),
    ("contact", ("@",)),
    ("table", (" | ",)),
    ("web", ("http://", "https://", "www.")),
)
DIMENSIONS = ("source", "lang", "topic")


def topic(text: Column) -> Column:
    out = F.lit("prose")
    for name, marks in reversed(TOPICS):
        held = F.lit(False)
        for mark in marks:
            held = held | F.contains(text, F.lit(mark))
        out = F.when(held, name).otherwise(out)
    return out


def tokens(text: Column) -> Column:
    """About four bytes make a token."""
    return F.ceil(F.octet_length(text) / 4).cast("long")


def draw(doc_id: Column) -> Column:
    """Uniform in [0, 1), from the first 52 bits of the md5 of the id."""
    digest = F.md5(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary"))
    return F.conv(F.substring(digest, 1, 13), 16, 10).cast("double") / float(1 << 52)


def _slim(documents: DataFrame) -> DataFrame:
    raw = F.coalesce(F.col("text"), F.lit(""))
    return documents.select("doc_id", "source", "lang", topic(raw).alias("topic"), tokens(raw).alias("tokens"))


def _same(rows: DataFrame, other: DataFrame, names) -> Column:
    """``names`` of ``rows`` equal those of ``other``, which have an underscore before them; null equals null."""
    out = F.lit(True)
    for name in names:
        out = out & rows[name].eqNullSafe(other[f"_{name}"])
    return out


def _per_category(cells: DataFrame, name: str, value: Column) -> DataFrame:
    """Add ``value``, an aggregate over all cells of the same category of a dimension."""
    sums = cells.groupBy(name).agg(value).withColumnRenamed(name, f"_{name}")
    if name == "topic":
        sums = F.broadcast(sums)  # len(TOPICS) + 1 rows
    return cells.join(sums, _same(cells, sums, [name])).drop(f"_{name}")


def _goal(cells: DataFrame, name: str, alpha: float, targets: dict | None, rate: float | None) -> DataFrame:
    """Add <dimension>_goal, the tokens that the category should have. Without a rate only their ratios count."""
    if targets and name in targets:
        share = F.lit(0.0)
        for category, value in targets[name].items():
            share = F.when(F.col(name).eqNullSafe(F.lit(category)), float(value)).otherwise(share)
        share = F.first(share)
    else:
        share = F.pow(F.sum("n"), F.lit(alpha))
    sums = cells.groupBy(name).agg(share.alias("share"), F.sum("n").alias("own"))
    every = sums.agg(F.sum("share").alias("shares"), F.sum("own").alias("all"))
    goals = sums.crossJoin(F.broadcast(every))  # one row
    goal = F.col("all") * F.col("share") / F.nullif("shares", F.lit(0.0))
    if rate is not None:
        goal = F.least(goal * rate, F.col("own"))
    goals = goals.select(F.col(name).alias(f"_{name}"), F.coalesce(goal, F.lit(0.0)).alias(f"{name}_goal"))
    return cells.join(goals, _same(cells, goals, [name])).drop(f"_{name}")


def _common(cells: DataFrame) -> DataFrame:
    """Goals of all dimensions scaled to the least of their sums, so that they can hold together."""
    sums = []
    for name in DIMENSIONS:
        per = cells.groupBy(name).agg(F.first(f"{name}_goal").alias("goal"))
        sums.append(per.agg(F.sum("goal").alias(f"{name}_sum")))
    all_sums = sums[0].crossJoin(sums[1]).crossJoin(sums[2])  # one row each
    scaled = cells.crossJoin(F.broadcast(all_sums))
    least = F.least(*[F.col(f"{name}_sum") for name in DIMENSIONS])
    goals = {
        f"{name}_goal": F.coalesce(F.col(f"{name}_goal") * least / F.nullif(f"{name}_sum", F.lit(0.0)), F.lit(0.0))
        for name in DIMENSIONS
    }
    return scaled.withColumns(goals).select(*cells.columns)


def _scaled(cells: DataFrame, name: str, clip: bool) -> DataFrame:
    """The weights after the step of a dimension; ``cells`` has the category's sum."""
    weight = F.coalesce(F.col("w") * F.col(f"{name}_goal") / F.nullif("sum", F.lit(0.0)), F.lit(0.0))
    return cells.withColumn("w", F.least(weight, F.col("n")) if clip else weight).drop("sum")


def _few_rounds(cells: DataFrame, clip: bool, steps: int) -> DataFrame:
    """``steps`` rounds over at most CELLS cells, which one task does quickly without a shuffle."""
    cells = cells.coalesce(1)
    for _ in range(steps):
        for name in DIMENSIONS:
            cells = _scaled(cells.withColumn("sum", F.sum("w").over(Window.partitionBy(name))), name, clip)
    return stored(cells, "mix-round")


def _rounds(cells: DataFrame, clip: bool, steps: int) -> DataFrame:
    """The same for any number of cells; every round is written, which keeps the plan short."""
    for _ in range(steps):
        for name in DIMENSIONS:
            cells = _scaled(_per_category(cells, name, F.sum("w").alias("sum")), name, clip)
        cells = stored(cells, "mix-round")
    return cells


def misses(raked: DataFrame) -> DataFrame:
    """dimension, category, goal, weight, miss (relative) of every category of ``raked_cells``."""
    out = None
    for name in DIMENSIONS:
        per = raked.groupBy(F.col(name).alias("category")).agg(
            F.first(f"{name}_goal").alias("goal"), F.sum("w").alias("weight")
        )
        miss = F.abs(F.col("weight") / F.nullif("goal", F.lit(0.0)) - 1)
        per = per.select(F.lit(name).alias("dimension"), "category", "goal", "weight", miss.alias("miss"))
        out = per if out is None else out.unionByName(per)
    return out


def rake(cells: DataFrame, rounds: int = ROUNDS, clip: bool = True, most_miss: float = MISS) -> DataFrame:
    """``cells`` with the weight w whose sums meet the goals of each dimension, from the tokens n; clipped to them if asked."""
    some = _few_rounds if cells.count() <= CELLS else _rounds
    cells = cells.withColumn("w", F.col("n"))
    done = 0
    while done < rounds:
        cells = some(cells, clip, min(STEPS, rounds - done))
        done += STEPS
        worst = misses(cells).agg(F.max("miss")).first()[0]
        if worst is None or worst <= most_miss:
            break
    return cells


def raked_cells(
    documents: DataFrame,
    alpha: float = ALPHA,
    rounds: int = ROUNDS,
    targets: dict | None = None,
    rate: float | None = None,
    most_miss: float | None = None,
) -> DataFrame:
    """source, lang, topic, n, the goals of the three categories and w of each cell with tokens.

    ``targets``: shares by dimension and category name that replace the tempered ones, such as
    {"lang": {"en": 0.5, None: 0.5}}; categories of a named dimension that it leaves out get none. ``rate`` is RATE
    unless given or ``targets`` are.
    """
    if rate is None and targets is None:
        rate = RATE
    sums = _slim(documents).groupBy(*DIMENSIONS).agg(F.sum("tokens").cast("double").alias("n"))
    cells = stored(sums.where("n > 0"), "mix-cells")
    for name in DIMENSIONS:
        cells = _goal(cells, name, alpha, targets, rate)
    cells = stored(cells, "mix-goals")
    if rate is not None:
        cells = stored(_common(cells), "mix-goals")
    most = (EXACT if rate is None else MISS) if most_miss is None else most_miss
    return rake(cells, rounds, rate is not None, most)


def calibrate(
    documents: DataFrame,
    alpha: float = ALPHA,
    rounds: int = ROUNDS,
    targets: dict | None = None,
    rate: float | None = None,
    most_miss: float | None = None,
) -> DataFrame:
    """_source, _lang, _topic, probability of each cell with tokens; parameters as of ``raked_cells``."""
    raked = raked_cells(documents, alpha, rounds, targets, rate, most_miss)
    factor = F.col("w") / F.col("n")
    if rate is None and targets is not None:
        top = F.broadcast(raked.agg(F.max(factor).alias("top")))  # one row
        raked, factor = raked.crossJoin(top), factor / F.nullif("top", F.lit(0.0))
    names = [F.col(name).alias(f"_{name}") for name in DIMENSIONS]
    return stored(raked.select(*names, F.coalesce(factor, F.lit(0.0)).alias("probability")), "mix-factors")


def _with_probability(rows: DataFrame, cells: DataFrame) -> DataFrame:
    """Rows with their cell's probability. How they meet is left to Catalyst, which sees the stored cells' size: mostly the
    cells are sent, else adaptive execution splits hot ones."""
    found = rows.join(cells, _same(rows, cells, DIMENSIONS), "left")
    return found.withColumn("probability", F.coalesce("probability", F.lit(1.0)))


def mix(documents: DataFrame, **how) -> DataFrame:
    """doc_id, source, lang, topic, tokens, probability, kept of every row of ``documents``."""
    rows = _with_probability(_slim(documents), calibrate(documents, **how))
    return rows.select(
        "doc_id",
        "source",
        "lang",
        "topic",
        "tokens",
        "probability",
        # No draw reaches 1.
        (draw(F.col("doc_id")) < F.col("probability")).alias("kept"),
    )


def sample(documents: DataFrame, **how) -> DataFrame:
    """The rows of ``documents`` that the mixture keeps, with their columns; text is not shuffled."""
    columns = documents.columns
    raw = F.coalesce(F.col("text"), F.lit(""))
    # The document travels as one struct, so that none of its columns clashes with the ones used here.
    rows = documents.select(
        F.struct(*[F.col(f"`{c}`") for c in columns]).alias("_document"),
        F.col("doc_id").alias("_id"), "source", "lang", topic(raw).alias("topic"),
    )
    rows = _with_probability(rows, calibrate(documents, **how))
    return rows.where(draw(F.col("_id")) < F.col("probability")).select("_document.*")
