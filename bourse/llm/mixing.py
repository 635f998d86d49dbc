"""Mixing sources to target weights by iterative proportional fitting, in DataFrame functions only.

Documents fall into cells (source, language, topic); each document of a cell is sampled with
the cell's probability.  The sample is calibrated: it is to have ``keep`` of all tokens, shared out over the
values of each dimension by target shares.

A value cannot give more tokens than it has.  Values short of their share are taken
whole and their missing tokens are dealt to the others, in proportion to their shares: the goal of a value is
the lesser of its tokens and a level times its share, with the level at which the goals sum to the
sample's size.  So a tiny new source is kept whole and moves nothing else.  ``mixture`` returns the goals, the
shortfalls and what raking reached.

Raking then multiplies the factor of every cell, one dimension after the other, until all marginals meet
their goals within ``TOLERANCE``.  A cell's probability is its factor, or 1 if that is more; such a cell
gives all it has, so a value's factors are multiplied by (goal - tokens of its whole cells) / (expected tokens
of its other cells).  Goals that contradict each other are reported.

The cells are a table.  Few cells (counted) are raked in one partition, eight sweeps a job and no
shuffle; more than ``FEW_CELLS`` by an aggregation and a join per dimension.
"""

from __future__ import annotations

import warnings

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from bourse.llm.common import broadcast_if_small, fresh

# Topic of a text: the first of these patterns that it contains, else "general".
TOPICS = (
    ("licensing", "Licensed under|Copyright|All rights reserved"),
    ("credentials", "password|passwd|secret|token|AKIA"),
    ("contact", "@[a-z0-9-]+[.]|https?://"),
)
# Target shares are the present shares to these powers (then made to sum to 1): below 1 lifts what is rare.
TEMPER = {"source": 0.7, "lang": 0.8, "topic": 0.9}
KEEP = 0.9  # share of all tokens that the sample is to have
SWEEPS = 8  # at a time, until the largest relative error of a marginal is below TOLERANCE
TOLERANCE = 1e-9
MOST_SWEEPS = 200
FEW_CELLS = 20_000
BROADCAST_ROWS = 200_000
WORD = r"[^\x20\x09-\x0D]+"


def topic_of(text: Column, topics: tuple[tuple[str, str], ...] = TOPICS) -> Column:
    found = F.lit("general")
    for name, pattern in reversed(topics):
        found = F.when(text.rlike(pattern), name).otherwise(found)
    return found


def uniform(row_id: Column, seed: str) -> Column:
    """A number in [0, 1) that depends on the id and the seed alone."""
    digits = F.substring(F.md5(F.concat(F.coalesce(row_id.cast("string"), F.lit("null")), F.lit(":" + seed))), 1, 13)
    return F.conv(digits, 16, 10).cast("long").cast("double") / float(16**13)


def _value(c: Column) -> Column:
    """A dimension's value as a key that tells null from every text."""
    return F.when(c.isNull(), "-").otherwise(F.concat(F.lit("="), c.cast("string")))


def goals(cells: DataFrame, dim: str, targets: DataFrame | None, power: float, size: float) -> DataFrame:
    """``<dim>, has, share, goal``: tokens of every value, its target share, and its part of ``size`` tokens.

    ``targets`` has columns ``dim``, share; a value that it lacks gets nothing.  Without it
    shares are the present ones to ``power``.
    """
    values = cells.groupBy(dim).agg(F.sum("t").alias("has"))
    if targets is not None:
        want = targets.select(_value(F.col(dim)).alias(dim), F.col("share").cast("double").alias("w"))
        values = values.join(want, dim, "left").withColumn("w", F.coalesce("w", F.lit(0.0)))
    else:
        values = values.withColumn("w", F.when(F.col("has") > 0, F.pow(F.col("has").cast("double"), power)).otherwise(0.0))
    # filled up in the order in which values run out: the level with the first k values taken whole, at its largest
    wanted = F.col("w") > 0
    runs_out = Window.orderBy(F.when(wanted, F.col("has") / F.col("w")).asc_nulls_last(), F.col(dim))  # one row per value
    before = F.coalesce(F.sum(F.when(wanted, F.col("has"))).over(runs_out.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    still = F.sum(F.when(wanted, F.col("w"))).over(runs_out.rowsBetween(Window.currentRow, Window.unboundedFollowing))
    level = F.max(F.when(wanted, (F.lit(size) - before) / F.col("still"))).over(Window.partitionBy(F.lit(1)))
    filled = values.withColumn("still", still).withColumn("level", level)
    total = F.sum("w").over(Window.partitionBy(F.lit(1)))
    return filled.select(
        dim, "has", F.when(total > 0, F.col("w") / total).otherwise(0.0).alias("share"),
        F.when(wanted, F.least(F.col("has").cast("double"), F.col("level") * F.col("w"))).otherwise(0.0).alias("goal"),
    )


def rake(
    cells: DataFrame,
    dims: list[str],
    targets: dict[str, DataFrame] | None,
    temper: dict[str, float],
    keep: float = KEEP,
    few_cells: int = FEW_CELLS,
) -> DataFrame:
    """``cells`` (one row per combination of ``dims``, column ``t`` tokens) with the goals ``g_<dim>`` and the probability ``p``."""
    total = float(cells.agg(F.sum("t")).first()[0] or 0)

    def all_goals(size: float) -> dict[str, DataFrame]:
        return {d: goals(cells, d, (targets or {}).get(d), temper.get(d, 1.0), size) for d in dims}

    size = keep * total
    # values without a share give nothing: the sample is no larger than what the others have
    reach = [r.agg(F.sum(F.when(F.col("share") > 0, F.col("has")))).first()[0] or 0 for r in all_goals(size).values()]
    size = min([size, *map(float, reach)])
    out = cells
    for d, g in all_goals(size).items():
        out = out.join(g.select(d, F.col("goal").alias("g_" + d)), d)
    out = out.withColumn("f", F.lit(size / total if total > 0 else 1.0)).checkpoint()
    few = out.count() <= few_cells
    if few:
        out = out.coalesce(1)
    errors: list[float] = []
    for done in range(SWEEPS, MOST_SWEEPS + 1, SWEEPS):
        for _ in range(SWEEPS):
            for d in dims:
                out = _fit(out, d, few)
                if not few:  # each join reads its table twice
                    out = out.checkpoint()
        out = out.checkpoint() if few else out
        errors.append(_largest_error(out, dims))
        if errors[-1] <= TOLERANCE:
            return out.withColumn("p", F.least("f", F.lit(1.0)))
        out = out.coalesce(1) if few else out
    missed = max(0.0, errors[-1])
    warnings.warn(f"raking: a marginal misses its goal by {missed:.2g} of it after {done} sweeps; the targets contradict", stacklevel=2)
    return out.withColumn("p", F.least("f", F.lit(1.0)))


def _fit(cells: DataFrame, d: str, few: bool) -> DataFrame:
    """One dimension's marginal brought to its goal by what is not taken whole yet."""
    whole = F.sum(F.when(F.col("f") >= 1, F.col("t")).otherwise(0))
    open_ = F.sum(F.when(F.col("f") < 1, F.col("t") * F.col("f")).otherwise(0.0))
    if few:  # all cells lie in one partition: no shuffle
        by = Window.partitionBy(d)
        cells = cells.withColumns({"whole": whole.over(by), "open": open_.over(by)})
    else:
        cells = cells.join(cells.groupBy(d).agg(whole.alias("whole"), open_.alias("open")), d)
    goal, now = F.col("g_" + d), F.col("whole") + F.col("open")
    times = F.when((F.col("open") > 0) & (goal > F.col("whole")), (goal - F.col("whole")) / F.col("open")).when(now > 0, goal / now).otherwise(1.0)
    return cells.withColumn("f", F.col("f") * times).drop("whole", "open")


def _largest_error(cells: DataFrame, dims: list[str]) -> float:
    """The largest error of a marginal, relative to its goal."""
    p = F.least(F.col("f"), F.lit(1.0))
    parts = [cells.groupBy(d).agg(F.sum(F.col("t") * p).alias("now"), F.max("g_" + d).alias("want")).drop(d) for d in dims]
    both = parts[0]
    for x in parts[1:]:
        both = both.unionByName(x)
    return both.where("want > 0").agg(F.max(F.abs(F.col("now") - F.col("want")) / F.col("want"))).first()[0] or 0.0


def _with_probability(
    docs: DataFrame, text_col: str, source_col: str, lang_col: str, topic_col: str | None, targets, temper, keep, broadcast_rows, few_cells
):
    """``docs`` with its topic, its number of tokens and its probability in columns of new names, and those names."""
    names = fresh(docs.columns, "_topic", "_tokens", "_p", "_source_key", "_lang_key", "_topic_key")
    topic, tokens, p, *keys = names
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.withColumns(
        {
            topic: F.col(topic_col).cast("string") if topic_col else topic_of(text),
            tokens: F.regexp_count(text, F.lit(WORD)).cast("long"),
        }
    )
    rows = rows.withColumns({k: _value(F.col(c)) for k, c in zip(keys, (source_col, lang_col, topic), strict=True)})
    dims = ["source", "lang", "topic"]
    cells = rows.groupBy(*keys).agg(F.sum(tokens).alias("t"))
    cells = cells.select(*(F.col(k).alias(d) for k, d in zip(keys, dims, strict=True)), "t").checkpoint()
    raked = rake(cells, dims, targets, temper, keep, few_cells)
    factors = raked.select(*(F.col(d).alias(k) for d, k in zip(dims, keys, strict=True)), F.col("p").alias(p)).checkpoint()
    return rows.join(broadcast_if_small(factors, broadcast_rows), keys).drop(*keys), raked, topic, tokens, p


def mix(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    lang_col: str = "lang",
    topic_col: str | None = None,
    targets: dict[str, DataFrame] | None = None,
    temper: dict[str, float] = TEMPER,
    keep: float = KEEP,
    seed: str = "mix",
    broadcast_rows: int = BROADCAST_ROWS,
    few_cells: int = FEW_CELLS,
) -> DataFrame:
    """``doc_id, source, lang, topic, n_tokens, weight, probability, sampled`` per row of ``docs``.

    ``weight`` is the probability over ``keep``: above 1 for what the mixture lifts.  A topic is the value of
    ``topic_col``, or the first of ``TOPICS`` that the text contains.  Null source, language, topic or text is a value
    of its own (null text has no tokens); rows without tokens carry their cell's probability and do not move
    the marginals; repeated ids are drawn alike; an empty table gives no rows.  Other columns, whatever their names, are not read.
    """
    columns = {"doc_id": id_col, "text": text_col, "source": source_col, "lang": lang_col}
    rows = docs.select(*(F.col(c).alias(n) for n, c in columns.items()), *([F.col(topic_col).alias("topic")] if topic_col else []))
    drawn, _, topic, tokens, p = _with_probability(
        rows, "text", "source", "lang", "topic" if topic_col else None, targets, temper, keep, broadcast_rows, few_cells
    )
    return drawn.select(
        "doc_id",
        "source",
        "lang",
        F.col(topic).alias("topic"),
        F.col(tokens).alias("n_tokens"),
        F.round(F.col(p) / keep, 6).alias("weight"),
        F.round(p, 6).alias("probability"),
        (uniform(F.col("doc_id"), seed) < F.col(p)).alias("sampled"),
    )


def mixed_documents(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    lang_col: str = "lang",
    topic_col: str | None = None,
    targets: dict[str, DataFrame] | None = None,
    temper: dict[str, float] = TEMPER,
    keep: float = KEEP,
    seed: str = "mix",
    broadcast_rows: int = BROADCAST_ROWS,
    few_cells: int = FEW_CELLS,
) -> DataFrame:
    """The sampled rows of ``docs``, all columns unchanged, whatever their names.

    Nulls, ties, repeated ids and empty tables are treated as ``mix`` does.
    """
    drawn, _, _, _, p = _with_probability(docs, text_col, source_col, lang_col, topic_col, targets, temper, keep, broadcast_rows, few_cells)
    return drawn.where(uniform(F.col(id_col), seed) < F.col(p)).select(*docs.columns)


def mixture(
    docs: DataFrame,
    text_col: str = "text",
    source_col: str = "source",
    lang_col: str = "lang",
    topic_col: str | None = None,
    targets: dict[str, DataFrame] | None = None,
    temper: dict[str, float] = TEMPER,
    keep: float = KEEP,
) -> DataFrame:
    """``dimension, value, has, share, goal, short, expected``: tokens of each value, its target share, its goal,
    how many tokens it is short of its share of the sample, and what the raked probabilities give it."""
    _, raked, *_ = _with_probability(docs, text_col, source_col, lang_col, topic_col, targets, temper, keep, BROADCAST_ROWS, FEW_CELLS)
    raked = raked.select("source", "lang", "topic", "t", "p").checkpoint()
    size = keep * float(raked.agg(F.sum("t")).first()[0] or 0)
    parts = []
    for d in ("source", "lang", "topic"):
        g = goals(raked, d, (targets or {}).get(d), temper.get(d, 1.0), size)
        got = raked.groupBy(d).agg(F.sum(F.col("t") * F.col("p")).alias("expected"))
        parts.append(
            g.join(got, d).select(
                F.lit(d).alias("dimension"), F.when(F.col(d) != "-", F.substring(d, 2, 1 << 30)).alias("value"), "has", "share", "goal",
                F.greatest(F.col("share") * size - F.col("goal"), F.lit(0.0)).alias("short"), "expected",
            )
        )
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def oracle(temper: dict[str, float] = TEMPER, keep: float = KEEP, seed: str = "mix") -> str:
    """The result of ``mix`` as DuckDB SQL over ``documents``: sweeps over the cells as a recursive query, with the same stop."""
    dims = ["source", "lang", "topic"]
    cases = " ".join(f"WHEN regexp_matches(coalesce(text, ''), '{p}') THEN '{n}'" for n, p in TOPICS)
    wants = ",\n".join(
        f"v_{d} AS (SELECT {d}, sum(t) AS has, CASE WHEN sum(t) > 0 THEN pow(CAST(sum(t) AS DOUBLE), {temper[d]}) ELSE 0 END AS w "
        f"FROM cells GROUP BY {d}),\n"
        f"k_{d} AS (SELECT *, coalesce(sum(has) FILTER (w > 0) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before, "
        f"sum(w) FILTER (w > 0) OVER (o ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS still "
        f"FROM v_{d} WINDOW o AS (ORDER BY CASE WHEN w > 0 THEN has / w END NULLS LAST, {d} NULLS FIRST)),\n"
        f"t_{d} AS (SELECT {d}, CASE WHEN w > 0 THEN least(CAST(has AS DOUBLE), "
        f"max(CASE WHEN w > 0 THEN ({keep} * (SELECT sum(t) FROM cells) - before) / still END) OVER () * w) ELSE 0 END AS goal FROM k_{d})"
        for d in dims
    )
    joins = " ".join(f"JOIN t_{d} ON t_{d}.{d} IS NOT DISTINCT FROM cells.{d}" for d in dims)
    goal = ", ".join(f"t_{d}.goal AS g_{d}" for d in dims)
    last = f"(SELECT * FROM sw WHERE n < {MOST_SWEEPS} AND NOT (n > 0 AND n % {SWEEPS} = 0 AND miss <= {TOLERANCE}))"
    for d in dims:
        last = (
            f"(SELECT * EXCLUDE (whole, rest) REPLACE (f * CASE WHEN rest > 0 AND g_{d} > whole THEN (g_{d} - whole) / rest "
            f"WHEN whole + rest > 0 THEN g_{d} / (whole + rest) ELSE 1 END AS f) "
            f"FROM (SELECT *, sum(CASE WHEN f >= 1 THEN t ELSE 0 END) OVER (PARTITION BY {d}) AS whole, "
            f"sum(CASE WHEN f < 1 THEN t * f ELSE 0 END) OVER (PARTITION BY {d}) AS rest FROM {last}))"
        )
    errors = ", ".join(f"abs(sum(t * least(f, 1)) OVER (PARTITION BY {d}) - g_{d}) / nullif(g_{d}, 0)" for d in dims)
    return f"""
WITH RECURSIVE r AS (SELECT doc_id, source, lang, CASE {cases} ELSE 'general' END AS topic,
  CAST(len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS BIGINT) AS n_tokens FROM documents),
cells AS MATERIALIZED (SELECT source, lang, topic, CAST(sum(n_tokens) AS BIGINT) AS t FROM r GROUP BY ALL),
{wants},
sw AS (
  SELECT cells.source, cells.lang, cells.topic, t, {goal}, CAST({keep} AS DOUBLE) AS f, 0 AS n, CAST(1 AS DOUBLE) AS miss FROM cells {joins}
  UNION ALL
  SELECT source, lang, topic, t, g_source, g_lang, g_topic, f, n, max(miss) OVER () AS miss
  FROM (SELECT source, lang, topic, t, g_source, g_lang, g_topic, f, n + 1 AS n, coalesce(greatest({errors}), 0) AS miss FROM {last})),
fin AS (SELECT *, least(f, 1) AS p FROM sw WHERE n = (SELECT max(n) FROM sw))
SELECT doc_id, r.source, r.lang, r.topic, n_tokens, round(p / {keep}, 6) AS weight, round(p, 6) AS probability,
  CAST(('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), 'null') || ':{seed}'), 1, 13)) AS BIGINT) / pow(16, 13) < p AS sampled
FROM r JOIN fin ON r.source IS NOT DISTINCT FROM fin.source AND r.lang IS NOT DISTINCT FROM fin.lang AND r.topic = fin.topic"""
