"""Mixing sources to target weights by raking.

Documents are summed to cells (one per combination of source, language and
topic). Iterative proportional fitting multiplies each cell's weight until the
tokens of every source, language and topic make up their target share; each
step is one pre-aggregated sum per margin over the cells. A document's weight
is its cell's factor, and it is drawn with a probability in proportion to
that, by a hash of its id: draws are independent and the same in every run.
Given a budget of tokens, cells that would need more than all their rows are
taken whole, and the others' probabilities are solved again to meet it.

DataFrame functions alone: texts are read by built-in functions, and nothing
but one row of totals comes to the driver.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import materialize

SWEEPS = 8
TEMPER = 0.7
SEED = 17
BROADCAST_CELLS = 100_000
CELL_FILES = 8   # files of a table of cells

DIMS = ("source", "lang", "topic")


def token_weight(text: Column) -> Column:
    """Words of a text, as its blanks and line breaks tell; an empty or null text has none."""
    whole = F.length(text)
    seen = 2 * whole - F.length(F.replace(text, F.lit(" "))) - F.length(F.replace(text, F.lit("\n"))) + 1
    return F.when(F.coalesce(whole, F.lit(0)) == 0, 0).otherwise(seen).cast("double")


def topic_of(text: Column) -> Column:
    """What kind of text it is, by its marks and length (fixed values: list, noise, shout, note, article)."""
    noise = F.lit(False)
    for mark in ("%%%", "###", "***", "&&&", "$$$"):
        noise = noise | F.contains(text, F.lit(mark))
    return (F.when(F.contains(text, F.lit(" | ")), "list").when(noise, "noise")
            .when(F.contains(text, F.lit("!!")), "shout").when(F.length(text) < 1000, "note").otherwise("article"))


def with_margins(docs: DataFrame, topic: Column | None = None) -> DataFrame:
    """``docs`` with m_source, m_lang, m_topic (null: empty text) and m_tokens (replacing equal names)."""
    text = F.col("text").cast("string")
    return docs.withColumns({
        "m_source": F.coalesce(F.col("source").cast("string"), F.lit("")),
        "m_lang": F.coalesce(F.col("lang").cast("string"), F.lit("")),
        "m_topic": F.coalesce(topic_of(text) if topic is None else topic, F.lit("")),
        "m_tokens": token_weight(text),
    })


def tempered_targets(cells: DataFrame, dim: str, power: float = TEMPER) -> DataFrame:
    """Target shares of ``dim``: the present shares of tokens to the power ``power``, made to sum to 1."""
    here = cells.groupBy(dim).agg(F.sum("m_tokens").alias("tokens"))
    raised = here.select(dim, F.pow("tokens", F.lit(power)).alias("raised"))
    whole = raised.agg(F.sum("raised").alias("whole"))
    return raised.join(F.broadcast(whole)).select(dim, F.when(F.col("whole") > 0, F.col("raised") / F.col("whole"))
                                                  .otherwise(0.0).alias("target"))


def rake(cells: DataFrame, targets: dict[str, DataFrame], sweeps: int = SWEEPS) -> DataFrame:
    """``cells`` (the margins' columns, m_tokens) with the fitted ``factor``.

    ``targets``: per margin column, a table of it and the ``target`` share. A
    value without target keeps its weight in that step, as does one without tokens.
    """
    total = cells.agg(F.coalesce(F.sum("m_tokens"), F.lit(0.0))).first()[0]
    fitted = cells.withColumn("factor", F.lit(1.0))
    for dim, target in targets.items():
        fitted = fitted.join(target.select(dim, F.col("target").alias(f"to_{dim}")), dim, "left")
    fitted = materialize(fitted, files=CELL_FILES)
    # each step is written: the next reads it twice, and nested steps would double the plan each time
    for _ in range(sweeps):
        for dim in targets:
            now = fitted.groupBy(dim).agg(F.sum(F.col("m_tokens") * F.col("factor")).alias("now"))
            ratio = F.when((F.col("now") > 0) & F.col(f"to_{dim}").isNotNull(),
                           F.col(f"to_{dim}") * F.lit(total) / F.col("now")).otherwise(1.0)
            fitted = materialize(fitted.join(now, dim).withColumn("factor", F.col("factor") * ratio).drop("now"),
                                 files=CELL_FILES)
    return fitted.drop(*(f"to_{dim}" for dim in targets))


def budget_rate(cells: DataFrame, budget: float) -> float:
    """The rate at which min(1, factor * rate) of each cell's tokens add up to ``budget`` tokens.

    Solved anew without the cells that are full until no more fill up; each step is one row of sums over the
    cells. A budget of all tokens or more fills every cell.
    """
    rate, full = 0.0, -1
    while True:
        over = F.col("factor") * F.lit(rate) >= 1
        taken, free, n = cells.where("m_tokens > 0").agg(
            F.sum(F.when(over, F.col("m_tokens")).otherwise(0.0)),
            F.sum(F.when(over, 0.0).otherwise(F.col("m_tokens") * F.col("factor"))),
            F.count(F.when(over, 1))).first()
        if not free or n == full:
            return rate
        rate, full = max(rate, (budget - taken) / free), n


def fit_mixture(docs: DataFrame, budget: float, topic: Column | None = None,
                targets: dict[str, DataFrame] | None = None) -> DataFrame:
    """The raked cells of ``docs``: m_source, m_lang, m_topic, m_tokens, factor, probability, wanted, shortfall.

    Probabilities are min(1, factor * rate). ``budget`` is the share of all tokens to draw; the rate is
    solved so that the expected tokens are that share whatever the rarest cell's factor (``budget_rate``).

    wanted is factor * rate, the times the targets ask for each row; shortfall the tokens that a cell
    lacks where this is above 1.
    """
    keys = [f"m_{d}" for d in DIMS]
    cells = materialize(with_margins(docs, topic).groupBy(*keys).agg(F.sum("m_tokens").alias("m_tokens")), files=CELL_FILES)
    wanted = targets or {k: materialize(tempered_targets(cells, k), files=CELL_FILES) for k in keys}
    fitted = rake(cells, wanted)
    rate = budget_rate(fitted, budget * (cells.agg(F.sum("m_tokens")).first()[0] or 0.0))
    wants = F.col("factor") * F.lit(rate)
    return fitted.withColumns({"probability": F.least(F.lit(1.0), wants), "wanted": wants,
                               "shortfall": F.col("m_tokens") * F.greatest(F.lit(0.0), wants - 1.0)})


def draw(doc_id: Column, seed: int = SEED) -> Column:
    """A fixed number in [0, 1) per document id."""
    name = F.concat(F.coalesce(doc_id.cast("string"), F.lit("")), F.lit(f":{seed}"))
    return F.conv(F.substring(F.md5(name.cast("binary")), 1, 8), 16, 10).cast("double") / F.lit(4294967296.0)


def weigh(docs: DataFrame, cells: DataFrame, topic: Column | None = None, seed: int = SEED) -> DataFrame:
    """``docs`` (all columns) with topic, n_tokens, weight, probability, selected (replacing equal names).

    ``cells``: of ``fit_mixture``. Null source, language and topic are values
    of their own; empty and null texts have no tokens and are drawn by their
    cell's probability too. Repeated rows are drawn alike; an empty table gives no rows.
    """
    keys = [f"m_{d}" for d in DIMS]
    table = cells.select(*keys, "factor", F.col("probability").alias("m_probability"))
    if cells.count() <= BROADCAST_CELLS:
        table = F.broadcast(table)
    joined = with_margins(docs.drop("factor", "m_probability"), topic).join(table, keys, "left")
    new = {"topic": F.col("m_topic"), "n_tokens": F.col("m_tokens").cast("long"), "weight": F.col("factor"),
           "probability": F.col("m_probability"), "selected": draw(F.col("doc_id"), seed) < F.col("m_probability")}
    return joined.select(*(c for c in docs.columns if c not in new), *(v.alias(k) for k, v in new.items()))


def oracle_sql(budget: float, docs: str = "documents", sweeps: int = SWEEPS, power: float = TEMPER, seed: int = SEED) -> str:
    """DuckDB SQL for ``weigh(docs, fit_mixture(docs, budget))`` without the text, probabilities to six places.

    The rate is that of the fewest full cells (from the largest factor on) beside which no other cell fills up.
    """
    marks = " OR ".join(f"contains(text, '{m}')" for m in ("%%%", "###", "***", "&&&", "$$$"))
    ctes = [f"""base AS (SELECT doc_id, coalesce(source, '') AS source, coalesce(lang, '') AS lang,
  coalesce(CASE WHEN contains(text, ' | ') THEN 'list' WHEN {marks} THEN 'noise' WHEN contains(text, '!!') THEN 'shout'
    WHEN length(text) < 1000 THEN 'note' ELSE 'article' END, '') AS topic,
  CASE WHEN coalesce(length(text), 0) = 0 THEN 0 ELSE 2 * length(text) - length(replace(text, ' ', ''))
    - length(replace(text, chr(10), '')) + 1 END AS n_tokens FROM {docs})""",
            "f0 AS MATERIALIZED (SELECT source, lang, topic, CAST(sum(n_tokens) AS DOUBLE) AS tok, 1.0::DOUBLE AS f "
            "FROM base GROUP BY ALL)",
            "whole AS MATERIALIZED (SELECT sum(tok) AS t FROM f0)"]
    for d in DIMS:
        ctes.append(f"t_{d} AS MATERIALIZED (SELECT {d}, pow(sum(tok), {power}) AS r FROM f0 GROUP BY {d})")
    k = 0
    for _ in range(sweeps):
        for d in DIMS:
            ctes.append(f"""f{k + 1} AS MATERIALIZED (SELECT c.source, c.lang, c.topic, c.tok, c.f * CASE WHEN n.now > 0 THEN
  (t.r / (SELECT sum(r) FROM t_{d})) * (SELECT t FROM whole) / n.now ELSE 1.0 END AS f
  FROM f{k} c JOIN (SELECT {d}, sum(tok * f) AS now FROM f{k} GROUP BY {d}) n ON c.{d} = n.{d} JOIN t_{d} t ON c.{d} = t.{d})""")
            k += 1
    return f"""WITH {', '.join(ctes)},
ranked AS (SELECT f, row_number() OVER w AS n, coalesce(sum(tok) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS taken,
    sum(tok * f) OVER (ORDER BY f, source DESC, lang DESC, topic DESC) AS free FROM f{k} WHERE tok > 0
  WINDOW w AS (ORDER BY f DESC, source, lang, topic)),
rates AS (SELECT n, f, ({budget} * (SELECT t FROM whole) - taken) / free AS rate FROM ranked),
rate AS (SELECT coalesce((SELECT arg_min(rate, n) FROM rates WHERE f * rate < 1), (SELECT arg_max(rate, n) FROM rates), 0) AS rate),
prob AS (SELECT source, lang, topic, f, least(1.0, f * (SELECT rate FROM rate)) AS p FROM f{k})
SELECT b.doc_id, b.topic, b.n_tokens, round(p.f, 6) AS weight, round(p.p, 6) AS probability,
  CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '') || ':{seed}'), 1, 8) AS BIGINT) / 4294967296.0 < p.p AS selected
FROM base b JOIN prob p ON b.source = p.source AND b.lang = p.lang AND b.topic = p.topic"""
