"""Mixing sources to target weights by iterative proportional fitting.

Token totals of the cells (source, language, topic) are raked to target shares of the sources, the languages and the
topics in turn. A cell's weight is its raked share over its present share; documents are then sampled with probabilities
in proportion to these weights, so that the expected tokens of the sample have the target shares. By default the largest
probability is 1, which makes the rarest level the scale of all others; with the setting `expected` the sample has a
stated number of expected tokens instead, and documents of cells whose rate exceeds 1 are repeated.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from curbflow.llm.tables import free_name, table, text_of, written

DIMENSIONS = ("source", "lang", "topic")
MISSING = "(none)"


@dataclass(frozen=True)
class Settings:
    """tempering: target shares are present shares to this power, by dimension (1 leaves a dimension as it is, 0 makes
    its levels equal). sweeps: rounds over the three dimensions at most. tolerance: difference of a raked share from its
    goal at which the rounds end. seed: of the sample. expected: tokens of the sample in
    expectation, as a share of the present tokens; without it the largest probability is 1."""

    tempering: tuple[tuple[str, float], ...] = (("source", 0.8), ("lang", 0.9), ("topic", 1.0))
    sweeps: int = 8
    tolerance: float = 1e-12
    seed: str = "mix-1"
    expected: float | None = None


#: Topics by what the whole text holds; the first that applies.
TOPICS = (("markup", "<"), ("table", "|"), ("contact", "@"), ("noise", "%"), ("exclaiming", "!"))
OTHER_TOPIC = "prose"


def topic_of(text_col: str = "text") -> Column:
    topic = None
    for name, mark in TOPICS:
        test = F.contains(text_of(text_col), F.lit(mark))
        topic = F.when(test, name) if topic is None else topic.when(test, name)
    return topic.otherwise(OTHER_TOPIC)


def tokens_of(text_col: str = "text") -> Column:
    """Words of the whole text, as a measure of its tokens."""
    return F.regexp_count(text_of(text_col), F.lit(r"[^\x20\x09-\x0D]+")).cast("long")


def weighed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
            lang_col: str = "lang", topic: Column | None = None) -> DataFrame:
    """(doc_id, source, lang, topic, n_tokens); a null level counts as the level `(none)`."""
    level = lambda c: F.coalesce(c.cast("string"), F.lit(MISSING))
    return docs.select(
        F.col(id_col).alias("doc_id"), level(F.col(source_col)).alias("source"), level(F.col(lang_col)).alias("lang"),
        level(topic_of(text_col) if topic is None else topic).alias("topic"), tokens_of(text_col).alias("n_tokens"),
    )


def tempered_targets(cells: DataFrame, settings: Settings) -> dict[str, DataFrame]:
    """Per dimension (level, goal): present token shares, tempered. Levels without tokens have the goal 0."""
    out = {}
    for name, power in settings.tempering:
        shares = cells.groupBy(F.col(name).alias("level")).agg(F.sum("n_tokens").cast("double").alias("mass"))
        shares = shares.withColumn("raised", F.when(F.col("mass") > 0, F.pow("mass", F.lit(float(power)))).otherwise(0.0))
        total = shares.agg(F.sum("raised").alias("all_raised"))
        out[name] = shares.join(F.broadcast(total)).select(
            "level", F.when(F.col("all_raised") > 0, F.col("raised") / F.col("all_raised")).otherwise(0.0).alias("goal")
        )
    return out


def margin_error(raked: DataFrame, goals: dict[str, DataFrame]) -> float:
    """The largest difference of a level's share of the raked mass from its goal; 0 without mass."""
    total = raked.agg(F.sum("raked")).first()[0] or 0.0
    worst = 0.0
    for name, goal in goals.items():
        sums = raked.groupBy(F.col(name).alias("level")).agg(F.sum("raked").alias("mass"))
        gap = F.abs(F.coalesce("mass", F.lit(0.0)) / F.lit(total or 1.0) - F.coalesce("goal", F.lit(0.0)))
        worst = max(worst, sums.join(goal, "level", "full").agg(F.max(gap)).first()[0] or 0.0)
    return worst if total else 0.0


def rake(cells: DataFrame, targets: dict[str, DataFrame], settings: Settings) -> tuple[DataFrame, float]:
    """cells with `raked`, their mass from their token totals, and the margin error that remains.

    Each step scales the cells of a level to the level's goal; sums are aggregated before they are joined back, so large
    levels meet in no task. The sweeps end at the tolerance. Targets that contradict each other never meet it: the last
    dimension of a sweep is met then, and the error says by how much another is missed."""
    goals = {name: written(t, f"goals-{name}") for name, t in targets.items()}
    now, error = written(cells.withColumn("raked", F.col("n_tokens").cast("double")), "raked"), 0.0
    for _ in range(settings.sweeps):
        for name, goal in goals.items():
            sums = now.groupBy(F.col(name).alias("level")).agg(F.sum("raked").alias("mass"))
            factor = F.when(F.col("mass") > 0, F.col("goal") / F.col("mass")).otherwise(0.0)
            factors = sums.join(goal, "level").select(F.col("level").alias(name), factor.alias("factor"))
            now = now.join(factors, name).withColumn("raked", F.col("raked") * F.col("factor")).drop("factor")
        now = written(now, "raked")  # once a sweep: the plan of a step holds that of the step before twice
        error = margin_error(now, goals)
        if error <= settings.tolerance:
            break
    return now, error


def cell_probabilities(cells: DataFrame, targets: dict[str, DataFrame], settings: Settings) -> DataFrame:
    """(source, lang, topic, weight, probability, margin_error): weight is raked over present share, probability the weight over the
    largest weight. With `expected` it is the expected copies of a document, which may exceed 1: weights average 1 over
    the present tokens, so `expected` times the weight. Cells without tokens have weight 0 and probability 0."""
    raked, error = rake(cells, targets, settings)
    ratio = F.when(F.col("n_tokens") > 0, F.col("raked") / F.col("n_tokens")).otherwise(0.0)
    rated = raked.withColumn("ratio", ratio)
    totals = rated.agg(F.sum("n_tokens").alias("tokens"), F.max("ratio").alias("largest"), F.sum("raked").alias("mass"))
    weight = F.when(F.col("mass") > 0, F.col("ratio") * F.col("tokens") / F.col("mass")).otherwise(0.0)
    if settings.expected is None:
        probability = F.when(F.col("largest") > 0, F.col("ratio") / F.col("largest")).otherwise(0.0)
    else:
        probability = weight * F.lit(float(settings.expected))
    return rated.join(F.broadcast(totals)).select(
        *DIMENSIONS, weight.alias("weight"), probability.alias("probability"), F.lit(error).alias("margin_error")
    )


def place(id_col: Column, seed: str) -> Column:
    """A number in [0, 1) for each id: the first 32 bits of a hash."""
    return F.conv(F.substring(F.md5(F.concat(F.lit(seed), F.coalesce(id_col.cast("string"), F.lit(MISSING))).cast("binary")), 1, 8), 16, 10).cast("double") / F.lit(float(1 << 32))


def copies_of(rate: Column, at: Column) -> Column:
    """How often a document at the place `at` is taken: the whole part of its rate, and once more with the rest as
    probability. Rates up to 1 take it where its place is below the rate."""
    whole = F.floor(rate)
    return whole + (at < rate - whole).cast("long")


def sampled(documents: DataFrame, settings: Settings = Settings(), targets: dict[str, DataFrame] | None = None) -> DataFrame:
    """`weighed` rows with weight, probability, margin_error (of the raking as a whole) and kept. Rows that repeat a doc_id share one decision if they share a
    cell. Documents without tokens are never kept where their cell has none. No rows give no rows. With `expected`,
    `copies` says how often a row is taken, and probability, the copies in expectation, may exceed 1."""
    cells = written(documents.groupBy(*DIMENSIONS).agg(F.sum("n_tokens").alias("n_tokens")), "cells")
    targets = targets or tempered_targets(cells, settings)
    rates = written(cell_probabilities(cells, targets, settings), "rates")
    rows = documents.join(rates, [*DIMENSIONS], "left").withColumns({
        "weight": F.coalesce("weight", F.lit(0.0)), "probability": F.coalesce("probability", F.lit(0.0)),
    })
    at = place(F.col("doc_id"), settings.seed)
    if settings.expected is None:
        return rows.withColumn("kept", at < F.col("probability"))
    return rows.withColumn("copies", copies_of(F.col("probability"), at)).withColumn("kept", F.col("copies") > 0)


def mixed(docs: DataFrame, settings: Settings = Settings(), id_col: str = "doc_id", text_col: str = "text",
          source_col: str = "source", lang_col: str = "lang", topic: Column | None = None) -> DataFrame:
    """The sampled rows of docs, with all their columns. Texts stay where they are: only cell rates are joined to them.
    With `expected`, a row stands as often as it is taken."""
    levels = {d: free_name(docs, f"_{d}") for d in DIMENSIONS}
    rows = weighed(docs, id_col, text_col, source_col, lang_col, topic)
    cells = written(rows.groupBy(*DIMENSIONS).agg(F.sum("n_tokens").alias("n_tokens")), "cells")
    rates = written(cell_probabilities(cells, tempered_targets(cells, settings), settings), "rates")
    odds = free_name(docs, "_probability")
    rates = rates.select(*(F.col(d).alias(levels[d]) for d in DIMENSIONS), F.col("probability").alias(odds))
    level = lambda c: F.coalesce(c.cast("string"), F.lit(MISSING))
    marked = docs.withColumns({
        levels["source"]: level(F.col(source_col)), levels["lang"]: level(F.col(lang_col)),
        levels["topic"]: level(topic_of(text_col) if topic is None else topic),
    })
    found = marked.join(rates, list(levels.values()))
    at = place(F.col(id_col), settings.seed)
    if settings.expected is None:
        return found.filter(at < F.col(odds)).select(*docs.columns)
    turn = free_name(docs, "_turn")
    taken = found.withColumn(odds, copies_of(F.col(odds), at)).filter(F.col(odds) > 0)
    return taken.withColumn(turn, F.explode(F.sequence(F.lit(1), F.col(odds)))).select(*docs.columns)


DIGITS = 9


def op10(spark: SparkSession, sf_dir: str, settings: Settings = Settings()) -> DataFrame:
    rows = written(weighed(table(spark, sf_dir, "documents")), "weighed")
    return sampled(rows, settings).drop("margin_error").withColumns(
        {"weight": F.round("weight", DIGITS), "probability": F.round("probability", DIGITS)}
    )


#: op10 without the largest probability as scale: the sample has nine tenths of the present tokens in expectation.
EXPECTED = Settings(expected=0.9)


def op10_expected(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op10(spark, sf_dir, EXPECTED)


def sql(settings: Settings = Settings(), result: str = "", documents: str = "documents") -> str:
    """The same by DuckDB, sweep by sweep."""
    topics = " ".join(f"when contains(coalesce(text, ''), '{mark}') then '{name}'" for name, mark in TOPICS)
    parts = [f"""docs as (
        select doc_id, coalesce(source, '{MISSING}') as source, coalesce(lang, '{MISSING}') as lang,
               case {topics} else '{OTHER_TOPIC}' end as topic,
               len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+'))::bigint as n_tokens
        from {documents})""",
        "raked_0 as materialized (select source, lang, topic, sum(n_tokens)::bigint as n_tokens, sum(n_tokens)::double as raked from docs group by all)"]
    for name, power in settings.tempering:
        parts.append(f"""goals_{name} as materialized (
        select level, case when sum(raised) over () > 0 then raised / sum(raised) over () else 0 end as goal from (
            select {name} as level, case when sum(n_tokens) > 0 then pow(sum(n_tokens)::double, {power}) else 0 end as raised
            from raked_0 group by 1))""")
    step = 0
    for _ in range(settings.sweeps):
        for name, _ in settings.tempering:
            parts.append(f"""raked_{step + 1} as materialized (
        select source, lang, topic, n_tokens, raked * case when mass > 0 then goal / mass else 0 end as raked
        from (select *, sum(raked) over (partition by {name}) as mass from raked_{step}) join goals_{name} on level = {name})""")
            step += 1
    parts.append(f"""rated as materialized (
        select *, case when n_tokens > 0 then raked / n_tokens else 0 end as ratio from raked_{step})""")
    parts.append("""rates as materialized (
        select source, lang, topic,
               case when sum(raked) over () > 0 then ratio * sum(n_tokens) over () / sum(raked) over () else 0 end as weight,
               case when max(ratio) over () > 0 then ratio / max(ratio) over () else 0 end as probability
        from rated)""")
    chosen = f"(('0x' || substr(md5('{settings.seed}' || coalesce(doc_id::varchar, '{MISSING}')), 1, 8))::bigint / {float(1 << 32)}) < probability"
    if settings.expected is not None:
        parts.append(f"""scaled as materialized (
        select source, lang, topic, weight, weight * {settings.expected} as probability from rates)""")
        parts.append(f"""placed as (
        select *, (('0x' || substr(md5('{settings.seed}' || coalesce(doc_id::varchar, '{MISSING}')), 1, 8))::bigint / {float(1 << 32)}) as place
        from docs join scaled using (source, lang, topic))""")
        result = result or f"""select doc_id, source, lang, topic, n_tokens, round(weight, {DIGITS}) as weight,
           round(probability, {DIGITS}) as probability, copies, copies > 0 as kept from (
        select *, (floor(probability) + (place < probability - floor(probability))::int)::bigint as copies from placed)"""
    result = result or f"""select doc_id, source, lang, topic, n_tokens, round(weight, {DIGITS}) as weight,
           round(probability, {DIGITS}) as probability, {chosen} as kept
    from docs join rates using (source, lang, topic)"""
    return "with " + ",\n".join(parts) + "\n" + result


OP10_SQL = sql()
OP10_EXPECTED_SQL = sql(EXPECTED)
