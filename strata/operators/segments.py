"""Audience-segment counting over stored rule predicates.

For each rule (a SQL predicate over a user-fact table): ``group_number`` =
distinct users with a row matching it, ``group_active_count`` = those users
that also have a row in the active date window.

Fused form: one scan and one aggregation for a batch of rules. A row's rules
are bits of a few longs, 63 each; a user's words are their ``bit_or`` (partial
aggregation map-side, so a user with many rows costs one short row per map
task). Users' set bits are then unpacked once and counted by rule.
The per-rule reference forms are kept as ``rule_users`` / ``rule_active_users``.
"""

from __future__ import annotations

from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession, functions as F

#: rules of one scan, a bound of the plan's size
RULES_PER_PASS = 1008
#: rules of one word
_BITS = 63


def active_rules(rules: DataFrame, exclude_names) -> DataFrame:
    """R2: ``status = 1``, name not excluded, rule text present and non-empty."""
    return rules.where(
        (F.col("status") == 1)
        & ~F.col("group_name").isin(*exclude_names)
        & F.col("group_rule_sql").isNotNull()
        & (F.col("group_rule_sql") != "")
    ).select("id", "group_name", "group_rule_sql")


def normalize_rules(rules: DataFrame, mapping: dict[str, str]) -> DataFrame:
    """Regex rewrite of schema names inside the rule text (case-sensitive)."""
    c = F.col("group_rule_sql")
    for pat, rep in mapping.items():
        c = F.regexp_replace(c, pat, rep)
    return rules.withColumn("group_rule_sql", c).where(F.col("group_rule_sql") != "")


def _rule_list(rules) -> list[tuple[int, str]]:
    if isinstance(rules, DataFrame):
        # the rule table is configuration (one row per stored segment), read
        # once to compile the predicates into the plan
        return [(int(r["id"]), r["group_rule_sql"]) for r in
                rules.select("id", "group_rule_sql").orderBy("id").toLocalIterator()]
    return [(int(i), s) for i, s in rules]


@contextmanager
def _lenient(spark: SparkSession):
    """Stored rules are read with lenient casts: a value that does not convert
    is null instead of an error. The mode is kept in the analysed expressions."""
    before = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", "false")
    try:
        yield
    finally:
        spark.conf.set("spark.sql.ansi.enabled", before)


def _flag(sql: str):
    return F.max(F.coalesce(F.expr(f"({sql})"), F.lit(False)).cast("int"))


def _word(rules: list[str]):
    """The rules that hold for a row, as bits; a rule that is null does not."""
    terms = [F.when(F.expr(f"({sql})"), F.lit(1 << i)).otherwise(F.lit(0)).cast("long") for i, sql in enumerate(rules)]
    while len(terms) > 1:  # a balanced tree, not a chain of 63
        terms = [terms[i].bitwiseOR(terms[i + 1]) if i + 1 < len(terms) else terms[i] for i in range(0, len(terms), 2)]
    return terms[0]


def validate_rules(facts: DataFrame, rule_list) -> list[tuple[int, str, str]]:
    """(id, rule, status) of each rule; the status is ``ok`` or says why the
    rule cannot be counted.

    Analysis only (columns, functions and sub-query views are resolved on the
    driver); no job runs. A rule must be a boolean expression of a row that can
    stand inside an aggregate: ``count(*) > 1`` and ``value`` are no rules. One
    bad stored rule must not fail the whole batch.
    """
    with _lenient(facts.sparkSession):
        return _validated(facts, list(rule_list))


def _validated(facts: DataFrame, rules: list[tuple[int, str]]) -> list[tuple[int, str, str]]:
    """All rules are analysed at once; where that fails, each half by itself."""
    from pyspark.errors import PySparkException
    if not rules:
        return []
    try:
        schema = facts.select(*[F.expr(f"({sql})").alias(f"r{i}") for i, (_, sql) in enumerate(rules)]).schema
        kinds = [f.dataType.simpleString() for f in schema]
        flags = [_flag(sql).alias(f"r{i}") for i, (_, sql) in enumerate(rules) if kinds[i] == "boolean"]
        if flags:
            facts.agg(*flags).schema
    except (PySparkException, ValueError) as e:
        if len(rules) > 1:
            half = len(rules) // 2
            return _validated(facts, rules[:half]) + _validated(facts, rules[half:])
        reason = e.getCondition() if isinstance(e, PySparkException) else None
        return [(*rules[0], f"invalid: {reason or type(e).__name__}")]
    return [(rid, sql, "ok" if k == "boolean" else f"not a condition: {k}") for (rid, sql), k in zip(rules, kinds)]


COUNT_SCHEMA = "id int, group_number bigint, group_active_count bigint, status string"


def segment_counts(facts: DataFrame, rules, user_col: str = "uuid", date_col: str = "l_date",
                   start: str | None = None, end: str | None = None,
                   rules_per_pass: int = RULES_PER_PASS) -> DataFrame:
    """``(id, group_number, group_active_count, status)`` for every rule.

    ``start``/``end`` are inclusive ``yyyy-MM-dd`` bounds of the active
    window. Rules are fused ``rules_per_pass`` at a time to bound plan size.
    A rule that cannot be counted gets null counts and a ``status`` that says
    why, instead of failing the run.
    """
    spark: SparkSession = facts.sparkSession
    checked = validate_rules(facts, _rule_list(rules))
    rule_list = [(rid, sql) for rid, sql, status in checked if status == "ok"]
    active = F.lit(True)
    if start is not None:
        active = active & (F.col(date_col) >= F.lit(start))
    if end is not None:
        active = active & (F.col(date_col) <= F.lit(end))
    outs = []
    for b in range(0, len(rule_list), rules_per_pass):
        batch = rule_list[b:b + rules_per_pass]
        with _lenient(spark):
            words = [F.bit_or(_word([sql for _, sql in batch[w:w + _BITS]])).alias(f"w{w}") for w in range(0, len(batch), _BITS)]
            per_user = (facts.where(F.col(user_col).isNotNull()).groupBy(user_col)
                        .agg(*words, F.max(F.coalesce(active, F.lit(False)).cast("int")).alias("_act")))
        # a user's set bits, each the place of a rule in the batch
        bits = (per_user.select("_act", F.posexplode(F.array(*[c for c in per_user.columns if c.startswith("w")])).alias("word", "bits"))
                .where("bits <> 0").select("_act", "word", F.explode(F.expr(f"filter(sequence(0, {_BITS - 1}), b -> getbit(bits, b) = 1)")).alias("bit")))
        counts = bits.groupBy((F.col("word") * _BITS + F.col("bit")).alias("place")).agg(
            F.count(F.lit(1)).alias("n"), F.sum("_act").alias("a"))
        places = spark.createDataFrame([(int(rid), i) for i, (rid, _) in enumerate(batch)], "id int, place int")
        outs.append(places.join(counts, "place", "left").select(
            "id", F.coalesce("n", F.lit(0)).cast("long").alias("group_number"),
            F.coalesce("a", F.lit(0)).cast("long").alias("group_active_count"), F.lit("ok").alias("status")))
    bad = [(int(rid), None, None, status) for rid, _, status in checked if status != "ok"]
    if bad or not outs:
        outs.append(spark.createDataFrame(bad, COUNT_SCHEMA))
    out = outs[0]
    for o in outs[1:]:
        out = out.unionByName(o)
    return out


def rule_users(facts: DataFrame, rule_sql: str, user_col: str = "uuid") -> DataFrame:
    """A3, per-rule form: distinct users with a row matching the rule."""
    return facts.where(F.expr(f"({rule_sql})")).agg(
        F.count_distinct(user_col).alias("group_number"))


def rule_active_users(facts: DataFrame, rule_sql: str, start: str, end: str,
                      user_col: str = "uuid", date_col: str = "l_date") -> DataFrame:
    """A4, per-rule form: users matching the rule (semi join) that have a row
    in ``[start, end]``."""
    matched = facts.where(F.expr(f"({rule_sql})")).select(user_col)
    return (facts.where((F.col(date_col) >= start) & (F.col(date_col) <= end))
            .join(matched, user_col, "left_semi")
            .agg(F.count_distinct(user_col).alias("group_active_count")))
