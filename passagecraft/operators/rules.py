"""Rules over the signals of a text, with the reasons why a text fails."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from passagecraft.operators.prepare import with_signals

# Conditions on the signals under which a text is rejected.
RULES = {
    "few words": "n_words < 20",
    "odd word length": "word_length < 2 or word_length > 12",
    "symbols": "symbol_share > 0.1",
    "capitals": "upper_share > 0.5",
    "repeated lines": "repeated_line_share > 0.3",
    "no sentence ends": "ended_line_share < 0.2",
}


def apply_rules(docs: DataFrame, rules: dict[str, str] = RULES) -> DataFrame:
    """``docs`` with ``reasons``, the names of the rules each text meets, in the order of ``rules``.

    A rule is an SQL condition on the signals of :func:`with_signals`; one that is null does
    not reject. A null text counts as an empty one. Narrow: nothing is shuffled, and texts
    are cut once for all rules.
    """
    rows = docs.drop("reasons").select(F.struct("*").alias("_row"), F.coalesce("text", F.lit("")).alias("text"))
    reasons = F.array_compact(F.array(*[F.when(F.expr(condition), F.lit(name)) for name, condition in rules.items()]))
    return with_signals(rows).withColumn("reasons", reasons).select("_row.*", "reasons")
