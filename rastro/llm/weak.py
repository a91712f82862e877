"""Weak supervision: labelers vote or abstain, expectation-maximisation weighs them.

A vote is 1 (positive), -1 (negative) or 0 (abstains); null counts as 0. For each labeler two
accuracies are estimated: how often it says 1 on positives, and -1 on negatives, among the rows on
which it votes. A labeler that says the same everywhere so weighs nothing, however often it speaks.

With K labelers there are at most 3^K vote patterns. The corpus is read once, to count patterns, and
all rounds of the expectation-maximisation run over that small table. Only 2 K + 1 numbers reach
the driver.
"""

from dataclasses import dataclass
from math import log

from pyspark.sql import functions as F

#: An accuracy stays inside these bounds, so no single vote decides alone.
LOWEST, HIGHEST = 0.02, 0.98


@dataclass(frozen=True)
class VoteModel:
    """Per labeler its accuracy on positives and on negatives; the share of positives."""

    on_positive: dict
    on_negative: dict
    prior: float

    def posterior(self, vote=F.col):
        """Column: probability of the positive class; ``vote`` gives a labeler's column."""
        logit = F.lit(log(self.prior / (1 - self.prior)))
        for name, right in self.on_positive.items():
            rejects = self.on_negative[name]
            logit = (
                logit
                + F.when(vote(name) > 0, F.lit(log(right / (1 - rejects))))
                .when(vote(name) < 0, F.lit(log((1 - right) / rejects)))
                .otherwise(F.lit(0.0))
            )
        return 1 / (1 + F.exp(-logit))


def count_patterns(rows, labelers):
    """How often each pattern of votes occurs: at most 3^K rows."""
    votes = [F.coalesce(F.col(c).cast("int"), F.lit(0)).alias(c) for c in labelers]
    return rows.select(*votes).groupBy(*labelers).agg(F.count("*").alias("n"))


def _inside(value):
    return F.least(F.greatest(value, F.lit(LOWEST)), F.lit(HIGHEST))


def _total(patterns, value):
    return F.aggregate(patterns, F.lit(0.0), lambda total, p: total + value(p))


def fit(rows, labelers, prior=0.8, on_positive=0.9, on_negative=0.6, strength=5.0, rounds=25):
    """Estimate a ``VoteModel`` for the vote columns ``labelers`` of ``rows``.

    The starting accuracies also count as ``strength`` votes seen beforehand, so that a labeler with
    few votes keeps them. Without rows the starting values are returned.

    The rounds are one fold over the list of patterns, whose length is bounded by the number of
    possible patterns and not by the corpus.
    """
    labelers = list(labelers)
    size = len(labelers)
    patterns = count_patterns(rows, labelers).agg(
        F.collect_list(
            F.struct(F.col("n").cast("double").alias("n"), F.array(*labelers).alias("votes"))
        ).alias("patterns")
    )
    every = F.sequence(F.lit(0), F.lit(size - 1))

    def judged(state, p):
        """The pattern with its expected number of positives."""
        weight = F.aggregate(
            every,
            F.log(state["prior"] / (1 - state["prior"])),
            lambda total, j: total
            + F.when(
                F.get(p["votes"], j) > 0,
                F.log(F.get(state["on_positive"], j) / (1 - F.get(state["on_negative"], j))),
            )
            .when(
                F.get(p["votes"], j) < 0,
                F.log((1 - F.get(state["on_positive"], j)) / F.get(state["on_negative"], j)),
            )
            .otherwise(F.lit(0.0)),
        )
        return F.struct(
            p["n"].alias("n"), p["votes"].alias("votes"), (p["n"] / (1 + F.exp(-weight))).alias("positive")
        )

    def estimate(judged):
        def accuracy(sign, amount, start):
            def of(j):
                agree = _total(
                    judged, lambda p: F.when(F.get(p["votes"], j) * sign > 0, amount(p)).otherwise(0.0)
                )
                cast = _total(
                    judged, lambda p: F.when(F.get(p["votes"], j) != 0, amount(p)).otherwise(0.0)
                )
                return _inside((agree + strength * start) / (cast + strength))

            return F.transform(every, of)

        return F.struct(
            accuracy(1, lambda p: p["positive"], on_positive).alias("on_positive"),
            accuracy(-1, lambda p: p["n"] - p["positive"], on_negative).alias("on_negative"),
            _inside(_total(judged, lambda p: p["positive"]) / _total(judged, lambda p: p["n"])).alias(
                "prior"
            ),
        )

    def one_round(state, _):
        # a list of one, so that the judged patterns are computed once and used many times
        current = F.array(F.transform(F.col("patterns"), lambda p: judged(state, p)))
        return F.get(F.transform(current, estimate), F.lit(0))

    start = F.struct(
        F.array_repeat(F.lit(on_positive), size).alias("on_positive"),
        F.array_repeat(F.lit(on_negative), size).alias("on_negative"),
        F.lit(prior).alias("prior"),
    )
    fitted = F.when(
        F.size("patterns") > 0, F.aggregate(F.sequence(F.lit(1), F.lit(rounds)), start, one_round)
    ).otherwise(start)
    found = patterns.select(fitted.alias("model")).first().model
    return VoteModel(
        dict(zip(labelers, found.on_positive)), dict(zip(labelers, found.on_negative)), found.prior
    )
