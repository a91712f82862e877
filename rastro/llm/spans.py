"""Regex matches with their places, as built-in column functions.

Java's regex engine finds leftmost non-overlapping matches. ``split`` returns the text between the
matches of the same search, so their lengths give each match's place, in code points.
"""

from pyspark.sql import functions as F

SPAN = "struct<kind:string,start:int,stop:int,body:string>"
SPANS = f"array<{SPAN}>"


def no_spans():
    return F.array().cast(SPANS)


#: Matches whose places are added up together.
CHUNK = 256


def _places(steps, kind):
    """Struct of the length of all ``steps`` (text between, match) and the spans inside."""
    start = F.struct(F.lit(0).alias("at"), no_spans().alias("found"))

    def step(state, x):
        begin = state["at"] + F.length(x["gap"])
        end = begin + F.coalesce(F.length(x["body"]), F.lit(0))
        span = F.struct(
            F.lit(kind).alias("kind"), begin.alias("start"), end.alias("stop"), x["body"].alias("body")
        )
        more = F.when(x["body"].isNull(), state["found"]).otherwise(
            F.concat(state["found"], F.array(span).cast(SPANS))
        )
        return F.struct(end.alias("at"), more.alias("found"))

    return F.aggregate(steps, start, step)


def matches(text, kind, pattern, only_if=None):
    """Column array of (kind, start, stop, body) for every match of ``pattern``, in order.

    ``text`` must not be null. ``only_if`` is a cheaper pattern that every text with a wanted match
    contains; texts without it are not searched in full. Lengths are added up in chunks, and then over
    the chunks, because extending a list copies it.
    """
    steps = F.arrays_zip(
        F.split(text, pattern, -1).alias("gap"),
        F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("body"),
    )

    def in_chunks(steps):
        firsts = F.sequence(F.lit(1), F.size(steps), F.lit(CHUNK))
        return F.transform(firsts, lambda i: _places(F.slice(steps, i, F.lit(CHUNK)), kind))

    def add_chunk(state, chunk):
        def moved(s):
            return F.struct(
                s["kind"].alias("kind"),
                (s["start"] + state["at"]).alias("start"),
                (s["stop"] + state["at"]).alias("stop"),
                s["body"].alias("body"),
            )

        spans = F.array(F.transform(chunk["found"], moved).cast(SPANS))
        return F.struct(
            (state["at"] + chunk["at"]).alias("at"), F.concat(state["found"], spans).alias("found")
        )

    # a list of one, so that the search happens once
    chunks = F.get(F.transform(F.array(steps), in_chunks), F.lit(0))
    start = F.struct(F.lit(0).alias("at"), F.array().cast(f"array<{SPANS}>").alias("found"))
    found = F.aggregate(chunks, start, add_chunk, lambda state: F.flatten(state["found"]))
    return F.when(text.rlike(only_if or pattern), found).otherwise(no_spans())


def overlaps_none(span, others):
    """True if ``span`` shares no character with any of ``others``."""
    return ~F.exists(others, lambda b: (b["start"] < span["stop"]) & (span["start"] < b["stop"]))


def listed(spans, kinds, by_kind):
    """Column string kind:start:end, comma-joined; by kind as listed then start, or the reverse."""

    def rank(s):
        order = F.lit(len(kinds))
        for i, kind in enumerate(kinds):
            order = F.when(s["kind"] == kind, F.lit(i)).otherwise(order)
        return order

    def row(s):
        keys = [rank(s), s["start"]] if by_kind else [s["start"], rank(s)]
        label = F.concat_ws(":", s["kind"], s["start"].cast("string"), s["stop"].cast("string"))
        return F.struct(keys[0].alias("a"), keys[1].alias("b"), s["stop"].alias("c"), label.alias("label"))

    ordered = F.sort_array(F.transform(spans, row))
    return F.array_join(F.transform(ordered, lambda s: s["label"]), ",")


def masked(text, spans, mark):
    """``text`` with every span replaced by ``mark``; overlapping spans are replaced together."""
    ordered = F.sort_array(
        F.transform(spans, lambda s: F.struct(s["start"].alias("start"), s["stop"].alias("stop")))
    )
    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))

    def step(state, s):
        apart = s["start"] >= state["at"]
        gap = F.substring(text, state["at"] + 1, s["start"] - state["at"])
        out = F.when(apart, F.concat(state["out"], gap, F.lit(mark))).otherwise(state["out"])
        return F.struct(F.greatest(state["at"], s["stop"]).alias("at"), out.alias("out"))

    def finish(state):
        return F.concat(state["out"], F.substring(text, state["at"] + 1, F.length(text)))

    # adjacent spans of which one ends where the other begins keep a mark each
    return F.when(F.size(spans) == 0, text).otherwise(F.aggregate(ordered, start, step, finish))
