"""Operator 1, secret scans: patterns, and sliding-window entropy per character class.

Patterns find secrets with a known form. The entropy method takes the other strings that mix
letters with digits, slides a window over each, and keeps a count per character: when the window
moves, one count rises and one falls, and the sum behind the Shannon entropy follows from those
two alone. A candidate is a secret if a window reaches the threshold of the candidate's character
class and nothing on the allow-list speaks against it. All of it is built-in functions over one row.

Defined results: a null text has no secrets; empty text likewise; rows are independent, so ties,
repeated rows and null ids give one result row each. Columns other than the id and the text are not
looked at; ``mask_secrets`` hands them on.
"""

from math import log2

from pyspark.sql import functions as F

from rastro.llm.spans import SPANS, listed, masked, matches, overlaps_none

KINDS = ("assign", "access", "hex", "entropy")

#: Fixed patterns. Letter cases are written out, so no case folding beyond ASCII takes place.
_KEY = (
    "(?:[Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]"
    "|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])"
)
_SIGN = r"""["']?\x20*[:=]\x20*["']?"""
ASSIGN = rf"{_KEY}{_SIGN}([A-Za-z0-9+/_.=-]+)"
ASSIGN_LONG = rf"{_KEY}{_SIGN}[A-Za-z0-9+/_.=-]{{8}}"
#: A run that is long enough is matched whole, a shorter one never; so the length can be part of
#: the pattern. Looking behind lets the search pass over the inside of a run that failed.
ACCESS = r"AKIA[A-Z0-9]{12,}"
HEX = r"(?<![0-9a-f])[0-9a-f]{32,}"

#: Strings of this many characters that hold a letter and a digit are candidates of the entropy scan, after
#: '=' too; '=' belongs to a candidate only as padding, not as the sign between a name and a value.
WINDOW = 20
CANDIDATE = (
    r"(?<![A-Za-z0-9+/_-])(?=[A-Za-z+/_-]*+[0-9])(?=[0-9+/_-]*+[A-Za-z])"
    rf"[A-Za-z0-9+/_-]{{{WINDOW},}}+(?:={{1,2}}+(?![A-Za-z0-9+/_=-]))?"
)
ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_-="
#: (class, pattern, bits per character that a window must reach); the first class that fits counts.
CLASSES = (
    ("hex", "^([0-9a-f]+|[0-9A-F]+)$", 3.0),
    ("alphanumeric", "^[A-Za-z0-9]+$", 3.7),
    ("base64", "^.*$", 3.85),
)
#: Allow-list: strings that look random and are no secrets. Lower-case strings in parts are let through if every part is
#: letters or digits, or a word with a short number (python3, 64bit); a key behind a prefix has a part that is neither.
ALLOWED = (
    r"(?i)example|sample|dummy|placeholder|changeme|x{6,}",
    r"(?i)^[0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12}$",
    r"(?i)0123456789|123456789|abcdefghij",
    r"^[a-z]+[0-9]{0,4}([_/+-]([a-z]+[0-9]{0,4}|[0-9]+[a-z]{0,3}))+$",
    r"(.)\1{7}",
)


def window_entropy(body, window=WINDOW):
    """Column: highest Shannon entropy, in bits, of any ``window`` characters; 0 if shorter."""
    codes = F.transform(
        F.filter(F.split(body, ""), lambda c: c != ""), lambda c: F.instr(F.lit(ALPHABET), c)
    )
    leaving = F.concat(F.array_repeat(F.lit(0), window), codes)
    steps = F.slice(F.arrays_zip(codes.alias("new"), leaving.alias("old")), 1, F.length(body))
    weights = F.array(*[F.lit(c * log2(c) if c else 0.0) for c in range(window + 2)])
    start = F.struct(
        F.array_repeat(F.lit(0), len(ALPHABET)).alias("counts"),
        F.lit(0).alias("seen"),
        F.lit(0.0).alias("total"),
        F.lit(0.0).alias("best"),
    )

    def weight(count):
        return F.element_at(weights, count + 1)

    def step(state, x):
        new, old, counts = x["new"], x["old"], state["counts"]
        rises = F.element_at(counts, new)
        # no index may be null, and none below 1
        falls = F.when(old > 0, F.element_at(counts, F.greatest(old, F.lit(1)))).otherwise(F.lit(1))
        moved = (weight(rises + 1) - weight(rises)) - F.when(
            old > 0, weight(falls) - weight(falls - 1)
        ).otherwise(F.lit(0.0))
        total = state["total"] + F.when(new == old, F.lit(0.0)).otherwise(moved)
        counts = F.transform(
            counts,
            lambda c, i: c + (i + 1 == new).cast("int") - (i + 1 == old).cast("int"),
        )
        entropy = F.when(state["seen"] + 1 >= window, F.lit(log2(window)) - total / window)
        return F.struct(
            counts.alias("counts"),
            (state["seen"] + 1).alias("seen"),
            total.alias("total"),
            F.greatest(state["best"], F.coalesce(entropy, F.lit(0.0))).alias("best"),
        )

    return F.aggregate(steps, start, step, lambda state: state["best"])


def _threshold(body):
    needed = F.lit(None).cast("double")
    for _, pattern, bits in reversed(CLASSES):
        needed = F.when(body.rlike(pattern), F.lit(bits)).otherwise(needed)
    return needed


def find_secrets(docs, text="text", allowed=ALLOWED):
    """Add the columns ``_base`` and ``_entropy``, arrays of (kind, start, stop, body)."""
    whole = F.coalesce(F.col(text), F.lit(""))
    assign = F.filter(
        matches(whole, "assign", ASSIGN, only_if=ASSIGN_LONG),
        lambda s: F.length(F.regexp_extract(s["body"], ASSIGN, 1)) >= 8,
    )
    base = F.concat(assign, matches(whole, "access", ACCESS), matches(whole, "hex", HEX))
    found = docs.withColumn("_base", base).withColumn("_other", matches(whole, "entropy", CANDIDATE))

    def is_secret(s):
        keep = overlaps_none(s, F.col("_base"))
        for pattern in allowed:
            keep = keep & ~s["body"].rlike(pattern)
        return keep & (window_entropy(s["body"]) >= _threshold(s["body"]))

    entropy = F.filter(F.col("_other"), is_secret)
    return found.withColumn("_entropy", entropy).drop("_other")


def secret_report(docs, doc_id="doc_id", text="text"):
    """One row per document: counts of the base kinds, a digest of their places, and all spans."""
    found = find_secrets(docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")))
    base = F.col("_base")

    def count(kind):
        return F.size(F.filter(base, lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return found.select(
        "doc_id",
        count("assign"),
        count("access"),
        count("hex"),
        F.sha2(listed(base, KINDS, by_kind=False), 256).alias("base_sha256"),
        listed(F.concat(base, F.col("_entropy")), KINDS, by_kind=False).alias("spans"),
    )


def mask_secrets(docs, text="text", mark="[SECRET]"):
    """``docs`` with every secret in ``text`` replaced by ``mark``; other columns as they are.

    A null text stays null.
    """
    found = find_secrets(docs.select(F.struct("*").alias("row"), F.col(text).alias("text")))
    found = found.withColumn("_spans", F.concat(F.col("_base"), F.col("_entropy")).cast(SPANS))
    cleaned = F.when(F.col("text").isNull(), F.lit(None).cast("string")).otherwise(
        masked(F.col("text"), F.col("_spans"), mark)
    )
    return found.select(
        *[cleaned.alias(c) if c == text else F.col("row")[c].alias(c) for c in docs.columns]
    )
