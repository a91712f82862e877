"""Operator 10, quality rules: rules vote or abstain, EM weighs them, a posterior decides.

Each rule votes on a document from a few counts. How far a rule can be trusted is estimated by
expectation-maximisation over the vote patterns of the whole corpus (``weak.py``), not set by hand,
and a document is kept if the posterior probability of good quality reaches ``threshold``.

All counts are built-in functions over one row. The counts of a row are written once, to the shared
folder, because they are needed twice: to fit the rules and to judge with them.

Defined results: a null text counts as empty, has no words, and fails (fewer than 10 words). Rows
are independent: repeated rows and null ids give one row each. An empty table gives no rows.
"""

from pyspark.sql import functions as F

from rastro.llm.weak import fit
from rastro.session import scratch_path

SPACE = r"[\x20\x09-\x0D]+"
SPACES = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"
#: Very common short words of the languages in the corpus, padded to find whole words.
COMMON = (
    "the of and to in is that with "
    "la de que el en y los del se las "
    "der die und das ist nicht mit von ein "
    "le les et des est une dans pour qui"
).split()

RULES = (
    "enough_words",
    "few_symbols",
    "few_marked_words",
    "few_repeated_words",
    "few_repeated_lines",
    "mostly_lower_case",
    "ends_sentences",
    "few_exclamations",
    "common_words",
    "usual_word_length",
)


def words_of(text):
    """Column array of the words of ``text`` (not null), split at ASCII white space."""
    return F.array_remove(F.split(text, SPACE), "")


def _repeat_words(words):
    """Words inside any five-word window that occurs twice or more, the first one included.

    Windows are compared by a hash first: if all hashes differ, all windows do. Only a text with equal
    hashes has its windows compared as strings, by sorting them.
    """
    last = F.greatest(F.size(words) - 5, F.lit(0))

    def window(i):
        return F.slice(words, i + 1, 5)

    hashes = F.transform(
        F.sequence(F.lit(0), last), lambda i: F.xxhash64(*[F.get(words, i + k) for k in range(5)])
    )
    ordered = F.sort_array(
        F.transform(
            F.sequence(F.lit(0), last),
            lambda i: F.struct(F.array_join(window(i), " ").alias("gram"), i.alias("at")),
        )
    )
    nobody = F.array(F.lit(None).cast("struct<gram:string,at:int>"))

    def places(windows):
        beside = F.arrays_zip(
            windows.alias("own"),
            F.concat(nobody, windows).alias("before"),
            F.slice(windows, 2, F.size(words)).alias("after"),
        )
        repeated = F.filter(
            beside,
            lambda x: (x["own"]["gram"] == x["before"]["gram"]) | (x["own"]["gram"] == x["after"]["gram"]),
        )
        return F.sort_array(F.transform(repeated, lambda x: x["own"]["at"]))

    # the sorted windows are used several times; as the argument of a function they are made once
    repeated = F.flatten(F.transform(F.array(ordered), places))
    covered = F.aggregate(
        repeated,
        F.struct(F.lit(0).alias("upto"), F.lit(0).alias("n")),
        lambda state, at: F.struct(
            (at + 5).alias("upto"), (state["n"] + at + 5 - F.greatest(state["upto"], at)).alias("n")
        ),
        lambda state: state["n"],
    )
    none = (F.size(words) < 6) | (F.size(F.array_distinct(hashes)) == F.size(hashes))
    return F.when(none, F.lit(0)).otherwise(covered)


def document_counts(docs, text="text"):
    """Add the counts that the rules look at; ``docs`` may have any other columns."""
    whole = F.coalesce(F.col(text), F.lit(""))
    words = F.col("_words")
    lines = F.filter(F.split(whole, "\n", -1), lambda line: line.rlike(r"[^\x20\x09-\x0D]"))
    found = docs.withColumn("_words", words_of(whole)).withColumn("_lines", lines)

    def length_without(characters):
        return F.length(F.translate(whole, characters, ""))

    def long(column):
        return column.cast("long")

    return found.withColumns(
        {
            "n_words": long(F.size(words)),
            "word_chars": long(length_without(SPACES)),
            "n_symbols": long(F.length(whole) - length_without(SYMBOLS)),
            "n_dup_lines": long(F.size("_lines") - F.size(F.array_distinct("_lines"))),
            "n_repeat_words": long(_repeat_words(words)),
            "_n_lines": long(F.size("_lines")),
            "_n_marked": long(F.regexp_count(whole, F.lit(r"[#*$%&|<>!]+"))),
            "_n_exclaim": long(F.length(whole) - length_without("!")),
            "_n_upper": long(F.regexp_count(whole, F.lit(r"\p{Lu}"))),
            "_n_ended": long(F.size(F.filter(F.col("_lines"), lambda s: s.rlike(r"[.?!\"'”»)]\s*$")))),
            "_n_common": long(F.size(F.array_intersect(words, F.array(*map(F.lit, COMMON))))),
        }
    ).drop("_words", "_lines")


def _votes():
    """Column of each rule's vote: 1 good, -1 bad, 0 abstains."""
    n = F.col("n_words")

    def vote(good, bad):
        return F.when(good, F.lit(1)).when(bad, F.lit(-1)).otherwise(F.lit(0))

    c = F.col
    return {
        "enough_words": vote(n >= 50, n < 10),
        "few_symbols": vote(c("n_symbols") * 50 <= n, c("n_symbols") * 10 > n),
        "few_marked_words": vote(c("_n_marked") * 20 <= n, c("_n_marked") * 10 > n * 3),
        "few_repeated_words": vote(c("n_repeat_words") == 0, c("n_repeat_words") * 5 > n),
        "few_repeated_lines": vote(
            (c("_n_lines") > 3) & (c("n_dup_lines") == 0), c("n_dup_lines") * 10 > c("_n_lines") * 3
        ),
        "mostly_lower_case": vote(
            c("_n_upper") * 10 <= c("word_chars"), c("_n_upper") * 10 > c("word_chars") * 3
        ),
        "ends_sentences": vote(
            c("_n_ended") * 10 >= c("_n_lines") * 7, c("_n_ended") * 2 < c("_n_lines")
        ),
        "few_exclamations": vote(c("_n_exclaim") * 50 <= n, c("_n_exclaim") * 5 > n),
        "common_words": vote(c("_n_common") >= 3, (n >= 30) & (c("_n_common") == 0)),
        "usual_word_length": vote(
            c("word_chars").between(3 * n, 9 * n), (c("word_chars") < 2 * n) | (c("word_chars") > 12 * n)
        ),
    }


def judge_quality(docs, text="text", threshold=0.5):
    """``docs`` without ``text``, with the counts, ``base_failed``, ``quality`` and ``kept``.

    ``quality`` is the posterior probability of good quality. Runs the counting job when called.
    """
    spark = docs.sparkSession
    folder = scratch_path(spark, "quality")
    counted = document_counts(docs, text).drop(text)
    base_failed = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    counted.withColumns(_votes()).withColumn("base_failed", base_failed).write.parquet(folder)
    counted = spark.read.parquet(folder)
    model = fit(counted, RULES)
    return (
        counted.withColumn("quality", model.posterior())
        .withColumn("kept", ~F.col("base_failed") & (F.col("quality") >= threshold))
        .drop(*RULES, *(c for c in counted.columns if c.startswith("_n_")))
    )


def quality_report(docs, doc_id="doc_id", text="text"):
    """One row per document: its counts, the base verdict and the method's."""
    judged = judge_quality(docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")))
    return judged.select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        "base_failed",
        "kept",
        "quality",
    )
