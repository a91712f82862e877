"""Operator 8, personal data: labelers vote on candidate spans, EM weighs them, a classifier decides.

The base patterns find mail addresses, IPv4 addresses, card and phone numbers. The method looks at
looser candidates too: masked mail addresses, local phone numbers, national id numbers, account numbers and
named persons. For every candidate and every base span, labelers that look at its form, a checksum, gazetteers,
the words before it, its digits and its neighbours vote or abstain. Expectation-maximisation over the vote
patterns of the whole corpus estimates each labeler's reliability (``weak.py``), and the resulting
classifier keeps the candidates with a posterior of at least ``threshold``. Base spans always stay.

Texts are searched once: the spans of each row, with their votes, are written to the shared folder and read
twice, to fit and to classify. Only built-in functions are used.

Defined results: null and empty texts have no spans. Rows are independent: repeated rows and null
ids give one row each; an empty table gives no rows.
"""

from pyspark.sql import functions as F

from rastro.llm.spans import SPAN, listed, matches, overlaps_none
from rastro.llm.weak import fit
from rastro.session import scratch_path

KINDS = ("email", "ip", "card", "phone")
EXTRA = ("masked_email", "local_phone", "national_id", "iban", "person")

#: Fixed patterns. They find what the plain forms find, but do not rescan a run of characters from
#: each of its places: a search starts at the end of the previous match or where a run begins,
#: and possessive repeats do not give back.
_LOCAL = r"A-Za-z0-9._%+-"
EMAIL = rf"(?:\G|(?<![{_LOCAL}]))[{_LOCAL}]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
CARD = r"[0-9](?:[\x20-]?[0-9])++"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"

MASKED_EMAIL = (
    r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64}\x20?[\[(](?i:at)[\])]\x20?[A-Za-z0-9-]{1,63}"
    r"(?:\x20?(?:\.|[\[(](?i:dot)[\])])\x20?[A-Za-z0-9-]{1,63}){1,8}"
)
LOCAL_PHONE = r"(?<![0-9A-Za-z+().-])\(?[0-9]{3}\)?[\x20.-][0-9]{3}[\x20.-][0-9]{4}(?![0-9-])"
NATIONAL_ID = r"(?<![0-9A-Za-z-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])"
IBAN = r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){2,7}(?:\x20?[A-Z0-9]{1,3})?(?![A-Za-z0-9])"

#: Gazetteers, fixed lists: given names, top-level domains, country codes of accounts.
GIVEN_NAMES = (
    "James John Robert Michael William David Richard Mary Patricia Linda Barbara Elizabeth Jennifer "
    "Maria Susan Thomas Charles Daniel Hans Peter Klaus Anna Julia Pierre Jean Marie Jose Juan Carlos"
).split()
PERSON = rf"(?<![A-Za-z])(?:{'|'.join(GIVEN_NAMES)})\x20\p{{Lu}}\p{{Ll}}{{1,30}}"
DOMAINS = "com org net edu gov io de fr es uk eu info biz us"
ACCOUNT_COUNTRIES = "DE FR ES IT NL BE AT CH GB PT IE LU PL SE DK NO FI"
#: Words before a span that speak for it or against it.
CUES = {
    "email": "mail|contact|write",
    "ip": r"\bip\b|server|host|address",
    "card": r"card|visa|master|credit|karte|tarjeta|carte",
    "phone": r"phone|\btel|call|mobile|fax|anruf|llam|appel",
    "masked_email": "mail|contact|write",
    "local_phone": r"phone|\btel|call|mobile|fax|anruf|llam|appel",
    "national_id": "ssn|social|security|passport",
    "iban": r"iban|account|konto|cuenta|compte",
    "person": r"\bm(r|rs|s)\b|name|contact|signed|herr|frau|señor",
}
AGAINST = r"order|invoice|isbn|version|article|model|serial|build|chapter|figure|\bv\.?\s*$|\bno\.?\s*$"

LABELERS = ("form", "checksum", "gazetteer", "context", "digits", "borders")


def digits_of(body):
    return F.regexp_replace(body, "[^0-9]+", "")


def passes_luhn(digits):
    """Column: the check digit of a string of digits is right."""
    total = F.aggregate(
        F.transform(
            F.reverse(F.array_remove(F.split(digits, ""), "")),
            lambda d, i: F.when(
                i % 2 == 1, d.cast("int") * 2 - F.when(d.cast("int") > 4, 9).otherwise(0)
            ).otherwise(d.cast("int")),
        ),
        F.lit(0),
        lambda total, d: total + d,
    )
    return total % 10 == 0


def _small_parts(body):
    """Every dotted part is a number of at most 255; leading zeros are allowed."""

    def small(part):
        plain = F.regexp_replace(part, "^0+(?=.)", "")
        return F.when(F.length(plain) > 3, F.lit(False)).otherwise(
            F.substring(plain, 1, 3).cast("int") <= 255
        )

    return F.forall(F.split(body, r"\."), small)


def _of(whole, kind):
    """Spans of one base kind that meet its condition."""
    if kind == "email":
        return matches(whole, kind, EMAIL, only_if=r"@[A-Za-z0-9-]")
    if kind == "ip":
        return F.filter(matches(whole, kind, IP), lambda s: _small_parts(s["body"]))
    if kind == "card":
        found = matches(whole, kind, CARD, only_if=r"(?:[0-9][\x20-]?){15}[0-9]")
        return F.filter(
            found,
            lambda s: F.when(
                F.length(digits_of(s["body"])).between(16, 19), passes_luhn(digits_of(s["body"]))
            ).otherwise(F.lit(False)),
        )
    found = matches(whole, kind, PHONE, only_if=r"\+[0-9]")
    return F.filter(found, lambda s: F.length(digits_of(s["body"])).between(8, 15))


def _votes(s, whole):
    """Struct of the labelers' votes on the span ``s``."""
    body, kind = s["body"], s["kind"]
    before = F.lower(
        F.substring(whole, F.greatest(s["start"] - 39, F.lit(1)), F.least(s["start"], F.lit(40)))
    )
    edge_left = F.substring(whole, s["start"], F.least(s["start"], F.lit(1)))
    edge_right = F.substring(whole, s["stop"] + 1, 1)
    numbers = digits_of(body)

    def vote(good, bad):
        return F.when(good, F.lit(1)).when(bad, F.lit(-1)).otherwise(F.lit(0))

    cue = F.lit(False)
    for name, words in CUES.items():
        cue = cue | ((kind == name) & before.rlike(words))
    domain = F.lower(F.regexp_extract(body, r"([A-Za-z]+)$", 1))
    numeric = kind.isin("card", "phone", "local_phone", "national_id")
    return F.struct(
        # the strict forms are typical; loose ones need other support
        vote(kind.isin(*KINDS, "masked_email"), kind.isin("person", "local_phone")).alias("form"),
        vote(
            kind.isin("card", "ip") | ((kind == "national_id") & ~body.rlike("^(000|666|9)|-00-|0000$")),
            (kind == "national_id") | ((kind == "iban") & ~body.rlike("[0-9]{6}")),
        ).alias("checksum"),
        vote(
            (kind.isin("email", "masked_email") & domain.isin(DOMAINS.split()))
            | ((kind == "iban") & F.substring(body, 1, 2).isin(ACCOUNT_COUNTRIES.split()))
            | (kind == "phone")
            | (kind == "person"),
            kind.isin("email", "masked_email", "iban"),
        ).alias("gazetteer"),
        vote(cue, before.rlike(AGAINST)).alias("context"),
        vote(
            numeric & ~numbers.rlike(r"(.)\1{6}|0123456789|1234567"),
            numeric & numbers.rlike(r"(.)\1{6}|0123456789|1234567"),
        ).alias("digits"),
        vote(
            edge_left.rlike(r"^[\s(\[\"'<:,;]?$") & edge_right.rlike(r"^[\s)\]\"'>:,;.!?]?$"),
            edge_left.rlike("[A-Za-z0-9]") | edge_right.rlike("[A-Za-z0-9]"),
        ).alias("borders"),
    )


def find_candidates(docs, text="text"):
    """Add ``_base`` (spans that stay) and ``_other`` (candidates), each span with its votes."""
    whole = F.coalesce(F.col(text), F.lit(""))
    base = F.concat(*[_of(whole, kind) for kind in KINDS])
    other = F.concat(
        matches(whole, "masked_email", MASKED_EMAIL, only_if=r"(?i)[\[(]at[\])]"),
        matches(whole, "local_phone", LOCAL_PHONE),
        matches(whole, "national_id", NATIONAL_ID),
        matches(whole, "iban", IBAN),
        matches(whole, "person", PERSON),
    )
    found = docs.withColumns({"_base": base, "_all": other})
    found = found.withColumn(
        "_other", F.filter(F.col("_all"), lambda s: overlaps_none(s, F.col("_base")))
    )

    def with_votes(spans):
        return F.transform(F.col(spans), lambda s: F.struct(s.alias("span"), _votes(s, whole).alias("vote")))

    return found.withColumns(
        {"_base": with_votes("_base"), "_other": with_votes("_other")}
    ).drop("_all")


def find_personal_data(docs, text="text", threshold=0.5):
    """``docs`` without ``text``, with ``_base`` and ``_found``, arrays of (kind, start, stop, body).

    Runs the search when called. Names that begin with an underscore must not occur in ``docs``.
    """
    spark = docs.sparkSession
    folder = scratch_path(spark, "personal-data")
    find_candidates(docs, text).drop(text).write.parquet(folder)
    found = spark.read.parquet(folder)
    voted = found.select(F.explode(F.concat("_base", "_other")).alias("x")).select("x.vote.*")
    model = fit(voted, LABELERS)
    accepted = F.filter("_other", lambda x: _posterior(model, x["vote"]) >= threshold)

    def spans(column):
        return F.transform(column, lambda x: x["span"]).cast(f"array<{SPAN}>")

    return found.withColumns({"_base": spans(F.col("_base")), "_found": spans(accepted)}).drop("_other")


def _posterior(model, vote):
    """The model's posterior for a struct of votes inside an array."""
    return model.posterior(lambda name: vote[name])


def personal_data_report(docs, doc_id="doc_id", text="text"):
    """One row per document: counts of the base kinds, a digest of their places, and all spans."""
    found = find_personal_data(docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")))
    base = F.col("_base")
    kinds = KINDS + EXTRA

    def count(kind):
        return F.size(F.filter(base, lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return found.select(
        "doc_id",
        *[count(kind) for kind in KINDS],
        F.sha2(listed(base, kinds, by_kind=True), 256).alias("base_sha256"),
        listed(F.concat(base, F.col("_found")), kinds, by_kind=True).alias("spans"),
    )
