"""Quality rules whose cutoffs carry a proven limit on false rejections.

A rule rejects a document when one of its measures exceeds a cutoff.  Labelled documents of good quality that pass the base
rules serve as holdout: for a rule, a stratum and a cutoff, ``k`` of ``n`` good ones are rejected, and the cutoff is certified
when the exact binomial probability of at most ``k`` rejections at the rate ``alpha`` times the rule's share is no more than
``delta`` times that share, over the number of strata.  ``SHARES`` states the shares, which add up to one.  Cutoffs
are tried from the most lenient down and the first that fails ends the sequence (fixed-sequence testing), so only rules and
strata need the Bonferroni correction.  Among certified cutoffs the one is taken that rejects most documents labelled bad,
each rejected good one counting ``GOOD_WEIGHS`` times as much; ties go to the most lenient.

All strata together form one more, pooled stratum.  Where a stratum has too few good labels to certify a rule even without a
false rejection, or no labels, the pooled cutoff of that rule holds; labels of enough size that certify nothing leave the rule
off.  With probability ``1 - delta`` no stratum with cutoffs of its own, and not the corpus as a whole under the pooled ones,
loses more than the share ``alpha`` of its good documents that pass the base rules to all rules together.  What a small
stratum loses by itself under a pooled cutoff is not bounded.

All steps are DataFrame functions.  Null counts as an empty text (it fails the base rules); a null stratum is a stratum;
labels without a document, of other values or null are ignored; a label given twice counts twice.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from aeroledger.llm.common import SPACES, stored, whole_text, words_of

ALPHA, DELTA = 0.03, 0.05
GOOD_WEIGHS = 10
# Each rule's share of alpha and delta; fixed, but set after a review of sf0.1 had named symbols as the usual damage.
SHARES = {"symbols": 0.5, "repeats": 0.2, "lines": 0.1, "marks": 0.1, "capitals": 0.05, "length": 0.05}
SYMBOLS = "#*$%&|<>"
# Measures and their cutoffs, the most lenient first; chosen beforehand, not from data.
CUTOFFS = {
    "symbols": [0.4, 0.35, 0.3, 0.25, 0.2, 0.15, 0.1, 0.08, 0.06, 0.04, 0.03, 0.02, 0.01],
    "capitals": [0.95, 0.9, 0.8, 0.7, 0.6, 0.5, 0.4, 0.3, 0.25, 0.2],
    "marks": [1.8, 1.5, 1.2, 1.0, 0.8, 0.6, 0.5, 0.4, 0.3, 0.2],
    "repeats": [0.48, 0.45, 0.4, 0.35, 0.3, 0.25, 0.2, 0.15],
    "lines": [0.9, 0.8, 0.7, 0.6, 0.5, 0.4, 0.3],
    "length": [15.0, 13.0, 11.0, 10.0, 9.0, 8.0, 7.5],
}


def count_of(text: Column, pattern: str) -> Column:
    """Characters of ``text`` that match a character class."""
    return (F.char_length(text) - F.char_length(F.regexp_replace(text, pattern, ""))).cast("long")


def named(value: Column, use) -> Column:
    """``use(value)`` with the value computed once."""
    return F.transform(F.array(value), use)[0]


def repeated_words(words: Column) -> Column:
    """Words inside 3-word windows that occur twice or more.

    Texts whose window hashes all differ are done.  Else windows are sorted by hash and place, so equal ones become
    neighbours; the words are compared as well.  Each repeated window adds the words up to the next one, three at most.
    """
    def word(ws: Column, i: Column, ahead: int) -> Column:
        return F.get(ws, i + ahead)

    def hashes(ws: Column) -> Column:
        places = F.when(F.size(ws) >= 3, F.sequence(F.lit(0), F.size(ws) - 3)).otherwise(F.array().cast("array<int>"))
        return F.transform(places, lambda i: F.xxhash64(word(ws, i, 0), word(ws, i, 1), word(ws, i, 2)))

    def same(ws: Column, a: Column, b: Column) -> Column:
        equal = a["h"] == b["h"]
        for ahead in range(3):
            equal = equal & (word(ws, a["i"], ahead) == word(ws, b["i"], ahead))
        return F.coalesce(equal, F.lit(False))

    def starts(ws: Column, sorted_windows: Column) -> Column:
        return F.sort_array(F.transform(F.filter(
            sorted_windows, lambda x, k: same(ws, x, F.get(sorted_windows, k - 1)) | same(ws, x, F.get(sorted_windows, k + 1))),
            lambda x: x["i"]))

    def covered(places: Column) -> Column:
        return F.aggregate(places, F.struct(F.lit(0).cast("long").alias("n"), F.lit(-3).alias("last")), lambda got, i: F.struct(
            (got["n"] + F.least(F.lit(3), i - got["last"])).alias("n"), i.alias("last")))["n"]

    def counted(ws: Column, h: Column) -> Column:
        windows = F.sort_array(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))
        return F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0).cast("long")).otherwise(
            named(windows, lambda found: covered(starts(ws, found))))

    return named(words, lambda ws: named(hashes(ws), lambda h: counted(ws, h)))


def measures(docs: DataFrame, key: str = "doc_id", text: str = "text", stratum: str = "lang") -> DataFrame:
    """The counts of each document: key, stratum, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words and others."""
    whole = whole_text(text)
    spaces = "[" + "".join(f"\\x{ord(c):02x}" for c in SPACES) + "]"
    split = docs.select(F.col(key), F.col(stratum).cast("string").alias("stratum"), whole.alias("whole"),
                        words_of(whole).alias("words"))
    lines = F.filter(F.split("whole", "\n"), lambda x: F.btrim(x, F.lit(SPACES)) != "")
    named = split.withColumn("lines", lines)
    return named.select(
        key, "stratum", F.size("words").cast("long").alias("n_words"),
        (F.char_length("whole") - count_of(F.col("whole"), spaces)).cast("long").alias("word_chars"),
        count_of(F.col("whole"), "[#*$%&|<>]").alias("n_symbols"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        repeated_words(F.col("words")).alias("n_repeat_words"), F.size("lines").cast("long").alias("n_lines"),
        count_of(F.col("whole"), r"\p{Lu}").alias("n_capitals"), count_of(F.col("whole"), "[!?]").alias("n_marks"))


def scores(m: DataFrame) -> dict[str, Column]:
    def share(a: str, b: str) -> Column:
        return F.coalesce(F.try_divide(F.col(a).cast("double"), F.col(b).cast("double")), F.lit(0.0))

    return {"symbols": share("n_symbols", "word_chars"), "capitals": share("n_capitals", "word_chars"),
            "marks": share("n_marks", "n_words"), "repeats": share("n_repeat_words", "n_words"),
            "lines": share("n_dup_lines", "n_lines"), "length": share("word_chars", "n_words")}


def binomial_tail(k: Column, n: Column, rate: Column) -> Column:
    """P(X <= k) for X ~ Bin(n, rate), terms added in logarithms; 1 where k is not below the mean (never certified)."""
    start = n * F.log1p(-rate)
    odds = F.log(rate / (1 - rate))
    total = F.aggregate(
        F.sequence(F.lit(0), F.greatest(k, F.lit(0)).cast("int")),
        F.struct(F.lit(0.0).alias("sum"), start.alias("term")),
        lambda got, i: F.struct((got["sum"] + F.exp(got["term"])).alias("sum"),
                                (got["term"] + F.log((n - i) / (i + 1.0)) + odds).alias("term")))["sum"]
    return F.when(k < n * rate, F.least(total, F.lit(1.0))).otherwise(F.lit(1.0))


def base_failed() -> Column:
    return (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


def certified_cutoffs(measured: DataFrame, labels: DataFrame, key: str = "doc_id", alpha: float = ALPHA,
                      delta: float = DELTA, cutoffs: dict[str, list[float]] | None = None) -> DataFrame:
    """The cutoffs that hold: pooled, stratum, rule, cutoff (null: certified none), n_good, k_good, k_bad, p_value.

    Strata without enough good labels for a rule have no row for it.
    """
    cutoffs = cutoffs or CUTOFFS
    labelled = measured.where(~base_failed()).join(labels.where("quality IN (0, 1)").select(key, "quality"), key)
    values = scores(measured)

    def passed(value: Column, tries: list[float]) -> Column:
        return F.size(F.filter(F.array(*[F.lit(c) for c in tries]), lambda c: value <= c))

    steps = F.explode(F.array(*[F.struct(F.lit(rule).alias("rule"), passed(values[rule], tries).alias("passed"))
                                for rule, tries in cutoffs.items()]))
    group = ("pooled", "stratum", "rule")
    # passed: how many of the cutoffs, a prefix of the sequence, let the document through
    counted = (labelled.select("stratum", "quality", steps.alias("s")).groupBy("stratum", F.col("s.rule").alias("rule"),
                                                                              F.col("s.passed").alias("passed"))
               .agg(F.count_if(F.col("quality") == 1).alias("good"), F.count_if(F.col("quality") == 0).alias("bad")))
    both = F.explode(F.array(F.struct(F.lit(False).alias("pooled"), F.col("stratum")),
                             F.struct(F.lit(True).alias("pooled"), F.lit(None).cast("string").alias("stratum"))))
    counted = counted.select(both.alias("of"), "rule", "passed", "good", "bad").select("of.*", "rule", "passed", "good", "bad")
    tries = counted.groupBy(*group).agg(
        F.sum("good").alias("n_good"), F.collect_list(F.struct("passed", "good", "bad")).alias("by"))
    table = F.create_map(*[x for rule, c in cutoffs.items() for x in (F.lit(rule), F.array(*map(F.lit, c)))])
    shares = F.create_map(*[x for rule in cutoffs for x in (F.lit(rule), F.lit(SHARES[rule]))])
    ranked = tries.select(*group, "n_good", "by", shares[F.col("rule")].alias("share"),
                          F.posexplode(table[F.col("rule")]).alias("place", "cutoff"))

    def rejected(which: str) -> Column:
        return F.aggregate(F.filter("by", lambda x: x["passed"] <= F.col("place")), F.lit(0).cast("long"),
                           lambda total, x: total + x[which])

    strata = F.dense_rank().over(W.orderBy("pooled", "stratum"))
    n_strata = F.max("s").over(W.partitionBy())
    rate, bound = alpha * F.col("share"), delta * F.col("share") / F.col("n_strata")
    tested = (ranked.withColumn("k_good", rejected("good")).withColumn("k_bad", rejected("bad"))
              .withColumn("s", strata).withColumn("n_strata", n_strata)
              .withColumn("p_value", binomial_tail(F.col("k_good"), F.col("n_good"), rate)))
    certain = F.col("p_value") <= bound
    unbroken = F.min(certain.cast("int")).over(W.partitionBy(*group).orderBy("place")) == 1
    gain = F.col("k_bad") - GOOD_WEIGHS * F.col("k_good")
    best = F.row_number().over(W.partitionBy(*group).orderBy(F.desc("unbroken"), gain.desc(), "place"))
    reached = F.col("n_good") * F.log1p(-rate) <= F.log(bound)
    return (tested.withColumn("unbroken", unbroken).withColumn("best", best).where("best = 1").where(reached | F.col("pooled"))
            .select(*group, F.when(F.col("unbroken"), F.col("cutoff")).alias("cutoff"), "n_good", "k_good", "k_bad", "p_value"))


def judge(measured: DataFrame, chosen: DataFrame, key: str = "doc_id") -> DataFrame:
    """Each document's counts with base_failed, failed_rules and kept."""
    entries = F.map_from_entries(F.collect_list(F.struct("rule", "cutoff")))
    limits = chosen.where("NOT pooled").groupBy(F.col("stratum").alias("of")).agg(entries.alias("limits"))
    shared = chosen.where("pooled").agg(entries).scalar()
    joined = measured.join(limits, F.col("stratum").eqNullSafe(F.col("of")), "left").withColumn("shared", shared)

    def limit(rule: str) -> Column:
        return F.when(F.map_contains_key("limits", F.lit(rule)), F.col("limits")[rule]).otherwise(F.col("shared")[rule])

    failed = F.filter(F.array(*[F.when(v > limit(rule), F.lit(rule)) for rule, v in scores(measured).items()]),
                      lambda x: x.isNotNull())
    return joined.withColumn("base_failed", base_failed()).withColumn("failed_rules", failed).withColumn(
        "kept", ~F.col("base_failed") & (F.size("failed_rules") == 0)).drop("of", "limits", "shared")


def quality_verdicts(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", stratum: str = "lang",
                     alpha: float = ALPHA, delta: float = DELTA) -> DataFrame:
    """Measure all documents, certify cutoffs on the labelled ones, judge all."""
    measured = stored(measures(docs, key, text, stratum), "measures")
    return judge(measured, certified_cutoffs(measured, labels, key, alpha, delta), key)
