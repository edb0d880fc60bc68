"""Document quality by weak supervision, in DataFrame functions only.

Rules look at counts of a text and vote good, bad or abstain. How far each vote can be trusted is not set by
hand: a two-class latent model is fitted by expectation-maximisation over all documents, and a document's
quality is the posterior probability of the good class. A single doubtful vote so no longer rejects a document.

The fit reads no documents: it works on the table of vote patterns with their counts, which has at most
``3 ** len(RULES)`` rows at any size of input. An iteration is one aggregation of that table.

NULL and empty texts have no words, and count as failing the base rule. Repeated rows count as often as they
occur; an empty table gives an empty result; other columns are kept.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tollgate.llm.common import WORD, saved, words

#: Words of a window, for repeated passages.
_WINDOW = 8
GOOD, BAD, NONE = 1, 0, -1
#: Frequent words of English, French, German and Spanish.
FUNCTION_WORDS = (
    "the of and to in is that for with as was are this be by it from an on at a or "
    "le la les des et qui une un du dans pour par que est sur au ne pas de en "
    "der die das und den von zu mit dem im nicht ein eine als auch es auf ist sich "
    "el los las del y una con se su al lo como no ha"
).split()


def _pairs(hashes: Column, step: int) -> Column:
    """Hash of each element with the one ``step`` places on."""
    later = F.slice(hashes, step + 1, F.greatest(F.size(hashes) - step, F.lit(0)))
    return F.zip_with(hashes, later, lambda a, b: F.xxhash64(a, b))


def _let(value: Column, body) -> Column:
    """``body`` of ``value``, which is computed once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _covered(windows: Column) -> Column:
    """Words in windows that occur twice or more, from the windows' hashes in order."""

    def counted(entries: Column) -> Column:
        def hash_at(i: Column) -> Column:
            return F.get(entries, i)["h"]

        twice = F.filter(
            entries, lambda e, i: F.coalesce(hash_at(i - 1) == e["h"], F.lit(False)) | F.coalesce(hash_at(i + 1) == e["h"], F.lit(False))
        )
        starts = F.array_sort(F.transform(twice, lambda e: e["i"]))
        zero = F.struct(F.lit(0).alias("end"), F.lit(0).alias("n"))

        def add(sum_: Column, i: Column) -> Column:
            end = i + _WINDOW
            return F.struct(end.alias("end"), (sum_["n"] + end - F.greatest(sum_["end"], i)).alias("n"))

        return F.aggregate(starts, zero, add, lambda s: s["n"])

    entries = F.array_sort(F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    repeated = F.size(F.array_distinct(windows)) < F.size(windows)
    return F.when(repeated, _let(entries, counted)).otherwise(0)


def counts(docs: DataFrame) -> DataFrame:
    """Add the counts that the base rule and the votes use, computed once per text.

    Equal windows of words are found by 64-bit hashes within a document.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    lines = F.filter(F.split(text, "\n"), lambda line: line.rlike(WORD))

    def kept(pattern: str) -> Column:
        return F.length(F.regexp_replace(text, f"[^{pattern}]+", ""))

    def of(w: Column) -> Column:
        hashes = F.transform(w, lambda x: F.xxhash64(x))
        # One by one, pairs of neighbours, pairs of pairs: eight words.
        windows = _let(_pairs(hashes, 1), lambda two: _let(_pairs(two, 2), lambda four: _pairs(four, 4)))
        windows = F.slice(windows, 1, F.greatest(F.size(w) - (_WINDOW - 1), F.lit(0)))
        return F.struct(
            F.size(w).cast("long").alias("n_words"),
            F.length(F.array_join(w, "")).cast("long").alias("word_chars"),
            kept(r"#*$%&|<>").cast("long").alias("n_symbols"),
            _let(windows, _covered).cast("long").alias("n_repeat_words"),
            F.size(F.array_distinct(w)).cast("long").alias("_distinct"),
            _let(lines, lambda x: F.struct(F.size(x).alias("n"), F.size(F.array_distinct(x)).alias("d"))).alias("_lines"),
            F.size(F.filter(F.zip_with(w, F.slice(w, 2, F.size(w)), lambda a, b: a == b), lambda x: x)).cast("long").alias("_same"),
            kept(r"\p{Lu}").cast("long").alias("_upper"),
            kept(r"!|").cast("long").alias("_marks"),
            kept(r"0-9").cast("long").alias("_digits"),
            F.size(F.filter(w, lambda x: F.lower(x).isin(FUNCTION_WORDS))).cast("long").alias("_function"),
            F.size(F.filter(w, lambda x: x.rlike("[.!?]$"))).cast("long").alias("_ends"),
        )

    counted = docs.select("*", F.inline(F.transform(F.array(words(F.col("text"))), of)))
    n_dup = (F.col("_lines.n") - F.col("_lines.d")).cast("long")
    return counted.withColumns({"n_dup_lines": n_dup, "_n_lines": F.col("_lines.n")}).drop("_lines")


def _share(part: str, whole: str) -> Column:
    return F.col(part) / F.greatest(F.col(whole), F.lit(1))


def _bad(found: Column) -> Column:
    return F.when(found, BAD).otherwise(NONE)


#: Votes by the columns of ``counts``. A rule that looks for one kind of junk can tell bad, but never good.
RULES = {
    "length": lambda: _bad(F.col("n_words") < 20),
    "symbols": lambda: _bad(_share("n_symbols", "n_words") >= 0.15),
    "marks": lambda: _bad(_share("_marks", "n_words") >= 0.15),
    "capitals": lambda: _bad(_share("_upper", "word_chars") >= 0.30),
    "digits": lambda: _bad(_share("_digits", "word_chars") >= 0.20),
    "repeats": lambda: _bad(_share("n_repeat_words", "n_words") >= 0.30),
    "lines": lambda: _bad(_share("n_dup_lines", "_n_lines") >= 0.50),
    "variety": lambda: _bad((F.col("n_words") >= 20) & (F.col("_distinct") < 2 * F.sqrt("n_words"))),
    "stutter": lambda: _bad(_share("_same", "n_words") >= 0.20),
    "word_length": lambda: _bad(~_share("word_chars", "n_words").between(2.0, 14.0)),
    "function_words": lambda: F.when(_share("_function", "n_words") >= 0.10, GOOD).when(
        (F.col("n_words") >= 40) & (_share("_function", "n_words") < 0.02), BAD
    ).otherwise(NONE),
    "sentences": lambda: F.when(_share("_ends", "n_words").between(0.02, 0.34), GOOD).otherwise(NONE),
}
#: Where the fit starts: how often a rule votes so in the good and in the bad class.
START = {GOOD: (0.8, 0.4), BAD: (0.01, 0.3), NONE: (0.19, 0.3)}


def votes(counted: DataFrame) -> DataFrame:
    """Add ``_votes``, the rules' votes in order."""
    return counted.withColumn("_votes", F.array(*[rule() for rule in RULES.values()]).cast("array<tinyint>"))


class Fit:
    """Prior of the good class, and per rule the probability of each vote given each class."""

    def __init__(self, prior: float, rates: list[dict[int, tuple[float, float]]]):
        self.prior, self.rates = prior, rates

    def posterior(self, pattern: str = "_votes") -> Column:
        """Probability that a document is good. An abstention says nothing."""
        odds = F.lit(math.log(self.prior / (1 - self.prior)))
        for i, rates in enumerate(self.rates):
            vote = F.get(F.col(pattern), F.lit(i))
            weights = {v: math.log(good / bad) for v, (good, bad) in rates.items() if v != NONE}
            odds += F.when(vote == GOOD, weights[GOOD]).when(vote == BAD, weights[BAD]).otherwise(0.0)
        return 1 / (1 + F.exp(-odds))


def fit(voted: DataFrame, rounds: int = 12, strength: float = 20.0) -> Fit:
    """Expectation-maximisation over all documents, from ``START``, which also counts as ``strength`` documents."""
    patterns = saved(voted.groupBy("_votes").agg(F.count("*").cast("double").alias("_n")), "votes")
    model = Fit(0.8, [dict(START) for _ in RULES])
    for _ in range(rounds):
        weighed = patterns.select("_n", model.posterior().alias("_good"), F.posexplode("_votes").alias("_rule", "_vote"))
        sums = weighed.groupBy("_rule", "_vote").agg(
            F.sum(F.col("_n") * F.col("_good")).alias("g"), F.sum(F.col("_n") * (1 - F.col("_good"))).alias("b")
        )
        found = {(r["_rule"], r["_vote"]): (r["g"], r["b"]) for r in sums.collect()}  # three rows a rule
        good, bad = (sum(found.get((0, v), (0, 0))[i] for v in START) for i in (0, 1))
        rates = []
        for i in range(len(RULES)):
            seen = {v: found.get((i, v), (0.0, 0.0)) for v in START}
            rates.append(
                {
                    v: ((seen[v][0] + strength * g) / (good + strength), (seen[v][1] + strength * b) / (bad + strength))
                    for v, (g, b) in START.items()
                }
            )
        model = Fit((good + strength * 0.8) / (good + bad + strength), rates)
    return model


#: Columns that ``score`` adds.
ADDED = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "quality", "kept"]


def score(docs: DataFrame) -> DataFrame:
    """Add counts, base_failed, quality (posterior of good) and kept to ``docs`` (text and any other columns).

    A column of ``docs`` that has the name of an added one is replaced.
    """
    own = {f"_doc_{i}": name for i, name in enumerate(docs.columns) if name not in ADDED}
    text = F.col("text").alias("text")
    renamed = docs.select(*[F.col(f"`{name}`").alias(key) for key, name in own.items() if name != "text"], text)
    counted = saved(votes(counts(renamed)), "quality")
    model = fit(counted)
    failed = (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))
    scored = counted.withColumn("base_failed", failed).withColumn("quality", model.posterior())
    scored = scored.withColumn("kept", ~F.col("base_failed") & (F.col("quality") >= 0.5))
    back = [F.col("text" if name == "text" else key).alias(name) for key, name in own.items()]
    return scored.select(*back, *ADDED)
