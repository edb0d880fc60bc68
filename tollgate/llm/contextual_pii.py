"""Personal data: known forms, and unseen identifiers found by bootstrapping contexts; DataFrame functions only.

Known forms (email, ip, card, phone) are the seeds. An instance is a seed, another word that holds a digit
or an ``@``, or a run of neighbouring words with digits; its context is the word before and the word after it.
Contexts with a kind are patterns, and patterns and instances make a graph that is scored in rounds: a pattern's
confidence is the share of that kind among the different values that stand in its context, an instance's belief
is ``1 - prod(1 - confidence)`` over the patterns it stands in, times the evidence of its shape. That is the
likeness (numbers of digits and of groups of digits, letters, ``@``) to the shape of a seed, or to that of an
instance found before times the belief in it; no shape is required. Instances of high belief become seeds of the
next round. Copies of a text add no evidence, because values are counted once. Words of a run can be found by
themselves, but only the run counts in its context. Of found spans that overlap, those of higher belief stay.

Scale: only instances leave their document (start, end, kind, context), never texts. Values and patterns are
aggregated before they are joined; a context that very many instances share is summed on the map side, and
Spark splits its side of a join. Matching is linear in a text's length.

NULL and empty texts have no spans. Rows that repeat a ``doc_id`` are documents of their own. An empty table
gives no rows; other columns are dropped.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tollgate.llm.common import saved

KINDS = ["email", "ip", "card", "phone"]
#: What the known forms match, written so that no text takes more than linear time: runs are taken whole
#: (possessive), and a match begins where a run does, or where the match before it ended.
_LOCAL = "A-Za-z0-9._%+-"
FORMS = {
    "email": rf"(?:(?<![{_LOCAL}])|\G)[{_LOCAL}]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
_GAP = r"\x20\x09-\x0D"
#: A word with a digit or an at sign.
_WORD = rf"(?<![^{_GAP}])[^{_GAP}0-9@]*+[0-9@][^{_GAP}]*+"
#: A run of two or more neighbouring words with a digit and no at sign.
_DIGITS = rf"[^{_GAP}0-9@]*+[0-9][^{_GAP}@]*+(?![^{_GAP}])"
_RUN = rf"(?<![^{_GAP}]){_DIGITS}(?:[\x20\x09]++{_DIGITS})++"
#: Characters of a text around an instance that are searched for its neighbours.
_REACH = 48

#: A pattern counts from this confidence and number of different values on, an instance from this belief.
CONFIDENCE, SUPPORT, BELIEF, ROUNDS = 0.8, 3, 0.8, 3


def _let(value: Column, body) -> Column:
    return F.element_at(F.transform(F.array(value), body), 1)


def _found(text: Column, pattern: str) -> Column:
    """Leftmost matches in order as an array of (start, end, value), in code points."""
    kind = "array<struct<start:int,end:int,value:string>>"

    def placed(m: Column) -> Column:
        def with_gaps(gaps: Column) -> Column:
            zero = F.struct(F.lit(0).alias("at"), F.array().cast(kind).alias("out"))

            def step(acc: Column, i: Column) -> Column:
                start = acc["at"] + F.length(F.get(gaps, i))
                value = F.get(m, i)
                end = start + F.length(value)
                span = F.struct(start.alias("start"), end.alias("end"), value.alias("value"))
                return F.struct(end.alias("at"), F.concat(acc["out"], F.array(span)).alias("out"))

            numbers = F.sequence(F.lit(0), F.size(m) - 1)
            return F.aggregate(numbers, zero, step, lambda acc: acc["out"])

        return F.when(F.size(m) > 0, _let(F.split(text, pattern), with_gaps)).otherwise(F.array().cast(kind))

    return _let(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), placed)


def _holds(kind: str, value: Column) -> Column:
    """What a match must hold besides its form."""
    digits = F.regexp_replace(value, "[^0-9]", "")
    if kind == "ip":
        return value.rlike(r"^(0*(25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2})(\.|$)){4}$")
    if kind == "card":
        return F.length(digits).between(12, 19) & F.call_function("luhn_check", digits)
    if kind == "phone":
        return F.length(digits).between(9, 15)
    return F.lit(True)


def base_spans(text: Column) -> Column:
    """Known forms of a text by start, then kind: array of (start, kind number, end, value)."""

    def of_kind(number: int, kind: str) -> Column:
        spans = F.filter(_found(text, FORMS[kind]), lambda s: _holds(kind, s["value"]))
        return F.transform(spans, lambda s: F.struct(s["start"], F.lit(number).alias("kind"), s["end"], s["value"]))

    parts = [of_kind(number, kind) for number, kind in enumerate(KINDS)]
    return F.array_sort(F.concat(*parts))


def _plain(word: Column) -> Column:
    return F.regexp_replace(F.lower(word), "[0-9]", "0")


def _context(text: Column, start: Column, end: Column) -> tuple[Column, Column]:
    begin = F.greatest(start - _REACH, F.lit(0))
    before = F.substring(text, begin + 1, start - begin)
    after = F.substring(text, end + 1, F.lit(_REACH))
    left = F.regexp_extract(before, rf"([^{_GAP}]+)[{_GAP}]*$", 1)
    # What is glued to the instance, such as a full stop, is no word of its own.
    right = F.regexp_extract(after, rf"^[^{_GAP}]*[{_GAP}]+([^{_GAP}]+)", 1)
    return _plain(left), _plain(right)


def _cut(found: Column, ahead: str, whole: Column) -> Column:
    """Matches without the marks around them; ``ahead`` is what is cut before them."""
    return F.transform(
        found,
        lambda w: _let(
            F.length(w["value"]) - F.length(F.regexp_replace(w["value"], ahead, "")),
            lambda n: F.struct(
                (w["start"] + n).alias("start"),
                F.lit(None).cast("int").alias("kind"),
                F.greatest(w["start"] + n, w["end"] - F.length(F.regexp_extract(w["value"], r"[^\p{L}\p{N}]+$", 0))).alias("end"),
                F.regexp_replace(F.regexp_replace(w["value"], ahead, ""), r"[^\p{L}\p{N}]+$", "").alias("value"),
                whole.alias("whole"),
            ),
        ),
    )


def _runs(text: Column, base: Column) -> Column:
    """Runs of digit words; they end at a seed, whose characters are masked."""
    masked = F.aggregate(
        base, text, lambda acc, b: F.overlay(acc, F.repeat(F.lit("@"), b["end"] - b["start"]), b["start"] + 1, b["end"] - b["start"])
    )
    # An area code in brackets belongs to its run.
    return _let(masked, lambda m: _cut(_found(m, _RUN), r"^(?:(?!\([0-9]+\))[^\p{L}\p{N}+@])+", F.lit(True)))


def _instances(text: Column, base: Column, runs: Column) -> Column:
    """Seeds, runs of digit words, and other words with a digit or an at sign, with their contexts."""

    def meets(spans: Column, w: Column) -> Column:
        return F.exists(spans, lambda s: (s["start"] < w["end"]) & (w["start"] < s["end"]))

    words = _cut(_found(text, _WORD), r"^[^\p{L}\p{N}+@]+", F.lit(True))
    words = F.filter(words, lambda w: (w["end"] > w["start"]) & ~meets(base, w))
    words = F.transform(words, lambda w: w.withField("whole", ~meets(runs, w)))
    seeds = F.transform(base, lambda b: F.struct(b["start"], b["kind"], b["end"], b["value"], F.lit(True).alias("whole")))

    def described(s: Column) -> Column:
        left, right = _context(text, s["start"], s["end"])
        shape = F.regexp_replace(F.regexp_replace(s["value"], r"\p{L}+", "a"), "[0-9]+", "0")
        digits = F.regexp_count(s["value"], F.lit("[0-9]")).alias("digits")
        return F.struct(
            s["start"], s["end"], s["kind"], s["value"], left.alias("left"), right.alias("right"), shape.alias("shape"), digits, s["whole"]
        )

    return F.transform(F.concat(seeds, runs, words), described)


def _traits(of: DataFrame) -> DataFrame:
    """Add what of a value's form is compared: numbers of digits and of their groups, letters, at signs."""
    groups = F.length(F.regexp_replace("shape", "[^0]", ""))
    return of.withColumns({"groups": groups, "letters": F.col("shape").contains("a"), "at": F.col("shape").contains("@")})


_TRAITS = ["digits", "groups", "letters", "at"]


def _likeness(a: str, b: str) -> Column:
    """How alike two forms are, from 0 to 1; values of equal shape and number of digits have 1."""

    def part(name: str) -> Column:
        x, y = F.col(f"{a}.{name}"), F.col(f"{b}.{name}")
        return F.abs(x - y) / F.greatest(x, y, F.lit(1))

    differ = [F.when(F.col(f"{a}.{n}") == F.col(f"{b}.{n}"), 1.0).otherwise(rest) for n, rest in (("letters", 0.95), ("at", 0.5))]
    return (1 - part("digits")) * (1 - part("groups") / 4) * differ[0] * differ[1]


def discover(instances: DataFrame) -> DataFrame:
    """Find unseen identifiers among ``instances``: row, start, end, kind or NULL, value, left, right, shape, digits,
    whole (False for words of a run).

    Returns row, start, end, kind, belief of those found.
    """
    # Values, not occurrences, are evidence: one row per value, kind and context.
    facts = instances.groupBy("value", "shape", "digits", "left", "right", "kind").agg(F.max("whole").alias("whole"))
    facts = saved(facts, "pii-facts")
    known = _traits(facts.where("kind IS NOT NULL")).select("kind", F.struct(*_TRAITS).alias("trait"), F.lit(1.0).alias("sure")).distinct()
    # Few rows: combinations of small numbers.
    known = saved(known, "pii-shapes")
    found = None
    for _ in range(ROUNDS):
        named = facts
        if found is not None:
            named = facts.join(found.select("value", "shape", F.col("kind").alias("_new")), ["value", "shape"], "left")
            named = named.withColumn("kind", F.coalesce("kind", "_new")).drop("_new")
        # A context with its two words, or the word before alone.
        both = F.struct("left", "right")
        one = F.struct("left", F.lit("*").alias("right"))
        sides = named.where("left <> ''").withColumn("context", F.explode(F.array(both, one)))
        values = sides.where("whole OR kind IS NOT NULL").select("context", "kind", "value").distinct()
        # A value that has a kind anywhere is no evidence against it.
        tallied = values.groupBy("context", "kind").agg(F.count("*").alias("n"))
        total = tallied.groupBy("context").agg(F.sum("n").alias("all"))
        patterns = tallied.where("kind IS NOT NULL").join(total, "context")
        patterns = patterns.where(F.col("n") >= SUPPORT).withColumn("confidence", F.col("n") / F.col("all"))
        patterns = patterns.where(F.col("confidence") >= CONFIDENCE).select("context", "kind", "confidence")
        open_ = sides.where("kind IS NULL").select("value", "shape", "digits", "context").distinct()
        doubt = F.exp(F.sum(F.log(F.greatest(1 - F.col("confidence"), F.lit(1e-6)))))
        believed = open_.join(patterns, "context").groupBy("value", "shape", "digits", "kind").agg((1 - doubt).alias("belief"))
        believed = _traits(believed.where(F.col("belief") >= BELIEF)).withColumn("trait", F.struct(*_TRAITS))
        believed = saved(believed.select("value", "shape", "kind", "trait", "belief"), "pii-believed")
        # Forms are compared once each, not per value.
        forms = believed.select("kind", "trait").distinct().alias("f").join(F.broadcast(known.alias("k")), F.col("f.kind") == F.col("k.kind"))
        like = forms.groupBy("f.kind", "f.trait").agg(F.max(F.col("k.sure") * _likeness("f.trait", "k.trait")).alias("like"))
        believed = believed.join(F.broadcast(like), ["kind", "trait"]).withColumn("belief", F.col("belief") * F.col("like"))
        believed = believed.where(F.col("belief") >= BELIEF)
        best = believed.groupBy("value", "shape").agg(F.max(F.struct("belief", (-F.col("kind")).alias("_kind"), "trait")).alias("best"))
        best = best.select("value", "shape", (-F.col("best._kind")).alias("kind"), "best.belief", "best.trait")
        found = saved(best if found is None else found.unionByName(best), "pii-found")
        more = known.unionByName(found.select("kind", "trait", F.col("belief").alias("sure")))
        known = saved(more.groupBy("kind", "trait").agg(F.max("sure").alias("sure")), "pii-shapes")
    unseen = instances.where("kind IS NULL").drop("kind").join(found.drop("trait"), ["value", "shape"])
    return unseen.select("row", "start", "end", "kind", "belief")


def _listed(spans: Column) -> Column:
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ","
    )


def find_personal_data(docs: DataFrame) -> DataFrame:
    """Personal data of ``docs`` (doc_id, text).

    Returns doc_id, base and spans: arrays of (start, kind number, end) by start, of the known forms and of all.
    """
    # The text goes through generators, so that each step is computed once.
    text = docs.select("doc_id", F.explode(F.array(F.coalesce("text", F.lit("")))).alias("text"))
    marked = text.select("doc_id", "text", F.explode(F.array(F.when(F.col("text").rlike("[0-9@]"), base_spans(F.col("text"))))).alias("base"))
    runs = F.explode(F.array(F.when(F.col("base").isNotNull(), _runs(F.col("text"), F.col("base")))))
    marked = marked.select("doc_id", "text", "base", runs.alias("runs"))
    inside = F.when(F.col("base").isNotNull(), _instances(F.col("text"), F.col("base"), F.col("runs")))
    kept = F.transform(F.col("base"), lambda s: F.struct(s["start"], s["kind"], s["end"]))
    kept = F.coalesce(kept, F.array().cast("array<struct<start:int,kind:int,end:int>>"))
    rows = marked.select(F.monotonically_increasing_id().alias("row"), "doc_id", kept.alias("_kept"), inside.alias("inside"))
    rows = saved(rows.withColumnRenamed("_kept", "base"), "pii")
    instances = rows.select("row", F.inline("inside"))
    found = F.collect_list(F.struct("start", "kind", "end", "belief"))
    extra = discover(instances).groupBy("row").agg(found.alias("extra"))

    def rank(s: Column) -> Column:
        return F.struct(s["belief"], s["end"] - s["start"], -s["start"])

    def beaten(s: Column) -> Column:
        return F.exists("extra", lambda o: (o["start"] < s["end"]) & (s["start"] < o["end"]) & (rank(o) > rank(s)))

    left = F.filter("extra", lambda s: ~beaten(s))
    extra = extra.select("row", F.transform(left, lambda s: F.struct(s["start"], s["kind"], s["end"])).alias("extra"))
    joined = rows.drop("inside").join(extra, "row", "left")
    spans = F.when(F.col("extra").isNull(), F.col("base")).otherwise(F.array_sort(F.concat("base", "extra")))
    return joined.select("doc_id", "base", spans.alias("spans"))


def digest(found: DataFrame) -> DataFrame:
    """Counts per kind, a hash of the base spans, and all spans as text."""

    def count(number: int, kind: str) -> Column:
        return F.size(F.filter("base", lambda s: s["kind"] == number)).cast("long").alias(f"n_{kind}")

    counts = [count(number, kind) for number, kind in enumerate(KINDS)]
    return found.select(
        "doc_id", *counts, F.sha2(_listed(F.col("base")), 256).alias("base_sha256"), _listed(F.col("spans")).alias("spans")
    )
