"""Quality rules: counts over words and lines, and the distance of a document from language references.

A document is compared with references by the Jensen-Shannon distance of two histograms, one of character
classes and one of common words.  A reference holds the summed histograms of all documents of one language.
A document of a language that ``COMMON_WORDS`` does not name is compared with the reference of its own language
too, whose common words are counted from the table; one without a language is not judged by histograms.
Everything is a column expression; nothing is shuffled but one row of sums per task and language, and the word
counts of languages without fixed words.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from shelfcast.operators.joins import attach
from shelfcast.shared import written_table

SPACE = r"[\x20\x09-\x0D]"
#: Frequent function words by language.
COMMON_WORDS = {
    "en": ("the", "of", "and", "to", "in", "is"),
    "de": ("der", "die", "und", "den", "das", "zu"),
    "fr": ("le", "la", "les", "et", "des", "en"),
    "es": ("el", "de", "que", "y", "los", "las"),
}
#: Common words taken from the table for each other language, as many as the fixed ones have.
OWN_WORDS = 6


@dataclass(frozen=True)
class QualityRules:
    """Parameters of the verdict.

    A document is rejected when its nearest reference is farther than ``max_class_distance`` by character
    classes, or farther than ``max_word_distance`` by common words.  Distances lie in 0 to 1.  Documents with
    fewer characters (words) than the guard are not judged by that histogram, as short ones vary too much.
    """

    min_words: int = 20
    max_repeat_percent: int = 30
    min_class_chars: int = 200
    max_class_distance: float = 0.26
    min_histogram_words: int = 150
    max_word_distance: float = 0.26
    common_words: dict[str, Sequence[str]] = field(default_factory=lambda: dict(COMMON_WORDS))

    def vocabulary(self) -> list[str]:
        return sorted({w for words in self.common_words.values() for w in words})


def _characters(text: Column, others: str) -> Column:
    """Number of characters left when those that match ``others`` are taken out."""
    return F.length(F.regexp_replace(text, others, "")).cast("long")


def _total(counts: str) -> Column:
    return F.aggregate(counts, F.lit(0).cast("long"), lambda a, n: a + n)


def _repeated_words(words: str) -> dict[str, Column]:
    """Columns, step by step, that lead to the number of words inside 8-word windows that occur twice or more."""
    count = F.size("_hashes")
    last = F.size("_sorted") - 1

    def twin(x: Column, j: Column) -> Column:
        before = F.when(j > 0, F.col("_sorted")[j - 1]["h"] == x["h"]).otherwise(False)
        after = F.when(j < last, F.col("_sorted")[j + 1]["h"] == x["h"]).otherwise(False)
        return before | after

    windows = F.when(count >= 8, F.transform(F.sequence(F.lit(1), count - 7), lambda i: F.xxhash64(F.slice("_hashes", i, 8))))
    numbered = F.transform("_windows", lambda h, i: F.struct(h.alias("h"), i.alias("i")))
    gaps = F.transform("_places", lambda p, j: F.least(F.lit(8), F.coalesce(F.get("_places", j + 1) - p, F.lit(8))))
    return {
        "_hashes": F.transform(words, lambda w: F.xxhash64(w)),
        "_windows": windows,
        "_sorted": F.when(F.size(F.array_distinct("_windows")) < F.size("_windows"), F.array_sort(numbered)),
        "_places": F.when(
            F.col("_sorted").isNotNull(), F.array_sort(F.transform(F.filter("_sorted", twin), lambda x: x["i"]))
        ),
        "_n_repeat_words": F.when(F.size("_places") > 0, F.aggregate(gaps, F.lit(0), lambda a, g: a + g))
        .otherwise(0).cast("long"),
    }


def further_words(docs: DataFrame, rules: QualityRules, text: str = "text", lang: str = "lang") -> DataFrame | None:
    """``_lang`` and ``_own``: for each language outside ``rules`` its words in most documents, parted by blanks.

    ``OWN_WORDS`` words a language, in lower case.  ``None`` if every document is of a language of ``rules`` or
    of none; then the texts are not read.
    """
    rows = docs.select(F.col(f"`{lang}`").alias("_lang"), F.col(f"`{text}`").alias("_text"))
    rows = rows.filter(F.col("_lang").isNotNull() & ~F.col("_lang").isin(list(rules.common_words)))
    if rows.agg(F.count(F.lit(1))).first()[0] == 0:
        return None
    words = F.array_distinct(F.split(F.lower("_text"), SPACE + "+"))
    counts = rows.select("_lang", F.explode(words).alias("word")).filter("word <> ''")
    counts = counts.groupBy("_lang", "word").agg(F.count(F.lit(1)).alias("n"))
    place = F.row_number().over(W.partitionBy("_lang").orderBy(F.col("n").desc(), "word"))
    first = counts.withColumn("place", place).filter(F.col("place") <= OWN_WORDS)
    own = first.groupBy("_lang").agg(F.array_join(F.array_sort(F.collect_list("word")), " ").alias("_own"))
    return written_table(own, "further-words")


def measure(
    docs: DataFrame, rules: QualityRules | None = None, text: str = "text", lang: str = "lang", words: DataFrame | None = None
) -> DataFrame:
    """The rows of ``docs`` as struct ``_row`` beside a struct ``_counts`` of numbers.

    ``_counts`` has ``n_words word_chars n_symbols n_dup_lines n_repeat_words`` and two histograms: ``classes``
    (upper case, digits, marks, symbols, line ends and tabs, bytes beyond the first of a character, the rest,
    which is lower case and blanks) and ``common`` (a count per common word in lower case, upper case
    or capitalised, then the other words).  With ``words`` of :func:`further_words` there is ``own`` too, a count
    per common word of a language outside ``rules``, else null.  A null text counts as an empty one.
    """
    rules = rules or QualityRules()
    vocabulary = rules.vocabulary()
    written = sorted({v for w in vocabulary for v in (w, w.capitalize(), w.upper())})
    body = F.coalesce(F.col("_text"), F.lit(""))
    step = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"), F.col(f"`{text}`").alias("_text"))
    if words is not None:
        step = attach(step.withColumn("_lang", F.col(f"_row.`{lang}`")), words, ["_lang"])
        step = step.withColumn("_own", F.split("_own", " "))
    step = step.withColumns({
        "_words": F.array_remove(F.split(body, SPACE + "+"), ""),
        "_signs": F.regexp_replace(body, r"[a-z \x7F-\x{10FFFF}]+", ""),
        "_size": F.octet_length(body).cast("long"), "_length": F.length(body).cast("long"),
    })
    step = step.withColumns({
        "_hits": F.transform(F.filter("_words", lambda w: w.isin(written)), lambda w: F.lower(w)),
        "_n_words": F.size("_words").cast("long"), "_word_chars": F.length(F.array_join("_words", "")).cast("long"),
        "_upper": _characters(F.col("_signs"), "[^A-Z]+"), "_digit": _characters(F.col("_signs"), "[^0-9]+"),
        "_mark": _characters(F.col("_signs"), r"[^.,;:!?'\"()-]+"),
        "_ends": _characters(F.col("_signs"), r"[^\x00-\x1F]+"), "_rest": F.length("_signs").cast("long"),
        "_n_symbols": _characters(F.col("_signs"), "[^#*$%&|<>]+"),
        "_lines": F.filter(F.split(body, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]")),
    })
    for name, column in _repeated_words("_words").items():
        step = step.withColumn(name, column)
    counted = F.transform(
        F.array(*map(F.lit, vocabulary)), lambda v: F.size(F.filter("_hits", lambda w: w == v)).cast("long")
    )
    wide = F.col("_size") - F.col("_length")
    own = []
    if words is not None:
        found = F.filter(F.transform("_words", lambda w: F.lower(w)), lambda w: F.array_contains("_own", w))
        step = step.withColumn("_found", F.when(F.col("_own").isNotNull(), found))
        each = [F.size(F.filter("_found", lambda w, i=i: w == F.get("_own", F.lit(i)))).cast("long") for i in range(OWN_WORDS)]
        own = [F.when(F.col("_own").isNotNull(), F.array(*each)).alias("own")]
    return step.select("_row", F.struct(
        F.col("_n_words").alias("n_words"), F.col("_word_chars").alias("word_chars"), F.col("_n_symbols").alias("n_symbols"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        F.col("_n_repeat_words").alias("n_repeat_words"),
        F.array(
            "_upper", "_digit", "_mark", F.col("_rest") - F.col("_upper") - F.col("_digit") - F.col("_mark") - F.col("_ends"),
            "_ends", wide, F.col("_length") - F.col("_rest"),
        ).alias("classes"),
        F.concat(counted, F.array(F.col("_n_words") - F.size("_hits"))).alias("common"), *own,
    ).alias("_counts"))


def jensen_shannon(counts: Column, size: Column, reference: Sequence[int]) -> Column:
    """Square root of the Jensen-Shannon divergence (base 2) between a histogram, which sums to ``size``, and a
    reference; 1 if either is empty.  ``size`` is read for every bin, so it should be a plain column."""
    total = sum(reference)
    if total == 0:
        return F.lit(1.0)
    return _distance(counts, size, F.array(*[F.lit(n / total) for n in reference]))


def _distance(counts: Column, size: Column, shares: Column) -> Column:
    """As :func:`jensen_shannon`, with the reference as an array of shares."""
    def term(p: Column, q: Column) -> Column:
        return F.when(p > 0, p * F.log2(2 * p / (p + q))).otherwise(0.0)

    terms = F.zip_with(
        F.transform(counts, lambda n: n / size), shares, lambda p, q: (term(p, q) + term(q, p)) / 2
    )
    summed = F.aggregate(terms, F.lit(0.0), lambda a, x: a + x)
    return F.when(size == 0, 1.0).otherwise(F.sqrt(F.greatest(summed, F.lit(0.0))))


Reference = tuple[list[int], list[int]]


def language_references(measured: DataFrame, rules: QualityRules, lang: str) -> list[Reference]:
    """Summed histograms of the languages of ``rules`` that occur, in order of the language.

    One row per language of ``rules`` comes to the driver, however many documents or languages there are.
    """
    bins = {"classes": 7, "common": len(rules.vocabulary()) + 1}
    own = measured.select(F.col(f"_row.`{lang}`").alias("lang"), "_counts.classes", "_counts.common")
    sums = own.filter(F.col("lang").isin(list(rules.common_words))).groupBy("lang").agg(
        *[F.sum(F.col(c)[i]).alias(f"{c}{i}") for c, n in bins.items() for i in range(n)]
    )
    return [
        tuple([r[f"{c}{i}"] for i in range(n)] for c, n in bins.items())
        for r in sorted(sums.collect(), key=lambda r: r["lang"])
    ]


def _own_histogram(words: Column, own: Column) -> Column:
    """The histogram over the common words of the document's own language, then the other words."""
    return F.concat(own, F.array(words - _total(own)))


def further_references(measured: DataFrame, lang: str = "lang") -> DataFrame:
    """Per language outside the rules ``_lang`` and its summed histograms, a column per bin; any number of languages."""
    own = measured.filter(F.col("_counts.own").isNotNull()).select(
        F.col(f"_row.`{lang}`").alias("_lang"), F.col("_counts.classes").alias("classes"),
        _own_histogram(F.col("_counts.n_words"), F.col("_counts.own")).alias("words"),
    )
    bins = {"classes": 7, "words": OWN_WORDS + 1}
    sums = own.groupBy("_lang").agg(*[F.sum(F.col(c)[i]).alias(f"_{c}{i}") for c, n in bins.items() for i in range(n)])
    return written_table(sums, "further-references")


def verdict(
    measured: DataFrame, references: Sequence[Reference], rules: QualityRules, lang: str = "lang",
    further: DataFrame | None = None,
) -> DataFrame:
    """Add ``_rules``: the counts, ``base_failed``, both distances to the nearest reference, and ``kept``.

    Documents of languages outside the rules have the row of their language in ``further`` as one more reference;
    those whose language has no reference are judged by the base rules only.
    """
    step = measured.withColumns({
        "_chars": _total("_counts.classes"), "_bins": _total("_counts.common"),
        "_classes": F.col("_counts.classes"), "_common": F.col("_counts.common"),
    })

    has_reference = F.coalesce(F.col(f"_row.`{lang}`").isin(list(rules.common_words)), F.lit(False))
    own: list[Column] = []
    if further is not None:
        step = attach(step.withColumn("_lang", F.col(f"_row.`{lang}`")), further, ["_lang"])
        bins = {kind: [c for c in further.columns if c.startswith(f"_{kind}")] for kind in ("classes", "words")}
        total = {kind: sum((F.col(c) for c in names[1:]), F.col(names[0])) for kind, names in bins.items()}
        step = step.withColumns({
            **{f"_{kind}_total": total[kind] for kind in bins},
            "_own_words": _own_histogram(F.col("_counts.n_words"), F.col("_counts.own")),
        })
        shares = {k: F.when(F.col(f"_{k}_total") > 0, F.array(*[F.col(c) / F.col(f"_{k}_total") for c in bins[k]])) for k in bins}
        step = step.withColumns({f"_{kind}_shares": shares[kind] for kind in bins})
        own = [
            F.when(F.col(f"_{kind}_shares").isNotNull(), _distance(F.col(counts), F.col(size), F.col(f"_{kind}_shares")))
            for kind, counts, size in (("classes", "_classes", "_chars"), ("words", "_own_words", "_bins"))
        ]
        has_reference = has_reference | F.col("_classes_shares").isNotNull()

    def nearest(counts: str, size: str, which: int) -> Column:
        found = [jensen_shannon(F.col(counts), F.col(size), r[which]) for r in references] + own[which : which + 1]
        return F.lit(None).cast("double") if not found else found[0] if len(found) == 1 else F.least(*found)

    words = F.col("_counts.n_words")
    step = step.withColumns({
        "_class_distance": nearest("_classes", "_chars", 0), "_word_distance": nearest("_common", "_bins", 1),
        "_failed": (words < rules.min_words) | (100 * F.col("_counts.n_repeat_words") > rules.max_repeat_percent * words),
    })
    far = (
        (F.col("_chars") >= rules.min_class_chars) & (F.col("_class_distance") > rules.max_class_distance)
    ) | ((words >= rules.min_histogram_words) & (F.col("_word_distance") > rules.max_word_distance))
    counts = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    return step.select("_row", F.struct(
        *[F.col(f"_counts.{c}") for c in counts], F.col("_failed").alias("base_failed"),
        F.col("_class_distance").alias("class_distance"), F.col("_word_distance").alias("word_distance"),
        (~F.col("_failed") & ~(has_reference & F.coalesce(far, F.lit(False)))).alias("kept"),
    ).alias("_rules"))


def judge(docs: DataFrame, rules: QualityRules | None = None, text: str = "text", lang: str = "lang") -> DataFrame:
    """Every row of ``docs`` as struct ``_row`` with its counts, distances and verdict in a struct ``_rules``.

    A null or empty text has no words and fails the base rules.  A language outside the rules is compared with
    their references and with its own; a null language has none, so distances are given but only the base rules
    decide.  Without any reference (empty table) distances are null.  Repeated rows are judged alike; other columns
    are passed through, whatever their names.
    """
    rules = rules or QualityRules()
    words = further_words(docs, rules, text, lang)
    measured = measure(docs, rules, text, lang, words)
    further = None if words is None else further_references(measured, lang)
    return verdict(measured, language_references(measured, rules, lang), rules, lang, further)


def keep_good(docs: DataFrame, rules: QualityRules | None = None) -> DataFrame:
    """The rows of ``docs`` that the rules keep, unchanged; odd rows as in :func:`judge`.

    Rows are measured once and stored with their counts; references and verdicts are made from the stored counts.
    """
    rules = rules or QualityRules()
    words = further_words(docs, rules)
    measured = written_table(measure(docs, rules, words=words), "measured", compression="zstd")  # whole texts among them
    further = None if words is None else further_references(measured)
    judged = verdict(measured, language_references(measured, rules, "lang"), rules, further=further)
    # a filter is not pushed below a column that depends on the row's place; pushed down, the condition would
    # hold all the distances once for each time it names them
    placed = judged.withColumn("_place", F.monotonically_increasing_id())
    return placed.filter(F.col("_rules.kept") & (F.col("_place") >= 0)).select("_row.*")
