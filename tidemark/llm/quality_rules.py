"""Quality rules whose limits adapt to each language and source.

Every text gets a few whole-number measures. Their distribution per language
and source is kept as a quantile sketch: counts over bins whose width is at most a
sixteenth of their value, so sketches merge by adding counts and give the same
quantiles however the rows were dealt. Limits come from a group's own sketch: its ninth
decile and three times that decile's distance from the median, so that up to a tenth of a group may be
junk without widening them. Beyond the limit a text may have a few counts, growing with the square root
of its size as chance does; in a spotless group that is all it may have. Groups with few documents use the
merged sketch of their language, or of all rows. Documents are then joined to the limits of their group.

All of it is DataFrame code; a text never leaves its row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import stored

SPACE = "[ \\t-\\r]"
SPACES = " \t\n\u000b\f\r"
WINDOW = 5
# Measures: whole numbers, larger is worse for the first three.
MEASURES = ("symbol_rate", "repeat_rate", "dup_line_rate", "word_length")
# Per rate what is counted, what it is counted in, and how many counts beyond the limit a text of the
# stated size or less may have; larger texts may have more, by the square root of their size.
SLACK = {
    "symbol_rate": ("n_symbols", "word_chars", 4, 500),
    "repeat_rate": ("n_repeat_words", "n_words", 10, 100),
    "dup_line_rate": ("n_dup_lines", "n_lines", 1, 10),
}
SPREAD = 3


def words_of(text: Column) -> Column:
    """The words of a text, in order; none for a null or blank one."""
    trimmed = F.btrim(text, F.lit(SPACES))
    return F.when(F.length(trimmed) > 0, F.split(trimmed, SPACE + "+")).otherwise(
        F.array().cast("array<string>")
    )


def _window_hashes(words: Column) -> Column:
    """A 64-bit hash of each run of five words, by its first word's index."""
    last = F.size(words) - WINDOW
    return F.transform(
        F.sequence(F.lit(0), last),
        lambda i: F.xxhash64(*[F.get(words, i + k) for k in range(WINDOW)]),
    )


def _covered(hashes: Column) -> Column:
    """Words inside windows whose hash occurs at least twice.

    Hashes are sorted with their positions, so that equal ones are neighbours;
    each repeated window then adds the words up to the next one's start.
    """
    ranked = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    ranked_last = F.size(hashes) - 1

    def starts(r: Column) -> Column:
        own = lambda j: F.get(r, j)["h"]
        twice = F.filter(
            F.sequence(F.lit(0), ranked_last),
            lambda j: F.coalesce(own(j) == own(j + 1), F.lit(False))
            | F.when(j > 0, F.coalesce(own(j) == own(j - 1), F.lit(False))).otherwise(False),
        )
        return F.sort_array(F.transform(twice, lambda j: F.get(r, j)["i"]))

    def total(at: Column) -> Column:
        gaps = F.transform(
            at, lambda p, k: F.least(F.lit(WINDOW), F.coalesce(F.get(at, k + 1) - p, F.lit(WINDOW)))
        )
        return F.aggregate(gaps, F.lit(0).cast("long"), lambda a, g: a + g)

    # One-element arrays bind a value once, so that it isn't computed again for each use.
    bound = F.transform(F.array(ranked), lambda r: total_of(starts(r), total))
    return F.get(bound, F.lit(0))


def total_of(at: Column, total) -> Column:
    return F.get(F.transform(F.array(at), total), F.lit(0))


def measured(docs: DataFrame, text_column: str = "text") -> DataFrame:
    """Add the base counts of each whole text as long columns.

    n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words and n_lines (those with
    a word). A null text has none of anything.
    """
    text = F.coalesce(F.col(text_column), F.lit(""))
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike("[^ \\t-\\r]"))
    step = docs.withColumn("__words", words_of(text)).withColumn("__lines", lines)
    step = step.withColumn(
        "__hashes",
        F.when(F.size("__words") > WINDOW, _window_hashes(F.col("__words"))).otherwise(
            F.array().cast("array<bigint>")
        ),
    )
    hashes = F.col("__hashes")
    repeated = F.size(F.array_distinct(hashes)) < F.size(hashes)
    return step.select(
        *docs.columns,
        F.size("__words").cast("long").alias("n_words"),
        F.length(F.array_join("__words", "")).cast("long").alias("word_chars"),
        F.regexp_count(text, F.lit("[#*$%&|<>]")).cast("long").alias("n_symbols"),
        (F.size("__lines") - F.size(F.array_distinct("__lines"))).cast("long").alias("n_dup_lines"),
        F.when(repeated, _covered(hashes)).otherwise(0).cast("long").alias("n_repeat_words"),
        F.size("__lines").cast("long").alias("n_lines"),
    )


def with_rates(counts: DataFrame) -> DataFrame:
    """Add the measures the fences are about, as whole numbers."""

    def per(scale: int, part: str, whole: str) -> Column:
        return F.expr(f"({scale}L * {part}) div greatest({whole}, 1L)")

    return (
        counts.withColumn("symbol_rate", per(1000, "n_symbols", "word_chars"))
        .withColumn("repeat_rate", per(1000, "n_repeat_words", "n_words"))
        .withColumn("dup_line_rate", per(1000, "n_dup_lines", "n_lines"))
        .withColumn("word_length", per(100, "word_chars", "n_words"))
    )


def sketch_bin(value: str) -> Column:
    """Bin of a whole number: itself below 32, then 16 bins for each doubling."""
    shift = f"(length(bin({value})) - 5)"
    return F.expr(
        f"case when {value} < 32 then cast({value} as int) else "
        f"cast(32 + ({shift} - 1) * 16 + (shiftright({value}, {shift}) - 16) as int) end"
    )


def bin_floor(at: str) -> Column:
    """The least value in a bin."""
    return F.expr(
        f"case when {at} < 32 then cast({at} as long) else "
        f"shiftleft(cast(16 + ({at} - 32) % 16 as long), cast((({at} - 32) div 16) + 1 as int)) end"
    )


def sketches(rows: DataFrame, keys: list[str], measures: tuple[str, ...] = MEASURES) -> DataFrame:
    """Per group and measure, how many rows fall in each bin."""
    pairs = ", ".join(f"'{m}', {m}" for m in measures)
    long = rows.select(*keys, F.expr(f"stack({len(measures)}, {pairs}) as (measure, value)"))
    return (
        long.withColumn("bin", sketch_bin("value"))
        .groupBy(*keys, "measure", "bin")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def merged(sketch: DataFrame, keys: list[str]) -> DataFrame:
    """Sketches of coarser groups: the sums of the finer ones' counts."""
    return sketch.groupBy(*keys, "measure", "bin").agg(F.sum("n").alias("n"))


def bin_last(at: str) -> Column:
    """The largest value in a bin."""
    return F.expr(
        f"case when {at} < 32 then cast({at} as long) else "
        f"shiftleft(cast(17 + ({at} - 32) % 16 as long), cast((({at} - 32) div 16) + 1 as int)) - 1 end"
    )


def quantiles(sketch: DataFrame, keys: list[str]) -> DataFrame:
    """n, q1, q2, q3, d9 and top of each group and measure: quartiles and ninth decile as floors of their bins, and the last of d9's bin."""
    group = [*keys, "measure"]
    upto = Window.partitionBy(*group).orderBy("bin")
    whole = Window.partitionBy(*group)
    ranked = (
        sketch.withColumn("__upto", F.sum("n").over(upto))
        .withColumn("__all", F.sum("n").over(whole))
        .withColumn("__floor", bin_floor("bin"))
        .withColumn("__last", bin_last("bin"))
    )
    at = lambda k, c="__floor": F.min(F.when(F.col("__upto") * 20 >= F.col("__all") * k, F.col(c)))
    return ranked.groupBy(*group).agg(
        F.max("__all").alias("n"), at(5).alias("q1"), at(10).alias("q2"), at(15).alias("q3"),
        at(18).alias("d9"), at(18, "__last").alias("top"),
    )


def fences(sketch: DataFrame, keys: list[str], spread: int = SPREAD) -> DataFrame:
    """One row per group with n and, for each measure, its low and high limit.

    The high limit of a rate is the ninth decile plus ``spread`` times its distance from the median. That of
    word_length is q3 plus four times q3 - q1, at least twice the median, and its low limit q1 less as much, at most
    half the median.
    """
    q = quantiles(sketch, keys)
    wide = 4 * (F.col("q3") - F.col("q1"))
    length = F.col("measure") == "word_length"
    high = F.when(length, F.greatest(F.col("q3") + wide, 2 * F.col("q2"))).otherwise(
        F.col("top") + spread * (F.col("d9") - F.col("q2")))
    low = F.when(length, F.least(F.col("q1") - wide, F.expr("q2 div 2"))).otherwise(-1)
    limits = q.withColumn("__high", high).withColumn("__low", low)
    pick = lambda m, c: F.max(F.when(F.col("measure") == m, F.col(c)))
    return limits.groupBy(*keys).agg(
        F.max("n").alias("__n"),
        *[pick(m, "__high").alias(f"max_{m}") for m in MEASURES],
        pick("word_length", "__low").alias("min_word_length"),
    )


def within(measure: str) -> Column:
    """Whether a row is within its group's limit of a measure, or beyond it by no more than its slack."""
    limit = F.coalesce(F.col(f"max_{measure}"), F.col(measure))
    fits = F.col(measure) <= limit
    if measure in SLACK:
        count, size, least, unit = SLACK[measure]
        beyond = 1000 * F.col(count) - limit * F.col(size)
        fits = fits | (beyond <= 1000.0 * least * F.greatest(F.lit(1.0), F.sqrt(F.col(size) / F.lit(float(unit)))))
    return fits


LIMITS = [f"max_{m}" for m in MEASURES] + ["min_word_length"]


def adaptive_limits(rates: DataFrame, keys: list[str], min_docs: int = 50) -> DataFrame:
    """Limits for every group of ``keys`` (language, source), null keys included.

    A group of fewer than ``min_docs`` rows takes its language's limits, a language
    of fewer those of all rows. Rates are of rows that the base rules let pass: what they reject
    must not widen the fences.
    """
    lang = keys[0]
    fine = stored(sketches(rates, keys), "sketches")
    by_group = fences(fine, keys)
    by_lang = fences(merged(fine, [lang]), [lang])
    names = ["__n", *LIMITS]
    overall = fences(merged(fine.withColumn("__all", F.lit(1)), ["__all"]), ["__all"])
    coarse = by_lang.select(
        F.col(lang).alias("__lang"), *[F.col(c).alias(f"lang_{c}") for c in names]
    )
    everything = overall.select(*[F.col(c).alias(f"all_{c}") for c in LIMITS])
    joined = by_group.join(coarse, F.col(lang).eqNullSafe(F.col("__lang")), "left").join(
        F.broadcast(everything), F.lit(True), "left"  # one row
    )

    def chosen(c: str) -> Column:
        return (
            F.when(F.col("__n") >= min_docs, F.col(c))
            .when(F.col("lang___n") >= min_docs, F.col(f"lang_{c}"))
            .otherwise(F.col(f"all_{c}"))
            .alias(c)
        )

    return joined.select(*keys, *[chosen(c) for c in LIMITS])


def with_limits(rows: DataFrame, limits: DataFrame, keys: list[str], salts: int = 32) -> DataFrame:
    """Join rows to their group's limits; a huge group's rows are spread over ``salts`` keys."""
    salted = rows.withColumn("__salt", F.pmod(F.xxhash64("doc_id", "n_words"), F.lit(salts)).cast("int"))
    names = {k: f"__key_{k}" for k in keys}
    copies = limits.withColumnsRenamed(names).withColumn(
        "__copy", F.explode(F.sequence(F.lit(0), F.lit(salts - 1)))
    )
    on = F.col("__salt") == F.col("__copy")
    for k, other in names.items():
        on = on & F.col(k).eqNullSafe(F.col(other))
    return salted.join(copies, on, "left").drop("__salt", "__copy", *names.values())


def quality_rules(
    docs: DataFrame,
    min_words: int = 10,
    max_repeat_percent: int = 20,
    min_docs: int = 50,
) -> DataFrame:
    """Counts, base verdict, measures, limits and verdict of every document.

    ``docs`` has doc_id, text, lang and source; other columns are not read. A null or
    empty text has no words and fails the base rules; null languages and sources are groups
    of their own; repeated rows are judged as often as they occur; an empty table gives
    no rows. ``kept`` is false for what the base rules fail, else whether every measure is
    within the limits, and their slack, of the document's language and source.
    """
    counts = measured(docs.select("doc_id", "text", "lang", "source")).drop("text")
    failed = (F.col("n_words") < min_words) | (
        F.col("n_repeat_words") * 100 > F.col("n_words") * max_repeat_percent
    )
    rates = stored(with_rates(counts).withColumn("base_failed", failed), "rates")
    keys = ["lang", "source"]
    limits = adaptive_limits(rates.filter(~F.col("base_failed")), keys, min_docs)
    judged = with_limits(rates, stored(limits, "limits"), keys)
    fits = F.col("word_length") >= F.coalesce(F.col("min_word_length"), F.lit(-1))
    for m in MEASURES:
        fits = fits & within(m)
    return judged.withColumn("kept", ~F.col("base_failed") & fits)
