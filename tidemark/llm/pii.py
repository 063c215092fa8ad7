"""Personal data: known formats, and boosted trees over generous candidates for the rest.

Known formats are found by patterns and checks. Besides, high-recall generators propose spans
that may overlap: address-like strings, runs of digits and separators, dotted or coloned
groups, long numbers. Gradient-boosted trees judge them by format and context: lengths,
digit groups, signs, neighbours, words of contact, payment, networks or references before them.

What the trees learn from: right are candidates that coincide with a checked known format, and known spans
rewritten in a form that the patterns miss (at-forms, local numbers, mistyped check digits, colon
groups); wrong are candidates of a checked harmless shape (dates, times, prices, versions, references, parts of
longer words), in the texts or written in place of a known span. Other candidates are in neither class. The checks of
the formats (check digits, ranges) are no features. The fit uses a bounded sample per generator and class; then all
labelled candidates of the corpus are scored and a threshold for each generator is set from their counts by score.
Candidates above it that touch no known span are merged into spans of their own.

All of it is DataFrame code; the trees are those of Spark's own library.
"""

from __future__ import annotations

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import stored
from tidemark.llm.spans import LABELLED, bind, labelled, listed, markable, no_spans, spans_of

# The formats. Groups that repeat never give back what they took, which changes no match
# and keeps long runs from exhausting the stack; a match starts where a run does, or where the last one ended.
EMAIL = "(?:\\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\\.[A-Za-z0-9-]++)++"
IP = "(?:\\G|(?<![0-9]))[0-9]++\\.[0-9]++\\.[0-9]++\\.[0-9]++"
CARD = "[0-9](?:[\\x20-]?[0-9])++"
PHONE = "\\+[0-9][\\x20().0-9-]+[0-9]"
BYTE = "0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]{1,2})"
KINDS = ("email", "ip", "card", "phone")

GENERATORS = (
    "(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++\\x20?(?:@|\\(at\\)|\\[at\\])\\x20?[A-Za-z0-9.-]+",
    "[+(]?[0-9][0-9().\\x20/:-]{5,}[0-9]",
    "(?<![0-9A-Za-z:.])[0-9A-Fa-f]{1,4}(?:(?:::?|\\.)[0-9A-Fa-f]{1,4}){2,7}(?![0-9A-Za-z])",
    "[0-9]{6,}",
)
CONTEXT = 24  # characters before a candidate that are looked at
WORDS_BEFORE = (
    "(?i)(phone|tel|call|fax|mobile|cell)", "(?i)(mail|contact|write)", "(?i)(card|visa|credit|account|iban)",
    "(?i)(ip|host|server|address|network)", "(?i)(order|invoice|ticket|ref|number|item|page|version|no\\.|nr\\.|#)",
    "(?:[$€£]|(?i:usd|eur|gbp|costs?|price))\\x20?$",
)
SAMPLE_ROWS = 600  # per generator, class and origin: at most 9,600 in all, of which the trees are fitted

DAY = "(?:[0-9]{4}[-/.][0-9]{1,2}[-/.][0-9]{1,2}|[0-9]{1,2}[-/.][0-9]{1,2}[-/.](?:[0-9]{4}|[0-9]{2}))"
CLOCK = "[0-9]{1,2}:[0-9]{2}(?::[0-9]{2})?"
# Harmless shapes: of the whole candidate, and of what stands before it.
HARMLESS = (
    f"^(?:{DAY}(?:\\x20{CLOCK})?|{CLOCK}|(?:19|20)[0-9]{{2}}[-/\\x20](?:19|20)?[0-9]{{2}})$",  # dates, times, spans of years
    "^[0-9]{1,9}\\.[0-9]{2}$",  # prices
    "^[0-9]+\\.[0-9]+\\.[0-9]+$",  # versions
    "^[0-9]+\\x20?@",  # so many at a price
)
HARMLESS_BEFORE = "(?:[$€£#]|(?i:(?<![a-z])(?:order|invoice|ticket|ref|reference|item|page|version|no\\.|nr\\.)))[\\x20:#]*$"


def digits_of(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """Whether the check digit is right."""
    doubled = F.transform(
        F.split(F.reverse(digits), ""),
        lambda c, i: bind(c.cast("int") * F.when(i % 2 == 1, 2).otherwise(1), lambda d: F.when(d > 9, d - 9).otherwise(d)),
    )
    return F.aggregate(doubled, F.lit(0), lambda a, d: a + d) % 10 == 0


def base_spans(text: Column) -> list[Column]:
    """Matches of each known format that pass its checks; a failed match is not tried again."""
    size = lambda s: F.length(digits_of(s["text"]))
    return [
        spans_of(text, EMAIL),
        F.filter(spans_of(text, IP), lambda s: s["text"].rlike(f"^{BYTE}\\.{BYTE}\\.{BYTE}\\.{BYTE}$")),
        F.filter(spans_of(text, CARD), lambda s: size(s).between(13, 19) & luhn(digits_of(s["text"]))),
        F.filter(spans_of(text, PHONE), lambda s: size(s).between(9, 15)),
    ]


def _before(text: Column, s: Column) -> Column:
    return F.substring(text, F.greatest(s["start"] - CONTEXT + 1, F.lit(1)), F.least(s["start"], F.lit(CONTEXT)))


def _harmless(text: Column, s: Column) -> Column:
    """Whether a candidate has a checked harmless shape, or is part of a longer word or number.

    So has a number as long as a card's that fails the check and has no word of payment before it.
    """
    before, after = _before(text, s), F.substring(text, s["end"] + 1, F.lit(1))
    digits = digits_of(s["text"])
    failing = F.when(s["text"].rlike("^[0-9\\x20-]+$") & F.length(digits).between(13, 19), ~luhn(digits) & ~before.rlike(WORDS_BEFORE[2])).otherwise(False)
    shape = before.rlike(HARMLESS_BEFORE) | before.rlike("[A-Za-z0-9]$") | after.rlike("^[A-Za-z0-9]") | failing
    for pattern in HARMLESS:
        shape = shape | s["text"].rlike(pattern)
    return shape


def _features(text: Column, s: Column, generator: int) -> Column:
    """Numbers that describe a candidate and its surroundings."""
    own = s["text"]
    count = lambda pattern: F.regexp_count(own, F.lit(pattern)).cast("double")
    flag = lambda x: F.coalesce(x, F.lit(False)).cast("double")
    before, after = _before(text, s), F.substring(text, s["end"] + 1, F.lit(1))
    groups = F.regexp_extract_all(own, F.lit("[0-9]+"), F.lit(0))
    return F.array(
        *[F.lit(float(generator == k)) for k in range(len(GENERATORS))],
        F.length(own).cast("double"), count("[0-9]"), count("[A-Za-z]"), count("\\."), count("-"), count("\\x20"),
        count("@"), count("[()]"), count("[:/]"), flag(own.startswith("+")), F.size(groups).cast("double"),
        F.coalesce(F.array_max(F.transform(groups, lambda g: F.length(g))), F.lit(0)).cast("double"),
        *[F.coalesce(F.length(F.get(groups, at)), F.lit(0)).cast("double") for at in (F.lit(0), F.lit(1), F.size(groups) - 1)],
        flag(before.rlike("[A-Za-z]$")), flag(before.rlike("[\\x20\\n]$")), flag(F.length(before) == 0),
        flag(after.rlike("[A-Za-z0-9]")), flag(after.rlike("[\\x20\\n.,;]")),
        *[flag(before.rlike(w)) for w in WORDS_BEFORE],
    )


def _candidates(text: Column, base: Column) -> Column:
    """Candidates of all generators: known if half of it or more is a checked span."""
    def of(generator: int) -> Column:
        def row(s: Column) -> Column:
            shared = lambda b: F.least(b["end"], s["end"]) - F.greatest(b["start"], s["start"])
            return F.struct(
                F.lit(generator).alias("generator"), s["start"].alias("start"), s["end"].alias("end"),
                _features(text, s, generator).alias("features"),
                F.exists(base, lambda b: shared(b) * 2 >= s["end"] - s["start"]).alias("known"),
                F.exists(base, lambda b: shared(b) > 0).alias("touches"),
                _harmless(text, s).alias("harmless"),
            )

        return F.transform(spans_of(text, GENERATORS[generator]), row)

    return F.concat(*[of(g) for g in range(len(GENERATORS))])


def _seeds(text: Column, base: Column) -> Column:
    """Known spans with what stands around them."""
    return F.transform(base, lambda s: F.struct(
        s["rank"].alias("rank"), s["start"].alias("start"), _before(text, s).alias("before"),
        F.substring(text, s["start"] + 1, s["end"] - s["start"]).alias("own"),
        F.substring(text, s["end"] + 1, F.lit(1)).alias("after"),
    ))


def _right_forms(own: str, rank: str) -> str:
    """SQL for the forms that a known span of a kind may be rewritten in; the hash of the span picks digits and signs."""
    six = f"regexp_replace(md5({own}), '(.{{4}})(?=.)', '$1:')"
    drawn = f"translate(md5({own}), 'abcdef', '123456')"
    ten = f"right(concat({drawn}, if({rank} = 3, regexp_replace({own}, '[^0-9]', ''), '')), 10)"
    local = [f"concat('(', left({ten}, 3), ') ', substr({ten}, 4, 3), '-', right({ten}, 4))"] + [
        f"concat(left({ten}, 3), '{c}', substr({ten}, 4, 3), '{c}', right({ten}, 4))" for c in "-. "
    ]
    # A card's last digit raised by one fails its check.
    plain = f"regexp_replace({own}, '[^0-9]', '')"
    wrong = f"concat(left({plain}, length({plain}) - 1), (cast(right({plain}, 1) as int) + 1) % 10)"
    networks = [six, f"concat('fe80::', left({six}, 19))", f"concat(left({six}, 9), '::', right({six}, 4))"]
    of_kind = {
        0: [f"replace({own}, '@', '{at}')" for at in (" (at) ", " [at] ", "(at)", "[at]", " @ ")],
        1: networks,
        2: [wrong, f"regexp_replace({wrong}, '(.{{4}})(?=.)', '$1-')", f"regexp_replace({wrong}, '(.{{4}})(?=.)', '$1 ')"],
        3: [*local, f"substr({own}, 2)"],
    }
    cases = " ".join(f"when {k} then array({', '.join(forms)})" for k, forms in of_kind.items())
    return f"concat(case {rank} {cases} end, array({', '.join([*networks[:1], *local[:2]])}))"


def _wrong_forms(own: str) -> str:
    """SQL for harmless shapes as (what stands before, shape)."""
    drawn = f"translate(md5({own}), 'abcdef', '123456')"
    digits = lambda at, n: f"substr({drawn}, {at}, {n})"
    upto = lambda at, most: f"lpad(cast(1 + cast({digits(at, 4)} as int) % {most} as string), 2, '0')"
    year = f"cast(1950 + cast({digits(1, 4)} as int) % 90 as string)"
    shapes = [
        (" on ", f"concat_ws('-', {year}, {upto(5, 12)}, {upto(9, 28)})"), (" on ", f"concat_ws('/', {upto(5, 28)}, {upto(9, 12)}, {year})"),
        (" on ", f"concat_ws('.', {upto(5, 28)}, {upto(9, 12)}, {year})"), (" since ", f"concat({year}, '-', cast(1 + cast({year} as int) as string))"),
        (" at ", f"concat({year}, '-', {upto(5, 12)}, '-', {upto(9, 28)}, ' ', {upto(13, 23)}, ':', {upto(17, 59)})"),
        (" at ", f"concat_ws(':', {upto(5, 23)}, {upto(9, 59)}, {upto(13, 59)})"),
        (" costs $", f"concat({digits(1, 5)}, '.', {digits(9, 2)})"), (" sold ", f"concat({digits(1, 5)}, '.', {digits(9, 2)})"),
        (" version ", f"concat_ws('.', {digits(1, 1)}, {digits(2, 2)}, {digits(4, 2)})"),
        (" order ", digits(1, 7)), (" order ", digits(1, 10)), (" invoice no. ", digits(1, 12)), (" ticket #", digits(1, 8)), (" ref ", digits(1, 16)),
        (" total ", digits(1, 6)), (" ", digits(1, 8)), (" ", digits(1, 11)), (" ", digits(1, 16)), (" hash a7f", digits(1, 14)), (" sold ", f"concat({digits(1, 2)}, ' @ ', {digits(3, 2)})"),
    ]
    return "array(" + ", ".join(f"named_struct('before', '{b}', 'own', {own_form})" for b, own_form in shapes) + ")"


def _altered(seeds: DataFrame) -> DataFrame:
    """Labelled candidates from each known span rewritten once as a right form and once as a wrong one."""
    # Within lambdas the many forms are evaluated as they are; as generated code they are too long to compile.
    pick = lambda forms: (
        f"get(transform(array(own), o -> get(transform(array({forms}), f -> get(f, cast(pmod(xxhash64(o, start, doc_id), size(f)) as int))), 0)), 0)"
    )
    wrong = pick(_wrong_forms("o"))
    # A mistyped card is one only after a word of payment.
    paying = f"concat(left(before, 8), {pick("array(' card ', ' visa ', ' account ', ' card number: ')")})"
    lead = f"if(rank = 2 and not before rlike '{WORDS_BEFORE[2]}', {paying}, before)"
    two = seeds.select(
        "doc_id", "start",
        F.expr(f"stack(2, 1.0D, {lead}, {pick(_right_forms('o', 'rank'))}, after, "
               f"0.0D, concat(left(before, 8), {wrong}.before), {wrong}.own, after) as (label, before, own, after)"),
    )
    text, first = F.col("__text"), F.length("before")
    last = first + F.length("own")
    inside = lambda c: 2 * (F.least(c["end"], last) - F.greatest(c["start"], first)) >= F.greatest(last - first, c["end"] - c["start"])
    snippets = two.withColumn("__text", F.concat("before", "own", "after"))
    made = snippets.withColumn("c", F.explode(F.filter(_candidates(text, F.array().cast(f"array<{LABELLED}>")), inside)))
    return made.select("doc_id", "start", "c.generator", "c.features", "label", F.lit(1).alias("origin"))


def _fitted(labelled_rows: DataFrame, most: int):
    """Trees and a threshold per generator, or None where there is nothing to tell apart.

    The sample is taken by a hash of ids, places and features, and is fitted in one order in one small partition, so that the
    result does not depend on how rows are dealt.
    """
    key = F.xxhash64("doc_id", "start", "generator", "features")
    strata = Window.partitionBy("generator", "label", "origin").orderBy("__key", "features")
    sample = labelled_rows.withColumn("__key", key).withColumn("__rank", F.row_number().over(strata)).filter(F.col("__rank") <= most)
    learn = stored(
        sample.repartition(1).sortWithinPartitions("generator", "label", "origin", "__rank")
        .select("label", "features"), "sample",
    )
    if learn.select("label").distinct().count() < 2:
        return None
    trees = GBTClassifier(maxIter=20, maxDepth=4, stepSize=0.3, seed=1).fit(
        learn.select("label", array_to_vector("features").alias("features")))
    scored = trees.transform(labelled_rows.withColumn("features", array_to_vector("features"))).select(
        "generator", "label", F.floor(vector_to_array("probability")[1] * 100).cast("int").alias("bin")
    )
    return trees, thresholds(scored)


def thresholds(scored: DataFrame, precision: float = 0.9) -> dict[int, float]:
    """Per generator the least score, a half at least, above which at least ``precision`` of the rows are right.

    A generator where no score is that precise has none and selects nothing. One row per generator and
    hundredth comes to the driver.
    """
    counts = scored.groupBy("generator", "bin").agg(F.sum("label").alias("right"), F.count(F.lit(1)).alias("n")).collect()
    found: dict[int, float] = {}
    for g in {r["generator"] for r in counts}:
        right = n = 0
        for r in sorted((r for r in counts if r["generator"] == g), key=lambda r: -r["bin"]):
            right, n = right + r["right"], n + r["n"]
            if r["bin"] >= 50 and right >= precision * n:
                found[g] = r["bin"] / 100
    return found


def _labelled(candidates: DataFrame, seeds: DataFrame) -> DataFrame:
    """All candidates that are known to be right or wrong: those of the texts and rewritten ones."""
    own = candidates.filter(F.col("known") | (~F.col("touches") & F.col("harmless"))).select(
        "doc_id", "start", "generator", "features", F.col("known").cast("double").alias("label"), F.lit(0).alias("origin"))
    return stored(own.unionByName(_altered(seeds)), "labelled")


def _selected(candidates: DataFrame, seeds: DataFrame, limit: int) -> DataFrame:
    """row and merged spans of the candidates that the trees select."""
    free = candidates.filter(~F.col("touches"))
    model = _fitted(_labelled(candidates, seeds), limit)
    if model is None:
        return free.limit(0).select("row", no_spans(LABELLED).alias("model"))
    trees, limits = model
    limit_of = F.array(*[F.lit(limits.get(g, 2.0)) for g in range(len(GENERATORS))])
    scored = trees.transform(free.withColumn("features", array_to_vector("features")))
    chosen = scored.filter(vector_to_array("probability")[1] >= F.get(limit_of, F.col("generator")))
    # Overlapping ones become one: a new span begins where nothing before reaches.
    order = Window.partitionBy("row").orderBy("start", "end")
    reach = F.max("end").over(order.rowsBetween(Window.unboundedPreceding, -1))
    apart = chosen.select("row", "start", "end").withColumn("new", F.coalesce(F.col("start") >= reach, F.lit(True)).cast("int"))
    islands = apart.withColumn("island", F.sum("new").over(order)).groupBy("row", "island").agg(
        F.min("start").alias("start"), F.max("end").alias("end")
    )
    span = F.struct(F.lit(len(KINDS)).alias("rank"), "start", "end", F.lit("model").alias("kind"))
    return islands.groupBy("row").agg(F.collect_list(span).alias("model"))


def personal_spans(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", limit: int = SAMPLE_ROWS) -> DataFrame:
    """doc_id, base (spans of known formats) and model (further spans that the trees select).

    Spans are (rank, start, end, kind) in code points, ends exclusive. A null text is an empty one and has none.
    Repeated rows are scanned each; columns besides the two are not read; an empty table gives no rows. Without any
    known span there is nothing to learn from, and model is empty.
    """
    text = F.col("__text")
    found = base_spans(text)
    marked = docs.select(
        F.monotonically_increasing_id().alias("row"), F.col(id_column).alias("doc_id"),
        markable(F.col(text_column)).alias("__text"),
    )
    based = marked.withColumn("base", F.concat(*[labelled(s, k, i) for i, (k, s) in enumerate(zip(KINDS, found, strict=True))]))
    scanned = stored(based.select(
        "row", "doc_id", "base", _candidates(text, F.col("base")).alias("candidates"), _seeds(text, F.col("base")).alias("seeds"),
    ), "scanned")
    candidates = scanned.select("row", "doc_id", F.explode("candidates").alias("c")).select("row", "doc_id", "c.*")
    seeds = scanned.select("doc_id", F.explode("seeds").alias("s")).select("doc_id", "s.*")
    model = stored(_selected(candidates, seeds, limit), "selected")
    return scanned.join(model, "row", "left").select(
        "doc_id", "base", F.coalesce("model", no_spans(LABELLED)).alias("model")
    )


def redacted(text: Column, spans: Column) -> Column:
    """The text with each span, in order and not overlapping, replaced by its kind in brackets."""
    def piece(s: Column, i: Column) -> Column:
        start = F.coalesce(F.get(spans, i - 1)["end"], F.lit(0))
        return F.concat(F.substring(text, start + 1, s["start"] - start), F.lit("["), s["kind"], F.lit("]"))

    body = F.transform(spans, lambda s, i: F.when(i > 0, piece(s, i)).otherwise(
        F.concat(F.substring(text, F.lit(1), s["start"]), F.lit("["), s["kind"], F.lit("]"))))
    rest = F.substring(text, F.get(spans, F.size(spans) - 1)["end"] + 1, F.length(text))
    return F.when(F.size(spans) > 0, F.concat(F.array_join(body, ""), rest)).otherwise(text)


def report(found: DataFrame) -> DataFrame:
    """Counts of each known format, their digest, and all spans as text."""
    count = lambda kind: F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long")
    return found.select(
        "doc_id", *[count(k).alias(f"n_{k}") for k in KINDS],
        F.sha2(listed(F.col("base"), by_start=False), 256).alias("base_sha256"),
        listed(F.concat("base", "model"), by_start=False).alias("spans"),
    )
