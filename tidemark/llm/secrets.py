"""Secret scans: known formats, and a battery of randomness tests for the rest.

Known formats are found by patterns. Besides, every run of 20 or more letters, digits and
the signs of base64 is a candidate. Its encoding is inferred from the characters it uses (decimal, hex,
base32, base36, base62, base64), and the hypothesis that its characters are drawn at random from that
alphabet is tested: chi-squared over symbols and over kinds of symbols, runs of one kind, and serial
correlation. Words and identifiers are rejected, keys are not.

Rejections are made under false-discovery control (Benjamini-Hochberg) within classes of length, over all
candidates of the corpus: of what is dismissed as ordinary, at most the stated share is random. p-values
are counted in bins, so the control needs a small table of counts, not a sort of all candidates.

All of it is DataFrame code. Texts are read once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import stored
from tidemark.llm.spans import LABELLED, bind, labelled, listed, markable, no_spans, spans_of

# The formats.
ASSIGN = (
    "(?i:(password|passwd|secret|token|api_?key))[\"']?\\x20*[:=]\\x20*[\"']?([A-Za-z0-9+/_.=-]+)"
)
ACCESS = "AKIA[A-Z0-9]{12,}"  # 16 characters or more
HEX = "[0-9a-f]{32,}"
LEAST_VALUE = 8

CANDIDATE = "[A-Za-z0-9+/_=-]{20,}"
LENGTH_CLASSES = (20, 32, 48, 96)  # least length of each class
BINS = 400  # a bin is a factor of 2 ** 0.1 in p


def base_spans(text: Column) -> tuple[Column, Column, Column]:
    """Matches of each known format that pass its checks."""
    assign = F.filter(
        spans_of(text, ASSIGN),
        lambda s: F.length(F.regexp_extract(s["text"], ASSIGN, 2)) >= LEAST_VALUE,
    )
    return assign, spans_of(text, ACCESS), spans_of(text, HEX)


def _tail(z: Column) -> Column:
    """Upper tail of the normal distribution, by an approximation good to a few percent."""
    up = F.greatest(z, F.lit(0.0))
    return F.when(z <= 0, 0.5).otherwise(0.5 * F.exp(-0.717 * up - 0.416 * up * up))


def _chi_tail(statistic: Column, freedom: Column) -> Column:
    """Upper tail of chi-squared, by the cube-root transform."""
    k = F.greatest(freedom, F.lit(1.0))
    spread = 2 / (9 * k)
    return _tail((F.pow(F.greatest(statistic, F.lit(0.0)) / k, F.lit(1 / 3)) - (1 - spread)) / F.sqrt(spread))


def _encoding(token: Column) -> Column:
    """Counts of lower, upper, digit and other symbols in the smallest alphabet that has all of the token's."""
    alphabet = lambda *n: F.array(*[F.lit(float(x)) for x in n])
    return (
        F.when(token.rlike("^[0-9]+$"), alphabet(0, 0, 10, 0))
        .when(token.rlike("^[0-9a-f]+$") & token.rlike("[0-9]"), alphabet(6, 0, 10, 0))
        .when(token.rlike("^[0-9A-F]+$") & token.rlike("[0-9]"), alphabet(0, 6, 10, 0))
        .when(token.rlike("^[A-Z2-7]+=*$") & token.rlike("[2-7]"), alphabet(0, 26, 6, 0))
        .when(token.rlike("^[0-9a-z]+$") & token.rlike("[0-9]"), alphabet(26, 0, 10, 0))
        .when(token.rlike("^[0-9A-Z]+$") & token.rlike("[0-9]"), alphabet(0, 26, 10, 0))
        .when(token.rlike("^[0-9A-Za-z]+$"), alphabet(26, 26, 10, 0))
        .otherwise(alphabet(26, 26, 10, 2))
    )


def randomness(token: Column) -> Column:
    """p-value of the hypothesis that the token is random in its encoding, the least of four tests times four."""
    kinds = [F.regexp_count(token, F.lit(p)).cast("double") for p in ("[a-z]", "[A-Z]", "[0-9]", "[^a-zA-Z0-9]")]

    def tests(bound: Column) -> Column:
        sizes, seen, chars = bound["sizes"], bound["seen"], bound["chars"]
        n = F.size(chars).cast("double")
        symbols = F.aggregate(sizes, F.lit(0.0), lambda a, x: a + x)
        share = lambda k: F.get(sizes, F.lit(k)) / symbols
        squares = F.aggregate(
            F.array_distinct(chars), F.lit(0.0),
            lambda a, c: a + F.pow(F.length(bound["token"]) - F.length(F.replace(bound["token"], c, F.lit(""))), F.lit(2)),
        )
        by_symbol = _chi_tail(symbols / n * squares - n, symbols - 1)
        used = sum((F.when(share(k) > 0, 1.0).otherwise(0.0) for k in range(4)), F.lit(0.0))
        by_kind = F.when(used <= 1, 1.0).otherwise(_chi_tail(
            sum((F.when(share(k) > 0, F.pow(F.get(seen, F.lit(k)) - n * share(k), F.lit(2)) / (n * share(k))).otherwise(0.0)
                 for k in range(4)), F.lit(0.0)),
            used - 1,
        ))
        # Changes from one kind of symbol to another between neighbours.
        kind_of = F.split(F.regexp_replace(F.regexp_replace(F.regexp_replace(F.regexp_replace(
            bound["token"], "[a-z]", "!"), "[A-Z]", "\""), "[0-9]", "#"), "[^!\"#]", "%"), "")
        changes = bind(kind_of, lambda q: F.size(F.filter(
            F.sequence(F.lit(0), F.size(q) - 2), lambda i: F.get(q, i) != F.get(q, i + 1))).cast("double"))
        change = 1 - sum((F.pow(share(k), F.lit(2)) for k in range(4)), F.lit(0.0))
        expected = (n - 1) * change
        runs = F.when(used <= 1, 1.0).otherwise(
            2 * _tail(F.abs(changes - expected) / F.sqrt(F.greatest(expected * (1 - change), F.lit(0.25)))))
        serial = bind(F.transform(chars, lambda c: F.ascii(c).cast("double")), lambda v: bind(
            F.aggregate(v, F.lit(0.0), lambda a, x: a + x) / n,
            lambda mean: 2 * _tail(F.sqrt(n) * F.abs(
                F.aggregate(F.sequence(F.lit(0), F.size(v) - 2), F.lit(0.0),
                            lambda a, i: a + (F.get(v, i) - mean) * (F.get(v, i + 1) - mean))
                / F.greatest(F.aggregate(v, F.lit(0.0), lambda a, x: a + (x - mean) * (x - mean)), F.lit(1e-9)))),
        ))
        return F.least(F.lit(1.0), 4 * F.least(by_symbol, by_kind, runs, serial))

    return bind(F.struct(
        token.alias("token"), _encoding(token).alias("sizes"), F.array(*kinds).alias("seen"),
        F.split(token, "").alias("chars"),
    ), tests)


def _candidates(text: Column) -> Column:
    """Candidates as (start, end, class, bin); a high bin means not random at all."""
    def row(s: Column) -> Column:
        length = s["end"] - s["start"]
        kind = sum(((length >= c).cast("int") for c in LENGTH_CLASSES[1:]), F.lit(0))
        p = F.greatest(randomness(s["text"]), F.lit(2.0 ** (-BINS / 10)))
        return F.struct(
            s["start"].alias("start"), s["end"].alias("end"), kind.alias("class"),
            F.floor(-10 * F.log2(p)).cast("int").alias("bin"),
        )

    return F.transform(spans_of(text, CANDIDATE), row)


def dismissal_bins(scanned: DataFrame, rate: float) -> dict[int, int]:
    """Per length class the least bin that is dismissed as not random.

    Of m candidates, those with p at most rate * i / m are dismissed, i being how many have a p as small. The
    table has one row per class and bin, at most 4 x 401.
    """
    each = scanned.select(F.explode("candidates").alias("c")).select("c.class", "c.bin")
    counts = each.groupBy("class", "bin").agg(F.count(F.lit(1)).alias("n"))
    down = Window.partitionBy("class").orderBy(F.col("bin").desc())
    whole = Window.partitionBy("class")
    ranked = counts.withColumn("i", F.sum("n").over(down)).withColumn("m", F.sum("n").over(whole))
    low = ranked.filter(F.pow(F.lit(2.0), -F.col("bin") / 10) <= rate * F.col("i") / F.col("m"))
    return {r["class"]: r["bin"] for r in low.groupBy("class").agg(F.min("bin").alias("bin")).collect()}


def secret_spans(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", rate: float = 0.01) -> DataFrame:
    """doc_id, base (spans of known formats) and random (spans of further random strings).

    Spans are (rank, start, end, kind) in code points, ends exclusive. A null text is an empty one and has
    none. Repeated rows are scanned each; columns besides the two are not read; an empty table gives no rows.
    """
    text = F.col("__text")
    assign, access, hexa = base_spans(text)
    scanned = docs.select(F.col(id_column).alias("doc_id"), markable(F.col(text_column)).alias("__text")).select(
        "doc_id",
        F.concat(labelled(assign, "assign", 0), labelled(access, "access", 1), labelled(hexa, "hex", 2)).alias("base"),
        _candidates(text).alias("candidates"),
    )
    scanned = stored(scanned, "scanned")
    limits = dismissal_bins(scanned, rate)
    limit = F.array(*[F.lit(limits.get(k, BINS + 1)) for k in range(len(LENGTH_CLASSES))])
    random = F.filter("candidates", lambda c: c["bin"] < F.get(limit, c["class"]))
    return scanned.select(
        "doc_id", "base",
        F.when(F.size(random) > 0, labelled(random, "random", 3)).otherwise(no_spans(LABELLED)).alias("random"),
    )


def report(found: DataFrame) -> DataFrame:
    """Counts of each known format, their digest, and all spans as text."""
    count = lambda kind: F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long")
    return found.select(
        "doc_id", *[count(k).alias(f"n_{k}") for k in ("assign", "access", "hex")],
        F.sha2(listed(F.col("base"), by_start=True), 256).alias("base_sha256"),
        listed(F.concat("base", "random"), by_start=True).alias("spans"),
    )
