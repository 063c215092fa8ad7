"""The text operators against brute force, on tables with every awkward case."""

import random
from collections import Counter

import pytest
import texts
from pyspark.sql import functions as F

import corpus_pipeline
from tidemark.llm import (
    decontaminate, jaccard, lm_scoring, mixing, pii, quality_classifier, quality_rules, queries, secrets, sharding,
    toxicity,
)
from tidemark.llm.links import components


@pytest.fixture(scope="module")
def rows():
    return texts.awkward()


@pytest.fixture(scope="module")
def docs(spark, rows):
    return texts.table(spark, rows).repartition(3).cache()


@pytest.fixture(scope="module")
def empty(docs):
    return docs.limit(0)


@pytest.fixture(scope="module")
def labels(spark):
    known = [(i, int(i % 3 > 0), int(i % 5 == 0)) for i in range(0, 60)]
    return texts.table(spark, [*known, (None, 1, 1), (4, None, None), (5, 0, 1), (5, 1, 0), (999, 1, 0)], texts.LABELS)


# Quality rules ------------------------------------------------------------------

def test_base_counts(docs, rows):
    got = quality_rules.quality_rules(docs).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")
    expected = Counter()
    for r in rows:
        own = texts.base_counts(r[1])
        expected[(r[0], *own, own[0] < 10 or 100 * own[4] > 20 * own[0])] += 1
    assert Counter(tuple(x) for x in got.collect()) == expected


def test_rules_reject_odd_documents_of_a_group_and_keep_the_rest(spark):
    plain = [(i, " ".join(f"word{i + k}" for k in range(30)), "en", "a") for i in range(80)]
    odd = [(100, " ".join(["#$%&"] * 4 + [f"w{k}" for k in range(20)]), "en", "a")]
    lonely = [(101, " ".join(f"term{k}" for k in range(30)), "xx", "b")]  # a group too small for limits of its own
    df = spark.createDataFrame(plain + odd + lonely, "doc_id long, text string, lang string, source string")
    kept = {r.doc_id: r.kept for r in quality_rules.quality_rules(df).collect()}
    assert [i for i, k in kept.items() if not k] == [100]


def with_repeats(i, share, words=100):
    """A text of ``words`` words, ``share`` percent of them in a run that occurs twice."""
    half = share * words // 200
    run = [f"again{i}x{k}" for k in range(half)]
    return " ".join([*run, *[f"once{i}x{k}" for k in range(words - 2 * half)], *run])


def test_limits_follow_the_group(spark):
    rows = [(i, with_repeats(i, 0), "en", "spotless") for i in range(200)]
    rows += [(1000 + i, with_repeats(i, 16 if i % 2 else 0), "en", "repetitive") for i in range(200)]
    rows += [(2000, with_repeats(2000, 16), "en", "spotless"), (2001, with_repeats(2001, 10), "en", "spotless"),
             (2002, with_repeats(2002, 16), "en", "repetitive"), (2003, with_repeats(2003, 16), "en", "other")]
    judged = {r.doc_id: r for r in quality_rules.quality_rules(
        spark.createDataFrame(rows, "doc_id long, text string, lang string, source string").repartition(5)).collect()}
    assert judged[2000].repeat_rate == 160 and not judged[2000].base_failed
    assert [i for i, r in judged.items() if not r.kept] == [2000]
    assert judged[0].max_repeat_rate == 0 and judged[1000].max_repeat_rate > 160
    # A group too small for limits of its own has those of its language, where such repeats are usual.
    assert judged[2003].max_repeat_rate > 160


def test_slack_grows_slower_than_the_text(spark):
    rows = [(i, with_repeats(i, 0), "en", "a") for i in range(100)]
    rows += [(200, with_repeats(200, 1, 10_000), "en", "a"), (201, with_repeats(201, 2, 10_000), "en", "a")]
    kept = {r.doc_id: r.kept for r in quality_rules.quality_rules(
        spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")).collect()}
    assert kept[200] and not kept[201]


def test_sketches_merge(spark):
    values = [(i % 3, v) for i, v in enumerate([0, 1, 31, 32, 33, 47, 48, 100, 1000, 10**6, 10**9] * 3)]
    df = spark.createDataFrame(values, "g int, value long").withColumn("bin", quality_rules.sketch_bin("value"))
    for r in df.withColumn("low", quality_rules.bin_floor("bin")).withColumn("last", quality_rules.bin_last("bin")).collect():
        assert r.low <= r.value <= r.last <= r.low * 17 / 16 + 1e-9
    whole = quality_rules.sketches(df.withColumnRenamed("value", "m"), [], ("m",))
    parts = quality_rules.merged(quality_rules.sketches(df.withColumnRenamed("value", "m"), ["g"], ("m",)), [])
    assert sorted(map(tuple, whole.collect())) == sorted(map(tuple, parts.collect()))


# Sharding -------------------------------------------------------------------------

@pytest.mark.parametrize("shards", [1, 4, 40])
def test_shards_are_balanced_and_gapless(docs, rows, shards):
    got = sharding.shard_documents(docs, shards).collect()
    assert len(got) == len(rows)
    sizes = Counter()
    for r in got:
        sizes[r["shard"]] += r["size"]
    total, largest = sum(sizes.values()), max(r["size"] for r in got)
    assert all(abs(sizes[k] - total / shards) <= largest for k in range(shards))
    for k in range(shards):
        slots = sorted(r["slot"] for r in got if r["shard"] == k)
        assert slots == list(range(len(slots)))


# Jaccard join -----------------------------------------------------------------------

def near_copies(seed: int) -> list[tuple]:
    rng = random.Random(seed)
    out = []
    for _ in range(40):
        n = rng.choice([1, 2, 3, 5, 11, 12, 14, 20, 30, 60, 150, 400])
        words = [rng.choice(texts.LETTERS) * rng.randint(1, 3) for _ in range(n)]
        for _ in range(rng.choice([1, 2, 5, 15])):
            own = list(words)
            for _ in range(rng.randint(0, max(1, n // 40))):
                own[rng.randrange(n)] = rng.choice("xyz") * rng.randint(1, 5)
            out.append((len(out), " ".join(own)))
    return out


@pytest.mark.parametrize("block", [4096, 4])
def test_jaccard_components(spark, monkeypatch, block):
    monkeypatch.setattr(jaccard, "BLOCK", block)
    pairs = near_copies(block)
    df = spark.createDataFrame(pairs, "doc_id long, text string").repartition(4)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard.jaccard_components(df).collect()}
    assert got == texts.jaccard(pairs)


def test_jaccard_on_awkward_rows(docs, rows):
    got = jaccard.jaccard_components(docs).collect()
    assert len(got) == len(rows)
    expected = texts.jaccard([(r[0], r[1]) for r in rows if r[0] is not None])
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got if r.doc_id is not None} == expected
    assert all(r.component_id is None for r in got if r.doc_id is None)


def test_a_row_without_id_hides_no_links_of_its_copies(spark):
    words = [f"word{k}" for k in range(60)]
    rows = [(None, " ".join(words)), (5, " ".join(words)), (6, " ".join([*words, "more"]))]
    df = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    got = {r.doc_id: r.component_id for r in jaccard.jaccard_components(df).collect()}
    assert got == {None: None, 5: 5, 6: 5}


def test_one_of_each(docs, rows):
    kept = jaccard.one_of_each(docs)
    assert kept.columns == docs.columns
    expected = texts.jaccard([(r[0], r[1]) for r in rows if r[0] is not None])
    stay = sorted(i for i, (_, c) in expected.items() if c == i)
    got = [r.doc_id for r in kept.collect()]
    assert sorted(i for i in got if i is not None) == stay and got.count(None) == 2


def test_cells_miss_no_link_of_any_size():
    """Sets at the very limit of similarity share a cell."""
    import numpy as np

    rng = np.random.default_rng(0)
    for n in [*range(9, 60), 100, 333, 1000]:
        a = rng.integers(0, 2**63, n).astype(np.uint64)
        for m in range(n, n * 10 // 9 + 1):
            least = -(-(90 * (n + m)) // 190)
            if least > n:
                continue
            b = np.concatenate([a[:least], rng.integers(0, 2**63, m - least).astype(np.uint64)])
            values = np.concatenate([np.sort(a), np.sort(b)])
            row, key = jaccard.cell_keys(values, np.array([0, n, n + m]))
            assert set(key[row == 0].tolist()) & set(key[row == 1].tolist()), (n, m)


@pytest.mark.parametrize("percent", [80, 90])
def test_cells_of_any_threshold(percent):
    """Sets at the very limit share a cell, and large sets make few cells of empty groups."""
    import numpy as np

    like = jaccard.Likeness(5, percent)
    rng = np.random.default_rng(1)
    counts = rng.integers(0, 9, jaccard.BUCKETS).astype(np.uint32)
    for n in [*range(like.least_size, 60), 100, 333, 1000]:
        a = rng.integers(0, 2**63, n).astype(np.uint64) << np.uint64(1)
        for m in range(n, 100 * n // percent + 1):
            least = -(-(percent * (n + m)) // (100 + percent))
            if least > n:
                continue
            b = np.concatenate([a[:least], rng.integers(0, 2**63, m - least).astype(np.uint64) << np.uint64(1)])
            values = np.concatenate([np.sort(a), np.sort(b)])
            row, key = jaccard.cell_keys(values, np.array([0, n, n + m]), like)
            assert set(key[row == 0].tolist()) & set(key[row == 1].tolist()), (n, m)
            row, key = jaccard.rare_keys(values, np.array([0, n, n + m]), counts, like)
            assert set(key[row == 0].tolist()) & set(key[row == 1].tolist()), (n, m)
    many = np.sort(rng.integers(0, 2**63, (300, 500)).astype(np.uint64) << np.uint64(1), axis=1)
    row, key = jaccard.cell_keys(many.ravel(), np.arange(301) * 500, like)
    assert np.unique(key, return_counts=True)[1].max() <= 3


@pytest.mark.parametrize("block", [4096, 4])
def test_jaccard_of_five_words(spark, monkeypatch, block):
    monkeypatch.setattr(jaccard, "BLOCK", block)
    pairs = near_copies(block + 1)
    df = spark.createDataFrame(pairs, "doc_id long, text string").repartition(4)
    found = jaccard.jaccard_components(df, like=jaccard.Likeness(5, 80)).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in found} == texts.jaccard(pairs, 5, 80)


def test_pipeline_drops_what_is_near_by_five_words(spark):
    """A hundred words with two edits are near by five words and 0.8, but not by three and 0.9."""
    rng = random.Random(11)
    rows = []
    for i in range(30):
        words = ["".join(rng.choice(texts.LETTERS) for _ in range(6)) for _ in range(100)]
        rows.append((2 * i, " ".join(words), "en", "a"))
        for k in range(1 + i % 4):
            words[10 + 20 * k] = f"edit{k}"
        rows.append((2 * i + 1, " ".join(words), "en", "b"))
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string").repartition(3)
    pairs = [r[:2] for r in rows]
    expected = {i for i, (_, c) in texts.jaccard(pairs, 5, 80).items() if c == i}
    assert expected != {i for i, (_, c) in texts.jaccard(pairs).items() if c == i}
    assert sorted(r.doc_id for r in corpus_pipeline.distinct(spark, df, "").collect()) == sorted(expected)


def test_components_of_a_long_chain(spark):
    chain = [(i, i + 1) for i in range(200)] + [(500, 501), (501, 500), (7, 7), (None, 3)]
    got = {r.node: r.component for r in components(spark.createDataFrame(chain, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(1, 201)}, 501: 500}


# Decontamination ----------------------------------------------------------------------

def leaky(seed: int):
    rng = random.Random(seed)
    text = lambda n: " ".join(rng.choice(["a", "b", "c", "the", "x9", "é"]) + rng.choice(["", ",", "\n"]) for _ in range(n))
    items = [(i, text(n)) for i, n in enumerate([5, 7, 9, 10, 11, 30, 30])] + [(7, None), (8, ""), (9, "!?")]
    rows = [(i, f"{text(rng.choice([0, 3, 40, 200]))} {rng.choice(items)[1] or ''} {text(9).upper()}") for i in range(60)]
    return [*rows, (60, None), (61, ""), (61, items[5][1]), (None, items[4][1])], items


@pytest.mark.parametrize("chars", [8_000_000, 60])
def test_contamination(spark, chars):
    rows, items = leaky(chars)
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("n_words", F.lit("other")).repartition(3)
    found = decontaminate.contaminated_spans(df, spark.createDataFrame(items, "item_id long, text string"), ["doc_id"], block_chars=chars)
    got = decontaminate.report(found).select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")
    assert Counter(map(tuple, got.collect())) == Counter(texts.contaminated(rows, items))


def found_by_hand(rows, items):
    """doc id, words hit and items found, of the operator's inner search without Spark."""
    import pyarrow as pa

    from tidemark.llm.blocks import ALNUM, word_chunks

    phrases = decontaminate.phrases_of([str(i) for i, _ in items], [t for _, t in items])
    out = []
    for words in word_chunks(pa.array([t for _, t in rows], pa.string()), ALNUM, decontaminate.SHARD_BYTES):
        hit, row, item = decontaminate.found_in(words, phrases)
        for k in range(words.rows):
            found = {phrases.names[x] for x in item[row == k]}
            out.append((rows[words.first + k][0], int(hit[words.row == k].sum()), len(found)))
    return out


def test_hashing_holds_a_bounded_piece_of_the_text(monkeypatch):
    import tracemalloc

    import pyarrow as pa

    from tidemark.llm import blocks

    text = "word " + " ".join(f"W{i}" + "x" * (i % 40) for i in range(60_000))
    words, = blocks.word_chunks(pa.array([text]), blocks.ALNUM)
    words.hashes()
    tracemalloc.start()
    whole = words.hashes()
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert most < 15 * len(text)
    monkeypatch.setattr(blocks, "HASH_BYTES", 7)
    few, = blocks.word_chunks(pa.array([text[:2000]]), blocks.ALNUM)
    assert few.hashes()[:-1].tolist() == whole[: len(few.start) - 1].tolist()


@pytest.mark.parametrize("most", [1, 7, 50])
def test_an_index_is_cut_without_loss(monkeypatch, most):
    monkeypatch.setattr(decontaminate, "INDEX_WORDS", most)
    rows, items = leaky(most)
    assert found_by_hand(rows, items) == [(r[0], r[2], r[3]) for r in texts.contaminated(rows, items)]


def test_a_text_of_over_two_million_known_words():
    import numpy as np

    rng = np.random.default_rng(3)
    names = np.array([f"w{k}" for k in range(40)])
    items = [(0, " ".join(names)), *((i, " ".join(names[rng.integers(0, 40, n)])) for i, n in enumerate([10, 10, 12, 30], 1))]
    words = rng.integers(0, 40, 2**21 + 5000)
    text = names[words]
    for k in range(1500):
        item = np.array(items[k % 5][1].split())
        at = k * 1400 + 7 if k % 7 else min(2**20 * (1 + k % 2) - 5 + k % 11, len(text) - 50)
        text[at : at + len(item)] = item
    text[-30:] = np.array(items[4][1].split())
    rows = [(1, " ".join(text))]
    assert found_by_hand(rows, items) == [(r[0], r[2], r[3]) for r in texts.contaminated(rows, items)]


def test_suffixes_of_over_two_million_words_are_in_order():
    import numpy as np

    rng = np.random.default_rng(4)
    text = rng.integers(1, 6, 2**21 + 9)
    text[-1] = 0
    left = np.arange(len(text))[::-1]
    order = decontaminate.suffix_order(text, left)
    assert len(np.unique(order)) == len(text)
    for k in rng.integers(1, len(text), 3000):
        a, b = order[k - 1], order[k]
        assert tuple(text[a : a + 60]) <= tuple(text[b : b + 60])


def test_spans_are_cut_out(spark):
    item = "one two three four five six seven eight nine ten eleven"
    rows = [(1, f"Été before. {item.upper()}! after \U0001f600"), (2, item), (3, "clean")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    found = decontaminate.contaminated_spans(df, spark.createDataFrame([(1, item)], "item_id long, text string"), ["doc_id", "text"])
    cut = found.select("doc_id", decontaminate.without_spans(F.col("text"), F.col("spans")).alias("t"))
    assert dict(map(tuple, cut.collect())) == {1: "Été before. ! after \U0001f600", 2: "", 3: "clean"}
    kept = decontaminate.clean_documents(df, spark.createDataFrame([(1, item)], "item_id long, text string"))
    assert kept.collect() == [(3, "clean")]


def test_nothing_to_look_for(spark, docs, rows):
    found = decontaminate.contaminated_spans(docs, spark.createDataFrame([], "item_id long, text string"), ["doc_id"])
    assert [r.spans for r in found.collect()] == [[]] * len(rows)


# Mixing ---------------------------------------------------------------------------------

@pytest.mark.parametrize("target", [mixing.Target(0.9, 3.0, 4000), mixing.Target(1.0, 8.0, 9000), mixing.Target(0.9, 2.0, None)])
def test_mixture_meets_weights(spark, target):
    rng = random.Random(7)
    rows = [(i, " ".join(["w"] * rng.randint(1, 30)), "big" if i % 10 < 7 else rng.choice(["b", "c", None])) for i in range(400)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(3)
    draws = mixing.mixture(df, target).collect()
    tokens, own, times, weight = Counter(), Counter(), Counter(), {}
    for i, text, source in rows:
        own[source] += len(text.split())
    for r in draws:
        tokens[r.source] += r.n_tokens
        times[r.doc_id] += 1
        weight[r.source] = r.weight
    assert abs(sum(weight.values()) - 1) < 1e-9
    budget = target.budget or sum(tokens.values())
    for source, n in own.items():
        assert abs(tokens[source] - weight[source] * budget) <= 31 * 2
        assert weight[source] * budget / n <= target.repeats * 1.02
    if target.budget is None:
        assert len(times) == len(rows)
    of_source = {r[0]: r[2] for r in rows}
    for source in own:  # no document is drawn twice more often than another of its source
        counts = [times[i] for i, s in of_source.items() if s == source]
        assert max(counts) - min(counts) <= 1


def test_query_mixes(spark):
    """Half-way in entropy to equal weights, whole epochs and a cut one, on the supplied tables."""
    import math

    draws = queries.op5_temperature_mix(spark, "/root/testdata/sf0.01").collect()
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    own = {r.source: r.n for r in docs.groupBy("source").agg(F.sum(mixing.token_count(F.col("text"))).alias("n")).collect()}
    total = sum(own.values())
    weight = {r.source: r.weight for r in draws}
    entropy = lambda shares: -sum(x * math.log(x) for x in shares if x)
    before = entropy([n / total for n in own.values()])
    wanted = before + 0.5 * (math.log(len(own)) - before)
    assert abs(entropy(weight.values()) - wanted) < 1e-6 and wanted > before
    times = Counter(r.doc_id for r in draws)
    assert {1, 2} <= set(times.values()) and {r.epoch for r in draws} >= {0, 1}
    longest = docs.agg(F.max(mixing.token_count(F.col("text")))).first()[0]
    assert abs(sum(r.n_tokens for r in draws) - 1.5 * total) <= longest * len(own)
    assert all(weight[s] < n / total for s, n in own.items() if n == max(own.values()))


def test_mixture_of_awkward_rows(docs, rows):
    mixed = mixing.mixed_documents(docs, mixing.Target(0.95, 2.0, None))
    assert mixed.columns == docs.columns
    assert not set(r[0] for r in rows) - set(r.doc_id for r in mixed.select("doc_id").collect())


# Secrets and personal data ------------------------------------------------------------------

SECRET_TEXTS = [
    None, "", "token=abc12345 é\U0001f600 PASSWORD: \"abcdefgh\"﷐ secret='x' api_key = zzzzzzzzz",
    "AKIA" + "A" * 12 + " AKIA" + "B" * 11 + " xAKIA1234567890AB", "f" * 32 + " " + "e" * 31 + "é" + "0" * 40,
    "token=password=abcdefgh1", 'secret="token:abcdefghij"', "password=aaaaaaaa " * 2000,
]
PERSONAL_TEXTS = [
    None, "", "a@b.c_d@e.f x@y", "1.2.3.4.5.6.7.8 256.1.1.1 0001.02.3.255", "4111 1111 1111 1111 4111-1111-1111-1111",
    "+1 (979) 555-6697 +12", "é\U0001f600 a.b@c.de ﷐ 1.1.1.1", "1 " * 20_000, "a.b@c" + ".d" * 10_000, "9" * 30_000, "x" * 30_000,
]


def test_secret_formats(spark):
    rng = random.Random(3)
    rows = list(enumerate(SECRET_TEXTS + ["".join(rng.choice("tokensecret=: 'AKI0f9\"") for _ in range(200)) for _ in range(100)]))
    df = spark.createDataFrame([*rows, rows[2], (None, "token=abcdefgh")], "doc_id long, text string")
    got = secrets.report(secrets.secret_spans(df)).select("doc_id", "n_assign", "n_access", "n_hex", "base_sha256")
    expected = Counter((i, *texts.base_matches(t, texts.SECRETS, True)) for i, t in [*rows, rows[2], (None, "token=abcdefgh")])
    assert Counter(map(tuple, got.collect())) == expected


def test_random_strings_are_found_and_words_are_not(spark):
    import base64

    rng = random.Random(5)
    hidden = [base64.b64encode(rng.randbytes(36)).decode() for _ in range(20)] + [rng.randbytes(20).hex() for _ in range(20)]
    plain = ["thisisaratherlongnaturalword", "anotherverylongnaturalword", "internationalisationefforts", "ANOTHERVERYLONGNATURALWORD"]
    rows = [(i, f"before {plain[i % 4]}{'abcdefgh'[i % 8]} {h} after {plain[(i + 1) % 4]}") for i, h in enumerate(hidden)]
    rows += [(100 + i, " ".join(plain)) for i in range(200)]
    found = secrets.secret_spans(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    text = dict(rows)
    got = {r.doc_id: [text[r.doc_id][s.start : s.end] for s in r.random] for r in found}
    assert sum(got[i] == [h] for i, h in enumerate(hidden)) >= 38
    assert all(not got[100 + i] for i in range(200))


def test_personal_formats(spark):
    rng = random.Random(2)
    rows = list(enumerate(PERSONAL_TEXTS + ["".join(rng.choice("a1.@+- 23é(9") for _ in range(rng.randint(5, 120))) for _ in range(300)]))
    df = spark.createDataFrame([*rows, rows[3], (None, "a@b.c")], "doc_id long, text string").repartition(3)
    got = pii.report(pii.personal_spans(df)).select("doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256")
    expected = Counter((i, *texts.base_matches(t, texts.PERSONAL, False)) for i, t in [*rows, rows[3], (None, "a@b.c")])
    assert Counter(map(tuple, got.collect())) == expected


def test_mistyped_cards_are_selected_and_years_are_not(spark):
    rng = random.Random(2)

    def card(right: bool) -> str:
        while True:
            digits = "4" + "".join(rng.choice("0123456789") for _ in range(15))
            if texts.luhn(digits) == right:
                return digits

    rows = [(i, f"pay with card {card(i % 20 > 0)} by {rng.randint(1990, 2030)}-10-{rng.randint(10, 28)} order {rng.randint(10**6, 10**7 - 1)}") for i in range(800)]
    found = pii.personal_spans(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    model = {r.doc_id: [(s.start, s.end) for s in r.model] for r in found}
    assert sum(model[i] == [(14, 30)] for i in range(0, 800, 20)) >= 36
    assert not any(model[i] for i in range(800) if i % 20)


def new_forms(seed: int) -> list[tuple]:
    """Texts with forms that no base pattern finds (third column: start, end) or harmless numbers, beside known formats."""
    rng = random.Random(seed)
    digits = lambda n: "".join(rng.choice("123456789") for _ in range(n))
    word = lambda: "".join(rng.choice("abcdeilmnorst") for _ in range(rng.randint(3, 9)))
    made = []

    def add(before: str, own: str, wanted: bool | None):
        lead = " ".join(word() for _ in range(rng.randint(1, 6))) + before
        span = None if wanted is None else (len(lead), len(lead) + len(own)) if wanted else ()
        made.append((len(made), f"{lead}{own} {word()} {word()}", span))

    for _ in range(100):
        add(rng.choice([" mail ", " "]), f"{word()}{rng.choice([' (at) ', ' [at] '])}{word()}.org", True)
        add(rng.choice([" call ", " "]), f"({digits(3)}) {digits(3)}-{digits(4)}", True)
        add(rng.choice([" host ", " "]), ":".join(f"{rng.randint(4096, 65535):x}" for _ in range(8)), True)
        add(" on ", f"{rng.randint(1960, 2030)}-{rng.randint(10, 12)}-{rng.randint(10, 28)}", False)
        add(" for $", f"{digits(5)}.{digits(2)}", False)
        add(" order ", digits(rng.choice([7, 9])), False)
        add(" version ", f"{digits(1)}.{digits(2)}.{digits(2)}", False)
    for _ in range(400):
        add(rng.choice([" mail ", " "]), f"{word()}@{word()}.com", None)
    for _ in range(100):
        add(rng.choice([" call ", " "]), f"+1 {digits(3)}-{digits(3)}-{digits(4)}", None)
    return made


def test_forms_that_no_pattern_knows(spark):
    made = new_forms(8)
    rows = [(i, t) for i, t, _ in made]
    found = [
        {r.doc_id: sorted((s.start, s.end) for s in r.model) for r in pii.personal_spans(
            spark.createDataFrame(rows, "doc_id long, text string").repartition(n)).collect()}
        for n in (1, 7)
    ]
    assert found[0] == found[1]
    for k, name in enumerate(("at", "phone", "network")):
        wanted = [(i, w) for i, _, w in made[:700] if i % 7 == k]
        assert sum([w] == found[0][i] for i, w in wanted) >= 90, name
    assert sum(bool(found[0][i]) for i, _, w in made if w == ()) <= 8
    assert not any(found[0][i] for i, _, w in made if w is None)


def test_redaction(spark):
    df = spark.createDataFrame([("é a@b.c and 1.2.3.4!",)], "text string")
    spans = "array(named_struct('start', 2, 'end', 7, 'kind', 'email'), named_struct('start', 12, 'end', 19, 'kind', 'ip'))"
    assert df.select(pii.redacted(F.col("text"), F.expr(spans))).first()[0] == "é [email] and [ip]!"


# Language-model scoring --------------------------------------------------------------------------

@pytest.mark.parametrize("block, buckets", [(250_000, None), (100, 3)])
def test_cross_entropy_difference(spark, block, buckets):
    rng = random.Random(4)
    rows = [(i, " ".join(rng.choice("abcdefgh") * rng.randint(1, 2) for _ in range(rng.randint(0, 60)))) for i in range(80)]
    rows += [(80, None), (81, "É é A")]
    target = set(range(40))
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("target", F.lit("other")).repartition(3)
    ids = spark.createDataFrame([(i,) for i in [*target, 3, None]], "doc_id long")
    smoothing = lm_scoring.Smoothing(0.5, 7.0)
    got = lm_scoring.cross_entropy_difference(df, ids, smoothing, block, buckets).collect()
    expected = texts.losses(rows, target, 0.5, 7.0)
    assert len(got) == len(rows)
    for r in got:
        assert (r.n_tokens, r.loss_target, r.loss_background) == pytest.approx(expected[r.doc_id], abs=1e-9)
        assert r.ce_diff == pytest.approx(r.loss_target - r.loss_background)


def test_losses_of_awkward_rows(docs, rows, labels):
    got = lm_scoring.cross_entropy_difference(docs, labels.limit(0)).collect()
    assert Counter(r.doc_id for r in got) == Counter(r[0] for r in rows)


# Classifiers -------------------------------------------------------------------------------------

def held_out_accuracy(scored, spark, label, modulus, held_out, cut):
    from tidemark.llm.common import id_remainder

    truth = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    both = scored.join(truth, "doc_id").filter(id_remainder("doc_id", modulus) == held_out).collect()
    return sum((r["score"] >= cut) == (r[label] == 1) for r in both) / len(both)


def test_quality_held_out(spark):
    read = lambda t: spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet")
    scored = quality_classifier.scored_documents(read("documents"), read("labels"))
    assert held_out_accuracy(scored, spark, "quality", 3, 1, 0.5) >= 0.97


def test_quality_learns_from_every_labelled_row(spark):
    """The only bad rows have the greatest hashes of over 20,000 ids."""
    from tidemark.llm.common import id_remainder

    ids = spark.range(33_000).select(F.col("id").alias("doc_id"))
    usable = ids.filter(id_remainder("doc_id", 3) != 1).orderBy(F.xxhash64("doc_id"), "doc_id")
    bad = {r[0] for r in usable.collect()[20_050:]}
    assert len(bad) > 500
    rows = [(i, " ".join(["@@##" if i in bad else "word"] * (3 + i % 50)), int(i not in bad)) for i in range(33_000)]
    table = spark.createDataFrame(rows, "doc_id long, text string, quality int")
    model = quality_classifier.learn_quality(table.select("doc_id", "text"), table.select("doc_id", "quality"))
    probe = spark.createDataFrame([(0, "word " * 9), (1, "@@## " * 9)], "i int, text string")
    score = dict(map(tuple, probe.select("i", quality_classifier.quality_score(F.col("text"), model)).collect()))
    assert score[0] > 0.5 > score[1]


def test_value_at_rank(spark):
    values = [random.Random(3).choice([1.5, 2.0, 9.0]) for _ in range(300)] + [i / 7 for i in range(500)]
    rows = spark.createDataFrame([(v,) for v in values], "v double")
    for rank in (0, 1, 250, 400, 799):
        assert quality_classifier.value_at(rows, "v", rank, bins=4, few=20) == sorted(values)[rank]


def test_toxicity_held_out(spark):
    read = lambda t: spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet")
    scored = toxicity.scored_documents(read("documents"), read("labels"))
    assert held_out_accuracy(scored, spark, "toxic", 4, 2, 0.3) >= 0.92


def test_scores_of_awkward_rows(docs, rows, labels):
    for operator in (quality_classifier, toxicity):
        got = operator.scored_documents(docs, labels).collect()
        assert Counter(r.doc_id for r in got) == Counter(r[0] for r in rows)
        assert all(0 <= r.score <= 1 for r in got)
        unlabelled = operator.scored_documents(docs, labels.limit(0)).collect()
        assert len({r.score for r in unlabelled}) == 1


def test_automaton_accepts_what_is_near():
    def distance(a, b):
        """Edits between two words, swaps of neighbours included."""
        d = {(i, 0): i for i in range(len(a) + 1)} | {(0, j): j for j in range(len(b) + 1)}
        for i in range(1, len(a) + 1):
            for j in range(1, len(b) + 1):
                d[i, j] = min(d[i - 1, j] + 1, d[i, j - 1] + 1, d[i - 1, j - 1] + (a[i - 1] != b[j - 1]))
                if i > 1 and j > 1 and a[i - 1] == b[j - 2] and a[i - 2] == b[j - 1]:
                    d[i, j] = min(d[i, j], d[i - 2, j - 2] + 1)
        return d[len(a), len(b)]

    import numpy as np

    terms = ["abcde", "abdce", "bbbbb", "dcba", "cacao", "ebony*"]
    machine = toxicity.build_automaton(terms)
    rng = random.Random(0)
    words = ["".join(rng.choice("abcdeo") for _ in range(rng.randint(1, 7))) for _ in range(4000)]
    for t in terms:
        words += [t.rstrip("*"), t[:2] + t[3:], t[1] + t[0] + t[2:].rstrip("*"), t.rstrip("*") + "x", "zz" + t]
    for w in words:
        points = np.array([ord(c) for c in w])
        state = machine.run(points, np.array([0]), np.array([len(w)]))[0]
        near = [distance(w, t) for t in terms if not t.endswith("*") and distance(w, t) <= toxicity.edits_allowed(t)]
        near += [0 for t in terms if t.endswith("*") and w.startswith(t[:-1])]
        assert (machine.term[state] >= 0) == bool(near), w
        if near:
            assert machine.cost[state] == min(near), w


def test_misspelt_abuse_counts_and_quotation_counts_less(spark):
    rng = random.Random(1)
    filler = lambda n: " ".join("".join(rng.choice("mnrstlk") for _ in range(6)) for _ in range(n))
    rows, labels = [], []
    for i in range(240):
        bad = i % 4 == 0
        rows.append((i, f"{filler(20)} {'you worthless idiot !' if bad else ''} {filler(10)}"))
        labels.append((i, 1, int(bad)))
    quoted = [(1000 + i, f'{filler(20)} the word "idiot" he said {filler(10)}') for i in range(15)]
    probes = [(2000, f"{filler(20)} you worthles idoit ! {filler(10)}"), (2001, filler(30)), (2002, f'{filler(20)} he said "idiot" once {filler(9)}'), (2003, f"{filler(20)} you idiot ! {filler(9)}")]
    docs = spark.createDataFrame(rows + quoted + probes, "doc_id long, text string")
    known = spark.createDataFrame(labels + [(i, 1, 0) for i, _ in quoted], texts.LABELS)
    score = dict(map(tuple, toxicity.scored_documents(docs, known).collect()))
    assert score[2001] < 0.05 and score[2003] > score[2002] and score[2003] > 0.3 and score[2000] > score[2001]


# All operators ---------------------------------------------------------------------------------------

def test_empty_tables(spark, empty, labels, docs):
    benchmark = spark.createDataFrame([(1, "one two three")], "item_id long, text string")
    for labelled in (labels, labels.limit(0)):
        assert quality_classifier.scored_documents(empty, labelled).count() == 0
        assert toxicity.scored_documents(empty, labelled).count() == 0
        assert lm_scoring.cross_entropy_difference(empty, labelled).count() == 0
    assert quality_rules.quality_rules(empty).count() == 0
    assert secrets.secret_spans(empty).count() == 0
    assert pii.personal_spans(empty).count() == 0
    assert mixing.mixture(empty, mixing.Target()).count() == 0
    assert mixing.mixture(empty, mixing.Target(0.5, relative=True, passes=1.5)).count() == 0
    assert sharding.shard_documents(empty).count() == 0
    assert jaccard.jaccard_components(empty).count() == 0
    assert jaccard.one_of_each(empty).count() == 0
    assert decontaminate.contaminated_spans(empty, benchmark, ["doc_id"]).count() == 0


def test_awkward_rows_have_spans(docs, rows):
    for found in (secrets.secret_spans(docs), pii.personal_spans(docs)):
        assert Counter(r.doc_id for r in found.collect()) == Counter(r[0] for r in rows)


# The pipeline -----------------------------------------------------------------------------------------

def test_pipeline_stages(spark):
    """Each stage on what its predecessor kept, with planted copies and leaks."""
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    long = docs.filter("length(text) > 1500").orderBy("doc_id").limit(3).collect()
    leak = spark.read.parquet(f"{sf}/benchmark.parquet").first()["text"]
    planted = [(9000 + k, r.text + " once", r.lang, r.source, r.n_chars) for k, r in enumerate(long)]
    planted += [(9100, long[0].text[:800] + " " + leak, "en", "s", 1), (9200, None, None, None, None)]
    docs = docs.union(spark.createDataFrame(planted, docs.schema))
    before = docs
    seen = {}
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, before, sf).cache()
        seen[name] = {r.doc_id for r in out.select("doc_id").collect()}
        if stage is not corpus_pipeline.shard:
            assert out.columns == docs.columns
        before = out
    good, distinct, clean, mixed, sharded = seen.values()
    assert good >= distinct >= clean and clean == mixed == sharded
    kept = docs.filter(F.col("doc_id").isin(*good)).select("doc_id", "text").collect()
    groups = texts.jaccard([tuple(r) for r in kept], 5, 80)
    assert distinct == {i for i, (_, c) in groups.items() if c == i}
    items = [tuple(r) for r in spark.read.parquet(f"{sf}/benchmark.parquet").select("item_id", "text").collect()]
    leaks = {r[0] for r in texts.contaminated([tuple(r) for r in docs.select("doc_id", "text").collect()], items) if r[5]}
    assert 9100 in leaks and clean == distinct - leaks
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    assert sum(q == 1 and i not in good for i, q in labels.items()) <= 2


def test_fine_vectors_bound_the_overlap():
    """For sets of all sizes, also where one vector is longer than the other."""
    import numpy as np

    rng = np.random.default_rng(2)
    pool = rng.integers(0, 2**63, 9_000).astype(np.uint64)
    sets = [np.unique(rng.choice(pool, n, replace=False)) for n in (0, 1, 5, 64, 255, 256, 257, 900, 1000, 4000, 8000)]
    edges = np.concatenate([[0], np.cumsum([len(s) for s in sets])])
    fine = jaccard.fine_vectors(np.concatenate(sets), edges)
    i, j = (x.ravel() for x in np.meshgrid(range(len(sets)), range(len(sets))))
    bound, sizes = jaccard.overlap_bounds(fine, i, j)
    assert sizes.tolist() == [len(s) for s in sets]
    overlap = np.array([len(np.intersect1d(sets[a], sets[b])) for a, b in zip(i, j)])
    assert (bound >= overlap).all() and (bound <= np.minimum(sizes[i], sizes[j])).all()
    assert (bound[i == j] == sizes).all()
    apart = jaccard.fine_vectors(np.concatenate([pool[:4000], pool[4000:8000]]), np.array([0, 4000, 8000]))
    assert jaccard.overlap_bounds(apart, np.array([0]), np.array([1]))[0][0] < 0.8 * 4000  # random sets do not pass
