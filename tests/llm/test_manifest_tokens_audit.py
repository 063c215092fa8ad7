"""Token counts, Merkle manifests and filter audits against brute force, on tables with every awkward case."""

import random
from collections import Counter

import public_tokenizers
import pytest
import texts
from pyspark.sql import functions as F

from tidemark.llm import filter_audit, merkle, token_counts

MODEL = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def rows():
    return texts.awkward()


@pytest.fixture(scope="module")
def docs(spark, rows):
    return texts.table(spark, rows).repartition(3).cache()


# Token counts -------------------------------------------------------------------


@pytest.fixture(scope="module")
def library():
    from sentencepiece import SentencePieceProcessor

    return SentencePieceProcessor(model_file=MODEL)


@pytest.fixture(scope="module")
def merges():
    return token_counts.merge_table(MODEL)


def test_tokens_of_awkward_documents(docs, rows, library, merges):
    got = token_counts.token_report(docs, merges, limit=100).collect()
    expected = Counter()
    for r in rows:
        n = len(library.encode(r[1] or ""))
        expected[(r[0], len((r[1] or "").encode()), n, n > 100)] += 1
    assert Counter(map(tuple, got)) == expected
    assert token_counts.token_report(docs.limit(0), merges, limit=100).collect() == []


def some_texts(library, n: int) -> list[str]:
    rng = random.Random(5)
    pieces = [library.id_to_piece(i).replace("▁", " ") for i in range(259, library.get_piece_size())]
    kinds = [
        lambda: "".join(rng.choice(pieces) for _ in range(rng.randint(1, 40))),
        lambda: "".join(rng.choice("ab  \n\tx") for _ in range(rng.randint(1, 90))),
        lambda: "".join(chr(rng.choice([rng.randint(0, 0x7F), rng.randint(0x80, 0xD7FF), rng.randint(0xE000, 0x10FFFF)])) for _ in range(30)),
        lambda: "".join(rng.choice("etaoinshrdlu") for _ in range(rng.randint(50, 600))),
    ]
    fixed = ["", " ", "▁▁ ▁x", "<s></s><unk><0x0A>", "\x00", " " * 99, "a" + " " * 37 + "b", "x" * 3000, "日本語テキスト" * 40, "\U0001f600" * 9]
    return fixed + [rng.choice(kinds)() for _ in range(n)]


@pytest.mark.parametrize("segment, in_order", [(500_000, 20_000), (61, 20_000), (500_000, 0), (500_000, 30)])
def test_merging_equals_the_library(library, merges, monkeypatch, segment, in_order):
    """However texts are cut into segments, all at once or in strict order."""
    monkeypatch.setattr(token_counts, "SEGMENT", segment)
    monkeypatch.setattr(token_counts, "IN_ORDER", in_order)
    some = some_texts(library, 600)
    assert token_counts.Merger(merges).counts(some).tolist() == [len(x) for x in library.encode(some)]


def toy(pieces: list[str]) -> token_counts.MergeTable:
    """A table of pieces in order of rank; all characters are symbols."""
    names = sorted({c for p in pieces for c in p}) + pieces
    number, n = {p: k for k, p in enumerate(names)}, len(names)
    found = sorted((number[p[:c]] * n + number[p[c:]], number[p], k) for k, p in enumerate(pieces)
                   for c in range(1, len(p)) if p[:c] in number and p[c:] in number)
    table = token_counts.np.array(found, "int64").reshape(-1, 3)
    chars = sorted({ord(c) for p in pieces for c in p})
    near = sorted({chars.index(ord(a)) * len(chars) + chars.index(ord(b)) for p in pieces for a, b in zip(p, p[1:])})
    array = token_counts.np.array
    return token_counts.MergeTable(
        n, array([1] * n), array(chars), array([number[chr(c)] for c in chars], "int32"), table[:, 0].copy(),
        table[:, 1].astype("int32"), table[:, 2].astype("int32"), array(near))


def plain_merge(text: str, pieces: list[str]) -> int:
    rank, sym = {p: k for k, p in enumerate(pieces)}, list(text)
    while True:
        best = min(((rank[a + b], i) for i, (a, b) in enumerate(zip(sym, sym[1:])) if a + b in rank), default=None)
        if best is None:
            return len(sym)
        sym[best[1] : best[1] + 2] = [sym[best[1]] + sym[best[1] + 1]]


def test_merges_that_make_a_better_pair(merges):
    """Vocabularies no training gives, where one merge changes what comes next."""
    rng = random.Random(3)
    for _ in range(150):
        pieces = list({"".join(rng.choice("abc") for _ in range(rng.choice([2, 2, 3, 3, 4]))) for _ in range(9)})
        rng.shuffle(pieces)
        merger = token_counts.Merger(toy(pieces))
        some = ["".join(rng.choice("abc") for _ in range(rng.randint(1, 25))) for _ in range(20)]
        symbols = [merger.table.char_symbol[merger.place[[ord(c) for c in t]]] if all(merger.place[ord(c)] < merger.width - 1 for c in t) else None for t in some]
        kept = [(t, s) for t, s in zip(some, symbols) if s is not None]
        if kept:
            sizes = token_counts.np.array([len(t) for t, _ in kept])
            got = merger.merged_counts(token_counts.np.concatenate([s for _, s in kept]), sizes)
            assert got.tolist() == [plain_merge(t, pieces) for t, _ in kept]


def test_models_that_change_texts_are_refused(tmp_path):
    with pytest.raises(Exception):  # noqa: B017
        token_counts.merge_table(public_tokenizers.path("byte_bpe_50k.json"))


# Merkle manifest ------------------------------------------------------------------


def leaves(df):
    return df.select("doc_id", "source", "lang", "n_chars", "text")


def manifest(df):
    return merkle.manifest(df, **merkle.lower_cased_thirds(df))


def test_manifest_of_awkward_documents(docs, rows):
    got = manifest(docs).collect()
    assert Counter(map(tuple, got)) == Counter(texts.merkle([(r[0], r[3], r[2], r[4], r[1]) for r in rows]))
    assert manifest(docs.limit(0)).collect() == []


@pytest.mark.parametrize("sizes", [[1], [8], [9, 1], [64, 65, 512], [513, 2], [4097, 3]])
def test_trees_of_all_heights(spark, sizes):
    data = [(i * 7 % n + 1000 * g, "s", f"l{g}", 1, f"Text {i}") for g, n in enumerate(sizes) for i in range(n)]
    df = spark.createDataFrame(data, "doc_id long, source string, lang string, n_chars long, text string")
    assert Counter(map(tuple, manifest(df).collect())) == Counter(texts.merkle(data))


def test_many_groups(spark):
    """Enough of them for a tree of two superblock levels over the groups."""
    data = [(i, None, f"g{i}" if i else None, None, None) for i in range(600)]
    df = spark.createDataFrame(data, "doc_id long, source string, lang string, n_chars long, text string")
    assert Counter(map(tuple, manifest(df).collect())) == Counter(texts.merkle(data))


def test_a_changed_row_fails_and_no_other(spark):
    data = [(i, "s", "en", 1, "AbC" if i % 2 else "abc") for i in range(1, 700)]
    df = spark.createDataFrame(data, "doc_id long, source string, lang string, n_chars long, text string")
    got = {r.doc_id: r.verified for r in merkle.manifest(df, tampered=F.lit(True), tampered_fields=tuple(
        F.col(c) if c != "text" else F.lower("text") for c in ("doc_id", "source", "lang", "n_chars", "text"))).collect()}
    assert got == {i: i % 2 == 0 for i in range(1, 700)}


# Filter audit ---------------------------------------------------------------------


def steps(df):
    return {tuple(r[:3]): tuple(r[3:]) for r in df.collect()}


def test_filters_in_every_order(spark, docs, rows):
    marks = [(i, int(i % 3 > 0), int(i % 5 == 0)) for i in range(60)] + [(None, 1, 1), (4, None, None), (5, 1, 0), (5, 0, 1), (999, 1, 1)]
    labels = texts.table(spark, marks, texts.LABELS)
    got = steps(filter_audit.filter_interactions(docs, labels))
    assert got == texts.filter_steps([(r[0], r[3], r[1]) for r in rows], marks)
    assert len(got) == 600 * len({r[3] or "" for r in rows})
    assert steps(filter_audit.filter_interactions(docs.limit(0), labels)) == {}
    assert len(steps(filter_audit.filter_interactions(docs, labels.limit(0)))) == len(got)


def test_every_filter_and_hot_copies(spark):
    long = " ".join(f"word{k}" for k in range(60))
    data = [(i, "a", long) for i in range(300)] + [(300 + i, "b", long) for i in range(9)] + [(None, "a", long)] * 3
    data += [(400, "a", "Short"), (401, "b", long.upper()), (402, "b", "a b " * 30), (403, None, long + " #"), (404, "", long + " #"), (404, "", long + " #")]
    labels = texts.table(spark, [(i, i % 2, (i + 1) % 2) for i in range(405)], texts.LABELS)
    df = spark.createDataFrame(data, "doc_id long, source string, text string")
    got = steps(filter_audit.filter_interactions(df, labels))
    assert got == texts.filter_steps(data, [(i, i % 2, (i + 1) % 2) for i in range(405)])
