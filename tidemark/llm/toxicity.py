"""Toxicity by fuzzy lexicon matches weighed in their context.

* **Lexicon.** Words and word beginnings that are significantly more frequent in texts labelled
  toxic are learnt from a bounded sample of labelled rows, with their log odds as weights.
* **Matching.** The lexicon is a trie. Levenshtein automata (one edit, swaps of neighbours
  included, for words of five letters or more) are intersected with it, and the product is
  made deterministic once, on the driver. Tasks then run all words of a chunk through that
  automaton together, a letter at a time; most words are out after two or three.
  Misspellings that the sample shows to be ordinary words are no matches.
* **Context.** For every match a window of words around it tells quotation (inside quotation marks,
  near a verb of saying) from abuse (an address, further matches, exclamation).
* **Score.** The evidence of a text, separately for exact and misspelt terms and for
  quotation and abuse, goes into a logistic regression fitted on the same sample.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.blocks import ALNUM, Words, word_chunks
from tidemark.llm.common import stored
from tidemark.llm.training import label_sample, logistic, sampled_texts, sigmoid

SAMPLE_ROWS = 24_000  # labelled rows looked at when fitting
MAX_TERMS = 200  # terms of the lexicon
STEM = (4, 8)  # letters of a word beginning
LEAST_ODDS = 2.0
EXPLAINED = 4  # chosen terms that explain a text
WINDOW = 5

# Words of saying and of address.
SAYING = (
    "said says quote quoted wrote called word term so-called reported "
    "sagte sagt schrieb nannte wort begriff zitat "
    "dit disait mot terme cite appelé "
    "dijo dice palabra término cita llamó"
).split()
ADDRESS = "you your youre u du dich dein ihr euch tu toi ton vous votre tú te tus usted vosotros".split()
QUOTES = "\"“”„«»‹›"


# Learning the lexicon ---------------------------------------------------------

def _term_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Documents per term and label, summed within the task."""
    held: dict[str, list[int]] = {}

    def flush() -> pa.RecordBatch:
        out = pa.RecordBatch.from_arrays(
            [pa.array(list(held), pa.string()), *(pa.array([v[k] for v in held.values()], pa.int64()) for k in (1, 0))],
            names=["term", "toxic", "other"],
        )
        held.clear()
        return out

    for batch in batches:
        labels = batch.column(0).to_pylist()
        for words in word_chunks(_lowered(batch.column(1)), ALNUM):
            raw = words.data.tobytes()
            edges = words.edges
            for r in range(words.rows):
                own = {raw[a:b].decode() for a, b in zip(
                    words.start[edges[r] : edges[r + 1]].tolist(), words.end[edges[r] : edges[r + 1]].tolist(), strict=True)}
                terms = {w for w in own if len(w) >= STEM[0]}
                terms |= {w[:n] + "*" for w in terms for n in range(STEM[0], min(STEM[1], len(w)) + 1)}
                label = labels[words.first + r]
                for t in terms:
                    if t in held:
                        held[t][label] += 1
                    else:
                        held[t] = [1 - label, label]
            if len(held) > 400_000:
                yield flush()
    if held:
        yield flush()


def _surprise(a: np.ndarray, b: np.ndarray, n: int, m: int) -> np.ndarray:
    """Log-likelihood ratio of a of n against b of m."""
    p = (a + b) / (n + m)
    total = np.zeros(len(a))
    for k, size in ((a, n), (b, m)):
        for seen, rate in ((k, p), (size - k, 1 - p)):
            ok = (seen > 0) & (rate > 0)
            total[ok] += seen[ok] * np.log(seen[ok] / (size * rate[ok]))
    return 2 * total


def candidates(counts: list[tuple[str, int, int]], toxic: int, other: int, most: int = 5000) -> tuple[list[str], np.ndarray, np.ndarray, float]:
    """Terms above the bar of significance, their weights and counts in other texts, and the bar.

    The bar rises with the number of terms, as for many tests at once.
    """
    bar = 2 * math.log(2 * max(2, len(counts)))
    if not counts:
        return [], np.zeros(0), np.zeros(0), bar
    a, b = (np.array([c[k] for c in counts], float) for k in (1, 2))
    odds = np.log((a + 0.5) / (toxic - a + 0.5)) - np.log((b + 0.5) / (other - b + 0.5))
    g = _surprise(a, b, toxic, other)
    use = np.flatnonzero((odds >= LEAST_ODDS) & (g >= bar))
    # Of equally telling terms, whole words and then longer ones come first.
    use = sorted(use.tolist(), key=lambda i: (-round(g[i], 6), counts[i][0].endswith("*"), -len(counts[i][0]), counts[i][0]))[:most]
    return [counts[i][0] for i in use], np.minimum(odds[use], 8.0), b[use], bar


def choose_terms(terms: list[str], other_counts: np.ndarray, texts: list[list[int]], toxic: int, other: int, bar: float, most: int = MAX_TERMS) -> list[int]:
    """Indexes of the terms taken, one after another, each the most telling for what is left.

    ``texts`` has the candidates in each toxic text. A text with ``EXPLAINED`` chosen terms is explained and counts no more,
    so that the words of a passage or of copies of one toxic text are not taken for toxic themselves. Of
    terms one of which begins with the other only one is taken.
    """
    text = np.repeat(np.arange(len(texts)), [len(t) for t in texts])
    term = np.array([i for t in texts for i in t], np.int64)
    explained = np.zeros(len(texts), np.int64)
    chosen: list[int] = []
    open_terms = np.ones(len(terms), bool)
    while len(chosen) < most and open_terms.any():
        seen = np.bincount(term[explained[text] < EXPLAINED], minlength=len(terms)).astype(float)
        left = max(1, int((explained < EXPLAINED).sum()))
        more = (seen + 0.5) / (left + 1) > 3 * (other_counts + 0.5) / (other + 1)
        g = np.where(open_terms & (seen >= 3) & more, _surprise(np.minimum(seen, left), other_counts, left, other), -1)
        best = int(np.argmax(g))
        if g[best] < bar:
            break
        chosen.append(best)
        explained[np.unique(text[term == best])] += 1
        body, stem = terms[best].rstrip("*"), terms[best].endswith("*")
        for i in np.flatnonzero(open_terms):
            own = terms[i].rstrip("*")
            if i == best or (stem and own.startswith(body)) or (terms[i].endswith("*") and body.startswith(own)):
                open_terms[i] = False
    return chosen


def _incidence(terms: list[str]):
    number = {t: i for i, t in enumerate(terms)}

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for words in word_chunks(_lowered(batch.column(0)), ALNUM):
                raw = words.data.tobytes()
                edges = words.edges
                for r in range(words.rows):
                    own = slice(edges[r], edges[r + 1])
                    found = set()
                    for a, b in zip(words.start[own].tolist(), words.end[own].tolist(), strict=True):
                        word = raw[a:b].decode()
                        found.add(number.get(word))
                        found.update(number.get(word[:n] + "*") for n in range(STEM[0], min(STEM[1], len(word)) + 1))
                    out.append(sorted(found - {None}))
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.list_(pa.int64()))], names=["found"])

    return rows


# Levenshtein automata and trie --------------------------------------------------

def edits_allowed(term: str) -> int:
    return 0 if term.endswith("*") or len(term) < 5 else 1


@dataclass
class Automaton:
    """A deterministic automaton over letters: state 0 is dead, 1 the start."""

    letters: np.ndarray  # code points, sorted; any other letter is class 0
    step: np.ndarray  # state x class
    term: np.ndarray  # accepted term of a state that ends a word, or -1
    cost: np.ndarray  # its edits
    final: np.ndarray  # states that accept whatever follows

    def classes(self, points: np.ndarray) -> np.ndarray:
        if not len(self.letters):
            return np.zeros(len(points), np.int64)
        at = np.minimum(np.searchsorted(self.letters, points), len(self.letters) - 1)
        return np.where(self.letters[at] == points, at + 1, 0)

    def run(self, points: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """The state after each word."""
        state = np.ones(len(start), np.int64)
        live, at = np.arange(len(start)), start.copy()
        while len(live):
            live = live[at[live] < end[live]]
            state[live] = self.step[state[live], self.classes(points[at[live]])]
            at[live] += 1
            live = live[(state[live] > 0) & ~self.final[state[live]]]
        return state


def build_automaton(terms: list[str]) -> Automaton:
    """The product of the terms' trie with their Levenshtein automata, made deterministic.

    A state is a set of (trie node, edits so far), the least edits per node; a swap of two
    neighbours waits for its second letter as (node after both, letter awaited, edits).
    """
    child: list[dict[str, int]] = [{}]
    ends: list[int] = [-1]
    spare: list[int] = [0]  # edits that some term below the node allows
    whole: list[bool] = [False]
    for k, term in enumerate(terms):
        node, allowed = 0, edits_allowed(term)
        spare[0] = max(spare[0], allowed)
        for letter in term.rstrip("*"):
            if letter not in child[node]:
                child[node][letter] = len(child)
                child.append({})
                ends.append(-1)
                spare.append(0)
                whole.append(False)
            node = child[node][letter]
            spare[node] = max(spare[node], allowed)
        ends[node] = k
        whole[node] = term.endswith("*")

    def closed(raw: dict) -> frozenset:
        """With skipped letters of the trie, and without what cannot end well."""
        todo, best = list(raw.items()), {}
        while todo:
            key, edits = todo.pop()
            node = key[0]
            if edits > spare[node] or best.get(key, 99) <= edits:
                continue
            best[key] = edits
            if len(key) == 1:
                todo += [((c,), edits + 1) for c in child[node].values()]
        return frozenset(best.items())

    def after(state: frozenset, letter: str | None) -> frozenset:
        out: dict = {}

        def put(key: tuple, edits: int) -> None:
            out[key] = min(edits, out.get(key, 99))

        for key, edits in state:
            node = key[0]
            if len(key) == 2:
                if key[1] == letter:
                    put((node,), edits)
                continue
            if whole[node]:
                put(key, edits)  # what follows the beginning does not matter
                continue
            put(key, edits + 1)
            for own, to in child[node].items():
                put((to,), edits if own == letter else edits + 1)
                if letter in child[to]:
                    put((child[to][letter], own), edits + 1)
        return closed(out)

    letters = sorted({c for t in terms for c in t.rstrip("*")})
    start = closed({(0,): 0})
    number = {frozenset(): 0, start: 1}
    steps, todo = [[0] * (len(letters) + 1), None], [start]
    while todo:
        state = todo.pop()
        row = []
        usual = after(state, None)
        near = {own for key, _ in state for own in child[key[0]]} | {k[1] for k, _ in state if len(k) == 2}
        near |= {c for key, _ in state for to in child[key[0]].values() for c in child[to]}
        for letter in [None, *letters]:
            to = after(state, letter) if letter in near else usual
            if to not in number:
                number[to] = len(number)
                steps.append(None)
                todo.append(to)
            row.append(number[to])
        steps[number[state]] = row
    term = np.full(len(number), -1)
    cost = np.zeros(len(number), np.int64)
    final = np.zeros(len(number), bool)
    for state, k in number.items():
        hits = [(edits, ends[key[0]]) for key, edits in state
                if len(key) == 1 and ends[key[0]] >= 0 and edits <= edits_allowed(terms[ends[key[0]]])]
        if hits:
            cost[k], term[k] = min(hits)
        final[k] = any(len(key) == 1 and whole[key[0]] and edits == 0 for key, edits in state)
    return Automaton(np.array([ord(c) for c in letters]), np.array(steps), term, cost, final)


# Scoring ------------------------------------------------------------------------

@dataclass
class Lexicon:
    weights: np.ndarray
    automaton: dict
    ordinary: set  # misspellings that are words of their own


FEATURES = 8


def _matches(words: Words, lexicon: Lexicon) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Word index, term and edits of every match, and each word's class in its context."""
    machine = Automaton(**lexicon.automaton)
    points = np.frombuffer(words.data.tobytes().decode("utf-8", "replace").encode("utf-32-le"), np.uint32).astype(np.int64)
    chars = np.concatenate([[0], np.cumsum((words.data & 0xC0) != 0x80)])
    state = machine.run(points, chars[words.start], chars[words.end])
    term = machine.term[state]
    at = np.flatnonzero(term >= 0)
    edits = machine.cost[state[at]]
    if lexicon.ordinary and len(at):
        raw = words.data.tobytes()
        own = np.array([e > 0 and raw[words.start[i] : words.end[i]].decode() in lexicon.ordinary
                        for i, e in zip(at.tolist(), edits.tolist(), strict=True)], bool)
        at, edits = at[~own], edits[~own]
    return at, term[at], edits, points


def _near(flags: np.ndarray, row: np.ndarray, at: np.ndarray) -> np.ndarray:
    """How many flagged words lie in the window around each match, within its text."""
    sums = np.concatenate([[0], np.cumsum(flags)])
    first = np.maximum(np.searchsorted(row, row[at]), at - WINDOW)
    last = np.minimum(np.searchsorted(row, row[at], "right"), at + WINDOW + 1)
    return sums[last] - sums[first]


def evidence(words: Words, lexicon: Lexicon) -> np.ndarray:
    """A row of numbers for each text of a chunk of lower-cased texts."""
    out = np.zeros((words.rows, FEATURES))
    out[:, -1] = 1.0
    if not len(words.start):
        return out
    at, term, edits, points = _matches(words, lexicon)
    if not len(at):
        return out
    row = words.row[at]
    raw = words.data.tobytes()
    hashed = words.hashes()
    known = {name: np.unique(_hash_of(group)) for name, group in (("saying", SAYING), ("address", ADDRESS))}
    saying = _near(np.isin(hashed, known["saying"]), words.row, at)
    address = _near(np.isin(hashed, known["address"]), words.row, at)
    matched = np.zeros(len(hashed), bool)
    matched[at] = True
    others = _near(matched, words.row, at) - 1
    # Inside quotation marks: an odd number of them lies between the text's start and the match.
    chars = np.concatenate([[0], np.cumsum((words.data & 0xC0) != 0x80)])
    marks = np.concatenate([[0], np.cumsum(np.isin(points, [ord(c) for c in QUOTES]))])
    before = marks[chars[words.start[at]]] - marks[chars[words.offs[row]]]
    following = marks[chars[words.offs[row + 1]]] - marks[chars[words.end[at]]]
    inside = (before % 2 == 1) & (following > 0)
    loud = np.array([raw[e : e + 1] == b"!" for e in words.end[at].tolist()])
    quotation = 1 - (1 - 0.6 * inside) * (1 - 0.5 * (saying > 0))
    abuse = (1 - quotation) * (1 + 0.3 * (address > 0) + 0.2 * np.minimum(others, 3) + 0.2 * loud)
    weight = lexicon.weights[term]
    total = lambda x: np.bincount(row, weights=x, minlength=words.rows)
    exact = edits == 0
    out[:, 0] = np.log1p(total(weight * abuse * exact))
    out[:, 1] = np.log1p(total(weight * quotation * exact))
    out[:, 2] = np.log1p(total(weight * abuse * ~exact))
    out[:, 3] = np.log1p(total(weight * quotation * ~exact))
    np.maximum.at(out[:, 4], row, weight * abuse * exact / 8)
    out[:, 5] = np.log1p(1000 * total(np.ones(len(row))) / np.maximum(1, words.count)) / 5
    out[:, 6] = total(exact) > 0
    return out


def _hash_of(group: list[str]) -> np.ndarray:
    return np.concatenate([w.hashes() for w in word_chunks(pa.array(group, pa.string()), ALNUM)])


def _lowered(column: pa.Array) -> pa.Array:
    return pc.utf8_lower(pc.fill_null(column, ""))


def _evidence_rows(lexicon: Lexicon):
    parts = vars(lexicon)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Lexicon(**parts)
        for batch in batches:
            for words in word_chunks(_lowered(batch.column(1)), ALNUM):
                x = evidence(words, own)
                at, _, edits, _ = _matches(words, own)
                raw = words.data.tobytes()
                near: list[list[str]] = [[] for _ in range(words.rows)]
                for i in at[edits > 0].tolist():
                    near[words.row[i]].append(raw[words.start[i] : words.end[i]].decode())
                lists = pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1) * FEATURES, pa.int32()), pa.array(x.ravel()))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(words.first, words.rows), lists, pa.array([sorted(set(n)) for n in near], pa.list_(pa.string()))],
                    names=["label", "x", "near"],
                )

    return rows


@dataclass
class ToxicityModel:
    terms: list[str]
    lexicon: Lexicon
    weights: np.ndarray


def learn_toxicity(docs: DataFrame, labels: DataFrame, modulus: int = 4, held_out: int = 2, limit: int = SAMPLE_ROWS) -> ToxicityModel:
    """Fit on at most ``limit`` labelled rows; copies of a text count once.

    The driver gets the candidate terms above the bar of significance and eight numbers
    per sampled text. Without labels of both classes the lexicon is empty and every score 0.
    """
    sample = label_sample(labels, "toxic", modulus, held_out, limit)
    rows = sampled_texts(docs, sample).select("label", "text").dropDuplicates(["text", "label"])
    rows = stored(rows, "labelled")
    sizes = {r["label"]: r["count"] for r in rows.groupBy("label").count().collect()}
    toxic, other = sizes.get(1, 0), sizes.get(0, 0)
    counts = (
        rows.mapInArrow(_term_counts, "term string, toxic long, other long").groupBy("term")
        .agg(F.sum("toxic").alias("toxic"), F.sum("other").alias("other"))
        .filter(f"toxic >= 3 and toxic * {other + 1.0} > 6 * other * {toxic + 1.0}")
        .orderBy(F.col("toxic").desc(), "term").limit(200_000)
    )
    terms, weights = [], np.zeros(0)
    if toxic and other:
        near, odds, others, bar = candidates([tuple(r) for r in counts.collect()], toxic, other)
        texts = rows.filter("label = 1").select("text").mapInArrow(_incidence(near), "found array<long>").toArrow()
        chosen = choose_terms(near, others, texts.column("found").to_pylist(), toxic, other, bar)
        chosen.sort(key=lambda i: near[i])
        terms, weights = [near[i] for i in chosen], odds[chosen]
    lexicon = Lexicon(weights, vars(build_automaton(terms)), set())
    seen = rows.mapInArrow(_evidence_rows(lexicon), "label int, x array<double>, near array<string>").toArrow().to_pydict()
    own: Counter = Counter()
    clean: Counter = Counter()
    for label, near in zip(seen["label"], seen["near"], strict=True):
        (own if label else clean).update(near)
    lexicon.ordinary = {w for w in clean if clean[w] * max(1, toxic) >= own[w] * max(1, other) / 8}
    if lexicon.ordinary:
        seen = rows.mapInArrow(_evidence_rows(lexicon), "label int, x array<double>, near array<string>").toArrow().to_pydict()
    if not toxic or not other:
        return ToxicityModel(terms, lexicon, np.array([0.0] * (FEATURES - 1) + [-40.0]))
    x, y = np.array(seen["x"], float).reshape(-1, FEATURES), np.array(seen["label"], float)
    return ToxicityModel(terms, lexicon, logistic(x, y, 0.05))


def toxicity_score(text: Column, model: ToxicityModel) -> Column:
    """Score of a text, 0 to 1; a null text scores as an empty one."""
    parts, weights = vars(model.lexicon), model.weights

    def scored(column: pa.Array) -> pa.Array:
        own = Lexicon(**parts)
        out = [sigmoid(evidence(words, own) @ weights) for words in word_chunks(_lowered(column), ALNUM)]
        return pa.array(np.concatenate(out) if out else np.zeros(0))

    return F.arrow_udf(scored, "double")(text)


def scored_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id and toxicity score of every document.

    Null and empty texts get the score of a text without matches. Repeated rows are scored
    each; an empty table gives no rows. Columns besides doc_id and text are not read.
    """
    model = learn_toxicity(docs, labels)
    return docs.select("doc_id", toxicity_score(F.col("text"), model).alias("score"))
