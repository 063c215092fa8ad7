"""Small tables with every awkward case, and brute-force versions of the operators."""

import collections
import hashlib
import itertools
import math
import random
import re
import zlib

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, score double, n_words string, label int"
LABELS = "doc_id long, quality int, toxic int"
LETTERS = "abcdefghijklmnopqrstuvwxyz"


def awkward(seed: int = 1, n: int = 60) -> list[tuple]:
    """Rows with nulls in every column, empty and long texts, copies, repeated rows and clashing columns."""
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice(LETTERS) for _ in range(rng.randint(1, 7)))
    rows = []
    for i in range(n):
        words = [word() for _ in range(rng.choice([0, 1, 2, 9, 12, 40, 120]))]
        text = " ".join(words) + rng.choice(["", ".", "\n" + " ".join(words[:8]), " !!", " été \U0001f600"])
        rows.append((i, text, rng.choice(["en", "de", None]), rng.choice(["a", "b", None]), len(text), 0.5, "x", 3))
    rows += [
        (n, None, "en", "a", None, None, None, None), (n + 1, "", None, None, 0, None, None, None),
        (n + 2, " \t\n\u000b ", "en", "a", 5, None, None, None), (n + 3, rows[5][1], "en", "a", 1, None, None, None),
        (n + 4, "long " * 30_000 + "end", "en", "a", 1, None, None, None), (n + 5, "x" * 40_000, "en", "b", 1, None, None, None),
        (None, "a row without an id but with quite a few words in it, more than ten", "en", "a", 1, None, None, None),
        (None, None, None, None, None, None, None, None),
    ]
    rows += [rows[7], rows[7]]
    return rows


def table(spark, rows, schema=SCHEMA):
    return spark.createDataFrame(rows, schema)


def ascii_lower(text: str) -> str:
    return re.sub("[A-Z]", lambda m: m[0].lower(), text)


def spaced_words(text) -> list[str]:
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def plain_words(text) -> list[str]:
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", ascii_lower(text or ""))


def base_counts(text) -> tuple:
    words, text = spaced_words(text), text or ""
    windows = collections.Counter(tuple(words[i : i + 5]) for i in range(len(words) - 4))
    covered = {j for i in range(len(words) - 4) if windows[tuple(words[i : i + 5])] > 1 for j in range(i, i + 5)}
    lines = [x for x in text.split("\n") if spaced_words(x)]
    symbols = len(re.findall(r"[#*$%&|<>]", text))
    return len(words), sum(map(len, words)), symbols, len(lines) - len(set(lines)), len(covered)


def jaccard(rows: list[tuple], shingle: int = 3, percent: int = 90) -> dict:
    """n_shingles and component of each id; several rows with an id are one document with all their links."""
    sets = []
    for i, text in rows:
        w = [ascii_lower(x) for x in spaced_words(text)]
        sets.append((i, {tuple(w[k : k + shingle]) for k in range(max(1, len(w) - shingle + 1))} if w else set()))
    parent = {i: i for i, _ in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for k, (i, a) in enumerate(sets):
        for j, b in sets[:k]:
            both = len(a & b)
            if both and 100 * both >= percent * (len(a) + len(b) - both):
                x, y = root(i), root(j)
                parent[max(x, y)] = min(x, y)
    return {i: (len(s), root(i)) for i, s in sets}


def contaminated(rows: list[tuple], items: list[tuple]) -> list[tuple]:
    windows = collections.defaultdict(set)
    for item, text in items:
        w = plain_words(text)
        for k in range(max(1, len(w) - 9) if w else 0):
            windows[tuple(w[k : k + 10])].add(item)
    sizes = {len(k) for k in windows}
    out = []
    for i, text in rows:
        w, hit, found = plain_words(text), set(), set()
        for size in sizes:
            for k in range(len(w) - size + 1):
                own = windows.get(tuple(w[k : k + size]))
                if own:
                    hit |= set(range(k, k + size))
                    found |= own
        ids = ",".join(sorted(map(str, found)))
        out.append((i, len(w), len(hit), len(found), hashlib.sha256(ids.encode()).hexdigest(), bool(hit)))
    return out


def losses(rows: list[tuple], target: set, word: float, history: float) -> dict:
    """n_tokens and mean losses under target and background, each document left out."""
    words = {i: [*plain_words(t), "</>"] for i, t in rows}

    def counts(ids):
        single, pair = collections.Counter(), collections.Counter()
        for i in ids:
            single.update(words[i])
            pair.update(zip(["</>", *words[i][:-1]], words[i], strict=True))
        return single, pair, sum(single.values())

    every, good = counts(words), counts([i for i in words if i in target])
    out = {}
    for i, own_words in words.items():
        own, found = counts([i]), []
        for model, mine in ((good, i in target), (every, True)):
            total = 0.0
            for h, x in zip(["</>", *own_words[:-1]], own_words, strict=True):
                p = (model[0][x] - mine * own[0][x] + word) / (model[2] - mine * own[2] + word * len(every[0]))
                total -= math.log((model[1][h, x] - mine * own[1][h, x] + history * p) / (model[0][h] - mine * own[0][h] + history))
            found.append(total / len(own_words))
        out[i] = (len(own_words), *found)
    return out


def _digits(text):
    return re.sub("[^0-9]", "", text)


def luhn(text) -> bool:
    total = 0
    for k, c in enumerate(reversed(_digits(text))):
        v = int(c) * (1 + k % 2)
        total += v - 9 if v > 9 else v
    return total % 10 == 0


SECRETS = [
    ("assign", r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", lambda m: len(m[2]) >= 8),
    ("access", r"AKIA[A-Z0-9]+", lambda m: len(m[0]) >= 16),
    ("hex", r"[0-9a-f]+", lambda m: len(m[0]) >= 32),
]
PERSONAL = [
    ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda m: True),
    ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda m: all(int(x) <= 255 for x in m[0].split("."))),
    ("card", r"[0-9]([\x20-]?[0-9])+", lambda m: 13 <= len(_digits(m[0])) <= 19 and luhn(m[0])),
    ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", lambda m: 9 <= len(_digits(m[0])) <= 15),
]


def base_matches(text, formats, by_start: bool) -> tuple:
    """Counts per kind, and the digest."""
    found = [(m.start(), k, m.end(), name) for k, (name, pattern, ok) in enumerate(formats)
             for m in re.finditer(pattern, text or "") if ok(m)]
    found.sort(key=lambda f: f[:2] if by_start else (f[1], f[0]))
    joined = ",".join(f"{name}:{a}:{b}" for a, _, b, name in found)
    return (*(sum(f[3] == name for f in found) for name, _, _ in formats), hashlib.sha256(joined.encode()).hexdigest())


def merkle(rows: list[tuple]) -> list[tuple]:
    """Rows (doc_id, source, lang, n_chars, text) with leaf, subroot, root, proof, folded root and verdict."""
    h = lambda s: hashlib.sha256(s.encode()).hexdigest()

    def leaf(fields):
        return h("".join("-" if f is None else f"{len(str(f).encode())}:{f}" for f in fields))

    def tree(nodes):
        levels = [nodes]
        while len(levels[-1]) > 1:
            levels.append([h("".join(levels[-1][k : k + 8])) for k in range(0, len(levels[-1]), 8)])
        return levels

    def way(levels, k):
        out = []
        for nodes in levels[:-1]:
            first = k - k % 8
            out.append((nodes[first:k], nodes[k + 1 : first + 8]))
            k //= 8
        return out

    groups = collections.defaultdict(list)
    for r in rows:
        groups["" if r[2] is None else "=" + r[2]].append((leaf(r), r))
    names = sorted(groups, key=str.encode)
    for n in names:
        groups[n].sort(key=lambda g: (g[1][0] is not None, g[1][0] or 0, g[0]))
    trees = {n: tree([g[0] for g in groups[n]]) for n in names}
    crown = tree([trees[n][-1][0] for n in names])
    out = []
    for k, n in enumerate(names):
        for i, (own, r) in enumerate(groups[n]):
            path = way(trees[n], i) + way(crown, k)
            node = own
            if zlib.crc32(b"" if r[0] is None else str(r[0]).encode()) % 3 == 0 and r[4] is not None:
                node = leaf((*r[:4], ascii_lower(r[4])))
            for before, after in path:
                node = h("".join(before) + node + "".join(after))
            proof = h("".join("".join(b + a) for b, a in path))
            out.append((r[0], own, trees[n][-1][0], crown[-1][0], proof, node, node == crown[-1][0]))
    return out


def filter_steps(rows: list[tuple], labels: list[tuple]) -> dict:
    """(part, order, step) to its seven numbers; rows are (doc_id, source, text)."""
    good = {i for i, q, _ in labels if q == 1}
    toxic = {i for i, _, t in labels if t == 1}
    first = {}
    for i, _, text in rows:
        if i is not None:
            first[text or ""] = min(first.get(text or "", i), i)
    parts = collections.defaultdict(list)
    for i, source, text in rows:
        w, t = spaced_words(text), text or ""
        fails = {"A": len(w) < 50, "B": 100 * len(set(w)) < 65 * len(w), "C": 100 * len(re.findall("[A-Z]", t)) > 5 * len(t),
                 "D": bool(re.search("[#$%&*|]", t)), "E": i is not None and i > first[t]}
        parts[source or ""].append((i, {k for k, v in fails.items() if v}))
    out, shapley = {}, collections.Counter()
    for part, found in parts.items():
        for order in itertools.permutations("ABCDE"):
            for k, f in enumerate(order):
                past, upto = set(order[:k]), set(order[: k + 1])
                removed = [i for i, m in found if f in m and not m & past]
                shapley[part, f] += len(removed)
                out[part, "".join(order), k + 1] = (
                    sum(not m & upto for _, m in found), len(removed), sum(f in m and bool(m & past) for _, m in found),
                    sum(m == {f} for _, m in found), sum(i is not None and i in good for i in removed), sum(i is not None and i in toxic for i in removed))
    return {key: (*v, shapley[key[0], key[1][key[2] - 1]]) for key, v in out.items()}
