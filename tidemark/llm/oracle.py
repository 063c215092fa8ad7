"""SQL twins of the text queries that SQL can express.

Not here: op1, op3 and op8 fit models, op11 merges by a vocabulary, op4 and op7 need positions of pattern matches and, besides, a
test battery and trees; the pipeline has such a stage too. Those are tested against brute force or
held-out labels.
"""

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

_MEASURES = ("symbol_rate", "repeat_rate", "dup_line_rate", "word_length")
_SLACK = {
    "symbol_rate": ("n_symbols", "word_chars", 4, 500), "repeat_rate": ("n_repeat_words", "n_words", 10, 100),
    "dup_line_rate": ("n_dup_lines", "n_lines", 1, 10),
}


def _limits(level: str, keys: str) -> str:
    group = f"{keys}, " if keys else ""
    by = f"GROUP BY {keys}" if keys else ""
    columns = ", ".join(
        f"max(CASE WHEN measure = '{m}' THEN high END) AS max_{m}" for m in _MEASURES
    )
    return f"""
{level}_q AS (
  SELECT {group}measure, max(total) AS n,
         min(low) FILTER (upto * 4 >= total) AS q1, min(low) FILTER (upto * 4 >= total * 2) AS q2,
         min(low) FILTER (upto * 4 >= total * 3) AS q3, min(low) FILTER (upto * 10 >= total * 9) AS d9,
         min(last) FILTER (upto * 10 >= total * 9) AS top
  FROM (SELECT {group}measure, low, last, sum(n) OVER (PARTITION BY {group}measure ORDER BY low) AS upto,
               sum(n) OVER (PARTITION BY {group}measure) AS total
        FROM (SELECT {group}measure, low, last, count(*) AS n FROM binned GROUP BY {group}measure, low, last))
  GROUP BY {group}measure),
{level} AS (
  SELECT {group}max(n) AS n, {columns}, max(CASE WHEN measure = 'word_length' THEN low END) AS min_word_length
  FROM (SELECT *, CASE WHEN measure = 'word_length' THEN greatest(q3 + 4 * (q3 - q1), 2 * q2) ELSE top + 3 * (d9 - q2) END AS high,
               least(q1 - 4 * (q3 - q1), q2 // 2) AS low
        FROM {level}_q) {by})"""


def _op2() -> str:
    pick = lambda c: (
        f"CASE WHEN g.n >= 50 THEN g.{c} WHEN l.n >= 50 THEN l.{c} ELSE o.{c} END"
    )
    def within(m: str) -> str:
        limit = f"coalesce({pick(f'max_{m}')}, {m})"
        if m not in _SLACK:
            return f"{m} <= {limit}"
        n, size, least, unit = _SLACK[m]
        return f"({m} <= {limit} OR 1000 * {n} - {limit} * {size} <= 1000.0::DOUBLE * {least} * greatest(1.0::DOUBLE, sqrt({size}::DOUBLE / {unit})))"

    fits = " AND ".join(map(within, _MEASURES))
    return f"""
WITH t AS (
  SELECT row_number() OVER () AS r, doc_id, lang, source, coalesce(text, '') AS text,
         regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
windows AS (
  SELECT r, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] || ' ' || w[i + 3] || ' ' || w[i + 4] AS g
  FROM (SELECT r, w, unnest(range(1, len(w) - 3)) AS i FROM t)),
twice AS (SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, g) AS n FROM windows) WHERE n > 1),
covered AS (SELECT r, count(DISTINCT j) AS n FROM (SELECT r, unnest(range(i, i + 5)) AS j FROM twice) GROUP BY r),
counts AS (
  SELECT t.r, doc_id, lang, source, len(w)::BIGINT AS n_words, coalesce(list_sum(list_transform(w, lambda x: length(x))), 0)::BIGINT AS word_chars,
         len(regexp_extract_all(text, '[#*$%&|<>]'))::BIGINT AS n_symbols,
         (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines, coalesce(c.n, 0)::BIGINT AS n_repeat_words,
         len(lines) AS n_lines
  FROM (SELECT *, list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS lines FROM t) t
  LEFT JOIN covered c ON c.r = t.r),
rates AS (
  SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed,
         1000 * n_symbols // greatest(word_chars, 1) AS symbol_rate, 1000 * n_repeat_words // greatest(n_words, 1) AS repeat_rate,
         1000 * n_dup_lines // greatest(n_lines, 1) AS dup_line_rate, 100 * word_chars // greatest(n_words, 1) AS word_length
  FROM counts),
long AS (UNPIVOT (SELECT lang, source, symbol_rate, repeat_rate, dup_line_rate, word_length FROM rates WHERE NOT base_failed)
         ON symbol_rate, repeat_rate, dup_line_rate, word_length INTO NAME measure VALUE value),
binned AS (
  SELECT lang, source, measure,
         CASE WHEN value < 32 THEN value ELSE (value >> (length(bin(value)) - 5)) << (length(bin(value)) - 5) END AS low,
         CASE WHEN value < 32 THEN value ELSE (((value >> (length(bin(value)) - 5)) + 1) << (length(bin(value)) - 5)) - 1 END AS last
  FROM long),
{_limits("g", "lang, source")}, {_limits("l", "lang")}, {_limits("o", "")}
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND {fits} AND word_length >= coalesce({pick('min_word_length')}, -1) AS kept
FROM rates
LEFT JOIN g ON g.lang IS NOT DISTINCT FROM rates.lang AND g.source IS NOT DISTINCT FROM rates.source
LEFT JOIN l ON l.lang IS NOT DISTINCT FROM rates.lang
LEFT JOIN o ON true
"""


_OP5 = """
WITH RECURSIVE d AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+'))::BIGINT AS n_tokens,
         md5(coalesce(doc_id::VARCHAR, '') || ':' || coalesce(length(text)::VARCHAR, '')) AS k FROM documents),
s AS (SELECT source, sum(n_tokens)::BIGINT AS tokens FROM d GROUP BY source),
p AS (SELECT tokens / (SELECT sum(tokens)::DOUBLE FROM s) AS p FROM s WHERE tokens > 0),
g AS (SELECT floor(sum(tokens) * 1.5)::BIGINT AS budget, sum(tokens)::DOUBLE AS total FROM s),
h AS (SELECT own, own + 0.5 * (ln(n) - own) AS wanted FROM (SELECT ln(sum(p)) - sum(p * ln(p)) / sum(p) AS own, count(*) AS n FROM p)),
e AS (  -- bisect for the largest exponent whose entropy is high enough, then for repetition
  SELECT 0 AS i, 0.0::DOUBLE AS low, 1.0::DOUBLE AS high
  UNION ALL
  SELECT i + 1, CASE WHEN ok THEN mid ELSE low END, CASE WHEN ok THEN high ELSE mid END
  FROM (SELECT i, low, high, (low + high) / 2 AS mid,
               (SELECT ln(sum(pow(p, (low + high) / 2))) - (low + high) / 2 * sum(pow(p, (low + high) / 2) * ln(p)) / sum(pow(p, (low + high) / 2))
                       >= (SELECT wanted FROM h) FROM p) AS ok
        FROM e WHERE i < 32)),
a AS (SELECT CASE WHEN (SELECT own >= wanted FROM h) THEN 1.0
                  ELSE (SELECT low FROM e WHERE i = 32) END AS a),
f AS (
  SELECT 0 AS i, a AS low, 1.0::DOUBLE AS high FROM a
  UNION ALL
  SELECT i + 1, CASE WHEN over THEN mid ELSE low END, CASE WHEN over THEN high ELSE mid END
  FROM (SELECT i, low, high, (low + high) / 2 AS mid,
               (SELECT (SELECT budget / total FROM g) * pow(min(p), (low + high) / 2 - 1) / sum(pow(p, (low + high) / 2)) > 4.0 FROM p) AS over
        FROM f WHERE i < 32)),
x AS (SELECT CASE WHEN (SELECT (SELECT budget / total FROM g) * pow(min(p), a - 1) / sum(pow(p, a)) > 4.0 FROM p) THEN (SELECT high FROM f WHERE i = 32) ELSE a END AS a FROM a),
w AS (
  SELECT source, tokens, CASE WHEN tokens > 0 THEN pow(tokens / (SELECT sum(tokens)::DOUBLE FROM s), (SELECT a FROM x))
         / (SELECT sum(pow(p, (SELECT a FROM x))) FROM p) ELSE 0.0 END AS weight FROM s),
q AS (
  SELECT *, CASE WHEN tokens > 0 THEN quota // tokens ELSE 1 END AS epochs, CASE WHEN tokens > 0 THEN quota % tokens ELSE 0 END AS rest
  FROM (SELECT *, floor(weight * (SELECT budget::DOUBLE FROM g) + 0.5)::BIGINT AS quota FROM w)),
b AS (
  SELECT *, sum(n) OVER (PARTITION BY source ORDER BY turn) AS upto
  FROM (SELECT d.source, substr(k, 1, 3) AS block, any_value(q.rest) AS rest, sum(n_tokens) AS n,
               md5(coalesce(d.source, '') || '|' || any_value(q.epochs)::VARCHAR || '|' || substr(k, 1, 3)) AS turn
        FROM d JOIN q ON d.source IS NOT DISTINCT FROM q.source GROUP BY d.source, substr(k, 1, 3))),
edge AS (SELECT source, min(turn) AS turn, arg_min(block, turn) AS block, arg_min(rest - (upto - n), turn) AS room FROM b WHERE upto > rest GROUP BY source),
cut AS (
  SELECT source, max(k) AS cutoff
  FROM (SELECT d.source, k, edge.room, sum(n_tokens) OVER (PARTITION BY d.source ORDER BY k) AS upto
        FROM d JOIN edge ON d.source IS NOT DISTINCT FROM edge.source AND substr(k, 1, 3) = edge.block)
  WHERE upto <= room GROUP BY source),
n AS (
  SELECT d.*, q.weight, substr(k, 1, 3) AS block,
         q.epochs + coalesce((b.turn < edge.turn OR (b.turn = edge.turn AND k <= coalesce(cut.cutoff, '')))::INT, 0) AS copies
  FROM d JOIN q ON d.source IS NOT DISTINCT FROM q.source
  JOIN b ON d.source IS NOT DISTINCT FROM b.source AND substr(k, 1, 3) = b.block
  LEFT JOIN edge ON d.source IS NOT DISTINCT FROM edge.source LEFT JOIN cut ON d.source IS NOT DISTINCT FROM cut.source)
SELECT doc_id, source, n_tokens, round(weight, 12) AS weight, epoch::INTEGER AS epoch, block,
       md5(coalesce(source, '') || '|' || epoch::VARCHAR || '|' || block) || k AS place
FROM (SELECT *, unnest(range(copies)) AS epoch FROM n)
"""

# The table of CRC-32 by its polynomial, and the checksum of a text by it.
_CRC_TABLE = """steps(i, k, c) AS (
  SELECT range, 0, range FROM range(256)
  UNION ALL SELECT i, k + 1, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END FROM steps WHERE k < 8),
crc AS (SELECT list(c ORDER BY i) AS t FROM steps WHERE k = 8)"""


def _crc(text: str) -> str:
    return f"""xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(
           regexp_extract_all(hex(encode({text})), '..'), lambda h: ('0x' || h)::BIGINT)),
           lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295::BIGINT)"""


_OP6 = f"""
WITH RECURSIVE {_CRC_TABLE},
d AS (
  SELECT doc_id, md5(text) AS k, strlen(coalesce(text, ''))::BIGINT + 16 AS size, {_crc("coalesce(text, '')")} AS text_crc32
  FROM documents, crc),
s AS (
  SELECT *, sum(size) OVER (ORDER BY k NULLS FIRST, doc_id NULLS FIRST ROWS UNBOUNDED PRECEDING) - size AS before,
         sum(size) OVER () AS total, row_number() OVER (ORDER BY k NULLS FIRST, doc_id NULLS FIRST) AS place FROM d),
c AS (SELECT *, least(39, (40 * (2 * before + size)) // (2 * total))::INTEGER AS shard FROM s)
SELECT doc_id, size, text_crc32, 'bytes' AS law, shard,
       (place - min(place) OVER (PARTITION BY shard))::BIGINT AS slot, NULL::INTEGER AS grown_shard FROM c
"""

_OP9 = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id,
                  regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM documents),
b AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM benchmark),
p AS (SELECT DISTINCT item_id, least(len(w), 10) AS n, array_to_string(w[i : i + least(len(w), 10) - 1], ' ') AS g
      FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i FROM b WHERE len(w) > 0)),
g AS (SELECT r, i, n, array_to_string(w[i : i + n - 1], ' ') AS g
      FROM (SELECT r, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, (SELECT DISTINCT n FROM p))),
h AS (SELECT r, i, g.n, item_id FROM g JOIN p ON g.g = p.g AND g.n = p.n),
c AS (SELECT r, count(DISTINCT j) AS n FROM (SELECT r, unnest(range(i, i + n)) AS j FROM h) GROUP BY r),
m AS (SELECT r, count(DISTINCT item_id) AS n, string_agg(DISTINCT item_id::VARCHAR, ',' ORDER BY item_id::VARCHAR) AS ids FROM h GROUP BY r)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(c.n, 0)::BIGINT AS n_hit, coalesce(m.n, 0)::BIGINT AS n_items,
       sha256(coalesce(m.ids, '')) AS items_sha256, coalesce(c.n, 0) > 0 AS contaminated
FROM d LEFT JOIN c USING (r) LEFT JOIN m USING (r)
"""

_OP10 = f"""
WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, array_to_string(w[i : i + 2], ' ') AS g
      FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 2, 1) + 1)) AS i FROM d WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
links AS (
  SELECT a, b FROM (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS k FROM s x JOIN s y USING (g) WHERE x.doc_id <> y.doc_id GROUP BY ALL)
  JOIN n na ON na.doc_id = a JOIN n nb ON nb.doc_id = b WHERE 100 * k >= 90 * (na.n + nb.n - k)),
reach AS (SELECT doc_id AS a, doc_id AS b FROM d UNION SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a)
SELECT doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, c.component_id
FROM d LEFT JOIN n USING (doc_id) JOIN (SELECT a AS doc_id, min(b) AS component_id FROM reach GROUP BY a) c USING (doc_id)
"""

def _op12(levels: int = 7) -> str:
    """Trees of up to 8 ** levels leaves: each level a grouping by the place divided by eight."""

    def leaf(text: str) -> str:
        parts = [f"CASE WHEN {c} IS NULL THEN '-' ELSE strlen({c}::VARCHAR) || ':' || {c}::VARCHAR END"
                 for c in ("doc_id", "source", "lang", "n_chars", text)]
        return "sha256(" + " || ".join(parts) + ")"

    def tree(name: str) -> list[str]:
        return [f"""{name}{k + 1} AS (
  SELECT g, i // 8 AS i, (max(n) + 7) // 8 AS n, CASE WHEN max(n) = 1 THEN max(h) ELSE sha256(string_agg(h, '' ORDER BY i)) END AS h
  FROM {name}{k} GROUP BY g, i // 8)""" for k in range(levels)]

    def folds(name: str, key: str, source: str) -> list[str]:
        """Level by level: the runs that nodes lie in, and what leaf and siblings make of ``source``."""
        out = []
        for k in range(levels):
            out.append(f"""{name}p{k} AS (
  SELECT x.{key}, coalesce(string_agg(y.h, '' ORDER BY y.i) FILTER (WHERE y.i < x.i // {8 ** k}), '') AS before,
         coalesce(string_agg(y.h, '' ORDER BY y.i) FILTER (WHERE y.i > x.i // {8 ** k}), '') AS after, max(y.n) > 1 AS more
  FROM {name}0 x JOIN {name}{k} y ON x.g = y.g AND x.i // {8 ** (k + 1)} = y.i // 8 GROUP BY x.{key})""")
            out.append(f"""{name}f{k} AS (
  SELECT s.r, s.name, s.doc_id, s.leaf, s.proof || w.before || w.after AS proof,
         CASE WHEN w.more THEN sha256(w.before || s.folded || w.after) ELSE s.folded END AS folded
  FROM {source} s JOIN {name}p{k} w USING ({key}))""")
            source = f"{name}f{k}"
        return out

    lower = leaf(f"translate(text, '{UPPER}', '{LOWER}')")
    checksum = _crc("coalesce(doc_id::VARCHAR, '')")
    ctes = [
        _CRC_TABLE,
        f"""d AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce('=' || lang, '') AS name, {leaf("text")} AS leaf, '' AS proof,
         CASE WHEN {checksum} % 3 = 0 THEN {lower} ELSE {leaf("text")} END AS folded FROM documents, crc)""",
        """a0 AS (SELECT name AS g, row_number() OVER (PARTITION BY name ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i,
  count(*) OVER (PARTITION BY name) AS n, leaf AS h, r FROM d)""",
        *tree("a"),
        f"b0 AS (SELECT '' AS g, row_number() OVER (ORDER BY g) - 1 AS i, count(*) OVER () AS n, h, g AS name FROM a{levels})",
        *tree("b"), *folds("a", "r", "d"), *folds("b", "name", f"af{levels - 1}"),
    ]
    return f"""
WITH RECURSIVE {", ".join(ctes)}
SELECT f.doc_id, f.leaf, a.h AS subroot, b.h AS root, sha256(f.proof) AS proof_sha256, f.folded AS folded_root, f.folded = b.h AS verified
FROM bf{levels - 1} f JOIN a{levels} a ON f.name = a.g, b{levels} b
"""


_OP13 = """
WITH l AS (SELECT doc_id, max(coalesce(quality = 1, false)::INT) AS good, max(coalesce(toxic = 1, false)::INT) AS toxic FROM labels GROUP BY doc_id),
t AS (SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS text,
             regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
m AS (SELECT part, good, toxic,
             (len(w) < 50)::INT + 2 * (100 * len(list_distinct(w)) < 65 * len(w))::INT
             + 4 * (100 * len(regexp_replace(text, '[^A-Z]', '', 'g')) > 5 * length(text))::INT
             + 8 * regexp_matches(text, '[#$%&*|]')::INT
             + 16 * coalesce(doc_id > min(doc_id) OVER (PARTITION BY text), false)::INT AS mask
      FROM t LEFT JOIN l USING (doc_id)),
c AS (SELECT part, mask, count(*) AS n, coalesce(sum(good), 0) AS good, coalesce(sum(toxic), 0) AS toxic FROM m GROUP BY part, mask),
x AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS f, unnest([1, 2, 4, 8, 16]) AS b),
o AS (SELECT a.f || b.f || c.f || d.f || e.f AS filter_order, [a.b, b.b, c.b, d.b, e.b] AS bits
      FROM x a, x b, x c, x d, x e WHERE len(list_distinct([a.f, b.f, c.f, d.f, e.f])) = 5),
s AS (SELECT filter_order, step, bits[step] AS bit, coalesce(list_sum(bits[1 : step - 1]), 0)::INT AS past
      FROM (SELECT *, unnest(range(1, 6))::INTEGER AS step FROM o)),
r AS (SELECT part, filter_order, step, bit,
             sum(CASE WHEN mask & (past | bit) = 0 THEN n ELSE 0 END)::BIGINT AS kept,
             sum(CASE WHEN mask & past = 0 AND mask & bit <> 0 THEN n ELSE 0 END)::BIGINT AS removed,
             sum(CASE WHEN mask & past <> 0 AND mask & bit <> 0 THEN n ELSE 0 END)::BIGINT AS redundant,
             sum(CASE WHEN mask = bit THEN n ELSE 0 END)::BIGINT AS unique_fails,
             sum(CASE WHEN mask & past = 0 AND mask & bit <> 0 THEN good ELSE 0 END)::BIGINT AS good_lost,
             sum(CASE WHEN mask & past = 0 AND mask & bit <> 0 THEN toxic ELSE 0 END)::BIGINT AS toxic_lost
      FROM c, s GROUP BY part, filter_order, step, bit)
SELECT part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
       (sum(removed) OVER (PARTITION BY part, bit))::BIGINT AS shapley FROM r
"""

ORACLE = {
    "op2_adaptive_rules": _op2(),
    "op5_temperature_mix": _OP5,
    "op6_prefix_sum_shards": _OP6,
    "op9_fm_index_decontamination": _OP9,
    "op10_jaccard_join": _OP10,
    "op12_merkle_manifest": _op12(),
    "op13_filter_audit": _OP13,
}
