"""DuckDB SQL of the queries that SQL can express: document fingerprints, the quality ledger, hard
negatives, chat formatting and the trie of conversation prefixes."""

from __future__ import annotations


def _tree(text: str, name: str) -> str:
    """Two further steps on a row with ``text``: leaves by paragraph, then the digests above them."""
    mark = r"!-/:-@\[-`{-~"
    leaf = rf"[^{mark}]{{0,120}}[{mark}]+|[^{mark}]{{1,120}}"
    return f"list_transform(string_split({text}, chr(10)), lambda p: list_transform(regexp_extract_all(p, '{leaf}', 0), lambda x: sha256(x))) AS {name}_leaves"


def _paragraphs(name: str) -> str:
    return f"list_transform({name}_leaves, lambda x: sha256(array_to_string(x, ','))) AS {name}_paragraphs"


def _sections(name: str) -> str:
    runs = f"string_split(array_to_string(list_transform({name}_paragraphs, lambda d: d || CASE WHEN d < '4' THEN ';' ELSE ',' END), ''), ';')"
    return f"list_transform(list_filter({runs}, lambda s: s <> ''), lambda s: sha256(s)) AS {name}_sections"


def _root(name: str) -> str:
    return f"sha256(array_to_string({name}_sections, ',')) AS {name}_root, list_distinct(flatten({name}_leaves)) AS {name}_set"


def _likeness(a: str, b: str) -> str:
    total = f"(len({a}_set) + len({b}_set))"
    return f"CASE WHEN {a}_root = {b}_root THEN 1::DOUBLE WHEN {total} = 0 THEN 0::DOUBLE ELSE 2::DOUBLE * len(list_intersect({a}_set, {b}_set)) / {total} END"


def _difference(a: str, b: str, level: str) -> str:
    x, y = f"{a}_{level}", f"{b}_{level}"
    return f"coalesce(list_filter(range(1, greatest(len({x}), len({y})) + 1), lambda i: {x}[i] IS DISTINCT FROM {y}[i])[1] - 1, -1)::BIGINT"


def _each(step, names=("own", "edit", "next")) -> str:
    return ", ".join(step(n) for n in names)


FINGERPRINTS = f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
n AS (SELECT doc_id, text, coalesce(lead(text) OVER w, first_value(text) OVER w) AS next_text FROM d
      WINDOW w AS (ORDER BY doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)),
e AS (SELECT *, substr(text, 1, length(text) - length(text) // 2) || substr(next_text, 1, length(text) // 2) AS edited FROM n),
leaves AS (SELECT *, {_tree('text', 'own')}, {_tree('edited', 'edit')}, {_tree('next_text', 'next')} FROM e),
paragraphs AS (SELECT *, {_each(_paragraphs)} FROM leaves),
sections AS (SELECT *, {_each(_sections)} FROM paragraphs),
roots AS (SELECT *, {_each(_root)} FROM sections)
SELECT doc_id, length(text)::BIGINT AS n_chars, sha256(edited) AS edited_sha256, own_root AS fingerprint, edit_root AS edited_fingerprint,
       {_likeness('own', 'edit')} AS near_edited, {_likeness('own', 'next')} AS near_next,
       len(own_paragraphs)::BIGINT AS n_paragraphs, len(own_sections)::BIGINT AS n_sections,
       {_difference('own', 'edit', 'sections')} AS edit_section, {_difference('own', 'edit', 'paragraphs')} AS edit_paragraph
FROM roots
"""

_SPACE = r"\x20\x09-\x0D"
_FOLLOWING = ", ".join(f"lead(w, {k}) OVER p" for k in range(1, 8))

QUALITY = rf"""
WITH t AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS text FROM documents),
s AS (SELECT *, list_filter(regexp_split_to_array(text, '[{_SPACE}]'), lambda x: x <> '') AS words,
             list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^{_SPACE}]')) AS lines FROM t),
word AS (SELECT rid, len(words) AS n, unnest(words) AS w, generate_subscripts(words, 1) AS i FROM s),
spans AS (SELECT rid, n, i, concat_ws(' ', w, {_FOLLOWING}) AS span FROM word WINDOW p AS (PARTITION BY rid ORDER BY i)),
twice AS (SELECT rid, i FROM spans WHERE i <= n - 7 QUALIFY count(*) OVER (PARTITION BY rid, span) > 1),
covered AS (SELECT rid, count(DISTINCT place) AS n FROM (SELECT rid, unnest(range(i, i + 8)) AS place FROM twice) GROUP BY rid),
m AS (SELECT doc_id, len(words)::BIGINT AS n_words, coalesce(list_sum(list_transform(words, lambda x: length(x))), 0)::BIGINT AS word_chars,
             length(regexp_replace(text, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols,
             (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines, coalesce(covered.n, 0)::BIGINT AS n_repeat_words,
             len(lines)::BIGINT AS n_lines, length(regexp_replace(text, '[^A-Z]', '', 'g'))::BIGINT AS n_upper
      FROM s LEFT JOIN covered USING (rid)),
f AS (SELECT *, CASE WHEN n_words < 20 THEN 1 ELSE 0 END + CASE WHEN 100 * n_repeat_words > 30 * n_words THEN 2 ELSE 0 END
             + CASE WHEN 10 * n_symbols > n_words THEN 4 ELSE 0 END + CASE WHEN 2 * word_chars < 5 * n_words THEN 8 ELSE 0 END
             + CASE WHEN word_chars > 12 * n_words THEN 16 ELSE 0 END + CASE WHEN 10 * n_dup_lines > 4 * n_lines THEN 32 ELSE 0 END
             + CASE WHEN 10 * n_upper > 4 * word_chars THEN 64 ELSE 0 END AS bits FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_lines, n_upper, bits::BIGINT AS failures,
       n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed,
       NOT (n_words < 20 OR 100 * n_repeat_words > 30 * n_words OR 10 * n_symbols > n_words OR 10 * n_dup_lines > 4 * n_lines) AS kept
FROM f
"""


NEGATIVES = """
WITH g AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS e
           FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
     v AS (SELECT row_number() OVER () AS r, vec_id, label, list_resize(e, (SELECT greatest(2, max(len(e))) FROM g), 0) AS e FROM g),
     s AS (SELECT a.r, a.vec_id AS anchor_id, a.label = b.label AS same, b.vec_id, list_dot_product(a.e, b.e)::BIGINT AS score FROM v AS a JOIN v AS b ON a.r <> b.r WHERE a.vec_id % 50 = 0),
     p AS (SELECT *, row_number() OVER (PARTITION BY r ORDER BY score DESC, vec_id NULLS LAST) AS k FROM s WHERE same QUALIFY k <= 5)
SELECT p.anchor_id, p.vec_id AS positive_id, (row_number() OVER (PARTITION BY p.r, p.k ORDER BY s.score DESC, s.vec_id NULLS LAST))::INT AS rank, s.vec_id AS negative_id,
       p.score AS positive_score, s.score AS negative_score
FROM p JOIN s ON s.r = p.r AND NOT s.same AND 50 * p.score <= 100 * s.score AND 100 * s.score <= 95 * p.score
QUALIFY rank <= 3
"""

def _escaped(col: str) -> str:
    slashes = rf"replace({col}, '\', '\\')"
    return rf"replace(replace({slashes}, '### ', '\### '), '</turn>', '\</turn>')"


CHAT = rf"""
WITH c AS (SELECT conv_id, turn, role AS r, text AS t FROM conversations
           UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok' UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'),
     f AS (SELECT conv_id, turn, r, t, coalesce(r, '') AS role, coalesce(t, '') AS text FROM c),
     g AS (SELECT conv_id, count(*) AS n_turns,
                  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, r NULLS FIRST, t NULLS FIRST)) AS turns_sha256,
                  coalesce(string_agg(CASE WHEN role = 'assistant' THEN text END, '' ORDER BY turn NULLS FIRST, r NULLS FIRST, t NULLS FIRST), '') AS loss,
                  sum(length('### ') + length(replace({_escaped("role")}, ':', '\:')) + length(': ') + length({_escaped("text")}) + length('</turn>') + 1) AS formatted
           FROM f GROUP BY conv_id)
SELECT conv_id, n_turns, turns_sha256, length(loss)::BIGINT AS loss_chars, sha256(loss) AS loss_sha256, formatted::BIGINT AS formatted_chars
FROM g
"""

#: CRC-32 (reflected, polynomial EDB88320) of a text of ASCII characters.
_CRC = """xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split({0}, ''), lambda x: ascii(x)::BIGINT)),
            lambda s, x: list_reduce([xor(s, x), 0, 0, 0, 0, 0, 0, 0, 0], lambda a, z: xor(a >> 1, CASE WHEN a & 1 = 1 THEN 3988292384 ELSE 0 END))))"""

TRIE = f"""
WITH s AS (SELECT conv_id AS c, turn, coalesce(text, '') AS text, sha256(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')) AS said
           FROM conversations WHERE conv_id IS NOT NULL),
     t AS (SELECT *, row_number() OVER (PARTITION BY c ORDER BY turn NULLS FIRST, said) AS pos FROM s),
     k AS (SELECT c, count(*) AS n, ({_CRC.format("c::VARCHAR")} % 6)::BIGINT AS h, c - c % 100 AS b FROM t GROUP BY c),
     r AS (SELECT k.c, t.pos AS d, t.text, t.said FROM k JOIN t ON t.c = k.b WHERE t.pos <= k.h
           UNION ALL SELECT k.c, least(k.h, coalesce(base.n, 0)) + t.pos - k.h, t.text, t.said FROM k JOIN t ON t.c = k.c LEFT JOIN k AS base ON base.c = k.b WHERE t.pos > k.h),
     p AS (SELECT c, d, length(text) AS chars, string_agg(said, '') OVER (PARTITION BY c ORDER BY d) AS key FROM r UNION ALL SELECT c, 0, 0, '' FROM k),
     e AS (SELECT c, max(d) AS whole FROM p GROUP BY c),
     n AS (SELECT p.d, p.key, min(p.c) AS c, count(*) AS n_convs, min(p.chars) AS chars, left(p.key, 64 * (p.d - 1)) AS above, max(e.whole) = p.d AS childless,
                  sha256(coalesce(string_agg(CASE WHEN e.whole = p.d THEN p.c::VARCHAR END, ',' ORDER BY p.c), '')) AS ends_sha256
           FROM p JOIN e ON e.c = p.c GROUP BY p.d, p.key),
     u AS (SELECT p.d, p.key, sum((x.n_convs - 1) * x.chars)::BIGINT AS saved_tokens, sum(x.childless::INT)::BIGINT AS n_leaves
           FROM n AS x JOIN p ON p.c = x.c AND p.d <= x.d GROUP BY p.d, p.key),
     g AS (SELECT d - 1 AS d, above AS key, count(*) AS n_children FROM n WHERE d > 0 GROUP BY ALL)
SELECT n.c AS conv_id, n.d::BIGINT AS depth, y.c AS parent_conv_id, n.n_convs, coalesce(g.n_children, 0) AS n_children, u.n_leaves, u.saved_tokens, n.ends_sha256
FROM n JOIN u ON u.d = n.d AND u.key = n.key LEFT JOIN g ON g.d = n.d AND g.key = n.key LEFT JOIN n AS y ON n.d > 0 AND y.d = n.d - 1 AND y.key = n.above
"""

ORACLE = {"op1_fingerprints": FINGERPRINTS, "op7_quality": QUALITY, "op11_hard_negatives": NEGATIVES, "op12_chat": CHAT, "op13_prefix_trie": TRIE}
