"""SQL counterparts of the queries, where SQL can express them."""

from __future__ import annotations

from starloom.llm import chat_formatting as chat
from starloom.llm import fingerprints as prints
from starloom.llm import quality_rules as rules

ROTATION = rf"""
WITH said AS (
    SELECT conv_id, turn, coalesce(role, '{chat.NO_NAME}') AS role,
        regexp_replace(coalesce(text, ''), '{chat.MARKER}', '<\1|im_', 'g') AS text,
        CAST(floor(turn / {chat.PAGE_TURNS}) AS BIGINT) AS page,
        CASE WHEN conv_id IS NULL THEN row_number() OVER () END AS lone
    FROM conversations
), speakers AS (
    SELECT DISTINCT conv_id, lone, role AS speaker FROM said WHERE role <> 'system'
), ranked AS (
    SELECT *, row_number() OVER (w ORDER BY turn NULLS FIRST, role, text) AS nth, count(*) OVER w AS held
    FROM said WINDOW w AS (PARTITION BY conv_id, lone, page)
), segments AS (
    SELECT s.conv_id, s.lone, speaker, page, role, text, nth,
        CASE WHEN held > {chat.MOST_ROWS * chat.PAGE_TURNS} THEN (nth - 1) // {chat.PAGE_TURNS} ELSE 0 END AS part,
        CASE WHEN role = 'system' THEN '{chat.START}system' || chr(10)
             WHEN role = speaker THEN '{chat.START}assistant' || chr(10)
             ELSE '{chat.START}user name=' || array_to_string(list_transform(
                list_filter(string_split(role, ''), lambda c: c <> ''), lambda c: CASE
                    WHEN regexp_full_match(c, '{chat.IN_NAMES}') THEN c WHEN c = '_' THEN '__'
                    ELSE '_' || lower(hex(c)) || '_' END), '') || chr(10)
        END AS head
    FROM ranked s JOIN speakers p ON s.conv_id IS NOT DISTINCT FROM p.conv_id AND s.lone IS NOT DISTINCT FROM p.lone
), placed AS (
    SELECT *, head || text || '{chat.END}' || chr(10) AS segment,
        coalesce(sum(length(head) + length(text) + {len(chat.END) + 1}) OVER (
            PARTITION BY conv_id, lone, speaker, page, part ORDER BY nth
            ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) + length(head) AS begins
    FROM segments
)
SELECT conv_id, speaker, page, part, CAST(count(*) AS INTEGER) AS n_turns,
    string_agg(segment, '' ORDER BY nth) AS rendered,
    coalesce(string_agg(CASE WHEN role = speaker THEN
        CAST(begins AS BIGINT) || ':' || CAST(begins + length(text) + {len(chat.END)} AS BIGINT) END, ' ' ORDER BY nth), '')
        AS mask
FROM placed GROUP BY conv_id, lone, speaker, page, part
"""


def _tree(text: str) -> str:
    """Columns ``root, lines, pieces`` of the table ``trees_of_<text>``."""
    return f"""
pieces_{text} AS (
    SELECT doc_id, list_transform(string_split({text}, chr(10)), lambda line: list_transform(
        regexp_extract_all(line, '{prints.PIECE}'), lambda p: substr(sha256(p), 1, {prints.DIGITS}))) AS leaves
    FROM pairs
), lines_{text} AS (
    SELECT doc_id, flatten(leaves) AS pieces, list_transform(leaves, lambda row:
        substr(sha256(array_to_string(row, ' ')), 1, {prints.DIGITS})) AS lines
    FROM pieces_{text}
), parts_{text} AS (
    SELECT *, string_split(array_to_string(list_transform(lines, lambda h: h || CASE
        WHEN starts_with(h, '{prints.SECTION_END}') THEN ' |' ELSE ' ' END), ''), '|') AS parts
    FROM lines_{text}
), tree_{text} AS (
    SELECT *, list_histogram(pieces) AS counts, sha256(array_to_string(list_transform(parts, lambda part:
        substr(sha256(part), 1, {prints.DIGITS})), ' ')) AS root
    FROM parts_{text}
)"""


def _likeness(a: str, b: str) -> str:
    counts = f"least({a}.counts[k], coalesce({b}.counts[k], 0))"
    return f"""CASE WHEN {a}.root = {b}.root THEN 1.0::DOUBLE
        ELSE 2.0::DOUBLE * coalesce(list_sum(list_transform(map_keys({a}.counts), lambda k: {counts})), 0)
            / (len({a}.pieces) + len({b}.pieces) + 2) END"""


def _equal_beginning(a: str, b: str) -> str:
    same = f"list_position(list_transform(list_zip({a}, {b}), lambda z: z[1] IS NOT DISTINCT FROM z[2]), false)"
    return f"CASE WHEN coalesce({same}, 0) > 0 THEN {same} - 1 ELSE len({a}) END"


FINGERPRINTS = f"""
WITH docs AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
nexts AS (
    SELECT doc_id, text, coalesce(lead(text) OVER (ORDER BY doc_id DESC),
        first_value(text) OVER (ORDER BY doc_id DESC)) AS next_text
    FROM docs
), pairs AS (
    SELECT *, substr(text, 1, length(text) - length(text) // 3) || substr(next_text, 1, length(text) // 3) AS edited
    FROM nexts
), {_tree("text")}, {_tree("edited")}, {_tree("next_text")}
SELECT p.doc_id, length(p.text) AS n_chars, sha256(p.edited) AS edited_sha256,
    a.root AS fingerprint, b.root AS edited_fingerprint,
    {_likeness("a", "b")} AS near_edited, {_likeness("a", "c")} AS near_next,
    CAST(CASE WHEN a.root = b.root THEN 0 ELSE {_equal_beginning("a.lines", "b.lines")} END AS INTEGER)
        AS first_changed_paragraph,
    CAST(CASE WHEN a.root = b.root THEN 0 ELSE len(a.lines) - {_equal_beginning("a.lines", "b.lines")} - least(
        {_equal_beginning("list_reverse(a.lines)", "list_reverse(b.lines)")},
        least(len(a.lines), len(b.lines)) - {_equal_beginning("a.lines", "b.lines")}) END AS INTEGER)
        AS n_changed_paragraphs
FROM pairs p JOIN tree_text a USING (doc_id) JOIN tree_edited b USING (doc_id) JOIN tree_next_text c USING (doc_id)
"""

WORD = r"[^\x20\x09-\x0D]+"
RULES = f"""
WITH docs AS (SELECT doc_id, source, coalesce(text, '') AS text FROM documents),
words AS (SELECT doc_id, regexp_extract_all(text, '{WORD}') AS words FROM docs),
windows AS (
    SELECT doc_id, nth, array_to_string(words[nth:nth + {rules.WINDOW_WORDS - 1}], ' ') AS said
    FROM words, LATERAL (SELECT unnest(range(1, len(words) - {rules.WINDOW_WORDS - 2})) AS nth)
), again AS (
    SELECT doc_id, nth FROM windows QUALIFY count(*) OVER (PARTITION BY doc_id, said) > 1
), repeated AS (
    SELECT doc_id, count(DISTINCT nth + step) AS n_repeat_words
    FROM again, (SELECT unnest(range({rules.WINDOW_WORDS})) AS step) GROUP BY doc_id
), lines AS (
    SELECT doc_id, line, count(*) AS n
    FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM docs)
    WHERE regexp_matches(line, '{WORD}') GROUP BY doc_id, line
), dups AS (SELECT doc_id, CAST(sum(n - 1) AS BIGINT) AS n_dup_lines FROM lines GROUP BY doc_id),
measures AS (
    SELECT doc_id, source, len(words) AS n_words,
        CAST(coalesce(list_sum(list_transform(words, lambda w: length(w))), 0) AS BIGINT) AS word_chars,
        CAST(length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
        coalesce(n_dup_lines, 0) AS n_dup_lines, coalesce(n_repeat_words, 0) AS n_repeat_words
    FROM docs JOIN words USING (doc_id) LEFT JOIN dups USING (doc_id) LEFT JOIN repeated USING (doc_id)
), judged AS (
    SELECT *, n_words < {rules.LEAST_WORDS}
        OR 100 * n_repeat_words > {rules.MOST_REPEATED_PERCENT} * n_words AS base_failed
    FROM measures
), hosts AS (
    SELECT source, count(*) AS n, CAST(sum(CAST(base_failed AS INTEGER)) AS BIGINT) AS f FROM judged GROUP BY source
), sums AS (
    SELECT CAST(sum(n) AS DOUBLE) AS n, CAST(sum(f) AS DOUBLE) AS f, count(*) AS hosts,
        sum(CAST(f AS DOUBLE) * f / n) AS ff, sum(CAST(n AS DOUBLE) * n) AS nn FROM hosts
), prior AS (
    SELECT f / n AS m, n - nn / n - (hosts - 1) AS room,
        CASE WHEN f > 0 AND f < n AND n - nn / n - (hosts - 1) > 0
            THEN ((ff - f / n * f) / (f / n * (1 - f / n)) - (hosts - 1)) / (n - nn / n - (hosts - 1)) ELSE 0 END AS c
    FROM sums
), strength AS (
    SELECT m, CASE WHEN c > 0 THEN least(greatest(1 / c - 1, {rules.WEAKEST}), {rules.STRONGEST})
        ELSE {rules.STRONGEST} END AS s
    FROM prior
), verdicts AS (
    SELECT source, (f + s * m) / (n + s) <= {rules.MOST_FAILING} AS host_kept FROM hosts, strength
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
    NOT base_failed AND host_kept AS kept
FROM judged JOIN verdicts v ON judged.source IS NOT DISTINCT FROM v.source
"""

NEGATIVES = """
WITH vectors AS (
    SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (CAST(label AS BIGINT) + 1) % 10 ELSE label END AS label,
        list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v, row_number() OVER () AS rid
    FROM embeddings
    WHERE label IS NOT NULL AND embedding IS NOT NULL
        AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
    SELECT a.rid AS anchor, a.vec_id AS anchor_id, r.vec_id, a.label = r.label AS same,
        CAST(list_inner_product(a.v, r.v) AS BIGINT) AS score
    FROM vectors a JOIN vectors r ON a.rid <> r.rid WHERE a.vec_id % 100 = 0
), positives AS (
    SELECT anchor, vec_id AS positive_id, score AS positive_score FROM scored WHERE same
    QUALIFY row_number() OVER (PARTITION BY anchor ORDER BY score DESC, vec_id) <= 5
)
SELECT anchor_id, positive_id, CAST(row_number() OVER w AS INTEGER) AS rank, vec_id AS negative_id,
    positive_score, score AS negative_score
FROM positives JOIN scored USING (anchor)
WHERE NOT same AND 80 * positive_score <= 100 * score AND score <= positive_score
WINDOW w AS (PARTITION BY anchor, positive_id ORDER BY score DESC, vec_id)
QUALIFY rank <= 5
"""

PHRASES = r"""
WITH lowered AS (
    SELECT coalesce(lang, 'und') AS lang, translate(coalesce(text, ''),
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text
    FROM documents
), pieces AS (
    SELECT lang, unnest(string_split_regex(text, '[.,;:!?\x0A-\x0D]')) AS piece FROM lowered
), worded AS (
    SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS words FROM pieces
), counted AS (
    SELECT lang, size, phrase, count(*) AS f FROM (
        SELECT lang, size, array_to_string(list_slice(words, nth, nth + size - 1), ' ') AS phrase
        FROM worded, range(1, 5) AS s(size), LATERAL (SELECT unnest(range(1, len(words) - size + 2)) AS nth)
    ) GROUP BY ALL
), totals AS (
    SELECT lang, CAST(sum(f) AS BIGINT) AS n FROM counted WHERE size = 1 GROUP BY lang
), candidates AS (
    SELECT lang, phrase, size, f AS a, string_split(phrase, ' ') AS words FROM counted WHERE size > 1 AND f >= 30
), covered AS (
    SELECT DISTINCT c.lang, part AS phrase FROM (
        SELECT c.lang, array_to_string(list_slice(words, nth, nth + s.size - 1), ' ') AS part, c.a AS longer
        FROM candidates c, range(2, 4) AS s(size), LATERAL (SELECT unnest(range(1, c.size - s.size + 2)) AS nth)
        WHERE s.size < c.size
    ) p JOIN candidates c ON c.lang = p.lang AND c.phrase = part WHERE 100 * longer >= 80 * c.a
), cut AS (
    SELECT c.lang, c.phrase, a, k, x.f AS l, y.f AS r, CAST(2000000 * CAST(a AS HUGEINT) // (x.f + y.f) AS BIGINT) AS score
    FROM (SELECT *, unnest(range(1, size)) AS k FROM candidates ANTI JOIN covered USING (lang, phrase)) c
    JOIN counted x ON x.lang = c.lang AND x.phrase = array_to_string(list_slice(words, 1, k), ' ')
    JOIN counted y ON y.lang = c.lang AND y.phrase = array_to_string(list_slice(words, k + 1, c.size), ' ')
), lowest AS (
    SELECT * FROM cut QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1
)
SELECT lang, row_number() OVER w AS rank, phrase, a, l, r, n, score
FROM lowest JOIN totals USING (lang)
WINDOW w AS (PARTITION BY lang ORDER BY score DESC, a DESC, phrase)
QUALIFY rank <= 2000
"""

ORACLES: dict[str, str] = {
    "op3_perspective_rotation": ROTATION,
    "op4_merkle_fingerprints": FINGERPRINTS,
    "op9_quality_rules": RULES,
    "op11_hard_negatives": NEGATIVES,
    "op12_phrase_mining": PHRASES,
}
