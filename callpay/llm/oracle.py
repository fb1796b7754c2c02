"""SQL counterparts of the queries that SQL can express.

The others rest on seeded hashes, a knapsack, fitted weights, compression or checksums that SQL lacks; their tests hold
them against plain restatements.
"""

from __future__ import annotations

_WORD = r"[^\x20\x09-\x0D]+"
_ALNUM = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def _lower(text: str) -> str:
    """A-Z to small letters only."""
    return f"translate(coalesce({text}, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


_ESCAPE = (
    r"regexp_replace({}, '([<\[])(\\*)(\|[^|<>\[\]]{{1,64}}\|>|/?s>|/?(?:bos|eos|pad|unk|mask|start_of_turn|end_of_turn)>|/?INST\]|</?SYS>>)', '\1\\\2\3', 'g')"
)

OP2 = f"""
WITH turns AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
    UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]'
    UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'
), placed AS (
    SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS i,
           count(*) OVER (PARTITION BY conv_id) AS n,
           length({_ESCAPE.format("role")}) + length({_ESCAPE.format("text")}) + length('<|turn|><|text|><|end|>') AS shown
    FROM turns
), grown AS (SELECT *, sum(shown) OVER (PARTITION BY conv_id ORDER BY i) AS so_far FROM placed)
SELECT conv_id, any_value(n) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY i)) AS turns_sha256,
       coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY i) FILTER (role = 'assistant'), '')) AS loss_sha256,
       sum(so_far) FILTER (role = 'assistant' OR i = n)::BIGINT AS formatted_chars
FROM grown GROUP BY conv_id
"""

OP4 = f"""
WITH texts AS (SELECT doc_id, regexp_extract_all({_lower("text")}, '{_ALNUM}') AS w FROM documents),
items AS (SELECT item_id, regexp_extract_all({_lower("text")}, '{_ALNUM}') AS w FROM benchmark),
marks AS (
    SELECT item_id, least(len(w), 10) AS size, array_to_string(list_slice(w, i, i + 9), ' ') AS words
    FROM items, unnest(range(1, greatest(len(w) - 8, 2))) AS u(i) WHERE len(w) > 0
), sizes AS (SELECT DISTINCT size FROM marks),
runs AS (
    SELECT doc_id, size, i, array_to_string(list_slice(w, i, i + size - 1), ' ') AS words
    FROM texts, sizes, unnest(range(1, len(w) - size + 2)) AS u(i)
), hits AS (SELECT DISTINCT doc_id, i, runs.size, item_id FROM runs JOIN marks ON runs.size = marks.size AND runs.words = marks.words),
places AS (SELECT doc_id, count(DISTINCT i + k) AS n FROM hits, unnest(range(0, size)) AS u(k) GROUP BY doc_id),
found AS (
    SELECT doc_id, count(*) AS n, string_agg(item, ',' ORDER BY item) AS ids
    FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item FROM hits) GROUP BY doc_id
)
SELECT t.doc_id, len(w)::BIGINT AS n_words, coalesce(p.n, 0)::BIGINT AS n_hit, coalesce(f.n, 0)::BIGINT AS n_items,
       sha256(coalesce(f.ids, '')) AS items_sha256, coalesce(p.n, 0) > 0 AS contaminated
FROM texts t LEFT JOIN places p USING (doc_id) LEFT JOIN found f USING (doc_id)
"""

OP9 = f"""
WITH RECURSIVE texts AS (SELECT doc_id, regexp_extract_all({_lower("text")}, '{_WORD}') AS w FROM documents),
shingles AS (
    SELECT DISTINCT doc_id, array_to_string(list_slice(w, i, i + 3), ' ') AS s
    FROM texts, unnest(range(1, greatest(len(w) - 2, 2))) AS u(i) WHERE len(w) > 0
), sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
pairs AS (
    SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS n FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY 1, 2
), links AS (
    SELECT a, b FROM pairs p JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b
    WHERE 100 * p.n >= 85 * (x.n + y.n - p.n)
), edges AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach AS (SELECT a AS doc_id, a AS other FROM edges UNION SELECT r.doc_id, l.b FROM reach r JOIN edges l ON l.a = r.other)
SELECT t.doc_id, coalesce(any_value(z.n), 0)::BIGINT AS n_shingles, least(t.doc_id, min(r.other)) AS component_id
FROM texts t LEFT JOIN sizes z USING (doc_id) LEFT JOIN reach r USING (doc_id) GROUP BY t.doc_id
"""

_RULES = {
    "short": "n_words < 20",
    "repeats": "100 * n_repeat_words > 30 * n_words",
    "symbols": "10 * n_symbols > word_chars",
    "dup_lines": "100 * n_dup_lines > 10 * n_words",
}


def _host_rules() -> str:
    bad = ", ".join(f"count(*) FILTER ({rule}) AS bad_{name}" for name, rule in _RULES.items())
    moments = ", ".join(f"avg(bad_{r} / docs) AS mean_{r}, var_samp(bad_{r} / docs) AS spread_{r}" for r in _RULES)
    weights = ", ".join(
        f"CASE WHEN spread_{r} > 0 THEN greatest(mean_{r} * (1 - mean_{r}) / spread_{r} - 1, 1.0) ELSE 1.0 END AS weight_{r}" for r in _RULES
    )
    kept = " AND ".join(f"(bad_{r} + mean_{r} * weight_{r}) / (docs + weight_{r}) <= 0.5" for r in _RULES)
    return f"""
WITH texts AS (SELECT doc_id, source, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '{_WORD}') AS w FROM documents),
windows AS (SELECT doc_id, i, array_to_string(list_slice(w, i, i + 7), ' ') AS s FROM texts, unnest(range(1, len(w) - 6)) AS u(i)),
again AS (SELECT doc_id, i FROM windows QUALIFY count(*) OVER (PARTITION BY doc_id, s) > 1),
repeated AS (SELECT doc_id, count(DISTINCT i + k) AS n FROM again, unnest(range(0, 8)) AS u(k) GROUP BY doc_id),
lines AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM texts),
doubled AS (SELECT doc_id, count(*) - count(DISTINCT line) AS n FROM lines WHERE regexp_matches(line, '{_WORD}') GROUP BY doc_id),
measured AS (
    SELECT t.doc_id, t.source, len(w)::BIGINT AS n_words, length(array_to_string(w, ''))::BIGINT AS word_chars,
           (length(text) - length(translate(text, '#*$%&|<>', '')))::BIGINT AS n_symbols,
           coalesce(d.n, 0)::BIGINT AS n_dup_lines, coalesce(r.n, 0)::BIGINT AS n_repeat_words
    FROM texts t LEFT JOIN doubled d USING (doc_id) LEFT JOIN repeated r USING (doc_id)
), hosts AS (SELECT source, count(*) AS docs, {bad} FROM measured GROUP BY source),
moments AS (SELECT {moments} FROM hosts), prior AS (SELECT *, {weights} FROM moments),
verdicts AS (SELECT source, {kept} AS host_kept FROM hosts, prior)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       ({_RULES["short"]} OR {_RULES["repeats"]}) AS base_failed,
       NOT ({_RULES["short"]} OR {_RULES["repeats"]}) AND host_kept AS kept
FROM measured m JOIN verdicts v ON m.source IS NOT DISTINCT FROM v.source
"""


OP11 = r"""
WITH RECURSIVE said AS (
    SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
           coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS place
    FROM conversations
), drawn AS (
    -- crc32, bit by bit
    SELECT *, xor(list_reduce(
        list_prepend(4294967295::BIGINT, list_transform(string_split(place, ''), lambda c: ord(c)::BIGINT)),
        lambda crc, b: list_reduce(list_prepend(xor(crc, b), range(8)),
            lambda x, k: xor(x >> 1, 3988292384::BIGINT * (x & 1)))), 4294967295::BIGINT) % 20 AS d
    FROM said
), spoiled AS (
    SELECT conv_id, turn, CASE WHEN d = 4 THEN 'user' ELSE role END AS role,
           CASE d WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text
    FROM drawn, unnest(CASE WHEN d = 3 THEN [1, 2] ELSE [1] END) WHERE d <> 0
), placed AS (
    SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS i, left(role, 1) AS initial
    FROM spoiled
), judged AS (
    SELECT *, CASE WHEN NOT regexp_matches(text, '[^\x20\x09-\x0D]') THEN 'blank'
                   WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 THEN 'duplicate'
                   WHEN NOT regexp_matches(text, '[.!?][\x20\x09-\x0D]*\z') THEN 'truncated' ELSE '' END AS fault,
           lag(initial) OVER (PARTITION BY conv_id ORDER BY i) || initial AS pair
    FROM placed
), counted AS (
    SELECT conv_id, count(*) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
           count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate,
           count(*) FILTER (fault = 'truncated') AS truncated,
           count(*) FILTER (pair NOT IN ('su', 'ua', 'au')) AS illegal
    FROM judged GROUP BY conv_id
), inserts (a, m, cost, audit, lines) AS (
    -- states: 0 nothing, 1 system, 2 user, 3 assistant; rows inserted before one that stays or goes
    VALUES (0, 0, 0, '', []), (1, 1, 0, '', []), (2, 2, 0, '', []), (3, 3, 0, '', []),
           (0, 2, 5, 'I', ['user:']), (1, 2, 5, 'I', ['user:']), (3, 2, 5, 'I', ['user:']), (2, 3, 5, 'I', ['assistant:']),
           (0, 3, 10, 'II', ['user:', 'assistant:']), (1, 3, 10, 'II', ['user:', 'assistant:'])
), edits (m, b, edit, cost, initial, role) AS (
    VALUES (0, 0, 'D', 2, NULL, NULL), (1, 1, 'D', 2, NULL, NULL), (2, 2, 'D', 2, NULL, NULL), (3, 3, 'D', 2, NULL, NULL),
           (0, 1, 'K', 0, 's', NULL), (0, 2, 'K', 0, 'u', NULL), (1, 2, 'K', 0, 'u', NULL), (2, 3, 'K', 0, 'a', NULL),
           (3, 2, 'K', 0, 'u', NULL),
           (0, 2, 'R', 1, NULL, 'user'), (1, 2, 'R', 1, NULL, 'user'), (2, 3, 'R', 1, NULL, 'assistant'), (3, 2, 'R', 1, NULL, 'user')
), walk AS (
    SELECT conv_id, 0::BIGINT AS i, 0 AS state, {'cost': 0::BIGINT, 'audit': '', 'lines': []::VARCHAR[]} AS best FROM counted
    UNION ALL
    SELECT j.conv_id, j.i, e.b, min({
        'cost': w.best.cost + n.cost + e.cost + CASE WHEN j.fault = 'truncated' AND e.edit <> 'D' THEN 5 ELSE 0 END,
        'audit': w.best.audit || n.audit || e.edit,
        'lines': list_concat(w.best.lines, n.lines, CASE WHEN e.edit = 'D' THEN [] ELSE [coalesce(e.role, j.role) || ':' || j.text] END)})
    FROM walk w
    JOIN judged j ON j.conv_id IS NOT DISTINCT FROM w.conv_id AND j.i = w.i + 1
    JOIN inserts n ON n.a = w.state
    JOIN edits e ON e.m = n.m AND (e.initial IS NULL OR e.initial = j.initial)
                AND (e.edit = 'D' OR j.fault NOT IN ('blank', 'duplicate'))
    GROUP BY j.conv_id, j.i, e.b
), ended AS (
    SELECT c.conv_id, min({'cost': w.best.cost + n.cost, 'audit': w.best.audit || n.audit, 'lines': list_concat(w.best.lines, n.lines)}) AS best
    FROM counted c
    JOIN walk w ON w.conv_id IS NOT DISTINCT FROM c.conv_id AND w.i = c.n
    JOIN inserts n ON n.a = w.state AND n.m IN (0, 3)
    GROUP BY c.conv_id
)
SELECT o.conv_id, coalesce(c.gaps, 0)::BIGINT AS gaps, coalesce(c.blank, 0) AS blank, coalesce(c.duplicate, 0) AS duplicate,
       coalesce(c.truncated, 0) AS truncated, coalesce(c.illegal, 0) AS illegal, coalesce(e.best.cost, 0)::BIGINT AS cost,
       coalesce(e.best.audit, '') AS audit, sha256(coalesce(array_to_string(e.best.lines, chr(10)), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) o
LEFT JOIN counted c ON c.conv_id IS NOT DISTINCT FROM o.conv_id
LEFT JOIN ended e ON e.conv_id IS NOT DISTINCT FROM o.conv_id
"""

OP13 = """
WITH kept AS (
    SELECT vec_id, list_transform(embedding, lambda c: floor(256 * c::DOUBLE)) AS x FROM embeddings
    WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(c))) = 0
), scored AS (
    SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.x, c.x)::BIGINT AS score
    FROM kept q JOIN kept c ON q.vec_id % 50 = 0 AND c.vec_id <> q.vec_id
), ranked AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM scored)
SELECT query_id, rank::INTEGER AS rank, vec_id, score FROM ranked WHERE rank <= 5
"""

ORACLE: dict[str, str] = {
    "op2_chat_prefix_targets": OP2,
    "op4_winnowed_benchmark": OP4,
    "op9_jaccard_groups": OP9,
    "op10_host_rules": _host_rules(),
    "op11_hirschberg_repair": OP11.strip(),
    "op13_norm_sorted_top_k": OP13.strip(),
}
