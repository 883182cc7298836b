"""SQL that gives the rows of the registered queries, for an engine other than Spark."""

from __future__ import annotations

from tillwork.llm.quality_rules import RULES, STOP_WORDS

# Patterns of the contract, written out so that a slip in an operator shows.
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
PLAIN_WORD = r"[^\x20\x09-\x0D]+"
SYMBOL = r"[#*$%&|<>]"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

_STOP = ", ".join(f"'{w}'" for w in sorted(set(STOP_WORDS)))
_SHARES = {
    "mean_word_chars": ("word_chars", "n_words"),
    "symbol_ratio": ("n_symbols", "n_words"),
    "stop_word_ratio": ("n_stop_words", "n_words"),
    "dup_line_ratio": ("n_dup_lines", "n_lines"),
    "repeat_ratio": ("n_repeat_words", "n_words"),
}


def _breaks(rule) -> str:
    part, whole = _SHARES[rule.measure]
    share = f"(CASE WHEN {whole} > 0 THEN {part}::DOUBLE / {whole} ELSE 0 END)"
    sides = [] if rule.low is None else [f"{share} < {rule.low}"]
    return " OR ".join(sides + ([] if rule.high is None else [f"{share} > {rule.high}"]))


QUALITY = f"""
    WITH cut AS (
        SELECT doc_id, coalesce(text, '') AS t,
            regexp_extract_all(coalesce(text, ''), '{PLAIN_WORD}') AS w,
            list_filter(string_split(coalesce(text, ''), chr(10)),
                lambda x: regexp_matches(x, '{PLAIN_WORD}')) AS l
        FROM documents
    ), grams AS (
        SELECT doc_id, unnest(g) AS gram, generate_subscripts(g, 1) AS i
        FROM (SELECT doc_id, list_transform(range(1, len(w) - 1),
                lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2]) AS g FROM cut)
    ), again AS (
        SELECT doc_id, count(DISTINCT j) AS n FROM (
            SELECT doc_id, unnest([i, i + 1, i + 2]) AS j FROM (
                SELECT *, count(*) OVER (PARTITION BY doc_id, gram) AS times FROM grams
            ) WHERE times > 1) GROUP BY doc_id
    ), counted AS (
        SELECT doc_id, len(w) AS n_words, length(array_to_string(w, '')) AS word_chars,
            len(regexp_extract_all(t, '{SYMBOL}')) AS n_symbols,
            len(l) - len(list_distinct(l)) AS n_dup_lines, coalesce(n, 0) AS n_repeat_words,
            len(l) AS n_lines, len(list_filter(w, lambda x: x IN ({_STOP}))) AS n_stop_words
        FROM cut LEFT JOIN again USING (doc_id)
    ), judged AS (
        SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
            concat_ws(',', {", ".join(f"CASE WHEN {_breaks(r)} THEN '{r.name}' END" for r in RULES)})
                AS failed
        FROM counted
    )
    SELECT *, NOT base_failed AND failed = '' AS kept FROM judged"""

CONTAMINATION = f"""
    WITH item AS (
        SELECT item_id, regexp_extract_all(
            translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '{WORD}') AS w FROM benchmark
    ), win AS (
        SELECT DISTINCT item_id, least(len(w), 13) AS size, unnest(list_transform(
            range(1, greatest(len(w) - 12, 1) + 1),
            lambda i: array_to_string(w[i : i + 12], ' '))) AS id
        FROM item WHERE len(w) > 0
    ), doc AS (
        SELECT doc_id, regexp_extract_all(
            translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '{WORD}') AS w FROM documents
    ), seen AS (
        SELECT doc_id, size, unnest(g) AS id, generate_subscripts(g, 1) AS start FROM (
            SELECT doc_id, size, list_transform(range(1, len(w) - size + 2),
                lambda i: array_to_string(w[i : i + size - 1], ' ')) AS g
            FROM doc, (SELECT DISTINCT size FROM win) WHERE len(w) >= size)
    ), found AS (
        SELECT doc_id, start, size, item_id FROM seen JOIN win USING (id, size)
    ), hit AS (
        SELECT doc_id, count(DISTINCT p) AS n_hit FROM (
            SELECT doc_id, unnest(range(start, start + size)) AS p
            FROM (SELECT DISTINCT doc_id, start, size FROM found)) GROUP BY doc_id
    ), held AS (
        SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS listed
        FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item FROM found) GROUP BY doc_id
    )
    SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
        sha256(coalesce(listed, '')) AS items_sha256,
        coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
    FROM doc LEFT JOIN hit USING (doc_id) LEFT JOIN held USING (doc_id)"""

def _jaccard(words: int, columns: str) -> str:
    """Components of documents whose shingles of so many words have a similarity of 0.8."""
    return f"""
    WITH RECURSIVE cut AS (
        SELECT doc_id, regexp_extract_all(
            translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '{PLAIN_WORD}') AS w FROM documents
    ), sets AS (
        SELECT doc_id, CASE WHEN len(w) = 0 THEN [] ELSE list_sort(list_distinct(list_transform(
            range(1, greatest(len(w) - {words - 1}, 1) + 1),
            lambda i: array_to_string(w[i : i + {words - 1}], ' ')))) END AS g FROM cut
    ), classes AS (
        SELECT md5(array_to_string(g, chr(10))) AS class, min(doc_id) AS class_id, any_value(g) AS g
        FROM sets WHERE len(g) > 0 GROUP BY class
    ), spread AS (
        SELECT class_id, len(g) AS n, unnest(g) AS gram FROM classes
    ), links AS (
        SELECT a, b FROM (
            SELECT x.class_id AS a, y.class_id AS b, x.n AS n, y.n AS m, count(*) AS overlap
            FROM spread x JOIN spread y ON x.gram = y.gram AND x.class_id <> y.class_id
                AND least(x.n, y.n) * 100 >= greatest(x.n, y.n) * 80
            GROUP BY ALL) WHERE 100 * overlap >= 80 * (n + m - overlap)
    ), reach AS (
        SELECT class_id AS a, class_id AS b FROM classes
        UNION SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a
    ), least_of AS (
        SELECT a AS class_id, min(b) AS component_id FROM reach GROUP BY a
    )
    SELECT doc_id, len(sets.g) AS n_shingles, coalesce(component_id, doc_id) AS component_id,
        coalesce(class_id, doc_id) AS class_id{columns}
    FROM sets LEFT JOIN classes ON len(sets.g) > 0
        AND md5(array_to_string(sets.g, chr(10))) = classes.class
    LEFT JOIN least_of USING (class_id)"""


# The checksum of a text: a table of 256 remainders, then a step for each byte.
_CRC_TABLE = """remainders AS (
        SELECT list(list_reduce(range(8),
                lambda c, k: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END, i)
            ORDER BY i) AS t
        FROM (SELECT unnest(range(256)) AS i))"""


def _crc(text: str) -> str:
    whole = f"hex(encode({text}))"
    numbers = f"list_transform(range(len({whole}) // 2), lambda i: ('0x' || {whole}[2 * i + 1 : 2 * i + 2])::BIGINT)"
    return f"xor(list_reduce({numbers}, lambda c, b: xor(c // 256, t[1 + xor(c % 256, b)]), 4294967295), 4294967295)"


TRIE = f"""
    WITH {_CRC_TABLE}, turn AS (
        SELECT conv_id, md5(coalesce(role, '')) || md5(coalesce(text, '')) AS step,
            length(coalesce(text, '')) AS chars,
            row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST) - 1 AS i
        FROM conversations WHERE conv_id IS NOT NULL
    ), conv AS (
        SELECT conv_id, conv_id - conv_id % 100 AS donor, {_crc("conv_id::VARCHAR")} % 6 AS h
        FROM (SELECT DISTINCT conv_id FROM conversations WHERE conv_id IS NOT NULL), remainders
    ), whole AS (
        SELECT conv.conv_id, 0 AS own, i, step, chars FROM conv JOIN turn ON turn.conv_id = donor AND i < h
        UNION ALL
        SELECT conv_id, 1, i, step, chars FROM conv JOIN turn USING (conv_id) WHERE i >= h
    ), visit AS (
        SELECT conv_id, row_number() OVER w AS depth, string_agg(step, '') OVER w AS path, chars
        FROM whole WINDOW w AS (PARTITION BY conv_id ORDER BY own, i)
        UNION ALL SELECT conv_id, 0, '', 0 FROM conv
    ), node AS (
        SELECT path, depth, min(conv_id) AS conv_id, count(*) AS n_convs, max(chars) AS chars
        FROM visit GROUP BY path, depth
    ), last AS (
        SELECT conv_id, max(depth) AS depth FROM visit GROUP BY conv_id
    ), ended AS (
        SELECT path, string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) AS ids
        FROM visit JOIN last USING (conv_id, depth) GROUP BY path
    ), child AS (
        SELECT path[: -65] AS path, count(*) AS n_children FROM node WHERE depth > 0 GROUP BY ALL
    ), full_node AS (
        SELECT node.*, coalesce(n_children, 0) AS n_children FROM node LEFT JOIN child USING (path)
    ), below AS (
        SELECT DISTINCT a.path AS top, b.path AS path
        FROM visit a JOIN visit b ON a.conv_id = b.conv_id AND a.depth <= b.depth
    ), total AS (
        SELECT top AS path, count(*) FILTER (n_children = 0) AS n_leaves,
            sum((n_convs - 1) * chars)::BIGINT AS saved_tokens
        FROM below JOIN full_node USING (path) GROUP BY top
    )
    SELECT v.conv_id, v.depth, up.conv_id AS parent_conv_id, v.n_convs, v.n_children, n_leaves,
        saved_tokens, sha256(coalesce(ids, '')) AS ends_sha256
    FROM full_node v JOIN total USING (path) LEFT JOIN ended USING (path)
    LEFT JOIN node up ON v.depth > 0 AND up.path = v.path[: -65]"""

SPELLING = f"""
    WITH RECURSIVE {_CRC_TABLE}, run AS (
        SELECT doc_id, run, count(*) AS times FROM (
            SELECT coalesce(doc_id::VARCHAR, '') AS doc_id, unnest(regexp_extract_all(
                translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[a-zÀ-ÿ]+')) AS run FROM documents)
        WHERE length(run) >= 7 GROUP BY ALL
    ), checked AS (
        SELECT run, times, {_crc("doc_id || ':' || run")} AS h FROM run, remainders
    ), slipped AS (
        SELECT times, CASE WHEN h % 31 = 0
            THEN run[: h % length(run)] || run[h % length(run) + 2 :] ELSE run END AS word FROM checked
    ), counted AS (
        SELECT word, sum(times)::BIGINT AS n FROM slipped WHERE length(word) >= 7 GROUP BY word HAVING sum(times) >= 2
    ), without AS (
        SELECT word, n, i, word[: i - 1] || word[i + 1 :] AS rest
        FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM counted)
    ), replaced AS (
        SELECT a.word, a.n, b.word AS near, b.n AS near_n
        FROM without a JOIN without b ON a.rest = b.rest AND a.i = b.i AND a.word <> b.word
    ), inserted AS (
        SELECT DISTINCT a.word, a.n, b.word AS near, b.n AS near_n
        FROM counted a JOIN without b ON a.word = b.rest
    ), near AS (
        FROM replaced UNION FROM inserted UNION SELECT near, near_n, word, n FROM inserted
    ), best AS (
        SELECT word, count(*) AS n_near,
            arg_min(near, (-near_n, near)) AS form, max(near_n) AS form_n, any_value(n) AS n
        FROM near GROUP BY word
    ), judged AS (
        SELECT word, n_near, CASE WHEN form_n >= 10 * n THEN form END AS form,
            CASE WHEN form_n >= 10 * n THEN form_n END AS form_n FROM best
    ), chain AS (
        SELECT word, form AS reached, 1 AS steps FROM judged WHERE form IS NOT NULL
        UNION ALL
        SELECT chain.word, judged.form, steps + 1 FROM chain JOIN judged ON chain.reached = judged.word
        WHERE judged.form IS NOT NULL
    ), ends AS (
        SELECT word, arg_max(reached, steps) AS root FROM chain GROUP BY word
    )
    SELECT word, n, coalesce(n_near, 0) AS n_near, form, form_n, coalesce(root, word) AS root
    FROM counted LEFT JOIN judged USING (word) LEFT JOIN ends USING (word)"""

SQL = {
    "op5_positional_index": CONTAMINATION,
    "op8_quality_rules": QUALITY,
    "op9_vertical_join": _jaccard(5, ""),
    "op11_prefix_trie": TRIE,
    "op12_bayesian_minhash": _jaccard(4, ", doc_id = coalesce(component_id, doc_id) AS kept"),
    "op13_spelling_blocks": SPELLING,
}
