"""SQL twins (DuckDB) of the queries that SQL can express, written without the library's code."""

from __future__ import annotations

from docketrank.llm.licenses import TEMPLATES

# Vectors of a label against each other; components by following links.
OP2 = """
WITH RECURSIVE named AS (
    SELECT vec_id, label, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS v FROM embeddings
), usable AS (
    SELECT vec_id, label, v FROM named
    WHERE vec_id IS NOT NULL AND label IS NOT NULL AND v IS NOT NULL AND len(v) > 0
      AND len(list_filter(v, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND list_dot_product(v, v) > 0
), links AS (
    SELECT a.vec_id AS a, b.vec_id AS b FROM usable a JOIN usable b ON a.label = b.label AND a.vec_id <> b.vec_id
    WHERE list_dot_product(a.v, b.v) / sqrt(list_dot_product(a.v, a.v)) / sqrt(list_dot_product(b.v, b.v)) >= 0.98
), reach AS (
    SELECT vec_id AS id, vec_id AS other FROM embeddings WHERE vec_id IS NOT NULL
    UNION
    SELECT r.id, l.b FROM reach r JOIN links l ON r.other = l.a
), least AS (
    SELECT id, min(other) AS component_id FROM reach GROUP BY id
), counted AS (
    SELECT a, count(*) AS n_links FROM links GROUP BY a
)
SELECT e.vec_id, coalesce(c.n_links, 0) AS n_links, l.component_id, coalesce(e.vec_id = l.component_id, true) AS kept
FROM embeddings e LEFT JOIN least l ON e.vec_id = l.id LEFT JOIN counted c ON e.vec_id = c.a
"""

OP3 = r"""
WITH docs AS (
    SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS text, lang, source FROM documents
), split AS (
    SELECT *, list_filter(regexp_split_to_array(text, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS words,
        list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines
    FROM docs
), windows AS (
    SELECT rid, i, array_to_string(words[i:i+7], ' ') AS words8
    FROM (SELECT rid, words, unnest(range(1, len(words) - 6)) AS i FROM split WHERE len(words) > 8)
), twice AS (
    SELECT rid, i FROM windows QUALIFY count(*) OVER (PARTITION BY rid, words8) > 1
), repeated AS (
    SELECT rid, sum(least(8, coalesce(following - i, 8))) AS n
    FROM (SELECT rid, i, lead(i) OVER (PARTITION BY rid ORDER BY i) AS following FROM twice) GROUP BY rid
), measured AS (
    SELECT rid, doc_id, lang, source, len(words) AS n_words, coalesce(length(array_to_string(words, '')), 0) AS word_chars,
        length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS n_symbols, len(lines) - len(list_distinct(lines)) AS n_dup_lines,
        len(lines) AS n_lines, len(list_filter(range(2, len(words) + 1), lambda i: words[i] = words[i - 1])) AS n_stutter
    FROM split
), valued AS (
    SELECT m.*, CAST(coalesce(r.n, 0) AS BIGINT) AS n_repeat_words,
        CASE WHEN n_words > 0 THEN least(100 * n_symbols // n_words, 1000) ELSE 0 END AS symbols,
        CASE WHEN n_words > 0 THEN least(10 * word_chars // n_words, 1000) ELSE 0 END AS word_length,
        CASE WHEN n_lines > 0 THEN least(100 * n_dup_lines // n_lines, 100) ELSE 0 END AS dup_lines,
        CASE WHEN n_words > 0 THEN least(100 * n_stutter // n_words, 100) ELSE 0 END AS stutter
    FROM measured m LEFT JOIN repeated r USING (rid)
), quartiles AS (
    SELECT lang, source,
        quantile_disc(symbols, 0.25) AS s1, quantile_disc(symbols, 0.75) AS s3,
        quantile_disc(word_length, 0.25) AS w1, quantile_disc(word_length, 0.75) AS w3,
        quantile_disc(dup_lines, 0.25) AS d1, quantile_disc(dup_lines, 0.75) AS d3,
        quantile_disc(stutter, 0.25) AS t1, quantile_disc(stutter, 0.75) AS t3
    FROM valued GROUP BY lang, source
), judged AS (
    SELECT v.*, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed,
        symbols <= s3 + 3 * greatest(s3 - s1, 5) AND dup_lines <= d3 + 3 * greatest(d3 - d1, 15)
        AND stutter <= t3 + 3 * greatest(t3 - t1, 8)
        AND word_length BETWEEN w1 - 3 * greatest(w3 - w1, 10) AND w3 + 3 * greatest(w3 - w1, 10) AS inside
    FROM valued v JOIN quartiles q ON v.lang IS NOT DISTINCT FROM q.lang AND v.source IS NOT DISTINCT FROM q.source
)
SELECT doc_id, CAST(n_words AS BIGINT) AS n_words, CAST(word_chars AS BIGINT) AS word_chars,
    CAST(n_symbols AS BIGINT) AS n_symbols, CAST(n_dup_lines AS BIGINT) AS n_dup_lines, n_repeat_words, base_failed,
    NOT base_failed AND inside AS kept
FROM judged
"""

# The templates of the license scan are fixed values; everything else about the scan is written anew.
_TEMPLATES = ", ".join(f"('{label}', {i}, '{text}')" for label, texts in TEMPLATES.items() for i, text in enumerate(texts))

OP7 = rf"""
WITH docs AS (
    SELECT doc_id, list_filter(regexp_split_to_array(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS words
    FROM documents
), placed AS (
    SELECT doc_id, words, unnest(range(1, len(words) + 1)) AS i FROM docs
), base AS (
    SELECT doc_id, i - 1 AS start, CASE
        WHEN words[i] = 'mit' AND words[i + 1] = 'license' THEN 'mit'
        WHEN words[i] = 'apache' AND words[i + 1] = 'license' THEN 'apache'
        WHEN words[i] = 'general' AND words[i + 1] = 'public' AND words[i + 2] = 'license' THEN 'gpl' END AS label
    FROM placed
), based AS (
    SELECT doc_id, count(*) AS n_base, min(start) AS first_word, max(start) AS last_word, list(DISTINCT label) AS base_labels
    FROM base WHERE label IS NOT NULL GROUP BY doc_id
), templates(label, number, body) AS (VALUES {_TEMPLATES}
), template_words AS (
    SELECT label, number, string_split(body, ' ') AS words FROM templates
), template_grams AS (
    SELECT label, number, size, pos, array_to_string(words[pos + 1:pos + 4], ' ') AS gram FROM (
        SELECT label, number, words, len(words) AS size, unnest(range(0, len(words) - 3)) AS pos FROM template_words)
), grams AS (
    SELECT doc_id, i - 1 AS place, array_to_string(words[i:i + 3], ' ') AS gram FROM placed WHERE i + 3 <= len(words)
), hits AS (
    SELECT DISTINCT doc_id, label, number, size, place, pos, place - pos AS diagonal FROM grams JOIN template_grams USING (gram)
), starts AS (
    SELECT *, coalesce(diagonal - lag(diagonal) OVER w > 3, true) AS apart FROM hits
    WINDOW w AS (PARTITION BY doc_id, label, number ORDER BY diagonal)
), spans AS (
    SELECT *, sum(CAST(apart AS INT)) OVER (PARTITION BY doc_id, label, number ORDER BY diagonal) AS span FROM starts
), places AS (
    SELECT DISTINCT doc_id, label, number, size, span, pos, min(place) OVER w AS first, max(place) OVER w + 3 AS last FROM spans
    WINDOW w AS (PARTITION BY doc_id, label, number, span)
), covered AS (
    SELECT *, least(4, coalesce(lead(pos) OVER (PARTITION BY doc_id, label, number, span ORDER BY pos) - pos, 4)) AS more FROM places
), verified AS (
    SELECT doc_id, label, sum(more) / size AS share FROM covered
    GROUP BY doc_id, label, number, size, span, first, last HAVING last - first < 2 * size AND sum(more) / size >= 0.75
), method AS (
    SELECT doc_id, list(DISTINCT label) AS found, max(share) AS share, count(*) AS n_spans FROM verified GROUP BY doc_id
)
SELECT d.doc_id, CAST(len(d.words) AS BIGINT) AS n_words, coalesce(b.n_base, 0) AS n_base, b.first_word, b.last_word,
    coalesce(array_to_string(list_sort(b.base_labels), ','), '') AS base_labels,
    coalesce(array_to_string(list_sort(list_distinct(list_concat(coalesce(b.base_labels, []), coalesce(m.found, [])))), ','), '') AS labels,
    greatest(CASE WHEN b.n_base > 0 THEN 0.9::DOUBLE ELSE 0::DOUBLE END, coalesce(m.share, 0)) AS score,
    coalesce(m.n_spans, 0) AS n_spans
FROM docs d LEFT JOIN based b USING (doc_id) LEFT JOIN method m USING (doc_id)
"""  # noqa: E501

OP8 = r"""
WITH turns AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
    UNION ALL VALUES (-1, 0, 'user', '</s>[INST] ok [/INST]'), (-1, 1, 'assistant', '</s>[INST] ok [/INST]')
), escaped AS (
    SELECT *, row_number() OVER w AS place, count(*) OVER (PARTITION BY conv_id) AS size,
        length(replace(replace(replace(replace(replace(replace(replace(replace(replace(text, '\', '\\'), '<|', '<\|'), '|>', '|\>'),
            '<s>', '<\s>'), '</s>', '<\/s>'), '[INST]', '[\INST]'), '[/INST]', '[\/INST]'), '<<SYS>>', '<\<SYS>>'),
            '<</SYS>>', '<\</SYS>>'))
        + length(replace(replace(replace(replace(replace(replace(replace(replace(replace(role, '\', '\\'), '<|', '<\|'), '|>', '|\>'),
            '<s>', '<\s>'), '</s>', '<\/s>'), '[INST]', '[\INST]'), '[/INST]', '[\/INST]'), '<<SYS>>', '<\<SYS>>'),
            '<</SYS>>', '<\</SYS>>'))
        + length('<|turn|><|says|><|end|>') AS written
    FROM turns WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text)
), counted AS (
    SELECT *, sum(CASE WHEN role = 'assistant' OR place = size THEN 1 ELSE 0 END)
        OVER (PARTITION BY conv_id ORDER BY place DESC) AS examples FROM escaped
)
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY place)) AS turns_sha256,
    CAST(coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0) AS BIGINT) AS loss_chars,
    sha256(coalesce(string_agg(text, '' ORDER BY place) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
    CAST(sum(written * examples) AS BIGINT) AS formatted_chars
FROM counted GROUP BY conv_id
"""

OP11 = r"""
WITH plain AS (
    SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS text FROM documents
)
SELECT doc_id, min(doc_id) OVER copies AS keep_id, count(*) OVER copies AS group_size,
    doc_id = min(doc_id) OVER copies AS kept, sha256(text) AS text_sha256
FROM plain WINDOW copies AS (PARTITION BY text)
"""


def _merkle_sql(levels: int = 6) -> str:
    """Trees of up to so many levels, level by level; a level with one node has no siblings and passes it up."""

    def level(name: str, key: str) -> str:
        return f"""{name} AS (
            SELECT *, count(*) OVER (PARTITION BY {key}) > 1 AS several,
                coalesce(string_agg(node, '') OVER (PARTITION BY {key}, r // 16 ORDER BY r
                    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS l,
                coalesce(string_agg(node, '') OVER (PARTITION BY {key}, r // 16 ORDER BY r
                    ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS g
            FROM {name}_nodes
        )"""

    def above(name: str, of: str, key: str) -> str:
        return f"""{name}_nodes AS (
            SELECT {key}, r // 16 AS r, CASE WHEN bool_or(several) THEN sha256(string_agg(node, '' ORDER BY r)) ELSE any_value(node) END AS node
            FROM {of} GROUP BY {key}, r // 16
        )"""

    def field(value: str) -> str:
        return f"coalesce(strlen(CAST({value} AS VARCHAR)) || ':' || {value}, '-')"

    def leaf(text: str) -> str:
        return "sha256(" + " || ".join(field(x) for x in ("doc_id", "source", "lang", "n_chars", text)) + ")"

    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    # CRC-32 bit by bit, with the reversed polynomial 0xEDB88320.
    crc = """xor(4294967295, list_reduce(
        list_prepend(CAST(4294967295 AS BIGINT), list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda x: CAST(ord(x) AS BIGINT))),
        lambda c, b: list_reduce(list_prepend(xor(c, b), range(8)),
            lambda x, i: CASE WHEN x % 2 = 1 THEN xor(x // 2, 3988292384) ELSE x // 2 END)))"""
    parts = [
        f"""rows AS (
            SELECT doc_id, {leaf("text")} AS leaf, dense_rank() OVER (ORDER BY source NULLS FIRST) - 1 AS s,
                {leaf(f"(CASE WHEN {crc} % 5 = 0 THEN translate(text, '{upper}', '{upper.lower()}') ELSE text END)")} AS again
            FROM documents
        )""",
        "f0 AS (SELECT *, row_number() OVER (PARTITION BY s ORDER BY doc_id NULLS FIRST, leaf) - 1 AS r, '' AS proof, again AS f FROM rows)",
        "a0_nodes AS (SELECT s, r, leaf AS node FROM f0)",
        level("a0", "s"),
    ]
    for k in range(1, levels):
        parts += [above(f"a{k}", f"a{k - 1}", "s"), level(f"a{k}", "s")]
    parts += [
        above("subroots", f"a{levels - 1}", "s"),
        "b0_nodes AS (SELECT 0 AS o, s AS r, node FROM subroots_nodes)",
        level("b0", "o"),
    ]
    for k in range(1, levels):
        parts += [above(f"b{k}", f"b{k - 1}", "o"), level(f"b{k}", "o")]
    parts.append(above("roots", f"b{levels - 1}", "o"))
    for k in range(2 * levels):
        name, place = (f"a{k}", "f.r") if k < levels else (f"b{k - levels}", "f.s")
        on = f"{'f.s = n.s AND' if k < levels else ''} {place} // {16 ** (k % levels)} = n.r"
        parts.append(f"""f{k + 1} AS (
            SELECT f.doc_id, f.leaf, f.s, f.r, CASE WHEN several THEN proof || l || g ELSE proof END AS proof,
                CASE WHEN several THEN sha256(l || f || g) ELSE f END AS f
            FROM f{k} f JOIN {name} n ON {on}
        )""")
    return f"""WITH {", ".join(parts)}
    SELECT doc_id, leaf, t.node AS subroot, roots_nodes.node AS root, sha256(proof) AS proof_sha256, f AS folded_root,
        f = roots_nodes.node AS verified
    FROM f{2 * levels} f JOIN subroots_nodes t ON f.s = t.s, roots_nodes"""


ORACLE: dict[str, str] = {
    "op2_embedding_dedup": OP2,
    "op3_quality_rules": OP3,
    "op7_license_scan": OP7,
    "op8_chat_format": OP8,
    "op11_exact_dedup": OP11,
    "op12_merkle_manifest": _merkle_sql(),
}
