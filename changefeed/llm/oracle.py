"""SQL for the queries that SQL can express on whole tables."""

from __future__ import annotations

from changefeed.llm import licenses, secret_scan

ASCII_LOWER = f"translate(coalesce({{}}, ''), '{licenses.UPPER}', '{licenses.LOWER}')"


def words_list(words: tuple[str, ...]) -> str:
    return "[" + ", ".join(f"'{word}'" for word in words) + "]"


def license_places(t: licenses.Template) -> str:
    """(label, start, share) of one template in the word list w."""
    equal = " + ".join(
        f"coalesce(CASE WHEN s + {k - t.offset + 1} >= 1 THEN (w[s + {k - t.offset + 1}] = '{word}')::INT END, 0)"
        for k, word in enumerate(t.words)
    )
    phrase = words_list(t.key)
    starts = f"list_filter(range(CASE WHEN list_has_all(w, {phrase}) THEN len(w) ELSE 0 END), lambda s: w[s + 1 : s + {len(t.key)}] = {phrase})"
    placed = f"list_transform({starts}, lambda s: {{'label': '{t.label}', 'start': s, 'share': ({equal}) / {len(t.words)}.0::DOUBLE}})"
    return f"list_filter({placed}, lambda x: x.share >= {licenses.SHARE})"


def licenses_sql() -> str:
    def joined(templates) -> str:
        return "list_concat(" + ", ".join(license_places(t) for t in templates) + ")"

    labels = "array_to_string(list_sort(list_distinct(list_transform({}, lambda x: x.label))), ',')"
    return f"""
        WITH d AS (
            SELECT doc_id, regexp_extract_all({ASCII_LOWER.format('text')}, '{licenses.WORD}') AS w FROM documents
        ), found AS (SELECT doc_id, len(w) AS n_words, {joined(licenses.BASE)} AS base, {joined(licenses.NOTICES)} AS more FROM d)
        SELECT doc_id, n_words::BIGINT AS n_words, len(base)::BIGINT AS n_base,
               list_min(list_transform(base, lambda x: x.start))::BIGINT AS first_word,
               list_max(list_transform(base, lambda x: x.start))::BIGINT AS last_word,
               {labels.format('base')} AS base_labels,
               {labels.format('list_concat(base, more)')} AS labels,
               coalesce(list_max(list_transform(list_concat(base, more), lambda x: x.share)), 0.0)::DOUBLE AS score
        FROM found"""


def components(nodes: str) -> str:
    """Of links(x, y): the smallest node reachable from each of `nodes` (id), itself included."""
    return f"""
        edges AS (SELECT x, y FROM links UNION ALL SELECT y, x FROM links),
        reach(id, other) AS (
            SELECT x, y FROM edges UNION SELECT r.id, e.y FROM reach r JOIN edges e ON r.other = e.x
        ),
        component AS (
            SELECT n.id, least(n.id, coalesce(min(r.other), n.id)) AS root
            FROM {nodes} n LEFT JOIN reach r ON n.id = r.id GROUP BY n.id
        )"""


MINHASH = f"""
    WITH RECURSIVE d AS (
        SELECT doc_id, regexp_extract_all({ASCII_LOWER.format('text')}, '[^\\x20\\x09-\\x0D]+') AS w FROM documents
    ), s AS (
        SELECT DISTINCT doc_id, unnest(CASE
            WHEN len(w) >= 5 THEN list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i : i + 4], ' '))
            WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS shingle
        FROM d
    ), n AS (SELECT doc_id AS id, count(*) AS n FROM s GROUP BY ALL),
    pairs AS (
        SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c
        FROM s a JOIN s b ON a.shingle = b.shingle AND a.doc_id < b.doc_id GROUP BY ALL
    ), links AS (
        SELECT x, y FROM pairs JOIN n p ON x = p.id JOIN n q ON y = q.id WHERE 100 * c >= 75 * (p.n + q.n - c)
    ), {components('n')}
    SELECT d.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, coalesce(root, d.doc_id) AS component_id,
           coalesce(root, d.doc_id) = d.doc_id AS kept
    FROM d LEFT JOIN n ON d.doc_id = n.id LEFT JOIN component c ON d.doc_id = c.id"""

LINES = f"""
    WITH RECURSIVE l AS (
        SELECT doc_id, unnest(range(len(parts))) AS line_no, trim(unnest(parts), ' ' || chr(9) || chr(11) || chr(12) || chr(13)) AS body
        FROM (SELECT doc_id, string_split(text, chr(10)) AS parts FROM documents WHERE text IS NOT NULL)
    ), bodies AS (
        SELECT body, row_number() OVER (ORDER BY body) AS id, min({{'d': doc_id, 'l': line_no}}) AS first
        FROM l WHERE body <> '' GROUP BY body
    ), s AS (
        SELECT DISTINCT id, unnest(list_transform(range(1, greatest(length(body) - 7, 1) + 1), lambda i: substr(body, i, 8))) AS shingle
        FROM bodies
    ), n AS (SELECT id, count(*) AS n FROM s GROUP BY ALL),
    pairs AS (
        SELECT a.id AS x, b.id AS y, count(*) AS c FROM s a JOIN s b ON a.shingle = b.shingle AND a.id < b.id GROUP BY ALL
    ), links AS (
        SELECT x, y FROM pairs JOIN n p ON x = p.id JOIN n q ON y = q.id WHERE 100 * c >= 80 * (p.n + q.n - c)
    ), {components('n')},
    keepers AS (SELECT root, min(first) AS keeper FROM component JOIN bodies USING (id) GROUP BY root)
    SELECT doc_id, line_no::INT AS line_no, keeper.d AS kept_doc_id, keeper.l::INT AS kept_line_no,
           keeper = {{'d': doc_id, 'l': line_no}} AS kept
    FROM l JOIN bodies USING (body) JOIN component USING (id) JOIN keepers USING (root)"""

LATTICE = f"""
    WITH RECURSIVE v AS (
        SELECT vec_id AS id, embedding::DOUBLE[] AS e FROM embeddings
        WHERE embedding IS NOT NULL AND len(embedding) > 0 AND list_bool_and(list_transform(embedding, lambda x: x IS NOT NULL AND isfinite(x)))
          AND list_bool_or(list_transform(embedding, lambda x: x <> 0))
    ), links AS (
        SELECT a.id AS x, b.id AS y FROM v a JOIN v b ON a.id < b.id AND len(a.e) = len(b.e)
        WHERE list_cosine_similarity(a.e, b.e) >= 0.95
    ), {components('v')},
    degree AS (SELECT x AS id, count(*) AS n FROM edges GROUP BY x)
    SELECT vec_id, coalesce(n, 0)::BIGINT AS n_links, coalesce(root, vec_id) AS component_id, coalesce(root, vec_id) = vec_id AS kept
    FROM embeddings LEFT JOIN component c ON vec_id = c.id LEFT JOIN degree g ON vec_id = g.id"""

WARC = """
    WITH p AS (
        SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest FROM pages
    ), f AS (SELECT *, CASE WHEN payload_bytes >= 100 THEN min(page_id) OVER (PARTITION BY payload_digest) END AS first FROM p)
    SELECT page_id, payload_bytes::BIGINT AS payload_bytes, payload_digest,
           CASE WHEN first <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
           CASE WHEN first <> page_id THEN first END AS refers_to
    FROM f"""


FILTER_AUDIT = """
    WITH d AS (
        SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS body,
               regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w FROM documents
    ), f AS (
        SELECT doc_id, part,
               CASE WHEN len(w) < 200 THEN 'A' ELSE '' END ||
               CASE WHEN 100 * len(list_distinct(w)) < 50 * len(w) THEN 'B' ELSE '' END ||
               CASE WHEN 100 * length(regexp_replace(body, '[^A-Z]', '', 'g')) > 3 * length(body) THEN 'C' ELSE '' END ||
               CASE WHEN regexp_matches(body, '[#$%&*|]') THEN 'D' ELSE '' END ||
               CASE WHEN doc_id > min(doc_id) OVER (PARTITION BY body) THEN 'E' ELSE '' END AS fails
        FROM d
    ), l AS (SELECT doc_id, bool_or(quality = 1) AS good, bool_or(toxic = 1) AS toxic FROM labels GROUP BY ALL),
    cells AS (
        SELECT part, fails, count(*) AS n, count(*) FILTER (good) AS good, count(*) FILTER (toxic) AS toxic
        FROM f LEFT JOIN l USING (doc_id) GROUP BY ALL
    ), letters AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x),
    orders AS (
        SELECT a.x || b.x || c.x || d.x || e.x AS filter_order FROM letters a, letters b, letters c, letters d, letters e
        WHERE len(list_distinct([a.x, b.x, c.x, d.x, e.x])) = 5
    ), steps AS (
        SELECT filter_order, s::INT AS step, substr(filter_order, s, 1) AS letter, '[' || left(filter_order, s) || ']' AS gone,
               CASE WHEN s > 1 THEN '[' || left(filter_order, s - 1) || ']' ELSE '^$a' END AS gone_before
        FROM orders, (SELECT unnest(range(1, 6)) AS s)
    ), counted AS (
        SELECT part, filter_order, step, letter,
               coalesce(sum(n) FILTER (NOT regexp_matches(fails, gone)), 0)::BIGINT AS kept,
               coalesce(sum(n) FILTER (contains(fails, letter) AND NOT regexp_matches(fails, gone_before)), 0)::BIGINT AS removed,
               coalesce(sum(n) FILTER (contains(fails, letter) AND regexp_matches(fails, gone_before)), 0)::BIGINT AS redundant,
               coalesce(sum(n) FILTER (fails = letter), 0)::BIGINT AS unique_fails,
               coalesce(sum(good) FILTER (contains(fails, letter) AND NOT regexp_matches(fails, gone_before)), 0)::BIGINT AS good_lost,
               coalesce(sum(toxic) FILTER (contains(fails, letter) AND NOT regexp_matches(fails, gone_before)), 0)::BIGINT AS toxic_lost
        FROM cells, steps GROUP BY ALL
    )
    SELECT * EXCLUDE (letter), (sum(removed) OVER (PARTITION BY part, letter))::BIGINT AS shapley FROM counted"""


def sql_pattern(pattern: str) -> str:
    return "'" + pattern.replace("'", "''") + "'"


def secret_spans(pattern: str, kind: str, group: int = 0) -> str:
    """(start, rank, end, text) of the matches of a pattern in body, by the lengths of what lies between them."""
    p = sql_pattern(pattern)
    hits, gaps = f"regexp_extract_all(body, {p})", f"string_split_regex(body, {p})"
    named = f"regexp_extract_all(body, {p}, {group})"
    before = f"coalesce(list_sum(list_transform({gaps}[:i], lambda g: length(g))), 0) + coalesce(list_sum(list_transform({hits}[:i - 1], lambda h: length(h))), 0)"
    return (
        f"list_transform(range(1, len({hits}) + 1), lambda i: {{'start': ({before})::BIGINT, 'rank': {secret_scan.KINDS.index(kind)}, "
        f"'end': ({before} + length({hits}[i]))::BIGINT, 'text': {named}[i]}})"
    )


def secrets_sql() -> str:
    allowed = (
        "regexp_matches(p, '^[A-Za-z]+$|^[0-9]+$|^[A-Za-z]+([-_/][A-Za-z]+)+$"
        "|^[0-9A-Fa-f]{8}-[0-9A-Fa-f]{4}-[0-9A-Fa-f]{4}-[0-9A-Fa-f]{4}-[0-9A-Fa-f]{12}$')"
    )
    fillers = (
        "abcdefgh|01234567|12345678|qwertyui|example|sample|dummy|placeholder|changeme|x{6}"
        "|your[-_]?(?:key|token|secret)|test[-_]?(?:key|token|secret)"
    )
    cut = f"'(?i)[-_=+/]{{4,}}|[^-_=+/]*(?:{fillers})[^-_=+/]*'"

    def candidates(kind: str) -> str:
        letters, bits = {"entropy_hex": ("[0-9A-Fa-f]", 2.95), "entropy_upper": ("[0-9A-Z]", 3.45), "entropy_base64": ("[0-9A-Za-z+/_=-]", 3.85)}[kind]
        parts = f"list_transform(string_split_regex(x.text, {cut}), lambda p: regexp_replace(p, '^[-_=+/]+|[-_=+/]+$', '', 'g'))"
        best = "list_max(list_transform(range(1, length(p) - 18), lambda i: list_aggregate(string_split(substr(p, i, 20), ''), 'entropy')))"
        judged = f"len(list_filter({parts}, lambda p: length(p) >= 20 AND NOT {allowed} AND {best} >= {bits})) > 0"
        return f"list_filter({secret_spans(f'{letters}{{20,}}', kind)}, lambda x: {judged})"

    assigned = f"list_filter({secret_spans(secret_scan.ASSIGN, 'assign', 2)}, lambda x: length(x.text) >= {secret_scan.LEAST_ASSIGNED})"
    steps, known = [], ["base"]
    for kind in secret_scan.CLASSES:
        inside = " OR ".join(f"len(list_filter({name}, lambda y: y.start <= x.start AND x.end <= y.end)) > 0" for name in known)
        steps.append(f"list_filter(c_{kind}, lambda x: NOT ({inside})) AS {kind}")
        known.append(kind)
    names = words_list(secret_scan.KINDS)
    joined = "array_to_string(list_transform(list_sort({}), lambda x: " + names + "[x.rank + 1] || ':' || x.start || ':' || x.end), ',')"
    every = ", ".join(known)
    return f"""
        WITH d AS (SELECT doc_id, coalesce(text, '') AS body FROM documents),
        f AS (
            SELECT doc_id, {assigned} AS assign, {secret_spans(secret_scan.ACCESS, 'access')} AS access,
                   {secret_spans(secret_scan.HEX, 'hex')} AS hex,
                   {', '.join(f'{candidates(kind)} AS c_{kind}' for kind in secret_scan.CLASSES)}
            FROM d
        ), b AS (SELECT *, list_concat(assign, access, hex) AS base FROM f),
        e AS (SELECT *, {', '.join(steps)} FROM b)
        SELECT doc_id, len(assign)::BIGINT AS n_assign, len(access)::BIGINT AS n_access, len(hex)::BIGINT AS n_hex,
               sha256({joined.format('base')}) AS base_sha256, {joined.format(f'list_concat({every})')} AS spans
        FROM e"""


ORACLE_SQL: dict[str, str] = {
    "op2_licenses": licenses_sql(),
    "op4_lattice": LATTICE,
    "op5_line_dedup": LINES,
    "op6_secrets": secrets_sql(),
    "op7_minhash": MINHASH,
    "op10_warc": WARC,
    "op11_filter_audit": FILTER_AUDIT,
}
