"""SQL twins of the queries that SQL can express."""

from __future__ import annotations

from starlode.llm.quality import STOP_WORDS
from starlode.llm.secret_scan import BASE, RULES

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_ALNUM = r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'"
_WORD = r"'[^\x20\x09-\x0D]+'"
_STOPS = ", ".join(f"'{w}'" for w in sorted(set(STOP_WORDS)))

LLM_ORACLE: dict[str, str] = {
    "op1_decontamination": f"""
    WITH item AS (
      SELECT CAST(item_id AS VARCHAR) AS item_id, regexp_extract_all({_LOWER}, {_ALNUM}) AS ws FROM benchmark),
    win AS (
      SELECT DISTINCT item_id, array_to_string(list_slice(ws, i, i + 12), ' ') AS gram,
             len(list_slice(ws, i, i + 12)) AS n
      FROM (SELECT item_id, ws, unnest(range(1, greatest(len(ws) - 12, 1) + 1)) AS i FROM item WHERE len(ws) > 0)),
    doc AS (SELECT doc_id, regexp_extract_all({_LOWER}, {_ALNUM}) AS ws FROM documents),
    sizes AS (SELECT DISTINCT n FROM win),
    spot AS (
      SELECT doc_id, i, n, array_to_string(list_slice(ws, i, i + n - 1), ' ') AS gram
      FROM (SELECT doc_id, ws, n, unnest(range(1, len(ws) - n + 2)) AS i FROM doc CROSS JOIN sizes)),
    hit AS (SELECT DISTINCT doc_id, i, spot.n, item_id FROM spot JOIN win ON win.gram = spot.gram AND win.n = spot.n),
    covered AS (
      SELECT doc_id, count(DISTINCT p) AS n_hit
      FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM hit) GROUP BY doc_id),
    named AS (
      SELECT doc_id, count(DISTINCT item_id) AS n_items, string_agg(DISTINCT item_id, ',' ORDER BY item_id) AS ids
      FROM hit GROUP BY doc_id)
    SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
           sha256(coalesce(ids, '')) AS items_sha256,
           coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(ws) AS contaminated
    FROM doc LEFT JOIN covered USING (doc_id) LEFT JOIN named USING (doc_id)""",
    "op2_mixing": f"""
    WITH sized AS (
      SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), {_WORD})) AS BIGINT) AS size,
             coalesce((SELECT max(CASE WHEN quality > 0 THEN 2.0 ELSE 0.5 END) FROM labels
                       WHERE labels.doc_id = documents.doc_id AND quality IS NOT NULL), 1.0) AS weight
      FROM documents),
    src AS (
      SELECT source, sum(size) AS source_size, 2.0::DOUBLE * sum(size) AS cap,
             CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 WHEN 0 THEN 3.0::DOUBLE
                  WHEN 1 THEN 1.0::DOUBLE ELSE 2.0::DOUBLE END AS w
      FROM sized GROUP BY source),
    lev AS (
      SELECT *, (1.5::DOUBLE * sum(source_size) OVER ()
                 - coalesce(sum(cap) OVER (ORDER BY cap / w, source ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
             / sum(w) OVER (ORDER BY cap / w, source ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS lv
      FROM src),
    tgt AS (
      SELECT *, least(cap, coalesce(max(CASE WHEN lv * w < cap THEN lv END) OVER () * w, cap)) AS target FROM lev),
    plan AS (
      SELECT source, CAST(source_size AS BIGINT) AS source_size, target,
             CASE WHEN source_size > 0 THEN CAST(floor(target / source_size) AS BIGINT) ELSE 0 END AS whole
      FROM tgt),
    keyed AS (
      SELECT doc_id, size, source_size, target, whole,
             CAST(floor(target - whole * source_size) AS BIGINT) AS rest, sized.source AS src,
             -ln((CAST(CAST('0x' || substr(md5('7:' || doc_id), 1, 12) AS BIGINT) AS DOUBLE) + 0.5)
                 / 281474976710656.0::DOUBLE) / CAST(weight AS DOUBLE) AS key
      FROM sized JOIN plan ON sized.source IS NOT DISTINCT FROM plan.source),
    placed AS (
      SELECT *, coalesce(sum(size) OVER (PARTITION BY src ORDER BY key, doc_id, size
                                         ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
      FROM keyed)
    SELECT doc_id, size, source_size, target,
           CAST(whole * size + greatest(0, least(size, rest - before)) AS BIGINT) AS taken
    FROM placed""",
    "op4_quality": rf"""
    WITH doc AS (
      SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), {_WORD}) AS ws,
             list_filter(string_split(coalesce(text, ''), chr(10)),
                         lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS ls
      FROM documents),
    spot AS (
      SELECT doc_id, i, list_slice(ws, i, i + 2) AS gram
      FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 1)) AS i FROM doc)),
    rep AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, gram) AS c FROM spot) WHERE c > 1),
    cov AS (SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest(range(i, i + 3)) AS p FROM rep) GROUP BY 1),
    m AS (
      SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words,
             CAST(length(array_to_string(ws, '')) AS BIGINT) AS word_chars,
             CAST(len(regexp_extract_all(text, '[#*$%&|<>]')) AS BIGINT) AS n_symbols,
             CAST(len(ls) - len(list_distinct(ls)) AS BIGINT) AS n_dup_lines,
             coalesce(n, 0) AS n_repeat_words, len(ls) AS n_lines,
             len(regexp_extract_all(array_to_string(ws, ''), '!')) AS shouts,
             len(list_filter(ws, lambda w: lower(w) IN ({_STOPS}))) AS stops,
             len(list_filter(ws, lambda w: regexp_matches(w, '\pL'))) AS lettered,
             len(list_filter(ls, lambda x: regexp_matches(x, '^[\x20\x09-\x0D]*[-*•]'))) AS bullets,
             len(list_filter(ls, lambda x: regexp_matches(x, '(\.\.\.|…)[\x20\x09-\x0D]*$'))) AS dots
      FROM doc LEFT JOIN cov USING (doc_id)),
    f AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
                 CAST(greatest(n_words, 1) AS DOUBLE) AS nw, CAST(greatest(n_lines, 1) AS DOUBLE) AS nl FROM m)
    SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
           NOT base_failed AND word_chars / nw BETWEEN 2 AND 12 AND n_symbols / nw <= 0.1 AND stops / nw >= 0.02
           AND n_dup_lines / nl <= 0.5 AND bullets / nl <= 0.9 AND dots / nl <= 0.3 AND shouts / nw <= 0.3
           AND lettered / nw >= 0.7 AS kept
    FROM f""",
}

LLM_ORACLE["op7_substring_dedup"] = f"""
    WITH doc AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), {_WORD}) AS ws FROM documents),
    spot AS (
      SELECT doc_id, i, list_slice(ws, i, i + 12) AS gram
      FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 11)) AS i FROM doc)),
    late AS (
      SELECT doc_id, i FROM (SELECT doc_id, i, min(doc_id) OVER (PARTITION BY gram) AS least FROM spot)
      WHERE least < doc_id),
    gone AS (SELECT doc_id, list(DISTINCT p) AS ps FROM (SELECT doc_id, unnest(range(i, i + 13)) AS p FROM late) GROUP BY 1),
    word AS (SELECT doc_id, i, ws[i] AS w FROM (SELECT doc_id, ws, unnest(range(1, len(ws) + 1)) AS i FROM doc)),
    kept AS (
      SELECT word.doc_id, string_agg(w, ' ' ORDER BY i) AS text FROM word
      WHERE NOT EXISTS (SELECT 1 FROM (SELECT doc_id, unnest(ps) AS p FROM gone) g
                        WHERE g.doc_id = word.doc_id AND g.p = word.i)
      GROUP BY 1)
    SELECT doc.doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(coalesce(len(ps), 0) AS BIGINT) AS n_removed,
           sha256(coalesce(kept.text, '')) AS kept_sha256
    FROM doc LEFT JOIN gone USING (doc_id) LEFT JOIN kept USING (doc_id)"""


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _secret_sql() -> str:
    parts = []
    for rank, rule in enumerate(RULES):
        p = _quoted(rule.pattern)
        parts.append(
            f"""SELECT doc_id, {rank} AS rank, '{rule.kind}' AS kind,
              list_sum([0] || list_transform(list_slice(gaps, 1, i), lambda x: length(x)))
              + list_sum([0] || list_transform(list_slice(found, 1, i - 1), lambda x: length(x))) AS s,
              length(found[i]) AS n
            FROM (SELECT doc_id, string_split_regex(text, {p}) AS gaps, regexp_extract_all(text, {p}) AS found,
                         regexp_extract_all(text, {p}, {rule.group}) AS tested,
                         unnest(range(1, len(regexp_extract_all(text, {p})) + 1)) AS i FROM doc)
            WHERE length(tested[i]) >= {rule.least}"""
        )
    listed = "string_agg(kind || ':' || CAST(s AS BIGINT) || ':' || CAST(s + n AS BIGINT), ',' ORDER BY s, rank, n)"
    return f"""
    WITH doc AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
    span AS ({' UNION ALL '.join(parts)}),
    agg AS (
      SELECT doc_id, count(*) FILTER (kind = 'assign') AS n_assign, count(*) FILTER (kind = 'access') AS n_access,
             count(*) FILTER (kind = 'hex') AS n_hex, {listed} FILTER (rank < {len(BASE)}) AS base, {listed} AS spans
      FROM span GROUP BY 1)
    SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
           sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
    FROM doc LEFT JOIN agg USING (doc_id)"""


LLM_ORACLE["op6_secret_scan"] = _secret_sql()

LLM_ORACLE["op9_warc"] = """
    WITH page AS (SELECT page_id, encode(coalesce(html, '')) AS payload FROM pages),
    sized AS (SELECT page_id, CAST(octet_length(payload) AS BIGINT) AS payload_bytes, payload FROM page),
    held AS (SELECT *, max(page_id) OVER (PARTITION BY payload) AS holder FROM sized)
    SELECT page_id, payload_bytes, sha1(payload) AS payload_digest,
           CASE WHEN payload_bytes >= 1000 AND holder <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
           CASE WHEN payload_bytes >= 1000 AND holder <> page_id THEN holder END AS refers_to
    FROM held"""


def _merkle_sql(fanout: int = 8, levels: int = 11) -> str:
    """One pair of steps per level: ``levels`` is enough for 8 ** 11 documents of a language."""

    def field(value: str) -> str:
        return f"coalesce(CAST(strlen({value}) AS VARCHAR) || ':' || {value}, '-')"

    def leaf(text: str) -> str:
        names = [f"CAST({c} AS VARCHAR)" for c in ("doc_id", "source", "lang", "n_chars")]
        return f"sha256({' || '.join(field(v) for v in [*names, text])})"

    lower = _LOWER.replace("coalesce(text, '')", "text")
    bits = "list_transform(range(8 * len(s)), lambda i: CASE WHEN i % 8 = 0 THEN ascii(s[i // 8 + 1]) ELSE 0 END)"
    crc = f"""xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), {bits}),
              lambda a, e: xor(xor(a, e) >> 1, 3988292384 * (xor(a, e) & 1))), 4294967295)"""

    def climb(name: str) -> list[str]:
        """Relations ``{name}0`` (tree, idx, digest) upwards: the runs of each level."""
        steps = []
        for k in range(levels):
            steps.append(f"""
    {name}_run{k} AS (
      SELECT tree, idx // {fanout} AS idx, list(digest ORDER BY idx) AS kids, any_value(live) AS live
      FROM (SELECT *, count(*) OVER (PARTITION BY tree) > 1 AS live FROM {name}{k}) GROUP BY 1, 2),
    {name}{k + 1} AS (
      SELECT tree, idx, CASE WHEN live THEN sha256(array_to_string(kids, '')) ELSE kids[1] END AS digest
      FROM {name}_run{k})""")
        return steps

    def prove(name: str, start: str) -> list[str]:
        """From ``start`` (doc_id, tree, idx, node, proof) along the runs of ``name``."""
        steps, before = [], start
        for k in range(levels):
            left = f"array_to_string(kids[1:{before}.idx % {fanout}], '')"
            right = f"array_to_string(kids[{before}.idx % {fanout} + 2:], '')"
            steps.append(f"""
    {name}_way{k} AS (
      SELECT doc_id, {before}.tree, {before}.idx // {fanout} AS idx,
             CASE WHEN live THEN sha256({left} || node || {right}) ELSE node END AS node,
             CASE WHEN live THEN proof || {left} || {right} ELSE proof END AS proof
      FROM {before} JOIN {name}_run{k} r ON r.tree = {before}.tree AND r.idx = {before}.idx // {fanout})""")
            before = f"{name}_way{k}"
        return steps

    parts = [
        f"""
    doc AS (
      SELECT doc_id, {leaf("text")} AS leaf, CASE WHEN {crc} % 3 = 0 THEN {leaf(lower)} ELSE {leaf("text")} END AS node,
             dense_rank() OVER (ORDER BY lang NULLS FIRST) - 1 AS tree,
             row_number() OVER (PARTITION BY lang ORDER BY doc_id) - 1 AS idx
      FROM (SELECT *, CAST(doc_id AS VARCHAR) AS s FROM documents)),
    low0 AS (SELECT tree, idx, leaf AS digest FROM doc)""",
        *climb("low"),
        f"""
    top0 AS (SELECT 0 AS tree, tree AS idx, digest FROM low{levels})""",
        *climb("top"),
        """
    start AS (SELECT doc_id, tree, idx, node, '' AS proof FROM doc)""",
        *prove("low", "start"),
        f"""
    middle AS (SELECT doc_id, 0 AS tree, tree AS idx, node, proof FROM low_way{levels - 1})""",
        *prove("top", "middle"),
    ]
    return f"""
    WITH {",".join(parts)}
    SELECT doc.doc_id, doc.leaf, low.digest AS subroot, root.digest AS root, sha256(proof) AS proof_sha256,
           w.node AS folded_root, w.node = root.digest AS verified
    FROM doc JOIN top_way{levels - 1} w USING (doc_id) JOIN low{levels} low ON low.tree = doc.tree
    CROSS JOIN top{levels} root"""


LLM_ORACLE["op12_merkle_manifest"] = _merkle_sql()
