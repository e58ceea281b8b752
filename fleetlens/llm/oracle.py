"""DuckDB SQL for the training-data queries that SQL can express."""

from __future__ import annotations

import string

from fleetlens.llm.decontaminate import WINDOW as PHRASE
from fleetlens.llm.substrings import WINDOW as REPEAT


def _runs(words: str, size: int) -> str:
    """Rows (doc_id, pos, run): every run of ``size`` words of a (doc_id, pos, word) table."""
    span = f"OVER (PARTITION BY doc_id ORDER BY pos ROWS BETWEEN CURRENT ROW AND {size - 1} FOLLOWING)"
    return (f"SELECT doc_id, pos, run FROM (SELECT doc_id, pos, STRING_AGG(word, ' ') {span} AS run, "
            f"COUNT(*) {span} AS n FROM {words}) WHERE n = {size}")


def _words(table: str, key: str, text: str, word: str) -> str:
    lists = f"SELECT {key} AS doc_id, REGEXP_EXTRACT_ALL(COALESCE({text}, ''), '{word}') AS ws FROM {table}"
    return f"SELECT doc_id, UNNEST(ws) AS word, GENERATE_SUBSCRIPTS(ws, 1) AS pos FROM ({lists}) WHERE LEN(ws) > 0"


def substring_dedup() -> str:
    return f"""
        WITH words AS ({_words("documents", "doc_id", "text", "[^\\x20\\x09-\\x0D]+")}),
        runs AS ({_runs("words", REPEAT)}),
        again AS (SELECT doc_id, pos FROM runs QUALIFY ROW_NUMBER() OVER (PARTITION BY run ORDER BY doc_id, pos) > 1),
        gone AS (SELECT DISTINCT doc_id, pos + shift AS pos FROM again, RANGE({REPEAT}) t(shift)),
        kept AS (SELECT doc_id, COUNT(*) AS n_words, COUNT(g.pos) AS n_removed,
                        STRING_AGG(word, ' ' ORDER BY pos) FILTER (WHERE g.pos IS NULL) AS text
                 FROM words LEFT JOIN gone g USING (doc_id, pos) GROUP BY doc_id)
        SELECT doc_id, COALESCE(n_words, 0) AS n_words, COALESCE(n_removed, 0) AS n_removed,
               SHA256(COALESCE(kept.text, '')) AS kept_sha256
        FROM documents LEFT JOIN kept USING (doc_id)"""


def decontamination() -> str:
    lower = f"TRANSLATE(text, '{string.ascii_uppercase}', '{string.ascii_lowercase}')"
    word = "[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+"
    sizes = range(1, PHRASE + 1)
    # An item of fewer words than a window is one window.
    windows = " UNION ALL ".join(
        f"SELECT doc_id AS item_id, {n} AS size, run FROM ({_runs('item_words', n)})"
        + ("" if n == PHRASE else f" WHERE doc_id IN (SELECT doc_id FROM item_words GROUP BY doc_id HAVING COUNT(*) = {n})")
        for n in sizes)
    hits = " UNION ALL ".join(
        f"SELECT r.doc_id, r.pos, w.size, w.item_id FROM ({_runs('words', n)}) r JOIN windows w ON w.size = {n} AND w.run = r.run"
        for n in sizes)
    return f"""
        WITH words AS ({_words("documents", "doc_id", lower, word)}),
        item_words AS ({_words("benchmark", "item_id", lower, word)}),
        windows AS MATERIALIZED ({windows}),
        hits AS MATERIALIZED ({hits}),
        covered AS (SELECT doc_id, COUNT(DISTINCT place) AS n_hit
                    FROM (SELECT doc_id, UNNEST(RANGE(pos, pos + size)) AS place FROM hits) GROUP BY doc_id),
        items AS (SELECT doc_id, COUNT(*) AS n_items, STRING_AGG(item, ',' ORDER BY item) AS names
                  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM hits) GROUP BY doc_id),
        sizes AS (SELECT doc_id, COUNT(*) AS n_words FROM words GROUP BY doc_id)
        SELECT doc_id, COALESCE(n_words, 0) AS n_words, COALESCE(n_hit, 0) AS n_hit, COALESCE(n_items, 0) AS n_items,
               SHA256(COALESCE(names, '')) AS items_sha256,
               COALESCE(n_hit > 0 AND 20 * n_hit >= n_words, FALSE) AS contaminated
        FROM documents LEFT JOIN sizes USING (doc_id) LEFT JOIN covered USING (doc_id) LEFT JOIN items USING (doc_id)"""


def centroid_clustering(k: int = 8, rounds: int = 10) -> str:
    steps = []
    for i in range(rounds + 1):
        steps.append(f"""near{i} AS MATERIALIZED (
            SELECT r, MIN(STRUCT_PACK(d := CAST(LIST_SUM(LIST_TRANSFORM(x, lambda v, p: (v - c[p]) * (v - c[p]))) AS BIGINT), k := k)) AS near
            FROM v, c{i} GROUP BY r)""")
        if i < rounds:
            steps.append(f"""c{i + 1} AS MATERIALIZED (
            SELECT c{i}.k, COALESCE(m.c, c{i}.c) AS c FROM c{i} LEFT JOIN (
                SELECT k, LIST(q ORDER BY p) AS c FROM (
                    SELECT k, p, CAST((total - ((total % n) + n) % n) // n AS BIGINT) AS q FROM (
                        SELECT near.k AS k, p, SUM(x[p]) AS total, COUNT(*) AS n
                        FROM near{i} JOIN v USING (r), RANGE(1, 65) t(p) GROUP BY near.k, p)) GROUP BY k) m USING (k))""")
    return f"""
        WITH v AS MATERIALIZED (
            SELECT ROW_NUMBER() OVER () AS r, vec_id,
                   LIST_TRANSFORM(embedding, lambda e: CAST(FLOOR(1024 * CAST(e AS DOUBLE)) AS BIGINT)) AS x
            FROM embeddings
            WHERE LEN(embedding) = 64 AND LEN(LIST_FILTER(embedding, lambda e: COALESCE(ISFINITE(e), FALSE))) = 64),
        c0 AS MATERIALIZED (
            SELECT CAST(ROW_NUMBER() OVER (ORDER BY h NULLS LAST, x) - 1 AS INTEGER) AS k, x AS c
            FROM (SELECT SHA256('3:' || vec_id) AS h, x FROM v ORDER BY h NULLS LAST, x LIMIT {k})),
        {", ".join(steps)},
        placed AS (SELECT vec_id, near.k AS cluster, near.d AS distance FROM near{rounds} JOIN v USING (r))
        SELECT vec_id, cluster, distance, CAST(SUM(distance) OVER (PARTITION BY cluster) AS BIGINT) AS cluster_inertia,
               CAST(SUM(distance) OVER () AS BIGINT) AS inertia, SHA256(ARRAY_TO_STRING(c, ',')) AS centroid_sha256
        FROM placed JOIN c{rounds} ON c{rounds}.k = cluster"""


#: Edit states of a repair: nothing yet, s, u, a.
_INSERT = {0: (2, "user"), 1: (2, "user"), 2: (3, "assistant"), 3: (2, "user")}


def _offers(to: int) -> str:
    """All ways into a state by one row: insertions, then keep, rerole or delete."""
    keeps = {(0, 1): "s", (0, 2): "u", (1, 2): "u", (2, 3): "a", (3, 2): "u"}
    out = []
    for start in range(4):
        at, audit, lines, cost = start, "", "", 0
        for _ in range(3):
            ways = [("TRUE", 4, "D", "''")] if at == to else []
            if (at, to) in keeps:
                ways.append((f"fault IN ('', 'truncated') AND role[1:1] = '{keeps[at, to]}'", "bad", "K", "role || ':' || text || CHR(10)"))
            if (at, to) in keeps and to > 1:
                ways.append(("fault IN ('', 'truncated')", "3 + bad", "R", f"'{_INSERT[at][1]}:' || text || CHR(10)"))
            out += [f"CASE WHEN {when} AND s{start} IS NOT NULL THEN STRUCT_PACK(cost := s{start}.cost + {cost} + {paid}, "
                    f"audit := s{start}.audit || '{audit}{edit}', said := s{start}.said || {lines or chr(39) * 2} || {said}) END"
                    for when, paid, edit, said in ways]
            at, role = _INSERT[at]
            audit, cost = audit + "I", cost + 3
            lines = (lines + " || " if lines else "") + f"'{role}:' || CHR(10)"
    return f"LIST_MIN([{', '.join(out)}])"


def conversation_repair() -> str:
    def shown(name: str) -> str:
        return f"COALESCE(CAST({name} AS VARCHAR), ' ')"

    kind = "STRUCT(cost BIGINT, audit VARCHAR, said VARCHAR)"
    ends = {0: ("", ""), 1: ("II", "'user:' || CHR(10) || 'assistant:' || CHR(10)"), 2: ("I", "'assistant:' || CHR(10)"), 3: ("", "")}
    last = ", ".join(
        f"CASE WHEN s{s} IS NOT NULL THEN STRUCT_PACK(cost := s{s}.cost + {3 * len(a)}, audit := s{s}.audit || '{a}', said := s{s}.said || {t or chr(39) * 2}) END"
        for s, (a, t) in ends.items())
    return f"""
        WITH RECURSIVE crcs AS (
            SELECT LIST_TRANSFORM(RANGE(256), lambda b: LIST_REDUCE(LIST_PREPEND(CAST(b AS BIGINT), RANGE(8)),
                lambda c, i: CASE WHEN c & 1 = 1 THEN XOR(c >> 1, 3988292384) ELSE c >> 1 END)) AS t),
        marked AS (
            SELECT conv_id, turn, {shown("role")} AS role, {shown("text")} AS text, DENSE_RANK() OVER (ORDER BY conv_id) AS g,
                   XOR(LIST_REDUCE(LIST_PREPEND(4294967295, LIST_TRANSFORM(STRING_SPLIT({shown("conv_id")} || ':' || {shown("turn")}, ''), lambda c: CAST(ORD(c) AS BIGINT))),
                       lambda a, b: XOR(a >> 8, t[(XOR(a, b) & 255) + 1])), 4294967295) % 20 AS hit
            FROM conversations, crcs),
        hurt AS MATERIALIZED (
            SELECT g, turn, CASE WHEN hit = 4 THEN 'user' ELSE role END AS role,
                   CASE hit WHEN 1 THEN '' WHEN 2 THEN TRANSLATE(text, '.!?', '') ELSE text END AS text
            FROM marked, RANGE(2) t(copy) WHERE hit <> 0 AND (copy = 0 OR hit = 3)),
        numbered AS MATERIALIZED (
            SELECT *, CASE WHEN fault = 'truncated' THEN 3 ELSE 0 END AS bad FROM (
                SELECT *, LAG(role) OVER (PARTITION BY g ORDER BY i) AS before,
                       CASE WHEN NOT REGEXP_MATCHES(text, '[^\x20\x09-\x0D]') THEN 'blank'
                            WHEN ROW_NUMBER() OVER (PARTITION BY g, role, text ORDER BY i) > 1 THEN 'duplicate'
                            WHEN NOT REGEXP_MATCHES(text, '[.!?][\x20\x09-\x0D]*\\z') THEN 'truncated' ELSE '' END AS fault
                FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY g ORDER BY turn NULLS FIRST, role, text) AS i FROM hurt))),
        walk AS (
            SELECT g, CAST(0 AS BIGINT) AS i, CAST({{'cost': 0, 'audit': '', 'said': ''}} AS {kind}) AS s0,
                   CAST(NULL AS {kind}) AS s1, CAST(NULL AS {kind}) AS s2, CAST(NULL AS {kind}) AS s3
            FROM (SELECT DISTINCT g FROM marked)
            UNION ALL
            SELECT walk.g, numbered.i, {", ".join(f"CAST({_offers(s)} AS {kind})" for s in range(4))}
            FROM walk JOIN numbered ON numbered.g = walk.g AND numbered.i = walk.i + 1),
        repaired AS (SELECT g, LIST_MIN([{last}]) AS best FROM walk QUALIFY ROW_NUMBER() OVER (PARTITION BY g ORDER BY i DESC) = 1),
        counts AS (
            SELECT g, COALESCE(MAX(turn) - MIN(turn) + 1 - COUNT(DISTINCT turn), 0) AS gaps, COUNT(*) FILTER (fault = 'blank') AS blank,
                   COUNT(*) FILTER (fault = 'duplicate') AS duplicate, COUNT(*) FILTER (fault = 'truncated') AS truncated,
                   COUNT(*) FILTER (i > 1 AND before[1:1] || role[1:1] NOT IN ('su', 'ua', 'au')) AS illegal
            FROM numbered GROUP BY g)
        SELECT conv_id, COALESCE(gaps, 0) AS gaps, COALESCE(blank, 0) AS blank, COALESCE(duplicate, 0) AS duplicate,
               COALESCE(truncated, 0) AS truncated, COALESCE(illegal, 0) AS illegal, best.cost AS cost, best.audit AS audit,
               SHA256(CASE WHEN best.said = '' THEN '' ELSE best.said[:-2] END) AS repaired_sha256
        FROM (SELECT DISTINCT g, conv_id FROM marked) JOIN repaired USING (g) LEFT JOIN counts USING (g)"""


def oracle_sql() -> dict[str, str]:
    return {"op3_substring_dedup": substring_dedup(), "op5_decontamination": decontamination(),
            "op11_centroid_clustering": centroid_clustering(), "op12_conversation_repair": conversation_repair()}
