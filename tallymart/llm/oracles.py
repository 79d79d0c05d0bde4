"""SQL twins of the manifest and of the trie."""

from __future__ import annotations

LEVELS = 8  # 8^8 leaves in a group
GROUP_LEVELS = 3  # 8^3 groups
LETTERS = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"


def crc32(text: str) -> str:
    """The usual checksum of an ASCII text, bit by bit: every byte, then eight shifts."""
    shifts = ", ".join(["-1"] * 8)
    steps = f"flatten(list_transform(string_split({text}, ''), lambda c: [ascii(c)::BIGINT, {shifts}]))"
    step = "CASE WHEN x >= 0 THEN xor(a, x) WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END"
    return f"xor(list_reduce({steps}, lambda a, x: {step}, 4294967295::BIGINT), 4294967295)"


def _field(value: str) -> str:
    return f"coalesce(strlen({value}::VARCHAR) || ':' || {value}::VARCHAR, '-')"


def _leaf(text: str) -> str:
    return "sha256(" + " || ".join(_field(c) for c in ("doc_id", "source", "lang", "n_chars", text)) + ")"


def _levels(name: str, count: int) -> str:
    return ", ".join(
        f"""{name}{k} AS (SELECT g, r // 8 AS r, (n + 7) // 8 AS n, list(node ORDER BY r) AS run, sha256(string_agg(node, '' ORDER BY r)) AS node
      FROM {name}{k - 1} WHERE n > 1 GROUP BY g, r // 8, (n + 7) // 8)"""
        for k in range(1, count + 1)
    )


def _tops(name: str, count: int) -> str:
    return " UNION ALL ".join(f"SELECT g, node FROM {name}{k} WHERE n = 1" for k in range(count + 1))


def _climb(name: str, start: str, levels: str, count: int, group: str, place: str) -> str:
    """From ``start`` level by level: the run of the level replaces the node, its other members join the proof."""
    out = []
    for k in range(1, count + 1):
        before = start if k == 1 else f"{name}{k - 1}"
        out.append(
            f"""{name}{k} AS (SELECT f.* REPLACE (CASE WHEN l.run IS NULL THEN cur
          ELSE sha256(array_to_string(list_concat(l.run[1:{place} % 8], [cur], l.run[{place} % 8 + 2:]), '')) END AS cur,
        proof || CASE WHEN l.run IS NULL THEN '' ELSE array_to_string(list_concat(l.run[1:{place} % 8], l.run[{place} % 8 + 2:]), '') END AS proof,
        {place} // 8 AS {place}) FROM {before} f
        LEFT JOIN (SELECT g AS lg, r AS lr, run FROM {levels}{k}) l ON lg = f.{group} AND lr = f.{place} // 8)"""
        )
    return ", ".join(out)


MANIFEST = f"""WITH d AS (SELECT doc_id, coalesce('=' || lang, '-') AS g, {_leaf("text")} AS leaf,
    CASE WHEN {crc32("doc_id::VARCHAR")} % 3 = 0 THEN {_leaf(f"translate(text, {LETTERS})")} ELSE {_leaf("text")} END AS cur FROM documents),
  p0 AS (SELECT *, row_number() OVER (PARTITION BY g ORDER BY doc_id NULLS FIRST, leaf) - 1 AS r, count(*) OVER (PARTITION BY g) AS n, '' AS proof FROM d),
  l0 AS (SELECT g, r, n, leaf AS node FROM p0), {_levels("l", LEVELS)},
  tops AS ({_tops("l", LEVELS)}),
  u0 AS (SELECT '' AS g, row_number() OVER (ORDER BY g) - 1 AS r, count(*) OVER () AS n, node FROM tops), {_levels("u", GROUP_LEVELS)},
  roots AS ({_tops("u", GROUP_LEVELS)}),
  {_climb("f", "p0", "l", LEVELS, "g", "r")},
  q0 AS (SELECT f.*, '' AS up, t.node AS subroot, t.place FROM f{LEVELS} f
    JOIN (SELECT g, node, row_number() OVER (ORDER BY g) - 1 AS place FROM tops) t ON t.g = f.g),
  {_climb("q", "q0", "u", GROUP_LEVELS, "up", "place")}
SELECT doc_id, leaf, subroot, (SELECT node FROM roots) AS root, sha256(proof) AS proof_sha256, cur AS folded_root,
  cur = (SELECT node FROM roots) AS verified FROM q{GROUP_LEVELS}"""

TRIE = f"""WITH own AS (SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS p FROM conversations WHERE conv_id IS NOT NULL),
  cv AS (SELECT conv_id, conv_id - conv_id % 5 AS base, {crc32("conv_id::VARCHAR")} % 9 AS h FROM (SELECT DISTINCT conv_id FROM own)),
  re AS (SELECT cv.conv_id, p, role, text FROM cv JOIN own ON own.conv_id = base AND p <= h
    UNION ALL SELECT conv_id, p + 8, role, text FROM own JOIN cv USING (conv_id) WHERE p > h),
  sq AS (SELECT conv_id, coalesce(s, []) AS s FROM cv LEFT JOIN
    (SELECT conv_id, list({{'role': role, 'text': text}} ORDER BY p) AS s FROM re GROUP BY 1) USING (conv_id)),
  pr AS (SELECT conv_id, d, s[1:d] AS pre, len(s) = d AS ended FROM (SELECT *, unnest(range(0, len(s) + 1)) AS d FROM sq)),
  nd AS (SELECT pre, any_value(d) AS d, min(conv_id) AS conv_id, count(*) AS n,
    sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (WHERE ended), '')) AS ends FROM pr GROUP BY pre),
  kd AS (SELECT pre[1:d - 1] AS pre, count(*) AS kids FROM nd WHERE d > 0 GROUP BY 1),
  al AS (SELECT nd.*, coalesce(kids, 0) AS kids, CASE WHEN d = 0 THEN 0 ELSE (n - 1) * strlen(nd.pre[d].text) END AS bytes FROM nd LEFT JOIN kd ON kd.pre = nd.pre),
  su AS (SELECT pre[1:up] AS pre, count(*) FILTER (WHERE kids = 0) AS leaves, sum(bytes)::BIGINT AS saved
    FROM (SELECT *, unnest(range(0, d + 1)) AS up FROM al) GROUP BY 1)
SELECT al.conv_id, al.d AS depth, pa.conv_id AS parent_conv_id, al.n AS n_convs, al.kids AS n_children, leaves AS n_leaves,
  saved AS saved_tokens, al.ends AS ends_sha256
FROM al JOIN su ON su.pre = al.pre LEFT JOIN nd pa ON al.d > 0 AND pa.pre = al.pre[1:al.d - 1]"""
