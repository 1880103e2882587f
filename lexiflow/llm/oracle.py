"""DuckDB SQL of the queries that SQL can express, written independently of the Spark plans."""

from __future__ import annotations

import math

from lexiflow.llm.license_scan import TEMPLATES, THRESHOLD

_FACTORIALS = ", ".join(repr(float(math.factorial(k))) for k in range(81))


def _unit(middle: str) -> str:
    return f"(('0x' || substr(md5({middle}), 1, 13))::BIGINT::DOUBLE + 0.5) / 4503599627370496.0"


_DOC = "coalesce(doc_id::VARCHAR, '')"

OP3 = f"""
WITH volumes AS (
  SELECT source, sum(coalesce(length(text), 0))::BIGINT AS volume FROM documents GROUP BY source),
raws AS (SELECT *, CASE WHEN volume > 0 THEN pow(volume::DOUBLE, 0.5) ELSE 0.0 END AS raw FROM volumes),
total AS (SELECT sum(volume)::DOUBLE AS all_volume, sum(raw) AS all_raw FROM raws),
means AS (
  SELECT source, CASE WHEN volume > 0 THEN raw / all_raw * all_volume / volume ELSE 1.0::DOUBLE END AS mean
  FROM raws, total),
steps AS (SELECT source, greatest(1, ceil(mean / 16.0::DOUBLE))::BIGINT AS steps, mean FROM means),
pmfs AS (
  SELECT source, steps, list_transform(range(0, 81), lambda k:
      exp(-(mean / steps)) * pow(mean / steps, k) / ([{_FACTORIALS}]::DOUBLE[])[k + 1]) AS pmf
  FROM steps),
cdfs AS (
  SELECT source, steps, list_transform(range(1, 82), lambda k: list_sum(pmf[1:k])) AS cdf FROM pmfs),
drawn AS (
  SELECT d.*, list_sum(list_transform(range(0, steps), lambda i: len(list_filter(cdf, lambda c:
      c <= {_unit(f"'mix-1|' || {_DOC} || '|' || i::VARCHAR")}))))::BIGINT AS copies
  FROM documents d JOIN cdfs c ON d.source IS NOT DISTINCT FROM c.source),
copied AS (SELECT *, unnest(range(0, copies)) AS copy FROM drawn WHERE copies > 0)
SELECT doc_id, text, lang, source, n_chars, copies, copy,
       {_unit(f"'mix-1|order|' || {_DOC} || '|' || copy::VARCHAR")} AS order_key
FROM copied
"""


def _any_case(word: str) -> str:
    return "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in word)


_KEYWORDS = "|".join([*map(_any_case, ("password", "passwd", "secret", "token")),
                      _any_case("api") + "_?" + _any_case("key")])
_ASSIGN = f"""({_KEYWORDS})["'']?\\x20*[:=]\\x20*["'']?([A-Za-z0-9+/_.=-]+)"""


def _spans(kind: str, number: int, pattern: str, keep: str) -> str:
    """Matches of one kind: gaps and matches alternate, so lengths give the places."""
    return f"""
  SELECT doc_id, '{kind}' AS kind, {number} AS kind_no, pos,
         pos + length(hit) AS stop
  FROM (SELECT doc_id, hits[i] AS hit, parts[i] AS part,
               (list_sum(list_transform(gaps[1:i], lambda g: length(g)))
                + coalesce(list_sum(list_transform(hits[1:i - 1], lambda h: length(h))), 0))::BIGINT AS pos
        FROM (SELECT *, unnest(range(1, len(hits) + 1)) AS i
              FROM (SELECT doc_id, regexp_extract_all(text, '{pattern}') AS hits,
                           regexp_extract_all(text, '{pattern}', {2 if kind == 'assign' else 0}) AS parts,
                           regexp_split_to_array(text, '{pattern}') AS gaps
                    FROM documents WHERE regexp_matches(text, '{pattern}'))))
  WHERE length({keep})"""


OP4 = f"""
WITH spans AS ({_spans('assign', 0, _ASSIGN, 'part')} >= 8
  UNION ALL {_spans('access', 1, 'AKIA[A-Z0-9]+', 'hit')} >= 16
  UNION ALL {_spans('hex', 2, '[0-9a-f]+', 'hit')} >= 32),
joined AS (
  SELECT doc_id, string_agg(kind || ':' || pos || ':' || stop, ',' ORDER BY pos, kind_no) AS spans,
         count(*) FILTER (kind = 'assign') AS a, count(*) FILTER (kind = 'access') AS k,
         count(*) FILTER (kind = 'hex') AS h
  FROM spans GROUP BY doc_id)
SELECT d.doc_id, coalesce(a, 0) AS n_assign, coalesce(k, 0) AS n_access, coalesce(h, 0) AS n_hex,
       sha256(coalesce(spans, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM documents d LEFT JOIN joined j ON d.doc_id = j.doc_id
"""


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


_VALUES = ", ".join(f"({_quoted(name)}, {i}, {_quoted(t)})"
                    for name, texts in TEMPLATES.items() for i, t in enumerate(texts))
_WORDS = (r"regexp_extract_all(translate(body, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', "
          r"'abcdefghijklmnopqrstuvwxyz'), '[a-z0-9]+(?:\.[a-z0-9]+)*')")
_GRAMS = ("list_distinct(CASE WHEN len(w) >= 2 THEN list_transform(range(1, len(w)), "
          "lambda i: w[i] || ' ' || w[i + 1]) ELSE w END)")

OP7 = rf"""
WITH templates AS (
  SELECT licence, {_GRAMS} AS t FROM (
    SELECT licence, {_WORDS} AS w FROM (VALUES {_VALUES}) v(licence, template_no, body))),
lines AS (
  SELECT doc_id, 'line' AS unit, unnest(range(0, len(l))) AS unit_no, unnest(l) AS body
  FROM (SELECT doc_id, string_split(text, chr(10)) AS l FROM documents WHERE text IS NOT NULL)),
paragraphs AS (
  SELECT doc_id, 'paragraph' AS unit, min(unit_no) AS unit_no, string_agg(body, chr(10) ORDER BY unit_no) AS body
  FROM (SELECT *, trim(body, ' ' || chr(9) || chr(13)) = '' AS blank,
               count(*) FILTER (trim(body, ' ' || chr(9) || chr(13)) = '')
                 OVER (PARTITION BY doc_id ORDER BY unit_no) AS run
        FROM lines)
  WHERE NOT blank GROUP BY doc_id, run HAVING count(*) > 1),
units AS (
  SELECT doc_id, unit, unit_no, {_GRAMS} AS g FROM (
    SELECT doc_id, unit, unit_no, {_WORDS} AS w FROM (
      SELECT * FROM lines UNION ALL SELECT * FROM paragraphs))
  WHERE len(w) > 0),
scored AS (
  SELECT doc_id, unit, unit_no, licence,
         2.0::DOUBLE * len(list_intersect(g, t)) / (len(g) + len(t)) AS dice
  FROM units, templates
  WHERE len(g) <= 200)
SELECT doc_id, unit, unit_no::INTEGER AS unit_no, licence, max(dice) AS dice
FROM scored WHERE dice >= {THRESHOLD}
GROUP BY doc_id, unit, unit_no, licence
"""

def _levels(name: str, first: str, levels: int) -> str:
    """Runs of three of ``first(grp, pos, n, h)``: per level the nodes and what stands beside each in its run."""
    out = [f"{name}_0 AS ({first})"]
    for i in range(levels):
        out.append(f"""{name}_run_{i} AS (
  SELECT grp, pos, coalesce(string_agg(h, '') OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS l,
         coalesce(string_agg(h, '') OVER (w ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS r
  FROM {name}_{i} WHERE n > 1 WINDOW w AS (PARTITION BY grp, pos // 3 ORDER BY pos))""")
        out.append(f"""{name}_{i + 1} AS (
  SELECT grp, pos // 3 AS pos, (any_value(n) + 2) // 3 AS n, sha256(string_agg(h, '' ORDER BY pos)) AS h
  FROM {name}_{i} WHERE n > 1 GROUP BY grp, pos // 3
  UNION ALL SELECT grp, pos, n, h FROM {name}_{i} WHERE n = 1)""")
    return ",\n".join(out)


def _folds(name: str, runs: str, first: str, levels: int) -> str:
    """``first`` with ``f`` folded and ``p`` prolonged by the siblings of every level."""
    out = [f"{name}_0 AS ({first})"]
    for i in range(levels):
        out.append(f"""{name}_{i + 1} AS (
  SELECT d.* REPLACE (CASE WHEN s.l IS NULL THEN f ELSE sha256(s.l || f || s.r) END AS f,
                      p || coalesce(s.l || s.r, '') AS p, d.pos // 3 AS pos)
  FROM {name}_{i} d LEFT JOIN {runs}_run_{i} s ON d.grp IS NOT DISTINCT FROM s.grp AND d.pos = s.pos)""")
    return ",\n".join(out)


def _leaf_sql(text: str) -> str:
    values = ["doc_id::VARCHAR", "source", "lang", "n_chars::VARCHAR", text]
    return "sha256(" + " || ".join(f"coalesce(strlen({v}) || ':' || {v}, '-')" for v in values) + ")"


_CRC32 = """xor(4294967295, list_reduce(list_concat([4294967295::BIGINT],
  list_transform(string_split(doc_id::VARCHAR, ''), lambda c: ascii(c)::BIGINT)), lambda a, b:
  list_reduce(list_concat([xor(a, b)], [0, 0, 0, 0, 0, 0, 0, 0]), lambda x, z:
    xor(x >> 1, CASE WHEN x & 1 = 1 THEN 3988292384 ELSE 0 END))))"""
_TREE_LEVELS = 12

OP11 = f"""
WITH leaves AS (
  SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos,
         count(*) OVER (PARTITION BY source) AS n
  FROM (SELECT doc_id, source, {_leaf_sql("text")} AS leaf,
               CASE WHEN {_CRC32} % 2 = 0 THEN {_leaf_sql("replace(text, chr(10), '')")}
                    ELSE {_leaf_sql("text")} END AS tampered FROM documents)),
{_levels("t", "SELECT source AS grp, pos, n, leaf AS h FROM leaves", _TREE_LEVELS)},
{_levels("g", f"SELECT 0 AS grp, row_number() OVER (ORDER BY grp NULLS FIRST) - 1 AS pos, count(*) OVER () AS n, h "
              f"FROM t_{_TREE_LEVELS}", _TREE_LEVELS)},
{_folds("d", "t", "SELECT doc_id, leaf, source AS grp, pos, tampered AS f, '' AS p FROM leaves", _TREE_LEVELS)},
{_folds("e", "g", f"SELECT d.doc_id, d.leaf, s.h AS subroot, 0 AS grp, s.pos, d.f, d.p FROM d_{_TREE_LEVELS} d JOIN "
                  f"(SELECT grp, h, row_number() OVER (ORDER BY grp NULLS FIRST) - 1 AS pos FROM t_{_TREE_LEVELS}) s "
                  "ON d.grp IS NOT DISTINCT FROM s.grp", _TREE_LEVELS)}
SELECT doc_id, leaf, subroot, (SELECT h FROM g_{_TREE_LEVELS}) AS root, sha256(p) AS proof_sha256,
       f AS folded_root, f = (SELECT h FROM g_{_TREE_LEVELS}) AS verified
FROM e_{_TREE_LEVELS}
"""

OP13 = """
WITH RECURSIVE vectors AS (
  SELECT row_number() OVER () AS row_id, vec_id, embedding::DOUBLE[] AS e FROM embeddings),
usable AS (
  SELECT * FROM vectors
  WHERE e IS NOT NULL AND len(list_filter(e, lambda c: c IS NULL OR NOT isfinite(c))) = 0
    AND len(list_filter(e, lambda c: c <> 0)) > 0),
links AS (
  SELECT a.row_id, b.row_id AS other, b.vec_id AS other_id FROM usable a JOIN usable b ON a.row_id <> b.row_id
  WHERE list_cosine_similarity(a.e, b.e) >= 0.95),
reached AS (
  SELECT row_id, row_id AS other, vec_id AS other_id FROM vectors
  UNION SELECT r.row_id, l.other, l.other_id FROM reached r JOIN links l ON r.other = l.row_id),
lowest AS (SELECT row_id, min(other_id) AS component_id FROM reached GROUP BY row_id),
counts AS (SELECT row_id, count(*) AS n_links FROM links GROUP BY row_id)
SELECT v.vec_id, coalesce(c.n_links, 0)::BIGINT AS n_links, l.component_id,
       v.vec_id IS NOT DISTINCT FROM l.component_id AS kept
FROM vectors v JOIN lowest l USING (row_id) LEFT JOIN counts c USING (row_id)
"""

ORACLE_SQL = {"op3_poisson_mix": OP3, "op4_secret_scan": OP4, "op7_license_scan": OP7,
              "op11_merkle_manifest": OP11, "op13_embedding_dedup": OP13}
