"""Common table expressions that the DuckDB statements share."""

from __future__ import annotations

from taxoweave import fixed_values as fv

_STOP = ", ".join(f"'{w}'" for w in fv.STOPWORDS)


def tok(expr: str) -> str:
    """Distinct tokens of a text, as a DuckDB list."""
    return (
        f"list_distinct(list_filter(regexp_extract_all(lower({expr}), '[a-z0-9&]+'), "
        f"lambda w: len(w) > 1 AND NOT list_contains([{_STOP}], w)))"
    )


def _texts(rows: str) -> str:
    return f"""
q AS (SELECT transaction_id, concat(spend_description, ' ', vendor) AS text FROM {rows}),
dt AS MATERIALIZED (SELECT DISTINCT text FROM q),
rawt AS MATERIALIZED (SELECT text, unnest({tok('text')}) AS token FROM dt),
qt AS MATERIALIZED (
  SELECT text, token FROM rawt
  UNION SELECT r.text, s.token FROM rawt r JOIN fx_synonyms s ON s.syn_key = r.token
  UNION SELECT d.text, s.token FROM dt d JOIN fx_synonyms s
        ON contains(s.syn_key, ' ') AND contains(lower(d.text), s.syn_key))"""


# Points per text and leaf by joining tokens and names with the leaves that hold them.
_INDEXED = f"""
leaf AS MATERIALIZED (SELECT * FROM fx_taxonomy),
lt AS MATERIALIZED (
  SELECT ordinal, 'NOTE' AS signal, unnest({tok('boundary_note')}) AS token, 8 AS points FROM leaf
  UNION ALL SELECT ordinal, 'L4', unnest({tok('L4')}), 5 FROM leaf
  UNION ALL SELECT ordinal, 'L3', unnest({tok('L3')}), 3 FROM leaf
  UNION ALL SELECT ordinal, 'L2', unnest({tok('L2')}), 2 FROM leaf
  UNION ALL SELECT ordinal, 'L1', unnest({tok('L1')}), 1 FROM leaf),
names AS (
  SELECT ordinal, 'L4_NAME' AS signal, lower(L4) AS name, 10 AS points FROM leaf WHERE L4 <> ''
  UNION ALL SELECT ordinal, 'L3_NAME', lower(L3), 7 FROM leaf WHERE L3 <> ''),
nh AS MATERIALIZED (
  SELECT d.text, n.name FROM dt d JOIN (SELECT DISTINCT name FROM names) n ON contains(lower(d.text), n.name)),
pts AS MATERIALIZED (
  SELECT qt.text, lt.ordinal, lt.signal, lt.token AS term, lt.points FROM qt JOIN lt ON lt.token = qt.token
  UNION ALL SELECT nh.text, names.ordinal, names.signal, names.name, names.points
            FROM nh JOIN names ON names.name = nh.name),
sc AS (
  SELECT text, ordinal, CAST(sum(points) AS BIGINT) AS score FROM (
    SELECT text, ordinal, points FROM pts
    UNION ALL SELECT dt.text, f.ordinal, 0 FROM dt, (SELECT ordinal FROM leaf ORDER BY ordinal LIMIT 12) f) u
  GROUP BY text, ordinal)"""

# Points per text and leaf by comparing every text with every leaf.
_BRUTE = f"""
leaf AS MATERIALIZED (
  SELECT *, {tok('boundary_note')} AS tn, {tok('L4')} AS t4, {tok('L3')} AS t3, {tok('L2')} AS t2, {tok('L1')} AS t1
  FROM fx_taxonomy),
qs AS MATERIALIZED (
  SELECT d.text, lower(d.text) AS low, coalesce(list(qt.token) FILTER (qt.token IS NOT NULL), []) AS ts
  FROM dt d LEFT JOIN qt ON qt.text = d.text GROUP BY d.text),
sc AS (
  SELECT qs.text, leaf.ordinal, CAST(
    CASE WHEN leaf.L4 <> '' AND contains(low, lower(leaf.L4)) THEN 10 ELSE 0 END
    + CASE WHEN leaf.L3 <> '' AND contains(low, lower(leaf.L3)) THEN 7 ELSE 0 END
    + 8 * len(list_intersect(ts, tn)) + 5 * len(list_intersect(ts, t4)) + 3 * len(list_intersect(ts, t3))
    + 2 * len(list_intersect(ts, t2)) + len(list_intersect(ts, t1)) AS BIGINT) AS score
  FROM qs CROSS JOIN leaf)"""


def retrieval(top_n: int = 7, rows: str = "fx_transactions", *, brute: bool = False) -> str:
    """CTEs up to ``cand``: candidates per distinct text, and ``q``: text per transaction."""
    return f"""{_texts(rows)},{_BRUTE if brute else _INDEXED},
rk AS MATERIALIZED (
  SELECT text, ordinal, score, row_number() OVER (PARTITION BY text ORDER BY score DESC, ordinal) AS rank,
         max(score) OVER (PARTITION BY text) AS max_score FROM sc),
br AS MATERIALIZED (
  SELECT *, CASE WHEN max_score >= 8 THEN 'strong' WHEN max_score >= 3 THEN 'moderate' ELSE 'weak' END AS branch
  FROM rk WHERE rank <= 12),
section AS (
  SELECT ordinal, row_number() OVER (ORDER BY ordinal) AS rank FROM (
    SELECT ordinal, row_number() OVER (PARTITION BY L1 ORDER BY ordinal) AS n FROM leaf) s WHERE n <= 2),
cand AS MATERIALIZED (
  SELECT c.text, c.branch, c.max_score, c.rank, c.ordinal, c.score, leaf.full_path, leaf.boundary_note,
         leaf.L1, leaf.L2, leaf.L3, leaf.L4,
         CASE WHEN trim(leaf.boundary_note) <> ''
              THEN concat(leaf.full_path, '  [Boundary note: ', trim(leaf.boundary_note), ']')
              ELSE leaf.full_path END AS line
  FROM (
    SELECT text, branch, max_score, rank, ordinal, score FROM br
    WHERE branch <> 'weak' AND rank <= CASE branch WHEN 'strong' THEN {min(top_n, 7)} ELSE {min(max(top_n, 10), 12)} END
    UNION ALL
    SELECT br.text, 'weak', br.max_score, section.rank, section.ordinal, NULL
    FROM br, section WHERE br.branch = 'weak' AND br.rank = 1) c
  JOIN leaf ON leaf.ordinal = c.ordinal)"""


#: The default lexicon as a table.
DEFAULT_SYNONYMS = "default_synonyms AS (SELECT * FROM (VALUES " + ", ".join(
    f"('{key}', '{token}')" for key, words in fv.SYNONYMS.items() for token in words) + ") AS s(syn_key, token))"


def retrieval_of(texts: str, taxonomy: str = "fx_taxonomy", synonyms: str = "fx_synonyms", top_n: int = 7) -> str:
    """:func:`retrieval` for ``transaction_id, text`` of a query, another taxonomy or other synonyms."""
    parts = retrieval(top_n).split(" FROM fx_transactions),", 1)
    return f"q AS ({texts})," + parts[1].replace("fx_taxonomy", taxonomy).replace("fx_synonyms", synonyms)


# First row per key, and whether the store answers it.
RUN = """
keyed AS MATERIALIZED (
  SELECT *, concat('v2__||__', trim(spend_description), '__||__', trim(vendor)) AS cache_key FROM fx_transactions),
uniq AS MATERIALIZED (
  SELECT * FROM (
    SELECT *, row_number() OVER (PARTITION BY cache_key ORDER BY transaction_id) AS nth,
           count(*) OVER (PARTITION BY cache_key) AS n_rows FROM keyed) k WHERE nth = 1),
store AS MATERIALIZED (SELECT * FROM fx_store),
needed AS MATERIALIZED (
  SELECT u.*, row_number() OVER (ORDER BY u.transaction_id) - 1 AS position FROM uniq u
  WHERE u.cache_key NOT IN (SELECT cache_key FROM store WHERE coalesce(l1, '') <> ''))"""

# The default answer to every needed row, the store after the run, and the merged results.
DEFAULT_RUN = f"""{RUN},{retrieval(rows='needed')},
fresh AS MATERIALIZED (
  SELECT q.transaction_id, n.cache_key, c.L1 AS l1, c.L2 AS l2, c.L3 AS l3, c.L4 AS l4,
         'first candidate' AS classification_reason,
         CASE c.branch WHEN 'strong' THEN 'HIGH' WHEN 'moderate' THEN 'MEDIUM' ELSE 'LOW' END AS confidence_level,
         c.branch = 'weak' AS human_review_required, c.full_path AS retrieved_taxonomy
  FROM q JOIN cand c ON c.text = q.text AND c.rank = 1 JOIN needed n ON n.transaction_id = q.transaction_id),
after_run AS (
  SELECT s.cache_key, s.l1, s.l2, s.l3, s.l4, s.classification_reason, s.confidence_level,
         s.human_review_required, s.retrieved_taxonomy
  FROM store s WHERE s.cache_key NOT IN (SELECT cache_key FROM fresh)
  UNION ALL SELECT cache_key, l1, l2, l3, l4, classification_reason, confidence_level,
                   human_review_required, retrieved_taxonomy FROM fresh),
merged AS MATERIALIZED (
  SELECT k.transaction_id, k.spend_description, k.vendor, a.l1, a.l2, a.l3, a.l4, a.classification_reason,
         a.confidence_level, a.human_review_required, a.retrieved_taxonomy, CAST(NULL AS VARCHAR) AS api_error,
         f.transaction_id IS NULL AS from_cache
  FROM keyed k JOIN after_run a ON a.cache_key = k.cache_key
  LEFT JOIN fresh f ON f.transaction_id = k.transaction_id)"""


def _any(column: str, terms: list[str]) -> str:
    return " OR ".join(f"contains({column}, '{t}')" for t in terms)


def rule_case(rules) -> str:
    """The first rule's reason over columns ``txt``, ``a1`` and ``a4``, in lower case."""
    arms = []
    for _, triggers, l4_terms, l1_terms, reason in rules:
        blocked = " OR ".join(filter(None, [_any("a4", l4_terms), _any("a1", l1_terms)])) or "true"
        arms.append(f"WHEN ({_any('txt', triggers)}) AND ({blocked}) THEN '{reason}'")
    return f"CASE WHEN txt = '' OR coalesce(a4, '') = '' THEN NULL {' '.join(arms)} END"


def validated(rules, source: str = "fx_predictions") -> str:
    """CTEs up to ``final``: flags, semantic check, status, notes and routing."""
    texts = "t.spend_description, t.vendor"
    return f"""
p AS (
  SELECT s.*, {texts} FROM {source} s JOIN fx_transactions t ON t.transaction_id = s.transaction_id),
chk AS (
  SELECT *, lower(trim(concat(spend_description, ' ', vendor))) AS txt, lower(l4) AS a4,
         lower(coalesce(l1, 'None')) AS a1,
         trim(coalesce(api_error, '')) NOT IN ('', 'nan', 'None') AS bad FROM p),
flg AS (
  SELECT *,
    NOT bad AND EXISTS (SELECT 1 FROM fx_taxonomy x WHERE x.L1 = chk.l1) AS l1_valid,
    NOT bad AND EXISTS (SELECT 1 FROM fx_taxonomy x WHERE x.L1 = chk.l1 AND x.L2 = chk.l2) AS l2_valid,
    NOT bad AND EXISTS (SELECT 1 FROM fx_taxonomy x WHERE x.L1 = chk.l1 AND x.L2 = chk.l2 AND x.L3 = chk.l3) AS l3_valid,
    NOT bad AND EXISTS (SELECT 1 FROM fx_taxonomy x WHERE x.L1 = chk.l1 AND x.L2 = chk.l2 AND x.L3 = chk.l3
                        AND x.L4 = chk.l4) AS l4_valid,
    CASE WHEN NOT bad THEN {rule_case(rules)} END AS semantic_mismatch_reason FROM chk),
sts AS (
  SELECT *, l1_valid AND l2_valid AND l3_valid AND l4_valid AS full_path_valid,
    semantic_mismatch_reason IS NOT NULL AS semantic_mismatch,
    CASE WHEN bad OR NOT l4_valid THEN 'INVALID'
         WHEN semantic_mismatch_reason IS NOT NULL OR coalesce(human_review_required, true) THEN 'REVIEW'
         ELSE 'VALID' END AS validation_status,
    CASE WHEN bad THEN concat('{fv.NOTE_ERROR}', api_error)
         WHEN NOT l4_valid THEN '{fv.NOTE_BAD_PATH.replace("'", "''")}'
         WHEN semantic_mismatch_reason IS NOT NULL THEN concat('{fv.NOTE_MISMATCH}', semantic_mismatch_reason)
         WHEN coalesce(human_review_required, true) THEN '{fv.NOTE_FLAGGED}'
         ELSE '{fv.NOTE_VALID}' END AS validation_notes FROM flg),
final AS (
  SELECT transaction_id, spend_description, vendor, l1, l2, l3, l4, classification_reason, confidence_level,
    api_error, from_cache, l1_valid, l2_valid, l3_valid, l4_valid, full_path_valid, semantic_mismatch,
    semantic_mismatch_reason, validation_status, validation_notes,
    CASE WHEN validation_status = 'INVALID' THEN 'INVALID'
         WHEN validation_status = 'VALID' AND confidence_level = 'HIGH' THEN 'ACCEPTED'
         ELSE 'REVIEW_REQUIRED' END AS final_status,
    NOT (validation_status = 'VALID' AND coalesce(confidence_level, '') = 'HIGH') AS human_review_required
  FROM sts)"""
