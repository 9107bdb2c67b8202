"""SQL twins of the queries that SQL can express."""


def _marks(text, more=""):
    """How many backslashes the chat format puts into a text."""
    places = f"range(1, length({text}) + 1)"
    controls = [("'\\'", 1), ("'###'", 3), ("'</turn>'", 7)] + ([("':'", 1)] if more else [])
    tests = " OR ".join(f"substr({text}, CAST(i AS INT), {n}) = {c}" for c, n in controls)
    return f"len(list_filter({places}, lambda i: {tests}))"


_SAID = "'\\### Assistant: </turn> ok'"
_ORDER = "ORDER BY turn NULLS FIRST, role, text"
_LOSS = "FILTER (WHERE role = 'assistant')"

OP2 = f"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', {_SAID} UNION ALL SELECT -7, 1, 'assistant', {_SAID})
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' {_ORDER})) AS turns_sha256,
  CAST(coalesce(sum(length(text)) {_LOSS}, 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' {_ORDER}) {_LOSS}, '')) AS loss_sha256,
  CAST(sum(14 + length(role) + length(text) + {_marks('text')} + {_marks('role', 'colons')}) AS BIGINT)
    AS formatted_chars
FROM turns GROUP BY conv_id
"""

OP5 = """
WITH whole AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v
  FROM embeddings
  WHERE embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.v, c.v) AS BIGINT) AS score
  FROM whole q JOIN whole c ON q.vec_id % 50 = 0 AND q.vec_id <> c.vec_id AND len(q.v) = len(c.v)),
ranked AS (
  SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INT)
    AS rank, vec_id, score
  FROM scored)
SELECT * FROM ranked WHERE rank <= 5
"""

OP12 = """
WITH whole AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT a.vec_id AS anchor_id, c.vec_id, a.label = c.label AS same,
    CAST(list_inner_product(a.v, c.v) AS BIGINT) AS score
  FROM whole a JOIN whole c ON a.vec_id % 50 = 0 AND a.vec_id <> c.vec_id AND len(a.v) = len(c.v)),
positives AS (
  SELECT * FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5),
ranked AS (
  SELECT p.anchor_id, p.vec_id AS positive_id,
    CAST(row_number() OVER (PARTITION BY p.anchor_id, p.vec_id ORDER BY n.score DESC, n.vec_id) AS INT)
      AS rank, n.vec_id AS negative_id, p.score AS positive_score, n.score AS negative_score
  FROM positives p JOIN scored n ON p.anchor_id = n.anchor_id AND NOT n.same
    AND 50 * p.score <= 100 * n.score AND 100 * n.score <= 95 * p.score)
SELECT * FROM ranked WHERE rank <= 3
"""
