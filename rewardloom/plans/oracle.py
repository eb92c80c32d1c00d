"""DuckDB SQL twins of the registered queries.

They start from the driver's tables *relationally* (``conversations`` rows,
never the JSON text the Spark side parses), so a match checks the JSON path,
the cleaning semantics and the ordering rules independently.
"""

from __future__ import annotations

from rewardloom.config import UNICODE_WS

# Unicode whitespace set for DuckDB's two-argument trim.
WS_SQL = "||".join(f"chr({ord(c)})" for c in UNICODE_WS)


def ustrip(x: str) -> str:
    return f"trim({x}, {WS_SQL})"


NUM_RE = r"[ \t\n\x0B\f\r]*[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)([eE][+-]?[0-9]+)?[ \t\n\x0B\f\r]*"
INF_RE = r"[ \t\n\x0B\f\r]*[+-]?inf(inity)?[ \t\n\x0B\f\r]*"


def coerce(x: str) -> str:
    d = f"TRY_CAST(trim({x}, chr(9)||chr(10)||chr(11)||chr(12)||chr(13)||chr(32)) AS DOUBLE)"
    return (f"(CASE WHEN regexp_full_match({x}, '{NUM_RE}') THEN "
            f"(CASE WHEN isinf({d}) THEN NULL ELSE {d} END) "
            f"WHEN regexp_full_match(lower({x}), '{INF_RE}') THEN {d} END)")


def key(q: str, a: str) -> str:
    return (f"concat(substr(lower({ustrip(q)}), 1, 200), '|||', "
            f"substr(lower({ustrip(a)}), 1, 200))")


CTE = {
    "fx_user": "SELECT c_custkey AS id, concat(lower(c_name), '@example.com') AS email FROM customer",
    "fx_messages": """
SELECT conv_id AS chat_id, turn, role,
  CASE WHEN conv_id % 11 = 0 THEN -1 ELSE conv_id END AS user_id,
  CASE WHEN (conv_id + turn) % 17 = 0 THEN '   '
       WHEN turn % 4 = 1 THEN concat('  ', text, chr(9)) ELSE text END AS content,
  CASE WHEN (conv_id + turn) % 13 = 0 THEN NULL
       ELSE 1704067200 + (conv_id % 7) * 86400 + turn * 60 + conv_id END AS epoch,
  (conv_id * 7 + turn * 3) % 10 AS h
FROM conversations""",
    # every message with the fields its JSON carries, and its parent's content
    "fx_msg": """
SELECT m.chat_id, m.turn, CAST(m.turn AS INTEGER) AS msg_pos, 'm' || CAST(m.turn AS VARCHAR) AS message_id,
  m.role, m.user_id, m.content, m.epoch, m.h, m.h <= 7 AS rated,
  CASE WHEN m.role = 'assistant' THEN 'model-' || CAST(m.chat_id % 3 AS VARCHAR) END AS model,
  CASE WHEN m.h <= 4 THEN CAST(m.h + 1 AS VARCHAR)
       WHEN m.h = 5 AND m.chat_id % 2 = 0 THEN '10' WHEN m.h = 5 THEN '-1'
       WHEN m.h = 6 THEN 'n/a' END AS rating,
  CASE WHEN m.h <= 4 THEN 'r' || CAST(m.h AS VARCHAR) END AS reason,
  CASE WHEN m.h = 5 THEN 'c' END AS comment,
  CASE WHEN m.turn > 0 THEN 'm' || CAST(m.turn - 1 AS VARCHAR) END AS parent_id,
  p.content AS question
FROM fx_messages m LEFT JOIN fx_messages p ON p.chat_id = m.chat_id AND p.turn = m.turn - 1""",
    "fx_feedback": """
SELECT m.*, u.email FROM fx_msg m JOIN fx_user u ON u.id = m.user_id WHERE m.rated""",
    "fx_unrated": """
SELECT m.*, u.email FROM fx_msg m JOIN fx_user u ON u.id = m.user_id
WHERE NOT m.rated AND m.role = 'assistant'""",
    "fx_coerced": f"""
SELECT chat_id, turn, msg_pos, email, model, epoch, rating AS rating_text, {coerce('rating')} AS rating,
  reason, comment, question, content AS answer FROM fx_feedback""",
    "fx_clean": f"""
SELECT chat_id, turn, msg_pos, email, model, epoch, rating, reason, comment,
  {ustrip('question')} AS question, {ustrip('answer')} AS answer
FROM fx_coerced
WHERE rating IS NOT NULL AND NOT isnan(rating) AND question IS NOT NULL AND answer IS NOT NULL
  AND {ustrip('question')} <> '' AND {ustrip('answer')} <> ''""",
    "fx_samples": """
SELECT *, greatest(-1.0, least(1.0, (rating - 3.0) / 2.0)) AS reward FROM fx_clean""",
    "fx_rated": """
SELECT d.doc_id, concat('Q ', d.lang, ' ', d.source) AS question, d.text AS answer,
  CAST(1 + (l.quality * 3 + l.toxic + d.doc_id % 2) AS DOUBLE) AS rating,
  1704067200 + (d.doc_id * 37) % 100000 AS epoch
FROM documents d JOIN labels l ON l.doc_id = d.doc_id""",
    "fx_rated_dup": """
SELECT * FROM fx_rated
UNION ALL
SELECT doc_id + 1000000, upper(question), concat(' ', answer, '  '), 6 - rating,
  CASE WHEN doc_id % 5 = 0 THEN NULL WHEN doc_id % 2 = 0 THEN epoch + 500 ELSE epoch - 500 END
FROM fx_rated""",
    "fx_responses": """
SELECT doc_id, doc_id % 3 AS epoch_no, CAST(floor(doc_id / 8) AS BIGINT) AS batch_idx, question,
  CASE WHEN doc_id % 4 = 0 THEN concat('new ', answer)
       WHEN doc_id % 4 = 1 THEN concat(answer, ' tail') ELSE answer END AS response
FROM fx_rated""",
    "fx_cache": f"""
SELECT key, reward, n_ratings FROM (
  SELECT key, reward, count(*) OVER (PARTITION BY key) AS n_ratings,
    row_number() OVER (PARTITION BY key ORDER BY epoch ASC NULLS LAST, doc_id DESC) AS rn
  FROM (SELECT {key('question', 'answer')} AS key, doc_id, epoch,
               greatest(-1.0, least(1.0, (rating - 3.0) / 2.0)) AS reward FROM fx_rated_dup))
WHERE rn = 1""",
    "fx_scored": f"""
SELECT r.doc_id, r.epoch_no, r.batch_idx, CAST(coalesce(c.reward, 0.0) AS FLOAT) AS reward,
  c.key IS NOT NULL AS hit
FROM (SELECT *, {key('question', 'response')} AS key FROM fx_responses) r
LEFT JOIN fx_cache c ON c.key = r.key""",
    "fx_prompts": """
SELECT doc_id AS prompt_id, text AS prompt FROM documents UNION ALL SELECT -1, '   '""",
}

# dependency order of the CTEs above
_ORDER = ["fx_user", "fx_messages", "fx_msg", "fx_feedback", "fx_unrated", "fx_coerced",
          "fx_clean", "fx_samples", "fx_rated", "fx_rated_dup", "fx_responses", "fx_cache",
          "fx_scored", "fx_prompts"]


def with_ctes(body: str, *extra: tuple[str, str]) -> str:
    """Prefix ``body`` with the CTEs it mentions (and their dependencies)."""
    defs = dict(CTE)
    order = list(_ORDER)
    for name, sql in extra:
        defs[name] = sql
        order.append(name)
    needed: set[str] = set()

    def need(name: str):
        if name in needed:
            return
        needed.add(name)
        for dep in order:
            if dep != name and dep in defs[name]:
                need(dep)

    text = body + " ".join(s for _, s in extra)
    for name in order:
        if name in text:
            need(name)
    parts = [f"{n} AS ({defs[n]}\n)" for n in order if n in needed]
    return ("WITH RECURSIVE " + ",\n".join(parts) + "\n" if parts else "") + body


SPLIT_RE = r"[ \t\n\r\f\x0B]+"


def tokens(x: str) -> str:
    """Whitespace tokens of ``x`` (same rule as functions.text.corpus_tokens)."""
    return f"list_filter(string_split_regex({ustrip(x)}, '{SPLIT_RE}'), lambda t: t <> '')"


def vocab_sql(source: str) -> str:
    """Vocabulary over ``source`` (a query yielding one column ``txt``)."""
    return f"""
SELECT token, CAST(row_number() OVER (ORDER BY n DESC, token) + 2 AS BIGINT) AS token_id, n
FROM (SELECT token, count(*) AS n
      FROM (SELECT unnest({tokens('txt')}) AS token FROM ({source}))
      WHERE token NOT IN ('<pad>', '</s>', '<unk>') GROUP BY token)
UNION ALL SELECT '<pad>', 0, 0 UNION ALL SELECT '</s>', 1, 0 UNION ALL SELECT '<unk>', 2, 0"""
