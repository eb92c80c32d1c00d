"""One query per numbered operator, over the whole of its table."""

from __future__ import annotations

import public_tokenizers

from rewardloom.llm.common import documents, ship, table


def op1_partial_matching(spark, sf_dir):
    from rewardloom.llm.ppm import score
    return score(documents(spark, sf_dir), order=5)


def op2_cube_mix(spark, sf_dir):
    from rewardloom.llm.cube import mix
    return mix(documents(spark, sf_dir)).drop("h")


def op3_paragraph_sketch(spark, sf_dir):
    from rewardloom.llm.iblt import fingerprint
    return fingerprint(documents(spark, sf_dir))


def op4_family_duels(spark, sf_dir):
    from rewardloom.llm.langid import identify
    return identify(documents(spark, sf_dir))


def op5_boosted_toxicity(spark, sf_dir):
    from rewardloom.llm.toxicity import score
    return score(documents(spark, sf_dir), table(spark, sf_dir, "labels"))


def op6_minimum_bin_slack(spark, sf_dir):
    from rewardloom.llm.packing import pack
    return pack(documents(spark, sf_dir), public_tokenizers.path("word_bpe_49k.json"), "dropped", capacity=4096)


def op7_site_posteriors(spark, sf_dir):
    from rewardloom.llm.quality import posteriors
    return posteriors(documents(spark, sf_dir), table(spark, sf_dir, "labels")).drop("h")


def op8_ngram_bands(spark, sf_dir):
    from rewardloom.llm.ngram_join import linked
    return linked(documents(spark, sf_dir)).drop("h", "keeper")


def op9_hilbert_windows(spark, sf_dir):
    from rewardloom.llm.curves import nearest
    return nearest(table(spark, sf_dir, "embeddings"), k=20, every=20)


def op10_patched_blocks(spark, sf_dir):
    from rewardloom.llm.pfor import encode_and_read
    return encode_and_read(documents(spark, sf_dir), public_tokenizers.path("byte_bpe_50k.json"), "kept")


def op11_bucket_shuffle(spark, sf_dir):
    from rewardloom.llm.sharding import shard_and_read
    return shard_and_read(documents(spark, sf_dir), shards=40)


def op12_polarised_whitening(spark, sf_dir):
    from rewardloom.llm.whitening import whiten
    return whiten(table(spark, sf_dir, "embeddings"), components=8)


def op13_automaton_ranking(spark, sf_dir):
    from rewardloom.llm.lexical import search
    return search(documents(spark, sf_dir), table(spark, sf_dir, "benchmark"), k=50)


def _ready(query):
    """Workers import this package; where they can't find it (a session started elsewhere), it is sent to them."""
    def run(spark, sf_dir):
        ship(spark)
        return query(spark, sf_dir)
    return run


def queries() -> dict:
    found = {n: f for n, f in globals().items() if n.startswith("op") and n[2].isdigit()}
    return {n: _ready(found[n]) for n in sorted(found, key=lambda n: int(n[2:].split("_")[0]))}


# every pair of documents that shares a 5-gram, and the documents that links connect
_NGRAM_JOIN_SQL = """
WITH RECURSIVE words AS (
  SELECT doc_id, list_filter(string_split_regex(
           translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\\x20\\x09-\\x0D]+'),
         lambda x: x <> '') AS w
  FROM documents),
grams AS (
  SELECT DISTINCT doc_id, array_to_string(w[i:i + 4], ' ') AS g
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 3, 2))) AS i FROM words WHERE len(w) > 0)),
sizes AS (SELECT doc_id, count(*) AS n FROM grams GROUP BY doc_id),
pairs AS (
  SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS shared
  FROM grams a JOIN grams b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY ALL),
links AS (
  SELECT x, y, shared = s.n AND shared = t.n AS same FROM pairs JOIN sizes s ON s.doc_id = x JOIN sizes t ON t.doc_id = y
  WHERE shared >= 0.8 * (s.n + t.n - shared)
  UNION ALL
  SELECT a.doc_id, b.doc_id, true FROM words a JOIN words b ON a.doc_id <> b.doc_id WHERE len(a.w) = 0 AND len(b.w) = 0),
reached AS (
  SELECT doc_id AS x, doc_id AS y FROM documents
  UNION
  SELECT r.x, l.y FROM reached r JOIN links l ON l.x = r.y),
classes AS (SELECT x AS doc_id, min(y) AS class_id FROM reached GROUP BY x),
counts AS (SELECT x AS doc_id, count(*) AS n_links, min(y) FILTER (same) AS other FROM links GROUP BY x)
SELECT c.doc_id, c.class_id, least(c.doc_id, coalesce(k.other, c.doc_id)) AS text_class, coalesce(k.n_links, 0) AS n_links
FROM classes c LEFT JOIN counts k ON k.doc_id = c.doc_id"""


_RANKING_SQL = """
WITH doc_terms AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+') AS t
  FROM documents),
docs AS (SELECT row_number() OVER () AS row, doc_id, len(t) AS n, t FROM doc_terms WHERE len(t) > 0),
totals AS (SELECT count(*)::BIGINT AS n_docs, sum(n)::BIGINT AS n_terms FROM docs),
tfs AS (SELECT row, doc_id, n, term, count(*) AS tf FROM (SELECT row, doc_id, n, unnest(t) AS term FROM docs) GROUP BY ALL),
items AS (
  SELECT DISTINCT i, item_id, unnest(regexp_extract_all(
           translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) AS term
  FROM (SELECT row_number() OVER () AS i, item_id, text FROM benchmark)),
weighted AS (
  SELECT term, floor(1000 * ln((2.0::DOUBLE * n_docs + 2) / (2.0::DOUBLE * df + 1)))::BIGINT AS w
  FROM (SELECT term, count(*) AS df FROM tfs GROUP BY term), totals),
scores AS (
  SELECT i, item_id, row, doc_id,
         sum(w * ((1000000000 * tf) // (1000 * tf + 20 * (50 + (50 * n * n_docs) // n_terms))))::BIGINT AS score
  FROM items JOIN tfs USING (term) JOIN weighted USING (term), totals GROUP BY i, item_id, row, doc_id)
SELECT item_id, rank, doc_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY i ORDER BY score DESC, doc_id NULLS LAST)::INTEGER AS rank FROM scores WHERE score > 0)
WHERE rank <= 50"""


def oracle_sql() -> dict:
    return {"op8_ngram_bands": _NGRAM_JOIN_SQL, "op13_automaton_ranking": _RANKING_SQL}
