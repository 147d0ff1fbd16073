"""DuckDB statements for the queries of this folder that SQL can express on whole small tables."""

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _lower(column: str) -> str:
    return f"translate(coalesce({column}, ''), '{_UPPER}', '{_LOWER}')"


def _words(column: str, pattern: str) -> str:
    return f"regexp_extract_all({_lower(column)}, '{pattern}')"


_ALNUM = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
_NOT_SPACE = r"[^\x20\x09-\x0D]+"

#: Links between documents, then the smallest document that they lead to.
_REACH = """
reach AS (
  SELECT a AS node, a AS seen FROM nodes
  UNION
  SELECT reach.node, links.b FROM reach JOIN links ON links.a = reach.seen
)
"""



def _rounds(count: int) -> str:
    """Parts assigned to the nearest entries, and entries moved to the mean of their parts, ``count`` times over."""
    steps = []
    for k in range(count + 1):
        steps.append(f"""near{k} AS (
  SELECT id, part, p, arg_min(entry, (d, entry)) AS entry, min(d) AS d
  FROM (
    SELECT parts.id, part, parts.p, entry, list_sum(list_transform(list_zip(parts.p, e), lambda x: (x[1] - x[2]) ** 2))::BIGINT AS d
    FROM parts JOIN book{k} USING (part)
  ) GROUP BY ALL
)""")
        if k < count:
            steps.append(f"""sums{k} AS (
  SELECT part, entry, pos, sum(x)::BIGINT AS s, count(*) AS n
  FROM (SELECT part, entry, unnest(p) AS x, unnest(range(len(p))) AS pos FROM near{k}) GROUP BY ALL
), means{k} AS (
  SELECT part, entry, list(floor(s::DOUBLE / n)::BIGINT ORDER BY pos) AS e FROM sums{k} GROUP BY ALL
), book{k + 1} AS (
  SELECT part, entry, coalesce(means{k}.e, book{k}.e) AS e FROM book{k} LEFT JOIN means{k} USING (part, entry)
)""")
    return ", ".join(steps)


ORACLE = {
    "op2_decontaminate": f"""
WITH items AS (
  SELECT item_id, {_words("text", _ALNUM)} AS w FROM benchmark
), windows AS (
  SELECT DISTINCT item_id, least(10, len(w)) AS n, list_slice(w, k, k + least(10, len(w)) - 1) AS win
  FROM (SELECT item_id, w, unnest(range(1, len(w) - least(10, len(w)) + 2)) AS k FROM items WHERE len(w) > 0)
), docs AS (
  SELECT doc_id, {_words("text", _ALNUM)} AS w FROM documents
), starts AS (
  SELECT doc_id, k, n, list_slice(w, k, k + n - 1) AS win
  FROM (
    SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS k
    FROM docs, (SELECT DISTINCT n FROM windows) WHERE len(w) >= n
  )
), found AS (
  SELECT doc_id, k, starts.n, item_id FROM starts JOIN windows USING (win)
), hit AS (
  SELECT doc_id, count(DISTINCT place) AS n_hit
  FROM (SELECT doc_id, unnest(range(k, k + n)) AS place FROM found) GROUP BY doc_id
), ids AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS joined
  FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item FROM found) GROUP BY doc_id
)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
  sha256(coalesce(joined, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM docs LEFT JOIN hit USING (doc_id) LEFT JOIN ids USING (doc_id)
""",
    "op5_warc": """
WITH p AS (
  SELECT page_id, coalesce(html, '') AS html, octet_length(encode(coalesce(html, ''))) AS n FROM pages
), g AS (
  SELECT html, max(page_id) AS last FROM p WHERE n >= 1000 GROUP BY html
)
SELECT page_id, n::BIGINT AS payload_bytes, sha1(p.html) AS payload_digest,
  CASE WHEN last <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN last <> page_id THEN last END AS refers_to
FROM p LEFT JOIN g USING (html)
""",
    "op8_ngram_join": f"""
WITH docs AS (
  SELECT doc_id, {_words("text", _NOT_SPACE)} AS w FROM documents
), sets AS (
  SELECT DISTINCT doc_id, list_slice(w, k, k + 2) AS gram
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 1, 2))) AS k FROM docs WHERE len(w) > 0)
), sizes AS (
  SELECT doc_id, count(*) AS n FROM sets GROUP BY doc_id
), common AS (
  SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c
  FROM sets x JOIN sets y ON x.gram = y.gram AND x.doc_id <> y.doc_id GROUP BY ALL
), links AS (
  SELECT a, b FROM common JOIN sizes s ON s.doc_id = a JOIN sizes t ON t.doc_id = b WHERE 100 * c >= 90 * (s.n + t.n - c)
), nodes AS (
  SELECT DISTINCT a FROM links
), parts AS (
  WITH RECURSIVE {_REACH} SELECT node, min(seen) AS low FROM reach GROUP BY node
)
SELECT doc_id, coalesce(n, 0)::BIGINT AS n_shingles, coalesce(low, doc_id) AS component_id
FROM docs LEFT JOIN sizes USING (doc_id) LEFT JOIN parts ON node = doc_id
""",
    "op9_nn_descent": f"""
WITH v AS (
  SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings
  WHERE len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0
), links AS (
  SELECT x.vec_id AS a, y.vec_id AS b FROM v x JOIN v y ON x.vec_id <> y.vec_id AND len(x.e) = len(y.e)
  WHERE list_cosine_similarity(x.e, y.e) >= 0.95
), nodes AS (
  SELECT DISTINCT a FROM links
), parts AS (
  WITH RECURSIVE {_REACH} SELECT node, min(seen) AS low FROM reach GROUP BY node
), counted AS (
  SELECT a, count(*) AS n FROM links GROUP BY a
)
SELECT vec_id, coalesce(n, 0)::BIGINT AS n_links, coalesce(low, vec_id) AS component_id, coalesce(low, vec_id) = vec_id AS kept
FROM embeddings LEFT JOIN counted ON a = vec_id LEFT JOIN parts ON node = vec_id
""",
    "op10_suffixes": f"""
WITH docs AS (
  SELECT doc_id, {_words("text", _ALNUM)} AS w FROM documents
), starts AS (
  SELECT doc_id, k, list_slice(w, k + 1, k + 50) AS win
  FROM (SELECT doc_id, w, unnest(range(0, len(w) - 49)) AS k FROM docs WHERE len(w) >= 50)
), held AS (
  SELECT win, count(DISTINCT doc_id) AS n, min(doc_id) AS low FROM starts GROUP BY win
), own AS (
  SELECT doc_id, k, n, low, k > coalesce(lag(k) OVER (PARTITION BY doc_id ORDER BY k), -1000) + 50 AS opens
  FROM starts JOIN held USING (win) WHERE n > 1
), runs AS (
  SELECT *, sum(opens::INT) OVER (PARTITION BY doc_id ORDER BY k) AS run FROM own
)
SELECT doc_id, min(k)::BIGINT AS "start", (max(k) + 50)::BIGINT AS "end", max(n)::BIGINT AS n_docs, min(low) AS first_doc
FROM runs GROUP BY doc_id, run
""",
    "op12_ranked_search": rf"""
WITH d AS (
  SELECT doc_id, unnest({_words("text", _TERM)}) AS term FROM documents
), held AS (
  SELECT doc_id, term, count(*) AS tf FROM d GROUP BY ALL
), sizes AS (
  SELECT doc_id, sum(tf)::BIGINT AS n FROM held GROUP BY doc_id
), whole AS (
  SELECT count(*) AS docs, sum(n)::BIGINT AS words FROM sizes
), weights AS (
  SELECT term, floor(1000 * ln((2 * docs + 2)::DOUBLE / (2 * count(*) + 1)))::BIGINT AS w FROM held, whole GROUP BY term, docs
), asked AS (
  SELECT item_id, term, count(*) AS times FROM (SELECT item_id, unnest({_words("text", _TERM)}) AS term FROM benchmark) GROUP BY ALL
), scores AS (
  SELECT item_id, doc_id,
    sum(times * w * ((1000000000 * tf) // (1000 * tf + 8 * (25 + (75 * n * docs) // words))))::BIGINT AS score
  FROM asked JOIN weights USING (term) JOIN held USING (term) JOIN sizes USING (doc_id), whole GROUP BY ALL
)
SELECT item_id, (row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id))::INT AS rank, doc_id, score
FROM scores WHERE score > 0 QUALIFY rank <= 10
""",
    "op13_vector_codes": f"""
WITH kept AS (
  SELECT vec_id, label, list_transform(embedding, lambda x: floor(x::DOUBLE * 1024)::BIGINT) AS v,
    row_number() OVER (ORDER BY vec_id) - 1 AS id
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), parts AS (
  SELECT id, part, list_slice(v, part * len(v) // 4 + 1, (part + 1) * len(v) // 4) AS p
  FROM kept, (SELECT unnest(range(4)) AS part)
), book0 AS (
  SELECT part, id AS entry, p AS e FROM parts WHERE id < 256
), {_rounds(4)}, digest AS (
  SELECT sha256(string_agg(x::VARCHAR, ',' ORDER BY part, entry, pos)) AS codebooks_sha256
  FROM (SELECT part, entry, unnest(e) AS x, unnest(range(len(e))) AS pos FROM book4)
), coded AS (
  SELECT id, string_agg(printf('%02x', entry), '' ORDER BY part) AS code, sum(d)::BIGINT AS error FROM near4 GROUP BY id
)
SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error, codebooks_sha256
FROM coded JOIN kept USING (id), digest
""",
}
