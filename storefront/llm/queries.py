"""One query per operator, over its whole table, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from storefront.llm import (decontaminate, html_extraction, line_dedup, mixing, prefix_trie, quality_lm, simhash, substring_dedup,
                            tokenizer_alignment, topk, toxicity, url_filter, warc)
from storefront.llm.shared import new_path


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines that 10 or more documents share leave every document."""
    out = line_dedup.dedup_lines(_table(spark, sf_dir, "documents"), min_docs=10)
    return out.select("doc_id", "n_lines", "n_dropped", F.sha2("kept_text", 256).alias("kept_sha256"))


def op2_quality_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that the language model of trusted text finds likely enough."""
    out = quality_lm.classify(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"), carry=("doc_id",))
    return out.filter("keep").select("row.doc_id", "lang", "perplexity", "threshold")


def op3_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sources mixed 3:1:2 to 150 % of all words, none above twice its size."""
    out = mixing.mix(_table(spark, sf_dir, "documents"), weights=(3, 1, 2), share=1.5, most=2)
    return out.select("doc_id", "size", "source_size", "target", "taken")


def op4_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages judged by the URL lists in force when they were fetched.

    Fetch times and dated list entries are derived from the tables: a page's
    time from its id; an entry from each event, on the page its user id names
    (host, parent domain, first folder or URL in turn), in the list of its
    type, every third one a removal."""
    pages = _table(spark, sf_dir, "pages").select("page_id", "url")
    events = _table(spark, sf_dir, "events").select("event_id", "user_id", "event_type", F.col("ts").cast("timestamp_ntz").alias("at"))
    named = events.join(pages, F.col("user_id") == F.col("page_id"))
    host, kind = url_filter.url_host(F.col("url")), F.col("event_id") % 4
    folder = F.concat(host, F.lit("/"), F.split(url_filter.url_path(F.col("url")), "/").getItem(1), F.lit("/"))
    full = F.regexp_replace(F.regexp_replace("url", url_filter.SCHEME + "[^/?#]*", ""), "#.*", "")
    key = (F.when(kind == 0, F.concat(F.lit("host:"), host))
           .when(kind == 1, F.concat(F.lit("domain:"), F.regexp_replace(host, r"^[^.]*\.", "")))
           .when(kind == 2, F.concat(F.lit("folder:"), folder)).otherwise(F.concat(F.lit("url:"), host, full)))
    entries = named.select(F.col("event_type").alias("list"), key.alias("key"), (F.col("event_id") % 3 != 0).alias("added"), "at")
    fetched = F.expr("timestamp_ntz'2024-01-01 00:00:00' + make_dt_interval(0, 0, 0, page_id * 7919 % 2592000)")
    out = url_filter.judge(pages.withColumn("fetched", fetched), entries)
    return out.select("row.page_id", "blocked", "n_rules", "lists")


def op5_warc_archives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages written to dictionary-compressed WARC archives and read back."""
    path = new_path(spark, "warc")
    warc.write_archives(_table(spark, sf_dir, "pages"), path, least_revisit=100)
    return warc.read_archives(spark, path).select("page_id", "payload_bytes", "payload_digest", "record_type",
                                                  "refers_to")


def op6_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words in windows of 35 words that start anywhere else are removed."""
    out = substring_dedup.remove_repeats(_table(spark, sf_dir, "documents"), window=35)
    return out.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


def op7_benchmark_leaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents holding 80 % or more of a test item's five-word shingles."""
    found = decontaminate.leaks_of(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"),
                                   shingle=5, share=0.8)
    return found.select("row.doc_id", "leak.item_id", "leak.shared", "leak.size", "leak.containment")


def op8_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 5 best inner products of every 50th vector among all others."""
    return topk.top_k(_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0, k=5, scale=256)


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity scores of all documents, learnt from the training labels."""
    return toxicity.score(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages of ``corpus_pipeline`` one after the other."""
    import corpus_pipeline  # here: without it the operators' own queries still work
    return corpus_pipeline.run(spark, sf_dir)


def op10_simhash_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups of documents whose fingerprints link at 3 bits or fewer."""
    out = simhash.near_duplicates(_table(spark, sf_dir, "documents"), shingle=3, max_bits=3)
    return out.select("doc_id", "fingerprint", "component_id")


def op11_tokenizer_alignment(spark: SparkSession, sf_dir: str, folder: str = "/opt/tokenizers") -> DataFrame:
    """A byte-level BPE and a BPE of pieces aligned over all documents."""
    out = tokenizer_alignment.align(_table(spark, sf_dir, "documents"), f"{folder}/byte_bpe_50k.json", f"{folder}/piece_bpe_32k.model")
    return out.select("row.doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


def op12_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The main text of every page by a recurrent block labeller."""
    out = html_extraction.main_text(_table(spark, sf_dir, "pages"), keep=("page_id", "url"))
    return out.select("row.page_id", "row.url", "text", "n_chars")


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The prefix trie of all conversations, rebuilt with their block's heads."""
    out = prefix_trie.conversation_trie(_table(spark, sf_dir, "conversations"), block=20, heads=4)
    return out.select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_line_dedup": op1_line_dedup,
    "op2_quality_lm": op2_quality_lm,
    "op3_mix_sources": op3_mix_sources,
    "op4_url_filter": op4_url_filter,
    "op5_warc_archives": op5_warc_archives,
    "op6_substring_dedup": op6_substring_dedup,
    "op7_benchmark_leaks": op7_benchmark_leaks,
    "op8_exact_top_k": op8_exact_top_k,
    "op9_toxicity": op9_toxicity,
    "op10_simhash_groups": op10_simhash_groups,
    "pipeline": pipeline,
    "op11_tokenizer_alignment": op11_tokenizer_alignment,
    "op12_html_extraction": op12_html_extraction,
    "op13_prefix_trie": op13_prefix_trie,
}

_LINES = """
    lines AS (
        SELECT doc_id, u.i AS pos, l[u.i] AS line,
               translate(trim(l[u.i], chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                         'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k
        FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS l FROM documents),
             LATERAL (SELECT unnest(range(1, len(l) + 1)) AS i) u),
    frequent AS (SELECT k FROM lines WHERE k <> '' GROUP BY k HAVING count(DISTINCT doc_id) >= 10)"""

SQL: dict[str, str] = {
    "op1_line_dedup": f"""
WITH {_LINES}
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (f.k IS NOT NULL) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (f.k IS NULL), '')) AS kept_sha256
FROM lines LEFT JOIN frequent f ON lines.k = f.k
GROUP BY doc_id""",
    "op3_mix_sources": """
WITH sized AS (
        SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+'))::BIGINT AS size,
               ('0x' || substr(md5(concat_ws('|', coalesce(doc_id::VARCHAR, '\\N'), coalesce(source, '\\N'),
                                             coalesce(text, '\\N'))), 1, 15))::BIGINT AS u
        FROM documents),
    sizes AS (SELECT source, sum(size)::BIGINT AS source_size FROM sized GROUP BY source),
    caps AS (
        SELECT source, source_size, [3, 1, 2][((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::INT] AS w,
               2 * source_size AS cap, 1.5::DOUBLE * (sum(source_size) OVER ())::DOUBLE AS budget
        FROM sizes),
    levels AS (
        SELECT a.*, (budget - coalesce((SELECT sum(b.cap) FROM caps b WHERE b.cap::DOUBLE / b.w < a.cap::DOUBLE / a.w), 0)::DOUBLE)
                    / (SELECT sum(b.w) FROM caps b WHERE b.cap::DOUBLE / b.w >= a.cap::DOUBLE / a.w)::DOUBLE AS level
        FROM caps a),
    goal AS (
        SELECT source, source_size,
               least(coalesce((SELECT max(level) FROM levels WHERE level * w <= cap) * w, cap::DOUBLE), cap::DOUBLE) AS target
        FROM levels),
    running AS (
        SELECT s.doc_id, s.size, g.source_size, g.target, coalesce(floor(g.target / nullif(g.source_size, 0)), 0) AS copies,
               sum(s.size) OVER (PARTITION BY s.source ORDER BY s.u) AS upto,
               sum(s.size) OVER (PARTITION BY s.source, s.u) AS here
        FROM sized s JOIN goal g ON s.source IS NOT DISTINCT FROM g.source)
SELECT doc_id, size, source_size, target,
       (size * (copies + CASE WHEN upto <= rest OR (upto - here < rest AND upto - rest < rest - (upto - here))
                              THEN 1 ELSE 0 END))::BIGINT AS taken
FROM (SELECT *, target - copies * source_size AS rest FROM running)""",
    "op5_warc_archives": """
WITH p AS (
        SELECT page_id, encode(coalesce(html, '')) AS payload FROM pages),
    d AS (SELECT page_id, octet_length(payload) AS payload_bytes, sha256(payload) AS payload_digest FROM p),
    f AS (SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS first FROM d)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN payload_bytes >= 100 AND page_id <> first THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= 100 AND page_id <> first THEN first END AS refers_to
FROM f""",
    "op4_url_filter": r"""
WITH p AS (
        SELECT page_id, url, lower(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)', 1)) AS host,
               regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)', 1) AS raw_path,
               regexp_extract(url, '^[^?#]*([?][^#]*)', 1) AS query,
               TIMESTAMP '2024-01-01' + (page_id * 7919 % 2592000) * INTERVAL 1 SECOND AS fetched
        FROM pages),
    q AS (SELECT *, CASE WHEN raw_path = '' THEN '/' ELSE raw_path END AS path FROM p),
    entries AS (
        SELECT event_type AS list, ts AS at, bool_or(event_id % 3 <> 0) AS added,
               CASE event_id % 4 WHEN 0 THEN 'host:' || host
                    WHEN 1 THEN 'domain:' || regexp_replace(host, '^[^.]*[.]', '')
                    WHEN 2 THEN 'folder:' || host || '/' || string_split(path, '/')[2] || '/'
                    ELSE 'url:' || host || raw_path || query END AS key
        FROM events JOIN q ON user_id = page_id GROUP BY ALL),
    keys AS (
        SELECT page_id, fetched, 'host:' || host AS key FROM q WHERE host <> ''
        UNION SELECT page_id, fetched, 'url:' || host || path || query FROM q WHERE host <> ''
        UNION SELECT page_id, fetched, 'domain:' || array_to_string(string_split(host, '.')[i:], '.')
              FROM q, LATERAL (SELECT unnest(range(1, len(string_split(host, '.')) + 1)) AS i) WHERE host <> ''
        UNION SELECT page_id, fetched, 'folder:' || host || array_to_string(string_split(path, '/')[:i], '/') || '/'
              FROM q, LATERAL (SELECT unnest(range(1, len(string_split(path, '/')))) AS i) WHERE host <> ''),
    asked AS (SELECT * FROM keys, (SELECT DISTINCT list FROM entries)),
    hits AS (
        SELECT a.page_id, a.list FROM asked a ASOF JOIN entries e
        ON a.key = e.key AND a.list = e.list AND a.fetched >= e.at WHERE e.added)
SELECT q.page_id, count(h.page_id) > 0 AS blocked, count(h.page_id) AS n_rules,
       coalesce(string_agg(DISTINCT h.list, ',' ORDER BY h.list), '') AS lists
FROM q LEFT JOIN hits h ON q.page_id = h.page_id GROUP BY q.page_id""",
    "op8_exact_top_k": """
WITH v AS (
        SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS q FROM embeddings
        WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
    s AS (SELECT a.vec_id AS query_id, b.vec_id, list_dot_product(a.q::DOUBLE[], b.q::DOUBLE[])::BIGINT AS score
          FROM v a JOIN v b ON a.vec_id <> b.vec_id WHERE a.vec_id % 50 = 0),
    r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INT AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5""",
    "op6_substring_dedup": r"""
WITH words AS (
        SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
    places AS (SELECT doc_id, unnest(range(1, len(w) - 33)) AS i, w FROM words),
    windows AS (SELECT doc_id, i, md5(array_to_string(w[i:i + 34], ' ')) AS h FROM places),
    again AS (SELECT h FROM windows GROUP BY h HAVING count(*) > 1),
    gone AS (SELECT DISTINCT doc_id, unnest(range(i, i + 35)) AS i FROM windows SEMI JOIN again USING (h)),
    each AS (SELECT doc_id, unnest(w) AS x, unnest(range(1, len(w) + 1)) AS i FROM words),
    kept AS (
        SELECT e.doc_id, count(*) AS n_kept, string_agg(x, ' ' ORDER BY e.i) AS t
        FROM each e ANTI JOIN gone g ON e.doc_id = g.doc_id AND e.i = g.i GROUP BY e.doc_id)
SELECT doc_id, len(w) AS n_words, len(w) - coalesce(n_kept, 0) AS n_removed, sha256(coalesce(t, '')) AS kept_sha256
FROM words LEFT JOIN kept USING (doc_id)""",
    "op13_prefix_trie": r"""
WITH own AS (
        SELECT conv_id AS c, list({'role': coalesce(role, ''), 'text': coalesce(text, '')} ORDER BY turn NULLS FIRST) AS t
        FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id),
    hashed AS (
        SELECT c, t, xor(list_reduce(list_transform(range(1, len(c::VARCHAR) + 1), lambda i: ascii((c::VARCHAR)[i])::BIGINT),
                                     lambda crc, byte: list_reduce(range(8), lambda x, bit: CASE WHEN x % 2 = 1
                                         THEN xor(x // 2, 3988292384) ELSE x // 2 END, xor(crc, byte)), 4294967295::BIGINT),
                         4294967295) % 4 AS h
        FROM own),
    rebuilt AS (
        SELECT a.c, list_concat(coalesce(b.t[1:a.h], []), a.t[a.h + 1:]) AS t
        FROM hashed a LEFT JOIN own b ON b.c = a.c - a.c % 20),
    places AS (
        SELECT c, d, md5(t[1:d]::VARCHAR) AS node, CASE WHEN d > 0 THEN md5(t[1:d - 1]::VARCHAR) END AS above, d = len(t) AS last,
               CASE WHEN d > 0 THEN len(regexp_extract_all(t[d].text, '[^\x20\x09-\x0D]+')) ELSE 0 END AS words
        FROM rebuilt, LATERAL (SELECT unnest(range(len(t) + 1)) AS d)),
    nodes AS (
        SELECT node, d, any_value(above) AS above, min(c) AS c, count(*) AS n, (count(*) - 1) * any_value(words) AS saved,
               sha256(coalesce(string_agg(c::VARCHAR, ',' ORDER BY c) FILTER (last), '')) AS ends
        FROM places GROUP BY node, d),
    kids AS (SELECT above, d - 1 AS d, count(*) AS n FROM nodes WHERE d > 0 GROUP BY ALL),
    tree AS (SELECT nodes.*, coalesce(kids.n, 0) AS children FROM nodes LEFT JOIN kids ON nodes.node = kids.above AND nodes.d = kids.d),
    below AS (
        SELECT p.node, p.d, sum((t.children = 0)::INT) AS leaves, sum(t.saved) AS saved
        FROM tree t JOIN places p ON p.c = t.c AND p.d <= t.d GROUP BY p.node, p.d)
SELECT t.c AS conv_id, t.d::BIGINT AS depth, up.c AS parent_conv_id, t.n AS n_convs, t.children AS n_children,
       b.leaves::BIGINT AS n_leaves, b.saved::BIGINT AS saved_tokens, t.ends AS ends_sha256
FROM tree t JOIN below b ON t.node = b.node AND t.d = b.d LEFT JOIN tree up ON t.above = up.node AND t.d = up.d + 1""",
}
