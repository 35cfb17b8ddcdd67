"""Line dedup: lines that many documents share leave every document.

Lines are exploded as hashes of their normalised form, the documents per hash
are counted with a partial aggregate before the shuffle (a line that every
document holds costs one row per task), and the positions of frequent lines
come back to the documents, whose remaining lines are joined in their order.
Line texts never move: only 24-byte rows are shuffled for lines, and each text
crosses the network once, for the join with its dropped positions.

Defined results: a null or empty text is one empty line and is kept; blank
lines (no code point left after stripping) always stay; each row is a
document of its own, so repeated rows count once each; extra columns play no
part, and those to keep may have any names; a very long text is split, hashed
and joined again in work that grows with its lines. An empty table gives no
rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from storefront.llm.shared import SPACE, column, lower_ascii, text_key, written


def line_keys(text: Column) -> Column:
    """The key of every line: white space stripped at both ends, A-Z lower-cased."""
    return F.transform(F.transform(F.split(text, "\n", -1), lambda line: F.btrim(line, F.lit(SPACE))), lower_ascii)


def _hashes(text: Column) -> Column:
    """Per line, a 128-bit hash of its key (null for keys that are empty)."""
    return F.transform(line_keys(text), lambda key: F.when(F.length(key) > 0, F.struct(
        F.xxhash64(key).alias("a"), F.xxhash64(F.lit("2"), key).alias("b"))))


def dedup_lines(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", min_docs: int = 10,
                keep: tuple[str, ...] = ()) -> DataFrame:
    """Per row of ``docs``: ``doc_id``, the columns ``keep``, ``n_lines``,
    ``n_dropped`` and ``kept_text``. Lines whose key occurs in at least
    ``min_docs`` documents are dropped everywhere.

    The hashes are written once to the shared folder, as counting and
    dropping both read them."""
    rows = docs.select(column(docs, doc_id).alias("_id"), F.coalesce(column(docs, text), F.lit("")).alias("_text"),
                       *[column(docs, c).alias(f"_keep_{i}") for i, c in enumerate(keep)])
    key = text_key(F.col("_id"), F.col("_text"))
    hashed = written(rows.select(*key, _hashes(F.col("_text")).alias("hs")), "line-hashes")

    # Each hash of a document once: sorted, then compared with its neighbour (array_distinct compares structs pair by pair).
    in_order = hashed.select(F.sort_array("hs").alias("hs"))
    fresh = F.filter("hs", lambda h, i: h.isNotNull() & ~h.eqNullSafe(F.get("hs", i - 1)))
    per_doc = in_order.select(F.explode(fresh).alias("h"))
    frequent = per_doc.groupBy("h.a", "h.b").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= min_docs)
    # Written first: a join that shuffles both sides itself can be split where one line has most rows.
    frequent = written(frequent.select("a", "b"), "frequent-lines")

    lines = (hashed.select("_k1", "_k2", F.posexplode("hs").alias("pos", "h"))
             .filter("h IS NOT NULL").select("_k1", "_k2", "pos", "h.a", "h.b"))
    drops = (lines.join(frequent, ["a", "b"], "left_semi").groupBy("_k1", "_k2")
             .agg(F.collect_set("pos").alias("_drop")))

    out = rows.select("*", *key).join(drops, ["_k1", "_k2"], "left").withColumn("_lines", F.split("_text", "\n", -1))
    # Positions that stay (hashed set difference, in order), then their lines: work grows with lines plus drops.
    stay = F.array_except(F.sequence(F.lit(0), F.size("_lines") - 1), F.col("_drop"))
    kept = F.when(F.col("_drop").isNull(), F.col("_text")).otherwise(
        F.array_join(F.transform(stay, lambda i: F.col("_lines")[i]), "\n"))
    return out.select(F.col("_id").alias(doc_id), *[F.col(f"_keep_{i}").alias(c) for i, c in enumerate(keep)],
                      F.size("_lines").cast("long").alias("n_lines"),
                      F.coalesce(F.size("_drop"), F.lit(0)).cast("long").alias("n_dropped"),
                      kept.alias("kept_text"))
