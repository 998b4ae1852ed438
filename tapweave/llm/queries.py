"""Registered queries of the corpus operators, with SQL twins where SQL can express them."""

from __future__ import annotations

import zlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tapweave.functions.stage import Stages
from tapweave.llm import (
    exactdup, hostgraph, mixing, neardup, packing, periodic, pii, prefixtrie, quality, rowrules, topk, toxicity, warc,
)
from tapweave.llm.common import id_crc, table


def held_out(modulus: int, part: int):
    return id_crc() % modulus == part


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    model = toxicity.fit(docs, labels, ~held_out(5, 0))
    scored = toxicity.with_score(docs.select("doc_id", "text"), model)
    return scored.select("doc_id", held_out(5, 0).alias("held_out"), "score", "predicted")


def op2_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages, stages = table(spark, sf_dir, "pages"), Stages(spark)
    manifest = warc.write_archives(pages, stages.path("warc"), stages)
    return warc.read_records(pages, manifest)


def op3_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = hostgraph.judge(table(spark, sf_dir, "pages").select("page_id", "url", "html"), Stages(spark))
    return judged.select("page_id", "host", "path", "rule", "verdict", "trust", "distrust")


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    stats = Stages(spark).write(quality.with_statistics(docs).select("doc_id", *quality.STATISTICS), "statistics")
    model = quality.fit(stats, labels, ~held_out(3, 1))
    return quality.with_score(stats, model).select("doc_id", held_out(3, 1).alias("held_out"), "score", "predicted")


def op5_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0, Stages(spark))


def op6_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.digested(pii.with_spans(table(spark, sf_dir, "documents").select("doc_id", "text")))


# Half of all tokens, however rare the rarest cell is.
OP7_MIX = mixing.Mix(budget=0.5)


def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source", "lang")
    mixed = mixing.calibrated(docs, OP7_MIX, Stages(spark))
    return mixed.select(
        "doc_id", "source", "lang", F.col("mix_topic").alias("topic"), F.col("mix_tokens").alias("tokens"),
        F.round("mix_weight", 9).alias("weight"), F.col("mix_probability").alias("probability"), F.col("mix_kept").alias("kept"),
    )


def op8_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.groups(table(spark, sf_dir, "documents"), Stages(spark))


def op9_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    table(spark, sf_dir, "documents")
    marked = exactdup.mark(spark, f"{sf_dir.rstrip('/')}/documents.parquet", Stages(spark))
    return marked.withColumnRenamed("text_digest", "text_sha256")


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), Stages(spark))


def op11_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    model = rowrules.fit(docs, labels, ~held_out(3, 1))
    judged = rowrules.with_verdict(docs.select("doc_id", "text"), model, into="r")
    return judged.select(
        "doc_id", *(f"r.{c}" for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "score"))
    )


def with_planted_tail(doc_id: int | None, words: list[bytes]) -> list[bytes]:
    """One document in ten, by the crc of its id, gets a periodic tail."""
    h = 1 if doc_id is None else zlib.crc32(str(doc_id).encode())
    n, g = len(words), h // 10
    if h % 10 or not n:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + (words[a : a + p] * ((n - a) // p + 1))[: n - a]


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return periodic.digested(periodic.with_runs(docs, rewrite=with_planted_tail))


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    told = prefixtrie.with_shared_heads(prefixtrie.paths(table(spark, sf_dir, "conversations")), 20, id_crc("conv_id") % 4)
    return prefixtrie.nodes(told, Stages(spark))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_toxicity, op2_warc, op3_url_filter, op4_quality, op5_topk, op6_pii, op7_mixing, op8_minhash, op9_exact_dedup, op10_packing,
        op11_quality_rules, op12_periodic_runs, op13_prefix_trie,
    )
}


def _mixing_sql(mix: mixing.Mix) -> str:
    """The same raking within a budget, unrolled: each half-sweep is one table of factors."""
    text = "coalesce(text, '')"

    def many(chars: str, share: float) -> str:
        return f"length({text}) - length(translate({text}, '{chars}', '')) > length({text}) * {share}"

    topic = (
        f"CASE WHEN {many('|', 0.02)} THEN 'table' WHEN {many('!', 0.02)} THEN 'shouting' "
        f"WHEN {many('#$%&*<>=', 0.02)} THEN 'symbols' WHEN {many('0123456789', 0.05)} THEN 'data' "
        f"WHEN length({text}) < 500 THEN 'note' WHEN length({text}) < 3000 THEN 'article' "
        f"WHEN length({text}) < 12000 THEN 'essay' ELSE 'book' END"
    )
    parts = [
        f"told AS (SELECT doc_id, source, lang, coalesce(source, '') AS s, coalesce(lang, '') AS l, {topic} AS topic, "
        f"greatest(1, CAST(ceil(length({text}) / 4.0) AS bigint)) AS tokens FROM documents)",
        "cells AS (SELECT s AS source, l AS lang, topic, CAST(sum(tokens) AS bigint) AS tokens FROM told GROUP BY ALL)",
        "everything AS (SELECT CAST(sum(tokens) AS double) AS n FROM cells)",
    ]
    for m in mixing.MARGINS:
        parts.append(
            f"target_{m} AS (SELECT {m}, p / sum(p) OVER () AS t FROM "
            f"(SELECT {m}, pow(CAST(sum(tokens) AS double), {mix.temper[m]}) AS p FROM cells GROUP BY {m}) x)"
        )
    now: dict[str, str] = {}

    def weighted() -> str:
        joins = "".join(f" JOIN {name} AS f_{m} ON f_{m}.{m} = cells.{m}" for m, name in now.items())
        product = "".join(f" * f_{m}.f" for m in now)
        old = ", ".join(f"f_{m}.f AS old_{m}" if m in now else f"1.0 AS old_{m}" for m in mixing.MARGINS)
        return (
            f"SELECT cells.*, {old}, cells.tokens / everything.n{product} AS w, cells.tokens / (everything.n * {mix.budget}) AS most "
            f"FROM cells CROSS JOIN everything{joins}"
        )

    for i in range(mix.sweeps):
        for m in mixing.MARGINS:
            name = f"factor_{m}_{i}"
            parts.append(
                f"{name} AS MATERIALIZED (SELECT t.{m}, c.old * coalesce(CASE WHEN c.free > 0 AND t.t > c.whole THEN (t.t - c.whole) / c.free END, "
                f"t.t / nullif(c.whole + c.free, 0), 0) AS f FROM target_{m} t JOIN "
                f"(SELECT {m}, max(old_{m}) AS old, sum(CASE WHEN w >= most THEN most ELSE 0 END) AS whole, "
                f"sum(CASE WHEN w >= most THEN 0 ELSE w END) AS free FROM ({weighted()}) q GROUP BY {m}) c ON c.{m} = t.{m})"
            )
            now[m] = name
    # cells get full in the order of their rates; the first count of full ones that leaves the next below 1 is it
    parts += [
        f"raked AS MATERIALIZED (SELECT source, lang, topic, tokens, w, w / tokens AS rate FROM ({weighted()}) q)",
        f"""ordered AS (SELECT *, row_number() OVER o AS k,
 coalesce(sum(tokens) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS whole,
 sum(w) OVER (o ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS free FROM raked WINDOW o AS (ORDER BY rate DESC, source, lang, topic))""",
        f"scales AS (SELECT k, rate, (n * {mix.budget} - whole) / free AS c FROM ordered CROSS JOIN everything)",
        "scale AS (SELECT arg_min(c, k) AS c FROM scales WHERE c * rate < 1)",
        "rates AS (SELECT source, lang, topic, tokens, least(1.0, rate * c) AS u, round(least(1.0, rate * c), 9) AS p FROM raked CROSS JOIN scale)",
    ]
    hashed = "CAST('0x' || substr(md5(coalesce(CAST(doc_id AS varchar), '')), 1, 13) AS bigint) / 4503599627370496.0"
    return (
        f"WITH {', '.join(parts)} SELECT d.doc_id, d.source, d.lang, d.topic, d.tokens, round(r.u * r.tokens / (e.n * {mix.budget}), 9) AS weight, "
        f"r.p AS probability, {hashed} < r.p AS kept "
        "FROM told d JOIN rates r ON r.source = d.s AND r.lang = d.l AND r.topic = d.topic CROSS JOIN everything e"
    )


# crc32 of an id's decimal text, bit by bit
_CRC = """(xor(4294967295, list_reduce(list_prepend(4294967295::bigint, list_transform(string_split(CAST({} AS varchar), ''), lambda c: ascii(c)::bigint)),
 lambda a, b: list_reduce(list_prepend(xor(a, b), range(8)), lambda x, y: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END))))"""

_SPACES = "[\\x20\\x09-\\x0D]"

ORACLES: dict[str, str] = {
    "op2_warc": """
WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS b FROM pages),
h AS (SELECT page_id, octet_length(b) AS n, sha1(b) AS h FROM p),
g AS (SELECT h, n, max(page_id) AS last FROM h GROUP BY h, n)
SELECT page_id, CAST(h.n AS bigint) AS payload_bytes,
 array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
   CAST(1 + ((CAST('0x' || substr(h.h, 1 + 10 * (i // 8), 10) AS bigint) >> CAST(35 - 5 * (i % 8) AS int)) & 31) AS int), 1)), '') AS payload_digest,
 CASE WHEN page_id = last THEN 'response' ELSE 'revisit' END AS record_type,
 CASE WHEN page_id <> last THEN last END AS refers_to
FROM h JOIN g ON g.h = h.h AND g.n = h.n""",
    "op5_topk": """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(64 * CAST(x AS double))) AS v FROM embeddings
 WHERE embedding IS NOT NULL AND len(embedding) > 0
 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.v, c.v) AS bigint) AS score
 FROM v q JOIN v c ON q.vec_id % 20 = 0 AND q.vec_id <> c.vec_id),
r AS (SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS int) AS rank, vec_id, score FROM s)
SELECT * FROM r WHERE rank <= 20""",
    "op7_mixing": _mixing_sql(OP7_MIX),
    "op8_minhash": """
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''),
   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
s AS (SELECT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
   ELSE list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i+4], ' '))) END) AS s FROM w),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
e AS (SELECT a.doc_id AS a, b.doc_id AS b FROM s a JOIN s b ON a.s = b.s AND a.doc_id <> b.doc_id
   JOIN n na ON na.doc_id = a.doc_id JOIN n nb ON nb.doc_id = b.doc_id
   GROUP BY a.doc_id, b.doc_id HAVING 100 * count(*) >= 85 * (min(na.n) + min(nb.n) - count(*))),
c(node, component) AS (SELECT doc_id, doc_id FROM documents
   UNION SELECT e.b, c.component FROM c JOIN e ON e.a = c.node AND c.component < e.b),
m AS (SELECT node, min(component) AS component FROM c GROUP BY node)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, m.component AS component_id, d.doc_id = m.component AS kept
FROM documents d JOIN m ON m.node = d.doc_id LEFT JOIN n ON n.doc_id = d.doc_id""",
    "op9_exact_dedup": f"""
WITH t AS (SELECT doc_id, length(coalesce(text, '')) AS n, sha256(regexp_replace(coalesce(text, ''), '{_SPACES}', '', 'g')) AS h FROM documents),
r AS (SELECT *, first_value(doc_id) OVER (PARTITION BY h ORDER BY n DESC, doc_id) AS keep_id, count(*) OVER (PARTITION BY h) AS c FROM t)
SELECT doc_id, keep_id, c AS group_size, doc_id = keep_id AS kept, h AS text_sha256 FROM r""",
    "op13_prefix_trie": f"""
WITH t AS (SELECT conv_id, turn, coalesce(text, '') AS text,
  sha256(CAST(length(coalesce(role, '')) AS varchar) || ':' || coalesce(role, '') || coalesce(text, ''))[1:32] AS x FROM conversations WHERE conv_id IS NOT NULL),
o AS (SELECT conv_id, list(x ORDER BY turn NULLS FIRST, x) AS x,
  list(CAST(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')) AS bigint) ORDER BY turn NULLS FIRST, x) AS w, CAST({_CRC.format('conv_id')} % 4 AS bigint) AS h FROM t GROUP BY conv_id),
r AS (SELECT c.conv_id, list_concat(coalesce(b.x[1:c.h], []), c.x[c.h + 1:]) AS x, list_concat(coalesce(b.w[1:c.h], []), c.w[c.h + 1:]) AS w
  FROM o c LEFT JOIN o b ON b.conv_id = c.conv_id - c.conv_id % 20),
p AS (SELECT conv_id, d, len(x) AS n, array_to_string(x[1:d], '') AS k, CASE WHEN d > 0 THEN w[d] END AS words
  FROM (SELECT *, unnest(range(0, len(x) + 1)) AS d FROM r) y),
g AS (SELECT k, d, min(conv_id) AS conv_id, count(*) AS n_convs, min(words) AS words,
  sha256(coalesce(string_agg(CAST(conv_id AS varchar), ',' ORDER BY conv_id) FILTER (n = d), '')) AS ends FROM p GROUP BY k, d),
c AS (SELECT a.k, a.d, count(b.k) AS n_children FROM g a LEFT JOIN g b ON b.d = a.d + 1 AND b.k[1:32 * a.d] = a.k GROUP BY a.k, a.d),
f AS (SELECT g.*, n_children FROM g JOIN c ON c.k = g.k AND c.d = g.d),
u AS (SELECT CAST(unnest(range(0, d + 1)) AS bigint) AS d, k, n_children, (n_convs - 1) * words AS saved FROM f),
s AS (SELECT d, k[1:32 * d] AS k, count_if(n_children = 0) AS n_leaves, coalesce(sum(saved), 0) AS saved FROM u GROUP BY 1, 2)
SELECT f.conv_id, CAST(f.d AS bigint) AS depth, q.conv_id AS parent_conv_id, f.n_convs, f.n_children, CAST(s.n_leaves AS bigint) AS n_leaves,
 CAST(s.saved AS bigint) AS saved_tokens, f.ends AS ends_sha256
FROM f JOIN s ON s.d = f.d AND s.k = f.k LEFT JOIN g q ON q.d = f.d - 1 AND q.k = f.k[1:32 * (f.d - 1)]""",
}
