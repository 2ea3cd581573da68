"""The corpus operators as queries over the test tables, with SQL where SQL can express the result."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import local_scratch
from . import (
    extraction, fill_middle, jaccard, langid, licenses, merkle, mixing, packing, quality, repeats, secrets,
    token_counts, topk,
)
from .common import read_table

Query = Callable[[SparkSession, str], DataFrame]


def tokenizer_file(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = read_table(spark, sf_dir, "pages")
    return extraction.main_text(pages, extraction.trained(pages))


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    model = langid.learn(docs.where(~langid.held_out("doc_id")))
    return langid.identify(docs, model).select(
        "doc_id", langid.held_out("doc_id").alias("held_out"), "lang_pred", "score",
        F.size("spans").alias("n_spans"),
    )


def op3_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.without_repeats(read_table(spark, sf_dir, "documents"))


def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of each line and of each sentence of each document, from encodings of whole documents."""
    import public_tokenizers

    return token_counts.section_tokens(
        read_table(spark, sf_dir, "documents"),
        tokenizer_file("byte_bpe_50k.tiktoken"),
        public_tokenizers.PATTERN,
        kinds=("line", "sentence"),
    )


def op5_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    return jaccard.near_copies(docs, k=3, num=90, den=100)


def op6_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.find_secrets(read_table(spark, sf_dir, "documents"))
    base = [r.kind for r in secrets.BASE_RULES]

    def listed(spans):
        return F.array_join(
            F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ","
        )

    def count(kind):
        return F.size(F.filter("found", lambda s: s["kind"] == kind)).cast("bigint")

    return found.select(
        "doc_id",
        *[count(k).alias(f"n_{k}") for k in base],
        F.sha2(listed(F.filter("found", lambda s: s["kind"].isin(base))), 256).alias("base_sha256"),
        listed("found").alias("spans"),
    )


def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.verdicts(read_table(spark, sf_dir, "documents")).select(
        "doc_id", "m.n_words", "m.word_chars", "m.n_symbols", "m.n_dup_lines", "m.n_repeat_words",
        "base_failed", "kept", F.round("posterior", 6).alias("posterior"),
    )


def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    return packing.pack(docs, tokenizer_file("word_bpe_49k.json"))


def op9_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(read_table(spark, sf_dir, "embeddings"))


def op10_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(read_table(spark, sf_dir, "documents"))


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's proof against the root, where a third of the texts were put into lower case since."""
    text = F.col("text")
    tampered = F.when(merkle.every_third(F.col("doc_id")), merkle.lower_ascii(text)).otherwise(text)
    manifest = merkle.build(read_table(spark, sf_dir, "documents"), now={"text": tampered})
    return merkle.proofs(manifest).select(
        F.col("id").alias("doc_id"), "leaf", "subroot", "root",
        F.sha2(F.array_join("proof", ""), 256).alias("proof_sha256"), "folded_root", "verified",
    )


def op12_fill_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = fill_middle.fill_in_middle(read_table(spark, sf_dir, "documents"))
    again = fill_middle.restored(F.col("output"), F.col("form"))
    return made.select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars",
        F.sha2("output", 256).alias("output_sha256"), F.sha2(again, 256).alias("restored_sha256"),
    )


def op13_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = F.filter("detections", lambda d: d["base"])

    def labels(found):
        return F.array_join(F.array_sort(F.array_distinct(F.transform(found, lambda d: d["label"]))), ",")

    starts = F.transform(base, lambda d: d["start"])
    return licenses.scan(read_table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", F.size(base).cast("bigint").alias("n_base"),
        F.array_min(starts).alias("first_word"), F.array_max(starts).alias("last_word"),
        labels(base).alias("base_labels"), labels(F.col("detections")).alias("labels"), "score",
    )


_QUERIES: dict[str, Query] = {
    f.__name__: f
    for f in (
        op1_html_extraction, op2_language_id, op3_substring_dedup, op4_token_counts, op5_jaccard_join,
        op6_secret_scan, op7_quality_rules, op8_packing, op9_top_k, op10_source_mix,
        op11_merkle_manifest, op12_fill_middle, op13_license_scan,
    )
}


def _with_scratch(run: Query) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        local_scratch(spark)
        return run(spark, sf_dir)

    return query


def queries() -> dict[str, Query]:
    return {name: _with_scratch(run) for name, run in _QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return dict(_SQL)


# Words as in `common.WORD`. Windows are compared as text: words hold no white space, so joining them by a
# space tells all word sequences apart.
_SQL: dict[str, str] = {
    "op3_substring_dedup": r"""
WITH w AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents
), starts AS (
  SELECT doc_id, words, unnest(range(1, len(words) - 48)) AS i FROM w WHERE len(words) >= 50
), windows AS (
  SELECT doc_id, i, md5(array_to_string(words[i:i + 49], ' ')) AS h FROM starts
), firsts AS (
  SELECT h, min(doc_id) AS d FROM windows GROUP BY h
), gone AS (
  SELECT DISTINCT doc_id, i + unnest(range(0, 50)) AS p
  FROM windows JOIN firsts USING (h) WHERE doc_id > d
), listed AS (
  SELECT doc_id, list(p) AS ps FROM gone GROUP BY doc_id
), marked AS (
  SELECT doc_id, words, coalesce(ps, []) AS ps FROM w LEFT JOIN listed USING (doc_id)
)
SELECT doc_id, len(words)::BIGINT AS n_words, len(ps)::BIGINT AS n_removed,
       sha256(array_to_string(
         [words[j] FOR j IN range(1, len(words) + 1) IF NOT list_contains(ps, j)], ' ')) AS kept_sha256
FROM marked
""",
    "op5_jaccard_join": r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x20\x09-\x0D]+') AS words FROM documents
), s AS (
  SELECT doc_id, CASE WHEN len(words) = 0 THEN []
    WHEN len(words) < 3 THEN [array_to_string(words, ' ')]
    ELSE list_distinct([array_to_string(words[i:i + 2], ' ') FOR i IN range(1, len(words) - 1)]) END AS set
  FROM w
), e AS (
  SELECT doc_id, len(set) AS n, unnest(set) AS x FROM s
), common AS (
  SELECT a.doc_id AS a, b.doc_id AS b, any_value(a.n) AS na, any_value(b.n) AS nb, count(*) AS c
  FROM e a JOIN e b ON a.x = b.x AND a.doc_id < b.doc_id
    AND 10 * a.n >= 9 * b.n AND 10 * b.n >= 9 * a.n
  GROUP BY 1, 2
), links AS (
  SELECT a, b FROM common WHERE 100 * c >= 90 * (na + nb - c)
), both_ways AS (
  SELECT a, b FROM links UNION ALL SELECT b, a FROM links
), reach AS (
  SELECT doc_id AS node, doc_id AS seen FROM documents
  UNION
  SELECT reach.node, both_ways.b FROM reach JOIN both_ways ON reach.seen = both_ways.a
)
SELECT s.doc_id, len(s.set)::BIGINT AS n_shingles, min(reach.seen) AS component_id
FROM s JOIN reach ON s.doc_id = reach.node GROUP BY s.doc_id, s.set
""",
    # CRC-32 bit by bit: eight steps for each character of the decimal id.
    "op11_merkle_manifest": r"""
WITH RECURSIVE d AS (
  SELECT *, list_reduce([4294967295::BIGINT] || [unicode(c)::BIGINT FOR c IN string_split(doc_id::VARCHAR, '')],
    lambda crc, c: list_reduce([xor(crc, c), 0, 0, 0, 0, 0, 0, 0, 0],
      lambda x, z: CASE WHEN x % 2 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END)) AS crc
  FROM documents
), t AS (
  SELECT *, CASE WHEN xor(crc, 4294967295) % 3 = 0
    THEN translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') ELSE text END AS now
  FROM d
), fields AS (
  SELECT doc_id, lang,
    coalesce(strlen(doc_id::VARCHAR) || ':' || doc_id::VARCHAR, '-') || coalesce(strlen(source) || ':' || source, '-')
    || coalesce(strlen(lang) || ':' || lang, '-') || coalesce(strlen(n_chars::VARCHAR) || ':' || n_chars::VARCHAR, '-') AS head,
    coalesce(strlen(text) || ':' || text, '-') AS tail, coalesce(strlen(now) || ':' || now, '-') AS now_tail
  FROM t
), leaf AS (
  SELECT doc_id, sha256(head || tail) AS leaf, sha256(head || now_tail) AS present,
    dense_rank() OVER (ORDER BY lang NULLS FIRST) - 1 AS tree,
    row_number() OVER (PARTITION BY lang ORDER BY doc_id) - 1 AS node, count(*) OVER (PARTITION BY lang) AS n
  FROM fields
), nodes AS (
  SELECT tree, 0 AS lvl, node, n, n AS width, leaf AS hash FROM leaf
  UNION ALL
  SELECT tree, lvl + 1, node // 8, any_value(n), (any_value(width) + 7) // 8, sha256(string_agg(hash, '' ORDER BY node))
  FROM nodes WHERE width > 1 GROUP BY tree, lvl, node // 8
), subroots AS (
  SELECT tree, hash AS subroot, count(*) OVER () AS trees FROM nodes WHERE width = 1
), tops AS (
  SELECT 0 AS lvl, tree AS node, trees AS width, subroot AS hash FROM subroots
  UNION ALL
  SELECT lvl + 1, node // 8, (any_value(width) + 7) // 8, sha256(string_agg(hash, '' ORDER BY node))
  FROM tops WHERE width > 1 GROUP BY lvl, node // 8
), runs AS (
  SELECT tree, lvl, node // 8 AS run, list(hash ORDER BY node) AS hashes FROM nodes WHERE width > 1 GROUP BY ALL
  UNION ALL
  SELECT -1, lvl, node // 8, list(hash ORDER BY node) FROM tops WHERE width > 1 GROUP BY ALL
), climb AS (
  SELECT doc_id, tree AS home, tree, 0 AS lvl, node, n AS width, present AS folded, '' AS proof FROM leaf
  UNION ALL
  SELECT c.doc_id, c.home, CASE WHEN c.width = 1 THEN -1 ELSE c.tree END,
    CASE WHEN c.width = 1 THEN 0 ELSE c.lvl + 1 END, CASE WHEN c.width = 1 THEN c.home ELSE c.node // 8 END,
    CASE WHEN c.width = 1 THEN (SELECT any_value(trees) FROM subroots) ELSE (c.width + 7) // 8 END,
    CASE WHEN c.width = 1 THEN c.folded
      ELSE sha256(array_to_string(r.hashes[1:c.node % 8] || [c.folded] || r.hashes[c.node % 8 + 2:], '')) END,
    CASE WHEN c.width = 1 THEN c.proof
      ELSE c.proof || array_to_string(r.hashes[1:c.node % 8] || r.hashes[c.node % 8 + 2:], '') END
  FROM climb c LEFT JOIN runs r ON r.tree = c.tree AND r.lvl = c.lvl AND r.run = c.node // 8
  WHERE c.width > 1 OR c.tree >= 0
)
SELECT l.doc_id, l.leaf, s.subroot, root.hash AS root, sha256(c.proof) AS proof_sha256, c.folded AS folded_root,
       c.folded = root.hash AS verified
FROM leaf l JOIN subroots s USING (tree) JOIN climb c ON c.doc_id = l.doc_id AND c.tree = -1 AND c.width = 1
CROSS JOIN (SELECT hash FROM tops WHERE width = 1) root
""",
    "op12_fill_middle": r"""
WITH h AS (
  SELECT doc_id, coalesce(text, '') AS text, sha256('42:' || doc_id) AS h,
    regexp_extract_all(coalesce(text, ''), '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+') AS t
  FROM documents
), d AS (
  SELECT doc_id, text, t, len(t) AS n, ('0x' || h[1:8])::BIGINT % (len(t) + 1) AS a,
    ('0x' || h[9:16])::BIGINT % (len(t) + 1) AS b, ('0x' || h[17:24])::BIGINT % 100 AS h3, ('0x' || h[25:32])::BIGINT % 100 AS h4
  FROM h
), f AS (
  SELECT doc_id, text, n,
    CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR h3 >= 50 THEN 'plain'
      WHEN h4 < 80 THEN 'spm' ELSE 'psm' END AS form,
    array_to_string(t[1:least(a, b)], '') AS prefix,
    array_to_string(t[least(a, b) + 1:greatest(a, b)], '') AS middle,
    array_to_string(t[greatest(a, b) + 1:], '') AS suffix
  FROM d
)
SELECT doc_id, n::BIGINT AS n, form,
  CASE WHEN form <> 'plain' THEN length(prefix) END::BIGINT AS prefix_chars,
  CASE WHEN form <> 'plain' THEN length(middle) END::BIGINT AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
    ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
  sha256(text) AS restored_sha256
FROM f
""",
    "op9_top_k": """
WITH v AS (
  SELECT vec_id, [floor(64 * x::DOUBLE)::BIGINT FOR x IN embedding] AS x
  FROM embeddings
  WHERE embedding IS NOT NULL
    AND len([y FOR y IN embedding IF y IS NULL OR NOT isfinite(y)]) = 0
), scores AS (
  SELECT q.vec_id AS query_id, c.vec_id,
         list_inner_product(q.x::DOUBLE[], c.x::DOUBLE[])::BIGINT AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 20 = 0
), ranked AS (
  SELECT query_id, vec_id, score,
         row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INT AS rank
  FROM scores
)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 20
""",
}
