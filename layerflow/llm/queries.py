"""The text operators as registered queries, and SQL counterparts where SQL can express them."""

from __future__ import annotations

import functools

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from layerflow.llm import (
    chat,
    decontaminate,
    jaccard,
    licenses,
    pii,
    quality,
    runs,
    search,
    sentencepiece,
    sharding,
    simhash,
    toxicity,
    urls,
)
from layerflow.llm.text import let
from layerflow.llm.training import ship

# Surrogates are a function of it: a run that must not be linked to others takes a key of its own.
PII_KEY = "layerflow surrogates"

QUERIES = {}
ORACLE = {}


def query(fn):
    @functools.wraps(fn)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        ship(spark)
        return fn(spark, sf_dir)

    QUERIES[fn.__name__] = run
    return run


def load(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


@query
def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents").select("doc_id", "text")
    held_out = toxicity.held_out(F.col("doc_id"))
    model = toxicity.train(docs, load(spark, sf_dir, "labels"), usable=~held_out)
    rows = toxicity.score_toxicity(docs, model, keep=["doc_id"])
    return rows.select("doc_id", held_out.alias("held_out"), "score", "predicted", "spans")


@query
def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents").select("doc_id", "text")
    model = quality.train(docs, load(spark, sf_dir, "labels"))
    return quality.quality_rules(docs, model, keep=["doc_id"])


@query
def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages of ``corpus_pipeline``, which builds on this subpackage, one after another."""
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


SHARDS = [f"shard-{i:03d}" for i in range(128)]


@query
def op3_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents").drop("text")
    return sharding.place(docs, SHARDS).select("doc_id", "slot", "shard")


URL_RULES = [
    urls.Rule(block=False, host="org", path="/"),
    urls.Rule(block=True, host="example.org", path="/es/"),
    urls.Rule(block=True, host="example.org", path="/en/1"),
    urls.Rule(block=False, host="com", path="/fr/"),
    urls.Rule(block=True, host="com", path="/de/"),
]


@query
def op4_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = load(spark, sf_dir, "pages").select("page_id", "url")
    model = urls.train(urls.rule_labels(pages, URL_RULES))
    return urls.judge(pages, URL_RULES, model, keep=["page_id"])


@query
def op5_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per paragraph taken for a licence notice."""
    docs = load(spark, sf_dir, "documents").select("doc_id", "text")
    return licenses.scan(docs, licenses.train(docs))


@query
def op6_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents").select("doc_id", "text")
    return pii.replace_entities(docs, PII_KEY, count_col="n_entities")


@query
def op7_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of every whole text, and whether decoding them gives the text again."""
    docs = load(spark, sf_dir, "documents").select("doc_id", "text")
    rows = sentencepiece.encode(docs, keep=["doc_id"], check_col="round_trip")
    return rows.withColumn("n_ids", F.size("ids").cast("long"))


@query
def op8_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = simhash.simhash_classes(load(spark, sf_dir, "documents"), shingle=3, max_bits=2)
    text = F.lower(F.lpad(F.hex("fp"), 16, "0"))
    return rows.select("doc_id", text.alias("fingerprint"), "component_id")


@query
def op9_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per document and benchmark item that it overlaps."""
    docs = load(spark, sf_dir, "documents").select("doc_id", "text")
    found = decontaminate.find_benchmark(docs, load(spark, sf_dir, "benchmark"))
    return found.select("doc_id", F.explode("overlaps").alias("hit")).select("doc_id", "hit.*")


@query
def op10_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The mask as text, ``start-end`` of each range."""
    rows = chat.rotate_perspectives(load(spark, sf_dir, "conversations"))
    spans = F.transform("mask", lambda m: F.concat_ws("-", m["start"], m["end"]))
    return rows.withColumn("mask", F.array_join(spans, ","))


@query
def op11_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents").select("doc_id", "text")
    return jaccard.jaccard_classes(docs, shingle=5, percent=80)


def planted_text(doc_id: Column, text: Column) -> Column:
    """One text in ten with its words from some place on repeated at a period, by the id's crc32."""
    h = F.crc32(doc_id.cast("string").cast("binary"))
    g = F.floor(h / 10)

    def repeated(words: Column) -> Column:
        n = F.size(words)
        a = F.pmod(g, n)
        p = 1 + F.floor((n - a) / (3 + F.pmod(g, F.lit(8))))
        place = lambda i: F.when(i < a, i).otherwise(a + F.pmod(i - a, p))
        taken = F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.get(words, place(i).cast("int")))
        return F.when(n > 0, F.array_join(taken, " ")).otherwise(text)

    words = F.filter(F.split(text, r"[\x20\x09-\x0D]+"), lambda w: w != "")
    return F.when(F.pmod(h, F.lit(10)) == 0, let(words, repeated)).otherwise(text)


@query
def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents").select("doc_id", "text")
    docs = docs.withColumn("text", planted_text(F.col("doc_id"), F.col("text")))
    rows = runs.find_runs(docs, min_length=6, min_exponent=4, keep=["doc_id"])
    # runs come by start, then period, so of equal ones the first stays
    greater = lambda a, b: a["length"] * b["period"] > b["length"] * a["period"]
    best = F.aggregate(
        "runs",
        F.get("runs", F.lit(0)),
        lambda best, r: F.when(greater(r, best), r).otherwise(best),
    )
    listed = F.transform(
        "runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"])
    )
    lines = F.array_join(F.transform(listed, lambda line: F.concat(line, F.lit("\n"))), "")
    return (
        rows.withColumn("best", best)
        .select(
            "doc_id",
            F.size("runs").cast("long").alias("n_runs"),
            "best.*",
            F.expr("1000 * best.length div best.period").alias("exponent_milli"),
            F.sha2(lines.cast("binary"), 256).alias("runs_sha256"),
            F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
        )
    )


@query
def op13_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    index = search.build_index(load(spark, sf_dir, "documents").select("doc_id", "text"))
    return search.search(index, load(spark, sf_dir, "benchmark"), k=20)


ORACLE["op10_chat_formatting"] = r"""
WITH turns AS (
    SELECT conv_id, coalesce(role, '') AS speaker, coalesce(text, '') AS said,
           row_number() OVER (PARTITION BY conv_id
               ORDER BY turn NULLS LAST, coalesce(role, ''), coalesce(text, '')) - 1 AS position
    FROM conversations
), speakers AS (
    SELECT DISTINCT conv_id, speaker AS me FROM turns WHERE speaker <> 'system'
), pieces AS (
    SELECT turns.conv_id, me, position, position // 256 AS part, speaker = me AS learn,
           CASE WHEN speaker = me THEN '<|im_start|>assistant'
                WHEN speaker = 'system' THEN '<|im_start|>system'
                ELSE '<|im_start|>user name=' || coalesce(nullif(
                    regexp_replace(replace(speaker, '<|', '< |'), '[\s<>|]+', '_', 'g'), ''),
                    'unknown')
           END || chr(10) AS header,
           replace(said, '<|', '< |') || '<|im_end|>' AS body
    FROM turns JOIN speakers ON turns.conv_id IS NOT DISTINCT FROM speakers.conv_id
), placed AS (
    SELECT *, sum(length(header) + length(body) + 1)
                  OVER (PARTITION BY conv_id, me, part ORDER BY position) - 1 AS stop
    FROM pieces
)
SELECT conv_id, CASE WHEN me = '' THEN 'unknown' ELSE me END AS perspective, part,
       count(*) AS n_turns, CAST(count(*) FILTER (learn) AS BIGINT) AS n_learned,
       string_agg(header || body || chr(10), '' ORDER BY position) AS rendered,
       coalesce(string_agg((stop - length(body))::BIGINT || '-' || stop::BIGINT, ','
           ORDER BY position) FILTER (learn), '') AS mask
FROM placed
GROUP BY conv_id, me, part
"""

ORACLE["op11_ngram_jaccard"] = r"""
WITH RECURSIVE split AS (
    SELECT doc_id, regexp_extract_all(
               translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                   'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS words
    FROM documents
), places AS (
    SELECT doc_id, words, unnest(range(greatest(1, len(words) - 4))) AS i
    FROM split WHERE len(words) > 0
), shingles AS (
    SELECT DISTINCT doc_id, array_to_string(list_slice(words, i + 1, i + 5), ' ') AS shingle
    FROM places
), sizes AS (
    SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id
), common AS (
    SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS n
    FROM shingles x JOIN shingles y ON x.shingle = y.shingle AND x.doc_id <> y.doc_id
    GROUP BY x.doc_id, y.doc_id
), links AS (
    SELECT a, b FROM common JOIN sizes p ON p.doc_id = a JOIN sizes q ON q.doc_id = b
    WHERE 100 * common.n >= 80 * (p.n + q.n - common.n)
), reached AS (
    SELECT doc_id AS a, doc_id AS b FROM documents
    UNION
    SELECT reached.a, links.b FROM reached JOIN links ON reached.b = links.a
)
SELECT a AS doc_id, coalesce(any_value(n), 0) AS n_shingles, min(b) AS component_id
FROM reached LEFT JOIN sizes ON sizes.doc_id = a
GROUP BY a
"""

ORACLE["op12_periodic_runs"] = r"""
WITH named AS (
    SELECT doc_id, CAST(doc_id AS VARCHAR) AS digits,
           regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words
    FROM documents
), hashed AS (
    SELECT doc_id, words, xor(4294967295, list_reduce(range(8 * length(digits)), lambda crc, i:
               xor(xor(crc, CASE WHEN i % 8 = 0 THEN ascii(substr(digits, i // 8 + 1, 1)) ELSE 0 END) >> 1,
                   (xor(crc, CASE WHEN i % 8 = 0 THEN ascii(substr(digits, i // 8 + 1, 1)) ELSE 0 END) & 1)
                       * 3988292384), 4294967295)) AS h
    FROM named
), placed AS (
    SELECT *, sum(length(header) + length(body) + 1)
                  OVER (PARTITION BY conv_id, me, part ORDER BY position) - 1 AS stop
    FROM pieces
)
SELECT conv_id, CASE WHEN me = '' THEN 'unknown' ELSE me END AS perspective, part,
       count(*) AS n_turns, CAST(count(*) FILTER (learn) AS BIGINT) AS n_learned,
       string_agg(header || body || chr(10), '' ORDER BY position) AS rendered,
       coalesce(string_agg((stop - length(body))::BIGINT || '-' || stop::BIGINT, ','
           ORDER BY position) FILTER (learn), '') AS mask
FROM placed
GROUP BY conv_id, me, part
"""

ORACLE["op11_ngram_jaccard"] = r"""
WITH RECURSIVE split AS (
    SELECT doc_id, regexp_extract_all(
               translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                   'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS words
    FROM documents
), places AS (
    SELECT doc_id, words, unnest(range(greatest(1, len(words) - 4))) AS i
    FROM split WHERE len(words) > 0
), shingles AS (
    SELECT DISTINCT doc_id, array_to_string(list_slice(words, i + 1, i + 5), ' ') AS shingle
    FROM places
), sizes AS (
    SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id
), common AS (
    SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS n
    FROM shingles x JOIN shingles y ON x.shingle = y.shingle AND x.doc_id <> y.doc_id
    GROUP BY x.doc_id, y.doc_id
), links AS (
    SELECT a, b FROM common JOIN sizes p ON p.doc_id = a JOIN sizes q ON q.doc_id = b
    WHERE 100 * common.n >= 80 * (p.n + q.n - common.n)
), reached AS (
    SELECT doc_id AS a, doc_id AS b FROM documents
    UNION
    SELECT reached.a, links.b FROM reached JOIN links ON reached.b = links.a
)
SELECT a AS doc_id, coalesce(any_value(n), 0) AS n_shingles, min(b) AS component_id
FROM reached LEFT JOIN sizes ON sizes.doc_id = a
GROUP BY a
"""

ORACLE["op12_periodic_runs"] = r"""
WITH named AS (
    SELECT doc_id, CAST(doc_id AS VARCHAR) AS digits,
           regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words
    FROM documents
), hashed AS (
    SELECT doc_id, words, xor(4294967295, list_reduce(range(8 * length(digits)), lambda crc, i:
               xor(xor(crc, CASE WHEN i % 8 = 0 THEN ascii(substr(digits, i // 8 + 1, 1)) ELSE 0 END)
                       >> 1,
                   (xor(crc, CASE WHEN i % 8 = 0 THEN ascii(substr(digits, i // 8 + 1, 1)) ELSE 0 END)
                       & 1) * 3988292384), 4294967295)) AS h
    FROM named
), placed AS (
    SELECT doc_id, words, h, len(words) AS n,
           CASE WHEN len(words) > 0 THEN (h // 10) % len(words) ELSE 0 END AS a
    FROM hashed
), positions AS (
    SELECT doc_id, unnest(range(n)) AS i, words, a, h % 10 = 0 AS planted,
           1 + (n - a) // (3 + (h // 10) % 8) AS p
    FROM placed WHERE n > 0
), tokens AS (
    SELECT doc_id, i,
           list_extract(words, 1 + CASE WHEN planted AND i >= a THEN a + (i - a) % p ELSE i END) AS word
    FROM positions
), sizes AS (
    SELECT doc_id, count(*) AS n FROM tokens GROUP BY doc_id
), equal AS (
    SELECT x.doc_id, x.i, y.i - x.i AS q
    FROM tokens x JOIN tokens y ON x.doc_id = y.doc_id AND x.word = y.word AND x.i < y.i
    JOIN sizes ON x.doc_id = sizes.doc_id
    WHERE 4 * (y.i - x.i) <= n
), islands AS (
    SELECT doc_id, q, i, i - row_number() OVER (PARTITION BY doc_id, q ORDER BY i) AS island
    FROM equal
), stretches AS (
    SELECT doc_id, q, min(i) AS start, count(*) + q AS length
    FROM islands GROUP BY doc_id, q, island
    HAVING count(*) + q >= greatest(6, 4 * q)
), runs AS (
    SELECT doc_id, start, length, min(q) AS period FROM stretches GROUP BY doc_id, start, length
), listed AS (
    SELECT doc_id, count(*) AS n_runs,
           string_agg(start || ',' || length || ',' || period || chr(10), '' ORDER BY start, period)
               AS lines
    FROM runs GROUP BY doc_id
), ranked AS (
    SELECT *, row_number() OVER (PARTITION BY doc_id
               ORDER BY length::DOUBLE / period DESC, start, period) AS place
    FROM runs
), dropped AS (
    SELECT DISTINCT doc_id, unnest(range(start + period, start + length)) AS i FROM runs
), kept AS (
    SELECT tokens.doc_id, string_agg(word, ' ' ORDER BY tokens.i) AS collapsed
    FROM tokens ANTI JOIN dropped ON tokens.doc_id = dropped.doc_id AND tokens.i = dropped.i
    GROUP BY tokens.doc_id
)
SELECT documents.doc_id, coalesce(n_runs, 0) AS n_runs, ranked.start, ranked.length, ranked.period,
       1000 * ranked.length // ranked.period AS exponent_milli,
       sha256(coalesce(lines, '')) AS runs_sha256,
       sha256(coalesce(collapsed, '')) AS collapsed_sha256
FROM documents LEFT JOIN listed ON documents.doc_id = listed.doc_id
LEFT JOIN ranked ON documents.doc_id = ranked.doc_id AND place = 1
LEFT JOIN kept ON documents.doc_id = kept.doc_id
"""

ORACLE["op13_lexical_search"] = r"""
WITH doc_terms AS (
    SELECT doc_id, unnest(regexp_extract_all(
               translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
               '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
    FROM documents
), item_terms AS (
    SELECT item_id, unnest(regexp_extract_all(
               translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
               '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
    FROM benchmark
), lengths AS (
    SELECT doc_id, count(*) AS n FROM doc_terms GROUP BY doc_id
), totals AS (
    SELECT count(*) AS docs, CAST(sum(n) AS BIGINT) AS terms FROM lengths
), frequencies AS (
    SELECT doc_id, term, count(*) AS tf FROM doc_terms
    WHERE term IN (SELECT term FROM item_terms) GROUP BY doc_id, term
), weights AS (
    SELECT term, CAST(floor(1000 * ln((2 * docs + 2) / (2 * count(*) + 1))) AS BIGINT) AS w
    FROM frequencies, totals GROUP BY term, docs
), parts AS (
    SELECT doc_id, term,
           w * ((1000000000 * tf) // (1000 * tf + 12 * (75 + (25 * n * docs) // terms))) AS part
    FROM frequencies JOIN weights USING (term) JOIN lengths USING (doc_id), totals
), scored AS (
    SELECT item_id, doc_id, CAST(sum(part) AS BIGINT) AS score
    FROM item_terms JOIN parts USING (term) GROUP BY item_id, doc_id
), ranked AS (
    SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INT)
               AS rank, doc_id, score
    FROM scored WHERE score > 0
)
SELECT * FROM ranked WHERE rank <= 20
"""
