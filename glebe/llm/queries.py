"""Queries of the operators over whole tables, and the SQL that gives the same rows where SQL can."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from glebe.llm import codes, conversations, decontaminate, hmm, html, language, licences, mixing, privacy, quality, simhash, urls
from glebe.llm.near import NearCopies
from glebe.llm.tables import fold, table

QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def keep(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return keep


@register(
    "op8_decontaminate",
    r"""
    WITH d AS (SELECT row_number() OVER () AS k, doc_id,
               regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                  '[0-9a-z\x{80}-\x{10FFFF}]+') AS w FROM documents),
    b AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                  '[0-9a-z\x{80}-\x{10FFFF}]+') AS w FROM benchmark),
    bw AS (SELECT DISTINCT item_id, len(w[i:i + 9]) AS n, array_to_string(w[i:i + 9], ' ') AS win
           FROM b, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS u(i) WHERE len(w) > 0),
    dw AS (SELECT k, i, n, array_to_string(w[i:i + n - 1], ' ') AS win
           FROM d, (SELECT DISTINCT n FROM bw) AS sizes, unnest(range(1, len(w) - n + 2)) AS u(i)),
    m AS (SELECT k, i, dw.n, item_id FROM dw JOIN bw USING (win) WHERE dw.n = bw.n),
    h AS (SELECT k, count(DISTINCT p) AS n_hit FROM (SELECT k, unnest(range(i, i + n)) AS p FROM m) GROUP BY k),
    t AS (SELECT k, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
          FROM (SELECT DISTINCT k, CAST(item_id AS VARCHAR) AS item FROM m) GROUP BY k)
    SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
           CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(items, '')) AS items_sha256,
           coalesce(n_hit, 0) > 0 AS contaminated
    FROM d LEFT JOIN h USING (k) LEFT JOIN t USING (k)""",
)
def op8_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exact ten-word windows of the benchmark items in every document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found, (n_words, hits, items) = decontaminate.search(docs, table(spark, sf_dir, "benchmark"))
    n_hit = F.size(hits).cast("long")
    return found.select(
        "doc_id",
        F.col(n_words).alias("n_words"),
        n_hit.alias("n_hit"),
        F.size(items).cast("long").alias("n_items"),
        F.sha2(F.array_join(items, ","), 256).alias("items_sha256"),
        (n_hit > 0).alias("contaminated"),
    )


@register("op7_near_copies")
def op7_near_copies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with the least id of its class of near copies and whether it is that document."""
    found = NearCopies(table(spark, sf_dir, "documents")).classes()
    return found.select(
        F.col("id").alias("doc_id"), F.col("class").alias("class_id"), F.col("id").eqNullSafe(F.col("class")).alias("is_first")
    )


@register(
    "op2_quality_rules",
    r"""
    WITH d AS (SELECT row_number() OVER () AS k, doc_id, coalesce(text, '') AS text FROM documents),
    w AS (SELECT *, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS w FROM d),
    ln AS (SELECT k, count(*) AS n_lines, count(*) - count(DISTINCT line) AS n_dup
           FROM (SELECT k, unnest(string_split(text, chr(10))) AS line FROM d) WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY k),
    win AS (SELECT k, i, array_to_string(w[i:i + 7], ' ') AS t FROM w, unnest(range(1, len(w) - 6)) AS u(i)),
    dup AS (SELECT k, unnest(starts) AS i FROM (SELECT k, list(i) AS starts FROM win GROUP BY k, t HAVING count(*) > 1)),
    rep AS (SELECT k, count(DISTINCT p) AS n FROM (SELECT k, unnest(range(i, i + 8)) AS p FROM dup) GROUP BY k),
    m AS (SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(length(regexp_replace(text, '[\x20\x09-\x0D]', '', 'g')) AS BIGINT) AS word_chars,
                 CAST(length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols, coalesce(n_dup, 0) AS n_dup_lines,
                 coalesce(rep.n, 0) AS n_repeat_words, coalesce(n_lines, 0) AS n_lines,
                 length(regexp_replace(text, '[^A-Z]', '', 'g')) AS up, length(regexp_replace(text, '[^A-Za-z]', '', 'g')) AS letters
          FROM w LEFT JOIN ln USING (k) LEFT JOIN rep USING (k)),
    b AS (SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM m)
    SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
           NOT (base_failed OR 100 * n_symbols > 10 * word_chars OR word_chars > 30 * n_words
                OR (letters > 0 AND 100 * up > 60 * letters) OR 100 * n_dup_lines > 60 * n_lines) AS kept
    FROM b""",
)
def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Measures of every whole document and the verdict of the cascade."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    judged, (rejected, *names) = quality.judge(docs, measures=quality.MEASURES)
    failed = F.expr("n_words < 20 OR 100 * n_repeat_words > 30 * n_words")
    return judged.select("doc_id", *names, failed.alias("base_failed"), (~failed & F.col(rejected).isNull()).alias("kept"))


@register("op3_mix_sources")
def op3_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words that the mix takes of every document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", mixing.word_count(F.col("text")).alias("words"))
    mixed, (size, source_size, target, copies) = mixing.mix(docs, size=F.col("words"))
    return mixed.select(
        "doc_id", F.col(size).alias("size"), F.col(source_size).alias("source_size"), F.col(target).alias("target"),
        (F.col(size) * F.col(copies)).alias("taken"), F.col(copies).alias("copies"),
    )


@register("op9_personal_data")
def op9_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spans of personal data and of the terms that reveal it, in every whole document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found, (base, terms) = privacy.scan(docs)
    counts = [privacy.number(base, k).cast("long").alias(f"n_{name}") for k, name in enumerate(privacy.KINDS[:4])]
    return found.select(
        "doc_id", *counts, F.sha2(privacy.digest(F.col(base)), 256).alias("base_sha256"), privacy.digest(F.concat(base, terms)).alias("spans")
    )


URL_RULES = urls.Rules([("block", "net/"), ("allow", "example.net/en/"), ("block", "example.com/de/"), ("allow", "org/fr/")])


@register("op1_url_filter")
def op1_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdict on the url of every page."""
    labelled = spark.createDataFrame([(u, 1) for u in urls.BLOCKED] + [(u, 0) for u in urls.ALLOWED], "url string, blocked int")
    judged, names = urls.judge(table(spark, sf_dir, "pages").select("page_id", "url"), URL_RULES, urls.train(labelled))
    return judged.select("page_id", *[F.col(n).alias(k) for n, k in zip(names, ("host", "path", "rule", "verdict", "score"))])


@register("op4_language_id")
def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every whole document, learned from four fifths of them."""
    docs = table(spark, sf_dir, "documents").withColumn("held_out", fold(F.col("doc_id"), 5) == 0)
    model = language.train(docs.filter("NOT held_out").select("text", "lang"))
    found, (lang, score) = language.predict(docs.select("doc_id", "held_out", "text"), model)
    return found.select("doc_id", "held_out", F.col(lang).alias("lang_pred"), F.col(score).alias("score"))


@register("op6_main_text")
def op6_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    found, text = html.extract(table(spark, sf_dir, "pages").select("page_id", "url", "html"))
    return found.select("page_id", "url", F.col(text).alias("text"), F.length(text).cast("long").alias("n_chars"))


@register("op10_lm_score")
def op10_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Score of every whole document under the hidden Markov model of six sevenths of them."""
    docs = table(spark, sf_dir, "documents").select("doc_id", (fold(F.col("doc_id"), 7) == 2).alias("held_out"), "text")
    found, (n, known, base, score), vocab, _ = hmm.score(docs, ~F.col("held_out"))
    return found.select(
        "doc_id", "held_out", F.col(n).alias("n_tokens"), F.col(known).alias("n_known"),
        F.lit(vocab.tokens).cast("long").alias("train_tokens"), F.col(base).alias("base_score"), F.col(score).alias("score"),
    )


@register("op5_licence_scan")
def op5_licence_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licence notices in every whole document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    texts = docs.withColumn("print", F.xxhash64("text"))
    found = licences.paragraphs(docs, licences.train(docs)).groupBy("print").agg(
        F.count("*").alias("n"), F.sort_array(F.collect_set("family")).alias("families"), F.sort_array(F.collect_list("line")).alias("lines")
    )
    return texts.select("doc_id", "print").join(found, "print", "left").select(
        "doc_id", F.coalesce("n", F.lit(0)).cast("long").alias("n_licences"), F.coalesce(F.array_join("families", ","), F.lit("")).alias("families"),
        F.coalesce(F.array_join(F.col("lines").cast("array<string>"), ","), F.lit("")).alias("lines"),
    )


@register("op11_simhash")
def op11_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and component of every whole document."""
    found, (value, part) = simhash.find(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("doc_id", simhash.hexadecimal(F.col(value)).alias("fingerprint"), F.col(part).alias("component_id"))


def damaged(turns: DataFrame) -> DataFrame:
    """The rows of conversations with faults put in; ``present`` is false for those to be left out."""
    said = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    fault = F.crc32(F.concat(said("conv_id"), F.lit(":"), said("turn"))) % 20
    text = F.when(fault == 1, "").when(fault == 2, F.regexp_replace(said("text"), "[.!?]", "")).otherwise(said("text"))
    role = F.when(fault == 4, "user").otherwise(said("role"))
    copies = F.array_repeat(F.lit(1), F.when(fault == 3, 2).otherwise(1))
    return turns.select("conv_id", "turn", role.alias("role"), text.alias("text"), (fault != 0).alias("present"), F.explode(copies).alias("copy"))


@register(
    "op12_repair_conversations",
    r"""
    WITH RECURSIVE tab AS (SELECT list(list_reduce(range(9), lambda c, i: CASE WHEN i = 0 THEN c WHEN c % 2 = 1 THEN xor(3988292384, c >> 1) ELSE c >> 1 END, n) ORDER BY n) AS t
                 FROM range(256) AS r(n)),
    h AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
                 xor(4294967295, list_reduce(list_transform(string_split(coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' '), ''),
                                             lambda x: CAST(unicode(x) AS BIGINT)),
                                 lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1]), 4294967295)) % 20 AS f
          FROM conversations, tab),
    d AS (SELECT conv_id, turn, CASE WHEN f = 4 THEN 'user' ELSE role END AS role,
                 CASE WHEN f = 1 THEN '' WHEN f = 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text
          FROM h, range(2) AS c(copy) WHERE f <> 0 AND (copy = 0 OR f = 3)),
    o AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, md5(concat(length(role), ':', role, text))) AS i FROM d),
    r AS (SELECT *, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 AS again,
                 NOT regexp_matches(text, '[^ 	-
]') AS blank, NOT regexp_matches(text, '[.!?][ 	-
]*$') AS cut,
                 concat(lag(role[1:1]) OVER (PARTITION BY conv_id ORDER BY i), role[1:1]) AS pair FROM o),
    m AS (SELECT *, CASE WHEN cut THEN 5 ELSE 0 END AS stay, blank OR again AS gone, role[1:1] AS k FROM r),
    dp AS (SELECT conv_id, CAST(0 AS BIGINT) AS i,
                  {'c': CAST(0 AS BIGINT), 'a': '', 'o': ''} AS f0, {'c': CAST(1000000000 AS BIGINT), 'a': '', 'o': ''} AS f1,
                  {'c': CAST(1000000000 AS BIGINT), 'a': '', 'o': ''} AS f2, {'c': CAST(1000000000 AS BIGINT), 'a': '', 'o': ''} AS f3
           FROM (SELECT DISTINCT conv_id FROM conversations)
           UNION ALL
           SELECT conv_id, i,
                  {'c': g0.c + 2, 'a': g0.a || 'D', 'o': g0.o} AS f0,
                  list_min([{'c': g1.c + 2, 'a': g1.a || 'D', 'o': g1.o},
                            {'c': CASE WHEN NOT gone AND k = 's' THEN g0.c + stay ELSE 2000000000 END, 'a': g0.a || 'K', 'o': g0.o || said}]) AS f1,
                  list_min([{'c': g2.c + 2, 'a': g2.a || 'D', 'o': g2.o},
                            {'c': CASE WHEN NOT gone AND k = 'u' THEN g.c + stay ELSE 2000000000 END, 'a': g.a || 'K', 'o': g.o || said},
                            {'c': CASE WHEN NOT gone THEN g.c + stay + 1 ELSE 2000000000 END, 'a': g.a || 'R', 'o': g.o || chr(10) || 'user:' || text}]) AS f2,
                  list_min([{'c': g3.c + 2, 'a': g3.a || 'D', 'o': g3.o},
                            {'c': CASE WHEN NOT gone AND k = 'a' THEN g2.c + stay ELSE 2000000000 END, 'a': g2.a || 'K', 'o': g2.o || said},
                            {'c': CASE WHEN NOT gone THEN g2.c + stay + 1 ELSE 2000000000 END, 'a': g2.a || 'R', 'o': g2.o || chr(10) || 'assistant:' || text}]) AS f3
           FROM (SELECT *, list_min([g0, g1, g3]) AS g, chr(10) || role || ':' || text AS said
                 FROM (SELECT m.*, f0 AS g0, f1 AS g1,
                              list_min([f2, {'c': f0.c + 5, 'a': f0.a || 'I', 'o': f0.o || chr(10) || 'user:'},
                                        {'c': f1.c + 5, 'a': f1.a || 'I', 'o': f1.o || chr(10) || 'user:'},
                                        {'c': f3.c + 5, 'a': f3.a || 'I', 'o': f3.o || chr(10) || 'user:'}]) AS g2,
                              list_min([f3, {'c': f2.c + 5, 'a': f2.a || 'I', 'o': f2.o || chr(10) || 'assistant:'}]) AS g3
                       FROM dp JOIN m ON dp.conv_id IS NOT DISTINCT FROM m.conv_id AND m.i = dp.i + 1))),
    last AS (SELECT conv_id, max(i) AS i FROM dp GROUP BY conv_id),
    best AS (SELECT dp.conv_id, list_min([f0, f3, {'c': f2.c + 5, 'a': f2.a || 'I', 'o': f2.o || chr(10) || 'assistant:'}]) AS b
             FROM dp JOIN last ON dp.conv_id IS NOT DISTINCT FROM last.conv_id AND dp.i = last.i),
    n AS (SELECT conv_id, max(turn) - min(turn) + 1 - count(DISTINCT turn) AS gaps, count(*) FILTER (blank) AS blank,
                 count(*) FILTER (again AND NOT blank) AS duplicate, count(*) FILTER (cut AND NOT gone) AS truncated,
                 count(*) FILTER (i > 1 AND pair NOT IN ('su', 'ua', 'au')) AS illegal FROM m GROUP BY conv_id)
    SELECT best.conv_id, CAST(coalesce(gaps, 0) AS BIGINT) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
           coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, b.c AS cost, b.a AS audit, sha256(b.o[2:]) AS repaired_sha256
    FROM best LEFT JOIN n ON best.conv_id IS NOT DISTINCT FROM n.conv_id""",
)
def op12_repair_conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Faults of every damaged conversation and the cheapest edits that repair it."""
    return conversations.repair(damaged(table(spark, sf_dir, "conversations")), present=F.col("present"))


def _codes_sql() -> str:
    """Integer k-means round after round."""
    near = "list_sum(list_transform(list_zip(x, c), lambda z: (z[1] - z[2]) * (z[1] - z[2])))"
    assigned = "SELECT part, r, any_value(x) AS x, arg_min(e, d * 16 + e) AS e, min(d) AS d FROM (SELECT p.part, r, x, e, {near} AS d FROM p JOIN e{n} USING (part)) GROUP BY part, r"
    steps = []
    for n in range(codes.ROUNDS):
        steps.append(f"a{n} AS ({assigned.format(n=n, near=near)})")
        steps.append(
            f"m{n} AS (SELECT part, e, list((s - ((s % n) + n) % n) // n ORDER BY i) AS c FROM (SELECT part, e, i, sum(x[i])::BIGINT AS s, count(*) AS n "
            f"FROM a{n}, unnest(range(1, len(x) + 1)) AS u(i) GROUP BY part, e, i) GROUP BY part, e)"
        )
        steps.append(f"e{n + 1} AS (SELECT part, e, coalesce(m{n}.c, e{n}.c) AS c FROM e{n} LEFT JOIN m{n} USING (part, e))")
    n = codes.ROUNDS
    return rf"""
    WITH k AS (SELECT row_number() OVER (ORDER BY vec_id) AS r, vec_id, label, list_transform(embedding, lambda x: CAST(floor(4096 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
               FROM embeddings WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0),
    p AS (SELECT r, part, v[part * (len(v) // 8) + 1:(part + 1) * (len(v) // 8)] AS x FROM k, range(8) AS t(part)),
    e0 AS (SELECT part, r - 1 AS e, x AS c FROM p WHERE r <= 16),
    {", ".join(steps)},
    f AS ({assigned.format(n=n, near=near)}),
    g AS (SELECT r, string_agg(printf('%02x', e), '' ORDER BY part) AS code, CAST(sum(d) AS BIGINT) AS error FROM f GROUP BY r),
    b AS (SELECT sha256(string_agg(array_to_string(c, ','), ',' ORDER BY part, e)) AS codebooks_sha256 FROM e{n})
    SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, codebooks_sha256
    FROM k JOIN g USING (r), b"""


@register("op13_vector_codes", _codes_sql())
def op13_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Code and error of every usable vector under codebooks learned from all."""
    found = codes.compress(table(spark, sf_dir, "embeddings").select("vec_id", "label", "embedding"))
    return codes.with_sums(found.found, "label", found.error, "label_error").select(
        "vec_id", F.lower(F.hex(found.code)).alias("code"), F.col(found.error).alias("error"), "label_error",
        F.lit(found.digest).alias("codebooks_sha256"),
    )
