"""Registered queries of the subpackage: thin builders over the operators."""

from __future__ import annotations

from . import (compression_quality, decontaminate, html_extract, line_dedup, mixing, near_dup,
               quality_rules, ranked_search, secret_scan, spelling, suffix_dedup, token_counts,
               warc)
from .tables import table


def op1_benchmark_decontamination(spark, sf_dir):
    return decontaminate.find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op2_quality_classifier(spark, sf_dir):
    return compression_quality.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op3_html_extraction(spark, sf_dir):
    return html_extract.extract_pages(table(spark, sf_dir, "pages"))


def op4_suffix_dedup(spark, sf_dir):
    return suffix_dedup.repeat_report(table(spark, sf_dir, "documents"))


def op5_line_dedup(spark, sf_dir):
    return line_dedup.line_report(table(spark, sf_dir, "documents"))


def op6_quality_rules(spark, sf_dir):
    return quality_rules.quality_rules(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", "kept")


def op7_secret_scan(spark, sf_dir):
    return secret_scan.secret_scan(table(spark, sf_dir, "documents"))


def op8_source_mixing(spark, sf_dir):
    return mixing.mix(table(spark, sf_dir, "documents"))


def op9_token_counts(spark, sf_dir):
    return token_counts.token_counts(table(spark, sf_dir, "documents"))


def op10_minhash_near_dedup(spark, sf_dir):
    return near_dup.near_dups(table(spark, sf_dir, "documents"), width=2).drop("_nd_k")


def op11_warc(spark, sf_dir):
    return warc.archive_and_read(table(spark, sf_dir, "pages"))


def op12_ranked_search(spark, sf_dir):
    return ranked_search.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op13_spelling_variants(spark, sf_dir):
    return spelling.spelling_groups(table(spark, sf_dir, "documents"))


QUERIES = {
    "op1_benchmark_decontamination": op1_benchmark_decontamination,
    "op2_quality_classifier": op2_quality_classifier,
    "op3_html_extraction": op3_html_extraction,
    "op4_suffix_dedup": op4_suffix_dedup,
    "op5_line_dedup": op5_line_dedup,
    "op6_quality_rules": op6_quality_rules,
    "op7_secret_scan": op7_secret_scan,
    "op8_source_mixing": op8_source_mixing,
    "op9_token_counts": op9_token_counts,
    "op10_minhash_near_dedup": op10_minhash_near_dedup,
    "op11_warc": op11_warc,
    "op12_ranked_search": op12_ranked_search,
    "op13_spelling_variants": op13_spelling_variants,
}

def quality_sql() -> str:
    """op6 in DuckDB SQL: features by text functions, sketches as counts per logarithmic bucket."""
    q = quality_rules
    value = " ".join(f"WHEN '{m}' THEN CASE WHEN {below} > 0 THEN {top} / {below} ELSE 0 END"
                     for m, (top, below, _, _) in q.METRICS.items())
    floor = " ".join(f"WHEN '{m}' THEN {least}" for m, (_, _, least, _) in q.METRICS.items())
    two = ", ".join(f"'{m}'" for m, v in q.METRICS.items() if v[3])
    g = f"((1 + {q.SKETCH_ERROR}) / (1 - {q.SKETCH_ERROR}))"
    g = g.replace("1 +", "1::DOUBLE +").replace("1 -", "1::DOUBLE -")

    def fences(name: str, keys: str) -> str:
        by = f"{keys}, " if keys else ""
        return f"""
        {name}_m AS (SELECT {by}metric, bucket, sum(n) AS n FROM sketch GROUP BY ALL),
        {name}_r AS (SELECT {by}metric, CASE WHEN bucket = 0 THEN 0 ELSE 2 * {q.SMALLEST}::DOUBLE * pow({g}, bucket) / (1 + {g}) END AS v,
                     sum(n) OVER (PARTITION BY {by}metric ORDER BY bucket) AS upto,
                     sum(n) OVER (PARTITION BY {by}metric) AS docs FROM {name}_m),
        {name}_q AS (SELECT {by}metric, max(docs) AS docs, min(v) FILTER (WHERE upto >= 0.25 * docs) AS q25,
                     min(v) FILTER (WHERE upto >= 0.75 * docs) AS q75 FROM {name}_r GROUP BY ALL),
        {name} AS (SELECT {by}metric, docs, q25 - {q.FENCE}::DOUBLE * greatest(q75 - q25, CASE metric {floor} END) AS low,
                   q75 + {q.FENCE}::DOUBLE * greatest(q75 - q25, CASE metric {floor} END) AS high FROM {name}_q)"""
    return rf"""
        WITH t AS MATERIALIZED (SELECT row_number() OVER () AS k, doc_id, lang, source, coalesce(text, '') AS t FROM documents),
        w AS (SELECT k, u.w, u.i FROM t, LATERAL (
              SELECT unnest(regexp_extract_all(t.t, '[^\x20\x09-\x0D]+')) AS w,
                     generate_subscripts(regexp_extract_all(t.t, '[^\x20\x09-\x0D]+'), 1) AS i) u),
        g AS (SELECT k, i, w, lead(w) OVER o AS w2, lead(w, 2) OVER o AS w3 FROM w WINDOW o AS (PARTITION BY k ORDER BY i)),
        d AS (SELECT k, i, w, (w3 IS NOT NULL AND count(*) OVER (PARTITION BY k, w, w2, w3) > 1)::INT AS again FROM g),
        c AS (SELECT k, w, (again + coalesce(lag(again) OVER o, 0) + coalesce(lag(again, 2) OVER o, 0) > 0)::INT AS covered
              FROM d WINDOW o AS (PARTITION BY k ORDER BY i)),
        f1 AS (SELECT k, count(*) AS n_words, sum(length(w)) AS word_chars, sum(covered) AS n_repeat_words FROM c GROUP BY k),
        l AS (SELECT k, unnest(string_split(t, chr(10))) AS line FROM t),
        f2 AS (SELECT k, count(*) AS n_lines, count(*) - count(DISTINCT line) AS n_dup_lines
               FROM l WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY k),
        f AS (SELECT t.k, doc_id, lang, source, coalesce(n_words, 0)::BIGINT AS n_words,
                     coalesce(word_chars, 0)::BIGINT AS word_chars, coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words,
                     coalesce(n_lines, 0)::BIGINT AS n_lines, coalesce(n_dup_lines, 0)::BIGINT AS n_dup_lines,
                     (length(t) - length(regexp_replace(t, '[#*$%&|<>]+', '', 'g')))::BIGINT AS n_symbols,
                     (length(t) - length(regexp_replace(t, '\p{{Lu}}+', '', 'g')))::BIGINT AS n_capitals,
                     (length(t) - length(regexp_replace(t, '[!?]+', '', 'g')))::BIGINT AS n_marks
              FROM t LEFT JOIN f1 USING (k) LEFT JOIN f2 USING (k)),
        m AS (SELECT k, lang, source, metric, (CASE metric {value} END)::DOUBLE AS value, n_words
              FROM f, (SELECT unnest([{', '.join(f"'{m}'" for m in q.METRICS)}]) AS metric)),
        sketch AS MATERIALIZED (SELECT lang, source, metric, CASE WHEN value <= {q.SMALLEST} THEN 0
                   ELSE ceil(ln(value / {q.SMALLEST}::DOUBLE) / ln({g})) END AS bucket, count(*) AS n
                   FROM m WHERE n_words > 0 GROUP BY ALL),
        {fences("own", "lang, source")}, {fences("by_lang", "lang")}, {fences("by_all", "")},
        cuts AS (SELECT own.lang, own.source, metric,
                 (own.docs * own.low + {q.PRIOR} * ((b.docs * b.low + {q.PRIOR} * a.low) / (b.docs + {q.PRIOR}))) / (own.docs + {q.PRIOR}) AS low,
                 (own.docs * own.high + {q.PRIOR} * ((b.docs * b.high + {q.PRIOR} * a.high) / (b.docs + {q.PRIOR}))) / (own.docs + {q.PRIOR}) AS high
                 FROM own JOIN by_lang b USING (metric) JOIN by_all a USING (metric) WHERE own.lang IS NOT DISTINCT FROM b.lang),
        bad AS (SELECT DISTINCT k FROM m JOIN cuts c USING (metric)
                WHERE m.lang IS NOT DISTINCT FROM c.lang AND m.source IS NOT DISTINCT FROM c.source
                  AND (value > high OR (metric IN ({two}) AND value < low))),
        v AS (SELECT *, n_words < {q.MIN_WORDS} OR 100 * n_repeat_words > {q.MAX_REPEAT_PERCENT} * n_words AS base_failed FROM f)
        SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
               NOT base_failed AND k NOT IN (SELECT k FROM bad) AS kept
        FROM v"""


#: DuckDB SQL where a result can be said in SQL.
SQL: dict[str, str] = {
    "op6_quality_rules": quality_sql(),
    "op11_warc": """
        WITH p AS (SELECT page_id, coalesce(html, '') AS payload FROM pages),
        q AS (SELECT page_id, strlen(payload)::BIGINT AS payload_bytes, sha256(payload) AS payload_digest FROM p),
        r AS (SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS low FROM q)
        SELECT page_id, payload_bytes, payload_digest,
               CASE WHEN payload_bytes >= 100 AND page_id <> low THEN 'revisit' ELSE 'response' END AS record_type,
               CASE WHEN payload_bytes >= 100 AND page_id <> low THEN low END AS refers_to
        FROM r""",
    "op12_ranked_search": r"""
        WITH d AS MATERIALIZED (
            SELECT row_number() OVER () AS k, doc_id,
                   translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents),
        i AS MATERIALIZED (
            SELECT row_number() OVER () AS j, item_id,
                   translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM benchmark),
        q AS (SELECT DISTINCT j, item_id,
                     unnest(regexp_extract_all(t, '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM i),
        w AS (SELECT k, doc_id,
                     unnest(regexp_extract_all(t, '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM d),
        tf AS (SELECT k, any_value(doc_id) AS doc_id, term, count(*) AS tf FROM w GROUP BY k, term),
        n AS (SELECT k, sum(tf)::BIGINT AS n FROM tf GROUP BY k),
        s AS (SELECT count(*) AS nn, sum(n)::BIGINT AS ll FROM n),
        df AS (SELECT term, count(*) AS df FROM tf GROUP BY term),
        c AS (SELECT j, item_id, k, doc_id,
                     sum(floor(1000 * ln((2 * nn + 2) / (2 * df + 1)))::BIGINT
                         * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * n * nn) // ll))))::BIGINT AS score
              FROM q JOIN tf USING (term) JOIN df USING (term) JOIN n USING (k) CROSS JOIN s
              GROUP BY j, item_id, k, doc_id),
        r AS (SELECT *, row_number() OVER (PARTITION BY j ORDER BY score DESC, doc_id, k)::INTEGER AS "rank"
              FROM c WHERE score > 0)
        SELECT item_id, "rank", doc_id, score FROM r WHERE "rank" <= 10""",
}
