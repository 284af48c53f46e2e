"""The queries of the corpus operators, and DuckDB SQL for those that SQL expresses.

Each takes (spark, sf_dir) and applies its operator to the whole table with
production parameters.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm import collocations, decontaminate, html_text, kneser_ney, merkle, mixing, passages, quality_rules, repeated_bytes, simhash, site_lines, token_counts, token_files
from tessera.llm.common import read


def op1_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = mixing.mix(read(spark, sf_dir, "documents"))
    return found.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"), "source", "copies")


def op2_repeated_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return passages.repeated_passages(read(spark, sf_dir, "documents"))


def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(read(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


def op4_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.main_texts(read(spark, sf_dir, "pages"))


def op5_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files.round_trip(read(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op6_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(read(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def op7_site_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return site_lines.drop_site_lines(read(spark, sf_dir, "pages"))


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.measured(read(spark, sf_dir, "documents"))


def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.item_hits(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", F.size("item_ids").cast("long").alias("n_items"), F.sha2(F.concat_ws(",", "item_ids"), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"))


def op10_perplexity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kneser_ney.classify(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.verified(read(spark, sf_dir, "documents"))


def op12_repeated_bytes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeated_bytes.digests(read(spark, sf_dir, "documents"))


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(read(spark, sf_dir, "documents"))


QUERIES = {
    "op1_source_mixing": op1_source_mixing,
    "op2_repeated_passages": op2_repeated_passages,
    "op3_token_counts": op3_token_counts,
    "op4_html_text": op4_html_text,
    "op5_token_files": op5_token_files,
    "op6_simhash_near_dedup": op6_simhash_near_dedup,
    "op7_site_lines": op7_site_lines,
    "op8_quality_rules": op8_quality_rules,
    "op9_decontamination": op9_decontamination,
    "op10_perplexity": op10_perplexity,
    "op11_merkle_manifest": op11_merkle_manifest,
    "op12_repeated_bytes": op12_repeated_bytes,
    "op13_collocations": op13_collocations,
}

def _climb(name: str, key: str, levels: int) -> str:
    """DuckDB SQL: ``name``0 (key, pos, d) climbed level by level; ``name``_up has each node's siblings in all of its ancestors' runs, ``name``_root the roots.

    A tree that is one node stays as it is. ``levels`` levels are enough for 3 ** levels nodes.
    """
    out = []
    for k in range(levels):
        out.append(f"{name}{k + 1} AS (SELECT {key}, pos // 3 AS pos, CASE WHEN n = 1 THEN min(d) ELSE sha256(string_agg(d, '' ORDER BY pos)) END AS d FROM (SELECT *, count(*) OVER (PARTITION BY {key}) AS n FROM {name}{k}) GROUP BY {key}, n, pos // 3)")
        out.append(f"{name}_s{k} AS (SELECT x.{key}, x.pos, coalesce(string_agg(y.d, '' ORDER BY y.pos) FILTER (y.pos < x.pos), '') AS b, coalesce(string_agg(y.d, '' ORDER BY y.pos) FILTER (y.pos > x.pos), '') AS a, max(x.n) > 1 AS run FROM (SELECT *, count(*) OVER (PARTITION BY {key}) AS n FROM {name}{k}) x JOIN {name}{k} y ON x.{key} = y.{key} AND x.pos // 3 = y.pos // 3 GROUP BY x.{key}, x.pos)")
    ups = ", ".join(f"s{k}.run AS r{k}, s{k}.b AS b{k}, s{k}.a AS a{k}" for k in range(levels))
    joins = " ".join(f"JOIN {name}_s{k} s{k} ON s{k}.{key} = x.{key} AND s{k}.pos = x.pos // {3**k}" for k in range(levels))
    out.append(f"{name}_up AS (SELECT x.{key}, x.pos, {ups} FROM {name}0 x {joins})")
    return ", ".join(out)


def _fold_steps(start: str, name: str, levels: int) -> str:
    """DuckDB SQL: one subquery a level, as a digest that stood twice in one expression would double it at each level."""
    sql = start
    for k in range(levels):
        sql = f"SELECT * REPLACE (CASE WHEN {name}_r{k} THEN sha256({name}_b{k} || f || {name}_a{k}) ELSE f END AS f) FROM ({sql})"
    return sql


_CRC = """xor(4294967295::BIGINT, list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda c: ascii(c)::BIGINT)),
        lambda x, y: list_reduce(list_prepend(xor(x, y), range(8)), lambda p, q: CASE WHEN p % 2 = 1 THEN xor(p // 2, 3988292384::BIGINT) ELSE p // 2 END)))"""
_FIELDS = " || ".join(f"coalesce(octet_length(encode(CAST({c} AS VARCHAR))) || ':' || CAST({c} AS VARCHAR), '-')" for c in ("doc_id", "source", "lang", "n_chars"))
_LEAF = "sha256({0} || coalesce(octet_length(encode({1})) || ':' || {1}, '-'))"
_LEVELS, _SOURCE_LEVELS = 8, 4


def _merkle_sql() -> str:
    steps = [("l", k) for k in range(_LEVELS)] + [("s", k) for k in range(_SOURCE_LEVELS)]
    columns = ", ".join(f"{n}.r{k} AS {n}_r{k}, {n}.b{k} AS {n}_b{k}, {n}.a{k} AS {n}_a{k}" for n, k in steps)
    proof = " || ".join(f"{n}_b{k} || {n}_a{k}" for n, k in steps)
    start = f"SELECT d.doc_id, d.leaf, t.d AS subroot, r.d AS root, d.tampered AS f, {columns} FROM d JOIN l_up l ON l.src = d.src AND l.pos = d.pos JOIN l{_LEVELS} t ON t.src = d.src JOIN s0 ON s0.src = d.src JOIN s_up s ON s.pos = s0.pos CROSS JOIN s{_SOURCE_LEVELS} r"
    folded = _fold_steps(_fold_steps(start, "l", _LEVELS), "s", _SOURCE_LEVELS)
    return f"""
        WITH h AS (SELECT doc_id, coalesce('1' || source, '0') AS src, {_LEAF.format(_FIELDS, "text")} AS leaf,
                          CASE WHEN doc_id IS NOT NULL AND {_CRC} % 2 = 0 THEN {_LEAF.format(_FIELDS, "replace(text, chr(10), '')")} ELSE {_LEAF.format(_FIELDS, "text")} END AS tampered FROM documents),
        d AS MATERIALIZED (SELECT *, row_number() OVER (PARTITION BY src ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos FROM h),
        l0 AS (SELECT src, pos, leaf AS d FROM d), {_climb("l", "src", _LEVELS)},
        s0 AS (SELECT 0 AS one, src, row_number() OVER (ORDER BY src) - 1 AS pos, d FROM l{_LEVELS}), {_climb("s", "one", _SOURCE_LEVELS)}
        SELECT doc_id, leaf, subroot, root, sha256({proof}) AS proof_sha256, f AS folded_root, f = root AS verified FROM ({folded})"""


ORACLE_SQL = {
    "op13_collocations": r"""
        WITH d AS (SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
        w AS (SELECT lang, list_filter(regexp_split_to_array(piece, '[\x20\x09]+'), lambda x: x <> '') AS words FROM d),
        total AS (SELECT lang, sum(len(words))::BIGINT AS n FROM w GROUP BY lang),
        s AS (SELECT lang, words, k, unnest(range(1, len(words) - k + 2)) AS i FROM w, (SELECT unnest(range(1, 6)) AS k) WHERE len(words) >= k),
        f AS (SELECT lang, words[i : i + k - 1] AS p, count(*) AS f FROM s GROUP BY ALL HAVING count(*) >= 100),
        c AS (SELECT lang, p, f AS a FROM f WHERE len(p) > 1),
        part AS (SELECT lang, p, a, k, unnest(range(1, len(p) - k + 2)) AS i FROM c, (SELECT unnest(range(2, 5)) AS k) WHERE len(p) > k),
        held AS (SELECT lang, p[i : i + k - 1] AS p, max(a) AS longer FROM part GROUP BY ALL),
        kept AS (SELECT c.* FROM c LEFT JOIN held h ON h.lang = c.lang AND h.p = c.p WHERE longer IS NULL OR 100 * longer < 100 * a),
        cut AS (SELECT lang, p, a, unnest(range(1, len(p))) AS k FROM kept),
        score AS (SELECT c.lang, c.p, a, k, x.f AS l, y.f AS r, n, ((1000::HUGEINT * a * n) // (x.f::HUGEINT * y.f))::BIGINT AS score FROM cut c JOIN total t ON t.lang = c.lang
                  JOIN f x ON x.lang = c.lang AND x.p = c.p[1 : k] JOIN f y ON y.lang = c.lang AND y.p = c.p[k + 1 :]),
        low AS (SELECT lang, array_to_string(p, ' ') AS phrase, a, l, r, n, score FROM score QUALIFY row_number() OVER (PARTITION BY lang, p ORDER BY score, k) = 1)
        SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score FROM low QUALIFY rank <= 2000""",
    "op11_merkle_manifest": _merkle_sql(),
    "op12_repeated_bytes": r"""
        WITH d AS (SELECT row_number() OVER () AS rid, doc_id, encode(coalesce(text, '')) AS t FROM documents),
        w AS (SELECT rid, doc_id, k, t[k + 1 : k + 50] AS w FROM (SELECT *, unnest(range(octet_length(t) - 49)) AS k FROM d)),
        least AS (SELECT w, min(doc_id) AS least FROM w GROUP BY w),
        hit AS (SELECT rid, k FROM w JOIN least USING (w) WHERE least < doc_id),
        run AS (SELECT rid, k, sum(fresh) OVER (PARTITION BY rid ORDER BY k) AS span FROM (SELECT rid, k, CASE WHEN k - lag(k) OVER (PARTITION BY rid ORDER BY k) <= 50 THEN 0 ELSE 1 END AS fresh FROM hit)),
        span AS (SELECT rid, min(k) AS start, max(k) + 50 AS stop FROM run GROUP BY rid, span),
        per AS (SELECT rid, sum(stop - start)::BIGINT AS n_removed, count(*) AS n_spans FROM span GROUP BY rid),
        edge AS (SELECT rid, stop AS lo, lead(start) OVER (PARTITION BY rid ORDER BY start) AS hi FROM (SELECT * FROM span UNION ALL SELECT rid, -1, 0 FROM d)),
        kept AS (SELECT e.rid, string_agg(hex(t[lo + 1 : coalesce(hi, octet_length(t))]), '' ORDER BY lo) AS kept FROM edge e JOIN d USING (rid) GROUP BY e.rid)
        SELECT doc_id, octet_length(t) AS n_bytes, coalesce(n_removed, 0) AS n_removed, coalesce(n_spans, 0) AS n_spans, sha256(unhex(kept)) AS kept_sha256
        FROM d LEFT JOIN per USING (rid) JOIN kept USING (rid)""",
    "op7_site_lines": r"""
        WITH d AS (SELECT row_number() OVER () AS rid, page_id, lower(coalesce(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://([^/?#:@]*)', 1), '')) AS host,
                          string_split(regexp_replace(coalesce(html, ''), '<[^>]*>', chr(10), 'g'), chr(10)) AS lines FROM pages),
        l AS (SELECT rid, page_id, host, unnest(lines) AS line, unnest(range(len(lines))) AS i FROM d),
        w AS (SELECT *, regexp_matches(line, '[^\x20\x09-\x0D]') AS word FROM l),
        total AS (SELECT host, count(*) AS n_pages FROM d GROUP BY host),
        often AS (SELECT w.host, line FROM w JOIN total t ON w.host = t.host WHERE word
                  GROUP BY w.host, line, n_pages HAVING count(DISTINCT rid) >= 3 AND count(DISTINCT rid) > 0.5 * n_pages),
        m AS (SELECT w.*, o.line IS NOT NULL AS gone FROM w LEFT JOIN often o ON w.host = o.host AND w.line = o.line AND w.word)
        SELECT page_id, host, count(*) FILTER (word)::BIGINT AS n_lines, count(*) FILTER (gone)::BIGINT AS n_dropped,
               coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (NOT gone), '') AS text
        FROM m GROUP BY rid, page_id, host""",
    "op8_quality_rules": r"""
        WITH d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS text FROM documents),
        w AS (SELECT rid, doc_id, text, list_filter(regexp_split_to_array(text, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS words FROM d),
        g AS (SELECT rid, unnest(range(1, len(words) - 1)) AS k, words FROM w WHERE len(words) >= 3),
        gs AS (SELECT rid, k, words[k] || ' ' || words[k + 1] || ' ' || words[k + 2] AS gram FROM g),
        rep AS (SELECT rid, k FROM gs QUALIFY count(*) OVER (PARTITION BY rid, gram) > 1),
        covered AS (SELECT rid, count(DISTINCT p) AS n FROM (SELECT rid, unnest([k, k + 1, k + 2]) AS p FROM rep) GROUP BY rid),
        m AS (SELECT w.rid, doc_id, len(words)::BIGINT AS n_words,
                     coalesce(list_sum(list_transform(words, lambda x: length(x))), 0)::BIGINT AS word_chars,
                     len(regexp_extract_all(text, '[#*$%&|<>]'))::BIGINT AS n_symbols,
                     list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines,
                     coalesce(c.n, 0)::BIGINT AS n_repeat_words
              FROM w LEFT JOIN covered c ON c.rid = w.rid),
        l AS (SELECT *, (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines,
                     n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM m)
        SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
               NOT (base_failed OR word_chars < 2 * n_words OR word_chars > 15 * n_words
                    OR 10 * n_symbols > n_words OR 20 * n_dup_lines > n_words) AS kept
        FROM l""",
    "op9_decontamination": r"""
        WITH iw AS (SELECT CAST(item_id AS VARCHAR) AS item_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS words FROM benchmark),
        wins AS (SELECT item_id, least(10, len(words)) AS n, unnest(range(1, greatest(len(words) - 9, 1) + 1)) AS s, words FROM iw WHERE len(words) > 0),
        win AS (SELECT DISTINCT item_id, n, array_to_string(words[s : s + n - 1], ' ') AS win FROM wins),
        dw AS (SELECT row_number() OVER () AS rid, doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS words FROM documents),
        sizes AS (SELECT DISTINCT n FROM win),
        runs AS (SELECT rid, sizes.n AS n, unnest(range(1, len(words) - sizes.n + 2)) AS s, words FROM dw, sizes WHERE len(words) >= sizes.n),
        held AS (SELECT r.rid, r.s, r.n, win.item_id FROM runs r JOIN win ON win.n = r.n AND win.win = array_to_string(r.words[r.s : r.s + r.n - 1], ' ')),
        hit AS (SELECT rid, count(DISTINCT p) AS n_hit FROM (SELECT rid, unnest(range(s, s + n)) AS p FROM held) GROUP BY rid),
        ids AS (SELECT rid, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS ids FROM (SELECT DISTINCT rid, item_id FROM held) GROUP BY rid)
        SELECT doc_id, len(words)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
               sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
        FROM dw LEFT JOIN hit USING (rid) LEFT JOIN ids USING (rid)""",
}
