"""The operators over the given tables, each with the columns of its contract, and SQL where SQL can express it."""
from __future__ import annotations

import public_tokenizers
from pyspark.sql import functions as F

from feedyard.llm import (bpe, curriculum, decontaminate, exact_dedup, language, line_dedup, merkle, near_dedup, periodic_runs, secrets, sharding,
                          token_files, toxicity)
from feedyard.llm.common import read_table
from feedyard.session import work_dir

TOKENIZER = "byte_bpe_50k.json"
END_ID = 2


def op1_near_dedup(spark, sf_dir):
    return near_dedup.near_components(read_table(spark, sf_dir, "documents")).drop("tag")


def op2_bpe(spark, sf_dir):
    return bpe.digests(read_table(spark, sf_dir, "documents"), public_tokenizers.path(TOKENIZER))


def op3_token_files(spark, sf_dir):
    folder = work_dir(spark, "token-files")
    return token_files.token_files(read_table(spark, sf_dir, "documents"), public_tokenizers.path(TOKENIZER), END_ID, folder)


def fold(folds: int, held: int):
    """Whether the document belongs to the fold that is held out."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % folds == held, F.lit(False))


def op4_language(spark, sf_dir):
    found = language.identify(read_table(spark, sf_dir, "documents"), ~fold(4, 2))
    return found.select("doc_id", fold(4, 2).alias("held_out"), "lang_pred", "score", "rejected")


def op5_exact_dedup(spark, sf_dir):
    return exact_dedup.exact_dedup(spark, f"{sf_dir}/documents.parquet").drop("file", "row")


def op6_secrets(spark, sf_dir):
    found = secrets.scan_secrets(read_table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_assign", "n_access", "n_hex", F.sha2(secrets.span_text(F.col("base_spans")), 256).alias("base_sha256"),
                        secrets.span_text(F.col("spans")).alias("spans"))


def op7_toxicity(spark, sf_dir):
    rated = toxicity.rate_toxicity(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"), ~fold(3, 1))
    return rated.select("doc_id", fold(3, 1).alias("held_out"), "score", "predicted")


def op8_line_dedup(spark, sf_dir):
    kept = line_dedup.line_dedup(read_table(spark, sf_dir, "documents"))
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2(F.col("kept_text").cast("binary"), 256).alias("kept_sha256"))


def op9_decontaminate(spark, sf_dir):
    found = decontaminate.decontaminate(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", F.size("items").cast("bigint").alias("n_items"),
                        F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"), "contaminated")


def op10_sharding(spark, sf_dir):
    return sharding.assign_shards(read_table(spark, sf_dir, "documents")).drop("linked_piece")


def op11_curriculum(spark, sf_dir):
    return curriculum.mix(read_table(spark, sf_dir, "documents"))


def op12_periodic_runs(spark, sf_dir):
    found = periodic_runs.periodic_runs(periodic_runs.with_planted_runs(read_table(spark, sf_dir, "documents")))
    best = F.col("strongest")
    listed = F.transform("runs", lambda r: F.concat(r["start"], F.lit(","), r["length"], F.lit(","), r["period"], F.lit("\n")))
    return found.select("doc_id", F.size("runs").cast("bigint").alias("n_runs"), best["start"].alias("start"), best["length"].alias("length"), best["period"].alias("period"),
                        F.expr("1000 * strongest.length div strongest.period").alias("exponent_milli"),
                        F.sha2(F.array_join(listed, "").cast("binary"), 256).alias("runs_sha256"), F.sha2(F.col("collapsed_text").cast("binary"), 256).alias("collapsed_sha256"))


def op13_merkle_manifest(spark, sf_dir):
    tampered = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0
    received = F.when(tampered, F.replace("text", F.lit("\n"), F.lit(""))).otherwise(F.col("text"))
    return merkle.manifest(read_table(spark, sf_dir, "documents"), received).drop("path")


QUERIES = {f.__name__: f for f in (op1_near_dedup, op2_bpe, op3_token_files, op4_language, op5_exact_dedup, op6_secrets, op7_toxicity, op8_line_dedup, op9_decontaminate,
                                   op10_sharding, op11_curriculum, op12_periodic_runs, op13_merkle_manifest)}

ORACLES = {
    "op1_near_dedup": r"""
        WITH RECURSIVE w AS (
            SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS words FROM documents),
        s AS (SELECT DISTINCT doc_id, CASE WHEN len(words) < 5 THEN words ELSE list_slice(words, k, k + 4) END AS sh
              FROM (SELECT doc_id, words, unnest(range(1, greatest(len(words) - 3, 2))) AS k FROM w WHERE len(words) > 0)),
        n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
        common AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS i FROM s x JOIN s y ON x.sh = y.sh AND x.doc_id <> y.doc_id GROUP BY ALL),
        links AS (SELECT a, b FROM common JOIN n p ON p.doc_id = a JOIN n q ON q.doc_id = b WHERE 100 * i >= 75 * (p.n + q.n - i)),
        reach(doc_id, other) AS (SELECT doc_id, doc_id FROM documents UNION SELECT r.doc_id, l.b FROM reach r JOIN links l ON r.other = l.a)
        SELECT d.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, r.c AS component_id, d.doc_id = r.c AS kept
        FROM documents d LEFT JOIN n USING (doc_id) JOIN (SELECT doc_id, min(other) AS c FROM reach GROUP BY doc_id) r USING (doc_id)""",
    "op5_exact_dedup": r"""
        WITH t AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS body FROM documents)
        SELECT doc_id, min(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size, doc_id = min(doc_id) OVER w AS kept, sha256(body) AS text_sha256
        FROM t WINDOW w AS (PARTITION BY body)""",
    "op8_line_dedup": r"""
        WITH lines AS (
            SELECT doc_id, generate_subscripts(parts, 1) AS pos, unnest(parts) AS line
            FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS parts FROM documents)),
        keyed AS (
            SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM lines),
        repeated AS (SELECT key, min(doc_id) AS first FROM keyed WHERE length(key) >= 10 GROUP BY key HAVING count(DISTINCT doc_id) > 1),
        judged AS (SELECT k.*, r.key IS NOT NULL AND doc_id > first AS gone FROM keyed k LEFT JOIN repeated r USING (key))
        SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
               sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '')) AS kept_sha256
        FROM judged GROUP BY doc_id""",
    "op9_decontaminate": r"""
        WITH w AS (
            SELECT 'd' AS side, doc_id::VARCHAR AS id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                   '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words FROM documents
            UNION ALL
            SELECT 'b', item_id::VARCHAR, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                   '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') FROM benchmark WHERE item_id IS NOT NULL),
        items AS (SELECT id, words, least(len(words), 13) AS size FROM w WHERE side = 'b' AND len(words) > 0),
        windows AS (SELECT DISTINCT id, size, list_slice(words, k, k + size - 1) AS win FROM (SELECT id, words, size, unnest(range(1, len(words) - size + 2)) AS k FROM items)),
        sizes AS (SELECT DISTINCT size FROM items),
        places AS (SELECT id, size, k, list_slice(words, k, k + size - 1) AS win
                   FROM (SELECT w.id, words, size, unnest(range(1, len(words) - size + 2)) AS k FROM w, sizes WHERE side = 'd' AND len(words) >= size)),
        met AS (SELECT p.id, p.size, k, v.id AS item FROM places p JOIN windows v ON p.size = v.size AND p.win = v.win),
        hit AS (SELECT id, count(DISTINCT pos) AS n_hit FROM (SELECT id, unnest(range(k, k + size)) AS pos FROM met) GROUP BY id),
        seen AS (SELECT id, count(DISTINCT item) AS n_items, string_agg(DISTINCT item, ',' ORDER BY item) AS list FROM met GROUP BY id)
        SELECT w.id::BIGINT AS doc_id, len(words)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
               sha256(coalesce(list, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(words) AS contaminated
        FROM w LEFT JOIN hit USING (id) LEFT JOIN seen USING (id) WHERE side = 'd'""",
    "op11_curriculum": r"""
        WITH d AS (SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
                          md5(coalesce(doc_id::VARCHAR, '-') || '|curriculum') AS drawn FROM documents),
        s AS (SELECT source, sum(size)::BIGINT AS source_size, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS source_no FROM d GROUP BY source),
        w AS (SELECT *, [3.0::DOUBLE, 1.0, 2.0][source_no % 3 + 1] AS weight, 2.0::DOUBLE * source_size AS lim FROM s),
        f AS (SELECT *, coalesce(sum(lim) OVER o, 0) AS full_, coalesce(sum(weight) OVER o, 0) AS gone, sum(lim) OVER () * 0.75::DOUBLE AS wanted, sum(weight) OVER () AS weights
              FROM w WINDOW o AS (ORDER BY lim / weight, source_no ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
        c AS (SELECT *, lim / weight <= (wanted - full_) / (weights - gone) AS limited FROM f),
        l AS (SELECT (max(wanted) - coalesce(sum(lim) FILTER (limited), 0)) / (max(weights) - coalesce(sum(weight) FILTER (limited), 0)) AS level FROM c),
        t AS (SELECT source, source_no, source_size, CASE WHEN limited THEN lim ELSE weight * level END AS target, weight FROM c, l),
        r AS (SELECT d.doc_id, d.size, t.*, row_number() OVER o AS place, coalesce(sum(size) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS bef
              FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source WINDOW o AS (PARTITION BY source_no ORDER BY drawn, d.doc_id, d.size)),
        v AS (SELECT *, k * source_size + bef AS frm, least(size, floor(target)::BIGINT - (k * source_size + bef)) AS words FROM r, (VALUES (0), (1)) AS z(k)),
        m AS (SELECT *, (frm + words / 2.0::DOUBLE) * weight / target AS a FROM v WHERE words > 0),
        p AS (SELECT *, CASE source_no % 3
                  WHEN 0 THEN least(1.0, 0.0 + 2.0 * a / (4.5 + sqrt(greatest(0.0, 20.25 + -6.0 * a))))
                  WHEN 1 THEN least(1.0, 0.0 + 2.0 * a / (0.5 + sqrt(greatest(0.0, 0.25 + 2.0 * a))))
                  ELSE CASE WHEN a <= 1.0 THEN least(0.5, 0.0 + 2.0 * a / (1.0 + sqrt(greatest(0.0, 1.0 + 8.0 * a))))
                            ELSE least(1.0, 0.5 + 2.0 * (a - 1.0) / (3.0 + sqrt(greatest(0.0, 9.0 + -8.0 * (a - 1.0))))) END END AS position FROM m),
        q AS (SELECT *, coalesce(sum(words) OVER (ORDER BY position, source_no, place, k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS start FROM p),
        g AS (SELECT source_no, place, sum(words)::BIGINT AS taken, count(*) AS visits, min(position) AS first_position, min(start) AS first_start FROM q GROUP BY ALL)
        SELECT doc_id, size, source_size, target, coalesce(taken, 0) AS taken, coalesce(visits, 0) AS visits, first_position, first_start
        FROM r LEFT JOIN g USING (source_no, place)""",
    "op12_periodic_runs": r"""
        WITH RECURSIVE crc0(i, k, c) AS (SELECT i::BIGINT, 0, i::BIGINT FROM range(256) t(i) UNION ALL
            SELECT i, k + 1, CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END FROM crc0 WHERE k < 8),
        crc1 AS (SELECT list(c ORDER BY i) AS tab FROM crc0 WHERE k = 8),
        docs AS (SELECT row_number() OVER () AS row, doc_id, doc_id::VARCHAR AS s, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents),
        crc2(row, s, k, c) AS (SELECT row, s, 0, 4294967295::BIGINT FROM docs WHERE s IS NOT NULL UNION ALL
            SELECT row, s, k + 1, xor(c >> 8, tab[xor(c & 255, ord(s[k + 1])) + 1]) FROM crc2, crc1 WHERE k < length(s)),
        h AS (SELECT row, xor(c, 4294967295) AS h FROM crc2 WHERE k = length(s)),
        plan AS (SELECT *, len(words)::BIGINT AS n, CASE WHEN h % 10 = 0 AND len(words) > 0 THEN (h // 10) % len(words) END AS a, h // 10 AS g FROM docs LEFT JOIN h USING (row)),
        cyc AS (SELECT *, 1 + (n - a) // (3 + g % 8) AS p FROM plan),
        pos AS (SELECT row, i, words[1 + CASE WHEN a IS NULL OR i < a THEN i ELSE a + (i - a) % p END] AS word FROM (SELECT *, unnest(range(0, n)) AS i FROM cyc)),
        text AS (SELECT row, list(word ORDER BY i) AS ws, count(*) AS n FROM pos GROUP BY row),
        gram AS (SELECT row, i, n, hash(list_slice(ws, i + 1, i + 16)) AS g FROM (SELECT *, unnest(range(0, n - 15)) AS i FROM text WHERE n >= 24)),
        lags AS (SELECT DISTINCT x.row, y.i - x.i AS q FROM gram x JOIN gram y ON x.row = y.row AND x.g = y.g AND y.i > x.i WHERE 3 * (y.i - x.i) <= x.n),
        eq AS (SELECT l.row, l.q, x.i, x.i - row_number() OVER (PARTITION BY l.row, l.q ORDER BY x.i) AS isle
               FROM lags l JOIN pos x ON x.row = l.row JOIN pos y ON y.row = l.row AND y.i = x.i + l.q AND y.word = x.word),
        long AS (SELECT row, min(i) AS start, count(*) + q AS length, q FROM eq GROUP BY row, q, isle HAVING count(*) + q >= greatest(24, 3 * q)),
        runs AS (SELECT row, start, length, min(q) AS period FROM long GROUP BY ALL),
        best AS (SELECT *, row_number() OVER (PARTITION BY row ORDER BY length / period DESC, start, period) AS nth FROM runs),
        told AS (SELECT row, count(*) AS n_runs, string_agg(start || ',' || length || ',' || period || chr(10), '' ORDER BY start, period) AS list FROM runs GROUP BY row),
        gone AS (SELECT DISTINCT row, unnest(range(start + period, start + length)) AS i FROM runs),
        kept AS (SELECT row, string_agg(word, ' ' ORDER BY i) AS body FROM pos ANTI JOIN gone USING (row, i) GROUP BY row)
        SELECT doc_id, coalesce(n_runs, 0) AS n_runs, start, length, period, 1000 * length // period AS exponent_milli,
               sha256(coalesce(list, '')) AS runs_sha256, sha256(coalesce(body, '')) AS collapsed_sha256
        FROM docs LEFT JOIN (SELECT * FROM best WHERE nth = 1) USING (row) LEFT JOIN told USING (row) LEFT JOIN kept USING (row)""",
    "op13_merkle_manifest": r"""
        WITH RECURSIVE crc0(i, k, c) AS (SELECT i::BIGINT, 0, i::BIGINT FROM range(256) t(i) UNION ALL
            SELECT i, k + 1, CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END FROM crc0 WHERE k < 8),
        crc1 AS (SELECT list(c ORDER BY i) AS tab FROM crc0 WHERE k = 8),
        docs AS (SELECT row_number() OVER () AS row, doc_id, source, lang, n_chars, text, doc_id::VARCHAR AS s FROM documents),
        crc2(row, s, k, c) AS (SELECT row, s, 0, 4294967295::BIGINT FROM docs WHERE s IS NOT NULL UNION ALL
            SELECT row, s, k + 1, xor(c >> 8, tab[xor(c & 255, ord(s[k + 1])) + 1]) FROM crc2, crc1 WHERE k < length(s)),
        odd AS (SELECT row, xor(c, 4294967295) % 2 = 0 AS tampered FROM crc2 WHERE k = length(s)),
        head AS (SELECT row, doc_id, source, text, coalesce(tampered, false) AS tampered,
                   coalesce(strlen(doc_id::VARCHAR) || ':' || doc_id, '-') || coalesce(strlen(source) || ':' || source, '-') || coalesce(strlen(lang) || ':' || lang, '-')
                   || coalesce(strlen(n_chars::VARCHAR) || ':' || n_chars, '-') AS h FROM docs LEFT JOIN odd USING (row)),
        leaf AS (SELECT row, doc_id, source, sha256(h || coalesce(strlen(text) || ':' || text, '-')) AS leaf,
                   CASE WHEN tampered THEN sha256(h || coalesce(strlen(replace(text, chr(10), '')) || ':' || replace(text, chr(10), ''), '-')) END AS back FROM head),
        tree AS (SELECT source, row_number() OVER (ORDER BY source NULLS FIRST) AS tree FROM (SELECT DISTINCT source FROM leaf)),
        placed AS (SELECT l.*, tree, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos, count(*) OVER (PARTITION BY tree) AS n
                   FROM leaf l JOIN tree t ON l.source IS NOT DISTINCT FROM t.source),
        low(tree, level, pos, n, node) AS (SELECT tree, 0, pos, n, leaf FROM placed UNION ALL
            SELECT tree, any_value(level) + 1, pos // 3, (any_value(n) + 2) // 3, sha256(string_agg(node, '' ORDER BY pos)) FROM low WHERE n > 1 GROUP BY tree, pos // 3),
        high(tree, level, pos, n, node) AS (SELECT 0, 0, tree - 1, count(*) OVER (), node FROM low WHERE n = 1 UNION ALL
            SELECT tree, any_value(level) + 1, pos // 3, (any_value(n) + 2) // 3, sha256(string_agg(node, '' ORDER BY pos)) FROM high WHERE n > 1 GROUP BY tree, pos // 3),
        nodes AS (SELECT * FROM low UNION ALL SELECT * FROM high),
        step AS (SELECT a.tree, a.level, a.pos, coalesce(string_agg(b.node, '' ORDER BY b.pos) FILTER (b.pos < a.pos), '') AS l, coalesce(string_agg(b.node, '' ORDER BY b.pos) FILTER (b.pos > a.pos), '') AS r
                 FROM nodes a JOIN nodes b ON a.tree = b.tree AND a.level = b.level AND a.pos // 3 = b.pos // 3 WHERE a.n > 1 GROUP BY ALL),
        deep AS (SELECT tree, max(level) AS deep FROM low GROUP BY tree),
        road AS (SELECT p.row, s.level AS lvl, l, r FROM placed p JOIN step s ON s.tree = p.tree AND s.pos = p.pos // (3 ** s.level)::BIGINT
                 UNION ALL SELECT p.row, deep + s.level, l, r FROM placed p JOIN deep USING (tree) JOIN step s ON s.tree = 0 AND s.pos = (p.tree - 1) // (3 ** s.level)::BIGINT),
        proof AS (SELECT row, string_agg(l || r, '' ORDER BY lvl) AS proof FROM road GROUP BY row),
        fold(row, lvl, x) AS (SELECT row, 0::BIGINT, coalesce(back, leaf) FROM placed UNION ALL SELECT f.row, f.lvl + 1, sha256(l || x || r) FROM fold f JOIN road USING (row, lvl)),
        ends AS (SELECT row, arg_max(x, lvl) AS folded_root FROM fold GROUP BY row),
        tops AS (SELECT tree, any_value(node) FILTER (n = 1) AS subroot FROM low GROUP BY tree)
        SELECT doc_id, leaf, subroot, root, sha256(coalesce(proof, '')) AS proof_sha256, folded_root, folded_root = root AS verified
        FROM placed JOIN tops USING (tree) JOIN ends USING (row) LEFT JOIN proof USING (row), (SELECT node AS root FROM high WHERE n = 1)""",
}
