"""The registered query of each operator, over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import collocations, langid, licenses, lines, media, mixing, ngram_join, packing, pfor, pieces, pivots, resample, substrings


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.pack(table(spark, sf_dir, "documents"))
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


def op2_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = substrings.remove_repeats(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))


def op3_token_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    read = pfor.round_trip(table(spark, sf_dir, "documents"))
    return read.select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").withColumn("held_out", F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(4)) == 2)
    model = langid.train(docs.filter(~F.col("held_out")))
    found = docs.select("doc_id", "held_out", langid.identify(F.col("text"), model).alias("found"))
    return found.select("doc_id", "held_out", F.col("found.lang").alias("lang_pred"), "found.score", F.size("found.spans").alias("n_spans"))


def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = lines.dedup_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", "n_lines", "n_removed", F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256"))


def op6_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.near_duplicates(table(spark, sf_dir, "documents"))


def op7_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"))


def op8_media(spark: SparkSession, sf_dir: str) -> DataFrame:
    content = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", content.alias("content"))
    media_table = media.measured(media.store(docs.select("content")))
    # Each document is a page: its lines are paragraphs, its payload a figure behind them.
    ref, caption = F.concat(F.lit("sha256:"), F.sha2("content", 256)), F.concat(F.lit("document "), F.coalesce(F.col("doc_id").cast("string"), F.lit("?")))
    page = media.page_of(F.col("text"), ref, F.lit("payload"), caption)
    pages = docs.select("doc_id", page.alias("html")).select("doc_id", media.interleave(F.col("html")).alias("sequence"))
    resolved = media.resolve(media.media_refs(pages, "doc_id"), media_table)
    return resolved.select("doc_id", "n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature", "position", "caption")


def op9_permutation_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pivots.search(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


def op10_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = table(spark, sf_dir, "documents").select("doc_id", licenses.scan_licenses(F.col("text")).alias("found"))
    return found.select("doc_id", F.size("found.sentences").cast("long").alias("n_sentences"), F.array_join("found.licenses.license", ";").alias("licenses"), F.size("found.licenses").cast("long").alias("n_licenses"))


def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(table(spark, sf_dir, "documents"))


def op12_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    drawn = resample.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return drawn.select("doc_id", "n_features", "weight", "score", "rank")


def op13_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded = table(spark, sf_dir, "documents").select("doc_id", pieces.encode(F.col("text")).alias("ids"))
    coded = coded.select("doc_id", "ids", pieces.decode(F.col("ids")).alias("decoded"))
    written_ids = F.array_join(F.transform("ids", lambda i: i.cast("string")), " ")
    return coded.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), F.sha2(written_ids, 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_packing": op1_packing,
    "op2_substring_dedup": op2_substring_dedup,
    "op3_token_ids": op3_token_ids,
    "op4_language_id": op4_language_id,
    "op5_line_dedup": op5_line_dedup,
    "op6_ngram_join": op6_ngram_join,
    "op7_source_mixing": op7_source_mixing,
    "op8_media": op8_media,
    "op9_permutation_search": op9_permutation_search,
    "op10_license_scan": op10_license_scan,
    "op11_collocations": op11_collocations,
    "op12_resampling": op12_resampling,
    "op13_sentencepiece": op13_sentencepiece,
}

_WORDS = r"regexp_extract_all({}, '[^\x20\x09-\x0D]+')"
_LOWER = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_FEATURE_WORDS = rf"regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

ORACLE_SQL: dict[str, str] = {
    "op11_collocations": f"""
WITH pieces AS (
    SELECT coalesce(lang, 'und') AS lang, regexp_extract_all(unnest(regexp_split_to_array({_LOWER}, '[.,;:!?\x0A-\x0D]')), '[^\x20\x09]+') AS w FROM documents
), grams AS (
    SELECT lang, k, array_to_string(w[i:i + k - 1], ' ') AS phrase
    FROM (SELECT lang, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM pieces, (SELECT unnest([1, 2, 3, 4, 5]) AS k) WHERE len(w) >= k)
), counts AS (
    SELECT lang, k, phrase, count(*) AS f FROM grams GROUP BY ALL HAVING count(*) >= 100
), totals AS (
    SELECT lang, CAST(sum(len(w)) AS BIGINT) AS n FROM pieces GROUP BY lang
), candidates AS (
    SELECT lang, k, phrase, f AS a, string_split(phrase, ' ') AS w FROM counts WHERE k >= 2
), inside AS (
    SELECT lang, array_to_string(w[i:i + m - 1], ' ') AS phrase, max(a) AS longer
    FROM (SELECT lang, w, a, m, unnest(range(1, k - m + 2)) AS i FROM candidates, (SELECT unnest([2, 3, 4]) AS m) WHERE m < k) GROUP BY ALL
), cuts AS (
    SELECT lang, phrase, w, k, a, unnest(range(1, k)) AS c FROM candidates
), scores AS (
    SELECT u.lang, u.phrase, u.a, x.f AS l, y.f AS r, t.n, CAST(CAST(1000 AS HUGEINT) * u.a * t.n // (CAST(x.f AS HUGEINT) * y.f) AS BIGINT) AS score
    FROM cuts u JOIN totals t ON t.lang = u.lang
    JOIN counts x ON x.lang = u.lang AND x.phrase = array_to_string(u.w[1:u.c], ' ') JOIN counts y ON y.lang = u.lang AND y.phrase = array_to_string(u.w[u.c + 1:u.k], ' ')
    QUALIFY row_number() OVER (PARTITION BY u.lang, u.phrase ORDER BY score, u.c) = 1
)
SELECT s.lang, row_number() OVER (PARTITION BY s.lang ORDER BY score DESC, a DESC, s.phrase) AS rank, s.phrase, a, l, r, n, score
FROM scores s LEFT JOIN inside i ON i.lang = s.lang AND i.phrase = s.phrase WHERE i.longer IS NULL OR 100 * i.longer < 100 * a
QUALIFY rank <= 2000
""",
    "op12_resampling": f"""
WITH crcs AS (
    SELECT list_transform(range(256), lambda b: list_reduce(range(8), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, b)) AS t
), words AS (
    SELECT TRUE AS own, doc_id, coalesce({_FEATURE_WORDS}, []) AS w FROM documents UNION ALL SELECT FALSE, item_id, coalesce({_FEATURE_WORDS}, []) FROM benchmark
), features AS (
    SELECT own, doc_id, unnest(w || list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) AS feature FROM words
), kinds AS (
    SELECT feature, xor(list_reduce(list_transform(regexp_extract_all(hex(encode(feature)), '..'), lambda h: CAST('0x' || h AS BIGINT)),
        lambda crc, byte: xor(crc >> 8, t[(xor(crc, byte) & 255) + 1]), 4294967295), 4294967295) % 10000 AS bucket FROM (SELECT DISTINCT feature FROM features), crcs
), placed AS (
    SELECT own, doc_id, bucket FROM features JOIN kinds USING (feature)
), sums AS (
    SELECT CAST(count(*) FILTER (WHERE own) AS DOUBLE) AS s, CAST(count(*) FILTER (WHERE NOT own) AS DOUBLE) AS t FROM placed
), gains AS (
    SELECT bucket, CAST(floor(1000 * ln((count(*) FILTER (WHERE NOT own) + 1.0::DOUBLE) * (s + 10000) / ((count(*) FILTER (WHERE own) + 1.0::DOUBLE) * (t + 10000)))) AS BIGINT) AS gain
    FROM placed, sums GROUP BY bucket, s, t
), weights AS (
    SELECT doc_id, count(*) AS n_features, CAST(floor(sum(gain) / CAST(count(*) AS DOUBLE)) AS BIGINT) AS weight FROM placed JOIN gains USING (bucket) WHERE own GROUP BY doc_id
), scores AS (
    SELECT doc_id, len(w) AS words, coalesce(n_features, 0) AS n_features, coalesce(weight, 0) AS weight,
           coalesce(weight, 0) + CAST(floor(-1000 * ln(-ln((CAST('0x' || left(sha256('7:' || doc_id), 8) AS BIGINT) + 0.5::DOUBLE) / 4294967296))) AS BIGINT) AS score
    FROM words LEFT JOIN weights USING (doc_id) WHERE own
), ranked AS (
    SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS rank FROM scores WHERE words >= 20 QUALIFY rank <= 25 * (SELECT count(*) FROM scores WHERE words >= 20) // 100
)
SELECT doc_id, n_features, weight, score, rank FROM scores LEFT JOIN ranked USING (doc_id)
""",
    "op2_substring_dedup": f"""
WITH docs AS (
    SELECT doc_id, coalesce({_WORDS.format("text")}, []) AS w FROM documents
), windows AS (
    SELECT doc_id, i, array_to_string(w[i:i + 49], ' ') AS k FROM (SELECT doc_id, w, unnest(range(1, len(w) - 48)) AS i FROM docs WHERE len(w) >= 50)
), firsts AS (
    SELECT k, min(doc_id) AS first FROM windows GROUP BY k
), late AS (
    SELECT doc_id, i FROM windows JOIN firsts USING (k) WHERE first < doc_id
), words AS (
    SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS i FROM docs
), marked AS (
    SELECT a.doc_id, a.word, a.i, max(CASE WHEN b.i IS NULL THEN 0 ELSE 1 END) OVER (PARTITION BY a.doc_id ORDER BY a.i ROWS BETWEEN 49 PRECEDING AND CURRENT ROW) AS gone
    FROM words a LEFT JOIN late b ON a.doc_id = b.doc_id AND a.i = b.i
), kept AS (
    SELECT doc_id, CAST(sum(gone) AS BIGINT) AS n_removed, string_agg(word, ' ' ORDER BY i) FILTER (WHERE gone = 0) AS kept FROM marked GROUP BY doc_id
)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, coalesce(k.n_removed, 0) AS n_removed, sha256(coalesce(k.kept, '')) AS kept_sha256
FROM docs d LEFT JOIN kept k ON d.doc_id = k.doc_id
""",
    "op6_ngram_join": f"""
WITH RECURSIVE docs AS (
    SELECT doc_id, coalesce({_WORDS.format(_LOWER)}, []) AS w FROM documents
), sets AS (
    SELECT DISTINCT doc_id, s FROM (
        SELECT doc_id, unnest(CASE WHEN len(w) < 5 THEN [array_to_string(w, ' ')] ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) END) AS s
        FROM docs WHERE len(w) > 0)
), sizes AS (
    SELECT doc_id, count(*) AS n FROM sets GROUP BY doc_id
), pairs AS (
    SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM sets a JOIN sets b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY 1, 2
), links AS (
    SELECT x, y FROM pairs JOIN sizes a ON a.doc_id = x JOIN sizes b ON b.doc_id = y WHERE 100 * c >= 80 * (a.n + b.n - c)
), edges AS (
    SELECT x, y FROM links UNION ALL SELECT y, x FROM links
), reached(doc_id, other) AS (
    SELECT doc_id, doc_id FROM documents
    UNION
    SELECT r.doc_id, e.y FROM reached r JOIN edges e ON r.other = e.x
)
SELECT d.doc_id, coalesce(max(s.n), 0) AS n_shingles, min(r.other) AS component_id
FROM documents d JOIN reached r ON r.doc_id = d.doc_id LEFT JOIN sizes s ON s.doc_id = d.doc_id GROUP BY d.doc_id
""",
    "op8_media": r"""
WITH docs AS (
    SELECT doc_id, text, encode(coalesce(text, '')) AS content FROM documents
), padded AS (
    SELECT *, octet_length(content) AS n, content || repeat('\xFF'::BLOB, CASE WHEN octet_length(content) = 0 THEN 576 ELSE (576 - octet_length(content) % 576) % 576 END) AS payload FROM docs
), stored AS (
    SELECT *, octet_length(payload) AS size, hex(payload) AS digits,
           encode('P5' || chr(10) || '# ' || n || ' bytes' || chr(10) || '24 ' || octet_length(payload) // 24 || chr(10) || '255' || chr(10)) || payload AS media FROM padded
), counts AS (
    SELECT doc_id, byte, count(*) AS c FROM (SELECT doc_id, CAST('0x' || unnest(regexp_extract_all(digits, '..')) AS BIGINT) AS byte FROM stored) GROUP BY ALL
), shares AS (
    SELECT doc_id, byte // 32 AS part, sum(c) AS c FROM counts GROUP BY ALL
), measures AS (
    SELECT doc_id, CAST(sum(c * byte) AS DOUBLE) AS total, CAST(sum(c * byte * byte) AS DOUBLE) AS squares, sum(c) AS n FROM counts GROUP BY doc_id
), histograms AS (
    SELECT m.doc_id, string_agg(printf('%.4f', coalesce(s.c, 0) / CAST(m.n AS DOUBLE)), ',' ORDER BY p.part) AS hist
    FROM measures m CROSS JOIN (SELECT unnest(range(8)) AS part) p LEFT JOIN shares s ON s.doc_id = m.doc_id AND s.part = p.part GROUP BY m.doc_id
)
SELECT d.doc_id, n_bytes, payload_bytes, payload_sha256, tail_crc32, media_bytes, media_sha256,
       'mean=' || printf('%.4f', total / m.n) || ';sd=' || printf('%.4f', sqrt(squares / m.n - (total / m.n) * (total / m.n))) || ';hist=' || hist AS feature, position, caption
FROM (
    SELECT doc_id, CAST(n AS BIGINT) AS n_bytes, CAST(size AS BIGINT) AS payload_bytes, sha256(payload) AS payload_sha256, CAST(octet_length(media) AS BIGINT) AS media_bytes, sha256(media) AS media_sha256,
           xor(list_reduce(list_transform(regexp_extract_all(right(digits, 64), '..'), lambda h: CAST('0x' || h AS BIGINT)),
               lambda crc, byte: list_reduce(range(8), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, xor(crc, byte)), 4294967295), 4294967295) AS tail_crc32,
           CAST(len(list_filter(string_split(coalesce(text, ''), chr(10)), lambda l: regexp_matches(l, '[^\x09-\x0D\x1C-\x20\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]'))) AS INTEGER) AS position,
           'document ' || doc_id AS caption
    FROM stored) d JOIN measures m ON m.doc_id = d.doc_id JOIN histograms h ON h.doc_id = d.doc_id
""",
    "op5_line_dedup": """
WITH lines AS (
    SELECT doc_id, text, string_split(text, chr(10)) AS l FROM documents
), windows AS (
    SELECT doc_id, i AS place, l[i] || chr(10) || l[i + 1] || chr(10) || l[i + 2] AS w
    FROM (SELECT doc_id, l, unnest(range(1, len(l) - 1)) AS i FROM lines WHERE len(l) >= 3)
), ranked AS (
    SELECT doc_id, place, row_number() OVER (PARTITION BY w ORDER BY doc_id, place) AS n
    FROM windows WHERE length(trim(translate(w, chr(10) || chr(9) || chr(13) || chr(11) || chr(12), ''))) > 0
), gone AS (
    SELECT DISTINCT doc_id, place + k AS line FROM ranked, (SELECT unnest([0, 1, 2]) AS k) WHERE n > 1
), kept AS (
    SELECT a.doc_id, string_agg(a.line, chr(10) ORDER BY a.i) AS text, count(*) AS n
    FROM (SELECT doc_id, unnest(l) AS line, unnest(range(1, len(l) + 1)) AS i FROM lines) a
    ANTI JOIN gone g ON a.doc_id = g.doc_id AND a.i = g.line
    GROUP BY a.doc_id
)
SELECT d.doc_id, CAST(coalesce(len(d.l), 0) AS BIGINT) AS n_lines,
       CAST(coalesce(len(d.l), 0) - coalesce(k.n, 0) AS BIGINT) AS n_removed,
       CASE WHEN d.text IS NULL THEN NULL ELSE sha256(coalesce(k.text, '')) END AS kept_sha256
FROM lines d LEFT JOIN kept k ON d.doc_id = k.doc_id
""",
}


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(ORACLE_SQL)
