"""The registered queries of this package, each over the whole of its table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from hourloom.llm import alignment, contamination, language_id, licenses, line_rules, mixing, ngram_join, packing, pii, repeats, sharding, spelling, url_filters
from hourloom.llm.common import table


def op1_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licences of every document by rare words and their positions."""
    return licenses.scan(table(spark, sf_dir, "documents")).drop("places")


def op2_line_frequency(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality counts and verdict of every document; lines common on its source don't count as its own."""
    return line_rules.rules(table(spark, sf_dir, "documents"))


def op3_pii_votes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data of every document."""
    return pii.digest(pii.detect(table(spark, sf_dir, "documents")))


def op4_template_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item, be it with other parameters, or a passage of it, and the item."""
    return contamination.report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), passages=True)


def op5_lpt_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sixteen shards of nearly equal bytes; equal texts stay together."""
    return sharding.shards(table(spark, sf_dir, "documents"))


def op6_dp_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Windows of 1024 tokens cut by dynamic programming."""
    import public_tokenizers

    return packing.pack(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("byte_bpe_50k.tiktoken"))


def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document."""
    return language_id.identify(table(spark, sf_dir, "documents"))


def op8_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of documents whose sets of four-word shingles have a Jaccard similarity of 0.85."""
    return ngram_join.classes(table(spark, sf_dir, "documents"))


def op9_repeat_removal(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is left of every document without strings of 100 bytes that stand earlier too."""
    return repeats.strip(table(spark, sf_dir, "documents"))


def op10_filter_cascade(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rule and verdict of every page's url; hosts named like advertising are listed."""
    return url_filters.judge(table(spark, sf_dir, "pages"))


def op11_systematic_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a mix of the sources by weight takes of every document."""
    return mixing.report(table(spark, sf_dir, "documents"))


def op12_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How the tokens of two vocabularies stand against each other in every document."""
    import public_tokenizers

    return alignment.align(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model"))


def op13_spelling_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of the documents, those one edit away from them, and the form they are variants of."""
    return spelling.group(table(spark, sf_dir, "documents"))


QUERIES = {
    f.__name__: f
    for f in (
        op1_license_scan,
        op2_line_frequency,
        op3_pii_votes,
        op4_template_windows,
        op5_lpt_shards,
        op6_dp_packing,
        op7_language_id,
        op8_ngram_join,
        op9_repeat_removal,
        op10_filter_cascade,
        op11_systematic_mix,
        op12_token_alignment,
        op13_spelling_groups,
    )
}

ORACLES: dict[str, str] = {
    "op10_filter_cascade": rf"""
WITH parts AS (
    SELECT page_id, translate(regexp_extract(coalesce(url, ''), '://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
        regexp_extract(coalesce(url, ''), '://[^/?#]*([^?#]*)', 1) AS path
    FROM pages
), ruled AS (
    SELECT *, CASE
        WHEN (host = 'example.net' OR ends_with(host, '.example.net')) AND starts_with(path, '/en/') THEN 'example.net/en/'
        WHEN (host = 'example.com' OR ends_with(host, '.example.com')) AND starts_with(path, '/de/') THEN 'example.com/de/'
        WHEN (host = 'org' OR ends_with(host, '.org')) AND starts_with(path, '/fr/') THEN 'org/fr/'
        WHEN (host = 'net' OR ends_with(host, '.net')) AND starts_with(path, '/') THEN 'net/' END AS rule
    FROM parts
)
SELECT page_id, host, path, rule, CASE
    WHEN rule IN ('example.net/en/', 'org/fr/') THEN 'allow' WHEN rule IS NOT NULL THEN 'block'
    WHEN regexp_matches(host, '{url_filters.ADVERTISING}') THEN 'block' ELSE 'allow' END AS verdict
FROM ruled
""",
    "op8_ngram_join": r"""
WITH RECURSIVE cut AS (
    SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS words
    FROM documents
), shingles AS (
    SELECT DISTINCT doc_id, unnest(CASE WHEN len(words) = 0 THEN [] WHEN len(words) < 4 THEN [array_to_string(words, ' ')]
        ELSE list_transform(range(1, len(words) - 2), lambda i: array_to_string(words[i:i + 3], ' ')) END) AS shingle FROM cut
), sizes AS (
    SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id
), common AS (
    SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM shingles a JOIN shingles b ON a.shingle = b.shingle AND a.doc_id < b.doc_id GROUP BY 1, 2
), links AS (
    SELECT a, b FROM common JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b WHERE 100 * c >= 85 * (x.n + y.n - c)
), reached(doc_id, other) AS (
    SELECT doc_id, doc_id FROM sizes
    UNION
    SELECT r.doc_id, l.other FROM reached r JOIN (SELECT a AS doc_id, b AS other FROM links UNION ALL SELECT b, a FROM links) l ON r.other = l.doc_id
)
SELECT d.doc_id, CAST(coalesce(s.n, 0) AS BIGINT) AS n_shingles, coalesce(c.least, d.doc_id) AS component_id
FROM documents d LEFT JOIN sizes s ON s.doc_id = d.doc_id LEFT JOIN (SELECT doc_id, min(other) AS least FROM reached GROUP BY doc_id) c ON c.doc_id = d.doc_id
""",
    "op11_systematic_mix": r"""
WITH sized AS (
    SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size,
        ('0x' || substr(md5('7:' || coalesce(CAST(doc_id AS VARCHAR), '') || ':' || coalesce(text, '')), 1, 15))::BIGINT AS h
    FROM documents
), sources AS (
    SELECT source, CAST(sum(size) AS BIGINT) AS source_size, [1.0, 2.0, 3.0][CAST((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS INT)] AS weight
    FROM sized GROUP BY source
), levels AS (  -- the level if all sources that come to their limit before this one are held there
    SELECT *, 3.0 * source_size / weight AS own,
        (sum(source_size) OVER () - coalesce(sum(3 * source_size) OVER before, 0)) / (sum(weight) OVER () - coalesce(sum(weight) OVER before, 0))::DOUBLE AS level
    FROM sources WINDOW before AS (ORDER BY 3.0 * source_size / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), shares AS (
    SELECT source, source_size, least(3.0 * source_size, weight * (SELECT min_by(level, own) FROM levels WHERE level <= own))::DOUBLE AS target,
        ('0x' || substr(md5('7:' || coalesce(source, '')), 1, 15))::BIGINT % 16777216 AS start
    FROM sources
), parts AS (
    SELECT *, CASE WHEN source_size > 0 THEN CAST(least(50331648, floor(target / source_size * 16777216 + 0.5)) AS BIGINT) ELSE 0 END AS part FROM shares
), summed AS (
    SELECT s.doc_id, s.size, p.source_size, p.target, p.part,
        CAST(p.start + p.part * row_number() OVER (PARTITION BY s.source ORDER BY s.size, s.h) AS BIGINT) AS upto
    FROM sized s JOIN parts p ON s.source IS NOT DISTINCT FROM p.source
)
SELECT doc_id, CAST(size AS BIGINT) AS size, source_size, target, CAST(size * (upto // 16777216 - (upto - part) // 16777216) AS BIGINT) AS taken FROM summed
""",
    "op13_spelling_groups": r"""
WITH RECURSIVE eight(i, k, v) AS (
    SELECT i, 0, i FROM range(256) t(i)
    UNION ALL
    SELECT i, k + 1, CASE WHEN v % 2 = 1 THEN xor(v >> 1, 3988292384) ELSE v >> 1 END FROM eight WHERE k < 8
), crc_table AS (
    SELECT i, v FROM eight WHERE k = 8
), runs AS (
    SELECT doc_id, translate(unnest(regexp_extract_all(coalesce(text, ''), '[A-Za-z\x{C0}-\x{FF}]{7,}')), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run
    FROM documents
), kinds AS (
    SELECT row_number() OVER () AS kind, run, count(*) AS times, hex(encode(coalesce(CAST(doc_id AS VARCHAR), '') || ':' || run)) AS raw FROM runs GROUP BY doc_id, run
), bytes(kind, spot, c) AS (
    SELECT kind, 0::BIGINT, 4294967295::BIGINT FROM kinds
    UNION ALL
    SELECT b.kind, b.spot + 1, xor(b.c >> 8, t.v)
    FROM bytes b JOIN kinds k ON b.kind = k.kind AND 2 * b.spot < length(k.raw) JOIN crc_table t ON t.i = xor(b.c & 255, ('0x' || substr(k.raw, 2 * b.spot + 1, 2))::BIGINT)
), hashed AS (
    SELECT k.run, k.times, xor(b.c, 4294967295) AS h FROM kinds k JOIN bytes b ON b.kind = k.kind AND 2 * b.spot = length(k.raw)
), words AS (
    SELECT CASE WHEN h % 31 = 0 THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word, CAST(sum(times) AS BIGINT) AS n
    FROM hashed GROUP BY 1 HAVING length(word) >= 7 AND n >= 2
), cut AS (
    SELECT word, n, i, substr(word, 1, i - 1) || substr(word, i + 1) AS rest FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM words)
), near AS (
    SELECT a.word, b.word AS other, b.n AS other_n FROM cut a JOIN cut b ON a.i = b.i AND a.rest = b.rest AND a.word <> b.word
    UNION
    SELECT a.word, b.word, b.n FROM cut a JOIN words b ON a.rest = b.word
    UNION
    SELECT b.word, a.word, a.n FROM cut a JOIN words b ON a.rest = b.word
), best AS (
    SELECT word, other, other_n, count(*) OVER (PARTITION BY word) AS n_near FROM near QUALIFY row_number() OVER (PARTITION BY word ORDER BY other_n DESC, other) = 1
), formed AS (
    SELECT w.word, w.n, coalesce(b.n_near, 0) AS n_near, CASE WHEN b.other_n >= 10 * w.n THEN b.other END AS form, CASE WHEN b.other_n >= 10 * w.n THEN b.other_n END AS form_n
    FROM words w LEFT JOIN best b ON w.word = b.word
), chains(word, spot, step) AS (
    SELECT word, word, 0 FROM formed
    UNION ALL
    SELECT c.word, f.form, c.step + 1 FROM chains c JOIN formed f ON c.spot = f.word WHERE f.form IS NOT NULL
)
SELECT f.word, f.form, r.root, f.n, f.n_near, f.form_n FROM formed f JOIN (SELECT word, max_by(spot, step) AS root FROM chains GROUP BY word) r ON f.word = r.word
""",
}
