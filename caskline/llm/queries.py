"""The operators applied to whole tables, and the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from caskline.llm.bpe import load_ranks, round_trip
from caskline.llm.common import lean_workers, table
from caskline.llm.decontaminate import benchmark_leaks
from caskline.llm.html import extract_articles
from caskline.llm.jaccard import near_duplicates
from caskline.llm.language import language_predictions
from caskline.llm.licenses import scan_licenses
from caskline.llm.mixing import balanced_mix
from caskline.llm.quality import quality_verdicts
from caskline.llm.search import build_index, search
from caskline.llm.suffixes import remove_repeats
from caskline.llm.urls import filter_as_of, url_keys
from caskline.llm.variants import spelling_variants
from caskline.llm.warc import archive_pages


def op1_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return balanced_mix(table(spark, sf_dir, "documents"))


def op2_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_articles(table(spark, sf_dir, "pages"))


def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_verdicts(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op4_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = archive_pages(table(spark, sf_dir, "pages"))
    return records.select(F.col("id").alias("page_id"), "payload_bytes", "payload_digest", "record_type", "refers_to")


def _digit_groups(text: Column, start: int) -> Column:
    """Four hexadecimal digits of a text's MD5 as a number."""
    return F.conv(F.substring(F.md5(text), start, 4), 16, 10).cast("int")


def _captures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pages, each with a fetch date between 2020 and 2023 that follows from its URL."""
    day = (_digit_groups(F.col("url"), 1) % 1400).cast("int")
    return table(spark, sf_dir, "pages").select("page_id", "url", F.date_add(F.lit("2020-01-01").cast("date"), day).alias("fetched"))


def _list_entries(captures: DataFrame) -> DataFrame:
    """A blocklist's history for every key of the pages: listed, later taken off, later listed again."""
    key = F.col("key")
    first = F.date_add(F.lit("2019-06-01").cast("date"), _digit_groups(key, 1) % 900)
    second = F.date_add(first, 1 + _digit_groups(key, 5) % 300)
    third = F.date_add(second, 1 + _digit_groups(key, 9) % 600)
    pick = lambda start: F.when(_digit_groups(key, start) % 3 == 0, "block").otherwise("allow")
    keys = captures.select(F.explode(F.transform(url_keys(F.col("url")), lambda x: x["key"])).alias("key")).distinct()
    dated = F.array(
        F.struct(first.alias("since"), pick(13).alias("verdict")),
        F.struct(second.alias("since"), F.lit("remove").alias("verdict")),
        F.struct(third.alias("since"), pick(17).alias("verdict")),
    )
    return keys.select("key", F.inline(dated))


def op5_url_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    captures = _captures(spark, sf_dir)
    return filter_as_of(captures, _list_entries(captures))


def op6_leaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return benchmark_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op7_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = remove_repeats(table(spark, sf_dir, "documents"))
    return cut.select("row.doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def op8_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_predictions(table(spark, sf_dir, "documents"))


def op9_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_licenses(table(spark, sf_dir, "documents"))


def op10_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents")).drop("row_key", "class_key")


def op11_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    lean_workers(spark)
    return search(build_index(table(spark, sf_dir, "documents")), table(spark, sf_dir, "benchmark"))


def op12_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling_variants(table(spark, sf_dir, "documents"))


def op13_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    ranks = load_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    return round_trip(table(spark, sf_dir, "documents"), ranks, public_tokenizers.PATTERN)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_mix": op1_mix,
    "op2_extract": op2_extract,
    "op3_quality": op3_quality,
    "op4_warc": op4_warc,
    "op5_url_lists": op5_url_lists,
    "op6_leaks": op6_leaks,
    "op7_suffix_dedup": op7_suffix_dedup,
    "op8_language": op8_language,
    "op9_licenses": op9_licenses,
    "op10_near_duplicates": op10_near_duplicates,
    "op11_search": op11_search,
    "op12_variants": op12_variants,
    "op13_bpe": op13_bpe,
}

#: Base32 of a SHA-1 in groups of 20 bits: five hexadecimal digits are four letters.
_BASE32 = " || ".join(
    f"substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', "
    f"(((('0x' || substr(sha1, {k}, 5))::BIGINT >> {shift}) & 31) + 1)::INT, 1)"
    for k in range(1, 41, 5)
    for shift in (15, 10, 5, 0)
)

SQL: dict[str, str] = {
    "op4_warc": f"""
        WITH p AS (SELECT page_id, coalesce(html, '') AS payload, sha1(coalesce(html, '')) AS sha1 FROM pages),
        w AS (SELECT *, max(page_id) OVER (PARTITION BY sha1) AS top FROM p)
        SELECT page_id, octet_length(encode(payload))::BIGINT AS payload_bytes, {_BASE32} AS payload_digest,
               CASE WHEN page_id = top THEN 'response' ELSE 'revisit' END AS record_type,
               CASE WHEN page_id <> top THEN top END AS refers_to
        FROM w""",
    "op5_url_lists": """
        WITH c AS (
            SELECT page_id, url, DATE '2020-01-01' + (('0x' || substr(md5(url), 1, 4))::BIGINT % 1400)::INT AS fetched,
                   lower(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^:/?#]+)', 1)) AS host,
                   regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*/([^/?#]+)', 1) AS segment
            FROM pages),
        l AS (SELECT *, string_split(host, '.') AS labels FROM c WHERE host <> ''),
        k AS (
            SELECT page_id, url, fetched, 'h:' || host AS key, 1000 AS rank FROM l
            UNION ALL SELECT page_id, url, fetched, 'p:' || host || '/' || segment, 2000 FROM l
            UNION ALL SELECT page_id, url, fetched, 'd:' || array_to_string(labels[i:len(labels)], '.'), len(labels) - i + 1
            FROM (SELECT *, unnest(range(1, len(labels) + 1)) AS i FROM l)),
        h AS (
            SELECT key, DATE '2019-06-01' + (('0x' || substr(md5(key), 1, 4))::BIGINT % 900)::INT AS first,
                   (1 + ('0x' || substr(md5(key), 5, 4))::BIGINT % 300)::INT AS gap1,
                   (1 + ('0x' || substr(md5(key), 9, 4))::BIGINT % 600)::INT AS gap2,
                   CASE WHEN ('0x' || substr(md5(key), 13, 4))::BIGINT % 3 = 0 THEN 'block' ELSE 'allow' END AS v1,
                   CASE WHEN ('0x' || substr(md5(key), 17, 4))::BIGINT % 3 = 0 THEN 'block' ELSE 'allow' END AS v2
            FROM (SELECT DISTINCT key FROM k)),
        i AS (
            SELECT key, v1 AS verdict, first AS valid_from, first + gap1 AS valid_to FROM h
            UNION ALL SELECT key, v2, first + gap1 + gap2, NULL FROM h),
        a AS (
            SELECT k.page_id, k.key, i.verdict, i.valid_from,
                   row_number() OVER (PARTITION BY k.page_id ORDER BY k.rank DESC, k.key DESC) AS n
            FROM k JOIN i ON k.key = i.key AND k.fetched >= i.valid_from AND (i.valid_to IS NULL OR k.fetched < i.valid_to))
        SELECT c.page_id, c.url, c.fetched, a.verdict, a.key AS matched_key, a.valid_from AS listed_on,
               coalesce(a.verdict, 'allow') <> 'block' AS kept
        FROM c LEFT JOIN a ON c.page_id = a.page_id AND a.n = 1""",
    "op11_search": """
        WITH d AS (
            SELECT doc_id, term, count(*) AS tf FROM (
                SELECT doc_id, unnest(regexp_extract_all(
                    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                    '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) AS term
                FROM documents)
            GROUP BY doc_id, term),
        q AS (
            SELECT item_id, term, count(*) AS often FROM (
                SELECT item_id, unnest(regexp_extract_all(
                    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                    '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) AS term
                FROM benchmark)
            GROUP BY item_id, term),
        n AS (SELECT doc_id, sum(tf)::BIGINT AS n FROM d GROUP BY doc_id),
        s AS (SELECT count(*)::BIGINT AS docs, sum(n)::BIGINT AS terms FROM n),
        m AS (SELECT doc_id, 75 + (25 * n * docs) // terms AS m FROM n, s),
        w AS (
            SELECT term, floor(1000 * ln((2 * docs + 2)::DOUBLE / (2 * count(*) + 1)))::BIGINT AS w
            FROM d, s GROUP BY term, docs),
        r AS (
            SELECT item_id, doc_id, sum(often * w * ((1000000000 * tf) // (1000 * tf + 12 * m)))::BIGINT AS score
            FROM q JOIN d USING (term) JOIN w USING (term) JOIN m USING (doc_id)
            GROUP BY item_id, doc_id)
        SELECT item_id, rank, doc_id, score FROM (
            SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INT AS rank FROM r WHERE score > 0)
        WHERE rank <= 20""",
    "op12_variants": """
        WITH RECURSIVE c AS (
            SELECT list(code ORDER BY i) AS codes FROM (
                SELECT i, list_reduce([i::BIGINT, 1, 2, 3, 4, 5, 6, 7, 8],
                    lambda x, k: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384::BIGINT) ELSE x >> 1 END) AS code
                FROM range(256) AS r(i))),
        t AS (
            SELECT doc_id, run, count(*) AS n FROM (
                SELECT doc_id, unnest(regexp_extract_all(
                    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[A-Za-z\\x{C0}-\\x{FF}]+')) AS run
                FROM documents)
            GROUP BY doc_id, run),
        h AS (
            SELECT run, n, hex(encode(coalesce(doc_id::VARCHAR, 'null') || ':' || run)) AS bytes FROM t),
        s AS (
            SELECT run, n, xor(4294967295::BIGINT, list_reduce(
                list_prepend(4294967295::BIGINT, list_transform(range(1, length(bytes), 2), lambda k: ('0x' || substr(bytes, k, 2))::BIGINT)),
                lambda x, b: xor(x >> 8, codes[(xor(x, b) & 255) + 1]))) AS h
            FROM h, c),
        w AS (
            SELECT word, sum(n)::BIGINT AS n FROM (
                SELECT n, CASE WHEN h % 97 = 0
                    THEN substr(run, 1, (h % length(run))::INT) || substr(run, (h % length(run))::INT + 2) ELSE run END AS word
                FROM s)
            WHERE length(word) >= 5 GROUP BY word HAVING sum(n) >= 3),
        d AS (SELECT word, n, i, substr(word, 1, i - 1) || substr(word, i + 1) AS less
              FROM (SELECT word, n, unnest(range(1, length(word) + 1))::INT AS i FROM w)),
        p AS (
            SELECT DISTINCT word, near, near_n FROM (
                SELECT a.word, b.word AS near, b.n AS near_n FROM d AS a JOIN d AS b ON a.i = b.i AND a.less = b.less AND a.word <> b.word
                UNION ALL SELECT d.word, w.word, w.n FROM d JOIN w ON d.less = w.word
                UNION ALL SELECT w.word, d.word, d.n FROM d JOIN w ON d.less = w.word)),
        b AS (
            SELECT word, near, near_n, row_number() OVER (PARTITION BY word ORDER BY near_n DESC, encode(near)) AS place,
                   count(*) OVER (PARTITION BY word) AS n_near
            FROM p),
        f AS (
            SELECT w.word, w.n, coalesce(n_near, 0)::BIGINT AS n_near,
                   CASE WHEN near_n >= 2 * w.n THEN near END AS form, CASE WHEN near_n >= 2 * w.n THEN near_n END AS form_n
            FROM w LEFT JOIN b ON w.word = b.word AND b.place = 1),
        r AS (
            SELECT word, word AS root, form AS next FROM f
            UNION ALL SELECT r.word, f.word, f.form FROM r JOIN f ON r.next = f.word)
        SELECT f.word, f.form, r.root, f.n, f.n_near, f.form_n FROM f JOIN r ON f.word = r.word AND r.next IS NULL""",
}
