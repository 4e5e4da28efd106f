"""The registered query of each operator, over whole tables, and SQL where it has the words."""

from __future__ import annotations

import inspect
import sys
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderlake.llm import (
    decontam,
    fingerprint,
    huffman,
    kneserney,
    merkle,
    neardup,
    packing,
    pii,
    simhash,
    spelling,
    toxicity,
    urlfilter,
    wacz,
)
from orderlake.llm.common import crc_mod, table


def op1_fingerprints(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents")
    return fingerprint.compared_in_order(docs, fingerprint.ranks_of(fingerprint.entropy_counts(docs)))


def op2_packing(spark: SparkSession, d: str) -> DataFrame:
    return packing.packed_documents(table(spark, d, "documents"))


def op3_decontamination(spark: SparkSession, d: str) -> DataFrame:
    return decontam.contained_items(table(spark, d, "documents"), table(spark, d, "benchmark"))


def op4_toxicity(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents")
    model = toxicity.train(docs, table(spark, d, "labels"))
    return toxicity.scored(docs, model).select(
        "doc_id",
        (crc_mod(F.col("doc_id"), 5) == 0).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )


def op5_kneser_ney(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents")
    model = kneserney.train(docs.where(~kneserney.held_out()), order=3)
    scores = kneserney.scored(docs, model)
    return scores.select("doc_id", kneserney.held_out().alias("held_out"), *scores.columns[1:])


def op6_near_duplicates(spark: SparkSession, d: str) -> DataFrame:
    return neardup.near_duplicates(table(spark, d, "documents"), words=2)


# Captures and list changes that the pages' own ids and hosts determine. A host's md5
# says whether a list names it, and on which days of the year it was added and removed.
DAY = "cast(date_add(DATE'2024-01-01', cast({n} as int)) as date)"
HEX = "(instr('0123456789abcdef', substr(md5({x}), {at}, 1)) - 1)"


def captures(pages: DataFrame) -> DataFrame:
    """Pages with a day of 2024 on which each was fetched."""
    return pages.select("page_id", "url", F.expr(DAY.format(n="page_id % 360")).alias("fetched_at"))


def list_changes(pages: DataFrame) -> DataFrame:
    """Dated changes of four lists about the hosts and URLs of the pages."""
    hosts = pages.select(urlfilter.host_of(F.col("url")).alias("host")).where("host <> ''").distinct()
    digit = lambda at, x="host": HEX.format(x=x, at=at)
    day = lambda n: F.expr(DAY.format(n=n))

    def change(rows: DataFrame, name: str, policy: str, key, action: str, at: str) -> DataFrame:
        return rows.select(
            F.lit(name).alias("list_name"), F.lit(policy).alias("policy"), key.alias("key"),
            F.lit(action).alias("action"), day(at).alias("at"),
        )

    host_key = F.concat(F.lit("domain:"), F.col("host"))
    parent = F.concat(F.lit("domain:"), F.regexp_extract("host", r"([^.]+\.[^.]+\.[^.]+)$", 1))
    spam = hosts.where(f"{digit(1)} < 5")
    adult = hosts.where(f"{digit(2)} < 3 and host rlike '[.].*[.]'")
    trusted = hosts.where(f"{digit(3)} < 2")
    urls = pages.select(F.regexp_replace("url", "#.*$", "").alias("page")).dropna().distinct()
    taken_down = urls.where(f"{digit(1, 'page')} < 1")
    return (
        change(spam, "spam", "block", host_key, "add", f"{digit(4)} * 12")
        .union(change(spam, "spam", "block", host_key, "remove", f"{digit(4)} * 12 + {digit(5)} * 10 + 20"))
        .union(change(spam.where(f"{digit(6)} < 8"), "spam", "block", host_key, "add", f"{digit(4)} * 12 + {digit(5)} * 10 + 60"))
        .union(change(adult, "adult", "block", parent, "add", f"{digit(7)} * 20"))
        .union(change(trusted, "trusted", "allow", host_key, "add", "100"))
        .union(change(trusted, "trusted", "allow", host_key, "remove", "250"))
        .union(change(taken_down, "takedown", "block", F.concat(F.lit("url:"), F.col("page")), "add", f"{digit(2, 'page')} * 22"))
    )


def op7_url_filters(spark: SparkSession, d: str) -> DataFrame:
    pages = table(spark, d, "pages")
    return urlfilter.judged(captures(pages), list_changes(pages))


def op8_web_archives(spark: SparkSession, d: str) -> DataFrame:
    return wacz.round_trip(table(spark, d, "pages")).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"
    )


def op9_huffman_ids(spark: SparkSession, d: str) -> DataFrame:
    read = huffman.round_trip(table(spark, d, "documents"))
    return read.select(
        "doc_id", "start", F.expr("octet_length(ids) div 4").alias("n_tokens"), F.crc32("ids").alias("ids_crc32")
    )


def op10_personal_data(spark: SparkSession, d: str) -> DataFrame:
    found = pii.personal_data(table(spark, d, "documents"))
    count = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")
    told = lambda spans: F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ","
    )
    plain = F.filter("spans", lambda s: s["plain"])
    return found.select(
        "doc_id",
        *(count(k).alias(f"n_{k}") for k in pii.KINDS),
        F.sha2(told(plain), 256).alias("base_sha256"),
        told(F.col("spans")).alias("spans"),
    )


def op11_simhash(spark: SparkSession, d: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, d, "documents"), words=3)


def op12_spelling(spark: SparkSession, d: str) -> DataFrame:
    return spelling.spelling_variants(table(spark, d, "documents"), slips=199)


def op13_merkle(spark: SparkSession, d: str) -> DataFrame:
    tampered = F.when(crc_mod(F.col("doc_id"), 2) == 0, F.replace("text", F.lit("\n"), F.lit("")))
    docs = table(spark, d, "documents")
    return merkle.checked(merkle.build(docs, found={"text": tampered.otherwise(F.col("text"))}))


def pipeline(spark: SparkSession, d: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, d)


def registered() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    module = sys.modules[__name__]
    named = inspect.getmembers(module, inspect.isfunction)
    found = {name: f for name, f in named if name.startswith("op") and name[2].isdigit()}
    return {**found, "pipeline": pipeline}


_SQL_DAY = "(DATE '2024-01-01' + CAST({n} AS INTEGER))"
_SQL_HEX = "(instr('0123456789abcdef', substr(md5({x}), {at}, 1)) - 1)"


def _url_filter_sql() -> str:
    digit = lambda at, x="host": _SQL_HEX.format(x=x, at=at)
    day = lambda n: _SQL_DAY.format(n=n)
    host = r"rtrim(regexp_extract(lower(url), '^[a-z][a-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:@]+)', 1), '.')"
    spam = f"hosts WHERE {digit(1)} < 5"
    return f"""
WITH hosts AS (SELECT DISTINCT {host} AS host FROM pages WHERE {host} <> ''),
urls AS (SELECT DISTINCT regexp_replace(url, '#.*$', '') AS page FROM pages WHERE url IS NOT NULL),
changes AS (
  SELECT 'spam' AS list_name, 'block' AS policy, 'domain:' || host AS key, 1 AS turn, {day(f"{digit(4)} * 12")} AS day FROM {spam}
  UNION ALL SELECT 'spam', 'block', 'domain:' || host, 0, {day(f"{digit(4)} * 12 + {digit(5)} * 10 + 20")} FROM {spam}
  UNION ALL SELECT 'spam', 'block', 'domain:' || host, 1, {day(f"{digit(4)} * 12 + {digit(5)} * 10 + 60")} FROM {spam} AND {digit(6)} < 8
  UNION ALL SELECT 'adult', 'block', 'domain:' || regexp_extract(host, '([^.]+\\.[^.]+\\.[^.]+)$', 1), 1, {day(f"{digit(7)} * 20")}
    FROM hosts WHERE {digit(2)} < 3 AND regexp_matches(host, '[.].*[.]')
  UNION ALL SELECT 'trusted', 'allow', 'domain:' || host, 1, {day("100")} FROM hosts WHERE {digit(3)} < 2
  UNION ALL SELECT 'trusted', 'allow', 'domain:' || host, 0, {day("250")} FROM hosts WHERE {digit(3)} < 2
  UNION ALL SELECT 'takedown', 'block', 'url:' || page, 1, {day(f"{digit(2, 'page')} * 22")} FROM urls WHERE {digit(1, 'page')} < 1
),
dated AS (SELECT list_name, policy, key, day, max(turn) AS turn FROM changes GROUP BY ALL),
fetched AS (
  SELECT row_number() OVER () AS r, page_id, url, {day("page_id % 360")} AS fetched_at, string_split({host}, '.') AS labels, {host} AS host
  FROM pages
),
keyed AS (
  SELECT r, fetched_at, 'url:' || regexp_replace(url, '#.*$', '') AS key FROM fetched
  UNION SELECT r, fetched_at, 'domain:' || array_to_string(labels[i:], '.')
    FROM (SELECT *, unnest(range(1, len(labels) + 1)) AS i FROM fetched WHERE host <> '')
),
latest AS (
  SELECT k.r, c.list_name, c.policy, c.key, arg_max(c.turn, c.day) AS turn
  FROM keyed k JOIN dated c ON k.key = c.key AND c.day <= k.fetched_at GROUP BY ALL
),
valid AS (
  SELECT r, count(*) FILTER (policy = 'block') AS n_block, count(*) FILTER (policy = 'allow') AS n_allow,
    array_to_string(list_sort(list(DISTINCT list_name) FILTER (policy = 'block')), ',') AS lists
  FROM latest WHERE turn = 1 GROUP BY r
)
SELECT page_id, url, fetched_at, coalesce(n_block, 0) AS n_block, coalesce(n_allow, 0) AS n_allow,
  coalesce(lists, '') AS lists, coalesce(n_block > 0 AND n_allow = 0, false) AS blocked
FROM fetched LEFT JOIN valid USING (r)"""


def _merkle_sql() -> str:
    field = lambda c: f"coalesce(octet_length(encode({c})) || ':' || {c}, '-')"
    leaf = lambda text: "sha256(" + " || ".join(
        field(c) for c in ("CAST(doc_id AS VARCHAR)", "source", "lang", "CAST(n_chars AS VARCHAR)", text)
    ) + ")"
    # crc32 bit by bit: each byte of the decimal id comes before seven zeros.
    feed = "xor(c, b)"
    crc = f"""xor(list_reduce(list_prepend(4294967295::BIGINT, flatten(list_transform(
        range(1, length(doc_id::VARCHAR) + 1),
        lambda i: [unicode(substr(doc_id::VARCHAR, i, 1))::BIGINT, 0, 0, 0, 0, 0, 0, 0]))),
        lambda c, b: xor({feed} >> 1, ({feed} & 1) * 3988292384)), 4294967295)"""
    levels = lambda name, nodes: f"""{name}(key, level, place, h, size) AS (  -- all nodes of the trees of all keys
  {nodes}
  UNION ALL
  SELECT key, level + 1, place // 3, sha256(string_agg(h, '' ORDER BY place)), (any_value(size) + 2) // 3
  FROM {name} WHERE size > 1 GROUP BY key, level, place // 3
)"""  # noqa: E731
    # A path's siblings by level, and the digest that the claimed leaf gives up to that level.
    climb = lambda name, nodes, start: f"""{name}(doc_id, key, level, place, h, path) AS (
  {start}
  UNION ALL
  SELECT w.doc_id, w.key, w.level + 1, w.place // 3,
    sha256(string_agg(CASE WHEN n.place = w.place THEN w.h ELSE n.h END, '' ORDER BY n.place)),
    w.path || coalesce(string_agg(n.h, '' ORDER BY n.place) FILTER (n.place <> w.place), '')
  FROM {name} w JOIN {nodes} n ON n.key = w.key AND n.level = w.level AND n.place // 3 = w.place // 3 AND n.size > 1
  GROUP BY w.doc_id, w.key, w.level, w.place, w.h, w.path
)"""  # noqa: E731
    return f"""
WITH RECURSIVE leaves AS (
  SELECT doc_id, coalesce('+' || source, '') AS key, {leaf("text")} AS leaf,
    {leaf("CASE WHEN " + crc + " % 2 = 0 THEN replace(text, chr(10), '') ELSE text END")} AS claimed,
    row_number() OVER (PARTITION BY source ORDER BY doc_id) - 1 AS place, count(*) OVER (PARTITION BY source) AS size
  FROM documents
),
{levels("nodes", "SELECT key, 0, place, leaf, size FROM leaves")},
subroots AS (
  SELECT key, h AS subroot, row_number() OVER (ORDER BY encode(key)) - 1 AS place, count(*) OVER () AS size
  FROM nodes WHERE size = 1
),
{levels("tops", "SELECT '', 0, place, subroot, size FROM subroots")},
{climb("climbed", "nodes", "SELECT doc_id, key, 0, place, claimed, '' FROM leaves")},
at_subroot AS (
  SELECT c.doc_id, s.place, c.h, c.path, s.subroot FROM subroots s JOIN
  (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY level DESC) AS r FROM climbed) c ON c.key = s.key WHERE r = 1
),
{climb("crossed", "tops", "SELECT doc_id, '', 0, place, h, path FROM at_subroot")},
at_root AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY level DESC) AS r FROM crossed)
SELECT doc_id, leaf, subroot, t.h AS root, sha256(a.path) AS proof_sha256, a.h AS folded_root, a.h = t.h AS verified
FROM leaves JOIN at_subroot USING (doc_id) JOIN at_root a USING (doc_id), (SELECT h FROM tops WHERE size = 1) t
WHERE a.r = 1"""


def statements() -> dict[str, str]:
    """DuckDB SQL of the operators that it can express."""
    return {"op7_url_filters": _url_filter_sql(), "op13_merkle": _merkle_sql()}
