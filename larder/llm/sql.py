"""The same results as SQL for DuckDB, where SQL can express them.

The archives' round trip is defined by the pages alone; resampling, the filter audit and
the licence scan are counts, sums and joins. The other operators learn from the whole
corpus, train models, hash with a seed that SQL lacks, or walk a graph; their queries are
tested against brute force, exact round trips and held-out rows in tests/llm.
"""

from __future__ import annotations

from larder.llm import license_scan
from larder.llm.warc import BASE32

# Four base-32 digits for every five hex digits of the SHA-1.
DIGITS = " || ".join(
    f"substr('{BASE32}', ((part{i} // {32 ** (3 - j)}) % 32) + 1, 1)" for i in range(8) for j in range(4)
)
PARTS = ", ".join(f"CAST('0x' || substr(digest, {5 * i + 1}, 5) AS INT) AS part{i}" for i in range(8))


def _uuid(name: str) -> str:
    cut = ", ".join(f"substr({name}, {at}, {n})" for at, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12)))
    return f"'<urn:uuid:' || concat_ws('-', {cut}) || '>'"


WARC = f"""
WITH rows AS (
  SELECT page_id, url, octet_length(encode(coalesce(html, ''))) AS payload_bytes, sha1(coalesce(html, '')) AS digest
  FROM pages),
ranked AS (
  SELECT *, rank() OVER (PARTITION BY digest, payload_bytes ORDER BY page_id DESC NULLS LAST, url DESC NULLS LAST) AS place,
         max(page_id) OVER (PARTITION BY digest, payload_bytes) AS best,
         md5(concat_ws(chr(10), 'capture', coalesce(CAST(page_id AS VARCHAR), chr(13)), coalesce(url, chr(13)), digest)) AS name,
         {PARTS}
  FROM rows)
SELECT page_id, url, CAST(payload_bytes AS BIGINT) AS payload_bytes, {DIGITS} AS payload_digest,
       CASE WHEN place = 1 THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN place > 1 THEN best END AS refers_to, {_uuid('name')} AS record_id
FROM ranked"""


UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
WORDS = (
    f"list_filter(regexp_split_to_array(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), "
    r"'[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '')"
)


def _crc_table() -> list[int]:
    """What eight steps of the reflected polynomial make of each byte."""
    table = []
    for value in range(256):
        for _ in range(8):
            value = (value >> 1) ^ (0xEDB88320 if value & 1 else 0)
        table.append(value)
    return table


RESAMPLING = f"""
WITH texts AS (
  SELECT 's' AS side, row_number() OVER () AS uid, doc_id, {WORDS} AS w FROM documents
  UNION ALL SELECT 't', row_number() OVER (), NULL, {WORDS} FROM benchmark),
features AS (
  SELECT side, uid, array_to_string(w[i:i + n - 1], ' ') AS f
  FROM (SELECT side, uid, w, n, unnest(range(1, len(w) + 2 - n)) AS i FROM texts, range(1, 4) r(n) WHERE len(w) >= n)),
known AS (
  SELECT f, xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(range(0, octet_length(encode(f))),
    lambda k: CAST('0x' || substr(hex(encode(f)), 2 * k + 1, 2) AS BIGINT))),
    lambda c, b: xor(c >> 8, ({_crc_table()})[(xor(c, b) & 255) + 1])), 4294967295) % 10000 AS bucket
  FROM (SELECT DISTINCT f FROM features)),
counts AS (
  SELECT bucket, count_if(side = 's')::DOUBLE AS s, count_if(side = 't')::DOUBLE AS t FROM features JOIN known USING (f) GROUP BY bucket),
totals AS (SELECT coalesce(sum(s), 0) + 10000 AS s_all, coalesce(sum(t), 0) + 10000 AS t_all FROM counts),
gains AS (SELECT bucket, floor(1000 * ln((t + 1) * s_all / ((s + 1) * t_all)))::BIGINT AS gain FROM counts, totals),
weights AS (SELECT uid, sum(gain) AS weight FROM features JOIN known USING (f) JOIN gains USING (bucket) WHERE side = 's' GROUP BY uid),
scored AS (
  SELECT doc_id, len(w) AS n, coalesce(weight, 0)::BIGINT AS weight, floor(-1000 * ln(-ln(
    (CAST('0x' || substr(sha256('42:' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 8) AS BIGINT) + 0.5::DOUBLE)
    / 4294967296.0::DOUBLE)))::BIGINT AS noise
  FROM texts LEFT JOIN weights USING (uid) WHERE side = 's'),
placed AS (
  SELECT *, n >= 20 AS fits, row_number() OVER (
    PARTITION BY n >= 20 ORDER BY weight + noise DESC, doc_id ASC NULLS LAST, weight DESC, n DESC) AS place
  FROM scored)
SELECT doc_id, (n + greatest(n - 1, 0) + greatest(n - 2, 0))::BIGINT AS n_features, weight, weight + noise AS score,
  CASE WHEN fits AND place <= (SELECT 5 * count(*) // 100 FROM scored WHERE n >= 20) THEN place END AS rank
FROM placed"""


AUDIT = r"""
WITH d AS (
  SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t,
    list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda w: w <> '') AS w
  FROM documents),
l AS (
  SELECT doc_id, max(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS good, max(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS toxic
  FROM labels GROUP BY doc_id),
m AS (
  SELECT part, coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic,
    (len(w) < 100)::INT + 2 * (100 * len(list_distinct(w)) < 80 * len(w))::INT
    + 4 * (100 * len(regexp_extract_all(t, '[A-Z]')) > 10 * length(t))::INT
    + 8 * regexp_matches(t, '[#$%&*|]')::INT
    + 16 * coalesce(min(d.doc_id) OVER (PARTITION BY t) < d.doc_id, false)::INT AS mask
  FROM d LEFT JOIN l USING (doc_id)),
n AS (SELECT part, mask, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM m GROUP BY ALL),
f AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS f),
o AS (
  SELECT a.f || b.f || c.f || d.f || e.f AS filter_order FROM f a, f b, f c, f d, f e
  WHERE len(list_distinct([a.f, b.f, c.f, d.f, e.f])) = 5),
s AS (
  SELECT filter_order, step::INT AS step, 1 << (ascii(filter_order[step]) - 65) AS bit,
    coalesce(list_sum([1 << (ascii(filter_order[k]) - 65) FOR k IN range(1, step)]), 0)::INT AS before
  FROM o, range(1, 6) r(step)),
r AS (
  SELECT part, filter_order, step, bit,
    sum(CASE WHEN mask & (bit | before) = 0 THEN n ELSE 0 END)::BIGINT AS kept,
    sum(CASE WHEN mask & bit > 0 AND mask & before = 0 THEN n ELSE 0 END)::BIGINT AS removed,
    sum(CASE WHEN mask & bit > 0 AND mask & before > 0 THEN n ELSE 0 END)::BIGINT AS redundant,
    sum(CASE WHEN mask = bit THEN n ELSE 0 END)::BIGINT AS unique_fails,
    sum(CASE WHEN mask & bit > 0 AND mask & before = 0 THEN good ELSE 0 END)::BIGINT AS good_lost,
    sum(CASE WHEN mask & bit > 0 AND mask & before = 0 THEN toxic ELSE 0 END)::BIGINT AS toxic_lost
  FROM n, s GROUP BY part, filter_order, step, bit)
SELECT * EXCLUDE (bit), (sum(removed) OVER (PARTITION BY part, bit))::BIGINT AS shapley FROM r"""


def _places(phrase: str) -> str:
    words = " AND ".join(f"w[i + {k}] = '{w}'" for k, w in enumerate(phrase.split(), start=1))
    return f"[i FOR i IN range(0, len(w)) IF {words}]"


def licenses() -> str:
    """The licence scan, with runs of words as text instead of hashes."""
    run, phrases = license_scan.RUN, license_scan.PHRASES
    runs = ", ".join(
        f"({i}, '{label}', {license_scan.words_asked(passage)}, {at}, '{' '.join(words)}')"
        for i, (label, passage) in enumerate(license_scan.TEMPLATES) for at, words in license_scan.voting_runs(passage))
    places = ", ".join(f"{_places(p)} AS p{i}" for i, p in enumerate(phrases))
    every = "list_concat(list_concat(p0, p1), p2)"
    base = "list_filter([" + ", ".join(
        f"CASE WHEN len(p{i}) > 0 THEN '{label}' END" for i, label in enumerate(phrases.values())) + "], lambda x: x IS NOT NULL)"
    return f"""
WITH runs(template, label, asked, pos, gram) AS (VALUES {runs}),
d AS (SELECT row_number() OVER () AS uid, doc_id, {WORDS} AS w FROM documents),
rolled AS (SELECT uid, place, array_to_string(w[place + 1:place + {run}], ' ') AS gram
  FROM (SELECT uid, w, unnest(range(0, len(w) - {run - 1})) AS place FROM d)),
hits AS (SELECT uid, template, label, asked, place - pos AS diagonal, pos FROM rolled JOIN runs USING (gram)),
steps AS (SELECT *, CASE WHEN diagonal - lag(diagonal) OVER (PARTITION BY uid, template ORDER BY diagonal) <= {license_scan.APART}
  THEN 0 ELSE 1 END AS is_new FROM (SELECT DISTINCT uid, template, diagonal FROM hits)),
islands AS (SELECT *, sum(is_new) OVER (PARTITION BY uid, template ORDER BY diagonal) AS island FROM steps),
covered AS (SELECT uid, label, asked, template, island, count(DISTINCT k)::DOUBLE / asked AS share
  FROM (SELECT hits.*, island, unnest(range(pos, pos + {run})) AS k FROM hits JOIN islands USING (uid, template, diagonal))
  GROUP BY uid, label, asked, template, island),
voted AS (SELECT uid, max(share) AS share, list(DISTINCT label) FILTER (
  share >= CASE WHEN asked <= {license_scan.SHORT_NOTICE} THEN 1.0 ELSE {license_scan.LONG_SHARE}::DOUBLE END) AS own FROM covered GROUP BY uid),
based AS (SELECT *, {every} AS every, list_sort({base}) AS base FROM (SELECT uid, doc_id, w, {places} FROM d))
SELECT doc_id, len(w)::BIGINT AS n_words, len(every)::BIGINT AS n_base, list_min(every)::BIGINT AS first_word,
  list_max(every)::BIGINT AS last_word, coalesce(array_to_string(base, ','), '') AS base_labels,
  coalesce(array_to_string(list_sort(list_distinct(list_concat(base, coalesce(own, [])))), ','), '') AS labels,
  CASE WHEN len(base) > 0 THEN 1.0::DOUBLE ELSE coalesce(share, 0.0::DOUBLE) END AS score
FROM based LEFT JOIN voted USING (uid)"""


def oracle_sql() -> dict[str, str]:
    return {
        "op8_warc": WARC, "op11_importance_resampling": RESAMPLING, "op12_filter_interactions": AUDIT,
        "op13_license_scans": licenses(),
    }
