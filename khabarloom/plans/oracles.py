"""SQL for the core queries, written independently of the operators."""

from __future__ import annotations

_URL = r"""
parts AS (
  SELECT ordinal, source_id, trim(url) AS u,
    lower(regexp_extract(trim(url), '^(?:([^:/?#]+):)?(?://([^/?#]*))?([^?#]*)(?:\?([^#]*))?', 1)) AS scheme,
    lower(regexp_extract(trim(url), '^(?:([^:/?#]+):)?(?://([^/?#]*))?([^?#]*)(?:\?([^#]*))?', 2)) AS host,
    regexp_extract(trim(url), '^(?:([^:/?#]+):)?(?://([^/?#]*))?([^?#]*)(?:\?([^#]*))?', 3) AS path,
    regexp_extract(trim(url), '^(?:([^:/?#]+):)?(?://([^/?#]*))?([^?#]*)(?:\?([^#]*))?', 4) AS query
  FROM raw_items
), pairs AS (
  SELECT *, list_filter(list_transform(list_filter(string_split(query, '&'), lambda p: p <> ''),
      lambda p: {'k': url_decode(replace(split_part(p, '=', 1), '+', ' ')), 'v': url_decode(replace(CASE WHEN contains(p, '=') THEN p[strpos(p, '=') + 1:] ELSE '' END, '+', ' '))}),
      lambda p: NOT (starts_with(lower(p.k), 'utm_') OR starts_with(lower(p.k), 'pk_') OR starts_with(lower(p.k), 'mc_')
        OR lower(p.k) IN ('fbclid', 'gclid', 'igshid', 'ref', 'ref_src', 'share', 'amp'))) AS kept
  FROM parts
), canon AS (
  SELECT ordinal, source_id,
    CASE scheme WHEN '' THEN '' WHEN 'http' THEN 'https:' ELSE scheme || ':' END
    || CASE WHEN host = '' AND NOT contains(u, '//') THEN '' ELSE '//' || regexp_replace(host, '^www\.', '') END
    || CASE WHEN length(path) > 1 THEN rtrim(path, '/') ELSE path END
    || CASE WHEN len(kept) = 0 THEN '' ELSE '?' || array_to_string(list_transform(kept, lambda p: replace(url_encode(p.k), '%20', '+') || '=' || replace(url_encode(p.v), '%20', '+')), '&') END AS url
  FROM pairs
)"""

_CLEAN = r"trim(regexp_replace(nfc_normalize(replace({0}, '&hellip;', '…')), '[ \t\x{{00A0}}\x{{200B}}\x{{200C}}\x{{200D}}]+', ' ', 'g'), ' ' || chr(10))"

_STREAK = """
islands AS (
  SELECT *, sum(CASE WHEN ok THEN 1 ELSE 0 END) OVER (PARTITION BY source_id ORDER BY started_at, id ROWS UNBOUNDED PRECEDING) AS island FROM fetch_log
), streaks AS (
  SELECT *, CAST(sum(CASE WHEN ok THEN 0 ELSE 1 END) OVER (PARTITION BY source_id, island ORDER BY started_at, id ROWS UNBOUNDED PRECEDING) AS INTEGER) AS streak FROM islands
), waits AS (
  SELECT s.*, CASE o.priority WHEN 1 THEN 15 WHEN 2 THEN 30 WHEN 3 THEN 60 ELSE 360 END AS minutes FROM streaks s JOIN sources o ON o.id = s.source_id
), nexts AS (
  SELECT *, CAST(CASE WHEN streak > 0 THEN least(minutes * pow(2, streak), 360) ELSE minutes END AS INTEGER) AS backoff FROM waits
)"""

_GREEDY = """
ordered AS (SELECT article_id, simhash, row_number() OVER (ORDER BY article_id) AS rn FROM {0} WHERE simhash <> 0),
walk AS (
  SELECT 0::BIGINT AS rn, NULL::BIGINT AS article_id, true AS kept, []::BIGINT[] AS held
  UNION ALL
  SELECT o.rn, o.article_id, len(list_filter(w.held, lambda x: bit_count(xor(x, o.simhash)) <= 8)) = 0,
    CASE WHEN len(list_filter(w.held, lambda x: bit_count(xor(x, o.simhash)) <= 8)) = 0 THEN list_append(w.held, o.simhash) ELSE w.held END
  FROM walk w JOIN ordered o ON o.rn = w.rn + 1
)"""

_TOKENS = r"regexp_extract_all(lower(title || ' ' || CASE WHEN body = '' THEN summary ELSE body END), '[\p{L}\p{N}_\x{0900}-\x{097F}]+')"
_RUNS = "CASE WHEN len(t) >= 3 THEN list_transform(range(1, len(t) - 1), lambda i: array_to_string(t[i:i + 2], ' ')) WHEN len(t) > 0 THEN [array_to_string(t, ' ')] ELSE [] END"

_BLANK = r"[\s\v\x{1C}-\x{1F}\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]+"

_STATE = """
  WITH last AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY source_id ORDER BY started_at DESC, id DESC) AS r FROM fetch_log) WHERE r = 1),
  good AS (SELECT source_id, started_at AS at, id AS i FROM (SELECT *, row_number() OVER (PARTITION BY source_id ORDER BY started_at DESC, id DESC) AS r FROM fetch_log WHERE ok) WHERE r = 1),
  since AS (SELECT f.source_id, count(*) AS n FROM fetch_log f LEFT JOIN good g USING (source_id) WHERE g.i IS NULL OR f.started_at > g.at OR (f.started_at = g.at AND f.id > g.i) GROUP BY 1),
  tags AS (SELECT source_id, i FROM (SELECT source_id, id AS i, row_number() OVER (PARTITION BY source_id ORDER BY started_at DESC, id DESC) AS r FROM fetch_log WHERE ok AND NOT not_modified) WHERE r = 1),
  fails AS (
    SELECT l.source_id, CAST(CASE WHEN l.ok THEN 0 WHEN g.i IS NULL THEN coalesce(s.consecutive_failures, 0) + n.n ELSE n.n END AS INTEGER) AS fails
    FROM last l LEFT JOIN good g USING (source_id) JOIN since n USING (source_id) LEFT JOIN source_state s ON s.id = l.source_id
    UNION ALL SELECT l.source_id, 0 FROM last l WHERE l.source_id NOT IN (SELECT source_id FROM since)
  ), waits AS (
    SELECT f.source_id, fails, CASE WHEN fails > 0 THEN least(minutes * pow(2, fails), 360) ELSE minutes END AS wait
    FROM fails f JOIN (SELECT id, CASE priority WHEN 1 THEN 15 WHEN 2 THEN 30 WHEN 3 THEN 60 ELSE 360 END AS minutes FROM sources) o ON o.id = f.source_id
  )
  SELECT s.id, coalesce('"' || t.i || '"', s.etag) AS etag, s.last_modified, coalesce(epoch_us(l.started_at), epoch_us(s.last_run_at)) // 1000000 AS last_run_at_s,
    CASE WHEN l.id IS NULL THEN epoch_us(s.next_run_at) // 1000000 ELSE epoch_us(l.started_at) // 1000000 + CAST(60 * w.wait AS BIGINT) END AS next_run_at_s,
    CASE WHEN l.id IS NULL THEN s.consecutive_failures ELSE w.fails END AS consecutive_failures,
    CASE WHEN l.id IS NULL THEN s.last_error WHEN NOT l.ok THEN substr(l.error, 1, 2000) END AS last_error
  FROM source_state s LEFT JOIN last l ON l.source_id = s.id LEFT JOIN waits w ON w.source_id = s.id LEFT JOIN tags t ON t.source_id = s.id"""

_DATES = r"""
WITH items AS (
  SELECT i.ordinal, i.fetched_at, z.zone,
    trim(regexp_replace(regexp_replace(regexp_replace(translate(i.published, '०१२३४५६७८९', '0123456789'), '(?i)\b(mon|tue|wed|thu|fri|sat|sun)(day|sday|nesday|rsday|urday)?,', ' '),
      '(आइत|सोम|मंगल|मङ्गल|बुध|बिहि|बिही|शुक्र|शनि)(बार|वार)', ' ', 'g'), '[\s,]+', ' ', 'g')) AS t
  FROM raw_items i LEFT JOIN source_zones z USING (source_id)
), split AS (
  SELECT *, regexp_extract(t, '^([^ :T]+(?: ?[^ :T0-9]+)?(?: [^ :]+)*?)(?:[T ]+\d{1,2}:|$)', 1) AS d,
    regexp_extract(t, '(\d{1,2}):(\d{2})(?::(\d{2})(?:\.\d+)?)? ?([aApP][mM])? ?([A-Za-z]{1,5}|[+-]\d{2}:?\d{2})?$', ['h', 'mi', 's', 'ap', 'z']) AS c,
    regexp_matches(t, '^\d{10}(\d{3})?$') AS epoch
  FROM items
), dated AS (
  SELECT *, lower(trim(regexp_extract(d, '([^\d ./-]+)', 1))) AS name,
    CASE WHEN regexp_matches(d, '^\d{4}[-/]\d{2}[-/]\d{2}$') THEN [d[1:4], d[6:7], d[9:10]]
      WHEN regexp_matches(d, '^\d{1,2} ?[^\d ]+ \d{4}$') THEN [regexp_extract(d, '(\d{4})$', 1), '0', regexp_extract(d, '^(\d{1,2})', 1)]
      WHEN regexp_matches(d, '^[^\d ]+ ?\d{1,2} \d{4}$') THEN [regexp_extract(d, '(\d{4})$', 1), '0', regexp_extract(d, '^[^\d]+(\d{1,2})', 1)]
      WHEN regexp_matches(d, '^\d{4} ?[^\d ]+ \d{1,2}$') THEN [d[1:4], '0', regexp_extract(d, '(\d{1,2})$', 1)] END AS p
  FROM split
), named AS (
  SELECT *, CAST(p[1] AS INTEGER) AS y, CAST(p[3] AS INTEGER) AS day,
    CASE WHEN name = '' THEN NULL WHEN regexp_matches(name, '^(बैशाख|वैशाख|bai|vai)') THEN 1 WHEN regexp_matches(name, '^(जेठ|जेष्ठ|ज्येष्ठ|jes|jet|jye)') THEN 2
      WHEN regexp_matches(name, '^(असार|आषाढ|अषाढ|asar|ash?ad)') THEN 3 WHEN regexp_matches(name, '^(साउन|श्रावण|सावन|shr|sau|saw)') THEN 4 WHEN regexp_matches(name, '^(भदौ|भाद्र|bha)') THEN 5
      WHEN regexp_matches(name, '^(असोज|आश्विन|अश्विन|ash?oj|ash?w)') THEN 6 WHEN regexp_matches(name, '^(कात्तिक|कार्तिक|kar|kat)') THEN 7 WHEN regexp_matches(name, '^(मंसिर|मङ्सिर|मार्ग|man)') THEN 8
      WHEN regexp_matches(name, '^(पुस|पुष|पौष|pus|pou|pau)') THEN 9 WHEN regexp_matches(name, '^(माघ|mag)') THEN 10 WHEN regexp_matches(name, '^(फागुन|फाल्गुन|pha|fal|fag)') THEN 11
      WHEN regexp_matches(name, '^(चैत|chai)') THEN 12 END AS bs_name,
    list_position(['jan', 'feb', 'mar', 'apr', 'may', 'jun', 'jul', 'aug', 'sep', 'oct', 'nov', 'dec'], name[1:3]) AS month_name
  FROM dated
), days AS (
  SELECT n.*, n.bs_name IS NOT NULL OR (n.name = '' AND n.y > 2060) AS bs,
    CASE WHEN n.bs_name IS NOT NULL OR (n.name = '' AND n.y > 2060) THEN CASE WHEN n.day BETWEEN 1 AND b.days THEN CAST(b.first_day AS DATE) + (n.day - 1) END
      WHEN n.name = '' THEN TRY_CAST(p[1] || '-' || p[2] || '-' || p[3] AS DATE)
      ELSE TRY_CAST(p[1] || '-' || lpad(CAST(n.month_name AS VARCHAR), 2, '0') || '-' || lpad(p[3], 2, '0') AS DATE) END AS g
  FROM named n LEFT JOIN bs_months b ON b.bs_year = n.y AND b.bs_month = coalesce(n.bs_name, CASE WHEN n.name = '' THEN CAST(p[2] AS INTEGER) END)
), clocks AS (
  SELECT *, coalesce(TRY_CAST(nullif(c.h, '') AS INTEGER), 0) AS h0, coalesce(TRY_CAST(nullif(c.mi, '') AS INTEGER), 0) AS mi, coalesce(TRY_CAST(nullif(c.s, '') AS INTEGER), 0) AS s,
    lower(c.ap) AS ap, upper(c.z) AS zn, (c.h = '' AND d <> t) AS odd FROM days
), local AS (
  SELECT *, CASE WHEN g IS NULL OR odd OR mi > 59 OR s > 59 OR h0 > 23 OR (ap <> '' AND h0 NOT BETWEEN 1 AND 12) THEN NULL
    ELSE CAST(g AS TIMESTAMP) + to_seconds((CASE WHEN ap = '' THEN h0 ELSE h0 % 12 + CASE WHEN ap = 'pm' THEN 12 ELSE 0 END END) * 3600 + mi * 60 + s) END AS wall
  FROM clocks
), zoned AS (
  SELECT l.*, CASE WHEN zn = 'Z' THEN 0 WHEN regexp_matches(zn, '^[+-]') THEN (CASE WHEN zn[1] = '-' THEN -1 ELSE 1 END) * (CAST(zn[2:3] AS INTEGER) * 60 + CAST(zn[-2:] AS INTEGER))
    WHEN zn <> '' THEN a.utc_offset_min WHEN bs THEN 345 END AS off, wall AT TIME ZONE zone AS own
  FROM local l LEFT JOIN zone_names a ON upper(a.abbr) = l.zn
), instants AS (
  SELECT ordinal, fetched_at, CASE WHEN epoch THEN CAST(t[1:10] AS BIGINT) WHEN off IS NOT NULL THEN epoch_us(wall) // 1000000 - off * 60 WHEN zn <> '' THEN NULL
    WHEN (own - INTERVAL 1 HOUR) AT TIME ZONE zone = wall THEN epoch_us(own) // 1000000 - 3600 ELSE epoch_us(own) // 1000000 END AS sec
  FROM zoned
), good AS (SELECT ordinal, sec FROM instants WHERE sec >= 946684800 AND sec * 1000000 <= epoch_us(fetched_at) // 1000000 * 1000000 + 3600000000)
SELECT 'raw_items' AS rec, ordinal AS rec_id, sec AS published_s FROM good
UNION ALL
SELECT 'articles', a.article_id, coalesce(g.sec, epoch_us(a.fetched_at) // 1000000) FROM articles a LEFT JOIN good g ON g.ordinal = a.item_ordinal
WHERE epoch_us(a.published_at) // 1000000 <> coalesce(g.sec, epoch_us(a.fetched_at) // 1000000) OR a.published_estimated <> (g.sec IS NULL)
"""

_STORIES = """
v AS (SELECT e.vec_id, e.embedding::DOUBLE[] AS x, d.published_at AS at FROM embeddings e JOIN documents d ON d.doc_id = e.vec_id + 1),
pairs AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.vec_id < b.vec_id
  WHERE abs(epoch_us(a.at) - epoch_us(b.at)) <= 172800000000 AND list_cosine_similarity(a.x, b.x) >= 0.3
), walk AS (
  SELECT vec_id AS id, vec_id AS seen FROM v
  UNION SELECT w.id, CASE WHEN p.a = w.seen THEN p.b ELSE p.a END FROM walk w JOIN pairs p ON p.a = w.seen OR p.b = w.seen
), stories AS (SELECT id AS vec_id, min(seen) AS cluster FROM walk GROUP BY 1)"""

_LINES = r"""list_transform(string_split({0}, chr(10)), lambda x: trim(regexp_replace(nfc_normalize(regexp_replace(x, '<[^>]+>', ' ', 'g')), '[ \t\x{{00A0}}\x{{200B}}\x{{200C}}\x{{200D}}]+', ' ', 'g')))"""

ORACLES: dict[str, str] = {
    "p3_found": _DATES,
    "a5_source_report": """
      SELECT source_id, count(*) AS articles, max(epoch_us(published_at)) // 1000000 AS newest_s FROM (
        SELECT *, row_number() OVER (PARTITION BY url_hash ORDER BY article_id) AS r FROM articles) WHERE r = 1 GROUP BY 1""",
    "f11_canonical_url": f"WITH {_URL} SELECT ordinal, url FROM canon",
    "f13_url_hash": f"WITH {_URL} SELECT ordinal, sha256(url) AS url_hash FROM canon",
    "f10_homepage": "SELECT id, regexp_extract(url, '^([^:/]+://[^/?#]*)', 1) AS homepage FROM sources",
    "f14_urljoin": r"""
      WITH x AS (SELECT ordinal, url, regexp_extract(url, '^([^:]+://[^/]+)', 1) AS origin, regexp_extract(url, '^[^:]+://[^/]+(/[^?#]*)', 1) AS path, 's' || ordinal AS last FROM raw_items)
      SELECT ordinal, 'path' AS form, CASE WHEN path = '' THEN origin || '/feed/all/now' ELSE origin || path END AS url FROM x
      UNION ALL SELECT ordinal, 'up', origin || '/feed/' || last FROM x UNION ALL SELECT ordinal, 'beside', origin || '/feed/all/' || last || '?a=1' FROM x
      UNION ALL SELECT ordinal, 'query', origin || '/feed/all/now?q=' || last FROM x UNION ALL SELECT ordinal, 'host', split_part(origin, ':', 1) || '://other.example/' || last FROM x
      UNION ALL SELECT ordinal, 'whole', trim(url) FROM x""",
    "f1_clean": f"SELECT ordinal, {_CLEAN.format('title')} AS title, {_CLEAN.format('summary')} AS summary FROM raw_items",
    "f2_strip_tags": "SELECT ordinal, ' ' || regexp_replace(summary, '<[^>]+>', ' ', 'g') || '  ' AS text FROM raw_items",
    "f8_ascii_digits": "SELECT article_id, translate(title, '०१२३४५६७८९', '0123456789') AS title FROM articles",
    "f9_devanagari_share": r"""
      WITH l AS (SELECT article_id, regexp_replace(body, '[^\p{L}]', '', 'g') AS x FROM articles),
      c AS (SELECT article_id, length(x) AS n, length(regexp_replace(x, '[^\x{0900}-\x{097F}]', '', 'g')) AS own FROM l)
      SELECT article_id, round(CASE WHEN n > 0 THEN own / n END, 6) AS share, coalesce(CASE WHEN n > 0 THEN own / n END >= 0.2, false) AS devanagari FROM c""",
    "f31_bool": "SELECT id, lower(trim(active::VARCHAR)) IN ('1','true','yes','on') AS active, CASE WHEN notes IS NULL THEN true ELSE lower(trim(notes)) IN ('1','true','yes','on') END AS notes FROM sources",
    "f33_log_context": "SELECT id, concat_ws(' ', 'source=' || id, 'method=' || method, 'url=' || homepage) AS context FROM sources",
    "f34_report_line": """
      SELECT id, CASE WHEN NOT ok THEN source_id || ': FAILED - ' || coalesce(error, '') WHEN not_modified THEN source_id || ': unchanged (304)'
        ELSE source_id || ': ' || items_seen || ' seen, ' || items_new || ' new, ' || items_duplicate || ' duplicate' END AS line FROM fetch_log""",
    "d2_tokenize": f"SELECT article_id, CAST(len({_TOKENS}) AS INTEGER) AS n, md5(array_to_string({_TOKENS}, ' ')) AS tokens FROM articles",
    "d3_runs": f"WITH x AS (SELECT article_id, {_TOKENS} AS t FROM articles), r AS (SELECT article_id, {_RUNS} AS r FROM x) SELECT article_id, CAST(len(r) AS INTEGER) AS n, md5(array_to_string(r, '|')) AS runs FROM r",
    "d1_first_items": f"WITH {_URL} SELECT min(ordinal) AS ordinal, arg_min(source_id, ordinal) AS source_id, sha256(url) AS url_hash FROM canon GROUP BY url",
    "d4_simhash": "SELECT article_id, simhash FROM articles WHERE simhash <> 0",
    "d4b_simhash_md5": f"""
      WITH x AS (SELECT article_id, {_TOKENS} AS t FROM articles), r AS (SELECT article_id, {_RUNS} AS r FROM x),
      h AS (SELECT article_id, ('0x' || substr(md5(s), 1, 16))::UBIGINT AS h FROM (SELECT article_id, unnest(r) AS s FROM r)),
      v AS (SELECT article_id, b, sum(CASE WHEN (h >> b) & 1 = 1 THEN 1 ELSE -1 END) AS votes FROM h, (SELECT unnest(range(64))::UBIGINT AS b) GROUP BY 1, 2),
      f AS (SELECT article_id, sum(CASE WHEN votes > 0 THEN (1::HUGEINT << b::INTEGER) ELSE 0 END) AS s FROM v GROUP BY 1)
      SELECT a.article_id, CAST(CASE WHEN coalesce(s, 0) >= 9223372036854775808::HUGEINT THEN s - 18446744073709551616::HUGEINT ELSE coalesce(s, 0) END AS BIGINT) AS simhash
      FROM articles a LEFT JOIN f USING (article_id)""",
    "d5_hamming_pairs": """
      WITH n AS (SELECT simhash, min(article_id) AS id FROM articles WHERE simhash <> 0 GROUP BY 1)
      SELECT a.id AS a, b.id AS b, CAST(bit_count(xor(a.simhash, b.simhash)) AS INTEGER) AS distance FROM n a JOIN n b ON a.id < b.id WHERE bit_count(xor(a.simhash, b.simhash)) <= 8""",
    "d7_greedy_near_dup": f"WITH RECURSIVE {_GREEDY.format('articles')} SELECT article_id, kept FROM walk WHERE rn > 0 UNION ALL SELECT article_id, true FROM articles WHERE simhash = 0",
    "d7_kept_report": f"""
      WITH RECURSIVE firsts AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY url_hash ORDER BY article_id) AS r FROM articles) WHERE r = 1),
      {_GREEDY.format('firsts')}
      SELECT source_id, count(*) AS articles, max(epoch_us(published_at)) // 1000000 AS newest_s FROM firsts
      WHERE article_id NOT IN (SELECT article_id FROM walk WHERE rn > 0 AND NOT kept) GROUP BY 1""",
    "j1_known_items": f"WITH {_URL} SELECT ordinal, source_id FROM canon WHERE sha256(url) IN (SELECT url_hash FROM articles)",
    "j2_new_items": "SELECT article_id, source_id FROM incoming_articles WHERE url_hash NOT IN (SELECT url_hash FROM articles)",
    "j3_due_sources": "SELECT id, priority FROM sources WHERE active AND id NOT IN (SELECT id FROM source_state WHERE next_run_at > TIMESTAMPTZ '2026-08-30 01:11:16+00')",
    "j4_item_sources": "SELECT s.category, s.lang, count(*) AS items FROM raw_items i JOIN sources s ON s.id = i.source_id GROUP BY 1, 2",
    "j8_orphan_runs": "SELECT id, source_id FROM fetch_log WHERE source_id NOT IN (SELECT id FROM source_state WHERE last_run_at IS NOT NULL)",
    "j7_near_known": """
      SELECT i.article_id, min(a.article_id) AS known FROM incoming_articles i JOIN articles a ON bit_count(xor(i.simhash, a.simhash)) <= 8
      WHERE i.simhash <> 0 AND a.simhash <> 0 AND a.published_at >= TIMESTAMPTZ '2026-01-01 00:00:00+00' GROUP BY 1""",
    "j5_packs": """
      SELECT s.id, p.pack, p.users FROM sources s LEFT JOIN (SELECT selectors AS pack, count(*) AS users FROM sources WHERE active AND selectors IS NOT NULL GROUP BY 1) p ON p.pack = s.selectors""",
    "f15_bs_dates": """
      SELECT (bs_year * 10000 + bs_month * 100 + d)::BIGINT AS ordinal, epoch_us(first_day::DATE + (d - 1)::INTEGER)::BIGINT // 1000000 + 14 * 3600 + 29 * 60 + 53 - 20700 AS at
      FROM (SELECT *, unnest(range(1, days + 1)) AS d FROM bs_months)""",
    "f19_feed_dates": "SELECT id AS ordinal, epoch_us(started_at) // 1000000 AS at FROM fetch_log",
    "f18_iso_dates": """
      SELECT id AS ordinal, epoch_us(CASE WHEN (started_at - INTERVAL 1 HOUR) AT TIME ZONE zone = started_at AT TIME ZONE zone THEN started_at - INTERVAL 1 HOUR ELSE started_at END) // 1000000 AS at
      FROM fetch_log JOIN source_zones USING (source_id)""",
    "f24_jsonld_value": f"SELECT article_id, {_CLEAN.format('title')} AS title FROM articles",
    "t4_fetch_state": """
      SELECT source_id, CASE WHEN ok AND NOT not_modified THEN '"' || id || '"' END AS etag, NULL::VARCHAR AS last_modified, not_modified
      FROM (SELECT *, row_number() OVER (PARTITION BY source_id ORDER BY started_at DESC, CASE WHEN ok AND NOT not_modified THEN '"' || id || '"' ELSE '' END DESC) AS r FROM fetch_log) WHERE r = 1""",
    "x1_not_in_mix": "SELECT id FROM sources WHERE active EXCEPT SELECT source FROM mix_targets",
    "k1_inserted": """
      SELECT article_id, source_id, url_hash FROM (SELECT *, row_number() OVER (PARTITION BY url_hash ORDER BY article_id) AS r FROM incoming_articles)
      WHERE r = 1 AND url_hash NOT IN (SELECT url_hash FROM articles)""",
    "k3_saved_state": _STATE,
    "op_p2_published_ladder": """
      SELECT article_id, epoch_us(CASE WHEN NOT published_estimated OR author IS NOT NULL THEN published_at ELSE fetched_at END) // 1000000 AS published_s,
        published_estimated AND author IS NULL AS estimated FROM articles""",
    "op_p3_language": r"""
      SELECT ordinal, CASE WHEN s.lang = 'en' AND length(regexp_replace(title, '[^\p{L}]', '', 'g')) > 0
        AND length(regexp_replace(regexp_replace(title, '[^\p{L}]', '', 'g'), '[^\x{0900}-\x{097F}]', '', 'g')) / length(regexp_replace(title, '[^\p{L}]', '', 'g')) >= 0.2
        THEN 'ne' ELSE s.lang END AS lang FROM raw_items i JOIN sources s ON s.id = i.source_id""",
    "op_p5_implausible": "SELECT article_id FROM articles WHERE epoch_us(published_at) - epoch_us(fetched_at) > 3600000000 OR epoch_us(published_at) // 1000000 + 20700 < 946684800",
    "op_p8_selected": """
      SELECT 'name' AS mode, min(id) AS id FROM sources WHERE NOT active UNION ALL SELECT 'priority', id FROM sources WHERE active AND priority = 2 UNION ALL SELECT 'active', id FROM sources WHERE active
      UNION ALL SELECT 'due', id FROM sources WHERE active AND id NOT IN (SELECT id FROM source_state WHERE next_run_at > TIMESTAMPTZ '2026-08-30 01:11:16+00')""",
    "op_p9_article_text": f"""
      WITH x AS (SELECT article_id, 'as is' AS form, title AS t, body AS b, summary AS s FROM articles UNION ALL SELECT article_id, 'no title', ' ' || chr(10), body, summary FROM articles
        UNION ALL SELECT article_id, 'no body', title, chr(9) || chr(10) || ' ' || chr(160), summary FROM articles)
      SELECT article_id, form, md5(regexp_replace(regexp_replace(t || chr(10) || chr(10) || CASE WHEN b = '' THEN s ELSE b END, '^{_BLANK}', ''), '{_BLANK}$', '')) AS text FROM x""",
    "op_p10_poll_interval": "SELECT id, CASE priority WHEN 1 THEN 15 WHEN 2 THEN 30 WHEN 3 THEN 60 WHEN 4 THEN 360 END AS minutes FROM sources",
    "op_p11_error_cut": "SELECT id, substr(repeat(error, 300), 1, 2000) AS error FROM fetch_log WHERE error IS NOT NULL",
    "a1_run_counters": """
      SELECT source_id, count(*) AS runs, count_if(NOT ok)::BIGINT AS failed, sum(items_seen)::BIGINT AS items_seen, sum(items_new)::BIGINT AS items_new,
        sum(items_duplicate)::BIGINT AS items_duplicate, sum(items_seen - items_new - items_duplicate)::BIGINT AS batch_duplicate FROM fetch_log GROUP BY 1""",
    "a2_cycle_summary": """
      SELECT strftime((to_timestamp(0) + to_microseconds(epoch_us(started_at))) AT TIME ZONE 'UTC', '%Y-%m-%d') AS day, sum(items_new)::BIGINT AS items_new,
        coalesce(string_agg(DISTINCT CASE WHEN NOT ok THEN source_id END, ',' ORDER BY CASE WHEN NOT ok THEN source_id END), '') AS failed FROM fetch_log GROUP BY 1""",
    "a3_config_counts": "SELECT count(*) AS configured, count_if(active)::BIGINT AS active FROM sources",
    "a4_estimated": "SELECT source_id, count_if(published_estimated)::BIGINT AS estimated, count(*) AS articles FROM articles GROUP BY 1",
    "a11_unhealthy": f"WITH {_STREAK} SELECT source_id, max(streak) AS longest FROM streaks GROUP BY 1 HAVING max(streak) >= 2",
    "w2_failure_streak": f"WITH {_STREAK} SELECT id, source_id, streak FROM streaks",
    "w3_next_run": f"WITH {_STREAK} SELECT id, streak, backoff, epoch_us(started_at) // 1000000 + 60 * backoff AS next_run_at_s FROM nexts",
    "w4_inventory": "SELECT id, active, CAST(row_number() OVER (PARTITION BY active ORDER BY CASE WHEN active THEN priority ELSE 0 END, lower(name), id) AS INTEGER) AS rank FROM sources",
    "w5_first_items": "SELECT ordinal, source_id, rank FROM (SELECT ordinal, source_id, CAST(row_number() OVER (PARTITION BY source_id ORDER BY ordinal) AS INTEGER) AS rank FROM raw_items) WHERE rank <= 25",
    "o1_recent_fingerprints": "SELECT url_hash, simhash, epoch_us(published_at) // 1000000 AS published_at_s FROM articles WHERE published_at >= TIMESTAMPTZ '2026-01-01 00:00:00+00' AND simhash <> 0 ORDER BY published_at DESC, url_hash LIMIT 5000",
    "s1_rss_items": f"""
      SELECT ordinal, source_id, trim(url) AS url, {_CLEAN.format('title')} AS title, {_CLEAN.format('summary')} AS summary, nullif({_CLEAN.format('author')}, '') AS author,
        nullif(trim(regexp_replace(coalesce(published, ''), '\\s+', ' ', 'g')), '') AS published FROM raw_items""",
    "s2_listing_items": f"SELECT ordinal, 0 AS place, 'https://list.example' || regexp_extract(url, '^[^:]+://[^/]+(/[^#]*)', 1) AS url, {_CLEAN.format('title')} AS title, {_CLEAN.format('summary')} AS summary FROM raw_items",
    "f29_extract": r"""
      WITH l AS (SELECT article_id, author, list_transform(string_split(body, chr(10)),
        lambda x: trim(regexp_replace(nfc_normalize(regexp_replace(x, '<[^>]+>', ' ', 'g')), '[ \t\x{00A0}\x{200B}\x{200C}\x{200D}]+', ' ', 'g'))) AS p FROM articles)
      SELECT article_id, md5(array_to_string(list_filter(p, lambda x: x <> ''), chr(10) || chr(10))) AS body, nullif(author, '') AS author, '2026-01-02' AS published, 'i.jpg' AS image FROM l""",
    "s8_retry_after": "SELECT id, CASE id % 3 WHEN 0 THEN least(items_seen, 120)::DOUBLE WHEN 1 THEN least(items_seen * 10, 120)::DOUBLE END AS seconds FROM fetch_log",
    "s7_robots": "SELECT ordinal FROM raw_items WHERE NOT (starts_with(url, 'https') AND regexp_matches(url, '^https://[^/]+/desh/'))",
    "s11_source_validation": """
      SELECT id, CASE WHEN method NOT IN ('rss', 'html') THEN 'method' WHEN lang NOT IN ('ne', 'en') THEN 'lang'
        WHEN category NOT IN ('news','economic','govt','disaster','social','sports','entertainment') THEN 'category' WHEN priority NOT IN (1, 2, 3, 4) THEN 'priority'
        WHEN NOT regexp_matches(url, '^https?://') THEN 'url' WHEN NOT active AND coalesce(inactive_reason, '') = '' THEN 'inactive_reason'
        WHEN method = 'html' AND coalesce(selectors, '') = '' THEN 'selectors' END AS problem FROM sources
      UNION ALL SELECT 'bare-' || id, CASE WHEN active THEN 'missing: lang' ELSE 'missing: lang, url' END FROM sources""",
    "a8_daily_volume": "SELECT source_id, strftime(published_at AT TIME ZONE 'UTC', '%Y-%m-%d') AS day, count(*) AS articles, count_if(published_estimated)::BIGINT AS estimated FROM articles GROUP BY 1, 2",
    "a9_week_over_week": """
      WITH w AS (SELECT category, date_trunc('week', published_at AT TIME ZONE 'UTC') AS week, count(*) AS articles FROM articles GROUP BY 1, 2)
      SELECT category, strftime(week, '%Y-%m-%d') AS week, articles, articles - lag(articles) OVER (PARTITION BY category ORDER BY week) AS change FROM w""",
    "d9_cosine_neighbours": """
      SELECT query, neighbour, rank FROM (SELECT q.vec_id AS query, r.vec_id AS neighbour,
        CAST(row_number() OVER (PARTITION BY q.vec_id ORDER BY list_cosine_similarity(q.embedding::DOUBLE[], r.embedding::DOUBLE[]) DESC, r.vec_id) AS INTEGER) AS rank
        FROM embeddings q JOIN embeddings r ON q.vec_id <> r.vec_id WHERE q.vec_id % 20 = 0) WHERE rank <= 5""",
    "t1_stream_insert": """
      SELECT article_id, source_id, url_hash FROM (SELECT *, row_number() OVER (PARTITION BY url_hash ORDER BY article_id) AS r FROM incoming_articles) WHERE r = 1""",
    "t3_state_stream": _STATE,
    "k7_inventory_lines": """
      SELECT active, CAST(r AS INTEGER) AS rank, CASE WHEN active THEN '| ' || r || ' | ' || name || ' | <' || url || '> | ' || lang || ' | ' || category || ' | ' || priority || ' | ' || method || ' |'
        ELSE '| ' || name || ' | <' || url || '> | ' || coalesce(inactive_reason, '') || ' |' END AS line
      FROM (SELECT *, row_number() OVER (PARTITION BY active ORDER BY CASE WHEN active THEN priority ELSE 0 END, lower(name), id) AS r FROM sources)""",
    "j6_page_fill": f"""
      WITH first AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY url ORDER BY page_id) AS r FROM extracted_articles) WHERE r = 1)
      SELECT e.page_id, md5(array_to_string(list_filter({_LINES.format('p.body')}, lambda x: x <> ''), chr(10) || chr(10))) AS body,
        coalesce(nullif(e.author, ''), nullif(trim(coalesce(p.author, 'desk')), '')) AS author, nullif(p.image, '') AS image, 'feed' AS published
      FROM extracted_articles e JOIN first p USING (url)
      UNION ALL SELECT -page_id, md5('own'), 'own', NULL, NULL FROM extracted_articles""",
    "op_p1_normalize": f"""
      WITH {_URL}, said AS (SELECT item_ordinal AS ordinal, min(CASE WHEN NOT published_estimated THEN epoch_us(published_at) // 1000000 END) AS feed,
        min(CASE WHEN published_estimated THEN epoch_us(published_at) // 1000000 END) AS page FROM articles GROUP BY 1)
      SELECT i.ordinal, i.source_id, sha256(c.url) AS url_hash, trim(i.title) AS title,
        CASE WHEN s.lang = 'en' AND length(regexp_replace(i.title, '[^\\x{{0900}}-\\x{{097F}}]|[^\\p{{L}}]', '', 'g')) >= 0.2 * length(regexp_replace(i.title, '[^\\p{{L}}]', '', 'g'))
          AND length(regexp_replace(i.title, '[^\\p{{L}}]', '', 'g')) > 0 THEN 'ne' ELSE s.lang END AS lang, s.category,
        coalesce(d.feed, d.page, epoch_us(i.fetched_at) // 1000000) AS published_at_s, d.feed IS NULL AND d.page IS NULL AS published_estimated, nullif(i.author, '') AS author, i.body = '' AS body_missing
      FROM raw_items i JOIN canon c USING (ordinal) JOIN sources s ON s.id = i.source_id LEFT JOIN said d USING (ordinal) WHERE trim(i.url) <> '' AND trim(i.title) <> ''""",
    "s9_payload_items": f"""
      WITH x AS (SELECT r.ordinal, r.source_id, trim(r.url) AS url, {_CLEAN.format('r.title')} AS title, s.method, r.ordinal // 20 AS feed FROM raw_items r JOIN sources s ON s.id = r.source_id
        WHERE r.source_id NOT IN (SELECT id FROM source_state WHERE etag IS NOT NULL)),
      firsts AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY source_id, feed, url ORDER BY ordinal) AS r FROM x) WHERE method = 'rss' OR r = 1)
      SELECT source_id, url, count(*) AS times, min(title) AS title FROM firsts GROUP BY 1, 2""",
    "f18_modes": """
      SELECT 'bs' AS form, mode, count(*) AS readable FROM bs_months, (SELECT unnest(['bs', 'auto']) AS mode) GROUP BY 2
      UNION ALL SELECT 'iso', mode, count(*) FROM fetch_log, (SELECT unnest(['iso', 'auto']) AS mode) GROUP BY 2""",
    "d9_story_clusters": f"WITH RECURSIVE {_STORIES} SELECT vec_id, cluster FROM stories",
    "a10_stories_per_day": f"""
      WITH RECURSIVE {_STORIES} SELECT strftime(v.at AT TIME ZONE 'UTC', '%Y-%m-%d') AS day, count(*) AS articles, count(DISTINCT cluster) AS stories FROM v JOIN stories USING (vec_id) GROUP BY 1""",
}
