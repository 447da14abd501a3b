"""DuckDB texts for the feed queries."""

from checks.duck_views import CRAWL, FEED_ITEMS, norm_text, norm_url, stable_id

_ITEM_ID = stable_id("feed_item", "source_id", "feed_id", "article_url")
_RECORD = stable_id("record", "article_url", "title", "summary", "published_iso")
_PART = "('0x' || substr(sha256(feed_item_id || ':' || record_hash), {0}, 16))::UBIGINT::HUGEINT"
_HASH = "sha256(count(*)::VARCHAR || " + " || ".join(
    f"':' || sum({_PART.format(1 + 16 * i)})::VARCHAR" for i in range(4)) + ")"
_SAME = "source_id IN ('src5', 'src6')"

ITEMS = FEED_ITEMS.replace(
    "CASE WHEN quality = 0 THEN", f"CASE WHEN quality = 0 AND NOT {_SAME} THEN"
).replace("WHERE quality IS NOT NULL", f"WHERE quality IS NOT NULL OR {_SAME}") + f""",
hcur AS (SELECT *, {_ITEM_ID} AS feed_item_id, {_RECORD} AS record_hash FROM cur),
hprev AS (SELECT *, {_ITEM_ID} AS feed_item_id, {_RECORD} AS record_hash FROM prev),
feeds AS (SELECT DISTINCT source AS source_id, lang AS feed_id FROM documents),
sem AS (SELECT source_id, feed_id, count(*) AS items, {_HASH} AS content_hash FROM hcur GROUP BY ALL),
semprev AS (SELECT source_id, feed_id, {_HASH} AS content_hash FROM hprev GROUP BY ALL),
checkpoints AS (
  SELECT f.source_id, f.feed_id, p.content_hash, f.feed_id <> 'fr' AS events_published,
    CASE WHEN f.feed_id <> 'en' THEN 'etag-old' END AS etag,
    'Sun, 31 Dec 2023 00:00:00 GMT' AS last_modified
  FROM feeds f JOIN semprev p USING (source_id, feed_id) WHERE source_id <> 'src9'),
diff AS (SELECT c.*, CASE WHEN p.record_hash IS NULL THEN 'new' ELSE 'changed' END AS change
  FROM hcur c LEFT JOIN hprev p USING (source_id, feed_id, feed_item_id)
  WHERE p.record_hash IS DISTINCT FROM c.record_hash),
off AS (SELECT source_id, feed_id FROM cur
  WHERE NOT ends_with(regexp_extract(article_url, '//([^/]*)', 1), '.' || source_id || '.example.com')
  GROUP BY ALL),
status AS (
  SELECT source_id, feed_id, s.content_hash,
    CASE WHEN source_id IN ('src3', 'src4') THEN
        CASE WHEN k.events_published THEN 'not_modified' ELSE 'unbacked_304' END
      WHEN off.source_id IS NOT NULL THEN 'rejected'
      WHEN k.events_published AND k.content_hash = s.content_hash THEN 'unchanged'
      ELSE 'published' END AS status,
    s.items AS parsed, k.content_hash AS known_hash,
    (SELECT count(*) FROM diff d WHERE d.source_id = f.source_id AND d.feed_id = f.feed_id) AS changed,
    CASE WHEN source_id = 'src1' AND feed_id = 'en' THEN (SELECT count(*) FROM conversations)
      ELSE 0 END AS skipped,
    (SELECT count(*) FROM items0 i WHERE i.source_id = f.source_id AND i.feed_id = f.feed_id
      AND i.quality IS NOT NULL) AS duplicates
  FROM feeds f LEFT JOIN sem s USING (source_id, feed_id)
    LEFT JOIN checkpoints k USING (source_id, feed_id) LEFT JOIN off USING (source_id, feed_id)),
news AS (
  SELECT d.*, {stable_id('rss_run', 'd.source_id', 'd.feed_id', 's.content_hash')} AS run_id,
    CASE WHEN s.known_hash = s.content_hash THEN '2023-12-31' ELSE '2024-02-01' END AS day
  FROM diff d JOIN status s USING (source_id, feed_id) WHERE s.status = 'published'),
merged AS (SELECT source_id, feed_id, feed_item_id, coalesce(c.record_hash, p.record_hash) AS record_hash,
    p.record_hash IS NULL AS is_new, c.pos
  FROM hprev p FULL JOIN hcur c USING (source_id, feed_id, feed_item_id))"""

_LINES = """lines AS (
  SELECT source AS source_id, doc_id AS feed_id, generate_subscripts(l, 1) - 1 AS pos, unnest(l) AS line
  FROM (SELECT *, string_split(text, chr(10)) AS l FROM documents)),
linked AS (SELECT *, 'https://news.example.com/' || md5(line) AS article_url,
    row_number() OVER (PARTITION BY feed_id, line ORDER BY pos) AS nth FROM lines
  WHERE length(line) >= 20)"""
_MULTI = "feed_id IN (SELECT feed_id FROM lines GROUP BY 1 HAVING count(*) > 1)"

_ARTICLE = stable_id("article", "article_url")

SQL = {
    "feed_items_from_xml": f"""WITH {_LINES} SELECT source_id, feed_id, CAST(pos AS BIGINT) AS pos,
        article_url, {norm_text('line')} AS title, '2023-12-31 22:00:00' AS published_at,
        '2024-01-01T05:00:00+07:00' AS published_iso
      FROM linked WHERE nth = 1 AND {_MULTI}""",
    "feed_parse_verdict": f"""WITH {_LINES}, c AS (
        SELECT l.source_id, l.feed_id, count(*) AS n,
          count(DISTINCT l.line) FILTER (length(l.line) >= 20) AS good,
          count(*) FILTER (length(l.line) < 20) AS short
        FROM lines l GROUP BY ALL)
      SELECT source_id, feed_id,
        CASE WHEN n = 1 THEN 'not_rss' WHEN good = 0 THEN 'no_valid_items' END AS verdict,
        CAST(CASE WHEN n > 1 THEN good ELSE 0 END AS INTEGER) AS parsed,
        CAST(CASE WHEN n > 1 THEN short ELSE 0 END AS INTEGER) AS skipped,
        CAST(CASE WHEN n > 1 THEN n - short - good ELSE 0 END AS INTEGER) AS duplicates FROM c""",
    "feed_item_validity": f"""WITH {ITEMS} SELECT source_id, feed_id,
        CAST(parsed + duplicates AS BIGINT) AS valid, CAST(skipped AS BIGINT) AS skipped FROM status""",
    "feed_all_or_nothing": f"""WITH {ITEMS} SELECT source_id, feed_id, pos, article_url
      FROM cur ANTI JOIN off USING (source_id, feed_id)""",
    "feed_item_diff": f"""WITH {ITEMS} SELECT source_id, feed_id, feed_item_id, record_hash, change
      FROM diff""",
    "feed_semantic_hash": f"WITH {ITEMS} SELECT * FROM sem",
    "feed_change_status": f"""WITH {ITEMS} SELECT source_id, feed_id, status, content_hash,
        CASE WHEN status IN ('unchanged', 'published') THEN parsed ELSE 0 END AS parsed,
        CASE WHEN status = 'published' THEN changed ELSE 0 END AS discovered,
        CASE WHEN status IN ('unchanged', 'published') THEN skipped ELSE 0 END AS skipped,
        CASE WHEN status IN ('unchanged', 'published') THEN duplicates ELSE 0 END AS duplicates
      FROM status""",
    "feed_run_rollup": f"""WITH {CRAWL} SELECT *, CASE WHEN fatal > 0 OR (failed > 0 AND successful = 0)
        THEN 'failed' ELSE 'success' END AS outcome FROM (
      SELECT source_id, count(*) AS feed_count, count(*) FILTER (status IN (200, 304)) AS successful,
        count(*) FILTER (status NOT IN (200, 304)) AS failed,
        count(*) FILTER (status NOT IN (200, 304)
          AND (untyped OR status IN (408, 425, 429, 500, 503))) AS fatal
      FROM crawl GROUP BY ALL)""",
    "conditional_request": f"""WITH {ITEMS} SELECT source_id, feed_id,
        CASE WHEN events_published THEN etag END AS if_none_match,
        CASE WHEN events_published THEN last_modified END AS if_modified_since
      FROM feeds LEFT JOIN checkpoints USING (source_id, feed_id)""",
    "first_wins_dedupe": f"""WITH {_LINES} SELECT source_id,
        'https://news.example.com/' || md5(line) AS article_url, doc_id, CAST(pos AS INTEGER) AS pos
      FROM (SELECT source_id, line, feed_id AS doc_id, pos,
          row_number() OVER (PARTITION BY source_id, line ORDER BY feed_id, pos) AS nth FROM lines)
      WHERE nth = 1""",
    "item_map_merge": f"""WITH {ITEMS} SELECT source_id, feed_id, feed_item_id, record_hash, is_new
      FROM merged""",
    "checkpoint_retention": f"""WITH {ITEMS} SELECT source_id, feed_id, feed_item_id, record_hash FROM (
      SELECT *, row_number() OVER (PARTITION BY source_id, feed_id ORDER BY is_new DESC,
        CASE WHEN is_new THEN pos END DESC NULLS LAST,
        CASE WHEN NOT is_new THEN feed_item_id END DESC NULLS LAST) AS back FROM merged)
      WHERE back <= 8""",
    "checkpoint_upsert": f"""WITH {ITEMS} SELECT source_id, feed_id,
        coalesce(n.content_hash, o.content_hash) AS content_hash,
        CASE WHEN n.content_hash IS NULL THEN 1 ELSE 2 END AS round,
        CASE WHEN n.content_hash IS NULL AND feed_id = 'es' THEN NULL
          WHEN n.content_hash IS NULL THEN o.events_published ELSE TRUE END AS events_published,
        CASE WHEN n.content_hash IS NULL AND feed_id = 'es'
          THEN 'invalid_checkpoint:events_published' END AS verdict
      FROM checkpoints o FULL JOIN (SELECT * FROM sem WHERE feed_id <> 'es') n
        USING (source_id, feed_id)""",
    "discovery_events_build": f"""WITH {ITEMS} SELECT 'feed_item.discovered.v2' AS schema_version,
        {stable_id('event', "'feed_item.discovered.v2'", 'feed_item_id', 'record_hash')} AS event_id,
        day || 'T00:00:00.000000Z' AS event_time, run_id, source_id, day AS ingest_date, feed_item_id,
        {_ARTICLE} AS article_id, feed_id, 'news' AS category, article_url, title,
        published_iso AS published_at, day || 'T00:00:00.000000Z' AS discovered_at,
        'landing/feeds/source_id=' || source_id || '/ingest_date=' || day || '/feed_id=' || feed_id
          || '/run_id=' || run_id AS payload_uri, record_hash FROM news""",
    "fetch_requests_build": f"""WITH {ITEMS} SELECT 'article.fetch_requested.v3' AS schema_version,
        {stable_id('event', "'article.fetch_requested.v3'", _ARTICLE, 'record_hash')} AS event_id,
        day || 'T00:00:00.000000Z' AS event_time, run_id, source_id, day AS ingest_date,
        {_ARTICLE} AS article_id, article_url AS requested_url, record_hash AS request_revision
      FROM news""",
    "feed_state_after_poll": f"""WITH {ITEMS} SELECT source_id, feed_id, feed_item_id,
        CASE WHEN t.status = 'published' THEN coalesce(c.record_hash, p.record_hash) ELSE p.record_hash END AS record_hash,
        p.record_hash IS NULL AS is_new
      FROM hprev p FULL JOIN hcur c USING (source_id, feed_id, feed_item_id) LEFT JOIN status t USING (source_id, feed_id)
      WHERE p.record_hash IS NOT NULL OR t.status = 'published'""",
    "feed_checkpoints_after_poll": f"""WITH {ITEMS}, ends AS (SELECT s.*, k.etag AS old_etag, k.last_modified AS old_time,
          k.events_published, k.source_id IS NOT NULL AS had,
          CASE WHEN s.known_hash = s.content_hash THEN '2023-12-31' ELSE '2024-02-01' END AS day,
          {stable_id('rss_run', 's.source_id', 's.feed_id', 's.content_hash')} AS run_id
        FROM status s LEFT JOIN checkpoints k ON k.source_id = s.source_id AND k.feed_id = s.feed_id)
      SELECT source_id, feed_id, CASE WHEN status = 'published' THEN content_hash ELSE known_hash END AS content_hash,
        CASE WHEN status = 'published' THEN day ELSE '2023-12-31' END AS observed_on,
        status = 'published' OR events_published AS events_published,
        CASE WHEN status IN ('published', 'unchanged') THEN 'etag-' || source_id ELSE old_etag END AS etag,
        CASE WHEN status IN ('published', 'unchanged') THEN 'Mon, 01 Jan 2024 00:00:00 GMT' ELSE old_time END AS last_modified,
        CASE WHEN status = 'published' THEN 'landing/feeds/source_id=' || source_id || '/ingest_date=' || day || '/feed_id='
          || feed_id || '/run_id=' || run_id END AS payload_uri
      FROM ends WHERE had OR status = 'published'""",
    "dedupe_by_event_id": f"""WITH {ITEMS} SELECT DISTINCT
        {stable_id('event', "'article.fetch_requested.v3'", _ARTICLE, 'record_hash')} AS event_id,
        {_ARTICLE} AS article_id, record_hash AS request_revision FROM hcur""",
}
