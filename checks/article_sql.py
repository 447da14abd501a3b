"""DuckDB texts for the extraction queries."""

from checks.duck_views import norm_text, stable_id
from checks.fetch_sql import PAGES

_ENT = ("regexp_replace(regexp_replace(regexp_replace(regexp_replace({0}, '&copy;?', '©', 'g'), '&middot;?', '·', 'g'), "
        "'&quot;?', '\"', 'g'), '&amp;?', '&', 'g')")


def _plain(markup):
    """Normalised text of markup: tags and comments out, entities read."""
    bare = f"regexp_replace(regexp_replace({markup}, '<!--.*?-->', ' ', 'gs'), '<[^>]*>', ' ', 'g')"
    return norm_text(_ENT.replace("{0}", bare))


def _without(markup, *tags):
    for tag in tags:
        markup = f"regexp_replace({markup}, '<{tag}\\b.*?</{tag}>', '', 'gs')"
    return markup


_TITLE = _plain("regexp_extract(html, '<title>(.*?)</title>', 1, 's')")
_ARTICLE = "regexp_extract(html, '<article>(.*)</article>', 1, 's')"


def _clean(title):
    return norm_text(f"regexp_replace({title}, '\\s+[-|]\\s+.*$', '')")



# The first paragraph of a page is never closed, so it holds all that follow.
TEXT = PAGES + f""",
page AS (SELECT *, {_TITLE} AS raw_title, {_ARTICLE} AS article,
    {_plain(f"regexp_extract({_ARTICLE}, '(<p\\b.*)$', 1, 's')")} AS body FROM landed),
extracted AS (SELECT *, CASE source_id WHEN 'example.net' THEN 1200 ELSE 80 END AS least_chars,
    length(body) AS chars FROM page WHERE source_id IN ('example.com', 'example.net', 'example.org')),
judged AS (SELECT *, CASE WHEN chars < 20 THEN 'no blocks'
    WHEN chars < least_chars THEN 'short text: ' || chars || ' < ' || least_chars
    END AS reason FROM extracted)"""

# The boilerplate lines, in DuckDB's regular expressions.
_BAD = ("(?i)^\\s*>>\\s*|^\\s*(tin liên quan|tin lien quan|xem thêm|xem them|đọc tiếp|doc tiep)([^\\p{L}\\p{N}_]|$)"
        "|^\\s*(theo dõi|bấm theo dõi|mời bạn đọc)([^\\p{L}\\p{N}_]|$)|^\\s*(nguồn|source)\\s*:"
        "|^\\s*chia sẻ\\s*$|^\\s*google news\\s*$")
def _skip(value):
    return f"(length({value}) < 20 OR regexp_matches({value}, '{_BAD}'))"




def _key(value):
    return f"regexp_replace(lower({value}), '[^\\p{{L}}\\p{{N}}_]+', '', 'g')"



LINES = f"""lines AS (
  SELECT doc_id, source, CAST(generate_subscripts(l, 1) - 1 AS INTEGER) AS pos, unnest(l) AS raw
  FROM (SELECT *, string_split(text, chr(10)) AS l FROM documents)),
clean AS (SELECT *, {norm_text('raw')} AS text FROM lines),
blocks AS (SELECT doc_id, pos, text, CAST(row_number() OVER (PARTITION BY doc_id ORDER BY pos) - 1 AS INTEGER)
    AS ordinal FROM (
  SELECT *, row_number() OVER (PARTITION BY doc_id, {_key('text')} ORDER BY pos) AS nth
  FROM clean WHERE NOT {_skip('text')}) WHERE nth = 1),
bodies AS (SELECT doc_id, string_agg(text, chr(10) || chr(10) ORDER BY ordinal) AS body_text,
  CAST(count(*) AS INTEGER) AS block_count FROM blocks GROUP BY doc_id)"""

_IMAGES = LINES + f""", images AS (SELECT doc_id, 'https://news.example.com/img/' || md5(raw) || '.jpg' AS url,
    md5(raw) AS alt, CASE WHEN length(text) BETWEEN 5 AND 500 AND NOT regexp_matches(text, '{_BAD}')
      THEN text END AS caption,
    CAST(row_number() OVER (PARTITION BY doc_id ORDER BY pos) - 1 AS INTEGER) AS ordinal
  FROM (SELECT *, row_number() OVER (PARTITION BY doc_id, raw ORDER BY pos) AS nth FROM clean
    WHERE pos % 5 = 3) WHERE nth = 1)"""

_JSON = """'{"article_id":"article_' || doc_id || '","author":null,"body_text":' || to_json({body})
  || ',"canonical_url":"https://news.example.com/' || doc_id || '","content_blocks":[' || {blocks}
  || '],"content_hash":"' || content_hash || '","event_id":"' || event_id
  || '","event_time":"2024-02-01T00:00:00.000000Z","extracted_payload_hash":' || {hash}
  || ',"extracted_payload_uri":' || {uri}
  || ',"extraction_status":"success","extractor_version":"html_article_blocks_v1","images":[],"ingest_date":"2024-01-02"'
  || ',"published_at":null,"requested_url":"https://news.example.com/' || doc_id
  || '","run_id":"run","schema_version":"article.extracted.v3","source_document_id":"source_doc_' || doc_id
  || '","source_id":"' || source || '","source_payload_uri":"uri/' || doc_id
  || '","summary":null,"title":"Document ' || doc_id || '"}'"""


def _json(body, blocks, digest, uri):
    return (_JSON.replace("{body}", body).replace("{blocks}", blocks).replace("{hash}", digest)
            .replace("{uri}", uri))


EVENTS = f"""docs AS (SELECT *, replace(text, chr(10), chr(10) || chr(10)) AS body,
    (SELECT string_agg('{{"ordinal":' || (i - 1) || ',"text":' || to_json(l[i]) || ',"type":"paragraph"}}', ','
      ORDER BY i) FROM range(1, len(l) + 1) r(i)) AS block_json
  FROM (SELECT *, string_split(text, chr(10)) AS l FROM documents)),
hashed AS (SELECT *, sha256(encode(body)) AS content_hash FROM docs),
built AS (SELECT *, {stable_id('event', "'article.extracted.v3'", "'article_' || doc_id", "'source_doc_' || doc_id",
                               'content_hash')} AS event_id FROM hashed),
sized AS (SELECT *, {_json('body', 'block_json', "'null'", "'null'")} AS full_json FROM built),
split AS (SELECT *, octet_length(encode(full_json)) + 5 AS full_bytes, sha256(encode(full_json)) AS digest FROM sized),
named AS (SELECT *, 'landing/extracted/source_id=' || source || '/ingest_date=2024-01-02/article_id=article_' || doc_id
    || '/source_document_id=source_doc_' || doc_id || '/extracted_payload_hash=' || digest AS uri FROM split)"""

_SLIM = _json("''", "''", "'\"' || digest || '\"'", "'\"' || uri || '\"'")

SQL = {
    "extract_articles": f"""WITH {TEXT} SELECT page_id, requested_url AS canonical_url,
        CASE WHEN raw_title <> '' THEN {_clean('raw_title')} END AS title,
        CAST(CASE WHEN chars >= 20 THEN 1 ELSE 0 END AS INTEGER) AS blocks, CAST(0 AS INTEGER) AS images,
        CASE WHEN reason IS NULL THEN body END AS body_text, reason AS rejection_reason FROM judged""",
    "page_metadata": f"""WITH {TEXT} SELECT page_id, nullif(raw_title, '') AS title,
        CAST(NULL AS VARCHAR) AS summary, CAST(NULL AS VARCHAR) AS author, '' AS dates FROM judged""",
    "page_canonical": f"""SELECT doc_id, '/doc/' || doc_id AS canonical, source AS author,
        nullif({norm_text("split_part(text, chr(10), 1)")}, '') AS title FROM documents""",
    "strip_boilerplate_nodes": f"""WITH {TEXT} SELECT page_id, CAST(len(regexp_extract_all(
          {_without('html', 'script', 'style')}, '<(nav|footer|header|aside|form|button|h1)\\b')) AS INTEGER)
          + 2 - CASE WHEN source_id <> 'example.net' THEN CAST(len(regexp_extract_all(html, '<h1\\b')) AS INTEGER) ELSE 0 END
          AS removed_nodes,
        {_plain("CASE source_id WHEN 'example.net' THEN " + _without('html', 'script', 'style', 'nav', 'footer', 'h1')
                + " ELSE " + _without('html', 'script', 'style', 'nav', 'footer') + " END")} AS remaining
      FROM judged""",
    "content_containers": f"""WITH {TEXT} SELECT page_id, CAST(0 AS INTEGER) AS ordinal,
        CAST(CASE source_id WHEN 'example.net' THEN 2 ELSE 1 END AS INTEGER) AS place, 'article' AS tag,
        {_plain("CASE source_id WHEN 'example.net' THEN " + _without('article', 'h1') + " ELSE article END")} AS text
      FROM judged""",
    "content_blocks": f"""WITH {LINES} SELECT doc_id, text, ordinal, CASE pos % 5 WHEN 3 THEN 'caption'
        WHEN 4 THEN 'list_item' ELSE 'paragraph' END AS type FROM blocks""",
    "article_images": f"WITH {_IMAGES} SELECT doc_id, url, alt, ordinal FROM images",
    "image_captions": f"WITH {_IMAGES} SELECT doc_id, url, caption FROM images",
    "extraction_config_join": f"""WITH {TEXT} SELECT page_id, source_id,
        CASE source_id WHEN 'example.net' THEN 'main,article' ELSE '' END AS content,
        CASE source_id WHEN 'example.net' THEN 'h1' ELSE '' END AS exclude,
        CAST(least_chars AS INTEGER) AS min_text_chars, CAST(1 AS INTEGER) AS min_blocks FROM judged""",
    "extraction_gates": f"""WITH {TEXT} SELECT page_id, verdict, CASE WHEN verdict = 'hash_mismatch' THEN 'payload_read'
        WHEN verdict IS NOT NULL THEN 'article_extract' END AS stage FROM (
      SELECT page_id, CASE WHEN fetch_status = 'failed' THEN 'not_fetched'
        WHEN real_hash <> content_hash THEN 'hash_mismatch'
        WHEN source_id = 'example.org' THEN 'unsupported extractor: pdf_article'
        WHEN reason IS NOT NULL THEN 'rejected: ' || reason
        WHEN coalesce({_clean('raw_title')}, '') = '' THEN 'no_title_or_body' END AS verdict FROM judged)""",
    "oversize_split": f"""WITH {EVENTS} SELECT 'article_' || doc_id AS article_id,
        CAST(CASE WHEN big THEN octet_length(encode({_SLIM})) + 5 ELSE full_bytes END AS INTEGER) AS inline_event_bytes,
        CAST(CASE WHEN big THEN 0 ELSE length(body) END AS INTEGER) AS body_length,
        CAST(CASE WHEN big THEN 0 ELSE len(l) END AS INTEGER) AS blocks,
        CASE WHEN big THEN digest END AS extracted_payload_hash,
        CASE WHEN big THEN uri END AS extracted_payload_uri, CAST(NULL AS VARCHAR) AS size_verdict
      FROM (SELECT *, full_bytes > 3000 AS big FROM named)""",
    "extracted_event_build": f"""WITH {EVENTS} SELECT 'article.extracted.v3' AS schema_version, event_id,
        '2024-02-01T00:00:00.000000Z' AS event_time, source AS source_id, '2024-01-02' AS ingest_date,
        'article_' || doc_id AS article_id, 'https://news.example.com/' || doc_id AS canonical_url,
        'Document ' || doc_id AS title, content_hash, 'source_doc_' || doc_id AS source_document_id,
        'uri/' || doc_id AS source_payload_uri, 'html_article_blocks_v1' AS extractor_version,
        'success' AS extraction_status FROM built""",
    "extract_outcome_stats": f"""WITH {EVENTS} SELECT 'article_' || doc_id AS article_id,
        CAST(length(body) AS INTEGER) AS body_length, CAST(len(l) AS INTEGER) AS block_count,
        CAST(0 AS INTEGER) AS image_count FROM docs""",
    "block_skip": f"""WITH {LINES}, m AS (SELECT doc_id, pos, CASE WHEN pos % 3 = 2 THEN
          ['>> ', 'XEM THÊM ', 'Nguồn : ', 'sources: ', 'Chia sẻ'][pos % 5 + 1] || text ELSE text END AS t FROM clean)
      SELECT doc_id, pos, {_skip('t')} AS skip FROM m""",
    "caption_validity": f"""WITH {LINES} SELECT doc_id, pos, length(text) BETWEEN 5 AND 500
        AND NOT regexp_matches(text, '{_BAD}') AS valid FROM clean""",
    "block_dedupe": f"WITH {LINES} SELECT doc_id, pos, ordinal, text FROM blocks",
    "json_body_join": f"WITH {LINES} SELECT doc_id, body_text, block_count FROM bodies",
    "content_quality_reject": f"""WITH {LINES} SELECT doc_id, CASE
        WHEN body_text IS NULL THEN 'no blocks'
        WHEN length(body_text) < 200 THEN 'short text: ' || length(body_text) || ' < 200'
        WHEN block_count < 2 THEN 'few blocks: ' || block_count || ' < 2'
        WHEN length(body_text) < 1000 AND
          (length(body_text) - length(replace(lower(body_text), 'the ', ''))) / 4
          + (length(body_text) - length(replace(lower(body_text), 'und ', ''))) / 4 >= 3
          THEN 'mostly boilerplate' END AS reason
      FROM documents LEFT JOIN bodies USING (doc_id)""",
}
