"""The results of ``entries`` in plain SQL, written independently of them.

Where Spark joins tokens, unrolls hops or folds aggregates, the SQL here tests
patterns, recurses and ranks.
"""

from tributary.checks import bindings

AS_OF = bindings.AS_OF

# RE2's \s lacks the vertical tab.
_BLANK = r"[\s\x0B\x1C-\x1F\x{85}\p{Z}]"
_TAGS = r'(?i)<\s*(a|img)\s*[^>]*(?:(?:href|src)\s*=\s*"([^"]+))"[^>]*>'
_SHORT = "('bit.ly', 't.co', 'yfrog.com', 'flic.kr')"


def _strip(text):
    return f"regexp_replace({text}, '^{_BLANK}+|{_BLANK}+$', '', 'g')"


def _fold(text):
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    return f"translate({text}, '{upper}', '{lower}')"


def _csv(column):
    return f"array_to_string(list_sort(list(distinct {column})), ',')"


def _host(url):
    return rf"regexp_extract({url}, '^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//([^/?#]*)', 1)"


def _active(channel, channels="fx_river_channels"):
    return f"""(select c.id as channel_id, cast(c.river_id as bigint) as river_id,
 c.parameters from {channels} c where c.channel = '{channel}' and c.active = 1
 and exists (select 1 from fx_rivers r where r.id = c.river_id and r.river_active = 1))"""


def _terms(source, also=""):
    """Clean terms of the options in ``source``."""
    clean = f"regexp_replace({_strip('lower(t)')}, '^@?#?', '')"
    return f"""(select case when lower(k) in ('person', 'user') then 'follow'
  else 'track' end as type, {clean} as term, channel_id, river_id {also} from (
 select *, unnest(string_split(v, ',')) as t from (
 select *, json_extract_string(parameters, '$.value.' || k) as v from (
 select *, unnest(json_keys(parameters, '$.value')) as k from {source} s)))
 where {clean} <> '')"""


def _predicates(channels="fx_river_channels"):
    source = _active("twitter", channels)
    return f"(select distinct * from {_terms(source)} where length(term) <= 60)"


def _next(url, last):
    digest = f"substr(md5({url} || {last}), 1, 8)"
    return f"{last} + 1800 + cast('0x' || {digest} as bigint) % 1801"


_SUBS = f"""(select json_extract_string(parameters, '$.value') as url, river_id,
 channel_id from {_active('rss')} a)"""
_PARTS = f"""(select url, cast(0 as bigint) as part,
 {_csv('river_id')} as rivers, {_csv('channel_id')} as channels
 from {_SUBS} s group by all)"""
_PRED = _predicates()
_STATE = f"""(select url, coalesce(last_fetch_time, 0) as last_fetch_time,
 last_fetch_etag, last_fetch_modified,
 {_next('url', 'last_fetch_time')} as next_fetch_time, false as submitted
 from fx_rss_urls)"""
_RECONCILED = f"""(select coalesce(s.url, w.url) as url,
 coalesce(s.last_fetch_time, 0) as last_fetch_time, s.last_fetch_etag,
 s.last_fetch_modified, coalesce(s.next_fetch_time, 0) as next_fetch_time,
 coalesce(s.submitted, false) as submitted, md5(coalesce(s.url, w.url)) as url_hash,
 case when s.url is null then 'new' when w.url is null then 'orphan' else 'kept' end
  as change
 from {_STATE} s full join (select distinct url from {_SUBS} u) w on s.url = w.url)"""
_MODE = """case when last_fetch_etag <> '' then 'etag'
 when last_fetch_modified <> '' then 'modified' else 'full' end"""
_JOB_COLUMNS = f"""url, replace(url, '&amp;', '&') as fetch_url, next_fetch_time,
 last_fetch_time, last_fetch_etag, last_fetch_modified, false as use_cache,
 {_MODE} as mode"""
_DUE_STATE = f"(select * from {_STATE} s where next_fetch_time < {AS_OF})"

# Text form of a match: each token between ASCII word bounds or between blanks.
_TRACK = rf"""(select d.id, t.term from fx_drops d,
 (select distinct term from {_PRED} p where type = 'track') t
 where list_bool_and([regexp_matches({_fold('d.droplet_raw')},
  '\b' || regexp_escape(k) || '\b|(^|[\s\x0B])' || regexp_escape(k) || '([\s\x0B]|$)')
  for k in string_split(t.term, ' ') if k <> '']))"""
_FOLLOW = f"""(select distinct d.id, p.term from fx_drops d, {_PRED} p
 where p.type = 'follow'
 and (p.term = d.identity_orig_id or p.term = d.in_reply_to_user_id))"""


def _routes(matches, kind):
    return f"""select m.id, cast(0 as bigint) as part,
 {_csv('p.river_id')} as rivers, {_csv('p.channel_id')} as channels
 from {matches} m join {_PRED} p on p.term = m.term and p.type = '{kind}'
 group by all"""


_ENTRIES = """(select *, row_number() over (partition by url, fetch_id
  order by doc_id) - 1 as pos, min(doc_id) over (partition by url, fetch_id) as first
 from fx_entries)"""
_FEED_DROPS = f"""(select e.fetch_id, e.pos, e.url as identity_orig_id,
 coalesce(e.feed_link, e.url) as identity_username,
 coalesce(e.feed_title, e.url) as identity_name, e.feed_image as identity_avatar,
 md5(coalesce(e.link, '') || coalesce(e.entry_id, '')) as droplet_orig_id,
 e.title as droplet_title, md5(coalesce(e.content, e.summary)) as content_md5,
 md5(coalesce(e.content, e.summary)) as raw_md5, e.feed_language as droplet_locale,
 coalesce(e.published, {AS_OF}) as date_pub, e.link
 from {_ENTRIES} e join {_DUE_STATE} j on j.url = e.url
 where coalesce(j.last_fetch_etag, '') <> '' or coalesce(j.last_fetch_modified, '') <> ''
 or coalesce(e.published, {AS_OF}) >= j.last_fetch_time)"""
_CONTROL = """(select *, case when op in ('add', 'enable') then 'add' else 'delete' end
 as change, json_extract_string(parameters, '$.value') as url, id as channel_id
 from fx_control)"""
_CACHE = """(select id, 'http://feeds.example/' || identity_orig_id as url, date_pub,
 droplet_orig_id, droplet_title, md5(droplet_raw) as raw_md5 from fx_drops)"""
_REPLAYED = f"(select distinct url from {_CONTROL} c where channel = 'rss' and change = 'add')"

_NO_TAGS = _strip("regexp_replace(droplet_raw, '<[^>]*>', '', 'g')")
_TAGGED = f"""(select id, i - 1 as pos, lower(t[i]) as tag, u[i] as url from (
 select *, unnest(range(1, len(t) + 1)) as i from (
 select id, regexp_extract_all(droplet_raw, '{_TAGS}', 1) as t,
  regexp_extract_all(droplet_raw, '{_TAGS}', 2) as u from fx_html_drops)))"""
_BARE = f"""(select id, i - 1 as pos, u[i] as url from (
 select *, unnest(range(1, len(u) + 1)) as i from (
 select id, regexp_extract_all({_NO_TAGS}, 'https?://[^\\s]+') as u
 from fx_html_drops)))"""
_FOUND = f"""(select id, pos, tag, url from {_TAGGED} x union all
 select b.id, b.pos + coalesce(n, 0), 'text', b.url from {_BARE} b left join
  (select id, count(*) as n from {_TAGGED} y group by id) c on c.id = b.id)"""
_WALK = f"""walk(url, cur, hop) as (
 select distinct url, url, 0 from {_FOUND} f
  where tag <> 'img' and lower({_host('url')}) in {_SHORT}
 union all select w.url, r.location, hop + 1 from walk w join fx_redirects r
  on r.url = w.cur and r.status between 100 and 399
  where hop < 5 and lower({_host('w.cur')}) in {_SHORT})"""
_EXPANDED = "(select url, arg_max(cur, hop) as full_url from walk group by url)"
_PHOTOS = """(select url, 'http://img.example/' || photo || '.jpg' as photo
 from fx_photo_pages)"""
_IMAGE = r"(?i)\.(jpg|jpeg|png|gif)(?:[?#].*)?$"
_FACTS = f"""(select img, f.url, full_url, kind, target,
 case when kind = 'image' then cast(p.width as bigint) * p.height end as area from (
 select true as img, url, url as full_url, 'image' as kind, url as target
  from (select distinct url from {_FOUND} f where tag = 'img')
 union all select false, url, full_url,
  case when pic is null then 'link' else 'image' end, coalesce(pic, full_url) from (
  select o.url, coalesce(e.full_url, o.url) as full_url,
   case when regexp_matches(coalesce(e.full_url, o.url), '{_IMAGE}')
     then coalesce(e.full_url, o.url)
    when {_host('coalesce(e.full_url, o.url)')} = 'yfrog.com'
     then trim(coalesce(e.full_url, o.url)) || ':iphone'
    when {_host('coalesce(e.full_url, o.url)')} = 'twitpic.com'
     then 'http://twitpic.com/show/large/' || string_split(coalesce(e.full_url, o.url), '/')[4]
    else ph.photo end as pic
  from (select distinct url from {_FOUND} f where tag <> 'img') o
  left join {_EXPANDED} e on e.url = o.url
  left join {_PHOTOS} ph on ph.url = coalesce(e.full_url, o.url))) f
 left join fx_image_probes p on p.url = f.target)"""
_MENTIONS = f"""(select f.id, f.pos, x.kind, x.target, x.area from {_FOUND} f
 join {_FACTS} x on x.url = f.url and x.img = (f.tag = 'img'))"""
_BEST = f"""(select id, target as droplet_image from (select *, row_number() over (
  partition by id order by area desc, pos) as r from {_MENTIONS} m
  where kind = 'image' and area > 5000) where r = 1)"""

_ACCEPTED = """(select correlation_id, count(*) as attempts,
 min(case when status = 200 and attempt <= 6 then attempt end) as good
 from fx_entity_responses group by correlation_id)"""
_ANSWERS = f"""(select a.correlation_id as id, r.source, r.lang, r.body from {_ACCEPTED} a
 join fx_entity_responses r on r.correlation_id = a.correlation_id
 and r.attempt = a.good)"""

_LOCALS = """(select mail_id, split_part(a, '@', 1) as local from (
 select mail_id, unnest([rcpt1, rcpt2]) as a from fx_mail))"""
_REACHED = f"""(select l.mail_id, {_csv('r.id')} as rivers from {_LOCALS} l
 join fx_rivers r on r.email_id = l.local and r.river_active = 1 group by l.mail_id)"""
_HTML_BODY = "md5(replace(body, chr(10), '<br>' || chr(10)))"
_PUSHED = "(select * from fx_push_requests where routing_key = 'web.bucket.push.deployment')"
_LOG_TIME = "2024-01-01 12:00:00"
_NEW_LOG = f"""(select l.bucket_id, l.droplet_id,
 case when p.droplet_id is null then l.droplet_push_status else 1 end
  as droplet_push_status,
 case when p.droplet_id is null then l.droplet_date_push else '{_LOG_TIME}' end
  as droplet_date_push
 from fx_push_log l left join (select distinct bucket_id, droplet_id from {_PUSHED} q) p
 on p.bucket_id = l.bucket_id and p.droplet_id = l.droplet_id)"""


def _hmac(key, message):
    block = f"""rpad(case when octet_length(encode({key})) > 64 then sha256({key})
 else hex(encode({key})) end, 128, '0')"""

    def padded(pad):
        byte = f"cast('0x' || substr({block}, 2 * i + 1, 2) as integer)"
        return f"""array_to_string([printf('%02x', xor({byte}, {pad}))
 for i in range(64)], '')"""

    inner = f"sha256(unhex({padded(0x36)}) || encode({message}))"
    return f"sha256(unhex({padded(0x5C)} || {inner}))"


_SQL = {
    "active_channels": f"""select *, 'rss' as channel from {_active('rss')} a
 union all select *, 'twitter' from {_active('twitter')} b""",
    "url_subscribers": f"select * from {_PARTS} p",
    "term_normalise": f"select * from {_terms(_active('twitter'))} t",
    "predicates": f"select * from {_PRED} p",
    "predicates_by_user_id": f"""select distinct type,
 case when type = 'follow' then u.user_id else term end as term, channel_id, river_id
 from {_PRED} p left join fx_user_ids u on u.screen_name = p.term
 where type = 'track' or u.user_id is not null""",
    "predicate_quota": f"""select distinct type, term, channel_id, river_id from (
 select *, count(*) filter (first) over (partition by type order by channel_id
  range between unbounded preceding and 1 preceding) as before from (
 select *, row_number() over (partition by type, term order by channel_id) = 1 as first
 from {_PRED} p)) where before < case type when 'track' then 3 else 4 end""",
    "quota_refused": f"""select distinct type, term, channel_id, river_id from (
 select *, count(*) filter (first) over (partition by type order by channel_id
  range between unbounded preceding and 1 preceding) as before from (
 select *, row_number() over (partition by type, term order by channel_id) = 1 as first
 from {_PRED} p)) where before >= case type when 'track' then 3 else 4 end""",
    "first_writer": f"""select type, term, channel_id, river_id from (select *,
 row_number() over (partition by type, term order by channel_id) as r from {_PRED} p)
 where r = 1""",
    "predicate_counts": f"""select type, count(distinct term) as terms from {_PRED} p
 group by type""",
    "registry_maps": f"""select type, term,
 cast(0 as bigint) as part,
 string_agg(channel_id || ':' || river_id, ',' order by channel_id) as channels
 from {_PRED} p group by all""",
    "predicate_maps": f"""select term, cast(0 as bigint) as part,
 string_agg(channel_id || ':' || river_id, ',' order by channel_id) as channels from (
 select term, channel_id, arg_max(river_id, type = 'track') as river_id from {_PRED} p
 group by all) group by all""",
    "predicate_diff": f"""select coalesce(o.type, n.type) as type,
 coalesce(o.term, n.term) as term, coalesce(o.channel_id, n.channel_id) as channel_id,
 case when o.term is null then 'added' when n.term is null then 'removed'
  else 'moved' end as change
 from {_predicates('fx_river_channels_before')} o full join {_PRED} n
 on o.type = n.type and o.term = n.term and o.channel_id = n.channel_id
 where o.river_id is distinct from n.river_id""",
    "registry_add": f"""with b as {_predicates('fx_river_channels_before')}
 select * from b union all select * from {_PRED} p where not exists (select 1 from b
 where b.type = p.type and b.term = p.term and b.channel_id = p.channel_id)""",
    "registry_delete": f"""with n as {_PRED}
 select * from {_predicates('fx_river_channels_before')} p where not exists (
 select 1 from n where n.type = p.type and n.term = p.term
 and n.channel_id = p.channel_id)""",
    "user_id_cache": """select * from fx_user_ids union all
 select distinct identity_orig_id, 'new-' || identity_orig_id from fx_drops
 where identity_orig_id not in (select screen_name from fx_user_ids)""",
    "control_events": """select case when op in ('enable', 'disable')
 then 'web.river.' || op else 'web.channel.' || channel || '.' || op end as routing_key,
 count(*) as n from fx_control
 where op in ('enable', 'disable') or channel = 'rss' group by all""",
    "registry_fold": f"""with last as (select type, term, channel_id, river_id, change
 from (select *, row_number() over (partition by type, term, channel_id
  order by seq desc) as r from {_terms(f"(select * from {_CONTROL} c where channel = 'twitter')", ', change, seq')} t)
 where r = 1)
 select * from {_PRED} p where not exists (select 1 from last l where l.type = p.type
 and l.term = p.term and l.channel_id = p.channel_id)
 union all select type, term, channel_id, cast(river_id as bigint) from last
 where change = 'add'""",
    "subscription_fold": f"""with last as (select url, river_id, channel_id, change from (
 select *, row_number() over (partition by url, channel_id order by seq desc) as r
 from {_CONTROL} c where channel = 'rss') where r = 1)
 select * from {_SUBS} p where not exists (select 1 from last l where l.url = p.url
 and l.channel_id = p.channel_id)
 union all select url, cast(river_id as bigint), channel_id from last
 where change = 'add'""",
    "track_match": f"select * from {_TRACK} t",
    "follow_match": f"select * from {_FOLLOW} t",
    "match_rivers": _routes(_TRACK, "track"),
    "follow_rivers": _routes(_FOLLOW, "follow"),
    "tweet_classes": """select kind, count(*) as n,
 count(*) filter (kind = 'status') as with_id from fx_tweets group by kind""",
    "tweet_drops": f"""select 'twitter' as channel, 'u' || conv_id % 50 as identity_orig_id,
 case when turn > 0 then 'u' || (conv_id + 1) % 50 end as in_reply_to_user_id,
 'Name of ' || screen_name as identity_name, screen_name as identity_username,
 'http://img.example/avatar.png' as identity_avatar,
 cast(id as varchar) as droplet_orig_id, 'original' as droplet_type,
 md5(t) as title_md5, md5(t) as content_md5, md5(t) as raw_md5,
 'en' as droplet_locale, id + 1704067200 as date_pub,
 'https://twitter.com/' || screen_name || '/statuses/' || id as link
 from (select *, {_strip('text')} as t from fx_tweets where kind = 'status')
 where lower(substr(t, 1, 2)) <> 'rt'""",
    "notices": """select kind, case kind when 'delete' then id || '/' || screen_name
 when 'limit' then cast(conv_id as varchar) else md5('not json ' || text) end as v
 from fx_tweets where kind in ('delete', 'limit', 'bad')""",
    "urls_missing": f"select url, url_hash from {_RECONCILED} r where change = 'new'",
    "urls_deleted": f"select url, url_hash from {_RECONCILED} r where change = 'orphan'",
    "url_state": f"select * from {_RECONCILED} r",
    "next_fetch": f"select url, last_fetch_time, next_fetch_time from {_STATE} s",
    "due_jobs": f"""select {_JOB_COLUMNS} from {_RECONCILED} r
 where change <> 'orphan' and next_fetch_time < {AS_OF}""",
    "fetch_jobs": f"""select r.url, p.part, {_MODE} as mode, false as use_cache,
 last_fetch_time, p.rivers, p.channels from {_RECONCILED} r join {_PARTS} p
 on p.url = r.url where change <> 'orphan' and next_fetch_time < {AS_OF}""",
    "fetch_mode": f"select url, {_MODE} as mode from fx_rss_urls",
    "latest_responses": """select url, status, last_fetch_time, last_fetch_etag,
 last_fetch_modified from (select *, row_number() over (partition by url
 order by seq desc) as r from fx_fetch_responses) where r = 1""",
    "fetch_status_upsert": f"""with last as (select * from (select *, row_number() over (
  partition by url order by seq desc) as r from fx_fetch_responses) where r = 1)
 select url, last_fetch_time, last_fetch_etag, last_fetch_modified,
 {_next('url', 'last_fetch_time')} as next_fetch_time, false as submitted from last
 union all select * from {_STATE} s where url not in (select url from last)""",
    "fetch_flags": f"""with answered as (select distinct url from fx_fetch_responses)
 select url, url not in (select url from answered) and next_fetch_time < {AS_OF}
  as submitted from {_STATE} s
 union all select url, false from answered where url not in (select url from {_STATE} t)""",
    "replay_jobs": f"""select r.url, r.url as fetch_url,
 coalesce(s.next_fetch_time, 0) as next_fetch_time,
 coalesce(s.last_fetch_time, 0) as last_fetch_time, s.last_fetch_etag,
 s.last_fetch_modified, true as use_cache, {_MODE} as mode
 from {_REPLAYED} r left join {_STATE} s on s.url = r.url""",
    "feed_entries": f"""select url, fetch_id, pos, feed_title, feed_link, feed_language,
 feed_image, entry_id, link, title, md5(summary) as summary_md5,
 md5(content) as content_md5, published from {_ENTRIES} e""",
    "feed_drops": f"select * exclude (pos) from {_FEED_DROPS} d",
    "since_last_fetch": f"""select identity_orig_id, count(*) as kept
 from {_FEED_DROPS} d group by identity_orig_id""",
    "fetch_counts": """select url, fetch_id, count(*) as drop_count from fx_entries
 group by all""",
    "fetch_answers": f"""select distinct e.url, e.fetch_id,
 case when first % 2 = 0 then 200 else 304 end as status,
 case when first % 4 = 1 then 'Tue, 02 Jan 2024 00:00:00 GMT'
  else j.last_fetch_modified end as last_fetch_modified,
 case when first % 4 = 0 then 'new-' || feed_title else j.last_fetch_etag end
  as last_fetch_etag, cast({AS_OF} as bigint) as last_fetch_time
 from {_ENTRIES} e join {_DUE_STATE} j on j.url = e.url""",
    "feed_routes": f"""select identity_orig_id, droplet_orig_id, p.part, p.rivers,
 p.channels from {_FEED_DROPS} d join {_PARTS} p on p.url = d.identity_orig_id""",
    "cache_serve": f"""select c.id, p.part, c.droplet_orig_id, c.raw_md5, p.rivers,
 p.channels from {_CACHE} c join {_REPLAYED} r on r.url = c.url
 join {_PARTS} p on p.url = c.url""",
    "cache_misses": f"""select url, true as use_cache from {_REPLAYED} r
 where url not in (select url from {_CACHE} c)""",
    "cache_trim": f"""select url, id, date_pub, droplet_title from (select *,
 row_number() over (partition by url order by date_pub desc, id desc) as r
 from {_CACHE} c) where r <= 20""",
    "cache_insert": f"""with new as (select * from (select *, row_number() over (
  partition by identity_orig_id, fetch_id order by pos) as r from {_FEED_DROPS} d)
  where r <= 20)
 select url, id, date_pub, droplet_title from (select *, row_number() over (
  partition by url order by date_pub desc, id desc) as r from {_CACHE} c)
 where r <= 20 or url not in (select identity_orig_id from new)
 union all select identity_orig_id,
 cast('0x' || substr(droplet_orig_id, 1, 12) as bigint), date_pub, droplet_title
 from new""",
    "cache_purge": f"""select url, id from {_CACHE} c
 where url in (select url from {_SUBS} s)""",
    "page_links": f"select * from {_TAGGED} t",
    "bare_urls": f"select * from {_BARE} t",
    "url_parts": rf"""select url, host, path, name, lower(right(name, 3)) as ext from (
 select *, string_split(path, '/')[-1] as name from (
 select url, {_host('url')} as host,
 regexp_replace(regexp_extract(url,
  '^(?:[A-Za-z][A-Za-z0-9+.-]*:)?(?://[^/?#]*)?([^?#]*)', 1), ';[^/]*$', '') as path
 from (select distinct url from {_FOUND} f)))""",
    "short_urls": f"""select id, pos, url from {_FOUND} f
 where lower({_host('url')}) in {_SHORT}""",
    "expanded_urls": f"""with recursive {_WALK} select o.url,
 coalesce(e.full_url, o.url) as full_url
 from (select distinct url from {_FOUND} f where tag <> 'img') o
 left join {_EXPANDED} e on e.url = o.url""",
    "link_classes": f"with recursive {_WALK} select * from {_FACTS} x",
    "page_photos": f"select * from {_PHOTOS} p",
    "drop_links": f"""with recursive {_WALK} select h.id, l.links,
 true as media_complete, 'mediaextractor' as source from fx_html_drops h left join (
 select id, string_agg(target, ',' order by pos) as links from {_MENTIONS} m
 where kind = 'link' group by id) l on l.id = h.id""",
    "drop_media": f"""with recursive {_WALK} select m.id,
 row_number() over (partition by m.id order by m.pos) - 1 as pos, m.target as url,
 'image' as type, m.target = b.droplet_image as droplet_image
 from {_MENTIONS} m join {_BEST} b on b.id = m.id
 where m.kind = 'image' and m.area > 5000""",
    "drop_image": f"with recursive {_WALK} select * from {_BEST} b",
    "entity_attempts": f"""select correlation_id, good is not null as accepted, attempts
 from {_ACCEPTED} a""",
    "drop_tags": f"""select id, 'person' as tag_type, source as tag_name from {_ANSWERS} a
 union all select id, 'person', 'p' || id % 9 from {_ANSWERS} a
 union all select id, 'location', lang from {_ANSWERS} a""",
    "drop_places": f"""select id, lang as place_name, id % 90 * 100 + 50 as lat100,
 id % 180 * 100 + 25 as lon100, 'city' as place_type, 'gisgraphy' as place_source
 from {_ANSWERS} a""",
    "semantics_status": f"""select d.id, true as semantics_complete,
 'semantics' as source, cast(case when a.id is null then -1 else 3 end as bigint)
 as n_tags from fx_drops d left join {_ANSWERS} a on a.id = d.id""",
    "mail_rivers": f"select * from {_REACHED} r",
    "mail_parts": """select mail_id, subject, cast(null as varchar) as error,
 md5(body) as content_md5 from fx_mail""",
    "mail_drops": f"""select m.mail_id, 'email' as channel, r.rivers,
 m.mailfrom as identity_orig_id, m.subject as droplet_title,
 {_HTML_BODY} as content_md5, m.mail_id * 60 + 1704067200 as date_pub,
 case when m.mail_id % 3 <> 0 then 'attachments/' || sha256(m.attached) end as media_url,
 case when m.mail_id % 3 <> 0 then 'application' end as media_type
 from fx_mail m join {_REACHED} r on r.mail_id = m.mail_id where m.subject is not null""",
    "mail_comments": f"""select m.mail_id, t.token, t.type,
 'http://api.example/' || case when t.type = 'drop-comment'
  then 'drop/' || json_extract_string(t.data, '$.drop_id')
  else 'bucket/' || json_extract_string(t.data, '$.bucket_id') end
  || '/comment?api_key=KEY' as post_url, m.mailfrom as from_email,
 json_extract_string(t.data, '$.context') as context,
 json_extract_string(t.data, '$.context_obj_id') as context_obj_id,
 {_HTML_BODY} as text_md5
 from fx_mail m join (select distinct mail_id,
  regexp_replace(local, '^(drop|bucket)-comment-', '') as token from {_LOCALS} l) k
 on k.mail_id = m.mail_id join fx_auth_tokens t on t.token = k.token""",
    "attachments": f"""select distinct sha256(attached) as sha256,
 'application/pdf' as content_type, attached as payload from fx_mail m
 join {_REACHED} r on r.mail_id = m.mail_id
 where m.subject is not null and m.mail_id % 3 <> 0""",
    "push_gate": f"select bucket_id, count(*) as n from {_PUSHED} p group by bucket_id",
    "push_payload": f"""select *, 'drops=' || url_encode(drops_b64) || '&checksum='
 || checksum || '&client_id=' || url_encode(client_id) as body from (
 select bucket_id, part, post_url, client_id, payload,
 to_base64(encode(payload)) as drops_b64, {_hmac('client_secret', 'payload')} as checksum
 from (select bucket_id, cast(0 as bigint) as part, post_url,
 client_id, client_secret, '[' || string_agg('{{"id":' || droplet_id
  || ',"droplet_title":' || to_json(droplet_title) || '}}', ',' order by droplet_id)
  || ']' as payload from {_PUSHED} p group by all))""",
    "signatures": f"""select id, {_hmac('k', 'droplet_raw')} as checksum,
 md5(to_base64(encode(droplet_raw))) as b64_md5, sha256(droplet_raw) as sha256
 from (select *, repeat(md5(droplet_orig_id), id % 4 + 1) as k from fx_drops)""",
    "push_log": f"select * from {_NEW_LOG} l",
    "push_pending": f"""select s.bucket_id, cast(case when s.pending_drop_count > 0
 then greatest(0, s.pending_drop_count - coalesce(n, 0)) else s.pending_drop_count end
 as bigint) as pending_drop_count from fx_push_settings s left join (
 select bucket_id, count(*) as n from {_PUSHED} p group by bucket_id) c
 on c.bucket_id = s.bucket_id""",
    "pending_by_log": f"""select bucket_id, count(*) filter (droplet_push_status = 0)
 as pending from {_NEW_LOG} l group by bucket_id""",
    "date_texts": """select id,
 strftime(make_timestamp(date_pub * 1000000), '%a, %d %b %Y %H:%M:%S +0000') as rfc822,
 strftime(make_timestamp(date_pub * 1000000), '%Y-%m-%d %H:%M:%S') as log,
 date_pub as from_rfc822, date_pub as from_log from fx_drops""",
    "line_breaks": """select id, md5(replace(droplet_raw, chr(10), '<br>' || chr(10)))
 as html_md5 from fx_drops""",
}


_SQL.update(
    {
        "stream_match_rivers": _SQL["match_rivers"],
        "stream_registry_fold": _SQL["registry_fold"],
        "stream_subscription_fold": _SQL["subscription_fold"],
        "stream_fetch_status": _SQL["fetch_status_upsert"],
        "stream_registry_by_user_id": f"select * from ({_SQL['predicates_by_user_id']}) where type = 'follow'",
        "stream_predicate_changes": f"""with bounds as (select min(seq) as first, max(seq) as last from fx_control),
 held as (select type, term, channel_id, case when change = 'add' then cast(river_id as bigint) end as after,
  seq, cast(floor((seq - first) * 3 / (last - first + 1)) as bigint) as run
  from {_terms(f"(select * from {_CONTROL} c where channel = 'twitter')", ', change, seq')} t, bounds),
 ends as (select * from (select *, row_number() over (partition by type, term, channel_id, run
  order by seq desc) as r from held) where r = 1),
 steps as (select e.*, case when row_number() over w = 1 then p.river_id else lag(after) over w end as before
  from ends e left join {_PRED} p on p.type = e.type and p.term = e.term and p.channel_id = e.channel_id
  window w as (partition by e.type, e.term, e.channel_id order by e.run))
 select run, type, term, channel_id, coalesce(after, before) as river_id,
  case when before is null then 'added' when after is null then 'removed' else 'moved' end as change
 from steps where before is distinct from after""",
        "cache_serve_pruned": _SQL["cache_serve"],
        "cache_insert_pruned": f"""select * from ({_SQL['cache_insert']})
 qualify row_number() over (partition by url, id order by date_pub desc) = 1""",
        "stream_cache_serve": f"""with last as (select url, river_id, channel_id, change from (
  select *, row_number() over (partition by url, channel_id order by seq desc) as r
  from {_CONTROL} c where channel = 'rss') where r = 1),
 added as (select url, {_csv('river_id')} as rivers, {_csv('channel_id')} as channels
  from last where change = 'add' group by url)
 select c.id, c.droplet_orig_id, a.rivers, a.channels from {_CACHE} c join added a on a.url = c.url""",
        "feed_quarantine": f"""select distinct e.url, e.fetch_id,
 case when regexp_extract(e.url, '[^/]*$') in ('src3', 'src9', 'src14') then 'broken'
 else 'answered' end as outcome from {_ENTRIES} e join {_DUE_STATE} j on j.url = e.url""",
        "message_quarantine": """select case when op in ('enable', 'disable') then 'web.river.' || op
 else 'web.channel.' || channel || '.' || op end as routing_key, seq,
 case when seq % 10 = 3 then 'broken' else 'read' end as outcome from fx_control""",
        "stream_track_and_follow": rf"""with d as ({_SQL['tweet_drops']}),
 s as (select d.droplet_orig_id, f.screen_name, {_fold(_strip('f.text'))} as raw from d
  join fx_tweets f on cast(f.id as varchar) = d.droplet_orig_id),
 t as (select distinct type, term from {_PRED} p),
 hits as (select s.droplet_orig_id, t.type, t.term from s join t on t.type = 'track'
  where list_bool_and([regexp_matches(s.raw,
  '\b' || regexp_escape(k) || '\b|(^|[\s])' || regexp_escape(k)
  || '([\s]|$)') for k in string_split(t.term, ' ') if k <> ''])
  union all select d.droplet_orig_id, t.type, t.term from d join t on t.type = 'follow'
  and (t.term = d.identity_orig_id or t.term = d.in_reply_to_user_id))
 select distinct h.droplet_orig_id, p.channel_id from hits h
 join {_PRED} p on p.type = h.type and p.term = h.term""",
        "stream_subscription_state": _SQL["subscription_fold"],
        "stream_push_log": _SQL["push_log"],
        "stream_push_pending": _SQL["push_pending"],
        # The last response of each run holds until the next one of its URL; its job
        # goes out if the clock passes the due time before that.
        "stream_fetch_jobs": f"""with timed as (select *, (last_fetch_time - min(last_fetch_time) over ())
  // ((max(last_fetch_time) over () - min(last_fetch_time) over ()) // 4 + 1) as part
  from fx_fetch_responses),
 clocks as (select k as part, (select max(last_fetch_time) from timed t where t.part <= k) as clock
  from unnest(range(4)) as s(k)),
 latest as (select * from (select *, row_number() over (partition by url, part order by seq desc) as r,
  max(seq) over (partition by url order by part) as newest from timed) where r = 1 and seq = newest),
 states as (select url, part, last_fetch_time, last_fetch_etag, last_fetch_modified,
  {_next('url', 'last_fetch_time')} as next_fetch_time from latest
  union all select url, 0, last_fetch_time, last_fetch_etag, last_fetch_modified, next_fetch_time
  from {_STATE} s where url not in (select url from latest where part = 0)),
 held as (select *, coalesce(lead(part) over (partition by url order by part), 4) - 1 as until from states)
 select h.url, h.url as fetch_url, next_fetch_time, last_fetch_time, last_fetch_etag,
  last_fetch_modified, false as use_cache, {_MODE} as mode
 from held h join clocks c on c.part = h.until where next_fetch_time < clock""",
        "stream_outbox_retries": """with tried as (select distinct cast(correlation_id as bigint) as message_id,
  cast(correlation_id % 8 as bigint) as failing from fx_entity_responses)
 select message_id, 'sent' as kind, k as attempt from tried, unnest(range(1, 4)) as s(k)
  where k <= failing + 1
 union all select message_id, case when failing < 3 then 'delivered' else 'given up' end,
  least(failing + 1, 3) from tried""",
        "stream_dedupe": "select distinct channel, droplet_orig_id from fx_drops",
        "stream_tweets": rf"""with d as ({_SQL['tweet_drops']}),
 t as (select distinct term from {_PRED} p where type = 'track'),
 s as (select d.droplet_orig_id, {_fold(_strip('f.text'))} as raw from d
  join fx_tweets f on cast(f.id as varchar) = d.droplet_orig_id)
 select distinct 'drop' as kind, droplet_orig_id as v from s, t
 where list_bool_and([regexp_matches(s.raw,
  '\b' || regexp_escape(k) || '\b|(^|[\s\x0B])' || regexp_escape(k)
  || '([\s\x0B]|$)') for k in string_split(t.term, ' ') if k <> ''])
 union all select kind, case kind when 'delete' then cast(id as varchar)
 when 'limit' then cast(conv_id as varchar) else md5('not json ' || text) end
 from fx_tweets where kind in ('delete', 'limit', 'bad')""",
    }
)


def statements():
    """Query name to SQL, each with the views it needs."""
    return {name: bindings.duck_query(sql) for name, sql in _SQL.items()}
