"""Input tables of the pipeline, derived from the generic test tables.

Each view is one SELECT over whole tables that both Spark and DuckDB can run.
``{name}`` stands for a table, ``{epoch}`` for the second of an event, and
``{steps:a:b}`` for a column ``k`` running from a to b beside each row.
"""

import re

AS_OF = 1704067200 + 43200
FEEDS = "http://feeds.example/"

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()

#: Channel option text, by a key column.
_PARAMETERS = """case when KEY % 2 = 0
  then concat('{{"value":"http://feeds.example/src', KEY % 26, '"}}')
 when KEY % 13 = 0
  then concat('{{"value":{{"user":"@src', KEY % 20, '"}}}}')
 else concat('{{"value":{{"keyword":"', case KEY % 6 when 1 then 'the, Für'
  when 3 then 'Le, #elle,@und,' else 'of the,example.com' end, '"}}}}') end"""

VIEWS = {
    "fx_rivers": """select n_nationkey as id,
 case when n_nationkey % 5 = 4 then 0 else 1 end as river_active,
 concat('river', n_nationkey) as email_id from {nation}""",
    "fx_river_channels": f"""select c_custkey as id, c_nationkey as river_id,
 case when c_custkey % 2 = 0 then 'rss' else 'twitter' end as channel,
 case when c_custkey % 7 = 0 then 0 else 1 end as active,
 {_PARAMETERS.replace("KEY", "c_custkey")} as parameters from {{customer}}""",
    # The same options at an earlier time: some not there yet, some in another
    # river.
    "fx_river_channels_before": f"""select c_custkey as id,
 case when c_mktsegment = 'BUILDING' then 0 else c_nationkey end as river_id,
 case when c_custkey % 2 = 0 then 'rss' else 'twitter' end as channel,
 case when c_acctbal < 0 then 0 else 1 end as active,
 {_PARAMETERS.replace("KEY", "c_custkey")} as parameters from {{customer}}""",
    "fx_user_ids": """select source as screen_name, concat('uid-', source) as user_id
 from {documents} group by source having sum(n_chars) % 4 <> 0""",
    "fx_rss_urls": """select concat('http://feeds.example/', source) as url,
 cast(1704067200 + sum(n_chars) % 86400 as bigint) as last_fetch_time,
 case when min(doc_id) % 3 = 0 then concat('etag-', source) end as last_fetch_etag,
 case when min(doc_id) % 3 = 1 then 'Mon, 01 Jan 2024 00:00:00 GMT' end
  as last_fetch_modified,
 md5(concat('http://feeds.example/', source)) as url_hash
 from {documents} group by source""",
    "fx_fetch_responses": """select event_id as seq,
 concat('http://feeds.example/src', user_id % 26) as url,
 case when event_type = 'error' then 500 else 200 end as status,
 cast(props as string) as last_fetch_etag,
 case when user_id % 3 = 0 then event_type end as last_fetch_modified,
 {epoch} as last_fetch_time from {events}""",
    "fx_drops": """select doc_id as id,
 case when doc_id % 2 = 0 then 'rss' else 'twitter' end as channel,
 source as identity_orig_id, concat('src', doc_id % 7) as in_reply_to_user_id,
 md5(concat(source, '/', doc_id)) as droplet_orig_id,
 concat('Note ', doc_id) as droplet_title, text as droplet_content,
 text as droplet_raw, lang as droplet_locale,
 1704067200 + doc_id * 60 as date_pub from {documents}""",
    # One row per entry; Spark packs the entries of a fetch into one document.
    "fx_entries": """select concat('http://feeds.example/', source) as url,
 cast(floor(doc_id / 1000) as bigint) as fetch_id, doc_id,
 case when source in ('src4', 'src14') then 'atom' else 'rss' end as dialect,
 concat('Feed ', source) as feed_title,
 case when source <> 'src6' then concat('http://', source, '.example/') end
  as feed_link,
 case when source <> 'src8' then 'en' end as feed_language,
 case when source <> 'src10' then concat('http://', source, '.example/i.png') end
  as feed_image,
 case when doc_id % 9 <> 0 then concat('id&', doc_id) end as entry_id,
 case when doc_id % 10 <> 0 then concat('http://', source, '.example/?a=1&b=', doc_id)
  end as link,
 concat('Note <', doc_id, '>') as title,
 case when doc_id % 3 = 0 then text else 'in short' end as summary,
 case when doc_id % 3 <> 0 then text end as content,
 case when doc_id % 20 <> 19 then 1704067200 + doc_id * 60 end as published
 from {documents}""",
    "fx_html_drops": """select page_id as id, url, concat(html,
 ' see http://bit.ly/', page_id, '-0 and http://plain.example/', page_id,
 ' <img src="http://img.example/', page_id * 8 + 1, '.jpg"> <IMG alt="x" src="http://img.example/',
 page_id * 8 + 3, '.PNG?x=1"> <a href="http://twitpic.com/', page_id,
 '">p</a> <a href="http://plixi.com/p/', page_id,
 '">q</a> <a href="http://img.example/', page_id * 8 + 2,
 '.jpg">r</a> http://t.co/hot') as droplet_raw from {pages}""",
    "fx_redirects": """select concat(
  case when k % 2 = 0 then 'http://bit.ly/' else 'http://t.co/' end, page_id, '-', k)
  as url,
 case when page_id % 11 = 0 then 404 else 301 end as status,
 case when k = page_id % 8 then url else concat(
  case when k % 2 = 1 then 'http://bit.ly/' else 'http://t.co/' end,
  page_id, '-', k + 1) end as location
 from {pages} {steps:0:page_id % 8}
 union all select 'http://t.co/hot', 302, max(url) from {pages}""",
    "fx_image_probes": """select concat('http://img.example/', p_partkey,
 case when p_partkey % 8 = 3 then '.PNG?x=1' else '.jpg' end) as url,
 p_size * 10 as width, cast(p_partkey % 30 as int) * 10 as height from {part}""",
    "fx_photo_pages": """select concat('http://plixi.com/p/', page_id) as url,
 page_id * 8 + 5 as photo, html from {pages}""",
    "fx_push_log": """select o_custkey as bucket_id, o_orderkey as droplet_id,
 0 as droplet_push_status, cast(null as string) as droplet_date_push from {orders}""",
    "fx_push_requests": """select o_custkey as bucket_id, o_orderkey as droplet_id,
 concat('Order "', o_orderkey, '"') as droplet_title,
 concat('http://deploy.example/', o_custkey % 10) as post_url,
 concat('client+', o_custkey) as client_id,
 md5(concat('secret', o_custkey)) as client_secret,
 case when o_custkey % 9 = 0 then 'web.bucket.push.other'
  else 'web.bucket.push.deployment' end as routing_key
 from {orders}""",
    "fx_push_settings": """select o_custkey as bucket_id,
 cast(count(*) - 2 as bigint) as pending_drop_count from {orders} group by o_custkey""",
    "fx_auth_tokens": """select md5(concat('tok', s_suppkey)) as token,
 case when s_suppkey % 2 = 0 then 'drop-comment' else 'bucket-comment' end as type,
 case when s_suppkey % 2 = 0 then concat('{{"drop_id":', s_suppkey,
  ',"context":"river","context_obj_id":', s_suppkey % 25, '}}')
  else concat('{{"bucket_id":', s_suppkey, '}}') end as data from {supplier}""",
    "fx_mail": """select doc_id as mail_id,
 concat('user', doc_id % 37, '@mail.example') as mailfrom,
 concat('river', doc_id % 30, '@in.example') as rcpt1,
 concat(case when doc_id % 2 = 0 then 'drop-comment-' else 'bucket-comment-' end,
  md5(concat('tok', doc_id % 130)), '@in.example') as rcpt2,
 case when doc_id % 17 <> 0 then concat('Note ', doc_id) end as subject,
 text as body, lang as attached from {documents}""",
    "fx_tweets": """select conv_id * 1000 + turn as id, role as screen_name,
 conv_id, turn,
 case when turn % 4 = 3 then concat('RT @x ', text) else concat(' ', text) end as text,
 case when turn % 5 = 4 then 'delete' when turn % 7 = 6 then 'limit'
  when conv_id % 10 = 9 then 'ignored' when conv_id % 10 = 8 then 'bad'
  else 'status' end as kind from {conversations}""",
    "fx_entity_responses": """select doc_id as correlation_id, k as attempt,
 case when k > doc_id % 8 then 200 else 503 end as status, source, lang,
 concat('{{"person":["', source, '","p', doc_id % 9, '"],"location":["', lang,
  '"],"places":[{{"name":"', lang, '","latitude":', doc_id % 90,
  '.5,"longitude":', doc_id % 180, '.25,"place_type":"city"}}]}}') as body
 from {documents} {steps:1:doc_id % 8 + 1}""",
    "fx_control": f"""select event_id as seq, user_id as id, user_id % 25 as river_id,
 case when user_id % 2 = 0 then 'rss' else 'twitter' end as channel,
 case event_type when 'click' then 'add' when 'view' then 'enable'
  when 'error' then 'delete' else 'disable' end as op,
 {_PARAMETERS.replace("KEY", "user_id")} as parameters from {{events}}""",
}


def _steps(sql, form):
    return re.sub(r"\{steps:([^:}]*):([^}]*)\}", form, sql)


def table(spark, sf_dir, name):
    """A test table; its schema is read from the file once per process."""
    path = f"{sf_dir}/{name}.parquet"
    if path not in _SCHEMAS:
        _SCHEMAS[path] = spark.read.parquet(path).schema
    return spark.read.schema(_SCHEMAS[path]).parquet(path)


_SCHEMAS = {}
_SPARK_EPOCH = (
    "unix_seconds(cast(convert_timezone('UTC', current_timezone(), ts) as timestamp))"
)


def view(spark, sf_dir, name, instead=None):
    """The view as a DataFrame; ``instead`` maps tables to other DataFrames."""
    sql = VIEWS[name].replace("{epoch}", _SPARK_EPOCH)
    sql = _steps(sql, r"lateral view explode(sequence(\1, \2)) as k")
    given = instead or {}
    used = {
        t: given[t] if t in given else table(spark, sf_dir, t)
        for t in set(re.findall(r"\{([a-z]+)\}", sql))
    }
    return spark.sql(sql, **used)


def duck_text(name):
    """The view as DuckDB SQL over the registered tables."""
    sql = VIEWS[name].replace("{epoch}", "cast(floor(epoch(ts)) as bigint)")
    sql = _steps(sql, r"cross join unnest(range(\1, \2 + 1)) as s(k)")
    return sql.format(**{t: t for t in TABLES})


def duck_query(sql):
    """``sql`` with every view it names put before it as a common table."""
    names = [n for n in VIEWS if re.search(rf"\b{n}\b", sql)]
    tables = [f"{n} as ({duck_text(n)})" for n in names]
    body = sql.strip()
    if body.lower().startswith("with recursive"):
        return "with recursive " + ", ".join(tables) + ", " + body[len("with recursive"):]
    if body.lower().startswith("with "):
        return "with " + ", ".join(tables) + ", " + body[len("with "):]
    return "with " + ", ".join(tables) + " " + body
