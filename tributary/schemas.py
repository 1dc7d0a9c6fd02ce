"""Explicit schemas (DDL) of the records that cross a boundary. FN-6."""

LINK = "struct<url:string,original_url:boolean>"
THUMBNAIL = "struct<size:int,url:string>"
MEDIA = (
    "struct<url:string,type:string,droplet_image:boolean,"
    f"thumbnails:array<{THUMBNAIL}>>"
)
TAG = "struct<tag_type:string,tag_name:string>"
PLACE = (
    "struct<place_name:string,latitude:double,longitude:double,"
    "place_type:string,source:string>"
)

#: The canonical drop.  A key the producer never set is NULL, an empty list is
#: ``array()``; the two mean different things to the enrichers.
DROP_COLUMNS = {
    "channel": "string",
    "river_id": "array<bigint>",
    "channel_ids": "array<bigint>",
    "identity_orig_id": "string",
    "identity_username": "string",
    "identity_name": "string",
    "identity_avatar": "string",
    "in_reply_to_user_id": "string",
    "droplet_orig_id": "string",
    "droplet_type": "string",
    "droplet_title": "string",
    "droplet_content": "string",
    "droplet_raw": "string",
    "droplet_locale": "string",
    "droplet_date_pub": "timestamp",
    "links": f"array<{LINK}>",
    "media": f"array<{MEDIA}>",
    "tags": f"array<{TAG}>",
    "places": f"array<{PLACE}>",
    "media_complete": "boolean",
    "semantics_complete": "boolean",
    "source": "string",
    "correlation_id": "string",
    "reply_to": "string",
}
DROP = ", ".join(f"{name} {kind}" for name, kind in DROP_COLUMNS.items())

RIVERS = "id bigint, river_active int, email_id string"
RIVER_CHANNELS = (
    "id bigint, river_id bigint, channel string, active int, parameters string"
)
RSS_URLS = (
    "id bigint, url string, last_fetch_time bigint, last_fetch_etag string, "
    "last_fetch_modified string, url_hash string"
)
FETCH_JOB = (
    "url string, river_ids array<bigint>, channel_ids array<bigint>, "
    "last_fetch_time bigint, last_fetch_etag string, "
    "last_fetch_modified string, use_cache boolean"
)
FETCH_RESPONSE = (
    "url string, status int, last_fetch_modified string, "
    "last_fetch_etag string, last_fetch_time bigint"
)
TWEET = (
    "text string, id_str string, created_at string, "
    "in_reply_to_status_id bigint, in_reply_to_user_id_str string, "
    "user struct<id_str:string,screen_name:string,name:string,"
    "profile_image_url:string,lang:string>, "
    "delete struct<status:struct<id_str:string,user_id_str:string>>, "
    "limit struct<track:bigint>"
)
# Ids in messages from the web come as numbers or as text: read as text, cast
# by the operator.
CHANNEL_EVENT = "id string, river_id string, channel string, parameters string"
RIVER_EVENT = (
    "channels array<struct<channel_id:string,river_id:string,channel:string,"
    "parameters:string>>"
)
PUSH_REQUEST = (
    "post_url string, drops array<struct<id:string,droplet_title:string,"
    "droplet_content:string,droplet_date_pub:string>>, bucket_id string, "
    "client_id string, client_secret string"
)

#: Captured feed documents.  Both dialects are parsed by ``from_xml``.
RSS_FEED = (
    "channel struct<title:string,link:string,language:string,"
    "image:struct<url:string>,item:array<struct<guid:string,link:string,"
    "title:string,description:string,`content:encoded`:string,"
    "pubDate:string>>>"
)
#: RSS 1.0: the entries stand beside the channel.
RDF_FEED = (
    "channel struct<title:string,link:string,`dc:language`:string>,"
    "image struct<url:string>,"
    "item array<struct<`_rdf:about`:string,link:string,title:string,"
    "description:string,`content:encoded`:string,`dc:date`:string>>"
)
ATOM_FEED = (
    "title string, `_xml:lang` string, logo string, "
    "link array<struct<_href:string,_rel:string>>, "
    "entry array<struct<id:string,title:string,"
    "link:array<struct<_href:string,_rel:string>>,summary:string,"
    "content:string,updated:string,published:string>>"
)
