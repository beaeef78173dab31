"""Declared schemas of the loading zone, as DDL."""

SCHEMAS = {
    "event_stats": (
        "media_id string, media_url string, received_at timestamp, percent_viewed double, "
        "visitor_key string, ip string, country string"
    ),
    "media_show": "hashed_id string, name string, created timestamp, duration double",
    "visitor_stats": (
        "visitor_key string, created_at timestamp, load_count bigint, play_count bigint, "
        "agent struct<browser:string,mobile:boolean>, tags array<string>"
    ),
    "media_stats": "media_id string, load_count bigint, play_count bigint",
}
