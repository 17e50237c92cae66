"""Schemas of captured bundles; nothing is inferred."""

COMMENT = (
    "comment_id string, scraped_at string, platform string, creator_handle string, post_shortcode string, post_url string, post_kind string, comment_author string, "
    "comment_text string, comment_likes string, comment_verified boolean, comment_posted_at string, native_comment_id string, comment_permalink string, comment_depth int, "
    "parent_comment_id string, worker_id string, batch_id string, extraction_source string"
)
POST = (
    "shortcode string, platform string, creator_handle string, post_url string, post_kind string, caption string, posted_date string, displayed_comment_count bigint, captured_count bigint, "
    "like_count bigint, repost_count bigint, status string, failure_reason string, attempts int, visible_index int, started_at string, completed_at string"
)
EVENT = "id string, ts string, type string, detail string"
RAW_POST = "id string, shortcode string, captured_at string, payload string"
QUEUE = "shortcode string, position int, post_url string, post_kind string, status string"

ENTITIES = {"comments": COMMENT, "posts": POST, "events": EVENT, "raw_post_records": RAW_POST, "post_queue": QUEUE}
DEFAULTS = {"comments": {"platform": "unknown", "post_url": "", "comment_author": "unknown", "comment_text": "", "comment_likes": "0", "comment_verified": False, "comment_depth": 0}, "posts": {"attempts": 0, "captured_count": 0, "like_count": 0}}
