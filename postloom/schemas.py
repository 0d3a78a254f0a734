"""Column contracts of the sources and products."""

from __future__ import annotations

# The texts pandas' read_csv takes as missing (public pandas documentation).
NA_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)

# Source columns, by name, that the jobs use. Other columns may be present.
USER_ACTION = {
    "id": "long", "user_id": "long", "event_id": "long", "event_data": "string", "created_at": "long",
}
POSTS = {
    "id": "long", "user_id": "long", "subject_id": "long", "title": "string", "desc": "string",
    "praise_count": "long", "reply_count": "long", "forward_count": "long", "star_count": "long",
    "share_count": "long", "create_time": "long",
}
TOPICS = {
    "id": "long", "title": "string", "introduction": "string", "genre_id": "long", "create_time": "long",
}
USERS = {"id": "string", "sex": "string", "zan_count": "string"}

# The products, in file order.
CAPPED_LOG = {"user_id": "long", "event_id": "long", "event_data": "string", "created_at": "long"}
USER = {"id": "long", "sex": "long", "zan_count": "long"}
CONTENT_RAW = {
    "content_id": "long", "content_title": "string", "desc": "string", "user_id": "long",
    "topic_id": "long", "topic_title": "string", "introduction": "string", "praise_count": "long",
    "reply_count": "long", "forward_count": "long", "star_count": "long", "share_count": "long",
    "content_create_time": "long", "topic_create_time": "long", "topic_praise_count": "long",
    "topic_reply_count": "long", "topic_forward_count": "long",
}
INTER_LIST = {"content_id": "long", "inter_list": "string"}
CONTENT = CONTENT_RAW | {"inter_list": "string"}
CONTENT_WITH_AUTHOR = CONTENT | {"author_user_id": "long"}
USER_CONTENT_LIST = {"user_id": "long", "content_list": "string", "content_num": "long"}
INTERACTIONS = {
    "user_id": "long", "topic_id": "long", "desc": "string", "genre_id": "long",
    "introduction": "string", "comment": "int", "forward": "int", "thumb": "int", "detail": "int",
    "neg": "int", "created_at": "long",
}
TIER = INTERACTIONS | {"content_list": "string", "content_num": "long"}
TEST_SET = {"user_id": "long", "content_list": "string"}

PRODUCTS = {
    "useract_all": CAPPED_LOG,
    "useract5k": CAPPED_LOG,
    "user": USER,
    "content_raw": CONTENT_RAW,
    "inter_list": INTER_LIST,
    "content": CONTENT,
    "content_with_author": CONTENT_WITH_AUTHOR,
    "content_with_interlist": USER_CONTENT_LIST,
    "content_with_topiccnt": INTERACTIONS,
    "bt": TIER,
    "train": INTERACTIONS,
    "dev": INTERACTIONS,
    "test": TEST_SET,
}
