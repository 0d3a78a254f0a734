"""DuckDB SQL that states the expected result of each registered query, on the test tables."""

from __future__ import annotations

# Fixed values, written out here once more: the statements must not follow a mistake in the library.
EVENT_LABELS = {"thumb": (254, 248), "comment": (257, 249), "forward": (258, 256), "detail": (262, 263, 264, 310)}
FLAGS = ("comment", "forward", "thumb", "detail", "neg")
TIERS = (1, 2, 3, 4, 5)
INTERACTIONS = (
    "user_id", "topic_id", "desc", "genre_id", "introduction", "comment", "forward", "thumb", "detail", "neg", "created_at",
)
NA_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)


def _quoted(columns) -> str:
    return ", ".join(f'"{c}"' for c in columns)


_LABEL_CASES = " ".join(
    f"WHEN event_id IN ({', '.join(map(str, codes))}) THEN '{name}'" for name, codes in EVENT_LABELS.items()
)
_ONE_HOT = ", ".join(f"CAST(follow = '{f}' AS INTEGER) AS {f}" for f in FLAGS)
_TOKENS = ", ".join(f"'{t}'" for t in NA_TOKENS)

# Each entry may use the ones above it.
TABLES = {
    "keyed_events": """
        SELECT *, CAST(regexp_extract(props, '[0-9]+', 0) AS BIGINT) AS k,
               event_type IN ('click', 'purchase') AND user_id % 10 <> 0 AS p
        FROM events""",
    "events_with_cid": """
        SELECT *, CASE WHEN k >= 95 THEN 9000000 + k
                       WHEN p AND user_id % 10 BETWEEN 1 AND 6 THEN k % (user_id % 10) + 100 * (user_id % 3)
                       ELSE k + 100 * (user_id % 3) END AS cid
        FROM keyed_events""",
    "user_action": """
        SELECT event_id AS id, user_id,
               CASE WHEN p AND event_type = 'click' THEN [254, 248, 257, 249, 258][event_id % 5 + 1]
                    WHEN p THEN [256, 262, 263, 264, 310][event_id % 5 + 1]
                    WHEN event_id % 41 = 0 THEN NULL ELSE 100 END AS event_id,
               CASE WHEN event_id % 101 = 0 THEN '[1,2]'
                    WHEN event_id % 23 = 1 THEN '{"x": 1}'
                    WHEN event_id % 101 = 2 THEN '{"content_id": "n/a"}'
                    WHEN event_id % 101 = 4 THEN '{"content_id": ' || cid
                    WHEN event_id % 101 = 6 THEN '{"content_id": null}'
                    WHEN event_id % 101 = 8 THEN '{"content_id": [1, 2]}'
                    WHEN event_id % 23 = 3 THEN '{"content_id": "' || cid || '"}'
                    ELSE '{"content_id": ' || cid || '}' END AS event_data,
               epoch_us(ts) // 1000000 AS created_at
        FROM events_with_cid""",
    "posts": """
        SELECT doc_id AS id, doc_id % 150 AS user_id,
               CASE WHEN doc_id % 29 <> 28 THEN doc_id % 28 END AS subject_id,
               substr(text, 1, 40) AS title, CASE WHEN doc_id % 17 <> 5 THEN text END AS "desc",
               n_chars % 50 AS praise_count, n_chars % 7 AS reply_count, n_chars % 11 AS forward_count,
               n_chars % 5 AS star_count, n_chars % 3 AS share_count, 1700000000 + doc_id AS create_time
        FROM documents""",
    "topics": """
        SELECT CAST(n_nationkey AS BIGINT) AS id, n_name AS title,
               concat(n_name, ' in ', chr(10), r_name) AS introduction, CAST(n_regionkey AS BIGINT) AS genre_id,
               CASE WHEN n_nationkey % 6 <> 5 THEN CAST(1600000000 + n_nationkey AS BIGINT) END AS create_time
        FROM nation JOIN region ON n_regionkey = r_regionkey""",
    "users": """
        SELECT CAST(c_custkey AS VARCHAR) AS id,
               CASE WHEN c_custkey % 7 <> 6 THEN CAST(c_nationkey % 3 AS VARCHAR) END AS sex,
               CASE WHEN c_custkey % 11 <> 10 THEN CAST(c_acctbal AS VARCHAR) END AS zan_count
        FROM customer""",
    "payloads": """
        SELECT *, CASE WHEN json_valid(event_data) THEN event_data END AS payload FROM user_action""",
    "judged": """
        SELECT *, payload IS NULL OR payload LIKE '{%'
                  AND coalesce(json_type(json_extract(payload, '$.content_id')), '') IN ('NULL', 'ARRAY', 'OBJECT') AS bad_json
        FROM payloads""",
    "parsed": f"""
        SELECT id, user_id, event_id, created_at,
               CASE {_LABEL_CASES} ELSE 'neg' END AS follow,
               CASE WHEN payload NOT LIKE '{{%' THEN 0
                    WHEN json_extract(payload, '$.content_id') IS NULL THEN NULL
                    ELSE coalesce(TRY_CAST(json_extract_string(payload, '$.content_id') AS BIGINT), 0)
               END AS content_id
        FROM judged WHERE NOT bad_json""",
    "usable": """
        SELECT * FROM parsed
        WHERE user_id IS NOT NULL AND event_id IS NOT NULL AND content_id IS NOT NULL AND created_at IS NOT NULL""",
    "activity": """
        SELECT user_id, count(*) AS events FROM user_action WHERE user_id IS NOT NULL GROUP BY user_id""",
    "capped": """
        SELECT * FROM user_action
        WHERE user_id IN (SELECT user_id FROM activity WHERE events < 70)
          AND event_id IS NOT NULL AND event_data IS NOT NULL AND created_at IS NOT NULL""",
    "cohort": """
        SELECT user_id FROM activity WHERE events < 70 ORDER BY md5('0|' || user_id), user_id LIMIT 40""",
    "post_topics": """
        SELECT p.id AS content_id, translate(p.title, chr(10) || chr(13) || ' ', '') AS content_title,
               translate(p."desc", chr(10) || chr(13) || ' ', '') AS "desc", p.user_id, p.subject_id AS topic_id,
               translate(t.title, chr(10) || chr(13) || ' ', '') AS topic_title,
               translate(t.introduction, chr(10) || chr(13) || ' ', '') AS introduction,
               p.praise_count, p.reply_count, p.forward_count, p.star_count, p.share_count,
               p.create_time AS content_create_time, coalesce(t.create_time, 0) AS topic_create_time
        FROM posts p LEFT JOIN topics t ON p.subject_id IS NOT DISTINCT FROM t.id""",
    "content_raw": """
        SELECT p.*,
               CAST((SELECT coalesce(sum(q.praise_count), 0) FROM post_topics q WHERE q.topic_id = p.topic_id)
                    AS BIGINT) AS topic_praise_count,
               CAST((SELECT coalesce(sum(q.reply_count), 0) FROM post_topics q WHERE q.topic_id = p.topic_id)
                    AS BIGINT) AS topic_reply_count,
               CAST((SELECT coalesce(sum(q.forward_count), 0) FROM post_topics q WHERE q.topic_id = p.topic_id)
                    AS BIGINT) AS topic_forward_count
        FROM post_topics p""",
    "inter_lists": """
        SELECT content_id, string_agg(CAST(user_id AS VARCHAR), ',' ORDER BY user_id) AS inter_list
        FROM (SELECT DISTINCT coalesce(content_id, 0) AS content_id, user_id
              FROM parsed JOIN (SELECT id FROM capped) USING (id) WHERE follow <> 'neg')
        GROUP BY content_id""",
    "content": """
        SELECT r.*, i.inter_list
        FROM content_raw r LEFT JOIN inter_lists i ON r.content_id = i.content_id AND i.content_id <> 0""",
    "firsts": """
        SELECT user_id, content_id, created_at, id FROM usable WHERE follow <> 'neg'
        QUALIFY row_number() OVER (PARTITION BY user_id, content_id ORDER BY created_at, id) = 1""",
    "content_lists": """
        SELECT user_id, string_agg(CAST(content_id AS VARCHAR), ',' ORDER BY created_at, id) AS content_list,
               count(*) AS content_num
        FROM firsts GROUP BY user_id""",
    "pos": """
        SELECT user_id, content_id, follow, created_at, id FROM usable WHERE follow <> 'neg'
        QUALIFY row_number() OVER (PARTITION BY user_id, content_id, follow ORDER BY created_at DESC, id DESC) = 1""",
    "neg": """
        SELECT user_id, content_id, follow, created_at, id FROM usable WHERE follow = 'neg'
        QUALIFY row_number() OVER (PARTITION BY user_id, content_id ORDER BY created_at DESC, id DESC) = 1""",
    "ratio": """
        SELECT (SELECT count(*) FROM pos) AS positives, (SELECT count(*) FROM neg) AS negatives,
               CAST((SELECT count(*) FROM pos) AS DOUBLE) / CAST((SELECT count(*) FROM neg) AS DOUBLE) AS ratio""",
    "quotas": """
        SELECT user_id, count(*) AS negatives,
               CAST(round_even(count(*) * (SELECT ratio FROM ratio), 0) AS BIGINT) AS quota
        FROM neg GROUP BY user_id""",
    "sampled": """
        SELECT user_id, content_id, follow, created_at, id
        FROM (SELECT *, row_number() OVER (PARTITION BY user_id
                        ORDER BY md5('0|' || user_id || '|' || content_id), content_id) AS draw FROM neg)
        JOIN quotas USING (user_id) WHERE draw <= quota""",
    "drawn_union": "SELECT * FROM pos UNION ALL SELECT * FROM sampled",
    "enriched": f"""
        SELECT b.*, p.subject_id AS topic_id, p."desc", t.genre_id, t.introduction, {_ONE_HOT}
        FROM drawn_union b LEFT JOIN posts p ON b.content_id = p.id
        LEFT JOIN topics t ON p.subject_id IS NOT DISTINCT FROM t.id""",
    "flagged": """
        SELECT *, follow <> 'neg'
                  AND count(*) FILTER (follow <> 'neg') OVER (PARTITION BY user_id, "desc") > 1 AS rep
        FROM enriched""",
    "merged": """
        SELECT * EXCLUDE (comment, forward, thumb, detail), """ + ", ".join(
            f'CAST(CASE WHEN NOT rep THEN {f} WHEN "desc" IS NULL THEN 0 '
            f'ELSE max({f}) OVER (PARTITION BY user_id, "desc") END AS INTEGER) AS {f}'
            for f in FLAGS[:4]
        ) + " FROM flagged",
    "kept": """
        SELECT *, 0 AS block FROM merged WHERE follow <> 'neg'
        QUALIFY row_number() OVER (PARTITION BY user_id, "desc" ORDER BY created_at DESC, id DESC) = 1
        UNION ALL SELECT *, 1 AS block FROM merged WHERE follow = 'neg'""",
    "rows_in_order": """
        SELECT user_id, coalesce(topic_id, 0) AS topic_id,
               translate("desc", chr(10) || chr(13) || ' ', '') AS "desc", coalesce(genre_id, 0) AS genre_id,
               translate(introduction, chr(10) || chr(13) || ' ', '') AS introduction,
               comment, forward, thumb, detail, neg, created_at, block, id
        FROM kept""",
    "tiers": f"""
        SELECT r.*, l.content_list, l.content_num, tier.k
        FROM rows_in_order r JOIN content_lists l USING (user_id)
        JOIN (VALUES {", ".join(f"({k})" for k in TIERS)}) tier(k) ON l.content_num > tier.k""",
}


def _split_tables(name: str, order: str) -> dict[str, str]:
    """The positional split by plain row numbers, in a given order."""
    return {
        f"{name}_placed": f"""
            SELECT *, row_number() OVER (PARTITION BY k ORDER BY {order}) - 1 AS position,
                   CAST(trunc(count(*) OVER (PARTITION BY k) * CAST(0.8 AS DOUBLE)) AS BIGINT) AS a,
                   CAST(trunc(count(*) OVER (PARTITION BY k) * CAST(0.1 AS DOUBLE)) AS BIGINT) AS d
            FROM tiers""",
        f"{name}_parts": f"""
            SELECT *, CASE WHEN position < a THEN 'train' WHEN position < a + d THEN 'dev' ELSE 'test' END AS part
            FROM {name}_placed""",
        f"{name}_left_out": f"""
            SELECT k, part, CASE WHEN part = 'train' THEN max_by(user_id, position)
                                 ELSE min_by(user_id, position) END AS user_id
            FROM {name}_parts GROUP BY k, part""",
        f"{name}_split": f"SELECT * FROM {name}_parts ANTI JOIN {name}_left_out USING (k, part, user_id)",
    }


TABLES |= _split_tables("reference", "block, user_id, created_at, id")
TABLES |= _split_tables("by_user", "user_id, created_at, block, id")


def _query(final: str) -> str:
    """`final` with the tables it needs, and those they need, in front."""
    needed, texts = set(), [final]
    for name in reversed(TABLES):
        if any(_uses(t, name) for t in texts):
            needed.add(name)
            texts.append(TABLES[name])
    tables = ",\n".join(f"{n} AS ({TABLES[n]})" for n in TABLES if n in needed)
    return f"WITH {tables}\n{final}"


def _uses(sql: str, name: str) -> bool:
    words = sql.replace("(", " ").replace(")", " ").replace(",", " ").split()
    return any(w in ("FROM", "JOIN") and words[i + 1] == name for i, w in enumerate(words[:-1]))


_INTERACTION = _quoted(INTERACTIONS)
_CONTENT_TEXTS = ("content_title", "desc", "topic_title", "introduction")


def _text_of(table: str, columns: tuple[str, ...], without: str = "") -> str:
    """The table after a trip through text: texts that stand for missing values are null."""
    texts = ", ".join(f'CASE WHEN "{c}" NOT IN ({_TOKENS}) THEN "{c}" END AS "{c}"' for c in columns)
    return f"SELECT * {f'EXCLUDE ({without}) ' if without else ''}REPLACE ({texts}) FROM {table}"


def oracle_sql() -> dict[str, str]:
    finals_user = """
            SELECT coalesce(CAST(id AS BIGINT), 0) AS id, coalesce(CAST(sex AS BIGINT), 0) AS sex,
                   coalesce(CAST(trunc(CAST(zan_count AS DECIMAL(38, 9))) AS BIGINT), 0) AS zan_count
            FROM users"""
    finals = {
        "label_distribution": f"""
            SELECT CASE {_LABEL_CASES} ELSE 'neg' END AS follow, count(*) AS events FROM user_action GROUP BY 1""",
        "payload_counts": "SELECT count(*) AS log_rows, count(*) FILTER (bad_json) AS bad_json FROM judged",
        "content_id_counts": """
            SELECT coalesce(content_id, 0) AS content_id, count(*) AS events FROM parsed GROUP BY 1""",
        "user_dim": finals_user,
        "activity": "SELECT * FROM activity",
        "capped_log": """
            SELECT user_id, CAST(event_id AS BIGINT) AS event_id, event_data, created_at FROM capped""",
        "cohort_log": """
            SELECT user_id, CAST(event_id AS BIGINT) AS event_id, event_data, created_at
            FROM capped SEMI JOIN cohort USING (user_id)""",
        "post_topic": "SELECT * FROM post_topics",
        "topic_counters": """
            SELECT DISTINCT topic_id, topic_praise_count, topic_reply_count, topic_forward_count FROM content_raw""",
        "content_raw": "SELECT * FROM content_raw",
        "inter_list": "SELECT * FROM inter_lists",
        "inter_list_pieces": """
            SELECT *, CAST(len(string_split(inter_list, ',')) AS BIGINT) AS num FROM inter_lists""",
        "content": "SELECT * FROM content",
        "content_author": """
            SELECT c.*, p.user_id AS author_user_id
            FROM content c LEFT JOIN posts p ON c.content_id = p.id""",
        "no_post_users": "SELECT CAST(unnest(string_split(inter_list, ',')) AS BIGINT) AS user_id FROM inter_lists WHERE content_id = 0",
        "content_rewrite": """
            SELECT c.*, p.user_id AS author_user_id
            FROM content c LEFT JOIN posts p ON c.content_id = p.id""",
        "user_content_list": "SELECT * FROM content_lists",
        "user_list_pieces": "SELECT * FROM content_lists",
        "pos_dedupe": "SELECT * FROM pos",
        "neg_dedupe": "SELECT * FROM neg",
        "pos_neg_ratio": "SELECT * FROM ratio",
        "neg_quota": "SELECT * FROM quotas",
        "neg_sample": "SELECT * FROM sampled",
        "sampled_union": "SELECT * FROM drawn_union",
        "enriched": "SELECT * FROM enriched",
        "repeat_flags": "SELECT user_id, content_id, follow, rep FROM flagged",
        "repeat_merge": """
            SELECT user_id, content_id, follow, rep, comment, forward, thumb, detail, neg FROM merged""",
        "interactions": f"SELECT {_INTERACTION} FROM rows_in_order",
        "bt_tiers": f"SELECT {_INTERACTION}, content_list, content_num, k FROM tiers",
        "split_train": f"SELECT {_INTERACTION}, k FROM reference_split WHERE part = 'train'",
        "split_dev": f"SELECT {_INTERACTION}, k FROM reference_split WHERE part = 'dev'",
        "split_test": "SELECT DISTINCT user_id, content_list, k FROM reference_split WHERE part = 'test'",
        "split_test_pieces": """
            SELECT DISTINCT s.user_id, s.content_list, l.content_num, k
            FROM reference_split s LEFT JOIN content_lists l USING (user_id) WHERE part = 'test'""",
        "split_user_order": f"""
            SELECT {_INTERACTION}, k, part FROM by_user_split WHERE part <> 'test'
            UNION ALL BY NAME
            SELECT DISTINCT user_id, content_list AS "desc", k, part FROM by_user_split WHERE part = 'test'""",
        "preview": f"""
            SELECT {_INTERACTION} FROM rows_in_order ORDER BY block, user_id, created_at, id LIMIT 3000""",
        "tsv_roundtrip": _text_of("content_raw", _CONTENT_TEXTS),
        "tsv_log": "SELECT user_id, CAST(event_id AS BIGINT) AS event_id, event_data, created_at FROM capped",
        "tsv_user": finals_user,
        "tsv_inter_list": "SELECT * FROM inter_lists",
        "tsv_content": _text_of("content", _CONTENT_TEXTS),
        "tsv_content_author": _text_of(
            "content c LEFT JOIN (SELECT id, user_id AS author_user_id FROM posts) p ON c.content_id = p.id", _CONTENT_TEXTS, "id"
        ),
        "tsv_user_lists": "SELECT * FROM content_lists",
        "tsv_interactions": _text_of(f"(SELECT {_INTERACTION} FROM rows_in_order)", ("desc", "introduction")),
        "tsv_tier": _text_of(f"(SELECT {_INTERACTION}, content_list, content_num FROM tiers)", ("desc", "introduction")),
        "tsv_test": "SELECT user_id, content_list FROM (SELECT DISTINCT user_id, content_list, k FROM reference_split WHERE part = 'test')",
        "tsv_quoted": _text_of("content_raw", _CONTENT_TEXTS),
        "fan_out_rows": f"SELECT {_INTERACTION} FROM rows_in_order",
        "fan_out_tiers": f"SELECT {_INTERACTION}, max(k) AS top FROM tiers GROUP BY {_INTERACTION}, id, block",
        "fan_out_splits": f"SELECT {_INTERACTION}, k, part FROM reference_split WHERE part <> 'test'",
        "log_csv": """
            SELECT id, user_id, CAST(event_id AS BIGINT) AS event_id, event_data, created_at FROM user_action""",
        "user_csv": "SELECT * FROM users",
        "user_without_sex": finals_user.replace("coalesce(CAST(sex AS BIGINT), 0) AS sex", "CAST(0 AS BIGINT) AS sex"),
        "strict_csv": _text_of("posts", ("title", "desc")),
        "lenient_csv": _text_of(
            """(SELECT id, user_id, title,""" + ", ".join(
                f'CASE WHEN id % 5 <> 2 THEN "{c}" END AS "{c}"'
                for c in ("subject_id", "desc", "praise_count", "reply_count", "forward_count", "star_count", "share_count", "create_time")
            ) + " FROM posts WHERE id % 5 NOT IN (1, 4))", ("title", "desc")
        ),
        "left_out_lines": "SELECT count(*) AS lines, count(*) FILTER (id % 5 = 1) AS lines_left_out FROM posts",
    }
    return {name: _query(final) for name, final in finals.items()}
