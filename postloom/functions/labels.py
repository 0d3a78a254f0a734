"""Event labels and post ids, from the event code and the JSON payload."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

# The label of each event code; every other code, and null, is "neg".
EVENT_LABELS = {
    "thumb": (254, 248),
    "comment": (257, 249),
    "forward": (258, 256),
    "detail": (262, 263, 264, 310),
}
# The labels in product column order.
FLAGS = ("comment", "forward", "thumb", "detail", "neg")
MERGED_FLAGS = FLAGS[:4]


def _codes(codes: tuple[int, ...]) -> str:
    return ", ".join(map(str, codes))


def label() -> Column:
    """The label of `event_id`."""
    cases = " ".join(f"WHEN event_id IN ({_codes(codes)}) THEN '{name}'" for name, codes in EVENT_LABELS.items())
    return F.expr(f"CASE {cases} ELSE 'neg' END")


def is_positive() -> Column:
    """The same split as `label() != 'neg'`, in a form a Parquet scan can use."""
    return F.expr(f"event_id IN ({', '.join(map(_codes, EVENT_LABELS.values()))})")


def one_hot() -> list[str]:
    """One 0/1 column per label of `follow`."""
    return [f"int(follow = '{name}') AS {name}" for name in FLAGS]


_NUMBER = "try_variant_get(value, '$', 'bigint')"
_TEXT = r"regexp_replace(try_variant_get(value, '$', 'string'), r'^\s+|\s+$', '')"
_IS_OBJECT = r"event_data RLIKE r'^\s*\{'"
# An object without inner braces ends at its one brace. Others are parsed once more, as the only entry of a list.
_ENDS_THERE = r"""coalesce(event_data RLIKE r'^\s*\{[^{}]*\}\s*$'
    OR size(from_json(concat('[', event_data, ']'), 'array<variant>', map('allowSingleQuotes', 'false'))) = 1, false)"""
# Nearly all payloads end at the first branch; the others need the kind of the value.
_CONTENT_ID = rf"""
    CASE WHEN {_NUMBER} IS NOT NULL THEN {_NUMBER}
         WHEN NOT {_IS_OBJECT} THEN CASE WHEN try_parse_json(event_data) IS NOT NULL THEN 0L END
         WHEN schema_of_variant(value) = 'STRING' THEN CASE
             WHEN {_TEXT} RLIKE '^[+-]?[0-9]+(_[0-9]+)*$'
             THEN coalesce(try_cast(replace({_TEXT}, '_', '') AS BIGINT), 0L) ELSE 0L END
         WHEN isnan(try_variant_get(value, '$', 'double')) THEN 0L END
"""


def with_content_id(log: DataFrame, strict: bool = False) -> DataFrame:
    """Add `content_id`, and `bad_json` for payloads that carry no usable value.

    A payload that is no object gives 0, an object without the key gives null. Texts that are no
    whole number give 0, fractions are cut off. Broken JSON and null, list or object values are
    `bad_json` with a null id; `strict` raises on them instead, and on text after the object as well,
    which is ignored otherwise.
    """
    found = (
        log.selectExpr(
            "*",
            # As a generator the parse runs once per row. As a plain column it would be copied into
            # each later filter on the id, and run again for every use there.
            "inline(array(from_json(event_data, 'content_id variant, broken string',"
            " map('columnNameOfCorruptRecord', 'broken', 'allowSingleQuotes', 'false')))) AS (value, broken)",
        )
        .selectExpr("*", f"explode(array({_CONTENT_ID})) AS content_id")
        .withColumn(
            "bad_json",
            F.expr(f"content_id IS NULL AND NOT coalesce(value IS NULL AND broken IS NULL AND {_IS_OBJECT}, false)"),
        )
    )
    if strict:
        found = found.withColumn("bad_json", F.expr(f"bad_json OR ({_IS_OBJECT} AND NOT {_ENDS_THERE})"))
        refuse = "raise_error(concat('no usable content_id in event_data: ', coalesce(event_data, 'null')))"
        found = found.withColumn("content_id", F.expr(f"CASE WHEN bad_json THEN {refuse} ELSE content_id END"))
    return found.drop("value", "broken")


def labelled(
    log: DataFrame, missing: str, strict: bool = False, counts: Observation | None = None
) -> DataFrame:
    """One row per usable log row: id, user_id, content_id, follow, created_at.

    Rows with an unusable payload (`bad_json`) are left out. `missing` says what a row without a
    content id means: "drop" leaves the row out, together with rows that lack a user, code or time;
    "zero" keeps the row under id 0. `counts` receives how many rows there were and how many payloads
    were unusable, once the result is computed.
    """
    rows = with_content_id(log, strict)
    if counts is not None:
        rows = rows.observe(counts, F.count("*").alias("log_rows"), F.count_if("bad_json").alias("bad_json"))
    rows = rows.where("NOT bad_json")
    if missing == "drop":
        rows = rows.na.drop("any", subset=["user_id", "event_id", "content_id", "created_at"])
    elif missing == "zero":
        rows = rows.na.fill(0, subset=["content_id"])
    else:
        raise ValueError(f"missing must be 'drop' or 'zero', not {missing!r}")
    return rows.select("id", "user_id", "content_id", label().alias("follow"), "created_at")
