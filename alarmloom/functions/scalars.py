"""Column expressions used by the alarm jobs.  All stay inside Catalyst."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Message texts and codes the results must carry.
RECOVERY_PREFIX = "解除了报警,报警id为"
OFFLINE_ALARM_TEXT = "报警了"
OFFLINE_RECOVERY_TEXT = "报警了解除"
OFF_COUNT_RECOVERY_TEXT = "报警解除"
DISCONNECT_ALARM_TEXT = "达到报警 输出 报警了"
DISCONNECT_RECOVERY_TEXT = "恢复"
OFFLINE_RULE_ID = 1
OFF_COUNT_RULE_ID = 14
DISCONNECT_RULE_ID = 123
STATUS_OFF, STATUS_ON = "0", "1"
ALARM, RECOVERED = "0", "1"

# Characters trimmed from both ends of a value (U+0000 to U+0020).
BLANKS = "".join(chr(c) for c in range(0x21))


def trimmed(text: Column) -> Column:
    """The text without leading and trailing control characters and blanks."""
    return F.trim(text, F.lit(BLANKS))


def text_to_double(text: Column) -> Column:
    """Number in a text: empty gives 0, null or not a number gives null."""
    clean = trimmed(text)
    return F.when(clean == "", F.lit(0.0)).otherwise(clean.try_cast("double"))


def any_empty(*columns: tuple[Column, T.DataType] | Column) -> Column:
    """True when any argument is null, an empty text, or an empty collection.

    Arguments are columns (texts and scalars), or (column, type) pairs for
    arrays and maps.
    """
    tests = []
    for arg in columns:
        col, dtype = arg if isinstance(arg, tuple) else (arg, None)
        if isinstance(dtype, (T.ArrayType, T.MapType)):
            tests.append(col.isNull() | (F.size(col) == 0))
        else:
            tests.append(col.isNull() | (F.length(col.cast("string")) == 0))
    return reduce(lambda a, b: a | b, tests)


def typed_trigger(trigger: Column) -> Column:
    """A trigger (a struct of schemas.TRIGGER) with its numbers parsed.

    Meant for the rule side of a join, so that no bound is parsed per data point.
    """
    return F.struct(
        trigger["triggerCondition"].alias("condition"),
        F.coalesce(trigger["triggerConditionValType"], F.lit(0)).alias("kind"),
        text_to_double(trigger["triggerConditionAval"]).alias("a"),
        text_to_double(trigger["triggerConditionBval"]).alias("b"),
        text_to_double(F.coalesce(trigger["alarmDeadZone"], F.lit(""))).alias("zone"),
        trimmed(trigger["triggerConditionAval"]).alias("text"),
    )


def with_number(points: DataFrame, value: str = "val") -> DataFrame:
    """Data points with their trimmed text and their number, parsed once per point."""
    return points.withColumns(
        {"text": trimmed(F.col(value)), "number": text_to_double(F.col(value))}
    )


def trigger_holds(
    text: Column, number: Column, trigger: Column, literal: bool = False
) -> Column:
    """Whether a value (see with_number) meets a trigger (see typed_trigger).

    Conditions: 0 on, 1 off, 2 equals A, 3 above A, 4 below B, 5 between A and B,
    6 outside A and B.  Numeric bounds move by the dead zone; a value that is not
    a number meets no numeric condition.

    ``literal`` keeps the slips of the studied jobs: a numeric "equals" compares
    with the value type instead of A, "below B" tests above, 5 and 6 never hold.
    """
    condition = trigger["condition"]
    a, b, zone = trigger["a"], trigger["b"], trigger["zone"]
    numeric = trigger["kind"] == 0
    equals_text = (trigger["kind"] == 1) & (text == trigger["text"])
    if literal:
        equals = (numeric & (number == 0.0)) | equals_text
        below = numeric & (number > b - zone)
        between = outside = F.lit(False)
    else:
        equals = (numeric & (number == a)) | equals_text
        below = numeric & (number < b - zone)
        between = numeric & (number > a + zone) & (number < b - zone)
        outside = numeric & ((number < a - zone) | (number > b + zone))
    holds = (
        F.when(condition == "0", text == "1")
        .when(condition == "1", text == "0")
        .when(condition == "2", equals)
        .when(condition == "3", numeric & (number > a + zone))
        .when(condition == "4", below)
        .when(condition == "5", between)
        .when(condition == "6", outside)
    )
    return F.coalesce(holds, F.lit(False))


def equals_trigger(value: Column, condition: Column, a: Column) -> Column:
    """The one condition of the early jobs: text equality under condition 2."""
    return F.coalesce((condition == "2") & (value == a), F.lit(False))


def recovery_message(rule_id: Column) -> Column:
    return F.concat(F.lit(RECOVERY_PREFIX), rule_id.cast("string"))


def row_id(*business_key: Column) -> Column:
    """An id that a retried task computes again: a hash of the business key."""
    parts = [F.coalesce(c.cast("string"), F.lit("")) for c in business_key]
    return F.sha2(F.concat_ws("|", *parts), 256)


def literal_null(text: Column) -> Column:
    """The word "null" as a null."""
    return F.when(text != "null", text)
