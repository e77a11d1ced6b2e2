"""Keeping the mapping tables up to date from change messages."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from alarmloom.functions.parsing import explode_rule_ids
from alarmloom.operators.hotkeys import DEFAULT_POLICY, SplitPolicy
from alarmloom.operators.timeline import Timeline, last_seen

# Codes in rule change messages.
UNIQUE_POINT, TEMPLATE_POINT, COMPUTED_POINT = "0", "1", "2"
ADD, MODIFY, DELETE = "0", "1", "2"

BEFORE_ALL_US = -62_135_596_800_000_000 * 2 - 1  # twice the first of year one, less one


def point_rule_mapping(
    changes: DataFrame, ts: str, seq: str, policy: SplitPolicy = DEFAULT_POLICY
) -> DataFrame:
    """The mapping (type, id, rule_id) after a log of rule changes.

    A delete drops all rules of a point; what is added after the last delete
    stays.  One row per add, so a rule added twice is there twice, with the order
    it was added in (``ts``, ``seq``).  ``changes`` are parsed messages; their rule
    lists are exploded last, for the few that count.

    One pass: the log is read backwards per point, and an add counts as long as no
    delete has been met.
    """
    backwards = {
        "__ts": F.timestamp_micros(-F.unix_micros(F.col(ts))),
        "__seq": -F.col(seq),
    }
    deleted = F.when(F.col("action") == DELETE, F.lit(True))
    live = (
        Timeline(changes.withColumns(backwards), ["type", "id"], "__ts", "__seq", policy)
        .scan(__deleted=last_seen(deleted))
        .filter((F.col("action") == ADD) & F.col("__deleted").isNull())
    )
    return explode_rule_ids(live.select("type", "id", "rule_ids", ts, seq))


def apply_rule_changes(
    current: DataFrame, changes: DataFrame, ts: str, seq: str
) -> DataFrame:
    """The next version of a mapping (type, id, rule_id) after some more changes.

    Applying a log piece by piece in order gives the same mapping as applying it
    at once.
    """
    deleted = changes.filter(F.col("action") == DELETE).select("type", "id")
    kept = current.join(deleted.distinct(), ["type", "id"], "left_anti")
    added = point_rule_mapping(changes, ts, seq)
    columns = ["type", "id", "rule_id"]
    return kept.select(columns).unionByName(added.select(columns))


def cached_rules(
    changes: DataFrame, ts: str, seq: str, policy: SplitPolicy = DEFAULT_POLICY
) -> DataFrame:
    """Rule ids whose details are held after a log of rule changes.

    Adding or modifying a rule loads its details.  Deleting a unique point drops
    the details of every rule the point had at that time.  A rule is held when it
    was loaded after it was last dropped.
    """
    at = F.struct(F.col(ts).alias("t"), F.col(seq).alias("s"))
    loads = (
        explode_rule_ids(changes.filter(F.col("action").isin(ADD, MODIFY)))
        .groupBy("rule_id")
        .agg(F.max(at).alias("__loaded"))
    )
    # The next delete after an add is the last delete seen in reversed time.
    back = changes.filter(
        (F.col("type") == UNIQUE_POINT) & F.col("action").isin(ADD, DELETE)
    ).withColumns(
        {
            "__back": F.timestamp_micros(-F.unix_micros(F.col(ts))),
            "__seq": -F.col(seq),
        }
    )
    deleted = last_seen(F.when(F.col("action") == DELETE, at))
    dropped = (
        Timeline(back, ["id"], "__back", "__seq", policy)
        .scan(__gone=deleted)
        .filter((F.col("action") == ADD) & F.col("__gone").isNotNull())
        .select("rule_ids", "__gone")
    )
    drops = (
        explode_rule_ids(dropped)
        .groupBy("rule_id")
        .agg(F.max("__gone").alias("__dropped"))
    )
    return (
        loads.join(drops, "rule_id", "left")
        .filter(
            F.col("__dropped").isNull() | (F.col("__loaded") > F.col("__dropped"))
        )
        .select("rule_id")
    )


def rules_of_changed_points(changes: DataFrame, elements: DataFrame) -> DataFrame:
    """The early form: a change of a unique point reads its rules again."""
    points = changes.filter(F.col("type") == UNIQUE_POINT).select(
        F.col("id").alias("unique_data_point_id")
    )
    return elements.join(points, "unique_data_point_id", "left_semi").select(
        "sn", "unique_data_point_id", "rule_id"
    )


def as_text_list(mapping: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """A flat mapping as comma separated texts, for consumers that want them.

    A text holds all values of its key, so use it on mappings with short lists.
    """
    items = F.sort_array(F.collect_list(F.col(value).cast("string")))
    return mapping.groupBy(*keys).agg(F.array_join(items, ",").alias(value))


def replace_keys(
    target: DataFrame, fresh: DataFrame, key: str, changed: DataFrame
) -> DataFrame:
    """Rows of the changed keys replaced by the fresh ones.

    A changed key that is absent from ``fresh`` disappears; other keys stay.
    """
    names = changed.select(key).distinct()
    kept = target.join(names, key, "left_anti")
    return kept.unionByName(fresh.join(names, key, "left_semi"))


def resync_alarm_controls(
    target: DataFrame, rules: DataFrame, changed: DataFrame
) -> DataFrame:
    """(alarm_id, control_id) after a change of the listed alarm rules."""
    fresh = rules.select(
        F.col("rely_rule_id").try_cast("bigint").alias("alarm_id"),
        F.col("id").alias("control_id"),
    ).filter(F.col("alarm_id").isNotNull())
    return replace_keys(target, fresh, "alarm_id", changed)


def rebind_machines(
    target: DataFrame, relation: DataFrame, changed: DataFrame
) -> DataFrame:
    """(sn, machine_id) after gateways were bound or unbound.

    ``changed`` holds (sn, bind).  An unbound gateway is read again and vanishes
    when it has no machine left; a bound one is read again but never vanishes.
    """
    fresh = relation.select(F.col("device_sn").alias("sn"), "machine_id")
    present = changed.join(fresh, "sn", "left_semi")
    gone = changed.filter(~F.col("bind"))
    return replace_keys(
        target, fresh, "sn", present.select("sn").unionByName(gone.select("sn"))
    )


def resync_gateway_points(
    target: DataFrame, relation: DataFrame, changed: DataFrame
) -> DataFrame:
    """(sn, device_template_point_id, id) after gateways' points changed."""
    fresh = relation.select(
        F.col("device_no").alias("sn"), "device_template_point_id", "id"
    )
    return replace_keys(target, fresh, "sn", changed)


def as_of_changes(
    rows: DataFrame,
    changes: DataFrame,
    key: str,
    ts: str,
    tie: str,
    value: Column,
    name: str,
    policy: SplitPolicy = DEFAULT_POLICY,
) -> DataFrame:
    """Each row with the latest change of its key at or before its time.

    The batch form of data beside a change stream: both are put on one timeline
    (a change at the same instant comes first), so a key's rows and changes meet
    in one shuffle and hot keys are split like any other timeline.  A row without a time
    has no version, but passes: it goes before all changes.
    """
    boxed = F.struct(value.alias("v"))
    dtype = changes.select(boxed.alias("b")).schema["b"].dataType

    def at(side: int) -> Column:
        # Twice the time plus the side: changes come first at the same instant.
        return F.timestamp_micros(F.unix_micros(F.col(ts)) * 2 + side)

    first = F.timestamp_micros(F.lit(BEFORE_ALL_US))
    data = rows.withColumns(
        {"__c": F.lit(None).cast(dtype), "__at": F.coalesce(at(1), first)}
    )
    log = changes.select(key, tie, boxed.alias("__c"), at(0).alias("__at")).filter(
        F.col("__at").isNotNull()
    )
    both = data.unionByName(log, allowMissingColumns=True)
    seen = Timeline(both, [key], "__at", tie, policy).scan(
        __seen=last_seen(F.col("__c"))
    )
    return seen.filter(F.col("__c").isNull()).select(
        *rows.columns, F.col("__seen")["v"].alias(name)
    )
