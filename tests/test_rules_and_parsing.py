"""Parsers, rule lookups, change handling and control commands on small inputs."""

import pytest
from pyspark.sql import functions as F

from alarmloom import schemas
from alarmloom.functions import parsing as X
from alarmloom.functions import scalars as S
from alarmloom.operators import changes as C
from alarmloom.operators import control as K
from alarmloom.operators import rules as R
from alarmloom.operators.hotkeys import CHUNK, CHECKED, SplitPolicy, split_hot_keys
from alarmloom.operators import alarms as A
from alarmloom.plans import testbed as B
from alarmloom.sources.readers import MessageSource, dimension
from alarmloom.sources.sinks import as_json


def lines(spark, *texts):
    return spark.createDataFrame([(t,) for t in texts], "value string")


def test_gateway_messages(spark):
    good = ('{"deviceId":"sn123","dataPoints":[{"dataPointId":1,"timeMs":1000,'
            '"value":"20","err":0},{"dataPointId":2,"timeMs":1000,"value":"x","err":3},'
            '{"dataPointId":3,"timeMs":1000,"value":"y"}]}')
    empty = '{"deviceId":"sn1","dataPoints":[]}'
    none = '{"deviceId":"sn1"}'
    df = X.parse_messages(lines(spark, good, empty, none, "not json"))
    assert [tuple(r) for r in df.drop("ts").collect()] == [("sn123", 1, "20", 0, 1000)]
    as_bytes = lines(spark, good).select(F.encode("value", "utf-8").alias("value"))
    assert X.parse_messages(as_bytes).count() == 1
    nested = '{"deviceDataPointDto":{"parsedDataPointMessages":' + good + "}}"
    assert X.parse_nested_messages(lines(spark, nested)).first().sn == "sn123"


def test_text_lines(spark):
    row = X.parse_status_lines(lines(spark, "a,0,1000")).first()
    assert (row.sn, row.status, row.time_ms, row.ts.second) == ("a", "0", 1000, 1)
    row = X.parse_point_lines(lines(spark, "sn123,5,1,9,20")).first()
    assert tuple(row) == ("sn123", 5, 1, 9, "20")
    assert tuple(X.parse_pair_lines(lines(spark, "a,1")).first()) == ("a", "1")
    assert X.parse_named_lines(lines(spark, "x,1000")).first().name == "x"
    short = X.parse_status_lines(lines(spark, "a")).first()
    assert short.status is None and short.ts is None


def test_element_text(spark):
    text = "10-sn123-1-null-null#10-sn123-2-null-7"
    df = X.explode_element_text(lines(spark, text), "value")
    assert [tuple(r) for r in df.orderBy("pos").collect()] == [
        (0, "10", "sn123", 1, None, None), (1, "10", "sn123", 2, None, 7)
    ]


def test_numbers_and_equality(spark):
    df = lines(spark, "123", "123.00", " 7 ", "", "x").select(
        S.text_to_double(F.col("value")).alias("n"))
    assert [r.n for r in df.collect()] == [123.0, 123.0, 7.0, 0.0, None]


CHANGES = [  # ts, seq, type, action, id, rule ids
    (1, 1, "0", "0", 5, "1,2"), (2, 2, "0", "0", 5, "3"), (3, 3, "0", "2", 5, "1"),
    (4, 4, "0", "0", 5, "4"), (5, 5, "1", "0", 5, "9"), (6, 6, "0", "1", 5, "2"),
    (7, 7, "2", "0", 8, "3"), (8, 8, "2", "2", 8, "3"),
]


def test_rule_changes(spark):
    df = spark.createDataFrame(CHANGES, "t long, seq long, type string, actionType "
                               "string, id int, ruleId string")
    messages = df.select(
        F.timestamp_seconds("t").alias("ts"), "seq",
        F.to_json(F.struct("type", "actionType", "id", "ruleId")).alias("value"))
    changes = X.parse_rule_changes(messages)
    got = C.point_rule_mapping(changes, "ts", "seq").select("type", "id", "rule_id")
    assert sorted(map(tuple, got.collect())) == [("0", 5, 4), ("1", 5, 9)]
    text = C.as_text_list(got, ["type", "id"], "rule_id")
    assert sorted(map(tuple, text.collect())) == [("0", 5, "4"), ("1", 5, "9")]
    # 1, 2, 3 were dropped with point 5; 2 was loaded again by a modify, 3 by an add;
    # deleting a computed point drops no details.
    held = C.cached_rules(changes, "ts", "seq")
    assert sorted(r.rule_id for r in held.collect()) == [2, 3, 4, 9]
    split = C.cached_rules(changes, "ts", "seq",
                           SplitPolicy(target_rows=1))
    assert sorted(r.rule_id for r in split.collect()) == [2, 3, 4, 9]


def test_bind_and_unbind(spark):
    target = spark.createDataFrame([("a", 1), ("b", 2), ("c", 3), ("d", 4)],
                                   "sn string, machine_id long")
    relation = spark.createDataFrame([("a", 11), ("a", 12), ("c", 13)],
                                     "device_sn string, machine_id long")
    changed = X.parse_device_machine_changes(lines(
        spark, '{"snUnbind":"a,b"}', '{"snBind":"c,d","snUnbind":""}'))
    got = C.rebind_machines(target, relation, changed)
    # b is gone, a and c are read again, d stays although it has no machine now
    assert sorted(map(tuple, got.collect())) == [
        ("a", 11), ("a", 12), ("c", 13), ("d", 4)]


@pytest.mark.parametrize("policy", [SplitPolicy(),
                                    SplitPolicy(target_rows=2)])
def test_as_of_changes(spark, policy):
    rows = spark.createDataFrame(
        [("a", 1, 1), ("a", 5, 2), ("a", 6, 3), ("b", 5, 4), ("a", 9, 5), ("a", 9, 6)],
        "sn string, t long, id long").withColumn("ts", F.timestamp_seconds("t"))
    log = spark.createDataFrame([("a", 5, 1, "x"), ("a", 7, 2, None), ("a", 8, 3, "y")],
                                "sn string, t long, id long, v string"
                                ).withColumn("ts", F.timestamp_seconds("t"))
    out = C.as_of_changes(rows, log, "sn", "ts", "id", F.col("v"), "v", policy)
    assert {r.id: r.v for r in out.collect()} == {
        1: None, 2: "x", 3: "x", 4: None, 5: "y", 6: "y"}


ACTION = ('{"controlActionDtos":[{"controlType":1,"controlDataPointId":7,'
          '"controlUniqueDataPointId":70,"controlData":"on"}]}')


def test_control_commands(spark):
    """Gateway, device and template elements; the first matching element counts."""
    rules = spark.createDataFrame(
        [(r, None, '{"triggerCondition":"0"}', "0", 0, 0) for r in (1, 2, 3, 4)],
        "id long, rely_rule_id string, trigger string, trigger_type string,"
        "del_flag int, status int")
    elements = spark.createDataFrame(
        [(1, "0", 100, 5, 0, 1), (2, "1", 200, 5, 0, 1), (2, "0", 201, 5, 0, 2),
         (3, "2", 300, 0, 9, 1), (4, "0", 400, 6, 0, 1)],
        "rule_id long, element_type string, machine_id long,"
        "unique_data_point_id long, data_point_id long, position long"
    ).withColumn("del_flag", F.lit(0))
    actions = spark.createDataFrame([(r, ACTION, "2", "0") for r in (1, 2, 3, 4)],
                                    "rule_id long, action string, action_type string,"
                                    "execute_mode string")
    details = R.rule_details(rules, elements, actions)
    rows = spark.createDataFrame([(r, 5, 9, "gw", f"u{r}") for r in (1, 2, 3, 4)],
                                 "rule_id long, unique_data_point_id long,"
                                 "datapoint_id long, sn string, uuid string")
    points = spark.createDataFrame([(77, "gw", 7), (78, "other", 7)],
                                   "id long, device_no string,"
                                   "device_template_point_id long")
    machines = spark.createDataFrame([("gw", 31), ("gw", 32), ("other", 33)],
                                     "device_sn string, machine_id long")
    matched = K.match_elements(rows.join(details, "rule_id"), elements)
    flat = K.control_commands(matched, points, machines)
    assert flat.count() == 4  # the template command has a row per machine
    got = {r.rule_id: (r.alarm_uuid, r.control_machine_ids, r.unique_data_point_id)
           for r in K.with_machine_lists(flat).collect()}
    assert got == {1: ("u1", [], 70), 2: ("u2", [200], 70), 3: ("u3", [31, 32], 77)}


def test_rule_without_action_or_elements(spark):
    rules = spark.createDataFrame(
        [(1, None, "{}", "0", 0, 0), (2, None, "{}", "0", 0, 0), (3, None, "{}", "0", 1, 0)],
        "id long, rely_rule_id string, trigger string, trigger_type string,"
        "del_flag int, status int")
    elements = spark.createDataFrame(
        [(1, 10, "0", 100, 5, None, None, "a", None, 0), (1, 9, "0", 99, 5, None, None,
                                                          "a", None, 0)],
        "rule_id long, id long, element_type string, machine_id long,"
        "unique_data_point_id long, template_id long, data_point_id long, sn string,"
        "opera_data_point_id long, del_flag int")
    actions = spark.createDataFrame([], "rule_id long, action string,"
                                    "action_type string, execute_mode string")
    flat = R.assemble_rules(R.active_rule_elements(rules, elements), actions)
    nested = R.nest_elements(flat).collect()
    assert [(r.id, r.rule_action, len(r.element_list)) for r in nested] == [(1, None, 2)]


def test_chunks_carried_through_the_rule_join(spark, small_dir):
    """Points split before their keys are extended give the same alarms."""
    policy = SplitPolicy(target_rows=10)
    points = B.points(spark, small_dir)
    rules = B.unique_rules(spark, small_dir)
    split, done = split_hot_keys(points, ["unique_data_point_id"], "ts", "event_id",
                                 policy)
    assert done

    def alarms(rows):
        tagged = rows.join(rules, "unique_data_point_id").withColumn(
            "holds", (F.col("event_id") + F.col("rule_id")) % 4 != 0)
        out = A.delayed_alarms(tagged, ["unique_data_point_id", "rule_id"], "holds",
                               F.lit(100_000), policy=CHECKED)
        return out.select("unique_data_point_id", "rule_id", "event_id", "emit_us",
                          "recover")

    assert split.select(CHUNK).distinct().count() > 3
    assert sorted(alarms(split).collect()) == sorted(alarms(points).collect())


def test_sources_and_sinks(spark, tmp_path):
    topic = tmp_path / "rule-changes"
    topic.mkdir()
    (topic / "a.txt").write_text('{"id":1,"type":"0","actionType":"0","ruleId":"1,2"}\n')
    source = MessageSource(spark, folder=str(tmp_path), streaming=False)
    assert X.explode_rule_ids(source.rule_changes()).count() == 2
    assert source.machine_mapper_changes().count() == 1
    stream = MessageSource(spark, folder=str(tmp_path)).rule_changes()
    assert stream.isStreaming
    spark.range(3).selectExpr("id as rule_id").write.parquet(str(tmp_path / "rule_action"))
    assert dimension(spark, "rule_action", folder=str(tmp_path)).count() == 3
    with pytest.raises(ValueError):
        dimension(spark, "other", folder=str(tmp_path))
    assert as_json(spark.range(1)).first().value == '{"id":0}'


def test_topic_options(spark):
    stream = MessageSource(spark, servers="b:9092", group="g", max_offsets_per_trigger=500)
    assert stream.topic_options("points") == {
        "kafka.bootstrap.servers": "b:9092", "subscribe": "points",
        "startingOffsets": "latest", "kafka.group.id": "g", "maxOffsetsPerTrigger": "500"}
    start = '{"points":{"0":23}}'
    bounded = MessageSource(spark, servers="b:9092", streaming=False)
    assert bounded.topic_options("points")["startingOffsets"] == "earliest"
    resumed = MessageSource(spark, servers="b:9092", streaming=False, starting_offsets=start)
    assert resumed.topic_options("points")["startingOffsets"] == start
    assert resumed.topic_options("points")["endingOffsets"] == "latest"


def test_rows_without_a_time_pass_with_no_version(spark):
    rows = spark.createDataFrame([("a", None, 1), ("a", 5, 2)], "sn string, t long, id long"
                                 ).withColumn("ts", F.timestamp_seconds("t"))
    log = spark.createDataFrame([("a", 1, 1, "x")], "sn string, t long, id long, v string"
                                ).withColumn("ts", F.timestamp_seconds("t"))
    out = C.as_of_changes(rows, log, "sn", "ts", "id", F.col("v"), "v")
    assert {r.id: r.v for r in out.collect()} == {1: None, 2: "x"}


def test_equal_actions_are_commands_of_their_own(spark):
    action = ('{"controlActionDtos":[{"controlType":1,"controlDataPointId":7,'
              '"controlUniqueDataPointId":70,"controlData":"on"},{"controlType":1,'
              '"controlDataPointId":7,"controlUniqueDataPointId":70,"controlData":"on"}]}')
    row = spark.createDataFrame([("u", 1, 5, 9, "gw", "{}", action)],
                                "uuid string, rule_id long, unique_data_point_id long,"
                                "datapoint_id long, sn string, trigger_json string, a string")
    row = row.withColumn("action", F.from_json("a", schemas.ACTION))
    elements = spark.createDataFrame(
        [(1, "1", 200, 5, 0, 1, 0)],
        "rule_id long, element_type string, machine_id long, unique_data_point_id long,"
        "data_point_id long, position long, del_flag int")
    points = spark.createDataFrame([], "id long, device_no string,"
                                   "device_template_point_id long")
    machines = spark.createDataFrame([], "device_sn string, machine_id long")
    flat = K.control_commands(K.match_elements(row, elements), points, machines)
    assert flat.select("control_uuid").distinct().count() == 2
    assert K.with_machine_lists(flat).count() == 2


def test_one_scan_for_both_mappings(spark, small_dir):
    from alarmloom.plans.catalog import QUERIES

    plan = QUERIES["tagged_points"](spark, small_dir)._jdf.queryExecution().toString()
    physical = plan.split("== Physical Plan ==")[1]
    assert physical.count("events.parquet") == 1
