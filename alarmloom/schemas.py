"""Schemas of messages, dimension tables and JSON payloads.

Fixed values: field and column names are those of the messages and tables read.
"""

from __future__ import annotations

# Messages ------------------------------------------------------------------

GATEWAY_MESSAGE = (
    "deviceId string, "
    "dataPoints array<struct<dataPointId:int,timeMs:bigint,value:string,err:int>>"
)
NESTED_GATEWAY_MESSAGE = (
    "deviceDataPointDto struct<parsedDataPointMessages:"
    "struct<deviceId:string,dataPoints:"
    "array<struct<dataPointId:int,timeMs:bigint,value:string,err:int>>>>"
)
RULE_CHANGE = "id int, type string, actionType string, ruleId string"
ALARM_CONTROL_CHANGE = "alarmRuleId array<int>"
DEVICE_MACHINE_CHANGE = "snUnbind string, snBind string"
DEVICE_POINT_CHANGE = "sn array<string>"

# JSON carried inside rule rows ---------------------------------------------

TRIGGER = (
    "triggerCondition string, triggerConditionAval string, "
    "triggerConditionBval string, triggerConditionValType int, "
    "alarmMsg string, delayTime int, alarmDeadZone string"
)
CONTROL_ACTION = (
    "controlType:int,controlOperaDataPoint:int,controlDataPointId:int,"
    "controlUniqueDataPointId:int,controlObj:int,controlObjType:int,"
    "controlData:string,executeYear:int,executeMonth:int,executeDay:int,"
    "executeWeek:int,executeHour:int,executeMinute:int,executeSecond:int,"
    "executeInterval:int,startDt:string,endDt:string,cron:string"
)
ACTION = (
    "pushInterval int, pushFrequency int, pushWay string, controlObjType int, "
    f"controlObj string, controlActionDtos array<struct<{CONTROL_ACTION}>>"
)

# Dimension tables ----------------------------------------------------------

RULE = (
    "id bigint, rely_rule_id string, `trigger` string, trigger_type string, "
    "del_flag int, status int"
)
RULE_MONITOR_ELEMENT = (
    "id bigint, rule_id bigint, element_type string, machine_id bigint, "
    "device_id string, unique_data_point_id bigint, template_id bigint, "
    "data_point_id bigint, opera_data_point_id bigint, sn string, del_flag int"
)
RULE_ACTION = "rule_id bigint, action string, action_type string, execute_mode string"
DEVICE_TEMPLATE_POINT_REL = (
    "id bigint, device_no string, device_template_point_id bigint"
)
MACHINE_DEVICE_REL = "device_sn string, machine_id bigint"
