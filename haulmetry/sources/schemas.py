"""Declared schema of every source table, under neutral names.

FIXTURES.md describes the columns. A deployment maps these names to its own tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.types import StructType

_PARAMS = "array<struct<key: string, value: struct<string_value: string>>>"

SCHEMAS = {
    "app_events": f"event_date string, event_name string, event_params {_PARAMS}, user_properties {_PARAMS}, "
    "app_info struct<id: string, version: string>",
    "release_events": "app_version string, event_date timestamp_ntz",
    "demands": "id bigint, metadata string, created timestamp_ntz, consigner_user_code string, status string, "
    "vehicle_type_id bigint",
    "demand_addresses": "demand_id bigint, created timestamp_ntz",
    "consignments": "id bigint, demand_id bigint, code string, state string, deleted string, "
    "created timestamp_ntz, vehicle_number string, operator_code string, offline_metadata string",
    "demand_feedback": "demand_id bigint, rating int, remarks string, reasons string, updated timestamp_ntz, "
    "deleted string",
    "consigners": "code string, name string, type string, sales_manager string, deleted string",
    "consignment_states": "consignment_code string, state string, time bigint, remarks string, "
    "updated timestamp_ntz, updated_by string, deleted string",
    "vehicle_types": "id bigint, body_type string, tyre_count int",
    "demand_comments": "demand_id bigint, remarks string, created timestamp_ntz",
    "demand_tokens": "demand_id bigint, operator_code string, status string",
    "quotations": "operator_code string, demand_id bigint, created timestamp_ntz, app_response_details string",
    "rate_inputs": "user_code string, rate double, active string",
    "damage_claims": "consignment_code string, created timestamp_ntz, type string, reason string, "
    "claim_status string, consigner_assessed_amount double, assessed_damage_amount double, "
    "final_closure_amount double, metadata string, deleted string",
    "expenses": "consignment_id string, amount double, category string, party_type string, deleted string",
    "operator_transactions": "consignment_id string, amount double, created timestamp_ntz, "
    "updated timestamp_ntz, type string, status string, category string, deleted string",
    "bank_payments": "code string, amount double, otherparty string, status string, created timestamp_ntz, "
    "actpaidtime timestamp_ntz, opsremarks string",
    "trip_reports": "demand_id bigint, consignment_code string, consigner_type string, consigner_code string, "
    "op_freight double, tds_value string, tds_amount double, vehicle_state string, "
    "unloading_done_time timestamp_ntz, trip_start_time timestamp_ntz",
    "subscriptions": "user_code string, created_at timestamp_ntz, deleted string",
    "operator_profiles": "user_code string, kyc_status string, deleted string",
    "tickets": "id bigint, ticket_code string, created timestamp_ntz, updated timestamp_ntz, status string, "
    "source string, subject string, description string, assigned_to string, created_by string, "
    "updated_by string, reporting_to string, deleted string",
    "ticket_field_values": "ticket_id bigint, custom_field_id int, date_value bigint, string_value string, "
    "number_value bigint, updated timestamp_ntz, deleted string",
    "ticket_activity": "ticket_id bigint, field string, new_value string, updated timestamp_ntz",
    "vehicles": "id bigint, vehicle_number string",
    "vehicle_details": "vehicle_number string, device_name string, device_family string, hardware_type string, "
    "sim_network string, vehicle_state string",
    "device_history": "vehicle_id bigint, action string, from_time bigint, to_time bigint",
    "call_records": "call_id string, user_disposition_code string, product string, call_time timestamp_ntz",
    "call_crm": "call_id string, disposition_code string, c_type string",
}


def schema(name: str) -> StructType:
    return StructType.fromDDL(SCHEMAS[name])


def conform(df: DataFrame, name: str) -> DataFrame:
    """Keep the declared columns in order; fail on a missing column or a different type."""
    declared = schema(name)
    actual = {field.name: field.dataType for field in df.schema}
    missing = [field.name for field in declared if field.name not in actual]
    if missing:
        raise ValueError(f"{name}: missing columns {missing}")
    wrong = [
        f"{field.name} is {actual[field.name].simpleString()}, not {field.dataType.simpleString()}"
        for field in declared
        if actual[field.name].simpleString() != field.dataType.simpleString()
    ]
    if wrong:
        raise ValueError(f"{name}: {'; '.join(wrong)}")
    return df.select(*declared.names)
