"""The given tables read as the library's source tables.

Every source is a projection of one whole table, stated once as expressions that both engines
understand; a ``Dialect`` supplies the few spellings that differ.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from haulmetry.operators.cancellations import CANCEL_RULES
from haulmetry.sources.schemas import conform

APP_ID = "app.shipper"
DAMAGE_ASSIGNEE = "damage@acme.test"
LINK_BASE = "https://portal.acme.test/tickets?tid="
PARTIAL_PATTERNS = ("%#acme_ptl%", "%acme ptl%")
PAYMENT_PARTIAL_PATTERNS = ("%acme_ptl%",)
PORTAL, TRIP_TICKETS = "PORTAL", "MATRIX"
EXCLUDED_CUSTOMERS = ("C7", "C19", "C23")

START = 1_704_067_200  # 2024-01-01, first day of the derived trips


class SparkDialect:
    @staticmethod
    def epoch(ts):
        return f"cast(cast({ts} - timestamp_ntz'1970-01-01 00:00:00' as interval second) as bigint)"

    @staticmethod
    def at(seconds):
        return f"timestamp_ntz'1970-01-01 00:00:00' + make_dt_interval(0, 0, 0, cast({seconds} as decimal(18,6)))"

    @staticmethod
    def plus_days(ts, days):
        return f"{ts} + interval '{days}' day"

    @staticmethod
    def json_int(doc, key):
        return f"cast(get_json_object({doc}, '$.{key}') as int)"

    @staticmethod
    def pick(items, index):
        return f"element_at(array({', '.join(items)}), cast({index} as int))"

    @staticmethod
    def day_text(ts):
        return f"date_format({ts}, 'yyyyMMdd')"

    @staticmethod
    def pairs(*pairs):
        entries = [f"named_struct('key', {k}, 'value', named_struct('string_value', {v}))" for k, v in pairs]
        return f"array({', '.join(entries)})"

    @staticmethod
    def struct(**fields):
        return "named_struct(" + ", ".join(f"'{k}', {v}" for k, v in fields.items()) + ")"


class DuckDialect:
    @staticmethod
    def epoch(ts):
        return f"cast(floor(epoch({ts})) as bigint)"

    @staticmethod
    def at(seconds):
        return f"make_timestamp(cast(({seconds}) * 1000000 as bigint))"

    @staticmethod
    def plus_days(ts, days):
        return f"{ts} + interval '{days}' day"

    @staticmethod
    def json_int(doc, key):
        return f"cast(json_extract_string({doc}, '$.{key}') as int)"

    @staticmethod
    def pick(items, index):
        return f"([{', '.join(items)}])[{index}]"

    @staticmethod
    def day_text(ts):
        return f"strftime({ts}, '%Y%m%d')"

    @staticmethod
    def pairs(*pairs):
        return "[" + ", ".join(f"{{'key': {k}, 'value': {{'string_value': {v}}}}}" for k, v in pairs) + "]"

    @staticmethod
    def struct(**fields):
        return "{" + ", ".join(f"'{k}': {v}" for k, v in fields.items()) + "}"


def _text(expr: str) -> str:
    return f"cast({expr} as string)"


def _trip_base(key: str) -> str:
    return f"({START} + ({key} % 700) * 86400)"


def sources(d) -> dict[str, tuple[str, dict[str, str]]]:
    """Source name to (given table, column expressions)."""
    k = "k"  # number kept in the props of an event, read once per row
    shifted = d.plus_days("o_orderdate", 9000)
    demand_json = (
        "case when o_orderkey % 29 = 0 then null when o_orderkey % 31 = 0 then '{\"ptl\": ' else '{' "
        "|| case when o_orderkey % 17 = 0 then '\"ptl\": \"true\", ' when o_orderkey % 17 < 9 "
        "then '\"ptl\": \"false\", ' else '' end "
        "|| '\"appLoadingTime\": \"' || case when o_orderkey % 11 = 0 then '' else "
        f"{_text(_trip_base('o_orderkey') + ' + 180000 + (o_custkey % 400) * 60')} end || '\"' "
        "|| ', \"estimatedRouteDistance\": \"' || case when o_orderkey % 13 = 0 then '0' when o_orderkey % 13 = 1 "
        f"then '' else {_text('o_orderkey % 900')} || '.7' end || '\"' "
        "|| case when o_orderkey % 3 = 0 then ', \"shipperTATinHrs\": \"48\"' when o_orderkey % 3 = 1 "
        "then ', \"shipperTATinHrs\": \"\"' else '' end "
        "|| case when o_orderkey % 4 = 0 then ', \"operatorTATinHrs\": \"36.5\"' else '' end "
        "|| case o_orderkey % 5 when 1 then ', \"specialRequestBody\": {\"overHeight\": \"2.5\"}' "
        "when 2 then ', \"specialRequestBody\": {\"overWeight\": \"true\", \"openDala\": \"false\"}' "
        "when 3 then ', \"specialRequestBody\": {\"expressDeliveryTat\": \"24\", \"extraRope\": \"false\"}' "
        "when 4 then ', \"specialRequestBody\": {\"overHeight\": \"0\", \"helperRequired\": \"false\"}' "
        "else '' end || '}' end"
    )
    proof_json = (
        "'{\"podStatus\": \"' || case when o_orderkey % 3 = 2 then 'PENDING' else 'VERIFIED' end "
        "|| '\", \"podValidity\": \"' || case when o_orderkey % 5 = 0 then 'BAD' else 'OK' end "
        "|| '\", \"podCollectedDate\": \"' || case when o_orderkey % 7 = 0 then '' else "
        f"{_text(_trip_base('o_orderkey') + ' + 200000 + (o_custkey % 300) * 600')} end || '\"}}'"
    )
    claim_json = (
        "case o_orderkey % 4 when 0 then '{\"items\": [{\"name\": \"box\"}, {\"unit\": \"kg\"}, {\"quantity\": \"5\"}], "
        "\"proofDocCodes\": \"D1\"}' when 1 then '{\"items\": [{\"name\": \"bag\"}]}' when 2 then '{}' else null end"
    )
    code = d.pick([f"'{c}'" for c, _ in CANCEL_RULES], f"(l_partkey % {len(CANCEL_RULES)}) + 1")
    remark = (
        "case when l_suppkey % 11 = 0 then null when l_suppkey % 13 = 0 then 'no reason given' "
        f"when l_suppkey % 3 = 0 then 'by app: ' || lower({code}) "
        f"when l_suppkey % 3 = 1 then replace({code}, '_', '-') || ' x' else {code} end"
    )
    claimed = "(o_custkey * 10 + o_orderkey % 10)"
    never = "cast(null as string)"
    return {
        "app_events": (
            "events",
            {
                "event_date": d.day_text("ts"),
                "event_name": f"case {k} % 10 when 3 then 'v1_' || upper(event_type) when 7 then 'v1_map_readjust' "
                "when 5 then 'v1x' || event_type when 9 then 'open_' || event_type else 'v1_' || event_type end",
                "event_params": d.pairs(
                    (
                        f"case when {k} % 8 = 0 then 'other' else 'event_action' end",
                        f"case {k} % 8 when 1 then 'Click' when 2 then 'click' when 3 then 'view' when 4 then 'api' "
                        f"when 5 then 'engage' when 6 then 'zoom' else {never} end",
                    ),
                    (
                        "'event_category'",
                        f"case event_type when 'error' then {never} when 'view' then 'View' else event_type end",
                    ),
                    (
                        "case when user_id % 7 = 0 then 'other_screen' else 'screen_name' end",
                        f"'screen_' || {_text('user_id % 3')}",
                    ),
                    (
                        "'entity'",
                        "case user_id % 5 when 0 then 'demand:12' when 1 then 'demand:1:2' when 2 then 'DEMAND:9' "
                        f"when 3 then {never} else 'noformat' end",
                    ),
                    (
                        "'miscellaneous'",
                        f"case user_id % 4 when 0 then 'a:1::b:2' when 1 then 'a:1:b' when 2 then 'A:x' else {never} end",
                    ),
                    (
                        "'demand_id'",
                        f"case {k} % 5 when 0 then '123' when 1 then '12.5' when 2 then '' when 3 then 'abc' "
                        f"else {never} end",
                    ),
                    (
                        "'event_platform'",
                        f"case when event_type = 'signup' and {k} % 4 = 0 then 'ios' when event_type = 'signup' "
                        f"and {k} % 4 = 1 then 'Android' when {k} % 50 = 49 then {never} else 'android' end",
                    ),
                    (
                        "'target_product'",
                        f"case user_id % 10 when 0 then 'Fleet' when 1 then {never} else 'fleet' end",
                    ),
                    ("'entity'", "'second:value'"),
                ),
                "user_properties": d.pairs(
                    (
                        "'user_code'",
                        f"case when user_id % 9 = 0 then 'LOGOUT' when user_id % 11 = 0 then {never} "
                        f"else 'U' || {_text('user_id')} end",
                    ),
                    (
                        "case user_id % 3 when 0 then 'device_id' when 1 then 'device_Id' else 'dev' end",
                        f"'d' || {_text('user_id')}",
                    ),
                    ("'op_id'", f"case when user_id % 2 = 0 then 'OP' || {_text('user_id')} else {never} end"),
                ),
                "app_info": d.struct(
                    id=f"case when {k} % 13 = 12 then 'app.other' else '{APP_ID}' end",
                    version=f"case {k} % 20 when 19 then '1.1.0 debug' when 18 then '' when 17 then null "
                    f"else '1.' || {_text(k + ' % 14')} || '.0' end",
                ),
            },
        ),
        "release_events_history": (
            "events",
            # One listed version was never released.
            {"app_version": f"'1.' || {_text(f'case {k} % 14 when 5 then 99 else {k} % 14 end')} || '.0'", "event_date": "ts"},
        ),
        "release_events_current": (
            "events",
            {
                "app_version": f"'1.' || {_text('case user_id % 16 when 5 then 99 else user_id % 16 end')} || '.0'",
                "event_date": d.plus_days("ts", -2),
            },
        ),
        "demands": (
            "orders",
            {
                "id": "o_orderkey",
                "metadata": demand_json,
                "created": shifted,
                "consigner_user_code": f"'C' || {_text('o_custkey')}",
                "status": "case o_orderstatus when 'P' then 'OPEN' else 'FULFILLED' end",
                "vehicle_type_id": "o_orderkey % 27",
            },
        ),
        "demand_addresses": ("lineitem", {"demand_id": "l_orderkey", "created": d.plus_days("l_shipdate", 9000)}),
        "consignments": (
            "orders",
            {
                "id": "o_orderkey + 100000",
                "demand_id": "case when o_orderkey % 4 = 3 then o_orderkey - 1 else o_orderkey end",
                "code": f"'CN-' || {_text('o_orderkey')}",
                "state": "case o_orderpriority when '5-LOW' then 'CANCELLED' when '4-NOT SPECIFIED' then 'IN_TRANSIT' "
                "else 'TRIP_END' end",
                "deleted": "case when o_custkey % 23 = 0 then 'true' else 'false' end",
                "created": d.at(f"{d.epoch(shifted)} + (o_custkey % 1440) * 60"),
                "vehicle_number": f"'V' || {_text('o_custkey')}",
                "operator_code": f"'OP' || {_text('o_custkey % 150')}",
                "offline_metadata": proof_json,
            },
        ),
        "demand_feedback": (
            "orders",
            {
                "demand_id": "o_custkey * 10",
                "rating": "nullif(cast(o_orderkey % 6 as int), 0)",
                "remarks": "nullif(o_orderpriority, '3-MEDIUM')",
                "reasons": "o_orderstatus",
                "updated": "case when o_orderkey % 37 = 0 then null else o_orderdate end",
                "deleted": "case when o_orderkey % 11 = 0 then 'true' else 'false' end",
            },
        ),
        "consigners": (
            "customer",
            {
                "code": f"'C' || {_text('c_custkey')}",
                "name": "case when c_custkey % 41 = 0 then 'Testing Co' when c_custkey % 43 = 0 then 'Alternate ltd' "
                "when c_custkey % 53 = 0 then null else c_name end",
                "type": "case c_mktsegment when 'BUILDING' then 'SME' when 'HOUSEHOLD' then 'SME_HP' "
                "when 'FURNITURE' then 'SME' else 'LARGE' end",
                "sales_manager": f"'M' || {_text('c_nationkey')}",
                "deleted": "case when c_custkey % 37 = 0 then 'true' else 'false' end",
            },
        ),
        "consignment_states": (
            "lineitem",
            {
                "consignment_code": f"'CN-' || {_text('l_orderkey')}",
                "state": "case l_linenumber when 1 then 'GOING_TO_LOAD' when 2 then 'AT_LOADING' when 3 then "
                "'IN_TRANSIT' when 4 then 'AT_UNLOADING' when 6 then 'CANCELLED' else 'TRIP_END' end",
                "time": f"{_trip_base('l_orderkey')} + l_linenumber * 20000 + (l_partkey % 1000) * 361",
                "remarks": remark,
                "updated": "case when l_suppkey % 19 = 0 then null else l_shipdate end",
                "updated_by": f"'u' || {_text('l_suppkey % 10')}",
                "deleted": "case when l_quantity = 13 then 'true' when l_quantity = 14 then null else 'false' end",
            },
        ),
        "vehicle_types": (
            "nation",
            {
                "id": "cast(n_nationkey as bigint)",
                "body_type": "n_name",
                "tyre_count": "cast(n_regionkey * 2 + 4 as int)",
            },
        ),
        "demand_comments": (
            "events",
            {
                "demand_id": "event_id",
                "remarks": f"case {k} % 10 when 0 then 'note #Acme_PTL booked' when 1 then 'ACME PTL' "
                "when 2 then 'DEMAND CANCELLED' when 3 then null when 4 then 'x acme_ptl y' else 'ok ' || event_type end",
                "created": "ts",
            },
        ),
        "demand_tokens": (
            "events",
            {
                "demand_id": "event_id - event_id % 2",
                "operator_code": f"'OP' || {_text('user_id % 10')}",
                "status": "case event_type when 'click' then 'EXPIRED' when 'view' then 'FORFEITED' "
                "when 'signup' then 'INITIATED' else 'ACCEPTED' end",
            },
        ),
        "quotations": (
            "events",
            {
                "operator_code": f"'OP' || {_text('user_id')}",
                "demand_id": f"cast({k} % 40 as bigint)",
                "created": "ts",
                "app_response_details": f"case {k} % 7 when 0 then null when 1 then '{{\"quote\": \"\"}}' "
                f"when 2 then '{{\"quote\": \"0\"}}' when 3 then '{{}}' else '{{\"quote\": ' || {_text(k)} || '}}' end",
            },
        ),
        "rate_inputs": (
            "lineitem",
            {
                "user_code": f"'OP' || {_text('l_suppkey')}",
                "rate": "l_quantity - 45",
                "active": "case when l_linestatus = 'O' and l_returnflag = 'A' then 'true' else 'false' end",
            },
        ),
        "damage_claims": (
            "orders",
            {
                "consignment_code": f"'CN-' || {_text(claimed)}",
                "created": "o_orderdate",
                "type": f"case o_orderkey % 5 when 1 then 'NO_DAMAGE' when 2 then 'BREAKAGE' when 3 then {never} "
                "else 'SHORT' end",
                "reason": "o_orderpriority",
                "claim_status": "o_orderstatus",
                "consigner_assessed_amount": "o_totalprice",
                "assessed_damage_amount": "cast(o_custkey as double)",
                "final_closure_amount": "nullif(cast(o_orderkey % 3 as double), 0)",
                "metadata": claim_json,
                "deleted": "case when o_orderkey % 13 = 0 then 'true' else 'false' end",
            },
        ),
        "expenses": (
            "lineitem",
            {
                "consignment_id": _text("l_orderkey"),
                "amount": "case when l_quantity = 7 then null else l_extendedprice end",
                "category": "case l_returnflag when 'A' then 'CREDIT' when 'R' then 'DEBIT' else 'OTHER' end",
                "party_type": "case l_linestatus when 'O' then 'OPERATOR' else 'CONSIGNER' end",
                "deleted": "case when l_quantity = 13 then 'true' else 'false' end",
            },
        ),
        "operator_transactions": (
            "orders",
            {
                "consignment_id": _text(claimed),
                "amount": "o_totalprice",
                "created": "o_orderdate",
                "updated": "case when o_orderkey % 97 = 0 then null else "
                + d.at(f"{_trip_base(claimed)} + 60000 + (o_orderkey % 3000) * 60")
                + " end",
                "type": "case when o_orderkey % 5 = 4 then 'FINAL' else 'ADVANCE' end",
                "status": "case o_orderpriority when '1-URGENT' then 'FAILED' else 'SUCCESS' end",
                "category": "case when o_orderkey % 7 = 0 then 'CREDIT' else 'DEBIT' end",
                "deleted": "case when o_orderkey % 19 = 0 then 'true' else 'false' end",
            },
        ),
        "bank_payments": (
            "lineitem",
            {
                "code": f"'CN-' || {_text('l_orderkey')}",
                "amount": "l_extendedprice",
                "otherparty": "case l_returnflag when 'N' then 'CONSIGNER' else 'OPERATOR' end",
                "status": "case l_linenumber % 3 when 0 then 'FAILED' when 1 then 'SUCCESS' else 'DONE' end",
                "created": "l_shipdate",
                "actpaidtime": "case when l_suppkey % 19 = 0 then null else "
                + d.at(f"{_trip_base('l_orderkey')} + 200000 + (l_partkey % 2000) * 90")
                + " end",
                "opsremarks": "case l_linestatus when 'O' then 'BALANCE' else 'ADVANCE' end",
            },
        ),
        "trip_reports": (
            "orders",
            {
                "demand_id": "case when o_orderkey % 6 = 5 then o_orderkey - 1 else o_orderkey end",
                "consignment_code": f"'CN-' || {_text('o_orderkey')}",
                "consigner_type": "case when o_custkey % 2 = 0 then 'SME' else 'LARGE' end",
                "consigner_code": f"'C' || {_text('o_custkey')}",
                "op_freight": "o_totalprice",
                "tds_value": f"case o_orderkey % 4 when 0 then '0.01' when 1 then '' when 2 then {never} else '0.02' end",
                "tds_amount": "nullif(cast(o_custkey % 7 as double), 0)",
                "vehicle_state": "case o_orderstatus when 'P' then 'IN_TRANSIT' else 'TRIP_END' end",
                "unloading_done_time": d.at(f"{_trip_base('o_orderkey')} + 220000 + (o_custkey % 500) * 300"),
                "trip_start_time": d.at(f"{_trip_base('o_orderkey')} + 80000"),
            },
        ),
        "subscriptions": (
            "orders",
            {
                "user_code": f"'OP' || {_text('o_custkey')}",
                "created_at": "o_orderdate",
                "deleted": "case o_orderstatus when 'P' then 'true' else 'false' end",
            },
        ),
        "operator_profiles": (
            "customer",
            {
                "user_code": f"'OP' || {_text('c_custkey')}",
                "kyc_status": "case when c_acctbal > 5000 then 'VERIFIED' else 'PENDING' end",
                "deleted": "case when c_custkey % 29 = 0 then 'true' else 'false' end",
            },
        ),
        "tickets": (
            "events",
            {
                "id": "event_id",
                "ticket_code": f"'T' || {_text('event_id')}",
                "created": "ts",
                "updated": d.plus_days("ts", 1),
                "status": f"case {k} % 4 when 1 then 'ACTIVE' when 3 then 'HOLD' else 'RESOLVED' end",
                "source": "case event_type when 'view' then 'App' when 'purchase' then 'PORTAL' when 'signup' "
                "then 'MATRIX' else 'APP' end",
                "subject": f"case {k} % 6 when 0 then 'Damage / Shortage claim' when 1 then 'damage only' "
                f"when 2 then 'Unfulfilled Demand - Operator Backout' when 3 then {never} else 'Delay' end",
                "description": "event_type",
                "assigned_to": f"case when user_id % 10 = 0 then '{DAMAGE_ASSIGNEE}' "
                f"else 'agent' || {_text('user_id % 5')} end",
                "created_by": "'app'",
                "updated_by": f"'agent' || {_text('user_id % 5')}",
                "reporting_to": f"'lead' || {_text('user_id % 2')}",
                "deleted": "case when user_id % 17 = 0 then 'true' else 'false' end",
            },
        ),
        "ticket_field_values": (
            "lineitem",
            {
                "ticket_id": "l_orderkey",
                "custom_field_id": "cast(case l_linenumber when 1 then 8 + 16 * (l_suppkey % 2) when 2 then 35 + l_suppkey % 2 "
                "when 3 then 31 + l_suppkey % 2 when 4 then 26 + 3 * (l_suppkey % 2) when 5 then 37 + l_suppkey % 2 "
                "when 6 then 10 else 5 end as int)",
                "date_value": f"{START} + (l_orderkey * 259) % 2592000 + (l_partkey % 1000) * 60",
                "string_value": f"case l_linenumber when 7 then 'CN-' || {_text('l_orderkey - l_orderkey % 2')} "
                "when 6 then case l_suppkey % 4 when 0 then 'late' when 1 then 'no/show' when 2 then null else 'rude' end "
                f"else 's' || {_text('l_suppkey % 5')} end",
                "number_value": "case when l_suppkey % 10 = 0 then null else l_orderkey - l_orderkey % 3 end",
                "updated": "case when l_suppkey % 19 = 0 then null else l_shipdate end",
                "deleted": "case when l_quantity = 13 then 'true' else 'false' end",
            },
        ),
        "ticket_activity": (
            "events",
            {
                "ticket_id": "event_id - event_id % 3",
                "field": f"case when {k} % 10 = 0 then 'priority' else 'status' end",
                "new_value": f"case when {k} % 2 = 0 then 'HOLD' else 'RESOLVED' end",
                "updated": d.plus_days("ts", 2),
            },
        ),
        "vehicles": ("customer", {"id": "c_custkey", "vehicle_number": f"'V' || {_text('c_custkey')}"}),
        "vehicle_details": (
            "customer",
            {
                "vehicle_number": f"'V' || {_text('c_custkey')}",
                "device_name": f"'dev' || {_text('c_nationkey')}",
                "device_family": "c_mktsegment",
                "hardware_type": f"'hw' || {_text('c_nationkey % 3')}",
                "sim_network": "nullif(c_mktsegment, 'BUILDING')",
                "vehicle_state": "case c_mktsegment when 'MACHINERY' then 'SOLD' else 'LIVE' end",
            },
        ),
        "device_history": (
            "lineitem",
            {
                "vehicle_id": "l_partkey",
                "action": "l_returnflag",
                "from_time": f"{_trip_base('l_orderkey')} + l_suppkey * 900",
                "to_time": f"case when l_suppkey % 23 = 0 then null else {_trip_base('l_orderkey')} + l_suppkey * 900 "
                "+ cast(l_quantity as bigint) * 600 end",
            },
        ),
        "call_records": (
            "events",
            {
                "call_id": f"'call' || {_text('event_id')}",
                "user_disposition_code": f"'UD' || {_text(k + ' % 25')}",
                "product": "case when user_id % 4 = 0 then 'Other' else 'Marketplace' end",
                "call_time": "ts",
            },
        ),
        "call_crm": (
            "events",
            {
                "call_id": f"'call' || {_text('event_id - event_id % 2')}",
                "disposition_code": f"case {k} % 5 when 0 then 'MP_TRACKING ISSUE' when 1 then 'MP_ADVANCE QUERY' "
                f"when 2 then 'OTHER' when 3 then 'MP_DAMAGE / SHORTAGE' else {never} end",
                "c_type": "case when user_id % 3 = 0 then 'Operator' else 'Customer' end",
            },
        ),
    }


def _declared(name: str) -> str:
    return "release_events" if name.startswith("release_events") else name


class SparkSources:
    """Source tables by name, read lazily from one data folder."""

    def __init__(self, spark: SparkSession, folder: str):
        self._spark, self._folder, self._sources = spark, folder, sources(SparkDialect)

    def table(self, name: str) -> DataFrame:
        return self._spark.read.parquet(f"{self._folder}/{name}.parquet")

    def __getitem__(self, name: str) -> DataFrame:
        table, columns = self._sources[name]
        rows = self.table(table)
        if table == "events":
            rows = rows.withColumn("k", F.expr(SparkDialect.json_int("props", "k")))
        projected = rows.selectExpr(*[f"{expr} as `{col}`" for col, expr in columns.items()])
        return conform(projected, _declared(name))

    def many(self, *names: str) -> list[DataFrame]:
        return [self[name] for name in names]


def duck_sources() -> dict[str, str]:
    """Each source as a SELECT for the comparison engine."""
    events = f"(select *, {DuckDialect.json_int('props', 'k')} as k from events)"

    def select(table: str, columns: dict[str, str]) -> str:
        listed = ", ".join(f"{expr} as {col}" for col, expr in columns.items())
        return f"select {listed} from {events if table == 'events' else table}"

    return {name: select(table, columns) for name, (table, columns) in sources(DuckDialect).items()}
