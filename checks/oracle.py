"""Comparison SQL.

Each query is a named common table expression over the source projections of
``checks.bindings``; a query's text is its own expression preceded by those it reads. The
expressions state the meaning directly (windows, plain joins). They share the operators' fixed
values (rule lists, measures, excluded names), but no logic: a wrong fixed value shows in the survey,
not here.
"""

from __future__ import annotations

import re

from checks.bindings import (
    APP_ID,
    DAMAGE_ASSIGNEE,
    EXCLUDED_CUSTOMERS,
    LINK_BASE,
    PORTAL,
    TRIP_TICKETS,
    duck_sources,
)
from checks.queries import AS_OF, FIRST_DAY, FLAGS, LAST_DAY, NAMES, TEXT_RULES
from haulmetry.operators.cancellations import CANCEL_RULES
from haulmetry.operators.event_issues import MANDATORY, SUMMARY_LEFT_OUT, SUMMARY_OPTIONAL
from haulmetry.operators.event_quality import DEFINED_ACTIONS, EXCLUDED_EVENTS, MEASURES, SIGNATURE_ACTIONS
from haulmetry.operators.growth import CALL_DISPOSITIONS
from haulmetry.sources.sinks import ORDERED_BY

COUNTERS = [m[0] for m in MEASURES]
NOW = f"timestamp '{AS_OF:%Y-%m-%d %H:%M:%S}'"
TODAY = f"date '{AS_OF:%Y-%m-%d}'"


def _list(values) -> str:
    return "(" + ", ".join(f"'{v}'" for v in values) + ")"


def _local(seconds: str) -> str:
    return f"make_timestamp(cast((({seconds}) + 19800) * 1000000 as bigint))"


def _shift(ts: str) -> str:
    return f"({ts} + interval '330' minute)"


def _json(doc: str, path: str) -> str:
    return f"(case when json_valid({doc}) then coalesce(json_extract_string({doc}, '$.{path}'), '') end)"


def _num(text: str) -> str:
    return f"try_cast({text} as double)"


def _full_load(doc: str) -> str:
    return f"{_json(doc, 'ptl')} <> 'true'"


def _value(entries: str, key: str) -> str:
    return f"list_filter({entries}, lambda p: p.key = '{key}')[1].value.string_value"


def _newest(key: str, order: str, *ties: str) -> str:
    tie = "".join(f", {t} desc nulls last" for t in ties)
    return f"row_number() over (partition by {key} order by ({order} is null) desc, {order} desc{tie}) = 1"


def _ratio(part: str, whole: str) -> str:
    return f"cast({part} as double) / nullif(cast({whole} as double), 0.0)"


def _percent(part: str, whole: str) -> str:
    return f"cast({part} as double) * 100.0 / nullif(cast({whole} as double), 0.0)"


def _version_key(version: str) -> str:
    return rf"list_transform(regexp_extract_all({version}, '(\d+)', 1), lambda x: cast(x as bigint))"


def _event_audit() -> dict[str, str]:
    checks = {
        "event_action_format": f"event_action in {_list(DEFINED_ACTIONS)}",
        "entity_key": r"regexp_matches(entity, '^\w+:[^:]*$')",
        "miscellaneous_key": r"regexp_matches(miscellaneous, '^\w+:[^:]+(::\w+:[^:]+)*$')",
        "user_code_logout": "user_code = 'LOGOUT'",
        "demand_id_int": "regexp_full_match(trim(demand_id), '[+-]?[0-9]+')",
    }
    for name in (*COUNTERS, "op_id_fill"):
        if name.endswith("_fill"):
            checks[name] = f"{name.removesuffix('_fill')} is not null"
        elif name.endswith("_lower"):
            column = name.removesuffix("_lower")
            checks[name] = f"{column} = lower({column})"
    keys = (
        "event_date, app_info_id, target_product, event_platform, app_version, event_name, event_action, "
        "event_category, screen_name"
    )
    sums = ", ".join(f"cast(sum({c}) as bigint) as {c}" for c in ("total_rows", *COUNTERS))
    misses = ", ".join(f"round((total_rows - {c}) / total_rows * 100.0, 1) as {c}_pct" for c in COUNTERS)
    passes = ", ".join(f"count(*) filter (where not coalesce({c}_pct >= 1, false)) as {c}" for c in COUNTERS)
    rates = []
    for name, key, metric in MEASURES:
        whole = "total_events" if metric in ("fill", "LOGOUT") or key == "event_name" else f"{key}_fill"
        rates.append(f"round(cast({name} as double) / nullif({whole}, 0) * 100.0, 1) as {name}_pct")
    shown = [m for m in MEASURES if m[0] not in SUMMARY_LEFT_OUT]
    melted = ["select flag, 'total_events' as measure, 'total_events' as key_name, '--' as metrics, "
              "cast(total_events as double) as value from compliance_rates"]
    for name, key, metric in shown:
        tail = "_optional" if name in SUMMARY_OPTIONAL else ""
        melted.append(
            f"select flag, '{name}', '{key}', '{metric}_pct{tail}', {name}_pct from compliance_rates"
        )
    audited = [c for c in COUNTERS if c != "device_id_fill"]
    shares = ", ".join(f"cast(trunc(round({c} / total_rows * 100.0, 1)) as int) as {c}_pct" for c in audited)
    audited_sums = ", ".join(f"cast(sum({c}) as bigint) as {c}" for c in ("total_rows", *audited))
    issue_keys = "target_product, event_platform, row_number, event_name, event_action, event_category, screen_name"
    # Share limits of each phrase; every condition of a phrase must hold.
    phrases = (
        ("event name not in lower case", "event_name_lower_pct < 99"),
        ("issue in event_action", "least(event_action_fill_pct, event_action_lower_pct, event_action_format_pct) < 99"),
        ("event category not in lower case", "event_category_fill_pct >= 99 and event_category_lower_pct < 99"),
        ("screen name missing", "screen_name_fill_pct < 99"),
        ("screen name not in lower case", "screen_name_fill_pct >= 99 and screen_name_lower_pct < 99"),
        ("entity key value is not in right format", "entity_fill_pct >= 90 and entity_key_pct < 95"),
        (
            "miscellaneous key value is not in right format",
            "miscellaneous_fill_pct >= 95 and miscellaneous_key_pct < 95",
        ),
        ("user_code missing", "user_code_fill_pct < 80"),
        ("demand id not in numeric", "demand_id_fill_pct >= 95 and demand_id_int_pct < 95"),
        ("event_platform missing", "event_platform_fill_pct < 99"),
        ("event_platform not in lower case", "event_platform_lower_pct < 99"),
        ("target product missing", "target_product_fill_pct < 99"),
        ("target product not in lower case", "target_product_lower_pct < 99"),
    )
    issue = "concat_ws(',', " + ", ".join(f"case when {test} then '{text}' end" for text, test in phrases) + ")"

    def classify(where: str) -> str:
        return (
            f"select *, {issue} as issue_type from (select *, {shares} from "
            f"(select {issue_keys}, {audited_sums} from event_signature {where} group by all))"
        )

    pivots = ", ".join(f"max(value) filter (where flag = '{f}') as {f}" for f in FLAGS)
    no_nulls = " and ".join(f"{k} is not null" for k in issue_keys.split(", "))
    key = _version_key("app_version")
    return {
        "event_param_flatten": f"""
            select event_date, event_name,
              {", ".join(f"{_value('event_params', c)} as {c}" for c in (
                  "event_action", "event_category", "screen_name", "entity", "miscellaneous", "demand_id",
                  "event_platform", "target_product"))},
              {_value("user_properties", "user_code")} as user_code,
              coalesce({_value("user_properties", "device_id")}, {_value("user_properties", "device_Id")}) as device_id,
              {_value("user_properties", "op_id")} as op_id,
              app_info.id as app_info_id, app_info.version as app_version
            from app_events
            where event_date between '{FIRST_DAY}' and '{LAST_DAY}' and app_info.id = '{APP_ID}'
              and event_name like 'v1_%' and event_name not in {_list(EXCLUDED_EVENTS)}""",
        "event_quality_counts": f"""
            select {keys}, count(*) as total_rows,
              {", ".join(f"count(*) filter (where {checks[c]}) as {c}" for c in (*COUNTERS, "op_id_fill"))}
            from event_param_flatten group by all""",
        "platform_counts": "select * from event_quality_counts where app_version is distinct from '1.1.0 debug' "
        "and event_platform = 'android'",
        "version_sizes": f"""
            select app_version, cast(sum(total_rows) as bigint) as total_rows,
              row_number() over (order by {key}, app_version) as from_low,
              row_number() over (order by {key} desc, app_version desc) as from_high
            from platform_counts group by app_version""",
        "app_version_rank": f"""
            select app_version, total_rows,
              'app_latest_' || (row_number() over (order by from_high) - 1) as row_number
            from (select *, row_number() over (order by from_high = 1 desc, total_rows desc, app_version desc) as pick
                  from version_sizes where from_low > 1)
            where pick <= 10""",
        "release_date_first_seen": """
            select app_version, min(cast(event_date as date)) as release_date,
              app_version || ' (Release date- ' || strftime(min(cast(event_date as date)), '%Y-%m-%d') || ')'
                as app_version_1
            from (select * from release_events_history union all select * from release_events_current)
            where app_version in (select app_version from app_version_rank) group by app_version""",
        "version_tagging": "select c.*, r.row_number from platform_counts c left join app_version_rank r "
        "using (app_version)",
        "event_signature": f"""
            select *, event_name || event_action || coalesce(event_category, 'None') || coalesce(screen_name, 'None')
                as combined_event
            from (select * replace (case when event_action in {_list(SIGNATURE_ACTIONS)} then event_action else 'a' end
                    as event_action) from version_tagging)""",
        "quality_miss_pct": f"select *, {misses} from (select combined_event, {sums} from event_signature group by 1)",
        "quality_miss_pct_by_version": f"select *, {misses} from (select combined_event, row_number, {sums} "
        "from event_signature where row_number is not null group by 1, 2)",
        "compliance_funnel": f"""
            select 'overall' as flag, count(*) as total_events, {passes} from quality_miss_pct
            union all by name
            select row_number as flag, count(*) as total_events, {passes} from quality_miss_pct_by_version group by 1""",
        "compliance_rates": f"select *, {', '.join(rates)} from compliance_funnel",
        "summary_rows": " union all ".join(melted),
        "summary_long": """
            select case s.flag when 'overall' then 'overall' else coalesce(d.app_version_1, r.app_version) end as app_version,
              s.measure, s.key_name, s.metrics, s.value
            from summary_rows s left join app_version_rank r on r.row_number = s.flag
            left join release_date_first_seen d on d.app_version = r.app_version""",
        "summary_by_version": f"select key_name, metrics, {pivots} from summary_rows group by 1, 2",
        "summary_by_version_labelled": "select key_name, metrics, app_version, value from summary_long",
        "breach_flag": f"select *, coalesce(measure in {_list(MANDATORY)} and value < 99, false) as breach "
        "from summary_long",
        "issue_classifier": classify(f"where {no_nulls}"),
        "issue_classifier_all_keys": classify(""),
        "issue_latest_version": """
            select i.target_product, r.app_version, i.event_name, i.event_action, i.event_category, i.screen_name,
              i.issue_type
            from (select * from issue_classifier where issue_type <> ''
                  qualify row_number() over (partition by event_name, event_action, event_category, screen_name
                    order by cast(split_part(row_number, '_', 3) as int), target_product, event_platform) = 1) i
            left join app_version_rank r using (row_number)""",
        "issue_export": """
            select distinct app_version, event_name, event_action, event_category, screen_name, target_product,
              issue_type from issue_latest_version""",
        "issue_export_csv": "select * from issue_export",
        "event_log_window": "select * from event_param_flatten",
    }


def _trips() -> dict[str, str]:
    body = "body"
    amounts = [f"coalesce({_num(_json(body, k))} > 0, false)" for k in ("overHeight", "expressDeliveryTat")]
    flags = [
        f"coalesce({_json(body, k)} = 'true', false)"
        for k in (
            "overWeight",
            "openDala",
            "extraRope",
            "extraWidth",
            "extraPerson",
            "helperRequired",
            "dieselVehicle",
            "extraTripalRequired",
        )
    ]
    states = ("GOING_TO_LOAD", "AT_LOADING", "IN_TRANSIT", "AT_UNLOADING", "TRIP_END")
    times = ", ".join(f"max(time) filter (where state = '{s}') as {s.lower()}" for s in states)
    known = ", ".join(f"{_local(s.lower())} as {s.lower()}_time" for s in states)

    def overrun(key: str, per_day: float) -> str:
        promised = _json("metadata", key)
        distance = _num(_json("metadata", "estimatedRouteDistance"))
        return (
            f"date_diff('hour', in_transit_time, at_unloading_time) - case when {promised} <> '' "
            f"then {_num(promised)} else (case when {distance} > 0 then floor({distance}) end) / {per_day} * 24.0 end"
        )

    def inside(start: str, end: str) -> str:
        return (
            f"coalesce(sum(case when h.from_time between s.{start} and s.{end} and h.to_time between s.{start} "
            f"and s.{end} then date_diff('hour', {_local('h.from_time')}, {_local('h.to_time')}) else 0 end), 0)"
        )

    return {
        "special_request_flag": f"""
            select r.demand_id, {_num(_json(body, "expressDeliveryTat"))} as express_delivery,
              cast({" or ".join(amounts + flags)} or v.demand_id is not null as int) as sr_demand
            from (select id as demand_id, {_json("metadata", "specialRequestBody")} as body from demands
                  where created >= timestamp '2023-10-01') r
            left join (select demand_id from demand_addresses where created >= timestamp '2023-10-01'
                       group by 1 having count(demand_id) > 2) v using (demand_id)""",
        "latest_states": f"""
            select consignment_code as code, {times}
            from (select * from consignment_states where deleted = 'false' and state <> 'CANCELLED'
                  qualify {_newest("consignment_code, state", "updated", "time")})
            group by 1""",
        "state_milestones": f"select code, {known} from latest_states",
        "ended_trips": """
            select c.code, c.demand_id, m.* exclude (code), d.metadata, d.consigner_user_code
            from consignments c join state_milestones m using (code) left join demands d on d.id = c.demand_id
            where m.trip_end_time >= timestamp '2024-01-01'""",
        "loading_delay_bucket": f"""
            select *, case when g_delay <= 1 then 'ontime' when g_delay <= 120 then 'delay_2hr'
              when g_delay <= 240 then 'delay_2hr_to_4hr' else 'delay_4hours+' end as gtl_delay
            from (select distinct demand_id, date_diff('minute',
                    {_local(_num(_json("metadata", "appLoadingTime")))}, at_loading_time) as g_delay
                  from ended_trips)""",
        "transit_delay_bucket": f"""
            select *, case when cxnr_trnst > 48 then 'dely_abv_48' when cxnr_trnst > 24 then 'dely_undr_48'
              when cxnr_trnst > 0 then 'dely_undr_24' when cxnr_trnst <= 0 then 'ontime' end as sys_trnst_dly
            from (select distinct demand_id, {overrun("shipperTATinHrs", 300.0)} as cxnr_trnst,
                    {overrun("operatorTATinHrs", 400.0)} as fo_trnst from ended_trips)""",
        "trip_end_fact": f"""
            select distinct t.demand_id, t.trip_end_time as unloading_done_time, f.rating, f.remarks, f.reasons,
              l.gtl_delay, b.sys_trnst_dly, t.code, s.sr_demand, s.express_delivery
            from ended_trips t
            join consigners n on n.code = t.consigner_user_code
            left join demand_feedback f on f.demand_id = t.demand_id
            left join special_request_flag s on s.demand_id = t.demand_id
            left join loading_delay_bucket l on l.demand_id = t.demand_id
            left join transit_delay_bucket b on b.demand_id = t.demand_id
            where {_full_load("t.metadata")} and n.name not ilike '%testing%'""",
        "calendar_labels": f"select code, created, {_calendar('created')} from consignments",
        "gps_offline": f"""
            select s.code, s.vehicle_number, s.operator_code, {_local("s.in_transit")} as trnst_time,
              date_diff('hour', {_local("s.going_to_load")}, {_local("s.at_unloading")}) as trip_journey,
              s.gtl_to_loading_time, s.loading_to_transit_time, s.transit_to_unloading_time,
              s.gtl_to_loading_time + s.transit_to_unloading_time as total_offline_time,
              {_ratio("(s.gtl_to_loading_time + s.transit_to_unloading_time)",
                      f"date_diff('hour', {_local('s.going_to_load')}, {_local('s.at_unloading')})")} as offline_share,
              s.device_name, s.device_family, s.hardware_type, s.sim_network,
              date_diff('hour', {_local("s.in_transit")}, {_local("s.at_unloading")}) as transit_journey
            from (
              select s.*, cast({inside("going_to_load", "at_loading")} as bigint) as gtl_to_loading_time,
                cast({inside("at_loading", "in_transit")} as bigint) as loading_to_transit_time,
                cast({inside("in_transit", "at_unloading")} as bigint) as transit_to_unloading_time
              from (select c.code, c.vehicle_number, c.operator_code, v.device_name, v.device_family,
                      v.hardware_type, v.sim_network, l.going_to_load, l.at_loading, l.in_transit, l.at_unloading
                    from consignments c
                    join vehicle_details v on v.vehicle_number = c.vehicle_number and v.vehicle_state = 'LIVE'
                    left join latest_states l on l.code = c.code) s
              left join vehicles i on i.vehicle_number = s.vehicle_number
              left join device_history h on h.vehicle_id = i.id
              group by all) s""",
        "trip_enriched": f"""
            select t.*, {_calendar("t.unloading_done_time")}, k.ticket_code, k.ticket_feedback, k.opened_from,
              k.tat_resolve_cat, g.trip_journey, g.total_offline_time, g.sim_network, g.transit_journey
            from trip_end_fact t left join tickets_fact k on k.demand_id = t.demand_id
            left join gps_offline g on g.code = t.code""",
        "partial_demands": "select distinct demand_id from demand_comments where remarks ilike '%#acme_ptl%' "
        "or remarks ilike '%acme ptl%'",
        "exclude_partial_and_test": f"""
            select * from demands d
            where {_full_load("d.metadata")} and d.consigner_user_code not in {_list(EXCLUDED_CUSTOMERS)}
              and exists (select 1 from consigners n where n.code = d.consigner_user_code
                          and n.name not ilike '%testing%' and n.name not ilike '%alternat%')
              and not exists (select 1 from partial_demands p where p.demand_id = d.id)""",
    }


def _calendar(ts: str, with_date: bool = True) -> str:
    monday = f"date_trunc('week', {ts})"
    labels = (
        f"strftime({monday}, '%d-%b-%y') || ' - ' || strftime({monday} + interval '6' day, '%d-%b-%y') as week_date, "
        f"strftime({ts}, '%b') || '''' || strftime({ts}, '%y') as month_year"
    )
    return f"{labels}, cast({ts} as date) as date" if with_date else labels


def _tickets() -> dict[str, str]:
    def field(ids: tuple[int, ...], column: str, live: bool = True) -> str:
        only = " and deleted <> 'true'" if live else ""
        return (
            f"(select ticket_id, {column} as v from ticket_field_values where custom_field_id in {ids}{only} "
            f"qualify {_newest('ticket_id', 'updated', column)})"
        )

    return {
        "rating_category": f"""
            select demand_id, rating,
              case when rating < 3 then 'BAD' when rating = 3 then 'MODERATE' else 'GOOD' end as rating_cat
            from demand_feedback where deleted <> 'true'
            qualify {_newest("demand_id", "updated", "rating")}""",
        "ticket_fields": f"""
            select t.ticket_id, {_local("a.v")} as resolve_time, {_local("b.v")} as expected_res_time,
              c.v as sub_reason, d.v as tt_dem_id, e.v as ticket_feedback
            from (select distinct ticket_id from ticket_field_values
                  where custom_field_id in (8, 24, 26, 29, 31, 32, 35, 36, 37, 38)) t
            left join {field((36, 35), "date_value")} a on a.ticket_id = t.ticket_id
            left join {field((32, 31), "date_value", live=False)} b on b.ticket_id = t.ticket_id
            left join {field((26, 29), "string_value")} c on c.ticket_id = t.ticket_id
            left join {field((8, 24), "number_value")} d on d.ticket_id = t.ticket_id
            left join {field((37, 38), "string_value")} e on e.ticket_id = t.ticket_id""",
        "ticket_sla": f"""
            select ticket_code, ticket_created_time, tt_dem_id, status, ticket_feedback, resolve_dif, opened_from, tat,
              cast(case when resolve_dif <= tat then 1 when resolve_dif is not null then 0 end as int)
                as tat_resolve_cat,
              case when status = 'ACTIVE' and opened_from > tat then 'open_abv_tat' end as tat_chk,
              case when status = 'ACTIVE' and opened_from >= 4320 then 'opn_abv_72hrs' end as op_cat
            from (
              select t.ticket_code, {_shift("t.created")} as ticket_created_time, f.tt_dem_id, t.status,
                f.ticket_feedback,
                case when t.status = 'RESOLVED' then date_diff('minute', {_shift("t.created")}, f.resolve_time) end
                  as resolve_dif,
                case when t.status <> 'RESOLVED' then date_diff('minute', {_shift("t.created")}, {NOW}) end
                  as opened_from,
                date_diff('minute', {_shift("t.created")}, f.expected_res_time) as tat
              from tickets t left join ticket_fields f on f.ticket_id = t.id
              where t.deleted <> 'true' and t.source in ('APP', 'App', '{PORTAL}')
                and t.subject <> 'Unfulfilled Demand - Operator Backout')""",
        "trip_ends_any": f"""
            select consignment_code as code, {_local("time")} as trip_start_time from consignment_states
            where state = 'TRIP_END' and deleted <> 'true' qualify {_newest("consignment_code", "updated", "time")}""",
        "tickets_fact": f"""
            select s.*, d.id as demand_id, d.consigner_user_code, e.trip_start_time, r.rating_cat
            from ticket_sla s
            join demands d on d.id = s.tt_dem_id
            join consigners n on n.code = d.consigner_user_code and n.deleted <> 'true' and n.type in ('SME', 'SME_HP')
              and n.name not ilike '%alternat%' and n.name not ilike '%testing%'
            join consignments c on c.demand_id = d.id and c.state <> 'CANCELLED' and c.deleted <> 'true'
            join trip_ends_any e on e.code = c.code
            left join rating_category r on r.demand_id = d.id
            where s.ticket_created_time >= timestamp '2024-01-01' and d.status = 'FULFILLED'
              and {_full_load("d.metadata")} and d.consigner_user_code not in {_list(EXCLUDED_CUSTOMERS)}
              and d.id not in (select demand_id from partial_demands)""",
        "trip_tickets": f"""
            select t.id as ticket_id, t.ticket_code, t.status, {_shift("t.created")} as a_created,
              i.string_value as issue_identified, h.hold_time, p.string_value as trip_id, r.resolved_time,
              date_diff('hour', {_shift("t.created")}, r.resolved_time) as resolved_dur
            from tickets t
            join (select distinct ticket_id, string_value from ticket_field_values where custom_field_id = 10) i
              on i.ticket_id = t.id
            left join (select distinct ticket_id, string_value from ticket_field_values where custom_field_id = 5) p
              on p.ticket_id = t.id
            left join (select ticket_id, {_shift("min(updated)")} as hold_time from ticket_activity
                       where field = 'status' and new_value = 'HOLD' group by 1) h on h.ticket_id = t.id
            left join (select distinct ticket_id, {_shift("updated")} as resolved_time from ticket_activity
                       where field = 'status' and new_value = 'RESOLVED') r on r.ticket_id = t.id
            where t.source = '{TRIP_TICKETS}'""",
        "tickets_per_trip": f"""
            select c.code, {_shift("c.created")} as placement_time,
              cast(week({_shift("c.created")}) as int) as week_placed,
              cast(month({_shift("c.created")}) as int) as month_placed,
              string_agg(k.issue_identified, '/' order by k.ticket_code, k.issue_identified) as tickets_created,
              r.consigner_type, string_agg(k.ticket_code, '/' order by k.ticket_code) as ticket_codes,
              nullif(count(k.issue_identified), 0) as total_tickets
            from consignments c
            join demands d on d.id = c.demand_id
            left join (select distinct consignment_code, consigner_type from trip_reports) r
              on r.consignment_code = c.code
            left join trip_tickets k on k.trip_id = c.code
            where c.deleted = 'false' and {_shift("c.created")} >= timestamp '2023-02-01' and {_full_load("d.metadata")}
            group by c.code, c.created, r.consigner_type""",
        "trip_ticket_ratio_daily": f"""
            select *, {_ratio("total_tickets_created", "trips")} as ratio_trips_tickets,
              {_percent("no_tickets_created_trips", "trips")} as no_trips_tickets_pct,
              {_percent("trip_atleast_1_tickets", "trips")} as trips_tickets_pct
            from (select cast(placement_time as date) as placement_date, count(distinct code) as trips,
                    count(distinct code) filter (where total_tickets is null) as no_tickets_created_trips,
                    count(distinct code) filter (where total_tickets >= 1) as trip_atleast_1_tickets,
                    cast(sum(total_tickets) as bigint) as total_tickets_created
                  from tickets_per_trip where placement_time >= timestamp '2023-12-01' group by 1)""",
        "damage_raised": f"""
            select t.ticket_code, t.source, {_shift("t.created")} as opened, f.v as demand_id
            from tickets t join {field((8, 24), "number_value")} f on f.ticket_id = t.id
            where t.deleted <> 'true' and t.source in ('APP', 'App', '{PORTAL}')
              and ((t.subject ilike '%damage%' and t.subject ilike '%shortage%')
                   or t.assigned_to = '{DAMAGE_ASSIGNEE}')""",
        "damage_tickets": f"""
            select n.code, n.name, n.sales_manager, c.demand_id, c.code as trip_id,
              cast(month(k.opened) as int) as ticket_month,
              m.claim_status, m.type, m.reason, m.consigner_assessed_amount, m.assessed_damage_amount,
              m.final_closure_amount, {_json("m.metadata", "items[0].name")} as items,
              {_json("m.metadata", "items[1].unit")} as unit, {_json("m.metadata", "items[2].quantity")} as quantity,
              {_json("m.metadata", "proofDocCodes")} as proofdoccodes, z.total_tickets,
              cast(z.total_tickets > 1 as int) as multiple_ticket_cat,
              max(k.ticket_code) filter (where k.source = 'APP') as app_ticket,
              max('{LINK_BASE}' || k.ticket_code) filter (where k.source = 'APP') as app_ticket_link,
              max('{LINK_BASE}' || k.ticket_code) filter (where k.source = '{PORTAL}') as portal_ticket_link,
              max(k.ticket_code) filter (where k.source = '{PORTAL}') as portal_ticket,
              min(k.opened) as ticket_creation_time
            from damage_raised k
            join consignments c on c.demand_id = k.demand_id and c.deleted <> 'true'
            join damage_claims m on m.consignment_code = c.code and m.deleted <> 'true'
            join demands d on d.id = c.demand_id
            join consigners n on n.code = d.consigner_user_code and n.deleted <> 'true'
              and n.name not ilike '%testing%'
            join (select demand_id, count(distinct ticket_code) as total_tickets from damage_raised group by 1) z
              on z.demand_id = k.demand_id
            group by all""",
        "damage_daily": f"""
            select *, {_ratio("reported", "total_trips")} as reported_dmg_share,
              {_ratio("identfied", "total_trips")} as identfied_dmg_share,
              {_ratio("not_identfied", "total_trips")} as pending_identification_share,
              {_ratio("no_dmg", "total_trips")} as no_dmg_found_share,
              {_ratio("actual_damage", "total_trips")} as actual_dmg_share
            from (
              select *, identfied - no_dmg as actual_damage from (
                select cast(s.trip_end_time as date) as daily_trip, count(distinct c.code) as total_trips,
                  count(distinct m.trip_id) as reported,
                  count(distinct m.trip_id) filter (where m.type is null) as not_identfied,
                  count(distinct m.trip_id) filter (where m.type is not null) as identfied,
                  count(distinct m.trip_id) filter (where m.type = 'SHORT') as shortage,
                  count(distinct m.trip_id) filter (where m.type = 'NO_DAMAGE') as no_dmg
                from consignments c
                join state_milestones s on s.code = c.code and s.trip_end_time >= timestamp '2024-04-01'
                join demands d on d.id = c.demand_id and d.status = 'FULFILLED'
                left join damage_tickets m on m.trip_id = c.code
                where {_full_load("d.metadata")} group by 1))""",
    }


def _first_match(column: str, rules) -> str:
    tests = " ".join(f"when {column} ilike '%{code}%' then '{owner}'" for code, owner in rules)
    return f"case {tests} end"


def _cancellations() -> dict[str, str]:
    return {
        "cancel_reason": f"""
            select consignment_code, time, remarks, {_first_match("remarks", CANCEL_RULES)} as placed_cancel_reason
            from consignment_states""",
        "cancel_reason_documents": f"select doc_id, {_first_match('text', TEXT_RULES)} as owner from documents",
        "cancellations_fact": f"""
            select *, case when consignment_state = 'CANCELLED' then row_number() over (
                partition by demand_id, consignment_state order by placement_time desc, code, cancel_time nulls last,
                  cancelled_by nulls last, token_status nulls last, cancel_remarks nulls last) end as ord,
              {_calendar("placement_time")}
            from (
              select d.id as demand_id, c.code, c.operator_code, {_shift("c.created")} as placement_time,
                c.state as consignment_state, d.status, d.consigner_user_code, d.vehicle_type_id, v.tyre_count,
                {_first_match("x.remarks", CANCEL_RULES)} as placed_cancel_reason, x.remarks as cancel_remarks,
                {_local("x.time")} as cancel_time, x.updated_by as cancelled_by, k.status as token_status,
                date_diff('minute', {_shift("c.created")}, {_local("x.time")}) as cancelled_in
              from consignments c
              join demands d on d.id = c.demand_id
              join consigners n on n.code = d.consigner_user_code and n.type in ('SME', 'SME_HP')
                and n.name not ilike '%testing%' and n.name not ilike '%alternate%'
              left join vehicle_types v on v.id = d.vehicle_type_id
              left join (select * from consignment_states where state = 'CANCELLED' and deleted = 'false') x
                on x.consignment_code = c.code
              left join (select * from demand_tokens where status not in ('EXPIRED', 'INITIATED')) k
                on k.demand_id = c.demand_id and k.operator_code = c.operator_code
              where {_shift("c.created")} >= timestamp '2024-01-01' and {_full_load("d.metadata")})""",
        "cancellation_report": """
            select demand_id, code, placement_time, consignment_state, status, placed_cancel_reason, ord,
              operator_code, week_date, month_year, date from cancellations_fact""",
    }


def _growth() -> dict[str, str]:
    quoted = f"{_num(_json('app_response_details', 'quote'))} > 0"
    totals = {
        "op_subscribed_": "count(user_code)",
        "op_verified_": "count(user_code) filter (where kyc_status = 'VERIFIED')",
        "op_profile_completed_": "count(user_code) filter (where rated > 0)",
        "op_active_quote_": f"count(user_code) filter (where date_diff('day', last_quote, {TODAY}) <= 30)",
        "op_active_placement_": f"count(user_code) filter (where date_diff('day', last_placement, {TODAY}) <= 30)",
    }

    def funnel(column: str, grain: str) -> str:
        start = f"cast(date_trunc('{grain}', created_at) as date)"
        sums = ", ".join(
            f"cast(sum({count}) over (order by {start}) as bigint) as {name}" for name, count in totals.items()
        )
        return f"select {start} as {column}, {sums} from acquired group by {start}"

    return {
        "subscriptions_cumulative": f"""
            select s_date, cast(sum(n) over (order by s_date) as bigint) as cumulative_subscribed,
              {_calendar("s_date", with_date=False)}
            from (select cast(created_at as date) as s_date, count(distinct user_code) as n from subscriptions
                  where deleted = 'false' group by 1)""",
        "quotes_per_operator_daily": f"""
            select quote_date, count(demand_id) as demands, count(distinct operator_code) as operators,
              {_ratio("count(demand_id)", "count(distinct operator_code)")} as quotes_per_op
            from (select distinct operator_code, cast(created as date) as quote_date, demand_id from quotations
                  where {quoted} and cast(created as date) >= date '2023-01-01') group by 1""",
        "acquired": f"""
            select s.user_code, s.created_at, p.kyc_status, q.last_quote, c.last_placement, r.rated
            from subscriptions s
            left join (select operator_code, max(cast(created as date)) as last_quote from quotations
                       where {quoted} group by 1) q on q.operator_code = s.user_code
            left join (select operator_code, max(cast(created as date)) as last_placement from consignments
                       where deleted = 'false' and state <> 'CANCELLED' group by 1) c on c.operator_code = s.user_code
            left join (select user_code, kyc_status from operator_profiles where deleted = 'false') p
              on p.user_code = s.user_code
            left join (select user_code, count(*) filter (where rate > 0) as rated from rate_inputs
                       where active = 'true' group by 1) r on r.user_code = s.user_code
            where s.deleted = 'false'""",
        "acquisition_funnel_daily": funnel("subs_date", "day"),
        "acquisition_funnel_weekly": funnel("subs_week", "week"),
        "acquisition_funnel_monthly": funnel("subs_month", "month"),
        "calls_per_trip_daily": f"""
            select t.day, t.trips, k.calls_count, {_ratio("k.calls_count", "t.trips")} as calls_trips_ratio
            from (select cast({_shift("c.created")} as date) as day, count(c.code) as trips
                  from consignments c join demands d on d.id = c.demand_id where {_full_load("d.metadata")} group by 1) t
            left join (select cast(a.call_time as date) as day, count(distinct a.call_id) as calls_count
                       from call_records a join call_crm m on m.call_id = a.call_id
                       where a.product = 'Marketplace' and m.c_type = 'Customer'
                         and cast(a.call_time as date) >= date '2023-07-13'
                         and m.disposition_code in {_list(CALL_DISPOSITIONS)} group by 1) k on k.day = t.day""",
    }


def _payments() -> dict[str, str]:
    def daily(paid: str, source: str, extra: str = "") -> str:
        buckets = ("LessThan6Hr", "Btw6to12Hr", "Btw12to24Hr", "Morethan24Hr")
        counts = ", ".join(f"count(*) filter (where time_dispose = '{b}') as {b}" for b in buckets)
        shares = ", ".join(f"round({_percent(b, paid)}, 2) as {b}_prct" for b in buckets)
        return (
            f"select *, {shares} from (select cast(unloading_done_time as date) as month, "
            f"count(distinct code) as total_trips, count(time_dispose) as {paid}, {counts}{extra} "
            f"from {source} group by 1)"
        )

    def dispose(settled: str) -> str:
        return (
            "case when time_diff < 360 then 'LessThan6Hr' when time_diff <= 720 then 'Btw6to12Hr' "
            "when time_diff <= 1440 then 'Btw12to24Hr' when time_diff > 1440 then 'Morethan24Hr' "
            f"when coalesce(trip_bal < 200, true) and {settled} then 'LessThan6Hr' end as time_dispose"
        )

    trip_number = "split_part({}, '-', 2)"
    expense = (
        "(select consignment_id, sum(coalesce(amount, 0)) as v from expenses where category = '{}' "
        "and party_type = 'OPERATOR' and deleted = 'false' group by 1)"
    )
    balance = "op_freight + opadd - opsub - tds - oppaid"
    return {
        "balances": f"""
            select distinct *, {balance} as trip_bal
            from (
              select r.demand_id, r.op_freight, coalesce(a.v, 0.0) as opadd, coalesce(s.v, 0.0) as opsub,
                coalesce({_num("x.tds_value")}, 0.0) as tv,
                r.op_freight * coalesce({_num("x.tds_value")}, 0.0) as tds, p.v as oppaid
              from trip_reports r
              left join {expense.format("CREDIT")} a on a.consignment_id = {trip_number.format("r.consignment_code")}
              left join {expense.format("DEBIT")} s on s.consignment_id = {trip_number.format("r.consignment_code")}
              left join (select demand_id, tds_value from trip_reports qualify row_number() over (
                           partition by demand_id order by tds_amount nulls last, tds_value nulls first) = 1) x
                on x.demand_id = r.demand_id
              left join (select e.demand_id, sum(coalesce(b.amount, 0)) as v from trip_reports e
                         join bank_payments b on b.code = e.consignment_code
                         where b.otherparty = 'OPERATOR' and b.status in ('SUCCESS', 'DONE') group by 1) p
                on p.demand_id = r.demand_id
              where r.vehicle_state = 'TRIP_END')""",
        "trip_balance": """
            select distinct demand_id, op_freight, round(opadd, 4) as opadd, round(opsub, 4) as opsub, tv,
              round(tds, 4) as tds, round(oppaid, 4) as oppaid, round(trip_bal, 4) as trip_bal from balances""",
        "reported": f"""
            select distinct c.code, r.demand_id, c.offline_metadata, r.unloading_done_time, r.trip_start_time
            from consignments c
            join trip_reports r on r.demand_id = c.demand_id
            join demands d on d.id = r.demand_id
            join consigners n on n.code = r.consigner_code
            where r.unloading_done_time >= timestamp '2023-07-01' and c.deleted = 'false' and c.state = 'TRIP_END'
              and n.name not ilike '%testing%' and {_full_load("d.metadata")}
              and r.demand_id not in (select demand_id from demand_comments where remarks = 'DEMAND CANCELLED')
              and r.demand_id not in (select demand_id from demand_comments where remarks ilike '%acme_ptl%')""",
        "advance_rows": f"""
            select distinct *, {dispose("time_diff is null")} from (
              select t.code, t.demand_id, t.unloading_done_time, {_shift("a.created")} as raise_time,
                {_shift("a.updated")} as pay_time, a.amount, b.trip_bal,
                date_diff('minute', t.trip_start_time, {_shift("a.updated")}) as time_diff
              from reported t
              left join (select * from operator_transactions
                         where type = 'ADVANCE' and status = 'SUCCESS' and category = 'DEBIT' and deleted = 'false'
                         qualify {_newest("consignment_id", "updated", "created", "amount")}) a
                on a.consignment_id = {trip_number.format("t.code")}
              left join balances b on b.demand_id = t.demand_id)""",
        "advance_latency_daily": daily("advance_paid", "advance_rows"),
        "balance_rows": f"""
            select distinct *, {dispose("pay_time is null")} from (
              select *, date_diff('minute', case when entered is not null
                  then greatest(unloading_done_time, entered) end, pay_time) as time_diff
              from (
                select t.code, t.demand_id, t.unloading_done_time, {_shift("a.created")} as raise_time,
                  {_shift("a.actpaidtime")} as pay_time, a.amount, b.trip_bal,
                  {_json("t.offline_metadata", "podStatus")} as pod_status,
                  case when {_num(_json("t.offline_metadata", "podCollectedDate"))} > 0
                    then {_local(_num(_json("t.offline_metadata", "podCollectedDate")))} end as entered
                from reported t
                left join (select * from bank_payments where opsremarks = 'BALANCE' and status = 'SUCCESS'
                           qualify {_newest("code", "actpaidtime", "created", "amount")}) a on a.code = t.code
                left join balances b on b.demand_id = t.demand_id
                where {_json("t.offline_metadata", "podStatus")} = 'VERIFIED'
                  and {_json("t.offline_metadata", "podValidity")} = 'OK'))""",
        "balance_latency_daily": daily(
            "balance_paid", "balance_rows", ", count(*) filter (where pod_status = 'VERIFIED') as verified"
        ),
    }


def _outputs() -> dict[str, str]:
    tables = {
        ("fo_tkts", "trip_ticket_ratio_daily", "placement_date"): (
            "trips",
            "no_tickets_created_trips",
            "trip_atleast_1_tickets",
            "total_tickets_created",
            "ratio_trips_tickets",
            "no_trips_tickets_pct",
            "trips_tickets_pct",
        ),
        ("avg_quotes", "quotes_per_operator_daily", "quote_date"): ("demands", "operators", "quotes_per_op"),
        ("Call_fo", "calls_per_trip_daily", "day"): ("trips", "calls_count", "calls_trips_ratio"),
    }
    rows = [
        f"select '{section}' as section, '{m}' as metric, {period} as period, cast({m} as double) as value from {table}"
        for (section, table, period), metrics in tables.items()
        for m in metrics
    ]
    outputs = {
        "dmg_raw": "damage_daily",
        "tickets": "tickets_fact",
        "trip_end_raw": "trip_enriched",
        "can_raw": "cancellation_report",
        "sub_raw": "subscriptions_cumulative",
        "fo_tkts": "trip_ticket_ratio_daily",
        "avg_quotes": "quotes_per_operator_daily",
        "acq_pod_dod": "acquisition_funnel_daily",
        "acq_pod_wow": "acquisition_funnel_weekly",
        "acq_pod_mom": "acquisition_funnel_monthly",
        "Call_fo": "calls_per_trip_daily",
        "advance_op_payment": "advance_latency_daily",
        "bal_op_payment": "balance_latency_daily",
    }
    published = [
        f"select '{output}' as output, count(*) as n_rows, max(cast({ORDERED_BY[output]} as date)) as newest, {NOW} as refreshed_at from {table}"
        for output, table in outputs.items()
    ]
    return {
        "event_quality_counts_by_day": "select * from event_quality_counts",
        "event_quality_counts_streamed": "select * from event_quality_counts",
        "published_outputs": " union all ".join(published),
        "publish_stamped": f"select *, {NOW} as refreshed_at from quotes_per_operator_daily",
        "kpi_long": " union all ".join(rows),
    }


def oracle_sql() -> dict[str, str]:
    """SQL per registered query, on the given tables."""
    parts = {
        **duck_sources(),
        **_event_audit(),
        **_trips(),
        **_tickets(),
        **_cancellations(),
        **_growth(),
        **_payments(),
        **_outputs(),
    }
    # Names an expression reads: a part's name right after "from" or "join".
    reads = {
        name: [r for r in re.findall(r"\b(?:from|join)\s+([a-z_]\w*)", sql) if r in parts and r != name]
        for name, sql in parts.items()
    }

    def ordered(name: str, done: list[str]) -> list[str]:
        for read in reads[name]:
            if read not in done:
                ordered(read, done)
        if name not in done:
            done.append(name)
        return done

    def text(name: str) -> str:
        steps = [f"{step} as ({parts[step]})" for step in ordered(name, [])]
        return "with " + ",\n".join(steps) + f"\nselect * from {name}"

    return {name: text(name) for name in NAMES if name in parts}
