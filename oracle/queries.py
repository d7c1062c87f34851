"""Oracle text per query name."""

from __future__ import annotations

from spanloom.schemas import BRONZE_COLUMNS

from .ctes import compose, dbl, js, num, ts

_DATED = "TimeGenerated, Id, Name, OperationId, DurationMs, Success, Properties, date_routine"
_SPAN = "epoch_us(timestamp) as timestamp"

_NUMBER = """case event_id % 8 when 0 then cast(value as varchar) when 7 then '-' || cast(value as varchar)
  when 1 then '' when 3 then 'abc' when 4 then 'NaN' when 5 then 'Infinity' when 6 then '1e3' end"""

columns = {t: "'" + ", ".join(f"{c} string" for c in names) + "'" for t, names in BRONZE_COLUMNS.items()}

BODIES: dict[str, str] = {
    "export_unpack": f"select {_DATED} from app_requests",
    "csv_roundtrip": "select TimeGenerated, Message, OperationId, Properties, date_routine from app_traces",
    "export_ranges": f"select {_DATED} from app_requests",
    "csv_ranges": "select TimeGenerated, Message, OperationId, Properties, date_routine from app_traces",
    "bronze_versions": f"""
        select {_DATED} from app_requests
        where {ts('TimeGenerated')} is null or {ts('TimeGenerated')} >= timestamp '2024-01-10 12:00:00'""",
    "bronze_overwrite": f"select {_DATED} from app_requests",
    "bronze_date": "select Id, substring(TimeGenerated, 1, 10) as date_routine from app_requests",
    "scan_all": "select * from app_dependencies",
    "table_profile": f"""
        select 'app_requests' as table_name, count(*) as row_count, 43 as column_count, {columns['app_requests']} as columns from app_requests
        union all select 'app_dependencies', count(*), 43, {columns['app_dependencies']} from app_dependencies
        union all select 'app_traces', count(*), 36, {columns['app_traces']} from app_traces""",
    "retention_keep": f"""
        select Id, TimeGenerated from app_requests
        where {ts('TimeGenerated')} is null or {ts('TimeGenerated')} >= timestamp '2024-01-10 00:00:00'""",
    "span_union": "select * replace (epoch_us(timestamp) as timestamp) from span_union",
    "span_table": "select * exclude (Properties) replace (epoch_us(timestamp) as timestamp) from spans",
    "span_attrs": """select span_id, user_id, thread_id, run_id, tool_name, tool_input, tool_output, tokens_total,
        message_preview from spans""",
    "span_fill": f"""
        select {_SPAN}, name, kind,
          first_value(user_id ignore nulls) over w as user_id_filled,
          first_value(thread_id ignore nulls) over w as thread_id_filled, tool_name
        from spans window w as (partition by trace_id order by timestamp, span_id
          rows between unbounded preceding and unbounded following)""",
    "run_store_attrs": "select * from attrs",
    "users_active": "select user_id, count(*) as total_requests from spans where name = 'POST /chat' group by user_id",
    "threads_summary": """
        select thread_id, count(*) filter (where name = 'POST /chat') as interacciones,
          cast(sum(tokens_total) as bigint) as tokens_consumidos, epoch_us(max(timestamp)) as ultimo_mensaje
        from spans where thread_id is not null group by thread_id""",
    "interactions": f"""select {_SPAN}, user_id, thread_id, duration_ms, message_preview, tokens_total
        from spans where name = 'POST /chat'""",
    "tool_calls": f"""select {_SPAN}, trace_id, name, duration_ms, tool_input, tool_output, success
        from spans where name like 'tool.%'""",
    "audit_log": """
        select TimeGenerated as timestamp, OperationId as trace_id, json_extract_string(Message, '$.user_id') as user_id,
          json_extract_string(Message, '$.conversation.input') as input_completo,
          json_extract_string(Message, '$.conversation.output') as output_completo,
          json_extract_string(Message, '$.metrics.total_tokens') as tokens
        from app_traces where contains(Message, 'audit.business')""",
    "safe_numeric": f"""
        select event_id, case when isnan({dbl('x')}) then 'nan'
            when isinf({dbl('x')}) then 'Infinity' else cast(round({dbl('x')}, 4) as varchar) end as as_double,
          {num('x')} as as_long
        from (select event_id, {_NUMBER} as x from tele)""",
    "safe_timestamp": """
        select event_id, epoch_us(case event_id % 7 when 3 then ts - interval 2 hour when 4 then date_trunc('day', ts)
            when 5 then null when 6 then null else ts end) as micros from tele""",
    "props_safe": f"""
        select Id as span_id, cast(coalesce(len(json_keys(Properties)), 0) as int) as good_keys, 0 as bad_keys,
          coalesce({js('Properties', 'tool.kind')}, 'none') as tool_kind
        from (select Id, Properties from app_requests union all select Id, Properties from app_dependencies)""",
    "props_nested": f"""
        select TimeGenerated, Message, cast(len(json_keys(ev)) as int) as keys, json_extract_string(ev, '$.content') as content,
          coalesce(json_extract_string(ev, '$.id'), '') as id
        from (select *, {js('Properties', 'gen_ai.event.content')} as ev from app_traces where starts_with(Message, 'gen_ai.'))""",
    "assistant_text": "select time_text as TimeGenerated, text from assistant_all",
    "chat_requests": "select epoch_us(ts) as ts, request_id, start_time, duration_ms, user_id, thread_id, run_id from chat",
    "thread_owner": "select thread_id, user_id from owners",
    "run_first": "select run_id, thread_id, start_time, duration_ms from request_runs",
    "op_run_map": "select operation_id, operation_run from op_map",
    "dep_resolve": "select id, run_id, via from resolved",
    "run_universe": "select run_id, thread_id, start_time, origin = 0 as from_request, known_thread from skeleton",
    "run_attrs": "select * from attrs",
    "tools_extract": """select run_id, tool_id, start_time, duration_ms, tool_name, tool_type, tool_description, input_full,
        output_full, status, call_type, tool_function, tool_result from tools0""",
    "run_steps_extract": """select run_id, step_id, step_type, start_time, duration_ms, status, operation_name, agent_id,
        model from steps0""",
    "tools_attach": """
        select s.run_id, s.step_id, s.step_type, s.start_time, round(s.duration_ms, 4) as duration_ms, s.status,
          (select count(*) from tools0 t join hosts h using (run_id)
           where t.run_id = s.run_id and coalesce(h.host_id, 'step_tools_' || h.run_id) = s.step_id) as tool_count
        from steps s""",
    "trace_kinds": "select kind, count(*) as n from traces group by kind",
    "user_msg_asof": "select thread_id, epoch_us(ts) as ts, text, run_id from user_msgs",
    "assistant_first": """select run_id, coalesce(first(text order by ts) filter (where text <> ''), '') as output_message
        from assistant_msgs group by run_id""",
    "run_completed_asof": """select run_id, epoch_us(ts) as ts, input_tokens, output_tokens, total_tokens, duration_ms,
        status from completions""",
    "audit_assign": """select run_id, epoch_us(ts) as ts, total_tokens, status, has_metrics, agent_id, input, output,
        meta_trace, meta_span, meta_user, input_length, output_length from audits""",
    "run_events": "select run_id, epoch_us(ts) as ts, is_completion, total_tokens, status, agent_id from all_events",
    "tool_msg_zip": "select run_id, tool_id, nth, fill from tool_fills",
    "extract_counters": """
        select 'users' as counter, count(distinct user_id) as n from chat
        union all select 'threads', count(*) from owners
        union all select 'request_runs', count(*) from request_runs
        union all select 'runs', count(*) from skeleton
        union all select 'run_steps', count(*) from steps0
        union all select 'tools', count(*) from tools0
        union all select 'messages', count(*) from (
          select m.run_id from user_msgs m where run_id is not null and not exists (
            select 1 from user_msgs x where x.run_id = m.run_id and x.text <> '' and x.ts < m.ts) and not exists (
            select 1 from audits x where x.run_id = m.run_id and x.input <> '' and x.ts < m.ts)
          union all
          select m.run_id from assistant_msgs m where not exists (
            select 1 from assistant_msgs x where x.run_id = m.run_id and x.text <> '' and x.ts < m.ts) and not exists (
            select 1 from audits x where x.run_id = m.run_id and x.output <> '' and x.ts < m.ts))
        union all select 'run_events', count(*) from all_events""",
    "silver_users": "select user_id, total_interactions, total_tokens from users",
    "silver_threads": """select user_id, thread_id, start_time, end_time, round(duration_ms, 4) as duration_ms,
        total_input_tokens, total_output_tokens, total_tokens from threads""",
    "silver_runs": """select thread_id, run_id, agent_id, model, start_time, end_time, duration_ms, status, input_tokens,
        output_tokens, total_tokens, input_message, output_message from runs""",
    "silver_run_steps": """select run_id, step_id, step_type, start_time, end_time, duration_ms, status,
        cast(0 as bigint) as input_tokens, cast(0 as bigint) as output_tokens, cast(0 as bigint) as total_tokens from run_steps""",
    "silver_tools": """select step_id, tool_id, tool_name, tool_type, tool_description, start_time, end_time,
        round(duration_ms, 4) as duration_ms, input_full, output_full, status from tools""",
    "thread_rollup": """select thread_id, start_time, end_time, round(duration_ms, 4) as duration_ms, total_input_tokens,
        total_output_tokens, total_tokens, run_count from threads""",
    "user_rollup": "select user_id, total_interactions, total_tokens from users",
    "summary_global": """select (select count(*) from users) as users, (select count(*) from threads) as threads,
        (select count(*) from skeleton) as runs, (select cast(sum(total_tokens) as bigint) from users) as total_tokens""",
    "token_top_runs": """select run_id, input_tokens, output_tokens, total_tokens from runs
        order by total_tokens desc, run_id limit 10""",
    "token_top_threads": """select thread_id, total_input_tokens, total_output_tokens, total_tokens from threads
        order by total_tokens desc, thread_id limit 10""",
    "tool_usage": """select tool_name, count(tool_id) as invocations, round(avg(duration_ms), 4) as avg_duration_ms
        from tools group by tool_name order by invocations desc, tool_name limit 10""",
    "latency_stats": """select round(avg(duration_ms), 4) as avg_duration_ms, round(min(duration_ms), 4) as min_duration_ms,
        round(max(duration_ms), 4) as max_duration_ms from runs_all where known_thread""",
    "hierarchy_view": """
        select 'user' as level, user_id, null as thread_id, null as run_id, null as step_id, null as tool_id, null as name,
          null as tool_type, null as status, cast(null as boolean) as completed, null as model,
          cast(null as double) as duration_ms, cast(null as bigint) as input_tokens, cast(null as bigint) as output_tokens,
          total_tokens, total_interactions, null as input_preview, null as output_preview from users
        union all select 'thread', user_id, thread_id, null, null, null, null, null, null, null, null, round(duration_ms, 4), null,
          null, total_tokens, null, null, null from threads
        union all select 'run', t.user_id, r.thread_id, r.run_id, null, null, null, null, r.status, lower(r.status) = 'completed',
          r.model, r.duration_ms, r.input_tokens, r.output_tokens, r.total_tokens, null,
          case when length(input_message) > 100 then input_message[:100] || '...' else input_message end,
          case when length(output_message) > 100 then output_message[:100] || '...' else output_message end
          from runs r join threads t using (thread_id)
        union all select 'step', t.user_id, t.thread_id, s.run_id, s.step_id, null, s.step_type, null, null, null, null,
          s.duration_ms, null, null, null, null, null, null
          from run_steps s join runs r using (run_id) join threads t on t.thread_id = r.thread_id
        union all select 'tool', t.user_id, t.thread_id, x.run_id, x.step_id, x.tool_id, x.tool_name, x.tool_type, null, null, null,
          round(x.duration_ms, 4), null, null, null, null,
          case when length(input_full) > 80 then input_full[:80] || '...' else input_full end,
          case when length(output_full) > 80 then output_full[:80] || '...' else output_full end
          from tools x join runs r using (run_id) join threads t on t.thread_id = r.thread_id""",
    "hierarchy_json": """
        select 'user' as level, null as parent_id, user_id as node_id, total_tokens, cast(null as double) as duration_ms,
          null as meta_user, null as meta_operation, cast(null as int) as output_length from users
        union all select 'thread', user_id, thread_id, total_tokens, round(duration_ms, 4), null, null, null from threads
        union all select 'run', r.thread_id, r.run_id, r.total_tokens, r.duration_ms, a.meta_user, null, null
          from runs r left join (select run_id, last(meta_user order by ts) as meta_user from audits group by run_id) a using (run_id)
        union all select 'step', s.run_id, s.step_id, 0, s.duration_ms, null, s0.operation_name, null
          from run_steps s left join steps0 s0 on s0.run_id = s.run_id and s0.step_id = s.step_id
        union all select 'tool', step_id, tool_id, null, round(duration_ms, 4), null, null, cast(length(output_full) as int) from tools""",
}


# The same result by another way.
SAME = {
    "span_store_fill": "span_fill", "daily_users_active": "users_active", "daily_threads_summary": "threads_summary",
    **{f"document_{t}": f"silver_{t}" for t in ("users", "threads", "runs", "run_steps", "tools")},
    "daily_run_first": "run_first", "daily_op_run_map": "op_run_map", "export_stream": "export_unpack",
}
BODIES |= {name: BODIES[other] for name, other in SAME.items()}


def oracle_sql() -> dict[str, str]:
    return {name: compose(body) for name, body in BODIES.items()}
