"""DuckDB oracle: named CTEs over the raw tables, composed per query.

and correlated searches, so that it does not share logic with the Spark plans.
"""

from __future__ import annotations

import re

_FMT = "strftime(ts, '%Y-%m-%dT%H:%M:%S.%fZ')"


def js(column: str, key: str) -> str:
    return f"json_extract_string({column}, '$.\"{key}\"')"


def num(expr: str) -> str:
    """Text to bigint through double, truncating, 0 when bad."""
    d = f"try_cast({expr} as double)"
    return f"coalesce(case when isfinite({d}) then try_cast(trunc({d}) as bigint) end, 0)"


def dbl(expr: str) -> str:
    return f"coalesce(try_cast({expr} as double), 0.0)"


# Text times of the test data all end in Z, so the naive timestamp is the UTC one.
def ts(expr: str) -> str:
    return f"try_cast(replace({expr}, 'Z', '') as timestamp)"


CTES: dict[str, str] = {}

CTES["tele"] = f"""
select event_id, ts, user_id, event_type, value, {_FMT} as tg,
  concat('th-', user_id, '-', cast(floor((extract(day from ts)-1)/7) as int)) as thread_id,
  concat('op-', user_id, '-', extract(day from ts)) as op_id,
  'run-' || cast(last_value(case when event_type='purchase' then event_id end ignore nulls) over (
      partition by user_id, cast(floor((extract(day from ts)-1)/7) as int)
      order by ts, event_id rows between unbounded preceding and current row) as varchar) as cur_run
from events
"""

CTES["app_requests"] = """
select tg as TimeGenerated, concat('ev-', event_id) as Id,
  case when event_type='purchase' then 'POST /chat' else 'GET /health' end as Name,
  op_id as OperationId, '' as ParentId, 'true' as Success, cast(value as varchar) as DurationMs,
  case when event_type='purchase' then concat('{"user.id":"', user_id, '","azure.thread_id":"', thread_id,
    '","azure.run_id":"', cur_run, '","tokens.total":"', event_id % 500, '","message.preview":"m', event_id, '"}') end as Properties,
  substring(tg, 1, 10) as date_routine
from tele where event_type in ('purchase','signup')
"""

CTES["app_dependencies"] = """
select tg as TimeGenerated, concat('ev-', event_id) as Id,
  case when event_type='view' then 'agent.step' when event_type='error' then 'POST https://api'
       when event_id % 4 = 0 then 'search.kb' else concat('tool.t', event_id % 7) end as Name,
  case when event_type='click' then 'InProc' else 'HTTP' end as DependencyType,
  op_id as OperationId, concat('ev-', event_id - 1) as ParentId,
  case when event_id % 10 = 0 then 'false' else 'true' end as Success, cast(value as varchar) as DurationMs,
  case when event_type='click' then concat('{"tool.input_full":"in', event_id, '","tool.kind":"function"',
         case when event_id % 2 = 0 then '' else concat(',"tool.output_full":"out', event_id, '"') end,
         case when event_id % 3 = 0 then concat(',"tool.name":"named', event_id % 5, '"') else '' end, '}')
       when event_type='view' then concat('{"gen_ai.thread.id":"', thread_id, '"',
         case when cur_run is null then '' else concat(',"gen_ai.thread.run.id":"', cur_run, '"') end,
         ',"gen_ai.operation.name":"', case event_id % 6 when 0 then 'start_thread_run' when 1 then 'get_thread_run'
           when 2 then 'submit_tool_outputs' when 3 then 'create_message' when 4 then 'list_messages' else 'other' end,
         '","gen_ai.agent.id":"agent-', user_id % 5, '","gen_ai.response.model":"m', event_id % 3, '"',
         case when event_id % 4 = 0 then concat(',"gen_ai.usage.input_tokens":"', event_id % 90,
           '","gen_ai.usage.output_tokens":"', event_id % 70, '","gen_ai.usage.total_tokens":"', event_id % 90 + event_id % 70, '"') else '' end, '}')
  end as Properties,
  substring(tg, 1, 10) as date_routine
from tele where event_type in ('click','view') or (event_type='error' and event_id % 2 = 0)
"""

CTES["app_traces"] = r"""
select tg as TimeGenerated,
  case when event_type='signup' then 'gen_ai.user.message' when event_type='view' then 'gen_ai.assistant.message'
       when event_type='click' then 'gen_ai.tool.message' when event_id % 4 = 1 then 'run_completed'
       else concat('{"log_type":"audit.business","thread_id":"', thread_id, '","user_id":"', user_id,
         '","status":"RunStatus.COMPLETED","conversation":{"input":"ai', event_id, '","output":"ao', event_id,
         '","input_length":', event_id % 40, ',"output_length":', event_id % 60, '},"metrics":{"prompt_tokens":', event_id % 80,
         ',"completion_tokens":', event_id % 30, ',"total_tokens":', event_id % 80 + event_id % 30, ',"duration_ms":', cast(value as varchar),
         '},"extra":{"agent_id":"agent-x"', case when cur_run is null or event_id % 3 = 0 then '' else concat(',"run_id":"', cur_run, '"') end, '}}') end as Message,
  op_id as OperationId,
  case when event_type='signup' then concat('{"gen_ai.thread.id":"', thread_id, '","gen_ai.event.content":"{\"content\":\"hi ', event_id, '\"}"}')
       when event_type='view' then concat('{"gen_ai.thread.run.id":"', cur_run, '","gen_ai.event.content":"{\"content\":{\"text\":{\"value\":\"ok ', event_id, '\"}}}"}')
       when event_type='click' then concat('{"gen_ai.thread.run.id":"', cur_run, '","gen_ai.event.content":"{\"id\":\"c', event_id, '\",\"content\":\"tout ', event_id, '\"}"}')
       when event_id % 4 = 1 then concat('{"prompt_tokens":"', event_id % 50, '","completion_tokens":"', event_id % 20,
         '","total_tokens":"', event_id % 50 + event_id % 20, '","duration_ms":"', cast(value as varchar), '","status":"RunStatus.COMPLETED"}') end as Properties,
  substring(tg, 1, 10) as date_routine
from tele where event_type='signup' or (event_type='view' and event_id % 2 = 1 and cur_run is not null)
  or (event_type='click' and event_id % 2 = 0 and cur_run is not null) or (event_type='error' and event_id % 2 = 1)
"""

# --- spans ------------------------------------------------------------------------------------

CTES["span_union"] = f"""
select {ts('TimeGenerated')} as timestamp, OperationId as trace_id, Id as span_id, ParentId as parent_span_id,
  Name as name, 'SERVER' as kind, try_cast(DurationMs as double) as duration_ms, Success as success, Properties
from app_requests
union all
select {ts('TimeGenerated')}, OperationId, Id, ParentId, Name, DependencyType, try_cast(DurationMs as double), Success, Properties
from app_dependencies
"""

CTES["spans"] = f"""
select *, {js('Properties', 'user.id')} as user_id,
  coalesce({js('Properties', 'gen_ai.thread.id')}, {js('Properties', 'thread.id')}, {js('Properties', 'azure.thread_id')}) as thread_id,
  coalesce({js('Properties', 'gen_ai.thread.run.id')}, {js('Properties', 'run.id')}, {js('Properties', 'azure.run_id')}) as run_id,
  {js('Properties', 'tool.name')} as tool_name, {js('Properties', 'tool.input_full')} as tool_input,
  {js('Properties', 'tool.output_full')} as tool_output,
  try_cast(coalesce({js('Properties', 'gen_ai.usage.total_tokens')}, {js('Properties', 'tokens.total')}) as int) as tokens_total,
  coalesce({js('Properties', 'message.preview')}, {js('Properties', 'agent.response.preview')}) as message_preview
from span_union
"""

# --- requests ---------------------------------------------------------------------------------

CTES["chat"] = f"""
select {ts('TimeGenerated')} as ts, Id as request_id, TimeGenerated as start_time, {dbl('DurationMs')} as duration_ms,
  coalesce({js('Properties', 'user.id')}, 'unknown') as user_id, {js('Properties', 'azure.thread_id')} as thread_id,
  coalesce({js('Properties', 'azure.run_id')}, '') as run_id
from app_requests
where contains(Name, '/chat') and coalesce({js('Properties', 'azure.thread_id')}, '') <> ''
"""

CTES["owners"] = """
select thread_id, user_id, ts as thread_ts, request_id as thread_req
from chat qualify row_number() over (partition by thread_id order by ts, request_id) = 1
"""

CTES["request_runs"] = """
select run_id, thread_id, start_time, ts as start_ts, duration_ms, request_id
from chat where run_id <> '' qualify row_number() over (partition by run_id order by ts, request_id) = 1
"""

# --- dependencies -----------------------------------------------------------------------------

CTES["deps"] = f"""
select {ts('TimeGenerated')} as ts, Id as id, Name as name, TimeGenerated as start_time, {dbl('DurationMs')} as duration_ms,
  lower(Success) = 'true' as ok, nullif(OperationId, '') as operation_id, Properties as p,
  nullif({js('Properties', 'gen_ai.thread.run.id')}, '') as own_run,
  nullif({js('Properties', 'gen_ai.thread.id')}, '') as thread_id,
  coalesce({js('Properties', 'gen_ai.operation.name')}, '') as operation_name,
  nullif({js('Properties', 'gen_ai.agent.id')}, '') as agent_id,
  nullif({js('Properties', 'gen_ai.response.model')}, '') as model,
  nullif({js('Properties', 'gen_ai.thread.run.status')}, '') as run_status,
  nullif({js('Properties', 'gen_ai.usage.input_tokens')}, '') as input_tokens,
  nullif({js('Properties', 'gen_ai.usage.output_tokens')}, '') as output_tokens,
  nullif({js('Properties', 'gen_ai.usage.total_tokens')}, '') as total_tokens
from app_dependencies
"""

CTES["op_map"] = """
select operation_id, own_run as operation_run from deps where own_run is not null and operation_id is not null
qualify row_number() over (partition by operation_id order by ts desc, id desc) = 1
"""

CTES["own_runs"] = """
select own_run as run_id, min(struct_pack(ts := ts, id := id)) as f,
  (list(thread_id order by ts, id) filter (where thread_id is not null))[1] as thread_id
from deps where own_run is not null and own_run not in (select run_id from request_runs) group by own_run
"""

CTES["thread_map"] = """
select thread_id, run_id as thread_run from (
  select thread_id, run_id, 0 as origin, start_ts as ts, request_id as id from request_runs
  union all select thread_id, run_id, 1, f.ts, f.id from own_runs where thread_id is not null)
qualify row_number() over (partition by thread_id order by origin, ts, id) = 1
"""

CTES["resolved"] = """
select * from (
  select d.*, coalesce(own_run, operation_run, thread_run) as run_id,
    case when own_run is not null then 'own' when operation_run is not null then 'operation' else 'thread' end as via
  from deps d left join op_map using (operation_id) left join thread_map using (thread_id))
where run_id is not null
"""


def _last(column: str) -> str:
    return f"(list({column} order by ts desc, id desc) filter (where {column} is not null))[1]"


CTES["attrs"] = f"""
select run_id, coalesce({_last('agent_id')}, '') as agent_id, coalesce({_last('model')}, '') as model,
  coalesce({_last('run_status')}, '') as run_status, {num(_last('input_tokens'))} as input_tokens,
  {num(_last('output_tokens'))} as output_tokens, {num(_last('total_tokens'))} as total_tokens
from resolved group by run_id
"""

CTES["skeleton"] = """
with dep_runs as (
  select run_id, (list(thread_id order by ts, id) filter (where thread_id is not null))[1] as thread_id,
    min(struct_pack(ts := ts, id := id)) as f
  from resolved where run_id not in (select run_id from request_runs) group by run_id),
u as (
  select run_id, thread_id, start_time, start_ts, duration_ms, 0 as origin, start_ts as ord_ts, request_id as ord_id from request_runs
  union all
  select run_id, coalesce(thread_id, ''), '', null, 0.0, 1, f.ts, f.id from dep_runs)
select u.*, coalesce(agent_id, '') as agent_id, coalesce(model, '') as model, coalesce(run_status, '') as status,
  coalesce(input_tokens, 0) as input_tokens, coalesce(output_tokens, 0) as output_tokens, coalesce(total_tokens, 0) as total_tokens,
  u.thread_id in (select thread_id from owners) as known_thread
from u left join attrs using (run_id)
"""

CTES["tools0"] = f"""
select run_id, ts, id, id as tool_id,
  coalesce(nullif({js('p', 'tool.name')}, ''), case when starts_with(name, 'tool.') then name[6:] else name end) as tool_name,
  coalesce({js('p', 'tool.kind')}, 'function') as tool_type, coalesce({js('p', 'tool.description')}, '') as tool_description,
  start_time, duration_ms,
  coalesce(nullif({js('p', 'tool.input_full')}, ''), {js('p', 'tool.arguments')}, '') as input_full,
  coalesce({js('p', 'tool.output_full')}, '') as output_full,
  case when ok then 'completed' else 'failed' end as status,
  coalesce({js('p', 'tool.call_type')}, '') as call_type, coalesce({js('p', 'tool.function')}, '') as tool_function,
  coalesce({js('p', 'tool.result')}, '') as tool_result
from resolved
where starts_with(name, 'tool.') or starts_with(name, 'search.') or json_exists(p, '$."tool.name"')
"""

CTES["steps0"] = f"""
select run_id, ts, id, id as step_id,
  case operation_name when 'submit_tool_outputs' then 'tool_calls' else 'message_creation' end as step_type,
  start_time, duration_ms, coalesce({js('p', 'gen_ai.thread.run.status')}, 'completed') as status,
  operation_name, coalesce(agent_id, '') as agent_id, coalesce(model, '') as model
from resolved
where operation_name in ('start_thread_run', 'get_thread_run', 'submit_tool_outputs', 'create_message', 'list_messages')
"""

CTES["hosts"] = """
select t.run_id, t.ms, t.first_start, s.step_id as host_id
from (select run_id, sum(duration_ms) as ms, first(start_time order by ts, id) as first_start from tools0 group by run_id) t
left join (select run_id, step_id from steps0 where step_type = 'tool_calls'
           qualify row_number() over (partition by run_id order by ts, id) = 1) s using (run_id)
"""

CTES["steps"] = """
select s.run_id, s.step_id, s.step_type, s.start_time, coalesce(h.ms, s.duration_ms) as duration_ms, s.status,
  1 as step_rank, s.ts, s.id
from steps0 s left join hosts h on h.run_id = s.run_id and h.host_id = s.step_id
union all
select run_id, 'step_tools_' || run_id, 'tool_calls', first_start, ms, 'completed', 0, null, null from hosts where host_id is null
"""

# --- traces -----------------------------------------------------------------------------------

CTES["traces"] = """
select case when Message = 'gen_ai.user.message' then 'user' when Message = 'gen_ai.assistant.message' then 'assistant'
    when Message = 'run_completed' then 'completed' when contains(Message, 'audit.business') then 'audit'
    when Message = 'gen_ai.tool.message' then 'tool' else 'other' end as kind,
  """ + ts("TimeGenerated") + """ as ts, TimeGenerated as time_text, Message as m, Properties as p,
  """ + js("Properties", "gen_ai.event.content") + """ as ev,
  nullif(""" + js("Properties", "gen_ai.thread.run.id") + """, '') as run_id,
  nullif(""" + js("Properties", "gen_ai.thread.id") + """, '') as thread_id
from app_traces
"""

CTES["user_msgs"] = """
select m.thread_id, m.ts, coalesce(json_extract_string(m.ev, '$.content'), '') as text, r.run_id
from (select * from traces where kind = 'user' and thread_id is not null) m
asof left join (select thread_id, start_ts, last(run_id order by ord_ts, ord_id) as run_id from skeleton
                where start_ts is not null group by thread_id, start_ts) r
on m.thread_id = r.thread_id and m.ts >= r.start_ts
"""

CTES["assistant_all"] = """
select t.run_id, t.ts, t.time_text,
  coalesce(case when json_type(ev, '$.content.text') = 'OBJECT' then json_extract_string(ev, '$.content.text.value')
    when json_type(ev, '$.content') = 'OBJECT' then json_extract_string(ev, '$.content.text')
    else json_extract_string(ev, '$.content') end, '') as text
from traces t where kind = 'assistant'
"""

CTES["assistant_msgs"] = "select run_id, ts, text from assistant_all where run_id in (select run_id from skeleton)"

CTES["audits"] = f"""
with lines as (
  select ts, time_text, m, nullif(json_extract_string(m, '$.extra.run_id'), '') as audit_run,
    nullif(json_extract_string(m, '$.thread_id'), '') as audit_thread
  from traces where kind = 'audit' and starts_with(m, '{{') and json_valid(m)
    and json_extract_string(m, '$.log_type') = 'audit.business'),
firsts as (
  select thread_id, run_id from skeleton where thread_id <> ''
  qualify row_number() over (partition by thread_id order by origin, ord_ts, ord_id) = 1)
select * from (
  select coalesce((select k.run_id from skeleton k where k.run_id = l.audit_run), f.run_id) as run_id, l.ts, l.time_text,
    {num("json_extract_string(m, '$.metrics.prompt_tokens')")} as input_tokens,
    {num("json_extract_string(m, '$.metrics.completion_tokens')")} as output_tokens,
    {num("json_extract_string(m, '$.metrics.total_tokens')")} as total_tokens,
    {dbl("json_extract_string(m, '$.metrics.duration_ms')")} as duration_ms,
    replace(coalesce(json_extract_string(m, '$.status'), ''), 'RunStatus.', '') as status,
    len(json_keys(m, '$.metrics')) > 0 as has_metrics,
    nullif(json_extract_string(m, '$.extra.agent_id'), '') as agent_id,
    coalesce(json_extract_string(m, '$.conversation.input'), '') as input,
    coalesce(json_extract_string(m, '$.conversation.output'), '') as output,
    coalesce(json_extract_string(m, '$.trace_id'), '') as meta_trace, coalesce(json_extract_string(m, '$.span_id'), '') as meta_span,
    coalesce(json_extract_string(m, '$.user_id'), '') as meta_user,
    coalesce(cast(json_extract(m, '$.conversation.input_length') as bigint), 0) as input_length,
    coalesce(cast(json_extract(m, '$.conversation.output_length') as bigint), 0) as output_length
  from lines l left join firsts f on f.thread_id = l.audit_thread)
where run_id is not null
"""

CTES["completions"] = f"""
with recursive runs_of as (
  select k.run_id, k.total_tokens, k.start_ts, k.ord_ts, k.ord_id, k.thread_id, o.place,
    lead(k.start_ts) over (partition by k.thread_id order by k.start_ts, k.ord_ts, k.ord_id) as next_ts
  from skeleton k join (select thread_id, row_number() over (order by thread_ts, thread_req, thread_id) as place from owners) o using (thread_id)
  where k.start_ts is not null),
filled as (select run_id, min(ts) as filled_ts from audits where has_metrics and total_tokens <> 0 group by run_id),
open_runs as (
  select r.run_id, place, start_ts, next_ts, filled_ts, row_number() over () as i
  from runs_of r left join filled using (run_id) where r.total_tokens = 0),
events as (
  select row_number() over (order by ts) as n, ts, time_text, {num(js('p', 'prompt_tokens'))} as input_tokens,
    {num(js('p', 'completion_tokens'))} as output_tokens, {num(js('p', 'total_tokens'))} as total_tokens,
    {dbl(js('p', 'duration_ms'))} as duration_ms, replace(coalesce({js('p', 'status')}, ''), 'RunStatus.', '') as status
  from traces where kind = 'completed' and ts is not null),
-- the current run of every thread at every event, if it is without tokens then but for earlier completions
asked as (
  select e.n, e.total_tokens, list(r.i order by r.place) as candidates
  from events e left join open_runs r on r.start_ts <= e.ts and (r.next_ts is null or r.next_ts > e.ts)
    and (r.filled_ts is null or r.filled_ts > e.ts)
  group by e.n, e.total_tokens),
-- one step an event: the first thread whose run no earlier completion has used
walk as (
  select 0::bigint as n, []::bigint[] as used, null::bigint as pick
  union all
  select n, case when pick is not null and total_tokens <> 0 then list_append(used, pick) else used end, pick
  from (
    select a.n, a.total_tokens, w.used, list_filter(a.candidates, lambda c: c is not null and not list_contains(w.used, c))[1] as pick
    from walk w join asked a on a.n = w.n + 1)
)
select r.run_id, e.ts, e.time_text, e.input_tokens, e.output_tokens, e.total_tokens, e.duration_ms, e.status
from walk w join events e using (n) join open_runs r on r.i = w.pick
"""

CTES["all_events"] = """
select run_id, ts, time_text, input_tokens, output_tokens, total_tokens, duration_ms, status, true as has_metrics,
  true as is_completion, null as agent_id, null as input, null as output from completions
union all
select run_id, ts, time_text, input_tokens, output_tokens, total_tokens, duration_ms, status, has_metrics,
  false, agent_id, input, output from audits
"""


def _fst(expr: str, cond: str) -> str:
    return f"(list({expr} order by ts) filter (where {cond}))[1]"


def _lst(expr: str, cond: str) -> str:
    return f"(list({expr} order by ts desc) filter (where {cond}))[1]"


CTES["settled"] = f"""
select run_id,
  coalesce({_fst('struct_pack(i := input_tokens, o := output_tokens, t := total_tokens, d := duration_ms)', 'has_metrics and total_tokens > 0')},
           {_lst('struct_pack(i := input_tokens, o := output_tokens, t := total_tokens, d := duration_ms)', 'has_metrics')}) as u,
  {_lst('status', 'true')} as status, {_lst('time_text', 'true')} as end_time, {_lst('agent_id', 'agent_id is not null')} as agent_id
from all_events group by run_id
"""

CTES["texts"] = """
select run_id, first(text order by ts) as text, 'in' as side from (
  select run_id, ts, text from user_msgs where run_id is not null union all select run_id, ts, input from audits)
where text <> '' group by run_id
union all
select run_id, first(text order by ts), 'out' from (
  select run_id, ts, text from assistant_msgs union all select run_id, ts, output from audits)
where text <> '' group by run_id
"""

CTES["runs_all"] = """
select k.thread_id, k.run_id, coalesce(s.agent_id, k.agent_id) as agent_id, k.model, k.start_time, k.start_ts,
  coalesce(s.end_time, '') as end_time,
  case when k.total_tokens <> 0 or s.u is null then k.duration_ms else s.u.d end as duration_ms,
  coalesce(s.status, k.status) as status,
  case when k.total_tokens <> 0 or s.u is null then k.input_tokens else s.u.i end as input_tokens,
  case when k.total_tokens <> 0 or s.u is null then k.output_tokens else s.u.o end as output_tokens,
  case when k.total_tokens <> 0 or s.u is null then k.total_tokens else s.u.t end as total_tokens,
  coalesce(i.text, '') as input_message, coalesce(o.text, '') as output_message, k.known_thread, k.origin, k.ord_ts, k.ord_id
from skeleton k left join settled s using (run_id)
left join texts i on i.run_id = k.run_id and i.side = 'in'
left join texts o on o.run_id = k.run_id and o.side = 'out'
"""

CTES["runs"] = """
select thread_id, run_id, agent_id, model, start_time, end_time, round(duration_ms, 4) as duration_ms, status,
  input_tokens, output_tokens, total_tokens, input_message, output_message, start_ts, origin, ord_ts, ord_id
from runs_all where known_thread
"""

CTES["tool_fills"] = """
with msgs as (
  select run_id, ts, coalesce(json_extract_string(ev, '$.content'), '') as text, coalesce(json_extract_string(ev, '$.id'), '') as mid
  from traces where kind = 'tool' and run_id is not null),
places as (
  select run_id, tool_id, output_full, sum(case when output_full = '' then 1 else 0 end) over (partition by run_id order by ts, id) as empties,
    row_number() over (partition by run_id, tool_id order by ts, id) as copy from tools0),
numbered as (
  select msgs.run_id, text, p.empties as stop_at, row_number() over (partition by msgs.run_id order by ts) as n
  from msgs left join places p on p.run_id = msgs.run_id and p.tool_id = msgs.mid and p.copy = 1 where text <> ''),
walk as (
  with recursive w(run_id, n, filled, fills, text) as (
    select run_id, 0::bigint, 0::bigint, false, null::varchar from (select distinct run_id from numbered)
    union all
    select w.run_id, w.n + 1, w.filled + case when x.stop_at is null or w.filled < x.stop_at then 1 else 0 end,
      x.stop_at is null or w.filled < x.stop_at, x.text
    from w join numbered x on x.run_id = w.run_id and x.n = w.n + 1)
  select * from w),
m as (select run_id, text, filled as nth from walk where fills),
t as (select run_id, tool_id, empties::bigint as nth from places where output_full = '')
select t.run_id, t.tool_id, t.nth, m.text as fill from t join m on m.run_id = t.run_id and m.nth = t.nth
"""

CTES["tools"] = """
select coalesce(h.host_id, 'step_tools_' || t.run_id) as step_id, t.run_id, t.tool_id, t.tool_name, t.tool_type, t.tool_description,
  t.start_time, '' as end_time, t.duration_ms, t.input_full, coalesce(f.fill, t.output_full) as output_full, t.status, t.ts, t.id
from tools0 t join hosts h using (run_id) left join tool_fills f on f.run_id = t.run_id and f.tool_id = t.tool_id
where t.run_id in (select run_id from runs)
"""

CTES["run_steps"] = """
select run_id, step_id, step_type, start_time, '' as end_time, round(duration_ms, 4) as duration_ms, status, step_rank, ts, id
from steps where run_id in (select run_id from runs)
"""

_ISO = """case when {0} is null then '' when microsecond({0}) % 1000000 = 0 then strftime({0}, '%Y-%m-%dT%H:%M:%S+00:00')
  else strftime({0}, '%Y-%m-%dT%H:%M:%S.%f+00:00') end"""

CTES["threads"] = f"""
select o.user_id, o.thread_id, {_ISO.format('a.first_ts')} as start_time, {_ISO.format('a.last_ts')} as end_time,
  coalesce((epoch_us(a.last_ts) - epoch_us(a.first_ts)) / 1000.0, 0.0) as duration_ms,
  cast(coalesce(a.i, 0) as bigint) as total_input_tokens, cast(coalesce(a.o, 0) as bigint) as total_output_tokens,
  cast(coalesce(a.t, 0) as bigint) as total_tokens, coalesce(a.n, 0) as run_count, o.thread_ts, o.thread_req
from owners o left join (
  select thread_id, min(start_ts) as first_ts, max(start_ts) as last_ts, sum(input_tokens) as i, sum(output_tokens) as o,
    sum(total_tokens) as t, count(*) as n from runs group by thread_id) a using (thread_id)
"""

CTES["users"] = """
select c.user_id, cast(coalesce(t.n, 0) as bigint) as total_interactions, cast(coalesce(t.tok, 0) as bigint) as total_tokens
from (select distinct user_id from chat) c
left join (select user_id, sum(run_count) as n, sum(total_tokens) as tok from threads group by user_id) t using (user_id)
"""


def compose(body: str) -> str:
    """Prefix ``body`` with the CTEs it needs, in dependency order."""
    ordered: list[str] = []

    def add(name: str) -> None:
        for other in CTES:
            if other != name and other not in ordered and re.search(rf"\b(from|join)\s+{other}\b", CTES[name]):
                add(other)
        if name not in ordered:
            ordered.append(name)

    for name in CTES:
        if re.search(rf"\b(from|join)\s+{name}\b", body):
            add(name)
    if not ordered:
        return body.strip()
    ctes = ",\n".join(f"{name} as ({CTES[name].strip()})" for name in ordered)
    return f"with {ctes}\n{body.strip()}"
