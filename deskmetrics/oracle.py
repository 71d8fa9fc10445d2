"""DuckDB oracle SQL for the registered queries.

Written independently of the Spark code, as plain SQL over the driver's
tables (pre-registered as views).  Every query is ``WITH <shared CTEs>
<final select>``; DuckDB skips CTEs a query does not reference.

Portability notes:
* DuckDB has no ``initcap``: split on single blanks and upper-case the first
  letter of each piece, as Spark does.
* DuckDB's ``round(double)`` and Spark's differ on halves (38.925 -> 38.92 vs
  38.93); ``ROUND2`` rounds the shortest decimal text of the double half up,
  which is what Spark does.
* NULL ordering differs between the engines, so every window spells it out.
"""

from __future__ import annotations

FMT = "'%Y-%m-%d %H:%M:%S'"


def _ts(x: str) -> str:
    return (f"try_strptime(regexp_replace(regexp_replace({x}, '\\+00:00$', ''), "
            f"'\\.(\\d+)$', ''), {FMT})")


def _initcap(x: str) -> str:
    return (f"array_to_string(list_transform(string_split(lower({x}), ' '), "
            f"lambda w: upper(left(w, 1)) || substr(w, 2)), ' ')")


def ROUND2(x: str) -> str:  # noqa: N802 - reads like SQL
    return f"cast(round(cast(cast({x} as varchar) as decimal(38, 12)), 2) as double)"


def _hours(end: str, start: str) -> str:
    return (f"case when {end} is not null then "
            f"(epoch({end}) - epoch({start})) / 3600.0::double end")


_THRESHOLD = ("case priority when 'Critical' then 4.0::double when 'High' then 24.0::double "
              "when 'Medium' then 72.0::double when 'Low' then 168.0::double end")

# whole seconds are added up, so the mean does not depend on the order of rows
_EXACT_MEAN = ("cast(sum(cast(round(resolution_duration_hours * 3600) as bigint)) as double) "
               "/ (count(resolution_duration_hours) * 3600.0::double)")

CTES: list[tuple[str, str]] = [
    ("li", """select l_orderkey, sum(l_quantity) q, min(l_partkey) pk, min(l_suppkey) sk, count(*) n_lines
        from lineitem group by l_orderkey"""),
    ("one", """select o_orderkey id,
          '  ' || lower(n_name) || ' ' issue_proj,
          case when o_orderkey % 29 <> 0 then rep.c_name end issue_reporter,
          case when o_orderkey % 13 <> 0 then s_name end issue_assignee,
          n_lines issue_contr_count,
          case o_orderpriority when '1-URGENT' then 'critical' when '2-HIGH' then ' HIGH '
            when '3-MEDIUM' then 'Medium' when '5-LOW' then 'low'
            else case when o_orderkey % 2 = 0 then 'blocker' end end issue_priority,
          case when o_orderkey % 17 <> 0 then ' ' || lower(p_type) end issue_type,
          o_orderdate created,
          case when o_orderstatus <> 'O' and q is not null then o_orderdate + to_hours(cast(
            case when o_orderkey % 40 = 0 then -q when o_orderkey % 17 = 0 then q + 400 else q end
            as bigint)) + to_minutes(o_orderkey % 60) + to_seconds(o_orderkey * 7 % 60) end resolved,
          o_orderstatus issue_status
        from orders
        left join li on l_orderkey = o_orderkey
        left join customer c on c.c_custkey = o_custkey
        left join customer rep on rep.c_custkey =
          case when o_orderkey % 4 = 0 then o_custkey % 10 else o_custkey end
        left join nation on n_nationkey = c.c_nationkey
        left join supplier on s_suppkey = case when o_orderkey % 4 = 0 then o_orderkey % 7 else sk end
        left join part on p_partkey = pk"""),
    ("two", """select * from one union all
        select id, issue_proj, issue_reporter, issue_assignee, issue_contr_count, issue_priority,
          issue_type, created + interval 1 day, resolved + interval 1 day, issue_status
        from one where id % 50 = 0"""),
    ("raw_issues", f"""select cast(id as varchar) id, cast(id as varchar) issue_num, issue_proj,
          issue_reporter, issue_assignee, cast(issue_contr_count as varchar) issue_contr_count,
          issue_priority, issue_type,
          strftime(created, {FMT}) || case id % 3 when 0 then '+00:00' when 1 then '.564000' else '' end
            issue_created,
          strftime(resolved, {FMT}) || case id % 3 when 0 then '' when 1 then '+00:00' else '.250000' end
            issue_resolution_date,
          case when resolved is not null then 'Done' end issue_resolution,
          issue_status,
          cast(id % 11 as varchar) issue_comments_count,
          strftime(created + interval 2 day, {FMT}) last_change_date,
          cast(id * 60 as varchar) wf_total_time,
          cast(id % 9 as varchar) processing_steps
        from two"""),
    ("raw_changes", f"""select cast(l_orderkey * 10 + l_linenumber as varchar) id,
          cast(l_orderkey as varchar) issueid,
          case when l_linenumber % 2 = 1 then 'status' else 'assignee' end field,
          case when l_linenumber % 2 = 1 then
              case l_returnflag when 'N' then 'In Progress' when 'A' then 'Resolved'
                else case l_linestatus when 'F' then 'Closed' else 'Reopened' end end
            else case when l_partkey % 23 <> 0 then s_name end end value,
          strftime(l_shipdate, {FMT}) || case l_linenumber % 3 when 0 then '+00:00'
            when 1 then '.100000' else '' end created,
          cast(l_orderkey as varchar) change_group_id
        from lineitem left join supplier on s_suppkey = l_suppkey"""),
    ("issues", """select try_cast(id as bigint) id, try_cast(issue_num as bigint) issue_num,
          issue_proj, issue_reporter, issue_assignee,
          try_cast(issue_contr_count as integer) issue_contr_count, issue_priority, issue_type,
          issue_created, issue_resolution_date, issue_resolution, issue_status,
          try_cast(issue_comments_count as integer) issue_comments_count, last_change_date,
          try_cast(wf_total_time as bigint) wf_total_time,
          try_cast(processing_steps as integer) processing_steps
        from raw_issues"""),
    ("changes", """select try_cast(id as bigint) id, try_cast(issueid as bigint) issueid, field, value,
          created, try_cast(change_group_id as bigint) change_group_id from raw_changes"""),
    ("parsed", f"""select * replace ({_ts('issue_created')} as issue_created,
          {_ts('issue_resolution_date')} as issue_resolution_date,
          {_ts('last_change_date')} as last_change_date) from issues"""),
    ("changes_parsed", f"select * replace ({_ts('created')} as created) from changes"),
    ("valid", """select * from parsed
        where issue_resolution_date is null or issue_resolution_date >= issue_created"""),
    ("deduped", """select * exclude (rn) from (select *, row_number() over (partition by id
          order by issue_created asc nulls first, last_change_date desc nulls last) rn from valid)
        where rn = 1"""),
    ("latest", """select * exclude (rn) from (select *, row_number() over (partition by issueid, field
          order by created desc nulls last, id desc nulls last, value desc nulls last) rn
          from changes_parsed) where rn = 1"""),
    ("state", """select coalesce(a.issueid, s.issueid) issueid, a.value current_assignee,
          a.created last_assigned_at, s.value current_status
        from (select * from latest where field = 'assignee') a
        full outer join (select * from latest where field = 'status') s on a.issueid = s.issueid"""),
    ("staged", f"""select d.id ticket_id, d.issue_reporter reporter,
          coalesce(st.current_assignee, d.issue_assignee) assignee,
          upper(trim(d.issue_proj)) project,
          case when d.issue_type is null then 'Uncategorized' else {_initcap('trim(d.issue_type)')} end
            category,
          {_initcap('trim(d.issue_priority)')} priority,
          d.issue_created start_time, d.issue_resolution_date resolution_time,
          {_hours('d.issue_resolution_date', 'd.issue_created')} resolution_duration_hours,
          st.current_status status,
          d.issue_contr_count, d.processing_steps, d.wf_total_time
        from deduped d left join state st on d.id = st.issueid"""),
    ("fact", f"""select ticket_id, reporter, assignee, project, category, priority, start_time,
          resolution_time, resolution_duration_hours, status,
          case when resolution_duration_hours is not null and ({_THRESHOLD}) is not null
            then resolution_duration_hours <= ({_THRESHOLD}) end resolution_target_met,
          case when priority is not null and priority not in ('Critical', 'High', 'Medium', 'Low')
            then 'UNRECOGNIZED_PRIORITY' end priority_flag,
          issue_contr_count, processing_steps, wf_total_time
        from staged"""),
    ("fact_rest", f"""select * replace (cast({ROUND2('resolution_duration_hours')} as decimal(10, 2))
          as resolution_duration_hours) from fact"""),
    ("names", """select distinct 'reporter' role, reporter name from fact where reporter is not null
        union all select distinct 'assignee', assignee from fact where assignee is not null
        union all select distinct 'project', project from fact where project is not null"""),
    ("keyed", """select role, name, cast(row_number() over (partition by role order by name) as bigint) key
        from names"""),
    ("dim_customers", "select key customer_id, name reporter_name from keyed where role = 'reporter'"),
    ("dim_agents", "select key agent_id, name agent_name from keyed where role = 'assignee'"),
    ("dim_projects", "select key project_id, name project_name from keyed where role = 'project'"),
    ("fact_keys", """select f.*, c.customer_id, a.agent_id, p.project_id from fact f
        left join dim_customers c on f.reporter = c.reporter_name
        left join dim_agents a on f.assignee = a.agent_name
        left join dim_projects p on f.project = p.project_name"""),
    ("wfact", f"""select ticket_id, customer_id, agent_id, project_id, category, priority, start_time,
          resolution_time,
          cast({ROUND2('resolution_duration_hours')} as decimal(10, 2)) resolution_duration_hours,
          status, resolution_target_met from fact_keys"""),
    ("agent_vol", f"""select assignee, count(ticket_id) tickets_resolved,
          {ROUND2(_EXACT_MEAN)} avg_resolution_duration_hours
        from fact where resolution_time is not null group by assignee"""),
    ("agent_ranked", """select *, cast(dense_rank() over (order by tickets_resolved desc) as integer)
          rank_by_volume from agent_vol"""),
    ("agent_perf", """select a.agent_id, cast(r.tickets_resolved as integer) tickets_resolved,
          cast(r.avg_resolution_duration_hours as decimal(10, 2)) avg_resolution_duration_hours, r.rank_by_volume
        from agent_ranked r left join dim_agents a on r.assignee = a.agent_name"""),
    ("res_perf", f"""select priority, date_trunc('month', resolution_time) as month,
          cast(count(ticket_id) as integer) tickets_resolved,
          cast({ROUND2('100.0::double * sum(cast(resolution_target_met as integer)) / count(ticket_id)')}
            as decimal(5, 2)) compliance_rate
        from fact where resolution_time is not null group by all"""),
    ("cat_monthly", f"""select category, date_trunc('month', start_time) as month, count(ticket_id) ticket_volume,
          {_EXACT_MEAN} avg_h
        from fact group by all"""),
    ("cat_trends_h", f"""select *, case when prev is not null and prev > 0 then
          {ROUND2('100.0::double * (ticket_volume - prev) / prev')} end volume_change_pct
        from (select *, lag(ticket_volume) over (partition by category order by month asc nulls first) prev
              from cat_monthly)"""),
    ("cat_trends", "select category, month, ticket_volume, volume_change_pct from cat_trends_h"),
    ("planted", """select case when ticket_id % 109 <> 0 then ticket_id end ticket_id, ticket_id own,
          case when ticket_id % 103 = 0 then repeat('x', 70) else category end category,
          case when ticket_id % 107 = 0 then -5 else customer_id end customer_id
        from wfact, unnest(range(case when ticket_id % 101 = 0 then 2 else 1 end)) t(n)"""),
    ("disp", """select w.*, p.project_name, a.agent_name, strftime(start_time, '%Y-%m') ym from wfact w
        left join dim_projects p on p.project_id = w.project_id
        left join dim_agents a on a.agent_id = w.agent_id"""),
    ("heat_cats", """select category from disp where category is not null group by category
        order by count(*) desc, category limit 10"""),
    ("heat_months", "select distinct ym from disp where ym is not null order by ym desc limit 12"),
    ("heat", """select * from disp where category in (select category from heat_cats)
        and ym in (select ym from heat_months)"""),
    ("loads", "select assignee agent_name, count(*) tickets from fact where assignee is not null group by 1"),
]



def with_ctes(final: str) -> str:
    body = ",\n".join(f"{name} AS (\n{sql}\n)" for name, sql in CTES)
    return f"WITH {body}\n{final}"



def _top(col: str, n: int, frame: str = "disp") -> str:
    return (f"select {col}, count(*) tickets from {frame} where {col} is not null group by {col} "
            f"order by tickets desc, {col} limit {n}")


def _checks(rows: list[tuple[str, str, str]]) -> str:
    return "\nunion all ".join(
        f"select '{t}' table_name, '{c}' column_name, cast(({expr}) as bigint) violations"
        for t, c, expr in rows)


_DIMS = (("dim_customers", "customer_id", "reporter_name"),
         ("dim_agents", "agent_id", "agent_name"),
         ("dim_projects", "project_id", "project_name"))


def _dups(table: str, col: str) -> str:
    return (f"select count(*) from (select {col} from {table} where {col} is not null "
            f"group by {col} having count(*) > 1)")


def _nulls(table: str, col: str) -> str:
    return f"select count(*) from {table} where {col} is null"


def _out_of_range(table: str, col: str, dec: str) -> str:
    return (f"select count(*) from {table} where {col} is not null "
            f"and try_cast({col} as {dec}) is null")


def _too_long(table: str, col: str, n: int) -> str:
    return f"select count(*) from {table} where length({col}) > {n}"


_MEAN = "sum(resolution_duration_hours)::double / count(resolution_duration_hours)"
_RECENT = ("start_time >= (select max(start_time) from fact) - interval 30 day "
           "and category is not null")
_MET_PCT = "avg(cast(coalesce(resolution_target_met, false) as integer)) * 100.0::double"

FINAL: dict[str, str] = {
    # sources
    "scan_issues": "select * from issues",
    "scan_changes": "select * from changes",
    "scan_issues_csv": "select * from issues",
    "scan_changes_csv": "select * from changes",
    "input_counts": """select 'issues' source, count(*) rows from issues
        union all select 'changes', count(*) from changes""",
    "dashboard_base": """select w.*, p.project_name, a.agent_name from wfact w
        left join dim_projects p on p.project_id = w.project_id
        left join dim_agents a on a.agent_id = w.agent_id""",
    "preview": """select w.*, p.project_name, a.agent_name from wfact w
        left join dim_projects p on p.project_id = w.project_id
        left join dim_agents a on a.agent_id = w.agent_id order by ticket_id limit 5""",
    # projections
    "parse_timestamps": "select id, issue_created, issue_resolution_date, last_change_date from parsed",
    "invalid_resolution_count": """select
        count(*) filter (where issue_resolution_date is not null and issue_resolution_date < issue_created)
          invalid_rows,
        count(*) filter (where issue_resolution_date is not null and issue_created is null)
          resolved_without_created
      from parsed""",
    "valid_issues": "select * from valid",
    "resolution_hours": f"""select id ticket_id,
        {_hours('issue_resolution_date', 'issue_created')} resolution_duration_hours from deduped""",
    "standardize_category": f"""select id ticket_id, case when issue_type is null then 'Uncategorized'
        else {_initcap('trim(issue_type)')} end category from deduped""",
    "standardize_priority": f"select id ticket_id, {_initcap('trim(issue_priority)')} priority from deduped",
    "priority_flag": """select ticket_id, priority, priority_flag from fact""",
    "standardize_project": "select id ticket_id, upper(trim(issue_proj)) project from deduped",
    "sla_target_met": f"""select ticket_id, priority, resolution_duration_hours,
        {_THRESHOLD} threshold_hours, resolution_target_met from fact""",
    "fact_tickets": "select * from fact",
    "warehouse_fact": "select * from wfact",
    # state and joins
    "latest_change_per_field": """select issueid, field, id, value, created, change_group_id from (
        select *, row_number() over (partition by issueid, field order by created desc nulls last,
          id desc nulls last, value desc nulls last, change_group_id desc nulls last) rn
        from changes_parsed) where rn = 1""",
    "current_state": "select * from state",
    "dedup_tickets": "select * from deduped",
    "ticket_current_state": """select d.id ticket_id, s.current_assignee, s.last_assigned_at,
        s.current_status from deduped d left join state s on d.id = s.issueid""",
    "fact_with_keys": """select ticket_id, reporter, customer_id, assignee, agent_id, project, project_id
        from fact_keys""",
    # star schema
    "dim_customers": "select * from dim_customers",
    "dim_agents": "select * from dim_agents",
    "dim_projects": "select * from dim_projects",
    # marts
    "agent_volume": "select * from agent_vol",
    "agent_rank_by_volume": "select * from agent_ranked",
    "agent_performance": "select * from agent_perf",
    "resolution_performance": "select * from res_perf",
    "category_monthly_volume": "select category, month, ticket_volume from cat_monthly",
    "category_trends": """select category, month, cast(ticket_volume as integer) ticket_volume,
        cast(volume_change_pct as decimal(12, 2)) volume_change_pct from cat_trends""",
    # reports
    "sla_by_priority": f"""select priority, count(*) total_tickets,
        cast(sum(case when resolution_target_met = true then 1 else 0 end) as bigint) met_target,
        {ROUND2('100.0::double * sum(case when resolution_target_met = true then 1 else 0 end) / nullif(count(*), 0)')}
          compliance_rate_pct
      from fact where resolution_time is not null group by priority""",
    "top_agents_last_month": """select assignee agent_name, count(ticket_id) tickets_resolved
      from fact
      where assignee is not null
        and resolution_time >= date_trunc('month', (select max(resolution_time) from fact) - interval 1 month)
        and resolution_time < date_trunc('month', (select max(resolution_time) from fact))
      group by assignee order by tickets_resolved desc, agent_name limit 5""",
    "avg_resolution_by_project": f"""select project project_name, count(ticket_id) total_tickets,
        {ROUND2(_MEAN)} avg_resolution_hours
      from fact_rest where resolution_duration_hours is not null and project is not null
      group by project order by avg_resolution_hours, project_name limit 20""",
    "view_avg_resolution_by_project": f"""select project project_name, count(ticket_id) total_tickets,
        {ROUND2(_MEAN)} avg_resolution_hours
      from fact_rest where resolution_duration_hours is not null and project is not null group by project""",
    "agent_rank_by_speed": f"""select agent_name, avg_resolution_hours, rank_by_speed from (
        select assignee agent_name, {ROUND2(_MEAN)} avg_resolution_hours,
          cast(rank() over (order by {_MEAN}) as integer) rank_by_speed
        from fact_rest where resolution_duration_hours is not null and assignee is not null
        group by assignee)
      order by rank_by_speed, agent_name limit 20""",
    "heavy_reporters": """select reporter reporter_name, date_trunc('month', start_time) ticket_month,
        count(*) ticket_count
      from fact where reporter is not null group by all having count(*) > 5
      order by ticket_count desc, reporter_name, ticket_month nulls first limit 20""",
    "running_resolved_total": """select month, monthly_resolved,
        cast(sum(monthly_resolved) over (order by month asc nulls first
          range between unbounded preceding and current row) as bigint) running_total
      from (select date_trunc('month', resolution_time) as month, count(*) monthly_resolved
            from fact where resolution_time is not null group by 1)""",
    "zero_compliance_categories": f"""select distinct category from fact where {_RECENT}
        and category not in (select category from fact where {_RECENT}
                             and resolution_target_met = true)""",
    "zero_compliance_categories_anti": f"""select distinct category from fact where {_RECENT}
        and category not in (select category from fact where {_RECENT}
                             and resolution_target_met = true)""",
    "resolution_stats_by_priority": f"""select priority, {ROUND2(_MEAN)} avg_resolution_hours,
        count(*) total_tickets,
        cast(min(resolution_duration_hours) as double) min_hours,
        cast(max(resolution_duration_hours) as double) max_hours
      from fact_rest where resolution_duration_hours is not null group by priority""",
    "status_distribution": f"""select status, count(*) ticket_count,
        {ROUND2('100.0::double * count(*) / sum(count(*)) over ()')} percentage
      from fact where status is not null group by status""",
    "view_status_distribution": f"""select status, count(*) ticket_count,
        {ROUND2('100.0::double * count(*) / sum(count(*)) over ()')} percentage
      from fact where status is not null group by status""",
    "fastest_agent_per_project": f"""select project_name, agent_name, avg_resolution_hours from (
        select project project_name, assignee agent_name, {ROUND2(_MEAN)} avg_resolution_hours,
          rank() over (partition by project order by {_MEAN}) rk
        from fact_rest where resolution_duration_hours is not null and assignee is not null
          and project is not null
        group by project, assignee)
      where rk = 1 order by project_name, agent_name limit 20""",
    # dashboard
    "kpi_overall_compliance": f"select {_MET_PCT} overall_compliance_pct from disp",
    "top_category": """select category top_category from disp where category is not null
        group by category order by count(*) desc, category limit 1""",
    "kpi_total_tickets": "select count(*) total_tickets from disp",
    "tickets_by_status": _top("status", 15),
    "tickets_by_priority": _top("priority", 10),
    "tickets_by_category": _top("category", 10),
    "tickets_per_month": """select ym, count(*) tickets from disp where ym is not null
        group by ym order by ym desc limit 20""",
    "avg_hours_by_priority": f"""select priority, {_MEAN} avg_hours from disp
        where priority is not null group by priority having count(resolution_duration_hours) > 0
        order by avg_hours desc, priority limit 10""",
    "target_met_split": """select resolution_target_met, count(*) tickets,
        100.0::double * count(*) / sum(count(*)) over () share_pct
      from disp where resolution_target_met is not null group by resolution_target_met""",
    "top_projects": _top("project_name", 15),
    "compliance_by_priority_all": f"""select priority, {_MET_PCT} compliance_pct from disp
        where priority is not null group by priority""",
    "monthly_compliance_trend": f"""select ym, {_MET_PCT} compliance_pct from disp
        where ym is not null group by ym order by ym desc limit 20""",
    "top_agents_by_tickets": _top("agent_name", 10),
    "top_n_by_count": "\nunion all ".join(
        f"select * from (select '{c}' dimension, {c} as value, count(*) tickets from disp "
        f"where {c} is not null group by {c} order by tickets desc, {c} limit {n})"
        for c, n in (("status", 15), ("priority", 10), ("category", 10), ("project_name", 15))),
    "top_agents_avg_hours": f"""select agent_name, count(*) tickets, {_MEAN} avg_hours
      from disp where agent_name is not null group by agent_name
      order by tickets desc, agent_name limit 10""",
    "category_month_heatmap": """select c.category, m.ym, cast(coalesce(h.n, 0) as bigint) ticket_count
      from (select distinct category from heat) c
      cross join (select distinct ym from heat) m
      left join (select category, ym, count(*) n from heat group by all) h
        on h.category = c.category and h.ym = m.ym""",
    # checks
    "check_unique": _checks([("fact_tickets", "ticket_id", _dups("wfact", "ticket_id"))]
                            + [(t, c, _dups(t, c)) for t, k, n in _DIMS for c in (k, n)]),
    "check_not_null": _checks([("fact_tickets", "ticket_id", _nulls("wfact", "ticket_id"))]
                              + [(t, c, _nulls(t, c)) for t, k, n in _DIMS for c in (k, n)]),
    "check_foreign_keys": _checks([
        ("fact_tickets", k, f"select count(*) from wfact where {k} is not null "
                            f"and {k} not in (select {k} from {t})") for t, k, _ in _DIMS]),
    "check_bounds": _checks([
        ("fact_tickets", "category", _too_long("fact", "category", 60)),
        ("fact_tickets", "priority", _too_long("fact", "priority", 20)),
        ("fact_tickets", "status", _too_long("fact", "status", 60)),
        ("fact_tickets", "resolution_duration_hours",
         _out_of_range("fact", "resolution_duration_hours", "decimal(10,2)"))]
        + [(t, n, _too_long(t, n, 120)) for t, _, n in _DIMS]
        + [("agent_performance", "avg_resolution_duration_hours",
            _out_of_range("agent_perf", "avg_resolution_duration_hours", "decimal(10,2)")),
           ("resolution_performance", "compliance_rate",
            _out_of_range("res_perf", "compliance_rate", "decimal(5,2)")),
           ("category_trends", "volume_change_pct",
            _out_of_range("cat_trends", "volume_change_pct", "decimal(12,2)"))]),
    "quality_counts": """select 'issues.rows_in' metric, (select count(*) from parsed) value
      union all select 'issues.invalid_resolution', (select count(*) from parsed
        where issue_resolution_date is not null and issue_resolution_date < issue_created)
      union all select 'issues.resolved_without_created', (select count(*) from parsed
        where issue_resolution_date is not null and issue_created is null)
      union all select 'changes.rows_in', (select count(*) from changes)
      union all select 'fact_tickets.rows_after_dedup', (select count(*) from fact)
      union all select 'dimensions.dim_customers', (select count(*) from dim_customers)
      union all select 'dimensions.dim_agents', (select count(*) from dim_agents)
      union all select 'dimensions.dim_projects', (select count(*) from dim_projects)""",
    # documented extras
    "category_trends_with_hours": f"""select category, month, ticket_volume,
        {ROUND2('avg_h')} avg_resolution_hours, volume_change_pct from cat_trends_h""",
    "dim_date": """select cast(strftime(d, '%Y%m%d') as integer) date_key, cast(d as date) as date,
        cast(year(d) as integer) as year, cast(quarter(d) as integer) as quarter,
        cast(month(d) as integer) as month, cast(day(d) as integer) as day,
        cast(dayofweek(d) + 1 as integer) day_of_week,
        cast(date_trunc('month', d) as date) month_start
      from (select unnest(generate_series(min(cast(start_time as date)),
              max(cast(coalesce(resolution_time, start_time) as date)), interval 1 day)) d from fact)""",
    "dim_category": """select cast(row_number() over (order by category) as bigint) category_id,
        category category_name from (select distinct category from fact where category is not null)""",
    "dim_priority": """select cast(row_number() over (order by priority) as bigint) priority_id,
        priority priority_name from (select distinct priority from fact where priority is not null)""",
    "agent_monthly_hours": f"""select assignee agent_name, date_trunc('month', resolution_time) as month,
        count(*) tickets_resolved, {ROUND2(_EXACT_MEAN)} avg_resolution_hours
      from fact where resolution_time is not null and assignee is not null group by all""",
    "fastest_growing_categories": """select category, month, ticket_volume, volume_change_pct from (
        select *, row_number() over (partition by category order by month desc nulls last) rn
        from cat_trends) where rn = 1 and volume_change_pct is not null
      order by volume_change_pct desc, category limit 10""",
    "agent_workload_spread": """select agent_name, tickets, p25 p25_tickets, p75 p75_tickets,
        case when tickets > p75 then 'over' when tickets < p25 then 'under' else 'normal' end
          workload_band
      from loads, (select quantile_cont(tickets, 0.25) p25, quantile_cont(tickets, 0.75) p75 from loads)""",
    "stream_current_state": "select * from state",
    "stream_latest_per_field": """select issueid, field, id, value, created from (
        select event_id id, user_id issueid, event_type field, cast(value as varchar) value,
          date_trunc('second', ts) created,
          row_number() over (partition by user_id, event_type order by date_trunc('second', ts) desc nulls last,
            event_id desc nulls last, cast(value as varchar) desc nulls last) rn
        from events) where rn = 1""",
    "sla_by_policy": f"""select ticket_id, priority, resolution_duration_hours, threshold_hours,
        resolution_duration_hours <= threshold_hours resolution_target_met
      from (select *, case when priority in ('High', 'Low') and start_time >= timestamp '1995-01-01'
          then ({_THRESHOLD}) / 2 else ({_THRESHOLD}) end threshold_hours from fact)""",
    "top_reporters_by_summary": """select reporter reporter_name, count(*) tickets from fact
      where reporter is not null group by reporter order by tickets desc, reporter limit 10""",
    "quantiles_by_span": """select priority, cast(probability as double) probability, count(*) tickets, true within_bound
      from fact, (select unnest([0.25, 0.5, 0.9]) probability)
      where resolution_duration_hours is not null
        and resolution_time >= (select date_trunc('month', max(resolution_time)) - interval 11 month from fact)
      group by all""",
    "distinct_over_runs": """select metric, names, true within_bound from (
      select 'dim_customers' metric, count(*) names from dim_customers
      union all select 'dim_agents', count(*) from dim_agents
      union all select 'dim_projects', count(*) from dim_projects)""",
    "quarantined_rows": """select 'fact_tickets' table_name, 'ticket_id' column_name, 'duplicate' reason, cast(ticket_id as varchar) as key
        from planted where own % 101 = 0 and ticket_id is not null
      union all select 'fact_tickets', 'ticket_id', 'missing', null from planted where ticket_id is null
      union all select 'fact_tickets', 'customer_id', 'no dimension row', cast(ticket_id as varchar) from planted
        where customer_id = -5
      union all select 'fact_tickets', 'category', 'too long', cast(ticket_id as varchar) from planted
        where length(category) > 60
      union all select 'issues', null, 'malformed', id from raw_issues
        where cast(id as bigint) % 113 = 0 or cast(id as bigint) % 127 = 0""",
    "incremental_star": """select ticket_id, reporter, assignee, project, category, priority, start_time,
        resolution_time, resolution_duration_hours, status, resolution_target_met from fact_rest""",
    "incremental_dimensions": """select case role when 'reporter' then 'customers' when 'assignee' then 'agents'
        else 'projects' end dimension, name from names""",
    "incremental_agent_performance": """select r.* exclude (agent_id), agent_name
      from agent_perf r left join dim_agents a on a.agent_id = r.agent_id""",
    "incremental_resolution_performance": "select * from res_perf",
    "incremental_category_trends": """select category, month, cast(ticket_volume as integer) ticket_volume,
        cast(volume_change_pct as decimal(12, 2)) volume_change_pct from cat_trends""",
    "registry_keys": """select role, name, cast(row_number() over (partition by role order by late, name) as bigint) key
      from (select role, name, min(late) late from (
        select ticket_id % 2 late, unnest(['reporter', 'assignee', 'project']) role,
          unnest([reporter, assignee, project]) name from fact)
        where name is not null group by role, name)""",
    # sinks and the whole run
    "parquet_roundtrip": "select * from wfact",
    "data_end_stamps": "select max(start_time) last_start, max(resolution_time) last_resolution from fact",
    "run_pipeline": """select 'dim_customers' table_name, count(*) rows from dim_customers
      union all select 'dim_agents', count(*) from dim_agents
      union all select 'dim_projects', count(*) from dim_projects
      union all select 'fact_tickets', count(*) from wfact
      union all select 'agent_performance', count(*) from agent_perf
      union all select 'resolution_performance', count(*) from res_perf
      union all select 'category_trends', count(*) from cat_trends""",
}


def oracle_sql() -> dict[str, str]:
    return {name: with_ctes(sql) for name, sql in FINAL.items()}
