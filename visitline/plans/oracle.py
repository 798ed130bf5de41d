"""Independent SQL (DuckDB dialect) for every registered query.

Written from the rules, not from the Spark code: group statistics are
window aggregates, the inconsistent-visit rule is the literal many-to-many
self join, shared forms are a fold of ``list_intersect``. Runs on the
driver's pre-registered views of the parquet tables.
"""

from __future__ import annotations

from collections.abc import Sequence

# Forms without a visit scheme, per study, listed here once more so that a wrong list can't agree with itself.
CRCSCA_EXCLUDE = (
    "age_at_onset conclusionofstudyparticipation dsn_names7301 registration general_physical_exam covid_19_visit_impact_form deathrecord "
    "eligibility genetic_results physician_global_impression patient_global_impression concomitant_meds demographics "
    "demographics_supplement medical_history neurological_exam change_of_status"
).split()
EFACTS_EXCLUDE = ["SARA"]
FACHILD_EXCLUDE = "concl conmed currcond icflog random famed facmstat invsig visstat".split()
FACOMS_EXCLUDE = "concl conmed currcond icflog random famed facmstat famp screen pregoutc sig visstat mhcnsnsus".split()
UNIFAI_EXCLUDE = "TimeZone AE MH SCO mfar".split()

# The study's names for the first forms of the tables.
FORM_NAMES = {
    "CRCSCA": ("crf1", "_9hpt", "visit_codes", "demographics"),
    "EFACTS": ("sara", "_9hpt", "visit_codes", "SARA"),
    "FACHILD": ("faneuro", "_9hpt", "visit_codes", "conmed"),
    "FACOMS": ("faneuro", "_9hpt", "visit_codes", "screen"),
    "UNIFAI": ("mfar", "_9hpt", "visit_codes", "AE"),
}

OBS = """
v as (
  select o_orderkey, o_custkey, cast(o_orderdate as date) as od, o_orderpriority,
         row_number() over (partition by o_custkey order by o_orderdate, o_orderkey) - 1 as vn
  from orders),
obs as (
  select r_name as study, o_custkey as sjid,
    case when o_orderpriority = '5-LOW' and vn % 3 = 2 then 'PRN'
         when o_orderkey % 11 = 0 then 'Unscheduled'
         when vn = 0 then 'Baseline'
         else concat('Visit ', cast(vn as varchar)) end as avisit,
    case when o_orderkey % 11 = 0 then cast(-1 as double) else cast(vn as double) end as avisitn,
    concat('crf', cast(l_linenumber as varchar)) as crf,
    case when l_partkey % 397 = 0 then null
         when l_suppkey % 10 = 0 then od + cast(l_partkey % 200 as int)
         when l_suppkey % 3 = 0 then od + cast(l_partkey % 30 as int)
         else od + cast(o_orderkey % 7 as int) end as adt,
    l_returnflag as hpf,
    l_quantity as qty, l_linestatus as status, l_partkey as partkey
  from lineitem
  join v on l_orderkey = o_orderkey
  join customer on o_custkey = c_custkey
  join nation on c_nationkey = n_nationkey
  join region on n_regionkey = r_regionkey)"""

SUBJ = """
subj as (
  select r_name as study, c_custkey as sjid,
    case when c_custkey % 4 = 0 then null else cast(20 + c_custkey % 50 as double) end as start_age,
    case when c_custkey % 8 = 0 then null else cast(21 + c_custkey % 50 as double) end as registration_age,
    case when c_custkey % 40 = 0 then null else cast(22 + c_custkey % 50 as double) end as ageatregistration,
    concat(cast(1 + c_custkey % 12 as varchar), '/', cast(1 + c_custkey % 28 as varchar), '/2020') as dm_date
  from customer join nation on c_nationkey = n_nationkey join region on n_regionkey = r_regionkey)"""

AGES = """
reg as (select study, sjid, start_age, registration_age from subj),
dem as (select distinct sjid, ageatregistration, dm_date from subj),
regdem as (
  select r.study, r.sjid, r.start_age, r.registration_age, d.ageatregistration, d.dm_date,
         cast(try_strptime(d.dm_date, '%m/%d/%Y') as date) as dm_day
  from reg r left join dem d on r.sjid = d.sjid),
first_reg as (
  select * from regdem
  qualify row_number() over (partition by study, sjid
                             order by dm_day nulls last, ageatregistration nulls last,
                                      start_age nulls last, registration_age nulls last) = 1),
ages as (
  select study, sjid,
         coalesce(start_age, registration_age, ageatregistration) as start_age,
         case when start_age is null and registration_age is null
              then cast(try_strptime(dm_date, '%m/%d/%Y') as date) end as dm_age_used
  from first_reg
  where coalesce(start_age, registration_age, ageatregistration) > 1)"""

# Text exports: visit numbers and dates as text, some empty, blank or not readable.
TEXT = """
t as (
  select study, sjid, avisit, crf,
    case when partkey % 53 = 0 then concat(cast(cast(avisitn as int) as varchar), 'a') when partkey % 59 = 0 then ' '
         else cast(cast(avisitn as int) as varchar) end as num,
    case when partkey % 61 = 0 then 'n/a' when adt is null then '' else cast(adt as varchar) end as day
  from obs),
tr as (
  select *, try_cast(num as double) as avisitn, try_cast(nullif(day, '') as date) as adt,
    nullif(concat_ws(', ', case when try_cast(num as double) is null then 'visit number' end,
                           case when day <> '' and try_cast(day as date) is null then 'date' end), '') as reason
  from t where trim(num) <> '')"""

# A study's text files: some visit numbers can't be read.
EFACTS_FILES = """
ef as (
  select study, sjid, avisit, case when qty % 7 <> 0 then avisitn end as avisitn, qty % 7 <> 0 and qty % 11 = 0 as bad, adt,
         case crf {names} else crf end as crf
  from obs)"""

# Flag pipeline: every stacked row with a visit number.
FLAG = """
fobs as (select study, sjid, avisit, avisitn, crf, adt, hpf from obs where avisitn is not null),
fs as (
  select study, sjid, avisit, avisitn, adt, count(*) as n,
         string_agg(crf, ', ' order by crf) as crf, min(crf) as first_crf
  from fobs group by study, sjid, avisit, avisitn, adt),
spans as (
  select study, sjid, avisit, avisitn,
         case when count(adt) = count(*) then cast(max(adt) - min(adt) as bigint) end as diff
  from fs group by study, sjid, avisit, avisitn having count(*) > 1),
flags as (
  select fs.study, fs.sjid, fs.avisit, fs.avisitn, fs.adt, spans.diff, true as flagged,
         fs.n, fs.crf, fs.first_crf
  from fs join spans
    on fs.study = spans.study and fs.sjid = spans.sjid
   and fs.avisit is not distinct from spans.avisit
   and fs.avisitn is not distinct from spans.avisitn),
n_first as (
  select * from flags
  qualify row_number() over (partition by study, sjid, avisitn, diff, n
                             order by first_crf, adt nulls last) = 1),
n_text as (
  select study, sjid, avisitn, diff, true as flagged,
         string_agg(cast(n as varchar), ', '
                    order by first_crf, adt nulls last, cast(n as varchar)) as n
  from n_first group by study, sjid, avisitn, diff),
vdf as (
  select o.study, o.sjid, o.avisit, o.avisitn, o.adt, t.n, t.diff, o.crf, t.flagged
  from fobs o left join n_text t
    on o.study = t.study and o.sjid = t.sjid and o.avisitn is not distinct from t.avisitn)"""

# Repair pipeline: as-needed visits dropped, subjects with an age only.
REPAIR = """
r0 as (
  select study, sjid, avisit, avisitn, crf, adt from obs where avisit <> 'PRN'
  qualify row_number() over (partition by study, sjid, crf, hpf, qty, status
                             order by adt nulls last, avisitn nulls last, avisit nulls last) = 1),
r1 as (select * from r0 where exists (select 1 from ages a where a.study = r0.study and a.sjid = r0.sjid)),
c8 as (select study, sjid, avisitn, min(adt) as adt, crf from r1 group by study, sjid, avisitn, crf),
c9 as (select *, count(distinct crf) over (partition by study, sjid, avisitn, adt) as n_crf_date from c8),
c10 as (
  select distinct a.study, a.sjid, a.avisitn as avisitn_tbc, a.adt, a.crf as crf_tbc,
         a.n_crf_date as n_crf_date_tbc, b.avisitn, b.n_crf_date
  from c9 a join c9 b
    on a.study = b.study and a.sjid = b.sjid and a.adt is not distinct from b.adt
  where a.avisitn <> b.avisitn and a.crf <> b.crf),
c11a as (select * from c10 qualify n_crf_date = max(n_crf_date) over (partition by sjid, adt)),
c11 as (
  select study, sjid, avisitn_tbc as avisitn, avisitn as avisitn_new, crf_tbc as crf from c11a
  qualify n_crf_date_tbc = min(n_crf_date_tbc) over (partition by sjid, avisitn)),
c12 as (
  select c9.study, c9.sjid, coalesce(k.avisitn_new, c9.avisitn) as avisitn, c9.adt, c9.crf,
         c9.n_crf_date, case when k.avisitn_new is not null then c9.avisitn end as avisitn_original
  from c9 left join c11 k
    on c9.study = k.study and c9.sjid = k.sjid
   and c9.avisitn is not distinct from k.avisitn and c9.crf = k.crf),
c13 as (select * from c12 qualify count(*) over (partition by study, sjid, avisitn, adt, crf) = 1),
c14a as (
  select *,
    case when count(adt) over w = count(*) over w
         then cast(max(adt) over w - min(adt) over w as double) end as span0,
    case when count(adt) over w = count(*) over w
         then median(cast(adt - date '1970-01-01' as double)) over w end as med
  from c13 window w as (partition by study, sjid, avisitn)),
c14b as (
  select study, sjid, avisitn, avisitn_original, crf, adt as adt_before_median,
    case when span0 <= 31 then med
         when span0 > 31 then cast(adt - date '1970-01-01' as double) end as adt_day
  from c14a),
c14 as (
  select study, sjid, avisitn, avisitn_original, crf, adt_before_median, adt_day,
    cast(date '1970-01-01' + cast(floor(adt_day) as integer) as date) as adt,
    count(distinct crf) over (partition by study, sjid, avisitn, adt_day) as n_crf_date,
    case when count(adt_day) over w = count(*) over w
         then cast(max(adt_day) over w - min(adt_day) over w as bigint) end as diff
  from c14b window w as (partition by study, sjid, avisitn)),
c16 as (
  select distinct study, sjid, avisitn, adt_day, crf, conflict_type from (
    select *, 'same adt, multiple avisitn' as conflict_type from c14
    window d as (partition by study, sjid, adt_day)
    qualify count(distinct avisitn) over d
          + case when count(avisitn) over d < count(*) over d then 1 else 0 end > 1
    union all
    select *, 'same avisitn, multiple adt' as conflict_type from c14
    window v as (partition by study, sjid, avisitn)
    qualify count(distinct adt_day) over v
          + case when count(adt_day) over v < count(*) over v then 1 else 0 end > 1)),
c17 as (
  select study, sjid, avisitn, adt_day, conflict_type, count(distinct crf) as n_crf,
         list_sort(list_distinct(list(crf))) as distinct_crfs
  from c16 group by study, sjid, avisitn, adt_day, conflict_type),
c17k as (
  select *,
    cast(date '1970-01-01' + cast(floor(adt_day) as integer) as date) as adt,
    case when conflict_type = 'same adt, multiple avisitn'
         then strftime(cast(date '1970-01-01' + cast(floor(adt_day) as integer) as date), '%Y-%m-%d')
         when avisitn = floor(avisitn) then cast(cast(avisitn as bigint) as varchar)
         else cast(avisitn as varchar) end as group_key
  from c17),
c19 as (
  select study, sjid, conflict_type, group_key, avisitn, adt_day, adt, n_crf,
         array_to_string(distinct_crfs, ', ') as distinct_crfs
  from c17k
  qualify row_number() over (partition by study, sjid, conflict_type, group_key
                             order by n_crf desc, avisitn nulls last, adt_day nulls last) = 1),
c20 as (
  select study, sjid, adt_day, avisitn, cast(null as varchar) as crf from c19
  union all
  select u.study, u.sjid, u.adt_day, u.avisitn, u.crf
  from (select distinct study, sjid, adt_day, avisitn, crf from c14) u
  where not exists (
    select 1 from c17 s
    where s.study = u.study and s.sjid = u.sjid
      and s.adt_day is not distinct from u.adt_day and s.avisitn is not distinct from u.avisitn))"""


def form_names(study: str) -> str:
    return " ".join(f"when 'crf{i}' then '{name}'" for i, name in enumerate(FORM_NAMES[study], 1))


def study_stack(study: str, base: str | None, base_out: str | None, excluded: Sequence[str]) -> str:
    """A study's stacked rows, from the rules of the study rather than its settings."""
    names = form_names(study)
    out = ", ".join(f"'{x}'" for x in excluded)
    keep = f"crf not in ({out})"
    if study in ("EFACTS", "UNIFAI"):
        keep += " and not contains(crf, '_codes')"
    if study == "CRCSCA":
        keep += " and avisit <> 'PRN'"
    else:
        keep += " and avisitn is not null"
    if base:
        keep = f"crf = '{base}' or ({keep})"
    rename = "case crf when '_9hpt' then 'nhpt' else crf end" if study in ("CRCSCA", "FACHILD", "FACOMS") else "crf"
    if base_out:
        rename = f"case crf when '{base}' then '{base_out}' else {rename} end"
    first = """ qualify row_number() over (partition by study, sjid, crf, hpf, qty, status
                order by adt nulls last, avisitn nulls last, avisit nulls last) = 1"""
    rows = f"""
      named as (
        select study, sjid, avisit, case when qty % 7 <> 0 then avisitn end as avisitn,
               case crf {names} else crf end as crf, adt, hpf, qty, status from obs),
      kept as (select * from named {"where avisit <> 'PRN'" + first if study == "CRCSCA" else ""}),
      stacked as (select '{study}' as study, sjid, avisit, avisitn, {rename} as crf, adt from kept where {keep})"""
    body = "select * from stacked"
    if study == "UNIFAI":
        body = f"""select * from stacked where crf = '{base_out}'
                   union all (select distinct * from stacked where crf <> '{base_out}')"""
    return _with(OBS, rows, body=body)


def _with(*blocks: str, body: str) -> str:
    return "with" + ",".join(blocks) + "\n" + body


def queries(obs: str = OBS, subj: str = SUBJ) -> dict[str, str]:
    """Oracle SQL per query key; ``obs`` / ``subj`` may name other source CTEs (tests)."""
    OBS, SUBJ = obs, subj  # noqa: N806
    flag = lambda body: _with(OBS, FLAG, body=body)
    rep = lambda body: _with(OBS, SUBJ, AGES, REPAIR, body=body)
    hist = """
      select bin, case bin {labels} end as six_months, count(*) as n
      from (select case {bins} end as bin from spans) group by bin"""

    def histogram(breaks, labels):
        bins = " ".join(
            f"when diff > {lo} and diff <= {hi} then {i}"
            for i, (lo, hi) in enumerate(zip(breaks[:-1], breaks[1:]), start=1)
        )
        names = " ".join(f"when {i} then '{lab}'" for i, lab in enumerate(labels, start=1))
        return flag(hist.format(labels=names, bins=bins))

    crcsca_exclude = ", ".join(f"'{name}'" for name in CRCSCA_EXCLUDE)
    pivot_cols = ", ".join(f"min(case when crf = 'crf{i}' then adt end) as crf{i}" for i in range(1, 8))

    return {
        # forms and I/O
        "stack_forms": _with(OBS, body=f"""
            select study, sjid, avisit, avisitn, crf, adt from obs
            where avisit <> 'PRN' and crf not in ({crcsca_exclude})"""),
        "stack_forms_crcsca": study_stack("CRCSCA", None, None, CRCSCA_EXCLUDE),
        "stack_forms_efacts": study_stack("EFACTS", "sara", None, EFACTS_EXCLUDE),
        "stack_forms_fachild": study_stack("FACHILD", "faneuro", None, FACHILD_EXCLUDE),
        "stack_forms_facoms": study_stack("FACOMS", "faneuro", None, FACOMS_EXCLUDE),
        "stack_forms_unifai": study_stack("UNIFAI", "mfar", "fars", UNIFAI_EXCLUDE),
        "form_catalogue": _with(OBS, body=f"""
            select distinct crf from obs
            where crf not in ({crcsca_exclude})"""),
        "form_manifest": _with(OBS, EFACTS_FILES.format(names=form_names("EFACTS").replace("_9hpt", "nhpt")), body="""
            select crf, 'csv' as format, n as rows, columns, crf = 'sara' as base, reason is null as used, reason from (
              select crf, count(*) as n, 'SJID:string, AVISIT:string, AVISITN:string, ADT:string, HPF:string, QTY:string, STATUS:string' as columns,
                     case when crf = 'SARA' then 'excluded' when contains(crf, '_codes') then 'code list' end as reason
              from ef group by crf
              union all
              select 'sites', count(*), 'N_NAME:string', 'no visit keys' from nation
              union all
              select 'blank', 0, 'SJID:string, AVISIT:string, AVISITN:string, ADT:string, HPF:string, QTY:string, STATUS:string', 'empty')"""),
        "load_study_efacts": _with(OBS, EFACTS_FILES.format(names=form_names("EFACTS").replace("_9hpt", "nhpt")), body="""
            select 'EFACTS' as study, sjid, avisit, avisitn, crf, adt from ef
            where not bad and (crf = 'sara' or (crf <> 'SARA' and not contains(crf, '_codes') and avisitn is not null))"""),
        "load_study_facoms": study_stack("FACOMS", "faneuro", None, FACOMS_EXCLUDE),
        "stack_text_forms": _with(OBS, TEXT, body="select study, sjid, avisit, avisitn, crf, adt from tr where reason is null"),
        "rejected_rows": _with(OBS, TEXT, body="""
            select study, crf, sjid, avisit, num as avisitn, nullif(day, '') as adt, reason from tr where reason is not null"""),
        "duplicate_key_rows": _with(OBS, body="""
            select study, sjid, avisit, avisitn, crf, adt, count(*) as n_rows from obs
            group by all having count(*) > 1"""),
        "normalise_columns": "select * from lineitem",
        "dedupe_form_rows": _with(OBS, body="""
            select study, sjid, avisit, avisitn, crf, adt, hpf, qty, status from obs
            qualify row_number() over (partition by study, sjid, crf, hpf, qty, status
                                       order by adt nulls last, avisitn nulls last, avisit nulls last) = 1"""),
        "dedupe_form_keys": _with(OBS, body="""
            select distinct study, sjid, avisit, avisitn, crf, adt from obs"""),
        "pivot_form": _with(OBS, FLAG, body=f"""
            select study, sjid, avisit, avisitn, {pivot_cols}
            from fobs group by study, sjid, avisit, avisitn"""),
        # ages
        "baseline_age": _with(SUBJ, AGES, body="select study, sjid, start_age, dm_age_used from ages"),
        "age_at_visit": _with(OBS, SUBJ, AGES, REPAIR, body="""
            select r0.study, r0.sjid, r0.avisit, r0.avisitn, r0.crf, r0.adt, a.start_age as age_bl,
                   (cast(r0.adt - date '1970-01-01' as double)
                    - case when count(r0.adt) over s = count(*) over s
                           then min(cast(r0.adt - date '1970-01-01' as double)) over s end) / 365.25 as time,
                   a.start_age + (cast(r0.adt - date '1970-01-01' as double)
                    - case when count(r0.adt) over s = count(*) over s
                           then min(cast(r0.adt - date '1970-01-01' as double)) over s end) / 365.25 as age
            from r0 join ages a on r0.study = a.study and r0.sjid = a.sjid
            where a.start_age is not null
            window s as (partition by r0.study, r0.sjid)"""),
        # repair
        "one_date_per_form_visit": rep("select * from c8"),
        "forms_per_date": rep("select * from c9"),
        "inconsistent_visits": rep("select * from c10"),
        "visit_corrections": rep("select * from c11"),
        "apply_corrections": rep("select * from c12"),
        "drop_collided_forms": rep("select * from c13"),
        "distinct_dates": rep("select count(*) as n_dates from (select distinct adt from c13)"),
        "snap_to_median": rep("select * from c14"),
        # conflicts
        "conflict_rows": rep("""
            select *, cast(date '1970-01-01' + cast(floor(adt_day) as integer) as date) as adt from c16"""),
        "conflict_summary": rep("""
            select study, sjid, avisitn, adt_day, conflict_type, n_crf,
                   array_to_string(distinct_crfs, ', ') as distinct_crfs, adt from c17k"""),
        "conflict_shared_forms": rep("""
            select study, sjid, avisitn, adt_day, adt, conflict_type, n_crf,
                   array_to_string(distinct_crfs, ', ') as distinct_crfs, group_key,
                   array_to_string(shared, ', ') as shared_crfs, cast(len(shared) as bigint) as n_shared_crfs
            from (
              select *, count(*) over g as n_entries,
                     list_sort(list_reduce(list(distinct_crfs) over g,
                                           lambda a, b: list_intersect(a, b))) as shared
              from c17k window g as (partition by sjid, conflict_type, group_key))
            where n_entries > 1"""),
        "conflict_review": rep("""
            select * from (
              select study, sjid, avisitn, adt_day, adt, conflict_type, n_crf,
                     array_to_string(distinct_crfs, ', ') as distinct_crfs, group_key,
                     array_to_string(shared, ', ') as shared_crfs, cast(len(shared) as bigint) as n_shared_crfs
              from (
                select *, count(*) over g as n_entries,
                       list_sort(list_reduce(list(distinct_crfs) over g,
                                             lambda a, b: list_intersect(a, b))) as shared
                from c17k window g as (partition by sjid, conflict_type, group_key))
              where n_entries > 1)
            order by study, sjid, avisitn nulls last, adt_day nulls last, conflict_type"""),
        "resolve_conflicts": rep("select * from c19"),
        "clean_visits": rep("""
            select *, cast(date '1970-01-01' + cast(floor(adt_day) as integer) as date) as adt from c20"""),
        "visit_counts": rep("""
            select count(*) as total_rows,
              (select count(*) from (select distinct study, sjid from c20)) as unique_subjects,
              (select count(*) from (select distinct study, sjid, avisitn from c20)) as unique_visits,
              (select count(*) from (select distinct study, sjid, adt_day from c20)) as unique_dates,
              (select count(*) from (select distinct study, sjid, avisitn, adt_day, crf from c20)) as unique_crf_records
            from c20"""),
        "visit_dates_with_age": rep("""
            select v.study, v.sjid, v.adt_day,
                   cast(date '1970-01-01' + cast(floor(v.adt_day) as integer) as date) as adt,
                   v.avisitn, a.start_age as age_bl,
                   (v.adt_day - case when count(v.adt_day) over s = count(*) over s
                                     then min(v.adt_day) over s end) / 365.25 as time,
                   a.start_age + (v.adt_day - case when count(v.adt_day) over s = count(*) over s
                                     then min(v.adt_day) over s end) / 365.25 as age
            from (select distinct study, sjid, adt_day, avisitn from c20) v
            left join ages a on v.study = a.study and v.sjid = a.sjid
            window s as (partition by v.study, v.sjid)"""),
        # flags
        "form_summary": flag("select study, sjid, avisit, avisitn, adt, n, crf from fs"),
        "form_runs": flag("""
            select study, sjid, avisit, avisitn, adt, cast(sum(count(*)) over (partition by study, sjid, avisit, avisitn, adt) as bigint) as n,
                   crf, count(*) as rows
            from fobs group by study, sjid, avisit, avisitn, adt, crf"""),
        "multi_date_visits": flag("select study, sjid, avisit, avisitn, adt, diff, flagged, n, crf from flags"),
        "span_histogram": histogram(
            (0, 31, 90, 180, 1000, 2000, 3000, 1e18),
            ("(0,31]", "(31,90]", "(90,180]", "(180,1e+03]", "(1e+03,2e+03]", "(2e+03,3e+03]", "(3e+03,1e+18]"),
        ),
        "span_histogram_short": histogram(
            (0, 31, 90, 180, 3000), ("(0,31]", "(31,90]", "(90,180]", "(180,3e+03]")
        ),
        "visit_dates_flagged": flag("select * from vdf"),
        "sorted_visit_dates": flag("""
            select *, row_number() over (order by study, sjid, avisitn nulls last, adt nulls last, avisit nulls last, n nulls last,
                                         diff nulls last, crf nulls last, flagged nulls last) - 1 as place from vdf"""),
        "residual_multi_date": flag("""
            select * from (select distinct study, sjid, avisit, avisitn, adt, n, diff, flagged
                           from vdf where avisitn <> -1)
            qualify count(*) over (partition by sjid, avisit, avisitn) > 1"""),
        "visit_mode_summary": flag("""
            select study, sjid, avisit,
                   string_agg(coalesce(hpf, 'NA'), ', '
                              order by avisitn nulls last, adt nulls last, crf, coalesce(hpf, 'NA')) as hpf
            from (select * from fobs
                  qualify row_number() over (partition by study, sjid, avisit, hpf
                                             order by avisitn nulls last, adt nulls last, crf) = 1)
            group by study, sjid, avisit"""),
    }
