"""DuckDB SQL that states the expected result of every registered query.

Written against the driver's tables alone: each statement derives the mart inputs again in common
table expressions and repeats no code of the operators.
"""

from __future__ import annotations

CLICKS = [f"fe_{k}" for k in range(1, 21)]
FEATURES = ["tenure", "loan_amt", "customer_age", "Annual_Income", "Monthly_Inhand_Salary",
            "Num_Bank_Accounts", "Num_of_Loan", "Total_EMI_per_month", "Monthly_Balance",
            "debt_to_income_ratio", *CLICKS]
EDGES = ["-0.001", "0.1", "0.2", "0.30000000000000004", "0.4", "0.5", "0.6000000000000001",
         "0.7000000000000001", "0.8", "0.9", "1.001"]


def day(c, name=None):
    return f"strftime({c}, '%Y-%m-%d') as {name or c.split('.')[-1]}"


def r6(expression, name):
    return f"round(cast({expression} as double), 6) + 0.0 as {name}"


def dbl(names, prefix=""):
    return ", ".join(f"cast({prefix}{c} as double) as {c}" for c in names)


# --- common table expressions: name -> (needs, SQL) --------------------------------------------

CTES: dict[str, tuple[tuple[str, ...], str]] = {}

CTES["loans"] = ((), """
  select concat('L', cast(o_orderkey as varchar)) as loan_id, concat('C', cast(o_custkey as varchar)) as Customer_ID,
    d0 as loan_start_date, 10 as tenure, i as installment_num, o_totalprice as loan_amt,
    case when i = 0 then 0.0::double else o_totalprice / 10 end as due_amt,
    case when i > 0 and m = 0 then o_totalprice / 10 else 0.0::double end as paid_amt,
    case when o_orderkey % 53 = 0 and i = 6 then null else m * (o_totalprice / 10) end as overdue_amt,
    o_totalprice * (10 - i + m) / 10 as balance,
    cast(d0 + to_months(i) as date) as snapshot_date
  from (select o.*, t.i, cast(date_trunc('month', o_orderdate) as date) as d0,
          case when t.i > 0 and (o_orderkey * 7 + o_custkey) % 5 = 0
               then least(t.i, cast(1 + o_orderkey % 4 as int)) else 0 end as m
        from orders o cross join (select cast(unnest(range(11)) as int) as i) t) x""")

CTES["dated"] = ((), """
  select c.*, a.d from customer c
  join (select o_custkey, min(cast(date_trunc('month', o_orderdate) as date)) as d from orders group by o_custkey) a
    on c.c_custkey = a.o_custkey""")

CTES["people"] = (("dated",), """
  select concat('C', cast(c_custkey as varchar)) as Customer_ID, c_name as Name,
    case when c_custkey % 39 = 0 then '-500' when c_custkey % 41 = 0 then '8678_'
         when c_custkey % 20 = 0 then concat(cast(15 + c_custkey % 55 as varchar), '_')
         else cast(15 + c_custkey % 55 as varchar) end as Age,
    case when c_custkey % 18 = 0 then '#F%$D@*&8'
         else concat('900-00-', cast(1000 + c_custkey % 9000 as varchar)) end as SSN,
    case c_custkey % 8 when 0 then 'Engineer' when 1 then 'Doctor' when 2 then 'Manager' when 3 then 'Teacher'
         when 4 then '_______' when 5 then 'Media_Manager' when 6 then 'Lawyer' else 'Scientist' end as Occupation,
    d as snapshot_date
  from dated""")

CTES["money"] = (("dated",), """
  select concat('C', cast(c_custkey as varchar)) as Customer_ID,
    concat(cast(cast(floor(c_acctbal * 15) as int) as varchar), case when c_custkey % 17 = 0 then '_' else '' end) as Annual_Income,
    case when c_custkey % 23 = 0 then null else cast(cast(floor(c_acctbal) as int) as varchar) end as Monthly_Inhand_Salary,
    cast(c_custkey % 11 as varchar) as Num_Bank_Accounts,
    case when c_custkey % 19 = 0 then '_' when c_custkey % 13 = 0 then concat(cast(c_custkey % 9 as varchar), '.0')
         else concat(cast(c_custkey % 9 as varchar), '_') end as Num_of_Loan,
    case when c_custkey % 29 = 0 then '__-333333333333333333333333333__'
         else cast(cast(floor(c_acctbal) as int) as varchar) end as Monthly_Balance,
    cast(c_custkey % 400 as varchar) as Total_EMI_per_month, d as snapshot_date
  from dated""")

CTES["clicks"] = (("dated",), f"""
  select concat('C', cast(user_id as varchar)) as Customer_ID, d as snapshot_date,
    {", ".join(f"avg(case when event_id % 20 = {k - 1} then value end)::float as fe_{k}" for k in range(1, 21))}
  from events join dated on user_id = c_custkey group by user_id, d""")

CTES["s_loans"] = (("loans",), """
  select *, case when installments_missed > 0 then cast(snapshot_date - to_months(installments_missed) as date) end as first_missed_date
  from (select loan_id, Customer_ID, loan_start_date, tenure, installment_num,
          coalesce(loan_amt, 0)::float as loan_amt, coalesce(due_amt, 0)::float as due_amt,
          coalesce(paid_amt, 0)::float as paid_amt, coalesce(overdue_amt, 0)::float as overdue_amt,
          coalesce(balance, 0)::float as balance, snapshot_date, installment_num as mob,
          coalesce(cast(ceil(overdue_amt::float::double / nullif(due_amt::float::double, 0)) as int), 0) as installments_missed
        from loans) t""")

CTES["s_loans_dpd"] = (("s_loans",), """
  select *, cast(case when overdue_amt > 0 then datediff('day', first_missed_date, snapshot_date) else 0 end as int) as dpd
  from s_loans""")

CTES["s_people"] = (("people",), """
  select Customer_ID, Name, Age, SSN, Occupation, snapshot_date,
    case when Age < 25 then '18-24' when Age < 35 then '25-34' when Age < 45 then '35-44' when Age < 55 then '45-54'
         when Age < 65 then '55-64' else '65+' end as age_group,
    case when Occupation in ('Engineer', 'Developer', 'Scientist', 'Architect') then 'Technical'
         when Occupation in ('Doctor', 'Lawyer', 'Accountant') then 'Professional'
         when Occupation in ('Manager', 'Director', 'Executive') then 'Management'
         when Occupation in ('Teacher', 'Professor') then 'Education' else 'Other' end as occupation_category
  from (select * replace (case when n between 0 and 150 then n end as Age)
        from (select *, try_cast(replace(Age, '_', '') as int) as n from people) a) b""")

CTES["s_money"] = (("money",), """
  select Customer_ID, Annual_Income, Monthly_Inhand_Salary, Num_Bank_Accounts, Num_of_Loan, Monthly_Balance,
    Total_EMI_per_month, snapshot_date,
    cast(case when Monthly_Inhand_Salary > 0
         then Total_EMI_per_month::double / Monthly_Inhand_Salary::double * 100 else 0 end as float) as debt_to_income_ratio,
    case when Annual_Income < 30000 then 'Low' when Annual_Income < 70000 then 'Medium'
         when Annual_Income < 120000 then 'High' else 'Very High' end as income_category
  from (select Customer_ID, snapshot_date, try_cast(replace(Annual_Income, '_', '') as float) as Annual_Income,
          try_cast(Monthly_Inhand_Salary as float) as Monthly_Inhand_Salary,
          try_cast(Num_Bank_Accounts as int) as Num_Bank_Accounts,
          cast(trunc(try_cast(replace(Num_of_Loan, '_', '') as double)) as int) as Num_of_Loan,
          case when try_cast(replace(Monthly_Balance, '_', '') as float) between -1000000 and 1e15
               then try_cast(replace(Monthly_Balance, '_', '') as float) end as Monthly_Balance,
          try_cast(Total_EMI_per_month as float) as Total_EMI_per_month
        from money) m""")

CTES["features"] = (("s_loans", "s_people", "s_money", "clicks"), f"""
  select l.Customer_ID, l.snapshot_date, l.loan_id, l.loan_start_date, l.tenure, l.loan_amt,
    p.Age as customer_age, p.Occupation as customer_occupation, p.age_group, p.occupation_category,
    f.Annual_Income, f.Monthly_Inhand_Salary, f.Num_Bank_Accounts, f.Num_of_Loan, f.Total_EMI_per_month,
    f.Monthly_Balance, f.debt_to_income_ratio, f.income_category, {", ".join("k." + c for c in CLICKS)}
  from (select * from s_loans where mob = 0) l
  left join s_people p on l.Customer_ID = p.Customer_ID and l.snapshot_date = p.snapshot_date
  left join s_money f on l.Customer_ID = f.Customer_ID and l.snapshot_date = f.snapshot_date
  left join clicks k on l.Customer_ID = k.Customer_ID and l.snapshot_date = k.snapshot_date""")

CTES["label_rows"] = (("s_loans_dpd",), """
  select loan_id, Customer_ID, case when dpd >= 30 then 1 else 0 end as label, '30dpd_6mob' as label_def, snapshot_date
  from s_loans_dpd where mob = 6""")

CTES["splits"] = ((), """
  select * from (values ('train', date '1995-01-01', date '1998-12-01'), ('validation', date '1999-01-01', date '1999-12-01'),
    ('test', date '2000-01-01', date '2000-12-01'), ('oot', date '2001-01-01', date '2001-08-01')) t(split, a, b)""")


def _training(offset, how, aligned=False):
    match = f" and l.snapshot_date = cast(f.snapshot_date + to_months({offset}) as date)" if aligned else ""
    return (("features", "label_rows", "splits"), f"""
  select f.*, l.label from (select f.*, s.split from features f join splits s on f.snapshot_date between s.a and s.b) f
  {how} join (select l.*, s.split from label_rows l join splits s
    on l.snapshot_date between cast(s.a + to_months({offset}) as date) and cast(s.b + to_months({offset}) as date)) l
  on f.loan_id = l.loan_id and f.split = l.split{match}""")


CTES["training"] = _training(6, "inner")
CTES["training_aligned"] = _training(6, "inner", aligned=True)
CTES["training_early"] = _training(4, "left")


def _filled(source, key):
    medians = ", ".join(f"median(cast({c} as double)) as {c}" for c in FEATURES)
    return f"""select t.* replace ({", ".join(f"coalesce(cast(t.{c} as double), m.{c}) as {c}" for c in FEATURES)})
  from {source} t join (select {key}, {medians} from {source} group by {key}) m on t.{key} = m.{key}"""


CTES["filled_scoring"] = (("features",), _filled("features", "snapshot_date"))
CTES["filled_training"] = (("training",), _filled("training", "split"))

_LABEL = "case when (event_id * 37 + user_id * 11) % 10 < 3 then 1 else 0 end"
CTES["scores"] = ((), f"""
  select cast(event_id as varchar) as loan_id, cast(user_id as varchar) as Customer_ID,
    value / (value + 50.0::double) as p, {_LABEL} as label, cast(ts as date) as snapshot_date
  from events""")
CTES["preds"] = ((), f"""
  select 'alpha' as model_name, cast(event_id as varchar) as loan_id, cast(user_id as varchar) as Customer_ID,
    case when event_id % 997 = 5 then 'nan'::double when event_id % 991 = 7 then null
         else value / (value + 50.0::double) end as p, cast(ts as date) as snapshot_date from events
  union all
  select 'beta', cast(event_id as varchar), cast(user_id as varchar),
    0.3::double * ({_LABEL}) + 0.7::double * (cast((event_id * 7919) % 1000 as double) / 1000.0::double),
    cast(ts as date) from events""")
CTES["truth"] = ((), f"""
  select cast(event_id as varchar) as loan_id, cast(user_id as varchar) as Customer_ID, {_LABEL} as label,
    cast(cast(ts as date) + to_months(6) as date) as label_date
  from events where event_type <> 'error' and cast(ts as date) <= date '2024-01-25'""")
CTES["joined"] = (("preds", "truth"), """
  select p.model_name, p.snapshot_date, p.loan_id, p.Customer_ID, p.p, t.label
  from preds p join truth t on p.loan_id = t.loan_id and p.Customer_ID = t.Customer_ID
    and t.label_date = cast(p.snapshot_date + to_months(6) as date)""")
CTES["doc_scores"] = ((), """
  select l.doc_id, d.n_chars / (d.n_chars + 2000.0::double) as p, l.quality as label
  from labels l join documents d on l.doc_id = d.doc_id""")

_LOSS = ("-(case when label = 1 then ln(least(greatest(p, 2.220446049250313e-16), 1 - 2.220446049250313e-16)) "
         "else ln(1 - least(greatest(p, 2.220446049250313e-16), 1 - 2.220446049250313e-16)) end)")
_HIT = "coalesce(p >= 0.5 and not isnan(p), false)"  # NaN is above every number here
_BLIND = "count(*) filter (where p is null or isnan(p)) > 0"
_CELLS = {
    "true_negatives": f"label = 0 and not {_HIT}", "false_positives": f"label = 0 and {_HIT}",
    "false_negatives": f"label = 1 and not {_HIT}", "true_positives": f"label = 1 and {_HIT}",
}


def matrix(source, keys):
    cells = ", ".join(f"cast(count(*) filter (where {cond}) as bigint) as {name}" for name, cond in _CELLS.items())
    return f"select {keys + ', ' if keys else ''}{cells} from {source}{' group by ' + keys if keys else ''}"


def rates(source):
    return f"""select *, (true_negatives + true_positives) / n as accuracy,
      case when true_positives + false_positives = 0 then 0 else true_positives / (true_positives + false_positives) end as precision,
      case when true_positives + false_negatives = 0 then 0 else true_positives / (true_positives + false_negatives) end as recall,
      case when 2 * true_positives + false_positives + false_negatives = 0 then 0
           else 2 * true_positives / (2 * true_positives + false_positives + false_negatives) end as f1_score
    from (select *, (true_negatives + false_positives + false_negatives + true_positives)::double as n from {source}) q"""


def loss(source, keys):
    value = f"case when {_BLIND} then null when min(label) <> max(label) then avg({_LOSS}) end as log_loss"
    return f"select {keys + ', ' if keys else ''}{value} from {source}{' group by ' + keys if keys else ''}"


def auc(source, keys):
    """Mean rank of the positives among all rows, ties at their average rank."""
    part = f"partition by {keys}" if keys else ""
    lead = f"{keys}, " if keys else ""
    same = f"partition by {keys}, p" if keys else "partition by p"
    return f"""select {lead}case when not blind and n1 > 0 and n0 > 0 then (rank_sum - n1 * (n1 + 1) / 2) / (n1 * n0) end as auc_roc
    from (select {lead}sum(case when label = 1 then mean_rank end) as rank_sum, {_BLIND} as blind,
            count(*) filter (where label = 1)::double as n1, count(*) filter (where label = 0)::double as n0
          from (select {lead}label, p, rank() over ({part} order by p) + (count(*) over ({same}) - 1) / 2.0::double as mean_rank
                from {source}) ranked {'group by ' + keys if keys else ''}) sums"""


def histogram(source, keys):
    """(keys, bin, c, n): all ten bins of every group."""
    case = " ".join(f"when p >= {lo} and p {'<=' if i == 9 else '<'} {hi} then {i}"
                    for i, (lo, hi) in enumerate(zip(EDGES, EDGES[1:])))
    on = " and ".join(f"g.{k.strip()} = h.{k.strip()}" for k in keys.split(","))
    return f"""select {", ".join("g." + k.strip() for k in keys.split(","))}, b.bin, coalesce(h.c, 0) as c, g.n
    from (select {keys}, count(*) as n from {source} group by {keys}) g
    cross join (select unnest(range(10)) as bin) b
    left join (select {keys}, case {case} end as bin, count(*) as c from {source} group by all) h on {on} and b.bin = h.bin"""


_TERM = ("(a - e) * ln(a / e)")


def psi_sum(now, base, on, keys):
    return f"""select {keys}, sum({_TERM}) as psi from (
      select {keys}, case when n.c = 0 then 0.0001 else n.c / n.n::double end as a,
        case when b.c = 0 then 0.0001 else b.c / b.n::double end as e
      from {now} n join {base} b on n.bin = b.bin and {on}) t group by {keys}"""


CTES["hist_scores"] = (("scores",), histogram("scores", "snapshot_date"))
CTES["hist_preds"] = (("preds",), histogram("preds", "model_name, snapshot_date"))
CTES["hist_joined"] = (("joined",), histogram("joined", "model_name, snapshot_date"))
CTES["hist_base"] = (("hist_preds",), """
  select model_name as base_model, bin, c, n from hist_preds
  where (model_name, snapshot_date) in (select model_name, min(snapshot_date) from hist_preds group by model_name)""")
CTES["label_days"] = (("truth",), "select distinct label_date from truth")
CTES["m_matrix"] = (("joined",), matrix("joined", "model_name, snapshot_date"))
CTES["m_rates"] = (("m_matrix",), rates("m_matrix"))
CTES["m_loss"] = (("joined",), loss("joined", "model_name, snapshot_date"))
CTES["m_auc"] = (("joined",), auc("joined", "model_name, snapshot_date"))
CTES["psi_joined"] = (("hist_joined", "hist_base"),
                      psi_sum("hist_joined", "hist_base", "n.model_name = b.base_model", "model_name, snapshot_date"))
CTES["psi_all"] = (("hist_preds", "hist_base"),
                   psi_sum("hist_preds", "hist_base", "n.model_name = b.base_model", "model_name, snapshot_date"))
CTES["measured"] = (("preds", "label_days", "m_rates", "m_loss", "m_auc", "psi_joined", "psi_all"), """
  select d.model_name, d.snapshot_date, t.label_date is not null as has_labels,
    r.accuracy, r.precision, r.recall, r.f1_score, a.auc_roc, s.log_loss, 0.5::double as threshold,
    coalesce(r.true_negatives, 0) as true_negatives, coalesce(r.false_positives, 0) as false_positives,
    coalesce(r.false_negatives, 0) as false_negatives, coalesce(r.true_positives, 0) as true_positives,
    case when t.label_date is not null then j.psi else u.psi end as psi
  from (select distinct model_name, snapshot_date from preds) d
  left join label_days t on t.label_date = cast(d.snapshot_date + to_months(6) as date)
  left join m_rates r using (model_name, snapshot_date)
  left join m_loss s using (model_name, snapshot_date)
  left join m_auc a using (model_name, snapshot_date)
  left join psi_joined j using (model_name, snapshot_date)
  left join psi_all u using (model_name, snapshot_date)""")


def checked(source, zero_is_ok=False):
    silent = "psi is null" if zero_is_ok else "psi is null or psi = 0"
    return f"""select *, coalesce(auc_roc >= 0.7, false) as auc_roc_check, coalesce(precision >= 0.6, false) as precision_check,
      coalesce(recall >= 0.5, false) as recall_check, coalesce(f1_score >= 0.55, false) as f1_score_check,
      coalesce(psi < 0.1, true) as psi_warning, coalesce(psi < 0.2, true) as psi_critical,
      coalesce(auc_roc >= 0.7 and precision >= 0.6 and recall >= 0.5 and f1_score >= 0.55, false) as all_passed,
      case when {silent} then 'NO_PSI' when psi >= 0.2 then 'CRITICAL' when psi >= 0.1 then 'WARNING' else 'OK' end as alert_level
    from {source}"""


CTES["report"] = (("measured",), checked("measured"))
CTES["history"] = (("report",), """
  select *, strftime(snapshot_date, '%Y-%m-%d') || 'T08:00:00' as monitored_at from report
  union all
  select *, strftime(snapshot_date, '%Y-%m-%d') || 'T20:00:00' from report where day(snapshot_date) % 2 = 0""")
CTES["newest"] = (("history",), """
  select * from (select *, row_number() over (partition by model_name, snapshot_date order by monitored_at desc) as rn
                 from history) h where rn = 1""")
CTES["windows"] = ((), """
  select * from (values ('train', date '2024-01-01', date '2024-01-15'), ('validation', date '2024-01-16', date '2024-01-20'),
    ('test', date '2024-01-21', date '2024-01-25')) t(split, a, b)""")
CTES["joined_windows"] = (("joined", "windows"), """
  select j.*, w.split from joined j join windows w on j.snapshot_date between w.a and w.b""")
CTES["w_matrix"] = (("joined_windows",), matrix("joined_windows", "model_name, split"))
CTES["w_rates"] = (("w_matrix",), rates("w_matrix"))
CTES["w_loss"] = (("joined_windows",), loss("joined_windows", "model_name, split"))
CTES["w_auc"] = (("joined_windows",), auc("joined_windows", "model_name, split"))
CTES["registry"] = (("w_rates", "w_loss", "w_auc"), """
  select case when model_name = 'alpha' then 1 else 2 end as ordinal, model_name, split,
    unnest(['accuracy', 'precision', 'recall', 'f1_score', 'auc_roc', 'log_loss']) as metric,
    unnest([accuracy::double, precision::double, recall::double, f1_score::double, auc_roc::double, log_loss::double]) as value
  from w_rates join w_loss using (model_name, split) join w_auc using (model_name, split)""")


def sql(needs: str, body: str) -> str:
    """The statement with the table expressions it needs, in dependency order."""
    order: list[str] = []

    def add(name):
        for dependency in CTES[name][0]:
            add(dependency)
        if name not in order:
            order.append(name)

    for name in needs.split():
        add(name)
    head = ",\n".join(f"{name} as ({CTES[name][1]})" for name in order)
    return f"with {head}\n{body}" if head else body


ORACLES: dict[str, str] = {}

# --- lake -------------------------------------------------------------------------------------

ORACLES["bronze_snapshot"] = sql("loans", f"""
select loan_id, Customer_ID, strftime(loan_start_date, '%Y-%m-%d') as loan_start_date, cast(installment_num as varchar) as installment_num,
  {day("snapshot_date")}, {", ".join(r6(c, c) for c in ("loan_amt", "due_amt", "paid_amt", "overdue_amt", "balance"))}
from loans where snapshot_date = date '1998-06-01'""")

ORACLES["bronze_roundtrip"] = sql("loans", f"""
select {day("snapshot_date")}, count(*) as row_count, count(distinct loan_id) as loan_count,
  cast(sum(cast(round(balance * 1000) as bigint)) as bigint) as balance_mills, count(overdue_amt) as overdue_present
from loans group by snapshot_date""")

CTES["mixed"] = (("loans",), """
  select *, case when k % 29 = 0 then 'short' when k % 31 = 0 then 'long' when k % 37 = 0 then 'twice' else cast(k % 4 as varchar) end as kind
  from (select *, cast(substr(loan_id, 2) as bigint) as k from loans) x""")
ORACLES["bronze_reordered"] = sql("mixed", f"""
select {day("snapshot_date")}, count(*) as row_count, count(distinct loan_id || '/' || Customer_ID) as loan_count, cast(sum(installment_num) as bigint) as installments,
  count(case when kind <> '2' then balance end) as with_balance,
  cast(sum(case when kind <> '2' then cast(round(balance * 1000) as bigint) end) as bigint) as balance_mills,
  count(case when kind = '3' then 1 end) as rescued, max(case when kind = '3' then concat('branch ', k % 7) end) as last_branch
from mixed where kind in ('0', '1', '2', '3') group by snapshot_date""")
ORACLES["bronze_quarantine"] = sql("mixed", """
select case kind when 'twice' then 'column twice in the header: loan_id' else 'cells do not match the header' end as feed_reason,
  count(*) as n_rows, count(distinct loan_id) as n_loans, cast(sum(case kind when 'short' then 5 when 'long' then 12 else 11 end) as bigint) as n_cells
from mixed where kind in ('short', 'long', 'twice') group by all""")

_AGAIN = "case when year(snapshot_date) = 1997 then dpd + 1000 else dpd end"
ORACLES["overwrite_idempotent"] = sql("s_loans_dpd", f"""
select {day("snapshot_date")}, count(*) as row_count, cast(sum({_AGAIN}) as bigint) as dpd_sum from s_loans_dpd group by snapshot_date""")
ORACLES["rerun_covered_range"] = sql("s_loans_dpd", f"""
select {day("snapshot_date")}, count(*) as row_count, cast(sum({_AGAIN}) as bigint) as dpd_sum from s_loans_dpd
where snapshot_date <> date '1997-03-01' group by snapshot_date""")

ORACLES["snapshot_row_counts"] = sql("loans", f"""
select {day("snapshot_date")}, count(*) as row_count from loans group by snapshot_date""")

ORACLES["union_snapshots"] = sql("s_loans", f"""
select {day("snapshot_date")}, count(*) as row_count, count(*) filter (where mob = 0) as feature_rows,
  count(*) filter (where mob = 6) as label_rows
from s_loans where mob in (0, 6) group by snapshot_date""")

ORACLES["snapshot_tag_roundtrip"] = sql("loans", f"""
select distinct {day("snapshot_date")}, 'predictions_alpha_' || strftime(snapshot_date, '%Y_%m_%d') || '.parquet' as file_name,
  {day("snapshot_date", "parsed_date")} from loans""")

ORACLES["month_calendar_span"] = sql("loans", """
select strftime(m, '%Y-%m-%d') as month
from (select unnest(generate_series(min(snapshot_date), max(snapshot_date), interval 1 month)) as m from loans) t""")

ORACLES["missing_snapshots"] = sql("loans", """
select strftime(m, '%Y-%m-%d') as month
from (select unnest(generate_series(date '1994-09-01', date '2001-12-01', interval 1 month)) as m) t
where cast(m as date) not in (select snapshot_date from loans where installment_num = 0)""")


def _missing(ranges):
    series = " union ".join(f"select unnest(generate_series(date '{a}', date '{b}', interval 1 month)) as m" for a, b in ranges)
    return sql("loans", f"""
select store, strftime(m, '%Y-%m-%d') as month from (
  select 'feature_store' as store, cast(m as date) as m, 0 as mob from ({series}) a
  union all select 'label_store', cast(m + to_months(6) as date), 6 from ({series}) b) required
where not exists (select 1 from loans l where l.snapshot_date = required.m and l.installment_num = required.mob)""")


ORACLES["training_readiness"] = _missing([("1994-10-01", "1998-12-01"), ("1999-01-01", "1999-12-01"), ("2000-01-01", "2002-03-01")])
ORACLES["oot_readiness"] = _missing([("2001-06-01", "2001-12-01")])

# --- silver and gold --------------------------------------------------------------------------

_LOAN_FLOATS = ["loan_amt", "due_amt", "paid_amt", "overdue_amt", "balance"]
ORACLES["silver_loan_daily"] = sql("s_loans_dpd", f"""
select loan_id, Customer_ID, {day("loan_start_date")}, tenure, installment_num, {dbl(_LOAN_FLOATS)}, {day("snapshot_date")},
  mob, installments_missed, {day("first_missed_date")}, dpd from s_loans_dpd""")
ORACLES["silver_attributes"] = sql("s_people", f"select * replace (strftime(snapshot_date, '%Y-%m-%d') as snapshot_date) from s_people")
_MONEY_FLOATS = ["Annual_Income", "Monthly_Inhand_Salary", "Monthly_Balance", "Total_EMI_per_month", "debt_to_income_ratio"]
ORACLES["silver_financials"] = sql("s_money", f"""
select Customer_ID, {dbl(_MONEY_FLOATS)}, Num_Bank_Accounts, Num_of_Loan, income_category, {day("snapshot_date")} from s_money""")
ORACLES["silver_clickstream"] = sql("clicks", f"select Customer_ID, {day('snapshot_date')}, {dbl(CLICKS)} from clicks")
ORACLES["feature_store"] = sql("features", f"""
select Customer_ID, {day("snapshot_date")}, loan_id, {day("loan_start_date")}, tenure, cast(loan_amt as double) as loan_amt,
  customer_age, customer_occupation, age_group, occupation_category, {dbl(_MONEY_FLOATS)}, Num_Bank_Accounts, Num_of_Loan,
  income_category, {dbl(CLICKS)} from features""")
ORACLES["label_store"] = sql("label_rows", f"select loan_id, Customer_ID, label, label_def, {day('snapshot_date')} from label_rows")
ORACLES["label_distribution"] = sql("label_rows", "select label, count(*) as n_rows from label_rows group by label order by label")
ORACLES["default_rate"] = sql("label_rows", f"""
select {day("snapshot_date")}, count(label) as n_rows, cast(sum(label) as bigint) as defaults, {r6("avg(label)", "default_rate")}
from label_rows group by snapshot_date""")

ORACLES["medallion_backfill"] = sql("features label_rows", f"""
select strftime(coalesce(f.snapshot_date, l.snapshot_date), '%Y-%m-%d') as snapshot_date, feature_rows, with_age, with_income,
  amount_cents, age_sum, with_band, loan_count_sum, fe_1_cents, label_rows, defaults
from (select snapshot_date, count(*) as feature_rows, count(customer_age) as with_age, count(Annual_Income) as with_income,
        cast(sum(cast(round(cast(loan_amt as double) * 100) as bigint)) as bigint) as amount_cents,
        cast(sum(customer_age) as bigint) as age_sum, count(age_group) as with_band, cast(sum(Num_of_Loan) as bigint) as loan_count_sum,
        cast(sum(cast(round(cast(fe_1 as double) * 100) as bigint)) as bigint) as fe_1_cents
      from features group by snapshot_date) f
full join (select snapshot_date, count(*) as label_rows, cast(sum(label) as bigint) as defaults
           from label_rows group by snapshot_date) l on f.snapshot_date = l.snapshot_date""")

# --- data quality -----------------------------------------------------------------------------

_TYPED = {"Customer_ID": "Customer_ID", "Annual_Income": "Annual_Income", "Monthly_Inhand_Salary": "Monthly_Inhand_Salary",
          "Num_Bank_Accounts": "Num_Bank_Accounts", "Num_of_Loan": "Num_of_Loan", "Monthly_Balance": "Monthly_Balance",
          "Total_EMI_per_month": "Total_EMI_per_month", "snapshot_date": "snapshot_date"}


def _typed_count(c):
    target = {"Customer_ID": None, "snapshot_date": None, "Num_Bank_Accounts": "double", "Num_of_Loan": "double"}.get(c, "float")
    if target is None:
        return f"select '{c}' as column_name, count({c}) as present, cast(0 as bigint) as lost from money"
    return (f"select '{c}' as column_name, count({c}) as present, "
            f"count(*) filter (where {c} is not null and try_cast(replace({c}, '_', '') as {target}) is null) as lost from money")


ORACLES["cast_report"] = sql("money", " union all ".join(_typed_count(c) for c in _TYPED))
_FEATURE_COLUMNS = ["Customer_ID", "snapshot_date", "loan_id", "loan_start_date", "tenure", "loan_amt", "customer_age",
                    "customer_occupation", "age_group", "occupation_category", *_MONEY_FLOATS, "Num_Bank_Accounts",
                    "Num_of_Loan", "income_category", *CLICKS]
ORACLES["dq_missing"] = sql("features", f"""
select column_name, missing_count, {r6("round(missing_count / total::double * 100, 2)", "missing_percentage")} from ({" union all ".join(
    f"select '{c}' as column_name, count(*) - count({c}) as missing_count, count(*) as total from features" for c in _FEATURE_COLUMNS)}) t
where missing_count > 0""")


def _bad(table, c):
    return f"select '{c}' as column_name, {c} as value from {table} where {c} is not null and trim({c}) <> '' and try_cast({c} as double) is null"


_BAD_MONEY = " union all ".join(_bad("money", c) for c in (
    "Annual_Income", "Monthly_Inhand_Salary", "Num_Bank_Accounts", "Num_of_Loan", "Total_EMI_per_month", "Monthly_Balance"))
ORACLES["dq_non_numeric"] = sql("people money", f"""
select column_name, count(*) as bad_count from ({_bad("people", "Age")} union all {_BAD_MONEY}) t group by column_name""")
ORACLES["dq_non_numeric_samples"] = sql("money", f"""
select column_name, value, cast(rn as int) as rank from (
  select column_name, value, row_number() over (partition by column_name order by value) as rn
  from (select distinct column_name, value from ({_BAD_MONEY}) b) d) t where rn <= 10""")


def _duplicates(name, table, keys):
    return f"select '{name}' as check_name, count(*) - (select count(*) from (select distinct {keys} from {table}) d) as duplicates from {table}"


ORACLES["dq_duplicates"] = sql("people loans", " union all ".join([
    _duplicates("attributes by customer", "people", "Customer_ID"),
    _duplicates("loans by loan and snapshot", "loans", "loan_id, snapshot_date"),
    _duplicates("loans by loan", "loans", "loan_id"),
    _duplicates("loans by customer and snapshot", "loans", "Customer_ID, snapshot_date")]))
ORACLES["dq_shape"] = sql("money", """
select column_name, cast(position as int) as position, data_type, row_count from (values
  ('Customer_ID', 0, 'string'), ('Annual_Income', 1, 'string'), ('Monthly_Inhand_Salary', 2, 'string'),
  ('Num_Bank_Accounts', 3, 'string'), ('Num_of_Loan', 4, 'string'), ('Monthly_Balance', 5, 'string'),
  ('Total_EMI_per_month', 6, 'string'), ('snapshot_date', 7, 'date')) t(column_name, position, data_type)
cross join (select count(*) as row_count from money) n""")

# --- preparation ------------------------------------------------------------------------------

ORACLES["split_features"] = sql("features", f"""
select loan_id, Customer_ID, {day("snapshot_date")}, {dbl(["loan_amt"])}, customer_age, {dbl(["Annual_Income"])}
from features where snapshot_date between date '1999-01-01' and date '1999-12-01'""")
_SPAN = f"count(*) as n_rows, {day('min(snapshot_date)', 'first_day')}, {day('max(snapshot_date)', 'last_day')}"
ORACLES["temporal_split_counts"] = sql("loans splits", f"""
select split, {_SPAN} from loans join splits on snapshot_date between a and b where installment_num = 0 group by split""")
ORACLES["rolling_split_counts"] = sql("loans", f"""
select split, {_SPAN} from (
  select snapshot_date, case when back <= 1 then 'test' when back <= 3 then 'validation' when back <= 15 then 'train' end as split
  from (select snapshot_date, datediff('month', snapshot_date, (select max(snapshot_date) from loans where installment_num = 0)) as back
        from loans where installment_num = 0) b) t
where split is not null group by split""")
ORACLES["training_set"] = sql("training", f"""
select loan_id, split, {day("snapshot_date")}, {dbl(["loan_amt", "Annual_Income"])}, label from training""")
ORACLES["training_set_aligned"] = sql("training_aligned", f"""
select split, {day("snapshot_date")}, count(*) as n_rows, cast(sum(label) as bigint) as defaults
from training_aligned group by split, snapshot_date""")
ORACLES["training_set_left"] = sql("training_early", f"""
select split, {day("snapshot_date")}, count(*) as n_rows, count(label) as labelled, cast(sum(label) as bigint) as defaults
from training_early group by split, snapshot_date""")
_INTS = ["tenure", "customer_age", "Num_Bank_Accounts", "Num_of_Loan"]
_FLOATS = [c for c in FEATURES if c not in _INTS]
ORACLES["train_matrix"] = sql("training", f"select loan_id, split, label, {', '.join(_INTS)}, {dbl(_FLOATS)} from training")
ORACLES["inference_matrix"] = sql("features", f"""
select loan_id, Customer_ID, {day("snapshot_date")}, cast(null as double) as Interest_Rate, {", ".join(r6(c, c) for c in FEATURES)} from features""")
ORACLES["feature_medians"] = sql("features", " union all ".join(
    f"select {day('snapshot_date')}, '{c}' as column_name, {r6(f'median(cast({c} as double))', 'median')}, count({c}) as n from features group by snapshot_date"
    for c in FEATURES))
ORACLES["imputed_features"] = sql("filled_scoring", f"""
select loan_id, Customer_ID, {day("snapshot_date")}, {", ".join(r6(c, c) for c in FEATURES)} from filled_scoring""")
ORACLES["imputed_training_features"] = sql("filled_training", f"""
select loan_id, split, label, {", ".join(r6(c, c) for c in FEATURES)} from filled_training""")
ORACLES["scaler_stats"] = sql("filled_training", " union all ".join(
    f"select '{c}' as column_name, {r6(f'avg({c})', 'mean')}, {r6(f'stddev_pop({c})', 'std')} from filled_training where split = 'train'"
    for c in FEATURES))
_FITTED = ", ".join(f"avg({c}) as m_{c}, stddev_pop({c}) as s_{c}" for c in FEATURES)
ORACLES["scaled_features"] = sql("filled_training", f"""
select loan_id, split, label, {", ".join(r6(f"({c} - m_{c}) / case when s_{c} = 0 then 1 else s_{c} end", c) for c in FEATURES)}
from filled_training cross join (select {_FITTED} from filled_training where split = 'train') s""")
ORACLES["class_weights"] = sql("training", f"""
select label, n as n_rows, {r6("total / (2.0::double * n)", "balanced_weight")}, {r6("n0 / n1::double", "scale_pos_weight")}
from (select label, count(*) as n from training where split = 'train' group by label) c
cross join (select count(*)::double as total, count(*) filter (where label = 0) as n0, count(*) filter (where label = 1) as n1
            from training where split = 'train') t""")

# --- predictions against labels ---------------------------------------------------------------

ORACLES["score_output"] = sql("scores", f"""
select loan_id, Customer_ID, {r6("p", "prediction_proba")}, case when p >= 0.5 then 1 else 0 end as prediction_label,
  0.5::double as threshold, 'alpha' as model_name, {day("snapshot_date", "inference_date")} from scores""")
ORACLES["resolve_predictions"] = sql("preds", f"""
select {day("snapshot_date", "inference_date")}, case when day(snapshot_date) % 3 = 0 then 'unnamed'
    when day(snapshot_date) % 2 = 1 then 'beta' else 'alpha' end as model_name, count(*) as n_rows, {r6("avg(case when not isnan(p) then p end)", "mean_prediction")}
from preds where model_name = case when day(snapshot_date) % 3 = 0 then 'alpha' when day(snapshot_date) % 2 = 1 then 'beta' else 'alpha' end
group by snapshot_date""")
ORACLES["aligned_label_join"] = sql("scores truth", f"""
select {day("s.snapshot_date")}, {day("t.label_date")}, count(*) as n_rows, cast(sum(t.label) as bigint) as defaults
from scores s join truth t on s.loan_id = t.loan_id and s.Customer_ID = t.Customer_ID
  and t.label_date = cast(s.snapshot_date + to_months(6) as date)
group by s.snapshot_date, t.label_date""")
ORACLES["prediction_label_join"] = sql("joined", f"""
select loan_id, Customer_ID, model_name, {day("snapshot_date")}, {r6("case when not isnan(p) then p end", "prediction")}, label from joined""")
ORACLES["unmatched_keys"] = sql("scores truth", """
(select 'predictions' as side, loan_id from scores where loan_id not in (select loan_id from truth) order by loan_id limit 5)
union all
(select 'labels', loan_id from truth where loan_id not in (select loan_id from scores) order by loan_id limit 5)""")
ORACLES["predicted_rates"] = sql("scores", f"""
select {day("snapshot_date")}, {r6("avg(label)", "actual_rate")}, {r6("avg(p)", "mean_probability")},
  {r6("avg(case when p >= 0.5 then 1 else 0 end)", "predicted_rate")}, {r6("avg(case when p > 0.5 then 1 else 0 end)", "predicted_rate_strict")}
from scores group by snapshot_date""")

_CELL_LIST = ", ".join(_CELLS)
_RATE_LIST = ", ".join(r6(c, c) for c in ("accuracy", "precision", "recall", "f1_score"))


def _over(source, keys, kind):
    lead = f"{day(keys)}, " if keys else ""
    if kind == "matrix":
        return sql(source, f"select {lead}{_CELL_LIST} from ({matrix(source, keys)}) t")
    if kind == "rates":
        return sql(source, f"select {lead}{_CELL_LIST}, {_RATE_LIST} from ({rates('(' + matrix(source, keys) + ') m')}) t")
    build, name = {"loss": (loss, "log_loss"), "auc": (auc, "auc_roc")}[kind]
    return sql(source, f"select {lead}{r6(name, name)} from ({build(source, keys)}) t")


ORACLES["confusion_matrix"] = _over("scores", "snapshot_date", "matrix")
ORACLES["classification_metrics"] = _over("scores", "snapshot_date", "rates")
ORACLES["log_loss"] = _over("scores", "snapshot_date", "loss")
ORACLES["auc_by_snapshot"] = _over("scores", "snapshot_date", "auc")
ORACLES["auc_with_ties"] = sql("scores", f"""
select {day("snapshot_date")}, {r6("auc_roc", "auc_roc")}
from ({auc("(select snapshot_date, label, floor(p * 10) / 10 as p from scores) s", "snapshot_date")}) t""")
ORACLES["auc"] = _over("doc_scores", "", "auc")
ORACLES["log_loss_documents"] = _over("doc_scores", "", "loss")
ORACLES["classification_metrics_documents"] = _over("doc_scores", "", "rates")
ORACLES["evaluate_models"] = sql("joined", f"""
select model_name, {_RATE_LIST}, 0.5::double as threshold, {r6("auc_roc", "auc_roc")}, {r6("log_loss", "log_loss")}, {_CELL_LIST}
from ({rates('(' + matrix("joined", "model_name") + ') m')}) a
join ({loss("joined", "model_name")}) b using (model_name) join ({auc("joined", "model_name")}) c using (model_name)""")
ORACLES["psi_bins"] = sql("hist_scores", f"""
select {day("snapshot_date")}, cast(bin as int) as bin, c as bin_count, {r6("c / n::double", "share")} from hist_scores""")
ORACLES["psi_by_snapshot"] = sql("hist_scores", f"""
select {day("snapshot_date")}, {r6("psi", "psi")} from ({psi_sum(
    "hist_scores", "(select bin, c, n from hist_scores where snapshot_date = (select min(snapshot_date) from hist_scores))", "true",
    "snapshot_date")}) t""")
_DENSITY = f"""
select {day("snapshot_date")}, bin, {r6("lo + bin * w", "bin_start")}, count(*) as bin_count, {r6("count(*) / (n * w)", "density")}
from (select *, cast(case when p < lo + g * w then g - 1 when p >= lo + (g + 1) * w and g <> 49 then g + 1 else g end as int) as bin
      from (select s.snapshot_date, s.p, r.lo, r.n, (r.hi - r.lo) / 50 as w,
              least(floor((s.p - r.lo) / (r.hi - r.lo) * 50), 49) as g
            from scores s join (select snapshot_date, min(p) as lo, max(p) as hi, count(*) as n from scores group by snapshot_date) r
              on s.snapshot_date = r.snapshot_date) a) b
group by snapshot_date, bin, lo, w, n"""
ORACLES["score_density"] = sql("scores", _DENSITY)

# --- monitoring -------------------------------------------------------------------------------

_METRICS = ["accuracy", "precision", "recall", "f1_score", "auc_roc", "log_loss", "psi"]
_CHECKS = ["auc_roc_check", "precision_check", "recall_check", "f1_score_check", "psi_warning", "psi_critical", "all_passed",
           "alert_level"]
_M6 = ", ".join(r6(c, c) for c in _METRICS)
ORACLES["monitoring_report"] = sql("report", f"""
select model_name, {day("snapshot_date")}, has_labels, {_M6}, threshold, {_CELL_LIST}, {", ".join(_CHECKS)} from report""")
ORACLES["threshold_checks"] = sql("measured", f"""
select model_name, {day("snapshot_date")}, {", ".join(r6(c, c) for c in ("auc_roc", "precision", "recall", "f1_score", "psi"))},
  {", ".join(_CHECKS)} from ({checked("measured", zero_is_ok=True)}) t""")
ORACLES["monitoring_flat"] = sql("newest", f"""
select model_name, {day("snapshot_date")}, monitored_at,
  {", ".join(r6(c, "metric_" + c) for c in _METRICS)}, threshold as metric_threshold,
  {", ".join(f"{c} as metric_{c}" for c in _CELLS)}, {", ".join(f"{c} as check_{c}" for c in _CHECKS)} from newest""")
ORACLES["monitoring_period"] = sql("report", f"""
select model_name, {day("snapshot_date")}, has_labels, {_M6}, threshold, {_CELL_LIST}, {", ".join(_CHECKS)} from report
where snapshot_date between date '2024-01-10' and date '2024-01-15'""")
ORACLES["history_flatten"] = sql("history", f"""
select model_name, {day("snapshot_date")}, monitored_at, {_M6}, threshold, {_CELL_LIST},
  {", ".join(f"{c} as check_{c}" for c in _CHECKS)} from history""")
ORACLES["history_append"] = sql("history", f"""
select model_name, {day("snapshot_date")}, count(*) as records from history group by model_name, snapshot_date""")
ORACLES["history_in_period"] = sql("history", f"""
select model_name, {day("snapshot_date")}, monitored_at, {r6("auc_roc", "auc_roc")}, {r6("psi", "psi")}, alert_level as check_alert_level
from history where snapshot_date between date '2024-01-05' and date '2024-01-20'""")
ORACLES["history_latest"] = sql("newest", f"""
select model_name, {day("snapshot_date")}, monitored_at, {r6("accuracy", "accuracy")}, {r6("auc_roc", "auc_roc")}, {r6("psi", "psi")} from newest""")
ORACLES["latest_metrics"] = sql("history", f"""
select {day("snapshot_date")}, model_name, {", ".join(r6(c, c) for c in _METRICS if c != "log_loss")}
from history qualify row_number() over (partition by model_name order by history.snapshot_date desc, monitored_at desc) = 1""")
_PASSED = "(auc_roc_check::int + precision_check::int + recall_check::int + f1_score_check::int)"
ORACLES["threshold_compliance"] = sql("history", f"""
select {day("snapshot_date")}, model_name, monitored_at, {_PASSED} as passed_checks, 4 as total_checks,
  {r6(f"{_PASSED} / 4.0::double * 100", "compliance_rate")} from history""")
ORACLES["monitoring_summary"] = sql("history", f"""
select {day("min(snapshot_date)", "first_snapshot")}, {day("max(snapshot_date)", "last_snapshot")}, count(*) as records,
  model_name, {", ".join(r6(f"avg({c})", "avg_" + c) for c in _METRICS if c != "log_loss")},
  {r6("avg(all_passed::int) * 100", "pass_rate")} from history group by model_name""")
_SERIES = {"auc_roc": "0.7", "accuracy": "null", "precision": "0.6", "recall": "0.5", "f1_score": "0.55", "log_loss": "null",
           "psi": "0.2", "true_positives": "null", "false_positives": "null", "true_negatives": "null", "false_negatives": "null"}
ORACLES["monitoring_series"] = sql("history", " union all ".join(
    f"select {day('snapshot_date')}, model_name, monitored_at, '{c}' as series, {r6(c, 'value')}, cast({t} as double) as threshold, {"0.1::double" if c == "psi" else "null::double"} as warning from history"
    for c, t in _SERIES.items()))
ORACLES["even_period_sample"] = sql("scores", f"""
select position, {day("d.snapshot_date")}
from (select cast(case when k = 9 then n - 1 else floor(k * ((n - 1) / 9.0::double)) end as int) as position
      from (select count(distinct snapshot_date) as n from scores) c cross join (select unnest(range(10)) as k) ks) p
join (select snapshot_date, row_number() over (order by snapshot_date) - 1 as i
      from (select distinct snapshot_date from scores) u) d on p.position = d.i""")
ORACLES["sampled_density"] = sql("scores", f"""
select * from ({_DENSITY}) density
where snapshot_date between '2024-01-05' and '2024-01-28' and snapshot_date in (
  select strftime(d.snapshot_date, '%Y-%m-%d')
  from (select case when k = 9 then n - 1 else floor(k * ((n - 1) / 9.0::double)) end as position
        from (select count(distinct snapshot_date) as n from scores) c cross join (select unnest(range(10)) as k) ks) p
  join (select snapshot_date, row_number() over (order by snapshot_date) - 1 as i
        from (select distinct snapshot_date from scores) u) d on p.position = d.i)""")
ORACLES["monitoring_records"] = sql("newest", f"""
select {day("snapshot_date")}, model_name, monitored_at,
  {r6("auc_roc", "auc_roc")}, true_positives, {r6("psi", "psi")}, all_passed, alert_level, 0.2::double as psi_critical from newest""")
_FAILS = {"auc_roc": 0.7, "precision": 0.6, "recall": 0.5, "f1_score": 0.55}
ORACLES["retrain_trigger"] = sql("newest", f"""
select model_name, {day("snapshot_date")}, repeated_failure, drifted, repeated_failure or drifted as retrain from (
  select model_name, snapshot_date, coalesce(psi > 0.2, false) as drifted,
    {" or ".join(f"(f_{c} and coalesce(lag(f_{c}) over w, false))" for c in _FAILS)} as repeated_failure
  from (select *, {", ".join(f"not coalesce({c} >= {t}, false) as f_{c}" for c, t in _FAILS.items())} from newest) t
  window w as (partition by model_name order by snapshot_date)) x""")
ORACLES["performance_degradation"] = sql("newest", f"""
select model_name, {day("snapshot_date")}, {r6("auc_roc", "value")}, {r6("base", "baseline")}, coalesce(auc_roc < base * (1 - 0.05), false) as degraded
from newest join (select model_name as m, arg_min(auc_roc, snapshot_date) as base from newest where auc_roc is not null group by model_name) b
  on model_name = m""")
ORACLES["registry_metrics"] = sql("registry", f"select ordinal, model_name, split, metric, {r6('value', 'value')} from registry")
ORACLES["best_model"] = sql("registry", f"""
select model_name, 'auc_roc' as selection_metric, {r6("value", "selection_score")} from registry
where split = 'validation' and metric = 'auc_roc' order by value desc, ordinal limit 1""")

# --- models: what SQL can derive of fits and scores -------------------------------------------

_PARTS = "case when vec_id % 10 <= 6 then 'train' when vec_id % 10 <= 8 then 'validation' else 'test' end"
for _query, _model in (("train_logreg", "LogisticRegression"), ("train_rf", "RandomForest"), ("train_gbt", "GradientBoosting")):
    ORACLES[_query] = f"""
select '{_model}' as model_name, {_PARTS} as split, count(*) as n_rows, count(*) filter (where label < 3) as positives,
  count(*) as counted, true as in_range, true as beats_chance{", true as at_optimum" if _query == "train_logreg" else ""}
from embeddings group by 2"""
ORACLES["registry_long"] = """
select cast(o as int) as ordinal, m as model_name, split, metric, true as in_range
from (values (1, 'LogisticRegression'), (2, 'RandomForest'), (3, 'GradientBoosting')) a(o, m)
cross join (values ('train'), ('validation'), ('test')) b(split)
cross join (values ('accuracy'), ('precision'), ('recall'), ('f1_score'), ('auc_roc'), ('log_loss')) c(metric)"""
_SCORED = "features where snapshot_date between date '2001-01-01' and date '2001-08-01'"
ORACLES["score_range"] = sql("features", f"""
select {day("snapshot_date", "inference_date")}, count(*) as n_rows, true as in_range from {_SCORED} group by snapshot_date""")
ORACLES["score_best"] = sql("features", f"""
select loan_id, Customer_ID, 0.5::double as threshold, {day("snapshot_date", "inference_date")}, true as in_range, true as label_agrees
from {_SCORED}""")
ORACLES["degradation_from_validation"] = sql("newest registry", f"""
select n.model_name, {day("n.snapshot_date")}, {r6("n.auc_roc", "value")}, {r6("r.value", "baseline")},
  coalesce(n.auc_roc < r.value * (1 - 0.05), false) as degraded
from newest n left join (select model_name, value from registry where metric = 'auc_roc' and split = 'validation') r
  on n.model_name = r.model_name""")
ORACLES["scheduled_retraining"] = sql("label_rows", f"""
select 'alpha' as model_name, {day("snapshot_date")}, spell > 0 and spell > coalesce(lag(spell) over w, 0) as scheduled,
  rate > 0.2 or (fails and coalesce(lag(fails) over w, false)) or (spell > 0 and spell > coalesce(lag(spell) over w, 0)) as retrain
from (select snapshot_date, rate, rate < 0.7 as fails, datediff('month', min(snapshot_date) over (), snapshot_date) // 2 as spell
      from (select snapshot_date, avg(label) as rate from label_rows group by snapshot_date) r) q
window w as (order by snapshot_date)""")

# derivatives of the log loss at the start, sums left of each of at most 254 quantiles, the greatest gain
ORACLES["boosted_stump"] = """
with rows as (select vec_id, case when label < 3 then 1 else 0 end as y, embedding from embeddings),
base as (select count(*) as n, -(sum(0.5 - y)) / (0.25 * count(*)) as start from rows),
grad as (select vec_id, 1 / (1 + exp(-start)) - y as g, 1 / (1 + exp(-start)) * (1 - 1 / (1 + exp(-start))) as h, embedding from rows, base),
cell as (select vec_id, f, cast(embedding[f] as double) as x, g, h from grad, range(1, 65) r(f)),
ranked as (select f, x, row_number() over (partition by f order by x) as k, count(*) over (partition by f) as n, max(x) over (partition by f) as top from cell),
edge as (select distinct f, x as edge from ranked join range(1, 255) q(i) on k = ceil((i::double / 255) * n) where x < top),
upto as (select f, x, sum(g) over w as gl, sum(h) over w as hl, sum(g) over (partition by f) as ga, sum(h) over (partition by f) as ha
         from cell window w as (partition by f order by x range between unbounded preceding and current row)),
gain as (select distinct u.f, edge, gl, hl, ga, ha, gl * gl / (hl + 1) + (ga - gl) * (ga - gl) / (ha - hl + 1) - ga * ga / (ha + 1) as gain
         from edge join upto u on edge.f = u.f and edge.edge = u.x where hl >= 1 and ha - hl >= 1),
best as (select * from gain qualify row_number() over (order by round(gain, 9) desc, f, edge) = 1),
margin as (select avg(start + case when x <= edge then -gl / (hl + 1) else -(ga - gl) / (ha - hl + 1) end) as mean_margin, count(*) as n_rows
           from cell join best on cell.f = best.f, base)
select cast(f as int) as feature, round(edge, 6) + 0.0 as threshold, round(-gl / (hl + 1), 6) + 0.0 as left_weight,
  round(-(ga - gl) / (ha - hl + 1), 6) + 0.0 as right_weight, n_rows, round(mean_margin, 6) + 0.0 as mean_margin
from best, margin"""

ORACLES["monitoring_incremental"] = ORACLES["monitoring_report"]

ORACLES["atomic_rerun"] = sql("s_loans", f"""
select 1 as version, {day("snapshot_date")}, count(*) as n_rows from s_loans group by snapshot_date
union all
select 2, {day("snapshot_date")}, count(*) from s_loans
where year(snapshot_date) <> 1997 or (snapshot_date <> date '1997-03-01' and mob % 2 = 0) group by snapshot_date""")


def _medians_of(source):
    return f"select {', '.join(f'median(cast({c} as double)) as {c}' for c in FEATURES)} from {source}"


CTES["train_rows"] = (("training",), "select * from training where split = 'train'")
CTES["train_medians"] = (("train_rows",), _medians_of("train_rows"))
ORACLES["imputed_train_scope"] = sql("training train_medians", f"""
select t.loan_id, t.split, t.label, {", ".join(r6(f"coalesce(cast(t.{c} as double), m.{c})", c) for c in FEATURES)}
from training t, train_medians m""")

CTES["may_less"] = (("features",), "select * replace (case when month(snapshot_date) <> 5 then Monthly_Inhand_Salary end as Monthly_Inhand_Salary) from features")
CTES["may_medians"] = (("may_less",), f"{_medians_of('may_less').replace('select ', 'select snapshot_date, ')} group by snapshot_date")
ORACLES["imputed_batch_scope"] = sql("may_less may_medians train_medians", f"""
select t.loan_id, t.Customer_ID, {day("t.snapshot_date")}, {", ".join(r6(f"coalesce(cast(t.{c} as double), b.{c}, m.{c})", c) for c in FEATURES)}
from may_less t join may_medians b on t.snapshot_date = b.snapshot_date, train_medians m""")

ORACLES["history_documents"] = ORACLES["history_flatten"]

_COUNTED = " union all ".join(
    f"select '{layer}' as layer, '{name}' as table_name, count(*) as n_rows, count(*) - count(snapshot_date) as undated, "
    f"strftime(min(snapshot_date), '%Y-%m-%d') as first_day, strftime(max(snapshot_date), '%Y-%m-%d') as last_day from {source}"
    for layer, name, source in [(x, n, s) for x in ("bronze", "silver") for n, s in (
        ("loan_daily", "loans"), ("attributes", "people"), ("financials", "money"), ("clickstream", "clicks"))]
    + [("gold", "feature_store", "features"), ("gold", "label_store", "label_rows")])
ORACLES["medallion_counts"] = sql("loans people money clicks features label_rows", _COUNTED)
