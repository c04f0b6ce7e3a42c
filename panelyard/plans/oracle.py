"""SQL twins of the panel stages, as chained common table expressions for DuckDB.

They state the test panel's values directly and share no code with the operators.
"""

from __future__ import annotations

from panelyard.plans import contract as C


def _band(x: str, bands) -> str:
    edges, labels = bands
    cases = " ".join(f"when {x} < {e} then '{n}'" for e, n in zip(edges[1:], labels, strict=True))
    return f"case when {x} is null or {x} < {edges[0]} then 'Unknown' {cases} else 'Unknown' end"


def _map(x: str, names: dict, default: str = "'Unknown'") -> str:
    return f"case {x} " + " ".join(f"when '{k}' then '{v}'" for k, v in names.items()) + f" else {default} end"


STEPS = {
    "g": """select l_suppkey as k, date_trunc('month', l_shipdate)::date as m, count(*) filter (where l_returnflag = 'R') as nr from lineitem group by 1, 2""",
    "b0": """select *, row_number() over (partition by k order by m) - 1 as idx, year(m) * 12 + month(m) as mi, min(m) over (partition by k) as m0,
        max(m) over (partition by k) as last, 100000 + k * 7919 % 900000 as orig, 72 + 12 * (k % 25) as term from g""",
    "b": """select *, (case when idx = 0 then 0 when k % 17 = 3 and idx in (2, 3) then orig * 102 // 100 when k % 13 = 1 and idx % 9 = 4 then orig * 99 // 100
          else orig * greatest(0, 100 - 9 * (idx // 8)) // 100 end)::double as bal,
        case when k % 3 = 0 then nr - 3 when k % 10 = 5 then idx // 6 - 4 else nr - 6 end as x,
        case when (k % 29 <> 4 and m = last) or (k % 29 = 4 and idx = 60) then ['', '01', '02', '03', '06', '09', '15', '16'][(k % 8) + 1] else '' end as code,
        (k % 29 <> 4 and m = last) or (k % 29 = 4 and idx = 60) as ends, k % 31 = 6 and idx >= 10 as modified, k % 6 = 0 and (k + mi) % 10 < 2 as forborne from b0""",
    "mo0": """select k, idx, mi, k::varchar as loan_id, m as reporting_month, bal as current_balance,
        (300 + k * 11 % 400 - case when modified then 50 else 0 end)::double / 100 as current_interest_rate, (idx + k % 24)::int as loan_age_months,
        (term - idx + case when k % 19 = 5 and idx < 3 then 6 else 0 end)::int as remaining_term_months, (100 + k % 400)::double as scheduled_principal,
        (k % 5 * 100)::double as non_interest_bearing_upb, case when ends then bal end as last_upb,
        case when (k + mi) % 11 <> 0 then greatest(0, x)::int end as dlq_months, nullif(code, '') as zero_balance_code, code,
        case when ends and k % 8 <> 0 then m end as zero_balance_date, case when k % 2 = 0 then (m - interval 1 month)::date end as last_paid_installment,
        modified as modification_flag, forborne as forbearance_flag, 'Servicer ' || ((k + idx // 24) % 5) as servicer_name, 'part' || (k % 4) as source_file, k * 1000 + idx as ingest_seq from b""",
    "mo": """select *, (dlq_months * 30)::double as days_past_due, case when code = '01' then 'Prepaid' when code in ('02', '03', '09', '15') then 'Default' when code <> '' then 'Closed'
          when dlq_months >= 6 then 'Default' when dlq_months >= 1 then 'Delinquent' else 'Current' end as current_status,
        coalesce(dlq_months >= 1, false) as delinquency, coalesce(dlq_months >= 6, false) or code in ('02', '03', '09', '15') as default_flag, code = '01' as prepayment_flag, code <> '' as is_terminated,
        """ + _map("code", C.ZERO_BALANCE, "null") + """ as termination_reason, code in ('02', '03', '09', '15') as default_flag_credit_event,
        code in ('02', '03', '09', '15') or (coalesce(dlq_months >= 6, false) and not forbearance_flag) as default_flag_ex_forbearance from mo0""",
    "st0": """select k, k::varchar as loan_id, orig::double as original_balance, (300 + k * 11 % 400)::double / 100 as interest_rate, term::int as original_term_months,
        case when k % 13 <> 0 then (500 + k * 37 % 351)::double end as credit_score, case when k % 4 = 0 then (520 + k * 29 % 300)::double end as co_borrower_credit_score,
        case when k % 13 <> 0 then (40 + k * 13 % 65)::double end as ltv, case when k % 13 <> 0 then (40 + k * 13 % 65 + k % 3)::double end as combined_ltv,
        case when k % 13 <> 0 then (10 + k * 7 % 50)::double end as dti, (case when k % 23 = 2 then m0 + interval 2 month else m0 - to_months((k % 24)::int) end)::date as origination_month from b where idx = 0""",
    "st": f"""select *, {_band('credit_score', C.CREDIT_BANDS)} as credit_score_band, {_band('ltv', C.LTV_BANDS)} as ltv_band, {_band('dti', C.DTI_BANDS)} as dti_band,
        ['Unknown', 'TX', 'CA', 'NY', 'FL', 'OH', 'WA', 'IL'][(k % 8) + 1] as state, ['purchase', 'cash_out_refinance', 'refinance', 'Unknown', 'Unknown'][(k % 5) + 1] as loan_purpose,
        ['single_family', 'planned_urban_development', 'condominium', 'cooperative', 'manufactured_home', 'Unknown'][(k % 6) + 1] as property_type,
        ['principal', 'investor', 'second_home', 'Unknown'][(k // 4 % 4) + 1] as occupancy_type, ['retail', 'correspondent', 'broker', 'Unknown'][(k % 4) + 1] as channel,
        ['borrower_paid', 'lender_paid', 'investor_paid', 'Unknown'][(k % 4) + 1] as mi_type, 'Seller ' || (k % 7) as seller_name, (1 + k % 3)::int as num_borrowers, (1 + k % 4)::int as num_units,
        (10000 + k % 50)::varchar as msa, lpad((k * 17 % 1000)::varchar, 3, '0') as zip3, case when k % 3 = 0 then (k % 30)::double end as mi_pct, 'FRM' as product_type, k % 2 = 0 as first_time_buyer,
        k % 9 = 0 as homeready_flag, k % 10 = 0 as high_balance_flag, year(origination_month)::int as vintage_year, quarter(origination_month)::int as vintage_quarter from st0""",
    "cl0": """select * exclude (dlq_months, days_past_due), dlq_months is null as dlq_status_unreported, coalesce(dlq_months, 0) as dlq_months, coalesce(days_past_due, 0) as days_past_due,
        coalesce(current_balance, 0) <= 0 and not is_terminated as balance_imputed from mo""",
    "cl1": "select *, case when not balance_imputed then current_balance end as known from cl0",
    "cl": """select * exclude (current_balance, known), coalesce(known, last_value(known ignore nulls) over (partition by loan_id order by reporting_month rows unbounded preceding),
          first_value(known ignore nulls) over (partition by loan_id order by reporting_month rows between current row and unbounded following)) as current_balance from cl1""",
    "pn": """select cl.*, st.* exclude (k, loan_id), current_balance is null as balance_unrecoverable, (row_number() over (partition by cl.loan_id order by reporting_month) - 1)::int as month_index
        from cl left join st using (loan_id)""",
    "fd": """select loan_id, reporting_month, case when (k + mi) % 17 = 0 then ['Current', 'Delinquent', 'Default', 'Prepaid', 'Closed'][(list_position(['Current', 'Delinquent', 'Default', 'Prepaid', 'Closed'], current_status) % 5) + 1]
          else current_status end as feed_status, (last_day(reporting_month) + ((k + mi) % 40)::int)::date as last_updated_on, (k + mi) % 19 = 0 as is_stale from mo where (k * 31 + mi) % 20 < 3""",
    "ev0": """select pn.*, feed_status as conflict_status, lag(current_balance) over w as prev, lag(current_status) over w as prev_status, lag(reporting_month) over w as prev_month,
        min(zero_balance_date) over (partition by pn.loan_id) as first_end from pn left join fd using (loan_id, reporting_month) window w as (partition by pn.loan_id order by reporting_month)""",
    "ev1": """select *, current_balance - prev as delta, (prev - current_balance) / nullif(prev, 0) * 100 as drop_pct, coalesce(abs(current_balance - prev) < 0.01, false)::int as same,
        coalesce(current_status <> prev_status, false)::int as changed, (year(reporting_month) * 12 + month(reporting_month)) - (year(prev_month) * 12 + month(prev_month)) as gap from ev0""",
    "ev2": "select *, sum(1 - same) over (partition by loan_id order by reporting_month rows unbounded preceding) as block from ev1",
    "ev": """select *, sum(same) over (partition by loan_id, block order by reporting_month rows unbounded preceding) as stale,
        sum(changed) over (partition by loan_id order by reporting_month rows 11 preceding) as flips from ev2""",
    "ru0": """select *, coalesce(current_balance > original_balance * 1.0001::double and not modification_flag, false) as R001, coalesce(delta > 1 and not modification_flag and not is_terminated, false) as R002,
        coalesce(reporting_month < origination_month, false) as R003, (current_status = 'Delinquent' and days_past_due <= 0) or (current_status = 'Current' and days_past_due > 0) as R004,
        coalesce(current_balance < 0, false) or coalesce(remaining_term_months < 0, false) as R005, stale >= 6 and not is_terminated as R006, flips >= 3 as R007, dlq_status_unreported and not is_terminated as R008,
        coalesce(remaining_term_months > original_term_months, false) as R009, coalesce(reporting_month > first_end, false) as R010, coalesce(drop_pct > 40 and not is_terminated, false) as R011,
        coalesce(conflict_status <> current_status, false) as R012, coalesce(gap > 1, false) as R013 from ev""",
    "ru": "select *, " + " + ".join(f"R{int(r[1:]):03d}::int * {t.weight}::double" for r, t in C.RULES.items()) + " as dq_penalty, "
        + " + ".join(f"{r}::int" for r, t in C.RULES.items() if t.severity == "hard") + " as n_hard_failures, "
        + " + ".join(f"{r}::int" for r, t in C.RULES.items() if t.severity == "soft") + " as n_soft_failures, case "
        + " ".join(f"when {r} then '{C.RULES[r].exception_type}'" for r in C.PRIORITY) + " end as exception_type from ru0",
    "ft0": """select *, current_balance / nullif(original_balance, 0) as loan_utilization, (original_balance - current_balance) / nullif(original_balance, 0) as balance_reduction_ratio,
        current_balance / nullif(original_balance, 0) * 100 as remaining_balance_pct, loan_age_months::double / nullif(original_term_months, 0) as term_elapsed_pct,
        current_interest_rate - interest_rate as rate_gap, non_interest_bearing_upb / nullif(original_balance, 0) as deferred_balance_pct,
        lag(days_past_due, 1) over w as dpd_lag_1, lag(days_past_due, 3) over w as dpd_lag_3, days_past_due - lag(days_past_due, 1) over w as dpd_delta_1m,
        """ + ", ".join(f"""avg(days_past_due) over (w rows {k - 1} preceding) as dpd_mean_{k}m, max(days_past_due) over (w rows {k - 1} preceding) as dpd_max_{k}m,
        sum(delinquency::int) over (w rows {k - 1} preceding)::double as delinquent_months_{k}m""" for k in C.ROLLING) + """,
        coalesce(sum(delinquency::int) over (w rows between unbounded preceding and 1 preceding), 0)::double as cum_delinquent_months,
        coalesce(max(dlq_months) over (w rows unbounded preceding), 0)::double as cum_missed_payments, current_balance - lag(current_balance) over w as balance_delta_1m,
        current_balance - lag(current_balance, 3) over w as balance_delta_3m, (current_balance - lag(current_balance) over w) / nullif(lag(current_balance) over w, 0) as balance_pct_change_1m,
        (month_index - last_value(case when modification_flag then month_index end ignore nulls) over (w rows unbounded preceding))::double as months_since_modification,
        max(modification_flag::int) over (w rows unbounded preceding) as ever_modified, max(forbearance_flag::int) over (w rows unbounded preceding) as ever_forbearance,
        sum(forbearance_flag::int) over (w rows unbounded preceding)::double as forbearance_months,
        (0.45::double * coalesce((850 - least(greatest(credit_score, 300), 850)) / 550, 0.5) * (credit_score is not null)::int + case when credit_score is null then 0.45::double * 0.5 else 0 end
          + 0.35::double * case when ltv is null then 0.5 else least(greatest(ltv, 0), 125) / 125 end + 0.20::double * case when dti is null then 0.5 else least(greatest(dti, 0), 65) / 65 end) * 100 as credit_risk_score,
        dti * interest_rate / 100 as debt_burden, 100 - ltv as equity_cushion, least(greatest(1 - abs(loan_age_months::double - 36) / 60, 0), 1) as loan_age_risk, (loan_age_months >= 36)::int as is_seasoned,
        coalesce(ltv > 80, false)::int as high_ltv_flag, coalesce(credit_score < 660, false)::int as subprime_flag, coalesce(dti > 43, false)::int as high_dti_flag
        from pn window w as (partition by loan_id order by reporting_month)""",
    "ft": """select *, (cum_delinquent_months > 0)::int as ever_delinquent, term_elapsed_pct - balance_reduction_ratio as amortisation_gap, (850 - credit_score) / 550 * (ltv / 100) as credit_x_ltv,
        dti / 100 * interest_rate as dti_x_rate, (850 - credit_score) / 550 * (dti / 100) as credit_x_dti, cum_delinquent_months * (ltv / 100) as dlqhist_x_ltv,
        (term_elapsed_pct - balance_reduction_ratio) * interest_rate as amortgap_x_rate from ft0""",
    "en": "select max(reporting_month) as e from mo",
    "tg0": """select *, (year(e) * 12 + month(e)) - (year(reporting_month) * 12 + month(reporting_month)) as months_to_data_end, lead(current_status) over w as following,
        """ + ", ".join(f"coalesce(max({s}::int) over (w rows between 1 following and {k} following), 0) as {n}, coalesce(max(is_terminated::int) over (w rows between 1 following and {k} following), 0) as ended_{n}" for n, (k, s) in C.HORIZONS.items())
        + """, coalesce(max(default_flag_ex_forbearance::int) over (w rows between 1 following and 12 following), 0) as next_12m_default_ex_forbearance,
        coalesce(max(default_flag_credit_event::int) over (w rows between 1 following and 12 following), 0) as next_12m_default_credit_event
        from ft, en window w as (partition by loan_id order by reporting_month)""",
    "tg": "select *, coalesce(following, case when is_terminated then current_status end) as next_state, "
        + ", ".join(f"(months_to_data_end >= {k} or ended_{n} > 0 or {n} > 0)::int as {n}_complete" for n, (k, _) in C.HORIZONS.items())
        + ", (coalesce(following, case when is_terminated then current_status end) is not null and (months_to_data_end >= 1 or is_terminated))::int as next_state_complete from tg0",
    "sp0": """select *, case when reporting_month between (e - interval 23 month)::date and (e - interval 12 month)::date then 'test' when reporting_month <= date '1997-12-31' then 'train'
        when reporting_month between date '1998-01-01' and date '1998-12-31' then 'validation' when reporting_month between date '1999-01-01' and date '1999-12-31' then 'holdout' end as split from tg""",
    "sp": "select * from sp0 where not coalesce(split = 'train' and reporting_month > date '1996-12-01', false)",
}
_NEEDS = {"mo": "mo", "st": "st", "cl": "cl"}


def chain(select: str, last: str = "sp") -> str:
    """``select`` after all steps up to ``last``."""
    names = list(STEPS)
    return "with " + ",\n".join(f"{n} as ({STEPS[n]})" for n in names[:names.index(last) + 1]) + "\n" + select
