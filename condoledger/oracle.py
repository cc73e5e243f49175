"""DuckDB oracle SQL for the driver's side-by-side check.

The same ledger mapping as ``sources/ledger.py``, written once as SQL CTEs
over the pre-registered driver views, then one SELECT per registered query.
DuckDB divides decimals in DOUBLE, so money that needs a rounded quotient
(proration, averages) is computed with exact integer cents here.
"""

from __future__ import annotations

AS_OF = "DATE '2001-07-15'"


def ym(d: str) -> str:
    return f"(year({d}) * 100 + month({d}))"


def round_div_cents(num_money: str, den_int: str) -> str:
    """round_half_away(num / den, 2) for a money numerator, exact (HUGEINT)."""
    n = f"CAST(({num_money}) * 100 AS HUGEINT)"
    return (f"CAST(CAST(sign({n}) * ((2 * abs({n}) + ({den_int})) // (2 * ({den_int}))) AS DECIMAL(38,0)) * 0.01 "
            f"AS DECIMAL(18,2))")


def prorate_sql(total: str, share: str, sum_share: str) -> str:
    """round(total * share / sum_share, 2), exact, NULL when the sum is 0/NULL."""
    t = f"CAST(({total}) * 100 AS HUGEINT)"
    s = f"CAST(({share}) * 100 AS HUGEINT)"
    z = f"CAST(({sum_share}) * 100 AS HUGEINT)"
    return (f"CASE WHEN coalesce({sum_share}, 0) = 0 THEN NULL ELSE "
            f"CAST(CAST(sign({t}) * ((2 * abs({t}) * {s} + {z}) // (2 * {z})) AS DECIMAL(38,0)) * 0.01 "
            f"AS DECIMAL(18,2)) END")


def week_sql(d: str) -> str:
    return f"CAST(date_trunc('week', {d} + 1) AS DATE)"


LEDGER = f"""
ob AS (
  SELECT o.o_orderkey, CAST(o.o_custkey AS BIGINT) AS id_unit, CAST(c.c_nationkey AS BIGINT) AS id_building,
         CAST(o.o_orderdate AS DATE) AS order_date,
         CAST(date_trunc('month', CAST(o.o_orderdate AS DATE)) AS DATE) AS month_start,
         o.o_totalprice, o.o_orderpriority
  FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey),
cal0 AS (
  SELECT CAST(unnest(generate_series(
           CAST(date_trunc('month', CAST(min(o_orderdate) AS DATE)) AS TIMESTAMP),
           CAST(last_day(CAST(max(o_orderdate) AS DATE) + INTERVAL 3 MONTH) AS TIMESTAMP),
           INTERVAL 1 DAY)) AS DATE) AS cal_date
  FROM orders),
cal1 AS (
  SELECT cal_date, CAST(date_trunc('month', cal_date) AS DATE) AS month_start,
         isodow(cal_date) < 6 AS is_weekday,
         ((month(cal_date) = 1 AND day(cal_date) = 1) OR (month(cal_date) = 5 AND day(cal_date) = 1)
          OR (month(cal_date) = 12 AND day(cal_date) = 25)) AS is_holiday
  FROM cal0),
cal AS (
  SELECT *, is_weekday AND NOT is_holiday AS is_business,
         min(CASE WHEN is_weekday AND NOT is_holiday THEN cal_date END)
           OVER (ORDER BY cal_date ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS next_business_day
  FROM cal1),
nth5 AS (
  SELECT month_start, cal_date AS issue_date FROM (
    SELECT month_start, cal_date, row_number() OVER (PARTITION BY month_start ORDER BY cal_date) AS rn
    FROM cal WHERE is_business) WHERE rn = 5),
months AS (
  SELECT m.month_start, n.issue_date, d1.next_business_day AS due1, d2.next_business_day AS due2
  FROM (SELECT DISTINCT month_start FROM cal) m
  LEFT JOIN nth5 n ON n.month_start = m.month_start
  LEFT JOIN cal d1 ON d1.cal_date = least(m.month_start + 9, last_day(m.month_start))
  LEFT JOIN cal d2 ON d2.cal_date = least(m.month_start + 21, last_day(m.month_start))),
bill AS (
  SELECT p.id_building * 1000000 + {ym('p.month_start')} AS id_bill, p.id_building, p.month_start,
         m.issue_date, m.due1, m.due2, p.total
  FROM (SELECT id_building, month_start,
               CAST(sum(CAST(o_totalprice AS DECIMAL(10,2))) AS DECIMAL(18,2)) AS total
        FROM ob GROUP BY id_building, month_start) p
  JOIN months m ON m.month_start = p.month_start),
building AS (
  SELECT CAST(n.n_nationkey AS BIGINT) AS id_building, n.n_name AS name, 'Av. ' || n.n_name AS address,
         a.total_area
  FROM nation n LEFT JOIN (SELECT CAST(c_nationkey AS BIGINT) AS id_building,
                                  CAST(sum(CAST(40 + c_custkey % 61 AS DECIMAL(7,2))) AS DECIMAL(10,2)) AS total_area
                           FROM customer GROUP BY 1) a ON a.id_building = n.n_nationkey),
unit AS (
  SELECT CAST(c_custkey AS BIGINT) AS id_unit, CAST(c_nationkey AS BIGINT) AS id_building,
         CAST(c_custkey % 10 AS INTEGER) AS floor, chr(CAST(65 + c_custkey % 5 AS INTEGER)) AS dept,
         CAST(40 + c_custkey % 61 AS DECIMAL(7,2)) AS area,
         CAST(CASE WHEN c_custkey % 4 = 1 THEN 3.5 ELSE 0 END AS DECIMAL(5,2)) AS storage_m2,
         CAST(CASE WHEN c_custkey % 6 = 2 THEN 12 ELSE 0 END AS DECIMAL(5,2)) AS garage_m2,
         CAST(1 + c_custkey % 7 AS DECIMAL(5,2)) AS share,
         lpad(CAST(c_custkey AS VARCHAR), 22, '0') AS cbu
  FROM customer),
person AS (
  SELECT CAST(c_custkey AS BIGINT) AS id_person,
         upper(substr(c_mktsegment, 1, 1)) || lower(substr(c_mktsegment, 2)) AS first_name,
         c_name AS last_name, CAST(10000000 + c_custkey AS BIGINT) AS dni,
         CASE WHEN c_custkey % 5 = 0 THEN NULL ELSE lower(replace(c_name, '#', '.')) || '@mail.com' END AS email,
         CASE WHEN c_custkey % 7 = 0 THEN NULL ELSE '11' || lpad(CAST(c_custkey AS VARCHAR), 8, '0') END AS phone,
         CASE WHEN c_custkey % 4 = 0 THEN '9' || lpad(CAST(c_custkey AS VARCHAR), 21, '0')
              ELSE lpad(CAST(c_custkey AS VARCHAR), 22, '0') END AS cbu
  FROM customer),
occupancy AS (
  SELECT CAST(c_custkey AS BIGINT) AS id_person, CAST(c_nationkey AS BIGINT) AS id_building,
         c_custkey % 3 = 0 AS is_tenant
  FROM customer),
expense AS (
  SELECT CAST(o_orderkey AS BIGINT) AS id_expense, id_building * 1000000 + {ym('month_start')} AS id_bill,
         id_building,
         CASE WHEN o_orderpriority = '1-URGENT' THEN 'Extraordinario' ELSE 'Ordinario' END AS kind,
         o_orderpriority AS category, 'Proveedor ' || CAST(o_orderkey % 50 AS VARCHAR) AS supplier,
         'Orden ' || CAST(o_orderkey AS VARCHAR) AS description, order_date AS issue_date,
         CAST(o_totalprice AS DECIMAL(10,2)) AS amount
  FROM ob),
payment AS (
  SELECT concat_ws('-', l.l_orderkey, l.l_linenumber, l.l_partkey, l.l_suppkey,
                   row_number() OVER (PARTITION BY l.l_orderkey, l.l_linenumber, l.l_partkey, l.l_suppkey
                                      ORDER BY l.l_quantity, l.l_extendedprice, l.l_discount, l.l_tax, l.l_shipdate))
           AS id_payment,
         ob.id_unit * 1000000 + {ym('ob.month_start')} AS id_account, ob.id_unit, ob.id_building,
         ob.id_building * 1000000 + {ym('ob.month_start')} AS id_bill,
         CAST(ob.month_start + CAST((7 * l.l_orderkey + 5 * l.l_linenumber + l.l_partkey) % 50 AS INTEGER) AS DATE)
           AS pay_date,
         CAST(200 * l.l_quantity AS DECIMAL(10,2)) AS amount,
         lpad(CAST(ob.id_unit AS VARCHAR), 22, '0') AS cbu
  FROM lineitem l JOIN ob ON l.l_orderkey = ob.o_orderkey),
fx_quote AS (
  SELECT CAST(event_id AS BIGINT) AS id_quote, ts AS quote_ts,
         CASE user_id % 3 WHEN 0 THEN 'blue' WHEN 1 THEN 'oficial' ELSE 'tarjeta' END AS fx_type,
         CAST(value AS DECIMAL(10,2)) AS buy,
         CAST(round(CAST(value AS DECIMAL(10,2)) * 1.05, 2) AS DECIMAL(10,2)) AS sell
  FROM events WHERE event_type = 'purchase'),
exp_tot AS (
  SELECT id_bill,
         CAST(sum(CASE WHEN kind = 'Ordinario' THEN amount ELSE 0 END) AS DECIMAL(18,2)) AS tot_ord,
         CAST(sum(CASE WHEN kind = 'Extraordinario' THEN amount ELSE 0 END) AS DECIMAL(18,2)) AS tot_ext
  FROM expense GROUP BY id_bill),
share_sum AS (
  SELECT id_building, sum(CAST(share AS DECIMAL(18,6))) AS sum_share FROM unit GROUP BY id_building),
pay_tot AS (
  SELECT id_account, CAST(sum(amount) AS DECIMAL(18,2)) AS paid_sum, max(pay_date) AS last_pay
  FROM payment GROUP BY id_account)
"""


def ladder_sql(day: str, amount: str, strict: bool = False) -> str:
    if strict:
        on_time, late1, within2, late2 = f"{day} < due1", f"{day} >= due1", f"{day} < due2", f"{day} >= due2"
    else:
        on_time, late1, within2, late2 = f"{day} <= due1", f"{day} > due1", f"{day} <= due2", f"{day} > due2"
    return (f"CASE WHEN {on_time} THEN 0 "
            f"WHEN {late1} AND (due2 IS NULL OR {within2}) THEN round(0.02 * ({amount}), 2) "
            f"WHEN due2 IS NOT NULL AND {late2} THEN round(0.05 * ({amount}), 2) ELSE 0 END")


def interest_sql(rule: str, base: str = "base", paid: str = "paid_sum", last: str = "last_pay",
                 as_of: str = AS_OF) -> str:
    paid0 = f"coalesce({paid}, 0)"
    rem = f"({base} - {paid0})"
    if rule == "M1":
        e = (f"CASE WHEN {base} <= {paid0} THEN 0 WHEN {paid} IS NULL THEN {ladder_sql(as_of, base, True)} "
             f"ELSE {ladder_sql(last, rem)} END")
    elif rule == "M2":
        e = f"CASE WHEN {base} <= {paid0} OR {paid} IS NULL THEN 0 ELSE {ladder_sql(last, rem)} END"
    else:
        e = f"CASE WHEN {rem} <= 0 THEN 0 ELSE {ladder_sql(as_of, rem)} END"
    return f"CAST({e} AS DECIMAL(18,2))"


def accounts_sql(rule: str = "M1", bill_filter: str = "issue_date <> DATE '1900-01-01' AND coalesce(total, 0) <> 0") -> str:
    """J2 as CTEs ending in ``account``."""
    return f"""
fbill AS (SELECT * FROM bill WHERE {bill_filter}),
sk AS (
  SELECT u.id_unit * 1000000 + {ym('b.month_start')} AS id_account, u.id_unit, u.id_building, b.id_bill,
         b.issue_date, b.due1, b.due2, coalesce(b.due1, b.issue_date) AS acct_date,
         {prorate_sql('coalesce(t.tot_ord, 0)', 'u.share', 's.sum_share')} AS ord_amount,
         {prorate_sql('coalesce(t.tot_ext, 0)', 'u.share', 's.sum_share')} AS ext_amount
  FROM unit u JOIN fbill b ON b.id_building = u.id_building
  LEFT JOIN exp_tot t ON t.id_bill = b.id_bill
  LEFT JOIN share_sum s ON s.id_building = u.id_building),
acc1 AS (
  SELECT sk.*, p.paid_sum, p.last_pay, coalesce(ord_amount, 0) + coalesce(ext_amount, 0) AS base
  FROM sk LEFT JOIN pay_tot p ON p.id_account = sk.id_account),
acc2 AS (
  SELECT *, CAST(coalesce(paid_sum, 0) AS DECIMAL(18,2)) AS paid,
         CAST(CASE WHEN base <= coalesce(paid_sum, 0) THEN 0 ELSE base - coalesce(paid_sum, 0) END AS DECIMAL(18,2)) AS debt,
         {interest_sql(rule)} AS interest
  FROM acc1),
account AS (
  SELECT id_account, id_unit, id_building, id_bill, acct_date,
         CAST(coalesce(lag(coalesce(ord_amount, 0) + coalesce(ext_amount, 0) + coalesce(interest, 0) - coalesce(paid, 0))
              OVER (PARTITION BY id_building, id_unit ORDER BY issue_date, id_bill), 0) AS DECIMAL(18,2)) AS prev_balance,
         ord_amount, ext_amount, paid, debt, interest, CAST(debt + interest AS DECIMAL(18,2)) AS total_due
  FROM acc2)
"""


def with_ledger(*ctes: str, select: str) -> str:
    body = ",\n".join([LEDGER.strip()] + [c.strip() for c in ctes])
    return f"WITH {body}\n{select}"


PROPORTIONS = """
ec_tot AS (
  SELECT id_bill, sum(coalesce(ord_amount, 0)) AS ord_ec, sum(coalesce(ext_amount, 0)) AS ext_ec
  FROM account GROUP BY id_bill),
prop AS (
  SELECT b.id_bill, b.id_building, pr.p_ord, pr.p_ext FROM bill b LEFT JOIN (
    SELECT coalesce(g.id_bill, e.id_bill) AS id_bill,
           coalesce(nullif(g.tot_ord, 0), e.ord_ec, 0) AS p_ord,
           coalesce(nullif(g.tot_ext, 0), e.ext_ec, 0) AS p_ext
    FROM exp_tot g FULL JOIN ec_tot e ON e.id_bill = g.id_bill) pr ON pr.id_bill = b.id_bill)
"""


def pay_prop(date_from: str, date_to: str, building: str | None = None) -> str:
    bfilter = f" AND p.id_building = {building}" if building is not None else ""
    share = ("CASE WHEN coalesce(pr.p_ord, 0) + coalesce(pr.p_ext, 0) > 0 "
             "THEN CAST(pr.{0} AS DECIMAL(18,6)) / (pr.p_ord + pr.p_ext) ELSE 0.5 END")
    return f"""
pp AS (
  SELECT p.pay_date, p.amount, p.amount * {share.format('p_ord')} AS part_ord,
         p.amount * {share.format('p_ext')} AS part_ext
  FROM payment p JOIN prop pr ON pr.id_bill = p.id_bill
  WHERE p.pay_date >= {date_from} AND p.pay_date < {date_to} + 1{bfilter})
"""


def r3_sql(date_from: str = "DATE '2001-04-15'", date_to: str = AS_OF, building: str | None = None) -> str:
    return with_ledger(accounts_sql(), PROPORTIONS, pay_prop(date_from, date_to, building), f"""
wk AS (SELECT {week_sql('pay_date')} AS week_start, sum(part_ord) AS o, sum(part_ext) AS e,
              sum(amount) AS t FROM pp GROUP BY 1)""", select=f"""
SELECT week_start, CAST(o AS DECIMAL(18,2)) AS ordinary, CAST(e AS DECIMAL(18,2)) AS extraordinary,
       CAST(t AS DECIMAL(18,2)) AS total,
       {round_div_cents('sum(t) OVER ()', 'count(*) OVER ()')} AS weekly_avg,
       CAST(sum(t) OVER (ORDER BY week_start ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS DECIMAL(18,2))
         AS running_total
FROM wk""")


def div_money_sql(a: str, q: str) -> str:
    """round(a / q, 2) for two money values, exact."""
    A = f"CAST(({a}) * 100 AS HUGEINT)"
    Q = f"CAST(({q}) * 100 AS HUGEINT)"
    return (f"CAST(CAST(sign({A}) * ((2 * 100 * abs({A}) + {Q}) // (2 * {Q})) AS DECIMAL(38,0)) * 0.01 "
            f"AS DECIMAL(18,2))")


def r1_sql() -> str:
    return with_ledger("""
exp_out AS (SELECT id_bill, sum(amount) AS out_ FROM expense GROUP BY id_bill)""", """
pagg AS (
  SELECT p.id_bill,
         sum(CASE WHEN p.pay_date BETWEEN b.issue_date AND b.due1 THEN p.amount ELSE 0 END) AS on_time_,
         sum(CASE WHEN p.pay_date > b.due1 THEN p.amount ELSE 0 END) AS late_,
         sum(CASE WHEN p.pay_date < b.issue_date THEN p.amount ELSE 0 END) AS advance_,
         sum(p.amount) AS in_
  FROM payment p JOIN bill b ON b.id_bill = p.id_bill GROUP BY p.id_bill)""", """
m AS (
  SELECT b.id_bill, b.id_building, b.issue_date, b.total AS bill_total,
         CAST(coalesce(on_time_, 0) AS DECIMAL(18,2)) AS on_time, CAST(coalesce(late_, 0) AS DECIMAL(18,2)) AS late,
         CAST(coalesce(advance_, 0) AS DECIMAL(18,2)) AS advance, CAST(coalesce(in_, 0) AS DECIMAL(18,2)) AS total_in,
         CAST(coalesce(out_, 0) AS DECIMAL(18,2)) AS total_out
  FROM bill b LEFT JOIN exp_out e ON e.id_bill = b.id_bill LEFT JOIN pagg p ON p.id_bill = b.id_bill)""", """
m2 AS (
  SELECT *, CAST(sum(CAST(total_in - total_out AS DECIMAL(18,2))) OVER (PARTITION BY id_building
         ORDER BY issue_date, id_bill ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS DECIMAL(18,2)) AS closing
  FROM m)""", select="""
SELECT row_number() OVER (ORDER BY m2.id_building, issue_date, id_bill) AS row_id, m2.id_building,
       bd.name AS building_name, id_bill, issue_date, bill_total,
       CAST(coalesce(lag(closing) OVER (PARTITION BY m2.id_building ORDER BY issue_date, id_bill), 0) AS DECIMAL(18,2))
         AS previous,
       on_time, late, advance, total_in, total_out, closing
FROM m2 JOIN building bd ON bd.id_building = m2.id_building""")


def r4_sql(year: int = 2001) -> str:
    return with_ledger(select=f"""
SELECT strftime(period_date, '%Y-%m') AS period, department, CAST(sum(s) AS DECIMAL(18,2)) AS total_collected
FROM (SELECT CAST(date_trunc('month', b.issue_date) AS DATE) AS period_date,
             CAST(coalesce(u.floor, 0) AS VARCHAR) || coalesce(u.dept, '') AS department, p.amount AS s
      FROM payment p JOIN bill b ON b.id_bill = p.id_bill JOIN unit u ON u.id_unit = p.id_unit
      WHERE b.issue_date >= DATE '{year}-01-01' AND b.issue_date < DATE '{year + 1}-01-01')
GROUP BY period_date, department""")


def r5_sql(grouping: str = "MES", date_from: str = "DATE '2000-07-15'", date_to: str = AS_OF) -> str:
    if grouping == "TRIMESTRE":
        pd_ = "make_date(year(pay_date), 1 + 3 * (quarter(pay_date) - 1), 1)"
        label = ("CAST(year(period_date) AS VARCHAR) || '-T' || "
                 "CAST((month(period_date) - 1) // 3 + 1 AS VARCHAR)")
    else:
        pd_ = "CAST(date_trunc('month', pay_date) AS DATE)"
        label = "strftime(period_date, '%Y-%m')"
    return with_ledger(accounts_sql(), PROPORTIONS, pay_prop(date_from, date_to), f"""
g AS (SELECT {pd_} AS period_date, sum(part_ord) AS o, sum(part_ext) AS e FROM pp GROUP BY 1)""", select=f"""
SELECT {label} AS period, CAST(coalesce(o, 0) AS DECIMAL(18,2)) AS ordinary,
       CAST(coalesce(e, 0) AS DECIMAL(18,2)) AS extraordinary,
       CAST(coalesce(o, 0) + coalesce(e, 0) AS DECIMAL(18,2)) AS total,
       CAST(CASE WHEN o + e > 0 THEN o / (o + e) * 100 ELSE 0 END AS DECIMAL(5,2)) AS pct_ordinary,
       CAST(CASE WHEN o + e > 0 THEN e / (o + e) * 100 ELSE 0 END AS DECIMAL(5,2)) AS pct_extraordinary
FROM g""")


def r6_sql(fx: str = "blue", n: int = 5, year: int | None = None) -> str:
    def rng(c):
        return f"WHERE {c} >= DATE '{year}-01-01' AND {c} < DATE '{year + 1}-01-01'" if year else ""
    def top(kind, src):
        return f"""
SELECT '{kind}' AS movement, strftime(period_date, '%Y-%m') AS period, CAST(amt AS DECIMAL(18,2)) AS pesos,
       CASE WHEN coalesce(q.quote, 0) > 0 THEN {div_money_sql('amt', 'q.quote')} END AS dollars,
       '{fx}' AS fx_type, CAST(coalesce(q.quote, 0) AS DECIMAL(10,2)) AS quote_used
FROM (SELECT * FROM {src} ORDER BY amt DESC, period_date LIMIT {n}) t LEFT JOIN q ON TRUE"""
    return with_ledger(f"""
q AS (SELECT sell AS quote FROM (SELECT sell, row_number() OVER (ORDER BY quote_ts DESC) AS rn
                                 FROM fx_quote WHERE fx_type = '{fx}') WHERE rn = 1)""", f"""
em AS (SELECT CAST(date_trunc('month', issue_date) AS DATE) AS period_date, sum(amount) AS amt
       FROM expense {rng('issue_date')} GROUP BY 1)""", f"""
im AS (SELECT CAST(date_trunc('month', p.pay_date) AS DATE) AS period_date, sum(p.amount) AS amt
       FROM payment p JOIN bill b ON b.id_bill = p.id_bill {rng('p.pay_date')} GROUP BY 1)""",
                       select=top("GASTOS", "em") + "\nUNION ALL" + top("INGRESOS", "im"))


def risk_sql(d: str) -> str:
    return (f"CASE WHEN {d} > 180 THEN 'CRITICO' WHEN {d} > 90 THEN 'ALTO' WHEN {d} > 30 THEN 'MEDIO' "
            f"ELSE 'BAJO' END")


def r7_sql(n: int | None = 3, cut: str = AS_OF) -> str:
    lim = f"ORDER BY total_due DESC, days_late DESC, id_person LIMIT {n}" if n else ""
    return with_ledger(accounts_sql(), f"""
m AS (
  SELECT pe.id_person, a.id_building, count(DISTINCT a.id_bill) AS unpaid_bills,
         CAST(sum(a.debt) AS DECIMAL(18,2)) AS debt_total, CAST(sum(a.interest) AS DECIMAL(18,2)) AS interest_total,
         CAST(sum(a.total_due) AS DECIMAL(18,2)) AS total_due, max(b.due1) AS last_due
  FROM account a JOIN bill b ON b.id_bill = a.id_bill
  JOIN unit u ON u.id_unit = a.id_unit JOIN person pe ON pe.cbu = u.cbu
  JOIN (SELECT DISTINCT id_person, id_building FROM occupancy WHERE NOT is_tenant) o
    ON o.id_person = pe.id_person AND o.id_building = a.id_building
  WHERE a.debt > 0 AND b.due1 < {cut}
  GROUP BY pe.id_person, a.id_building)""", f"""
t AS (SELECT *, CAST(datediff('day', last_due, {cut}) AS BIGINT) AS days_late FROM m {lim})""", select=f"""
SELECT t.id_person, concat(pe.last_name, ', ', pe.first_name) AS full_name, pe.dni, pe.email, pe.phone,
       bd.name AS building_name, debt_total, interest_total, total_due, unpaid_bills, last_due, days_late,
       {risk_sql('days_late')} AS risk_level
FROM t JOIN person pe ON pe.id_person = t.id_person JOIN building bd ON bd.id_building = t.id_building""")


def r8_sql(date_from: str = "DATE '2000-07-15'", date_to: str = AS_OF) -> str:
    return with_ledger(f"""
pu AS (SELECT p.id_payment, p.id_unit, p.pay_date, p.amount, u.id_building, u.floor, u.dept
       FROM payment p JOIN unit u ON u.id_unit = p.id_unit
       WHERE p.pay_date >= {date_from} AND p.pay_date < {date_to} + 1)""", """
l AS (SELECT *, lag(pay_date) OVER (PARTITION BY id_unit ORDER BY pay_date, id_payment) AS prev_date FROM pu)""",
                       select="""
SELECT bd.name AS building_name, id_payment,
       'UF-' || CAST(id_unit AS VARCHAR) || ' (Piso ' || CAST(coalesce(floor, 0) AS VARCHAR) || coalesce(dept, '') || ')'
         AS unit_label,
       pay_date, prev_date, CAST(datediff('day', prev_date, pay_date) AS BIGINT) AS days_between, amount
FROM l JOIN building bd ON bd.id_building = l.id_building WHERE prev_date IS NOT NULL""")


def r9_sql(year: int = 2000, m1: int = 1, m2: int = 12) -> str:
    lo = f"DATE '{year}-{m1:02d}-01'"
    hi = f"(DATE '{year}-{m2:02d}-01' + INTERVAL 1 MONTH)"
    return with_ledger(f"""
mb AS (SELECT DISTINCT id_building, CAST(date_trunc('month', issue_date) AS DATE) AS m_start FROM bill
       WHERE issue_date >= {lo} AND issue_date < {hi})""", """
inc AS (
  SELECT m.id_building, m.m_start,
         sum(CASE WHEN b.issue_date >= m.m_start AND b.issue_date <= last_day(m.m_start) THEN p.amount ELSE 0 END) AS same_,
         sum(CASE WHEN b.issue_date < m.m_start THEN p.amount ELSE 0 END) AS owed_,
         sum(CASE WHEN b.issue_date > last_day(m.m_start) THEN p.amount ELSE 0 END) AS ahead_,
         sum(p.amount) AS in_
  FROM mb m JOIN payment p ON p.id_building = m.id_building AND p.pay_date BETWEEN m.m_start AND last_day(m.m_start)
  LEFT JOIN bill b ON b.id_bill = p.id_bill GROUP BY 1, 2)""", """
outm AS (
  SELECT m.id_building, m.m_start, sum(e.amount) AS out_
  FROM mb m JOIN expense e ON e.id_building = m.id_building AND e.issue_date BETWEEN m.m_start AND last_day(m.m_start)
  GROUP BY 1, 2)""", """
c AS (
  SELECT m.id_building, m.m_start, CAST(coalesce(same_, 0) AS DECIMAL(18,2)) AS income_on_time,
         CAST(coalesce(owed_, 0) AS DECIMAL(18,2)) AS income_owed, CAST(coalesce(ahead_, 0) AS DECIMAL(18,2)) AS income_ahead,
         CAST(coalesce(in_, 0) AS DECIMAL(18,2)) AS in_, CAST(coalesce(out_, 0) AS DECIMAL(18,2)) AS expenses
  FROM mb m LEFT JOIN inc i ON i.id_building = m.id_building AND i.m_start = m.m_start
  LEFT JOIN outm o ON o.id_building = m.id_building AND o.m_start = m.m_start)""", """
c2 AS (SELECT *, CAST(sum(in_ - expenses) OVER (PARTITION BY id_building ORDER BY m_start) AS DECIMAL(18,2)) AS closing
       FROM c)""", select="""
SELECT c2.id_building, bd.name AS building_name, CAST(year(m_start) AS BIGINT) AS year,
       CAST(month(m_start) AS BIGINT) AS month,
       CAST(coalesce(lag(closing) OVER (PARTITION BY c2.id_building ORDER BY m_start), 0) AS DECIMAL(18,2)) AS previous,
       income_on_time, income_owed, income_ahead, expenses, closing
FROM c2 JOIN building bd ON bd.id_building = c2.id_building""")


def r10_sql() -> str:
    return with_ledger(accounts_sql(), select="""
SELECT a.id_building, bd.name AS building_name, a.id_bill, b.issue_date, a.id_unit, u.share, u.floor, u.dept,
       CASE WHEN coalesce(u.garage_m2, 0) > 0 THEN 1 ELSE 0 END AS has_garage,
       CASE WHEN coalesce(u.storage_m2, 0) > 0 THEN 1 ELSE 0 END AS has_storage,
       coalesce(pe.last_name || ', ' || pe.first_name, pe.first_name, pe.last_name) AS owner,
       a.prev_balance, a.paid, a.debt, a.interest, a.ord_amount, a.ext_amount, a.total_due
FROM account a JOIN bill b ON b.id_bill = a.id_bill JOIN unit u ON u.id_unit = a.id_unit
LEFT JOIN person pe ON pe.cbu = u.cbu JOIN building bd ON bd.id_building = a.id_building""")


def r12_sql(now: str = "TIMESTAMP '2024-02-01 00:00:00'") -> str:
    return with_ledger(select=f"""
SELECT fx_type, buy, sell, quote_ts,
       CAST(epoch_us({now}) // 60000000 - epoch_us(quote_ts) // 60000000 AS BIGINT) AS minutes_since
FROM fx_quote""")


def j2_sql(rule: str = "M1") -> str:
    return with_ledger(accounts_sql(rule), select="SELECT * FROM account")


def j3_sql() -> str:
    return with_ledger(accounts_sql(), select="""
SELECT id_account, id_unit, id_bill, ord_amount, ext_amount FROM sk""")


def j4_sql(rule: str = "M2") -> str:
    return with_ledger(accounts_sql(), f"""
r AS (
  SELECT a.id_account, a.id_unit, a.id_building, a.id_bill, a.acct_date, a.prev_balance, a.ord_amount, a.ext_amount,
         b.due1, b.due2, p.paid_sum, p.last_pay, coalesce(a.ord_amount, 0) + coalesce(a.ext_amount, 0) AS base
  FROM account a JOIN bill b ON b.id_bill = a.id_bill LEFT JOIN pay_tot p ON p.id_account = a.id_account)""",
                       select=f"""
SELECT id_account, id_unit, id_building, id_bill, acct_date, prev_balance, ord_amount, ext_amount,
       CAST(coalesce(paid_sum, 0) AS DECIMAL(18,2)) AS paid,
       CAST(CASE WHEN base <= coalesce(paid_sum, 0) THEN 0 ELSE base - coalesce(paid_sum, 0) END AS DECIMAL(18,2)) AS debt,
       {interest_sql(rule)} AS interest,
       CAST(CAST(CASE WHEN base <= coalesce(paid_sum, 0) THEN 0 ELSE base - coalesce(paid_sum, 0) END AS DECIMAL(18,2))
            + {interest_sql(rule)} AS DECIMAL(18,2)) AS total_due
FROM r""")
