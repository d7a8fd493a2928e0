"""The registered queries again, as plain SQL over the source tables.

Written from the meaning of each operator, not from the Spark plans: other
formulas, window functions and unions where Spark uses single passes.
"""

AS_OF = "DATE '2001-08-01'"


def _values(rows: list[tuple]) -> str:
    def lit(v):
        return "NULL" if v is None else f"'{v}'" if isinstance(v, str) else str(v)

    return "(VALUES " + ", ".join("(" + ", ".join(lit(v) for v in r) + ")" for r in rows) + ")"


# --- reports -------------------------------------------------------------------------

MODALITY = """CASE WHEN p_size % 10 = 3 AND printf('%04d', l_partkey) = '0008' THEN 'Modality 3 special'
    WHEN p_size % 10 BETWEEN 1 AND 9 THEN 'Modality ' || (p_size % 10) ELSE 'Outros' END"""

ROWS = f"""clean AS (
  SELECT r_name AS branch,
    CASE l_returnflag WHEN 'R' THEN 'cancelled' ELSE 'reactivated' END AS kind,
    CASE WHEN l_suppkey % 11 <> 0 THEN trim(s_name) END AS seller,
    CASE WHEN c_custkey % 53 <> 0 THEN greatest(c_custkey % 97 - 5, 0) END AS age,
    CASE WHEN l_linenumber = 6 THEN 0.0::DOUBLE
      ELSE date_diff('month', o_orderdate::DATE, {AS_OF})::DOUBLE END AS tenure,
    CASE WHEN l_linenumber = 7 THEN NULL
      WHEN l_linenumber = 5 AND l_quantity < 5 THEN -l_extendedprice ELSE l_extendedprice END AS value,
    CASE WHEN l_quantity <> 1 THEN o_orderpriority END AS reason,
    {MODALITY} AS plan,
    c_mktsegment AS plan_class,
    nullif(o_orderstatus, 'P') AS payment_type
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
  LEFT JOIN nation ON c_nationkey = n_nationkey LEFT JOIN region ON n_regionkey = r_regionkey
  LEFT JOIN part ON l_partkey = p_partkey LEFT JOIN supplier ON l_suppkey = s_suppkey
  WHERE l_returnflag IN ('R', 'A'))"""

AGE_BANDS = [(i, f"{i * 10 - 10} a {i * 10 - 1}", i * 10 - 10, i * 10) for i in range(1, 8)] + [(8, "70+", 70, 1e9)]
TENURE_BANDS = [
    (1, "1 a 6 meses", 0, 7),
    (2, "6 a 12 meses", 7, 13),
    (3, "1 a 2 anos", 13, 25),
    (4, "2+", 25, 1e9),
]

PCT = "round_even(qty::DOUBLE / nullif(whole, 0)::DOUBLE * 100.0 * 10.0, 0) / 10.0"


def _share_columns(source: str) -> str:
    return f"""SELECT branch, kind, section, ord, label, qty, pct, pct::VARCHAR || '%' AS pct_text,
    CASE WHEN NOT is_total AND pct <> 0 THEN least(pct, 100.0) END AS bar, is_total FROM ({source})"""


def _banded(name: str, column: str, bands: list[tuple], where: str) -> str:
    counted = f"""SELECT g.branch, g.kind, b.ord, b.label, count(c.branch) AS qty
    FROM (SELECT DISTINCT branch, kind FROM clean WHERE {where}) g
    CROSS JOIN {_values(bands)} b(ord, label, lo, hi)
    LEFT JOIN clean c ON c.branch IS NOT DISTINCT FROM g.branch AND c.kind = g.kind AND c.{column} >= b.lo AND c.{column} < b.hi
    GROUP BY ALL"""
    return _with_total(name, counted, len(bands))


def _with_total(name: str, counted: str, last: int | str) -> str:
    with_whole = f"SELECT *, sum(qty) OVER (PARTITION BY branch, kind) AS whole FROM ({counted})"
    return _share_columns(
        f"""SELECT branch, kind, '{name}' AS section, ord::INTEGER AS ord, label, qty, {PCT} AS pct, FALSE AS is_total
    FROM ({with_whole})
    UNION ALL
    SELECT branch, kind, '{name}', (max(ord) + 1)::INTEGER, ' TOTAL GERAL', sum(qty)::BIGINT, 100.0::DOUBLE, TRUE
    FROM ({counted}) GROUP BY branch, kind"""
    )


def _labelled(name: str, column: str, where: str, total: bool) -> str:
    order = "label" if total else "qty DESC, label"
    counted = f"""SELECT branch, kind, label, qty,
      row_number() OVER (PARTITION BY branch, kind ORDER BY {order}) AS ord
    FROM (SELECT branch, kind, {column} AS label, count(*) AS qty FROM clean
      WHERE {column} IS NOT NULL AND {where} GROUP BY ALL)"""
    if total:
        return _with_total(name, counted, "max")
    return _share_columns(
        f"""SELECT branch, kind, '{name}' AS section, ord::INTEGER AS ord, label, qty, {PCT} AS pct, FALSE AS is_total
    FROM (SELECT *, sum(qty) OVER (PARTITION BY branch, kind) AS whole FROM ({counted}))"""
    )


def _sellers(where: str) -> str:
    return _share_columns(
        f"""SELECT branch, kind, 'sellers' AS section, ord::INTEGER AS ord, label, qty, {PCT} AS pct, FALSE AS is_total
    FROM (SELECT *, row_number() OVER (PARTITION BY branch, kind ORDER BY qty DESC, label) AS ord
      FROM (SELECT *, sum(qty) OVER (PARTITION BY branch, kind) AS whole
        FROM (SELECT branch, kind, seller AS label, count(*) AS qty FROM clean WHERE {where} GROUP BY ALL))
      WHERE label IS NOT NULL)
    WHERE ord <= 10"""
    )


def _section(name: str, where: str) -> str:
    match name:
        case "age":
            return _banded("age", "age", AGE_BANDS, where)
        case "tenure":
            return _banded("tenure", "tenure", TENURE_BANDS, where)
        case "sellers":
            return _sellers(where)
        case "reason":
            return _labelled("reason", "reason", where, True)
        case "class":
            return _labelled("class", "plan_class", where, False)
        case "payment":
            return _labelled("payment", "payment_type", where, False)
        case "plan":
            return _labelled("plan", "plan", where, False)


TWO = "round_even(({0}) * 100.0, 0) / 100.0"

STATS = f"""SELECT branch, kind, ord, label, amount, printf('R$ %.2f', {TWO.format('amount')}) AS amount_text FROM (
  SELECT branch, kind, unnest([1, 2, 3, 4, 5]) AS ord,
    unnest(['Valor Médio', 'Valor Mediano', 'Valor Mínimo', 'Valor Máximo',
      CASE kind WHEN 'cancelled' THEN 'Receita Perdida (Mensal)' ELSE 'Receita Resgatada (Mensal)' END]) AS label,
    unnest([total / n, median, lowest, highest, total]) AS amount
  FROM (
    SELECT branch, kind, count(*) AS n, sum(value::DECIMAL(18, 6))::DOUBLE AS total, min(value) AS lowest,
      max(value) AS highest,
      (max(value) FILTER (pos = (cnt + 1) // 2) + max(value) FILTER (pos = cnt // 2 + 1)) / 2 AS median
    FROM (SELECT *, row_number() OVER (PARTITION BY branch, kind ORDER BY value) AS pos,
        count(*) OVER (PARTITION BY branch, kind) AS cnt FROM clean WHERE value > 0)
    GROUP BY branch, kind))"""

# Values counted in cells whose ends are 1.01 / 0.99 apart; a cell stands for its middle.
SKETCHED = f"""WITH {ROWS.replace("FROM lineitem JOIN", ", o_orderdate::DATE AS day FROM lineitem JOIN", 1)},
  cells AS (SELECT branch, kind, floor(ln(value) / ln(1.01 / 0.99)) AS cell, count(*) AS n, sum(value::DECIMAL(18, 6)) AS total,
      min(value) AS lowest, max(value) AS highest
    FROM clean WHERE value > 0 AND day BETWEEN DATE '1996-01-01' AND DATE '2000-12-31' GROUP BY ALL),
  placed AS (SELECT *, sum(n) OVER (PARTITION BY branch, kind ORDER BY cell) AS upto, sum(n) OVER (PARTITION BY branch, kind) AS whole,
      least(greatest(pow(1.01 / 0.99, cell) * 1.01, lowest), highest) AS middle FROM cells),
  stats AS (SELECT branch, kind, sum(n) AS n, sum(total)::DOUBLE AS total, min(lowest) AS lowest, max(highest) AS highest,
      (max(middle) FILTER (upto - n < (whole + 1) // 2 AND (whole + 1) // 2 <= upto)
        + max(middle) FILTER (upto - n < whole // 2 + 1 AND whole // 2 + 1 <= upto)) / 2 AS median
    FROM placed GROUP BY branch, kind)
  SELECT branch, kind, ord, label, round_even(amount * 1000000.0, 0) / 1000000.0 AS amount,
    printf('R$ %.2f', {TWO.format('amount')}) AS amount_text FROM (
  SELECT branch, kind, unnest([1, 2, 3, 4, 5]) AS ord,
    unnest(['Valor Médio', 'Valor Mediano', 'Valor Mínimo', 'Valor Máximo',
      CASE kind WHEN 'cancelled' THEN 'Receita Perdida (Mensal)' ELSE 'Receita Resgatada (Mensal)' END]) AS label,
    unnest([total / n, median, lowest, highest, total]) AS amount FROM stats)"""

KPIS = f"""SELECT branch, kind, qty, mean_age, mean_years, revenue,
    replace(format('{{:,}}', qty), ',', '.') AS qty_text,
    printf('%.0f', round_even(mean_age, 0)) || ' anos' AS age_text,
    printf('%.0f', round_even(mean_years, 0)) || ' anos' AS years_text,
    'R$ ' || translate(format('{{:,.2f}}', {TWO.format('coalesce(revenue, 0.0)')}), ',.', '.,') AS revenue_text
  FROM (SELECT branch, kind, count(*) AS qty, sum(age)::DOUBLE / count(age) AS mean_age,
      sum(tenure::DECIMAL(18, 6))::DOUBLE / count(*) / 12 AS mean_years,
      sum(value::DECIMAL(18, 6))::DOUBLE AS revenue
    FROM clean GROUP BY branch, kind)"""

CANCELLED = "kind = 'cancelled'"


def _report() -> str:
    columns = "branch, kind, section, ord, label, qty, pct, pct_text, bar, NULL::DOUBLE AS amount, NULL AS amount_text, is_total"
    both, mine = "TRUE", CANCELLED
    parts = [
        f"SELECT {columns} FROM ({_section(n, w)})"
        for n, w in (("age", both), ("tenure", both), ("sellers", both), ("plan", both), ("payment", both), ("reason", mine))
    ]
    parts.append(f"SELECT {columns} FROM ({_section('class', mine)}) WHERE branch IS DISTINCT FROM 'AFRICA'")
    empty = "NULL::BIGINT AS qty, NULL::DOUBLE AS pct, NULL AS pct_text, NULL::DOUBLE AS bar"
    parts.append(f"SELECT branch, kind, 'value' AS section, ord, label, {empty}, amount, amount_text, FALSE FROM ({STATS})")
    parts.append(
        f"""SELECT branch, kind, 'kpi', unnest([1, 2, 3, 4]), unnest([
        CASE kind WHEN 'cancelled' THEN 'Total de Cancelamentos' ELSE 'Total de Reativados' END, 'Idade Média',
        'Tempo Médio', CASE kind WHEN 'cancelled' THEN 'Receita Perdida' ELSE 'Receita Resgatada' END]),
        NULL, NULL, NULL, NULL, unnest([qty::DOUBLE, mean_age, mean_years, revenue]),
        unnest([qty_text, age_text, years_text, revenue_text]), FALSE FROM ({KPIS})"""
    )
    return f"WITH {ROWS} " + " UNION ALL ".join(parts)


def report_queries() -> dict[str, str]:
    def of(name: str) -> str:
        return f"WITH {ROWS} SELECT * FROM ({_section(name, CANCELLED)}) WHERE {CANCELLED}"

    return {
        "cancel_by_age_band": of("age"),
        "cancel_by_tenure_band": of("tenure"),
        "cancel_by_class": of("class"),
        "cancel_by_reason": of("reason"),
        "cancel_by_plan": of("plan"),
        "cancel_by_payment": of("payment"),
        "top_sellers": f"WITH {ROWS} {_section('sellers', 'TRUE')}",
        "band_totals": f"WITH {ROWS} SELECT branch, kind, section, ord, label, qty, is_total FROM ({_section('tenure', 'TRUE')})",
        "value_stats": f"WITH {ROWS} {STATS}",
        "value_stats_by_sketch": SKETCHED,
        "branch_part": f"WITH {ROWS} SELECT * FROM ({KPIS}) WHERE branch = 'ASIA'",
        "report_rerun": f"""WITH {ROWS} SELECT * FROM ({_section('payment', CANCELLED)}) WHERE {CANCELLED}
          UNION ALL SELECT * FROM ({_section('tenure', 'TRUE')}) WHERE kind = 'reactivated'""",
        "report_kpis": f"WITH {ROWS} {KPIS}",
        "cancellation_report": f"SELECT * FROM ({_report()}) WHERE kind = 'cancelled'",
        "reactivation_report": f"SELECT * FROM ({_report()}) WHERE kind = 'reactivated'",
        "branch_report": _report(),
        "report_parts": f"SELECT * FROM ({_report()}) WHERE section = 'kpi'",
        "sheet_columns": "SELECT s_suppkey::VARCHAR AS s_suppkey, s_name FROM supplier",
    }


# --- contract tables -----------------------------------------------------------------

FAMILY = """'0001' AS org, printf('%04d', {k} // 3 % 25 % 8) AS company, printf('%06d', {k} // 3) AS family"""
YMD = "printf('%02d', c_custkey % 12 + 1) || printf('%02d', c_custkey % 28 + 1)"


def _date(text: str, strict: bool) -> str:
    parsed = f"try_strptime(nullif(rtrim({text}), ''), '%Y%m%d')::DATE"
    return f"coalesce({parsed}, DATE '1900-01-01')" if strict else parsed


MEMBERS = f"""members AS (
  SELECT {FAMILY.format(k='c_custkey')}, printf('%02d', c_custkey % 3) AS member_type,
    printf('%09d', c_custkey) AS card_no, c_name AS name, printf('%011d', c_custkey * 7) AS tax_id,
    '9' || printf('%08d', c_custkey) AS phone, 'Street ' || (c_custkey % 100) AS street,
    'District ' || (c_custkey % 10) AS district, printf('%04d', c_custkey % 200) AS plan_code,
    printf('%06d', c_custkey % 120) AS seller_code, printf('%04d', c_custkey // 3 % 25) AS contract_no,
    CASE WHEN c_custkey // 3 % 7 = 0 THEN 9 ELSE c_custkey // 3 % 25 % 3 END AS subcontract,
    CASE c_custkey % 9 WHEN 5 THEN 'IND' WHEN 6 THEN 'PRE' WHEN 7 THEN 'VER' WHEN 8 THEN 'ZZZ'
      ELSE (c_custkey % 9 + 1)::VARCHAR END AS class_code,
    CASE WHEN c_custkey % 41 = 0 THEN '        ' ELSE (c_custkey % 80 + 1930) || {YMD} END AS birth,
    (c_custkey % 11 + 1990) || {YMD} AS joined,
    CASE WHEN c_custkey % 3 = 0 THEN '        ' WHEN c_custkey % 5 = 0 THEN '19000101'
      ELSE (c_custkey % 4 + 1998) || {YMD} END AS blocked,
    c_custkey % 29 = 28 AS gone, c_custkey AS k
  FROM customer)"""

EVENTS = f"""events_ok AS (
  SELECT {FAMILY.format(k='o_custkey')}, printf('%02d', o_custkey % 3) AS member_type, o_orderkey AS row_id,
    strftime(o_orderdate, '%Y%m%d') AS event_date, o_orderdate::DATE AS event_day,
    printf('%03d', o_orderkey % 27) AS reason_code, 'U' || (o_orderkey % 9) AS "user"
  FROM orders WHERE o_orderstatus <> 'F' AND o_orderkey % 31 <> 30)"""

LATEST = """latest AS (
  SELECT * FROM events_ok WHERE event_day BETWEEN DATE '1995-01-01' AND DATE '2001-08-01'
  QUALIFY row_number() OVER (PARTITION BY org, company, family, member_type ORDER BY row_id DESC) = 1)"""

# Cycles from the 26th to the 25th, named by the month of their end.
MONTH_NAMES = "['Jan','Fev','Mar','Abr','Mai','Jun','Jul','Ago','Set','Out','Nov','Dez']"
CYCLES = f"""cycles AS (
  SELECT i + 1 AS period_ord, (DATE '1994-12-26' + to_months(i::INTEGER))::DATE AS first_day,
    (DATE '1995-01-25' + to_months(i::INTEGER))::DATE AS last_day,
    {MONTH_NAMES}[month((DATE '1995-01-25' + to_months(i::INTEGER))::DATE)] || '-' ||
      year((DATE '1995-01-25' + to_months(i::INTEGER))::DATE) AS period
  FROM range(80) r(i))"""
SEMESTERS = """semesters AS (
  SELECT row_number() OVER (ORDER BY min(first_day)) AS period_ord, min(first_day) AS first_day,
    max(last_day) AS last_day, 'S' || CASE WHEN month(last_day) <= 6 THEN 1 ELSE 2 END || '-' || year(last_day) AS period
  FROM cycles GROUP BY CASE WHEN month(last_day) <= 6 THEN 1 ELSE 2 END, year(last_day))"""


def _latest_by(periods: str) -> str:
    return f"""latest AS (
  SELECT period_ord::INTEGER AS period_ord, period, e.* FROM events_ok e JOIN {periods} p
    ON e.event_day BETWEEN p.first_day AND p.last_day
  QUALIFY row_number() OVER (PARTITION BY period_ord, org, company, family, member_type ORDER BY row_id DESC) = 1)"""


CLASS_A = """CASE class_code WHEN 'IND' THEN 'Individual' WHEN 'PRE' THEN 'Premium' WHEN 'VER' THEN 'VIP'
    WHEN 'ZZZ' THEN 'ZZZ' ELSE class_code || ' - Classe ' || class_code END"""
CLASS_B = """CASE class_code WHEN 'IND' THEN '   ' WHEN 'PRE' THEN '* P' WHEN 'VER' THEN '* V'
    WHEN 'ZZZ' THEN 'ZZZ' ELSE class_code || ' *' END"""

REVERSIBLE = "(" + ", ".join(f"'NATION_{n}'" for n in (1, 3, 4, 7, 9, 12, 18, 22)) + ")"


def _churn_base(extra: str = "") -> str:
    return f"""base AS (
  SELECT {extra} date_diff('month', {_date('m.joined', True)}, l.event_day) AS months,
    date_diff('year', {_date('m.birth', True)}, {AS_OF}) AS age, class_code
  FROM members m JOIN latest l USING (org, company, family, member_type)
  JOIN part ON printf('%04d', p_partkey) = m.plan_code
  JOIN nation ON printf('%03d', n_nationkey) = l.reason_code
  WHERE NOT m.gone AND m.company <> '0003' AND p_size % 10 IN (1, 2) AND p_partkey % 37 <> 36
    AND n_name IN {REVERSIBLE})"""


TENURE_CLASS = """CASE WHEN months <= 6 THEN '1. Até 6 meses' WHEN months <= 12 THEN '2. 7 meses a 1 ano'
    WHEN months <= 24 THEN '3. 13 meses a 2 anos' WHEN months <= 60 THEN '4. 2 anos e 1 mês a 5 anos'
    WHEN months <= 120 THEN '5. 5 anos e 1 mês a 10 anos' WHEN months <= 240 THEN '6. 10 anos 1 mês a 20 anos'
    ELSE '7. Acima de 20 anos' END"""
AGE_CLASS = """CASE WHEN age BETWEEN 0 AND 69 THEN
      printf('%02d', age // 10 + 1) || '. ' || (age // 10 * 10) || ' a ' || (age // 10 * 10 + 9) || ' anos'
    ELSE '08. 70 anos ou mais' END"""


def _rollup(report: str, label: str, by: str = "") -> str:
    return f"""SELECT {by} '{report}' AS report, CASE WHEN grouping(label) = 1 THEN 'TOTAL' ELSE label END AS label,
    grouping(label) = 1 AS is_total, count(*) AS qty
  FROM (SELECT {by} {label} AS label FROM base) GROUP BY {'GROUPING SETS ((' + by + 'label), (' + by.rstrip(', ') + '))' if by else 'ROLLUP (label)'}"""


def churn_queries() -> dict[str, str]:
    base = f"WITH {MEMBERS}, {EVENTS}, {LATEST}, {_churn_base()} "
    by_class = {"tenure": TENURE_CLASS, "age": AGE_CLASS, "class": CLASS_A}
    keys = "org, company, family, member_type, row_id, event_date, reason_code, \"user\""
    periods = f"{CYCLES}, {SEMESTERS}, {EVENTS}"
    series = f"WITH {MEMBERS}, {periods}, "
    by = "period_ord, period, "
    return {
        "latest_block": f"WITH {EVENTS}, {LATEST} SELECT {keys} FROM latest",
        "latest_block_by_cycle": f"WITH {periods}, {_latest_by('cycles')} SELECT period_ord, period, {keys} FROM latest",
        "churn_by_tenure": base + _rollup("tenure", TENURE_CLASS),
        "churn_by_age": base + _rollup("age", AGE_CLASS),
        "churn_by_class": base + _rollup("class", CLASS_A),
        "churn_all": base + " UNION ALL ".join(_rollup(n, c) for n, c in by_class.items()),
        "churn_series_month": f"{series} {_latest_by('cycles')}, {_churn_base(by)} " + _rollup("tenure", TENURE_CLASS, by),
        "churn_series_semester": f"{series} {_latest_by('semesters')}, {_churn_base(by)} "
        + _rollup("tenure", TENURE_CLASS, by),
    }


# --- detail extract ------------------------------------------------------------------

PRICES = f"""prices AS (
  SELECT {FAMILY.format(k='c_custkey')}, printf('%02d', c_custkey % 3) AS member_type, lo, hi,
    (c_custkey % 100 + 50 + i * 10)::DOUBLE AS price
  FROM customer JOIN (VALUES (0, 39, 0), (40, 200, 1), (60, 200, 2)) r(lo, hi, i) ON i < 2 OR c_custkey % 10 = 0
  WHERE c_custkey % 43 <> 42)"""
OCCURRENCES = f"""occurrences AS (
  SELECT 'C' || printf('%06d', o_custkey // 3) AS customer, {FAMILY.format(k='o_custkey')}, o_orderpriority AS occurrence
  FROM orders WHERE o_orderdate::DATE < {AS_OF} AND o_orderkey % 17 <> 16
  QUALIFY row_number() OVER (PARTITION BY o_custkey // 3 ORDER BY o_orderdate DESC, o_orderkey DESC) = 1)"""


def _detail(strict: bool) -> str:
    company = "m.company <> '0003' AND p_size % 10 IN (1, 2)" if strict else "m.company IN ('0001', '0002', '0003', '0006', '0007')"
    plan = "TRUE" if strict else "k // 3 % 100 NOT IN (83, 94, 95, 96)"
    until = f"coalesce(nullif({_date('blocked', False)}, DATE '1900-01-01'), {AS_OF})"
    return f"""WITH {MEMBERS}, {EVENTS}, {LATEST}, {PRICES}, {OCCURRENCES},
  attendance AS (SELECT printf('%09d', user_id) AS card_no, count(*) AS n FROM events GROUP BY user_id),
  people AS (
    SELECT m.*, {_date('m.birth', strict)} AS born, {_date('m.joined', strict)} AS since, {until} AS until_day,
      l.event_day, l.reason_code, l."user", p_size, p_partkey
    FROM members m JOIN latest l USING (org, company, family, member_type)
    JOIN part ON printf('%04d', p_partkey) = m.plan_code AND p_partkey % 37 <> 36
    WHERE NOT gone AND {company} AND {plan} AND k // 3 % 29 <> 28),
  joined_rows AS (
    SELECT DISTINCT people.card_no,
      CASE WHEN k // 3 % 2 = 0 THEN 'C' || printf('%06d', k // 3)
        WHEN sub.n_nationkey % 2 = 0 THEN 'C' || printf('%06d', sub.n_nationkey)
        WHEN con.n_nationkey % 3 = 0 THEN 'C' || printf('%06d', con.n_nationkey + 100) END AS customer_code,
      name AS member_name, tax_id, street, district, why.n_name AS reason,
      CASE WHEN con.n_nationkey % 3 = 0 THEN 'Contract ' || con.n_name ELSE sub.n_name END AS contract_description,
      rpad(s_name, 25, ' ') AS seller_name, strftime(born, '%Y-%m-%d') AS birth, attendance.n AS attendances,
      date_diff('month', since, until_day)::INTEGER AS tenure_months, phone AS member_phone,
      date_diff('year', born, until_day)::INTEGER AS age, "user" AS blocked_by,
      strftime(since, '%Y-%m-%d') AS joined, strftime(event_day, '%Y-%m-%d') AS blocked_on,
      CASE WHEN p_size % 10 = 3 AND p_partkey = 8 THEN 'Modality 3 special'
        WHEN p_size % 10 > 0 THEN 'Modality ' || (p_size % 10) ELSE 'Outros' END AS plan,
      {CLASS_A if strict else CLASS_B} AS plan_class, price AS monthly_value, pay.r_name AS payment_type,
      occurrence AS last_occurrence
    FROM people
    JOIN supplier ON printf('%06d', s_suppkey) = seller_code AND s_suppkey % 13 <> 12
    JOIN nation why ON printf('%03d', why.n_nationkey) = reason_code
    LEFT JOIN nation sub ON printf('%04d', sub.n_nationkey) = contract_no AND sub.n_nationkey % 3 = subcontract
    LEFT JOIN nation con ON printf('%04d', con.n_nationkey) = contract_no AND con.n_nationkey % 4 <> 3
    LEFT JOIN attendance ON attendance.card_no = people.card_no
    LEFT JOIN region pay ON pay.r_regionkey = k // 3 % 7
    LEFT JOIN prices ON prices.org = people.org AND prices.company = people.company
      AND prices.family = people.family AND prices.member_type = people.member_type
      AND date_diff('year', born, {AS_OF}) BETWEEN lo AND hi
    LEFT JOIN occurrences ON occurrences.customer = 'C' || printf('%06d', k // 3) AND occurrences.family = people.family)
  SELECT j.*, '71-' || f AS customer_phone
  FROM joined_rows j LEFT JOIN (SELECT DISTINCT c_custkey // 3 AS f FROM customer) billed
    ON f % 23 <> 22 AND 'C' || printf('%06d', f) = customer_code"""


def detail_queries() -> dict[str, str]:
    born, until = _date("birth", False), f"coalesce(nullif({_date('blocked', False)}, DATE '1900-01-01'), {AS_OF})"
    return {
        "cancel_detail_a": _detail(True),
        "cancel_detail_b": _detail(False),
        "price_by_age": f"""WITH {MEMBERS}, {PRICES}
  SELECT card_no, strftime(born, '%Y-%m-%d') AS birth_date, price AS monthly_value
  FROM (SELECT *, {born} AS born FROM members) m LEFT JOIN prices p ON m.org = p.org AND m.company = p.company
    AND m.family = p.family AND m.member_type = p.member_type AND date_diff('year', born, {AS_OF}) BETWEEN lo AND hi""",
        "last_occurrence": f"WITH {OCCURRENCES} SELECT customer, org, company, family, occurrence FROM occurrences",
        "date_scalars": f"""WITH {MEMBERS}, d AS (
    SELECT card_no, {born} AS born, {_date('joined', True)} AS joined, {until} AS until FROM members)
  SELECT card_no, strftime(born, '%Y-%m-%d') AS born, strftime(joined, '%Y-%m-%d') AS joined,
    strftime(until, '%Y-%m-%d') AS until, date_diff('month', joined, until)::INTEGER AS months,
    date_diff('year', born, until)::INTEGER AS years,
    strftime(CASE WHEN day(joined) >= 26 THEN date_trunc('month', joined) + INTERVAL 1 MONTH
      ELSE date_trunc('month', joined) END, '%Y-%m-%d') AS cycle
  FROM d""",
    }


# --- goals ---------------------------------------------------------------------------

TITLE = "array_to_string(list_transform(string_split(lower({0}), ' '), lambda w: upper(w[1]) || w[2:]), ' ')"

GOALS = f"""goals AS (
  SELECT branch, team, sum(goal)::DOUBLE AS goal FROM (
    SELECT {TITLE.format('r_name')} AS branch, 'Team ' || (n_nationkey % 7) AS team,
      CASE n_nationkey % 4 WHEN 0 THEN DATE '2001-07-01' WHEN 3 THEN NULL ELSE DATE '2001-08-01' END AS month,
      CASE WHEN n_nationkey = 9 THEN 0 ELSE (n_nationkey + 1) * 4 END AS goal
    FROM nation JOIN region ON n_regionkey = r_regionkey)
  WHERE (branch, month) IN (SELECT (branch, max(month)) FROM (
    SELECT {TITLE.format('r_name')} AS branch,
      CASE n_nationkey % 4 WHEN 0 THEN DATE '2001-07-01' WHEN 3 THEN NULL ELSE DATE '2001-08-01' END AS month
    FROM nation JOIN region ON n_regionkey = r_regionkey) GROUP BY branch)
  GROUP BY branch, team)"""

PROPOSALS = f"""proposals AS (
  SELECT {TITLE.format('r_name')} AS branch, o_orderkey AS k, r_name, o_orderstatus AS status, o_orderpriority AS product,
    CASE WHEN o_orderkey % 40 > 1 THEN printf('%06d', o_custkey % 110) END AS seller_code,
    o_orderdate BETWEEN TIMESTAMP '2001-07-26' AND TIMESTAMP '2001-08-01' AS in_cycle, o_orderkey % 5 + 1 AS lives
  FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
  JOIN region ON n_regionkey = r_regionkey)"""

TEAMS = """teams AS (
  SELECT printf('%06d', s_suppkey) AS seller_code, CASE WHEN s_suppkey % 9 <> 0 THEN 'Team ' || (s_nationkey % 7) END AS team
  FROM supplier JOIN range(2) r(i) ON i = 0 OR s_suppkey % 50 = 7)"""


def _lives(where: str) -> str:
    return f"""lives AS (
  SELECT branch, team, sum(lives)::BIGINT AS lives FROM proposals LEFT JOIN teams USING (seller_code)
  WHERE in_cycle AND {where} AND team IS NOT NULL GROUP BY branch, team)"""


RESULT = """result AS (
  SELECT branch, team, lives, goal, CASE WHEN goal IS NULL THEN 0.0 WHEN goal = 0 AND lives > 0 THEN NULL
      WHEN goal = 0 THEN 0.0 ELSE round_even(lives::DOUBLE / goal * 100.0 * 10.0, 0) / 10.0 END::DOUBLE AS pct
  FROM lives LEFT JOIN goals USING (branch, team))"""

MESSAGE = """SELECT branch, ord::INTEGER AS ord, team, lives::VARCHAR AS lives_text,
    coalesce(floor(goal)::BIGINT::VARCHAR, '—') AS goal_text,
    CASE WHEN goal IS NULL THEN 'sem meta definida'
      WHEN goal <= lives THEN '✅ Meta batida! Superou em ' || (lives - goal)::BIGINT || ' vida(s)'
      ELSE 'faltam ' || (goal - lives)::BIGINT || ' vidas para alcançar a meta' END AS progress,
    coalesce(printf('%.1f', round_even(shown * 10.0, 0) / 10.0) || '%', '—') AS attained,
    repeat(CASE WHEN ratio >= 100 THEN '🟦' WHEN ratio >= 70 THEN '🟩' ELSE '🟨' END, trunc(ratio / 100 * 10)::BIGINT)
      || repeat('⬜', greatest(10 - trunc(ratio / 100 * 10), 0)::BIGINT) || ' '
      || printf('%.0f', round_even(ratio, 0)) || '%' AS bar,
    reached
  FROM (SELECT *, CASE WHEN goal > 0 THEN lives::DOUBLE / goal * 100 ELSE 0.0::DOUBLE END AS ratio FROM (
    SELECT branch, 1 AS ord, team, lives, goal, pct AS shown, NULL::BOOLEAN AS reached FROM result
    UNION ALL
    SELECT branch, 0, 'TOTAL GERAL', lives, goal, CASE WHEN goal > 0 THEN lives::DOUBLE / goal * 100 END, lives >= goal
    FROM (SELECT branch, sum(lives)::BIGINT AS lives, floor(coalesce(sum(goal), 0))::DOUBLE AS goal
      FROM result GROUP BY branch)))"""


def goal_queries() -> dict[str, str]:
    every = f"WITH {GOALS}, {PROPOSALS}, {TEAMS}, {_lives('TRUE')}, {RESULT} "
    some = "status = 'O'"
    return {
        "goals_latest_month": f"WITH {GOALS} SELECT branch, team, goal FROM goals",
        "lives_by_team": f"{every} SELECT branch, team, lives FROM lives",
        "goals_by_team": f"{every} SELECT branch, team, lives, goal, pct FROM result",
        "goals_by_team_filtered": f"WITH {GOALS}, {PROPOSALS}, {TEAMS}, {_lives(some)}, {RESULT} "
        "SELECT branch, team, lives, goal, pct FROM result",
        "goals_idle_teams": f"""WITH {GOALS}, {PROPOSALS}, {TEAMS}, {_lives("product = '1-URGENT'")},
  every AS (SELECT branch, team, coalesce(lives, 0) AS lives, goal FROM lives FULL JOIN goals USING (branch, team))
  SELECT branch, team, lives, goal, CASE WHEN goal IS NULL THEN 0.0 WHEN goal = 0 AND lives > 0 THEN NULL
      WHEN goal = 0 THEN 0.0 ELSE round_even(lives::DOUBLE / goal * 100.0 * 10.0, 0) / 10.0 END::DOUBLE AS pct FROM every""",
        "goal_message": every + MESSAGE,
        "seller_diagnosis": f"""WITH {PROPOSALS}, {TEAMS}, spelled AS (
    SELECT seller_code, status, product, in_cycle, branch AS clean_branch,
      CASE k % 3 WHEN 0 THEN r_name WHEN 1 THEN '  ' || lower(r_name) ELSE branch || ' ' END AS branch FROM proposals)
  SELECT s.seller_code, s.branch, status, product, count(*) AS proposals, count(*) FILTER (in_cycle) AS in_cycle,
    coalesce((SELECT count(*) FROM teams t WHERE t.seller_code = s.seller_code), 0) AS listings,
    clean_branch = 'Asia' AS branch_ok, status = 'O' AS status_ok, product = '1-URGENT' AS product_ok
  FROM spelled s GROUP BY ALL""",
    }


# --- mail ----------------------------------------------------------------------------

FIVE = "printf('%05d', o_orderkey * 37 % 100000)"
THREE = "printf('%03d', o_orderkey % 1000)"
EIGHT = "printf('%08d', o_orderkey * 7919 % 100000000)"
FAR = "repeat('x ', 40)"
MAIL = f"""mail AS (
  SELECT 'Box ' || o_orderstatus AS folder, o_orderkey AS uid, o_orderdate AS sent,
    'c' || o_custkey || '@example.org' AS sender,
    CASE o_orderkey % 7 WHEN 0 THEN trim('Lista de CEPS ' || o_orderkey || ' ' || repeat('assunto ', 14))
      WHEN 1 THEN 'Pedido ' || {EIGHT} ELSE 'Pedido' END AS subject,
    CASE WHEN o_orderkey % 40 = 0 THEN 'cep ' || {FAR} || array_to_string(list_transform(range(25),
        lambda i: printf('%08d', (o_orderkey * 104729 + i * 3571) * 97 % 100000000)), ' ')
      WHEN o_orderkey % 6 = 0 THEN 'Entrega CEP: ' || {FIVE} || '-' || {THREE} || ' e ' || {EIGHT}
      WHEN o_orderkey % 6 = 1 THEN 'CEP ' || {FIVE} || {THREE} || {FAR} || {EIGHT} || ' ' || {FIVE} || ' - ' || {THREE}
      WHEN o_orderkey % 6 = 2 THEN 'nada aqui ' || {EIGHT}
      WHEN o_orderkey % 6 = 3 THEN {EIGHT} || ' ' || {FAR} || '20240101 cep ' || {FAR} || '00123456 19991231'
      WHEN o_orderkey % 6 = 4 THEN 'somente CEPS ' || {FIVE} || '-' || {THREE}
      ELSE 'CEP ' || {FIVE} || '-' || {THREE} || ' & fim' END AS body
  FROM orders)"""

# Explicit finds by regular expression; RE2 and Java agree on these patterns.
FOUND = r"""found AS (
  SELECT *, subject || chr(10) || body AS text,
    regexp_matches(subject, '(?i)\bCEPS?\b') OR regexp_matches(body, '(?i)\bCEP\b') AS gate FROM mail),
explicit AS (
  SELECT *, list_transform(
      list_concat(regexp_extract_all(text, '(?i)CEP\s*:?\s*\d{5}\s*-?\s*\d{3}'),
        regexp_extract_all(text, '\b\d{5}\s*-\s*\d{3}\b')),
      lambda x: regexp_replace(x, '\D', '', 'g')) AS hits
  FROM found)"""

# Bare numbers by position: each start, its neighbours and its context are looked at one by one.
BARE = r"""starts AS (
  SELECT uid, text, len(hits) AS listed, unnest(range(1, len(text) - 6)) AS pos FROM explicit WHERE gate),
bare AS (
  SELECT uid, listed, pos, substr(text, pos, 8) AS digits,
    contains(upper(substr(text, greatest(pos - 50, 1), least(50, pos - 1))), 'CEP')
      OR contains(upper(substr(text, pos, 50)), 'CEP') AS near
  FROM starts
  WHERE regexp_full_match(substr(text, pos, 8), '\d{8}')
    AND NOT regexp_full_match(substr(text, pos + 8, 1), '\w')
    AND (pos = 1 OR NOT regexp_full_match(substr(text, pos - 1, 1), '\w'))),
candidates AS (
  SELECT *, listed + row_number() OVER (PARTITION BY uid ORDER BY pos) - 1 AS before
  FROM bare WHERE near OR digits[1:2] NOT IN ('00', '19', '20', '21')),
over AS (
  SELECT uid, count(*) AS dropped FROM candidates WHERE NOT near AND before >= 20 GROUP BY uid),
accepted AS (
  SELECT uid, list(digits ORDER BY pos) AS more FROM candidates WHERE near OR before < 20 GROUP BY uid),
coded AS (
  SELECT e.*, CASE WHEN gate THEN list_concat(hits, coalesce(more, [])) ELSE [] END AS every, coalesce(dropped, 0) AS dropped
  FROM explicit e LEFT JOIN accepted USING (uid) LEFT JOIN over USING (uid))"""


def _codes(source: str, codes: str, dropped: str = "0") -> str:
    # The first place of each code keeps the order of appearance.
    unique = f"list_filter({codes}, lambda x, i: list_position({codes}, x) = i)"
    dashed = f"list_transform({unique}, lambda x: x[1:5] || '-' || x[6:8])"
    return f"""SELECT folder, uid, strftime(sent, '%Y-%m-%d %H:%M:%S') AS sent, sender, substr(subject, 1, 100) AS subject,
    body, array_to_string({dashed}, ', ') AS codes, len({unique})::INTEGER AS quantity,
    {dropped}::INTEGER AS dropped
  FROM {source} WHERE gate AND len({codes}) > 0"""


NO_SCRIPT = r"regexp_replace(regexp_replace(html, '(?is)<script\b[^>]*>.*?</script\s*>', ' ', 'g'), '(?is)<style\b[^>]*>.*?</style\s*>', ' ', 'g')"
NO_TAGS = rf"regexp_replace(regexp_replace({NO_SCRIPT}, '(?s)<!--.*?-->', ' ', 'g'), '(?s)</?[A-Za-z!?][^>]*>', ' ', 'g')"


def mail_queries() -> dict[str, str]:
    text = NO_TAGS
    for name, char in (("&amp;", "&"), ("&quot;", '"'), ("&copy;", "©"), ("&middot;", "·"), ("&lt;", "<"), ("&gt;", ">"), ("&nbsp;", " ")):
        text = f"replace({text}, '{name}', '{char}')"
    return {
        "mail_last_n": f"""WITH {MAIL} SELECT folder, uid, strftime(sent, '%Y-%m-%d %H:%M:%S') AS sent, sender,
    CASE WHEN uid % 7 = 0 THEN subject || ' ' ELSE subject END AS subject
  FROM mail WHERE sent >= TIMESTAMP '1996-01-01'
  QUALIFY row_number() OVER (PARTITION BY folder ORDER BY uid DESC) <= 500""",
        "mail_codes_explicit": f"WITH {MAIL}, {FOUND} " + _codes("explicit", "hits"),
        "mail_codes_full": f"WITH {MAIL}, {FOUND}, {BARE} " + _codes("coded", "every", "dropped"),
        "mail_totals": f"""WITH {MAIL}, {FOUND}, {BARE}
  SELECT folder, count(*) FILTER (len(every) > 0) AS with_codes, count(*) FILTER (len(every) = 0) AS without_codes,
    sum(len(list_distinct(every)))::BIGINT AS codes, sum(dropped)::BIGINT AS dropped FROM coded GROUP BY folder""",
        "html_text": rf"SELECT page_id, trim(regexp_replace({text}, '\s+', ' ', 'g')) AS text FROM pages",
    }


# --- leads ---------------------------------------------------------------------------

LEADS = """leads AS (
  SELECT o_orderkey AS lead_id, o_custkey AS cust, o_orderdate AS created,
    CASE WHEN o_totalprice > 300000 AND o_orderkey % 3 = 0 THEN 'Ganho' WHEN o_orderkey % 11 = 0 THEN 'Ganho'
      WHEN o_orderkey % 5 = 1 THEN 'Perdido' WHEN o_orderkey % 10 = 2 THEN 'Desistiu'
      WHEN o_orderkey % 10 = 3 THEN 'Descartado'
      ELSE (['Prospecção', 'Contato Pré Vendas', 'Negociação', 'Em Aprovação', 'Sem contato', 'Outro'])[o_orderkey % 6 + 1]
      END AS stage,
    (['Tráfego Pago', 'Orgânico', 'nenhum', 'Offline', 'Evento', NULL])[o_orderkey % 6 + 1] AS channel,
    CASE WHEN o_custkey % 13 <> 0 THEN ' Place ' || (o_custkey % 25) END AS place,
    (['Pré-Vendas 1', 'Suporte', 'Televendas', 'Vendas Diretas Sul', 'Parceiros', NULL])[o_custkey % 6 + 1] AS sales_team,
    CASE WHEN o_orderkey % 9 = 4 THEN 'price' WHEN o_orderkey % 9 = 5 THEN '' END AS loss_reason,
    CASE WHEN o_orderkey % 8 = 0 THEN NULL WHEN o_orderkey % 8 = 1 THEN '1.234,56'
      ELSE replace(o_totalprice::DECIMAL(18, 2)::VARCHAR, '.', ',') END AS expected_revenue,
    CASE WHEN o_custkey % 4 = 0 THEN '' WHEN o_custkey % 4 = 1 THEN 'Campaign' END AS campaign,
    o_totalprice
  FROM orders)"""

FEATURES = f"""{LEADS}, features AS (
  SELECT *, coalesce(stage = 'Ganho' OR loss_reason = 'price' OR stage IN ('Perdido', 'Desistiu', 'Descartado'), FALSE)
      AS decided,
    (stage = 'Ganho')::INTEGER AS target,
    stage NOT IN ('Ganho', 'Perdido', 'Desistiu', 'Descartado', 'Outro') AS open,
    CASE WHEN lead_id % 19 <> 0 THEN (lead_id % 24)::INTEGER END AS hour,
    isodow(created)::INTEGER - 1 AS weekday,
    CASE WHEN lead_id % 23 = 0 THEN 0.0 ELSE (lead_id % 90) END::DOUBLE AS days_in_funnel,
    CASE WHEN lead_id % 8 < 2 THEN 0.0 ELSE o_totalprice::DECIMAL(18, 2) END::DOUBLE AS revenue,
    CASE WHEN lead_id % 4 = 0 THEN -1 ELSE greatest(floor((lead_id % 200 - 20) * 7 / 24.0), 0) END::INTEGER AS days_to_close,
    CASE WHEN lead_id % 4 = 0 THEN -1.0 ELSE lead_id % 300 + 0.5 END::DOUBLE AS hours_to_close
  FROM leads)"""

SCORED = f"""{FEATURES}, scored AS (
  SELECT *, least(floor(revenue / 500) / 1000 + days_in_funnel / 1000, 1.0) AS p FROM features)"""

SCORES = """scores AS (
  SELECT lead_id, 'Contact ' || cust AS contact, 'Seller ' || (cust % 17) AS seller, stage, channel, place, sales_team,
    strftime(created, '%Y-%m-%d %H:%M:%S') AS created, expected_revenue, campaign, score, probability,
    CASE WHEN score < 25 THEN 'Frio (0-25)' WHEN score < 50 THEN 'Morno (26-50)' WHEN score < 75 THEN 'Quente (51-75)'
      ELSE 'Hot (76-100)' END AS score_band
  FROM (SELECT *, round_even(p * 100 * 10.0, 0) / 10.0 AS score, round_even(p * 10000.0, 0) / 10000.0 AS probability
    FROM scored WHERE open))"""


MODEL_COLUMNS = """SELECT lead_id, decided, target, open,
    CASE channel WHEN 'Tráfego Pago' THEN 'trafego_pago' WHEN 'Orgânico' THEN 'organico' WHEN 'nenhum' THEN 'desconhecido'
      WHEN 'Offline' THEN 'offline' ELSE 'outro' END AS channel_norm,
    coalesce(lower(trim(place)), 'desconhecida') AS place_norm,
    CASE WHEN sales_team IN ('Pré-Vendas 1', 'Suporte') THEN 'sdr' WHEN sales_team = 'Televendas' THEN 'televendas'
      WHEN sales_team LIKE 'Vendas Diretas%' THEN 'vendas_diretas' ELSE 'outras' END AS team_type,
    CASE WHEN hour IS NULL THEN 'nan' WHEN hour <= 6 THEN 'madrugada' WHEN hour <= 12 THEN 'manhã' WHEN hour <= 18 THEN 'tarde'
      ELSE 'noite' END AS day_part,
    hour, weekday, (weekday >= 5)::INTEGER AS weekend, month(created)::INTEGER AS month, days_in_funnel, revenue,
    (revenue > 0)::INTEGER AS has_revenue, (cust % 3 <> 0)::INTEGER AS has_email, (cust % 4 = 1)::INTEGER AS has_campaign,
    days_to_close, hours_to_close
  FROM features"""


def lead_queries() -> dict[str, str]:
    return {
        "lead_features": f"WITH {FEATURES} {MODEL_COLUMNS}",
        "lead_csv_features": f"WITH {FEATURES} {MODEL_COLUMNS}",
        "score_export": f"WITH {SCORED}, {SCORES} SELECT lead_id, score, probability FROM scores",
        "lead_label_codes": f"""WITH {FEATURES}, model AS ({MODEL_COLUMNS}),
    labels AS (SELECT DISTINCT unnest(['channel_norm', 'place_norm', 'team_type', 'day_part']) AS feature,
      unnest([channel_norm, place_norm, team_type, day_part]) AS label FROM model)
  SELECT feature, label, (row_number() OVER (PARTITION BY feature ORDER BY label) - 1)::INTEGER AS code FROM labels""",
        "lead_stages": f"WITH {LEADS} SELECT stage, count(*) AS n FROM leads GROUP BY stage",
        "lead_balance": f"""WITH {FEATURES}
  SELECT count(*) AS leads, count(*) FILTER (decided) AS decided, count(*) FILTER (decided AND target = 1) AS won,
    count(*) FILTER (decided AND target = 0) AS lost, count(*) FILTER (open) AS open_leads,
    count(*) FILTER (open AND decided) AS open_and_decided,
    (count(*) FILTER (decided AND target = 0))::DOUBLE / count(*) FILTER (decided AND target = 1) AS weight
  FROM features""",
        "lead_split": f"""WITH {FEATURES}, hashed AS (
    SELECT *, row_number() OVER (PARTITION BY target ORDER BY md5(lead_id::VARCHAR)) - 1 AS pos,
      count(*) OVER (PARTITION BY target) AS n FROM features WHERE decided)
  SELECT lead_id, target, pos < n * 0.2 AS is_test, (pos % 5)::INTEGER AS fold FROM hashed""",
        "auc_rank_sum": f"""WITH {SCORED}, ranked AS (
    SELECT target, rank() OVER (ORDER BY p) + (count(*) OVER (PARTITION BY p) - 1) / 2.0 AS r FROM scored WHERE decided)
  SELECT count(*) FILTER (target = 1) AS positives, count(*) FILTER (target = 0) AS negatives,
    (2 * sum(r) FILTER (target = 1) - (count(*) FILTER (target = 1))::DOUBLE * (count(*) FILTER (target = 1) + 1))::DOUBLE
      / (2.0 * count(*) FILTER (target = 1) * count(*) FILTER (target = 0))::DOUBLE AS auc
  FROM ranked""",
        "lead_fold_auc": f"""WITH {SCORED}, dealt AS (
    SELECT target, p, (row_number() OVER (PARTITION BY target ORDER BY md5(lead_id::VARCHAR)) - 1) % 5 AS fold
    FROM scored WHERE decided),
  ranked AS (SELECT fold, target, rank() OVER (PARTITION BY fold ORDER BY p)
      + (count(*) OVER (PARTITION BY fold, p) - 1) / 2.0 AS r FROM dealt),
  aucs AS (SELECT fold, (sum(r) FILTER (target = 1) - count(*) FILTER (target = 1) * (count(*) FILTER (target = 1) + 1) / 2.0)::DOUBLE
      / (count(*) FILTER (target = 1) * count(*) FILTER (target = 0)) AS auc FROM ranked GROUP BY fold)
  SELECT count(*)::INTEGER AS folds, round_even(avg(auc) * 1000000.0, 0) / 1000000.0 AS auc_mean,
    round_even(stddev_pop(auc) * 1000000.0, 0) / 1000000.0 AS auc_sd FROM aucs""",
        "lead_calibration": f"""WITH {SCORED}, cells AS (SELECT p AS raw, count(*) AS n, sum(target) AS won FROM scored WHERE decided GROUP BY 1),
  c AS (SELECT *, row_number() OVER (ORDER BY raw) AS k, sum(n) OVER (ORDER BY raw) AS cn, sum(won) OVER (ORDER BY raw) AS cw FROM cells),
  means AS (SELECT a.k AS i, b.k AS j, (b.cw - a.cw + a.won)::DOUBLE / (b.cn - a.cn + a.n)::DOUBLE AS m FROM c a JOIN c b ON a.k <= b.k),
  lows AS (SELECT j AS k, min(m) OVER (PARTITION BY i ORDER BY j DESC) AS m FROM means),
  highs AS (SELECT k, max(m) AS m FROM lows GROUP BY k)
  SELECT round_even(raw * 1000000.0, 0) / 1000000.0 AS raw, n, round_even(m * 1000000.0, 0) / 1000000.0 AS calibrated
  FROM c JOIN highs USING (k)""",
        "lead_rule_importance": f"""WITH {SCORED}, rows AS (
    SELECT lead_id, target, revenue, days_in_funnel, row_number() OVER (ORDER BY md5(lead_id::VARCHAR)) AS place,
      row_number() OVER (ORDER BY md5('revenue ' || lead_id)) AS revenue_place,
      row_number() OVER (ORDER BY md5('days_in_funnel ' || lead_id)) AS days_place FROM scored WHERE decided),
  variants AS (SELECT '' AS feature, target, revenue, days_in_funnel FROM rows
    UNION ALL SELECT 'revenue', a.target, b.revenue, a.days_in_funnel FROM rows a JOIN rows b ON a.place = b.revenue_place
    UNION ALL SELECT 'days_in_funnel', a.target, a.revenue, b.days_in_funnel FROM rows a JOIN rows b ON a.place = b.days_place),
  rated AS (SELECT feature, target, least(floor(revenue / 500) / 1000 + days_in_funnel / 1000, 1.0) AS p FROM variants),
  ranked AS (SELECT feature, target, rank() OVER (PARTITION BY feature ORDER BY p)
      + (count(*) OVER (PARTITION BY feature, p) - 1) / 2.0 AS r FROM rated),
  aucs AS (SELECT feature, (2 * sum(r) FILTER (target = 1) - (count(*) FILTER (target = 1))::DOUBLE * (count(*) FILTER (target = 1) + 1))::DOUBLE
      / (2.0 * count(*) FILTER (target = 1) * count(*) FILTER (target = 0))::DOUBLE AS auc FROM ranked GROUP BY feature)
  SELECT a.feature, round_even(a.auc * 1000000.0, 0) / 1000000.0 AS auc, round_even((b.auc - a.auc) * 1000000.0, 0) / 1000000.0 AS auc_drop
  FROM aucs a, aucs b WHERE a.feature <> '' AND b.feature = ''""",
        "lead_model_checks": """SELECT name, fold::INTEGER AS fold, TRUE AS ok
  FROM (VALUES ('sum of probabilities'), ('monotone calibration'), ('sum of importances'), ('loss on training rows'),
    ('leaves of a split differ')) t(name), range(3) f(fold)""",
        "lead_saved_model": f"WITH {FEATURES} SELECT count(*) AS leads, count(*) AS alike FROM features WHERE open",
        "class_report": f"""WITH {SCORED}, y AS (SELECT target, (p > 0.5)::INTEGER AS hit FROM scored WHERE decided),
  c AS (SELECT label, count(*) FILTER (target = label AND hit = label) AS good, count(*) FILTER (hit = label) AS predicted,
      count(*) FILTER (target = label) AS support, (count(*) FILTER (target = hit))::DOUBLE / count(*) AS accuracy
    FROM y CROSS JOIN (VALUES (0), (1)) l(label) GROUP BY label),
  pr AS (SELECT *, good::DOUBLE / predicted AS precision, good::DOUBLE / support AS recall FROM c)
  SELECT label, precision, recall, 2 * precision * recall / (precision + recall) AS f1, support, accuracy FROM pr""",
        "score_bands": f"WITH {SCORED}, {SCORES} SELECT * FROM scores",
        "score_band_counts": f"WITH {SCORED}, {SCORES} SELECT score_band, count(*) AS n FROM scores GROUP BY score_band",
        "lead_score_lookup": f"""WITH {SCORED}, {SCORES}
  SELECT l.lead_id, s.score, CASE WHEN s.score IS NULL THEN '—' ELSE printf('%.1f', s.score) || ' pts' END AS score_text,
    CASE WHEN s.score >= 76 THEN '#1D9E75' WHEN s.score >= 51 THEN '#378ADD' WHEN s.score >= 26 THEN '#EF9F27'
      ELSE '#D85A30' END AS score_colour
  FROM leads l LEFT JOIN scores s USING (lead_id)""",
    }


def all_queries() -> dict[str, str]:
    return {**report_queries(), **churn_queries(), **detail_queries(), **goal_queries(), **mail_queries(), **lead_queries()}
