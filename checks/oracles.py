"""DuckDB statements giving the results the registered queries must have.

Written in the plain, quadratic or windowed form; every statement is a chain of
the named steps below, from the raw tables on.
"""

from __future__ import annotations

from patronage.plans.registry import AS_OF, MEMBER_SEGMENT, PROFILE_ID, SEARCH_TEXT
from patronage.sources.derived import DERIVED


def even(value: str, digits: int) -> str:
    """Round half to even at ``digits`` places."""
    scale = f"{10**digits}.0::DOUBLE"
    return f"(round_even(({value}) * {scale}, 0) / {scale})"


# Fixed values, written here on their own: the score triples with a label.
_LABELS = """
  Champions: 555 554 545
  Loyal Customers: 455 544 445 444
  Potential Loyalists: 533 433 333
  New Customers: 511 411
  Promising: 311 322
  Need Attention: 222 233
  About to Sleep: 133 223
  At Risk: 122 123 211
  Can't Lose Them: 113 114 115
  Hibernating: 112
  Lost: 111
"""
_TRIPLES = ", ".join(
    "('{}', '{}')".format(triple, line.split(":")[0].strip().replace("'", "''"))
    for line in _LABELS.strip().splitlines()
    for triple in line.split(":")[1].split()
)
_AGES = range(-40, 90)
_MONEY = "CAST(sum(CAST({} AS DECIMAL(18,2))) AS DOUBLE)"
_FEATURES = ("name_similarity", "email_match", "phone_similarity")


def _scored(metrics: str) -> str:
    """R2 to R5 over a step of customer metrics."""
    return f"""
  SELECT m.*,
    (1 + CASE WHEN recency <= e1 THEN 1 ELSE 0 END + CASE WHEN recency <= e2 THEN 1 ELSE 0 END
       + CASE WHEN recency <= e3 THEN 1 ELSE 0 END + CASE WHEN recency <= e4 THEN 1 ELSE 0 END) AS r_score,
    CAST(greatest(1, ceil((row_number() OVER (ORDER BY frequency, customer_id) - 1) * 5.0 / (n - 1))) AS INT) AS f_score,
    CAST(greatest(1, ceil((row_number() OVER (ORDER BY monetary, customer_id) - 1) * 5.0 / (n - 1))) AS INT) AS m_score
  FROM {metrics} m, (SELECT count(*) AS n, quantile_cont(recency, 0.2) AS e1, quantile_cont(recency, 0.4) AS e2,
                            quantile_cont(recency, 0.6) AS e3, quantile_cont(recency, 0.8) AS e4 FROM {metrics})"""


def _segmented(scored: str) -> str:
    return f"""
  SELECT s.*, concat(r_score, f_score, m_score) AS rfm_score,
    coalesce(t.label, CASE WHEN r_score >= 4 AND f_score >= 4 THEN 'Loyal Customers'
      WHEN r_score >= 4 THEN 'Potential Loyalists' WHEN r_score <= 2 AND m_score >= 4 THEN 'Can''t Lose Them'
      WHEN r_score <= 2 THEN 'At Risk' ELSE 'Need Attention' END) AS segment
  FROM {scored} s LEFT JOIN (VALUES {_TRIPLES}) t(triple, label) ON t.triple = concat(r_score, f_score, m_score)"""


def _summary(purchases: str) -> str:
    """C1 over a step with customer_id, day and money of each purchase."""
    return f"""
  SELECT customer_id, count(*) - 1 AS frequency, date_diff('day', min(day), max(day)) AS recency,
    date_diff('day', min(day), (SELECT max(day) FROM {purchases})) AS "T",
    CAST(sum(spent) - arg_min(spent, day) AS DOUBLE) / (count(*) - 1) AS monetary_value
  FROM (SELECT customer_id, day, sum(spent) AS spent FROM {purchases} WHERE customer_id IS NOT NULL GROUP BY 1, 2)
  GROUP BY 1 HAVING count(*) > 1"""


def _valued(summary: str) -> str:
    return f"""
  SELECT *, predicted_purchases * monetary_value AS predicted_clv FROM (
    SELECT *, CASE WHEN "T" = 0 THEN NULL
      ELSE greatest(0.0, CAST(frequency AS DOUBLE) / "T" * 12 * 30) END AS predicted_purchases FROM {summary})"""


def _tiered(valued: str) -> str:
    return f"""
  SELECT v.*, CASE WHEN predicted_clv <= lo THEN 'Low Value' WHEN predicted_clv <= hi THEN 'Medium Value'
    WHEN predicted_clv > hi THEN 'High Value' END AS clv_tier
  FROM {valued} v, (SELECT quantile_cont(predicted_clv, 0.33) AS lo, quantile_cont(predicted_clv, 0.66) AS hi FROM {valued})"""


_FEATURE_COLUMNS = (
    "r_score", "f_score", "m_score", "monetary", "web_sessions", "avg_pages", "avg_time", "ticket_count",
    "avg_satisfaction", "avg_resolution_time",
)

# Terms of the series: its argument is at most 360 / 420, so those left out are below 1e-20.
_TERMS = 500


# Name of a step -> (its statement, the steps it reads).
_STEPS: dict[str, tuple[str, tuple[str, ...]]] = {
    name: (text.format(**{s: s for s in sources}), ()) for name, (text, sources) in DERIVED.items()
} | {
    "forms": (
        """
  SELECT *, nullif(upper(substr(name_lower, 1, 1)), '') AS first_letter FROM (
    SELECT *, replace(trim(lower(coalesce(email, ''))), ' ', '') AS email_normalized,
      regexp_replace(coalesce(phone, ''), '[^0-9]', '', 'g') AS phone_normalized,
      trim(lower(coalesce(name, ''))) AS name_lower FROM crm_customers)""",
        ("crm_customers",),
    ),
    "compared": (
        """
  SELECT *, name_similarity * 0.4::DOUBLE + email_match * 0.4::DOUBLE + phone_similarity * 0.2::DOUBLE AS score FROM (
    SELECT l.rec_id AS left_id, r.rec_id AS right_id,
      CASE WHEN l.name_lower = '' OR r.name_lower = '' THEN 0.0
           ELSE jaro_winkler_similarity(l.name_lower, r.name_lower) END AS name_similarity,
      CASE WHEN l.email_normalized = r.email_normalized AND l.email_normalized <> '' THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS email_match,
      CASE WHEN l.phone_normalized = '' OR r.phone_normalized = '' THEN 0.0
           ELSE jaro_winkler_similarity(l.phone_normalized, r.phone_normalized) END AS phone_similarity
    FROM forms l JOIN forms r ON l.first_letter = r.first_letter AND l.rec_id > r.rec_id)""",
        ("forms",),
    ),
    "zipped": (
        """
  SELECT *, name_similarity * 0.4::DOUBLE + email_match * 0.4::DOUBLE + phone_similarity * 0.2::DOUBLE AS score FROM (
    SELECT l.rec_id AS left_id, r.rec_id AS right_id,
      CASE WHEN l.name_lower = '' OR r.name_lower = '' THEN 0.0
           ELSE jaro_winkler_similarity(l.name_lower, r.name_lower) END AS name_similarity,
      CASE WHEN l.email_normalized = r.email_normalized AND l.email_normalized <> '' THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS email_match,
      CASE WHEN l.phone_normalized = '' OR r.phone_normalized = '' THEN 0.0
           ELSE jaro_winkler_similarity(l.phone_normalized, r.phone_normalized) END AS phone_similarity
    FROM forms l JOIN forms r ON (l.first_letter = r.first_letter OR l.zip_code = r.zip_code) AND l.rec_id > r.rec_id)""",
        ("forms",),
    ),
    "labelled": (
        """
  SELECT *, CASE WHEN score >= 0.85::DOUBLE THEN 'match' WHEN score >= 0.6::DOUBLE THEN 'uncertain'
    ELSE 'non_match' END AS label FROM compared""",
        ("compared",),
    ),
    "kept": ("SELECT * FROM labelled WHERE label <> 'non_match'", ("labelled",)),
    "edges": (
        """
  SELECT left_id AS a, right_id AS b FROM kept WHERE label = 'match'
  UNION SELECT right_id, left_id FROM kept WHERE label = 'match'""",
        ("kept",),
    ),
    "reached": ("SELECT a AS rec_id, b AS other FROM edges UNION SELECT r.rec_id, e.b FROM reached r JOIN edges e ON r.other = e.a", ("edges",)),
    "clusters": (
        "SELECT rec_id, min(least(rec_id, other)) AS component_id FROM reached GROUP BY 1",
        ("reached",),
    ),
    "owned": (
        """
  SELECT c.*, coalesce(k.component_id, c.rec_id) AS component_id
  FROM crm_customers c LEFT JOIN clusters k ON k.rec_id = c.rec_id""",
        ("crm_customers", "clusters"),
    ),
    "golden": (
        """
  SELECT printf('GOLD_%06d', component_id) AS unified_id,
    (array_agg(name ORDER BY length(name) DESC, rec_id) FILTER (WHERE name IS NOT NULL))[1] AS name,
    coalesce((array_agg(email ORDER BY rec_id) FILTER (WHERE email LIKE '%@%'))[1],
             (array_agg(email ORDER BY rec_id) FILTER (WHERE email IS NOT NULL))[1]) AS email,
    (array_agg(phone ORDER BY length(regexp_replace(phone, '[^0-9]', '', 'g')) DESC, rec_id)
       FILTER (WHERE phone IS NOT NULL))[1] AS phone,
    count(*) AS record_count
  FROM owned GROUP BY component_id""",
        ("owned",),
    ),
    "listed": (
        """
  SELECT printf('GOLD_%06d', component_id) AS unified_id, rec_id, customer_id,
    row_number() OVER (PARTITION BY component_id ORDER BY rec_id) AS position FROM owned""",
        ("owned",),
    ),
    "walk": (
        "SELECT rec_id, customer_id, printf('GOLD_%06d', component_id) AS unified_id FROM owned",
        ("owned",),
    ),
    "rfm": (
        f"""
  SELECT customer_id, date_diff('day', max(date), DATE '{AS_OF}') AS recency, count(transaction_id) AS frequency,
    {_MONEY.format("amount")} AS monetary
  FROM transactions WHERE customer_id IS NOT NULL GROUP BY 1""",
        ("transactions",),
    ),
    "scored": (_scored("rfm"), ("rfm",)),
    "segmented": (_segmented("scored"), ("scored",)),
    "web": (
        """
  SELECT customer_id, count(session_id) AS web_sessions, avg(pages_visited) AS avg_pages, avg(time_on_site) AS avg_time
  FROM web_sessions WHERE customer_id IS NOT NULL GROUP BY 1""",
        ("web_sessions",),
    ),
    "support": (
        f"""
  SELECT customer_id, count(ticket_id) AS ticket_count, avg(satisfaction_score) AS avg_satisfaction,
    avg(resolution_time_hours) AS avg_resolution_time
  FROM support_tickets WHERE customer_id IS NOT NULL GROUP BY 1""",
        ("support_tickets",),
    ),
    "features": (
        """
  SELECT customer_id, r_score, f_score, m_score, monetary, coalesce(web_sessions, 0) AS web_sessions,
    coalesce(avg_pages, 0.0) AS avg_pages, coalesce(avg_time, 0.0) AS avg_time, coalesce(ticket_count, 0) AS ticket_count,
    coalesce(avg_satisfaction, 0.0) AS avg_satisfaction, coalesce(avg_resolution_time, 0.0) AS avg_resolution_time
  FROM segmented LEFT JOIN web USING (customer_id) LEFT JOIN support USING (customer_id)""",
        ("segmented", "web", "support"),
    ),
    "bought": (
        "SELECT customer_id, CAST(date AS DATE) AS day, CAST(amount AS DECIMAL(18,2)) AS spent FROM transactions",
        ("transactions",),
    ),
    "summary": (_summary("bought"), ("bought",)),
    "valued": (_valued("summary"), ("summary",)),
    "tiered": (_tiered("valued"), ("valued",)),
    "spending": (
        f"""
  SELECT customer_id, {_MONEY.format("amount")} AS total_spend, {_MONEY.format("amount")} / count(amount) AS avg_order,
    {even("coalesce(stddev_samp(amount), 0.0)", 6)} AS std_order, count(amount) AS order_count,
    count(DISTINCT product_category) AS category_diversity, date_diff('day', min(date), DATE '{AS_OF}') AS tenure_days,
    date_diff('day', max(date), DATE '{AS_OF}') AS recency_days,
    count(amount) / (greatest(date_diff('day', min(date), DATE '{AS_OF}'), 1) / 30.0::DOUBLE) AS purchase_frequency
  FROM transactions WHERE customer_id IS NOT NULL GROUP BY 1""",
        ("transactions",),
    ),
    # The expected purchases within every month at the given parameters, by the published series summed term by term.
    "ahead": (
        f"""
  SELECT customer_id, month, 4 * (90000 + x * m) / (4 * x + 2.5) AS worth,
    (2.2 + x) / -0.3 * (1 - pow((60 + age) / (60 + age + 30 * month), 0.8 + x) * series)
      / (1 + CASE WHEN x > 0 THEN 0.7 / (1.5 + x) * pow((60 + age) / (60 + t), 0.8 + x) ELSE 0 END) AS purchases
  FROM (
    SELECT customer_id, month, any_value(x) AS x, any_value(m) AS m, any_value(t) AS t, any_value(age) AS age,
      sum(exp(lgamma(0.8 + x + n) - lgamma(0.8 + x) + lgamma(2.5 + x + n) - lgamma(2.5 + x)
              - lgamma(2.2 + x + n) + lgamma(2.2 + x) - lgamma(n + 1.0) + n * ln(30 * month / (60 + age + 30 * month)))) AS series
    FROM (SELECT customer_id, frequency::DOUBLE AS x, recency::DOUBLE AS t, "T"::DOUBLE AS age, monetary_value AS m FROM summary),
      (SELECT unnest(range(1, 13)) AS month), (SELECT unnest(range(0, {_TERMS})) AS n)
    GROUP BY customer_id, month)""",
        ("summary",),
    ),
    "spend_features": (
        f"SELECT customer_id, {_MONEY.format('amount')} AS total_spend FROM transactions WHERE customer_id IS NOT NULL GROUP BY 1",
        ("transactions",),
    ),
    "parted": (
        """
  SELECT *, CAST(('0x' || substr(sha256('42:' || customer_id), 1, 8))::UBIGINT % 5 AS INTEGER) AS part,
    CAST(('0x' || substr(sha256('43:' || customer_id), 1, 8))::UBIGINT % 5 AS INTEGER) AS fold FROM spend_features""",
        ("spend_features",),
    ),
    "scaled": (
        "SELECT customer_id, [" + ", ".join(
            f"(({c} - avg({c}) OVER ()) / coalesce(nullif(stddev_pop({c}) OVER (), 0), 1))::DOUBLE" for c in _FEATURE_COLUMNS
        ) + "] AS x FROM features",
        ("features",),
    ),
    "ranged": (
        """
  SELECT customer_id, x, k, recency * k // ((SELECT max(recency) FROM scored) + 1) AS label
  FROM scaled JOIN scored USING (customer_id), (SELECT unnest(range(2, 8)) AS k)""",
        ("scaled", "scored"),
    ),
    "apart": (
        """
  SELECT a.customer_id AS i, b.customer_id AS j, list_sum(list_transform(list_zip(a.x, b.x), lambda z: (z[1] - z[2]) * (z[1] - z[2]))) AS d
  FROM scaled a, scaled b""",
        ("scaled",),
    ),
    "choice": (
        """
  SELECT k, any_value(inertia) AS inertia, CASE WHEN count(DISTINCT label) = 1 THEN -1 ELSE avg(silhouette) END AS silhouette FROM (
    SELECT k, label, CASE WHEN size = 1 THEN 0 ELSE (outside - inside) / nullif(greatest(inside, outside), 0) END AS silhouette,
      sum(own / size / 2) OVER (PARTITION BY k) AS inertia
    FROM (SELECT r.k, r.customer_id, r.label, max(s.d) FILTER (s.label = r.label) AS own, max(s.n) FILTER (s.label = r.label) AS size,
            max(s.d / greatest(s.n - 1, 1)) FILTER (s.label = r.label) AS inside, min(s.d / s.n) FILTER (s.label <> r.label) AS outside
          FROM ranged r JOIN (SELECT i, k, label, sum(d) AS d, count(*) AS n FROM apart JOIN ranged ON customer_id = j GROUP BY ALL) s
            ON s.i = r.customer_id AND s.k = r.k
          GROUP BY r.k, r.customer_id, r.label))
  GROUP BY k""",
        ("ranged", "apart"),
    ),
    "cohort_rows": (
        """
  SELECT t.*, date_trunc('month', c.signup_date)::DATE AS cohort_month, date_trunc('month', t.date)::DATE AS transaction_month,
    CAST((year(t.date) * 12 + month(t.date)) - (year(c.signup_date) * 12 + month(c.signup_date)) AS INT) AS cohort_age
  FROM transactions t JOIN crm_customers c ON c.customer_id = t.customer_id WHERE c.signup_date IS NOT NULL""",
        ("transactions", "crm_customers"),
    ),
    "active": (
        "SELECT cohort_month, cohort_age, count(DISTINCT customer_id) AS customers FROM cohort_rows GROUP BY 1, 2",
        ("cohort_rows",),
    ),
    "rates": (
        f"""
  SELECT a.cohort_month, a.cohort_age, a.customers, z.customers AS cohort_size,
    {even("a.customers::DOUBLE / z.customers * 100", 1)} AS retention_rate
  FROM active a JOIN active z ON z.cohort_month = a.cohort_month AND z.cohort_age = 0""",
        ("active",),
    ),
    # The unified customers: purchases under the unified id, then as above.
    "u_bought": (
        """
  SELECT coalesce(w.unified_id, t.customer_id) AS customer_id, t.transaction_id, CAST(t.date AS DATE) AS day,
    CAST(t.amount AS DECIMAL(18,2)) AS spent
  FROM transactions t LEFT JOIN walk w ON w.customer_id = t.customer_id WHERE t.customer_id IS NOT NULL""",
        ("transactions", "walk"),
    ),
    "u_rfm": (
        f"""
  SELECT customer_id, date_diff('day', max(day), DATE '{AS_OF}') AS recency, count(transaction_id) AS frequency,
    CAST(sum(spent) AS DOUBLE) AS monetary FROM u_bought GROUP BY 1""",
        ("u_bought",),
    ),
    "u_scored": (_scored("u_rfm"), ("u_rfm",)),
    "u_segmented": (_segmented("u_scored"), ("u_scored",)),
    "u_summary": (_summary("u_bought"), ("u_bought",)),
    "u_valued": (_valued("u_summary"), ("u_summary",)),
    "u_tiered": (_tiered("u_valued"), ("u_valued",)),
}

_RECURSIVE = {"reached"}


def _with(query: str, *steps: str) -> str:
    """The query behind the named steps and all they read."""
    ordered: list[str] = []

    def visit(step: str) -> None:
        if step not in ordered:
            for needed in _STEPS[step][1]:
                visit(needed)
            ordered.append(step)

    for step in steps:
        visit(step)
    # Steps read more than once are kept, or they would be evaluated again each time.
    chain = ",\n".join(
        f"{s} AS {'' if s in _RECURSIVE else 'MATERIALIZED '}({_STEPS[s][0].strip()})" for s in ordered
    )
    return f"WITH RECURSIVE {chain}\n{query.strip()}"


def _rounded(*columns: str) -> str:
    return ", ".join(f"{even(c, 6)} AS {c}" for c in columns)


_COUNTS = " UNION ALL ".join(f"SELECT '{t}' AS table_name, count(*) AS row_count FROM {t}" for t in DERIVED)
_PAIR_LABELS = "SELECT unnest(['match', 'uncertain', 'non_match']) AS label"
_SUMMARY_ROW = f"""
  SELECT segment, count(customer_id) AS customer_count, {even("avg(recency)", 2)} AS avg_recency,
    {even("avg(frequency)", 2)} AS avg_frequency, {even(_MONEY.format("monetary") + " / count(monetary)", 2)} AS avg_monetary,
    {even(_MONEY.format("monetary"), 2)} AS total_monetary
  FROM segmented GROUP BY segment"""
_OVERVIEW = """
  SELECT *, customer_count * avg_monetary AS total_revenue FROM (
    SELECT segment, count(*) AS customer_count, {money} / count(monetary) AS avg_monetary,
      avg(frequency) AS avg_frequency, avg(recency) AS avg_recency FROM {table} GROUP BY 1)"""
_VIEW_COLUMNS = "g.unified_id, g.name, g.email, r.rfm_score, r.segment"
_REVIEW = f"""
  SELECT l.customer_id AS left_id, r.customer_id AS right_id, l.name AS left_name, r.name AS right_name,
    {_rounded("score", *_FEATURES)}
  FROM kept k JOIN crm_customers l ON l.rec_id = k.left_id JOIN crm_customers r ON r.rec_id = k.right_id
  WHERE label = 'uncertain'"""
_MEMBERS = f"""
  SELECT {_VIEW_COLUMNS}, r.monetary, c.predicted_clv, c.clv_tier
  FROM golden g JOIN u_segmented r ON r.customer_id = g.unified_id LEFT JOIN u_tiered c ON c.customer_id = g.unified_id
  WHERE r.segment = '{MEMBER_SEGMENT}'"""
def _components() -> str:
    """The two leading eigenvalues of the covariance by power iteration, the second one after deflation."""
    d = len(_FEATURE_COLUMNS)
    times = "list_transform({m}, lambda r: list_sum(list_transform(list_zip(r, {v}), lambda z: z[1] * z[2])))"
    norm = "sqrt(list_sum(list_transform({v}, lambda z: z * z)))"

    def iterated(name: str, matrix: str) -> str:
        turned = times.format(m=f"(SELECT m FROM {matrix})", v="v")
        return f"""
{name}_power AS (
  SELECT 0 AS step, list_transform(range(1, {d + 1}), lambda i: 1.0::DOUBLE / i) AS v
  UNION ALL
  SELECT step + 1, list_transform(w, lambda z: z / {norm.format(v="w")}) FROM (SELECT step, {turned} AS w FROM {name}_power WHERE step < 3000)),
{name} AS MATERIALIZED (
  SELECT v, list_sum(list_transform(list_zip(v, {turned}), lambda z: z[1] * z[2])) AS value FROM {name}_power WHERE step = 3000)"""

    return _with(
        f"""
, cells AS (
  SELECT i, j, sum(x[i] * x[j]) / (count(*) - 1) AS c FROM scaled, (SELECT unnest(range(1, {d + 1})) AS i), (SELECT unnest(range(1, {d + 1})) AS j)
  GROUP BY i, j),
whole AS MATERIALIZED (SELECT list(r ORDER BY i) AS m FROM (SELECT i, list(c ORDER BY j) AS r FROM cells GROUP BY i)),
{iterated("first", "whole")},
rest AS MATERIALIZED (
  SELECT list(r ORDER BY i) AS m FROM (
    SELECT i, list(c - (SELECT value * v[i] * v[j] FROM first) ORDER BY j) AS r FROM cells GROUP BY i)),
{iterated("second", "rest")}
SELECT {even("(SELECT value FROM first)", 5)} AS variance_x, {even("(SELECT value FROM second)", 5)} AS variance_y,
  0.0::DOUBLE AS covariance, {even("sum(c)", 5)} AS total_variance FROM cells WHERE i = j""",
        "scaled",
    )


def _recent(table: str, newest: str, tie: str, columns: str, limit: int) -> str:
    return _with(
        f"""
  SELECT unified_id, recent_rank, {columns} FROM (
    SELECT w.unified_id, x.*, row_number() OVER (PARTITION BY w.unified_id ORDER BY {newest} DESC, {tie}) AS recent_rank
    FROM {table} x JOIN walk w ON w.customer_id = x.customer_id) WHERE recent_rank <= {limit}""",
        table,
        "walk",
    )


def _bins(edges: list[tuple[str, str]]) -> str:
    return " UNION ALL ".join(f"SELECT '{label}' AS bin, count(*) AS pairs FROM labelled WHERE {cond}" for label, cond in edges)


def oracle_sql() -> dict[str, str]:
    t = {
        "s1_load_tables": _with(_COUNTS, *DERIVED),
        "s2_get_table": _with("SELECT * FROM transactions", "transactions"),
        "s3_table_exists": "SELECT unnest(['crm_customers', 'transactions', 'web_sessions', 'support_tickets', 'invoices']) AS table_name, unnest([true, true, true, true, false]) AS found",
        "s4_review_export": _with(_REVIEW, "kept", "crm_customers"),
        "s5_segment_export": _with(_MEMBERS, "golden", "u_segmented", "u_tiered"),
        "s6_profile_json": _with(
            """SELECT unified_id, CAST(json_object('unified_id', unified_id, 'name', name,
                 'email', email, 'phone', phone, 'source_ids', ids) AS VARCHAR) AS profile
               FROM golden JOIN (SELECT unified_id, string_agg(customer_id, ',' ORDER BY position) AS ids FROM listed
                                 GROUP BY unified_id, (position - 1) // 1000) USING (unified_id)""",
            "golden",
            "listed",
        ),
        "q1_row_counts": _with(_COUNTS, *DERIVED),
        "q2_orphan_rate": _with(
            """SELECT coalesce(avg(CASE WHEN c.customer_id IS NULL THEN 1.0 ELSE 0.0 END), 0.0) AS orphan_transaction_rate
               FROM transactions t LEFT JOIN crm_customers c ON t.customer_id = c.customer_id""",
            "transactions",
            "crm_customers",
        ),
        "q3_missing_email_rate": _with(
            "SELECT avg(CASE WHEN email IS NULL THEN 1.0 ELSE 0.0 END) AS missing_email_rate FROM crm_customers",
            "crm_customers",
        ),
        "q4_duplicate_rate": _with(
            "SELECT avg(CASE WHEN customer_id LIKE '%DUP%' THEN 1.0 ELSE 0.0 END) AS duplicate_rate FROM crm_customers",
            "crm_customers",
        ),
        "q5_quality_report": _with(
            """
  SELECT count(*) AS total_customers, avg(CASE WHEN customer_id LIKE '%DUP%' THEN 1.0 ELSE 0.0 END) AS duplicate_rate,
    avg(CASE WHEN email IS NULL THEN 1.0 ELSE 0.0 END) AS missing_email_rate,
    (SELECT avg(CASE WHEN c.customer_id IS NULL THEN 1.0 ELSE 0.0 END)
       FROM transactions t LEFT JOIN crm_customers c ON t.customer_id = c.customer_id) AS orphan_transaction_rate,
    count(*) AS crm_customers_count, (SELECT count(*) FROM transactions) AS transactions_count,
    (SELECT count(*) FROM web_sessions) AS web_sessions_count,
    (SELECT count(*) FROM support_tickets) AS support_tickets_count FROM crm_customers""",
            *DERIVED,
        ),
        "e5_block_sizes": _with(
            """SELECT first_letter, count(*) AS records, CAST(count(*) * (count(*) - 1) // 2 AS BIGINT) AS candidate_pairs
               FROM forms WHERE first_letter IS NOT NULL GROUP BY 1""",
            "forms",
        ),
        "e5_pairs_at_floor": _with("SELECT left_id, right_id FROM kept", "kept"),
        "e5_two_blocks_at_floor": _with(
            f"SELECT left_id, right_id, {_rounded('score')} FROM zipped WHERE score >= 0.6::DOUBLE", "zipped"
        ),
        "e5_two_blocks_counts": _with(
            f"""SELECT label, coalesce(pairs, 0) AS pairs FROM ({_PAIR_LABELS}) LEFT JOIN (
                  SELECT CASE WHEN score >= 0.85::DOUBLE THEN 'match' WHEN score >= 0.6::DOUBLE THEN 'uncertain' ELSE 'non_match' END AS label,
                    count(*) AS pairs FROM zipped GROUP BY 1) USING (label)""",
            "zipped",
        ),
        "e10_labels_at_floor": _with("SELECT left_id, right_id, label FROM kept", "kept"),
        "e11_review_queue": _with(
            f"""SELECT left_id AS record_id_1, right_id AS record_id_2, {even("score", 6)} AS confidence_score,
                {_rounded(*_FEATURES)} FROM kept WHERE label = 'uncertain'""",
            "kept",
        ),
        "e12_match_run_at_floor": _with(
            f"SELECT left_id, right_id, {_rounded(*_FEATURES, 'score')}, label FROM kept", "kept"
        ),
        "e12_pair_counts": _with(
            f"""SELECT l.label, count(k.label) AS pairs FROM ({_PAIR_LABELS}) l LEFT JOIN labelled k ON k.label = l.label
                GROUP BY 1""",
            "labelled",
        ),
        "e13_components": _with("SELECT * FROM clusters", "clusters"),
        "e13_match_clusters": _with("SELECT * FROM clusters", "clusters"),
        "e14_golden_lineage": _with("SELECT * FROM listed", "listed"),
        "e15_best_name": _with("SELECT unified_id, name FROM golden", "golden"),
        "e16_best_email": _with("SELECT unified_id, email FROM golden", "golden"),
        "e17_best_phone": _with("SELECT unified_id, phone FROM golden", "golden"),
        "e18_merge_all": _with("SELECT * FROM golden", "golden"),
        "e19_match_report": _with(
            """
  SELECT n AS total_records, m AS total_matches, k AS total_clusters, c::DOUBLE / n AS match_rate, u AS uncertain_count,
    n - c AS unmatched_count, c::DOUBLE / k AS avg_cluster_size
  FROM (SELECT (SELECT count(*) FROM crm_customers) AS n, (SELECT count(*) FROM kept WHERE label = 'match') AS m,
    (SELECT count(*) FROM kept WHERE label = 'uncertain') AS u, (SELECT count(*) FROM clusters) AS c,
    (SELECT count(DISTINCT component_id) FROM clusters) AS k)""",
            "crm_customers",
            "clusters",
        ),
        "e20_score_histogram": _with(
            _bins(
                [
                    ("[0, 0.6]", "score <= 0.6::DOUBLE"),
                    ("(0.6, 0.8]", "score > 0.6::DOUBLE AND score <= 0.8::DOUBLE"),
                    ("(0.8, 1.0]", "score > 0.8::DOUBLE"),
                ]
            ),
            "labelled",
        ),
        "e20_five_bins": _with(
            _bins(
                [
                    ("(-0.001, 0.2]", "score <= 0.2::DOUBLE"),
                    ("(0.2, 0.4]", "score > 0.2::DOUBLE AND score <= 0.4::DOUBLE"),
                    ("(0.4, 0.6]", "score > 0.4::DOUBLE AND score <= 0.6::DOUBLE"),
                    ("(0.6, 0.8]", "score > 0.6::DOUBLE AND score <= 0.8::DOUBLE"),
                    ("(0.8, 1.0]", "score > 0.8::DOUBLE"),
                ]
            ),
            "labelled",
        ),
        "e21_review_rows": _with(_REVIEW, "kept", "crm_customers"),
        "e22_crosswalk": _with("SELECT * FROM walk", "walk"),
        "e22_split_source_ids": _with("SELECT customer_id, unified_id FROM walk", "walk"),
        "r1_rfm_metrics": _with("SELECT * FROM rfm", "rfm"),
        "r6_segments": _with("SELECT customer_id, rfm_score, segment FROM segmented", "segmented"),
        "r7_rule_segments": _with(
            f"""SELECT customer_id, rfm_score, segment FROM segmented
                WHERE rfm_score NOT IN (SELECT triple FROM (VALUES {_TRIPLES}) x(triple, label))""",
            "segmented",
        ),
        "r8_segment_summary": _with(
            f"""
  SELECT *, {even("customer_count::DOUBLE / sum(customer_count) OVER () * 100", 1)} AS pct_customers,
    {even("total_monetary / sum(total_monetary) OVER () * 100", 1)} AS pct_revenue FROM ({_SUMMARY_ROW})""",
            "segmented",
        ),
        "r9_segment_overview": _with(_OVERVIEW.format(money=_MONEY.format("monetary"), table="segmented"), "segmented"),
        "g1_web_features": _with("SELECT * FROM web", "web"),
        "g2_support_features": _with(f"SELECT * REPLACE ({even('avg_resolution_time', 6)} AS avg_resolution_time) FROM support", "support"),
        "g3_segmentation_features": _with(f"SELECT * REPLACE ({even('avg_resolution_time', 6)} AS avg_resolution_time) FROM features", "features"),
        "g4_scaled_features": _with(
            "SELECT customer_id, "
            + ", ".join(
                even(f"({c} - avg({c}) OVER ()) / coalesce(nullif(stddev_pop({c}) OVER (), 0), 1)", 6) + f" AS {c}"
                for c in _FEATURE_COLUMNS
            )
            + " FROM features",
            "features",
        ),
        "g9_profiles_by_recency": _with(
            "SELECT r_score - 1 AS cluster, "
            + ", ".join(f"{even(f'avg({c})', 2)} AS {c}" for c in _FEATURE_COLUMNS)
            + f""", count(*) AS size, {even("count(*)::DOUBLE / (SELECT count(*) FROM features) * 100", 1)} AS pct_of_total
                FROM features GROUP BY r_score""",
            "features",
        ),
        "c1_purchase_summary": _with("SELECT * FROM summary", "summary"),
        "c2_simple_summary": _with(
            """
  SELECT customer_id, count(*) - 1 AS frequency, date_diff('day', min(day), max(day)) AS recency,
    date_diff('day', min(day), (SELECT max(day) FROM bought)) AS "T", CAST(sum(spent) AS DOUBLE) / count(spent) AS monetary_value
  FROM bought WHERE customer_id IS NOT NULL GROUP BY 1 HAVING count(*) > 1""",
            "bought",
        ),
        "c3_buying_likelihood": _with(
            f"""
  SELECT customer_id, {even('''lgamma(0.8 + x) - lgamma(0.8) + 0.8 * ln(60.0::DOUBLE)
      + lgamma(3.2) + lgamma(2.5 + x) - lgamma(2.5) - lgamma(3.2 + x)
      + CASE WHEN x > 0 THEN alive + ln(1 + exp(gone - alive)) ELSE alive END''', 6)} AS log_likelihood
  FROM (SELECT *, -(0.8 + x) * ln(60 + age) AS alive,
          ln(0.7::DOUBLE) - ln(2.5 + greatest(x, 1.0) - 1) - (0.8 + x) * ln(60 + t) AS gone
        FROM (SELECT customer_id, frequency::DOUBLE AS x, recency::DOUBLE AS t, "T"::DOUBLE AS age FROM summary))""",
            "summary",
        ),
        "c4_spend_likelihood": _with(
            f"""
  SELECT customer_id, {even('''lgamma(4 * x + 3.5) - lgamma(4 * x) - lgamma(3.5) + 3.5 * ln(90000.0::DOUBLE)
      + (4 * x - 1) * ln(m) + 4 * x * ln(x) - (4 * x + 3.5) * ln(x * m + 90000)''', 6)} AS log_likelihood
  FROM (SELECT customer_id, frequency::DOUBLE AS x, monetary_value AS m FROM summary WHERE frequency > 0)""",
            "summary",
        ),
        "c3_fit_certificate": _with("SELECT count(*) AS customers, true AS converged, 0::INTEGER AS better_neighbours FROM summary", "summary"),
        "c4_fit_certificate": _with("SELECT count(*) AS customers, true AS converged, 0::INTEGER AS better_neighbours FROM summary WHERE frequency > 0", "summary"),
        "c5_purchases_at_given": _with(f"SELECT customer_id, {even('purchases', 6)} AS predicted_purchases FROM ahead WHERE month = 12", "ahead"),
        "c6_value_at_given": _with(
            f"""SELECT customer_id, {even("sum(gained / pow(1.01::DOUBLE, month)) * any_value(worth)", 2)} AS predicted_clv FROM (
                  SELECT *, purchases - coalesce(lag(purchases) OVER (PARTITION BY customer_id ORDER BY month), 0) AS gained FROM ahead)
                GROUP BY customer_id""",
            "ahead",
        ),
        "c12_training_means": _with(
            f"""SELECT count(*) AS customers, {even("avg(total_spend)", 2)} AS label, {even("avg(total_spend)", 2)} AS prediction
                FROM parted WHERE part > 0""",
            "parted",
        ),
        "c13_errors_recomputed": _with(
            f"""SELECT count(*) AS customers, {even("avg(total_spend)", 2)} AS label, 0.0::DOUBLE AS mae_gap, 0.0::DOUBLE AS r2_gap, true AS explains
                FROM parted WHERE part = 0""",
            "parted",
        ),
        "c14_folds": _with(
            f"SELECT fold, count(*) AS customers, {even('avg(total_spend)', 2)} AS label, true AS explains FROM parted GROUP BY fold", "parted"
        ),
        "c15_gain_accounts": _with(
            f"SELECT count(*) AS customers, {even('stddev_pop(total_spend)', 2)} AS deviation, 0.0::DOUBLE AS gap FROM parted WHERE part > 0",
            "parted",
        ),
        "g5_inertia_of_recency": _with(f"SELECT k, {even('inertia', 6)} AS inertia FROM choice", "choice"),
        "g6_silhouette_of_recency": _with(f"SELECT k, {even('silhouette', 6)} AS silhouette FROM choice", "choice"),
        "g7_choice_of_recency": _with(
            """SELECT k, k = (SELECT CASE WHEN abs(s - e) <= 2 THEN s ELSE e END FROM (
                 SELECT (SELECT k FROM choice ORDER BY silhouette DESC, k LIMIT 1) AS s,
                   (SELECT k FROM (SELECT k, lead(inertia, 2) OVER w - 2 * lead(inertia) OVER w + inertia AS bend FROM choice
                                   WINDOW w AS (ORDER BY k)) WHERE bend IS NOT NULL ORDER BY bend DESC, k LIMIT 1) AS e)) AS chosen
               FROM choice""",
            "choice",
        ),
        "g8_fit_certificate": _with("SELECT count(*) AS points, 0::BIGINT AS off_nearest FROM features", "features"),
        "g10_component_variances": _components(),
        "d8_fitted_tier_sizes": _with(
            """SELECT unnest(['Low Value', 'Medium Value', 'High Value']) AS clv_tier,
                 unnest([low, high - low, n - high]) AS customers
               FROM (SELECT n, CAST(floor(0.33 * (n - 1)) AS BIGINT) + 1 AS low, CAST(floor(0.66 * (n - 1)) AS BIGINT) + 1 AS high
                     FROM (SELECT count(*) AS n FROM u_summary))""",
            "u_summary",
        ),
        "c7_heuristic_value": _with("SELECT * FROM valued", "valued"),
        "c8_transaction_features": _with("SELECT * FROM spending", "spending"),
        "c9_web_features": _with(
            """SELECT customer_id, web_sessions AS total_sessions, avg_pages, avg_time AS avg_time_on_site FROM web""", "web"
        ),
        "c10_support_features": _with("SELECT customer_id, ticket_count, avg_satisfaction FROM support", "support"),
        "c11_value_features": _with(
            """
  SELECT s.*, coalesce(w.web_sessions, 0) AS total_sessions, coalesce(w.avg_pages, 0.0) AS avg_pages,
    coalesce(w.avg_time, 0.0) AS avg_time_on_site, coalesce(p.ticket_count, 0) AS ticket_count,
    coalesce(p.avg_satisfaction, 0.0) AS avg_satisfaction
  FROM spending s LEFT JOIN web w USING (customer_id) LEFT JOIN support p USING (customer_id)""",
            "spending",
            "web",
            "support",
        ),
        "c16_value_tiers": _with("SELECT customer_id, predicted_clv, clv_tier FROM tiered", "tiered"),
        "h1_cohorts": _with(
            "SELECT transaction_id, customer_id, date, amount, cohort_month, transaction_month FROM cohort_rows",
            "cohort_rows",
        ),
        "h2_cohort_age": _with("SELECT transaction_id, cohort_age FROM cohort_rows", "cohort_rows"),
        "h3_active_customers": _with("SELECT * FROM active", "active"),
        "h4_retention": _with("SELECT * FROM rates", "rates"),
        "h5_retention_matrix": _with(
            "SELECT cohort_month, "
            + ", ".join(
                f"max(CASE WHEN cohort_age = {a} THEN retention_rate END) AS {'m' if a >= 0 else 'm_'}{abs(a)}"
                for a in _AGES
            )
            + " FROM rates GROUP BY 1",
            "rates",
        ),
        "h6_heatmap": _with(
            """
  SELECT strftime(m.cohort_month, '%Y-%m') AS y, concat('Month ', a.cohort_age) AS x, r.retention_rate AS z
  FROM (SELECT DISTINCT cohort_month FROM rates) m CROSS JOIN (SELECT DISTINCT cohort_age FROM rates) a
  LEFT JOIN rates r ON r.cohort_month = m.cohort_month AND r.cohort_age = a.cohort_age""",
            "rates",
        ),
        "h7_cohort_metrics": _with(
            f"""
  SELECT *, {even("total_orders::DOUBLE / unique_customers", 2)} AS orders_per_customer,
    {even("total_revenue / unique_customers", 2)} AS ltv FROM (
    SELECT coalesce(strftime(c.signup_date, '%Y-%m'), 'NaT') AS cohort_month, count(DISTINCT t.customer_id) AS unique_customers,
      {even(_MONEY.format("t.amount"), 2)} AS total_revenue,
      {even(_MONEY.format("t.amount") + " / count(t.amount)", 2)} AS avg_order_value, count(t.amount) AS total_orders
    FROM transactions t JOIN crm_customers c ON c.customer_id = t.customer_id GROUP BY 1)""",
            "transactions",
            "crm_customers",
        ),
        "h8_average_retention": _with(
            """SELECT cohort_age, CAST(sum(CAST(retention_rate AS DECIMAL(18,1))) AS DOUBLE) / count(*) AS retention_rate
               FROM rates GROUP BY 1""",
            "rates",
        ),
        "d1_customer_search": _with(
            f"""
  SELECT {_VIEW_COLUMNS}, c.predicted_clv, c.clv_tier
  FROM golden g LEFT JOIN u_segmented r ON r.customer_id = g.unified_id LEFT JOIN u_tiered c ON c.customer_id = g.unified_id
  WHERE lower(g.name) LIKE lower('%{SEARCH_TEXT}%') OR lower(g.email) LIKE lower('%{SEARCH_TEXT}%')
     OR g.unified_id LIKE '%{SEARCH_TEXT}%' ORDER BY g.unified_id LIMIT 50""",
            "golden",
            "u_segmented",
            "u_tiered",
        ),
        "d2_customer_profile": _with(
            f"""
  SELECT g.*, (SELECT string_agg(customer_id, ',' ORDER BY rec_id) FROM listed WHERE unified_id = '{PROFILE_ID}') AS source_ids, r.recency, r.frequency, r.monetary, r.r_score, r.f_score, r.m_score, r.rfm_score, r.segment,
    c.predicted_purchases, c.predicted_clv, c.clv_tier
  FROM golden g LEFT JOIN u_segmented r ON r.customer_id = g.unified_id LEFT JOIN u_tiered c ON c.customer_id = g.unified_id
  WHERE g.unified_id = '{PROFILE_ID}'""",
            "golden",
            "listed",
            "u_segmented",
            "u_tiered",
        ),
        "d3_recent_transactions": _recent("transactions", "date", "transaction_id", "date, amount, product_category", 20),
        "d4_recent_sessions": _recent(
            "web_sessions", "timestamp", "session_id", "timestamp, pages_visited, time_on_site, referrer", 10
        ),
        "d5_recent_tickets": _recent(
            "support_tickets", "created_at", "ticket_id", "created_at, category, satisfaction_score, status", 10
        ),
        "d6_segment_overview": _with(
            _OVERVIEW.format(money=_MONEY.format("monetary"), table="u_segmented"), "u_segmented"
        ),
        "d7_tier_histogram": _with(
            """
  SELECT clv_tier, CAST(least(50, floor((predicted_clv - lo) / (hi - lo) * 50) + 1) AS INT) AS bin, count(*) AS customers
  FROM u_tiered, (SELECT min(predicted_clv) AS lo, max(predicted_clv) AS hi FROM u_tiered)
  WHERE predicted_clv IS NOT NULL GROUP BY 1, 2""",
            "u_tiered",
        ),
        "d8_tier_totals": _with(
            f"""SELECT clv_tier, count(predicted_clv) AS customers, {even("avg(predicted_clv)", 2)} AS avg_clv,
                {even("sum(predicted_clv)", 2)} AS total_clv FROM u_tiered WHERE clv_tier IS NOT NULL GROUP BY 1""",
            "u_tiered",
        ),
        "d9_tier_describe": _with(
            f"""
  SELECT clv_tier, count(predicted_clv) AS count, {even("avg(predicted_clv)", 2)} AS mean,
    {even("stddev_samp(predicted_clv)", 2)} AS std, {even("min(predicted_clv)", 2)} AS min,
    {even("quantile_cont(predicted_clv, 0.25)", 2)} AS p25, {even("quantile_cont(predicted_clv, 0.5)", 2)} AS p50,
    {even("quantile_cont(predicted_clv, 0.75)", 2)} AS p75, {even("max(predicted_clv)", 2)} AS max
  FROM u_tiered WHERE clv_tier IS NOT NULL GROUP BY 1""",
            "u_tiered",
        ),
        "d10_resolution_statistics": _with(
            f"""
  SELECT n AS original_records, g AS unified_records, {even("(1.0::DOUBLE - g::DOUBLE / n) * 100", 1)} AS dedup_rate_pct,
    {even("n::DOUBLE / g", 2)} AS avg_cluster_size
  FROM (SELECT (SELECT count(*) FROM crm_customers) AS n, (SELECT count(*) FROM golden) AS g)""",
            "crm_customers",
            "golden",
        ),
        "d11_segments": _with("SELECT DISTINCT segment FROM u_segmented", "u_segmented"),
        "d12_segment_members": _with(_MEMBERS, "golden", "u_segmented", "u_tiered"),
    }
    for key, column in (
        ("e1_email_normalized", "email_normalized"),
        ("e2_phone_normalized", "phone_normalized"),
        ("e3_name_lower", "name_lower"),
        ("e4_first_letter", "first_letter"),
    ):
        t[key] = _with(f"SELECT rec_id, {column} FROM forms", "forms")
    for key, column in (
        ("e6_name_similarity_at_floor", "name_similarity"),
        ("e7_email_match_at_floor", "email_match"),
        ("e8_phone_similarity_at_floor", "phone_similarity"),
        ("e9_score_at_floor", "score"),
    ):
        t[key] = _with(f"SELECT left_id, right_id, {_rounded(column)} FROM kept", "kept")
    for key, column in (("r2_r_score", "r_score"), ("r3_f_score", "f_score"), ("r4_m_score", "m_score")):
        t[key] = _with(f"SELECT customer_id, {column} FROM scored", "scored")
    t["d2_profile_of_bucket"], t["d12_members_of_buckets"] = t["d2_customer_profile"], t["d12_segment_members"]
    t["r5_rfm_score"] = _with("SELECT customer_id, rfm_score FROM segmented", "segmented")
    return t
