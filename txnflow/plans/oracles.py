"""SQL statements of the registered queries, for an independent engine (DuckDB).

They share nothing with the Spark code but the fixed values.
"""

from __future__ import annotations

KEYS = "l_orderkey, l_linenumber, l_partkey, l_suppkey"

RAW = """
SELECT CASE WHEN l_returnflag = 'R' AND l_linenumber % 2 = 0
            THEN concat('C', CAST(l_orderkey AS VARCHAR)) ELSE CAST(l_orderkey AS VARCHAR) END AS invoice,
       CAST(l_partkey AS VARCHAR) AS stockcode, p_name AS description,
       CASE WHEN l_orderkey % 97 = 0 THEN 'n/a' WHEN l_orderkey % 89 = 0 THEN NULL
            WHEN l_linenumber = 7 THEN '0.5'
            WHEN l_returnflag = 'R' AND l_linenumber % 2 = 0 AND l_orderkey % 3 <> 0
            THEN concat('-', CAST(CAST(l_quantity AS BIGINT) AS VARCHAR))
            ELSE CAST(CAST(l_quantity AS BIGINT) AS VARCHAR) END AS quantity,
       CASE WHEN l_orderkey % 101 = 0 THEN 'bad' WHEN l_orderkey % 103 = 0 THEN NULL
            ELSE concat(substr(CAST(o_orderdate AS VARCHAR), 1, 10), ' ',
                        lpad(CAST(l_orderkey % 24 AS VARCHAR), 2, '0'), ':00:00') END AS invoicedate,
       CASE WHEN l_partkey % 50 = 0 THEN '0.00'
            ELSE concat(CAST(CAST(floor(l_extendedprice / l_quantity / 100e0) AS BIGINT) AS VARCHAR), '.',
                 lpad(CAST(CAST(floor(l_extendedprice / l_quantity) AS BIGINT) % 100 AS VARCHAR), 2, '0')) END AS price,
       CASE WHEN o_custkey % 11 = 0 THEN NULL ELSE CAST(o_custkey AS VARCHAR) END AS customer_id,
       n_name AS country, l_orderkey, l_linenumber, l_partkey, l_suppkey
FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey
JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
"""

LINES = """
SELECT invoice, stock_code, description, quantity, invoice_date, price, customer_id, country,
       quantity * price AS total_amount,
       coalesce(CAST(extract(month FROM invoice_date) AS INT), 0) AS month,
       coalesce(CAST(extract(day FROM invoice_date) AS INT), 0) AS day,
       coalesce(CAST(extract(hour FROM invoice_date) AS INT), 0) AS hour,
       CASE WHEN quantity < 1 THEN 'low' WHEN quantity < 5 THEN 'medium' WHEN quantity < 20 THEN 'high'
            WHEN quantity < CAST('Infinity' AS DOUBLE) THEN 'bulk' ELSE 'unknown' END AS quantity_category,
       CAST(0 AS INT) AS high_value_customer, l_orderkey, l_linenumber, l_partkey, l_suppkey
FROM (SELECT invoice, stockcode AS stock_code, description,
             TRY_CAST(quantity AS DOUBLE) AS quantity, TRY_CAST(invoicedate AS TIMESTAMP) AS invoice_date,
             TRY_CAST(price AS DOUBLE) AS price, customer_id, country,
             l_orderkey, l_linenumber, l_partkey, l_suppkey
      FROM sales_raw
      WHERE coalesce(substr(lower(invoice), 1, 1), '') <> 'c' AND customer_id IS NOT NULL)
WHERE quantity > 0 AND price > 0
"""

BATCHED = f"""
SELECT *, CAST((row_number() OVER (ORDER BY {KEYS}) - 1) // 1000 AS BIGINT) AS batch_id FROM sales_lines
"""

# A save time for each batch, drawn from its own lines.
CATALOG = """
SELECT batch_id, concat('batch_', CAST(batch_id AS VARCHAR), '_', strftime(saved_at, '%Y%m%d_%H%M%S'), '.csv') AS file_name,
       saved_at
FROM (SELECT batch_id, TIMESTAMP '2025-05-29 00:00:00'
             + to_seconds(CAST(batch_id * 60 + max(l_partkey + l_suppkey) % 50 AS BIGINT)) AS saved_at
      FROM batched GROUP BY batch_id)
"""

FOLDED = """
SELECT l.*, CAST(CASE WHEN invoice_date IS NULL THEN 3 WHEN invoice_date <= c1 THEN 1
                      WHEN invoice_date <= c2 THEN 2 ELSE 3 END AS INT) AS fold
FROM sales_lines l,
     (SELECT min(CASE WHEN rn * 3 >= n THEN invoice_date END) AS c1,
             min(CASE WHEN rn * 3 >= 2 * n THEN invoice_date END) AS c2
      FROM (SELECT invoice_date, row_number() OVER (ORDER BY invoice_date) AS rn, count(*) OVER () AS n
            FROM sales_lines WHERE invoice_date IS NOT NULL)) cuts
"""



def split_by(*keys: str) -> str:
    """The side of a row by a hash of the text of its keys."""
    text = ", '|', ".join(f"CAST({key} AS VARCHAR)" for key in keys)
    return (f"CASE WHEN CAST(('0x' || substr(md5(concat('42|', {text})), 1, 8)) AS BIGINT) / 4294967296e0 < 0.8e0 "
            "THEN 'train' ELSE 'test' END AS split")


SPLIT = f"SELECT *, {split_by(*KEYS.split(', '))} FROM folded"

# Lines as three record files that overlap: each distinct record with the first file that has it.
RECORD_NAMES = ("invoice, stock_code, description, quantity, invoice_date, price, customer_id, country, total_amount, month, day, hour, "
                "quantity_category, high_value_customer")
FILES = f"""
SELECT {RECORD_NAMES}, min(f) AS fold FROM (
    SELECT *, 1 AS f FROM sales_lines WHERE month <= 4 UNION ALL SELECT *, 2 FROM sales_lines WHERE month BETWEEN 3 AND 8
    UNION ALL SELECT *, 3 FROM sales_lines WHERE month >= 8)
GROUP BY {RECORD_NAMES}
"""
FILE_SPLIT = f"SELECT *, {split_by('invoice', 'stock_code')} FROM record_files"

SPEND = """
SELECT customer_id, sum(total_amount) AS spend, count(*) AS lines FROM sales_lines GROUP BY customer_id
"""

CUSTOMERS = """
SELECT customer_id, spend, lines,
       CAST(spend > (SELECT quantile_cont(spend, 0.8) FROM spend) AS INT) AS high_value_customer
FROM spend
"""

LABELLED = """
SELECT l.* EXCLUDE (high_value_customer), c.high_value_customer
FROM sales_lines l JOIN customers c ON l.customer_id = c.customer_id
"""

_CTES = {
    "sales_raw": (RAW, ()),
    "sales_lines": (LINES, ("sales_raw",)),
    "batched": (BATCHED, ("sales_lines",)),
    "catalog": (CATALOG, ("batched",)),
    "folded": (FOLDED, ("sales_lines",)),
    "split_rows": (SPLIT, ("folded",)),
    "spend": (SPEND, ("sales_lines",)),
    "customers": (CUSTOMERS, ("spend",)),
    "labelled": (LABELLED, ("sales_lines", "customers")),
    "record_files": (FILES, ("sales_lines",)),
    "file_rows": (FILE_SPLIT, ("record_files",)),
}


def sql(body: str, *needs: str) -> str:
    """``body`` with the common table expressions it needs."""
    order: list[str] = []

    def visit(name: str) -> None:
        for other in _CTES[name][1]:
            visit(other)
        if name not in order:
            order.append(name)

    for name in needs:
        visit(name)
    ctes = ",\n".join(f"{name} AS MATERIALIZED ({_CTES[name][0]})" for name in order)
    return f"WITH {ctes}\n{body}"


def half_up(expression: str, digits: int) -> str:
    """Decimal rounding of the shortest text of a double, halves away from zero."""
    return f"CAST(round(CAST(CAST({expression} AS VARCHAR) AS DECIMAL(38, 18)), {digits}) AS DOUBLE)"


PEAK = "month IN (11, 12)"
OFFICE = "hour BETWEEN 9 AND 17"
AMOUNT_NAMES = "quantity,price,month,day,hour"
FULL_NAMES = "quantity,price,total_amount,month,day,hour"


def _factor(test: str, yes: str, no: str) -> str:
    return f"(CASE WHEN {test} THEN {yes}e0 ELSE {no}e0 END)"


def _envelope(model: str, version: int, names: str) -> str:
    return (
        f"{KEYS}, CAST(NULL AS VARCHAR) AS error, '{model}' AS model, '{names}' AS features_used, "
        f"CAST({version} AS INT) AS model_version"
    )


def score_amount(version: int) -> str:
    extra, value, confidence = "", "quantity * price", "0.85"
    if version == 2:
        season = _factor(PEAK, "1.2", "1.0")
        value, confidence, extra = f"{value} * {season}", "0.91", f", {season} AS seasonal_adjustment"
    if version == 3:
        season, hours = _factor(PEAK, "1.3", "1.0"), _factor(OFFICE, "1.1", "0.9")
        value, confidence = f"{value} * {season} * {hours}", "0.95"
        extra = f", {season} AS seasonal_adjustment, {hours} AS hourly_adjustment"
    return sql(
        f"SELECT {_envelope(f'linear_model_{version}', version, AMOUNT_NAMES)}, "
        f"{half_up(value, 2)} AS prediction, {confidence}e0 AS confidence{extra} FROM sales_lines",
        "sales_lines",
    )


def score_category(version: int) -> str:
    q, extra = "quantity", ""
    if version == 1:
        tests = ("quantity <= 1", "quantity <= 5", "quantity <= 20")
        own, other = ("0.75", "0.80", "0.85", "0.90"), ("0.2", "0.3", "0.3", "0.2")
    elif version == 2:
        tests = ("quantity <= 1 AND total_amount < 10", "quantity <= 5 AND total_amount < 50",
                 "quantity <= 20 AND total_amount < 200")
        own, other = ("0.82", "0.87", "0.90", "0.93"), ("0.15", "0.25", "0.35", "0.25")
        extra = ", TRUE AS amount_threshold_used"
    else:
        season, hours = _factor(PEAK, "1.2", "1.0"), _factor(OFFICE, "1.1", "0.9")
        q = f"(quantity * {season} * {hours})"
        tests = (f"{q} <= 1.2e0 AND total_amount < 12", f"{q} <= 6 AND total_amount < 60",
                 f"{q} <= 24 AND total_amount < 240")
        own, other = ("0.89", "0.92", "0.95", "0.97"), ("0.1", "0.2", "0.4", "0.3")
        extra = f", {season} AS seasonal_boost, {hours} AS time_boost, {half_up(q, 2)} AS adjusted_quantity"
    names = ("Low", "Medium", "High", "Bulk")
    cases = " ".join(f"WHEN {t} THEN '{n}'" for t, n in zip(tests, names))
    chances = ", ".join(
        f"CASE WHEN predicted_category = '{n}' THEN {a}e0 ELSE {b}e0 END AS {n.lower()}"
        for n, a, b in zip(names, own, other)
    )
    sure = " ".join(f"WHEN '{n}' THEN {a}e0" for n, a in zip(names, own))
    return sql(
        f"SELECT {_envelope(f'rf_model_window_{version}', version, FULL_NAMES)}, predicted_category, "
        f"CASE predicted_category {sure} END AS confidence, {chances}{extra} "
        f"FROM (SELECT *, CASE {cases} ELSE 'Bulk' END AS predicted_category FROM sales_lines)",
        "sales_lines",
    )


def score_high_value(version: int) -> str:
    if version == 1:
        body = (
            "total_amount > 50 AS is_high_value_customer, "
            f"{half_up('least(0.95e0, greatest(0.05e0, total_amount / 100))', 3)} AS probability, "
            "0.78e0 AS confidence, 50e0 AS threshold_used"
        )
        source = "sales_lines"
    else:
        scale, weight, cut, sure = ("75", "0.1", "0.5", "0.85") if version == 2 else ("60", "0.15", "0.45", "0.92")
        season, hours = _factor(PEAK, "0.3", "0"), _factor(OFFICE, "0.2", "0")
        total = f"total_amount / {scale} + quantity * {weight}e0"
        parts = ""
        if version == 3:
            total = f"{total} + {season} + {hours}"
            parts = f", {season} AS seasonal_bonus, {hours} AS time_bonus"
        chance = "(1 / (1 + exp(-s)))"
        body = (
            f"{chance} > {cut} AS is_high_value_customer, {half_up(chance, 3)} AS probability, "
            f"{sure}e0 AS confidence, {cut}e0 AS threshold, "
            f"{half_up(f'total_amount / {scale}', 3)} AS base_score, "
            f"{half_up(f'quantity * {weight}e0', 3)} AS quantity_bonus, "
            f"{half_up('s', 3)} AS final_score{parts}"
        )
        source = f"(SELECT *, {total} AS s FROM sales_lines)"
    return sql(
        f"SELECT {_envelope(f'logistic_model_batch_{version}', version, FULL_NAMES)}, {body} FROM {source}",
        "sales_lines",
    )


FEATURES = ("quantity", "price", "month", "day", "hour")


# The raw lines as requests; at noon the hour is sent as a word.
REQUESTS = f"""
SELECT {KEYS}, quantity, price, TRY_CAST(quantity AS DOUBLE) AS q, TRY_CAST(price AS DOUBLE) AS p, extract(month FROM t) AS month,
       extract(hour FROM t) AS hour, l_orderkey % 24 = 12 AS noon
FROM (SELECT *, TRY_CAST(invoicedate AS TIMESTAMP) AS t FROM sales_raw)
"""
_CTES["requests"] = (REQUESTS, ("sales_raw",))


def _request_error(version: int) -> str:
    """The error of an amount request: absent fields first, then values in the order they are read."""
    noon = "WHEN noon THEN 'invalid literal for int() with base 10: ''noon'''" if version == 3 else ""
    return f"""CASE WHEN quantity IS NULL THEN 'Missing field: quantity' WHEN price IS NULL THEN 'Missing field: price'
        WHEN month IS NULL THEN 'Missing field: month'
        WHEN q IS NULL THEN concat('could not convert string to float: ''', quantity, '''')
        WHEN p IS NULL THEN concat('could not convert string to float: ''', price, '''') {noon} END"""


def _request_amount(version: int) -> str:
    factors = ("", f" * {_factor(PEAK, '1.2', '1.0')}", f" * {_factor(PEAK, '1.3', '1.0')} * {_factor(OFFICE, '1.1', '0.9')}")
    return half_up(f"q * p{factors[version - 1]}", 2)


def request_errors() -> str:
    return sql("\nUNION ALL\n".join(f"""
    SELECT CAST({v} AS INT) AS version, CAST(CASE WHEN error IS NULL THEN 200 WHEN error LIKE 'Missing field: %' THEN 400 ELSE 500 END AS INT) AS status,
           error, count(*) AS requests
    FROM (SELECT {_request_error(v)} AS error FROM requests) GROUP BY error""" for v in (1, 2, 3)), "requests")


def compare_requests() -> str:
    columns = ", ".join(
        f"CASE WHEN e{v} IS NULL THEN v{v} END AS v{v}, CASE WHEN e{v} IS NULL THEN 'linear_model_{v}' END AS model_{v}, "
        f"CASE WHEN e{v} IS NULL THEN {sure}e0 END AS confidence_{v}" for v, sure in ((1, "0.85"), (2, "0.91"), (3, "0.95")))
    inner = ", ".join(f"{_request_error(v)} AS e{v}, {_request_amount(v)} AS v{v}" for v in (1, 2, 3))
    return sql(f"SELECT {KEYS}, CAST(200 AS INT) AS status, quantity AS input_quantity, price AS input_price, {columns} "
               f"FROM (SELECT *, {inner} FROM requests)", "requests")


def _least_squares(k: int, source: str = "split_rows") -> str:
    """Tables ``o<k>_<j>``: features made orthogonal one after the other on the train rows.

    The fitted value is the mean of the target plus its projections on them, so no
    matrix has to be solved. All rows get the values, coefficients use train rows only.
    """
    steps = [f"""o{k}_0 AS MATERIALIZED (
        SELECT s.*, total_amount AS y, {', '.join(f's.{f} - m.{f} AS z_{f}' for f in FEATURES)}, m.y AS fitted
        FROM {source} s, (SELECT avg(total_amount) AS y, {', '.join(f'avg({f}) AS {f}' for f in FEATURES)}
                            FROM {source} WHERE split = 'train' AND fold <= {k}) m
        WHERE fold <= {k})"""]
    for j, f in enumerate(FEATURES):
        later = FEATURES[j + 1:]
        shares = "".join(f", sum(z_{g} * z_{f}) / sum(z_{f} * z_{f}) AS b_{g}" for g in later)
        moved = "".join(f", z_{g} - b_{g} * z_{f} AS z_{g}" for g in later)
        gone = ", ".join(["fitted", *[f"z_{g}" for g in later]])
        steps.append(f"""o{k}_{j + 1} AS MATERIALIZED (
        SELECT t.* EXCLUDE ({gone}), fitted + c * z_{f} AS fitted{moved}
        FROM o{k}_{j} t, (SELECT sum(y * z_{f}) / sum(z_{f} * z_{f}) AS c{shares}
                          FROM o{k}_{j} WHERE split = 'train') b)""")
    return ",\n".join(steps)


def train_linear(source: str = "split_rows") -> str:
    head = sql("", source).rstrip()
    tables = ",\n".join(_least_squares(k, source) for k in (1, 2, 3))
    last = len(FEATURES)
    selects = "\nUNION ALL\n".join(f"""
    SELECT 'linear_model_{k}' AS model, 'trained' AS status,
           count(*) FILTER (split = 'train') AS train_rows, count(*) FILTER (split = 'test') AS test_rows,
           round(sqrt(avg((y - fitted) * (y - fitted)) FILTER (split = 'test')), 4) AS rmse,
           round(1 - (sum((y - fitted) * (y - fitted)) FILTER (split = 'test'))
                   / (var_pop(y) FILTER (split = 'test') * count(*) FILTER (split = 'test')), 6) AS r2
    FROM o{k}_{last}""" for k in (1, 2, 3))
    return f"{head},\n{tables}\n{selects}"


def model_score() -> str:
    head = sql("", "split_rows").rstrip()
    return f"{head},\n{_least_squares(3)}\nSELECT {KEYS}, round(fitted, 1) AS prediction FROM o3_{len(FEATURES)}"


def train_forest(minutes: int) -> str:
    """Rows of both sides in each time window; what the forest must fulfil is true."""
    return sql("\nUNION ALL\n".join(f"""
    SELECT 'rf_model_window_{k}' AS model, 'trained' AS status, count(*) FILTER (split = 'train') AS train_rows,
           count(*) FILTER (split = 'test') AS test_rows, TRUE AS agrees, TRUE AS beats_majority
    FROM split_rows WHERE invoice_date <= (SELECT min(invoice_date) FROM sales_lines) + to_minutes(CAST({k * minutes} AS BIGINT))"""
                                     for k in (1, 2, 3)), "split_rows")


def train_logistic() -> str:
    """Rows of both sides in the first batches and the share of the label; what an optimum must fulfil is true."""
    chosen = f"""(SELECT b.batch_id, c.high_value_customer AS y, {split_by(*[f'b.{key}' for key in KEYS.split(', ')])}
                  FROM batched b JOIN customers c ON b.customer_id = c.customer_id WHERE b.batch_id < 3)"""
    return sql("\nUNION ALL\n".join(f"""
    SELECT 'logistic_model_batch_{k}' AS model, 'trained' AS status, count(*) FILTER (split = 'train') AS train_rows,
           count(*) FILTER (split = 'test') AS test_rows, round(avg(y) FILTER (split = 'train'), 8) AS label_mean,
           TRUE AS mean_fits, TRUE AS products_fit
    FROM {chosen} WHERE batch_id < {k}""" for k in (1, 2, 3)), "batched", "customers")
