"""DuckDB SQL for every registered query, written against the shared transactions text.

Independent of the Spark code but for the fixed rule tables: dates go through format strings, means through
windows, and money through decimals.
"""

from __future__ import annotations

from salesmill.functions import rules
from salesmill.schemas import CLEAN_SCHEMA, RAW_COLUMNS
from salesmill.sources.star_schema import TRANSACTIONS_SQL

AS_OF = "DATE '2001-08-01'"
COUNT = "CAST(count(*) AS BIGINT)"


def q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


# -- text ---------------------------------------------------------------------------------------------------


def deleted(x: str, profile: str) -> str:
    return f"regexp_replace({x}, '[{rules.STRIPPED_CHARS[profile]}]', '', 'g')"


def replaced(x: str, profile: str) -> str:
    for old, new in rules.REPLACEMENTS[profile]:
        x = f"replace({x}, {q(old)}, {q(new)})"
    return x


def text(x: str, profile: str) -> str:
    if profile in rules.STRIPPED_CHARS:
        return f"trim({deleted(x, profile)})"
    x = f"trim({replaced(x, profile)})"
    if profile in ("chunked", "microbatch"):
        x = f"regexp_replace({x}, '\\s+', ' ', 'g')"
    return f"upper({x})" if profile == "microbatch" else x


# -- dates --------------------------------------------------------------------------------------------------


def first_format(x: str, *formats: str) -> str:
    return "CAST(coalesce(" + ", ".join(f"try_strptime({x}, {q(f)})" for f in formats) + ") AS DATE)"


def date(x: str, profile: str) -> str:
    if profile == "datamart":
        digits = f"CASE WHEN regexp_full_match({x}, '[0-9]{{8}}') THEN {first_format(x, '%Y%m%d')} END"
        return f"coalesce({first_format(x, '%Y-%m-%d', '%m/%d/%Y', '%d-%m-%Y')}, {digits})"
    if profile == "external":
        return first_format(deleted(x, profile), "%Y-%m-%d")
    if profile == "chunked":
        prefixes = [
            (r"^\d{4}-\d{1,2}-\d{1,2}", "%Y-%m-%d"), (r"^\d{1,2}/\d{1,2}/\d{4}", "%m/%d/%Y"),
            (r"^\d{1,2}-\d{1,2}-\d{4}", "%m-%d-%Y"), (r"^\d{8}", "%Y%m%d"),
        ]
        return "CASE " + " ".join(
            f"WHEN regexp_matches({x}, {q(p)}) THEN {first_format(f'regexp_extract({x}, {q(p)})', f)}" for p, f in prefixes
        ) + " END"
    if profile == "microbatch":
        return first_format(
            f"trim({x})", "%Y-%m-%d", "%m/%d/%Y", "%d-%m-%Y", "%Y%m%d", "%d/%m/%Y", "%m-%d-%Y", "%Y/%m/%d",
            "%Y-%m-%d %H:%M:%S", "%Y-%m-%dT%H:%M:%S",
        )
    return f"trim({x})"


def timestamp(x: str, profile: str) -> str:
    if profile == "datamart":
        return f"coalesce(try_strptime({x}, '%Y-%m-%d %H:%M:%S'), try_strptime({x}, '%Y-%m-%dT%H:%M:%S'))"
    if profile == "external":
        return f"try_strptime({deleted(x, profile)}, '%Y-%m-%d %H:%M:%S')"
    if profile == "lines":
        return x
    return f"CAST({date(x, profile)} AS TIMESTAMP)"


def modified(x: str, profile: str) -> str:
    if profile == "datamart":
        return f"coalesce({first_format(x, '%Y-%m-%d', '%m/%d/%Y', '%d-%m-%Y')}, {AS_OF})"
    return date(x, profile)


def month(x: str, profile: str) -> str:
    if profile == "lines":
        return (
            f"CASE WHEN length({x}) >= 4 THEN try_cast(substr({x}, 1, 4) || "
            f"CASE WHEN length({x}) >= 7 THEN substr({x}, 6, 2) ELSE '01' END AS INTEGER) END"
        )
    return f"CAST(year({x}) * 100 + month({x}) AS INTEGER)"


# -- numbers ------------------------------------------------------------------------------------------------


def long(x: str) -> str:
    return f"CASE WHEN regexp_full_match(trim({x}), '[+-]?[0-9]+') THEN try_cast({x} AS BIGINT) END"


def double(x: str) -> str:
    return f"try_cast({x} AS DOUBLE)"


def flag(condition: str) -> str:
    return f"CASE WHEN {condition} THEN 1 ELSE 0 END"


def total(x: str) -> str:
    """Exact: all money in the transactions has two decimals."""
    return f"CAST(sum(CAST({x} AS DECIMAL(18,2))) AS DOUBLE)"


def mean(x: str) -> str:
    return f"{total(x)} / count({x})"


# -- categories ---------------------------------------------------------------------------------------------


def category(x: str, column: str, profile: str) -> str:
    if profile == "datamart":
        table, test = rules.DATAMART_CATEGORIES[column], lambda vs: f"lower({x}) IN ({', '.join(map(q, vs))})"
        other = f"upper({text(x, profile)})" if column == "currency" else text(x, profile)
        other = f"coalesce({other}, {q(rules.DATAMART_DEFAULTS[column])})"
    elif column == "currency" or (profile == "microbatch" and column == "region"):
        return f"coalesce({x}, {q(rules.DEFAULT_CURRENCY if column == 'currency' else rules.DEFAULT_REGION)})"
    elif profile == "external":
        table, test = rules.EXTERNAL_CATEGORIES[column], lambda vs: " OR ".join(f"lower({x}) LIKE '%{v}%'" for v in vs)
        other = f"upper({text(x, profile)})"
        other = f"coalesce({other}, {q(rules.DEFAULT_REGION)})" if column == "region" else other
    else:
        key = f"trim(upper({x}))"
        table, test = rules.MICROBATCH_CATEGORIES[column], lambda vs: " OR ".join(f"contains({key}, {q(v)})" for v in vs)
        other = f"coalesce({key}, {q(rules.MISSING_CATEGORY)})"
    return "CASE " + " ".join(f"WHEN {test(vs)} THEN {q(label)}" for label, vs in table) + f" ELSE {other} END"


CATEGORY_COLUMNS = {
    "datamart": list(rules.DATAMART_CATEGORIES),
    "external": list(rules.EXTERNAL_CATEGORIES) + ["currency"],
    "microbatch": list(rules.MICROBATCH_CATEGORIES) + ["currency", "region"],
}

# -- whole rows ---------------------------------------------------------------------------------------------

FREE_TEXT = ["customer_id", "product_id", "warehouse", "notes", "created_by"]
NUMBERS = ["quantity", "unit_price", "total_amount", "discount_pct", "tax_amount"]
LINE_TEXT = [c for c in RAW_COLUMNS if c not in NUMBERS + ["transaction_id", "date", "timestamp", "modified_date"]]
KEYS = ["AnioMes", "region", "product_id", "product_category"]

RAW = f"raw AS ({TRANSACTIONS_SQL})"
# The same rows after a trip through comma-joined lines.
LINES = "lines AS (SELECT " + ", ".join(f"trim(coalesce({c}, '')) AS {c}" for c in RAW_COLUMNS) + " FROM raw)"


def default(x: str, column: str) -> str:
    return f"coalesce({x}, {q(rules.DATAMART_DEFAULTS[column])})"


def row_columns(p: str) -> dict[str, str]:
    out = {c: c for c in RAW_COLUMNS}
    if p == "datamart":
        out |= {c: default(text(c, p), c) for c in FREE_TEXT}
        out["transaction_id"] = default("trim(transaction_id)", "transaction_id")
    elif p in ("external", "microbatch"):
        out |= {c: text(c, p) for c in ["transaction_id"] + FREE_TEXT}
    else:
        out |= {c: text(c, p) for c in LINE_TEXT}
    out |= {c: category(c, c, p) for c in CATEGORY_COLUMNS.get(p, [])}
    out |= {c: double(c) for c in NUMBERS[1:]}
    if p in ("datamart", "external"):
        out["quantity"] = long("quantity")
    elif p == "lines":
        out["quantity"] = double("quantity")
    else:
        out["quantity"] = f"CAST(trunc({double('quantity')}) AS BIGINT)"
    out["date"], out["timestamp"] = date("date", p), timestamp("timestamp", p)
    out["modified_date"] = modified("modified_date", p)
    missing = {"microbatch": "quantity IS NULL", "lines": f"quantity <> '' AND {double('quantity')} IS NULL"}
    out["quantity_null"] = flag(missing.get(p, f"{out['quantity']} IS NULL"))
    out["price_missing"] = f"unit_price <> '' AND {double('unit_price')} IS NULL" if p == "lines" else f"{double('unit_price')} IS NULL"
    return out


def rows(p: str) -> str:
    """CTE `rows`: cleaned and derived, before imputation."""
    source = "lines" if p == "lines" else "raw"
    where = "WHERE transaction_id IS NOT NULL" if p in ("datamart", "external") else ""
    select = ", ".join(f"{e} AS {c}" for c, e in row_columns(p).items())
    dated = "WHERE date IS NOT NULL" if p in ("datamart", "external") else ""
    lines_cte = f"{LINES}, " if p == "lines" else ""
    return (
        f"{lines_cte}typed AS (SELECT {select} FROM {source} {where}), "
        f"rows AS (SELECT *, {month('date', p)} AS AnioMes FROM typed {dated})"
    )


def window_mean(keys: list[str], price: str = "unit_price") -> str:
    over = f"OVER (PARTITION BY {', '.join(keys)})" if keys else "OVER ()"
    s, n = f"sum(CAST({price} AS DECIMAL(18,2))) {over}", f"count({price}) {over}"
    return f"CASE WHEN {n} > 0 THEN CAST({s} AS DOUBLE) / {n} END"


def filled(p: str) -> str:
    """CTEs `rows` and `filled`: with `unit_price_imput` and `impute_level`."""
    levels = [KEYS[:3], KEYS[:2] + KEYS[3:], KEYS[:2], []]
    price = "unit_price"
    if p == "lines":
        levels, price = levels[:1], "nullif(unit_price, 0)"
    null_safe = {"datamart": KEYS, "chunked": KEYS[1:]}.get(p, [])
    means = []
    for keys in levels:
        tests = [f"{k} IS NOT NULL" for k in keys if k not in null_safe]
        tests += [f"{k} <> {'0' if k == 'AnioMes' else q('')}" for k in keys if p == "lines"]
        means.append(f"CASE WHEN {' AND '.join(tests) or 'true'} THEN {window_mean(keys, price)} END")
    named = ", ".join(f"{m} AS m{i}" for i, m in enumerate(means, 1))
    fill = "coalesce(" + ", ".join(f"m{i}" for i in range(1, len(means) + 1)) + ")"
    level = "CASE WHEN NOT price_missing THEN 0 " + " ".join(f"WHEN m{i} IS NOT NULL THEN {i}" for i in range(1, len(means) + 1)) + " END"
    present = "NULL" if p == "external" else "unit_price"
    return (
        f"{rows(p)}, meant AS (SELECT *, {named} FROM rows), "
        f"filled AS (SELECT *, CASE WHEN price_missing THEN {fill} ELSE {present} END AS unit_price_imput, {level} AS impute_level FROM meant)"
    )


def clean(p: str) -> str:
    """CTEs up to `clean`: the 24 columns of profile `p`."""
    names = ", ".join(CLEAN_SCHEMA.names)
    if p == "microbatch":
        return f"{rows(p)}, clean AS (SELECT {names.replace('unit_price_imput', 'CAST(NULL AS DOUBLE) AS unit_price_imput')} FROM rows)"
    kept = f"WHERE transaction_id <> {q(rules.UNKNOWN_ID)}" if p == "datamart" else ""
    return f"{filled(p)}, clean AS (SELECT {names} FROM filled {kept})"


def over(ctes: str, select: str) -> str:
    return f"WITH {RAW}, {ctes} {select}" if ctes else f"WITH {RAW} {select}"


# The finished table without imputed prices.
MART = f"{rows('datamart')}, mart AS (SELECT * FROM rows WHERE transaction_id <> {q(rules.UNKNOWN_ID)})"


def mart(select: str) -> str:
    return over(MART, select)


# -- statistics and dashboard -------------------------------------------------------------------------------

COUNTS = (
    f"{COUNT} AS {{rows}}, count(DISTINCT customer_id) AS unique_customers, count(DISTINCT product_id) AS unique_products, "
    "count(DISTINCT region) AS unique_regions, min(date) AS earliest_date, max(date) AS latest_date"
)
MONEY = f"{mean('unit_price')} AS avg_unit_price, {mean('total_amount')} AS avg_total_amount, {total('total_amount')} AS total_revenue"
STATS = {
    "external": COUNTS.format(rows="total_rows") + f", {MONEY}, count(*) FILTER (unit_price IS NULL) AS null_prices, count(*) FILTER (quantity IS NULL) AS null_quantities",
    "pipeline": COUNTS.format(rows="total_rows") + f", avg(quantity) AS avg_quantity, {MONEY}",
    "dashboard": COUNTS.format(rows="total_transactions") + f", avg(quantity) AS avg_quantity, {MONEY}",
    "short": (
        f"{COUNT} AS total_registros, count(DISTINCT customer_id) AS clientes_unicos, count(DISTINCT product_id) AS productos_unicos, "
        "count(DISTINCT region) AS regiones, min(date) AS fecha_inicio, max(date) AS fecha_fin, "
        f"{mean('total_amount')} AS monto_promedio, {total('total_amount')} AS monto_total"
    ),
    "smoke": f"{COUNT} AS total_rows, {mean('unit_price')} AS avg_price",
    "count": f"{COUNT} AS total",
}

REVENUE = f"coalesce({total('total_amount')}, 0) AS revenue"
QUANTITY = "CAST(coalesce(sum(quantity), 0) AS BIGINT) AS quantity"
TRANSACTIONS = "count(transaction_id) AS transactions"
CUSTOMERS = "count(DISTINCT customer_id) AS customers"


def groups(key: str, *measures: str, limit: int | None = None) -> str:
    tail = f" ORDER BY revenue DESC, {key} LIMIT {limit}" if limit else ""
    return mart(f"SELECT {key}, {', '.join(measures)} FROM mart WHERE {key} IS NOT NULL GROUP BY {key}{tail}")


def shared(key: str, measure: str, *measures: str) -> str:
    inner = f"SELECT {key}, {', '.join(measures)} FROM mart WHERE {key} IS NOT NULL GROUP BY {key}"
    whole = f"(SELECT CAST(sum(CAST({measure} AS DECIMAL(38,2))) AS DOUBLE) FROM g)"
    return over(f"{MART}, g AS ({inner})", f"SELECT *, {measure} / {whole} * 100 AS share_pct FROM g")


def histogram(column: str, bins: int, extra: str = "") -> str:
    width = f"((SELECT max({column}) - min({column}) FROM mart) / {bins})"
    lo = f"(SELECT min({column}) FROM mart)"
    bin_no = f"least(CAST(floor(({column} - {lo}) / {width}) AS INTEGER), {bins - 1})"
    return over(
        f"{MART}, h AS (SELECT {bin_no} AS bin, {COUNT} AS n FROM mart WHERE {column} IS NOT NULL GROUP BY 1)",
        f"SELECT bin, {lo} + bin * {width} AS bin_from, n{extra.format(lo=lo, width=width)} FROM h",
    )


def unpivoted(select_one: str, source: str) -> str:
    return source + " " + " UNION ALL ".join(select_one.format(c=c) for c in CLEAN_SCHEMA.names)


TYPE_NAMES = {f.name: f.dataType.simpleString() for f in CLEAN_SCHEMA.fields}


def null_profile() -> str:
    one = "SELECT '{c}' AS column, count(*) FILTER ({c} IS NULL) AS nulls, count(*) FILTER ({c} IS NULL) / count(*) * 100 AS pct FROM clean"
    return unpivoted(one.replace(" AS column", ' AS "column"'), f"WITH {RAW}, {clean('datamart')}")


def types() -> str:
    parts = [f"SELECT '{c}' AS \"column\", '{t}' AS type, count({c}) AS n_values FROM clean" for c, t in TYPE_NAMES.items()]
    return f"WITH {RAW}, {clean('datamart')} " + " UNION ALL ".join(parts)


def schema_report() -> str:
    parts = []
    for c, t in TYPE_NAMES.items():
        here = c in RAW_COLUMNS
        parts.append(
            f"SELECT '{c}' AS \"column\", '{t}' AS expected, {q('string') if here else 'NULL'} AS actual, "
            f"{f'count({c})' if here else 'count(NULL)'} AS n_values, {'true' if here and t == 'string' else 'false'} AS ok FROM raw"
        )
    return f"WITH {RAW} " + " UNION ALL ".join(parts)


# -- files, streams, quality --------------------------------------------------------------------------------


def joined(columns: list[str]) -> str:
    return " || ',' || ".join(f"coalesce({c}, '')" for c in columns)


def csv_cells() -> str:
    """Raw columns after a CSV trip, where empty text reads as NULL."""
    return ", ".join(f"nullif({c}, '') AS {c}" for c in RAW_COLUMNS)


def jagged() -> str:
    cut = {c: f"CASE WHEN customer_segment IS NOT NULL THEN nullif({c}, '') END AS {c}" for c in RAW_COLUMNS[-2:]}
    return ", ".join(cut.get(c, f"nullif({c}, '') AS {c}") for c in RAW_COLUMNS)


def lines_text() -> str:
    cells = ", ".join(f"{replaced(c, 'lines')} AS {c}" for c in RAW_COLUMNS)
    month_text = "CASE WHEN length(trim(date)) >= 4 THEN substr(trim(date), 1, 4) || CASE WHEN length(trim(date)) >= 7 THEN substr(trim(date), 6, 2) ELSE '01' END ELSE '' END"
    tail = [month_text, "CASE WHEN trim(quantity) = '' THEN '1' ELSE '0' END", "unit_price"]
    return over(f"{LINES}, c AS (SELECT {cells} FROM lines)", f"SELECT {joined(RAW_COLUMNS)} || ',' || {' || '.join([tail[0], q(','), tail[1], q(','), tail[2]])} AS value FROM c")


def reject_reason() -> str:
    out = f"CASE WHEN transaction_id IS NULL THEN 'null_id' WHEN {date('date', 'datamart')} IS NULL THEN 'bad_date'"
    for c in NUMBERS:
        number = long(c) if c == "quantity" else double(c)
        out += f" WHEN {c} IS NOT NULL AND trim({c}) <> '' AND ({number}) IS NULL THEN 'bad_{c}'"
    return out + " END"


def quality_figures() -> str:
    given = "date IS NOT NULL AND trim(date) <> ''"
    before = f"SELECT {COUNT} AS raw_rows, count(*) FILTER ({given}) AS dates_given, count(*) FILTER ({given} AND ({date('date', 'datamart')}) IS NOT NULL) AS dates_read FROM raw"
    after = f"SELECT {COUNT} AS clean_rows, count(*) FILTER (unit_price IS NULL) AS prices_missing, count(*) FILTER (unit_price IS NULL AND unit_price_imput IS NOT NULL) AS prices_filled FROM clean"
    return over(
        f"{clean('datamart')}, a AS ({before}), b AS ({after})",
        "SELECT *, clean_rows / raw_rows * 100 AS pct_rows_kept, dates_read / dates_given * 100 AS pct_dates_read, "
        "prices_filled / prices_missing * 100 AS pct_prices_filled FROM a, b",
    )


def text_rows() -> str:
    cells = [f"coalesce(CAST({c} AS VARCHAR), 'None')" for c in ["transaction_id", "date", "customer_id", "AnioMes", "quantity_null"]]
    return over(rows("lines"), f"SELECT {(' || ' + q(',') + ' || ').join(cells)} AS value FROM rows")


def oracles() -> dict[str, str]:
    profiles = ["datamart", "external", "chunked", "microbatch", "lines"]
    dated = profiles[:4]
    o = {f"{p}_clean": over(clean(p), "SELECT * FROM clean") for p in profiles}
    sample = RAW_COLUMNS
    o |= {f"text_{p}": over("", "SELECT " + ", ".join(f"{text(c, p)} AS {c}" for c in sample) + " FROM raw") for p in profiles}
    o |= {f"dates_{p}": over("", f"SELECT {date('date', p)} AS date, {date('modified_date', p)} AS modified_date FROM raw") for p in dated}
    o |= {f"timestamps_{p}": over("", f"SELECT {timestamp('timestamp', p)} AS ts FROM raw") for p in dated}
    o["anio_mes_sliced"] = over("", f"SELECT date, {month('trim(date)', 'lines')} AS AnioMes FROM raw")
    modified = "CAST(nullif(modified_date, '') AS DATE)"
    o["free_dates"] = over("", f"SELECT {modified} AS day_first, {modified} AS month_first FROM raw")
    o["numeric_casts"] = over("", f"SELECT {long('quantity')} AS quantity, {double('quantity')} AS quantity_float, " + ", ".join(f"{double(c)} AS {c}" for c in NUMBERS[1:]) + " FROM raw")
    o["quantity_flag"] = over("", f"SELECT quantity, {flag(f'({long('quantity')}) IS NULL')} AS after_integer_cast, {flag(double('quantity') + ' IS NULL')} AS after_float_cast, {flag('quantity IS NULL')} AS before_cast FROM raw")
    o["defaults_datamart"] = over("", "SELECT " + ", ".join(f"{row_columns('datamart')[c]} AS {c}" for c in rules.DATAMART_DEFAULTS) + " FROM raw")
    for p, columns in CATEGORY_COLUMNS.items():
        o |= {f"cat_{c}_{p}": over("", f"SELECT {c} AS raw_value, {category(c, c, p)} AS label, {COUNT} AS n FROM raw GROUP BY 1, 2") for c in columns}

    o["impute_levels"] = over(filled("datamart"), f"SELECT impute_level, {COUNT} AS n, round(avg(unit_price_imput), 6) AS avg_price FROM filled WHERE transaction_id <> 'UNKNOWN' GROUP BY 1")
    shown = f"transaction_id, {', '.join(KEYS)}, unit_price, unit_price_imput, impute_level"
    for name, p in [("impute_datamart", "datamart"), ("impute_shuffled", "datamart"), ("impute_nulls_only", "external"), ("impute_chunked", "chunked")]:
        o[name] = over(filled(p), f"SELECT {shown} FROM filled")
    o["impute_one_level"] = over(filled("lines"), f"SELECT transaction_id, {', '.join(KEYS[:3])}, unit_price, unit_price_imput FROM filled")
    levels = {"product": KEYS[:3], "category": KEYS[:2] + KEYS[3:], "region": KEYS[:2]}
    for name, keys in levels.items():
        k = ", ".join(keys)
        o[f"price_means_{name}"] = over(rows("datamart"), f"SELECT {k}, {mean('unit_price')} AS mean_price FROM rows GROUP BY {k} HAVING count(unit_price) > 0")
    o["price_mean_global"] = over(rows("datamart"), f"SELECT {mean('unit_price')} AS mean_price FROM rows")

    o["stats_external"] = over(rows("external"), f"SELECT {STATS['external']} FROM rows")
    o |= {f"stats_{f}": mart(f"SELECT {STATS[f]} FROM mart") for f in ["pipeline", "short", "smoke", "count"]}
    o["eda_kpis"] = mart(f"SELECT {STATS['dashboard']} FROM mart")
    o["eda_null_profile"], o["eda_types"] = null_profile(), types()
    o["eda_regions"] = shared("region", "transactions", f"{COUNT} AS transactions")
    o["eda_monthly"] = mart(
        f"SELECT strftime(date, '%Y-%m') AS year_month, {REVENUE}, "
        f"round({mean('total_amount')}, 2) AS avg_amount, count(total_amount) AS transactions, {QUANTITY}, {CUSTOMERS} FROM mart GROUP BY 1"
    )
    o["cached_monthly"] = o["eda_monthly"]
    o["named_columns"] = o["text_chunked"]
    o["eda_categories"] = groups("product_category", REVENUE, QUANTITY, TRANSACTIONS)
    o["eda_top_products"] = groups("product_id", REVENUE, QUANTITY, TRANSACTIONS, limit=10)
    o["eda_lifecycle"] = shared("product_lifecycle", "revenue", REVENUE, QUANTITY, TRANSACTIONS)
    o["eda_segments"] = groups("customer_segment", REVENUE, QUANTITY, TRANSACTIONS, CUSTOMERS)
    o["eda_top_customers"] = groups("customer_id", REVENUE, QUANTITY, TRANSACTIONS, limit=10)
    o["eda_payments"] = shared("payment_method", "revenue", REVENUE, TRANSACTIONS)
    o["eda_financial"] = mart(f"SELECT {REVENUE}, {mean('total_amount')} AS avg_ticket, {total('discount_pct')} AS discount_sum, {total('tax_amount')} AS tax_sum FROM mart")
    o["eda_price_hist"] = histogram("unit_price", 50, ", {lo} + bin * {width} <= (SELECT quantile_cont(unit_price, 0.95) FROM mart) AS in_view")
    o["eda_discount_hist"] = histogram("discount_pct", 30)
    o["eda_price_by_region"] = groups("region", f"{mean('unit_price')} AS avg_price")
    o["eda_discount_by_category"] = groups("product_category", f"{mean('discount_pct')} AS avg_discount")
    o["eda_region_profit"] = groups("region", REVENUE, QUANTITY, TRANSACTIONS)
    o["eda_price_p95"] = mart("SELECT quantile_cont(unit_price, 0.95) AS p95 FROM mart")
    o["recent_window"] = mart(f"SELECT transaction_id, date, AnioMes, total_amount FROM mart WHERE date >= {AS_OF} - INTERVAL 60 DAY")

    # Up to 4096 customers a sketch holds them all.
    o["sketch_customers"] = mart(
        f"SELECT region, {COUNT} AS n_rows, CAST(count(DISTINCT customer_id) AS BIGINT) AS n_customers FROM mart GROUP BY 1 "
        f"UNION ALL SELECT '*', {COUNT}, CAST(count(DISTINCT customer_id) AS BIGINT) FROM mart"
    )
    o["sketch_kept_customers"] = mart(
        "SELECT m.AnioMes, m.region, CAST(count(DISTINCT m.customer_id) AS BIGINT) AS n_customers, CAST(count(DISTINCT l.customer_id) AS BIGINT) AS n_kept "
        "FROM (SELECT DISTINCT AnioMes, region, customer_id FROM mart) m LEFT JOIN (SELECT DISTINCT AnioMes, region, customer_id FROM mart) l "
        "ON l.region = m.region AND l.customer_id = m.customer_id AND l.AnioMes // 100 * 12 + l.AnioMes % 100 + 1 = m.AnioMes // 100 * 12 + m.AnioMes % 100 GROUP BY 1, 2"
    )
    o["sketch_price_quantiles"] = mart(f"SELECT AnioMes, region, {COUNT} AS n_prices, true AS near FROM mart WHERE unit_price IS NOT NULL GROUP BY 1, 2")

    o["csv_roundtrip"] = o["bronze"] = over("", f"SELECT {csv_cells()} FROM raw")
    o["gzip_chain"] = o["bronze"]
    noted = "'\"' || coalesce(notes, '') || '\",' || chr(10) || chr(10) || product_id"
    o["quoted_csv"] = over("", f"SELECT {csv_cells()} FROM (SELECT * REPLACE ({noted} AS notes) FROM raw)")
    o["csv_jagged"] = over("", f"SELECT {jagged()} FROM raw")
    o["csv_corrupt"] = over("", f"SELECT product_id, CASE WHEN customer_segment IS NULL THEN 'short_row' WHEN status IS NULL THEN 'long_row' END AS reason, {COUNT} AS n FROM raw GROUP BY 1, 2")
    o["external_view"] = over("", "SELECT transaction_id, '\"' || region || '\",' || chr(10) || product_id AS notes, nullif(modified_date, '') AS modified_date FROM raw")
    o["lines_parse"] = over(LINES, "SELECT * FROM lines")
    o["lines_text"] = lines_text()
    cut = f"CASE WHEN customer_segment IS NULL THEN {joined(RAW_COLUMNS[:15])} ELSE {joined(RAW_COLUMNS)} END"
    o["line_rejects"] = over("", f"SELECT CASE WHEN customer_segment IS NULL THEN 'short_row' ELSE 'ok' END AS reason, {COUNT} AS n, CAST(sum(length({cut})) AS BIGINT) AS chars FROM raw GROUP BY 1")
    o["schema_evolution"] = mart("SELECT transaction_id, AnioMes, CASE WHEN AnioMes >= 199901 THEN notes END AS notes FROM mart")
    o["column_merge"] = mart("SELECT transaction_id, AnioMes, CASE WHEN AnioMes < 199901 THEN region END AS region, CASE WHEN AnioMes >= 199901 THEN notes END AS notes FROM mart")
    o["parquet_overwrite"] = mart("SELECT " + ", ".join(c for c in CLEAN_SCHEMA.names if c != "unit_price_imput") + " FROM mart")
    o["dual_write"] = mart(f"SELECT target, AnioMes, {COUNT} AS n, {total('total_amount')} AS revenue FROM mart, (VALUES (0), (1)) t(target) GROUP BY 1, 2")
    o["table_replace"] = mart("SELECT transaction_id, date, region, quantity FROM mart")
    o["add_column"] = over(filled("external"), "SELECT transaction_id, unit_price, unit_price_imput, unit_price_imput IS NOT NULL AS was_filled FROM filled")
    o["text_sink"] = text_rows()
    o["stream_append"] = o["microbatch_clean"]
    o["stream_filled"] = o["stream_moving_rows"] = o["datamart_clean"]
    o["stream_moving_means"] = o["store_add"] = o["price_means_category"]
    o["store_refresh"] = o["price_means_product"]
    o["update_in_place"] = o["add_column"]
    o["stream_monthly"] = o["eda_monthly"]
    o["stream_windows"] = over(
        rows("datamart"),
        f"SELECT time_bucket(INTERVAL 30 DAY, timestamp, TIMESTAMP '1970-01-01') AS window_start, {total('total_amount')} AS revenue, {COUNT} AS transactions "
        "FROM rows WHERE timestamp IS NOT NULL GROUP BY 1",
    )
    o["quality_figures"] = quality_figures()
    o["rejects"] = over(f"r AS (SELECT *, {reject_reason()} AS reason FROM raw)", "SELECT * FROM r WHERE reason IS NOT NULL")
    o["schema_report"] = schema_report()
    size = "SELECT least({n}, " + COUNT + ") AS n_rows, least({n}, " + COUNT + ") AS n_distinct, least({n}, " + COUNT + ") AS n_members FROM mart"
    o["sample_n_facts"] = mart(size.format(n=10_000))
    o["dashboard_sample"] = mart(size.format(n=100_000) + f" WHERE date >= {AS_OF} - INTERVAL 60 DAY")
    o["sample_months"] = mart("SELECT AnioMes, region, " + size.format(n=50).removeprefix("SELECT ") + " GROUP BY 1, 2")
    o["job_stats"] = over(clean("datamart"), f"SELECT s.*, target FROM (SELECT {STATS['pipeline']} FROM clean) s, (VALUES (0), (1)) t(target)")
    o["lines_file"] = o["lines_parse"]
    o["line_reject_rows"] = over("", f"SELECT {cut} AS value, CASE WHEN customer_segment IS NULL THEN 'short_row' ELSE 'ok' END AS reason FROM raw")
    whole = "customer_segment IS NOT NULL AND status IS NOT NULL"
    o["stream_rejects"] = over(
        "",
        f"SELECT {jagged()}, CASE WHEN customer_segment IS NULL THEN 'short_row' ELSE 'long_row' END AS reason, "
        f"(SELECT {COUNT} FROM raw WHERE {whole}) AS n_clean FROM raw WHERE NOT ({whole})",
    )
    o["stream_progress"] = (
        f"WITH {RAW.replace('raw AS', 'every AS', 1)}, raw AS (SELECT * FROM every WHERE {whole}), {MART}, "
        f"n AS (SELECT (SELECT {COUNT} FROM every) AS rows_in, (SELECT {COUNT} FROM raw) AS usable, (SELECT {COUNT} FROM mart) AS rows_out) "
        "SELECT CAST(2 AS BIGINT) AS batches, rows_in, rows_out, usable - rows_out AS dropped, rows_in - usable AS rejected FROM n"
    )
    return o
