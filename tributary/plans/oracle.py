"""The same queries as plain SQL, for a check by another engine.

Paths, types, columns and the update set are written out here once more, on purpose: nothing that
decides a result is taken from the code under check. Only the texts of reasons are shared.
"""

from tributary.functions import values as V

# Where a field is in a document, and as what it is read.
FIELDS = (
    ("order_id", "$.order_id", "string"),
    ("order_date_text", "$.order_date", "string"),
    ("order_status", "$.order_status", "string"),
    ("customer_id", "$.customer.customer_id", "string"),
    ("customer_name", "$.customer.customer_name", "string"),
    ("customer_region", "$.customer.region", "string"),
    ("customer_segment", "$.customer.segment", "string"),
    ("supplier_id", "$.supplier.supplier_id", "string"),
    ("supplier_name", "$.supplier.supplier_name", "string"),
    ("supplier_country", "$.supplier.country", "string"),
    ("lead_time_days", "$.supplier.lead_time_days", "decimal(38,0)"),
    ("performance_score", "$.supplier.performance_score", "double"),
    ("supplier_performance_score", "$.supplier.supplier_performance_score", "double"),
    ("shipment_id", "$.shipment.shipment_id", "string"),
    ("carrier", "$.shipment.carrier", "string"),
    ("ship_date_text", "$.shipment.ship_date", "string"),
    ("estimated_delivery_text", "$.shipment.estimated_delivery", "string"),
    ("delay_days", "$.shipment.delay_days", "decimal(38,0)"),
    ("product_id", "$.items[0].product_id", "string"),
    ("product_name", "$.items[0].product_name", "string"),
    ("category", "$.items[0].category", "string"),
    ("quantity", "$.items[0].quantity", "decimal(38,0)"),
    ("unit_price", "$.items[0].unit_price", "double"),
    ("total_amount", "$.financials.total_amount", "double"),
    ("payment_status", "$.financials.payment_status", "string"),
    ("warehouse_id", "$.warehouse.warehouse_id", "string"),
    ("warehouse_location", "$.warehouse.warehouse_location", "string"),
    ("inventory_level", "$.warehouse.inventory_level", "decimal(38,0)"),
)

# The columns of the tables, and those a later document overwrites.
SHOWN = (
    "order_id", "order_date", "order_status", "customer_id", "customer_name", "customer_region",
    "customer_segment", "supplier_id", "supplier_name", "supplier_country", "lead_time_days",
    "performance_score", "shipment_id", "carrier", "ship_date", "estimated_delivery", "delay_days",
    "product_id", "product_name", "category", "quantity", "unit_price", "total_amount", "payment_status",
    "warehouse_id", "warehouse_location", "inventory_level", "file_name", "file_row_number",
)
UPDATED = (
    "order_status", "carrier", "ship_date", "estimated_delivery", "delay_days", "inventory_level",
    "payment_status", "customer_name", "customer_region", "supplier_name", "performance_score",
    "warehouse_id", "warehouse_location",
)
ORDER_TYPES = {
    "order_date": "timestamp_ntz", "lead_time_days": "decimal(38,0)", "performance_score": "double",
    "ship_date": "timestamp_ntz", "estimated_delivery": "date", "delay_days": "decimal(38,0)",
    "quantity": "decimal(38,0)", "unit_price": "double", "total_amount": "double",
    "inventory_level": "decimal(38,0)", "file_row_number": "decimal(38,0)",
    "ingested_at": "timestamp_ntz", "transformed_at": "timestamp_ntz",
}
DEFINITIONS = {
    "raw_orders": (
        ("raw_data", "variant"), ("ingested_at", "timestamp_ntz"), ("file_name", "string"),
        ("file_row_number", "decimal(38,0)"), ("load_id", "string"),
    ),
    "dead_letter": (
        ("raw_data", "variant"), ("error_reason", "string"), ("file_name", "string"),
        ("file_row_number", "decimal(38,0)"), ("rejected_at", "timestamp_ntz"),
    ),
    "stg_orders": tuple((c, ORDER_TYPES.get(c, "string")) for c in (*SHOWN, "ingested_at", "transformed_at")),
}
COMMENT = " silver layer stage 1 -- flattened and clean supply chain "
FILES = 8


def _unless(k: str, value: str, other: str = "NULL") -> str:
    return f"CASE WHEN k IN ({k}) THEN {other} ELSE {value} END"


_QUANTITY = "CASE WHEN l_orderkey % 101 = 10 THEN NULL WHEN l_orderkey % 101 = 11 THEN 0 ELSE CAST(l_quantity AS BIGINT) END"
_PRICE = "CASE WHEN l_orderkey % 101 = 12 THEN NULL WHEN l_orderkey % 101 = 13 THEN -1.5::DOUBLE ELSE p_retailprice END"
_ORDER = "ORDER BY l_linenumber, l_partkey, l_suppkey, CAST(l_quantity AS BIGINT), l_shipdate"

JOINED = f"""
order_lines AS (
  SELECT l_orderkey, first(l_shipdate {_ORDER}) AS first_shipdate, first(p_size {_ORDER}) AS first_size,
    list(struct_pack(product_id := 'prd-' || l_partkey, product_name := p_name, category := p_type,
      quantity := {_QUANTITY}, unit_price := {_PRICE}) {_ORDER}) AS items
  FROM lineitem LEFT JOIN part ON p_partkey = l_partkey GROUP BY l_orderkey
),
joined AS (
  SELECT o_orderkey, o_orderkey % 101 AS k, o_orderstatus, o_totalprice, o_orderdate,
         first_shipdate, first_size AS p_size, items, c_custkey, c_name, r_name, c_mktsegment,
         s_suppkey, s_name, sn.n_name AS s_country
  FROM orders
  LEFT JOIN order_lines ON l_orderkey = o_orderkey
  LEFT JOIN customer ON c_custkey = o_custkey
  LEFT JOIN nation cn ON cn.n_nationkey = c_nationkey
  LEFT JOIN region ON r_regionkey = cn.n_regionkey
  LEFT JOIN supplier ON s_suppkey = o_orderkey % (SELECT count(*) FROM supplier)
  LEFT JOIN nation sn ON sn.n_nationkey = s_nationkey
)"""


def _documents(revision: int) -> str:
    status = _unless("18", _unless(
        "3", "CASE o_orderstatus WHEN 'O' THEN ' pending' WHEN 'F' THEN 'Delivered'"
        " WHEN 'P' THEN 'in transit ' END", "'lost'"
    ))
    carrier = "CASE o_orderkey % 4 WHEN 1 THEN 'dhl' WHEN 2 THEN ' UPS' WHEN 3 THEN 'FedEx ' END"
    total = _unless("15", _unless("14", "o_totalprice"), "-5.25::DOUBLE")
    name = _unless("22", "c_name")
    if revision == 2:
        status, carrier, total = "'shipped'", "'rail'", f"({total}) + 1"
    if revision == 3:
        name = "NULL::VARCHAR"
    iso = "'%Y-%m-%dT%H:%M:%SZ'"
    date = _unless("17", _unless(
        "2", f"CASE WHEN o_orderkey % 5 = 0 THEN strftime(o_orderdate, '%d-%m-%Y')"
        f" ELSE strftime(o_orderdate, {iso}) END", "'garbage'"
    ))
    score = _unless("19", _unless("6, 8", _unless("7", "s_suppkey % 101", "-1"), "101"))
    inventory = _unless("20, 21", _unless("16", "p_size", "-1"))
    return f"""
docs{revision} AS (
  SELECT o_orderkey, CASE WHEN k = 21 THEN replace(doc, ',"inventory_level":null', '') ELSE doc END AS doc
  FROM (SELECT o_orderkey, k, CAST(to_json(struct_pack(
    order_id := {_unless("1", "CASE WHEN o_orderkey % 2 = 0 THEN ' ord-' ELSE 'Ord-' END || o_orderkey")},
    order_date := {date},
    order_status := {status},
    customer := struct_pack(
        customer_id := {_unless("4", "'cust-' || c_custkey")}, customer_name := {name},
        region := r_name, segment := c_mktsegment),
    supplier := struct_pack(
        supplier_id := {_unless("5", "'sup-' || s_suppkey")},
        supplier_name := s_name, country := s_country,
        lead_time_days := {_unless("23", _unless("9", "s_suppkey % 30", "-1"))},
        performance_score := {score},
        supplier_performance_score := CASE WHEN k = 8 THEN 120 END),
    shipment := struct_pack(
        shipment_id := 'shp-' || o_orderkey, carrier := {carrier},
        ship_date := strftime(first_shipdate, {iso}),
        estimated_delivery := strftime(o_orderdate + INTERVAL 10 DAY, '%Y-%m-%d'),
        delay_days := date_diff('day', CAST(o_orderdate AS DATE), CAST(first_shipdate AS DATE)) - 30),
    items := coalesce(items, []),
    financials := struct_pack(
        total_amount := {total},
        payment_status := CASE o_orderkey % 3 WHEN 0 THEN 'paid' WHEN 1 THEN 'Due' END),
    warehouse := struct_pack(
        warehouse_id := 'wh-' || (o_orderkey % 7),
        warehouse_location := CASE WHEN o_orderkey % 2 = 0 THEN 'Hall a' END,
        inventory_level := {inventory})
  )) AS VARCHAR) AS doc FROM joined)
)"""


def _typed(revision: int) -> str:
    columns = []
    for name, path, kind in FIELDS:
        text = f"json_extract_string(doc, '{path}')"
        if kind == "string":
            columns.append(f"{text} AS {name}")
        else:
            columns.append(f"TRY_CAST({text} AS {kind}) AS {name}, {text} AS {name}_text")
    names = ",\n    ".join(columns)
    day_first = f"order_date_text LIKE '{V.DAY_FIRST_LIKE}'"
    return f"""
typed{revision} AS (
  SELECT * EXCLUDE (order_status), upper(trim(order_status)) AS order_status, {day_first} AS day_first,
    CASE WHEN {day_first} THEN try_strptime(order_date_text, '%d-%m-%Y')
         ELSE TRY_CAST(order_date_text AS TIMESTAMP) END AS order_timestamp
  FROM (SELECT o_orderkey, 'r{revision}-' || (o_orderkey % {FILES}) || '.json' AS file_name,
    o_orderkey // {FILES} + 1 AS file_row_number, o_orderkey % {FILES} AS file_no,
    json_extract(doc, '$.warehouse.inventory_level') IS NOT NULL AS inventory_given,
    {names}
  FROM docs{revision})
)"""


_STATUSES = ", ".join(f"'{s}'" for s in V.ORDER_STATUSES)

REJECTS = f"""(order_id IS NULL
    OR (order_timestamp IS NULL AND NOT day_first) OR order_status NOT IN ({_STATUSES})
    OR customer_id IS NULL OR supplier_id IS NULL
    OR performance_score > 100 OR performance_score < 0 OR lead_time_days < 0
    OR product_id IS NULL OR quantity IS NULL OR quantity <= 0
    OR unit_price IS NULL OR unit_price < 0 OR total_amount IS NULL OR total_amount < 0
    OR inventory_level < 0)"""

ACCEPTS = f"""(order_id IS NOT NULL
    AND (order_timestamp IS NOT NULL OR day_first) AND order_status IN ({_STATUSES})
    AND customer_id IS NOT NULL AND supplier_id IS NOT NULL
    AND performance_score BETWEEN 0 AND 100 AND (lead_time_days >= 0 OR lead_time_days IS NULL)
    AND product_id IS NOT NULL AND quantity IS NOT NULL AND quantity > 0
    AND unit_price IS NOT NULL AND unit_price >= 0 AND total_amount IS NOT NULL AND total_amount >= 0
    AND (inventory_level >= 0 OR NOT inventory_given))"""

REASON = f"""CASE WHEN order_id IS NULL THEN '{V.MISSING_ORDER_ID}'
    WHEN order_timestamp IS NULL AND NOT day_first THEN '{V.BAD_DATE}'
    WHEN order_status NOT IN ({_STATUSES}) THEN '{V.BAD_STATUS}'
    WHEN customer_id IS NULL THEN '{V.MISSING_CUSTOMER_ID}'
    WHEN supplier_id IS NULL THEN '{V.MISSING_SUPPLIER_ID}'
    WHEN supplier_performance_score > 100 OR supplier_performance_score < 0
      THEN '{V.BAD_PERFORMANCE_SCORE}' || performance_score_text
    WHEN lead_time_days < 0 THEN '{V.BAD_LEAD_TIME}' || lead_time_days_text
    WHEN product_id IS NULL THEN '{V.MISSING_PRODUCT_ID}'
    WHEN quantity <= 0 THEN '{V.BAD_QUANTITY}' || quantity_text
    WHEN unit_price IS NULL OR unit_price < 0
      THEN '{V.BAD_UNIT_PRICE}' || coalesce(unit_price_text, '{V.NO_PRICE_TEXT}')
    WHEN total_amount IS NULL OR total_amount < 0
      THEN '{V.BAD_TOTAL_AMOUNT}' || coalesce(total_amount_text, '{V.NO_TOTAL_TEXT}')
    WHEN inventory_level < 0 THEN '{V.BAD_INVENTORY}' || inventory_level_text
    ELSE '{V.UNKNOWN_REASON}' END"""

GAP_REASON = """CASE WHEN order_date_text IS NULL THEN 'missing order date'
    WHEN order_status IS NULL THEN 'missing order status'
    WHEN performance_score IS NULL THEN 'missing performance score' ELSE 'null inventory level' END"""


def _flat(column: str) -> str:
    number = {
        "lead_time_days": "coalesce(lead_time_days, 0)",
        "delay_days": "greatest(coalesce(delay_days, 0), 0)",
        "quantity": "quantity",
        "inventory_level": "coalesce(inventory_level, 0)",
        "file_row_number": "file_row_number",
    }
    plain = {
        "order_date": "order_timestamp",
        "order_status": "order_status",
        "performance_score": "coalesce(performance_score, 0)",
        "ship_date": "TRY_CAST(ship_date_text AS TIMESTAMP)",
        "estimated_delivery": "TRY_CAST(estimated_delivery_text AS DATE)",
        "unit_price": "unit_price",
        "total_amount": "total_amount",
        "file_name": "file_name",
    }
    if column in number:
        return f"CAST({number[column]} AS BIGINT)"
    if column in plain:
        return plain[column]
    cleaned = f"upper(trim({column}))"
    if column in ("order_id", "customer_id", "supplier_id", "product_id"):
        return cleaned
    return f"coalesce({cleaned}, '{V.UNKNOWN}')"


_BATCH = {1: "o_orderkey % 3 < 2", 2: "o_orderkey % 3 > 0", 3: "o_orderkey % 3 = 1"}


def _orders(revision: int, where: str = "true") -> str:
    columns = ", ".join(f"{_flat(c)} AS {c}" for c in SHOWN)
    return f"SELECT o_orderkey, file_no, {columns} FROM typed{revision} WHERE {ACCEPTS} AND {where}"


def _with(*revisions: int, extra: str = "") -> str:
    parts = [JOINED]
    for revision in revisions:
        parts += [_documents(revision), _typed(revision)]
    return "WITH " + ",".join(parts) + (f",{extra}" if extra else "")


def _batches(*revisions: int) -> str:
    return ",".join(f"\nbatch{r} AS ({_orders(r, _BATCH[r])})" for r in revisions)


def _merged(target: str, source: str, *more: str) -> str:
    """Merge two relations; ``more`` columns keep their first value."""
    columns = []
    for c in (*SHOWN, *more):
        if c == "order_id":
            columns.append("coalesce(t.order_id, s.order_id) AS order_id")
        elif c in UPDATED:
            columns.append(f"CASE WHEN s.order_id IS NOT NULL THEN s.{c} ELSE t.{c} END AS {c}")
        else:
            columns.append(f"CASE WHEN t.order_id IS NOT NULL THEN t.{c} ELSE s.{c} END AS {c}")
    names = ", ".join(columns)
    return f"SELECT {names} FROM {target} t FULL JOIN {source} s ON t.order_id = s.order_id"


def _folded() -> str:
    columns = ["order_id"]
    for c in SHOWN[1:]:
        pick = "arg_max_null" if c in UPDATED else "arg_min_null"
        columns.append(f"{pick}({c}, batch_id) AS {c}")
    union = " UNION ALL ".join(f"SELECT *, {r} AS batch_id FROM batch{r}" for r in (1, 2, 3))
    return f"SELECT {', '.join(columns)} FROM ({union}) GROUP BY order_id"


def oracle_sql() -> dict[str, str]:
    shown = ", ".join(SHOWN)
    one, two = _with(1), _with(1, 2, extra=_batches(1, 2))
    numbered = f"""{one}
SELECT file_no, row_number() OVER (PARTITION BY file_no ORDER BY o_orderkey) AS file_row_number, order_id
FROM typed1"""
    keyed = "SELECT file_name, file_row_number, order_id"
    typed_names = [
        c
        for name, _, kind in FIELDS
        for c in (
            [name]
            if kind == "string"
            else [f"CAST({name} AS BIGINT) AS {name}" if kind.startswith("decimal") else name, f"{name}_text"]
        )
        if c not in ("unit_price_text", "total_amount_text")
    ]
    typed_columns = ", ".join(typed_names)
    duplicates = f"""{_with(1, 2, extra=_batches(1, 2))}, twice AS (
  SELECT *, 0 AS again FROM batch2
  UNION ALL
  SELECT * REPLACE (file_row_number + 100000 AS file_row_number, 'AIR' AS carrier), 1 AS again
  FROM batch2 WHERE o_orderkey % 10 = 1
), latest AS (
  SELECT * FROM twice QUALIFY row_number() OVER (PARTITION BY order_id ORDER BY file_row_number DESC) = 1
)
{_merged("batch1", "latest")}"""
    # Files of the two end-to-end batches.
    loaded = "".join(
        f""",
loaded{r} AS (
  SELECT * REPLACE (row_number() OVER (PARTITION BY file_no ORDER BY o_orderkey) AS file_row_number)
  FROM typed{r} WHERE {_BATCH[r]}
)"""
        for r in (1, 2)
    )
    steps = _with(1, 2) + loaded
    columns = ", ".join(f"{_flat(c)} AS {c}" for c in SHOWN)
    stored = steps + "".join(
        f",\nstep{r} AS (SELECT file_no, {columns} FROM loaded{r} WHERE {ACCEPTS})" for r in (1, 2)
    )
    accounts = f"""count(*) FILTER ({ACCEPTS}) AS accepted, count(*) FILTER ({REJECTS}) AS rejected,
  count(*) FILTER (coalesce({ACCEPTS}, false) = false AND coalesce({REJECTS}, false) = false) AS unrouted"""
    both = "(SELECT * FROM loaded1 UNION ALL SELECT * FROM loaded2)"
    stored_columns = ", ".join(c for c in (*SHOWN, "file_no") if c != "file_name")
    return {
        "bronze_documents": numbered,
        "bronze_array_split": numbered,
        "bronze_lines": numbered,
        "bronze_load_history": """
SELECT 'raw_orders' AS table_name, file_no,
  CASE WHEN file_no = 3 THEN 0 ELSE n END AS row_count,
  CASE WHEN file_no = 3 THEN 0 ELSE n END AS row_parsed,
  CASE WHEN file_no = 3 THEN 'malformed JSON' END AS first_error,
  CASE WHEN file_no = 3 THEN 'LOAD_FAILED' ELSE 'LOADED' END AS status
FROM (SELECT o_orderkey % 8 AS file_no, count(*) AS n FROM orders GROUP BY 1)""",
        "bronze_load_history_lines": """
SELECT 'raw_orders' AS table_name, file_no,
  CASE WHEN file_no = 3 THEN 0 ELSE n END AS row_count,
  CASE WHEN file_no = 3 THEN 0 ELSE n END AS row_parsed,
  CASE WHEN file_no = 3 THEN 'malformed JSON' END AS first_error,
  CASE WHEN file_no = 3 THEN 'LOAD_FAILED' ELSE 'LOADED' END AS status, 0 AS pending
FROM (SELECT o_orderkey % 8 AS file_no, count(*) AS n FROM orders GROUP BY 1
  UNION ALL SELECT 8, 0 UNION ALL SELECT 9, 0)""",
        "bronze_lines_loaded": numbered,
        "bronze_items": f"""WITH {JOINED}
SELECT 'shp-' || o_orderkey AS shipment_id, position, item.product_id AS product_id,
  item.product_name AS product_name, item.category AS category, CAST(item.quantity AS BIGINT) AS quantity,
  item.unit_price AS unit_price
FROM (SELECT o_orderkey, unnest(items) AS item, CAST(unnest(range(len(items))) AS BIGINT) AS position FROM joined)""",
        "bronze_pipe_status": """
SELECT phase, 'STOPPED' AS execution_state, CASE phase WHEN 'later' THEN n ELSE 0 END AS pending_files, loaded_rows
FROM (VALUES ('loaded'), ('later')) v(phase),
  (SELECT count(DISTINCT o_orderkey % 8) AS n, count(*) AS loaded_rows FROM orders)""",
        "bronze_late_files": """
SELECT late, documents FROM (VALUES (false), (true)) v(late), (SELECT count(*) AS documents FROM orders)""",
        "bronze_shapes": "SELECT 'shp-' || o_orderkey AS shipment_id, '} {\\' AS note FROM orders",
        "table_definitions": "SELECT table_name, position, column_name, type, comment, orders FROM (VALUES "
        + ", ".join(
            f"('{t}', {i}::BIGINT, '{c}', '{kind}', '{COMMENT if t == 'stg_orders' else ''}')"
            for t, columns in DEFINITIONS.items() for i, (c, kind) in enumerate(columns)
        )
        + ") v(table_name, position, column_name, type, comment), (SELECT count(*) AS orders FROM orders)",
        "bronze_pending_files": "SELECT DISTINCT o_orderkey % 8 AS file_no FROM orders",
        "stage_listing": f"""{one}
SELECT o_orderkey % 8 AS file_no, CAST(sum(strlen(doc) + 2) + 1 AS BIGINT) AS size,
  md5('[' || string_agg(doc, ',' || chr(10) ORDER BY o_orderkey) || ']' || chr(10)) AS md5
FROM docs1 GROUP BY 1""",
        "stream_append_only": f"""{steps}
SELECT 0::BIGINT AS delivery, file_no, file_row_number, order_id, 'INSERT' AS action, false AS is_update
FROM loaded1
UNION ALL
SELECT 1, file_no, file_row_number, order_id, 'INSERT', false FROM loaded2""",
        "stream_has_data": f"""
SELECT phase, phase = 'loaded' AS has_data, CAST(loaded_rows AS BIGINT) AS loaded_rows
FROM (VALUES ('empty'), ('loaded'), ('stepped')) v(phase),
  (SELECT count(*) AS loaded_rows FROM orders)""",
        "silver_typed_fields": f"""{one}
SELECT file_name, file_row_number, inventory_given, {typed_columns} FROM typed1""",
        "silver_reject": f"{one} {keyed} FROM typed1 WHERE {REJECTS}",
        "silver_dead_letter": f"{one} {keyed}, {REASON} AS error_reason FROM typed1 WHERE {REJECTS}",
        "insert_defaults": f"""{one}
{keyed}, {REASON} AS error_reason, true AS has_time, CAST(1 AS BIGINT) AS batch_id FROM typed1 WHERE {REJECTS}""",
        "silver_reason_counts": f"""{one}
SELECT {REASON} AS error_reason, count(*) AS documents FROM typed1 WHERE {REJECTS} GROUP BY 1""",
        "silver_accept": f"{one} {keyed} FROM typed1 WHERE {ACCEPTS}",
        "silver_unrouted": f"""{one} {keyed} FROM typed1
WHERE coalesce({REJECTS}, false) = false AND coalesce({ACCEPTS}, false) = false""",
        "silver_route_counts": f"""{one}
SELECT CASE WHEN {REJECTS} THEN 'rejected' WHEN {ACCEPTS} THEN 'accepted' ELSE 'unrouted' END AS route,
  count(*) AS documents FROM typed1 GROUP BY 1""",
        "silver_tolerant": f"""{one}
SELECT file_name, file_row_number, CASE WHEN {ACCEPTS} THEN 'accepted' ELSE 'rejected' END AS route,
  CASE WHEN {REJECTS} THEN {REASON} WHEN {ACCEPTS} THEN NULL ELSE {GAP_REASON} END AS error_reason
FROM typed1""",
        "silver_order_date": f"""{one}
SELECT file_name, file_row_number, order_date_text, order_timestamp AS order_date FROM typed1""",
        "silver_orders": f"{one} SELECT {shown} FROM ({_orders(1)})",
        "merge_insert": f"{one} SELECT {shown} FROM ({_orders(1)})",
        "merge_update": f"{two} {_merged('batch1', 'batch2')}",
        "merge_fold": f"{_with(1, 2, 3, extra=_batches(1, 2, 3))} {_folded()}",
        "merge_duplicate_latest": duplicates,
        "merge_duplicate_reference": f"""{two}, twice AS (
  SELECT * FROM batch2
  UNION ALL
  SELECT * REPLACE (file_row_number + 100000 AS file_row_number, 'AIR' AS carrier) FROM batch2 WHERE o_orderkey % 10 = 1
), new_rows AS (SELECT * FROM twice WHERE order_id NOT IN (SELECT order_id FROM batch1))
SELECT {shown}, true AS known_twice_fails FROM batch1 UNION ALL SELECT {shown}, true FROM new_rows""",
        "silver_step_counts": f"""{steps}
SELECT 'stg_orders' AS table_name, count(DISTINCT upper(trim(order_id))) AS row_count
FROM {both} WHERE {ACCEPTS}
UNION ALL
SELECT 'dead_letter', count(*) FROM {both} WHERE {REJECTS}""",
        "silver_row_accounting": f"""{steps}
SELECT {accounts}, count(*) FILTER ({ACCEPTS}) AS stored_changes, count(*) FILTER ({REJECTS}) AS stored_dead_letters,
  count(*) AS stored_documents
FROM {both}""",
        # The third batch has every order twice; tolerant mode rejects what has no route.
        "silver_failed_step": f"""{_with(1, 2, 3)}{loaded}, latest AS (
  SELECT count(*) FILTER ({ACCEPTS}) AS good, count(*) AS n FROM typed3
)
SELECT accepted + 2 * good AS accepted, rejected + 2 * (n - good) AS rejected, unrouted,
  accepted + good AS stored_changes, rejected + 2 * (n - good) AS stored_dead_letters,
  accepted + rejected + unrouted + 2 * n AS stored_documents, true AS failed, true AS unchanged
FROM (SELECT {accounts} FROM {both}), latest""",
        "silver_scheduled_task": f"""{one}
SELECT 'stg_orders' AS table_name, count(*) FILTER ({ACCEPTS}) AS row_count FROM typed1
UNION ALL SELECT 'dead_letter', count(*) FILTER ({REJECTS}) FROM typed1""",
        "stored_orders": f"{stored} SELECT {stored_columns} FROM ({_merged('step1', 'step2', 'file_no')})",
    }
