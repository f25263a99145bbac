"""Order documents made from the star-schema tables.

Every 101st order carries one defect, chosen by ``o_orderkey % 101``, so each
validation rule is met. ``items`` holds all lines of an order with their parts;
a document is one row, so its items are gathered per order.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

FILES = 8

# Columns read of each table; a given schema saves a look into the files.
TABLES = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int",
    "part": "p_partkey bigint, p_name string, p_type string, p_size int, p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double,"
    " o_orderdate timestamp_ntz",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int,"
    " l_quantity double, l_shipdate timestamp_ntz",
}


def order_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders with all their lines and parts, the customer and a supplier; the same for every revision."""
    t = {n: spark.read.schema(ddl).parquet(f"{sf_dir}/{n}.parquet") for n, ddl in TABLES.items()}
    line = F.expr(
        "struct(l_linenumber, l_partkey, l_suppkey, CAST(l_quantity AS bigint) AS quantity, l_shipdate,"
        " p_name, p_type, p_retailprice, p_size)"
    )
    lines = t["lineitem"].join(t["part"], F.expr("l_partkey = p_partkey"), "left")
    lines = lines.repartition("l_orderkey").groupBy("l_orderkey").agg(F.array_sort(F.collect_list(line)).alias("lines"))
    # What the documents show of a line; the rest was for the order.
    lines = lines.selectExpr(
        "l_orderkey", "transform(lines, l -> struct(l.l_partkey, l.quantity, l.p_name, l.p_type, l.p_retailprice)) AS lines",
        "lines[0].l_shipdate AS first_shipdate", "lines[0].p_size AS first_size",
    )
    regions = t["nation"].join(t["region"], F.expr("n_regionkey = r_regionkey"))
    customers = t["customer"].join(regions, F.expr("c_nationkey = n_nationkey"), "left")
    countries = t["nation"].selectExpr("n_nationkey AS s_nation", "n_name AS s_country")
    suppliers = t["supplier"].join(countries, F.expr("s_nationkey = s_nation"), "left")
    supplier_count = t["supplier"].select(F.count("*")).scalar()
    orders = t["orders"].withColumn("suppliers", supplier_count)
    # Lines come last, so that the wide rows are shuffled once, by order.
    return (
        orders.join(customers.drop("n_name"), F.expr("o_custkey = c_custkey"), "left")
        .join(suppliers, F.expr("o_orderkey % suppliers = s_suppkey"), "left")
        .join(lines, F.expr("o_orderkey = l_orderkey"), "left")
        .selectExpr(
            "o_orderkey", "o_orderkey % 101 AS k", "o_orderstatus", "o_totalprice", "o_orderdate", "lines", "first_shipdate", "first_size",
            "c_custkey", "c_name", "r_name", "c_mktsegment", "s_suppkey", "s_name", "s_country",
        )
    )


def _defect(value: str, **by_k) -> str:
    """``value``, but for the given ``k`` another one: ``k2="'garbage'"``."""
    branches = " ".join(f"WHEN {k[1:]} THEN {other}" for k, other in by_k.items())
    return f"CASE k {branches} ELSE {value} END"


def _document(revision: int) -> str:
    """The document as a struct; all its text and numbers read alike on other engines."""
    iso = "yyyy-MM-dd\\'T\\'HH:mm:ss\\'Z\\'"
    day_first = "date_format(o_orderdate, 'dd-MM-yyyy')"
    date = f"CASE WHEN o_orderkey % 5 = 0 THEN {day_first} ELSE date_format(o_orderdate, '{iso}') END"
    status = "CASE o_orderstatus WHEN 'O' THEN ' pending' WHEN 'F' THEN 'Delivered' WHEN 'P' THEN 'in transit ' END"
    status = _defect(status, k3="'lost'", k18="NULL")
    carrier = "CASE o_orderkey % 4 WHEN 1 THEN 'dhl' WHEN 2 THEN ' UPS' WHEN 3 THEN 'FedEx ' END"
    total = _defect("o_totalprice", k14="NULL", k15="-5.25D")
    name = _defect("c_name", k22="NULL")
    if revision == 2:
        status, carrier, total = "'shipped'", "'rail'", f"{total} + 1"
    if revision == 3:
        name = "CAST(NULL AS string)"
    parent = "CASE WHEN o_orderkey % 2 = 0 THEN ' ord-' ELSE 'Ord-' END || o_orderkey"
    items = f"""transform(lines, line -> named_struct(
        'product_id', 'prd-' || line.l_partkey, 'product_name', line.p_name, 'category', line.p_type,
        'quantity', {_defect("line.quantity", k10="NULL", k11="0L")},
        'unit_price', {_defect("line.p_retailprice", k12="NULL", k13="-1.5D")}))"""
    return f"""named_struct(
      'order_id', {_defect(parent, k1="NULL")},
      'order_date', {_defect(date, k2="'garbage'", k17="NULL")},
      'order_status', {status},
      'customer', named_struct(
        'customer_id', {_defect("'cust-' || c_custkey", k4="NULL")},
        'customer_name', {name}, 'region', r_name, 'segment', c_mktsegment),
      'supplier', named_struct(
        'supplier_id', {_defect("'sup-' || s_suppkey", k5="NULL")},
        'supplier_name', s_name, 'country', s_country,
        'lead_time_days', {_defect("s_suppkey % 30", k9="-1", k23="NULL")},
        'performance_score', {_defect("s_suppkey % 101", k6="101", k7="-1", k8="101", k19="NULL")},
        'supplier_performance_score', CASE WHEN k = 8 THEN 120 END),
      'shipment', named_struct(
        'shipment_id', 'shp-' || o_orderkey, 'carrier', {carrier},
        'ship_date', date_format(first_shipdate, '{iso}'),
        'estimated_delivery', date_format(date_add(to_date(o_orderdate), 10), 'yyyy-MM-dd'),
        'delay_days', datediff(to_date(first_shipdate), to_date(o_orderdate)) - 30),
      'items', coalesce({items}, array()),
      'financials', named_struct(
        'total_amount', {total},
        'payment_status', CASE o_orderkey % 3 WHEN 0 THEN 'paid' WHEN 1 THEN 'Due' END),
      'warehouse', named_struct(
        'warehouse_id', 'wh-' || (o_orderkey % 7),
        'warehouse_location', CASE WHEN o_orderkey % 2 = 0 THEN 'Hall a' END,
        'inventory_level', {_defect("first_size", k16="-1", k20="NULL", k21="NULL")}))"""


def order_documents(facts: DataFrame, revision: int = 1) -> DataFrame:
    """``(o_orderkey, document)``, one JSON text per order; ``file_no`` and ``pair`` are kept if the facts have them.

    Revision 2 is a later document of the same order (shipped by rail, amount
    raised by one), revision 3 one without a customer name.
    """
    text = f"to_json({_document(revision)}, map('ignoreNullFields', 'false'))"
    # An absent level and a JSON null are told apart by the rules, so one defect removes the key.
    without_level = """replace(document, ',"inventory_level":null', '')"""
    kept = ["o_orderkey", *(c for c in ("file_no", "pair") if c in facts.columns)]
    return facts.selectExpr(*kept, "k", f"{text} AS document").selectExpr(
        *kept, f"CASE WHEN k = 21 THEN {without_level} ELSE document END AS document"
    )


def in_batch(documents: DataFrame, revision: int) -> DataFrame:
    """The orders of one merge batch; each order is in it once."""
    return documents.where({1: "o_orderkey % 3 < 2", 2: "o_orderkey % 3 > 0", 3: "o_orderkey % 3 = 1"}[revision])


def raw_orders(facts: DataFrame, revision: int = 1) -> DataFrame:
    """The documents as bronze rows."""
    return order_documents(facts, revision).selectExpr(
        "o_orderkey",
        "parse_json(document) AS raw_data",
        "TIMESTAMP_NTZ'1970-01-01 00:00:00' AS ingested_at",
        f"'r{revision}-' || (o_orderkey % {FILES}) || '.json' AS file_name",
        f"CAST(o_orderkey DIV {FILES} + 1 AS decimal(38,0)) AS file_row_number",
        f"'load-{revision}' AS load_id",
    )


def write_lines(documents: DataFrame, folder: str, compression: str = "snappy") -> None:
    """The documents as compressed files of one document per line, as many as there are tasks; nothing is shuffled."""
    documents.selectExpr("document AS value").write.mode("append").option("compression", compression).text(folder)


def in_files(rows: DataFrame) -> DataFrame:
    """Facts or documents dealt out by ``file_no``, one task per file, in order of their keys.

    Facts are shorter than documents, so deal them out before documents are made of them.
    """
    numbered = rows.withColumn("file_no", F.expr(f"o_orderkey % {FILES}"))
    task = F.coalesce(F.pmod("o_orderkey", F.lit(FILES)), F.lit(0)).cast("int")
    return numbered.repartitionById(FILES, task).sortWithinPartitions("file_no", "o_orderkey")


def write_files(
    documents: DataFrame, folder: str, array: bool = True, broken: bool = False, compression: str = "none"
) -> None:
    """The documents as eight text files in order of their keys, ``file_no=<n>/...``.

    A file is one array over several lines, or one document per line. With
    ``broken`` file 3 is cut off after its last document and so malformed.
    Documents that are not dealt out by :func:`in_files` are now.
    """
    dealt = documents if "file_no" in documents.columns else in_files(documents)
    value = "document"
    if array or broken:
        start, separator, end = ("[", ",", "]") if array else ("", "", "")
        tail = f"CASE WHEN NOT is_last THEN '{separator}' WHEN {'file_no = 3' if broken else 'false'} THEN '{{' ELSE '{end}' END"
        value = f"if(is_first, '{start}', '') || document || {tail}"
        # Where a file starts and ends in its task, by place: a window over the documents would hold whole files.
        dealt = dealt.withColumn("at", F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)))
        starts, at = {}, {}
        # One row per file.
        for file_no, n in sorted(dealt.groupBy("file_no").count().collect(), key=lambda r: (r[0] is not None, r[0])):
            task = (file_no or 0) % FILES
            starts[file_no] = at.get(task, 0)
            at[task] = starts[file_no] + n
            starts[file_no] = (starts[file_no], at[task] - 1)

        def place(end: int) -> str:
            return " OR ".join(f"(file_no <=> {'NULL' if no is None else no} AND at = {ends[end]})"
                               for no, ends in starts.items()) or "false"

        dealt = dealt.selectExpr("*", f"{place(0)} AS is_first", f"{place(1)} AS is_last")
    dealt.selectExpr("file_no", f"{value} AS value").write.partitionBy("file_no").mode("append").option(
        "compression", compression).text(folder)
