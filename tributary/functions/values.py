"""Values other systems already match on."""

# These texts must stay exactly as they are, blanks and spelling included.
ORDER_STATUSES = (
    "PENDING",
    "PROCESSING",
    "SHIPPED",
    "IN TRANSIT",
    "DELIVERED",
    "CANCELLED",
)
DAY_FIRST_LIKE = "__-__-____"
UNKNOWN = "UNKNOWN"

MISSING_ORDER_ID = "missing order id "
BAD_DATE = "Invalid or missing date"
BAD_STATUS = "Invalid order status"
MISSING_CUSTOMER_ID = "missing customer id "
MISSING_SUPPLIER_ID = "supplier id is mising "
BAD_PERFORMANCE_SCORE = "Invalid performance score "
BAD_LEAD_TIME = "Invalid lead_time_Days < 0"
MISSING_PRODUCT_ID = "Missing product id "
BAD_QUANTITY = "invalid quantity"
BAD_UNIT_PRICE = "Invalid unit_price"
BAD_TOTAL_AMOUNT = "invalid total_amount"
BAD_INVENTORY = "invalid inventory_level < 0 "
UNKNOWN_REASON = "unknown"
NO_PRICE_TEXT = "null"
NO_TOTAL_TEXT = "Null"

STEP_MESSAGE = "sp_bronze_to_silver completed successfully"
SILVER_COMMENT = " silver layer stage 1 -- flattened and clean supply chain "
