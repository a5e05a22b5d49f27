"""Fixed schemas of the five order tables (CSV layout of the public dataset)."""

from pyspark.sql import types as T

ORDERS = T.StructType([
    T.StructField("order_id", T.LongType(), False),
    T.StructField("user_id", T.LongType(), False),
    T.StructField("eval_set", T.StringType(), False),
    T.StructField("order_number", T.IntegerType(), False),
    T.StructField("order_dow", T.IntegerType(), False),
    T.StructField("order_hour_of_day", T.IntegerType(), False),
    T.StructField("days_since_prior_order", T.DoubleType(), True),
])

PRODUCTS = T.StructType([
    T.StructField("product_id", T.LongType(), False),
    T.StructField("product_name", T.StringType(), False),
    T.StructField("aisle_id", T.IntegerType(), True),
    T.StructField("department_id", T.IntegerType(), True),
])

AISLES = T.StructType([
    T.StructField("aisle_id", T.IntegerType(), False),
    T.StructField("aisle", T.StringType(), False),
])

DEPARTMENTS = T.StructType([
    T.StructField("department_id", T.IntegerType(), False),
    T.StructField("department", T.StringType(), False),
])

ORDER_PRODUCTS = T.StructType([
    T.StructField("order_id", T.LongType(), False),
    T.StructField("product_id", T.LongType(), False),
    T.StructField("add_to_cart_order", T.IntegerType(), False),
    T.StructField("reordered", T.IntegerType(), False),
])

# file names of the public dataset layout
FILES = {
    "orders": ("orders.csv", ORDERS),
    "products": ("products.csv", PRODUCTS),
    "aisles": ("aisles.csv", AISLES),
    "departments": ("departments.csv", DEPARTMENTS),
    "order_products_prior": ("order_products__prior.csv", ORDER_PRODUCTS),
    "order_products_train": ("order_products__train.csv", ORDER_PRODUCTS),
}
