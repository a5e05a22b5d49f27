"""Hand-made order tables for unit tests."""

from basketry.sources import schemas
from basketry.sources.tables import Tables


def make_tables(spark, orders, products, aisles, departments, prior, train) -> Tables:
    return Tables(
        orders=spark.createDataFrame(orders, schemas.ORDERS),
        products=spark.createDataFrame(products, schemas.PRODUCTS),
        aisles=spark.createDataFrame(aisles, schemas.AISLES),
        departments=spark.createDataFrame(departments, schemas.DEPARTMENTS),
        order_products_prior=spark.createDataFrame(prior, schemas.ORDER_PRODUCTS),
        order_products_train=spark.createDataFrame(train, schemas.ORDER_PRODUCTS),
    )


def small_tables(spark) -> Tables:
    # user 1: three orders, product 10 bought in every order and twice in order 3;
    # product 99 is missing from the products table (NULL aisle / department)
    # user 2: a single order with one line (sample sd undefined)
    orders = [
        (1, 1, "prior", 1, 0, 8, None),
        (2, 1, "prior", 2, 3, 9, 7.0),
        (3, 1, "train", 3, 5, 10, 30.0),
        (4, 2, "train", 1, 1, 12, None),
    ]
    products = [(10, "apple", 1, 1), (11, "pear", 1, 1), (12, "milk", 2, 2), (13, "apple", 3, 2)]
    aisles = [(1, "fruit"), (2, "dairy"), (3, "more fruit")]
    departments = [(1, "produce"), (2, "fridge")]
    prior = [(1, 10, 1, 0), (1, 11, 2, 0), (2, 10, 1, 1), (2, 12, 2, 0)]
    train = [(3, 10, 1, 1), (3, 10, 2, 1), (3, 99, 3, 0), (3, 13, 4, 0), (4, 12, 1, 0)]
    return make_tables(spark, orders, products, aisles, departments, prior, train)
